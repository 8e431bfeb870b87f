"""Quality rules by repetition coverage.

Word n-grams of several lengths get rolling hashes in numpy; the characters inside n-grams that occur more
than once, and inside repeated lines, are measured against all characters in words. A document whose
covered share passes a limit at any length is rejected.

Defined results: a null or blank text has no words and fails the base rule; repeated rows are judged alike;
an empty table gives an empty one. Texts are taken whole; a long one is hashed slice by slice, so its words
are never all Python objects at once. Other columns pass through untouched, whatever their names.
"""

from __future__ import annotations

import re

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm.common import packed, release, table, unpacked

#: Largest share of the word characters that may lie in repeated n-grams, by n-gram length in words. Limits half as high,
#: as some corpora use them, would reject mostly documents that are labelled good here (the README has the figures).
LIMITS = {5: 0.40, 6: 0.38, 7: 0.36, 8: 0.34, 9: 0.32, 10: 0.30}
#: Largest shares of lines that repeat an earlier one, and of characters in them.
LINE_LIMIT, LINE_CHARS_LIMIT = 0.40, 0.40
MIN_WORDS, BASE_NGRAM, BASE_PERCENT = 20, 8, 30
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
NO_SPACES = dict.fromkeys(map(ord, SPACES))

RESULT = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean"
)


def _slices(data: bytes, step: int = 1 << 20):
    """Consecutive parts of data, cut after white space."""
    start = 0
    while start < len(data):
        end = start + step
        if end < len(data):
            cut = max(data.rfind(c.encode(), start, end) for c in SPACES)
            if cut < start:  # one word is longer than the step
                found = re.compile(rb"[\x20\x09-\x0D]").search(data, end)
                cut = found.start() if found else len(data) - 1
            end = cut + 1
        yield data[start:end]
        start = end


def word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash and the number of code points of each word. bytes.split() cuts at ASCII white space only."""
    hashes, sizes = [], []
    for part in _slices(data):
        words = part.split()
        hashes.append(np.fromiter(map(hash, words), np.int64, len(words)))
        if part.isascii():
            sizes.append(np.fromiter(map(len, words), np.int64, len(words)))
        else:
            sizes.append(np.fromiter((len(w.decode()) for w in words), np.int64, len(words)))
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes).view(np.uint64), np.concatenate(sizes)


def _repeated(h: np.ndarray) -> np.ndarray | None:
    """Which values of h occur more than once; None if none does."""
    s = np.sort(h)
    if not (s[1:] == s[:-1]).any():
        return None
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    out = np.zeros(len(h), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _covered(starts: np.ndarray, n: int) -> np.ndarray:
    """Words inside the n-word windows that begin where starts is true."""
    edge = np.zeros(len(starts) + n, np.int64)
    edge[: len(starts)] += starts
    edge[n:] -= starts
    return np.cumsum(edge)[:-1] > 0


def repetition(hashes: np.ndarray, lengths: tuple[int, ...]) -> dict[int, np.ndarray]:
    """For each n, the words covered by n-grams that occur more than once (only lengths that have some)."""
    out: dict[int, np.ndarray] = {}
    rolling, first = hashes, True
    mult = np.uint64(0x9E3779B97F4A7C15)
    for n in range(1, max(lengths) + 1):
        if not first:
            if len(rolling) < 2:
                break
            rolling = (rolling[:-1] ^ (rolling[:-1] >> np.uint64(29))) * mult + hashes[n - 1 :]
        first = False
        if n in lengths:
            again = _repeated(rolling)
            if again is None:  # then no longer n-gram repeats either
                break
            out[n] = _covered(again, n)
    return out


def judge(text: str | None) -> tuple[int, int, int, int, int, bool, bool]:
    if not text:
        return 0, 0, 0, 0, 0, True, False
    hashes, sizes = word_hashes(text.encode("utf-8", "surrogatepass"))
    n_words, word_chars = len(hashes), int(sizes.sum())
    n_symbols = sum(text.count(c) for c in SYMBOLS)
    seen: set[str] = set()
    lines = dup_lines = dup_chars = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            if line in seen:
                dup_lines += 1
                dup_chars += len(line.translate(NO_SPACES))
            else:
                seen.add(line)
    cover = repetition(hashes, tuple(LIMITS)) if n_words else {}
    n_repeat = int(cover[BASE_NGRAM].sum()) if BASE_NGRAM in cover else 0
    base_failed = n_words < MIN_WORDS or 100 * n_repeat > BASE_PERCENT * n_words
    good = all(float(sizes[mask].sum()) <= LIMITS[n] * word_chars for n, mask in cover.items())
    good = good and dup_lines <= LINE_LIMIT * lines and dup_chars <= LINE_CHARS_LIMIT * word_chars
    return n_words, word_chars, n_symbols, dup_lines, n_repeat, base_failed, good and not base_failed


def rules(text: Column) -> Column:
    """A struct of the counts and verdicts of one text."""

    @F.pandas_udf(RESULT)
    def judged(texts: pd.Series) -> pd.DataFrame:
        names = [x.split()[0] for x in RESULT.split(", ")]
        rows = [judge(t) for t in texts]
        release()
        return pd.DataFrame(rows, columns=names) if rows else pd.DataFrame({n: [] for n in names})

    return judged(text)


def apply_rules(docs: DataFrame) -> DataFrame:
    """One row for each document: doc_id with its counts and verdicts."""
    return docs.select("doc_id", rules(F.col("text")).alias("_r")).select("doc_id", "_r.*")


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that pass, with all their columns. The verdict is computed once, in its own step."""
    judged = packed(docs, "text").withColumn("_verdict", rules(F.col("text")))
    return judged.filter("_verdict.kept").select(unpacked(judged, docs, "text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text"))


ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols
  FROM docs
), lines AS (
  SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) > 1 AS again, length(regexp_replace(line, '[\x20\x09-\x0D]', '', 'g')) AS chars
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), line_sums AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (again) AS dup, coalesce(sum(chars) FILTER (again), 0) AS dup_chars FROM lines GROUP BY doc_id
), five AS (
  SELECT DISTINCT doc_id FROM (SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4])) AS g FROM docs) GROUP BY doc_id, g HAVING count(*) > 1
), grams AS (
  SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: w[i:i + n - 1])) AS g
  FROM docs JOIN five USING (doc_id), range(5, 11) r(n)
), repeated AS (
  SELECT doc_id, n, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, n, g) > 1
), covered AS (
  SELECT DISTINCT doc_id, n, unnest(range(i, i + n)) AS at FROM repeated
), shares AS (
  SELECT c.doc_id, c.n, count(*) AS words, sum(length(d.w[c.at])) AS chars FROM covered c JOIN docs d USING (doc_id) GROUP BY c.doc_id, c.n
), verdicts AS (
  SELECT s.doc_id, max(words) FILTER (n = 8) AS n_repeat, bool_or(chars::DOUBLE > (0.5::DOUBLE - n * 0.02::DOUBLE) * word_chars) AS bad
  FROM shares s JOIN base USING (doc_id) GROUP BY s.doc_id
), joined AS (
  SELECT b.*, CAST(coalesce(l.dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(v.n_repeat, 0) AS BIGINT) AS n_repeat_words, coalesce(v.bad, false)
    OR coalesce(l.dup, 0) > 0.4::DOUBLE * coalesce(l.n, 0) OR coalesce(l.dup_chars, 0) > 0.4::DOUBLE * word_chars AS bad
  FROM base b LEFT JOIN line_sums l USING (doc_id) LEFT JOIN verdicts v USING (doc_id)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  NOT bad AND NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS kept
FROM joined
"""
