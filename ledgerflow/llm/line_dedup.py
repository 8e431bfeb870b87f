"""Line dedup by a deletion-neighbourhood join, in DataFrame operations only.

A line is its words. A line is removed where an earlier line, by (doc_id, place), is equal to it or, for lines of
MIN_WORDS words or more, at most one word away (a word inserted, deleted or replaced), judged on the input; the
earliest of each kind stays. Lines without words stay. One word is too much of a shorter line: it would make "Read more"
and "Read this" one line.

Lines are first reduced to distinct ones. Two lines within the bound share their first or their last half, so
only lines that share a half with another go on. Each of these emits all its variants with one word left out,
as hashed keys. Lines of one length that share a variant at one place differ in that word alone; a line that
equals a variant of a longer one lacks that one word. Either way one join with the earliest line of a key finds
what is to go, the edit distance is verified on the words, and no pairs inside a group are emitted.

Defined results: a null text has no lines and stays null; rows that repeat a doc_id and its text keep the
same lines; a null doc_id stands last; ties go by the text's hash; an empty table gives an empty result; other
columns pass through. Lines are equal when 96 bits made of a 64-bit hash of their first and one of their last half are: of
10^12 pairs of lines with one half in common one agrees by chance once in 10^7 runs, and of others one in 10^12 distinct
lines once in 10^5. Lines one word apart are compared by the words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import discard, hashed, materialize, packed, table, unpacked

MIN_WORDS = 5
LAST = (1 << 63) - 1
DOC = ["_d", "_th"]
LINE = ["h", "h2"]
HALVES = ["p0", "s0", "p1", "s1"]


def _words(line: Column) -> Column:
    """The words between ASCII white space; plain replacements and a split at one character, which need no regex."""
    for c in "\t\x0b\x0c\r":
        line = F.replace(line, F.lit(c), F.lit(" "))
    return F.array_remove(F.split(line, " "), "")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_d", F.coalesce("doc_id", F.lit(LAST))).withColumn("_th", F.xxhash64("text"))


def _place() -> Column:
    """One number that orders lines by document and place; a number keeps the aggregations hash-based."""
    return F.col("_d").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("no")


def _halves(w: Column, n: Column) -> list[Column]:
    """Keys that a partner with as many words or one more shares, and those for a partner with one fewer."""
    keys = []
    for k, m in enumerate((n, n - 1)):
        m = F.greatest(m, F.lit(0))
        half = F.floor(m / 2).cast("int")
        keys += [
            F.xxhash64(F.lit("p"), m, F.slice(w, 1, half)).alias(f"p{k}"),
            F.xxhash64(F.lit("s"), m, F.slice(w, F.greatest(n - m + half + 1, F.lit(1)), F.greatest(m - half, F.lit(0)))).alias(f"s{k}"),
        ]
    return keys


def occurrences(docs: DataFrame) -> DataFrame:
    """_d, _th, no, h, h2, n, p0, s0, p1, s1: every line."""
    lines = _keyed(docs.select("doc_id", "text")).filter("text IS NOT NULL")
    lines = lines.select("_d", "_th", F.posexplode(F.split("text", "\n")).alias("no", "line"))
    words = lines.select("_d", "_th", "no", _words(F.col("line")).alias("w"))
    n = F.size("w")
    # no filter on n here: it would be pushed below and find the words twice
    halves = words.select("_d", "_th", "no", n.alias("n"), *_halves(F.col("w"), n))
    return halves.select("_d", "_th", "no", F.xxhash64("p0", "s0").alias("h"), F.hash("s0", "p0").alias("h2"), "n", *HALVES)


def _within_one(a: Column, b: Column) -> Column:
    """Whether two word arrays are at most one insertion, deletion or replacement apart."""
    m = F.least(F.size(a), F.size(b))
    same = F.zip_with(F.slice(a, 1, m), F.slice(b, 1, m), lambda x, y: x == y)
    hit = F.array_position(same, False).cast("int")
    p = F.when(hit == 0, m).otherwise(hit - 1)  # words that agree at the start
    longer_a, longer_b = (F.size(a) > F.size(b)).cast("int"), (F.size(b) > F.size(a)).cast("int")
    level = ((longer_a + longer_b) == 0).cast("int")

    def tail(x: Column, longer: Column) -> Column:
        skip = p + F.greatest(longer, level)
        return F.slice(x, skip + 1, F.greatest(F.size(x) - skip, F.lit(0)))

    return (F.abs(F.size(a) - F.size(b)) <= 1) & (tail(a, longer_a) == tail(b, longer_b))


def near_lines(docs: DataFrame, distinct: DataFrame) -> DataFrame:
    """h, h2 of distinct lines that have an earlier line within one word."""
    rows = distinct.count()
    halves = distinct.select(*LINE, F.explode(F.array(*HALVES)).alias("k"))
    shared = halves.groupBy("k").agg(F.count("*").alias("c")).filter("c > 1").select("k")
    wanted = halves.join(hashed(shared, rows), "k", "left_semi").select(*LINE).distinct()
    at = distinct.join(hashed(wanted, rows), LINE, "left_semi").select(*LINE, "n", "place", "_d", "_th", "no")
    by_doc = at.groupBy(*DOC).agg(F.collect_list(F.struct("no", *LINE, "n", "place")).alias("at"))
    texts = _keyed(docs.select("doc_id", "text")).select(*DOC, "text").join(hashed(by_doc, rows), DOC)
    texts = texts.select(F.split("text", "\n").alias("lines"), F.explode("at").alias("at"))
    found = texts.select("at.*", _words(F.element_at("lines", F.col("at.no") + 1)).alias("w"))
    found = materialize(found.drop("no").dropDuplicates(LINE))

    # each word's hash at its own place, and at the place before; their running combinations give all variants
    each = found.select(*LINE, "n", "place", F.posexplode("w").alias("j", "word"))
    each = each.withColumn("x", F.xxhash64("word", "j")).withColumn("y", F.xxhash64("word", F.col("j") - 1)).drop("word")
    line = Window.partitionBy(*LINE).orderBy("j")
    upto = line.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    all_ = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.bit_xor("x").over(upto).bitwiseXOR(F.col("x"))
    right = F.bit_xor("y").over(all_).bitwiseXOR(F.bit_xor("y").over(upto))
    variants = each.select(*LINE, "n", "place", "j", left.bitwiseXOR(right).alias("v"), F.bit_xor("x").over(all_).alias("whole"))
    variants = materialize(variants)

    first = [F.min("place").alias("ep"), F.min_by("h", "place").alias("eh"), F.min_by("h2", "place").alias("eh2")]
    # replaced: one length, one place, one variant; every line differs from the earliest in that word alone
    key = ["v", "j", "n"]
    earliest = variants.groupBy(*key).agg(*first, F.count("*").alias("c")).filter("c > 1").drop("c")
    replaced = variants.join(earliest, key).filter("ep < place").select(*LINE, "eh", "eh2")
    # inserted or deleted: a variant that is a whole line
    full = variants.filter("j = 0").select(F.col("whole").alias("v"), (F.col("n") + 1).alias("n"), F.col("h").alias("eh"), F.col("h2").alias("eh2"), F.col("place").alias("ep"))
    met = variants.select("v", "n", *LINE, "place").join(full, ["v", "n"])
    longer = met.filter("ep < place").select(*LINE, "eh", "eh2")
    shorter = met.groupBy("eh", "eh2", "ep").agg(F.min("place").alias("place"), F.min_by("h", "place").alias("h"), F.min_by("h2", "place").alias("h2"))
    shorter = shorter.filter("place < ep").select("eh", "eh2", "h", "h2").toDF("h", "h2", "eh", "eh2")
    pairs = replaced.unionByName(longer).unionByName(shorter).distinct()

    words = found.select(*LINE, "w")
    other = words.toDF("eh", "eh2", "ew")
    checked = pairs.join(words, LINE).join(other, ["eh", "eh2"]).filter(_within_one(F.col("w"), F.col("ew")))
    near = materialize(checked.select(*LINE).distinct())
    discard(found, variants)
    return near


def removed_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """_d, _th, gone: the places of the lines that go, by document."""
    occ = materialize(occurrences(docs)).filter("n > 0").withColumn("place", _place())
    # of lines of one place (rows that repeat a doc_id) any serves: they are equal
    where = [F.min("place").alias("place"), *[F.min_by(c, "place").alias(c) for c in ("_d", "_th", "no")]]
    distinct = materialize(occ.groupBy(*LINE).agg(*where, *[F.min(c).alias(c) for c in ("n", *HALVES)]))
    near = near_lines(docs, distinct.filter(F.col("n") >= min_words)).withColumn("near", F.lit(True))
    fate = distinct.select(*LINE, F.col("place").alias("first")).join(near, LINE, "left")
    gone = occ.select(*DOC, "no", "place", *LINE).join(fate, LINE).filter((F.col("first") < F.col("place")) | F.col("near"))
    return materialize(gone.groupBy(*DOC).agg(F.sort_array(F.collect_set("no")).alias("gone")))


def dedup(docs: DataFrame, min_words: int = MIN_WORDS, counts: tuple[str, str] | None = None) -> DataFrame:
    """The documents with their kept lines as text; counts names two more columns, for the lines and the removed ones."""
    own = packed(docs, "doc_id", "text")
    gone = removed_lines(own, min_words)
    joined = _keyed(own).join(hashed(gone, gone.count()), DOC, "left")
    # a column of its own: inside the function below, an expression would be split anew for every line
    joined = joined.withColumn("_lines", F.split("text", "\n"))
    lines = F.col("_lines")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("gone"))
    kept = F.array_join(F.transform(stay, lambda i: F.element_at(lines, i + 1)), "\n")
    n_lines = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    n_removed = F.when(F.col("gone").isNull(), F.lit(0)).otherwise(F.size("gone")).cast("long")
    out = joined.select(
        "doc_id", F.when(F.col("gone").isNull(), F.col("text")).otherwise(kept).alias("text"), "_rest", n_lines.alias("_n_lines"), n_removed.alias("_n_removed")
    )
    more = [F.col("_n_lines").alias(counts[0]), F.col("_n_removed").alias(counts[1])] if counts else []
    return out.select(*unpacked(out, docs, "doc_id", "text"), *more)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=("n_lines", "n_removed"))
    text = F.coalesce("text", F.lit(""))
    return done.select(
        "doc_id", "n_lines", "n_removed",
        F.length(text).cast("long").alias("kept_chars"), F.sha2(text, 256).alias("kept_sha256"),
    )


ORACLE_SQL = r"""
WITH lines AS (
  SELECT doc_id, CAST(no - 1 AS INTEGER) AS no, line,
    list_filter(string_split_regex(line, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS no FROM documents)
), uniq AS (
  SELECT w, len(w) AS n, min((doc_id, no)) AS first FROM lines WHERE len(w) >= 1 GROUP BY w
), variants AS (
  SELECT w, n, first, i, list_concat(w[1:i - 1], w[i + 1:n]) AS v FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM uniq WHERE n >= 5)
), near AS (
  SELECT w FROM (SELECT w, first, min(first) OVER (PARTITION BY v, i, n) AS e FROM variants) WHERE e < first
  UNION
  SELECT y.w FROM variants y JOIN uniq x ON y.v = x.w WHERE x.n >= 5 AND x.first < y.first
  UNION
  SELECT x.w FROM variants y JOIN uniq x ON y.v = x.w WHERE x.n >= 5 AND y.first < x.first
), judged AS (
  SELECT l.doc_id, l.no, l.line, coalesce(u.first < (l.doc_id, l.no), false) OR x.w IS NOT NULL AS gone
  FROM lines l LEFT JOIN uniq u ON u.w = l.w LEFT JOIN near x ON x.w = l.w
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INTEGER)) AS BIGINT) AS n_removed,
  CAST(length(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS BIGINT) AS kept_chars,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""
