"""Main text of web pages: structure, and a suffix array per host for what repeats across its pages.

A page is cut into blocks in page order. Blocks inside an article (or main) element are the article; blocks in
menus, headers, footers, sidebars, notices, adverts, forms and reader comments go by their element, role, class
or id. A class or id counts where all its words are of that kind ("comment-list", not "social-science").

All text outside articles forms the page's token stream, in which each block of an article stands as one token. The
streams of a host are joined, their suffixes are sorted to the depth RUN by prefix doubling, and each group of
neighbours that agree to that depth is one string with the number of its distinct pages; an article block is a string of
its own. A string is boilerplate where at least SHARE of the host's pages have it, and MIN_PAGES of them at least:
articles of one host do share passages (here a line stands on up to an eighth of a host's pages), so a lower share would
cut articles. An article loses its boilerplate blocks; a page without an article element keeps the unique runs of its
blocks that no mark excludes. Pages with the same article, or the same unmarked text where there is none, count as one
page, whatever menu stands around them, so copies of a page keep their text.

A host's streams are dealt into chunks of bounded pages and bytes by their hash, so a host with a third of all pages is spread
over many tasks; a chunk sends each string once with its pages, and the chunks' page counts are added up, which
makes the result that of one suffix array.

Defined results: null html or a page without text gives an empty text; pages with a null or odd url share one
host; repeated rows are treated alike; an empty table gives an empty result; other columns are not read.
Unclosed elements end with the element around them.
"""

from __future__ import annotations

import html as html_lib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import materialize, release, table
from ledgerflow.llm.shingles import mix64, word_hashes

RUN, CHUNK_BYTES, CHUNK_PAGES = 8, 1 << 22, 500
#: A string is boilerplate on this share of a host's distinct pages, and on so many of them at least.
SHARE, MIN_PAGES = 0.5, 3

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+>|[^>]*+(?:>|\Z))|<[!?/][^>]*+(?:>|\Z)", re.DOTALL
)
_ATTR = re.compile(r"(class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "xmp", "noembed", "noframes", "svg", "math"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins",
    "kbd", "label", "mark", "nobr", "q", "ruby", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time",
    "tt", "u", "var", "wbr",
}
#: Elements, roles and class or id words of what is not the article.
CHROME = {"nav", "footer", "aside", "form", "button", "select", "menu", "dialog", "object", "audio", "video", "canvas", "fieldset", "head"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
WORDS = {
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "sidebar", "footer", "masthead", "banner", "cookie", "cookies",
    "consent", "gdpr", "notice", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "ad", "ads", "advert", "adverts",
    "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo", "promoted", "promotion", "outbrain", "taboola", "related",
    "recommended", "share", "sharing", "social", "comment", "comments", "disqus", "respond", "replies", "toolbar", "pagination", "pager",
}
HEADER_WORDS = {"header", "topbar"}
#: Words that say nothing about what a block holds.
NEUTRAL = {
    "list", "area", "box", "section", "container", "wrapper", "wrap", "block", "button", "buttons", "bar", "link", "links", "item", "items",
    "widget", "inner", "outer", "slot", "unit", "top", "bottom", "left", "right", "site", "page", "main", "global", "primary", "secondary",
    "post", "posts", "article", "articles", "form", "thread", "media", "icons", "text", "js", "id", "col", "row", "panel", "message", "policy",
    "collapse", "toggle", "dropdown", "mobile", "desktop", "fixed", "sticky", "inline", "close", "count", "reply", "email", "network",
    "networks", "tools", "meta", "header", "body", "title", "sub", "view", "feed", "content",
}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CONTENT = {"content", "article", "main", "post", "entry", "story", "articlebody"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


def _kind(name: str, attrs: str, in_article: bool) -> str:
    """'article', 'chrome' or '' for an element."""
    if name in ("article", "main"):
        kind = "article"
    elif name in CHROME or (name == "header" and not in_article):
        return "chrome"
    else:
        kind = ""
    if name in ("html", "body") or not attrs or "=" not in attrs:
        return kind
    for key, *values in _ATTR.findall(attrs):
        value = next((v for v in values if v), "")
        key = key.lower()
        if key == "role":
            if value.lower() in ROLES:
                return "chrome"
            if value.lower() in ("main", "article"):
                kind = "article"
        elif key == "itemprop":
            if value.lower() == "articlebody":
                kind = "article"
        elif not (in_article and name in HEADINGS):  # ids of headings are made from their text
            for part in value.split():
                if part.lower() in CONTENT:
                    break
                words = {w.lower() for w in _PARTS.findall(part)}
                marks = words & (WORDS if in_article else WORDS | HEADER_WORDS)
                if marks and words <= marks | NEUTRAL:
                    return "chrome"
    return kind


def blocks(page: str) -> list[tuple[str, str]]:
    """(kind, text) of each block of text in page order; kind is 'article', 'chrome' or ''."""
    out: list[tuple[str, str]] = []
    held: list[str] = []
    stack: list[tuple[str, str]] = []  # element and the kind that holds inside it
    kind = ""

    def flush():
        if held:
            text = " ".join(html_lib.unescape("".join(held)).split())
            held.clear()
            if text:
                out.append((kind, text))

    at, size = 0, len(page)
    while at < size:
        m = _TAG.search(page, at)
        if m is None:
            held.append(page[at:])
            break
        if m.start() > at:
            held.append(page[at : m.start()])
        at = m.end()
        name = (m[2] or "").lower()
        if not name:
            continue
        if m[1]:
            if name in INLINE and not any(n == name and k != kind for n, k in stack[-1:]):
                for j in range(len(stack) - 1, -1, -1):
                    if stack[j][0] == name:
                        if stack[j][1] == (stack[j - 1][1] if j else ""):
                            del stack[j]
                        else:
                            flush()
                            del stack[j:]
                            kind = stack[-1][1] if stack else ""
                        break
                    if stack[j][0] not in INLINE:
                        break
                continue
            if name == "br":
                held.append(" ")
                continue
            for j in range(len(stack) - 1, -1, -1):
                if stack[j][0] == name:
                    flush()
                    del stack[j:]
                    kind = stack[-1][1] if stack else ""
                    break
            else:
                if name not in INLINE:
                    flush()
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>", re.IGNORECASE).search(page, at)
            if not m[0].endswith("/>") or name not in ("svg", "math"):
                at = end.end() if end else size
            continue
        if name in VOID:
            if name == "br":
                held.append(" ")
            elif name == "hr":
                flush()
            continue
        found = _kind(name, m[3] or "", "article" in (kind,))
        if name not in INLINE or found:
            flush()
            # a block ends an open paragraph; items end their like
            for j in range(len(stack) - 1, -1, -1):
                if stack[j][0] == "p" or stack[j][0] in CLOSES.get(name, ()):
                    if name in INLINE:
                        break
                    del stack[j:]
                    kind = stack[-1][1] if stack else ""
                    break
                if stack[j][0] not in INLINE and not (name in ("tr",) and stack[j][0] in ("td", "th")):
                    break
        if m[0].endswith("/>") and found != "article" and name not in INLINE:
            continue
        inner = "chrome" if kind == "chrome" or found == "chrome" else "article" if kind == "article" else found
        stack.append((name, inner))
        kind = inner
    flush()
    return out


def host_of(url: str | None) -> str:
    m = re.match(r"[a-zA-Z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _long(x: np.uint64) -> int:
    return int(np.uint64(x).astype(np.int64))


PARSED = "page_id long, url string, host long, article array<string>, marks array<long>, texts array<string>, chrome array<boolean>, page long"


def _mixed(words: np.ndarray) -> np.uint64:
    """One value for a sequence of hashes."""
    return np.bitwise_xor.reduce(mix64(words + np.arange(1, len(words) + 1, dtype=np.uint64))) if len(words) else np.uint64(0)


def _words(text: str) -> np.ndarray:
    return word_hashes(text.encode("utf-8", "surrogatepass"))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in PARSED.split(", ")]
    longs, strings = pa.list_(pa.int64()), pa.list_(pa.string())
    kinds = [pa.int64(), pa.string(), pa.int64(), strings, longs, strings, pa.list_(pa.bool_()), pa.int64()]
    for batch in batches:
        rows = []
        for page_id, url, page in zip(batch.column("page_id").to_pylist(), batch.column("url").to_pylist(), batch.column("html"), strict=True):
            found = blocks(page.as_py() or "")
            body = [t for k, t in found if k == "article"]
            rest = [(t, k == "chrome") for k, t in found if k != "article"]
            host = _words("h " + host_of(url))
            marks = np.array([_mixed(_words(t)) for t in body], np.uint64)
            own = mix64(marks) if body else _words("\n".join(t for t, c in rest if not c))
            rows.append((
                page_id, url, _long(host[-1] + np.uint64(len(host))), body or None, marks.astype(np.int64).tolist(),
                [t for t, _ in rest], [c for _, c in rest], _long(_mixed(own) + np.uint64(bool(body))),
            ))
        cols = list(zip(*rows, strict=True)) or [[]] * len(names)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names)
        release()


def suffix_ranks(tokens: np.ndarray, depth: int) -> np.ndarray:
    """The rank of each suffix by its first `depth` tokens, by prefix doubling; equal ranks are equal strings."""
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    step = 1
    while step < depth:
        nxt = np.concatenate([rank[step:], np.full(min(step, len(rank)), -1)])[: len(rank)]
        rank = np.unique(rank * (len(rank) + 2) + nxt + 1, return_inverse=True)[1].astype(np.int64)
        step *= 2
    return rank


def _grams(words: np.ndarray, n: int = RUN) -> np.ndarray:
    """A hash of each run of n tokens."""
    count = len(words) - n + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(count, np.uint64(n))
    for i in range(n):
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + words[i : i + count])
    return out


def _host_array(pdf: pd.DataFrame) -> pd.DataFrame:
    """The suffix array of a chunk of a host: each string, of RUN tokens or an article's block, with the number of its pages."""
    parts, owner, grams, length = [], [], [], []
    for k, (texts, marks) in enumerate(zip(pdf["texts"], pdf["marks"], strict=True)):
        words, blocks_ = _words("\n".join(texts)), np.asarray(marks, np.int64).view(np.uint64)
        g = _grams(words)
        end = np.array([k], np.uint64) ^ np.uint64(1 << 63)  # no string crosses a page's end
        parts += [words, end, blocks_]
        owner.append(np.full(len(words) + 1 + len(blocks_), k))
        grams += [g, np.zeros(len(words) + 1 - len(g), np.uint64), blocks_]
        length += [np.full(len(g), RUN), np.zeros(len(words) + 1 - len(g), np.int64), np.ones(len(blocks_), np.int64)]
    tokens, owner, grams, length = np.concatenate(parts), np.concatenate(owner), np.concatenate(grams), np.concatenate(length)
    out = []
    for depth in (RUN, 1):
        starts_here = length == depth
        rank, own, gram = suffix_ranks(tokens, depth)[starts_here], owner[starts_here], grams[starts_here]
        order = np.lexsort((own, rank))
        rank, own, gram = rank[order], own[order], gram[order]
        if len(rank):
            new = np.concatenate([[True], rank[1:] != rank[:-1]])
            page = new | np.concatenate([[True], own[1:] != own[:-1]])
            starts = np.flatnonzero(new)
            out.append(pd.DataFrame({"gram": gram[starts].astype(np.int64), "n": np.add.reduceat(page.astype(np.int64), starts)}))
    found = pd.concat(out) if out else pd.DataFrame({"gram": [], "n": []}, dtype="int64")
    found.insert(0, "host", pdf["host"].iloc[0])
    return found


def _page_grams(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for host, key, texts in zip(pdf["host"], pdf["key"], pdf["texts"], strict=True):
            g = _grams(_words("\n".join(texts)))
            out.append(pd.DataFrame({"host": host, "key": key, "at": np.arange(len(g)), "gram": g.astype(np.int64)}))
        yield pd.concat(out) if out else pd.DataFrame({"host": [], "key": [], "at": [], "gram": []}, dtype="int64")


@F.pandas_udf(T.StringType())
def _unique_runs(texts: pd.Series, chrome: pd.Series, repeated: pd.Series) -> pd.Series:
    """Of the blocks that no mark excludes, what no repeated string covers."""
    out = []
    for blocks_, marked, starts in zip(texts, chrome, repeated, strict=True):
        words = [t.split() for t in blocks_]
        hit = np.zeros(sum(map(len, words)) + 1, np.int64)
        if starts is not None:
            np.add.at(hit, np.asarray(starts, np.int64), 1)
            np.add.at(hit, np.minimum(np.asarray(starts, np.int64) + RUN, len(hit) - 1), -1)
        covered = np.cumsum(hit) > 0
        kept, at = [], 0
        for block, mark in zip(words, marked, strict=True):
            if not mark:
                stay = " ".join(w for w, c in zip(block, covered[at : at + len(block)], strict=True) if not c)
                if stay:
                    kept.append(stay)
            at += len(block)
        out.append("\n".join(kept))
    return pd.Series(out)


def extract(pages: DataFrame, chunk_bytes: int = CHUNK_BYTES, share: float = SHARE, min_pages: int = MIN_PAGES) -> DataFrame:
    """page_id, url, text."""
    parsed = pages.select("page_id", "url", "html").mapInArrow(_parse, PARSED)
    parsed = materialize(parsed)
    # one of the pages with the same text of their own, the same one in every run
    size = F.aggregate("texts", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t))
    one = parsed.select("host", "page", "texts", "marks", size.alias("bytes"), F.xxhash64("texts").alias("h"))
    one = one.groupBy("host", "page").agg(F.min_by(F.struct("texts", "marks", "bytes"), "h").alias("one")).select("host", "page", "one.*")
    hosts = one.groupBy("host").agg(F.count("*").alias("n_pages"), F.sum("bytes").alias("bytes"))
    hosts = hosts.select("host", "n_pages", (1 + F.floor(F.greatest(F.col("bytes") / chunk_bytes, F.col("n_pages") / CHUNK_PAGES))).alias("chunks"))
    hosts = materialize(hosts)
    streams = one.join(hosts, "host").withColumn("chunk", F.pmod(F.xxhash64("page"), F.col("chunks")))
    counts = streams.select("host", "chunk", "texts", "marks").groupBy("host", "chunk").applyInPandas(_host_array, "host long, gram long, n long")
    counts = counts.groupBy("host", "gram").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_pages)
    repeated = materialize(counts.join(hosts, "host").filter(F.col("n") >= share * F.col("n_pages")).select("host", "gram"))

    marked = parsed.filter("article IS NOT NULL")
    hit = marked.select("host", "page", F.explode("marks").alias("gram")).distinct().join(repeated, ["host", "gram"])
    hit = materialize(hit.groupBy("host", "page").agg(F.collect_set("gram").alias("gone")))
    marked = marked.select("page_id", "url", "host", "page", "article", "marks").join(hit, ["host", "page"], "left")
    kept = F.filter(F.arrays_zip("article", "marks"), lambda b: ~F.array_contains("gone", b["marks"]))
    kept = F.when(F.col("gone").isNull(), F.col("article")).otherwise(F.transform(kept, lambda b: b["article"]))
    marked = marked.select("page_id", "url", F.array_join(kept, "\n").alias("text"))

    loose = parsed.filter("article IS NULL").withColumn("key", F.xxhash64("texts"))
    open_ = loose.select("host", "key", "texts").dropDuplicates(["host", "key"])
    found = open_.mapInPandas(_page_grams, "host long, key long, at long, gram long").join(repeated, ["host", "gram"])
    found = found.groupBy("host", "key").agg(F.collect_list("at").alias("repeated"))
    rest = loose.join(found, ["host", "key"], "left")
    rest = rest.select("page_id", "url", _unique_runs("texts", "chrome", "repeated").alias("text"))
    return marked.unionByName(rest)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = extract(table(spark, sf_dir, "pages"))
    return done.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
