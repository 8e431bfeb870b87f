"""Similarity join on word shingles by PartEnum signatures.

Two documents link when the Jaccard similarity of their sets of word shingles reaches a limit: 4 words and 85 percent
by default. A pair whose smaller set has s shingles then differs in at most s * (100 - percent) / percent of them. Sets are put into size bands; for a band the
shingle domain is hashed into n1 x n2 partitions, and for each of the n1 the subsets of n2 - k2 partitions are
enumerated; a signature is the hash of the shingles that fall into one subset. With at most k differences and
n1 > k / (k2 + 1), some first-level partition holds k2 differences at most, so the sets share a signature there.
A set emits the signatures of its own band, and those of the bands below where a smaller partner may stand.

A subset without shingles says nothing, so its signature is left out; n1 is taken larger by `slack` to make up
for that. A set with more such partitions than that slack also uses a second hash of the domain, and so on;
in the last one it keeps its empty signatures. Of two similar sets either one is regular under a hash that both use,
or both keep the empty ones: no pair is lost.

Equal sets are one entity throughout. Signatures travel as packed arrays by hash bucket, those that a batch
shares being sent once; of signatures that the same sets share one is kept. Where several sets share one, each is held
against one of them, in a second round against another one, and last against the sets of other components that share
a signature with it: of a signature's sets only those outside its largest component are paired with the rest. A signature
with many such sets is mostly a passage that dissimilar sets have in common. It is extended by one of their rarest
shingles: in any one order of the shingles the first that two similar sets share stands early in both, and in an order
by frequency a passage stands late. Of all pairs only those go on whose sizes and parity sketches allow the similarity (a
bound that no similar pair fails); these are checked exactly. Components are found by alternating large-star and
small-star steps.

Defined results: a null or blank text has the empty set and is linked with nothing; repeated rows have equal
sets, so they are linked; empty input gives an empty result; a null doc_id stands last, and a component of
such rows alone has a null id; other columns are not read. Sets are compared by 64-bit shingle hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import WORD, discard, materialize, packed, release, table, tie, unpacked
from ledgerflow.llm.shingles import mix64, shingle_set

SHINGLE, PERCENT, BAND, SEEDS = 4, 85, 1.25, 8
BUCKET_ROWS = 500_000
#: Bytes of packed records that leave a worker at once, and of texts that one gets: so much stands in the JVM beside it.
SEND_BYTES, BATCH_BYTES = 1 << 20, 1 << 21
#: Shingles that a subset should hold.
HOLDS = 3
#: Sets outside a signature's largest component up to which they are paired with all its sets.
CROWD = 16
#: Counters of shingles by hash, and the parts in which they travel.
COUNTERS, PARTS = 1 << 16, 64


def fingerprint(s: np.ndarray) -> int:
    """One value for a set, whatever the order."""
    with np.errstate(over="ignore"):
        a = mix64(s).sum(dtype=np.uint64)
        b = mix64(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
        both = mix64(np.array([a, b + np.uint64(len(s))], np.uint64) + np.array([0, 1], np.uint64))
        return int((both[0] * np.uint64(3) + both[1]).astype(np.int64))


def band_limits(band: int) -> tuple[int, int]:
    """Smallest and largest size in a band."""
    return int(np.ceil(BAND**band)), int(np.ceil(BAND ** (band + 1))) - 1


def band_of(n: int) -> int:
    band = int(np.log(n) / np.log(BAND))
    while band_limits(band)[1] < n:
        band += 1
    while band_limits(band)[0] > n:
        band -= 1
    return band


def _over(n: int, p: float, most: int) -> float:
    """The probability that more than `most` of n independent events of probability p happen."""
    if p <= 0 or most >= n:
        return 0.0
    mean = n * p
    if mean > 60:
        return 0.5 * math.erfc((most + 0.5 - mean) / math.sqrt(2 * mean * (1 - p)))
    term, total = (1 - p) ** n, 0.0
    for i in range(most + 1):
        total += term
        term *= (n - i) / (i + 1) * p / (1 - p)
    return max(0.0, 1 - total)


def _empty_subset(n: int, n1: int, n2: int, k2: int) -> float:
    """The probability that one of n1 groups of n2 partitions has a subset of n2 - k2 partitions without any of n shingles."""
    e = math.exp(-n / (n1 * n2))
    return sum(math.comb(n2, i) * e**i * (1 - e) ** (n2 - i) for i in range(n2 - k2, n2 + 1))


_SCHEMES: dict[tuple[int, int], tuple[int, int, np.ndarray, int] | None] = {}


def scheme(band: int, percent: int = PERCENT) -> tuple[int, int, np.ndarray, int] | None:
    """_scheme(), once for each worker."""
    if (band, percent) not in _SCHEMES:
        _SCHEMES[band, percent] = _scheme(band, percent)
    return _SCHEMES[band, percent]


def _scheme(band: int, percent: int) -> tuple[int, int, np.ndarray, int] | None:
    """n1, n2, subsets as rows of 0 and 1, slack; None where only equal sets can link.

    Of all n2, k2 the ones with the fewest signatures are taken, those counting more whose subsets hold fewer than HOLDS
    shingles (they are shared too easily) or are often empty (sets then need another hash). The slack is the number of
    groups with an empty subset that a set of the band's least size rarely exceeds.
    """
    least, most = band_limits(band)
    k = most * (100 - percent) // percent
    if k == 0:
        return None
    best = None
    for k2 in range(1, min(k, 6) + 1):
        need = k // (k2 + 1) + 1
        for n2 in range(k2 + 1, k2 + 5):
            if math.comb(n2, k2) > 84:
                continue
            for slack in range(need + 3):
                n1 = need + slack
                rare = _over(n1, min(1.0, _empty_subset(least, n1, n2, k2)), slack)
                if rare > 0.9:
                    continue
                holds = least * (n2 - k2) / (n1 * n2)
                cost = n1 * math.comb(n2, k2) * (1 + (HOLDS / holds) ** 4) * (1 + rare / (1 - rare))
                if best is None or cost < best[0]:
                    best = cost, n1, n2, k2, slack
                if rare < 0.001:
                    break
    if best is None:
        best = 0.0, k + 1, 2, 1, 0  # sets this small keep their empty signatures
    _, n1, n2, k2, slack = best
    subsets = np.zeros((math.comb(n2, k2), n2))
    for row, kept in zip(subsets, combinations(range(n2), n2 - k2), strict=True):
        row[list(kept)] = 1
    return n1, n2, subsets, slack


def signatures(s: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The PartEnum signatures of a set."""
    n = len(s)
    if n == 0:
        return np.zeros(0, np.uint64)
    own = band_of(n)
    bands = [own]
    while bands[-1] > 0 and n * percent <= band_limits(bands[-1] - 1)[1] * 100:
        bands.append(bands[-1] - 1)
    out = []
    for band in bands:
        found = scheme(band, percent)
        if found is None:
            continue
        n1, n2, subsets, slack = found
        for seed in range(SEEDS):
            h = mix64(s + np.uint64(0x632BE59BD9B4E019 * (seed + 1) & (2**64 - 1)))
            part = ((h >> np.uint64(32)) % np.uint64(n1 * n2)).astype(np.int64)
            rest = mix64(h)
            low = np.bincount(part, (rest & np.uint64(0xFFFFFFFF)).astype(np.float64), n1 * n2).reshape(n1, n2)
            high = np.bincount(part, (rest >> np.uint64(32)).astype(np.float64), n1 * n2).reshape(n1, n2)
            some = np.bincount(part, minlength=n1 * n2).reshape(n1, n2) @ subsets.T > 0
            regular = (~some).any(axis=1).sum() <= slack
            keep = some if regular or seed < SEEDS - 1 else np.ones_like(some)
            tag = np.uint64((band * SEEDS + seed) << 40) + np.arange(some.size, dtype=np.uint64).reshape(some.shape)
            sig = mix64(mix64((low @ subsets.T).astype(np.uint64) + tag * np.uint64(0x9E3779B97F4A7C15)) + (high @ subsets.T).astype(np.uint64))
            out.append(sig[keep])
            if regular:
                break
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def _arrow(names: list[str], kinds: list, cols: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names)


#: Words of 64 bits in a set's parity sketch.
SKETCH = 8


def sketch(s: np.ndarray) -> list[int]:
    """Parities of the set's sizes in 64 * SKETCH parts: two sketches differ in no more bits than the sets in shingles."""
    part = (mix64(s ^ np.uint64(0x3C6EF372FE94F82B)) % np.uint64(64 * SKETCH)).astype(np.int64)
    return np.packbits(np.bincount(part, minlength=64 * SKETCH).astype(np.uint8) & 1).view(np.int64).tolist()


def sizes(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n (size of the set), fp (its fingerprint), k0, k1, ... (its sketch)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [(len(s), fingerprint(s), *sketch(s)) for s in (shingle_set(t.as_py(), shingle) for t in batch.column("text"))]
            cols = list(zip(*made, strict=True)) or [[]] * (2 + SKETCH)
            names = ["doc_id", "n", "fp", *(f"k{i}" for i in range(SKETCH))]
            yield _arrow(names, [pa.int64()] * len(names), [batch.column("doc_id").to_pylist(), *cols])
        release()

    extra = "".join(f", k{i} long" for i in range(SKETCH))
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id long, n long, fp long{extra}")


def may_be_similar(a: str, b: str, percent: int = PERCENT):
    """A condition that every similar pair meets: similar sets differ in at most (100 - percent) / (100 + percent) of their
    sizes' sum, and neither their sizes nor their sketches can differ by more than the sets do."""
    apart = sum((F.bit_count(F.col(f"{a}k{i}").bitwiseXOR(F.col(f"{b}k{i}"))) for i in range(1, SKETCH)), F.bit_count(F.col(f"{a}k0").bitwiseXOR(F.col(f"{b}k0"))))
    limit = (100 - percent) * (F.col(f"{a}n") + F.col(f"{b}n"))
    return ((100 + percent) * F.abs(F.col(f"{a}n") - F.col(f"{b}n")) <= limit) & ((100 + percent) * apart <= limit)


#: A record: a signature and the set that has it. The signature's lowest bit says that several sets of a batch share it.
RECORD = np.dtype([("sig", "<u8"), ("fp", "<i8")])
SHARED = np.uint64(1)


def _records(buckets: int, shingle: int, percent: int):
    """Packed records by bucket. Within a batch only one set of a signature goes to the signature's bucket;
    the others go, spread by set, to buckets that pass them on unchanged. What a step has used goes before the next one
    begins, and records leave in small parts: two workers share an executor with its JVM."""

    def send(sig: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((fp, sig))
        rec = np.empty(len(sig), RECORD)
        rec["sig"], rec["fp"] = sig[order], fp[order]
        del sig, fp, order
        sig, fp = rec["sig"], rec["fp"]
        first = np.ones(len(rec), bool)
        first[1:] = sig[1:] != sig[:-1]
        group = np.cumsum(first, dtype=np.int32)
        group -= 1
        other = fp != fp[first][group]  # equal sets are one entity
        shared = np.zeros(int(first.sum()), np.uint64)
        shared[group[other]] = SHARED
        sig |= shared[group]
        del group, shared
        where = np.zeros(len(rec), np.int32)
        where[first] = (sig[first] >> np.uint64(17)) % np.uint64(buckets)
        where[other] = np.uint64(buckets) + mix64(fp[other].view(np.uint64)) % np.uint64(buckets)
        order = np.flatnonzero(first | other)
        del sig, fp, first, other
        order = order[np.argsort(where[order], kind="stable")]
        rec, where = rec[order], where[order]
        del order
        starts = np.concatenate([[0], np.flatnonzero(where[1:] != where[:-1]) + 1, [len(rec)]])
        ids, blobs, size = [], [], 0
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            ids.append(int(where[a]))
            blobs.append(rec[a:b].tobytes())
            size += len(blobs[-1])
            if size >= SEND_BYTES or b == len(rec):
                yield _arrow(["bucket", "blob"], [pa.int32(), pa.binary()], [ids, blobs])
                ids, blobs, size = [], [], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sigs, fps, held = [], [], 0
        seen: set[int] = set()

        def flush():
            sig = np.concatenate(sigs) & ~SHARED
            fp = np.repeat(np.array(fps, np.int64), [len(s) for s in sigs])
            sigs.clear()
            fps.clear()
            seen.clear()
            return send(sig, fp)

        for batch in batches:
            for text in batch.column("text"):
                s = shingle_set(text.as_py(), shingle)
                fp = fingerprint(s)
                if fp in seen:
                    continue
                made = signatures(s, percent)
                if len(made):
                    seen.add(fp)
                    sigs.append(made)
                    fps.append(fp)
                    held += len(made)
                if held >= BUCKET_ROWS:
                    yield from flush()
                    held = 0
        if held:
            yield from flush()
        release()

    return run


def _members(pdf: pd.DataFrame) -> pd.DataFrame:
    """The sets of signatures that several different sets share."""
    out = _members_of(pdf["blob"], bool(pdf["passed"].iloc[0]))
    release()
    return out


def _members_of(blobs: pd.Series, passed: bool) -> pd.DataFrame:
    rec = np.concatenate([np.frombuffer(b, RECORD) for b in blobs])
    sig, fp, shared = rec["sig"] & ~SHARED, rec["fp"], (rec["sig"] & SHARED) > 0
    if not passed:
        order = np.lexsort((fp, sig))
        sig, fp, shared = sig[order], fp[order], shared[order]
        first = np.ones(len(sig), bool)
        first[1:] = sig[1:] != sig[:-1]
        group = np.cumsum(first) - 1
        several = np.zeros(int(first.sum()), bool)
        several[group[shared | (fp != fp[first][group])]] = True
        again = np.zeros(len(sig), bool)
        again[1:] = (sig[1:] == sig[:-1]) & (fp[1:] == fp[:-1])
        keep = several[group] & ~again
        sig, fp = sig[keep], fp[keep]
    return pd.DataFrame({"sig": sig.astype(np.int64), "fp": fp})


def members(docs: DataFrame, buckets: int, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    packed = docs.select("text").mapInArrow(_records(buckets, shingle, percent), "bucket int, blob binary")
    packed = packed.withColumn("passed", F.col("bucket") >= buckets)
    return packed.groupBy("bucket").applyInPandas(_members, "sig long, fp long")


def _set_rows(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(t.as_py(), shingle) for t in batch.column("text")]
            yield _arrow(["fp", "s"], [pa.int64(), pa.binary()], [[fingerprint(s) for s in made], [s.tobytes() for s in made]])
        release()

    return run


@F.pandas_udf(T.BooleanType())
def _similar(a: pd.Series, b: pd.Series, percent: pd.Series) -> pd.Series:
    out, limit = [], int(percent.iloc[0]) if len(percent) else 0
    for x, y in zip(a, b, strict=True):
        p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        both = np.concatenate([p, q])
        both.sort()
        inter = int((both[1:] == both[:-1]).sum())
        out.append(100 * inter >= limit * (len(p) + len(q) - inter))
    release()
    return pd.Series(out)


def verify(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    one = pairs.join(sets.select(F.col("fp").alias("a"), F.col("s").alias("sa")), "a")
    two = one.join(sets.select(F.col("fp").alias("b"), F.col("s").alias("sb")), "b")
    return two.filter(_similar("sa", "sb", F.lit(percent))).select("a", "b")


def components(links: DataFrame) -> DataFrame:
    """fp, label: label is the least fp of the component, by alternating large-star and small-star steps."""
    edges = materialize(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # the least neighbours are written before they are joined: adaptive execution then splits a hub's rows
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = materialize(large)
        down = materialize(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(down, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        small = materialize(small.filter("u <> v").distinct())
        now = small.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        discard(edges, least, large, down)
        if now == before:
            return small.groupBy(F.col("u").alias("fp")).agg(F.min("v").alias("label"))
        edges, before = small, now


def one_each(shared: DataFrame) -> DataFrame:
    """Of all signatures that the same sets share, the rows of one. Sums of hashes, the least, the largest and the number tell which are the same."""
    part = lambda i: F.sum(F.shiftright(F.xxhash64("fp", F.lit(i)), 28))
    groups = shared.groupBy("sig").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"), F.count("*").alias("c"), part(1).alias("h1"), part(2).alias("h2"))
    return shared.join(groups.groupBy("lo", "hi", "c", "h1", "h2").agg(F.min("sig").alias("sig")).select("sig"), "sig", "left_semi")


def _named(df: DataFrame, prefix: str, key: str) -> DataFrame:
    return df.select(*[F.col(c).alias(c if c == key else prefix + c) for c in df.columns])


def _pairs(x: DataFrame, y: DataFrame, key: str, percent: int, also) -> DataFrame:
    """a < b: the rows of x with those of y that have the same key and another label, where they may be similar and `also` holds."""
    met = _named(x, "x", key).join(_named(y, "y", key), key)
    met = met.filter((F.col("xlabel") != F.col("ylabel")) & also & may_be_similar("x", "y", percent))
    return met.select(F.least("xfp", "yfp").alias("a"), F.greatest("xfp", "yfp").alias("b"))


def star(rows: DataFrame, place, percent: int = PERCENT) -> DataFrame:
    """The pairs of each signature's first set by `place` with its others."""
    placed = rows.withColumn("place", place)
    centre = placed.join(placed.groupBy("sig").agg(F.min("place").alias("place")), ["sig", "place"])
    return _pairs(rows, centre, "sig", percent, F.lit(True)).distinct()


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with the labels of their sets."""
    return rows.join(labels, "fp", "left").withColumn("label", F.coalesce("label", "fp"))


def outside(rows: DataFrame, key: str) -> DataFrame:
    """The rows of keys with several labels; minor: not of the key's most frequent label; minors: how many are not."""
    each = rows.groupBy(key, "label").agg(F.count("*").alias("c"))
    top = each.groupBy(key).agg(F.max(F.struct("c", "label")).alias("top"), F.sum("c").alias("minors"))
    top = top.select(key, F.col("top.label").alias("major"), (F.col("minors") - F.col("top.c")).alias("minors")).filter("minors > 0")
    return rows.join(top, key).withColumn("minor", F.col("label") != F.col("major")).drop("major")


def _count_shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts, some = np.zeros(COUNTERS, np.int64), False
    for batch in batches:
        for s in batch.column("s"):
            counts += np.bincount(_counter(np.frombuffer(s.as_py(), np.uint64)), minlength=COUNTERS)
            some = True
    if some:
        yield _arrow(["part", "counts"], [pa.int32(), pa.binary()], [list(range(PARTS)), [c.tobytes() for c in np.split(counts, PARTS)]])
    release()


def _counter(s: np.ndarray) -> np.ndarray:
    return (mix64(s) % np.uint64(COUNTERS)).astype(np.int64)


def _sum_counts(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, np.int64) for c in pdf["counts"])
    return pd.DataFrame({"part": pdf["part"].iloc[:1].to_numpy(), "counts": [total.tobytes()]})


def frequencies(sets: DataFrame) -> np.ndarray:
    """In how many of the sets the shingles of each counter stand: 512 KB, whatever the sets."""
    found = sets.select("s").mapInArrow(_count_shingles, "part int, counts binary").groupBy("part").applyInPandas(_sum_counts, "part int, counts binary")
    parts = {r["part"]: np.frombuffer(r["counts"], np.int64) for r in found.collect()}
    return np.concatenate([parts[i] for i in range(PARTS)]) if parts else np.zeros(COUNTERS, np.int64)


def leading(s: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, int]:
    """The rarest shingles of a set, rarest first, among which the first one shared with any similar set of its size or less
    stands; and how many of them suffice for similar sets of its size or more.

    Similar sets of n and m shingles share at least percent * (n + m) / (100 + percent), and percent / 100 of the larger.
    """
    n = len(s)
    order = np.argsort(counts[_counter(s)], kind="stable")  # s is sorted: one order for all sets
    return s[order[: n - -(-percent * n // 100) + 1]], n - -(-2 * percent * n // (100 + percent)) + 1


def _leading_rows(counts: np.ndarray, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [leading(np.frombuffer(s.as_py(), np.uint64), counts, percent) for s in batch.column("s")]
            if not made:
                continue
            of = pa.array(np.repeat(np.arange(len(made)), [len(t) for t, _ in made]))
            rest = batch.drop_columns(["s"])
            pos = np.concatenate([np.arange(len(t)) for t, _ in made])
            few = np.concatenate([np.arange(len(t)) < k for t, k in made])
            cols = [pa.array(np.concatenate([t for t, _ in made]).view(np.int64)), pa.array(pos), pa.array(few), *(c.take(of) for c in rest.columns)]
            yield pa.RecordBatch.from_arrays(cols, ["shingle", "pos", "few", *rest.schema.names])
        release()

    return run


def crowded_pairs(crowd: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a < b: the sets of `crowd` (fp, label, n, sketch) that may be similar, have different labels and share one of their rarest shingles."""
    full = crowd.join(sets, "fp")
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in crowd.schema)
    rows = full.select("s", *crowd.columns).mapInArrow(_leading_rows(frequencies(full), percent), f"shingle long, pos long, few boolean, {fields}")
    rows = materialize(outside(materialize(rows), "shingle").drop("minors"))
    # the smaller set's few against the larger's; the first common shingle leaves room for what they must share
    room = F.least(F.col("xn") - F.col("xpos"), F.col("yn") - F.col("ypos"))
    also = (F.struct("xn", "xfp") < F.struct("yn", "yfp")) & ((100 + percent) * room >= percent * (F.col("xn") + F.col("yn")))
    few, minor = rows.filter("few"), rows.filter("minor")
    return _pairs(few.filter("minor"), rows, "shingle", percent, also).unionByName(_pairs(few.filter("NOT minor"), minor, "shingle", percent, also))


def link(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every document; sets of so many words link from so many percent on."""
    slim = materialize(sizes(docs, shingle), BATCH_BYTES)
    total = slim.agg(F.sum("n")).first()[0] or 0
    buckets = max(1, int(0.6 * total) // BUCKET_ROWS + 1)
    every = materialize(members(docs, buckets, shingle, percent).distinct(), BATCH_BYTES)
    # one row for each set, so that copies of a text meet in no later join
    entities = materialize(slim.groupBy("fp").agg(F.min("doc_id").alias("doc"), *[F.max(c).alias(c) for c in ("n", *(f"k{i}" for i in range(SKETCH)))]))
    shared = materialize(one_each(every).join(entities.drop("doc"), "fp"))
    discard(every)
    # one set of each signature against the others
    tested = materialize(star(shared.withColumn("label", F.col("fp")), F.col("fp"), percent))
    wanted = entities.select("fp", "doc").join(shared.select("fp").distinct(), "fp", "left_semi")
    texts = docs.select("doc_id", "text").join(wanted.select("doc"), F.col("doc_id").eqNullSafe(F.col("doc")), "left_semi")
    sets = texts.mapInArrow(_set_rows(shingle), "fp long, s binary").dropDuplicates(["fp"])
    sets = materialize(sets.join(wanted.select("fp"), "fp", "left_semi"), BATCH_BYTES)
    labels = materialize(components(verify(tested, sets, percent)))
    # another one, not the same for all signatures, against those that still stand in another component
    open_ = materialize(outside(labelled(shared, labels), "sig").drop("minor", "minors"))
    again = materialize(star(open_, F.xxhash64("sig", "fp"), percent).join(tested, ["a", "b"], "left_anti"))
    edges = labels.select(F.col("fp").alias("a"), F.col("label").alias("b"))
    labels2 = materialize(components(edges.unionByName(verify(again, sets, percent))))
    # all that share a signature and still stand in different components
    last = materialize(outside(labelled(open_.drop("label"), labels2), "sig"))
    once = ~F.col("yminor") | (F.col("xfp") < F.col("yfp"))
    small = last.filter(F.col("minors") <= CROWD).drop("minors")
    cross = _pairs(small.filter("minor"), small, "sig", percent, once)
    crowd = materialize(last.filter(F.col("minors") > CROWD).drop("sig", "minor", "minors").distinct())
    if not crowd.isEmpty():
        cross = cross.unionByName(crowded_pairs(crowd, sets, percent))
    cross = materialize(cross.distinct())
    cross = cross.join(tested.unionByName(again), ["a", "b"], "left_anti")
    edges = labels2.select(F.col("fp").alias("a"), F.col("label").alias("b"))
    labels3 = materialize(components(edges.unionByName(verify(cross, sets, percent))))
    named = slim.select("doc_id", "n", "fp").join(labels3, "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    named = materialize(named)
    discard(slim, entities, shared, tested, sets, labels, open_, again, labels2, last, crowd, labels3)
    ids = materialize(named.filter("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id")))
    out = named.filter("n > 0").join(ids, "label").select("doc_id", "n", "component_id")
    alone = named.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id"))
    return out.unionByName(alone).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The earliest document of each component, and every document without words, with all their columns."""
    linked = link(docs.select("doc_id", "text"), shingle, percent)
    stay = linked.filter((F.col("n_shingles") == 0) | F.col("component_id").eqNullSafe(F.col("doc_id")))
    last = F.lit((1 << 63) - 1)
    stay = stay.select(F.coalesce("doc_id", last).alias("_d")).distinct()
    keyed = packed(docs, "doc_id", "text").withColumn("_d", F.coalesce("doc_id", last)).withColumn("_th", F.xxhash64("text"))
    kept = keyed.join(stay, "_d", "left_semi")
    blank = ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    # rows that repeat a document: one of them
    kept = kept.withColumn("_rn", F.row_number().over(Window.partitionBy("_d", "_th").orderBy(tie(kept))))
    return kept.filter((F.col("_rn") == 1) | blank).select(unpacked(kept, docs, "doc_id", "text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link(table(spark, sf_dir, "documents"), SHINGLE, PERCENT)


ORACLE_SQL = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT DISTINCT doc_id, w[i:i + 3] AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1)) + 1)) AS i FROM docs)
), sized AS (
  SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM sets a JOIN sets b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
), links AS (
  SELECT a, b FROM pairs JOIN sized x ON x.doc_id = a JOIN sized y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)
), reached AS (
  SELECT a, b FROM (WITH RECURSIVE r AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM r JOIN links l ON r.b = l.a) SELECT * FROM r)
)
SELECT d.doc_id, CAST(coalesce(any_value(s.n), 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(min(r.b), d.doc_id)) AS component_id
FROM docs d LEFT JOIN sized s USING (doc_id) LEFT JOIN reached r ON r.a = d.doc_id GROUP BY d.doc_id
"""
