"""Mixing, sharding, the Jaccard join and the pipeline against plain statements of their rules."""

import math
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerflow.llm import jaccard_join, label_sharding, registry, source_mixing
from tests.llm.test_text_operators import WORDS, D, brute_lines, clashing, docs_of, odd_texts, token_ids

from ledgerflow.llm.quality_rules import judge


# mixing


def brute_targets(sizes):
    names = sorted((n for n in sizes if n is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {n: (3, 1, 2)[i % 3] for i, n in enumerate(names)}
    left, open_, out = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[n] for n in open_)
        full = {n for n in open_ if 2 * sizes[n] < weight[n] * level}
        if not full:
            return out | {n: weight[n] * level for n in open_}
        for n in full:
            out[n] = 2.0 * sizes[n]
            left -= out[n]
        open_ -= full
    return out


def check_mix(rows, docs):
    sizes, of = defaultdict(int), {}
    for d, t, s in docs:
        n = len(WORDS.findall(t or ""))
        sizes[s] += n
        of[d] = (n, s)
    want = brute_targets(sizes)
    taken = defaultdict(int)
    for r in rows:
        n, s = of[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (n, sizes[s])
        assert math.isclose(r["target"], want[s], rel_tol=1e-9, abs_tol=1e-9)
        assert r["taken"] in (0, n, 2 * n)
        taken[s] += r["taken"]
    return want, taken


def test_mixing(spark):
    docs = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{D}/documents.parquet").collect()]
    one = registry.QUERIES["op4_source_mixing"](spark, D).collect()
    want, taken = check_mix(one, docs)
    largest = max(r["size"] for r in one)
    assert all(abs(taken[s] - want[s]) <= largest for s in want)
    again = registry.QUERIES["op4_source_mixing"](spark, D).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, again))


def test_mixing_odd(spark):
    texts = odd_texts()
    df = clashing(docs_of(spark, texts))
    mixed = source_mixing.mix(df).withColumn("taken", F.col("copies") * F.col("size")).collect()
    check_mix(mixed, [(r["doc_id"], r["text"], r["source"]) for r in df.collect()])
    out = source_mixing.emit(df)
    assert out.columns == df.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({r["doc_id"]: r["copies"] for r in mixed if r["copies"]})
    assert source_mixing.mix(df.limit(0)).count() == 0
    blank = docs_of(spark, [None, "", " "])
    assert {r["target"] for r in source_mixing.mix(blank).collect()} == {0.0}


def test_mixing_repeated_rows_and_null_ids(spark):
    """Rows that repeat a document share what the mix takes of them, and a rerun keeps the same rows."""
    texts = ["a b c d", "e f g", "h i", "j k l m n"]
    rows = [(d, t, "en", s, n) for n, (d, t, s) in enumerate([(1, texts[0], "s0")] * 5 + [(None, texts[1], "s1")] * 3 + [(None, texts[2], "s1"), (2, texts[3], None), (3, None, "s2")])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    mixed = source_mixing.mix(df).collect()
    assert len(mixed) == len(rows) and all(r["copies"] in (0, 1, 2) for r in mixed)
    want = Counter()
    for r in mixed:
        want[r["doc_id"], r["size"]] += r["copies"]
    once = sorted(map(repr, source_mixing.emit(df).collect()))
    assert Counter((r["doc_id"], len(WORDS.findall(r["text"] or ""))) for r in source_mixing.emit(df).collect()) == +want
    assert once == sorted(map(repr, source_mixing.emit(df.orderBy(F.desc("n_chars"))).collect()))


# sharding


def check_shards(rows, texts, k=8):
    counts = Counter(r["shard"] for r in rows)
    assert max(counts.values()) - min([*counts.values(), *([0] if len(counts) < k else [])]) <= 1
    for s, n in counts.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n))
    return counts


def test_sharding_tables(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{D}/documents.parquet").collect()}
    rows = registry.QUERIES["op5_label_sharding"](spark, D).collect()
    check_shards(rows, texts)
    assert len(rows) == len(texts)
    groups = defaultdict(set)
    for r in rows:
        b = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(b) + 1, zlib.crc32(b), "rows", None)
        groups[b].add(r["shard"])
    assert all(len(s) == 1 for s in groups.values())


def test_sharding_odd(spark):
    for texts in (["same"] * 40 + ["a", "b", None, "", None], ["same"] * 50, [], ["x"], [f"t{i // 2}" for i in range(60)], odd_texts()):
        df = clashing(docs_of(spark, texts)) if texts else docs_of(spark, ["x"]).limit(0)
        rows = label_sharding.assign(df).collect()
        assert sorted(r["doc_id"] for r in rows) == list(range(len(texts)))
        if rows:
            check_shards(rows, texts)


def spread_of(rows, texts):
    out = defaultdict(set)
    for r in rows:
        out[texts[r["doc_id"]]].add(r["shard"])
    return out


def test_sharding_null_and_repeated_ids(spark):
    texts = ["a"] * 6 + ["b", None, ""] + [f"t{i}" for i in range(11)]
    rows = label_sharding.assign(docs_of(spark, texts, ids=[None, 1, 1, 1, None, 2, 3, 4, None, *range(5, 16)])).collect()
    assert Counter(r["doc_id"] for r in rows) == Counter([None, 1, 1, 1, None, 2, 3, 4, None, *range(5, 16)])
    sizes = Counter(r["shard"] for r in rows)
    assert sorted(sizes.values()) == [2] * 4 + [3] * 4
    assert all(sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(n)) for s, n in sizes.items())


def test_sharding_cuts_no_group_that_fits(spark):
    for texts in (
        [f"t{i // 3}" for i in range(240)], [f"t{i // 30}" for i in range(240)], [f"t{i // 30}" for i in range(120)] + [f"u{i // 2}" for i in range(120)],
        [f"t{i // 15}" for i in range(150)] + [f"u{i}" for i in range(90)], [f"t{i // 2}" for i in range(1600)], [f"t{i // (2 + i % 5)}-{i % 5}" for i in range(2000)] + [f"u{i}" for i in range(40)],
    ):
        rows = label_sharding.assign(docs_of(spark, texts)).collect()
        check_shards(rows, texts)
        assert {len(s) for s in spread_of(rows, texts).values()} == {1}


def test_sharding_divides_large_groups_among_few(spark):
    texts = ["large"] * 100 + [f"t{i // 2}" for i in range(100)] + [f"u{i}" for i in range(40)]
    rows = label_sharding.assign(docs_of(spark, texts)).collect()
    check_shards(rows, texts)
    spread = spread_of(rows, texts)
    assert len(spread.pop("large")) == 4  # no assignment of 100 documents to shards of 30 touches fewer
    assert {len(s) for s in spread.values()} == {1}


def test_sharding_against_brute_force(spark):
    """Small cases: as few groups are cut as the best of all assignments cuts."""
    rnd = random.Random(2)

    def least_cut(sizes, quota):
        if not sizes:
            return 0
        best = 1 + least_cut(sizes[1:], quota)  # cut it: its documents then take what is left
        for s in range(len(quota)):
            if quota[s] >= sizes[0] and quota[s] not in quota[:s]:
                best = min(best, least_cut(sizes[1:], [q - sizes[0] * (i == s) for i, q in enumerate(quota)]))
        return best

    worse = 0
    for case in range(6):
        sizes = sorted((rnd.randint(2, 9) for _ in range(7)), reverse=True)
        texts = [f"g{g}" for g, n in enumerate(sizes) for _ in range(n)] + [f"u{i}" for i in range(rnd.randint(0, 10))]
        rnd.shuffle(texts)
        rows = label_sharding.assign(docs_of(spark, texts), shards=3).collect()
        cut = sum(len(s) > 1 for s in spread_of(rows, texts).values())
        quota = [len(texts) // 3 + (s < len(texts) % 3) for s in range(3)]
        assert Counter(Counter(r["shard"] for r in rows).values()) == Counter(quota)
        worse += cut - least_cut(sizes, quota)
    assert 0 <= worse <= 3


# Jaccard join


def shingles(text):
    words = WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    n = min(4, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if words else frozenset()


def brute_components(rows):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                label[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), d), d)
    return sorted((d, len(sets[i]), d if not sets[i] else least[find(i)]) for i, (d, _) in enumerate(rows))


def edited(rnd, words, n):
    out = list(words)
    for _ in range(n):
        out[rnd.randrange(len(out))] = f"new{rnd.randrange(10**6)}"
    return " ".join(out)


def test_jaccard_near_the_limit(spark):
    rnd = random.Random(5)
    texts = []
    for size in (3, 4, 5, 9, 12, 20, 33, 50, 90, 160, 400):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(size)]
        texts += [" ".join(words), " ".join(words).upper()]
        texts += [edited(rnd, words, e) for e in (1, 1, 2, max(1, size // 60), max(1, size // 45), size // 25) if e < size]
        texts += [" ".join(words + [f"x{i}" for i in range(max(1, size // 7))]), " ".join(words[max(1, size // 8) :])]
    texts += [None, "", "  ", texts[0]]
    rows = list(enumerate(texts))
    got = sorted(map(tuple, jaccard_join.link(clashing(docs_of(spark, texts))).collect()))
    assert got == brute_components(rows)


def test_jaccard_chains(spark):
    """Copies that link to a common one and not to each other, and a chain of small steps."""
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(200)]
    texts = [edited(rnd, words, 3) for _ in range(60)] + [" ".join(words)]
    step = list(words)
    for i in range(25):
        step[i * 7 : i * 7 + 4] = [f"s{i}{j}" for j in range(4)]
        texts.append(" ".join(step))
    got = sorted(map(tuple, jaccard_join.link(docs_of(spark, texts)).collect()))
    assert got == brute_components(list(enumerate(texts)))


def test_jaccard_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(60))
    df = docs_of(spark, [text, text + " x", text, "other words", "other words", None], ids=[None, 9, 4, None, None, None])
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.link(df).collect()), key=repr)
    assert got == sorted([(None, 57, 4), (9, 58, 4), (4, 57, 4), (None, 1, None), (None, 1, None), (None, 0, None)], key=repr)
    assert sorted(r["doc_id"] for r in jaccard_join.keep_one(df.filter("doc_id IS NOT NULL")).collect()) == [4]


def test_jaccard_common_passage(spark):
    """A passage that makes half of every text links nothing by itself, and hides no similar pair."""
    rnd = random.Random(12)
    word = lambda: f"w{rnd.randrange(10**6)}"
    passage = [word() for _ in range(100)]
    texts = []
    for k in range(150):
        own = [word() for _ in range(100)]
        texts.append(" ".join(own + passage))
        if k % 5 == 0:
            texts.append(" ".join(own[1:] + passage + [word()]))
            texts.append(edited(rnd, own + passage, 2))
    rnd.shuffle(texts)
    got = sorted(map(tuple, jaccard_join.link(docs_of(spark, texts)).collect()))
    assert got == brute_components([*enumerate(texts)])


def test_jaccard_crowded_signatures(spark, monkeypatch):
    """Texts that are four fifths a common passage, and copies of a text that is not there: few pairs are held against each other, no link is lost."""
    rnd = random.Random(21)
    word = lambda: f"w{rnd.randrange(10**6)}"
    passage, base = [word() for _ in range(80)], [word() for _ in range(120)]
    texts = [edited(rnd, base, 3) for _ in range(60)]
    for k in range(240):
        own = [word() for _ in range(20 + k % 3)]
        texts.append(" ".join(own + passage))
        if k % 6 == 0:
            texts.append(" ".join(own[1:] + passage + [word()]))
    rnd.shuffle(texts)
    held, bound = spark.sparkContext.accumulator(0), jaccard_join.may_be_similar

    def counted(a, b, *percent):
        return F.udf(lambda x: held.add(1) or x, "boolean")(bound(a, b, *percent))

    monkeypatch.setattr(jaccard_join, "may_be_similar", counted)
    got = sorted(map(tuple, jaccard_join.link(docs_of(spark, texts)).collect()))
    assert got == brute_components([*enumerate(texts)])
    assert held.value < 50 * len(texts)


def test_leading_shingles_lose_no_pair():
    """Similar sets share one of the rarest shingles of the smaller and of the larger, early enough for what they must share."""
    rnd = np.random.default_rng(14)
    some = lambda n: rnd.integers(0, 2**63, n).astype(np.uint64)
    passage, similar = some(200), 0
    for percent in (80, 85):
        for _ in range(400):
            size = int(rnd.integers(1, 120))
            common = np.concatenate([some(size), passage[: rnd.integers(0, 200)]])
            apart = int(len(common) * (100 - percent) / percent) + 2
            a, b = (np.unique(np.concatenate([common, some(rnd.integers(0, apart))])) for _ in range(2))
            a, b = (a, b) if len(a) <= len(b) else (b, a)
            both = len(np.intersect1d(a, b))
            if 100 * both < percent * (len(a) + len(b) - both):
                continue
            similar += 1
            counts = np.zeros(jaccard_join.COUNTERS, np.int64)
            for s in (a, b, passage):
                counts += np.bincount(jaccard_join._counter(s), minlength=len(counts))
            (x, few), (y, _) = jaccard_join.leading(a, counts, percent), jaccard_join.leading(b, counts, percent)
            at = {t: i for i, t in enumerate(y.tolist())}
            room = [min(len(a) - i, len(b) - at[t]) for i, t in enumerate(x[:few].tolist()) if t in at]
            assert (100 + percent) * max(room) >= percent * (len(a) + len(b))
    assert similar > 100


def test_records_leave_in_small_parts_and_take_little_memory():
    """Two workers and a JVM share an executor: a signature takes a few copies of its record at most until it has left."""
    rng = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(20_000)])
    texts = [" ".join(words[rng.integers(0, len(words), 600)]) for _ in range(1_000)]
    texts += [f"{t} more" for t in texts[:200]] + texts[:50]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 100])], ["text"]) for i in range(0, len(texts), 100)]
    expected = set()
    for s in map(jaccard_join.shingle_set, dict.fromkeys(texts)):
        expected |= {(x & ~1, jaccard_join.fingerprint(s)) for x in jaccard_join.signatures(s).tolist()}
    assert len(expected) > 200_000
    tracemalloc.start()
    made = list(jaccard_join._records(16, 4, 85)(iter(batches)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 75 * len(expected)
    blobs = [[b.as_py() for b in out.column("blob")] for out in made]
    assert len(blobs) > 1 and all(sum(map(len, b[:-1])) < jaccard_join.SEND_BYTES for b in blobs)
    rec = np.frombuffer(b"".join(b for out in blobs for b in out), jaccard_join.RECORD)
    assert len(rec) == len(expected)
    assert set(zip((rec["sig"] & ~jaccard_join.SHARED).tolist(), rec["fp"].tolist(), strict=True)) == expected


def test_schemes_lose_no_pair():
    """Sets at the very limit share a signature, whatever their size."""
    rnd = np.random.default_rng(9)
    for percent in (80, 85):
        for size in (2, 4, 5, 6, 7, 9, 11, 13, 17, 21, 26, 33, 48, 77, 150, 400, 1500):
            for _ in range(12):
                apart = size * (100 - percent) // percent  # the larger set may hold so many more, or both differ in the middle
                common = rnd.integers(0, 2**63, size).astype(np.uint64)
                other = np.concatenate([common, rnd.integers(0, 2**63, rnd.integers(0, apart + 1)).astype(np.uint64)])
                swap = int((len(common) + len(other)) * (100 - percent) / (100 + percent)) - (len(other) - len(common))
                if swap >= 2:
                    other[: swap // 2] = rnd.integers(0, 2**63, swap // 2).astype(np.uint64)
                a, b = np.unique(common), np.unique(other)
                both = len(np.intersect1d(a, b))
                if 100 * both < percent * (len(a) + len(b) - both) or np.array_equal(a, b):
                    continue
                assert set(jaccard_join.signatures(a, percent).tolist()) & set(jaccard_join.signatures(b, percent).tolist())


def test_jaccard_odd(spark):
    texts = odd_texts()
    df = docs_of(spark, texts)
    assert sorted(map(tuple, jaccard_join.link(df).collect())) == brute_components(list(enumerate(texts)))
    assert jaccard_join.link(df.limit(0)).count() == 0
    twice = clashing(df.unionByName(df))
    kept = jaccard_join.keep_one(twice)
    assert kept.columns == twice.columns
    comps = {c for _, n, c in brute_components(list(enumerate(texts))) if n}
    assert Counter(r["doc_id"] for r in kept.collect() if shingles(r["text"])) == Counter(comps)


def test_near_duplicate_stage_limit(spark):
    """Copies lengthened on both sides of five words and 0.8, some of them under four words and 0.85."""
    rnd = random.Random(11)
    texts = []
    for size in (6, 12, 30, 80, 200):
        words = [f"w{rnd.randrange(10**6)}" for _ in range(size)]
        texts.append(" ".join(words))
        texts += [" ".join(words + [f"x{rnd.randrange(10**6)}" for _ in range(size * p // 100)]) for p in (10, 20, 23, 40)]
        texts.append(edited(rnd, words, 1))
    sets = [(lambda w: frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)))(t.split()) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            label[i] = min(label[j] for j, b in enumerate(sets) if 100 * len(a & b) >= 80 * len(a | b))
        label = [label[x] for x in label]
    got = sorted(r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs_of(spark, texts), D).collect())
    assert got == sorted(set(label))
    assert len(got) < len({c for _, _, c in brute_components(list(enumerate(texts)))})


def test_sketch_is_a_bound():
    rnd = np.random.default_rng(4)
    for _ in range(200):
        a = np.unique(rnd.integers(0, 2**63, 50).astype(np.uint64))
        b = np.unique(np.concatenate([a[: rnd.integers(1, 50)], rnd.integers(0, 2**63, rnd.integers(1, 20)).astype(np.uint64)]))
        apart = sum(int(x ^ y & 2**64 - 1).bit_count() for x, y in zip([v & (2**64 - 1) for v in jaccard_join.sketch(a)], [v & (2**64 - 1) for v in jaccard_join.sketch(b)]))
        assert apart <= len(np.setxor1d(a, b))


def test_jaccard_tables(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{D}/documents.parquet").collect()]
    got = sorted(map(tuple, registry.QUERIES["op8_jaccard_join"](spark, D).collect()))
    assert got == brute_components(rows)


# pipeline


def test_stages_on_odd_input(spark):
    """Nulls in any column, odd and long texts, repeated rows, clashing names and no rows at all."""
    texts = [*odd_texts(), *odd_texts()[4:8], " ".join(f"long{i}" for i in range(30_000))]
    df = docs_of(spark, texts, ids=[None if i in (4, 17) else i // 2 * 2 for i in range(len(texts))])
    df = clashing(df).withColumns({"_lines_before": F.lit("x"), "_Lines_Removed": F.lit(None).cast("string"), "n_chars": F.when(F.col("n_chars") > 10, F.col("n_chars"))})
    ids = set(r["doc_id"] for r in df.collect())
    for name, stage in corpus_pipeline.STAGES:
        for docs in (df, df.limit(0), df.select("doc_id", "text", "source")):
            out = stage(spark, docs, D)
            rows = out.collect()
            if name != "best-fit packing":
                assert out.columns == docs.columns
            assert {r["doc_id"] for r in rows} <= ids
            assert bool(rows) == (docs is not None and docs.count() > 0)


def test_pipeline(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    columns = docs.columns
    before = {r["doc_id"]: r for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality rules"](spark, docs, D)
    assert good.columns == columns
    want = {d for d, r in before.items() if judge(r["text"])[6]}
    assert {r["doc_id"] for r in good.collect()} == want
    lined = stages["line dedup"](spark, good, D)
    assert lined.columns == columns
    texts = dict(brute_lines([(d, before[d]["text"]) for d in sorted(want)]))
    left = {d: t for d, t in texts.items() if t == before[d]["text"] or WORDS.search(t)}
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in lined.collect()}
    assert got == {d: (t, len(t)) for d, t in left.items()}
    one = stages["n-gram Jaccard join"](spark, lined, D)
    assert one.columns == columns
    stay = {c if n else d for d, n, c in brute_components(sorted(left.items()))}
    assert {r["doc_id"] for r in one.collect()} == stay
    mixed = stages["mixing sources to target weights"](spark, one, D)
    assert mixed.columns == columns
    copies = Counter(r["doc_id"] for r in mixed.collect())
    assert max(copies.values()) <= 2 and set(copies) <= stay
    check_mix([{"doc_id": d, "size": len(WORDS.findall(left[d])), "source_size": r["source_size"], "target": r["target"], "taken": r["copies"] * r["size"]}
               for r in source_mixing.mix(one).collect() for d in [r["doc_id"]]], [(d, left[d], before[d]["source"]) for d in stay])
    rows = corpus_pipeline.run(spark, D).collect()
    assert Counter(r["doc_id"] for r in rows if r["piece"] == 0) == copies
    single = {d for d, n in copies.items() if n == 1}
    sizes = Counter()
    for r in rows:
        sizes[r["doc_id"]] += r["length"]
    whole = {d: len(token_ids(left[d])) for d in single}
    assert {d: sizes[d] for d in single} == whole
    ids = defaultdict(bytes)
    for r in sorted(rows, key=lambda r: (r["doc_id"], r["piece"])):
        ids[r["doc_id"]] += r["ids"]
    assert all(ids[d] == np.array(token_ids(left[d]), "<u4").tobytes() for d in single)
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 1024) * 1.02 + 4
