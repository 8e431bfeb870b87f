"""Sharding by balanced label propagation, in DataFrame operations only.

Documents with equal texts are linked. Each starts in a shard by the hash of its id; in each round every group of linked
documents that has no place yet takes the label of the shard where most of its members stand, of those shards
that can still hold all of it (the other shards count as having none of its members). Quotas are exact: the groups
that want a shard enter in order, largest size class first and by hash inside a class, as far as its free places
reach; the others try again in the next round, with what is left. The groups of more than a sixteenth of a shard,
which are 16 for each shard at most, are placed before the rounds, largest first, each where it fills a shard best. Only groups that fit no shard, because they are larger than
what any has left, are divided, and then among as few shards as can be: their documents fill the free places shard
by shard, the emptiest shard first.

Members are counted by (group, salt) before anything else, so the rounds run over one row for each group, and a group
with a third of all rows meets its label in many tasks.

The law is `rows`: the shards' document counts differ by one at most. Documents without a link fill the places
that are left, longest first, dealt in turn, which keeps the bytes even too.

Defined results: a null text is empty and is linked like an empty one; repeated rows are documents of their own
(they are linked, being equal); ties go by hash; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialize, table, zip_index

SHARDS, ROUNDS, SALTS, BUCKETS, LARGE = 8, 24, 64, 512, 16


def _pick(values: list, at: Column) -> Column:
    """values[at], values being one number for each shard."""
    return F.element_at(F.array(*[F.lit(int(v)) for v in values]), (at + 1).cast("int"))


def _rounds(groups: DataFrame, quota: list[int], rounds: int) -> tuple[DataFrame, list[int]]:
    """grp with its shard, null where no shard can hold all of it, and the places that are left.

    groups: grp, size, near (how many of its members began in each shard).
    """
    k = len(quota)
    spare = list(quota)
    open_ = groups.select("grp", "size", "near")
    settled: list[DataFrame] = []
    for step in range(rounds):
        ranks = F.array(*[
            F.struct((F.lit(int(spare[s])) >= F.col("size")).alias("fits"), F.col("near")[s].alias("n"), F.xxhash64("grp", F.lit(step), F.lit(s)).alias("h"), F.lit(s).alias("s"))
            for s in range(k)
        ])
        wish = open_.withColumn("_best", F.array_max(ranks))
        turn = (63 - F.floor(F.log2("size"))) * BUCKETS + F.pmod(F.xxhash64("grp", F.lit(step)), F.lit(BUCKETS))
        wish = materialize(wish.select("grp", "size", "near", F.when(F.col("_best.fits"), F.col("_best.s")).alias("label"), turn.alias("turn")))
        queue = wish.filter("label IS NOT NULL").groupBy("label", "turn").agg(F.sum("size").alias("n"))  # k * 64 * BUCKETS rows at most
        upto = Window.partitionBy("label").orderBy("turn")
        queue = queue.withColumn("_sum", F.sum("n").over(upto)).filter(F.col("_sum") <= _pick(spare, F.col("label")))
        taken = {r["label"]: r for r in queue.groupBy("label").agg(F.max("turn").alias("turn"), F.max("_sum").alias("n")).collect()}
        first = wish.filter("label IS NOT NULL").groupBy("label").agg(F.min("turn").alias("turn")).collect()
        if not first:
            open_ = wish
            break
        # where not even the first turn fits, it holds several groups: one of them enters
        alone = {r["label"]: r["turn"] for r in first if r["label"] not in taken}
        enter = F.col("label").isNotNull() & (F.col("turn") <= _pick([taken[s]["turn"] if s in taken else -1 for s in range(k)], F.col("label")))
        if alone:
            stuck = F.col("label").isNotNull() & (F.col("turn") == _pick([alone.get(s, -1) for s in range(k)], F.col("label")))
            one = [r["grp"] for r in wish.filter(stuck).groupBy("label").agg(F.min("grp").alias("grp")).collect()]  # k at most
            for r in wish.filter(F.col("grp").isin(one)).select("label", "size").collect():
                spare[r["label"]] -= r["size"]
            enter = enter | F.col("grp").isin(one)
        for s, r in taken.items():
            spare[s] -= r["n"]
        settled.append(wish.filter(enter).select("grp", F.col("label").alias("shard")))
        open_ = wish.filter(~F.coalesce(enter, F.lit(False)))
    out = open_.select("grp", F.lit(None).cast("int").alias("shard"))
    for s in settled:
        out = out.unionByName(s)
    return out, spare


def _deal(index: Column, left: list[int]) -> tuple[Column, Column]:
    """(shard, turn) of the index-th place when shards are dealt one place each in turn until each has left[s]."""
    order = sorted(range(len(left)), key=lambda s: (left[s], s))
    shard, turn = F.lit(None).cast("int"), F.lit(None).cast("long")
    start, done = 0, 0
    for j, s in enumerate(order):
        active = sorted(order[j:])
        level = left[s]
        span = (level - done) * len(active)
        if span > 0:
            here = (index >= start) & (index < start + span)
            at = index - F.lit(start)
            shard = F.when(here, _pick(active, at % len(active)).cast("int")).otherwise(shard)
            turn = F.when(here, F.floor(at / len(active)) + done).otherwise(turn)
            start, done = start + span, level
    return shard, turn


def _fill(start: int, end: int, spare: list[int]) -> list[tuple[int, int, int, int]]:
    """(index, shard, place, count): the indices from start to end fill the shards' spare places, the emptiest shard first."""
    out = []
    for s in sorted(range(len(spare)), key=lambda s: (-spare[s], s)):
        n = min(spare[s], end - start)
        if n > 0:
            out.append((start, s, 0, n))
            start += n
    return out


def assign(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for all documents; groups of equal texts stay together where a shard can hold them."""
    text = F.coalesce("text", F.lit(""))
    slim = docs.select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("grp"),
    )
    spread = F.xxhash64("doc_id", "grp")
    slim = slim.withColumn("salt", F.pmod(spread, F.lit(SALTS)).cast("int"))
    slim = materialize(slim.withColumn("start", F.pmod(F.shiftright(spread, 8), F.lit(shards)).cast("int")))
    total = slim.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]

    cells = slim.groupBy("grp", "salt").agg(F.count("*").alias("cnt"), *[F.count_if(F.col("start") == s).alias(f"n{s}") for s in range(shards)])
    groups = cells.groupBy("grp").agg(F.sum("cnt").alias("size"), F.array(*[F.sum(f"n{s}") for s in range(shards)]).alias("near"))
    groups = materialize(groups.filter("size > 1"))
    # groups of more than a LARGE-th of a shard are few, LARGE * shards at most; what is larger than a shard is divided first
    large = groups.filter(F.col("size") * LARGE > max(quota)).orderBy(F.desc("size"), "grp").collect()
    divided = [r["grp"] for r in large if r["size"] > max(quota)]
    n_divided = sum(r["size"] for r in large if r["size"] > max(quota))
    spans = _fill(0, n_divided, list(quota))
    filled = [sum(n for _, s, _, n in spans if s == k) for k in range(shards)]
    spare, placed = [quota[s] - filled[s] for s in range(shards)], []
    for r in large:
        fits = [s for s in range(shards) if spare[s] >= r["size"]]
        if r["size"] <= max(quota):
            # of the shards that hold all of it the one that it fills most, then the one where most of it stands
            best = min(fits, key=lambda s: (spare[s], -r["near"][s], s), default=None)
            placed.append((r["grp"], best))
            if best is not None:
                spare[best] -= r["size"]
    small, spare = _rounds(groups.filter(F.col("size") * LARGE <= max(quota)), spare, rounds)
    homes = small.unionByName(docs.sparkSession.createDataFrame(placed + [(g, None) for g in divided], "grp string, shard int"))
    homes = materialize(homes)

    # a row for each salt that a group has, so that a large group's documents meet it in many tasks
    salts = slim.select("grp", "salt").distinct().join(homes, "grp").withColumn("linked", F.lit(True))
    labelled = slim.drop("start").join(salts, ["grp", "salt"], "left").drop("salt")
    labelled = materialize(labelled.withColumn("linked", F.coalesce("linked", F.lit(False))))
    out = ["doc_id", "size", "text_crc32", "shard", "slot"]

    # whole groups, shard by shard
    tied = zip_index(labelled.filter("shard IS NOT NULL").drop("linked"), [F.col("shard"), F.col("grp"), F.col("doc_id")], "_i")
    used = [quota[s] - filled[s] - spare[s] for s in range(shards)]
    starts = [sum(used[:s]) - filled[s] for s in range(shards)]
    tied = tied.withColumn("slot", F.col("_i") - _pick(starts, F.col("shard")))
    filled = [filled[s] + used[s] for s in range(shards)]

    # groups that no shard could hold, the large ones first
    parts = labelled.filter("linked AND shard IS NULL").select("doc_id", "size", "text_crc32", "grp")
    parts = zip_index(parts, [~F.col("grp").isin(divided), F.col("grp"), F.col("doc_id")], "_i")
    spans += [(i, s, filled[s] + at, n) for i, s, at, n in _fill(n_divided, parts.count(), spare)]
    shard, slot = F.lit(None).cast("int"), F.lit(None).cast("long")
    for i, s, at, n in spans:
        here = (F.col("_i") >= i) & (F.col("_i") < i + n)
        shard, slot = F.when(here, F.lit(s)).otherwise(shard), F.when(here, F.col("_i") - F.lit(i) + F.lit(at)).otherwise(slot)
        spare[s] -= n if i >= n_divided else 0
    parts = parts.withColumn("shard", shard).withColumn("slot", slot)
    left = spare

    free = labelled.filter("NOT linked").drop("linked", "shard")
    free = zip_index(free, [F.col("size").desc(), F.col("grp"), F.col("doc_id")], "_i")
    shard, turn = _deal(F.col("_i"), left)
    free = free.withColumn("shard", shard).withColumn("slot", turn + _pick([quota[s] - left[s] for s in range(shards)], F.col("shard")))
    return tied.select(out).unionByName(parts.select(out)).unionByName(free.select(out))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    dealt = assign(table(spark, sf_dir, "documents"))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int"), "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
