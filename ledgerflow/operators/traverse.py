"""Walking the graph upstream, level by level for all start points at once.

A level is one join and one aggregation, so the frontier never holds more than one row for each start and node,
however many paths lead there. Loops have a fixed number of levels; every few levels the lineage is cut.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.normalize import conduit_name, part_of
from ledgerflow.operators import blocks
from ledgerflow.schemas import FOLLOWED, PART, TERMINAL_ORGS
from ledgerflow.sources.store import checkpointed


def pair_weights(transferred: DataFrame, committees: DataFrame) -> DataFrame:
    """src, dst, w (parallel edges summed) with the source's type and receipts."""
    w = transferred.groupBy("src", "dst").agg(F.sum("total_amount").cast(PART).alias("w"))
    src = committees.select(F.col("CMTE_ID").alias("src"), F.col("terminal_type").alias("src_type"), F.col("total_receipts").cast("double").alias("src_receipts"))
    return w.join(src, "src")


def direct_committees(affiliated: DataFrame, committees: DataFrame) -> DataFrame:
    """cand_id, cmte_id: a candidate's campaign committees (H, S, P), or all that are linked where there are none."""
    linked = affiliated.select("cand_id", "cmte_id").distinct()
    typed = linked.join(committees.select(F.col("CMTE_ID").alias("cmte_id"), "CMTE_TP"), "cmte_id")
    campaign = F.coalesce(F.col("CMTE_TP").isin("H", "S", "P"), F.lit(False))
    some = F.max(campaign).over(Window.partitionBy("cand_id"))
    return typed.withColumn("c", campaign).withColumn("s", some).filter("c OR NOT s").select("cand_id", "cmte_id")


def donor_inflow(contributed: DataFrame, donors: DataFrame, dark_money: bool = True) -> DataFrame:
    """cmte_id, donor_key, kind, w: gifts whose donor's name is not that of a pass-along platform. Organisations count as
    dark money, or (dark_money=False) as individuals like all others."""
    kept = donors.filter(~conduit_name(F.col("canonical_name")))
    kind = F.when((F.col("donor_type") == "organization") & F.lit(dark_money), "dark_money").otherwise("individual")
    w = contributed.groupBy("cmte_id", "donor_key").agg(F.sum("total_amount").cast(PART).alias("w"))
    return w.join(kept.select("donor_key", kind.alias("kind")), "donor_key")


def upstream(
    starts: DataFrame, weights: DataFrame, inflow: DataFrame, levels: int = 5, least: float = 1e-4, dust: float = 0.01,
    mode: str = "sum", cap_ratio: bool = False,
) -> DataFrame:
    """start, kind, entity, amount: proportional attribution of all money upstream of each start's committees.

    A passthrough committee hands on its own inflow at amount / receipts. mode='sum' counts every walk;
    mode='first_visit' lets a node and an edge count once, for the parent with the largest share (ties by key).
    """
    # every level reads these, so they are made once: rows for pairs of committees and for gifts, and the frontier itself
    weights, inflow = checkpointed(weights), checkpointed(inflow)
    front = checkpointed(starts.select("start", "cmte_id").distinct().withColumn("m", F.lit(1.0)))
    visited = front.select("start", "cmte_id")
    found = []
    ratio = F.col("w").cast("double") / F.col("src_receipts")
    ratio = F.least(ratio, F.lit(1.0)) if cap_ratio else ratio
    for level in range(levels):
        found.append(front.join(inflow, "cmte_id").select("start", "kind", F.col("donor_key").alias("entity"), part_of(F.col("w"), F.col("m")).alias("a")))
        step = front.join(weights, F.col("cmte_id") == F.col("dst"))
        ends = step.filter(F.col("src_type").isin(TERMINAL_ORGS))
        found.append(ends.select("start", F.col("src_type").alias("kind"), F.col("src").alias("entity"), part_of(F.col("w"), F.col("m")).alias("a")))
        if level == levels - 1:
            break
        follow = step.filter(F.col("src_type").isin(FOLLOWED) & (F.col("src_receipts") > 0))
        follow = follow.select("start", F.col("src").alias("cmte_id"), F.col("dst").alias("parent"), F.col("m").alias("pm"), (F.col("m") * ratio).alias("m"))
        if mode == "sum":
            front = follow.groupBy("start", "cmte_id").agg(F.sum("m").alias("m"))
        else:
            best = Window.partitionBy("start", "cmte_id").orderBy(F.col("pm").desc(), "parent", F.col("m").desc())
            front = follow.withColumn("rn", F.row_number().over(best)).filter("rn = 1").select("start", "cmte_id", "m")
            front = front.join(visited, ["start", "cmte_id"], "left_anti")
        front = checkpointed(front)
        visited = visited.unionByName(front.select("start", "cmte_id"))
        front = front.filter(F.col("m") >= least)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.groupBy("start", "kind", "entity").agg(F.sum("a").alias("amount")).filter(F.col("amount") > dust)


def upstream_unweighted(starts: DataFrame, transferred: DataFrame, contributed: DataFrame, donors: DataFrame, committees: DataFrame) -> DataFrame:
    """One hop in full, and one more behind passthrough committees in full; amounts multiply with the edges between, by design."""
    named = donors.filter(~conduit_name(F.col("canonical_name"))).select("donor_key", F.col("canonical_name").alias("name"))
    gift = contributed.join(named, "donor_key").select("cmte_id", F.col("donor_key").alias("entity"), F.lit("donor").alias("terminal_type"), "name", F.col("total_amount").alias("amount"))
    types = committees.select(F.col("CMTE_ID").alias("src"), F.col("CMTE_NM").alias("name"), "terminal_type")
    move = transferred.join(types, "src").select(F.col("dst").alias("cmte_id"), F.col("src").alias("entity"), "terminal_type", "name", F.col("total_amount").alias("amount"))
    orgs = F.col("terminal_type").isin(TERMINAL_ORGS)
    one = starts.select("start", "cmte_id").distinct()
    near = one.join(move, "cmte_id")
    # parallel edges to a passthrough committee count once each: their number is all that matters behind it
    behind = near.filter(F.col("terminal_type").isin(FOLLOWED)).groupBy("start", F.col("entity").alias("cmte_id")).agg(F.count("*").alias("times"))
    first = one.join(gift, "cmte_id").unionByName(near.filter(orgs)).withColumn("times", F.lit(1).cast("long"))
    far = gift.groupBy("cmte_id", "entity", "terminal_type", "name").agg(F.sum("amount").alias("amount"), F.count("*").alias("n"))
    far = far.unionByName(move.filter(orgs).groupBy("cmte_id", "entity", "terminal_type", "name").agg(F.sum("amount").alias("amount"), F.count("*").alias("n")))
    second = behind.join(far, "cmte_id").select("start", "entity", "terminal_type", "name", (F.col("amount") * F.col("times")).alias("amount"), (F.col("n") * F.col("times")).alias("paths"))
    first = first.select("start", "entity", "terminal_type", "name", "amount", F.col("times").alias("paths"))
    return first.unionByName(second).groupBy("start", "entity", "terminal_type", "name").agg(F.sum("amount").alias("total_amount"), F.sum("paths").alias("paths"))


def source_ratio(committees: DataFrame, transferred: DataFrame, contributed: DataFrame, donors: DataFrame, steps: int = 9) -> DataFrame:
    """cmte_id, i, o, h: which share of a committee's money comes from persons and from organisations, and how many hops away.

    Terminal organisations are (0, 1, 0); a committee without receipts is (.5, .5, 1). The recursion is read as a
    recurrence from (.5, .5, 1) with a fixed number of steps, which does not depend on any visiting order.
    """
    types = committees.select(F.col("CMTE_ID").alias("cmte_id"), F.col("terminal_type").isin(TERMINAL_ORGS).alias("org"), (F.col("total_receipts") > 0).alias("some"))
    persons = contributed.join(donors.filter(~F.col("donor_type").eqNullSafe("conduit")).select("donor_key"), "donor_key", "left_semi")
    persons = persons.groupBy("cmte_id").agg(F.sum("total_amount").cast("double").alias("own"))
    w = transferred.groupBy("src", "dst").agg(F.sum("total_amount").cast("double").alias("w"))
    base = checkpointed(types.join(persons, "cmte_id", "left").withColumn("own", F.coalesce("own", F.lit(0.0))))
    w = checkpointed(w)
    half = F.lit(0.5)
    state = base.select("cmte_id", F.when(F.col("org"), 0.0).otherwise(half).alias("i"), F.when(F.col("org"), 1.0).otherwise(half).alias("o"), F.when(F.col("org"), 0.0).otherwise(1.0).alias("h"), "org")
    for step in range(steps):
        came = w.join(state.withColumnRenamed("cmte_id", "src"), "src")
        hops = F.when(F.col("org"), 1.0).otherwise(F.col("h") + 1)
        sums = came.groupBy(F.col("dst").alias("cmte_id")).agg(
            F.sum(F.col("w") * F.col("i")).alias("si"), F.sum(F.col("w") * F.col("o")).alias("so"), F.sum(F.col("w") * hops).alias("sh"), F.sum("w").alias("sw")
        )
        joined = base.join(sums, "cmte_id", "left").fillna(0.0, ["si", "so", "sh", "sw"])
        i, o, a = F.col("own") + F.col("si"), F.col("so"), F.col("own") + F.col("sw")
        flat = ~F.col("some") | (i + o <= 0)
        state = joined.select(
            "cmte_id", F.when(F.col("org"), 0.0).when(flat, half).otherwise(i / (i + o)).alias("i"), F.when(F.col("org"), 1.0).when(flat, half).otherwise(o / (i + o)).alias("o"),
            F.when(F.col("org"), 0.0).when(flat, 1.0).otherwise((F.col("own") + F.col("sh")) / a).alias("h"), "org",
        )
        if step % 3 == 2:
            state = checkpointed(state)
    return state.select("cmte_id", "i", "o", "h")


def paths(edges: DataFrame, starts: DataFrame, most: int = 5, least: int = 0) -> DataFrame:
    """origin, target, hops, path (array) of every walk of least..most edges that leaves a start and repeats no vertex.

    starts: origin. The result holds one row for each path, so it grows with the number of starts and with the edges of a
    vertex to the power of the hops; chains() counts walks without listing them.
    """
    edges = checkpointed(edges.select(F.col("src").alias("target"), F.col("dst").alias("nxt")).filter("target <> nxt").distinct())
    front = starts.select("origin", F.col("origin").alias("target"), F.array("origin").alias("path"), F.lit(0).alias("hops"))
    out = front
    for k in range(1, most + 1):
        step = front.join(edges, "target").filter(~F.array_contains("path", F.col("nxt")))
        front = step.select("origin", F.col("nxt").alias("target"), F.concat("path", F.array("nxt")).alias("path"), F.lit(k).alias("hops"))
        out = out.unionByName(front)
    return out.filter(F.col("hops") >= least)


def chains(edges: DataFrame, affiliated: DataFrame, most: int = 5, least: int = 3) -> DataFrame:
    """origin, cand_id, hops, walks: how many walks of so many transfers lead from each committee to a candidate's
    committee. One row for each candidate, committee and level, whatever the number of walks."""
    edges = checkpointed(edges.select("src", F.col("dst").alias("node")).filter("src <> node").distinct())
    front = affiliated.select("cand_id", F.col("cmte_id").alias("node")).distinct().withColumn("walks", F.lit(1).cast("decimal(38,0)"))
    found = None
    for k in range(1, most + 1):
        front = front.join(edges, "node").groupBy("cand_id", F.col("src").alias("node")).agg(F.sum("walks").cast("decimal(38,0)").alias("walks"))
        front = checkpointed(front)
        if k >= least:
            part = front.select(F.col("node").alias("origin"), "cand_id", F.lit(k).cast("long").alias("hops"), "walks")
            found = part if found is None else found.unionByName(part)
    return found


def shortest_hops(edges: DataFrame, most: int | None = 5) -> DataFrame:
    """origin, target, hops: the least number of edges, up to a bound or (None) until no new pair is found, by levels. Up to
    the result a level is one list or bit map for each origin (blocks.py), so the edges behind a pair make no rows."""
    ids, levels = blocks.hop_levels(edges, most)
    pairs = levels.select("origin", F.explode("to").alias("i"), "hops")
    return pairs.join(blocks.small(ids).withColumnRenamed("v", "target"), "i").select("origin", "target", "hops")


def all_gifts(contributed: DataFrame, donors: DataFrame) -> DataFrame:
    """cmte_id, kind, w: the gifts of all donors by the donor's type."""
    given = contributed.join(donors.select("donor_key", "donor_type"), "donor_key")
    return given.groupBy("cmte_id", F.coalesce("donor_type", F.lit("donor")).alias("kind")).agg(F.sum("total_amount").cast(PART).alias("w"))


def inflow_by_kind(weights: DataFrame, gifts: DataFrame, most: int = 3) -> DataFrame:
    """target, kind, hops, amount: what reaches each committee over exactly so many edges, by the kind of the vertex it
    leaves. Every committee hands its inflow on at amount / receipts; all walks count, and none is listed. The factors of a
    target are one list (blocks.py), so the edges behind a pair make no rows."""
    weights = checkpointed(weights)
    came = gifts.unionByName(weights.groupBy(F.col("dst").alias("cmte_id"), F.col("src_type").alias("kind")).agg(F.sum("w").cast(PART).alias("w")))
    came = checkpointed(came.groupBy("cmte_id", "kind").agg(F.sum("w").cast(PART).alias("w")))
    first = came.select(F.col("cmte_id").alias("target"), "kind", F.lit(1).cast("long").alias("hops"), part_of(F.col("w"), F.lit(1.0)).cast("decimal(38,16)").alias("amount"))
    share = F.when(F.col("src_receipts") > 0, F.col("w").cast("double") / F.col("src_receipts"))
    further = blocks.inflow_levels(weights.select("src", "dst", share.alias("share")), came, most)
    return first if further is None else first.unionByName(further)
