"""Per-entity summaries: totals, breakdowns and top lists, each one set-based pass for all entities."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions import classify
from ledgerflow.functions.normalize import percent
from ledgerflow.schemas import RECEIPTS_THRESHOLD, SUM


def top_n(df: DataFrame, by: str, amount: str, tie: str, n: int = 10) -> DataFrame:
    """The n largest rows of each entity, with their rank."""
    best = Window.partitionBy(by).orderBy(F.col(amount).desc(), F.col(tie).asc())
    return df.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)


def with_remainder(df: DataFrame, by: str, amount: str, tie: str, n: int = 10) -> DataFrame:
    """Top lists with the number and sum of what is not shown."""
    best = Window.partitionBy(by).orderBy(F.col(amount).desc(), F.col(tie).asc())
    ranked = df.withColumn("rank", F.row_number().over(best))
    rest = F.col("rank") > n
    return ranked.groupBy(by).agg(F.count_if(rest).alias("more"), F.coalesce(F.sum(F.when(rest, F.col(amount))), F.lit(0)).cast(SUM).alias("more_amount"))


def not_conduits(donors: DataFrame) -> DataFrame:
    """Donors without a type count as persons."""
    return donors.filter(~F.col("donor_type").eqNullSafe("conduit"))


def top_donors(contributed: DataFrame, donors: DataFrame, n: int = 10) -> DataFrame:
    """The largest donors of each committee that are not conduits."""
    named = not_conduits(donors).select("donor_key", "canonical_name", "donor_type", "whale_tier")
    sums = contributed.groupBy("cmte_id", "donor_key").agg(F.sum("total_amount").cast(SUM).alias("amount"))
    return top_n(sums.join(named, "donor_key"), "cmte_id", "amount", "donor_key", n)


def top_sources(transferred: DataFrame, committees: DataFrame, n: int = 10) -> DataFrame:
    sums = transferred.groupBy("dst", "src").agg(F.sum("total_amount").cast(SUM).alias("amount"))
    return top_n(sums, "dst", "amount", "src", n).join(committees.select(F.col("CMTE_ID").alias("src"), "CMTE_NM", "terminal_type"), "src")


def top_recipients(transferred: DataFrame, committees: DataFrame, n: int = 10) -> DataFrame:
    sums = transferred.groupBy("src", "dst").agg(F.sum("total_amount").cast(SUM).alias("amount"))
    return top_n(sums, "src", "amount", "dst", n).join(committees.select(F.col("CMTE_ID").alias("dst"), "CMTE_NM", "terminal_type"), "dst")


def donor_top_committees(contributed: DataFrame, committees: DataFrame, n: int = 10) -> DataFrame:
    sums = contributed.groupBy("donor_key", "cmte_id").agg(F.sum("total_amount").cast(SUM).alias("amount"))
    return top_n(sums, "donor_key", "amount", "cmte_id", n).join(committees.select(F.col("CMTE_ID").alias("cmte_id"), "CMTE_NM", "terminal_type"), "cmte_id")


def candidate_top_donors(starts: DataFrame, contributed: DataFrame, donors: DataFrame, n: int = 10) -> DataFrame:
    """The largest donors of all of a candidate's committees that are not conduits."""
    named = not_conduits(donors).select("donor_key", "canonical_name", "donor_type", "whale_tier")
    sums = starts.join(contributed, "cmte_id").groupBy("start", "donor_key").agg(F.sum("total_amount").cast(SUM).alias("amount"))
    return top_n(sums.join(named, "donor_key"), "start", "amount", "donor_key", n)


def candidate_top_committees(starts: DataFrame, transferred: DataFrame, committees: DataFrame, n: int = 10) -> DataFrame:
    """The committees that moved most into all of a candidate's committees."""
    sums = starts.join(transferred, F.col("cmte_id") == F.col("dst")).groupBy("start", "src").agg(F.sum("total_amount").cast(SUM).alias("amount"))
    return top_n(sums, "start", "amount", "src", n).join(committees.select(F.col("CMTE_ID").alias("src"), "CMTE_NM", "terminal_type"), "src")


def candidate_whale_counts(starts: DataFrame, contributed: DataFrame, donors: DataFrame) -> DataFrame:
    """Gifts and distinct donors of each tier by candidate."""
    tiered = starts.join(contributed, "cmte_id").join(donors.filter("whale_tier IS NOT NULL").select("donor_key", "whale_tier"), "donor_key")
    return tiered.groupBy("start", "whale_tier").agg(F.count("*").alias("n_edges"), F.countDistinct("donor_key").alias("n_donors"))


def by_cycle(flows: dict[str, DataFrame], entity: str, cycles: list[str]) -> DataFrame:
    """entity x cycle with the sum and the number of edges of each flow, zeros where nothing happened.

    flows: name -> edges with the entity's column. The cycles are a parameter; money of any other cycle stands under the
    cycle 'other', which is there only where an entity has some, so none vanishes.
    """
    zero, known = F.lit(0).cast(SUM), F.col("cycle").isin(cycles)
    tagged = None
    for name, edges in flows.items():
        cols = [F.when(F.lit(n == name), F.col("total_amount")).alias(n) for n in flows]
        one = edges.select(entity, F.when(known, F.col("cycle")).otherwise("other").alias("cycle"), *cols)
        tagged = one if tagged is None else tagged.unionByName(one)
    aggs = [x for n in flows for x in (F.sum(n).cast(SUM).alias(n), F.count(n).alias(f"{n}_count"))]
    sums = tagged.groupBy(entity, "cycle").agg(*aggs)
    grid = sums.select(entity).distinct().withColumn("cycle", F.explode(F.array(*[F.lit(c) for c in cycles])))
    full = grid.join(sums.filter("cycle <> 'other'"), [entity, "cycle"], "left").unionByName(sums.filter("cycle = 'other'"))
    return full.select(entity, "cycle", *[x for n in flows for x in (F.coalesce(n, zero).alias(n), F.coalesce(f"{n}_count", F.lit(0)).alias(f"{n}_count"))])


def whale_counts(contributed: DataFrame, donors: DataFrame) -> DataFrame:
    """Gifts and distinct donors of each tier by committee."""
    tiered = contributed.join(donors.filter("whale_tier IS NOT NULL").select("donor_key", "whale_tier"), "donor_key")
    return tiered.groupBy("cmte_id", "whale_tier").agg(F.count("*").alias("n_edges"), F.countDistinct("donor_key").alias("n_donors"))


def gifts_to_candidates(contributed: DataFrame, affiliated: DataFrame, compat_fanout: bool = False) -> DataFrame:
    """donor -> candidate through its committees; a committee counts once however many cycles link it (compat_fanout: once each)."""
    links = affiliated.select("cmte_id", "cand_id")
    links = links if compat_fanout else links.distinct()
    return contributed.join(links, "cmte_id")


def donor_lean(contributed: DataFrame, affiliated: DataFrame, candidates: DataFrame, compat_fanout: bool = False) -> DataFrame:
    """donor_key, dem, rep, other, their percentages, lean: gifts by the party of the candidates behind the committees."""
    parties = candidates.filter("CAND_PTY_AFFILIATION IS NOT NULL").select(F.col("CAND_ID").alias("cand_id"), F.col("CAND_PTY_AFFILIATION").alias("party"))
    given = gifts_to_candidates(contributed, affiliated, compat_fanout).join(parties, "cand_id")
    part = lambda *p: F.coalesce(F.sum(F.when(F.col("party").isin(*p), F.col("total_amount"))), F.lit(0)).cast(SUM)
    sums = given.groupBy("donor_key").agg(part("DEM", "D").alias("dem"), part("REP", "R").alias("rep"), F.sum("total_amount").cast(SUM).alias("total"))
    sums = sums.withColumn("other", (F.col("total") - F.col("dem") - F.col("rep")).cast(SUM))
    pct = [percent(F.col(p), F.col("total")).alias(f"{p}_pct") for p in ("dem", "rep", "other")]
    return sums.select("donor_key", "dem", "rep", "other", *pct, classify.lean(F.col("dem"), F.col("rep"), F.col("total")).alias("lean"))


def donor_top_candidates(contributed: DataFrame, affiliated: DataFrame, candidates: DataFrame, n: int = 10) -> DataFrame:
    sums = gifts_to_candidates(contributed, affiliated).groupBy("donor_key", "cand_id").agg(F.sum("total_amount").cast(SUM).alias("amount"))
    return top_n(sums, "donor_key", "amount", "cand_id", n).join(candidates.select(F.col("CAND_ID").alias("cand_id"), "CAND_NAME"), "cand_id")


def committee_summary(committees: DataFrame, contributed: DataFrame, transferred: DataFrame, threshold: float = RECEIPTS_THRESHOLD) -> DataFrame:
    """Gifts and transfers among one-hop receipts, in total and per cent of their sum, for committees of some size.

    Gifts through conduits count here; only the top lists leave conduits out.
    """
    large = committees.filter(F.col("total_receipts") >= threshold).select("CMTE_ID", "terminal_type", "total_receipts", "total_disbursed")
    given = contributed.groupBy(F.col("cmte_id").alias("CMTE_ID")).agg(F.sum("total_amount").cast(SUM).alias("individual_total"), F.countDistinct("donor_key").alias("n_donors"))
    moved = transferred.groupBy(F.col("dst").alias("CMTE_ID")).agg(F.sum("total_amount").cast(SUM).alias("committee_total"), F.countDistinct("src").alias("n_sources"))
    zero = F.lit(0).cast(SUM)
    joined = large.join(given, "CMTE_ID", "left").join(moved, "CMTE_ID", "left")
    joined = joined.select(
        "CMTE_ID", "terminal_type", "total_receipts", "total_disbursed", F.coalesce("individual_total", zero).alias("individual_total"),
        F.coalesce("committee_total", zero).alias("committee_total"), F.coalesce("n_donors", F.lit(0)).alias("n_donors"), F.coalesce("n_sources", F.lit(0)).alias("n_sources"),
    )
    both = F.col("individual_total") + F.col("committee_total")
    return joined.withColumn("individual_pct", percent(F.col("individual_total"), both)).withColumn("committee_pct", percent(F.col("committee_total"), both))


def donor_summary(donors: DataFrame, contributed: DataFrame, lean: DataFrame, threshold: float) -> DataFrame:
    """Totals, reach and lean of donors of some size that are not conduits."""
    large = not_conduits(donors).filter(F.col("total_amount") >= threshold)
    reach = contributed.groupBy("donor_key").agg(F.countDistinct("cmte_id").alias("committees"), F.countDistinct("cycle").alias("active_cycles"))
    pct = ["dem_pct", "rep_pct", "other_pct"]
    joined = large.select("donor_key", "donor_type", "whale_tier", "total_amount").join(reach, "donor_key", "left").join(lean.select("donor_key", *pct, "lean"), "donor_key", "left")
    zero = F.lit(0)
    return joined.select(
        "donor_key", "donor_type", "whale_tier", "total_amount", F.coalesce("committees", zero).alias("committees"),
        F.least(F.coalesce("committees", zero), F.lit(10)).alias("committee_count"), F.coalesce("active_cycles", zero).alias("active_cycles"),
        *[F.coalesce(p, F.lit(0.0)).alias(p) for p in pct], F.coalesce("lean", F.lit("UNKNOWN")).alias("lean"),
    )


def nested(df: DataFrame, key: str, name: str, *cols: str) -> DataFrame:
    """A list column with one struct for each row of an entity, ordered by the first of the columns."""
    return df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(*cols))).alias(name))


def funding_documents(summary: DataFrame, key: str, lists: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """A summary with its lists nested, one row for each entity: name -> (rows with the entity's key, columns).

    A top list holds ten entries and a breakdown one for each cycle or tier, so an entity's row stays small.
    """
    out = summary
    for name, (rows, cols) in lists.items():
        out = out.join(nested(rows, key, name, *cols), key, "left")
    return out
