"""Vertices and edges from raw rows. Amounts stay decimal, so sums do not depend on their order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.normalize import donor_key, employer_key, employer_or_default
from ledgerflow.schemas import DONOR_THRESHOLD, IE_TYPES, NOT_EMPLOYERS, OTH_ENTITIES, SUM, TRANSFER_ENTITIES


def _sums() -> list:
    return [F.sum("TRANSACTION_AMT").cast(SUM).alias("total_amount"), F.count("*").alias("transaction_count")]


def without_memos(rows: DataFrame) -> DataFrame:
    """Rows whose amounts belong to totals: a memo of X marks one that is reported elsewhere. Off by default."""
    return rows.filter(~F.col("MEMO_CD").eqNullSafe("X"))


def gifts(indiv: DataFrame) -> DataFrame:
    """Usable rows of individual gifts: a name, an amount; employer with its default."""
    usable = indiv.filter("NAME IS NOT NULL AND NAME <> '' AND TRANSACTION_AMT IS NOT NULL")
    return usable.withColumn("emp", employer_or_default(F.col("EMPLOYER")))


def gift_groups(indiv: DataFrame) -> DataFrame:
    """Gifts by (cycle, name, employer, committee): all that donors and their edges need of the raw rows."""
    return gifts(indiv).groupBy("cycle", "NAME", "emp", "CMTE_ID").agg(*_sums())


def donors(indiv: DataFrame, threshold: float = DONOR_THRESHOLD, threshold_on: str = "raw") -> DataFrame:
    return donors_of(gift_groups(indiv), threshold, threshold_on)


def donors_of(groups: DataFrame, threshold: float = DONOR_THRESHOLD, threshold_on: str = "raw") -> DataFrame:
    """donor_key, canonical_name, canonical_employer, total_amount, transaction_count, cycles.

    The threshold holds for the raw (name, employer) of a cycle, as the data's publisher counts; with
    threshold_on='normalized' for the normalised donor of a cycle.
    """
    raw = groups.groupBy("cycle", "NAME", "emp").agg(F.sum("total_amount").cast(SUM).alias("total_amount"), F.sum("transaction_count").alias("transaction_count"))
    keyed = raw.withColumn("donor_key", donor_key(F.col("NAME"), F.col("emp")))
    if threshold_on == "raw":
        keyed = keyed.filter(F.col("total_amount") >= threshold)
    else:
        whole = keyed.groupBy("cycle", "donor_key").agg(F.sum("total_amount").alias("t")).filter(F.col("t") >= threshold)
        keyed = keyed.join(whole.select("cycle", "donor_key"), ["cycle", "donor_key"], "left_semi")
    return keyed.groupBy("donor_key").agg(
        F.min("NAME").alias("canonical_name"), F.min("emp").alias("canonical_employer"), F.sum("total_amount").cast(SUM).alias("total_amount"),
        F.sum("transaction_count").alias("transaction_count"), F.array_sort(F.collect_set("cycle")).alias("cycles"),
    )


def employers(donors_: DataFrame) -> DataFrame:
    real = donors_.filter((F.col("canonical_employer") != "") & ~F.col("canonical_employer").isin(NOT_EMPLOYERS))
    return real.withColumn("employer_key", employer_key(F.col("canonical_employer"))).groupBy("employer_key").agg(
        F.min("canonical_employer").alias("name"), F.sum("total_amount").cast(SUM).alias("total_from_employees"),
        F.count("*").alias("employee_donor_count"), F.sum("transaction_count").alias("total_transactions"),
    )


def employed_by(donors_: DataFrame, employers_: DataFrame) -> DataFrame:
    real = donors_.filter((F.col("canonical_employer") != "") & ~F.col("canonical_employer").isin(NOT_EMPLOYERS))
    keyed = real.select("donor_key", employer_key(F.col("canonical_employer")).alias("employer_key"))
    return keyed.join(employers_.select("employer_key"), "employer_key", "left_semi")


def _keyed_groups(groups: DataFrame) -> DataFrame:
    known = groups.filter("CMTE_ID IS NOT NULL AND total_amount > 0")
    return known.withColumn("donor_key", donor_key(F.col("NAME"), F.col("emp")))


def contributed_to(indiv: DataFrame, donors_: DataFrame, committees: DataFrame) -> DataFrame:
    return contributed_of(gift_groups(indiv), donors_, committees)


def contributed_of(groups: DataFrame, donors_: DataFrame, committees: DataFrame) -> DataFrame:
    """donor -> committee by cycle; variants of one donor are summed, so no money is lost between them."""
    known = _keyed_groups(groups).join(donors_.select("donor_key"), "donor_key", "left_semi")
    known = known.join(committees.select("CMTE_ID"), "CMTE_ID", "left_semi")
    return known.groupBy("donor_key", F.col("CMTE_ID").alias("cmte_id"), "cycle").agg(
        F.sum("total_amount").cast(SUM).alias("total_amount"), F.sum("transaction_count").alias("transaction_count")
    )


def skipped_contributions(groups: DataFrame, donors_: DataFrame) -> DataFrame:
    """What the donor threshold leaves out, by cycle."""
    gone = _keyed_groups(groups).join(donors_.select("donor_key"), "donor_key", "left_anti")
    return gone.groupBy("cycle").agg(F.count("*").alias("n_edges"), F.sum("total_amount").cast(SUM).alias("total_amount"))


def transferred_to(pas2: DataFrame, oth: DataFrame, committees: DataFrame, dedupe_sources: bool = False) -> DataFrame:
    """src -> dst by cycle and source. Givers report in pas2, takers in oth; where both report, dedupe_sources keeps the larger."""
    given = pas2.filter(F.col("ENTITY_TP").isin(TRANSFER_ENTITIES)).select("cycle", F.col("CMTE_ID").alias("src"), F.col("OTHER_ID").alias("dst"), "TRANSACTION_AMT", F.lit("pas2").alias("source"))
    taken = oth.filter(F.col("ENTITY_TP").isin(OTH_ENTITIES)).select("cycle", F.col("OTHER_ID").alias("src"), F.col("CMTE_ID").alias("dst"), "TRANSACTION_AMT", F.lit("oth").alias("source"))
    rows = given.unionByName(taken).filter("src IS NOT NULL AND dst IS NOT NULL AND src <> dst AND TRANSACTION_AMT IS NOT NULL")
    edges = rows.groupBy("src", "dst", "cycle", "source").agg(*_sums()).filter("total_amount > 0")
    known = committees.select("CMTE_ID")
    edges = edges.join(known.withColumnRenamed("CMTE_ID", "src"), "src", "left_semi").join(known.withColumnRenamed("CMTE_ID", "dst"), "dst", "left_semi")
    if dedupe_sources:
        best = F.max(F.struct("total_amount", "transaction_count", "source")).alias("b")
        edges = edges.groupBy("src", "dst", "cycle").agg(best).select("src", "dst", "cycle", "b.source", "b.total_amount", "b.transaction_count")
    return edges.select("src", "dst", "cycle", "source", "total_amount", "transaction_count")


def affiliated_with(ccl: DataFrame, committees: DataFrame, candidates: DataFrame) -> DataFrame:
    """committee -> candidate by cycle; of several linkages the one with the greatest id."""
    last = F.max(F.struct("LINKAGE_ID", "CMTE_DSGN", "CMTE_TP")).alias("b")
    edges = ccl.groupBy(F.col("CMTE_ID").alias("cmte_id"), F.col("CAND_ID").alias("cand_id"), "cycle").agg(last)
    edges = edges.join(committees.select(F.col("CMTE_ID").alias("cmte_id")), "cmte_id", "left_semi")
    edges = edges.join(candidates.select(F.col("CAND_ID").alias("cand_id")), "cand_id", "left_semi")
    return edges.select("cmte_id", "cand_id", "cycle", F.col("b.LINKAGE_ID").alias("linkage_id"), F.col("b.CMTE_DSGN").alias("cmte_designation"), F.col("b.CMTE_TP").alias("cmte_type"))


def spent_on(pas2: DataFrame, committees: DataFrame, candidates: DataFrame) -> DataFrame:
    """committee -> candidate by cycle, for (S) or against (O)."""
    side = F.when(F.col("TRANSACTION_TP") == "24E", IE_TYPES["24E"]).when(F.col("TRANSACTION_TP") == "24A", IE_TYPES["24A"])
    rows = pas2.withColumn("support_oppose", side).filter("support_oppose IS NOT NULL AND TRANSACTION_AMT IS NOT NULL")
    edges = rows.groupBy(F.col("CMTE_ID").alias("cmte_id"), F.col("CAND_ID").alias("cand_id"), "support_oppose", "cycle").agg(*_sums()).filter("total_amount > 0")
    edges = edges.join(committees.select(F.col("CMTE_ID").alias("cmte_id")), "cmte_id", "left_semi")
    return edges.join(candidates.select(F.col("CAND_ID").alias("cand_id")), "cand_id", "left_semi")
