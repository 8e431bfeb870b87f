"""Classifications and money totals on vertices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions import classify
from ledgerflow.schemas import SUM


def classified_committees(committees: DataFrame) -> DataFrame:
    return committees.withColumn("terminal_type", classify.terminal_type(F.col("CMTE_TP"), F.col("ORG_TP")))


def largest(committees: DataFrame, n: int = 5) -> DataFrame:
    """The committees with the largest receipts of all."""
    return committees.orderBy(F.desc("total_receipts"), "CMTE_ID").limit(n)


def classified_donors(donors: DataFrame) -> DataFrame:
    """The occupation counts where the donors carry one."""
    occupation = F.col("occupation") if "occupation" in donors.columns else None
    kind = classify.donor_type(F.col("canonical_name"), F.col("canonical_employer"), occupation)
    return donors.withColumn("donor_type", kind).withColumn("whale_tier", classify.whale_tier(F.col("total_amount")))


def financials(committees: DataFrame, contributed: DataFrame, transferred: DataFrame) -> DataFrame:
    """Receipts (gifts and transfers in) and disbursements (transfers out) of every committee, all cycles together.

    The three sums are one aggregation over tagged rows, then one join to the committees.
    """
    zero = F.lit(0).cast(SUM)
    flows = contributed.select(F.col("cmte_id").alias("CMTE_ID"), F.col("total_amount").alias("i"), zero.alias("o"))
    flows = flows.unionByName(transferred.select(F.col("dst").alias("CMTE_ID"), F.col("total_amount").alias("i"), zero.alias("o")))
    flows = flows.unionByName(transferred.select(F.col("src").alias("CMTE_ID"), zero.alias("i"), F.col("total_amount").alias("o")))
    sums = flows.groupBy("CMTE_ID").agg(F.sum("i").cast(SUM).alias("total_receipts"), F.sum("o").cast(SUM).alias("total_disbursed"))
    joined = committees.join(sums, "CMTE_ID", "left")
    return joined.withColumn("total_receipts", F.coalesce("total_receipts", zero)).withColumn("total_disbursed", F.coalesce("total_disbursed", zero))


def financial_stats(committees: DataFrame) -> DataFrame:
    r, d = F.col("total_receipts") > 0, F.col("total_disbursed") > 0
    return committees.agg(
        F.count("*").alias("committees"), F.count_if(r).alias("with_receipts"), F.count_if(d).alias("with_disbursed"), F.count_if(r & d).alias("with_both")
    )
