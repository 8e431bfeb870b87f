"""The star-schema test tables in the roles of the raw files (deterministic expressions only)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ["lineitem", "orders", "customer", "supplier", "nation"]
CMTE_TP = ["H", "S", "P", "N", "Q", "W", "O", "U", "X", "Y", "V", "D", "N"]
ORG_TP = ["C", "L", "T", "M", "V", "W", ""]
ENTITY = ["COM", "PAC", "PTY", "CCM", "ORG", "IND"]
FACTORS = ["0.01", "0.03", "0.10", "0.30", "1.00"]


@dataclass
class Raw:
    """The raw tables: indiv, cm, cn, ccl, ie (pas2 with a candidate), pas2 and oth (transfers)."""

    indiv: DataFrame
    cm: DataFrame
    cn: DataFrame
    ccl: DataFrame
    ie: DataFrame
    pas2: DataFrame
    oth: DataFrame


def _pick(values: list[str], at) -> object:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (at + 1).cast("int"))


def _id(prefix: str, c: str):
    return F.concat(F.lit(prefix), F.lpad(F.col(c).cast("string"), 8, "0"))


def raw_tables(spark: SparkSession, sf_dir: str) -> Raw:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    year = F.year("o_orderdate")
    orders = read("orders").select("o_orderkey", "o_custkey", (year + year % 2).cast("string").alias("cycle"))
    line = read("lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_returnflag")
    line = line.withColumn("price", F.col("l_extendedprice").cast("decimal(14,2)"))
    customer = read("customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")

    k = F.col("c_custkey")
    name = (
        F.when(k % 7 == 0, F.col("c_name")).when(k % 7 == 1, F.concat("c_name", F.lit(" LLC"))).when(k % 7 == 2, F.concat(F.lit("ACTBLUE "), k.cast("string")))
        .when(k % 7 == 3, F.concat(F.lit("DOE "), k.cast("string"), F.lit(", JANE"))).when(k % 7 == 4, F.concat(F.lit("MR "), "c_name"))
        .when(k % 7 == 5, F.concat(F.lit("SMITH  JOHN "), k.cast("string"))).otherwise(F.concat(F.lit("UNITEMIZED "), k.cast("string")))
    )
    employer = (
        F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 11 == 1, "").when(k % 11 == 2, "RETIRED")
        .when(k % 11 == 3, F.concat("c_mktsegment", F.lit(", INC."))).otherwise(F.col("c_mktsegment"))
    )
    factor = _pick(FACTORS, k % 5).cast("decimal(3,2)")
    joined = line.join(orders, line.l_orderkey == orders.o_orderkey).join(customer, F.col("o_custkey") == k)
    indiv = joined.select(
        "cycle", name.alias("NAME"), employer.alias("EMPLOYER"), _id("C", "l_suppkey").alias("CMTE_ID"),
        (F.col("price") * factor).cast("decimal(18,4)").alias("TRANSACTION_AMT"),
    )

    s = F.col("s_suppkey")
    supplier = read("supplier")
    cm = supplier.select(
        _id("C", "s_suppkey").alias("CMTE_ID"),
        F.when(s % 3 == 0, F.concat("s_name", F.lit(" EMPLOYEES PAC"))).when(s % 3 == 1, F.concat("s_name", F.lit(" CORPORATION"))).otherwise(F.col("s_name")).alias("CMTE_NM"),
        _pick(CMTE_TP, s % 13).alias("CMTE_TP"), _pick(ORG_TP, s % 7).alias("ORG_TP"),
    )
    n = F.col("n_nationkey")
    cn = read("nation").select(
        _id("H", "n_nationkey").alias("CAND_ID"), F.col("n_name").alias("CAND_NAME"),
        _pick(["DEM", "REP", "D", "R", "IND"], F.col("n_regionkey") % 5).alias("CAND_PTY_AFFILIATION"), _pick(["H", "S", "P"], n % 3).alias("CAND_OFFICE"),
    )
    with_order = line.join(orders, line.l_orderkey == orders.o_orderkey)
    served = with_order.select(F.col("l_suppkey").alias("s_suppkey"), "cycle").distinct()
    ccl = served.join(supplier.select("s_suppkey", "s_nationkey"), "s_suppkey").select(
        _id("H", "s_nationkey").alias("CAND_ID"), _id("C", "s_suppkey").alias("CMTE_ID"), "cycle", _pick(CMTE_TP, s % 13).alias("CMTE_TP"),
        _pick(["P", "A", "J", "U"], s % 4).alias("CMTE_DSGN"), (s * 10000 + F.col("cycle").cast("long")).cast("string").alias("LINKAGE_ID"),
    )
    ie = joined.select(
        "cycle", _id("C", "l_suppkey").alias("CMTE_ID"), _id("H", "c_nationkey").alias("CAND_ID"),
        F.when(F.col("l_returnflag") == "A", "24A").when(F.col("l_returnflag") == "R", "24E").otherwise("24K").alias("TRANSACTION_TP"),
        F.col("price").alias("TRANSACTION_AMT"),
    )
    per = with_order.groupBy("l_orderkey", "cycle", "l_suppkey").agg(F.min("l_linenumber").alias("at"), F.sum("price").alias("amt"))
    steps = Window.partitionBy("l_orderkey").orderBy("at", "l_suppkey")
    moves = per.withColumn("prev", F.lag("l_suppkey").over(steps)).filter("prev IS NOT NULL")
    moves = moves.select("l_orderkey", "cycle", _id("C", "prev").alias("giver"), _id("C", "l_suppkey").alias("taker"), _pick(ENTITY, F.col("prev") % 6).alias("ENTITY_TP"), "amt")
    by_taker = F.col("l_orderkey") % 3 == 0
    pas2 = moves.filter(~by_taker).select("cycle", F.col("giver").alias("CMTE_ID"), F.col("taker").alias("OTHER_ID"), "ENTITY_TP", F.col("amt").alias("TRANSACTION_AMT"))
    oth = moves.filter(by_taker).select("cycle", F.col("taker").alias("CMTE_ID"), F.col("giver").alias("OTHER_ID"), "ENTITY_TP", F.col("amt").alias("TRANSACTION_AMT"))
    return Raw(indiv, cm, cn, ccl, ie, pas2, oth)
