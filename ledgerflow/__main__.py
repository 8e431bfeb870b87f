"""Funding of a candidate on the command line.

python -m ledgerflow TABLES --candidate NAME [--cycle 1998] [--depth 5]   five pies (the default)
python -m ledgerflow TABLES --fec ID --summary                            totals
python -m ledgerflow TABLES --list-members [--members FILE]               members and their ids
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.normalize import format_money
from ledgerflow.operators import analysis, traverse
from ledgerflow.plans import queries
from ledgerflow.plans.graph import Graph
from ledgerflow.sources.members import read_members


def _money(spark: SparkSession, amount) -> str:
    return spark.range(1).select(format_money(F.lit(float(amount or 0)))).first()[0]


def _pie(spark: SparkSession, title: str, rows: DataFrame, limit: int = 10) -> float:
    """Print each kind's total, share and largest sources; the sum of all."""
    kinds = analysis.pie(rows.withColumn("start", F.lit(0)), "start", limit).orderBy(F.desc("total")).collect()
    whole = float(sum(k["total"] for k in kinds))
    print(f"\n{title}: {_money(spark, whole)}")
    for k in kinds:
        print(f"  {k['kind']}: {_money(spark, k['total'])} ({k['pct']} %)")
        for source in k["top"]:
            print(f"    {source['entity'][:50]:<52}{_money(spark, source['amount']):>12}")
        if k["sources"] > limit:
            print(f"    ... and {k['sources'] - limit} more")
    return whole


def pies(spark: SparkSession, g: Graph, found, depth: int) -> None:
    starts = _starts(g.starts, g, found)
    weights = traverse.pair_weights(g.transferred, g.committees)
    names = g.donors.select(F.col("donor_key").alias("entity"), F.col("canonical_name").alias("n")).unionByName(g.raw.cm.select(F.col("CMTE_ID").alias("entity"), F.col("CMTE_NM").alias("n")))
    traced = traverse.upstream(starts, weights, traverse.donor_inflow(g.contributed, g.donors), levels=depth)
    direct = _pie(spark, "PIES 1 AND 2: SOURCES", traced.join(names, "entity").select("kind", F.col("n").alias("entity"), "amount"))
    sides = {}
    for number, side, title in ((3, "S", "SUPPORT"), (4, "O", "OPPOSITION")):
        ie = analysis.ie_funding(g.spent.filter(F.col("cand_id").isin(found["candidate_ids"])), side, g.committees, g.transferred, g.contributed, g.donors)
        sides[side] = _pie(spark, f"PIE {number}: INDEPENDENT SPENDING, {title}", ie.select("kind", F.col("label").alias("entity"), "amount"))
    firms = analysis.corporate_influence(starts, g.typed, g.transferred, g.contributed, g.donors).groupBy("company").agg(*[F.sum(c).alias(c) for c in ("pac", "employees", "total")])
    print("\nPIE 5: CORPORATE INFLUENCE")
    for r in firms.orderBy(F.desc("total"), "company").limit(20).collect():
        print(f"  {r['company'][:40]:<42} committees {_money(spark, r['pac']):>10}  employees {_money(spark, r['employees']):>10}")
    print(f"\nFOR: {_money(spark, direct + sides['S'])}   AGAINST: {_money(spark, sides['O'])}")


def totals(spark: SparkSession, g: Graph, found) -> None:
    rows = analysis.funding_totals(_starts(g.all_starts, g, found), g.contributed, g.transferred, g.spent.filter(F.col("cand_id").isin(found["candidate_ids"])))
    sums = rows.agg(*[F.sum(c).alias(c) for c in ("pro", "direct", "pac", "ie_support", "ie_oppose")]).first()
    for name in ("pro", "direct", "pac", "ie_support", "ie_oppose"):
        print(f"{name:<12}{_money(spark, sums[name]):>12}")


def _starts(starts: DataFrame, g: Graph, found) -> DataFrame:
    own = starts.filter(F.col("start").isin(found["candidate_ids"]))
    first = F.lit(found["candidate_ids"][0] if found["candidate_ids"] else "")
    known = g.raw.cm.filter(F.col("CMTE_ID").isin(found["committee_ids"])).select(first.alias("start"), F.col("CMTE_ID").alias("cmte_id"))
    return own.select(first.alias("start"), "cmte_id").unionByName(known).distinct()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    p = argparse.ArgumentParser(prog="ledgerflow", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("tables")
    p.add_argument("--candidate")
    p.add_argument("--fec")
    p.add_argument("--bioguide")
    p.add_argument("--members", help="the members' file, JSON or YAML")
    p.add_argument("--cycle")
    p.add_argument("--depth", type=int, default=5)
    p.add_argument("--pies", action="store_true")
    p.add_argument("--summary", action="store_true")
    p.add_argument("--list-members", action="store_true")
    a = p.parse_args(argv)
    spark = spark or SparkSession.builder.appName("ledgerflow").getOrCreate()
    g = Graph.of(spark, a.tables)
    raw = read_members(spark, a.members) if a.members else queries.members_table(g)
    members = analysis.member_mapping(raw, g.raw.cn, g.raw.ccl)
    if a.list_members:
        for r in analysis.list_members(members).collect():
            print(f"{r['bioguide']:<12}{r['first']} {r['last']} ({r['party']}-{r['state']}) {', '.join(r['candidate_ids'])}")
        return 0
    if not (a.candidate or a.fec or a.bioguide):
        p.error("one of --candidate, --fec and --bioguide is needed")
    found = analysis.resolve_candidate(g.raw.cn, name=a.candidate, fec_id=a.fec, members=members, bioguide=a.bioguide).first()
    if found is None:
        print("no such candidate", file=sys.stderr)
        return 1
    print(f"{found['name']}: {', '.join(found['candidate_ids'])}")
    g = g.only(a.cycle) if a.cycle else g
    if a.summary:
        totals(spark, g, found)
    if a.pies or not a.summary:
        pies(spark, g, found, a.depth)
    return 0


if __name__ == "__main__":
    sys.exit(main())
