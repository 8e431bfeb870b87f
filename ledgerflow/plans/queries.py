"""The engine's queries over the test tables; money leaves as double."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions import classify, normalize
from ledgerflow.operators import analysis, build, enrich, summaries, traverse
from ledgerflow.plans.graph import Graph
from ledgerflow.schemas import DONOR_SUMMARY_THRESHOLD, FIELDS, raw_schema
from ledgerflow.sources import fec, store
from ledgerflow.sources.store import stage_path
from ledgerflow.streaming import events

CYCLES = ["1996", "1998", "2000", "2002"]
#: The cycle of the queries over one.
CYCLE = "1998"


def _out(df: DataFrame) -> DataFrame:
    """Decimals as double, key lists as text, so that the result compares by value everywhere."""
    cols = []
    for name, kind in df.dtypes:
        c = F.col(name)
        cols.append(c.cast("double").alias(name) if kind.startswith("decimal") else F.array_join(c, ",").alias(name) if kind == "array<string>" else c)
    return df.select(*cols)


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    """To two places. The sums are decimals, so halves round alike everywhere."""
    return df.withColumns({n: F.round(F.col(n), 2) for n in names})


def _upstream(g: Graph, dark_money: bool = True, **how) -> DataFrame:
    weights = traverse.pair_weights(g.transferred, g.committees)
    return traverse.upstream(g.starts, weights, traverse.donor_inflow(g.contributed, g.donors, dark_money), **how)


def _unweighted(g: Graph) -> DataFrame:
    return traverse.upstream_unweighted(g.all_starts, g.transferred, g.contributed, g.donors, g.typed)


def donor_keys(g: Graph) -> DataFrame:
    names = g.raw.indiv.select("NAME", "EMPLOYER").distinct()
    emp = normalize.employer_or_default(F.col("EMPLOYER"))
    return names.select(
        "NAME", "EMPLOYER", normalize.normalize_name(F.col("NAME")).alias("norm_name"), normalize.normalize_employer(emp).alias("norm_employer"),
        normalize.donor_key(F.col("NAME"), emp).alias("donor_key"), normalize.conduit_name(F.col("NAME")).alias("conduit_name"),
    )


def committee_flags(g: Graph) -> DataFrame:
    tp = F.col("CMTE_TP")
    return g.raw.cm.select("CMTE_ID", classify.is_super_pac(tp).alias("is_super_pac"), classify.is_campaign(tp).alias("is_campaign"), normalize.extract_company(F.col("CMTE_NM")).alias("company"))


def candidate_names(g: Graph) -> DataFrame:
    return g.raw.cn.select("CAND_ID", "CAND_NAME", classify.office_name(F.col("CAND_OFFICE")).alias("office"), classify.party_name(F.col("CAND_PTY_AFFILIATION")).alias("party"))


def linkage_flags(g: Graph) -> DataFrame:
    d = F.col("cmte_designation")
    return g.affiliated.groupBy("cand_id").agg(F.count_if(classify.is_principal_committee(d)).alias("principal"), F.count_if(classify.is_authorized(d)).alias("authorized"), F.count("*").alias("links"))


def donor_type_counts(g: Graph) -> DataFrame:
    return g.donors.groupBy("donor_type", "whale_tier").agg(F.count("*").alias("n"))


def donor_paths(g: Graph) -> DataFrame:
    """Every path from the donor with the largest total to a candidate, over two transfers at most."""
    donor = g.donors.orderBy(F.desc("total_amount"), "donor_key").limit(1).select("donor_key")
    first = g.contributed.join(donor, "donor_key", "left_semi").select("donor_key", F.col("cmte_id").alias("origin")).distinct()
    walks = traverse.paths(g.transferred, first.select("origin"), 2).join(first, "origin")
    ends = g.affiliated.select(F.col("cmte_id").alias("target"), "cand_id").distinct()
    return walks.join(ends, "target").select("donor_key", "cand_id", F.array_join("path", ">").alias("path"), (F.col("hops") + 2).cast("long").alias("hops"))


def employer_influence(g: Graph) -> DataFrame:
    """employer -> employee -> committee -> candidate, by employer and candidate."""
    jobs = g.employed.join(g.employers.select("employer_key", "name"), "employer_key")
    given = summaries.gifts_to_candidates(g.contributed, g.affiliated).join(jobs, "donor_key")
    return given.groupBy("name", "cand_id").agg(F.sum("total_amount").alias("amount"), F.countDistinct("donor_key").alias("donors"))


def committee_inflow(g: Graph) -> DataFrame:
    """The money that reaches a committee over every edge in three hops and fewer, by the kind of its source and the hops."""
    weights = traverse.pair_weights(g.transferred, g.committees)
    return _rounded(traverse.inflow_by_kind(weights, traverse.all_gifts(g.contributed, g.donors)), "amount")


def shortest_hops(g: Graph) -> DataFrame:
    """Pairs of committees over every transfer, without a bound."""
    return traverse.shortest_hops(g.transferred, None).withColumn("hops", F.col("hops").cast("long"))


def long_chains(g: Graph) -> DataFrame:
    """How many chains of three to five transfers lead from a committee to a candidate, over every transfer."""
    return traverse.chains(g.transferred, g.affiliated)


def committee_documents(g: Graph) -> DataFrame:
    """Committee summaries with their lists nested, as JSON."""
    by_cycle = summaries.by_cycle({"individual": g.contributed.withColumnRenamed("cmte_id", "CMTE_ID"), "committee": g.transferred.withColumnRenamed("dst", "CMTE_ID")}, "CMTE_ID", CYCLES)
    lists = {
        "funding_by_cycle": (by_cycle, ["cycle", "individual", "individual_count", "committee", "committee_count"]),
        "top_individual_donors": (summaries.top_donors(g.contributed, g.donors).withColumnRenamed("cmte_id", "CMTE_ID"), ["rank", "canonical_name", "amount", "donor_type", "whale_tier"]),
        "top_committee_sources": (summaries.top_sources(g.transferred, g.typed).withColumnRenamed("dst", "CMTE_ID"), ["rank", "src", "CMTE_NM", "amount", "terminal_type"]),
        "top_recipients": (summaries.top_recipients(g.transferred, g.typed).withColumnRenamed("src", "CMTE_ID"), ["rank", "dst", "CMTE_NM", "amount", "terminal_type"]),
        "whale_donor_counts": (summaries.whale_counts(g.contributed, g.donors).withColumnRenamed("cmte_id", "CMTE_ID"), ["whale_tier", "n_edges", "n_donors"]),
    }
    whole = summaries.funding_documents(summaries.committee_summary(g.committees, g.contributed, g.transferred), "CMTE_ID", lists)
    return whole.select("CMTE_ID", *[F.to_json(F.col(n)).alias(n) for n in lists])


def members_table(g: Graph) -> DataFrame:
    """Members of a legislature in the shape of their file, made from candidates: each names its own id and one that no file knows."""
    k = F.substring("CAND_ID", 2, 8).cast("int")
    term = lambda y, kind: F.struct(F.lit(kind).alias("type"), F.lpad((k % 50).cast("string"), 2, "0").alias("state"), F.col("CAND_PTY_AFFILIATION").alias("party"), F.lit(y).alias("start"), (k % 9).alias("district"))
    return g.raw.cn.select(
        F.concat(F.lit("B"), F.substring("CAND_ID", 2, 8)).alias("bioguide"),
        F.struct(F.concat(F.lit("First"), (k % 5).cast("string")).alias("first"), F.concat(F.lit("Last"), k.cast("string")).alias("last")).alias("name"),
        F.when(k % 4 == 3, F.array().cast("array<string>")).otherwise(F.array("CAND_ID", F.lit("S99999999"))).alias("fec"),
        F.array(term("2015", "rep"), F.when(k % 2 == 0, term("2021", "sen")).otherwise(term("2021", "rep"))).alias("terms"),
    )


def member_mapping(g: Graph) -> DataFrame:
    found = analysis.member_mapping(members_table(g), g.raw.cn, g.raw.ccl)
    return found.select("bioguide", F.col("name.last").alias("last"), "candidate_ids", "committee_ids", F.col("congress.chamber").alias("chamber"), F.col("congress.state").alias("state"), F.col("congress.party").alias("party"))


def list_members(g: Graph) -> DataFrame:
    return analysis.list_members(analysis.member_mapping(members_table(g), g.raw.cn, g.raw.ccl))


def member_totals(g: Graph) -> DataFrame:
    """Funding totals where the committees that members' records name are united with the affiliated ones."""
    members = analysis.member_mapping(members_table(g), g.raw.cn, g.raw.ccl)
    return analysis.funding_totals(analysis.with_known(g.all_starts, members), g.contributed, g.transferred, g.spent)


def resolve_member(g: Graph) -> DataFrame:
    members = analysis.member_mapping(members_table(g), g.raw.cn, g.raw.ccl)
    return analysis.resolve_candidate(g.raw.cn, name="first1 last1", members=members)


def committee_merge(g: Graph) -> DataFrame:
    """Committee records of several cycles, the later one's fields over the earlier one's."""
    cycles = g.affiliated.select(F.col("cmte_id").alias("CMTE_ID"), "cycle").distinct()
    rows = g.raw.cm.join(cycles, "CMTE_ID").withColumn("CMTE_NM", F.concat("CMTE_NM", F.lit(" "), "cycle"))
    return fec.latest_fields(rows.select("CMTE_ID", "CMTE_NM", "CMTE_TP", "cycle"), "CMTE_ID")


def _through_files(rows: DataFrame, kind: str) -> DataFrame:
    """Rows written as pipe-delimited files, one folder for each cycle, then read back, typed and deduplicated."""
    spark = rows.sparkSession
    if "SUB_ID" in FIELDS[kind]:
        rows = rows.withColumn("SUB_ID", F.monotonically_increasing_id().cast("string"))
    if "TRANSACTION_AMT" in rows.columns:
        rows = rows.withColumn("TRANSACTION_AMT", F.col("TRANSACTION_AMT").cast("decimal(14,2)"))
    line = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) if c in rows.columns else F.lit("") for c in FIELDS[kind]])
    path = stage_path(spark, f"raw-{kind}")
    rows.select("cycle", line.alias("value")).write.partitionBy("cycle").text(path)
    files = None
    for cycle in sorted(r["cycle"] for r in rows.select("cycle").distinct().collect()):
        one = fec.read_text(spark, kind, f"{path}/cycle={cycle}", cycle)
        files = one if files is None else files.unionByName(one)
    if files is None:
        files = spark.createDataFrame([], raw_schema(kind)).withColumn("cycle", F.lit(""))
    return fec.load(files, kind)


def raw_files(g: Graph) -> DataFrame:
    """From files of gifts to edges."""
    indiv = _through_files(g.raw.indiv, "indiv")
    return build.contributed_to(indiv, build.donors(indiv), g.raw.cm)


def raw_file_transfers(g: Graph) -> DataFrame:
    """From files of committees and transfers, as givers and as takers report them, to edges."""
    cm = _through_files(g.raw.cm.withColumn("cycle", F.lit(CYCLE)), "cm")
    return build.transferred_to(_through_files(g.raw.pas2, "pas2"), _through_files(g.raw.oth, "oth"), cm)


def raw_file_links(g: Graph) -> DataFrame:
    """From files of candidates, committees and linkages to edges."""
    cn, cm = (_through_files(df.withColumn("cycle", F.lit(CYCLE)), kind) for df, kind in ((g.raw.cn, "cn"), (g.raw.cm, "cm")))
    return build.affiliated_with(_through_files(g.raw.ccl, "ccl"), cm, cn)


def raw_file_spending(g: Graph) -> DataFrame:
    """From files of independent spending to edges."""
    return build.spent_on(_through_files(g.raw.ie, "pas2"), g.raw.cm, g.raw.cn)


def restored_spending(g: Graph) -> DataFrame:
    """Independent spending after a dump as gzip JSON and its restore."""
    spark = g.raw.cm.sparkSession
    root = stage_path(spark, "dump")
    store.dump(g.spent, root, "aggregation", "spent_on")
    return store.restore(spark, root, "aggregation", "spent_on")


def merged_committees(g: Graph) -> DataFrame:
    """Two overlapping sets of committees under each import mode that lets keys repeat."""
    k = F.substring("CMTE_ID", 2, 8).cast("int")
    old = g.raw.cm.filter(k % 3 != 0).select("CMTE_ID", "CMTE_NM", "CMTE_TP")
    new = g.raw.cm.filter(k % 3 != 1).select("CMTE_ID", F.upper("CMTE_NM").alias("CMTE_NM"), F.lit(None).cast("string").alias("CMTE_TP"))
    out = None
    for mode in ("ignore", "replace", "update"):
        one = store.merge(old, new, ["CMTE_ID"], mode).select(F.lit(mode).alias("mode"), "CMTE_ID", "CMTE_NM", "CMTE_TP")
        out = one if out is None else out.unionByName(one)
    return out


def _sums(df: DataFrame, *by: str) -> DataFrame:
    return df.groupBy(*by).agg(F.sum("total_amount").alias("total_amount"), F.sum("transaction_count").alias("transaction_count"), F.count("*").alias("edges"))


def _side(g: Graph, side: str) -> DataFrame:
    return _rounded(analysis.ie_funding(g.spent, side, g.committees, g.transferred, g.contributed, g.donors), "amount")


def _corporate(g: Graph) -> DataFrame:
    return _rounded(analysis.corporate_influence(g.starts, g.typed, g.transferred, g.contributed, g.donors), "pac", "employees", "total")


def _stats(g: Graph) -> DataFrame:
    return analysis.graph_stats({
        "donors": g.base_donors, "employers": g.employers, "committees": g.raw.cm, "candidates": g.raw.cn, "contributed_to": g.contributed,
        "transferred_to": g.transferred, "affiliated_with": g.affiliated, "employed_by": g.employed, "spent_on": g.spent,
    })


def _pies(g: Graph) -> DataFrame:
    sums = analysis.pie(_upstream(g))
    return _rounded(sums.select("start", "kind", "total", "pct", "sources"), "total")


PLANS = {
    "contrib_edges": lambda g: g.contributed,
    "donor_vertices": lambda g: g.base_donors,
    "donor_keys": donor_keys,
    "employer_vertices": lambda g: g.employers,
    "employed_by_edges": lambda g: g.employed,
    "transfer_edges": lambda g: g.transferred,
    "ie_edges": lambda g: g.spent,
    "affiliation_edges": lambda g: g.affiliated,
    "committee_terminal_type": lambda g: g.typed.select("CMTE_ID", "CMTE_TP", "ORG_TP", "terminal_type"),
    "committee_flags": committee_flags,
    "candidate_names": candidate_names,
    "linkage_flags": linkage_flags,
    "donor_type": lambda g: g.donors.select("donor_key", "canonical_name", "canonical_employer", "donor_type"),
    "whale_tier": lambda g: g.donors.select("donor_key", "total_amount", "whale_tier"),
    "type_counts": donor_type_counts,
    "committee_financials": lambda g: g.committees.select("CMTE_ID", "total_receipts", "total_disbursed"),
    "largest_committees": lambda g: enrich.largest(g.committees).select("CMTE_ID", "CMTE_NM", "total_receipts"),
    "financial_stats": lambda g: enrich.financial_stats(g.committees),
    "committee_by_cycle": lambda g: summaries.by_cycle({"individual": g.contributed, "committee": g.transferred.withColumnRenamed("dst", "cmte_id")}, "cmte_id", CYCLES),
    "donor_by_cycle": lambda g: summaries.by_cycle({"total": g.contributed}, "donor_key", CYCLES),
    "top_donors": lambda g: summaries.top_donors(g.contributed, g.donors),
    "donor_top_committees": lambda g: summaries.donor_top_committees(g.contributed, g.typed),
    "candidate_top_donors": lambda g: summaries.candidate_top_donors(g.all_starts, g.contributed, g.donors),
    "candidate_top_committees": lambda g: summaries.candidate_top_committees(g.all_starts, g.transferred, g.typed),
    "candidate_whale_counts": lambda g: summaries.candidate_whale_counts(g.all_starts, g.contributed, g.donors),
    "committee_documents": committee_documents,
    "top_sources": lambda g: summaries.top_sources(g.transferred, g.typed),
    "top_recipients": lambda g: summaries.top_recipients(g.transferred, g.typed),
    "more_sources": lambda g: summaries.with_remainder(g.transferred.groupBy("dst", "src").agg(F.sum("total_amount").alias("amount")), "dst", "amount", "src"),
    "whale_counts": lambda g: summaries.whale_counts(g.contributed, g.donors),
    "donor_lean": lambda g: g.lean,
    "donor_top_candidates": lambda g: summaries.donor_top_candidates(g.contributed, g.affiliated, g.raw.cn),
    "committee_summary": lambda g: summaries.committee_summary(g.committees, g.contributed, g.transferred),
    "donor_summary": lambda g: summaries.donor_summary(g.donors, g.contributed, g.lean, DONOR_SUMMARY_THRESHOLD),
    "direct_committees": lambda g: traverse.direct_committees(g.affiliated, g.typed),
    "upstream_unweighted": _unweighted,
    "upstream_summary": lambda g: analysis.upstream_summary(_unweighted(g)),
    "upstream_top": lambda g: analysis.upstream_top(_unweighted(g)),
    "upstream_proportional": lambda g: _rounded(_upstream(g), "amount"),
    "upstream_first_visit": lambda g: _rounded(_upstream(g, mode="first_visit"), "amount"),
    "upstream_depth3": lambda g: _rounded(_upstream(g, False, mode="first_visit", levels=4, least=1e-3, dust=0.0), "amount"),
    "upstream_cycle": lambda g: _rounded(_upstream(g.only(CYCLE)), "amount"),
    "upstream_cycle_compat": lambda g: _rounded(_upstream(g.only(CYCLE, True)), "amount"),
    "funding_pies": _pies,
    "pie_top": lambda g: _rounded(analysis.pie_top(_upstream(g)), "amount"),
    "ie_support": lambda g: _side(g, "S"),
    "ie_oppose": lambda g: _side(g, "O"),
    "ie_support_cycle": lambda g: _side(g.only(CYCLE), "S"),
    "ie_spenders": lambda g: analysis.ie_spenders(g.spent, g.raw.cm),
    "corporate_influence": lambda g: _corporate(g),
    "corporate_influence_cycle": lambda g: _corporate(g.only(CYCLE)),
    "source_ratio": lambda g: g.ratios.withColumns({n: F.round(F.col(n), 6) for n in ("i", "o", "h")}),
    "candidate_summary": lambda g: _rounded(analysis.candidate_summary(g.all_starts, g.committees, g.ratios), "total_raised", "individual_total", "organization_total"),
    "funding_totals": lambda g: analysis.funding_totals(g.all_starts, g.contributed, g.transferred, g.spent),
    "resolve_candidate": lambda g: analysis.resolve_candidate(g.raw.cn, name="nation"),
    "donor_paths": donor_paths,
    "employer_influence": employer_influence,
    "committee_inflow": committee_inflow,
    "long_chains": long_chains,
    "shortest_hops": shortest_hops,
    "member_totals": member_totals,
    "member_mapping": member_mapping,
    "list_members": list_members,
    "resolve_member": resolve_member,
    "committee_merge": committee_merge,
    "transaction_types": lambda g: fec.histogram(g.raw.ie, "TRANSACTION_TP"),
    "filtered_transfers": lambda g: fec.filtered_share(g.raw.oth),
    "restored_spending": restored_spending,
    "merged_committees": merged_committees,
    "raw_files": raw_files,
    "raw_file_transfers": raw_file_transfers,
    "raw_file_links": raw_file_links,
    "raw_file_spending": raw_file_spending,
    "graph_stats": _stats,
    "skipped_edges": lambda g: build.skipped_contributions(g.gift_groups, g.base_donors),
}


def queries() -> dict:
    def bound(plan):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return _out(plan(Graph.of(spark, sf_dir)))

        return run

    out = {name: bound(plan) for name, plan in PLANS.items()}
    out["event_windows"] = lambda spark, sf_dir: events.windowed(spark.read.parquet(f"{sf_dir}/events.parquet"))
    return out
