"""Who pays for a candidate: independent spending, corporate influence, totals, name lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.normalize import extract_company, part_of
from ledgerflow.operators import blocks
from ledgerflow.operators.traverse import donor_inflow
from ledgerflow.schemas import IE_NOT_EMPLOYERS, NOT_COMPANIES, PART, SUM

#: The categories of upstream sources; any other kind is unresolved.
CATEGORIES = {
    "corporation": "corporations", "trade_association": "trade_associations", "labor_union": "labor_unions", "ideological": "ideological",
    "donor": "donors",
}


def _categories(found: DataFrame) -> DataFrame:
    out = F.lit("unresolved")
    for kind, name in CATEGORIES.items():
        out = F.when(F.col("terminal_type") == kind, name).otherwise(out)
    return found.withColumn("category", out)


def upstream_summary(found: DataFrame) -> DataFrame:
    """start, category, total, sources: sources by category."""
    return _categories(found).groupBy("start", "category").agg(F.sum("total_amount").alias("total"), F.count("*").alias("sources"))


def upstream_top(found: DataFrame, n: int = 10) -> DataFrame:
    """start, category, rank, entity, name, amount: the largest sources of each category."""
    best = Window.partitionBy("start", "category").orderBy(F.desc("total_amount"), "entity", "terminal_type")
    ranked = _categories(found).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n)
    return ranked.select("start", "category", "rank", "entity", "name", F.col("total_amount").alias("amount"))


def ie_funding(spent: DataFrame, side: str, committees: DataFrame, transferred: DataFrame, contributed: DataFrame, donors: DataFrame) -> DataFrame:
    """cand_id, kind, label, amount: who funded the committees that spent for (S) or against (O) a candidate, one hop, in
    proportion; committees of every type are sources here."""
    sums = spent.filter(F.col("support_oppose") == side).groupBy("cand_id", "cmte_id").agg(F.sum("total_amount").cast("double").alias("spent"))
    receipts = committees.filter("total_receipts > 0").select(F.col("CMTE_ID").alias("cmte_id"), F.col("total_receipts").cast("double").alias("receipts"))
    shares = sums.join(receipts, "cmte_id").select("cand_id", "cmte_id", (F.col("spent") / F.col("receipts")).alias("m"))
    people = donors.select("donor_key", "canonical_name", F.col("canonical_employer").alias("emp"))
    gifts = donor_inflow(contributed, donors).join(people, "donor_key")
    placeholder = F.upper("emp").isin(IE_NOT_EMPLOYERS) | (F.coalesce("emp", F.lit("")) == "")
    label = F.when((F.col("kind") == "individual") & ~placeholder, F.concat("canonical_name", F.lit(" ("), "emp", F.lit(")"))).otherwise(F.col("canonical_name"))
    gifts = gifts.groupBy("cmte_id", "kind", label.alias("label")).agg(F.sum("w").alias("w"))
    moves = transferred.groupBy("src", "dst").agg(F.sum("total_amount").cast(PART).alias("w"))
    types = committees.select(F.col("CMTE_ID").alias("src"), "CMTE_NM", F.coalesce("terminal_type", F.lit("unknown")).alias("kind"))
    moves = moves.join(types, "src").groupBy(F.col("dst").alias("cmte_id"), "kind", F.col("CMTE_NM").alias("label")).agg(F.sum("w").alias("w"))
    return blocks.money_by_label(shares, gifts.unionByName(moves)).filter("amount > 0.01")


def ie_spenders(spent: DataFrame, committees: DataFrame) -> DataFrame:
    named = spent.join(committees.select(F.col("CMTE_ID").alias("cmte_id"), "CMTE_NM"), "cmte_id")
    return named.groupBy("cand_id", "support_oppose", "cmte_id", "CMTE_NM").agg(F.sum("total_amount").cast(SUM).alias("amount"))


def corporate_influence(starts: DataFrame, committees: DataFrame, transferred: DataFrame, contributed: DataFrame, donors: DataFrame) -> DataFrame:
    """start, company, pac, employees, total: committees of corporations, direct or behind a passthrough, and gifts of employees."""
    w = transferred.groupBy("src", "dst").agg(F.sum("total_amount").cast(PART).alias("w"))
    direct_all = starts.join(w, F.col("cmte_id") == F.col("dst"))
    passing = committees.filter("terminal_type = 'passthrough'").select(F.col("CMTE_ID").alias("src"))
    to_start = direct_all.join(passing, "src", "left_semi").groupBy("start", "src").agg(F.sum("w").alias("to_start")).filter("to_start > 0")
    out = w.groupBy("src").agg(F.sum("w").alias("total_out")).filter("total_out > 0")
    share = to_start.join(out, "src").select("start", F.col("src").alias("via"), F.least(F.col("to_start").cast("double") / F.col("total_out").cast("double"), F.lit(1.0)).alias("pct"))
    corp = committees.filter("ORG_TP = 'C'").select(F.col("CMTE_ID").alias("src"), "CMTE_NM")
    corp_w = w.join(corp, "src")
    behind = share.join(corp_w, F.col("via") == F.col("dst")).select("start", "CMTE_NM", part_of(F.col("w"), F.col("pct")).alias("a"))
    direct = starts.join(corp_w, F.col("cmte_id") == F.col("dst")).select("start", "CMTE_NM", part_of(F.col("w"), F.lit(1.0)).alias("a"))
    zero = F.lit(0).cast("decimal(37,16)")
    pac = behind.unionByName(direct).select("start", extract_company(F.col("CMTE_NM")).alias("company"), F.col("a").alias("pac"), zero.alias("employees"))
    kept = donors.filter(F.col("donor_type").isin("individual", "likely_individual") & F.col("canonical_employer").isNotNull() & ~F.col("canonical_employer").isin(NOT_COMPANIES))
    gifts = contributed.groupBy("cmte_id", "donor_key").agg(F.sum("total_amount").cast(PART).alias("w"))
    gifts = starts.join(gifts, "cmte_id").join(kept.select("donor_key", F.trim(F.upper("canonical_employer")).alias("company")), "donor_key")
    emp = gifts.select("start", "company", zero.alias("pac"), part_of(F.col("w"), F.lit(1.0)).alias("employees"))
    both = pac.unionByName(emp).groupBy("start", "company").agg(F.sum("pac").alias("pac"), F.sum("employees").alias("employees"))
    return both.withColumn("total", F.col("pac") + F.col("employees"))


def funding_totals(starts: DataFrame, contributed: DataFrame, transferred: DataFrame, spent: DataFrame) -> DataFrame:
    """start, direct, pac, ie_support, ie_oppose, pro: one aggregation over tagged rows. starts holds all linked committees of a
    candidate, and those known otherwise (with_known)."""
    part = lambda df, name: df.select("start", F.lit(name).alias("part"), F.col("total_amount").alias("a"))
    money = part(starts.join(contributed, "cmte_id"), "direct").unionByName(part(starts.join(transferred, F.col("cmte_id") == F.col("dst")), "pac"))
    ie = spent.select(F.col("cand_id").alias("start"), F.when(F.col("support_oppose") == "S", "ie_support").otherwise("ie_oppose").alias("part"), F.col("total_amount").alias("a"))
    money = money.unionByName(ie)
    one = lambda n: F.coalesce(F.sum(F.when(F.col("part") == n, F.col("a"))), F.lit(0)).cast("double")
    sums = money.groupBy("start").agg(*[one(n).alias(n) for n in ("direct", "pac", "ie_support", "ie_oppose")])
    return sums.withColumn("pro", F.col("direct") + F.col("pac") + F.col("ie_support"))


def with_known(starts: DataFrame, members: DataFrame) -> DataFrame:
    """starts and the committees that a member's record names for its candidates: a set union."""
    known = members.select(F.explode("candidate_ids").alias("start"), F.col("committee_ids").alias("c")).select("start", F.explode("c").alias("cmte_id"))
    return starts.select("start", "cmte_id").unionByName(known).distinct()


def candidate_summary(starts: DataFrame, committees: DataFrame, ratios: DataFrame) -> DataFrame:
    """start, total_raised, individual_total, organization_total, their percentages, funding_distance: the source ratios of all of
    a candidate's committees weighted by receipts, one hop further. Candidates without traced money have no row."""
    money = committees.filter("total_receipts > 0").select(F.col("CMTE_ID").alias("cmte_id"), F.col("total_receipts").alias("r"))
    money = starts.join(money, "cmte_id").join(ratios, "cmte_id")
    share = lambda x: F.sum(part_of(F.col("r"), F.col(x)))
    sums = money.groupBy("start").agg(share("i").alias("individual_total"), share("o").alias("organization_total"), share("h").alias("steps"), F.sum("r").alias("r"))
    whole = F.col("individual_total") + F.col("organization_total")
    pct = lambda x: F.round(F.col(x).cast("double") / F.col("total_raised").cast("double") * 100, 1)
    sums = sums.withColumn("total_raised", whole).filter("total_raised > 0")
    return sums.select(
        "start", "total_raised", "individual_total", "organization_total", pct("individual_total").alias("individual_pct"),
        pct("organization_total").alias("organization_pct"), F.round(F.col("steps").cast("double") / F.col("r").cast("double") + 1, 2).alias("funding_distance"),
    )


def resolve_candidate(candidates: DataFrame, name: str | None = None, fec_id: str | None = None, members: DataFrame | None = None, bioguide: str | None = None) -> DataFrame:
    """name, candidate_ids (and committee_ids): a member by bioguide id, a candidate by id (its name falls back to the id), or by name: the
    first member whose name holds the query or whose last name the query holds, else the first candidate. First is by key."""
    spark = candidates.sparkSession
    empty = F.array().cast("array<string>")
    if bioguide is not None and members is not None:
        return members.filter(F.col("bioguide") == bioguide).select(F.concat_ws(" ", "name.first", "name.last").alias("name"), "candidate_ids", "committee_ids")
    if fec_id is not None:
        asked = spark.createDataFrame([(fec_id,)], "CAND_ID string")
        found = asked.join(candidates.select("CAND_ID", "CAND_NAME"), "CAND_ID", "left")
        return found.select(F.coalesce("CAND_NAME", "CAND_ID").alias("name"), F.array("CAND_ID").alias("candidate_ids"), empty.alias("committee_ids"))
    q = F.lit((name or "").upper())
    hits = candidates.filter(F.upper("CAND_NAME").contains(q)).select(F.lit(2).alias("o"), F.col("CAND_ID").alias("k"), F.col("CAND_NAME").alias("name"), F.array("CAND_ID").alias("candidate_ids"), empty.alias("committee_ids"))
    if members is not None:
        full = F.concat_ws(" ", F.upper("name.first"), F.upper("name.last"))
        own = members.filter(full.contains(q) | q.contains(F.upper("name.last")))
        hits = hits.unionByName(own.select(F.lit(1).alias("o"), F.col("bioguide").alias("k"), F.concat_ws(" ", "name.first", "name.last").alias("name"), "candidate_ids", "committee_ids"))
    return hits.orderBy("o", "k").limit(1).drop("o", "k")


def pie_top(df: DataFrame, n: int = 10) -> DataFrame:
    """start, kind, rank, entity, amount: the largest sources of each slice."""
    best = Window.partitionBy("start", "kind").orderBy(F.desc("amount"), "entity")
    return df.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= n).select("start", "kind", "rank", "entity", "amount")


def graph_stats(tables: dict[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in tables.items():
        one = df.agg(F.lit(name).alias("collection"), F.count("*").alias("documents"))
        out = one if out is None else out.unionByName(one)
    return out


def member_mapping(members: DataFrame, candidates: DataFrame, ccl: DataFrame) -> DataFrame:
    """Members with the candidate ids that some cycle's candidate file knows, their committees, and their last term."""
    ids = members.select("bioguide", F.explode_outer("fec").alias("CAND_ID"))
    known = ids.join(candidates.select("CAND_ID").distinct(), "CAND_ID", "left_semi")
    cands = known.groupBy("bioguide").agg(F.array_sort(F.collect_set("CAND_ID")).alias("candidate_ids"))
    cmtes = known.join(ccl.select("CAND_ID", "CMTE_ID").distinct(), "CAND_ID").groupBy("bioguide").agg(F.array_sort(F.collect_set("CMTE_ID")).alias("committee_ids"))
    term = F.try_element_at("terms", F.lit(-1))
    names = members.schema["terms"].dataType.elementType.names
    field = lambda n, out: (term[n] if n in names else F.lit(None).cast("string")).alias(out)
    chamber = F.when(term["type"] == "sen", "senate").otherwise("house")
    rest = (("state", "state"), ("party", "party"), ("class", "class"), ("district", "district"), ("start", "term_start"), ("end", "term_end"), ("state_rank", "state_rank"))
    empty = F.array().cast("array<string>")
    joined = members.join(cands, "bioguide", "left").join(cmtes, "bioguide", "left")
    return joined.select(
        "bioguide", "name", F.coalesce("candidate_ids", empty).alias("candidate_ids"), F.coalesce("committee_ids", empty).alias("committee_ids"),
        F.struct(chamber.alias("chamber"), *[field(n, out) for n, out in rest]).alias("congress"),
    )


def list_members(mapping: DataFrame) -> DataFrame:
    return mapping.select("bioguide", F.col("name.first").alias("first"), F.col("name.last").alias("last"), F.col("congress.state").alias("state"), F.col("congress.party").alias("party"), "candidate_ids").orderBy("last", "first")


def pie(df: DataFrame, start: str = "start", n: int = 10) -> DataFrame:
    """start, kind, total, pct, sources, top (largest first): one slice for each kind."""
    whole = F.sum("total").over(Window.partitionBy(start))
    best = F.slice(F.sort_array(F.collect_list(F.struct("amount", "entity")), asc=False), 1, n)
    sums = df.groupBy(start, "kind").agg(F.sum("amount").alias("total"), F.count("*").alias("sources"), best.alias("top"))
    return sums.withColumn("pct", F.when(whole > 0, F.round(F.col("total").cast("double") / whole.cast("double") * 100, 1)).otherwise(0.0))
