"""Hand-made graphs small enough to check by hand."""

from decimal import Decimal, localcontext

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.functions import classify, normalize
from ledgerflow.operators import analysis, blocks, build, enrich, summaries, traverse


def _committees(spark, rows):
    """(id, type, receipts)"""
    return spark.createDataFrame(rows, "CMTE_ID string, terminal_type string, total_receipts double").withColumn("CMTE_NM", F.col("CMTE_ID")).withColumn("ORG_TP", F.lit(""))


def _moves(spark, rows):
    return spark.createDataFrame([(a, b, "2020", "pas2", Decimal(w), 1) for a, b, w in rows], "src string, dst string, cycle string, source string, total_amount decimal(20,4), transaction_count long")


def _gifts(spark, rows):
    return spark.createDataFrame([(d, c, "2020", Decimal(w), 1) for d, c, w in rows], "donor_key string, cmte_id string, cycle string, total_amount decimal(20,4), transaction_count long")


def _donors(spark, rows):
    """(key, type)"""
    return spark.createDataFrame(rows, "donor_key string, donor_type string").withColumn("canonical_name", F.concat(F.lit("N "), "donor_key")).withColumn("canonical_employer", F.lit("X"))


def _attributed(spark, committees, moves, gifts, donors, **kw):
    c = _committees(spark, committees)
    m, g, d = _moves(spark, moves), _gifts(spark, gifts), _donors(spark, donors)
    starts = spark.createDataFrame([("cand", "K")], "start string, cmte_id string")
    out = traverse.upstream(starts, traverse.pair_weights(m, c), traverse.donor_inflow(g, d), **kw)
    return {(r["kind"], r["entity"]): round(r["amount"], 6) for r in out.collect()}


def test_proportional_share(spark):
    """P received 100, 20 of it from T, and gave 40 to K: 8 of T's money reached K."""
    got = _attributed(
        spark, [("K", "campaign", 40.0), ("P", "passthrough", 100.0), ("T", "corporation", 0.0)], [("P", "K", 40), ("T", "P", 20)], [("d", "P", 80)], [("d", "individual")]
    )
    assert got == {("corporation", "T"): 8.0, ("individual", "d"): 32.0}


def test_diamond_by_mode(spark):
    committees = [("K", "campaign", 50.0), ("P1", "passthrough", 100.0), ("P2", "passthrough", 100.0), ("S", "passthrough", 200.0)]
    moves = [("P1", "K", 30), ("P2", "K", 20), ("S", "P1", 100), ("S", "P2", 100)]
    args = (spark, committees, moves, [("d", "S", 200)], [("d", None)])
    assert _attributed(*args) == {("individual", "d"): 50.0}
    assert _attributed(*args, mode="first_visit") == {("individual", "d"): 30.0}


def test_cycle_ends_and_cap(spark):
    committees = [("K", "campaign", 10.0), ("P1", "passthrough", 100.0), ("P2", "passthrough", 5.0)]
    moves = [("P2", "K", 10), ("P1", "P2", 5), ("P2", "P1", 50)]
    free = _attributed(spark, committees, moves, [("d", "P1", 50)], [("d", "individual")])
    capped = _attributed(spark, committees, moves, [("d", "P1", 50)], [("d", "individual")], cap_ratio=True)
    assert free[("individual", "d")] > capped[("individual", "d")] > 0


def test_campaign_sources_are_dropped(spark):
    got = _attributed(spark, [("K", "campaign", 9.0), ("C", "campaign", 9.0)], [("C", "K", 9)], [("d", "C", 9)], [("d", "individual")])
    assert got == {}


@pytest.mark.parametrize("chain,hops", [(0, 1.0), (1, 2.0), (2, 3.0)])
def test_source_ratio_distance(spark, chain, hops):
    names = ["K", "A", "B"][: chain + 1]
    c = _committees(spark, [(n, "passthrough", 10.0) for n in names])
    m = _moves(spark, [(b, a, 10) for a, b in zip(names, names[1:], strict=False)] or [("x", "y", 1)])
    g = _gifts(spark, [("d", names[-1], 10)])
    out = {r["cmte_id"]: r for r in traverse.source_ratio(c, m, g, _donors(spark, [("d", "individual")])).collect()}
    assert (out["K"]["i"], out["K"]["o"], out["K"]["h"]) == (1.0, 0.0, hops)


def test_source_ratio_edge_cases(spark):
    c = _committees(spark, [("zero", "passthrough", 0.0), ("T", "corporation", 5.0), ("K", "campaign", 5.0), ("P", "passthrough", 5.0), ("Q", "passthrough", 5.0)])
    m = _moves(spark, [("T", "K", 5), ("P", "Q", 5), ("Q", "P", 5)])
    out = {r["cmte_id"]: r for r in traverse.source_ratio(c, m, _gifts(spark, [("d", "P", 5)]), _donors(spark, [("d", None)])).collect()}
    assert (out["zero"]["i"], out["zero"]["o"], out["zero"]["h"]) == (0.5, 0.5, 1.0)
    assert (out["K"]["i"], out["K"]["o"], out["K"]["h"]) == (0.0, 1.0, 1.0)
    assert all(abs(r["i"] + r["o"] - 1) < 1e-12 for r in out.values())


def test_unweighted_counts_paths(spark):
    c = _committees(spark, [("K", "campaign", 1.0), ("P", "passthrough", 1.0), ("T", "labor_union", 1.0)])
    m = _moves(spark, [("P", "K", 1), ("T", "P", 7), ("T", "K", 2)]).unionByName(_moves(spark, [("P", "K", 1)]).withColumn("cycle", F.lit("2022")))
    starts = spark.createDataFrame([("cand", "K")], "start string, cmte_id string")
    out = {r["entity"]: r for r in traverse.upstream_unweighted(starts, m, _gifts(spark, [("d", "P", 3)]), _donors(spark, [("d", "individual")]), c).collect()}
    assert (out["T"]["total_amount"], out["T"]["paths"]) == (16.0, 3)
    assert (out["d"]["total_amount"], out["d"]["paths"]) == (6.0, 2)


def test_direct_committees_fall_back(spark):
    a = spark.createDataFrame([("K", "c1", "2020"), ("P", "c1", "2020"), ("P", "c2", "2020"), ("P", "c2", "2022")], "cmte_id string, cand_id string, cycle string")
    c = spark.createDataFrame([("K", "H"), ("P", "Q")], "CMTE_ID string, CMTE_TP string")
    assert sorted(map(tuple, traverse.direct_committees(a, c).collect())) == [("c1", "K"), ("c2", "P")]


def test_fanout_counts_a_committee_once(spark):
    g = _gifts(spark, [("d", "K", 10)])
    a = spark.createDataFrame([("K", "c", y) for y in ("2018", "2020", "2022")], "cmte_id string, cand_id string, cycle string")
    assert summaries.gifts_to_candidates(g, a).count() == 1
    assert summaries.gifts_to_candidates(g, a, compat_fanout=True).count() == 3


def test_donor_variants_and_threshold(spark):
    rows = [("2020", "SMITH, JOHN", "ACME INC", "C1", "9000"), ("2020", "SMITH  JOHN", "ACME, INC.", "C1", "12000"), ("2020", "", "X", "C1", "99999"), ("2020", "ROE", None, "C1", None)]
    indiv = spark.createDataFrame([(a, b, c, d, Decimal(e) if e else None) for a, b, c, d, e in rows], "cycle string, NAME string, EMPLOYER string, CMTE_ID string, TRANSACTION_AMT decimal(18,4)")
    raw = build.donors(indiv).collect()
    assert len(raw) == 1 and float(raw[0]["total_amount"]) == 12000
    whole = build.donors(indiv, threshold_on="normalized").collect()
    assert len(whole) == 1 and float(whole[0]["total_amount"]) == 21000
    cm = spark.createDataFrame([("C1",)], "CMTE_ID string")
    assert float(build.contributed_to(indiv, build.donors(indiv), cm).first()["total_amount"]) == 21000


def test_transfers_directions(spark):
    schema = "cycle string, CMTE_ID string, OTHER_ID string, ENTITY_TP string, TRANSACTION_AMT decimal(14,2)"
    pas2 = spark.createDataFrame([("2020", "A", "B", "PAC", Decimal(5)), ("2020", "A", "A", "PAC", Decimal(5)), ("2020", "A", "Z", "PAC", Decimal(5)), ("2020", "B", "A", "IND", Decimal(1))], schema)
    oth = spark.createDataFrame([("2020", "B", "A", "PAC", Decimal(7)), ("2020", "A", "B", "IND", Decimal(9)), ("2020", "A", "B", "ORG", Decimal(-3))], schema)
    cm = spark.createDataFrame([("A",), ("B",)], "CMTE_ID string")
    got = sorted((r["src"], r["dst"], r["source"], float(r["total_amount"])) for r in build.transferred_to(pas2, oth, cm).collect())
    assert got == [("A", "B", "oth", 7.0), ("A", "B", "pas2", 5.0)]
    assert [float(r["total_amount"]) for r in build.transferred_to(pas2, oth, cm, dedupe_sources=True).collect()] == [7.0]


def test_classification_branches(spark):
    cases = [("X", "C", "passthrough"), ("V", "", "passthrough"), ("H", "C", "campaign"), ("N", "C", "corporation"), ("Q", "T", "trade_association"), ("O", "L", "labor_union"),
             ("D", "M", "ideological"), ("D", "W", "corporation"), ("D", "V", "cooperative"), ("U", None, "super_pac_unclassified"), ("W", "", "passthrough"), (None, None, "unknown")]
    df = spark.createDataFrame(cases, "tp string, org string, want string")
    assert df.filter(classify.terminal_type(F.col("tp"), F.col("org")) != F.col("want")).count() == 0
    people = [(None, None, "unclear"), ("WINRED", None, "conduit"), ("XX EARMARK", None, "conduit"), ("ACME LLC", None, "organization"), ("DOE, JANE", None, "individual"),
              ("JANE DOE", None, "individual"), ("DOE 5", "RETIRED", "individual"), ("DOE, J4", "X", "likely_individual"), ("DOE 5 X", "X", "likely_individual"), ("CHER9", "X", "unclear")]
    df = spark.createDataFrame(people, "n string, e string, want string")
    assert df.filter(classify.donor_type(F.col("n"), F.col("e")) != F.col("want")).collect() == []
    tiers = [(49999.99, None), (50000.0, "notable"), (100000.0, "whale"), (500000.0, "mega"), (1000000.0, "ultra")]
    df = spark.createDataFrame(tiers, "t double, want string")
    assert df.filter(~classify.whale_tier(F.col("t")).eqNullSafe(F.col("want"))).count() == 0


def test_amounts_and_names(spark):
    rows = [("", 0.0), ("12.5", 12.5), (" -3 ", -3.0), ("abc", None), ("1d", None), (None, None)]
    df = spark.createDataFrame(rows, "a string, want double").withColumn("got", normalize.amount(F.col("a")).cast("double"))
    assert df.filter(~F.col("got").eqNullSafe(F.col("want"))).collect() == []
    one = spark.range(1).select(
        normalize.normalize_name(F.lit(" smith ,  john ")).alias("n"), normalize.normalize_employer(F.lit("Acme,  Inc.")).alias("e"),
        normalize.extract_company(F.lit("ACME EMPLOYEES PAC")).alias("c"), normalize.format_money(F.lit(1234567.0)).alias("m"),
    ).first()
    assert tuple(one) == ("SMITH JOHN", "ACME INC", "ACME", "$1.23M")


def test_financials_and_null_type(spark):
    cm = spark.createDataFrame([("K", "H", ""), ("Z", "Q", "")], "CMTE_ID string, CMTE_TP string, ORG_TP string")
    typed = enrich.classified_committees(cm)
    out = {r["CMTE_ID"]: (float(r["total_receipts"]), float(r["total_disbursed"])) for r in enrich.financials(typed, _gifts(spark, [("d", "K", 4)]), _moves(spark, [("Z", "K", 6)])).collect()}
    assert out == {"K": (10.0, 0.0), "Z": (0.0, 6.0)}
    s = summaries.committee_summary(enrich.financials(typed, _gifts(spark, [("d", "K", 4)]), _moves(spark, [("Z", "K", 6)])), _gifts(spark, [("d", "K", 4)]), _moves(spark, [("Z", "K", 6)]), 1)
    assert (s.first()["individual_pct"], s.first()["committee_pct"]) == (40.0, 60.0)
    top = summaries.top_donors(_gifts(spark, [("d", "K", 4), ("e", "K", 9)]), _donors(spark, [("d", None), ("e", "conduit")]).withColumn("whale_tier", F.lit(None).cast("string")))
    assert [r["donor_key"] for r in top.collect()] == ["d"]  # a donor without a type is not a conduit


def test_other_cycles_are_reported(spark):
    g = _gifts(spark, [("d", "K", 4)]).unionByName(_gifts(spark, [("d", "K", 5)]).withColumn("cycle", F.lit("1990")))
    out = {(r["cmte_id"], r["cycle"]): (float(r["total"]), r["total_count"]) for r in summaries.by_cycle({"total": g}, "cmte_id", ["2018", "2020"]).collect()}
    assert out == {("K", "2018"): (0.0, 0), ("K", "2020"): (4.0, 1), ("K", "other"): (5.0, 1)}


def test_names_of_codes(spark):
    df = spark.createDataFrame([("DEM", "Democrat", "H", "House"), ("XYZ", "XYZ", "Q", "Unknown"), (None, "Unknown", None, "Unknown"), ("", "Unknown", "P", "President")], "p string, want string, o string, office string")
    assert df.filter((classify.party_name(F.col("p")) != F.col("want")) | (classify.office_name(F.col("o")) != F.col("office"))).count() == 0


def test_independent_spending_sources(spark):
    """A committee of any type is a source; the employer stands in the label unless it is a placeholder."""
    c = _committees(spark, [("S", "super_pac_unclassified", 10.0), ("K", "campaign", 5.0)])
    spent = spark.createDataFrame([("S", "cand", Decimal(5), 1, "O", "2020")], "cmte_id string, cand_id string, total_amount decimal(20,4), transaction_count long, support_oppose string, cycle string")
    people = spark.createDataFrame(
        [("a", "individual", "A", "SELF EMPLOYED"), ("b", "individual", "B", "homemaker"), ("c", None, "C", None), ("o", "organization", "O", "X")],
        "donor_key string, donor_type string, canonical_name string, canonical_employer string",
    )
    gifts = _gifts(spark, [("a", "S", 1), ("b", "S", 1), ("c", "S", 1), ("o", "S", 1)])
    out = {(r["kind"], r["label"]): float(r["amount"]) for r in analysis.ie_funding(spent, "O", c, _moves(spark, [("K", "S", 6)]), gifts, people).collect()}
    assert out == {("individual", "A (SELF EMPLOYED)"): 0.5, ("individual", "B"): 0.5, ("individual", "C"): 0.5, ("dark_money", "O"): 0.5, ("campaign", "K"): 3.0}


def test_upstream_categories(spark):
    rows = [("c", t, t, t, Decimal(1), 1) for t in ("corporation", "trade_association", "labor_union", "ideological", "donor", "cooperative")]
    found = spark.createDataFrame(rows, "start string, entity string, terminal_type string, name string, total_amount decimal(20,4), paths long")
    assert {r["category"] for r in analysis.upstream_summary(found).collect()} == {"corporations", "trade_associations", "labor_unions", "ideological", "donors", "unresolved"}
    assert analysis.upstream_top(found.unionByName(found.withColumn("entity", F.lit("z"))), 1).count() == 6


def test_candidate_without_money_has_no_summary(spark):
    starts = spark.createDataFrame([("a", "K"), ("b", "Z")], "start string, cmte_id string")
    c = _committees(spark, [("K", "campaign", 10.0), ("Z", "campaign", 0.0)])
    ratios = spark.createDataFrame([("K", 0.25, 0.75, 1.0), ("Z", 0.5, 0.5, 1.0)], "cmte_id string, i double, o double, h double")
    out = analysis.candidate_summary(starts, c, ratios).collect()
    assert [(r["start"], float(r["total_raised"]), float(r["individual_total"]), r["organization_pct"], r["funding_distance"]) for r in out] == [("a", 10.0, 2.5, 75.0, 2.0)]


def test_known_committees_are_united(spark):
    starts = spark.createDataFrame([("a", "K")], "start string, cmte_id string")
    members = spark.createDataFrame([(["a"], ["K", "M"]), ([], ["N"])], "candidate_ids array<string>, committee_ids array<string>")
    assert sorted(map(tuple, analysis.with_known(starts, members).collect())) == [("a", "K"), ("a", "M")]


def test_paths_and_shortest(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "src string, dst string")
    starts = e.select(F.col("src").alias("origin"))
    assert sorted(">".join(r["path"]) for r in traverse.paths(e, starts, least=1).collect()) == sorted(["a>b", "b>c", "c>a", "a>b>c", "b>c>a", "c>a>b"])
    assert sorted(">".join(r["path"]) for r in traverse.paths(e, starts.limit(1), 1).collect()) == ["a", "a>b"]
    links = spark.createDataFrame([("c", "X")], "cmte_id string, cand_id string")
    assert sorted((r["origin"], r["hops"], int(r["walks"])) for r in traverse.chains(e.union(e), links, 4, 1).collect()) == [("a", 2, 1), ("b", 1, 1), ("b", 4, 1), ("c", 3, 1)]
    assert {(r["origin"], r["target"]): r["hops"] for r in traverse.shortest_hops(e).collect()}[("a", "c")] == 2


def test_whole_graph_hops(spark):
    """A committee's third source counts too, and a chain is followed to its end."""
    moves = [("a", "k", 9), ("b", "k", 8), ("c", "k", 1), ("c", "k", 2)] + [(f"n{i}", f"n{i + 1}", 1) for i in range(7)]
    got = {(r["origin"], r["target"]): r["hops"] for r in traverse.shortest_hops(_moves(spark, moves), None).collect()}
    assert got == {(x, "k"): 1 for x in "abc"} | {(f"n{i}", f"n{j}"): j - i for i in range(8) for j in range(i + 1, 8)}


def _random_moves(n=40, seed=5):
    """Dense parts that are not linked, a long chain and vertices without a way on."""
    import random

    r = random.Random(seed)
    pairs = {(f"{p}{r.randrange(n)}", f"{p}{r.randrange(n)}") for p in "xy" for _ in range(6 * n)} | {(f"z{i}", f"z{i + 1}") for i in range(12)}
    return sorted((a, b, r.randrange(1, 99)) for a, b in pairs if a != b)


def test_hops_of_blocks(spark, monkeypatch):
    """Blocks and matrices smaller than the graph, against a search from every vertex; no row is made for an edge behind a pair."""
    monkeypatch.setattr(blocks, "BLOCK", 7)
    moves = _random_moves()
    want = {}
    for start in {m[0] for m in moves}:
        far, level = {start: 0}, [start]
        while level:
            level = sorted({b for a, b, _ in moves if a in level} - far.keys())
            far |= dict.fromkeys(level, max(far.values()) + 1)
        want |= {(start, x): k for x, k in far.items() if k}
    got = traverse.shortest_hops(_moves(spark, moves), None).collect()
    assert len(got) == len(want) and {(r["origin"], r["target"]): r["hops"] for r in got} == want
    _, levels = blocks.hop_levels(_moves(spark, moves), None)
    assert levels.select("o", "hops").distinct().count() == levels.count()


def test_hops_are_bits(monkeypatch):
    """A dense level of a block, more than one word of starts and slices of edges: a pair takes bits, not a number."""
    import pyarrow as pa

    monkeypatch.setattr(blocks, "EDGES", 500, raising=False)
    monkeypatch.setattr(blocks, "SLICE", 3000, raising=False)
    n, r = 600, np.random.default_rng(3)
    edge = r.random((n, n)) < 0.02
    edge[:, :5] = edge[7] = False
    np.fill_diagonal(edge, False)
    ends = [np.flatnonzero(row).astype(np.int32) for row in edge]
    some = [i for i in range(n) if len(ends[i])]
    lists, kind = [ends[i] for i in some], pa.list_(pa.int32())
    one = pa.array([1] * len(some), pa.int32())
    ids, none = pa.array(some, pa.int32()), pa.nulls(len(some), pa.int32())
    left = pa.table({"b": pa.array([0] * len(some), pa.int32()), "o": ids, "hops": one, "to": pa.array(lists, kind), "base": none, "bits": pa.nulls(len(some), pa.binary())})
    right = pa.table({"for": pa.array([0] * len(some), pa.int32()), "m": ids, "next": pa.array(lists, kind)})
    got = blocks.next_hops(2)(left, right)
    want = (edge.astype(int) @ edge > 0) & ~edge & ~np.eye(n, dtype=bool)
    assert got.nbytes < want.sum()
    starts = got.filter(got.column("o").is_valid())
    found = dict(zip(starts.column("o").to_pylist(), (v.tolist() for v in blocks.reached(starts)), strict=True))
    assert found == {i: np.flatnonzero(row).tolist() for i, row in enumerate(want) if row.any()}
    assert got.filter(got.column("o").is_null()).column("to").to_pylist() == [np.flatnonzero(want.any(axis=0)).tolist()]


def test_whole_graph_inflow(spark):
    """K gets 3, 2 and 1 from A, B and C and 4 from a donor; A's 10 came from a donor, so 3 of it reached K."""
    c = _committees(spark, [("K", "campaign", 10.0), ("A", "passthrough", 10.0), ("B", "corporation", 0.0), ("C", "unknown", 0.0)])
    m, g = _moves(spark, [("A", "K", 3), ("B", "K", 2), ("C", "K", 1)]), _gifts(spark, [("d", "K", 4), ("e", "A", 10)])
    out = traverse.inflow_by_kind(traverse.pair_weights(m, c), traverse.all_gifts(g, _donors(spark, [("d", None), ("e", "individual")])))
    want = {("K", "passthrough", 1): 3.0, ("K", "corporation", 1): 2.0, ("K", "unknown", 1): 1.0, ("K", "donor", 1): 4.0, ("A", "individual", 1): 10.0, ("K", "individual", 2): 3.0}
    assert {(r["target"], r["kind"], r["hops"]): r["amount"] for r in out.collect()} == want


def test_inflow_of_blocks(spark, monkeypatch):
    """Small blocks, and sums of large amounts to the last place, against plain sums over all walks of three edges."""
    monkeypatch.setattr(blocks, "BLOCK", 7)
    moves = _random_moves(12)
    names = sorted({x for m in moves for x in m[:2]})
    c = _committees(spark, [(x, "unknown" if i % 3 else "corporation", 1000.0 * (i % 5)) for i, x in enumerate(names)])
    gifts = [(f"d{i}", x, 10**12 + 7 * i) for i, x in enumerate(names) if i % 4]
    weights = traverse.pair_weights(_moves(spark, moves), c)
    got = traverse.inflow_by_kind(weights, traverse.all_gifts(_gifts(spark, gifts), _donors(spark, [(d, None) for d, _, _ in gifts])))
    kind = {x: "unknown" if i % 3 else "corporation" for i, x in enumerate(names)}
    receipts = {x: 1000.0 * (i % 5) for i, x in enumerate(names)}
    came = {}
    for x, k, w in [(b, kind[a], w) for a, b, w in moves] + [(x, "donor", w) for _, x, w in gifts]:
        came[x, k] = came.get((x, k), 0) + w
    front, want = {(x, x): 1.0 for x, _ in came}, {}
    for hops in (1, 2, 3):
        for (t, v), m in front.items():
            for (x, k), w in came.items():
                if x == v:
                    want[t, k, hops] = want.get((t, k, hops), 0) + w * Decimal(round(m, 12)).quantize(Decimal("1e-12"))
        step = {}
        for (t, v), m in front.items():
            for a, b, w in moves:
                if b == v and receipts[a]:
                    step[t, a] = step.get((t, a), 0.0) + m * (w / receipts[a])
        front = step
    rows = {(r["target"], r["kind"], r["hops"]): r["amount"] for r in got.collect()}
    assert rows.keys() == want.keys() and all(abs(rows[k] - want[k]) <= Decimal("0.01") for k in want)
    big = np.array([[2**59 + 1, -(2**59) - 3]]), np.array([[2**59 - 5], [12345]])
    assert blocks.exact_product(*big)[0, 0] == (2**59 + 1) * (2**59 - 5) - (2**59 + 3) * 12345
    assert blocks.money(-5) == "-0.0000000000000005"


def test_inflow_writes_no_pairs(spark, monkeypatch):
    """The factors of the last front, here one for nearly every pair, are not written; four and five edges agree with walks counted by matrices."""
    written = []
    real = blocks.checkpointed

    def checkpointed(df, *a):
        made = real(df, *a)
        if "v" in made.columns and "m" in made.columns:
            written.append(made.agg(F.sum(F.size("v"))).first()[0] or 0)
        return made

    monkeypatch.setattr(blocks, "checkpointed", checkpointed)
    monkeypatch.setattr(blocks, "BLOCK", 3)
    n, r = 40, np.random.default_rng(4)
    edge = (r.random((n, n)) < 0.2) & ~np.eye(n, dtype=bool)
    share = np.where(edge, r.integers(1, 64, (n, n)) / 1024, 0)
    name = [f"C{i:02}" for i in range(n)]
    weights = spark.createDataFrame([(name[i], name[j], float(share[i, j])) for i, j in zip(*np.nonzero(edge), strict=True)], "src string, dst string, share double")
    came = spark.createDataFrame([(x, ("a", None)[i % 2], Decimal(i + 1)) for i, x in enumerate(name) if i % 5], "cmte_id string, kind string, w decimal(18,4)")
    w = np.array([[i + 1 if i % 5 and i % 2 == k else 0 for i in range(n)] for k in (0, 1)])
    for most in (2, 3, 5):
        written.clear()
        got = {(x["target"], x["kind"], x["hops"]): float(x["amount"]) for x in blocks.inflow_levels(weights, came, most).collect()}
        want, front = {}, share.T
        for hops in range(2, most + 1):
            want |= {(name[t], k, hops): (front @ w[c])[t] for c, k in enumerate(("a", None)) for t in range(n) if (front @ w[c])[t]}
            front = front @ share.T
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 for k in want)
        if most == 3:
            assert sum(written) == 0


def test_money_by_label(spark, monkeypatch):
    """Exact sums whatever the size of amounts and blocks, null labels included; the plan has no join of amounts and factors."""
    monkeypatch.setattr(blocks, "AMOUNTS", 40)
    factors = [(f"H{c}", f"C{k}", (k * 7 + c) / 13 * 10.0 ** -(c % 4)) for c in range(5) for k in range(30) if (k + c) % 3]
    money = [(f"C{k}", "individual", None if n == 3 else f"L{n}", Decimal(10 ** (n % 13) * (k + 1)) + Decimal("0.0001") * n) for n in range(20) for k in range(n, 40, 3)]
    want = {}
    with localcontext(prec=60):
        for cand, cmte, m in factors:
            for other, kind, label, w in money:
                if other == cmte:
                    key = cand, kind, label
                    want[key] = want.get(key, 0) + w * Decimal(repr(m)).quantize(Decimal("1e-12"), "ROUND_HALF_UP")
    shares = spark.createDataFrame(factors, "cand_id string, cmte_id string, m double")
    found = blocks.money_by_label(shares, spark.createDataFrame(money, "cmte_id string, kind string, label string, w decimal(28,4)"))
    assert {(r["cand_id"], r["kind"], r["label"]): r["amount"] for r in found.collect()} == want
    assert blocks.decimals([np.array([-5])] + [np.array([0])] * 7)[0].as_py() == Decimal("-0.0000000000000005")


def test_members(spark):
    m = spark.createDataFrame(
        [("B1", ("Ann", "Lee"), ["H1", "H9"], [("rep", "NY", "D", 1), ("sen", "NY", "D", None)]), ("B2", ("Bob", "Ray"), [], [])],
        "bioguide string, name struct<first:string,last:string>, fec array<string>, terms array<struct<type:string,state:string,party:string,district:int>>",
    )
    cn = spark.createDataFrame([("H1", "LEE, ANN"), ("H2", "POE, ED")], "CAND_ID string, CAND_NAME string")
    ccl = spark.createDataFrame([("H1", "C1"), ("H1", "C2"), ("H9", "C3")], "CAND_ID string, CMTE_ID string")
    got = analysis.member_mapping(m, cn, ccl)
    one = {r["bioguide"]: r for r in got.collect()}
    assert one["B1"]["candidate_ids"] == ["H1"] and one["B1"]["committee_ids"] == ["C1", "C2"] and one["B1"]["congress"]["chamber"] == "senate"
    assert one["B2"]["candidate_ids"] == []
    assert [r["last"] for r in analysis.list_members(got).collect()] == ["Lee", "Ray"]
    assert analysis.resolve_candidate(cn, name="ann lee", members=got).first()["candidate_ids"] == ["H1"]
    assert analysis.resolve_candidate(cn, fec_id="H77").first()["name"] == "H77"
    assert analysis.resolve_candidate(cn, name="poe").first()["candidate_ids"] == ["H2"]
    assert analysis.resolve_candidate(cn, bioguide="B1", members=got).first()["name"] == "Ann Lee"


def test_options(spark):
    """Memos may be left out, an occupation may tell a person, identifiers fall apart."""
    rows = spark.createDataFrame([("X", 1), ("", 2), (None, 3)], "MEMO_CD string, n int")
    assert sorted(r["n"] for r in build.without_memos(rows).collect()) == [2, 3]
    donors = spark.createDataFrame([("CHER9", "Y", "attorney", 1.0), ("CHER9", "Y", "singer", 1.0)], "canonical_name string, canonical_employer string, occupation string, total_amount double")
    assert [r["donor_type"] for r in enrich.classified_donors(donors).collect()] == ["individual", "unclear"]
    ids = spark.createDataFrame([("committees/C1", "C1", "committees"), ("C2", "C2", None)], "id string, k string, c string")
    wrong = ~normalize.identifier_key(F.col("id")).eqNullSafe(F.col("k")) | ~normalize.identifier_collection(F.col("id")).eqNullSafe(F.col("c"))
    assert ids.filter(wrong).count() == 0


def test_command(spark, capsys):
    from ledgerflow.__main__ import main

    d = "/root/testdata/sf0.001"
    assert main([d, "--list-members"], spark) == 0
    assert capsys.readouterr().out.count("First") == 25
    assert main([d, "--candidate", "last15", "--summary", "--pies"], spark) == 0
    out = capsys.readouterr().out
    assert "PIES 1 AND 2" in out and "PIE 5" in out and "direct" in out
    assert main([d, "--candidate", "nobody at all"], spark) == 1
    assert main([d, "--fec", "H00000015", "--cycle", "1998", "--depth", "2"], spark) == 0
