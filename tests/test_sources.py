"""Raw files, dumps, merges, streaming."""

import zipfile
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerflow.schemas import EDGES, FIELDS
from ledgerflow.sources import fec, store
from ledgerflow.streaming import events

LINES = [
    "C1|N|Q1||1|24E|PAC|ACME \"PAC\"|||||||12.50|C2|t1|1|||S1 ",
    "  C1|N|Q1||1|24A|IND|X|||||||abc|C2|t2|1|||S2|surplus",
    "",
    "C1|N|Q1||1|15|COM|Y|||||||",
    "C1|N|Q1||1|15|ORG|late|||||01312020||7|C2|t3|1|||S1",
]


def test_field_counts():
    assert {k: len(v) for k, v in FIELDS.items()} == {"cn": 15, "cm": 15, "ccl": 7, "indiv": 21, "oth": 21, "pas2": 22}


def test_text_and_zip_agree(spark, tmp_path):
    (tmp_path / "oth.txt").write_bytes("\n".join(LINES).encode() + b"\nC3|\xff|Q\n")
    with zipfile.ZipFile(tmp_path / "oth.zip", "w") as z:
        z.write(tmp_path / "oth.txt", "itoth.txt")
    text = fec.read_text(spark, "oth", str(tmp_path / "oth.txt"), "2020")
    packed = fec.read_zip(spark, "oth", str(tmp_path / "oth.zip"), "2020")
    key = lambda df: sorted(tuple(r) for r in df.collect())
    assert key(text) == key(packed) and text.count() == 5
    assert text.filter("AMNDT_IND = '' AND CMTE_ID = 'C3'").count() == 1
    assert text.filter(F.col("NAME").contains('"')).count() == 1


def test_load_oth(spark, tmp_path):
    (tmp_path / "oth.txt").write_text("\n".join(LINES))
    raw = fec.read_text(spark, "oth", str(tmp_path / "oth.txt"), "2020")
    assert raw.filter("SUB_ID = 'S1'").count() == 2
    got = {r["SUB_ID"]: r for r in fec.load(raw, "oth").collect()}
    assert set(got) == {"S1", ""}  # persons go, one row for each key stays
    assert tuple(fec.filtered_share(raw).first()) == ("2020", 3, 1)
    assert fec.histogram(raw, "TRANSACTION_TP").count() == 3


def test_last_cycle_wins(spark):
    df = spark.createDataFrame([("C1", "old", "2018"), ("C1", "new", "2020"), ("C2", "x", "2018")], "CMTE_ID string, CMTE_NM string, cycle string")
    assert sorted(map(tuple, fec.latest_fields(df, "CMTE_ID").collect())) == [("C1", "new"), ("C2", "x")]


def test_dump_restore(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, t string")
    root = str(tmp_path)
    assert not store.can_restore(spark, root, "db", "c")
    store.dump(df, root, "db", "c")
    assert store.can_restore(spark, root, "db", "c") and sorted(map(tuple, store.restore(spark, root, "db", "c").collect())) == [(1, "a"), (2, None)]
    assert len(list(store.iterate(df))) == 2
    store.dump_graph(spark, f"{root}/g.json")
    assert store.restore_graph(spark, f"{root}/g.json") == EDGES
    back = store.write_stage(df.withColumn("cycle", F.lit("2020")), f"{root}/stage")
    assert back.filter("cycle = '2020'").count() == 2


def test_shared_folder_is_required_on_a_cluster():
    """Only a local master may do without; others must name the folder."""
    from types import SimpleNamespace

    class Context(SimpleNamespace):
        def getCheckpointDir(self):
            return None

        def setCheckpointDir(self, where):
            self.where = where

    def session(master, where=None):
        return SimpleNamespace(sparkContext=Context(master=master), conf=SimpleNamespace(get=lambda key, default=None: where))

    for master in ("spark://host:7077", "yarn", "local-cluster[3,2,1024]", "k8s://x"):
        with pytest.raises(RuntimeError):
            store.shared_folder(session(master))
        assert store.shared_folder(session(master, "hdfs://x/y")) == "hdfs://x/y"
    for master in ("local", "local[4]", "local[*]", "local[2,3]"):
        one = session(master)
        assert store.shared_folder(one) == one.sparkContext.where


def test_merge_modes(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, t string, u string")
    new = spark.createDataFrame([(2, "B", None), (3, "c", "z")], "id long, t string, u string")
    got = lambda mode: sorted(map(tuple, store.merge(old, new, ["id"], mode).collect()))
    assert got("ignore")[1] == (2, "b", "y")
    assert got("replace")[1] == (2, "B", None)
    assert got("update")[1] == (2, "B", "y")
    with pytest.raises(ValueError):
        got("error")


def test_freshness_and_sql(spark):
    now = datetime(2024, 1, 10)
    assert store.needs_download(now, None, None) and store.needs_download(now, now, None, force=True)
    assert not store.needs_download(now, now - timedelta(days=1), None)
    assert store.needs_download(now, now - timedelta(days=8), None) and store.needs_download(now, now - timedelta(days=1), now)
    df = spark.createDataFrame([(1,), (2,)], "x int")
    assert store.sql(spark, "SELECT * FROM t WHERE x > :least", {"t": df}, least=1).count() == 1


def test_stream_equals_batch(spark):
    d = "/root/testdata/sf0.001"
    batch = events.windowed(spark.read.parquet(f"{d}/events.parquet"))
    q = events.windowed(events.read_stream(spark, d)).writeStream.outputMode("complete").format("memory").queryName("ev").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, spark.table("ev").collect())) == sorted(map(tuple, batch.collect()))


def test_members_file(spark, tmp_path):
    """JSON and YAML give the same members, and the last term is the current one."""
    import json

    from ledgerflow.operators import analysis
    from ledgerflow.sources.members import read_members

    records = [
        {"id": {"bioguide": "B1", "fec": ["H1", "S9"]}, "name": {"first": "Ann", "last": "Lee"}, "bio": {"birthday": "1950-01-02"},
         "terms": [{"type": "rep", "state": "NY", "party": "D", "district": 3, "start": "2001-01-03", "end": "2003-01-03"},
                   {"type": "sen", "state": "NY", "party": "D", "class": 1, "start": "2003-01-03", "end": "2009-01-03", "state_rank": "junior"}]},
        {"id": {"bioguide": "B2"}, "name": {"first": "Bob", "last": "Ray"}, "terms": []},
    ]
    (tmp_path / "m.json").write_text(json.dumps(records))
    got = read_members(spark, str(tmp_path / "m.json"))
    assert [(r["bioguide"], r["fec"], len(r["terms"])) for r in got.orderBy("bioguide").collect()] == [("B1", ["H1", "S9"], 2), ("B2", [], 0)]
    cn = spark.createDataFrame([("H1",)], "CAND_ID string")
    one = analysis.member_mapping(got, cn, spark.createDataFrame([("H1", "C1")], "CAND_ID string, CMTE_ID string")).filter("bioguide = 'B1'").first()
    assert (one["congress"]["chamber"], one["congress"]["class"], one["congress"]["term_start"], one["congress"]["state_rank"]) == ("senate", 1, "2003-01-03", "junior")
    pytest.importorskip("yaml")
    import yaml

    (tmp_path / "m.yaml").write_text(yaml.safe_dump(records))
    assert sorted(map(str, read_members(spark, str(tmp_path / "m.yaml")).collect())) == sorted(map(str, got.collect()))


def test_schema_statement_and_stats(spark, tmp_path):
    from ledgerflow.schemas import ddl

    text = ddl("pas2", "t")
    assert text.count(" STRING") == 22 and "TRANSACTION_AMT STRING COMMENT 'number(14,2)'" in text
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "x.txt").write_text("12345")
    assert [(s["files"], s["bytes"]) for s in store.stats(spark, str(tmp_path / "a"))] == [(1, 5)]
    assert store.stats(spark, str(tmp_path / "none")) == []
