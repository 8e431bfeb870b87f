"""Stages on disk: Parquet by cycle, gzip JSON dumps with a manifest, the graph's definition, freshness."""

from __future__ import annotations

import json
import re
import tempfile
import uuid
from contextlib import contextmanager
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.schemas import EDGES


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    p, fs = _fs(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def stage_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, which goes when the driver ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    p, fs = _fs(spark, path)
    fs.deleteOnExit(p)
    return path


#: Shuffle files go when the query that made them ends; a stage has its rows in the shared folder by then.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _tidy(spark: SparkSession):
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)


def write_stage(df: DataFrame, path: str, partition: str | None = "cycle") -> DataFrame:
    """Write a stage as Parquet, by cycle where it has one (then a filter on the cycle reads that part alone), and read it back."""
    writer = df.write.mode("overwrite")
    if partition and partition in df.columns:
        # a cycle's rows are dealt out over tasks by hash, so a part holds few files, and no task all rows of a cycle
        parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) // 4)
        keys = [c for c in df.columns if c != partition][:2]
        writer = df.repartition(parts, *keys).write.mode("overwrite").partitionBy(partition)
    with _tidy(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local master may go without; it gets a temporary one."""
    sc = spark.sparkContext
    where = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if where:
        return where
    if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
        raise RuntimeError(f"set spark.checkpoint.dir to a folder that the driver and all executors of {sc.master} share")
    where = tempfile.mkdtemp(prefix="ledgerflow-")
    sc.setCheckpointDir(where)
    return where


def checkpointed(df: DataFrame, name: str = "step") -> DataFrame:
    """Cut the lineage with a table in the shared folder; it goes when the driver ends."""
    path = stage_path(df.sparkSession, name)
    with _tidy(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fingerprint(spark: SparkSession, *paths: str) -> tuple:
    """What tells whether files have changed: their number, length and last modification."""
    out = []
    for path in paths:
        p, fs = _fs(spark, path)
        files = [f for f in (fs.listStatus(p) or []) if f.isFile()] if fs.exists(p) else []
        out.append((path, len(files), sum(f.getLen() for f in files), max((f.getModificationTime() for f in files), default=0)))
    return tuple(out)


def stats(spark: SparkSession, root: str) -> list[dict]:
    """Each folder below root that holds files: their number, bytes and the last modification."""
    p, fs = _fs(spark, root)
    out: dict[str, dict] = {}
    if fs.exists(p):
        files = fs.listFiles(p, True)
        while files.hasNext():
            f = files.next()
            one = out.setdefault(f.getPath().getParent().toString(), {"files": 0, "bytes": 0, "modified": 0})
            one["files"] += 1
            one["bytes"] += f.getLen()
            one["modified"] = max(one["modified"], f.getModificationTime())
    return [{"folder": k} | v for k, v in sorted(out.items())]


def dump(df: DataFrame, root: str, database: str, collection: str) -> None:
    """A gzip JSON dump and its entry in the manifest (one file for each dump, so that writers do not meet)."""
    df.write.mode("overwrite").json(f"{root}/{database}/{collection}", compression="gzip")
    meta = {"database": database, "collection": collection, "schema": df.schema.jsonValue(), "dumped_at": datetime.now(timezone.utc).isoformat()}
    _write_text(df.sparkSession, f"{root}/{database}/{collection}.meta.json", json.dumps(meta))


def manifest(spark: SparkSession, root: str, database: str, collection: str) -> dict | None:
    p, fs = _fs(spark, f"{root}/{database}/{collection}.meta.json")
    if not fs.exists(p):
        return None
    return json.loads(spark.read.text(f"{root}/{database}/{collection}.meta.json", wholetext=True).first()[0])


def restore(spark: SparkSession, root: str, database: str, collection: str) -> DataFrame:
    from pyspark.sql.types import StructType

    meta = manifest(spark, root, database, collection)
    if meta is None:
        raise FileNotFoundError(f"no dump of {database}.{collection} in {root}")
    return spark.read.schema(StructType.fromJson(meta["schema"])).json(f"{root}/{database}/{collection}")


def can_restore(spark: SparkSession, root: str, database: str, collection: str, source: str | None = None) -> bool:
    """A dump exists, is in the manifest, and its source has not changed since."""
    meta = manifest(spark, root, database, collection)
    p, fs = _fs(spark, f"{root}/{database}/{collection}")
    if meta is None or not fs.exists(p):
        return False
    if source is None:
        return True
    s, sfs = _fs(spark, source)
    if not sfs.exists(s):
        return True
    return sfs.getFileStatus(s).getModificationTime() / 1000 <= datetime.fromisoformat(meta["dumped_at"]).timestamp()


def iterate(df: DataFrame):
    """Documents one at a time; partitions come to the driver one by one."""
    for row in df.toLocalIterator():
        yield row.asDict(recursive=True)


def dump_graph(spark: SparkSession, path: str, name: str = "money_flow") -> dict:
    """The graph's definition as JSON, on whatever file system the path names."""
    definition = {"name": name, "edges": {e: {"from": a, "to": b} for e, (a, b) in EDGES.items()}}
    _write_text(spark, path, json.dumps(definition, indent=1))
    return definition


def restore_graph(spark: SparkSession, path: str) -> dict[str, tuple[str, str]]:
    text = spark.read.text(path, wholetext=True).first()[0]
    return {e: (d["from"], d["to"]) for e, d in json.loads(text)["edges"].items()}


def needs_download(now: datetime, local: datetime | None, remote: datetime | None, force: bool = False, max_age_days: int = 7) -> bool:
    """Forced, missing, older than the remote file, or of a certain age."""
    if force or local is None:
        return True
    return (remote is not None and remote > local) or now - local >= timedelta(days=max_age_days)


def merge(old: DataFrame, new: DataFrame, keys: list[str], on_duplicate: str = "error") -> DataFrame:
    """Bulk import: error, ignore (old stays), replace (new wins) or update (new non-null fields win)."""
    from pyspark.sql import functions as F

    if on_duplicate == "error":
        if old.join(new, keys, "left_semi").limit(1).count():
            raise ValueError("duplicate keys")
        return old.unionByName(new, allowMissingColumns=True)
    if on_duplicate == "ignore":
        return old.unionByName(new.join(old, keys, "left_anti"), allowMissingColumns=True)
    if on_duplicate == "replace":
        return old.join(new, keys, "left_anti").unionByName(new, allowMissingColumns=True)
    if on_duplicate == "update":
        a, b = old.alias("a"), new.alias("b")
        both = a.join(b, keys, "full")
        names = [c for c in dict.fromkeys([*old.columns, *new.columns]) if c not in keys]
        pick = [
            F.coalesce(*([F.col(f"b.{c}")] if c in new.columns else []), *([F.col(f"a.{c}")] if c in old.columns else [])).alias(c)
            for c in names
        ]
        return both.select(*keys, *pick)
    raise ValueError(on_duplicate)


def sql(spark: SparkSession, text: str, tables: dict[str, DataFrame], **args) -> DataFrame:
    """Free SQL over given tables with named parameters; nothing is spliced into the text."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=args or None)
