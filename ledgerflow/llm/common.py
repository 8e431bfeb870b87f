"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.sources.store import shared_folder

#: A word is a maximal run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def release() -> None:
    """Hand the worker's free memory back, so that idle Python workers leave the room to the JVM beside them."""
    import ctypes

    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame, *keep: str) -> DataFrame:
    """The columns to work on and one struct `_rest` of all others, so that no other column's name can clash."""
    rest = [F.col(f"`{c}`") for c in docs.columns if c not in keep]
    return docs.select(*keep, (F.struct(*rest) if rest else F.lit(0)).alias("_rest"))


def tie(df: DataFrame) -> Column:
    """A number that follows from the packed columns, to order rows that are otherwise equal the same way in every run."""
    return F.xxhash64(F.to_json("_rest") if df.schema["_rest"].dataType.typeName() == "struct" else F.lit(0))


def unpacked(df: DataFrame, docs: DataFrame, *keep: str) -> list[Column]:
    """The columns of docs again, in their order."""
    return [F.col(c) if c in keep else F.col(f"_rest.`{c}`").alias(c) for c in docs.columns]


#: Shuffle files go when the query that made them ends; materialize() has its rows in the shared folder by then.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Rows that a Python worker gets at once: texts may be very long, and a batch stands in the JVM and in the worker.
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Rows of a join's smaller side in a partition up to which it is built as a hash table, some ten bytes each.
HASH_ROWS = 500_000


def hashed(df: DataFrame, rows: int) -> DataFrame:
    """df as the built side of a hash join where a partition gets few enough of its rows (so many at most), else as it is:
    then the join sorts, and spills where it must."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.hint("SHUFFLE_HASH") if rows <= HASH_ROWS * partitions else df


def materialize(df: DataFrame, batch_bytes: int | None = None) -> DataFrame:
    """Cut the lineage: write df as Parquet into the shared folder and read it back. batch_bytes bounds what a Python worker gets at once.

    Parquet rather than checkpoint(): compressed, columnar, and later reads prune columns. The files go
    when the driver's JVM ends, or with discard().
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/ledgerflow-{uuid.uuid4().hex}"
    schema = df.schema
    conf = {_CLEANUP: "true", _BATCH: "2000"} | ({_BATCH_BYTES: str(batch_bytes)} if batch_bytes else {})
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df.write.parquet(path)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    out = spark.read.schema(schema).parquet(path)
    out._materialized = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete what materialize() wrote for frames that are not read any more."""
    for df in frames:
        if not hasattr(df, "_materialized"):
            continue
        sc = df.sparkSession.sparkContext
        target = sc._jvm.org.apache.hadoop.fs.Path(df._materialized)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


def zip_index(df: DataFrame, order: list[Column], name: str = "idx") -> DataFrame:
    """Add a gapless global index from 0 in the given order, without a window over one partition.

    Range partitioning puts the rows in order over the partitions; a row's place inside its partition is in
    the low 33 bits of monotonically_increasing_id. Only the partitions' row counts reach the driver.
    """
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(ranged.withColumn("_mid", F.monotonically_increasing_id()))
    pid = F.shiftright("_mid", 33)
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(pid.alias("p")).agg(F.count("*").alias("n")).collect())
    starts, total = [], 0
    for p, n in counts:
        starts.append((p, total))
        total += n
    offsets = df.sparkSession.createDataFrame(starts or [(0, 0)], "p long, _start long")
    # one row for each partition: bounded by the number of partitions
    joined = placed.withColumn("p", pid).join(F.broadcast(offsets), "p")
    return joined.withColumn(name, F.col("_start") + F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1))).drop("p", "_start", "_mid")
