"""Readers of the raw pipe-delimited files; every file becomes a DataFrame with a cycle column."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.functions.normalize import amount
from ledgerflow.schemas import FIELDS, KEYS, OTH_ENTITIES, raw_schema


def _clean(df: DataFrame, kind: str) -> DataFrame:
    """Missing fields are empty, undecodable bytes go, the line's outer blanks go."""
    names = FIELDS[kind]

    def one(i: int, c: str) -> Column:
        out = F.replace(F.coalesce(F.col(c), F.lit("")), F.lit("�"), F.lit(""))
        out = F.ltrim(out) if i == 0 else out
        return (F.rtrim(out) if i == len(names) - 1 else out).alias(c)

    return df.select(*[one(i, c) for i, c in enumerate(names)], *[c for c in df.columns if c not in names])


def read_text(spark: SparkSession, kind: str, path: str, cycle: str) -> DataFrame:
    """An unpacked file. Short lines are padded, surplus fields and blank lines dropped, quotes kept."""
    raw = spark.read.schema(raw_schema(kind)).csv(path, sep="|", quote="", escape="", header=False, mode="PERMISSIVE")
    return _clean(raw, kind).withColumn("cycle", F.lit(cycle))


def read_zip(spark: SparkSession, kind: str, path: str, cycle: str) -> DataFrame:
    """The first .txt member of each archive. An archive must fit in a task; unpack larger ones and use read_text."""
    names = FIELDS[kind]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for content in pdf["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    member = next((n for n in z.namelist() if n.lower().endswith(".txt")), None)
                    if member is None:
                        continue
                    held: list[list[str]] = []
                    with z.open(member) as f:
                        for line in f:
                            text = line.decode("utf-8", "ignore").strip()
                            if text:
                                parts = text.split("|")[: len(names)]
                                held.append(parts + [""] * (len(names) - len(parts)))
                            if len(held) >= 50_000:
                                yield pd.DataFrame(held, columns=names)
                                held = []
                    if held:
                        yield pd.DataFrame(held, columns=names)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInPandas(run, raw_schema(kind)).withColumn("cycle", F.lit(cycle))


def replace_duplicates(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Of rows with one key the last in the given order stays."""
    last = Window.partitionBy(*keys).orderBy(order.desc())
    return df.withColumn("_rn", F.row_number().over(last)).filter("_rn = 1").drop("_rn")


def load(raw: DataFrame, kind: str, order: Column | None = None) -> DataFrame:
    """Typed and deduplicated rows of one file type: amounts decimal, the date parsed beside its text, the year an int."""
    out = raw
    if "TRANSACTION_AMT" in raw.columns:
        out = out.withColumn("TRANSACTION_AMT", amount(F.col("TRANSACTION_AMT")))
        out = out.withColumn("TRANSACTION_DATE", F.try_to_timestamp("TRANSACTION_DT", F.lit("MMddyyyy")).cast("date"))
    if kind == "cn":
        out = out.withColumn("CAND_ELECTION_YR", F.col("CAND_ELECTION_YR").try_cast("int"))
    if kind == "ccl":
        out = out.withColumn("key", F.concat_ws("_", "CAND_ID", "CMTE_ID", "LINKAGE_ID"))
    if kind == "oth":
        out = out.filter(F.col("ENTITY_TP").isin(OTH_ENTITIES))
    keys = ["cycle", *KEYS[kind]]
    order = order if order is not None else F.struct(*[F.col(c) for c in sorted(raw.columns)])
    return replace_duplicates(out, keys, order) if out.columns else out


def filtered_share(raw_oth: DataFrame) -> DataFrame:
    """How many rows the entity filter keeps and drops, by cycle."""
    kept = F.coalesce(F.col("ENTITY_TP").isin(OTH_ENTITIES), F.lit(False))
    return raw_oth.groupBy("cycle").agg(F.count_if(kept).alias("kept"), F.count_if(~kept).alias("filtered_out"))


def histogram(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy("cycle", column).agg(F.count("*").alias("n"))


def latest_fields(df: DataFrame, key: str) -> DataFrame:
    """One row for each key with the fields of its last cycle."""
    others = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*others), "cycle").alias("s")
    return df.groupBy(key).agg(best).select(key, *[F.col(f"s.{c}") for c in others if c != "cycle"])
