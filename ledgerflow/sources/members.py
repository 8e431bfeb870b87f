"""The file of a legislature's members: a list of nested records, as JSON or YAML."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_S = T.StringType()
TERM = T.StructType([T.StructField(n, T.IntegerType() if n in ("class", "district") else _S) for n in ("type", "state", "party", "class", "district", "start", "end", "state_rank")])
RECORD = T.StructType([
    T.StructField("id", T.StructType([T.StructField("bioguide", _S), T.StructField("fec", T.ArrayType(_S))])),
    T.StructField("name", T.StructType([T.StructField(n, _S) for n in ("first", "last", "official_full")])),
    T.StructField("bio", T.MapType(_S, _S)),
    T.StructField("terms", T.ArrayType(TERM)),
])


def read_members(spark: SparkSession, path: str) -> DataFrame:
    """bioguide, name, bio, fec, terms. A YAML file is read on the driver: it holds some hundred records."""
    if path.endswith((".yaml", ".yml")):
        import yaml

        text = spark.read.text(path, wholetext=True).first()[0]
        lines = [(json.dumps(r, default=str),) for r in yaml.safe_load(text) or []]
        rows = spark.createDataFrame(lines, "value string").select(F.from_json("value", RECORD).alias("r")).select("r.*")
    else:
        rows = spark.read.schema(RECORD).json(path, multiLine=True)
    return rows.select(F.col("id.bioguide").alias("bioguide"), "name", "bio", F.coalesce("id.fec", F.array().cast("array<string>")).alias("fec"), "terms")
