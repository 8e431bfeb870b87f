"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, the source's target over its size. The
documents of a source stand in a line, longest first; the expected copies are summed along it, one random
offset is added, and a document is emitted once for each integer boundary that its stretch crosses. The expected
copies being equal, their sum up to a place is the rate times the place. With the line ordered by length the sample is
spread over all lengths: a running sum of copies is less than one off the expected one, so (summation by parts over falling
lengths) the words taken are off the target by less than the source's longest document.

Targets: sources in code point order (null last) weigh 3, 1, 2, repeating, and share 150 % of all words; a
target stops at twice its source's words, the excess being shared again by weight until none is above.

The line is indexed by range partitioning (no window over a source), so a source with a third of all rows is
spread over many tasks. Only a row for each source and partition count is ever gathered: the windows over sources
stand in one task, which suits thousands of sources, not a source for each document.

Defined results: a null text has size 0, so its copies add nothing; rows with a null source form the last
source; ties in length go by doc_id (null first), and repeated rows are separate documents; a source without words
has target 0; an empty table gives an empty mix; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import WORD, materialize, packed, table, tie, unpacked, zip_index

WEIGHTS, SHARE, CAP, SEED = (3, 1, 2), 1.5, 2.0, 17


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def targets(sources: DataFrame, share: float = SHARE, cap: float = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Add target to (source, source_size): water-filling in closed form.

    Without caps the level is total / weight. A source is capped where cap * size / weight lies below the
    level; in the order of that ratio the capped ones come first, so running sums give the level that
    holds after capping the first j. The right j is the first whose level the next source can bear; the level
    rises up to it and falls after it, so it is the greatest of the levels that can be borne.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sources.withColumn("_w", F.element_at(cycle, (F.row_number().over(by_name) - 1) % len(weights) + 1))
    weighed = weighed.withColumn("_most", cap * F.col("source_size")).withColumn("_ratio", F.col("_most") / F.col("_w"))
    before = Window.orderBy("_ratio", F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = share * F.sum("source_size").over(whole)
    level = (total - F.coalesce(F.sum("_most").over(before), F.lit(0.0))) / (
        F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    )
    filled = weighed.withColumn("_level", level)
    filled = filled.withColumn("_level", F.max(F.when(F.col("_ratio") >= F.col("_level"), F.col("_level"))).over(whole))
    target = F.when(F.col("_level").isNull() | (F.col("_ratio") < F.col("_level")), F.col("_most"))
    return filled.select("source", "source_size", target.otherwise(F.col("_w") * F.col("_level")).alias("target"))


def offset(source: Column, seed: int = SEED) -> Column:
    """The random offset of a source in [0, 1); it follows from the seed and the source alone, so reruns agree."""
    name = F.coalesce(F.concat(F.lit("s"), source), F.lit("null"))
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}/"), name)), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def mix(docs: DataFrame, seed: int = SEED, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, source, size, source_size, target, copies (how often the mix emits the row) and the columns to carry."""
    slim = materialize(docs.select("doc_id", "source", n_words(F.col("text")).alias("size"), *carry))
    totals = slim.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_n"))
    aims = targets(totals.select("source", "source_size")).withColumnRenamed("source", "_s")
    counted = totals.select("source", "_n")
    first = Window.orderBy(F.col("source").isNull(), "source").rowsBetween(Window.unboundedPreceding, -1)
    counted = counted.withColumn("_first", F.coalesce(F.sum("_n").over(first), F.lit(0)))
    plan = counted.join(aims, F.col("source").eqNullSafe(F.col("_s"))).drop("_s", "_n")
    plan = plan.withColumn("_rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0)))
    plan = materialize(plan.withColumn("_offset", offset(F.col("source"), seed)))

    order = [F.col("source").isNull(), F.col("source"), F.col("size").desc(), F.col("doc_id"), *[F.col(c) for c in carry]]
    line = zip_index(slim, order, "_i").withColumnRenamed("source", "_src")
    placed = line.join(plan, F.col("_src").eqNullSafe(F.col("source"))).drop("_src")
    at = (F.col("_i") - F.col("_first")).cast("double")
    rate, u = F.col("_rate"), F.col("_offset")
    copies = F.floor(rate * (at + 1) + u) - F.floor(rate * at + u)
    return placed.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), *carry)


def emit(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """The mix itself: each document as often as the mix takes it, with all its columns."""
    own = ("doc_id", "text", "source")
    keyed = packed(docs, *own).withColumn("_d", F.coalesce("doc_id", F.lit((1 << 63) - 1))).withColumn("_th", F.xxhash64("text", "source"))
    copies = mix(keyed, seed, ("_d", "_th")).groupBy("_d", "_th").agg(F.sum("copies").alias("_all"))
    # equal rows share what the mix takes of them
    equal = Window.partitionBy("_d", "_th")
    joined = keyed.join(copies, ["_d", "_th"])
    joined = joined.withColumn("_k", F.count("*").over(equal)).withColumn("_rn", F.row_number().over(equal.orderBy(tie(joined))))
    joined = joined.withColumn("_own", F.floor(F.col("_all") / F.col("_k")) + (F.col("_rn") <= F.col("_all") % F.col("_k")).cast("int"))
    times = F.explode(F.array_repeat(F.lit(0), F.col("_own").cast("int"))).alias("_times")
    joined = joined.select(*own, "_rest", times)
    return joined.select(unpacked(joined, docs, *own))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE_SQL = r"""
WITH slim AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM slim GROUP BY source
), weighed AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS most,
    ([3.0, 1.0, 2.0]::DOUBLE[])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w
  FROM totals
), levels AS (
  SELECT *, most / w AS ratio,
    ((SELECT 1.5::DOUBLE * sum(source_size) FROM totals) - coalesce(sum(most) OVER prior, 0))
      / ((SELECT sum(w) FROM weighed) - coalesce(sum(w) OVER prior, 0)) AS level
  FROM weighed
  WINDOW prior AS (ORDER BY most / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), aims AS (
  SELECT source, source_size,
    CASE WHEN m IS NULL OR ratio < m THEN most ELSE w * m END AS target
  FROM levels, (SELECT max(level) AS m FROM levels WHERE ratio >= level)
), line AS (
  SELECT s.*, a.source_size, a.target, CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0.0::DOUBLE END AS rate,
    CAST(row_number() OVER (PARTITION BY s.source ORDER BY s.size DESC, s.doc_id NULLS FIRST) - 1 AS DOUBLE) AS i
  FROM slim s JOIN aims a ON s.source IS NOT DISTINCT FROM a.source
), tried AS (
  SELECT *, CAST(('0x' || substr(md5('17/' || coalesce('s' || source, 'null')), 1, 8)) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE AS u FROM line
)
SELECT doc_id, size, source_size, target, CAST(floor(rate * (i + 1) + u) - floor(rate * i + u) AS BIGINT) * size AS taken FROM tried
"""
