"""Exact top-k inner-product search: a ball tree per shard, searched by branch and bound.

The rows are dealt by hash into shards of bounded size; each shard builds a ball tree over its vectors, once for all
queries. Nodes are taken in the order of their upper bound for the inner product, q.c + |q| r, and a node whose bound
is below a query's current k-th score is left out for that query. The k-th score is shared between shards: a first
pass searches each query in one shard only, and the second pass starts every other shard from the score found
there. A shard's vectors come first in its part of the stream and its queries after them in batches, so a task holds one
shard and one batch, however many queries there are, and every vector moves once for a pass.

Defined results: vectors that are null or hold a null or non-finite component take no part, as queries or as
candidates; a missing component at the end counts as 0; rows with the query's own vec_id are not its
candidates; repeated rows are candidates of their own; different vectors under one vec_id are queries of their own, each
with its ranks, and equal ones are one query; ties go to the smaller vec_id, a null vec_id last; a score beyond 64
bits stands at the limit; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import materialize, table

K, EVERY, SCALE = 10, 100, 1024
SHARD_ROWS, LEAF_ROWS = 16384, 48
FOUND = "query_id long, qk long, vec_id long, score long"
NULL_ID = np.iinfo(np.int64).max


def integers(vector) -> np.ndarray | None:
    """floor(SCALE * x) for each component as float64 (exact: a power of two times a double, then floor)."""
    if vector is None or any(x is None for x in vector):
        return None
    v = np.asarray(vector, np.float64)
    if not np.isfinite(v).all():
        return None
    return np.floor(SCALE * v)


def _packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        made = [integers(v) for v in pdf["embedding"]]
        keep = [m is not None for m in made]
        yield pd.DataFrame({"vec_id": pdf["vec_id"][keep], "asks": pdf["asks"][keep], "v": [m.tobytes() for m in made if m is not None]})


def matrix(packed, width: int | None = None) -> np.ndarray:
    """Rows of one width; what lies beyond it meets only zeros."""
    parts = [np.frombuffer(b) for b in packed]
    out = np.zeros((len(parts), max((len(p) for p in parts), default=0) if width is None else width))
    for i, p in enumerate(parts):
        out[i, : len(p)] = p[: out.shape[1]]
    return out


class BallTree:
    def __init__(self, vectors: np.ndarray, ids: np.ndarray, leaf: int = LEAF_ROWS):
        self.vectors, self.ids, self.leaf = vectors, ids, leaf
        self.nodes: list[tuple] = []
        if len(ids):
            self._build(np.argsort(ids, kind="stable"))

    def _build(self, rows: np.ndarray) -> int:
        """Node: centre, radius, rows, children."""
        own = self.vectors[rows]
        centre = own.mean(axis=0)
        away = np.sqrt(((own - centre) ** 2).sum(axis=1))
        at = len(self.nodes)
        self.nodes.append((centre, float(away.max()), rows, None))
        if len(rows) > self.leaf and away.max() > 0:
            one = own[away.argmax()]
            other = own[((own - one) ** 2).sum(axis=1).argmax()]
            along = own @ (other - one)
            order = np.argsort(along, kind="stable")
            half = len(rows) // 2
            parts = [np.sort(order[:half]), np.sort(order[half:])]  # rows stay in the order of their ids
            children = tuple(self._build(rows[p]) for p in parts)
            self.nodes[at] = (*self.nodes[at][:3], children)
        return at


def dot(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact integer inner products, kept inside 64 bits."""
    most = np.abs(q).max(initial=0) * np.abs(v).max(initial=0) * max(1, q.shape[1])
    if most < 2**53:
        return (q @ v.T).astype(np.int64)
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    a = [[int(x) for x in row] for row in q]
    b = [[int(x) for x in row] for row in v]
    return np.array(
        [[min(max(sum(x * y for x, y in zip(r, s, strict=True)), low), high) for s in b] for r in a], np.int64
    ).reshape(len(a), len(b))


def search(tree: BallTree, queries: np.ndarray, own: np.ndarray, least: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, vec_id, score) of each query's k best in the tree that reach least, its k-th score so far."""
    n = len(queries)
    low = np.iinfo(np.int64).min
    scores, ids = np.full((n, k), low), np.full((n, k), NULL_ID)
    filled = np.zeros(n, np.int64)
    least = least.astype(np.float64)
    norms = np.sqrt((queries**2).sum(axis=1))

    def bound(node: int, active: np.ndarray) -> np.ndarray:
        centre, radius = tree.nodes[node][:2]
        q = queries[active]
        slack = 1 + 1e-9 * (norms[active] * (np.sqrt(centre @ centre) + radius))
        # scores stand inside 64 bits, and so do the bounds
        return np.clip(q @ centre + norms[active] * radius + slack, -(2.0**63), 2.0**63)

    heap = [(-np.inf, 0, np.arange(n))] if tree.nodes and n else []
    while heap:
        _, node, active = heapq.heappop(heap)
        active = active[bound(node, active) >= least[active]]
        if not len(active):
            continue
        rows, children = tree.nodes[node][2:]
        if children:
            for child in children:
                up = bound(child, active)
                stay = up >= least[active]
                if stay.any():
                    heapq.heappush(heap, (-float(up[stay].max()), child, active[stay]))
            continue
        got = dot(queries[active], tree.vectors[rows])
        there = tree.ids[rows][None, :].repeat(len(active), 0)
        ok = there != own[active][:, None]
        all_scores = np.concatenate([scores[active], np.where(ok, got, low)], axis=1)
        all_ids = np.concatenate([ids[active], np.where(ok, there, NULL_ID)], axis=1)
        real = np.concatenate([np.arange(k)[None, :] < filled[active][:, None], ok], axis=1)
        order = np.lexsort((all_ids, -all_scores.astype(np.float64), ~real), axis=1)[:, :k]
        if np.abs(all_scores).max() >= 2**53:  # too large for the key above
            order = np.array([sorted(range(len(s)), key=lambda j: (not r[j], -int(s[j]), i[j]))[:k] for s, i, r in zip(all_scores, all_ids, real, strict=True)])
        scores[active] = np.take_along_axis(all_scores, order, 1)
        ids[active] = np.take_along_axis(all_ids, order, 1)
        filled[active] = np.take_along_axis(real, order, 1).sum(axis=1)
        full = active[filled[active] == k]
        least[full] = np.maximum(least[full], scores[full, k - 1])
    q, j = np.nonzero((np.arange(k)[None, :] < filled[:, None]) & (scores.astype(np.float64) >= least[:, None]))
    return q, ids[q, j], scores[q, j]


def _searcher(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shard, held, tree = None, [], None
        for pdf in batches:
            cuts = np.flatnonzero(np.diff(pdf["shard"].to_numpy(), prepend=-1)) if len(pdf) else []
            for part in (pdf.iloc[a:b] for a, b in zip(cuts, [*cuts[1:], len(pdf)], strict=True)):
                if part["shard"].iloc[0] != shard:
                    shard, held, tree = part["shard"].iloc[0], [], None
                asks = part["asks"].to_numpy(bool)
                if not asks.all():
                    held.append(part[~asks][["id", "v"]])
                if not asks.any() or not held:
                    continue
                if tree is None:
                    rows = pd.concat(held)
                    tree = BallTree(matrix(rows["v"]), rows["id"].to_numpy(np.int64))
                block = part[asks]
                own, keys = block["id"].to_numpy(np.int64), block["qk"].to_numpy(np.int64)
                q, ids, scores = search(tree, matrix(block["v"], tree.vectors.shape[1]), own, block["least"].to_numpy(np.float64, na_value=-np.inf), k)
                yield pd.DataFrame({"query_id": own[q], "qk": keys[q], "vec_id": ids, "score": scores})

    return run


def top_k(vectors: DataFrame, is_query, k: int = K, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row where is_query holds."""
    asks = F.coalesce(is_query, F.lit(False)) & F.col("vec_id").isNotNull()
    # a null id would make pandas turn all ids into floating point
    rows = vectors.filter("embedding IS NOT NULL").select(F.coalesce("vec_id", F.lit(int(NULL_ID))).alias("vec_id"), asks.alias("asks"), "embedding")
    packed = materialize(rows.mapInPandas(_packed, "vec_id long, asks boolean, v binary"))
    queries = packed.filter("asks").select("vec_id", "v").dropDuplicates().withColumn("qk", F.xxhash64("v"))
    shards = max(1, -(-packed.count() // shard_rows))
    place = F.pmod(F.xxhash64("vec_id", "v", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    cols = ["shard", "asks", "id", "qk", "v", "least"]
    none = F.lit(None).cast("double").alias("least")
    placed = materialize(packed.select(place.alias("shard"), F.lit(False).alias("asks"), F.col("vec_id").alias("id"), F.lit(0).cast("long").alias("qk"), "v", none))

    def find(rows: DataFrame, ask: DataFrame) -> DataFrame:
        both = rows.select(cols).unionByName(ask.select(cols)).repartition("shard").sortWithinPartitions("shard", "asks")
        return both.mapInPandas(_searcher(k), FOUND)

    asked = queries.select(F.lit(True).alias("asks"), F.col("vec_id").alias("id"), "qk", "v")
    first = asked.withColumn("shard", F.pmod(F.xxhash64("id", F.lit("home")), F.lit(shards)).cast("int")).withColumn("least", none)
    kth = find(placed, first).groupBy("query_id", "qk").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("least"))
    kth = materialize(kth.filter(F.col("n") >= k).select(F.col("query_id").alias("id"), "qk", "least"))
    everywhere = asked.join(kth, ["id", "qk"], "left").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    found = find(placed, everywhere)
    best = Window.partitionBy("query_id", "qk").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    vec_id = F.when(F.col("vec_id") != int(NULL_ID), F.col("vec_id")).alias("vec_id")
    return ranked.select("query_id", "rank", vec_id, "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


ORACLE_SQL = """
WITH ints AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM ints q JOIN ints c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""
