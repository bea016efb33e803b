"""Exact top-k search by inner product (operator 8).

Every shard (a partition of the candidates) builds one KD-tree by median
splits, each node with its tight bounding box. A query walks a tree best
first: a box's bound is the largest inner product any point in it could have,
and boxes below the k-th best score known so far are left out. That score is
propagated: queries are first searched among the queries themselves, and every
shard starts from the k-th score found there. Each shard returns its k best;
one window per query merges them.

Queries go to the shards in blocks of at most ``block_queries`` rows, each
read into one bounded broadcast.

Cases: vectors null, empty or holding null or non-finite components take no
part, as query or candidate; vectors whose length differs from the query's are
no candidates for it; fewer than k candidates are all returned; ties go to the
smaller id; a candidate row with the query's own id is the query's own; rows
with a null id take no part; repeated query rows are searched once; unlike
vectors of one query id are all searched and their results ranked together.
Scores must fit 64 bits.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keelson.llm.common import Shared, saved, table

LEAF = 256


class KdTree:
    """Over integer vectors: node arrays, points ordered so that a node is a
    slice; ids ascend within a leaf."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(points))
        self.low, self.high, self.at, self.kids = [], [], [], []
        todo = [(0, len(points), -1)]
        while todo:
            a, b, parent = todo.pop()
            own = points[order[a:b]]
            node = len(self.low)
            lo, hi = own.min(0), own.max(0)
            self.low.append(lo)
            self.high.append(hi)
            self.at.append((a, b))
            self.kids.append([])
            if parent >= 0:
                self.kids[parent].append(node)
            if b - a > leaf and (hi > lo).any():
                mid = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(own[:, np.argmax(hi - lo)], mid)]
                todo += [(a, a + mid, node), (a + mid, b, node)]
        self.points, self.ids = points[order], ids[order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def search(self, q: np.ndarray, own: int, k: int, least: float, best: list[tuple[int, int]]) -> None:
        """Put into the heap ``best`` (score, -id; the worst on top) whatever
        belongs to the k best and isn't below ``least``."""
        bound = np.maximum(q * self.low, q * self.high).sum(1).tolist()
        queue = [(-bound[0], 0)]
        while queue:
            top, node = heapq.heappop(queue)
            floor = max(least, best[0][0]) if len(best) == k else least
            if -top < floor:
                return
            if self.kids[node]:
                for kid in self.kids[node]:
                    if bound[kid] >= floor:
                        heapq.heappush(queue, (-bound[kid], kid))
                continue
            a, b = self.at[node]
            scores = self.points[a:b] @ q
            for i in np.flatnonzero(scores >= floor).tolist():
                if (key := int(self.ids[a + i])) != own:
                    item = (int(scores[i]), -key)
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)


def whole_numbers(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id and floor(scale * component) of the vectors that take part."""
    x = F.col("embedding")
    fine = F.col("vec_id").isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    return vectors.filter(fine).select(F.col("vec_id").cast("long").alias("vec_id"),
                                       F.transform(x, lambda v: F.floor(v.cast("double") * scale)).alias("x"))


def matrices(ids: pa.Array, vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """(ids, matrix of 64-bit integers) by vector length."""
    sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    out = {}
    for d in np.unique(sizes).tolist():
        own = pa.array(np.flatnonzero(sizes == d))
        flat = vectors.take(own).flatten().to_numpy(zero_copy_only=False)
        out[d] = ids.take(own).to_numpy(zero_copy_only=False), flat.reshape(-1, d).astype(np.int64)
    return out


def search_shards(vectors: DataFrame, queries: list, k: int, least: dict[int, float], shard_rows: int) -> DataFrame:
    """Each task's k best for every query of one block. A task takes its rows
    shard by shard; what it has found so far bounds its next shard."""
    spark = vectors.sparkSession
    shared = Shared(spark, (queries, least))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, least = shared.value
        asked = matrices(pa.array([i for i, _ in rows], pa.int64()), pa.array([x for _, x in rows], pa.list_(pa.int64())))
        found: dict[int, list[tuple[int, int]]] = {}
        held: list[pa.RecordBatch] = []

        def search() -> None:
            t = pa.Table.from_batches(held).combine_chunks()
            mine = matrices(t.column(0).combine_chunks(), t.column(1).combine_chunks())
            for d in asked.keys() & mine.keys():
                (q_ids, q_x), (ids, x) = asked[d], mine[d]
                exact = float(np.abs(x).max()) * float(np.abs(q_x).max()) * d < 2**52
                tree = KdTree(x.astype(np.float64) if exact else x, ids)
                for i, q in zip(q_ids.tolist(), q_x.astype(np.float64) if exact else q_x):
                    best = found.setdefault(i, [])
                    tree.search(q, i, k, least.get(i, float("-inf")), best)

        for batch in batches:
            for a in range(0, batch.num_rows, shard_rows):
                held.append(batch.slice(a, shard_rows))
                if sum(b.num_rows for b in held) >= shard_rows:
                    search()
                    held = []
        if held and sum(b.num_rows for b in held):
            search()
        out = [(i, -key, score) for i, best in found.items() for score, key in best]
        columns = [pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))]
        yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return vectors.mapInArrow(run, "query_id long, vec_id long, score long")


def best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: int = 1024, block_queries: int = 4096,
          shard_rows: int = 20_000) -> DataFrame:
    """query_id, rank, vec_id, score for every query row (a subset of the
    vectors' rows, with the same columns)."""
    asked = saved(whole_numbers(queries, scale).dropDuplicates(["vec_id", "x"]))
    n = asked.count()
    candidates = whole_numbers(vectors, scale)
    blocks = max(1, -(-n // block_queries))
    found = None
    for b in range(blocks):
        own = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b)
        rows = [(r["vec_id"], r["x"]) for r in own.toLocalIterator()]
        # the k-th score among the queries themselves bounds every shard's search
        first = best(search_shards(own, rows, k, {}, shard_rows), k).filter(F.col("rank") == k).select("query_id", "score").collect() if rows else []
        part = search_shards(candidates, rows, k, {r["query_id"]: r["score"] for r in first}, shard_rows)
        found = part if found is None else found.union(part)
    return best(found, k).select("query_id", "rank", "vec_id", "score")


def op8(vectors: DataFrame) -> DataFrame:
    return top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8(table(spark, sf_dir, "embeddings"))


SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
WHERE rank <= 10
"""
