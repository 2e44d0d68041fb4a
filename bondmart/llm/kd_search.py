"""Exact top-k inner products with a KD-tree per shard.

Vectors are dealt to shards of bounded size. In each shard a KD-tree is built
by median splits of the widest dimension, with the tight bounding box of every
node; the shard is one packed row. Queries are packed into blocks. A query
descends a tree best-first: the bound of a box is the largest inner product
that any point in it could have, and a box whose bound is under the kth score
known so far is never opened. Every block is first searched in one shard; the
kth scores found there go along to all other shards as the starting bound.

Scores are exact integers: components become floor(1024 * x), and where
products could leave the exact range of doubles, whole numbers of any size
are used (a score beyond a long is given as the nearest long).

Defined cases: vectors that are null or hold null, NaN or infinite components
take no part, nor do rows with a null id; rows that share an id are one
vector, the least; only vectors of equal length are compared; ties go to the
smaller id; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bondmart.llm.common import column, materialize, ship, table

TOP, EVERY, SCALE = 10, 100, 1024
SHARD_ROWS = 8192    # vectors of a shard, about
BLOCK_ROWS = 4096    # queries of a block, about
LEAF_ROWS = 128
_EXACT = float(1 << 53)
_LONG = (1 << 63) - 1

_PACKED = "dim int, part long, ids binary, data binary, largest double"


def build_tree(data: np.ndarray) -> tuple[np.ndarray, list[tuple[int, int]], list[int], np.ndarray, np.ndarray]:
    """Order of rows; for each node its range in it and its left child (the
    right one follows; -1: a leaf); and the nodes' boxes."""
    order = np.arange(len(data))
    spans, child, low, high = [(0, len(data))], [-1], [], []
    i = 0
    while i < len(spans):
        a, b = spans[i]
        rows = data[order[a:b]]
        lo, hi = rows.min(axis=0), rows.max(axis=0)
        low.append(lo)
        high.append(hi)
        wide = hi - lo
        if b - a > LEAF_ROWS and len(wide) and wide.max() > 0:
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(rows[:, int(wide.argmax())], mid)]
            child[i] = len(spans)
            spans += [(a, a + mid), (a + mid, b)]
            child += [-1, -1]
        i += 1
    return order, spans, child, np.array(low), np.array(high)


class Shard:
    def __init__(self, ids: np.ndarray, data: np.ndarray):
        order, self.spans, self.child, self.low, self.high = build_tree(data)
        self.ids, self.data = ids[order], data[order]

    def search(self, queries: np.ndarray, query_ids: np.ndarray, floors: np.ndarray, k: int):
        """For each query its best (score, -id), at most k, of those not under
        its floor."""
        up, down = np.maximum(queries, 0), np.minimum(queries, 0)
        bounds = up @ self.high.T + down @ self.low.T
        for q in range(len(queries)):
            own, me, best, floor = bounds[q], int(query_ids[q]), [], floors[q]
            heap = [(-own[0], 0)]
            while heap:
                bound, node = heapq.heappop(heap)
                if -bound < floor:  # nor can any other box left
                    break
                left = self.child[node]
                if left >= 0:
                    for c in (left, left + 1):
                        if own[c] >= floor:
                            heapq.heappush(heap, (-own[c], c))
                    continue
                a, b = self.spans[node]
                scores = self.data[a:b] @ queries[q]
                for i in np.flatnonzero(scores >= floor):
                    ident = int(self.ids[a + i])
                    if ident == me:
                        continue
                    item = (int(scores[i]), -ident)
                    if len(best) < k:
                        heapq.heappush(best, item)
                    elif item > best[0]:
                        heapq.heapreplace(best, item)
                if len(best) == k:
                    floor = max(floor, best[0][0])
            yield sorted(best, reverse=True)


def _pack(key: tuple, rows: pa.Table) -> pa.Table:
    ids = rows.column("vec_id").to_numpy()
    values = rows.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    values = np.floor(values.astype(np.float64) * SCALE)
    largest = float(np.abs(values).max(initial=0))
    return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()),
                     pa.array([ids.tobytes()], pa.binary()), pa.array([values.tobytes()], pa.binary()),
                     pa.array([largest], pa.float64())], names=[c.split()[0] for c in _PACKED.split(", ")])


def _blocks(vectors: DataFrame, rows: int, salt: int) -> DataFrame:
    """Packed rows of about ``rows`` vectors of one length each."""
    sizes = vectors.groupBy("dim").count().withColumnRenamed("count", "in_dim")  # a row per length of vectors
    parts = F.ceil(F.col("in_dim") / rows)
    dealt = vectors.join(sizes, "dim").withColumn("part", F.pmod(F.xxhash64("vec_id", F.lit(salt)), parts))
    return dealt.select("dim", "part", "vec_id", "embedding").groupBy("dim", "part").applyInArrow(_pack, _PACKED)


def _unpack(ids: bytes, data: bytes, dim: int, exact: bool) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(ids, np.int64)
    data = np.frombuffer(data, np.float64).reshape(len(ids), dim)
    return ids, data if exact else np.vectorize(int, otypes=[object])(data).reshape(len(ids), dim)


def _search(k: int):
    names = ["query_id", "vec_id", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                exact = r["dim"] * r["largest"] * r["q_largest"] < _EXACT
                shard = Shard(*_unpack(r["ids"], r["data"], r["dim"], exact))
                ids, queries = _unpack(r["q_ids"], r["q_data"], r["dim"], exact)
                known = dict(zip(r["bound_ids"] or (), r["bounds"] or ()))
                # a bound of another range of numbers may have been clamped to a long: then it bounds nothing
                floors = [f if abs(f := known.get(i, -_LONG)) < _LONG else -float("inf") for i in ids.tolist()]
                out = [(int(i), -v, max(-_LONG, min(_LONG, s))) for i, best in zip(
                    ids, shard.search(queries, ids, floors, k)) for s, v in best]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([o[n] for o in out], pa.int64()) for n in range(3)], names)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")  # at most k rows per query and shard
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_inner_products(vectors: DataFrame, every: int = EVERY, k: int = TOP) -> DataFrame:
    """query_id, rank, vec_id, score for the rows of vectors(vec_id,
    embedding) whose id is divisible by ``every``, against all rows."""
    ship(vectors.sparkSession)
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole).select(
        F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding")).withColumn("dim", F.size("embedding"))
    rows = materialize(rows, "vectors")
    shards = materialize(_blocks(rows, SHARD_ROWS, 1), "shards")
    blocks = materialize(_blocks(rows.where(F.col("vec_id") % every == 0), BLOCK_ROWS, 2).select(
        "dim", F.col("part").alias("block"), F.col("ids").alias("q_ids"), F.col("data").alias("q_data"),
        F.col("largest").alias("q_largest")), "queries")
    counts = shards.groupBy("dim").agg(F.max("part").alias("last"))
    none = [F.lit(None).cast("array<long>").alias(c) for c in ("bound_ids", "bounds")]
    first = blocks.join(counts, "dim").withColumn("part", F.pmod("block", F.col("last") + 1))
    seed = first.drop("last").join(shards, ["dim", "part"]).select("*", *none).mapInArrow(
        _search(k), "query_id long, vec_id long, score long")
    seed = materialize(_best(seed, k), "seed")
    held = rows.where(F.col("vec_id") % every == 0).select(
        F.col("vec_id").alias("query_id"), "dim", F.xxhash64("vec_id", F.lit(2)).alias("h"))
    in_dim = held.groupBy("dim").count()
    bounds = seed.where(F.col("rank") == k).join(held, "query_id").join(in_dim, "dim").groupBy(
        "dim", F.pmod("h", F.ceil(F.col("count") / BLOCK_ROWS)).alias("block")).agg(  # a block's own queries
        F.collect_list("query_id").alias("bound_ids"), F.collect_list("score").alias("bounds"))
    rest = first.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), "last"))).where("other <> part")
    rest = rest.drop("part", "last").withColumnRenamed("other", "part").join(bounds, ["dim", "block"], "left")
    found = rest.join(shards, ["dim", "part"]).mapInArrow(_search(k), "query_id long, vec_id long, score long")
    return _best(found.unionByName(seed.drop("rank")), k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def op6_kd_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_inner_products(table(spark, sf_dir, "embeddings"))


OP6_SQL = """
WITH v AS (
  SELECT vec_id, min(embedding) AS embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id
), i AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS e FROM v
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM i q JOIN i c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.e) = len(q.e)
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10
"""
