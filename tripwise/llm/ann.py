"""Nearest neighbours by inner product with a forest of hash prefixes.

Vectors are dealt into shards of bounded size.  Each shard's index is a forest:
per tree a long hash string for every vector (signs of random projections) and
the array of the strings in sorted order.  A query descends to the longest
prefix its own string shares with the array, which is a range of it, and
ascends in all trees at once to shorter prefixes, that is longer ranges, for
more candidates.  It stops once a neighbour as close as its k-th best would
share a prefix of this length in some tree with probability ``found``; with
the length at 0 the range is the whole shard.  So near neighbours end the
search early, and queries without any look further, at every size alike.

Queries travel in groups of bounded size, each group meeting every shard; the
best of all shards are merged by rank.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

BITS = 32
LEVELS = (32, 28, 24, 20, 17, 14, 12, 10, 8, 6, 4, 2, 0)
INDEX = "shard int, ids binary, vectors binary, codes binary, orders binary"


# ---- one shard --------------------------------------------------------------

def projections(dimension: int, trees: int, seed: int = 17) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((trees, BITS, dimension))


def hash_strings(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """[trees, vectors] hash strings as 32-bit numbers, first bit highest.
    Only directions count, so vectors need not be scaled."""
    powers = 1 << np.arange(BITS - 1, -1, -1, dtype=np.uint64)
    return np.stack([((vectors @ p.T) > 0) @ powers for p in planes]).astype(np.uint32)


class Forest:
    """Sorted arrays of hash strings over the vectors of one shard."""

    def __init__(self, ids, vectors, codes, orders, planes):
        self.ids, self.vectors, self.codes, self.orders, self.planes = ids, vectors, codes, orders, planes

    @staticmethod
    def build(ids: np.ndarray, vectors: np.ndarray, planes: np.ndarray):
        codes = hash_strings(vectors, planes)
        orders = np.argsort(codes, axis=1, kind="stable").astype(np.int32)
        return Forest(ids, vectors, np.take_along_axis(codes, orders, 1), orders, planes)

    def ranges(self, strings: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
        """[trees, queries] ranges of the arrays that share ``length`` bits."""
        shift = np.uint64(BITS - length)
        low = (strings.astype(np.uint64) >> shift) << shift
        high = low + (np.uint64(1) << shift)
        pair = [np.stack([np.searchsorted(c, x.astype(np.uint64)) for c, x in zip(self.codes.astype(np.uint64), bound)]) for bound in (low, high)]
        return pair[0], pair[1]

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, found: float):
        """(row of the query, vec_id, exact score) of each query's k best."""
        n, trees = len(self.ids), len(self.planes)
        strings = hash_strings(queries, self.planes)
        norms, lengths = np.linalg.norm(self.vectors, axis=1), np.linalg.norm(queries, axis=1)
        longest = float(norms.max()) if n else 0.0
        seen = [np.zeros(0, np.int64)] * len(queries)
        active = np.arange(len(queries))
        best = np.full(len(queries), -np.inf)
        out = [None] * len(queries)
        for level in LEVELS:
            if not len(active):
                break
            if level == 0:
                for part in np.array_split(active, max(1, len(active) * n // 4_000_000)):
                    scores = queries[part] @ self.vectors.T
                    for q, row in zip(part.tolist(), scores):
                        out[q] = self._best(np.arange(n), row, queries[q], query_ids[q], k)
                break
            low, high = self.ranges(strings[:, active], level)
            wide = (high - low).sum(0)
            still = []
            for j, q in enumerate(active.tolist()):
                if wide[j] > n // 2:
                    # So large a union is quicker looked through as a whole.
                    still.append(q)
                    continue
                if wide[j] > len(seen[q]):
                    rows = np.unique(np.concatenate([self.orders[t, low[t, j]:high[t, j]] for t in range(trees)]))
                    seen[q] = rows
                    scores = self.vectors[rows] @ queries[q]
                    out[q] = self._best(rows, scores, queries[q], query_ids[q], k)
                    if len(out[q][0]) >= k:
                        best[q] = out[q][1].min()
                # How surely a vector this close shares the prefix in a tree.
                reach = lengths[q] * longest
                angle = np.arccos(np.clip(best[q] / reach, -1, 1)) if np.isfinite(best[q]) and reach else np.pi
                alike = (1 - angle / np.pi) ** level
                if 1 - (1 - alike) ** trees < found:
                    still.append(q)
            active = np.array(still, np.int64)
        rows = [(np.full(len(r[0]), q), *r) for q, r in enumerate(out) if r is not None]
        if not rows:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        return tuple(np.concatenate(x) for x in zip(*rows))

    def _best(self, rows: np.ndarray, scores: np.ndarray, query: np.ndarray, own: int, k: int):
        """(ids, exact scores) of the k best rows, ties to the smaller id."""
        other = self.ids[rows] != own
        rows, scores = rows[other], scores[other]
        if len(rows) > k:
            # Rounding of a matrix product differs by place: whatever may tie
            # with the k-th is scored again, alike for equal vectors.
            cut = np.partition(scores, len(scores) - k)[len(scores) - k]
            rows = rows[scores >= cut - 1e-9 * max(1.0, abs(cut))]
        scores = (self.vectors[rows] * query).sum(axis=1)
        order = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows][order], scores[order]


# ---- Spark -------------------------------------------------------------------

def usable(rows: DataFrame) -> tuple[DataFrame, int, int]:
    """(vec_id, vector) of the vectors that take part, how many, and their
    dimension (the most frequent one).  Vectors that are null, zero, of another
    length, or hold a null or non-finite component do not; nor do null ids."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    good = (rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"),
                        finite.alias("finite"), F.exists(vector, lambda x: x != 0).alias("some"))
            .filter("vec_id IS NOT NULL AND finite AND some").select("vec_id", "vector"))
    found = good.groupBy(F.size("vector").alias("n")).agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), "n").first()
    if found is None:
        return good, 0, 0
    return good.filter(F.size("vector") == found.n), found.rows, found.n


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def build_index(vectors: DataFrame, count: int, dimension: int, trees: int, shard_rows: int) -> DataFrame:
    """One row per shard: its forest.  Vectors are dealt by a hash of id and
    place in the table, so copies of one row are spread as well."""
    shards = max(1, -(-count // shard_rows))
    planes = projections(dimension, trees)
    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int"))

    def build(key, table):
        chunk = table.combine_chunks()
        ids = chunk.column("vec_id").combine_chunks().to_numpy(zero_copy_only=False)
        forest = Forest.build(ids, _matrix(chunk.column("vector").combine_chunks(), dimension), planes)
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "ids": [ids.astype("<i8").tobytes()],
                         "vectors": [forest.vectors.astype("<f8").tobytes()], "codes": [forest.codes.astype("<u4").tobytes()],
                         "orders": [forest.orders.astype("<i4").tobytes()]})

    return dealt.groupBy("shard").applyInArrow(build, INDEX)


def search(queries: DataFrame, index: DataFrame, shards: int, count: int, dimension: int, trees: int, k: int,
           found: float, group_rows: int) -> DataFrame:
    """query_id, vec_id, score: the k best of every shard for every query."""
    groups = max(1, -(-count // group_rows))
    planes = projections(dimension, trees)

    def gather(key, table):
        chunk = table.combine_chunks()
        ids = chunk.column("vec_id").combine_chunks().to_numpy(zero_copy_only=False)
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "query_ids": [ids.astype("<i8").tobytes()],
                         "queries": [_matrix(chunk.column("vector").combine_chunks(), dimension).astype("<f8").tobytes()]})

    part = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(groups)).cast("int")
    grouped = queries.withColumn("part", part).groupBy("part").applyInArrow(gather, "part int, query_ids binary, queries binary")
    # Each group of queries meets every shard: one row is one bounded piece of work.
    work = (grouped.select("*", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"))
            .join(index.hint("merge"), "shard").select("query_ids", "queries", *index.columns[1:]))

    def run(batches):
        schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
        for batch in batches:
            for row in batch.to_pylist():
                ids, query_ids = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["query_ids"], "<i8")
                asked = np.frombuffer(row["queries"], "<f8").reshape(-1, dimension)
                forest = Forest(ids, np.frombuffer(row["vectors"], "<f8").reshape(-1, dimension),
                                np.frombuffer(row["codes"], "<u4").reshape(trees, -1), np.frombuffer(row["orders"], "<i4").reshape(trees, -1), planes)
                q, near, scores = forest.search(query_ids, asked, k, found)
                yield pa.RecordBatch.from_arrays([pa.array(query_ids[q], pa.int64()), pa.array(near, pa.int64()), pa.array(scores)], schema=schema)

    return work.repartition(max(shards * groups, 1), F.xxhash64("query_ids", "ids")).mapInArrow(run, "query_id long, vec_id long, score double")


def nearest(rows: DataFrame, k: int = 20, every: int = 20, trees: int = 12, found: float = 0.97,
            shard_rows: int = 16_384, group_rows: int = 4096) -> DataFrame:
    """query_id, rank, vec_id, score for the queries vec_id % every == 0.

    A row is never its own neighbour (nor is another row of the same id); rows
    that repeat an id and vector are one candidate and one query.  Fewer
    candidates than ``k`` are all returned; no usable vectors give no rows."""
    spark = rows.sparkSession
    good, count, dimension = usable(rows)
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    common.bounded_batches(spark)
    index = common.written(build_index(good, count, dimension, trees, shard_rows), "ann-index")
    asked = good.filter(F.pmod("vec_id", F.lit(every)) == 0)
    hits = search(asked, index, max(1, -(-count // shard_rows)), max(1, asked.count()), dimension, trees, k, found, group_rows)
    best = hits.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
