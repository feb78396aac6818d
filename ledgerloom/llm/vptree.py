"""Approximate nearest neighbours by largest inner product: vantage-point trees, one per shard.

Inner products become distances: with M the largest length in a shard, a vector x gets the further component
sqrt(M^2 - |x|^2) and a query 0, and then |q - x|^2 = |q|^2 + M^2 - 2 q.x. A tree node holds a vantage point and the
median distance to it. With the current k-th distance t, the far side of a node is skipped if the query lies further
than t from the median shell: |d - median| > factor * t. By the triangle inequality, factor 1 skips nothing that could
be nearer, so the search is exact; a smaller factor skips more and finds less. All queries of a block go down the
tree together, and a leaf is compared with those that reach it by one matrix product.

Every row is in exactly one shard (by hash) and is sent there once; every query meets every shard once, and the best k
per shard are merged per query: k rows per query and shard. A shard's tree is built once, before its queries come in
blocks. A shard's rows and a block's queries bound a task's memory.

Scores are the sum of products of the given components in double precision, in order of the components. The matrix
product only preselects, with a slack far above its rounding.

Defined cases. Vectors that are null, zero or hold null or non-finite components, those whose length isn't the most
frequent one among queries, and rows with a null id take no part. Ties go to the smaller vec_id. Rows that repeat an
id are candidates of their own, but never for a query of that id; queries that repeat an id share one result. An empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .itq import usable

#: Rows of a shard, queries of a block and rows of a leaf.
SHARD_ROWS, BLOCK_QUERIES, LEAF = 16_384, 8_192, 256
SLACK = 1e-9


def _exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed component by component."""
    total = np.zeros(len(q))
    for d in range(q.shape[1]):
        total += q[:, d] * x[:, d]
    return total


class VantagePointTree:
    """Exact or relaxed search for the k largest inner products among the rows of one shard."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, leaf: int = LEAF, seed: int = 5):
        order = np.lexsort((*x.T[::-1], ids))  # the same tree whatever order rows come in
        self.ids, self.x = ids[order], x[order]
        square = (self.x**2).sum(axis=1)
        self.longest = square.max(initial=0.0)
        self.lifted = np.column_stack((self.x, np.sqrt(np.maximum(0.0, self.longest - square))))
        self.leaf, self.rng, self.nodes = leaf, np.random.default_rng(seed), []
        self.compared = 0
        self.root = self._build(np.arange(len(ids)))

    def _build(self, rows: np.ndarray) -> int:
        """Index of the node for rows: (rows,) for a leaf, else (vantage point, median, near side, far side)."""
        at = len(self.nodes)
        self.nodes.append((rows,))
        if len(rows) > self.leaf:
            point = self.lifted[rows[self.rng.integers(len(rows))]]
            distance = np.sqrt(((self.lifted[rows] - point) ** 2).sum(axis=1))
            median = np.partition(distance, len(rows) // 2)[len(rows) // 2]
            near = distance < median
            if near.any():  # else more than half of the rows are equally far: they stay one leaf
                self.nodes[at] = (point, median, self._build(rows[near]), self._build(rows[~near]))
        return at

    def search(self, query_ids: np.ndarray, q: np.ndarray, k: int, factor: float = 1.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of queries, ids found and scores, at most k per query, its own id left out."""
        self.query_ids, self.q, self.k, self.factor = query_ids, q, k, factor
        self.square = (q**2).sum(axis=1)
        self.lifted_q = np.column_stack((q, np.zeros(len(q))))
        self.best_score = np.full((len(q), k), -np.inf)
        self.best_id = np.full((len(q), k), np.iinfo(np.int64).max)
        if len(self.ids) and len(q):
            self._visit(self.root, np.arange(len(q)))
        row, place = np.nonzero(self.best_score > -np.inf)
        return row, self.best_id[row, place], self.best_score[row, place]

    def _visit(self, at: int, active: np.ndarray) -> None:
        node = self.nodes[at]
        if len(node) == 1:
            self._scan(node[0], active)
            return
        point, median, near, far = node
        distance = np.sqrt(np.maximum(0.0, ((self.lifted_q[active] - point) ** 2).sum(axis=1)))
        inside = distance < median
        for first, second, mine in ((near, far, inside), (far, near, ~inside)):
            some, gap = active[mine], np.abs(distance[mine] - median)
            if not len(some):
                continue
            self._visit(first, some)
            kth = self.best_score[some, -1]
            reach = np.sqrt(np.maximum(0.0, self.square[some] + self.longest - 2 * kth)) * self.factor
            open_ = gap <= reach + SLACK
            if open_.any():
                self._visit(second, some[open_])

    def _scan(self, rows: np.ndarray, active: np.ndarray) -> None:
        self.compared += len(rows) * len(active)
        step = max(1, 2_000_000 // len(rows))
        for a in range(0, len(active), step):
            some = active[a : a + step]
            score = self.q[some] @ self.x[rows].T
            score[self.query_ids[some, None] == self.ids[rows][None, :]] = -np.inf
            floor = self.best_score[some, -1]
            if score.shape[1] > self.k:  # no more than the k best of this leaf, and ties with the last of them
                floor = np.maximum(floor, np.partition(score, -self.k, axis=1)[:, -self.k])
            i, j = np.nonzero((score >= floor[:, None] - SLACK * (1 + np.abs(floor[:, None]))) & (score > -np.inf))
            if len(i):
                self._merge(some, i, rows[j])

    def _merge(self, some: np.ndarray, i: np.ndarray, row: np.ndarray) -> None:
        touched, i = np.unique(i, return_inverse=True)
        mine = some[touched]
        n, k = len(mine), self.k
        query = np.concatenate((np.repeat(np.arange(n), k), i))
        score = np.concatenate((self.best_score[mine].ravel(), _exact(self.q[mine[i]], self.x[row])))
        found = np.concatenate((self.best_id[mine].ravel(), self.ids[row]))
        order = np.lexsort((found, -score, query))
        query, score, found = query[order], score[order], found[order]
        begins = np.searchsorted(query, np.arange(n))
        top = begins[:, None] + np.arange(k)
        self.best_score[mine], self.best_id[mine] = score[top], found[top]


def _shards(parts: Iterator[pa.RecordBatch], size: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]]:
    """Per shard of a partition its ids, vectors and the blocks of its queries, `most` at a time; blocks are read as asked for."""

    def cut() -> Iterator[tuple[int, bool, np.ndarray, np.ndarray]]:
        for part in parts:
            shard, asks, ids = (part[c].to_numpy(zero_copy_only=False) for c in ("shard", "asks", "vec_id"))
            x = part["vector"].flatten().to_numpy().reshape(len(ids), size)
            edges = [0, *(np.flatnonzero((np.diff(shard) != 0) | (asks[1:] != asks[:-1])) + 1).tolist(), len(ids)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a < b:
                    yield int(shard[a]), bool(asks[a]), ids[a:b], x[a:b]

    runs = cut()
    ahead = next(runs, None)

    def take(shard: int, asks: bool, rows: int | None) -> tuple[np.ndarray, np.ndarray] | None:
        nonlocal ahead
        ids, x, held = [], [], 0
        while ahead is not None and ahead[:2] == (shard, asks) and (rows is None or held < rows):
            ids.append(ahead[2])
            x.append(ahead[3])
            held += len(ahead[2])
            ahead = next(runs, None)
        return (np.concatenate(ids), np.concatenate(x)) if ids else None

    none = np.zeros(0, dtype=np.int64), np.zeros((0, size))
    while ahead is not None:
        shard = ahead[0]
        ids, x = take(shard, False, None) or none
        yield ids, x, iter(lambda shard=shard: take(shard, True, most), None)


def nearest(
    df: DataFrame,
    queries: Column,
    k: int = 20,
    factor: float = 1.0,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    shard_rows: int = SHARD_ROWS,
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """query_id, rank, vec_id and score of the k rows of df nearest to each row that `queries` chooses."""
    rows = df.where(usable(vector) & F.col(vec_id).isNotNull()).select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(queries, F.lit(False)).alias("asks")
    )
    sizes = rows.groupBy(F.size("vector").alias("size")).agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asked"))
    found = sizes.orderBy(F.desc("asked"), F.desc("n"), "size").limit(1).collect()
    size, n, asked = found[0] if found else (0, 0, 0)
    shards = max(1, -(-n // shard_rows))
    same = rows.where(F.size("vector") == size)
    place = F.xxhash64("vec_id")
    held = same.select(F.pmod(place, F.lit(shards)).cast("int").alias("shard"), F.lit(False).alias("asks"), "vec_id", "vector")
    asking = same.where("asks").select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), "asks", "vec_id", "vector")

    def search(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x, queries in _shards(parts, size, block_queries):
            tree = VantagePointTree(ids, x)
            for asked_ids, asked_x in queries:
                row, near, score = tree.search(asked_ids, asked_x, k, factor)
                yield pa.RecordBatch.from_arrays([pa.array(asked_ids[row]), pa.array(near), pa.array(score)], names=["query_id", "vec_id", "score"])

    # a shard's rows come first, its queries after them
    dealt = held.unionByName(asking).repartition("shard").sortWithinPartitions("shard", "asks")
    best = dealt.mapInArrow(search, "query_id long, vec_id long, score double")
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    return ranked.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def sql(divisor: int = 20, k: int = 20) -> str:
    """The exact search over a table embeddings with vectors of one length, as SQL for DuckDB."""
    return f"""
with e as (
  select vec_id, embedding::double[] as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), s as (
  select q.vec_id as query_id, e.vec_id, list_inner_product(q.v, e.v) as score
  from e q join e on q.vec_id <> e.vec_id where q.vec_id % {divisor} = 0
), r as (
  select query_id, row_number() over (partition by query_id order by score desc, vec_id) as rank, vec_id, score from s
)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= {k}
"""
