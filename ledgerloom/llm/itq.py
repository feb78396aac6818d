"""Embedding near-duplicates: balanced binary codes by iterative quantisation, multi-index Hamming tables, reranking.

1. A rotation is learnt on at most SAMPLE vectors (those of least hash): principal axes, then rotations in turn with
   the nearest corner of the cube, so that the signs make balanced codes.
2. The code of every vector is cut into substrings, one per table. A vector goes to the buckets of its substring and of
   all that differ in one bit, so two vectors meet if any substring differs in two bits or fewer. Those within a radius
   in the whole code are kept.
3. What is kept in a bucket is compared by the cosine of the original vectors in double precision; that gives groups.
4. Within a group every two vectors are compared once more by cosine, for the exact number of links.

Equal vectors are one vertex. Large buckets and groups are cut into cells (see cells.py), so no group is ever in one
task and no list of pairs is made. Spark doesn't see how many rows a substring's buckets make of a vector, so that table
and the vectors are joined by sorting, whatever their size seems to be: the driver never holds them. Of the sample, it
gets few more rows than it keeps.

At a cosine of 0.95 a bit differs with a probability of about 0.1. Substrings have as many bits as the number of vectors
(16 at least, 32 at most), so buckets don't grow with the table, and there are as many tables as find a pair at the
threshold with a probability of RECALL (see design): 4 tables of 16 bits up to 65,536 vectors, 6 of 20 bits for a
million, 12 of 30 bits for 10^9. A pair that step 2 misses is found in step 4 all the same if other links join it.

Defined cases. Vectors that are null, zero or hold null or non-finite components, and those whose length isn't the most
frequent one of the sample, link with nothing and are kept. Rows of one vec_id are one thing: they share a component.
A null vec_id has no component. An empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import acos, ceil, comb, log, pi, sqrt

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import settle
from . import cells
from .components import classes, components

COSINE = 0.95
#: Probability that a pair at the threshold shares a bucket. Bits of a substring at least and at most.
RECALL, WIDTHS = 0.997, (16, 32)
BITS = 64
SAMPLE, TURNS, SEED = 10_000, 40, 11
BUCKET_BLOCK, GROUP_BLOCK = 1024, 1024


def usable(vector: str):
    """Whether a vector takes part: it isn't null or zero and all its components are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very small or large components stay in range
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def design(n: int, cosine: float = COSINE) -> tuple[int, int, int, int]:
    """(bits, tables, width of a substring, radius) of the codes of n vectors."""
    differs = acos(cosine) / pi  # probability that a bit differs at the threshold
    width = min(WIDTHS[1], max(WIDTHS[0], (max(2, n) - 1).bit_length()))
    meets = sum(comb(width, k) * differs**k * (1 - differs) ** (width - k) for k in range(3))
    tables = max(4, ceil(log(1 - RECALL) / log(1 - meets)))
    bits = -(-tables * width // 64) * 64
    return bits, tables, width, int(bits * differs + 3.2 * sqrt(bits * differs * (1 - differs)))


def learn(sample: np.ndarray, bits: int = BITS, turns: int = TURNS, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): the signs of (unit vector - mean) @ projection are the code."""
    x = _unit(sample)
    mean = x.mean(axis=0)
    x = x - mean
    rng = np.random.default_rng(seed)
    _, _, axes = np.linalg.svd(x.T @ x)
    axes = axes[:bits].T
    if axes.shape[1] < bits:  # fewer dimensions than bits: spread them over directions at random first
        axes = axes @ rng.standard_normal((axes.shape[1], bits))
    v = x @ axes
    turn = np.linalg.qr(rng.standard_normal((bits, bits)))[0]
    for _ in range(turns):
        code = np.where(v @ turn >= 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(code.T @ v)
        turn = (left @ right).T
    return mean, axes @ turn


def encode(x: np.ndarray, mean: np.ndarray, projection: np.ndarray) -> np.ndarray:
    """Codes of vectors, as rows of numbers of 64 bits."""
    signs = ((_unit(x) - mean) @ projection) >= 0
    return np.packbits(signs, axis=1, bitorder="little").view("<u8")


def substrings(codes: np.ndarray, tables: int, width: int) -> np.ndarray:
    """The substrings of codes, a column for each table."""
    bits = np.unpackbits(np.ascontiguousarray(codes).view(np.uint8), axis=1, bitorder="little")[:, : tables * width]
    return bits.reshape(len(codes), tables, width).astype(np.int64) @ (np.int64(1) << np.arange(width, dtype=np.int64))


def _matrix(column) -> np.ndarray:
    return cells.binary_matrix(column, "<f4").astype(np.float64)


def _prints(df: DataFrame, size: int, mean: np.ndarray, projection: np.ndarray, tables: int, width: int) -> DataFrame:
    """vec_id, vertex, code, its substrings and the bytes of each usable vector."""

    def make(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            if not part.num_rows:
                continue
            x = np.array(part.column(1).flatten(), dtype="<f4").reshape(part.num_rows, size) + np.float32(0)
            raw = [r.tobytes() for r in x]
            names = [xxhash.xxh64_intdigest(r) - (1 << 63) for r in raw]
            codes = encode(x, mean, projection)
            parts = pa.ListArray.from_arrays(np.arange(len(codes) + 1, dtype=np.int32) * tables, substrings(codes, tables, width).ravel())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(names, pa.int64()), pa.array([c.tobytes() for c in codes], pa.binary()), parts, pa.array(raw, pa.binary())],
                names=["vec_id", "vertex", "code", "parts", "raw"],
            )

    return df.mapInArrow(make, "vec_id long, vertex long, code binary, parts array<long>, raw binary")


def _met(vertices: DataFrame, width: int, radius: int) -> DataFrame:
    """(bucket, vertex) of the vertices that have another one within the radius in that bucket."""
    masks = F.array(*[F.lit(m).cast("long") for m in (0, *(1 << k for k in range(width)))])
    keys = F.transform("parts", lambda p, t: F.transform(masks, lambda m: p.bitwiseXOR(m).bitwiseOR(F.shiftleft(t.cast("long"), 40))))
    keyed = vertices.select("vertex", "code", F.explode(F.flatten(keys)).alias("bucket")).hint("merge")
    held = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    dealt = cells.deal(keyed.join(held, "bucket"), "bucket", "vertex", F.ceil(F.col("members") / BUCKET_BLOCK))

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in cells.runs(parts, "bucket", 8192):
            own, lo, hi = (table[c].to_numpy() for c in ("own", "lo", "hi"))
            code = cells.binary_matrix(table["code"], "<u8")
            near = np.zeros(len(table), dtype=bool)
            for a, b in cells.pairs(starts, own, lo, hi):
                close = np.bitwise_count(code[a] ^ code[b]).sum(axis=1) <= radius
                near[a[close]] = near[b[close]] = True
            yield from table.select(["bucket", "vertex"]).filter(pa.array(near)).to_batches()

    return dealt.select("bucket", "own", "lo", "hi", "vertex", "code").mapInArrow(compare, "bucket long, vertex long").distinct()


def _edges(met: DataFrame, cosine: float) -> DataFrame:
    """Edges (a, b) that join what is linked within a bucket. met: bucket, members, vertex, raw."""
    dealt = cells.deal(met, "bucket", "vertex", F.ceil(F.col("members") / GROUP_BLOCK))

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in cells.runs(parts, "bucket", 2048):
            x = _unit(_matrix(table["raw"]))
            names, node = np.unique(table["vertex"].to_numpy(), return_inverse=True)
            own, lo, hi = (table[c].to_numpy() for c in ("own", "lo", "hi"))
            label = np.arange(len(names))
            for a, b in cells.pairs(starts, own, lo, hi, most=50_000):
                unknown = label[node[a]] != label[node[b]]
                a, b = a[unknown], b[unknown]
                linked = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
                if linked.any():
                    every = np.arange(len(names))
                    more = cells.least_reached(len(names), np.concatenate((label[node[a[linked]]], every)), np.concatenate((label[node[b[linked]]], label)))
                    label = more[label]
            tied = np.flatnonzero(label != np.arange(len(names)))
            yield pa.RecordBatch.from_arrays([pa.array(names[tied]), pa.array(names[label[tied]])], names=["a", "b"])

    return dealt.select("bucket", "own", "lo", "hi", "vertex", "raw").mapInArrow(compare, "a long, b long")


def _verified(members: DataFrame, cosine: float) -> DataFrame:
    """Per vertex and cell: links counted with copies, and links between ids that join what is linked."""

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in cells.runs(parts, "group_id", 512):
            ids, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
            own, lo, hi = (table[c].to_numpy() for c in ("own", "lo", "hi"))
            x = _unit(_matrix(table["raw"]))
            links = np.zeros(len(ids), dtype=np.int64)
            least = np.arange(len(ids))
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if e - s < 2:
                    continue
                linked = x[s:e] @ x[s:e].T >= cosine
                np.fill_diagonal(linked, False)
                if lo[s] != hi[s]:
                    linked &= own[s:e, None] != own[None, s:e]
                links[s:e] = linked @ copies[s:e]
                a, b = np.nonzero(np.triu(linked))
                least[s:e] = s + cells.least_reached(e - s, a, b)
            yield pa.RecordBatch.from_arrays([table["vertex"].combine_chunks(), pa.array(links), pa.array(ids), pa.array(ids[least])], names=["vertex", "links", "a", "b"])

    return members.mapInArrow(compare, "vertex long, links long, a long, b long")


def _sample(good: DataFrame, most: int = SAMPLE) -> list[list[float]]:
    """The vectors of least hash, at most so many. Every partition would send its own ones to the driver, so those of hashes
    that are most likely too large stay behind first."""
    hashed = good.select(F.xxhash64("vec_id").alias("h"), "vector")
    n = good.count()
    below = int((most + 10 * sqrt(most)) / max(n, 1) * (1 << 64)) - (1 << 63)
    least = lambda rows: rows.orderBy("h", F.xxhash64("vector")).select("vector").limit(most).toPandas()["vector"].tolist()
    found = least(hashed.where(F.col("h") < below)) if below < 1 << 63 else []
    return found if len(found) == most else least(hashed)


def near_duplicates(df: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Per row of df: vec_id, n_links, component_id and kept."""
    rows = df.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<float>").alias("vector"))
    good = rows.where(usable("vector"))
    sample = _sample(good)
    if not sample:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    lengths, counts = np.unique([len(v) for v in sample], return_counts=True)
    size = int(lengths[counts.argmax()])
    own = good.where((F.size("vector") == size) & F.col("vec_id").isNotNull())
    bits, tables, width, radius = design(own.count(), cosine)
    mean, projection = learn(np.array([v for v in sample if len(v) == size], dtype=np.float32), bits)

    prints = settle(_prints(own, size, mean, projection, tables, width))
    named = settle(prints.groupBy("vertex").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.min("code").alias("code"), F.min("parts").alias("parts")))
    raw = prints.join(named.select("vertex", F.col("rep").alias("vec_id")), ["vertex", "vec_id"]).select("vertex", "raw").dropDuplicates(["vertex"]).hint("merge")
    met = settle(_met(named, width, radius))
    held = met.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    near = components(_edges(met.join(held, "bucket").join(raw, "vertex"), cosine))

    grouped = near.withColumnRenamed("component", "group_id").join(named, "vertex")
    totals = grouped.groupBy("group_id").agg(F.count(F.lit(1)).alias("members"))
    wanted = grouped.join(totals, "group_id").join(raw, "vertex").select("vertex", "rep", "copies", "group_id", "members", "raw")
    dealt = cells.deal(wanted, "group_id", "vertex", F.ceil(F.col("members") / GROUP_BLOCK))
    checked = settle(_verified(dealt.select("group_id", "own", "lo", "hi", "vertex", "rep", "copies", "raw"), cosine))
    found = classes(prints.select("vec_id", "vertex"), named, checked, "vec_id")
    taken = F.coalesce(usable("vector") & (F.size("vector") == size) & F.col("vec_id").isNotNull(), F.lit(False))
    others = rows.where(~taken)
    alone = others.select("vec_id", F.col("vec_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    whole = found.unionByName(alone)
    return whole.select("vec_id", "n_links", F.col("class_id").alias("component_id"), (F.coalesce(F.col("vec_id") == F.col("class_id"), F.lit(True))).alias("kept"))


def sql(cosine: float = COSINE) -> str:
    """The same over a table embeddings with unique vec_id and vectors of one length, as SQL for DuckDB."""
    return f"""
with recursive e as (
  select vec_id, embedding::double[] as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
), l as (
  select a.vec_id as a, b.vec_id as b from e a join e b on a.vec_id <> b.vec_id
  where list_cosine_similarity(a.v, b.v) >= {cosine}
), r as (
  select vec_id as v, vec_id as t from embeddings
  union
  select l.b as v, r.t from r join l on l.a = r.v
), c as (
  select v, min(t) as t from r group by v
)
select vec_id, (select count(*) from l where a = vec_id) as n_links, c.t as component_id, vec_id = c.t as kept
from embeddings join c on c.v = vec_id
"""
