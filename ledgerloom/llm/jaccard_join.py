"""N-gram Jaccard join with Bayesian pruning of candidates.

Documents are sets of shingles of five words (runs of characters other than ASCII white space, as they stand). Two
are linked if the Jaccard similarity of their sets is 0.8 or more.

1. Documents of one set are one vertex, so copies are never compared with each other.
2. Vertices that agree in all MinHash values of a band are candidates: BANDS bands of ROWS values miss a pair at 0.8
   with a probability of 3e-6.
3. The MinHash values of candidates are compared STEP at a time. With m of n equal, a uniform prior makes the
   similarity's posterior Beta(m + 1, n - m + 1); the pair goes once P(similarity >= threshold) < TOLERANCE.
4. What is left is grouped into connected candidates, and within a group the exact similarity of every two vertices
   is computed from their whole sets. So a pair lost in steps 2 or 3 is found all the same if other links join it.

Large buckets and groups are cut into cells (see cells.py): no group is ever in one task, no list of pairs is made,
and what leaves a task is one row per member.

Defined cases. A text with fewer than five words is one shingle of all its words; null texts and texts without words
link with nothing. Rows of one doc_id are one document: they share a class, and each has its own text's links. A
null doc_id has no class and no links. An empty table gives no rows. Other columns are not read. A vertex is known by
64 bits of a 128-bit hash of its set, and shingles by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import cells
from .components import classes, components
from .shared import settle, small_batches, unused

WORDS, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 4
STEP, TOLERANCE = 16, 1e-4
#: Most members in a block of a bucket; of a group of candidates, and most shingles.
BUCKET_BLOCK, GROUP_BLOCK, BLOCK_SHINGLES = 1024, 512, 2_000_000
#: Bytes of text that a worker turns into shingles at once (a longer text is alone).
CHUNK = 2_000_000

U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed scramble of 64-bit numbers."""
    x = (x ^ (x >> U(31))) * U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> U(29))) * U(0xD6E8FEB86659FD93)
    return x ^ (x >> U(32))


_rng = np.random.default_rng(20240607)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = U(0x2545F4914F6CDD1D)
_PERM = _rng.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * U(2) + U(1)
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(n + 1, _BASE, dtype=np.uint64)
    up[0] = 1
    down = np.full(n + 1, U(pow(int(_BASE), -1, 1 << 64)), dtype=np.uint64)
    down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def shingles(texts: list[str | None], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each text, one text after another, sorted; and where each text begins (and the end)."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8)
    ends_of = np.cumsum([len(r) + 1 for r in raw])
    blank = _SPACE[data]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], blank)).view(np.int8)))
    first, stop = edge[::2], edge[1::2]
    up, down = _powers(len(data))
    total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(_BYTE[data] * up[:-1])))
    word = _mix((total[stop] - total[first]) * down[first] + (stop - first).astype(np.uint64))
    doc = np.searchsorted(ends_of, first, side="right")
    held = np.bincount(doc, minlength=len(texts))
    begins = np.concatenate(([0], np.cumsum(held)))
    # a full window in every text with enough words, all words of one with fewer
    place = np.arange(len(word)) - begins[doc]
    left = held[doc] - place
    span = np.minimum(words, held)[doc]
    starts = np.flatnonzero((left >= words) | ((place == 0) & (held[doc] < words)))
    value = np.zeros(len(starts), dtype=np.uint64)
    padded = np.concatenate((word, np.zeros(words, dtype=np.uint64)))
    for k in range(words):
        value = np.where(k < span[starts], _mix(value + padded[starts + k]), value)
    owner = doc[starts]
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    value, owner = value[new], owner[new]
    return value, np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(texts)))))


def chunks(texts: list[str | None]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK characters."""
    start, held = 0, 0
    for k, t in enumerate(texts):
        n = len(t) if t else 0
        if held and held + n > CHUNK:
            yield start, k
            start, held = k, 0
        held += n
    if start < len(texts):
        yield start, len(texts)


def vertex_of(values: np.ndarray) -> int:
    """The name of a set of shingles."""
    return int.from_bytes(xxhash.xxh128_digest(values.astype("<u8").tobytes())[:8], "little", signed=True)


def signatures(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """MinHash values (32 bits) of the sets that have members; a row of zeros for others."""
    out = np.zeros((len(begins) - 1, len(_PERM)), dtype=np.uint32)
    some = np.flatnonzero(np.diff(begins))
    if len(some):
        for k, a in enumerate(_PERM):
            out[some, k] = np.minimum.reduceat(values * a, begins[:-1][some]) >> U(32)
    return out


def need(threshold: float, tolerance: float, step: int = STEP, n: int = BANDS * ROWS) -> list[int]:
    """Equal values that a pair must have after each step: fewer make P(similarity >= threshold) < tolerance."""
    out = []
    for seen in range(step, n + 1, step):
        tail, m = 0.0, -1
        # P(Beta(m + 1, seen - m + 1) >= t) = P(Binomial(seen + 1, t) <= m)
        while tail < tolerance:
            m += 1
            tail += comb(seen + 1, m) * threshold**m * (1 - threshold) ** (seen + 1 - m)
        out.append(m)
    return out


def prune(sig: np.ndarray, a: np.ndarray, b: np.ndarray, needed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The pairs that stay plausible after every step."""
    equal = np.zeros(len(a), dtype=np.int64)
    for k, least in enumerate(needed):
        part = slice(k * STEP, (k + 1) * STEP)
        equal = equal + (sig[a, part] == sig[b, part]).sum(axis=1)
        keep = equal >= least
        a, b, equal = a[keep], b[keep], equal[keep]
        if not len(a):
            break
    return a, b


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, vertex (null without words), number of shingles and MinHash values of every row."""
    small_batches(df.sparkSession)

    def make(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(1).to_pylist()
            for a, b in chunks(texts):
                values, begins = shingles(texts[a:b])
                sig = signatures(values, begins)
                held = np.diff(begins)
                names = [vertex_of(values[s:e]) if e > s else None for s, e in zip(begins[:-1], begins[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(a, b - a), pa.array(names, pa.int64()), pa.array(held, pa.int64()), pa.array([r.tobytes() for r in sig], pa.binary())],
                    names=["doc_id", "vertex", "held", "sig"],
                )

    return df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(make, "doc_id long, vertex long, held long, sig binary")


def _candidates(vertices: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Edges (a, b) between vertices that join all plausible candidates of a bucket."""
    needed = need(threshold, tolerance)
    size = ROWS * 4
    bands = F.array(*[F.xxhash64(F.lit(k), F.substring("sig", k * size + 1, size)) for k in range(BANDS)])
    keyed = vertices.select("vertex", F.explode(bands).alias("bucket"))
    shared = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = keyed.join(shared, "bucket").join(vertices.select("vertex", "sig"), "vertex")
    dealt = cells.deal(met, "bucket", "vertex", F.ceil(F.col("members") / BUCKET_BLOCK))

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in cells.runs(parts, "bucket", 4096):
            sig = cells.binary_matrix(table["sig"], "<u4")
            names, node = np.unique(table["vertex"].to_numpy(), return_inverse=True)
            own, lo, hi = (table[c].to_numpy() for c in ("own", "lo", "hi"))
            label = np.arange(len(names))
            for a, b in cells.pairs(starts, own, lo, hi):
                unknown = label[node[a]] != label[node[b]]  # already joined ones need no second look
                a, b = prune(sig, a[unknown], b[unknown], needed)
                if len(a):
                    more = cells.least_reached(len(names), np.concatenate((label[node[a]], np.arange(len(names)))), np.concatenate((label[node[b]], label)))
                    label = more[label]
            tied = np.flatnonzero(label != np.arange(len(names)))
            yield pa.RecordBatch.from_arrays([pa.array(names[tied]), pa.array(names[label[tied]])], names=["a", "b"])

    return dealt.select("bucket", "own", "lo", "hi", "vertex", "sig").mapInArrow(compare, "a long, b long")


#: A shingle of more members of a cell than this is compared by matrix product, others by listing their pairs.
FREQUENT = 48


def overlaps(values: list[np.ndarray]) -> np.ndarray:
    """Numbers of shingles that each two of the sets share."""
    n = len(values)
    if n <= 6:
        out = np.zeros((n, n), dtype=np.int64)
        for i in range(n):
            for j in range(i + 1, n):
                out[i, j] = out[j, i] = len(np.intersect1d(values[i], values[j], assume_unique=True))
        return out
    flat = np.concatenate(values)
    owner = np.repeat(np.arange(n), [len(v) for v in values])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    first = np.flatnonzero(np.concatenate(([True], flat[1:] != flat[:-1])))
    held = np.diff(np.append(first, len(flat)))
    out = np.zeros(n * n, dtype=np.int64)
    for size in np.unique(held[(held > 1) & (held <= FREQUENT)]).tolist():
        at = owner[first[held == size][:, None] + np.arange(size)]
        i, j = np.triu_indices(size, 1)
        step = max(1, 2_000_000 // len(i))
        for k in range(0, len(at), step):
            out += np.bincount((at[k : k + step][:, i] * n + at[k : k + step][:, j]).ravel(), minlength=n * n)
    out = out.reshape(n, n)
    out = out + out.T
    often = np.flatnonzero(held > FREQUENT)
    for k in range(0, len(often), 4096):
        mine = often[k : k + 4096]
        column = np.repeat(np.arange(len(mine)), held[mine])
        row = np.concatenate([owner[first[m] : first[m] + held[m]] for m in mine.tolist()])
        member = np.zeros((n, len(mine)), dtype=np.float32)
        member[row, column] = 1
        out += (member @ member.T).astype(np.int64)  # counts below 2 ** 24 are exact
    return out


def _verified(members: DataFrame, threshold: float) -> DataFrame:
    """Per vertex and cell: doc_id of the vertex, links counted with copies, and a linked doc_id nearest to the least."""

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, starts in cells.runs(parts, "group_id", 512):
            ids, copies = table["rep"].to_numpy(), table["copies"].to_numpy()
            own, lo, hi = (table[c].to_numpy() for c in ("own", "lo", "hi"))
            sets = [np.frombuffer(v, dtype="<u8") for v in table["values"].to_pylist()]
            links = np.zeros(len(ids), dtype=np.int64)
            least = np.arange(len(ids))
            for s, e in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if e - s < 2:
                    continue
                held = np.array([len(x) for x in sets[s:e]])
                inter = overlaps(sets[s:e])
                linked = inter / np.maximum(1, held[:, None] + held[None, :] - inter) >= threshold
                np.fill_diagonal(linked, False)
                if lo[s] != hi[s]:
                    linked &= own[s:e, None] != own[None, s:e]
                links[s:e] = linked @ copies[s:e]
                a, b = np.nonzero(np.triu(linked))
                least[s:e] = s + cells.least_reached(e - s, a, b)
            yield pa.RecordBatch.from_arrays([table["vertex"].combine_chunks(), pa.array(links), pa.array(ids), pa.array(ids[least])], names=["vertex", "links", "a", "b"])

    return members.mapInArrow(compare, "vertex long, links long, a long, b long")


def join(df: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of df: doc_id, class_id (least doc_id that links reach), n_links (other rows linked directly)."""
    docs = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    prints = settle(fingerprints(docs))
    known = prints.where("vertex is not null and doc_id is not null")
    groups = known.groupBy("vertex").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("copies"), F.max("held").alias("held"))
    named = settle(groups)
    sig = known.join(named.select(F.col("vertex"), F.col("rep").alias("doc_id")), ["vertex", "doc_id"]).select("vertex", "sig").dropDuplicates(["vertex"])
    near = components(_candidates(settle(sig), threshold, tolerance))

    grouped = near.withColumnRenamed("component", "group_id").join(named, "vertex")
    totals = grouped.groupBy("group_id").agg(F.count(F.lit(1)).alias("members"), F.sum("held").alias("all_held"))
    blocks = F.greatest(F.ceil(F.col("members") / GROUP_BLOCK), F.ceil(F.col("all_held") / BLOCK_SHINGLES))
    wanted = grouped.join(totals, "group_id").select("vertex", "rep", "copies", "group_id", blocks.cast("int").alias("blocks"))

    def sets(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column("text").to_pylist()
            names = part.column("vertex").to_pylist()
            for a, b in chunks(texts):
                values, begins = shingles(texts[a:b])
                made = [values[s:e] for s, e in zip(begins[:-1], begins[1:], strict=True)]
                # a doc_id with several texts brings them all; only the one that the vertex names stays
                keep = pa.array([vertex_of(v) == n for v, n in zip(made, names[a:b], strict=True)])
                rest = [part.column(c).slice(a, b - a) for c in ("vertex", "rep", "copies", "group_id", "blocks")]
                out = pa.RecordBatch.from_arrays([*rest, pa.array([v.tobytes() for v in made], pa.binary())], names=["vertex", "rep", "copies", "group_id", "blocks", "values"])
                yield out.filter(keep)

    texts = docs.where("doc_id is not null").join(wanted.withColumn("doc_id", F.col("rep")), "doc_id")
    made = texts.select("vertex", "rep", "copies", "group_id", "blocks", "text").mapInArrow(sets, "vertex long, rep long, copies long, group_id long, blocks int, values binary")
    once = made.withColumn("_n", F.row_number().over(Window.partitionBy("vertex").orderBy("rep"))).where("_n = 1").drop("_n")
    dealt = cells.deal(once, "group_id", "vertex", F.col("blocks"))
    checked = settle(_verified(dealt.select("group_id", "own", "lo", "hi", "vertex", "rep", "copies", "values"), threshold))
    return classes(prints, named, checked)


def keep_one(df: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """df with one row of each class: that of the least doc_id, and of its rows the first by text.

    Rows with a null doc_id, and texts without words, stay as they are.
    """
    found = join(df, threshold).where("doc_id = class_id").select("doc_id").distinct()
    kept = df.join(found, "doc_id")
    n = unused(df, "keep_n")
    first = kept.withColumn(n, F.row_number().over(Window.partitionBy("doc_id").orderBy("text"))).where(F.col(n) == 1)
    return first.select(*df.columns).unionByName(df.where("doc_id is null"))


def sql(threshold: float = THRESHOLD, words: int = WORDS) -> str:
    """The same over a table documents with unique doc_id, as SQL for DuckDB."""
    return f"""
with recursive w as (
  select doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as w from documents where text is not null
), s as (
  select distinct doc_id, unnest(case when len(w) >= {words}
    then list_transform(range(1, len(w) - {words - 2}), lambda i: array_to_string(w[i:i + {words - 1}], ' '))
    else [array_to_string(w, ' ')] end) as g
  from w where len(w) > 0
), n as (
  select doc_id, count(*) as n from s group by doc_id
), c as (
  select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.g = y.g and x.doc_id <> y.doc_id group by 1, 2
), l as (
  select a, b from c join n p on p.doc_id = a join n q on q.doc_id = b where c / (p.n + q.n - c) >= {threshold}
), r as (
  select doc_id as v, doc_id as t from documents
  union
  select l.b as v, r.t from r join l on l.a = r.v
)
select doc_id, (select min(t) from r where v = doc_id) as class_id, (select count(*) from l where a = doc_id) as n_links
from documents
"""
