"""Comparing all members of groups of any size: groups are cut into blocks, and pairs of blocks are the units of work.

A group of k blocks becomes k (k + 1) / 2 cells (lo, hi) with lo <= hi. Each member goes to the k cells of its own
block, so every two members meet in exactly one cell, and no task or worker ever holds a whole large group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def deal(df: DataFrame, key: str, member: str, blocks: Column) -> DataFrame:
    """df with own, lo and hi, one row per cell that needs it, cells whole and together in a partition."""
    counted = df.withColumn("_blocks", F.greatest(F.lit(1), blocks).cast("int"))
    owned = counted.withColumn("own", F.pmod(F.xxhash64(F.col(member)), F.col("_blocks")).cast("int"))
    spread = owned.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    placed = spread.select(*[c for c in df.columns], "own", F.least("own", "_other").alias("lo"), F.greatest("own", "_other").alias("hi"))
    return placed.repartition(key, "lo", "hi").sortWithinPartitions(key, "lo", "hi", member)


def runs(parts: Iterator[pa.RecordBatch], key: str, least_rows: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole cells, of least_rows rows or a little more, with the first row of each cell and the end."""
    held: list[pa.Table] = []
    rows = 0

    def cut(table: pa.Table) -> np.ndarray:
        cols = [table[c].to_numpy() for c in (key, "lo", "hi")]
        change = np.zeros(len(table), dtype=bool)
        change[:1] = True
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(change)

    for part in parts:
        if part.num_rows:
            held.append(pa.Table.from_batches([part]))
            rows += part.num_rows
        if rows >= least_rows:
            table = pa.concat_tables(held).combine_chunks()
            starts = cut(table)
            if len(starts) > 1:  # the last cell may go on in the next batch
                yield table.slice(0, starts[-1]), starts
                table = table.slice(starts[-1])
            held, rows = [table], table.num_rows
            if len(starts) == 1:
                rows = 0  # one cell so far: look again after as many rows
    if held:
        table = pa.concat_tables(held).combine_chunks()
        if len(table):
            yield table, np.append(cut(table), len(table))


def binary_matrix(column: pa.ChunkedArray, dtype: str) -> np.ndarray:
    """Rows of a binary column of equal lengths as the rows of an array."""
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), dtype=dtype).reshape(len(values), -1)


def pairs(starts: np.ndarray, own: np.ndarray, lo: np.ndarray, hi: np.ndarray, most: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows that meet in a cell, at most `most` at a time: within a block, or between the two blocks."""
    begins, sizes = starts[:-1], np.diff(starts)
    small = sizes <= 64
    same = lo[begins] == hi[begins]
    for size in np.unique(sizes[small & same]).tolist():
        if size < 2:
            continue
        i, j = np.triu_indices(size, 1)
        firsts = begins[small & same & (sizes == size)]
        step = max(1, most // len(i))
        for k in range(0, len(firsts), step):
            at = firsts[k : k + step, None]
            yield (at + i).ravel(), (at + j).ravel()
    for begin, size, inside in zip(begins[~(small & same)].tolist(), sizes[~(small & same)].tolist(), same[~(small & same)].tolist(), strict=True):
        rows = np.arange(begin, begin + size)
        left = rows if inside else rows[own[rows] == lo[begin]]
        right = rows if inside else rows[own[rows] == hi[begin]]
        if not len(left) or not len(right):
            continue
        step = max(1, most // len(right))
        for k in range(0, len(left), step):
            a = np.repeat(left[k : k + step], len(right))
            b = np.tile(right, len(left[k : k + step]))
            keep = a < b if inside else slice(None)
            yield a[keep], b[keep]


def least_reached(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest node that the links (a, b) reach from it."""
    label = np.arange(n)
    while len(a):
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            break
    return label
