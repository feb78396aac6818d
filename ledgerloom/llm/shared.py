"""What several operators of this subpackage use: settled tables, batch sizes, what workers keep, and names that are free."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Hashable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..storage import new_folder
from ..storage import written as settle

__all__ = ["BATCH_ROWS", "held", "new_folder", "settle", "small_batches", "tidy", "unused"]

#: Rows in one Arrow batch. Texts can be long, so a batch must stay small in bytes too.
BATCH_ROWS = 256
#: The key and the value that held() keeps in this process.
_held: list = []


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Python workers get at most so many rows at once (a session setting of Spark, lowered, never raised)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key, "10000"))
    if now <= 0 or now > rows:
        spark.conf.set(key, str(rows))


def tidy() -> None:
    """Give back what earlier tasks left in this Python worker, which Spark uses for one stage after another."""
    _held.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:  # glibc alone has it
        trim(0)


def held(key: Hashable, make: Callable[[], object]):
    """make()'s value, kept from task to task until tidy() or another key: a worker never holds two."""
    if not _held or _held[0] != key:
        tidy()
        _held[:] = [key, make()]
    return _held[1]


def unused(df: DataFrame, name: str) -> str:
    """The name, with underscores behind it until no column of df is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
