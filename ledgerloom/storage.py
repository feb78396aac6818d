"""Tables that cut a plan's lineage, kept in the folder that the driver and all executors share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Folders named below the shared one and not yet removed, by application.
_made: dict[str, list[str]] = {}
#: Bytes of compressed files up to which settle() lets Spark choose how to join.
SMALL = 1_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir of the session.

    Only where that is unset and one machine does all (master local, as in tests) a local temporary folder takes its
    place; on a cluster that is an error.
    """
    place = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not place:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            place = current.get()
        elif re.match(r"local(\[|$)", spark.sparkContext.master):
            place = tempfile.mkdtemp(prefix="ledgerloom-")
            spark.sparkContext.setCheckpointDir(place)
        else:
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return place.rstrip("/")


def new_folder(spark: SparkSession, what: str) -> str:
    """A path below the shared folder that nothing else uses; remove() and scratch() delete it."""
    path = f"{shared_dir(spark)}/{what}-{uuid.uuid4().hex}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(df: DataFrame) -> DataFrame:
    """df written to the shared folder and read from there."""
    return _written(df)[0]


def _written(df: DataFrame) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = new_folder(spark, "settled")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def settle(df: DataFrame) -> DataFrame:
    """written(), never held whole by the driver for a join if its files are larger than SMALL.

    Spark takes the size of files for that of their rows, which is ten or twenty times as large for names and ids.
    """
    rows, path = _written(df)
    spark = df.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    large = place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength() > SMALL
    return rows.hint("merge") if large else rows


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that new_folder() named."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
    made = _made.get(spark.sparkContext.applicationId, [])
    if path in made:
        made.remove(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Deletes at its end what was settled inside; results must be written by then."""
    before = set(_made.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        for path in [p for p in _made.get(spark.sparkContext.applicationId, []) if p not in before]:
            remove(spark, path)
