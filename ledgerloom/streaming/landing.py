"""Batches from a landing folder: pairs of workbooks with a status, and the same as a stream of files.

A folder's status goes pending -> In Progress -> Manual Review, or Failed where its work raised an error, which is kept
and doesn't stop the folders after it. Statuses are a table that is only appended to; the latest row of a folder counts.
Folders are found at any depth below a root. A folder is taken if it holds exactly two workbooks (.xlsx, which is what
sources.xlsx reads); the one whose name has "cbl" in it is the left ledger.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PENDING, RUNNING, REVIEW, FAILED = "pending", "In Progress", "Manual Review", "Failed"
STATUS = "folder string, status string, at timestamp, note string"


def crawl(spark: SparkSession, root: str) -> DataFrame:
    """(path) of all files below root, at any depth; contents aren't read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")


def latest(statuses: DataFrame) -> DataFrame:
    """(folder, status) by the latest row of each folder."""
    return statuses.groupBy("folder").agg(F.max_by("status", F.struct("at", "status")).alias("status"))


def pending(statuses: DataFrame) -> DataFrame:
    """Folders whose status is pending, in any case."""
    return latest(statuses).where(F.lower(F.trim("status")) == PENDING).select("folder")


def mark(spark: SparkSession, path: str, folder: str, status: str, note: str | None = None) -> None:
    """Append a status."""
    row = spark.createDataFrame([(folder, status, note)], "folder string, status string, note string")
    row.select("folder", "status", F.current_timestamp().alias("at"), "note").write.mode("append").parquet(path)


def ledger_files(files: DataFrame) -> DataFrame:
    """(folder, left, right) of folders of files (path) with exactly two workbooks, one of them the left ledger."""
    named = files.select("path", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"), F.lower(F.regexp_extract("path", r"([^/]*)$", 1)).alias("name"))
    books = named.where(F.col("name").rlike(r"\.xlsx$")).withColumn("is_left", F.contains("name", F.lit("cbl")))
    per = books.groupBy("folder").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_left").alias("n_left"), F.max(F.when(F.col("is_left"), F.col("path"))).alias("left"), F.max(F.when(~F.col("is_left"), F.col("path"))).alias("right"))
    return per.where("n = 2 and n_left = 1").select("folder", "left", "right")


def run_pending(spark: SparkSession, status_path: str, files: DataFrame, work: Callable[[str, str, str], None]) -> list[str]:
    """Run work(folder, left, right) for every pending folder that has its two files; the folders that went well.

    What the driver loops over is one row per waiting folder.
    """
    waiting = ledger_files(files).join(pending(spark.read.schema(STATUS).parquet(status_path)), "folder").orderBy("folder").collect()
    done = []
    for row in waiting:
        mark(spark, status_path, row["folder"], RUNNING)
        try:
            work(row["folder"], row["left"], row["right"])
        except Exception as e:  # whatever went wrong, the next folder is tried
            mark(spark, status_path, row["folder"], FAILED, f"{type(e).__name__}: {e}"[:500])
        else:
            mark(spark, status_path, row["folder"], REVIEW)
            done.append(row["folder"])
    return done


def stream_tiers(spark: SparkSession, source: str, schema: str, target: str, checkpoint: str, tolerance: float = 100):
    """Left and right amounts that arrive as Parquet files, classified; runs until all files that are there are done.

    The files have l_id, r_id, l_amount and r_amount; what is written has diff and tier too.
    """
    from ..functions import scalars as S

    rows = spark.readStream.schema(schema).parquet(source)
    diff = S.difference(F.col("l_amount"), F.col("r_amount"))
    rated = rows.withColumn("diff", diff).withColumn("tier", S.amount_tier(F.col("diff"), tolerance))
    return rated.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
