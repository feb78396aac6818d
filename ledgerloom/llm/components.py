"""Connected components of a graph too large for one machine: alternating large-star and small-star steps.

Every step is a sum per vertex and a join on the vertex; a vertex with many neighbours is pre-aggregated before the
shuffle and split by the skew join. After each round the edges are written to the shared folder, so that a lost
executor costs no earlier round. The edges end as stars whose centre is the smallest id of the component.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import settle


def _print(edges: DataFrame) -> tuple[int, int]:
    """Count and sum of hashes, which tell whether a round changed anything."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(vertex, component) for every vertex of edges (a, b); component is the smallest vertex that links reach.

    Vertices without edges aren't in edges and so aren't in the result. Loops and repeated edges do no harm; rows
    with a null end are no edges.
    """
    now = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    now = settle(now)
    before = _print(now)
    for _ in range(most_rounds):
        if not before[0]:
            break
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = now.select(F.col("a").alias("v"), F.col("b").alias("a")).join(least, "a").select(F.col("v").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        centre = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(centre, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        now = settle(small)
        after = _print(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    leaves = now.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "vertex")
    roots = now.select(F.col("b").alias("vertex")).distinct().withColumn("component", F.col("vertex"))
    return leaves.unionByName(roots)


def classes(rows: DataFrame, named: DataFrame, checked: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Per row: its id, class_id (least id that links reach) and n_links (other rows linked directly).

    rows has the id and the vertex of every row (null: links with nothing), named (vertex, rep: its least id,
    copies: its rows), checked (vertex, links, a, b): links counted in copies, possibly in several parts, and a link
    between the ids a and b that, with the others, joins what is linked. Rows of one id with several vertices are one
    thing and share a class.
    """
    links = checked.groupBy("vertex").agg(F.sum("links").alias("links"))
    known = rows.where(F.col("vertex").isNotNull() & F.col(id_column).isNotNull())
    # an id with several vertices ties their least ids together; ids are spread, so this sum has no hot key
    several = known.groupBy(id_column).agg(F.min("vertex").alias("lo"), F.max("vertex").alias("hi")).where("lo <> hi").select(id_column)
    tied = known.join(several, id_column, "left_semi").join(named, "vertex").select(F.col(id_column).alias("a"), F.col("rep").alias("b"))
    found = components(checked.where("a <> b").select("a", "b").unionByName(tied)).withColumnRenamed("vertex", "rep")
    per_vertex = named.join(links, "vertex", "left").join(found, "rep", "left")
    per_vertex = per_vertex.select("vertex", F.coalesce("component", "rep").alias("class_id"), (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    out = rows.select(id_column, F.when(F.col(id_column).isNotNull(), F.col("vertex")).alias("vertex")).join(per_vertex, "vertex", "left")
    return out.select(id_column, F.coalesce("class_id", id_column).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
