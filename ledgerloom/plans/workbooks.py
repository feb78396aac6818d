"""From two workbooks to a report: sheets, headers, mappings, reconciliation, ten tables."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import matrix, report
from ..sources import ingest, xlsx
from ..storage import settle
from . import ledgers, reconcile


#: Rows that a sheet, and sheets that a workbook, may have: powers of 2 that make up a row's place.
ROW_BITS, SHEET_BITS = 21, 12


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """One table of a workbook: its sheets merged if they are alike, else the largest one.

    A sheet's columns are the cells of its header row; unnamed ones are "Unnamed: n", repeated names get a number. The
    column ingest.PLACE rises in the order of sheets and rows; it is 0 for the first row below the first header.
    """
    grid = settle(xlsx.read_grid(spark, path))
    if grid.select("path").distinct().count() > 1:
        raise ValueError(f"{path} holds several workbooks; a ledger is one of them")
    heads = {r["sheet"]: r["header_row"] for r in ingest.header_rows(grid).collect()}
    rows = {r["sheet"]: (r["sheet_idx"], r["count"]) for r in grid.groupBy("sheet", "sheet_idx").count().collect()}
    tables = {}
    for sheet in sorted(heads, key=lambda name: rows[name]):
        at = heads[sheet]
        mine = grid.where(F.col("sheet") == sheet)
        head = mine.where(F.col("row_idx") == at).select("cells").first()
        names: list[str] = []
        for k, cell in enumerate(head["cells"] if head else []):
            name = cell or f"Unnamed: {k}"
            names.append(name if name not in names else f"{name}.{names.count(name)}")
        if names:
            place = F.shiftleft(F.col("sheet_idx").cast("long"), ROW_BITS) + F.col("row_idx") - F.lit(at + 1)
            tables[sheet] = ingest.body(mine, at, names, place)
    if not tables:
        raise ValueError(f"{path} has no sheet with rows")
    return ingest.read_sheets(tables, {name: n for name, (_, n) in rows.items()})


def canonical(df: DataFrame, names: list[str], custom: Mapping[str, str] | None, row: str) -> DataFrame:
    """df under canonical names, with missing ones null, amounts as numbers and a row id.

    The id is the row's place in its workbook, so rows keep their order and rerun alike.
    """
    named = ingest.apply_mapping(df, ingest.column_mapping(df.columns, names, custom)).withColumnRenamed(ingest.PLACE, row)
    full = ingest.fill_missing(named, names).withColumn("Amount", S.to_amount(F.col("Amount")))
    return settle(full.select(row, *[F.col(f"`{c}`") for c in full.columns if c != row]))


def run(
    spark: SparkSession,
    left_path: str,
    right_path: str,
    left_map: Mapping[str, str] | None = None,
    right_map: Mapping[str, str] | None = None,
    profile: reconcile.Profile = reconcile.MODULAR,
    rules: DataFrame | None = None,
    key_columns: tuple[list[str], list[str]] = (ingest.LEFT_NAMES, ingest.RIGHT_NAMES),
) -> dict[str, DataFrame]:
    """The ten tables of the report by sheet name. Passes whose columns aren't there are skipped.

    rules (rule_id, rule) run the matrix pass first; their keys are made of key_columns, those of each side that exist.
    """
    raw_left, raw_right = read_ledger(spark, left_path), read_ledger(spark, right_path)
    have = [{t for t in ingest.column_mapping(d.columns, n, m).values()} for d, n, m in ((raw_left, ingest.LEFT_NAMES, left_map), (raw_right, ingest.RIGHT_NAMES, right_map))]
    left, right = canonical(raw_left, ingest.LEFT_NAMES, left_map, "l_id"), canonical(raw_right, ingest.RIGHT_NAMES, right_map, "r_id")
    used = replace(profile, passes=tuple(p for p in profile.passes if p in reconcile.available_passes(*have)))
    keys = [settle(matrix.keyed(d, i, [c for c in cs if c in d.columns])) if rules is not None else None for d, i, cs in ((left, "l_id", key_columns[0]), (right, "r_id", key_columns[1]))]
    state = reconcile.reconcile(settle(ledgers.clean_left(left)), settle(ledgers.clean_right(right)), used, rules, *keys)
    return report.tables(left, right, *report.final_decisions(state))
