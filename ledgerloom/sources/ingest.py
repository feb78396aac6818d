"""Ingest: header rows, sheets alike, merging, column mappings."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a header row may hold (fixed values).
HEADER_PATTERNS = ["placing.*no", "client.*name", "policy.*no", "balance", "amount", "premium", "brokerage", "currency|curr", "period.*insurance", "insurance.*type"]
PROBE_ROWS = 20
#: A column that says where in its workbook a row stood.
PLACE = "_place"
#: Columns that the flow adds to a sheet's own.
ADDED = ("_source_sheet", PLACE)
#: Canonical names of the two sides (fixed values).
LEFT_NAMES = ["PlacingNo", "PolicyNo", "ClientName", "Amount"]
RIGHT_NAMES = ["PlacingNo", "PolicyNo_1", "PolicyNo_2", "ClientName", "Amount"]


def header_score(cells: Column) -> Column:
    """How much a row of cells (array of text) looks like a header."""
    full = F.filter(cells, lambda c: c.isNotNull())
    text = F.array_join(full, " ")
    n, all_cells = F.size(full), F.size(cells)
    numbers = F.size(F.filter(full, lambda c: F.trim(c).rlike(r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|infinity|nan)$|^[+-]?(?i:inf|infinity|nan)$")))
    score = F.lit(0)
    for p in HEADER_PATTERNS:
        score = score + text.rlike(f"(?i){p}").cast("int")
    score = score + (n >= 3).cast("int") + (n >= 5).cast("int") + F.coalesce(F.try_divide(n, all_cells) > 0.5, F.lit(False)).cast("int")
    return score + F.when((n - numbers > numbers) & (n - numbers >= 3), 2).otherwise(0)


def header_rows(grid: DataFrame) -> DataFrame:
    """(sheet, header_row) of a grid (sheet, row_idx, cells): the best of the first rows, the earliest of equals.

    A sheet without a row that scores 2 has its header in row 0.
    """
    rated = grid.where(F.col("row_idx") < PROBE_ROWS).select("sheet", "row_idx", header_score(F.col("cells")).alias("score"))
    best = rated.groupBy("sheet").agg(F.max(F.struct("score", (-F.col("row_idx")).alias("at"))).alias("m"))
    return best.select("sheet", F.when(F.col("m.score") >= 2, -F.col("m.at")).otherwise(0).cast("int").alias("header_row"))


def body(grid: DataFrame, header_row: int, names: list[str], place: Column | None = None) -> DataFrame:
    """Rows below the header as columns: without repeated headers and rows that are empty; PLACE is what `place` says."""
    rows = grid.where(F.col("row_idx") > header_row)
    cells = [F.get("cells", F.lit(k)).alias(n) for k, n in enumerate(names)]
    out = rows.select(*cells, *([] if place is None else [place.alias(PLACE)]))
    if header_row > 0:
        out = out.where(~F.col(f"`{names[0]}`").eqNullSafe(F.lit(names[0])))
    return out.where(F.coalesce(*[F.col(f"`{n}`") for n in names]).isNotNull())


def similarity(a: Column, b: Column) -> Column:
    """Share of common names in all names of two arrays, lower-case and trimmed; null where both are empty."""
    clean = lambda c: F.array_distinct(F.transform(c, lambda x: F.lower(F.trim(x))))
    return F.try_divide(F.size(F.array_intersect(clean(a), clean(b))), F.size(F.array_union(clean(a), clean(b))))


def alike(a: list[str], b: list[str], threshold: float = 0.8) -> bool:
    """The same for names at hand."""
    x, y = ({str(n).strip().lower() for n in c} for c in (a, b))
    return bool(x | y) and len(x & y) / len(x | y) >= threshold


def group_sheets(columns: Mapping[str, list[str]], threshold: float = 0.8) -> list[list[str]]:
    """Names of sheets whose columns are like those of the first sheet of their group."""
    groups: list[list[str]] = []
    for name, names in columns.items():
        home = next((g for g in groups if alike(columns[g[0]], names, threshold)), None)
        if home is None:
            groups.append([name])
        else:
            home.append(name)
    return groups


def merge_sheets(sheets: Mapping[str, DataFrame]) -> DataFrame:
    """All sheets below each other with _source_sheet, without rows more than half of whose names are headers again."""
    out = None
    for name, df in sheets.items():
        tagged = df.withColumn("_source_sheet", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    names = [c for c in out.columns if c not in ADDED]
    values = F.array(*[F.lower(F.trim(F.col(f"`{c}`").cast("string"))) for c in names])
    again = F.size(F.array_intersect(F.array(*[F.lit(c.strip().lower()) for c in names]), values))
    return out.where(again * 2 <= len(names))


def read_sheets(sheets: Mapping[str, DataFrame], rows: Mapping[str, int]) -> DataFrame:
    """One sheet as it is, sheets that are all alike merged, else the one with most rows."""
    if len(sheets) == 1:
        return next(iter(sheets.values()))
    if len(group_sheets({n: [c for c in d.columns if c not in ADDED] for n, d in sheets.items()})) == 1:
        return merge_sheets(sheets)
    return sheets[max(sheets, key=lambda n: rows[n])]


def mapping(text: Column) -> Column:
    """Map of column names from JSON that may have commas before closing brackets."""
    return F.from_json(F.regexp_replace(text, r",\s*([}\]])", "$1"), "map<string,string>")


def parse_mapping(text: str) -> dict[str, str]:
    """The same for a text at hand."""
    return json.loads(re.sub(r",\s*([}\]])", r"\1", text))


def hybrid(columns: Column, names: list[str], text: Column) -> Column:
    """Map of source column to canonical name: own names, overlaid by the JSON text, for the columns that exist.

    A text that is null or no JSON overlays nothing.
    """
    custom = F.coalesce(mapping(text), F.create_map().cast("map<string,string>"))
    own = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.lit(n) for n in names]))
    kept = F.map_filter(own, lambda k, _: ~F.map_contains_key(custom, k))
    return F.map_filter(F.map_concat(kept, custom), lambda k, _: F.array_contains(columns, k))


def custom_mapping(text: str | None) -> dict[str, str]:
    """A mapping from JSON text; none if it isn't one."""
    try:
        found = parse_mapping(text) if text else {}
    except ValueError:
        return {}
    return found if isinstance(found, dict) else {}


def matrix_list(items: DataFrame, insurer: str | None = None) -> DataFrame:
    """(rule_id, rule) of a matrix list (folder, position, matrix_key), of one insurer's folder in any case.

    Keys that are null or blank are no rules; a rule's id is its place in the list.
    """
    mine = items if insurer is None else items.where(F.lower("folder") == insurer.lower())
    return mine.where(F.length(F.trim("matrix_key")) > 0).select(F.col("position").alias("rule_id"), F.col("matrix_key").alias("rule"))


def column_mapping(columns: list[str], names: list[str], custom: Mapping[str, str] | None = None) -> dict[str, str]:
    """Source column -> canonical name: own names as they are, overlaid by custom, for columns that exist."""
    return {s: t for s, t in ({n: n for n in names} | dict(custom or {})).items() if s in columns}


def apply_mapping(df: DataFrame, chosen: Mapping[str, str], suffix: str = "") -> DataFrame:
    """df without unnamed columns, renamed; several sources of one name are its first value that isn't null.

    The suffix marks one side's columns where both are shown together.
    """
    kept = [c for c in df.columns if not c.startswith("Unnamed:")]
    sources: dict[str, list[str]] = {}
    for c in kept:
        sources.setdefault(chosen.get(c, c), []).append(c)
    order = list(chosen)
    rank = lambda c: order.index(c) if c in order else len(order)
    return df.select(*[F.coalesce(*[F.col(f"`{c}`") for c in sorted(cs, key=rank)]).alias(f"{name}{suffix}") for name, cs in sources.items()])


def fill_missing(df: DataFrame, names: list[str], value: str | None = None) -> DataFrame:
    """df with every canonical column, missing ones filled."""
    return df.select("*", *[F.lit(value).cast("string").alias(n) for n in names if n not in df.columns])


def check_columns(df: DataFrame, names: list[str]) -> list[str]:
    """Canonical names that df lacks."""
    return [n for n in names if n not in df.columns]
