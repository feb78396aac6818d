"""Workbooks (.xlsx) as a source and a sink, with the standard library alone.

Read: read_grid gives one row per row of a sheet: path, sheet, sheet_idx and row_idx (from 0) and cells (array of text).
Files are read through Spark, so any store will do. Write: write_workbook puts tables into the
sheets of one file; a workbook is one file by nature, so its rows pass through the driver in batches, in bounded
memory, and a report too large for a sheet (1,048,576 rows) raises an error instead of being cut.
"""

from __future__ import annotations

import io
import re
import tempfile
import zipfile
from collections.abc import Iterator, Mapping
from decimal import Decimal
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

# Fixed values of the format.
MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
RELATION = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
MOST_ROWS = 1_048_576
GRID = "path string, sheet string, sheet_idx int, row_idx int, cells array<string>"


def _column(ref: str) -> int:
    """Place (from 0) of a cell reference such as AB12."""
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = 26 * n + ord(c) - 64
    return n - 1


def read_workbook(data: bytes) -> Iterator[tuple[str, int, int, list[str | None]]]:
    """(sheet, sheet_idx, row_idx, cells) of every row of a workbook; rows of a sheet are as wide as its widest."""
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        names = set(z.namelist())
        shared = []
        if "xl/sharedStrings.xml" in names:
            for item in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{MAIN}si"):
                shared.append("".join(t.text or "" for t in item.iter(f"{MAIN}t")))
        targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        for number, sheet in enumerate(ElementTree.fromstring(z.read("xl/workbook.xml")).iter(f"{MAIN}sheet")):
            target = targets[sheet.get(f"{RELATION}id")].lstrip("/")
            path = target if target.startswith("xl/") else f"xl/{target}"
            rows: list[tuple[int, dict[int, str]]] = []
            for row in ElementTree.fromstring(z.read(path)).iter(f"{MAIN}row"):
                cells: dict[int, str] = {}
                for k, cell in enumerate(row.iter(f"{MAIN}c")):
                    at = _column(cell.get("r")) if cell.get("r") else k
                    value = cell.find(f"{MAIN}v")
                    if cell.get("t") == "inlineStr":
                        cells[at] = "".join(t.text or "" for t in cell.iter(f"{MAIN}t"))
                    elif value is not None and value.text is not None:
                        cells[at] = shared[int(value.text)] if cell.get("t") == "s" else value.text
                rows.append((int(row.get("r") or len(rows) + 1) - 1, cells))
            width = max((max(c, default=-1) + 1 for _, c in rows), default=0)
            for at, cells in rows:
                yield sheet.get("name"), number, at, [cells.get(k) or None for k in range(width)]


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    """The cells of all workbooks below path: path, sheet, sheet_idx, row_idx, cells. One task reads a workbook."""

    def rows(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            for name, data in zip(part["path"], part["content"], strict=True):
                found = [(name, *r) for r in read_workbook(data)]
                yield pd.DataFrame(found, columns=["path", "sheet", "sheet_idx", "row_idx", "cells"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "content").mapInPandas(rows, GRID)


def _cell(value) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool) or not isinstance(value, (int, float)) or value != value or value in (float("inf"), float("-inf")):
        text = re.sub(r"[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]", "", str(value))
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(text)}</t></is></c>'
    return f"<c><v>{value!r}</v></c>"


def write_workbook(tables: Mapping[str, DataFrame], target: str, spark: SparkSession | None = None) -> None:
    """One workbook with a sheet per table, written to a local path; with spark to a path of any store it knows."""
    if spark is not None:
        with tempfile.TemporaryDirectory() as folder:  # the driver's own file, moved to the store when it is whole
            write_workbook(tables, f"{folder}/book.xlsx")
            path = spark._jvm.org.apache.hadoop.fs.Path
            path(target).getFileSystem(spark._jsc.hadoopConfiguration()).copyFromLocalFile(False, True, path(f"file:{folder}/book.xlsx"), path(target))
        return
    sheets = list(tables)
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{k}.xml" ContentType="{kind}.worksheet+xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr(
            "[Content_Types].xml",
            '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>{parts}</Types>',
        )
        base = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
        head = '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        z.writestr("_rels/.rels", f'{head}<Relationship Id="rId1" Type="{base}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        listed = "".join(f'<sheet name="{escape(n, {chr(34): "&quot;"})}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(sheets, 1))
        z.writestr("xl/workbook.xml", f'<?xml version="1.0"?><workbook xmlns="{MAIN[1:-1]}" xmlns:r="{base}"><sheets>{listed}</sheets></workbook>')
        links = "".join(f'<Relationship Id="rId{k}" Type="{base}/worksheet" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1))
        z.writestr("xl/_rels/workbook.xml.rels", f"{head}{links}</Relationships>")
        for k, name in enumerate(sheets, 1):
            df, n = tables[name], 1
            with z.open(f"xl/worksheets/sheet{k}.xml", "w") as f:
                f.write(f'<?xml version="1.0"?><worksheet xmlns="{MAIN[1:-1]}"><sheetData>'.encode())
                f.write(("<row>" + "".join(_cell(c) for c in df.columns) + "</row>").encode())
                for row in df.toLocalIterator(prefetchPartitions=True):
                    n += 1
                    if n > MOST_ROWS:
                        raise ValueError(f"{name} has more rows than a sheet holds; write it as Parquet")
                    f.write(("<row>" + "".join(_cell(float(v) if isinstance(v, Decimal) else v) for v in row) + "</row>").encode())
                f.write(b"</sheetData></worksheet>")


def write_tables(tables: Mapping[str, DataFrame], path: str) -> None:
    """The same tables as Parquet, one folder per sheet: the sink for reports of any size."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name.replace(' ', '_')}")
