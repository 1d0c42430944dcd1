"""Workbooks (.xlsx) as rows of cells. Files are read by Spark as bytes, one a task at a time, so any store will do; a
workbook's parts are zipped XML, whose rows are streamed. (Old binary .xls files are not read.)

Cells are text as a reader would show them: whole numbers without a point, dates and times in ISO form by their cell's number
format, TRUE and FALSE; empty cells and errors are NULL. A file that is no workbook has no rows, or raises if `strict`."""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Number formats that show dates or times, of those every workbook has (fixed values).
DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
ROWS = "path string, sheet string, sheet_idx int, row_idx int, cells array<string>"


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _xml(book: zipfile.ZipFile, name: str):
    return ElementTree.fromstring(book.read(name)) if name in book.namelist() else ElementTree.Element("none")


def _is_date(code: str) -> bool:
    """Does a number format show a date or time: one of its letters outside quotes, brackets and escapes."""
    return bool(re.search(r"[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.|_.', "", code.lower())))


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    root = _xml(book, "xl/styles.xml")
    own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in root.iter() if _local(f.tag) == "numFmt"}
    cells = next((e for e in root if _local(e.tag) == "cellXfs"), [])
    formats = [int(x.get("numFmtId", 0)) for x in cells]
    return {i for i, f in enumerate(formats) if (_is_date(own[f]) if f in own else f in DATE_FORMATS)}


def _moment(serial: float, since: dt.datetime) -> str:
    at = since + dt.timedelta(seconds=round(serial * 86400))
    return at.strftime("%H:%M:%S") if serial < 1 else at.strftime("%Y-%m-%d %H:%M:%S")


def _column(place: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", place)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheets(content: bytes) -> Iterator[tuple[str, int, int, list[str | None]]]:
    """(sheet, its number, row number from 0, cells) of a workbook; rows that it leaves out are empty."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared = ["".join(t.text or "" for t in s.iter() if _local(t.tag) == "t") for s in _xml(book, "xl/sharedStrings.xml")]
        dates, top = _date_styles(book), _xml(book, "xl/workbook.xml")
        since = dt.datetime(1904, 1, 1) if any(_local(e.tag) == "workbookPr" and e.get("date1904") in ("1", "true") for e in top) else dt.datetime(1899, 12, 30)
        where = {r.get("Id"): r.get("Target") for r in _xml(book, "xl/_rels/workbook.xml.rels")}

        def text(c) -> str | None:
            kind = c.get("t", "n")
            if kind == "inlineStr":
                return "".join(t.text or "" for t in c.iter() if _local(t.tag) == "t")
            v = next((e.text for e in c if _local(e.tag) == "v"), None)
            if v is None or kind == "e":
                return None
            if kind == "s":
                return shared[int(v)]
            if kind == "b":
                return "TRUE" if v == "1" else "FALSE"
            if kind != "n":
                return v
            x = float(v)
            if int(c.get("s", 0)) in dates:
                return _moment(x, since)
            return str(int(x)) if x == int(x) and abs(x) < 1e15 else repr(x)

        for k, s in enumerate(e for e in top.iter() if _local(e.tag) == "sheet"):
            target = where[next(v for a, v in s.attrib.items() if _local(a) == "id")]
            last = -1
            with book.open(target.lstrip("/") if target.startswith("/") else f"xl/{target}") as f:
                for _, row in ElementTree.iterparse(f):
                    if _local(row.tag) != "row":
                        continue
                    n, cells = int(row.get("r", last + 2)) - 1, []
                    for c in row:
                        at = _column(c.get("r")) if c.get("r") else len(cells)
                        cells += [None] * (at - len(cells)) + [text(c)]
                    for empty in range(last + 1, n):
                        yield s.get("name"), k, empty, []
                    yield s.get("name"), k, n, cells
                    last = n
                    row.clear()


def read_workbooks(spark: SparkSession, path: str, sheet: str | int | None = None, strict: bool = False, pattern: str = "*.xlsx") -> DataFrame:
    """(path, sheet, sheet_idx, row_idx, cells) of all workbooks under `path`, of all sheets or the one named or numbered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.string())]
        names = [c.split()[0] for c in ROWS.split(", ")]
        for b in batches:
            for at, content in zip(b.column("path").to_pylist(), b.column("content"), strict=True):
                rows = []
                try:
                    for row in sheets(content.as_py()):
                        rows.append((at, *row))
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                            rows = []
                except (zipfile.BadZipFile, KeyError, ElementTree.ParseError, StopIteration, ValueError, IndexError) as e:
                    if strict:
                        raise ValueError(f"{at} is no workbook: {e}") from e
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", "content")
    rows = files.mapInArrow(run, ROWS)
    return rows if sheet is None else rows.where(F.col("sheet_idx" if isinstance(sheet, int) else "sheet") == sheet)


def positional(rows: DataFrame, keys: list[str], columns: dict[str, int], start: int = 0) -> DataFrame:
    """(keys, row_idx, columns) of sheets without a header, from row `start` on, each column by its place; rows with none of them go."""
    cells = [F.nullif(F.trim(F.get("cells", F.lit(i))), F.lit("")).alias(c) for c, i in columns.items()]
    return rows.where(F.col("row_idx") >= start).select(*keys, "row_idx", *cells).dropna("all", subset=list(columns))
