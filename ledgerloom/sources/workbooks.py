"""First sheets of workbooks (.xlsx), read where they lie.

Spark lists and reads the files, from any storage it can read, one row per workbook; a
task streams each workbook's first sheet out of its archive, row by row, and sends the
rows on in batches. So a task holds one workbook as it is stored and a few thousand of
its rows, and as many tasks work as there are files.

Cells come as text, as a CSV export would have them: numbers in their shortest form,
dates (by the cell's number format) as ISO text, true and false in capitals, errors and
empty cells as NULL. Rows without any cell are left out; ``row_no`` is the sheet's own.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Collection, Iterator, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import drop_name, normalize_header, parse_number, period_from_name
from ledgerloom.session import ship_package

_BATCH = 5000
# fixed values: number formats of the file format that show a date or a time
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _tree(book: zipfile.ZipFile, name: str):
    try:
        return ElementTree.fromstring(book.read(name))
    except KeyError:
        return None


def _texts(book: zipfile.ZipFile) -> list[str]:
    """The shared strings; a string in several formats is put together."""
    out: list[str] = []
    if "xl/sharedStrings.xml" not in book.namelist():
        return out
    with book.open("xl/sharedStrings.xml") as f:
        for _, node in ElementTree.iterparse(f):
            if _local(node.tag) == "si":
                out.append(_string(node))
                node.clear()
    return out


def _string(node) -> str:
    """Text of a string item, without the readings above East Asian signs."""
    skip = {id(t) for r in node.iter() if _local(r.tag) == "rPh" for t in r.iter()}
    return "".join(t.text or "" for t in node.iter() if _local(t.tag) == "t" and id(t) not in skip)


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles that show a date or a time."""
    tree = _tree(book, "xl/styles.xml")
    if tree is None:
        return set()
    own = {}
    for n in tree.iter():
        if _local(n.tag) == "numFmt":
            code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", n.get("formatCode", ""))
            own[int(n.get("numFmtId"))] = bool(re.search(r"[ymdhs]", code, re.IGNORECASE))
    styles = [x for xfs in tree.iter() if _local(xfs.tag) == "cellXfs" for x in xfs]
    ids = [int(x.get("numFmtId", 0)) for x in styles]
    return {i for i, f in enumerate(ids) if own.get(f, f in _DATE_FORMATS)}


def _first_sheet(book: zipfile.ZipFile) -> tuple[str | None, bool]:
    """The archive member of the first sheet; whether dates count from 1904."""
    tree = _tree(book, "xl/workbook.xml")
    links = _tree(book, "xl/_rels/workbook.xml.rels")
    if tree is None or links is None:
        raise ValueError("not a workbook")
    targets = {n.get("Id"): n.get("Target") for n in links}
    old = any(_local(n.tag) == "workbookPr" and n.get("date1904") in ("1", "true") for n in tree.iter())
    for n in tree.iter():
        if _local(n.tag) == "sheet":
            link = next((v for k, v in n.attrib.items() if _local(k) == "id"), None)
            to = targets.get(link, "")
            return (to.lstrip("/") if to.startswith("/") else f"xl/{to}"), old
    return None, old


def _day(number: float, old: bool) -> str:
    """A day number as ISO text; whole days without a time, times without a day."""
    base = dt.datetime(1904, 1, 1) if old else dt.datetime(1899, 12, 30)
    at = base + dt.timedelta(seconds=round(number * 86400))
    if number < 1 and not old:
        return at.time().isoformat()
    return at.date().isoformat() if at.time() == dt.time() else at.isoformat(sep=" ")


def _number(text: str) -> str:
    value = float(text)
    return str(int(value)) if value.is_integer() and abs(value) < 1e15 else repr(value)


def _column(ref: str) -> int:
    n = 0
    for c in ref:
        if not c.isalpha():
            break
        n = 26 * n + ord(c.upper()) - 64
    return n - 1


def sheet_rows(content: bytes) -> Iterator[tuple[int, list[str | None]]]:
    """(row number, cells) of the first sheet, streamed; the first is its header row."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        name, old = _first_sheet(book)
        if name is None:
            return
        texts, dates = _texts(book), _date_styles(book)
        at = 0
        with book.open(name) as f:
            for _, node in ElementTree.iterparse(f):
                if _local(node.tag) != "row":
                    continue
                at = int(node.get("r", at + 1))
                cells: list[str | None] = []
                for c in node:
                    if _local(c.tag) != "c":
                        continue
                    i = _column(c.get("r")) if c.get("r") else len(cells)
                    cells.extend([None] * (i + 1 - len(cells)))
                    cells[i] = _cell(c, texts, dates, old)
                node.clear()
                if any(x is not None and x != "" for x in cells):
                    yield at, cells


def _cell(c, texts: list[str], dates: set[int], old: bool) -> str | None:
    kind = c.get("t", "n")
    if kind == "inlineStr":
        return _string(c)
    value = next((v.text for v in c if _local(v.tag) == "v"), None)
    if value is None or kind == "e":
        return None
    if kind == "s":
        return texts[int(value)]
    if kind == "b":
        return "TRUE" if value.strip() == "1" else "FALSE"
    if kind in ("str", "d"):
        return value
    if int(c.get("s", 0)) in dates:
        return _day(float(value), old)
    return _number(value)


def read_workbooks(spark: SparkSession, path: str | Sequence[str], strip_chars: str | None = None,
                   headers_only: bool = False) -> DataFrame:
    """(file_path, file_mtime, row_no, names, cells) of every row below the header row of
    each workbook's first sheet; ``names`` are its normalised headers. With
    ``headers_only`` the header row itself, as ``cells``; nothing below it is read."""
    ship_package(spark)
    files = spark.read.format("binaryFile").load(path).select("path", "modificationTime", "content")

    def run(batches):
        for b in batches:
            for file, at, content in zip(*(b.column(i) for i in range(3))):
                rows = sheet_rows(content.as_py())
                _, header = next(rows, (0, []))
                names = [normalize_header(h or "", strip_chars) for h in header]
                held: list[tuple[int, list]] = [(0, header)] if headers_only else []
                for row in () if headers_only else rows:
                    held.append((row[0], row[1][:len(names)] + [None] * (len(names) - len(row[1]))))
                    if len(held) >= _BATCH:
                        yield sent(file, at, names, held)
                        held = []
                if held:
                    yield sent(file, at, names, held)

    def sent(file, at, names, rows):
        n, kind = len(rows), pa.list_(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array([file.as_py()] * n, pa.string()), pa.array([at.as_py()] * n, at.type),
             pa.array([r[0] for r in rows], pa.int32()), pa.array([names] * n, kind),
             pa.array([r[1] for r in rows], kind)], names=["file_path", "file_mtime", "row_no", "names", "cells"])

    return files.mapInArrow(run, "file_path string, file_mtime timestamp, row_no int, "
                                 "names array<string>, cells array<string>")


def _value(name: str, numeric: bool, decimal_comma: bool) -> Column:
    """A column by its header: repeated headers are summed if numeric, else the first
    set value counts; NULL where the sheet has no such header."""
    own = F.transform(F.filter(F.arrays_zip("names", "cells"), lambda x: x["names"] == F.lit(name)),
                      lambda x: x["cells"])
    if not numeric:
        return F.get(F.filter(own, lambda v: v.isNotNull()), F.lit(0))
    numbers = F.transform(own, lambda v: parse_number(v, decimal_comma=decimal_comma))
    total = F.aggregate(numbers, F.lit(0.0), lambda s, v: s + F.coalesce(v, F.lit(0.0)))
    return F.when(F.size(own) == 1, F.get(numbers, F.lit(0))).when(F.size(own) > 1, total)


def scan_workbooks(spark: SparkSession, path: str | Sequence[str], template: Sequence[str],
                   numeric: Collection[str] = (), strip_chars: str | None = None,
                   decimal_comma: bool = False) -> tuple[DataFrame, list[tuple[list[str], list[str]]]]:
    """Monthly workbooks by header, as :func:`~ledgerloom.sources.scans.scan_by_header`
    does for CSV: the template's columns, ``row_no`` and the ``file_*`` columns; and
    (header, files) of every layout. One scan, however many layouts there are."""
    wanted = [normalize_header(t, strip_chars) for t in template]
    numbers = {normalize_header(n, strip_chars) for n in numeric}
    rows = read_workbooks(spark, path, strip_chars)
    p = period_from_name(F.col("file_path"))
    out = rows.select(
        *[_value(n, n in numbers, decimal_comma).alias(n) for n in wanted if n != "row_no"], "row_no",
        F.regexp_extract("file_path", r"([^/\\]*)$", 1).alias("file_name"),
        drop_name(F.col("file_path")).alias("file_drop"), "file_mtime",
        p["year"].alias("file_year"), p["month"].alias("file_month"))
    heads = (read_workbooks(spark, path, strip_chars, headers_only=True)
             .groupBy("cells").agg(F.array_sort(F.collect_list("file_path")).alias("files")).collect())
    # one row per distinct header row
    return out, [([h or "" for h in r["cells"]], r["files"]) for r in heads]
