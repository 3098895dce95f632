"""Scans of monthly drops.

Every scan takes a path or glob, so one call reads one month or the whole
history; the period of each row comes from its own file name via the hidden
``_metadata`` column, never from a single driver-side variable.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StructType

from ledgerloom.functions.scalars import (
    drop_name,
    named,
    normalize_header,
    parse_number,
    period_from_name,
    trim_text,
)
from ledgerloom.operators.periods import files_below
from ledgerloom.operators.reshape import merge_repeated_columns, normalize_headers

# fixed values: positional layouts of the two headerless CSV drops
STORE_COSTS_COLUMNS = ["year", "month", "ym", "rcid", "filid", "lagerid", "proekt", "costs"]
DC_COSTS_COLUMNS = ["year", "month", "ym", "rcid", "postid", "lagerid",
                    "costsLogistics", "costsOther", "costs"]

# every cell is read as text and parsed by a guarded helper: the CSV reader itself
# would take the comma of '12,5' for a grouping mark
STORE_COSTS_SCHEMA = ", ".join(f"{c} string" for c in STORE_COSTS_COLUMNS)
DC_COSTS_SCHEMA = ", ".join(f"{c} string" for c in DC_COSTS_COLUMNS)


def with_file_period(df: DataFrame, strict: bool = True) -> DataFrame:
    """Add ``file_name``, ``file_drop``, ``file_year``, ``file_month``, ``file_mtime``.

    ``file_drop`` names the drop (the file, or the dataset folder of ``part-*``
    files); the period is read from it.
    """
    p = period_from_name(F.col("_metadata.file_path"), strict=strict)
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("file_name"),
        drop_name(F.col("_metadata.file_path")).alias("file_drop"),
        F.col("_metadata.file_modification_time").alias("file_mtime"),
        p["year"].alias("file_year"),
        p["month"].alias("file_month"))


def scan_monthly_csv(spark: SparkSession, path: str | Sequence[str], schema: str | StructType,
                     sep: str = ";", header: bool = False, with_period: bool = True) -> DataFrame:
    """Headerless (by default) delimited drop with a declared positional schema.

    A UTF-8 byte-order mark is stripped by the reader; short rows leave the
    trailing columns NULL (permissive mode).
    """
    df = (spark.read.schema(schema)
          .option("sep", sep).option("header", str(header).lower())
          .option("mode", "PERMISSIVE").option("encoding", "UTF-8")
          .csv(path))
    return with_file_period(df) if with_period else df


#: Columns of a quarantine table: the line as it stands in the file, and what is wrong.
REJECT_COLUMNS = ["file_drop", "file_name", "file_year", "file_month", "reason", "line"]


def scan_with_rejects(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str], *,
                      least: int | None = None, numeric: Collection[str] = (), sep: str = ";") -> DataFrame:
    """Headerless drop whose every line is kept: its cells by position as text, and in
    ``reason`` why it is rejected (NULL: it is not).

    * ``too many fields`` / ``too few fields``: more than ``columns``, or fewer than ``least``;
    * ``no number in <column>``: a cell of ``numeric`` that holds text but no number.

    ``line`` is the line itself, for rejected lines only. Empty lines are no rows. Quoted
    cells may hold the separator and doubled quotes, but no line break.
    """
    width, least = len(columns), len(columns) if least is None else least
    lines = with_file_period(spark.read.text(path)).where(trim_text(F.col("value")) != "")
    mark = "\ufeff"  # a byte-order mark before the first line
    raw = F.when(F.col("value").startswith(mark), F.substring(F.col("value"), 2, 2**31 - 1)).otherwise(F.col("value"))
    schema = ", ".join(f"c{i} string" for i in range(width))
    split = (lines.withColumn("line", raw)
             .withColumn("cells", F.from_csv("line", F.lit(schema), {"sep": sep, "escape": '"', "mode": "PERMISSIVE"}))
             # a quoted cell counts as one field whatever it holds
             .withColumn("fields", F.size(F.split(F.regexp_replace("line", '"(?:[^"]|"")*"', "q"), "\\Q" + sep + "\\E", -1))))
    named_cells = split.select("line", "fields", *FILE_COLUMNS, *[
        F.nullif(F.col(f"cells.c{i}"), F.lit("")).alias(c) for i, c in enumerate(columns)])
    wrong = F.when(F.col("fields") > width, F.lit("too many fields")).when(F.col("fields") < least, F.lit("too few fields"))
    for c in columns:
        if c in numeric:
            text = trim_text(named(c))
            wrong = wrong.when((text != "") & parse_number(named(c)).isNull(), F.lit(f"no number in {c}"))
    return (named_cells.withColumn("reason", wrong).drop("fields")
            .withColumn("line", F.when(F.col("reason").isNotNull(), F.col("line"))))


def scan_monthly_table(spark: SparkSession, path: str | Sequence[str], fmt: str = "csv",
                       normalize: bool = True, strip_chars: str | None = None,
                       with_period: bool = True, schema: str | StructType | None = None,
                       **options) -> DataFrame:
    """Headered drop landed as CSV or Parquet (a workbook's first sheet, exported).

    Without a schema every CSV column is read as text; convert with the
    parse helpers so bad cells become NULL instead of failing the scan.
    Headers are normalised (lower case, no whitespace) unless ``normalize=False``.
    Parquet drops of differing layouts are read together: columns that one of them
    lacks are NULL there, and columns whose headers differ in case and spacing only
    are one.
    """
    reader = spark.read.format(fmt)
    if fmt == "parquet" and schema is None:
        reader = reader.option("mergeSchema", "true")
    if fmt == "csv":
        reader = reader.option("header", "true").option("inferSchema", "false")
    if schema is not None:
        reader = reader.schema(schema)
    for k, v in options.items():
        reader = reader.option(k, v)
    df = reader.load(path)
    if with_period:
        df = with_file_period(df)
    if not normalize:
        return df
    plain = [normalize_header(c, strip_chars) for c in df.columns]
    if fmt == "parquet" and len(set(plain)) < len(plain):
        return _one_of_each(df, plain)
    return normalize_headers(df, strip_chars)


def _one_of_each(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Columns of one name as one. Numbers are added up, so that a header that one drop
    repeats counts like a repeated CSV header; what no drop has stays NULL."""
    pos = df.toDF(*[f"__c{i}" for i in range(len(names))])
    own: dict[str, list[int]] = {}
    for i, n in enumerate(names):
        own.setdefault(n, []).append(i)
    cols = []
    for n, at in own.items():
        each = [F.col(f"__c{i}") for i in at]
        if len(at) > 1 and all(isinstance(df.schema.fields[i].dataType, NumericType) for i in at):
            total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0)) for c in each])
            cols.append(F.when(F.coalesce(*each).isNotNull(), total).alias(n))
        else:
            cols.append(F.coalesce(*each).alias(n))
    return pos.select(*cols)


def header_rows(spark: SparkSession, path: str | Sequence[str], sep: str = ",") -> dict[str, list[str]]:
    """First record of every file -> the files that begin with it.

    Only the first kilobytes of a file are read, more if its first record is longer;
    a record goes on over a line break that stands in quotes. Compressed files are
    unpacked as far. What is held are the distinct headers and the file names.
    """
    got: dict[str, list[str]] = {}
    for file in sorted(f for p in ([path] if isinstance(path, str) else path) for f in files_below(spark, p)):
        record = _first_record(spark, file)
        if record is not None:
            got.setdefault(record, []).append(file)
    return got


def _first_record(spark: SparkSession, file: str, start: int = 1 << 13) -> str | None:
    """The first record of a text file without a byte-order mark; None if it is empty."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(file)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
    size = start
    while True:
        stream = p.getFileSystem(conf).open(p)
        try:
            source = codec.createInputStream(stream) if codec is not None else stream
            data = bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(
                jvm.org.apache.commons.io.input.BoundedInputStream(source, size)))
        finally:
            stream.close()
        text = data.decode("utf-8", "ignore").lstrip("\ufeff")
        end, quoted = None, False
        for i, c in enumerate(text):
            if c == '"':
                quoted = not quoted
            elif c in "\r\n" and not quoted:
                end = i
                break
        if end is not None:
            return text[:end]
        if len(data) < size:
            return text or None
        size *= 8


def scan_by_header(spark: SparkSession, path: str | Sequence[str], template: Sequence[str],
                   numeric: Collection[str] = (), sep: str = ",", strip_chars: str | None = None,
                   decimal_comma: bool = False) -> tuple[DataFrame, list[tuple[list[str], list[str]]]]:
    """Headered CSV drops read by name: each file's columns are those of its own header.

    Files with the same normalised header are one scan, so the plan grows with
    the layouts, not with the files. Repeated headers become one column (those in
    ``numeric`` are parsed and summed, else the first set value is kept); a
    template column that a layout lacks is NULL. Returns the rows, with the
    ``file_*`` columns, and (header, files) of every layout.
    """
    wanted = [normalize_header(t, strip_chars) for t in template]
    numbers = {normalize_header(n, strip_chars) for n in numeric}
    layouts: dict[tuple[tuple[str, ...], bool], tuple[list[str], list[str]]] = {}
    for record, files in header_rows(spark, path, sep).items():
        header = next(csv.reader(io.StringIO(record, newline=""), delimiter=sep), [])
        names = tuple(normalize_header(h, strip_chars) for h in header)
        layouts.setdefault((names, "\n" in record or "\r" in record), (header, []))[1].extend(files)
    parts = []
    for (names, broken), (_, files) in sorted(layouts.items()):
        if not names:
            continue
        schema = ", ".join(f"__c{i} string" for i in range(len(names)))
        raw = with_file_period(spark.read.schema(schema).option("sep", sep).option("header", "true")
                               # a header over several lines needs a reader that joins them
                               .option("multiLine", str(broken).lower())
                               .option("enforceSchema", "true").csv(files))
        cells = raw.select(*[
            (parse_number(F.col(f"__c{i}"), decimal_comma=decimal_comma) if n in numbers
             else F.col(f"__c{i}")).alias(n) for i, n in enumerate(names)], *FILE_COLUMNS)
        kinds = ["double" if n in numbers else "string" for n in wanted]
        merged = merge_repeated_columns(cells)
        parts.append(merged.select(
            *[(named(n) if n in names else F.lit(None).cast(k)).alias(n) for n, k in zip(wanted, kinds)],
            *FILE_COLUMNS))
    found = [(header, files) for header, files in layouts.values()]
    if not parts:
        kinds = ", ".join(f"`{n}` {'double' if n in numbers else 'string'}" for n in wanted)
        return spark.createDataFrame([], f"{kinds}, file_name string, file_drop string, "
                                         "file_mtime timestamp, file_year int, file_month int"), found
    return reduce(lambda a, b: a.unionByName(b), parts), found


FILE_COLUMNS = ["file_name", "file_drop", "file_mtime", "file_year", "file_month"]
