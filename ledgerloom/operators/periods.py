"""A target whose periods are replaced in one commit.

:class:`PeriodTable` keeps the rows of every load in a folder of its own and names, in
one small file per version, which load holds which month. Replacing months, clearing
months and remembering which drop a month came from are one new version, published by
one rename. A reader takes the newest version and so sees all of a load or nothing of
it; a load that dies leaves a folder that no version names. Which months a load has
rows for is read from the folders it has written, not from job metrics.

``<root>/data/load=<id>/<year>=2026/<month>=5/part-*``   rows of a load
``<root>/versions/000000000007.json``                     months -> load, drop; schema

A version file has one entry per month, so it stays small however large the months are.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterable, Mapping

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StructField, StructType

#: (year, month); the drop of a month: (modification time in ms, name)
Period = tuple[int, int]
Drop = tuple[int, str]


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and the path: any storage that Spark reads."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def files_below(spark: SparkSession, path: str) -> dict[str, int]:
    """All files under a path, folder or glob: location -> modification time in ms."""
    fs, p = _fs(spark, path)
    out = {}
    for status in fs.globStatus(p) or ():
        files = fs.listFiles(status.getPath(), True)
        while files.hasNext():
            f = files.next()
            if not f.getPath().getName().startswith(("_", ".")):
                out[f.getPath().toString()] = int(f.getModificationTime())
    return out


class StateLog:
    """Numbered JSON documents in a shared folder; the highest number is the state.

    A document is written under a private name and renamed; the rename fails if its
    number is taken, so of two writers one wins and the other starts from its state.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def versions(self) -> list[int]:
        fs, p = _fs(self.spark, self.folder)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n[:-5]) for n in names if re.fullmatch(r"\d{12}\.json", n))

    def read(self, version: int) -> dict:
        fs, p = _fs(self.spark, f"{self.folder}/{version:012d}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict]:
        """(0, {}) where nothing is committed yet."""
        known = self.versions()
        return (known[-1], self.read(known[-1])) if known else (0, {})

    def publish(self, version: int, state: dict) -> bool:
        """Make ``state`` the document ``version``; False if there is one already."""
        jvm = self.spark._jvm
        fs, own = _fs(self.spark, f"{self.folder}/.{uuid.uuid4().hex}.tmp")
        out = fs.create(own, True)
        try:
            out.write(bytearray(json.dumps(state, sort_keys=True).encode()))
        finally:
            out.close()
        to = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{version:012d}.json")
        kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        none = self.spark.sparkContext._gateway.new_array(kind, 0)  # no overwriting
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            own.toUri() if own.toUri().getScheme() else fs.getUri(), self.spark._jsc.hadoopConfiguration())
        try:
            context.rename(own, to, none)
            return True
        except Py4JJavaError as ex:
            if "FileAlreadyExistsException" in str(ex.java_exception.toString()):
                fs.delete(own, False)
                return False
            raise

    def advance(self, change: Callable[[dict], dict | None]) -> int:
        """Commit ``change(state)``, anew on the winner's state if another writer was
        faster; no commit where it gives None. Returns the version that then holds."""
        while True:
            version, state = self.latest()
            new = change(state)
            if new is None:
                return version
            if self.publish(version + 1, new):
                return version + 1


def _name(period: Period) -> str:
    return f"{period[0]:04d}-{period[1]:02d}"


def newer(drop: Drop, known) -> bool:
    """Whether a drop is newer than the one remembered (by time, then by name)."""
    return known is None or tuple(drop) > tuple(known)


class DropLedger:
    """Which drop each month was last loaded from, kept over runs and replays."""

    def __init__(self, spark: SparkSession, folder: str):
        self.log = StateLog(spark, folder)

    def drops(self) -> dict[Period, Drop]:
        return _drops(self.log.latest()[1])

    def remember(self, drops: Mapping[Period, Drop]) -> None:
        def change(state):
            known = dict(state.get("drops", {}))
            for period, drop in drops.items():
                if newer(drop, known.get(_name(period))):
                    known[_name(period)] = list(drop)
            return None if known == state.get("drops", {}) else {**state, "drops": known}

        self.log.advance(change)


def _drops(state: dict) -> dict[Period, Drop]:
    return {(int(k[:4]), int(k[5:])): (v[0], v[1]) for k, v in state.get("drops", {}).items()}


class PeriodTable:
    """A table of months at ``root`` whose changes are single commits."""

    def __init__(self, spark: SparkSession, root: str, year_col: str = "year", month_col: str = "month"):
        self.spark, self.root = spark, root.rstrip("/")
        self.year_col, self.month_col = year_col, month_col
        self.log = StateLog(spark, f"{self.root}/versions")

    def periods(self, version: int | None = None) -> dict[Period, str]:
        """The months of a version and the load that holds each."""
        state = self.log.latest()[1] if version is None else self.log.read(version)
        return {(int(k[:4]), int(k[5:])): v for k, v in state.get("periods", {}).items()}

    def drops(self) -> dict[Period, Drop]:
        return _drops(self.log.latest()[1])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of the newest, or of an earlier, version; a lazy scan of exactly its
        months' folders, partitioned by month."""
        state = self.log.latest()[1] if version is None else self.log.read(version)
        if "schema" not in state:
            raise ValueError(f"nothing was ever loaded into {self.root}")
        schema = StructType.fromJson(state["schema"])
        full = StructType([*schema.fields, StructField("load", _text()),
                           StructField(self.year_col, IntegerType()), StructField(self.month_col, IntegerType())])
        paths = [self._folder(load, (int(k[:4]), int(k[5:]))) for k, load in sorted(state["periods"].items())]
        if not paths:
            return self.spark.createDataFrame([], full).drop("load")
        return (self.spark.read.schema(full).option("basePath", f"{self.root}/data").parquet(*paths)
                .drop("load"))

    def replace(self, df: DataFrame, periods: Iterable[Period] = (),
                drops: Mapping[Period, Drop] | None = None) -> int:
        """Replace every month that ``df`` has rows of and clear those of ``periods``
        that it has none of, in one commit; returns the version.

        With ``drops`` (the drop each month comes from) a month whose remembered drop
        is not older stays as it is: late old drops and replays change nothing.
        """
        load = uuid.uuid4().hex
        folder = f"{self.root}/data/load={load}"
        df.write.partitionBy(self.year_col, self.month_col).parquet(folder)
        written = self._written(folder)
        schema = StructType([f for f in df.schema.fields if f.name not in (self.year_col, self.month_col)])
        drops = dict(drops or {})

        def change(state):
            months, known = dict(state.get("periods", {})), dict(state.get("drops", {}))
            touched = False
            for period in sorted(written | set(periods)):
                name = _name(period)
                if period in drops:
                    if not newer(drops[period], known.get(name)):
                        continue
                    known[name] = list(drops[period])
                touched = True
                if period in written:
                    months[name] = load
                else:
                    months.pop(name, None)
            if not touched and "schema" in state:
                return None
            return {"periods": months, "drops": known, "schema": _merged(state.get("schema"), schema)}

        return self.log.advance(change)

    def _folder(self, load: str, period: Period) -> str:
        return (f"{self.root}/data/load={load}/{self.year_col}={period[0]}/"
                f"{self.month_col}={period[1]}")

    def _written(self, folder: str) -> set[Period]:
        fs, p = _fs(self.spark, f"{folder}/{self.year_col}=*/{self.month_col}=*")
        out = set()
        for status in fs.globStatus(p) or ():
            year, month = (part.split("=", 1)[1] for part in status.getPath().toString().split("/")[-2:])
            if not (year.isdigit() and month.isdigit()):
                raise ValueError(f"rows without a period: {self.year_col}={year}, {self.month_col}={month}")
            out.add((int(year), int(month)))
        return out


def _text():
    from pyspark.sql.types import StringType

    return StringType()


def _merged(known: dict | None, schema: StructType) -> dict:
    """The columns so far and those a load adds; a column that changes its type is an
    error, as its earlier months could no longer be read."""
    fields = {f.name: f for f in StructType.fromJson(known).fields} if known else {}
    for f in schema.fields:
        if f.name in fields and fields[f.name].dataType != f.dataType:
            raise ValueError(f"column {f.name} was {fields[f.name].dataType.simpleString()}, "
                             f"now {f.dataType.simpleString()}")
        fields.setdefault(f.name, StructField(f.name, f.dataType, True))
    return StructType(list(fields.values())).jsonValue()
