"""Monthly drops as they arrive: each new or corrected file replaces its period.

A file-source stream watches the landing folder; every micro-batch holds the
rows of the files that arrived since the last one. For each period in the
batch only the newest file is kept (a corrected re-drop wins over the one it
replaces, and two drops of one month in one batch are not added together).
Which drop a period was last loaded from, and that drop's time, is kept in a
ledger over batches and runs: a drop that is older than the one loaded changes
nothing, however late it arrives, and a batch that is replayed changes nothing
either. A file without any row is not in a batch's rows; it is found in the
listing of the landing folder, and where it is the newest drop of its period it
clears that period.

With a path as target the periods are replaced by dynamic partition overwrite
and the ledger lies beside the stream's progress; a crash between the two is
mended by the replay, which writes the same partitions again. With a
:class:`~ledgerloom.operators.periods.PeriodTable` rows and ledger are one commit.

With ``trigger(availableNow=True)`` (default) the stream processes whatever
has landed and stops, which suits a scheduled job; pass ``once=False`` to keep
it running.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions.scalars import drop_name, period_from_name
from ledgerloom.operators.periods import Drop, DropLedger, Period, PeriodTable, files_below, newer
from ledgerloom.operators.sink import write_periods
from ledgerloom.session import checkpoint_dir


def newest_file_per_period(batch: DataFrame) -> DataFrame:
    """Keep the rows of the most recent drop of each (file_year, file_month).

    A drop is a file, or a dataset folder of ``part-*`` files; its time is the
    newest modification time among its files. The choice is made on one small
    row per drop and joined back, so a month holding most of the batch is
    never gathered into one task.
    """
    drops = (batch.groupBy("file_year", "file_month", "file_drop")
             .agg(F.max("file_mtime").alias("__t")))
    latest = (drops.groupBy("file_year", "file_month")
              .agg(F.max(F.struct("__t", "file_drop")).alias("__l"))
              .select("file_year", "file_month", F.col("__l.file_drop").alias("file_drop")))
    # one row per period in the batch: bounded by the drops that arrived
    return batch.join(F.broadcast(latest), ["file_year", "file_month", "file_drop"], "left_semi")


def landed_drops(spark: SparkSession, landing: str) -> dict[Period, tuple[Drop, list[str]]]:
    """The newest drop of each period in the landing folder, with its files; from the
    listing alone, so a drop without rows is there too."""
    files = files_below(spark, landing)
    if not files:
        return {}
    listed = spark.createDataFrame(list(files.items()), "path string, at long")
    p = period_from_name(F.col("path"), strict=False)
    drops = (listed.select("path", "at", drop_name(F.col("path")).alias("name"), p.alias("p"))
             .where("p.year IS NOT NULL").groupBy("p", "name")
             .agg(F.max("at").alias("at"), F.collect_list("path").alias("paths")))
    latest = drops.groupBy("p").agg(F.max(F.struct("at", "name", "paths")).alias("d"))
    # one row per period: a handful of drops, whatever they hold
    return {(r.p.year, r.p.month): ((r.d.at, r.d.name), list(r.d.paths)) for r in latest.collect()}


def batch_drops(batch: DataFrame) -> dict[Period, Drop]:
    """The newest drop of each period among the rows of a batch."""
    at = F.unix_millis(F.col("file_mtime").cast("timestamp"))
    drops = batch.groupBy("file_year", "file_month", "file_drop").agg(F.max(at).alias("at"))
    latest = drops.groupBy("file_year", "file_month").agg(F.max(F.struct("at", "file_drop")).alias("d"))
    return {(r.file_year, r.file_month): (r.d.at, r.d.file_drop) for r in latest.collect()}


def ingest_monthly_drops(spark: SparkSession, landing: str, schema: StructType | str,
                         transform: Callable[[DataFrame], DataFrame], target: str | PeriodTable,
                         checkpoint: str | None = None, fmt: str = "csv", year_col: str = "year",
                         month_col: str = "month", once: bool = True, **options):
    """Start the ingestion stream; returns the ``StreamingQuery``.

    ``transform`` maps the rows of a batch (with ``file_name``, ``file_drop``,
    ``file_mtime``, ``file_year``, ``file_month``) to target rows carrying ``year_col`` and
    ``month_col``. ``checkpoint`` must be a shared folder (it holds the
    stream's progress and survives restarts); by default it is a folder under
    the session's ``spark.checkpoint.dir`` named after the target. A ledger that
    should outlive the checkpoint needs a :class:`PeriodTable` as target.
    """
    if checkpoint is None:
        name = (target.root if isinstance(target, PeriodTable) else target).rstrip("/").replace(":", "_").replace("/", "_")
        checkpoint = f"{checkpoint_dir(spark).rstrip('/')}/ingest/{name}"
    # the ledger decides what is too old, not the age of a file against the newest one
    reader = spark.readStream.format(fmt).schema(schema).option("maxFileAge", "36500d")
    for k, v in options.items():
        reader = reader.option(k, v)
    stream = reader.load(landing)
    p = period_from_name(F.col("_metadata.file_path"))
    stream = stream.select(
        "*", F.col("_metadata.file_name").alias("file_name"),
        drop_name(F.col("_metadata.file_path")).alias("file_drop"),
        F.col("_metadata.file_modification_time").alias("file_mtime"),
        p["year"].alias("file_year"), p["month"].alias("file_month"))

    ledger = target if isinstance(target, PeriodTable) else DropLedger(spark, f"{checkpoint}/drops")

    def empty(paths: list[str]) -> bool:
        rows = spark.read.format(fmt).schema(schema)
        for k, v in options.items():
            rows = rows.option(k, v)
        return rows.load(paths).isEmpty()

    def apply(batch: DataFrame, batch_id: int) -> None:
        known, found = ledger.drops(), batch_drops(batch)
        won = {p: d for p, d in found.items() if newer(d, known.get(p))}
        for p, (drop, paths) in landed_drops(spark, landing).items():
            # newer than all that has rows: without rows it clears its period, with rows
            # it is on its way in a later batch
            if newer(drop, known.get(p)) and newer(drop, found.get(p)) and empty(paths):
                won[p] = drop
        if not won:
            return
        winners = spark.createDataFrame([(*p, d[1]) for p, d in won.items()],
                                        "file_year int, file_month int, file_drop string")
        # one row per period of the batch
        rows = transform(batch.join(F.broadcast(winners), ["file_year", "file_month", "file_drop"], "left_semi"))
        if isinstance(target, PeriodTable):
            target.replace(rows, won, won)
        else:
            # periods that the transform leaves without rows are cleared
            write_periods(rows, target, year_col, month_col, list(won))
            ledger.remember(won)

    writer = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start()
