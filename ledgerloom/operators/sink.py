"""Replacing periods in partitioned targets, and the target schemas.

A target is a Parquet dataset partitioned by its two period columns. Loading a
month replaces exactly that month's partition in one write job:

* :func:`write_period`   one month, in one job; an empty frame still clears the month;
* :func:`write_periods`  many months at once (backfill): dynamic partition
  overwrite replaces the months present in the frame; months that a drop's files
  are for but that have no row left are cleared, all others stay;
* :func:`replace_period_frame`  the same replacement as a pure query.

A row whose own period differs from the period being loaded fails the load
job before commit, so the target is left as it was.

On a plain dataset the swap and the clearing of months without rows are two steps. A
:class:`~ledgerloom.operators.periods.PeriodTable` in place of the path makes them one
commit, and readers never see a part of a load.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerloom.operators.periods import PeriodTable, files_below


class PeriodMismatch(ValueError):
    pass


def _period_cond(year: int, month: int, year_col: str, month_col: str):
    return (F.col(year_col) == year) & (F.col(month_col) == month)


def replace_period_frame(existing: DataFrame, new: DataFrame, year: int, month: int,
                         year_col: str = "year", month_col: str = "month") -> DataFrame:
    """``existing`` without ``(year, month)``, plus ``new`` (pure query form)."""
    keep = existing.where(~F.coalesce(_period_cond(year, month, year_col, month_col), F.lit(False)))
    return keep.unionByName(new.select(*existing.columns))


def _partition_path(root: str, year: int, month: int, year_col: str, month_col: str) -> str:
    return f"{root.rstrip('/')}/{year_col}={year}/{month_col}={month}"


def _guard_period(df: DataFrame, year: int, month: int, year_col: str,
                  month_col: str) -> DataFrame:
    """Fail the job (before anything is committed) on a row of another period."""
    ok = F.coalesce(_period_cond(year, month, year_col, month_col), F.lit(False))
    err = F.raise_error(F.lit(f"{_MISMATCH} {year}-{month:02d}"))
    return df.withColumn(year_col, F.when(ok, F.col(year_col)).otherwise(err))


_MISMATCH = "row outside the period being loaded:"


def write_period(new: DataFrame, root: str | PeriodTable, year: int, month: int,
                 year_col: str = "year", month_col: str = "month") -> None:
    """Replace the ``(year, month)`` partition of the target at ``root``.

    Rows are checked against the period as they are written (a row of another
    period fails the job before commit, so the target is untouched). A load that
    turned out empty clears the month. Running the load twice gives the same result.
    """
    guarded = _guard_period(new, year, month, year_col, month_col)
    try:
        write_periods(guarded, root, year_col, month_col, [(year, month)])
    except PySparkException as ex:
        if _MISMATCH in str(ex):
            raise PeriodMismatch(f"rows outside {year}-{month:02d} in a load for that period") from ex
        raise


def write_periods(df: DataFrame, root: str | PeriodTable, year_col: str = "year", month_col: str = "month",
                  periods: Sequence[tuple[int, int]] = ()) -> None:
    """Replace every month present in ``df`` and clear those of ``periods`` (the
    months a drop's files are for) that have no row left; others stay as they are.

    One job writes. Which of ``periods`` it had rows for is seen from the target:
    the job puts new files into the folder of every month it has a row of, so a
    month whose files are the same as before got none. Nothing is concluded from
    job metrics, which can be lost.
    """
    if isinstance(root, PeriodTable):
        root.replace(df, periods)
        return
    spark = df.sparkSession
    folders = {p: _partition_path(root, *p, year_col, month_col) for p in periods}
    before = {p: set(files_below(spark, folder)) for p, folder in folders.items()}
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(year_col, month_col)
     .parquet(root))
    for p, folder in folders.items():
        if before[p] and set(files_below(spark, folder)) == before[p]:
            df.limit(0).drop(year_col, month_col).write.mode("overwrite").parquet(folder)


def conform_schema(df: DataFrame, schema: StructType | str, strict: bool = True) -> DataFrame:
    """Select and cast the target columns, matching names case-insensitively.

    A target column the frame lacks raises when ``strict``, else becomes NULL.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            if strict:
                raise KeyError(f"column {f.name!r} missing; have {df.columns}")
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(src).cast(f.dataType).alias(f.name))
    return df.select(*cols)



def replace_period(new: DataFrame, root: str | PeriodTable, year: int, month: int,
                   year_col: str = "year", month_col: str = "month") -> None:
    """Replace one period of a partitioned target (see :func:`write_period`)."""
    write_period(new, root, year, month, year_col, month_col)
