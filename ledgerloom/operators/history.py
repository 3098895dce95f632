"""Kept history for the anomaly scoring.

Scoring compares a month with the three before it, per group and category. What it needs
of a month is one small row per group: each category's sum and the number of values in
it. :class:`HistoryCells` keeps these rows in a :class:`PeriodTable`. A month's row set is
made once, when the month is loaded, and made anew when the month is corrected; scoring
reads the kept rows and never the facts, whatever the length of the history.

Rows merge: sums and counts of two parts of a month add up to those of the whole month,
so a part that comes late can be added without reading the first part's facts again.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import month_index, month_index_of
from ledgerloom.operators.aggregate import drop_null_keys
from ledgerloom.operators.anomaly import anomaly_all_periods, anomaly_one_period
from ledgerloom.operators.periods import Drop, Period, PeriodTable


def _count(category: str) -> str:
    return f"{category}__n"


class HistoryCells:
    """Sum and count per group, month and category, kept under ``root``."""

    def __init__(self, spark: SparkSession, root: str, group_keys: Sequence[str], categories: Sequence[str],
                 year_col: str = "year", month_col: str = "month"):
        self.keys, self.categories = list(group_keys), list(categories)
        self.year_col, self.month_col = year_col, month_col
        self.table = PeriodTable(spark, root, year_col, month_col)

    def cells(self, facts: DataFrame) -> DataFrame:
        """One row per group and month of ``facts``; rows with a NULL key are left out."""
        grain = [*self.keys, self.year_col, self.month_col]
        return drop_null_keys(facts, grain).groupBy(*grain).agg(
            *[F.sum(c).alias(c) for c in self.categories],
            *[F.count(c).alias(_count(c)) for c in self.categories])

    def replace(self, facts: DataFrame, periods: Iterable[Period] = (),
                drops: Mapping[Period, Drop] | None = None) -> int:
        """The months of ``facts`` anew, and those of ``periods`` without a row cleared; one
        commit. With ``drops`` an older drop changes nothing (see :meth:`PeriodTable.replace`)."""
        return self.table.replace(self.cells(facts), periods, drops)

    def add(self, facts: DataFrame, periods: Sequence[Period]) -> int:
        """Rows that belong to months already kept: ``periods`` are the months of ``facts``.
        Only these months' kept rows are read and written."""
        new = self.cells(facts)
        if not self.table.log.versions():
            return self.table.replace(new, periods)
        grain = [*self.keys, self.year_col, self.month_col]
        both = self._months(periods).unionByName(new)
        merged = both.groupBy(*grain).agg(
            *[F.sum(c).alias(c) for c in self.categories],
            *[F.sum(_count(c)).alias(_count(c)) for c in self.categories])
        kind = {f.name: f.dataType for f in new.schema.fields}
        return self.table.replace(merged.select(*[F.col(c).cast(kind[c]).alias(c) for c in new.columns]), periods)

    def _months(self, periods: Iterable[Period]) -> DataFrame:
        wanted = [(F.col(self.year_col) == y) & (F.col(self.month_col) == m) for y, m in periods]
        return self.table.read().where(reduce(lambda a, b: a | b, wanted, F.lit(False)))

    def score(self, year: int, month: int, threshold: float = 1.0, months_back: int = 3, **options) -> DataFrame:
        """Anomalies of one kept month against the months before it; reads those months only."""
        p = month_index_of(year, month)
        kept = self.table.read()
        current = kept.where((F.col(self.year_col) == year) & (F.col(self.month_col) == month))
        history = kept.where(month_index(self.year_col, self.month_col).between(p - months_back, p - 1))
        return anomaly_one_period(current, history, year, month, self.categories, self.keys, threshold,
                                  year_col=self.year_col, month_col=self.month_col, months_back=months_back, **options)

    def score_all(self, threshold: float = 1.0, **options) -> DataFrame:
        """Anomalies of every kept month."""
        return anomaly_all_periods(self.table.read(), self.categories, self.keys, threshold,
                                   year_col=self.year_col, month_col=self.month_col, **options)
