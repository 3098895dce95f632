"""Anomaly scoring against the previous three calendar months.

A value of the scored month is flagged for a (group, category) when both hold:

* C1  it is more than ``1 + global_threshold`` times the mean over *all* groups
      of the category in the three previous months (mean over the existing
      (group, month) cells; a zero mean flags nothing);
* C2  the group has a value in each of the three previous months, none of
      them zero, their mean is not zero, and the value is more than
      ``1 + threshold`` times that mean.

Signs are ignored on both sides (absolute values). A NULL month value blocks
C2; a group with no history at all is not scored (see :func:`keys_without_history`).
A NaN should be made NULL at ingest (``nan_to_null``).

Comparisons are written multiplicatively (``|cur| * n > |sum| * (1 + t)``),
so decimal inputs are compared exactly.

Two forms:

* :func:`anomaly_one_period`   one scored month, history read for just the
  three months before it (a range on the period columns, so a table
  partitioned by (year, month) is pruned);
* :func:`anomaly_all_periods`  every month at once (backfill): per-group
  statistics come from a ``rangeBetween(-3, -1)`` window over month cells,
  per-category means from a window over one row per (category, month).
  Groups are aggregated to one cell per month before any window, so no window
  partition holds more than one row per month, however hot a group is.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from ledgerloom.functions.scalars import month_index, month_index_of

# fixed values: the reason texts of the anomaly report, verbatim
REASON_GLOBAL = "вище середнього по всіх магазинах більше ніж вдвічі"
REASON_OWN = "вище власної історії більше ніж вдвічі"
REASON_BOTH = REASON_GLOBAL + ", " + REASON_OWN

_MI = "__month_idx"


def _factor(t: float) -> Column:
    return F.lit(Decimal(str(1 + t)))


def _cells(df: DataFrame, keys: Sequence[str], categories: Sequence[str],
           year_col: str, month_col: str, vals: _Values) -> DataFrame:
    """One row per (group, month) with the SUM of each category (NULL if all NULL)."""
    aggs = [F.sum(vals.carry(F.col(c))).alias(c) for c in categories]
    return (df.dropna(subset=list(keys) + [year_col, month_col])
            .groupBy(*keys, year_col, month_col).agg(*aggs)
            .withColumn(_MI, month_index(year_col, month_col)))


def _long(df: DataFrame, ids: Sequence[str], categories: Sequence[str], carried: str) -> DataFrame:
    """Unpivot the category columns into (category, v); NULL values are kept."""
    cast = df.select(*ids, *[F.col(c).cast(carried).alias(c) for c in categories])
    return cast.unpivot(list(ids), list(categories), "category", "v")


class _Values:
    """How category values are carried through the scoring.

    Decimal inputs (scale <= 9) travel as 64-bit counts of ``10^-scale`` units:
    sums and windows stay on the long fast path, comparisons are made on
    ``decimal(38,0)`` (exact, no overflow) and outputs are divided by
    ``10^scale`` once. Anything else is carried as the given or common type.
    """

    def __init__(self, df: DataFrame, categories: Sequence[str], value_type: str | None):
        self.scale = None
        if value_type:
            self.type = value_type
        else:
            types = {df.schema[c].dataType for c in categories}
            t = types.pop() if len(types) == 1 else None
            self.type = t.simpleString() if t is not None else "double"
            if isinstance(t, DecimalType) and t.scale <= 9:
                self.scale = t.scale
        self.carried = "long" if self.scale is not None else self.type

    def carry(self, col: Column) -> Column:
        if self.scale is None:
            return col.cast(self.type)
        return (col.cast(self.type) * F.lit(10 ** self.scale)).cast("long")

    def exact(self, col: Column) -> Column:
        return col.cast("decimal(38,0)") if self.scale is not None else col

    def out(self, col: Column) -> Column:
        d = col.cast("double")
        return d / F.lit(float(10 ** self.scale)) if self.scale is not None else d


def _flag(cur: Column, n: Column, zeros: Column, own_sum: Column, gsum: Column,
          gcnt: Column, threshold: float, global_threshold: float, months_back: int,
          vals: _Values) -> Column:
    a = lambda c: F.abs(vals.exact(c))
    c1 = (gsum != 0) & (a(cur) * gcnt > a(gsum) * _factor(global_threshold))
    c2 = ((n == months_back) & (zeros == 0) & (own_sum != 0)
          & (a(cur) * F.lit(months_back) > a(own_sum) * _factor(threshold)))
    return F.coalesce(c1 & c2, F.lit(False))


def _outputs(cur: Column, n: Column, own_sum: Column, gsum: Column, gcnt: Column,
             round_digits: int | None, vals: _Values) -> list[Column]:
    own = vals.out(own_sum) / n
    glob = vals.out(gsum) / gcnt
    if round_digits is not None:
        own, glob = F.bround(own, round_digits), F.bround(glob, round_digits)
    return [vals.out(cur).alias("current"), own.alias("own_avg_3m"),
            glob.alias("global_avg"), F.lit(REASON_BOTH).alias("reason")]


def anomaly_one_period(current: DataFrame, history: DataFrame, year: int, month: int,
                       categories: Sequence[str], group_keys: Sequence[str],
                       threshold: float = 1.0, global_threshold: float | None = None,
                       year_col: str = "year", month_col: str = "month",
                       months_back: int = 3, value_type: str | None = None,
                       round_digits: int | None = None) -> DataFrame:
    """Flag (group, category) values of ``current`` for the month ``(year, month)``.

    ``current`` is summed to one row per group first (grain fix: the history is
    per group and month). ``history`` holds earlier months with the period
    columns ``year_col``/``month_col``. Output: group keys, ``category``,
    ``current``, ``own_avg_3m``, ``global_avg``, ``reason``.
    """
    keys = list(group_keys)
    gt = threshold if global_threshold is None else global_threshold
    vals = _Values(history, categories, value_type)
    p = month_index_of(year, month)

    cur = (current.dropna(subset=keys).groupBy(*keys)
           .agg(*[F.coalesce(F.sum(vals.carry(F.col(c))), F.lit(0)).alias(c)
                  for c in categories]))
    hist = history.where(month_index(year_col, month_col).between(p - months_back, p - 1))
    cells = _cells(hist, keys, categories, year_col, month_col, vals)
    # per group, all categories side by side: the join below is on the group
    # keys only, which both sides are already partitioned by (no extra shuffle)
    own = cells.groupBy(*keys).agg(*[
        agg for i, c in enumerate(categories) for agg in (
            F.count(c).alias(f"__n{i}"),
            F.count(F.when(F.col(c) == 0, F.lit(1))).alias(f"__z{i}"),
            F.sum(c).alias(f"__s{i}"))])
    # one row per category: bounded by the configured category list
    glob = (_long(cells, keys, categories, vals.carried)
            .groupBy("category").agg(F.sum("v").alias("__gsum"), F.count("v").alias("__gcnt")))
    # keys are NULL-free here; null-safe equality keeps the optimizer from pushing
    # an inferred IS NOT NULL into this branch only, so ``cells`` stays one
    # shared subtree (history read once)
    o = own.select(*[F.col(k).alias(f"__o_{k}") for k in keys],
                   *[F.col(x) for x in own.columns if x not in keys])
    cond = None
    for k in keys:
        e = F.col(k).eqNullSafe(F.col(f"__o_{k}"))
        cond = e if cond is None else cond & e
    wide = cur.join(o, cond, "inner").drop(*[f"__o_{k}" for k in keys])
    rows = ", ".join(f"{_sql_string(c)}, `{c.replace('`', '``')}`, `__n{i}`, `__z{i}`, `__s{i}`"
                     for i, c in enumerate(categories))
    long = wide.select(*keys, F.expr(
        f"stack({len(categories)}, {rows}) AS (category, __cur, __n, __zeros, __own_sum)"))
    j = long.join(F.broadcast(glob), "category", "left")
    c = {k: F.col(k) for k in ("__cur", "__n", "__zeros", "__own_sum", "__gsum", "__gcnt")}
    flagged = j.where(_flag(c["__cur"], c["__n"], c["__zeros"], c["__own_sum"], c["__gsum"],
                            c["__gcnt"], threshold, gt, months_back, vals))
    return flagged.select(*keys, "category",
                          *_outputs(c["__cur"], c["__n"], c["__own_sum"], c["__gsum"],
                                    c["__gcnt"], round_digits, vals))


def _sql_string(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def anomaly_all_periods(facts: DataFrame, categories: Sequence[str], group_keys: Sequence[str],
                        threshold: float = 1.0, global_threshold: float | None = None,
                        year_col: str = "year", month_col: str = "month",
                        months_back: int = 3, value_type: str | None = None,
                        round_digits: int | None = None) -> DataFrame:
    """Score every month of ``facts`` against its own three previous months.

    Equivalent to running :func:`anomaly_one_period` for each month ``p`` with
    ``current = facts at p`` and ``history = facts``. Output adds the period
    columns.
    """
    keys = list(group_keys)
    gt = threshold if global_threshold is None else global_threshold
    vals = _Values(facts, categories, value_type)
    cells = _cells(facts, keys, categories, year_col, month_col, vals)
    long = _long(cells, keys + [year_col, month_col, _MI], categories, vals.carried)

    w_own = (Window.partitionBy(*keys, "category").orderBy(_MI)
             .rangeBetween(-months_back, -1))
    stats = long.select(
        *keys, year_col, month_col, _MI, "category", F.col("v").alias("__cur"),
        F.count(F.lit(1)).over(w_own).alias("__rows"),
        F.count("v").over(w_own).alias("__n"),
        F.count(F.when(F.col("v") == 0, F.lit(1))).over(w_own).alias("__zeros"),
        F.sum("v").over(w_own).alias("__own_sum"))

    # per (category, month) partial sums: #categories x #months rows
    per_month = long.groupBy("category", _MI).agg(F.sum("v").alias("__s"), F.count("v").alias("__c"))
    w_glob = Window.partitionBy("category").orderBy(_MI).rangeBetween(-months_back, -1)
    glob = per_month.select("category", _MI,
                            F.sum("__s").over(w_glob).alias("__gsum"),
                            F.sum("__c").over(w_glob).alias("__gcnt"))

    # null-safe keys: no inferred IS NOT NULL filter is pushed into this branch
    # alone, so both branches keep one identical subtree and Spark reuses its
    # exchange (the fact table is scanned and shuffled once)
    g = glob.select(F.col("category").alias("__gcat"), F.col(_MI).alias("__gmi"),
                    "__gsum", "__gcnt")
    j = (stats.where(F.col("__rows") > 0)
         .join(F.broadcast(g), F.col("category").eqNullSafe(F.col("__gcat"))
               & F.col(_MI).eqNullSafe(F.col("__gmi")), "left")
         .drop("__gcat", "__gmi"))
    c = {k: F.col(k) for k in ("__cur", "__n", "__zeros", "__own_sum", "__gsum", "__gcnt")}
    flagged = j.where(_flag(c["__cur"], c["__n"], c["__zeros"], c["__own_sum"], c["__gsum"],
                            c["__gcnt"], threshold, gt, months_back, vals))
    return flagged.select(*keys, F.col(year_col).cast("int").alias(year_col),
                          F.col(month_col).cast("int").alias(month_col), "category",
                          *_outputs(c["__cur"], c["__n"], c["__own_sum"], c["__gsum"],
                                    c["__gcnt"], round_digits, vals))


def keys_without_history(current: DataFrame, history: DataFrame, year: int, month: int,
                         group_keys: Sequence[str], year_col: str = "year",
                         month_col: str = "month", months_back: int = 3) -> DataFrame:
    """Distinct groups of the scored month that have no row in the history window."""
    keys = list(group_keys)
    p = month_index_of(year, month)
    hist = (history.where(month_index(year_col, month_col).between(p - months_back, p - 1))
            .select(*keys).distinct())
    return current.dropna(subset=keys).select(*keys).distinct().join(hist, keys, "left_anti")
