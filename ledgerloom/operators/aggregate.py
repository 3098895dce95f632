"""Grouped aggregates with the null rules of the monthly reports.

* a row with a NULL in any group key is dropped (not kept as a NULL group);
* the sum of an all-NULL group is 0, not NULL;
* "first" means the first non-NULL value in an explicit row order.

All of them are single ``groupBy`` aggregations, so Spark runs a partial
(map-side) aggregate before the shuffle: a key holding a third of the rows is
reduced to one row per task before anything moves.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import exact_sum
from ledgerloom.operators.stage import written


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(keys)) if keys else df


def grouped_sum(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
                scale: int | None = None,
                zero_if_all_null: bool = True) -> DataFrame:
    """Sum ``measures`` per ``keys``; NULL-key rows dropped, all-NULL sums -> 0.

    ``scale=s`` sums exactly (order-independent, see :func:`exact_sum`), rounds
    the group's total to ``s`` decimals and returns ``decimal(38, s)``; without
    it the column's own type is summed.
    """
    aggs = []
    for m in measures:
        s = exact_sum(F.col(m), scale) if scale is not None else F.sum(m)
        if zero_if_all_null:
            s = F.coalesce(s, F.lit(0))
        aggs.append(s.alias(m))
    return drop_null_keys(df, keys).groupBy(*keys).agg(*aggs)


def first_non_null(value: Column, order: Column) -> Column:
    """Aggregate: the value of the earliest row (by ``order``) whose value is set."""
    return F.min_by(value, F.when(value.isNotNull(), order))


def sum_and_first(df: DataFrame, keys: Sequence[str], sum_cols: Sequence[str],
                  first_cols: Sequence[str], order: str | Column,
                  scale: int | None = None) -> DataFrame:
    """Per group: sums (all-NULL -> 0) and the first non-NULL value in row order."""
    order_c = _col(order)
    aggs = []
    for m in sum_cols:
        s = exact_sum(F.col(m), scale) if scale is not None else F.sum(m)
        aggs.append(F.coalesce(s, F.lit(0)).alias(m))
    for c in first_cols:
        aggs.append(first_non_null(F.col(c), order_c).alias(c))
    return drop_null_keys(df, keys).groupBy(*keys).agg(*aggs)


def control_totals(df: DataFrame, by: Sequence[str], measure: str,
                   flag: Column | None = None, scale: int = 9) -> DataFrame:
    """Reconciliation figures per group: row count, total, mean, and (optionally)
    the total and count of the rows where ``flag`` holds.

    Totals are exact sums, rounded to ``scale`` decimals and cast to double; the mean is
    total / count of values.
    """
    v = F.col(measure)
    total = exact_sum(v, scale)
    aggs = [
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(total, F.lit(0)).cast("double").alias("total"),
        (total.cast("double") / F.count(v)).alias("mean"),
    ]
    if flag is not None:
        aggs += [
            F.coalesce(exact_sum(F.when(flag, v), scale), F.lit(0)).cast("double")
            .alias("flagged_total"),
            F.count(F.when(flag, F.lit(1))).alias("flagged_rows"),
        ]
    return df.groupBy(*by).agg(*aggs)


def exact_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: Sequence[float],
                    names: Sequence[str], n_ranges: int | None = None) -> DataFrame:
    """Exact, linearly interpolated quantiles of ``value`` per group, rounded to 6 decimals.

    Order statistics by counting, with no state that holds a group's values:

    1. (group, value, count), summed map-side: equal values are one row;
    2. Spark cuts these in the order of (group, value) into ranges of equal size; they
       are written with their range's number, so a hot group lies in many ranges;
    3. a running count over the few (group, range) totals says which range holds each
       wanted rank, and a running count inside that range which value.

    NULL values do not count; a group of NULLs only has no row; a NULL group is one.
    """
    spark = df.sparkSession
    n = n_ranges or max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    keys = [f"__k{i}" for i in range(len(by))]
    counts = (df.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], F.col(value).cast("double").alias("__v"))
              .where(F.col("__v").isNotNull()).groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__n")))
    ranged = written(counts.repartitionByRange(n, *keys, "__v").withColumn("__range", F.spark_partition_id()),
                     "value-counts")
    # per (group, range): how many values lie before it, and in the whole group
    group = Window.partitionBy(*keys)
    totals = ranged.groupBy(*keys, "__range").agg(F.sum("__n").alias("__n"))
    before = F.sum("__n").over(group.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1))
    place = totals.withColumns({"__before": F.coalesce(before, F.lit(0)), "__all": F.sum("__n").over(group)})
    wanted = F.array(*[f((F.col("__all") - 1) * F.lit(float(p))).cast("long") for p in probs for f in (F.floor, F.ceil)])
    place = place.withColumn("__ranks", F.filter(
        F.array_distinct(wanted), lambda r: (r >= F.col("__before")) & (r < F.col("__before") + F.col("__n"))))
    place = place.where(F.size("__ranks") > 0).select(*keys, "__range", "__before", "__all", "__ranks")
    running = (Window.partitionBy(*keys, "__range").orderBy("__v")
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    inside = (_join_null_safe(ranged, place, [*keys, "__range"])
              .withColumn("__to", F.col("__before") + F.sum("__n").over(running)))
    at = inside.select(*keys, "__v", "__all", F.explode(F.filter(
        "__ranks", lambda r: (r >= F.col("__to") - F.col("__n")) & (r < F.col("__to")))).alias("__rank"))
    out = []
    for p, name in zip(probs, names):
        pos = (F.col("__all") - 1) * F.lit(float(p))
        low = F.max(F.when(F.col("__rank") == F.floor(pos), F.col("__v")))
        high = F.max(F.when(F.col("__rank") == F.ceil(pos), F.col("__v")))
        part = F.max(pos - F.floor(pos))
        out.append(F.round(low + (high - low) * part, 6).alias(name))
    return at.groupBy(*keys).agg(*out).select(*[F.col(k).alias(b) for k, b in zip(keys, by)], *names)


def _join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join on keys that may be NULL, the keys once."""
    other = right.select(*[F.col(c).alias(f"__other_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__other_{k}")) for k in keys])
    return left.join(other, cond).drop(*[f"__other_{k}" for k in keys])


def rate_summary(df: DataFrame, by: Sequence[str], value: str,
                 decimal: tuple[int, int] = (18, 2), approx: bool = False) -> DataFrame:
    """count, mean, sample std-dev, min, quartiles and max of ``value`` per group.

    Moments are exact decimal sums, so the result does not depend on the order
    rows arrive in (and cancellation in the variance is exact). Quartiles are
    exact and linearly interpolated, rounded to 6 decimals (see
    :func:`exact_quantiles`), for groups of any size. ``approx=True`` uses
    ``percentile_approx``, which needs one pass less.
    """
    x = F.col(value).cast(f"decimal({decimal[0]},{decimal[1]})")
    n = F.count(x)
    s1 = F.sum(x)
    s2 = F.sum(x * x)
    # (n * sum(x^2) - sum(x)^2) is exact; one division and a square root follow
    var = ((n * s2 - s1 * s1).cast("double") / (n * (n - 1)).cast("double"))
    names, probs = ["p25", "p50", "p75"], [0.25, 0.5, 0.75]
    quartiles = [F.percentile_approx(value, p, 10000).cast("double").alias(q)
                 for p, q in zip(probs, names)] if approx else []
    moments = df.groupBy(*by).agg(
        n.alias("n"), (s1.cast("double") / n).alias("mean"), F.when(n > 1, F.sqrt(var)).alias("std"),
        F.min(value).alias("min"), F.max(value).alias("max"), *quartiles)
    if not approx:
        exact = exact_quantiles(df, by, value, probs, names)
        other = exact.select(*[F.col(b).alias(f"__{b}") for b in by], *names)
        cond = reduce(lambda a, b: a & b, [F.col(b).eqNullSafe(F.col(f"__{b}")) for b in by])
        moments = moments.join(other, cond, "left")
    return moments.select(*by, "n", "mean", "std", "min", *names, "max")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (the "must be empty" check)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))
