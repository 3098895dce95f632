"""Sales-share allocation of shared labour hours.

``dense_sales_share`` gives, for every store, month and listed department, the
department's and the store's sales; ``labor_allocation`` splits the hours of a
shared role across the departments by that share.

The sales are read once. One aggregate keeps what the share needs of them: the
sums of the asked months, which departments had a row in a year, and which
stores there are at all. It is written, and the rest is done on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import exact_sum, guarded_ratio, month_index, month_index_of
from ledgerloom.operators.stage import written


def dense_sales_share(sales: DataFrame, year: int, month: int, depts: Sequence,
                      calendar: DataFrame | None = None,
                      store_col: str = "filid", dept_col: str = "depid",
                      year_col: str = "year", month_col: str = "month",
                      type_col: str = "type_oper", sales_type: str = "sales",
                      amount_col: str = "sumout", scale: int | None = 2,
                      stores: DataFrame | None = None) -> DataFrame:
    """Per (year, month, store, department): department sales and store sales.

    * stores: every store ever seen in ``sales`` (any year);
    * departments: those of ``depts`` with any row in ``year``;
    * months: ``(year, month)`` if the calendar has it (default: it does);
    * missing sales are 0; ``sumout_filial`` is the store's total that month.
    Amounts are summed exactly at ``scale`` decimals (``None``: as given).
    """
    return dense_sales_share_periods(sales, [(year, month)], depts, calendar, store_col,
                                     dept_col, year_col, month_col, type_col, sales_type,
                                     amount_col, scale, stores)


def dense_sales_share_periods(sales: DataFrame, periods: Sequence[tuple[int, int]],
                              depts: Sequence, calendar: DataFrame | None = None,
                              store_col: str = "filid", dept_col: str = "depid",
                              year_col: str = "year", month_col: str = "month",
                              type_col: str = "type_oper", sales_type: str = "sales",
                              amount_col: str = "sumout", scale: int | None = 2,
                              stores: DataFrame | None = None) -> DataFrame:
    """:func:`dense_sales_share` for several months in one plan (backfill).

    ``periods`` is a list of (year, month); departments count as seen per
    year, and a year without any is left out. The sales table is read once for
    all months, however many. ``stores`` (one column named like ``store_col``)
    replaces "every store ever seen in sales", for which the whole history has to
    be read.
    """
    depts = list(depts)
    periods = sorted({(int(y), int(m)) for y, m in periods})
    if not periods:
        # no month asked for: an empty share with the usual columns
        return sales.select(F.col(year_col).cast("int"), F.col(month_col).cast("int"),
                            store_col, dept_col,
                            F.lit(0).alias("sumout_dep"), F.lit(0).alias("sumout_filial")).limit(0)
    cells = written(sales_cells(sales, periods, depts, store_col, dept_col, year_col, month_col, type_col,
                                sales_type, amount_col, scale, every_store=stores is None), "sales-cells")
    # at most len(depts) departments a year
    seen = cells.where(F.col(dept_col).isNotNull()).select(year_col, dept_col).distinct().collect()
    of_year: dict[int, list] = {}
    for y, d in sorted(tuple(r) for r in seen):
        of_year.setdefault(y, []).append(d)
    months = [(y, m) for y, m in periods if y in of_year]
    kind = {f.name: f.dataType for f in cells.schema.fields}
    if not months:
        return cells.select(F.col(year_col).cast("int"), F.col(month_col).cast("int"), store_col, dept_col,
                            F.col("amount").alias("sumout_dep"), F.col("amount").alias("sumout_filial")).limit(0)
    if stores is None:
        stores = cells
    # a row without an amount for every store and month, beside the sums: one aggregate
    # then has them all, a column per department
    asked = F.explode(F.array(*[F.struct(F.lit(y).alias("y"), F.lit(m).alias("m")) for y, m in months]))
    blank = (stores.select(store_col).where(F.col(store_col).isNotNull()).distinct()
             .select(F.col(store_col).cast(kind[store_col]), asked.alias("p"))
             .select(F.col("p.y").cast("int").alias(year_col), F.col("p.m").cast("int").alias(month_col), store_col,
                     F.lit(None).cast(kind[dept_col]).alias(dept_col), F.lit(None).cast(kind["amount"]).alias("amount")))
    if calendar is not None:
        cal = calendar.select(F.col(year_col).cast("int"), F.col(month_col).cast("int")).distinct()
        blank = blank.join(F.broadcast(cal), [year_col, month_col], "left_semi")
    sold = cells.where(F.col(month_col).isNotNull() & F.col(store_col).isNotNull()).select(
        F.col(year_col).cast("int"), F.col(month_col).cast("int"), store_col, dept_col, "amount")
    listed = sorted({d for own in of_year.values() for d in own})
    zero = F.lit(0).cast(kind["amount"])
    wide = (blank.withColumn("asked", F.lit(1)).union(sold.withColumn("asked", F.lit(0)))
            .groupBy(year_col, month_col, store_col).agg(
                F.max("asked").alias("asked"), F.coalesce(F.sum("amount"), zero).alias("sumout_filial"),
                *[F.coalesce(F.sum(F.when(F.col(dept_col) == F.lit(d), F.col("amount"))), zero).alias(f"__d{i}")
                  for i, d in enumerate(listed)])
            .where("asked = 1"))
    each = F.explode(F.array(*[
        F.struct(F.lit(d).cast(kind[dept_col]).alias("d"), F.col(f"__d{i}").alias("v"),
                 F.col(year_col).isin(*[y for y, own in of_year.items() if d in own]).alias("sold"))
        for i, d in enumerate(listed)]))
    return (wide.select(year_col, month_col, store_col, each.alias("e"), "sumout_filial").where("e.sold")
            .select(year_col, month_col, store_col, F.col("e.d").alias(dept_col),
                    F.col("e.v").alias("sumout_dep"), "sumout_filial"))


def sales_cells(sales: DataFrame, periods: Sequence[tuple[int, int]], depts: Sequence,
                store_col: str, dept_col: str, year_col: str, month_col: str, type_col: str,
                sales_type: str, amount_col: str, scale: int | None, every_store: bool = True) -> DataFrame:
    """All that a share needs of the sales, from one pass: (year, month, store,
    department, amount) with the sales of the asked months; with a NULL month the
    departments of the asked years; with only the store, the other stores."""
    listed = F.col(dept_col).isin(*depts)
    of_years = F.coalesce(listed & F.col(year_col).isin(*sorted({y for y, _ in periods})), F.lit(False))
    if len(periods) == 1:  # two equalities can reach the scan
        asked = (F.col(year_col) == periods[0][0]) & (F.col(month_col) == periods[0][1])
    else:
        asked = month_index(year_col, month_col).isin(*(month_index_of(y, m) for y, m in periods))
    counted = F.coalesce(of_years & asked & (F.col(type_col) == sales_type), F.lit(False))
    if not every_store:
        sales = sales.where(of_years)
    kept = sales.select(
        F.when(of_years, F.col(year_col)).alias(year_col), F.when(counted, F.col(month_col)).alias(month_col),
        store_col, F.when(of_years, F.col(dept_col)).alias(dept_col),
        F.when(counted, F.col(amount_col)).alias("amount"))
    total = exact_sum(F.col("amount"), scale) if scale is not None else F.sum("amount")
    return kept.groupBy(year_col, month_col, store_col, dept_col).agg(total.alias("amount"))


# the share of one month as parameterised SQL: sums per store and department and, by
# the same aggregate, the departments seen; a store's sums are a map, looked up for each
_SHARE_SQL = """
WITH kept AS (
  SELECT filid, CASE WHEN listed AND year = :year THEN depid END AS depid,
         CASE WHEN listed AND year = :year AND month = :month AND type_oper = 'sales' THEN sumout END AS amount
  FROM (SELECT *, array_contains(:depts, depid) AS listed FROM {sales})
),
cells AS (
  SELECT filid, depid, SUM(amount) AS amount, GROUPING(filid) AS every
  FROM kept GROUP BY GROUPING SETS ((filid, depid), (depid))
),
per_store AS (
  SELECT filid, map_from_entries(array_agg(struct(depid, amount)) FILTER (WHERE depid IS NOT NULL)) AS sold,
         COALESCE(SUM(amount), 0) AS sumout_filial,
         (SELECT array_agg(depid) FROM cells WHERE every = 1 AND depid IS NOT NULL) AS seen
  FROM cells WHERE every = 0 AND filid IS NOT NULL GROUP BY filid
)
SELECT :year AS year, :month AS month, filid, dep AS depid,
       COALESCE(try_element_at(sold, dep), 0) AS sumout_dep, sumout_filial
FROM per_store LATERAL VIEW explode(seen) AS dep
"""


def dense_sales_share_sql(spark, sales: DataFrame, year: int, month: int,
                          depts: Sequence) -> DataFrame:
    """:func:`dense_sales_share` written as SQL with named parameters.

    ``sales`` must have the default column names (filid, depid, year, month,
    type_oper, sumout); amounts are summed as given.
    """
    return spark.sql(_SHARE_SQL, args={"year": year, "month": month,
                                       "depts": F.array(*[F.lit(d) for d in depts])},
                     sales=sales)


def labor_allocation(labor: DataFrame, share: DataFrame, shared_dept,
                     store_col: str = "filid", dept_col: str = "depid",
                     hours_col: str = "hours", rate_col: str = "cost_hour",
                     cost_col: str = "cost_labor",
                     period_cols: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """Split rows of the shared department by the store's sales share.

    ``hours_dep = hours * sumout_dep / sumout_filial``; 0 when the store sold
    nothing; NULL (and a NULL department) when the store has no sales rows at
    all. ``cost = rate * hours_dep``. Every other row - including rows with a
    NULL department - is kept unchanged. One predicate decides what is shared
    and the rest pass through the same join unmatched, so no row is lost or
    doubled and the labour rows are computed once.
    ``period_cols`` pairs (labour column, share column), e.g.
    ``[("y", "year"), ("m", "month")]``, split many months at once.
    """
    is_shared = F.col(dept_col).eqNullSafe(F.lit(shared_dept))
    sh = share.select(F.col(store_col).alias("__s_store"),
                      *[F.col(sc).alias(f"__s_{lc}") for lc, sc in period_cols],
                      F.col(dept_col).cast(labor.schema[dept_col].dataType).alias("__s_dept"),
                      F.col("sumout_dep").cast("double").alias("__dep"),
                      F.col("sumout_filial").cast("double").alias("__fil"))
    # one left join, no split-and-union: only shared rows can match (so the
    # upstream plan is computed once), they fan out to their departments, and a
    # shared row whose store has no sales rows stays once with NULLs
    cond = is_shared & (F.col(store_col) == F.col("__s_store"))
    for lc, _ in period_cols:
        cond = cond & (F.col(lc) == F.col(f"__s_{lc}"))
    j = labor.join(sh, cond, "left")
    split_hours = guarded_ratio(F.col(hours_col).cast("double") * F.col("__dep"), F.col("__fil"),
                                null_denominator="null")
    out = (j.withColumn("__shared", is_shared)  # decided on the original department
           .withColumn(dept_col, F.when(F.col("__shared"), F.col("__s_dept"))
                       .otherwise(F.col(dept_col)))
           .withColumn(hours_col, F.when(F.col("__shared"), split_hours)
                       .otherwise(F.col(hours_col)))
           .withColumn(cost_col, F.when(F.col("__shared"), F.col(rate_col) * F.col(hours_col))
                       .otherwise(F.col(cost_col))))
    return out.select(*labor.columns)
