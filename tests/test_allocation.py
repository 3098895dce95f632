"""FX6 labour allocation, FX7 dense sales share, FX9 rate fill."""

from pyspark.sql import functions as F

from ledgerloom.operators.allocate import dense_sales_share, labor_allocation
from ledgerloom.operators.enrich import rate_fill
from tests.conftest import rows

SALES = "filid int, depid int, year int, month int, type_oper string, sumout double"


def test_fx7_dense_share(spark):
    sales = spark.createDataFrame([(1, 104, 2026, 5, "sales", 30.0), (1, 105, 2026, 5, "sales", 70.0),
                                   (2, 104, 2025, 5, "sales", 99.0), (1, 104, 2026, 5, "waste", 5.0)],
                                  SALES)
    cal = spark.createDataFrame([(2026, 5), (2026, 6)], "year int, month int")
    out = dense_sales_share(sales, 2026, 5, [104, 105], calendar=cal)
    got = rows(out.select("filid", "depid", F.col("sumout_dep").cast("double").alias("d"),
                          F.col("sumout_filial").cast("double").alias("f")))
    assert got == [(1, 104, 30.0, 100.0), (1, 105, 70.0, 100.0), (2, 104, 0.0, 0.0), (2, 105, 0.0, 0.0)]
    # a month the calendar lacks gives no grid
    assert dense_sales_share(sales, 2026, 7, [104, 105], calendar=cal).count() == 0


def test_fx6_allocation(spark):
    labor = spark.createDataFrame(
        [(1, "104_105", 10.0, 200.0, 2000.0), (2, "104_105", 8.0, 200.0, 1600.0),
         (3, "104_105", 5.0, 200.0, 1000.0), (1, None, 4.0, 150.0, 600.0)],
        "filid int, depid string, hours double, cost_hour double, cost_labor double")
    sales = spark.createDataFrame([(1, 104, 2026, 5, "sales", 30.0), (1, 105, 2026, 5, "sales", 70.0),
                                   (2, 104, 2026, 5, "sales", 0.0), (2, 105, 2026, 5, "sales", 0.0)],
                                  SALES)
    share = dense_sales_share(sales, 2026, 5, [104, 105])
    out = labor_allocation(labor, share, "104_105")
    got = rows(out, "filid", "depid", "hours", "cost_labor")
    assert got == [(1, None, 4.0, 600.0), (1, "104", 3.0, 600.0), (1, "105", 7.0, 1400.0),
                   (2, "104", 0.0, 0.0), (2, "105", 0.0, 0.0), (3, None, None, None)]
    # hours are conserved for stores that sold something
    tot = out.where(F.col("filid") == 1).where(F.col("depid").isNotNull()).agg(F.sum("hours")).first()[0]
    assert tot == 10.0


def test_fx9_rate_fill(spark):
    card = spark.createDataFrame([(1, "A", 100.0), (2, "A", 200.0), (None, "A", 300.0)],
                                 "filid int, role string, rate double")
    hours = spark.createDataFrame([(1, "A", 10.0), (3, "A", 5.0), (1, "B", 2.0)],
                                  "filid int, role string, h double")
    out = rate_fill(hours, card, "role", "filid", "rate", "h")
    assert rows(out, "filid", "role", "cost_hour", "cost_labor") == [
        (1, "A", 100.0, 1000.0), (1, "B", None, None), (3, "A", 200.0, 1000.0)]


def test_sql_form_matches_dataframe_form(spark):
    from ledgerloom.operators.allocate import dense_sales_share_sql
    sales = spark.createDataFrame([(1, 104, 2026, 5, "sales", 30.0), (1, 105, 2026, 5, "sales", 70.0),
                                   (2, 104, 2025, 5, "sales", 99.0), (1, 104, 2026, 5, "waste", 5.0),
                                   (3, 105, 2026, 4, "sales", 1.0)], SALES)
    a = dense_sales_share(sales, 2026, 5, [104, 105], scale=None)
    b = dense_sales_share_sql(spark, sales, 2026, 5, [104, 105])
    assert rows(a) == rows(b.select(*a.columns))
    assert len(rows(a)) == 6


def test_multi_period_share_equals_per_month(spark):
    from ledgerloom.operators.allocate import dense_sales_share_periods
    sales = spark.createDataFrame([(1, 104, 2026, 5, "sales", 30.0), (1, 105, 2026, 6, "sales", 70.0),
                                   (2, 104, 2025, 12, "sales", 99.0), (3, 105, 2025, 11, "sales", 4.0),
                                   (1, 104, 2026, 6, "waste", 5.0)], SALES)
    periods = [(2025, 12), (2026, 5), (2026, 6)]
    together = rows(dense_sales_share_periods(sales, periods, [104, 105]))
    apart = []
    for y, m in periods:
        apart += rows(dense_sales_share(sales, y, m, [104, 105]))
    assert together == sorted(apart, key=lambda t: tuple((v is not None, v) for v in t))
    assert len(together) > 0


def test_no_period_gives_empty_share(spark):
    from ledgerloom.operators.allocate import dense_sales_share_periods
    sales = spark.createDataFrame([(1, 104, 2026, 5, "sales", 30.0)], SALES)
    out = dense_sales_share_periods(sales, [], [104, 105])
    assert out.count() == 0
    assert out.columns == ["year", "month", "filid", "depid", "sumout_dep", "sumout_filial"]


def test_given_store_list_replaces_stores_ever_seen(spark):
    sales = spark.createDataFrame([(1, 104, 2026, 5, "sales", 30.0), (2, 105, 2020, 1, "sales", 1.0)],
                                  SALES)
    stores = spark.createDataFrame([(1,), (3,)], "filid int")
    got = rows(dense_sales_share(sales, 2026, 5, [104, 105], stores=stores), "filid", "depid")
    assert got == [(1, 104), (3, 104)]
