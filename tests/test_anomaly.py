"""FX5 anomalies and the invariants between the two scoring forms."""

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.anomaly import (
    REASON_BOTH,
    anomaly_all_periods,
    anomaly_one_period,
    keys_without_history,
)

HISTORY = [("k1", 2026, 2, 10.0), ("k1", 2026, 3, 10.0), ("k1", 2026, 4, 10.0),
           ("k2", 2026, 2, 10.0), ("k2", 2026, 3, 0.0), ("k2", 2026, 4, 10.0),
           ("k3", 2026, 3, 100.0), ("k3", 2026, 4, 100.0),
           ("k4", 2026, 2, 20.0), ("k4", 2026, 3, 20.0), ("k4", 2026, 4, 20.0)]
NEW = [("k1", 60.0), ("k2", 60.0), ("k3", 500.0), ("k4", 56.0), ("k5", 999.0)]
SCHEMA_H = "key string, year int, month int, v double"


def _run(spark, history, new, year=2026, month=5, threshold=1.0):
    h = spark.createDataFrame(history, SCHEMA_H)
    n = spark.createDataFrame(new, "key string, v double")
    return anomaly_one_period(n, h, year, month, ["v"], ["key"], threshold)


def test_fx5_flags_only_k1(spark):
    out = _run(spark, HISTORY, NEW).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.key, r.category, r.current) == ("k1", "v", 60.0)
    assert r.own_avg_3m == pytest.approx(10.0)
    assert r.global_avg == pytest.approx(310 / 11)
    assert r.reason == REASON_BOTH


def test_fx5_negative_value_is_flagged(spark):
    new = [("k1", -60.0)] + NEW[1:]
    assert [r.key for r in _run(spark, HISTORY, new).collect()] == ["k1"]


def test_fx5_null_and_nan_history_block(spark):
    hist = [h if not (h[0] == "k1" and h[2] == 3) else ("k1", 2026, 3, None) for h in HISTORY]
    assert _run(spark, hist, NEW).count() == 0
    hist_nan = [h if not (h[0] == "k1" and h[2] == 3) else ("k1", 2026, 3, float("nan"))
                for h in HISTORY]
    h = spark.createDataFrame(hist_nan, SCHEMA_H)
    from ledgerloom.functions.scalars import nan_to_null
    h = h.withColumn("v", nan_to_null(F.col("v")))
    n = spark.createDataFrame(NEW, "key string, v double")
    assert anomaly_one_period(n, h, 2026, 5, ["v"], ["key"]).count() == 0


def test_fx5_year_wrap_reads_previous_year(spark):
    hist = [("k1", 2025, 10, 10.0), ("k1", 2025, 11, 10.0), ("k1", 2025, 12, 10.0),
            ("k4", 2025, 10, 20.0), ("k4", 2025, 11, 20.0), ("k4", 2025, 12, 20.0),
            ("k1", 2025, 9, 1000.0)]
    out = _run(spark, hist, [("k1", 60.0), ("k4", 20.0)], 2026, 1).collect()
    assert [r.key for r in out] == ["k1"]


def test_fx5_zero_global_mean_flags_nothing(spark):
    hist = [("k1", 2026, m, v) for m, v in [(2, 10.0), (3, 10.0), (4, 10.0)]] + \
           [("k2", 2026, m, -v) for m, v in [(2, 10.0), (3, 10.0), (4, 10.0)]]
    assert _run(spark, hist, [("k1", 100.0)]).count() == 0


def test_unmatched_keys(spark):
    h = spark.createDataFrame(HISTORY, SCHEMA_H)
    n = spark.createDataFrame(NEW, "key string, v double")
    assert [r.key for r in keys_without_history(n, h, 2026, 5, ["key"]).collect()] == ["k5"]


def _facts(spark, sf):
    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    return (li.select("l_suppkey", F.year("l_shipdate").alias("year"),
                      F.month("l_shipdate").alias("month"),
                      *[F.when(F.col("l_returnflag") == f, F.col("l_extendedprice").cast("decimal(18,2)"))
                        .alias(f) for f in "ANR"])
            .groupBy("l_suppkey", "year", "month")
            .agg(*[F.coalesce(F.sum(f), F.lit(0)).alias(f) for f in "ANR"]))


def test_all_periods_equals_one_period_per_month(spark):
    facts = _facts(spark, "/root/testdata/sf0.001")
    allp = anomaly_all_periods(facts, list("ANR"), ["l_suppkey"])
    for (y, m) in [(1997, 6), (1999, 1), (2000, 3)]:
        cur = facts.where((F.col("year") == y) & (F.col("month") == m))
        one = anomaly_one_period(cur, facts, y, m, list("ANR"), ["l_suppkey"])
        a = sorted(tuple(r) for r in allp.where((F.col("year") == y) & (F.col("month") == m))
                   .drop("year", "month").collect())
        b = sorted(tuple(r) for r in one.collect())
        assert a == b, (y, m)


def test_scaling_leaves_flags_unchanged(spark):
    facts = _facts(spark, "/root/testdata/sf0.001")
    scaled = facts.select("l_suppkey", "year", "month", *[(F.col(f) * 3).alias(f) for f in "ANR"])
    a = {(r.l_suppkey, r.year, r.month, r.category) for r in
         anomaly_all_periods(facts, list("ANR"), ["l_suppkey"]).collect()}
    b = {(r.l_suppkey, r.year, r.month, r.category) for r in
         anomaly_all_periods(scaled, list("ANR"), ["l_suppkey"]).collect()}
    assert a == b and len(a) > 0
