"""Smaller public helpers."""

from pyspark.sql import functions as F

from ledgerloom.functions.scalars import blank_to_null, exact_sum, squash_text
from ledgerloom.operators.composite import DC_COST_KEYS, dc_costs, tariff_by_cost_centre
from ledgerloom.operators.filters import filter_valid_key
from ledgerloom.session import checkpoint_dir
from tests.conftest import rows


def test_text_helpers(spark):
    df = spark.createDataFrame([("Піч Піца 1",), ("   ",), ("",), ("x",)], "s string")
    got = df.select(squash_text(F.col("s")).alias("a"), blank_to_null(F.col("s")).alias("b")).collect()
    assert [r.a for r in got] == ["пічпіца1", "", "", "x"]
    assert [r.b for r in got] == ["Піч Піца 1", None, None, "x"]


def test_valid_keys(spark):
    keys = spark.createDataFrame([("a", "x"), ("-", "x"), ("b", " "), ("c", None), ("\u00a0- \u00a0", "x"),
                                  ("d", "\u00a0")], "p string, q string")
    assert rows(filter_valid_key(keys, "p", "q")) == [("a", "x")]


def test_sums_lose_nothing_below_their_scale(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.lit(0.004).alias("a"), F.lit(0.006).alias("b"))
    got = df.groupBy("k").agg(exact_sum(F.col("a"), 2).cast("double").alias("a"),
                              exact_sum(F.col("b")).cast("double").alias("b")).first()
    assert (got.a, got.b) == (4.0, 6.0)
    one = df.limit(1).agg(exact_sum(F.col("a")).cast("double")).first()[0]
    assert one == 0.004
    costs = df.select(*[F.lit(1).alias(k) for k in DC_COST_KEYS], F.col("a").alias("costsLogistics"),
                      F.col("b").alias("costsOther"))
    got = dc_costs(costs).first()
    assert (float(got.costsLogistics), float(got.costsOther), float(got.costs)) == (4.0, 6.0, 10.0)
    kwh = df.select(F.lit("m\u00a0").alias("mvz"), F.col("a").alias("kwt"), F.col("b").alias("uah"))
    got = tariff_by_cost_centre(kwh).first()
    assert (got.mvz, got.consump_kwt, got.consump_uah) == ("m", 4.0, 7.2)


def test_checkpoint_dir(spark):
    d = checkpoint_dir(spark)
    assert d and spark.sparkContext.getCheckpointDir()


def test_survey_named_operators(spark, tmpdir_path):
    from ledgerloom.operators import replace_period, unmatched_keys
    a = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    b = spark.createDataFrame([(2,)], "k int")
    assert rows(unmatched_keys(a, b, ["k"])) == [(None,), (1,)]
    df = spark.createDataFrame([("x", 2026, 5)], "v string, year int, month int")
    replace_period(df, f"{tmpdir_path}/t", 2026, 5)
    assert rows(spark.read.parquet(f"{tmpdir_path}/t")) == [("x", 2026, 5)]
