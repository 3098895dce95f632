"""Scoring from kept cells equals scoring from the facts, before and after corrections."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.anomaly import anomaly_all_periods, anomaly_one_period
from ledgerloom.operators.history import HistoryCells
from tests.conftest import rows

SCHEMA = "store int, year int, month int, a decimal(12,2), b decimal(12,2)"


def _facts(spark, seed, months=range(1, 9)):
    from decimal import Decimal
    rng = random.Random(seed)
    data = [(s if rng.random() < 0.98 else None, 2026, m,
             Decimal(rng.choice([1, 2, 3, 40])) if rng.random() < 0.9 else None, Decimal(rng.choice([0, 5, 6, 90])))
            for m in months for s in range(1, 9) for _ in range(rng.randint(0, 3))]
    return spark.createDataFrame(data, SCHEMA)


def _all(df):
    return rows(df, "store", "year", "month", "category", "current", "own_avg_3m", "global_avg")


@pytest.fixture()
def kept(spark, tmpdir_path):
    return HistoryCells(spark, f"{tmpdir_path}/cells", ["store"], ["a", "b"])


def test_scores_of_kept_cells_equal_those_of_the_facts(spark, kept):
    facts = _facts(spark, 1)
    for m in range(1, 9):  # month by month, as they are loaded
        kept.replace(facts.where(F.col("month") == m), [(2026, m)])
    want = _all(anomaly_all_periods(facts, ["a", "b"], ["store"]))
    assert want and _all(kept.score_all()) == want
    for m in (4, 7):
        one = anomaly_one_period(facts.where(F.col("month") == m), facts, 2026, m, ["a", "b"], ["store"])
        cols = ("store", "category", "current", "own_avg_3m", "global_avg")
        assert rows(kept.score(2026, m), *cols) == rows(one, *cols)


def test_a_corrected_month_changes_all_months_that_look_back_to_it(spark, kept):
    facts, other = _facts(spark, 1), _facts(spark, 2, [4])
    kept.replace(facts)
    before = _all(kept.score_all())
    kept.replace(other, [(2026, 4)])
    corrected = facts.where("month <> 4").unionByName(other)
    want = _all(anomaly_all_periods(corrected, ["a", "b"], ["store"]))
    assert _all(kept.score_all()) == want != before
    kept.replace(facts.limit(0), [(2026, 4)])  # the month is withdrawn
    assert _all(kept.score_all()) == _all(anomaly_all_periods(facts.where("month <> 4"), ["a", "b"], ["store"]))
    # a late old drop changes nothing
    kept.replace(other, [(2026, 4)], drops={(2026, 4): (200, "new")})
    kept.replace(facts.where("month = 4"), [(2026, 4)], drops={(2026, 4): (100, "old")})
    assert _all(kept.score_all()) == want


def test_parts_of_a_month_add_up(spark, kept):
    facts = _facts(spark, 3).withColumn("part", F.rand(1) < 0.5).cache()
    kept.add(facts.where("part").drop("part"), [(2026, m) for m in range(1, 9)])
    for m in (3, 5, 6):
        kept.add(facts.where(f"NOT part AND month = {m}").drop("part"), [(2026, m)])
    whole = facts.where("part OR month IN (3, 5, 6)").drop("part")
    assert rows(kept.table.read(), "store", "month", "a", "b", "a__n", "b__n") == \
        rows(kept.cells(whole), "store", "month", "a", "b", "a__n", "b__n")
    assert _all(kept.score_all()) == _all(anomaly_all_periods(whole, ["a", "b"], ["store"]))
    facts.unpersist()


def test_one_month_reads_its_own_and_three_months(spark, kept):
    kept.replace(_facts(spark, 1))
    out = kept.score(2026, 6)
    files = {f.split("month=")[1].split("/")[0] for f in out.inputFiles()}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "load=" not in str(out.columns)
    assert files <= {str(m) for m in range(1, 9)}
