"""Atomic replacement of months, the drop ledger, and clearing without job metrics."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import periods as P
from ledgerloom.operators import sink
from ledgerloom.plans import monthly
from ledgerloom.streaming.ingest import ingest_monthly_drops
from tests.conftest import rows

SCHEMA = "k string, v double, year int, month int"


def _df(spark, *data):
    return spark.createDataFrame(list(data), SCHEMA)


def test_replace_and_clear_are_one_version(spark, tmpdir_path):
    t = P.PeriodTable(spark, f"{tmpdir_path}/t")
    with pytest.raises(ValueError):
        t.read()
    assert t.replace(_df(spark, ("a", 1.0, 2026, 4), ("b", 2.0, 2026, 5))) == 1
    old = t.read()
    assert t.replace(_df(spark, ("c", 3.0, 2026, 5)), [(2026, 4), (2026, 5)]) == 2
    assert rows(t.read(), "k", "year", "month") == [("c", 2026, 5)]
    # the earlier version, and a frame taken from it, still read whole
    assert rows(t.read(1), "k") == rows(old, "k") == [("a",), ("b",)]
    t.replace(_df(spark), [(2026, 5)])
    assert t.read().count() == 0 and t.periods() == {}
    assert t.read().columns == ["k", "v", "year", "month"]


def test_a_reader_sees_old_or_new_between_any_two_steps(spark, tmpdir_path, monkeypatch):
    t = P.PeriodTable(spark, f"{tmpdir_path}/t")
    t.replace(_df(spark, ("a", 1.0, 2026, 4), ("b", 1.0, 2026, 5)))
    seen = []
    real = {name: getattr(P.StateLog, name) for name in ("latest", "publish")}

    def watched(name):
        def call(self, *args):
            seen.append(rows(P.PeriodTable(spark, t.root).read(
                real["latest"](self)[0]), "k"))
            out = real[name](self, *args)
            seen.append(rows(P.PeriodTable(spark, t.root).read(real["latest"](self)[0]), "k"))
            return out
        return call

    reader_log = P.StateLog.latest
    for name in real:
        monkeypatch.setattr(t.log, name, watched(name).__get__(t.log))
    t.replace(_df(spark, ("c", 1.0, 2026, 5)), [(2026, 4), (2026, 5)])
    assert {tuple(s) for s in seen} == {(("a",), ("b",)), (("c",),)}
    assert reader_log is P.StateLog.latest


def test_a_killed_load_leaves_the_old_months(spark, tmpdir_path):
    t = P.PeriodTable(spark, f"{tmpdir_path}/t")
    t.replace(_df(spark, ("a", 1.0, 2026, 5)))
    bad = _df(spark, *[("x", float(i), 2026, 5) for i in range(50)]).repartition(5).withColumn(
        "v", F.when(F.col("v") == 40, F.raise_error(F.lit("killed"))).otherwise(F.col("v")))
    with pytest.raises(Exception, match="killed"):
        t.replace(bad, [(2026, 5)])
    assert rows(t.read(), "k") == [("a",)]
    # written but not committed: no version names the folder
    t.log.publish = lambda version, state: (_ for _ in ()).throw(RuntimeError("died"))
    with pytest.raises(RuntimeError):
        t.replace(_df(spark, ("z", 1.0, 2026, 5)))
    assert rows(P.PeriodTable(spark, t.root).read(), "k") == [("a",)]


def test_two_writers_both_win_their_months(spark, tmpdir_path):
    a, b = (P.PeriodTable(spark, f"{tmpdir_path}/t") for _ in range(2))
    a.replace(_df(spark, ("a", 1.0, 2026, 4)))
    stale = b.log.latest()
    first = iter([stale])
    fresh = b.log.latest
    b.log.latest = lambda: next(first, None) or fresh()
    a.replace(_df(spark, ("c", 1.0, 2026, 6)))
    b.replace(_df(spark, ("b", 1.0, 2026, 5)))  # starts from a version that is no longer the newest
    assert rows(a.read(), "k", "month") == [("a", 4), ("b", 5), ("c", 6)]
    log = P.StateLog(spark, f"{tmpdir_path}/log")
    assert log.publish(1, {"x": 1}) and not log.publish(1, {"x": 2})
    assert log.latest() == (1, {"x": 1})


def test_columns_may_come_but_not_change_type(spark, tmpdir_path):
    t = P.PeriodTable(spark, f"{tmpdir_path}/t")
    t.replace(_df(spark, ("a", 1.0, 2026, 4)))
    t.replace(_df(spark, ("b", 2.0, 2026, 5)).withColumn("w", F.lit("new")))
    assert rows(t.read(), "k", "w") == [("a", None), ("b", "new")]
    with pytest.raises(ValueError, match="column v"):
        t.replace(_df(spark, ("b", 2.0, 2026, 5)).withColumn("v", F.lit("text")))
    with pytest.raises(ValueError, match="without a period"):
        t.replace(_df(spark, ("b", 2.0, None, 5)))
    plan = t.read().where("year = 2026 AND month = 5")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


@pytest.mark.parametrize("kind", ["path", "table"])
def test_lost_metrics_clear_nothing(spark, tmpdir_path, kind, monkeypatch):
    """No month is cleared on the word of job metrics: there are none to lose."""
    from ledgerloom.operators import quality
    monkeypatch.setattr(quality, "observed", lambda obs: {})
    root = f"{tmpdir_path}/t" if kind == "path" else P.PeriodTable(spark, f"{tmpdir_path}/t")
    read = (lambda: spark.read.parquet(root)) if kind == "path" else (lambda: root.read())
    for _ in range(2):
        sink.write_period(_df(spark, ("a", 1.0, 2026, 5)), root, 2026, 5)
        assert rows(read(), "k") == [("a",)]
    sink.write_periods(_df(spark, ("b", 1.0, 2026, 4), ("c", 1.0, 2026, 5)), root,
                       periods=[(2026, 4), (2026, 5)])
    sink.write_periods(_df(spark, ("d", 1.0, 2026, 4)), root, periods=[(2026, 4), (2026, 5)])
    assert rows(read(), "k") == [("d",)]
    with pytest.raises(sink.PeriodMismatch):
        sink.write_period(_df(spark, ("x", 1.0, 2026, 6)), root, 2026, 5)
    assert rows(read(), "k") == [("d",)]


def test_feed_loads_into_a_period_table(spark, tmpdir_path):
    def write(name, text):
        path = f"{tmpdir_path}/{name}"
        with open(path, "w") as f:
            f.write(text)
        return path

    t = P.PeriodTable(spark, f"{tmpdir_path}/t")
    head = "МВЗ (Код),Место возникновения затрат,kwt,uah\n"
    write("tariff_2604.csv", head + "M1,a,10,100\n")
    write("tariff_2605.csv", head + "M1,a,10,200\n")
    monthly.load(monthly.tariff_drop(spark, f"{tmpdir_path}/tariff_*.csv"), t)
    assert rows(t.read(), "month", "consump_uah") == [(4, 120.0), (5, 240.0)]
    write("tariff_2605.csv", head + "-,a,10,200\n")  # no valid key is left
    monthly.load(monthly.tariff_drop(spark, f"{tmpdir_path}/tariff_*.csv"), t)
    assert rows(t.read(), "month") == [(4,)]


# -- the stream ---------------------------------------------------------------

class Landing:
    def __init__(self, spark, folder, kind):
        self.spark, self.folder, self.n = spark, folder, 0
        os.makedirs(f"{folder}/landing")
        self.path = f"{folder}/target"
        self.table = P.PeriodTable(spark, self.path) if kind == "table" else None

    def drop(self, name, at, *values):
        path = f"{self.folder}/landing/{name}.csv"
        with open(path, "w") as f:
            f.writelines(f"{v}\n" for v in values)
        os.utime(path, (at, at))

    def run(self, fresh=False):
        if fresh:
            self.n += 1
        q = ingest_monthly_drops(
            self.spark, f"{self.folder}/landing", "v double",
            lambda b: b.select("v", F.col("file_year").alias("year"), F.col("file_month").alias("month")),
            self.table or self.path, f"{self.folder}/ckpt{self.n}")
        q.awaitTermination()
        target = self.table.read() if self.table else self.spark.read.parquet(self.path)
        return rows(target, "month", "v")


@pytest.mark.parametrize("kind", ["path", "table"])
def test_an_older_drop_in_a_later_batch_changes_nothing(spark, tmpdir_path, kind):
    landing = Landing(spark, tmpdir_path, kind)
    landing.drop("x_2605_new", 2_000_000_000, 20.0)
    assert landing.run() == [(5, 20.0)]
    landing.drop("x_2605_old", 1_900_000_000, 10.0)
    landing.drop("x_2606", 1_900_000_000, 6.0)
    assert landing.run() == [(5, 20.0), (6, 6.0)]
    landing.drop("x_2605_newest", 2_000_000_100, 30.0, 31.0)
    assert landing.run() == [(5, 30.0), (5, 31.0), (6, 6.0)]


@pytest.mark.parametrize("kind", ["path", "table"])
def test_the_newest_file_clears_its_month_when_it_has_no_rows(spark, tmpdir_path, kind):
    landing = Landing(spark, tmpdir_path, kind)
    landing.drop("x_2605", 1_900_000_000, 1.0)
    landing.drop("x_2606", 1_900_000_000, 2.0)
    assert landing.run() == [(5, 1.0), (6, 2.0)]
    landing.drop("x_2605_b", 1_900_000_100)
    landing.drop("x_2606_b", 1_800_000_000)  # older than what was loaded
    landing.drop("x_2607", 1_900_000_100, 7.0)
    assert landing.run() == [(6, 2.0), (7, 7.0)]
    landing.drop("x_2605_c", 1_900_000_050, 9.0)  # older than the empty one
    assert landing.run() == [(6, 2.0), (7, 7.0)]


def test_replays_change_nothing(spark, tmpdir_path):
    landing = Landing(spark, tmpdir_path, "table")
    landing.drop("x_2605_new", 2_000_000_000, 20.0)
    landing.drop("x_2605_old", 1_900_000_000, 10.0)
    assert landing.run() == [(5, 20.0)]
    version = landing.table.log.latest()[0]
    assert landing.run(fresh=True) == [(5, 20.0)]  # the stream's progress is lost: all files come again
    assert landing.table.log.latest()[0] == version
