"""Rejected lines of the headerless drops: kept as they stand, counted per file."""

from pyspark.sql import functions as F

from ledgerloom.operators.periods import PeriodTable
from ledgerloom.plans import monthly
from ledgerloom.sources.scans import scan_with_rejects
from tests.conftest import rows


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


GOOD = "2026;5;202605;1;10;100;A;12.50\n"


def test_every_line_is_loaded_or_rejected(spark, tmpdir_path):
    bad = ["2026;5;202605;1;10;100;A;1;extra", "2026;5;202605;1", "2026;5;202605;1;ten;100;A;1", "2026;5;202605;1;10;100;A;12,5"]
    _write(f"{tmpdir_path}/MC_2605.csv", "﻿" + GOOD + "\n".join(bad) + "\n\n" + GOOD + '2026;5;202605;1;11;100;"B;""q""";2\n')
    _write(f"{tmpdir_path}/MC_2606.csv", "2026;6;202606;1;10;100;A;3\n2026;6;x;1;10;100;A;3\n")
    run = monthly.store_costs_drop(spark, f"{tmpdir_path}/MC_*.csv", quarantine=True)
    target, aside = f"{tmpdir_path}/target", PeriodTable(spark, f"{tmpdir_path}/aside")
    found = monthly.load(run, target, quarantine=aside)
    loaded = spark.read.parquet(target).select("month", "filid", "proekt", F.col("costs").cast("double").alias("costs"))
    assert rows(loaded) == [(5, 10, "A", 25.0), (5, 11, 'B;"q"', 2.0), (6, 10, "A", 3.0)]
    kept = aside.read()
    assert rows(kept, "month", "line", "reason") == sorted([
        (5, bad[0], "too many fields"), (5, bad[1], "too few fields"), (5, bad[2], "no number in filid"),
        (5, bad[3], "no number in costs"), (6, "2026;6;x;1;10;100;A;3", "no number in ym")])
    counts = {(r.subject, r.detail): r.n for r in found.collect() if r.check == "rejected"}
    assert counts[("MC_2605.csv", "too few fields")] == 1 and sum(counts.values()) == 5
    read = next(r.n for r in found.collect() if r.check == "rows")
    assert read + sum(counts.values()) == 3 + 5 + 1  # loaded (before summing) + rejected = lines
    # a mended drop empties its month's quarantine, other months stay
    _write(f"{tmpdir_path}/MC_2605.csv", GOOD)
    again = monthly.store_costs_drop(spark, f"{tmpdir_path}/MC_2605.csv", quarantine=True)
    monthly.load(again, target, quarantine=aside)
    assert rows(aside.read(), "month") == [(6,)] and rows(spark.read.parquet(target), "month") == [(5,), (6,)]


def test_short_rows_are_fine_where_the_layout_allows_them(spark, tmpdir_path):
    _write(f"{tmpdir_path}/RC_2605.csv", "2026;5;202605;1;2;3;1.5;2\n2026;5;202605;1;2;3;1;1;9\n2026;5;202605;1;2;3;1\n")
    run = monthly.dc_costs_drop(spark, f"{tmpdir_path}/RC_2605.csv", quarantine=True)
    got = rows(run.result.select(*[F.col(c).cast("double") for c in ("costsLogistics", "costsOther", "costs")]))
    assert got == [(2.5, 3.0, 5.5)]
    assert rows(run.rejected, "line", "reason") == [("2026;5;202605;1;2;3;1", "too few fields")]
    plain = monthly.dc_costs_drop(spark, f"{tmpdir_path}/RC_2605.csv")
    assert plain.rejected is None


def test_empty_drop(spark, tmpdir_path):
    _write(f"{tmpdir_path}/MC_2605.csv", "\n\n")
    lines = scan_with_rejects(spark, f"{tmpdir_path}/MC_2605.csv", ["a", "b"])
    assert lines.count() == 0
    run = monthly.store_costs_drop(spark, f"{tmpdir_path}/MC_2605.csv", quarantine=True)
    assert run.result.count() == 0 and run.rejected.count() == 0 and run.periods == [(2026, 5)]
