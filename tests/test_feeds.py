"""FX1 tariff, FX2 store costs, FX3 DC costs, FX8 meter, FX10 replace period, streaming."""

import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.composite import tariff_by_cost_centre
from ledgerloom.operators.enrich import store_directory
from ledgerloom.operators.sink import PeriodMismatch, replace_period_frame, write_period, write_periods
from ledgerloom.plans import monthly
from ledgerloom.streaming.ingest import ingest_monthly_drops
from tests.conftest import rows


def _write(path, text, bom=False):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write(text)


def test_fx1_tariff_operator(spark):
    df = spark.createDataFrame([("M1", 100.0, 500.0), ("M1", 50.0, 100.0), ("M2", 0.0, 30.0),
                                ("-", 5.0, 5.0), (None, 1.0, 1.0), ("  ", 2.0, 2.0),
                                ("M3", None, None)], "mvz string, kwt double, uah double")
    assert rows(tariff_by_cost_centre(df)) == [("M1", 150.0, 720.0, 4.8), ("M2", 0.0, 36.0, 0.0),
                                                ("M3", 0.0, 0.0, 0.0)]


def test_fx1_tariff_drop_file(spark, tmpdir_path):
    _write(f"{tmpdir_path}/tariff_2604.csv",
           "'МВЗ (Код),Место возникновения затрат,kwt,uah\n"
           "M1,a,100,500\nM1,a,50,100\nM2,b,0,30\n-,c,5,5\n,d,1,1\n  ,e,2,2\nM3,f,,\n")
    run = monthly.tariff_drop(spark, f"{tmpdir_path}/tariff_*.csv")
    assert rows(run.result) == [("M1", 2026, 4, 150.0, 720.0, 4.8), ("M2", 2026, 4, 0.0, 36.0, 0.0),
                                ("M3", 2026, 4, 0.0, 0.0, 0.0)]
    dq = {r.check: r.n for r in run.dq.collect()}
    assert dq["invalid_key"] == 3 and dq["duplicate_key"] == 0


def test_fx2_store_costs(spark, tmpdir_path):
    _write(f"{tmpdir_path}/MC_2605.csv",
           "2026;5;202605;1;10;100;A;12.50\n2026;5;202605;1;10;100;A;1.25\n"
           "2026;5;202605;1;10;100;;9.99\n2026;5;202605;1;11;100;B;0.00\n", bom=True)
    run = monthly.store_costs_drop(spark, f"{tmpdir_path}/MC_*.csv")
    got = rows(run.result.select("year", "filid", "proekt", F.col("costs").cast("string")))
    assert got == [(2026, 10, "A", "13.75"), (2026, 11, "B", "0.00")]
    dq = {r.check: r.n for r in run.dq.collect()}
    assert dq["null_key"] == 1 and dq["period_mismatch"] == 0


def test_fx3_dc_costs(spark, tmpdir_path):
    _write(f"{tmpdir_path}/RC_2605.csv",
           "2026;5;202605;1;7;100;10;;\n2026;5;202605;1;7;100;;5;\n2026;5;202605;1;8;101;;;\n")
    run = monthly.dc_costs_drop(spark, f"{tmpdir_path}/RC_*.csv")
    assert rows(run.result, "postid", "lagerid", "costsLogistics", "costsOther", "costs") == [
        (7, 100, 10.0, 5.0, 15.0), (8, 101, 0.0, 0.0, 0.0)]


def test_fx8_meter(spark, tmpdir_path):
    _write(f"{tmpdir_path}/meter_2605.csv",
           "Дата,Час,Магазин,Піч піца,Пічпіца,ПКВ допік,ПКВ\n"
           '2026-05-31,10,"002, Київ",1,2,5,4\n'
           '2026-05-31,10,"003, Київ (Оренда)",0,0,0,0\n'
           '01.06.2026,10,"002, Київ",9,9,9,9\n'
           '2026-05-31,10,"002, Київ (Рефіт)",1,0,0,\n'
           "2026-05-31,10,XYZ,1,1,1,1\n")
    directory = store_directory(spark.createDataFrame(
        [(21, "2"), (31, "3"), (99, None)], "id int, AccountantNumber string"),
        name_col=None, mvz_col=None)
    run = monthly.meter_drop(spark, [f"{tmpdir_path}/meter_2605.csv"], directory)
    assert rows(run.result) == [(2026, 5, 21, 4.0, 0.0, 0.0, 5.0, 4.0)]
    dq = {}
    for r in run.dq.collect():
        dq[r.check] = dq.get(r.check, 0) + r.n
    assert dq["repeated_header"] == 2 and dq["missing_column"] == 23 and dq["unmatched"] == 1


def test_fx10_replace_period(spark, tmpdir_path):
    schema = "k string, year int, month int"
    root = f"{tmpdir_path}/target"
    write_periods(spark.createDataFrame([("a", 2026, 4), ("b", 2026, 5)], schema), root)
    new = spark.createDataFrame([("c", 2026, 5)], schema)
    write_period(new, root, 2026, 5)
    write_period(new, root, 2026, 5)
    assert rows(spark.read.parquet(root), "k", "year", "month") == [("a", 2026, 4), ("c", 2026, 5)]
    write_period(spark.createDataFrame([], schema), root, 2026, 5)
    assert rows(spark.read.parquet(root), "k") == [("a",)]
    with pytest.raises(PeriodMismatch):
        write_period(spark.createDataFrame([("x", 2026, 4), ("y", 2026, 5)], schema), root, 2026, 5)
    # the failed load committed nothing
    assert rows(spark.read.parquet(root), "k", "year", "month") == [("a", 2026, 4)]
    hist = spark.createDataFrame([("a", 2026, 4), ("b", 2026, 5)], schema)
    assert rows(replace_period_frame(hist, new, 2026, 5)) == [("a", 2026, 4), ("c", 2026, 5)]


def test_streaming_ingest_replaces_periods(spark, tmpdir_path):
    landing, target, ckpt = (f"{tmpdir_path}/{x}" for x in ("landing", "target", "ckpt"))
    schema = ("year int, month int, ym int, rcid int, filid int, lagerid int, proekt string, "
              "costs decimal(12,2)")

    def transform(batch):
        from ledgerloom.operators.composite import store_costs
        ok = batch.where((F.col("year") == F.col("file_year")) & (F.col("month") == F.col("file_month")))
        return store_costs(ok)

    _write(f"{landing}/MC_2604.csv", "2026;4;202604;1;10;100;A;1.00\n")
    _write(f"{landing}/MC_2605.csv", "2026;5;202605;1;10;100;A;2.00\n")
    q = ingest_monthly_drops(spark, landing, schema, transform, target, ckpt, sep=";")
    q.awaitTermination()
    got = rows(spark.read.parquet(target).select("year", "month", F.col("costs").cast("double")))
    assert got == [(2026, 4, 1.0), (2026, 5, 2.0)]
    # a corrected May drop replaces only May
    _write(f"{landing}/MC_2605_v2.csv", "2026;5;202605;1;10;100;A;7.00\n")
    q = ingest_monthly_drops(spark, landing, schema, transform, target, ckpt, sep=";")
    q.awaitTermination()
    got = rows(spark.read.parquet(target).select("year", "month", F.col("costs").cast("double")))
    assert got == [(2026, 4, 1.0), (2026, 5, 7.0)]


def test_streaming_default_checkpoint_resumes(spark, tmpdir_path):
    landing, target = f"{tmpdir_path}/landing", f"{tmpdir_path}/target"
    schema = "year int, month int, v double"
    _write(f"{landing}/x_2601.csv", "2026;1;1.5\n")
    q1 = ingest_monthly_drops(spark, landing, schema, lambda b: b.select("year", "month", "v"),
                              target, sep=";")
    q1.awaitTermination()
    _write(f"{landing}/x_2602.csv", "2026;2;2.5\n")
    q = ingest_monthly_drops(spark, landing, schema, lambda b: b.select("year", "month", "v"),
                             target, sep=";")
    q.awaitTermination()
    # the second run read as much as the first: only the new file (progress was kept)
    assert q.lastProgress["numInputRows"] == q1.lastProgress["numInputRows"] > 0
    assert rows(spark.read.parquet(target), "year", "month", "v") == [(2026, 1, 1.5), (2026, 2, 2.5)]


def test_fx6_labor_drop(spark, tmpdir_path):
    _write(f"{tmpdir_path}/labor_2605.csv",
           "filid,mm,h,category,filialname\n"
           "1,5,6,Кулінарія/Гриль,S1\n1,5,4,Кулінарія/Гриль,S1\n2,5,8,Кулінарія/Гриль,S2\n"
           "3,5,5,Кулінарія/Гриль,S3\n1,5,4,Касир,S1\n")
    roles = spark.createDataFrame(
        [("Кулінарія/Гриль", "Кухар", "104_105", "Кулінарія"), ("Касир", "Касир", "106", "Каса")],
        "`посада з годин` string, `Посада з зп` string, depid string, `Відділ` string")
    rate_col = "вартість години з податками з 04_26"
    card = spark.createDataFrame(
        [("1001", "Кухар", 200.0), ("1002", "Кухар", 200.0), ("1003", "Кухар", 200.0),
         ("1001", "Касир", 150.0)], f"`№ магазина` string, `посада` string, `{rate_col}` double")
    directory = store_directory(spark.createDataFrame(
        [(1, "1001"), (2, "1002"), (3, "1003")], "id int, AccountantNumber string"),
        name_col=None, mvz_col=None)
    sales = spark.createDataFrame(
        [(1, 104, 2026, 5, "sales", 30.0), (1, 105, 2026, 5, "sales", 70.0),
         (2, 104, 2026, 5, "sales", 0.0), (2, 105, 2026, 5, "sales", 0.0)],
        "filid int, depid int, year int, month int, type_oper string, sumout double")
    run = monthly.labor_drop(spark, f"{tmpdir_path}/labor_*.csv", roles, card, directory, sales,
                             rate_col)
    found = {r.check: r.n for r in run.dq.collect()}
    assert found["shared_hours_zero_sales"] == 1 and found["shared_hours_no_sales"] == 1
    assert rows(run.result) == [
        (2026, 5, 1, 104, 3.0, 200.0, 600.0),
        (2026, 5, 1, 105, 7.0, 200.0, 1400.0), (2026, 5, 1, 106, 4.0, 150.0, 600.0),
        (2026, 5, 2, 104, 0.0, 200.0, 0.0), (2026, 5, 2, 105, 0.0, 200.0, 0.0),
        (2026, 5, 3, None, None, 200.0, None)]


def test_fx4_accounts_drop(spark, tmpdir_path):
    from tests.test_filldown import EXPECTED, REPORT
    df = spark.createDataFrame(REPORT, "row_no long, `Стаття/МВЗ` string, `Назва` string, "
                                       "uah string, percent double")
    df.write.parquet(f"{tmpdir_path}/accounts_2604.parquet")
    directory = store_directory(spark.createDataFrame(
        [(11, "A", "1", "1001"), (12, "B", "2", "1002")],
        "id int, name string, AccountantNumber string, MVZ string"))
    run = monthly.accounts_drop(spark, f"{tmpdir_path}/accounts_*.parquet", directory)
    got = rows(run.result, "filid", "account", "name", "sum", "share_TO")
    assert got == EXPECTED
    assert {(r.year, r.month) for r in run.result.collect()} == {(2026, 4)}
    assert {r.check: r.n for r in run.dq.collect()}["no_article"] == 1


def test_history_read_is_partition_pruned(spark, tmpdir_path):
    from ledgerloom.operators.anomaly import anomaly_one_period
    root = f"{tmpdir_path}/meter"
    hist = spark.createDataFrame([(k, 2026, m, float(m)) for k in range(5) for m in range(1, 7)],
                                 "filid int, year int, month int, v double")
    write_periods(hist, root)
    cur = spark.createDataFrame([(1, 2026, 5, 50.0)], "filid int, year int, month int, v double")
    out = anomaly_one_period(cur, spark.read.parquet(root), 2026, 5, ["v"], ["filid"])
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "month#" in plan


def test_tariff_months_load_and_score(spark, tmpdir_path):
    """Four monthly drops in one call, loaded at once, scored one month and all months."""
    landing, root = f"{tmpdir_path}/landing", f"{tmpdir_path}/tariff"
    head = "МВЗ (Код),Место возникновения затрат,kwt,uah\n"
    for m, (m1, m2) in {1: (100, 100), 2: (110, 90), 3: (90, 110), 4: (500, 100)}.items():
        _write(f"{landing}/tariff_26{m:02d}.csv", head + f"M1,a,10,{m1}\nM2,b,10,{m2}\nM3,c,10,100\n")
    run = monthly.tariff_drop(spark, f"{landing}/tariff_*.csv")
    monthly.load(run, root)
    target = spark.read.parquet(root)
    assert target.count() == 12
    flagged = monthly.score(run, target, 2026, 4).collect()
    assert {(r.mvz, r.category) for r in flagged} == {("M1", "consump_uah"), ("M1", "tariff")}
    r = [x for x in flagged if x.category == "consump_uah"][0]
    assert (r.current, r.own_avg_3m, r.global_avg) == (600.0, 120.0, 120.0)
    every = monthly.score_history(target, run.contract).collect()
    assert {(r.mvz, r.year, r.month, r.category) for r in every} == {
        ("M1", 2026, 4, "consump_uah"), ("M1", 2026, 4, "tariff")}
    # reloading April alone replaces only April
    _write(f"{landing}/v2/tariff_2604.csv", head + "M1,a,10,100\n")
    monthly.load(monthly.tariff_drop(spark, f"{landing}/v2/tariff_2604.csv"), root, 2026, 4)
    assert spark.read.parquet(root).count() == 10


def test_load_returns_findings_observed_in_the_same_job(spark, tmpdir_path):
    _write(f"{tmpdir_path}/MC_2605.csv",
           "2026;5;202605;1;10;100;A;12.50\n2026;5;202605;1;10;100;A;1.25\n"
           "2026;5;202605;1;10;100;;9.99\n2026;4;202604;1;11;100;B;0.00\n")
    run = monthly.store_costs_drop(spark, f"{tmpdir_path}/MC_*.csv")
    found = {r.check: r.n for r in monthly.load(run, f"{tmpdir_path}/target", 2026, 5).collect()}
    assert found == {"rows": 4, "period_mismatch": 1, "null_key": 1, "bad_number": 0}
    standalone = {r.check: r.n for r in run.dq.collect()}
    assert standalone["period_mismatch"] == 1 and standalone["null_key"] == 1
    loaded = spark.read.parquet(f"{tmpdir_path}/target")
    assert rows(loaded.select("filid", "proekt", F.col("costs").cast("double"))) == [(10, "A", 13.75)]

    _write(f"{tmpdir_path}/t/tariff_2604.csv",
           "'МВЗ (Код),Место возникновения затрат,kwt,uah\nM1,a,100,500\n-,c,5,5\n,d,1,1\n")
    t = monthly.tariff_drop(spark, f"{tmpdir_path}/t/tariff_*.csv")
    found = {}
    for r in monthly.load(t, f"{tmpdir_path}/tt").collect():
        found[r.check] = found.get(r.check, 0) + r.n
    assert found["invalid_key"] == 2 and found["rows"] == 3 and "missing_column" not in found


def test_fx6_labor_findings(spark, tmpdir_path):
    _write(f"{tmpdir_path}/labor_2605.csv",
           "filid,mm,h,region,filialname\n1,5,6,Кулінарія/Гриль,S1\n1,5,4,Касир,S1\n2,5,1,Охорона,S2\n"
           "2,6,1,Касир,S2\n")
    roles = spark.createDataFrame(
        [("Кулінарія/Гриль", "Кухар", "104", "Кулінарія"), ("Касир", "Касир", "106", "Каса")],
        "`посада з годин` string, `Посада з зп` string, depid string, `Відділ` string")
    card = spark.createDataFrame([("1001", "Кухар", 200.0)],
                                 "`№ магазина` string, `посада` string, rate double")
    directory = store_directory(spark.createDataFrame([(1, "1001")], "id int, AccountantNumber string"),
                                name_col=None, mvz_col=None)
    sales = spark.createDataFrame([], "filid int, depid int, year int, month int, type_oper string, "
                                      "sumout double")
    run = monthly.labor_drop(spark, f"{tmpdir_path}/labor_*.csv", roles, card, directory, sales, "rate")
    found = {r.check: r.n for r in run.dq.collect()}
    assert found["unmatched"] == 1 and found["shared_role_mismatch"] == 1 and found["no_rate"] == 2
    assert found["period_mismatch"] == 1
    assert {(r.y, r.m) for r in run.result.collect()} == {(2026, 5)}


def test_command_line_backfill_then_one_month(spark, tmpdir_path):
    from ledgerloom.plans import run as cli
    landing = f"{tmpdir_path}/landing"
    head = "МВЗ (Код),Место возникновения затрат,kwt,uah\n"
    for m, v in {1: 100, 2: 110, 3: 90}.items():
        _write(f"{landing}/tariff_26{m:02d}.csv", head + f"M1,a,10,{v}\nM2,b,10,100\n")
    target, anomalies, findings = (f"{tmpdir_path}/{x}" for x in ("t", "a", "f"))
    args = cli.parser().parse_args(["tariff", "--drop", f"{landing}/tariff_*.csv", "--target", target,
                                    "--anomalies", anomalies, "--findings", findings])
    cli.run(spark, args)
    assert spark.read.parquet(target).count() == 6
    _write(f"{landing}/new/tariff_2604.csv", head + "M1,a,10,500\nM2,b,10,100\n")
    args = cli.parser().parse_args(["tariff", "--drop", f"{landing}/new/tariff_2604.csv",
                                    "--target", target, "--year", "2026", "--month", "4",
                                    "--anomalies", f"{anomalies}_04", "--findings", findings])
    cli.run(spark, args)
    flagged = {(r.mvz, r.category) for r in spark.read.parquet(f"{anomalies}_04").collect()}
    assert flagged == {("M1", "consump_uah"), ("M1", "tariff")}
    assert spark.read.parquet(target).count() == 8
    assert spark.read.parquet(findings).where("check = 'rows'").count() == 2


def test_meter_scoring_with_group_names(spark):
    from ledgerloom.plans.contracts import CONTRACTS, METER_OUTPUT_GROUPS
    c = CONTRACTS["meter"]
    cols = ", ".join(f"`{g}` double" for g in METER_OUTPUT_GROUPS)
    hist = spark.createDataFrame(
        [(2026, m, f, *([10.0] * 5)) for m in (2, 3, 4) for f in (21, 22)],
        f"year int, month int, filid int, {cols}")
    cur = spark.createDataFrame([(2026, 5, 21, 10.0, 90.0, 10.0, 10.0, 10.0),
                                 (2026, 5, 22, 10.0, 10.0, 10.0, 10.0, 10.0)],
                                f"year int, month int, filid int, {cols}")
    run = monthly.FeedRun(c, cur, cur.limit(0))
    got = [(r.filid, r.category, r.current) for r in monthly.score(run, hist, 2026, 5).collect()]
    assert got == [(21, "Стрит-Фуд", 90.0)]


def _found(df):
    out = {}
    for r in df.collect():
        out[r.check, r.subject] = out.get((r.check, r.subject), 0) + r.n
    return out


def test_headered_drops_are_read_by_name(spark, tmpdir_path):
    """Another column order, a repeated and a missing header: no column is swapped."""
    root = f"{tmpdir_path}/hdr"
    _write(f"{root}/tariff_2605.csv", "МВЗ (Код),Место возникновения затрат,kwt,uah\nM1,a,10,120\n")
    _write(f"{root}/tariff_2606.csv", "uah,kwt,МВЗ (Код),KWT \n120,10,M1,5\n")
    _write(f"{root}/tariff_2607.csv", "МВЗ (Код),uah\nM1,7\n")
    run = monthly.tariff_drop(spark, f"{root}/tariff_*.csv")
    assert rows(run.result, "month", "consump_kwt", "consump_uah") == [
        (5, 10.0, 144.0), (6, 15.0, 144.0), (7, 0.0, 8.4)]
    dq = _found(run.dq)
    assert dq["repeated_header", "kwt"] == 2 and dq["missing_column", "kwt"] == 1
    directory = store_directory(spark.createDataFrame([(21, "2")], "id int, AccountantNumber string"),
                                name_col=None, mvz_col=None)
    _write(f"{root}/meter_2605.csv", 'Дата,Магазин,Піч піца\n2026-05-31,"002, Київ",1\n')
    _write(f"{root}/meter_2606.csv", 'Магазин,Піч піца,Дата,Пічпіца\n"002, Київ","1,5",2026-06-30,2\n')
    run = monthly.meter_drop(spark, f"{root}/meter_*.csv", directory)
    assert rows(run.result, "month", "filid", "Пиццерия") == [(5, 21, 1.0), (6, 21, 3.5)]
    _write(f"{root}/acc_2605.csv", "uah,row_no,Назва,percent,Стаття/МВЗ\n,1,Rent,,8401\n5 UAH,2,x,0.5,C1\n")
    _write(f"{root}/acc_2606.csv", "row_no,Стаття/МВЗ,Назва,uah\n1,8401,Rent,\n2,C1,x,6 UAH\n")
    stores = store_directory(spark.createDataFrame([(21, "2", "C1")], "id int, AccountantNumber string, MVZ string"),
                             name_col=None)
    run = monthly.accounts_drop(spark, f"{root}/acc_*.csv", stores, fmt="csv")
    assert rows(run.result, "month", "filid", "sum") == [(5, 21, 5.0), (6, 21, 6.0)]
    assert _found(run.dq)["missing_column", "percent"] == 1


def test_cost_cells_are_parsed_safely(spark, tmpdir_path):
    root = f"{tmpdir_path}/cells"
    _write(f"{root}/MC_2605.csv", "2026;5;202605;1;10;100;A;12,5\n2026;5;202605;1;10;100;A;1.00\n")
    run = monthly.store_costs_drop(spark, f"{root}/MC_*.csv")
    assert [float(r.costs) for r in run.result.collect()] == [1.0]
    assert _found(run.dq)["bad_number", "year,month,ym,rcid,filid,lagerid,costs"] == 1
    _write(f"{root}/RC_2605.csv", "2026;5;202605;1;7;100;12,5;0.004;\n")
    run = monthly.dc_costs_drop(spark, f"{root}/RC_*.csv")
    assert rows(run.result, "costsLogistics", "costsOther") == [(0.0, 0.004)]
    assert [n for (check, _), n in _found(run.dq).items() if check == "bad_number"] == [1]


def test_a_month_without_rows_left_is_cleared(spark, tmpdir_path):
    root, target = f"{tmpdir_path}/drop", f"{tmpdir_path}/target"
    line = "2026;{m};20260{m};1;10;100;{p};{v}\n"
    _write(f"{root}/MC_2605.csv", line.format(m=5, p="A", v="10.00"))
    _write(f"{root}/MC_2606.csv", line.format(m=6, p="A", v="20.00"))
    monthly.load(monthly.store_costs_drop(spark, f"{root}/MC_*.csv"), target)
    _write(f"{root}/MC_2606.csv", line.format(m=6, p="", v="20.00"))  # its only row is dropped now
    found = monthly.load(monthly.store_costs_drop(spark, f"{root}/MC_*.csv"), target)
    assert [(r.month, float(r.costs)) for r in spark.read.parquet(target).collect()] == [(5, 10.0)]
    assert _found(found)["null_key", "year,month,ym,rcid,filid,lagerid,proekt"] == 1
    # one month, nothing left, and then an empty file: cleared, findings returned
    _write(f"{root}/MC_2605.csv", line.format(m=5, p="", v="1.00"))
    assert monthly.load(monthly.store_costs_drop(spark, f"{root}/MC_2605.csv"), target, 2026, 5).count() == 4
    _write(f"{root}/MC_2606.csv", "")
    found = monthly.load(monthly.store_costs_drop(spark, f"{root}/MC_2606.csv"), target, 2026, 6)
    assert _found(found)["rows", "input"] == 0
    assert spark.read.parquet(target).count() == 0
