"""Scale properties of the plans, checked on the final adaptive plans."""

import re

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
Q = entry.queries()


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    qe = df._jdf.queryExecution()
    plan = qe.executedPlan()
    try:
        return plan.finalPhysicalPlan().toString()
    except Exception:  # not adaptive
        return plan.toString()


def test_all_period_scoring_reads_and_shuffles_facts_once(spark):
    plan = final_plan(Q["anomaly_all_periods"](spark, SF))
    assert "ReusedExchange" in plan
    assert len(re.findall(r"FileScan parquet", plan)) == 1


def test_tariff_sums_lines_per_part_before_the_join(spark):
    plan = final_plan(Q["tariff_by_cost_centre"](spark, SF)).splitlines()
    join = next(i for i, line in enumerate(plan) if "Join" in line)
    below = "\n".join(plan[join:])
    assert "HashAggregate(keys=[l_partkey" in below


class Steps:
    """The frames that operators write on their way, and their final plans."""

    def __init__(self, monkeypatch, *modules):
        self.frames, self.plans = {}, {}
        for m in modules:
            monkeypatch.setattr(m, "written", self.keep)

    def keep(self, df, name):
        from ledgerloom.operators.stage import written
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        self.frames[name], self.plans[name] = df, (plan, final_plan(df))
        return written(df, name)


def test_fill_down_shuffles_its_rows_once(spark, monkeypatch):
    """One range shuffle of the rows, then a join with two rows per range; no literals."""
    from ledgerloom.operators import filldown
    steps = Steps(monkeypatch, filldown)
    out = Q["fill_down"](spark, SF)
    rows = steps.plans["filled-ranges"][1]
    exchanges = re.findall(r"Exchange (\w+)", rows.split("Initial Plan")[0])
    assert exchanges and set(exchanges) == {"rangepartitioning"} and len(exchanges) == 1
    plan = final_plan(out).split("Initial Plan")[0]
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # what is left of the plan moves the small rows only: the rows themselves are scanned once
    # for the result, and once, by their kind, for the carry
    assert len(re.findall(r"FileScan parquet", plan)) == 2
    assert len(plan) < 20_000


def test_fill_down_plan_does_not_grow_with_the_rows(spark):
    from pyspark.sql import functions as F

    from ledgerloom.operators.filldown import fill_down

    def plan_size(n):
        df = spark.range(n).select("id", (F.col("id") % 7).alias("g"), (F.col("id") % 5 == 0).alias("h"))
        out = fill_down(df, ["id"], {"v": F.col("id").cast("string")}, F.col("h"), partition_by=["g"])
        return len(out._jdf.queryExecution().optimizedPlan().toString())

    assert abs(plan_size(2000) - plan_size(20_000)) < 40


def test_sales_share_reads_the_sales_once(spark, monkeypatch):
    from ledgerloom.operators import allocate
    for name in ("dense_sales_share", "dense_sales_share_year"):
        steps = Steps(monkeypatch, allocate)
        out = Q[name](spark, SF)
        assert len(re.findall(r"FileScan parquet", steps.plans["sales-cells"][1].split("Initial Plan")[0])) == 1
        assert "lineitem" not in final_plan(out) and "Window" not in final_plan(out)


def test_labour_reads_each_table_once_per_use(spark, monkeypatch):
    """Hours and card read lines and parts once each, the share reads the lines once."""
    from ledgerloom.operators import allocate, enrich

    def table_scans(plan):
        return len(re.findall(r"FileScan parquet[^\n]*testdata", plan.split("Initial Plan")[0]))

    for name, most in (("rate_fill", 4), ("labor_allocation", 5)):
        steps = Steps(monkeypatch, allocate, enrich)
        out = Q[name](spark, SF)
        assert sum(table_scans(p) for _, p in steps.plans.values()) + table_scans(final_plan(out)) <= most, name


def test_quartiles_hold_no_group(spark, monkeypatch):
    from ledgerloom.operators import aggregate
    steps = Steps(monkeypatch, aggregate)
    plan = final_plan(Q["price_quartiles"](spark, SF)) + steps.plans["value-counts"][1]
    assert "percentile" not in plan and "collect" not in plan


def test_rows_without_a_code_meet_no_exchange(spark):
    """Keeping the rows without a code adds a scan to the plan of the inner join, but no exchange."""
    from pyspark.sql import functions as F

    from ledgerloom.operators.enrich import enrich_store
    facts = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey", "l_suppkey")
    stores = spark.read.parquet(f"{SF}/supplier.parquet").select(F.col("s_suppkey").alias("code"), F.col("s_suppkey").alias("id"))
    code = F.when(F.col("l_orderkey") % 3 != 0, F.col("l_suppkey"))
    plans = {how: enrich_store(facts, stores, code, how=how)._jdf.queryExecution().executedPlan().toString()
             for how in ("inner", "left")}
    assert "Union" in plans["left"] and plans["left"].count("Exchange") == plans["inner"].count("Exchange")
    assert plans["left"].count("FileScan") == plans["inner"].count("FileScan") + 1


def test_numbers_are_matched_once_each(spark):
    plan = Q["meter_rollup"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 0 and plan.count("RLIKE") <= 6


def test_anti_join_dedupes_reference_keys(spark):
    plan = final_plan(Q["unmatched_keys"](spark, SF))
    assert re.search(r"HashAggregate\(keys=\[o_orderkey", plan)


def test_one_period_scoring_reads_history_once(spark):
    plan = final_plan(Q["anomaly_one_period"](spark, SF))
    # one scan for the scored month, one for its three previous months
    assert len(re.findall(r"FileScan parquet", plan)) == 2
    assert "ReusedExchange" in plan


def test_a_hot_supplier_meets_the_join_as_sums(spark):
    """Without broadcasts the lines are summed below the join, not shuffled to it."""
    from ledgerloom.plans.bindings import QUERIES
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for name in ("store_costs", "dc_costs"):
            plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
            assert "partial_sum" in plan and plan.index("SortMergeJoin") < plan.index("HashAggregate"), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
