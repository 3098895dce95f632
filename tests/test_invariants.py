"""Invariants from the test strategy: roll-up totals, fill-down under any chunking."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ledgerloom.operators.filldown import fill_down
from ledgerloom.operators.reshape import rollup_columns


def test_rollup_total_equals_sum_of_members(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    wide = li.select("l_orderkey", *[F.when(F.col("l_returnflag") == f, F.col("l_quantity")).alias(f)
                                     for f in "ANR"])
    groups = {"g1": ["A", "R"], "g2": ["N"], "g3": ["missing"]}
    out = rollup_columns(wide, groups, keep=["l_orderkey"])
    a = out.agg(F.sum("g1"), F.sum("g2"), F.sum("g3")).first()
    b = wide.agg(F.sum(F.coalesce("A", F.lit(0.0)) + F.coalesce("R", F.lit(0.0))),
                 F.sum(F.coalesce("N", F.lit(0.0)))).first()
    assert (a[0], a[1], a[2]) == (b[0], b[1], 0)


def _brute(data):
    out, last = [], {}
    for k, o, hdr, v in sorted(data, key=lambda t: (t[0], t[1])):
        if hdr and v is not None:
            last[k] = v
        if not hdr:
            out.append((k, o, last.get(k)))
    return sorted(out)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(seed=st.integers(0, 10_000), n_chunks=st.integers(1, 12), keys=st.integers(1, 4))
def test_fill_down_any_chunking(spark, seed, n_chunks, keys):
    rnd = random.Random(seed)
    data = [(rnd.randrange(keys), i, rnd.random() < 0.2,
             rnd.choice([None, rnd.randrange(100)])) for i in range(rnd.randrange(1, 200))]
    data = [(k, o, h, v if h else None) for k, o, h, v in data]
    df = spark.createDataFrame(data, "k int, o int, hdr boolean, v int")
    out = fill_down(df, ["o"], {"f": F.col("v")}, F.col("hdr"), partition_by=["k"],
                    n_chunks=n_chunks)
    assert sorted(tuple(r) for r in out.select("k", "o", "f").collect()) == _brute(data)


def test_fill_down_null_group_is_a_group(spark):
    data = [(None, 1, True, 5), (None, 2, False, None), (1, 3, False, None), (None, 4, False, None),
            (1, 5, True, 7), (1, 6, False, None)]
    df = spark.createDataFrame(data, "k int, o int, hdr boolean, v int")
    for n in (None, 3):
        out = fill_down(df, ["o"], {"f": F.col("v")}, F.col("hdr"), partition_by=["k"], n_chunks=n)
        got = sorted(tuple(r) for r in out.select("o", "f").collect())
        assert got == [(2, 5), (3, None), (4, 5), (6, 7)]


def test_merge_repeated_text_columns_keep_first_value(spark):
    from ledgerloom.operators.reshape import merge_repeated_columns
    df = spark.createDataFrame([(None, "b", 1.0, None), ("a", "z", None, 2.0)],
                               "`Name` string, `na me` string, `V 1` double, `v1` double")
    out = merge_repeated_columns(df)
    assert out.columns == ["name", "v1"]
    assert sorted(tuple(r) for r in out.collect()) == [("a", 2.0), ("b", 1.0)]
