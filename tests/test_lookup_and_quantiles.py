"""Skew-safe store lookup and exact quantiles against plain versions."""

import random
import statistics

from pyspark.sql import functions as F

from ledgerloom.operators import aggregate, enrich
from tests.conftest import rows


def test_hot_and_missing_codes_give_the_plain_join(spark):
    rng = random.Random(1)
    data = [(i, rng.choice([None, 1, 1, rng.randrange(2, 90)])) for i in range(3000)]
    facts = spark.createDataFrame(data, "i int, c long")
    stores = spark.createDataFrame([(k, k * 10) for k in range(1, 60)] + [(5, 7), (None, 99)], "code long, id int")
    assert enrich.hot_keys(facts, "c", share=10) == [1]
    want = {None: None, **{k: k * 10 for k in range(1, 60)}, 5: 7}
    for deal in (False, True):
        left = enrich.enrich_store(facts, stores, F.col("c"), deal_hot=deal)
        assert left.columns == ["i", "c", "filid"]
        assert rows(left, "i", "filid") == sorted(((i, want.get(c)) for i, c in data),
                                                  key=lambda t: (t[0], t[1] is not None, t[1]))
        inner = enrich.enrich_store(facts, stores, F.col("c"), how="inner", deal_hot=deal)
        assert rows(inner, "i", "filid") == sorted((i, want[c]) for i, c in data if want.get(c) is not None)
    none = facts.where("c IS NULL")
    assert enrich.enrich_store(none, stores, F.col("c"), deal_hot=True).where("filid IS NULL").count() == none.count()
    twice = spark.createDataFrame([(1, 10), (1, 11)], "code long, id int")
    both = enrich.enrich_store(facts, twice, F.col("c"), unique_codes=False, how="inner", deal_hot=True)
    assert both.count() == 2 * sum(c == 1 for _, c in data)


def test_quantiles_of_skewed_groups(spark):
    rng = random.Random(2)
    data = [("hot", rng.choice([0.5, float(rng.randrange(400)), rng.gauss(0, 1e6)])) for _ in range(4000)]
    data += [("small", 3.0), (None, 1.0), (None, 2.0), ("nulls", None), ("hot", None)]
    data += [("ties", 7.0)] * 500 + [("pair", 1.0), ("pair", 2.0)]
    df = spark.createDataFrame(data, "g string, v double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    for n in (1, 7, 32):
        got = {r.g: tuple(r)[1:] for r in aggregate.exact_quantiles(
            df, ["g"], "v", probs, [f"q{i}" for i in range(5)], n_ranges=n).collect()}
        assert set(got) == {"hot", "small", None, "ties", "pair"}
        for g, q in got.items():
            own = sorted(v for k, v in data if k == g and v is not None)
            for p, x in zip(probs, q):
                pos = p * (len(own) - 1)
                low = own[int(pos)]
                high = own[min(int(pos) + 1, len(own) - 1)]
                assert abs(x - (low + (high - low) * (pos - int(pos)))) < 2e-6
        assert got["hot"][2] == round(statistics.median(v for k, v in data if k == "hot" and v is not None), 6)
    whole = aggregate.exact_quantiles(df, [], "v", [0.5], ["m"]).first()
    assert whole.m == round(statistics.median(v for _, v in data if v is not None), 6)
    summary = {r.g: r for r in aggregate.rate_summary(df, ["g"], "v").collect()}
    assert summary["nulls"].n == 0 and summary["nulls"].p50 is None and summary[None].p50 == 1.5
