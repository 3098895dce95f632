"""FX4 accounts report and the chunked fill-down against a brute-force fill."""

import random

from pyspark.sql import functions as F

from ledgerloom.operators.composite import accounts_by_store
from ledgerloom.operators.enrich import store_directory
from ledgerloom.operators.filldown import fill_down
from tests.conftest import rows

REPORT = [(0, "1001", "Store A", "7", 0.9), (1, "84090200", "Bank fees", None, None),
          (2, "1001", "Store A", "1 200.50 UAH", 0.5), (3, "1002", "Store B", "300 UAH", None),
          (4, "84030500", None, None, None), (5, "1001", "Store A", "50", 0.1),
          (6, "1001", "Store A", "25", 0.2), (7, "9999", "Unknown", "10", 0.3)]
EXPECTED = [(11, 84030500, "Bank fees", 75.0, 0.1), (11, 84090200, "Bank fees", 1200.5, 0.5),
            (12, 84090200, "Bank fees", 300.0, None)]


def _directory(spark):
    raw = spark.createDataFrame([(11, "A", "1", "1001"), (12, "B", "2", "1002")],
                                "id int, name string, AccountantNumber string, MVZ string")
    return store_directory(raw)


def _accounts(spark, df, chunk=None):
    out = accounts_by_store(df, _directory(spark), "code", "name", "uah", "percent", "row_no",
                            chunk=chunk)
    return rows(out, "filid", "account", "name", "sum", "share_TO")


def test_fx4_accounts(spark):
    df = spark.createDataFrame(REPORT, "row_no long, code string, name string, uah string, percent double")
    assert _accounts(spark, df) == EXPECTED


def test_fx4_shuffled_and_chunked(spark):
    shuffled = REPORT[:]
    random.Random(3).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, "row_no long, code string, name string, uah string, "
                                         "percent double").repartition(5)
    assert _accounts(spark, df) == EXPECTED
    # bucketed chunks of two rows carry the header across chunk borders
    assert _accounts(spark, df, chunk=F.floor(F.col("row_no") / 2)) == EXPECTED


def _brute(data):
    out = []
    by_key = {}
    for k, o, hdr, v in sorted(data, key=lambda t: (t[0], t[1])):
        last = by_key.get(k)
        if hdr and v is not None:
            by_key[k] = last = v
        if not hdr:
            out.append((k, o, last))
    return sorted(out)


def test_fill_down_hot_key_matches_brute_force(spark):
    rnd = random.Random(7)
    data = []
    for i in range(3000):
        k = 0 if rnd.random() < 0.4 else rnd.randrange(1, 20)   # one key holds ~40%
        hdr = rnd.random() < 0.1
        v = (rnd.randrange(1000) if rnd.random() < 0.8 else None) if hdr else None
        data.append((k, i, hdr, v))
    df = spark.createDataFrame(data, "k int, o int, hdr boolean, v int")
    out = fill_down(df, ["o"], {"f": F.col("v")}, F.col("hdr"), partition_by=["k"], n_chunks=16)
    got = sorted(tuple(r) for r in out.select("k", "o", "f").collect())
    assert got == _brute(data)
    single = fill_down(df, ["o"], {"f": F.col("v")}, F.col("hdr"), partition_by=["k"], n_chunks=1)
    assert sorted(tuple(r) for r in single.select("k", "o", "f").collect()) == got


def test_hot_user_is_spread_over_bounded_chunks(spark):
    """40% of all events on one user: no (user, chunk) window partition gets
    much more than rows / n_chunks, and the hot user spans many chunks."""
    from ledgerloom.operators.filldown import sampled_chunk
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    skewed = ev.withColumn("user_id", F.when(F.rand(11) < 0.4, F.lit(0)).otherwise(F.col("user_id")))
    skewed = skewed.cache()
    total = skewed.count()
    n = 16
    chunk = sampled_chunk(skewed, ["user_id", "ts", "event_id"], n)
    sizes = (skewed.withColumn("c", chunk).groupBy("user_id", "c").count()
             .orderBy(F.desc("count")).collect())
    assert sizes[0]["count"] <= 2 * total / n
    hot_chunks = [r for r in sizes if r["user_id"] == 0]
    assert len(hot_chunks) >= n // 4
    skewed.unpersist()


def test_one_path_for_every_size_and_key_type(spark):
    """A small input is cut into chunks as well; a binary group key works."""
    from ledgerloom.operators.filldown import sampled_chunk
    df = spark.range(400).select(
        F.encode(F.when(F.col("id") % 2 == 0, "a").otherwise("b"), "utf-8").alias("g"), "id",
        F.when(F.col("id") % 37 == 0, F.col("id")).alias("head"))
    chunks = df.select(sampled_chunk(df, ["g", "id"]).alias("c")).distinct().count()
    assert chunks > 1
    args = (["id"], {"v": F.col("head").cast("string")}, F.col("head").isNotNull(), ["g"])
    many, one = fill_down(df, *args), fill_down(df, *args, n_chunks=1)
    assert rows(many, "g", "id", "v") == rows(one, "g", "id", "v")
