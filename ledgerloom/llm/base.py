"""Shared helpers of the corpus operators: input, scratch tables, shipping code.

Scratch tables are Parquet written under ``spark.checkpoint.dir`` (read from
the session, never replaced), so a lost executor never loses a finished step.
"""

from __future__ import annotations

import functools
import gc
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import checkpoint_dir

_PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, opened by Spark's own reader (any path Spark can read)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: What a batch on its way to Python holds at most: texts and index shards are large
#: rows, and a worker keeps the memory of its largest batch. Spark's own settings win
#: where the application sets them.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
         "spark.sql.execution.arrow.maxBytesPerBatch": "8388608"}


def ship(spark: SparkSession) -> None:
    """Make the session ready for the operators' Python tasks: small batches, and
    this package's source sent to the executors, once per application."""
    sc = spark.sparkContext
    given = sc.getConf()
    for key, value in BATCH.items():
        if not given.contains(key):
            spark.conf.set(key, value)
    if getattr(sc, "_ledgerloom_shipped", False):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="ledgerloom-src-"), "ledgerloom_src.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(_PACKAGE):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(_PACKAGE)))
    sc.addPyFile(path)
    sc._ledgerloom_shipped = True


def lean(task):
    """A function of batches that gives memory back at its end: workers live on between
    tasks, and allocators keep what a task has freed."""
    @functools.wraps(task)
    def run(batches):
        import ctypes

        import pyarrow as pa

        try:
            yield from task(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
            if trim is not None:
                trim(0)

    return run


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; nothing is written yet."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def unused(df: DataFrame, *names: str) -> list[str]:
    """Column names like these that ``df`` does not have (case aside), for helpers
    that must not replace a caller's column."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


# -- joins on keys that very many rows share ---------------------------------

def spread_join(left: DataFrame, right: DataFrame, keys: list[str], weight: str,
                share: int = 1000, salts: int = 64) -> DataFrame:
    """Inner join on keys that are unique in ``right``, a written table whose
    ``weight`` says how many rows of ``left`` have the key.

    A key with over 1/``share`` of all rows (there are fewer than ``share`` such
    keys) is dealt to ``salts`` tasks: its row of ``right`` is copied to each, its
    rows of ``left`` go to one by their hash. The result is that of the plain join.
    """
    total = right.agg(F.sum(weight)).first()[0] or 0
    hot = [r[0] for r in right.where(F.col(weight) * share > total).select(F.xxhash64(*keys)).collect()]
    small = right.drop(weight)
    if not hot:
        return left.join(small, keys)
    is_hot = F.xxhash64(*keys).isin(*hot)
    dealt = left.withColumn("__salt", F.when(is_hot, F.pmod(F.xxhash64(*left.columns), F.lit(salts)))
                            .otherwise(F.lit(0).cast("long")))
    copied = small.withColumn("__salt", F.explode(F.when(
        is_hot, F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))
        .otherwise(F.array(F.lit(0).cast("long")))))
    return dealt.join(copied, [*keys, "__salt"]).drop("__salt")


# -- ranges of an ordered integer key ---------------------------------------

def range_edges(df: DataFrame, key: str, pieces: int) -> list[int]:
    """At most ``pieces`` ascending key values; range k starts at edge k.

    One pass over the key column alone. Edges are values of the data and the
    first is the least key, so no range is empty. Nulls are left out; an empty
    or all-null column gives [].
    """
    probs = [i / pieces for i in range(pieces)]
    got = df.agg(F.min(key), F.percentile_approx(key, F.array(*map(F.lit, probs)),
                                                 F.lit(max(10_000, 10 * pieces)))).first()
    if got[0] is None:
        return []
    return sorted({got[0], *got[1]})


def range_of(key: Column, edges: list[int]) -> Column:
    """The number of the range that holds ``key`` (null: 0), by binary search."""
    if len(edges) < 2:
        return F.lit(0)
    steps = [1 << i for i in reversed(range((len(edges) - 1).bit_length()))]
    table = F.array(*(F.lit(e) for e in edges))
    last = len(edges) - 1

    def step(at, jump):
        to = F.least(at + jump, F.lit(last))
        return F.when(F.get(table, to) <= key, to).otherwise(at)

    return F.coalesce(F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), step), F.lit(0))
