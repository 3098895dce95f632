"""Data-quality findings as one long table.

Columns: ``feed, year, month, check, subject, n, detail``. Two ways to fill it:

* :class:`ObservedChecks` - counts observed during the job that loads the
  result (no extra pass over the data); what the feeds use when loading;
* the standalone findings below - each a global count (a partial count per
  task, then one tiny merge), unioned by name - for checking a frame on its own.

Header findings come from column names (metadata), not from the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.reshape import header_counts, missing_columns

DQ_SCHEMA = ("feed string, year int, month int, check string, subject string, "
             "n bigint, detail string")


def _row(df: DataFrame, feed: str, year, month, check: str, subject: str,
         n, detail=None, by: Sequence[str] | None = None) -> DataFrame:
    if by:
        y, m = (F.col(by[0]).cast("int"), F.col(by[1]).cast("int"))
    else:
        y, m = (F.lit(year).cast("int"), F.lit(month).cast("int"))
    return df.select(
        F.lit(feed).alias("feed"), y.alias("year"), m.alias("month"),
        F.lit(check).alias("check"), F.lit(subject).alias("subject"),
        n.cast("bigint").alias("n"), F.lit(detail).cast("string").alias("detail"))


def _grouped(df: DataFrame, by: Sequence[str] | None):
    return df.groupBy(*by) if by else df


def null_key_count(df: DataFrame, keys: Sequence[str], feed: str, year=None, month=None,
                   by: Sequence[str] | None = None) -> DataFrame:
    """Rows dropped by grouping because a key is NULL (per period with ``by``)."""
    cond = None
    for k in keys:
        c = F.col(k).isNull()
        cond = c if cond is None else cond | c
    agg = _grouped(df, by).agg(F.count(F.when(cond, F.lit(1))).alias("__n"))
    return _row(agg, feed, year, month, "null_key", ",".join(keys), F.col("__n"), by=by)


def unmatched_count(df: DataFrame, ref: DataFrame, keys: Sequence[str], feed: str,
                    ref_keys: Sequence[str] | None = None, year=None, month=None,
                    by: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` with no partner in ``ref`` (per period of ``df`` with ``by``).

    A left join to the distinct reference keys (no fan-out) keeps periods
    where nothing is unmatched, so they report 0.
    """
    ref_keys = list(ref_keys or keys)
    r = (ref.select(*[F.col(rk).alias(k) for k, rk in zip(keys, ref_keys)]).distinct()
         .withColumn("__hit", F.lit(True)))
    joined = df.join(r, list(keys), "left")
    agg = _grouped(joined, by).agg(F.count(F.when(F.col("__hit").isNull(), F.lit(1))).alias("__n"))
    return _row(agg, feed, year, month, "unmatched", ",".join(keys), F.col("__n"), by=by)


def duplicate_count(df: DataFrame, keys: Sequence[str], feed: str, year=None, month=None,
                    by: Sequence[str] | None = None) -> DataFrame:
    """Number of keys that occur more than once (must be 0); per period with ``by``."""
    per_key = df.groupBy(*keys, *(by or [])).agg(F.count(F.lit(1)).alias("__c"))
    agg = _grouped(per_key, by).agg(F.count(F.when(F.col("__c") > 1, F.lit(1))).alias("__n"))
    return _row(agg, feed, year, month, "duplicate_key", ",".join(keys), F.col("__n"), by=by)


def header_findings(spark: SparkSession, columns: Sequence[str], template: Sequence[str],
                    feed: str, year=None, month=None) -> DataFrame:
    """Repeated template headers and missing template headers of one drop."""
    rows = []
    for name, n in header_counts(columns, template).items():
        if n > 1:
            rows.append((feed, year, month, "repeated_header", name, n, None))
    for name in missing_columns(columns, template):
        rows.append((feed, year, month, "missing_column", name, 1, None))
    return spark.createDataFrame(rows, DQ_SCHEMA)


def count_finding(df: DataFrame, cond, check: str, subject: str, feed: str,
                  year=None, month=None, detail: str | None = None,
                  by: Sequence[str] | None = None) -> DataFrame:
    """Generic finding: number of rows where ``cond`` holds (per period with ``by``)."""
    agg = _grouped(df, by).agg(F.count(F.when(cond, F.lit(1))).alias("__n"))
    return _row(agg, feed, year, month, check, subject, F.col("__n"), detail, by=by)


def dq_report(parts: Sequence[DataFrame]) -> DataFrame:
    """Union the findings into the report table."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def observed(observation: Observation) -> dict:
    """The metrics of a finished action; none if its plan had no rows to observe
    (an empty drop is optimised away together with its metrics)."""
    try:
        return dict(observation.get)
    except (AssertionError, PySparkException, Py4JError):
        return {}


class ObservedChecks:
    """Row-count findings gathered *while* the load job runs (``DataFrame.observe``).

    Counting through separate aggregations would read the drop again once per
    finding; observed metrics ride along the one job that writes the result,
    each task adding its partial counts. Attach once with :meth:`watch`, read
    after the action with :meth:`report`.
    """

    def __init__(self, feed: str):
        self.feed = feed
        self.watched: list[tuple[Observation, list[tuple[str, str, str]]]] = []

    def watch(self, df: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
        """``checks``: (check, subject, condition) - rows where the condition holds are
        counted. May be called at several places of a plan that each see a row once (not
        above a range partitioning, which reads its input twice)."""
        observation = Observation(f"dq_{self.feed}_{uuid.uuid4().hex[:12]}")
        specs = [(f"m{i}", check, subject) for i, (check, subject, _) in enumerate(checks)]
        self.watched.append((observation, specs))
        return df.observe(observation, F.count(F.lit(1)).alias("rows"), *[
            F.count(F.when(cond, F.lit(1))).alias(name) for (name, _, _), (_, _, cond) in zip(specs, checks)])

    def report(self, spark: SparkSession, year=None, month=None) -> DataFrame:
        """The findings of the finished action, as rows of the report table; the rows
        read are those of the first place watched."""
        rows = []
        for i, (observation, specs) in enumerate(self.watched):
            got = observed(observation)
            if not i:
                rows.append((self.feed, year, month, "rows", "input", got.get("rows") or 0, None))
            rows += [(self.feed, year, month, check, subject, got.get(name) or 0, None)
                     for name, check, subject in specs]
        return spark.createDataFrame(rows, DQ_SCHEMA)
