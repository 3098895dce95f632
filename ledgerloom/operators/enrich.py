"""Lookup joins: store directory, role dictionary, rate cards, anti-join reports.

Dimension sides are not hinted for broadcast unless their size is bounded by
configuration: the directory, the rate card and the role dictionary all grow
with the business, so the join strategy is left to Spark, which broadcasts a
side only when its measured size (AQE runtime statistics) is under
``spark.sql.autoBroadcastJoinThreshold`` and sort-merges otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import exact_sum, parse_number, trim_text
from ledgerloom.operators.stage import written


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "left") -> DataFrame:
    """Equi-join where NULL keys match each other (the spreadsheet-merge rule)."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in keys else F.col(c)
                       for c in right.columns])
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"__r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"__r_{k}" for k in keys])


def store_directory(raw: DataFrame, id_col: str = "id", code_col: str = "AccountantNumber",
                    name_col: str | None = "name", mvz_col: str | None = "MVZ") -> DataFrame:
    """Store directory with the accountant code coerced to a nullable bigint.

    Codes that are not whole numbers become NULL (and never match, see D3).
    ``mvz`` is the trimmed cost-centre text used by the accounts feed.
    """
    cols = [F.col(id_col).cast("int").alias("id"),
            parse_number(F.col(code_col), integral=True).alias("code")]
    if name_col:
        cols.append(F.col(name_col).cast("string").alias("name"))
    if mvz_col:
        cols.append(trim_text(F.col(mvz_col)).alias("mvz"))
    return raw.select(*cols)


def enrich_store(df: DataFrame, directory: DataFrame, code: Column, out_col: str = "filid",
                 dir_code_col: str = "code", dir_id_col: str = "id",
                 null_safe: bool = False, unique_codes: bool = True,
                 how: str = "left", deal_hot: bool = False) -> DataFrame:
    """Attach the store id whose directory code equals ``code``.

    * ``null_safe=False`` (default): a missing code matches nothing; ``True``
      reproduces the spreadsheet rule where missing matches missing.
    * ``unique_codes=True``: a code listed twice in the directory resolves to
      its smallest id instead of duplicating the fact row.
    * ``how='left'`` keeps unmatched rows with a NULL id; ``'inner'`` drops them.
    * rows without a code take no part in the join (but where missing matches
      missing): they are not shuffled and meet in no task. ``deal_hot=True`` first
      counts the codes and deals those of very many rows to several tasks.
    """
    d = directory.select(F.col(dir_code_col).alias("__code"), F.col(dir_id_col).alias(out_col))
    if not null_safe:
        d = d.where(F.col("__code").isNotNull())
    if unique_codes:
        d = d.groupBy("__code").agg(F.min(out_col).alias(out_col))
    fact = df.withColumn("__code", code)
    if null_safe:
        return null_safe_join(fact, d, ["__code"], how).drop("__code")
    coded = fact.where(F.col("__code").isNotNull())
    if deal_hot:
        out = spread_lookup(coded, d, "__code", how).drop("__code")
    else:
        out = coded.join(d, "__code", how).drop("__code")
    if how == "inner":
        return out
    without = fact.where(F.col("__code").isNull()).drop("__code").withColumn(
        out_col, F.lit(None).cast(d.schema[out_col].dataType))
    return out.unionByName(without)


def hot_keys(df: DataFrame, key: str, share: int = 1000) -> list:
    """The values that over 1/``share`` of all rows have: fewer than ``share``. One pass,
    counted map-side."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col(key).isNotNull())
    big = counts.agg(F.sum("n")).first()[0] or 0
    return [r[0] for r in counts.where(F.col("n") * share > F.lit(big)).select(key).collect()] if big else []


def spread_lookup(df: DataFrame, table: DataFrame, key: str, how: str = "left", share: int = 1000,
                  salts: int = 32) -> DataFrame:
    """Join on a key of ``table`` that very many rows of ``df`` may share.

    The rows of a hot key are dealt to ``salts`` tasks by their hash and the key's rows
    of ``table`` are copied to each; all other keys are joined as usual. The result is
    that of the plain join.
    """
    hot = hot_keys(df.select(key), key, share)
    if not hot:
        return df.join(table, key, how)
    is_hot, none = F.col(key).isin(*hot), F.lit(0).cast("long")
    dealt = df.withColumn("__salt", F.when(is_hot, F.pmod(F.xxhash64(*df.columns), F.lit(salts))).otherwise(none))
    copied = table.withColumn("__salt", F.explode(F.when(
        is_hot, F.sequence(none, F.lit(salts - 1).cast("long"))).otherwise(F.array(none))))
    return dealt.join(copied, [key, "__salt"], how).drop("__salt")


def lookup(df: DataFrame, table: DataFrame, keys: Sequence[str],
           how: str = "left") -> DataFrame:
    """Plain left lookup on one or more keys (role dictionary, rate card)."""
    return df.join(table, list(keys), how)


def role_means(card: DataFrame, role_col: str, rate_col: str, scale: int = 9,
               keys: Sequence[str] = ()) -> DataFrame:
    """Mean rate per role over *all* rate-card rows of that role (exact sum / count)."""
    r = F.col(rate_col)
    return (card.where(F.col(role_col).isNotNull())
            .groupBy(*keys, role_col)
            .agg((exact_sum(r, scale).cast("double") / F.count(r)).alias("__role_mean")))


def rate_fill(hours: DataFrame, card: DataFrame, role_col: str, store_col: str,
              rate_col: str, hours_col: str, out_rate: str = "cost_hour",
              out_cost: str = "cost_labor", scale: int = 9,
              keys: Sequence[str] = (), kept: bool = False) -> DataFrame:
    """Rate per (role, store) from the card, else the role's mean rate; cost = rate * hours.

    ``keys`` (e.g. the month) belong to both tables: every month has its own card
    and means. The card is expected to hold one row per (keys, role, store). Rows
    whose role has no card at all keep a NULL rate and cost. The card is read twice, for
    the exact rates and for the means; it is written first, unless it is ``kept`` (a
    table already).
    """
    if not kept:
        card = written(card.select(*keys, role_col, store_col, rate_col), "rate-card")
    exact_rate = card.select(*keys, role_col, store_col, F.col(rate_col).cast("double").alias("__rate"))
    means = role_means(card, role_col, rate_col, scale, keys)
    out = (hours.join(exact_rate, [*keys, role_col, store_col], "left")
           .join(means, [*keys, role_col], "left"))
    rate = F.coalesce(F.col("__rate"), F.col("__role_mean"))
    return (out.withColumn(out_rate, rate)
            .withColumn(out_cost, F.col(out_rate) * F.col(hours_col).cast("double"))
            .drop("__rate", "__role_mean"))


def unmatched_rows(df: DataFrame, ref: DataFrame, keys: Sequence[str],
                   ref_keys: Sequence[str] | None = None) -> DataFrame:
    """Rows of ``df`` whose key has no match in ``ref`` (left anti join).

    The reference keys are made distinct first: the map-side part of that
    distinct shrinks what is shuffled when a key repeats (lines per order),
    and the join reuses its partitioning.
    """
    ref_keys = list(ref_keys or keys)
    r = ref.select(*[F.col(rk).alias(k) for k, rk in zip(keys, ref_keys)]).distinct()
    return df.join(r, list(keys), "left_anti")


def role_lookup(df: DataFrame, dictionary: DataFrame, role_col: str) -> DataFrame:
    """Role dictionary lookup (left): each row gets its pay role and department;
    a role the dictionary lacks keeps NULLs."""
    return lookup(df, dictionary, [role_col], "left")


def rate_lookup(df: DataFrame, card: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Composite-key rate lookup (left), e.g. on (role, store); misses keep NULLs."""
    return lookup(df, card, list(keys), "left")


def unmatched_keys(df: DataFrame, ref: DataFrame, keys: Sequence[str],
                   ref_keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct keys of ``df`` that ``ref`` lacks (keys without history, stores
    missing from the directory, orders without lines)."""
    return unmatched_rows(df.select(*keys).distinct(), ref, keys, ref_keys)
