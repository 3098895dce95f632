"""The operators a feed actually calls, each composed from the building blocks.

* :func:`tariff_by_cost_centre`  kWh, VAT-inclusive cost and price per cost centre
* :func:`store_costs`            costs by DC / store / SKU / project
* :func:`dc_costs`               logistics + other costs by DC / supplier / SKU
* :func:`meter_rollup`           meter columns rolled up into kitchen groups
* :func:`accounts_by_store`      hierarchical account report -> store rows
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import guarded_ratio, named, parse_money, trim_text, valid_key
from ledgerloom.operators.aggregate import grouped_sum, sum_and_first
from ledgerloom.operators.enrich import enrich_store
from ledgerloom.operators.filldown import fill_down
from ledgerloom.operators.filters import drop_empty_tagged_rows
from ledgerloom.operators.reshape import rollup_columns

# fixed values: VAT multiplier applied to electricity cost; header code prefix of
# an article row in the account report; rental-duplicate tag in meter names
VAT = "1.2"
ARTICLE_PREFIX = "840"
RENTAL_TAG = "(Оренда)"


def tariff_by_cost_centre(df: DataFrame, key: str = "mvz", kwt: str = "kwt", uah: str = "uah",
                          keys: Sequence[str] = (), vat: str = VAT,
                          scale: int | None = 9) -> DataFrame:
    """Sum kWh and cost per trimmed, valid cost-centre code; cost x VAT; price = cost / kWh.

    Invalid codes (NULL, blank, ``-``) are removed before grouping. The price
    is 0 where consumption is 0. ``keys`` adds grouping columns (e.g. the
    period, to process every month at once).
    """
    rows = (df.where(valid_key(F.col(key)))
            .withColumn(key, trim_text(F.col(key))))
    g = grouped_sum(rows, [*keys, key], [kwt, uah], scale=scale)
    cost = F.col(uah) * F.lit(Decimal(vat))
    return g.select(
        *keys, F.col(key).alias("mvz"),
        F.col(kwt).cast("double").alias("consump_kwt"),
        cost.cast("double").alias("consump_uah"),
        guarded_ratio(cost.cast("double"), F.col(kwt).cast("double")).alias("tariff"))


# fixed values: grain of the two cost drops
STORE_COST_KEYS = ["year", "month", "ym", "rcid", "filid", "lagerid", "proekt"]
DC_COST_KEYS = ["year", "month", "ym", "rcid", "postid", "lagerid"]


def store_costs(df: DataFrame, keys: Sequence[str] = STORE_COST_KEYS,
                costs: str = "costs") -> DataFrame:
    """Exact cost sums (2 decimals) per store-cost key; rows with a NULL key are dropped."""
    return grouped_sum(df, list(keys), [costs], scale=2)


def dc_costs(df: DataFrame, keys: Sequence[str] = DC_COST_KEYS,
             logistics: str = "costsLogistics", other: str = "costsOther",
             scale: int = 9) -> DataFrame:
    """Logistics and other costs per DC key (all-NULL -> 0) and ``costs`` = their sum."""
    g = grouped_sum(df, list(keys), [logistics, other], scale=scale)
    return g.withColumn("costs", F.col(logistics) + F.col(other))


def meter_rollup(df: DataFrame, groups: Mapping[str, Sequence[str]], name_col: str,
                 store_col: str, keys: Sequence[str], numeric_cols: Sequence[str],
                 tag: str = RENTAL_TAG, scale: int = 9) -> DataFrame:
    """Meter readings -> kitchen groups per ``keys``.

    Drops rental duplicates (all meters empty and the name tagged), rolls the
    meter columns up into ``groups`` row by row (NULL as 0; a group with no
    meter present is 0), drops rows without a store and sums per ``keys``.
    """
    kept = drop_empty_tagged_rows(df, numeric_cols, name_col, tag)
    cast = kept.select(*[named(c) for c in kept.columns if c not in numeric_cols],
                       *[named(c).cast("double").alias(c) for c in numeric_cols])
    wide = rollup_columns(cast, groups, keep=list(keys))
    out = grouped_sum(wide.where(F.col(store_col).isNotNull()), list(keys), list(groups),
                      scale=scale)
    return out.select(*keys, *[F.col(g).cast("double").alias(g) for g in groups])


def filled_report(report: DataFrame, code_col: str, name_col: str, order_col: str,
                  partition_by: Sequence[str] = (), chunk: Column | None = None) -> DataFrame:
    """The store rows of a hierarchical account report with the ``account`` and ``name``
    of the article rows (code starting ``840``) above them, each filled down on its own;
    rows above the first article have a NULL account."""
    is_article = F.col(code_col).cast("string").startswith(ARTICLE_PREFIX)
    return fill_down(report, [order_col],
                     {"account": F.col(code_col).cast("string"), "name": F.col(name_col)},
                     is_header=is_article, partition_by=partition_by, chunk=chunk)


def accounts_of(filled: DataFrame, directory: DataFrame, code_col: str, uah_col: str, share_col: str,
                order_col: str, keys: Sequence[str] = (),
                watch: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Filled report rows -> (filid, account, name, sum, share_TO).

    Store rows are joined to the directory on the trimmed cost-centre text, money is
    parsed strictly, and rows are summed per (store, account, name) with the first
    non-NULL share in report order. ``watch`` sees all rows after the join, those
    without a store (``filid`` NULL) or an article (``account`` NULL) among them.
    """
    rows = (filled
            .withColumn("uah_value", parse_money(F.col(uah_col)))
            .withColumn("mvz_code", trim_text(F.col(code_col))))
    joined = enrich_store(rows, directory, F.col("mvz_code"), out_col="filid", dir_code_col="mvz",
                          how="left" if watch else "inner")
    if watch:
        joined = watch(joined).where(F.col("filid").isNotNull())
    joined = joined.withColumn("account", F.col("account").cast("bigint"))
    out = sum_and_first(joined, ["filid", "account", "name", *keys], ["uah_value"], [share_col],
                        order=F.col(order_col), scale=9)
    return out.select("filid", "account", "name", *keys,
                      F.col("uah_value").cast("double").alias("sum"),
                      F.col(share_col).cast("double").alias("share_TO"))


def accounts_by_store(report: DataFrame, directory: DataFrame, code_col: str, name_col: str,
                      uah_col: str, share_col: str, order_col: str,
                      partition_by: Sequence[str] = (), chunk: Column | None = None,
                      keys: Sequence[str] = ()) -> DataFrame:
    """Hierarchical account report -> (filid, account, name, sum, share_TO): the report's
    headers are filled down (:func:`filled_report`), then its rows are matched to stores
    and summed (:func:`accounts_of`)."""
    filled = filled_report(report, code_col, name_col, order_col, partition_by, chunk)
    return accounts_of(filled, directory, code_col, uah_col, share_col, order_col, keys)
