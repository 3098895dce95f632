"""Row filters: the file's period, key validity, empty rental duplicates."""

from __future__ import annotations

from collections.abc import Collection, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ledgerloom.functions.scalars import contains_tag, in_period, named, nan_to_null, parse_number, valid_key


def filter_period(df: DataFrame, ts_col: str, year: int, month: int) -> DataFrame:
    """Rows whose date falls in ``(year, month)`` (a range, so it pushes down)."""
    return df.where(in_period(F.col(ts_col), year, month))


def filter_valid_key(df: DataFrame, *key_cols: str) -> DataFrame:
    """Rows whose keys are all set, not blank and not ``-``."""
    return df.where(reduce(lambda a, b: a & b, [valid_key(F.col(k)) for k in key_cols]))


def all_zero(cols: Sequence[str | Column], numbers: Collection[str] = ()) -> Column:
    """Every listed value is 0, blank or not a number. Columns in ``numbers`` hold
    numbers already and are not parsed from text."""
    parts = []
    for c in cols:
        col = named(c) if isinstance(c, str) else c
        value = nan_to_null(col.cast("double")) if isinstance(c, str) and c in numbers \
            else parse_number(col.cast("string"))
        parts.append(F.coalesce(value, F.lit(0.0)) == 0)
    return reduce(lambda a, b: a & b, parts)


def drop_empty_tagged_rows(df: DataFrame, numeric_cols: Sequence[str], name_col: str,
                           tag: str) -> DataFrame:
    """Drop rows whose numeric columns are all empty **and** whose name carries ``tag``."""
    numbers = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)}
    # the tag is looked for first: few rows carry it
    return df.where(~(contains_tag(F.col(name_col), tag) & all_zero(numeric_cols, numbers)))
