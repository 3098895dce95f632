"""Header conformance and wide-column roll-ups.

Monthly drops drift: headers change case and spacing, columns come and go,
and the same meter can appear twice under headers that only differ in
spacing. Header work is metadata (a projection list built on the driver);
the data itself is only touched by column expressions inside one projection,
so none of this shuffles.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ledgerloom.functions.scalars import named, normalize_header


def normalize_headers(df: DataFrame, strip_chars: str | None = None) -> DataFrame:
    """Rename every column to its normalised header (positional, so duplicates survive)."""
    return df.toDF(*[normalize_header(c, strip_chars) for c in df.columns])


def header_counts(columns: Sequence[str], template: Sequence[str]) -> dict[str, int]:
    """How often each template header occurs among the (normalised) columns."""
    tmpl = {normalize_header(t) for t in template}
    counts: dict[str, int] = OrderedDict()
    for c in columns:
        n = normalize_header(c)
        if n in tmpl:
            counts[n] = counts.get(n, 0) + 1
    return counts


def missing_columns(columns: Sequence[str], template: Sequence[str]) -> list[str]:
    have = {normalize_header(c) for c in columns}
    return [normalize_header(t) for t in template if normalize_header(t) not in have]


def merge_repeated_columns(df: DataFrame, strip_chars: str | None = None) -> DataFrame:
    """Columns whose headers are equal once normalised become one column.

    Numeric duplicates are summed row-wise with NULL as 0; for non-numeric
    duplicates the first non-NULL value is kept (text is never concatenated).
    Columns are addressed by position, so even identical headers are merged.
    """
    names = [normalize_header(c, strip_chars) for c in df.columns]
    pos = df.toDF(*[f"__c{i}" for i in range(len(names))])
    groups: dict[str, list[int]] = OrderedDict()
    for i, n in enumerate(names):
        groups.setdefault(n, []).append(i)
    cols = []
    for n, idx in groups.items():
        if len(idx) == 1:
            cols.append(F.col(f"__c{idx[0]}").alias(n))
            continue
        numeric = all(isinstance(df.schema.fields[i].dataType, NumericType) for i in idx)
        if numeric:
            cols.append(reduce(lambda a, b: a + b,
                               [F.coalesce(F.col(f"__c{i}"), F.lit(0)) for i in idx]).alias(n))
        else:
            cols.append(F.coalesce(*[F.col(f"__c{i}") for i in idx]).alias(n))
    return pos.select(*cols)


def project_template(df: DataFrame, template: Sequence[str]) -> DataFrame:
    """Keep the template columns that exist, in template order."""
    have = set(df.columns)
    return df.select(*[named(c) for c in template if c in have])


def rollup_columns(df: DataFrame, groups: Mapping[str, Sequence[str]],
                   keep: Sequence[str] = ()) -> DataFrame:
    """Row-wise sum of member columns per group; NULL members count as 0 and a
    group with no member present is 0.
    """
    have = set(df.columns)
    out = [F.col(k) for k in keep]
    for g, members in groups.items():
        present = [m for m in members if m in have]
        if present:
            expr = reduce(lambda a, b: a + b, [F.coalesce(named(m), F.lit(0)) for m in present])
        else:
            expr = F.lit(0)
        out.append(expr.alias(g))
    return df.select(*out)
