"""Column expressions shared by all feeds.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside whole-stage codegen; nothing runs row by row in Python. The few
helpers that take plain ``str`` work on column *names* (metadata) only.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# header names (driver-side metadata, never data)
# ---------------------------------------------------------------------------


def normalize_header(name: str, strip_chars: str | None = None) -> str:
    """Lower-case a header and remove every whitespace character (incl. NBSP).

    ``strip_chars`` are first stripped from both ends, e.g. ``" '"`` for the
    tariff sheet whose first header carries a stray apostrophe.
    """
    if strip_chars:
        name = name.strip(strip_chars)
    return "".join(name.lower().split())


def named(name: str) -> Column:
    """The column of exactly this name (a header may hold a dot)."""
    return F.col("`" + name.replace("`", "``") + "`")


# ---------------------------------------------------------------------------
# text
# ---------------------------------------------------------------------------


def squash_text(col: Column) -> Column:
    """Data-side twin of :func:`normalize_header`: lower case, no whitespace.

    ``(?U)`` makes ``\\s`` Unicode-aware so NBSP and friends are removed too.
    """
    return F.regexp_replace(F.lower(col), r"(?U)\s+", "")


def strip_chars(col: Column, chars: str) -> Column:
    """Text without any of ``chars`` at its ends (data-side twin of the strip set)."""
    return F.btrim(col.cast("string"), F.lit(chars))


def blank_to_null(col: Column) -> Column:
    """A string made only of whitespace (or empty) becomes NULL."""
    return F.when(trim_text(col) != "", col)


def contains_tag(col: Column, tag: str) -> Column:
    """Literal substring test where NULL text counts as *not* containing."""
    return F.coalesce(F.instr(col, tag) > 0, F.lit(False))


# fixed values: the signs that Unicode counts as white space
_SPACES = ("\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009"
           "\u200a\u2028\u2029\u202f\u205f\u3000")


def trim_text(col: Column) -> Column:
    """Text without white space at its ends; NBSP and other Unicode spaces count."""
    return F.btrim(col.cast("string"), F.lit(_SPACES))


def valid_key(col: Column, bad_values: tuple[str, ...] = ("", "-")) -> Column:
    """Key validity: not NULL, and not blank / a placeholder after trimming."""
    trimmed = trim_text(col)
    return col.isNotNull() & ~trimmed.isin(*bad_values)


def code_before_comma(col: Column) -> Column:
    """Text before the first comma with spaces removed: ``'002, Kyiv'`` -> ``'002'``."""
    return F.replace(F.substring_index(col, ",", 1), F.lit(" "), F.lit(""))


# ---------------------------------------------------------------------------
# numbers
# ---------------------------------------------------------------------------

# fixed values: the only texts a coercing numeric parse accepts
_NUMBER_RE = r"^[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i)inf(inity)?)$"


def parse_number(col: Column, integral: bool = False, decimal_comma: bool = False) -> Column:
    """Coercing numeric parse: anything that is not a plain number becomes NULL.

    Accepts surrounding whitespace, signs, exponents and ``inf``; rejects
    blanks, ``'12d'``, ``'0x10'`` and ``'12,5'`` (unless ``decimal_comma``).
    ``NaN`` is never produced: missing stays NULL. With ``integral=True`` the
    result is a bigint and a non-integral value becomes NULL (see
    :func:`non_integral` to count those).
    """
    text = trim_text(col)
    if decimal_comma:
        text = F.replace(text, F.lit(","), F.lit("."))
    return _once(text, lambda t: _parsed(t, integral))


def _parsed(text: Column, integral: bool) -> Column:
    value = F.when(text.rlike(_NUMBER_RE), text.try_cast("double"))
    return whole_number(value) if integral else value


def whole_number(value: Column) -> Column:
    """A double as a bigint; NULL if it is not whole or does not fit."""
    return _once(value, lambda v: F.when(v == F.floor(v), v.try_cast("bigint")))


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is looked at."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def non_integral(col: Column, decimal_comma: bool = False) -> Column:
    """True where a value parses as a number but not as a whole one."""
    return F.coalesce(_once(parse_number(col, decimal_comma=decimal_comma), lambda v: v != F.floor(v)), F.lit(False))


def parse_money(col: Column, currency: str = "UAH") -> Column:
    """Strict money parse: drop the currency tag and spaces, blank -> NULL.

    Anything else that is not a number raises (ANSI cast), like the report it
    mirrors; a NULL cell stays NULL.
    """
    text = F.replace(F.replace(col.cast("string"), F.lit(currency), F.lit("")),
                     F.lit(" "), F.lit(""))
    return F.nullif(text, F.lit("")).cast("double")


def nan_to_null(col: Column) -> Column:
    """NaN compares as larger than everything in Spark; make it missing instead."""
    return F.when(~F.isnan(col), col)


def guarded_ratio(num: Column, den: Column, null_denominator: str = "zero") -> Column:
    """``num / den`` with a zero denominator giving 0 (no ANSI error).

    ``null_denominator='zero'`` also maps a NULL denominator to 0 (the tariff
    rule); ``'null'`` keeps it NULL (the labour split rule).
    """
    if null_denominator == "zero":
        return F.when(den != 0, num / den).otherwise(F.lit(0.0))
    return F.when(den == 0, F.lit(0.0)).otherwise(num / den)


def exact_sum(col: Column, scale: int = 9) -> Column:
    """Aggregate: order-independent sum, as ``decimal(38, scale)``.

    Only the group's result is rounded (half-even) to ``scale`` decimals. Each
    value is split into whole units and billionths, both summed as 64-bit
    integers, which stays on Spark's fast long-sum path; a value's digits beyond
    the ninth decimal are the only ones not kept. A group total beyond 9.2e18
    raises (ANSI overflow) rather than wrapping; the billionths alone hold
    1.8e10 rows a group.
    """
    value = col.cast("double")
    whole = F.rint(value)
    rest = F.rint((value - whole) * F.lit(1e9))
    total = (F.sum(whole.cast("long")).cast("decimal(28,9)")
             + F.sum(rest.cast("long")).cast("decimal(19,0)") * F.lit(Decimal("0.000000001")))
    return F.bround(total, scale).cast(f"decimal(38,{scale})")


# ---------------------------------------------------------------------------
# periods and calendar
# ---------------------------------------------------------------------------


def month_index(year: Column | str, month: Column | str) -> Column:
    """``year * 12 + month``: consecutive months are consecutive integers."""
    y = F.col(year) if isinstance(year, str) else year
    m = F.col(month) if isinstance(month, str) else month
    return y * 12 + m


def month_index_of(year: int, month: int) -> int:
    return year * 12 + month


def previous_periods(year: int, month: int, n: int = 3) -> list[tuple[int, int]]:
    """The ``n`` calendar months before ``(year, month)``, newest first."""
    out = []
    idx = month_index_of(year, month)
    for k in range(1, n + 1):
        j = idx - k - 1
        out.append((j // 12, j % 12 + 1))
    return out


def period_bounds(year: int, month: int) -> tuple[str, str]:
    """``[first day, first day of next month)`` as ISO strings (pushes down)."""
    ny, nm = (year + 1, 1) if month == 12 else (year, month + 1)
    return f"{year:04d}-{month:02d}-01", f"{ny:04d}-{nm:02d}-01"


def in_period(ts: Column, year: int, month: int) -> Column:
    """Half-open range test on a date/timestamp column; Parquet can push it down."""
    lo, hi = period_bounds(year, month)
    return (ts >= F.lit(lo).cast("timestamp_ntz")) & (ts < F.lit(hi).cast("timestamp_ntz"))


# fixed values: a monthly drop is named <feed>_<yymm>.<ext>; yymm is the first
# run of exactly four digits in the *file name*, year = 2000 + yy
_PERIOD_RE = r"(?<![0-9])([0-9]{4})(?![0-9])"


def drop_name(path: Column) -> Column:
    """Name of the drop a file belongs to: the file name, or the folder name for
    the ``part-*`` files of a dataset folder written by Spark or Hadoop."""
    leaf = F.regexp_extract(path, r"([^/\\]*)$", 1)
    folder = F.regexp_extract(path, r"([^/\\]*)[/\\][^/\\]*$", 1)
    return F.when(leaf.startswith("part-") & (folder != ""), folder).otherwise(leaf)


def period_from_name(path: Column, strict: bool = True) -> Column:
    """``struct(year, month)`` read from a file name such as ``meter_2605.xlsx``.

    Only the drop's own name is searched, so a dated folder does not win:
    the file name, or - for the ``part-*`` files of a dataset folder written
    by Spark or Hadoop - the name of that folder. A name without a four-digit
    run, or with a month outside 1..12, raises when ``strict`` (default) and
    gives NULLs otherwise.
    """
    base = drop_name(path)
    yymm = F.regexp_extract(base, _PERIOD_RE, 1)
    year = (F.lit(2000) + F.substring(yymm, 1, 2).try_cast("int")).cast("int")
    month = F.substring(yymm, 3, 2).try_cast("int")
    good = (yymm != "") & month.between(1, 12)
    if strict:
        bad = F.raise_error(F.concat(F.lit("no yymm period in file name: "), base))
        year = F.when(good, year).otherwise(bad.cast("int"))
        month = F.when(good, month).otherwise(bad.cast("int"))
    else:
        year = F.when(good, year)
        month = F.when(good, month)
    return F.struct(year.alias("year"), month.alias("month"))


# fixed values: date layouts accepted in landed drops (ISO first, then day-first)
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "dd.MM.yyyy HH:mm:ss", "dd.MM.yyyy HH:mm",
                "dd.MM.yyyy", "dd/MM/yyyy")


def parse_date(col: Column, formats: tuple[str, ...] = DATE_FORMATS) -> Column:
    """First layout that parses; text matching none becomes NULL (never an error)."""
    text = trim_text(col)
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in formats])


def calendar_columns(d: Column) -> dict[str, Column]:
    """Clock fields of a date: month bounds, ISO weekday, weekday name, yyyymm.

    Dates come back as ``yyyy-MM-dd`` strings, the form the reports use.
    """
    day = d.cast("date")
    return {
        "first_day": F.date_format(F.trunc(day, "month"), "yyyy-MM-dd"),
        "last_day": F.date_format(F.last_day(day), "yyyy-MM-dd"),
        "weekday_num": (F.weekday(day) + 1).cast("int"),
        "weekday_name": F.date_format(day, "EEEE"),
        "ym": F.date_format(day, "yyyyMM"),
    }
