"""The six monthly feeds, end to end, over landed files.

Every feed follows one spine:

    scan -> period from the file name -> conform headers -> clean -> enrich by
    lookup joins -> aggregate -> (score against the previous three months) ->
    report findings -> replace the periods in the target

A feed takes a path or a glob, so one call handles one month or the whole
history; the period of every row comes from its own file name. Each builder
returns a :class:`FeedRun` of lazy DataFrames; :func:`load` writes the result
(one month: that partition is replaced; many months: dynamic overwrite) and
:func:`score` / :func:`score_history` produce the anomaly tables.

Headered drops are CSV, Parquet or workbooks (``fmt="xlsx"``: the first sheet).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import (
    code_before_comma,
    non_integral,
    normalize_header,
    parse_date,
    parse_number,
    period_from_name,
    trim_text,
    valid_key,
)
from ledgerloom.operators import composite, quality
from ledgerloom.operators.aggregate import control_totals, grouped_sum
from ledgerloom.operators.allocate import dense_sales_share_periods, labor_allocation
from ledgerloom.operators.anomaly import anomaly_all_periods, anomaly_one_period, keys_without_history
from ledgerloom.operators.enrich import enrich_store, rate_fill, store_directory
from ledgerloom.operators.periods import PeriodTable
from ledgerloom.operators.sink import conform_schema, write_period, write_periods
from ledgerloom.plans.contracts import (
    ACCOUNTS_TEMPLATE,
    CONTRACTS,
    LABOR_TEMPLATE,
    METER_DATE,
    METER_GROUPS,
    METER_OUTPUT_GROUPS,
    METER_STORE,
    METER_TEMPLATE,
    SHARED_DEPT,
    SHARED_ROLE,
    SHARED_SPLIT,
    TARIFF_TEMPLATE,
    FeedContract,
    normalized_groups,
)
from ledgerloom.operators.stage import written
from ledgerloom.sources.scans import (
    DC_COSTS_SCHEMA,
    REJECT_COLUMNS,
    STORE_COSTS_SCHEMA,
    scan_monthly_csv,
    scan_by_header,
    scan_monthly_table,
    scan_with_rejects,
)
from ledgerloom.sources.workbooks import scan_workbooks


@dataclass
class FeedRun:
    """A feed's lazy outputs.

    ``result`` is what gets loaded. ``checks`` are row counts observed while
    the load job runs (returned by :func:`load`, no extra pass); ``headers``
    are findings about the drop's header rows (metadata); ``dq`` recomputes
    every finding on its own, for inspecting a drop without loading it;
    ``periods`` are the months of the drop's files, whatever rows they hold;
    ``rejected`` are the lines that a drop read with ``quarantine=True`` sets aside.
    """
    contract: FeedContract
    result: DataFrame
    dq: DataFrame
    checks: quality.ObservedChecks | None = None
    headers: DataFrame | None = None
    periods: Sequence[tuple[int, int]] = ()
    rejected: DataFrame | None = None


def _period_cols(df: DataFrame, year_col: str = "year", month_col: str = "month") -> DataFrame:
    return (df.withColumnRenamed("file_year", year_col).withColumnRenamed("file_month", month_col))


def _same_period() -> Column:
    same = (F.col("year") == F.col("file_year")) & (F.col("month") == F.col("file_month"))
    return F.coalesce(same, F.lit(False))


def _any_null(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _own_period_mismatch(df: DataFrame, feed: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose own year/month differ from their file's are set aside and counted."""
    ok = df.where(_same_period())
    finding = quality.count_finding(df, ~_same_period(), "period_mismatch", "year,month", feed)
    return ok, finding


def _bad_number(cells: Sequence[str]) -> Column:
    """A cell that holds text but no number."""
    return reduce(lambda a, b: a | b, [
        F.coalesce((trim_text(F.col(f"__raw_{c}")) != "") & F.col(c).isNull(), F.lit(False)) for c in cells])


def _cost_drop(spark: SparkSession, c: FeedContract, path, schema: str, keys: list[str],
               amounts: list[str], build, quarantine: bool = False) -> FeedRun:
    """A headerless cost drop: cells come as text; what is no number becomes NULL
    and is counted, so ``12,5`` is neither 125 nor a silent 0. With ``quarantine``
    such lines, and lines with too many or too few fields, are rejected as they stand:
    the drop is parsed once into a written table, of which one part is loaded and the
    other goes to the quarantine."""
    whole = [k for k in keys if k != "proekt"]
    rejected = None
    if quarantine:
        names = [f.split()[0] for f in schema.split(", ")]
        lines = scan_with_rejects(spark, path, names, least=max(names.index(n) for n in (*keys, *amounts)) + 1,
                                  numeric=[*whole, *amounts])
        every = written(lines, f"{c.name}-lines")
        text = every.where(F.col("reason").isNull()).drop("reason", "line")
        rejected = every.where(F.col("reason").isNotNull()).select(*REJECT_COLUMNS)
        months = drop_periods(spark, lines)
    else:
        text = scan_monthly_csv(spark, path, schema)
        months = drop_periods(spark, text)
    raw = text.select(
        *[F.col(k).alias(f"__raw_{k}") for k in (*whole, *amounts)],
        *[parse_number(F.col(k), integral=True).cast("int").alias(k) for k in whole],
        *[parse_number(F.col(a)).alias(a) for a in amounts],
        *([F.col("proekt")] if "proekt" in keys else []), "file_year", "file_month")
    bad = _bad_number([*whole, *amounts])
    checks = quality.ObservedChecks(c.name)
    watched = checks.watch(raw, [("period_mismatch", "year,month", ~_same_period()),
                                 ("null_key", ",".join(keys), _same_period() & _any_null(keys)),
                                 ("bad_number", ",".join([*whole, *amounts]), bad)])
    result = build(watched.where(_same_period()), keys)
    ok, mismatch = _own_period_mismatch(raw, c.name)
    dq = quality.dq_report([
        mismatch,
        quality.null_key_count(ok, keys, c.name),
        quality.count_finding(raw, bad, "bad_number", ",".join([*whole, *amounts]), c.name),
        quality.duplicate_count(build(ok, keys), keys, c.name),
    ])
    if rejected is not None:
        dq = quality.dq_report([dq, rejected_counts(rejected, c.name)])
    return FeedRun(c, conform_schema(result, c.target_schema), dq, checks, periods=months, rejected=rejected)


def rejected_counts(rejected: DataFrame, feed: str) -> DataFrame:
    """Findings: how many lines of each file were rejected, by reason."""
    return (rejected.groupBy("file_name", "file_year", "file_month", "reason").agg(F.count(F.lit(1)).alias("n"))
            .select(F.lit(feed).alias("feed"), F.col("file_year").alias("year"), F.col("file_month").alias("month"),
                    F.lit("rejected").alias("check"), F.col("file_name").alias("subject"), "n",
                    F.col("reason").alias("detail")))


# ---------------------------------------------------------------------------
# costs (two headerless CSV drops)
# ---------------------------------------------------------------------------


def store_costs_drop(spark: SparkSession, path: str | Sequence[str], quarantine: bool = False) -> FeedRun:
    return _cost_drop(spark, CONTRACTS["store_costs"], path, STORE_COSTS_SCHEMA,
                      ["year", "month", "ym", "rcid", "filid", "lagerid", "proekt"], ["costs"],
                      composite.store_costs, quarantine)


def dc_costs_drop(spark: SparkSession, path: str | Sequence[str], quarantine: bool = False) -> FeedRun:
    return _cost_drop(spark, CONTRACTS["dc_costs"], path, DC_COSTS_SCHEMA,
                      ["year", "month", "ym", "rcid", "postid", "lagerid"],
                      ["costsLogistics", "costsOther"], composite.dc_costs, quarantine)


def _headered(spark: SparkSession, path, fmt: str, template: Sequence[str], feed: str,
              numeric: Sequence[str] = (), extra: Sequence[str] = (), strip_chars: str | None = None,
              sep: str = ",", decimal_comma: bool = False) -> tuple[DataFrame, DataFrame]:
    """Rows of a headered drop with every template column, and its header findings.

    Parquet drops match by name as they are; CSV drops and workbooks (``xlsx``: the
    first sheet) by each file's own header.
    """
    wanted = [*template, *extra]
    if fmt == "xlsx":
        rows, layouts = scan_workbooks(spark, path, wanted, numeric, strip_chars, decimal_comma)
        headers = [[normalize_header(h, strip_chars) for h in header] for header, _ in layouts]
    elif fmt == "csv":
        rows, layouts = scan_by_header(spark, path, wanted, numeric, sep, strip_chars, decimal_comma)
        headers = [[normalize_header(h, strip_chars) for h in header] for header, _ in layouts]
    else:
        rows = scan_monthly_table(spark, path, fmt=fmt, strip_chars=strip_chars)
        headers = [rows.columns]
        for name in (normalize_header(w, strip_chars) for w in wanted):
            if name not in rows.columns:
                rows = rows.withColumn(name, F.lit(None).cast("string"))
    plain = [normalize_header(t, strip_chars) for t in template]
    found = [quality.header_findings(spark, h, plain, feed) for h in headers]
    return rows, quality.dq_report(found or [quality.header_findings(spark, [], plain, feed)])


# ---------------------------------------------------------------------------
# tariff
# ---------------------------------------------------------------------------


def tariff_drop(spark: SparkSession, path: str | Sequence[str], fmt: str = "csv") -> FeedRun:
    c = CONTRACTS["tariff"]
    key, kwt, uah = (normalize_header(h, " '") for h in
                     (TARIFF_TEMPLATE[0], TARIFF_TEMPLATE[2], TARIFF_TEMPLATE[3]))
    raw, headers = _headered(spark, path, fmt, TARIFF_TEMPLATE, c.name, [kwt, uah], strip_chars=" '")
    rows = raw.select(F.col(key).cast("string").alias("mvz"),
                      parse_number(F.col(kwt)).alias("kwt"), parse_number(F.col(uah)).alias("uah"),
                      F.col("file_year").alias("year"), F.col("file_month").alias("month"))
    invalid = ~F.coalesce(valid_key(F.col("mvz")), F.lit(False))
    checks = quality.ObservedChecks(c.name)
    result = composite.tariff_by_cost_centre(
        checks.watch(rows, [("invalid_key", "mvz", invalid)]), keys=["year", "month"])
    dq = quality.dq_report([
        headers,
        quality.count_finding(rows, invalid, "invalid_key", "mvz", c.name),
        quality.duplicate_count(composite.tariff_by_cost_centre(rows, keys=["year", "month"]),
                                ["year", "month", "mvz"], c.name),
    ])
    return FeedRun(c, conform_schema(result, c.target_schema), dq, checks, headers,
                   drop_periods(spark, raw))


# ---------------------------------------------------------------------------
# meter readings
# ---------------------------------------------------------------------------


def meter_drop(spark: SparkSession, paths: str | Sequence[str], directory: DataFrame,
               sep: str = ",", fmt: str = "csv") -> FeedRun:
    """Meter drops (CSV or workbooks) -> kitchen-group consumption per store and month."""
    c = CONTRACTS["meter"]
    meters = sorted({normalize_header(t) for t in METER_TEMPLATE[3:]})
    rows, headers = _headered(spark, paths, fmt, METER_TEMPLATE, c.name, meters, sep=sep,
                              decimal_comma=True)
    periods = drop_periods(spark, rows)
    day = parse_date(F.col(METER_DATE))
    in_period = ((F.year(day) == F.col("file_year")) & (F.month(day) == F.col("file_month")))
    in_period = F.coalesce(in_period, F.lit(False))
    outside = quality.count_finding(rows, ~in_period, "period_mismatch", METER_DATE, c.name)
    rows = rows.where(in_period)
    code = parse_number(code_before_comma(F.col(METER_STORE)), integral=True)
    enriched = enrich_store(rows, directory, code, out_col="filid")

    def rollup(df: DataFrame) -> DataFrame:
        return composite.meter_rollup(
            _period_cols(df), normalized_groups(METER_GROUPS), METER_STORE, "filid",
            ["year", "month", "filid"], meters)

    checks = quality.ObservedChecks(c.name)
    result = rollup(checks.watch(enriched, [("unmatched", "store", F.col("filid").isNull())]))
    dq = quality.dq_report([
        headers, outside,
        quality.count_finding(enriched, F.col("filid").isNull(), "unmatched", "store", c.name),
        quality.duplicate_count(rollup(enriched), ["year", "month", "filid"], c.name),
    ])
    out = result.select("year", "month", "filid", *METER_OUTPUT_GROUPS)
    return FeedRun(c, conform_schema(out, c.target_schema), dq, checks, headers, periods)


# ---------------------------------------------------------------------------
# hierarchical account report
# ---------------------------------------------------------------------------


def accounts_drop(spark: SparkSession, path: str | Sequence[str], directory: DataFrame,
                  fmt: str = "parquet", row_no: str = "row_no") -> FeedRun:
    """Account report (landed with its row number) -> store rows per account."""
    c = CONTRACTS["accounts"]
    raw, headers = _headered(spark, path, fmt, ACCOUNTS_TEMPLATE, c.name, extra=[row_no])
    code, name = normalize_header("Стаття/МВЗ"), normalize_header("Назва")
    report = raw.withColumn(row_no, F.col(row_no).cast("long"))
    filled = composite.filled_report(_period_cols(report), code, name, row_no, ["file_drop"])
    checks = quality.ObservedChecks(c.name)
    # rows above the first article row of their report have no article (dropped)
    found = [("no_article", "row_no", F.col("account").isNull()), ("unmatched", "store", F.col("filid").isNull())]

    def accounts(watch=None) -> DataFrame:
        return composite.accounts_of(filled, directory, code, "uah", "percent", row_no, ["year", "month"], watch)

    dq = quality.dq_report([
        headers,
        quality.count_finding(filled, F.col("account").isNull(), "no_article", "row_no", c.name),
        quality.duplicate_count(accounts(), ["filid", "account", "name", "year", "month"], c.name),
    ])
    result = accounts(lambda rows: checks.watch(rows, found))
    return FeedRun(c, conform_schema(result, c.target_schema), dq, checks, headers, drop_periods(spark, raw))


# ---------------------------------------------------------------------------
# labour hours
# ---------------------------------------------------------------------------


def labor_drop(spark: SparkSession, hours_path: str | Sequence[str], roles: DataFrame,
               rate_card: DataFrame, directory: DataFrame, sales: DataFrame,
               rate_col: str, fmt: str = "csv", calendar: DataFrame | None = None,
               stores: DataFrame | None = None) -> FeedRun:
    """Labour hours x rates per store and department, shared role split by sales.

    ``roles``: (``посада з годин``, ``Посада з зп``, ``depid``, ``Відділ``);
    ``rate_card``: (``№ магазина``, ``посада``, ``rate_col``) - the rate column
    name changes with each card and is passed in; ``sales``: (filid, depid,
    year, month, type_oper, sumout). Processes the period(s) of the hours drop.
    ``stores`` (a ``filid`` column) spares the scan of the whole sales history
    that "every store ever seen" needs otherwise.
    """
    c = CONTRACTS["labor"]
    raw, headers = _headered(spark, hours_path, fmt, LABOR_TEMPLATE, c.name, extra=["category"])
    raw = raw.withColumn("region", F.coalesce("region", "category"))
    hours = raw.select(
        parse_number(F.col("filid"), integral=True).alias("filid"),
        parse_number(F.col("mm"), integral=True).cast("int").alias("mm"),
        parse_number(F.col("h")).alias("h"), "region", "filialname",
        "file_year", "file_month")
    # a row whose own month differs from its file's is set aside (and counted)
    own_month = F.coalesce(F.col("mm") == F.col("file_month"), F.lit(False))
    month_mismatch = quality.count_finding(hours, ~own_month, "period_mismatch", "mm", c.name)
    checks = quality.ObservedChecks(c.name)
    hour_keys = ["filid", "mm", "region", "filialname"]
    watched = checks.watch(hours, [("period_mismatch", "mm", ~own_month),
                                   ("null_key", ",".join(hour_keys), own_month & _any_null(hour_keys))])

    def summed(rows: DataFrame) -> DataFrame:
        return grouped_sum(rows.where(own_month),
                           [*hour_keys, "file_year", "file_month"], ["h"], scale=9)

    r = roles.toDF(*[normalize_header(x) for x in roles.columns])
    role_dict = r.select(F.col(normalize_header("посада з годин")).alias("region"),
                         F.col(normalize_header("Посада з зп")).alias("pay_role"),
                         F.col("depid").cast("string").alias("depid"))
    card = rate_card.toDF(*[normalize_header(x) for x in rate_card.columns])
    card = card.select(parse_number(F.col(normalize_header("№ магазина")), integral=True)
                       .alias("code"),
                       F.col(normalize_header("посада")).alias("pay_role"),
                       parse_number(F.col(normalize_header(rate_col))).alias("rate"))
    card = enrich_store(card, directory, F.col("code"), out_col="filid")

    card = written(card, "rate-card")

    def priced(main: DataFrame) -> DataFrame:
        return rate_fill(main, card, "pay_role", "filid", "rate", "h", kept=True)

    def rows_of(filled: DataFrame) -> DataFrame:
        return filled.select(F.col("file_year").alias("y"), F.col("mm").alias("m"),
                             F.col("filid").cast("long").alias("filid"), "depid",
                             F.col("h").cast("double").alias("hours"), "cost_hour", "cost_labor")

    main = summed(hours).join(role_dict, "region", "left")
    filled = priced(main)
    labor = rows_of(filled)
    # the same once more for the load, watched on the way
    loaded = checks.watch(priced(summed(watched).join(role_dict, "region", "left")), [
        ("unmatched", "role", F.col("pay_role").isNull()), ("no_rate", "pay_role", F.col("cost_hour").isNull())])

    # the months of the drop, from its file names (a listing, no data read)
    periods = drop_periods(spark, raw)
    share = dense_sales_share_periods(sales, periods, SHARED_SPLIT, calendar=calendar,
                                      stores=stores)
    share = share.select(F.col("filid").cast("long").alias("filid"),
                         F.col("depid").cast("string").alias("depid"),
                         "year", "month", "sumout_dep", "sumout_filial")
    share = written(share, "sales-share")
    split = [("y", "year"), ("m", "month")]
    out = labor_allocation(labor, share, SHARED_DEPT, period_cols=split)
    shared = labor.where(F.col("depid") == SHARED_DEPT)
    store_month = share.select("filid", F.col("year").alias("y"), F.col("month").alias("m"),
                               "sumout_filial").distinct()
    result = labor_allocation(rows_of(loaded), share, SHARED_DEPT, period_cols=split).select(
        "y", "m", "filid", F.col("depid").try_cast("int").alias("depid"), "hours", "cost_hour", "cost_labor")
    dq = quality.dq_report([
        headers,
        month_mismatch,
        quality.count_finding(main, F.col("pay_role").isNull(), "unmatched", "role", c.name),
        # the role and its department must agree on what is shared
        quality.count_finding(main, F.coalesce(F.col("region") == SHARED_ROLE, F.lit(False))
                              != F.coalesce(F.col("depid") == SHARED_DEPT, F.lit(False)),
                              "shared_role_mismatch", "region,depid", c.name),
        quality.count_finding(filled, F.col("cost_hour").isNull(), "no_rate", "pay_role", c.name),
        quality.count_finding(raw, non_integral(F.col("filid")), "non_integral", "filid", c.name),
        # shared hours that cannot be split: the store sold nothing (hours become 0) ...
        quality.count_finding(shared.join(store_month.where(F.col("sumout_filial") == 0),
                                          ["filid", "y", "m"], "left_semi"),
                              F.lit(True), "shared_hours_zero_sales", "filid", c.name),
        # ... or has no sales rows at all (department and hours stay NULL)
        quality.count_finding(shared.join(store_month, ["filid", "y", "m"], "left_anti"),
                              F.lit(True), "shared_hours_no_sales", "filid", c.name),
        # a department that is no number has none in the target
        quality.count_finding(out, F.col("depid").isNotNull() & F.col("depid").try_cast("int").isNull(),
                              "bad_number", "depid", c.name),
    ])
    return FeedRun(c, conform_schema(result, c.target_schema), dq, checks, headers, periods)


# ---------------------------------------------------------------------------
# scoring and loading
# ---------------------------------------------------------------------------


def score(run: FeedRun, history: DataFrame, year: int, month: int,
          threshold: float = 1.0) -> DataFrame:
    """Anomalies of one month of a feed's result against its target history."""
    c = run.contract
    cur = run.result.where((F.col(c.year_col) == year) & (F.col(c.month_col) == month))
    outs = []
    for keys in (c.group_keys, *c.extra_scoring):
        outs.append(anomaly_one_period(cur, history, year, month, list(c.categories), list(keys),
                                       threshold, year_col=c.year_col, month_col=c.month_col,
                                       value_type="double", round_digits=2)
                    .withColumn("grain", F.lit(",".join(keys))))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), outs)


def score_history(target: DataFrame, contract: FeedContract, threshold: float = 1.0) -> DataFrame:
    """Anomalies of every month of a target table at once (backfill), at each
    scoring grain of the feed."""
    outs = [anomaly_all_periods(target, list(contract.categories), list(keys), threshold,
                                year_col=contract.year_col, month_col=contract.month_col,
                                value_type="double", round_digits=2)
            .withColumn("grain", F.lit(",".join(keys)))
            for keys in (contract.group_keys, *contract.extra_scoring)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), outs)


def drop_periods(spark: SparkSession, df: DataFrame) -> list[tuple[int, int]]:
    """(year, month) of every file a drop DataFrame reads - from the file list only."""
    files = spark.createDataFrame([(f,) for f in df.inputFiles()], "path string")
    p = period_from_name(F.col("path"))
    return sorted({(r.year, r.month) for r in
                   files.select(p["year"].alias("year"), p["month"].alias("month")).collect()})


def load(run: FeedRun, root: str | PeriodTable, year: int | None = None,
         month: int | None = None, quarantine: str | PeriodTable | None = None) -> DataFrame | None:
    """Replace the month ``(year, month)`` - or, without one, every month of the
    drop's files, clearing those without a row left.

    ``quarantine`` is the target of the rejected lines, replaced by month like the
    rows, so a reload of a mended drop also empties its months' quarantine.

    Returns the findings observed during the load (row counts, header
    findings), or ``None`` for a feed without observed checks.
    """
    c = run.contract
    if quarantine is not None:
        if run.rejected is None:
            raise ValueError("the drop was not read with quarantine=True")
        aside = run.rejected.withColumnsRenamed({"file_year": "year", "file_month": "month"})
        months = run.periods
        if year is not None and month is not None:
            aside, months = aside.where((F.col("year") == year) & (F.col("month") == month)), [(year, month)]
        write_periods(aside, quarantine, periods=months)
    if year is not None and month is not None:
        write_period(run.result, root, year, month, c.year_col, c.month_col)
    else:
        write_periods(run.result, root, c.year_col, c.month_col, run.periods)
    parts = [p for p in (run.headers,) if p is not None]
    if run.checks is not None:
        parts.append(run.checks.report(run.result.sparkSession, year, month))
    if run.rejected is not None:
        parts.append(rejected_counts(run.rejected, c.name))
    return quality.dq_report(parts) if parts else None


def full_report(run: FeedRun, target: DataFrame | None = None, year: int | None = None,
                month: int | None = None, anomalies: DataFrame | None = None) -> DataFrame:
    """Every section of a feed's report: the checks of ``run.dq``, control totals per
    month and category, the keys of the month that have no history, and how many
    anomalies each grain has."""
    c, parts = run.contract, [run.dq]
    for category in c.categories:
        totals = control_totals(run.result, [c.year_col, c.month_col], category)
        parts.append(totals.select(
            F.lit(c.name).alias("feed"), F.col(c.year_col).cast("int").alias("year"),
            F.col(c.month_col).cast("int").alias("month"), F.lit("control_total").alias("check"),
            F.lit(category).alias("subject"), F.col("n_rows").alias("n"),
            F.concat(F.lit("total "), F.col("total").cast("string")).alias("detail")))
    if target is not None and year is not None and month is not None:
        current = run.result.where((F.col(c.year_col) == year) & (F.col(c.month_col) == month))
        for keys in (c.group_keys, *c.extra_scoring):
            new = keys_without_history(current, target, year, month, list(keys),
                                       year_col=c.year_col, month_col=c.month_col)
            parts.append(quality.count_finding(new, F.lit(True), "no_history", ",".join(keys), c.name,
                                               year, month))
    if anomalies is not None:
        parts.append(anomalies.groupBy("grain").agg(F.count("*").alias("n")).select(
            F.lit(c.name).alias("feed"), F.lit(year).cast("int").alias("year"),
            F.lit(month).cast("int").alias("month"), F.lit("anomalies").alias("check"),
            F.col("grain").alias("subject"), "n", F.lit(None).cast("string").alias("detail")))
    return quality.dq_report(parts)


def directory_from(raw: DataFrame) -> DataFrame:
    """Store directory (id, name, AccountantNumber, MVZ) ready for the joins."""
    return store_directory(raw)
