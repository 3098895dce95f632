"""Every operator bound to the shared test tables.

Roles: store = supplier (``l_suppkey``), SKU / cost centre = part, month = month
of ``l_shipdate``, categories = ``l_returnflag``. The tables hold no NULLs in
the columns used, so ``nullif`` makes some where a NULL rule is exercised.

Each function takes ``(spark, sf_dir)`` and returns a lazy DataFrame; every
one reads whole tables (a period filter is the feature only where the
operator is a one-month operator). Amounts are summed exactly at a fixed
number of decimals and leave as doubles, so results do not depend on row order.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import (
    calendar_columns,
    code_before_comma,
    parse_date,
    parse_number,
    period_from_name,
    squash_text,
    strip_chars,
    valid_key,
)
from ledgerloom.operators import aggregate as agg
from ledgerloom.operators import composite, enrich, filters, quality, reshape, sink
from ledgerloom.operators.allocate import (
    dense_sales_share,
    dense_sales_share_periods,
    labor_allocation,
)
from ledgerloom.operators.anomaly import anomaly_all_periods, anomaly_one_period, keys_without_history
from ledgerloom.operators.filldown import fill_down
from ledgerloom.operators.history import HistoryCells
from ledgerloom.plans.contracts import METER_GROUPS, METER_OUTPUT_GROUPS, normalized_groups
from ledgerloom.session import checkpoint_dir
from ledgerloom.sources.tables import table

# the month every one-period binding scores / loads
YEAR, MONTH = 1997, 6
FLAGS = ["A", "N", "R"]
# months the tables' dates can fall in; years without any sale drop out by themselves
ALL_MONTHS = [(y, m) for y in range(1990, 2011) for m in range(1, 13)]


def _ym(ts: str = "l_shipdate"):
    return [F.year(ts).cast("int").alias("year"), F.month(ts).cast("int").alias("month")]


def _between_months(ts: str, first: tuple[int, int], last: tuple[int, int]):
    """Half-open timestamp range covering the months first..last (pushes down)."""
    lo = f"{first[0]:04d}-{first[1]:02d}-01"
    ny, nm = (last[0] + 1, 1) if last[1] == 12 else (last[0], last[1] + 1)
    hi = f"{ny:04d}-{nm:02d}-01"
    return (F.col(ts) >= F.lit(lo).cast("timestamp_ntz")) & (F.col(ts) < F.lit(hi).cast("timestamp_ntz"))


def _store_month(spark: SparkSession, sf: str, where=None) -> DataFrame:
    """Monthly target table: price per store and month, one column per flag (0-filled)."""
    li = table(spark, sf, "lineitem", "l_suppkey", "l_returnflag", "l_extendedprice", "l_shipdate")
    if where is not None:
        li = li.where(where)
    wide = li.select("l_suppkey", *_ym(), *[
        F.when(F.col("l_returnflag") == f, F.col("l_extendedprice")).alias(f) for f in FLAGS])
    return agg.grouped_sum(wide, ["l_suppkey", "year", "month"], FLAGS, scale=2)


# ---------------------------------------------------------------------------


def tariff_by_cost_centre(spark: SparkSession, sf: str) -> DataFrame:
    """Cost centre = brand; kWh = quantity; cost = price x discount (four decimals).
    Lines are summed per part first (map-side), so only one row per part meets
    the part table."""
    li = table(spark, sf, "lineitem", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    part = table(spark, sf, "part", "p_partkey", "p_brand")
    per_part = agg.grouped_sum(
        li.select("l_partkey", F.col("l_quantity").alias("kwt"),
                  (F.col("l_extendedprice") * F.col("l_discount")).alias("uah")),
        ["l_partkey"], ["kwt", "uah"], scale=9, zero_if_all_null=False)
    rows = per_part.join(part, per_part["l_partkey"] == part["p_partkey"]).select(
        F.col("p_brand").alias("mvz"), "kwt", "uah")
    return composite.tariff_by_cost_centre(rows, scale=None)


def anomaly_one_period_q(spark: SparkSession, sf: str) -> DataFrame:
    """Store x flag price of 1997-06 against 1997-03..05."""
    current = _store_month(spark, sf, _between_months("l_shipdate", (YEAR, MONTH), (YEAR, MONTH)))
    history = _store_month(spark, sf, _between_months("l_shipdate", (YEAR, MONTH - 3), (YEAR, MONTH - 1)))
    return anomaly_one_period(current, history, YEAR, MONTH, FLAGS, ["l_suppkey"])


def anomaly_all_periods_q(spark: SparkSession, sf: str) -> DataFrame:
    """Every month of the store x flag price table against its previous three."""
    return anomaly_all_periods(_store_month(spark, sf), FLAGS, ["l_suppkey"])


def anomaly_from_history(spark: SparkSession, sf: str) -> DataFrame:
    """Scores from kept cells after a correction: all months are loaded, then 1997-06 comes
    again with the prices of every fifth store times three; the facts are not scored."""
    li = table(spark, sf, "lineitem", "l_suppkey", "l_returnflag", "l_extendedprice", "l_shipdate")
    kept = HistoryCells(spark, f"{checkpoint_dir(spark).rstrip('/')}/history-{uuid.uuid4().hex}", ["l_suppkey"], FLAGS)
    kept.replace(_store_month(spark, sf))
    again = li.where(_between_months("l_shipdate", (YEAR, MONTH), (YEAR, MONTH))).withColumn(
        "l_extendedprice", F.when(F.col("l_suppkey") % 5 == 0, F.col("l_extendedprice") * 3)
        .otherwise(F.col("l_extendedprice")))
    wide = again.select("l_suppkey", *_ym(), *[
        F.when(F.col("l_returnflag") == f, F.col("l_extendedprice")).alias(f) for f in FLAGS])
    kept.replace(agg.grouped_sum(wide, ["l_suppkey", "year", "month"], FLAGS, scale=2), [(YEAR, MONTH)])
    return kept.score_all()


def anomaly_unmatched_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Parts of 1997-06 with no row in 1997-03..05 (not scored)."""
    li = table(spark, sf, "lineitem", "l_partkey", "l_shipdate")
    current = li.where(_between_months("l_shipdate", (YEAR, MONTH), (YEAR, MONTH))).select("l_partkey", *_ym())
    history = li.where(_between_months("l_shipdate", (YEAR, MONTH - 3), (YEAR, MONTH - 1))).select("l_partkey", *_ym())
    return keys_without_history(current, history, YEAR, MONTH, ["l_partkey"])


def _sales(spark: SparkSession, sf: str) -> DataFrame:
    """Sales fact: store = supplier, department = flag, 'sales' = line status F."""
    li = table(spark, sf, "lineitem", "l_suppkey", "l_returnflag", "l_linestatus",
               "l_extendedprice", "l_shipdate")
    return li.select(
        F.col("l_suppkey").alias("filid"), F.col("l_returnflag").alias("depid"), *_ym(),
        F.when(F.col("l_linestatus") == "F", "sales").otherwise("other").alias("type_oper"),
        F.col("l_extendedprice").alias("sumout"))


def dense_sales_share_q(spark: SparkSession, sf: str) -> DataFrame:
    share = dense_sales_share(_sales(spark, sf), YEAR, MONTH, ["A", "R"])
    return share.select("year", "month", "filid", "depid",
                        F.col("sumout_dep").cast("double").alias("sumout_dep"),
                        F.col("sumout_filial").cast("double").alias("sumout_filial"))


def _lines_with_type(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_quantity", "l_shipdate")
    part = table(spark, sf, "part", "p_partkey", "p_type", "p_retailprice")
    return li.join(part, li["l_partkey"] == part["p_partkey"]).select("*", *_ym())


def _rate_card(spark: SparkSession, sf: str) -> DataFrame:
    """Rate cards of all months: a month's card has, per (store, role), the highest
    list price of that type sold in the month before."""
    after = F.add_months(F.trunc("l_shipdate", "month"), 1)
    return (_lines_with_type(spark, sf)
            .groupBy(F.year(after).cast("int").alias("year"), F.month(after).cast("int").alias("month"),
                     F.col("l_suppkey").alias("filid"), F.col("p_type").alias("role"))
            .agg(F.max("p_retailprice").alias("rate")))


def _hours(spark: SparkSession, sf: str) -> DataFrame:
    """Hours per (month, store, role) = quantity."""
    rows = _lines_with_type(spark, sf).select(
        "year", "month", F.col("l_suppkey").alias("filid"), F.col("p_type").alias("role"),
        F.col("l_quantity").alias("hours"))
    return agg.grouped_sum(rows, ["year", "month", "filid", "role"], ["hours"], scale=2)


_MONTH = ["year", "month"]


def rate_fill_q(spark: SparkSession, sf: str) -> DataFrame:
    """Every month's hours priced by that month's card."""
    filled = enrich.rate_fill(_hours(spark, sf), _rate_card(spark, sf), "role", "filid", "rate", "hours",
                              keys=_MONTH)
    return filled.select(*_MONTH, "filid", "role", F.col("hours").cast("double").alias("hours"),
                         "cost_hour", "cost_labor")


def labor_allocation_q(spark: SparkSession, sf: str) -> DataFrame:
    """Role PROMO is shared by departments A and R ('A_R'), split by A/R sales of
    the same month; all months."""
    hours = _hours(spark, sf).withColumn(
        "depid", F.when(F.col("role") == "PROMO", F.lit("A_R")).otherwise(F.col("role")))
    filled = enrich.rate_fill(hours, _rate_card(spark, sf), "role", "filid", "rate", "hours", keys=_MONTH)
    labor = filled.select(F.col("year").alias("y"), F.col("month").alias("m"), "filid", "depid",
                          F.col("hours").cast("double").alias("hours"), "cost_hour", "cost_labor")
    share = dense_sales_share_periods(_sales(spark, sf), ALL_MONTHS, ["A", "R"])
    return labor_allocation(labor, share, "A_R", period_cols=[("y", "year"), ("m", "month")])


def fill_down_q(spark: SparkSession, sf: str) -> DataFrame:
    """Per user, in (ts, event_id) order, the last signup carried onto later events:
    its code (the event id as text), and independently its props where its value
    is at least 50."""
    ev = table(spark, sf, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    out = fill_down(
        ev, ["ts", "event_id"],
        {"header_code": F.col("event_id").cast("string"),
         "header_props": F.when(F.col("value") >= 50, F.col("props"))},
        is_header=F.col("event_type") == "signup", partition_by=["user_id"])
    return out.select("event_id", "user_id", "event_type", "header_code", "header_props")


def enrich_store_q(spark: SparkSession, sf: str) -> DataFrame:
    """Customers labelled ``Customer#<n>`` matched to the supplier directory by
    number; rows without a store are dropped, as the feeds do after the join
    (they are what ``unmatched`` findings count)."""
    cust = table(spark, sf, "customer", "c_custkey", "c_name")
    sup = table(spark, sf, "supplier", "s_suppkey", "s_name", "s_nationkey")
    directory = enrich.store_directory(
        sup.select(F.col("s_suppkey").alias("id"),
                   F.col("s_suppkey").cast("string").alias("AccountantNumber"),
                   F.col("s_name").alias("name"),
                   F.col("s_nationkey").cast("string").alias("MVZ")))
    code = parse_number(F.regexp_extract("c_name", r"#(.*)$", 1), integral=True)
    out = enrich.enrich_store(cust.withColumn("code", code), directory, F.col("code"), how="inner")
    return out.select("c_custkey", "code", F.col("filid").cast("bigint").alias("filid"))


def enrich_store_left(spark: SparkSession, sf: str) -> DataFrame:
    """Lines matched to the supplier directory by a code written as text; of every three
    lines one has no code and one has that of the first supplier. Unmatched lines stay."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey")
    sup = table(spark, sf, "supplier", "s_suppkey")
    directory = enrich.store_directory(
        sup.where(F.col("s_suppkey") % 10 != 0).select(
            F.col("s_suppkey").alias("id"), F.concat(F.lit(" "), F.col("s_suppkey").cast("string")).alias("AccountantNumber")),
        name_col=None, mvz_col=None)
    third = (F.col("l_orderkey") + F.col("l_linenumber")) % 3
    text = F.when(third == 0, F.lit("-")).when(third == 1, F.lit("1")).otherwise(F.col("l_suppkey").cast("string"))
    out = enrich.enrich_store(li.select("l_orderkey", "l_linenumber", text.alias("label")), directory,
                              parse_number(F.col("label"), integral=True), how="left", deal_hot=True)
    return out.select("l_orderkey", "l_linenumber", "label", F.col("filid").cast("bigint").alias("filid"))


def unmatched_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Orders without any line."""
    orders = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    li = table(spark, sf, "lineitem", "l_orderkey")
    return enrich.unmatched_rows(orders, li, ["o_orderkey"], ["l_orderkey"])


def grouped_sum_q(spark: SparkSession, sf: str) -> DataFrame:
    """Flag N made NULL: its rows vanish from the grouping."""
    li = table(spark, sf, "lineitem", "l_returnflag", "l_quantity", "l_extendedprice")
    rows = li.select(F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"),
                     F.col("l_quantity").alias("sum_qty"),
                     F.col("l_extendedprice").alias("sum_price"))
    g = agg.grouped_sum(rows, ["flag"], ["sum_qty", "sum_price"], scale=2)
    return g.select("flag", F.col("sum_qty").cast("double").alias("sum_qty"),
                    F.col("sum_price").cast("double").alias("sum_price"))


def drop_empty_tagged_rows_q(spark: SparkSession, sf: str) -> DataFrame:
    """Lines with no discount and no tax whose flag is R are removed."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_discount", "l_tax",
               "l_returnflag")
    return filters.drop_empty_tagged_rows(li, ["l_discount", "l_tax"], "l_returnflag", "R")


def control_totals_q(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of price x discount (four decimals) per month."""
    li = table(spark, sf, "lineitem", "l_extendedprice", "l_discount", "l_returnflag", "l_shipdate")
    rows = li.select(*_ym(), (F.col("l_extendedprice") * F.col("l_discount")).alias("rebate"),
                     "l_returnflag")
    return agg.control_totals(rows, ["year", "month"], "rebate",
                              flag=F.col("l_returnflag") == "R")


def sum_and_first_q(spark: SparkSession, sf: str) -> DataFrame:
    """Per (customer, status): total price and the first set priority by order key."""
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
              "o_orderpriority")
    rows = o.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                    F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("first_priority"))
    g = agg.sum_and_first(rows, ["o_custkey", "o_orderstatus"], ["o_totalprice"],
                          ["first_priority"], order="o_orderkey", scale=2)
    return g.select("o_custkey", "o_orderstatus",
                    F.col("o_totalprice").cast("double").alias("total_price"), "first_priority")


def rollup_columns_q(spark: SparkSession, sf: str) -> DataFrame:
    """Per-line meter columns A/N/R (quantity) rolled into g1 = A+R, g2 = N,
    g3 = an absent meter (0), then summed per store and month."""
    li = table(spark, sf, "lineitem", "l_suppkey", "l_returnflag", "l_quantity", "l_shipdate")
    wide = li.select("l_suppkey", *_ym(), *[
        F.when(F.col("l_returnflag") == f, F.col("l_quantity")).alias(f) for f in FLAGS])
    rolled = reshape.rollup_columns(wide, {"g1": ["A", "R"], "g2": ["N"], "g3": ["X"]},
                                    keep=["l_suppkey", "year", "month"])
    g = agg.grouped_sum(rolled, ["l_suppkey", "year", "month"], ["g1", "g2", "g3"], scale=2)
    return g.select("l_suppkey", "year", "month",
                    *[F.col(c).cast("double").alias(c) for c in ("g1", "g2", "g3")])


def merge_repeated_columns_q(spark: SparkSession, sf: str) -> DataFrame:
    """Headers 'Disc Tax' and 'disc tax' are one meter once normalised: summed."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_discount", "l_tax")
    wide = li.select("l_orderkey", "l_linenumber",
                     F.nullif(F.col("l_discount"), F.lit(0.0)).alias("Disc Tax"),
                     F.nullif(F.col("l_tax"), F.lit(0.0)).alias("disc tax"))
    return reshape.merge_repeated_columns(wide)


def role_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Customer nation -> (nation, region) dictionary that leaves ASIA out."""
    c = table(spark, sf, "customer", "c_custkey", "c_nationkey")
    n = table(spark, sf, "nation", "n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf, "region", "r_regionkey", "r_name")
    dictionary = (n.join(r, n["n_regionkey"] == r["r_regionkey"])
                  .where(F.col("r_name") != "ASIA")
                  .select(F.col("n_nationkey").alias("c_nationkey"), "n_name", "r_name"))
    return enrich.role_lookup(c, dictionary, "c_nationkey").select(
        "c_custkey", "c_nationkey", "n_name", "r_name")


def rate_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Open lines (status O) priced by (part, supplier) from the highest unit price
    of the finished ones (status F)."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
               "l_quantity", "l_extendedprice", "l_linestatus")
    card = (li.where(F.col("l_linestatus") == "F").groupBy("l_partkey", "l_suppkey")
            .agg(F.max(F.col("l_extendedprice") / F.nullif(F.col("l_quantity"), F.lit(0.0)))
                 .alias("rate")))
    lines = li.where(F.col("l_linestatus") == "O").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    out = enrich.rate_lookup(lines, card, ["l_partkey", "l_suppkey"])
    return out.withColumn("cost", F.col("rate") * F.col("l_quantity"))


def _cost_lines(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem", "l_suppkey", "l_partkey", "l_returnflag", "l_extendedprice",
                 "l_discount", "l_tax", "l_shipdate").select(
        "*", *_ym(), (F.year("l_shipdate") * 100 + F.month("l_shipdate")).cast("int").alias("ym"))


def _with_dc(costs: DataFrame, supplier: str, spark: SparkSession, sf: str) -> DataFrame:
    """The DC of each cost row = its supplier's nation, attached after the sums: a
    supplier with very many lines meets the join as few rows."""
    sup = table(spark, sf, "supplier", "s_suppkey", "s_nationkey").where(F.col("s_nationkey").isNotNull())
    return costs.join(sup, F.col(supplier) == F.col("s_suppkey")).withColumnRenamed("s_nationkey", "rcid")


def store_costs_q(spark: SparkSession, sf: str) -> DataFrame:
    """DC = supplier nation, store = supplier, SKU = part, project = flag (N -> NULL, dropped)."""
    rows = _cost_lines(spark, sf).select(
        "year", "month", "ym", F.col("l_suppkey").alias("filid"), F.col("l_partkey").alias("lagerid"),
        F.nullif(F.col("l_returnflag"), F.lit("N")).alias("proekt"), F.col("l_extendedprice").alias("costs"))
    g = composite.store_costs(rows, [k for k in composite.STORE_COST_KEYS if k != "rcid"])
    return _with_dc(g, "filid", spark, sf).select(
        *composite.STORE_COST_KEYS, F.col("costs").cast("double").alias("costs"))


def dc_costs_q(spark: SparkSession, sf: str) -> DataFrame:
    """Logistics = price x discount, other = price x tax, four decimals each (0 made
    NULL; all-NULL sums are 0)."""
    def cost(rate: str):
        return F.nullif(F.col("l_extendedprice") * F.col(rate), F.lit(0.0))

    rows = _cost_lines(spark, sf).select(
        "year", "month", "ym", F.col("l_suppkey").alias("postid"), F.col("l_partkey").alias("lagerid"),
        cost("l_discount").alias("costsLogistics"), cost("l_tax").alias("costsOther"))
    g = composite.dc_costs(rows, [k for k in composite.DC_COST_KEYS if k != "rcid"])
    return _with_dc(g, "postid", spark, sf).select(
        *composite.DC_COST_KEYS,
        *[F.col(c).cast("double").alias(c) for c in ("costsLogistics", "costsOther", "costs")])


def replace_period_q(spark: SparkSession, sf: str) -> DataFrame:
    """Store-month quantities; 1997-06 replaced by a reload (x2, flag N left out)."""
    li = table(spark, sf, "lineitem", "l_suppkey", "l_returnflag", "l_quantity", "l_shipdate")
    existing = agg.grouped_sum(li.select("l_suppkey", *_ym(), F.col("l_quantity").alias("qty")),
                               ["l_suppkey", "year", "month"], ["qty"], scale=2)
    reload = (li.where(_between_months("l_shipdate", (YEAR, MONTH), (YEAR, MONTH))
                       & (F.col("l_returnflag") != "N"))
              .select("l_suppkey", *_ym(), (F.col("l_quantity") * 2).alias("qty")))
    new = agg.grouped_sum(reload, ["l_suppkey", "year", "month"], ["qty"], scale=2)
    out = sink.replace_period_frame(existing, new, YEAR, MONTH)
    return out.withColumn("qty", F.col("qty").cast("double"))


def valid_key_q(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders", "o_orderkey", "o_orderstatus", "o_orderpriority")
    rows = o.select("o_orderkey",
                    F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
                    F.when(F.col("o_orderstatus") == "P", F.lit("\u00a0- \u00a0"))
                    .otherwise(F.col("o_orderstatus")).alias("status"))
    return rows.where(valid_key(F.col("priority")) & valid_key(F.col("status")))


def text_amounts(spark: SparkSession, sf: str) -> DataFrame:
    """Amounts written as text in many ways, parsed again: a decimal comma, NBSP
    around, blank (flag N with an even line), junk (odd), and a day-first date."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_quantity", "l_shipdate")
    whole = F.col("l_quantity").cast("bigint").cast("string")
    written = (F.when(F.col("l_returnflag") == "A", F.concat(whole, F.lit(",5")))
               .when(F.col("l_returnflag") == "R", F.concat(F.lit("\u00a0"), whole, F.lit(".25\t")))
               .when(F.col("l_linenumber") % 2 == 0, F.lit(" \u00a0 ")).otherwise(F.lit("12d")))
    day = F.date_format("l_shipdate", "dd.MM.yyyy")
    return li.select("l_orderkey", "l_linenumber", parse_number(written, decimal_comma=True).alias("amount"),
                     F.date_format(parse_date(day), "yyyy-MM-dd").alias("day"))


def text_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Text cells squashed like headers (lower case, no white space, NBSP among it), and
    stripped of a set of signs at both ends."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus")
    spaced = F.concat(F.lit("\u00a0 "), F.col("l_returnflag"), F.lit("\t N O\u2003"), F.col("l_linenumber").cast("string"))
    inner = F.when(F.col("l_linenumber") % 2 == 0, F.concat_ws(" - ", "l_returnflag", "l_linestatus")) \
        .otherwise(F.col("l_returnflag"))
    return li.select("l_orderkey", "l_linenumber", squash_text(spaced).alias("squashed"),
                     strip_chars(F.concat(F.lit(" '-"), inner, F.lit("-' '")), " '-").alias("stripped"))


def filter_period_q(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity",
               "l_shipdate")
    return filters.filter_period(li, "l_shipdate", YEAR, MONTH).drop("l_shipdate")


def calendar_columns_q(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders", "o_orderdate")
    days = o.select(F.col("o_orderdate").cast("date").alias("day")).distinct()
    cal = calendar_columns(F.col("day"))
    return days.select(F.date_format("day", "yyyy-MM-dd").alias("day"),
                       *[v.alias(k) for k, v in cal.items()])


def period_from_name_q(spark: SparkSession, sf: str) -> DataFrame:
    """Drop names ``meter_<yymm>.xlsx`` built from order dates; year = 2000 + yy."""
    o = table(spark, sf, "orders", "o_orderdate")
    names = o.select(F.concat(F.lit("meter_"), F.date_format("o_orderdate", "yyMM"),
                              F.lit(".xlsx")).alias("file_name")).distinct()
    p = period_from_name(F.col("file_name"))
    return names.select("file_name", p["year"].alias("year"), p["month"].alias("month"))


def rate_summary_q(spark: SparkSession, sf: str) -> DataFrame:
    p = table(spark, sf, "part", "p_type", "p_retailprice").where(F.col("p_type") != "PROMO")
    return agg.rate_summary(p, ["p_type"], "p_retailprice")


def price_quartiles(spark: SparkSession, sf: str) -> DataFrame:
    """The summary over facts: line prices per flag, quartiles exact."""
    li = table(spark, sf, "lineitem", "l_returnflag", "l_extendedprice")
    return agg.rate_summary(li, ["l_returnflag"], "l_extendedprice")


def duplicate_keys_q(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem", "l_orderkey", "l_partkey")
    return agg.duplicate_keys(li, ["l_orderkey", "l_partkey"])


def dq_report_q(spark: SparkSession, sf: str) -> DataFrame:
    """Findings per month: NULL keys (flag N) and duplicate (order, part) keys of
    the lines by ship month, orders without lines by order month."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_partkey", "l_returnflag", "l_shipdate")
    orders = table(spark, sf, "orders", "o_orderkey", "o_orderdate")
    lines = li.select("l_orderkey", "l_partkey", *_ym(),
                      F.nullif(F.col("l_returnflag"), F.lit("N")).alias("flag"))
    by = ("year", "month")
    return quality.dq_report([
        quality.null_key_count(lines, ["flag"], "lineitem", by=by),
        quality.unmatched_count(orders.select("o_orderkey", *_ym("o_orderdate")), li,
                                ["o_orderkey"], "orders", ref_keys=["l_orderkey"], by=by),
        quality.duplicate_count(lines, ["l_orderkey", "l_partkey"], "lineitem", by=by),
    ])


def meter_rollup_q(spark: SparkSession, sf: str) -> DataFrame:
    """Lines read as meter readings of the supplier's store.

    Store label ``'<suppkey>, Store'`` tagged ``(Оренда)`` on R lines; meters:
    pizza oven = quantity of F lines, bake-off = discount, grill = tax.
    Empty tagged readings are dropped, the store code before the comma is
    matched to the supplier directory, meters roll up into the kitchen groups.
    """

    li = table(spark, sf, "lineitem", "l_suppkey", "l_returnflag", "l_linestatus", "l_quantity",
               "l_discount", "l_tax", "l_shipdate")
    readings = li.select(
        *_ym(),
        F.concat(F.col("l_suppkey").cast("string"), F.lit(", Store"),
                 F.when(F.col("l_returnflag") == "R", F.lit(" " + composite.RENTAL_TAG))
                 .otherwise(F.lit(""))).alias("магазин"),
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("пічпіца"),
        F.col("l_discount").alias("пквдопік"), F.col("l_tax").alias("пкв"))
    sup = table(spark, sf, "supplier", "s_suppkey")
    directory = enrich.store_directory(
        sup.select(F.col("s_suppkey").alias("id"),
                   F.col("s_suppkey").cast("string").alias("AccountantNumber")),
        name_col=None, mvz_col=None)
    code = parse_number(code_before_comma(F.col("магазин")), integral=True)
    enriched = enrich.enrich_store(readings, directory, code, out_col="filid")
    out = composite.meter_rollup(enriched, normalized_groups(METER_GROUPS), "магазин", "filid",
                                 ["year", "month", "filid"], ["пічпіца", "пквдопік", "пкв"])
    return out.select("year", "month", "filid", *METER_OUTPUT_GROUPS)


def accounts_by_store_q(spark: SparkSession, sf: str) -> DataFrame:
    """Each user's events read as an account report, in event-id order.

    A signup is an article row: code ``'840' || event_id``, name = its props
    where its value is at least 50 (else empty, so the previous name stays).
    Other events are store rows: cost-centre code = the user id, amount
    ``'<value> UAH'``, share = value / 100 where value is at least 50. Store
    rows meet the customer directory on the trimmed code.
    """
    ev = table(spark, sf, "events", "event_id", "user_id", "event_type", "value", "props")
    signup = F.col("event_type") == "signup"
    report = ev.select(
        "user_id", F.col("event_id").alias("row_no"),
        F.when(signup, F.concat(F.lit(composite.ARTICLE_PREFIX), F.col("event_id").cast("string")))
        .otherwise(F.col("user_id").cast("string")).alias("code"),
        F.when(signup, F.when(F.col("value") >= 50, F.col("props")))
        .otherwise(F.col("event_type")).alias("name"),
        F.concat(F.col("value").cast("string"), F.lit(" UAH")).alias("uah"),
        F.when(F.col("value") >= 50, F.col("value") / 100).alias("percent"))
    cust = table(spark, sf, "customer", "c_custkey")
    directory = enrich.store_directory(
        cust.select(F.col("c_custkey").alias("id"), F.lit(None).cast("string").alias("AccountantNumber"),
                    F.col("c_custkey").cast("string").alias("MVZ")), name_col=None)
    return composite.accounts_by_store(report, directory, "code", "name", "uah", "percent",
                                       "row_no", partition_by=["user_id"])


def tariff_by_period(spark: SparkSession, sf: str) -> DataFrame:
    """The tariff operator for every month at once (backfill form): per month and brand."""
    li = table(spark, sf, "lineitem", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
    part = table(spark, sf, "part", "p_partkey", "p_brand")
    per_part = agg.grouped_sum(
        li.select("l_partkey", *_ym(), F.col("l_quantity").alias("kwt"),
                  F.col("l_extendedprice").alias("uah")),
        ["l_partkey", "year", "month"], ["kwt", "uah"], scale=9, zero_if_all_null=False)
    rows = per_part.join(part, per_part["l_partkey"] == part["p_partkey"]).select(
        "year", "month", F.col("p_brand").alias("mvz"), "kwt", "uah")
    return composite.tariff_by_cost_centre(rows, keys=["year", "month"], scale=None)


def dense_sales_share_year(spark: SparkSession, sf: str) -> DataFrame:
    """The dense sales share for every month of every year in one plan."""
    share = dense_sales_share_periods(_sales(spark, sf), ALL_MONTHS, ["A", "R"])
    return share.select("year", "month", "filid", "depid",
                        F.col("sumout_dep").cast("double").alias("sumout_dep"),
                        F.col("sumout_filial").cast("double").alias("sumout_filial"))


# fixed values of this binding: a drifting header row and the template it must meet
_DRIFTED = {"l_orderkey": " L_Order Key", "l_linenumber": "L_LINENUMBER",
            "l_quantity": "l_ quantity", "l_tax": "L_Tax ", "l_comment": "L_Comment"}
_TEMPLATE = ["l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"]
_TARGET = "l_orderkey bigint, l_linenumber int, l_quantity decimal(12,2), l_tax decimal(6,2)"


def conform_schema_q(spark: SparkSession, sf: str) -> DataFrame:
    """Headers that drift in case and spacing are normalised, kept in template
    order, then cast to the target types (matched case-insensitively)."""
    li = table(spark, sf, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_tax",
               "l_returnflag")
    drifted = li.select(*[F.col(c).alias(_DRIFTED.get(c, c)) for c in
                          ("l_orderkey", "l_linenumber", "l_quantity", "l_tax")],
                        F.col("l_returnflag").alias(_DRIFTED["l_comment"]))
    kept = reshape.project_template(reshape.normalize_headers(drifted), _TEMPLATE)
    out = sink.conform_schema(kept, _TARGET)
    return out.select("l_orderkey", "l_linenumber",
                      F.col("l_quantity").cast("double").alias("l_quantity"),
                      F.col("l_tax").cast("double").alias("l_tax"))


QUERIES = {
    "tariff_by_cost_centre": tariff_by_cost_centre,
    "anomaly_one_period": anomaly_one_period_q,
    "anomaly_all_periods": anomaly_all_periods_q,
    "anomaly_from_history": anomaly_from_history,
    "anomaly_unmatched_keys": anomaly_unmatched_keys,
    "dense_sales_share": dense_sales_share_q,
    "rate_fill": rate_fill_q,
    "labor_allocation": labor_allocation_q,
    "fill_down": fill_down_q,
    "enrich_store": enrich_store_q,
    "unmatched_keys": unmatched_keys,
    "grouped_sum": grouped_sum_q,
    "drop_empty_tagged_rows": drop_empty_tagged_rows_q,
    "control_totals": control_totals_q,
    "sum_and_first": sum_and_first_q,
    "rollup_columns": rollup_columns_q,
    "merge_repeated_columns": merge_repeated_columns_q,
    "role_lookup": role_lookup,
    "rate_lookup": rate_lookup,
    "store_costs": store_costs_q,
    "dc_costs": dc_costs_q,
    "replace_period": replace_period_q,
    "valid_key": valid_key_q,
    "text_amounts": text_amounts,
    "text_keys": text_keys,
    "filter_period": filter_period_q,
    "calendar_columns": calendar_columns_q,
    "period_from_name": period_from_name_q,
    "rate_summary": rate_summary_q,
    "price_quartiles": price_quartiles,
    "enrich_store_left": enrich_store_left,
    "duplicate_keys": duplicate_keys_q,
    "dq_report": dq_report_q,
    "meter_rollup": meter_rollup_q,
    "accounts_by_store": accounts_by_store_q,
    "tariff_by_period": tariff_by_period,
    "dense_sales_share_year": dense_sales_share_year,
    "conform_schema": conform_schema_q,
}
