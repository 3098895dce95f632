"""Reference SQL for every binding, runnable by DuckDB on the same tables.

Written independently of the DataFrame plans (e.g. self-joins where the
Spark side uses windows) so that agreement means something. Amounts are
summed as unrounded decimals and converted to ``DOUBLE`` once, as on the
Spark side.
"""

from __future__ import annotations

from ledgerloom.operators.anomaly import REASON_BOTH

_REASON = REASON_BOTH.replace("'", "''")

# 0-filled monthly price per store with one column per flag
_STORE_MONTH = """
  SELECT l_suppkey,
         CAST(year(l_shipdate) AS INTEGER) AS year,
         CAST(month(l_shipdate) AS INTEGER) AS month,
         COALESCE(SUM(CASE WHEN l_returnflag = 'A' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0) AS A,
         COALESCE(SUM(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0) AS N,
         COALESCE(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END), 0) AS R
  FROM lineitem
  GROUP BY l_suppkey, year(l_shipdate), month(l_shipdate)
"""

_CELLS = f"""
sm AS ({_STORE_MONTH}),
cells AS (
  SELECT l_suppkey, year, month, year * 12 + month AS mi, 'A' AS category, A AS v FROM sm
  UNION ALL SELECT l_suppkey, year, month, year * 12 + month, 'N', N FROM sm
  UNION ALL SELECT l_suppkey, year, month, year * 12 + month, 'R', R FROM sm
)"""

_SALES = """
  SELECT l_suppkey AS filid, l_returnflag AS depid,
         CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         CASE WHEN l_linestatus = 'F' THEN 'sales' ELSE 'other' END AS type_oper,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS sumout
  FROM lineitem
"""

# the share from its definition: any store, a listed department that has a row in
# the year, any month; what was not sold counts as nothing
_SHARES = f"""
fact AS ({_SALES}),
places AS (SELECT filid FROM fact GROUP BY filid),
active AS (SELECT year, depid FROM fact GROUP BY year, depid HAVING depid = 'A' OR depid = 'R'),
months AS (SELECT range AS month FROM range(1, 13)),
sold AS (
  SELECT filid, depid, year, month, SUM(sumout) FILTER (type_oper = 'sales') AS amount
  FROM fact GROUP BY filid, depid, year, month
),
share AS (
  SELECT active.year, months.month, places.filid, active.depid,
         (SELECT COALESCE(MAX(amount), 0) FROM sold WHERE sold.filid = places.filid
            AND sold.depid = active.depid AND sold.year = active.year AND sold.month = months.month) AS sumout_dep,
         (SELECT COALESCE(SUM(amount), 0) FROM sold WHERE sold.filid = places.filid
            AND sold.depid IN ('A', 'R') AND sold.year = active.year AND sold.month = months.month) AS sumout_filial
  FROM places, active, months
)"""

_LINES_TYPED = """
  SELECT l.l_suppkey, l.l_partkey, l.l_quantity, l.l_shipdate, p.p_type, p.p_retailprice
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""

_RATES = f"""
lt AS ({_LINES_TYPED}),
card AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) + INTERVAL 1 MONTH AS first_day,
         l_suppkey AS filid, p_type AS role, MAX(p_retailprice) AS rate
  FROM lt GROUP BY ALL
),
role_mean AS (
  SELECT first_day, role, CAST(SUM(CAST(rate AS DECIMAL(18,4))) AS DOUBLE) / COUNT(rate) AS role_mean
  FROM card GROUP BY first_day, role
),
hrs AS (
  SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS first_day, l_suppkey AS filid, p_type AS role,
         COALESCE(SUM(CAST(l_quantity AS DECIMAL(18,2))), 0) AS hours
  FROM lt GROUP BY ALL
),
filled AS (
  SELECT CAST(year(h.first_day) AS INTEGER) AS year, CAST(month(h.first_day) AS INTEGER) AS month,
         h.filid, h.role, CAST(h.hours AS DOUBLE) AS hours,
         COALESCE(c.rate, m.role_mean) AS cost_hour,
         COALESCE(c.rate, m.role_mean) * CAST(h.hours AS DOUBLE) AS cost_labor
  FROM hrs h
  LEFT JOIN card c ON c.first_day = h.first_day AND c.filid = h.filid AND c.role = h.role
  LEFT JOIN role_mean m ON m.first_day = h.first_day AND m.role = h.role
)"""

_COST_LINES = """
  SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS ym,
         s.s_nationkey AS rcid, l.l_suppkey, l.l_partkey, l.l_returnflag,
         l.l_extendedprice, l.l_discount, l.l_tax
  FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
"""


ORACLE_SQL: dict[str, str] = {
    "tariff_by_cost_centre": """
WITH g AS (
  SELECT trim(p.p_brand) AS mvz,
         SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS kwt,
         SUM(CAST(l.l_extendedprice AS DECIMAL(12,2)) * CAST(l.l_discount AS DECIMAL(4,2))) AS uah
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  WHERE p.p_brand IS NOT NULL AND trim(p.p_brand) NOT IN ('', '-')
  GROUP BY trim(p.p_brand)
)
SELECT mvz,
       CAST(kwt AS DOUBLE) AS consump_kwt,
       CAST(uah * 1.2 AS DOUBLE) AS consump_uah,
       CASE WHEN kwt <> 0 THEN CAST(uah * 1.2 AS DOUBLE) / CAST(kwt AS DOUBLE) ELSE 0.0 END AS tariff
FROM g
""",

    "anomaly_one_period": f"""
WITH {_CELLS.strip()},
cur AS (SELECT l_suppkey, category, v FROM cells WHERE mi = 1997 * 12 + 6),
hist AS (SELECT * FROM cells WHERE mi BETWEEN 1997 * 12 + 3 AND 1997 * 12 + 5),
own AS (
  SELECT l_suppkey, category, COUNT(v) AS n, COUNT(CASE WHEN v = 0 THEN 1 END) AS zeros,
         SUM(v) AS own_sum
  FROM hist GROUP BY l_suppkey, category
),
gstat AS (SELECT category, SUM(v) AS gsum, COUNT(v) AS gcnt FROM hist GROUP BY category)
SELECT c.l_suppkey, c.category, CAST(c.v AS DOUBLE) AS current,
       CAST(o.own_sum AS DOUBLE) / o.n AS own_avg_3m,
       CAST(g.gsum AS DOUBLE) / g.gcnt AS global_avg,
       '{_REASON}' AS reason
FROM cur c
JOIN own o ON o.l_suppkey = c.l_suppkey AND o.category = c.category
LEFT JOIN gstat g ON g.category = c.category
WHERE g.gsum <> 0 AND abs(c.v) * g.gcnt > abs(g.gsum) * 2.0
  AND o.n = 3 AND o.zeros = 0 AND o.own_sum <> 0 AND abs(c.v) * 3 > abs(o.own_sum) * 2.0
""",

    "anomaly_all_periods": f"""
WITH {_CELLS.strip()},
own AS (
  SELECT c.l_suppkey, c.year, c.month, c.mi, c.category, c.v,
         COUNT(h.v) AS n, COUNT(CASE WHEN h.v = 0 THEN 1 END) AS zeros, SUM(h.v) AS own_sum
  FROM cells c
  JOIN cells h ON h.l_suppkey = c.l_suppkey AND h.category = c.category
              AND h.mi BETWEEN c.mi - 3 AND c.mi - 1
  GROUP BY c.l_suppkey, c.year, c.month, c.mi, c.category, c.v
),
months AS (SELECT DISTINCT category, mi FROM cells),
gstat AS (
  SELECT m.category, m.mi, SUM(h.v) AS gsum, COUNT(h.v) AS gcnt
  FROM months m JOIN cells h ON h.category = m.category AND h.mi BETWEEN m.mi - 3 AND m.mi - 1
  GROUP BY m.category, m.mi
)
SELECT o.l_suppkey, o.year, o.month, o.category, CAST(o.v AS DOUBLE) AS current,
       CAST(o.own_sum AS DOUBLE) / o.n AS own_avg_3m,
       CAST(g.gsum AS DOUBLE) / g.gcnt AS global_avg,
       '{_REASON}' AS reason
FROM own o JOIN gstat g ON g.category = o.category AND g.mi = o.mi
WHERE g.gsum <> 0 AND abs(o.v) * g.gcnt > abs(g.gsum) * 2.0
  AND o.n = 3 AND o.zeros = 0 AND o.own_sum <> 0 AND abs(o.v) * 3 > abs(o.own_sum) * 2.0
""",

    "anomaly_unmatched_keys": """
SELECT DISTINCT l_partkey FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-06-01' AND l_shipdate < TIMESTAMP '1997-07-01'
  AND l_partkey NOT IN (
    SELECT l_partkey FROM lineitem
    WHERE l_shipdate >= TIMESTAMP '1997-03-01' AND l_shipdate < TIMESTAMP '1997-06-01')
""",

    "dense_sales_share": f"""
WITH {_SHARES.strip()}
SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, filid, depid,
       CAST(sumout_dep AS DOUBLE) AS sumout_dep, CAST(sumout_filial AS DOUBLE) AS sumout_filial
FROM share WHERE year = 1997 AND month = 6
""",

    "rate_fill": f"""
WITH {_RATES.strip()}
SELECT year, month, filid, role, hours, cost_hour, cost_labor FROM filled
""",

    "labor_allocation": f"""
WITH {_RATES.strip()},
{_SHARES.strip()}
SELECT f.year AS y, f.month AS m, f.filid, f.role AS depid, f.hours, f.cost_hour, f.cost_labor
FROM filled f WHERE f.role IS DISTINCT FROM 'PROMO'
UNION ALL
SELECT year, month, filid, depid, part, cost_hour, cost_hour * part FROM (
  SELECT f.year, f.month, f.filid, s.depid, f.cost_hour,
         CASE WHEN s.sumout_filial = 0 THEN 0.0
              ELSE f.hours * CAST(s.sumout_dep AS DOUBLE) / CAST(s.sumout_filial AS DOUBLE) END AS part
  FROM filled f LEFT JOIN share s ON s.filid = f.filid AND s.year = f.year AND s.month = f.month
  WHERE f.role = 'PROMO')
""",

    "fill_down": """
WITH marked AS (
  SELECT event_id, user_id, event_type, ts,
         CASE WHEN event_type = 'signup' THEN CAST(event_id AS VARCHAR) END AS hcode,
         CASE WHEN event_type = 'signup' AND value >= 50 THEN props END AS hprops
  FROM events
)
SELECT event_id, user_id, event_type, header_code, header_props FROM (
  SELECT event_id, user_id, event_type,
         last_value(hcode IGNORE NULLS) OVER w AS header_code,
         last_value(hprops IGNORE NULLS) OVER w AS header_props
  FROM marked
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
) WHERE event_type IS DISTINCT FROM 'signup'
""",

    "enrich_store": """
WITH dir AS (
  SELECT s_suppkey AS code, MIN(s_suppkey) AS filid FROM supplier GROUP BY s_suppkey
),
c AS (
  SELECT c_custkey,
         CASE WHEN trim(regexp_extract(c_name, '#(.*)$', 1)) SIMILAR TO '[0-9]+'
              THEN CAST(trim(regexp_extract(c_name, '#(.*)$', 1)) AS BIGINT) END AS code
  FROM customer
)
SELECT c.c_custkey, c.code, dir.filid FROM c JOIN dir ON dir.code = c.code
""",

    "unmatched_keys": """
SELECT o_orderkey, o_custkey FROM orders o
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""",

    "grouped_sum": """
SELECT nullif(l_returnflag, 'N') AS flag,
       CAST(SUM(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS sum_qty,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS sum_price
FROM lineitem WHERE nullif(l_returnflag, 'N') IS NOT NULL
GROUP BY nullif(l_returnflag, 'N')
""",

    "drop_empty_tagged_rows": """
SELECT l_orderkey, l_linenumber, l_discount, l_tax, l_returnflag FROM lineitem
WHERE NOT (COALESCE(l_discount, 0) = 0 AND COALESCE(l_tax, 0) = 0
           AND COALESCE(strpos(l_returnflag, 'R') > 0, false))
""",

    "control_totals": """
SELECT CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       COUNT(*) AS n_rows,
       CAST(COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))), 0) AS DOUBLE) AS total,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))) AS DOUBLE) / COUNT(l_extendedprice) AS mean,
       CAST(COALESCE(SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2)) END), 0) AS DOUBLE)
         AS flagged_total,
       COUNT(CASE WHEN l_returnflag = 'R' THEN 1 END) AS flagged_rows
FROM lineitem
GROUP BY year(l_shipdate), month(l_shipdate)
""",

    "sum_and_first": """
SELECT o_custkey, o_orderstatus,
       CAST(COALESCE(SUM(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS total_price,
       arg_min(nullif(o_orderpriority, '5-LOW'), o_orderkey)
         FILTER (WHERE nullif(o_orderpriority, '5-LOW') IS NOT NULL) AS first_priority
FROM orders
WHERE o_custkey IS NOT NULL AND o_orderstatus IS NOT NULL
GROUP BY o_custkey, o_orderstatus
""",

    "rollup_columns": """
SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
       CAST(SUM(CASE WHEN l_returnflag IN ('A', 'R') THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS g1,
       CAST(SUM(CASE WHEN l_returnflag = 'N' THEN CAST(l_quantity AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS g2,
       CAST(0 AS DOUBLE) AS g3
FROM lineitem
GROUP BY l_suppkey, year(l_shipdate), month(l_shipdate)
""",

    "merge_repeated_columns": """
SELECT l_orderkey, l_linenumber,
       COALESCE(nullif(l_discount, 0), 0) + COALESCE(nullif(l_tax, 0), 0) AS disctax
FROM lineitem
""",

    "role_lookup": """
SELECT c.c_custkey, c.c_nationkey, d.n_name, d.r_name
FROM customer c LEFT JOIN (
  SELECT n.n_nationkey, n.n_name, r.r_name
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
  WHERE r.r_name <> 'ASIA'
) d ON d.n_nationkey = c.c_nationkey
""",

    "rate_lookup": """
SELECT l.l_partkey, l.l_suppkey, l.l_orderkey, l.l_linenumber, l.l_quantity, c.rate,
       c.rate * l.l_quantity AS cost
FROM lineitem l LEFT JOIN (
  SELECT l_partkey, l_suppkey, MAX(l_extendedprice / nullif(l_quantity, 0)) AS rate
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_partkey, l_suppkey
) c ON c.l_partkey = l.l_partkey AND c.l_suppkey = l.l_suppkey
WHERE l.l_linestatus = 'O'
""",

    "store_costs": f"""
WITH cl AS ({_COST_LINES})
SELECT year, month, ym, rcid, l_suppkey AS filid, l_partkey AS lagerid,
       nullif(l_returnflag, 'N') AS proekt,
       CAST(COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(12,2))), 0) AS DOUBLE) AS costs
FROM cl WHERE nullif(l_returnflag, 'N') IS NOT NULL
GROUP BY year, month, ym, rcid, l_suppkey, l_partkey, nullif(l_returnflag, 'N')
""",

    "dc_costs": f"""
WITH cl AS ({_COST_LINES}),
g AS (
  SELECT year, month, ym, rcid, l_suppkey AS postid, l_partkey AS lagerid,
         COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_discount AS DECIMAL(4,2))), 0) AS a,
         COALESCE(SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))), 0) AS b
  FROM cl GROUP BY year, month, ym, rcid, l_suppkey, l_partkey
)
SELECT year, month, ym, rcid, postid, lagerid,
       CAST(a AS DOUBLE) AS "costsLogistics", CAST(b AS DOUBLE) AS "costsOther",
       CAST(a + b AS DOUBLE) AS costs
FROM g
""",

    "replace_period": """
WITH existing AS (
  SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         SUM(CAST(l_quantity AS DECIMAL(18,2))) AS qty
  FROM lineitem GROUP BY l_suppkey, year(l_shipdate), month(l_shipdate)
),
reload AS (
  SELECT l_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year, CAST(month(l_shipdate) AS INTEGER) AS month,
         SUM(CAST(l_quantity AS DECIMAL(18,2)) * 2) AS qty
  FROM lineitem
  WHERE l_shipdate >= TIMESTAMP '1997-06-01' AND l_shipdate < TIMESTAMP '1997-07-01'
    AND l_returnflag <> 'N'
  GROUP BY l_suppkey, year(l_shipdate), month(l_shipdate)
)
SELECT l_suppkey, year, month, CAST(qty AS DOUBLE) AS qty FROM existing
WHERE NOT (year = 1997 AND month = 6)
UNION ALL
SELECT l_suppkey, year, month, CAST(qty AS DOUBLE) AS qty FROM reload
""",

    "valid_key": """
SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority, o_orderstatus AS status
FROM orders
WHERE nullif(o_orderpriority, '5-LOW') IS NOT NULL AND trim(o_orderpriority) NOT IN ('', '-')
  AND o_orderstatus <> 'P' AND trim(o_orderstatus) NOT IN ('', '-')
""",

    "text_amounts": """
SELECT l_orderkey, l_linenumber,
       CASE l_returnflag WHEN 'A' THEN CAST(floor(l_quantity) AS DOUBLE) + 0.5
                         WHEN 'R' THEN CAST(floor(l_quantity) AS DOUBLE) + 0.25 END AS amount,
       strftime(l_shipdate, '%Y-%m-%d') AS day
FROM lineitem
""",

    "filter_period": """
SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1997-06-01' AND l_shipdate < TIMESTAMP '1997-07-01'
""",

    "calendar_columns": """
SELECT strftime(day, '%Y-%m-%d') AS day,
       strftime(date_trunc('month', day), '%Y-%m-%d') AS first_day,
       strftime(last_day(day), '%Y-%m-%d') AS last_day,
       CAST(isodow(day) AS INTEGER) AS weekday_num,
       dayname(day) AS weekday_name,
       strftime(day, '%Y%m') AS ym
FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
""",

    "period_from_name": """
SELECT file_name,
       CAST(2000 + CAST(substr(yymm, 1, 2) AS INTEGER) AS INTEGER) AS year,
       CAST(substr(yymm, 3, 2) AS INTEGER) AS month
FROM (
  SELECT DISTINCT 'meter_' || strftime(o_orderdate, '%y%m') || '.xlsx' AS file_name,
         strftime(o_orderdate, '%y%m') AS yymm
  FROM orders
)
""",

    "rate_summary": """
SELECT p_type,
       COUNT(p_retailprice) AS n,
       CAST(SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(p_retailprice) AS mean,
       CASE WHEN COUNT(p_retailprice) > 1 THEN sqrt(
         CAST(COUNT(p_retailprice) * SUM(CAST(p_retailprice AS DECIMAL(18,2)) * CAST(p_retailprice AS DECIMAL(18,2)))
              - SUM(CAST(p_retailprice AS DECIMAL(18,2))) * SUM(CAST(p_retailprice AS DECIMAL(18,2))) AS DOUBLE)
         / CAST(COUNT(p_retailprice) * (COUNT(p_retailprice) - 1) AS DOUBLE)) END AS std,
       MIN(p_retailprice) AS min,
       round(quantile_cont(p_retailprice, 0.25), 6) AS p25,
       round(quantile_cont(p_retailprice, 0.5), 6) AS p50,
       round(quantile_cont(p_retailprice, 0.75), 6) AS p75,
       MAX(p_retailprice) AS max
FROM part WHERE p_type <> 'PROMO'
GROUP BY p_type
""",

    "price_quartiles": """
SELECT l_returnflag, COUNT(l_extendedprice) AS n,
       CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) / COUNT(l_extendedprice) AS mean,
       sqrt(CAST(COUNT(l_extendedprice)
                 * SUM(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_extendedprice AS DECIMAL(18,2)))
              - SUM(CAST(l_extendedprice AS DECIMAL(18,2))) * SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE)
         / CAST(COUNT(l_extendedprice) * (COUNT(l_extendedprice) - 1) AS DOUBLE)) AS std,
       MIN(l_extendedprice) AS min,
       round(quantile_cont(l_extendedprice, 0.25), 6) AS p25,
       round(quantile_cont(l_extendedprice, 0.5), 6) AS p50,
       round(quantile_cont(l_extendedprice, 0.75), 6) AS p75,
       MAX(l_extendedprice) AS max
FROM lineitem GROUP BY l_returnflag
""",

    "enrich_store_left": """
WITH lines AS (
  SELECT l_orderkey, l_linenumber,
         CASE (l_orderkey + l_linenumber) % 3 WHEN 0 THEN '-' WHEN 1 THEN '1' ELSE CAST(l_suppkey AS VARCHAR) END AS label
  FROM lineitem)
SELECT l_orderkey, l_linenumber, label, CAST(s_suppkey AS BIGINT) AS filid
FROM lines LEFT JOIN (SELECT * FROM supplier WHERE s_suppkey % 10 <> 0) ON CAST(s_suppkey AS VARCHAR) = label
""",

    "text_keys": """
SELECT l_orderkey, l_linenumber,
       lower(l_returnflag) || 'no' || CAST(l_linenumber AS VARCHAR) AS squashed,
       CASE WHEN l_linenumber % 2 = 0 THEN l_returnflag || ' - ' || l_linestatus ELSE l_returnflag END AS stripped
FROM lineitem
""",

    "duplicate_keys": """
SELECT l_orderkey, l_partkey, COUNT(*) AS n FROM lineitem
GROUP BY l_orderkey, l_partkey HAVING COUNT(*) > 1
""",

    "dq_report": """
SELECT 'lineitem' AS feed, CAST(year(l_shipdate) AS INTEGER) AS year,
       CAST(month(l_shipdate) AS INTEGER) AS month, 'null_key' AS "check", 'flag' AS subject,
       CAST(COUNT(CASE WHEN nullif(l_returnflag, 'N') IS NULL THEN 1 END) AS BIGINT) AS n,
       CAST(NULL AS VARCHAR) AS detail
FROM lineitem GROUP BY year(l_shipdate), month(l_shipdate)
UNION ALL
SELECT 'orders', CAST(year(o.o_orderdate) AS INTEGER), CAST(month(o.o_orderdate) AS INTEGER),
       'unmatched', 'o_orderkey', CAST(COUNT(CASE WHEN l.k IS NULL THEN 1 END) AS BIGINT), NULL
FROM orders o LEFT JOIN (SELECT DISTINCT l_orderkey AS k FROM lineitem) l ON l.k = o.o_orderkey
GROUP BY year(o.o_orderdate), month(o.o_orderdate)
UNION ALL
SELECT 'lineitem', y, m, 'duplicate_key', 'l_orderkey,l_partkey',
       CAST(COUNT(CASE WHEN c > 1 THEN 1 END) AS BIGINT), NULL
FROM (SELECT l_orderkey, l_partkey, CAST(year(l_shipdate) AS INTEGER) AS y,
             CAST(month(l_shipdate) AS INTEGER) AS m, COUNT(*) AS c
      FROM lineitem GROUP BY l_orderkey, l_partkey, year(l_shipdate), month(l_shipdate))
GROUP BY y, m
""",


    "meter_rollup": """
WITH r AS (
  SELECT l_shipdate,
         CAST(l_suppkey AS VARCHAR) || ', Store'
           || CASE WHEN l_returnflag = 'R' THEN ' (Оренда)' ELSE '' END AS store,
         CASE WHEN l_linestatus = 'F' THEN l_quantity END AS m_pizza,
         l_discount AS m_dopik, l_tax AS m_grill
  FROM lineitem
),
kept AS (
  SELECT * FROM r
  WHERE NOT (COALESCE(m_pizza, 0) = 0 AND COALESCE(m_dopik, 0) = 0 AND COALESCE(m_grill, 0) = 0
             AND strpos(store, '(Оренда)') > 0)
),
dir AS (SELECT s_suppkey AS code, MIN(s_suppkey) AS filid FROM supplier GROUP BY s_suppkey)
SELECT CAST(year(k.l_shipdate) AS INTEGER) AS year, CAST(month(k.l_shipdate) AS INTEGER) AS month,
       CAST(d.filid AS INTEGER) AS filid,
       CAST(SUM(CAST(COALESCE(k.m_pizza, 0) AS DECIMAL(18,4))) AS DOUBLE) AS "Пиццерия",
       CAST(0 AS DOUBLE) AS "Стрит-Фуд",
       CAST(0 AS DOUBLE) AS "Пекарня",
       CAST(SUM(CAST(COALESCE(k.m_dopik, 0) AS DECIMAL(18,4))) AS DOUBLE) AS "Допёк",
       CAST(SUM(CAST(COALESCE(k.m_grill, 0) AS DECIMAL(18,4))) AS DOUBLE) AS "Гриль"
FROM kept k JOIN dir d ON d.code = CAST(trim(split_part(k.store, ',', 1)) AS BIGINT)
GROUP BY year(k.l_shipdate), month(k.l_shipdate), d.filid
""",

    "accounts_by_store": """
WITH m AS (
  SELECT user_id, event_id AS row_no,
         CASE WHEN event_type = 'signup' THEN '840' || CAST(event_id AS VARCHAR)
              ELSE CAST(user_id AS VARCHAR) END AS code,
         CASE WHEN event_type = 'signup' THEN CASE WHEN value >= 50 THEN props END
              ELSE event_type END AS name,
         value,
         CASE WHEN value >= 50 THEN value / 100 END AS percent
  FROM events
),
f AS (
  SELECT *,
         last_value(CASE WHEN starts_with(code, '840') THEN code END IGNORE NULLS) OVER w AS account,
         last_value(CASE WHEN starts_with(code, '840') THEN name END IGNORE NULLS) OVER w AS hname
  FROM m
  WINDOW w AS (PARTITION BY user_id ORDER BY row_no ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
),
dir AS (SELECT CAST(c_custkey AS VARCHAR) AS mvz, MIN(c_custkey) AS filid FROM customer GROUP BY 1)
SELECT CAST(d.filid AS INTEGER) AS filid, CAST(f.account AS BIGINT) AS account, f.hname AS name,
       CAST(SUM(CAST(f.value AS DECIMAL(18,2))) AS DOUBLE) AS sum,
       arg_min(f.percent, f.row_no) FILTER (WHERE f.percent IS NOT NULL) AS "share_TO"
FROM f JOIN dir d ON d.mvz = trim(f.code)
WHERE NOT starts_with(f.code, '840') AND f.account IS NOT NULL AND f.hname IS NOT NULL
GROUP BY d.filid, f.account, f.hname
""",

    "tariff_by_period": """
WITH g AS (
  SELECT CAST(year(l.l_shipdate) AS INTEGER) AS year, CAST(month(l.l_shipdate) AS INTEGER) AS month,
         trim(p.p_brand) AS mvz,
         SUM(CAST(l.l_quantity AS DECIMAL(18,2))) AS kwt,
         SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS uah
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  WHERE p.p_brand IS NOT NULL AND trim(p.p_brand) NOT IN ('', '-')
  GROUP BY year(l.l_shipdate), month(l.l_shipdate), trim(p.p_brand)
)
SELECT year, month, mvz,
       CAST(kwt AS DOUBLE) AS consump_kwt,
       CAST(uah * 1.2 AS DOUBLE) AS consump_uah,
       CASE WHEN kwt <> 0 THEN CAST(uah * 1.2 AS DOUBLE) / CAST(kwt AS DOUBLE) ELSE 0.0 END AS tariff
FROM g
""",

    "dense_sales_share_year": f"""
WITH {_SHARES.strip()}
SELECT CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, filid, depid,
       CAST(sumout_dep AS DOUBLE) AS sumout_dep, CAST(sumout_filial AS DOUBLE) AS sumout_filial
FROM share
""",

    "conform_schema": """
SELECT l_orderkey, l_linenumber,
       CAST(CAST(l_quantity AS DECIMAL(12,2)) AS DOUBLE) AS l_quantity,
       CAST(CAST(l_tax AS DECIMAL(6,2)) AS DOUBLE) AS l_tax
FROM lineitem
""",
}

# the same scores over the lines as they are after the correction of 1997-06
ORACLE_SQL["anomaly_from_history"] = """
WITH corrected AS (
  SELECT * REPLACE (CASE WHEN l_suppkey % 5 = 0 AND year(l_shipdate) = 1997 AND month(l_shipdate) = 6
                         THEN l_extendedprice * 3 ELSE l_extendedprice END AS l_extendedprice)
  FROM lineitem),
""" + ORACLE_SQL["anomaly_all_periods"].replace("lineitem", "corrected").strip().removeprefix("WITH")
