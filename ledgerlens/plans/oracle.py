"""Equivalent SQL for every registered query, runnable by DuckDB on the
driver's tables (views ``lineitem``, ``orders``, ``customer``, ``nation``,
``part``, ``events`` ...).  Written independently of the DataFrame code: this
is the correctness oracle.
"""

from __future__ import annotations

# The sales mapping (same rules as ledgerlens.sources.sales), written once as a
# CTE prefix shared by all oracle statements.
SALES_CTE = """
WITH sales AS (
  SELECT
    l.l_orderkey AS order_id,
    CAST(o.o_orderdate AS DATE) AS order_date,
    CASE WHEN l.l_returnflag = 'R' THEN 'Cancelled'
         WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'F' THEN 'Shipped - Delivered to Buyer'
         WHEN l.l_returnflag = 'A' AND l.l_linestatus = 'O' THEN 'SHIPPED'
         WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'F' THEN 'Pending'
         WHEN l.l_returnflag = 'N' AND l.l_linestatus = 'O' THEN 'Shipped' END AS status,
    CASE WHEN l.l_suppkey % 2 = 0 THEN 'Merchant' ELSE 'Marketplace' END AS fulfilment,
    CASE WHEN l.l_linestatus = 'O' THEN 'Shipped' ELSE 'Unshipped' END AS courier_status,
    CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Expedited' ELSE 'Standard' END AS service_level,
    p.p_brand || '-' || p.p_type AS style,
    CAST(l.l_partkey AS VARCHAR) AS sku,
    CASE WHEN p.p_size <= 5 THEN 'XS' WHEN p.p_size <= 10 THEN 'S'
         WHEN p.p_size <= 15 THEN 'M' WHEN p.p_size <= 20 THEN 'L'
         WHEN p.p_size <= 40 THEN 'XL' WHEN p.p_size <= 44 THEN 'XXL'
         WHEN p.p_size <= 46 THEN '3XL' WHEN p.p_size <= 48 THEN '4XL'
         WHEN p.p_size <= 49 THEN '5XL' ELSE '6XL' END AS size,
    CAST(CAST(l.l_quantity AS INTEGER) % 10 AS INTEGER) AS qty,
    CASE WHEN l.l_tax = 0 AND l.l_discount = 0 THEN NULL ELSE l.l_extendedprice END AS amount,
    CASE WHEN c.c_custkey % 3 = 0 THEN lower(n.n_name)
         WHEN c.c_custkey % 3 = 1 THEN ' ' || n.n_name
         ELSE n.n_name END AS state,
    n.n_name || ' ' || c.c_mktsegment AS city,
    concat_ws(',',
      CASE WHEN l.l_linenumber >= 2 THEN 'A' || CAST(l.l_partkey % 20 AS VARCHAR) || '-' ||
           CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS VARCHAR) END,
      CASE WHEN l.l_linenumber >= 4 THEN ' B' || CAST(l.l_partkey % 200 AS VARCHAR) || '-' ||
           CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS VARCHAR) END,
      CASE WHEN l.l_linenumber >= 6 THEN 'C' || CAST(l.l_partkey AS VARCHAR) || '-' ||
           CAST(year(o.o_orderdate) * 100 + month(o.o_orderdate) AS VARCHAR) END
    ) AS promotion_ids
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN part p ON l.l_partkey = p.p_partkey
)"""


def _q(body: str) -> str:
    return SALES_CTE + ",\n" + body.strip()


VARIETY_CTES = """
vlines AS (
  SELECT strftime(order_date, '%Y-%m') AS month, upper(trim(state)) AS state,
         trim(style) AS style, trim(sku) AS sku, upper(trim(size)) AS size
  FROM sales
  WHERE upper(trim(state)) <> '' AND upper(trim(state)) <> 'NULL' AND state IS NOT NULL
    AND trim(style) <> '' AND trim(sku) <> '' AND trim(size) <> ''
    AND order_date IS NOT NULL
),
sv AS (
  SELECT month, state, style, count(DISTINCT sku) AS variety
  FROM vlines GROUP BY month, state, style
  HAVING bool_or(size IN ('XXL', '3XL', '4XL', '5XL', '6XL'))
)"""

TRAILING_CTES = """
t_lines AS (
  SELECT upper(trim(state)) AS state, order_date AS day, trim(size) AS size
  FROM sales
  WHERE lower(status) LIKE '%shipped%' AND coalesce(qty, 0) > 0
    AND state IS NOT NULL AND upper(trim(state)) <> '' AND upper(trim(state)) <> 'NULL'
    AND size IS NOT NULL AND trim(size) <> '' AND order_date IS NOT NULL
),
t_daily AS (SELECT state, day, size, count(*) AS cnt FROM t_lines GROUP BY state, day, size),
t_fan AS (
  SELECT state, CAST(day + CAST(k AS INTEGER) AS DATE) AS target_date, size, cnt
  FROM t_daily CROSS JOIN range(1, 8) AS r(k)
),
t_counts AS (
  SELECT state, target_date, size, sum(cnt) AS cnt FROM t_fan GROUP BY state, target_date, size
),
t_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY state, target_date ORDER BY cnt DESC, size) AS rn
  FROM t_counts
)"""

TRAILING_SQL = _q(TRAILING_CTES + """
SELECT state, target_date, size AS top_size, CAST(cnt AS BIGINT) AS size_count
FROM t_ranked WHERE rn = 1""")

PROMO_CTES = """
toks AS (
  SELECT order_id, order_date, trim(tok) AS promotion_id
  FROM (SELECT order_id, order_date, unnest(string_split(promotion_ids, ',')) AS tok
        FROM sales WHERE promotion_ids IS NOT NULL AND trim(promotion_ids) <> '') x
),
valid AS (
  SELECT promotion_id, min(order_date) AS first_seen, max(order_date) AS last_seen,
         CAST(date_diff('day', min(order_date), max(order_date)) AS INTEGER) AS active_days
  FROM toks WHERE promotion_id <> ''
  GROUP BY promotion_id
  HAVING date_diff('day', min(order_date), max(order_date)) >= 2
),
good AS (
  SELECT order_id, count(DISTINCT promotion_id) AS valid_promo_count
  FROM toks WHERE promotion_id IN (SELECT promotion_id FROM valid)
  GROUP BY order_id HAVING count(DISTINCT promotion_id) >= 3
),
savg AS (
  SELECT upper(trim(state)) AS state, avg(amount) AS avg_amount
  FROM sales
  WHERE fulfilment = 'Merchant' AND courier_status = 'Shipped'
    AND state IS NOT NULL AND trim(state) <> ''
  GROUP BY upper(trim(state))
),
base AS (
  SELECT order_id, amount, upper(trim(state)) AS state, upper(trim(city)) AS city
  FROM sales
  WHERE status = 'Cancelled' AND service_level = 'Standard'
    AND city IS NOT NULL AND trim(city) <> ''
),
denom AS (SELECT city, count(order_id) AS base_count FROM base GROUP BY city),
numer AS (
  SELECT b.city, count(b.order_id) AS qualified_count
  FROM base b JOIN savg s ON b.state = s.state
  JOIN good g ON b.order_id = g.order_id
  WHERE b.amount < s.avg_amount
  GROUP BY b.city
)"""

PCT_CTES = """
po AS (
  SELECT order_id, sku, CAST(month(order_date) AS INTEGER) AS month, CAST(amount AS DOUBLE) AS amount,
         CAST(CASE WHEN promotion_ids IS NULL OR trim(promotion_ids) = '' THEN 0
                   ELSE len(string_split(trim(promotion_ids), ',')) END AS INTEGER) AS promo_count
  FROM sales
  WHERE order_id IS NOT NULL AND sku IS NOT NULL AND amount IS NOT NULL AND order_date IS NOT NULL
),
thr AS (
  SELECT sku, month, count(*) AS total_orders,
         quantile_disc(promo_count, 0.8) AS p80, quantile_disc(promo_count, 0.9) AS p90
  FROM po GROUP BY sku, month
),
res AS (
  SELECT t.sku, t.month, t.total_orders, t.p80, t.p90,
    count(*) FILTER (WHERE o.promo_count >= t.p80) AS o80,
    stddev_pop(o.amount) FILTER (WHERE o.promo_count >= t.p80) AS s80,
    count(*) FILTER (WHERE o.promo_count >= t.p90) AS o90,
    stddev_pop(o.amount) FILTER (WHERE o.promo_count >= t.p90) AS s90
  FROM thr t JOIN po o ON o.sku = t.sku AND o.month = t.month
  GROUP BY t.sku, t.month, t.total_orders, t.p80, t.p90
),
wide_raw AS (
  SELECT sku, month, total_orders,
    p80 AS threshold_p80_approx, o80 AS orders_p80_approx,
    CASE WHEN o80 < 2 THEN 0.0 ELSE s80 END AS stddev_p80_approx,
    p90 AS threshold_p90_approx, o90 AS orders_p90_approx,
    CASE WHEN o90 < 2 THEN 0.0 ELSE s90 END AS stddev_p90_approx,
    p80 AS threshold_p80_exact, o80 AS orders_p80_exact,
    CASE WHEN o80 < 2 THEN 0.0 ELSE s80 END AS stddev_p80_exact,
    p90 AS threshold_p90_exact, o90 AS orders_p90_exact,
    CASE WHEN o90 < 2 THEN 0.0 ELSE s90 END AS stddev_p90_exact
  FROM res
),
wide AS (
  SELECT sku, month, total_orders,
    p80 AS threshold_p80_approx, o80 AS orders_p80_approx,
    round(CASE WHEN o80 < 2 THEN 0.0 ELSE s80 END, 4) AS stddev_p80_approx,
    p90 AS threshold_p90_approx, o90 AS orders_p90_approx,
    round(CASE WHEN o90 < 2 THEN 0.0 ELSE s90 END, 4) AS stddev_p90_approx,
    p80 AS threshold_p80_exact, o80 AS orders_p80_exact,
    round(CASE WHEN o80 < 2 THEN 0.0 ELSE s80 END, 4) AS stddev_p80_exact,
    p90 AS threshold_p90_exact, o90 AS orders_p90_exact,
    round(CASE WHEN o90 < 2 THEN 0.0 ELSE s90 END, 4) AS stddev_p90_exact
  FROM res
)"""


# Thresholds that are off in stated groups, for the comparison reports: p80 is one more
# where the SKU is a multiple of 7, p90 one less where it is one of 5.
DRIFT_CTES = PCT_CTES + """,
thr_d AS (
  SELECT sku, month, total_orders, p80, p90,
         p80 + CASE WHEN CAST(sku AS BIGINT) % 7 = 0 THEN 1 ELSE 0 END AS a80,
         p90 - CASE WHEN CAST(sku AS BIGINT) % 5 = 0 THEN 1 ELSE 0 END AS a90
  FROM thr
),
res_d AS (
  SELECT t.sku, t.month, t.total_orders, t.p80, t.p90, t.a80, t.a90,
    count(*) FILTER (WHERE o.promo_count >= t.p80) AS o80,
    stddev_pop(o.amount) FILTER (WHERE o.promo_count >= t.p80) AS s80,
    count(*) FILTER (WHERE o.promo_count >= t.p90) AS o90,
    stddev_pop(o.amount) FILTER (WHERE o.promo_count >= t.p90) AS s90,
    count(*) FILTER (WHERE o.promo_count >= t.a80) AS oa80,
    stddev_pop(o.amount) FILTER (WHERE o.promo_count >= t.a80) AS sa80,
    count(*) FILTER (WHERE o.promo_count >= t.a90) AS oa90,
    stddev_pop(o.amount) FILTER (WHERE o.promo_count >= t.a90) AS sa90
  FROM thr_d t JOIN po o ON o.sku = t.sku AND o.month = t.month
  GROUP BY ALL
),
wide_d AS (
  SELECT sku, month, total_orders,
    a80 AS threshold_p80_approx, oa80 AS orders_p80_approx,
    CASE WHEN oa80 < 2 THEN 0.0 ELSE sa80 END AS stddev_p80_approx,
    a90 AS threshold_p90_approx, oa90 AS orders_p90_approx,
    CASE WHEN oa90 < 2 THEN 0.0 ELSE sa90 END AS stddev_p90_approx,
    p80 AS threshold_p80_exact, o80 AS orders_p80_exact,
    CASE WHEN o80 < 2 THEN 0.0 ELSE s80 END AS stddev_p80_exact,
    p90 AS threshold_p90_exact, o90 AS orders_p90_exact,
    CASE WHEN o90 < 2 THEN 0.0 ELSE s90 END AS stddev_p90_exact
  FROM res_d
)"""


def _validate_damaged_sql() -> str:
    ctes = DRIFT_CTES + """,
damaged AS (
  SELECT * REPLACE (
    CASE WHEN CAST(sku AS BIGINT) % 11 = 0 THEN total_orders + 1 ELSE orders_p90_exact END
      AS orders_p90_exact,
    CASE WHEN orders_p90_approx < 2 THEN 1.0 ELSE stddev_p90_approx END AS stddev_p90_approx)
  FROM wide_d),
bad AS (
  SELECT * FROM damaged
  UNION ALL SELECT * FROM damaged WHERE CAST(sku AS BIGINT) % 97 = 0)"""
    parts = ["SELECT 'missing_required_columns' AS \"check\", CAST(1 AS BIGINT) AS violations",
             "SELECT 'duplicate_keys', count(*) - count(DISTINCT (sku, month)) FROM bad"]
    for m in ("approx", "exact"):
        parts.append(f"SELECT 'threshold_p90_{m} >= threshold_p80_{m}', "
                     f"count_if(threshold_p90_{m} < threshold_p80_{m}) FROM bad")
        parts.append(f"SELECT 'orders_p90_{m} <= orders_p80_{m}', "
                     f"count_if(orders_p90_{m} > orders_p80_{m}) FROM bad")
        for l in ("p80", "p90"):
            parts.append(f"SELECT 'orders_{l}_{m} <= total_orders', "
                         f"count_if(orders_{l}_{m} > total_orders) FROM bad")
            count = ("NULL" if (l, m) == ("p80", "exact") else
                     f"count_if(orders_{l}_{m} < 2 AND abs(stddev_{l}_{m}) > 1e-12)")
            parts.append(f"SELECT 'stddev_{l}_{m} == 0 when orders_{l}_{m} < 2', {count} FROM bad"
                         + (" LIMIT 1" if count == "NULL" else ""))
    return _q(ctes + "\n" + "\nUNION ALL\n".join(f"({x})" for x in parts))


def _validate_sql() -> str:
    parts = ["SELECT 'missing_required_columns' AS \"check\", CAST(0 AS BIGINT) AS violations",
             "SELECT 'duplicate_keys', CAST(count(*) - (SELECT count(*) FROM "
             "(SELECT DISTINCT sku, month FROM wide_raw)) AS BIGINT) FROM wide_raw"]
    for m in ("approx", "exact"):
        parts.append(f"SELECT 'threshold_p90_{m} >= threshold_p80_{m}', count(*) FILTER "
                     f"(WHERE threshold_p90_{m} < threshold_p80_{m}) FROM wide_raw")
        parts.append(f"SELECT 'orders_p90_{m} <= orders_p80_{m}', count(*) FILTER "
                     f"(WHERE orders_p90_{m} > orders_p80_{m}) FROM wide_raw")
        for l in ("p80", "p90"):
            parts.append(f"SELECT 'orders_{l}_{m} <= total_orders', count(*) FILTER "
                         f"(WHERE orders_{l}_{m} > total_orders) FROM wide_raw")
            parts.append(f"SELECT 'stddev_{l}_{m} == 0 when orders_{l}_{m} < 2', count(*) FILTER "
                         f"(WHERE orders_{l}_{m} < 2 AND abs(stddev_{l}_{m}) > 1e-12) FROM wide_raw")
    return _q(PCT_CTES + "\n" + "\nUNION ALL\n".join(parts))


def _zero_sql() -> str:
    parts = []
    for m in ("approx", "exact"):
        for l in ("p80", "p90"):
            o, sd = f"orders_{l}_{m}", f"stddev_{l}_{m}"
            parts.append(
                f"SELECT '{m}' AS method, '{l.upper()}' AS percentile, "
                f"count(*) FILTER (WHERE {sd} = 0) AS zero_stddev_groups, "
                f"count(*) FILTER (WHERE {o} < 2 AND {sd} = 0) AS zero_due_to_lt2_qualifying_orders, "
                f"count(*) FILTER (WHERE {o} >= 2 AND {sd} = 0) AS zero_with_at_least_2_qualifying_orders, "
                f"count(*) FILTER (WHERE {sd} <> 0) AS nonzero_stddev_groups FROM wide_raw")
    return _q(PCT_CTES + "\n" + "\nUNION ALL\n".join(parts))


def _by_level(select_for) -> str:
    return "\nUNION ALL\n".join(select_for(l) for l in ("p80", "p90"))


DIFF_CTE = """,
diff AS (
  SELECT sku, month, a80 AS p80_approx, p80 AS p80_exact, CAST(a80 - p80 AS INTEGER) AS p80_diff,
         a90 AS p90_approx, p90 AS p90_exact, CAST(a90 - p90 AS INTEGER) AS p90_diff
  FROM thr_d
)"""

EVENT_CTES = """
ev AS (
  SELECT CAST(event_id AS BIGINT) AS run, event_type AS method,
         CAST(round("value" * 100) AS BIGINT) AS ms
  FROM events WHERE event_type <> 'error'
),
per AS (
  SELECT method, count(ms) AS runs, avg(ms) AS mean_ms, stddev_pop(ms) AS std_ms_population,
         min(ms) AS min_ms, max(ms) AS max_ms
  FROM ev GROUP BY method
),
stats AS (
  SELECT method, count(ms / 1000) AS number_of_runs,
         round(avg(ms / 1000), 6) AS mean_seconds,
         round(CASE WHEN count(ms) < 2 THEN 0.0 ELSE stddev_samp(ms / 1000) END, 6) AS stddev_seconds,
         round(min(ms / 1000), 6) AS min_seconds, round(max(ms / 1000), 6) AS max_seconds
  FROM ev GROUP BY method
)"""

SAMPLE_SQL = _q("""
s1 AS (SELECT * FROM sales WHERE amount IS NULL
       ORDER BY order_id, sku, order_date, status, promotion_ids LIMIT 3)
SELECT sku, strftime(order_date, '%m-%d-%y') AS date, status,
       substring(promotion_ids, 1, 50) AS promo FROM s1""")

MEDIAN_SQL = _q(VARIETY_CTES + """
SELECT month, state, CAST(median(variety) AS DOUBLE) AS median_variety
FROM sv GROUP BY month, state""")

QUAL_SQL = _q(PROMO_CTES + """
SELECT d.city, d.base_count, coalesce(n.qualified_count, 0) AS qualified_count,
       round(coalesce(n.qualified_count, 0) / d.base_count * 100, 2) AS pct_qualified
FROM denom d LEFT JOIN numer n ON d.city = n.city""")

MISMATCH_CTE = DRIFT_CTES + """,
u AS (""" + _by_level(lambda l: f"""
  SELECT '{l.upper()}' AS percentile, sku, month, total_orders,
         threshold_{l}_approx AS threshold_approx, threshold_{l}_exact AS threshold_exact
  FROM wide_d WHERE threshold_{l}_approx <> threshold_{l}_exact""") + """)
"""


def _stddev_histogram_sql(column: str) -> str:
    return _q(PCT_CTES + f""",
v AS (SELECT round({column}, 4) AS x FROM wide_raw),
mm AS (SELECT min(x) AS mn, max(x) AS mx FROM v),
hb AS (
  SELECT CASE WHEN mx - mn = 0 THEN 1
              ELSE least(CAST(floor((x - mn) * 50 / (mx - mn)) AS INTEGER) + 1, 50) END AS bin, mn, mx
  FROM v, mm WHERE x IS NOT NULL
)
SELECT bin, round(mn + (bin - 1) * (mx - mn) / 50, 4) AS bin_lower,
       round(mn + bin * (mx - mn) / 50, 4) AS bin_upper, count(*) AS count
FROM hb GROUP BY bin, mn, mx""")


# The CSV report: its two-digit years mean 2000 to 2099; stated orders have a date, quantity or amount that does not parse.
CSV_CTE = """
report AS (
  SELECT * REPLACE (
    CASE WHEN order_id % 50 >= 2 THEN CAST(strftime(order_date, '20%y-%m-%d') AS DATE) END
      AS order_date,
    CASE WHEN order_id % 70 <> 0 THEN qty END AS qty,
    CASE WHEN order_id % 90 <> 0 THEN amount END AS amount)
  FROM sales)"""

def trailing_sql(days: int) -> str:
    """The daily report over windows of any length, by a join on the date range."""
    return _q(TRAILING_CTES[:TRAILING_CTES.index("t_fan AS")] + f"""
t_days AS (
  SELECT state, CAST(unnest(generate_series(first + 1, last + {days}, INTERVAL 1 DAY)) AS DATE)
         AS target_date
  FROM (SELECT state, CAST(min(day) AS DATE) AS first, CAST(max(day) AS DATE) AS last
        FROM t_daily GROUP BY state) x
),
t_counts AS (
  SELECT d.state, d.target_date, l.size, sum(l.cnt) AS cnt
  FROM t_days d JOIN t_daily l ON l.state = d.state
   AND l.day >= d.target_date - {days} AND l.day < d.target_date
  GROUP BY d.state, d.target_date, l.size
),
t_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY state, target_date ORDER BY cnt DESC, size) AS rn
  FROM t_counts
),
t_result AS (
  SELECT state, target_date, size AS top_size, CAST(cnt AS BIGINT) AS size_count
  FROM t_ranked WHERE rn = 1
)""")


# P80 / P90 of the amount per month and, with a null month, over everything: the value whose
# place in order is the nearest rank.
AMOUNT_CTES = PCT_CTES + """,
scoped AS (
  SELECT month, amount FROM po UNION ALL SELECT CAST(NULL AS INTEGER), amount FROM po
),
placed AS (
  SELECT month, amount, row_number() OVER (PARTITION BY month ORDER BY amount) AS place,
         count(*) OVER (PARTITION BY month) AS n
  FROM scoped
),
amount_thr AS (
  SELECT month, n,
         max(amount) FILTER (WHERE place = CAST(ceil(CAST(n AS DECIMAL(18, 0)) * 0.80) AS BIGINT)) AS p80,
         max(amount) FILTER (WHERE place = CAST(ceil(CAST(n AS DECIMAL(18, 0)) * 0.90) AS BIGINT)) AS p90
  FROM placed GROUP BY month, n
)"""

# The report with stated damage, line by line: its reasons, in a fixed order.
DAMAGE_CTES = """
damaged AS (
  SELECT order_id, concat_ws(',',
    CASE WHEN order_id % 110 = 0 OR order_id % 130 = 0 THEN 'fields' END,
    CASE WHEN order_id % 110 <> 0 AND order_id % 130 <> 0 AND order_id % 50 IN (0, 1)
         THEN 'order_date' END,
    CASE WHEN order_id % 110 <> 0 AND order_id % 130 <> 0 AND order_id % 70 = 0 THEN 'qty' END,
    CASE WHEN order_id % 110 <> 0 AND order_id % 130 <> 0 AND order_id % 90 = 0
         THEN 'amount' END) AS reasons
  FROM sales
)"""

# Two versions of the exact thresholds.
VERSION_CTES = PCT_CTES + """,
old_v AS (SELECT sku, month, p80, p90, CAST(sku AS BIGINT) % 997 AS k FROM thr),
new_v AS (
  SELECT sku, month, p80 + CASE WHEN k = 7 THEN 1 ELSE 0 END AS p80, p90 FROM old_v
  WHERE NOT (k = 42 AND month <= 2)
  UNION ALL SELECT sku, 13, p80, p90 FROM old_v WHERE k = 99 AND month = 5
),
diff_v AS (
  SELECT coalesce(o.sku, n.sku) AS sku, CAST(coalesce(o.month, n.month) AS INTEGER) AS month,
         CASE WHEN o.sku IS NULL THEN 'added' WHEN n.sku IS NULL THEN 'lost' ELSE 'changed' END AS status,
         o.p80 AS old_p80, n.p80 AS new_p80, o.p90 AS old_p90, n.p90 AS new_p90
  FROM old_v o FULL JOIN new_v n ON o.sku = n.sku AND o.month = n.month
  WHERE o.sku IS NULL OR n.sku IS NULL OR o.p80 <> n.p80 OR o.p90 <> n.p90
)"""

SALES_TYPES = (
    ("order_id", "bigint"), ("order_date", "date"), ("status", "string"), ("fulfilment", "string"),
    ("courier_status", "string"), ("service_level", "string"), ("style", "string"),
    ("sku", "string"), ("size", "string"), ("qty", "int"), ("amount", "double"),
    ("state", "string"), ("city", "string"), ("promotion_ids", "string"))

ORACLE: dict[str, str] = {
    "column_profile": _q("""
one AS (SELECT count(*) AS n FROM sales)
""" + " UNION ALL ".join(f"""
SELECT CAST({i} AS INTEGER) AS position, '{name}' AS "column", '{kind}' AS dtype, count(*) AS "rows",
       count(*) FILTER (WHERE {name} IS NULL) AS nulls,
       CAST({f"count(*) FILTER (WHERE trim({name}) = '')" if kind == 'string' else 0} AS BIGINT) AS blanks
FROM sales""" for i, (name, kind) in enumerate(SALES_TYPES))),
    "sketch_thresholds": _q(PCT_CTES + "\nSELECT sku, month, p80, p90 FROM thr"),
    "sketch_rank_error": _q(PCT_CTES + """
SELECT month, level AS percentile, count(*) AS n,
       CAST(ceil(CAST(count(*) AS DECIMAL(18, 0)) * share) AS BIGINT) AS wanted_rank,
       CAST(floor(count(*) * 0.01) AS BIGINT) AS allowed, TRUE AS within_bound
FROM po, (VALUES ('P80', 0.80), ('P90', 0.90)) l(level, share) GROUP BY month, level, share"""),
    "kept_skus": _q("""
sold AS (SELECT DISTINCT upper(trim(state)) AS state, strftime(order_date, '%Y-%m') AS period, sku
         FROM sales),
steps AS (SELECT state, period, lag(period) OVER (PARTITION BY state ORDER BY period) AS before
          FROM (SELECT DISTINCT state, period FROM sold) p)
SELECT s.state, s.period, count(*) AS items, count(b.sku) AS kept, TRUE AS within_bound
FROM steps s JOIN sold n ON n.state = s.state AND n.period = s.period
LEFT JOIN sold b ON b.state = s.state AND b.period = s.before AND b.sku = n.sku
WHERE s.before IS NOT NULL GROUP BY s.state, s.period"""),
    "heavy_sku_customers": """
SELECT l_partkey AS sku, o_custkey AS customer, count(*) AS lines,
       (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS total_lines
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_partkey, o_custkey
HAVING count(*) > 0.00003 * (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""",
    "heavy_sizes": _q("""
n AS (SELECT count(*) AS total_lines FROM sales)
SELECT state, size, count(*) AS lines, max(total_lines) AS total_lines
FROM sales, n GROUP BY state, size HAVING count(*) > 0.004 * max(total_lines)"""),
    "orders_by_increments": _q(PROMO_CTES + "\nSELECT * FROM good"),
    "promotions_by_increments": _q(PROMO_CTES + "\nSELECT * FROM valid"),
    "qualification_rate_colocated": QUAL_SQL,
    "percentile_stddev_colocated": _q(PCT_CTES + "\nSELECT * FROM wide"),
    "version_diff": _q(VERSION_CTES + "\nSELECT * FROM diff_v"),
    "version_diff_summary": _q(VERSION_CTES
                               + "\nSELECT status, count(*) AS groups FROM diff_v GROUP BY status"),
    "quarantine_rows": _q(DAMAGE_CTES + """
SELECT order_id, reasons, TRUE AS has_place FROM damaged WHERE reasons <> ''"""),
    "quarantine_counts": _q(DAMAGE_CTES + """,
outcomes AS (
  SELECT unnest(CASE WHEN reasons = '' THEN ['good'] ELSE string_split(reasons, ',') END) AS outcome
  FROM damaged
)
SELECT names.outcome, count(o.outcome) AS observed, count(o.outcome) AS "rows"
FROM (VALUES ('fields'), ('order_date'), ('qty'), ('amount'), ('good')) names(outcome)
LEFT JOIN outcomes o ON o.outcome = names.outcome GROUP BY names.outcome"""),
    "verified_write": "WITH rate AS (" + QUAL_SQL + """),
sums AS (
  SELECT count(*) AS n, CAST(sum(CAST(('0x' || substr(md5(concat_ws('|', city, base_count,
           qualified_count, pct_qualified)), 1, 15)) AS BIGINT)) AS VARCHAR) AS c
  FROM rate
)
SELECT n AS rows_written, c AS checksum_written, n AS rows_read, c AS checksum_read FROM sums""",
    "amount_percentiles": _q(AMOUNT_CTES + "\nSELECT month, n, p80, p90 FROM amount_thr"),
    "amount_percentile_stddev": _q(AMOUNT_CTES + """
SELECT t.month, t.n, p80 AS threshold_p80, count(*) FILTER (WHERE amount >= p80) AS orders_p80,
       round(CASE WHEN count(*) FILTER (WHERE amount >= p80) < 2 THEN 0.0
                  ELSE stddev_pop(amount) FILTER (WHERE amount >= p80) END, 4) AS stddev_p80,
       p90 AS threshold_p90, count(*) FILTER (WHERE amount >= p90) AS orders_p90,
       round(CASE WHEN count(*) FILTER (WHERE amount >= p90) < 2 THEN 0.0
                  ELSE stddev_pop(amount) FILTER (WHERE amount >= p90) END, 4) AS stddev_p90
FROM amount_thr t JOIN scoped s ON s.month IS NOT DISTINCT FROM t.month
GROUP BY t.month, t.n, p80, p90"""),
    "trailing_mode_by_changes": TRAILING_SQL,
    "trailing_mode_streamed": TRAILING_SQL,
    "trailing_mode_180": trailing_sql(180) + "\nSELECT * FROM t_result",
    "trailing_changes_180": trailing_sql(180) + """,
t_islands AS (
  SELECT *, target_date - CAST(row_number() OVER (
           PARTITION BY state, top_size, size_count ORDER BY target_date) AS INTEGER) AS island
  FROM t_result
)
SELECT state, min(target_date) AS valid_from, max(target_date) AS valid_to, top_size, size_count
FROM t_islands GROUP BY state, top_size, size_count, island""",
    "style_variety": _q(VARIETY_CTES + "\nSELECT month, state, style, variety FROM sv"),
    "median_variety": MEDIAN_SQL,
    "csv_roundtrip": MEDIAN_SQL,
    "clean_sales": _q("SELECT * FROM sales"),
    "trailing_mode": TRAILING_SQL,
    "trailing_mode_window_fn": TRAILING_SQL,
    "valid_promotions": _q(PROMO_CTES + "\nSELECT * FROM valid"),
    "orders_3_valid_promos": _q(PROMO_CTES + "\nSELECT * FROM good"),
    "state_avg_amount": _q(PROMO_CTES + "\nSELECT state, round(avg_amount, 4) AS avg_amount FROM savg"),
    "cancelled_standard_base": _q(PROMO_CTES + "\nSELECT * FROM denom"),
    "qualification_rate": QUAL_SQL,
    "parquet_roundtrip": QUAL_SQL,
    "promo_count": _q(PCT_CTES + "\nSELECT * FROM po"),
    "promo_cdf": _q(PCT_CTES + """
SELECT sku, month, promo_count, freq,
       CAST(sum(freq) OVER (PARTITION BY sku, month ORDER BY promo_count
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cum_freq,
       CAST(sum(freq) OVER (PARTITION BY sku, month) AS BIGINT) AS n
FROM (SELECT sku, month, promo_count, count(*) AS freq FROM po GROUP BY sku, month, promo_count) f"""),
    "threshold_exact": _q(PCT_CTES + "\nSELECT sku, month, p80, p90 FROM thr"),
    "threshold_disc": _q(PCT_CTES + "\nSELECT sku, month, p80, p90 FROM thr"),
    "threshold_approx": _q(PCT_CTES + "\nSELECT sku, month, p80, p90 FROM thr"),
    "percentile_stddev": _q(PCT_CTES + "\nSELECT * FROM wide"),
    "threshold_diff": _q(DRIFT_CTES + DIFF_CTE + "\nSELECT * FROM diff"),
    "threshold_mismatch_top": _q(DRIFT_CTES + DIFF_CTE + """
SELECT * FROM diff WHERE p80_approx <> p80_exact
ORDER BY abs(p80_diff) DESC, sku, month LIMIT 20"""),
    "threshold_accuracy": _q(DRIFT_CTES + "\n" + _by_level(lambda l: f"""
SELECT '{l.upper()}' AS percentile, count(*) AS num_groups,
       count(*) FILTER (WHERE threshold_{l}_approx - threshold_{l}_exact <> 0) AS num_threshold_mismatch,
       round(avg(CASE WHEN threshold_{l}_approx - threshold_{l}_exact <> 0
                      THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END) * 100, 4) AS mismatch_rate_percent,
       round(avg(CAST(abs(threshold_{l}_approx - threshold_{l}_exact) AS DOUBLE)), 4) AS mean_abs_threshold_diff,
       CAST(max(abs(threshold_{l}_approx - threshold_{l}_exact)) AS INTEGER) AS max_abs_threshold_diff,
       CAST(min(threshold_{l}_approx - threshold_{l}_exact) AS INTEGER) AS min_signed_diff,
       CAST(max(threshold_{l}_approx - threshold_{l}_exact) AS INTEGER) AS max_signed_diff
FROM wide_d""")),
    "mismatch_union": _q(MISMATCH_CTE + "SELECT *, abs(threshold_approx - threshold_exact) "
                         "AS abs_threshold_diff FROM u"),
    "mismatch_union_top": _q(MISMATCH_CTE + """
SELECT *, abs(threshold_approx - threshold_exact) AS abs_threshold_diff FROM u
ORDER BY percentile, abs_threshold_diff DESC, sku, month LIMIT 20"""),
    "threshold_mismatch_top_p90": _q(DRIFT_CTES + DIFF_CTE + """
SELECT * FROM diff WHERE p90_approx <> p90_exact
ORDER BY abs(p90_diff) DESC, sku, month LIMIT 20"""),
    "validate_damaged": _validate_damaged_sql(),
    "histogram_stddev_p80": _stddev_histogram_sql("stddev_p80_exact"),
    "histogram_stddev_p90": _stddev_histogram_sql("stddev_p90_exact"),
    "csv_by_name": _q(CSV_CTE + """
SELECT CAST(order_id AS VARCHAR) AS order_id, order_date, status, fulfilment, courier_status,
       service_level, style, sku, size, qty, amount, state, city,
       CASE WHEN promotion_ids <> '' THEN promotion_ids END AS promotion_ids
FROM report"""),
    "csv_by_position": _q(CSV_CTE + """
SELECT upper(trim(state)) AS state, order_date AS day, count(*) AS lines,
       CAST(sum(qty) AS BIGINT) AS qty
FROM report WHERE order_date IS NOT NULL AND qty > 0 GROUP BY ALL"""),
    "profile_raw": _q(CSV_CTE + """
SELECT count(*) AS total_rows, 14 AS num_columns,
       count_if(amount IS NULL AND order_id % 90 <> 0) AS empty_amount_rows,
       count_if(amount = 0) AS zero_amount_rows, count_if(order_id % 90 = 0) AS bad_amount_rows,
       count_if(sku IS NULL OR trim(sku) = '') AS empty_sku_rows,
       count_if(trim(promotion_ids) <> '') AS rows_with_promotions,
       count_if(trim(promotion_ids) <> '' AND regexp_matches(promotion_ids, '^\\s|\\s$'))
         AS promotions_with_outer_whitespace,
       count_if(order_date IS NULL) AS date_parse_errors, count_if(qty IS NULL) AS bad_qty_rows
FROM report"""),
    "key_integrity": """
SELECT 'lineitem.l_orderkey' AS foreign_key, count(*) AS rows,
       count_if(NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)) AS orphans
FROM lineitem
UNION ALL SELECT 'lineitem.l_partkey', count(*),
       count_if(NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)) FROM lineitem
UNION ALL SELECT 'orders.o_custkey', count(*),
       count_if(NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)) FROM orders
UNION ALL SELECT 'customer.c_nationkey', count(*),
       count_if(NOT EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey)) FROM customer""",
    "runtime_from_text": "WITH " + EVENT_CTES.strip() + """
SELECT method, runs, round(mean_ms, 2) AS mean_ms, round(std_ms_population, 2) AS std_ms_population,
       min_ms, max_ms, round(mean_ms / 1000, 2) AS mean_seconds,
       round(mean_ms / (SELECT mean_ms FROM per WHERE method = 'click'), 2) AS relative_to_baseline
FROM per""",
    "json_run_log": "WITH " + EVENT_CTES.strip() + """
SELECT 'events' AS task, method, run, ms / 1000 AS runtime_seconds FROM ev""",
    "result_drift": _q(DRIFT_CTES + "\n" + _by_level(lambda l: f"""
SELECT '{l.upper()}' AS percentile, sku, month,
       orders_{l}_approx AS orders_approx, orders_{l}_exact AS orders_exact,
       round(stddev_{l}_approx, 4) AS stddev_approx, round(stddev_{l}_exact, 4) AS stddev_exact
FROM wide_d
WHERE orders_{l}_approx <> orders_{l}_exact
   OR round(stddev_{l}_approx, 6) <> round(stddev_{l}_exact, 6)""")),
    "qualifying_diff_summary": _q(DRIFT_CTES + "\n" + _by_level(lambda l: f"""
SELECT '{l.upper()}' AS percentile,
       count(*) FILTER (WHERE orders_{l}_approx - orders_{l}_exact <> 0) AS groups_with_different_qualifying_count,
       round(avg(CAST(abs(orders_{l}_approx - orders_{l}_exact) AS DOUBLE)), 4) AS mean_abs_qualifying_count_diff,
       CAST(max(abs(orders_{l}_approx - orders_{l}_exact)) AS BIGINT) AS max_abs_qualifying_count_diff,
       count(*) FILTER (WHERE abs(stddev_{l}_approx - stddev_{l}_exact) > 1e-9) AS groups_with_different_stddev,
       round(avg(abs(stddev_{l}_approx - stddev_{l}_exact)), 4) AS mean_abs_stddev_diff,
       round(max(abs(stddev_{l}_approx - stddev_{l}_exact)), 4) AS max_abs_stddev_diff
FROM wide_d""")),
    "heavy_groups": _q(PCT_CTES + """
SELECT sku, month, count(*) AS total_orders FROM po GROUP BY sku, month
HAVING count(*) > 5"""),
    "heavy_months": _q(PCT_CTES + """
SELECT month, count(*) AS total_orders FROM po GROUP BY month HAVING count(*) > 1000"""),
    "top_groups": _q(PCT_CTES + """
SELECT sku, month, count(*) AS total_orders FROM po GROUP BY sku, month
ORDER BY total_orders DESC, sku, month LIMIT 10"""),
    "validate_result": _validate_sql(),
    "zero_breakdown": _zero_sql(),
    "overview": _q(PCT_CTES + """
SELECT count(*) AS num_sku_month_groups, count(DISTINCT sku) AS num_unique_sku,
       array_to_string(list_sort(list_distinct(list(month))), ',') AS months,
       CAST(sum(total_orders) AS BIGINT) AS sum_total_orders_across_groups,
       min(total_orders) AS min_orders_per_group,
       CAST(median(total_orders) AS DOUBLE) AS median_orders_per_group,
       round(avg(total_orders), 4) AS mean_orders_per_group,
       max(total_orders) AS max_orders_per_group
FROM wide_raw"""),
    "histogram": _q(PCT_CTES + """,
mm AS (SELECT CAST(min(total_orders) AS DOUBLE) AS mn, CAST(max(total_orders) AS DOUBLE) AS mx FROM wide_raw),
hb AS (
  SELECT CASE WHEN mx - mn = 0 THEN 1
              ELSE least(CAST(floor((CAST(total_orders AS DOUBLE) - mn) * 50 / (mx - mn)) AS INTEGER) + 1, 50)
         END AS bin, mn, mx
  FROM wide_raw, mm WHERE total_orders IS NOT NULL
)
SELECT bin, round(mn + (bin - 1) * (mx - mn) / 50, 4) AS bin_lower,
       round(mn + bin * (mx - mn) / 50, 4) AS bin_upper, count(*) AS count
FROM hb GROUP BY bin, mn, mx"""),
    "profile_summary": _q("""
x AS (SELECT 1)
SELECT count(*) AS total_rows, CAST(14 AS INTEGER) AS num_columns,
       count(*) FILTER (WHERE amount IS NULL) AS empty_amount_rows,
       count(*) FILTER (WHERE amount = 0) AS zero_amount_rows,
       count(*) FILTER (WHERE sku IS NULL OR trim(sku) = '') AS empty_sku_rows,
       count(*) FILTER (WHERE promotion_ids IS NOT NULL AND trim(promotion_ids) <> '') AS rows_with_promotions,
       count(*) FILTER (WHERE promotion_ids IS NOT NULL AND trim(promotion_ids) <> ''
                        AND regexp_matches(promotion_ids, '^\\s|\\s$')) AS promotions_with_outer_whitespace,
       (SELECT count(*) FROM (SELECT DISTINCT trim(sku), month(order_date) FROM sales
                              WHERE order_date IS NOT NULL AND sku IS NOT NULL)) AS sku_month_groups,
       count(*) FILTER (WHERE order_date IS NULL) AS date_parse_errors
FROM sales"""),
    "promo_distribution": _q("""
pd AS (
  SELECT CAST(CASE WHEN promotion_ids IS NULL OR trim(promotion_ids) = '' THEN 0
              ELSE len(list_filter(string_split(trim(promotion_ids), ','), lambda t: trim(t) <> '')) END
         AS INTEGER) AS promo_count
  FROM sales
)
SELECT promo_count, count(*) AS rows FROM pd GROUP BY promo_count"""),
    "date_format_classes": _q("""
dt AS (SELECT CASE WHEN order_id % 50 = 0 THEN 'not a date' WHEN order_id % 50 = 1 THEN ''
                   ELSE strftime(order_date, '%m-%d-%y') END AS d FROM sales)
SELECT CASE WHEN d = '' THEN 'EMPTY'
            WHEN length(d) = 8 AND substring(d, 3, 1) = '-' AND substring(d, 6, 1) = '-' THEN 'MM-DD-YY'
            ELSE 'OTHER:' || substring(d, 1, 10) END AS date_format,
       count(*) AS rows
FROM dt GROUP BY 1"""),
    "sample_rows": SAMPLE_SQL,
    "runtime_pivot": "WITH " + EVENT_CTES.strip() + """
SELECT run,
       max(ms) FILTER (WHERE method = 'click') AS click_ms,
       max(ms) FILTER (WHERE method = 'purchase') AS purchase_ms,
       max(ms) FILTER (WHERE method = 'signup') AS signup_ms,
       max(ms) FILTER (WHERE method = 'view') AS view_ms
FROM ev GROUP BY run""",
    "runtime_summary": "WITH " + EVENT_CTES.strip() + """
SELECT method, runs, round(mean_ms, 2) AS mean_ms, round(std_ms_population, 2) AS std_ms_population,
       min_ms, max_ms, round(mean_ms / 1000, 2) AS mean_seconds,
       round(mean_ms / (SELECT mean_ms FROM per WHERE method = 'click'), 2) AS relative_to_baseline
FROM per""",
    "run_stats": "WITH " + EVENT_CTES.strip() + "\nSELECT * FROM stats",
    "json_roundtrip": "WITH " + EVENT_CTES.strip() + "\nSELECT * FROM stats",
    "largest_groups": _q(PCT_CTES + """
SELECT sku, month, total_orders, threshold_p80_exact, orders_p80_exact,
       round(stddev_p80_exact, 4) AS stddev_p80_exact, threshold_p90_exact, orders_p90_exact,
       round(stddev_p90_exact, 4) AS stddev_p90_exact
FROM wide_raw ORDER BY total_orders DESC, sku, month LIMIT 10"""),
    "diff_groups": _q(DRIFT_CTES + "\n" + _by_level(lambda l: f"""
SELECT '{l.upper()}' AS percentile, sku, month, total_orders,
       threshold_{l}_approx AS threshold_approx, threshold_{l}_exact AS threshold_exact,
       orders_{l}_approx AS orders_approx, orders_{l}_exact AS orders_exact,
       round(stddev_{l}_approx, 4) AS stddev_approx, round(stddev_{l}_exact, 4) AS stddev_exact,
       orders_{l}_approx - orders_{l}_exact AS qualifying_count_diff,
       round(stddev_{l}_approx - stddev_{l}_exact, 4) AS stddev_diff
FROM wide_d
WHERE orders_{l}_approx - orders_{l}_exact <> 0
   OR abs(stddev_{l}_approx - stddev_{l}_exact) > 1e-9""")),
    "percentile_stddev_parquet": _q(PCT_CTES + "\nSELECT * FROM wide"),
    "run_numbers": """
SELECT CAST(row_number() OVER (ORDER BY event_id) AS BIGINT) AS run,
       CAST(printf('%.2f', "value") AS DOUBLE) AS runtime_seconds
FROM events""",
    "trailing_mode_csv": _q(TRAILING_CTES + """
SELECT state AS "State", strftime(target_date, '%m-%d-%y') AS "TargetDate",
       size AS "MostBoughtSize", CAST(cnt AS BIGINT) AS "Count"
FROM t_ranked WHERE rn = 1"""),
}
