"""For each query whose result SQL can state: that SQL, for DuckDB.

Written from the definitions, not from the Spark plans: plain windows, plain
``quantile_cont`` and plain ``count(distinct …)``.
"""

from __future__ import annotations

import re

TX = """
SELECT o_custkey AS customer_id, l_orderkey AS order_id,
  concat(p_name, ' #', cast(p_partkey AS varchar)) AS product_name,
  p_type AS category_name, p_brand AS department_name,
  c_mktsegment AS customer_segment, r_name AS market,
  n_name AS order_region, n_name AS order_country,
  o_orderpriority AS shipping_mode, o_orderstatus AS order_status,
  l_linestatus AS delivery_status,
  o_orderdate AS order_date, l_shipdate AS ship_date,
  l_quantity AS quantity, l_extendedprice / l_quantity AS unit_price,
  l_extendedprice * l_discount AS discount_amount, l_discount AS discount_rate,
  l_extendedprice AS sales,
  l_extendedprice * (1 - l_discount) AS order_item_total,
  l_extendedprice * (1 - l_discount) - cast(1.75 AS double) * l_quantity * p_retailprice AS profit,
  (l_extendedprice * (1 - l_discount) - cast(1.75 AS double) * l_quantity * p_retailprice)
    / (l_extendedprice * (1 - l_discount)) AS profit_ratio,
  l_extendedprice * (1 - l_discount) - cast(1.75 AS double) * l_quantity * p_retailprice AS benefit_per_order,
  cast(n_nationkey * 5 - 60 AS double) AS latitude,
  cast(n_nationkey * 14 - 170 AS double) AS longitude,
  CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 4 ELSE 7 END
    AS scheduled_days,
  CASE WHEN l_shipdate > o_orderdate + INTERVAL '30' DAY THEN 1 ELSE 0 END AS late_delivery_risk
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""

FILTERS = {
    "category_name": "category_name < 'M'",
    "customer_segment": "customer_segment IN ('BUILDING', 'MACHINERY')",
    "market": "market IN ('ASIA', 'EUROPE')",
}
SUBSETS = [[d for i, d in enumerate(FILTERS) if chosen >> i & 1] for chosen in range(8)]

FAULTY_COLUMNS = """customer_id, order_id, product_name, quantity, unit_price, discount_amount,
  discount_rate, order_item_total, sales, profit, ship_date"""

COMMON = {
    "tx": TX,
    "faulty_once": f"""
        SELECT {FAULTY_COLUMNS} FROM (
          SELECT * REPLACE (
            CASE WHEN quantity <> 49 THEN sales END AS sales,
            order_item_total + CASE WHEN quantity = 48 THEN 1.0 ELSE 0.0 END AS order_item_total)
          FROM tx)""",
    "faulty": "SELECT * FROM faulty_once UNION ALL SELECT * FROM faulty_once WHERE quantity = 50",
    "fitting": """
        SELECT *, coalesce(abs(order_item_total - (unit_price * quantity - discount_amount)) <= 0.05, false) AS ok
        FROM faulty""",
    "customers": """
        SELECT customer_id, MONEY(sales) AS total_sales, MONEY(profit) AS total_profit,
          fsum(discount_rate) / count(discount_rate) AS avg_discount,
          count(DISTINCT order_id) AS order_count,
          fsum(profit_ratio) / count(profit_ratio) AS avg_profit_ratio
        FROM tx GROUP BY customer_id""",
    "segment_modes": """
        SELECT customer_id, customer_segment FROM (
          SELECT customer_id, customer_segment,
            row_number() OVER (PARTITION BY customer_id ORDER BY count(*) DESC, customer_segment) AS rn
          FROM tx GROUP BY customer_id, customer_segment) WHERE rn = 1""",
    "products": """
        SELECT product_name, MONEY(sales) AS total_sales, MONEY(profit) AS total_profit,
          MONEY(quantity) AS units_sold,
          fsum(discount_rate) / count(discount_rate) AS avg_discount,
          CASE WHEN sum(quantity) > 0 THEN MONEY(profit) / MONEY(quantity) ELSE 0 END
            AS profit_per_unit
        FROM tx GROUP BY product_name""",
    "markets": """
        SELECT market, MONEY(sales) AS total_sales, MONEY(profit) AS total_profit,
          count(sales) AS order_count, MONEY(profit) / MONEY(sales) * 100 AS profit_margin_pct
        FROM tx GROUP BY market""",
    "regions": """
        SELECT order_region, MONEY(sales) AS total_sales, MONEY(profit) AS total_profit,
          count(sales) AS order_count, MONEY(profit) / MONEY(sales) * 100 AS profit_margin_pct
        FROM tx GROUP BY order_region""",
    "months": """
        SELECT strftime(order_date, '%Y-%m') AS month, MONEY(sales) AS monthly_revenue,
          MONEY(profit) AS monthly_profit, count(sales) AS order_count
        FROM tx WHERE order_date IS NOT NULL GROUP BY 1""",
    "categories": """
        SELECT category_name, MONEY(sales) AS total_sales, MONEY(profit) AS total_profit,
          fsum(profit_ratio) / count(profit_ratio) AS avg_profit_ratio,
          MONEY(quantity) AS units_sold, count(sales) AS volume
        FROM tx GROUP BY category_name""",
    "health": """
        SELECT category_name, total_sales AS total_revenue, total_profit, avg_profit_ratio, volume,
          round(0.6 * (avg_profit_ratio - min(avg_profit_ratio) OVER ())
                / (max(avg_profit_ratio) OVER () - min(avg_profit_ratio) OVER () + 1e-9)
              + 0.4 * (volume - min(volume) OVER ()) / (max(volume) OVER () - min(volume) OVER () + 1e-9), 4)
            AS health_score
        FROM categories""",
    "elasticity": """
        SELECT customer_segment, corr(discount_rate, profit) AS discount_profit_correlation
        FROM tx GROUP BY customer_segment""",
    "sums": """
        SELECT MONEY(sales) AS revenue, MONEY(profit) AS profit,
          MONEY(CASE WHEN discount_rate = 0 THEN sales END) AS revenue0,
          MONEY(CASE WHEN discount_rate = 0 THEN profit END) AS profit0,
          MONEY(benefit_per_order) AS benefit,
          count(DISTINCT customer_id) AS customers, count(DISTINCT order_id) AS orders FROM tx""",
    "category_margin": """
        SELECT fsum(m) / count(m) * 100 AS average FROM (
          SELECT fsum(profit_ratio) / count(profit_ratio) AS m FROM tx GROUP BY category_name)""",
    "kpis": """
        SELECT round(revenue, 2) AS total_revenue,
          round(profit, 2) AS total_profit,
          round(profit / revenue * 100, 4) AS profit_margin_pct,
          round(profit0 / revenue0 * 100, 4) AS margin_zero_discount_pct,
          round(profit0 / revenue0 * 100 - profit / revenue * 100, 4) AS discount_impact_ratio_pct,
          round(average, 4) AS average_category_margin_pct,
          round(revenue / orders, 2) AS average_order_value,
          customers AS n_unique_customers, orders AS n_orders,
          benefit AS benefit_per_order_total, round(benefit - profit, 2) AS benefit_vs_profit_delta
        FROM sums, category_margin""",
    "rfm_dated": """
        SELECT customer_id, cast(floor(epoch(max(max(order_date)) OVER () - max(order_date)) / 86400) AS bigint) AS recency,
          count(DISTINCT order_id) AS frequency, MONEY(sales) AS monetary
        FROM tx GROUP BY customer_id""",
    "rfm_edges": """
        SELECT quantile_cont(recency, [0, .25, .5, .75, 1]) AS r, quantile_cont(frequency, [0, .25, .5, .75, 1]) AS f,
          quantile_cont(monetary, [0, .25, .5, .75, 1]) AS m FROM rfm_dated""",
    "rfm_scored": """
        SELECT customer_id, recency, frequency, monetary,
          CASE WHEN len(list_distinct(r)) < 5 THEN 2 WHEN recency <= r[2] THEN 4 WHEN recency <= r[3] THEN 3
            WHEN recency <= r[4] THEN 2 ELSE 1 END AS recency_score,
          CASE WHEN len(list_distinct(f)) < 5 THEN 2 WHEN frequency <= f[2] THEN 1 WHEN frequency <= f[3] THEN 2
            WHEN frequency <= f[4] THEN 3 ELSE 4 END AS frequency_score,
          CASE WHEN len(list_distinct(m)) < 5 THEN 2 WHEN monetary <= m[2] THEN 1 WHEN monetary <= m[3] THEN 2
            WHEN monetary <= m[4] THEN 3 ELSE 4 END AS monetary_score
        FROM rfm_dated, rfm_edges""",
    "rfm": """
        SELECT *, CASE WHEN rfm_total >= 10 THEN 'Champions' WHEN rfm_total >= 8 THEN 'Loyal'
          WHEN rfm_total >= 6 THEN 'Potential Loyalist' WHEN rfm_total >= 4 THEN 'At Risk' ELSE 'Lost' END AS rfm_segment
        FROM (SELECT *, recency_score + frequency_score + monetary_score AS rfm_total FROM rfm_scored)""",
    "matrix": """
        SELECT customer_id, total_sales, total_profit,
          CASE WHEN total_sales >= q AND total_profit > 0 THEN 'VIP (High Value)'
            WHEN total_sales >= q AND total_profit <= 0 THEN 'Bleeder (High Vol, Loss)'
            WHEN total_sales < q AND total_profit <= 0 THEN 'Low Value (Drain)' ELSE 'Standard' END AS segment_class
        FROM customers, (SELECT quantile_cont(total_sales, 0.75) AS q FROM customers)""",
    "rated": """
        SELECT *, CASE WHEN total_sales > 0 THEN total_profit / total_sales ELSE 0 END AS margin,
          profit_per_unit AS profit_density,
          units_sold / (SELECT MONEY(units_sold) FROM products) AS volume_contribution
        FROM products""",
    "efficient": """
        SELECT *,
          0.4 * (margin - min(margin) OVER ()) / (max(margin) OVER () - min(margin) OVER ())
          + 0.3 * (profit_density - min(profit_density) OVER ())
              / (max(profit_density) OVER () - min(profit_density) OVER ())
          + 0.3 * (volume_contribution - min(volume_contribution) OVER ())
              / (max(volume_contribution) OVER () - min(volume_contribution) OVER ()) AS product_efficiency_index
        FROM rated""",
    "pareto": """
        SELECT customer_id, total_profit, row_number() OVER w AS customer_rank,
          sum(total_profit) OVER w AS cumulative_profit,
          sum(total_profit) OVER w
            / sum(total_profit) OVER () AS cumulative_pct
        FROM customers WHERE total_profit > 0
        WINDOW w AS (ORDER BY total_profit DESC, md5(cast(customer_id AS varchar)) ROWS UNBOUNDED PRECEDING)""",
    "abc_shares": """
        SELECT product_name, total_profit,
          sum(total_profit) OVER (ORDER BY total_profit DESC, md5(product_name) ROWS UNBOUNDED PRECEDING)
            / sum(total_profit) OVER () AS cumulative_profit_pct FROM products""",
    "abc": """
        SELECT *, CASE WHEN cumulative_profit_pct <= 0.70 THEN 'A (Top 70%)'
          WHEN cumulative_profit_pct <= 0.90 THEN 'B (70–90%)' ELSE 'C (Bottom 10%)' END AS abc_class FROM abc_shares""",
    "nodes": """
        SELECT latitude, longitude, order_country, MONEY(profit) AS total_profit,
          MONEY(sales) AS total_sales, count(sales) AS order_count,
          CASE WHEN MONEY(profit) >= 0 THEN 'Profitable' ELSE 'Loss-Making' END AS profit_status
        FROM tx GROUP BY latitude, longitude, order_country""",
    "late_days": """
        SELECT *, cast(floor(epoch(ship_date - order_date) / 86400) AS bigint) AS delivery_delay_days,
          cast(floor(epoch(ship_date - order_date) / 86400) AS bigint) - scheduled_days AS delivery_overrun_days
        FROM tx""",
    "selected": """
        SELECT * FROM tx WHERE customer_segment IN ('BUILDING', 'MACHINERY') AND market IN ('ASIA', 'EUROPE')""",
    "risky": """
        SELECT *, round(CASE WHEN profit < 0 THEN 0.5 ELSE 0.0 END + discount_rate * 5, 6) AS risk_score FROM tx""",
    "ltv": """
        SELECT *, round(order_count / (order_count + 10), 6) AS ltv_score FROM customers""",
    "modes": """
        SELECT customer_id, column_name, value FROM (
          SELECT customer_id, column_name, value,
            row_number() OVER (PARTITION BY customer_id, column_name ORDER BY count(*) DESC, value) AS rn
          FROM (SELECT customer_id, customer_segment, shipping_mode, category_name, market, order_region FROM tx)
          UNPIVOT (value FOR column_name IN (customer_segment, shipping_mode, category_name, market, order_region))
          GROUP BY customer_id, column_name, value) WHERE rn = 1""",
    "wide_modes": """
        SELECT customer_id, max(value) FILTER (column_name = 'customer_segment') AS customer_segment,
          max(value) FILTER (column_name = 'shipping_mode') AS shipping_mode,
          max(value) FILTER (column_name = 'category_name') AS category_name,
          max(value) FILTER (column_name = 'market') AS market,
          max(value) FILTER (column_name = 'order_region') AS order_region
        FROM modes GROUP BY customer_id""",
    "ltv_table": """
        SELECT customer_id, total_sales, avg_discount, cast(order_count AS double) AS order_count,
          customer_segment, market, order_region,
          CASE WHEN total_sales >= (SELECT quantile_cont(total_sales, 0.75) FROM customers) THEN 1 ELSE 0 END AS label
        FROM customers JOIN wide_modes USING (customer_id)""",
    "clv": """
        SELECT customer_id, total_sales AS total_revenue, total_profit, order_count, avg_discount,
          total_profit * (1 + ln(1 + order_count)) AS clv_score, order_count <= 3 AS churn_risk
        FROM customers""",
    "churn_strengths": " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, abs(auc - 0.5) AS strength FROM (SELECT (sum(CASE WHEN churn_risk THEN rnk ELSE 0 END) - p * (p + 1) / 2.0::double)
          / (p::double * (n - p)) AS auc FROM (
            SELECT churn_risk, rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0::double AS rnk,
              count(*) FILTER (churn_risk) OVER () AS p, count(*) OVER () AS n FROM clv) GROUP BY p, n)"""
        for c in ("total_revenue", "total_profit", "order_count", "avg_discount", "clv_score")
    ),
    "best_feature": """
        SELECT feature, strength, (SELECT count(*) > 50 AND count(*) FILTER (churn_risk) BETWEEN 10 AND count(*) - 1 FROM clv) AS fitted
        FROM churn_strengths ORDER BY strength DESC, feature LIMIT 1""",
    "fold_aucs": """
        SELECT trial, fold, (sum(CASE WHEN label = 1 THEN rnk ELSE 0 END) - p * (p + 1) / 2.0::double) / (p::double * (n - p)) AS auc
        FROM (SELECT trial, fold, label,
            rank() OVER (PARTITION BY trial, fold ORDER BY score) + (count(*) OVER (PARTITION BY trial, fold, score) - 1) / 2.0::double AS rnk,
            sum(label) OVER (PARTITION BY trial, fold) AS p, count(*) OVER (PARTITION BY trial, fold) AS n
          FROM (SELECT cast(trial AS int) AS trial, cast(order_id % 5 AS int) AS fold, CASE WHEN profit < 0 THEN 1 ELSE 0 END AS label,
              (trial * 5 % 12) * 1000 * discount_rate - unit_price AS score FROM tx, range(12) AS t(trial)))
        GROUP BY trial, fold, p, n""",
    "distinct_rows": "SELECT *, count(*) AS copies FROM faulty GROUP BY ALL",
    "tagged": """
        SELECT *, sales IS NOT NULL AND profit IS NOT NULL AND customer_id IS NOT NULL AS complete,
          coalesce(abs(order_item_total - (unit_price * quantity - discount_amount)) <= 0.05, false) AS ok
        FROM distinct_rows""",
    "tagged_stats": """
        SELECT avg(sales) AS ms, stddev_pop(sales) AS ds, avg(profit) AS mp, stddev_pop(profit) AS dp,
          avg(discount_amount) AS md, stddev_pop(discount_amount) AS dd FROM tagged WHERE complete AND ok""",
    "judged": """
        SELECT tagged.*, abs((sales - ms) / ds) < 3 AND abs((profit - mp) / dp) < 3
          AND abs((discount_amount - md) / dd) < 3 AS usual FROM tagged, tagged_stats""",
}


def _needed(body: str) -> list[str]:
    """The common tables a text mentions, with those they mention, in definition order."""
    used: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for name in re.findall(r"\b\w+\b", text):
            if name in COMMON and name not in used:
                used.add(name)
                todo.append(COMMON[name])
    return [name for name in COMMON if name in used]


def _money_sums(text: str) -> str:
    """Write out ``MONEY(x)``: the sum of x, 0 without values."""
    while (start := text.find("MONEY(")) >= 0:
        end, depth = start + len("MONEY("), 1
        while depth:
            depth += {"(": 1, ")": -1}.get(text[end], 0)
            end += 1
        value = text[start + len("MONEY(") : end - 1]
        text = f"{text[:start]}coalesce(fsum({value}), 0){text[end:]}"
    return text


def _with_common(body: str) -> str:
    tables = ",\n".join(f"{name} AS ({COMMON[name]})" for name in _needed(body))
    return _money_sums(f"WITH {tables}\n{body.strip()}" if tables else body.strip())


def _kept(source: str, condition: str = "true") -> str:
    return f"""SELECT count(*) AS rows, cast(coalesce(sum(order_id % 1000003), 0) AS bigint) AS order_id_sum,
      MONEY(sales) AS sales_sum, MONEY(profit) AS profit_sum,
      MONEY(discount_amount) AS discount_sum FROM {source} WHERE {condition}"""


def _zscore(limit: float) -> str:
    return f"""abs((sales - ms) / ds) < {limit} AND abs((profit - mp) / dp) < {limit}
      AND abs((discount_amount - md) / dd) < {limit}"""


STATS = """(SELECT avg(sales) AS ms, stddev_pop(sales) AS ds, avg(profit) AS mp, stddev_pop(profit) AS dp,
  avg(discount_amount) AS md, stddev_pop(discount_amount) AS dd FROM tx)"""
QUARTILES = """(SELECT quantile_cont(sales, [.25, .75]) AS qs, quantile_cont(profit, [.25, .75]) AS qp,
  quantile_cont(discount_amount, [.25, .75]) AS qd FROM tx)"""


TAILED = """(SELECT * REPLACE ((sales / 10000) * (sales / 10000) * (sales / 10000) * (sales / 10000) * (sales / 10000)
  * (sales / 10000) AS sales) FROM tx)"""


def _iqr(factor: float) -> str:
    return " AND ".join(
        f"{c} BETWEEN {q}[1] - ({q}[2] - {q}[1]) * {factor} AND {q}[2] + ({q}[2] - {q}[1]) * {factor}"
        for c, q in (("sales", "qs"), ("profit", "qp"), ("discount_amount", "qd"))
    )


def _whatif(cap: float) -> str:
    return f"""
      SELECT current_profit, n AS breaching_orders, n / orders * 100 AS breach_pct, recovered,
        current_profit + recovered AS simulated_profit,
        recovered / greatest(abs(current_profit), 1.0) * 100 AS recovery_rate_pct
      FROM (SELECT MONEY(profit) AS current_profit, count(*) AS orders,
        count(*) FILTER (discount_rate > {cap}) AS n,
        MONEY(CASE WHEN discount_rate > {cap}::double THEN sales * (discount_rate - {cap}::double) END) AS recovered
        FROM tx)"""


def _caps(caps: tuple[float, ...], current: float) -> str:
    values = ", ".join(f"({c}::double)" for c in caps)
    return f"""
      SELECT cap, count(*) FILTER (discount_rate > cap) AS breaching_orders,
        count(*) FILTER (discount_rate > cap) / count(*) * 100 AS affected_pct,
        MONEY(CASE WHEN discount_rate > cap THEN sales * (discount_rate - cap) END) AS estimated_recovery,
        abs(cap - {current}) < 0.005 AS is_current_policy
      FROM tx, (VALUES {values}) AS c(cap) GROUP BY cap"""


def _histogram(source: str, value: str, bins: int) -> str:
    return f"""
      SELECT bin, low + bin * width AS bin_low, low + (bin + 1) * width AS bin_high, count(*) AS orders
      FROM (SELECT cast(least(floor((v - low) / width), {bins - 1}) AS bigint) AS bin, low, width
        FROM (SELECT v, min(v) OVER () AS low, (max(v) OVER () - min(v) OVER ()) / {bins}.0::double AS width
          FROM (SELECT {value} AS v FROM {source})))
      GROUP BY bin, low, width"""


def _auc(source: str, score: str, label: str) -> str:
    """Mann-Whitney form, from ranks with ties at their mean."""
    return f"""
      SELECT (sum(CASE WHEN {label} = 1 THEN rnk ELSE 0 END) - p * (p + 1) / 2.0::double)
          / (p::double * (n - p)) AS auc
      FROM (SELECT {label}, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2.0::double AS rnk,
        sum({label}) OVER () AS p, count(*) OVER () AS n FROM {source})
      GROUP BY p, n"""


def _hash(seed: int) -> str:
    """The row hash: the first 13 hexadecimal digits of the md5 of the row's identity, as a share of 1."""
    identity = ", ".join(
        f"cast({c} AS varchar)"
        for c in ("customer_id", "order_id", "product_name", "order_date", "ship_date", "quantity", "sales", "discount_rate")
    )
    return f"cast('0x' || substr(md5(concat_ws('|', {identity}, '{seed}')), 1, 13) AS bigint) / 4503599627370496.0::double"


SAMPLE = f"(SELECT *, {_hash(42)} AS h FROM tx ORDER BY h LIMIT 15000)"
BANDED = """CASE WHEN profit_ratio <= 0 THEN 'Loss' WHEN profit_ratio <= 0.10 THEN 'Thin (<10%)'
  WHEN profit_ratio <= 0.25 THEN 'Healthy (10-25%)' ELSE 'Star (>25%)' END"""

ENCODED = ("shipping_mode", "market", "customer_segment", "category_name", "order_status", "department_name")

BODIES: dict[str, str] = {
    # sources and sinks
    "csv_scan": """SELECT customer_id, order_id, product_name, market,
        strftime(order_date, '%Y-%m-%d %H:%M:%S') AS order_date,
        quantity, sales, profit, discount_rate, late_delivery_risk FROM tx""",
    "csv_encodings": """SELECT product_name || ' é Übergröße ñ' AS product_name, count(*) AS rows, MONEY(sales) AS total_sales
        FROM tx GROUP BY 1""",
    "orphan_keys": " UNION ALL ".join(
        f"SELECT '{name}.{key}' AS link, count(*) AS rows FROM {name} WHERE {key} NOT IN (SELECT {own} FROM {lookup})"
        for name, key, lookup, own in (
            ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "part", "p_partkey"),
            ("orders", "o_custkey", "customer", "c_custkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
            ("nation", "n_regionkey", "region", "r_regionkey"),
        )
    ),
    "normalise_columns": """SELECT customer_id, MONEY(benefit_per_order) AS benefit_per_order,
        MONEY(profit) AS profit FROM tx GROUP BY customer_id""",
    "typed_transactions": """SELECT order_id, CASE WHEN quantity NOT IN (48, 49) THEN quantity END AS quantity, sales,
        CASE WHEN late_delivery_risk = 1 THEN 1.0::double END AS late_delivery_risk, market FROM tx""",
    "parquet_roundtrip": "SELECT * FROM markets",
    "narrow_floats": """SELECT order_id, cast(cast(sales AS float) AS double) AS sales,
        cast(cast(profit AS float) AS double) AS profit FROM tx""",
    "view_catalog": """SELECT 'market_agg' AS view_name, market AS key, total_sales, order_count FROM markets
        UNION ALL SELECT 'shipping_agg', shipping_mode, MONEY(sales), count(*) FROM tx GROUP BY shipping_mode""",
    "sql_query": """SELECT market, count(*) AS orders, MONEY(sales) AS total_sales FROM tx
        WHERE sales > 1000 AND customer_segment = 'BUILDING' GROUP BY market""",
    "preview": """SELECT customer_id, order_id, product_name, sales, discount_rate, profit FROM tx
        ORDER BY customer_id, order_id, product_name, sales, discount_rate, profit LIMIT 100""",
    # cleaning
    "dedup_rows": _kept("(SELECT DISTINCT * FROM faulty)"),
    "drop_missing": _kept("faulty", "sales IS NOT NULL AND profit IS NOT NULL AND customer_id IS NOT NULL"),
    "normalise_text": """SELECT c_custkey AS customer_id, upper(trim(c_name)) AS customer_city FROM customer""",
    "parse_dates": """SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 10 = 0 THEN NULL
        WHEN o_orderkey % 10 = 1 THEN strftime(date_trunc('minute', o_orderdate), '%Y-%m-%d %H:%M:%S')
        ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_date FROM orders""",
    "financial_validation": """SELECT ok AS finval_ok, count(*) AS rows, cast(coalesce(sum(order_id % 1000003), 0) AS bigint) AS order_id_sum
        FROM fitting GROUP BY ok""",
    "financial_filter": _kept("fitting", "ok"),
    "outliers_zscore": _kept(f"tx, {STATS}", _zscore(3)),
    "outliers_iqr": _kept(f"tx, {QUARTILES}", _iqr(1.5)),
    "outliers_iqr_default": _kept(f"{TAILED}, {QUARTILES.replace('FROM tx', f'FROM {TAILED}')}", _iqr(3)),
    "outliers_adaptive": _kept(
        f"tx, {STATS}, {QUARTILES}, (SELECT 1 - avg(CASE WHEN {_zscore(3)} THEN 1 ELSE 0 END) AS removed FROM tx, {STATS})",
        f"CASE WHEN removed > 0.05 THEN {_iqr(3)} ELSE {_zscore(3)} END",
    ),
    "outliers_adaptive_iqr": _kept(
        f"tx, {STATS}, {QUARTILES}, (SELECT 1 - avg(CASE WHEN {_zscore(2)} THEN 1 ELSE 0 END) AS removed FROM tx, {STATS})",
        f"CASE WHEN removed > 0.05 THEN {_iqr(1)} ELSE {_zscore(2)} END",
    ),
    "cleaning_report": """SELECT cast(sum(copies) AS bigint) AS initial_rows, cast(11 AS bigint) AS initial_cols,
        cast(sum(copies) - count(*) AS bigint) AS dropped_duplicates,
        count(*) FILTER (NOT complete) AS dropped_missing,
        count(*) FILTER (complete AND NOT ok) AS financial_mismatches,
        count(*) FILTER (complete AND ok AND NOT usual) AS outliers_removed,
        CASE WHEN count(*) FILTER (complete AND ok AND NOT usual) > 0.05 * count(*) FILTER (complete AND ok)
          THEN 'IQR' ELSE 'Z-score' END AS outlier_method,
        count(*) FILTER (complete AND ok AND usual) AS final_rows FROM judged""",
    "clean_transactions": _kept("judged", "complete AND ok AND usual"),
    "margin_band": """SELECT CASE WHEN profit_ratio <= 0 THEN 'Loss' WHEN profit_ratio <= 0.10 THEN 'Thin (<10%)'
        WHEN profit_ratio <= 0.25 THEN 'Healthy (10-25%)' ELSE 'Star (>25%)' END AS margin_band,
        count(*) AS orders, cast(coalesce(sum(order_id % 1000003), 0) AS bigint) AS order_id_sum FROM tx GROUP BY 1""",
    "delivery_delay": "SELECT delivery_delay_days, count(*) AS orders FROM late_days GROUP BY 1",
    "delivery_overrun": """SELECT shipping_mode, cast(sum(delivery_overrun_days) AS bigint) AS overrun_days,
        min(delivery_overrun_days) AS min_overrun, max(delivery_overrun_days) AS max_overrun
        FROM late_days GROUP BY shipping_mode""",
    "cross_filter": _kept("selected"),
    "filter_options": """SELECT 'customer_segment' AS dimension, customer_segment AS value FROM tx GROUP BY 2
        UNION ALL SELECT 'category_name', category_name FROM tx GROUP BY 2
        UNION ALL SELECT 'market', market FROM tx GROUP BY 2 ORDER BY 1, 2""",
    "policy_breach_orders": """SELECT CASE WHEN discount_rate > 0.05 THEN 'violation' ELSE 'compliant' END AS policy,
        count(*) AS orders, MONEY(profit) AS profit FROM tx GROUP BY 1""",
    "policy_breach_rows": """SELECT customer_id, order_id, product_name, sales, profit, discount_rate
        FROM tx WHERE discount_rate > 0.09""",
    "nonnegative_sales": _kept("(SELECT * REPLACE (round(sales - 1000, 4) AS sales) FROM tx)", "sales >= 0"),
    "formatted_scorecard": """SELECT market, '$' || format('{:,}', cast(round(total_sales) AS bigint)) AS total_sales,
        '$' || format('{:,}', cast(round(total_profit) AS bigint)) AS total_profit,
        format('{:,}', order_count) AS order_count,
        printf('%.2f%%', profit_margin_pct) AS profit_margin_pct FROM markets ORDER BY markets.profit_margin_pct DESC""",
    # joins
    "transactions_join": """SELECT market, customer_segment, category_name, department_name, count(*) AS items,
        MONEY(sales) AS sales, MONEY(profit) AS profit, cast(sum(late_delivery_risk) AS bigint) AS late
        FROM tx GROUP BY ALL""",
    "customer_with_segment": """SELECT customers.*,
        total_profit / order_count AS customer_value_index, customer_segment
        FROM customers LEFT JOIN segment_modes USING (customer_id)""",
    "score_lookup_join": """SELECT customer_id, total_sales, order_count, ltv_score FROM ltv WHERE ltv_score >= 0.4""",
    # aggregates
    "macro_kpis": "SELECT * FROM kpis",
    "kpi_document": "SELECT n_orders, elasticity.* FROM kpis, elasticity",
    "monthly_trend": """SELECT *,
        (monthly_revenue / nullif(lag(monthly_revenue) OVER (ORDER BY month), 0) - 1) * 100 AS mom_revenue_growth_pct,
        (monthly_profit / nullif(lag(monthly_profit) OVER (ORDER BY month), 0) - 1) * 100 AS mom_profit_growth_pct
        FROM months""",
    "customer_clv": "SELECT * FROM clv",
    "category_health": "SELECT * FROM health",
    "segment_elasticity": "SELECT * FROM elasticity",
    "customer_agg": """SELECT customers.*, total_profit / order_count AS customer_value_index, customer_segment
        FROM customers JOIN segment_modes USING (customer_id)""",
    "customer_modes": "SELECT customer_id, customer_segment, shipping_mode, category_name FROM wide_modes",
    "category_agg": """SELECT category_name, total_sales, total_profit, avg_profit_ratio, units_sold,
        total_sales / sum(total_sales) OVER () AS revenue_share,
        (total_sales / sum(total_sales) OVER ()) * (total_sales / sum(total_sales) OVER ())
          AS hhi_contribution FROM categories""",
    "product_agg": "SELECT * FROM products",
    "market_agg": "SELECT * FROM markets",
    "region_agg": "SELECT * FROM regions",
    "country_agg": "SELECT order_region AS order_country, * EXCLUDE (order_region) FROM regions",
    "places_agg": """SELECT 'market' AS dimension, market AS value, * EXCLUDE (market) FROM markets
        UNION ALL SELECT 'order_region', order_region, * EXCLUDE (order_region) FROM regions
        UNION ALL SELECT 'order_country', order_region, * EXCLUDE (order_region) FROM regions""",
    "shipping_agg": """SELECT shipping_mode, MONEY(sales) AS total_sales, MONEY(profit) AS total_profit,
        count(sales) AS order_count, cast(sum(delivery_overrun_days) AS double) / count(*) AS avg_overrun_days,
        MONEY(profit) / MONEY(sales) * 100 AS profit_margin_pct
        FROM late_days GROUP BY shipping_mode""",
    "geo_nodes": "SELECT * FROM nodes",
    "geo_summary": """SELECT greatest(abs(min(total_profit)), abs(max(total_profit))) AS color_range,
        sum(latitude) / count(*) AS center_latitude, sum(longitude) / count(*) AS center_longitude,
        count(*) AS nodes FROM nodes""",
    "geo_markers": """SELECT *, least(greatest(order_count / 10.0::double, 3.0::double), 15.0::double) AS radius,
        CASE WHEN total_profit >= 0 THEN 'green' ELSE 'red' END AS color FROM nodes""",
    "correlation_matrix": " UNION ALL ".join(
        f"SELECT '{a}' AS x, '{b}' AS y, corr({a}, {b}) AS correlation FROM tx"
        for a in ("discount_rate", "profit", "sales", "quantity", "profit_ratio")
        for b in ("discount_rate", "profit", "sales", "quantity", "profit_ratio")
    ),
    "discount_profit_correlation":
        "SELECT round(corr(discount_rate, profit), 4) AS discount_profit_correlation FROM tx",
    "profit_histogram": _histogram("tx", "profit", 60),
    "loss_histogram": _histogram("(SELECT * FROM tx WHERE profit < 0)", "profit", 30),
    "loss_order_share": """SELECT count(*) AS orders, count(*) FILTER (profit < 0) AS loss_orders,
        count(*) FILTER (profit < 0) / count(*) * 100 AS loss_share_pct,
        count(*) FILTER (profit < 0) / count(*) * 100 > 20 AS is_critical FROM tx""",
    "margin_bridge": """SELECT step_no, step, amount FROM (
        SELECT 1 AS step_no, 'Gross Revenue' AS step, total_revenue AS amount FROM kpis
        UNION ALL SELECT 2, 'Costs & COGS', -(total_revenue - total_profit
            - discount_impact_ratio_pct / 100 * total_revenue) FROM kpis
        UNION ALL SELECT 3, 'Discount Leak', -(discount_impact_ratio_pct / 100 * total_revenue) FROM kpis
        UNION ALL SELECT 4, 'Net Profit', total_profit FROM kpis)""",
    "filtered_kpis": """SELECT revenue, profit, profit / revenue * 100 AS margin_pct,
        revenue / orders AS average_order_value, customers, orders
        FROM (SELECT MONEY(sales) AS revenue, MONEY(profit) AS profit,
          count(DISTINCT customer_id) AS customers, count(DISTINCT order_id) AS orders FROM selected)""",
    "filtered_discount_leak": """SELECT revenue, profit, profit / revenue * 100 AS margin_pct,
        revenue / orders AS average_order_value, customers, orders,
        revenue * (SELECT discount_impact_ratio_pct FROM kpis) / 100 AS discount_leak
        FROM (SELECT MONEY(sales) AS revenue, MONEY(profit) AS profit,
          count(DISTINCT customer_id) AS customers, count(DISTINCT order_id) AS orders FROM selected)""",
    "cohort_retention": """SELECT cohort, months_later, customers, cohort_size, customers / cohort_size AS retention FROM (
        SELECT strftime(first_date, '%Y-%m') AS cohort, datediff('month', first_date, order_date) AS months_later,
          count(DISTINCT customer_id) AS customers FROM
          (SELECT customer_id, order_date, min(order_date) OVER (PARTITION BY customer_id) AS first_date FROM tx)
        GROUP BY 1, 2)
        JOIN (SELECT strftime(f, '%Y-%m') AS cohort, count(*) AS cohort_size
          FROM (SELECT min(order_date) AS f FROM tx GROUP BY customer_id) GROUP BY 1) USING (cohort)""",
    "rolling_trend": """SELECT month, monthly_revenue, monthly_profit,
        avg(monthly_revenue) OVER w AS rolling_revenue, avg(monthly_profit) OVER w AS rolling_profit
        FROM months WINDOW w AS (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
    "running_best": """SELECT month, monthly_revenue, max(monthly_revenue) OVER (ORDER BY month) AS best_so_far FROM months""",
    # pricing
    "discount_curve": """SELECT (b - 1) / 20.0::double AS bracket_low, b / 20.0::double AS bracket_high,
        MONEY(profit) / count(profit) AS avg_profit
        FROM (SELECT cast(ceil(round(discount_rate * 20, 6)) AS bigint) AS b, profit FROM tx
          WHERE discount_rate > 0 AND discount_rate <= 1) GROUP BY b""",
    "discount_sensitivity": """SELECT round(discount_rate * 20) / 20 AS discount_bracket, count(*) AS order_count,
        fsum(profit_ratio) / count(*) AS avg_margin, MONEY(sales) AS total_revenue
        FROM tx WHERE discount_rate <= 0.30 GROUP BY 1 ORDER BY 1""",
    "discount_buckets": """SELECT discount_bucket, bucket_no, count(profit) AS orders, MONEY(profit) AS total_profit,
        MONEY(profit) / count(profit) AS avg_profit
        FROM tx JOIN (VALUES (-0.01, 0.05, '0–5%', 1), (0.05, 0.10, '5–10%', 2), (0.10, 0.15, '10–15%', 3),
          (0.15, 0.20, '15–20%', 4), (0.20, 0.25, '20–25%', 5), (0.25, 0.30, '25–30%', 6), (0.30, 0.50, '30–50%', 7),
          (0.50, 1.00, '50%+', 8)) AS b(low, high, discount_bucket, bucket_no)
          ON round(discount_rate, 6) > low::double AND round(discount_rate, 6) <= high::double
        GROUP BY 1, 2""",
    "revenue_at_risk": """SELECT MONEY(CASE WHEN discount_rate > 0.05::double
        THEN sales * (discount_rate - 0.05::double) END) AS revenue_at_risk FROM tx""",
    "revenue_at_risk_default_cap": """SELECT MONEY(CASE WHEN discount_rate > 0.25::double
        THEN sales * (discount_rate - 0.25::double) END) AS revenue_at_risk FROM tx""",
    "discount_whatif": _whatif(0.05),
    "cap_sensitivity": _caps((0.02, 0.03, 0.04, 0.05, 0.06, 0.07, 0.08), 0.05),
    "cap_sensitivity_default_caps": _caps((0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.35, 0.40), 0.25),
    # segments
    "rfm_segments": "SELECT * FROM rfm",
    "rfm_no_dates": """SELECT *, CASE WHEN rfm_total >= 10 THEN 'Champions' WHEN rfm_total >= 8 THEN 'Loyal'
        WHEN rfm_total >= 6 THEN 'Potential Loyalist' WHEN rfm_total >= 4 THEN 'At Risk' ELSE 'Lost' END AS rfm_segment
        FROM (SELECT customer_id, frequency, monetary, frequency_score, monetary_score,
          frequency_score + monetary_score AS rfm_total FROM rfm_scored)""",
    "rfm_distribution": "SELECT rfm_segment, count(*) AS customers FROM rfm GROUP BY 1",
    "rfm_share": """SELECT rfm_segment, count(*) AS customers, count(*) / (SELECT count(*) FROM rfm) * 100 AS share_pct
        FROM rfm GROUP BY 1""",
    "customer_segmentation": "SELECT * FROM matrix",
    "segment_distribution": "SELECT segment_class, count(*) AS customers FROM matrix GROUP BY 1",
    "n_bleeders": "SELECT count(*) FILTER (segment_class LIKE 'Bleeder%') AS n_bleeders FROM matrix",
    "median_customer_sales": """SELECT count(*) AS customers, median(total_sales) AS median_sales,
        median(total_profit) AS median_profit FROM customers""",
    "customer_tier": """SELECT customer_id, total_sales, order_count,
        CASE WHEN total_sales > 5000 AND order_count >= 10 THEN 'VIP' WHEN total_sales > 1000 THEN 'Loyal'
          ELSE 'Occasional' END AS tier FROM customers""",
    "product_margin": "SELECT product_name, total_sales, total_profit, margin FROM rated",
    "product_efficiency": "SELECT * FROM efficient",
    "product_quadrants": """SELECT product_name, units_sold, margin,
        CASE WHEN units_sold >= mu AND margin >= mm THEN 'Stars (High Vol, High Margin)'
          WHEN units_sold < mu AND margin >= mm THEN 'Niche (Low Vol, High Margin)'
          WHEN units_sold >= mu AND margin < mm THEN 'Cash Cows (High Vol, Low Margin)'
          ELSE 'Dogs (Low Vol, Low Margin)' END AS quadrant
        FROM rated, (SELECT median(units_sold) AS mu, median(margin) AS mm FROM rated WHERE total_sales > 1000)
        WHERE total_sales > 1000""",
    "pareto_curve": "SELECT * FROM pareto",
    "pareto_pct": """SELECT count(*) FILTER (cumulative_pct <= 0.80) AS pareto_customers,
        round(count(*) FILTER (cumulative_pct <= 0.80) / (SELECT count(*) FROM customers) * 100, 2) AS pareto_pct FROM pareto""",
    "abc_classification": "SELECT product_name, total_profit, cumulative_profit_pct, abc_class FROM abc",
    "abc_summary": "SELECT abc_class, count(*) AS products, MONEY(total_profit) AS total_profit FROM abc GROUP BY 1",
    "abc_top_products": """SELECT abc_class, product_name, total_profit, rank::int AS rank FROM (
        SELECT *, row_number() OVER (PARTITION BY abc_class ORDER BY total_profit DESC, product_name) AS rank FROM abc)
        WHERE rank <= 3""",
    "abc_top20": "SELECT product_name, total_profit, abc_class FROM abc ORDER BY total_profit DESC, product_name LIMIT 20",
    "insights": """SELECT
        (SELECT round(MONEY(CASE WHEN discount_rate > 0.05::double THEN sales * (discount_rate - 0.05::double) END), 2)
          FROM tx) AS revenue_at_risk,
        (SELECT round(corr(discount_rate, profit), 4) FROM tx) AS discount_profit_correlation,
        (SELECT round(count(*) FILTER (cumulative_pct <= 0.80) / (SELECT count(*) FROM customers) * 100, 2) FROM pareto)
          AS pareto_pct,
        (SELECT count(*) FROM matrix WHERE segment_class LIKE 'Bleeder%') AS n_bleeders,
        (SELECT string_agg(rfm_segment || '=' || n, '; ' ORDER BY rfm_segment)
          FROM (SELECT rfm_segment, count(*) AS n FROM rfm GROUP BY 1)) AS rfm_distribution""",
    "region_margin_band": """SELECT order_region, profit_margin_pct, CASE WHEN profit_margin_pct < 10 THEN 'red'
        WHEN profit_margin_pct < 20 THEN 'amber' ELSE 'green' END AS band FROM regions""",
    "health_band": """SELECT category_name, health_score, CASE WHEN health_score * 100 < 33 THEN 'red'
        WHEN health_score * 100 < 66 THEN 'amber' ELSE 'green' END AS band FROM health""",
    "elasticity_band": """SELECT *, CASE WHEN discount_profit_correlation < -0.065 THEN 'red'
        WHEN discount_profit_correlation < -0.060 THEN 'amber' ELSE 'green' END AS band FROM elasticity""",
    # top lists
    "top_customers_profit": """SELECT customer_id, total_sales, total_profit FROM customers
        ORDER BY total_profit DESC, customer_id LIMIT 10""",
    "bottom_customers": "SELECT customer_id, total_profit FROM customers ORDER BY total_profit, customer_id LIMIT 5",
    "customer_summary": """SELECT customers.*, total_profit / order_count AS customer_value_index, customer_segment
        FROM customers JOIN segment_modes USING (customer_id) ORDER BY total_sales DESC, customer_id LIMIT 100""",
    "top_products_pei": """SELECT product_name, total_sales, product_efficiency_index FROM efficient
        WHERE total_sales > 1000 ORDER BY product_efficiency_index DESC, product_name LIMIT 10""",
    "top_categories": """SELECT category_name, total_sales, total_profit, avg_profit_ratio, units_sold,
        total_sales / sum(total_sales) OVER () AS revenue_share,
        (total_sales / sum(total_sales) OVER ()) * (total_sales / sum(total_sales) OVER ())
          AS hhi_contribution FROM categories ORDER BY total_profit DESC, category_name LIMIT 15""",
    "loss_products": """SELECT product_name, total_profit FROM products WHERE total_profit < 0
        ORDER BY total_profit, product_name LIMIT 12""",
    "loss_products_total": """SELECT count(*) AS loss_products, MONEY(total_profit) AS total_loss
        FROM products WHERE total_profit < 0""",
    "high_risk_orders": """SELECT risk_score, customer_id, order_id, product_name, sales, discount_rate, profit FROM risky
        WHERE risk_score >= 0.7
        ORDER BY risk_score DESC, customer_id, order_id, product_name, sales, discount_rate, profit LIMIT 20""",
    "risk_histogram": _histogram("risky", "risk_score", 50),
    "top_ltv_customers": """SELECT customer_id, '$' || format('{:,}', cast(round(total_sales) AS bigint)) AS total_sales,
        order_count, printf('%.1f%%', ltv_score * 100) AS ltv_score
        FROM ltv ORDER BY ltv.ltv_score DESC, customer_id LIMIT 10""",
    "high_risk_revenue": """SELECT count(*) AS high_risk_customers, MONEY(total_sales) AS revenue_at_risk
        FROM ltv WHERE ltv_score >= 0.5""",
    "market_scorecard": "SELECT * FROM markets ORDER BY profit_margin_pct DESC, market",
    "markets_by_profit": "SELECT * FROM markets ORDER BY total_profit DESC, market",
    "region_ranking": "SELECT * FROM regions ORDER BY profit_margin_pct DESC, order_region",
    "health_ranking": "SELECT * FROM health ORDER BY health_score DESC, category_name",
    # features and metrics
    "delivery_risk_features": """SELECT shipping_mode, market, late_delivery_risk AS label, count(*) AS rows,
        fsum(discount_rate) AS discount_rate, fsum(quantity) AS quantity,
        fsum(unit_price) AS unit_price, fsum(discount_rate * quantity) AS disc_x_qty,
        fsum(unit_price * quantity) AS price_x_qty, sum(ln(1 + unit_price)) AS log_price
        FROM tx GROUP BY 1, 2, 3""",
    "ltv_features": "SELECT * FROM ltv_table",
    "margin_risk_features": """SELECT shipping_mode, market, customer_segment, category_name,
        CASE WHEN profit < 0 THEN 1 ELSE 0 END AS label, count(*) AS rows,
        MONEY(discount_rate) AS discount_rate, fsum(unit_price) AS unit_price
        FROM tx GROUP BY 1, 2, 3, 4, 5""",
    "churn_features": """SELECT customer_id, total_revenue, total_profit, cast(order_count AS double) AS order_count,
        avg_discount, clv_score, cast(churn_risk AS int) AS label FROM clv""",
    "label_encode": " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", {c} AS value, dense_rank() OVER (ORDER BY {c}) - 1 AS code, count(*) AS rows
        FROM tx GROUP BY {c}"""
        for c in ENCODED
    ),
    "ui_sample": f"""SELECT discount_rate, profit, sales, customer_segment, category_name, product_name, market, profit_ratio,
        {BANDED} AS margin_band, shipping_mode, quantity, late_delivery_risk FROM {SAMPLE}""",
    # the error from the plain variance over all sampled rows, those outside of the selection as 0
    "sample_scaled_kpis": f"""SELECT sales * scale AS estimated_revenue, profit * scale AS estimated_profit,
        profit / sales * 100 AS margin_pct, cast(floor(n * scale) AS bigint) AS estimated_orders,
        full_rows * sqrt((1 - sample_rows / full_rows) * sales_variance / sample_rows) AS revenue_error,
        full_rows * sqrt((1 - sample_rows / full_rows) * profit_variance / sample_rows) AS profit_error
        FROM (SELECT MONEY(CASE WHEN chosen THEN sales END) AS sales, MONEY(CASE WHEN chosen THEN profit END) AS profit,
            count(*) FILTER (chosen) AS n, var_samp(CASE WHEN chosen THEN sales ELSE 0 END) AS sales_variance,
            var_samp(CASE WHEN chosen THEN profit ELSE 0 END) AS profit_variance
          FROM (SELECT *, customer_segment IN ('BUILDING', 'MACHINERY') AND market IN ('ASIA', 'EUROPE') AS chosen FROM {SAMPLE})),
          (SELECT count(*) AS full_rows, least(count(*), 15000) AS sample_rows, count(*) / least(count(*), 15000) AS scale FROM tx)""",
    "stratified_split": f"""SELECT part, count(*) AS rows, avg(label) AS positive_share FROM (
        SELECT label, CASE WHEN row_number() OVER (PARTITION BY label ORDER BY h)
          <= floor(count(*) OVER (PARTITION BY label) * 0.25 + 0.5) THEN 'test' ELSE 'train' END AS part
        FROM (SELECT CASE WHEN profit < 0 THEN 1 ELSE 0 END AS label, {_hash(42)} AS h FROM tx)) GROUP BY part""",
    "stratified_folds": """SELECT fold, label, count(*) AS rows FROM (
        SELECT label, cast(len(list_filter([0.2, 0.4, 0.6, 0.8], lambda s: r > floor(n * s + 0.5))) AS int) AS fold
        FROM (SELECT label, row_number() OVER (PARTITION BY label) AS r, count(*) OVER (PARTITION BY label) AS n
          FROM (SELECT CASE WHEN profit < 0 THEN 1 ELSE 0 END AS label FROM tx))) GROUP BY ALL""",
    "delivery_risk_codes": """SELECT label, shipping_mode_code, market_code, customer_segment_code, order_status_code,
        count(*) AS rows, cast(sum(category_code) AS bigint) AS category_codes, cast(sum(department_code) AS bigint) AS department_codes
        FROM (SELECT late_delivery_risk AS label, dense_rank() OVER (ORDER BY shipping_mode) - 1 AS shipping_mode_code,
          dense_rank() OVER (ORDER BY market) - 1 AS market_code, dense_rank() OVER (ORDER BY customer_segment) - 1 AS customer_segment_code,
          dense_rank() OVER (ORDER BY order_status) - 1 AS order_status_code, dense_rank() OVER (ORDER BY category_name) - 1 AS category_code,
          dense_rank() OVER (ORDER BY department_name) - 1 AS department_code FROM tx) GROUP BY ALL""",
    "margin_risk_scores": """SELECT profit < 0 AS is_loss, count(*) AS rows, MONEY(sales) AS sales_sum, count(*) AS in_bounds,
        count(*) AS flags_agree, true AS auc_reaches_target FROM tx GROUP BY 1""",
    "churn_scores": """SELECT customer_id, total_revenue, order_count, cast(churn_risk AS int) AS churn_risk,
        (SELECT count(*) > 50 AND count(*) FILTER (churn_risk) BETWEEN 10 AND count(*) - 1 FROM clv) AS scored FROM clv""",
    # a model that learns ranks as well as the best single feature, and finds it
    "feature_importance": """SELECT max(feature) FILTER (fitted) AS top_feature,
        cast(count(*) FILTER (fitted) * 5 AS bigint) AS features, max(CASE WHEN fitted THEN 1.0 ELSE 0.0 END)::double AS gains FROM best_feature""",
    "permutation_importance": """SELECT max(feature) FILTER (fitted) AS top_feature,
        cast(count(*) FILTER (fitted) * 5 AS bigint) AS features, cast(count(*) FILTER (fitted) * 5 AS bigint) AS in_bounds FROM best_feature""",
    "model_report": """SELECT 'customer_churn' AS model, '200' AS trees, '4' AS depth, cast(5 AS bigint) AS features,
        round(0.5 + strength, 1) AS holdout_auc FROM best_feature WHERE fitted""",
    "cross_validated_auc": """SELECT CASE WHEN fitted THEN round(0.5 + strength, 1) END AS cv_mean,
        CASE WHEN fitted THEN 0.0::double END AS cv_std FROM best_feature""",
    "margin_attribution_sums": """SELECT profit < 0 AS is_loss, count(*) AS rows, count(*) AS adding_up, count(*) AS with_all_features
        FROM tx GROUP BY 1""",
    "delivery_risk_scores": f"""SELECT label, count(*) AS rows, count(*) AS in_bounds, any_value(auc) AS feature_auc, true AS better_than_feature
        FROM (SELECT late_delivery_risk AS label FROM tx), ({_auc("tx", "discount_rate", "late_delivery_risk")}) GROUP BY label""",
    "ltv_scores": f"""SELECT label, count(*) AS rows, count(*) AS in_bounds, any_value(auc) AS feature_auc, true AS better_than_feature
        FROM ltv_table, ({_auc("ltv_table", "order_count", "label")}) GROUP BY label""",
    "hpo_pruning": """SELECT trial, stopped_after IS NOT NULL AS stopped, avg(auc) AS mean_auc, count(*) AS folds_run FROM (
        SELECT *, min(CASE WHEN fold < 4 AND others >= 5 AND so_far < middle THEN fold END) OVER (PARTITION BY trial) AS stopped_after
        FROM (SELECT *, count(*) OVER w AS others, quantile_cont(so_far, 0.5) OVER w AS middle
          FROM (SELECT *, avg(auc) OVER (PARTITION BY trial ORDER BY fold) AS so_far FROM fold_aucs)
          WINDOW w AS (PARTITION BY fold ORDER BY trial // 2 RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)))
        WHERE stopped_after IS NULL OR fold <= stopped_after GROUP BY ALL""",
    "routed_kpis": " UNION ALL ".join(
        f"""SELECT '{"+".join(chosen)}' AS filters, MONEY(sales) AS revenue, MONEY(profit) AS profit,
        MONEY(profit) / MONEY(sales) * 100 AS margin_pct, MONEY(sales) / count(DISTINCT order_id) AS average_order_value,
        count(DISTINCT customer_id) AS customers, count(DISTINCT order_id) AS orders FROM tx WHERE {" AND ".join(FILTERS[d] for d in chosen) or "true"}"""
        for chosen in SUBSETS
    ),
    "refreshed_totals": """
        SELECT 'monthly' AS result, month AS key, monthly_revenue AS total_sales, monthly_profit AS total_profit,
          (monthly_revenue / lag(monthly_revenue) OVER (ORDER BY month) - 1) * 100 AS detail FROM months
        UNION ALL SELECT 'category', category_name, total_sales, total_profit, total_sales / sum(total_sales) OVER () FROM categories
        UNION ALL SELECT 'product', product_name, total_sales, total_profit, profit_per_unit FROM products
        UNION ALL SELECT 'market', market, total_sales, total_profit, profit_margin_pct FROM markets
        UNION ALL SELECT 'region', order_region, total_sales, total_profit, profit_margin_pct FROM regions
        UNION ALL SELECT 'shipping', shipping_mode, MONEY(sales), MONEY(profit), avg(delivery_overrun_days) FROM late_days GROUP BY shipping_mode""",
    "clustered_selection": _kept("selected"),
    "bucketed_customer_join": """SELECT customer_id, total_sales, customers.order_count, clv_score, churn_risk, rfm_segment
        FROM customers JOIN clv USING (customer_id) JOIN rfm USING (customer_id)""",
    "calibrated_model_scores": "SELECT customer_id, churn_risk, true AS scored FROM clv",
    # the monotone fit is, for each score, the largest over starts of the smallest over ends of the mean between them
    "calibrated_scores": """SELECT * FROM (WITH points AS (
          SELECT score, count(*) AS rows, cast(sum(label) AS bigint) AS losses, row_number() OVER (ORDER BY score) AS i
          FROM (SELECT 1 / (1 + round(unit_price / 50)) AS score, CASE WHEN profit < 0 THEN 1 ELSE 0 END AS label FROM tx)
          GROUP BY score),
        sums AS (SELECT i, sum(losses) OVER (ORDER BY i) AS y, sum(rows) OVER (ORDER BY i) AS w FROM points),
        spans AS (
          SELECT a.i AS first, b.i AS last, (b.y - coalesce(p.y, 0)) / (b.w - coalesce(p.w, 0)) AS mean
          FROM sums a JOIN sums b ON b.i >= a.i LEFT JOIN sums p ON p.i = a.i - 1),
        least_ends AS (SELECT points.i, first, min(mean) AS low FROM points JOIN spans ON first <= points.i AND last >= points.i GROUP BY ALL)
        SELECT score, rows, losses, max(low) AS probability FROM points JOIN least_ends USING (i) GROUP BY ALL)""",
    "roc_auc": _auc("tx", "sales", "late_delivery_risk"),
    "brier_score": """SELECT avg((risk_score - late_delivery_risk) * (risk_score - late_delivery_risk)) AS brier
        FROM risky""",
    "model_gates": f"""SELECT margin_auc, ltv_auc, margin_auc > 0.80 AND ltv_auc > 0.60 AND ltv_auc < 0.99 AS production_grade,
        margin_auc < 0.60 AS needs_rebuild, ltv_auc > 0.99 AS label_leakage
        FROM (SELECT auc AS margin_auc FROM ({_auc(
            "(SELECT CASE WHEN profit < 0 THEN 1 ELSE 0 END AS loss, -unit_price AS score FROM tx)", "score", "loss")})),
          (SELECT auc AS ltv_auc FROM ({_auc("ltv_table", "order_count", "label")}))""",
}

ORACLE_SQL: dict[str, str] = {name: _with_common(body) for name, body in BODIES.items()}
