"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

BASE = """
WITH products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS product_category,
         p_brand AS product_subcategory,
         CAST(p_retailprice AS DECIMAL(10,2)) AS sales_price,
         CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 0.6 AS DECIMAL(10,2)) AS cost_to_make,
         p_size AS stock, CAST(p_partkey % 500 AS INTEGER) AS opening_stock
  FROM part
), customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_name,
         c_mktsegment || ', ' || CAST(c_nationkey AS VARCHAR) AS address
  FROM customer
), headers AS (
  SELECT CAST(o_orderdate AS DATE) AS batch_date, o_orderkey AS order_id,
         o_custkey AS customer_id, o_orderdate AS order_datetime
  FROM orders
), items AS (
  SELECT l_orderkey AS order_id,
         CASE WHEN l_linenumber = 4 AND l_returnflag = 'A' THEN -1 - l_partkey
              ELSE l_partkey END AS product_id,
         CASE WHEN l_linenumber = 7 THEN NULL
              WHEN l_linenumber = 6 THEN 0
              WHEN l_linenumber = 5 AND l_returnflag = 'R' THEN -CAST(l_quantity AS INTEGER)
              ELSE CAST(l_quantity AS INTEGER) END AS quantity
  FROM lineitem
), lines AS (
  SELECT batch_date, order_id, customer_id, order_datetime, product_id, quantity
  FROM items JOIN headers USING (order_id)
), checked AS (
  SELECT l.*, p.sales_price AS unit_price, p.cost_to_make, p.stock,
         CASE WHEN quantity <= stock THEN quantity END AS final_quantity
  FROM lines l LEFT JOIN products p USING (product_id)
  WHERE quantity IS NOT NULL
), validated AS (
  SELECT *, CAST(round(final_quantity * unit_price, 2) AS DECIMAL(18,2)) AS line_total,
         CAST(round((unit_price - cost_to_make) * final_quantity, 2) AS DECIMAL(18,2)) AS profit
  FROM checked
), valid_orders AS (
  SELECT batch_date, order_id, CAST(sum(final_quantity) AS BIGINT) AS units
  FROM validated GROUP BY batch_date, order_id HAVING sum(final_quantity) > 0
), found_orders AS (
  SELECT DISTINCT batch_date, order_id, customer_id, order_datetime
  FROM validated SEMI JOIN valid_orders USING (batch_date, order_id)
), found_items AS (
  SELECT batch_date, order_id, product_id, final_quantity AS quantity, unit_price, line_total
  FROM validated WHERE batch_date IN (SELECT batch_date FROM valid_orders)
), summary AS (
  SELECT CAST(order_datetime AS DATE) AS date,
         CAST(count(DISTINCT order_id) AS BIGINT) AS num_orders,
         CAST(round(sum(line_total), 2) AS DECIMAL(18,2)) AS total_sales,
         CAST(round(sum(profit), 2) AS DECIMAL(18,2)) AS total_profit
  FROM validated SEMI JOIN valid_orders USING (batch_date, order_id)
  WHERE final_quantity > 0 GROUP BY 1
), ordered AS (
  SELECT product_id, CAST(sum(final_quantity) AS BIGINT) AS total_ordered
  FROM validated GROUP BY product_id
), stock_levels AS (
  SELECT product_id, product_name,
         CAST(CASE WHEN opening_stock - coalesce(total_ordered, 0) < 0 THEN 0
                   ELSE opening_stock - coalesce(total_ordered, 0) END AS BIGINT) AS current_stock
  FROM products LEFT JOIN ordered USING (product_id)
), summary_series AS (
  SELECT 'total_sales' AS series_key, date, CAST(total_sales AS DOUBLE) AS y FROM summary
  UNION ALL SELECT 'total_profit', date, CAST(total_profit AS DOUBLE) FROM summary
), event_series AS (
  SELECT event_type AS series_key, CAST(ts AS DATE) AS date,
         fsum(value) AS y
  FROM events GROUP BY 1, 2
)
"""

SPINE = """
SELECT CAST(d AS DATE) AS date, strftime(d, '%Y%m%d') AS day_code
FROM (SELECT unnest(generate_series(min(batch_date), max(batch_date), INTERVAL 1 DAY)) AS d FROM headers)
"""

# Catalogue versions, as the driver's tables give them.
VERSIONS = """
SELECT product_id, product_name, valid_from, unit_price, CAST(unit_price * 0.6 AS DECIMAL(10,2)) AS cost, stock
FROM (SELECT product_id, product_name, CAST(DATE '1995-01-01' + CAST((product_id * 37 + n * n * 211) % 2400 AS INTEGER) AS DATE)
               AS valid_from, CAST(sales_price + n * 7 AS DECIMAL(10,2)) AS unit_price, CAST(stock - n * 3 AS INTEGER) AS stock
      FROM products, (SELECT unnest([0, 1, 2, 3]) AS n) WHERE n > 0 OR product_id % 7 > 0)
"""
LINE = "batch_date, order_id, customer_id, product_id, quantity"
EXPLODED = """
SELECT batch_date, order_id, customer_id, order_datetime, product_id, product_name, quantity
FROM lines LEFT JOIN (SELECT product_id, product_name FROM products) USING (product_id)
"""


def _fit(series: str) -> str:
    return f"""
SELECT series_key, regr_slope(y, x) AS slope, avg(x) AS mean_day, avg(y) AS mean_y,
       max(date) AS last_date
FROM (SELECT *, CAST(date_diff('day', DATE '1970-01-01', date) AS DOUBLE) AS x FROM {series})
GROUP BY series_key
"""


def _predict(series: str, horizon: int) -> str:
    return f"""
SELECT series_key, CAST(last_date + CAST(ahead AS INTEGER) AS DATE) AS date,
       mean_y + slope * (date_diff('day', DATE '1970-01-01', last_date) + ahead - mean_day) AS yhat
FROM ({_fit(series)}) CROSS JOIN (SELECT unnest(range(1, {horizon + 1})) AS ahead)
"""


def _sales_and_profit(horizon: int) -> str:
    return f"""
SELECT date, round(max(yhat) FILTER (series_key = 'total_sales'), 4) AS forecasted_sales,
       round(max(yhat) FILTER (series_key = 'total_profit'), 4) AS forecasted_profit
FROM ({_predict('summary_series', horizon)}) GROUP BY date
"""


def _running(partition: str, order: str) -> str:
    return f"""
SELECT product_id, batch_date, order_id, quantity, ordered_so_far,
       CAST(CASE WHEN opening_stock - ordered_so_far < 0 THEN 0
                 ELSE opening_stock - ordered_so_far END AS BIGINT) AS remaining_stock
FROM (
  SELECT product_id, batch_date, order_id, final_quantity AS quantity,
         CAST(sum(final_quantity) OVER (
           PARTITION BY {partition} ORDER BY {order}
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS ordered_so_far
  FROM validated WHERE final_quantity > 0
) JOIN products USING (product_id)
"""


def _running_stock(partition: str) -> str:
    """Lines one after the other: what is left after each is known only from the one before."""
    same = " AND ".join(f"t.{name.strip()} = n.{name.strip()}" for name in partition.split(","))
    return f"""
, numbered AS MATERIALIZED (
  SELECT l.batch_date, l.order_id, l.customer_id, l.product_id, l.quantity, p.opening_stock, p.sales_price, p.cost_to_make,
         row_number() OVER (PARTITION BY {", ".join("l." + n.strip() for n in partition.split(","))}
                            ORDER BY l.batch_date, l.order_datetime, l.order_id, l.quantity) AS n
  FROM lines l JOIN products p USING (product_id) WHERE quantity IS NOT NULL
), walked AS (
  SELECT *, quantity <= opening_stock AS filled,
         opening_stock - CASE WHEN quantity <= opening_stock THEN quantity ELSE 0 END AS remaining
  FROM numbered WHERE n = 1
  UNION ALL
  SELECT n.*, n.quantity <= t.remaining, t.remaining - CASE WHEN n.quantity <= t.remaining THEN n.quantity ELSE 0 END
  FROM walked t JOIN numbered n ON {same} AND n.n = t.n + 1
)
SELECT {LINE}, CASE WHEN filled THEN quantity END AS final_quantity,
       CAST(CASE WHEN filled THEN round(quantity * sales_price, 2) END AS DECIMAL(18,2)) AS line_total,
       CAST(CASE WHEN filled THEN round((sales_price - cost_to_make) * quantity, 2) END AS DECIMAL(18,2)) AS profit
FROM walked
UNION ALL
SELECT {LINE}, NULL, NULL, NULL FROM lines ANTI JOIN products USING (product_id) WHERE quantity IS NOT NULL
"""


_STATEMENTS = {
    "src_csv_roundtrip": "SELECT * FROM products",
    "src_csv_customers": "SELECT * FROM customers",
    "src_json_documents": EXPLODED,
    "src_variant_documents": """
SELECT batch_date, order_id, customer_id, order_datetime, CASE WHEN NOT bare THEN product_id END AS product_id,
       CASE WHEN NOT bare AND NOT in_words THEN quantity END AS quantity, NOT bare AND NOT in_words AS kept,
       CASE WHEN bare THEN 'item: ' || product_id WHEN in_words THEN 'qty: "lots"' ELSE '' END AS problems
FROM (SELECT *, order_id % 11 = 0 AND product_id % 4 = 0 AS in_words, order_id % 13 = 0 AND product_id % 6 = 0 AS bare FROM lines)""",
    "src_days_of_table": """
SELECT batch_date, order_id, customer_id, order_datetime FROM headers WHERE last_day(batch_date) = batch_date""",
    "batch_run_written": """
SELECT table_name, CAST(n AS BIGINT) AS n_rows, CAST(days AS INTEGER) AS n_parts, CAST(lost AS BIGINT) AS n_cancelled
FROM (SELECT 'orders' AS table_name, count(*) AS n, count(DISTINCT batch_date) AS days, 0 AS lost FROM found_orders
      UNION ALL SELECT 'order_line_items', count(*), count(DISTINCT batch_date), count(*) FILTER (quantity IS NULL)
      FROM found_items
      UNION ALL SELECT 'daily_summary', count(*), 0, 0 FROM summary
      UNION ALL SELECT 'products_updated', count(*), 0, 0 FROM products)""",
    "batch_run_dated_catalogue": f"""
, dated AS (
  SELECT l.batch_date, l.order_id, l.product_id, CASE WHEN quantity <= stock THEN quantity END AS quantity, unit_price,
         CAST(CASE WHEN quantity <= stock THEN round(quantity * unit_price, 2) END AS DECIMAL(18,2)) AS line_total
  FROM (SELECT * FROM lines WHERE quantity IS NOT NULL) l
  ASOF LEFT JOIN ({VERSIONS}) v ON l.product_id = v.product_id AND l.batch_date >= v.valid_from
), trading AS (SELECT batch_date FROM dated GROUP BY batch_date, order_id HAVING sum(quantity) > 0)
SELECT * FROM dated WHERE batch_date IN (SELECT batch_date FROM trading)""",
    "join_bucketed_orders": """
SELECT order_id, min(customer_id) AS customer_id, CAST(count(*) AS BIGINT) AS num_items, CAST(sum(quantity) AS BIGINT) AS units
FROM headers JOIN items USING (order_id) GROUP BY order_id""",
    "distinct_orders_of_range": """
SELECT first_day, last_day, CAST(count(DISTINCT order_id) AS BIGINT) AS num_orders
FROM (SELECT first_day, CAST(first_day + 75 AS DATE) AS last_day
      FROM (SELECT DISTINCT CAST(date_trunc('month', batch_date) AS DATE) AS first_day FROM headers))
LEFT JOIN validated ON batch_date BETWEEN first_day AND last_day
GROUP BY first_day, last_day""",
    "forecast_rolling_errors": """
SELECT series_key, ahead, CAST(count(*) AS BIGINT) AS origins, round(avg(abs(y - yhat)), 2) AS mae,
       round(avg((y - yhat) * (y - yhat)), 2) AS mse
FROM (
  SELECT o.series_key, CAST(h.ahead AS INTEGER) AS ahead, CAST(o.origin + CAST(h.ahead AS INTEGER) AS DATE) AS date,
         mean_y + slope * (date_diff('day', DATE '1970-01-01', o.origin) + h.ahead - mean_day) AS yhat
  FROM (
    SELECT a.series_key, a.date AS origin, regr_slope(b.y, date_diff('day', DATE '1970-01-01', b.date)) AS slope,
           avg(date_diff('day', DATE '1970-01-01', b.date)) AS mean_day, avg(b.y) AS mean_y
    FROM summary_series a JOIN summary_series b ON a.series_key = b.series_key AND b.date <= a.date
    GROUP BY a.series_key, a.date HAVING count(*) >= 3) o,
  (SELECT unnest(range(1, 8)) AS ahead) h)
JOIN summary_series USING (series_key, date)
GROUP BY series_key, ahead""",
    "src_dated_batches": """
SELECT batch_date, order_id, product_id, quantity, final_quantity, line_total FROM validated""",
    "sink_csv_roundtrip": "SELECT * FROM summary",
    "sink_partitioned_batches": """
SELECT batch_date, CAST(count(*) AS BIGINT) AS n_items FROM found_items GROUP BY batch_date""",
    "union_batches": "SELECT * FROM found_orders",
    "batch_run": "SELECT * FROM found_items",
    "src_flat_documents": "SELECT * FROM found_orders",
    "batch_run_orders": "SELECT * FROM found_orders",
    "batch_run_summary": "SELECT * FROM summary",
    "batch_run_stock": """
SELECT product_id, product_name,
       CAST(greatest(stock - coalesce(total_ordered, 0), 0) AS BIGINT) AS current_stock
FROM products LEFT JOIN ordered USING (product_id)""",
    "date_spine": SPINE,
    "empty_batch_schema": f"""
SELECT date AS batch_date, coalesce(n_orders, 0) AS n_orders, coalesce(n_items, 0) AS n_items,
       'batch_date,order_id,customer_id,order_datetime' AS order_columns,
       'batch_date,order_id,product_id,quantity,unit_price,line_total' AS item_columns
FROM ({SPINE})
LEFT JOIN (SELECT batch_date AS date, CAST(count(*) AS BIGINT) AS n_orders FROM found_orders GROUP BY 1)
  USING (date)
LEFT JOIN (SELECT batch_date AS date, CAST(count(*) AS BIGINT) AS n_items FROM found_items GROUP BY 1)
  USING (date)""",
    "table_profile": """
SELECT 'customers' AS table_name, CAST(count(*) AS BIGINT) AS n_rows, 3 AS n_columns FROM customers
UNION ALL SELECT 'products', count(*), 8 FROM products
UNION ALL SELECT 'orders', count(*), 4 FROM headers
UNION ALL SELECT 'lines', count(*), 6 FROM lines""",
    "preview_topn": "SELECT * FROM headers ORDER BY order_id, order_datetime LIMIT 10",
    "project_rename_cast": """
SELECT order_id AS transaction_id, CAST(product_id AS INTEGER) AS item_code,
       TRY_CAST(quantity AS INTEGER) AS qty, CAST(quantity AS DECIMAL(10,2)) AS qty_amount
FROM items""",
    "explode_order_items": EXPLODED,
    "filter_null_quantity": f"SELECT {LINE} FROM lines WHERE quantity IS NOT NULL",
    "filter_positive_quantity": f"SELECT {LINE} FROM lines WHERE quantity > 0",
    "join_orders_items": f"SELECT {LINE}, order_datetime FROM headers JOIN items USING (order_id)",
    "join_items_products_left": """
SELECT order_id, product_id, quantity, sales_price AS unit_price, cost_to_make, stock
FROM items LEFT JOIN products USING (product_id)""",
    "semi_valid_orders": f"""
SELECT {LINE}, final_quantity FROM validated SEMI JOIN valid_orders USING (batch_date, order_id)""",
    "enrich_orders_customers": "SELECT * FROM headers LEFT JOIN customers USING (customer_id)",
    "validate_stock": f"SELECT {LINE}, stock, final_quantity FROM validated",
    "validate_running_stock": _running_stock("product_id"),
    "validate_running_stock_daily_reload": _running_stock("product_id, batch_date"),
    "price_as_of": f"""
SELECT {LINE.replace('product_id', 'l.product_id')}, unit_price, stock, CASE WHEN quantity <= stock THEN quantity END AS final_quantity,
       CAST(CASE WHEN quantity <= stock THEN round(quantity * unit_price, 2) END AS DECIMAL(18,2)) AS line_total,
       CAST(CASE WHEN quantity <= stock THEN round(quantity * (unit_price - cost), 2) END AS DECIMAL(18,2)) AS profit
FROM (SELECT * FROM lines WHERE quantity IS NOT NULL) l
ASOF LEFT JOIN ({VERSIONS}) v ON l.product_id = v.product_id AND l.batch_date >= v.valid_from""",
    "line_total": "SELECT order_id, product_id, final_quantity, unit_price, line_total FROM validated",
    "profit_per_line": "SELECT order_id, product_id, final_quantity, profit FROM validated",
    "valid_orders_having": "SELECT * FROM valid_orders",
    "cancelled_orders": """
SELECT batch_date, order_id, CAST(sum(CASE WHEN quantity <= stock THEN quantity ELSE 0 END) AS BIGINT) AS units
FROM lines LEFT JOIN products USING (product_id)
GROUP BY batch_date, order_id HAVING units = 0""",
    "cancelled_item_count": """
SELECT CAST(count(*) FILTER (final_quantity IS NULL) AS BIGINT) AS cancelled_items FROM validated""",
    "orders_distinct": "SELECT * FROM found_orders",
    "order_line_items": "SELECT * FROM found_items",
    "orders_formatted": """
SELECT order_id, customer_id, strftime(order_datetime, '%Y-%m-%dT%H:%M:%S.%f') AS order_datetime
FROM headers ORDER BY order_id""",
    "order_line_items_clean": """
SELECT * FROM found_items WHERE quantity IS NOT NULL ORDER BY order_id, product_id""",
    "count_distinct_orders": """
SELECT batch_date, CAST(count(DISTINCT order_id) AS BIGINT) AS num_orders
FROM validated GROUP BY batch_date""",
    "daily_summary": "SELECT * FROM summary ORDER BY date",
    "ordered_qty_per_product": "SELECT * FROM ordered",
    "update_inventory": "SELECT * FROM stock_levels ORDER BY product_id",
    "inventory_report": """
SELECT product_id,
       printf('• %-30s (ID: %3d): %4d units', product_name, product_id, current_stock) AS report_line
FROM stock_levels ORDER BY product_id""",
    "running_inventory": _running("product_id", "batch_date, order_id, final_quantity"),
    "running_inventory_daily_reload": _running("product_id, batch_date", "order_id, final_quantity"),
    "series_prepare": """
SELECT series_key, date, CAST(date_diff('day', first_date, date) AS INTEGER) AS t, y
FROM summary_series
JOIN (SELECT series_key, min(date) AS first_date FROM summary_series GROUP BY series_key)
USING (series_key)""",
    "series_info": """
SELECT series_key, min(date) AS first_date, max(date) AS last_date,
       CAST(count(y) AS BIGINT) AS n_points, round(avg(y), 4) AS mean_y
FROM summary_series GROUP BY series_key""",
    "series_segments": """
SELECT series_key, CAST(len(list_filter(knots, lambda k: k < t)) AS INTEGER) AS segment,
       round(CAST(count(*) AS DOUBLE), 6) AS points, round(sum(u), 6) AS u, round(sum(u * u), 6) AS uu,
       round(sum(v), 6) AS v, round(sum(u * v), 6) AS uv, round(sum(v * v), 6) AS vv
FROM (
  SELECT *, date_diff('day', first_date, date) AS t,
         date_diff('day', first_date, date)::DOUBLE / greatest(span, 1) AS u, y / scale AS v,
         list_transform(range(1, least(25, history - 1) + 1),
                        lambda j: round_even(j * ((history - 1)::DOUBLE / least(25, history - 1)), 0)) AS knots
  FROM (
    SELECT *, CAST(floor((span + 1) * 0.8) AS BIGINT) AS history
    FROM (
      SELECT series_key, date, y, min(date) OVER s AS first_date,
             date_diff('day', min(date) OVER s, max(date) OVER s) AS span,
             CASE WHEN max(abs(y)) OVER s > 0 THEN max(abs(y)) OVER s ELSE 1 END AS scale
      FROM summary_series WINDOW s AS (PARTITION BY series_key))))
GROUP BY series_key, segment""",
    "forecast_dates": f"SELECT series_key, date FROM ({_predict('event_series', 7)})",
    "forecast_linear": _sales_and_profit(1),
    "forecast_horizon7": _sales_and_profit(7),
    "forecast_multi_series": f"""
SELECT series_key, date, round(yhat, 4) AS yhat FROM ({_predict('event_series', 7)})""",
    "forecast_metrics": f"""
SELECT series_key, round(avg(abs(y - yhat)), 2) AS mae, round(avg((y - yhat) * (y - yhat)), 2) AS mse
FROM (SELECT series_key, y, mean_y + slope * (date_diff('day', DATE '1970-01-01', date) - mean_day) AS yhat
      FROM summary_series JOIN ({_fit('summary_series')}) USING (series_key))
GROUP BY series_key""",
}

def _with_base(statement: str) -> str:
    """A statement that adds its own tables to the common ones begins with a comma."""
    recursive = "t.n + 1" in statement
    return (BASE.replace("WITH ", "WITH RECURSIVE ", 1) if recursive else BASE) + statement


ORACLES = {name: _with_base(statement) for name, statement in _STATEMENTS.items()}
