"""SQL for the queries of the catalog, written for DuckDB over the same test tables."""

from __future__ import annotations

# Both mappings end in t_orders, t_prior, t_train, products, aisles, departments.
_DIMENSIONS = """
products AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         CAST(dense_rank() OVER (ORDER BY p_brand) AS INT) AS aisle_id,
         CAST(dense_rank() OVER (ORDER BY p_type) AS INT) AS department_id
  FROM part),
aisles AS (
  SELECT DISTINCT CAST(dense_rank() OVER (ORDER BY p_brand) AS INT) AS aisle_id,
         p_brand AS aisle FROM part),
departments AS (
  SELECT DISTINCT CAST(dense_rank() OVER (ORDER BY p_type) AS INT) AS department_id,
         p_type AS department FROM part),
t_prior AS (SELECT order_id, product_id, add_to_cart_order, reordered
            FROM t_lines WHERE eval_set = 'prior'),
t_train AS (SELECT order_id, product_id, add_to_cart_order, reordered
            FROM t_lines WHERE eval_set = 'train'),
prior_orders AS (SELECT * FROM t_orders WHERE eval_set = 'prior'),
history AS (SELECT l.*, o.user_id, o.order_number
            FROM t_prior l JOIN prior_orders o ON l.order_id = o.order_id),
interactions AS (SELECT user_id, product_id, count(*) AS purchases FROM history GROUP BY 1, 2),
labelled AS (SELECT DISTINCT user_id FROM t_orders WHERE eval_set = 'train'),
truth AS (SELECT DISTINCT o.user_id, l.product_id
          FROM t_train l JOIN t_orders o ON l.order_id = o.order_id AND o.eval_set = 'train'),
popular AS (
  SELECT product_id, row_number() OVER (ORDER BY count(*) DESC, product_id) AS pop_rank
  FROM history GROUP BY product_id),
features AS (
  SELECT p.user_id, p.product_id, p.product_purchases, p.first_order, p.last_order,
         p.avg_cart_position, u.user_orders,
         p.product_purchases / u.user_orders AS purchase_rate,
         u.user_orders - p.last_order AS orders_since_last_purchase
  FROM (SELECT user_id, product_id, count(*) AS product_purchases,
               min(order_number) AS first_order, max(order_number) AS last_order,
               avg(add_to_cart_order) AS avg_cart_position
        FROM history GROUP BY 1, 2) p
  JOIN (SELECT user_id, max(order_number) AS user_orders FROM prior_orders GROUP BY 1) u
    ON p.user_id = u.user_id),
dataset AS (
  SELECT f.*, CASE WHEN t.user_id IS NULL THEN CAST(0 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END AS label
  FROM features f LEFT JOIN truth t ON f.user_id = t.user_id AND f.product_id = t.product_id),
scored AS (
  SELECT user_id, purchase_rate AS probability, label FROM dataset
  WHERE user_id IN (SELECT user_id FROM labelled))
"""

SALES = (
    """WITH s AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_number,
         count(*) OVER (PARTITION BY o_custkey) AS n
  FROM orders),
t_orders AS (
  SELECT order_id, user_id,
         CASE WHEN order_number < n THEN 'prior'
              WHEN user_id % 5 = 0 THEN 'test' ELSE 'train' END AS eval_set,
         CAST(order_number AS INT) AS order_number,
         CAST(dayofweek(o_orderdate) AS INT) AS order_dow,
         CAST(hour(o_orderdate) AS INT) AS order_hour_of_day
  FROM s),
b AS (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, min(l_linenumber) AS ln
  FROM lineitem GROUP BY 1, 2),
t_lines AS (
  SELECT b.order_id, b.product_id, o.eval_set,
         CAST(row_number() OVER (PARTITION BY b.order_id ORDER BY ln, b.product_id) AS INT)
           AS add_to_cart_order,
         CASE WHEN row_number() OVER (PARTITION BY o.user_id, b.product_id ORDER BY o.order_number) > 1
              THEN 1 ELSE 0 END AS reordered
  FROM b JOIN t_orders o ON b.order_id = o.order_id),"""
    + _DIMENSIONS
)

EVENTS = (
    """WITH ev AS (
  SELECT user_id, event_id, ts, CAST(ts AS DATE) AS dt,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id
  FROM events),
s AS (SELECT user_id, dt, min(ts) AS ts FROM ev GROUP BY 1, 2),
r AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY dt) AS order_number,
         count(*) OVER (PARTITION BY user_id) AS n
  FROM s),
t_orders AS (
  SELECT user_id * 100000 + date_diff('day', DATE '1970-01-01', dt) AS order_id, user_id,
         CASE WHEN order_number < n THEN 'prior'
              WHEN user_id % 5 = 0 THEN 'test' ELSE 'train' END AS eval_set,
         CAST(order_number AS INT) AS order_number, CAST(dayofweek(dt) AS INT) AS order_dow,
         CAST(hour(ts) AS INT) AS order_hour_of_day
  FROM r),
b AS (
  SELECT user_id * 100000 + date_diff('day', DATE '1970-01-01', dt) AS order_id, product_id, min(event_id) AS ln
  FROM ev GROUP BY 1, 2),
t_lines AS (
  SELECT b.order_id, b.product_id, o.eval_set,
         CAST(row_number() OVER (PARTITION BY b.order_id ORDER BY ln) AS INT) AS add_to_cart_order,
         CASE WHEN row_number() OVER (PARTITION BY o.user_id, b.product_id ORDER BY o.order_number) > 1
              THEN 1 ELSE 0 END AS reordered
  FROM b JOIN t_orders o ON b.order_id = o.order_id),"""
    + _DIMENSIONS
)

_STATS = """
SELECT (SELECT count(*) FROM t_orders) AS orders,
       (SELECT count(*) FROM (SELECT DISTINCT user_id FROM t_orders)) AS users,
       (SELECT count(*) FROM products) AS products,
       (SELECT count(*) FROM t_prior) AS interactions,
       (SELECT round(avg(reordered) * 100, 2) FROM t_prior) AS reorder_rate,
       (SELECT round(avg(n), 2) FROM (SELECT count(*) AS n FROM t_prior GROUP BY order_id)) AS basket
"""

_COUNTS = """
SELECT 'orders' AS table_name, count(*) AS n_rows FROM t_orders
UNION ALL SELECT 'order_products__prior', count(*) FROM t_prior
UNION ALL SELECT 'order_products__train', count(*) FROM t_train
UNION ALL SELECT 'products', count(*) FROM products
UNION ALL SELECT 'aisles', count(*) FROM aisles
UNION ALL SELECT 'departments', count(*) FROM departments
"""


def _top(k: int) -> str:
    return f"""
SELECT p.product_id, p.product_name, count(*) AS n
FROM t_prior l JOIN products p ON l.product_id = p.product_id
GROUP BY 1, 2 ORDER BY n DESC, 1 LIMIT {k}
"""


_BY_HOUR = """
SELECT CAST(h.i AS INT) AS order_hour_of_day, count(o.order_id) AS n_orders
FROM range(24) h(i) LEFT JOIN t_orders o ON o.order_hour_of_day = h.i GROUP BY 1
"""

_FEATURE_COLUMNS = """user_id, product_id, product_purchases, first_order, last_order,
       round(avg_cart_position, 6) AS avg_cart_position, user_orders,
       round(purchase_rate, 6) AS purchase_rate, orders_since_last_purchase"""

_INTERACTIONS = "SELECT user_id, product_id, purchases FROM interactions"

_PURCHASES = """
SELECT i.user_id, i.product_id, p.product_name, i.purchases
FROM interactions i JOIN products p ON i.product_id = p.product_id
"""

_FEATURES = f"SELECT {_FEATURE_COLUMNS} FROM features"

_PER_USER_METRICS = """,
lists AS (
  SELECT 'popular' AS model, user_id, product_id, pop_rank AS r
  FROM labelled, popular WHERE pop_rank <= 10
  UNION ALL
  SELECT 'own', user_id, product_id,
         row_number() OVER (PARTITION BY user_id ORDER BY purchases DESC, product_id) AS r
  FROM interactions QUALIFY r <= 10),
per_user AS (
  SELECT m.model, t.user_id, count(l.product_id) AS hits, count(*) AS n_actual,
         coalesce(sum(1.0 / log2(l.r + 1)), 0) AS gain
  FROM truth t CROSS JOIN (VALUES ('popular'), ('own')) m(model)
  LEFT JOIN lists l
    ON l.model = m.model AND l.user_id = t.user_id AND l.product_id = t.product_id
  GROUP BY 1, 2),
judged AS (
  SELECT model, u.user_id, hits, n_actual, hits / 10.0 AS "precision", hits / n_actual AS recall,
         gain / (SELECT sum(1.0 / log2(g.i + 1)) FROM range(1, 11) g(i) WHERE g.i <= n_actual) AS ndcg
  FROM per_user u)
"""

_RANKING = (
    _PER_USER_METRICS
    + """
SELECT count(*) AS n_users, round(avg("precision"), 6) AS "precision",
       round(avg(recall), 6) AS recall, round(avg(ndcg), 6) AS ndcg
FROM judged WHERE model = 'popular'
"""
)

_PROFILE = """,
pairs AS (SELECT h.*, p.product_id AS known, p.aisle_id, p.department_id
          FROM history h LEFT JOIN products p ON h.product_id = p.product_id),
o AS (SELECT user_id, count(*) AS orders FROM prior_orders GROUP BY 1),
l AS (SELECT user_id, count(*) AS purchases, count(DISTINCT product_id) AS unique_products,
             avg(reordered) AS rate FROM pairs GROUP BY 1),
dow AS (SELECT user_id, order_dow AS v, count(*) AS n,
               row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, order_dow) AS rn
        FROM prior_orders GROUP BY 1, 2),
hod AS (SELECT user_id, order_hour_of_day AS v, count(*) AS n,
               row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, order_hour_of_day) AS rn
        FROM prior_orders GROUP BY 1, 2),
ai AS (SELECT user_id, aisle_id AS v, count(*) AS n,
              row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, aisle_id) AS rn
       FROM pairs WHERE known IS NOT NULL GROUP BY 1, 2),
de AS (SELECT user_id, department_id AS v, count(*) AS n,
              row_number() OVER (PARTITION BY user_id ORDER BY count(*) DESC, department_id) AS rn
       FROM pairs WHERE known IS NOT NULL GROUP BY 1, 2)
SELECT o.user_id, o.orders, coalesce(l.unique_products, 0) AS unique_products,
       coalesce(l.purchases, 0) AS purchases, round(l.rate * 100, 1) AS reorder_rate,
       coalesce(departments.department, 'Unknown') AS favorite_department,
       coalesce(aisles.aisle, 'Unknown') AS favorite_aisle,
       round(de.n / l.purchases * 100, 1) AS favorite_department_share,
       round(ai.n / l.purchases * 100, 1) AS favorite_aisle_share,
       dow.v AS favorite_order_day, round(dow.n / o.orders * 100, 1) AS favorite_order_day_share,
       hod.v AS favorite_order_hour, round(hod.n / o.orders * 100, 1) AS favorite_order_hour_share
FROM o LEFT JOIN l ON o.user_id = l.user_id
JOIN dow ON o.user_id = dow.user_id AND dow.rn = 1
JOIN hod ON o.user_id = hod.user_id AND hod.rn = 1
LEFT JOIN ai ON o.user_id = ai.user_id AND ai.rn = 1
LEFT JOIN de ON o.user_id = de.user_id AND de.rn = 1
LEFT JOIN aisles ON ai.v = aisles.aisle_id
LEFT JOIN departments ON de.v = departments.department_id
"""

_CELLS = """count(*) FILTER (WHERE probability >= t AND label = 1) AS tp,
         count(*) FILTER (WHERE probability >= t AND label = 0) AS fp,
         count(*) FILTER (WHERE probability < t AND label = 1) AS fn,
         count(*) FILTER (WHERE probability < t AND label = 0) AS tn"""

_RATES = """coalesce(tp / nullif(tp + fp, 0), 0) AS "precision",
       coalesce(tp / nullif(tp + fn, 0), 0) AS recall,
       coalesce((tp + tn) / nullif(tp + fp + fn + tn, 0), 0) AS accuracy,
       coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1"""

_ROUNDED_RATES = """round("precision", 6) AS "precision", round(recall, 6) AS recall,
       round(accuracy, 6) AS accuracy, round(f1, 6) AS f1"""


def _sweep(steps: int) -> str:
    return f""",
steps AS (SELECT CAST(round(0.05 * (i + 2), 2) AS DOUBLE) AS t FROM range({steps}) r(i)),
cells AS (SELECT t, {_CELLS} FROM scored, steps GROUP BY t),
sweep AS (SELECT t AS threshold, tp, fp, fn, tn, {_RATES} FROM cells)
"""


_SHOW_SWEEP = f"SELECT threshold, tp, fp, fn, tn, {_ROUNDED_RATES} FROM sweep"

_LISTED = """
  SELECT u.user_id, p.product_id, p.pop_rank FROM labelled u, popular p WHERE p.pop_rank <= """


def _fraction(seed: int = 42) -> str:
    return f"(((user_id % 1000003) * 2654435761 + {seed}) % 10007) / 10007.0"


def _split() -> str:
    return f"CASE WHEN {_fraction()} < 0.8 THEN 'train' ELSE 'test' END"


_SPLIT_DATASET = f""",
parted AS (
  SELECT *, CASE WHEN {_fraction()} < 0.7 THEN 'train'
                 WHEN {_fraction()} < 0.85 THEN 'validation' ELSE 'test' END AS split
  FROM dataset WHERE user_id IN (SELECT user_id FROM labelled))
"""

_LABELS = """count(*) FILTER (WHERE label = 1) AS n_positive,
       count(*) FILTER (WHERE label = 0) AS n_negative, true AS in_bounds"""

_TEST_LABELS = f"SELECT {_LABELS} FROM parted WHERE split = 'test'"

_NONE = "CAST(0 AS BIGINT)"


def _lists(where: str = "true", more: str = "") -> str:
    """Facts about complete lists of ten, of the users that ``where`` chooses."""
    return f"""
, catalogue AS (SELECT count(DISTINCT product_id) AS p FROM interactions)
SELECT DISTINCT user_id, least(10, p) AS n, CAST(least(10, p) AS INT) AS last_rank,
       least(10, p) AS n_products, {_NONE} AS n_unknown, {_NONE} AS n_rising{more}
FROM interactions, catalogue WHERE {where}
"""


_IS_LABELLED = "user_id IN (SELECT user_id FROM labelled)"

_NAMED = f", {_NONE} AS n_misnamed"

_TUNED_USERS = """
, ends AS (SELECT user_id, max(order_number) AS last_number FROM prior_orders
           WHERE user_id IN (SELECT user_id FROM labelled) GROUP BY 1),
tuned AS (
  SELECT h.user_id FROM history h JOIN ends e ON h.user_id = e.user_id GROUP BY 1
  HAVING bool_or(h.order_number = e.last_number) AND bool_or(h.order_number < e.last_number))
"""

_RANKED = """
SELECT i.user_id, i.product_id, p.product_name, i.purchases,
       row_number() OVER (PARTITION BY i.user_id ORDER BY i.purchases DESC, i.product_id) AS "rank"
FROM interactions i JOIN products p ON i.product_id = p.product_id
"""

# Every table of a run: rows, a sum that no fit changes, rows that cannot be right.
_PIPELINE_TABLES = f"""
, bought AS (SELECT product_id, count(*) AS n FROM t_prior GROUP BY 1),
top AS (SELECT b.n, row_number() OVER (ORDER BY b.n DESC, b.product_id) AS rn
        FROM bought b JOIN products p ON b.product_id = p.product_id),
size AS (SELECT count(DISTINCT user_id) AS u, count(DISTINCT product_id) AS p FROM interactions),
made AS (
SELECT 'dashboard/stats' AS part, 1 AS n_rows,
       (SELECT count(*) FROM t_orders) + (SELECT count(DISTINCT user_id) FROM t_orders)
       + (SELECT count(*) FROM products) + (SELECT count(*) FROM t_prior) AS numbers
UNION ALL SELECT 'dashboard/top_products', count(*), sum(n) FROM top WHERE rn <= 10
UNION ALL SELECT 'dashboard/orders_by_hour', 24, count(order_hour_of_day) FROM t_orders
UNION ALL SELECT 'dashboard/orders_by_dow', 7, count(order_dow) FROM t_orders
UNION ALL SELECT 'popularity', count(*), sum(n) FROM top WHERE rn <= 100
UNION ALL SELECT 'customer_profile', (SELECT count(DISTINCT user_id) FROM prior_orders),
                 (SELECT count(*) FROM history)
UNION ALL SELECT 'recommendations', u * least(10, p), u * least(10, p) * (least(10, p) + 1) // 2 FROM size
UNION ALL SELECT 'model_comparison', 2, 2 * count(DISTINCT user_id) FROM truth
UNION ALL SELECT 'threshold_sweep', 13, 13 * count(*) FROM parted WHERE split = 'validation' AND label = 1
UNION ALL SELECT 'reorder_quality', 1, count(*) FROM parted WHERE split = 'test' AND label = 1
UNION ALL SELECT 'reorder_predictions', NULL, 0
UNION ALL SELECT 'models/user_ids', count(DISTINCT user_id), sum(DISTINCT user_id) FROM interactions
UNION ALL SELECT 'models/product_ids', count(DISTINCT product_id), sum(DISTINCT product_id) FROM interactions
UNION ALL SELECT 'runs', 1, 10)
SELECT part, CAST(n_rows AS BIGINT) AS n_rows, CAST(numbers AS BIGINT) AS numbers, {_NONE} AS n_wrong FROM made
"""


def _judged_pairs(where: str = "true") -> str:
    return f"""
SELECT user_id, count(*) AS n_pairs, {_NONE} AS n_short, {_NONE} AS n_unlikely,
       {_NONE} AS n_rising, {_NONE} AS n_different
FROM features WHERE {where} GROUP BY 1
"""


def _sums(table: str, numbers: str, characters: str = "0", name: str = "") -> str:
    return f"""SELECT '{name or table}' AS table_name, count(*) AS n_rows,
       CAST(sum({numbers}) AS BIGINT) AS numbers, CAST(sum({characters}) AS BIGINT) AS characters
FROM {table}"""


_TABLE_SUMS = "\nUNION ALL ".join(
    [
        _sums("t_orders", "order_id + user_id + order_number + order_dow + order_hour_of_day",
              "length(eval_set)", "orders"),
        _sums("t_prior", "order_id + product_id + add_to_cart_order + reordered", name="prior"),
        _sums("t_train", "order_id + product_id + add_to_cart_order + reordered", name="train"),
        _sums("products", "product_id + aisle_id + department_id", "length(product_name)"),
        _sums("aisles", "aisle_id", "length(aisle)"),
        _sums("departments", "department_id", "length(department)"),
    ]
)

_DASHBOARD = f"""
, facts AS ({_STATS}),
top AS ({_top(10)}),
hours AS ({_BY_HOUR}),
days AS (SELECT CAST(d.i AS INT) AS order_dow, count(o.order_id) AS n_orders
         FROM range(7) d(i) LEFT JOIN t_orders o ON o.order_dow = d.i GROUP BY 1)
SELECT 'stats' AS part, CAST(0 AS BIGINT) AS "key", name, CAST(value AS DOUBLE) AS "value"
FROM (SELECT unnest(['orders', 'users', 'products', 'interactions', 'reorder_rate', 'basket']) AS name,
             unnest([CAST(orders AS DOUBLE), users, products, interactions, reorder_rate, basket]) AS value
      FROM facts)
UNION ALL SELECT 'top_products', product_id, product_name, CAST(n AS DOUBLE) FROM top
UNION ALL SELECT 'orders_by_hour', order_hour_of_day, '', CAST(n_orders AS DOUBLE) FROM hours
UNION ALL SELECT 'orders_by_dow', order_dow, '', CAST(n_orders AS DOUBLE) FROM days
"""

ORACLES: dict[str, str] = {
    "table_counts": SALES + _COUNTS,
    "scan_parquet": EVENTS + _TABLE_SUMS,
    "scan_orc": EVENTS + _TABLE_SUMS,
    "dashboard_stats": SALES + _STATS,
    "dashboard_stats_events": EVENTS + _STATS,
    "scan_csv": EVENTS + _TABLE_SUMS,
    "unique_users": SALES
    + "SELECT count(*) AS users FROM (SELECT DISTINCT user_id FROM t_orders)",
    "avg_basket": SALES
    + "SELECT round(avg(n), 6) AS basket FROM (SELECT count(*) AS n FROM t_prior GROUP BY order_id)",
    "reorder_rate": EVENTS + "SELECT round(avg(reordered) * 100, 6) AS reorder_rate FROM t_prior",
    "orders_by_dow": SALES
    + """
SELECT CAST(d.i AS INT) AS order_dow, count(o.order_id) AS n_orders
FROM range(7) d(i) LEFT JOIN t_orders o ON o.order_dow = d.i GROUP BY 1
""",
    "orders_by_hour": EVENTS + _BY_HOUR,
    "dashboard_sink": EVENTS + _DASHBOARD,
    "product_counts": SALES + "SELECT product_id, count(*) AS n FROM t_prior GROUP BY 1",
    "top_products": SALES + _top(10),
    "popularity_table": SALES + _top(100),
    "popularity_sink": SALES + _top(100),
    "cohort_filter": SALES + "SELECT * FROM prior_orders",
    "cohort_users": SALES + "SELECT user_id FROM labelled",
    "join_lines_orders": SALES
    + """SELECT order_id, product_id, add_to_cart_order, reordered, user_id, order_number
FROM history""",
    "interactions": SALES + _INTERACTIONS,
    "interactions_events": EVENTS + _INTERACTIONS,
    "join_restrict_users": SALES
    + _INTERACTIONS
    + " WHERE user_id IN (SELECT user_id FROM labelled)",
    "purchase_history": SALES + _PURCHASES,
    "purchase_history_events": EVENTS + _PURCHASES,
    "ranked_history": SALES + _RANKED,
    "ranked_history_events": EVENTS + _RANKED,
    "next_order": SALES
    + """
SELECT o.user_id, l.order_id, l.product_id, p.product_name, l.reordered
FROM t_train l JOIN t_orders o ON l.order_id = o.order_id AND o.eval_set = 'train'
JOIN products p ON l.product_id = p.product_id
""",
    "actual_sets": SALES + "SELECT user_id, product_id FROM truth",
    "last_order_per_user": SALES
    + "SELECT user_id, max(order_number) AS user_orders FROM prior_orders GROUP BY 1",
    "leave_last_order_out": SALES
    + """
SELECT *, CASE WHEN order_number = max(order_number) OVER (PARTITION BY user_id)
               THEN 'validation' ELSE 'history' END AS split
FROM prior_orders WHERE user_id IN (SELECT user_id FROM labelled)
""",
    "customer_profile": EVENTS + _PROFILE,
    "customer_profile_sales": SALES + _PROFILE,
    "user_profiles": SALES + _PROFILE + "WHERE o.user_id IN (SELECT user_id FROM labelled)",
    "basic_customer_aggs": EVENTS
    + """
SELECT user_id, count(*) AS purchases, count(DISTINCT product_id) AS unique_products,
       round(avg(reordered), 6) AS reorder_rate FROM history GROUP BY 1
""",
    "favourite_counts": EVENTS
    + """
SELECT user_id, order_dow, order_hour_of_day, count(*) AS n FROM prior_orders
GROUP BY GROUPING SETS ((user_id, order_dow), (user_id, order_hour_of_day))
""",
    "top1_per_user": EVENTS
    + """
SELECT user_id, product_id, purchases FROM interactions
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY purchases DESC, product_id) = 1
""",
    "popularity_recommendations": EVENTS
    + f'SELECT user_id, product_id, CAST(pop_rank AS INT) AS "rank" FROM ({_LISTED} 10)',
    "als_novel_counts": EVENTS
    + """
, own AS (SELECT user_id, count(*) AS b FROM interactions GROUP BY 1)
SELECT user_id, least(10, p - b) AS n, CAST(least(10, p - b) AS INT) AS last_rank
FROM own, (SELECT count(DISTINCT product_id) AS p FROM interactions) WHERE p > b
""",
    "novel_recommendations": EVENTS
    + f"""
SELECT l.user_id, l.product_id,
       CAST(row_number() OVER (PARTITION BY l.user_id ORDER BY l.pop_rank) AS INT) AS "rank"
FROM ({_LISTED} 1000000) l ANTI JOIN interactions i
  ON l.user_id = i.user_id AND l.product_id = i.product_id
QUALIFY row_number() OVER (PARTITION BY l.user_id ORDER BY l.pop_rank) <= 10
""",
    "ranking_metrics": EVENTS + _RANKING,
    "ranking_metrics_sales": SALES + _RANKING,
    "user_metrics": EVENTS
    + _PER_USER_METRICS
    + """
SELECT user_id, hits, n_actual, round("precision", 6) AS "precision", round(recall, 6) AS recall,
       round(ndcg, 6) AS ndcg FROM judged WHERE model = 'popular'
""",
    "compare_models": EVENTS
    + _PER_USER_METRICS
    + """
SELECT model, count(*) AS n_users, round(avg("precision"), 6) AS "precision",
       round(avg(recall), 6) AS recall, round(avg(ndcg), 6) AS ndcg FROM judged GROUP BY 1
""",
    "topk_per_user": EVENTS
    + """,
best AS (
  SELECT user_id, product_id, purchase_rate,
         row_number() OVER (PARTITION BY user_id ORDER BY purchase_rate DESC, product_id) AS rn
  FROM features)
SELECT b.user_id, CAST(rn AS INT) AS "rank", b.product_id,
       coalesce(p.product_name, 'Product ' || b.product_id) AS product_name,
       round(purchase_rate, 4) AS score
FROM best b LEFT JOIN products p ON b.product_id = p.product_id WHERE rn <= 10
""",
    "join_names_fallback": SALES
    + """
SELECT l.product_id, count(*) AS n,
       coalesce(any_value(p.product_name), 'Product ' || l.product_id) AS product_name
FROM t_prior l LEFT JOIN products p ON l.product_id = p.product_id GROUP BY l.product_id
""",
    "user_product_aggs": EVENTS
    + """
SELECT user_id, product_id, count(*) AS purchases, CAST(sum(reordered) AS BIGINT) AS reorders,
       count(reordered) AS marked, min(order_number) AS first_order,
       max(order_number) AS last_order, round(avg(add_to_cart_order), 6) AS avg_cart_position
FROM history GROUP BY 1, 2
""",
    "reorder_features": EVENTS + _FEATURES,
    "reorder_features_sales": SALES + _FEATURES,
    "reorder_dataset": EVENTS
    + f"""
SELECT {_FEATURE_COLUMNS}, label FROM dataset WHERE user_id IN (SELECT user_id FROM labelled)
""",
    "reorder_dataset_all_users": EVENTS + f"SELECT {_FEATURE_COLUMNS}, label FROM dataset",
    "split_users": SALES + f"SELECT user_id, {_split()} AS split FROM labelled",
    "confusion": EVENTS + f"SELECT {_CELLS} FROM scored, (SELECT CAST(0.2 AS DOUBLE) AS t)",
    "threshold_sweep": EVENTS + _sweep(13) + _SHOW_SWEEP,
    "threshold_sweep_wide": EVENTS + _sweep(17) + _SHOW_SWEEP,
    "best_threshold": EVENTS
    + _sweep(13)
    + """
SELECT CASE WHEN f1 > 0 THEN threshold ELSE 0 END AS threshold, round(f1, 6) AS f1
FROM sweep ORDER BY sweep.f1 DESC, sweep.threshold LIMIT 1
""",
    "holdout_eval": EVENTS
    + f""",
cells AS (SELECT {_CELLS} FROM scored, (SELECT CAST(0.2 AS DOUBLE) AS t)
          WHERE {_split()} = 'test'),
rates AS (SELECT tp, fp, fn, tn, {_RATES} FROM cells)
SELECT tp, fp, fn, tn, {_ROUNDED_RATES} FROM rates
""",
    "rate_reorder_list": EVENTS
    + """,
likely AS (
  SELECT f.*, p.product_name,
         row_number() OVER (PARTITION BY f.user_id ORDER BY purchase_rate DESC, f.product_id) AS rn
  FROM features f JOIN products p ON f.product_id = p.product_id WHERE purchase_rate >= 0.2)
SELECT user_id, CAST(rn AS INT) AS "rank", product_id, product_name,
       round(purchase_rate, 4) AS probability, product_purchases,
       round(purchase_rate, 4) AS purchase_rate, orders_since_last_purchase,
       round(avg_cart_position, 2) AS avg_cart_position
FROM likely WHERE rn <= 10
""",
    "als_optimality": EVENTS
    + "SELECT user_id, count(*) AS n_products, true AS optimal FROM interactions GROUP BY 1",
    "als_search": EVENTS
    + f"""
, catalogue AS (SELECT count(DISTINCT product_id) AS p FROM interactions)
SELECT DISTINCT user_id, least(10, p) AS n, least(10, p) AS n_other, {_NONE} AS n_different
FROM interactions, catalogue
""",
    "als_grid_recounted": EVENTS + _TUNED_USERS
    + """
SELECT CAST(g.i AS INT) AS position, n.n_users, true AS same
FROM range(6) g(i), (SELECT count(*) AS n_users FROM tuned) n
""",
    "metrics_recounted": EVENTS
    + """
, n AS (SELECT count(DISTINCT user_id) AS every,
               count(DISTINCT user_id) FILTER (WHERE user_id IN (SELECT user_id FROM interactions)) AS known
        FROM truth)
SELECT m.model, m.users, CASE WHEN m.users = 'truth' OR m.model = 'popularity' THEN every ELSE known END AS n_users,
       true AS same
FROM n, (VALUES ('popularity', 'common'), ('popularity', 'truth'), ('als', 'common'), ('als', 'truth')) m(model, users)
""",
    "recommender_large_ids": EVENTS
    + f"""
, catalogue AS (SELECT count(DISTINCT product_id) AS p FROM interactions)
SELECT DISTINCT user_id + 8589934592 AS user_id, least(10, p) AS n, CAST(least(10, p) AS INT) AS last_rank,
       least(10, p) AS n_products, {_NONE} AS n_unknown, {_NONE} AS n_rising
FROM interactions, catalogue
""",
    "rf_walked": EVENTS
    + _SPLIT_DATASET
    + "SELECT user_id, product_id, true AS equal FROM parted WHERE split = 'test'",
    "rf_fit_check": EVENTS
    + _SPLIT_DATASET
    + f"""
SELECT CAST(t.i AS INT) AS tree, count(*) AS n_rows, count(*) FILTER (WHERE label = 1) AS n_positive,
       {_NONE} AS wrong_counts, {_NONE} AS wrong_impurities, {_NONE} AS wrong_gains
FROM parted, range(10) t(i) WHERE split = 'train' GROUP BY t.i
""",
    "rf_cells_recounted": EVENTS
    + _SPLIT_DATASET
    + f"""
SELECT q.name, count(*) AS n_rows, {_NONE} AS gap
FROM parted, (VALUES ('rf_default_eval'), ('rf_holdout')) q(name) WHERE split = 'test' GROUP BY q.name
""",
    "pipeline_tables": EVENTS + _SPLIT_DATASET + _PIPELINE_TABLES,
    "als_fit": EVENTS
    + """
SELECT 'user' AS side, user_id AS id, CAST(20 AS INT) AS n_factors, true AS nonnegative
FROM interactions GROUP BY user_id
UNION ALL SELECT 'product', product_id, 20, true FROM interactions GROUP BY product_id
""",
    "als_recommend_all": EVENTS + _lists(),
    "als_recommend_subset": EVENTS + _lists(_IS_LABELLED),
    "als_named": EVENTS + _lists(more=_NAMED),
    "als_novel": EVENTS
    + f"""
, own AS (SELECT user_id, count(*) AS b FROM interactions GROUP BY 1)
SELECT user_id, least(10, p - b) AS n, CAST(least(10, p - b) AS INT) AS last_rank,
       least(10, p - b) AS n_products, {_NONE} AS n_unknown, {_NONE} AS n_rising, {_NONE} AS n_bought
FROM own, (SELECT count(DISTINCT product_id) AS p FROM interactions) WHERE p > b
""",
    "als_metrics": EVENTS
    + """
SELECT count(DISTINCT user_id) AS n_users, true AS in_bounds
FROM truth WHERE user_id IN (SELECT user_id FROM interactions)
""",
    "als_grid": EVENTS + _TUNED_USERS
    + """
SELECT g.position, g.rank, g.reg, n.n_users, true AS in_bounds
FROM (VALUES (0, 5, CAST(0.05 AS DOUBLE)), (1, 5, 0.1), (2, 10, 0.05), (3, 10, 0.1), (4, 20, 0.05),
             (5, 20, 0.1)) g(position, rank, reg),
     (SELECT count(*) AS n_users FROM tuned) n
""",
    "model_comparison": EVENTS
    + _PER_USER_METRICS
    + """
SELECT 'popularity' AS model, count(*) AS n_users, round(avg("precision"), 6) AS "precision",
       round(avg(recall), 6) AS recall, round(avg(ndcg), 6) AS ndcg, true AS in_bounds
FROM judged WHERE model = 'popular'
UNION ALL SELECT 'als', count(DISTINCT user_id), NULL, NULL, NULL, true FROM truth
""",
    "rf_scores": EVENTS
    + _SPLIT_DATASET
    + """
SELECT user_id, product_id, label, true AS in_bounds, true AS agrees FROM parted WHERE split = 'test'
""",
    "rf_default_eval": EVENTS + _SPLIT_DATASET + _TEST_LABELS,
    "rf_holdout": EVENTS + _SPLIT_DATASET + _TEST_LABELS,
    "rf_threshold_sweep": EVENTS
    + _SPLIT_DATASET
    + f"""
SELECT CAST(round(0.05 * (r.i + 2), 2) AS DOUBLE) AS threshold, l.*
FROM range(13) r(i), (SELECT {_LABELS} FROM parted WHERE split = 'validation') l
""",
    "reorder_predictions": EVENTS + _judged_pairs(),
    "user_recommendations": EVENTS + _lists(_IS_LABELLED, _NAMED),
    "user_reorders": EVENTS + _judged_pairs(_IS_LABELLED),
    "full_pipeline": EVENTS + _PROFILE,
}
