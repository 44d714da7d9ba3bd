"""SQL that states what each registered query must return.

Every statement stands alone: it starts with the marketplace views it needs,
defined over the star-schema tables, and spells the result out in plain SQL.
"""

from __future__ import annotations

VIEWS = {
    "ord": """
        SELECT order_id, customer_id, order_status,
               o_orderdate + to_hours(order_id % 24) AS bought,
               CASE WHEN order_id % 97 <> 0
                     AND (order_status <> 'shipped' OR order_id % 5 = 0)
                    THEN o_orderdate + to_days((1 + (order_id * 7919) % 40)::INTEGER)
                         + to_hours(order_id % 24) END AS arrived,
               o_orderdate + to_days(25) AS promised
        FROM (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate,
                     CASE WHEN o_orderstatus IN ('F', 'O') THEN 'delivered'
                          WHEN o_orderkey % 4 = 0 THEN 'canceled'
                          ELSE 'shipped' END AS order_status
              FROM orders)""",
    "itm": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
               l_extendedprice::DECIMAL(12,2) AS price
        FROM lineitem""",
    "cus": """
        SELECT c_custkey AS customer_id, c_custkey // 2 AS person, n_name AS customer_state
        FROM customer, nation WHERE c_nationkey = n_nationkey""",
    "prd": "SELECT p_partkey AS product_id, p_type AS product_category_name FROM part",
    "sel": """
        SELECT s_suppkey AS seller_id, n_name AS seller_state
        FROM supplier, nation WHERE s_nationkey = n_nationkey""",
    "rev": """
        SELECT CASE WHEN o_orderkey % 500 = 1 THEN o_orderkey - 1 ELSE o_orderkey END AS review_id,
               o_orderkey AS order_id, left(o_orderpriority, 1)::INTEGER AS review_score
        FROM orders WHERE o_orderkey % 10 <> 3""",
}

# The damaged views: dropped rows, then repeated rows, then keys set to NULL.
BROKEN = {
    **VIEWS,
    "ord0": VIEWS["ord"],
    "cus0": VIEWS["cus"],
    "prd0": VIEWS["prd"],
    "sel0": VIEWS["sel"],
    "ord": """
        SELECT CASE WHEN order_id % 250 <> 9 THEN order_id END AS order_id,
               CASE WHEN order_id % 450 <> 1 THEN customer_id END AS customer_id,
               order_status, bought, arrived, promised
        FROM ord0 JOIN (VALUES (1), (2)) AS copy(n) ON n = 1 OR order_id % 700 = 0
        WHERE order_id % 300 <> 5
          AND bought::DATE NOT BETWEEN DATE '1998-05-01' AND DATE '1998-05-03'""",
    "cus": """
        SELECT CASE WHEN customer_id % 90 <> 2 THEN customer_id END AS customer_id,
               person, customer_state
        FROM cus0 JOIN (VALUES (1), (2)) AS copy(n) ON n = 1 OR customer_id % 75 = 0
        WHERE customer_id % 60 <> 1""",
    "prd": """
        SELECT CASE WHEN product_id % 80 <> 5 THEN product_id END AS product_id,
               CASE WHEN product_id % 11 <> 0 THEN product_category_name END
                   AS product_category_name
        FROM prd0 JOIN (VALUES (1), (2)) AS copy(n) ON n = 1 OR product_id % 100 = 6
        WHERE product_id % 40 <> 3""",
    "sel": """
        SELECT CASE WHEN seller_id % 20 <> 9 THEN seller_id END AS seller_id, seller_state
        FROM sel0 JOIN (VALUES (1), (2)) AS copy(n) ON n = 1 OR seller_id % 25 = 4
        WHERE seller_id % 50 <> 7""",
}
TIED = {
    **VIEWS,
    "itm": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_suppkey AS seller_id,
               (100 * (1 + l_partkey % 5))::DECIMAL(12,2) AS price
        FROM lineitem""",
}
SUBCENT = {
    **VIEWS,
    "itm0": VIEWS["itm"],
    "itm": """
        SELECT order_id, product_id, seller_id,
               (CASE WHEN order_id % 3 = 0 THEN 0 ELSE price END
                + (order_id % 7 + 1)::DECIMAL(5,0) * 0.0009::DECIMAL(5,4))::DECIMAL(18,4) AS price
        FROM itm0""",
}
# DOUBLE prices, as whole multiples of 2**-30.
UNIT = 1 << 30
DOUBLES = {
    **VIEWS,
    "itm0": VIEWS["itm"],
    "itm": f"""
        SELECT order_id, product_id, seller_id,
               (CASE WHEN order_id % 3 = 0 THEN order_id % 7 + 1
                ELSE floor(price::DOUBLE / 7 * {UNIT}) END)::BIGINT AS price
        FROM itm0""",
}
HALVES = {
    **VIEWS,
    "rev0": VIEWS["rev"],
    "rev": """
        SELECT review_id, order_id,
               review_score + CASE WHEN order_id % 2 = 0 THEN 0.5 ELSE 0 END AS review_score
        FROM rev0""",
}
HURRIED = {
    **VIEWS,
    "ord0": VIEWS["ord"],
    "ord": """
        SELECT * REPLACE (bought + to_days((customer_id % 11)::INTEGER) AS promised) FROM ord0""",
}
UNESTIMATED = {
    **VIEWS,
    "ord0": VIEWS["ord"],
    "ord": "SELECT * REPLACE (CASE WHEN order_id % 13 <> 0 THEN promised END AS promised) FROM ord0",
}


def statement(body: str, views: dict[str, str] = VIEWS, **steps: str) -> str:
    """``body`` after the views and named steps it may read."""
    order = sorted(views, key=lambda name: not name.endswith("0"))
    parts = [f"{name} AS ({views[name]})" for name in order]
    parts += [f"{name} AS ({sql})" for name, sql in steps.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


def during(start: str | None = None, end: str | None = None) -> str:
    bounds = ["true"]
    if start:
        bounds.append(f"bought::DATE >= DATE '{start}'")
    if end:
        bounds.append(f"bought::DATE <= DATE '{end}'")
    return " AND ".join(bounds)


# --- sellers ---------------------------------------------------------------


def _sold(when: str, state: str | None) -> str:
    place = f" AND seller_state = '{state}'" if state else ""
    return (
        "SELECT seller_id, price, order_status, arrived, promised "
        "FROM itm JOIN ord USING (order_id) JOIN sel USING (seller_id) "
        f"WHERE {when}{place}"
    )


SELLER_SUMS = """
    SELECT seller_id,
           sum(price)::DOUBLE AS total_revenue,
           count(*) AS total_items_sold,
           avg(CASE WHEN arrived <= promised THEN 1 ELSE 0 END)
               FILTER (WHERE order_status = 'delivered' AND arrived IS NOT NULL) AS on_time_rate,
           avg(CASE WHEN order_status = 'canceled' THEN 1 ELSE 0 END) AS cancel_rate
    FROM sold GROUP BY seller_id"""
SELLER_SCORES = """
    SELECT seller_id, avg(review_score) AS avg_review
    FROM itm JOIN rev USING (order_id) GROUP BY seller_id"""
RANKED_SELLERS = """
    SELECT seller_id, total_revenue, total_items_sold, on_time_rate, avg_review, cancel_rate,
           rank() OVER (ORDER BY total_revenue DESC NULLS LAST) AS revenue_rank,
           rank() OVER (ORDER BY on_time_rate DESC NULLS LAST) AS delivery_rank,
           rank() OVER (ORDER BY avg_review DESC NULLS LAST) AS review_rank,
           rank() OVER (ORDER BY cancel_rate ASC NULLS LAST) AS cancel_rank
    FROM sums LEFT JOIN scores USING (seller_id)"""
SCORED_SELLERS = """
    SELECT *, round((revenue_rank + delivery_rank + review_rank + cancel_rank) / 4.0, 1)
                  AS composite_score
    FROM ranked"""


def sellers(body: str, when: str = "true", state: str | None = None, views=VIEWS, **more) -> str:
    return statement(
        body,
        views,
        sold=_sold(when, state),
        sums=SELLER_SUMS,
        scores=SELLER_SCORES,
        ranked=RANKED_SELLERS,
        scorecard=SCORED_SELLERS,
        **more,
    )


SELLER_BASE = """
    SELECT seller_id, price, order_status, arrived AS order_delivered_customer_date,
           promised AS order_estimated_delivery_date FROM sold"""

# --- products --------------------------------------------------------------


def _earned(when: str) -> str:
    return (
        "SELECT product_id, product_category_name, sum(price) AS revenue, count(*) AS units_sold "
        "FROM itm JOIN ord USING (order_id) LEFT JOIN prd USING (product_id) "
        f"WHERE {when} GROUP BY ALL"
    )


PRODUCT_RUN = """
    SELECT *, sum(revenue) OVER ()::DOUBLE AS whole,
           sum(revenue) OVER (ORDER BY revenue DESC NULLS LAST, product_id, product_category_name
                              ROWS UNBOUNDED PRECEDING)::DOUBLE AS so_far
    FROM earned"""
PRODUCT_CLASSES = """
    SELECT product_id, product_category_name, revenue, units_sold,
           round(revenue::DOUBLE / whole * 100, 4) AS pct_of_revenue,
           round(so_far / whole * 100, 4) AS cumulative_pct,
           CASE WHEN so_far / whole <= 0.80::DOUBLE THEN 'A'
                WHEN so_far / whole <= 0.95::DOUBLE THEN 'B' ELSE 'C' END AS abc_class
    FROM run"""
CLASS_SUMS = """
    SELECT abc_class, count(*) AS product_count, sum(revenue)::DOUBLE AS total_revenue,
           round(sum(pct_of_revenue::DECIMAL(18,4)), 2)::DOUBLE AS pct_of_total_revenue
    FROM graded GROUP BY abc_class"""


def products(body: str, when: str = "true", views=VIEWS, **more) -> str:
    return statement(
        body,
        views,
        earned=_earned(when),
        run=PRODUCT_RUN,
        graded=PRODUCT_CLASSES,
        classes=CLASS_SUMS,
        **more,
    )


PRODUCT_REVENUE = "SELECT * REPLACE (revenue::DOUBLE AS revenue) FROM earned"

# --- delivery --------------------------------------------------------------


def _transit(when: str) -> str:
    return (
        "SELECT order_id, customer_state, "
        "date_diff('day', bought::DATE, arrived::DATE) AS actual_days, "
        "date_diff('day', bought::DATE, promised::DATE) AS estimated_days "
        "FROM ord JOIN cus USING (customer_id) "
        f"WHERE order_status = 'delivered' AND arrived IS NOT NULL AND {when}"
    )


STATE_SUMS = """
    SELECT customer_state, count(*) AS total_orders,
           round(avg(actual_days), 1) AS avg_actual_days,
           round(avg(estimated_days), 1) AS avg_estimated_days,
           round(avg(actual_days - estimated_days), 1) AS avg_delay_days,
           round(count(*) FILTER (WHERE actual_days > estimated_days) * 100 / count(*)::DOUBLE, 1)
               AS pct_late
    FROM transit GROUP BY customer_state"""


def delivery(body: str, when: str = "true", views=VIEWS, **more) -> str:
    return statement(body, views, transit=_transit(when), states=STATE_SUMS, **more)


# --- retention -------------------------------------------------------------

ORDERS_OF_PEOPLE = "SELECT person, bought FROM ord JOIN cus USING (customer_id)"
DAYS_AFTER = """
    SELECT person AS customer_unique_id,
           date_diff('day', first_purchase::DATE, bought::DATE) AS days_since_first
    FROM visits JOIN firsts ON person = customer_unique_id"""
RETURNED = """
    SELECT customer_unique_id,
           max(CASE WHEN days_since_first BETWEEN 1 AND 30 THEN 1 ELSE 0 END) AS retained_30,
           max(CASE WHEN days_since_first BETWEEN 1 AND 60 THEN 1 ELSE 0 END) AS retained_60,
           max(CASE WHEN days_since_first BETWEEN 1 AND 90 THEN 1 ELSE 0 END) AS retained_90
    FROM gaps GROUP BY customer_unique_id"""
RETURN_RATES = """
    SELECT count(*) AS total_customers,
           round(avg(retained_30) * 100, 2) AS retention_30_pct,
           round(avg(retained_60) * 100, 2) AS retention_60_pct,
           round(avg(retained_90) * 100, 2) AS retention_90_pct
    FROM flags"""


def retention(body: str, when: str = "true", views=VIEWS, **more) -> str:
    firsts = (
        "SELECT person AS customer_unique_id, min(bought) AS first_purchase "
        f"FROM visits WHERE {when} GROUP BY person"
    )
    return statement(
        body,
        views,
        visits=ORDERS_OF_PEOPLE,
        firsts=firsts,
        gaps=DAYS_AFTER,
        flags=RETURNED,
        rates=RETURN_RATES,
        **more,
    )


# --- trends ----------------------------------------------------------------


def _months(when: str) -> str:
    return (
        "SELECT date_trunc('month', bought)::DATE AS order_month, count(*) AS total_orders, "
        "sum(price)::DOUBLE AS total_revenue FROM ord JOIN itm USING (order_id) "
        f"WHERE order_status <> 'canceled' AND {when} GROUP BY 1"
    )


def trend(body: str, when: str = "true", views=VIEWS) -> str:
    return statement(body, views, months=_months(when))


# --- audit -----------------------------------------------------------------

ROW_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source}"
    for name, source in (
        ("category_translation", "(SELECT DISTINCT p_type FROM part)"),
        ("customers", "cus"),
        ("geolocation", "nation"),
        ("order_items", "itm"),
        ("order_payments", "orders"),
        ("order_reviews", "rev"),
        ("orders", "ord"),
        ("products", "prd"),
        ("sellers", "sel"),
    )
)


def _nulls(table: str, view: str, *own: str) -> str:
    keys = ("order_id", "customer_id", "product_id", "seller_id")
    counts = [
        (f"sum(({k} IS NULL)::INTEGER)::BIGINT" if k in own else "0::BIGINT") + f" AS null_{k}"
        for k in keys
    ]
    return f"SELECT '{table}' AS table_name, count(*) AS total_rows, {', '.join(counts)} FROM {view}"


NULL_PROFILE = " UNION ALL ".join(
    (
        _nulls("orders", "ord", "order_id", "customer_id"),
        _nulls("customers", "cus", "customer_id"),
        _nulls("products", "prd", "product_id"),
        _nulls("sellers", "sel", "seller_id"),
    )
)


def _orphans(key: str, child: str, parent: str) -> str:
    return (
        f"(SELECT count(*) FROM {child} WHERE NOT EXISTS "
        f"(FROM {parent} WHERE {parent}.{key} = {child}.{key})) AS orphan_{key}"
    )


ORPHAN_KEYS = "SELECT " + ", ".join(
    (
        _orphans("customer_id", "ord", "cus"),
        _orphans("order_id", "itm", "ord"),
        _orphans("product_id", "itm", "prd"),
        _orphans("seller_id", "itm", "sel"),
    )
)
MISSING_DAYS = """
    SELECT g::DATE AS date
    FROM generate_series((SELECT min(bought::DATE) FROM ord)::TIMESTAMP,
                         (SELECT max(bought::DATE) FROM ord)::TIMESTAMP, INTERVAL 1 DAY) AS t(g)
    WHERE g::DATE NOT IN (SELECT bought::DATE FROM ord WHERE bought IS NOT NULL)"""
DATE_GAPS = f"""
    SELECT min(bought::DATE) AS start_date, max(bought::DATE) AS end_date,
           (SELECT count(*) FROM ({MISSING_DAYS})) AS missing_days
    FROM ord"""


def _repeats(name: str, view: str, key: str) -> str:
    return (
        f"(SELECT count(*) FROM (SELECT {key} FROM {view} GROUP BY {key} HAVING count(*) > 1)) "
        f"AS duplicate_{name}"
    )


DUPLICATE_KEYS = "SELECT " + ", ".join(
    (
        _repeats("orders", "ord", "order_id"),
        _repeats("customers", "cus", "customer_id"),
        _repeats("products", "prd", "product_id"),
        _repeats("sellers", "sel", "seller_id"),
        _repeats("reviews", "rev", "review_id"),
    )
)

# --- checks ----------------------------------------------------------------


def _check(name: str, item: str, seen: str, wanted: str, passed: str, source: str, level="fail"):
    return (
        f"SELECT '{name}' AS \"check\", '{item}' AS item, "
        f"coalesce(({seen})::VARCHAR, 'none') AS observed, '{wanted}' AS expected, "
        f"coalesce({passed}, false) AS passed, '{level}' AS severity FROM {source}"
    )


TABLE_CHECK = " UNION ALL ".join(
    f"SELECT 'tables_exist' AS \"check\", '{t}' AS item, 'present' AS observed, "
    "'present' AS expected, true AS passed, 'fail' AS severity"
    for t in (
        "category_translation",
        "customers",
        "geolocation",
        "order_items",
        "order_payments",
        "order_reviews",
        "orders",
        "products",
        "sellers",
    )
)
KEY_CHECK = " UNION ALL ".join(
    _check("key_columns", f"{t}.{k}", f"count({k})", ">= 1", f"count({k}) > 0", view)
    for t, k, view in (
        ("orders", "order_id", "ord"),
        ("customers", "customer_id", "cus"),
        ("products", "product_id", "prd"),
        ("sellers", "seller_id", "sel"),
    )
)
SIZE_CHECK = " UNION ALL ".join(
    _check("row_counts", t, "count(*)", ">= 1000", "count(*) >= 1000", view)
    for t, view in (("orders", "ord"), ("order_items", "itm"), ("customers", "cus"))
)


def date_check(min_year: int, as_of: str) -> str:
    item = "orders.order_purchase_timestamp"
    low, high = "min(bought::DATE)", "max(bought::DATE)"
    rows = [
        _check("dates_present", item, low, "any date", f"{low} IS NOT NULL", "ord"),
        _check("dates_not_ahead", item, high, f"<= {as_of}", f"{high} <= DATE '{as_of}'", "ord")
        .replace("'fail' AS severity", "'warn' AS severity"),
        _check(
            "dates_not_too_early", item, low, f"year >= {min_year}", f"year({low}) >= {min_year}",
            "ord",
        ),
    ]
    return " UNION ALL ".join(rows)


def all_checks(min_year: int, as_of: str) -> str:
    return " UNION ALL ".join((TABLE_CHECK, KEY_CHECK, date_check(min_year, as_of), SIZE_CHECK))


INCOMPLETE = """
    SELECT * FROM found WHERE item NOT IN ('geolocation', 'sellers.seller_id')
    UNION ALL SELECT 'tables_exist', 'geolocation', 'missing', 'present', false, 'fail'
    UNION ALL SELECT 'key_columns', 'sellers.seller_id', 'none', '>= 1', false, 'fail'"""

# --- reports ---------------------------------------------------------------

TOP_STATES = """
    SELECT customer_state, avg_delay_days, total_orders FROM states
    ORDER BY avg_delay_days DESC NULLS LAST, customer_state LIMIT 15"""
TOP_SELLERS = """
    SELECT seller_id, total_revenue, on_time_rate, avg_review, cancel_rate, composite_score
    FROM scorecard ORDER BY composite_score, seller_id LIMIT 20"""
MONTH_SHEET = "SELECT * REPLACE (strftime(order_month, '%Y-%m-%d') AS order_month) FROM months"
RATE_TILES = " UNION ALL ".join(
    f"SELECT '{n}-Day Retention' AS metric, retention_{n}_pct::VARCHAR || '%' AS value FROM rates"
    for n in (30, 60, 90)
)
INSIGHT = """
    SELECT 'Class A products (' || format('{:,}', a.product_count) || ' items) generate '
           || a.pct_of_total_revenue || '% of all revenue, following a classic Pareto '
           || 'distribution. Class C (' || format('{:,}', c.product_count)
           || ' items) contributes only ' || c.pct_of_total_revenue || '%.' AS insight
    FROM classes a, classes c WHERE a.abc_class = 'A' AND c.abc_class = 'C'"""
FINDINGS = """
    SELECT 'Seller Scorecard' AS topic, format('{:,}', count(*))
           || ' active sellers ranked by composite score' AS finding FROM scorecard
    UNION ALL SELECT 'Delivery Analysis', customer_state || ' experiences the most delays '
           || 'vs. estimates (' || avg_delay_days || ' days on average)'
           FROM (FROM states ORDER BY avg_delay_days DESC NULLS LAST, customer_state LIMIT 1)
    UNION ALL SELECT 'ABC Classification', 'Class A (' || format('{:,}', product_count)
           || ' products) drives ' || pct_of_total_revenue || '% of revenue'
           FROM classes WHERE abc_class = 'A'
    UNION ALL SELECT 'Customer Retention', 'Only ' || retention_90_pct
           || '% of customers return within 90 days' FROM rates"""


def findings(views=VIEWS) -> str:
    return sellers(
        FINDINGS,
        views=views,
        transit=_transit("true"),
        states=STATE_SUMS,
        earned=_earned("true"),
        run=PRODUCT_RUN,
        graded=PRODUCT_CLASSES,
        classes=CLASS_SUMS,
        visits=ORDERS_OF_PEOPLE,
        firsts="SELECT person AS customer_unique_id, min(bought) AS first_purchase "
        "FROM visits GROUP BY person",
        gaps=DAYS_AFTER,
        flags=RETURNED,
        rates=RETURN_RATES,
    )
