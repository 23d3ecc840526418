"""SQL for the registry, written for DuckDB on the driver's tables.

The statements state the results on their own terms (arg_max, FILTER, QUALIFY, self-joins), so
that agreement with Spark means something. `shaped` gives the final columns comparable types.
"""

from __future__ import annotations

# Kinds of output columns: bigint, double to 6 decimals, money to 2, text, date, timestamp, flag.
_KINDS = {
    "n": "CAST({c} AS BIGINT)",
    "r": "round_even(CAST({c} AS DOUBLE) * 1e6::DOUBLE, 0) / 1e6::DOUBLE + 0.0::DOUBLE",
    "m": "round_even(CAST({c} AS DOUBLE) * 1e2::DOUBLE, 0) / 1e2::DOUBLE + 0.0::DOUBLE",
    "s": "CAST({c} AS VARCHAR)",
    "d": "STRFTIME({c}, '%Y-%m-%d')",
    "t": "STRFTIME({c}, '%Y-%m-%d %H:%M:%S')",
    "b": "CAST({c} AS VARCHAR)",
}

# Named subqueries and what each is built on.
_CTES: dict[str, str] = {
    "o": """
        SELECT o_orderkey AS order_id, o_custkey AS person,
               CASE WHEN o_orderstatus = 'P' THEN
                        CASE o_orderpriority WHEN '1-URGENT' THEN 'canceled'
                             WHEN '2-HIGH' THEN 'canceled'
                             WHEN '3-MEDIUM' THEN 'unavailable' ELSE 'delivered' END
                    WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'shipped'
                    ELSE 'delivered' END AS status,
               o_orderdate + to_hours(o_orderkey % 24) AS bought,
               CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN NULL
                    ELSE o_orderdate + to_hours(o_orderkey % 24)
                         + to_hours(24 + CAST(floor(o_totalprice) AS BIGINT) % 720) END AS arrived,
               o_orderdate + to_days(11 + 4 * CAST(o_orderpriority[1] AS INTEGER)) AS due
        FROM orders""",
    "cust": """
        SELECT o_orderkey AS customer_id, o_custkey AS person,
               lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip,
               c_mktsegment AS city, n_name AS state
        FROM orders, customer, nation
        WHERE o_custkey = c_custkey AND c_nationkey = n_nationkey""",
    "sell": """
        SELECT s_suppkey AS seller_id, lpad(CAST(s_nationkey AS VARCHAR), 5, '0') AS zip,
               s_name AS city, n_name AS state
        FROM supplier, nation WHERE s_nationkey = n_nationkey""",
    "geo": """
        SELECT lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip, AVG(la) AS lat, AVG(ln) AS lng
        FROM (SELECT c_nationkey,
                     c_nationkey * 1.1::DOUBLE - 30 + c_acctbal / 100000
                       + CASE WHEN c_mktsegment = 'MACHINERY' OR c_nationkey = 24
                              THEN 90 ELSE 0 END AS la,
                     c_nationkey * 1.3::DOUBLE - 70 + c_acctbal / 100000 AS ln
              FROM customer)
        WHERE la >= -34 AND la <= 6 AND ln >= -74 AND ln <= -34
        GROUP BY c_nationkey""",
    "rev": """
        SELECT l_orderkey AS order_id, 1 + CAST(floor(l_quantity) AS BIGINT) % 5 AS score,
               l_shipdate - INTERVAL 1 DAY AS created, l_shipdate AS answered,
               l_linestatus = 'O' AS has_comment
        FROM lineitem WHERE l_returnflag <> 'N'
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY l_orderkey
            ORDER BY l_shipdate DESC, concat_ws('-', l_linenumber, l_partkey, l_suppkey)) = 1""",
    "prod": """
        SELECT p_partkey AS product_id,
               CASE WHEN p_brand = 'Brand#2' THEN 'unknown'
                    WHEN p_type IN ('STANDARD', 'LARGE') THEN p_type
                    ELSE lower(p_type) END AS category,
               CASE WHEN p_brand <> 'Brand#1' THEN CAST(p_size AS DOUBLE) END AS weight_g
        FROM part""",
    "lines": """
        SELECT l_orderkey AS order_id, COUNT(*) AS item_count,
               COUNT(DISTINCT l_suppkey) AS seller_count, SUM(l_extendedprice) AS item_value,
               SUM(l_extendedprice * l_tax) AS freight_value
        FROM lineitem GROUP BY l_orderkey""",
    "top_line": """
        SELECT l_orderkey AS order_id, l_suppkey AS seller_id, l_partkey AS product_id,
               l_extendedprice AS price
        FROM lineitem
        QUALIFY ROW_NUMBER() OVER (
            PARTITION BY l_orderkey
            ORDER BY l_extendedprice DESC, l_linenumber, l_partkey DESC, l_suppkey DESC) = 1""",
    "pay": """
        SELECT l_orderkey AS order_id,
               SUM(l_extendedprice * (1 - l_discount) * (1 + l_tax)) AS paid_value,
               MAX(l_linenumber) AS installments
        FROM lineitem GROUP BY l_orderkey""",
    "due_days": """
        SELECT *, CAST(arrived AS DATE) - CAST(due AS DATE) AS days_late
        FROM o WHERE status = 'delivered' AND arrived IS NOT NULL""",
    "timing": """
        SELECT order_id, person, bought, arrived, due, days_late, days_late > 0 AS is_late,
               CAST(arrived AS DATE) - CAST(bought AS DATE) AS delivery_days,
               CAST(due AS DATE) - CAST(bought AS DATE) AS promised_days,
               make_date(year(bought), month(bought), 1) AS order_month,
               CASE WHEN days_late >= 15 THEN '4 15+ days late'
                    WHEN days_late >= 8 THEN '3 8-14 days late'
                    WHEN days_late >= 4 THEN '2 4-7 days late'
                    WHEN days_late >= 1 THEN '1 1-3 days late'
                    ELSE '0 On time' END AS lateness_bucket
        FROM due_days""",
    "f": """
        SELECT x.*, rev.score, rev.score < 3 AS negative, rev.has_comment,
               lines.* EXCLUDE (order_id), pay.paid_value, pay.installments,
               cust.state AS customer_state, cust.city AS customer_city,
               sell.seller_id AS main_seller_id, sell.state AS seller_state,
               prod.category AS main_category, cust.state = sell.state AS same_state,
               2 * 6371 * asin(sqrt(
                   pow(sin((radians(cg.lat) - radians(sg.lat)) / 2), 2)
                   + pow(sin((radians(cg.lng) - radians(sg.lng)) / 2), 2)
                     * cos(radians(cg.lat)) * cos(radians(sg.lat)))) AS distance_km
        FROM timing x
        INNER JOIN lines USING (order_id) INNER JOIN top_line USING (order_id)
        INNER JOIN cust ON cust.customer_id = x.order_id INNER JOIN sell USING (seller_id)
        LEFT OUTER JOIN prod USING (product_id) LEFT OUTER JOIN pay USING (order_id)
        LEFT OUTER JOIN rev USING (order_id)
        LEFT OUTER JOIN geo cg ON cg.zip = cust.zip LEFT OUTER JOIN geo sg ON sg.zip = sell.zip""",
    "seq": """
        SELECT cust.person, order_id, bought,
               COUNT(*) OVER (PARTITION BY cust.person ORDER BY bought, order_id) AS order_seq,
               MIN(bought) OVER (PARTITION BY cust.person ORDER BY bought, order_id
                                 ROWS BETWEEN 1 FOLLOWING AND 1 FOLLOWING) AS next_bought
        FROM o INNER JOIN cust ON cust.customer_id = order_id
        WHERE status <> 'canceled' AND status <> 'unavailable'""",
    "back": """
        SELECT one.order_id, MIN(later.bought) AS next_order_at
        FROM seq one INNER JOIN f USING (order_id)
        LEFT OUTER JOIN seq later
          ON later.person = one.person AND later.order_seq >= 2 AND later.bought > f.arrived
        WHERE one.order_seq = 1 GROUP BY one.order_id""",
    "r": """
        SELECT f.*, next_order_at,
               CAST(next_order_at AS DATE) - CAST(arrived AS DATE) AS days_to_next,
               next_order_at IS NOT NULL
                 AND CAST(next_order_at AS DATE) - CAST(arrived AS DATE) <= 180 AS repeated,
               arrived + to_days(180) <= (SELECT MAX(bought) FROM o) AS mature
        FROM back INNER JOIN f USING (order_id)""",
    "lateness": """
        SELECT lateness_bucket, orders, orders / (SELECT COUNT(score) FROM f) AS share_of_orders,
               avg_review, negative_review_rate, mature_first_orders, repeat_rate
        FROM (SELECT lateness_bucket, COUNT(score) AS orders, AVG(score) AS avg_review,
                     COUNT(*) FILTER (WHERE negative) / COUNT(score) AS negative_review_rate
              FROM f WHERE score IS NOT NULL GROUP BY lateness_bucket)
        LEFT OUTER JOIN (
              SELECT lateness_bucket, COUNT(*) AS mature_first_orders,
                     AVG(repeated::INTEGER) AS repeat_rate
              FROM r WHERE mature GROUP BY lateness_bucket) USING (lateness_bucket)""",
    "late_split": """
        SELECT if(is_late, 'Late', 'On time') AS delivery, COUNT(*) AS orders,
               AVG(score) AS avg_review, AVG((score <= 2)::INTEGER) AS negative_review_rate,
               AVG((score = 5)::INTEGER) AS five_star_rate, AVG(delivery_days) AS avg_delivery_days
        FROM f WHERE score IS NOT NULL GROUP BY ALL""",
    "repeat_split": """
        SELECT if(is_late, 'Late', 'On time') AS first_delivery, COUNT(*) AS customers,
               COUNT(*) FILTER (WHERE repeated) AS repeat_customers,
               AVG(repeated::INTEGER) AS repeat_rate
        FROM r WHERE mature GROUP BY ALL""",
    "state": """
        SELECT *, 1 + (SELECT COUNT(*) FROM st AS worse WHERE worse.late_rate > st.late_rate)
                  AS late_rank
        FROM st""",
    "st": """
        SELECT customer_state, COUNT(*) AS orders, AVG(is_late::INTEGER) AS late_rate,
               AVG(delivery_days) AS avg_delivery_days, AVG(promised_days) AS avg_promised_days,
               AVG(distance_km) AS avg_distance_km, AVG(score) AS avg_review
        FROM f GROUP BY customer_state""",
    "seller": """
        SELECT *, late_orders / (SELECT SUM(late_orders) FROM se) AS share_of_all_late_orders,
               NTILE(10) OVER (ORDER BY late_rate DESC, seller_id) AS late_rate_decile
        FROM se""",
    "se": """
        SELECT main_seller_id AS seller_id, any_value(seller_state) AS seller_state,
               COUNT(*) AS orders, COUNT(*) FILTER (WHERE is_late) AS late_orders,
               AVG(is_late::INTEGER) AS late_rate, AVG(score) AS avg_review,
               SUM(item_value) AS item_value
        FROM f GROUP BY main_seller_id HAVING COUNT(*) > 109""",
    "monthly": """
        SELECT order_month, COUNT(*) AS orders, AVG(is_late::INTEGER) AS late_rate,
               AVG(score) AS avg_review, AVG(delivery_days) AS avg_delivery_days
        FROM f GROUP BY order_month""",
    "distance": """
        SELECT distance_band, COUNT(*) AS orders, AVG(is_late::INTEGER) AS late_rate,
               AVG(delivery_days) AS avg_delivery_days, AVG(promised_days) AS avg_promised_days,
               AVG(score) AS avg_review
        FROM (SELECT *, coalesce(CASE WHEN distance_km >= 2000 THEN '5 2,000+ km'
                                      WHEN distance_km >= 1000 THEN '4 1,000-1,999 km'
                                      WHEN distance_km >= 500 THEN '3 500-999 km'
                                      WHEN distance_km >= 100 THEN '2 100-499 km'
                                      WHEN distance_km >= 0 THEN '1 <100 km' END,
                                 '9 Unknown') AS distance_band FROM f)
        GROUP BY distance_band""",
    "deciles": """
        SELECT late_rate_decile, COUNT(*) AS sellers, SUM(orders) AS orders,
               SUM(late_orders) / SUM(orders) AS late_rate, AVG(avg_review) AS avg_review
        FROM seller GROUP BY late_rate_decile""",
    "counts": """
        SELECT COUNT(*) FILTER (WHERE NOT is_late) AS n1, COUNT(*) FILTER (WHERE is_late) AS n2,
               COUNT(*) FILTER (WHERE NOT is_late AND repeated) AS x1,
               COUNT(*) FILTER (WHERE is_late AND repeated) AS x2
        FROM r WHERE mature""",
    "counts_by": """
        SELECT customer_state, COUNT(*) FILTER (WHERE NOT is_late) AS n1,
               COUNT(*) FILTER (WHERE is_late) AS n2,
               COUNT(*) FILTER (WHERE NOT is_late AND repeated) AS x1,
               COUNT(*) FILTER (WHERE is_late AND repeated) AS x2
        FROM r WHERE mature GROUP BY customer_state""",
    "bi_label": """
        SELECT *, lateness_bucket[3:] AS lateness_label,
               CASE WHEN distance_km < 100 THEN '<100 km' WHEN distance_km < 500 THEN '100-499 km'
                    WHEN distance_km < 1000 THEN '500-999 km'
                    WHEN distance_km < 2000 THEN '1,000-1,999 km'
                    ELSE '2,000+ km' END AS distance_label
        FROM f""",
}

_USES = {
    "due_days": ["o"],
    "timing": ["due_days"],
    "f": ["timing", "lines", "top_line", "cust", "sell", "prod", "pay", "rev", "geo"],
    "seq": ["o", "cust"],
    "back": ["seq", "f"],
    "r": ["back", "f", "o"],
    "lateness": ["f", "r"],
    "late_split": ["f"],
    "repeat_split": ["r"],
    "st": ["f"],
    "state": ["st"],
    "se": ["f"],
    "seller": ["se"],
    "monthly": ["f"],
    "distance": ["f"],
    "deciles": ["seller"],
    "counts": ["r"],
    "counts_by": ["r"],
    "bi_label": ["f"],
}


def _with(uses: list[str]) -> str:
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in _USES.get(name, []):
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in uses:
        add(name)
    if not ordered:
        return ""
    return "WITH " + ",\n".join(f"{name} AS ({_CTES[name]})" for name in ordered) + "\n"


def shaped(columns: str, uses: str, body: str) -> str:
    """`columns` is `name:kind ...`; `body` yields those names from the tables and `uses`."""
    picked = []
    for item in columns.split():
        name, kind = item.split(":")
        picked.append(f"{_KINDS[kind].format(c=name)} AS {name}")
    return f"{_with(uses.split())}SELECT {', '.join(picked)} FROM ({body}) AS result"


_FACT = """order_id, person AS customer_unique_id, bought AS purchased_at, order_month,
    arrived AS delivered_at, due AS estimated_at, delivery_days, promised_days, days_late, is_late,
    lateness_bucket, score AS review_score, negative AS is_negative_review, has_comment,
    item_count, seller_count, item_value, freight_value, paid_value, installments, customer_state,
    customer_city, main_seller_id, seller_state, main_category, same_state, distance_km"""
_EXTRACT_COLUMNS = """order_id:n purchased_at:t order_month:d delivered_at:t estimated_at:t
    delivery_days:n promised_days:n days_late:n is_late:b lateness_bucket:s review_score:n
    is_negative_review:b has_comment:b item_count:n seller_count:n item_value:m freight_value:r
    paid_value:r installments:n customer_state:s customer_city:s main_seller_id:n seller_state:s
    main_category:s same_state:b distance_km:r"""
_FACT_COLUMNS = "customer_unique_id:n " + _EXTRACT_COLUMNS
_RETENTION = f"""SELECT {_FACT}, next_order_at, days_to_next AS days_to_next_order,
    repeated AS repeat_in_window, mature AS is_mature FROM r"""
_RETENTION_COLUMNS = (
    _FACT_COLUMNS + " next_order_at:t days_to_next_order:n repeat_in_window:b is_mature:b"
)
_SEQUENCE = """SELECT person AS customer_unique_id, order_id, bought AS purchased_at, order_seq,
    next_bought AS next_purchased_at FROM seq"""
_SEQUENCE_COLUMNS = """customer_unique_id:n order_id:n purchased_at:t order_seq:n
    next_purchased_at:t"""
_LATENESS_COLUMNS = """lateness_bucket:s orders:n share_of_orders:r avg_review:r
    negative_review_rate:r mature_first_orders:n repeat_rate:r"""
_STATE_COLUMNS = """customer_state:s orders:n late_rate:r avg_delivery_days:r avg_promised_days:r
    avg_distance_km:r avg_review:r late_rank:n"""
_MONTHLY_COLUMNS = "order_month:d orders:n late_rate:r avg_review:r avg_delivery_days:r"
_DISTANCE_COLUMNS = """distance_band:s orders:n late_rate:r avg_delivery_days:r
    avg_promised_days:r avg_review:r"""
_BI_COLUMNS = """orders:n late_orders:n late_rate:r avg_review:r negative_review_rate:r
    avg_distance_km:r"""
_BI = """COUNT(*) AS orders, SUM(is_late::INTEGER) AS late_orders,
    AVG(is_late::INTEGER) AS late_rate, AVG(score) AS avg_review,
    AVG((score <= 2)::INTEGER) AS negative_review_rate, AVG(distance_km) AS avg_distance_km"""

# Extracts of the marts: the subquery that holds each, its key and its figures.
_MART_EXTRACTS = {
    "lateness": ("lateness", _LATENESS_COLUMNS),
    "state": ("state", _STATE_COLUMNS),
    "seller": (
        "seller",
        "seller_id:n orders:n late_orders:n late_rate:r avg_review:r item_value:m "
        "share_of_all_late_orders:r late_rate_decile:n",
    ),
    "monthly": ("monthly", _MONTHLY_COLUMNS),
    "distance": ("distance", _DISTANCE_COLUMNS),
    "late_vs_ontime": (
        "late_split",
        "delivery:s orders:n avg_review:r negative_review_rate:r five_star_rate:r avg_delivery_days:r",
    ),
    "retention_late_vs_ontime": (
        "repeat_split",
        "first_delivery:s customers:n repeat_customers:n repeat_rate:r",
    ),
}


def _figures() -> str:
    """A row per extract, group and figure."""
    parts = []
    for extract, (source, columns) in _MART_EXTRACTS.items():
        key, *figures = columns.split()
        item = _KINDS[key.split(":")[1]].format(c=key.split(":")[0])
        for figure in figures:
            name, kind = figure.split(":")
            parts.append(
                f"SELECT '{extract}' AS extract, CAST({item} AS VARCHAR) AS item, "
                f"'{name}' AS figure, CAST({_KINDS[kind].format(c=name)} AS DOUBLE) AS value FROM {source}"
            )
    uses = " ".join(source for source, _ in _MART_EXTRACTS.values())
    return shaped("extract:s item:s figure:s value:r", uses, " UNION ALL ".join(parts))


_TEST_COLUMNS = """on_time_customers:n late_customers:n on_time_repeat:n late_repeat:n p1:r p2:r
    diff:r relative_diff:r z:r ci_low:r ci_high:r"""


def _ztest(counts: str, keys: str = "") -> str:
    """z from a 2x2 chi-square identity; the p-value from the power series of erf."""
    return f"""
        SELECT *, n1 AS on_time_customers, n2 AS late_customers, x1 AS on_time_repeat,
               x2 AS late_repeat, if(p1 = 0, 'nan'::DOUBLE, diff / p1) AS relative_diff,
               diff - 1.96 * se AS ci_low,
               diff + 1.96 * se AS ci_high,
               (SELECT 1 - exp(-z * z / 2) * SUM(pow(abs(z) / sqrt(2), 2 * k + 1) / gamma(k + 1.5))
                FROM range(0, 120) AS terms(k)) AS p_value
        FROM (SELECT *, p1 - p2 AS diff,
                     sqrt(p1 * (1 - p1) / n1 + p2 * (1 - p2) / n2) AS se,
                     (x1::DOUBLE * (n2 - x2) - x2::DOUBLE * (n1 - x1)) * sqrt(n1::DOUBLE + n2)
                       / nullif(sqrt(n1::DOUBLE * n2 * (x1 + x2) * (n1 + n2 - x1 - x2)), 0) AS z
              FROM (SELECT *, x1 / nullif(n1, 0) AS p1, x2 / nullif(n2, 0) AS p2 FROM {counts}))"""


def _checks() -> str:
    gone = "SELECT '{name}' AS check_name, COUNT(*) AS failing_rows FROM {rows}"
    return " UNION ALL ".join(
        gone.format(name=name, rows=rows)
        for name, rows in {
            "Duplicate order IDs in fct_orders": """
                f WHERE order_id IN (SELECT order_id FROM f GROUP BY order_id HAVING COUNT(*) > 1)
                """,
            "Orders without a customer": """
                orders WHERE NOT EXISTS (FROM cust WHERE customer_id = o_orderkey)""",
            "Order items with an unknown seller": """
                lineitem WHERE l_suppkey NOT IN (SELECT seller_id FROM sell)""",
            "Order items with an unknown product": """
                lineitem WHERE l_partkey NOT IN (SELECT product_id FROM prod)""",
            "More than one review per order after dedupe": """
                (SELECT order_id FROM rev GROUP BY order_id HAVING COUNT(*) > 1)""",
            "Review scores outside 1-5": "rev WHERE score < 1 OR score > 5",
            "Delivered before purchase": "f WHERE bought > arrived",
            "Negative prices or freight": """
                lineitem WHERE l_extendedprice < 0 OR l_extendedprice * l_tax < 0""",
            "Distance over 5,000 km (bad coordinates)": "f WHERE distance_km > 5000",
            "Customers with more than one first order": """
                (SELECT person FROM r GROUP BY person HAVING COUNT(*) > 1)""",
        }.items()
    )


def statements() -> dict[str, str]:
    return {
        "csv_roundtrip": shaped(
            "order_id:n order_status:s purchased_at:t delivered_at:t line_numbers:n item_value:m",
            "o",
            """SELECT order_id, status AS order_status, bought AS purchased_at,
                      arrived AS delivered_at, SUM(l_linenumber) AS line_numbers,
                      SUM(l_extendedprice) AS item_value
               FROM o INNER JOIN lineitem ON l_orderkey = order_id GROUP BY ALL""",
        ).replace("CAST(order_id AS BIGINT)", "CAST(order_id AS VARCHAR)"),
        "table_roundtrip": shaped(
            "order_month:d orders:n days_late:n",
            "f",
            "SELECT order_month, COUNT(*) AS orders, SUM(days_late) AS days_late FROM f GROUP BY 1",
        ),
        "extract_orders": shaped(_EXTRACT_COLUMNS, "f", f"SELECT {_FACT} FROM f"),
        "extract_roundtrip": shaped(_MONTHLY_COLUMNS, "monthly", "FROM monthly"),
        "stage_orders": shaped(
            "order_id:s customer_id:s order_status:s purchased_at:t approved_at:t shipped_at:t "
            "delivered_at:t estimated_at:t",
            "o",
            """SELECT order_id, order_id AS customer_id, status AS order_status,
                      bought AS purchased_at, bought + INTERVAL 1 HOUR AS approved_at,
                      bought + INTERVAL 24 HOUR AS shipped_at, arrived AS delivered_at,
                      due AS estimated_at FROM o""",
        ),
        "stage_customers": shaped(
            "customer_id:s customer_unique_id:s customer_zip:s customer_city:s customer_state:s",
            "cust",
            """SELECT customer_id, person AS customer_unique_id, zip AS customer_zip,
                      city AS customer_city, state AS customer_state FROM cust""",
        ),
        "stage_order_items": shaped(
            "order_id:s order_item_id:n product_id:s seller_id:s price:r freight:r",
            "",
            """SELECT l_orderkey AS order_id, l_linenumber AS order_item_id,
                      l_partkey AS product_id, l_suppkey AS seller_id, l_extendedprice AS price,
                      l_tax * l_extendedprice AS freight FROM lineitem""",
        ),
        "stage_payments": shaped(
            "order_id:s payment_type:s installments:n payment_value:r",
            "",
            """SELECT l_orderkey AS order_id, l_linestatus AS payment_type,
                      l_linenumber AS installments,
                      l_extendedprice * (1 - l_discount) * (1 + l_tax) AS payment_value
               FROM lineitem""",
        ),
        "stage_reviews": shaped(
            "order_id:s review_score:n review_created_at:t review_answered_at:t has_comment:b",
            "rev",
            """SELECT order_id, score AS review_score, created AS review_created_at,
                      answered AS review_answered_at, has_comment FROM rev""",
        ),
        "stage_products": shaped("product_id:s category:s weight_g:r", "prod", "FROM prod"),
        "stage_sellers": shaped(
            "seller_id:s seller_zip:s seller_city:s seller_state:s",
            "sell",
            """SELECT seller_id, zip AS seller_zip, city AS seller_city, state AS seller_state
               FROM sell""",
        ),
        "stage_zip_geo": shaped("zip:s lat:r lng:r", "geo", "FROM geo"),
        "order_timing": shaped(
            "order_id:n order_month:d delivery_days:n promised_days:n days_late:n is_late:b "
            "window_start:t",
            "timing",
            "SELECT *, arrived - INTERVAL 180 DAY AS window_start FROM timing",
        ),
        "lateness_bucket": shaped(
            "lateness_bucket:s orders:n least_days:n most_days:n",
            "timing",
            """SELECT lateness_bucket, COUNT(*) AS orders, MIN(days_late) AS least_days,
                      MAX(days_late) AS most_days FROM timing GROUP BY lateness_bucket""",
        ),
        "string_funcs": shaped(
            "c_custkey:n short_code:s long_code:s label:s has_wxyz:b",
            "",
            """SELECT c_custkey, format('{:05d}', c_nationkey) AS short_code,
                      left(c_name, 5) AS long_code, right(c_name, -2) AS label,
                      trim(translate(c_mktsegment, 'ABCDEFGHIJKLMNOPQRSTUV',
                                     repeat(' ', 22))) <> '' AS has_wxyz
               FROM customer""",
        ),
        "month_label": shaped(
            "label:s orders:n month:d",
            "",
            """SELECT strftime(o_orderdate, '%b %Y') AS label, COUNT(*) AS orders,
                      CAST(MIN(date_trunc('month', o_orderdate)) AS DATE) AS month
               FROM orders GROUP BY label""",
        ),
        "number_format": shaped(
            "o_orderpriority:s o_orderstatus:s orders:s highest_price:s dear:s",
            "",
            """SELECT o_orderpriority, o_orderstatus, format('{:,}', COUNT(*)) AS orders,
                      CASE WHEN o_orderstatus = 'F'
                           THEN format('{:.1f}', round(MAX(o_totalprice), 1)) END AS highest_price,
                      CASE WHEN o_orderstatus = 'F'
                           THEN format('{:.1f}%', round(100.0 * COUNT(*) FILTER
                                (WHERE o_totalprice > 100000) / COUNT(*), 1)) END AS dear
               FROM orders GROUP BY o_orderpriority, o_orderstatus""",
        ),
        "zip_geo": shaped(
            "geolocation_zip_code_prefix:s lat:r lng:r",
            "geo",
            """SELECT CAST(CAST(zip AS INTEGER) AS VARCHAR) AS geolocation_zip_code_prefix,
                      lat, lng FROM geo""",
        ),
        "distance_km": shaped(
            "customer_zip:s seller_zip:s lines:n distance_km:r distance_band:s",
            "cust sell geo",
            """SELECT *, CASE WHEN distance_km IS NULL THEN '9 Unknown'
                              WHEN distance_km >= 2000 THEN '5 2,000+ km'
                              WHEN distance_km >= 1000 THEN '4 1,000-1,999 km'
                              WHEN distance_km >= 500 THEN '3 500-999 km'
                              WHEN distance_km >= 100 THEN '2 100-499 km'
                              ELSE '1 <100 km' END AS distance_band
               FROM (SELECT cust.zip AS customer_zip, sell.zip AS seller_zip, COUNT(*) AS lines,
                            any_value(12742 * asin(sqrt(
                                pow(sin(radians(cg.lat - sg.lat) / 2), 2)
                                + cos(radians(sg.lat)) * cos(radians(cg.lat))
                                  * pow(sin(radians(cg.lng - sg.lng) / 2), 2)))) AS distance_km
                     FROM lineitem INNER JOIN cust ON customer_id = l_orderkey
                     INNER JOIN sell ON seller_id = l_suppkey
                     LEFT OUTER JOIN geo cg ON cg.zip = cust.zip
                     LEFT OUTER JOIN geo sg ON sg.zip = sell.zip
                     GROUP BY cust.zip, sell.zip)""",
        ),
        "bi_distance_band": shaped(
            "distance_label:s " + _BI_COLUMNS,
            "bi_label",
            f"SELECT distance_label, {_BI} FROM bi_label GROUP BY distance_label",
        ),
        "join_inner": shaped(
            "seller_state:s customer_state:s lines:n item_value:m",
            "cust sell",
            """SELECT sell.state AS seller_state, cust.state AS customer_state,
                      COUNT(*) AS lines, SUM(l_extendedprice) AS item_value
               FROM lineitem, cust, sell
               WHERE l_suppkey = seller_id AND l_orderkey = customer_id GROUP BY ALL""",
        ),
        "join_left": shaped(
            "order_id:n paid_value:r installments:n review_score:n has_comment:b",
            "o pay rev",
            """SELECT order_id, paid_value, installments, score AS review_score, has_comment
               FROM o LEFT OUTER JOIN pay USING (order_id) LEFT OUTER JOIN rev USING (order_id)""",
        ),
        "check_orphans": shaped(
            "check_name:s failing_rows:n",
            "",
            """SELECT 'unknown part' AS check_name, COUNT(*) AS failing_rows FROM lineitem
               WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <= 25)
               UNION ALL
               SELECT 'unknown supplier', COUNT(*) FROM lineitem
               WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)""",
        ),
        "agg_items": shaped(
            "order_id:n item_count:n seller_count:n item_value:m freight_value:r",
            "lines",
            "FROM lines",
        ),
        "agg_payments": shaped("order_id:n paid_value:r installments:n", "pay", "FROM pay"),
        "late_rate": shaped(
            "main_category:s late_rate:r negative_review_rate:r late_orders:n",
            "f",
            """SELECT main_category, SUM(is_late::INTEGER) / COUNT(*) AS late_rate,
                      COUNT(*) FILTER (WHERE negative) / COUNT(*) AS negative_review_rate,
                      COUNT(*) FILTER (WHERE is_late) AS late_orders
               FROM f GROUP BY main_category""",
        ),
        "dedupe_latest": shaped(
            "order_id:n review_score:n review_created_at:t review_answered_at:t has_comment:b",
            "rev",
            """SELECT order_id, score AS review_score, created AS review_created_at,
                      answered AS review_answered_at, has_comment FROM rev""",
        ),
        "main_line": shaped("order_id:n seller_id:n product_id:n price:r", "top_line", "FROM top_line"),
        "customer_orders": shaped(_SEQUENCE_COLUMNS, "seq", _SEQUENCE),
        "customer_orders_hot": shaped(
            "person:n o_orderkey:n ordered_at:t event_seq:n next_ts:t first_event:n",
            "",
            """SELECT person, o_orderkey, ordered_at, ROW_NUMBER() OVER line AS event_seq,
                      LEAD(ordered_at) OVER line AS next_ts,
                      FIRST_VALUE(o_orderkey) OVER line AS first_event
               FROM (SELECT CASE WHEN o_orderkey % 3 <> 0 THEN 0 ELSE o_custkey END AS person,
                            o_orderkey, o_orderdate::TIMESTAMP AS ordered_at FROM orders) AS o
               WINDOW line AS (PARTITION BY person ORDER BY ordered_at, o_orderkey)""",
        ),
        "share_of_total": shaped(
            "l_suppkey:n quantity:r share:r",
            "",
            """SELECT l_suppkey, SUM(l_quantity) AS quantity,
                      SUM(l_quantity) / SUM(SUM(l_quantity)) OVER () AS share
               FROM lineitem GROUP BY l_suppkey""",
        ),
        "ntile_scalable": shaped(
            "tile:n lines:n quantity:r order_keys:n",
            "",
            """SELECT tile, COUNT(*) AS lines, SUM(l_quantity) AS quantity,
                      SUM(l_orderkey) AS order_keys
               FROM (SELECT *, NTILE(7) OVER (
                         ORDER BY l_quantity DESC, l_orderkey, l_linenumber, l_partkey, l_suppkey,
                                  l_extendedprice) AS tile FROM lineitem)
               GROUP BY tile""",
        ),
        "fct_orders": shaped(_FACT_COLUMNS, "f", f"SELECT {_FACT} FROM f"),
        "next_after_delivery": shaped(
            "customer_unique_id:n next_order_at:t",
            "r",
            "SELECT person AS customer_unique_id, next_order_at FROM r",
        ),
        "first_order_retention": shaped(_RETENTION_COLUMNS, "r", _RETENTION),
        "retention_long_window": shaped(
            "customer_unique_id:n order_id:n next_order_at:t days_to_next_order:n "
            "repeat_in_window:b is_mature:b",
            "r",
            """SELECT person AS customer_unique_id, order_id, next_order_at,
                      days_to_next AS days_to_next_order,
                      coalesce(days_to_next <= 1800, FALSE) AS repeat_in_window,
                      arrived + to_days(1800) <= (SELECT MAX(bought) FROM o) AS is_mature
               FROM r""",
        ),
        "mart_lateness": shaped(_LATENESS_COLUMNS, "lateness", "FROM lateness"),
        "late_vs_ontime": shaped(
            "delivery:s orders:n avg_review:r negative_review_rate:r five_star_rate:r "
            "avg_delivery_days:r",
            "late_split",
            "FROM late_split",
        ),
        "retention_late_vs_ontime": shaped(
            "first_delivery:s customers:n repeat_customers:n repeat_rate:r",
            "repeat_split",
            "FROM repeat_split",
        ),
        "mart_state": shaped(_STATE_COLUMNS, "state", "FROM state"),
        "mart_seller": shaped(
            "seller_id:n seller_state:s orders:n late_orders:n late_rate:r avg_review:r "
            "item_value:m share_of_all_late_orders:r late_rate_decile:n",
            "seller",
            "FROM seller",
        ),
        "mart_monthly": shaped(_MONTHLY_COLUMNS, "monthly", "FROM monthly"),
        "mart_distance": shaped(_DISTANCE_COLUMNS, "distance", "FROM distance"),
        "job_extracts": _figures(),
        "job_orders_extract": shaped(_EXTRACT_COLUMNS, "f", f"SELECT {_FACT} FROM f"),
        "job_distance_extract": shaped(_DISTANCE_COLUMNS, "distance", "FROM distance"),
        "quality_checks": shaped(
            "check_name:s failing_rows:n", "f r cust sell prod rev", _checks()
        ),
        "quality_report_file": shaped(
            "check_name:s failing_rows:n", "f r cust sell prod rev", _checks()
        ),
        "statistic_file": shaped(_TEST_COLUMNS, "counts", _ztest("counts")),
        "extract_order": shaped(
            "line:n customer_state:s late_rank:n orders:n",
            "state",
            """SELECT *, ROW_NUMBER() OVER (ORDER BY late_rank, customer_state) AS line FROM state""",
        ),
        "chart_order": shaped(
            "place:n customer_state:s",
            "state",
            """SELECT customer_state, ROW_NUMBER() OVER (ORDER BY late_rate, customer_state) AS place
               FROM state""",
        ),
        "quality_gate": shaped(
            "failing_rows:n",
            "f r cust sell prod rev",
            f"SELECT SUM(failing_rows) AS failing_rows FROM ({_checks()})",
        ),
        "ztest_late_vs_ontime": shaped(_TEST_COLUMNS, "counts", _ztest("counts")),
        "ztest_by_segment": shaped(
            "customer_state:s " + _TEST_COLUMNS, "counts_by", _ztest("counts_by")
        ),
        "ztest_p_value": shaped("customer_state:s z:r p_value:r", "counts_by", _ztest("counts_by")),
        "report_totals": shaped(
            "orders:n customers:n sellers:n late_rate:r first_order:t last_order:t",
            "f",
            """SELECT (SELECT COUNT(*) FROM f) AS orders,
                      (SELECT COUNT(*) FROM (SELECT DISTINCT person FROM f)) AS customers,
                      (SELECT COUNT(*) FROM (SELECT DISTINCT main_seller_id FROM f)) AS sellers,
                      AVG(is_late::INTEGER) AS late_rate, MIN(bought) AS first_order,
                      MAX(bought) AS last_order FROM f""",
        ),
        "report_headline": shaped(
            "late_avg_review:r late_negative_review_rate:r late_five_star_rate:r "
            "on_time_avg_review:r on_time_negative_review_rate:r on_time_five_star_rate:r "
            "negative_review_ratio:r",
            "late_split",
            """SELECT a.avg_review AS late_avg_review,
                      a.negative_review_rate AS late_negative_review_rate,
                      a.five_star_rate AS late_five_star_rate,
                      b.avg_review AS on_time_avg_review,
                      b.negative_review_rate AS on_time_negative_review_rate,
                      b.five_star_rate AS on_time_five_star_rate,
                      a.negative_review_rate / b.negative_review_rate AS negative_review_ratio
               FROM late_split a, late_split b
               WHERE a.delivery = 'Late' AND b.delivery = 'On time'""",
        ),
        "report_states": shaped(
            _STATE_COLUMNS,
            "state",
            """FROM state WHERE orders >= 300 ORDER BY late_rate DESC, customer_state LIMIT 5""",
        ),
        "report_distance": shaped(
            _DISTANCE_COLUMNS, "distance", "FROM distance WHERE distance_band <> '9 Unknown'"
        ),
        "report_seller_deciles": shaped(
            "late_rate_decile:n sellers:n orders:n late_rate:r avg_review:r",
            "deciles",
            "FROM deciles",
        ),
        "report_decile_ends": shaped(
            "sellers:n worst_late_rate:r worst_avg_review:r best_late_rate:r best_avg_review:r",
            "deciles",
            """SELECT SUM(sellers) AS sellers,
                      arg_min(late_rate, late_rate_decile) AS worst_late_rate,
                      arg_min(avg_review, late_rate_decile) AS worst_avg_review,
                      arg_max(late_rate, late_rate_decile) AS best_late_rate,
                      arg_max(avg_review, late_rate_decile) AS best_avg_review FROM deciles""",
        ),
        "report_worst_months": shaped(
            _MONTHLY_COLUMNS,
            "monthly",
            "FROM monthly WHERE orders >= 100 ORDER BY late_rate DESC, order_month LIMIT 3",
        ),
        "chart_reviews_by_lateness": shaped(
            "label:s avg_review:r orders:n negative_review_rate:r",
            "lateness",
            "SELECT *, substr(lateness_bucket, 3) AS label FROM lateness",
        ),
        "chart_retention_ci": shaped(
            "label:s repeat_pct:r half_width_pct:r repeat_customers:n customers:n",
            "repeat_split",
            """SELECT first_delivery[1:2] AS side, customers, repeat_customers,
                      CASE first_delivery WHEN 'Late' THEN 'Late first delivery'
                           ELSE 'On-time first delivery' END AS label,
                      100 * repeat_customers / customers AS repeat_pct,
                      196 * sqrt(repeat_customers::DOUBLE * (customers - repeat_customers)
                                 / pow(customers, 3)) AS half_width_pct
               FROM repeat_split""",
        ),
        "overall_late_rate": shaped(
            "late_rate:r", "f", "SELECT AVG(is_late::INTEGER) AS late_rate FROM f"
        ),
        "chart_states": shaped(
            "customer_state:s late_pct:r avg_distance_km:r level:s",
            "state",
            """SELECT *, 100 * late_rate AS late_pct,
                      CASE WHEN late_rate < 0.08 THEN 'normal' WHEN late_rate < 0.12 THEN 'raised'
                           ELSE 'high' END AS level
               FROM state WHERE orders >= 300""",
        ),
        "chart_distance": shaped(
            "label:s late_pct:r avg_delivery_days:r avg_review:r",
            "distance",
            """SELECT *, substr(distance_band, 3) AS label, 100 * late_rate AS late_pct
               FROM distance WHERE distance_band NOT LIKE '9%'""",
        ),
        "chart_monthly": shaped(
            "order_month:d late_pct:r avg_review:r",
            "monthly",
            "SELECT *, 100 * late_rate AS late_pct FROM monthly WHERE orders >= 100",
        ),
        "bi_kpis": shaped(
            "lateness_label:s " + _BI_COLUMNS,
            "bi_label",
            f"""SELECT lateness_label, {_BI} FROM bi_label
                WHERE year(bought) * 12 + month(bought) BETWEEN 1995 * 12 + 1 AND 1997 * 12 + 12
                  AND customer_state IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_5',
                                         'NATION_8', 'NATION_13')
                  AND main_category IN ('economy', 'promo', 'LARGE', 'unknown')
                GROUP BY lateness_label""",
        ),
        "top_sellers": shaped(
            "seller_id:n late_orders:n late_rate:r avg_review:r",
            "seller",
            "FROM seller ORDER BY late_orders DESC, seller_id LIMIT 10",
        ),
    }
