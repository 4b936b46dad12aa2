"""The registered queries as plain SQL over the same Parquet tables, for checking.

Written independently of the DataFrame plans: one shared set of CTEs derives the logical tables,
each check then aggregates them. Money is DECIMAL, rounding is spelled out as arithmetic.
"""

from __future__ import annotations

S = "TIMESTAMP '2000-08-01'"
D = "DATE '2000-08-01'"


def r(e: str, n: int) -> str:
    """Half away from zero at n digits."""
    x, f = f"CAST({e} AS DOUBLE)", f"1e{n}"
    return (
        f"(CASE WHEN {x} < 0 THEN (-CAST(floor(-{x}*{f}+0.5) AS BIGINT))/{f} "
        f"ELSE CAST(floor({x}*{f}+0.5) AS BIGINT)/{f} END)"
    )


def even(e: str, n: int) -> str:
    return f"(round_even(CAST({e} AS DOUBLE)*1e{n}, 0)/1e{n})"


def avg(e: str) -> str:
    return f"(CAST(SUM({e}) AS DOUBLE)/NULLIF(CAST(COUNT({e}) AS DOUBLE), 0))"


def tot(e: str) -> str:
    return f"CAST(SUM({e}) AS DOUBLE)"


def big(e: str) -> str:
    return f"CAST({e} AS BIGINT)"


def title(c: str) -> str:
    return (
        f"list_aggregate(list_transform(regexp_extract_all(lower(trim({c})), '[a-z]+|[^a-z]+'), "
        "lambda s: upper(s[1]) || s[2:]), 'string_agg', '')"
    )


RATE4 = r(avg("churned") + "*100", 4)
COUNT = "CAST(COUNT(*) AS BIGINT)"


def cut(c: str, edges: list, labels: list[str], lowest: bool = False) -> str:
    op = "<" if lowest else "<="
    parts = [f"WHEN {c} {op} {edges[0]} THEN NULL"]
    parts += [f"WHEN {c} <= {e} THEN {lab}" for e, lab in zip(edges[1:], labels)]
    return "(CASE " + " ".join(parts) + " END)"


def quote(labels) -> list[str]:
    return ["'" + x + "'" for x in labels]


CTES = {
    "past": f"SELECT * FROM orders WHERE o_orderdate < {S}",
    "raw_orders": """
        SELECT l_orderkey*10 + l_linenumber AS order_id, o_custkey AS customer_id,
          p_partkey AS product_id, p_name AS product_name, p_type AS category,
          o_orderstatus AS order_status, CAST(o_orderdate AS DATE) AS order_date,
          CASE WHEN l_shipdate >= o_orderdate THEN CAST(l_shipdate AS DATE) END AS delivery_date,
          CASE WHEN l_shipdate >= o_orderdate
            THEN CAST(date_diff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS INT)
          END AS delivery_days,
          CASE WHEN l_orderkey % 8 < 3 THEN CAST(1 + l_orderkey % 5 AS DOUBLE) END AS customer_rating,
          CAST(round(l_discount*100) AS INT) AS discount_pct,
          CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS returned,
          CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
            AS DECIMAL(18,4)) AS total_amount_usd,
          l_quantity AS session_duration_minutes, l_linenumber AS pages_viewed_before_purchase
        FROM lineitem JOIN past ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "heads": """
        SELECT o_custkey, COUNT(*) AS n, SUM(CAST(o_totalprice AS DECIMAL(14,2))) AS spend,
          CAST(MIN(o_orderdate) AS DATE) AS first_day, CAST(MAX(o_orderdate) AS DATE) AS last_day
        FROM past GROUP BY o_custkey""",
    "later": f"""
        SELECT DISTINCT o_custkey FROM orders
        WHERE o_orderdate >= {S} AND o_orderdate < {S} + INTERVAL 365 DAY""",
    "usual_priority": """
        SELECT o_custkey, o_orderpriority FROM (
          SELECT o_custkey, o_orderpriority, row_number() OVER (
            PARTITION BY o_custkey ORDER BY COUNT(*) DESC, o_orderpriority) AS k
          FROM past GROUP BY o_custkey, o_orderpriority) WHERE k = 1""",
    "usual_category": """
        SELECT customer_id, category FROM (
          SELECT customer_id, category, row_number() OVER (
            PARTITION BY customer_id ORDER BY COUNT(*) DESC, category) AS k
          FROM raw_orders GROUP BY customer_id, category) WHERE k = 1""",
    "returned_lines": "SELECT customer_id, SUM(returned) AS returns FROM raw_orders GROUP BY customer_id",
    "raw_customers": f"""
        SELECT c_custkey AS customer_id, first_day AS registration_date,
          CAST(18 + c_custkey % 63 AS INT) AS age,
          CASE c_custkey % 3 WHEN 0 THEN ' female' WHEN 1 THEN 'MALE ' ELSE 'other' END AS gender,
          n_name AS country,
          CASE WHEN c_acctbal < 4000 THEN 'Free' WHEN c_acctbal < 6500 THEN 'Silver'
            WHEN c_acctbal < 8500 THEN 'Gold' ELSE 'Platinum' END AS membership_tier,
          category AS preferred_category,
          CASE (c_custkey*7) % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END
            AS preferred_device,
          o_orderpriority AS preferred_payment_method, c_mktsegment AS acquisition_channel,
          CAST(coalesce(n, 0) AS INT) AS total_orders,
          CAST(coalesce(spend, 0) AS DECIMAL(24,2)) AS total_spend_usd,
          CAST(coalesce(spend, 0) AS DOUBLE) / greatest(coalesce(n, 0), 1) AS avg_order_value_usd,
          CAST(date_diff('day', last_day, {D}) AS INT) AS days_since_last_purchase,
          CAST(c_custkey % 5 AS INT) AS reviews_given,
          1 + CAST((c_custkey*13) % 41 AS DOUBLE)/10e0 AS avg_review_score,
          CAST(coalesce(returns, 0) AS INT) AS returns_made,
          CAST((c_custkey*11) % 21 AS INT) AS wishlist_items,
          CAST(c_custkey % 2 AS INT) AS newsletter_subscribed,
          CASE WHEN later.o_custkey IS NULL THEN 1 ELSE 0 END AS churned
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
          LEFT JOIN heads ON heads.o_custkey = c_custkey
          LEFT JOIN later ON later.o_custkey = c_custkey
          LEFT JOIN usual_priority ON usual_priority.o_custkey = c_custkey
          LEFT JOIN usual_category ON usual_category.customer_id = c_custkey
          LEFT JOIN returned_lines ON returned_lines.customer_id = c_custkey""",
    "customers": f"""
        SELECT * REPLACE (
            CASE WHEN reviews_given = 0 THEN NULL ELSE avg_review_score END AS avg_review_score,
            {", ".join(f"{title(c)} AS {c}" for c in (
                "membership_tier", "gender", "preferred_category", "preferred_device",
                "preferred_payment_method", "acquisition_channel", "country"))}),
          CAST(date_diff('day', registration_date, {D}) AS INT) AS customer_tenure_days
        FROM raw_customers
        WHERE age BETWEEN 16 AND 100 AND total_orders >= 0 AND total_spend_usd >= 0
          AND avg_review_score BETWEEN 0 AND 5""",
    "category_rating": """
        SELECT category, median(customer_rating) AS m FROM raw_orders GROUP BY category""",
    "clean_orders": """
        SELECT raw_orders.* REPLACE (coalesce(customer_rating, m,
              (SELECT median(coalesce(customer_rating, m)) FROM raw_orders
               LEFT JOIN category_rating USING (category))) AS customer_rating),
          CASE WHEN customer_rating IS NULL THEN 1 ELSE 0 END AS rating_imputed,
          strftime(order_date, '%Y-%m') AS order_month_label,
          CASE WHEN discount_pct > 0 THEN 1 ELSE 0 END AS is_discounted, returned AS is_returned
        FROM raw_orders LEFT JOIN category_rating USING (category)""",
    "raw_revenue": f"""
        SELECT m.*, coalesce(new_customers, 0) AS new_customers FROM (
          SELECT CAST(year(order_date) AS INT) AS year, CAST(month(order_date) AS INT) AS month,
            'Q' || CAST(quarter(order_date) AS VARCHAR) AS quarter, {COUNT} AS orders,
            {tot("total_amount_usd")} AS revenue_usd, {avg("total_amount_usd")} AS avg_order_value,
            {avg("discount_pct")} AS avg_discount_pct, {avg("returned")} AS return_rate,
            CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS unique_customers
          FROM raw_orders GROUP BY 1, 2, 3) m
        LEFT JOIN (SELECT CAST(year(first_day) AS INT) AS year, CAST(month(first_day) AS INT) AS month,
            {COUNT} AS new_customers FROM heads JOIN customer ON c_custkey = o_custkey
            GROUP BY 1, 2) USING (year, month)""",
    "revenue": """
        SELECT *, CAST(year AS VARCHAR) || '-' || lpad(CAST(month AS VARCHAR), 2, '0') AS period_label,
          (revenue_usd / lag(revenue_usd) OVER (ORDER BY year, month) - 1) * 100 AS revenue_mom_pct
        FROM raw_revenue""",
    "trend": f"""
        SELECT year, month, quarter, revenue_usd, unique_customers, new_customers,
          {r("return_rate*100", 2)} AS return_rate_pct, period_label,
          {r("revenue_mom_pct", 2)} AS mom_growth_pct FROM revenue""",
    "products": f"""
        SELECT product_id, MIN(category) AS category, MIN(product_name) AS product_name,
          {COUNT} AS total_orders, {tot("total_amount_usd")} AS total_revenue_usd,
          {avg("total_amount_usd")} AS avg_price, {avg("customer_rating")} AS avg_rating,
          {avg("returned")}*100 AS return_rate, {avg("discount_pct")} AS avg_discount_pct,
          {avg("delivery_days")} AS avg_delivery_days
        FROM raw_orders GROUP BY product_id""",
    "rollup": f"""
        SELECT customer_id, CAST(COUNT(order_id) AS BIGINT) AS order_count,
          coalesce({tot("total_amount_usd")}, 0e0) AS total_order_revenue,
          {avg("total_amount_usd")} AS avg_order_value,
          {avg("session_duration_minutes")} AS avg_session_mins,
          {avg("pages_viewed_before_purchase")} AS avg_pages_viewed,
          CAST(coalesce(SUM(returned), 0) AS BIGINT) AS total_returns,
          {avg("customer_rating")} AS avg_rating_orders,
          {avg("delivery_days")} AS avg_delivery_days,
          {avg("is_discounted")} AS pct_discounted_orders,
          CAST(COUNT(DISTINCT category) AS BIGINT) AS unique_categories,
          CAST(MAX(discount_pct) AS DOUBLE) AS max_discount_pct,
          CAST(coalesce(SUM(returned), 0) AS DOUBLE)/greatest(COUNT(order_id), 1) AS return_rate,
          coalesce({tot("total_amount_usd")}, 0e0)/greatest(COUNT(order_id), 1) AS revenue_per_order
        FROM clean_orders WHERE customer_id IS NOT NULL GROUP BY customer_id""",
    "spend_cuts": """
        SELECT quantile_cont(greatest(CAST(total_spend_usd AS DOUBLE), 0e0) + 0.01e0,
                 [0.2, 0.4, 0.6, 0.8]) AS q5,
          quantile_cont(CAST(total_spend_usd AS DOUBLE), [0.25, 0.5, 0.75]) AS q4
        FROM customers""",
    "scored": f"""
        SELECT customers.*, rollup.* EXCLUDE (customer_id), category AS primary_category,
          CAST({cut("days_since_last_purchase", [-1, 30, 90, 180, 365, 99999], "54321")} AS DOUBLE)
            AS recency_score,
          CAST({cut("total_orders", [-1, 1, 3, 7, 15, 99999], "12345")} AS DOUBLE) AS frequency_score,
          CAST(CASE WHEN sp <= q5[1] THEN 1 WHEN sp <= q5[2] THEN 2 WHEN sp <= q5[3] THEN 3
            WHEN sp <= q5[4] THEN 4 ELSE 5 END AS DOUBLE) AS monetary_score,
          CASE WHEN raw_sp >= q4[3] THEN 'High Value' WHEN raw_sp >= q4[2] THEN 'Mid Value'
            WHEN raw_sp >= q4[1] THEN 'Low Value' ELSE 'At Risk' END AS value_segment,
          {even("customer_tenure_days/30.44e0", 1)} AS tenure_months,
          CASE membership_tier WHEN 'Silver' THEN 1 WHEN 'Gold' THEN 2 WHEN 'Platinum' THEN 3
            ELSE 0 END AS tier_rank,
          newsletter_subscribed + CASE WHEN wishlist_items > 0 THEN 1 ELSE 0 END
            + CASE WHEN reviews_given > 0 THEN 1 ELSE 0 END AS engagement_score,
          CASE WHEN return_rate > 0.20 THEN 1 ELSE 0 END AS high_return_flag,
          CASE WHEN avg_review_score < 3 THEN 1 ELSE 0 END AS low_satisfaction_flag,
          CASE WHEN days_since_last_purchase >= 180 THEN 1 ELSE 0 END AS dormant_flag
        FROM (SELECT *, greatest(CAST(total_spend_usd AS DOUBLE), 0e0) + 0.01e0 AS sp,
                CAST(total_spend_usd AS DOUBLE) AS raw_sp FROM customers) customers
          LEFT JOIN rollup USING (customer_id)
          LEFT JOIN usual_category USING (customer_id), spend_cuts""",
    "features": f"""
        SELECT * EXCLUDE (sp, raw_sp),
          recency_score*0.35e0 + frequency_score*0.35e0 + monetary_score*0.30e0 AS rfm_score,
          CASE WHEN monetary_score >= 4 AND dormant_flag = 1 THEN 1 ELSE 0 END AS high_value_at_risk,
          {even("(1-recency_score/5)*0.30e0 + (1-frequency_score/5)*0.25e0 + high_return_flag*0.20e0"
                " + low_satisfaction_flag*0.15e0"
                " + (1-CAST(engagement_score AS DOUBLE)/3)*0.10e0", 4)} AS churn_risk_score
        FROM scored""",
    "predictions": f"""
        SELECT customer_id, {even("churn_risk_score", 4)} AS churn_probability,
          CASE WHEN churn_risk_score >= 0.5 THEN 1 WHEN churn_risk_score < 0.5 THEN 0 END
            AS predicted_churn,
          {cut("churn_risk_score", [0, 0.30, 0.55, 1], quote(["LOW", "MEDIUM", "HIGH"]), True)}
            AS risk_tier,
          'risk_score' AS model_version
        FROM features""",
}

ORDER = list(CTES)
_KNOWN = {name: body for name, body in CTES.items()}


def _uses(text: str, name: str) -> bool:
    import re

    return re.search(rf"\b{name}\b", text) is not None


def with_ctes(body: str, **extra: str) -> str:
    """``body`` under the CTEs it needs, directly or through others."""
    wanted, frontier = set(), [body, *extra.values()]
    while frontier:
        text = frontier.pop()
        for name in ORDER:
            if name not in wanted and _uses(text, name):
                wanted.add(name)
                frontier.append(_KNOWN[name])
    parts = [f"{name} AS MATERIALIZED ({_KNOWN[name]})" for name in ORDER if name in wanted]
    parts += [f"{name} AS ({text})" for name, text in extra.items()]
    return f"WITH {', '.join(parts)} {body}" if parts else body


def _by_bins(source: str, edges: list, labels: list[str], name: str, where: str = "TRUE") -> str:
    binned = cut(source, edges, quote(labels))
    values = ", ".join(f"('{lab}', {i})" for i, lab in enumerate(labels))
    return f"""
        SELECT d.{name}, d.bucket_order, coalesce(customers, 0) AS customers, churn_rate_pct
        FROM (VALUES {values}) d({name}, bucket_order) LEFT JOIN (
          SELECT {binned} AS {name}, {COUNT} AS customers, {RATE4} AS churn_rate_pct
          FROM customers WHERE {where} GROUP BY 1) g ON g.{name} = d.{name}"""


def _marked(inner: str, rate: str = "churn_rate_pct") -> str:
    column = "churned" if rate == "churn_rate_pct" else "returned"
    raw = f"{avg(column)}*100 AS raw_rate"
    rounded = f"{r(avg(column) + '*100', 4)} AS {rate}"
    inner = inner.replace(rounded, f"{rounded}, {raw}")
    for listed in ("customers, churn_rate_pct\n", "churned, churn_rate_pct, avg"):
        inner = inner.replace(listed, listed.replace("churn_rate_pct", "churn_rate_pct, raw_rate"))
    return f"""
        SELECT g.* EXCLUDE (raw_rate), {r("m", 4)} AS mean_rate,
          CASE WHEN CAST(CAST(raw_rate AS DECIMAL(24,14)) AS DOUBLE) > m THEN 1 ELSE 0 END AS above_mean
        FROM ({inner}) g, (SELECT CAST(SUM(CAST(raw_rate AS DECIMAL(24,14))) AS DOUBLE)/COUNT(raw_rate) AS m
          FROM ({inner})) a"""


def _rate_by(key: str, source: str = "customers") -> str:
    return f"""SELECT {key}, {COUNT} AS customers, {RATE4} AS churn_rate_pct
        FROM {source} WHERE {key} IS NOT NULL GROUP BY {key}"""


def _quartile_label(source: str, labels: list[str]) -> str:
    x = f"CAST({source} AS DOUBLE)"
    a, b, c, d = quote(labels)
    return (
        f"(CASE WHEN {x} IS NULL THEN NULL WHEN {x} <= q[1] THEN {a} WHEN {x} <= q[2] THEN {b} "
        f"WHEN {x} <= q[3] THEN {c} ELSE {d} END)"
    )


CORR = [
    "age", "total_orders", "total_spend_usd", "avg_order_value_usd",
    "days_since_last_purchase", "reviews_given", "avg_review_score",
    "returns_made", "wishlist_items", "newsletter_subscribed",
    "tenure_days", "engagement_score", "churned",
]
CORR_INPUT = f"""SELECT {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in CORR)} FROM (
    SELECT * EXCLUDE (customer_tenure_days), customer_tenure_days AS tenure_days,
      newsletter_subscribed + CASE WHEN wishlist_items > 0 THEN 1 ELSE 0 END
        + CASE WHEN reviews_given > 0 THEN 1 ELSE 0 END AS engagement_score
    FROM customers)"""


def _pairs() -> str:
    parts = [
        f"SELECT '{b}' AS feature, '{a}' AS other, {r(f'corr({b}, {a})', 6)} AS r FROM corr_input"
        for i, a in enumerate(CORR)
        for b in CORR[i + 1 :]
    ]
    return " UNION ALL ".join(parts)


MODEL_NUMBERS = [
    "age", "total_orders", "total_spend_usd", "avg_order_value_usd", "days_since_last_purchase", "reviews_given",
    "avg_review_score", "returns_made", "wishlist_items", "newsletter_subscribed", "customer_tenure_days",
    "rfm_score", "recency_score", "frequency_score", "monetary_score", "tier_rank", "engagement_score",
    "high_return_flag", "low_satisfaction_flag", "dormant_flag", "churn_risk_score", "return_rate",
    "avg_session_mins", "avg_pages_viewed", "pct_discounted_orders", "unique_categories",
]
MODEL_TEXTS = [
    "gender", "membership_tier", "preferred_category", "preferred_device", "preferred_payment_method",
    "acquisition_channel",
]


def _filled_number(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return f"SELECT coalesce({x}, (SELECT quantile_cont({x}, 0.5) FROM features), 0e0) AS x FROM features"


def _mode(c: str, source: str = "features") -> str:
    return f"""(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1)"""


def _preparation_values() -> str:
    numbers = [
        f"""SELECT '{c}' AS column_name, {r(f"(SELECT quantile_cont(CAST({c} AS DOUBLE), 0.5) FROM features)", 4)} AS median,
          {r("avg(x)", 4)} AS mean, {r("stddev_samp(x)", 4)} AS std, CAST(NULL AS VARCHAR) AS mode,
          CAST(NULL AS INTEGER) AS labels FROM ({_filled_number(c)})"""
        for c in MODEL_NUMBERS
    ]
    texts = [
        f"""SELECT '{c}', CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), {_mode(c)},
          CAST((SELECT COUNT(DISTINCT {c}) FROM features) AS INTEGER)"""
        for c in MODEL_TEXTS
    ]
    return " UNION ALL ".join(numbers + texts)


def _encoded_rows() -> str:
    """Place of the text among the sorted texts of the fitting rows, -1 for a text not among them."""
    seen = "(SELECT * FROM features WHERE membership_tier IS DISTINCT FROM 'Platinum')"
    places = [
        f"""CAST(coalesce(list_position((SELECT list_sort(list(DISTINCT {c})) FROM {seen} WHERE {c} IS NOT NULL),
          coalesce({c}, {_mode(c, seen)})), 0) - 1 AS INTEGER) AS {c}"""
        for c in MODEL_TEXTS
    ]
    return f"SELECT customer_id, {', '.join(places)} FROM features"


def _contributions() -> str:
    """Mean absolute coefficient times distance from the mean; numbers standardised, texts as ordinals."""
    parts = []
    for j, c in enumerate(MODEL_NUMBERS + MODEL_TEXTS):
        b = f"({(j % 5 - 2) * 0.3!r}e0)"
        if c in MODEL_NUMBERS:
            rows, z = _filled_number(c), "CASE WHEN s = 0 THEN 0e0 ELSE (x - m)/s END"
        else:
            rows, z = f"""SELECT CAST(list_position((SELECT list_sort(list(DISTINCT {c})) FROM features
              WHERE {c} IS NOT NULL), coalesce({c}, {_mode(c)})) - 1 AS DOUBLE) AS x FROM features""", "x - m"
        parts.append(
            f"""SELECT '{c}' AS feature, avg(abs({b}*({z}))) AS m
            FROM ({rows}), (SELECT avg(x) AS m, stddev_samp(x) AS s FROM ({rows}))"""
        )
    return " UNION ALL ".join(parts)


def _target() -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(f'corr({c}, churned)', 6)} AS r FROM corr_input"
        for c in CORR
        if c != "churned"
    )


def _histogram(column: str, bins: int, upper: float | None, by_class: bool) -> str:
    x = f"CAST({column} AS DOUBLE)"
    x = f"least({x}, {float(upper)}e0)" if upper is not None else x
    key = "churned" if by_class else "0"
    out = "churned, " if by_class else ""
    return f"""
        WITH v AS (SELECT {key} AS k, {x} AS v FROM customers WHERE {column} IS NOT NULL),
        b AS (SELECT k, CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
                CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi FROM v GROUP BY k),
        h AS (SELECT k, least(CAST(floor((v - lo)/(hi - lo)*{bins}) AS INT) + 1, {bins}) AS bin,
                COUNT(*) AS n FROM v JOIN b USING (k) GROUP BY 1, 2)
        SELECT {"CAST(b.k AS INT) AS churned, " if by_class else ""}CAST(g AS INT) AS bin,
          {r(f"lo + (g - 1)*((hi - lo)/{bins})", 6)} AS bin_start,
          {r(f"lo + g*((hi - lo)/{bins})", 6)} AS bin_end, CAST(coalesce(n, 0) AS BIGINT) AS n
        FROM b, range(1, {bins + 1}) t(g) LEFT JOIN h ON h.k = b.k AND h.bin = g"""


def _describe(columns: list[str]) -> str:
    parts = []
    for c in columns:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(COUNT({c}) AS BIGINT) AS count, "
            f"{r(avg(c), 4)} AS mean, {r(f'stddev_samp({x})', 4)} AS std, "
            f"CAST(MIN({c}) AS DOUBLE) AS min, {r(f'quantile_cont({x}, 0.25)', 4)} AS q25, "
            f"{r(f'quantile_cont({x}, 0.5)', 4)} AS q50, {r(f'quantile_cont({x}, 0.75)', 4)} AS q75, "
            f"CAST(MAX({c}) AS DOUBLE) AS max FROM customers"
        )
    return " UNION ALL ".join(parts)


def _nulls(columns: list[str], table: str) -> str:
    parts = [
        f"SELECT '{c}' AS column_name, CAST(COUNT(*) - COUNT({c}) AS BIGINT) AS null_count FROM {table}"
        for c in columns
    ]
    total = " + ".join(f"(COUNT(*) - COUNT({c}))" for c in columns)
    parts.append(
        f"SELECT '(all columns)' AS column_name, CAST({total} AS BIGINT) AS null_count FROM {table}"
    )
    return " UNION ALL ".join(parts)


CUSTOMER_TYPES = {
    "customer_id": "bigint", "registration_date": "date", "age": "int", "gender": "string",
    "country": "string", "membership_tier": "string", "preferred_category": "string",
    "preferred_device": "string", "preferred_payment_method": "string",
    "acquisition_channel": "string", "total_orders": "int", "total_spend_usd": "decimal(24,2)",
    "avg_order_value_usd": "double", "days_since_last_purchase": "int", "reviews_given": "int",
    "avg_review_score": "double", "returns_made": "int", "wishlist_items": "int",
    "newsletter_subscribed": "int", "churned": "int", "customer_tenure_days": "int",
}
ORDER_TYPES = (
    "order_id", "customer_id", "product_id", "product_name", "category", "order_status",
    "order_date", "delivery_date", "delivery_days", "customer_rating", "discount_pct", "returned",
    "total_amount_usd", "session_duration_minutes", "pages_viewed_before_purchase",
)
NUMERIC = [
    "age", "total_orders", "total_spend_usd", "avg_order_value_usd", "days_since_last_purchase",
    "reviews_given", "avg_review_score", "returns_made", "wishlist_items",
    "newsletter_subscribed", "churned",
]

EXPECTED_LOSS = r(
    "CAST(SUM(CAST(churn_probability AS DECIMAL(9,6)) * CAST(total_spend_usd AS DECIMAL(18,2)))"
    " AS DOUBLE)",
    2,
)
REVIEW_MEAN = r(avg("avg_review_score"), 4)
RETURNS_PER_ORDER = r(
    "CAST(SUM(returns_made) AS DOUBLE)/NULLIF(CAST(SUM(total_orders) AS DOUBLE), 0)", 4
)
CATEGORY_STATS = f"""SELECT category, {tot("total_amount_usd")} AS revenue,
    {r(avg("returned") + "*100", 4)} AS return_rate_pct, {r(avg("customer_rating"), 4)} AS avg_rating,
    {big("COUNT(order_id)")} AS orders FROM clean_orders WHERE category IS NOT NULL GROUP BY category"""
SCORED_ROWS = "SELECT churned, churn_risk_score AS score FROM features WHERE churn_risk_score IS NOT NULL"
POINTS = """SELECT score, SUM(churned) AS pos, SUM(1 - churned) AS neg,
    SUM(SUM(churned)) OVER (ORDER BY score DESC) AS tp,
    SUM(COUNT(*)) OVER (ORDER BY score DESC) AS called FROM rows_in GROUP BY score"""
PROFILE = [
    ("membership_tier", "membership_tier"),
    ("preferred_device", "preferred_device"),
    ("acquisition_channel", "acquisition_channel"),
]


def _profile(above: float) -> str:
    return " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {k} AS segment, {COUNT} AS customers, "
        f"{RETURNS_PER_ORDER} AS returns_per_order, {REVIEW_MEAN} AS avg_review_score "
        f"FROM predictions JOIN customers USING (customer_id) WHERE churn_probability > {above} "
        f"GROUP BY {k}"
        for d, k in PROFILE
    )


def _report() -> str:
    hit, false, missed, right = "tp", "fp", "fn", "tn"

    def div(a: str, b: str) -> str:
        return f"coalesce(CAST({a} AS DOUBLE)/NULLIF(CAST({b} AS DOUBLE), 0), 0e0)"

    def line(tp: str, fp: str, fn: str) -> tuple[str, str, str, str]:
        return (
            div(tp, f"{tp}+{fp}"), div(tp, f"{tp}+{fn}"),
            div(f"2*{tp}", f"2*{tp}+{fp}+{fn}"), f"({tp}+{fn})",
        )

    neg, pos = line(right, missed, false), line(hit, false, missed)
    n = "(tp+fp+fn+tn)"
    acc = div("tp+tn", n)
    macro = [f"({a}+{b})/2" for a, b in zip(neg[:3], pos[:3])]
    weighted = [div(f"({a}*{neg[3]}+{b}*{pos[3]})", n) for a, b in zip(neg[:3], pos[:3])]
    rows = [
        ("Retained", *neg), ("Churned", *pos), ("accuracy", acc, acc, acc, n),
        ("macro avg", *macro, n), ("weighted avg", *weighted, n),
    ]
    return " UNION ALL ".join(
        f"SELECT '{name}' AS label, {p} AS precision, {q} AS recall, {f} AS f1, "
        f"CAST({s} AS BIGINT) AS support FROM outcome"
        for name, p, q, f, s in rows
    )


# Columns of the published tables with their Spark types; * marks those beyond the expected ones.
PUBLISHED = {
    "customers": ("customers", """acquisition_channel string, age int, avg_order_value_usd double, avg_review_score double,
        churned int, country string, customer_id bigint, customer_tenure_days int, days_since_last_purchase int, gender string,
        membership_tier string, newsletter_subscribed int, preferred_category string, preferred_device string,
        preferred_payment_method string, registration_date date, returns_made int, reviews_given int, total_orders int,
        total_spend_usd decimal(24;2), wishlist_items int"""),
    "monthly_revenue": ("revenue", """avg_discount_pct double, avg_order_value double, month int, new_customers bigint,
        orders bigint, period_label string, quarter string, return_rate double, revenue_mom_pct double, revenue_usd double,
        unique_customers bigint, year int"""),
    "orders": ("clean_orders", """category string, customer_id bigint, customer_rating double, delivery_date date,
        delivery_days int, discount_pct int, is_discounted int, is_returned int, order_date date, order_id bigint,
        order_month_label string, order_status string, pages_viewed_before_purchase int, *product_id bigint,
        *product_name string, rating_imputed int, returned int, session_duration_minutes double,
        total_amount_usd decimal(18;4)"""),
    "product_summary": ("products", """avg_delivery_days double, avg_discount_pct double, avg_price double, avg_rating double,
        category string, *product_id bigint, product_name string, return_rate double, total_orders bigint,
        total_revenue_usd double"""),
}
# The exported tables: source, number columns, other columns (a date counts as its ten letters).
EXPORTED = {
    "customers": ("customers", """age total_orders total_spend_usd avg_order_value_usd days_since_last_purchase reviews_given
        avg_review_score returns_made wishlist_items newsletter_subscribed churned customer_id""",
        "registration_date gender country membership_tier preferred_category preferred_device preferred_payment_method acquisition_channel"),
    "orders": ("clean_orders", """order_id customer_id total_amount_usd discount_pct customer_rating returned
        session_duration_minutes pages_viewed_before_purchase""", "category order_status"),
    "monthly_revenue": ("revenue", """avg_discount_pct avg_order_value month new_customers orders return_rate revenue_mom_pct
        revenue_usd unique_customers year""", "period_label quarter"),
    "product_summary": ("products", """avg_delivery_days avg_discount_pct avg_price avg_rating product_id return_rate
        total_orders total_revenue_usd""", "category product_name"),
    "churn_predictions": ("predictions", "customer_id churn_probability predicted_churn", "risk_tier model_version"),
    "shap_importance": ("contributed", "mean_abs_shap", "feature"),
    "v_executive_kpis": ("kpis", "total_customers total_churned churn_rate_pct avg_ltv_usd lost_revenue_usd retained_revenue_usd", ""),
    "v_churn_by_tier": ("tiers", "customers churned churn_rate_pct avg_ltv_usd", "membership_tier"),
    "v_churn_by_channel": ("channels", "customers churn_rate_pct avg_ltv_usd", "acquisition_channel"),
    "v_revenue_trend": ("trend", "year month revenue_usd unique_customers new_customers return_rate_pct mom_growth_pct",
        "quarter period_label"),
}


def _exchange_losses() -> str:
    """Partners in a ring of MD5 order inside MD5 buckets; AUC by summed ranks."""
    weights = {"days_since_last_purchase": 3, "total_orders": -40, "wishlist_items": 7, "age": -1}
    draw = "CAST('0x' || substr(md5(CAST(customer_id AS VARCHAR) || '|{}'), 1, 15) AS BIGINT)"
    own = " + ".join(f"{w}*{c}" for c, w in weights.items())
    variants = [("", own)] + [
        (c, " + ".join(f"{w}*{'o_' if c == other else ''}{other}" for other, w in weights.items())) for c in weights
    ]
    ring = "(PARTITION BY b ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
    others = ", ".join(f"coalesce(lead({c}) OVER (PARTITION BY b ORDER BY h), first_value({c}) OVER {ring}) AS o_{c}" for c in weights)
    values = ", ".join(f"coalesce(CAST({c} AS BIGINT), 0) AS {c}" for c in weights)
    scores = " UNION ALL ".join(f"SELECT '{name}' AS feature, churned, {score} AS s FROM paired" for name, score in variants)
    return f"""SELECT feature, {r("base - auc", 9)} AS auc_loss FROM (
      SELECT feature, auc, max(CASE WHEN feature = '' THEN auc END) OVER () AS base FROM (
        SELECT feature, CAST(SUM(neg*(above + pos*0.5e0)) AS DOUBLE)/(SUM(pos)*SUM(neg)) AS auc FROM (
          SELECT *, coalesce(SUM(pos) OVER (PARTITION BY feature ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above
          FROM (SELECT feature, s, SUM(churned) AS pos, SUM(1 - churned) AS neg FROM (
            WITH keyed AS (SELECT customer_id, churned, {values}, {draw.format(42)} AS h,
                {draw.format(43)} % (SELECT greatest(1, COUNT(*) // 4096) FROM customers) AS b FROM customers),
              paired AS (SELECT *, {others} FROM keyed)
            {scores}) GROUP BY feature, s))
        GROUP BY feature)) WHERE feature <> ''"""


def _published_columns() -> str:
    parts = []
    for table, (source, columns) in PUBLISHED.items():
        for column, kind in (c.split() for c in columns.replace("\n", " ").split(",")):
            status = "additional" if column.startswith("*") else "ok"
            name, kind = column.lstrip("*"), kind.replace(";", ",")
            parts.append(
                f"SELECT '{table}' AS table_name, '{name}' AS column_name, '{kind}' AS data_type, '{status}' AS status, "
                f"CAST(COUNT({name}) AS BIGINT) AS filled FROM {source}"
            )
    return " UNION ALL ".join(parts)


def _exported_columns() -> str:
    parts = []
    for table, (source, numbers, texts) in EXPORTED.items():
        amounts = {c: f"CAST({c} AS DOUBLE)" for c in numbers.split()}
        amounts |= {c: f"LENGTH(CAST({c} AS VARCHAR))" for c in texts.split()}
        for column, amount in amounts.items():
            parts.append(
                f"SELECT '{table}' AS table_name, '{column}' AS column_name, CAST(COUNT({column}) AS BIGINT) AS filled, "
                f"{r(f'SUM({amount})', 2)} AS total FROM {source}"
            )
    return " UNION ALL ".join(parts)


def all_oracles() -> dict[str, str]:
    q: dict[str, str] = {}
    bodies: dict[str, str] = {}

    def add(name: str, body: str, **extra: str) -> None:
        bodies[name] = body
        q[name] = with_ctes(body, **extra)

    # -- profiling
    shapes = [("customers", "raw_customers", 20), ("orders", "raw_orders", 15),
              ("monthly_revenue", "raw_revenue", 10), ("product_summary", "products", 10)]
    add("table_shapes", " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, {COUNT} AS row_count, CAST({k} AS BIGINT) AS column_count FROM {t}"
        for n, t, k in shapes))
    add("first_customers", """SELECT customer_id, country, membership_tier, total_orders, churned
        FROM customers ORDER BY customer_id LIMIT 5""")  # fmt: skip
    add("column_info", " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, '{k}' AS data_type, "
        f"CAST(COUNT({c}) AS BIGINT) AS non_null FROM customers"
        for i, (c, k) in enumerate(CUSTOMER_TYPES.items())))
    add("describe_customers", _describe(NUMERIC))
    add("null_counts", _nulls(list(ORDER_TYPES), "raw_orders"))
    add("duplicate_rows", f"""SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicates FROM (
        SELECT COUNT(*) AS n FROM raw_orders GROUP BY {", ".join(ORDER_TYPES)})""")  # fmt: skip
    add("duplicate_keys", """SELECT CAST(SUM(n - 1) AS BIGINT) AS duplicates FROM (
        SELECT COUNT(*) AS n FROM raw_orders GROUP BY order_id)""")  # fmt: skip
    add("distinct_tiers", "SELECT DISTINCT membership_tier FROM customers")
    counts = """SELECT {c}, CAST(COUNT(*) AS BIGINT) AS n, {p} AS pct
        FROM {t} WHERE {c} IS NOT NULL GROUP BY {c}"""
    share = r("CAST(COUNT(*) AS DOUBLE)*100/SUM(COUNT(*)) OVER ()", 4)
    add("churn_value_counts", counts.format(c="churned", p=share, t="customers"))
    add("order_status_counts", counts.format(c="order_status", p=share, t="raw_orders"))
    ends = [("age", "customers"), ("total_spend_usd", "customers"), ("order_date", "raw_orders")]
    add("value_ranges", " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(MIN({c}) AS VARCHAR) AS min_value, "
        f"CAST(MAX({c}) AS VARCHAR) AS max_value FROM {t}" for c, t in ends))  # fmt: skip
    add("distinct_counts", " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(COUNT(DISTINCT {c}) AS BIGINT) AS n_distinct FROM raw_orders"
        for c in ("category", "order_status", "customer_id")))
    add("table_totals", f"""SELECT {r("(SELECT SUM(revenue_usd) FROM revenue)", 0)} AS total_revenue,
        {r("(SELECT SUM(revenue_usd)/COUNT(*) FROM revenue)", 0)} AS avg_monthly_revenue,
        (SELECT {r(avg("churned") + "*100", 2)} FROM customers) AS churn_rate_pct,
        (SELECT {r(avg("returned") + "*100", 1)} FROM raw_orders) AS return_rate_pct""")  # fmt: skip
    add("product_category_means", f"""SELECT category, {even(avg("total_revenue_usd"), 2)} AS total_revenue_usd,
        {even(avg("avg_rating"), 2)} AS avg_rating, {even(avg("return_rate"), 2)} AS return_rate
        FROM products GROUP BY category""")  # fmt: skip
    add("relationship_check", """
        SELECT 'duplicate customer keys' AS check_name,
          CAST(COUNT(*) - COUNT(DISTINCT customer_id) AS BIGINT) AS violations FROM customers
        UNION ALL SELECT 'orders without customer', CAST(COUNT(*) AS BIGINT) FROM raw_orders
          WHERE customer_id NOT IN (SELECT customer_id FROM customers)
        UNION ALL SELECT 'duplicate prediction keys',
          CAST(COUNT(*) - COUNT(DISTINCT customer_id) AS BIGINT) FROM predictions
        UNION ALL SELECT 'predictions without customer', CAST(COUNT(*) AS BIGINT) FROM predictions
          WHERE customer_id NOT IN (SELECT customer_id FROM customers)
        UNION ALL SELECT 'customers without prediction', CAST(COUNT(*) AS BIGINT) FROM customers
          WHERE customer_id NOT IN (SELECT customer_id FROM predictions)""")  # fmt: skip

    # -- cleaning
    add("cleaned_customers", "SELECT * FROM customers")
    add("rejected_customers", """
        SELECT rule, CAST(SUM(bad) AS BIGINT) AS rejected FROM (
          SELECT unnest(['age', 'total_orders', 'total_spend_usd', 'avg_review_score', 'any']) AS rule,
            unnest([a, b, c, d, greatest(a, b, c, d)]) AS bad FROM (
            SELECT CASE WHEN age BETWEEN 16 AND 100 THEN 0 ELSE 1 END AS a,
              CASE WHEN total_orders >= 0 THEN 0 ELSE 1 END AS b,
              CASE WHEN total_spend_usd >= 0 THEN 0 ELSE 1 END AS c,
              CASE WHEN avg_review_score BETWEEN 0 AND 5 THEN 0 ELSE 1 END AS d
            FROM raw_customers)) GROUP BY rule""")  # fmt: skip
    add("cleaned_orders", "SELECT * FROM clean_orders")
    add("cleaned_revenue", f"""SELECT year, month, quarter, orders, revenue_usd, avg_order_value,
        avg_discount_pct, return_rate, unique_customers, new_customers, period_label,
        {r("revenue_mom_pct", 6)} AS revenue_mom_pct FROM revenue""")  # fmt: skip

    # -- bins
    bins = {
        "recency_score": cut("days_since_last_purchase", [-1, 30, 90, 180, 365, 99999], "54321"),
        "frequency_score": cut("total_orders", [-1, 1, 3, 7, 15, 99999], "12345"),
        "wishlist_bucket": cut("wishlist_items", [-1, 0, 5, 15, 100],
                               quote(["0 items", "1–5", "6–15", "16+"])),
        "rating_bucket": cut("avg_review_score", [0, 2, 3, 4, 5],
                             quote(["1–2 Poor", "3 Neutral", "4 Good", "5 Excellent"])),
        "return_bucket": cut("returns_made", [-1, 0, 1, 2, 100],
                             quote(["0 returns", "1 return", "2 returns", "3+ returns"])),
        "age_group": cut("age", [0, 25, 35, 45, 60, 100],
                         quote(["18–25", "26–35", "36–45", "46–60", "60+"])),
        "tenure_cohort": """CASE WHEN customer_tenure_days <= 90 THEN '0-3 months'
            WHEN customer_tenure_days <= 365 THEN '3-12 months'
            WHEN customer_tenure_days <= 730 THEN '1-2 years' ELSE '2+ years' END""",
    }
    add("customer_bins", "SELECT customer_id, "
        + ", ".join(f"{e} AS {n}" for n, e in bins.items()) + " FROM customers")
    spend_labels = ["Q1 Low", "Q2 Mid-Low", "Q3 Mid-High", "Q4 High"]
    add("spend_bins", f"""SELECT customer_id, CAST(monetary_score AS INT) AS monetary_score, value_segment,
        {_quartile_label("total_spend_usd", spend_labels)} AS spend_quartile
        FROM features, (SELECT quantile_cont(CAST(total_spend_usd AS DOUBLE), [0.25, 0.5, 0.75]) AS q
          FROM customers)""")  # fmt: skip
    age_labels = ["young adult", "adult", "middle aged", "senior"]
    add("age_quartiles", f"""SELECT customer_id, age, {_quartile_label("age", age_labels)} AS age_group
        FROM customers, (SELECT quantile_cont(CAST(age AS DOUBLE), [0.25, 0.5, 0.75]) AS q
          FROM customers)""")  # fmt: skip

    # -- business library
    add("executive_kpis", f"""SELECT {COUNT} AS total_customers, {big("SUM(churned)")} AS total_churned,
        {r(avg("churned") + "*100", 2)} AS churn_rate_pct, {r(avg("total_spend_usd"), 2)} AS avg_ltv_usd,
        {r("SUM(CASE WHEN churned=1 THEN total_spend_usd END)", 2)} AS lost_revenue_usd,
        {r("SUM(CASE WHEN churned=0 THEN total_spend_usd END)", 2)} AS retained_revenue_usd
        FROM customers""")  # fmt: skip
    add("churn_by_tier", f"""SELECT membership_tier, {COUNT} AS customers, {big("SUM(churned)")} AS churned,
        {r(avg("churned") + "*100", 2)} AS churn_rate_pct, {r(avg("total_spend_usd"), 2)} AS avg_ltv_usd
        FROM customers GROUP BY membership_tier""")  # fmt: skip
    add("churn_by_channel", f"""SELECT acquisition_channel, {COUNT} AS customers,
        {r(avg("churned") + "*100", 2)} AS churn_rate_pct, {r(avg("total_spend_usd"), 2)} AS avg_ltv_usd
        FROM customers GROUP BY acquisition_channel""")  # fmt: skip
    add("revenue_trend", "SELECT * FROM trend")
    add("revenue_per_user", f"""SELECT period_label, revenue_usd, unique_customers, new_customers,
        return_rate_pct, mom_growth_pct, {r("revenue_usd/unique_customers", 2)} AS arpu FROM trend""")  # fmt: skip
    add("category_performance", f"""SELECT category, {COUNT} AS total_orders,
        {r(tot("total_amount_usd"), 0)} AS total_revenue, {r(avg("total_amount_usd"), 2)} AS avg_order_value,
        {r(avg("customer_rating"), 2)} AS avg_rating, {r(avg("returned") + "*100", 1)} AS return_rate_pct,
        {r(avg("discount_pct"), 1)} AS avg_discount_pct, {r(avg("delivery_days"), 1)} AS avg_delivery_days
        FROM clean_orders GROUP BY category""")  # fmt: skip
    add("order_status_funnel", f"""SELECT order_status, {COUNT} AS orders,
        {r("COUNT(*)*100e0/SUM(COUNT(*)) OVER ()", 1)} AS pct_of_total,
        {r(tot("total_amount_usd"), 0)} AS total_value FROM raw_orders GROUP BY order_status""")  # fmt: skip
    add("device_payment_matrix", f"""SELECT preferred_device, preferred_payment_method,
        {COUNT} AS customers, {r(avg("churned") + "*100", 1)} AS churn_rate_pct,
        {r(avg("total_spend_usd"), 0)} AS avg_spend FROM customers GROUP BY 1, 2""")  # fmt: skip
    add("tenure_cohorts", f"""SELECT {bins["tenure_cohort"]} AS tenure_cohort, {COUNT} AS customers,
        {r(avg("churned") + "*100", 1)} AS churn_rate_pct, {r(avg("total_spend_usd"), 0)} AS avg_ltv,
        MIN(customer_tenure_days) AS min_tenure_days FROM customers GROUP BY 1""")  # fmt: skip
    quadrant = """CASE WHEN total_revenue_usd > ar AND return_rate > rr
          THEN 'High Revenue / High Return — Fix Quality'
        WHEN total_revenue_usd > ar THEN 'Star Product — Promote'
        WHEN return_rate > rr THEN 'Low Revenue / High Return — Review or Discontinue'
        ELSE 'Low Revenue / Low Return — Grow or Phase Out' END"""
    averages = f"(SELECT {avg('total_revenue_usd')} AS ar, {avg('return_rate')} AS rr FROM products)"
    add("product_quadrants", f"""SELECT product_id, product_name, category, total_orders,
        {r("total_revenue_usd", 0)} AS revenue, avg_rating, return_rate, {quadrant} AS product_quadrant
        FROM products, {averages}""")  # fmt: skip
    add("quadrant_sizes", f"""SELECT {quadrant} AS product_quadrant, {COUNT} AS products
        FROM products, {averages} GROUP BY 1""")  # fmt: skip

    # -- findings
    add("churn_split", f"""SELECT churned, {COUNT} AS customers, {tot("total_spend_usd")} AS total_spend_usd,
        {r(avg("total_spend_usd"), 2)} AS avg_ltv_usd,
        {r("COUNT(*)*100e0/SUM(COUNT(*)) OVER ()", 1)} AS share_pct FROM customers GROUP BY churned""")  # fmt: skip
    kept = avg("CASE WHEN churned=0 THEN total_spend_usd END")
    lost = avg("CASE WHEN churned=1 THEN total_spend_usd END")
    add("ltv_gap", f"""SELECT {r(kept, 2)} AS avg_ltv_retained, {r(lost, 2)} AS avg_ltv_churned,
        {r(f"({kept}-{lost})/{kept}*100", 1)} AS ltv_gap_pct FROM customers""")  # fmt: skip
    tiers = f"""SELECT d.*, customers, churned, churn_rate_pct, avg_ltv_usd, revenue_at_risk_usd
        FROM (VALUES ('Free', 0), ('Silver', 1), ('Gold', 2), ('Platinum', 3)) d(membership_tier, bucket_order)
        LEFT JOIN (SELECT membership_tier, {COUNT} AS customers, {big("SUM(churned)")} AS churned,
          {RATE4} AS churn_rate_pct, {r(avg("total_spend_usd"), 2)} AS avg_ltv_usd,
          coalesce({tot("CASE WHEN churned=1 THEN total_spend_usd END")}, 0e0) AS revenue_at_risk_usd
          FROM customers GROUP BY 1) USING (membership_tier)"""
    add("tier_breakdown", _marked(tiers))
    add("channel_stats", _marked(f"""SELECT acquisition_channel, {RATE4} AS churn_rate_pct,
        {even(avg("total_spend_usd"), 2)} AS avg_ltv_usd, {COUNT} AS customers FROM customers
        WHERE acquisition_channel IS NOT NULL GROUP BY 1"""))  # fmt: skip
    add("recency_by_class", f"""SELECT churned, {r(avg("days_since_last_purchase"), 4)} AS avg_recency_days,
        {r(avg("CASE WHEN days_since_last_purchase >= 180 THEN 1 ELSE 0 END") + "*100", 4)} AS dormant_pct
        FROM customers GROUP BY churned""")  # fmt: skip
    add("churn_by_engagement", f"""SELECT engagement_score, {COUNT} AS customers, {RATE4} AS churn_rate_pct,
        CASE engagement_score WHEN 0 THEN '0 — None' WHEN 1 THEN '1 — Low' WHEN 2 THEN '2 — Medium'
          ELSE '3 — High' END AS engagement_level
        FROM (SELECT churned, newsletter_subscribed + CASE WHEN wishlist_items > 0 THEN 1 ELSE 0 END
          + CASE WHEN reviews_given > 0 THEN 1 ELSE 0 END AS engagement_score FROM customers)
        GROUP BY 1""")  # fmt: skip
    add("churn_by_wishlist", _by_bins("wishlist_items", [-1, 0, 5, 15, 100],
        ["0 items", "1–5", "6–15", "16+"], "wishlist_bucket"))
    quartile_values = ", ".join(f"('{lab}', {i})" for i, lab in enumerate(spend_labels))
    add("churn_by_spend_quartile", _marked(f"""SELECT d.*, coalesce(customers, 0) AS customers, churn_rate_pct
        FROM (VALUES {quartile_values}) d(spend_quartile, bucket_order) LEFT JOIN (
          SELECT {_quartile_label("total_spend_usd", spend_labels)} AS spend_quartile,
            {COUNT} AS customers, {RATE4} AS churn_rate_pct
          FROM customers, (SELECT quantile_cont(CAST(total_spend_usd AS DOUBLE), [0.25, 0.5, 0.75]) AS q
            FROM customers) GROUP BY 1) USING (spend_quartile)"""))  # fmt: skip
    top = "CAST(total_spend_usd AS DOUBLE) >= p"
    add("top_spender_churn", f"""SELECT {r("MAX(p)", 4)} AS p75_spend_usd,
        CAST(COUNT(*) FILTER ({top}) AS BIGINT) AS top_customers,
        {r(avg(f"CASE WHEN {top} THEN churned END") + "*100", 4)} AS top_churn_rate_pct,
        {RATE4} AS churn_rate_pct
        FROM customers, (SELECT quantile_cont(CAST(total_spend_usd AS DOUBLE), 0.75) AS p
          FROM customers)""")  # fmt: skip
    add("churn_by_review", _by_bins("avg_review_score", [0, 2, 3, 4, 5],
        ["1–2 Poor", "3 Neutral", "4 Good", "5 Excellent"], "rating_bucket", "reviews_given > 0"))
    add("churn_by_returns", _by_bins("returns_made", [-1, 0, 1, 2, 100],
        ["0 returns", "1 return", "2 returns", "3+ returns"], "return_bucket"))
    add("primary_category", "SELECT customer_id, category AS primary_category FROM usual_category")
    add("churn_by_primary_category", _marked(_rate_by("category",
        "(SELECT category, churned FROM usual_category JOIN customers USING (customer_id))").replace(
            "SELECT category,", "SELECT category AS primary_category,", 1)))
    add("category_returns", f"""SELECT category, return_rate_pct, avg_rating, orders,
        left(category, 12) AS short_label FROM ({CATEGORY_STATS})""")  # fmt: skip
    add("most_returned_category", f"""SELECT category, return_rate_pct FROM ({CATEGORY_STATS})
        ORDER BY return_rate_pct DESC, category LIMIT 1""")  # fmt: skip
    add("rolling_revenue", f"""SELECT year, month, period_label, revenue_usd,
        CASE WHEN COUNT(*) OVER w = 6 THEN {r("AVG(revenue_usd) OVER w", 2)} END AS rolling_avg_usd
        FROM revenue WINDOW w AS (ORDER BY year, month ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING)""")  # fmt: skip
    add("annual_summary", f"""SELECT year, {r("SUM(revenue_usd)", 2)} AS revenue_usd,
        {even("SUM(revenue_usd)/1e6", 2)} AS revenue_m, {big("SUM(new_customers)")} AS new_customers,
        {big("SUM(unique_customers)")} AS unique_customers FROM revenue GROUP BY year""")  # fmt: skip
    add("annual_unique_customers", """SELECT CAST(year(order_date) AS INT) AS year,
        CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS unique_customers FROM raw_orders GROUP BY 1""")  # fmt: skip
    parts = {"month": "strftime(order_date, '%Y-%m')", "quarter": "year(order_date) || '-Q' || quarter(order_date)",
        "year": "CAST(year(order_date) AS VARCHAR)", "all": "'all'"}
    add("active_periods", " UNION ALL ".join(f"""SELECT '{p}' AS period, {label} AS label,
        CAST(COUNT(DISTINCT customer_id) AS BIGINT) AS unique_customers, TRUE AS estimate_agrees FROM raw_orders GROUP BY ALL"""
        for p, label in parts.items()))
    add("exchange_losses", _exchange_losses())
    add("category_revenue", f"""SELECT * REPLACE ({r("revenue", 2)} AS revenue)
        FROM ({_marked(CATEGORY_STATS, "return_rate_pct")})""")  # fmt: skip
    add("top_categories", f"""SELECT category, {even(tot("total_amount_usd"), 2)} AS revenue,
        {even(avg("returned") + "*100", 2)} AS return_rate_pct, {even(avg("customer_rating"), 2)} AS avg_rating,
        {big("COUNT(order_id)")} AS orders FROM clean_orders WHERE category IS NOT NULL GROUP BY category
        ORDER BY revenue DESC, category LIMIT 5""")  # fmt: skip
    add("churn_by_age", _marked(_by_bins("age", [0, 25, 35, 45, 60, 100],
        ["18–25", "26–35", "36–45", "46–60", "60+"], "age_group")))
    add("top_countries", """SELECT country, CAST(COUNT(*) AS BIGINT) AS n FROM customers
        GROUP BY country ORDER BY n DESC, country LIMIT 8""")  # fmt: skip
    add("churn_by_top_countries", _marked(_rate_by("country", """(SELECT * FROM customers WHERE country IN (
        SELECT country FROM customers GROUP BY country ORDER BY COUNT(*) DESC, country LIMIT 8))""")))  # fmt: skip
    add("churn_by_gender", _rate_by("gender"))
    q["recency_histogram"] = with_ctes(f"SELECT * FROM ({_histogram('days_since_last_purchase', 40, 600, True)})")
    q["spend_histogram"] = with_ctes(f"SELECT * FROM ({_histogram('total_spend_usd', 45, 5000, True)})")
    q["spend_histogram_overall"] = with_ctes(f"SELECT * FROM ({_histogram('total_spend_usd', 30, None, False)})")
    add("spend_centres", f"""SELECT churned, {r(avg("total_spend_usd"), 4)} AS mean_value,
        {r("quantile_cont(CAST(total_spend_usd AS DOUBLE), 0.5)", 4)} AS median_value
        FROM customers GROUP BY churned""")  # fmt: skip
    x = "CAST(days_since_last_purchase AS DOUBLE)"
    inside = "x BETWEEN q[1] - (q[3]-q[1])*1.5e0 AND q[3] + (q[3]-q[1])*1.5e0"
    add("recency_box", f"""SELECT churned, MAX(q[1]) AS q1, MAX(q[2]) AS median, MAX(q[3]) AS q3,
        MIN(CASE WHEN {inside} THEN x END) AS whisker_low, MAX(CASE WHEN {inside} THEN x END) AS whisker_high,
        CAST(COUNT(*) FILTER (NOT ({inside})) AS BIGINT) AS outliers
        FROM (SELECT churned, {x} AS x FROM customers WHERE days_since_last_purchase IS NOT NULL)
        JOIN (SELECT churned, quantile_cont({x}, [0.25, 0.5, 0.75]) AS q FROM customers GROUP BY churned)
          USING (churned) GROUP BY churned""")  # fmt: skip
    add("correlation_matrix", f"""SELECT * FROM pair_rows
        UNION ALL SELECT other, feature, r FROM pair_rows
        UNION ALL SELECT c, c, 1e0 FROM (SELECT unnest([{", ".join(quote(CORR))}]) AS c)""",
        corr_input=CORR_INPUT, pair_rows=_pairs())
    add("correlation_triangle", "SELECT * FROM pair_rows", corr_input=CORR_INPUT, pair_rows=_pairs())
    add("target_correlations", """SELECT feature, r, CASE WHEN abs(r) > 0.05 THEN 1 ELSE 0 END AS keep
        FROM target_rows""", corr_input=CORR_INPUT, target_rows=_target())  # fmt: skip
    add("strongest_correlations", """SELECT 'risk' AS direction, max_by(feature, r) AS feature, MAX(r) AS r
        FROM target_rows UNION ALL SELECT 'protective', min_by(feature, r), MIN(r) FROM target_rows""",
        corr_input=CORR_INPUT, target_rows=_target())
    add("collinear_pairs", "SELECT * FROM pair_rows WHERE r > 0.85 AND feature <> 'churned'",
        corr_input=CORR_INPUT, pair_rows=_pairs())

    # -- features
    add("order_rollup", """SELECT rollup.*, category AS primary_category FROM rollup
        LEFT JOIN usual_category USING (customer_id)""")  # fmt: skip
    add("feature_table", "SELECT * FROM features")

    # -- scored customers
    add("prediction_table", "SELECT * FROM predictions")
    add("at_risk_list", """SELECT customer_id, country, age, membership_tier, total_spend_usd,
        days_since_last_purchase, avg_review_score, returns_made, acquisition_channel,
        churn_probability, risk_tier FROM customers JOIN predictions USING (customer_id)
        WHERE risk_tier = 'HIGH' AND CAST(total_spend_usd AS DOUBLE) > (SELECT
          CAST(SUM(total_spend_usd) AS DOUBLE)/COUNT(total_spend_usd) FROM customers)
        ORDER BY churn_probability DESC, total_spend_usd DESC, customer_id LIMIT 100""")  # fmt: skip
    add("risk_tier_revenue", f"""SELECT risk_tier, {COUNT} AS customers, {r(avg("total_spend_usd"), 0)} AS avg_ltv,
        {r(tot("total_spend_usd"), 0)} AS total_at_risk_usd,
        {r(avg("CAST(churn_probability AS DECIMAL(9,6))") + "*100", 1)} AS avg_churn_prob_pct
        FROM predictions JOIN customers USING (customer_id) GROUP BY risk_tier""")  # fmt: skip
    add("tier_counts", f"SELECT risk_tier, {COUNT} AS customers FROM predictions GROUP BY risk_tier")
    add("tier_activity", f"""SELECT risk_tier, {COUNT} AS customers, CAST(SUM(CAST(total_spend_usd AS DECIMAL(18,2))) AS DOUBLE) AS spend,
        CAST(coalesce(SUM(order_count), 0) AS BIGINT) AS orders, CAST(COUNT_IF(order_count IS NULL) AS BIGINT) AS without_orders
        FROM customers LEFT JOIN rollup USING (customer_id) JOIN predictions USING (customer_id) GROUP BY risk_tier""")
    add("revenue_at_risk", f"""SELECT {COUNT} AS customers, {EXPECTED_LOSS} AS expected_loss_usd
        FROM predictions JOIN customers USING (customer_id)""")  # fmt: skip
    for key in ("country", "membership_tier", "acquisition_channel"):
        add(f"revenue_at_risk_by_{key}", f"""SELECT {key}, {COUNT} AS customers,
            {EXPECTED_LOSS} AS expected_loss_usd FROM predictions JOIN customers USING (customer_id)
            GROUP BY {key}""")  # fmt: skip
    add("cohort_profile", _profile(0.5))
    contributions = _contributions()
    add("linear_contributions", f"SELECT feature, {r('m', 6)} AS mean_abs_shap FROM ({contributions})")
    add("preparation_values", _preparation_values())
    add("encoded_rows", _encoded_rows())
    add("fold_sizes", """SELECT churned, CAST(f AS INT) AS fold,
        CAST((CASE WHEN f = 4 THEN n ELSE floor(n*((f + 1)/5e0) + 0.5) END)
          - (CASE WHEN f = 0 THEN 0 ELSE floor(n*(f/5e0) + 0.5) END) AS BIGINT) AS customers
        FROM (SELECT churned, COUNT(*) AS n FROM customers GROUP BY churned), range(5) t(f)""")
    add("top_linear_drivers", f"""SELECT feature, {r("m", 4)} AS importance FROM ({contributions})
        ORDER BY m DESC, feature LIMIT 15""")
    retention = """SELECT customer_id, membership_tier, total_spend_usd, days_since_last_purchase,
        churn_probability FROM customers JOIN predictions USING (customer_id) WHERE risk_tier = 'HIGH'"""
    add("retention_list", retention)
    add("retention_list_by_spend", retention + " ORDER BY total_spend_usd DESC, customer_id LIMIT 50")
    add("high_risk_sample", """SELECT customer_id, churn_probability, risk_tier FROM predictions
        WHERE churn_probability > 0.5 ORDER BY churn_probability DESC, customer_id LIMIT 100""")  # fmt: skip
    add("insight_report_by_rule", f"""
        SELECT 'high-risk sample' AS section, risk_tier AS rank_key, CAST(customer_id AS VARCHAR) AS item,
          churn_probability AS value FROM (SELECT * FROM predictions WHERE churn_probability > 0.5
            ORDER BY churn_probability DESC, customer_id LIMIT 100)
        UNION ALL SELECT 'top drivers', '', feature, {r("abs(r)", 4)} FROM (
          SELECT * FROM target_rows ORDER BY abs(r) DESC, feature LIMIT 5)
        UNION ALL SELECT 'customers per tier', '', risk_tier, CAST(COUNT(*) AS DOUBLE)
          FROM predictions GROUP BY risk_tier
        UNION ALL SELECT 'revenue at risk', '', 'expected loss', {EXPECTED_LOSS}
          FROM predictions JOIN customers USING (customer_id)
        UNION ALL SELECT 'high-risk cohort', dimension, segment, CAST(customers AS DOUBLE)
          FROM ({_profile(0.5)})""", corr_input=CORR_INPUT, target_rows=_target())  # fmt: skip

    # -- model quality on the rule-based score
    best = f"""SELECT score AS threshold, CAST(tp AS DOUBLE)/CAST(called AS DOUBLE) AS precision,
        CAST(tp AS DOUBLE)/(SELECT CAST(SUM(churned) AS DOUBLE) FROM rows_in) AS recall FROM points"""
    add("best_threshold", """SELECT threshold, precision, recall, f_beta FROM (
        SELECT *, 5e0*precision*recall/(4e0*precision + recall + 1e-9) AS f_beta FROM curve)
        ORDER BY f_beta DESC, threshold LIMIT 1""", rows_in=SCORED_ROWS, points=POINTS, curve=best)  # fmt: skip
    add("precision_recall_curve", """SELECT score AS threshold, CAST(tp AS BIGINT) AS true_positives,
        CAST(called AS BIGINT) AS called_positive, CAST(tp AS DOUBLE)/CAST(called AS DOUBLE) AS precision,
        CAST(tp AS DOUBLE)/(SELECT CAST(SUM(churned) AS DOUBLE) FROM rows_in) AS recall FROM points""",
        rows_in=SCORED_ROWS, points=POINTS)
    add("risk_score_auc", f"""SELECT {r("SUM(CAST(neg AS DOUBLE)*(tp - pos + pos*0.5e0))"
        "/(CAST(SUM(pos) AS DOUBLE)*CAST(SUM(neg) AS DOUBLE))", 9)} AS auc FROM points""",
        rows_in=SCORED_ROWS, points=POINTS)
    add("classification_report", _report(), outcome="""SELECT
        COUNT(*) FILTER (churned=1 AND z=1) AS tp, COUNT(*) FILTER (churned=0 AND z=1) AS fp,
        COUNT(*) FILTER (churned=1 AND z=0) AS fn, COUNT(*) FILTER (churned=0 AND z=0) AS tn
        FROM (SELECT churned, predicted_churn AS z FROM predictions JOIN customers USING (customer_id))
        WHERE z IS NOT NULL""")  # fmt: skip
    add("split_sizes", """SELECT churned, CAST(n - t AS BIGINT) AS train_rows, CAST(t AS BIGINT) AS test_rows
        FROM (SELECT churned, COUNT(*) AS n, floor(COUNT(*)*0.2e0 + 0.5) AS t FROM customers
          GROUP BY churned)""")  # fmt: skip
    add("class_weights", f"""SELECT churned, CAST(n AS BIGINT) AS customers,
        CAST(total AS DOUBLE)/(2e0*n) AS balanced_weight,
        CASE WHEN churned = 1 THEN {even("CAST(total - n AS DOUBLE)/n", 1)} ELSE 1e0 END
          AS boosting_weight
        FROM (SELECT churned, COUNT(*) AS n, SUM(COUNT(*)) OVER () AS total FROM customers
          GROUP BY churned)""")  # fmt: skip

    # -- storage
    add("csv_reload", f"""SELECT category, {COUNT} AS orders, {big("SUM(returned)")} AS returned,
        {tot("total_amount_usd")} AS revenue, MIN(order_date) AS first_order
        FROM raw_orders GROUP BY category""")  # fmt: skip
    published = [("customers", "customers"), ("orders", "clean_orders"),
                 ("monthly_revenue", "revenue"), ("product_summary", "products")]
    add("published_rows", " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, {COUNT} AS row_count FROM {t}" for n, t in published))

    add("clean_from_csv", " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, {COUNT} AS row_count, CAST(SUM({c}) AS DOUBLE) AS measure FROM {t}"
        for (n, t), c in zip(published, (
            "customer_tenure_days", "customer_rating", "unique_customers", "total_orders"))))
    spend, earned = (f"CAST(SUM(CAST({c} AS DECIMAL(18,2))) AS DOUBLE)" for c in ("total_spend_usd", "revenue_usd"))
    add("catalog_rows", f"""SELECT 'first' AS state, 'customers' AS table_name, {COUNT} AS row_count, {spend} AS total FROM customers
        UNION ALL SELECT 'first', 'revenue', {COUNT}, {earned} FROM revenue
        UNION ALL SELECT 'replaced', 'customers', {COUNT}, 2*{spend} FROM customers WHERE churned = 0
        UNION ALL SELECT 'replaced', 'revenue', {COUNT}, {earned} FROM revenue WHERE month <= 6""")
    add("csv_quarantine", " UNION ALL ".join(f"SELECT '{item}' AS item, CAST(COUNT_IF({test}) AS BIGINT) AS lines FROM raw_orders" for item, test in (
        ("lines", "TRUE"), ("kept", "order_id % 1000 NOT IN (7, 16, 25)"), ("quarantined", "order_id % 1000 IN (7, 16, 25)"))) + "".join(
        f" UNION ALL SELECT '{c} is no {t}', CAST(COUNT(*) AS BIGINT) FROM raw_orders WHERE order_id % 1000 = {k} HAVING COUNT(*) > 0"
        for c, t, k in (("total_amount_usd", "double", 7), ("customer_rating", "double", 16), ("returned", "int", 25))))
    bad = {"age": "age BETWEEN 16 AND 100", "total_orders": "total_orders >= 0", "total_spend_usd": "total_spend_usd >= 0",
        "avg_review_score": "avg_review_score BETWEEN 0 AND 5"}
    bad["any"] = " AND ".join(f"coalesce({ok}, FALSE)" for ok in bad.values())
    counted = [("customers_read", "rows", "COUNT(*)", "raw_customers")]
    counted += [("customers_read", n, f"COUNT_IF(NOT coalesce({ok}, FALSE))", "raw_customers") for n, ok in bad.items()]
    counted += [("customers_written", "rows", "COUNT(*)", "customers"), ("customers_written", "no_review_score", "COUNT_IF(avg_review_score IS NULL)", "customers"),
        ("orders_written", "rows", "COUNT(*)", "clean_orders"), ("orders_written", "imputed_ratings", "SUM(rating_imputed)", "clean_orders"),
        ("orders_written", "discounted", "SUM(is_discounted)", "clean_orders")]
    add("publication_counters", " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{n}' AS counter, CAST({e} AS BIGINT) AS value FROM {source}" for t, n, e, source in counted))
    add("published_columns", _published_columns())
    add("exported_views", _exported_columns(), contributed=f"SELECT feature, {r('m', 6)} AS mean_abs_shap FROM ({contributions})",
        kpis=bodies["executive_kpis"], tiers=bodies["churn_by_tier"], channels=bodies["churn_by_channel"])
    names = ("Logistic Regression", "Random Forest", "Gradient Boosting")
    add("model_round_trip", " UNION ALL ".join(f"""SELECT '{name}' AS model, {COUNT} AS customers, CAST(0 AS BIGINT) AS differing,
        CAST({len(MODEL_NUMBERS + MODEL_TEXTS)} AS BIGINT) AS drivers FROM customers""" for name in names))

    # -- events
    dormancy = """SELECT user_id AS customer_id, MIN(ts) AS active_from, MAX(ts) AS last_event,
        MAX(ts) + INTERVAL 12 HOUR AS dormant_at, CAST(COUNT(*) AS BIGINT) AS events
        FROM (SELECT user_id, ts, SUM(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS spell FROM (
          SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
            + INTERVAL 12 HOUR THEN 0 ELSE 1 END AS fresh FROM events WHERE user_id IS NOT NULL))
        GROUP BY user_id, spell
        HAVING MAX(ts) + INTERVAL 12 HOUR <= (SELECT MAX(ts) FROM events)"""
    add("dormancy_spells", dormancy)
    add("dormancy_stream", dormancy + " - INTERVAL 1 DAY")
    add("dormancy_timers", dormancy + " - INTERVAL 1 DAY")
    add("return_follow_ups", "SELECT event_id, user_id, event_type FROM events WHERE event_type = 'error'")
    return q
