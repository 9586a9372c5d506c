"""The registered queries once more, as SQL for an independent engine.

Each text is self-contained: views over the star schema, then the operators down to the one asked
for. Nothing here is used by the library.
"""

from __future__ import annotations

VIEWS = {
    "customers": """
        SELECT c_custkey AS customer_id,
               CAST(floor(c_custkey / 2) AS BIGINT) AS customer_unique_id,
               CAST(c_nationkey AS VARCHAR) AS customer_zip_code_prefix,
               n_name AS customer_city, r_name AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "shop_orders": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
               o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS order_purchase_timestamp
        FROM orders""",
    "payments": """
        SELECT l_orderkey AS order_id, l_linenumber AS payment_sequential, l_returnflag AS payment_type,
               1 + CAST(l_quantity AS INTEGER) % 12 AS payment_installments,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
                    * (1 + CAST(l_tax AS DECIMAL(4,2))) AS DECIMAL(12,2)) AS payment_value
        FROM lineitem""",
    "items": """
        SELECT l_orderkey AS order_id, l_partkey AS product_id, l_shipdate AS shipping_limit_date,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(12,2))
                   AS freight_value
        FROM lineitem""",
    "reviews": """
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey) AS review_id, l_orderkey AS order_id,
               1 + CAST(l_quantity AS INTEGER) % 5 AS review_score
        FROM lineitem WHERE l_returnflag = 'R'""",
    "clean_orders": """
        SELECT * FROM shop_orders WHERE order_purchase_timestamp IS NOT NULL AND order_id IS NOT NULL""",
    "payments_by_order": """
        SELECT order_id, sum(payment_value) AS total_order_payment,
               max(payment_installments) AS max_installments,
               count(payment_sequential) AS payment_method_count,
               arg_min(payment_type, row(payment_sequential, payment_type)) AS primary_payment_type
        FROM payments GROUP BY order_id""",
    "items_by_order": """
        SELECT order_id, sum(price) AS total_price, sum(freight_value) AS total_freight,
               count(product_id) AS total_items, min(shipping_limit_date) AS shipping_limit_date
        FROM items GROUP BY order_id""",
    "reviews_by_order": """
        SELECT order_id, avg(review_score) AS Avg_review_score, min(review_score) AS Min_review_score,
               count(review_id) AS Total_Review_Number
        FROM reviews GROUP BY order_id""",
    "order_master": """
        SELECT * FROM customers JOIN clean_orders USING (customer_id)
        LEFT JOIN payments_by_order USING (order_id)
        LEFT JOIN items_by_order USING (order_id)
        LEFT JOIN reviews_by_order USING (order_id)""",
    "study_bounds": """
        SELECT max(order_purchase_timestamp) - INTERVAL 455 DAY AS start,
               max(order_purchase_timestamp) - INTERVAL 90 DAY AS split,
               max(order_purchase_timestamp) AS "end"
        FROM clean_orders""",
    "study_period": """
        SELECT order_master.* FROM order_master, study_bounds
        WHERE order_purchase_timestamp >= start AND order_purchase_timestamp < "end" """,
    "observation": """
        SELECT study_period.* FROM study_period, study_bounds WHERE order_purchase_timestamp <= split""",
    "response": """
        SELECT study_period.* FROM study_period, study_bounds
        WHERE order_purchase_timestamp > split
          AND order_purchase_timestamp <= CAST(CAST(split AS DATE) + 90 AS TIMESTAMP)""",
    "active_customers": "SELECT DISTINCT customer_unique_id FROM response",
    "rfm_features": """
        SELECT customer_unique_id,
               date_diff('day', CAST(max(order_purchase_timestamp) AS DATE), CAST(max(split) AS DATE)) AS recency,
               count(DISTINCT order_id) AS frequency,
               CAST(sum(total_order_payment) AS DOUBLE) AS monetary,
               arg_min(customer_zip_code_prefix, row(order_purchase_timestamp, order_id))
                   FILTER (WHERE customer_zip_code_prefix IS NOT NULL) AS zip_code,
               arg_min(customer_city, row(order_purchase_timestamp, order_id))
                   FILTER (WHERE customer_city IS NOT NULL) AS city,
               arg_min(customer_state, row(order_purchase_timestamp, order_id))
                   FILTER (WHERE customer_state IS NOT NULL) AS state,
               sum(total_items) AS total_items_volume,
               max(payment_method_count) AS payment_method_count,
               arg_min(primary_payment_type, row(order_purchase_timestamp, order_id))
                   FILTER (WHERE primary_payment_type IS NOT NULL) AS primary_payment_type,
               max(max_installments) AS max_installments,
               round(avg(Avg_review_score), 12) AS avg_satisfaction,
               min(Min_review_score) AS min_review_score,
               sum(Total_Review_Number) AS total_reviews_given
        FROM observation, study_bounds GROUP BY customer_unique_id""",
    "labelled": """
        SELECT rfm_features.*,
               CASE WHEN active_customers.customer_unique_id IS NULL THEN 1 ELSE 0 END AS churn
        FROM rfm_features LEFT JOIN active_customers USING (customer_unique_id)""",
    "gold": """
        SELECT customer_unique_id, CAST(recency AS INTEGER) AS recency, CAST(frequency AS BIGINT) AS frequency,
               coalesce(monetary, 0) AS monetary, zip_code, city, state,
               CAST(coalesce(total_items_volume, 0) AS BIGINT) AS total_items_volume,
               CAST(coalesce(payment_method_count, 0) AS BIGINT) AS payment_method_count,
               primary_payment_type,
               CAST(coalesce(max_installments, 0) AS INTEGER) AS max_installments,
               coalesce(avg_satisfaction, 0) AS avg_satisfaction,
               CAST(coalesce(min_review_score, 0) AS INTEGER) AS min_review_score,
               CAST(coalesce(total_reviews_given, 0) AS BIGINT) AS total_reviews_given,
               CAST(churn AS INTEGER) AS churn
        FROM labelled""",
}

_MASTER = """
    order_id, customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state,
    order_purchase_timestamp, CAST(total_order_payment AS DOUBLE) AS total_order_payment, max_installments,
    CAST(payment_method_count AS BIGINT) AS payment_method_count, primary_payment_type,
    CAST(total_price AS DOUBLE) AS total_price, CAST(total_freight AS DOUBLE) AS total_freight,
    CAST(total_items AS BIGINT) AS total_items, shipping_limit_date,
    round(Avg_review_score, 6) AS Avg_review_score, Min_review_score,
    CAST(Total_Review_Number AS BIGINT) AS Total_Review_Number"""


def _with_views(select: str) -> str:
    """Put the views that ``select`` needs, directly or through others, in front of it."""
    names = list(VIEWS)
    needed: set[str] = set()
    open_texts = [select]
    while open_texts:
        words = set(open_texts.pop().replace("(", " ").replace(")", " ").replace(",", " ").replace(".", " ").split())
        for name in names:
            if name in words and name not in needed:
                needed.add(name)
                open_texts.append(VIEWS[name])
    views = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in names if name in needed)
    return f"WITH {views}\n{select}" if views else select


def _snapshots(gold: str, *days_before_end: int) -> str:
    """The feature table at several snapshots, each with its own window and named by its date.

    While the response window is open the label is null."""
    parts = []
    for days in days_before_end:
        text = _with_views(
            f"SELECT g.* REPLACE (CASE WHEN CAST(CAST(split AS DATE) + 90 AS TIMESTAMP) <= newest THEN churn END AS churn), "
            f"CAST(CAST(split AS DATE) AS VARCHAR) AS snapshot_date FROM ({gold}) AS g, study_bounds"
        )
        own = f"""
        SELECT max(order_purchase_timestamp) - INTERVAL {days + 365} DAY AS start,
               max(order_purchase_timestamp) - INTERVAL {days} DAY AS split,
               max(order_purchase_timestamp) - INTERVAL {days} DAY + INTERVAL 90 DAY AS "end",
               max(order_purchase_timestamp) AS newest
        FROM clean_orders"""
        parts.append("SELECT * FROM (" + text.replace(VIEWS["study_bounds"], own) + ")")
    return "\nUNION ALL ".join(parts)


# The feature columns and those of the histograms.
FEATURES = [
    "recency",
    "frequency",
    "monetary",
    "total_items_volume",
    "payment_method_count",
    "max_installments",
    "avg_satisfaction",
    "min_review_score",
    "total_reviews_given",
]
HISTOGRAM_COLUMNS = ["recency", "frequency", "monetary", "total_items_volume", "max_installments", "avg_satisfaction"]


def _describe() -> str:
    parts = []
    for name in ["customer_unique_id", *FEATURES, "churn"]:
        parts.append(
            f"""SELECT '{name}' AS column_name, count({name}) AS "count", round(avg({name}), 6) AS mean,
                round(stddev_samp({name}), 6) AS stddev, CAST(min({name}) AS DOUBLE) AS "min",
                CAST(max({name}) AS DOUBLE) AS "max", CAST(NULL AS VARCHAR) AS min_text,
                CAST(NULL AS VARCHAR) AS max_text FROM gold"""
        )
    for name in ["zip_code", "city", "state", "primary_payment_type"]:
        parts.append(
            f"""SELECT '{name}', count({name}), round(avg(TRY_CAST({name} AS DOUBLE)), 6),
                round(stddev_samp(TRY_CAST({name} AS DOUBLE)), 6), NULL, NULL, min({name}), max({name}) FROM gold"""
        )
    return "\nUNION ALL ".join(parts)


def _correlation() -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS correlation FROM gold"
        for a in FEATURES
        for b in FEATURES
    )


def _bins() -> str:
    """Views ``ranges`` (per column), ``binned`` (per column and bin)."""
    ranges = "\nUNION ALL ".join(
        f"""SELECT '{name}' AS column_name, count({name}) AS total, CAST(min({name}) AS DOUBLE) AS low,
            (CAST(max({name}) AS DOUBLE) - CAST(min({name}) AS DOUBLE)) / 20 AS width,
            stddev_samp({name}) AS spread FROM gold"""
        for name in HISTOGRAM_COLUMNS
    )
    values = "\nUNION ALL ".join(
        f"SELECT '{name}' AS column_name, CAST({name} AS DOUBLE) AS v FROM gold" for name in HISTOGRAM_COLUMNS
    )
    return f"""
        ranges AS ({ranges}),
        long_values AS ({values}),
        counts AS (
            SELECT column_name,
                   CAST(least(coalesce(floor((v - low) / nullif(width, 0)), 0), 19) AS INTEGER) AS bin,
                   count(*) AS n
            FROM long_values JOIN ranges USING (column_name) WHERE v IS NOT NULL GROUP BY ALL),
        binned AS (
            SELECT ranges.column_name, CAST(b.bin AS INTEGER) AS bin, low + b.bin * width AS lower,
                   low + (b.bin + 1) * width AS upper, coalesce(n, 0) AS n, total, spread
            FROM ranges CROSS JOIN range(20) AS b(bin)
            LEFT JOIN counts ON counts.column_name = ranges.column_name AND counts.bin = b.bin)"""


def _histogram() -> str:
    return _with_views("SELECT * FROM gold").replace("SELECT * FROM gold", "").rstrip() + f""", {_bins()}
        SELECT column_name, bin, round(lower, 6) AS lower, round(upper, 6) AS upper,
               CAST(n AS BIGINT) AS "rows" FROM binned"""


def _density() -> str:
    """The kernel summed over the raw rows at every point within six bandwidths of one of them."""
    return _with_views("SELECT * FROM gold").replace("SELECT * FROM gold", "").rstrip() + f""", {_bins()},
        steps AS (SELECT column_name, total, spread * power(total, -0.2) AS h FROM ranges WHERE spread > 0),
        points AS (
            SELECT DISTINCT column_name, unnest(range(CAST(ceil(v / (h / 2) - 12) AS BIGINT),
                                                      CAST(floor(v / (h / 2) + 12) AS BIGINT) + 1)) AS point
            FROM long_values JOIN steps USING (column_name) WHERE v IS NOT NULL)
        SELECT column_name, point, round(point * any_value(h) / 2, 6) AS x, round(any_value(h) / 2, 6) AS step,
               round(sum(exp(-0.5 * power((point * h / 2 - v) / h, 2)))
                     / (any_value(total) * any_value(h) * sqrt(2 * pi())), 7) AS density
        FROM points JOIN steps USING (column_name) JOIN long_values USING (column_name)
        WHERE v IS NOT NULL GROUP BY column_name, point"""


def _exploration() -> str:
    """The exploration tables in long form."""
    share = """SELECT churn, round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS "percent" FROM gold GROUP BY churn"""
    top = "\nUNION ALL ".join(
        f"""SELECT '{name} ' || row_number() OVER (ORDER BY count(*) DESC, {name}) || ' ' || {name} AS key, count(*) AS "rows",
            row_number() OVER (ORDER BY count(*) DESC, {name}) AS place FROM gold WHERE {name} IS NOT NULL GROUP BY {name}"""
        for name in ("state", "primary_payment_type")
    )
    return _with_views(f"""
        SELECT 'describe' AS table_name, column_name AS key, stddev AS "value" FROM ({_describe()})
        UNION ALL SELECT 'class_share', CAST(churn AS VARCHAR), "percent" FROM ({share})
        UNION ALL SELECT 'histogram', column_name || ' ' || bin, CAST("rows" AS DOUBLE) FROM ({_histogram()})
        UNION ALL SELECT 'density', column_name || ' ' || point, density FROM ({_density()})
        UNION ALL SELECT 'top_categories', key, CAST("rows" AS DOUBLE) FROM ({top}) WHERE place <= 10
        UNION ALL SELECT 'correlation', column_a || ' ' || column_b, correlation FROM ({_correlation()})""")


RULES = {
    "rule_recency": ("CAST(recency AS DOUBLE)", "recency > 60"),
    "rule_frequency": ("-CAST(frequency AS DOUBLE)", "frequency <= 3"),
    "rule_mixed": (
        "recency - CAST(20 AS DOUBLE) * frequency - monetary / CAST(10000 AS DOUBLE)",
        "recency - CAST(20 AS DOUBLE) * frequency - monetary / CAST(10000 AS DOUBLE) > 0",
    ),
}


def _auc(rule: str) -> str:
    """One row: area, positives, negatives, by comparing each positive with all lower scores."""
    return f"""
        SELECT sum(pos * (below + neg / 2.0)) / (sum(pos) * sum(neg)) AS auc_roc,
               CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives
        FROM (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY score
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
              FROM (SELECT {RULES[rule][0]} AS score, CAST(sum(churn) AS DOUBLE) AS pos,
                           CAST(sum(1 - churn) AS DOUBLE) AS neg FROM gold GROUP BY ALL))"""


def _decisions(rule: str) -> str:
    """One row: accuracy, weighted precision, weighted recall and F1 from the four cells."""
    return f"""
        SELECT (tp + tn) / (tp + tn + fp + fn) AS accuracy,
               ((tp + fn) * tp / (tp + fp) + (tn + fp) * tn / (tn + fn)) / (tp + tn + fp + fn) AS weighted_precision,
               (tp + tn) / (tp + tn + fp + fn) AS weighted_recall,
               ((tp + fn) * 2 * tp / (2 * tp + fp + fn) + (tn + fp) * 2 * tn / (2 * tn + fp + fn))
                   / (tp + tn + fp + fn) AS f1
        FROM (SELECT CAST(count(*) FILTER (WHERE churn = 1 AND claim) AS DOUBLE) AS tp,
                     CAST(count(*) FILTER (WHERE churn = 0 AND NOT claim) AS DOUBLE) AS tn,
                     CAST(count(*) FILTER (WHERE churn = 0 AND claim) AS DOUBLE) AS fp,
                     CAST(count(*) FILTER (WHERE churn = 1 AND NOT claim) AS DOUBLE) AS fn
              FROM (SELECT churn, {RULES[rule][1]} AS claim FROM gold))"""


def _rule_board() -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{rule}' AS run_id, '{rule}' AS run_name, round(accuracy, 6) AS accuracy,
            round(auc_roc, 6) AS auc_roc, round(weighted_precision, 6) AS "precision",
            round(weighted_recall, 6) AS recall, round(f1, 6) AS f1_score
            FROM ({_auc(rule)}), ({_decisions(rule)})"""
        for rule in RULES
    )


def _report() -> str:
    return f"""
        SELECT customer_unique_id, {", ".join(FEATURES)}, '🔴 HIGH RISK' AS risk_status,
               round(chance, 9) AS churn_probability
        FROM (SELECT * REPLACE (round(avg_satisfaction, 6) AS avg_satisfaction),
                     1 / (1 + exp(-({RULES['rule_mixed'][0]}) / CAST(100 AS DOUBLE))) AS chance FROM gold)
        WHERE chance > 0.5"""


HASHED = "CAST('0x' || substr(md5(CAST(customer_unique_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296"


def _fact_rows(facts: dict[str, str]) -> str:
    """Rows (fact, value), each value an expression over the feature table."""
    return "\nUNION ALL ".join(
        f"SELECT '{name}' AS fact, CAST({value} AS BIGINT) AS \"value\"" for name, value in facts.items()
    )


def _train_facts() -> str:
    held_out = f"(SELECT count(*) FROM gold WHERE {HASHED} >= 0.7)"
    return _fact_rows(
        {
            "held_out": held_out,
            "churned": f"(SELECT sum(churn) FROM gold WHERE {HASHED} >= 0.7)",
            "probabilities": held_out,
            "fitting_predictions": held_out,
            "equal_metrics": "5",
            "speed_metrics": "3",
            "logged_metrics": "8",
        }
    )


def _tune_facts(draws: int) -> str:
    facts = {name: str(draws) for name in ("trials", "finished", "areas", "draws_in_space")}
    return _fact_rows(facts | {"best_is_largest": "1", "scored_people": "(SELECT count(*) FROM gold)"})


def _window(gold: str, days: int) -> str:
    """The feature table with another response window."""
    text = _with_views(gold)
    return text.replace("INTERVAL 455 DAY", f"INTERVAL {365 + days} DAY").replace("INTERVAL 90 DAY", f"INTERVAL {days} DAY").replace(
        "CAST(split AS DATE) + 90", f"CAST(split AS DATE) + {days}"
    )


def _queries() -> dict[str, str]:
    gold = "SELECT * REPLACE (round(avg_satisfaction, 6) AS avg_satisfaction) FROM gold"
    return {
        "clean_orders": "SELECT order_id, customer_id, order_purchase_timestamp FROM clean_orders",
        "payments_by_order": """
            SELECT order_id, CAST(total_order_payment AS DOUBLE) AS total_order_payment, max_installments,
                   payment_method_count, primary_payment_type FROM payments_by_order""",
        "items_by_order": """
            SELECT order_id, CAST(total_price AS DOUBLE) AS total_price, CAST(total_freight AS DOUBLE) AS total_freight,
                   total_items, shipping_limit_date FROM items_by_order""",
        "reviews_by_order": """
            SELECT order_id, round(Avg_review_score, 6) AS Avg_review_score, Min_review_score, Total_Review_Number
            FROM reviews_by_order""",
        "order_facts": """
            SELECT order_id, CAST(total_order_payment AS DOUBLE) AS total_order_payment, max_installments,
                   payment_method_count, primary_payment_type, CAST(total_price AS DOUBLE) AS total_price,
                   CAST(total_freight AS DOUBLE) AS total_freight, total_items, shipping_limit_date,
                   round(Avg_review_score, 6) AS Avg_review_score, Min_review_score, Total_Review_Number
            FROM payments_by_order FULL JOIN items_by_order USING (order_id)
            FULL JOIN reviews_by_order USING (order_id)""",
        "order_master": f"SELECT {_MASTER} FROM order_master",
        "study_bounds": "SELECT * FROM study_bounds",
        "study_period": f"SELECT {_MASTER} FROM study_period",
        "observation": f"SELECT {_MASTER} FROM observation",
        "response": f"SELECT {_MASTER} FROM response",
        "active_customers": "SELECT * FROM active_customers",
        "rfm_features": """
            SELECT customer_unique_id, CAST(recency AS INTEGER) AS recency, frequency, monetary,
                   CAST(total_items_volume AS BIGINT) AS total_items_volume, payment_method_count, max_installments,
                   round(avg_satisfaction, 6) AS avg_satisfaction, min_review_score,
                   CAST(total_reviews_given AS BIGINT) AS total_reviews_given,
                   zip_code, city, state, primary_payment_type FROM rfm_features""",
        "label_churn": "SELECT customer_unique_id, CAST(churn AS INTEGER) AS churn FROM labelled",
        "churn_gold": gold,
        "silver_orders": """
            SELECT clean_orders.*, CAST(total_order_payment AS DOUBLE) AS total_order_payment, max_installments,
                   payment_method_count, primary_payment_type, CAST(total_price AS DOUBLE) AS total_price,
                   CAST(total_freight AS DOUBLE) AS total_freight, total_items, shipping_limit_date,
                   round(Avg_review_score, 6) AS Avg_review_score, Min_review_score, Total_Review_Number
            FROM clean_orders LEFT JOIN payments_by_order USING (order_id)
            LEFT JOIN items_by_order USING (order_id) LEFT JOIN reviews_by_order USING (order_id)""",
        "silver_refresh": """
            SELECT clean_orders.*, CAST(total_order_payment AS DOUBLE) AS total_order_payment, max_installments,
                   payment_method_count, primary_payment_type, CAST(total_price AS DOUBLE) AS total_price,
                   CAST(total_freight AS DOUBLE) AS total_freight, total_items, shipping_limit_date,
                   round(Avg_review_score, 6) AS Avg_review_score, Min_review_score, Total_Review_Number
            FROM clean_orders LEFT JOIN payments_by_order USING (order_id)
            LEFT JOIN items_by_order USING (order_id) LEFT JOIN reviews_by_order USING (order_id)""",
        "gold_from_silver": gold,
        "feature_store": _snapshots(gold, 90, 120, 455, 30),
        "exploration": _exploration(),
        "score_later": f"""
            SELECT * FROM (SELECT snapshot_date, count(*) AS people, count(churn) AS labelled, CAST(sum(churn) AS BIGINT) AS churned,
                   true AS report_fits, true AS measured FROM ({_snapshots(gold, 270, 180, 90, 30)}) GROUP BY snapshot_date)""",
        "reviewed": "SELECT customer_unique_id, CAST(total_reviews_given > 0 AS INTEGER) AS reviewed FROM gold",
        "daily_snapshots": _snapshots(gold, *range(90, 120)),
        "describe": _describe(),
        "value_share": """
            SELECT churn, count(*) AS "rows", round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS "percent"
            FROM gold GROUP BY churn""",
        "correlation": _correlation(),
        "histogram": _histogram(),
        "density": _density(),
        "top_categories": "\nUNION ALL ".join(
            f"""(SELECT '{name}' AS column_name, {name} AS "value", count(*) AS "rows",
                 CAST(row_number() OVER (ORDER BY count(*) DESC, {name}) AS INTEGER) AS place
                 FROM gold WHERE {name} IS NOT NULL GROUP BY {name} ORDER BY count(*) DESC, {name} LIMIT 10)"""
            for name in ("state", "primary_payment_type")
        ),
        "class_weights": """
            SELECT count(*) AS total, CAST(sum(churn) AS BIGINT) AS churned_rows,
                   CAST(sum(1 - churn) AS BIGINT) AS stayed_rows,
                   CAST(count(*) AS DOUBLE) / (2 * sum(churn)) AS churned_weight,
                   CAST(count(*) AS DOUBLE) / (2 * sum(1 - churn)) AS stayed_weight FROM gold""",
        "weighted_gold": """
            SELECT * REPLACE (round(avg_satisfaction, 6) AS avg_satisfaction),
                   CASE WHEN churn = 1 THEN CAST(count(*) OVER () AS DOUBLE) / (2 * sum(churn) OVER ())
                           ELSE CAST(count(*) OVER () AS DOUBLE) / (2 * sum(1 - churn) OVER ()) END AS weight
            FROM gold""",
        "hash_split": """
            SELECT customer_unique_id,
                   CASE WHEN CAST('0x' || substr(md5(CAST(customer_unique_id AS VARCHAR)), 1, 8) AS BIGINT) < 0.7 * 4294967296
                        THEN 'train' ELSE 'test' END AS part
            FROM gold""",
        "auc_roc": f"SELECT round(auc_roc, 9) AS auc_roc, positives, negatives FROM ({_auc('rule_mixed')})",
        "classification_metrics": f"""
            SELECT round(accuracy, 6) AS accuracy, round(weighted_precision, 6) AS weighted_precision,
                   round(weighted_recall, 6) AS weighted_recall, round(f1, 6) AS f1
            FROM ({_decisions('rule_mixed')})""",
        "risk_status": f"""
            SELECT customer_unique_id, CAST(CASE WHEN chance > 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS prediction,
                   CASE WHEN chance > 0.5 THEN '🔴 HIGH RISK' ELSE '🟢 LOW RISK' END AS risk_status
            FROM (SELECT *, 1 / (1 + exp(-({RULES['rule_mixed'][0]}) / CAST(100 AS DOUBLE))) AS chance FROM gold)""",
        "churn_report": _report(),
        "stored_report": _report(),
        "random_split": "SELECT customer_unique_id FROM gold",
        "leaderboard": _rule_board(),
        "best_run": f"""
            SELECT run_id, run_name, auc_roc FROM ({_rule_board()}) ORDER BY auc_roc DESC, run_id LIMIT 1""",
        "csv_roundtrip": "SELECT doc_id, lang, text FROM documents",
        "register_directory": """
            SELECT 'customers' AS table_name, count(*) AS "rows", count(DISTINCT customer_id) AS "keys" FROM customers
            UNION ALL SELECT 'orders', count(*), count(DISTINCT order_id) FROM shop_orders
            UNION ALL SELECT 'payments', count(*), count(DISTINCT order_id) FROM payments
            UNION ALL SELECT 'items', count(*), count(DISTINCT order_id) FROM items
            UNION ALL SELECT 'reviews', count(*), count(DISTINCT order_id) FROM reviews""",
        "model_roundtrip": "SELECT customer_unique_id, true AS same FROM gold",
        "saved_run": "SELECT customer_unique_id, true AS same FROM gold",
        "score_batch": """
            SELECT customer_unique_id, true AS is_probability, true AS prediction_fits, true AS risk_fits FROM gold""",
        "train_rf": _train_facts(),
        "train_gbt": _train_facts(),
        "train_lr": _train_facts(),
        "tune_gbt": _tune_facts(30),
        "tune_rf": _tune_facts(60),
        "tune_lr": _tune_facts(120),
        "failing_trial": """
            SELECT CAST(4 AS BIGINT) AS trials, true AS failed_as_drawn, true AS best_could_be_fitted""",
        "run_log": "\nUNION ALL ".join(
            f"SELECT '{rule}' AS run_id, name, round(\"value\", 6) AS \"value\" FROM "
            f"(UNPIVOT ({_decisions(rule)}) ON accuracy, weighted_precision, weighted_recall, f1 INTO NAME name VALUE \"value\")"
            for rule in RULES
        ),
        "throughput": _fact_rows({"rows": "(SELECT count(*) FROM gold)", "consistent": "1"}),
        "preview": "SELECT least(5, count(*)) AS \"rows\" FROM gold",
        "default_features": "\nUNION ALL ".join(
            f"SELECT CAST({i} AS INTEGER) AS place, count(*) AS \"rows\", round(sum(CAST({name} AS DOUBLE)), 2) AS total FROM gold"
            for i, name in enumerate(FEATURES[:3])
        ),
        "scored_report": _fact_rows(
            dict.fromkeys(("predicted_but_not_reported", "reported_but_not_predicted", "wrong_labels", "unlikely"), "0")
        ),
        "churn_window_30": _window(gold, 30),
        "hash_split_80": f"""
            SELECT CASE WHEN {HASHED} < 0.8 THEN 'train' ELSE 'check' END AS part, count(*) AS "rows",
                   CAST(sum(churn) AS BIGINT) AS churned FROM gold GROUP BY ALL""",
    }


def oracle_sql() -> dict[str, str]:
    complete = ("WITH", "SELECT * FROM (WITH")
    return {name: text if text.lstrip().startswith(complete) else _with_views(text) for name, text in _queries().items()}
