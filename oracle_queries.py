"""DuckDB SQL for every registered query, written apart from the Spark code.

Queries are assembled from the named relations in ``RELATIONS``; a query lists the ones it needs
and their own needs follow.
"""

from __future__ import annotations

LINE_ORDER = (
    "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, "
    "l_returnflag, l_linestatus"
)
# The category lists of the score.
HIGH = "('shopping_net', 'misc_net', 'grocery_pos', 'shopping_pos', 'misc_pos')"
MEDIUM = "('entertainment', 'gas_transport', 'food_dining')"


def events_sql(lines: str) -> str:
    return f"""
    SELECT l_orderkey || '-' || l_linenumber AS trans_num,
      o_orderdate + to_hours(l_partkey % 24) AS trans_at,
      l_shipdate + to_hours(l_suppkey % 24) AS ingested_at,
      strftime(trans_at, '%Y-%m-%d %H:%M:%S') AS trans_date_trans_time,
      epoch(trans_at)::BIGINT AS unix_time,
      round(l_extendedprice::DECIMAL(12,2) * (1 - l_discount::DECIMAL(4,2))
        * 0.01::DECIMAL(4,2), 2)::DECIMAL(12,2) AS amt,
      o_custkey AS cc_num, s_name AS merchant,
      CASE p_type WHEN 'ECONOMY' THEN 'shopping_net' WHEN 'SMALL' THEN 'grocery_pos'
        WHEN 'MEDIUM' THEN 'entertainment' WHEN 'PROMO' THEN 'misc_net'
        WHEN 'STANDARD' THEN 'food_dining' WHEN 'LARGE' THEN 'health_fitness' END AS category,
      25 + (c_custkey * 41 % 240) / 10.0e0 AS lat,
      -120 + (c_custkey * 53 % 500) / 10.0e0 AS "long",
      lat + ((l_partkey % 21) - 10) * 0.5e0 AS merch_lat,
      "long" + ((l_suppkey % 21) - 10) * 0.5e0 AS merch_long,
      (500 + c_custkey * 37 % 100000)::INTEGER AS city_pop,
      (l_returnflag = 'R' AND l_discount >= 0.09e0 AND l_tax >= 0.07e0)::INTEGER AS is_fraud,
      split_part(c_name, '#', 1) AS first, split_part(c_name, '#', 2) AS last,
      CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
      (DATE '1935-01-01' + (c_custkey * 97 % 16000)::INTEGER)::VARCHAR AS dob,
      c_mktsegment AS job, (c_custkey % 900 + 1) || ' Main St' AS street,
      n_name AS city, n_name AS state,
      lpad((c_custkey % 100000)::VARCHAR, 5, '0') AS zip,
      strftime(ingested_at, '%Y-%m-%dT%H:%M:%S') || '.000000+00:00' AS produced_at,
      CASE WHEN o_orderstatus = 'O' THEN 'stream' ELSE 'batch' END AS source,
      CASE WHEN o_orderstatus <> 'O' THEN o_custkey END AS customer_id,
      CASE WHEN o_orderstatus <> 'O' THEN l_suppkey END AS merchant_id
    FROM {lines} JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
      JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey
      JOIN supplier ON l_suppkey = s_suppkey"""


def scored_sql(relation: str, distance: str = "exact_km") -> str:
    """Bands, score and reason of events."""
    return f"""
    SELECT *,
      CASE WHEN amt > 1000 THEN 1e0 WHEN amt > 500 THEN 0.7e0 WHEN amt > 200 THEN 0.4e0
        ELSE 0.1e0 END AS amount_band,
      CASE WHEN distance_km > 500 THEN 1e0 WHEN distance_km > 200 THEN 0.7e0
        WHEN distance_km > 50 THEN 0.3e0 ELSE 0e0 END AS distance_band,
      CASE WHEN category IN {HIGH} THEN 0.6e0 WHEN category IN {MEDIUM} THEN 0.3e0
        ELSE 0.1e0 END AS category_band,
      round(least(0.4e0 * amount_band + 0.4e0 * distance_band + 0.2e0 * category_band, 1e0), 4)
        AS risk_score,
      coalesce(nullif(concat_ws(' | ',
        CASE WHEN distance_km > 200 THEN 'distance ' || printf('%.0f', distance_km)
          || 'km from home' END,
        CASE WHEN amt > 500 THEN 'high amount $' || printf('%.2f', amt::DOUBLE) END,
        CASE WHEN category IN {HIGH} THEN 'high-risk category: ' || category END), ''),
        'rule-based flag') AS alert_reason
    FROM (
      SELECT *, {distance} AS distance_km FROM (
        SELECT *, pow(sin(radians(merch_lat - lat) / 2), 2) + cos(radians(lat))
            * cos(radians(merch_lat)) * pow(sin(radians(merch_long - "long") / 2), 2) AS chord,
          round(6371e0 * 2 * atan2(sqrt(chord), sqrt(greatest(1 - chord, 0e0))), 2) AS exact_km
        FROM {relation}))"""


def percentage(part: str, whole: str) -> str:
    """Exact integer rounding, half up, to four decimals."""
    return f"((2 * {part} * 1000000 + {whole}) // (2 * {whole}))::BIGINT / 10000e0"


def first_wins(relation: str, keys: str, order: str) -> str:
    return (
        f"SELECT * EXCLUDE rn FROM (SELECT *, row_number() OVER (PARTITION BY {keys} "
        f"ORDER BY {order}) AS rn FROM {relation}) WHERE rn = 1"
    )


def age(born: str) -> str:
    return (
        f"(2001 - year({born}) - ('1231' < strftime({born}, '%m%d'))::INTEGER)::INTEGER"
    )


STREAM_ORDER = "unix_time, produced_at, amt, is_fraud, category, distance_km"

# name -> (needed relations, SQL)
RELATIONS: dict[str, tuple[str, str]] = {
    "lines": ("", first_wins("lineitem", "l_orderkey, l_linenumber", LINE_ORDER)),
    "raw": ("", events_sql("lineitem")),
    "uniq": ("lines", events_sql("lines")),
    "scored": ("uniq", scored_sql("uniq")),
    "narrow": ("uniq", scored_sql("uniq", "exact_km::FLOAT::DOUBLE")),
    "alerts": (
        "scored",
        """SELECT trans_num AS trans_id, ingested_at AS detected_at,
          risk_score::DECIMAL(5,4) AS risk_score, distance_km::DECIMAL(10,2) AS distance_km,
          alert_reason FROM scored
          WHERE source = 'stream' AND (is_fraud = 1 OR risk_score >= 0.7e0)""",
    ),
    "txns": (
        "uniq",
        """SELECT trans_num AS trans_id, customer_id, merchant_id, trans_at, unix_time,
          amt AS amount, is_fraud, source, ingested_at FROM uniq""",
    ),
    "custs": (
        "",
        """SELECT c_custkey AS customer_id, c_custkey AS cc_num,
          split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
          CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
          DATE '1935-01-01' + (c_custkey * 97 % 16000)::INTEGER AS dob, c_mktsegment AS job,
          n_name AS city, n_name AS state, lpad((c_custkey % 100000)::VARCHAR, 5, '0') AS zip,
          25 + (c_custkey * 41 % 240) / 10.0e0 AS lat,
          -120 + (c_custkey * 53 % 500) / 10.0e0 AS "long",
          (500 + c_custkey * 37 % 100000)::INTEGER AS city_pop,
          TIMESTAMP '1995-01-01' + to_hours(c_custkey) AS created_at
          FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "merchs": (
        "",
        """SELECT s_suppkey AS merchant_id, s_name AS merchant_name,
          CASE WHEN s_suppkey % 2 = 1 THEN ' ' || upper(name) ELSE name END AS category,
          25 + (s_suppkey * 31 % 240) / 10.0e0 AS merch_lat,
          -120 + (s_suppkey * 59 % 500) / 10.0e0 AS merch_long,
          TIMESTAMP '1995-01-01' + to_hours(s_suppkey) AS created_at
          FROM (SELECT *, ['shopping_net', 'grocery_pos', 'entertainment', 'misc_net',
            'food_dining', 'health_fitness'][(s_suppkey % 6 + 1)::INTEGER] AS name
            FROM supplier)""",
    ),
    "stg_transactions": (
        "txns",
        """SELECT trans_id, customer_id, merchant_id, trans_at, unix_time,
          hour(trans_at)::INTEGER AS hour_of_day, dayofweek(trans_at)::INTEGER AS day_of_week,
          dayofweek(trans_at) IN (0, 6) AS is_weekend, amount, is_fraud, source, ingested_at
          FROM txns""",
    ),
    "stg_customers": (
        "custs",
        f"""SELECT customer_id, cc_num, trim(first_name || ' ' || last_name) AS full_name,
          first_name, last_name, gender, dob, {age("dob")} AS age, job, city, state, zip, lat,
          "long", city_pop FROM custs""",
    ),
    "stg_merchants": (
        "merchs",
        """SELECT merchant_id, merchant_name, lower(trim(category)) AS category, merch_lat,
          merch_long FROM merchs""",
    ),
    "int_transaction_stats": (
        "stg_transactions stg_customers stg_merchants",
        """SELECT t.trans_id, t.trans_at, t.hour_of_day, t.day_of_week, t.is_weekend, t.amount,
          t.is_fraud, t.source, t.ingested_at, t.customer_id, c.full_name AS customer_name,
          c.age AS customer_age, c.gender AS customer_gender, c.job AS customer_job,
          c.city AS customer_city, c.state AS customer_state, c.city_pop AS customer_city_pop,
          c.lat AS customer_lat, c."long" AS customer_long, t.merchant_id, m.merchant_name,
          m.category AS merchant_category, m.merch_lat, m.merch_long
          FROM stg_transactions t
          LEFT JOIN stg_customers c ON t.customer_id = c.customer_id
          LEFT JOIN stg_merchants m ON t.merchant_id = m.merchant_id""",
    ),
    "dim_customer": (
        "stg_customers",
        """SELECT customer_id, cc_num, full_name, gender, age, job, city, state, zip, city_pop,
          lat, "long" FROM stg_customers""",
    ),
    "dim_merchant": ("stg_merchants", "SELECT * FROM stg_merchants"),
    "dim_date": (
        "",
        """SELECT strftime(full_date, '%Y%m%d')::INTEGER AS date_id, full_date,
          year(full_date)::INTEGER AS year, month(full_date)::INTEGER AS month,
          day(full_date)::INTEGER AS day, dayofweek(full_date)::INTEGER AS day_of_week,
          rpad(dayname(full_date), 9, ' ') AS day_name,
          rpad(monthname(full_date), 9, ' ') AS month_name,
          quarter(full_date)::INTEGER AS quarter,
          dayofweek(full_date) IN (0, 6) AS is_weekend
          FROM (SELECT unnest(generate_series(make_date(min(year(o_orderdate)), 1, 1)::TIMESTAMP,
            make_date(max(year(o_orderdate)), 12, 31)::TIMESTAMP, INTERVAL 1 DAY))::DATE
            AS full_date FROM orders)""",
    ),
    "calendar": (
        "",
        """SELECT strftime(full_date, '%Y%m%d')::INTEGER AS date_id, full_date FROM (
          SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-12-31',
            INTERVAL 1 DAY))::DATE AS full_date)""",
    ),
    "fact_transactions": (
        "stg_transactions calendar",
        """SELECT trans_id, customer_id, merchant_id, date_id, trans_at, amount, is_fraud,
          source, hour_of_day, is_weekend, ingested_at
          FROM stg_transactions LEFT JOIN calendar ON trans_at::DATE = full_date""",
    ),
    "mart_fraud_summary": (
        "int_transaction_stats",
        f"""SELECT *, {percentage("fraud_count", "total_transactions")} AS fraud_rate_pct FROM (
          SELECT trans_at::DATE AS txn_date, merchant_category, customer_state,
            count(*) AS total_transactions, sum(amount)::DECIMAL(22,2) AS total_amount,
            sum(amount)::DOUBLE / count(amount) AS avg_amount,
            sum(is_fraud)::BIGINT AS fraud_count,
            sum(CASE WHEN is_fraud = 1 THEN amount END)::DOUBLE
              / nullif(count(CASE WHEN is_fraud = 1 THEN amount END), 0) AS avg_fraud_amount,
            sum(CASE WHEN source = 'stream' THEN 1 ELSE 0 END)::BIGINT AS stream_count,
            sum(CASE WHEN source = 'batch' THEN 1 ELSE 0 END)::BIGINT AS batch_count
          FROM int_transaction_stats GROUP BY 1, 2, 3)""",
    ),
    "mart_customer_360": (
        "int_transaction_stats",
        f"""SELECT *, {percentage("total_fraud_count", "total_transactions")} AS fraud_rate_pct,
          CASE WHEN total_fraud_count * 20 > total_transactions THEN 'HIGH'
            WHEN total_fraud_count * 100 > total_transactions THEN 'MEDIUM'
            ELSE 'LOW' END AS risk_tier FROM (
          SELECT customer_id, customer_name, customer_age, customer_gender, customer_job,
            customer_state, customer_city, customer_city_pop, count(*) AS total_transactions,
            sum(amount)::DECIMAL(22,2) AS total_spend,
            sum(amount)::DOUBLE / count(amount) AS avg_transaction_amount,
            max(amount) AS max_transaction_amount, sum(is_fraud)::BIGINT AS total_fraud_count,
            mode() WITHIN GROUP (ORDER BY merchant_category) AS top_category,
            min(trans_at) AS first_transaction_at, max(trans_at) AS last_transaction_at
          FROM int_transaction_stats GROUP BY ALL)""",
    ),
    "log": (
        "",
        """SELECT CASE WHEN event_type = 'error' THEN 'dlq_transactions'
          ELSE 'raw_transactions' END AS topic, (event_id % 3)::INTEGER AS partition,
          event_id // 3 AS "offset", ts, props AS value FROM events""",
    ),
    "depth": (
        "log",
        """SELECT topic, sum(n)::BIGINT AS depth FROM (SELECT topic, partition,
          max("offset") + 1 - min("offset") AS n FROM log GROUP BY 1, 2) GROUP BY 1""",
    ),
    "stream_raw": ("raw", "SELECT * FROM raw WHERE source = 'stream'"),
    "stream_all": ("stream_raw", scored_sql("stream_raw")),
    "stream_scored": ("stream_all", first_wins("stream_all", "trans_num", STREAM_ORDER)),
    "outcomes": (
        "uniq",
        """SELECT CASE hour(trans_at) WHEN 12 THEN 'malformed json' WHEN 7 THEN 'trans_num is null'
          WHEN 8 THEN 'trans_at is null' WHEN 9 THEN 'amount is null'
          WHEN 10 THEN 'coordinates are null' WHEN 11 THEN 'is_fraud not in (0, 1)'
          ELSE 'accepted' END AS outcome FROM uniq""",
    ),
    "batch_raw": ("raw", "SELECT * FROM raw WHERE source = 'batch'"),
    "loaded": (
        "batch_raw",
        first_wins("batch_raw", "trans_num", "unix_time, trans_at, amt, is_fraud"),
    ),
}


def build(needs: str, sql: str) -> str:
    """Prefix a query with the relations it needs, each once and in dependency order."""
    ordered: dict[str, str] = {}

    def add(name: str) -> None:
        wanted, text = RELATIONS[name]
        for other in wanted.split():
            add(other)
        ordered.setdefault(name, text)

    for name in needs.split():
        add(name)
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({t})" for n, t in ordered.items()) + "\n" + sql


# The declared tests of every model; the last item says which rows fail.
CHECKS = (
    ("stg_transactions", "trans_id", "not_null", "trans_id IS NULL"),
    ("stg_transactions", "trans_id", "unique", ""),
    ("stg_transactions", "amount", "not_null", "amount IS NULL"),
    ("stg_transactions", "amount", "accepted_range", "amount < 0 OR amount > 50000"),
    ("stg_transactions", "is_fraud", "not_null", "is_fraud IS NULL"),
    ("stg_transactions", "is_fraud", "accepted_values", "is_fraud NOT IN (0, 1)"),
    ("stg_transactions", "source", "not_null", "source IS NULL"),
    ("stg_transactions", "source", "accepted_values", "source NOT IN ('batch', 'stream')"),
    ("stg_transactions", "trans_at", "not_null", "trans_at IS NULL"),
    ("stg_customers", "customer_id", "not_null", "customer_id IS NULL"),
    ("stg_customers", "customer_id", "unique", ""),
    ("stg_customers", "cc_num", "not_null", "cc_num IS NULL"),
    ("stg_customers", "cc_num", "unique", ""),
    ("stg_customers", "full_name", "not_null", "full_name IS NULL"),
    ("stg_customers", "state", "not_null", "state IS NULL"),
    ("stg_merchants", "merchant_id", "not_null", "merchant_id IS NULL"),
    ("stg_merchants", "merchant_id", "unique", ""),
    ("stg_merchants", "merchant_name", "not_null", "merchant_name IS NULL"),
    ("stg_merchants", "merchant_name", "unique", ""),
    ("stg_merchants", "category", "not_null", "category IS NULL"),
    ("int_transaction_stats", "trans_id", "not_null", "trans_id IS NULL"),
    ("int_transaction_stats", "trans_id", "unique", ""),
    ("int_transaction_stats", "amount", "not_null", "amount IS NULL"),
    ("int_transaction_stats", "amount", "accepted_range", "amount < 0"),
    ("int_transaction_stats", "is_fraud", "not_null", "is_fraud IS NULL"),
    ("int_transaction_stats", "is_fraud", "accepted_values", "is_fraud NOT IN (0, 1)"),
    ("int_transaction_stats", "customer_age", "accepted_range", "customer_age < 18 OR customer_age > 110"),
    ("fact_transactions", "trans_id", "not_null", "trans_id IS NULL"),
    ("fact_transactions", "trans_id", "unique", ""),
    ("fact_transactions", "amount", "not_null", "amount IS NULL"),
    ("fact_transactions", "amount", "accepted_range", "amount < 0"),
    ("fact_transactions", "is_fraud", "not_null", "is_fraud IS NULL"),
    ("fact_transactions", "is_fraud", "accepted_values", "is_fraud NOT IN (0, 1)"),
    ("fact_transactions", "source", "not_null", "source IS NULL"),
    ("fact_transactions", "source", "accepted_values", "source NOT IN ('batch', 'stream')"),
    ("dim_customer", "customer_id", "not_null", "customer_id IS NULL"),
    ("dim_customer", "customer_id", "unique", ""),
    ("dim_merchant", "merchant_id", "not_null", "merchant_id IS NULL"),
    ("dim_merchant", "merchant_id", "unique", ""),
    ("dim_date", "date_id", "not_null", "date_id IS NULL"),
    ("dim_date", "date_id", "unique", ""),
    ("dim_date", "full_date", "not_null", "full_date IS NULL"),
    ("dim_date", "full_date", "unique", ""),
    ("mart_fraud_summary", "txn_date", "not_null", "txn_date IS NULL"),
    ("mart_fraud_summary", "total_transactions", "not_null", "total_transactions IS NULL"),
    ("mart_fraud_summary", "total_transactions", "accepted_range", "total_transactions < 1"),
    ("mart_fraud_summary", "fraud_rate_pct", "accepted_range", "fraud_rate_pct < 0 OR fraud_rate_pct > 100"),
    ("mart_customer_360", "total_transactions", "not_null", "total_transactions IS NULL"),
    ("mart_customer_360", "total_transactions", "accepted_range", "total_transactions < 1"),
    ("mart_customer_360", "risk_tier", "not_null", "risk_tier IS NULL"),
    ("mart_customer_360", "risk_tier", "accepted_values", "risk_tier NOT IN ('HIGH', 'MEDIUM', 'LOW')"),
)
ALL_CHECKS = CHECKS
STAGING_CHECKS = [check for check in CHECKS if check[0].startswith("stg_")]


def check_sql(checks, tables: dict[str, str]) -> str:
    """The check report as a union of counts; ``tables`` maps a model to its relation."""
    parts = []
    for model, column, test, fails in checks:
        relation = tables.get(model, model)
        count = f"SELECT count(*) FROM {relation} WHERE {fails}"
        if test == "unique":
            count = (
                f"SELECT count(*) FROM (SELECT {column} FROM {relation} WHERE {column} "
                f"IS NOT NULL GROUP BY {column} HAVING count(*) > 1)"
            )
        parts.append(
            f"SELECT '{model}' AS model, '{column}' AS column_name, "
            f"'{test}' AS test, ({count}) AS failures"
        )
    return "\nUNION ALL ".join(parts)


ALL_MODELS = (
    "stg_transactions stg_customers stg_merchants int_transaction_stats fact_transactions "
    "dim_customer dim_merchant dim_date mart_fraud_summary mart_customer_360"
)
IS_ALERT = "(is_fraud = 1 OR risk_score >= 0.7e0)"
SUMMARY_RATE = percentage("sum(fraud_count)", "sum(total_transactions)")


def band(value: str, yellow: str, red: str) -> str:
    return (
        f"CASE WHEN {value} >= {red} THEN 'red' WHEN {value} >= {yellow} THEN 'yellow' "
        f"WHEN {value} IS NOT NULL THEN 'green' END"
    )


def hourly(relation: str, column: str, name: str, where: str = "true") -> str:
    return (
        f"SELECT date_trunc('hour', {column}) AS time, count(*) AS {name} "
        f"FROM {relation} WHERE {where} GROUP BY 1"
    )


def precision_recall_sql(where: str) -> str:
    return f"""SELECT *, true_positive::DOUBLE / nullif(true_positive + false_positive, 0)
      AS precision, true_positive::DOUBLE / nullif(true_positive + false_negative, 0) AS recall
      FROM (
        SELECT count(*) FILTER (WHERE risk_score >= 0.7e0 AND is_fraud = 1) AS true_positive,
          count(*) FILTER (WHERE risk_score >= 0.7e0 AND is_fraud <> 1) AS false_positive,
          count(*) FILTER (WHERE risk_score < 0.7e0 AND is_fraud = 1) AS false_negative,
          count(*) FILTER (WHERE risk_score < 0.7e0 AND is_fraud <> 1) AS true_negative
        FROM scored WHERE {where})"""


STAR = """SELECT f.date_id, f.trans_id, f.customer_id, f.merchant_id, f.trans_at, f.amount,
  f.is_fraud, f.source, f.hour_of_day, f.is_weekend, f.ingested_at, c.full_name, c.age, c.job,
  c.state AS customer_state, m.merchant_name, m.category AS merchant_category, d.full_date,
  rpad(dayname(d.full_date), 9, ' ') AS day_name,
  rpad(monthname(d.full_date), 9, ' ') AS month_name, quarter(d.full_date)::INTEGER AS quarter
  FROM fact_transactions f LEFT JOIN dim_customer c ON f.customer_id = c.customer_id
  LEFT JOIN dim_merchant m ON f.merchant_id = m.merchant_id
  LEFT JOIN calendar d ON f.date_id = d.date_id"""

WINDOWS = """SELECT make_timestamp(tick * 15000000) AS window_start,
  make_timestamp((tick + 1) * 15000000) AS window_end, count(*) AS events,
  count(*) / 15e0 AS events_per_second
  FROM (SELECT epoch_us(ts) // 15000000 AS tick FROM events) GROUP BY tick"""

# The staged models of a CSV load. Surrogate keys are hashes in Spark; their natural keys stand in
# for them here, which the counts cannot tell apart.
LOADED_MODELS = {
    "stg_transactions": "(SELECT trans_num AS trans_id, amt AS amount, is_fraud, source, "
    "trans_at FROM loaded)",
    "stg_customers": "(SELECT cc_num AS customer_id, cc_num, any_value(first || ' ' || last) "
    "AS full_name, any_value(state) AS state FROM batch_raw GROUP BY cc_num)",
    "stg_merchants": "(SELECT merchant AS merchant_id, merchant AS merchant_name, "
    "any_value(category) AS category FROM batch_raw GROUP BY merchant)",
    "int_transaction_stats": "(SELECT trans_num AS trans_id, amt AS amount, is_fraud, "
    f"{age('dob::DATE')} AS customer_age FROM loaded)",
    "fact_transactions": "(SELECT trans_num AS trans_id, amt AS amount, is_fraud, source "
    "FROM loaded)",
    "dim_customer": "(SELECT DISTINCT cc_num AS customer_id FROM batch_raw)",
    "dim_merchant": "(SELECT DISTINCT merchant AS merchant_id FROM batch_raw)",
    "dim_date": "calendar",
    "mart_fraud_summary": "(SELECT trans_at::DATE AS txn_date, count(*) AS total_transactions, "
    "100e0 * sum(is_fraud) / count(*) AS fraud_rate_pct FROM loaded GROUP BY 1, category, state)",
    "mart_customer_360": "(SELECT count(*) AS total_transactions, 'LOW' AS risk_tier "
    "FROM loaded GROUP BY cc_num)",
}

# name -> (needed relations, SQL)
_ORACLES: dict[str, tuple[str, str]] = {
    "txn_enriched": (
        "scored",
        """SELECT trans_num, trans_at, hour(trans_at)::INTEGER AS hour_of_day,
          amt::DOUBLE AS amt, distance_km, risk_score, alert_reason FROM scored""",
    ),
    "txn_enriched_sql": (
        "scored",
        """SELECT trans_num, trans_at, hour(trans_at)::INTEGER AS hour_of_day,
          amt::DOUBLE AS amt, distance_km, risk_score, alert_reason FROM scored""",
    ),
    "txn_risk_score": (
        "scored",
        """SELECT trans_num, amount_band, distance_band, category_band, risk_score
          FROM scored""",
    ),
    "txn_alerts": (
        "scored",
        f"""SELECT trans_num, is_fraud, risk_score, distance_km, alert_reason FROM scored
          WHERE {IS_ALERT}""",
    ),
    "txn_alerts_float32": (
        "narrow",
        """SELECT trans_num, is_fraud, risk_score FROM narrow
          WHERE is_fraud = 1 OR risk_score::FLOAT::DOUBLE >= 0.7e0""",
    ),
    "score_band_matrix": (
        "scored",
        f"""SELECT amount_band, distance_band, category_band, min(risk_score) AS min_score,
          max(risk_score) AS max_score, count(*) AS transactions,
          count(*) FILTER (WHERE {IS_ALERT}) AS alerts FROM scored GROUP BY 1, 2, 3""",
    ),
    "alert_reason_text": (
        "scored",
        "SELECT alert_reason, count(*) AS transactions FROM scored GROUP BY 1",
    ),
    "raw_json_roundtrip": (
        "uniq",
        """SELECT trans_num, trans_date_trans_time, unix_time, amt::DOUBLE AS amt, cc_num,
          merchant, category, merch_lat, merch_long, lat, "long", city_pop, is_fraud, first,
          last, gender, dob, job, street, city, state, zip, produced_at FROM uniq""",
    ),
    "json_parse_rejects": (
        "outcomes",
        "SELECT outcome, count(*) AS events FROM outcomes GROUP BY 1",
    ),
    "txn_first_wins": (
        "uniq",
        """SELECT trans_num, trans_at, unix_time, amt, is_fraud, merchant, source FROM uniq""",
    ),
    "customers_first_wins": (
        "raw",
        f"""SELECT cc_num, first, last, gender, dob, state, city_pop, unix_time, trans_num,
          produced_at, amt, merchant FROM (
          {first_wins("raw", "cc_num", "unix_time, trans_num, produced_at, amt, merchant")})""",
    ),
    "merchants_first_wins": (
        "raw",
        f"""SELECT merchant, category, merch_lat, merch_long, unix_time, trans_num, produced_at,
          amt FROM ({first_wins("raw", "merchant", "unix_time, trans_num, produced_at, amt")})""",
    ),
    "txn_key_resolved": (
        "raw uniq",
        """SELECT trans_num, trans_at, amt, source, cc_num AS customer_id, k.merchant_id
          FROM uniq u JOIN (SELECT DISTINCT merchant, merchant_id FROM raw
            WHERE source = 'batch') k USING (merchant)
          WHERE cc_num IN (SELECT cc_num FROM raw WHERE source = 'batch')""",
    ),
    "txn_unresolved": (
        "raw uniq",
        """SELECT * FROM (SELECT trans_num, cc_num, merchant,
          cc_num NOT IN (SELECT cc_num FROM raw WHERE source = 'batch') AS customer_missing,
          merchant NOT IN (SELECT merchant FROM raw WHERE source = 'batch')
            AS merchant_missing FROM uniq) WHERE customer_missing OR merchant_missing""",
    ),
    "txn_insert_if_absent": (
        "raw",
        """SELECT trans_num, unix_time, produced_at, amt, merchant, ingested_at FROM (
          SELECT *, row_number() OVER (PARTITION BY trans_num
            ORDER BY unix_time, produced_at, amt, merchant) AS rn FROM raw WHERE trans_num
            NOT IN (SELECT trans_num FROM raw WHERE ingested_at < TIMESTAMP '1999-01-01'))
          WHERE rn = 1""",
    ),
    **{
        name: (name, f"SELECT * FROM {name}")
        for name in (
            "stg_transactions",
            "stg_customers",
            "stg_merchants",
            "int_transaction_stats",
            "dim_customer",
            "dim_merchant",
            "dim_date",
            "fact_transactions",
            "mart_fraud_summary",
            "mart_customer_360",
        )
    },
    "star_join": ("fact_transactions dim_customer dim_merchant calendar", STAR),
    "mart_customer_360_resolved": (
        "mart_customer_360",
        "SELECT * FROM mart_customer_360 WHERE customer_id IS NOT NULL",
    ),
    "panel_total_txn": (
        "mart_fraud_summary",
        """SELECT sum(total_transactions)::BIGINT AS total_transactions
          FROM mart_fraud_summary""",
    ),
    "panel_total_fraud": (
        "mart_fraud_summary",
        "SELECT sum(fraud_count)::BIGINT AS fraud_count FROM mart_fraud_summary",
    ),
    "panel_fraud_rate": (
        "mart_fraud_summary",
        f"SELECT {SUMMARY_RATE} AS fraud_rate_pct FROM mart_fraud_summary",
    ),
    "panel_avg_fraud_amount": (
        "mart_fraud_summary",
        """SELECT round(avg(avg_fraud_amount), 2) AS avg_fraud_amount FROM mart_fraud_summary
          WHERE avg_fraud_amount IS NOT NULL""",
    ),
    "panel_avg_fraud_amount_weighted": (
        "txns",
        """SELECT round(sum(amount)::DOUBLE / count(*), 2) AS weighted_fraud_amount FROM txns
          WHERE is_fraud = 1""",
    ),
    "panel_stream_events": (
        "mart_fraud_summary",
        "SELECT sum(stream_count)::BIGINT AS stream_count FROM mart_fraud_summary",
    ),
    "panel_daily_rate": (
        "mart_fraud_summary",
        f"""SELECT txn_date AS time, {SUMMARY_RATE} AS fraud_rate_pct FROM mart_fraud_summary
          GROUP BY 1""",
    ),
    "panel_daily_volume": (
        "mart_fraud_summary",
        """SELECT txn_date AS time, sum(total_transactions)::BIGINT AS total,
          sum(fraud_count)::BIGINT AS fraud FROM mart_fraud_summary GROUP BY 1""",
    ),
    "panel_top_categories": (
        "mart_fraud_summary",
        """SELECT merchant_category, sum(fraud_count)::BIGINT AS fraud_count
          FROM mart_fraud_summary GROUP BY 1
          ORDER BY fraud_count DESC NULLS FIRST, merchant_category ASC NULLS LAST LIMIT 10""",
    ),
    "panel_top_customers": (
        "mart_customer_360",
        """SELECT customer_name, customer_state, customer_job, total_transactions,
          total_fraud_count, fraud_rate_pct, risk_tier, top_category FROM mart_customer_360
          ORDER BY fraud_rate_pct DESC NULLS FIRST, customer_id ASC NULLS LAST LIMIT 10""",
    ),
    "panel_recent_alerts": (
        "alerts",
        """SELECT detected_at, trans_id, risk_score, distance_km, alert_reason FROM alerts
          ORDER BY detected_at DESC NULLS FIRST, trans_id LIMIT 50""",
    ),
    "doc_precision_recall": ("scored", precision_recall_sql("true")),
    "doc_precision_recall_stored": ("scored", precision_recall_sql("source = 'stream'")),
    "doc_fraud_by_state": (
        "mart_fraud_summary",
        f"""SELECT customer_state, sum(total_transactions)::BIGINT AS total_transactions,
          sum(fraud_count)::BIGINT AS fraud_count, {SUMMARY_RATE} AS fraud_rate_pct
          FROM mart_fraud_summary GROUP BY 1""",
    ),
    "doc_tier_distribution": (
        "mart_customer_360",
        "SELECT risk_tier, count(*) AS customers FROM mart_customer_360 GROUP BY 1",
    ),
    "doc_rate_by_age_job": (
        "mart_customer_360",
        f"""SELECT (customer_age // 10 * 10)::INTEGER AS age_group, customer_job,
          sum(total_transactions)::BIGINT AS total_transactions,
          sum(total_fraud_count)::BIGINT AS fraud_count,
          {percentage("sum(total_fraud_count)", "sum(total_transactions)")} AS fraud_rate_pct
          FROM mart_customer_360 GROUP BY 1, 2""",
    ),
    "status_bands": (
        "mart_fraud_summary mart_customer_360 alerts",
        f"""SELECT 'day' AS kind, {band("rate", "0.3e0", "0.6e0")} AS band, count(*) AS n FROM (
            SELECT {SUMMARY_RATE} AS rate FROM mart_fraud_summary GROUP BY txn_date) GROUP BY 2
          UNION ALL SELECT 'customer', {band("fraud_rate_pct", "1", "3")}, count(*)
            FROM mart_customer_360 GROUP BY 2
          UNION ALL SELECT 'alert', {band("risk_score", "0.5", "0.7")}, count(*)
            FROM alerts GROUP BY 2""",
    ),
    "health_alert_count": ("alerts", "SELECT count(*) AS alerts FROM alerts"),
    "health_batch_rows": (
        "txns",
        "SELECT count(*) AS batch_rows FROM txns WHERE source = 'batch'",
    ),
    "health_stream_rows": (
        "txns",
        "SELECT count(*) AS stream_rows FROM txns WHERE source = 'stream'",
    ),
    "health_source_rows": (
        "txns",
        """SELECT count(*) FILTER (WHERE source = 'batch') AS batch_rows,
          count(*) FILTER (WHERE source = 'stream') AS stream_rows FROM txns""",
    ),
    "health_hourly_batch": (
        "txns",
        hourly("txns", "ingested_at", "batch_rows", "source = 'batch'"),
    ),
    "health_hourly_stream": (
        "txns",
        hourly("txns", "ingested_at", "stream_rows", "source = 'stream'"),
    ),
    "health_hourly_alerts": ("alerts", hourly("alerts", "detected_at", "alerts")),
    "health_alert_scores": ("alerts", "SELECT risk_score FROM alerts"),
    "health_score_histogram": (
        "alerts",
        """SELECT least(floor(risk_score * 10), 9)::INTEGER AS bucket, count(*) AS alerts
          FROM alerts GROUP BY 1""",
    ),
    "health_status": (
        "txns alerts custs merchs",
        """SELECT 'OLTP transactions' AS component, count(*) AS count,
            max(ingested_at) AS last_updated FROM txns
          UNION ALL SELECT 'Fraud alerts', count(*), max(detected_at) FROM alerts
          UNION ALL SELECT 'Unique customers', count(*), max(created_at) FROM custs
          UNION ALL SELECT 'Unique merchants', count(*), max(created_at) FROM merchs""",
    ),
    "batch_and_stream_union": (
        "txns",
        """SELECT source, count(*) AS rows, count(customer_id) AS with_customer,
          sum(amount)::DECIMAL(22,2) AS amount FROM txns GROUP BY 1""",
    ),
    "dq_report": (ALL_MODELS, check_sql(ALL_CHECKS, {})),
    "dq_report_unclean": (
        "raw stg_customers stg_merchants",
        check_sql(
            STAGING_CHECKS,
            {
                "stg_transactions": "(SELECT trans_num AS trans_id, amt * 100 AS amount, "
                "is_fraud, source, trans_at FROM raw)"
            },
        ),
    ),
    "dq_orphans": (
        "txns alerts merchs",
        """SELECT 'transactions.customer_id' AS constraint_name, trans_id FROM txns
            WHERE customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)
          UNION ALL SELECT 'transactions.merchant_id', trans_id FROM txns
            WHERE merchant_id NOT IN (SELECT merchant_id FROM merchs)
          UNION ALL SELECT 'fraud_alerts.trans_id', trans_id FROM alerts
            WHERE trans_id NOT IN (SELECT trans_id FROM txns WHERE amount <= 1000)""",
    ),
    "dq_constraint_rejects": (
        "",
        """SELECT CASE WHEN l_shipdate < o_orderdate THEN 'trans_at is null'
            WHEN l_returnflag NOT IN ('R', 'N') THEN 'is_fraud not in (0, 1)'
            WHEN o_orderstatus NOT IN ('O', 'F') THEN 'source not in (batch, stream)'
            ELSE 'accepted' END AS outcome, count(*) AS rows
          FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1""",
    ),
    "event_rate_15s": ("", WINDOWS),
    "stream_event_rate_state": ("", WINDOWS),
    "event_rate_lag": (
        "log",
        """SELECT topic, make_timestamp(tick) AS sampled_at,
            (total - lag(total, 1, begun) OVER w)::BIGINT AS messages,
            coalesce((total - lag(total) OVER w) * 1000000e0 / (tick - lag(tick) OVER w), 0e0)
              AS events_per_second
          FROM (SELECT topic, tick, sum(coalesce(reached, begin_offset)) AS total,
              sum(begin_offset) AS begun
            FROM (SELECT t.topic, t.tick, p.begin_offset, max(s.end_offset) OVER (
                PARTITION BY t.topic, p.partition ORDER BY t.tick) AS reached
              FROM (SELECT DISTINCT topic, (epoch_us(ts) // 15000000 + 1) * 15000000 AS tick
                FROM log) t
              JOIN (SELECT topic, partition, min("offset") AS begin_offset FROM log
                GROUP BY 1, 2) p ON t.topic = p.topic
              LEFT JOIN (SELECT topic, partition, (epoch_us(ts) // 15000000 + 1) * 15000000
                  AS tick, max("offset") + 1 AS end_offset FROM log GROUP BY 1, 2, 3) s
                ON s.topic = t.topic AND s.tick = t.tick AND s.partition = p.partition)
            GROUP BY 1, 2)
          WINDOW w AS (PARTITION BY topic ORDER BY tick)""",
    ),
    "topic_offsets": (
        "log",
        """SELECT topic, partition, min("offset") AS begin_offset,
          max("offset") + 1 AS end_offset FROM log GROUP BY 1, 2""",
    ),
    "dlq_depth": ("depth", "SELECT * FROM depth WHERE topic = 'dlq_transactions'"),
    "dlq_action": (
        "depth",
        """SELECT topic, depth, CASE WHEN depth > 0 THEN 'alert_team' ELSE 'no_action' END
          AS action, CASE WHEN depth >= 1 THEN 'red' ELSE 'green' END AS band FROM depth""",
    ),
    "dlq_peek": (
        "log",
        """SELECT partition, "offset", value FROM log WHERE topic = 'dlq_transactions'
          ORDER BY "offset" LIMIT 20""",
    ),
    "stream_alerts": (
        "stream_scored",
        f"""SELECT trans_num AS trans_id, risk_score::DECIMAL(5,4) AS risk_score,
          distance_km::DECIMAL(10,2) AS distance_km, alert_reason FROM stream_scored
          WHERE {IS_ALERT}""",
    ),
    "stream_transactions": (
        "stream_scored",
        """SELECT trans_num AS trans_id, trans_at, unix_time, amt AS amount, is_fraud, source
          FROM stream_scored""",
    ),
    "stream_staging": (
        "stream_raw",
        """SELECT trans_num AS trans_id, cc_num, merchant AS merchant_name, category, trans_at,
          unix_time, amt::DOUBLE AS amount, is_fraud, lat, "long", merch_lat, merch_long,
          city_pop, first, last, gender, dob, job, street, city, state, zip, source
          FROM stream_raw""",
    ),
    "stream_replay": (
        "stream_scored",
        f"""SELECT 'stream_staging' AS table_name, 'replayed-' || epoch AS batch_id,
            count(*) AS rows FROM stream_raw, (VALUES (0), (1)) AS e(epoch) GROUP BY 2
          UNION ALL SELECT 'transactions', 'replayed-0', count(*) FROM stream_scored
          UNION ALL SELECT 'fraud_alerts', 'replayed-0', count(*) FROM stream_scored
            WHERE {IS_ALERT}""",
    ),
    "stream_dlq": (
        "raw",
        """SELECT reason, count(*) AS letters, count(*) AS with_reason_in_value FROM (
            SELECT CASE hour(trans_at) WHEN 12 THEN 'malformed json'
              WHEN 7 THEN 'trans_num is null' WHEN 8 THEN 'trans_at is null'
              WHEN 9 THEN 'amount is null' WHEN 10 THEN 'coordinates are null'
              WHEN 11 THEN 'is_fraud not in (0, 1)' END AS reason FROM raw)
          WHERE reason IS NOT NULL GROUP BY 1""",
    ),
    "stream_dedup": ("stream_raw", "SELECT DISTINCT trans_num FROM stream_raw"),
    "stream_event_rate": (
        "",
        WINDOWS,
    ),
    "stream_compacted": (
        "stream_raw stream_scored",
        f"""SELECT 'stream_staging' AS table_name, 'closed-' || cc_num % 3 AS batch_id,
            count(*) AS rows FROM stream_raw GROUP BY 2
          UNION ALL SELECT 'transactions', 'closed-' || cc_num % 3, count(*)
            FROM stream_scored GROUP BY 2
          UNION ALL SELECT 'fraud_alerts', 'closed-' || cc_num % 3, count(*)
            FROM stream_scored WHERE {IS_ALERT} GROUP BY 2
          UNION ALL SELECT 'stored again', 'closed-3', 0""",
    ),
    "epoch_counters": (
        "stream_scored",
        f"""SELECT 'rows' AS counter, count(*) AS value FROM stream_scored
          UNION ALL SELECT 'alerts', count(*) FROM stream_scored WHERE {IS_ALERT}""",
    ),
    "topic_messages": (
        "stream_scored",
        f"""SELECT topic, trans_num AS key, trans_num, alert_reason FROM stream_scored,
            (VALUES ('enriched_transactions'), ('fraud_alerts')) AS t(topic)
          WHERE topic = 'enriched_transactions' OR {IS_ALERT}""",
    ),
    "dlq_pipeline": (
        "raw",
        """SELECT 'dlq_transactions' AS topic, count(*) AS depth, 'alert_team' AS action,
          'red' AS band FROM raw WHERE hour(trans_at) BETWEEN 7 AND 12""",
    ),
    "replay_order": (
        "raw",
        """SELECT 'messages' AS measure, count(*) AS value FROM raw
          UNION ALL SELECT 'falls', 0 UNION ALL SELECT 'overlaps', 0""",
    ),
    "message_keys": (
        "uniq",
        """SELECT count(*) AS messages, count(*) FILTER (WHERE hour(trans_at) <> 7) AS by_number,
          count(*) FILTER (WHERE hour(trans_at) = 7) AS by_hash, 0::BIGINT AS without_key,
          count(DISTINCT trans_num) AS keys FROM uniq""",
    ),
    "payload_defaults": (
        "uniq",
        """SELECT CASE hour(trans_at) WHEN 3 THEN 'amount is null'
            WHEN 4 THEN 'coordinates are null' ELSE 'accepted' END AS outcome,
          count(*) AS rows, 0::BIGINT AS city_pop FROM uniq GROUP BY 1""",
    ),
    "consumer_progress": (
        "",
        """SELECT event_id % 4 AS batch_id, count(*) AS input_rows,
            (sum(count(*)) OVER (ORDER BY event_id % 4))::BIGINT AS received,
            (sum(count(*)) OVER ())::BIGINT AS available, available - received AS lag
          FROM events GROUP BY event_id % 4""",
    ),
    "panel_from_store": (
        "mart_fraud_summary mart_customer_360",
        f"""SELECT unnest(['total_transactions', 'total_fraud', 'fraud_rate',
            'average_fraud_amount', 'stream_events', 'customers']) AS panel,
          unnest([sum(total_transactions)::DOUBLE, sum(fraud_count)::DOUBLE, {SUMMARY_RATE},
            round(avg(avg_fraud_amount), 2), sum(stream_count)::DOUBLE,
            (SELECT count(customer_id) FROM mart_customer_360)::DOUBLE]) AS value
          FROM mart_fraud_summary""",
    ),
    "load_unresolved": (
        "batch_raw",
        """SELECT unnest(['customers_attempted', 'customers_inserted', 'merchants_attempted',
            'merchants_inserted', 'transactions_attempted', 'transactions_inserted',
            'transactions_unresolved', 'rows_rejected']) AS counter,
          unnest([count(*) FILTER (WHERE cc_num % 11 <> 0),
            count(DISTINCT cc_num) FILTER (WHERE cc_num % 11 <> 0), count(*),
            count(DISTINCT merchant), count(*) FILTER (WHERE cc_num % 11 <> 0),
            count(DISTINCT trans_num) FILTER (WHERE cc_num % 11 <> 0),
            count(*) FILTER (WHERE cc_num % 11 = 0),
            count(*) FILTER (WHERE cc_num % 11 = 0)]) AS value FROM batch_raw""",
    ),
    "load_counters": (
        "batch_raw",
        """SELECT unnest(['customers_attempted', 'customers_inserted', 'merchants_attempted',
            'merchants_inserted', 'transactions_attempted', 'transactions_inserted',
            'transactions_unresolved', 'rows_rejected']) AS counter,
          unnest([count(*), count(DISTINCT cc_num), count(*), count(DISTINCT merchant),
            count(*), count(DISTINCT trans_num), 0, 0]) AS value FROM batch_raw""",
    ),
    "batch_load_transactions": (
        "loaded",
        """SELECT trans_num AS trans_id, cc_num, trans_at, amt AS amount, is_fraud, source
          FROM loaded""",
    ),
    "warehouse_refresh": ("loaded calendar", check_sql(ALL_CHECKS, LOADED_MODELS)),
    "warehouse_refresh_selected": (
        "loaded calendar",
        check_sql(
            [c for c in ALL_CHECKS if c[0].startswith("stg_") or c[0] in ("int_transaction_stats", "mart_fraud_summary")],
            LOADED_MODELS,
        ),
    ),
    "int_transaction_stats_bucketed": ("int_transaction_stats", "SELECT * FROM int_transaction_stats"),
    "mart_fraud_summary_by_load": ("mart_fraud_summary", "SELECT * FROM mart_fraud_summary"),
    "mart_customer_360_by_load": ("mart_customer_360", "SELECT * FROM mart_customer_360"),
}


def oracle_sql() -> dict[str, str]:
    return {name: build(*parts) for name, parts in _ORACLES.items()}
