"""The registered queries again, as DuckDB SQL over the same tables.

``BASE`` derives payments, scores, stored tables, messages and labelled rows; each query adds
its own SELECT. Numbers written with an exponent are doubles, as they must be for equal bits.
"""

from __future__ import annotations

SIGNALS = [f"V{i}" for i in range(1, 29)]
# Decimals are compared as doubles.
AMOUNT = "CAST(amount AS DOUBLE) AS amount"
PROBABILITY = "CAST(ml_probability AS DOUBLE) AS ml_probability"
TX_COLUMNS = (
    f"transaction_id, user_id, {AMOUNT}, currency, country, usual_country, merchant_category, payment_method, "
    f"device_id, ip_address, transaction_timestamp, transaction_status, risk_score, {PROBABILITY}, "
    "behavior_score, final_score, detection_method, actual_label, processed_at"
)
DETAILS = (
    f"transaction_id, user_id, {AMOUNT}, currency, country, usual_country, merchant_category, payment_method, "
    f"risk_score, {PROBABILITY}, behavior_score, final_score, transaction_status, actual_label, "
    "detection_method, transaction_timestamp, processed_at"
)
ALERT_COLUMNS = "alert_id, transaction_id, user_id, risk_score, alert_type, message, status, created_at"
STAMP = "TIMESTAMP '2024-02-01 00:00:00'"
ALERTING = "transaction_status IN ('SUSPICIOUS', 'FRAUD')"

_RULES = """
    CASE WHEN amount > 10000 THEN 40 WHEN amount > 5000 THEN 30 ELSE 0 END AS amount_score,
    CASE WHEN country <> usual_country THEN 20 ELSE 0 END AS country_score,
    CASE WHEN merchant_category IN ('Crypto', 'Luxury', 'Gaming', 'Gambling') THEN 15 ELSE 0 END AS merchant_score,
    CASE WHEN hour(event_time) BETWEEN 0 AND 5 THEN 10 ELSE 0 END AS time_score,
    CASE WHEN device_id LIKE '%D-8%' OR device_id LIKE '%D-9%' THEN 15 ELSE 0 END AS device_score,
    0 AS frequency_score,
    CASE WHEN amount_vs_avg_user >= 10 THEN 30 WHEN amount_vs_avg_user >= 5 THEN 20
         WHEN amount_vs_avg_user >= 3 THEN 10 ELSE 0 END AS behavior_score"""


def _decided(source: str) -> str:
    """Scores and status over ``source``, which has the rule inputs and ``ml_probability``."""
    return f"""
  SELECT *, CASE WHEN final_score >= 60 OR (rule_score >= 50 AND ml_probability >= 1e-1) THEN 'FRAUD'
                 WHEN final_score >= 35 OR ml_probability >= 8e-2 OR rule_score >= 40 THEN 'SUSPICIOUS'
                 ELSE 'NORMAL' END AS transaction_status
  FROM (SELECT *, CAST(round(rule_score * 35e-2 + ml_score * 45e-2 + behavior_score * 20e-2) AS INTEGER) AS final_score
        FROM (SELECT *, amount_score + country_score + merchant_score + time_score + device_score
                        + frequency_score AS rule_score, ml_probability * 100 AS ml_score
              FROM (SELECT *, {_RULES} FROM {source})))"""


def _stored(source: str, extra: str = "") -> str:
    return f"""
  SELECT {extra} transaction_id, user_id, CAST(amount AS DECIMAL(12,2)) AS amount, currency, country, usual_country,
         merchant_category, payment_method, device_id, ip_address, event_time AS transaction_timestamp,
         transaction_status, final_score AS risk_score, CAST(ml_probability AS DECIMAL(6,4)) AS ml_probability,
         behavior_score, final_score, 'HYBRID_RULES_ML_BEHAVIOR' AS detection_method,
         TRY_CAST(actual_label AS INTEGER) AS actual_label, processed_at
  FROM {source}"""


def _alerts(source: str, where: str = ALERTING) -> str:
    return f"""
  SELECT md5(transaction_id || '|HYBRID_FRAUD_DETECTION') AS alert_id, transaction_id, user_id,
         final_score AS risk_score, 'HYBRID_FRAUD_DETECTION' AS alert_type,
         'Transaction ' || transaction_id || ' detected as ' || transaction_status || ' | final_score=' || final_score
           || ' | ml_probability=' || CAST(ml_probability AS DECIMAL(6,4)) AS message,
         'OPEN' AS status, processed_at AS created_at
  FROM {source} WHERE {where}"""


def _risk_rows(source: str) -> str:
    return f"""
  SELECT md5(transaction_id) AS id, transaction_id, amount_score, country_score, merchant_score, time_score,
         device_score, frequency_score, final_score, transaction_status AS decision, processed_at AS created_at
  FROM {source}"""


_SIGNAL_LIST = ",\n    ".join(
    f"CAST(embedding[{i}] AS DOUBLE)" + (" + CASE WHEN vec_id % 10 = 0 THEN 3e-1 ELSE 0e0 END" if i <= 2 else "") + f' AS "V{i}"'
    for i in range(1, 29)
)

_SIGNAL_COLUMNS = ", ".join(f'"{c}"' for c in ["Time", *SIGNALS])
_MESSAGE_SIGNALS = ", ".join(
    f'CASE WHEN n % 50 IN (1, 9) OR n % 5 = 0 THEN NULL ELSE "{c}" END AS "{c}"' for c in ["Time", *SIGNALS]
)

BASE = f"""WITH
spend AS (
  SELECT user_id, CAST(SUM(CAST(value AS DECIMAL(12,2))) AS DOUBLE) AS spent, COUNT(*) AS key_rows
  FROM events GROUP BY user_id),
profile AS (
  SELECT user_id, here.n_name AS usual_country, abroad.n_name AS next_country, spent / key_rows AS user_avg_amount
  FROM spend JOIN customer ON c_custkey = user_id
  JOIN nation here ON here.n_nationkey = c_nationkey
  JOIN nation abroad ON abroad.n_nationkey = (c_nationkey + 1) % 25),
payments AS (
  SELECT *, amount / greatest(user_avg_amount, 1e0) AS amount_vs_avg_user, (p0*p0)*(p0*p0)*((p0*p0)*(p0*p0)) AS ml_probability
  FROM (SELECT event_id AS n, 'TX-' || event_id AS transaction_id, 'U' || user_id AS user_id,
    CASE WHEN event_id % 13 = 0 THEN value * 60e0 ELSE value END AS amount, 'EUR' AS currency,
    CASE WHEN event_id % 11 = 0 THEN next_country ELSE usual_country END AS country, usual_country,
    ['Crypto','Luxury','Grocery','Restaurant','Electronics','Transport','Pharmacy'][event_id % 7 + 1] AS merchant_category,
    ['Credit Card','Debit Card','Mobile Wallet','Bank Transfer'][event_id % 4 + 1] AS payment_method,
    'D-' || (100 + (event_id * 37) % 900) AS device_id, '192.168.1.' || (1 + event_id % 255) AS ip_address,
    ts AS event_time, user_avg_amount, CASE WHEN event_type = 'error' THEN 1e0 ELSE 0e0 END AS actual_label,
    CAST((event_id * 7919) % 1000 AS DOUBLE) / 1e3 AS p0
    FROM events JOIN profile USING (user_id))),
scored AS (SELECT *, event_time AS processed_at FROM ({_decided("payments")})),
tx AS ({_stored("scored")}),
alerts AS ({_alerts("scored")}),
damaged AS (
  SELECT CASE WHEN n % 211 = 0 THEN NULL ELSE transaction_id END AS transaction_id,
    CASE WHEN n % 97 = 0 THEN NULL ELSE user_id END AS user_id,
    CASE WHEN n % 89 = 0 THEN -1 WHEN n % 179 = 0 THEN NULL ELSE amount END AS amount,
    currency, country, usual_country, merchant_category, payment_method, device_id, ip_address,
    CASE WHEN n % 71 = 0 THEN NULL ELSE transaction_timestamp END AS transaction_timestamp,
    CASE WHEN n % 83 = 0 THEN 'UNKNOWN' ELSE transaction_status END AS transaction_status,
    CASE WHEN n % 79 = 0 THEN NULL WHEN n % 73 = 0 THEN 101 ELSE risk_score END AS risk_score,
    CASE WHEN n % 67 = 0 THEN NULL WHEN n % 61 = 0 THEN 1.5 ELSE ml_probability END AS ml_probability,
    CASE WHEN n % 59 = 0 THEN NULL WHEN n % 53 = 0 THEN 101 ELSE behavior_score END AS behavior_score,
    CASE WHEN n % 47 = 0 THEN NULL WHEN n % 43 = 0 THEN 101 ELSE final_score END AS final_score,
    CASE WHEN n % 41 = 0 THEN NULL ELSE detection_method END AS detection_method,
    CASE WHEN n % 37 = 0 THEN 2 WHEN n % 10 = 1 THEN NULL ELSE actual_label END AS actual_label, processed_at
  FROM ({_stored("scored", "n,")}), LATERAL (SELECT unnest(CASE WHEN n % 101 = 0 THEN [0, 1] ELSE [0] END))),
lossy AS ({_alerts("scored", ALERTING + " AND n % 10 <> 0")}
  UNION ALL {_alerts("(SELECT * REPLACE ('TX-X' || n AS transaction_id, 'FRAUD' AS transaction_status) FROM scored WHERE n % 500 = 0)", "true")}),
labelled AS (
  SELECT CAST(vec_id AS DOUBLE) AS "Time", {_SIGNAL_LIST},
    abs(CAST(embedding[29] AS DOUBLE)) * 1000 AS "Amount", CAST(vec_id % 10 = 0 AS INTEGER) AS "Class", vec_id
  FROM embeddings),
signals AS (SELECT vec_id AS signal_of, {_SIGNAL_COLUMNS} FROM labelled),
messages AS (
  SELECT n,
    CASE WHEN n % 50 IN (1, 2, 9) THEN NULL ELSE transaction_id END AS transaction_id,
    CASE WHEN n % 50 IN (1, 3, 9) THEN NULL ELSE user_id END AS user_id,
    CASE WHEN n % 50 IN (1, 4, 9) THEN NULL ELSE amount END AS amount,
    CASE WHEN n % 50 IN (1, 9) THEN NULL ELSE currency END AS currency,
    CASE WHEN n % 50 IN (1, 8, 9) THEN NULL ELSE country END AS country,
    CASE WHEN n % 50 IN (1, 9) THEN NULL ELSE usual_country END AS usual_country,
    CASE WHEN n % 50 IN (1, 9) THEN NULL ELSE merchant_category END AS merchant_category,
    CASE WHEN n % 50 IN (1, 9) THEN NULL ELSE payment_method END AS payment_method,
    CASE WHEN n % 50 IN (1, 9) THEN NULL ELSE device_id END AS device_id,
    CASE WHEN n % 50 IN (1, 9) THEN NULL ELSE ip_address END AS ip_address,
    CASE WHEN n % 50 IN (1, 9) THEN NULL WHEN n % 50 = 6 THEN '2024-01-01T00:00:00'
         ELSE strftime(event_time, '%Y-%m-%d %H:%M:%S') END AS "timestamp",
    CASE WHEN n % 50 IN (1, 6, 9) THEN NULL ELSE date_trunc('second', event_time) END AS event_time,
    CASE WHEN n % 50 IN (1, 9) OR n % 5 = 0 THEN NULL ELSE user_avg_amount END AS user_avg_amount,
    CASE WHEN n % 50 IN (1, 9) OR n % 5 = 0 THEN NULL ELSE amount_vs_avg_user END AS amount_vs_avg_user,
    CASE WHEN n % 50 IN (1, 9) OR n % 5 = 0 THEN NULL WHEN n % 50 = 11 THEN 1e12 ELSE actual_label END AS actual_label,
    {_MESSAGE_SIGNALS},
    ml_probability
  FROM payments LEFT JOIN signals ON signal_of = n),
accepted AS (
  SELECT * REPLACE (coalesce(user_avg_amount, 200e0) AS user_avg_amount,
                    coalesce(amount_vs_avg_user, amount / 200e0) AS amount_vs_avg_user)
  FROM messages
  WHERE transaction_id IS NOT NULL AND user_id IS NOT NULL AND amount IS NOT NULL AND event_time IS NOT NULL),
streamed AS (SELECT *, {STAMP} AS processed_at FROM ({_decided("accepted")}))
"""


def _mean(name: str) -> str:
    return f"coalesce(CAST(SUM({name}) AS DOUBLE) / nullif(COUNT({name}), 0), 0e0) AS avg_{name}"


def _peak(name: str) -> str:
    top = f"coalesce(max({name}), 0)"
    return f"CAST({top} AS {'DOUBLE' if name == 'ml_probability' else 'INTEGER'}) AS max_{name}"


def _n_status(*statuses: str) -> str:
    return ", ".join(f"COUNT(*) FILTER (WHERE transaction_status = '{s}') AS total_{s.lower()}" for s in statuses)


def _fraud_money(alias: str) -> str:
    return (
        f"CAST(coalesce(SUM(CASE WHEN transaction_status = 'FRAUD' THEN amount END), 0) AS DOUBLE) AS {alias}"
    )


_KPI = ", ".join(
    [
        "COUNT(*) AS total_transactions",
        _n_status("NORMAL", "SUSPICIOUS", "FRAUD"),
        _fraud_money("total_fraud_amount"),
        _mean("ml_probability"),
        _mean("behavior_score"),
        _mean("final_score"),
    ]
)

_CONFUSION = """
  SELECT COUNT(*) FILTER (WHERE actual_label = 1 AND hit) AS true_positives, COUNT(*) FILTER (WHERE actual_label = 0 AND hit) AS false_positives,
         COUNT(*) FILTER (WHERE actual_label = 0 AND pass) AS true_negatives, COUNT(*) FILTER (WHERE actual_label = 1 AND pass) AS false_negatives
  FROM (SELECT actual_label, transaction_status IN ('SUSPICIOUS', 'FRAUD') AS hit, transaction_status = 'NORMAL' AS pass FROM tx)"""

_FAULTS = {
    "missing_transaction_id": "transaction_id IS NULL",
    "missing_user_id": "user_id IS NULL",
    "invalid_amount": "amount IS NULL OR amount < 0",
    "invalid_transaction_status": "coalesce(transaction_status, '') NOT IN ('NORMAL', 'SUSPICIOUS', 'FRAUD')",
    "missing_risk_score": "risk_score IS NULL",
    "invalid_risk_score": "NOT (risk_score BETWEEN 0 AND 100)",
    "missing_transaction_timestamp": "transaction_timestamp IS NULL",
    "missing_ml_probability": "detection_method IS NOT NULL AND ml_probability IS NULL",
    "invalid_ml_probability": "NOT (ml_probability BETWEEN 0 AND 1)",
    "missing_behavior_score": "detection_method IS NOT NULL AND behavior_score IS NULL",
    "invalid_behavior_score": "NOT (behavior_score BETWEEN 0 AND 100)",
    "missing_final_score": "detection_method IS NOT NULL AND final_score IS NULL",
    "invalid_final_score": "NOT (final_score BETWEEN 0 AND 100)",
    "missing_detection_method": "detection_method IS NULL",
    "invalid_actual_label": "actual_label NOT BETWEEN 0 AND 1",
}
_KEYED = {
    "duplicated_transaction_id": (
        "SELECT COUNT(*) AS issue_count FROM (SELECT count(*) AS c FROM damaged GROUP BY transaction_id) WHERE c > 1"
    ),
    "fraud_alert_without_transaction": (
        "SELECT COUNT(*) AS issue_count FROM lossy l "
        "WHERE NOT EXISTS (SELECT 1 FROM damaged d WHERE d.transaction_id = l.transaction_id)"
    ),
    "fraud_transaction_without_alert": (
        f"SELECT COUNT(*) AS issue_count FROM damaged d WHERE {ALERTING} "
        "AND NOT EXISTS (SELECT 1 FROM lossy l WHERE l.transaction_id = d.transaction_id)"
    ),
}
# fixed values: the checks in report order
CHECK_ORDER = (
    "missing_transaction_id",
    "missing_user_id",
    "invalid_amount",
    "invalid_transaction_status",
    "missing_risk_score",
    "invalid_risk_score",
    "missing_transaction_timestamp",
    "duplicated_transaction_id",
    "missing_ml_probability",
    "invalid_ml_probability",
    "missing_behavior_score",
    "invalid_behavior_score",
    "missing_final_score",
    "invalid_final_score",
    "missing_detection_method",
    "invalid_actual_label",
    "fraud_alert_without_transaction",
    "fraud_transaction_without_alert",
)


def _check(name: str) -> str:
    return _KEYED.get(name) or f"SELECT COUNT(*) FILTER (WHERE {_FAULTS[name]}) AS issue_count FROM damaged"


_REPORT = " UNION ALL ".join(f"SELECT '{name}' AS check_name, issue_count FROM ({_check(name)})" for name in CHECK_ORDER)



def _auc(table: str, score: str, label: str) -> str:
    """Ranks of all rows, ties averaged; twice the sum of those of the positives, less that of the positives among themselves."""
    return f"""
      WITH r AS (
        SELECT {label} AS y, {score} AS s FROM {table} WHERE {score} IS NOT NULL AND {label} IN (0, 1)),
      ranked AS (
        SELECT y, 2 * rank() OVER (ORDER BY s) + COUNT(*) OVER (PARTITION BY s) - 1 AS twice_rank FROM r),
      sums AS (
        SELECT CAST(SUM(twice_rank) FILTER (WHERE y = 1) AS DOUBLE) AS ranks,
               CAST(COUNT(*) FILTER (WHERE y = 1) AS DOUBLE) AS p, CAST(COUNT(*) FILTER (WHERE y = 0) AS DOUBLE) AS n
        FROM ranked)
      SELECT (ranks - p * (p + 1)) / (p * n * 2) AS auc, CAST(p AS BIGINT) AS positives, CAST(n AS BIGINT) AS negatives FROM sums"""


def _f1(table: str, label: str, prediction: str) -> str:
    return f"""
      WITH r AS (
        SELECT CAST({label} AS DOUBLE) AS y, CAST({prediction} AS DOUBLE) AS p FROM {table}
        WHERE {label} IS NOT NULL AND {prediction} IS NOT NULL),
      classes AS (
        SELECT c.y, (SELECT COUNT(*) FROM r WHERE r.y = c.y) AS own, (SELECT COUNT(*) FROM r WHERE r.p = c.y) AS claimed,
               (SELECT COUNT(*) FROM r WHERE r.y = c.y AND r.p = c.y) AS hits
        FROM (SELECT DISTINCT y FROM r) c)
      SELECT round(SUM(own * 2 * hits / CAST(own + claimed AS DOUBLE)) / SUM(own), 12) AS f1, CAST(SUM(own) AS BIGINT) AS rows FROM classes"""


_LONELY = f"""
  SELECT {ALERT_COLUMNS} FROM lossy l
  WHERE NOT EXISTS (SELECT 1 FROM damaged d WHERE d.transaction_id = l.transaction_id)"""

_RATED = f"""
  WITH known AS (SELECT * FROM damaged WHERE user_id IS NOT NULL),
  common AS (
    SELECT user_id, country FROM known WHERE country IS NOT NULL GROUP BY user_id, country
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY COUNT(*) DESC, country) = 1),
  sums AS (
    SELECT user_id, COUNT(*) AS n, COUNT(*) FILTER (WHERE transaction_status = 'FRAUD') AS frauds,
           COUNT(*) FILTER (WHERE {ALERTING}) AS alerts, CAST(SUM(amount) AS DOUBLE) / COUNT(amount) AS avg_amount
    FROM known GROUP BY user_id)
  SELECT user_id, country AS usual_country, avg_amount,
         CASE WHEN frauds >= 5e-2 * n THEN 'HIGH' WHEN alerts >= 1e0 / 3 * n THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM sums LEFT JOIN common USING (user_id)"""

_MISSING = f"""
  SELECT transaction_id, user_id, {AMOUNT}, currency, country, usual_country, merchant_category, payment_method,
         risk_score, transaction_status, transaction_timestamp, processed_at
  FROM tx WHERE {ALERTING} AND NOT EXISTS (SELECT 1 FROM lossy l WHERE l.transaction_id = tx.transaction_id)"""

_REPAIR_ROWS = f"""
  SELECT md5(transaction_id || '|REAL_TIME_FRAUD_DETECTION') AS alert_id, transaction_id, user_id, risk_score,
         'REAL_TIME_FRAUD_DETECTION' AS alert_type,
         'Transaction ' || transaction_id || ' detected as ' || transaction_status || ' with risk score ' || risk_score
           AS message,
         'OPEN' AS status, {STAMP} AS created_at
  FROM ({_MISSING})"""


def _bucket(key: str) -> str:
    return f"CAST('0x' || substr(md5('42|' || {key}), 1, 8) AS BIGINT)"


def _histogram(value: str, column: str, width: str) -> str:
    return (
        f"SELECT bin, bin * {width} AS bin_start, COUNT(*) AS count FROM (SELECT greatest(0, least(19, "
        f"CAST(floor({value}) AS INTEGER))) AS bin FROM tx WHERE {column} IS NOT NULL) GROUP BY bin"
    )


def _counts(tx: str, risk: str, alerts: str) -> str:
    return (
        f"SELECT 'transactions' AS table_name, COUNT(*) AS row_count FROM {tx} "
        f"UNION ALL SELECT 'risk_scores', COUNT(*) FROM {risk} UNION ALL SELECT 'fraud_alerts', COUNT(*) FROM {alerts}"
    )


_STREAMED_ALERTS = f"(SELECT * FROM streamed WHERE {ALERTING})"
_LABELLED_COLUMNS = ", ".join(f'"{c}"' for c in ["Time", *SIGNALS, "Amount", "Class"])
_GAPS = """(SELECT * REPLACE (
      CASE WHEN vec_id % 7 = 0 THEN NULL WHEN vec_id % 11 = 0 THEN 'NaN'::DOUBLE ELSE "V3" END AS "V3",
      CASE WHEN vec_id % 13 = 0 THEN NULL ELSE "Class" END AS "Class") FROM labelled)"""

_PARSED = f"""
  SELECT transaction_id, user_id, amount, currency, country, usual_country, merchant_category, payment_method, device_id,
         ip_address, "timestamp", user_avg_amount, amount_vs_avg_user, actual_label, {_SIGNAL_COLUMNS}
  FROM messages"""

SELECTS: dict[str, str] = {
    # sources
    "s01_message_stream": "SELECT COUNT(*) AS message_count FROM events",
    "s02_labelled_csv": f"SELECT {_LABELLED_COLUMNS} FROM labelled",
    "s03_replay_source": """SELECT CASE "Class" WHEN 1 THEN 'fraud' ELSE 'normal' END AS part, "Time", "Amount" FROM labelled""",
    "s04_transactions_scan": f"SELECT {TX_COLUMNS} FROM tx",
    "s05_alerts_scan": f"SELECT {ALERT_COLUMNS} FROM alerts",
    # sinks
    "k01_fan_out": _counts("streamed", "streamed", _STREAMED_ALERTS),
    "k02_empty_batch": "SELECT 'direct-0' AS run_id, COUNT(*) AS row_count FROM streamed",
    "k03_append_transactions": f"SELECT {TX_COLUMNS} FROM tx",
    "k03_two_streams": f"SELECT {TX_COLUMNS} FROM ({_stored('streamed')})",
    "k03_replayed_run": f"SELECT {TX_COLUMNS} FROM tx",
    "k04_append_risk_scores": _risk_rows("scored"),
    "k05_append_alerts": f"SELECT {ALERT_COLUMNS} FROM alerts",
    "k06_append_repairs": f"SELECT {ALERT_COLUMNS} FROM lossy UNION ALL {_REPAIR_ROWS}",
    "k07_daily_csv": f"""
      SELECT 'fraud_summary' AS report, 1 AS row_count
      UNION ALL SELECT 'fraud_status_distribution', COUNT(DISTINCT transaction_status) FROM tx
      UNION ALL SELECT 'fraud_details', COUNT(*) FILTER (WHERE {ALERTING}) FROM tx
      UNION ALL SELECT 'fraud_top_countries', least(20, COUNT(DISTINCT country)) FROM tx WHERE {ALERTING}""",
    "k08_quality_csv": f"""
      SELECT check_name, CASE WHEN issue_count = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, issue_count
      FROM ({_REPORT})""",
    "k09_evaluation_csv": """
      SELECT 'model_evaluation_metrics' AS report, 1 AS row_count
      UNION ALL SELECT 'model_evaluation_distribution', COUNT(*)
        FROM (SELECT DISTINCT actual_label, transaction_status FROM tx WHERE actual_label IS NOT NULL)
      UNION ALL SELECT 'model_top_predictions', least(100, COUNT(*)) FROM tx WHERE actual_label IS NOT NULL""",
    "k10_repair_csv": f"""
      SELECT transaction_id, risk_score, 'REPAIRED' AS repair_status, COUNT(*) OVER () AS repaired_count_total
      FROM ({_MISSING})""",
    "k13_publish_messages": f"""
      SELECT transaction_id, user_id, amount, currency, country, usual_country, merchant_category, payment_method,
             device_id, ip_address, user_avg_amount, amount_vs_avg_user, actual_label, {_SIGNAL_COLUMNS},
             strftime(event_time, '%Y-%m-%d %H:%M:%S') AS "timestamp", transaction_id AS message_key
      FROM payments LEFT JOIN signals ON signal_of = n""",
    # parsing and cleaning
    "p01_message_text": "SELECT device_id FROM messages",
    "p02_json_to_struct": _PARSED,
    "p03_flatten_event": _PARSED,
    "p04_event_time": 'SELECT transaction_id, "timestamp", event_time FROM messages',
    "p05_default_average": "SELECT transaction_id, coalesce(user_avg_amount, 200e0) AS user_avg_amount FROM messages",
    "p06_default_ratio": (
        "SELECT transaction_id, coalesce(amount_vs_avg_user, amount / 200e0) AS amount_vs_avg_user FROM messages"
    ),
    "p07_fill_features": "SELECT n, transaction_id, payments.amount, "
    + ", ".join(f'coalesce(l."{c}", 0e0) AS "{c}"' for c in ["Time", *SIGNALS])
    + " FROM payments LEFT JOIN labelled l ON l.vec_id = n",
    "p08_model_amount": 'SELECT transaction_id, amount, amount AS model_amount FROM payments',
    "p09_transaction_rows": f"SELECT {TX_COLUMNS} FROM ({_stored('streamed')})",
    "p10_risk_score_rows": _risk_rows("streamed"),
    "p11_alert_rows": f"""
      SELECT md5(transaction_id || '|HYBRID_FRAUD_DETECTION') AS alert_id, transaction_id, user_id,
             final_score AS risk_score, 'HYBRID_FRAUD_DETECTION' AS alert_type, 'OPEN' AS status,
             'Transaction ' || transaction_id || ' detected as ' || transaction_status || ' | final_score=' || final_score
               || ' | ml_probability=' AS message_text,
             ml_probability AS message_probability
      FROM scored WHERE {ALERTING}""",
    "p12_complete_rows": f"""
      SELECT {_LABELLED_COLUMNS} FROM {_GAPS} WHERE "V3" IS NOT NULL AND NOT isnan("V3") AND "Class" IS NOT NULL""",
    "p13_repair_alert_rows": _REPAIR_ROWS,
    "p14_repair_report": f"""
      SELECT *, 'REPAIRED' AS repair_status, {STAMP} AS repaired_at, COUNT(*) OVER () AS repaired_count_total
      FROM ({_MISSING})""",
    "p14_repair_report_none": f"SELECT 'NO_MISSING_ALERTS' AS status, CAST(0 AS BIGINT) AS repaired_count, {STAMP} AS checked_at",
    "p15_profile_enrichment": """
      SELECT event_id, user_id, value AS amount, usual_country, user_avg_amount,
             value / greatest(user_avg_amount, 1e0) AS amount_vs_avg_user
      FROM events JOIN profile USING (user_id)""",
    # filters
    "f01_required_fields": "SELECT transaction_id, user_id, amount, event_time FROM accepted",
    "k03_rejected_messages": """
      SELECT CASE WHEN n % 50 IN (1, 9) THEN 'unreadable_message' WHEN n % 50 = 2 THEN 'missing_transaction_id'
                  WHEN n % 50 = 3 THEN 'missing_user_id' WHEN n % 50 = 4 THEN 'missing_amount'
                  ELSE 'bad_timestamp' END AS reject_reason, COUNT(*) AS row_count
      FROM messages WHERE n % 50 IN (1, 2, 3, 4, 6, 9) GROUP BY 1""",
    "f01_rejected_messages": """
      SELECT CASE WHEN n % 50 IN (1, 9) THEN 'unreadable_message' WHEN n % 50 = 2 THEN 'missing_transaction_id'
                  WHEN n % 50 = 3 THEN 'missing_user_id' WHEN n % 50 = 4 THEN 'missing_amount'
                  ELSE 'bad_timestamp' END AS reject_reason, COUNT(*) AS row_count
      FROM messages WHERE n % 50 IN (1, 2, 3, 4, 6, 9) GROUP BY 1""",
    "f02_alertable": f"SELECT transaction_id, transaction_status FROM tx WHERE {ALERTING}",
    "f03_selected_statuses": (
        "SELECT transaction_id, transaction_status FROM tx WHERE transaction_status IN ('NORMAL', 'FRAUD')"
    ),
    "f03_no_selection": "SELECT transaction_id, transaction_status FROM tx",
    "f04_labelled": "SELECT transaction_id, actual_label FROM damaged WHERE actual_label IS NOT NULL",
    "f05_scores_present": f"""
      SELECT transaction_id, final_score, {PROBABILITY}, behavior_score, detection_method FROM damaged
      WHERE final_score IS NOT NULL AND ml_probability IS NOT NULL AND behavior_score IS NOT NULL
        AND detection_method IS NOT NULL""",
    "f06_fraud_only": "SELECT transaction_id FROM tx WHERE transaction_status = 'FRAUD'",
    "f07_by_class": 'SELECT "Time", "Class" FROM labelled WHERE "Class" = 1',
    "f08_faulty_rows": " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, device_id, ip_address FROM damaged WHERE {fault}" for name, fault in _FAULTS.items()
    ),
    # scoring
    **{
        f"r{i:02d}_{name}": f"SELECT transaction_id, {name} FROM scored"
        for i, name in enumerate(
            (
                "amount_score",
                "country_score",
                "merchant_score",
                "time_score",
                "device_score",
                "frequency_score",
                "rule_score",
                "behavior_score",
            ),
            start=1,
        )
    },
    "r10_ml_score": "SELECT transaction_id, ml_score FROM scored",
    "r11_final_score": "SELECT transaction_id, final_score FROM scored",
    "r12_transaction_status": "SELECT transaction_id, transaction_status FROM scored",
    "r13_risk_score": "SELECT transaction_id, final_score AS risk_score FROM scored",
    "r14_detection_method": "SELECT transaction_id, 'HYBRID_RULES_ML_BEHAVIOR' AS detection_method FROM scored",
    "r15_processed_at": "SELECT COUNT(*) AS row_count, 1 AS distinct_times FROM scored",
    # learning: what does not depend on what the forest learned
    "s06_model_scan": 'SELECT "Time" AS row_time, "Class" AS label, true AS sound FROM labelled',
    "k11_model_save": "SELECT COUNT(*) AS rows_seen, 80 AS trees FROM labelled",
    "k12_training_record": f"""
      SELECT 'Spark ML RandomForestClassifier' AS model_type, COUNT(*) AS total_rows,
             COUNT(*) FILTER (WHERE "Class" = 0) AS normal_rows, COUNT(*) FILTER (WHERE "Class" = 1) AS fraud_rows,
             true AS auc_is_high, true AS f1_is_high, '{",".join(["Time", *SIGNALS, "Amount"])}' AS features
      FROM labelled""",
    "r09_ml_probability": "SELECT transaction_id, true AS sound FROM payments",
    "m02_random_split": "SELECT COUNT(*) AS row_count, COUNT(*) AS distinct_rows, true AS share_is_near FROM labelled",
    "m04_forest": " UNION ALL ".join(f"SELECT '{c}' AS feature, true AS sound" for c in ["Time", *SIGNALS, "Amount"]),
    "m05_pipeline_fit": (
        "SELECT 0 AS position, 'VectorAssembler' AS stage UNION ALL SELECT 1, 'RandomForestClassificationModel'"
    ),
    "m06_batch_scoring": f"""
      SELECT "Time" AS row_time, "Class" AS label, true AS sound FROM labelled
      WHERE {_bucket('"Time"')} >= CAST(floor(8e-1 * 4294967296) AS BIGINT)""",
    "m07_stream_scoring": "SELECT transaction_id, true AS sound, true AS score_follows FROM payments",
    "m08_area_under_roc": _auc("payments", "ml_probability", "actual_label"),
    "m08_area_under_roc_of_scores": _auc("damaged", "final_score", "actual_label"),
    "m09_weighted_f1": _f1("tx", "actual_label", "CAST(transaction_status <> 'NORMAL' AS INTEGER)"),
    "m09_weighted_f1_of_classes": _f1("damaged", "final_score - final_score % 10", "behavior_score"),
    "m01_class_weights": """
      SELECT "Time", "Class", CASE "Class" WHEN 1 THEN total / (2e0 * fraud) ELSE total / (2e0 * (total - fraud)) END
        AS class_weight
      FROM labelled, (SELECT COUNT(*) AS total, SUM("Class") AS fraud FROM labelled)""",
    "m02_hash_split": f"""
      SELECT vec_id AS row_id, CASE WHEN {_bucket('vec_id')} < CAST(floor(8e-1 * 4294967296) AS BIGINT)
        THEN 'train' ELSE 'held_out' END AS part
      FROM embeddings""",
    "m03_feature_vector": 'SELECT "Time" AS first_input, "V1" AS second_input, "Amount" AS last_input, 30 AS inputs FROM labelled',
    "m10_rebalance": f"""
      SELECT n, CAST(actual_label AS INTEGER) AS "Class" FROM payments,
        (SELECT COUNT(*) AS total, SUM(actual_label) AS fraud FROM payments)
      WHERE {_bucket('n')} < CASE WHEN actual_label = 1
        THEN CAST(floor(least(1e0, 1e0 / (fraud * (1e0 - 10e-2) / (10e-2 * (total - fraud)))) * 4294967296) AS BIGINT)
        ELSE CAST(floor(least(1e0, fraud * (1e0 - 10e-2) / (10e-2 * (total - fraud))) * 4294967296) AS BIGINT) END""",
    # joins
    "j01_alerts_without_transaction": f"""
      SELECT {ALERT_COLUMNS} FROM lossy l
      WHERE NOT EXISTS (SELECT 1 FROM damaged d WHERE d.transaction_id = l.transaction_id)""",
    "j02_transactions_without_alert": _KEYED["fraud_transaction_without_alert"],
    "j03_missing_alerts": _MISSING,
    "j04_repair_insert": _REPAIR_ROWS,
    "j05_profile_lookup": "SELECT event_id, usual_country, user_avg_amount FROM events JOIN profile USING (user_id)",
    # aggregations
    "a01_daily_summary": f"SELECT {_KPI}, {_peak('ml_probability')}, {_peak('final_score')} FROM tx",
    "a02_status_breakdown": f"""
      SELECT transaction_status, COUNT(*) AS total, {_mean('ml_probability')}, {_mean('final_score')},
             {_peak('final_score')} FROM tx GROUP BY transaction_status""",
    "a03_top_alert_countries": f"""
      SELECT country, COUNT(*) AS total_alerts, {_n_status('FRAUD', 'SUSPICIOUS')}, {_fraud_money('fraud_amount')}
      FROM tx WHERE {ALERTING} GROUP BY country ORDER BY total_alerts DESC, country LIMIT 20""",
    "a04_kpi_block": f"SELECT {_KPI} FROM tx WHERE transaction_status IN ('SUSPICIOUS', 'FRAUD')",
    "a05_status_distribution": "SELECT transaction_status, COUNT(*) AS count FROM tx GROUP BY transaction_status",
    "a06_top_countries": f"""
      SELECT country, COUNT(*) AS total_alerts FROM tx WHERE {ALERTING}
      GROUP BY country ORDER BY total_alerts DESC, country LIMIT 10""",
    "a07_final_score_histogram": _histogram("final_score / 5", "final_score", "5e0"),
    "a08_probability_histogram": _histogram("ml_probability * 20", "ml_probability", "5e-2"),
    "a09_behavior_distribution": "SELECT behavior_score, COUNT(*) AS count FROM tx GROUP BY behavior_score",
    "a10_method_distribution": "SELECT detection_method, COUNT(*) AS count FROM tx GROUP BY detection_method",
    "a11_confusion": _CONFUSION,
    "a12_confusion_metrics": f"""
      SELECT true_positives, false_positives, true_negatives, false_negatives, round(p, 4) AS precision,
        round(r, 4) AS recall, round(coalesce(2 * p * r / nullif(p + r, 0), 0e0), 4) AS f1_score,
        round(coalesce((true_positives + true_negatives)
          / nullif(true_positives + true_negatives + false_positives + false_negatives, 0), 0e0), 4) AS accuracy,
        {STAMP} AS evaluated_at
      FROM (SELECT *, coalesce(true_positives / nullif(true_positives + false_positives, 0), 0e0) AS p,
                      coalesce(true_positives / nullif(true_positives + false_negatives, 0), 0e0) AS r
            FROM ({_CONFUSION}))""",
    "a13_label_status_breakdown": f"""
      SELECT actual_label, transaction_status, COUNT(*) AS total, {_mean('ml_probability')}, {_mean('behavior_score')},
             {_mean('final_score')}, {_peak('final_score')} FROM tx GROUP BY actual_label, transaction_status""",
    "a14_label_status_matrix": (
        "SELECT actual_label, transaction_status, COUNT(*) AS total FROM tx GROUP BY actual_label, transaction_status"
    ),
    "a14_label_status_matrix_wide": """
      SELECT actual_label, COUNT(*) FILTER (WHERE transaction_status = 'NORMAL') AS "NORMAL",
             COUNT(*) FILTER (WHERE transaction_status = 'SUSPICIOUS') AS "SUSPICIOUS", COUNT(*) FILTER (WHERE transaction_status = 'FRAUD') AS "FRAUD"
      FROM tx GROUP BY actual_label""",
    "a15_label_profile": f"""
      SELECT actual_label, COUNT(*) AS total, {_mean('ml_probability')}, {_mean('final_score')}, {_peak('final_score')}
      FROM tx GROUP BY actual_label""",
    "a16_frauds_per_minute": """
      SELECT date_trunc('minute', processed_at) AS minute, COUNT(*) AS fraud_count FROM tx
      WHERE transaction_status = 'FRAUD' GROUP BY minute""",
    "a17_table_counts": _counts("tx", "scored", "alerts"),
    "a18_duplicated_ids": (
        "SELECT transaction_id, COUNT(*) AS row_count FROM damaged GROUP BY transaction_id HAVING COUNT(*) > 1"
    ),
    # quality
    **{f"q{i:02d}_{name}": _check(name) for i, name in enumerate(CHECK_ORDER, start=1)},
    "q19_quality_report": f"""
      SELECT check_name, CASE WHEN issue_count = 0 THEN 'PASSED' ELSE 'FAILED' END AS status, issue_count,
             {STAMP} AS checked_at
      FROM ({_REPORT})""",
    "q20_observed_checks": f"SELECT * FROM ({_REPORT}) WHERE check_name NOT IN ('duplicated_transaction_id', 'fraud_alert_without_transaction', 'fraud_transaction_without_alert')",
    "q19_quality_gate": f"""
      SELECT COUNT(*) FILTER (WHERE issue_count > 0) > 0 AS gate_failed FROM ({_REPORT})""",
    # top-k and sorts
    "l01_alert_details": f"SELECT {DETAILS} FROM tx WHERE {ALERTING}",
    "l02_top_predictions": f"""
      SELECT {DETAILS.replace('currency, ', '')} FROM tx WHERE actual_label IS NOT NULL
      ORDER BY final_score DESC, transaction_id LIMIT 100""",
    "l03_latest_transactions": f"SELECT {DETAILS} FROM tx ORDER BY processed_at DESC, transaction_id LIMIT 30",
    "l04_latest_alerts": f"SELECT {ALERT_COLUMNS} FROM alerts ORDER BY created_at DESC, transaction_id LIMIT 30",
    "l05_latest_checked": f"""
      SELECT transaction_id, {AMOUNT}, country, usual_country, {PROBABILITY}, behavior_score, final_score,
             transaction_status, actual_label FROM tx ORDER BY processed_at DESC, transaction_id LIMIT 20""",
    "l06_newest_missing_alerts": _MISSING,
    # streaming
    "t01_scoring_stream": f"SELECT {TX_COLUMNS} FROM ({_stored('streamed')})",
    "t01_scoring_stream_alerts": f"SELECT {ALERT_COLUMNS} FROM ({_alerts('streamed')})",
    "t01_restarted_stream": f"SELECT {TX_COLUMNS} FROM ({_stored('streamed')})",
    "t02_fraud_timeline": """
      SELECT date_trunc('minute', transaction_timestamp) AS minute, COUNT(*) AS fraud_count FROM tx
      WHERE transaction_status = 'FRAUD' GROUP BY minute""",
    "t02_late_events": """
      WITH frauds AS (
        SELECT transaction_timestamp AS ts, CAST(substr(transaction_id, 4) AS BIGINT) % 3 = 0 AS late
        FROM tx WHERE transaction_status = 'FRAUD'),
      parts AS (SELECT *, ts < TIMESTAMP '2024-01-16 12:00:00' AND NOT late AS first FROM frauds),
      mark AS (SELECT date_trunc('milliseconds', max(ts)) - INTERVAL 2 DAY AS wm FROM parts WHERE first)
      SELECT date_trunc('minute', ts) AS minute, COUNT(*) AS fraud_count FROM parts, mark
      WHERE first OR ts > wm GROUP BY minute""",
    "t02_replayed_timeline": """
      SELECT date_trunc('minute', transaction_timestamp) AS minute, COUNT(*) AS fraud_count FROM tx
      WHERE transaction_status = 'FRAUD' GROUP BY minute""",
    "t03_drop_duplicates": """
      SELECT DISTINCT transaction_id FROM damaged WHERE transaction_id IS NOT NULL
      UNION ALL SELECT transaction_id FROM damaged WHERE transaction_id IS NULL""",
    "t03_drop_stored": f"SELECT transaction_id FROM tx WHERE {ALERTING}",
    "t03_bounded_memory": f"SELECT {TX_COLUMNS} FROM ({_stored('streamed')})",
    "t03_stream_duplicates": f"SELECT {TX_COLUMNS} FROM ({_stored('streamed')})",
    # declared tables
    "x01_daily_rollup": f"""
      SELECT CAST(transaction_timestamp AS DATE) AS report_date, COUNT(*) AS total_transactions,
             {_n_status('NORMAL', 'SUSPICIOUS', 'FRAUD')}, {_fraud_money('total_fraud_amount')}
      FROM tx GROUP BY report_date""",
    "x01_maintained_reports": f"""
      SELECT CAST(transaction_timestamp AS DATE) AS report_date, COUNT(*) AS total_transactions,
             {_n_status('NORMAL', 'SUSPICIOUS', 'FRAUD')}, {_fraud_money('total_fraud_amount')}
      FROM tx GROUP BY report_date""",
    "x02_rated_users": _RATED,
    "x02_merged_history": _RATED,
    "p15_running_average": """
      WITH spent AS (
        SELECT transaction_id, amount, SUM(CAST(round(amount * 100) AS BIGINT)) OVER h AS cents, COUNT(*) OVER h AS k
        FROM payments
        WINDOW h AS (PARTITION BY user_id ORDER BY event_time, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
      averaged AS (
        SELECT transaction_id, amount, CASE WHEN k > 0 THEN CAST(cents AS DOUBLE) / 100 / k END AS user_avg_amount FROM spent)
      SELECT transaction_id, user_avg_amount,
             CASE WHEN user_avg_amount IS NOT NULL THEN amount / greatest(user_avg_amount, 1e0) END AS amount_vs_avg_user
      FROM averaged""",
    "p15_running_average_stream": """
      WITH stored AS (SELECT *, CAST(amount AS DECIMAL(12, 2)) AS kept FROM payments),
      spent AS (
        SELECT transaction_id, CAST(kept AS DOUBLE) AS amount, SUM(CAST(kept * 100 AS BIGINT)) OVER h AS cents, COUNT(*) OVER h AS k
        FROM stored
        WINDOW h AS (PARTITION BY user_id ORDER BY event_time, transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
      averaged AS (
        SELECT transaction_id, amount, CASE WHEN k > 0 THEN CAST(cents AS DOUBLE) / 100 / k END AS user_avg_amount FROM spent)
      SELECT transaction_id, user_avg_amount,
             CASE WHEN user_avg_amount IS NOT NULL THEN amount / greatest(user_avg_amount, 1e0) END AS amount_vs_avg_user
      FROM averaged""",
    "j01_alerts_without_transaction_bucketed": _LONELY,
    "j03_missing_alerts_bucketed": f"""
      SELECT transaction_id, user_id, processed_at FROM damaged
      WHERE {ALERTING} AND NOT EXISTS (SELECT 1 FROM lossy l WHERE l.transaction_id = damaged.transaction_id)""",
    "x02_user_dimension": """
      SELECT 'U' || c_custkey AS user_id, n_name AS usual_country, user_avg_amount AS avg_amount,
             CAST(NULL AS VARCHAR) AS risk_level
      FROM customer JOIN nation ON n_nationkey = c_nationkey LEFT JOIN profile ON user_id = c_custkey""",
    "x04_surrogate_keys": "SELECT alert_id, transaction_id FROM alerts",
}


_KNOWN_STATUS = "transaction_status IN ('NORMAL', 'SUSPICIOUS', 'FRAUD')"
_DAMAGED_ROWS = {
    "a07": _KNOWN_STATUS,
    "a08": _KNOWN_STATUS,
    "a09": f"{_KNOWN_STATUS} AND behavior_score IS NOT NULL",
    "a10": f"{_KNOWN_STATUS} AND detection_method IS NOT NULL",
}


def _damaged(name: str) -> str:
    """The same SELECT over the damaged rows that the plan takes: labelled ones, or those of a known status."""
    rows = _DAMAGED_ROWS.get(name[:3], "actual_label IS NOT NULL")
    return SELECTS[name].replace("FROM tx", f"FROM (SELECT * FROM damaged WHERE {rows}) AS taken")


def statements() -> dict[str, str]:
    from checks.queries import CSV_CONTENTS, DAMAGED_PLANS, FROM_CUBE

    selects = {**SELECTS, **{f"{name}_from_cube": SELECTS[name] for name in FROM_CUBE}}
    selects |= {f"{name}_damaged": _damaged(name) for name in DAMAGED_PLANS}
    selects |= {f"{name}_merged": SELECTS[name] for name in SELECTS if name[:3] in ("l03", "l04", "l05")}
    selects |= {name: SELECTS[content] for name, content in CSV_CONTENTS.items()}
    selects["k09_model_evaluation_metrics"] = f"SELECT * EXCLUDE (evaluated_at) FROM ({SELECTS['a12_confusion_metrics']})"
    # a statement with names of its own stands in brackets behind the common ones
    nested = {k: f"SELECT * FROM ({s})" if s.lstrip().startswith("WITH") else s for k, s in selects.items()}
    return {name: f"{BASE} {select}" for name, select in nested.items()}
