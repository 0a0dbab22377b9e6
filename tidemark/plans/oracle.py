"""SQL counterparts of the named queries, for a second engine to check results against."""

from __future__ import annotations

from tidemark import settings
from tidemark.operators.rules import ENUM_RULES, NUMERIC_RULES
from tidemark.plans.queries import LIMIT, RANGES, STORED, THRESHOLDS, tried_values
from tidemark.plans.testbed import ATTRIBUTION_WIDTH, ORDERS_CARD

DERIVED = """
  tenure_months / 12e0 AS tenure_years,
  CAST(coalesce(tenure_months <= 12, false) AS INTEGER) AS is_new_customer,
  CAST(coalesce(tenure_months >= 36, false) AS INTEGER) AS is_long_term_customer,
  total_charges / (tenure_months + 1) AS avg_monthly_spend,
  monthly_charges / (total_charges / (tenure_months + 1) + 0.01e0) AS current_to_avg_ratio,
  monthly_charges / (total_charges + 0.01e0) AS total_spend_ratio,
  CAST(internet_service IS NOT NULL AS INTEGER) AS service_count,
  CAST(coalesce(monthly_charges > (SELECT quantile_cont(monthly_charges, 0.5) FROM customers), false) AS INTEGER)
    AS is_high_value"""


def _card() -> str:
    terms = [f"{ORDERS_CARD.base}e0"] + [
        f"CASE WHEN {c} THEN {p}e0 ELSE 0e0 END" for c, p in ORDERS_CARD.rules
    ]
    return f"round(least(greatest({' + '.join(terms)}, {ORDERS_CARD.low}e0), {ORDERS_CARD.high}e0), 6)"


CUSTOMERS = """
cut AS (SELECT max(o_orderdate) - INTERVAL 180 DAY AS c FROM orders),
early AS (SELECT o.* FROM orders o, cut WHERE o_orderdate <= c),
totals AS (
  SELECT o_custkey, count(*) AS n_orders, min(o_orderdate) AS first_order,
         CAST(sum(CAST(o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS total
  FROM early GROUP BY o_custkey),
priorities AS (
  SELECT o_custkey, o_orderpriority,
         row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderpriority) AS rn
  FROM early GROUP BY o_custkey, o_orderpriority),
statuses AS (
  SELECT o_custkey, o_orderstatus,
         row_number() OVER (PARTITION BY o_custkey ORDER BY count(*) DESC, o_orderstatus) AS rn
  FROM early GROUP BY o_custkey, o_orderstatus),
later AS (SELECT DISTINCT o_custkey FROM orders, cut WHERE o_orderdate > c),
customers AS (
  SELECT printf('CUST_%04d', c_custkey) AS customer_id,
         CAST(date_diff('day', first_order, c) // 30 AS INTEGER) AS tenure_months,
         CASE WHEN c_acctbal >= 0 THEN total / n_orders END AS monthly_charges,
         total AS total_charges, c_mktsegment AS contract_type,
         CASE WHEN c_acctbal <= 9500 THEN p.o_orderpriority END AS payment_method,
         s.o_orderstatus AS internet_service,
         CAST(l.o_custkey IS NULL AS INTEGER) AS churn,
         round((c_acctbal + 1000e0) / 11000e0, 6) AS account_score
  FROM totals t JOIN customer ON c_custkey = t.o_custkey
  JOIN priorities p ON p.o_custkey = t.o_custkey AND p.rn = 1
  JOIN statuses s ON s.o_custkey = t.o_custkey AND s.rn = 1
  LEFT JOIN later l ON l.o_custkey = t.o_custkey, cut)"""

SCORED = f"""{CUSTOMERS},
raw_scored AS (SELECT *, {_card()} AS churn_probability FROM customers),
scored AS (
  SELECT *, churn_probability >= 0.5e0 AS is_high_risk,
         CAST(churn_probability >= 0.5e0 AS INTEGER) AS predicted_class,
         'v_' || lower(internet_service) AS model_version
  FROM raw_scored)"""

LOG = """
predictions AS (
  SELECT 'PRED_' || event_id AS prediction_id, CAST(user_id AS VARCHAR) AS customer_id,
         'v_' || event_type AS model_version, round(value / (value + 50e0), 6) AS prediction,
         CAST(value >= 50 AS INTEGER) AS predicted_class, ts AS prediction_timestamp, props AS features
  FROM events WHERE event_type IN ('view', 'click')),
decided AS (
  SELECT 'PRED_' || (event_id - d) AS prediction_id, CAST(event_type = 'purchase' AS INTEGER) AS actual_outcome,
         ts AS outcome_timestamp
  FROM events, (VALUES (1), (2)) v(d) WHERE event_type IN ('purchase', 'signup', 'error')),
last_decided AS (
  SELECT * FROM decided
  QUALIFY row_number() OVER (PARTITION BY prediction_id ORDER BY outcome_timestamp DESC, actual_outcome DESC) = 1),
resolved AS (
  SELECT p.*, d.actual_outcome, d.outcome_timestamp FROM predictions p LEFT JOIN last_decided d USING (prediction_id))"""

ATTRIBUTIONS = f"""
attributions AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS shap, 0.25e0 AS base_value, label >= 5 AS is_high_risk,
         0.25e0 + list_sum(CAST(embedding AS DOUBLE[])[1:{ATTRIBUTION_WIDTH // 2}]) AS margin
  FROM embeddings),
long AS (
  SELECT vec_id, is_high_risk, i - 1 AS pos, 'f' || (i - 1) AS feature, shap[i] AS v
  FROM attributions, range(1, {ATTRIBUTION_WIDTH + 1}) r(i)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY abs(v) DESC, pos) AS rank FROM long)"""

MICRO = "'%Y-%m-%d %H:%M:%S.%f'"


def _counts(label: str, predicted: str) -> str:
    parts = [("tn", 0, 0), ("fp", 0, 1), ("fn", 1, 0), ("tp", 1, 1)]
    return ", ".join(f"count(*) FILTER (WHERE {label} = {y} AND {predicted} = {p}) AS {n}" for n, y, p in parts)


_METRICS = """coalesce(tp / nullif(tp + fp, 0), 0e0) AS precision,
  coalesce(tp / nullif(tp + fn, 0), 0e0) AS recall,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0e0) AS f1_score,
  coalesce((tn + tp) / nullif(tn + fp + fn + tp, 0), 0e0) AS accuracy"""


def _rounded(expressions: str, names: str, source: str) -> str:
    return f"SELECT {expressions}{', '.join(f'round({n}, 6) AS {n}' for n in names.split())} FROM {source}"


def _auc(source: str, label: str, score: str, by: str) -> str:
    """Mann-Whitney statistic from tie-averaged ranks, as a subquery with the group and roc_auc."""
    part = f"PARTITION BY {by} " if by else ""
    group = f"GROUP BY {by}" if by else ""
    keep = f"{by}, " if by else ""
    return f"""(
  SELECT {keep}CASE WHEN count(*) FILTER (WHERE y = 1) * count(*) FILTER (WHERE y = 0) = 0 THEN 0e0 ELSE
    (sum(r) FILTER (WHERE y = 1) - count(*) FILTER (WHERE y = 1) * (count(*) FILTER (WHERE y = 1) + 1) / 2e0)
    / (CAST(count(*) FILTER (WHERE y = 1) AS DOUBLE) * count(*) FILTER (WHERE y = 0)) END AS roc_auc
  FROM (
    SELECT {keep}{label} AS y,
      rank() OVER ({part}ORDER BY {score}) + (count(*) OVER (PARTITION BY {keep}{score}) - 1) / 2e0 AS r
    FROM {source}) {group})"""


def _evaluation(source: str, label: str, score: str, predicted: str, by: str) -> str:
    return f"""(
  SELECT c.*, coalesce(a.roc_auc, 0e0) AS roc_auc, tn + fp + fn + tp AS n_samples, {_METRICS}
  FROM (SELECT {by}, {_counts(label, predicted)}, count(*) FILTER (WHERE {score} IS NULL OR isnan({score})) AS n_unscored
    FROM {source} GROUP BY {by}) c
  LEFT JOIN {_auc(f'(SELECT * FROM {source} WHERE NOT isnan({score}))', label, score, by)} a USING ({by}))"""


_EVAL_COLUMNS = (
    "tn, fp, fn, tp, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1_score, 6) AS f1_score, "
    "round(accuracy, 6) AS accuracy, round(roc_auc, 6) AS roc_auc, n_samples, n_unscored"
)

DAILY = f"""{LOG},
dated AS (
  SELECT * REPLACE ('v_' || strftime(prediction_timestamp, '%Y%m%d') AS model_version)
  FROM resolved WHERE actual_outcome IS NOT NULL),
daily AS (
  SELECT model_version, strptime(substr(model_version, 3), '%Y%m%d') AS evaluation_date,
         tn, fp, fn, tp, precision, recall, f1_score, accuracy, roc_auc, n_samples
  FROM {_evaluation('dated', 'actual_outcome', 'prediction', 'predicted_class', 'model_version')})"""

# decided events of closed days, and what the daily check makes of them
_DECIDED = f"""decided_events AS (SELECT 'v_' || event_type AS model_version, CAST(value >= 50 AS INTEGER) AS predicted_class,
    round(value / (value + 50e0), 6) AS prediction, CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50 AS INTEGER) AS actual_outcome,
    date_trunc('day', ts) AS day FROM events
  WHERE date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)),
days AS (SELECT * FROM {_evaluation('decided_events', 'actual_outcome', 'prediction', 'predicted_class', 'model_version, day')})"""

# predictions whose three hours are over by the final watermark of their stream
_CLOSED = """closed AS (SELECT * FROM predictions WHERE prediction_timestamp + INTERVAL 3 HOUR
  < (SELECT least((SELECT max(prediction_timestamp) FROM predictions), (SELECT max(outcome_timestamp) FROM decided)) - INTERVAL 1 HOUR))"""

_EVALUATED = ["tn", "fp", "fn", "tp", "precision", "recall", "f1_score", "accuracy", "roc_auc", "n_unscored"]

def _quoted(text: str | None) -> str:
    return "NULL" if text is None else "'" + text.replace("'", "''") + "'"


def _stored_schemas() -> str:
    """The errors from the engine's own description of the files. Types have Spark's names."""
    kind = ("CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double' "
            "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'DATE' THEN 'date' ELSE lower(column_type) END")  # fmt: skip
    parts = []
    for t in STORED:
        parts.append(f"SELECT '{t}' AS table_name, 'Missing required features: [''no_such_column'']' AS error UNION ALL SELECT '{t}', 'Missing target variable: no_label'")
        parts.append(f"SELECT '{t}', 'Feature ''' || column_name || ''' must be numeric, got ' || {kind} FROM (DESCRIBE {t}) WHERE {kind} NOT IN ('bigint', 'int', 'double')")
        parts.append(f"SELECT '{t}', 'Feature ''' || column_name || ''' must be categorical/string, got ' || {kind} FROM (DESCRIBE {t}) WHERE {kind} <> 'string'")
    return " UNION ALL ".join(parts)


def _rule_error(param: str) -> str:
    """What is wrong with ``value`` of the type ``kind``, as SQL of its own for every rule."""
    numeric = {r[0]: r for r in NUMERIC_RULES}
    if param not in numeric:
        listed = ENUM_RULES[param]
        tail = _quoted("'. Must be one of: " + ", ".join(listed))
        head = _quoted(f"{param}: Invalid value '")
        return f"CASE WHEN value NOT IN ({', '.join(map(_quoted, listed))}) THEN {head} || value || {tail} END"
    _, wanted, low, excluded, high, text = numeric[param]
    allowed, name = ("('int', 'bool')", "an integer") if wanted == "int" else ("('int', 'float', 'bool')", "a number")
    x = "CASE value WHEN 'True' THEN 1e0 WHEN 'False' THEN 0e0 ELSE TRY_CAST(value AS DOUBLE) END"
    bounds = [] if low is None else [f"{x} {'<=' if excluded else '<'} {low}e0"]
    bounds += [] if high is None else [f"{x} > {high}e0"]
    wrong = f"NOT isnan({x}) AND ({' OR '.join(bounds)})" if bounds else "false"
    return f"CASE WHEN kind NOT IN {allowed} THEN '{param}: Expected {name}, got ' || kind WHEN {wrong} THEN '{param}: {text} (got ' || value || ')' END"


def _all_rules() -> str:
    parts = []
    for i, (param, values) in enumerate(tried_values().items()):
        texts, kinds = (", ".join(map(_quoted, some)) for some in zip(*values, strict=True))
        at = f"CAST((o_orderkey + {i}) % {len(values)} + 1 AS INTEGER)"
        rows = f"SELECT o_orderkey AS config_id, ([{texts}])[{at}] AS value, ([{kinds}])[{at}] AS kind FROM orders"
        parts.append(f"SELECT config_id, '{param}' AS param, value, {_rule_error(param)} AS error FROM ({rows}) WHERE value IS NOT NULL")
    return f"SELECT * FROM ({' UNION ALL '.join(parts)}) WHERE error IS NOT NULL"


VERSION_EVENTS = f"""{DAILY},
version_events AS (
  SELECT model_version AS version, 'deploy' AS event, evaluation_date + INTERVAL 12 HOUR AS happened
  FROM daily WHERE recall >= 0.5
  UNION ALL
  SELECT model_version, 'delete', evaluation_date + INTERVAL 20 HOUR FROM daily WHERE recall < 0.4)"""


def _hash(key: str, seed: int) -> str:
    return f"CAST('0x' || substr(md5({key} || '{seed}'), 1, 15) AS BIGINT)"


def _range_rows() -> str:
    rows = []
    for c, (low, high) in RANGES.items():
        outside = f"count(*) FILTER (WHERE {c} IS NOT NULL AND NOT {c} BETWEEN {low} AND {high})"
        rows.append(
            f"SELECT '{c}' AS feature, CAST({low} AS DOUBLE) AS lower_bound, CAST({high} AS DOUBLE) AS upper_bound, "
            f"round(CAST(min({c}) AS DOUBLE), 6) AS observed_min, round(CAST(max({c}) AS DOUBLE), 6) AS observed_max, "
            f"{outside} AS n_outside, {outside} = 0 AS in_range FROM customers"
        )
    return " UNION ALL ".join(rows)


_OUT = ", ".join(f"CASE WHEN NOT {c} BETWEEN {lo} AND {hi} THEN '{c}' END" for c, (lo, hi) in RANGES.items())

_ENGINEERED = f"{CUSTOMERS}, engineered AS (SELECT *, {DERIVED} FROM customers)"
_NUMERIC = settings.NUMERIC_FEATURES + [
    "tenure_years", "is_new_customer", "is_long_term_customer", "avg_monthly_spend", "current_to_avg_ratio",
    "total_spend_ratio", "service_count", "is_high_value",
]
_FILLED_STD = "stddev_pop(coalesce(CAST({c} AS DOUBLE), (SELECT avg({c}) FROM {t})))"
_STATS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(avg({c}), 6) AS mean, "
    f"round(coalesce(nullif({_FILLED_STD.format(c=c, t='engineered')}, 0), 1), 6) AS scale FROM engineered"
    for c in _NUMERIC
)
_CATEGORY_ROWS = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS category FROM customers" for c in settings.CATEGORICAL_FEATURES
)

_SEGMENTS = ["AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY"]
_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
_STATUSES = ["F", "O", "P"]


def _encoded() -> str:
    parts = ["customer_id"]
    for c in settings.NUMERIC_FEATURES:
        mean = f"(SELECT avg({c}) FROM seen)"
        parts.append(
            f"round((coalesce({c}, {mean}) - {mean}) / (SELECT {_FILLED_STD.format(c=c, t='seen')} FROM seen), 6) AS {c}"
        )
    for c, values in zip(settings.CATEGORICAL_FEATURES, (_SEGMENTS, _PRIORITIES, _STATUSES)):
        mode = f"(SELECT {c} FROM seen WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
        for v in values:
            name = f"{c}_{v}".lower().replace("-", "_").replace(" ", "_")
            parts.append(f"CAST(coalesce({c}, {mode}) = '{v}' AS DOUBLE) AS {name}")
    return f"WITH {CUSTOMERS}, seen AS (SELECT * FROM customers WHERE contract_type <> 'FURNITURE') SELECT {', '.join(parts)} FROM customers"


_CONFIGS = """configs AS (
  SELECT o_orderkey AS config_id, printf('%.10f', o_totalprice / 400000e0) AS learning_rate,
         printf('%.10f', 1.5e0 - o_totalprice / 250000e0) AS subsample, day(o_orderdate) - 1 AS n_estimators,
         CASE o_orderpriority WHEN '1-URGENT' THEN 'hist' WHEN '2-HIGH' THEN 'fastest' END AS tree_method,
         o_orderstatus AS max_depth
  FROM orders),
violations AS (
  SELECT config_id, 'learning_rate' AS param, learning_rate AS value,
         'learning_rate: Learning rate (eta) must be in range (0, 1] (got ' || learning_rate || ')' AS error
  FROM configs WHERE CAST(learning_rate AS DOUBLE) <= 0 OR CAST(learning_rate AS DOUBLE) > 1
  UNION ALL
  SELECT config_id, 'subsample', subsample, 'subsample: Subsample ratio must be in range (0, 1] (got ' || subsample || ')'
  FROM configs WHERE CAST(subsample AS DOUBLE) <= 0 OR CAST(subsample AS DOUBLE) > 1
  UNION ALL
  SELECT config_id, 'n_estimators', CAST(n_estimators AS VARCHAR),
         'n_estimators: Number of estimators must be >= 1 (got ' || n_estimators || ')'
  FROM configs WHERE n_estimators < 1
  UNION ALL
  SELECT config_id, 'tree_method', tree_method,
         'tree_method: Invalid value ''' || tree_method || '''. Must be one of: {methods}'
  FROM configs WHERE tree_method NOT IN ({quoted})
  UNION ALL
  SELECT config_id, 'max_depth', max_depth, 'max_depth: Expected an integer, got str' FROM configs)""".format(
    methods=", ".join(ENUM_RULES["tree_method"]), quoted=", ".join(f"'{m}'" for m in ENUM_RULES["tree_method"])
)


def _split_cut() -> str:
    return (
        "ordered AS (SELECT customer_id, churn, row_number() OVER (PARTITION BY churn ORDER BY "
        f"{_hash('customer_id', 42)}, customer_id) AS rn, count(*) OVER (PARTITION BY churn) AS n FROM customers)"
    )


_EDGES = """
pos AS (SELECT account_score AS s, row_number() OVER (ORDER BY account_score) - 1 AS rn, count(*) OVER () AS n FROM scored),
wanted AS (SELECT i, i * (1e0 / 8) * ((SELECT max(n) FROM pos) - 1) AS p FROM range(1, 8) r(i)),
edges AS (
  SELECT CASE WHEN p - floor(p) >= 0.5 THEN h.s - (h.s - l.s) * (1 - (p - floor(p)))
              ELSE l.s + (h.s - l.s) * (p - floor(p)) END AS e
  FROM wanted JOIN pos l ON l.rn = floor(p) JOIN pos h ON h.rn = ceil(p)),
binned AS (SELECT churn, account_score, (SELECT count(*) FROM edges WHERE e < account_score) AS bin FROM scored)"""


def _box(source: str, value: str) -> str:
    qs = {"min": 0, "q1": 0.25, "median": 0.5, "q3": 0.75, "max": 1}
    return f"SELECT churn, {', '.join(f'round(quantile_cont({value}, {q}), 6) AS {n}' for n, q in qs.items())} FROM {source} WHERE {value} IS NOT NULL GROUP BY churn"


def _profile() -> str:
    types = {
        "customer_id": "string", "tenure_months": "int", "monthly_charges": "double", "total_charges": "double",
        "contract_type": "string", "payment_method": "string", "internet_service": "string", "churn": "int",
        "account_score": "double",
    }
    rows = []
    for c, t in types.items():
        bounds = [f"round(CAST({f}({c}) AS DOUBLE), 6)" if t != "string" else "CAST(NULL AS DOUBLE)" for f in ("min", "max")]
        rows.append(
            f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) AS n_rows, count(*) - count({c}) AS n_missing, "
            f"{bounds[0]} AS min_value, {bounds[1]} AS max_value FROM customers"
        )
    return " UNION ALL ".join(rows)


_POINTS = """
per_score AS (
  SELECT account_score AS threshold, count(*) FILTER (WHERE churn = 0) AS neg, count(*) FILTER (WHERE churn = 1) AS pos
  FROM scored GROUP BY account_score),
points AS (
  SELECT threshold, sum(neg) OVER w / sum(neg) OVER () AS fpr, sum(pos) OVER w / sum(pos) OVER () AS tpr
  FROM per_score WINDOW w AS (ORDER BY threshold DESC))"""

_BANDS = [("(0.0, 0.2]", 0.0, 0.2), ("(0.2, 0.4]", 0.2, 0.4), ("(0.4, 0.6]", 0.4, 0.6), ("(0.6, 0.8]", 0.6, 0.8), ("(0.8, 1.0]", 0.8, 1.0)]
_BAND = "CASE " + " ".join(
    f"WHEN churn_probability > {lo}e0 AND churn_probability <= {hi}e0 THEN '{n}'" for n, lo, hi in _BANDS
) + " END"

# the scored customers whose score is left when the queries on gaps blank a fifth
_KNOWN = SCORED.replace("scored AS (\n  SELECT", "all_scored AS (\n  SELECT").replace("raw_all_scored", "raw_scored") + """,
scored AS (SELECT * FROM all_scored WHERE CAST(substr(customer_id, 6) AS BIGINT) % 10 NOT IN (3, 7))"""

_UNIFORM = """
binned AS (
  SELECT churn, churn_probability,
         CAST(len(list_filter(range(1, 10), lambda i: i * (1e0 / 10) < churn_probability)) AS INTEGER) AS bin
  FROM scored),
curve AS (
  SELECT bin, avg(churn) AS prob_true, avg(churn_probability) AS prob_pred, count(*) AS n FROM binned GROUP BY bin)"""

_STREAM_SCORE = """round(least(greatest(0.15e0
  + CASE WHEN m < 6 THEN 0.3e0 ELSE 0e0 END + CASE WHEN m >= 6 AND m < 12 THEN 0.2e0 ELSE 0e0 END
  + CASE WHEN m >= 36 THEN -0.15e0 ELSE 0e0 END
  + CASE WHEN o_orderstatus = 'F' THEN 0.25e0 ELSE 0e0 END + CASE WHEN o_orderstatus = 'O' THEN -0.2e0 ELSE 0e0 END
  + CASE WHEN o_orderpriority = '1-URGENT' THEN 0.15e0 ELSE 0e0 END
  + CASE WHEN o_orderpriority <> '1-URGENT' THEN -0.1e0 ELSE 0e0 END
  + CASE WHEN o_totalprice / 5000e0 > 80 THEN 0.15e0 ELSE 0e0 END
  + CASE WHEN o_orderpriority <> '5-LOW' THEN 0.1e0 ELSE 0e0 END, 0.05e0), 0.85e0), 6)"""

_STATS_COLUMNS = """count(*) AS total_predictions, count(actual_outcome) AS predictions_with_outcomes,
  count(*) - count(actual_outcome) AS predictions_without_outcomes,
  round(count(*) FILTER (WHERE predicted_class = actual_outcome) / nullif(count(actual_outcome), 0), 6) AS accuracy"""

_REPORT = """
counts AS (SELECT {counts} FROM scored),
per_class AS (
  SELECT '0' AS label, coalesce(tn / nullif(tn + fn, 0), 0e0) AS p, coalesce(tn / nullif(tn + fp, 0), 0e0) AS r,
         coalesce(2 * tn / nullif(2 * tn + fn + fp, 0), 0e0) AS f, tn + fp AS s FROM counts
  UNION ALL
  SELECT '1', coalesce(tp / nullif(tp + fp, 0), 0e0), coalesce(tp / nullif(tp + fn, 0), 0e0),
         coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0e0), tp + fn FROM counts),
rows AS (
  SELECT * FROM per_class
  UNION ALL SELECT 'accuracy', (tn + tp) / (tn + fp + fn + tp), (tn + tp) / (tn + fp + fn + tp),
                   (tn + tp) / (tn + fp + fn + tp), tn + fp + fn + tp FROM counts
  UNION ALL SELECT 'macro avg', avg(p), avg(r), avg(f), CAST(sum(s) AS BIGINT) FROM per_class
  UNION ALL SELECT 'weighted avg', sum(p * s) / sum(s), sum(r * s) / sum(s), sum(f * s) / sum(s), CAST(sum(s) AS BIGINT)
            FROM per_class)""".format(counts=_counts("churn", "predicted_class"))

ORACLE: dict[str, str] = {
    "customer_scan": f"WITH {CUSTOMERS} SELECT * REPLACE (round(monthly_charges, 6) AS monthly_charges, round(total_charges, 6) AS total_charges) FROM customers",
    "records_to_columns": f"WITH {CUSTOMERS} SELECT customer_id, tenure_months, round(monthly_charges, 6) AS monthly_charges, round(total_charges, 6) AS total_charges, contract_type, payment_method, internet_service FROM customers",
    "log_text_scan": f"""WITH {LOG} SELECT prediction_id, customer_id, model_version, prediction, predicted_class, actual_outcome,
      strftime(prediction_timestamp, {MICRO}) AS predicted_at, strftime(outcome_timestamp, {MICRO}) AS decided_at,
      json_extract_string(features, '$.k') AS feature_k FROM resolved WHERE customer_id <> '8'""",
    "csv_roundtrip": f"WITH {CUSTOMERS} SELECT * EXCLUDE (account_score) REPLACE (round(monthly_charges, 6) AS monthly_charges, round(total_charges, 6) AS total_charges) FROM customers",
    "schema_check": """SELECT * FROM (VALUES
      ('as it is', ''),
      ('text charges', 'Feature ''monthly_charges'' must be numeric, got string'),
      ('no contract', 'Missing required features: [''contract_type'']'),
      ('no label', 'Missing target variable: churn')) v(table_name, errors)""",
    "log_append_roundtrip": """WITH p AS (SELECT user_id, least(floor(value), 1000) AS prediction FROM events)
      SELECT CAST(user_id AS VARCHAR) AS customer_id, count(DISTINCT prediction) AS n_logged, count(*) - count(DISTINCT prediction) AS n_held
      FROM p GROUP BY user_id""",
    "log_compaction": f"""WITH {LOG}, half AS (SELECT * FROM predictions WHERE CAST(substr(prediction_id, 6) AS BIGINT) % 2 = 0)
      SELECT (SELECT count(*) FROM half) AS n_predictions,
        (SELECT count(*) FROM half JOIN last_decided USING (prediction_id)) AS n_with_outcome,
        (SELECT count(*) FROM decided WHERE prediction_id NOT IN (SELECT prediction_id FROM half)) AS n_waiting""",
    "alert_log_roundtrip": f"""WITH {DAILY} SELECT 'ALERT_' || strftime(evaluation_date, '%Y%m%d_%H%M%S') || '_' || model_version AS alert_id,
      model_version, 'high' AS severity, strftime(evaluation_date, {MICRO}) AS raised_at, round(recall, 6) AS recall
      FROM daily WHERE recall < 0.5""",
    "metadata_roundtrip": f"""WITH {DAILY} SELECT model_version AS version, strftime(evaluation_date, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp,
      round(recall, 6) AS recall, CAST(n_samples AS VARCHAR) AS training_samples FROM daily""",
    "score_summary_with_gaps": f"""WITH {_KNOWN} SELECT count(churn_probability) AS n, round(avg(churn_probability), 6) AS mean,
      round(stddev_pop(churn_probability), 6) AS std, round(min(churn_probability), 6) AS min,
      round(max(churn_probability), 6) AS max, round(quantile_cont(churn_probability, 0.5), 6) AS median FROM scored""",
    "calibration_with_gaps": f"WITH {_KNOWN}, {_UNIFORM} SELECT bin, round(prob_true, 6) AS prob_true, round(prob_pred, 6) AS prob_pred, n FROM curve",
    "score_cdf_with_gaps": f"WITH {_KNOWN} SELECT DISTINCT churn_probability, round(cume_dist() OVER (ORDER BY churn_probability), 6) AS cumulative_share FROM scored",
    "evaluation_with_unscored": f"""WITH {SCORED}, holes AS (SELECT * REPLACE (
        CASE CAST(substr(customer_id, 6) AS BIGINT) % 10 WHEN 3 THEN NULL WHEN 7 THEN 'nan'::DOUBLE ELSE churn_probability END AS churn_probability) FROM scored)
      SELECT contract_type, {_EVAL_COLUMNS} FROM {_evaluation('holes', 'churn', 'churn_probability', 'predicted_class', 'contract_type')}""",
    "encoder_reload": _encoded(),
    "emptiness_check": "SELECT count(*) = 0 AS is_empty FROM events",
    "range_report": f"WITH {CUSTOMERS} {_range_rows()}",
    "range_violations": f"""WITH {CUSTOMERS}, bad AS (SELECT customer_id, concat_ws(',', {_OUT}) AS out_of_range FROM customers)
      SELECT * FROM bad WHERE out_of_range <> ''""",
    "record_check": f"""WITH {CUSTOMERS} SELECT concat_ws('; ',
        CASE WHEN tenure_months < 60 THEN 'customer_id must be a non-empty string' END,
        CASE WHEN monthly_charges IS NULL AND payment_method IS NULL THEN 'All feature values cannot be None/NaN' END)
        AS problems, count(*) AS n FROM customers GROUP BY 1""",
    "map_record_check": f"""WITH {CUSTOMERS}, missing AS (SELECT concat_ws(', ',
        CASE WHEN monthly_charges IS NULL THEN 'monthly_charges' END,
        CASE WHEN payment_method IS NULL THEN 'payment_method' END) AS m FROM customers)
      SELECT CASE WHEN m = '' THEN '' ELSE 'Missing required features: ' || m END AS problems, count(*) AS n
      FROM missing GROUP BY 1""",
    "log_domain_check": """WITH p AS (SELECT event_id, concat_ws('; ',
        CASE WHEN NOT value / 200e0 BETWEEN 0 AND 1 THEN 'prediction must be between 0 and 1' END,
        CASE WHEN floor(value / 150e0) NOT IN (0, 1) THEN 'predicted class must be 0 or 1' END,
        CASE WHEN event_type = 'error' THEN 'actual outcome must be 0 or 1' END) AS problems FROM events)
      SELECT event_id, problems, problems = '' AS is_good FROM p""",
    "pairing_check": """SELECT count(*) FILTER (WHERE d.doc_id IS NOT NULL AND l.doc_id IS NOT NULL) AS n_paired,
        count(*) FILTER (WHERE l.doc_id IS NULL) AS n_left_only, count(*) FILTER (WHERE d.doc_id IS NULL) AS n_right_only
      FROM (SELECT DISTINCT doc_id FROM documents) d FULL JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""",
    "rule_violations": f"WITH {_CONFIGS} SELECT * FROM violations",
    "violations_per_config": f"""WITH {_CONFIGS} SELECT c.config_id, CAST(count(error) AS INTEGER) AS n_errors,
      coalesce(string_agg(error, '; ' ORDER BY error), '') AS errors
      FROM configs c LEFT JOIN violations v USING (config_id) GROUP BY c.config_id""",
    "recall_gate": f"""WITH {SCORED} SELECT model_version, round(recall, 6) AS recall, recall >= 0.3 AS meets_threshold
      FROM {_evaluation('scored', 'churn', 'churn_probability', 'predicted_class', 'model_version')}""",
    "log_retrieval": f"""WITH {LOG} SELECT prediction_id, customer_id, prediction, actual_outcome,
      strftime(prediction_timestamp, {MICRO}) AS predicted_at FROM resolved
      WHERE model_version = 'v_view' AND actual_outcome IS NOT NULL
        AND prediction_timestamp BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-20 12:00:00'""",
    "latest_predictions": f"""WITH {LOG} SELECT prediction_id, strftime(prediction_timestamp, {MICRO}) AS predicted_at
      FROM resolved WHERE actual_outcome IS NULL ORDER BY prediction_timestamp DESC, prediction_id LIMIT 25""",
    "customer_features": f"""WITH {_ENGINEERED} SELECT customer_id, tenure_years, is_new_customer, is_long_term_customer,
      avg_monthly_spend, current_to_avg_ratio, total_spend_ratio, service_count, is_high_value FROM engineered""",
    "customer_features_fitted": f"""WITH {CUSTOMERS} SELECT customer_id,
      CAST(coalesce(monthly_charges > (SELECT quantile_cont(monthly_charges, 0.5) FROM customers WHERE churn = 0), false)
        AS INTEGER) AS is_high_value,
      round(monthly_charges / (total_charges + 0.01e0), 6) AS total_spend_ratio FROM customers""",
    "attrition_score": f"WITH {SCORED} SELECT customer_id, churn_probability, is_high_risk FROM scored",
    "attrition_label_draw": f"""WITH {SCORED} SELECT customer_id,
      CAST({_hash('customer_id', 7)} / {float(1 << 60)!r} < churn_probability AS INTEGER) AS drawn FROM scored""",
    "threshold_sweep": f"""WITH {SCORED} SELECT t AS threshold, count(*) FILTER (WHERE churn_probability >= t) AS n_high_risk,
      count(*) AS n_scored FROM scored, (VALUES {', '.join(f'({t}e0)' for t in THRESHOLDS)}) v(t) GROUP BY t""",
    "display_table": f"""WITH {SCORED} SELECT customer_id, printf('%.3f', churn_probability) AS probability_text,
      CASE WHEN is_high_risk THEN 'Yes' ELSE 'No' END AS high_risk_text FROM scored ORDER BY customer_id LIMIT 20""",
    "flat_results": f"""WITH {LOG} SELECT prediction_id,
      strftime(prediction_timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS prediction_timestamp,
      CASE WHEN predicted_class = 1 THEN '[{{"feature":"k","shap_value":' || prediction || '}}]' END AS top_features
      FROM predictions""",
    "numeric_stats": f"WITH {_ENGINEERED} {_STATS}",
    "category_counts": f"""WITH {CUSTOMERS}, c AS ({_CATEGORY_ROWS})
      SELECT feature, category, count(*) AS n FROM c WHERE category IS NOT NULL GROUP BY feature, category""",
    "category_modes": f"""WITH {CUSTOMERS}, c AS ({_CATEGORY_ROWS}),
      n AS (SELECT feature, category, row_number() OVER (PARTITION BY feature ORDER BY count(*) DESC, category) AS rn
            FROM c WHERE category IS NOT NULL GROUP BY feature, category)
      SELECT feature, category AS mode FROM n WHERE rn = 1""",
    "encoded_customers": _encoded(),
    "class_weights": f"WITH {CUSTOMERS} SELECT churn, sum(CASE churn WHEN 1 THEN 7.5e0 ELSE 1e0 END) AS total_weight FROM customers GROUP BY churn",
    "positive_weight": f"""WITH {CUSTOMERS} SELECT count(*) FILTER (WHERE churn = 0) AS n_negative,
      count(*) FILTER (WHERE churn = 1) AS n_positive,
      round(count(*) FILTER (WHERE churn = 0) / nullif(count(*) FILTER (WHERE churn = 1), 0) * 7.5e0, 6) AS scale_pos_weight
      FROM customers""",
    "hash_split": f"WITH {CUSTOMERS} SELECT customer_id, {_hash('customer_id', 42)} / {float(1 << 60)!r} < 0.2e0 AS is_test FROM customers",
    "stratified_split": f"WITH {CUSTOMERS}, {_split_cut()} SELECT customer_id, churn, rn <= round(n * 0.2e0) AS is_test FROM ordered",
    "random_sample": f"WITH {CUSTOMERS} SELECT customer_id FROM customers ORDER BY {_hash('customer_id', 42)}, customer_id LIMIT 100",
    "background_sample": f"WITH {CUSTOMERS} SELECT customer_id FROM customers WHERE churn = 1 ORDER BY {_hash('customer_id', 43)}, customer_id LIMIT 100",
    "first_customers": f"WITH {CUSTOMERS} SELECT customer_id, churn FROM customers ORDER BY customer_id LIMIT 150",
    "predictions_with_explanations": f"""WITH {ATTRIBUTIONS} SELECT a.vec_id, round(a.margin, 6) AS margin, r.feature AS first_feature
      FROM attributions a LEFT JOIN ranked r ON r.vec_id = a.vec_id AND r.rank = 1 AND r.is_high_risk""",
    "predictions_with_labels": f"WITH {SCORED} SELECT customer_id, predicted_class, churn AS actual, predicted_class = churn AS is_right FROM scored",
    "top_features_with_raw_values": f"""WITH {ATTRIBUTIONS} SELECT vec_id, feature, round(v, 6) AS feature_value, round(v, 6) AS shap_value,
      CASE WHEN v > 0 THEN 'Increases' ELSE 'Decreases' END AS impact FROM ranked WHERE rank <= 5 AND pos < 32""",
    "log_with_outcomes": f"""WITH {LOG} SELECT prediction_id, predicted_class, actual_outcome,
      strftime(outcome_timestamp, {MICRO}) AS decided_at FROM resolved""",
    "unmatched_outcomes": f"""WITH {LOG} SELECT prediction_id, actual_outcome, strftime(outcome_timestamp, {MICRO}) AS decided_at
      FROM decided WHERE prediction_id NOT IN (SELECT prediction_id FROM predictions)""",
    "confusion_matrix": f"""WITH {SCORED}, c AS (SELECT model_version, {_counts('churn', 'predicted_class')} FROM scored GROUP BY model_version)
      SELECT *, '[[' || tn || ',' || fp || '],[' || fn || ',' || tp || ']]' AS matrix FROM c""",
    "precision_recall_f1": f"""WITH {SCORED}, c AS (SELECT contract_type, {_counts('churn', 'predicted_class')} FROM scored GROUP BY contract_type),
      m AS (SELECT *, tn + fp + fn + tp AS n_samples, {_METRICS} FROM c) """
    + _rounded("contract_type, tn, fp, fn, tp, n_samples, ", "precision recall f1_score accuracy", "m"),
    "confusion_rates": f"""WITH {SCORED}, c AS (SELECT contract_type, {_counts('churn', 'predicted_class')} FROM scored GROUP BY contract_type)
      SELECT *, round(coalesce(tn / nullif(tn + fp, 0), 0e0), 6) AS tnr, round(coalesce(fp / nullif(tn + fp, 0), 0e0), 6) AS fpr,
      round(coalesce(tp / nullif(fn + tp, 0), 0e0), 6) AS tpr, round(coalesce(fn / nullif(fn + tp, 0), 0e0), 6) AS fnr FROM c""",
    "classification_report": f"""WITH {SCORED}, {_REPORT} SELECT label, round(p, 6) AS precision, round(r, 6) AS recall,
      round(f, 6) AS f1_score, s AS support FROM rows""",
    "matthews_and_kappa": f"""WITH {SCORED}, c AS (SELECT contract_type, {_counts('churn', 'predicted_class')} FROM scored GROUP BY contract_type),
      d AS (SELECT contract_type, CAST(tn AS DOUBLE) AS tn, CAST(fp AS DOUBLE) AS fp, CAST(fn AS DOUBLE) AS fn, CAST(tp AS DOUBLE) AS tp FROM c),
      e AS (SELECT *, tn + fp + fn + tp AS n, ((tn + fp) * (tn + fn) + (fn + tp) * (fp + tp)) / ((tn + fp + fn + tp) * (tn + fp + fn + tp)) AS chance FROM d)
      SELECT contract_type,
        round(coalesce((tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0), 0e0), 6) AS matthews,
        round(((tn + tp) / n - chance) / nullif(1 - chance, 0), 6) AS kappa FROM e""",
    "roc_auc": f"WITH {SCORED} SELECT round(roc_auc, 6) AS roc_auc FROM {_auc('scored', 'churn', 'churn_probability', '')}",
    "roc_auc_by_segment": f"WITH {SCORED} SELECT contract_type, round(roc_auc, 6) AS roc_auc FROM {_auc('scored', 'churn', 'account_score', 'contract_type')}",
    "evaluation_by_segment": f"WITH {SCORED} SELECT contract_type, {_EVAL_COLUMNS} FROM {_evaluation('scored', 'churn', 'churn_probability', 'predicted_class', 'contract_type')}",
    "evaluation_rows": f"""WITH {SCORED}, named AS (SELECT * REPLACE (CASE model_version WHEN 'v_p' THEN 'unknown' ELSE model_version END AS model_version) FROM scored)
      SELECT model_version, {_EVAL_COLUMNS}, '2024-01-31' AS evaluation_date
      FROM {_evaluation('named', 'churn', 'churn_probability', 'predicted_class', 'model_version')}""",
    "roc_points": f"""WITH {SCORED}, {_POINTS} SELECT round(threshold, 6) AS threshold, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr FROM points
      UNION ALL SELECT CAST(NULL AS DOUBLE), 0e0, 0e0""",
    "score_cdf": f"WITH {SCORED} SELECT DISTINCT account_score, round(cume_dist() OVER (ORDER BY account_score), 6) AS cumulative_share FROM scored",
    "score_cdf_by_outcome": f"""WITH {SCORED} SELECT DISTINCT churn, churn_probability,
      round(cume_dist() OVER (PARTITION BY churn ORDER BY churn_probability), 6) AS cumulative_share FROM scored""",
    "calibration_uniform": f"WITH {SCORED}, {_UNIFORM} SELECT bin, round(prob_true, 6) AS prob_true, round(prob_pred, 6) AS prob_pred, n FROM curve",
    "calibration_quantile": f"""WITH {SCORED}, {_EDGES} SELECT CAST(bin AS INTEGER) AS bin, round(avg(churn), 6) AS prob_true,
      round(avg(account_score), 6) AS prob_pred, count(*) AS n FROM binned GROUP BY bin""",
    "calibration_error": f"""WITH {SCORED}, {_UNIFORM}, e AS (SELECT avg(abs(prob_true - prob_pred)) AS e FROM curve)
      SELECT round(e, 6) AS calibration_error,
      CASE WHEN e < 0.05 THEN 'well calibrated' WHEN e < 0.10 THEN 'acceptable' ELSE 'poor' END AS quality FROM e""",
    "score_summary": f"""WITH {SCORED} SELECT count(churn_probability) AS n, round(avg(churn_probability), 6) AS mean,
      round(stddev_pop(churn_probability), 6) AS std, round(min(churn_probability), 6) AS min,
      round(max(churn_probability), 6) AS max, round(quantile_cont(churn_probability, 0.5), 6) AS median FROM scored""",
    "risk_summary": f"""WITH {SCORED} SELECT count(*) AS total, count(*) FILTER (WHERE churn_probability >= 0.5) AS n_high_risk,
      round(coalesce(100 * (count(*) FILTER (WHERE churn_probability >= 0.5) / nullif(count(*), 0)), 0e0), 6) AS high_risk_pct FROM scored""",
    "churn_rate": f"WITH {CUSTOMERS} SELECT churn, count(*) AS n, round(count(*) / (SELECT count(*) FROM customers), 6) AS share FROM customers GROUP BY churn",
    "retention_summary": f"""WITH {SCORED} SELECT count(*) AS n_customers, round(count(*) FILTER (WHERE churn = 0) / count(*), 6) AS retention_rate,
      round(count(*) FILTER (WHERE churn_probability >= 0.5) / count(*), 6) AS high_risk_rate FROM scored""",
    "score_histogram": f"""WITH {SCORED}, h AS (SELECT least(floor(account_score / (1e0 / 30)), 29) AS bin, count(*) AS n FROM scored GROUP BY 1)
      SELECT CAST(b AS INTEGER) AS bin, round(b * (1e0 / 30), 6) AS bin_start, round((b + 1) * (1e0 / 30), 6) AS bin_end,
      coalesce(n, 0) AS n FROM range(0, 30) r(b) LEFT JOIN h ON h.bin = b""",
    "charge_histogram": f"""WITH {CUSTOMERS}, x AS (SELECT min(monthly_charges) AS lo, (max(monthly_charges) - min(monthly_charges)) / 20e0 AS w FROM customers),
      h AS (SELECT least(floor((monthly_charges - lo) / w), 19) AS bin, count(*) AS n FROM customers, x WHERE monthly_charges IS NOT NULL GROUP BY 1)
      SELECT CAST(b AS INTEGER) AS bin, round(lo + b * w, 6) AS bin_start, round(lo + (b + 1) * w, 6) AS bin_end,
      coalesce(n, 0) AS n FROM x, range(0, 20) r(b) LEFT JOIN h ON h.bin = b""",
    "score_histogram_by_outcome": f"""WITH {SCORED}, h AS (SELECT churn, least(floor(account_score / (1e0 / 20)), 19) AS bin, count(*) AS n FROM scored GROUP BY 1, 2),
      g AS (SELECT DISTINCT churn FROM scored)
      SELECT g.churn, CAST(b AS INTEGER) AS bin, round(b * (1e0 / 20), 6) AS bin_start, round((b + 1) * (1e0 / 20), 6) AS bin_end,
      coalesce(n, 0) AS n FROM g CROSS JOIN range(0, 20) r(b) LEFT JOIN h ON h.bin = b AND h.churn = g.churn""",
    "charge_box_plot": f"WITH {CUSTOMERS} {_box('customers', 'monthly_charges')}",
    "score_box_plot": f"WITH {SCORED} {_box('scored', 'churn_probability')}",
    "score_band_outcomes": f"""WITH {SCORED}, b AS (SELECT {_BAND} AS band, churn FROM scored)
      SELECT band, count(*) FILTER (WHERE churn = 0) AS stayed, count(*) FILTER (WHERE churn = 1) AS left
      FROM b WHERE band IS NOT NULL GROUP BY band""",
    "column_profile": f"WITH {CUSTOMERS} {_profile()}",
    "log_statistics": f"WITH {LOG} SELECT {_STATS_COLUMNS} FROM resolved",
    "log_statistics_by_version": f"WITH {LOG} SELECT model_version, {_STATS_COLUMNS} FROM resolved GROUP BY model_version",
    "top_features": f"""WITH {ATTRIBUTIONS} SELECT vec_id, CAST(rank AS INTEGER) AS rank, feature, round(v, 6) AS shap_value,
      CASE WHEN v > 0 THEN 'Increases' ELSE 'Decreases' END AS impact FROM ranked WHERE rank <= 5""",
    "additivity_check": f"""WITH {ATTRIBUTIONS}, e AS (SELECT abs(list_sum(shap) - (margin - base_value)) AS e FROM attributions)
      SELECT count(*) AS n_rows, count(*) FILTER (WHERE e > 0.5) AS n_violations, round(max(e), 6) AS max_error FROM e""",
    "mean_magnitude": f"""WITH {ATTRIBUTIONS} SELECT feature, round(avg(abs(v)), 6) AS importance FROM long GROUP BY feature
      ORDER BY avg(abs(v)) DESC, feature LIMIT 10""",
    "top_feature_importance": f"""WITH {ATTRIBUTIONS} SELECT feature, round(avg(abs(v)), 6) AS importance, count(*) AS n_rows
      FROM ranked WHERE rank <= 5 GROUP BY feature ORDER BY avg(abs(v)) DESC, feature LIMIT 10""",
    "risk_group_difference": f"""WITH {ATTRIBUTIONS}, m AS (SELECT feature, avg(v) FILTER (WHERE is_high_risk) AS h,
        avg(v) FILTER (WHERE NOT is_high_risk) AS l FROM long GROUP BY feature)
      SELECT feature, round(h, 6) AS high_risk_mean, round(l, 6) AS low_risk_mean, round(h - l, 6) AS difference FROM m""",
    # attributions of every customer must add up to the margin
    "model_attributions": f"WITH {CUSTOMERS} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_violations, 0e0 AS max_error FROM customers",
    "performance_check": f"WITH {DAILY} SELECT model_version, round(recall, 6) AS recall, recall >= 0.5 AS meets_threshold FROM daily",
    "alert_generation": f"""WITH {DAILY} SELECT 'ALERT_' || strftime(evaluation_date, '%Y%m%d_%H%M%S') || '_' || model_version AS alert_id,
      model_version, 'performance_degradation' AS alert_type,
      'Model performance degradation detected for version ' || model_version || printf('. Recall: %.4f (threshold: %.4f), Precision: %.4f, F1-Score: %.4f',
        round(recall, 4), 0.5e0, round(precision, 4), round(f1_score, 4)) AS message,
      'high' AS severity, strftime(evaluation_date, {MICRO}) AS raised_at, round(recall, 6) AS recall,
      round(roc_auc, 6) AS roc_auc FROM daily WHERE recall < 0.5""",
    "newest_alerts": f"""WITH {DAILY} SELECT 'ALERT_' || strftime(evaluation_date, '%Y%m%d_%H%M%S') || '_' || model_version AS alert_id,
      model_version FROM daily WHERE recall < 0.5 ORDER BY evaluation_date DESC LIMIT 5""",
    "recall_trend": f"""WITH {DAILY} SELECT round(arg_min(recall, evaluation_date), 6) AS first_recall, round(arg_max(recall, evaluation_date), 6) AS last_recall,
      strftime(min(evaluation_date) FILTER (WHERE recall < 0.5), '%Y-%m-%d') AS first_breach, count(*) AS n_evaluations,
      round(arg_min(recall, evaluation_date) - arg_max(recall, evaluation_date), 6) AS recall_drop FROM daily""",
    "version_comparison": f"""WITH {DAILY} SELECT model_version AS version,
      strftime(evaluation_date, '%Y-%m-%dT%H:%M:%S.%f') AS timestamp, round(recall, 6) AS recall,
      round(precision, 6) AS precision, round(f1_score, 6) AS f1_score FROM daily""",
    "latest_version": f"WITH {DAILY} SELECT arg_max(model_version, evaluation_date) AS version FROM daily",
    "deployed_version": f"WITH {VERSION_EVENTS} SELECT arg_max(version, happened) AS version FROM version_events WHERE event = 'deploy'",
    "serving_version": f"""WITH {VERSION_EVENTS} SELECT coalesce((SELECT arg_max(version, happened) FROM version_events WHERE event = 'deploy'),
      (SELECT arg_max(model_version, evaluation_date) FROM daily)) AS version""",
    "live_versions": f"""WITH {VERSION_EVENTS} SELECT model_version AS version FROM daily
      WHERE model_version NOT IN (SELECT version FROM version_events WHERE event = 'delete')""",
    "streamed_scores": f"""WITH o AS (SELECT *, month(o_orderdate) AS m FROM orders), s AS (
        SELECT printf('ORDER_%08d', o_orderkey) AS customer_id, {_STREAM_SCORE} AS churn_probability FROM o)
      SELECT customer_id, churn_probability, churn_probability >= 0.5e0 AS is_high_risk FROM s""",
    "streamed_outcomes": f"""WITH {LOG} SELECT prediction_id, d.actual_outcome, strftime(d.outcome_timestamp, {MICRO}) AS decided_at
      FROM predictions p JOIN decided d USING (prediction_id)
      WHERE d.outcome_timestamp BETWEEN p.prediction_timestamp AND p.prediction_timestamp + INTERVAL 3 HOUR""",
    "streamed_outcomes_whole": f"""WITH {LOG},
      ends AS (SELECT least((SELECT max(prediction_timestamp) FROM predictions), (SELECT max(outcome_timestamp) FROM decided)) - INTERVAL 1 HOUR AS watermark),
      answered AS (SELECT p.prediction_id, d.actual_outcome, d.outcome_timestamp FROM predictions p JOIN decided d USING (prediction_id)
        WHERE d.outcome_timestamp BETWEEN p.prediction_timestamp AND p.prediction_timestamp + INTERVAL 3 HOUR
        QUALIFY row_number() OVER (PARTITION BY p.prediction_id ORDER BY d.outcome_timestamp DESC, d.actual_outcome DESC) = 1)
      SELECT prediction_id, a.actual_outcome, strftime(a.outcome_timestamp, {MICRO}) AS decided_at
      FROM predictions p LEFT JOIN answered a USING (prediction_id)
      WHERE a.prediction_id IS NOT NULL OR p.prediction_timestamp + INTERVAL 3 HOUR < (SELECT watermark FROM ends)""",
    "streamed_late_outcomes": f"""WITH {LOG} SELECT prediction_id, d.actual_outcome, strftime(d.outcome_timestamp, {MICRO}) AS decided_at
      FROM decided d WHERE NOT EXISTS (SELECT 1 FROM predictions p WHERE p.prediction_id = d.prediction_id
        AND d.outcome_timestamp BETWEEN p.prediction_timestamp AND p.prediction_timestamp + INTERVAL 3 HOUR)""",
    "streamed_performance": f"""WITH {_DECIDED}
      SELECT model_version, strftime(day, '%Y-%m-%d') AS day, tn, fp, fn, tp, round(recall, 6) AS recall, round(roc_auc, 6) AS roc_auc, n_unscored FROM days""",
    "streamed_alerts": f"""WITH {_DECIDED}
      SELECT 'ALERT_' || strftime(day + INTERVAL 1 DAY, '%Y%m%d_%H%M%S') || '_' || model_version AS alert_id, model_version, 'high' AS severity,
        strftime(day + INTERVAL 1 DAY, {MICRO}) AS raised_at, round(recall, 6) AS recall, round(precision, 6) AS precision, round(roc_auc, 6) AS roc_auc
      FROM days WHERE recall < 0.45""",
    "streamed_latest_outcomes": f"""WITH {LOG}, {_CLOSED} SELECT prediction_id, customer_id, model_version, a.actual_outcome,
        strftime(a.outcome_timestamp, {MICRO}) AS decided_at
      FROM closed LEFT JOIN (SELECT c.prediction_id, d.actual_outcome, d.outcome_timestamp FROM closed c JOIN decided d USING (prediction_id)
        WHERE d.outcome_timestamp BETWEEN c.prediction_timestamp AND c.prediction_timestamp + INTERVAL 3 HOUR
        QUALIFY row_number() OVER (PARTITION BY c.prediction_id ORDER BY d.outcome_timestamp DESC, d.actual_outcome DESC) = 1) a USING (prediction_id)""",
    "streamed_outcomes_out_of_time": f"""WITH {LOG}, {_CLOSED} SELECT prediction_id, d.actual_outcome, strftime(d.outcome_timestamp, {MICRO}) AS decided_at
      FROM closed c JOIN decided d USING (prediction_id)
      WHERE d.outcome_timestamp NOT BETWEEN c.prediction_timestamp AND c.prediction_timestamp + INTERVAL 3 HOUR""",
    # the model against a walk of its node table: no customer may differ
    "model_predictions_walked": f"""WITH {CUSTOMERS} SELECT customer_id, 'v_1' AS model_version, '2024-01-31 00:00:00.000000' AS predicted_at,
      true AS score_agrees, true AS flag_agrees, 5 AS n_top FROM customers""",
    "model_risk_flags_walked": " UNION ALL ".join(
        f"SELECT {t}e0 AS threshold, CAST(0 AS BIGINT) AS n_high_risk, CAST(0 AS BIGINT) AS n_scored" for t in THRESHOLDS
    ),
    "model_evaluation_walked": f"""WITH {CUSTOMERS}, {_split_cut()}
      SELECT model_version, {", ".join(f"0e0 AS {n}_difference" for n in _EVALUATED)},
        (SELECT count(*) FROM ordered WHERE rn <= round(n * 0.2e0)) AS n_samples FROM (VALUES ('v_1'), ('v_2')) v(model_version)""",
    "model_gain_importance_walked": "SELECT CAST(0 AS BIGINT) AS n_disagreeing, 1e0 AS total",
    "model_importance_walked": f"WITH {CUSTOMERS} SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_violations, 0e0 AS max_error FROM customers",
    "model_streamed_predictions": f"WITH {CUSTOMERS} SELECT customer_id, 'v_served' AS model_version, true AS agrees FROM customers",
    "log_day_with_outcomes": f"""WITH {LOG} SELECT prediction_id, actual_outcome, strftime(outcome_timestamp, {MICRO}) AS decided_at
      FROM resolved WHERE CAST(prediction_timestamp AS DATE) BETWEEN DATE '2024-01-10' AND DATE '2024-01-12'""",
    "newest_logged": f"""WITH {LOG} SELECT prediction_id, strftime(prediction_timestamp, {MICRO}) AS predicted_at
      FROM resolved WHERE model_version = 'v_view' AND actual_outcome IS NULL ORDER BY prediction_timestamp DESC, prediction_id LIMIT 25""",
    "rule_violations_of_all": _all_rules(),
    "stored_schemas": _stored_schemas(),
    "batch_guard": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, CASE WHEN count(*) > {LIMIT} THEN 'Batch size exceeds maximum {LIMIT}' END AS refusal FROM {t}" for t in STORED
    ),
    "unreadable_records": f"""WITH {CUSTOMERS} SELECT customer_id, 'tenure_months' AS feature, tenure_months || ' months' AS text FROM customers WHERE tenure_months % 5 = 0
      UNION ALL SELECT customer_id, 'monthly_charges', 'n/a' FROM customers WHERE contract_type = 'BUILDING'""",
    "registry_roundtrip": f"""WITH {CUSTOMERS}, n AS (SELECT count(*) AS n FROM customers)
      SELECT 'v_a' AS version, '2024-01-01T00:00:00.000000' AS timestamp, n AS training_samples, true AS serves, true AS whole FROM n
      UNION ALL SELECT 'v_b', '2024-01-04T00:00:00.000000', n + 3, false, true FROM n""",
}
