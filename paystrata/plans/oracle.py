"""DuckDB statements that give the same results as the registered queries.

They are written from the fixture's definition and each operator's meaning, with
plain windows and aggregates, and share no plan with the Spark side.
"""

from __future__ import annotations

from paystrata import dimensions as dims
from paystrata.operators.rules import BRONZE_SUITE
from paystrata.plans.queries import LOGICAL_DATE
from paystrata.schema import TRANSACTION_COLUMNS

_DIALECT = {"STRING": "VARCHAR", "INT": "INTEGER", "ARRAY<STRING>": "VARCHAR[]"}

COLUMNS = ", ".join(TRANSACTION_COLUMNS)

# The fixture: events seen as transactions.
TXNS = """
raw AS (
  SELECT event_id, ts, user_id AS u, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
         CASE WHEN event_id % 20 = 0 THEN 1 + (event_id // 20) % 7 ELSE 0 END AS days_late
  FROM events
),
txns AS (
  SELECT event_id,
    'TXN-' || lpad(printf('%X', event_id), 12, '0') AS txn_id,
    strftime(ts - to_days(CAST(days_late AS INTEGER)), '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS txn_timestamp,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS arrival_timestamp,
    value AS amount,
    'INR' AS currency,
    CASE WHEN event_type = 'error' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
    CASE WHEN event_type = 'error' THEN
      CASE event_id % 3 WHEN 0 THEN 'INSUFFICIENT_FUNDS' WHEN 1 THEN 'TIMEOUT' ELSE 'BANK_DECLINED' END
    END AS failure_reason,
    'USR-' || lpad(CAST(u AS VARCHAR), 6, '0') AS user_id,
    CASE u % 4 WHEN 0 THEN 'premium' WHEN 1 THEN 'regular' WHEN 2 THEN 'new' ELSE 'dormant' END AS user_segment,
    'MRC-' || lpad(CAST(k AS VARCHAR), 6, '0') AS merchant_id,
    CASE k % 8 WHEN 0 THEN 'food_delivery' WHEN 1 THEN 'ecommerce' WHEN 2 THEN 'utilities'
      WHEN 3 THEN 'entertainment' WHEN 4 THEN 'travel' WHEN 5 THEN 'grocery'
      WHEN 6 THEN 'healthcare' ELSE 'fuel' END AS merchant_category,
    CASE k % 4 WHEN 0 THEN 'GW-001' WHEN 1 THEN 'GW-002' WHEN 2 THEN 'GW-003' ELSE 'GW-004' END AS gateway_id,
    CASE k % 4 WHEN 0 THEN 'Razorpay' WHEN 1 THEN 'PayU' WHEN 2 THEN 'Cashfree' ELSE 'Unknown' END AS gateway_name,
    CASE WHEN event_id % 25 = 0 THEN 'PRC-003' ELSE
      CASE event_id % 4 WHEN 0 THEN 'PRC-001' WHEN 1 THEN 'PRC-002' WHEN 2 THEN 'PRC-004' ELSE 'PRC-001' END
    END AS processor_id,
    CASE WHEN event_id % 25 = 0 THEN 'Mastercard' ELSE
      CASE event_id % 4 WHEN 0 THEN 'NPCI' WHEN 1 THEN 'Visa' WHEN 2 THEN 'RBI_NEFT' ELSE 'NPCI' END
    END AS processor_name,
    CASE event_id % 4 WHEN 0 THEN 'UPI' WHEN 1 THEN 'CARD' WHEN 2 THEN 'NETBANKING' ELSE 'WALLET' END AS payment_method,
    CASE event_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
    CASE u % 2 WHEN 0 THEN 'Mumbai' ELSE 'Delhi' END AS location_city,
    CASE u % 2 WHEN 0 THEN 'Maharashtra' ELSE 'Delhi' END AS location_state,
    false AS is_international
  FROM raw
)"""

ARRIVAL_PARTS = """
    CAST(year(arrived) AS INTEGER) AS arrival_year, CAST(month(arrived) AS INTEGER) AS arrival_month,
    CAST(day(arrived) AS INTEGER) AS arrival_day, CAST(hour(arrived) AS INTEGER) AS arrival_hour"""

BRONZE = f"""{TXNS},
bronze AS (
  SELECT *, {ARRIVAL_PARTS}
  FROM (SELECT *, try_strptime(arrival_timestamp, '%Y-%m-%dT%H:%M:%S.%gZ') AS arrived FROM txns)
)"""

DOUBLED = f"""{TXNS},
doubled AS (SELECT * FROM txns UNION ALL SELECT * FROM txns WHERE event_id % 100 = 0)"""

_ODD = "CAST(arrival_timestamp[10:10] AS INTEGER) % 2 = 1"
MENDED = f"""{BRONZE},
mended AS (
  SELECT * REPLACE (CASE WHEN {_ODD} AND gateway_id = 'GW-004' THEN 'GW-001' ELSE gateway_id END AS gateway_id,
    CASE WHEN {_ODD} THEN greatest(amount, 1.0) ELSE amount END AS amount) FROM bronze
)"""

FAILED = "status = 'FAILED'"
LATE = "CAST(txn_timestamp[1:10] AS DATE) < CAST(arrival_timestamp[1:10] AS DATE)"
PARTS = "arrival_year, arrival_month, arrival_day, arrival_hour"
DAY = "arrival_year, arrival_month, arrival_day"


def _literal(value) -> str:
    if isinstance(value, tuple):
        return "[" + ", ".join(map(_literal, value)) + "]"
    return f"'{value}'" if isinstance(value, str) else repr(value)


def dimension(dim: dims.Dimension) -> str:
    """The dimension as a CTE named after it."""
    rows = ", ".join(
        "(" + ", ".join([str(place), *map(_literal, row)]) + ")"
        for place, row in enumerate(dim.rows, start=1)
    )
    typed = ", ".join(
        f"CAST({name} AS {_DIALECT.get(kind, kind)}) AS {name}" for name, kind in dim.columns
    )
    names = ", ".join(("position", *dim.column_names))
    return f"dim_{dim.name} AS (SELECT position, {typed} FROM (VALUES {rows}) AS t({names}))"


# --- rules ----------------------------------------------------------------------

# What breaks each row rule, by rule id.
BROKEN = {
    1: "txn_id IS NULL",
    3: "NOT regexp_matches(txn_id, '^TXN-[A-Z0-9]{12}$')",
    4: "amount IS NULL",
    5: "amount < 1.0 OR amount > 1000000.0",
    6: "status NOT IN ('SUCCESS', 'FAILED')",
    7: "status IS NULL",
    8: "user_id IS NULL",
    9: r"NOT regexp_matches(user_id, '^USR-\d{6}$')",
    10: "user_segment NOT IN ('premium', 'regular', 'new', 'dormant')",
    11: "merchant_id IS NULL",
    12: r"NOT regexp_matches(merchant_id, '^MRC-\d{6}$')",
    13: "merchant_category NOT IN ('food_delivery', 'ecommerce', 'utilities', 'entertainment',"
    " 'travel', 'grocery', 'healthcare', 'fuel')",
    14: "payment_method NOT IN ('UPI', 'CARD', 'NETBANKING', 'WALLET')",
    15: "txn_timestamp IS NULL",
    16: "arrival_timestamp IS NULL",
    17: "gateway_id IS NULL",
    18: "gateway_id NOT IN ('GW-001', 'GW-002', 'GW-003')",
}
_NOT_NULL_IDS = {1, 4, 7, 8, 11, 15, 16, 17}


def rule_counts(source: str, by: str = "") -> str:
    """CTE ``summary``: one row per rule over ``source``, per group of ``by``."""
    lead = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    parts = []
    for rule in BRONZE_SUITE:
        head = (
            f"SELECT {lead}CAST({rule.rule_id} AS INTEGER) AS rule_id, '{rule.rule_type}' AS rule_type, "
            + (f"'{rule.column}'" if rule.column else "CAST(NULL AS VARCHAR)")
            + f" AS \"column\", '{rule.kwargs}' AS kwargs, "
        )
        if rule.rule_id == 2:
            parts.append(
                f"{head}CAST(sum(n) AS BIGINT) AS element_count, "
                "CAST(coalesce(sum(n) FILTER (WHERE txn_id IS NULL), 0) AS BIGINT) AS missing_count, "
                "CAST(coalesce(sum(n) FILTER (WHERE txn_id IS NOT NULL AND n > 1), 0) AS BIGINT) AS unexpected_count "
                f"FROM (SELECT {lead}txn_id, count(*) AS n FROM {source} GROUP BY {lead}txn_id){group}"
            )
        elif rule.rule_id == 19:
            parts.append(
                f"{head}CAST(NULL AS BIGINT) AS element_count, CAST(NULL AS BIGINT) AS missing_count, "
                f"CAST(NULL AS BIGINT) AS unexpected_count FROM {source}{group}"
                + ("" if by else " LIMIT 1")
            )
        else:
            missing = (
                "CAST(NULL AS BIGINT)"
                if rule.rule_id in _NOT_NULL_IDS
                else f"count(*) FILTER (WHERE {rule.column} IS NULL)"
            )
            parts.append(
                f"{head}count(*) AS element_count, {missing} AS missing_count, "
                f"count(*) FILTER (WHERE {BROKEN[rule.rule_id]}) AS unexpected_count FROM {source}{group}"
            )
    # LIMIT has to stay inside its own branch of the union.
    union = " UNION ALL ".join(f"({part})" for part in parts)
    return f"""counts AS ({union}),
summary AS (
  SELECT *,
    coalesce(unexpected_count = 0, true) AS success,
    round(100.0 * missing_count / element_count, 6) AS missing_percent,
    round(100.0 * unexpected_count / (element_count - coalesce(missing_count, 0)), 6) AS unexpected_percent,
    round(100.0 * unexpected_count / element_count, 6) AS unexpected_percent_total,
    CAST(NULL AS VARCHAR) AS error
  FROM counts
)"""


SUMMARY_COLUMNS = (
    'rule_id, rule_type, "column", kwargs, success, coalesce(element_count, -1) AS element_count, '
    "coalesce(missing_count, -1) AS missing_count, missing_percent, "
    "coalesce(unexpected_count, -1) AS unexpected_count, unexpected_percent, "
    "unexpected_percent_total, error"
)
STATISTICS = """count(*) AS evaluated_expectations,
  count(*) FILTER (WHERE success) AS successful_expectations,
  count(*) FILTER (WHERE NOT success) AS unsuccessful_expectations"""


def _samples() -> str:
    pairs = " UNION ALL ".join(
        f"SELECT CAST({rule.rule_id} AS INTEGER) AS rule_id, CAST({rule.column} AS VARCHAR) AS value "
        f"FROM doubled WHERE {BROKEN[rule.rule_id]}"
        for rule in BRONZE_SUITE
        if rule.rule_id in BROKEN
    )
    repeated = (
        "SELECT CAST(2 AS INTEGER) AS rule_id, txn_id AS value FROM doubled WHERE txn_id IN "
        "(SELECT txn_id FROM doubled GROUP BY txn_id HAVING count(*) > 1)"
    )
    return f"""WITH {DOUBLED},
pairs AS ({pairs} UNION ALL {repeated}),
counted AS (SELECT rule_id, value, count(*) AS n FROM pairs GROUP BY rule_id, value),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY rule_id ORDER BY n DESC, value NULLS FIRST) AS INTEGER) AS place
  FROM counted
)
SELECT rule_id, value, n, place FROM ranked WHERE place <= 20"""


def _gate_report() -> str:
    return f"""WITH {MENDED},
{rule_counts("mended", DAY)}
SELECT strftime(make_date(arrival_year, arrival_month, arrival_day), '%Y-%m-%d') AS logical_date,
  bool_and(success) AS success, {STATISTICS},
  round(100.0 * count(*) FILTER (WHERE success) / count(*), 6) AS success_percent,
  coalesce(string_agg(rule_type, ',' ORDER BY rule_id) FILTER (WHERE NOT success), '') AS failed_types,
  CAST(coalesce(sum(unexpected_count) FILTER (WHERE NOT success), 0) AS BIGINT) AS unexpected_values
FROM summary GROUP BY {DAY}"""


def _schema_rule() -> str:
    """The rule asks for the contract columns in order. The ingest time is stored
    before the partition columns, which a reader appends; the engine rearranges."""
    rule = BRONZE_SUITE[18]
    outcomes = {"as_written": False, "in_contract_order": True, "without_amount": False, "first_two_swapped": False}
    return " UNION ALL ".join(
        f"SELECT '{variant}' AS variant, CAST(19 AS INTEGER) AS rule_id, '{rule.rule_type}' AS rule_type, "
        f"'{rule.kwargs}' AS kwargs, {str(success).lower()} AS success"
        for variant, success in outcomes.items()
    )


# --- envelopes --------------------------------------------------------------------

QUARANTINE = f"""WITH {TXNS}
SELECT txn_id AS message_key,
  CASE event_id % 50 WHEN 0 THEN 'malformed_json' WHEN 1 THEN 'empty_payload' WHEN 2 THEN 'bad_field'
    WHEN 3 THEN 'bad_arrival_time' WHEN 4 THEN 'no_fields' WHEN 7 THEN 'implausible_time' ELSE 'no_id' END AS reason
FROM txns WHERE event_id % 50 < 8"""

CORRUPT_BRONZE = f"""WITH {BRONZE}
SELECT txn_id AS message_key,
  CASE WHEN event_id % 50 = 6 THEN '  ' WHEN event_id % 50 NOT IN (0, 1, 4, 5) THEN txn_id END AS txn_id,
  CASE WHEN event_id % 50 NOT IN (0, 1, 2, 4) THEN amount END AS amount,
  CASE WHEN event_id % 50 NOT IN (0, 1, 4) THEN status END AS status,
  CASE WHEN event_id % 50 NOT IN (0, 1, 3, 4) THEN arrival_day ELSE -1 END AS arrival_day,
  CASE WHEN event_id % 50 NOT IN (0, 1, 3, 4) THEN arrival_hour ELSE -1 END AS arrival_hour
FROM bronze"""

VARIANTS = f"""WITH {TXNS},
spelled AS (
  SELECT event_id,
    CASE event_id % 10
      WHEN 0 THEN arrival_timestamp
      WHEN 1 THEN arrival_timestamp[1:22] || 'Z'
      WHEN 2 THEN arrival_timestamp[1:19] || 'Z'
      WHEN 3 THEN arrival_timestamp[1:23] || '000Z'
      WHEN 4 THEN arrival_timestamp[1:23] || '+05:30'
      WHEN 5 THEN '2024-1-' || arrival_timestamp[9:24]
      WHEN 6 THEN arrival_timestamp[1:11] || '24:00:00.000Z'
      WHEN 7 THEN '2024-02-30' || arrival_timestamp[11:24]
      WHEN 8 THEN arrival_timestamp || ' '
      ELSE '' END AS variant
  FROM txns
),
parsed AS (
  SELECT event_id, variant,
    CASE WHEN regexp_full_match(variant, '\\d{{4}}-\\d{{2}}-\\d{{2}}T\\d{{2}}:\\d{{2}}:\\d{{2}}\\.\\d{{2,3}}Z')
      THEN try_strptime(variant, '%Y-%m-%dT%H:%M:%S.%gZ') END AS arrived
  FROM spelled
)
SELECT event_id, variant, strftime(arrived, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS parsed,
  CAST(coalesce(year(arrived), -1) AS INTEGER) AS arrival_year,
  CAST(coalesce(month(arrived), -1) AS INTEGER) AS arrival_month,
  CAST(coalesce(day(arrived), -1) AS INTEGER) AS arrival_day,
  CAST(coalesce(hour(arrived), -1) AS INTEGER) AS arrival_hour
FROM parsed"""


# --- rates and shares --------------------------------------------------------------


def rate(part: str, whole: str = "published") -> str:
    return f"CAST((2000 * {part} + {whole}) // (2 * {whole}) AS DOUBLE) / 10.0"


TOTALS = f"""totals AS (
  SELECT count(*) AS published, count(*) FILTER (WHERE {FAILED}) AS failed,
    count(*) FILTER (WHERE {LATE}) AS late
  FROM txns
)"""
RATES = f"""WITH {TXNS}, {TOTALS}
SELECT published, failed, late, {rate('failed')} AS failure_rate, {rate('late')} AS late_rate FROM totals"""

RATES_PER_1000 = f"""WITH {TXNS},
running AS (
  SELECT row_number() OVER (ORDER BY event_id) AS published,
    CAST(count(*) FILTER (WHERE {FAILED}) OVER (ORDER BY event_id) AS BIGINT) AS failed,
    CAST(count(*) FILTER (WHERE {LATE}) OVER (ORDER BY event_id) AS BIGINT) AS late
  FROM txns
)
SELECT published, failed, late, {rate('failed')} AS failure_rate, {rate('late')} AS late_rate
FROM running WHERE published % 1000 = 0"""


def share(value: str, dim: dims.Dimension, key: str, where: str = "true") -> str:
    return f"""WITH {TXNS}, {dimension(dim)},
counts AS (SELECT {value} AS value, count(*) AS n FROM txns WHERE {where} GROUP BY 1),
weights AS (
  SELECT {key} AS value, weight / (SELECT sum(weight) FROM dim_{dim.name}) AS expected
  FROM dim_{dim.name}
),
total AS (SELECT sum(n) AS rows FROM counts)
SELECT coalesce(c.value, w.value) AS value, coalesce(n, 0) AS n_txns,
  round(CAST(coalesce(n, 0) AS DOUBLE) / rows, 6) AS observed_share,
  round(expected, 6) AS expected_share,
  round(CAST(coalesce(n, 0) AS DOUBLE) / rows - expected, 6) AS share_difference
FROM counts c FULL JOIN weights w ON c.value = w.value, total"""


LATENESS = f"""WITH {TXNS},
times AS (
  SELECT strptime(txn_timestamp, '%Y-%m-%dT%H:%M:%S.%gZ') AS event,
         strptime(arrival_timestamp, '%Y-%m-%dT%H:%M:%S.%gZ') AS arrival
  FROM txns
)
SELECT CAST(date_diff('day', CAST(event AS DATE), CAST(arrival AS DATE)) AS INTEGER) AS days_late,
  count(*) AS n_txns, count(*) FILTER (WHERE event > arrival) AS n_ahead
FROM times GROUP BY 1"""

ZIPF = f"""WITH {TXNS},
counts AS (SELECT merchant_id, count(*) AS n_txns FROM txns GROUP BY merchant_id),
ranked AS (SELECT *, row_number() OVER (ORDER BY n_txns DESC, merchant_id) AS rank FROM counts)
SELECT merchant_id, n_txns, rank,
  round(CAST(n_txns AS DOUBLE) / (SELECT sum(n_txns) FROM ranked), 6) AS observed_share,
  round((1.0::DOUBLE / rank) / (SELECT sum(1.0::DOUBLE / rank) FROM ranked), 6) AS rank_weight
FROM ranked"""


# --- lookups -----------------------------------------------------------------------

LOOKUPS = ", ".join(
    dimension(dim)
    for dim in (dims.SEGMENT, dims.MERCHANT_CATEGORY, dims.GATEWAY, dims.PAYMENT_METHOD, dims.PROCESSOR)
)
JOINED = """txns t
  LEFT JOIN dim_segment s ON t.user_segment = s.segment
  LEFT JOIN dim_merchant_category c ON t.merchant_category = c.category
  LEFT JOIN dim_gateway g ON t.gateway_id = g.gateway_id
  LEFT JOIN dim_payment_method m ON t.payment_method = m.method
  LEFT JOIN dim_processor p ON t.processor_id = p.processor_id"""
T_COLUMNS = ", ".join(f"t.{name}" for name in TRANSACTION_COLUMNS)
RISK = "c.failure_rate * 0.4::DOUBLE + m.failure_rate * 0.4::DOUBLE + (1.0::DOUBLE - g.success_rate) * 0.2::DOUBLE"

ENRICHED = f"""WITH {TXNS}, {LOOKUPS}
SELECT {T_COLUMNS},
  s.avg_amount AS segment_avg_amount, s.txn_frequency AS segment_frequency,
  c.avg_amount AS category_avg_amount, c.failure_rate AS category_failure_rate,
  g.success_rate AS gateway_success_rate, coalesce(g.avg_latency_ms, -1) AS gateway_latency_ms,
  m.failure_rate AS method_failure_rate, m.processor AS method_processor,
  p.success_rate AS processor_success_rate, coalesce(p.settlement_hours, -1) AS settlement_hours
FROM {JOINED}"""

_SUPPORTED = (
    "EXISTS (SELECT 1 FROM dim_gateway g WHERE g.gateway_id = t.gateway_id"
    " AND list_contains(g.supported_methods, t.payment_method))"
)

METHOD_GATEWAYS = f"""WITH {TXNS}, {dimension(dims.GATEWAY)},
used AS (SELECT payment_method, count(*) AS n_txns FROM txns GROUP BY payment_method)
SELECT payment_method, n_txns,
  (SELECT string_agg(gateway_id, ',' ORDER BY gateway_id) FROM dim_gateway
   WHERE list_contains(supported_methods, payment_method)) AS eligible_gateways
FROM used"""

PROCESSOR_MISMATCH = f"""WITH {TXNS}
SELECT {COLUMNS} FROM txns
WHERE NOT (CASE payment_method WHEN 'UPI' THEN processor_id = 'PRC-001'
  WHEN 'CARD' THEN processor_id IN ('PRC-002', 'PRC-003')
  WHEN 'NETBANKING' THEN processor_id = 'PRC-004'
  WHEN 'WALLET' THEN processor_id = 'PRC-001' ELSE false END)"""

# --- assignment ----------------------------------------------------------------------


def uniform(key: str) -> str:
    return f"CAST(CAST('0x' || substr(md5({key}), 1, 8) AS BIGINT) AS DOUBLE) / 4294967296.0::DOUBLE"


def intervals(name: str, source: str, value: str, weight: str) -> str:
    """CTE ``name`` with value, lower and upper bounds."""
    return f"""{name}_ends AS (
  SELECT position, {value} AS value, CASE WHEN position = max(position) OVER () THEN 1.0::DOUBLE
    ELSE round(sum({weight}) OVER (ORDER BY position) / sum({weight}) OVER (), 12) END AS upper
  FROM {source}
),
{name} AS (
  SELECT value, upper, coalesce(lag(upper) OVER (ORDER BY position), 0.0::DOUBLE) AS lower
  FROM {name}_ends
)"""


def _assignment() -> str:
    draws = {
        "segment": (dims.SEGMENT, "segment", "weight * txn_frequency"),
        "category": (dims.MERCHANT_CATEGORY, "category", "weight"),
        "method": (dims.PAYMENT_METHOD, "method", "weight"),
        "reason": (dims.FAILURE_REASON, "reason", "weight"),
        "city": (dims.LOCATION, "city", "weight"),
        "hour": (dims.HOUR_WEIGHT, "hour", "weight"),
    }
    ctes, picks, joins = [], [], []
    for name, (dim, value, weight) in draws.items():
        ctes.append(dimension(dim))
        ctes.append(intervals(f"cut_{name}", f"dim_{dim.name}", value, weight))
        picks.append(f"i_{name}.value AS drawn_{name}")
        joins.append(
            f"JOIN cut_{name} i_{name} ON u_{name} >= i_{name}.lower AND u_{name} < i_{name}.upper"
        )
    numbers = ", ".join(f"{uniform(f"'{name}:' || txn_id")} AS u_{name}" for name in draws)
    return f"""WITH {TXNS}, {", ".join(ctes)},
placed AS (SELECT txn_id, 'TXN-' || upper(substr(md5(txn_id), 1, 12)) AS draw_id, {numbers} FROM txns)
SELECT txn_id, draw_id, {", ".join(picks)} FROM placed {" ".join(joins)}"""


MERCHANT_ASSIGNMENT = f"""WITH {TXNS},
pool AS (
  SELECT position, 'MRC-' || lpad(CAST(position AS VARCHAR), 6, '0') AS merchant
  FROM range(1, {dims.MERCHANT_POOL_SIZE + 1}) AS r(position)
),
{intervals("cut", "pool", "merchant", "1.0::DOUBLE / position")},
placed AS (SELECT txn_id, {uniform("txn_id")} AS u FROM txns)
SELECT txn_id, round(u, 9) AS uniform, cut.value AS drawn_merchant
FROM placed JOIN cut ON u >= cut.lower AND u < cut.upper"""


# --- silver and gold -------------------------------------------------------------------


def _shifted(column: str, days: int) -> str:
    return (
        f"strftime(strptime({column}, '%Y-%m-%dT%H:%M:%S.%gZ') + to_days({days}), "
        f"'%Y-%m-%dT%H:%M:%S.%g') || 'Z'"
    )


VERSIONS = f"""{TXNS},
settled AS (
  SELECT * REPLACE ({_shifted('arrival_timestamp', 1)} AS arrival_timestamp, 'SUCCESS' AS status,
    CAST(NULL AS VARCHAR) AS failure_reason) FROM txns WHERE {FAILED}
),
outdated AS (
  SELECT * REPLACE ({_shifted('arrival_timestamp', -1)} AS arrival_timestamp, 0.0::DOUBLE AS amount)
  FROM txns WHERE {LATE}
),
redated AS (
  SELECT * REPLACE ({_shifted('arrival_timestamp', 2)} AS arrival_timestamp,
    {_shifted('txn_timestamp', -1)} AS txn_timestamp) FROM txns WHERE event_id % 10 = 3
),
unread AS (
  SELECT * REPLACE ('not a time' AS arrival_timestamp, 1.0::DOUBLE AS amount) FROM txns WHERE event_id % 10 = 7
),
close AS (
  SELECT txns.* REPLACE (substring({_shifted('arrival_timestamp', 3)}, 1, 19) || spelling AS arrival_timestamp, version_amount AS amount)
  FROM txns, (VALUES ('.99Z', 2.0::DOUBLE), ('.995Z', 3.0::DOUBLE)) AS v(spelling, version_amount) WHERE event_id % 10 = 8
),
versions AS (
  SELECT * FROM settled UNION ALL SELECT * FROM outdated UNION ALL SELECT * FROM redated
  UNION ALL SELECT * FROM unread UNION ALL SELECT * FROM close
)"""


def _moment(column: str) -> str:
    """The time that a text spells, or NULL."""
    return (
        f"CASE WHEN regexp_matches({column}, '^[0-9-]{{10}}T[0-9:]{{8}}\\.[0-9]{{1,3}}Z$') "
        f"THEN try_cast(replace({column}[1:-2], 'T', ' ') AS TIMESTAMP) END"
    )


def _latest_first(arrival: str, event: str | None = None) -> str:
    columns = [arrival] if event is None else [arrival, event]
    return ", ".join(f"{c} DESC NULLS LAST" for c in (*map(_moment, columns), *columns))


_REST = ", ".join(
    f"{name} ASC NULLS FIRST"
    for name in TRANSACTION_COLUMNS
    if name not in ("txn_id", "arrival_timestamp", "txn_timestamp")
)


def latest(source: str) -> str:
    return f"""SELECT {COLUMNS} FROM (
  SELECT *, row_number() OVER (PARTITION BY txn_id
    ORDER BY {_latest_first('arrival_timestamp', 'txn_timestamp')}, {_REST}) AS place FROM {source})
WHERE place = 1 AND txn_id IS NOT NULL"""


# What silver chooses among: undamaged enough messages, and the versions.
ROW_ACCOUNTING = f"""WITH {VERSIONS},
messages AS (
  SELECT txn_id, CASE event_id % 50 WHEN 3 THEN regexp_replace(arrival_timestamp, '\\.[0-9]{{3}}Z$', 'Z')
    ELSE arrival_timestamp END AS arrival, event_id % 50 IN (0, 1, 4, 5, 6, 7) AS unusable FROM txns
  UNION ALL SELECT txn_id, arrival_timestamp, false FROM versions
),
newest AS (
  SELECT txn_id, arrival AS kept FROM messages WHERE NOT unusable
  QUALIFY row_number() OVER (PARTITION BY txn_id ORDER BY {_latest_first('arrival')}) = 1
)
SELECT CASE WHEN unusable THEN 'quarantine' WHEN arrival = kept THEN 'silver' ELSE 'replaced' END AS state,
  count(*) AS n_rows
FROM messages LEFT JOIN newest USING (txn_id) GROUP BY 1"""


MEASURES = f"""count(*) AS n_txns, count(*) FILTER (WHERE {FAILED}) AS n_failed,
  round(sum(amount), 2) AS amount_sum, min(amount) AS amount_min, max(amount) AS amount_max,
  round(CAST(count(*) FILTER (WHERE {FAILED}) AS DOUBLE) / count(*), 6) AS failure_rate"""
ROUTE = "gateway_id, payment_method, merchant_category"


def _gold(grouping: str) -> str:
    return f"""WITH {TXNS}
SELECT {ROUTE}, CAST(GROUPING({ROUTE}) AS BIGINT) AS grouping_level, {MEASURES}
FROM txns GROUP BY {grouping}({ROUTE})"""


def _field_kinds() -> str:
    kinds = {name: "string" for name in TRANSACTION_COLUMNS} | {"amount": "number", "is_international": "boolean"}
    otherwise = {"amount": "WHEN way = 3 THEN 'string' ", "is_international": "WHEN way = 4 THEN 'string' "}
    known = " UNION ALL ".join(
        f"SELECT '{name}' AS field, '{kind}' AS expected, CASE {otherwise.get(name, '')}"
        f"WHEN {name} IS NULL THEN 'null' ELSE '{kind}' END AS kind FROM sent"
        for name, kind in kinds.items()
    )
    added = " UNION ALL ".join(
        f"SELECT '{name}', NULL, '{kind}' FROM sent WHERE way = {way}"
        for way, name, kind in ((1, "channel", "string"), (2, "retries", "number"), (5, "device", "object"), (6, "tags", "array"))
    )
    return (
        f"WITH {TXNS}, sent AS (SELECT *, event_id % 20 AS way FROM txns WHERE event_id % 20 <> 7), "
        f"seen AS ({known} UNION ALL {added}) SELECT field, kind, count(*) AS n_messages, expected, "
        "expected IS NULL OR (kind <> expected AND kind <> 'null') AS drifted FROM seen GROUP BY field, kind, expected"
    )


MESSAGE_DRIFT = f"""WITH {TXNS} SELECT txn_id AS message_key, CASE event_id % 20
  WHEN 1 THEN '{{"channel":"web"}}' WHEN 2 THEN '{{"retries":' || (event_id % 7) || '}}'
  WHEN 3 THEN '{{"amount":"many"}}' WHEN 4 THEN '{{"is_international":"no"}}'
  WHEN 5 THEN '{{"device":{{"os":"x"}}}}' WHEN 6 THEN '{{"tags":["a","b"]}}' END AS drift FROM txns"""


def statements() -> dict[str, str]:
    bronze_rows = f"WITH {BRONZE} SELECT {COLUMNS}, {PARTS} FROM bronze"
    summary = f"WITH {BRONZE}, {rule_counts('bronze')}"
    upserted = (
        f"WITH {VERSIONS}, everything AS (SELECT * FROM txns UNION ALL SELECT * FROM versions), "
        f"kept AS ({latest('everything')}) SELECT *, txn_timestamp[1:10] AS event_date FROM kept"
    )
    hour = "CAST(hour(strptime(txn_timestamp, '%Y-%m-%dT%H:%M:%S.%gZ')) AS INTEGER)"
    return {
        "bronze_parse": bronze_rows,
        "bronze_partition_counts": (
            f"WITH {BRONZE} SELECT {PARTS}, count(*) AS n_rows FROM bronze GROUP BY {PARTS}"
        ),
        "envelope_roundtrip": (
            f"WITH {TXNS} SELECT txn_id AS message_key, failure_reason IS NULL AS explicit_null, "
            f"{COLUMNS} FROM txns"
        ),
        "corrupt_quarantine": QUARANTINE,
        "corrupt_bronze": CORRUPT_BRONZE,
        "timestamp_variants": VARIANTS,
        "bronze_table": bronze_rows,
        "day_scan": f"{bronze_rows} WHERE CAST(arrived AS DATE) = DATE '{LOGICAL_DATE}'",
        "rule_summary": f"{summary} SELECT {SUMMARY_COLUMNS} FROM summary",
        "rule_summary_by_day": (
            f"WITH {BRONZE}, {rule_counts('bronze', DAY)} SELECT {DAY}, {SUMMARY_COLUMNS} FROM summary"
        ),
        "rule_summary_doubled": (
            f"WITH {DOUBLED}, {rule_counts('doubled')} SELECT {SUMMARY_COLUMNS} FROM summary"
        ),
        "rule_summary_incremental": (
            f"WITH {DOUBLED}, {rule_counts('doubled')} SELECT {SUMMARY_COLUMNS} FROM summary"
        ),
        "schema_rule": _schema_rule(),
        "suite_statistics": (
            f"{summary} SELECT {STATISTICS}, "
            "100.0::DOUBLE * count(*) FILTER (WHERE success) / count(*) AS success_percent, "
            "bool_and(success) AS success FROM summary"
        ),
        "failed_rules": f"{summary} SELECT {SUMMARY_COLUMNS} FROM summary WHERE NOT success",
        "unexpected_samples": _samples(),
        "duplicate_rows": (
            f"WITH {DOUBLED} SELECT * FROM (SELECT {COLUMNS}, "
            "count(*) OVER (PARTITION BY txn_id) AS group_size FROM doubled WHERE txn_id IS NOT NULL) "
            "WHERE group_size > 1"
        ),
        "duplicate_rows_hot": (
            f"WITH {TXNS}, hot AS (SELECT * REPLACE (CASE WHEN event_id % 3 = 0 THEN 'TXN-HOT' ELSE txn_id END AS txn_id) "
            f"FROM txns) SELECT * FROM (SELECT {COLUMNS}, count(*) OVER (PARTITION BY txn_id) AS group_size FROM hot) "
            "WHERE group_size > 1"
        ),
        "duplicate_marks": (
            f"WITH {DOUBLED} SELECT txn_id, arrival_timestamp, "
            "count(*) OVER (PARTITION BY txn_id) > 1 AND txn_id IS NOT NULL AS is_duplicate FROM doubled"
        ),
        "gate_report": _gate_report(),
        "gate_single_day": (
            f"WITH {MENDED} SELECT {COLUMNS}, {PARTS}, true AS passed FROM mended "
            f"WHERE CAST(arrived AS DATE) = DATE '{LOGICAL_DATE}'"
        ),
        "published_read": f"WITH {MENDED}, {rule_counts('mended', DAY)}, passing AS "
        f"(SELECT {DAY} FROM summary GROUP BY {DAY} HAVING bool_and(success)) "
        f"SELECT {COLUMNS}, {PARTS} FROM mended SEMI JOIN passing USING ({DAY})",
        "late_arrivals": f"WITH {TXNS} SELECT {COLUMNS} FROM txns WHERE {LATE}",
        "failed_transactions": f"WITH {TXNS} SELECT {COLUMNS} FROM txns WHERE {FAILED}",
        "failure_late_rates": RATES,
        "rates_per_1000": RATES_PER_1000,
        "share_vs_weight_segment": share("user_segment", dims.SEGMENT, "segment"),
        "share_vs_weight_category": share("merchant_category", dims.MERCHANT_CATEGORY, "category"),
        "share_vs_weight_method": share("payment_method", dims.PAYMENT_METHOD, "method"),
        "share_vs_weight_reason": share("failure_reason", dims.FAILURE_REASON, "reason", FAILED),
        "share_vs_weight_city": share("location_city", dims.LOCATION, "city"),
        "share_vs_weight_hour": share(hour, dims.HOUR_WEIGHT, "hour"),
        "lateness_profile": LATENESS,
        "merchant_zipf": ZIPF,
        "enrich_dims": ENRICHED,
        "gateway_violations": (
            f"WITH {TXNS}, {dimension(dims.GATEWAY)} SELECT {COLUMNS} FROM txns t WHERE NOT {_SUPPORTED}"
        ),
        "gateway_eligible": (
            f"WITH {TXNS}, {dimension(dims.GATEWAY)} SELECT {COLUMNS} FROM txns t WHERE {_SUPPORTED}"
        ),
        "methods_to_gateways": METHOD_GATEWAYS,
        "processor_mismatch": PROCESSOR_MISMATCH,
        "expected_failure": (
            f"WITH {TXNS}, {LOOKUPS} SELECT txn_id, round({RISK}, 6) AS failure_probability FROM {JOINED}"
        ),
        "expected_vs_actual": (
            f"WITH {TXNS}, {LOOKUPS} SELECT t.gateway_id, payment_method, merchant_category, "
            f"count(*) AS n_txns, count({RISK}) AS n_scored, round(sum({RISK}), 6) AS expected_failures, "
            f"count(*) FILTER (WHERE {FAILED}) AS actual_failures FROM {JOINED} GROUP BY 1, 2, 3"
        ),
        "amount_zscore": (
            f"WITH {TXNS}, {LOOKUPS}, means AS (SELECT txn_id, amount, "
            f"(s.avg_amount + c.avg_amount) / 2.0::DOUBLE AS expected_amount FROM {JOINED}) "
            "SELECT txn_id, amount, expected_amount, "
            "round((amount - expected_amount) / (expected_amount * 0.3::DOUBLE), 6) AS amount_zscore FROM means"
        ),
        "amount_clamp": (
            f"WITH {TXNS} SELECT txn_id, amount, round(greatest(10.0::DOUBLE, amount), 2) AS clamped FROM txns"
        ),
        "weighted_assignment": _assignment(),
        "segment_assignment": f"SELECT txn_id, drawn_segment FROM ({_assignment()})",
        "row_accounting": ROW_ACCOUNTING,
        "merchant_assignment": MERCHANT_ASSIGNMENT,
        "silver_dedupe": (
            f"WITH {VERSIONS}, everything AS (SELECT * FROM txns UNION ALL SELECT * FROM txns "
            f"WHERE event_id % 100 = 0 UNION ALL SELECT * FROM versions) {latest('everything')}"
        ),
        "silver_dedupe_ranked": (
            f"WITH {VERSIONS}, everything AS (SELECT * FROM txns UNION ALL SELECT * FROM txns "
            f"WHERE event_id % 100 = 0 UNION ALL SELECT * FROM versions) {latest('everything')}"
        ),
        "silver_upsert": upserted,
        "stream_silver": upserted,
        "silver_changes": (
            f"WITH {VERSIONS}, everything AS (SELECT {COLUMNS} FROM txns UNION ALL SELECT {COLUMNS} FROM versions), "
            f"before AS ({latest('txns')}), after AS ({latest('everything')}) "
            "SELECT -1 AS sign, * FROM (FROM before EXCEPT ALL FROM after) "
            "UNION ALL SELECT 1 AS sign, * FROM (FROM after EXCEPT ALL FROM before)"
        ),
        "gold_incremental": (
            f"WITH {VERSIONS}, everything AS (SELECT * FROM txns UNION ALL SELECT * FROM versions), "
            f"kept AS ({latest('everything')}) SELECT {ROUTE}, CAST(GROUPING({ROUTE}) AS BIGINT) AS grouping_level, "
            f"{MEASURES} FROM kept GROUP BY CUBE({ROUTE})"
        ),
        "gold_routes": f"WITH {TXNS} SELECT {ROUTE}, {MEASURES} FROM txns GROUP BY {ROUTE}",
        "gold_rollup": _gold("ROLLUP"),
        "gold_cube": _gold("CUBE"),
        "gold_daily": f"WITH {BRONZE} SELECT {DAY}, {MEASURES} FROM bronze GROUP BY {DAY}",
        "stream_bronze": bronze_rows,
        "stream_quarantine": QUARANTINE,
        "stream_replay": bronze_rows,
        "bronze_compacted": bronze_rows,
        "stream_dedupe": bronze_rows,
        "field_kinds": _field_kinds(),
        "message_drift": MESSAGE_DRIFT,
        "stream_rates": RATES,
    }
