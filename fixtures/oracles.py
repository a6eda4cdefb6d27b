"""The registered queries as SQL over the test tables, written without the library."""

from __future__ import annotations

A = """a AS (
  SELECT event_id, user_id, event_type, value, ts, epoch_us(ts) // 1000 AS ts_ms,
         CASE WHEN event_id % 97 = 0 THEN 'x' WHEN event_type = 'error' THEN 'd'
              WHEN event_type = 'signup' THEN 'c' WHEN event_type = 'view' THEN 'r'
              ELSE 'u' END AS op
  FROM events)"""

B = """b AS (
  SELECT o_orderkey, o_custkey, 'F' || o_custkey AS first_name, o_orderpriority AS city,
         DATE '1970-01-01' + CAST(3650 + o_custkey % 10000 AS INTEGER) AS date_of_birth,
         o_orderdate AS registration_date, epoch_us(o_orderdate) // 1000 AS ts_ms,
         CASE WHEN o_orderstatus = 'F' THEN 'd' ELSE 'u' END AS op
  FROM orders)"""

C = """c AS (
  SELECT l_orderkey * 10 + l_linenumber AS transaction_id, l_suppkey AS account_id,
         l_returnflag AS transaction_type, l_extendedprice AS amount, l_shipdate AS ts,
         epoch_us(l_shipdate) // 1000 AS ts_ms, l_partkey * 1000000 + l_suppkey AS off
  FROM lineitem)"""

# One version per run of rows that agree in the tracked columns; see scd2 tests for the rules.
HISTORY = B + """, b1 AS (
  SELECT * FROM b
  QUALIFY row_number() OVER (PARTITION BY o_custkey, ts_ms ORDER BY o_orderkey DESC) = 1),
b2 AS (
  SELECT *, lag(op = 'd') OVER w AS prev_deleted, lag(city) OVER w AS prev_city,
         lag(first_name) OVER w AS prev_name, lag(date_of_birth) OVER w AS prev_birth
  FROM b1 WINDOW w AS (PARTITION BY o_custkey ORDER BY ts_ms)),
b3 AS (
  SELECT *, sum(CASE
      WHEN prev_deleted IS NULL OR prev_deleted <> (op = 'd') THEN 1
      WHEN op <> 'd' AND (city IS DISTINCT FROM prev_city OR first_name IS DISTINCT FROM prev_name
           OR date_of_birth IS DISTINCT FROM prev_birth) THEN 1
      ELSE 0 END) OVER (PARTITION BY o_custkey ORDER BY ts_ms ROWS UNBOUNDED PRECEDING) AS version
  FROM b2),
b4 AS (
  SELECT o_custkey, version, min(ts_ms) AS start_at, arg_max(city, ts_ms) AS city,
         arg_max(first_name, ts_ms) AS first_name, arg_max(date_of_birth, ts_ms) AS date_of_birth,
         arg_max(registration_date, ts_ms) AS registration_date, max(ts_ms) AS last_ms,
         bool_or(op = 'd') AS deleted
  FROM b3 GROUP BY o_custkey, version),
b5 AS (
  SELECT *, lead(start_at) OVER (PARTITION BY o_custkey ORDER BY version) AS end_at FROM b4),
h AS (
  SELECT o_custkey AS customer_id, first_name, city, date_of_birth, registration_date,
         last_ms AS effective_timestamp, start_at AS __START_AT, end_at AS __END_AT
  FROM b5 WHERE NOT deleted)"""

LATEST = A + """, newest AS (
  SELECT * FROM a WHERE op <> 'x'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) = 1)"""

DAILY = A + """, daily AS (
  SELECT CAST(ts AS DATE) AS account_date, user_id AS account_id, user_id % 50 AS customer_id,
         CASE WHEN user_id % 2 = 0 THEN 'CHECKING' ELSE 'SAVINGS' END AS account_type,
         'USD' AS currency, arg_max_null(value, (ts_ms, event_id)) AS end_of_day_balance,
         count(*) AS daily_updates_count
  FROM a WHERE op NOT IN ('x', 'd') GROUP BY ALL)"""

TRANSACTIONS = C + """, last_c AS (
  SELECT * FROM c
  QUALIFY row_number() OVER (PARTITION BY transaction_id
    ORDER BY ts_ms DESC, transaction_id % 12 DESC, off DESC) = 1),
summary AS (
  SELECT CAST(ts AS DATE) AS transaction_date, account_id, transaction_type,
         CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS total_transaction_amount,
         count(transaction_id) AS number_of_transactions
  FROM last_c GROUP BY ALL)"""

BRANCHES = """SELECT s_suppkey AS branch_id, s_name AS branch_name, CAST(NULL AS VARCHAR) AS address,
  CAST(s_nationkey AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS state,
  CAST(NULL AS VARCHAR) AS zip_code, CAST(NULL AS VARCHAR) AS phone_number,
  CAST(1000 AS BIGINT) AS last_updated_ms
  FROM supplier WHERE s_suppkey % 10 <> 0"""


def _image(prefix: str, present: str) -> str:
    """An accounts row image, NULL unless ``present``."""
    fields = {
        "account_id": "user_id",
        "customer_id": "user_id % 50",
        "account_type": "CASE WHEN user_id % 2 = 0 THEN 'CHECKING' ELSE 'SAVINGS' END",
        "balance": "value",
        "currency": "'USD'",
        "open_date": "CAST(NULL AS TIMESTAMP)",
        "status": "event_type",
        "last_activity_date": "ts",
    }
    return ", ".join(
        f"CASE WHEN {present} THEN {e} END AS {prefix}{name}" for name, e in fields.items()
    )


META = """op AS operation_type, ts_ms AS operation_timestamp_ms,
  date_trunc('milliseconds', ts) AS event_time,
  CAST(user_id % 6 AS INTEGER) AS kafka_partition, event_id AS kafka_offset"""

# A typed change: the after-image, its key filled in from the before-image on deletes.
CHANGE = _image("", "op <> 'd'").replace(
    "CASE WHEN op <> 'd' THEN user_id END AS account_id", "user_id AS account_id"
) + ", " + META

BASIC = """'dbserver1.banking_db.accounts' AS kafka_topic,
  CAST(user_id % 6 AS INTEGER) AS kafka_partition, event_id AS kafka_offset"""


def _changed(field: str, text: str) -> str:
    """Differences of one customers field between a row's before- and after-image.

    A first row that is a delete has a before-image with nothing but the key.
    """
    if field == "customer_id":
        old = "CASE WHEN prev_id IS NOT NULL OR op = 'd' THEN CAST(o_custkey AS VARCHAR) END"
    else:
        old = f"lag({text}) OVER w"
    return f"""SELECT o_custkey AS customer_id, ts_ms AS operation_timestamp_ms,
      op AS operation_type, CAST(o_custkey % 6 AS INTEGER) AS kafka_partition,
      o_orderkey AS kafka_offset, '{field}' AS field, {old} AS old_value,
      CASE WHEN op <> 'd' THEN {text} END AS new_value
      FROM b0 WINDOW w AS (PARTITION BY o_custkey ORDER BY registration_date, o_orderkey)"""


FIELD_CHANGES = (
    f"WITH {B}, b0 AS (SELECT *, lag(o_custkey) OVER "
    "(PARTITION BY o_custkey ORDER BY registration_date, o_orderkey) AS prev_id FROM b), diff AS ("
    + " UNION ALL ".join(
        _changed(field, f"CAST({column} AS VARCHAR)")
        for field, column in {
            "customer_id": "o_custkey",
            "first_name": "first_name",
            "city": "city",
            "date_of_birth": "date_of_birth",
            "registration_date": "registration_date",
        }.items()
    )
    + ") SELECT * FROM diff WHERE old_value IS DISTINCT FROM new_value"
)

SILVER = f"""WITH {A}, {B}, {C},
last_a AS (SELECT op FROM a WHERE op <> 'x'
  QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) = 1),
last_b AS (SELECT op FROM b
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY ts_ms DESC, o_orderkey DESC) = 1),
counted AS (
  SELECT 'accounts' AS table_name, (SELECT count(*) FROM a WHERE op <> 'x') AS changes,
    (SELECT count(*) FROM last_a) AS keys, (SELECT count_if(op <> 'd') FROM last_a) AS live_keys
  UNION ALL SELECT 'customers', (SELECT count(*) FROM b), (SELECT count(*) FROM last_b),
    (SELECT count_if(op <> 'd') FROM last_b)
  UNION ALL SELECT 'atm_transactions', count(*), count(DISTINCT transaction_id),
    count(DISTINCT transaction_id) FROM c
  UNION ALL SELECT 'branches', count(*) + count_if(s_suppkey % 10 = 0), count(*),
    count_if(s_suppkey % 10 <> 0) FROM supplier
  UNION ALL SELECT 'loans', count(*), count(*), count(*) FROM orders
  UNION ALL SELECT 'cards', count(*), count(*), count_if(c_custkey % 7 <> 3) FROM customer
  UNION ALL SELECT 'merchants', count(*), count(*), count_if(c_custkey % 7 <> 3) FROM customer
  UNION ALL SELECT 'employees', count(*), count(*), count_if(s_suppkey % 7 <> 3) FROM supplier
  UNION ALL SELECT 'transaction_types', count(*), count(*), count_if(n_nationkey % 7 <> 3) FROM nation
  UNION ALL SELECT 'audit_logs', count(*), count(*), count_if(event_id % 7 <> 3) FROM events
  UNION ALL SELECT 'products', count(*), count(*), count_if(p_partkey % 7 <> 3) FROM part
  UNION ALL SELECT 'services', count(*), count(*), count_if(r_regionkey % 7 <> 3) FROM region
  UNION ALL SELECT 'transaction_details', count(*), count(DISTINCT transaction_id),
    count(DISTINCT CASE WHEN transaction_id % 7 <> 3 THEN transaction_id END) FROM c)
SELECT table_name, CAST(changes AS BIGINT) AS changes, CAST(keys AS BIGINT) AS keys,
  CAST(live_keys AS BIGINT) AS live_keys FROM counted"""

# Per table: its rows, whether a row is a delete, its key, and the whole number that stands for a value
# of each column that is ever filled, beside a text whose length does.
_COLUMNS = {
    "accounts": (
        "a WHERE op <> 'x'", "op = 'd'", "account_id", "user_id",
        {"customer_id": "user_id % 50", "account_type": "CASE WHEN user_id % 2 = 0 THEN 8 ELSE 7 END",
         "balance": "round(value * 100)", "currency": "3", "status": "length(event_type)",
         "last_activity_date": "epoch_us(ts)"},
        "open_date",
    ),
    "customers": (
        "b", "op = 'd'", "customer_id", "o_custkey",
        {"first_name": "length(first_name)", "city": "length(city)",
         "date_of_birth": "3650 + o_custkey % 10000", "registration_date": "epoch_us(registration_date)"},
        "last_name email phone_number address_line1 address_line2 state zip_code gender last_update_timestamp",
    ),
    "atm_transactions": (
        "c", "false", "transaction_id", "transaction_id",
        {"account_id": "account_id", "transaction_type": "length(transaction_type)", "amount": "round(amount * 100)"},
        "atm_id transaction_timestamp location status",
    ),
    "loans": (
        "orders", "false", "loan_id", "o_orderkey",
        {"account_id": "o_custkey", "principal_amount": "round(o_totalprice * 100)",
         "start_date": "CAST(o_orderdate AS DATE) - DATE '1970-01-01'",
         "end_date": "CAST(o_orderdate AS DATE) - DATE '1970-01-01'", "status": "length(o_orderstatus)"},
        "loan_type interest_rate outstanding_balance",
    ),
    "cards": (
        "customer", "c_custkey % 7 = 3", "card_id", "c_custkey",
        {"account_id": "c_custkey % 1000", "card_type": "length(c_mktsegment)", "card_number_hash": "64",
         "expiration_date": "20000 + c_custkey % 1000", "issue_date": "18262 + c_custkey % 365", "status": "6"},
        "",
    ),
    "branches": (
        "(SELECT *, false AS gone FROM supplier UNION ALL SELECT *, true FROM supplier WHERE s_suppkey % 10 = 0)",
        "gone", "branch_id", "s_suppkey",
        {"branch_name": "length(s_name)", "city": "length(CAST(s_nationkey AS VARCHAR))"},
        "address state zip_code phone_number",
    ),
    "employees": (
        "supplier", "s_suppkey % 7 = 3", "employee_id", "s_suppkey",
        {"branch_id": "s_suppkey % 10", "first_name": "length(s_name)", "position": "5",
         "hire_date": "10000 + s_suppkey % 5000"},
        "last_name email",
    ),
    "transaction_types": (
        "nation", "n_nationkey % 7 = 3", "type_id", "n_nationkey",
        {"type_name": "length(n_name)", "description": "length('region ' || n_regionkey)"},
        "",
    ),
    "audit_logs": (
        "events", "event_id % 7 = 3", "log_id", "event_id",
        {"user_id": "user_id", "action": "length(event_type)", "timestamp": "epoch_us(ts) // 1000 * 1000",
         "details": "length(props)"},
        "",
    ),
    "products": (
        "part", "p_partkey % 7 = 3", "product_id", "p_partkey",
        {"product_name": "length(p_name)", "product_type": "length(p_type)", "description": "length(p_brand)",
         "interest_rate": "p_size * 25", "min_balance": "round(p_retailprice * 100)"},
        "",
    ),
    "services": (
        "region", "r_regionkey % 7 = 3", "service_id", "r_regionkey",
        {"service_name": "length(r_name)", "status": "4"},
        "description",
    ),
    "transaction_details": (
        "lineitem", "(l_orderkey * 10 + l_linenumber) % 7 = 3", "detail_id", "l_orderkey * 10 + l_linenumber",
        {"transaction_id": "l_orderkey * 10 + l_linenumber", "item_description": "length(l_linestatus)",
         "item_amount": "round(l_extendedprice * 100)", "category": "length(l_returnflag)"},
        "",
    ),
    "merchants": (
        "customer", "c_custkey % 7 = 3", "merchant_id", "c_custkey",
        {"merchant_name": "length(c_name)", "category": "length(c_mktsegment)", "city": "length('city ' || c_nationkey)"},
        "state",
    ),
}


def _column_totals() -> str:
    lines = []
    for table, (rows, gone, key, key_value, filled, empty) in _COLUMNS.items():
        values = {key: key_value}
        values |= {c: f"CASE WHEN NOT ({gone}) THEN {e} END" for c, e in filled.items()}
        values |= dict.fromkeys(empty.split(), "NULL")
        for column, value in values.items():
            lines.append(
                f"SELECT '{table}' AS table_name, '{column}' AS column_name, count({value}) AS filled, "
                f"CAST(coalesce(sum((CAST({value} AS BIGINT) % 1000003 + 1000003) % 1000003), 0) AS BIGINT) AS total "
                f"FROM {rows}"
            )
    return f"WITH {A}, {B}, {C} " + " UNION ALL ".join(lines)




def _status_versions(name: str, key: str, rows: str) -> str:
    """CTEs that end in ``name``: versions of the status by ``key``, closed by deletes."""
    return f"""{name}1 AS (
  SELECT {key} AS k, ts_ms, op, event_type FROM a WHERE {rows}
  QUALIFY row_number() OVER (PARTITION BY {key}, ts_ms ORDER BY user_id % 6 DESC, event_id DESC) = 1),
{name}2 AS (
  SELECT *, CASE WHEN lag(ts_ms) OVER w IS NULL OR lag(op = 'd') OVER w <> (op = 'd')
      OR (op <> 'd' AND event_type IS DISTINCT FROM lag(event_type) OVER w) THEN 1 ELSE 0 END AS opens
  FROM {name}1 WINDOW w AS (PARTITION BY k ORDER BY ts_ms)),
{name}3 AS (SELECT *, sum(opens) OVER (PARTITION BY k ORDER BY ts_ms) AS version FROM {name}2),
{name}4 AS (
  SELECT k, version, min(ts_ms) AS start_at, any_value(event_type) AS status, bool_or(op = 'd') AS gone
  FROM {name}3 GROUP BY k, version),
{name} AS (
  SELECT * FROM (SELECT *, lead(start_at) OVER (PARTITION BY k ORDER BY version) AS end_at FROM {name}4)
  WHERE NOT gone)"""


HISTORY_JOIN = f"""WITH {A}, {_status_versions("x", "user_id", "op <> 'x'")},
{_status_versions("y", "user_id % 50", "op NOT IN ('x', 'd')")}
SELECT x.k AS account_id, x.k % 50 AS customer_id, x.status, y.status AS customer_status,
  greatest(x.start_at, y.start_at) AS __START_AT, least(x.end_at, y.end_at) AS __END_AT
FROM x JOIN y ON y.k = x.k % 50 AND x.start_at < coalesce(y.end_at, 9e18)
  AND y.start_at < coalesce(x.end_at, 9e18)"""

AUDITED = """audited AS (
  SELECT CAST(event_id % 10 = 0 AS INTEGER) AS p, event_id AS o,
         CASE WHEN event_id % 41 = 0 THEN 3 ELSE 1 END AS copies,
         ts - CASE WHEN event_id % 53 = 0 THEN INTERVAL 2 DAY ELSE INTERVAL 0 DAY END AS t
  FROM events WHERE event_id % 37 NOT IN (5, 6)),
stepped AS (
  SELECT *, lag(o) OVER w AS previous,
    max(t) OVER (PARTITION BY p ORDER BY o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS latest
  FROM audited WINDOW w AS (PARTITION BY p ORDER BY o))"""


def _state(moment: str) -> str:
    return f"""SELECT '{moment}' AS moment, {CHANGE} FROM (
        SELECT * FROM a WHERE op <> 'x' AND date_trunc('milliseconds', ts) <= TIMESTAMP '{moment}'
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) = 1) WHERE op <> 'd'"""


CLOSED_DAYS = f"""WITH {DAILY}
SELECT * FROM daily
WHERE CAST(account_date AS TIMESTAMP) + INTERVAL 1 DAY <= (
  SELECT max(date_trunc('milliseconds', ts)) - INTERVAL 10 MINUTE
  FROM a WHERE op NOT IN ('x', 'd'))"""

_TEXT_NULLS = ", ".join(
    f"CAST(NULL AS VARCHAR) AS {name}"
    for name in (
        "last_name",
        "email",
        "phone_number",
        "address_line1",
        "address_line2",
        "state",
        "zip_code",
        "gender",
    )
)

ORACLES = {
    "bronze_projection": f"""SELECT {BASIC}, ts AS kafka_timestamp, 'accounts' AS table_name,
        true AS dated_by_arrival FROM events""",
    "topic_table_name": """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'customers'
        WHEN event_id % 3 = 0 THEN 'accounts' WHEN event_id % 3 = 1 THEN 'loans'
        ELSE 'cards' END AS table_name FROM events""",
    "parse_envelope": f"""WITH {A} SELECT event_id AS kafka_offset, op, ts_ms,
        'banking_db' AS source_db, 'accounts' AS source_table, ts_ms AS source_ts_ms,
        'false' AS source_snapshot, CASE WHEN op <> 'd' THEN 7 END::INTEGER AS after_fields,
        CASE WHEN op <> 'd' THEN event_type END AS after_status FROM a""",
    "typed_images": f"""WITH {A} SELECT {_image("", "op <> 'd'")},
        {_image("before_", "op IN ('u', 'd')")}, {META} FROM a""",
    "typed_epochs": """WITH texts AS (
        SELECT event_id, CAST(left(CAST(epoch_us(ts) AS VARCHAR), CAST(event_id % 16 + 1 AS INTEGER)) AS BIGINT) AS n
        FROM events)
        SELECT event_id, CASE WHEN n <= 9223372036854775 THEN n * 1000 END AS from_millis,
          n AS from_micros, CASE WHEN n <= 2147483647 THEN CAST(n AS INTEGER) END AS days FROM texts""",
    "typed_dates": """SELECT 'loans' AS table_name, o_orderkey AS "offset",
        CAST(o_orderdate AS DATE) AS first_date, CAST(o_orderdate AS DATE) AS second_date,
        CAST(NULL AS TIMESTAMP) AS instant FROM orders
        UNION ALL SELECT 'customers', o_orderkey,
        CASE WHEN o_orderstatus <> 'F'
             THEN DATE '1970-01-01' + CAST(3650 + o_custkey % 10000 AS INTEGER) END,
        NULL, CASE WHEN o_orderstatus <> 'F' THEN o_orderdate END FROM orders""",
    "valid_operations": f"""WITH {A} SELECT event_id AS kafka_offset, op AS operation_type
        FROM a WHERE op IN ('c', 'u', 'd', 'r')""",
    "quarantine": f"""WITH {A}, counted AS (
        SELECT 'malformed' AS reason, count_if(event_id % 50 = 1) AS events FROM a
        UNION ALL SELECT 'invalid_operation',
          count_if(op = 'x') + count_if(op = 'x' AND event_id % 40 = 1) FROM a
        UNION ALL SELECT 'missing_key', count_if(op <> 'x' AND event_id % 40 = 1) FROM a
        UNION ALL SELECT 'cast_failure', count_if(event_id % 30 = 1) FROM a)
        SELECT reason, CAST(events AS BIGINT) AS events FROM counted WHERE events > 0""",
    "split_valid": f"""WITH {A} SELECT user_id AS account_id,
        CASE WHEN op <> 'd' THEN value END AS balance, op AS operation_type,
        event_id AS kafka_offset FROM a WHERE op <> 'x'
        UNION ALL SELECT 1, NULL, 'c', event_id FROM a WHERE event_id % 30 = 1""",
    "foreign_events": """SELECT 'kept' AS outcome, count(*) AS events FROM orders
        UNION ALL SELECT 'wrong_table', count(*) FROM events""",
    "stream_by_name": """SELECT o_orderkey AS loan_id, o_custkey AS account_id,
        CAST(o_orderdate AS DATE) AS start_date, o_orderstatus AS status FROM orders""",
    "cast_failures": """SELECT image, field, CAST(CASE WHEN image = 'after' AND field = 'balance'
          THEN (SELECT count_if(event_id % 30 = 1) FROM events) ELSE 0 END AS BIGINT) AS failed
        FROM unnest(['before', 'after']) AS i(image), unnest(['account_id', 'customer_id',
          'account_type', 'balance', 'currency', 'open_date', 'status', 'last_activity_date'])
          AS f(field)""",
    "quality_report": f"""WITH {A}, passes AS (
        SELECT 'valid_operation' AS rule, count_if(op <> 'x') AS passed, count(*) AS n FROM a
        UNION ALL SELECT 'valid_account_id', count_if(op <> 'd'), count(*) FROM a
        UNION ALL SELECT 'large_balance', count_if(op <> 'd' AND value >= 50), count(*) FROM a)
        SELECT 'accounts' AS table_name, rule, CAST(passed AS BIGINT) AS passed,
          CAST(n - passed AS BIGINT) AS failed,
          CAST(n - passed AS DOUBLE) / n AS failed_rate FROM passes""",
    "route_by_table": """SELECT 'accounts' AS table_name, count(*) AS events FROM events
        UNION ALL SELECT 'atm_transactions', count(*) FROM lineitem""",
    "change_log": f"WITH {A} SELECT {CHANGE} FROM a WHERE op <> 'x'",
    "latest_per_key": f"WITH {LATEST} SELECT {CHANGE} FROM newest",
    "latest_per_key_live": f"WITH {LATEST} SELECT {CHANGE} FROM newest WHERE op <> 'd'",
    "state_at": f"""WITH {A}, newest AS (SELECT * FROM a
        WHERE op <> 'x' AND ts_ms <= epoch_us(TIMESTAMP '2024-01-15 00:00:00') // 1000
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts_ms DESC, event_id DESC) = 1)
        SELECT {CHANGE} FROM newest WHERE op <> 'd'""",
    "field_changes": FIELD_CHANGES,
    "silver_tables": SILVER,
    "scd2_history": f"WITH {HISTORY} SELECT * FROM h",
    "scd2_history_hot": f"WITH {HISTORY} SELECT * FROM h",
    "scd2_current": f"WITH {HISTORY} SELECT * FROM h WHERE __END_AT IS NULL",
    "scd2_as_of": f"""WITH {HISTORY} SELECT * FROM h WHERE __START_AT <= 883612800000
        AND (__END_AT IS NULL OR __END_AT > 883612800000)""",
    "scd1_branches": BRANCHES,
    "daily_account_balances": f"WITH {DAILY} SELECT * FROM daily",
    "closing_balance_gaps": f"""WITH {A}, gaps AS (
        SELECT *, epoch_ms(CAST(ts AS DATE)) AS day_ms,
          CASE WHEN event_id % 5 > 0 THEN user_id % 6 ELSE -1 END AS part
        FROM a WHERE op NOT IN ('x', 'd'))
        SELECT CAST(ts AS DATE) AS account_date, user_id AS account_id, user_id % 50 AS customer_id,
          CASE WHEN user_id % 2 = 0 THEN 'CHECKING' ELSE 'SAVINGS' END AS account_type,
          'USD' AS currency, arg_max_null(value, (day_ms, part, event_id)) AS end_of_day_balance,
          count(*) AS daily_updates_count FROM gaps GROUP BY ALL""",
    "exact_money": """SELECT l_suppkey, sum(l_partkey * 8 + 1) / 8000.0 AS total
        FROM lineitem GROUP BY l_suppkey""",
    "daily_transactions_summary": f"WITH {TRANSACTIONS} SELECT * FROM summary",
    "monthly_balances": f"""WITH {A} SELECT CAST(date_trunc('month', ts) AS DATE) AS account_month,
        user_id AS account_id, user_id % 50 AS customer_id,
        CASE WHEN user_id % 2 = 0 THEN 'CHECKING' ELSE 'SAVINGS' END AS account_type,
        'USD' AS currency, arg_max_null(value, (ts_ms, event_id)) AS end_of_month_balance,
        count(*) AS monthly_updates_count
        FROM a WHERE op NOT IN ('x', 'd') GROUP BY ALL""",
    "enrich_accounts": f"""WITH {DAILY}, {LATEST.removeprefix(A + ', ')}, {HISTORY}
        SELECT n.user_id AS account_id, n.user_id % 50 AS customer_id,
          CASE WHEN n.user_id % 2 = 0 THEN 'CHECKING' ELSE 'SAVINGS' END AS account_type,
          'USD' AS currency, n.event_type AS status, h.first_name, h.city,
          d.account_date, d.end_of_day_balance, d.daily_updates_count
        FROM newest n JOIN h ON h.customer_id = n.user_id % 50 AND h.__END_AT IS NULL
        LEFT JOIN daily d ON d.account_id = n.user_id
        WHERE n.op <> 'd'""",
    "temporal_join": f"""WITH {C}, {HISTORY}
        SELECT transaction_id, account_id, amount, ts_ms AS operation_timestamp_ms,
          off AS kafka_offset, h.city, h.__START_AT, h.__END_AT
        FROM c JOIN h ON h.customer_id = c.account_id AND c.ts_ms >= h.__START_AT
          AND (h.__END_AT IS NULL OR c.ts_ms < h.__END_AT)""",
    "temporal_join_walk": f"""WITH {C}, {HISTORY}
        SELECT transaction_id, account_id, amount, ts_ms AS operation_timestamp_ms,
          off AS kafka_offset, h.city, h.__START_AT, h.__END_AT
        FROM c JOIN h ON h.customer_id = c.account_id AND c.ts_ms >= h.__START_AT
          AND (h.__END_AT IS NULL OR c.ts_ms < h.__END_AT)""",
    "orphans": f"""WITH {LATEST}, {HISTORY}
        SELECT user_id AS account_id, user_id % 50 AS customer_id FROM newest n
        WHERE op <> 'd' AND NOT EXISTS (
          SELECT 1 FROM h WHERE h.customer_id = n.user_id % 50 AND h.__END_AT IS NULL)""",
    "non_orphans": f"""WITH {LATEST}, {HISTORY}
        SELECT user_id AS account_id, user_id % 50 AS customer_id FROM newest n
        WHERE op <> 'd' AND EXISTS (
          SELECT 1 FROM h WHERE h.customer_id = n.user_id % 50 AND h.__END_AT IS NULL)""",
    "vw_gold_customer_current": f"""WITH {HISTORY}
        SELECT customer_id, first_name, city, date_of_birth, registration_date, {_TEXT_NULLS},
          make_timestamp(effective_timestamp * 1000) AS last_updated_at,
          effective_timestamp AS last_updated_ms
        FROM h WHERE __END_AT IS NULL""",
    "vw_gold_daily_account_summary": f"WITH {DAILY} SELECT * FROM daily",
    "vw_gold_daily_transaction_summary": f"WITH {TRANSACTIONS} SELECT * FROM summary",
    "vw_gold_branch_current": f"""WITH br AS ({BRANCHES})
        SELECT *, make_timestamp(last_updated_ms * 1000) AS last_updated_at FROM br""",
    "stream_bronze": f"SELECT {BASIC}, 'accounts' AS table_name FROM events",
    "stream_replay": f"SELECT {BASIC}, 'accounts' AS table_name FROM events",
    "batch_replay": f"SELECT {BASIC}, 'accounts' AS table_name FROM events",
    "grown_log": f"""SELECT {BASIC},
        CASE WHEN event_id % 2 = 1 THEN 'r' || event_id % 3 END AS region FROM events""",
    "enforced_schema": """SELECT c_custkey AS customer_id, c_name AS first_name,
        CAST(NULL AS VARCHAR) AS email, c_acctbal AS score FROM customer""",
    "stream_change_log": f"WITH {A} SELECT {CHANGE} FROM a WHERE op <> 'x'",
    "stream_latest": f"WITH {LATEST} SELECT {CHANGE} FROM newest",
    "stream_latest_state": f"WITH {LATEST} SELECT {CHANGE} FROM newest",
    "stream_scd2": f"WITH {HISTORY} SELECT * FROM h",
    "stream_silver": _column_totals(),
    "stream_quarantine": f"""WITH {A}, counted AS (
        SELECT 'accounts' AS table_name, 'malformed' AS reason, count_if(event_id % 50 = 1) AS events FROM a
        UNION ALL SELECT 'accounts', 'invalid_operation',
          count_if(op = 'x') + count_if(op = 'x' AND event_id % 40 = 1) FROM a
        UNION ALL SELECT 'accounts', 'missing_key', count_if(op <> 'x' AND event_id % 40 = 1) FROM a
        UNION ALL SELECT 'accounts', 'cast_failure', count_if(event_id % 30 = 1) FROM a
        UNION ALL SELECT 'closed_accounts', 'unknown_table', count(*) FROM region)
        SELECT table_name, reason, CAST(events AS BIGINT) AS events FROM counted WHERE events > 0""",
    "stream_daily_balances_append": CLOSED_DAYS,
    "stream_daily_balances_rebuilt": f"WITH {DAILY} SELECT * FROM daily",
    "stream_daily_transactions_append": f"""WITH {C}
        SELECT CAST(ts AS DATE) AS transaction_date, account_id, transaction_type,
          CAST(sum(CAST(amount AS DECIMAL(18, 2))) AS DOUBLE) AS total_transaction_amount,
          count(transaction_id) AS number_of_transactions
        FROM c WHERE CAST(CAST(ts AS DATE) AS TIMESTAMP) + INTERVAL 1 DAY <= (
          SELECT max(ts) - INTERVAL 10 MINUTE FROM c)
        GROUP BY ALL""",
    "stream_daily_balances_update": f"WITH {DAILY} SELECT * FROM daily",
    "stream_daily_balances_late": f"WITH {DAILY} SELECT * FROM daily",
    "stream_daily_transactions": f"WITH {TRANSACTIONS} SELECT * FROM summary",
    "history_join": HISTORY_JOIN,
    "history_join_walk": HISTORY_JOIN,
    "state_at_snapshots": f"WITH {A} " + " UNION ALL ".join(
        _state(m)
        for m in ("2024-01-09 12:00:00", "2024-01-15 00:00:00", "2024-01-15 06:30:00", "2024-01-28 00:00:00")
    ),
    "offset_gaps": f"""WITH {AUDITED} SELECT 'accounts' AS kafka_topic, p AS kafka_partition,
        previous + 1 AS first_missing, o - 1 AS last_missing, o - previous - 1 AS missing
        FROM stepped WHERE o > previous + 1""",
    "offset_audit": f"""WITH {AUDITED} SELECT 'accounts' AS kafka_topic, p AS kafka_partition,
        min(o) AS first_offset, max(o) AS last_offset, count(*) AS offsets,
        max(o) - min(o) + 1 - count(*) AS missing, CAST(sum(copies - 1) AS BIGINT) AS repeated,
        count_if(t < latest) AS out_of_order FROM stepped GROUP BY p""",
    "quality_profile": f"""WITH {A} SELECT DATE '2024-01-01' AS month, column_name,
        count_if(op <> 'x') AS rows,
        count_if(op <> 'x' AND (op <> 'd' OR column_name = 'account_id')) AS filled,
        true AS distinct_within, true AS median_within
        FROM a, unnest(['account_id', 'status', 'balance', 'last_activity_date']) AS c(column_name)
        GROUP BY column_name""",
    "key_lookup": f"""WITH {A} SELECT {CHANGE} FROM a WHERE op <> 'x' AND user_id IN (7, 77, 117)
        AND date_trunc('milliseconds', ts) BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-12'""",
    "compact_partitions": f"SELECT {BASIC}, CAST(ts AS DATE) AS event_day FROM events",
    "compact_text_partitions": """SELECT event_id,
        lpad(CAST(event_id % 12 AS VARCHAR), 3, '0') AS desk FROM events""",
}
