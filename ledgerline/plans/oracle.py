"""DuckDB SQL oracles for the catalogue: the derived views inlined as CTEs.

Each string runs on DuckDB with the given tables registered as views, and gives the rows
and column names of the Spark query of the same key.
"""

from __future__ import annotations

# Derived views, in DuckDB dialect (see sources/fixtures.py for the Spark side).
V_TRANSACTIONS = r"""transactions AS (
 SELECT o_orderkey + 1 AS transaction_id,
  regexp_replace(md5(CAST(o_custkey AS VARCHAR)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5') AS account_id,
  CAST(1 + o_orderkey % 10 AS INTEGER) AS category_id,
  CAST(o_totalprice AS DECIMAL(18,2)) AS amount,
  CASE o_orderkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'COP' END AS currency,
  CASE o_orderkey % 2 WHEN 0 THEN 'debit' ELSE 'credit' END AS transaction_type,
  CASE o_orderstatus WHEN 'O' THEN 'pending' WHEN 'F' THEN 'completed' ELSE 'failed' END AS status,
  concat('order ', CAST(o_orderkey AS VARCHAR)) AS description,
  o_orderdate AS created_at,
  o_orderdate + to_seconds(o_orderkey % 86400) AS updated_at
 FROM orders)"""

V_LEDGER = r"""ledger AS (
 SELECT concat('run-', CAST(event_id AS VARCHAR)) AS pipeline_run_id, ts AS last_watermark,
  CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' ELSE 'running' END AS status
 FROM events)"""

BOUND = "TIMESTAMP '1999-12-31 23:55:00'"
WM = "TIMESTAMP '2000-01-01 00:00:00'"


def _with(*views: str) -> str:
    return "WITH " + ",\n".join(views) + "\n"


EXTRACT = f"""SELECT transaction_id, account_id, category_id, amount, currency, transaction_type, status,
 description, created_at, updated_at FROM transactions WHERE updated_at > {BOUND}"""

CHUNKED = f"""chunked AS (
 SELECT transaction_id, updated_at,
  row_number() OVER (ORDER BY updated_at, transaction_id) AS position
 FROM transactions WHERE updated_at > {BOUND}),
chunks AS (SELECT transaction_id, updated_at, position, CAST((position - 1) // 500 AS INTEGER) AS chunk_index FROM chunked)"""

SQL = {
    "incremental_extract": _with(V_TRANSACTIONS) + EXTRACT,
    "resume_point": _with(V_LEDGER)
    + """SELECT max(last_watermark) AS last_completed_watermark,
 coalesce(max(last_watermark), TIMESTAMP '1970-01-01') - INTERVAL 5 MINUTE AS extract_since,
 coalesce(max(last_watermark), TIMESTAMP '1970-01-01') AS initial_watermark
FROM ledger WHERE status = 'completed'""",
    "resume_point_empty": _with(V_LEDGER)
    + """SELECT max(last_watermark) AS last_completed_watermark,
 coalesce(max(last_watermark), TIMESTAMP '1970-01-01') - INTERVAL 5 MINUTE AS extract_since,
 coalesce(max(last_watermark), TIMESTAMP '1970-01-01') AS initial_watermark
FROM (SELECT pipeline_run_id, last_watermark, 'running' AS status FROM ledger) WHERE status = 'completed'""",
    "chunk_assign": _with(V_TRANSACTIONS, CHUNKED) + "SELECT transaction_id, updated_at, position, chunk_index FROM chunks",
    "chunk_ledger": _with(V_TRANSACTIONS, CHUNKED)
    + f""", per_chunk AS (
 SELECT chunk_index, count(*) AS row_count, coalesce(max(updated_at), TIMESTAMP '1970-01-01') AS chunk_high_watermark
 FROM chunks GROUP BY chunk_index)
SELECT chunk_index, row_count, chunk_high_watermark,
 greatest(max(chunk_high_watermark) OVER (ORDER BY chunk_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), {WM}) AS last_watermark,
 CAST(chunk_index + 1 AS INTEGER) AS chunks_completed
FROM per_chunk""",
    "extract_summary": _with(V_TRANSACTIONS, CHUNKED)
    + f"""SELECT {BOUND} AS extract_since, count(*) AS row_count,
 CAST(coalesce(max(chunk_index) + 1, 0) AS BIGINT) AS chunk_count FROM chunks""",
}

# ------------------------------------------------------------------ validation group
WS = r"[\x{9}-\x{D}\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
PYWS = r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def strip(x: str, ws: str = WS) -> str:
    return f"regexp_replace({x}, '^{ws}+|{ws}+$', '', 'g')"


def uuid_hex(x: str) -> str:
    h = f"lower(replace(regexp_replace(replace(replace({x}, 'urn:', ''), 'uuid:', ''), '^[{{}}]+|[{{}}]+$', '', 'g'), '-', ''))"
    return h


def canonical(x: str) -> str:
    h = uuid_hex(x)
    return (f"CASE WHEN regexp_full_match({h}, '[0-9a-f]{{32}}') THEN "
            f"regexp_replace({h}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5') END")


NUMBER = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?"
PLAIN = r"[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)"
NOT_FINITE = r"(?i)[+-]?(nan|snan|inf|infinity)"
TWO_PLACES = r"[+-]?([0-9]+(\.[0-9]{0,2}0*)?|\.[0-9]{1,2}0*)"
E16 = "CAST('10000000000000000' AS DECIMAL(38,18))"

V_RAW = r"""transactions_raw AS (
 SELECT CASE WHEN transaction_id % 97 = 16 THEN -transaction_id ELSE transaction_id END AS transaction_id,
  CASE WHEN transaction_id % 97 <> 13 THEN account_id END AS account_id,
  CAST(CASE WHEN transaction_id % 97 = 6 THEN 0 ELSE category_id END AS INTEGER) AS category_id,
  CASE transaction_id % 97 WHEN 0 THEN '0.00' WHEN 7 THEN '1.005' WHEN 10 THEN '100.500'
    WHEN 11 THEN '12345678901234567.00' ELSE CAST(amount AS VARCHAR) END AS amount,
  CASE transaction_id % 97 WHEN 2 THEN ' usd ' WHEN 3 THEN 'US' WHEN 12 THEN '$$$' ELSE currency END AS currency,
  CASE WHEN transaction_id % 97 = 5 THEN concat(' ', transaction_type) ELSE transaction_type END AS transaction_type,
  CASE WHEN transaction_id % 97 = 1 THEN upper(status) ELSE status END AS status,
  CASE transaction_id % 97 WHEN 4 THEN repeat('x', 256) WHEN 8 THEN NULL
    WHEN 9 THEN concat('  ', description, '  ') ELSE description END AS description,
  CASE WHEN transaction_id % 97 <> 14 THEN created_at END AS created_at,
  CASE WHEN transaction_id % 97 <> 15 THEN updated_at END AS updated_at
 FROM transactions)"""

V_TEXT = r"""transactions_text AS (
 SELECT CASE transaction_id % 89 WHEN 1 THEN concat(CAST(transaction_id AS VARCHAR), '.5')
    WHEN 11 THEN CAST(9000000000000000000 + transaction_id AS VARCHAR)
    WHEN 12 THEN concat(repeat('0', 20), CAST(transaction_id AS VARCHAR))
    WHEN 13 THEN concat(repeat('9', 19), CAST(transaction_id AS VARCHAR))
    ELSE CAST(transaction_id AS VARCHAR) END AS transaction_id,
  CASE transaction_id % 89 WHEN 2 THEN 'not-a-uuid' WHEN 3 THEN upper(replace(account_id, '-', ''))
    WHEN 4 THEN concat('{', account_id, '}') ELSE account_id END AS account_id,
  CAST(category_id AS VARCHAR) AS category_id,
  CASE transaction_id % 89 WHEN 5 THEN 'abc' WHEN 6 THEN NULL ELSE CAST(amount AS VARCHAR) END AS amount,
  CASE WHEN transaction_id % 89 = 7 THEN NULL ELSE currency END AS currency,
  transaction_type, status, description,
  CASE WHEN transaction_id % 89 = 8 THEN 'yesterday' ELSE CAST(created_at AS VARCHAR) END AS created_at,
  CASE transaction_id % 89 WHEN 9 THEN 'bad'
    WHEN 10 THEN concat(substring(CAST(updated_at AS VARCHAR), 1, 10), 'T12:00:00Z')
    WHEN 14 THEN concat(substring(CAST(updated_at AS VARCHAR), 1, 10), 'T21:30:00-05:00')
    WHEN 15 THEN concat(substring(CAST(updated_at AS VARCHAR), 1, 10), ' 03:00+0530')
    WHEN 16 THEN replace(substring(CAST(updated_at AS VARCHAR), 1, 10), '-', '')
    ELSE CAST(updated_at AS VARCHAR) END AS updated_at,
  CASE transaction_id % 89 WHEN 9 THEN NULL
    WHEN 10 THEN date_trunc('day', updated_at) + INTERVAL 12 HOUR
    WHEN 14 THEN date_trunc('day', updated_at) + INTERVAL '26 hours 30 minutes'
    WHEN 15 THEN date_trunc('day', updated_at) - INTERVAL '2 hours 30 minutes'
    WHEN 16 THEN date_trunc('day', updated_at) ELSE updated_at END AS utc
 FROM transactions)"""

# Rule evaluation of the transaction contract over a raw view with text amounts.
V_EVAL = f"""ev0 AS (
 SELECT *, {strip('amount')} AS a_s FROM transactions_raw),
ev1 AS (
 SELECT *, CASE WHEN regexp_full_match(a_s, '{NUMBER}') THEN TRY_CAST(a_s AS DECIMAL(38,18)) END AS a_v FROM ev0),
ev AS (
 SELECT transaction_id, {canonical('account_id')} AS n_account_id,
  CASE WHEN category_id = floor(category_id) THEN TRY_CAST(category_id AS INTEGER) END AS n_category_id,
  TRY_CAST(a_v AS DECIMAL(18,2)) AS n_amount,
  upper({strip('currency', PYWS)}) AS n_currency,
  transaction_type, status, {strip('description')} AS n_description, created_at, updated_at,
  amount, currency, description,
  concat_ws(',',
   CASE WHEN transaction_id < 1 THEN 'transaction_id' END,
   CASE WHEN account_id IS NULL THEN 'account_id' END,
   CASE WHEN category_id IS NULL OR category_id < 1 THEN 'category_id' END,
   CASE WHEN regexp_full_match(a_s, '{NOT_FINITE}') THEN 'amount_not_finite'
        WHEN a_v IS NULL OR abs(a_v) >= {E16} THEN 'amount_digits'
        WHEN NOT (CASE WHEN regexp_full_match(a_s, '{PLAIN}') THEN regexp_full_match(a_s, '{TWO_PLACES}')
                  ELSE a_v = round(a_v, 2) END) THEN 'amount_scale'
        WHEN a_v = 0 THEN 'amount_zero' END,
   CASE WHEN length({strip('currency', PYWS)}) <> 3 OR length(upper({strip('currency', PYWS)})) <> 3 THEN 'currency' END,
   CASE WHEN transaction_type IS NULL OR transaction_type NOT IN ('debit', 'credit') THEN 'transaction_type' END,
   CASE WHEN status IS NULL OR status NOT IN ('pending', 'completed', 'failed') THEN 'status' END,
   CASE WHEN length({strip('description')}) > 255 THEN 'description' END,
   CASE WHEN created_at IS NULL THEN 'created_at' END,
   CASE WHEN updated_at IS NULL THEN 'updated_at' END) AS errors
 FROM ev1)"""

NORMALISED = """SELECT transaction_id, n_account_id AS account_id, n_category_id AS category_id, n_amount AS amount,
 n_currency AS currency, transaction_type, status, n_description AS description, created_at, updated_at FROM ev"""

RAW_CHUNKS = """raw_chunks AS (
 SELECT *, CAST((row_number() OVER (ORDER BY updated_at NULLS FIRST, transaction_id) - 1) // 500 AS INTEGER) AS chunk_index
 FROM transactions_raw)"""

TS_TEXT = "TRY_CAST(regexp_replace({x}, '[Zz]$', '') AS TIMESTAMP)"

ACCOUNTS = r"""accounts AS (
 SELECT regexp_replace(md5(CAST(c_custkey AS VARCHAR)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5') AS account_id,
  concat('customer ', lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS account_name,
  CASE c_custkey % 3 WHEN 0 THEN 'savings' WHEN 1 THEN 'checking' ELSE 'investment' END AS account_type,
  c_name AS owner_name,
  CASE c_custkey % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'EUR' ELSE 'COP' END AS currency,
  CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
  c_custkey % 20 <> 0 AS is_active,
  TIMESTAMP '2024-01-01 00:00:00' AS created_at,
  TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey % 86400) AS updated_at
 FROM customer)"""

CATEGORIES = """categories AS (
 SELECT CAST(n_nationkey + 1 AS INTEGER) AS category_id, lower(n_name) AS name,
  CAST(NULL AS VARCHAR) AS description, TIMESTAMP '2024-01-01 00:00:00' AS updated_at
 FROM nation)"""

ACCOUNTS_RAW = """accounts_raw AS (
 SELECT CASE WHEN r = 1 THEN 'no-uuid' ELSE account_id END AS account_id, CASE WHEN r <> 2 THEN account_name END AS account_name,
  CASE WHEN r = 3 THEN upper(account_type) ELSE account_type END AS account_type,
  CASE WHEN r = 4 THEN repeat('o', 101) ELSE owner_name END AS owner_name,
  CASE WHEN r = 5 THEN 'US' ELSE currency END AS currency,
  CASE r WHEN 6 THEN '12345678901234567.00' WHEN 7 THEN '1.005' ELSE CAST(balance AS VARCHAR) END AS balance,
  CASE WHEN r <> 8 THEN is_active END AS is_active, CASE WHEN r <> 9 THEN created_at END AS created_at,
  CASE WHEN r <> 10 THEN updated_at END AS updated_at
 FROM (SELECT *, CAST(replace(account_name, 'customer ', '') AS BIGINT) % 41 AS r FROM accounts))"""

CATEGORIES_RAW = """categories_raw AS (
 SELECT CASE WHEN category_id = 4 THEN 0 ELSE category_id END AS category_id,
  CASE category_id WHEN 6 THEN NULL WHEN 8 THEN repeat(name, 51) ELSE name END AS name,
  CASE WHEN category_id = 10 THEN repeat('d', 201) ELSE description END AS description,
  CASE WHEN category_id <> 12 THEN updated_at END AS updated_at
 FROM categories)"""

SQL.update({
    "pack_unpack": "SELECT event_id, ts, user_id, event_type, value, props FROM events",
    "normalise_rows": _with(V_TRANSACTIONS, V_RAW, V_EVAL) + NORMALISED,
    "rule_errors": _with(V_TRANSACTIONS, V_RAW, V_EVAL) + "SELECT errors, count(*) AS row_count FROM ev GROUP BY errors",
    "valid_rows": _with(V_TRANSACTIONS, V_RAW, V_EVAL) + NORMALISED + " WHERE errors = ''",
    "dead_letter": _with(V_TRANSACTIONS, V_RAW, RAW_CHUNKS)
    + ", " + V_EVAL.replace("FROM transactions_raw)", "FROM raw_chunks)").replace(
        "amount, currency, description,", "amount, currency, description, chunk_index,")
    + """
SELECT 'fixture-run' AS pipeline_run_id, chunk_index, transaction_id, replace(errors, ',', '; ') AS error_message,
 amount AS payload_amount, currency AS payload_currency, transaction_type AS payload_transaction_type,
 status AS payload_status, description AS payload_description, updated_at AS payload_updated_at
FROM ev WHERE errors <> ''""",
    "fatal_rows": _with(V_TRANSACTIONS, V_TEXT)
    + f"""SELECT * FROM (
 SELECT transaction_id, concat_ws(',',
  CASE WHEN transaction_id IS NULL OR NOT regexp_full_match({strip('transaction_id')}, '[+-]?[0-9]+')
       OR TRY_CAST({strip('transaction_id')} AS BIGINT) IS NULL THEN 'transaction_id_type' END,
  CASE WHEN account_id IS NOT NULL AND NOT regexp_full_match({uuid_hex('account_id')}, '[0-9a-f]{{32}}') THEN 'account_id_format' END,
  CASE WHEN amount IS NULL OR (NOT regexp_full_match({strip('amount')}, '{NOT_FINITE}')
       AND NOT regexp_full_match({strip('amount')}, '{NUMBER}')) THEN 'amount_type' END,
  CASE WHEN currency IS NULL THEN 'currency_type' END,
  CASE WHEN created_at IS NOT NULL AND {TS_TEXT.format(x='created_at')} IS NULL THEN 'created_at_format' END,
  CASE WHEN updated_at IS NOT NULL AND utc IS NULL THEN 'updated_at_format' END) AS fatal
 FROM transactions_text) WHERE fatal <> ''""",
    "text_time_extract": _with(V_TRANSACTIONS, V_TEXT)
    + f"SELECT transaction_id, updated_at, utc FROM transactions_text WHERE utc > {BOUND} OR utc IS NULL",
    "extra_keys": """WITH e AS (SELECT event_type, CASE event_id % 50 WHEN 1 THEN '{"k": 1, "extra": 2}' WHEN 2 THEN '{"extra": 2}'
 WHEN 3 THEN '{}' ELSE props END AS props FROM events) SELECT event_type, count(*) AS row_count,
 count_if(len(list_filter(json_keys(props), lambda k: k NOT IN ('k'))) > 0) AS unknown_key_rows,
 count_if(len(list_filter(['k'], lambda k: NOT list_contains(json_keys(props), k))) > 0) AS missing_key_rows
FROM e GROUP BY event_type""",
    "account_contract": _with(ACCOUNTS, ACCOUNTS_RAW)
    + f"""SELECT account_id, {strip('account_name')} AS account_name,
 upper({strip('currency', PYWS)}) AS currency, TRY_CAST(TRY_CAST(balance AS DECIMAL(38,18)) AS DECIMAL(18,2)) AS balance, is_active,
 concat_ws(',',
  CASE WHEN currency IS NULL THEN 'currency_type' END,
  CASE WHEN account_id IS NULL OR NOT regexp_full_match({uuid_hex('account_id')}, '[0-9a-f]{{32}}') THEN 'account_id' END,
  CASE WHEN account_name IS NULL OR length({strip('account_name')}) > 100 THEN 'account_name' END,
  CASE WHEN account_type IS NULL OR account_type NOT IN ('savings', 'checking', 'investment') THEN 'account_type' END,
  CASE WHEN owner_name IS NULL OR length({strip('owner_name')}) > 100 THEN 'owner_name' END,
  CASE WHEN length({strip('currency', PYWS)}) <> 3 OR length(upper({strip('currency', PYWS)})) <> 3 THEN 'currency' END,
  CASE WHEN balance IS NULL THEN 'balance' WHEN abs(TRY_CAST(balance AS DECIMAL(38,18))) >= {E16} THEN 'balance_digits'
       WHEN NOT regexp_full_match(balance, '{TWO_PLACES}') THEN 'balance_scale' END,
  CASE WHEN is_active IS NULL THEN 'is_active' END,
  CASE WHEN created_at IS NULL THEN 'created_at' END,
  CASE WHEN updated_at IS NULL THEN 'updated_at' END) AS errors
FROM accounts_raw""",
    "category_contract": _with(CATEGORIES, CATEGORIES_RAW)
    + f"""SELECT category_id, {strip('name')} AS name, concat_ws(',',
  CASE WHEN category_id IS NULL OR category_id < 1 THEN 'category_id' END,
  CASE WHEN name IS NULL OR length({strip('name')}) > 50 THEN 'name' END,
  CASE WHEN length({strip('description')}) > 200 THEN 'description' END,
  CASE WHEN updated_at IS NULL THEN 'updated_at' END) AS errors
FROM categories_raw""",
})

# ------------------------------------------------------------------ merge / constraints / change set
EVENT_COLS = "event_id, ts, user_id, event_type, value, props"


def _newest(where: str, desc: bool = True) -> str:
    d = "DESC" if desc else "ASC"
    return (f"SELECT {EVENT_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts {d}, event_id {d}) AS rn "
            f"FROM events WHERE {where}) WHERE rn = 1")


def _upsert_sql(cut: str) -> str:
    return (f"WITH base AS ({_newest(f'ts <= {cut}')}), changes AS (SELECT {EVENT_COLS} FROM events WHERE ts > {cut}), "
            f"latest AS ({_newest(f'ts > {cut}')})\n"
            f"SELECT {EVENT_COLS} FROM base WHERE user_id NOT IN (SELECT user_id FROM changes) "
            f"UNION ALL SELECT {EVENT_COLS} FROM latest")


def _outcome_sql(cut: str) -> str:
    return (f"SELECT {cut} AS cut, outcome, count(*) AS row_count FROM (SELECT CASE WHEN c.user_id IS NOT NULL AND b.user_id IS NOT NULL "
            f"THEN 'update' WHEN c.user_id IS NOT NULL THEN 'insert' ELSE 'keep' END AS outcome FROM "
            f"(SELECT DISTINCT user_id FROM events WHERE ts <= {cut}) b FULL OUTER JOIN "
            f"(SELECT DISTINCT user_id FROM events WHERE ts > {cut}) c ON b.user_id = c.user_id) GROUP BY outcome")


CUT_SQL = ("TIMESTAMP '2024-01-01 01:00:00'", "TIMESTAMP '2024-01-02 00:00:00'", "TIMESTAMP '2024-01-30 12:00:00'")
NOW_SQL = "TIMESTAMP '2024-02-01 00:00:00'"

PENDING_KEYS = """pending_keys AS (SELECT transaction_id FROM transactions WHERE status = 'pending'
 ORDER BY created_at, transaction_id LIMIT 200)"""

UPDATED = f"""updated AS (SELECT transaction_id, account_id, category_id, amount, currency, transaction_type,
 CASE WHEN transaction_id IN (SELECT transaction_id FROM pending_keys) THEN 'completed' ELSE status END AS status,
 description, created_at,
 CASE WHEN transaction_id IN (SELECT transaction_id FROM pending_keys) THEN {NOW_SQL} ELSE updated_at END AS updated_at
 FROM transactions)"""

INSERTS = f"""acc AS (SELECT account_id, row_number() OVER (ORDER BY account_id) AS rn FROM accounts),
inserts AS (SELECT (SELECT max(transaction_id) FROM transactions) + e.event_id + 1 AS transaction_id, acc.account_id,
  CAST(1 + (e.event_id + 1) % 25 AS INTEGER) AS category_id,
  CAST(round(CAST(abs(e.value) AS DECIMAL(18,2)) + 1, 2) AS DECIMAL(18,2)) AS amount,
  (['CHF', 'USD', 'JPY', 'EUR'])[1 + (e.event_id + 1) % 4] AS currency,
  CASE WHEN e.event_type = 'purchase' THEN 'debit' ELSE 'credit' END AS transaction_type,
  'completed' AS status,
  concat(e.event_type, ' ', chr(CAST(65 + (e.event_id + 1) % 26 AS INTEGER)), lpad(CAST(e.event_id + 1 AS VARCHAR), 9, '0')) AS description,
  {NOW_SQL} AS created_at, {NOW_SQL} AS updated_at
 FROM events e JOIN acc ON acc.rn = 1 + (e.event_id + 1) % (SELECT count(*) FROM accounts)),
changed AS (SELECT * FROM updated UNION ALL SELECT * FROM inserts)"""

_CONSTRAINTS = [
    ("transaction_id_not_null", "transaction_id IS NULL"),
    ("account_id_not_null", "account_id IS NULL"),
    ("category_id_not_null", "category_id IS NULL"),
    ("amount_not_null", "amount IS NULL"),
    ("amount_not_zero", "TRY_CAST(amount AS DECIMAL(38,18)) = 0"),
    ("currency_not_null", "currency IS NULL"),
    ("currency_length", "length(currency) > 3"),
    ("transaction_type_not_null", "transaction_type IS NULL"),
    ("transaction_type_in", "transaction_type NOT IN ('debit', 'credit')"),
    ("transaction_type_length", "length(transaction_type) > 10"),
    ("status_not_null", "status IS NULL"),
    ("status_in", "status NOT IN ('pending', 'completed', 'failed')"),
    ("status_length", "length(status) > 10"),
    ("description_length", "length(description) > 255"),
    ("created_at_not_null", "created_at IS NULL"),
    ("updated_at_not_null", "updated_at IS NULL"),
]

def _null(*columns: str) -> list[tuple[str, str]]:
    return [(f"{c}_not_null", f"{c} IS NULL") for c in columns]


def _long(**limits: int) -> list[tuple[str, str]]:
    return [(f"{c}_length", f"length({c}) > {n}") for c, n in limits.items()]


# The reporting rows before any rule drops them.
REPORTING = f"""reporting AS (SELECT transaction_id, n_account_id AS account_id, n_category_id AS category_id, n_amount AS amount,
 n_currency AS currency, transaction_type, status, n_description AS description, created_at, updated_at,
 updated_at AS source_updated_at, {NOW_SQL} AS loaded_at FROM ev)"""

_ALL_CONSTRAINTS = [
    ("transactions", "transactions_raw", _CONSTRAINTS),
    ("accounts", "accounts_raw",
     _null("account_id", "account_name", "account_type", "owner_name", "currency", "balance", "is_active", "created_at", "updated_at")
     + [("account_type_in", "account_type NOT IN ('savings', 'checking', 'investment')")]
     + _long(account_name=100, account_type=20, owner_name=100, currency=3)),
    ("categories", "categories_raw", _null("category_id", "name", "updated_at") + _long(name=50, description=200)),
    ("financial_records", "reporting",
     _null("transaction_id", "account_id", "category_id", "amount", "currency", "transaction_type", "status", "created_at",
           "updated_at", "source_updated_at", "loaded_at")
     + _long(currency=3, transaction_type=10, status=10, description=255)),
    ("etl_checkpoints", "ledger",
     _null("pipeline_run_id", "last_watermark", "status") + [("status_in", "status NOT IN ('running', 'completed', 'failed')")]),
]

TXN_COLS = "transaction_id, account_id, category_id, amount, currency, transaction_type, status, description, created_at, updated_at"

SQL.update({
    "latest_per_key": _newest("TRUE"),
    "upsert_table": _upsert_sql(CUT_SQL[1]),
    "upsert_outcome": "\nUNION ALL\n".join(_outcome_sql(c) for c in CUT_SQL),
    "upsert_replay": _upsert_sql(CUT_SQL[2]),
    "upsert_stale_row": f"""WITH o AS ({_newest('TRUE', desc=False)}), n AS ({_newest('TRUE')})
SELECT o.user_id, o.event_id, o.ts, CASE WHEN o.ts >= n.ts THEN o.event_id ELSE n.event_id END AS guarded_event_id
FROM o JOIN n ON o.user_id = n.user_id""",
    "insert_if_absent": _with(CATEGORIES)
    + f""", offered AS (SELECT CAST(n_nationkey + 1 AS INTEGER) AS category_id, lower(n_name) AS name, {NOW_SQL} AS updated_at FROM nation)
, held AS (SELECT * FROM categories WHERE category_id <= 10)
SELECT category_id, name, updated_at FROM held
UNION ALL SELECT category_id, name, updated_at FROM offered WHERE name NOT IN (SELECT name FROM held)""",
    "unique_check": """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "foreign_key_check": _with(V_TRANSACTIONS, ACCOUNTS, CATEGORIES)
    + r""", t AS (SELECT transaction_id, category_id * 3 AS category_id, CASE WHEN transaction_id % 50 = 0 THEN
 regexp_replace(md5(CAST(-transaction_id AS VARCHAR)), '^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5') ELSE account_id END AS account_id
 FROM transactions)
SELECT 'category_fk' AS constraint_name, transaction_id, CAST(category_id AS VARCHAR) AS missing_key FROM t
 WHERE category_id IS NOT NULL AND category_id NOT IN (SELECT category_id FROM categories)
UNION ALL SELECT 'account_fk', transaction_id, account_id FROM t
 WHERE account_id IS NOT NULL AND account_id NOT IN (SELECT account_id FROM accounts)""",
    "check_constraints": _with(V_TRANSACTIONS, V_RAW, V_EVAL, ACCOUNTS, ACCOUNTS_RAW, CATEGORIES, CATEGORIES_RAW, V_LEDGER, REPORTING)
    + "\nUNION ALL ".join(
        f"SELECT '{t}' AS table_name, '{n}' AS constraint_name, count_if({c}) AS violations FROM {view}"
        for t, view, rows in _ALL_CONSTRAINTS for n, c in rows),
    "oldest_pending_update": _with(V_TRANSACTIONS, PENDING_KEYS, UPDATED) + "SELECT * FROM updated",
    "apply_change_set": _with(V_TRANSACTIONS, ACCOUNTS, PENDING_KEYS, UPDATED, INSERTS) + "SELECT * FROM changed",
    "newest_n_transfer": _with(V_TRANSACTIONS)
    + f"""SELECT {TXN_COLS}, updated_at AS source_updated_at, {NOW_SQL} AS loaded_at FROM transactions
ORDER BY updated_at DESC, transaction_id DESC LIMIT 1000""",
    "newest_n_rejects": _with(V_TRANSACTIONS, V_RAW, V_EVAL)
    + """SELECT CAST(transaction_id AS VARCHAR) AS transaction_id, errors AS codes FROM (
 SELECT * FROM ev ORDER BY updated_at DESC NULLS LAST, transaction_id DESC LIMIT 1000) WHERE errors <> ''""",
    "load_projection": _with(V_TRANSACTIONS, V_RAW, V_EVAL)
    + f"""SELECT transaction_id, n_account_id AS account_id, n_category_id AS category_id, n_amount AS amount,
 n_currency AS currency, transaction_type, status, n_description AS description, created_at, updated_at,
 updated_at AS source_updated_at, {NOW_SQL} AS loaded_at FROM ev WHERE errors = ''""",
    "table_counts": _with(V_TRANSACTIONS, ACCOUNTS, CATEGORIES, PENDING_KEYS, UPDATED, INSERTS)
    + f"""SELECT 'accounts' AS table_name, count(*) AS total FROM accounts
UNION ALL SELECT 'categories', count(*) FROM categories
UNION ALL SELECT 'transactions', count(*) FROM changed
UNION ALL SELECT 'recent_transactions', count(*) FROM changed WHERE updated_at >= {NOW_SQL} - INTERVAL 1 MINUTE""",
    # by what happened to each row, not by joining it with the target
    "late_rows": _with(V_TRANSACTIONS, V_RAW, V_EVAL)
    + """, m AS (SELECT transaction_id, updated_at, errors = '' AS valid, ((transaction_id % 11) + 11) % 11 = 3 AS was_older,
  updated_at + to_days(CAST(((transaction_id % 7) + 7) % 7 AS INTEGER)) <= TIMESTAMP '2000-06-01 00:00:00' AS seen FROM ev),
bound AS (SELECT max(updated_at) - INTERVAL 5 MINUTE AS b FROM m WHERE seen)
SELECT transaction_id, updated_at FROM m
WHERE updated_at <= (SELECT b FROM bound) AND (NOT seen OR (valid AND was_older))""",
})

# ------------------------------------------------------------------ pipeline, ledger, stream
E2E = f"""s1 AS (SELECT * FROM transactions_raw WHERE updated_at <= TIMESTAMP '2000-01-01 00:00:00'),
since2 AS (SELECT max(updated_at) - INTERVAL 5 MINUTE AS b FROM s1),
e2 AS (SELECT * FROM transactions_raw WHERE updated_at > (SELECT b FROM since2))"""

LOADED = f"""SELECT transaction_id, n_account_id AS account_id, n_category_id AS category_id, n_amount AS amount,
 n_currency AS currency, transaction_type, status, n_description AS description, created_at, updated_at,
 updated_at AS source_updated_at, {{loaded_at}} AS loaded_at FROM ev WHERE errors = ''"""

SQL.update({
    "pipeline_end_to_end": _with(V_TRANSACTIONS, V_RAW, V_EVAL, E2E)
    + LOADED.format(loaded_at="CASE WHEN updated_at > (SELECT b FROM since2) THEN TIMESTAMP '2024-02-02 00:00:00' "
                              "ELSE TIMESTAMP '2024-02-01 00:00:00' END"),
    "run_metrics": _with(V_TRANSACTIONS, V_RAW, V_EVAL, E2E)
    + """, m AS (
 SELECT 'run-1' AS pipeline_run_id, 0 AS staging_chunks, 0 AS validated_chunks,
  (SELECT count(*) FROM ev WHERE errors <> '' AND updated_at <= TIMESTAMP '2000-01-01 00:00:00') AS dead_letter_rows,
  (SELECT ceil(count(*) / 500) FROM s1) AS chunks_completed, (SELECT ceil(count(*) / 500) FROM s1) AS total_chunks,
  'completed' AS checkpoint_status
 UNION ALL
 SELECT 'run-2', (SELECT ceil(count(*) / 500) FROM e2), (SELECT ceil(count(*) / 500) FROM e2),
  (SELECT count(*) FROM ev WHERE errors <> '' AND updated_at > (SELECT b FROM since2)),
  (SELECT ceil(count(*) / 500) FROM e2), (SELECT ceil(count(*) / 500) FROM e2), 'running'
 UNION ALL
 SELECT 'run-unknown', 0, 0, 0, 0, 0, NULL)
SELECT pipeline_run_id, CAST(staging_chunks AS BIGINT) AS staging_chunks, CAST(validated_chunks AS BIGINT) AS validated_chunks,
 CAST(dead_letter_rows AS BIGINT) AS dead_letter_rows, CAST(chunks_completed AS BIGINT) AS chunks_completed,
 CAST(total_chunks AS BIGINT) AS total_chunks, checkpoint_status FROM m""",
    "ledger_state": """WITH ev AS (
 SELECT concat('run-', CAST(user_id AS VARCHAR)) AS pipeline_run_id, event_id AS seq, ts AS event_at,
  CASE event_type WHEN 'signup' THEN 'start' WHEN 'view' THEN 'total' WHEN 'click' THEN 'advance' ELSE 'finish' END AS event,
  CASE WHEN event_type IN ('signup', 'click') THEN ts END AS last_watermark,
  CASE WHEN event_type = 'click' THEN 1 END AS chunks_delta,
  CASE WHEN event_type = 'view' THEN CAST(floor(value) AS INTEGER) END AS total_chunks,
  CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' END AS status
 FROM events),
fs AS (SELECT pipeline_run_id, min(seq) AS first_start FROM ev WHERE event = 'start' GROUP BY pipeline_run_id),
live AS (SELECT ev.*, fs.first_start FROM ev JOIN fs ON ev.pipeline_run_id = fs.pipeline_run_id WHERE seq >= first_start)
SELECT pipeline_run_id,
 greatest(max(CASE WHEN seq = first_start THEN last_watermark END),
          coalesce(max(CASE WHEN event = 'advance' THEN last_watermark END), max(CASE WHEN seq = first_start THEN last_watermark END))) AS last_watermark,
 CAST(coalesce(sum(CASE WHEN event = 'advance' THEN chunks_delta END), 0) AS INTEGER) AS chunks_completed,
 arg_max(total_chunks, CASE WHEN event = 'total' THEN seq END) AS total_chunks,
 arg_max(CASE WHEN event = 'start' THEN 'running' WHEN event = 'finish' THEN status END,
         CASE WHEN event IN ('start', 'finish') THEN seq END) AS status,
 max(CASE WHEN seq = first_start THEN event_at END) AS started_at,
 max(event_at) AS updated_at
FROM live GROUP BY pipeline_run_id""",
    "stream_upsert": _with(V_TRANSACTIONS, V_RAW, V_EVAL) + LOADED.format(loaded_at="TIMESTAMP '2024-02-01 00:00:00'"),
})

SQL["event_time_stream"] = _with(V_TRANSACTIONS) + """, a AS (
 SELECT transaction_id, updated_at, unnest(CASE WHEN ((transaction_id % 8) + 8) % 8 = 0 THEN [0, 400] ELSE [0] END)
  + date_diff('day', DATE '1992-01-01', CAST(updated_at AS DATE))
  + CASE WHEN ((transaction_id % 9) + 9) % 9 = 0 THEN 700 ELSE 0 END AS day FROM transactions),
f AS (SELECT *, CAST(floor(day / 400) AS BIGINT) AS file FROM a),
m AS (SELECT file, max(updated_at) AS newest FROM f GROUP BY file),
w AS (SELECT file, max(newest) OVER (ORDER BY file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL 365 DAY AS passed FROM m)
SELECT transaction_id, updated_at, coalesce(updated_at <= passed, false) AS late FROM f JOIN w USING (file)"""

SQL["reconcile_tables"] = _with(V_TRANSACTIONS) + """, t AS (
 SELECT transaction_id, account_id, category_id, CASE WHEN transaction_id % 103 = 0 THEN amount + 1 ELSE amount END AS amount, currency,
  transaction_type, status, CASE WHEN transaction_id % 107 <> 0 THEN description END AS description, created_at, updated_at
 FROM transactions WHERE transaction_id % 101 <> 0
 UNION ALL SELECT -transaction_id, * EXCLUDE (transaction_id) FROM transactions WHERE transaction_id % 1000 < 3)
SELECT coalesce(s.transaction_id, t.transaction_id) AS transaction_id,
 CASE WHEN t.transaction_id IS NULL THEN 'missing' WHEN s.transaction_id IS NULL THEN 'extra' ELSE 'changed' END AS outcome
FROM transactions s FULL JOIN t ON s.transaction_id = t.transaction_id
WHERE s.transaction_id IS NULL OR t.transaction_id IS NULL OR s.amount <> t.amount OR s.description IS DISTINCT FROM t.description"""

SQL["props_paths"] = """WITH e AS (SELECT CASE event_id % 50 WHEN 1 THEN '{"k": 1, "extra": 2}' WHEN 2 THEN '{"extra": 2}' WHEN 3 THEN '{}'
 WHEN 4 THEN '{"k": "7", "tags": ["a", 1, {"z": null}], "at": {"x": 1.5, "y": {"w": true}}}' WHEN 5 THEN '{"k": true}'
 WHEN 6 THEN '{"k":' WHEN 7 THEN NULL ELSE props END AS props FROM events),
d AS (SELECT props, count(*) AS n FROM e GROUP BY props),
t AS (SELECT n, j.fullkey, j.type FROM (SELECT * FROM d WHERE json_valid(props)) v, json_tree(v.props) j),
u AS (SELECT regexp_replace(fullkey, '[[][0-9]+[]]', '[]', 'g') AS path,
 CASE type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean'
  WHEN 'NULL' THEN 'null' ELSE 'number' END AS type, n FROM t
 UNION ALL SELECT '$', CASE WHEN props IS NULL THEN 'missing' ELSE 'malformed' END, n FROM d WHERE props IS NULL OR NOT json_valid(props))
SELECT path, type, CAST(sum(n) AS BIGINT) AS "values" FROM u GROUP BY path, type"""
