"""Independent SQL statements of every registered query, for DuckDB.

Each query is a final SELECT over named CTEs; ``build(select, *ctes)`` pulls
in the CTEs it needs (and theirs) in dependency order. The driver tables
(events, orders, supplier, ...) are pre-registered views.
"""

from __future__ import annotations

# name -> (dependencies, body)
CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, deps: tuple[str, ...], body: str) -> None:
    CTES[name] = (deps, body)


def build(select: str, *needed: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][0]:
            visit(d)
        order.append(n)

    for n in needed:
        visit(n)
    select = select.strip()
    if not order:
        return select
    parts = ",\n".join(f"{n} AS (\n{CTES[n][1].strip()}\n)" for n in order)
    if select[:5].upper() == "WITH ":  # merge the statement's own CTEs
        return f"WITH {parts},\n{select[5:]}"
    return f"WITH {parts}\n{select}"


# -- raw tables ----------------------------------------------------------------
cte("raw_trans", (), """
SELECT
  CASE WHEN event_id % 401 <> 0 THEN
    'T' || CAST(event_id - CASE WHEN event_id % 11 = 5 AND event_id >= 1000 THEN 1000 ELSE 0 END AS VARCHAR) END AS trans_num_raw,
  CASE WHEN event_id % 41 = 0 THEN strftime(ts, '%Y-%m-%d')
       WHEN event_id % 3 = 0 THEN strftime(ts, '%d-%m-%Y %H:%M')
       ELSE strftime(ts, '%d-%m-%Y %H:%M:%S') END AS trans_date_raw,
  CASE WHEN event_id % 211 <> 0 THEN CAST(user_id AS VARCHAR) END AS card_num_raw,
  CASE WHEN event_id % 37 = 0 THEN 'abc'
       WHEN event_id % 43 = 0 THEN NULL
       ELSE CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) END AS amount_raw,
  CASE WHEN event_id % 307 <> 0 THEN 'M' || CAST(event_id % 120 AS VARCHAR) END AS merchant_raw,
  event_type AS category_raw,
  CASE WHEN event_id % 31 = 0 THEN 'maybe' WHEN event_id % 5 = 0 THEN 'on'
       WHEN event_id % 7 = 0 THEN 'TRUE' ELSE '0' END AS is_fraud_raw,
  'trans_' || CAST(event_id // 1000 AS VARCHAR) || '.csv' AS meta_filename,
  CAST(event_id % 1000 + 1 AS BIGINT) AS meta_file_row_number,
  date_trunc('hour', ts) AS meta_load_ts
FROM events""")

cte("raw_clients", (), """
SELECT
  CASE WHEN o_orderkey % 331 <> 0 THEN CAST(o_custkey // 10 AS VARCHAR) END AS card_num_raw,
  'F' || CAST(o_orderkey % 97 AS VARCHAR) AS first_name_raw,
  'L' || CAST(o_orderkey % 89 AS VARCHAR) AS last_name_raw,
  o_orderstatus AS gender_raw,
  CASE WHEN o_orderkey % 53 = 0 THEN 'n/a' ELSE strftime(o_orderdate, '%d-%m-%Y') END AS date_birth_raw,
  o_orderpriority AS job_raw,
  CAST(o_orderkey % 1000 AS VARCHAR) || ' Main St' AS street_raw,
  'City' || CAST(o_orderkey % 50 AS VARCHAR) AS city_raw,
  'S' || CAST(o_orderkey % 20 AS VARCHAR) AS state_raw,
  'clients_' || CAST(o_orderkey // 1000 AS VARCHAR) || '.csv' AS meta_filename,
  CAST(o_orderkey % 1000 + 1 AS BIGINT) AS meta_file_row_number,
  TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST((o_orderkey * 7) % 25 AS INTEGER)) AS meta_load_ts
FROM orders""")

cte("raw_merch", (), """
SELECT
  CASE WHEN s_suppkey % 23 <> 0 THEN 'M' || CAST(s_suppkey % 80 AS VARCHAR) END AS merchant_raw,
  CASE WHEN s_suppkey % 17 = 0 THEN '1000.0'
       ELSE CAST(CAST(CAST(s_acctbal AS DECIMAL(18,2)) / 100 AS DECIMAL(18,4)) AS VARCHAR) END AS merchant_lat_raw,
  CAST(CAST(CAST(s_acctbal AS DECIMAL(18,2)) / -50 AS DECIMAL(18,4)) AS VARCHAR) AS merchant_long_raw,
  'merch_' || CAST(s_suppkey // 100 AS VARCHAR) || '.csv' AS meta_filename,
  CAST(s_suppkey % 100 + 1 AS BIGINT) AS meta_file_row_number,
  TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(s_suppkey % 3 AS INTEGER)) AS meta_load_ts
FROM supplier""")

# -- staging -------------------------------------------------------------------
_BOOL = """CASE WHEN lower(trim({c})) IN ('true', 't', 'yes', 'y', 'on', '1') THEN TRUE
       WHEN lower(trim({c})) IN ('false', 'f', 'no', 'n', 'off', '0') THEN FALSE END"""

cte("stg_typed", ("raw_trans",), f"""
SELECT
  trans_num_raw AS trans_num,
  COALESCE(try_strptime(trans_date_raw, '%d-%m-%Y %H:%M:%S'),
           try_strptime(trans_date_raw, '%d-%m-%Y %H:%M')) AS trans_ts,
  card_num_raw AS card_num,
  TRY_CAST(trim(amount_raw) AS DECIMAL(18,2)) AS amount,
  merchant_raw AS merchant,
  category_raw AS category,
  {_BOOL.format(c='is_fraud_raw')} AS is_fraud,
  meta_filename, meta_file_row_number, meta_load_ts
FROM raw_trans""")

cte("stg_transactions", ("stg_typed",), """
SELECT *,
  CASE WHEN trans_ts IS NULL THEN 'INVALID_DATE'
       WHEN amount IS NULL THEN 'INVALID_AMOUNT'
       WHEN is_fraud IS NULL THEN 'INVALID_IS_FRAUD'
       ELSE 'VALID' END AS validation_status
FROM stg_typed""")

cte("stg_merchants", ("raw_merch",), """
SELECT merchant_raw AS merchant,
  TRY_CAST(trim(merchant_lat_raw) AS DECIMAL(11,8)) AS merchant_lat,
  TRY_CAST(trim(merchant_long_raw) AS DECIMAL(11,8)) AS merchant_long,
  meta_filename, meta_file_row_number, meta_load_ts
FROM raw_merch""")

cte("stg_clients", ("raw_clients",), """
SELECT card_num_raw AS card_num, first_name_raw AS first_name, last_name_raw AS last_name,
  gender_raw AS gender, CAST(try_strptime(date_birth_raw, '%d-%m-%Y') AS DATE) AS date_birth,
  job_raw AS job, street_raw AS street, city_raw AS city, state_raw AS state,
  meta_filename, meta_file_row_number, meta_load_ts
FROM raw_clients""")

# -- dimensions ----------------------------------------------------------------
cte("merchants_latest", ("stg_merchants",), """
SELECT merchant, merchant_lat, merchant_long, meta_load_ts FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY merchant
            ORDER BY meta_load_ts DESC, meta_file_row_number DESC, meta_filename DESC) AS rn
  FROM stg_merchants) WHERE rn = 1""")

CLIENT_ATTRS = "first_name, last_name, gender, date_birth, job, street, city, state"

cte("clients_deduped", ("stg_clients",), f"""
SELECT card_num, {CLIENT_ATTRS}, meta_load_ts AS valid_from,
       meta_filename, meta_file_row_number, meta_load_ts FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY card_num, meta_load_ts
            ORDER BY meta_file_row_number DESC, meta_filename DESC) AS rn
  FROM stg_clients) WHERE rn = 1""")

cte("clients_scd2", ("clients_deduped",), f"""
SELECT card_num, {CLIENT_ATTRS}, valid_from, meta_load_ts,
  LEAD(valid_from) OVER (PARTITION BY card_num ORDER BY valid_from) AS valid_to,
  LEAD(valid_from) OVER (PARTITION BY card_num ORDER BY valid_from) IS NULL AS is_current
FROM clients_deduped""")

# -- facts ---------------------------------------------------------------------
FACT_SELECT = """
  t.trans_num, t.trans_ts, t.card_num, t.amount, t.category, t.is_fraud,
  c.first_name, c.last_name, c.gender, c.job, c.city AS client_city, c.state AS client_state,
  m.merchant, m.merchant_lat, m.merchant_long, t.meta_load_ts"""

cte("fraud_full", ("stg_transactions", "merchants_latest", "clients_scd2"), f"""
SELECT {FACT_SELECT}
FROM stg_transactions t
LEFT JOIN merchants_latest m ON t.merchant = m.merchant
LEFT JOIN clients_scd2 c ON t.card_num = c.card_num
  AND t.trans_ts >= c.valid_from AND (t.trans_ts < c.valid_to OR c.valid_to IS NULL)
WHERE t.validation_status = 'VALID'""")

cte("trans_merch", ("stg_transactions", "merchants_latest"), """
SELECT t.trans_num, t.trans_ts, t.card_num, t.amount, t.category, t.is_fraud, t.validation_status,
  m.merchant, m.merchant_lat, m.merchant_long, t.meta_load_ts
FROM stg_transactions t LEFT JOIN merchants_latest m ON t.merchant = m.merchant""")

cte("trans_all_clients", ("trans_merch", "clients_scd2"), """
SELECT tm.*, c.first_name, c.last_name, c.gender, c.job, c.city AS client_city, c.state AS client_state
FROM trans_merch tm LEFT JOIN clients_scd2 c ON tm.card_num = c.card_num""")

QUARANTINE = ("trans_num, validation_status, meta_load_ts, trans_ts, card_num, amount, "
              "merchant, category, is_fraud")
