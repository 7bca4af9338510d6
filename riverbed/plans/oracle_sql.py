"""DuckDB statement per registered query (see ``oracles`` for the CTEs)."""

from __future__ import annotations

from riverbed.plans.oracles import CLIENT_ATTRS, QUARANTINE, build, cte

ORACLE_SQL: dict[str, str] = {
    "txn_parsed": build("SELECT * FROM stg_transactions", "stg_transactions"),
    "merchant_parsed": build("SELECT * FROM stg_merchants", "stg_merchants"),
    "client_parsed": build("SELECT * FROM stg_clients", "stg_clients"),
    "txn_status_counts": build(
        "SELECT validation_status, COUNT(*) AS n FROM stg_transactions GROUP BY validation_status",
        "stg_transactions"),
    "txn_invalid": build(
        f"SELECT {QUARANTINE} FROM stg_transactions WHERE validation_status <> 'VALID'",
        "stg_transactions"),
    "merchant_scd1": build("SELECT * FROM merchants_latest", "merchants_latest"),
    "client_deduped": build("SELECT * FROM clients_deduped", "clients_deduped"),
    "client_scd2": build("SELECT * FROM clients_scd2", "clients_scd2"),
    "fraud_full": build("SELECT * FROM fraud_full", "fraud_full"),
    "trans_merch": build("SELECT * FROM trans_merch", "trans_merch"),
    "trans_all_clients": build("SELECT * FROM trans_all_clients", "trans_all_clients"),
    "fraud_archive": build(
        "SELECT * FROM trans_all_clients WHERE validation_status = 'VALID'", "trans_all_clients"),
    "newest_rows": build(
        "SELECT * FROM stg_transactions ORDER BY meta_load_ts DESC, meta_filename DESC, "
        "meta_file_row_number DESC LIMIT 10", "stg_transactions"),
    "table_counts": build("""
SELECT 'raw_trans' AS table_name, COUNT(*) AS n FROM raw_trans
UNION ALL SELECT 'raw_clients', COUNT(*) FROM raw_clients
UNION ALL SELECT 'raw_merch', COUNT(*) FROM raw_merch
UNION ALL SELECT 'dt_transactions', COUNT(*) FROM stg_transactions
UNION ALL SELECT 'dt_merchants', COUNT(*) FROM merchants_latest
UNION ALL SELECT 'dt_clients_deduped', COUNT(*) FROM clients_deduped
UNION ALL SELECT 'dt_clients_scd2', COUNT(*) FROM clients_scd2
UNION ALL SELECT 'dt_invalid_trans', COUNT(*) FROM stg_transactions WHERE validation_status <> 'VALID'
UNION ALL SELECT 'dt_fraud_full', COUNT(*) FROM fraud_full""",
        "raw_trans", "raw_clients", "raw_merch", "stg_transactions", "merchants_latest",
        "clients_deduped", "clients_scd2", "fraud_full"),
}

_CUTS = """
SELECT * FROM (VALUES (0, TIMESTAMP '0001-01-01 00:00:00', TIMESTAMP '2024-01-11 00:00:00'),
                      (1, TIMESTAMP '2024-01-11 00:00:00', TIMESTAMP '2024-01-21 00:00:00'),
                      (2, TIMESTAMP '2024-01-21 00:00:00', TIMESTAMP '9999-12-31 00:00:00')) v(r, lo, hi)"""

_LOAD_DESC = "meta_load_ts DESC, meta_file_row_number DESC, meta_filename DESC"

ORACLE_SQL.update({
    # Incremental runs over load cuts equal the recomputed result.
    "txn_invalid_incremental": build(f"""
SELECT {QUARANTINE} FROM (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY trans_num ORDER BY {_LOAD_DESC}) AS rn
  FROM stg_transactions WHERE validation_status <> 'VALID' AND trans_num IS NOT NULL) WHERE rn = 1""",
        "stg_transactions"),
    # Rows without a key are set aside, every one of them.
    "quarantined_rows": build("""
SELECT 'fct_invalid_transactions' AS table_name, validation_status, card_num, merchant, category, meta_load_ts AS at
FROM stg_transactions WHERE validation_status <> 'VALID' AND trans_num IS NULL
UNION ALL SELECT 'fct_fraud_full', 'VALID', t.card_num, m.merchant, t.category, t.meta_load_ts
FROM stg_transactions t LEFT JOIN (
  SELECT 0 AS r, * FROM merchants_latest) m ON m.merchant = t.merchant
WHERE t.validation_status = 'VALID' AND t.trans_num IS NULL
UNION ALL SELECT 'conformed', NULL, NULL, NULL, category_raw,
  TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(((dayofyear(meta_load_ts) - 1) // 5 + 1) * 5 AS INTEGER))
FROM raw_trans WHERE trans_num_raw IS NULL""", "stg_transactions", "merchants_latest", "raw_trans"),
    "merchant_scd1_incremental": build(
        "SELECT * FROM merchants_latest WHERE merchant IS NOT NULL", "merchants_latest"),
    "client_scd2_snapshot": build(f"""
SELECT card_num, {CLIENT_ATTRS}, valid_from, meta_filename, meta_file_row_number, meta_load_ts,
  meta_load_ts AS dbt_updated_at, meta_load_ts AS dbt_valid_from,
  LEAD(meta_load_ts) OVER (PARTITION BY card_num ORDER BY meta_load_ts) AS dbt_valid_to,
  md5(COALESCE(CAST(length(card_num) AS VARCHAR) || ':' || card_num, 'null') || '|' || strftime(meta_load_ts, '%Y-%m-%d %H:%M:%S.%f')) AS dbt_scd_id
FROM clients_deduped""", "clients_deduped"),
    "client_dim_incremental": build(f"""
SELECT card_num, {CLIENT_ATTRS}, meta_load_ts, meta_load_ts AS valid_from,
  LEAD(meta_load_ts) OVER (PARTITION BY card_num ORDER BY meta_load_ts) AS valid_to,
  LEAD(meta_load_ts) OVER (PARTITION BY card_num ORDER BY meta_load_ts) IS NULL AS is_current,
  md5(COALESCE(CAST(length(card_num) AS VARCHAR) || ':' || card_num, 'null') || '|' || strftime(meta_load_ts, '%Y-%m-%d %H:%M:%S.%f')) AS dbt_scd_id,
  meta_load_ts AS dbt_updated_at
FROM clients_deduped""", "clients_deduped"),
    # Facts: each trans_num's latest VALID row, enriched with the dimensions
    # as they were at the run whose load window holds that row.
    "fraud_incremental": build(f"""
WITH cuts AS ({_CUTS}),
lv AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY trans_num ORDER BY {_LOAD_DESC}) AS rn
                 FROM stg_transactions WHERE validation_status = 'VALID' AND trans_num IS NOT NULL) WHERE rn = 1),
t AS (SELECT lv.*, cuts.r FROM lv JOIN cuts ON lv.meta_load_ts >= cuts.lo AND lv.meta_load_ts < cuts.hi),
m AS (
  SELECT r, merchant, merchant_lat, merchant_long FROM (
    SELECT cuts.r, s.*, ROW_NUMBER() OVER (PARTITION BY cuts.r, s.merchant ORDER BY
           s.meta_load_ts DESC, s.meta_file_row_number DESC, s.meta_filename DESC) AS rn
    FROM stg_merchants s JOIN cuts ON s.meta_load_ts < cuts.hi) WHERE rn = 1),
cd AS (
  SELECT r, card_num, {CLIENT_ATTRS}, meta_load_ts AS valid_from FROM (
    SELECT cuts.r, s.*, ROW_NUMBER() OVER (PARTITION BY cuts.r, s.card_num, s.meta_load_ts
           ORDER BY s.meta_file_row_number DESC, s.meta_filename DESC) AS rn
    FROM stg_clients s JOIN cuts ON s.meta_load_ts < cuts.hi) WHERE rn = 1),
c AS (SELECT *, LEAD(valid_from) OVER (PARTITION BY r, card_num ORDER BY valid_from) AS valid_to FROM cd)
SELECT t.trans_num, t.trans_ts, t.card_num, t.amount, t.category, t.is_fraud,
  c.first_name, c.last_name, c.gender, c.job, c.city AS client_city, c.state AS client_state,
  m.merchant, m.merchant_lat, m.merchant_long, t.meta_load_ts
FROM t
LEFT JOIN m ON t.r = m.r AND t.merchant = m.merchant
LEFT JOIN c ON t.r = c.r AND t.card_num = c.card_num
  AND t.trans_ts >= c.valid_from AND (t.trans_ts < c.valid_to OR c.valid_to IS NULL)""",
        "stg_transactions", "stg_merchants", "stg_clients"),
})

# V1: per (key, batch) latest; a batch changes the key when its row IS
# DISTINCT FROM the previous batch row; stamp of the last change.
_CONFORMED = build(f"""
WITH landing AS (
  SELECT trans_num_raw AS trans_id, try_strptime(trans_date_raw, '%d-%m-%Y %H:%M') AS trans_ts,
    category_raw AS category,
    CASE WHEN lower(trim(is_fraud_raw)) IN ('true', 't', 'yes', 'y', 'on', '1') THEN TRUE
         WHEN lower(trim(is_fraud_raw)) IN ('false', 'f', 'no', 'n', 'off', '0') THEN FALSE END AS is_fraud,
    meta_filename, meta_file_row_number, meta_load_ts,
    CAST((dayofyear(meta_load_ts) - 1) // 5 AS INTEGER) AS batch_id
  FROM raw_trans WHERE trans_num_raw IS NOT NULL),
per_batch AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY trans_id, batch_id ORDER BY {_LOAD_DESC}) AS rn
                 FROM landing) WHERE rn = 1),
flagged AS (
  SELECT *,
    (ROW_NUMBER() OVER w = 1
     OR trans_ts IS DISTINCT FROM LAG(trans_ts) OVER w
     OR category IS DISTINCT FROM LAG(category) OVER w
     OR is_fraud IS DISTINCT FROM LAG(is_fraud) OVER w
     OR meta_filename IS DISTINCT FROM LAG(meta_filename) OVER w) AS changed,
    TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST((batch_id + 1) * 5 AS INTEGER)) AS stamp
  FROM per_batch WINDOW w AS (PARTITION BY trans_id ORDER BY batch_id)),
final AS (
  SELECT *, MAX(CASE WHEN changed THEN stamp END) OVER (PARTITION BY trans_id) AS processed_ts,
    ROW_NUMBER() OVER (PARTITION BY trans_id ORDER BY batch_id DESC) AS last_rn
  FROM flagged)
SELECT trans_id, trans_ts, category, is_fraud, meta_filename AS source_filename, processed_ts
FROM final WHERE last_rn = 1""", "raw_trans")
ORACLE_SQL["conformed_upsert"] = _CONFORMED
ORACLE_SQL["conformed_replay"] = _CONFORMED

# -- wide-file normalisation -----------------------------------------------------
_WIDE = """
WITH wide AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) AS trans_num,
    strftime(o_orderdate, '%d-%m-%Y %H:%M:%S') AS trans_date_trans_time,
    c_custkey AS cc_num, CAST(l_extendedprice AS DECIMAL(18,2)) AS amt,
    p_brand AS merchant, p_type AS category,
    CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS is_fraud,
    c_name AS first, c_mktsegment AS last,
    CASE WHEN c_nationkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    'Street ' || CAST(c_custkey % 100 AS VARCHAR) AS street,
    n_name AS city, CAST(n_regionkey AS VARCHAR) AS state, c_nationkey AS zip,
    c_mktsegment AS job, CAST(c_acctbal AS DECIMAL(18,2)) AS dob,
    p_size AS merch_lat, CAST(p_retailprice AS DECIMAL(18,2)) AS merch_long
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
  JOIN nation ON c_nationkey = n_nationkey)
SELECT DISTINCT {cols} FROM wide"""
ORACLE_SQL["wide_normalise_trans"] = _WIDE.format(
    cols="trans_num, trans_date_trans_time, cc_num, amt, merchant, category, is_fraud")
ORACLE_SQL["wide_normalise_client"] = _WIDE.format(
    cols="cc_num, first, last, gender, street, city, state, zip, job, dob")
ORACLE_SQL["wide_normalise_merch"] = _WIDE.format(cols="trans_num, merchant, merch_lat, merch_long")

# -- monitoring ------------------------------------------------------------------
# What the delivered rows imply: one ledger row per source file, an error per
# malformed line, a failed audit while an amount is unreadable.
# Bytes of each delivered transaction line, with its line end.
cte("trans_bytes", ("raw_trans",), """
SELECT CAST(regexp_extract(meta_filename, '_([0-9]+)', 1) AS BIGINT) * 1000 + meta_file_row_number - 1 AS event_id,
  strlen(concat_ws(',', COALESCE(trans_num_raw, 'NULL'), trans_date_raw, COALESCE(card_num_raw, 'NULL'),
    COALESCE(amount_raw, 'NULL'), COALESCE(merchant_raw, 'NULL'), category_raw, is_fraud_raw)) + 1 AS bytes
FROM raw_trans""")

cte("ledger", ("raw_trans", "raw_clients", "raw_merch", "trans_bytes"), """
SELECT pipe_name, table_name, file_name, row_count, error_count, CAST(file_size AS BIGINT) AS file_size,
  CASE WHEN error_count = 0 THEN 'LOADED' WHEN error_count < row_count THEN 'PARTIALLY_LOADED'
       ELSE 'LOAD_FAILED' END AS status
FROM (SELECT 'PIPE_TRANS' AS pipe_name, 'RAW_TRANS' AS table_name,
        'trans_' || CAST(event_id // 1000 AS VARCHAR) || '.csv' AS file_name,
        COUNT(*) AS row_count, COUNT(CASE WHEN event_id % 499 = 0 THEN 1 END) AS error_count,
        SUM(bytes + CASE WHEN event_id % 499 = 0 THEN 6 ELSE 0 END) AS file_size
      FROM (SELECT e.event_id, r.bytes FROM events e JOIN trans_bytes r USING (event_id)) GROUP BY event_id // 1000
      UNION ALL SELECT 'PIPE_CLIENTS', 'RAW_CLIENTS', meta_filename, COUNT(*), 0, SUM(strlen(concat_ws(',',
        COALESCE(card_num_raw, 'NULL'), first_name_raw, last_name_raw, gender_raw, date_birth_raw, job_raw,
        street_raw, city_raw, state_raw)) + 1)
      FROM raw_clients GROUP BY meta_filename
      UNION ALL SELECT 'PIPE_MERCH', 'RAW_MERCH', meta_filename, COUNT(*), 0, SUM(strlen(concat_ws(',',
        COALESCE(merchant_raw, 'NULL'), merchant_lat_raw, merchant_long_raw)) + 1)
      FROM raw_merch GROUP BY meta_filename)""")

_LOAD_ALERT = """SELECT 'LOAD_ERRORS' AS alert_name, COUNT(*) AS matching_rows FROM ledger
WHERE pipe_name = 'PIPE_TRANS' AND error_count > 0 HAVING COUNT(*) > 0"""
_RUN_ALERT = """SELECT 'TASK_FAILED' AS alert_name, 1 AS matching_rows
WHERE EXISTS (SELECT 1 FROM stg_transactions WHERE validation_status = 'INVALID_AMOUNT')"""

ORACLE_SQL.update({
    "load_ledger": build("SELECT * FROM ledger", "ledger"),
    "load_stats": build("""
SELECT status, pipe_name, CAST(SUM(row_count) AS BIGINT) AS total_rows_loaded, COUNT(*) AS files_processed,
  TRUE AS latency_known, TRUE AS avg_within_max
FROM ledger WHERE pipe_name = 'PIPE_TRANS' GROUP BY status, pipe_name""", "ledger"),
    "load_volume": build("""
SELECT pipe_name, COUNT(*) AS files_inserted, CAST(SUM(file_size) AS BIGINT) AS bytes_inserted
FROM ledger GROUP BY pipe_name""", "ledger"),
    "load_error_alert": build(_LOAD_ALERT, "ledger"),
    "load_errors_exist": build(
        'SELECT pipe_name, BOOL_OR(error_count > 0) AS "exists" FROM ledger GROUP BY pipe_name', "ledger"),
    "run_failure_alert": build(_RUN_ALERT, "stg_transactions"),
    "run_history": build("""
SELECT 'CONFORMED_UPSERT' AS name, 'SUCCEEDED' AS state, 'INCREMENTAL' AS refresh_action,
  COUNT(*) AS row_count, TRUE AS ended FROM raw_trans""", "raw_trans"),
    "refresh_history": build("""
WITH audit AS (SELECT COUNT(*) AS n, COUNT(CASE WHEN validation_status = 'INVALID_AMOUNT' THEN 1 END) AS bad,
                 COUNT(CASE WHEN amount > 0 THEN 1 END) AS clean FROM stg_transactions)
SELECT 'DT_TRANSACTIONS' AS name, 'SUCCEEDED' AS state, 'FULL' AS refresh_action, n AS row_count FROM audit
UNION ALL SELECT 'DT_MERCHANTS', 'SUCCEEDED', 'FULL', COUNT(*) FROM merchants_latest
UNION ALL SELECT 'DT_AMOUNT_AUDIT', CASE WHEN bad > 0 THEN 'FAILED' ELSE 'SUCCEEDED' END, 'FULL',
  CASE WHEN bad = 0 THEN n END FROM audit
UNION ALL SELECT 'DT_CLEAN_AMOUNTS', CASE WHEN bad > 0 THEN 'UPSTREAM_FAILED' ELSE 'SUCCEEDED' END,
  CASE WHEN bad > 0 THEN 'NONE' ELSE 'FULL' END, CASE WHEN bad = 0 THEN clean END FROM audit""",
        "stg_transactions", "merchants_latest"),
    "alert_history": build(f"{_LOAD_ALERT} UNION ALL {_RUN_ALERT}", "ledger", "stg_transactions"),
})

# -- reports over dated ledgers and runs --------------------------------------------
# Times follow from the events: a file was received when its last event was,
# and loaded at the next quarter of an hour; a run starts three seconds later.
cte("dated_files", (), """
SELECT 'PIPE_' || CAST(event_id // 1000 % 2 AS VARCHAR) AS pipe_name, event_id // 1000 AS file_no,
  COUNT(*) AS row_count, COUNT(CASE WHEN event_id % 499 = 0 THEN 1 END) AS error_count,
  CAST(SUM(strlen(event_type) + 20) AS BIGINT) AS file_size, date_trunc('second', MAX(ts)) AS received,
  to_timestamp((epoch_ms(MAX(ts)) // 900000 + 1) * 900) AT TIME ZONE 'UTC' AS loaded
FROM events GROUP BY event_id // 1000""")
_RECENT = "loaded >= (SELECT MAX(loaded) FROM dated_files) - INTERVAL {h} HOUR"
ORACLE_SQL.update({
    "load_stats_dated": build(f"""
SELECT ROW_NUMBER() OVER (ORDER BY loaded DESC, status) AS place, status, pipe_name, loaded AS last_load_time,
  CAST(AVG(s) AS DECIMAL(18,3)) AS avg_latency_sec, MAX(s) AS max_latency_sec,
  CAST(SUM(row_count) AS BIGINT) AS total_rows_loaded, COUNT(*) AS files_processed
FROM (SELECT *, CASE WHEN error_count = 0 THEN 'LOADED' ELSE 'PARTIALLY_LOADED' END AS status,
        date_diff('second', received, loaded) AS s FROM dated_files)
WHERE pipe_name = 'PIPE_1' AND {_RECENT.format(h=360)} GROUP BY status, pipe_name, loaded""", "dated_files"),
    "load_volume_dated": build(f"""
SELECT date_trunc('hour', loaded) AS start_time, pipe_name, CAST(SUM(file_size) AS BIGINT) AS bytes_inserted,
  COUNT(*) AS files_inserted, date_trunc('hour', loaded) + INTERVAL 1 HOUR AS end_time
FROM dated_files WHERE {_RECENT.format(h=360)} GROUP BY date_trunc('hour', loaded), pipe_name""", "dated_files"),
    "run_history_dated": build(f"""
SELECT ROW_NUMBER() OVER (ORDER BY loaded DESC, file_no DESC) AS place, 'LOAD_' || pipe_name AS name,
  CASE WHEN error_count > 2 THEN 'FAILED' ELSE 'SUCCEEDED' END AS state, loaded AS scheduled_time,
  loaded + to_seconds(3 + file_no) AS start_time, CAST(row_count % 97 + 1 AS BIGINT) AS duration_sec, row_count
FROM dated_files WHERE pipe_name = 'PIPE_0' AND {_RECENT.format(h=24 * 15)}""", "dated_files"),
})

# -- ingestion -------------------------------------------------------------------
ORACLE_SQL["ingest_csv"] = build(
    "SELECT trans_num_raw, trans_date_raw, card_num_raw, amount_raw, merchant_raw, category_raw, "
    "is_fraud_raw FROM raw_trans", "raw_trans")

# Per (key, arrival) the row with the highest event id (highest file row:
# rows of one key share a file, ordered by event id); every later arrival is
# a change (its file name differs); stamp of the key's last arrival.
ORACLE_SQL["ingest_stream_upsert"] = build("""
WITH ev AS (
  SELECT 'T' || CAST(event_id - CASE WHEN event_id % 11 = 5 AND event_id >= 1000 THEN 1000 ELSE 0 END AS VARCHAR) AS trans_id,
    try_strptime(CASE WHEN event_id % 41 = 0 THEN strftime(ts, '%Y-%m-%d')
                      WHEN event_id % 3 = 0 THEN strftime(ts, '%d-%m-%Y %H:%M')
                      ELSE strftime(ts, '%d-%m-%Y %H:%M:%S') END, '%d-%m-%Y %H:%M') AS trans_ts,
    event_type AS category,
    CASE WHEN event_id % 31 = 0 THEN NULL WHEN event_id % 5 = 0 THEN TRUE
         WHEN event_id % 7 = 0 THEN TRUE ELSE FALSE END AS is_fraud,
    event_id, CAST((dayofyear(ts) - 1) // 5 AS INTEGER) AS arrival
  FROM events WHERE event_id % 401 <> 0),
per AS (
  SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY trans_id, arrival ORDER BY event_id DESC) AS rn
                 FROM ev) WHERE rn = 1)
SELECT trans_id, trans_ts, category, is_fraud,
  TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST((arrival + 1) * 5 AS INTEGER)) AS processed_ts
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY trans_id ORDER BY arrival DESC) AS r2 FROM per)
WHERE r2 = 1""")

ORACLE_SQL["fraud_propagated"] = build("SELECT * FROM fraud_full", "fraud_full")
ORACLE_SQL["fraud_refresh_runs"] = build(f"""
WITH cuts AS ({_CUTS}),
t AS (SELECT s.trans_ts, s.card_num, s.merchant, cuts.r FROM stg_transactions s
      JOIN cuts ON s.meta_load_ts >= cuts.lo AND s.meta_load_ts < cuts.hi WHERE s.validation_status = 'VALID'),
m AS (SELECT r, merchant, merchant_lat, merchant_long FROM (
    SELECT cuts.r, s.*, ROW_NUMBER() OVER (PARTITION BY cuts.r, s.merchant ORDER BY
           s.meta_load_ts DESC, s.meta_file_row_number DESC, s.meta_filename DESC) AS rn
    FROM stg_merchants s JOIN cuts ON s.meta_file_row_number % 3 <= cuts.r) WHERE rn = 1),
cd AS (SELECT r, card_num, first_name, last_name, gender, job, city, state, meta_load_ts AS valid_from FROM (
    SELECT cuts.r, s.*, ROW_NUMBER() OVER (PARTITION BY cuts.r, s.card_num, s.meta_load_ts
           ORDER BY s.meta_file_row_number DESC, s.meta_filename DESC) AS rn
    FROM stg_clients s JOIN cuts
      ON (CAST(regexp_extract(s.meta_filename, '_([0-9]+)', 1) AS INTEGER) + s.meta_file_row_number) % 3 <= cuts.r)
  WHERE rn = 1),
changed_m AS (SELECT DISTINCT r, merchant FROM (
    SELECT * FROM m EXCEPT SELECT r + 1, merchant, merchant_lat, merchant_long FROM m)),
changed_c AS (SELECT r, card_num, MIN(valid_from) AS since FROM (
    SELECT * FROM cd EXCEPT SELECT r + 1, card_num, first_name, last_name, gender, job, city, state, valid_from
    FROM cd) GROUP BY r, card_num)
SELECT CAST(cuts.r AS INTEGER) AS refresh, 'DT_FRAUD_FULL' AS name, 'SUCCEEDED' AS state,
  CASE WHEN cuts.r = 0 THEN 'FULL' ELSE 'INCREMENTAL' END AS refresh_action,
  COUNT(CASE WHEN t.r = cuts.r OR cm.merchant IS NOT NULL OR cc.card_num IS NOT NULL THEN 1 END) AS row_count
FROM cuts JOIN t ON t.r <= cuts.r
LEFT JOIN changed_m cm ON cm.r = cuts.r AND cm.merchant = t.merchant
LEFT JOIN changed_c cc ON cc.r = cuts.r AND cc.card_num = t.card_num AND t.trans_ts >= cc.since
GROUP BY cuts.r""", "stg_transactions", "stg_merchants", "stg_clients")

# -- H15 ---------------------------------------------------------------------------
ORACLE_SQL["v2_pipeline_fact"] = build("SELECT * FROM fraud_full", "fraud_full")
ORACLE_SQL["v2_refresh_runs"] = build("""
SELECT 'DT_TRANSACTIONS' AS name, 'SUCCEEDED' AS state, 'FULL' AS refresh_action,
       COUNT(*) AS row_count FROM stg_transactions
UNION ALL SELECT 'DT_MERCHANTS', 'SUCCEEDED', 'FULL', COUNT(*) FROM merchants_latest
UNION ALL SELECT 'DT_CLIENTS_DEDUPED', 'SUCCEEDED', 'FULL', COUNT(*) FROM clients_deduped
UNION ALL SELECT 'DT_CLIENTS_SCD2', 'SUCCEEDED', 'FULL', COUNT(*) FROM clients_scd2
UNION ALL SELECT 'DT_FRAUD_FULL', 'SUCCEEDED', 'FULL', CAST(NULL AS BIGINT)
UNION ALL SELECT 'DT_INVALID_TRANS', 'SUCCEEDED', 'FULL', CAST(NULL AS BIGINT)""",
    "stg_transactions", "merchants_latest", "clients_deduped", "clients_scd2")

# -- V2 ingest end to end ------------------------------------------------------------
ORACLE_SQL["ingest_v2_counts"] = build("""
SELECT 'raw_trans' AS table_name, validation_status AS metric, COUNT(*) AS n
FROM stg_transactions GROUP BY validation_status
UNION ALL SELECT 'raw_clients', 'rows', COUNT(*) FROM raw_clients
UNION ALL SELECT 'raw_clients', 'valid_birth', COUNT(try_strptime(date_birth_raw, '%d-%m-%Y')) FROM raw_clients
UNION ALL SELECT 'raw_clients', 'cards', COUNT(DISTINCT card_num_raw) FROM raw_clients
UNION ALL SELECT 'raw_clients', 'job_like', COUNT(CASE WHEN job_raw LIKE '1-%' OR job_raw LIKE '2-%'
  OR job_raw LIKE '3-%' OR job_raw LIKE '4-%' OR job_raw LIKE '5-%' THEN 1 END) FROM raw_clients
UNION ALL SELECT 'raw_merch', 'rows', COUNT(*) FROM raw_merch
UNION ALL SELECT 'raw_merch', 'valid_lat', COUNT(TRY_CAST(trim(merchant_lat_raw) AS DECIMAL(11,8))) FROM raw_merch
UNION ALL SELECT 'raw_merch', 'merchants', COUNT(DISTINCT merchant_raw) FROM raw_merch""",
    "stg_transactions", "raw_clients", "raw_merch")
ORACLE_SQL["fraud_full_sweep"] = build("SELECT * FROM fraud_full", "fraud_full")

# -- lineage, inventory, counts and previews -------------------------------------------
ORACLE_SQL.update({
    "ingest_lineage": build("""
SELECT meta_filename AS file_name, trans_num_raw, trans_date_raw,
  ROW_NUMBER() OVER (PARTITION BY meta_filename ORDER BY meta_file_row_number) AS meta_file_row_number
FROM raw_trans""", "raw_trans"),
    "ingest_late_files": build("""
SELECT CAST(regexp_extract(meta_filename, '_([0-9]+)', 1) AS INTEGER) % 2 AS run, meta_filename AS file_name,
  ROW_NUMBER() OVER (PARTITION BY meta_filename ORDER BY meta_file_row_number) AS meta_file_row_number,
  trans_num_raw
FROM raw_trans""", "raw_trans"),
    "file_inventory": build(
        "SELECT file_name AS name, file_size AS size FROM ledger WHERE pipe_name = 'PIPE_TRANS'", "ledger"),
    "any_rows": build("SELECT LEAST(COUNT(*), 10) AS n FROM raw_trans", "raw_trans"),
    "idle_run": build("""
SELECT COUNT(DISTINCT trans_num_raw) AS conformed_rows, 0 AS new_batches, 0 AS unread_batches, FALSE AS created
FROM raw_trans""", "raw_trans"),
    "v1_table_counts": build("""
SELECT 'landing' AS table_name, COUNT(*) AS n FROM raw_trans
UNION ALL SELECT 'landing_feed', 0
UNION ALL SELECT 'conformed', COUNT(DISTINCT trans_num_raw) FROM raw_trans
UNION ALL SELECT 'dt_trans_merch', COUNT(*) FROM trans_merch
UNION ALL SELECT 'dt_trans_all_clients', COUNT(*) FROM trans_all_clients""",
        "raw_trans", "trans_merch", "trans_all_clients"),
    "newest_derived": build("\nUNION ALL\n".join(
        f"SELECT * FROM (SELECT '{name}' AS table_name, {key} AS row_key, meta_load_ts FROM {src} "
        f"ORDER BY meta_load_ts DESC, {key} NULLS FIRST LIMIT 10)"
        for name, key, src in (
            ("dt_transactions", "trans_num", "stg_transactions"),
            ("dt_invalid_trans", "trans_num", "stg_transactions WHERE validation_status <> 'VALID'"),
            ("dt_merchants", "merchant", "merchants_latest"),
            ("dt_clients_scd2", "card_num", "clients_scd2"),
            ("dt_fraud_full", "trans_num", "fraud_full"))),
        "stg_transactions", "merchants_latest", "clients_scd2", "fraud_full"),
    "wide_csv_round_trip": _WIDE.format(
        cols="trans_num, merchant, CAST(merch_lat AS VARCHAR) AS merch_lat, "
             "CAST(merch_long AS VARCHAR) AS merch_long"),
})
