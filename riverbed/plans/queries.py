"""Registered queries: ``name -> f(spark, sf_dir) -> DataFrame``.

Each reads the driver tables through ``riverbed.sources.fixtures`` and runs a
model or operator over the whole input. ``riverbed.plans.oracles`` holds the
matching DuckDB statements.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.plans import fraud
from riverbed.session import stage
from riverbed.sources import fixtures as fx

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def _txn(spark, sf):
    return fraud.stg_transactions(fx.raw_trans(spark, sf))


def _merch(spark, sf):
    return fraud.merchants_latest(fraud.stg_merchants(fx.raw_merch(spark, sf)))


def _deduped(spark, sf):
    return fraud.clients_deduped(fraud.stg_clients(fx.raw_clients(spark, sf)))


def _scd2(spark, sf):
    # The deduplicated clients are a table of their own (dt_clients_deduped):
    # written once, so the chaining reads it twice instead of deriving it twice.
    return fraud.clients_scd2(stage(_deduped(spark, sf), "dt_clients_deduped"))


# -- staging -------------------------------------------------------------------
@query
def txn_parsed(spark, sf):
    """Typed, validated transactions with lineage."""
    return _txn(spark, sf)


@query
def merchant_parsed(spark, sf):
    """H13."""
    return fraud.stg_merchants(fx.raw_merch(spark, sf))


@query
def client_parsed(spark, sf):
    """H14."""
    return fraud.stg_clients(fx.raw_clients(spark, sf))


@query
def txn_status_counts(spark, sf):
    """S7 + G1: rows per validation label."""
    return _txn(spark, sf).groupBy("validation_status").agg(F.count(F.lit(1)).alias("n"))


@query
def txn_invalid(spark, sf):
    """S9 / H10 full: the quarantine."""
    return fraud.quarantine(_txn(spark, sf))


# -- dimensions ----------------------------------------------------------------
@query
def merchant_scd1(spark, sf):
    """W1 / H4 full: current merchant per key."""
    return fraud.dim_merchants_cols(_merch(spark, sf))


@query
def client_deduped(spark, sf):
    """One client row per (card, load time)."""
    return _deduped(spark, sf)


@query
def client_scd2(spark, sf):
    """Client versions by recomputation."""
    return _scd2(spark, sf)


# -- facts ---------------------------------------------------------------------
@query
def fraud_full(spark, sf):
    """J1 + J2 + S8 / H8: the enriched fact, recomputed."""
    return fraud.enriched_fact(_txn(spark, sf), _merch(spark, sf), _scd2(spark, sf))


@query
def trans_merch(spark, sf):
    """J1 (archive intermediate)."""
    return fraud.trans_merch(_txn(spark, sf), _merch(spark, sf))


@query
def trans_all_clients(spark, sf):
    """Fan-out to all client versions."""
    return fraud.trans_all_clients(fraud.trans_merch(_txn(spark, sf), _merch(spark, sf)),
                                   _scd2(spark, sf))


@query
def fraud_archive(spark, sf):
    """Archive enriched fact (VALID over the fan-out)."""
    return fraud.fraud_archive(trans_all_clients(spark, sf))


# -- previews and counts ---------------------------------------------------------
@query
def newest_rows(spark, sf):
    """L1: newest 10 transactions; lineage makes the order total."""
    return (_txn(spark, sf)
            .orderBy(F.col("meta_load_ts").desc(), F.col("meta_filename").desc(),
                     F.col("meta_file_row_number").desc())
            .limit(10))


_DERIVED: dict[tuple[str, str], str] = {}
DERIVED = ("dt_transactions", "dt_merchants", "dt_clients_deduped", "dt_clients_scd2", "dt_invalid_trans", "dt_fraud_full")


def _derived(spark, sf):
    """Folders of the derived tables, refreshed once per session and input."""
    import os

    from riverbed.plans.pipeline import fraud_v2
    from riverbed.session import path_exists, scratch_path
    key = (spark.sparkContext.applicationId, os.path.abspath(sf))
    root = _DERIVED.get(key)
    if root is None or not path_exists(spark, f"{root}/dt_fraud_full/_SUCCESS"):
        root = scratch_path(spark, "derived")
        fraud_v2(fx.raw_tables(spark, sf)).refresh(spark, paths={n: f"{root}/{n}" for n in DERIVED})
        _DERIVED[key] = root
    return {n: f"{root}/{n}" for n in DERIVED}


@query
def table_counts(spark, sf):
    """G1 / M9: row count of every raw and derived table, as (table_name, n),
    from the footers of the written tables."""
    from riverbed.operators.monitor import written_table_counts
    raw = {n: fx.landed_path(spark, sf, n) for n in ("raw_trans", "raw_clients", "raw_merch")}
    return written_table_counts(spark, {**raw, **_derived(spark, sf)})


# -- incremental models (V3) and the V1 upsert ---------------------------------------
_BY_CUT: dict[tuple[str, str], str] = {}


def _replay(spark, sf, name, models):
    """The raw tables are landed by load cut once per session and input."""
    import os

    from riverbed.plans.incremental import DEFAULT_CUTS, batch_of_cut, land_batches, replay
    from riverbed.session import path_exists, scratch_path
    raw = fx.raw_tables(spark, sf)
    key = (spark.sparkContext.applicationId, os.path.abspath(sf))
    root = _BY_CUT.get(key)
    if root is None or not all(path_exists(spark, f"{root}/{t}/_SUCCESS") for t in raw):
        root = _BY_CUT[key] = scratch_path(spark, "landing-by-cut")
        land_batches(spark, raw, root, lambda _name: batch_of_cut(DEFAULT_CUTS))
    return replay(spark, raw, name, models, landing={t: spark.read.parquet(f"{root}/{t}") for t in raw})


@query
def txn_invalid_incremental(spark, sf):
    """H3 + H2 + H10: quarantine built over three load cuts (= recompute)."""
    return _replay(spark, sf, "invalid", ["invalid"]).invalid.read()


@query
def quarantined_rows(spark, sf):
    """NULL keys: every row that the keyed tables set aside."""
    from riverbed.plans.incremental import batch_stamp, conformed_table, landing_batch, typed_landing, upsert_conformed
    from riverbed.session import scratch_path
    wh = _replay(spark, sf, "quarantine", ["invalid", "merchants", "snapshot", "clients", "facts"])
    none = F.lit(None).cast("string")
    invalid = wh.invalid.quarantined().select(
        F.lit("fct_invalid_transactions").alias("table_name"), "validation_status", "card_num", "merchant", "category",
        F.col("meta_load_ts").alias("at"))
    facts = wh.facts.quarantined().select(
        F.lit("fct_fraud_full").alias("table_name"), F.lit("VALID").alias("validation_status"), "card_num", "merchant",
        "category", F.col("meta_load_ts").alias("at"))
    landing = typed_landing(fx.raw_trans(spark, sf))
    landed = scratch_path(spark, "quarantine-landing")  # a folder per batch: an upsert reads its own batch alone
    landing.withColumn("batch_id", landing_batch(F.col("meta_load_ts"))).write.partitionBy("batch_id").parquet(landed)
    landing = spark.read.parquet(landed)
    table = conformed_table(spark, scratch_path(spark, "quarantine-conformed"))
    for b in sorted(r[0] for r in landing.select("batch_id").distinct().collect()):  # a handful
        upsert_conformed(table, landing.filter(F.col("batch_id") == b), b, batch_stamp(b))
    conformed = table.quarantined().select(
        F.lit("conformed").alias("table_name"), none.alias("validation_status"), none.alias("card_num"),
        none.alias("merchant"), "category", F.col("processed_ts").alias("at"))
    return invalid.unionByName(facts).unionByName(conformed)


@query
def merchant_scd1_incremental(spark, sf):
    """J5 + H2 / H4 incremental: equals the full SCD1."""
    return _replay(spark, sf, "merchants", ["merchants"]).merchants.read()


@query
def client_scd2_snapshot(spark, sf):
    """H6: snapshot applied over three load cuts (= H5 with version ids)."""
    return _replay(spark, sf, "snapshot", ["snapshot"]).snapshot.read()


@query
def client_dim_incremental(spark, sf):
    """H7 with the Q1 fix: incremental SCD2 dimension."""
    return _replay(spark, sf, "dim_clients", ["snapshot", "clients"]).clients.read()


@query
def fraud_incremental(spark, sf):
    """H9: incremental enriched fact; dimensions as of each run."""
    return _replay(spark, sf, "facts", ["merchants", "snapshot", "clients", "facts"]).facts.read()


def _propagated(spark, sf):
    """The fact refreshed three times. Client files are delivered in turn, so
    versions arrive late, between versions that are there; so do merchants."""
    from riverbed.plans.incremental import DEFAULT_CUTS, batch_of_cut, land_batches
    from riverbed.plans.pipeline import RunLog
    from riverbed.plans.propagate import FraudFact
    from riverbed.session import scratch_path
    root = scratch_path(spark, "propagated")
    file_number = F.regexp_extract("meta_filename", "_([0-9]+)", 1).cast("int")
    batch = {"raw_trans": batch_of_cut(DEFAULT_CUTS), "raw_clients": (file_number + F.col("meta_file_row_number")) % 3,
             "raw_merch": F.col("meta_file_row_number") % 3}
    landing = land_batches(spark, fx.raw_tables(spark, sf), f"{root}/landing", lambda n: batch[n].cast("int"))
    fact, log = FraudFact(spark, root), RunLog(spark)
    for n in range(3):
        fact.refresh(landing, n, log)
    return fact, log


@query
def fraud_propagated(spark, sf):
    """H8 + H15: the enriched fact kept incrementally, with late client
    versions and merchants carried to the rows they change (= fraud_full)."""
    return _propagated(spark, sf)[0].read()


@query
def fraud_refresh_runs(spark, sf):
    """H15 + M8: action and recomputed rows of each refresh: the new rows and
    those that a changed merchant or client version reaches, no others."""
    rows = _propagated(spark, sf)[1].held
    return spark.createDataFrame([(n, r.name, r.state, r.refresh_action, r.row_count) for n, r in enumerate(rows)],
                                 "refresh int, name string, state string, refresh_action string, row_count bigint")


def _landing(spark, sf):
    from riverbed.plans.incremental import landing_batch, typed_landing
    lan = typed_landing(fx.raw_trans(spark, sf))
    return lan.withColumn("batch_id", landing_batch(F.col("meta_load_ts")))


@query
def conformed_upsert(spark, sf):
    """A10 + W1 + H1: landing written by batch, each batch upserted in turn
    (changed-only, stamped, idempotent per batch id)."""
    from riverbed.plans.incremental import batch_stamp, conformed_table, upsert_conformed
    from riverbed.session import scratch_path
    root = scratch_path(spark, "conformed")
    _landing(spark, sf).write.partitionBy("batch_id").parquet(f"{root}/landing")
    landing = spark.read.parquet(f"{root}/landing")
    # The change feed: committed batches past the consumer's offset, in order
    # (distinct batch ids only: bounded by the number of batches).
    batches = sorted(r[0] for r in landing.select("batch_id").distinct().collect())
    table = conformed_table(spark, f"{root}/conformed")
    for b in batches:
        if b in table.applied_batches():
            continue
        upsert_conformed(table, landing.filter(F.col("batch_id") == b), b, batch_stamp(b))
    return table.read()


@query
def conformed_replay(spark, sf):
    """H1 backfill form: every batch applied in one pass (= conformed_upsert)."""
    from riverbed.plans.incremental import conformed_replay as replay_all
    return replay_all(_landing(spark, sf))


# -- wide-file normalisation (A12, G4) ---------------------------------------------
def _split(spark, sf):
    from riverbed.sources.wide import split_wide, wide_from_tables
    return split_wide(wide_from_tables(spark, sf))


@query
def wide_normalise_trans(spark, sf):
    """Transaction file of the wide export, full-row distinct."""
    return _split(spark, sf)["transaction"]


@query
def wide_normalise_client(spark, sf):
    """Client file of the wide export, full-row distinct."""
    return _split(spark, sf)["client"]


@query
def wide_normalise_merch(spark, sf):
    """Merchant file of the wide export, full-row distinct."""
    return _split(spark, sf)["merchant"]


# -- monitoring (M1-M9): reports over the loads, runs and alerts that ``monitored``
# really made. Their times are the clock's, so the queries return what the
# source rows imply: names, states, files, rows and errors in the look-back.
def _ledger(spark, sf):
    from riverbed.plans import monitoring
    return monitoring.ledger(spark, monitoring.monitored(spark, sf))


def _runs(spark, sf):
    from riverbed.plans import monitoring
    return monitoring.runs(spark, monitoring.monitored(spark, sf))


def _now():
    from riverbed.plans.pipeline import utc_now
    return utc_now()


@query
def load_ledger(spark, sf):
    """M1: status, rows and errors of every file the pipes loaded."""
    return _ledger(spark, sf).select("pipe_name", "table_name", "file_name", "status", "row_count", "error_count",
                                     "file_size")


@query
def load_stats(spark, sf):
    """Pipe performance of the last day, per status."""
    from riverbed.operators import monitor
    return (monitor.load_stats(_ledger(spark, sf), "PIPE_TRANS", _now(), 24)
            .groupBy("status", "pipe_name")
            .agg(F.sum("total_rows_loaded").alias("total_rows_loaded"),
                 F.sum("files_processed").alias("files_processed"),
                 (F.count("avg_latency_sec") == F.count(F.lit(1))).alias("latency_known"),
                 F.bool_and(F.col("avg_latency_sec") <= F.col("max_latency_sec")).alias("avg_within_max")))


@query
def load_volume(spark, sf):
    """M3: bytes and files per pipe over the hours of the last day."""
    from riverbed.operators import monitor
    return (monitor.load_volume(_ledger(spark, sf), _now(), 24).groupBy("pipe_name")
            .agg(F.sum("files_inserted").alias("files_inserted"), F.sum("bytes_inserted").alias("bytes_inserted")))


@query
def load_error_alert(spark, sf):
    """M5 + S16: files with load errors that the alert's runs see."""
    from riverbed.operators import monitor
    return (monitor.load_error_alert(_ledger(spark, sf), "PIPE_TRANS", "RAW_TRANS").groupBy("alert_name")
            .agg(F.sum("matching_rows").alias("matching_rows")))


@query
def load_errors_exist(spark, sf):
    """EXISTS, one truth value per pipe."""
    from riverbed.operators import monitor
    out = None
    for pipe in ("PIPE_TRANS", "PIPE_CLIENTS", "PIPE_MERCH"):
        bad = _ledger(spark, sf).filter((F.col("pipe_name") == pipe) & (F.col("error_count") > 0))
        one = monitor.exists(bad).select(F.lit(pipe).alias("pipe_name"), "exists")
        out = one if out is None else out.unionByName(one)
    return out


@query
def run_failure_alert(spark, sf):
    """M6: failed runs of the audit that the alert's runs see."""
    from riverbed.operators import monitor
    return (monitor.run_failure_alert(_runs(spark, sf), "DT_AMOUNT_AUDIT").groupBy("alert_name")
            .agg(F.sum("matching_rows").alias("matching_rows")))


@query
def run_history(spark, sf):
    """M4 + S14: the upsert task's runs of the last 24 hours."""
    from riverbed.operators import monitor
    return (monitor.run_history(_runs(spark, sf), "CONFORMED_UPSERT", _now(), 24)
            .groupBy("name", "state", "refresh_action")
            .agg(F.sum("row_count").alias("row_count"),
                 F.bool_and(F.col("end_time") >= F.col("start_time")).alias("ended")))


@query
def refresh_history(spark, sf):
    """M8 + S17: model refreshes whose name is LIKE 'DT_%'."""
    from riverbed.operators import monitor
    return (monitor.refresh_history(_runs(spark, sf), "DT_%")
            .select("name", "state", "refresh_action", "row_count"))


@query
def alert_history(spark, sf):
    """M7: the stored alerts of the last 24 hours."""
    from riverbed.functions.parse import lookback
    from riverbed.plans import monitoring
    alerts = monitoring.alerts(spark, monitoring.monitored(spark, sf))
    return (alerts.filter(F.col("scheduled_time") >= lookback(_now(), 24)).groupBy("alert_name")
            .agg(F.sum("matching_rows").alias("matching_rows")))


# -- the same reports over ledgers and runs whose times follow from the events ---------
def _dated(spark, sf):
    """One row per source file: received with its last event, loaded at the
    next quarter of an hour."""
    ev = fx.table(spark, sf, "events")
    number = F.floor(F.col("event_id") / 1000)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    quarter = F.floor(F.timestamp_diff("MILLISECOND", epoch, F.max("ts").cast("timestamp_ntz")) / 900000)
    return ev.groupBy(number.alias("file_no")).agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if(F.col("event_id") % 499 == 0).alias("error_count"),
        F.sum(F.octet_length("event_type") + 20).cast("bigint").alias("file_size"),
        F.date_trunc("second", F.max("ts")).cast("timestamp_ntz").alias("pipe_received_time"),
        F.timestamp_add("MINUTE", (quarter + 1) * 15, epoch).alias("last_load_time"),
    ).withColumns({"pipe_name": F.concat(F.lit("PIPE_"), (F.col("file_no") % 2).cast("string")),
                   "status": F.when(F.col("error_count") == 0, "LOADED").otherwise("PARTIALLY_LOADED")})


def _placed(df):
    """Rows with their place in the frame's own order (ids grow along it)."""
    from pyspark.sql import Window
    ids = df.withColumn("_id", F.monotonically_increasing_id())
    return ids.withColumn("place", F.row_number().over(Window.orderBy("_id")).cast("bigint")).drop("_id")


def _newest_load(ledger):
    return ledger.agg(F.max("last_load_time")).first()[0]


@query
def load_stats_dated(spark, sf):
    """M2 / G2 + S15 + L3: average and maximum latency per load, newest first."""
    from riverbed.operators import monitor
    ledger = _dated(spark, sf)
    return _placed(monitor.load_stats(ledger, "PIPE_1", _newest_load(ledger), 360).orderBy(
        F.col("last_load_time").desc(), "status"))


@query
def load_volume_dated(spark, sf):
    """M3: bytes and files per pipe and hour."""
    from riverbed.operators import monitor
    ledger = _dated(spark, sf)
    return monitor.load_volume(ledger, _newest_load(ledger), 360)


@query
def run_history_dated(spark, sf):
    """M4 + S14 + S15 + L3: runs with their durations, in the report's order."""
    from riverbed.functions.parse import seconds_between
    from riverbed.operators import monitor
    ledger = _dated(spark, sf)
    start = F.timestamp_add("SECOND", 3 + F.col("file_no"), F.col("last_load_time"))
    runs = ledger.select(
        F.concat(F.lit("LOAD_"), F.col("pipe_name")).alias("name"),
        F.when(F.col("error_count") > 2, "FAILED").otherwise("SUCCEEDED").alias("state"),
        F.lit("INCREMENTAL").alias("refresh_action"), F.col("last_load_time").alias("scheduled_time"),
        start.alias("start_time"), F.timestamp_add("SECOND", F.col("row_count") % 97 + 1, start).alias("end_time"),
        "row_count")
    found = monitor.run_history(runs, "LOAD_PIPE_0", _newest_load(ledger), 24 * 15)
    return _placed(found).select("place", "name", "state", "scheduled_time", "start_time", "row_count",
                                 seconds_between(F.col("start_time"), F.col("end_time")).alias("duration_sec"))


# -- ingestion (A1-A13, M1) -----------------------------------------------------------
RAW_TRANS_TEXT = ("trans_num_raw", "trans_date_raw", "card_num_raw", "amount_raw", "merchant_raw",
                  "category_raw", "is_fraud_raw")


def _write_raw_trans_csv(spark, sf, path):
    """Raw transactions as CSV files: NULL amounts as 'NULL' / 'null' tokens,
    categories padded with unquoted spaces (both undone by the reader)."""
    from riverbed.sources.csv import write_text_csv
    t = fx.trans_events(spark, sf)
    token = F.when(F.col("event_id") % 2 == 0, F.lit("NULL")).otherwise(F.lit("null"))
    out = t.select(*[F.coalesce(F.col(c), token).alias(c) if c == "amount_raw" else
                     F.concat(F.lit(" "), F.col(c), F.lit(" ")).alias(c) if c == "category_raw" else
                     F.col(c) for c in RAW_TRANS_TEXT])
    write_text_csv(out, path)


@query
def ingest_csv(spark, sf):
    """CSV files read back as the raw landing table."""
    import datetime as dt

    from riverbed.session import scratch_path
    from riverbed.sources.csv import default_positions, read_landing
    root = scratch_path(spark, "ingest_csv")
    _write_raw_trans_csv(spark, sf, f"{root}/src")
    landed = read_landing(spark, f"{root}/src", len(RAW_TRANS_TEXT), default_positions(RAW_TRANS_TEXT),
                          dt.datetime(2024, 2, 1))
    return landed.select(*RAW_TRANS_TEXT)


@query
def ingest_lineage(spark, sf):
    """A4: file name and row number of every row of files of known order."""
    import datetime as dt

    from riverbed.plans.monitoring import TEXT, deliver
    from riverbed.session import scratch_path
    from riverbed.sources.csv import CsvFormat, default_positions, read_landing
    root, cols = scratch_path(spark, "lineage"), TEXT["raw_trans"]
    deliver(fx.raw_trans(spark, sf), cols, root)
    landed = read_landing(spark, root, len(cols), default_positions(cols), dt.datetime(2024, 2, 1),
                          CsvFormat(header=False))
    return landed.select(F.regexp_extract("meta_filename", "src_file=([^/]+)/", 1).alias("file_name"),
                         "meta_file_row_number", "trans_num_raw", "trans_date_raw")


@query
def file_inventory(spark, sf):
    """The delivered files of a source folder."""
    from riverbed.plans.monitoring import monitored
    from riverbed.sources.csv import file_inventory as inventory
    files = inventory(spark, f"{monitored(spark, sf)}/src/raw_trans", "*.txt")
    return files.select(F.regexp_extract("name", "src_file=([^/]+)/", 1).alias("name"),
                        "size")


@query
def ingest_late_files(spark, sf):
    """A6 + A7: the files of odd number are delivered after the others were
    loaded, with times 40 days older. Each file lands once; the last run finds
    nothing. One row per landed row, with the run it came with."""
    import datetime as dt

    from riverbed.plans.monitoring import TEXT, deliver, pipe
    from riverbed.session import glob_paths, scratch_path, set_file_time
    root, cols = scratch_path(spark, "late_files"), TEXT["raw_trans"]
    rows = fx.raw_trans(spark, sf).withColumn(
        "number", F.regexp_extract("meta_filename", "_([0-9]+)", 1).cast("int"))
    loader = pipe(spark, root, "raw_trans")
    deliver(rows.filter("number % 2 = 0"), cols, f"{root}/src/raw_trans/first")
    batches = [loader.run_available_now()]
    deliver(rows.filter("number % 2 = 1"), cols, f"{root}/src/raw_trans/second")
    old = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None) - dt.timedelta(days=40)
    # One call per delivered file; the names of the delivery are the driver's.
    for name in glob_paths(spark, f"{root}/src/raw_trans/second/*/*.txt"):
        set_file_time(spark, name, old)
    batches += [loader.run_available_now(), loader.run_available_now()]
    of_run = F.create_map(*[F.lit(x) for k, ids in enumerate(batches) for b in ids for x in (b, k)])
    return (loader.landing().withColumn("run", of_run[F.col("batch_id")])
            .select("run", F.regexp_extract("meta_filename", "src_file=([^/]+)/", 1).alias("file_name"),
                    "meta_file_row_number", "trans_num_raw"))


@query
def any_rows(spark, sf):
    """L2: any 10 landed rows; which ones is open, so they are counted."""
    from riverbed.operators.monitor import any_rows as anyn
    return anyn(fx.raw_trans(spark, sf), 10).agg(F.count(F.lit(1)).alias("n"))


@query
def idle_run(spark, sf):
    """A11 + A15: a run without new files lands nothing, a table that is there
    is not created again, and every landed batch is applied."""
    from riverbed.plans import monitoring
    root = monitoring.monitored(spark, sf)
    pipe = monitoring.pipe(spark, root, "raw_trans")
    feed, table = monitoring.LandingFeed(spark, pipe.landing_path), monitoring.conformed_table(spark, f"{root}/conformed")
    before = feed.committed_batches()
    pipe.run_available_now()
    created = table.create_if_missing(table.schema())
    return table.read().agg(F.count(F.lit(1)).alias("conformed_rows")).select(
        "conformed_rows", F.lit(len(feed.committed_batches()) - len(before)).alias("new_batches"),
        F.lit(len(feed.pending(table.applied_batches()))).alias("unread_batches"), F.lit(created).alias("created"))


@query
def v1_table_counts(spark, sf):
    """G1: landing, unread change feed, conformed and archive tables."""
    from riverbed.operators.monitor import table_counts as counts
    from riverbed.plans import monitoring
    root = monitoring.monitored(spark, sf)
    feed = monitoring.LandingFeed(spark, f"{root}/raw_trans/landing")
    table = monitoring.conformed_table(spark, f"{root}/conformed")
    landing = spark.read.parquet(feed.path)
    unread = landing.filter(~F.col("batch_id").isin(*table.applied_batches()))
    tm = trans_merch(spark, sf)
    return counts({"landing": landing, "landing_feed": unread, "conformed": table.read(), "dt_trans_merch": tm,
                   "dt_trans_all_clients": fraud.trans_all_clients(tm, _scd2(spark, sf))})


@query
def newest_derived(spark, sf):
    """L1: key and load time of the newest 10 rows of each derived table."""
    from riverbed.operators.monitor import newest
    out = None
    tables = _derived(spark, sf)
    for name, key in (("dt_transactions", "trans_num"), ("dt_invalid_trans", "trans_num"), ("dt_merchants", "merchant"),
                      ("dt_clients_scd2", "card_num"), ("dt_fraud_full", "trans_num")):
        one = newest(spark.read.parquet(tables[name]), [F.col("meta_load_ts").desc(), F.col(key)]).select(
            F.lit(name).alias("table_name"), F.col(key).alias("row_key"), "meta_load_ts")
        out = one if out is None else out.unionByName(one)
    return out


@query
def wide_csv_round_trip(spark, sf):
    """A12 + A3: the merchant file of the split, written as CSV and read back
    by position, as text."""
    import datetime as dt

    from riverbed.session import scratch_path
    from riverbed.sources.csv import default_positions, read_landing
    from riverbed.sources.wide import MERCHANT_COLS, write_csv
    root = scratch_path(spark, "wide_csv")
    write_csv(_split(spark, sf)["merchant"], root)
    return read_landing(spark, root, len(MERCHANT_COLS), default_positions(MERCHANT_COLS),
                        dt.datetime(2024, 2, 1)).select(*MERCHANT_COLS)


@query
def ingest_stream_upsert(spark, sf):
    """V1 wide files delivered in five-day arrivals;
    after each arrival the pipe runs (availableNow) and the consumer upserts
    the new landing batches into the conformed table. The file name of the
    conformed row is a generated part-file name, so it is not returned."""
    import datetime as dt

    from riverbed.plans.incremental import conformed_table, typed_landing_v1, upsert_conformed
    from riverbed.session import scratch_path
    from riverbed.sources.csv import write_text_csv
    from riverbed.streaming.ingest import FileIngest, LandingFeed

    root = scratch_path(spark, "stream_upsert")
    wide = fx.v1_wide(spark, sf)
    arrivals = sorted(r[0] for r in wide.select("arrival").distinct().collect())  # a handful
    pipe = FileIngest(spark, f"{root}/src", f"{root}/pipe", n_fields=fx.V1_FIELDS,
                      positions=fx.V1_POSITIONS, pipe_name="PIPE_V1", table_name="LANDING",
                      typing=typed_landing_v1)
    feed = LandingFeed(spark, pipe.landing_path)
    table = conformed_table(spark, f"{root}/conformed")
    for k in arrivals:
        files = (wide.filter(F.col("arrival") == k).repartition("c19")
                 .sortWithinPartitions("event_id").select(*[f"c{i}" for i in range(1, 24)]))
        write_text_csv(files, f"{root}/src/arrival={k}")
        stamp = dt.datetime(2024, 1, 1) + dt.timedelta(days=5 * (k + 1))
        pipe.clock = lambda _b, s=stamp: s
        pipe.run_available_now()
        feed.consume(lambda rows, b, t: upsert_conformed(table, rows, b, t), f"{root}/conformed_offset")
    return table.read().drop("source_filename")


# -- H15: the V2 models refreshed in dependency order --------------------------------
def _refresh_v2(spark, sf):
    from riverbed.plans.pipeline import fraud_v2
    from riverbed.session import scratch_path
    root = scratch_path(spark, "v2")
    # Intermediate derived tables are written (lineage cut, later readers scan Parquet).
    paths = {n: f"{root}/{n}" for n in ("dt_transactions", "dt_merchants", "dt_clients_deduped", "dt_clients_scd2")}
    return fraud_v2(fx.raw_tables(spark, sf)).refresh(
        spark, ["dt_fraud_full", "dt_invalid_trans"], paths=paths)


@query
def v2_pipeline_fact(spark, sf):
    """dt_fraud_full produced by the dependency-ordered refresh (= fraud_full)."""
    frames, _ = _refresh_v2(spark, sf)
    return frames["dt_fraud_full"]


@query
def v2_refresh_runs(spark, sf):
    """H15 + M8: one run row per refreshed model with its row count
    (materialised models; the others are views and report no count)."""
    _, runs = _refresh_v2(spark, sf)
    return runs.select("name", "state", "refresh_action", "row_count")


# -- V2 ingest end to end: one pipe per entity folder (A2, A3, A6, A9) -------------------
# Positions of the three entity files, as the reference's loaders read them:
# clients skip $8 (zip), merchants skip $1 (trans_num).
V2_FILES = {
    "raw_trans": (7, {"trans_num_raw": 1, "trans_date_raw": 2, "card_num_raw": 3, "amount_raw": 4,
                      "merchant_raw": 5, "category_raw": 6, "is_fraud_raw": 7}),
    "raw_clients": (10, {"card_num_raw": 1, "first_name_raw": 2, "last_name_raw": 3, "gender_raw": 4,
                         "street_raw": 5, "city_raw": 6, "state_raw": 7, "job_raw": 9,
                         "date_birth_raw": 10}),
    "raw_merch": (4, {"merchant_raw": 2, "merchant_lat_raw": 3, "merchant_long_raw": 4}),
}


def _entity_files(spark, sf):
    """The three entity files in the reference's column order."""
    raw = fx.raw_tables(spark, sf)
    c = raw["raw_clients"]
    m = raw["raw_merch"]
    return {
        "raw_trans": raw["raw_trans"].select(*[F.col(n) for n in V2_FILES["raw_trans"][1]]),
        "raw_clients": c.select("card_num_raw", "first_name_raw", "last_name_raw", "gender_raw",
                                "street_raw", "city_raw", "state_raw",
                                F.lit("00000").alias("zip"), "job_raw", "date_birth_raw"),
        "raw_merch": m.select(F.concat(F.lit("T-"), F.col("merchant_raw")).alias("trans_num"),
                              "merchant_raw", "merchant_lat_raw", "merchant_long_raw"),
    }


@query
def ingest_v2_counts(spark, sf):
    """E2 ingest: each entity's files land through its own pipe; the landed
    raw tables are parsed and counted (positions, NULL tokens and parsers)."""
    import datetime as dt

    from riverbed.functions.parse import DATE_DMY, try_date, try_decimal
    from riverbed.session import scratch_path
    from riverbed.sources.csv import write_text_csv
    from riverbed.streaming.ingest import FileIngest

    root = scratch_path(spark, "v2_ingest")
    landed = {}
    for name, files in _entity_files(spark, sf).items():
        n_fields, positions = V2_FILES[name]
        write_text_csv(files, f"{root}/src/{name}")
        pipe = FileIngest(spark, f"{root}/src/{name}", f"{root}/{name}", n_fields=n_fields,
                          positions=positions, pipe_name=f"PIPE_{name.upper()}",
                          table_name=name.upper(), clock=lambda _b: dt.datetime(2024, 2, 1))
        pipe.run_available_now()
        landed[name] = pipe.landing()
    txn = fraud.stg_transactions(landed["raw_trans"])
    parts = [
        txn.groupBy(F.col("validation_status").alias("metric")).agg(F.count(F.lit(1)).alias("n"))
           .select(F.lit("raw_trans").alias("table_name"), "metric", "n"),
        landed["raw_clients"].agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(try_date("date_birth_raw", DATE_DMY)).alias("valid_birth"),
            F.count_distinct("card_num_raw").alias("cards"),
            F.count(F.when(F.col("job_raw").startswith("1-") | F.col("job_raw").startswith("2-")
                           | F.col("job_raw").startswith("3-") | F.col("job_raw").startswith("4-")
                           | F.col("job_raw").startswith("5-"), 1)).alias("job_like"))
        .select(F.lit("raw_clients").alias("table_name"),
                F.explode(F.create_map(*[x for k in ("rows", "valid_birth", "cards", "job_like")
                                         for x in (F.lit(k), F.col(k))])).alias("metric", "n")),
        landed["raw_merch"].agg(
            F.count(F.lit(1)).alias("rows"),
            F.count(try_decimal("merchant_lat_raw", 11, 8)).alias("valid_lat"),
            F.count_distinct("merchant_raw").alias("merchants"))
        .select(F.lit("raw_merch").alias("table_name"),
                F.explode(F.create_map(*[x for k in ("rows", "valid_lat", "merchants")
                                         for x in (F.lit(k), F.col(k))])).alias("metric", "n")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("table_name", "metric", F.col("n").cast("bigint").alias("n"))


@query
def fraud_full_sweep(spark, sf):
    """J2 skew-safe form: the enriched fact with the day-bucketed as-of sweep
    (= fraud_full)."""
    return fraud.enriched_fact(_txn(spark, sf), _merch(spark, sf), _scd2(spark, sf), as_of="sweep")
