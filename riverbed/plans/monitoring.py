"""The monitored pipeline: real loads, runs and alerts for the reports (M1-M9).

The raw rows are delivered as delimited files, one per source file name, and
loaded by one pipe per entity; the pipes write their own ledger. The upsert
task and the model refresh then run over what was loaded and append one run
row each, failed runs included; alerts that fire are appended too. All times
are the clock's. This is done once per session and input folder; the reports
only read the tables it left.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.operators import monitor
from riverbed.plans import fraud
from riverbed.plans.incremental import conformed_table, typed_landing, upsert_conformed
from riverbed.plans.pipeline import Pipeline, RunLog, stream_runs
from riverbed.session import path_exists, scratch_path
from riverbed.sources import fixtures as fx
from riverbed.sources.csv import CsvFormat, default_positions
from riverbed.streaming.ingest import FileIngest, LandingFeed

TEXT = {
    "raw_trans": ("trans_num_raw", "trans_date_raw", "card_num_raw", "amount_raw", "merchant_raw",
                  "category_raw", "is_fraud_raw"),
    "raw_clients": ("card_num_raw", "first_name_raw", "last_name_raw", "gender_raw", "date_birth_raw",
                    "job_raw", "street_raw", "city_raw", "state_raw"),
    "raw_merch": ("merchant_raw", "merchant_lat_raw", "merchant_long_raw"),
}
# Delivered transactions of these event ids carry one field too many.
MALFORMED_EVERY = 499
_DONE: dict[tuple[str, str], str] = {}


def deliver(rows: DataFrame, cols: tuple[str, ...], path: str, tail: Column | None = None) -> None:
    """Rows as header-less delimited lines, one folder with one file per
    source file, in the order of their row numbers; ``tail`` ends a line."""
    line = F.concat_ws(",", *[F.coalesce(F.col(c), F.lit("NULL")) for c in cols])
    (rows.withColumn("src_file", F.col("meta_filename")).repartition("src_file")
     .sortWithinPartitions("src_file", "meta_file_row_number")
     .select("src_file", F.concat(line, F.lit("") if tail is None else tail).alias("value"))
     .write.partitionBy("src_file").text(path))


def pipe(spark: SparkSession, root: str, name: str) -> FileIngest:
    """The pipe of one entity."""
    return FileIngest(spark, f"{root}/src/{name}", f"{root}/{name}", n_fields=len(TEXT[name]),
                      positions=default_positions(TEXT[name]), fmt=CsvFormat(header=False),
                      pipe_name=f"PIPE_{name[4:].upper()}", table_name=name.upper())


def amount_audit(txn: DataFrame) -> DataFrame:
    """A model that fails while the transactions hold an unreadable amount."""
    if not txn.filter(F.col("validation_status") == "INVALID_AMOUNT").isEmpty():
        raise ValueError("unreadable amounts")
    return txn.select("trans_num", "amount")


def monitored(spark: SparkSession, sf_dir: str) -> str:
    """Root folder with ``<entity>/ledger``, ``runs`` and ``alerts``."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    root = _DONE.get(key)
    if root is not None and path_exists(spark, f"{root}/alerts/_SUCCESS"):
        return root
    root = scratch_path(spark, "monitored")
    sources = {**fx.raw_tables(spark, sf_dir), "raw_trans": fx.trans_events(spark, sf_dir)}
    bad_line = F.when(F.col("event_id") % MALFORMED_EVERY == 0, F.lit(",extra")).otherwise(F.lit(""))
    landed = {}
    for name, cols in TEXT.items():
        deliver(sources[name], cols, f"{root}/src/{name}", bad_line if name == "raw_trans" else None)
        loader = pipe(spark, root, name)
        loader.run_available_now()
        landed[name] = loader.landing()

    # Task: the feed's stream, its runs as the stream reports them.
    log = RunLog(spark, f"{root}/runs")
    feed, table = LandingFeed(spark, f"{root}/raw_trans/landing"), conformed_table(spark, f"{root}/conformed")
    query = feed.consume(lambda rows, b, t: upsert_conformed(table, typed_landing(rows), b, t), f"{root}/conformed_offset")
    log.held += stream_runs(query, "CONFORMED_UPSERT", feed.rows_of_epoch)
    log.flush()

    # Models: the audit fails on bad data, the models beside it are refreshed.
    p = Pipeline(landed)
    p.model("dt_transactions", ["raw_trans"])(fraud.stg_transactions)
    p.model("dt_amount_audit", ["dt_transactions"])(amount_audit)
    p.model("dt_clean_amounts", ["dt_amount_audit"])(lambda a: a.filter("amount > 0"))
    p.model("dt_merchants", ["raw_merch"])(
        lambda m: fraud.dim_merchants_cols(fraud.merchants_latest(fraud.stg_merchants(m))))
    p.model("stg_clients", ["raw_clients"])(fraud.stg_clients)
    p.refresh(spark, paths={n: f"{root}/{n}" for n in p.models}, log=log, on_failure="continue")

    alerts = (monitor.load_error_alert(ledger(spark, root), "PIPE_TRANS", "RAW_TRANS")
              .unionByName(monitor.run_failure_alert(runs(spark, root), "DT_AMOUNT_AUDIT")))
    alerts.write.mode("append").parquet(f"{root}/alerts")
    _DONE[key] = root
    return root


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """The ledger rows of all pipes (M1), with the source file's own name."""
    out = None
    for name in TEXT:
        one = spark.read.parquet(f"{root}/{name}/ledger")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("file_name", F.regexp_extract("file_name", "src_file=([^/]+)/", 1))


def runs(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/runs")


def alerts(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/alerts")
