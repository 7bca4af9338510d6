"""Quality counts, previews and monitoring reports.

The reference reads its platform's load, task and alert history views. Spark
has none, so the ingest writes its own ledger (one row per file and batch,
``riverbed.streaming.ingest``) and every run writes a run row; the reports
below are ordinary aggregations and filters over those tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.parse import floor_ntz, lookback, seconds_between

LEDGER_COLS = ("status", "pipe_name", "table_name", "file_name", "file_size", "row_count",
               "error_count", "pipe_received_time", "last_load_time")
RUN_COLS = ("name", "state", "refresh_action", "scheduled_time", "start_time", "end_time",
            "row_count")


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """G1: ``SELECT COUNT(*)`` per table, unioned to (table_name, n)."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def written_table_counts(spark: SparkSession, paths: Mapping[str, str]) -> DataFrame:
    """G1 for tables that are written as Parquet: ``COUNT(*)`` is pushed down
    into the files' footers, one scan per table and no row is read. The
    settings that allow it belong to a session of their own."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    counts = table_counts({name: own.read.parquet(path) for name, path in paths.items()})
    # Without row groups the pushed count is NULL, though COUNT says it never is.
    return counts.groupBy("table_name").agg(F.coalesce(F.sum("n"), F.lit(0).cast("bigint")).alias("n"))


def newest(df: DataFrame, order: list[Column], n: int = 10) -> DataFrame:
    """L1: newest ``n`` rows (``TakeOrderedAndProject``: top-n per task, then
    a merge of n x tasks rows; never a full sort)."""
    return df.orderBy(*order).limit(n)


def any_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """L2: any ``n`` rows (non-deterministic by definition)."""
    return df.limit(n)


def exists(df: DataFrame) -> DataFrame:
    """``EXISTS (subquery)`` as a one-row boolean DataFrame; the scan
    stops at the first row."""
    return df.limit(1).agg((F.count(F.lit(1)) > 0).alias("exists"))


def load_stats(ledger: DataFrame, pipe: str, as_of, hours: int = 24) -> DataFrame:
    """Per (status, pipe, load time): avg and max latency in seconds,
    rows loaded and files, over the look-back window, newest first."""
    lat = seconds_between(F.col("pipe_received_time"), F.col("last_load_time"))
    return (ledger.filter((F.col("pipe_name") == pipe) &
                          (F.col("last_load_time") >= lookback(as_of, hours)))
            .groupBy("status", "pipe_name", "last_load_time")
            .agg(F.avg(lat).cast("decimal(18,3)").alias("avg_latency_sec"),
                 F.max(lat).alias("max_latency_sec"),
                 F.sum("row_count").cast("bigint").alias("total_rows_loaded"),
                 F.count(F.lit(1)).alias("files_processed"))
            .orderBy(F.col("last_load_time").desc()))


def load_volume(ledger: DataFrame, as_of, hours: int = 24, grain: str = "hour") -> DataFrame:
    """M3: bytes and files inserted per pipe and time grain."""
    start = floor_ntz(F.col("last_load_time"), grain)
    step = {"hour": "HOUR", "day": "DAY", "minute": "MINUTE"}[grain]
    return (ledger.filter(F.col("last_load_time") >= lookback(as_of, hours))
            .groupBy(start.alias("start_time"), "pipe_name")
            .agg(F.sum("file_size").cast("bigint").alias("bytes_inserted"),
                 F.count(F.lit(1)).alias("files_inserted"))
            .withColumn("end_time", F.timestamp_add(step, F.lit(1), F.col("start_time"))))


def window_runs(ts: Column, every_minutes: int) -> Column:
    """Scheduled alert runs whose closed window ``[t - every, t]`` holds ``ts``
    (S16 BETWEEN): the next boundary at or after ``ts``, and also the one
    after it when ``ts`` sits exactly on a boundary (closed windows on both
    ends count it twice, as the reference does). Returns an array so that the
    evaluation is an explode + group by instead of a range join."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    s = F.timestamp_diff("MICROSECOND", epoch, ts)
    step = F.lit(every_minutes * 60 * 1_000_000)
    up = F.ceil(s / step).cast("bigint") * step
    first = F.timestamp_add("MICROSECOND", up, epoch)
    on_boundary = (s % step) == 0
    return F.when(on_boundary, F.array(first, F.timestamp_add("MINUTE", F.lit(every_minutes), first))) \
            .otherwise(F.array(first))


def alert_runs(events: DataFrame, ts_col: str, alert_name: str, every_minutes: int = 15) -> DataFrame:
    """M5 / M6: the scheduled runs at which ``EXISTS (matching rows in the
    window)`` is true, with the number of matching rows."""
    return (events.select(F.explode(window_runs(F.col(ts_col), every_minutes)).alias("scheduled_time"))
            .groupBy("scheduled_time").agg(F.count(F.lit(1)).alias("matching_rows"))
            .select(F.lit(alert_name).alias("alert_name"), "scheduled_time", "matching_rows"))


def load_error_alert(ledger: DataFrame, pipe: str, table: str, every_minutes: int = 15) -> DataFrame:
    """M5: files of the pipe and table with load errors, per alert run."""
    bad = ledger.filter((F.col("pipe_name") == pipe) & (F.col("table_name") == table) &
                        (F.col("error_count") > 0))
    return alert_runs(bad, "last_load_time", "LOAD_ERRORS", every_minutes)


def run_failure_alert(runs: DataFrame, task: str, every_minutes: int = 15) -> DataFrame:
    """M6: failed runs of the task, per alert run."""
    failed = runs.filter((F.col("name") == task) & (F.col("state") == "FAILED"))
    return alert_runs(failed, "start_time", "TASK_FAILED", every_minutes)


def run_history(runs: DataFrame, task: str, as_of, hours: int = 24) -> DataFrame:
    """M4: runs of one task in the look-back window."""
    return (runs.filter((F.col("name") == task) &
                        (F.col("scheduled_time") >= lookback(as_of, hours)))
            .orderBy(F.col("scheduled_time").desc(), F.col("start_time").desc()))


def refresh_history(runs: DataFrame, name_like: str = "DT_%") -> DataFrame:
    """M8: refresh rows of the matching models (S17: ``_`` is a wildcard),
    by start time."""
    return (runs.filter(F.col("name").like(name_like))
            .select("name", "state", "refresh_action", "start_time", "end_time", "row_count")
            .orderBy("start_time", "name"))
