"""Monitoring helpers."""

import datetime as dt

from pyspark.sql import functions as F

from riverbed.operators import monitor

D = dt.datetime


def test_alert_windows_are_closed_on_both_ends(spark):
    df = spark.createDataFrame([(D(2024, 1, 1, 0, 15),), (D(2024, 1, 1, 0, 20),)], "ts timestamp_ntz")
    runs = sorted(r.scheduled_time for r in monitor.alert_runs(df, "ts", "A").collect())
    # 00:15 sits on a boundary: seen by the 00:15 and the 00:30 run
    assert runs == [D(2024, 1, 1, 0, 15), D(2024, 1, 1, 0, 30)]
    counts = {r.scheduled_time: r.matching_rows for r in monitor.alert_runs(df, "ts", "A").collect()}
    assert counts[D(2024, 1, 1, 0, 30)] == 2


def test_like_wildcard_and_exists(spark):
    runs = spark.createDataFrame(
        [("DT_A", "SUCCEEDED", "FULL", D(2024, 1, 1), D(2024, 1, 1), D(2024, 1, 1), 1),
         ("DTAX", "SUCCEEDED", "FULL", D(2024, 1, 1), D(2024, 1, 1), D(2024, 1, 1), 1),
         ("XDT_", "SUCCEEDED", "FULL", D(2024, 1, 1), D(2024, 1, 1), D(2024, 1, 1), 1)],
        "name string, state string, refresh_action string, scheduled_time timestamp_ntz, "
        "start_time timestamp_ntz, end_time timestamp_ntz, row_count bigint")
    names = {r.name for r in monitor.refresh_history(runs).collect()}
    assert names == {"DT_A", "DTAX"}  # '_' is a wildcard
    assert monitor.exists(runs.filter(F.col("name") == "DTAX")).first()[0] is True
    assert monitor.exists(runs.filter(F.col("name") == "none")).first()[0] is False


def test_counts_come_from_footers(spark, tmp_dir):
    for name, n in (("a", 1000), ("b", 0)):
        spark.range(n).write.parquet(f"{tmp_dir}/{name}")
    counts = monitor.written_table_counts(spark, {n: f"{tmp_dir}/{n}" for n in "ab"})
    assert {r.table_name: r.n for r in counts.collect()} == {"a": 1000, "b": 0}
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.split("== Initial Plan ==")[-1].count("PushedAggregation: [COUNT(*)]") == 2
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_load_stats_looks_at_the_latency_of_every_load(spark):
    from riverbed.plans.queries import REGISTRY
    rows = [r.asDict() for r in REGISTRY["load_stats"](spark, "/root/testdata/sf0.001").collect()]
    assert rows and all(r["latency_known"] is True and r["avg_within_max"] is True for r in rows)


def test_run_history_looks_at_the_end_of_every_run(spark):
    from riverbed.plans.queries import REGISTRY
    rows = [r.asDict() for r in REGISTRY["run_history"](spark, "/root/testdata/sf0.001").collect()]
    assert rows and all(r["ended"] is True for r in rows)
