"""Dependency-ordered refresh equals the direct model composition."""

from riverbed.plans import fraud
from riverbed.plans.pipeline import fraud_v2
from riverbed.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_v2_pipeline(spark, tmp_dir):
    raw = fx.raw_tables(spark, SF)
    p = fraud_v2(raw)
    order = p.order(["dt_fraud_full"])
    assert order.index("dt_clients_deduped") < order.index("dt_clients_scd2") < order.index("dt_fraud_full")
    assert "dt_invalid_trans" not in order
    frames, runs = p.refresh(spark, ["dt_fraud_full", "dt_invalid_trans"],
                             paths={"dt_transactions": f"{tmp_dir}/dt_transactions"})
    direct = fraud.v2_models(raw)
    assert frames["dt_fraud_full"].exceptAll(direct["dt_fraud_full"]).count() == 0
    assert frames["dt_fraud_full"].count() == direct["dt_fraud_full"].count()
    assert runs.count() == 6
    assert runs.filter("name = 'DT_TRANSACTIONS'").first().row_count == direct["dt_transactions"].count()


def test_failed_runs_are_stored(spark, tmp_dir):
    from pyspark.sql import functions as F

    from riverbed.plans.pipeline import Pipeline, RunLog

    def broken(_df):
        raise ValueError("no")

    p = Pipeline({"src": spark.range(10)})
    p.model("a", ["src"])(lambda s: s)
    p.model("b", ["a"])(broken)
    p.model("c", ["b"])(lambda b: b)
    p.model("d", ["a"])(lambda a: a.filter("id < 4"))
    paths = {n: f"{tmp_dir}/{n}" for n in "abcd"}
    _, runs = p.refresh(spark, paths=paths, log=RunLog(spark, f"{tmp_dir}/runs"), on_failure="continue")
    want = {("A", "SUCCEEDED", 10), ("B", "FAILED", None), ("C", "UPSTREAM_FAILED", None), ("D", "SUCCEEDED", 4)}
    assert {(r.name, r.state, r.row_count) for r in runs.collect()} == want
    try:
        p.refresh(spark, paths=paths, log=RunLog(spark, f"{tmp_dir}/runs"))
        raise AssertionError("a failing model ends the refresh")
    except ValueError:
        pass
    stored = spark.read.parquet(f"{tmp_dir}/runs")
    assert stored.count() == 6 and stored.filter(F.col("state") == "FAILED").count() == 2
    assert stored.filter(F.col("end_time") < F.col("start_time")).count() == 0
