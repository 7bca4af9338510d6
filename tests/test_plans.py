"""Plan shapes that matter at scale (read from ``explain``)."""

import contextlib
import io

from riverbed.plans.queries import REGISTRY

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_enriched_fact_plan(spark):
    p = plan(REGISTRY["fraud_full"](spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    # the as-of join is an equi join on the key with the interval as residual
    assert "LeftOuter" in p and "card_num" in p
    # dedupe ships at most one row per key and task through the shuffle
    assert "WindowGroupLimit" in p and "Partial" in p


def test_scans_are_pruned(spark):
    p = plan(REGISTRY["wide_normalise_client"](spark, SF))
    # lineitem is read with only the columns the client file needs
    line = next(x for x in p.splitlines() if "ReadSchema" in x and "l_orderkey" in x)
    assert "l_comment" not in line and "l_tax" not in line and "l_quantity" not in line
    assert "HashAggregate" in p  # partial distinct before the exchange


def test_keyed_read_has_one_exchange(spark, tmp_dir):
    from pyspark.sql import functions as F

    from riverbed.operators.upsert import KeyedTable
    batch = spark.range(200).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    for tracked, partial in ((None, True), (["v"], False)):
        t = KeyedTable(spark, f"{tmp_dir}/{partial}", ["k"], tracked=tracked)
        t.merge(batch, batch_id=0)
        t.merge(batch.filter("v < 20"), batch_id=1)
        p = plan(t.read())
        assert p.count("Arguments: hashpartitioning(") == 1 and "Join" not in p
        # the latest-row form ships at most one row per key and task
        assert ("WindowGroupLimit" in p and "Partial" in p) == partial


def test_as_of_join_without_broadcast_is_a_sort_merge_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(REGISTRY["fraud_full"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
    assert "SortMergeJoin LeftOuter" in p
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
