"""Changes carried to the enriched fact, and runs that read only what is new."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riverbed.operators.upsert import KeyedTable
from riverbed.plans import fraud
from riverbed.plans.incremental import FraudWarehouse, land_batches
from riverbed.plans.pipeline import RunLog
from riverbed.plans.propagate import FraudFact

D = dt.datetime
TRANS = ("trans_num_raw string, trans_date_raw string, card_num_raw string, amount_raw string, merchant_raw string, "
         "category_raw string, is_fraud_raw string, meta_filename string, meta_file_row_number bigint, "
         "meta_load_ts timestamp_ntz, batch_id int")
CLIENTS = ("card_num_raw string, first_name_raw string, last_name_raw string, gender_raw string, date_birth_raw string, "
           "job_raw string, street_raw string, city_raw string, state_raw string, meta_filename string, "
           "meta_file_row_number bigint, meta_load_ts timestamp_ntz, batch_id int")
MERCH = ("merchant_raw string, merchant_lat_raw string, merchant_long_raw string, meta_filename string, "
         "meta_file_row_number bigint, meta_load_ts timestamp_ntz, batch_id int")


def landing(spark):
    def t(batch, n, card, day, merchant="m1"):
        return (f"t{n}", f"{day:02d}-01-2024 12:00", card, "1.5", merchant, "c", "0", "t.csv", n, D(2024, 1, 28), batch)

    def c(batch, n, card, name, day):
        return (card, name, "l", "F", "01-01-1990", "j", "s", "c", "st", f"c{batch}.csv", n, D(2024, 1, day), batch)

    trans = [t(0, n, f"k{n % 4}", 1 + n % 20) for n in range(40)] + [t(0, 40, None, 3), t(0, 41, "k0", 3, None),
             t(0, 42, "k1", 9, "m2"), t(1, 43, "k0", 12), t(2, 44, "k9", 12)]
    clients = [c(0, n, f"k{n}", f"first{n}", 2) for n in range(4)] + [c(0, 9, None, "none", 2), c(0, 10, "k0", "second", 15)]
    clients += [c(1, 1, "k0", "late", 8), c(1, 2, "k3", "first3", 2)]  # between two versions; a repeated load
    clients += [c(2, 1, "k9", "new", 1)]
    merch = [("m1", "1.5", "2.5", "m.csv", 1, D(2024, 1, 1), 0), (None, "9", "9", "m.csv", 2, D(2024, 1, 1), 0),
             ("m2", "3.5", "4.5", "m.csv", 3, D(2024, 1, 1), 1), ("m1", "0", "0", "m.csv", 4, D(2023, 1, 1), 2)]
    return {"raw_trans": spark.createDataFrame(trans, TRANS), "raw_clients": spark.createDataFrame(clients, CLIENTS),
            "raw_merch": spark.createDataFrame(merch, MERCH)}


def recomputed(raw, upto):
    raw = {k: v.filter(F.col("batch_id") <= upto).drop("batch_id") for k, v in raw.items()}
    return sorted(map(str, fraud.v2_models(raw)["dt_fraud_full"].collect()))


def test_late_versions_reach_the_fact_and_only_their_rows(spark, tmp_dir):
    raw = landing(spark)
    fact, log = FraudFact(spark, f"{tmp_dir}/fact"), RunLog(spark)
    touched = []
    for n in range(3):
        assert fact.refresh(raw, n, log)
        assert sorted(map(str, fact.read().collect())) == recomputed(raw, n)
        batch = spark.read.parquet(f"{tmp_dir}/fact/dt_fraud_full/data").filter(F.col("_batch") == n)
        touched.append({r.meta_file_row_number for r in batch.collect()})
    assert not fact.refresh(raw, 2, log)
    # Batch 1: the new row, the fact of the new merchant, and card k0 from the 8th on.
    k0 = {n for n in range(40) if n % 4 == 0 and 1 + n % 20 >= 8}
    assert touched[1] == {43, 42} | k0
    assert touched[2] == {44}  # an older merchant row changes nothing
    assert [(r.refresh_action, r.row_count) for r in log.held] == [
        ("FULL", 43), ("INCREMENTAL", len(touched[1])), ("INCREMENTAL", 1)]


@pytest.mark.parametrize("dies_at", ["merchants", "history", "versions", "facts"])
def test_a_refresh_that_died_is_run_again(spark, tmp_dir, monkeypatch, dies_at):
    raw = landing(spark)
    FraudFact(spark, f"{tmp_dir}/fact").refresh(raw, 0)
    dying = FraudFact(spark, f"{tmp_dir}/fact")
    table = getattr(dying, dies_at)
    merge = table.merge

    def once(*a, **k):
        if dies_at != "facts":
            merge(*a, **k)
        raise OSError("driver lost")

    monkeypatch.setattr(table, "merge", once)
    with pytest.raises(OSError):
        dying.refresh(raw, 1)
    again = FraudFact(spark, f"{tmp_dir}/fact")
    assert again.refresh(raw, 1)
    assert sorted(map(str, again.read().collect())) == recomputed(raw, 1)


def test_a_run_reads_the_unread_batches_only(spark, tmp_dir):
    """Folders of applied batches are gone when the next run comes."""
    raw = landing(spark)
    for name, df in raw.items():
        df.write.partitionBy("batch_id").parquet(f"{tmp_dir}/land/{name}")
    lands = {name: spark.read.parquet(f"{tmp_dir}/land/{name}") for name in raw}
    wh = FraudWarehouse(spark, f"{tmp_dir}/wh")
    wh.run(lands, 0)
    only_new = {name: df.filter("batch_id > 0") for name, df in lands.items()}
    plan = only_new["raw_trans"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    poisoned = {name: df.withColumn("meta_filename", F.when(F.col("batch_id") == 0, F.raise_error(F.lit("read again")))
                                    .otherwise(F.col("meta_filename"))) for name, df in lands.items()}
    wh = FraudWarehouse(spark, f"{tmp_dir}/wh")  # a fresh handle: offsets come from the tables
    wh.run(poisoned, 1)
    assert wh.merchants.offset() == wh.facts.offset() == wh.clients.offset() == 1
    wh.run(poisoned, 1)  # nothing left to do
    assert {r.trans_num for r in wh.facts.read().collect()} >= {"t0", "t42"}


def test_matching_rows_of_a_table(spark, tmp_dir):
    t = KeyedTable(spark, f"{tmp_dir}/m", ["k"])
    t.merge(spark.createDataFrame([("a", 1, "x"), ("b", 2, "y"), ("c", 3, "x")], "k string, v int, g string"), batch_id=0)
    t.merge(spark.createDataFrame([("a", 9, "x")], "k string, v int, g string"), batch_id=4)
    got = t.read_matching(spark.createDataFrame([("x",)], "g string"))
    assert sorted((r.k, r.v) for r in got.collect()) == [("a", 9), ("c", 3)]
    assert t.offset() == 4
    assert [r.k for r in t.changes_after(0).collect()] == ["a"] and t.changes_after(4).count() == 0
    assert t.changes_after(-1).count() == 3
    t.compact()
    assert t.changes_after(0).count() == 3  # past the compaction: the whole table


def test_land_batches(spark, tmp_dir):
    raw = {"x": spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 5),)], "meta_load_ts timestamp_ntz")}
    out = land_batches(spark, raw, f"{tmp_dir}/lb", lambda _n: (F.dayofmonth("meta_load_ts") > 3).cast("int"))
    assert sorted(r.batch_id for r in out["x"].collect()) == [0, 1]


def test_a_refresh_parses_the_new_rows_once_and_meets_held_versions_once(spark, tmp_dir, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame
    raw, seen, subtracted = landing(spark), spark.sparkContext.accumulator(0), []

    def count(name):
        seen.add(1)
        return name

    counted = F.udf(count, "string").asNondeterministic()
    raw["raw_trans"] = raw["raw_trans"].coalesce(1).withColumn("meta_filename", counted("meta_filename"))
    plain = DataFrame.subtract
    monkeypatch.setattr(DataFrame, "subtract", lambda a, b: subtracted.append(a.columns) or plain(a, b))
    fact = FraudFact(spark, f"{tmp_dir}/fact")
    for n in range(3):
        before = seen.value
        fact.refresh(raw, n)
        assert seen.value - before == 45  # all rows of the landing, as the filter follows the count
    assert all("card_num" not in cols for cols in subtracted)
