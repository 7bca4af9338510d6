"""Reference quirks Q2-Q9 and the incremental-vs-recompute properties."""

import datetime as dt

from pyspark.sql import functions as F

from riverbed.operators.dedupe import latest_by_load
from riverbed.operators.upsert import KeyedTable, after_mark
from riverbed.plans import fraud, incremental
from riverbed.sources import fixtures as fx

D = dt.datetime
SF = "/root/testdata/sf0.001"
RAW = ("trans_num_raw string, trans_date_raw string, card_num_raw string, amount_raw string, "
       "merchant_raw string, category_raw string, is_fraud_raw string, meta_filename string, "
       "meta_file_row_number bigint, meta_load_ts timestamp_ntz")


def test_q4_strict_mark_drops_rows_at_the_mark(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 2),), (D(2024, 1, 2),)], "ts timestamp_ntz")
    assert after_mark(df, "ts", D(2024, 1, 2)).count() == 0


def test_q5_duplicate_keys_in_a_merge_source(spark, tmp_dir):
    t = KeyedTable(spark, tmp_dir, ["k"])
    src = spark.createDataFrame([("a", 1, D(2024, 1, 1)), ("a", 2, D(2024, 1, 2))],
                                "k string, v int, meta_load_ts timestamp_ntz")
    t.merge(src, order=["meta_load_ts desc"], batch_id=0)
    assert [(r.k, r.v) for r in t.read().collect()] == [("a", 2)]


def test_q8_v1_parses_one_layout_and_keeps_the_row(spark):
    raw = spark.createDataFrame([("T1", "21-06-2020 12:14:25", "1", "1", "M", "c", "1", "f", 1, D(2024, 1, 1)),
                                 ("T2", "21-06-2020 12:14", "1", "1", "M", "c", "1", "f", 2, D(2024, 1, 1))], RAW)
    got = {r.trans_id: r.trans_ts for r in incremental.typed_landing(raw).collect()}
    assert got == {"T1": None, "T2": D(2020, 6, 21, 12, 14)}


def test_q9_lineage_dropped_in_v2_kept_in_v3(spark):
    models = fraud.v2_models(fx.raw_tables(spark, SF))
    assert "meta_filename" not in models["dt_transactions"].columns
    assert "meta_filename" in fraud.stg_transactions(fx.raw_trans(spark, SF)).columns


def test_quarantine_and_valid_split_the_input(spark):
    txn = fraud.stg_transactions(fx.raw_trans(spark, SF))
    assert fraud.valid(txn).count() + fraud.quarantine(txn).count() == txn.count()


def test_h9_with_complete_dimensions_equals_h8(spark):
    raw = fx.raw_tables(spark, SF)
    one_run = incremental.replay(spark, raw, "one-run", ["merchants", "snapshot", "clients", "facts"],
                                 cuts=(None,)).facts.read()
    txn = fraud.stg_transactions(raw["raw_trans"])
    full = fraud.enriched_fact(txn, fraud.merchants_latest(fraud.stg_merchants(raw["raw_merch"])),
                               fraud.clients_scd2(fraud.clients_deduped(fraud.stg_clients(raw["raw_clients"]))),
                               extra=("meta_filename", "meta_file_row_number"))
    # The fact table sets rows without a key aside.
    latest = latest_by_load(full.filter("trans_num IS NOT NULL"), ["trans_num"]).select(*fraud.FACT_COLS)
    assert one_run.count() == latest.count()
    assert one_run.exceptAll(latest).count() == 0


def test_h9_differs_from_h8_only_where_dimensions_arrived_late(spark):
    raw = fx.raw_tables(spark, SF)
    inc = incremental.replay(spark, raw, "three-runs", ["merchants", "snapshot", "clients", "facts"]).facts.read()
    txn = fraud.stg_transactions(raw["raw_trans"])
    full = fraud.enriched_fact(txn, fraud.merchants_latest(fraud.stg_merchants(raw["raw_merch"])),
                               fraud.clients_scd2(fraud.clients_deduped(fraud.stg_clients(raw["raw_clients"]))),
                               extra=("meta_filename", "meta_file_row_number"))
    # The fact table sets rows without a key aside.
    latest = latest_by_load(full.filter("trans_num IS NOT NULL"), ["trans_num"]).select(*fraud.FACT_COLS)
    diff = inc.alias("i").join(latest.alias("f"), "trans_num").filter(
        ~F.col("i.first_name").eqNullSafe(F.col("f.first_name")) |
        ~F.col("i.merchant_lat").eqNullSafe(F.col("f.merchant_lat")))
    # every differing fact was written in a run before the last cut, when a
    # later dimension row had not arrived yet
    last_cut = incremental.DEFAULT_CUTS[-2]
    assert diff.filter(F.col("i.meta_load_ts") >= F.lit(str(last_cut)).cast("timestamp_ntz")).count() == 0
