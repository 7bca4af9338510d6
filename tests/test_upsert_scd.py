"""Keyed upsert (H1, H2), SCD (H4-H7) and enrichment (J1-J3) on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from riverbed.operators import enrich
from riverbed.operators.dedupe import latest_by_load, latest_per_key
from riverbed.operators.scd import (next_in_key, scd1_delta, scd1_full, scd2_dim_delta, scd2_from_history, scd_id,
                                    scd2_snapshot_delta)
from riverbed.operators.upsert import KeyedTable, after_mark, high_water_mark, merge_frames
from riverbed.sources.csv import file_inventory

D = dt.datetime
TGT = "k string, v string, f string, stamp timestamp_ntz"
SRC = "k string, v string, f string"
TRACKED = ["v", "f"]


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


def test_changed_only_upsert_cases(spark):
    tgt = spark.createDataFrame([("a", "1", "f1", D(2024, 1, 1)), ("b", None, "f1", D(2024, 1, 1)),
                                 ("c", "3", "f1", D(2024, 1, 1)), ("d", "4", "f1", D(2024, 1, 1))], TGT)
    src = spark.createDataFrame([("a", "1", "f1"),      # unchanged: stamp kept
                                 ("b", "2", "f1"),      # NULL -> value: update
                                 ("c", "3", "f2"),      # only file name differs: update
                                 ("e", "5", "f2")], SRC)  # new: insert
    out = merge_frames(tgt, src, ["k"], tracked=TRACKED, stamp=("stamp", D(2024, 1, 2)))
    assert rows(out) == [("a", "1", "f1", D(2024, 1, 1)), ("b", "2", "f1", D(2024, 1, 2)),
                         ("c", "3", "f2", D(2024, 1, 2)), ("d", "4", "f1", D(2024, 1, 1)),
                         ("e", "5", "f2", D(2024, 1, 2))]
    again = merge_frames(out, src, ["k"], tracked=TRACKED, stamp=("stamp", D(2024, 1, 3)))
    assert rows(again) == rows(out)  # idempotent: a replayed batch changes nothing


def test_always_update_and_null_keys(spark):
    tgt = spark.createDataFrame([("a", "1", "f1", D(2024, 1, 1)), (None, "x", "f1", D(2024, 1, 1))], TGT)
    src = spark.createDataFrame([("a", "1", "f1"), (None, "y", "f2")], SRC)
    out = merge_frames(tgt, src, ["k"], stamp=("stamp", D(2024, 1, 2)))
    assert dict((f.name, f.dataType.simpleString()) for f in out.schema.fields)["stamp"] == "timestamp_ntz"
    got = rows(out, "k", "v", "stamp")
    # matched rows always take the source (H2); NULL keys never match
    assert ("a", "1", D(2024, 1, 2)) in got
    assert sum(1 for r in got if r[0] is None) == 2


def test_keyed_table_replay(spark, tmp_dir):
    t = KeyedTable(spark, tmp_dir, ["k"], tracked=TRACKED)
    b0 = spark.createDataFrame([(f"k{i}", str(i), "f0") for i in range(50)], SRC)
    assert t.merge(b0, stamp=("stamp", D(2024, 1, 1)), batch_id=0)
    first = rows(t.read())
    b1 = spark.createDataFrame([("k1", "changed", "f1"), ("k2", "2", "f0"), ("new", "n", "f1")], SRC)
    assert t.merge(b1, stamp=("stamp", D(2024, 1, 2)), batch_id=1)
    assert not t.merge(b1, stamp=("stamp", D(2024, 1, 3)), batch_id=1)  # replay
    out = {r.k: r for r in t.read().collect()}
    assert len(out) == 51
    assert out["k1"].v == "changed" and out["k1"].stamp == D(2024, 1, 2)
    assert out["k2"].stamp == D(2024, 1, 1)  # unchanged row keeps its stamp
    assert out["new"].stamp == D(2024, 1, 2)
    # a fresh handle reads the same committed state from the folders
    again = KeyedTable(spark, tmp_dir, ["k"], tracked=TRACKED)
    assert rows(again.read()) == rows(t.read())
    assert again.applied_batches() == {0, 1}
    assert len(first) == 50
    # compacting changes no row, and an unchanged redelivery after it keeps the stamp
    again.compact()
    assert rows(again.read()) == rows(t.read())
    assert again.merge(b1, stamp=("stamp", D(2024, 1, 9)), batch_id=2)
    assert rows(again.read()) == rows(t.read())
    assert rows(KeyedTable(spark, tmp_dir, ["k"], tracked=TRACKED).read()) == rows(t.read())


def test_tracked_table_equals_merge_frames(spark, tmp_dir):
    import random
    rnd = random.Random(3)
    t, want = KeyedTable(spark, tmp_dir, ["k"], tracked=TRACKED), None
    for b in range(5):
        src = spark.createDataFrame([(f"k{i}", rnd.choice(["1", "2", None]), f"f{rnd.randrange(2)}")
                                     for i in rnd.sample(range(12), 8)], SRC)
        stamp = ("stamp", D(2024, 1, 1 + b))
        t.merge(src, stamp=stamp, batch_id=b)
        want = merge_frames(want, src, ["k"], tracked=TRACKED, stamp=stamp)
        if b == 2:
            t.compact()
        assert rows(t.read()) == rows(want)


def test_a_batch_writes_its_own_rows_only(spark, tmp_dir):
    t = KeyedTable(spark, tmp_dir, ["k"])
    make = lambda n: spark.range(n).select("id", F.uuid().alias("v")).withColumnRenamed("id", "k")
    t.merge(make(100_000), batch_id=0)
    t.merge(make(100), batch_id=1)
    t.merge(make(100), batch_id=2)
    size = dict(rows(file_inventory(spark, f"{tmp_dir}/data", "*.parquet")
                     .groupBy(F.regexp_extract("name", "_batch=([0-9]+)", 1).alias("b")).agg(F.sum("size"))))
    assert size["1"] < size["0"] / 50 and size["2"] < 1.5 * size["1"]
    assert t.read().count() == 100_000


def test_source_with_duplicates_or_missing_columns(spark, tmp_dir):
    t = KeyedTable(spark, tmp_dir, ["k"])
    t.merge(spark.createDataFrame([("a", "1", "f"), ("b", "2", "f")], SRC), batch_id=0)
    twice = spark.createDataFrame([("a", "3", "f"), ("a", "4", "f")], SRC)
    with pytest.raises(ValueError, match="more than one"):
        t.merge(twice, batch_id=1, on_duplicates="error")
    assert t.applied_batches() == {0}
    t.merge(spark.createDataFrame([("a", "9"), ("c", "5")], "k string, v string"), batch_id=1)
    assert rows(t.read()) == [("a", "9", "f"), ("b", "2", "f"), ("c", "5", None)]


def test_an_unfinished_attempt_is_not_read(spark, tmp_dir):
    t = KeyedTable(spark, tmp_dir, ["k"])
    t.merge(spark.createDataFrame([("a", "1", "f")], SRC), batch_id=0)
    half = f"{tmp_dir}/data/_kind=delta/_seq=1/_batch=1/_nulls=quarantine"
    (spark.createDataFrame([("a", "half", "f")], SRC).write
     .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half))
    again = KeyedTable(spark, tmp_dir, ["k"])
    assert again.applied_batches() == {0} and rows(again.read(), "v") == [("1",)]
    assert again.merge(spark.createDataFrame([("a", "2", "f")], SRC), batch_id=1)
    assert rows(KeyedTable(spark, tmp_dir, ["k"]).read(), "v") == [("2",)]


def test_high_water_mark_modes(spark):
    df = spark.createDataFrame([(D(2024, 1, 1),), (D(2024, 1, 2),)], "ts timestamp_ntz")
    empty = df.filter(F.lit(False))
    assert high_water_mark(df, "ts") == D(2024, 1, 2)
    assert after_mark(df, "ts", D(2024, 1, 1)).count() == 1
    assert high_water_mark(empty, "ts") is None
    assert after_mark(df, "ts", None).count() == 2                     # safe mode
    assert after_mark(df, "ts", None, literal_mode=True).count() == 0  # Q3 literal


def test_dedupe_ties(spark):
    df = spark.createDataFrame([
        ("a", D(2024, 1, 1), 5, "f1.csv", "old"),
        ("a", D(2024, 1, 2), 1, "f2.csv", "later load"),
        ("b", D(2024, 1, 1), 1, "f1.csv", "low row"),
        ("b", D(2024, 1, 1), 2, "f1.csv", "high row"),
        ("c", D(2024, 1, 1), 3, "f1.csv", "file 1"),
        ("c", D(2024, 1, 1), 3, "f2.csv", "file 2")],
        "k string, meta_load_ts timestamp_ntz, meta_file_row_number bigint, meta_filename string, v string")
    got = dict(rows(latest_by_load(df, ["k"]), "k", "v"))
    assert got == {"a": "later load", "b": "high row", "c": "file 2"}


CLIENT = "card string, name string, load timestamp_ntz"


def history(spark):
    return spark.createDataFrame([("1", "a", D(2024, 1, 1)), ("1", "a", D(2024, 1, 3)),
                                  ("1", "b", D(2024, 1, 5)), ("2", "x", D(2024, 1, 2))], CLIENT)


def test_scd2_recompute_properties(spark):
    v = scd2_from_history(history(spark), "card", "load")
    got = rows(v, "card", "name", "valid_from", "valid_to", "is_current")
    assert got == [("1", "a", D(2024, 1, 1), D(2024, 1, 3), False),
                   ("1", "a", D(2024, 1, 3), D(2024, 1, 5), False),  # same attributes, new version
                   ("1", "b", D(2024, 1, 5), None, True),
                   ("2", "x", D(2024, 1, 2), None, True)]


def test_snapshot_replay_equals_recompute(spark):
    h = history(spark)
    expect = rows(scd2_from_history(h, "card", "load"), "card", "valid_from", "valid_to")
    at_once = scd2_snapshot_delta(None, h, "card", "load")
    assert rows(at_once, "card", "dbt_valid_from", "dbt_valid_to") == expect
    snap = None
    for cut in (D(2024, 1, 2), D(2024, 1, 4), D(2024, 1, 9)):
        delta = scd2_snapshot_delta(snap, h.filter(F.col("load") < cut), "card", "load")
        snap = merge_frames(snap, delta, ["dbt_scd_id"]) if snap is not None else delta
        snap = spark.createDataFrame(snap.collect(), snap.schema)  # cut lineage
    assert rows(snap, "card", "dbt_valid_from", "dbt_valid_to") == expect
    # equal or older rows are ignored
    again = scd2_snapshot_delta(snap, h, "card", "load")
    assert again.count() == 0


def test_dim_delta_q1(spark):
    snap = scd2_snapshot_delta(None, history(spark), "card", "load")
    mark = D(2024, 1, 4)
    fixed = scd2_dim_delta(snap, mark)
    strict = scd2_dim_delta(snap, mark, strict_reference=True)
    # the version closed at 01-05 is re-read only with the fix
    assert fixed.count() == strict.count() + 1


def test_scd1_full_equals_incremental(spark):
    df = spark.createDataFrame([("m", 1, D(2024, 1, 1)), ("m", 2, D(2024, 1, 2)), ("n", 3, D(2024, 1, 1))],
                               "k string, v int, ts timestamp_ntz")
    order = ["ts desc"]
    full = scd1_full(df, ["k"], order)
    first = scd1_full(df.filter(F.col("ts") < D(2024, 1, 2)), ["k"], order)
    delta = scd1_delta(df, first, ["k"], order, "ts")
    assert rows(merge_frames(first, delta, ["k"])) == rows(full)
    assert rows(latest_per_key(df, ["k"], order)) == rows(full)


def test_as_of_join_cases(spark):
    versions = scd2_from_history(history(spark), "card", "load").select(
        "card", "name", "valid_from", "valid_to")
    facts = spark.createDataFrame([
        ("t1", "1", D(2023, 12, 31)),  # before the first load: no client
        ("t2", "1", D(2024, 1, 3)),    # exactly on a boundary: the new version
        ("t3", "1", D(2024, 2, 1)),    # after the last load: open version
        ("t4", "9", D(2024, 1, 3)),    # unknown card
        ("t5", "1", None)], "t string, card string, ts timestamp_ntz")
    j = enrich.join_as_of(facts, versions, "card", "ts", prefix="_c_")
    got = {r.t: (r._c_name, r._c_valid_from) for r in j.collect()}
    assert j.count() == facts.count()
    assert got["t1"] == (None, None) and got["t4"] == (None, None) and got["t5"] == (None, None)
    assert got["t2"] == ("a", D(2024, 1, 3))
    assert got["t3"] == ("b", D(2024, 1, 5))
    sweep = enrich.join_as_of_sweep(facts, versions, "card", "ts", ["name", "valid_from"], prefix="_c_")
    assert rows(sweep, "t", "_c_name", "_c_valid_from") == rows(j, "t", "_c_name", "_c_valid_from")
    fan = enrich.join_all_versions(facts, versions, "card", prefix="_c_")
    assert fan.count() == 4 * 3 + 1  # four card-1 facts x three versions, + the unknown card


def test_bucketed_lead_equals_plain_window(spark):
    from riverbed.functions.parse import floor_ntz
    from riverbed.operators.scd import next_in_key
    # one hot key over many days plus a few small keys
    data = [("hot", D(2024, 1, 1) + dt.timedelta(hours=7 * i)) for i in range(300)]
    data += [(f"k{j}", D(2024, 1, 1) + dt.timedelta(days=3 * i)) for j in range(5) for i in range(4)]
    df = spark.createDataFrame(data, "k string, ts timestamp_ntz")
    plain = next_in_key(df, "k", "ts", "nxt")
    bucketed = next_in_key(df, "k", "ts", "nxt", bucket=floor_ntz(F.col("ts"), "day"))
    assert rows(plain) == rows(bucketed)
    assert bucketed.filter(F.col("nxt").isNull()).count() == 6


def test_create_if_missing_then_overwrite(spark, tmp_dir):
    t = KeyedTable(spark, tmp_dir, ["k"])
    schema = spark.createDataFrame([], SRC).schema
    assert t.create_if_missing(schema)
    assert not t.create_if_missing(schema)
    assert t.read().count() == 0
    t.overwrite(spark.createDataFrame([("a", "1", "f")], SRC))
    t.overwrite(spark.createDataFrame([("b", "2", "f")], SRC))
    assert rows(t.read(), "k") == [("b",)]  # a full rebuild drops the rows before it


def test_mark_is_kept_and_read_back(spark, tmp_dir):
    t = KeyedTable(spark, tmp_dir, ["k"], mark_col="ts")
    mk = lambda n, day: spark.createDataFrame(
        [(f"k{i}", str(i), D(2024, 1, day)) for i in range(n)], "k string, v string, ts timestamp_ntz")
    t.merge(mk(40, 1), batch_id=0)
    t.merge(mk(10, 3), batch_id=1)
    assert t.mark() == D(2024, 1, 3)
    assert high_water_mark(t.read(), "ts") == t.mark()
    again = KeyedTable(spark, tmp_dir, ["k"], mark_col="ts")
    assert again.mark() == D(2024, 1, 3)
    again.compact()
    again.merge(mk(1, 2), batch_id=2)
    assert again.mark() == KeyedTable(spark, tmp_dir, ["k"], mark_col="ts").mark() == D(2024, 1, 3)


def test_compaction_between_batches_changes_nothing(spark, tmp_dir):
    t = KeyedTable(spark, tmp_dir, ["k"], mark_col="ts")
    for b in range(7):
        batch = spark.createDataFrame([(f"k{b % 3}", str(b), D(2024, 1, 1 + b))],
                                      "k string, v string, ts timestamp_ntz")
        assert t.merge(batch, batch_id=b)
        if b % 3 == 2:
            t.compact()
    fresh = KeyedTable(spark, tmp_dir, ["k"], mark_col="ts")
    assert rows(fresh.read()) == rows(t.read())
    assert {r.k: r.v for r in fresh.read().collect()} == {"k0": "6", "k1": "4", "k2": "5"}
    assert fresh.mark() == D(2024, 1, 7)
    assert fresh.applied_batches() == set(range(7))
    assert not fresh.merge(spark.createDataFrame([("k0", "x", D(2024, 2, 1))],
                                                 "k string, v string, ts timestamp_ntz"), batch_id=2)


def test_null_keys_are_quarantined_by_default(spark, tmp_dir):
    t = KeyedTable(spark, tmp_dir, ["k"])
    batch = spark.createDataFrame([("a", "1", "f"), (None, "2", "f")], SRC)
    t.merge(batch, batch_id=0)
    t.merge(batch, batch_id=1)
    assert rows(t.read(), "k") == [("a",)]
    q = t.quarantined()
    assert q.count() == 2 and q.filter("k IS NULL").count() == 2
    dup = spark.createDataFrame([(None, "3", "f"), (None, "4", "f"), ("a", "5", "f")], SRC)
    t.merge(dup, batch_id=2, order=["v desc"])
    assert t.quarantined().count() == 4  # no NULL row collapsed
    raw = KeyedTable(spark, tmp_dir + "-insert", ["k"])
    raw.merge(batch, batch_id=0, null_keys="insert")
    raw.merge(batch, batch_id=1, null_keys="insert")
    assert raw.read().filter("k IS NULL").count() == 2  # the reference's behaviour


def test_empty_batch_is_committed(spark, tmp_dir):
    t = KeyedTable(spark, tmp_dir, ["k"], mark_col="ts")
    base = spark.createDataFrame([("a", "1", D(2024, 1, 1))], "k string, v string, ts timestamp_ntz")
    t.merge(base, batch_id=0)
    assert t.merge(base.filter(F.lit(False)), batch_id=1)
    assert rows(t.read(), "k", "v") == [("a", "1")]
    assert 1 in t.applied_batches() and t.mark() == D(2024, 1, 1)


def test_bucketed_sweep_equals_interval_join_on_a_hot_key(spark):
    import random
    rnd = random.Random(7)
    hist = [("hot", f"n{i}", D(2024, 1, 1) + dt.timedelta(hours=5 * i)) for i in range(120)]
    hist += [(f"c{j}", f"m{j}", D(2024, 1, 3 + j)) for j in range(4)]
    versions = scd2_from_history(spark.createDataFrame(hist, CLIENT), "card", "load").select(
        "card", "name", "valid_from", "valid_to")
    facts = [(f"t{i}", "hot", D(2023, 12, 31) + dt.timedelta(minutes=rnd.randrange(0, 60 * 24 * 30)))
             for i in range(400)]
    facts += [(f"u{i}", f"c{i % 5}", D(2024, 1, 1) + dt.timedelta(days=i % 9)) for i in range(20)]
    facts += [("edge", "hot", D(2024, 1, 1, 5)), ("null", "hot", None)]
    fdf = spark.createDataFrame(facts, "t string, card string, ts timestamp_ntz")
    expect = rows(enrich.join_as_of(fdf, versions, "card", "ts", prefix="_c_"), "t", "_c_name")
    for unit in (None, "day"):
        got = enrich.join_as_of_sweep(fdf, versions, "card", "ts", ["name"], prefix="_c_", bucket_unit=unit)
        assert rows(got, "t", "_c_name") == expect


def test_changes_since_reads_only_later_batches(spark, tmp_dir):
    t = KeyedTable(spark, tmp_dir, ["k"])
    t.merge(spark.createDataFrame([(f"k{i}", "1", "f") for i in range(40)], SRC), batch_id=0)
    v0 = t.version()
    assert t.changes_since(v0).count() == 0 and t.changes_since(None).count() == 40
    t.merge(spark.createDataFrame([("k1", "2", "f")], SRC), batch_id=1)
    assert rows(t.changes_since(v0)) == [("k1", "2", "f")]
    assert all("_batch=1" in f for f in t.changes_since(v0).inputFiles())
    t.compact()
    assert t.changes_since(v0).count() == 40  # a newer base: everything


def test_int_keys_into_a_bigint_table_lose_nothing(spark, tmp_dir):
    t = KeyedTable(spark, tmp_dir, ["k"])
    t.merge(spark.range(200).select(F.col("id").alias("k"), F.lit("a").alias("v")), batch_id=0)
    t.merge(spark.createDataFrame([(0, "b"), (500, "c")], "k int, v string"), batch_id=1)
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 201 and got[0] == "b" and got[500] == "c" and got[199] == "a"


def test_late_batch_is_applied(spark, tmp_dir):
    t = KeyedTable(spark, tmp_dir, ["k"])
    for b in (0, 2, 4, 6):
        t.merge(spark.createDataFrame([(f"k{b}", "x")], "k string, v string"), batch_id=b)
    t.compact()
    again = KeyedTable(spark, tmp_dir, ["k"])
    assert again.applied_batches() == {0, 2, 4, 6}
    assert again.merge(spark.createDataFrame([("k3", "x")], "k string, v string"), batch_id=3)
    assert {r.k for r in again.read().collect()} == {"k0", "k2", "k3", "k4", "k6"}
    assert not again.merge(spark.createDataFrame([("k2", "y")], "k string, v string"), batch_id=2)


def test_null_keys_chain_in_both_forms_of_lead(spark):
    from riverbed.functions.parse import floor_ntz
    rows_in = [(None, D(2024, 1, d)) for d in (1, 2, 5)] + [("a", D(2024, 1, 1)), ("a", D(2024, 1, 3))]
    df = spark.createDataFrame(rows_in, "card string, ts timestamp_ntz")
    plain = next_in_key(df, "card", "ts", "nxt")
    bucketed = next_in_key(df, "card", "ts", "nxt", floor_ntz(F.col("ts"), "day"))
    assert sorted(map(str, plain.collect())) == sorted(map(str, bucketed.collect()))


def test_sweep_gives_null_keys_no_version(spark):
    from riverbed.operators.enrich import join_as_of_sweep
    fact = spark.createDataFrame([(None, D(2024, 1, 5)), ("a", D(2024, 1, 5))], "card string, ts timestamp_ntz")
    ver = spark.createDataFrame([(None, "x", D(2024, 1, 1)), ("a", "y", D(2024, 1, 1))],
                                "card string, name string, valid_from timestamp_ntz")
    for unit in (None, "day"):
        got = {r.card: r._d_name for r in join_as_of_sweep(fact, ver, "card", "ts", ["name"], bucket_unit=unit).collect()}
        assert got == {None: None, "a": "y"}


def test_incremental_keeps_null_keys_and_late_merchants(spark, tmp_dir):
    from riverbed.operators.dedupe import latest_keep_null_keys
    df = spark.createDataFrame([(None, 1), (None, 1), ("a", 1), ("a", 2)], "k string, o int")
    assert latest_keep_null_keys(df, ["k"], ["o desc"]).count() == 3
    t = KeyedTable(spark, tmp_dir, ["k"])
    t.merge(latest_keep_null_keys(df, ["k"], ["o desc"]), batch_id=0)
    assert t.quarantined().count() == 2 and t.read().count() == 1


# -- nothing is lost to attempts that died, repeated keys or clashing ids ------------
def test_a_failed_build_leaves_the_schema_alone(spark, tmp_dir):
    """A full build with other columns dies half way: the next merge commits at
    the same sequence number, and no handle reads the dead attempt's columns."""
    t = KeyedTable(spark, f"{tmp_dir}/dead", ["k"])
    t.merge(spark.createDataFrame([("a", "1"), ("b", "2")], "k string, v string"), batch_id=0)
    broken = spark.createDataFrame([("a", 1)], "k string, w int").withColumn("w", F.raise_error(F.lit("lost")).cast("int"))
    with pytest.raises(Exception, match="lost"):
        t.overwrite(broken, on_duplicates="unique")
    assert t.schema().names == ["k", "v"]
    t.merge(spark.createDataFrame([("c", "3")], "k string, v string"), batch_id=1)
    for handle in (t, KeyedTable(spark, f"{tmp_dir}/dead", ["k"])):
        assert {tuple(r) for r in handle.read().collect()} == {("a", "1"), ("b", "2"), ("c", "3")}
    t.overwrite(spark.createDataFrame([("z", 9)], "k string, w int"))
    assert [tuple(r) for r in t.read().collect()] == [("z", 9)] and t.schema().names == ["k", "w"]


def test_repeated_keys_are_refused_whatever_the_number_of_batches(spark, tmp_dir):
    twice = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    for batches in (0, 1):
        t = KeyedTable(spark, f"{tmp_dir}/twice{batches}", ["k"])
        if batches:
            t.merge(spark.createDataFrame([(3, "x")], "k int, v string"), batch_id=0)
        with pytest.raises(ValueError, match="more than one row"):
            t.merge(twice, batch_id=1)
        with pytest.raises(ValueError, match="more than one row"):
            t.overwrite(twice)
        t.merge(twice, batch_id=1, order=["v desc"])
        t.merge(spark.createDataFrame([(4, "y")], "k int, v string"), batch_id=2)
        assert {(r.k, r.v) for r in t.read().collect()} >= {(1, "b"), (2, "c"), (4, "y")}


def test_version_ids_of_null_and_empty_keys_differ(spark, tmp_dir):
    rows = [(None, D(2024, 1, 1)), ("", D(2024, 1, 1)), ("null", D(2024, 1, 1)), ("1:a", D(2024, 1, 1)),
            ("a|", D(2024, 1, 1)), ("a", None), ("", None), (None, None)]
    df = spark.createDataFrame(rows, "card string, t timestamp_ntz")
    ids = df.withColumn("id", scd_id("card", "t"))
    assert ids.select("id").distinct().count() == len(rows)
    source = spark.createDataFrame([(None, "n", D(2024, 1, 1)), ("", "e", D(2024, 1, 1))],
                                   "card string, v string, t timestamp_ntz")
    t = KeyedTable(spark, f"{tmp_dir}/ids", ["dbt_scd_id"])
    t.merge(scd2_snapshot_delta(None, source, "card", "t"), batch_id=0)
    later = spark.createDataFrame([("", "e2", D(2024, 1, 2))], "card string, v string, t timestamp_ntz")
    t.merge(scd2_snapshot_delta(t.read(), later, "card", "t"), batch_id=1)
    assert {(r.card, r.v, r.dbt_valid_to) for r in t.read().collect()} == {
        (None, "n", None), ("", "e", D(2024, 1, 2)), ("", "e2", None)}


@pytest.mark.parametrize("limit,most", [(3, 100), (3, 1), (1000, 100)])
def test_routed_as_of_join(spark, limit, most):
    """Keys of many versions are swept, the others joined; with too many of
    them all is swept. The equi join never sees a key above the limit."""
    cards = {"hot": 60, "warm": 4, "cold": 2, "one": 1, None: 5}
    versions = [(c, f"{c}{i}", D(2024, 1, 1) + dt.timedelta(hours=7 * i)) for c, n in cards.items() for i in range(n)]
    v = scd2_from_history(spark.createDataFrame(versions, "card string, name string, t timestamp_ntz")
                          .withColumn("valid_from", F.col("t")), "card", "valid_from")
    facts = [(i, c, D(2023, 12, 31) + dt.timedelta(hours=5 * (i % 100))) for c in [*cards, "none"] for i in range(100)]
    facts += [(1000, "hot", None), (1001, None, None)]
    f = spark.createDataFrame(facts, "n int, card string, ts timestamp_ntz")
    want = enrich.join_as_of(f, v, "card", "ts", prefix="_c_").select("n", "card", "ts", "_c_name")
    seen = []
    plain = enrich.join_as_of

    def spy(fact, versions, *a, **k):
        seen.append(versions.groupBy("card").count().agg(F.max("count")).first()[0] or 0)
        return plain(fact, versions, *a, **k)

    enrich.join_as_of = spy
    try:
        got = enrich.join_as_of_routed(f, v, "card", "ts", ["name"], prefix="_c_", max_versions=limit, max_hot=most)
        assert rows(got, "n", "card", "ts", "_c_name") == rows(want, "n", "card", "ts", "_c_name")
    finally:
        enrich.join_as_of = plain
    assert seen == ([5] if limit == 3 and most == 100 else [] if most == 1 else [60])  # 5: the NULL key, never matched
    hot = {r.card for r in enrich.hot_keys(v, "card", limit).collect()}
    assert hot == ({"hot", "warm"} if limit == 3 else set())


@pytest.mark.parametrize("tracked", [None, ["v"]])
def test_merges_compact_by_themselves(spark, tmp_dir, tracked):
    make = lambda limit: KeyedTable(spark, f"{tmp_dir}/c{limit}", ["k"], tracked=tracked, compact_after=limit)
    tables = {n: make(n) for n in (3, None)}
    for b in range(8):
        rows_ = [(f"k{b % 3}", str(b // 4)), (f"n{b}", "x"), (None, str(b))]
        for t in tables.values():
            t.merge(spark.createDataFrame(rows_, "k string, v string"), stamp=("s", D(2024, 1, 1 + b)), batch_id=b)
            assert t.compact_after is None or len(t._live()) <= t.compact_after
    got = [sorted(map(str, t.read().collect())) for t in (tables[3], tables[None], make(3))]
    assert got[0] == got[1] == got[2]
    assert tables[3].quarantined().count() == tables[None].quarantined().count() == 8
    assert make(3).offset() == 7 and not make(3).merge(spark.createDataFrame([("k0", "9")], "k string, v string"),
                                                        stamp=("s", D(2025, 1, 1)), batch_id=2)


def test_a_read_shuffles_the_batches_not_the_base(spark, tmp_dir):
    t = KeyedTable(spark, f"{tmp_dir}/based", ["k", "j"])
    make = lambda lo, hi, v: spark.range(lo, hi).select(
        F.col("id").alias("k"), (F.col("id") % 3).alias("j"), F.lit(v).alias("v"))
    t.merge(make(0, 3000, "a"), batch_id=0)
    t.compact()
    t.merge(make(2990, 3010, "b"), batch_id=1)
    t.merge(make(3005, 3020, "c"), batch_id=2)
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 3020 and [got[k] for k in (0, 2989, 2990, 3004, 3005, 3019)] == ["a", "a", "b", "b", "c", "c"]
    plan = t.read()._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan
    executed = t.read()._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 2  # both of the batches: their rows and their keys
