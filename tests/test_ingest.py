"""CSV source (A1-A5, A13) and streaming ingest."""

import datetime as dt
import os

from pyspark.sql import functions as F

import random

import pytest

from riverbed.operators.upsert import KeyedTable
from riverbed.plans.pipeline import stream_runs, utc_now
from riverbed.session import glob_paths
from riverbed.sources.csv import CsvFormat, file_inventory, quote_state, read_landing, read_numbered
from riverbed.streaming.ingest import FileIngest, LandingFeed

POS3 = {"a": 1, "b": 2, "c": 3}


def local_path(path):
    return path[path.index("/"):].replace("///", "/") if path.startswith("file:") else path


def write(path, name, data: bytes):
    p = local_path(path)
    os.makedirs(p, exist_ok=True)
    with open(os.path.join(p, name), "wb") as fh:
        fh.write(data)


def test_csv_dialect_edge_cases(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    write(src, "a.csv", b'h1,h2,h3\n1," sp ","a ""q"" b"\n2, x ,NULL\n3,null,""\n'
                        b'4,"multi\nline",z\n5,6\n7,8,9,10\n')
    write(src, "b.csv", b'h1,h2,h3\n8,\xff\xfebad,y\n')
    write(src, "c.csv", b"h1,h2,h3\n")
    landed = read_landing(spark, src, 3, POS3, dt.datetime(2024, 1, 1))
    got = {(r.a, r.meta_file_row_number): (r.b, r.c) for r in landed.collect()}
    assert got[("1", 1)] == (" sp ", 'a "q" b')   # quoted spaces kept, doubled quote
    assert got[("2", 2)] == ("x", None)             # unquoted spaces trimmed, NULL token
    assert got[("3", 3)] == (None, None)            # null token, empty quoted
    assert got[("4", 4)] == ("multi\nline", "z")    # quoted newline: one record
    assert got[("5", 5)] == ("6", None)             # too few fields: NULL padded
    assert got[("7", 6)] == ("8", "9")              # too many: truncated
    assert got[("8", 1)][0].startswith("�")     # bad UTF-8 replaced
    assert len(got) == 7                            # the header-only file adds no row
    text = read_numbered(spark, src, 3)
    assert text.filter(F.col("_corrupt_record").isNotNull()).count() == 2  # both flagged
    inv = file_inventory(spark, src)
    assert inv.count() == 3


def test_row_numbers_exact_across_splits(spark, tmp_dir):
    src = f"{tmp_dir}/rows"
    for f in range(3):
        write(src, f"f{f}.csv", ("h\n" + "".join(f"{f}-{i}\n" for i in range(1, 2001))).encode())
    fmt = CsvFormat(multiline=False, extra={"maxPartitionBytes": "4096"})
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        landed = read_landing(spark, src, 1, {"v": 1}, dt.datetime(2024, 1, 1), fmt)
        bad = landed.filter(F.split("v", "-")[1].cast("bigint") != F.col("meta_file_row_number"))
        assert landed.count() == 6000
        assert bad.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_stream_ingest_new_files_only_and_ledger(spark, tmp_dir):
    src, tgt = f"{tmp_dir}/in", f"{tmp_dir}/pipe"
    stamps = iter([dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3)])
    pipe = FileIngest(spark, src, tgt, n_fields=3, positions=POS3, pipe_name="P", table_name="T",
                      clock=lambda _b: next(stamps))
    write(src, "a.csv", b"h1,h2,h3\nk1,1,x\nk2,2,y\n")
    pipe.run_available_now()
    write(src, "e.csv", b"h1,h2,h3\n")  # header only: no row, still ledgered
    write(src, "b.csv", b"h1,h2,h3\nk1,9,z\nbad\n")
    os.utime(local_path(f"{src}/e.csv"), (1, 1))  # older than b.csv for sure
    pipe.run_available_now()
    pipe.run_available_now()  # nothing new: no batch written
    feed = LandingFeed(spark, pipe.landing_path)
    assert feed.committed_batches() == [0, 1]
    assert feed.batch(1).count() == 2
    ledger = {r.file_name.rsplit("/", 1)[1]: r for r in pipe.ledger().collect()}
    assert ledger["a.csv"].row_count == 2 and ledger["a.csv"].status == "LOADED"
    assert ledger["b.csv"].error_count == 1 and ledger["b.csv"].status == "PARTIALLY_LOADED"
    assert ledger["e.csv"].row_count == 0 and ledger["e.csv"].status == "LOADED"
    assert len(ledger) == 3
    # consumer: offset kept in the target, replay is a no-op
    table = KeyedTable(spark, f"{tmp_dir}/conformed", ["a"])
    for b in feed.pending(table.applied_batches()):
        table.merge(feed.batch(b).select("a", "b", "meta_load_ts"), batch_id=b,
                    order=["meta_load_ts desc"])
    assert feed.pending(table.applied_batches()) == []
    assert {r.a: r.b for r in table.read().collect()} == {"k1": "9", "k2": "2", "bad": None}


def quoted_text(seed, rows, ends="\n"):
    rnd = random.Random(seed)
    cells = ["x", " pad ", '"q"', '"a ""b"" c"', '"two\nlines"', '"\n\n"', '"x, y"', '""', "", '5" pipe', 'é"x"',
             '"open"tail', '"end\n"', '"line\n""deep""\nend"', "NULL"]
    out = ["h1,h2,h3"]
    for i in range(rows):
        out.append(",".join([str(i), rnd.choice(cells), rnd.choice(cells)]))
        if rnd.random() < .1:
            out.append(rnd.choice(["", "   "]))
    return (ends.join(x.replace("\n", ends) for x in out) + rnd.choice(["", ends])).encode()


@pytest.mark.parametrize("ends", ["\n", "\r\n"])
def test_quoted_files_in_splits_equal_the_multi_line_reader(spark, tmp_dir, ends):
    src = f"{tmp_dir}/quoted"
    write(src, "a b.csv", quoted_text(1, 400, ends))
    write(src, "c.csv", quoted_text(2, 3, ends))
    write(src, "d.csv", b"h1,h2,h3" + ends.encode())
    write(src, "e.csv", b"")
    whole = read_numbered(spark, src, 3, CsvFormat(splittable=False)).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    try:
        split = read_numbered(spark, src, 3)
        got = split.collect()
        tasks = spark.read.text(src).rdd.getNumPartitions()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    key = lambda r: (r.meta_filename, r.meta_file_row_number)
    assert tasks > 50 and len(got) == 403
    assert [tuple(r)[:3] + key(r) for r in sorted(got, key=key)] == [
        tuple(r)[:3] + key(r) for r in sorted(whole, key=key)]
    assert [r._corrupt_record is None for r in sorted(got, key=key)] == [
        r._corrupt_record is None for r in sorted(whole, key=key)]


def test_quote_state():
    for line, before, after in (('a,b', 0, 0), ('a,"b', 0, 1), ('a,"b""', 0, 1), ('b",c', 1, 0), ('b""c', 1, 1),
                                ('5" pipe,x', 0, 0), ('5",x', 0, 0), ('5",x,"6', 0, 1), ('"a"b,"c', 0, 1),
                                (' "a', 0, 1), ('x","y', 1, 1), ('', 1, 1), ('"', 0, 1), ('"\r', 1, 0)):
        assert quote_state(line, bool(before), ",", '"', True) == bool(after), line


def test_late_and_old_files_land_exactly_once(spark, tmp_dir):
    src = f"{tmp_dir}/late"
    pipe = FileIngest(spark, src, f"{tmp_dir}/late_pipe", n_fields=3, positions=POS3, pipe_name="P", table_name="T",
                      clock=lambda b: dt.datetime(2024, 1, 1 + b))
    write(src, "new.csv", b"h1,h2,h3\nk1,1,x\n")
    assert pipe.run_available_now() == [0]
    write(src, "old.csv", b"h1,h2,h3\nk2,2,y\nk3,3,z\n")
    old = os.stat(local_path(f"{src}/new.csv")).st_mtime - 30 * 86400
    os.utime(local_path(f"{src}/old.csv"), (old, old))
    assert pipe.run_available_now() == [1]
    assert pipe.run_available_now() == []
    assert sorted(r.a for r in pipe.landing().collect()) == ["k1", "k2", "k3"]
    write(src, "new.csv", b"h1,h2,h3\nk1,1,x\nk9,9,x\n")  # replaced: another size
    assert pipe.run_available_now() == [2]
    assert [(r.file_name.rsplit("/", 1)[1], r.row_count) for r in pipe.ledger().orderBy("batch_id").collect()] == [
        ("new.csv", 1), ("old.csv", 2), ("new.csv", 2)]


def test_no_ledger_row_for_a_file_that_was_not_read(spark, tmp_dir):
    """A file that appears while a batch runs, with an older time, waits for
    the next run; an empty file as old as another is ledgered at once."""
    src = f"{tmp_dir}/race"

    def clock(b):
        if b == 0:
            write(src, "during.csv", b"h1,h2,h3\nk2,2,y\n")
            os.utime(local_path(f"{src}/during.csv"), (1, 1))
        return dt.datetime(2024, 1, 1 + b)

    pipe = FileIngest(spark, src, f"{tmp_dir}/race_pipe", n_fields=3, positions=POS3, pipe_name="P", table_name="T",
                      clock=clock, max_files_per_trigger=2)
    write(src, "a.csv", b"h1,h2,h3\nk1,1,x\n")
    write(src, "b.csv", b"h1,h2,h3\n")
    os.utime(local_path(f"{src}/b.csv"), (os.stat(local_path(f"{src}/a.csv")).st_mtime,) * 2)
    pipe.run_available_now()
    first = {r.file_name.rsplit("/", 1)[1]: r.row_count for r in pipe.ledger().collect()}
    assert first == {"a.csv": 1, "b.csv": 0}
    pipe.run_available_now()
    assert {r.file_name.rsplit("/", 1)[1]: r.row_count for r in pipe.ledger().collect()} == {
        "a.csv": 1, "b.csv": 0, "during.csv": 1}


def test_an_unfinished_batch_is_repeated_with_its_files_and_time(spark, tmp_dir, monkeypatch):
    src = f"{tmp_dir}/died"
    times = iter([dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)])
    make = lambda: FileIngest(spark, src, f"{tmp_dir}/died_pipe", n_fields=3, positions=POS3, pipe_name="P",
                              table_name="T", clock=lambda _b: next(times))
    write(src, "a.csv", b"h1,h2,h3\nk1,1,x\n")
    pipe = make()
    monkeypatch.setattr(pipe, "load", lambda _b: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        pipe.run_available_now()
    write(src, "b.csv", b"h1,h2,h3\nk2,2,y\n")
    assert make().run_available_now() == [0, 1]
    assert sorted((r.a, r.meta_load_ts.day) for r in make().landing().collect()) == [("k1", 1), ("k2", 2)]


def test_feed_as_a_stream_resumes_at_its_own_offset(spark, tmp_dir):
    src, tgt = f"{tmp_dir}/feed", f"{tmp_dir}/feed_pipe"
    pipe = FileIngest(spark, src, tgt, n_fields=3, positions=POS3, pipe_name="P", table_name="T",
                      clock=lambda b: dt.datetime(2024, 1, 1 + b), max_files_per_trigger=1)
    seen = []

    def apply(rows, batch_id, load_time):
        if batch_id == 2 and len(seen) == 2:
            seen.append("failed")
            raise RuntimeError("consumer died")
        seen.append((batch_id, load_time.day, sorted(r.a for r in rows.collect())))

    def broken(*_):
        raise RuntimeError("always")

    feed = LandingFeed(spark, pipe.landing_path)
    assert feed.consume(apply, f"{tmp_dir}/offset") is None  # nothing ledgered yet
    for i in range(2):
        write(src, f"{i}.csv", f"h1,h2,h3\nk{i},1,x\n".encode())
    pipe.run_available_now()
    before = utc_now()
    runs = stream_runs(feed.consume(apply, f"{tmp_dir}/offset"), "T", feed.rows_of_epoch)
    assert [(r.name, r.state, r.row_count) for r in runs] == [("T", "SUCCEEDED", 2)]  # both batches, a row each
    assert before - dt.timedelta(seconds=1) <= runs[0].start_time < runs[0].end_time <= utc_now()
    assert stream_runs(feed.consume(apply, f"{tmp_dir}/offset"), "T") == []
    assert seen == [(0, 1, ["k0"]), (1, 2, ["k1"])]
    write(src, "2.csv", b"h1,h2,h3\nk2,1,x\n")
    pipe.run_available_now()
    with pytest.raises(Exception, match="consumer died"):
        feed.consume(apply, f"{tmp_dir}/offset")
    query = feed.consume(broken, f"{tmp_dir}/offset2", every="1 second")
    with pytest.raises(Exception, match="always"):
        query.processAllAvailable()
    assert [r.state for r in stream_runs(query, "T")] == ["FAILED"]
    LandingFeed(spark, pipe.landing_path).consume(apply, f"{tmp_dir}/offset")
    assert seen[3:] == [(2, 3, ["k2"])]
    assert len(glob_paths(spark, f"{tgt}/ledger/batch_id=*")) == 3


def test_max_files_per_trigger_bounds_batches(spark, tmp_dir):
    src, tgt = f"{tmp_dir}/in2", f"{tmp_dir}/pipe2"
    for i in range(3):
        write(src, f"f{i}.csv", f"h1,h2,h3\nk{i},{i},x\n".encode())
    pipe = FileIngest(spark, src, tgt, n_fields=3, positions=POS3, pipe_name="P", table_name="T",
                      clock=lambda b: dt.datetime(2024, 1, 1 + b), max_files_per_trigger=1)
    pipe.run_available_now()
    feed = LandingFeed(spark, pipe.landing_path)
    assert feed.committed_batches() == [0, 1, 2]
    assert all(feed.batch(b).count() == 1 for b in range(3))


def test_scheduled_pipe_picks_up_new_files(spark, tmp_dir):
    src, tgt = f"{tmp_dir}/in3", f"{tmp_dir}/pipe3"
    write(src, "a.csv", b"h1,h2,h3\nk1,1,x\n")
    pipe = FileIngest(spark, src, tgt, n_fields=3, positions=POS3, pipe_name="P", table_name="T",
                      clock=lambda b: dt.datetime(2024, 1, 1 + b))
    q = pipe.start(every="1 second")
    try:
        q.processAllAvailable()
        write(src, "b.csv", b"h1,h2,h3\nk2,2,y\n")
        q.processAllAvailable()
    finally:
        q.stop()
    assert sorted(r.a for r in pipe.landing().collect()) == ["k1", "k2"]


def test_latency_does_not_depend_on_the_session_zone(spark, tmp_dir):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        write(f"{tmp_dir}/in", "a.csv", b"h1,h2,h3\nk1,1,x\n")
        pipe = FileIngest(spark, f"{tmp_dir}/in", f"{tmp_dir}/pipe", n_fields=3, positions=POS3,
                          pipe_name="P", table_name="T")
        pipe.run_available_now()
        r = pipe.ledger().first()
        assert 0 <= (r.last_load_time - r.pipe_received_time).total_seconds() < 600
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_small_files_are_listed_by_few_tasks_and_read_once(spark, tmp_dir):
    rows = spark.range(0, 1200, 1, 1).selectExpr("id div 10 AS f", "concat('r', id) AS value")
    (rows.repartition(4, "f").sortWithinPartitions("f", "value").withColumn("file", F.col("f")).drop("f")
     .write.partitionBy("file").text(tmp_dir))
    setting = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before = spark.conf.get(setting)
    spark.sparkContext.setJobGroup("listing-test", "listing-test")
    names = [r["name"] for r in file_inventory(spark, tmp_dir, "*.txt").collect()]
    numbered = read_numbered(spark, names, 1, CsvFormat(header=False), largest=100)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert spark.conf.get(setting) == before and len(names) == 120
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing-test")
              for s in tracker.getJobInfo(j).stageIds]
    assert max(s.numTasks for s in stages if s is not None) < 120
    assert numbered._jdf.queryExecution().optimizedPlan().toString().count("csv") == 1
    got = {(r.meta_filename.split("file=")[1].split("/")[0], r.meta_file_row_number): r.c1 for r in numbered.collect()}
    assert got == {(str(i // 10), i % 10 + 1): f"r{i}" for i in range(1200)}
