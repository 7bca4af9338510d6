"""Continuous file ingest.

``FileIngest`` is the pipe: it loads each file of one folder once. What was
loaded is the ledger's business alone: a file is known by its path and size, so
one that arrives late, or with an old modification time, is loaded like any
other, and one that was replaced by a file of another size is loaded again.

A run lists the folder once, takes the files that the ledger lacks (an
anti-join; the first run takes the backlog, A7) in batches of bounded size, and
for each batch writes in this order, each commit by Spark's ``_SUCCESS``:

1. ``plan/batch_id=N``: the batch's files and its load time;
2. ``landing/batch_id=N``: the rows with file name, 1-based row number and the
   load time (A4, A5), parsed or kept as text (A8 / A9);
3. ``ledger/batch_id=N``: one row per planned file (M1), with counts from the
   landed rows. A file without rows is one of the planned files too.

A batch that was planned but not ledgered when a run died is loaded first by
the next one: same files, same load time, over whatever it had written. Without
new files nothing is written (A11).

``LandingFeed`` is the append-only change feed (A10): the ledgered batches. As
a stream it reads new ledger rows, and the query's own checkpoint is the
consumer's offset; as a batch it compares the committed batches with those the
consumer's table has applied.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Mapping
from itertools import islice

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riverbed.functions.parse import ntz
from riverbed.session import escape_glob, glob_paths, path_exists
from riverbed.sources.csv import CORRUPT, CsvFormat, file_inventory, pick, read_numbered

LoadClock = Callable[[int], dt.datetime]
# Spark's file stream source forgets, and then ignores, files that are older
# than the newest one by this. The pipe's own notifier must never do so.
NEVER = "36500d"
# Files of a batch: what the driver holds are their names (a megabyte or two),
# and a backlog of many small files takes few batches.
MAX_FILES = 10_000


def utc_now(_batch_id: int) -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


PLAN = T.StructType([T.StructField("name", T.StringType()), T.StructField("meta_filename", T.StringType()),
                     T.StructField("file_size", T.LongType()),
                     T.StructField("pipe_received_time", T.TimestampNTZType()),
                     T.StructField("last_load_time", T.TimestampNTZType())])


class FileIngest:
    """One pipe: source folder -> landing table + load ledger."""

    def __init__(self, spark: SparkSession, source: str, target: str, *, n_fields: int,
                 positions: Mapping[str, int], pipe_name: str, table_name: str,
                 fmt: CsvFormat = CsvFormat(), typing: Callable[[DataFrame], DataFrame] | None = None,
                 clock: LoadClock = utc_now, max_files_per_trigger: int | None = MAX_FILES):
        """``max_files_per_trigger`` bounds a batch: a backlog is loaded in
        several, so no batch has to hold all of it (None: no bound). ``typing``
        keeps the lineage columns and ``meta_malformed``."""
        self.spark, self.source, self.target = spark, source, target.rstrip("/")
        self.n_fields, self.positions, self.fmt = n_fields, dict(positions), fmt
        self.pipe_name, self.table_name = pipe_name, table_name
        self.typing, self.clock = typing, clock
        self.max_files = max_files_per_trigger

    @property
    def landing_path(self) -> str:
        return f"{self.target}/landing"

    @property
    def ledger_path(self) -> str:
        return f"{self.target}/ledger"

    @property
    def checkpoint_path(self) -> str:
        return f"{self.target}/_checkpoint"

    def _batches(self, kind: str) -> set[int]:
        """Ids of the committed batches of a table (one listing of names)."""
        done = glob_paths(self.spark, f"{self.target}/{kind}/batch_id=*/_SUCCESS")
        return {int(p.split("/")[-2].split("=")[1]) for p in done}

    def pending(self) -> DataFrame:
        """Files whose path and size the ledger does not hold (name,
        meta_filename, file_size, pipe_received_time)."""
        listed = file_inventory(self.spark, self.source, glob=None).select(
            "name", "meta_filename", F.col("size").alias("file_size"), F.col("last_modified").alias("pipe_received_time"))
        if not self._batches("ledger"):
            return listed
        seen = self.ledger().select(F.col("file_name").alias("meta_filename"), "file_size")
        return listed.join(seen, ["meta_filename", "file_size"], "left_anti").select(*listed.columns)

    def _chunks(self) -> Iterator[list[Row]]:
        """The pending files in order of their names, a batch at a time: the
        driver never holds more names than one batch has."""
        rows = self.pending().orderBy("name").toLocalIterator()
        while chunk := list(islice(rows, self.max_files)):
            yield chunk

    def load(self, batch_id: int) -> None:
        """Land and ledger one planned batch; repeating it changes nothing."""
        plan = self.spark.read.schema(PLAN).parquet(f"{self.target}/plan/batch_id={batch_id}")
        # One batch of names, at most ``max_files``.
        files = plan.select("name", "file_size", "last_load_time").collect()
        load_ts = files[0]["last_load_time"]
        numbered = read_numbered(self.spark, [escape_glob(f["name"]) for f in files], self.n_fields, self.fmt,
                                 max(f["file_size"] for f in files))
        rows = numbered.select(*pick(numbered, self.positions, self.fmt), "meta_filename", "meta_file_row_number",
                               ntz(load_ts).alias("meta_load_ts"),
                               F.col(CORRUPT).isNotNull().alias("meta_malformed"))
        if self.typing is not None:
            rows = self.typing(rows)
        landing = f"{self.landing_path}/batch_id={batch_id}"
        rows.write.mode("overwrite").parquet(landing)
        counts = (self.spark.read.schema(rows.schema).parquet(landing).groupBy("meta_filename")
                  .agg(F.count(F.lit(1)).alias("row_count"), F.count_if("meta_malformed").alias("error_count")))
        zero = F.lit(0).cast("bigint")
        ledger = plan.join(counts, "meta_filename", "left").select(
            F.when(F.coalesce("error_count", zero) == 0, F.lit("LOADED"))
             .when(F.col("error_count") < F.col("row_count"), F.lit("PARTIALLY_LOADED"))
             .otherwise(F.lit("LOAD_FAILED")).alias("status"),
            F.lit(self.pipe_name).alias("pipe_name"), F.lit(self.table_name).alias("table_name"),
            F.col("meta_filename").alias("file_name"), "file_size",
            F.coalesce("row_count", zero).alias("row_count"), F.coalesce("error_count", zero).alias("error_count"),
            "pipe_received_time", "last_load_time")
        # One small file, so that a reader of the ledger sees a batch whole or not at all.
        ledger.coalesce(1).write.mode("overwrite").parquet(f"{self.ledger_path}/batch_id={batch_id}")

    def run_available_now(self) -> list[int]:
        """A6 + A7: load every file not loaded yet; the ids of the batches."""
        planned, done = self._batches("plan"), self._batches("ledger")
        unfinished = sorted(planned - done)
        for batch_id in unfinished:
            self.load(batch_id)
        loaded, batch_id = unfinished, max(planned, default=-1)
        for chunk in self._chunks():
            batch_id += 1
            load_ts = self.clock(batch_id)
            rows = [(*r, load_ts) for r in chunk]
            (self.spark.createDataFrame(rows, PLAN).coalesce(1)
             .write.mode("overwrite").parquet(f"{self.target}/plan/batch_id={batch_id}"))
            self.load(batch_id)
            loaded.append(batch_id)
        return loaded

    def start(self, every: str = "15 minutes"):
        """A11 scheduled form: a streaming query over the folder wakes the pipe
        when files arrived; which files are loaded is the ledger's decision."""
        arrivals = self.spark.readStream.format("text").option("maxFileAge", NEVER).load(self.source)
        return (arrivals.writeStream.foreachBatch(lambda _df, _id: self.run_available_now())
                .option("checkpointLocation", self.checkpoint_path)
                .trigger(processingTime=every).start())

    def landing(self) -> DataFrame:
        return self.spark.read.parquet(self.landing_path)

    def ledger(self) -> DataFrame:
        return self.spark.read.parquet(self.ledger_path)


class LandingFeed:
    """A10: append-only change feed over the batches of a pipe's target."""

    def __init__(self, spark: SparkSession, landing_path: str):
        self.spark, self.path = spark, landing_path.rstrip("/")
        self.ledger_path = f"{self.path.rsplit('/', 1)[0]}/ledger"
        self.rows_of_epoch: dict[int, int] = {}  # landed rows that each micro-batch of ``consume`` took

    def committed_batches(self) -> list[int]:
        """Ids of the ledgered batches: one listing of names, no data is read,
        and a half-written batch does not count."""
        done = glob_paths(self.spark, f"{self.ledger_path}/batch_id=*/_SUCCESS")
        return sorted(int(p.split("/")[-2].split("=")[1]) for p in done)

    def batch(self, batch_id: int) -> DataFrame:
        """One committed batch (its folder only)."""
        return self.spark.read.parquet(f"{self.path}/batch_id={batch_id}")

    def load_time(self, batch_id: int):
        """The batch's load time, from its ledger rows: the stamp a consumer
        applies, identical on replay or after a restart."""
        return self.spark.read.parquet(f"{self.ledger_path}/batch_id={batch_id}").agg(F.max("last_load_time")).first()[0]

    def pending(self, applied: set[int]) -> list[int]:
        return [b for b in self.committed_batches() if b not in applied]

    def consume(self, apply: Callable[[DataFrame, int, dt.datetime], None], checkpoint: str,
                every: str | None = None):
        """The feed as a stream: ``apply(rows, batch_id, load_time)`` for each
        batch that is new to the query whose checkpoint this is, in order. The
        source is the ledger, whose files are written last and once; its rows
        say which batches to read, so no folder is probed per batch. After a
        failure the last micro-batch comes again: ``apply`` is told the batch id
        and must be a no-op for one it has seen (``KeyedTable.merge`` is).
        ``every`` None: all that is there, then the query ends."""
        if not path_exists(self.spark, self.ledger_path):
            return None
        schema = "batch_id int, last_load_time timestamp_ntz, row_count bigint"
        rows = (self.spark.readStream.schema(schema).option("maxFileAge", NEVER).parquet(self.ledger_path))

        def step(batch: DataFrame, epoch: int) -> None:
            # One row per new batch of the feed.
            new = batch.groupBy("batch_id").agg(F.max("last_load_time").alias("t"), F.sum("row_count").alias("n"))
            taken = 0
            for r in new.orderBy("batch_id").collect():
                apply(self.batch(r["batch_id"]), r["batch_id"], r["t"])
                taken += r["n"]
            self.rows_of_epoch[epoch] = taken

        writer = rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
        if every is not None:
            return writer.trigger(processingTime=every).start()
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
