"""V3 incremental models and the V1 conformed upsert, run against persisted
keyed tables.

A model run is ``delta = f(visible sources, current target)`` followed by
``KeyedTable.merge(delta)``. ``target is None`` plays the part of the
reference's "first run" branch. Example queries replay the raw history as a
few load cuts (a landing batch holds the rows whose load time is below the
cut), which is how the incremental path is exercised and compared with a full
recomputation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.parse import TS_WITHOUT_SECONDS, ntz, try_boolean, try_timestamp
from riverbed.operators.dedupe import LINEAGE, latest_keep_null_keys
from riverbed.operators.scd import scd1_delta, scd2_dim_delta, scd2_snapshot_delta
from riverbed.operators.upsert import KeyedTable, after_mark, high_water_mark
from riverbed.plans import fraud
from riverbed.plans.propagate import unread
from riverbed.session import scratch_path

# Load cuts used to replay the fixture history in three runs.
DEFAULT_CUTS = (dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21), None)
LOAD_ORDER = ["meta_load_ts desc", "meta_file_row_number desc", "meta_filename desc"]


# -- H10 incremental -------------------------------------------------------------
def invalid_delta(txn: DataFrame, current: DataFrame | None, mark=None) -> DataFrame:
    """fct_invalid_transactions: invalid rows past the mark, latest per key.
    ``mark`` defaults to ``MAX(meta_load_ts)`` of ``current``."""
    if mark is None:
        mark = high_water_mark(current, "meta_load_ts")
    rows = after_mark(txn.filter(F.col("validation_status") != fraud.VALID), "meta_load_ts", mark)
    return latest_keep_null_keys(rows, ["trans_num"]).select(*fraud.QUARANTINE_COLS)


# -- H4 incremental --------------------------------------------------------------
def merchants_delta(stg_merch: DataFrame, current: DataFrame | None) -> DataFrame:
    """dim_merchants: latest per merchant, new or newer than the dimension."""
    return fraud.dim_merchants_cols(
        scd1_delta(stg_merch, current, ["merchant"], LOAD_ORDER, "meta_load_ts"))


# -- H6 / H7 -----------------------------------------------------------------------
SNAPSHOT_COLS = ("card_num", *fraud.CLIENT_ATTRS, "valid_from", *LINEAGE,
                 "dbt_updated_at", "dbt_valid_from", "dbt_valid_to", "dbt_scd_id")
DIM_CLIENT_COLS = ("card_num", *fraud.CLIENT_ATTRS, "meta_load_ts", "valid_from", "valid_to",
                   "is_current", "dbt_scd_id", "dbt_updated_at")


def snapshot_delta(deduped: DataFrame, current: DataFrame | None) -> DataFrame:
    """clients_snapshot: unique key card_num, timestamp strategy on load time."""
    delta = scd2_snapshot_delta(current, deduped, "card_num", "meta_load_ts",
                                bucket_unit=fraud.SCD2_BUCKET)
    return delta.select(*SNAPSHOT_COLS)


def dim_clients_delta(snapshot: DataFrame, current: DataFrame | None,
                      strict_reference: bool = False, mark=None) -> DataFrame:
    """dim_clients: snapshot versions past the dimension's mark (Q1 fix by default)."""
    if mark is None:
        mark = high_water_mark(current, "dbt_updated_at")
    rows = scd2_dim_delta(snapshot, mark, strict_reference=strict_reference)
    return rows.select(
        "card_num", *fraud.CLIENT_ATTRS, "meta_load_ts",
        F.col("dbt_valid_from").alias("valid_from"), F.col("dbt_valid_to").alias("valid_to"),
        F.col("dbt_valid_to").isNull().alias("is_current"), "dbt_scd_id", "dbt_updated_at")


# -- H9 ----------------------------------------------------------------------------
def fact_delta(txn: DataFrame, dim_merch: DataFrame, dim_cli: DataFrame,
               current: DataFrame | None, mark=None) -> DataFrame:
    """fct_fraud_full: VALID rows past the fact's mark, enriched with the
    dimensions as they are now; latest row per trans_num (Q5)."""
    if mark is None:
        mark = high_water_mark(current, "meta_load_ts")
    rows = after_mark(txn.filter(F.col("validation_status") == fraud.VALID), "meta_load_ts", mark)
    # The joins keep each row once, so the narrow rows are reduced before them.
    rows = latest_keep_null_keys(rows, ["trans_num"])
    return fraud.enriched_fact(rows, dim_merch, dim_cli).select(*fraud.FACT_COLS)


class FraudWarehouse:
    """The V3 tables as keyed Parquet tables under one root.

    The landing tables carry ``batch_id``, and a load delivers one batch of each.
    A model's offset is the newest batch that its own table has applied, so it
    commits with the model's rows: a run reads the batches past it (other
    folders are pruned), and of the target the rows of the keys in them. What a
    run reads does not grow with the raw history."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        mk = lambda name, keys, mark=None: KeyedTable(
            spark, f"{root}/{name}", keys, mark_col=mark)
        # High-water marks come with the writes (no scan of the target).
        self.invalid = mk("fct_invalid_transactions", ["trans_num"], "meta_load_ts")
        self.merchants = mk("dim_merchants", ["merchant"], "meta_load_ts")
        self.snapshot = mk("clients_snapshot", ["dbt_scd_id"], "dbt_updated_at")
        self.clients = mk("dim_clients", ["dbt_scd_id"], "dbt_updated_at")
        self.facts = mk("fct_fraud_full", ["trans_num"], "meta_load_ts")

    def run(self, landing: dict[str, DataFrame], run_id: int, models: Sequence[str] = (
            "invalid", "merchants", "snapshot", "clients", "facts")) -> None:
        """One scheduled run over the landing batches up to ``run_id``, in
        dependency order (staging -> snapshot -> dims -> facts). Models that
        do not depend on each other are refreshed concurrently: each submits
        its own Spark jobs from a driver thread, and the scheduler shares
        the executors between them. A model that has applied the batch is left
        alone, so a run that died half way is simply run again."""
        want = set(models)

        def fresh(name: str, table: KeyedTable) -> DataFrame:
            return unread(landing[name], table.offset(), run_id)

        def merge(table: KeyedTable, delta) -> None:
            if run_id not in table.applied_batches():
                table.merge(delta(), batch_id=run_id, on_duplicates="unique")

        def invalid():
            merge(self.invalid, lambda: invalid_delta(
                fraud.stg_transactions(fresh("raw_trans", self.invalid)), None, self.invalid.mark()))

        def merchants():
            # New or newer is decided per key: a late merchant may carry a load
            # time at or below the table's largest.
            def delta():
                rows = fraud.stg_merchants(fresh("raw_merch", self.merchants))
                held = self.merchants.read_matching(rows.select("merchant").distinct()) if self.merchants.exists() else None
                return merchants_delta(rows, held)
            merge(self.merchants, delta)

        def clients():
            def delta():
                rows = fraud.clients_deduped(fraud.stg_clients(fresh("raw_clients", self.snapshot)))
                held = self.snapshot.read_matching(rows.select("card_num").distinct()) if self.snapshot.exists() else None
                return snapshot_delta(rows, held)
            merge(self.snapshot, delta)
            if want & {"clients", "facts"}:
                # Only snapshot batches past the dimension's offset can hold
                # versions past its mark (the mark filter decides).
                merge(self.clients, lambda: dim_clients_delta(
                    self.snapshot.changes_after(self.clients.offset()), None, mark=self.clients.mark()))

        branches = []
        if "invalid" in want:
            branches.append(invalid)
        if want & {"merchants", "facts"}:
            branches.append(merchants)
        if want & {"snapshot", "clients", "facts"}:
            branches.append(clients)
        with ThreadPoolExecutor(max_workers=max(1, len(branches))) as pool:
            for f in [pool.submit(b) for b in branches]:
                f.result()  # re-raise a failed branch
        if "facts" in want:
            merge(self.facts, lambda: fact_delta(
                fraud.stg_transactions(fresh("raw_trans", self.facts)), self.merchants.read(), self.clients.read(),
                None, self.facts.mark()))


def land_batches(spark: SparkSession, raw: dict[str, DataFrame], root: str,
                 batch: Callable[[str], Column]) -> dict[str, DataFrame]:
    """The raw tables as landing tables, one folder per batch."""
    for name, df in raw.items():
        df.withColumn("batch_id", batch(name)).write.partitionBy("batch_id").parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in raw}


def batch_of_cut(cuts: Sequence) -> Column:
    """The load that delivers a row: the first cut past its load time."""
    batch = F.lit(0)
    for cut in cuts:
        if cut is not None:
            batch = batch + (F.col("meta_load_ts") >= ntz(cut)).cast("int")
    return batch


NEEDS = {"invalid": ("raw_trans",), "merchants": ("raw_merch",), "snapshot": ("raw_clients",),
         "clients": ("raw_clients",), "facts": ("raw_trans", "raw_merch", "raw_clients")}


def replay(spark: SparkSession, raw: dict[str, DataFrame], name: str, models: Sequence[str], cuts=DEFAULT_CUTS,
           landing: dict[str, DataFrame] | None = None) -> FraudWarehouse:
    """Run the V3 models once per load cut on a fresh warehouse. ``landing``:
    the raw tables as landed by batch, where that has been done."""
    root = scratch_path(spark, name)
    wh = FraudWarehouse(spark, root)
    if landing is None:
        used = {t: raw[t] for m in models for t in NEEDS[m]}
        landing = land_batches(spark, used, f"{root}/landing", lambda _name: batch_of_cut(cuts))
    for run_id in range(len(cuts)):
        wh.run(landing, run_id, models)
    return wh


# -- V1: typed landing + changed-only upsert (A8, A10, W1, H1) ----------------------
CONFORMED_TRACKED = ("trans_ts", "category", "is_fraud", "source_filename")
CONFORMED_COLS = ("trans_id", *CONFORMED_TRACKED, "processed_ts")


def typed_landing(raw_trans: DataFrame) -> DataFrame:
    """V1 parses at load time with one timestamp layout (Q8): values with
    seconds land as NULL there, and the row is kept."""
    return raw_trans.select(
        F.col("trans_num_raw").alias("trans_id"),
        try_timestamp("trans_date_raw", TS_WITHOUT_SECONDS).alias("trans_ts"),
        F.col("category_raw").alias("category"),
        try_boolean("is_fraud_raw").alias("is_fraud"),
        *LINEAGE)


def typed_landing_v1(rows: DataFrame) -> DataFrame:
    """A8 inside the pipe: the picked wide fields typed at load time."""
    return rows.select(
        "trans_id", try_timestamp("trans_date_raw", TS_WITHOUT_SECONDS).alias("trans_ts"),
        "category", try_boolean("is_fraud_raw").alias("is_fraud"), *LINEAGE, "meta_malformed")


def landing_batch(load_ts) -> F.Column:
    """Batch of a landed row: five-day windows of its load time."""
    return F.floor((F.dayofyear(load_ts) - 1) / 5).cast("int")


def batch_stamp(batch_id: int) -> dt.datetime:
    """processed_ts of a batch: a parameter of the batch (replay-safe)."""
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=5 * (batch_id + 1))


def conformed_source(batch: DataFrame) -> DataFrame:
    """W1 over one landing batch, shaped as the conformed table (no stamp); its
    rows without a key all stay, for the table to set aside."""
    latest = latest_keep_null_keys(batch, ["trans_id"])
    return latest.select("trans_id", "trans_ts", "category", "is_fraud",
                         F.col("meta_filename").alias("source_filename"))


def conformed_table(spark: SparkSession, root: str) -> KeyedTable:
    return KeyedTable(spark, root, ["trans_id"], tracked=CONFORMED_TRACKED)


def upsert_conformed(table: KeyedTable, batch: DataFrame, batch_id: int, stamp) -> bool:
    """H1: changed-only upsert of one landing batch; idempotent per batch id."""
    return table.merge(conformed_source(batch), stamp=("processed_ts", stamp), batch_id=batch_id,
                       on_duplicates="unique")


def conformed_replay(landing: DataFrame, batch_col: str = "batch_id") -> DataFrame:
    """H1 applied to every batch at once (backfill form), equal to the
    sequential upsert: per (key, batch) the latest row; a batch changes the
    key when its row IS DISTINCT FROM the key's previous batch row; the
    conformed row is the key's last batch row stamped with its last change.
    No loop over batches."""
    from pyspark.sql import Window

    # NULL keys are set aside, as the sequential upsert does; the partial limit
    # runs before the exchange, so a hot (key, batch) ships one row per task.
    per_batch = latest_by_load_in(landing.filter(F.col("trans_id").isNotNull()), ["trans_id", batch_col])
    w = Window.partitionBy("trans_id").orderBy(batch_col)
    prev = [F.lag(c).over(w) for c in ("trans_ts", "category", "is_fraud", "meta_filename")]
    cur = [F.col(c) for c in ("trans_ts", "category", "is_fraud", "meta_filename")]
    changed = F.row_number().over(w) == 1
    for p, c in zip(prev, cur, strict=True):
        changed = changed | ~p.eqNullSafe(c)
    stamp = F.timestamp_add("DAY", (F.col(batch_col) + 1) * 5, F.lit("2024-01-01").cast("timestamp_ntz"))
    flagged = per_batch.withColumn("_changed", changed).withColumn("_stamp", stamp)
    wk = Window.partitionBy("trans_id")
    last = Window.partitionBy("trans_id").orderBy(F.col(batch_col).desc())
    out = (flagged.withColumn("processed_ts", F.max(F.when(F.col("_changed"), F.col("_stamp"))).over(wk))
           .withColumn("_last", F.row_number().over(last))
           .filter(F.col("_last") == 1))
    return out.select("trans_id", "trans_ts", "category", "is_fraud",
                      F.col("meta_filename").alias("source_filename"), "processed_ts")


def latest_by_load_in(df: DataFrame, keys: list[str]) -> DataFrame:
    from riverbed.operators.dedupe import latest_per_key
    return latest_per_key(df, keys, LOAD_ORDER)
