"""Incremental refresh of the enriched fact (H8, H15): new rows, and old rows
whose dimensions changed.

A refresh reads the landing batches past the fact's offset. It brings the
merchant and client dimensions up to date for the keys in those batches alone,
and notes what really changed: merchants whose shown columns differ, and per
card the earliest time from which its versions differ. A client version that
arrives late, between two versions that are there, changes its predecessor's
end too. The fact rows to recompute are then the new transactions, those of
changed merchants, and those of changed cards from that time on; their batch is
merged into the fact, whose rows are known by file and row number. The result
equals a full recomputation after every refresh.

Transactions are kept as typed columns, one folder per batch and card bucket,
so that a few changed cards prune the folders that are read.

Rows of a NULL card or merchant never match a dimension; dimension rows with a
NULL key are set aside by their tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.functions.parse import any_distinct
from riverbed.operators.dedupe import latest_per_key
from riverbed.operators.upsert import KeyedTable
from riverbed.plans import fraud
from riverbed.plans.pipeline import RunLog
from riverbed.session import stage

BUCKETS = 32
LINE = ["meta_filename", "meta_file_row_number"]
LOAD_ORDER = ["meta_load_ts desc", "meta_file_row_number desc", "meta_filename desc"]
SHOWN_CLIENT = ("first_name", "last_name", "gender", "job", "city", "state")
TXN = ("trans_num", "trans_ts", "card_num", "amount", "merchant", "category", "is_fraud", "meta_load_ts", *LINE)


def card_bucket(card: Column) -> Column:
    return F.pmod(F.xxhash64(card), F.lit(BUCKETS)).cast("int")


def unread(landing: DataFrame, after: int, upto: int) -> DataFrame:
    """Landing rows of the batches past an offset (other folders are pruned)."""
    return landing.filter((F.col("batch_id") > after) & (F.col("batch_id") <= upto)).drop("batch_id")


class FraudFact:
    """``dt_fraud_full`` and the tables it is kept from, under one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.merchants = KeyedTable(spark, f"{root}/dt_merchants", ["merchant"])
        self.history = KeyedTable(spark, f"{root}/dt_clients_deduped", ["card_num", "meta_load_ts"])
        self.versions = KeyedTable(spark, f"{root}/dt_clients_scd2", ["card_num", "valid_from"])
        self.facts = KeyedTable(spark, f"{root}/dt_fraud_full", LINE)
        self.txn_path = f"{self.root}/transactions"

    def _updated(self, table: KeyedTable, new: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
        """The rows that the table should hold for the keys of ``new``."""
        new = latest_per_key(new, table.keys, order)
        if not table.exists():
            return new
        held = table.read_matching(new.select(*keys).distinct())
        return latest_per_key(held.unionByName(new), table.keys, order)

    def _merchants(self, landing: DataFrame, upto: int, out: str) -> None:
        """Bring the merchants up to date; those whose shown columns differ
        after the unread batches go to ``out`` first."""
        if upto in self.merchants.applied_batches():
            return
        new = fraud.stg_merchants(unread(landing, self.merchants.offset(), upto)).filter("merchant IS NOT NULL")
        rows = stage(self._updated(self.merchants, new, ["merchant"], LOAD_ORDER), "merchants-updated")
        shown = ["merchant", "merchant_lat", "merchant_long"]
        changed = rows.select(*shown)
        if self.merchants.exists():
            changed = changed.subtract(self.merchants.read_matching(rows.select("merchant")).select(*shown))
        changed.select("merchant").distinct().write.mode("overwrite").parquet(out)
        self.merchants.merge(rows, batch_id=upto, on_duplicates="unique")

    def _cards(self, landing: DataFrame, upto: int, out: str) -> None:
        """Bring the client versions up to date; (card_num, since) of the cards
        whose versions differ after the unread batches goes to ``out`` first."""
        if upto in self.versions.applied_batches():
            return
        new = (fraud.clients_deduped(fraud.stg_clients(unread(landing, self.versions.offset(), upto)))
               .filter("card_num IS NOT NULL").drop("valid_from"))
        order = ["meta_file_row_number desc", "meta_filename desc"]
        rows = stage(self._updated(self.history, new, self.history.keys, order), "clients-updated")
        cards = stage(rows.select("card_num").distinct(), "cards-touched")
        self.history.merge(rows, batch_id=upto, on_duplicates="unique")
        # A touched card's versions are chained anew over all of its history.
        chained = stage(fraud.clients_scd2(self.history.read_matching(cards).withColumn(
            "valid_from", F.col("meta_load_ts"))), "versions-chained")
        # A version is new, or differs from the one held under its key; one that
        # only ends earlier ends where a new one begins. Held and chained rows
        # meet once, by their key.
        changed = chained.withColumn("_shown_differs", F.lit(True))
        if self.versions.exists():
            held = self.versions.read_matching(cards)
            held = held.select(*[F.col(c).alias(f"_h_{c}") for c in chained.columns], F.lit(True).alias("_held"))
            pairs = chained.join(held, [chained[k] == held[f"_h_{k}"] for k in self.versions.keys], "left")

            def differs(cols):
                return F.col("_held").isNull() | any_distinct([F.col(f"_h_{c}") for c in cols], [F.col(c) for c in cols])

            changed = stage(pairs.filter(differs(chained.columns)).select(
                *chained.columns, differs(SHOWN_CLIENT).alias("_shown_differs")), "versions-changed")
        (changed.filter("_shown_differs").groupBy("card_num").agg(F.min("valid_from").alias("since"))
         .write.mode("overwrite").parquet(out))
        changed = changed.drop("_shown_differs")
        self.versions.merge(changed, batch_id=upto, on_duplicates="unique")

    def refresh(self, landing: Mapping[str, DataFrame], upto: int, log: RunLog | None = None) -> bool:
        """Take in the landing batches up to ``upto`` (landing tables carry
        ``batch_id``), one refresh per batch; False when that has been. A refresh
        that died is run again: a dimension's changed keys are written before
        it commits, and one that has committed the batch is left alone."""
        if upto in self.facts.applied_batches():
            return False
        log, offset = log or RunLog(self.spark), self.facts.offset()
        with log.run("DT_FRAUD_FULL", "INCREMENTAL" if self.facts.exists() else "FULL") as run:
            new = (fraud.valid(fraud.stg_transactions(unread(landing["raw_trans"], offset, upto))).select(*TXN)
                   .withColumn("card_bucket", card_bucket(F.col("card_num"))))
            changes = f"{self.root}/changes/batch_id={upto}"
            self._merchants(landing["raw_merch"], upto, f"{changes}/merchants")
            self._cards(landing["raw_clients"], upto, f"{changes}/cards")
            # The new rows are parsed once, into their folders, and read from there.
            folder = f"{self.txn_path}/batch_id={upto}"
            new.write.mode("overwrite").partitionBy("card_bucket").parquet(folder)
            new = self.spark.read.schema(new.schema).parquet(folder).select(*new.columns)
            todo = new.drop("card_bucket")
            if self.facts.exists():
                old = self.spark.read.parquet(self.txn_path)
                old = old.filter((F.col("batch_id") <= offset)).drop("batch_id")
                merchants = self.spark.read.parquet(f"{changes}/merchants")
                cards = self.spark.read.parquet(f"{changes}/cards").select(
                    "card_num", "since", card_bucket(F.col("card_num")).alias("card_bucket"))
                by_card = old.join(cards, ["card_bucket", "card_num"]).filter("trans_ts >= since")
                todo = (new.unionByName(old.join(merchants, "merchant", "left_semi").select(*new.columns))
                        .unionByName(by_card.select(*new.columns)).dropDuplicates(LINE))
                todo = stage(todo.drop("card_bucket"), "facts-todo")
            run.row_count = todo.count()
            fact = fraud.enriched_fact(todo.withColumn("validation_status", F.lit(fraud.VALID)), self.merchants.read(),
                                       self.versions.read(), extra=tuple(LINE))
            self.facts.merge(fact, batch_id=upto, on_duplicates="unique")
        log.flush()
        return True

    def read(self) -> DataFrame:
        return self.facts.read().drop(*LINE)
