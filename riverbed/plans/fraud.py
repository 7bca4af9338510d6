"""The card-fraud models, the worked example of the library.

Staging (H12-H14) parses the raw text once with typed columns and keeps the
lineage; the V2 models (derived tables, recomputed) and the V3 models
(incremental) are built from them. Each model is a plain function of
DataFrames, so Catalyst sees the whole DAG at the action.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.functions.parse import (DATE_DMY, TS_WITH_SECONDS, TS_WITHOUT_SECONDS,
                                      first_failure, floor_ntz, parse_first, try_boolean,
                                      try_date, try_decimal)
from riverbed.operators import enrich
from riverbed.operators.dedupe import LINEAGE, latest_by_load, latest_per_key
from riverbed.operators.scd import scd2_from_history

VALID = "VALID"
# Validation order is part of the contract (first failure is reported).
TXN_RULES = (("trans_ts", "INVALID_DATE"), ("amount", "INVALID_AMOUNT"),
             ("is_fraud", "INVALID_IS_FRAUD"))

CLIENT_ATTRS = ("first_name", "last_name", "gender", "date_birth", "job", "street", "city", "state")
QUARANTINE_COLS = ("trans_num", "validation_status", "meta_load_ts", "trans_ts", "card_num",
                   "amount", "merchant", "category", "is_fraud")
FACT_COLS = ("trans_num", "trans_ts", "card_num", "amount", "category", "is_fraud",
             "first_name", "last_name", "gender", "job", "client_city", "client_state",
             "merchant", "merchant_lat", "merchant_long", "meta_load_ts")


# -- staging (H12, H13, H14) -------------------------------------------------
def stg_transactions(raw_trans: DataFrame) -> DataFrame:
    """Typed transactions with a validation label."""
    typed = raw_trans.select(
        F.col("trans_num_raw").alias("trans_num"),
        parse_first("trans_date_raw", [TS_WITH_SECONDS, TS_WITHOUT_SECONDS]).alias("trans_ts"),
        F.col("card_num_raw").alias("card_num"),
        try_decimal("amount_raw", 18, 2).alias("amount"),
        F.col("merchant_raw").alias("merchant"),
        F.col("category_raw").alias("category"),
        try_boolean("is_fraud_raw").alias("is_fraud"),
        *LINEAGE)
    status = first_failure([(F.col(c).isNull(), label) for c, label in TXN_RULES], VALID)
    return typed.withColumn("validation_status", status)


def stg_merchants(raw_merch: DataFrame) -> DataFrame:
    """Typed merchants."""
    return raw_merch.select(
        F.col("merchant_raw").alias("merchant"),
        try_decimal("merchant_lat_raw", 11, 8).alias("merchant_lat"),
        try_decimal("merchant_long_raw", 11, 8).alias("merchant_long"),
        *LINEAGE)


def stg_clients(raw_clients: DataFrame) -> DataFrame:
    """Typed clients (S3)."""
    return raw_clients.select(
        F.col("card_num_raw").alias("card_num"),
        F.col("first_name_raw").alias("first_name"),
        F.col("last_name_raw").alias("last_name"),
        F.col("gender_raw").alias("gender"),
        try_date("date_birth_raw", DATE_DMY).alias("date_birth"),
        F.col("job_raw").alias("job"),
        F.col("street_raw").alias("street"),
        F.col("city_raw").alias("city"),
        F.col("state_raw").alias("state"),
        *LINEAGE)


# -- data quality (S8, S9, H10) ----------------------------------------------
def valid(txn: DataFrame) -> DataFrame:
    """S8."""
    return txn.filter(F.col("validation_status") == VALID)


def quarantine(txn: DataFrame) -> DataFrame:
    """S9 / H10 full: invalid rows in the quarantine column order."""
    return txn.filter(F.col("validation_status") != VALID).select(*QUARANTINE_COLS)


# -- dimensions --------------------------------------------------------------
def merchants_latest(stg_merch: DataFrame) -> DataFrame:
    """H4 full (dt_merchants / int_merchants_latest): latest row per merchant."""
    return latest_by_load(stg_merch, ["merchant"])


def dim_merchants_cols(df: DataFrame) -> DataFrame:
    return df.select("merchant", "merchant_lat", "merchant_long", "meta_load_ts")


def clients_deduped(stg_cli: DataFrame) -> DataFrame:
    """W2 (int_clients_deduped): one row per (card, load time), highest row
    number (then greatest file name) wins; ``valid_from`` = load time."""
    latest = latest_per_key(stg_cli, ["card_num", "meta_load_ts"],
                            ["meta_file_row_number desc", "meta_filename desc"])
    return latest.select("card_num", *CLIENT_ATTRS, F.col("meta_load_ts").alias("valid_from"),
                         *LINEAGE)


# Versions are chained per (card, load day) first, so a card with a very long
# history is spread over its days (see ``next_in_key``).
SCD2_BUCKET = "day"


def clients_scd2(deduped: DataFrame) -> DataFrame:
    """H5 (dt_clients_scd2): LEAD over load time per card."""
    out = scd2_from_history(deduped, "card_num", "valid_from",
                            bucket=floor_ntz(F.col("valid_from"), SCD2_BUCKET))
    return out.select("card_num", *CLIENT_ATTRS, "valid_from", "meta_load_ts", "valid_to", "is_current")


# -- facts -------------------------------------------------------------------
def _fact_select(j: DataFrame, extra: tuple[str, ...] = (), p: str = "_d_",
                 c: str = "_c_") -> DataFrame:
    return j.select(
        "trans_num", "trans_ts", "card_num", "amount", "category", "is_fraud",
        F.col(c + "first_name").alias("first_name"), F.col(c + "last_name").alias("last_name"),
        F.col(c + "gender").alias("gender"), F.col(c + "job").alias("job"),
        F.col(c + "city").alias("client_city"), F.col(c + "state").alias("client_state"),
        F.col(p + "merchant").alias("merchant"), F.col(p + "merchant_lat").alias("merchant_lat"),
        F.col(p + "merchant_long").alias("merchant_long"), "meta_load_ts", *extra)


def enriched_fact(txn: DataFrame, merchants: DataFrame, client_versions: DataFrame,
                  extra: tuple[str, ...] = (), as_of: str = "routed") -> DataFrame:
    """H8 (dt_fraud_full): VALID transactions + current merchant (J1) + the
    client version valid at the transaction time (J2).

    ``as_of="interval"``: equi join on the card with the interval as residual
    (broadcast for a small dimension, else sort-merge with AQE skew split).
    ``as_of="sweep"``: the linear carry-forward form bucketed by day.
    ``as_of="routed"``: the sweep for cards of very many versions, the equi
    join for all others; which cards these are is looked up first."""
    t = valid(txn).select("trans_num", "trans_ts", "card_num", "amount", "merchant", "category",
                          "is_fraud", "meta_load_ts", *extra)
    m = dim_merchants_cols(merchants)
    c = client_versions.select("card_num", "first_name", "last_name", "gender", "job", "city",
                               "state", "valid_from", "valid_to")
    j = enrich.join_current(t, m, "merchant", prefix="_d_")
    shown = ["first_name", "last_name", "gender", "job", "city", "state"]
    if as_of == "sweep":
        j = enrich.join_as_of_sweep(j, c, "card_num", "trans_ts", shown, prefix="_c_", bucket_unit=SCD2_BUCKET)
    elif as_of == "routed":
        j = enrich.join_as_of_routed(j, c, "card_num", "trans_ts", shown, prefix="_c_", bucket_unit=SCD2_BUCKET)
    else:
        j = enrich.join_as_of(j, c, "card_num", "trans_ts", prefix="_c_")
    return _fact_select(j, extra)


def trans_merch(txn: DataFrame, merchants: DataFrame) -> DataFrame:
    """J1 archive form (dt_trans_merch): every transaction, with its status."""
    t = txn.select("trans_num", "trans_ts", "card_num", "amount", "merchant", "category",
                   "is_fraud", "validation_status", "meta_load_ts")
    j = enrich.join_current(t, dim_merchants_cols(merchants), "merchant", prefix="_d_")
    return j.select("trans_num", "trans_ts", "card_num", "amount", "category", "is_fraud",
                    "validation_status", F.col("_d_merchant").alias("merchant"),
                    F.col("_d_merchant_lat").alias("merchant_lat"),
                    F.col("_d_merchant_long").alias("merchant_long"), "meta_load_ts")


def trans_all_clients(tm: DataFrame, client_versions: DataFrame) -> DataFrame:
    """J3/J4 (dt_trans_all_clients): fan-out to every client version."""
    c = client_versions.select("card_num", "first_name", "last_name", "gender", "job", "city", "state")
    j = enrich.join_all_versions(tm, c, "card_num", prefix="_c_")
    return j.select(*tm.columns,
                    F.col("_c_first_name").alias("first_name"), F.col("_c_last_name").alias("last_name"),
                    F.col("_c_gender").alias("gender"), F.col("_c_job").alias("job"),
                    F.col("_c_city").alias("client_city"), F.col("_c_state").alias("client_state"))


def fraud_archive(tac: DataFrame) -> DataFrame:
    """H11 (archive dt_fraud_full): VALID filter over the fan-out; the
    interval filter of the archive is dead text after its ';' (Q6)."""
    return tac.filter(F.col("validation_status") == VALID)


# -- V2 as one DAG -------------------------------------------------------------
def v2_models(raw: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """All V2 derived tables from the three raw tables (lazy)."""
    txn = stg_transactions(raw["raw_trans"])
    merch = merchants_latest(stg_merchants(raw["raw_merch"]))
    deduped = clients_deduped(stg_clients(raw["raw_clients"]))
    scd2 = clients_scd2(deduped)
    return {
        "dt_transactions": txn.drop("meta_filename", "meta_file_row_number"),
        "dt_merchants": dim_merchants_cols(merch),
        "dt_clients_deduped": deduped.select("card_num", *CLIENT_ATTRS, "valid_from", "meta_load_ts"),
        "dt_clients_scd2": scd2,
        "dt_invalid_trans": quarantine(txn),
        "dt_fraud_full": enriched_fact(txn, merch, scd2, as_of="interval"),
    }
