"""Wide-file normalisation (A12): one wide card-transaction table split into
transaction, client and merchant tables, each de-duplicated on its full row.

``wide_from_tables`` derives the wide shape from the driver tables
(lineitem x orders x customer x part x nation); ``split_wide`` is the
operator; ``write_csv`` is the sink (header line, one folder per entity).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.sources.fixtures import table

# Fixed column lists of the three entity files (the reference's split).
TRANS_COLS = ("trans_num", "trans_date_trans_time", "cc_num", "amt", "merchant", "category",
              "is_fraud")
CLIENT_COLS = ("cc_num", "first", "last", "gender", "street", "city", "state", "zip", "job",
               "dob")
MERCHANT_COLS = ("trans_num", "merchant", "merch_lat", "merch_long")


def wide_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One wide row per lineitem, named like the card-transaction export."""
    li = table(spark, sf_dir, "lineitem")
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    p = table(spark, sf_dir, "part")
    n = table(spark, sf_dir, "nation")
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(c, o.o_custkey == c.c_custkey)
           .join(p, li.l_partkey == p.p_partkey)
           .join(n, c.c_nationkey == n.n_nationkey))
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
         .alias("trans_num"),
        F.date_format("o_orderdate", "dd-MM-yyyy HH:mm:ss").alias("trans_date_trans_time"),
        F.col("c_custkey").alias("cc_num"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("amt"),
        F.col("p_brand").alias("merchant"),
        F.col("p_type").alias("category"),
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("is_fraud"),
        F.col("c_name").alias("first"),
        F.col("c_mktsegment").alias("last"),
        F.when(F.col("c_nationkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.concat(F.lit("Street "), (F.col("c_custkey") % 100).cast("string")).alias("street"),
        F.col("n_name").alias("city"),
        F.col("n_regionkey").cast("string").alias("state"),
        F.col("c_nationkey").alias("zip"),
        F.col("c_mktsegment").alias("job"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("dob"),
        F.col("p_size").alias("merch_lat"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("merch_long"),
    )


def split_wide(wide: DataFrame) -> dict[str, DataFrame]:
    """Column subsets, each with full-row ``dropDuplicates`` (a
    partial aggregate per task before the shuffle, so duplicates never
    cross the network)."""
    return {"transaction": wide.select(*TRANS_COLS).dropDuplicates(),
            "client": wide.select(*CLIENT_COLS).dropDuplicates(),
            "merchant": wide.select(*MERCHANT_COLS).dropDuplicates()}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """CSV sink with a header line (one folder of part files per entity)."""
    df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"').csv(path)
