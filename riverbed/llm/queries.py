"""Registered queries of the training-data operators, and their DuckDB SQL.

Each query applies its operator, with production parameters, to the whole
table; ``ORACLE_SQL`` holds the statement where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.llm.common import ship_package

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    REGISTRY[fn.__name__] = fn
    return fn


def table(spark, sf, name):
    ship_package(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op2_warc_salvage(spark, sf):
    """Pages written as WARC records and read back by the salvage reader."""
    from riverbed.llm.warc import archive_pages
    return archive_pages(table(spark, sf, "pages"))


#: Bare base32 of a SHA-1: five hex digits make four characters.
ORACLE_SQL["op2_warc_salvage"] = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS hex,
             max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(((CAST('0x' || substr(hex, CAST((i // 4) * 5 + 1 AS INTEGER), 5) AS BIGINT)
               >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31) + 1 AS INTEGER), 1)), '') AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM h
"""


@query
def op8_exact_dedup(spark, sf):
    """Exact duplicates by deterministic block naming."""
    from riverbed.llm.exact_dedup import exact_duplicates
    return exact_duplicates(table(spark, sf, "documents")).drop("rid")


ORACLE_SQL["op8_exact_dedup"] = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


@query
def op10_pii(spark, sf):
    """Personal data by weak supervision, DataFrame functions only."""
    from riverbed.llm.pii import pii_report
    return pii_report(table(spark, sf, "documents"))


@query
def op4_license_scan(spark, sf):
    """License labels by a positional rare-token index."""
    from riverbed.llm.license_scan import scan_licenses
    return scan_licenses(table(spark, sf, "documents"))


@query
def op7_decontaminate(spark, sf):
    """Benchmark passages by SimHash over item-sized windows."""
    from riverbed.llm.decontaminate import find_leaks
    return (find_leaks(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
            .select("doc_id", "contaminated", "item_ids", F.array_max("similarity").alias("similarity"),
                    "first_word", "n_words", "by_index"))


@query
def op9_mixing(spark, sf):
    """Temperature mix of the sources: one row per drawn document and pass."""
    from riverbed.llm.mixing import draw
    return draw(table(spark, sf, "documents")).drop("rid")


@query
def op3_jaccard_join(spark, sf):
    """Near duplicates at 0.8 over five-word shingles, pruned by posterior."""
    from riverbed.llm.near_join import similar_texts
    return similar_texts(table(spark, sf, "documents")).drop("rid")


@query
def op1_lm_score(spark, sf):
    """Texts scored by deleted interpolation of bigrams and unigrams."""
    from riverbed.llm.lm_score import score_documents
    return score_documents(table(spark, sf, "documents"))


@query
def op5_language_id(spark, sf):
    """Languages by a byte convolutional network."""
    from riverbed.llm.language_id import identify
    return identify(table(spark, sf, "documents"))


@query
def op6_quality(spark, sf):
    """Quality by co-training a text and a metadata view."""
    from riverbed.llm.quality import score_quality
    return score_quality(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op11_periodic_runs(spark, sf):
    """Maximal word runs by suffix-tree extensions; every tenth document's tail
    is made to repeat first."""
    from riverbed.llm.periodic_runs import loop_tails, periodic_runs
    found = periodic_runs(table(spark, sf, "documents"), rewrite=loop_tails)
    # Exact comparison of length / period by cross products; runs are in order of start and period.
    best = F.expr("""aggregate(runs, CAST(NULL AS struct<start:bigint,length:bigint,period:bigint>),
        (a, r) -> CASE WHEN a IS NULL OR r.length * a.period > a.length * r.period THEN r ELSE a END)""")
    listed = F.expr("""concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')))""")
    return (found.withColumn("best", best)
            .select("doc_id", F.size("runs").cast("bigint").alias("n_runs"), F.col("best.start").alias("start"),
                    F.col("best.length").alias("length"), F.col("best.period").alias("period"),
                    F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                    F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
                    F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))


@query
def op12_suffix_dedup(spark, sf):
    """Repeated 200-byte strings removed by a hash-compared suffix sort."""
    from riverbed.llm.suffix_dedup import remove_repeats
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return (remove_repeats(table(spark, sf, "documents"))
            .select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"),
                    F.sha2("kept", 256).alias("kept_sha256")))


@query
def op13_whitening(spark, sf):
    """Embeddings whitened along four Jacobi-Davidson components."""
    from riverbed.llm.whitening import whiten
    return whiten(table(spark, sf, "embeddings"))
