"""Exact duplicates by deterministic block naming.

A text is cut into blocks of ``block_chars`` characters. Distinct blocks are
sorted and named with integers; then adjacent names are paired, the distinct
pairs are sorted and named in turn, and so on, until each document has one
name. Two documents of as many blocks have the same final name exactly when
their texts are identical: no digest decides anything.

At scale: block texts cross the network once, each distinct block at most once
per map task (partial aggregation), under a 128-bit address that only routes
them. ``min`` and ``max`` of the texts at an address show whether it holds more
than one text; blocks at such addresses are then named by their texts as well,
so colliding addresses cost time, not correctness. All other shuffles carry a
few integers per block. A block, pair or text that fills a third of the input
collapses in the partial aggregations; the joins back are plain equi-joins
whose hot keys adaptive execution splits. The number of rounds is the
logarithm of the longest text's number of blocks; each starts from a table
written to the shared folder.

Defined cases: NULL text counts as empty; empty texts are one group (no block,
name NULL); a NULL id sorts below all others; fully repeated rows form a group
like any other and exactly one row of it stays; an empty table gives an empty
result. Only the id and text columns are read, so others may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import stage_table, texts

BLOCK_CHARS = 4096


def block_address(block: Column) -> Column:
    """Where a block is named: 128 bits, for routing only."""
    return F.struct(F.xxhash64(block).alias("a"), F.xxhash64(F.lit(7), block).alias("b"))


def _named(distinct: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Integer names in the sort order of ``keys``: rows are range-partitioned
    and sorted, and a name is the partition and the place in it."""
    return (distinct.repartitionByRange(*[F.col(k).asc_nulls_first() for k in keys])
            .sortWithinPartitions(*[F.col(k).asc_nulls_first() for k in keys])
            .withColumn(name, F.monotonically_increasing_id()))


def text_names(rows: DataFrame, block_chars: int = BLOCK_CHARS, address=block_address) -> DataFrame:
    """(rid, n_blocks, name) of rows (rid, text); n_blocks and name identify
    the text."""
    blocks = F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % block_chars), F.lit(0))
    pieces = rows.select("rid", F.posexplode(blocks).alias("pos", "block"))
    pieces = pieces.withColumn("at", address(F.col("block")))
    at_address = stage_table(
        pieces.groupBy("at").agg(F.min("block").alias("lo"), F.max("block").alias("hi"))
        .select(F.col("at.a").alias("a"), F.col("at.b").alias("b"),
                (F.col("lo") != F.col("hi")).alias("shared")), "block-addresses")
    placed = pieces.select("rid", "pos", F.col("at.a").alias("a"), F.col("at.b").alias("b"), "block")
    shared = at_address.filter("shared").select("a", "b")
    clear = at_address.filter(~F.col("shared")).select("a", "b", F.lit(None).cast("string").alias("block"))
    if shared.isEmpty():
        names = _named(clear, ["a", "b"], "name").drop("block")
        occurrences = placed.drop("block").join(names, ["a", "b"])
    else:
        # Several texts at one address: their texts are part of the sort key.
        told = placed.join(shared.withColumn("told", F.lit(True)), ["a", "b"], "left").select(
            "rid", "pos", "a", "b", F.when(F.col("told"), F.col("block")).alias("block"))
        texts_there = told.filter("block IS NOT NULL").select("a", "b", "block").distinct()
        names = _named(clear.unionByName(texts_there), ["a", "b", "block"], "name")
        names = names.withColumnsRenamed({"a": "na", "b": "nb", "block": "nblock"})
        occurrences = told.join(names, (F.col("a") == F.col("na")) & (F.col("b") == F.col("nb"))
                                & F.col("block").eqNullSafe(F.col("nblock")))
    level = _paired(occurrences.select("rid", "pos", "name"))
    done = []
    while True:
        level = stage_table(level, "name-pairs")
        names = _named(level.select("l", "r").distinct(), ["l", "r"], "name")
        names = names.withColumnsRenamed({"l": "nl", "r": "nr"})
        # Written once: the finished texts, the test for others and the next
        # round read it, none names the pairs again.
        named = stage_table(level.join(names, (F.col("l") == F.col("nl")) & F.col("r").eqNullSafe(F.col("nr")))
                            .select("rid", "pos", "n", "last", "name"), "pair-names")
        done.append(named.filter("last AND pos = 0").select("rid", F.col("n").alias("n_blocks"), "name"))
        others = named.filter("NOT (last AND pos = 0)").select("rid", "pos", "name", "n")
        if others.isEmpty():
            break
        level = _paired(others, "n")
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def _paired(named: DataFrame, n: str | None = None) -> DataFrame:
    """(rid, pos, l, r, n, last): names at 2k and 2k+1 side by side. ``n`` is
    the document's number of blocks (known after the first round from the
    largest position), ``last`` marks its last pair."""
    from pyspark.sql import Window
    half = (F.col("pos") / 2).cast("int")
    pairs = (named.groupBy("rid", half.alias("pos"))
             .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("l"),
                  F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("r"),
                  *([F.first("n").alias("n")] if n else [])))
    own = Window.partitionBy("rid")  # the blocks of one text
    pairs = pairs.withColumn("top", F.max("pos").over(own))
    if not n:
        pairs = pairs.withColumn("n", F.sum(F.lit(1) + F.col("r").isNotNull().cast("int")).over(own))
    return pairs.select("rid", "pos", "l", "r", F.col("n").cast("bigint").alias("n"),
                        (F.col("pos") == F.col("top")).alias("last"))


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     block_chars: int = BLOCK_CHARS, address=block_address) -> DataFrame:
    """One row per input row: rid, doc_id, keep_id, group_size, kept and the
    text's SHA-256. Of equal texts the largest id stays (of repeated rows with
    that id, one). ``docs`` is a table read from files."""
    rows = texts(docs, id_col, text_col)
    names = text_names(rows.select("rid", "text"), block_chars, address)
    ids = rows.select("rid", "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))
    named = stage_table(ids.join(names, "rid", "left")
                        .select("rid", "doc_id", "text_sha256",
                                F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"),
                                F.coalesce("name", F.lit(0)).alias("name")), "document-names")
    groups = (named.groupBy("n_blocks", "name")
              .agg(F.max(F.struct("doc_id", "rid")).alias("top"), F.count(F.lit(1)).alias("group_size")))
    return (named.join(groups, ["n_blocks", "name"])
            .select("rid", "doc_id", F.col("top.doc_id").alias("keep_id"), "group_size",
                    (F.col("rid") == F.col("top.rid")).alias("kept"), "text_sha256"))


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, all columns as they were."""
    kept = exact_duplicates(docs).filter("kept").select(F.col("rid").alias("__kept_rid"))
    return (docs.withColumn("__rid", F.monotonically_increasing_id())
            .join(kept, F.col("__rid") == F.col("__kept_rid"), "left_semi").drop("__rid"))
