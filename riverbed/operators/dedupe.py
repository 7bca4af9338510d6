"""Latest row per key.

``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY ...) = 1``. Spark plans the
``rank = 1`` filter as a partial ``WindowGroupLimit`` before the shuffle and
a final one after it, so each map task ships at most one row per key: a hot
key costs one row per task in the exchange, not all of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Lineage columns written on every landed row (file, row in file, load time).
LINEAGE = ("meta_filename", "meta_file_row_number", "meta_load_ts")


def _order_cols(order: Sequence[Column | str]) -> list[Column]:
    out = []
    for o in order:
        if isinstance(o, str):
            name, _, direction = o.strip().partition(" ")
            c = F.col(name)
            o = c.asc_nulls_first() if direction.lower() == "asc" else c.desc_nulls_first()
        out.append(o)
    return out


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str],
                   rank_col: str = "_rn") -> DataFrame:
    """Keep the first row per ``keys`` under ``order``.

    ``order`` items are Columns or ``"col desc"`` / ``"col asc"`` strings; a
    bare name means DESC. DESC puts NULLs first, as the reference platform
    does. Add a unique tie-break (for example the file name) as the last item
    so that the kept row is deterministic."""
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    return (df.withColumn(rank_col, F.row_number().over(w))
              .filter(F.col(rank_col) == 1)
              .drop(rank_col))


def latest_keep_null_keys(df: DataFrame, keys: Sequence[str],
                          order: Sequence[Column | str] = ("meta_load_ts desc", "meta_file_row_number desc",
                                                           "meta_filename desc")) -> DataFrame:
    """Latest row per key; rows with a NULL key are no duplicates of each other
    and all stay."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    own = F.when(null_key, F.monotonically_increasing_id())
    return latest_per_key(df.withColumn("_nk", own), [*keys, "_nk"], order).drop("_nk")


def latest_by_load(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """W1 with the reference's ordering: newest load, then highest row in the
    file, then (own rule for exact ties) the greatest file name."""
    return latest_per_key(df, keys, ["meta_load_ts desc", "meta_file_row_number desc",
                                     "meta_filename desc"])
