"""Helpers shared by the training-data operators.

* ``row_ids`` / ``stage_table``: stable row identities and lineage cuts in the
  shared folder of ``spark.checkpoint.dir``.
* ``words``: a numpy tokeniser over Arrow string buffers. It hashes every
  word of a batch without a Python loop over rows or words, in slices of a
  bounded number of bytes (cut at separators), so one very long text costs no
  more working memory than many short ones beyond its own word hashes.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riverbed.session import scratch_path

#: Text hashed at once; at 8 bytes a byte and a few arrays of these, with the
#: batches of ``batches_by_bytes`` what a Python worker holds beyond its rows.
SLICE_BYTES = 1 << 18


def spark_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def ship_package(spark: SparkSession) -> None:
    """Give executors this package when they can't import it by themselves:
    neither PYTHONPATH nor the working folder (which local workers search)
    leads to it. Files added this way are fetched by each executor."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep)]
    sc = spark.sparkContext
    if root in map(os.path.abspath, filter(None, paths)) or any(
            f.endswith("/riverbed-package.zip") for f in sc.listFiles):
        return
    base = os.path.join(tempfile.mkdtemp(prefix="riverbed-"), "riverbed-package")
    sc.addPyFile(shutil.make_archive(base, "zip", root, "riverbed"))


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh folder of the shared scratch space and read it
    back: later steps start from the files, whatever happens to executors."""
    spark = spark_of(df)
    path = scratch_path(spark, f"llm/{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(rid, doc_id, text): only the two columns an operator needs, NULL text
    as empty, and a row id that keeps repeated rows apart. The id is that of
    the scan (partition and row), so the input must be a table read from
    files, which yields the same rows in the same partitions each time."""
    return docs.select(F.monotonically_increasing_id().alias("rid"),
                       F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))


# -- numpy tokeniser ----------------------------------------------------------------
#: Separators of whitespace words, and of alphanumeric words (bytes from 0x80 on
#: belong to letters of UTF-8 text and count as word bytes).
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NON_ALNUM = np.zeros(256, bool)
NON_ALNUM[:0x80] = True
NON_ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240917)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MULT = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93
_BASE_INV = pow(_BASE, -1, 1 << 64)
_powers = {}


def _pow(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + 8192)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (all bits depend on all bits)."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column without NULLs, sharing its memory."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        kind = np.int32
    else:
        kind = np.int64
    bufs = column.buffers()
    n = len(column)
    offs = np.frombuffer(bufs[1], kind)[column.offset: column.offset + n + 1].astype(np.int64) \
        if n else np.zeros(1, np.int64)
    data = np.frombuffer(bufs[2], np.uint8)[offs[0]: offs[-1]] if n and bufs[2] is not None \
        else np.zeros(0, np.uint8)
    return data, offs - offs[0]


def _slices(data: np.ndarray, sep: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Cut points of at most about ``limit`` bytes, always at a separator."""
    at = 0
    while at < len(data):
        end = min(at + limit, len(data))
        while end < len(data):
            hit = np.flatnonzero(sep[data[end: end + 4096]])
            if len(hit):
                end += int(hit[0])
                break
            end = min(end + 4096, len(data))
        yield at, end
        at = end


def words(column: pa.Array, sep: np.ndarray = NON_ALNUM, lower: bool = True,
          spans: bool = False):
    """Hash the words of a string column.

    Returns (hashes uint64, counts per row int64[, starts, ends]): the hashes
    of all rows' words one after another; ``spans`` adds byte spans relative
    to the column's first byte. Words never cross rows."""
    data, offs = string_buffers(column)
    outside_of = sep[LOWER] if lower else sep
    value_of = np.where(outside_of, np.uint64(0), _BYTE[LOWER] if lower else _BYTE)
    hashes, starts_all, ends_all = [], [], []
    for a, b in _row_slices(data, offs, outside_of):
        part = data[a:b]
        inside = ~outside_of[part]
        starts, ends = inside.copy(), inside.copy()
        starts[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        lo, hi = np.searchsorted(offs, [a, b], "left")
        edge = offs[lo:hi] - a  # rows begin here: a word ends before, another starts
        edge = edge[edge < b - a]
        starts[edge] = inside[edge]
        edge = edge[edge > 0]
        ends[edge - 1] = inside[edge - 1]
        starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
        if not len(starts):
            continue
        # Sum of byte value x base**position, moved back to the word's start:
        # bytes between words count 0, so one reduceat serves all words.
        val = value_of[part]
        val *= _pow(_BASE, b - a)
        sums = np.add.reduceat(val, starts)
        sums *= _pow(_BASE_INV, b - a)[starts]
        hashes.append(mix(sums + (ends - starts).astype(np.uint64) * _MULT))
        starts_all.append(starts + a)
        ends_all.append(ends + a)
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    s = np.concatenate(starts_all) if hashes else np.zeros(0, np.int64)
    counts = np.diff(np.searchsorted(s, offs, "left")).astype(np.int64)
    if spans:
        e = np.concatenate(ends_all) if hashes else np.zeros(0, np.int64)
        return h, counts, s, e
    return h, counts


def _row_slices(data, offs, sep):
    """Slices that end at row boundaries where they can, else at separators."""
    at, n = 0, len(data)
    while at < n:
        k = int(np.searchsorted(offs, at + SLICE_BYTES, "right")) - 1
        end = int(offs[k])
        if end > at:
            yield at, end
            at = end
            continue
        row_end = int(offs[np.searchsorted(offs, at, "right")])
        for a, b in _slices(data[at:row_end], sep, SLICE_BYTES):
            yield at + a, at + b
        at = row_end


def shingles(h: np.ndarray, counts: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each row, in order, and their number
    per row. A row of 1 to k-1 words has one shingle of all its words; a row
    without words has none."""
    n = len(h)
    ends = np.cumsum(counts)
    acc = np.zeros(n, np.uint64)
    short = (counts < k) & (counts > 0)
    for j in range(k):
        term = mix(h * np.uint64(2 * j + 3) + np.uint64(j))
        if j == 0:
            acc += term
        else:
            acc[:-j] += term[j:]
        if j and short.any():  # rows of fewer words stop at their end
            at = (ends - counts)[short & (counts <= j)]
            ok = at + j < n
            acc[at[ok]] -= term[at[ok] + j]
    keep = np.ones(n, bool)
    for j in range(1, k):
        at = (ends - j)[counts > j]  # the last words of a row begin no full shingle
        keep[at[ends[counts > j] - j > (ends - counts)[counts > j]]] = False
    out = mix(acc[keep] + np.uint64(k))
    return out, np.where(counts >= k, counts - k + 1, (counts > 0).astype(np.int64))


def row_of(counts: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(counts)), counts)


def batches_by_bytes(batch: pa.RecordBatch, column: str, limit: int = 1 << 20):
    """Slices of an Arrow batch whose text holds about ``limit`` bytes."""
    _, offs = string_buffers(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        end = min(end, batch.num_rows)
        yield batch.slice(at, end - at)
        at = end
