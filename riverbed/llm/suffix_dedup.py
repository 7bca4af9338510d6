"""Repeated byte strings removed, by a hash-compared suffix sort.

A byte goes when a string of ``length`` bytes that covers it starts anywhere
else too, in any document. Strings ("windows") never cross documents.

*Meeting.* Each window has one anchor: the least k-byte gram in it by hash (the
leftmost of equals). The anchor follows from the window's bytes alone, so equal
windows have equal anchors at equal offsets. The windows of one anchor are
neighbours; the bytes they cover are a segment. Segments that share a gram with
no other segment hold no repeated window. Where all segments of a gram are the
same (prefix polynomial hashes of 64 bits, besides the gram's), all their
windows are repeated, and the same holds for segments that occur twice among
different ones. What is left, a passage's rims, is sorted.

*Sorting.* Of each different segment of a gram one copy is cut from its text.
A task lays the segments of its grams end to end, with prefix polynomial
hashes. The windows of a gram with equal offsets are suffixes to be sorted: a
bottom-up mergesort in which all merges of a level go on in lockstep, and a
comparison finds the common extension of two suffixes by binary search over
hashed prefixes, then compares the byte after it. Neighbours in the order whose
common extension is a whole window are verified byte by byte; where a hash
collision is found, the windows of that gram are told apart by their bytes.

*Scale.* Texts cross the network twice (to cut segments, and to take the
removed spans away), and three integers per anchor once (about 60 bytes of
text), a gram's count after partial aggregation. A common passage costs a row
per map task in the counts; the joins back are equi-joins whose hot keys
adaptive execution splits. A gram with more than ``GROUP`` different segments
is never one task's: its windows are counted by two 64-bit hashes instead,
with partial aggregation, and joined back. Texts are read in blocks of
``BLOCK`` windows.

Defined cases: NULL and empty texts have no byte and no span; texts shorter
than ``length`` lose nothing; windows that repeat or overlap inside one text
count as repeats; repeated rows are documents of their own; NULL ids stay NULL;
an empty table gives an empty result. Only the id and text columns are read, so
others may have any name. ``docs`` is a table read from files.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import batches_by_bytes, mix, stage_table, string_buffers, texts

LENGTH = 200
BLOCK = 1 << 18        # window starts of a text that are looked at together
GROUP = 1000           # different segments of a gram that one task sorts
CHUNK = 1 << 20        # segment bytes that are sorted together

_rng = np.random.default_rng(20251212)
_VALUE = _rng.integers(1, 1 << 63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = (0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_power: dict[tuple[int, bool], np.ndarray] = {}


def powers(which: int, n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, or those of its inverse."""
    have = _power.get((which, inverse))
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 19), pow(_BASE[which], -1, 1 << 64) if inverse else _BASE[which], np.uint64)
        have[0] = 1
        have = _power[which, inverse] = np.cumprod(have, dtype=np.uint64)
    return have[:n]


def prefix_hashes(data: np.ndarray, which: int = 0) -> np.ndarray:
    """Sums of byte value x base**place over each prefix: a substring's hash is
    the difference of two, times base**-start."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[which][data] * powers(which, len(data)), out=out[1:])
    return out


def gram_size(length: int) -> int:
    return max(1, length * 8 // 25)


def _least_in(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    step = 1
    while 2 * step <= width:
        a = np.minimum(a[:-step], a[step:])
        step *= 2
    rest = width - step
    return np.minimum(a[:-rest], a[rest:]) if rest else a


def anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(first window, windows, anchor's offset in the first, gram hash, segment
    hash) of a text's anchors, in order."""
    k, out = gram_size(length), []
    for a in range(0, len(data) - length + 1, BLOCK):
        part = data[a: a + BLOCK + length - 1]
        h, back = prefix_hashes(part), powers(0, len(part) + 1, inverse=True)
        gram = mix((h[k:] - h[:-k]) * back[: len(part) - k + 1])
        places = np.uint64((1 << 20) - 1)
        key = (gram & ~places) | np.arange(len(gram), dtype=np.uint64)
        at = (_least_in(key, length - k + 1) & places).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        n = np.diff(np.r_[first, len(at)])
        at = at[first]
        h2, back2 = prefix_hashes(part, 1), powers(1, len(part) + 1, inverse=True)
        end = first + n - 1 + length
        segment = mix((h2[end] - h2[first]) * back2[first]
                      + (at - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                      + n.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
        out.append((first + a, n, at - first, gram[at], segment))
    if not out:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _different(gram: np.ndarray, segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First place of each different (gram, segment) and its count."""
    order = np.lexsort((segment, gram))
    g, s = gram[order], segment[order]
    fresh = np.r_[True, (g[1:] != g[:-1]) | (s[1:] != s[:-1])][:len(g)]
    return order[fresh], np.diff(np.r_[np.flatnonzero(fresh), len(g)])


def _pack(start, n, offset, twice):
    """One long: 37 bits of start, 13 of windows and of offset, 1 flag."""
    return (start << 27) | (n << 14) | (offset << 1) | twice


def _unpack(p):
    return p >> 27, (p >> 14) & 8191, (p >> 1) & 8191, p & 1


def _rows(column: pa.Array) -> Iterator[np.ndarray]:
    data, offs = string_buffers(column)
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        yield data[a:b]


def _anchor_rows(rows: DataFrame, length: int) -> DataFrame:
    """One row per text and different segment: gram, segment, rid, place (its
    first occurrence, and whether there are more in this text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in batches_by_bytes(whole, "text"):
                out = []
                for rid, data in zip(b.column("rid").to_pylist(), _rows(b.column("text")), strict=True):
                    start, n, offset, gram, segment = anchors(data, length)
                    if len(start):
                        i, count = _different(gram, segment)
                        out.append((gram[i].view(np.int64), segment[i].view(np.int64), np.full(len(i), rid),
                                    _pack(start[i], n[i], offset[i], (count > 1).astype(np.int64))))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)],
                                                     ["gram", "segment", "rid", "place"])
    return rows.select("rid", "text").mapInArrow(run, "gram bigint, segment bigint, rid bigint, place bigint")


# -- the suffix sort ------------------------------------------------------------
class Suffixes:
    """Windows of bytes laid end to end, compared by their common extension."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        self.hashes, self.power = prefix_hashes(data), powers(0, len(data) + 1)

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Longest common extension, up to a window, by binary search."""
        h, p = self.hashes, self.power
        hx, hy, px, py = h[x], h[y], p[x], p[y]
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.length, np.int64)
        for _ in range(self.length.bit_length()):
            mid = (low + high + 1) >> 1
            same = (h[x + mid] - hx) * py == (h[y + mid] - hy) * px
            low = np.where(same, mid, low)
            high = np.where(same, high, mid - 1)
        return low

    def below(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """x < y as strings of ``length`` bytes."""
        n = self.common(x, y)
        whole = n == self.length
        n = np.minimum(n, self.length - 1)
        return ~whole & (self.data[x + n] < self.data[y + n])

    def sort(self, at: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Mergesort inside groups of neighbours: ``at`` holds suffixes, group
        by group; ``first`` and ``size`` give each element's group. A level
        merges all pairs of runs at once: an element moves by the number of
        elements of the other run before it, found by binary search."""
        at, i = at.copy(), np.arange(len(at)) - first
        width = 1
        while True:
            live = np.flatnonzero(size > width)
            if not len(live):
                return at
            own, start, end = i[live], first[live], first[live] + size[live]
            pair = own // (2 * width) * (2 * width)
            is_left = own - pair < width
            low = np.minimum(start + pair + np.where(is_left, width, 0), end)
            other = low
            high = np.minimum(low + width, end)
            mine = at[live]
            todo = np.flatnonzero(low < high)
            low, high = low.copy(), high.copy()
            while len(todo):
                mid = (low[todo] + high[todo]) >> 1
                x, y, left = at[mid], mine[todo], is_left[todo]
                # Elements of the left run go before equal ones of the right run.
                swap = self.below(np.where(left, x, y), np.where(left, y, x))
                before = np.where(left, swap, ~swap)
                low[todo] = np.where(before, mid + 1, low[todo])
                high[todo] = np.where(before, high[todo], mid)
                todo = todo[low[todo] < high[todo]]
            run = own - pair - np.where(is_left, 0, width)
            moved = at.copy()
            moved[start + pair + run + low - other] = mine
            at = moved
            width *= 2

    def equal(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether windows are the same, byte by byte."""
        out, span = np.ones(len(x), bool), np.arange(self.length)
        for a in range(0, len(x), 1 << 14):
            b = slice(a, a + (1 << 14))
            out[b] = (self.data[x[b, None] + span] == self.data[y[b, None] + span]).all(1)
        return out


def repeated_windows(suffixes: Suffixes, at: np.ndarray, group: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """For each window (start, group, offset) whether another of its group and
    offset has the same bytes."""
    out = np.zeros(len(at), bool)
    if not len(at):
        return out
    order = np.lexsort((offset, group))
    g, o = group[order], offset[order]
    fresh = np.r_[True, (g[1:] != g[:-1]) | (o[1:] != o[:-1])]
    begin = np.flatnonzero(fresh)
    which = np.cumsum(fresh) - 1
    first, size = begin[which], np.diff(np.r_[begin, len(at)])[which]
    # Sorting needs the windows' starts; their numbers follow from them.
    number = np.full(len(suffixes.data), -1, np.int64)
    number[at] = np.arange(len(at))
    got = suffixes.sort(at[order], first, size)
    pair = np.flatnonzero(which[1:] == which[:-1])
    x, y = got[pair], got[pair + 1]
    pair = suffixes.common(x, y) == suffixes.length
    x, y, w = x[pair], y[pair], which[:-1][which[1:] == which[:-1]][pair]
    same = suffixes.equal(x, y)
    for bad in np.unique(w[~same]).tolist():  # a hash collision: tell this group's windows apart by their bytes
        seen: dict[bytes, list[int]] = {}
        for s in got[which == bad].tolist():
            seen.setdefault(suffixes.data[s: s + suffixes.length].tobytes(), []).append(s)
        twice = [s for found in seen.values() if len(found) > 1 for s in found]
        out[number[np.array(twice, np.int64)]] = True
        same[w == bad] = False
    out[number[x[same]]] = True
    out[number[y[same]]] = True
    return out


def _windows(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(segment, place in it) of the windows of segments that have n each."""
    seg = np.repeat(np.arange(len(n)), n)
    return seg, np.arange(len(seg)) - (np.cumsum(n) - n)[seg]


def _spans(seg: np.ndarray, j: np.ndarray, hit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, first, last) of the stretches of windows that are hit."""
    at = np.flatnonzero(hit)
    cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(seg[at]) > 0)) + 1 if len(at) else np.zeros(0, np.int64)
    lo = at[np.r_[0, cut]] if len(at) else at
    hi = at[np.r_[cut - 1, len(at) - 1]] if len(at) else at
    return seg[lo], j[lo], j[hi]


SPAN = "rid bigint, start bigint, end bigint"


def _sorted_spans(pieces: DataFrame, length: int) -> DataFrame:
    """Spans of the repeated windows of the asked segments, gram by gram."""
    def sort(t: pa.Table) -> pa.RecordBatch:
        t = t.combine_chunks()
        gram, place = t["gram"].to_numpy(), t["place"].to_numpy()
        start, n, offset, _ = _unpack(place)
        data, offs = string_buffers(t["bytes"])
        seg, j = _windows(n)
        group = np.cumsum(np.r_[0, gram[1:] != gram[:-1]])[seg]
        hit = repeated_windows(Suffixes(data, length), offs[:-1][seg] + j, group, offset[seg] - j)
        hit &= t["asked"].to_numpy()[seg]
        s, lo, hi = _spans(seg, j, hit)
        return pa.RecordBatch.from_arrays(
            [pa.array(t["rid"].to_numpy()[s]), pa.array(start[s] + lo), pa.array(start[s] + hi + length)],
            ["rid", "start", "end"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            held = t if held is None else pa.concat_tables([held, t])
            while held.num_rows and held["bytes"].nbytes > CHUNK:
                # Whole grams only: the last one may go on in the next batch.
                gram = held["gram"].to_numpy()
                ends = np.flatnonzero(gram[1:] != gram[:-1]) + 1
                if not len(ends):
                    break
                size = pa.compute.binary_length(held["bytes"]).to_numpy().cumsum()
                full = ends[np.searchsorted(size[ends - 1], CHUNK)] if size[ends[-1] - 1] > CHUNK else ends[-1]
                yield sort(held.slice(0, int(full)))
                held = held.slice(int(full))
        if held is not None and held.num_rows:
            yield sort(held)

    return (pieces.repartition(F.col("gram")).sortWithinPartitions("gram").mapInArrow(run, SPAN))


def _counted_spans(pieces: DataFrame, length: int) -> DataFrame:
    """The same for grams of very many segments: windows counted by hashes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            start, n, offset, _ = _unpack(b.column("place").to_numpy())
            data, offs = string_buffers(b.column("bytes"))
            seg, j = _windows(n)
            at = offs[:-1][seg] + j
            keys = []
            for which in (0, 1):
                h, back = prefix_hashes(data, which), powers(which, len(data) + 1, inverse=True)
                keys.append(mix((h[at + length] - h[at]) * back[at] + (offset[seg] - j).astype(np.uint64)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [*map(pa.array, keys), b.column("rid").take(pa.array(seg)), pa.array(start[seg] + j),
                 b.column("asked").take(pa.array(seg))], ["a", "b", "rid", "start", "asked"])

    found = pieces.mapInArrow(run, "a bigint, b bigint, rid bigint, start bigint, asked boolean")
    twice = found.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "b")
    return (found.filter("asked").join(twice, ["a", "b"])
            .select("rid", "start", (F.col("start") + length).alias("end")))


def _pieces(rows: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of the wanted segments (rid, place, gram, asked, hot)."""
    lists = wanted.groupBy("rid").agg(F.collect_list(F.struct("place", "gram", "asked", "hot")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists, flat = b.column("wanted"), b.column("wanted").flatten()
            row = np.repeat(np.arange(len(lists)), pa.compute.list_value_length(lists).to_numpy())
            place = flat.field("place")
            start, n, _, _ = _unpack(place.to_numpy())
            data, offs = string_buffers(b.column("text"))
            lo = offs[:-1][row] + start
            cut = [data[x:y].tobytes() for x, y in zip(lo.tolist(), (lo + n - 1 + length).tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("rid").take(pa.array(row)), place, flat.field("gram"), flat.field("asked"),
                 flat.field("hot"), pa.array(cut, pa.binary())],
                ["rid", "place", "gram", "asked", "hot", "bytes"])

    return (rows.select("rid", "text").join(lists, "rid").select("rid", "text", "wanted")
            .mapInArrow(run, "rid bigint, place bigint, gram bigint, asked boolean, hot boolean, bytes binary"))


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _cut(data: np.ndarray, spans: np.ndarray, again: bool, length: int) -> tuple[list, bytes]:
    """Merged spans and the bytes outside them. ``again``: segments occur more
    than once in this text, and only their first occurrence is listed."""
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, spans[:, 0], 1)
    np.add.at(edge, spans[:, 1], -1)
    if again:
        start, n, _, gram, segment = anchors(data, length)
        order = np.lexsort((segment, gram))
        same = (gram[order[1:]] == gram[order[:-1]]) & (segment[order[1:]] == segment[order[:-1]])
        at = np.unique(np.r_[order[1:][same], order[:-1][same]])
        np.add.at(edge, start[at], 1)
        np.add.at(edge, (start + n - 1 + length)[at], -1)
    gone = np.cumsum(edge[:-1]) > 0
    turn = np.flatnonzero(np.diff(np.r_[False, gone, False]))
    return [{"start": a, "end": b} for a, b in turn.reshape(-1, 2).tolist()], data[~gone].tobytes()


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   group: int = GROUP) -> DataFrame:
    """One row per input row: rid, doc_id, n_bytes, ``spans`` (start and end of
    the removed stretches, in bytes) and ``kept``, the bytes that are left."""
    if not 2 <= length <= 4096:
        raise ValueError("windows of 2 to 4096 bytes")
    rows = texts(docs, id_col, text_col)
    found = _anchor_rows(rows, length)
    twice = F.col("place").bitwiseAND(1)
    grams = (found.groupBy("gram")
             .agg(F.sum(1 + twice).alias("n"), F.min("segment").alias("lo"), F.max("segment").alias("hi"))
             .filter("n > 1").select("gram", (F.col("lo") != F.col("hi")).alias("mixed")))
    shared = stage_table(found.join(grams, "gram"), "shared-segments")
    mixed = shared.filter("mixed")
    classes = (mixed.groupBy("gram", "segment")
               .agg(F.sum(1 + twice).alias("n"), F.min("rid").alias("one")))
    sizes = classes.groupBy("gram").agg((F.count(F.lit(1)) > group).alias("hot"))
    told = stage_table(
        mixed.join(classes.join(sizes, "gram"), ["gram", "segment"])
        .select("rid", "place", "gram", (F.col("n") == 1).alias("asked"), (F.col("rid") == F.col("one")).alias("one"),
                "hot"), "told-segments")
    pieces = stage_table(_pieces(rows, told.filter("one").drop("one"), length), "segments")
    spans = _sorted_spans(pieces.filter("NOT hot"), length)
    if not pieces.filter("hot").isEmpty():
        spans = spans.unionByName(_counted_spans(pieces.filter("hot"), length))
    whole = (shared.filter("NOT mixed").select("rid", "place")
             .unionByName(told.filter("NOT asked").select("rid", "place")))
    start, n = F.shiftright("place", 27), F.shiftright("place", 14).bitwiseAND(8191)
    spans = (whole.select("rid", start.alias("start"), (start + n - 1 + length).alias("end"), twice.alias("twice"))
             .unionByName(spans.withColumn("twice", F.lit(0).cast("bigint"))))
    spans = spans.groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("spans"),
                                     (F.max("twice") > 0).alias("again"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for b in batches_by_bytes(whole_batch, "text"):
                cuts, kept, n = [], [], []
                lists = b.column("spans")
                for data, found_, again in zip(_rows(b.column("text")), lists, b.column("again").to_pylist(),
                                               strict=True):
                    n.append(len(data))
                    if not found_.is_valid:
                        cuts.append([])
                        kept.append(data.tobytes())
                        continue
                    own = found_.values
                    own = np.stack([own.field("start").to_numpy(), own.field("end").to_numpy()], 1)
                    c, k = _cut(data, own, bool(again), length)
                    cuts.append(c)
                    kept.append(k)
                yield pa.RecordBatch.from_arrays(
                    [b.column("rid"), b.column("doc_id"), pa.array(n, pa.int64()), pa.array(cuts, SPANS),
                     pa.array(kept, pa.binary())], ["rid", "doc_id", "n_bytes", "spans", "kept"])

    return (rows.join(spans, "rid", "left").select("rid", "doc_id", "text", "spans", "again")
            .mapInArrow(run, "rid bigint, doc_id bigint, n_bytes bigint, "
                             "spans array<struct<start:bigint,end:bigint>>, kept binary"))
