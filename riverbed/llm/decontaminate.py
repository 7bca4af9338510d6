"""Benchmark decontamination by SimHash over item-sized windows.

Every benchmark item is a multiset of five-word shingles weighted by the bytes
they cover, with a 64-bit SimHash. A document is read in windows of as many
shingles as some item has, at every start. Windows that could reach the
threshold are fingerprinted; a multi-index finds every item within Hamming
radius ``RADIUS``: fingerprints are cut into four 16-bit blocks, and two that
differ in at most 15 bits agree within 3 bits in at least one block, so
looking up each block among the items' blocks with up to 3 flipped bits misses
none. Candidates are verified by the exact weighted Jaccard similarity.

The radius is a guarantee about fingerprints, not about similarities: a match
near the threshold can lie outside it. For those alone there is a second way:
windows whose fingerprint is further than the radius from an item that the text
holds to a sufficient weight are verified as long as the weight they share
allows a better similarity. So none is lost; ``find_leaks`` says of each match
which way found it (``by_index``).

A window is skipped before fingerprinting only if it holds fewer benchmark
shingles than any item of its size needs to reach the threshold, which is a
bound, not a guess: shared weight is at most (shared shingles x the item's
heaviest shingle). That lets one pass without shuffle read the corpus.

The index of at most ``ITEMS_PER_SLICE`` items (and ``WORDS_PER_SLICE`` words)
goes to the tasks; a larger benchmark is split into slices by hash, each a
pass of its own whose matches are written before the next slice's index is
made, so the driver and what is sent hold one slice at a time.

Defined cases: NULL texts and items are empty and never match; an item of
fewer than five words is one shingle and matches only a text of just these
words; a text shorter than the item is one window; repeated items each
report; an item with a NULL id counts as any other and is reported as NULL,
unless an item with an id has the same text; repeated rows repeat results; empty tables give no matches. Only ids
and texts are read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import NON_ALNUM, batches_by_bytes, shingles, stage_table, texts, words

SHINGLE = 5
THRESHOLD = 0.8
BLOCK_BITS, BLOCK_RADIUS = 16, 3
RADIUS = 4 * (BLOCK_RADIUS + 1) - 1
ITEMS_PER_SLICE = 4096
WORDS_PER_SLICE = 2_000_000
_MASKS = np.array([sum(1 << i for i in c) for r in range(BLOCK_RADIUS + 1)
                   for c in combinations(range(BLOCK_BITS), r)], np.int64)


def weighted_shingles(column: pa.Array):
    """(hash, weight, shingles per row, words per row): a shingle weighs the
    bytes of its words."""
    h, counts, starts, ends = words(column, NON_ALNUM, spans=True)
    s, n = shingles(h, counts, SHINGLE)
    cum = np.concatenate([[0], np.cumsum(ends - starts)])
    first = np.repeat(np.cumsum(counts) - counts, n) + np.arange(len(s)) - np.repeat(np.cumsum(n) - n, n)
    size = np.repeat(np.minimum(counts, SHINGLE), n)
    return s, (cum[first + size] - cum[first]).astype(np.int64), n, counts


def _bits(s: np.ndarray) -> np.ndarray:
    """Bits of 64-bit hashes as +1 / -1, one row per hash."""
    b = np.unpackbits(s.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return b.astype(np.int32) * 2 - 1


def _pack(signs: np.ndarray) -> np.ndarray:
    return np.packbits(signs, axis=1, bitorder="little").view("<u8").ravel()


def simhash(s: np.ndarray, weight: np.ndarray) -> int:
    return int(_pack(((_bits(s) * weight[:, None]).sum(0) > 0)[None, :])[0])


def weighted_jaccard(a: tuple, b: tuple) -> float:
    """Of two multisets (hashes, weights per occurrence); exact."""
    ua, ia, na = np.unique(a[0], return_index=True, return_counts=True)
    ub, ib, nb = np.unique(b[0], return_index=True, return_counts=True)
    _, x, y = np.intersect1d(ua, ub, assume_unique=True, return_indices=True)
    shared = int((np.minimum(na[x], nb[y]) * a[1][ia[x]]).sum())
    union = int(a[1].sum()) + int(b[1].sum()) - shared
    return shared / union if union else 0.0


class ItemIndex:
    """Benchmark items ready for lookup."""

    def __init__(self, ids: list[int | None], item_texts: list[str], threshold: float = THRESHOLD):
        s, w, n, _ = weighted_shingles(pa.array(item_texts, pa.string()))
        cut = np.concatenate([[0], np.cumsum(n)])
        keep = np.flatnonzero(n > 0)
        self.threshold = threshold
        self.ids = [ids[i] for i in keep.tolist()]
        self.items = [(s[cut[i]: cut[i + 1]], w[cut[i]: cut[i + 1]]) for i in keep.tolist()]
        self.size = n[keep]
        self.prints = np.array([simhash(*x) for x in self.items], np.uint64)
        self.shingles = np.unique(s)
        self.total = np.array([int(x[1].sum()) for x in self.items], np.int64)
        # Items of each shingle, with the weight the shingle has in the item.
        place = np.searchsorted(self.shingles, s)
        pair, at = np.unique(place * max(len(n), 1) + np.repeat(np.cumsum(n > 0) - 1, n), return_inverse=True)
        self.sharing_weight = np.bincount(at.ravel(), w, len(pair)).astype(np.int64)
        self.sharing_item = pair % max(len(n), 1)
        self.sharing_cut = np.searchsorted(pair // max(len(n), 1), np.arange(len(self.shingles) + 1))
        self.need = {}  # fewest benchmark shingles in a window of each size
        for i, (_, wt) in enumerate(self.items):
            k = int(np.ceil(threshold * wt.sum() / wt.max() - 1e-9))
            m = int(self.size[i])
            self.need[m] = min(self.need.get(m, k), k)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.shingles >> np.uint64(44)).astype(np.int64)] = True
        self.blocks = []
        for b in range(4):
            key = ((self.prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            near = (key[:, None] ^ _MASKS[None, :]).ravel()
            item = np.repeat(np.arange(len(key)), len(_MASKS))
            order = np.argsort(near, kind="stable")
            self.blocks.append((np.searchsorted(near[order], np.arange((1 << 16) + 1)), item[order]))

    def hits(self, s: np.ndarray) -> np.ndarray:
        """Which shingles occur in the benchmark."""
        out = np.zeros(len(s), bool)
        at = np.flatnonzero(self.filter[(s >> np.uint64(44)).astype(np.int64)])
        if len(at) and len(self.shingles):
            lo = np.minimum(np.searchsorted(self.shingles, s[at]), len(self.shingles) - 1)
            out[at] = self.shingles[lo] == s[at]
        return out

    def sharing(self, s: np.ndarray) -> np.ndarray:
        """Items whose weight can be shared to the threshold by a text with
        these benchmark shingles; no other item reaches it in any window."""
        place = np.unique(np.searchsorted(self.shingles, s))
        n = self.sharing_cut[place + 1] - self.sharing_cut[place]
        at = np.repeat(self.sharing_cut[place], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        shared = np.bincount(self.sharing_item[at], self.sharing_weight[at], len(self.items))
        return np.flatnonzero(shared >= self.threshold * self.total * (1 - 1e-9))

    def lookup(self, prints: np.ndarray, sizes: np.ndarray):
        """(window, item, distance) for all items of the window's size within
        the radius."""
        win, item = [], []
        for b, (cut, items) in enumerate(self.blocks):
            key = ((prints >> np.uint64(16 * b)) & np.uint64(0xFFFF)).astype(np.int64)
            n = cut[key + 1] - cut[key]
            w = np.repeat(np.arange(len(prints)), n)
            i = items[np.repeat(cut[key], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            ok = self.size[i] == sizes[w]
            win.append(w[ok])
            item.append(i[ok])
        pair = np.unique(np.concatenate(win) * len(self.items) + np.concatenate(item))
        w, i = pair // len(self.items), pair % len(self.items)
        d = np.bitwise_count(prints[w] ^ self.prints[i])
        ok = d <= RADIUS
        return w[ok], i[ok], d[ok]


def match_row(s: np.ndarray, w: np.ndarray, hit: np.ndarray, index: ItemIndex) -> dict:
    """{item: (similarity, first shingle, shingles, by index)} of one text: the
    best window of each item that reaches the threshold."""
    n = len(s)
    cum = np.concatenate([[0], np.cumsum(hit)])
    starts, sizes, lens = [], [], []
    for m, need in index.need.items():
        if cum[-1] < need:
            continue
        k = min(m, n)
        at = np.flatnonzero(cum[k:] - cum[: n - k + 1] >= need)
        starts.append(at)
        sizes.append(np.full(len(at), m))
        lens.append(np.full(len(at), k))
    if not starts or not sum(map(len, starts)):
        return {}
    start, size, k = (np.concatenate(x) for x in (starts, sizes, lens))
    best: dict = {}
    fingerprint = np.zeros(len(start), np.uint64)
    lo, hi = int(start.min()), int((start + k).max())
    for a, b, pick in _spans(start, k, lo, hi):
        sums = np.zeros((b - a + 1, 64), np.int64)
        np.cumsum(_bits(s[a:b]) * w[a:b, None], axis=0, out=sums[1:])
        st, ln = start[pick], k[pick]
        for c in range(0, len(st), 20_000):
            x, y = st[c: c + 20_000], ln[c: c + 20_000]
            prints = fingerprint[pick[c: c + 20_000]] = _pack(sums[x + y - a] - sums[x - a] > 0)
            win, item, dist = index.lookup(prints, size[pick][c: c + 20_000])
            for o in np.argsort(dist, kind="stable").tolist():
                i, p, q = int(item[o]), int(x[win[o]]), int(y[win[o]])
                if i in best and best[i][0] >= 1.0:
                    continue
                sim = weighted_jaccard((s[p: p + q], w[p: p + q]), index.items[i])
                if sim >= index.threshold and sim > best.get(i, (0,))[0]:
                    best[i] = (sim, p, q, True)
    total = np.concatenate([[0], np.cumsum(w)])
    for i in index.sharing(s[hit]).tolist():
        far = np.bitwise_count(fingerprint ^ index.prints[i]) > RADIUS  # the index has seen the others
        own = np.flatnonzero((size == index.size[i]) & far)
        x, y = start[own], k[own]
        cum = np.concatenate([[0], np.cumsum(np.where(hit & np.isin(s, index.items[i][0]), w, 0))])
        shared = np.minimum(cum[x + y] - cum[x], index.total[i])
        most = shared / (total[x + y] - total[x] + index.total[i] - shared)
        for o in np.argsort(-most, kind="stable").tolist():
            if most[o] < index.threshold or most[o] <= best.get(i, (0,))[0]:
                break
            p, q = int(x[o]), int(y[o])
            sim = weighted_jaccard((s[p: p + q], w[p: p + q]), index.items[i])
            if sim >= index.threshold and sim > best.get(i, (0,))[0]:
                best[i] = (sim, p, q, False)
    return best


def row_matches(column: pa.Array, index: ItemIndex) -> list[dict]:
    """match_row of each text of a column; texts with too few benchmark
    shingles for any item are passed over."""
    s, w, n, _ = weighted_shingles(column)
    hit = index.hits(s)
    cut = np.concatenate([[0], np.cumsum(n)])
    hits = np.concatenate([[0], np.cumsum(hit)])[cut]
    least = min(index.need.values(), default=1)
    out: list[dict] = [{} for _ in range(len(n))]
    for r in np.flatnonzero(np.diff(hits) >= least).tolist():
        x = slice(int(cut[r]), int(cut[r + 1]))
        out[r] = match_row(s[x], w[x], hit[x], index)
    return out


def _spans(start, k, lo, hi, limit: int = 100_000):
    """Windows in groups whose text spans about ``limit`` shingles, so the
    prefix sums of a very long text are made piece by piece."""
    for a in range(lo, hi, limit):
        pick = np.flatnonzero((start >= a) & (start < a + limit))
        if len(pick):
            yield a, int((start[pick] + k[pick]).max()), pick


LISTS = ("item_ids", "similarity", "first_word", "n_words", "by_index")
SCHEMA = ("rid bigint, doc_id bigint, item_ids array<bigint>, similarity array<double>, "
          "first_word array<bigint>, n_words array<bigint>, by_index array<boolean>")


def _matches(rows: DataFrame, index: ItemIndex) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in batches_by_bytes(whole, "text"):
                yield one(b)

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        out = defaultdict(list)
        for got in row_matches(b.column("text"), index):
            order = sorted(got, key=lambda i: (index.ids[i] is None, index.ids[i] or 0))
            out["item_ids"].append([index.ids[i] for i in order])
            out["similarity"].append([float(got[i][0]) for i in order])
            out["first_word"].append([int(got[i][1]) for i in order])
            out["n_words"].append([int(got[i][2]) + SHINGLE - 1 for i in order])
            out["by_index"].append([bool(got[i][3]) for i in order])
        return pa.RecordBatch.from_arrays(
            [b.column("rid"), b.column("doc_id"), pa.array(out["item_ids"], pa.list_(pa.int64())),
             pa.array(out["similarity"], pa.list_(pa.float64())), pa.array(out["first_word"], pa.list_(pa.int64())),
             pa.array(out["n_words"], pa.list_(pa.int64())), pa.array(out["by_index"], pa.list_(pa.bool_()))],
            ["rid", "doc_id", *LISTS])

    return rows.mapInArrow(run, SCHEMA)


def _indexes(benchmark: DataFrame, threshold: float, items_per_slice: int) -> tuple[int, Iterator[ItemIndex]]:
    """The number of slices, and the benchmark's items slice by slice."""
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"),
                             F.coalesce("text", F.lit("")).alias("text"))
    count, size, named = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0)),
                                   F.count("item_id")).first()
    if named < count:
        known = items.filter("item_id IS NOT NULL")
        items = known.unionByName(items.filter("item_id IS NULL").join(known.select("text"), "text", "left_anti"))
    slices = max(1, -(-count // items_per_slice), -(-size // (5 * WORDS_PER_SLICE)))

    def one(k: int) -> ItemIndex:
        part = items if slices == 1 else items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == k)
        got = part.collect()  # one slice: bounded by its item and word limits
        return ItemIndex([r[0] for r in got], [r[1] for r in got], threshold)

    return slices, map(one, range(slices))


def find_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
               items_per_slice: int = ITEMS_PER_SLICE) -> DataFrame:
    """One row per document: rid, doc_id, contaminated, and the items found
    with their similarity, place (first word and number of words) and whether
    the fingerprint index found them."""
    rows = texts(docs)
    slices, indexes = _indexes(benchmark, threshold, items_per_slice)
    if slices == 1:
        out = _matches(rows, next(indexes))
    else:
        found = None
        for index in indexes:
            part = stage_table(_matches(rows, index).filter("size(item_ids) > 0").drop("doc_id"), "leaks")
            found = part if found is None else found.unionByName(part)
        per = found.groupBy("rid").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in LISTS])
        none = {c: F.coalesce(F.col(c), F.array().cast(t.dataType)) for c, t in
                ((f.name, f) for f in per.schema.fields if f.name in LISTS)}
        out = rows.select("rid", "doc_id").join(per, "rid", "left").withColumns(none)
    return out.select("rid", "doc_id", (F.size("item_ids") > 0).alias("contaminated"), *LISTS)


def _leaks(index: ItemIndex):
    @F.arrow_udf("boolean")
    def leaks(text: pa.Array) -> pa.Array:
        b = pa.RecordBatch.from_arrays([text], ["text"])
        return pa.array([x for part in batches_by_bytes(b, "text") for x in map(bool, row_matches(part.column(0), index))],
                        pa.bool_())
    return leaks


def drop_leaks(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD,
               items_per_slice: int = ITEMS_PER_SLICE) -> DataFrame:
    """The rows of ``docs`` without a benchmark passage, all columns as they
    were; for a benchmark of one slice a column function, so nothing is
    shuffled, else the rows that some slice matched are taken away."""
    slices, indexes = _indexes(benchmark, threshold, items_per_slice)
    if slices == 1:
        return docs.filter(~_leaks(next(indexes))(F.coalesce(F.col("text"), F.lit(""))))
    rows, found = texts(docs), None
    for index in indexes:
        part = stage_table(_matches(rows, index).filter("size(item_ids) > 0").select("rid"), "leaks")
        found = part if found is None else found.unionByName(part)
    return (docs.withColumn("__rid", F.monotonically_increasing_id())
            .join(found.withColumnRenamed("rid", "__leak"), F.col("__rid") == F.col("__leak"), "left_anti").drop("__rid"))
