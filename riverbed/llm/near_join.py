"""N-gram Jaccard self-join with Bayesian candidate pruning.

1. Every text becomes its set of five-word shingles, 80 MinHash values and a
   128-bit digest of the set. Texts with equal sets form one class; only one
   row of each class goes on, so thousands of copies cost what one does.
2. Twenty bands of four values address buckets. A pair at the threshold meets
   in no bucket with probability (1 - 0.8**4)**20, under 3 in 100 000; more
   similar pairs far less. Buckets of one class end here.
3. Within a bucket, pairs are compared 16 MinHash values at a time. After each
   step a pair is dropped when the posterior probability (uniform prior) that
   its similarity reaches the threshold is below ``TOLERANCE``. A pair belongs
   to the first band in which it meets, so it is looked at once.
4. Members with a pair left get their shingle sets and are grouped again; the
   surviving pairs are verified exactly. Tasks return one row per member (its
   links and the smallest member it is linked to), never a row per pair.
5. Groups are the connected components of the verified links.

At scale: buckets over ``BLOCK`` classes are cut into blocks by hash and each
pair of blocks is a task's work, so a bucket with a third of all classes is
spread and none is capped. Texts are shuffled once, and only beside the list
of members to verify. Every table between steps is written to the shared
folder.

Defined cases: NULL text is empty; texts without words form one class without
other links; a text of one to four words has one shingle, all its words; a
NULL id sorts last as representative; repeated rows are copies of each other;
an empty table gives an empty result. Only id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import NON_ALNUM, batches_by_bytes, shingles, stage_table, texts, words

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 20, 4
LANES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-6
BLOCK = 512
_rng = np.random.default_rng(5)
_A = _rng.integers(1, 1 << 62, LANES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(1, 1 << 62, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, number per row): the sorted distinct shingles of each row."""
    s, n = shingles(*words(column, NON_ALNUM), SHINGLE)
    cut = np.concatenate([[0], np.cumsum(n)])
    sets = [np.unique(s[cut[i]: cut[i + 1]]) for i in range(len(n))]
    return (np.concatenate(sets) if sets else s), np.array([len(x) for x in sets], np.int64)


def minhash(s: np.ndarray, n: np.ndarray) -> np.ndarray:
    """LANES values per row (zeros for an empty set)."""
    out = np.zeros((len(n), LANES), np.uint32)
    full = n > 0
    if full.any():
        at = (np.cumsum(n) - n)[full]
        for k in range(LANES):
            out[full, k] = np.minimum.reduceat(s * _A[k], at).astype(np.uint32)
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    """One 64-bit bucket address per row and band."""
    parts = sig.reshape(-1, BANDS, ROWS).astype(np.uint64) + np.uint64(1)
    key = (parts * _B).sum(2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64) * _A[0]
    key ^= key >> np.uint64(29)
    key *= _A[1]
    return (key ^ (key >> np.uint64(32))).view(np.int64)


@cache
def least_matches(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For 16, 32, ... compared values: the fewest equal ones with which
    P(similarity >= threshold) is still ``tolerance`` or more. The posterior
    of m equal among n is Beta(m+1, n-m+1); its tail is a binomial sum."""
    from math import comb
    out = []
    for n in range(STEP, LANES + 1, STEP):
        need = n
        for m in range(n + 1):
            # P(Beta(m+1, n-m+1) >= t) = P(Binomial(n+1, t) <= m)
            tail = sum(comb(n + 1, k) * threshold ** k * (1 - threshold) ** (n + 1 - k) for k in range(m + 1))
            if tail >= tolerance:
                need = m
                break
        out.append(need)
    return tuple(out)


def _sketches(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in batches_by_bytes(whole, "text"):
                s, n = shingle_sets(b.column("text"))
                sums = np.zeros((len(n), 2), np.uint64)
                full = n > 0
                if full.any():
                    at = (np.cumsum(n) - n)[full]
                    sums[full, 0] = np.add.reduceat(s, at)
                    sums[full, 1] = np.add.reduceat((s ^ (s >> np.uint64(23))) * _A[2], at)
                sig = minhash(s, n)
                k = sums.view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("rid"), b.column("doc_id"), pa.array(n), pa.array(np.ascontiguousarray(k[:, 0])),
                     pa.array(np.ascontiguousarray(k[:, 1])), _blobs(sig)],
                    ["rid", "doc_id", "n", "k1", "k2", "sig"])

    return rows.mapInArrow(run, "rid bigint, doc_id bigint, n bigint, k1 bigint, k2 bigint, sig binary")


def _blobs(sig: np.ndarray) -> pa.Array:
    width = sig.shape[1] * 4
    offs = pa.py_buffer(np.arange(len(sig) + 1, dtype=np.int32) * width)
    return pa.Array.from_buffers(pa.binary(), len(sig), [None, offs, pa.py_buffer(np.ascontiguousarray(sig))])


def _signatures(column: pa.Array) -> np.ndarray:
    offs = np.frombuffer(column.buffers()[1], np.int32)[column.offset: column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[offs[0]: offs[-1]].view(np.uint32).reshape(-1, LANES) \
        if len(column) else np.zeros((0, LANES), np.uint32)


def _band_rows(reps: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                keys = band_keys(_signatures(part.column(1)))
                rid = np.repeat(part.column(0).to_numpy(), BANDS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.tile(np.arange(BANDS, dtype=np.int32), len(keys))), pa.array(keys.ravel()),
                     pa.array(rid)], ["band", "key", "rid"])
    return reps.select("rid", "sig").mapInArrow(run, "band int, key bigint, rid bigint")


GROUP = ["band", "key", "lo", "hi"]


def _whole_groups(batches: Iterator[pa.RecordBatch], limit: int = 16 << 20) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by GROUP."""
    held: list[pa.RecordBatch] = []
    size = 0
    for b in batches:
        for at in range(0, b.num_rows, 1000):
            part = b.slice(at, 1000)
            held.append(part)
            size += part.nbytes
            if size < limit:
                continue
            t = pa.Table.from_batches(held).combine_chunks()
            end = _group_starts(t)[-1]
            if end:
                yield t.slice(0, end).combine_chunks()
            rest = t.slice(end)
            # Copied, so that the part handed out can be freed.
            held = [x for x in pa.Table.from_batches([y for y in rest.to_batches()]).to_batches()]
            size = rest.nbytes
    if held:
        t = pa.Table.from_batches(held).combine_chunks()
        if t.num_rows:
            yield t


def _group_starts(t: pa.Table) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[:1] = True
    for c in GROUP:
        x = t[c].to_numpy()
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def surviving_pairs(t: pa.Table, sig: np.ndarray, threshold: float, tolerance: float,
                    chunk: int = 200_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of row numbers of a table of whole groups that pass the pruning."""
    starts = _group_starts(t)
    ends = np.append(starts[1:], t.num_rows)
    group_end = np.repeat(ends, ends - starts)
    idx = np.arange(t.num_rows)
    later = group_end - idx - 1
    cum = np.cumsum(later)
    band, side = t["band"].to_numpy(), t["side"].to_numpy()
    cross = t["lo"].to_numpy() != t["hi"].to_numpy()
    need = least_matches(threshold, tolerance)
    at = 0
    while at < len(idx):
        end = max(at + 1, int(np.searchsorted(cum, (cum[at - 1] if at else 0) + chunk, "right")))
        n = later[at:end]
        x = np.repeat(idx[at:end], n)
        y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n)
        at = end
        ok = ~cross[x] | (side[x] != side[y])  # a pair of blocks compares across
        x, y = x[ok], y[ok]
        m = np.zeros(len(x), np.int32)
        for step in range(LANES // STEP):
            if not len(x):
                break
            lanes = slice(step * STEP, (step + 1) * STEP)
            m += (sig[x, lanes] == sig[y, lanes]).sum(1, dtype=np.int32)
            ok = m >= need[step]
            x, y, m = x[ok], y[ok], m[ok]
        if len(x):
            same = (sig[x] == sig[y]).reshape(-1, BANDS, ROWS).all(2)
            ok = same.any(1) & (same.argmax(1) == band[x])
            x, y = x[ok], y[ok]
        if len(x):
            yield x, y


def _to_verify(grouped: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Members of buckets that have a surviving pair there."""
    def run(batches):
        for t in _whole_groups(batches):
            sig = _signatures(t["sig"].chunk(0))
            keep = np.zeros(t.num_rows, bool)
            for x, y in surviving_pairs(t, sig, threshold, tolerance):
                keep[x] = keep[y] = True
            if keep.any():
                yield from t.select([*GROUP, "side", "rid"]).filter(pa.array(keep)).to_batches()
    return grouped.mapInArrow(run, "band int, key bigint, lo int, hi int, side int, rid bigint")


def _member_sets(rows: DataFrame) -> DataFrame:
    def run(batches):
        for whole in batches:
            for b in batches_by_bytes(whole, "text"):
                s, n = shingle_sets(b.column("text"))
                cut = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays(
                    [b.column("rid"), pa.array([s[cut[i]: cut[i + 1]].tobytes() for i in range(len(n))],
                                               pa.binary())], ["rid", "shingles"])
    return rows.select("rid", "text").mapInArrow(run, "rid bigint, shingles binary")


def exact_similarity(sets: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Jaccard of pairs of sets. Pairs of one group mostly share members, so
    shared shingles are counted by a matrix product over the group's
    shingles, in bounded columns; few pairs are intersected one by one."""
    size = np.array([len(s) for s in sets], np.int64)
    members = np.unique(np.concatenate([x, y]))
    if len(x) < 4 * len(members):
        both = np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True))
                         for a, b in zip(x.tolist(), y.tolist(), strict=True)], np.int64)
        return both / (size[x] + size[y] - both)
    flat = np.concatenate([sets[i] for i in members.tolist()])
    row = np.repeat(np.arange(len(members)), size[members])
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    col = np.cumsum(new) - 1
    often = np.bincount(col)[col] > 1  # a shingle of one set is shared by no pair
    row, col = row[often], np.unique(col[often], return_inverse=True)[1]
    shared = np.zeros((len(members), len(members)), np.float32)
    width = max(64, (8 << 20) // len(members))
    cut = np.searchsorted(col, np.arange(0, (col[-1] + 1 if len(col) else 0) + width, width))
    for a, b, base in zip(cut[:-1], cut[1:], range(0, 1 << 62, width), strict=False):
        block = np.zeros((len(members), width), np.float32)
        block[row[a:b], col[a:b] - base] = 1
        shared += block @ block.T
    both = shared[np.searchsorted(members, x), np.searchsorted(members, y)].astype(np.int64)
    return both / (size[x] + size[y] - both)


def _verified(grouped: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """(rid, links, texts, root) of each member with a verified link in a
    group: linked rows, linked classes, and the smallest row its links reach
    within the group."""
    def run(batches):
        for t in _whole_groups(batches):
            sig = _signatures(t["sig"].chunk(0))
            rid, copies = t["rid"].to_numpy(), t["copies"].to_numpy()
            starts = _group_starts(t)
            sets = [np.frombuffer(v.as_buffer(), np.uint64) for v in t["shingles"].chunk(0)]
            links, kinds = np.zeros(t.num_rows, np.int64), np.zeros(t.num_rows, np.int64)
            root = np.arange(t.num_rows)
            for x, y in surviving_pairs(t, sig, threshold, tolerance):
                group = np.searchsorted(starts, x, "right")
                order = np.argsort(group, kind="stable")
                cuts = np.flatnonzero(np.diff(group[order])) + 1
                for part in np.split(order, cuts):
                    a, b = x[part], y[part]
                    ok = exact_similarity(sets, a, b) >= threshold - 1e-12
                    a, b = a[ok], b[ok]
                    np.add.at(links, a, copies[b])
                    np.add.at(links, b, copies[a])
                    np.add.at(kinds, a, 1)
                    np.add.at(kinds, b, 1)
                    _join_roots(root, a, b)
            has = np.flatnonzero(kinds)
            if len(has):
                top = _tops(root)[has]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[has]), pa.array(links[has]), pa.array(kinds[has]), pa.array(rid[top])],
                    ["rid", "links", "texts", "root"])
    return grouped.mapInArrow(run, "rid bigint, links bigint, texts bigint, root bigint")


def _tops(root: np.ndarray) -> np.ndarray:
    while True:
        up = root[root]
        if (up == root).all():
            return root
        root = up


def _join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merge the trees of linked rows: the smaller root wins, until stable."""
    while len(a):
        root[:] = _tops(root)
        lo, hi = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        differ = lo != hi
        if not differ.any():
            return
        a, b = a[differ], b[differ]
        np.minimum.at(root, hi[differ], lo[differ])


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node of each connected component of
    ``edges`` (a, b). Minimum labels spread along edges and are short-cut
    through the label's own label each round, so rounds grow with the
    logarithm of a component's width; each is written to the shared folder."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stage_table(both.filter("a != b").distinct(), "cc-edges")
    labels = stage_table(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")),
                         "cc-labels")
    while True:
        near = (both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("label").alias("near")))
        moved = labels.join(near, F.col("node") == F.col("a")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        up = labels.select(F.col("node").alias("up"), F.col("label").alias("up_label"))
        moved = stage_table(moved.join(up, F.col("label") == F.col("up"), "left").select(
            "node", "old", F.least("label", F.coalesce("up_label", "label")).alias("label")), "cc-labels")
        if moved.filter("old != label").isEmpty():
            return moved.select("node", "label")
        labels = moved.select("node", "label")


def similar_texts(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
                  block: int = BLOCK) -> DataFrame:
    """One row per document: rid, doc_id, class_id (smallest id of its group
    of linked documents), copy_id and n_copies (documents with its very
    shingle set), n_links (other documents at the threshold or above, copies
    included) and n_texts (classes among them other than its own)."""
    rows = texts(docs)
    sketches = stage_table(_sketches(rows), "near-sketches")
    order = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "rid")
    classes = sketches.groupBy("n", "k1", "k2").agg(
        F.min(order).alias("top"), F.count(F.lit(1)).alias("copies"))
    members = stage_table(
        sketches.join(classes, ["n", "k1", "k2"]).select(
            "rid", "doc_id", "n", F.col("top.rid").alias("rep"), F.col("top.doc_id").alias("copy_id"), "copies",
            F.when(F.col("rid") == F.col("top.rid"), F.col("sig")).alias("sig")), "near-members")
    reps = members.filter("sig IS NOT NULL AND n > 0").select("rid", "copies", "sig")
    bands = stage_table(_band_rows(reps), "near-bands")
    full = bands.groupBy("band", "key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    buckets = bands.join(full, ["band", "key"])
    n_blocks = F.ceil(F.col("c") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("rid"), n_blocks).cast("int")
    spread = (buckets.withColumn("side", own)
              .withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
              .select("band", "key", F.least("side", "other").alias("lo"),
                      F.greatest("side", "other").alias("hi"), "side", "rid"))

    def together(df):
        return df.repartition(*GROUP).sortWithinPartitions(*GROUP, "rid")

    todo = stage_table(_to_verify(together(spread.join(reps.select("rid", "sig"), "rid")), threshold, tolerance),
                       "near-verify")
    wanted = todo.select("rid").distinct()
    sets = stage_table(_member_sets(rows.join(wanted, "rid", "left_semi")), "near-sets")
    known = reps.join(sets, "rid")
    links = stage_table(_verified(together(todo.join(known, "rid")), threshold, tolerance), "near-links")
    groups = components(links.select(F.col("rid").alias("a"), F.col("root").alias("b")))
    per = links.groupBy("rid").agg(F.sum("links").alias("links"), F.sum("texts").alias("texts"))
    per = per.join(groups, F.col("rid") == F.col("node"), "left").select(
        F.col("rid").alias("lrid"), "links", "texts", "label")
    named = stage_table(
        members.drop("sig").join(per, F.col("rep") == F.col("lrid"), "left").select(
            "rid", "doc_id", "rep", "copy_id", "copies", F.coalesce("links", F.lit(0)).alias("links"),
            F.coalesce("texts", F.lit(0)).alias("n_texts"), F.coalesce("label", "rep").alias("label")), "near-named")
    tops = named.groupBy(F.col("label").alias("l")).agg(
        F.min(order).alias("first"), F.count(F.lit(1)).alias("class_size"))
    return named.join(tops, F.col("label") == F.col("l")).select(
        "rid", "doc_id", F.col("first.doc_id").alias("class_id"), "class_size", "copy_id",
        F.col("copies").alias("n_copies"), (F.col("links") + F.col("copies") - 1).alias("n_links"), "n_texts",
        (F.col("rid") == F.col("first.rid")).alias("stays"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay: one of each group of linked documents."""
    kept = similar_texts(docs).filter("stays").select(F.col("rid").alias("__kept_rid"))
    return (docs.withColumn("__rid", F.monotonically_increasing_id())
            .join(kept, F.col("__rid") == F.col("__kept_rid"), "left_semi").drop("__rid"))
