"""Maximal periodic runs of words by suffix-tree longest common extensions.

A run is a stretch of words with a smallest period ``q``, at least
``min_length`` words and ``min_exponent`` periods long, that no neighbouring
word extends. Every run has a Lyndon root that is the longest Lyndon word at
its start, under the alphabetical order or its reverse. So, per stretch:

* Ukkonen's algorithm builds the suffix trees of the words and of their
  reversal; an Euler tour of string depths with a block-wise sparse table
  answers the depth of a lowest common ancestor, which is the longest common
  extension of two places, in constant time;
* the order of the leaves ranks the suffixes, and the next smaller suffix ends
  the longest Lyndon word at each place (for the reversed order the same with
  children visited in reverse);
* each of the two candidates per place is extended right by the tree and left
  by the reversal's tree, and kept if it is long enough.

Trees are built only where a run can be: of a run of ``L >= min_exponent * q``
words, each k-word gram (k = ``min_length`` * (1 - 2 / ``min_exponent``), 8 by
default) occurs a second time in the same document, one period on or back. The
grams of a batch are hashed and sorted by numpy, and each longest stretch of
repeated grams gets its trees: a run and the words that end it are decided
inside one stretch, and equal grams are never missed (hash collisions only add
stretches). Words are compared by their bytes.

One pass over the documents, no shuffle; work is linear in a text, and memory
follows the longest stretch.

Defined cases: NULL and blank texts have no words and no run; a NULL id stays
NULL; repeated rows and ids are reported once each; an empty table gives an
empty result. Only the id and text columns are read, so others may have any
name.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from riverbed.llm.common import SPACE, batches_by_bytes, mix, row_of, shingles, texts, words

MIN_LENGTH, MIN_EXPONENT = 24, 3


def ukkonen(codes: list[int]) -> tuple[dict[int, int], int, list[int], list[int]]:
    """The suffix tree of codes >= 1, ended by code 0: children by ``node *
    width + first code``, that width, and per node the end of its edge's label
    and where the suffix begins that the label was read from. So a node's
    string depth is their difference, and leaves are the nodes that end last."""
    s = [*codes, 0]
    n, width = len(s), max(s) + 1
    start, end, link, origin = [0], [0], [0], [0]
    child: dict[int, int] = {}
    node = edge = length = todo = 0
    for i, c in enumerate(s):
        todo += 1
        inner = 0  # the inner node made last, whose suffix link is open
        while todo:
            if not length:
                edge = i
            key = node * width + s[edge]
            below = child.get(key)
            if below is None:
                child[key] = len(start)
                start.append(i)
                end.append(n)
                link.append(0)
                origin.append(i - todo + 1)
                if inner:
                    link[inner] = node
                    inner = 0
            else:
                at = start[below]
                span = (end[below] if end[below] <= i else i + 1) - at
                if length >= span:
                    edge += span
                    length -= span
                    node = below
                    continue
                at += length
                if s[at] == c:
                    length += 1
                    if inner:
                        link[inner] = node
                    break
                split = len(start)
                child[key] = split
                child[split * width + s[at]] = below
                child[split * width + c] = split + 1
                start += (start[below], i)
                end += (at, n)
                link += (0, 0)
                origin += (origin[below], i - todo + 1)
                start[below] = at
                if inner:
                    link[inner] = split
                inner = split
            todo -= 1
            if node:
                node = link[node]
            elif length:
                length -= 1
                edge = i - todo + 1
    return child, width, end, origin


class SuffixForest:
    """One suffix tree per text, put in order together: children sorted, an
    Euler tour numbered by pointer jumping, and its string depths. A suffix is
    addressed by its place in the texts laid end to end, each with its end."""

    def __init__(self, texts_: list[list[int]]):
        parent, code, node, end, origin, leaf_end, base = [], [], [], [], [], [], []
        n_nodes = n_places = 0
        for codes in texts_:
            child, width, e, o = ukkonen(codes)
            keys = np.fromiter(child.keys(), np.int64, len(child))
            parent.append(keys // width + n_nodes)
            code.append(keys % width)
            node.append(np.fromiter(child.values(), np.int64, len(child)) + n_nodes)
            end.append(np.array(e, np.int64))
            origin.append(np.array(o, np.int64))
            leaf_end.append(np.full(len(e), len(codes) + 1, np.int64))
            base.append(np.full(len(e), n_places, np.int64))
            n_nodes += len(e)
            n_places += len(codes) + 1
        self._parent, self._code, self._node = map(np.concatenate, (parent, code, node))
        end, origin = np.concatenate(end), np.concatenate(origin)
        self._depth = (end - origin).astype(np.int32)
        self._leaves = np.flatnonzero(end == np.concatenate(leaf_end))
        self._suffix = (origin + np.concatenate(base))[self._leaves]
        self._n = n_places
        self._depths, self.place = None, None

    def _tour(self, reverse: bool) -> np.ndarray:
        """Place of each node's first visit in the Euler tours, laid end to
        end. The step down to node c is element c, the step back up is N + c;
        each step's successor is known, and jumping over ever more steps counts
        those that are left."""
        n = len(self._depth)
        order = np.lexsort((np.where(self._code > 0, -self._code, -(1 << 62)) if reverse else self._code, self._parent))
        up, down = self._parent[order], self._node[order]
        first = np.full(n, -1, np.int64)
        fresh = np.r_[True, up[1:] != up[:-1]]
        first[up[fresh]] = down[fresh]
        after = np.full(n, -1, np.int64)
        after[down[:-1][~fresh[1:]]] = down[1:][~fresh[1:]]
        above = np.full(n, -1, np.int64)
        above[down] = up
        self._above = above
        i = np.arange(n)
        to = np.empty(2 * n, np.int64)
        to[:n] = np.where(first >= 0, first, n + i)
        to[n:] = np.where(after >= 0, after, n + above)
        roots = above < 0
        last = n + i[roots]
        to[last] = last
        left = np.ones(2 * n, np.int64)
        left[last] = 0
        while True:
            left += left[to]
            nxt = to[to]
            if np.array_equal(nxt, to):
                break
            to = nxt
        total = np.zeros(n, np.int64)  # steps of the trees before a node's own
        total[roots] = np.r_[0, np.cumsum(left[:n][roots] + 1)[:-1]]
        root_of = np.maximum.accumulate(np.where(roots, i, 0))  # a tree's nodes follow its root
        size = left[:n][root_of]
        self._visits = np.concatenate([total[root_of] + size - left[:n], total[root_of] + size - left[n:]])
        return self._visits[:n]

    def ranks(self, reverse: bool = False) -> np.ndarray:
        """A number per suffix that orders a text's suffixes; ``reverse`` turns
        the order of the codes round (a text's end stays smallest)."""
        out = np.empty(self._n, np.int64)
        out[self._suffix] = self._tour(reverse)[self._leaves]
        return out

    def prepare(self) -> np.ndarray:
        """Ready for ``common``; the ranks in alphabetical order."""
        self.place = self.ranks()
        n = len(self._depth)
        values = np.empty(2 * n, np.int32)
        values[self._visits[:n]] = self._depth
        values[self._visits[n:]] = np.where(self._above >= 0, self._depth[self._above], 0)
        self._depths = RangeMin(values)
        return self.place

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Longest common extension of two different suffixes of one text."""
        a, b = self.place[i], self.place[j]
        return self._depths.least(np.minimum(a, b), np.maximum(a, b))


class RangeMin:
    """Range minima in constant time: prefix and suffix minima of blocks and a
    sparse table over the blocks."""
    BITS = 4

    def __init__(self, values: np.ndarray):
        size = 1 << self.BITS
        blocks = -(-len(values) // size)
        padded = np.full(blocks * size, np.iinfo(values.dtype).max, values.dtype)
        padded[:len(values)] = values
        square = padded.reshape(blocks, size)
        self.values = padded
        self.up = np.minimum.accumulate(square, 1).ravel()
        self.down = np.minimum.accumulate(square[:, ::-1], 1)[:, ::-1].ravel()
        table = [square.min(1)]
        while 2 << (len(table) - 1) <= blocks:
            step = 1 << (len(table) - 1)
            last = table[-1]
            table.append(np.minimum(last, np.concatenate([last[step:], last[-step:]])))
        self.table = np.stack(table)

    def least(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        a, b = lo >> self.BITS, hi >> self.BITS
        out = np.minimum(self.down[lo], self.up[hi])
        far = np.flatnonzero(b - a > 1)
        if len(far):
            x, y = a[far] + 1, b[far]
            k = np.frexp((y - x).astype(np.float64))[1] - 1
            out[far] = np.minimum(out[far], np.minimum(self.table[k, x], self.table[k, y - (1 << k)]))
        near = np.flatnonzero(a == b)
        if len(near):
            x, y = lo[near], hi[near]
            least = self.values[x]
            for step in range(1, 1 << self.BITS):
                least = np.minimum(least, self.values[np.minimum(x + step, y)])
            out[near] = least
        return out


def next_smaller(rank: list[int], at: int, n: int) -> list[int]:
    """For each of the n suffixes from place ``at`` the next one that ranks
    below it, both counted from the text's start."""
    rank = rank[at: at + n]
    out = [n] * n
    for i in range(n - 2, -1, -1):
        j, r = i + 1, rank[i]
        while j < n and rank[j] > r:
            j = out[j]
        out[i] = j
    return out


def runs_of(texts_: list[list[int]], min_length: int = 2, min_exponent: int = 2) -> np.ndarray:
    """Rows (text, start, length, period) of the runs of sequences of codes
    >= 1, ordered."""
    if not texts_:
        return np.zeros((0, 4), np.int64)
    tree, back = SuffixForest(texts_), SuffixForest([t[::-1] for t in texts_])
    back.prepare()
    size = np.array([len(t) for t in texts_])
    base = np.cumsum(size + 1) - size - 1
    which = np.repeat(np.arange(len(size)), size)
    i = np.arange(len(which)) - (np.cumsum(size) - size)[which]
    at, n = base[which], size[which]
    found = []
    for rank in (tree.prepare(), tree.ranks(reverse=True)):
        rank = rank.tolist()
        j = np.array([x for b, m in zip(base.tolist(), size.tolist(), strict=True) for x in next_smaller(rank, b, m)],
                     np.int64)
        right, left = np.zeros(len(i), np.int64), np.zeros(len(i), np.int64)
        k = np.flatnonzero(j < n)
        right[k] = tree.common(at[k] + i[k], at[k] + j[k])
        k = np.flatnonzero(i > 0)
        left[k] = back.common(at[k] + n[k] - i[k], at[k] + n[k] - j[k])
        found.append(np.stack([which, i - left, j + right - i + left, j - i], 1))
    rows = np.concatenate(found)
    rows = np.unique(rows[(rows[:, 2] >= min_length) & (rows[:, 2] >= min_exponent * rows[:, 3])], axis=0)
    return rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]


def stretches(column: pa.Array, min_length: int, min_exponent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(words per row, row, first word, words) of the stretches in which every
    gram occurs at least twice in its row: no run lies outside one."""
    h, counts = words(column, SPACE, lower=False)
    k = max(1, min_length * (min_exponent - 2) // min_exponent)
    grams, n = shingles(h, counts, k)
    del h
    row = row_of(n)
    key = mix(grams + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    if not len(at):
        none = np.zeros(0, np.int64)
        return counts, none, none, none
    cut = np.flatnonzero((np.diff(at) > 1) | (np.diff(row[at]) > 0)) + 1
    lo, hi = at[np.r_[0, cut]], at[np.r_[cut - 1, len(at) - 1]]
    size = hi - lo + k
    long = size >= min_length
    lo, size = lo[long], size[long]
    return counts, row[lo], lo - (np.cumsum(n) - n)[row[lo]], size


FOREST_WORDS = 1 << 17


def _runs_of_rows(tokens: dict[int, list[bytes]], parts: list[tuple[int, int, int]], min_length: int,
                  min_exponent: int) -> np.ndarray:
    """(row, start, length, period) of the runs in the stretches (row, first
    word, words): about FOREST_WORDS words at a time, a stretch never cut."""
    found, at = [np.zeros((0, 4), np.int64)], 0
    while at < len(parts):
        codes, owner, n = [], [], 0
        while at < len(parts) and (not n or n + parts[at][2] <= FOREST_WORDS):
            row, start, size = parts[at]
            names: dict[bytes, int] = {}
            codes.append([names.setdefault(w, len(names) + 1) for w in tokens[row][start: start + size]])
            owner.append((row, start))
            n += size
            at += 1
        rows = runs_of(codes, min_length, min_exponent)
        own = np.array(owner, np.int64)
        rows[:, 1] += own[rows[:, 0], 1]
        rows[:, 0] = own[rows[:, 0], 0]
        found.append(rows)
    return np.concatenate(found)


def _without_repeats(tokens: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run holds after its first period."""
    gone = np.zeros(len(tokens) + 1, np.int64)
    np.add.at(gone, runs[:, 0] + runs[:, 2], 1)
    np.add.at(gone, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([tokens[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)])


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
Rewrite = Callable[[pa.Array, pa.Array], pa.Array]


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
                  rewrite: Rewrite | None = None) -> DataFrame:
    """One row per input row: rid, doc_id, n_words, ``runs`` (start, length and
    period in words, by start and period) and ``collapsed``, the words that no
    run repeats (a run keeps its first period), joined by one space.
    ``rewrite`` maps (ids, texts) of a batch to the texts that are searched."""
    if min_exponent < 2:
        raise ValueError("a run holds at least two periods")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in batches_by_bytes(whole, "text"):
                column = b.column("text") if rewrite is None else rewrite(b.column("doc_id"), b.column("text"))
                counts, row, start, size = stretches(column, min_length, min_exponent)
                rows = column.cast(pa.binary()).to_pylist()  # bytes split at ASCII whitespace only
                parts = list(zip(row.tolist(), start.tolist(), size.tolist(), strict=True))
                tokens = {r: rows[r].split() for r in set(row.tolist())}
                found = _runs_of_rows(tokens, parts, min_length, min_exponent)
                cut = np.searchsorted(found[:, 0], np.arange(len(rows) + 1))
                flat = found[:, 1:]
                kept = [_without_repeats(tokens[r], flat[cut[r]: cut[r + 1]]) if cut[r] < cut[r + 1]
                        else b" ".join(text.split()) for r, text in enumerate(rows)]
                runs = pa.ListArray.from_arrays(
                    pa.array(cut.astype(np.int32)),
                    pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], fields=list(RUN)))
                yield pa.RecordBatch.from_arrays(
                    [b.column("rid"), b.column("doc_id"), pa.array(counts), runs,
                     pa.array(kept, pa.binary()).cast(pa.string())],
                    ["rid", "doc_id", "n_words", "runs", "collapsed"])

    return texts(docs, id_col, text_col).mapInArrow(
        run, "rid bigint, doc_id bigint, n_words bigint, "
             "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string")


def loop_tails(ids: pa.Array, column: pa.Array) -> pa.Array:
    """The registered query's documents: where crc32(id) mod 10 is 0, the words
    from a document's own place on repeat with a document's own period."""
    out = []
    for doc_id, text in zip(ids.to_pylist(), column.cast(pa.binary()).to_pylist(), strict=True):
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0:
            tokens = text.split()
            n, g = len(tokens), h // 10
            if n:
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                text = b" ".join([tokens[i if i < a else a + (i - a) % p] for i in range(n)])
        out.append(text)
    return pa.array(out, pa.binary()).cast(pa.string())
