"""Language identification by a byte convolutional network.

Bytes (ASCII letters in lower case) of fixed-length windows go through filters
of several widths, max pooling and softmax. As the input is one-hot, a filter
is a sum of table rows, one table per place in the filter, so no embedding is
needed. The network is trained in numpy on a bounded sample of labelled
windows (``WINDOWS_PER_LANGUAGE`` per language, one per document, taken in
hash order, and ``WINDOWS`` in all, but one of each language at least) and applied to every window of every whole text. A text's language
maximises the summed log probabilities of its windows, weighted by their bytes.

Scoring is one pass without a shuffle; only the sample moves.

Defined cases: NULL text and texts without a letter are ``und`` with score 0;
a NULL language is not learned from; a NULL id counts as the empty text in the
fold; without training windows everything is ``und``; repeated rows repeat
results; an empty table gives an empty result. Very long texts are scored in
batches of windows. Every language with a training window is learned, so the
sample and the network grow with the number of languages, not of rows; id, text
and language are the only columns read, and language only to train.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riverbed.llm.common import LOWER, stage_table, string_buffers

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
WINDOWS_PER_LANGUAGE, WINDOWS = 1500, 60_000
OVERSAMPLE = 3
#: Windows times languages that are scored at a time, at most.
CELLS = 1 << 18
EPOCHS, BATCH, RATE = 10, 64, 0.01
UNKNOWN = "und"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def cut_windows(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, row of each, bytes of each): texts in lower case cut every
    WINDOW bytes, the last window of a text padded with zeros."""
    size = np.diff(offs)
    n = -(-size // WINDOW)
    row = np.repeat(np.arange(len(size)), n)
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    begin = offs[:-1][row] + nth * WINDOW
    length = np.minimum(size[row] - nth * WINDOW, WINDOW)
    at = begin[:, None] + np.arange(WINDOW)
    inside = np.arange(WINDOW) < length[:, None]
    out = np.zeros(at.shape, np.uint8)
    out[inside] = LOWER[data[at[inside]]]
    return out, row, length


class ByteNet:
    """The network: tables[w][j] (256, FILTERS) per width and place, biases,
    and the dense layer."""

    def __init__(self, n_classes: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.tables = [rng.normal(0, 0.1, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        self.bias = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
        self.dense = rng.normal(0, 0.1, (len(WIDTHS) * FILTERS, n_classes)).astype(np.float32)
        self.out = np.zeros(n_classes, np.float32)

    def params(self) -> list[np.ndarray]:
        return [*self.tables, *self.bias, self.dense, self.out]

    def pooled(self, x: np.ndarray, places: bool = False):
        """Max-pooled rectified filter outputs, and the places of the maxima."""
        tops, where = [], []
        for w, table, bias in zip(WIDTHS, self.tables, self.bias, strict=True):
            p = x.shape[1] - w + 1
            conv = np.take(table[0], x[:, :p], axis=0)
            for j in range(1, w):
                conv += np.take(table[j], x[:, j: j + p], axis=0)
            if places:
                where.append(conv.argmax(1))
                top = np.take_along_axis(conv, where[-1][:, None, :], 1)[:, 0]
            else:
                top = conv.max(1)
            tops.append(np.maximum(top + bias, 0))
        h = np.concatenate(tops, 1)
        return (h, where) if places else h

    def log_softmax(self, h: np.ndarray) -> np.ndarray:
        z = h @ self.dense + self.out
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def log_probs(self, x: np.ndarray, batch: int = 128) -> np.ndarray:
        parts = [self.log_softmax(self.pooled(x[i: i + batch])) for i in range(0, len(x), batch)]
        return np.concatenate(parts) if parts else np.zeros((0, len(self.out)), np.float32)

    def gradients(self, x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
        h, where = self.pooled(x, True)
        d = np.exp(self.log_softmax(h))
        d[np.arange(len(y)), y] -= 1
        d /= len(y)
        back = (d @ self.dense.T) * (h > 0)
        tables, bias = [], []
        for k, w in enumerate(WIDTHS):
            g = back[:, k * FILTERS: (k + 1) * FILTERS]
            t = np.zeros_like(self.tables[k])
            for j in range(w):  # only the places of the maxima carry gradient
                byte = np.take_along_axis(x, where[k] + j, 1)
                np.add.at(t[j], (byte, np.arange(FILTERS)[None, :]), g)
            tables.append(t)
            bias.append(g.sum(0))
        return [*tables, *bias, h.T @ d, d.sum(0)]


def train(x: np.ndarray, y: np.ndarray, n_classes: int, epochs: int = EPOCHS, seed: int = 3) -> ByteNet:
    """Adam over shuffled batches."""
    net, rng = ByteNet(n_classes, seed), np.random.default_rng(seed)
    m = [np.zeros_like(p) for p in net.params()]
    v = [np.zeros_like(p) for p in net.params()]
    t = 0
    for epoch in range(epochs):
        order = rng.permutation(len(x))
        rate = RATE * (1 - epoch / epochs)
        for i in range(0, len(x), BATCH):
            pick = order[i: i + BATCH]
            t += 1
            for k, (p, g) in enumerate(zip(net.params(), net.gradients(x[pick], y[pick]), strict=True)):
                m[k] += 0.1 * (g - m[k])
                v[k] += 0.001 * (g * g - v[k])
                p -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-7)
    return net


def training_windows(docs: DataFrame, per_language: int = WINDOWS_PER_LANGUAGE) -> tuple[list[str], list[str]]:
    """(languages, windows) of the bounded sample: one window of a document,
    at a hashed place, from documents of the training folds."""
    text = F.coalesce(F.col("text"), F.lit(""))
    windows = F.greatest(F.floor(F.length(text) / WINDOW), F.lit(1))
    place = F.pmod(F.xxhash64(F.lit(11), "doc_id"), windows) * WINDOW + 1
    learn = docs.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    # Rows of each language, to thin the candidates by hash before they move:
    # about OVERSAMPLE times what is wanted reaches the ranking, at any size.
    sizes = stage_table(learn.groupBy(F.col("lang").cast("string").alias("size_lang"))
                        .agg(F.count(F.lit(1)).alias("size")), "languages")
    per_language = max(1, min(per_language, WINDOWS // max(sizes.count(), 1)))
    share = F.least(F.lit(1.0), F.lit(float(OVERSAMPLE * per_language)) / F.col("size"))
    h = F.xxhash64(F.lit(12), "doc_id", text)
    found = (learn.select("doc_id", "text", F.col("lang").cast("string").alias("lang"))
             .join(sizes, F.col("lang") == F.col("size_lang"))  # broadcast while it is small
             .filter(F.pmod(h, F.lit(1 << 30)) < share * (1 << 30))
             .select("lang", h.alias("h"),
                     F.substring(text, place.cast("int"), F.lit(WINDOW)).alias("window"))
             .filter(F.col("window").rlike(r"\p{L}")))
    first = Window.partitionBy("lang").orderBy("h", "window")
    got = (found.withColumn("k", F.row_number().over(first)).filter(F.col("k") <= per_language)
           .select("lang", "window").orderBy("lang", "window").collect())  # at most per_language rows of each
    return [r[0] for r in got], [r[1] for r in got]


def fit(docs: DataFrame, per_language: int = WINDOWS_PER_LANGUAGE) -> tuple[ByteNet | None, list[str]]:
    langs, windows = training_windows(docs, per_language)
    if not langs:
        return None, []
    names = sorted(set(langs))
    x = np.empty((len(langs), WINDOW), np.uint8)
    for i in range(0, len(langs), 8192):
        data, offs = string_buffers(pa.array(windows[i: i + 8192], pa.string()))
        cut, row, _ = cut_windows(data, offs)
        # a window of 256 characters may have more bytes
        x[i: i + 8192] = cut[np.concatenate([[True], row[1:] != row[:-1]])]
    place = {k: i for i, k in enumerate(names)}
    return train(x, np.array([place[k] for k in langs]), len(names)), names


SCHEMA = "doc_id bigint, held_out boolean, lang_pred string, score double"


def identify(docs: DataFrame, per_language: int = WINDOWS_PER_LANGUAGE) -> DataFrame:
    """One row per document: predicted language and its mean probability."""
    net, names = fit(docs, per_language)
    step = max(1, 16 * CELLS // max(len(names), 1))
    piece = min(1 << 20, max(1, CELLS // max(len(names), 1)) * WINDOW)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                       F.coalesce("text", F.lit("")).alias("text"),
                       F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (w.slice(i, step) for w in batches for i in range(0, w.num_rows, step)):
            n = b.num_rows
            known = b.column("letters").to_numpy(zero_copy_only=False)
            pred, score = np.full(n, -1), np.zeros(n)
            if net is not None:
                data, offs = string_buffers(b.column("text"))
                total, weight = np.zeros((n, len(names))), np.zeros((n, len(names)))
                for r0, r1, a, z in _pieces(offs, piece):
                    cut = np.clip(offs[r0: r1 + 1], a, z)
                    x, row, size = cut_windows(data, cut)
                    lp = net.log_probs(x)
                    np.add.at(total, row + r0, lp * size[:, None])
                    np.add.at(weight, row + r0, np.exp(lp) * size[:, None])
                pred = total.argmax(1)
                size = np.maximum(np.diff(offs), 1)
                score = np.clip(weight[np.arange(n), pred] / size, 0, 1)
            ok = known & (pred >= 0)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"),
                 pa.array([names[p] if k else UNKNOWN for p, k in zip(pred, ok, strict=True)], pa.string()),
                 pa.array(np.where(ok, score, 0.0))], ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(run, SCHEMA)


def _pieces(offs: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int, int, int]]:
    """(first row, last row + 1, first byte, last byte): whole rows of about
    ``limit`` bytes; a longer row in pieces of a multiple of WINDOW."""
    r, n = 0, len(offs) - 1
    limit -= limit % WINDOW
    while r < n:
        end = max(r + 1, int(np.searchsorted(offs, offs[r] + limit, "right")) - 1)
        end = min(end, n)
        for a in range(int(offs[r]), max(int(offs[end]), int(offs[r]) + 1), limit):
            yield r, end, a, min(a + limit, int(offs[end]))
        r = end
