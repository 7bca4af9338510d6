"""Language-model scores by deleted interpolation.

The model mixes maximum-likelihood bigrams, unigrams and a uniform floor:

    P(w | v) = l2[b] c(v, w) / c(v)  +  l1[b] c(w) / N  +  l0[b] / (V + 1)

with weights per bucket b of the context's frequency (powers of two). The
weights are learned by expectation-maximisation on held-out counts: counts of
nine tenths of the training documents, evaluated on the tenth deleted from
them. The final counts are those of all training documents.

At scale nothing about the vocabulary is broadcast or collected. Documents are
read in chunks of about ``CHUNK_BYTES``; a chunk asks for the counts of its
distinct words and bigrams, as sorted arrays of 56-bit keys, one row per key
range. Each range is summed over all chunks in one group and answers every
chunk with counts in its own key order, so what crosses the network is one
entry per distinct n-gram of a chunk, and a word or pair that fills a third of
all text costs one entry per chunk. The number of ranges grows with the input.
The statistics for expectation-maximisation are a histogram of at most a few
thousand cells. Each step is written to the shared folder.

Counts are exact 8-byte sums; an answer takes 4 bytes a count unless one of its
counts needs 8, so none is cut off at any size.

Keys are hashes: at 10**9 distinct n-grams about one pair in 14 would share a
count.

Defined cases: NULL text is empty (its one token is the end); a NULL id counts
as the empty text, so it is held out; repeated rows count and score each time;
with no training text every count is 0 and the floor alone scores; an empty
table gives an empty result. Only id and text are read. A very long text is a
chunk of its own.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import SPACE, mix, stage_table, texts, words

CHUNK_BYTES = 12 << 20
RANGE_BYTES = 16 << 20
MIN_BITS, MAX_BITS = 8, 24
KEY_BITS = 56
START, END = np.uint64(0x5354415254AA5501), np.uint64(0x454E44454E44AA55)
HELD_OUT, DELETED, MAIN = 0, 1, 2
BUCKETS = 64
EM_STEPS = 60


def fold(doc_id: Column) -> Column:
    """HELD_OUT (never learned from), DELETED (weights) or MAIN (counts)."""
    r = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 10
    return F.when(r == 0, HELD_OUT).when(r == 1, DELETED).otherwise(MAIN)


def token_stream(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, tokens per row): START, the words, END of each row."""
    h, n = words(column, SPACE)
    size = n + 2
    cut = np.cumsum(size)
    out = np.empty(int(cut[-1]) if len(cut) else 0, np.uint64)
    inner = np.ones(len(out), bool)
    inner[cut - size] = False
    inner[cut - 1] = False
    out[inner] = h
    out[cut - size] = START
    out[cut - 1] = END
    return out, size


def keys_of(tokens: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """56-bit keys of all tokens (START too, which counts contexts), and of
    the bigram that ends at each token but START."""
    shift = np.uint64(64 - KEY_BITS)
    pair = mix(tokens[:-1] * np.uint64(0x9FB21C651E98DF25) + tokens[1:] * np.uint64(0xD1342543DE82EF95)) \
        if len(tokens) else tokens
    starts = np.cumsum(size) - size
    keep = np.ones(len(pair), bool)
    keep[starts[1:] - 1] = False  # pairs that end at a START
    return tokens >> shift, pair[keep] >> shift


START_KEY = START >> np.uint64(64 - KEY_BITS)


def _ranges(keys: np.ndarray, bits: int) -> np.ndarray:
    """Cut points of sorted keys by key range."""
    edges = np.arange((1 << bits) + 1, dtype=np.uint64) << np.uint64(KEY_BITS - bits)
    return np.searchsorted(keys, edges)


REQUEST = "kind int, range int, chunk bigint, fold int, keys binary, counts binary"


def _requests(rows: DataFrame, bits: int) -> DataFrame:
    low = np.uint64((1 << (KEY_BITS - bits)) - 1)

    def ask(chunk: int, f: int, column: pa.Array) -> Iterator[pa.RecordBatch]:
        both = keys_of(*token_stream(column))
        for kind, k in enumerate(both):
            uniq, n = np.unique(k, return_counts=True)
            cut = _ranges(uniq, bits)
            packed = (uniq & low).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].copy()
            n = n.astype("<u4") if f != HELD_OUT else np.zeros(0, "<u4")
            at = np.flatnonzero(np.diff(cut))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), kind, np.int32)), pa.array(at.astype(np.int32)),
                 pa.array(np.full(len(at), chunk)), pa.array(np.full(len(at), f, np.int32)),
                 pa.array([packed[cut[i]: cut[i + 1]].tobytes() for i in at], pa.binary()),
                 pa.array([n[cut[i]: cut[i + 1]].tobytes() for i in at], pa.binary())],
                ["kind", "range", "chunk", "fold", "keys", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        now = None

        def flush():
            t = pa.concat_tables(held)
            for f in (HELD_OUT, DELETED, MAIN):
                own = t.filter(pa.compute.equal(t["fold"], f))
                if own.num_rows:
                    yield from ask(now, f, own["text"].combine_chunks())

        import pyarrow.compute  # noqa: F401
        for b in batches:
            chunk = b.column("chunk").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), b.num_rows]
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                if held and chunk[i] != now:
                    yield from flush()
                    held = []
                now = int(chunk[i])
                held.append(pa.Table.from_batches([b.slice(i, j - i)]).select(["fold", "text"]))
        if held:
            yield from flush()

    return rows.select("chunk", "fold", "text").mapInArrow(run, REQUEST)


def pack_counts(n: np.ndarray) -> bytes:
    """One byte of width, then the counts in 4 bytes each, or in 8 if one needs them."""
    width = 4 if int(n.max(initial=0)) < 1 << 32 else 8
    return bytes([width]) + n.astype(f"<u{width}").tobytes()


def unpack_counts(b: pa.Buffer | bytes) -> np.ndarray:
    return np.frombuffer(b, f"<u{np.frombuffer(b, np.uint8, 1)[0]}", offset=1)


ANSWER = "kind int, range int, chunk bigint, fold int, main binary, every binary, words bigint, tokens bigint, main_tokens bigint"


def _answers(requests: DataFrame, bits: int) -> DataFrame:
    """Sum each key range over all chunks and answer each in its own order; a
    row without chunk carries the range's distinct words and tokens."""
    def run(key, t):
        kind, rng = key[0].as_py(), key[1].as_py()
        folds = t["fold"].to_numpy()
        blobs = [v.as_buffer() for v in t["keys"]]
        sizes = np.array([len(b) // 6 for b in blobs], np.int64)
        raw = np.zeros((int(sizes.sum()), 8), np.uint8)
        raw[:, :6] = np.concatenate([np.frombuffer(b, np.uint8) for b in blobs]).reshape(-1, 6)
        keys = raw.view("<u8").ravel()
        n = np.zeros(len(keys), np.int64)
        cut = np.concatenate([[0], np.cumsum(sizes)])
        for i, v in enumerate(t["counts"]):
            if folds[i] != HELD_OUT:
                n[cut[i]: cut[i + 1]] = np.frombuffer(v.as_buffer(), "<u4")
        uniq, inv = np.unique(keys, return_inverse=True)
        inv = inv.ravel()
        row_fold = np.repeat(folds, sizes)
        every, main = np.zeros(len(uniq), np.int64), np.zeros(len(uniq), np.int64)
        np.add.at(every, inv, n)
        np.add.at(main, inv, np.where(row_fold == MAIN, n, 0))
        word = every > 0
        if kind == 0:
            word &= uniq != (START_KEY & np.uint64((1 << (KEY_BITS - bits)) - 1)) \
                if int(START_KEY) >> (KEY_BITS - bits) == rng else True
        none = [None]
        rows = t.num_rows
        return pa.table({
            "kind": pa.array([kind] * (rows + 1), pa.int32()), "range": pa.array([rng] * (rows + 1), pa.int32()),
            "chunk": pa.array(t["chunk"].to_pylist() + none, pa.int64()),
            "fold": pa.array(t["fold"].to_pylist() + none, pa.int32()),
            "main": pa.array([pack_counts(main[inv[cut[i]: cut[i + 1]]]) if folds[i] == DELETED else b""
                              for i in range(rows)] + none, pa.binary()),
            "every": pa.array([pack_counts(every[inv[cut[i]: cut[i + 1]]]) for i in range(rows)] + none, pa.binary()),
            "words": pa.array(none * rows + [int(word.sum())], pa.int64()),
            "tokens": pa.array(none * rows + [int(every[word].sum())], pa.int64()),
            "main_tokens": pa.array(none * rows + [int(main[word].sum())], pa.int64())})

    return requests.groupBy("kind", "range").applyInArrow(run, ANSWER)


def _counts(column: pa.Array, answers: pa.Table, field: str):
    """(size, c(w), c(v), c(v, w)) for each token but START of the rows."""
    tokens, size = token_stream(column)
    uni, pair = keys_of(tokens, size)
    order = np.lexsort((answers["range"].to_numpy(), answers["kind"].to_numpy()))
    kinds = answers["kind"].to_numpy()[order]
    blobs = answers[field].combine_chunks()
    got = []
    for kind, k in enumerate((uni, pair)):
        uniq, inv = np.unique(k, return_inverse=True)
        c = np.concatenate([unpack_counts(blobs[int(i)].as_buffer()) for i in order[kinds == kind]])
        if len(c) != len(uniq):
            raise RuntimeError("counts do not match the chunk's keys: its rows changed between two reads")
        got.append(c[inv.ravel()])
    starts = np.cumsum(size) - size
    token = np.ones(len(tokens), bool)
    token[starts] = False
    context = np.ones(len(tokens), bool)
    context[np.cumsum(size) - 1] = False
    c = got[0]
    return size - 1, c[token].astype(np.float64), c[context].astype(np.float64), got[1].astype(np.float64)


def bucket_of(c: np.ndarray) -> np.ndarray:
    """Context-frequency bucket: 0 for unseen, else by powers of two."""
    return np.where(c > 0, np.minimum(1 + np.log2(np.maximum(c, 1)).astype(np.int64), BUCKETS - 1), 0)


HISTOGRAM = "bucket int, b2 int, b1 int, n bigint, p2 double, p1 double"


def _cell(p: np.ndarray, cells: int) -> np.ndarray:
    return np.where(p > 0, 1 + np.minimum((-4 * np.log2(np.maximum(p, 1e-300))).astype(np.int64), cells - 2), 0)


def _histogram(docs: DataFrame, answers: DataFrame, main_tokens: int) -> DataFrame:
    """Events of the deleted tenth by context bucket and quarter powers of two
    of both estimates."""
    def run(key, left, right):
        names = ["bucket", "b2", "b1", "n", "p2", "p1"]
        if not left.num_rows:
            return pa.table({k: [] for k in names})
        _, cw, cv, cvw = _counts(left["text"].combine_chunks(), right, "main")
        p2 = np.divide(cvw, cv, out=np.zeros_like(cvw), where=cv > 0)
        p1 = cw / max(main_tokens, 1)
        cell = (bucket_of(cv) * 128 + _cell(p2, 128)) * 256 + _cell(p1, 256)
        uniq, inv = np.unique(cell, return_inverse=True)
        inv = inv.ravel()
        return pa.table({"bucket": pa.array((uniq // 32768).astype(np.int32)),
                         "b2": pa.array((uniq // 256 % 128).astype(np.int32)),
                         "b1": pa.array((uniq % 256).astype(np.int32)), "n": np.bincount(inv),
                         "p2": np.bincount(inv, p2), "p1": np.bincount(inv, p1)})

    each = (docs.groupBy("chunk", "fold").cogroup(answers.groupBy("chunk", "fold"))
            .applyInArrow(run, HISTOGRAM))
    return each.groupBy("bucket", "b2", "b1").agg(F.sum("n").alias("n"), F.sum("p2").alias("p2"),
                                                  F.sum("p1").alias("p1"))


def learn_weights(cells: list[tuple], floor: float, steps: int = EM_STEPS) -> np.ndarray:
    """(BUCKETS, 3) mixture weights of bigram, unigram and floor by
    expectation-maximisation over (bucket, n, mean p2, mean p1). A bucket
    without events takes the weights of all events together."""
    def em(rows):
        n, p = rows[:, 1], np.stack([rows[:, 2], rows[:, 3], np.full(len(rows), floor)], 1)
        w = np.full(3, 1 / 3)
        for _ in range(steps):
            q = p * w
            q /= q.sum(1, keepdims=True)
            w = (q * n[:, None]).sum(0) / n.sum()
        return w

    out = np.tile([0.0, 0.0, 1.0], (BUCKETS, 1))
    if cells:
        rows = np.array(cells, np.float64)
        out[:] = em(rows)
        for b in range(BUCKETS):
            own = rows[rows[:, 0] == b]
            if len(own):
                out[b] = em(own)
    out[0, 0] = 0.0  # an unseen context has no bigram estimate
    out[:, 2] = np.maximum(out[:, 2], 1e-6)
    return out / out.sum(1, keepdims=True)


SCORES = ("doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
          "base_score double, score double")


def _scores(docs: DataFrame, answers: DataFrame, weights: np.ndarray, n_words: int, n_tokens: int) -> DataFrame:
    def run(key, left, right):
        if not left.num_rows:
            return pa.table({k.split()[0]: [] for k in SCORES.split(", ")})
        size, cw, cv, cvw = _counts(left["text"].combine_chunks(), right, "every")
        w = weights[bucket_of(cv)]
        p = w[:, 0] * np.divide(cvw, cv, out=np.zeros_like(cvw), where=cv > 0) \
            + w[:, 1] * (cw / max(n_tokens, 1)) + w[:, 2] / (n_words + 1)
        base = np.log10((cw + 0.1) / (n_tokens + 0.1 * (n_words + 1)))
        at = np.cumsum(size) - size  # every row has a token: its end
        return pa.table({
            "doc_id": left["doc_id"], "held_out": pa.array(left["fold"].to_numpy() == HELD_OUT),
            "n_tokens": pa.array(size), "n_known": pa.array(np.add.reduceat((cw > 0).astype(np.int64), at)),
            "train_tokens": pa.array(np.full(len(size), n_tokens)),
            "base_score": pa.array(np.add.reduceat(base, at)),
            "score": pa.array(np.add.reduceat(np.log10(p), at))})

    return (docs.groupBy("chunk", "fold").cogroup(answers.groupBy("chunk", "fold")).applyInArrow(run, SCORES))


def score_documents(docs: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per document: the contract's base score and the model's log10
    probability of the text."""
    rows = texts(docs)
    total, count = rows.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    total = total or 0
    per_chunk = max(1, int(chunk_bytes * count / max(total, 1)))
    bits = min(MAX_BITS, max(MIN_BITS, math.ceil(math.log2(max(1, 2 * total / RANGE_BYTES)))))
    rows = rows.select("rid", "doc_id", fold(F.col("doc_id")).alias("fold"),
                       F.floor(F.col("rid") / F.lit(per_chunk)).cast("bigint").alias("chunk"), "text")
    answers = stage_table(_answers(_requests(rows, bits), bits), "lm-counts")
    n_words, n_tokens, main_tokens = [x or 0 for x in answers.filter("chunk IS NULL AND kind = 0").agg(
        F.sum("words"), F.sum("tokens"), F.sum("main_tokens")).first()]
    told = answers.filter("chunk IS NOT NULL")
    deleted = _histogram(rows.filter(F.col("fold") == DELETED).select("chunk", "fold", "text"),
                         told.filter(F.col("fold") == DELETED).select("chunk", "fold", "kind", "range", "main"),
                         main_tokens)
    cells = [(r["bucket"], r["n"], r["p2"] / r["n"], r["p1"] / r["n"]) for r in deleted.collect()]
    weights = learn_weights(cells, 1 / (n_words + 1))
    return _scores(rows.select("doc_id", "chunk", "fold", "text"),
                   told.select("chunk", "fold", "kind", "range", "every"), weights, n_words, n_tokens)
