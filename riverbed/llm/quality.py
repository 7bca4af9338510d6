"""Quality classifier by co-training on two views.

The text view sees content: style shares (letters, capitals, digits, marks,
line ends, repeated words, word length, size) and the presence of words that a
test on the sample ties to the label. The metadata view sees source, language
and size. Both are logistic models trained in numpy on a bounded sample of
labelled documents (``LABELLED``, one row per id). Which words the text view
sees is counted by Spark over that sample, so a row's features are bounded
whatever its text's size.

All unlabelled documents are the pool: features are written once. In each
of ``ROUNDS`` rounds tasks score all of them with both views; per view and class
the ``PER_ROUND`` surest texts from ``SURE`` on get that label and join the other
view's training set (equal texts count once). Then each view is calibrated on
labelled documents kept aside, and their log-odds add up, less the prior they
share.

A document is good when its quality is 1 and it is not toxic; it is kept when
its calibrated probability reaches ``THRESHOLD``. Every document is scored on
its whole text, as a column function: no shuffle, and all columns stay as they
are. Only ids of labelled documents are broadcast (at most LABELLED); the driver
holds the features of these and of the pseudo-labelled (at most
4 x ROUNDS x PER_ROUND).

Defined cases: NULL text is empty; NULL metadata is a value of its own; NULL
labels are not learned from, and their documents are in no pool; several labels
of a document count as their worst; of rows that share an id one is learned
from; without labels of both kinds all scores are 0.5 and all stay; repeated
rows get equal scores; an empty table gives an empty result. Columns the
metadata view wants but the table lacks count as NULL.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import NON_ALNUM, batches_by_bytes, row_of, stage_table, string_buffers, words

LABELLED = 6000
ROUNDS, PER_ROUND, SURE = 4, 300, 0.95
THRESHOLD = 0.5
WORD_BITS = 22
MAX_WORDS, MIN_ROWS, MIN_Z = 4096, 8, 5.0
META_SLOTS = 256

#: Byte classes of the style view: lower case and UTF-8 letters, capitals,
#: digits, spaces, line ends, '!' and '?', other marks, control bytes.
_CLASS = np.full(256, 7, np.uint8)
_CLASS[0x20:0x7F] = 6
_CLASS[0x80:] = 0
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58] = 0, 1, 2
_CLASS[[0x20, 0x09]], _CLASS[[0x0A, 0x0D]], _CLASS[[0x21, 0x3F]] = 3, 4, 5
#: Marks of ordinary prose.
_CLASS[[0x2C, 0x2E, 0x27, 0x2D, 0x3A, 0x3B, 0x28, 0x29]] = 8
STYLE = 13
#: Bytes whose classes are counted at once.
CLASS_BYTES = 1 << 18


def class_counts(data: np.ndarray, offs: np.ndarray, step: int = CLASS_BYTES) -> np.ndarray:
    """(rows, 9) bytes of each class, counted ``step`` bytes at a time: the
    counting takes 24 bytes of memory for each of them, whatever a row's size."""
    out = np.zeros((len(offs) - 1, 9), np.int64)
    for a in range(0, len(data), step):
        b = min(a + step, len(data))
        lo, hi = np.searchsorted(offs, a, "right") - 1, np.searchsorted(offs, b, "left")
        place = row_of(np.diff(np.clip(offs[lo: hi + 1], a, b))) * 9 + _CLASS[data[a:b]]
        out[lo:hi] += np.bincount(place, minlength=(hi - lo) * 9).reshape(-1, 9)
    return out


def style_features(column: pa.Array, h: np.ndarray, n: np.ndarray) -> np.ndarray:
    """(rows, STYLE) shares and sizes of whole texts."""
    data, offs = string_buffers(column)
    rows = len(n)
    size = np.diff(offs)
    kinds = class_counts(data, offs)
    out = np.zeros((rows, STYLE))
    out[:, :9] = kinds / np.maximum(size, 1)[:, None]
    row = row_of(n)
    again = np.zeros(len(h), bool)
    again[1:] = (h[1:] == h[:-1]) & (row[1:] == row[:-1])
    out[:, 9] = np.bincount(row, again, rows) / np.maximum(n, 1)
    out[:, 10] = np.log1p(size / np.maximum(n, 1))
    out[:, 11] = np.log1p(n)
    out[:, 12] = n == 0
    return out


def word_slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - WORD_BITS)).astype(np.int64)


def metadata_slots(docs: DataFrame) -> Column:
    """Slots of the metadata view: one per source, language and size step,
    by hash."""
    have = {c.lower() for c in docs.columns}
    values = [F.concat(F.lit(f"{c}="), F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0")))
              if c in have else F.lit(f"{c}=\0") for c in ("source", "lang")]
    size = F.floor(F.log2(F.col("n_chars").cast("double") + 1)) if "n_chars" in have else F.lit(None)
    values.append(F.concat(F.lit("size="), F.coalesce(size.cast("string"), F.lit("\0"))))
    return F.array(*[F.pmod(F.xxhash64(v), F.lit(META_SLOTS)).cast("int") for v in values])


# -- logistic models in numpy --------------------------------------------------------
@dataclass
class Linear:
    """Dense and present-slot weights of a logistic model."""
    dense: np.ndarray
    slots: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0

    def raw(self, dense: np.ndarray, row: np.ndarray, slot: np.ndarray) -> np.ndarray:
        z = np.bincount(row, self.slots[slot], len(dense)) if len(row) else np.zeros(len(dense))
        return dense @ self.dense + z + self.bias

    def logit(self, *x) -> np.ndarray:
        return self.scale * self.raw(*x) + self.shift


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_linear(dense, row, slot, n_slots: int, y, steps: int = 300, l2: float = 1e-3) -> Linear:
    """Full-batch Adam on the logistic loss, classes weighted alike."""
    pos = max(y.sum(), 1e-9)
    weight = np.where(y > 0.5, 0.5 / pos, 0.5 / max(len(y) - pos, 1e-9))
    params = [np.zeros(dense.shape[1]), np.zeros(n_slots), np.zeros(1)]
    m = [np.zeros_like(p) for p in params]
    v = [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        model = Linear(params[0], params[1], params[2][0])
        d = (_sigmoid(model.raw(dense, row, slot)) - y) * weight
        grads = [dense.T @ d + l2 * params[0], np.bincount(slot, d[row], n_slots) + l2 * params[1],
                 np.array([d.sum()])]
        for p, g, a, b in zip(params, grads, m, v, strict=True):
            a += 0.1 * (g - a)
            b += 0.01 * (g * g - b)
            p -= 0.1 * (a / (1 - 0.9 ** t)) / (np.sqrt(b / (1 - 0.99 ** t)) + 1e-8)
    return Linear(params[0], params[1], float(params[2][0]))


def calibrate(model: Linear, x, y: np.ndarray) -> None:
    """Platt scaling: two parameters on documents kept aside."""
    raw = model.raw(*x)
    spread = raw.std() or 1.0
    fitted = fit_platt(raw / spread, y)
    model.scale, model.shift = max(fitted[0], 0.0) / spread, fitted[1]


def fit_platt(z: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    a, b = 1.0, 0.0
    pos, neg = y.sum(), len(y) - y.sum()
    t = np.where(y > 0.5, (pos + 1) / (pos + 2), 1 / (neg + 2))
    for _ in range(steps):  # Newton with a little damping
        p = _sigmoid(a * z + b)
        w = np.maximum(p * (1 - p), 1e-9)
        g = np.array([((p - t) * z).sum(), (p - t).sum()])
        h = np.array([[(w * z * z).sum() + 1, (w * z).sum()], [(w * z).sum(), w.sum() + 1e-3]])
        step = np.clip(np.linalg.solve(h, g), -1, 1)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-9:
            break
    return float(a), float(b)


@dataclass
class Views:
    """Both trained views; ``word_slots`` are the text view's words, sorted."""
    text: Linear
    meta: Linear
    word_slots: np.ndarray
    mean: np.ndarray
    std: np.ndarray
    prior: float

    def combined(self, text_logit: np.ndarray, meta_logit: np.ndarray) -> np.ndarray:
        return _sigmoid(text_logit + meta_logit - self.prior)


# -- sample and pool -----------------------------------------------------------------
def _inputs(docs: DataFrame) -> DataFrame:
    """What both views see of a document, and a hash of it."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
                       metadata_slots(docs).alias("meta"))
    return rows.withColumn("same", F.xxhash64("text", "meta"))


def _labelled(docs: DataFrame, labels: DataFrame, labelled: int) -> DataFrame:
    """The bounded labelled sample, one row per id: inputs, y and whether the
    row is kept aside for calibration."""
    good = F.when((F.min("quality") == 1) & (F.max("toxic") == 0), 1).otherwise(0)
    marks = (labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL")
             .groupBy(F.col("doc_id").cast("bigint").alias("picked_id")).agg(good.alias("y")))
    order = F.xxhash64(F.lit(31), "picked_id")
    # At most a third from the documents to reject.
    some = (marks.filter("y = 1").orderBy(order, "picked_id").limit(labelled - labelled // 3)
            .unionByName(marks.filter("y = 0").orderBy(order, "picked_id").limit(labelled // 3)))
    rows = _inputs(docs).join(F.broadcast(some), F.col("doc_id") == F.col("picked_id"))  # at most ``labelled`` ids
    one = rows.groupBy("doc_id").agg(F.min_by(F.struct("text", "meta", "same", "y"), "same").alias("r"))
    return one.select("doc_id", "r.*", (F.pmod(F.xxhash64(F.lit(33), "doc_id"), F.lit(5)) == 0).alias("aside"))


def _chosen_words(sample: DataFrame) -> np.ndarray:
    """Slots of the words tied to the label, at most MAX_WORDS, sorted: the
    difference of two shares in standard errors."""
    def slots(batches):
        for whole in batches:
            for b in batches_by_bytes(whole, "text"):
                h, n = words(b.column("text"), NON_ALNUM)
                pair = np.unique((row_of(n).astype(np.int64) << WORD_BITS) | word_slots(h))
                yield pa.RecordBatch.from_arrays(
                    [pa.array((pair & ((1 << WORD_BITS) - 1)).astype(np.int32)),
                     b.column("y").take(pa.array(pair >> WORD_BITS))], ["slot", "y"])

    known = sample.filter("NOT aside")
    n1, n0 = known.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    counts = (known.select("text", "y").mapInArrow(slots, "slot int, y int").groupBy("slot")
              .agg(F.count_if(F.col("y") == 1).alias("c1"), F.count_if(F.col("y") == 0).alias("c0")))
    p = (F.col("c1") + F.col("c0")) / F.lit(max(n1 + n0, 1))
    spread = F.sqrt(F.greatest(p * (1 - p), F.lit(1e-12)) * F.lit(1 / max(n1, 1) + 1 / max(n0, 1)))
    z = F.abs(F.col("c1") / F.lit(max(n1, 1)) - F.col("c0") / F.lit(max(n0, 1))) / spread
    top = (counts.withColumn("z", z).filter((F.col("c1") + F.col("c0") >= MIN_ROWS) & (F.col("z") >= MIN_Z))
           .orderBy(F.col("z").desc(), "slot").limit(MAX_WORDS).select("slot").collect())
    return np.sort(np.array([r[0] for r in top], np.int64))


def _columns(slot: np.ndarray, row: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the chosen words present, each once."""
    if not len(chosen):
        none = np.zeros(0, np.int64)
        return none, none
    at = np.minimum(np.searchsorted(chosen, slot), len(chosen) - 1)
    has = np.flatnonzero(chosen[at] == slot)
    pair = np.unique(row[has] * len(chosen) + at[has])
    return pair // len(chosen), pair % len(chosen)


FEATURES = "style array<double>, cols array<int>"


def _features(rows: DataFrame, chosen: np.ndarray, keep: str) -> DataFrame:
    """``keep`` columns plus style and chosen words of the texts."""
    names = [c.split()[0] for c in keep.split(", ")]

    def run(batches):
        for whole in batches:
            for b in batches_by_bytes(whole, "text"):
                h, n = words(b.column("text"), NON_ALNUM)
                style = style_features(b.column("text"), h, n)
                row, col = _columns(word_slots(h), row_of(n), chosen)
                cut = np.searchsorted(row, np.arange(len(n) + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*[b.column(c) for c in names],
                     pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * STYLE),
                                              pa.array(style.ravel())),
                     pa.ListArray.from_arrays(pa.array(cut), pa.array(col.astype(np.int32)))],
                    [*names, "style", "cols"])

    return rows.select(*names, "text").mapInArrow(run, f"{keep}, {FEATURES}")


def _lists(column) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return row_of(np.diff(column.offsets.to_numpy())), column.flatten().to_numpy()


class Inputs:
    """Rows of features as both views take them."""

    def __init__(self, t, mean: np.ndarray | None = None, std: np.ndarray | None = None, known=None):
        style = _lists(t["style"])[1].reshape(-1, STYLE)
        self.mean = style[known].mean(0) if mean is None else mean
        self.std = style[known].std(0) + 1e-6 if std is None else std
        self.dense = np.clip((style - self.mean) / self.std, -8, 8)
        self.present = {"text": _lists(t["cols"]), "meta": _lists(t["meta"])}

    def of(self, view: str, mask=None):
        """One view's inputs of the rows in ``mask``."""
        row, col = self.present[view]
        dense = self.dense if view == "text" else self.dense[:, :0]
        if mask is None:
            return dense, row, col
        place, own = np.cumsum(mask) - 1, mask[row]
        return dense[mask], place[row[own]], col[own]


OTHER = {"text": "meta", "meta": "text"}


def train_views(docs: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Views | None:
    """Co-train on sample and pool; None when a class has too few labels."""
    sample = stage_table(_labelled(docs, labels, labelled), "quality-sample")
    chosen = _chosen_words(sample)
    t = _features(sample, chosen, "doc_id bigint, y int, aside boolean, meta array<int>").orderBy("doc_id").toArrow()
    t = t.combine_chunks()  # at most ``labelled`` rows of bounded size
    y = t["y"].to_numpy()
    aside = t["aside"].to_numpy()
    if min((y[~aside] == 1).sum(), (y[~aside] == 0).sum()) < 4 or not aside.any():
        return None
    base = Inputs(t, known=~aside)
    sizes = {"text": max(len(chosen), 1), "meta": META_SLOTS}
    held = {v: base.of(v, aside) for v in sizes}
    sets = {v: [(base.of(v, ~aside), y[~aside].astype(np.float64))] for v in sizes}

    def fit(view):
        model = fit_linear(*_joined([x for x, _ in sets[view]]), sizes[view], np.concatenate([z for _, z in sets[view]]),
                           l2=1e-3 if view == "text" else 1e-2)
        calibrate(model, held[view], y[aside])
        return model

    models = {v: fit(v) for v in sizes}
    marked = labels.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("marked_id"))
    pool = stage_table(_features(_inputs(docs), chosen, "doc_id bigint, same bigint, meta array<int>"), "quality-pool")
    taken = {v: set() for v in sizes}
    for _ in range(ROUNDS):
        picks = _surest(pool, marked, models, base.mean, base.std, taken)  # view -> [(same, label)]
        if not any(picks.values()):
            break
        rows = _pool_rows(pool, sorted({h for p in picks.values() for h, _ in p}))
        found = Inputs(rows, base.mean, base.std)
        at = {h: i for i, h in enumerate(rows["same"].to_pylist())}
        for teacher, chosen_rows in picks.items():
            pupil = OTHER[teacher]
            taken[pupil] |= {h for h, _ in chosen_rows}
            target = np.full(len(at), -1.0)
            target[[at[h] for h, _ in chosen_rows]] = [x for _, x in chosen_rows]
            if len(chosen_rows):
                sets[pupil].append((found.of(pupil, target >= 0), target[target >= 0]))
        models = {v: fit(v) for v in sizes}
    share = (y[aside].sum() + 1) / (aside.sum() + 2)
    return Views(models["text"], models["meta"], chosen, base.mean, base.std, float(np.log(share / (1 - share))))


def _joined(parts):
    """Inputs of several sets of rows, one after another."""
    dense = np.concatenate([d for d, _, _ in parts])
    at = np.cumsum([0, *[len(d) for d, _, _ in parts]])
    return (dense, np.concatenate([r + a for (_, r, _), a in zip(parts, at, strict=False)]),
            np.concatenate([c for _, _, c in parts]))


def _surest(pool: DataFrame, marked: DataFrame, models: dict, mean, std, taken: dict) -> dict:
    """Per teaching view the surest texts of the pool and their labels, without
    those that its pupil has: at most 2 x PER_ROUND. All of the pool is scored
    in tasks; documents with labels are taken out of the scores (an id and two
    numbers a row), and equal texts are one."""
    def run(batches):
        for b in batches:
            x = Inputs(b, mean, std)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("same"),
                 *[pa.array(_sigmoid(models[v].logit(*x.of(v)))) for v in ("text", "meta")]],
                ["doc_id", "same", "text", "meta"])

    scores = pool.mapInArrow(run, "doc_id bigint, same bigint, text double, meta double")
    sure = F.greatest(F.col("text"), 1 - F.col("text"), F.col("meta"), 1 - F.col("meta")) >= SURE
    scored = stage_table(scores.filter(sure).join(marked, F.col("doc_id") == F.col("marked_id"), "left_anti")
                         .groupBy("same").agg(F.max("text").alias("text"), F.max("meta").alias("meta")), "quality-scores")
    out = {}
    for view in ("text", "meta"):
        had, picks = taken[OTHER[view]], {}
        for label, sure in ((1.0, F.col(view)), (0.0, 1 - F.col(view))):
            top = (scored.select("same", sure.alias("sure")).filter(F.col("sure") >= SURE)
                   .orderBy(F.col("sure").desc(), "same").limit(PER_ROUND + len(had)).collect())
            for h in [r["same"] for r in top if r["same"] not in had][:PER_ROUND]:
                picks.setdefault(h, label)
        out[view] = list(picks.items())
    return out


def _pool_rows(pool: DataFrame, hashes: list[int]):
    """Features of the picked texts, one row each (at most 4 x PER_ROUND)."""
    want = pool.sparkSession.createDataFrame([(h,) for h in hashes], "want bigint")
    rows = pool.join(F.broadcast(want), F.col("same") == F.col("want"))
    one = rows.groupBy("same").agg(F.first(F.struct("meta", "style", "cols")).alias("r"))
    return one.select("same", "r.*").orderBy("same").toArrow().combine_chunks()


# -- scoring --------------------------------------------------------------------------
def score_column(views: Views | None, docs: DataFrame) -> Column:
    """struct(score, text, meta): calibrated probabilities that a document is
    good, combined and by view."""
    if views is None:
        half = F.lit(0.5)
        return F.struct(half.alias("score"), half.alias("text"), half.alias("meta"))

    @F.arrow_udf("struct<score double, text double, meta double>")
    def score(text: pa.Array, meta: pa.Array) -> pa.Array:
        out = []
        b = pa.RecordBatch.from_arrays([text, meta], ["text", "meta"])
        for part in batches_by_bytes(b, "text"):
            h, n = words(part.column("text"), NON_ALNUM)
            style = np.clip((style_features(part.column("text"), h, n) - views.mean) / views.std, -8, 8)
            row, col = _columns(word_slots(h), row_of(n), views.word_slots)
            t = views.text.logit(style, row, col)
            m_col = part.column("meta")
            m_row = row_of(np.diff(m_col.offsets.to_numpy()))
            m = views.meta.logit(np.zeros((len(n), 0)), m_row, m_col.flatten().to_numpy())
            out.append((views.combined(t, m), _sigmoid(t), _sigmoid(m)))
        cols = [np.concatenate([o[i] for o in out]) if out else np.zeros(0) for i in range(3)]
        return pa.StructArray.from_arrays([pa.array(c) for c in cols], ["score", "text", "meta"])

    return score(F.coalesce(F.col("text"), F.lit("")), metadata_slots(docs))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, kept, score and the two views' own
    probabilities."""
    s = score_column(train_views(docs, labels), docs)
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), s.alias("s"))
            .select("doc_id", (F.col("s.score") >= threshold).alias("kept"), F.col("s.score").alias("score"),
                    F.col("s.text").alias("text_score"), F.col("s.meta").alias("meta_score")))


def drop_low_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that are kept, all columns as they were."""
    s = score_column(train_views(docs, labels), docs)
    return docs.withColumn("__quality", s).filter(F.col("__quality.score") >= threshold).drop("__quality")
