"""License scan by a positional rare-token index.

The templates (license notices, file headers and whole short licenses) are
indexed by their rare words: for each template the words of highest inverse
document frequency, counted over the scanned corpus itself, with their
positions. A file's words are looked up in that index; each hit votes for
(template, start), its own position less the template's. Votes are intersected
by relative position with a tolerance: starts that lie within a template's slack
(words put in, left out or changed on the way) count together, each rare word of
the template once. Where enough of the rare weight stands, the template is
aligned with the text there (longest common subsequence weighted by IDF), and its
mandatory key phrases must stand word for word near their places. The score is
the share of the template's IDF weight that the alignment finds.

Two passes over the texts without a shuffle of them: document counts of the
templates' vocabulary (a few hundred words, added up per task), then the scan.
The index holds a few hundred postings, whatever the corpus.

Defined cases: NULL text is empty and gives zero words, no labels and score 0;
repeated rows give repeated results; a NULL id is kept; only the id and text
columns are read; very long texts are hashed in bounded slices.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riverbed.llm.common import NON_ALNUM, batches_by_bytes, row_of, words

#: Base phrases and their labels.
BASE_PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
#: License notices (label, notice, mandatory key phrases).
TEMPLATES = [
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3",
     ["gnu general public license version 3"]),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2",
     ["gnu general public license version 2"]),
    ("gpl-or-later", "you can redistribute it and or modify it under the terms of the gnu general public "
     "license as published by the free software foundation either version 3 of the license or at your "
     "option any later version", ["gnu general public license as published by the free software foundation"]),
    ("lgpl", "licensed under the gnu lesser general public license version 3",
     ["gnu lesser general public license"]),
    ("agpl", "licensed under the gnu affero general public license version 3",
     ["gnu affero general public license"]),
    ("apache-2.0", "licensed under the apache license version 2 0", ["apache license version 2 0"]),
    ("apache-2.0-header", "licensed under the apache license version 2 0 the license you may not use this "
     "file except in compliance with the license you may obtain a copy of the license at",
     ["apache license version 2 0", "except in compliance with the license"]),
    ("mit-notice", "released under the mit license", ["mit license"]),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this "
     "software and associated documentation files the software to deal in the software without restriction",
     ["permission is hereby granted free of charge", "without restriction"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met",
     ["redistribution and use in source and binary forms", "following conditions are met"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without "
     "fee is hereby granted", ["permission to use copy modify", "with or without fee is hereby granted"]),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
     ["mozilla public license v 2 0"]),
    ("cc-by-4.0", "licensed under cc by 4 0", ["cc by 4 0"]),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ["cc by sa 4 0"]),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ["cc by nc 4 0"]),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", ["cc by nd 4 0"]),
    ("cc0", "this work has been dedicated to the public domain under cc0 1 0", ["public domain under cc0"]),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     ["free and unencumbered software"]),
    # Whole texts.
    ("mit-text", "permission is hereby granted free of charge to any person obtaining a copy of this software "
     "and associated documentation files the software to deal in the software without restriction including "
     "without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies "
     "of the software and to permit persons to whom the software is furnished to do so subject to the "
     "following conditions the above copyright notice and this permission notice shall be included in all "
     "copies or substantial portions of the software the software is provided as is without warranty of any "
     "kind express or implied including but not limited to the warranties of merchantability fitness for a "
     "particular purpose and noninfringement in no event shall the authors or copyright holders be liable for "
     "any claim damages or other liability whether in an action of contract tort or otherwise arising from out "
     "of or in connection with the software or the use or other dealings in the software",
     ["permission is hereby granted", "substantial portions of the software"]),
    ("bsd-2-text", "redistribution and use in source and binary forms with or without modification are permitted "
     "provided that the following conditions are met redistributions of source code must retain the above "
     "copyright notice this list of conditions and the following disclaimer redistributions in binary form must "
     "reproduce the above copyright notice this list of conditions and the following disclaimer in the "
     "documentation and or other materials provided with the distribution",
     ["redistributions of source code must retain", "redistributions in binary form must reproduce"]),
    ("bsd-disclaimer", "this software is provided by the copyright holders and contributors as is and any express "
     "or implied warranties including but not limited to the implied warranties of merchantability and fitness "
     "for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable "
     "for any direct indirect incidental special exemplary or consequential damages including but not limited to "
     "procurement of substitute goods or services loss of use data or profits or business interruption however "
     "caused and on any theory of liability whether in contract strict liability or tort including negligence or "
     "otherwise arising in any way out of the use of this software even if advised of the possibility of such "
     "damage", ["procurement of substitute goods or services", "advised of the possibility of such damage"]),
    ("bsd-3-endorse", "neither the name of the copyright holder nor the names of its contributors may be used to "
     "endorse or promote products derived from this software without specific prior written permission",
     ["endorse or promote products derived from this software"]),
    ("isc-text", "permission to use copy modify and or distribute this software for any purpose with or without "
     "fee is hereby granted provided that the above copyright notice and this permission notice appear in all "
     "copies the software is provided as is and the author disclaims all warranties with regard to this software "
     "including all implied warranties of merchantability and fitness in no event shall the author be liable for "
     "any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use "
     "data or profits whether in an action of contract negligence or other tortious action arising out of or in "
     "connection with the use or performance of this software",
     ["fee is hereby granted", "the author disclaims all warranties"]),
    ("zlib-text", "this software is provided as is without any express or implied warranty in no event will the "
     "authors be held liable for any damages arising from the use of this software permission is granted to "
     "anyone to use this software for any purpose including commercial applications and to alter it and "
     "redistribute it freely subject to the following restrictions the origin of this software must not be "
     "misrepresented you must not claim that you wrote the original software",
     ["the origin of this software must not be misrepresented"]),
    ("gpl-warranty", "this program is distributed in the hope that it will be useful but without any warranty "
     "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu "
     "general public license for more details", ["in the hope that it will be useful"]),
    ("apache-2.0-limits", "unless required by applicable law or agreed to in writing software distributed under "
     "the license is distributed on an as is basis without warranties or conditions of any kind either express "
     "or implied see the license for the specific language governing permissions and limitations under the "
     "license", ["specific language governing permissions and limitations"]),
]
MIN_RARE_SHARE = 0.6  # of the rare words' weight must stand within the slack
MIN_SCORE = 0.7       # of the template's weight must be aligned


def rare_words(n: int) -> int:
    """How many words of a template of n are indexed."""
    return max(4, n // 8)


def slack(n: int) -> int:
    """By how many words places may move against a template of n words."""
    return max(2, n // 8)


def _hash(phrase: str) -> np.ndarray:
    return words(pa.array([phrase]), NON_ALNUM)[0]


@dataclass
class LicenseIndex:
    """Postings by word hash, and what verification needs."""
    labels: list[str]
    words: list[np.ndarray]            # word hashes of each template
    weight: list[np.ndarray]           # IDF of each of its words
    keys: list[list[tuple[int, np.ndarray]]]  # (place, hashes) of key phrases
    rare_weight: np.ndarray            # sum of the weights of its rare words
    slack: np.ndarray
    post_key: np.ndarray
    post_template: np.ndarray
    post_place: np.ndarray
    post_weight: np.ndarray


def vocabulary(templates=TEMPLATES) -> np.ndarray:
    """Hashes of the templates' words, sorted."""
    return np.unique(np.concatenate([_hash(t) for _, t, _ in templates]))


def document_counts(docs: DataFrame, templates=TEMPLATES, text_col: str = "text") -> tuple[int, dict[int, int]]:
    """(documents, documents that hold it by word) of the templates' words."""
    vocab = vocabulary(templates)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, rows = np.zeros(len(vocab), np.int64), 0
        for whole in batches:
            for b in batches_by_bytes(whole, "text"):
                h, counts = words(b.column("text"), NON_ALNUM)
                at = np.minimum(np.searchsorted(vocab, h), len(vocab) - 1)
                hit = np.flatnonzero(vocab[at] == h)
                pair = np.unique(row_of(counts)[hit] * len(vocab) + at[hit])
                found += np.bincount(pair % len(vocab), minlength=len(vocab))
                rows += b.num_rows
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[vocab.view(np.int64), -1]), pa.array(np.r_[found, rows]),
                                          pa.array(np.r_[np.zeros(len(vocab), bool), True])], ["word", "n", "all"])

    text = docs.select(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    got = (text.mapInArrow(run, "word bigint, n bigint, all boolean").groupBy("word", "all")
           .agg(F.sum("n").alias("n")).collect())  # a row per word of the templates
    total = sum(r["n"] for r in got if r["all"])
    return total, {r["word"] % (1 << 64): r["n"] for r in got if not r["all"]}


def build_index(templates=TEMPLATES, n_docs: int = 0, df: dict[int, int] | None = None) -> LicenseIndex:
    """The index of templates for a corpus of ``n_docs`` documents, ``df`` of
    which hold each word."""
    hashed = [_hash(t) for _, t, _ in templates]
    df = df or {}
    idf = lambda w: float(np.log((2 + n_docs) / (1 + df.get(w, 0))))
    weight = [np.array([idf(w) for w in h.tolist()]) for h in hashed]
    posts, rare_weight, keys = [], [], []
    for t, (h, wt) in enumerate(zip(hashed, weight, strict=True)):
        order = np.lexsort((np.arange(len(h)), -wt))[:rare_words(len(h))]
        posts += [(int(h[i]), t, int(i), float(wt[i])) for i in order]
        rare_weight.append(float(wt[order].sum()))
        places = []
        for phrase in templates[t][2]:
            k = _hash(phrase)
            at = [i for i in range(len(h) - len(k) + 1) if (h[i: i + len(k)] == k).all()]
            if not at:
                raise ValueError(f"key phrase {phrase!r} is not in its template")
            places.append((at[0], k))
        keys.append(places)
    posts.sort()
    cols = list(zip(*posts, strict=True))
    return LicenseIndex([t[0] for t in templates], hashed, weight, keys, np.array(rare_weight),
                        np.array([slack(len(h)) for h in hashed]), np.array(cols[0], np.uint64),
                        np.array(cols[1]), np.array(cols[2]), np.array(cols[3]))


def aligned(template: np.ndarray, weight: np.ndarray, text: np.ndarray) -> float:
    """Weight of the heaviest common subsequence of template and text."""
    best = np.zeros(len(text) + 1)
    for w, x in zip(template, weight, strict=True):
        best[1:] = np.maximum(best[1:], best[:-1] + np.where(text == w, x, 0.0))
        np.maximum.accumulate(best, out=best)
    return float(best[-1])


def template_matches(h: np.ndarray, counts: np.ndarray, index: LicenseIndex):
    """(row, template, start, score, verified) of every place where enough
    rare words of a template stand within its slack."""
    ends = np.cumsum(counts)
    begins = ends - counts
    none = np.zeros(0, np.int64)
    lo = np.searchsorted(index.post_key, h, "left")
    at = np.flatnonzero(index.post_key[np.minimum(lo, len(index.post_key) - 1)] == h)
    if not len(at):
        return none, none, none, none.astype(float), none.astype(bool)
    n = np.searchsorted(index.post_key, h[at], "right") - lo[at]
    word = np.repeat(at, n)
    post = np.repeat(lo[at], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    template = index.post_template[post]
    row = np.searchsorted(ends, word, "right")
    start = word - index.post_place[post] - begins[row]
    # Cells twice the slack wide on two grids half a cell apart: starts within
    # the slack of each other share a cell. A rare word counts once in a cell.
    width = 2 * index.slack[template]
    cells = np.concatenate([np.stack([row, template, 2 * np.floor_divide(start + shift * width // 2, width) + shift], 1)
                            for shift in (0, 1)])
    post2, start2 = np.tile(post, 2), np.tile(start, 2)
    uniq, cell = np.unique(cells, axis=0, return_inverse=True)
    cell = cell.ravel()
    once = np.unique(cell * len(index.post_key) + post2)
    rare = np.bincount(once // len(index.post_key), index.post_weight[once % len(index.post_key)], len(uniq))
    full = rare >= MIN_RARE_SHARE * index.rare_weight[uniq[:, 1]] - 1e-9
    pick = full[cell]
    # Where a cell's votes agree most its template begins.
    votes, count = np.unique(np.stack([cell[pick], start2[pick]], 1), axis=0, return_counts=True)
    order = np.lexsort((votes[:, 1], -count, votes[:, 0]))
    votes = votes[order]
    votes = votes[np.r_[True, votes[1:, 0] != votes[:-1, 0]]] if len(votes) else votes
    found = np.unique(np.column_stack([uniq[votes[:, 0], :2], votes[:, 1]]), axis=0)
    score, verified = np.zeros(len(found)), np.zeros(len(found), bool)
    for i, (r, t, s) in enumerate(found.tolist()):  # few: places that passed the intersection
        tw, give = index.words[t], int(index.slack[t])
        a = max(s - give, 0)
        text = h[begins[r] + a: min(begins[r] + s + len(tw) + give, ends[r])]
        score[i] = aligned(tw, index.weight[t], text) / index.weight[t].sum()
        near = all(len(at := phrase_starts(text, np.array([len(text)]), k)[1]) and np.abs(at + a - s - p).min() <= give
                   for p, k in index.keys[t])
        verified[i] = near and score[i] >= MIN_SCORE
    return found[:, 0], found[:, 1], found[:, 2], score, verified


def phrase_starts(h: np.ndarray, counts: np.ndarray, phrase: np.ndarray):
    """(row, word number in the row) of every place of a phrase."""
    k, n = len(phrase), len(h)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.flatnonzero(h[: n - k + 1] == phrase[0])
    for j in range(1, k):
        at = at[h[at + j] == phrase[j]]
    ends = np.cumsum(counts)
    row = np.searchsorted(ends, at, "right")
    ok = at + k <= ends[row]
    return row[ok], at[ok] - (ends - counts)[row[ok]]


SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
          "base_labels string, labels string, score double")


def scan_licenses(docs: DataFrame, templates=TEMPLATES, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per document: number of words, places of the base phrases,
    labels of base phrases and verified templates, score of the best template
    start (0.5 at least where a base phrase stands)."""
    index = build_index(templates, *document_counts(docs, templates, text_col))
    phrases = [(_hash(p), label) for p, label in BASE_PHRASES.items()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in batches_by_bytes(whole, "text"):
                yield scan_batch(b)

    def scan_batch(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = b.num_rows
        h, counts = words(b.column("text"), NON_ALNUM)
        n_base = np.zeros(rows, np.int64)
        first, last = np.full(rows, np.iinfo(np.int64).max), np.full(rows, -1, np.int64)
        base = defaultdict(set)
        for p, label in phrases:
            r, s = phrase_starts(h, counts, p)
            np.add.at(n_base, r, 1)
            np.minimum.at(first, r, s)
            np.maximum.at(last, r, s)
            for x in np.unique(r).tolist():
                base[x].add(label)
        found = defaultdict(set)
        score = np.where(n_base > 0, 0.5, 0.0)
        r, t, _, sc, ok = template_matches(h, counts, index)
        np.maximum.at(score, r, np.minimum(sc, 1.0))
        for x, y in zip(r[ok].tolist(), t[ok].tolist(), strict=True):
            found[x].add(index.labels[y])
        blank = n_base == 0
        return pa.RecordBatch.from_arrays([
            b.column("doc_id"), pa.array(counts), pa.array(n_base),
            pa.array(first, mask=blank), pa.array(last, mask=blank),
            pa.array([",".join(sorted(base.get(i, ()))) for i in range(rows)], pa.string()),
            pa.array([",".join(sorted(base.get(i, set()) | found.get(i, set()))) for i in range(rows)],
                     pa.string()), pa.array(score)],
            ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")).mapInArrow(scan, SCHEMA)


def brute_force(text: str | None) -> dict:
    """The base columns of one text by plain scanning, for tests."""
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    hits = [(i, label) for p, label in BASE_PHRASES.items()
            for i in range(len(w)) if w[i: i + len(p.split())] == p.split()]
    at = [i for i, _ in hits]
    return {"n_words": len(w), "n_base": len(hits), "first_word": min(at, default=None),
            "last_word": max(at, default=None), "base_labels": ",".join(sorted({x for _, x in hits}))}
