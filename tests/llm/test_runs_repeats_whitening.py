"""Periodic runs, repeated byte strings and whitening against plain versions."""

import hashlib
import random
import zlib

import numpy as np
import pytest

from riverbed.llm import periodic_runs, queries, suffix_dedup, whitening

DOCS = "doc_id bigint, text string, rid string, runs string, place int, gram string, spans int, twice string"


def table(spark, path, rows, schema, parts=3):
    spark.createDataFrame(rows, schema).repartition(parts).write.parquet(str(path))
    return spark.read.parquet(str(path))


def documents(spark, path, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return table(spark, path, [(i, t, "a", "b", 1, None, 2, "c") for i, t in zip(ids, texts, strict=True)], DOCS)


# -- periodic runs --------------------------------------------------------------
def plain_runs(s, least, exponent):
    """Every period, every stretch of equal words that far apart."""
    out = []
    for p in range(1, len(s) // 2 + 1):
        i = 0
        while i + p < len(s):
            j = i
            while j + p < len(s) and s[j] == s[j + p]:
                j += 1
            size = j - i + p
            if j > i and size >= max(least, exponent * p) and not any(
                    all(s[x] == s[x + q] for x in range(i, i + size - q)) for q in range(1, p)):
                out.append((i, size, p))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_runs_of_small_sequences():
    rnd = random.Random(5)
    many = []
    for _ in range(700):
        n, k = rnd.randrange(1, 50), rnd.choice([1, 2, 3, 6])
        s = [rnd.randrange(1, k + 1) for _ in range(n)]
        if rnd.random() < .4:
            p = rnd.randrange(1, n + 1)
            s = [s[i % p] for i in range(n)]
        many.append(s)
    for least, exponent in ((2, 2), (6, 3)):
        got = [[] for _ in many]
        for t, *r in periodic_runs.runs_of(many, least, exponent).tolist():
            got[t].append(tuple(r))
        assert got == [plain_runs(s, least, exponent) for s in many]


def test_extensions_are_common_prefixes():
    rnd = random.Random(6)
    texts = [[rnd.randrange(1, 3) for _ in range(n)] for n in (1, 2, 17, 40, 300)]
    tree = periodic_runs.SuffixForest(texts)
    tree.prepare()
    base = 0
    for s in texts:
        pairs = [(i, j) for i in range(len(s)) for j in range(i + 1, len(s))][:500]
        want = []
        for i, j in pairs:
            n = 0
            while j + n < len(s) and s[i + n] == s[j + n]:
                n += 1
            want.append(n)
        if pairs:
            i, j = np.array(pairs).T
            assert tree.common(base + i, base + j).tolist() == want
        base += len(s) + 1


def run_texts():
    rnd = random.Random(9)
    words = [f"w{i}" for i in range(40)] + ["é", "Ü", "x" * 300]
    out = [None, "", " \t\n", "a " * 500, "one two " * 40, "a b c " * 7, "a b c " * 8, ("a b c d " * 9) + "x " + ("d c " * 30)]
    for _ in range(150):
        t = [rnd.choice(words) for _ in range(rnd.randrange(0, 300))]
        if rnd.random() < .5:
            p = rnd.randrange(1, 40)
            block = [rnd.choice(words) for _ in range(p)]
            at = rnd.randrange(0, len(t) + 1)
            t[at:at] = (block * 40)[: rnd.randrange(1, 5 * p + 30)]
        out.append("  ".join(t) + "\n")
    return out + out[40:44]


def test_op11_against_plain_runs(spark, tmp_path):
    texts = run_texts()
    ids = [None if i == 60 else i for i in range(len(texts))]
    path = tmp_path / "sf"
    documents(spark, path / "documents.parquet", texts, ids)
    got = sorted(queries.op11_periodic_runs(spark, str(path)).collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"]))
    ids_, n_looped = sorted(range(len(texts)), key=lambda i: (ids[i] is not None, ids[i] or 0)), 0
    assert [r["doc_id"] for r in got] == [ids[i] for i in ids_]
    for r, i in zip(got, ids_, strict=True):
        s = (texts[i] or "").split()
        h = 1 if ids[i] is None else zlib.crc32(str(ids[i]).encode())
        if h % 10 == 0 and s:
            n_looped += 1
            n, g = len(s), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            s = [s[x if x < a else a + (x - a) % p] for x in range(n)]
        runs = plain_runs(s, 24, 3)
        kept = [w for x, w in enumerate(s) if not any(a + q <= x < a + m for a, m, q in runs)]
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None,) * 3
        assert r["n_runs"] == len(runs)
        assert (r["start"], r["length"], r["period"]) == best
        assert r["exponent_milli"] == (1000 * best[1] // best[2] if runs else None)
        assert r["runs_sha256"] == hashlib.sha256("".join(f"{a},{m},{q}\n" for a, m, q in runs).encode()).hexdigest()
        assert r["collapsed_sha256"] == hashlib.sha256(" ".join(kept).encode()).hexdigest()
    assert n_looped > 5 and sum(r["n_runs"] > 0 for r in got) > 40


def test_runs_of_an_empty_table_and_bad_exponent(spark, tmp_path):
    empty = documents(spark, tmp_path / "e", [])
    assert periodic_runs.periodic_runs(empty).collect() == []
    with pytest.raises(ValueError):
        periodic_runs.periodic_runs(empty, min_exponent=1)


def test_stretches_cut_in_small_forests(spark, tmp_path, monkeypatch):
    docs = documents(spark, tmp_path / "d", run_texts())
    want = sorted(map(tuple, periodic_runs.periodic_runs(docs).drop("rid").collect()), key=lambda r: r[0])
    monkeypatch.setattr(periodic_runs, "FOREST_WORDS", 50)
    rows = [t.split() for t in (x.encode() for x in run_texts() if x)]
    parts = [(r, 0, len(t)) for r, t in enumerate(rows)]
    found = periodic_runs._runs_of_rows(dict(enumerate(rows)), parts, 24, 3)
    assert len(found) == sum(len(r[2]) for r in want)


# -- repeated strings -----------------------------------------------------------
def plain_removal(texts, length):
    data = [(t or "").encode() for t in texts]
    places = {}
    for i, b in enumerate(data):
        for s in range(len(b) - length + 1):
            places.setdefault(b[s: s + length], []).append((i, s))
    gone = [np.zeros(len(b), bool) for b in data]
    for found in places.values():
        if len(found) > 1:
            for i, s in found:
                gone[i][s: s + length] = True
    return [(len(b), bytes(np.frombuffer(b, np.uint8)[~g]),
             int((np.diff(np.r_[0, g.astype(int)]) > 0).sum())) for b, g in zip(data, gone, strict=True)]


def repeat_texts(length, seed):
    rnd = random.Random(seed)
    letters = "abcdefgh é\n"

    def noise(n):
        return "".join(rnd.choice(letters) for _ in range(n))

    passage = noise(int(length * 2.5))
    out = [None, "", "x", "é" * 300, "ab" * 400, "a" * 900, "a" * 1300, "abc" * 100, passage + "1" + passage]
    for _ in range(100):
        t = noise(rnd.randrange(0, 4 * length))
        if rnd.random() < .6:
            a = rnd.randrange(len(passage))
            t += passage[a: rnd.randrange(a, len(passage) + 1)] + noise(rnd.randrange(0, length))
        out.append(t)
    return out + out[20:36]


@pytest.mark.parametrize("length,group,block", [(12, 1000, 1 << 18), (12, 2, 1 << 18), (40, 1000, 64), (200, 3, 300),
                                                (200, 1000, 1 << 18)])
def test_removal_against_all_windows(spark, tmp_path, monkeypatch, length, group, block):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    texts = repeat_texts(length, length + group)
    docs = documents(spark, tmp_path / "d", texts)
    got = {r["doc_id"]: r for r in suffix_dedup.remove_repeats(docs, length=length, group=group).collect()}
    for i, (n, kept, spans) in enumerate(plain_removal(texts, length)):
        assert (got[i]["n_bytes"], bytes(got[i]["kept"]), len(got[i]["spans"])) == (n, kept, spans), i


def test_op12_digests(spark, tmp_path):
    texts = repeat_texts(200, 3)
    ids = [None if i == 30 else i for i in range(len(texts))]
    documents(spark, tmp_path / "documents.parquet", texts, ids)
    got = sorted(map(tuple, queries.op12_suffix_dedup(spark, str(tmp_path)).collect()), key=str)
    want = [(ids[i], n, n - len(kept), spans, hashlib.sha256(kept).hexdigest())
            for i, (n, kept, spans) in enumerate(plain_removal(texts, 200))]
    assert got == sorted(want, key=str)


def test_hash_collisions_are_told_apart(monkeypatch):
    """With a hash that sees only a string's length, bytes decide."""
    data = np.frombuffer(b"aaaabbbbaaaacccc", np.uint8)
    suffixes = suffix_dedup.Suffixes(data, 4)
    suffixes.hashes = np.zeros(len(data) + 1, np.uint64)
    at = np.array([0, 4, 8, 12])
    same = suffix_dedup.repeated_windows(suffixes, at, np.zeros(4, np.int64), np.zeros(4, np.int64))
    assert same.tolist() == [True, False, True, False]


def test_suffix_sort_orders_windows():
    rnd = random.Random(2)
    data = np.array([rnd.randrange(97, 99) for _ in range(600)], np.uint8)
    suffixes, at = suffix_dedup.Suffixes(data, 20), np.array(rnd.sample(range(580), 300))
    size = np.repeat([1, 2, 7, 90, 200], [1, 2, 7, 90, 200])
    first = np.repeat([0, 1, 3, 10, 100], [1, 2, 7, 90, 200])
    got = suffixes.sort(at, first, size)
    for a, n in ((0, 1), (1, 2), (3, 7), (10, 90), (100, 200)):
        assert sorted(got[a: a + n]) == sorted(at[a: a + n])
        strings = [data[s: s + 20].tobytes() for s in got[a: a + n]]
        assert strings == sorted(strings)


def test_removal_of_an_empty_table(spark, tmp_path):
    assert suffix_dedup.remove_repeats(documents(spark, tmp_path / "e", [])).collect() == []


# -- whitening ------------------------------------------------------------------
VECTORS = "vec_id bigint, embedding array<float>, x string, component int, n string"


def vectors(spark, path, rows):
    return table(spark, path, [(i, v, "a", 1, None) for i, v in rows], VECTORS)


def test_whitening_against_dense_eigenvectors(spark, tmp_path):
    rng = np.random.default_rng(4)
    data = (rng.standard_normal((400, 20)) * np.linspace(.2, 1, 20)).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    rows += [(1000, None), (1001, [None] * 20), (1002, [float("nan")] * 20), (1003, [float("inf")] + [0.0] * 19),
             (1004, []), (1005, [1.0] * 3), (None, data[0].tolist()), (7, data[7].tolist())]
    vectors(spark, tmp_path / "embeddings.parquet", rows)
    got = queries.op13_whitening(spark, str(tmp_path)).collect()
    assert len(got) == 402 * 4 and {r["component"] for r in got} == {1, 2, 3, 4}
    x = np.floor(256 * data.astype(float))
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    c = fit - fit.mean(0)
    cov = c.T @ c / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:4], u[:, ::-1][:, :4]
    by = {(r["vec_id"], r["component"]): r for r in got}
    z = (x - fit.mean(0)) @ u / np.sqrt(e)
    turn = [np.sign(by[0, k + 1]["whitened"] * z[0, k]) for k in range(4)]
    for i in range(400):
        for k in range(4):
            r = by[i, k + 1]
            assert r["n"] == n
            assert r["deviation"] == sum((n * int(a) - int(b)) ** 2 for a, b in zip(x[i], s, strict=True))
            assert abs(r["whitened"] - turn[k] * z[i, k]) < 1e-9
            assert abs(r["explained"] - e[k] / np.trace(cov)) < 1e-12
            assert r["identity_error"] < 1e-10
    assert by[None, 1]["whitened"] == by[0, 1]["whitened"]


def test_whitening_of_little_data(spark, tmp_path):
    for k, rows in enumerate(([], [(1, [0.5, 1.0])], [(1, [0.5, 1.0]), (2, [0.5, 1.0])], [(1, None)])):
        assert whitening.whiten(vectors(spark, tmp_path / str(k), rows)).collect() == []
    flat = whitening.whiten(vectors(spark, tmp_path / "line", [(i, [float(i), 0.0, -2.0 * i]) for i in range(9)])).collect()
    assert {r["component"] for r in flat} == {1} and abs(flat[0]["explained"] - 1) < 1e-12
    huge = whitening.whiten(vectors(spark, tmp_path / "huge", [(1, [1e16, 0.0]), (2, [-1e16, 0.0]), (3, [0.0, 1.0])]))
    assert {r["vec_id"] for r in huge.filter("deviation IS NULL").collect()} == {1, 2}


@pytest.mark.parametrize("dim,rank", [(1, 1), (3, 3), (30, 30), (64, 64), (40, 2), (90, 90)])
def test_jacobi_davidson(dim, rank):
    rng = np.random.default_rng(dim)
    a = rng.standard_normal((300, rank)) @ rng.standard_normal((rank, dim))
    a = a.T @ a / 300
    e, u = whitening.jacobi_davidson(lambda b: a @ b, dim, 4)
    want = np.linalg.eigvalsh(a)[::-1][:4]
    assert np.abs(e - want).max() <= 1e-12 * want[0]
    assert np.linalg.norm(a @ u - u * e, axis=0).max() <= 1e-12 * want[0]
    assert np.abs(u.T @ u - np.eye(len(e))).max() < 1e-12
