"""Whitening, pivot index and lexical search against brute force and on odd inputs."""

import math
import re
from fractions import Fraction

import numpy as np
import pytest
from conftest import SF_SMALL
from oracle_compare import compare, duck

from rosterline.llm import lexical as LX
from rosterline.llm import pivot_dedup as PD
from rosterline.llm import queries as Q
from rosterline.llm import whitening as WH

VECTORS = "vec_id long, embedding array<float>, label int, id string, node string, vector string"


def vector_frame(spark, rows):
    """Embeddings with columns whose names operators use inside."""
    return spark.createDataFrame([(i, v, label, "x", "y", "z") for i, v, label in rows], VECTORS)


def odd_vectors():
    nan, inf = float("nan"), float("inf")
    return [
        (1, [1.0, 0.0, 0.0], 0), (1, [1.0, 0.0, 0.0], 0), (2, [0.99, 0.01, 0.0], 0), (3, [1.0, 0.0, 0.0], 1), (4, None, 0),
        (5, [], 0), (6, [0.0, 0.0, 0.0], 0), (7, [1.0, None, 0.0], 0), (8, [nan, 1.0, 0.0], 0), (9, [inf, 1.0, 0.0], 0),
        (10, [5.0, 0.0, 0.0], None), (None, [3.0, 0.0, 0.0], 0), (None, [0.0, 0.0, 7.0], 2), (11, [0.0, 1.0, 0.0], 0),
        (12, [0.0, 1.0], 0), (13, [0.0, 2.0], 0), (14, [1e-30, 0.0, 0.0], 0), (0, [-1.0, 0.0, 0.5], 0),
    ]


@pytest.fixture(scope="module")
def odd(spark):
    return vector_frame(spark, odd_vectors())


# ---------------------------------------------------------------- 11


def test_bit_sliced_products_are_exact():
    rng = np.random.default_rng(3)
    for rows, dims, top in ((1, 1, 1), (63, 3, 2), (64, 5, 1 << 12), (200, 70, 1 << 41), (65, 2, 1)):
        x = rng.integers(0, top, (rows, dims))
        want = x.astype(object).T @ x.astype(object)
        assert (WH.bit_sliced_products(x) == want).all()


def brute_whitening(rows):
    good = [(i, v) for i, v, _ in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(Fraction(float(np.float32(c))) * 1024) + 100_000 for c in v] for _, v in good]
    n, dims = len(x), len(x[0])
    sums = [sum(r[j] for r in x) for j in range(dims)]
    off = [[n * r[j] - sums[j] for j in range(dims)] for r in x]
    cov = [[Fraction(sum(r[a] * r[b] for r in off), n**3) for b in range(dims)] for a in range(dims)]
    value, vector = np.linalg.eigh(np.array(cov, float))
    return [i for i, _ in good], n, [sum(c * c for c in r) for r in off], np.array(off, float) / n, value[::-1], vector[:, ::-1], float(sum(cov[a][a] for a in range(dims)))


def check_whitening(got, rows, most=8):
    ids, n, deviation, off, value, vector, trace = brute_whitening(rows)
    k = min(most, len(value))
    assert len(got) == len(ids) * k and {r.component for r in got} == set(range(1, k + 1))
    assert all(r.n == n for r in got) and len({r.identity_error for r in got}) == 1
    if len(set(ids)) == len(ids):
        by = {(r.vec_id, r.component): r for r in got}
        for c in range(k):
            col = [by[i, c + 1] for i in ids]
            assert [r.deviation for r in col] == [d if d < 2**63 else None for d in deviation]
            assert np.allclose([r.explained for r in col], max(value[c], 0) / trace, rtol=1e-6, atol=1e-12)
            if value[c] > 1e-9 * trace:
                want = off @ vector[:, c] / np.sqrt(value[c])
                have = np.array([r.whitened for r in col])
                assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-6


def test_whitening(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = Q.queries()["op11_bit_sliced_whitening"](spark, SF_SMALL).collect()
    check_whitening(got, rows)
    assert got[0].identity_error < 1e-6


def test_whitening_of_odd_vectors(spark, odd):
    got = WH.whiten(odd).collect()
    rows = [r for r in odd_vectors() if r[1] and len(r[1]) == 3]
    check_whitening(got, rows)
    assert sum(r.vec_id is None for r in got) == 6 and got[0].identity_error < 1e-6
    wide = [(i, [float(v) * 2**20, float(i), -5.0], 0) for i, v in enumerate(np.random.default_rng(1).normal(size=50))]
    check_whitening(WH.whiten(vector_frame(spark, wide)).collect(), wide)


def test_whitening_without_variance_or_rows(spark):
    same = WH.whiten(vector_frame(spark, [(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)])).collect()
    assert [(r.whitened, r.explained, r.identity_error, r.deviation) for r in same] == [(None, 0.0, None, 0)] * 4
    assert WH.whiten(vector_frame(spark, [])).collect() == []
    assert WH.whiten(vector_frame(spark, [(1, None, 0), (2, [float("nan")], 0)])).collect() == []


def test_blocks_do_not_change_the_scatter(spark, monkeypatch):
    table = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet")
    vectors = WH.vectors_of(table, "vec_id", "embedding")
    n, sums, products = WH.scatter(vectors)
    x = np.array([[math.floor(c * 1024) + 100_000 for c in r.vector] for r in vectors.collect()], object)
    assert n == len(x) and (np.array(sums, object) == x.sum(axis=0)).all() and (products == x.T @ x).all()


# ---------------------------------------------------------------- 13


def brute_links(rows, least=0.98):
    good = [k for k, (_, v, label) in enumerate(rows) if label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)]
    unit = {}
    for k in good:
        v = np.array(rows[k][1], np.float32).astype(float)
        v = v / np.abs(v).max()
        unit[k] = v / np.sqrt((v * v).sum())
    pairs = {(a, b) for a in good for b in good if a < b and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= least}
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    count = [0] * len(rows)
    for a, b in pairs:
        count[a] += 1
        count[b] += 1
        root[find(b)] = find(a)
    groups = {}
    for k in range(len(rows)):
        groups.setdefault(find(k), []).append(rows[k][0])
    out = []
    for k, (i, _, _) in enumerate(rows):
        ids = [x for x in groups[find(k)] if x is not None]
        least_id = min(ids, default=None)
        out.append((i, count[k], least_id, i == least_id))
    return sorted(out, key=str)


def near_rows(seed, groups, copies, dims=64, noise=0.012):
    rng, rows = np.random.default_rng(seed), []
    for g in range(groups):
        base = rng.normal(size=dims)
        base /= np.linalg.norm(base)
        for c in range(copies if g == 0 else 1 + g % 4):
            rows.append((len(rows), (base + noise * rng.normal(size=dims) * (c > 0)).astype(np.float32).tolist(), g % 3))
    return rows + [(len(rows) + k, rows[0][1], 0) for k in range(5)]


@pytest.mark.parametrize("block", [2048, 16])
def test_near_duplicate_vectors(spark, odd, block, monkeypatch):
    monkeypatch.setattr(PD, "BLOCK_ROWS", block)
    rows = near_rows(1, 120, 90)
    got = PD.near_duplicates(vector_frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_links(rows)
    assert sorted((tuple(r) for r in PD.near_duplicates(odd).collect()), key=str) == brute_links(odd_vectors())


def test_near_duplicate_query_and_empty_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()]
    got = Q.queries()["op13_pivot_dedup"](spark, SF_SMALL).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_links(rows)
    assert PD.near_duplicates(vector_frame(spark, [])).collect() == []


def test_recall_at_the_threshold(spark):
    """Pairs of a cosine just above 0.98 among unrelated vectors: the hardest links."""
    rng, rows = np.random.default_rng(5), []
    for k in range(1500):
        u, r = rng.normal(size=64), rng.normal(size=64)
        u /= np.linalg.norm(u)
        r -= (r @ u) * u
        v = 0.9801 * u + math.sqrt(1 - 0.9801**2) * r / np.linalg.norm(r)
        rows += [(2 * k, u.astype(np.float32).tolist(), 0), (2 * k + 1, v.astype(np.float32).tolist(), 0)]
    got = PD.near_duplicates(vector_frame(spark, rows)).where("n_links > 0").count()
    assert got >= 0.99 * len(rows)


# ---------------------------------------------------------------- 12

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, k):
    def terms(t):
        return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))

    listed = [(i, terms(t)) for i, t in docs]
    n_docs, length = sum(bool(v) for _, v in listed), sum(len(v) for _, v in listed)
    out = []
    for item, text in {(i, t) for i, t in items if t is not None}:
        weight = {}
        for t in set(terms(text)):
            df = sum(t in v for _, v in listed)
            weight[t] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
        scores = []
        for i, v in listed:
            m = 50 + (50 * len(v) * n_docs) // max(length, 1)
            score = sum(w * ((1_000_000_000 * v.count(t)) // (1000 * v.count(t) + 20 * m)) for t, w in weight.items() if t in v)
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out += [(item, r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


@pytest.mark.parametrize("chunk,block,k", [(16 << 20, 8 << 20, 50), (3000, 700, 3), (1, 1, 1)])
def test_lexical_search(spark, monkeypatch, chunk, block, k):
    monkeypatch.setattr(LX, "CHUNK_BYTES", chunk)
    monkeypatch.setattr(LX, "BLOCK_BYTES", block)
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(120)
    extra = [(1, "Alpha beta, alpha-beta été 42!"), (1, "Alpha beta, alpha-beta été 42!"), (None, "alpha beta"), (7001, None), (7002, ""), (7003, "... !?"), (7004, "gamma " * 3000)]
    more = spark.createDataFrame([(i, t, "x", "y", None, "z") for i, t in extra], "doc_id long, text string, lang string, source string, n_chars long, term string")
    both = docs.unionByName(more, allowMissingColumns=True)
    bench = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").limit(6)
    odd = [(900, "ALPHA été"), (900, "ALPHA été"), (901, None), (902, ""), (903, "nosuchwordatall"), (None, "beta gamma"), (904, "42 gamma"), (904, "beta")]
    items = bench.unionByName(spark.createDataFrame([(i, t, 1) for i, t in odd], "item_id long, text string, score int"), allowMissingColumns=True)
    want = brute_search([(r.doc_id, r.text) for r in both.collect()], [(r.item_id, r.text) for r in items.collect()], k)
    got = LX.search(both, items, k).collect()
    assert sorted((tuple(r) for r in got), key=str) == want


def test_lexical_search_of_empty_tables(spark):
    docs, bench = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    assert LX.search(docs.where("false"), bench).collect() == []
    assert LX.search(docs, bench.where("false")).collect() == []


def test_accumulators_are_limited_and_scores_exact():
    rng = np.random.default_rng(2)
    size, known = 4000, 12
    held = [np.sort(rng.choice(size, 5 * 2**t if 5 * 2**t < size else size, replace=False)) for t in range(known)]
    gain = [rng.integers(1, 10 ** (6 - t // 3), len(d)) for t, d in enumerate(held)]
    cut = np.r_[0, np.cumsum([len(d) for d in held])]
    lists = LX.Postings(cut, np.concatenate(held), np.concatenate(gain), np.array([g.max() for g in gain]), size)
    dense = np.zeros(size, np.int64)
    for d, g in zip(held, gain):
        dense[d] += g
    alive, total = LX.accumulate(lists, np.arange(known), 10, np.zeros(0, np.int64))
    assert len(alive) < size // 4 and (total == dense[alive]).all()
    assert sorted(total)[-10:] == sorted(dense)[-10:]


def test_search_matches_sql_on_the_next_scale(spark):
    sf = SF_SMALL.replace("0.001", "0.01")
    ok, said = compare(Q.queries()["op12_lexical_search"](spark, sf), duck(sf), Q.oracle_sql()["op12_lexical_search"])
    assert ok, said
