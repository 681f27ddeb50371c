import math

import numpy as np
import pytest

from emporia.llm import embedding_dedup
from emporia.llm.embedding_dedup import bucket_keys, fast_hadamard, near_embeddings


def brute(rows, threshold=0.98):
    def usable(v):
        return v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    root, links = list(range(n)), [0] * n

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    order = sorted(range(n), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    rank = {k: p for p, k in enumerate(order)}
    for a in range(n):
        for b in range(a + 1, n):
            (i, v, x), (j, w, y) = rows[a], rows[b]
            if None in (i, j, x, y) or x != y or not usable(v) or not usable(w) or len(v) != len(w):
                continue
            v, w = (np.array(z, float) / max(map(abs, z)) for z in (v, w))
            if float(v @ w) / math.sqrt(float(v @ v) * float(w @ w)) >= threshold:
                links[a] += 1
                links[b] += 1
                p, q = find(a), find(b)
                if p != q:
                    lo, hi = (p, q) if rank[p] < rank[q] else (q, p)
                    root[hi] = lo
    return sorted([(rows[k][0], links[k], rows[find(k)][0], rows[k][0] == rows[find(k)][0]) for k in range(n)], key=str)


def groups(n, dim=64, seed=0, spread=0.015):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dim))
    return [(i, (centres[i % 6] + rng.normal(size=dim) * spread * 8 * (i % 4)).astype(np.float32).tolist(), i % 3)
            for i in range(n)]


def result(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows],
                                 "vec_id long, embedding array<float>, label int, rep string, n int, key int")


def test_groups_against_all_pairs(spark):
    rows = groups(300)
    assert result(near_embeddings(frame(spark, rows))) == brute(rows)


def test_blocks(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    monkeypatch.setattr(embedding_dedup, "STRIPE", 3)
    rows = groups(200, seed=2)
    assert result(near_embeddings(frame(spark, rows))) == brute(rows)


def test_odd_vectors(spark):
    one = [1.0, 2.0, 3.0, 4.0]
    rows = [(1, one, 0), (2, one, 0), (3, one, 1), (4, one, None), (None, one, 0), (5, [0.0] * 4, 0), (6, [0.0] * 4, 0),
            (7, None, 0), (8, [], 0), (9, [1.0, None, 3.0, 4.0], 0), (10, [1.0, math.nan, 3.0, 4.0], 0),
            (11, [math.inf, 2.0, 3.0, 4.0], 0), (12, [2.0, 4.0, 6.0, 8.0], 0), (13, [-1.0, -2.0, -3.0, -4.0], 0),
            (14, [1.0, 2.0, 3.0], 0), (15, [1e-38, 2e-38, 3e-38, 4e-38], 0), (16, [1e37, 2e37, 3e37, 4e37], 0),
            (17, [5.0], 0), (18, [7.0], 0), (19, [-7.0], 0), (20, one, 0), (20, one, 0)]
    rows = [(i, None if v is None else [None if x is None else float(np.float32(x)) for x in v], y) for i, v, y in rows]
    assert result(near_embeddings(frame(spark, rows))) == brute(rows)


def test_empty(spark):
    assert result(near_embeddings(frame(spark, groups(1)).limit(0))) == []


def test_hadamard_is_orthogonal():
    m = fast_hadamard(np.eye(16))
    assert np.array_equal(m @ m.T, 16 * np.eye(16)) and set(np.unique(m)) == {-1.0, 1.0}


@pytest.mark.parametrize("dim", [64, 48])
def test_recall_at_the_threshold(dim):
    """Random pairs exactly at cosine 0.98 share a bucket that is either's own."""
    rng = np.random.default_rng(5)
    a = rng.normal(size=(4000, dim))
    a /= np.linalg.norm(a, axis=1)[:, None]
    o = rng.normal(size=a.shape)
    o -= (o * a).sum(axis=1)[:, None] * a
    o /= np.linalg.norm(o, axis=1)[:, None]
    b = 0.98 * a + math.sqrt(1 - 0.98 ** 2) * o
    with np.errstate(over="ignore"):
        ka, kb = (bucket_keys(x, np.zeros(len(x), np.uint64), 10, 3, 2) for x in (a, b))
    met = (kb == ka[:, :, :1]).any(axis=2) | (ka == kb[:, :, :1]).any(axis=2)
    assert met.mean() > 0.7 and met.any(axis=1).all()


@pytest.mark.parametrize("dim", [2, 3, 4, 768])
def test_recall_in_other_dimensions(dim):
    from emporia.llm.embedding_dedup import MISS, pairs_at, tables_for

    n = 4000 if dim < 100 else 500
    tables = tables_for(dim, 0.98, 3, 2)
    with np.errstate(over="ignore"):
        ka, kb = (bucket_keys(x, np.zeros(n, np.uint64), tables, 3, 2) for x in pairs_at(0.98, n, dim, 9))
    met = (kb == ka[:, :, :1]).any(axis=2) | (ka == kb[:, :, :1]).any(axis=2)
    assert met.any(axis=1).all() and (1 - met.mean()) ** tables < 3 * MISS


def test_short_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = [(k, k % 2, [float(x) for x in rng.normal(size=2 + k % 3)]) for k in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    links = {i: 0 for i, _, _ in rows}
    for i, a, v in rows:
        for j, b, w in rows:
            if i != j and a == b and len(v) == len(w) and np.dot(v, w) >= 0.98 * np.linalg.norm(v) * np.linalg.norm(w):
                links[i] += 1
    assert {r["vec_id"]: r["n_links"] for r in near_embeddings(df).collect()} == links
