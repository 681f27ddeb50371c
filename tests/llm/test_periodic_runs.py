import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from emporia.llm import periodic_runs
from emporia.llm.periodic_runs import Grammar, find_runs
from tests.llm.conftest import ROWS


def brute_runs(words, repeats=4, least=6):
    """All runs by comparing words q apart, for every q."""
    n, found = len(words), {}
    for q in range(1, n // repeats + 1):
        a = 0
        while a + q < n:
            b = a
            while b + q < n and words[b] == words[b + q]:
                b += 1
            if b > a and b + q - a >= max(least, repeats * q):
                found.setdefault((a, b + q), q)  # the smallest period of equal stretches
            a = max(b, a) + 1
    return sorted((a, b, q) for (a, b), q in found.items())


def sequence(rng):
    kind = rng.randrange(6)
    letters = rng.choice([1, 2, 3, 10, 1000])
    out = [rng.randrange(letters) for _ in range(rng.choice([0, 1, 5, 6, 40, 120]))]
    if kind == 1:  # nested repeats
        for _ in range(3):
            a = rng.randrange(len(out) + 1)
            b = min(len(out), a + rng.randrange(1, 12))
            out[a:b] = out[a:b] * rng.randrange(2, 9)
            out = out[:600]
    elif kind == 2:  # powers with a fraction
        piece = out[:rng.randrange(1, 20)]
        out = (out + piece * 9)[:len(out) + rng.randrange(6 * len(piece) + 1)]
    elif kind == 3:  # Fibonacci words
        a, b = [0], [0, 1]
        while len(b) < 200:
            a, b = b, b + a
        out = b * rng.choice([1, 4, 5])
    return out


@pytest.mark.parametrize("seed", range(12))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    texts = [sequence(rng) for _ in range(60)]
    texts += rng.choices(texts, k=20)  # copies share their symbols
    words = np.array([w for t in texts for w in t], np.int64)
    text = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    got = list(zip(*(x.tolist() for x in find_runs(words, text))))
    want, base = [], 0
    for t in texts:
        want += [(a + base, b + base, q) for a, b, q in brute_runs(t)]
        base += len(t)
    assert got == sorted(want, key=lambda r: (r[0], r[2]))


def test_equal_texts_are_one_symbol_and_rounds_are_few():
    rng = random.Random(1)
    one = [rng.randrange(50) for _ in range(3000)]
    words, text = np.array(one * 4), np.repeat(np.arange(4), 3000)
    grammar = Grammar(words, text)
    roots = grammar.length == 3000
    assert roots.sum() == 1 and (grammar.kinds == np.flatnonzero(roots)[0]).sum() == 4
    assert Grammar(np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)).count == 14
    for words in (np.zeros(100_001, np.int64), np.arange(100_000), np.arange(100_000) % 2, np.arange(100_000) // 300):
        assert Grammar(words, np.zeros(len(words), np.int64)).length.max() == len(words)


@pytest.mark.parametrize("n,q", [(300_000, 1), (300_000, 2), (300_001, 997), (300_000, 75_000), (300_000, 75_001)])
def test_one_very_long_run(n, q):
    words = np.arange(n) % q
    runs = list(zip(*find_runs(words, np.zeros(n, np.int64))))
    assert runs == ([(0, n, q)] if n >= 4 * q else [])


def test_equal_hashes_of_unequal_stretches(monkeypatch):
    """With a hash that calls everything equal the words decide."""
    rng = random.Random(8)
    real = periodic_runs.PrefixHash.equal

    def liar(self, a, b, n):
        return real(self, a, b, n) | (np.random.default_rng(1).random(len(a)) < 0.05)

    monkeypatch.setattr(periodic_runs.PrefixHash, "equal", liar)
    for _ in range(30):
        t = [0] * rng.randrange(9) + [rng.randrange(3) for _ in range(30)] + [4, 5] * 6
        assert list(zip(*find_runs(np.array(t), np.zeros(len(t), np.int64)))) == sorted(
            brute_runs(t), key=lambda r: (r[0], r[2]))


def looped(words, g):
    n = len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def row_of(text, g=None):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if g is not None and words:
        words = looped(words, g)
    runs = [(a, b - a, q) for a, b, q in sorted(brute_runs(words), key=lambda r: (r[0], r[2]))]
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    return len(words), runs, best, " ".join(w for i, w in enumerate(words) if i not in gone)


SMALL = [(i, t) for i, t in ROWS if len(t or "") < 100_000] + [
    (30, "a b " * 5), (31, "x" + " a" * 6 + "\x0bb\x0cc \r\n\x1c " + "é ü\t" * 8), (32, "a " * 5), (32, "a " * 7),
    (33, "1 2 3 4 " * 4 + "1 2 3"), (34, "\x85a\xa0 " * 9)]


@pytest.mark.parametrize("chunk_bytes", [periodic_runs.CHUNK_BYTES, 1])
def test_odd_rows(spark, no_docs, monkeypatch, chunk_bytes):
    monkeypatch.setattr(periodic_runs, "CHUNK_BYTES", chunk_bytes)
    docs = spark.createDataFrame([(*r, "x", 1) for r in SMALL], "doc_id long, text string, runs string, id int")
    got = periodic_runs.periodic_runs(docs)
    assert got.columns == ["doc_id", "n_words", "runs", "strongest", "collapsed"]
    rows = sorted(((r[0], r[1], [tuple(x) for x in r[2]], r[3] and tuple(r[3]), r[4]) for r in got.collect()), key=str)
    assert rows == sorted(((i, *row_of(t)) for i, t in SMALL), key=str)
    assert periodic_runs.periodic_runs(no_docs).count() == 0


def test_long_texts(odd_docs):
    rows = {r["doc_id"]: r for r in periodic_runs.periodic_runs(odd_docs.where("doc_id in (9, 10)")).collect()}
    text = dict(ROWS)
    assert all(r["runs"] == [] and r["strongest"] is None and r["collapsed"] == text[i] for i, r in rows.items())


def test_op11_against_brute_force(spark, sf_small):
    from emporia.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = QUERIES["op11_periodic_runs"](spark, sf_small)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    rows = got.collect()
    assert len(rows) == len(docs)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    looped_rows = 0
    for r in rows:
        h = zlib.crc32(str(r["doc_id"]).encode())
        n, runs, best, collapsed = row_of(docs[r["doc_id"]], h // 10 if h % 10 == 0 else None)
        looped_rows += bool(runs)
        best = best and (*best, 1000 * best[1] // best[2])
        assert tuple(r) == (r["doc_id"], len(runs), *(best or (None,) * 4),
                            sha("".join(f"{a},{b},{q}\n" for a, b, q in runs)), sha(collapsed))
    assert looped_rows > 5
    assert got.where(F.col("period") < 1).count() == 0
