import random

import pytest
from pyspark.sql import functions as F

from emporia.llm import blocks, minhash_dedup
from emporia.llm.components import connected_components
from emporia.llm.minhash_dedup import bands_for, drop_near_duplicates, near_duplicates, shingle_set
from tests.llm.conftest import ROWS


def brute(rows, size, percent):
    """(n, component) by comparing all pairs; rows with a null id link with nothing."""
    sets = {i: shingle_set(t, size) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            common = len(sets[a] & sets[b])
            union = len(sets[a]) + len(sets[b]) - common
            if union and 100 * common >= percent * union:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted([(i, len(shingle_set(t, size)), None if i is None else find(i),
                    i is None or find(i) == i) for i, t in rows], key=str)


def variants(n, words=40, edits=8, seed=1):
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(edits)):
            own[rng.randrange(words)] = f"e{rng.randrange(50)}"
        rows.append((i, " ".join(own)))
    return rows


def result(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_odd_rows(odd_docs):
    got = near_duplicates(odd_docs, shingle=3, percent=85)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert result(got) == brute(ROWS, 3, 85)


def test_empty(no_docs):
    assert near_duplicates(no_docs).count() == 0
    assert drop_near_duplicates(no_docs).columns == no_docs.columns


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_group_of_near_copies_against_all_pairs(spark, size, percent):
    """Some copies are linked only through others, some not at all."""
    rows = variants(250) + [(1000 + i, f"other {i} text with words {i * 7} of its own") for i in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(near_duplicates(df, shingle=size, percent=percent)) == brute(rows, size, percent)


def test_bucket_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "BLOCK", 16)
    monkeypatch.setattr(minhash_dedup, "STRIPE", 5)
    rows = variants(150, seed=3)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(near_duplicates(df, shingle=3, percent=85)) == brute(rows, 3, 85)


def test_documents_against_all_pairs(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    assert result(near_duplicates(documents, shingle=3, percent=85)) == brute(rows, 3, 85)


def test_drop_keeps_columns_and_one_of_each_group(odd_docs):
    got = drop_near_duplicates(odd_docs, shingle=3, percent=85)
    assert got.columns == odd_docs.columns
    gone = {r[0] for r in brute(ROWS, 3, 85) if not r[3]}
    assert {r["doc_id"] for r in got.collect()} == {i for i, _ in ROWS} - gone


A, B, OTHER = ([f"{x}{i}" for i in range(60)] for x in "abo")
NEAR_A, NEAR_B = A[:59] + ["z"], B[:59] + ["z"]
REPEATED = [(1, A), (1, B), (2, NEAR_A), (3, NEAR_B), (2, OTHER), (5, OTHER[:59]), (6, A), (6, A), (7, NEAR_A[::-1])]


@pytest.mark.parametrize("order", [1, -1])
def test_identifiers_with_several_texts(spark, order):
    """Every text of an identifier has its own links, in any order of the rows;
    only the row whose text is a near copy goes."""
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in REPEATED][::order], "doc_id long, text string").coalesce(1)
    got = {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_duplicates(df, shingle=3, percent=85).collect()}
    assert got == {(1, 58, 1), (2, 58, 1), (3, 58, 1), (2, 58, 2), (5, 57, 2), (6, 58, 1), (7, 58, 7)}
    left = sorted(tuple(r) for r in drop_near_duplicates(df, shingle=3, percent=85).collect())
    assert left == sorted([(1, " ".join(A)), (1, " ".join(B)), (2, " ".join(OTHER)), (7, " ".join(NEAR_A[::-1]))])


def test_near_texts_of_one_identifier_leave_one(spark):
    df = spark.createDataFrame([(1, " ".join(A)), (1, " ".join(NEAR_A)), (2, " ".join(A))], "doc_id long, text string")
    assert len(drop_near_duplicates(df, shingle=3, percent=85).collect()) == 1
    assert {tuple(r) for r in near_duplicates(df, shingle=3, percent=85).collect()} == {(1, 58, 1, True), (2, 58, 1, False)}


def test_deal_apart_meets_all_but_the_inner_pairs(spark):
    m = spark.range(23).select(F.lit(5).cast("long").alias("key"), F.lit(9).alias("rest"), F.lit(14).alias("big"),
                               (F.col("id") >= 9).alias("inside"), F.col("id").alias("rep"))
    rows, met = blocks.deal_apart(m, 4).collect(), []
    for p, q in {(r["p"], r["q"]) for r in rows}:
        own = [r for r in rows if (r["p"], r["q"]) == (p, q)]
        one = [r["rep"] for r in own if p == q or not r["second"]]
        two = [r["rep"] for r in own if r["second"]]
        met += [(min(a, b), max(a, b)) for k, a in enumerate(one) for b in (one[k + 1:] if p == q else two)]
    assert sorted(met) == [(a, b) for a in range(9) for b in range(a + 1, 23)]


def test_bands_miss_little():
    for t in (0.8, 0.85, 0.95):
        rows, bands = bands_for(t, 1e-6)
        assert (1 - t ** rows) ** bands <= 1e-6


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 500 + i) for i in range(1, 80)] + [(7, 7), (None, 3), (900, 901)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in connected_components(df.union(df.select("b", "a"))).collect()}
    want = {i: 0 for i in range(101)} | {500 + i: 500 for i in range(80)} | {900: 900, 901: 900}
    assert got == want
    assert connected_components(df.limit(0)).count() == 0


def test_deal_blocks_meets_each_pair_once(spark):
    m = spark.range(23).select(F.lit(5).cast("long").alias("key"), F.lit(23).cast("long").alias("m"),
                               F.col("id").alias("rep"))
    rows = blocks.deal_blocks(m, 6).collect()
    met = []
    places = {(r["p"], r["q"]) for r in rows}
    for p, q in places:
        one = [r["rep"] for r in rows if (r["p"], r["q"]) == (p, q) and (p == q or not r["second"])]
        two = one if p == q else [r["rep"] for r in rows if (r["p"], r["q"]) == (p, q) and r["second"]]
        met += [(min(a, b), max(a, b)) for k, a in enumerate(one) for b in (one[k + 1:] if p == q else two)]
    assert sorted(met) == [(a, b) for a in range(23) for b in range(a + 1, 23)]
