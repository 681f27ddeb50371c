import hashlib

import pytest

from emporia.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from tests.llm.conftest import ROWS

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def norm(text):
    return (text or "").translate(LOWER)


def expected(rows, best):
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    out = []
    for i, t in rows:
        ids = [x for x in groups[norm(t)] if x is not None]
        keep = best(ids) if ids else None
        out.append((i, keep, len(groups[norm(t)]), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("keep,best", [("largest", max), ("smallest", min)])
@pytest.mark.parametrize("run_bits,fan_bits", [(8, 4), (1, 1), (5, 2)])
def test_odd_rows(odd_docs, keep, best, run_bits, fan_bits):
    got = exact_duplicates(odd_docs, keep=keep, run_bits=run_bits, fan_bits=fan_bits)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(ROWS, best)


def test_hot_group(spark):
    rows = [(i, "Copy" if i % 3 == 0 else f"text {i % 500}") for i in range(3000)]
    got = exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, max)


def test_only_builtin_operators(odd_docs):
    plan = exact_duplicates(odd_docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_empty(no_docs):
    assert exact_duplicates(no_docs).count() == 0
    assert drop_exact_duplicates(no_docs).columns == no_docs.columns


def test_drop_keeps_one_row_and_all_columns(odd_docs):
    got = drop_exact_duplicates(odd_docs)
    assert got.columns == odd_docs.columns
    texts = [norm(r["text"]) for r in got.collect()]
    assert sorted(texts) == sorted({norm(t) for _, t in ROWS})
    kept = {norm(r["text"]): r["doc_id"] for r in got.collect()}
    assert kept[norm(ROWS[0][1])] == 2 and kept[""] == 5 and kept["twice the same"] == 13


def test_drop_with_repeated_rows_and_identifiers_like_null(spark):
    rows = [("null", "A"), (None, "a"), ("7", "b"), ("7", "B"), ("7", "c"), (None, "d"), (None, "d"), ("8", "e")]
    docs = spark.createDataFrame([(*r, k) for k, r in enumerate(rows)], "doc_id string, text string, n int")
    got = sorted((norm(r["text"]), r["doc_id"]) for r in drop_exact_duplicates(docs.repartition(3)).collect())
    assert got == [("a", "null"), ("b", "7"), ("c", "7"), ("d", None), ("e", "8")]


def test_drop_does_not_shuffle_texts_beside_few_copies(spark):
    docs = spark.createDataFrame([(i, f"text {i // 2}") for i in range(100)], "doc_id long, text string")
    got = drop_exact_duplicates(docs)
    assert sorted(r["doc_id"] for r in got.collect()) == list(range(1, 100, 2))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan
