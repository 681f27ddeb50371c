import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from emporia.llm import language_id, quality
from emporia.llm.common import bounded_sample
from emporia.llm.language_id import LanguageModel, fit_languages, grams, identify, keep_identified
from emporia.llm.queries import QUERIES
from emporia.llm.quality import bradley_terry, features, fit_quality, keep_good, score_quality
from tests.llm.conftest import LONG, ROWS

SF = "/root/testdata/sf0.01"


def fold(ident, k):
    return zlib.crc32(str(ident).encode()) % k


def test_language_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in QUERIES["op2_language_id"](spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    assert len(got) == len(docs)
    right = []
    for d in docs:
        r = got[d["doc_id"]]
        assert r["held_out"] == (fold(d["doc_id"], 4) == 2) and 0 <= r["score"] <= 1
        if r["held_out"]:
            right.append(r["lang_pred"] == d["lang"])
    assert np.mean(right) > 0.98


def test_languages_of_an_ngram_have_no_false_negative():
    rng = np.random.default_rng(0)
    sets = {f"l{k:03}": set(rng.integers(0, 1 << 62, 500).tolist()) for k in range(70)}
    grams_of = [np.array(sorted(sets[name]), np.uint64) for name in sorted(sets)]
    with np.errstate(over="ignore"):
        model = LanguageModel.build(grams_of, sorted(sets), None, (3,))
        for k, name in enumerate(sorted(sets)):
            words = model.languages_of(np.array(sorted(sets[name]), np.uint64))
            assert ((words[k >> 6] >> np.uint64(k & 63)) & np.uint64(1)).all()
        absent = rng.integers(1 << 62, 1 << 63, 20_000).astype(np.uint64)
        words = model.languages_of(absent)
        for k in (0, 69):
            share = ((words[k >> 6] >> np.uint64(k & 63)) & np.uint64(1)).mean()
            assert abs(share - model.false_rate[k]) < 0.01


def test_long_text_is_read_whole(monkeypatch):
    text = "eins zwei drei " * 2000
    with np.errstate(over="ignore"):
        whole = np.sort(grams(text, (3, 4)))
        monkeypatch.setattr(language_id, "PIECE_CHARS", 1000)
        assert np.array_equal(np.sort(grams(text, (3, 4))), whole)


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    model = fit_languages(spark.read.parquet(f"{SF}/documents.parquet"))
    rows = identify(odd_docs, model).collect()
    assert len(rows) == len(ROWS)
    texts = {i: t for i, t in ROWS if i is not None}
    for r in rows:
        if r["doc_id"] is not None:
            letters = any(c.isalpha() for c in texts[r["doc_id"]] or "")
            assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    assert identify(no_docs, model).count() == 0
    kept = keep_identified(odd_docs, model, min_score=0.0)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(any(c.isalpha() for c in t or "") for _, t in ROWS)


def test_nothing_to_learn_languages_from(odd_docs, no_docs):
    model = fit_languages(no_docs)
    assert {(r["lang_pred"], r["score"]) for r in identify(odd_docs, model).collect()} == {("und", 0.0)}


def test_bounded_sample_is_the_smallest_hashes(spark):
    df = spark.range(60_000).select(F.when(F.col("id") % 3 < 2, "a").when(F.col("id") < 30, "b").otherwise("c").alias("k"),
                                    F.xxhash64("id").alias("h"), "id")
    rows = df.collect()
    got = bounded_sample(df, "k", 50, 3).collect()
    for k in "abc":
        own = sorted(r["h"] for r in rows if r["k"] == k)
        assert sorted(r["h"] for r in got if r["k"] == k) == own[:50]
    assert bounded_sample(df.limit(0), "k", 50, 3).count() == 0
    with pytest.raises(ValueError):
        bounded_sample(df, "k", 50, 2)


def test_sample_of_a_language_is_bounded(spark):
    df = spark.createDataFrame([(i, f"some words of number {i}", "en") for i in range(300)],
                               "doc_id long, text string, lang string")
    model = fit_languages(df, rows_per_language=10)
    assert model.languages == ["en"] and model.fallback == "en"


def test_quality_held_out_accuracy(spark):
    got = {r["doc_id"]: r for r in QUERIES["op9_quality"](spark, SF).collect()}
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for i, r in got.items():
        assert r["held_out"] == (fold(i, 3) == 1) and 0 <= r["score"] <= 1
        assert r["predicted"] == int(r["score"] >= 0.5)
    held = [i for i in labels if i in got and got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == labels[i] for i in held]) > 0.95
    good = [got[i]["score"] for i in held if labels[i] == 1]
    bad = [got[i]["score"] for i in held if labels[i] == 0]
    assert np.mean([g > b for g in good for b in bad]) > 0.98  # pairs in the right order


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1, 5), (3, 1, 5), (7, 0, 5), (14, 0, 5), (None, 1, 5), (4, None, 5), (5, 7, 5), (99, 0, 5), (9, 1, 5)],
        "doc_id long, quality int, text int")
    model = fit_quality(odd_docs, labels)
    rows = score_quality(odd_docs, model).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    empty = {r["score"] for r in rows if r["doc_id"] in (4, 5, 6)}
    assert len(empty) == 1
    assert score_quality(no_docs, model).count() == 0
    kept = keep_good(odd_docs, model)
    assert kept.columns == odd_docs.columns
    assert kept.count() == sum(r["predicted"] for r in rows)


@pytest.mark.parametrize("labels", [[], [(1, 1), (2, 1)], [(1, 0)]])
def test_nothing_to_prefer(spark, odd_docs, labels):
    model = fit_quality(odd_docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert {r["score"] for r in score_quality(odd_docs, model).collect()} == {0.5}


def test_weights_minimise_the_pairwise_loss():
    rng = np.random.default_rng(3)
    good = rng.normal(0.5, 1, (200, len(quality.FEATURES)))
    bad = rng.normal(0.0, 1, (150, len(quality.FEATURES)))
    for x in (good, bad):
        x[:, quality.FEATURES.index("log_words")] = 5.0
    model = bradley_terry(good, bad, 0.6, pairs=3000)
    assert (model.raw(good).mean() - model.raw(bad).mean()) > 1
    everything = np.concatenate([model.score(good), model.score(bad)])
    weight = np.r_[np.full(200, 0.6 / 200), np.full(150, 0.4 / 150)]
    assert abs((weight * (everything < 0.5)).sum() - 0.4) < 0.01  # the quantile


def test_quality_learns_from_every_labelled_row(spark):
    """2,600 rows of a label say a little, and a few, wherever their hashes
    lie, say what only they know: the whole table's sums are in the model."""
    def text(i):
        return " ".join(["word"] * (5 + i % 7) + (["12345"] if i % 2 else ["|||"]) * (1 + i % 5))

    rows = [(i, text(i) + (" !!!" if i % 1300 in (3, 4) else "")) for i in range(5200)]
    docs = spark.createDataFrame(rows + rows[:3] + [(None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5200)], "doc_id long, quality int")
    model = fit_quality(docs, labels)
    x = np.array([features(t) for _, t in rows + rows[:3]])
    assert np.allclose(model.mean, x.mean(axis=0), atol=1e-9)
    assert np.allclose(model.scale, np.where(x.std(axis=0) < 1e-9, 1, x.std(axis=0)), rtol=1e-6)
    again = fit_quality(docs.repartition(7), labels.repartition(5))
    assert np.array_equal(model.weights, again.weights) and model.threshold == again.threshold
    got = {r["doc_id"]: r["predicted"] for r in score_quality(docs, model).collect()}
    assert all(got[i] == i % 2 for i, _ in rows)


@pytest.mark.parametrize("good,bad", [(1, 700), (700, 1), (40, 3000), (300, 300)])
def test_every_row_meets_the_other_label(spark, good, bad):
    rows = spark.range(good + bad).select(
        "id", (F.col("id") < good).cast("int").alias("label"), F.array([F.lit(0.0)] * len(quality.FEATURES)).alias("x"),
        F.lit(1).cast("long").alias("n"))
    buckets = [r["rows"] for r in quality.pair_buckets(rows, good, bad).collect()]
    assert all({x["label"] for x in b} == {0, 1} for b in buckets)
    assert sum(x["first"] for b in buckets for x in b) == good + bad
    assert max(len(b) for b in buckets) < 300


def test_quantile_of_all_scores(spark):
    rng = np.random.default_rng(5)
    values = np.r_[rng.normal(0, 1, 900), np.full(300, 0.25), 1e12]
    label = rng.integers(0, 2, len(values))
    for share in (0.001, 0.3, 0.55, 0.999):
        weight = np.where(label == 1, (1 - share) / (label == 1).sum(), share / (label == 0).sum())
        order = np.argsort(values, kind="stable")
        k = min(int(np.searchsorted(np.cumsum(weight[order]), share + 1e-12, "right")), len(order) - 1)
        at = values[order[k]]
        others = values[values < at]
        want = (at + (others.max() if len(others) else values[values > at].min())) / 2
        df = spark.createDataFrame([(float(v), int(l), 1) for v, l in zip(values, label)], "score double, label int, n long")
        assert quality.score_quantile(df, share) == pytest.approx(want)
    same = spark.createDataFrame([(2.0, 1, 3), (2.0, 0, 1)], "score double, label int, n long")
    assert quality.score_quantile(same, 0.4) == 2.0


def test_features_read_the_whole_text():
    assert not np.array_equal(features(LONG), features(LONG + " !!" * 2000))
    assert np.array_equal(features(None), features("  \n"))
