import datetime

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from emporia.llm import language_id, quality
from emporia.llm.queries import ORACLE_SQL, QUERIES
from tests.llm.test_minhash_dedup import brute as near_brute

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "language", "exact_dedup", "minhash_dedup", "packing"]


def test_pipeline_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    columns, rows = docs.columns, docs.collect()

    def run(k, df):
        out = corpus_pipeline.STAGES[k][1](spark, df, sf_small)
        return out, sorted(r["doc_id"] for r in out.collect())

    # learned stages: their own models, applied row by row
    model = quality.fit_quality(docs, spark.read.parquet(f"{sf_small}/labels.parquet"))
    good, ids = run(0, docs)
    assert good.columns == columns
    assert ids == sorted(r["doc_id"] for r in rows
                         if model.score(quality.features(r["text"])[None])[0] >= 0.5)
    languages = language_id.fit_languages(good)
    known, ids = run(1, good)
    with np.errstate(over="ignore"):
        assert ids == sorted(r["doc_id"] for r in good.collect() if languages.predict(r["text"])[1] >= 0.1)
    distinct, ids = run(2, known)
    last = {}
    for r in known.collect():
        key = (r["text"] or "").translate(LOWER)
        last[key] = max(last.get(key, r["doc_id"]), r["doc_id"])
    assert ids == sorted(last.values())
    left, ids = run(3, distinct)
    assert left.columns == columns
    assert ids == sorted(r[0] for r in near_brute([(r["doc_id"], r["text"]) for r in distinct.collect()], 5, 80) if r[3])
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {r["doc_id"]: library.encode(r["text"], add_special_tokens=False).ids + [1] for r in left.collect()}
    pieces = {}
    for r in corpus_pipeline.run(spark, sf_small).collect():
        pieces.setdefault(r["doc_id"], []).append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
    assert {i: [x for _, part in sorted(p) for x in part] for i, p in pieces.items()} == want


def test_pipeline_of_an_empty_and_of_odd_tables(spark, sf_small, odd_docs, no_docs):
    for docs in (no_docs, odd_docs):
        for _, stage in corpus_pipeline.STAGES:
            before = docs.columns
            docs = stage(spark, docs, sf_small)
            assert docs.count() >= 0
            if stage is not corpus_pipeline.packing_stage:
                assert docs.columns == before


@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_query_equals_duckdb(spark, sf_small, key):
    con = duckdb.connect()
    for t in "documents embeddings pages benchmark labels conversations".split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    cur = con.execute(ORACLE_SQL[key])
    names = [c[0] for c in cur.description]
    df = QUERIES[key](spark, sf_small)
    assert sorted(df.columns) == sorted(names)
    got = [tuple(r[n] for n in names) for r in df.collect()]
    assert not any(isinstance(v, datetime.datetime) for r in got for v in r)
    assert sorted(got, key=str) == sorted(cur.fetchall(), key=str)


def test_every_operator_has_a_query():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
