import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F

from emporia.llm import piece_codec
from emporia.llm.piece_codec import MergeRounds, PieceCodec
from tests.llm.conftest import ROWS
from tests.llm.test_tokens import naive_merge, texts

MODEL = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(MODEL)


def lists(flat, counts):
    return [x.tolist() for x in np.split(flat, np.cumsum(counts)[:-1])] if len(counts) else []


@pytest.mark.parametrize("seed", range(8))
def test_merge_rounds_against_one_merge_at_a_time(seed):
    """Random tables, in which merged symbols often outrank what made them."""
    rng = random.Random(seed)
    pairs, symbols = {}, 3
    for _ in range(40):
        pair = (rng.randrange(symbols), rng.randrange(symbols))
        if pair not in pairs:
            pairs[pair] = (rng.randrange(12), symbols)
            symbols += 1
    seqs = [[rng.randrange(-1, 3) for _ in range(rng.choice([1, 2, 5, 30]))] for _ in range(300)]
    rounds = MergeRounds(np.array([(*p, r, m) for p, (r, m) in pairs.items()], np.int64))
    out, n = rounds.run(np.array([x for s in seqs for x in s]), np.array(list(map(len, seqs))))
    assert lists(out, n) == [naive_merge(s, pairs) for s in seqs]


@pytest.mark.parametrize("seed", [11, 12])
def test_codec_equals_the_library(codec, library, seed):
    sample = texts(seed)
    ids, n = codec.encode([t.encode() for t in sample])
    want = library.encode(sample, num_threads=1)
    assert lists(ids, n) == want
    assert codec.decode(ids, n) == [library.decode(x) for x in want]


def test_codec_forgets_words_and_stays_right(library, monkeypatch):
    monkeypatch.setattr(piece_codec, "KNOWN_WORDS", 50)
    codec, sample = PieceCodec(MODEL), texts(13, 400)
    for k in range(0, len(sample), 37):
        part = sample[k:k + 37]
        assert lists(*codec.encode([t.encode() for t in part])) == library.encode(part)
    assert len(codec.code) < 3000


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 1_000_003, " " * 31 + "中", "\n" * 200_000, "的一是不了" * 40_000,
                                  "x" + " " * 15 + "y", "▁▁a▁", "́" * 1000])
def test_very_long_words_and_runs(codec, library, text):
    ids, n = codec.encode([text.encode()])
    assert ids.tolist() == library.encode(text)
    assert codec.decode(ids, n) == [library.decode(ids.tolist())]


def test_decoding_of_any_ids(codec, library):
    rng = random.Random(3)
    kinds = (lambda: rng.randrange(3), lambda: rng.randrange(3, 259), lambda: rng.randrange(32_000), lambda: 28705,
             lambda: 259)
    seqs = [[rng.choice(kinds)() for _ in range(rng.randrange(9))] for _ in range(4000)]
    got = codec.decode(np.array([i for s in seqs for i in s]), np.array(list(map(len, seqs))))
    assert got == [library.decode(s) for s in seqs]


@pytest.mark.parametrize("chunk_bytes", [piece_codec.CHUNK_BYTES, 1])
def test_odd_rows(odd_docs, no_docs, library, monkeypatch, chunk_bytes):
    monkeypatch.setattr(piece_codec, "CHUNK_BYTES", chunk_bytes)
    want = [(i, library.encode(t or "")) for i, t in ROWS]
    got = piece_codec.encode(odd_docs, MODEL, decoded=True)
    assert got.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(i, len(x), x, library.decode(x)) for i, x in want], key=str)
    assert piece_codec.encode(no_docs, MODEL, decoded=True).count() == 0


def test_decode_of_a_table(spark, library):
    rows = [(1, library.encode("Hello  wide\nworld")), (1, []), (None, None), (2, [None, 300, 99_999, -5]), (3, [1, 300, 0, 2])]
    df = spark.createDataFrame(rows, "doc_id long, ids array<int>")
    assert sorted(map(tuple, piece_codec.decode(df, MODEL).collect()), key=str) == sorted(
        [(1, "Hello  wide\nworld"), (1, ""), (None, ""), (2, library.decode([300])), (3, library.decode([1, 300, 0, 2]))],
        key=str)
    assert piece_codec.decode(df.limit(0), MODEL).count() == 0


def test_op13_digests(spark, sf_small, library):
    from emporia.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf_small}/documents.parquet").collect()}
    got = QUERIES["op13_sentencepiece"](spark, sf_small)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library.encode(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(library.decode(ids).encode()).hexdigest())
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.where(F.col("n_tokens") < 0).count() == 0
