import random
import zlib

import numpy as np
import public_tokenizers as P
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from emporia.llm import packing, word_bpe
from emporia.llm.rank_merge import RankMerger
from emporia.llm.token_counts import PieceCounter, token_counts
from tests.llm.conftest import ROWS

PIECES = P.path("piece_bpe_32k.model")
WORDS = P.path("word_bpe_49k.json")
BYTES = P.path("byte_bpe_50k.json")
PARTS = ["▁", " ", "  ", " " * 15, " " * 31, "\n", "\t", "\r\n", "a", "the", " the", "ing", "ion", "'s", "'RE", "é", "ﬁ",
         "中", "文", "😀", "\x00", "\x1c", "\x85", "\xa0", "　", "0", "12", "٣", "½", "ª", "İ", "ß", "Σ", "́", "Ж", "K",
         "<s>", "</s>", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "!!", "_", "--", "==="]


def texts(seed, n=3000):
    rng = random.Random(seed)
    made = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(25))) for _ in range(n)]
    wild = ["".join(chr(rng.choice([rng.randrange(1, 0xD7FF), rng.randrange(0xE000, 0x1FFFF)]))
                    for _ in range(20)) for _ in range(300)]
    return made + wild + ["", " " * 1000, "a" * 3000, "的一是不了" * 300, "thethethe" * 500]


def naive_merge(seq, pairs):
    """One merge at a time: lowest rank, then leftmost."""
    seq = list(seq)
    while True:
        found = [(pairs[p][0], k) for k, p in enumerate(zip(seq, seq[1:])) if p in pairs]
        if not found:
            return seq
        _, k = min(found)
        seq[k:k + 2] = [pairs[(seq[k], seq[k + 1])][1]]


@pytest.mark.parametrize("seed", range(6))
def test_rank_merge_against_one_at_a_time(seed):
    """Random tables, in which merged symbols often outrank what made them."""
    rng = random.Random(seed)
    pairs, symbols = {}, 3
    for _ in range(40):
        pair = (rng.randrange(symbols), rng.randrange(symbols))
        if pair not in pairs:
            pairs[pair] = (rng.randrange(12), symbols)
            symbols += 1
    seqs = [[rng.randrange(-1, 3) for _ in range(rng.choice([0, 1, 2, 5, 30]))] for _ in range(300)]
    merger = RankMerger(np.array([(*p, r, m) for p, (r, m) in pairs.items()]))
    lens = np.array([len(s) for s in seqs])
    out, n = merger.merge(np.array([x for s in seqs for x in s], np.int64), lens)
    got = [part.tolist() for part in np.split(out, np.cumsum(n)[:-1])]
    assert got == [naive_merge(s, pairs) for s in seqs]


def test_piece_counts_equal_the_library():
    sample = texts(1)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    assert PieceCounter(PIECES).count(sample) == [len(x) for x in library.encode(sample, num_threads=1)]


def test_token_counts_of_odd_rows(odd_docs, no_docs):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = []
    for i, t in ROWS:
        n = len(library.encode(t or ""))
        want.append((i, len((t or "").encode()), n, n > 4096))
    got = token_counts(odd_docs, PIECES)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert token_counts(no_docs, PIECES).count() == 0


def test_word_codec_equals_the_library():
    codec, library = word_bpe.WordCodec(WORDS), Tokenizer.from_file(WORDS)
    sample = texts(2)
    words = [codec.words(t) for t in sample]
    distinct = sorted({w for ws in words for w in ws})
    ids = dict(zip(distinct, codec.encode(distinct)))
    for ws, e in zip(words, library.encode_batch(sample, add_special_tokens=False)):
        assert [i for w in ws for i in ids[w].tolist()] == e.ids


@pytest.mark.parametrize("block_chars", [word_bpe.BLOCK_CHARS, 200])
def test_encode_and_decode_odd_rows(odd_docs, no_docs, block_chars):
    library = Tokenizer.from_file(WORDS)
    want = []
    for i, t in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)))
    got = word_bpe.encode_and_decode(odd_docs, WORDS, block_chars=block_chars)
    assert sorted([(r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in got.collect()],
                  key=str) == sorted(want, key=str)
    assert word_bpe.encode_and_decode(no_docs, WORDS).count() == 0


def test_blocks_are_shuffled_once(documents):
    df = word_bpe.encode_and_decode(documents, WORDS)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ReusedExchange" in plan


def test_distinct_words_beyond_the_table(documents, monkeypatch):
    """With tiny blocks and tables the answers stay the same."""
    want = sorted(map(tuple, word_bpe.encode_and_decode(documents, WORDS).collect()))
    monkeypatch.setattr(word_bpe, "KNOWN_WORDS", 100)
    assert sorted(map(tuple, word_bpe.encode_and_decode(documents, WORDS, block_chars=200_000).collect())) == want


def test_known_words_are_bounded():
    known = word_bpe.KnownWords(word_bpe.WordCodec(WORDS), 50)
    want = known.codec.encode(sorted(f"word{i}" for i in range(400)))
    for _ in range(2):
        for k in range(0, 400, 20):
            sizes, ids = known.look_up(sorted(f"word{i}" for i in range(400))[k:k + 20])
            assert sizes.tolist() == [len(x) for x in want[k:k + 20]]
            assert ids.tolist() == np.concatenate(want[k:k + 20]).tolist()
            assert len(known.at) <= 70


def test_decode_join(spark):
    library = Tokenizer.from_file(WORDS)
    ids = [library.encode(t, add_special_tokens=False).ids for t in ("Hello wide world", "", "it's 12 <|endoftext|>")]
    df = spark.createDataFrame([(k, x) for k, x in enumerate(ids)] + [(7, None), (7, [10 ** 6])], "doc_id int, ids array<int>")
    got = sorted((r["doc_id"], r["decoded"]) for r in word_bpe.decode(df, WORDS).collect())
    assert got == sorted([(k, library.decode(x, skip_special_tokens=False)) for k, x in enumerate(ids)] + [(7, ""), (7, "")])


def test_byte_encoder_equals_the_library():
    encode, library = packing.byte_bpe_encoder(BYTES)(), Tokenizer.from_file(BYTES)
    sample = texts(3)
    for t, e in zip(sample, library.encode_batch(sample, add_special_tokens=False)):
        assert encode(t).tolist() == e.ids + [1]


@pytest.mark.parametrize("run", [" ", "\n", "\r\n\t ", "\u3000\x85"])
def test_byte_encoder_of_long_blank_runs(run):
    encode, library = packing.byte_bpe_encoder(BYTES)(), Tokenizer.from_file(BYTES)
    for n, around in ((2_000_000, ("two", " words")), (65_536, ("", "")), (65_537, ("", "x")),
                      (70_000, ("a\x1c", "\x1c!")), (70_000, ("<|endoftext|>", "<|endoftext|>b")), (70_000, ("'s", "'s"))):
        blanks = (run * n)[:n]
        text = around[0] + blanks + around[1] + blanks[:100_000] + "1" + blanks[:70_000]
        assert encode(text).tolist() == library.encode(text, add_special_tokens=False).ids + [1]


def test_pack_documents_with_a_long_blank_run(spark):
    texts = [(1, "two" + "\n" * 2_000_000 + "words"), (2, " " * 2_000_000), (3, "short")]
    got = packing.pack_documents(spark.createDataFrame(texts, "doc_id long, text string"), BYTES)
    library = Tokenizer.from_file(BYTES)
    assert {r["doc_id"]: r["n"] for r in got.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()} == {
        i: len(library.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts}


def check_packing(pieces, want, limits):
    """Pieces tile each example and each sequence, within the limits; returns the padding."""
    of_row, of_sequence = {}, {}
    for row, start, ids, total, sequence, offset, segment, loss in pieces:
        of_row.setdefault(row, []).append((start, ids, total))
        of_sequence.setdefault(sequence, []).append((offset, len(ids), segment, loss))
    assert set(of_row) == {k for k, v in want.items() if len(v)}
    for row, parts in of_row.items():
        parts.sort(key=lambda x: x[0])
        assert np.array_equal(np.concatenate([p[1] for p in parts]), want[row])
        assert all(p[2] == len(want[row]) for p in parts)
        assert [p[0] for p in parts] == np.cumsum([0] + [len(p[1]) for p in parts[:-1]]).tolist()
    padding = 0
    for parts in of_sequence.values():
        parts.sort()
        assert [p[0] for p in parts] == np.cumsum([0] + [p[1] for p in parts[:-1]]).tolist()
        assert [p[2] for p in parts] == list(range(len(parts)))
        tokens = sum(p[1] for p in parts)
        assert tokens <= limits[0] and len(parts) <= limits[1] and sum(p[3] for p in parts) <= limits[2]
        padding += 0 if tokens & (tokens - 1) == 0 else limits[0] - tokens
    return padding


def rows_of(packer, examples):
    found = [r for e in examples for r in packer.add(e)] + list(packer.flush())
    return [(r[0], r[1], np.frombuffer(r[3], "<u4"), r[4], r[5], r[6], r[7], r[8]) for r in found]


@pytest.mark.parametrize("limits", [(2048, 512, 2048), (64, 3, 64), (64, 64, 20), (1, 1, 1)])
@pytest.mark.parametrize("pool", [1, 7, 64])
def test_packing_with_cuts_wastes_nothing(limits, pool):
    rng = np.random.default_rng(4)
    want = {k: rng.integers(0, 50_000, rng.choice([0, 1, 2, 63, 64, 65, 300, 2047, 2049])).astype(np.uint32)
            for k in range(120)}
    packer = packing.Packer(limits, True, pool)
    assert check_packing(rows_of(packer, [packing.Example(k, v, len(v)) for k, v in want.items()]), want, limits) == 0


def test_packing_of_instruction_data_without_cuts():
    rng = np.random.default_rng(9)
    want, examples = {}, []
    for k in range(400):
        ids = rng.integers(0, 50_000, int(rng.integers(1, 400))).astype(np.uint32)
        bears = rng.random(len(ids)) < 0.5
        want[k] = ids
        examples.append(packing.Example(k, ids, len(ids), 0, np.r_[0, np.cumsum(bears)]))
    limits = (1024, 8, 500)
    rows = rows_of(packing.Packer(limits, False, 256), examples)
    check_packing(rows, want, limits)
    assert len(rows) == 400  # nothing is cut
    tokens = sum(len(v) for v in want.values())
    sequences = len({r[4] for r in rows})
    least = max(tokens / 1024, 400 / 8, sum(e.loss[-1] for e in examples) / 500)
    assert sequences <= 1.1 * least + 1


def test_too_large_example_without_cuts_gets_its_own_sequence():
    ids = np.arange(50, dtype=np.uint32)
    rows = rows_of(packing.Packer((20, 4, 20), False, 4), [packing.Example("a", ids, 50), packing.Example("b", ids[:5], 5)])
    assert [(r[0], len(r[2])) for r in rows] == [("a", 50), ("b", 5)] and rows[0][4] != rows[1][4]


def test_pack_documents_of_odd_rows(odd_docs, no_docs):
    library = Tokenizer.from_file(BYTES)
    got = packing.pack_documents(odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"]), BYTES).collect()
    want = {i: np.array(library.encode(t or "", add_special_tokens=False).ids + [1], np.uint32)
            for i, t in ROWS if i is not None}
    pieces = [(r["doc_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"], r["sequence_id"], r["offset"],
               r["segment"], r["loss_tokens"]) for r in got]
    assert check_packing(pieces, want, (2048, 512, 2048)) == 0
    assert packing.pack_documents(no_docs, BYTES).count() == 0
    everything = packing.pack_documents(odd_docs, BYTES).agg(F.sum("length")).first()[0]
    assert everything == sum(len(library.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in ROWS)


def test_prompt_tokens_bear_no_loss(spark):
    rows = spark.createDataFrame([(1, "what is it", "an answer"), (2, None, "other"), (3, "q", None)],
                                 "conv_id long, prompt string, reply string")
    got = packing.pack(rows, packing.byte_bpe_encoder(BYTES), "conv_id", F.col("reply"), 16, prompt=F.col("prompt"),
                       cut=False).collect()
    encode = packing.byte_bpe_encoder(BYTES)()
    assert {r["conv_id"]: (r["length"], r["loss_tokens"]) for r in got} == {
        1: (len(encode("what is it")) - 1 + len(encode("an answer")), len(encode("an answer"))),
        2: (len(encode("other")),) * 2, 3: (len(encode("q")) - 1 + 1, 1)}


@pytest.mark.parametrize("limits", [(64, 8, 20), (64, 64, 1), (50, 3, 49)])
@pytest.mark.parametrize("pool", [1, 5])
def test_pack_with_cuts_where_the_loss_limit_decides(spark, limits, pool):
    """More rows than the pool holds, prompts of any length, answers beyond every limit."""
    rng = random.Random(6)
    words = "alpha beta gamma delta <|endoftext|> 12 \n".split(" ")
    rows = [(k, " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 90]))), " ".join(rng.choices(words, k=rng.choice([0, 1, 9, 150]))))
            for k in range(60)]
    got = packing.pack(spark.createDataFrame(rows, "conv_id long, prompt string, reply string").coalesce(1),
                       packing.byte_bpe_encoder(BYTES), "conv_id", F.col("reply"), *limits[:2], max_loss=limits[2],
                       prompt=F.col("prompt"), cut=True, pool=pool).collect()
    encode = packing.byte_bpe_encoder(BYTES)()
    lead = {k: encode(p)[:-1] for k, p, _ in rows}
    want = {k: np.concatenate([lead[k], encode(r)]) for k, _, r in rows}
    pieces = [(r["conv_id"], r["start"], np.frombuffer(r["ids"], "<u4"), r["doc_tokens"], r["sequence_id"], r["offset"],
               r["segment"], r["loss_tokens"]) for r in got]
    assert check_packing(pieces, want, limits) == 0 or limits[0] == 50  # 50 isn't a power of two
    assert all(r["loss_tokens"] == max(0, r["start"] + r["length"] - max(r["start"], len(lead[r["conv_id"]]))) for r in got)


def test_op8_crc(spark, sf_small):
    from emporia.llm.queries import QUERIES

    row = QUERIES["op8_packing"](spark, sf_small).orderBy("doc_id", "start").first()
    text = spark.read.parquet(f"{sf_small}/documents.parquet").where(F.col("doc_id") == row["doc_id"]).first()["text"]
    ids = packing.byte_bpe_encoder(BYTES)()(text)[:row["length"]]
    assert row["ids_crc32"] == zlib.crc32(ids.astype("<u4").tobytes())
