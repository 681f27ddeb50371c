"""BPE encoding and decoding through a distinct-word table.

A text is cut into words, and a word's ids do not depend on its neighbours,
so each distinct word is encoded once:

1. every task cuts the texts it reads into words and keeps, per block of texts
   (bounded by characters), the block's distinct words and each text as
   positions in that word list;
2. a hash deals the words of all blocks over buckets, each block sending a
   bucket its words and their positions in one packed row.  A bucket is a part
   of the distinct-word table: a task goes through the packed rows of its buckets,
   merges the words it hasn't met (``rank_merge``), keeps their ids in a bounded
   table, and sends every row's ids back to the row's block.  However often texts
   repeat a word, a block sends it once;
3. a block and the ids of its words meet again by block, positions become ids,
   and ids become pieces through the id-to-piece table.

Blocks are shuffled once: both branches read the same exchange.  A block's
number contains a hash of its content, so that a block which came out
different when a lost task ran again could not be joined with stale ids.
"""

from __future__ import annotations

import itertools
import json
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tokenizers
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import chunks
from emporia.llm.packing import byte_alphabet
from emporia.llm.rank_merge import RankMerger
from emporia.session import ship_package

#: Words whose ids a task remembers.
KNOWN_WORDS = 1 << 20
#: Characters of text in one block, and of words merged at once.
BLOCK_CHARS, MERGE_CHARS = 8 << 20, 1 << 20
#: Characters of decoded text in one batch of results.
BATCH_CHARS = 4 << 20


class WordCodec:
    """Words, ids and pieces of a lower-casing byte-level BPE file whose words
    end in a suffix and whose pre-tokenizer keeps the matches of one pattern."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        split, level = spec["pre_tokenizer"]["pretokenizers"]
        if (steps != ["NFC", "Replace", "Lowercase"] or split["type"] != "Split" or not split["invert"]
                or level["use_regex"] or level["add_prefix_space"] or spec["decoder"]):
            raise ValueError("not a word BPE file of the supported form")
        self.library = tokenizers.Tokenizer.from_file(path)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_at = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.word_at = regex.compile(split["pattern"]["Regex"])
        vocab, self.end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]
        self.byte_of = byte_alphabet()
        self.inner, self.last = np.full(256, -1, np.int64), np.full(256, -1, np.int64)
        for c, b in self.byte_of.items():
            self.inner[b], self.last[b] = vocab[c], vocab[c + self.end]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.merger = RankMerger(np.array(
            [(vocab[a], vocab[b], rank, vocab[a + b]) for rank, (a, b) in enumerate(merges)], np.int64))
        #: The id-to-piece table.
        self.pieces = {i: p for p, i in vocab.items()} | {i: p for p, i in self.special.items()}

    def words(self, text: str) -> list[str]:
        if "<|" not in text:
            return self._plain(text)
        out: list[str] = []
        for k, part in enumerate(self.special_at.split(text)):
            out.extend([part] if k % 2 else self._plain(part))
        return out

    def _plain(self, text: str) -> list[str]:
        try:  # Latin-1 is NFC already, and its classes are the same in every Unicode version
            text.encode("latin-1")
        except UnicodeEncodeError:
            if text and max(text) >= "ɐ":
                return self._by_library(text)
        return self.word_at.findall(text.lower())

    def _by_library(self, text: str) -> list[str]:
        normal = self.library.normalizer.normalize_str(text)
        return [bytes(self.byte_of[c] for c in w).decode()
                for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def encode(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word, special tokens among them."""
        raw = [b"" if w in self.special else w.encode() for w in words]
        lens = np.fromiter(map(len, raw), np.int64, len(raw))
        flat = np.frombuffer(b"".join(raw), np.uint8)
        sym = self.inner[flat]
        ends = np.cumsum(lens)
        sym[ends[lens > 0] - 1] = self.last[flat[ends[lens > 0] - 1]]
        out, n = self.merger.merge(sym, lens)
        ids = np.split(out, np.cumsum(n)[:-1]) if len(n) else []
        return [np.array([self.special[w]]) if w in self.special else x for w, x in zip(words, ids)]


def _split(path: str, kind: pa.DataType, block_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, pack = WordCodec(path), zstandard.ZstdCompressor(level=3).compress
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        numbers = itertools.count()

        def block(ids: list, codes: list[np.ndarray], index: dict[str, int]) -> pa.RecordBatch:
            flat = np.concatenate(codes)
            words = pack("\n".join(index).encode())
            packed = pack((flat & 0xFFFF).astype("<u2").tobytes() + (flat >> 16).astype(np.uint8).tobytes())
            ends = np.cumsum([len(c) for c in codes]).tolist()
            number = xxhash.xxh3_64_intdigest(
                repr((part, next(numbers), ids)).encode() + words + packed) - (1 << 63)
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(kind)),
                 pa.array([ends], pa.list_(pa.int64())), pa.array([words]), pa.array([packed])],
                ["block", "ids", "ends", "words", "codes"])

        ids, codes, size = [], [], 0
        index: dict[str, int] = defaultdict(itertools.count().__next__)
        for batch in batches:
            for ident, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or ""
                # codes have 24 bits, and a word has at least one character
                if ids and (size + len(text) > block_chars or len(index) + len(text) >= 1 << 24):
                    yield block(ids, codes, index)
                    ids, codes, size = [], [], 0
                    index = defaultdict(itertools.count().__next__)
                words = codec.words(text)
                ids.append(ident.as_py())
                codes.append(np.fromiter(map(index.__getitem__, words), np.int32, len(words)))
                size += len(text)
        if ids:
            yield block(ids, codes, index)

    return run


def _unpack_words(packed: bytes) -> list[str]:
    joined = zstandard.decompress(packed).decode()
    return joined.split("\n") if joined else []


def _deal_words(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for number, packed in zip(batch.column(0).to_pylist(), batch.column(3)):
                words = _unpack_words(packed.as_py())
                if not words:
                    continue
                digest = xxhash.xxh3_64_intdigest
                bucket = np.fromiter((digest(w.encode()) % buckets for w in words), np.int32, len(words))
                order = np.argsort(bucket, kind="stable").astype(np.int32)
                cuts = np.flatnonzero(np.diff(bucket[order])) + 1
                rows = []
                for own in np.split(order, cuts):
                    steps = np.diff(own, prepend=0).astype("<u4")
                    rows.append((int(bucket[own[0]]), number, pack(steps.tobytes()),
                                 pack("\n".join([words[i] for i in own.tolist()]).encode())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary()))],
                    ["bucket", "block", "pos", "words"])

    return run


class KnownWords:
    """Ids of the words a task has met, end to end; it forgets all of them
    when they are too many, and merges again those that come back."""

    def __init__(self, codec: WordCodec, limit: int):
        self.codec, self.limit = codec, limit
        self.forget()

    def forget(self) -> None:
        self.at: dict[str, int] = {}
        self.ids, self.start, self.size, self.held = np.empty(1 << 16, "<u4"), np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64), 0

    def look_up(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids)."""
        if len(self.at) > self.limit or self.held > 8 * self.limit:
            self.forget()
        for fresh in chunks((w for w in words if w not in self.at), len, MERGE_CHARS):
            found = self.codec.encode(fresh)
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            n, end = len(self.at), self.held + int(sizes.sum())
            self.ids = _room(self.ids, end)
            self.start, self.size = _room(self.start, n + len(fresh)), _room(self.size, n + len(fresh))
            self.ids[self.held:end] = np.concatenate(found)
            self.start[n:n + len(fresh)] = self.held + np.cumsum(sizes) - sizes
            self.size[n:n + len(fresh)] = sizes
            self.at.update(zip(fresh, range(n, n + len(fresh))))
            self.held = end
        at = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
        sizes = self.size[at]
        ends = np.cumsum(sizes)
        return sizes, self.ids[np.repeat(self.start[at] - (ends - sizes), sizes) + np.arange(ends[-1])]


def _room(array: np.ndarray, n: int) -> np.ndarray:
    """The array, or one with room for ``n`` that begins with it."""
    return array if n <= len(array) else np.concatenate([array, np.empty(max(n, 2 * len(array)) - len(array), array.dtype)])


def _encode_buckets(path: str, known_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, pack = KnownWords(WordCodec(path), known_words), zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for number, pos, words in zip(*(batch.column(k) for k in (1, 2, 3))):
                sizes, ids = known.look_up(_unpack_words(words.as_py()))
                row = (number.as_py(), pos.as_py(), pack(sizes.astype("<u4").tobytes()), pack(ids.tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([v], k) for v, k in zip(row, (pa.int64(), pa.binary(), pa.binary(), pa.binary()))],
                    ["block", "pos", "sizes", "ids"])

    return run


def _assemble(path: str, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = WordCodec(path).pieces
        unpack = zstandard.decompress
        for batch in batches:
            for ids, ends, codes, parts in zip(*batch.columns[:4]):
                raw = unpack(codes.as_py())
                n = len(raw) // 3
                codes = (np.frombuffer(raw, "<u2", n).astype(np.int32)
                         | (np.frombuffer(raw, np.uint8, n, 2 * n).astype(np.int32) << 16))
                parts = parts.as_py() or []
                pos = [np.cumsum(np.frombuffer(unpack(p["pos"]), "<u4"), dtype=np.int64) for p in parts]
                pos = np.concatenate(pos) if pos else np.empty(0, np.int64)
                if not np.array_equal(np.sort(pos), np.arange(codes.max() + 1 if n else 0)):
                    raise RuntimeError("a block of texts and the ids of its words do not belong together")
                flat = np.frombuffer(b"".join(unpack(p["ids"]) for p in parts), "<u4")
                length = np.frombuffer(b"".join(unpack(p["sizes"]) for p in parts), "<u4").astype(np.int64)
                sizes, starts = np.empty_like(length), np.empty_like(length)
                sizes[pos], starts[pos] = length, np.cumsum(length) - length
                names = [piece[i] for i in flat.tolist()]  # the id-to-piece join
                text = [" ".join(names[a:a + k]) for a, k in zip(starts.tolist(), sizes.tolist())]
                del names
                yield from _texts(ids.as_py(), ends.as_py(), codes, flat, starts, sizes, text, kind)

    return run


def _texts(idents: list, ends: list[int], codes: np.ndarray, flat: np.ndarray, starts: np.ndarray,
           sizes: np.ndarray, text: list[str], kind: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Ids and decoded texts of one block, in batches."""
    kinds = (kind, pa.int64(), pa.binary(), pa.string())

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                                          ["id", "n_tokens", "ids", "decoded"])

    rows, held, begin = [], 0, 0
    for ident, end in zip(idents, ends):
        own = codes[begin:end]
        k = sizes[own]
        shift = np.repeat(starts[own] - (np.cumsum(k) - k), k)
        ids = flat[shift + np.arange(len(shift))]
        rows.append((ident, len(ids), ids.tobytes(), " ".join([text[c] for c in own.tolist()])))
        held += len(rows[-1][3])
        if held > BATCH_CHARS:
            yield batch(rows)
            rows, held = [], 0
        begin = end
    if rows:
        yield batch(rows)


def encode_and_decode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                      text_col: str = "text", block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per input row: the identifier, ``n_tokens``, ``ids`` (as
    little-endian 32-bit integers) and ``decoded``, the text of those ids
    with special tokens kept.

    A null text is the empty text: no ids, decoded to the empty text.  Null
    and repeated identifiers pass through.  Special tokens' strings inside a
    text become their ids.  Other columns are not read.  The rows should come
    from files, in the same order whenever they are read: a source that is
    not repeatable makes the job fail rather than give wrong ids.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    ship_package(docs.sparkSession)
    field = docs.schema[id_col].dataType
    kind, name = to_arrow_type(field), field.simpleString()
    blocks = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _split(tokenizer_path, kind, block_chars),
        f"block long, ids array<{name}>, ends array<long>, words binary, codes binary").repartition("block")
    buckets = 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    words = blocks.mapInArrow(_deal_words(buckets), "bucket int, block long, pos binary, words binary")
    coded = words.repartition("bucket").mapInArrow(
        _encode_buckets(tokenizer_path, KNOWN_WORDS), "block long, pos binary, sizes binary, ids binary")
    parts = coded.groupBy("block").agg(F.collect_list(F.struct("pos", "sizes", "ids")).alias("parts"))
    # all columns are passed on: with fewer, the two branches' exchanges would differ
    done = blocks.join(parts, "block", "left").select("ids", "ends", "codes", "parts", "words", "block").mapInArrow(
        _assemble(tokenizer_path, kind), f"id {name}, n_tokens long, ids binary, decoded string")
    return done.withColumnRenamed("id", id_col)


def decode(ids: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``id_col`` and ``decoded`` of each row's array of ids, through a join
    with the id-to-piece table (one row per vocabulary entry, which bounds it).
    An empty or null array gives the empty text; an unknown id gives nothing."""
    spark = ids.sparkSession
    pieces = spark.createDataFrame(sorted(WordCodec(tokenizer_path).pieces.items()), "piece_id int, piece string")
    one = ids.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids")).withColumn(
        "row", F.monotonically_increasing_id()).select("row", "id", F.posexplode_outer("ids").alias("pos", "piece_id"))
    joined = one.join(F.broadcast(pieces), "piece_id", "left")
    return joined.groupBy("row", "id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(
        F.when(F.col("piece").isNotNull(), F.struct("pos", "piece")))), lambda s: s["piece"]), " ").alias("decoded")
    ).select(F.col("id").alias(id_col), "decoded")
