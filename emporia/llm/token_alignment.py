"""Alignment of two tokenizers' tokens through sparse incidence matrices.

Both tokenizers cut the same bytes.  Their tokens are the rows of two incidence
matrices in compressed sparse row form: A and B (tokens by bytes) and, where
both end a token at the same byte and so close a group, G and H (tokens by
groups).  Products are Gustavson's, row by row: a row of A·Bᵀ is the sum of the
rows of Bᵀ that the row of A names, its entries being the tokens of B that
overlap the token, with the number of common bytes; G·Hᵀ has the links within a
group.  A product is made in blocks of rows, so that no more than
``PRODUCT_TERMS`` terms (or one row's) are held.

A link lies within one group, and a corpus repeats few different groups (mostly
words), so a block of texts keeps its different groups and the texts as numbers
of groups; products are made of the different groups alone.

A link's count is the number of links of the whole corpus between its two ids.

1. Each task cuts the texts it reads into blocks bounded by bytes; a block's row
   keeps its groups, its texts, and the distinct id pairs of its links with their
   number.  The blocks are written to the shared folder.
2. Pairs of all blocks are summed, and each second id's highest sum is found.  A
   pair that every document has is one row a block, added up before the shuffle.
3. The sums of its pairs go back to every block, in the order of its list, and
   judge the links of its groups, and by them its texts.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import chunks, written
from emporia.llm.packing import BLANKS, LONG_RUN, byte_alphabet
from emporia.llm.piece_codec import PieceCodec, gather
from emporia.session import ship_package

#: Bytes of text in a block, and terms of a product held at once.
BLOCK_BYTES, PRODUCT_TERMS = 2 << 20, 1 << 20
#: Characters of group texts in one batch of results.
BATCH_CHARS = 4 << 20


@dataclass
class Csr:
    """A sparse matrix of ones: row r has the columns
    ``columns[begin[r]:begin[r + 1]]``, in rising order."""

    begin: np.ndarray
    columns: np.ndarray
    width: int

    @property
    def height(self) -> int:
        return len(self.begin) - 1

    def rows(self, a: int, b: int) -> Csr:
        return Csr(self.begin[a:b + 1] - self.begin[a], self.columns[self.begin[a]:self.begin[b]], self.width)


def intervals(lens: np.ndarray) -> Csr:
    """Row r has the next lens[r] columns: tokens by the bytes they tile."""
    begin = np.append(0, np.cumsum(lens))
    return Csr(begin, np.arange(begin[-1]), int(begin[-1]))


def transposed_intervals(lens: np.ndarray) -> Csr:
    """The transpose of ``intervals(lens)``: each byte's row names its token."""
    total = int(lens.sum())
    return Csr(np.arange(total + 1), np.repeat(np.arange(len(lens)), lens), len(lens))


def members(column: np.ndarray, width: int) -> Csr:
    """Row r has the one column given."""
    return Csr(np.arange(len(column) + 1), column, width)


def transposed_members(column: np.ndarray, width: int) -> Csr:
    """The transpose of ``members(column, width)``, ``column`` in rising order."""
    return Csr(np.searchsorted(column, np.arange(width + 1)), np.arange(len(column)), len(column))


def product(left: Csr, right: Csr, terms: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, column, value) of the entries of left · right, by row, then
    column, in blocks of whole rows with at most ``terms`` terms (or one row)."""
    terms = PRODUCT_TERMS if terms is None else terms
    width = right.begin[1:] - right.begin[:-1]
    ends = np.append(0, np.cumsum(width[left.columns]))[left.begin]  # terms before each row
    row = 0
    while row < left.height:
        stop = max(row + 1, int(np.searchsorted(ends, ends[row] + terms, "right")) - 1)
        part = left.rows(row, stop)
        sizes = width[part.columns]
        column = right.columns[gather(right.begin[part.columns], sizes)]
        owner = np.repeat(np.repeat(np.arange(row, stop), np.diff(part.begin)), sizes)
        key = owner * right.width + column
        if (key[1:] < key[:-1]).any():
            key = np.sort(key, kind="stable")
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key = key[first]
        yield key // right.width, key % right.width, np.diff(first, append=len(owner))
        row = stop


class ByteTokens:
    """Ids and bytes of the tokens of a byte-level BPE file with the GPT-2
    word pattern; strings of special tokens are plain text."""

    def __init__(self, path: str):
        import public_tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in special}
        self.bpe = tiktoken.Encoding("align", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.length = np.zeros(max(ranks.values()) + 1, np.int64)
        for raw, i in ranks.items():
            self.length[i] = len(raw)
        self.size = len(self.length)
        self.long_run = re.compile(f"(?<![{BLANKS}])[{BLANKS}]{{{LONG_RUN},}}")

    def encode(self, text: str) -> np.ndarray:
        """Ids; a very long run of blanks is merged apart, since the pattern
        backtracks over it: it is one word, less its last character where anything follows."""
        parts, at = [], 0
        for run in self.long_run.finditer(text) if len(text) >= LONG_RUN else ():
            end = run.end() - (run.end() < len(text))
            parts += [self._plain(text[at:run.start()]),
                      np.array(self.bpe._core_bpe.encode_single_piece(text[run.start():end].encode()), np.int64)]
            at = end
        return np.concatenate([*parts, self._plain(text[at:] if at else text)]) if parts else self._plain(text)

    def _plain(self, text: str) -> np.ndarray:
        return np.asarray(self.bpe.encode_to_numpy(text), np.int64)


class Aligner:
    """Tokens and links of chunks of texts."""

    def __init__(self, byte_path: str, piece_path: str):
        self.a, self.b = ByteTokens(byte_path), PieceCodec(piece_path)

    def tokens(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both kinds, end to end, and their number per text.  Texts that
        the pieces' bytes don't give back have none."""
        ids_b, n_b = self.b.encode(texts)
        raw = [b" " + t if t else b"" for t in texts]
        data = np.frombuffer(b"".join(raw), np.uint8)
        own = np.repeat(np.arange(len(texts)), n_b)
        size = np.zeros(len(texts), np.int64)
        np.add.at(size, own, self.b.length[ids_b])
        # a mark U+2581 in a text is decoded to a blank, which is shorter
        whole = size == np.array(list(map(len, raw)), np.int64)
        if whole.all():
            there = np.concatenate([np.empty(0, np.uint8), *(
                self.b.surface[gather(self.b.begin[part], self.b.length[part])]
                for part in (ids_b[k:k + PRODUCT_TERMS] for k in range(0, len(ids_b), PRODUCT_TERMS)))])
            whole[np.searchsorted(np.cumsum(size), np.flatnonzero(there != data), "right")] = False
        if not whole.all():
            return self.tokens([t if ok else b"" for t, ok in zip(texts, whole)])
        parts = [self.a.encode(t.decode()) for t in raw]
        n_a = np.array([len(p) if r else 0 for p, r in zip(parts, raw)], np.int64)
        ids_a = np.concatenate([np.empty(0, np.int64), *(p for p, r in zip(parts, raw) if r)])
        return ids_a, n_a, ids_b.astype(np.int64), n_b

    def links(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(token of A, token of B, common bytes) of all overlaps: A · Bᵀ."""
        found = list(product(intervals(self.a.length[ids_a]), transposed_intervals(self.b.length[ids_b])))
        if not found:
            return (np.empty(0, np.int64),) * 3
        return tuple(np.concatenate(c) for c in zip(*found))

    def groups(self, ids_a: np.ndarray, ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """The group of each token of A and of B, and the number of groups."""
        end_a, end_b = np.cumsum(self.a.length[ids_a]), np.cumsum(self.b.length[ids_b])
        common = np.intersect1d(end_a, end_b, assume_unique=True)
        return np.searchsorted(common, end_a), np.searchsorted(common, end_b), len(common)

    def group_links(self, ids_a: np.ndarray, ids_b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(token of A, token of B) of one group, in blocks: G · Hᵀ."""
        group_a, group_b, n = self.groups(ids_a, ids_b)
        for a, b, _ in product(members(group_a, n), transposed_members(group_b, n)):
            yield a, b

    def distinct_groups(self, group_a: np.ndarray, group_b: np.ndarray, n: int, ids_a: np.ndarray,
                        ids_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The number of each group's kind; the ids of each kind, end to end
        (those of B raised by A's size); and their number per kind."""
        ids = np.empty(len(ids_a) + len(ids_b), np.uint32)
        ids[np.arange(len(ids_a)) + np.searchsorted(group_b, group_a)] = ids_a
        ids[np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")] = ids_b + self.a.size
        ends = np.cumsum(np.bincount(group_a, minlength=n) + np.bincount(group_b, minlength=n))
        coded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), n, [None, pa.py_buffer(4 * np.append(0, ends)), pa.py_buffer(ids)]).dictionary_encode()
        kinds = coded.dictionary.to_pylist()
        return (coded.indices.to_numpy(), np.frombuffer(b"".join(kinds), np.uint32),
                np.array([len(k) // 4 for k in kinds], np.int64))

    def of_groups(self, ids: np.ndarray, sizes: np.ndarray) -> Kinds:
        """What ``distinct_groups`` put together, taken apart, with its links."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        second = ids >= self.a.size
        ids_a, ids_b = ids[~second].astype(np.int64), ids[second].astype(np.int64) - self.a.size
        a, b, _ = self.links(ids_a, ids_b)
        place, pairs = pd.factorize(ids_a[a] << 32 | ids_b[b])
        return Kinds(ids_a, ids_b, owner[~second], owner[second], owner[~second][a], place, pairs)


@dataclass
class Kinds:
    """Different groups: their ids and the group of each; for each link its
    group and the place of its id pair in the list of distinct pairs."""

    ids_a: np.ndarray
    ids_b: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray
    group: np.ndarray
    place: np.ndarray
    pairs: np.ndarray

    def texts(self, n: int) -> list[str]:
        """``a1,a2|b1`` of each group."""
        def joined(ids: np.ndarray, owner: np.ndarray) -> list[str]:
            names, ends = list(map(str, ids.tolist())), np.searchsorted(owner, np.arange(n + 1)).tolist()
            return [",".join(names[x:y]) for x, y in zip(ends[:-1], ends[1:])]

        return [f"{x}|{y}" for x, y in zip(joined(self.ids_a, self.group_a), joined(self.ids_b, self.group_b))]


def _sums(owner: np.ndarray, values: np.ndarray | int, n: int) -> np.ndarray:
    out = np.zeros(n, np.int64)
    np.add.at(out, owner, values)
    return out


def _pack(numbers: np.ndarray) -> bytes:
    """Byte planes of 32-bit numbers, compressed."""
    return zstandard.compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 3)


def _unpack(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(packed), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _blocks(byte_path: str, piece_path: str, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, piece_path)
        context = TaskContext.get()
        numbers = itertools.count((context.partitionId() if context else 0) << 33)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(batch.column(0), batch.column(1))

        texts = ((i.as_py(), t.as_py() or b"") for i, t in rows())
        for part in chunks(texts, lambda r: len(r[1]) + 64, BLOCK_BYTES):
            ids_a, n_a, ids_b, _ = aligner.tokens([t for _, t in part])
            groups = aligner.groups(ids_a, ids_b)
            code, ids, sizes = aligner.distinct_groups(*groups, ids_a, ids_b)
            kinds = aligner.of_groups(ids, sizes)
            times = _sums(kinds.place, np.bincount(code, minlength=len(sizes))[kinds.group], len(kinds.pairs))
            # a text's last token closes a group
            n_groups = np.diff(np.append(0, groups[0] + 1)[np.append(0, np.cumsum(n_a))])
            yield pa.RecordBatch.from_arrays(
                [pa.array([next(numbers)]), pa.array([[i for i, _ in part]], pa.list_(kind)),
                 pa.array([n_groups], pa.list_(pa.int64())),
                 *(pa.array([_pack(x)]) for x in (code, ids, sizes)),
                 *(pa.array([x], pa.list_(pa.int64())) for x in (kinds.pairs, times))],
                ["block", "ids", "n_groups", "codes", "group_ids", "group_sizes", "pairs", "times"])

    return run


def _judged(byte_path: str, piece_path: str):
    """Rows of blocks with the sums of their pairs -> rows of documents."""
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "n_best", "count_sum", "groups"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, piece_path)
        for batch in batches:
            for idents, n_groups, codes, ids, sizes, sums in zip(*batch.columns):
                codes, ids, sizes = (_unpack(x.as_py()) for x in (codes, ids, sizes))
                n, kinds = len(sizes), aligner.of_groups(ids, sizes)
                sums = sums.values if sums.is_valid else pa.array([], sums.type.value_type)
                if not np.array_equal(sums.field("pair").to_numpy(), kinds.pairs):
                    raise RuntimeError("a block of texts and the sums of its pairs do not belong together")
                total = sums.field("total").to_numpy()[kinds.place]
                best = sums.field("best").to_numpy(zero_copy_only=False)[kinds.place].astype(np.int64)
                per_a, per_b = (np.bincount(g, minlength=n) for g in (kinds.group_a, kinds.group_b))
                # of each kind of group; n_shared: row sums of G · Hᵀ, its product with a vector of ones
                of_kind = [per_a, per_b, np.ones(n, np.int64), _sums(kinds.group, 1, n),
                           _sums(kinds.group_a, per_b[kinds.group_a], n), _sums(kinds.group, best, n),
                           _sums(kinds.group, total, n)]
                n_groups = np.array(n_groups.as_py(), np.int64)
                owner = np.repeat(np.arange(len(n_groups)), n_groups)
                found = [_sums(owner, x[codes], len(n_groups)) for x in of_kind]
                name, cuts, listed = kinds.texts(n), np.append(0, np.cumsum(n_groups)).tolist(), codes.tolist()
                texts = (";".join([name[c] for c in listed[x:y]]) for x, y in zip(cuts[:-1], cuts[1:]))
                idents, at = idents.values, 0
                for part in chunks(texts, len, BATCH_CHARS):
                    end = at + len(part)
                    yield pa.RecordBatch.from_arrays(
                        [idents.slice(at, len(part)), *(pa.array(x[at:end]) for x in found),
                         pa.array(part, pa.string())], names)
                    at = end

    return run


def align_tokens(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """One row per input row: the identifier; ``n_a`` and ``n_b``, the tokens
    of a blank and the text by the byte-level BPE file A and by the sentencepiece
    model B (which puts the blank in front itself); ``n_groups``; ``n_links``, pairs
    of overlapping tokens; ``n_shared``, pairs within a group; ``n_best``, links
    whose count is the highest of their B id in all rows, ties included;
    ``count_sum``, the sum of the links' counts; ``groups``, the ids of each
    group as ``a1,a2|b1;a3|b2``.

    Null and empty texts, and texts whose B tokens don't give their bytes back
    (those with a mark U+2581), have no tokens: zeros and an empty ``groups``.
    Null and repeated identifiers pass through, each row counting by itself.
    Strings of special tokens are plain text.  Other columns are not read.
    Writes the table of blocks when called.
    """
    from pyspark.sql.pandas.types import to_arrow_type

    ship_package(docs.sparkSession)
    field = docs.schema[id_col].dataType
    kind, name = to_arrow_type(field), field.simpleString()
    blocks = written(docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        _blocks(byte_path, piece_path, kind),
        f"block long, ids array<{name}>, n_groups array<long>, codes binary, group_ids binary, group_sizes binary, "
        "pairs array<long>, times array<long>"), "alignment-blocks")
    listed = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "times")).alias("pos", "own")).select(
        "block", "pos", F.col("own.pairs").alias("pair"), F.col("own.times").alias("times"))
    totals = listed.groupBy("pair").agg(F.sum("times").alias("total")).withColumn(
        "b", F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF)))
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    judged = totals.join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    sums = listed.select("block", "pos", "pair").join(judged, "pair").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("pos", "pair", "total", "best"))).alias("sums"))
    out = (f"id {name}, n_a long, n_b long, n_groups long, n_links long, n_shared long, n_best long, "
           "count_sum long, groups string")
    return blocks.join(sums, "block", "left").select(
        "ids", "n_groups", "codes", "group_ids", "group_sizes", "sums").mapInArrow(
        _judged(byte_path, piece_path), out).withColumnRenamed("id", id_col)


def alignment_links(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id",
                    text_col: str = "text", within_groups: bool = False) -> DataFrame:
    """The links themselves: the identifier, the numbers ``a`` and ``b`` of
    two tokens in their text (from 0), their ids ``a_id`` and ``b_id``, and
    ``n_bytes``, how many bytes they share.  ``within_groups``: all pairs of
    tokens of a group, with ``n_bytes`` null.  Rows without tokens give none."""
    ship_package(docs.sparkSession)
    name = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(byte_path, piece_path)
        for batch in batches:
            for i in range(batch.num_rows):
                ids_a, _, ids_b, _ = aligner.tokens([batch.column(1)[i].as_py() or b""])
                if within_groups:
                    found = ((a, b, None) for a, b in aligner.group_links(ids_a, ids_b))
                else:
                    found = product(intervals(aligner.a.length[ids_a]), transposed_intervals(aligner.b.length[ids_b]))
                for a, b, n in found:
                    own = batch.column(0).slice(i, 1).take(pa.array(np.zeros(len(a), np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [own, pa.array(a), pa.array(b), pa.array(ids_a[a]), pa.array(ids_b[b]),
                         pa.nulls(len(a), pa.int64()) if n is None else pa.array(n)],
                        ["id", "a", "b", "a_id", "b_id", "n_bytes"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(
        run, f"id {name}, a long, b long, a_id long, b_id long, n_bytes long").withColumnRenamed("id", id_col)
