"""SentencePiece encoding and decoding by vectorised merge rounds.

A task holds a chunk of texts as one byte array and cuts it into words where a
run of blanks begins and around line feeds, places that no piece of the model
spans.  Arrow's dictionary encoding finds the chunk's distinct words; those the
task has not met are merged together:

* their characters are one flat array of symbols;
* in a round every word finds the lowest rank among its adjacent pairs (a
  segmented minimum), merges that pair wherever it occurs, from the left, and
  the array is compacted;
* a word without a pair that the model knows is done and leaves the array.

Occurrences are merged together only up to the first whose merged symbol could
itself pair with a neighbour at that rank or a lower one, so the result is that
of one merge at a time (lowest rank, then leftmost).  What is left of a word
are piece ids, or characters that fall back to their UTF-8 bytes.

Ids come back to the texts by a ragged gather, and are decoded by another one
over the bytes of the pieces.  There is no shuffle: a text is encoded where it
is read, and a task holds a chunk and a bounded table of words.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import chunks
from emporia.session import ship_package

BLANK = "▁"
NO_RANK = np.iinfo(np.int32).max
#: Bytes of text in a chunk, characters merged at once, tokens decoded at once.
CHUNK_BYTES, MERGE_CHARS, DECODE_TOKENS = 4 << 20, 1 << 20, 1 << 20
#: Words and ids that a task remembers.
KNOWN_WORDS, KNOWN_IDS = 1 << 20, 1 << 23


def gather(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions of the slices (start, length), end to end."""
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)


def one_mark_per_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return "�", error.start + 1


codecs.register_error("one-mark-per-byte", one_mark_per_byte)


class MergeRounds:
    """Merging of symbol sequences by a table of pairs (left, right, rank, merged)."""

    def __init__(self, pairs: np.ndarray):
        pairs = pairs[np.lexsort((pairs[:, 1], pairs[:, 0]))]
        self.keys = np.append(pairs[:, 0] << 32 | pairs[:, 1], np.iinfo(np.int64).max)
        self.ranks = np.append(pairs[:, 2], NO_RANK).astype(np.int32)
        self.made = np.append(pairs[:, 3], -1).astype(np.int32)
        # the lowest rank at which a symbol takes part in a pair
        self.lowest = np.full(int(pairs.max(initial=0)) + 1, NO_RANK, np.int32)
        for side in (0, 1):
            np.minimum.at(self.lowest, pairs[:, side], pairs[:, 2].astype(np.int32))

    def find(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NO_RANK: none) and merged symbol of pairs; negative symbols have none."""
        key = left.astype(np.int64) << 32 | right
        key[(left < 0) | (right < 0)] = -1
        at = np.searchsorted(self.keys, key)
        known = self.keys[at] == key
        return np.where(known, self.ranks[at], NO_RANK), np.where(known, self.made[at], -1)

    def run(self, sym: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What is left of each sequence, end to end in the given order, and
        the lengths.  Sequences have at least one symbol."""
        word = np.arange(len(lens))
        sym, lens, left_over = sym.astype(np.int32), lens.astype(np.int64), lens.astype(np.int64)
        rank, made = self.find(sym, np.append(sym[1:], -1))
        rank[np.cumsum(lens) - 1] = NO_RANK
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        while len(word):
            first = np.cumsum(lens) - lens
            lowest = np.minimum.reduceat(rank, first)
            done = lowest == NO_RANK
            if done.any():
                out = np.repeat(done, lens)
                finished.append((np.repeat(word[done], lens[done]), sym[out]))
                left_over[word[done]] = lens[done]
                sym, rank, made = sym[~out], rank[~out], made[~out]
                word, lens, lowest = word[~done], lens[~done], lowest[~done]
                continue
            at = self._leftmost(np.flatnonzero(rank == np.repeat(lowest, lens)))
            own = np.searchsorted(first, at, "right") - 1
            if (self.lowest[made[at]] <= rank[at]).any():
                safe = self._undisturbed(sym, rank, made, at, own, first, lens)
                at, own = at[safe], own[safe]
            sym[at] = made[at]
            kept = np.ones(len(sym), bool)
            kept[at + 1] = False
            sym, rank, made = sym[kept], rank[kept], made[kept]
            lens = lens - np.bincount(own, minlength=len(lens))
            # the pairs beside each merged symbol are new
            at = at - np.arange(len(at))
            at = np.unique(np.concatenate([at, at[at > 0] - 1]))
            rank[at], made[at] = self.find(sym[at], np.append(sym, -1)[at + 1])
            rank[np.cumsum(lens) - 1] = NO_RANK
        if not finished:
            return sym, left_over
        owner = np.concatenate([w for w, _ in finished])
        return np.concatenate([s for _, s in finished])[np.argsort(owner, kind="stable")], left_over

    @staticmethod
    def _leftmost(at: np.ndarray) -> np.ndarray:
        """Of pairs that overlap the next one, every other one from the left."""
        number = np.arange(len(at))
        begins = np.diff(at, prepend=-2) != 1
        return at[(number - np.maximum.accumulate(np.where(begins, number, 0))) % 2 == 0]

    def _undisturbed(self, sym, rank, made, at, own, first, lens) -> np.ndarray:
        """Which merges no new pair comes before: those of each word up to and
        with the first whose merged symbol pairs with a neighbour at its rank or lower."""
        new = made[at]
        behind = np.where(at > first[own], sym[np.maximum(at, 1) - 1], -1)
        joined = np.flatnonzero((at[1:] == at[:-1] + 2) & (own[1:] == own[:-1])) + 1
        behind[joined] = new[joined - 1]  # the neighbour has been merged itself by then
        ahead = np.where(at + 2 < (first + lens)[own], np.append(sym, [-1, -1])[at + 2], -1)
        soonest = np.minimum(self.find(behind, new)[0], self.find(new, ahead)[0])
        stops = np.cumsum(soonest <= rank[at])
        before = np.append(0, stops[:-1])
        return before == before[np.searchsorted(own, own, "left")]


class PieceCodec:
    """Encodes and decodes as the library of the model file does, for BPE
    models with byte fallback and without text normalisation (a blank is put in
    front, blanks become the mark U+2581)."""

    def __init__(self, model_path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = sp.vocab_size()
        self.byte_id = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        plain = [i for i in range(size)
                 if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        piece = {i: sp.id_to_piece(i) for i in plain}
        if (not all(map(sp.is_byte, self.byte_id.tolist()))
                or sp.normalize(" ﬁ  Å\t \n") != BLANK + " ﬁ  Å\t \n".replace(" ", BLANK)):
            raise ValueError("a BPE model with byte fallback and without normalisation is needed")
        symbol = {p: i for i, p in piece.items()}
        letters = sorted({c for p in symbol for c in p} - symbol.keys())
        symbol |= {c: size + k for k, c in enumerate(letters)}  # letters that are no pieces
        mixed = {i: p for i, p in piece.items() if len(p) > 1 and p.strip(BLANK)}
        self.runs = {len(p): i for i, p in piece.items() if not p.strip(BLANK)}
        scores = sorted({sp.get_score(i) for i in mixed}, reverse=True)
        blank_scores = {sp.get_score(i) for n, i in self.runs.items() if n > 1}
        if (any(BLANK in p[1:] or "\n" in p for p in mixed.values()) or len(blank_scores) > 1
                or 1 not in self.runs or (blank_scores and scores and max(blank_scores) >= scores[-1])):
            raise ValueError("pieces of the model span places where texts are cut")
        rank = {s: r for r, s in enumerate(scores)}
        self.rounds = MergeRounds(np.array(
            [(symbol[p[:k]], symbol[p[k:]], rank[sp.get_score(i)], i) for i, p in mixed.items()
             for k in range(1, len(p)) if p[:k] in symbol and p[k:] in symbol], np.int64).reshape(-1, 4))
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for c, s in symbol.items():
            if len(c) == 1:
                self.symbol_of[ord(c)] = s
        self.symbol_of[ord(" ")] = self.runs[1]
        self.size = size
        surface = [b"" if sp.is_control(i) else sp.decode([i]).encode() if sp.is_unknown(i)
                   else bytes([int(sp.id_to_piece(i)[1:-1], 16)]) if sp.is_byte(i)
                   else sp.id_to_piece(i).replace(BLANK, " ").encode() for i in range(size)]
        #: Bytes of each id's text, end to end.
        self.surface = np.frombuffer(b"".join(surface), np.uint8)
        self.length = np.array(list(map(len, surface)) + [0], np.int64)
        self.begin = np.append(np.cumsum(self.length[:-1]) - self.length[:-1], 0)
        self.blank_first = np.array([i in piece and piece[i][0] == BLANK for i in range(size)] + [False])
        self._forget()

    def _forget(self) -> None:
        self.code: dict[bytes, int] = {}
        self.ids = np.empty(1 << 16, np.int32)
        self.start, self.count = np.empty(1 << 12, np.int64), np.empty(1 << 12, np.int64)
        self.held = 0

    # --- encoding -------------------------------------------------------

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (UTF-8), end to end, and their number per text."""
        raw = [b" " + t.replace("▁".encode(), b" ") if t else b"" for t in texts]
        sizes = np.array(list(map(len, raw)), np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        if not len(data):
            return np.empty(0, np.int32), np.zeros(len(texts), np.int64)
        text_at = np.cumsum(sizes) - sizes
        blank, feed = data == 32, data == 10
        cut = np.ones(len(data), bool)
        cut[1:] = (blank[1:] & ~blank[:-1]) | (feed[1:] != feed[:-1])
        cut[text_at[sizes > 0]] = True
        at = np.flatnonzero(cut)
        words = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(at), [None, pa.py_buffer(np.append(at, len(data))), pa.py_buffer(data)]
        ).dictionary_encode()
        code = self._codes(words.dictionary.to_pylist())[words.indices.to_numpy()]
        counts = self.count[code]
        of_text = np.searchsorted(text_at, at, "right") - 1  # an empty text comes before its successor
        return self.ids[gather(self.start[code], counts)], np.bincount(
            of_text, counts, len(texts)).astype(np.int64)

    def _codes(self, words: list[bytes]) -> np.ndarray:
        """Places of the words in the task's table; new ones are merged first."""
        if len(self.code) > KNOWN_WORDS or self.held > KNOWN_IDS:
            self._forget()
        fresh = [w for w in words if w not in self.code]
        for part in chunks(iter(fresh), len, MERGE_CHARS):
            ids, counts = self._merged(part)
            n, total = len(self.code), self.held + len(ids)
            self.ids = _room(self.ids, total)
            self.start, self.count = _room(self.start, n + len(part)), _room(self.count, n + len(part))
            self.ids[self.held:total] = ids
            self.start[n:n + len(part)] = self.held + np.cumsum(counts) - counts
            self.count[n:n + len(part)] = counts
            self.code.update(zip(part, range(n, n + len(part))))
            self.held = total
        return np.fromiter(map(self.code.__getitem__, words), np.int64, len(words))

    def _merged(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words and their number per word."""
        blanks = [len(w) - len(w.lstrip(b" ")) for w in words]
        body = [w[max(0, k - 1):] if k < len(w) else b" " for w, k in zip(words, blanks)]
        data = np.frombuffer(b"".join(body), np.uint8)
        sizes = np.array(list(map(len, body)), np.int64)
        lens = np.add.reduceat((data & 0xC0) != 0x80, np.cumsum(sizes) - sizes).astype(np.int64)
        points = np.frombuffer(b"".join(body).decode().encode("utf-32-le"), np.uint32).astype(np.int32)
        sym = self.symbol_of[points]
        alone = (sym < 0) | (sym >= self.size)
        # a character that is no piece keeps its own number below zero if it can't merge
        sym = np.where(sym < 0, -2 - points, sym)
        sym, lens = self.rounds.run(sym, lens)
        if alone.any():
            letter = np.full(int(max(self.size, sym.max())) + 1, -1, np.int64)
            known = np.flatnonzero(self.symbol_of >= self.size)
            letter[self.symbol_of[known]] = known
            point = np.where(sym < 0, -2 - sym, letter[np.maximum(sym, 0)])
            to_bytes = (sym < 0) | (sym >= self.size)
            width = np.where(to_bytes, 1 + (point > 0x7F) + (point > 0x7FF) + (point > 0xFFFF), 1)
            owner = np.repeat(np.arange(len(lens)), lens)
            ids = np.repeat(sym, width)
            raw = "".join(map(chr, point[to_bytes].tolist())).encode()
            ids[np.repeat(to_bytes, width)] = self.byte_id[np.frombuffer(raw, np.uint8)]
            lens = np.bincount(owner, width, len(lens)).astype(np.int64)
            sym = ids
        long = [k for k, (w, n) in enumerate(zip(words, blanks)) if n > 1]
        if not long:
            return sym, lens
        parts = np.split(sym, np.cumsum(lens)[:-1])
        for k in long:
            # a blank that merged with nothing belongs to the run before it
            loose = int(parts[k][0] == self.runs[1])
            run = blanks[k] if blanks[k] == len(words[k]) else blanks[k] - 1 + loose
            parts[k] = np.concatenate([self._blank_run(run), parts[k][loose:]])
        return np.concatenate(parts), np.array(list(map(len, parts)), np.int64)

    def _blank_run(self, n: int) -> np.ndarray:
        """Ids of a run of blanks.  Its pieces share one rank below all others,
        so it merges from the left, a merged one at once with its left neighbour;
        a longest piece stays, and the run goes on as at its beginning."""
        longest, stack = max(self.runs), []
        for k in range(1, n + 1):
            stack.append(1)
            while len(stack) > 1 and stack[-2] + stack[-1] in self.runs:
                stack[-2:] = [stack[-2] + stack[-1]]
            if stack == [longest]:
                return np.concatenate([np.full(n // k, self.runs[longest], np.int32), self._blank_run(n % k)])
        return np.array([self.runs[x] for x in stack], np.int32)

    # --- decoding -------------------------------------------------------

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[str]:
        """Texts of sequences of ids, given end to end.  Ids outside the
        vocabulary give nothing, bytes that are no UTF-8 one U+FFFD each."""
        ids = np.where((ids >= 0) & (ids < self.size), ids, self.size)
        lens = self.length[ids]
        data = b"".join(
            self.surface[gather(self.begin[part], self.length[part])].tobytes()
            for part in (ids[k:k + DECODE_TOKENS] for k in range(0, len(ids), DECODE_TOKENS)))
        owner = np.repeat(np.arange(len(counts)), counts)
        size = np.bincount(owner, lens, len(counts)).astype(np.int64)
        # the blank in front: of the first id that has a text
        told = np.flatnonzero(lens)
        first = told[np.unique(owner[told], return_index=True)[1]]
        end = np.cumsum(size)
        begin = end - size
        begin[owner[first]] += self.blank_first[ids[first]]
        return [data[a:b].decode("utf-8", "one-mark-per-byte") for a, b in zip(begin.tolist(), end.tolist())]


def _room(array: np.ndarray, n: int) -> np.ndarray:
    """The array, or one with room for ``n`` that begins with it."""
    if n <= len(array):
        return array
    larger = np.empty(max(n, 2 * len(array)), array.dtype)
    larger[:len(array)] = array
    return larger


def _mapped(rows: DataFrame, id_col: str, value: str, kind: str, out: str, transform) -> DataFrame:
    """``transform`` (batch -> batches of the columns after the identifier)
    over (id, value) rows."""
    ship_package(rows.sparkSession)
    name = rows.schema[id_col].dataType.simpleString()
    return rows.select(F.col(id_col).alias("id"), F.col(value).cast(kind).alias("value")).mapInArrow(
        transform, f"id {name}, {out}").withColumnRenamed("id", id_col)


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
           decoded: bool = False) -> DataFrame:
    """One row per input row: the identifier, ``n_tokens``, ``ids`` (an array,
    without begin or end ids) and, if asked for, ``decoded``, the text of those ids.

    A null text is the empty text, which has no ids.  Null and repeated
    identifiers pass through; special strings inside texts are plain text; a
    mark U+2581 inside a text counts as a blank, and is decoded to one, as in the
    library.  Other columns are not read.  ``model_path`` names the file on every node.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(model_path)
        for batch in batches:
            texts = ((i, x.as_py() or b"") for i, x in enumerate(batch.column(1)))
            for part in chunks(texts, lambda x: len(x[1]), CHUNK_BYTES):
                ids, counts = codec.encode([t for _, t in part])
                own = batch.column(0).slice(part[0][0], len(part))
                lists = pa.ListArray.from_arrays(np.append(0, np.cumsum(counts)).astype(np.int32), pa.array(ids, pa.int32()))
                found = [own, pa.array(counts), lists]
                if decoded:
                    found.append(pa.array(codec.decode(ids, counts), pa.string()))
                yield pa.RecordBatch.from_arrays(found, ["id", "n_tokens", "ids", "decoded"][:len(found)])

    out = "n_tokens long, ids array<int>" + (", decoded string" if decoded else "")
    return _mapped(docs, id_col, text_col, "binary", out, run)


def decode(rows: DataFrame, model_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The identifier and ``decoded``, the text of each row's array of ids.  A
    null or empty array gives the empty text; null ids and ids that the model
    lacks give nothing; ids of bytes that are no UTF-8 give U+FFFD."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = PieceCodec(model_path)
        for batch in batches:
            lists = ((i, x.as_py() or []) for i, x in enumerate(batch.column(1)))
            for part in chunks(lists, lambda x: len(x[1]), DECODE_TOKENS):
                counts = np.array([len(x) for _, x in part], np.int64)
                ids = np.array([-1 if i is None else i for _, x in part for i in x], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part[0][0], len(part)),
                     pa.array(codec.decode(ids, counts), pa.string())], ["id", "decoded"])

    return _mapped(rows, id_col, ids_col, "array<long>", "decoded string", run)
