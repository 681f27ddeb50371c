"""Vector bin packing of token sequences.

Every example has three sizes: tokens, one segment, and loss-bearing tokens.
A bin is a training sequence with a limit on each.  Bins are filled one at a
time from a bounded pool of waiting examples by the dot-product heuristic:
of the examples that fit, place the one whose sizes (as shares of the limits)
have the largest dot product with what is left of the bin.

With ``cut`` an example may be divided: what is longer than a sequence fills
whole sequences first, and when nothing fits the best example is cut to what
is left, so bins are full but for those closed by another limit or by the end
of the input.  Such a rest is laid out in sequences whose lengths are powers
of two, largest first, which need no padding.

Each task packs the rows it reads; there is no shuffle, and a task holds one
batch and one pool.  Sequence numbers carry the partition's number in their
high bits.  They, and the cuts, repeat exactly when a lost task runs again as
long as its input rows come in the same order, as rows read from files do.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.session import ship_package

SEQUENCE_BITS = 33
#: The pattern's \s (Unicode White_Space), and a run's length from which it is
#: cut out: the pattern backtracks over a run, with a limit of about 1,000,000.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 1 << 16
SCHEMA = ("start long, length long, ids binary, doc_tokens long, "
          "sequence_id long, offset long, segment long, loss_tokens long")


@dataclass
class Example:
    """Tokens of one example, from ``start`` on; ``loss`` counts the
    loss-bearing ones before each position (None: all bear loss)."""

    row: object
    ids: np.ndarray
    total: int
    start: int = 0
    loss: np.ndarray | None = None

    @property
    def tokens(self) -> int:
        return len(self.ids) - self.start

    def loss_to(self, length: int) -> int:
        if self.loss is None:
            return length
        return int(self.loss[self.start + length] - self.loss[self.start])

    def longest(self, tokens: int, loss: int) -> int:
        """Largest length within both limits."""
        if self.loss is None:
            return min(tokens, loss, self.tokens)
        most = int(np.searchsorted(self.loss, self.loss[self.start] + loss, "right")) - 1 - self.start
        return min(tokens, most, self.tokens)


class Packer:
    """``limits``: tokens, segments, loss-bearing tokens of a sequence."""

    def __init__(self, limits: tuple[int, int, int], cut: bool, pool: int, first_sequence: int = 0):
        self.limits = np.array(limits, np.int64)
        self.cut, self.size, self.next = cut, pool, first_sequence
        self.pool: list[Example | None] = [None] * pool
        self.free = list(range(pool))
        self.need = np.zeros((pool, 3), np.int64)
        self.used = np.zeros(pool, bool)

    def add(self, example: Example) -> Iterator[tuple]:
        """Rows (row, start, length, ids, total, sequence, offset, segment,
        loss) that adding the example completes."""
        if not self.cut:
            need = (example.tokens, 1, example.loss_to(example.tokens))
            if any(n > m for n, m in zip(need, self.limits)):
                # too large for any sequence and not to be cut: one of its own
                yield from self._lay([(example, example.tokens)])
                return
        while self.cut:
            t = example.longest(int(self.limits[0]), int(self.limits[2]))
            if t == example.tokens and t < self.limits[0]:
                break
            # it fills the tokens or the loss-bearing ones of a sequence alone
            yield from self._lay([(example, t)])
            example = self._after(example, t)
            if not example.tokens:
                return
        if not example.tokens:
            return
        # what waits is within every limit, so an empty bin takes at least one whole
        while not self.free:
            yield from self._fill(final=False)
        slot = self.free.pop()
        self.pool[slot] = example
        self._size(slot)

    def flush(self) -> Iterator[tuple]:
        while self.used.any():
            yield from self._fill(final=True)

    def _after(self, example: Example, t: int) -> Example:
        return Example(example.row, example.ids, example.total, example.start + t, example.loss)

    def _size(self, slot: int) -> None:
        e = self.pool[slot]
        self.need[slot] = e.tokens, 1, e.loss_to(e.tokens)
        self.used[slot] = True

    def _fill(self, final: bool) -> Iterator[tuple]:
        left = self.limits.copy()
        placed: list[tuple[Example, int]] = []
        while left[0] > 0 and left[1] > 0 and self.used.any():
            gain = (self.need / self.limits) @ (left / self.limits)
            fits = self.used & (self.need <= left).all(axis=1)
            if fits.any():
                slot = int(np.argmax(np.where(fits, gain, -1.0)))
                t = self.pool[slot].tokens
            elif self.cut:
                slot = int(np.argmax(np.where(self.used, gain, -1.0)))
                t = self.pool[slot].longest(int(left[0]), int(left[2]))
                if t == 0:
                    break
            else:
                break
            example = self.pool[slot]
            placed.append((example, t))
            left -= (t, 1, example.loss_to(t))
            if t == example.tokens:
                self.pool[slot], self.used[slot] = None, False
                self.free.append(slot)
            else:
                self.pool[slot] = self._after(example, t)
                self._size(slot)
        yield from self._lay(placed)

    def _lay(self, placed: list[tuple[Example, int]]) -> Iterator[tuple]:
        """The rows of one bin; with ``cut``, of sequences that need no padding."""
        rest = sum(t for _, t in placed)
        room, offset, segment = 0, 0, 0
        for example, t in placed:
            while t:
                if not room:
                    room = rest
                    if self.cut and rest != self.limits[0]:
                        room = 1 << (rest.bit_length() - 1)
                    rest -= room
                    sequence, offset, segment = self.next, 0, 0
                    self.next += 1
                n = min(t, room)
                ids = example.ids[example.start:example.start + n]
                yield (example.row, example.start, n, ids.astype("<u4").tobytes(), example.total,
                       sequence, offset, segment, example.loss_to(n))
                example, t, room = self._after(example, n), t - n, room - n
                offset, segment = offset + n, segment + 1


def pack(rows: DataFrame, encoder: Callable[[], Callable[[object], np.ndarray]], id_col: str,
         text: Column, max_tokens: int = 2048, max_segments: int = 512,
         max_loss: int | None = None, prompt: Column | None = None, cut: bool = True,
         pool: int = 512) -> DataFrame:
    """One row per piece: the identifier, ``start``, ``length``, ``ids`` (as
    little-endian 32-bit integers), ``doc_tokens``, ``sequence_id``,
    ``offset``, ``segment`` and ``loss_tokens``.

    ``encoder()`` is called in the task and returns text -> uint32 ids, the
    closing id included.  ``prompt``: text in front whose tokens (encoded
    without their closing id) bear no loss.  A null text is empty; an example
    without any token gives no row; null and repeated identifiers pass
    through, each row being an example.  Without ``cut`` an example beyond a
    limit gets a sequence of its own.
    """
    limits = (max_tokens, max_segments, max_tokens if max_loss is None else max_loss)
    if min(limits) < 1:
        raise ValueError("limits must be positive")
    has_prompt = prompt is not None
    ship_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder()
        context = TaskContext.get()
        part = context.partitionId() if context else 0
        packer = Packer(limits, cut, pool, part << SEQUENCE_BITS)
        kind = None

        def frame(found: list[tuple]) -> pa.RecordBatch:
            names, kinds = zip(*(x.split() for x in SCHEMA.split(", ")))
            arrow = [kind] + [pa.binary() if k == "binary" else pa.int64() for k in kinds]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*found), arrow)], ["id", *names])

        found: list[tuple] = []
        for batch in batches:
            kind = batch.schema.field(0).type
            for i in range(batch.num_rows):
                ids = encode(batch.column(1)[i].as_py() or "")
                loss = None
                if has_prompt:
                    lead = encode(batch.column(2)[i].as_py() or "")[:-1]
                    bears = np.r_[np.zeros(len(lead), np.int64), np.ones(len(ids), np.int64)]
                    ids, loss = np.concatenate([lead, ids]), np.r_[0, np.cumsum(bears)]
                found.extend(packer.add(Example(batch.column(0)[i].as_py(), ids, len(ids), 0, loss)))
                if len(found) >= 2048:
                    yield frame(found)
                    found = []
        found.extend(packer.flush())
        if found:
            yield frame(found)

    kind = rows.schema[id_col].dataType.simpleString()
    cols = [F.col(id_col).alias("id"), text.alias("text")] + ([prompt.alias("prompt")] if has_prompt else [])
    return rows.select(*cols).mapInArrow(run, f"id {kind}, {SCHEMA}").withColumnRenamed("id", id_col)


def byte_bpe_encoder(path: str, closing_id: int = 1) -> Callable[[], Callable[[str], np.ndarray]]:
    """Encoder of a byte-level BPE file with the GPT-2 word pattern; special
    tokens inside a text get their own ids, as the file's library does.

    A long run of blanks is merged apart, without the pattern: it is one word,
    less its last character where anything but a special token follows."""
    def build() -> Callable[[str], np.ndarray]:
        import json
        import re

        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        alphabet = byte_alphabet()
        ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items()
                 if token not in special}
        import public_tokenizers

        bpe = tiktoken.Encoding("pack", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                special_tokens=special)
        close = np.array([closing_id], np.uint32)

        long_run = re.compile(f"(?<![{BLANKS}])[{BLANKS}]{{{LONG_RUN},}}")
        starts = tuple(special)

        def plain(text: str) -> np.ndarray:
            return np.asarray(bpe.encode_to_numpy(text, allowed_special="all"), np.uint32)

        def encode(text: str) -> np.ndarray:
            parts, at = [], 0
            for run in long_run.finditer(text) if len(text) >= LONG_RUN else ():
                end = run.end()
                if end < len(text) and not (starts and text.startswith(starts, end)):
                    end -= 1
                parts += [plain(text[at:run.start()]),
                          np.array(bpe._core_bpe.encode_single_piece(text[run.start():end].encode()), np.uint32)]
                at = end
            return np.concatenate([*parts, plain(text[at:] if at else text), close])

        return encode

    return build


def byte_alphabet() -> dict[str, int]:
    """The byte each character of a byte-level vocabulary stands for: printable
    Latin-1 characters for themselves, the others in order from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id",
                   text_col: str = "text", **limits) -> DataFrame:
    """Pack the whole text of every row (null: empty), its closing id included."""
    return pack(docs, byte_bpe_encoder(tokenizer_path), id_col,
                F.coalesce(F.col(text_col), F.lit("")), **limits)
