"""Runs of periodically repeated words, found on a Re-Pair grammar.

A run is a maximal stretch of words with smallest period q (words q apart are
equal) that holds the period at least ``min_repeats`` times and ``min_words``
words.

1. A task holds a chunk of texts as one array of word ids and pairs it up
   (Re-Pair): in a round every pair of neighbouring symbols of a text is
   counted, and a pair is replaced by the symbol of its kind wherever it is more
   frequent than the two pairs overlapping it.  Frequencies count by their
   power of two, ties go by a hash of the pair, and of a pair that overlaps
   itself every other one is taken, so a text shrinks by a constant factor a
   round.  In the end each text is one symbol, and equal stretches of text in
   equal surroundings are derived from equal symbols, within a text and between
   the texts of the chunk.
2. A run that lies in the text of a symbol but in neither of its halves crosses
   their boundary.  One side of the boundary then holds half of the repeats, so
   the period occurs twice in a row right before or right after the boundary;
   those squares are looked for once for each symbol, in its first occurrence,
   and extended to both sides by comparing hashes of prefixes, then word by
   word.
3. The runs of a symbol are carried to all positions it was derived at, and
   what lies in a longer run of the same period (a run cut off at the end of a
   symbol's text, which a symbol above it has whole) is dropped.

A text's first occurrence stands for its symbols, so nothing is ever expanded.
There is no shuffle: a text is worked on where it is read.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import chunks, seeds, splitmix
from emporia.session import ship_package

#: Bytes of text worked on together.
CHUNK_BYTES = 4 << 20
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
BASE = np.uint64(0x9E3779B97F4A7C15)
RUN = "start long, length long, period long"


class Grammar:
    """The symbols of texts of word ids: where each kind of pair first
    occurs (``at``), its length and its left half's, and all its positions."""

    def __init__(self, words: np.ndarray, text: np.ndarray):
        n_words = int(words.max(initial=-1)) + 1
        self.at, self.length, self.left = [], [], []
        self.kinds, self.places = [], []
        sym, at = words.astype(np.int64), np.arange(len(words))
        size, self.count = np.ones(len(words), np.int64), 0
        while True:
            own = text[at]
            same = own[1:] == own[:-1]
            if not same.any():
                break
            key = (sym[:-1] << 32) | sym[1:]
            kind, pairs = pd.factorize(key)
            chosen = self._chosen(kind, same, np.bincount(kind[same], minlength=len(pairs)), pairs)
            kind, pairs = pd.factorize(kind[chosen])
            first = np.empty(len(pairs), np.int64)
            first[kind[::-1]] = chosen[::-1]
            self.at.append(at[first])
            self.left.append(size[first])
            self.length.append(size[first] + size[first + 1])
            self.kinds.append(kind + self.count)
            self.places.append(at[chosen])
            sym[chosen] = kind + (n_words + self.count)
            size[chosen] += size[chosen + 1]
            self.count += len(pairs)
            kept = np.ones(len(sym), bool)
            kept[chosen + 1] = False
            sym, at, size = sym[kept], at[kept], size[kept]

        def joined(parts: list) -> np.ndarray:
            return np.concatenate(parts) if parts else np.empty(0, np.int64)

        self.at, self.length, self.left = joined(self.at), joined(self.length), joined(self.left)
        self.kinds, self.places = joined(self.kinds), joined(self.places)

    @staticmethod
    def _chosen(kind: np.ndarray, same: np.ndarray, count: np.ndarray, pairs: np.ndarray) -> np.ndarray:
        """Positions of pairs that outrank the pairs overlapping them."""
        often = np.frexp(count.astype(np.float64))[1].astype(np.uint64)  # grows with the power of two
        with np.errstate(over="ignore"):
            mixed = splitmix(pairs.astype(np.uint64) * BASE)
        order = (often << np.uint64(57)) | (mixed >> np.uint64(7))
        # distinct kinds get distinct ranks
        level = np.empty(len(pairs), np.int64)
        level[np.lexsort((pairs, order))] = np.arange(1, len(pairs) + 1)
        rank = np.where(same, level[kind], 0)
        before, after = np.append(0, rank[:-1]), np.append(rank[1:], 0)
        # stretches of one kind: every other one from the left
        number = np.arange(len(rank))
        begins = (rank != before) | (number == 0)
        step = number - np.maximum.accumulate(np.where(begins, number, 0))
        top = (rank > 0) & (rank >= before) & (rank >= after)
        # a stretch counts only if both its ends outrank what is beside them
        stretch = np.cumsum(begins) - 1
        bad = np.bincount(stretch, ~top) > 0
        return np.flatnonzero(top & ~bad[stretch] & (step % 2 == 0))


class PrefixHash:
    """Equality of slices of a word array by polynomial hashes of prefixes."""

    def __init__(self, words: np.ndarray):
        with np.errstate(over="ignore"):
            value = splitmix(words.astype(np.uint64) + seeds(1, 11)[0])
            self.power = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(len(words), BASE, np.uint64)]))
            self.sums = np.append(np.zeros(1, np.uint64), np.cumsum(value * self.power[:-1]))

    def equal(self, a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Whether [a, a + n) and [b, b + n), b >= a, have equal hashes."""
        with np.errstate(over="ignore"):
            return ((self.sums[a + n] - self.sums[a]) * self.power[b - a]) == self.sums[b + n] - self.sums[b]

    def agree(self, a: np.ndarray, q: np.ndarray, room: np.ndarray, sign: int) -> np.ndarray:
        """How many words from ``a`` on (sign 1) or before ``a`` (sign -1),
        at most ``room``, equal the words q further."""
        low, high = np.zeros_like(room), room.copy()
        while (low < high).any():
            mid = (low + high + 1) >> 1
            begin = a if sign > 0 else a - mid
            ok = self.equal(begin, begin + q, mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low


def _ranges(starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Owner and value of the numbers start, start + 1, ... of each range."""
    ends = np.cumsum(lens)
    owner = np.repeat(np.arange(len(lens)), lens)
    return owner, np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - lens, lens) + starts[owner]


def _squares(words: np.ndarray, hashes: PrefixHash, begin: np.ndarray, size: np.ndarray,
             sign: int) -> tuple[np.ndarray, np.ndarray]:
    """(owner, q): the slices [begin, begin + size) that begin (sign 1) or end
    (sign -1) with a square of two times q words, q being no multiple of a shorter period of it."""
    owners, periods = [], []
    edge = begin if sign > 0 else begin + size - 1
    for part in _blocks(size // 2):
        owner, q = _ranges(np.ones(part.stop - part.start, np.int64), size[part] // 2)
        owner += part.start
        hit = words[edge[owner]] == words[edge[owner] + sign * q]
        owner, q = owner[hit], q[hit]
        a = edge[owner] if sign > 0 else edge[owner] + 1 - 2 * q
        hit = hashes.equal(a, a + q, q)
        owners.append(owner[hit])
        periods.append(q[hit])
    owner = np.concatenate([np.empty(0, np.int64), *owners])
    q = np.concatenate([np.empty(0, np.int64), *periods])
    # by rising q; one inside the reach of a shorter one repeats that one's period
    found = [(owner[:0], q[:0])]
    while len(owner):
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        own, least = owner[first], q[first]
        low, high = begin[own], begin[own] + size[own]
        a, b = _stretch(words, hashes, low if sign > 0 else high - least, least, low, high)
        square = b - a >= 2 * least  # else two different words had one hash
        found.append((own[square], least[square]))
        rest = 2 * q > np.repeat(np.where(square, b - a, 0), np.diff(np.append(first, len(owner))))
        rest[first] = False
        owner, q = owner[rest], q[rest]
    return np.concatenate([o for o, _ in found]), np.concatenate([p for _, p in found])


def _stretch(words: np.ndarray, hashes: PrefixHash, begin: np.ndarray, q: np.ndarray, low: np.ndarray,
             high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The longest [first, last) of period q around [begin, begin + q) within
    [low, high): by hashes, and where the words don't bear it out by the words."""
    first = begin - hashes.agree(begin, q, begin - low, -1)
    last = begin + q + hashes.agree(begin, q, high - begin - q, 1)
    for k in _unequal(words, first, last, q):
        differ = np.flatnonzero(words[low[k]:high[k] - q[k]] != words[low[k] + q[k]:high[k]]) + low[k]
        at = int(np.searchsorted(differ, begin[k]))
        first[k] = differ[at - 1] + 1 if at else low[k]
        last[k] = differ[at] + q[k] if at < len(differ) else high[k]
    return first, last


def _blocks(weight: np.ndarray, limit: int = 1 << 22) -> Iterator[slice]:
    """Consecutive slices of about ``limit`` total weight each."""
    block = np.cumsum(weight) // limit
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(block)) + 1, [len(weight)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        if b > a:
            yield slice(a, b)


def find_runs(words: np.ndarray, text: np.ndarray, min_repeats: int = 4,
              min_words: int = 6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, period) of all runs of texts of word ids laid end to end;
    ``text`` numbers each word's text, in rising order."""
    if min_repeats < 4:
        raise ValueError("a run must repeat its period four times or more")  # else no half holds a square
    grammar = Grammar(words, text)
    none = np.empty(0, np.int64)
    if not grammar.count:
        return none, none, none
    hashes = PrefixHash(words)
    at, size = grammar.at, grammar.length
    middle, end = at + grammar.left, at + size
    right = _squares(words, hashes, middle, end - middle, 1)
    left = _squares(words, hashes, at, middle - at, -1)
    rule, q = np.concatenate([left[0], right[0]]), np.concatenate([left[1], right[1]])
    # a square's place: it ends or begins at the boundary
    begin = np.concatenate([middle[left[0]] - 2 * left[1], middle[right[0]]])
    first, last = _stretch(words, hashes, begin, q, at[rule], end[rule])
    able = (last - first >= np.maximum(min_repeats * q, min_words)) & (first < middle[rule]) & (last > middle[rule])
    rule, q, first, last = rule[able], q[able], first[able], last[able]
    if not len(rule):
        return none, none, none
    # to all places the symbols were derived at
    by_rule = np.argsort(rule, kind="stable")
    rule, q, first, last = rule[by_rule], q[by_rule], first[by_rule], last[by_rule]
    n_runs = np.bincount(rule, minlength=grammar.count)
    here = n_runs[grammar.kinds] > 0
    kinds, places = grammar.kinds[here], grammar.places[here]
    owner, run = _ranges((np.cumsum(n_runs) - n_runs)[kinds], n_runs[kinds])
    move = places[owner] - at[rule[run]]
    return _maximal(first[run] + move, last[run] + move, q[run])


def _unequal(words: np.ndarray, first: np.ndarray, last: np.ndarray, q: np.ndarray) -> list[int]:
    """Which stretches don't have their period word by word."""
    wrong: list[int] = []
    for part in _blocks(last - first):
        owner, k = _ranges(first[part], (last - first - q)[part])
        off = words[k] != words[k + q[part][owner]]
        wrong += (np.unique(owner[off]) + part.start).tolist()
    return wrong


def _maximal(first: np.ndarray, last: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Intervals, once each, that lie in no longer one of the same period; by start, then period."""
    order = np.lexsort((-last, first, q))
    first, last, q = first[order], last[order], q[order]
    # all numbers of one period lie above those of the periods before it
    shift = np.cumsum(np.append(0, np.diff(q) != 0)) * (int(last.max()) + 1)
    reach = np.maximum.accumulate(last + shift)
    new = np.append(True, (last + shift)[1:] > reach[:-1])
    first, last, q = first[new], last[new], q[new]
    order = np.lexsort((q, first))
    return first[order], last[order], q[order]


class Words:
    """The words of a chunk of texts: ids, the texts they belong to, and the
    dictionary of their bytes."""

    def __init__(self, texts: list[bytes]):
        data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        space = SPACE[data]
        begins = np.flatnonzero(~space & np.append(True, space[:-1]))
        ends = np.flatnonzero(space & np.append(False, ~space[:-1]))
        close = np.cumsum([len(t) + 1 for t in texts])
        self.counts = np.diff(np.searchsorted(begins, close), prepend=0)
        offsets = np.append(0, np.cumsum(ends - begins))
        coded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(data[~space])]
        ).dictionary_encode()
        self.ids = coded.indices.to_numpy().astype(np.int64)
        self.names = coded.dictionary.to_pylist()


def _looped(n: int, seed: int) -> np.ndarray:
    """Positions of the words of a text with a planted loop."""
    a = seed % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + seed % 8)))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_repeats: int = 4,
                  min_words: int = 6, loop: Column | None = None) -> DataFrame:
    """One row per input row: the identifier, ``n_words``, ``runs`` (an array
    of start, length and period, in words from 0, by start, then period),
    ``strongest`` (the run with the greatest length / period; of equals the
    one with the smallest start, then period; null without a run) and
    ``collapsed``, the words joined by one space without those that any run
    holds after its first period.

    Words are what blanks, tabs, line feeds, vertical tabs, form feeds and
    carriage returns separate.  A null, empty or blank text has no words and
    no runs and collapses to the empty text.  Null and repeated identifiers
    pass through; other columns are not read.  ``loop``: for tests of recall, a
    long column; where it is not null, the words from number loop % n on are replaced by
    repeats of the first (n - loop % n) // (3 + loop % 8) + 1 of them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(range(batch.num_rows), batch.column(1), batch.column(2).to_pylist())
            rows = ((i, t.as_py() or b"", x) for i, t, x in rows)
            for part in chunks(rows, lambda r: len(r[1]), CHUNK_BYTES):
                words = Words([t for _, t, _ in part])
                ends = np.cumsum(words.counts)
                for (_, _, seed), a, b in zip(part, (ends - words.counts).tolist(), ends.tolist()):
                    if seed is not None and b > a:
                        words.ids[a:b] = words.ids[a:b][_looped(b - a, seed)]
                text = np.repeat(np.arange(len(part)), words.counts)
                first, last, q = find_runs(words.ids, text, min_repeats, min_words)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part[0][0], len(part)), pa.array(words.counts),
                     *_columns(words, ends, text, first, last, q)],
                    ["id", "n_words", "runs", "strongest", "collapsed"])

    ship_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    seed = F.lit(None) if loop is None else loop
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text"),
                       seed.cast("long").alias("loop")).mapInArrow(
        run, f"id {kind}, n_words long, runs array<struct<{RUN.replace(' ', ':')}>>, "
             f"strongest struct<{RUN.replace(' ', ':')}>, collapsed string".replace(",:", ", ")
    ).withColumnRenamed("id", id_col)


def _columns(words: Words, ends: np.ndarray, text: np.ndarray, first: np.ndarray, last: np.ndarray,
             q: np.ndarray) -> list[pa.Array]:
    """Runs, strongest run and collapsed text of each text of a chunk."""
    own = text[first]
    number = np.searchsorted(own, np.arange(len(ends) + 1))
    start = first - (ends - words.counts)[own]
    struct = pa.StructArray.from_arrays([pa.array(start), pa.array(last - first), pa.array(q)],
                                        ["start", "length", "period"])
    runs = pa.ListArray.from_arrays(number.astype(np.int32), struct)
    strongest = [max(range(a, b), key=lambda k: (Fraction(int(last[k] - first[k]), int(q[k])), -start[k], -q[k]))
                 if b > a else None for a, b in zip(number[:-1].tolist(), number[1:].tolist())]
    # words after a run's first period: one more where such a stretch opens, one less behind it
    depth = np.zeros(len(text) + 1, np.int64)
    np.add.at(depth, first + q, 1)
    np.add.at(depth, last, -1)
    kept = np.cumsum(depth)[:-1] == 0
    shown = words.ids[kept].tolist()
    cut = np.append(0, np.cumsum(kept))[np.append(0, ends)].tolist()
    name = words.names.__getitem__
    collapsed = [b" ".join(map(name, shown[a:b])) for a, b in zip(cut[:-1], cut[1:])]
    return [runs, struct.take(pa.array(strongest, pa.int64())),
            pa.array(collapsed, pa.binary()).cast(pa.string())]
