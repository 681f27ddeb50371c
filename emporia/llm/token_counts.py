"""Token counts of a sentencepiece BPE model by rank-synchronous merging.

Texts are cut into pre-tokens at spaces and line feeds, places no piece of the
model spans.  Each task keeps the counts of the pre-tokens it has met in a
bounded table; the new ones of a batch are held as ragged arrays and merged
together (``rank_merge``), and the surviving symbols are counted.  There is no
shuffle: each text is counted where it is read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.common import chunks
from emporia.llm.rank_merge import RankMerger
from emporia.session import ship_package

BLANK = "▁"
#: Pre-tokens whose counts a task remembers, and characters merged at once.
KNOWN_LIMIT = 1_000_000
BATCH_CHARS = 1 << 20


class PieceCounter:
    """Counts tokens as the model's library does, for BPE models without text
    normalisation (spaces become a blank mark, one is put in front)."""

    def __init__(self, model_path: str):
        sp = sentencepiece.SentencePieceProcessor(model_file=model_path)
        ids = [i for i in range(sp.vocab_size())
               if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))]
        score = {sp.id_to_piece(i): sp.get_score(i) for i in ids}
        rank = {s: r for r, s in enumerate(sorted(set(score.values()), reverse=True))}
        symbol = {p: i for i, p in enumerate(score)}
        chars = {c for p in score for c in p}
        for c in sorted(chars - symbol.keys()):
            symbol[c] = len(symbol)
        pairs = [(symbol[p[:k]], symbol[p[k:]], rank[score[p]], symbol[p])
                 for p in score for k in range(1, len(p))
                 if p[:k] in symbol and p[k:] in symbol]
        # whitespace-only pieces rank below all others, so a run of blanks is
        # merged after the word behind it took the last one
        runs = {len(p) for p in score if set(p) == {BLANK} and len(p) > 1}
        mixed = [p for p in score if len(p) > 1 and set(p) != {BLANK}]
        worst = max((rank[score[p]] for p in mixed), default=-1)
        blank_ranks = {rank[score[BLANK * k]] for k in runs}
        if (any(BLANK in p[1:] or "\n" in p for p in mixed) or len(blank_ranks) > 1
                or any(r <= worst for r in blank_ranks)):
            raise ValueError("the model's pieces span pre-token boundaries")
        self.run_sizes = runs
        self.run_tokens = {0: 0}
        self.merger = RankMerger(np.array(pairs, np.int64))
        self.char = np.full(0x110000, -1, np.int64)
        code = np.arange(0x110000)
        utf8 = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        self.char_cost = utf8.astype(np.int64)  # a character without a piece falls back to bytes
        for c in chars:
            self.char[ord(c)] = symbol[c]
            if c in score:
                self.char_cost[ord(c)] = 1
        self.cost = np.ones(len(symbol), np.int64)
        for c in chars - score.keys():
            self.cost[symbol[c]] = len(c.encode())
        self.bare = symbol.get(BLANK, -1)
        self.newline = int(self.char_cost[ord("\n")])
        self.known: dict[str, int] = {}
        self.loose: dict[str, bool] = {}

    def learn(self, words: list[str]) -> None:
        """Count new pre-tokens, batched by characters."""
        for part in chunks(iter(words), len, BATCH_CHARS):
            lens = np.fromiter(map(len, part), np.int64, len(part))
            codes = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32)
            sym, cost = self.char[codes], self.char_cost[codes]
            unknown = np.add.reduceat(np.append(np.where(sym < 0, cost, 0), 0),
                                      np.cumsum(lens) - lens) * (lens > 0)
            out, n = self.merger.merge(sym, lens)
            own = np.repeat(np.arange(len(part)), n)
            counts = np.bincount(own, np.where(out >= 0, self.cost[out], 0), len(part)).astype(np.int64)
            first = np.append(out, -1)[np.cumsum(n) - n]
            self.known.update(zip(part, (counts + unknown).tolist()))
            # a blank in front that merged with nothing joins the run before it
            self.loose.update((w, True) for w, f in zip(part, first.tolist())
                              if f == self.bare and w[:1] == BLANK)

    def runs(self, blanks: int) -> int:
        """Tokens of a run of blanks: pieces of blanks share one rank, so they
        merge from the left, and a merged one at once with its left neighbour."""
        if blanks not in self.run_tokens:
            settled: list[int] = []
            for _ in range(blanks):
                settled.append(1)
                while len(settled) > 1 and settled[-2] + settled[-1] in self.run_sizes:
                    settled[-2:] = [settled[-2] + settled[-1]]
            self.run_tokens[blanks] = len(settled)
        return self.run_tokens[blanks]

    def line(self, words: list[str]) -> int:
        """Tokens of one line, cut at its blanks (the first word had none)."""
        known = self.known
        total, blanks = (known[words[0]] if words[0] else 0), 0
        for w in words[1:]:
            if not w:
                blanks += 1
                continue
            marked = BLANK + w
            total += known[marked]
            if blanks:
                loose = marked in self.loose
                total += self.runs(blanks + loose) - loose
                blanks = 0
        return total + self.runs(blanks)

    def count(self, texts: list[str | None]) -> list[int]:
        lines = [[] if not t else
                 [x.split(BLANK) for x in (BLANK + t.replace(" ", BLANK)).split("\n")] for t in texts]
        fresh = set()
        for text in lines:
            for words in text:
                fresh.add(words[0])
                fresh.update([BLANK + w for w in words[1:]])
        if len(self.known) + len(fresh) > KNOWN_LIMIT:
            self.known.clear()
            self.loose.clear()
        fresh.difference_update(self.known)
        self.learn(sorted(fresh))
        known = self.known
        out = []
        for text in lines:
            total = max(0, len(text) - 1) * self.newline
            for words in text:
                if "" in words:
                    total += self.line(words)
                else:
                    total += known[words[0]] + sum([known[BLANK + w] for w in words[1:]])
            out.append(total)
        return out


def token_counts(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """One row per input row: the identifier, ``n_bytes`` (UTF-8), ``n_tokens``
    and ``over_limit`` (more than ``limit`` tokens).

    A null text counts as empty and has no tokens; null and repeated
    identifiers pass through; special strings inside texts are plain text.
    Other columns are not read.  ``model_path`` names the tokenizer file on
    every node.
    """
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PieceCounter(model_path)
        for batch in batches:
            n: list[int] = []
            for part in chunks((x.as_py() for x in batch.column(2)), lambda t: len(t or ""), 4 << 20):
                n += counter.count(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64())], ["id", "n_bytes", "n"])

    kind = docs.schema[id_col].dataType.simpleString()
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"),
                          text.alias("text")).mapInArrow(count, f"id {kind}, n_bytes long, n long")
    return counted.select(F.col("id").alias(id_col), "n_bytes", F.col("n").alias("n_tokens"),
                          (F.col("n") > limit).alias("over_limit"))
