"""Byte-pair merging on ragged numpy arrays, one rank at a time.

Many symbol sequences are held end to end in one array.  In a step every
sequence merges its own lowest-rank adjacent pair wherever it occurs, all
sequences at once.  Merging occurrences together is exact unless a merged
symbol could at once form a pair of equal or lower rank with a neighbour;
a sequence is then merged only up to the first such occurrence, which is the
order a one-at-a-time merge would follow (lowest rank, then leftmost).
"""

from __future__ import annotations

import numpy as np

NEVER = np.iinfo(np.int64).max


class RankMerger:
    """``pairs``: (left, right, rank, merged) rows of symbol ids >= 0; pairs
    of equal rank are merged from the left.  Negative ids never merge."""

    def __init__(self, pairs: np.ndarray):
        pairs = np.asarray(pairs, np.int64).reshape(-1, 4)
        key = (pairs[:, 0] << 32) | pairs[:, 1]
        order = np.argsort(key, kind="stable")
        self.key = np.append(key[order], NEVER)
        self.rank = np.append(pairs[order, 2], NEVER)
        self.merged = np.append(pairs[order, 3], -1)

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (NEVER if none) and merged symbol of each pair."""
        key = (left << 32) | right
        at = np.searchsorted(self.key, key)
        np.minimum(at, len(self.key) - 1, out=at)
        hit = (self.key[at] == key) & (left >= 0) & (right >= 0)
        return np.where(hit, self.rank[at], NEVER), self.merged[at]

    def merge(self, sym: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Surviving symbols, end to end, and their number per sequence.
        ``lens`` are the sequences' lengths, 0 allowed."""
        final_len = np.zeros(len(lens), np.int64)
        seq = np.flatnonzero(lens)
        sym, lens = sym.astype(np.int64), lens[seq].astype(np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        ends = np.cumsum(lens)
        rank, new = np.full(len(sym), NEVER), np.full(len(sym), -1, np.int64)
        if len(sym) > 1:
            rank[:-1], new[:-1] = self.lookup(sym[:-1], sym[1:])
        rank[ends - 1] = NEVER
        while len(seq):
            starts = np.cumsum(lens) - lens
            best = np.minimum.reduceat(rank, starts)
            live = best < NEVER
            if not live.all():
                here = np.repeat(live, lens)
                parts.append((np.repeat(seq[~live], lens[~live]), sym[~here]))
                final_len[seq[~live]] = lens[~live]
                sym, rank, new = sym[here], rank[here], new[here]
                seq, lens, best = seq[live], lens[live], best[live]
                if not len(seq):
                    break
                starts = np.cumsum(lens) - lens
            p = self._chosen(rank, np.repeat(best, lens))
            own = np.searchsorted(starts, p, "right") - 1
            p, own = self._in_order(sym, new, p, own, starts, starts + lens, best)
            sym[p] = new[p]
            keep = np.ones(len(sym), bool)
            keep[p + 1] = False
            sym, rank, new = sym[keep], rank[keep], new[keep]
            lens = lens - np.bincount(own, minlength=len(lens))
            q = p - np.arange(len(p))
            first = np.cumsum(lens) - lens
            touched = np.concatenate([q, q[q > first[own]] - 1])
            right = np.minimum(touched + 1, len(sym) - 1)
            rank[touched], new[touched] = self.lookup(sym[touched], sym[right])
            rank[first + lens - 1] = NEVER
        if not parts:
            return np.empty(0, np.int64), final_len
        where = np.concatenate([w for w, _ in parts])
        order = np.argsort(where, kind="stable")
        return np.concatenate([s for _, s in parts])[order], final_len

    @staticmethod
    def _chosen(rank: np.ndarray, best: np.ndarray) -> np.ndarray:
        """Positions of the best pairs, every other one where they overlap."""
        p = np.flatnonzero(rank == best)
        at = np.arange(len(p))
        new_run = np.ones(len(p), bool)
        new_run[1:] = p[1:] != p[:-1] + 1
        run_start = np.maximum.accumulate(np.where(new_run, at, 0))
        return p[(at - run_start) % 2 == 0]

    def _in_order(self, sym, new, p, own, starts, ends, best):
        """The leading positions of each sequence up to the first whose merged
        symbol forms a pair of no higher rank with a neighbour."""
        made = new[p]
        left = sym[np.maximum(p - 1, 0)]
        beside = np.zeros(len(p), bool)
        beside[1:] = (p[1:] == p[:-1] + 2) & (own[1:] == own[:-1])
        left = np.where(beside, np.concatenate([made[:1], made[:-1]]), left)
        left_rank, _ = self.lookup(np.where(p > starts[own], left, -1), made)
        right = np.where(p + 2 < ends[own], sym[np.minimum(p + 2, len(sym) - 1)], -1)
        right_rank, _ = self.lookup(made, right)
        stop = np.minimum(left_rank, right_rank) <= best[own]
        before = np.cumsum(stop) - stop
        first = np.ones(len(p), bool)
        first[1:] = own[1:] != own[:-1]
        base = np.maximum.accumulate(np.where(first, before, 0))
        ok = before == base
        return p[ok], own[ok]
