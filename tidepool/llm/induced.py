"""External induced suffix sorting of one shard, with common-prefix values.

The text of a shard is a sequence of pieces, each closed by a separator. Its suffixes are
sorted by induction (S* suffixes first, from them the L suffixes in rising order, from those
the S suffixes in falling order). Suffix tuples (position, common prefix with the neighbour)
wait in one queue per first symbol: a priority queue, as induction serves symbols in order
and tuples of a symbol in order of arrival. Whole queue runs are handled as numpy arrays.
The common prefix of two induced neighbours is one more than the least value between their
sources, so it is carried along and never compared anew.

S* suffixes are ordered by naming their S*-substrings and recursing on the names; the recursion
sorts names by doubling, restricted to names still tied, until a tie covers ``DEPTH`` symbols.

All orders and common prefixes are exact up to ``DEPTH`` symbols, which is what the search for
repeated strings of ``SPAN`` needs. Text, queues and flags move to unnamed temporary files of
the task once they exceed ``MEMORY``; these vanish with the task, which can run again elsewhere.
"""

from __future__ import annotations

import tempfile

import numpy as np

DEPTH, CAP, MEMORY = 224, 240, 64 << 20
SEPARATOR, PACK = 1, 6


class Store:
    """Arrays kept in memory up to ``memory`` bytes in all, in a temporary file beyond."""

    def __init__(self, memory: int = MEMORY):
        self.memory, self.used = memory, 0

    def array(self, n: int, dtype) -> np.ndarray:
        size = n * np.dtype(dtype).itemsize
        if self.used + size <= self.memory or n == 0:
            self.used += size
            return np.zeros(n, dtype)
        with tempfile.TemporaryFile() as file:  # stays mapped after it is closed and unlinked
            file.truncate(size)
            return np.memmap(file, dtype, "r+", shape=(n,))

    def keep(self, values: np.ndarray) -> np.ndarray:
        if self.used + values.nbytes <= self.memory:
            self.used += values.nbytes
            return values
        out = self.array(len(values), values.dtype)
        out[:] = values
        return out

    def release(self, values: np.ndarray) -> None:
        if not isinstance(values, np.memmap):
            self.used -= values.nbytes


class Queues:
    """A queue of (position, common prefix) tuples per symbol; runs spill through the store."""

    def __init__(self, store: Store, symbols: int):
        self.store, self.runs = store, [[] for _ in range(symbols)]

    def push(self, symbol: int, pos: np.ndarray, lcp: np.ndarray) -> None:
        self.runs[symbol].append((self.store.keep(pos), self.store.keep(lcp)))

    def pop(self, symbol: int) -> tuple[np.ndarray, np.ndarray] | None:
        runs, self.runs[symbol] = self.runs[symbol], []
        if not runs:
            return None
        for pair in runs:
            for values in pair:
                self.store.release(values)
        return tuple(np.concatenate(x) for x in zip(*runs, strict=True))


def refine(group: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Ranks (number of smaller elements) after splitting each group of equal rank by ``key``."""
    if len(key) and group.any():  # the key's place among the keys leaves room for the group in one integer
        order = np.argsort(key)
        place = np.empty_like(order)
        place[order] = np.cumsum(np.diff(key[order], prepend=key[order[0]]) != 0)
        order = np.argsort(group * len(key) + place)
    else:
        order = np.argsort(key)
    g, k, n = group[order], key[order], np.arange(len(order))
    new_group = np.ones(len(g), bool)
    new_group[1:] = g[1:] != g[:-1]
    new_run = new_group.copy()
    new_run[1:] |= k[1:] != k[:-1]
    rank = g + np.maximum.accumulate(np.where(new_run, n, 0)) - np.maximum.accumulate(np.where(new_group, n, 0))
    out = np.empty_like(group)
    out[order] = rank
    return out


class Induced:
    def __init__(self, text: np.ndarray, store: Store | None = None):
        """``text``: uint16 symbols, 0 only at its end, ``SEPARATOR`` between pieces."""
        self.text, self.store = text, store or Store()
        n = len(text)
        self.symbols = int(text.max()) + 1
        # type S if the next different symbol is larger; run: equal symbols from here on
        change = np.flatnonzero(text[1:] != text[:-1])
        self.is_s, self.run = self.store.array(n, bool), self.store.array(n, np.uint8)
        ends = np.append(change, n - 1)
        lengths = np.diff(np.concatenate([[-1], ends]))
        self.is_s[:] = np.repeat(np.append(text[change] < text[change + 1], True), lengths)
        self.run[:] = np.minimum(np.repeat(ends, lengths) - np.arange(n) + 1, CAP)

    def s_star(self) -> tuple[np.ndarray, np.ndarray]:
        """S* positions in suffix order and each one's common prefix with the one before."""
        text, is_s = self.text, self.is_s
        at = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
        m = len(at)
        size = np.append(np.diff(at) + 1, 1)

        def packed(which: np.ndarray, chunk: int) -> np.ndarray:
            key = np.zeros(len(which), np.int64)
            for o in range(chunk * PACK, (chunk + 1) * PACK):
                inside = o < size[which]
                i = np.minimum(at[which] + o, len(text) - 1)
                key = key << 10 | np.where(inside, text[i].astype(np.int64) * 2 + is_s[i], 0)
            return key

        rank = refine(np.zeros(m, np.int64), packed(np.arange(m), 0))
        long, chunk = np.flatnonzero(size > PACK), 1
        while len(long):
            long = long[np.bincount(rank[long], minlength=m)[rank[long]] > 1]
            if len(long):
                rank[long] = refine(rank[long], packed(long, chunk))
            long, chunk = long[size[long] > PACK * (chunk + 1)], chunk + 1
        h = 1
        while True:
            tied = np.flatnonzero(np.bincount(rank, minlength=m)[rank] > 1)
            tied = tied[at[np.minimum(tied + h, m - 1)] - at[tied] < DEPTH]
            if not len(tied):
                break
            rank[tied] = refine(rank[tied], rank[np.minimum(tied + h, m - 1)])
            h *= 2
        order = np.argsort(rank, kind="stable")
        same = np.zeros(m, bool)
        same[1:] = rank[order][1:] == rank[order][:-1]
        lcp = np.where(same, CAP, 0).astype(np.int16)
        todo = np.flatnonzero(~same[1:]) + 1
        p, q, length = at[order[todo - 1]], at[order[todo]], 0
        eight = np.lib.stride_tricks.sliding_window_view(np.append(text, np.zeros(16, text.dtype)), 8)
        while len(todo) and length < CAP:  # common prefixes of the S* order, eight symbols at a time
            differ = eight[p] != eight[q]
            same8 = np.flatnonzero(differ.view(np.uint64)[:, 0] == 0)
            lcp[todo] = length + differ.argmax(axis=1)
            todo, p, q, length = todo[same8], p[same8] + 8, q[same8] + 8, length + 8
            lcp[todo] = length
        return at[order], np.minimum(lcp, CAP)

    def _scan(self, pos: np.ndarray, lcp: np.ndarray, to_s: bool, queues: Queues, least: np.ndarray) -> None:
        """Induce from sources in order: push the preceding suffixes of the wanted type. ``least``
        holds, per symbol, the least common prefix since its last source (-1: none yet)."""
        before = np.maximum(pos - 1, 0)
        take = np.flatnonzero((self.is_s[before] == to_s) & (pos > 0))
        whole = lcp.min()
        if len(take):
            symbol = self.text[before[take]]
            order = np.argsort(symbol, kind="stable")
            take, symbol = take[order], symbol[order]
            head = np.ones(len(take), bool)
            head[1:] = symbol[1:] != symbol[:-1]
            bounds = np.append(lcp, np.int16(CAP))
            between = np.minimum.reduceat(bounds, take + 1)
            got = np.empty(len(take), np.int16)
            got[1:] = between[:-1]
            first = np.flatnonzero(head)
            got[first] = np.minimum(least[symbol[first]], np.minimum.accumulate(lcp)[take[first]])
            got = np.minimum(got + 1, CAP).astype(np.int16)
            np.minimum(least, whole, out=least)
            last = np.append(first[1:], len(take)) - 1
            least[symbol[last]] = np.minimum.accumulate(bounds[::-1])[::-1][take[last] + 1]
            new = before[take]
            for a, b in zip(first.tolist(), (last + 1).tolist(), strict=True):
                queues.push(int(symbol[a]), new[a:b], got[a:b])
        else:
            np.minimum(least, whole, out=least)

    def buckets(self):
        """Yield (positions, common prefixes with the one before) of each first symbol's suffixes,
        symbols falling, suffixes rising within a symbol."""
        star, star_lcp = self.s_star()
        cut = np.searchsorted(self.text[star], np.arange(self.symbols + 1))
        present = np.flatnonzero(np.bincount(self.text, minlength=self.symbols)).tolist()
        waiting, done = Queues(self.store, self.symbols), Queues(self.store, self.symbols)
        least = np.full(self.symbols, -1, np.int16)
        last_l = {}
        for c in present:
            while (got := waiting.pop(c)) is not None:
                done.push(c, *got)
                last_l[c] = int(got[0][-1])
                self._scan(*got, False, waiting, least)
            if cut[c + 1] > cut[c]:
                pos, lcp = star[cut[c]:cut[c + 1]], star_lcp[cut[c]:cut[c + 1]].copy()
                lcp[0] = min(self.run[last_l[c]], self.run[pos[0]]) if c in last_l else 0
                self._scan(pos, lcp, False, waiting, least)
        del star, star_lcp
        least[:] = -1
        none = (np.empty(0, np.int64), np.empty(0, np.int16))
        for c in reversed(present):
            larger = []
            while (got := waiting.pop(c)) is not None:
                larger.append(got)
                self._scan(*got, True, waiting, least)
            s_pos, s_lcp = (np.concatenate(x) for x in zip(*larger, strict=True)) if larger else none
            l_pos, l_lcp = done.pop(c) or none
            edge = min(self.run[l_pos[-1]], self.run[s_pos[-1]]) if len(l_pos) and len(s_pos) else 0
            if len(l_pos):
                self._scan(l_pos[::-1], np.append(np.int16(edge), l_lcp[1:][::-1]).astype(np.int16), True, waiting, least)
            s_up = np.append(np.int16(edge), s_lcp[1:][::-1]) if len(s_pos) else s_lcp
            yield np.append(l_pos, s_pos[::-1]), np.append(l_lcp, s_up)


def repeated(pieces: list[bytes], windows: list[int], weights: list[int], span: int,
             store: Store | None = None) -> list[list[tuple[int, int]]]:
    """For each piece the ranges [lo, hi) of window starts whose ``span`` bytes occur at least twice,
    where a piece stands for ``weights`` occurrences and only its first ``windows`` starts count."""
    store = store or Store()
    sizes = np.array([len(p) for p in pieces])
    starts = np.cumsum(sizes + 1) - sizes - 1
    n = int(sizes.sum()) + len(pieces) + 1
    text = store.array(n, np.uint16)
    for p, a in zip(pieces, starts.tolist(), strict=True):
        text[a:a + len(p)] = np.frombuffer(p, np.uint8)
        text[a:a + len(p)] += 2
    text[starts + sizes] = SEPARATOR
    text[-1] = 0
    count, flags = store.array(n, np.int32), store.array(n + 1, bool)
    for a, w, times in zip(starts.tolist(), windows, weights, strict=True):
        count[a:a + w] = min(times, 2)
    for pos, lcp in Induced(text, store).buckets():
        if len(pos):
            group = np.cumsum(lcp < span)
            times = count[pos]
            total = np.bincount(group, times)
            flags[pos[(total[group] >= 2) & (times > 0)]] = True
    edge = np.diff(np.concatenate([[0], flags.view(np.int8) if flags.dtype == bool else flags]).astype(np.int8))
    lo, hi = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    owner = np.searchsorted(starts, lo, "right") - 1
    out: list[list[tuple[int, int]]] = [[] for _ in pieces]
    for i, a, b in zip(owner.tolist(), (lo - starts[owner]).tolist(), (hi - starts[owner]).tolist(), strict=True):
        out[i].append((a, b))
    return out
