"""FM-index over sequences of symbols: wavelet-matrix ranks, backward search, matching statistics.

All queries of a batch advance together, one symbol a step, so the work is
NumPy over arrays of queries.
"""

from __future__ import annotations

import numpy as np


class WaveletMatrix:
    """Bit-packed wavelet matrix; ``step`` maps (symbol, position) through all levels."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.levels = []
        for b in range(bits - 1, -1, -1):
            bit = (symbols >> b) & 1
            padded = np.zeros(-(-(len(bit) + 1) // 64) * 64, np.uint8)
            padded[: len(bit)] = bit
            words = np.packbits(padded, bitorder="little").view("<u8")
            before = np.r_[0, np.cumsum(np.bitwise_count(words), dtype=np.int64)][:-1].astype(np.uint32)
            zeros = int(len(bit) - bit.sum())
            self.levels.append((b, words, before, zeros))
            symbols = np.r_[symbols[bit == 0], symbols[bit == 1]]

    def step(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.walk(symbol, at)[0]

    def walk(self, symbol: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The mapped positions, and whether the symbol itself stands at each position."""
        other, one = np.zeros(len(at), np.uint64), np.uint64(1)
        symbol = symbol.astype(np.uint64)
        for b, words, before, zeros in self.levels:
            w = at >> 6
            word, inside = words.take(w, mode="clip"), (at & 63).astype(np.uint64)
            ones = before.take(w) + np.bitwise_count(word & ((one << inside) - one))
            bit = (symbol >> np.uint64(b)) & one
            other |= (word >> inside) ^ bit
            at = np.where(bit, zeros + ones, at - ones)
        return at, (other & one) == 0

    @property
    def nbytes(self) -> int:
        return sum(words.nbytes + before.nbytes for _, words, before, _ in self.levels)


class FMIndex:
    """Compressed index of several sequences of 64-bit symbols.

    Every sequence ends in a separator of its own, so suffixes are totally
    ordered and no match crosses sequences. Kept are the transformed text as a
    wavelet matrix, the neighbours' common prefixes in the narrowest type with a
    tree of their minima, and the alphabet. Sorting needs the suffix array and
    ranks of doubled lengths; they are let go, since matches are only ever
    counted and measured, not located.
    """

    def __init__(self, sequences: list[np.ndarray]):
        lengths = np.array([len(s) for s in sequences], np.int64)
        ends = np.cumsum(lengths + 1)
        n, k = int(ends[-1]) if len(sequences) else 0, len(sequences)
        text = np.concatenate([x for s in sequences for x in (s, np.zeros(1, np.uint64))]) if k else np.zeros(0, np.uint64)
        sep = np.zeros(n, bool)
        sep[ends - 1] = True
        self.n = n
        self.alphabet, code = np.unique(text[~sep], return_inverse=True)
        rank = np.empty(n, np.int64)
        rank[sep] = np.arange(k)
        rank[~sep] = code + k
        longest = int(lengths.max()) + 1 if k else 1
        suffixes, ranks = _sorted_suffixes(rank, n + k + 1 + len(self.alphabet), longest)
        symbols = np.zeros(n, np.int64)
        symbols[~sep] = code + 1
        bits = max(1, int(len(self.alphabet)).bit_length())
        self.wavelet = WaveletMatrix(symbols[suffixes - 1], bits)  # before the first symbol stands the last separator
        every = np.arange(len(self.alphabet) + 1)
        counts = np.bincount(symbols, minlength=len(every))
        self.shift = np.cumsum(counts) - counts - self.wavelet.step(every, np.zeros(len(every), np.int64))
        low = np.zeros(1 << max(1, n.bit_length()), np.min_scalar_type(longest))
        low[1:n] = _common(ranks, suffixes[:-1], suffixes[1:])
        self.minima = [low]  # at i: the common prefix of suffixes i-1 and i; above it the minima of pairs
        while len(self.minima[-1]) > 1:
            self.minima.append(np.minimum(self.minima[-1][::2], self.minima[-1][1::2]))

    @property
    def nbytes(self) -> int:
        return self.wavelet.nbytes + sum(t.nbytes for t in self.minima) + self.alphabet.nbytes + self.shift.nbytes

    def _nearest(self, at: np.ndarray, length: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The nearest place from ``at`` on, to the left (0) or right (1), whose common prefix is below ``length`` (at least 1)."""
        i = at.copy()
        found = np.where(self.minima[0][i] < length, 0, -1)
        for level, t in enumerate(self.minima):
            left = np.flatnonzero(found < 0)
            if not len(left):
                break
            node = i[left]
            beside = node ^ 1
            got = ((node & 1) != right[left]) & (t[beside] < length[left])
            i[left] = np.where(got, beside, node >> 1)
            found[left[got]] = level
        for level in range(int(found.max(initial=0)) - 1, -1, -1):
            down = np.flatnonzero(found > level)
            child = 2 * i[down] + 1 - right[down]
            i[down] = np.where(self.minima[level][child] < length[down], child, child ^ 1)
        return i

    def matching_statistics(self, queries: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
        """Per query and position: the longest match that starts there, and its interval [from, to) of sorted suffixes.

        Backward search from the right end; where a symbol can't be added, the
        match is shortened from its right end to the next wider interval.
        """
        size = np.array([len(q) for q in queries], np.int64)
        if not len(queries):
            return [], [], []
        flat = np.concatenate(queries) if size.sum() else np.zeros(0, np.uint64)
        first = np.cumsum(size) - size
        code = np.searchsorted(self.alphabet, flat)
        known = code < len(self.alphabet)
        if len(self.alphabet):
            known &= self.alphabet[np.minimum(code, len(self.alphabet) - 1)] == flat
        code = np.where(known, code + 1, 0)
        length, begin, end = (np.zeros(len(flat), np.int64) for _ in range(3))
        lo, hi = np.zeros(len(size), np.int64), np.full(len(size), self.n, np.int64)
        matched, at = np.zeros(len(size), np.int64), first + size - 1
        lcp, q = self.minima[0], np.flatnonzero(size)
        while len(q):  # each query takes a symbol or gives up a part of its match, at its own place
            c = code[at[q]]
            known = c > 0
            lost, i, c = q[~known], q[known], c[known]
            lo[lost], hi[lost], matched[lost] = 0, self.n, 0
            low, high = lo[i], hi[i]
            wide = np.flatnonzero(high - low > 1)
            to, here = self.wavelet.walk(np.concatenate([c, c[wide]]), np.concatenate([low, high[wide]]))
            low = to[: len(i)] + self.shift[c]
            high = low + here[: len(i)]  # an interval of one holds the symbol or doesn't
            high[wide] = to[len(i) :] + self.shift[c[wide]]
            ok = high > low
            j, short = i[ok], i[~ok]
            lo[j], hi[j] = low[ok], high[ok]
            matched[j] += 1
            if len(short):  # the symbol is in the index, so the empty match can always take it
                matched[short] = np.maximum(lcp[lo[short]], lcp[hi[short]])
                none, some = short[matched[short] == 0], short[matched[short] > 0]
                lo[none], hi[none] = 0, self.n
                edges = self._nearest(np.concatenate([lo[some], hi[some]]), np.tile(matched[some], 2), np.repeat([0, 1], len(some)))
                lo[some], hi[some] = edges[: len(some)], edges[len(some) :]
            done = np.concatenate([lost, j])
            place = at[done]
            length[place], begin[place], end[place] = matched[done], lo[done], hi[done]
            at[done] -= 1
            q = q[at[q] >= first[q]]
        cuts = first[1:]
        return np.split(length, cuts), np.split(begin, cuts), np.split(end, cuts)


def _sorted_suffixes(rank: np.ndarray, base: int, longest: int):
    """Suffixes in order, and (length, rank of the prefix of that length) for doubled lengths up to the longest."""
    n, h, ranks = len(rank), 1, [(1, rank)]
    while True:
        ahead = np.zeros(n, np.int64)
        ahead[: n - h] = rank[h:] + 1
        key = rank * base + ahead
        order = np.argsort(key)
        s = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, s[1:] != s[:-1]]) if n else order
        h *= 2
        if h >= longest or (n and rank.max() == n - 1):
            return order, ranks
        ranks.append((h, rank))


def _common(ranks, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common prefix of suffixes a and b (text positions)."""
    n, out = len(ranks[0][1]), np.zeros(len(a), np.int64)
    for h, rank in reversed(ranks):
        inside = (a < n) & (b < n)
        same = np.zeros(len(a), bool)
        same[inside] = rank[a[inside]] == rank[b[inside]]
        out += h * same
        a, b = a + h * same, b + h * same
    return out
