"""An FM-index over word ids in numpy: suffix array, wavelet matrix, backward search, locate."""

import numpy as np

SAMPLE = 16


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Positions in the order of their suffixes, by prefix doubling.

    A rank is the place of the first suffix of its group, so that ranks only change
    inside groups that are still tied, and only those are sorted again.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    rank = np.empty(n, np.int64)

    def regroup(places, keys):
        """New ranks for sorted suffixes at `places`; returns which are still tied."""
        first = np.ones(len(keys), bool)
        first[1:] = keys[1:] != keys[:-1]
        heads = np.flatnonzero(first)
        group = np.cumsum(first) - 1
        rank[order[places]] = places[heads][group]
        return np.diff(np.append(heads, len(keys)))[group] > 1

    places = np.arange(n)
    places = places[regroup(places, symbols[order])]
    width = 1
    while len(places):
        tied = order[places]
        after = np.where(tied + width < n, rank[np.minimum(tied + width, n - 1)] + 1, 0)
        keys = rank[tied] * (n + 1) + after
        by = np.argsort(keys, kind="stable")
        order[places] = tied[by]
        places = places[regroup(places, keys[by])]
        width *= 2
    return order


class Wavelet:
    """Rank and access over small integers: one bit vector per binary digit."""

    def __init__(self, values: np.ndarray, digits: int):
        self.levels = []
        for digit in range(digits - 1, -1, -1):
            ones = (values >> digit) & 1
            zeros = np.zeros(len(values) + 1, np.int32)
            np.cumsum(1 - ones, out=zeros[1:])
            self.levels.append((digit, zeros))
            values = np.concatenate([values[ones == 0], values[ones == 1]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        first = np.zeros_like(at)
        for digit, zeros in self.levels:
            one = ((symbols >> digit) & 1).astype(bool)
            total = zeros[-1]
            at = np.where(one, total + at - zeros[at], zeros[at])
            first = np.where(one, total + first - zeros[first], zeros[first])
        return at - first

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at the places."""
        out = np.zeros_like(at)
        for digit, zeros in self.levels:
            one = zeros[at + 1] == zeros[at]
            out |= one.astype(out.dtype) << digit
            at = np.where(one, zeros[-1] + at - zeros[at], zeros[at])
        return out


class FMIndex:
    """Index of runs of word ids (1, 2, ...); each run ends in a separator, 0.

    Separators are told apart while sorting, so no suffix is compared beyond its run.
    """

    def __init__(self, text: np.ndarray, alphabet: int):
        separators = np.flatnonzero(text == 0)
        told = text + len(separators)
        told[separators] = np.arange(len(separators))
        order = suffix_array(told)
        before = text[order - 1]
        self.digits = max(1, int(alphabet).bit_length())
        self.wavelet = Wavelet(before, self.digits)
        self.first = np.zeros(alphabet + 2, np.int64)
        np.cumsum(np.bincount(text, minlength=alphabet + 1), out=self.first[1:])
        # Every SAMPLE-th position is kept, and the first of each run, so that no walk
        # leaves its run.
        kept = (order % SAMPLE == 0) | (before == 0)
        self.kept_before = np.zeros(len(text) + 1, np.int64)
        np.cumsum(kept, out=self.kept_before[1:])
        self.positions = order[kept]
        self.size = len(text)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of phrases of one length, one per line, from the last word back."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        alive = np.arange(len(phrases))
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column]
            start = self.first[symbol]
            low[alive] = start + self.wavelet.rank(symbol, low[alive])
            high[alive] = start + self.wavelet.rank(symbol, high[alive])
            alive = alive[high[alive] > low[alive]]
            if not len(alive):
                break
        return low, np.maximum(high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walk back to a kept position and add the steps."""
        out = np.empty(len(rows), np.int64)
        waiting, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(waiting):
            done = self.kept_before[at + 1] > self.kept_before[at]
            out[waiting[done]] = self.positions[self.kept_before[at[done]]] + steps
            waiting, at = waiting[~done], at[~done]
            symbol = self.wavelet.access(at)
            at = self.first[symbol] + self.wavelet.rank(symbol, at)
            steps += 1
        return out
