"""How far two places of a sequence agree, from a sorted sample of its suffixes.

Only suffixes at places whose remainder by 31 is in a difference cover are sorted: any two
places come to a pair of sampled ones after the same number of at most 30 steps. So a query
compares up to that many words, and asks a sparse table of the sampled suffixes' common prefixes for
the rest.
"""

from __future__ import annotations

import numpy as np

#: Every remainder by 31 is the difference of two of these.
COVER = [1, 5, 11, 24, 25, 27]
PERIOD = 31


def _steps() -> np.ndarray:
    """Least number of steps that brings two remainders into the cover, for each pair of them."""
    inside = np.isin(np.arange(PERIOD), COVER)
    place = (np.arange(PERIOD)[:, None] + np.arange(PERIOD)[None, :]) % PERIOD  # [remainder, steps]
    both = inside[place][:, None, :] & inside[place][None, :, :]
    return both.argmax(2)


STEPS = _steps()


def agreeing(codes: np.ndarray, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Equal codes from a and b on, each pair looked at for ``limit`` steps at most.

    The ends of texts are codes of their own that equal nothing else.
    """
    same = np.zeros(len(a), np.int64)
    left = np.flatnonzero(limit > 0)
    while len(left):
        left = left[codes[a[left] + same[left]] == codes[b[left] + same[left]]]
        same[left] += 1
        left = left[same[left] < limit[left]]
    return same


class CommonExtensions:
    """Longest common extensions of a sequence of codes, which ends with one that occurs once.

    Every text in the sequence must end with a code of its own. Memory is some forty numbers for each sampled place,
    six of 31 places.
    """

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        places = np.flatnonzero(np.isin(np.arange(n) % PERIOD, COVER))
        m = len(places)
        sample = np.full(n + 1, -1, np.int32)
        sample[places] = np.arange(m)
        padded = np.concatenate([codes, np.full(PERIOD, -1, codes.dtype)])
        levels = [self._first_ranks(padded, places)]
        step = PERIOD
        while m and levels[-1].max() < m - 1:  # twice as many words each time, until all differ
            rank = levels[-1]
            later = places + step
            after = np.where(later < n, rank[sample[np.minimum(later, n)]] + 1, 0)
            _, rank = np.unique(rank.astype(np.int64) * (m + 1) + after, return_inverse=True)
            levels.append(rank.astype(np.int32))
            step *= 2
        order = np.argsort(levels[-1], kind="stable")
        common = self._neighbours(padded, places, sample, levels, order)
        self._codes, self._sample, self._rank = codes, sample, levels[-1]
        self._least = [common]  # least of 1, 2, 4, ... neighbours' common prefixes
        while 2 << (len(self._least) - 1) <= len(common):
            half, last = 1 << (len(self._least) - 1), self._least[-1]
            self._least.append(np.minimum(last[:-half], last[half:]))

    @staticmethod
    def _first_ranks(padded: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Ranks by the first 31 codes: sorted from the last to the first, stably."""
        order = np.arange(len(places))
        for k in range(PERIOD - 1, -1, -1):
            order = order[np.argsort(padded[places[order] + k], kind="stable")]
        differs = np.zeros(len(places), bool)
        for k in range(PERIOD):
            column = padded[places[order] + k]
            differs[1:] |= column[1:] != column[:-1]
        rank = np.empty(len(places), np.int32)
        rank[order] = np.cumsum(differs)
        return rank

    @staticmethod
    def _neighbours(padded, places, sample, levels, order) -> np.ndarray:
        """Common prefixes of sorted neighbours: whole blocks by their ranks, longest first, then single codes."""
        a, b = order[:-1].copy(), order[1:].copy()
        common = np.zeros(len(a), np.int64)
        n = len(padded) - PERIOD
        for k in range(len(levels) - 1, -1, -1):
            same = np.flatnonzero(levels[k][a] == levels[k][b])
            common[same] += PERIOD << k
            for side, start in ((a, order[:-1]), (b, order[1:])):
                side[same] = sample[np.minimum(places[start[same]] + common[same], n)]
        first, second = places[order[:-1]] + common, places[order[1:]] + common
        return common + agreeing(padded, first, second, np.full(len(a), PERIOD - 1))

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal codes from each a and b on (a and b differ)."""
        steps = STEPS[a % PERIOD, b % PERIOD]
        same = agreeing(self._codes, a, b, steps)
        on = np.flatnonzero(same == steps)
        x, y = (self._rank[self._sample[p[on] + steps[on]]] for p in (a, b))
        low, high = np.minimum(x, y), np.maximum(x, y)
        power = np.frexp(high - low)[1] - 1
        for k in np.unique(power).tolist():
            at = np.flatnonzero(power == k)
            row = self._least[k]
            same[on[at]] += np.minimum(row[low[at]], row[high[at] - (1 << k)])
        return same
