"""Exchange clustering of words by the likelihood of a class bigram model.

A word moves to the class that raises the likelihood most, given how often each class comes before and
after it. With x log x = f(x) the likelihood is the sum of f over class pairs, less the sums of f over
classes as first and as second of a pair, so a move changes one row and one column of the table of
pairs.
"""

from __future__ import annotations

import numpy as np

#: Fixed places: texts' ends are class 0; words outside the core count as one more class, the last.
END = 0
_AT_ONCE = 1 << 14
_FEW = 4  # up to so many times beside a class, gains are looked up


def f(x: np.ndarray) -> np.ndarray:
    """x log x, 0 at 0."""
    return x * np.log(np.maximum(x, 1))


def likelihood(pairs: np.ndarray) -> float:
    return float(f(pairs).sum() - f(pairs.sum(0)).sum() - f(pairs.sum(1)).sum())


def first_classes(words: int, classes: int) -> np.ndarray:
    """Of the core words, most frequent first, each class gets one in turn; 0 and the last number are set apart."""
    own = 1 + np.arange(words) % (classes - 1)
    return np.concatenate([[END], own, [classes]]).astype(np.int64)


class Exchange:
    """Counts of class pairs, among ``classes`` classes and the words outside the core, while words move."""

    def __init__(self, pairs: np.ndarray):
        self.pairs = pairs.astype(np.float64)
        self.first, self.second = self.pairs.sum(1), self.pairs.sum(0)
        self.classes = len(pairs) - 1

    def move(self, own: int, before: np.ndarray, after: np.ndarray, itself: float) -> int:
        """Take a word out of its class and put it where the likelihood is greatest.

        ``before`` and ``after`` count the classes around the word but for the word itself, which follows itself
        ``itself`` times.
        """
        pairs, n_second, n_first = self.pairs, before.sum() + itself, after.sum() + itself
        self._shift(own, before, after, itself, -1)
        left, right = np.flatnonzero(before), np.flatnonzero(after)
        gain = (f(pairs[left] + before[left, None]) - f(pairs[left])).sum(0)
        gain += (f(pairs[:, right] + after[None, right]) - f(pairs[:, right])).sum(1)
        diagonal = np.diagonal(pairs)
        gain += (f(diagonal + before + after + itself) + f(diagonal)
                 - f(diagonal + before) - f(diagonal + after))
        gain -= f(self.first + n_first) - f(self.first) + f(self.second + n_second) - f(self.second)
        best = END + 1 + int(np.argmax(gain[END + 1:self.classes]))
        best = best if gain[best] > gain[own] + 1e-9 else own
        self._shift(best, before, after, itself, 1)
        return best

    def _shift(self, own: int, before: np.ndarray, after: np.ndarray, itself: float, sign: int) -> None:
        self.pairs[:, own] += sign * before
        self.pairs[own] += sign * after
        self.pairs[own, own] += sign * itself
        self.first[own] += sign * (after.sum() + itself)
        self.second[own] += sign * (before.sum() + itself)

    def moves(self, own: np.ndarray, before: tuple, after: tuple, itself: np.ndarray) -> np.ndarray:
        """As ``move`` for some words at once, all by the same counts, which move with the words in the end.

        ``own`` are their classes; those of the last class go to another one in any case. ``before`` and ``after`` are
        (word, class, n): word number i stands n times beside a class; in ``itself``, how often each follows itself.
        """
        words, k, pairs = len(itself), self.classes + 1, self.pairs
        before, after = (np.bincount(w * k + c, n, words * k).reshape(words, k) for w, c, n in (before, after))
        gain = np.zeros((words, k))
        for mine, across, table in ((before, after, pairs), (after, before, pairs.T)):
            of, at = np.nonzero(mine)
            plain = f(table)
            few = np.stack([f(table + n) - plain for n in range(1, _FEW + 1)])
            for lo in range(0, len(of), _AT_ONCE):
                part = slice(lo, lo + _AT_ONCE)
                o, t = of[part], at[part]
                n = mine[o, t]
                more = (n > _FEW) | (t == own[o])
                value = np.empty((len(o), k))
                less = np.flatnonzero(~more)
                value[less] = few[n[less].astype(np.int64) - 1, t[less]]
                x, there = own[o[less]], table[t[less], own[o[less]]]
                value[less, x] = f(there) - f(there - n[less])
                more = np.flatnonzero(more)
                o2, t2, n2 = o[more], t[more], n[more]
                row = table[t2]
                x = own[o2]
                row[np.arange(len(x)), x] -= n2
                same = np.flatnonzero(t2 == x)
                row[same] -= across[o2[same]]
                row[same, x[same]] -= itself[o2[same]]
                value[more] = f(row + n2[:, None]) - f(row)
                first = np.flatnonzero(np.diff(o, prepend=-1))
                gain[o[first]] += np.add.reduceat(value, first)
        # A class that stands on both sides has one cell for both.
        o, c = np.nonzero(((before > 0) & (after > 0)) | (itself > 0)[:, None])
        b, a, i = before[o, c], after[o, c], itself[o]
        there = pairs[c, c] - np.where(c == own[o], b + a + i, 0)
        gain[o, c] += f(there + b + a + i) + f(there) - f(there + b) - f(there + a)
        at = np.arange(words)
        for sums, n in ((self.first, after.sum(1) + itself), (self.second, before.sum(1) + itself)):
            kinds, kind = np.unique(n, return_inverse=True)
            loss = (f(sums + kinds[:, None]) - f(sums))[kind]
            loss[at, own] = f(sums[own]) - f(sums[own] - n)
            gain -= loss
        best = END + 1 + gain[:, END + 1:self.classes].argmax(1)
        best = np.where((gain[at, best] > gain[at, own] + 1e-9) | (own == self.classes), best, own)
        self._shift_all(own, before, after, itself, -1)
        self._shift_all(best, before, after, itself, 1)
        return best

    def _shift_all(self, of: np.ndarray, before: np.ndarray, after: np.ndarray, itself: np.ndarray, sign: int) -> None:
        one = np.zeros((len(of), self.classes + 1))
        one[np.arange(len(of)), of] = sign
        self.pairs += before.T @ one + one.T @ after + np.diag(one.T @ itself)
        self.first += one.T @ (after.sum(1) + itself)
        self.second += one.T @ (before.sum(1) + itself)
