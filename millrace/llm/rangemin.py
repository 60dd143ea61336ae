"""Range minima by a sparse table, and how far a bound holds to either side of a place."""

from __future__ import annotations

import numpy as np


class RangeMin:
    """Level k holds the minimum of every 2**k consecutive values."""

    def __init__(self, values: np.ndarray):
        self.levels = [np.asarray(values)]
        step = 1
        while 2 * step <= len(values):
            below = self.levels[-1]
            self.levels.append(np.minimum(below[:-step], below[step:]))
            step *= 2

    def least(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Minimum of values[first..last], both ends included; first <= last."""
        out = np.empty(len(first), self.levels[0].dtype)
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        for k in np.unique(level):
            at = level == k
            table = self.levels[k]
            out[at] = np.minimum(table[first[at]], table[last[at] + 1 - (1 << int(k))])
        return out

    def right(self, place: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The last r with values[place + 1 .. r] all >= bound, by binary search; `place` itself if there is none."""
        at = place.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            table = self.levels[k]
            fits = at + 1 < len(table)
            fits &= table[np.where(fits, at + 1, 0)] >= bound
            at[fits] += 1 << k
        return at

    def left(self, place: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first l with values[l + 1 .. place] all >= bound, by binary search; `place` itself if there is none."""
        at = place.copy()
        for k in range(len(self.levels) - 1, -1, -1):
            begin = at + 1 - (1 << k)
            fits = begin >= 1
            fits &= self.levels[k][np.where(fits, begin, 0)] >= bound
            at[fits] -= 1 << k
        return at
