"""Words of texts as numbers, in bulk: what both classifiers read."""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Hashable
from itertools import chain

import numpy as np

#: A word, or a run of marks; white space parts them.
TOKEN = re.compile(r"\w+|[^\w\s]+")
#: Words a worker keeps with what was computed for them.
KEPT = 200_000

_held: list[tuple[Hashable, object]] = []


def held(owner: Hashable, make: Callable[[], object]) -> object:
    """What this worker keeps for ``owner``, made when it is new. It keeps one such thing: that of the operator before goes."""
    if not _held or _held[0][0] != owner:
        _held.clear()
        _held.append((owner, make()))
    return _held[0][1]


class Memo(dict):
    """Values of a function of a word (or other key), for a bounded number of them."""

    def __init__(self, compute: Callable, most: int = KEPT) -> None:
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, word):
        if len(self) >= self.most:
            self.clear()
        value = self[word] = self.compute(word)
        return value


def hashed(word: str, seed: int = 0) -> int:
    """32 bits, the same in every process."""
    return zlib.crc32(word.encode("utf-8", "surrogatepass"), seed)


def numbered(token_lists: list[list[str]], memo: Memo) -> tuple[np.ndarray, np.ndarray]:
    """The memo's values for all tokens on end, and the bounds of each list."""
    bounds = np.cumsum([0, *map(len, token_lists)])
    values = np.fromiter(map(memo.__getitem__, chain.from_iterable(token_lists)), np.int64, bounds[-1])
    return values, bounds


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of each range, in double precision; empty ranges give 0."""
    out = np.zeros(len(bounds) - 1)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = np.add.reduceat(values.astype(np.float64), bounds[:-1][full])
    return out
