"""Content-chosen anchors: every window of a text picks one of its grams, so equal windows pick equal grams."""

from __future__ import annotations

import numpy as np

from .textops import prefix_hash, spans_hash

GRAM = 32


def anchors(data: np.ndarray, off: np.ndarray, window: int, gram: int = GRAM, prefix: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(row, anchor, low, high, gram hash): the starts low..high of windows of a row whose leftmost least gram is at anchor.

    Positions count bytes of ``data``, or what ``prefix`` hashes, one for each item of ``data``. The intervals of a row cover each start of a window once.
    """
    n = len(data)
    none = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    if n < window:
        return none
    count, wide = n - gram + 1, window - gram + 1
    prefix = prefix_hash(data) if prefix is None else prefix
    h = spans_hash(prefix, gram)
    place = np.uint64(max(1, int(count).bit_length()))
    below = (np.uint64(1) << place) - np.uint64(1)
    least = (h & ~below) | np.arange(count, dtype=np.uint64)
    reach = 1
    while reach < wide:  # the least of ``reach`` neighbours, from twice the least of fewer
        step = min(reach, wide - reach)
        least = np.minimum(least[:-step], least[step:])
        reach += step
    first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1, off[:-1], off[1:] - window + 1])
    first = np.sort(first[(first >= 0) & (first < len(least))])
    first = first[np.diff(first, prepend=-1) > 0]
    last = np.append(first[1:], len(least)) - 1
    row = np.searchsorted(off, first, side="right") - 1
    ok = first + window <= off[row + 1]
    row, first, last = row[ok], first[ok], last[ok]
    anchor = (least[first] & below).astype(np.int64)
    return row, anchor, first, last, h[anchor]
