"""Word alignment of a quotation: chains of equal words in order, with few single words between."""

from __future__ import annotations

import numpy as np

#: Words that may stand between two matched words of a passage, on either side, and what each costs.
GAP, COST = 3, 0.6


_STEPS = sorted((COST * (max(a, b) - 1), a, b) for a in range(1, GAP + 2) for b in range(1, GAP + 2))


def best_passage(rows: np.ndarray, columns: np.ndarray) -> tuple[int, tuple[int, int], tuple[int, int]]:
    """The best local chain among the matches (document word, item word), which come in document order.

    A match earns 1; each word skipped between two matches, on the side where more are skipped, costs ``COST``; at most ``GAP``
    words may be skipped in one place. Returns (matched words, [first, last] document word, [first, last] item word). Each
    match looks at the few cells before it, so the time is proportional to the number of matches.
    """
    cells: dict[int, tuple[float, int, int]] = {}
    width = 1 << 32
    top, top_at = (0.0, 0, 0), 0
    steps = [(cost, a * width + b) for cost, a, b in _STEPS]
    get = cells.get
    for at in (rows * width + columns).tolist():
        best, number, start = 0.0, 0, at
        for cost, back in steps:
            before = get(at - back)
            if before is not None and before[0] - cost > best:
                best, number, start = before[0] - cost, before[1], before[2]
        cells[at] = cell = (best + 1, number + 1, start)
        if cell[0] > top[0]:
            top, top_at = cell, at
    if not top[1]:
        return 0, (0, -1), (0, -1)
    (j0, i0), (j1, i1) = divmod(top[2], width), divmod(top_at, width)
    return top[1], (j0, j1), (i0, i1)


def matches(document: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All (document word, item word) that are equal, in document order."""
    order = np.argsort(item, kind="stable")
    known = item[order]
    lo, hi = np.searchsorted(known, document, "left"), np.searchsorted(known, document, "right")
    n = hi - lo
    rows = np.repeat(np.arange(len(document)), n)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(n) - n, n)
    return rows, order[np.repeat(lo, n) + within]


def quoted_words(document: np.ndarray, item: np.ndarray, least_half: int = 6, enough: int = 15, at: np.ndarray | None = None) -> tuple[int, int]:
    """Matched words of the best passage, and of the best second one that overlaps it neither in the document nor in the item
    and stands on the same side of it in both. The second is 0 if it has fewer than ``least_half`` words, or isn't needed as the
    first has ``enough``. ``at``: where the words given of the document stand in it."""
    rows, columns = matches(document, item)
    if at is not None:
        rows = at[rows]
    one, (j0, j1), (i0, i1) = best_passage(rows, columns)
    if one == 0 or one >= enough:
        return one, 0
    second = 0
    for part in ((rows < j0) & (columns < i0), (rows > j1) & (columns > i1)):
        if part.any():
            second = max(second, best_passage(rows[part], columns[part])[0])
    return one, second if second >= least_half else 0
