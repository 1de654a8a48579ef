"""Parent chains inside one fragment, by vectorised pointer doubling."""

from __future__ import annotations

import numpy as np


def contract(node: np.ndarray, parent: np.ndarray, hops: np.ndarray, low: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Follow each node's parents while they lie in the fragment.

    ``node`` (unique) has the parent ``parent``, ``hops`` steps away; ``low`` is the least id among the nodes from it
    up to, not including, that parent. Returns per node (exit, hops, low, circle): the first ancestor outside
    the fragment with the hops to it and the least id before it; or, if the chain runs into a circle inside
    the fragment, circle is True and ``exit`` the least id on that circle.
    """
    n = len(node)
    if n == 0:
        return parent, hops, low, np.zeros(0, dtype=bool)
    order = np.argsort(node, kind="stable")
    ids = node[order]
    place = np.searchsorted(ids, parent)
    place[place == n] = 0
    local = ids[place] == parent
    # Position n is a sentinel that all outside parents share.
    jump = np.append(np.where(local, order[place], n), n)
    dist = np.append(hops, 0)
    least = np.append(low, np.iinfo(np.int64).max)
    last = np.append(np.arange(n), n)  # the last local node seen
    span = 1
    while True:
        onward = jump[jump]
        last = np.where(jump == n, last, last[jump])
        dist = dist + np.where(jump == n, 0, dist[jump])
        least = np.minimum(least, least[jump])
        jump = onward
        span *= 2
        if span > n:
            break
    circle = jump[:n] != n
    # After at least n steps a looping chain stands on its circle, whose minimum that node has gathered.
    out = np.where(circle, least[jump[:n]], parent[last[:n]])
    return out, dist[:n], least[:n], circle
