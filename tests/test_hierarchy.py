import random

import pytest

from crateflow.operators.hierarchy import descendants, paths, roots


def brute(links):
    parent = {}
    for c, p in links:
        if c is not None and p is not None:
            parent[c] = min(p, parent.get(c, p))
    out = {}
    for x in {y for link in links for y in link if y is not None}:
        seen, y = [], x
        while y in parent and y not in seen:
            seen.append(y)
            y = parent[y]
        if y in seen:
            out[x] = (min(seen[seen.index(y) :]), -1)
        else:
            out[x] = (y, len(seen))
    return out


def shapes():
    rnd = random.Random(7)
    yield "forest", [(i, rnd.randrange(max(1, i))) for i in range(1, 400)]
    yield "path", [(i, i + 1) for i in range(500)]
    yield "circles", [(i, rnd.randrange(120)) for i in range(120)]
    yield "one circle", [(i, (i + 1) % 200) for i in range(200)]
    yield "star", [(i, 0) for i in range(1, 300)]
    yield "dirty", [(1, 2), (1, 2), (2, None), (None, 3), (4, 4), (5, 6), (5, 7), (None, None)]
    yield "empty", []


@pytest.mark.parametrize("name,links", list(shapes()), ids=lambda x: x if isinstance(x, str) else "")
@pytest.mark.parametrize("fragment", [40, 10_000])
def test_roots(spark, name, links, fragment):
    df = spark.createDataFrame([(c, p, "x") for c, p in links], "c int, p int, node string")
    got = {r.node: (r.root, r.depth) for r in roots(df, "c", "p", fragment).collect()}
    assert got == brute(links)


def test_paths_and_descendants(spark):
    df = spark.createDataFrame([(2, 1), (3, 2), (4, 3), (5, 2), (8, 9), (9, 8)], "c int, p int")
    p = paths(df, "c", "p", 3)
    assert {r.node: r.path for r in p.collect()} == {1: [1], 2: [1, 2], 3: [1, 2, 3], 4: [1, 2, 3, 4], 5: [1, 2, 5], 8: None, 9: None}
    assert sorted(tuple(r) for r in descendants(p).collect() if r.ancestor == 2) == [(2, 3, 1), (2, 4, 2), (2, 5, 1)]
