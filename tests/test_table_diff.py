import random

from crateflow.operators.table_diff import table_diff


def frame(spark, rows):
    return spark.createDataFrame(rows, "id int, title string, artist string, left_value string")


def diff(spark, a, b, **kw):
    out = table_diff(frame(spark, a), frame(spark, b), "id", ["title", "artist"], **kw)
    return sorted((r.id, r["diff"]) for r in out.collect())


def test_kinds_and_nulls(spark):
    a = [(1, "x", "y", ""), (2, None, "y", ""), (3, "x", None, ""), (4, "", "y", ""), (None, "z", "z", "")]
    b = [(1, "x", "y ", ""), (2, None, "y", ""), (5, "x", "y", ""), (4, None, "y", ""), (None, "q", "q", "")]
    assert diff(spark, a, b) == [(1, "artist"), (3, "only_left"), (4, "title"), (5, "only_right")]


def test_repeated_keys_compare_as_multisets(spark):
    a = [(1, "x", "y", ""), (1, "w", "y", ""), (2, "x", "y", ""), (2, "x", "y", "")]
    b = [(1, "w", "y", ""), (1, "x", "v", ""), (2, "x", "y", "")]
    assert diff(spark, a, b) == [(1, "artist"), (2, "artist"), (2, "title")]


def test_empty_sides(spark):
    assert diff(spark, [], []) == []
    assert diff(spark, [(1, "x", "y", "")], []) == [(1, "only_left")]


def test_random_against_brute_force(spark):
    rnd = random.Random(3)
    make = lambda: [(i, rnd.choice(["a", "b", None, "x" * 5000]), rnd.choice(["c", None]), "") for i in range(300) if rnd.random() < 0.9]
    a, b = make(), make()
    x, y = {r[0]: r for r in a}, {r[0]: r for r in b}
    want = [(i, "only_left") for i in x if i not in y] + [(i, "only_right") for i in y if i not in x]
    want += [(i, f) for i in x if i in y for k, f in ((1, "title"), (2, "artist")) if x[i][k] != y[i][k]]
    assert diff(spark, a, b, bucket_rows=20) == sorted(want)
