"""Guards and loads that a query can't show failing."""

import random

import pytest
from pyspark.sql import functions as F

from crateflow.operators import loads


def test_stubs(spark):
    artists = spark.createDataFrame([(1, "One", True, "p"), (2, "Two", True, None), (3, "Three", False, None)], "id int, name string, not_found boolean, profile string")
    credits = spark.createDataFrame([(1, "Uno"), (4, "Quattro"), (4, "Four"), (None, "x")], "artist_id int, artist_name string")
    got = {r.id: (r.name, r.not_found, r.profile) for r in loads.stub_artists(artists, credits).collect()}
    assert got == {1: ("One", False, "p"), 2: ("Two", True, None), 3: ("Three", False, None), 4: ("Four", False, None)}


def test_guarded_reload(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id int")
    old, new = ids(1, 2), ids(2, 3, 4)
    assert loads.guarded_reload(old, None, ids(3), "id") is old and loads.guarded_reload(old, new, ids(), "id") is old
    assert sorted(r.id for r in loads.guarded_reload(old, new, ids(3, 9), "id").collect()) == [3]
    with pytest.raises(ValueError):
        loads.truncation(["release", "entity.name"])
    assert loads.truncation(["release"]) == ["release"]


def test_copy_check_names_what_is_missing(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id int")
    assert loads.checked_copy(ids(1, 2), ids(2, 1, 1)).count() == 2
    with pytest.raises(loads.ShortfallError, match="3"):
        loads.checked_copy(ids(1, 2), ids(1, 2, 3))


def test_sample_is_that_of_the_twister(spark):
    ids = [i * 7 for i in range(1000)]
    df = spark.createDataFrame([(i,) for i in reversed(ids)] + [(7,), (None,)], "id int").repartition(5)
    want = sorted(random.Random(217).sample(sorted(ids), 40))
    assert sorted(r.id for r in loads.random_sample(df, 40, 217).collect()) == want
    assert loads.random_sample(df, 5000, 217).count() == 1000 and loads.random_sample(df.limit(0), 5, 1).count() == 0


def test_library(spark):
    rows = spark.createDataFrame([(1, "The Ida\0", "Pale (Live)", None, "x")], "library_id int, artist_name string, album_title string, label_name string, extra string")
    r = loads.normalized_library(rows, "backend", F.current_timestamp()).first()
    assert (r.artist_name, r.norm_artist, r.norm_title, r.norm_label, r.snapshot_source) == ("The Ida", "ida", "pale", None, "backend")
    with pytest.raises(ValueError):
        loads.normalized_library(rows, "elsewhere", F.current_timestamp())
    lib = spark.createDataFrame([(1, "t", "a", None, None)], "id int, title string, artist string, alternate_artist_name string, album_artist string")
    tracks = spark.createDataFrame([(1, "x")], "library_id int, artist_name string")
    assert set(loads.library_container(lib, tracks)) == {"library", "library_words", "compilation_track_artist"} and "compilation_track_artist" not in loads.library_container(lib, tracks.limit(0))
    assert loads.keep_list(None, "id", lib.select("id")).dtypes == [("id", "int")]


def test_least_row(spark):
    df = spark.createDataFrame([(1, "b", "x"), (1, None, "y"), (2, "b", "x"), (2, "a", "z"), (2, "a", "w")], "id int, artist string, v string")
    assert {r.id: (r.artist, r.v) for r in loads.least_row(df, "id", "artist").collect()} == {1: (None, "y"), 2: ("a", "w")}
