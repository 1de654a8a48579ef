import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crateflow.functions import formats, normalize, stats
from crateflow.functions.fold import strip_accents
from crateflow.functions.mojibake import explains
from crateflow.functions.similarity import common_length, indel_ratio, jaro_winkler, token_set, token_sort
from crateflow.functions.trigram import similarity


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "v string").select(f(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize("f,value,want", [
    (normalize.match_title, 'Blue Train 12" (Reissue)', "blue train"), (normalize.match_title, "Kind (2 cd set)(3)", "kind"), (normalize.match_title, None, None), (normalize.match_title, "", ""),
    (normalize.match_artist, "Beatles, The", "the beatles"), (normalize.match_artist, "Simon & Garfunkel (2)", "simon and garfunkel"), (normalize.match_artist, "Destiny's Child [US]", "destinys child"),
    (normalize.code_letters, " abc ", "ABC"), (normalize.code_letters, "Z-A", "V/A"), (normalize.code_letters, "beat", "BE"), (normalize.code_letters, " ", None),
    (normalize.is_compilation, "Various Artists - Rock", True), (normalize.is_compilation, "V/A", True), (normalize.is_compilation, "Soundtracks", True), (normalize.is_compilation, "Various Cruelties", False), (normalize.is_compilation, None, False),
    (normalize.none_form, " NULL ", None), (normalize.flat_breaks, "a\tb\nc", "a b c"), (normalize.split_names, "A Band, B Band", ["A Band", "B Band"]), (normalize.split_names, "10,000 Maniacs", None), (normalize.split_names, "Crosby", None),
    (normalize.is_corrupt, "a�", True),
    (formats.release_category, "2xLP, Album", "Vinyl"), (formats.release_category, "Betamax", None), (formats.shelf_category, "vinyl - 7\" x 2", '7"'), (formats.shelf_category, "vinyl - odd", "Vinyl"), (formats.shelf_category, "cd x 3 box", "CD"),
    (stats.release_year, "1999-01", 1999), (stats.release_year, "c.1999", None),
])
def test_forms(spark, f, value, want):
    assert one(spark, value, f) == want


def test_shelf_format(spark):
    assert tuple(one(spark, 'Vinyl - 12" x 2', formats.shelf_format)) == ('vinyl 12"', 2)
    assert tuple(one(spark, "cd x 3 box", formats.shelf_format)) == ("cd", 3)
    assert one(spark, "cassette", formats.shelf_format) is None


def test_accents_as_python_has_them(spark):
    base = lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c))
    text = "".join(chr(c) for c in range(0xA0, 0x530) if len(base(chr(c))) == 1)  # what decomposes to several letters stays
    assert one(spark, text, strip_accents) == base(text)


def test_trigram_value(spark):
    assert one(spark, "two words", lambda c: similarity(c, F.lit("word"))) == pytest.approx(4 / 11)
    assert one(spark, None, lambda c: similarity(c, F.lit("word"))) == 0


@given(st.text("abcd", max_size=30), st.text("abcd", max_size=30))
@settings(max_examples=80, deadline=None)
def test_common_subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[-1]))
        row = new
    assert common_length(a, b) == row[-1]
    assert 0 <= indel_ratio(a, b) <= 100 and indel_ratio(a, b) == indel_ratio(b, a)


def test_token_ratios():
    assert token_sort("new york mets", "mets york new") == 100
    assert token_set("mets", "new york mets") == 100 and token_set("", "x") == 0
    assert round(jaro_winkler("martha", "marhta"), 4) == 0.9611 and round(jaro_winkler("velvetlab", "velvet lab"), 2) == 0.98


def test_damage():
    assert explains("D�cal�", "Décalé") and not explains("D�cal�", "Décalx2")
    assert explains("DÃ©", "Dé") and explains("tr��s", "tràs") and not explains("x�", "x�") and explains(None, None)


def test_wilson_bounds(spark):
    r = spark.range(1).select(stats.wilson(F.lit(0.0), F.lit(0.0)).alias("z"), stats.wilson(F.lit(5.0), F.lit(5.0)).alias("a")).first()
    assert tuple(r.z) == (0, 0) and r.a.high == 1 and 0.5 < r.a.low < 0.6


def test_compatible_formats(spark):
    df = spark.createDataFrame([("CD", ["CD"], False, True), ("CD", ["Vinyl"], False, False), ("CD", ["Vinyl"], True, True), (None, ["CD"], False, True), ("CD", [], False, True), ("CD", None, None, True)], "r string, s array<string>, n boolean, want boolean")
    assert all(r.got == r.want for r in df.select(formats.compatible(F.col("r"), F.col("s"), F.col("n")).alias("got"), "want").collect())
