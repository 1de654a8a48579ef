"""Identity forms against the expected forms of their table and small cases of each rule."""

import re

import duckdb
import pytest
from conftest import SF

from crateflow.functions import identity, unaccent


@pytest.mark.parametrize("text,want", [
    ("The Velvet Ladder", "velvet ladder"), ("Velvet Ladder, The", "velvet ladder"), ("The Ladder, The", "ladder, the"), ("Ida Mur (Live [1999] (Take 2))", "ida mur"), ("(Ida Mur)", "(ida mur)"), ("[Ida]", "[ida]"),
    ("Ida (Live) [Demo]", "ida (live)"), ("Ώρες ΣΑΣ", "ωρεσ σασ"), ("Łada Øst", "lada ost"), ("І\u200bdа Mur", "ida mur"), ("Кино", "кино"), ("The", "the"), ("", ""), ("Zoé /3", "zoe /3"), ("Aşıq", "asıq"),
])
def test_base(text, want):
    assert identity.base(text) == want


def test_variants():
    assert identity.punctuation("The A.B. & C-D!") == "a b c d" and identity.punctuation("!!!") == ""
    assert identity.disambiguated("Ida (Live) /12") == "ida" and identity.disambiguated("X, The /1") == "x, the" and identity.disambiguated("Ida/12") == "ida/12"


@pytest.mark.parametrize("text,stored,matched,plain", [
    ("\u03a3", "\u03a3", "\u03c3", "s"), ("\u041a\u043e\u0442", "\u041a\u043e\u0442", "\u043a\u043e\u0442", "kot"), ("\u0451\u0436", "\u0451\u0436", "\u0451\u0436", "yozh"), ("\u6b4c", "\u6b4c", "\u6b4c", None), ("A \U0001f3b8", "A \U0001f3b8", "a \U0001f3b8", "a"),
    ("\u0141\u00f3d\u017a", "\u0141\u00f3d\u017a", "\u0142odz", "lodz"), ("a\u200eb", "a\u200eb", "ab", "ab"), ("\U0001f468\u200d\U0001f3a4", "\U0001f468\u200d\U0001f3a4", "\U0001f468\u200d\U0001f3a4", None), ("e\u0301", "\u00e9", "e", "e"), ("\u00c3\u00a9", "\u00e9", "e", "e"),
    ("a\0b", "a\0b", None, None), (" a ", "a", "a", "a"), ("\u2019", "\u2019", "\u2019", "'"),
])
def test_forms(text, stored, matched, plain):
    assert (identity.storage(text), identity.match(text), identity.ascii_form(text)) == (stored, matched, plain)


def test_expected_forms():
    rows = duckdb.sql(f"select input, expected, variant from '{SF}/identity_normalization_cases.parquet'").fetchall()
    kernel = {"base": identity.base, "title": identity.base, "punct": identity.punctuation, "disamb": identity.disambiguated}
    missed = [(i, e, v) for i, e, v in rows if kernel[v](i) != e]
    # Some inputs lost a space after a word, which no rule can know.
    joined = lambda t: re.sub("[^a-z0-9]", "", t)
    assert len(missed) < 0.03 * len(rows) and all(joined(kernel[v](i)).endswith(joined(e)) for i, e, v in missed)


def test_columns(spark):
    df = spark.createDataFrame([("The Ladder",), (None,)], "t string")
    assert [r.f for r in df.select(identity.identity_form("t").alias("f")).collect()] == ["ladder", None]


def test_rules(spark):
    assert unaccent.parse_rules("# x\n\n\u00c6\tAE\n") == [("\u00c6", "AE")]
    for bad in ("a", "a\tb\tc", "a\t"):
        with pytest.raises(ValueError):
            unaccent.parse_rules(bad)
    with pytest.raises(ValueError):
        unaccent.split_rules([("ab", "c")])
    with pytest.raises(ValueError):
        unaccent.split_rules([("\u00e6", "ae"), ("a", "b")])
    names = unaccent.register(spark)
    row = spark.sql("select f_unaccent('\u0141\u00f3d\u017a \u00c6s') as a, identity_match_artist('The \u00d8st (Live)') as b, f_unaccent(null) as c").first()
    assert (row.a, row.b, row.c) == ("Lodz AEs", "ost", None) and "f_unaccent" in names
