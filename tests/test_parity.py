"""Field models, row expectations, repair and verdict of two snapshots, case by case."""

import pytest
from pyspark.sql import functions as F

from crateflow.operators import parity

ROW = {c: None for c in parity.COLUMNS} | {"artist": "Ida Mur", "title": "Pale Ferry", "genre": "Rock", "format": "cd", "call_letters": "MUR", "artist_call_number": "4", "release_call_number": "2"}
SCHEMA = "id int, " + ", ".join(f"{c} string" for c in parity.COLUMNS)


def _rows(spark, *rows):
    return spark.createDataFrame([(r["id"], *[r[c] for c in parity.COLUMNS]) for r in rows], SCHEMA)


@pytest.mark.parametrize("column,left,right,want", [
    ("title", "Pale Ferry", " Pale Ferry ", ("agree", None)), ("title", "NULL", None, ("agree", None)), ("title", "Pale\tFerry", "Pale Ferry", ("normalized", "tab_newline_substituted")), ("title", "Pale", "pale", ("mismatch", None)),
    ("artist", "various artists - Rock", "Various Artists", ("normalized", "various_artists")), ("artist", "Ida\nMur", "Ida Mur", ("normalized", "trimmed_or_substituted")), ("artist", "Idá Mur", "IDA MUR", ("normalized", "fold_equal")), ("artist", "Ida", "Bo", ("mismatch", None)),
    ("call_letters", "mur", "MUR", ("normalized", "uppercased")), ("call_letters", "mu x", "MU", ("normalized", "uppercased")), ("call_letters", None, "??", ("normalized", "fallback_unknown")), ("call_letters", "Z-A", "v/a", ("normalized", "various_artists_code")), ("call_letters", "MUR", "LIN", ("mismatch", None)),
    ("artist_call_number", None, "0", ("normalized", "null_coalesced_zero")), ("artist_call_number", "4", "5", ("mismatch", None)), ("release_call_number", "NULL", "0", ("normalized", "null_coalesced_zero")), ("release_call_number", "2", "0", ("mismatch", None)),
    ("genre", "Rock", "ROCK", ("normalized", "case_folded")), ("genre", "Rock", "Jazz", ("mismatch", None)), ("format", "cd x 2", "CD", ("normalized", "format_derived")), ("format", 'vinyl - 12"', 'Vinyl 12"', ("normalized", "format_derived")), ("format", "tape", "cassette", ("mismatch", None)),
    ("cross_reference_names", "A | B", "b | a", ("normalized", "fold_equal")), ("cross_reference_names", "A | B", "A", ("normalized", "cardinality_loss")), ("cross_reference_names", "A", "A | C", ("normalized", "cardinality_gain")), ("cross_reference_names", "A | B", "A | C", ("mismatch", None)), ("cross_reference_names", None, "", ("agree", None)),
    ("album_artist", "a\nb", "a b", ("normalized", "tab_newline_substituted")), ("alternate_artist_name", None, "x", ("mismatch", None)),
])
def test_field_models(spark, column, left, right, want):
    a, b = _rows(spark, ROW | {"id": 1, column: left}), _rows(spark, ROW | {"id": 1, column: right})
    got = {r.field: (r.tier, r["class"]) for r in parity.field_classes(a, b, "id").collect()}
    assert got[column] == want and {k for k, v in got.items() if v[0] == "mismatch"} <= {column}


def test_compilations_have_their_own_letters_and_number(spark):
    a, b = _rows(spark, ROW | {"id": 1, "artist": "Various"}), _rows(spark, ROW | {"id": 1, "artist": "Various Artists", "call_letters": "V/A", "artist_call_number": "0"})
    got = {r.field: (r.tier, r["class"]) for r in parity.field_classes(a, b, "id").collect()}
    assert got["call_letters"] == ("normalized", "various") == got["artist_call_number"]


@pytest.mark.parametrize("genre,skipped,letters,number", [("rock", False, "fold_collapsed", "fold_collapsed"), ("Jazz", False, "fold_collapsed", None), ("rock", True, None, None)])
def test_siblings_explain_a_collapsed_value(spark, genre, skipped, letters, number):
    sibling = ROW | {"id": 2, "artist": "IDÁ MUR", "call_letters": "IDA", "artist_call_number": None, "genre": genre, "format": "tape" if skipped else "cd"}
    a = _rows(spark, ROW | {"id": 1}, sibling)
    b = _rows(spark, ROW | {"id": 1, "call_letters": "ida", "artist_call_number": "0"})
    got = {r.field: r["class"] for r in parity.field_classes(a, b, "id").collect()}
    assert (got["call_letters"], got["artist_call_number"]) == (letters, number)


def test_expectations_and_verdict(spark):
    left = _rows(spark, *[ROW | {"id": i} | x for i, x in enumerate(({}, {"genre": " DB_only"}, {"format": "tape"}, {"artist": " "}, {"title": None}, {"title": "NULL"}, {}, {}))])
    right = _rows(spark, ROW | {"id": 0}, ROW | {"id": 1_000_000}, ROW | {"id": 999_999})
    ledger = spark.createDataFrame([(6,), (77,)], "id int")
    got = {(r.id, r.side): r.expected for r in parity.row_expectations(left, right, "id", ledger).collect()}
    assert got == {(1, "missing"): True, (2, "missing"): True, (3, "missing"): True, (4, "missing"): True, (5, "missing"): False, (6, "missing"): True, (7, "missing"): False, (1_000_000, "extra"): True, (999_999, "extra"): False}
    fields = parity.field_classes(left, right, "id")
    none = spark.createDataFrame([], "missing long, extra long")
    v = parity.verdict(parity.row_expectations(left, right, "id", ledger), fields, none).first()
    assert (v.missing_expected, v.missing_unexplained, v.extra_expected, v.extra_unexplained, v.mismatches, v.clean, v.causes) == (5, 2, 1, 1, 0, False, "missing rows, extra rows")
    clean = parity.verdict(parity.row_expectations(left, left, "id"), parity.field_classes(left, left, "id"), none).first()
    assert clean.clean and clean.causes == ""


def test_repeated_ids_are_an_error(spark):
    df = spark.createDataFrame([(1,), (1,)], "id int")
    with pytest.raises(ValueError):
        parity.checked_rows(df, "id")
    assert parity.checked_rows(df.distinct(), "id").count() == 1


def test_repair_outcomes(spark):
    bad = spark.createDataFrame([(1, 9, "Zo\ufffd", "a"), (2, 9, "Zo\ufffd", "b"), (3, 8, "\ufffdx", "a"), (4, 7, "q\ufffd", "a"), (5, 9, "fine", "a")], "row int, k int, t string, u string")
    good = spark.createDataFrame([(9, "Zoé", "a"), (9, "Zoé", "b"), (9, "Zoè", "b"), (8, "\ufffdx", "a"), (9, "Zoé", "a")], "k int, t string, u string")
    got = {r.row: (r.outcome, r["values"]) for r in parity.repair(bad, good, ["k"], ["t", "u"], "row").collect()}
    assert got == {1: ("resolved", ["Zoé", "a"]), 2: ("multiple_candidates", None), 3: ("corrupt_candidates", None), 4: ("zero_candidates", None)}
    assert parity.repair(bad, good, ["k"], ["t"], "row").where(F.col("row") == 4).first().outcome == "zero_candidates"
