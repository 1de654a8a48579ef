import json

import pytest

from crateflow.operators import tables
from crateflow.sources.csv_tables import SPECS, read_csv, scan, swap_in, write_fixed_lines
from crateflow.sources.text_rows import load_mapping, parse_tsv, read_id_list, read_ndjson, write_classes, write_copy_text

LIBRARY = ["id", "title", "note"]


def test_csv_scan(spark, tmp_path):
    f = tmp_path / "release.csv"
    f.write_text('id,title,country,released,format,master_id,extra\n1,"A ""b""\nc",US,,2xLP,7,x\n1,Second,US,,CD,,x\nx,Bad,US,,CD,,x\n2,,US,,CD,,x\n', encoding="utf-8")
    rows = scan(read_csv(spark, str(f)), SPECS["release"])
    first = tables.first_wins(rows, ["id"], [rows["_row_pos"]]).collect()
    assert [(r.id, r.title, r.format, r.released) for r in first] == [(1, 'A "b"\nc', "Vinyl", None)]


def test_missing_columns(spark):
    raw = spark.createDataFrame([("1", "x")], "release_id string, artist_name string")
    assert scan(raw, SPECS["release_artist"]).count() == 0  # artist_id and extra are mandatory
    raw = spark.createDataFrame([("1", "2", "x", "0")], "release_id string, artist_id string, artist_name string, extra string")
    assert scan(raw, SPECS["release_artist"]).first().role is None


def test_tsv(spark):
    lines = spark.createDataFrame([("1\ta\\\\tb\t\\N",), ("2\ttoo few",), ("x\ta\tb",), ("3\tc\\td\\n\te",)], "value string")
    assert sorted(map(tuple, parse_tsv(lines, LIBRARY, ("id",)).collect())) == [(1, "a\\tb", None), (3, "c\td\n", "e")]


def test_copy_text_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", "a\\b\tc\nd", None)], "id string, title string, note string")
    write_copy_text(df, str(tmp_path / "out"))
    back = parse_tsv(spark.read.option("lineSep", "\n").text(str(tmp_path / "out")), LIBRARY)
    assert [tuple(r) for r in back.collect()] == [("1", "a\\b\tc\nd", None)]


def test_lists_and_dumps(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("# kept\n1\n\n 2 \n2\nx\n")
    assert sorted(r.id for r in read_id_list(spark, str(tmp_path / "ids.txt")).collect()) == [1, 2]
    (tmp_path / "map.json").write_text(json.dumps({"keep": {"A": 1}, "prune": {"B": 1}}))
    assert sorted(map(tuple, load_mapping(spark, str(tmp_path / "map.json")).collect())) == [("A", "keep"), ("B", "prune")]
    write_classes(spark.createDataFrame([(2, "keep"), (1, "keep"), (3, "prune")], "id int, class string"), str(tmp_path / "c"))
    assert [r.value for r in spark.read.text(str(tmp_path / "c/keep")).collect()] == ["1", "2"]


def test_ndjson(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "name": "x"}\n{"id": null, "name": "y"}\n')
    with pytest.raises(Exception, match="id is missing"):
        read_ndjson(spark, str(tmp_path / "a.json"), "id long, name string", ["id"]).collect()


def test_sinks(spark, tmp_path):
    write_fixed_lines(spark.createDataFrame([("a\r\nb",)], "x string"), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).first().x == "a b"
    for n in (1, 2):
        swap_in(spark.range(n), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
