"""Files exchanged with other systems, read and written on small cases."""

import json
import random

import pytest

from crateflow.functions.normalize import light_form
from crateflow.sources import csv_tables, exchange
from crateflow.sources.text_rows import load_mapping, parse_tsv


def _csv(rows):
    quote = lambda t: '"' + t.replace('"', '""') + '"' if any(c in t for c in ',"\n') else t
    return "id,title,note\n" + "".join(",".join(map(quote, r)) + "\n" for r in rows)


def test_split_csv_equals_one_task(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(str(i), "".join(rnd.choice('ab",\n é') for _ in range(rnd.randrange(0, 40))).strip("\r") or "x", rnd.choice(["", "n", '"', "a\n\n\nb" * 9])) for i in range(300)]
    f = tmp_path / "a.csv"
    f.write_text(_csv(rows), encoding="utf-8", newline="")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "900")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        got = csv_tables.read_split_csv(spark, str(f))
        assert spark.read.text(str(f)).rdd.getNumPartitions() > 5
        assert [tuple(r)[:3] for r in sorted(got.collect(), key=lambda r: r["_row_pos"])] == rows
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_key_widens(spark):
    spec = csv_tables.SPECS["release_track_artist"]
    raw = spark.createDataFrame([], "release_id string, track_sequence string, artist_name string, role string")
    assert csv_tables.key_of(raw, spec) == ["release_id", "track_sequence", "artist_name", "role"] and csv_tables.key_of(raw.drop("role"), spec) == list(spec.key)


def test_filter_export(spark):
    raw = spark.createDataFrame([("1", "a"), ("x", "b"), ("2", None), (None, "c"), (" 3 ", "d")], "release_id string, t string")
    ids = spark.createDataFrame([(2,), (3,)], "id int")
    assert sorted(r.release_id for r in exchange.filter_export(raw, ids).collect()) == [" 3 ", "2"]
    with pytest.raises(exchange.SourceError):
        exchange.filter_export(raw.select("t"), ids)
    assert exchange.adapted(raw, {"t": "string", "label": "int"}).dtypes == [("t", "string"), ("label", "int")]


def test_compilation_tracks_and_escapes(spark):
    lines = spark.createDataFrame([("1\ta\\\\tb\tc\\td",), ("1\t\\N\tx",), ("x\ta\tb",), ("2\ta",), ("3\ta\t\\N",)], "value string")
    assert sorted(map(tuple, exchange.compilation_tracks(lines).collect()), key=repr) == [(1, "a\\tb", "c\td"), (3, "a", None)]
    held = spark.createDataFrame([("\ue000\\\\n\ue000\t\\\\\\\\\\n",)], "value string")
    assert tuple(parse_tsv(held, ["a", "b"]).first()) == ("\ue000\\n\ue000", "\\\\\n")


def test_labels(spark):
    raw = spark.createDataFrame([("A", "T", "L"), ("A", "", "L"), ("A", "T", "L")], "artist_name string, release_title string, label_name string")
    assert [tuple(r) for r in exchange.label_preferences(raw).collect()] == [("A", "T", "L")]
    links = spark.createDataFrame([("1", "a", "2", "b"), ("x", "a", "2", "b"), ("1", "a", None, None)], "label_id string, label_name string, parent_label_id string, parent_label_name string")
    assert [tuple(r) for r in exchange.label_links(links).collect()] == [(1, "a", 2, "b")]


def test_mapping_round_trip(spark, tmp_path):
    d = spark.createDataFrame([("B", "prune", None), ("A", "keep", "Ä")], "artist string, decision string, library_artist string")
    exchange.write_mapping(d, str(tmp_path / "m.json"))
    assert json.loads((tmp_path / "m.json").read_text(encoding="utf-8")) == {"keep": {"A": "Ä"}, "prune": {"B": None}}
    assert sorted(map(tuple, load_mapping(spark, str(tmp_path / "m.json")).collect())) == [("A", "keep"), ("B", "prune")]


def test_audit_round_trip(spark, tmp_path):
    classes = spark.createDataFrame([(2, "keep"), (1, "prune"), (3, "prune"), (4, "review")], "id int, class string")
    releases = spark.createDataFrame([(1, "b", "t", None), (1, "a", "u", "CD"), (2, "x", "y", "CD")], "id int, artist string, title string, format string")
    exchange.write_audit(classes, classes, classes.limit(0), releases, str(tmp_path / "a"))
    got, pruned = exchange.read_audit(spark, str(tmp_path / "a"))
    assert sorted(map(tuple, got.collect())) == [(1, "prune"), (2, "keep"), (3, "prune"), (4, "review")]
    assert [tuple(r) for r in pruned.collect()] == [(1, "a", "u", "CD")]
    assert spark.read.json(str(tmp_path / "a/counts.json")).first().asDict() == {"keep": 1, "review": 1, "prune": 2, "total_release_rows": 3}


def test_collision_files(spark):
    raw = spark.createDataFrame([("7", "WRONG_PERSON", "A", "Rock", "AB", "3", 2), ("7", "WRONG_PERSON", "B", "Jazz", "AB", "3", 1), ("8", "FINE", "C", "Jazz", "C", "1", 3)], "library_code_id string, diagnosis string, artist_name string, station_genre string, call_letters string, call_numbers string, _row_pos int")
    assert [tuple(r) for r in exchange.wrong_persons(raw).collect()] == [(7, "B", "Jazz", "AB", 3)]
    resolved = spark.createDataFrame([("B", "RESOLVED", 5, 9, 0.71249, 2), ("C", "UNRESOLVED", None, None, None, 0)], "name string, status string, artist_id int, release_id int, score double, hits int")
    pair = lambda rows, schema: spark.createDataFrame(rows, schema)
    out = exchange.collision_rows(resolved, pair([("B", "t2"), ("B", "t1")], "name string, title string"), pair([(9, "Rock")], "release_id int, genre string"), pair([], "release_id int, style string"))
    assert {r.name: tuple(r)[1:] for r in out.collect()} == {"B": ("t1; t2", "9", "5", "0.712", "Rock", "", "2", "RESOLVED"), "C": ("", "", "", "", "", "", "0", "UNRESOLVED")}


def test_ledger(spark, tmp_path):
    lines = spark.createDataFrame([("# x",), ("",), ("mine\ttheirs",), ("5\t7",), ("3\t4",)], "value string")
    pairs = exchange.collapsed_ids(lines, ("mine", "theirs"))
    path = str(tmp_path / "l.json")
    (tmp_path / "l.json").write_text(json.dumps({"baselines": {"normalizations": {}, "cta_missing": 4}}))
    exchange.write_ledger(pairs, path, "2026-01-02")
    ids, baselines = exchange.read_ledger(spark, path)
    assert sorted(r.id for r in ids.collect()) == [3, 5] and baselines["cta_missing"] == 4
    with pytest.raises(Exception, match="not two ids"):
        exchange.collapsed_ids(spark.createDataFrame([("a\tb",)], "value string"), ("x", "y")).collect()
    for bad in ("[]", "{}", '{"collapsed_mysql_ids": {}, "baselines": "x"}', '{"collapsed_mysql_ids": {}, "baselines": {"cta_extra": true}}', "x"):
        (tmp_path / "l.json").write_text(bad)
        with pytest.raises(exchange.SourceError):
            exchange.read_ledger(spark, path)


XML = """<releases>
<release id="1" status="Accepted"><title>Pale &amp; Ferry</title><country>US</country><released>1999</released><notes>a
b</notes><data_quality>Correct</data_quality><master_id>7</master_id><formats><format name="Vinyl" qty="2"/><format name="CD" qty="1"/></formats>
<artists><artist><id>5</id><name>Ida Mur</name><anv>I. Mur</anv><join>&amp;</join></artist><artist><id>6</id><name>Bo Lind</name></artist></artists><extraartists><artist><id>8</id><name>Al Fox</name><role>Mix</role></artist></extraartists>
<labels><label id="3" name="Harbor" catno="H1"/></labels><tracklist><track><position>A1</position><title>One</title><duration>3:00</duration></track><track><position>A2</position><title>Two</title><duration/></track></tracklist></release>
<release id="2" status="Accepted"><title>Empty</title><artists/></release>
</releases>"""


def test_xml(spark, tmp_path):
    (tmp_path / "r.xml").write_text(XML, encoding="utf-8")
    t = exchange.read_releases_xml(spark, str(tmp_path / "r.xml"))
    releases = {r.id: r for r in t["release"].collect()}
    assert releases[1].title == "Pale & Ferry" and releases[1].format == "Vinyl" and releases[1].master_id == 7 and releases[2].format is None and set(releases) == {1, 2}
    assert sorted((r.artist_id, r.artist_name, r.extra) for r in t["release_artist"].collect()) == [(5, "Ida Mur", 0), (6, "Bo Lind", 0), (8, "Al Fox", 1)]
    assert [(r.release_id, r.label_id, r.label_name, r.catno) for r in t["release_label"].collect()] == [(1, 3, "Harbor", "H1")]
    assert sorted((r.sequence, r.position, r.title, r.duration) for r in t["release_track"].collect()) == [(1, "A1", "One", "3:00"), (2, "A2", "Two", None)]
    cut = exchange.xml_filter(t, spark.createDataFrame([("IDA MUR",)], "name string"), light_form)
    assert [r.id for r in cut["release"].collect()] == [1] and cut["release_track"].count() == 2


def test_consistent_snapshot(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id int")
    answers = [(ids(1), "a", ids(1), "b"), (ids(1), "b", ids(1, 2), "b"), (ids(1, 2), "c", ids(2), "c")]
    rows, children = exchange.consistent_snapshot(lambda: answers.pop(0), "id", "id")
    assert rows.count() == 2 and children.count() == 1 and not answers
    with pytest.raises(exchange.SourceError, match="moved"):
        exchange.consistent_snapshot(lambda: (ids(1), "a", ids(1), "b"), "id", "id", 2)
