import csv
import io

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from crateflow.functions.fsm import states_before, tokenize
from crateflow.operators.record_parse import parse_records, typed_rows


def run(records, chunk=None):
    raw = [r.encode() for r in records]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    ends = np.cumsum([len(r) for r in raw]) if raw else np.zeros(0, dtype=int)
    starts = ends - [len(r) for r in raw] if raw else ends
    bad, n, lo, hi = tokenize(data, starts.astype(np.int64), ends.astype(np.int64))
    fields = [bytes(data[a:b]).decode() for a, b in zip(lo, hi)]
    out, at = [], 0
    for k in n:
        out.append(fields[at : at + k])
        at += k
    return bad.tolist(), out


def test_quotes_and_breaks():
    bad, fields = run(['a,b', '"a,b",c', 'a"b', '"a"x', '"open', '"say ""hi""",', "", "x\ny", '"x\ny"'])
    assert bad == [-1, -1, 1, 3, 5, -1, -1, 1, -1]
    assert fields[1] == ['"a,b"', "c"] and fields[5] == ['"say ""hi"""', ""] and fields[6] == [""]


@given(st.lists(st.lists(st.text(alphabet='a",\n é', max_size=90), min_size=1, max_size=4), max_size=6))
@settings(max_examples=60, deadline=None)
def test_round_trip_with_a_csv_writer(rows):
    lines = []
    for r in rows:
        out = io.StringIO()
        csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="").writerow(r)
        lines.append(out.getvalue())
    bad, fields = run(lines)
    assert all(b == -1 for b in bad)
    assert [[f[1:-1].replace('""', '"') for f in fs] for fs in fields] == rows


@given(st.binary(max_size=400).map(lambda b: np.frombuffer(b, dtype=np.uint8) % 5), st.integers(1, 70))
@settings(max_examples=60, deadline=None)
def test_chunks_do_not_matter(classes, chunk):
    assert (states_before(classes, chunk) == states_before(classes, 10_000)).all()


CASES = [
    ("release.csv", "1,ok,Title,US,2001-02-00,,Correct,,CD", None),
    ("release.csv", "1,ok,Title,US,2001-00-00,,Correct,7,CD", None),
    ("release.csv", "1,ok,Title,US,2001-02-30,,Correct,7,CD", "value"),
    ("release.csv", "1,ok,Title,US,2001-00-05,,Correct,7,CD", "value"),
    ("release.csv", "1,ok,Title,US,2001-13,,Correct,7,CD", "value"),
    ("release.csv", "1,ok,,US,2001,,Correct,7,CD", "value"),
    ("release.csv", "2147483648,ok,Title,US,2001,,Correct,7,CD", "value"),
    ("release.csv", "1,ok,Title,US,Unknown,,Correct,x,CD", "value"),
    ("release.csv", "1,ok,Title,US,2001,,Correct,7", "columns"),
    ("release.csv", '1,ok,12" Title,US,2001,,Correct,7,CD,', "quoting"),
    ("release_track.csv", "1,2,A1,Song,3:59", None),
    ("release_track.csv", "1,2,A1,Song,1:03:59", None),
    ("release_track.csv", "1,2,A1,Song,3:60", "value"),
    ("release_track.csv", '1,2,A1,"Song, two",', None),
    ("other.csv", "1,2", "columns"),
    (None, None, "columns"),
    ("release.csv", None, "columns"),
    ("release_track.csv", "", "columns"),
    ("release_track.csv", '1,2,A1,"' + "long " * 60_000 + '",3:59', None),
]


def test_reasons(spark):
    df = spark.createDataFrame([(i, f, r, "clash") for i, (f, r, _) in enumerate(CASES)], "line_id long, csv_file string, raw_line string, reason string")
    got = {r.line_id: r.reason for r in parse_records(df, "line_id", "raw_line", "csv_file").collect()}
    assert got == {i: why for i, (_, _, why) in enumerate(CASES)}


def test_typed_rows_and_repeats(spark):
    df = spark.createDataFrame([(1, "release_track.csv", '5,2,,"Say ""x""",')] * 2, "line_id long, csv_file string, raw_line string")
    rows = typed_rows(parse_records(df, "line_id", "raw_line", "csv_file"), "line_id", "csv_file", "release_track.csv").collect()
    assert [tuple(r) for r in rows] == [(1, 5, 2, None, 'Say "x"', None)] * 2


@pytest.mark.parametrize("rows", [[]])
def test_empty(spark, rows):
    df = spark.createDataFrame(rows, "line_id long, csv_file string, raw_line string")
    assert parse_records(df, "line_id", "raw_line", "csv_file").count() == 0


def test_slices_change_nothing(spark, monkeypatch):
    from crateflow.operators import record_parse

    rows = [(i, "release_track.csv", r) for i, r in enumerate(["1,2,,T,", '1,2,,"' + "x" * 300 + '",3:00', None, '1,2,,"a', "x" * 90 + ",1,,T,", '1,2,,"a""b",9:61'])]
    df = spark.createDataFrame(rows, "line_id long, csv_file string, raw_line string").coalesce(1)
    whole = record_parse.parse_records(df, "line_id", "raw_line", "csv_file").collect()
    monkeypatch.setattr(record_parse, "SLICE_BYTES", 100)
    assert record_parse.parse_records(df, "line_id", "raw_line", "csv_file").collect() == whole
    assert [b.num_rows for b in record_parse._slices(pa_batch(["a" * 50, "b" * 60, None, "c" * 500, "d"]), "r", 100)] == [1, 2, 1, 1]


def pa_batch(texts):
    import pyarrow as pa

    return pa.RecordBatch.from_arrays([pa.array(texts)], names=["r"])
