from datetime import datetime

from crateflow.streaming import ingest


def test_first_wins_and_windows(spark, tmp_path):
    rows = [(1, "a", datetime(2025, 1, 1, 0, 1)), (1, "b", datetime(2025, 1, 1, 0, 2)), (2, "c", datetime(2025, 1, 1, 2, 0))]
    df = spark.createDataFrame(rows, "id int, v string, at timestamp")
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = ingest.parquet_stream(spark, str(tmp_path / "in"), df.schema)
    q = ingest.first_wins(stream, ["id"], "at").writeStream.format("memory").queryName("fw").start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.id for r in spark.table("fw").collect()) == [1, 2]
    q = ingest.windowed_counts(ingest.parquet_stream(spark, str(tmp_path / "in"), df.schema), "at", "id", "1 hour", "1 hour").writeStream.outputMode("complete").format("memory").queryName("wc").start()
    q.processAllAvailable()
    q.stop()
    assert sorted((r.id, r.n) for r in spark.table("wc").collect()) == [(1, 2), (2, 1)]


def test_upsert_sink_is_idempotent(spark, tmp_path):
    out = str(tmp_path / "out")
    sink = ingest.upsert_sink(out, "id", "n", 4)
    rows = lambda *x: spark.createDataFrame(list(x), "id int, n int")
    sink(rows((1, 1), (2, 1), (3, 1), (4, 1)), 0)
    sink(rows((1, 2), (9, 1)), 1)
    sink(rows((1, 2), (9, 1)), 1)
    sink(rows((2, 0)), 2)
    assert sorted(map(tuple, ingest.latest_rows(spark, out).collect())) == [(1, 2), (2, 1), (3, 1), (4, 1), (9, 1)]
    # Only the buckets of the keys that came are written again.
    assert len(list((tmp_path / "out/v=2").glob("bucket=*"))) == 1
