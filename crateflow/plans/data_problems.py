"""Queries of the general data problems: broken records, hierarchies and copies that differ."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateflow.operators.hierarchy import descendants, paths, roots
from crateflow.operators.record_parse import parse_records, typed_rows
from crateflow.operators.table_diff import table_diff
from crateflow.sources.tables import table


def _parsed(spark: SparkSession, d: str) -> DataFrame:
    return parse_records(table(spark, d, "release_raw"), "line_id", "raw_line", "csv_file")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _parsed(spark, d).where("reason is not null").select("line_id", "reason").distinct()


def p2_releases(spark: SparkSession, d: str) -> DataFrame:
    return typed_rows(_parsed(spark, d), "line_id", "csv_file", "release.csv")


def p2_tracks(spark: SparkSession, d: str) -> DataFrame:
    return typed_rows(_parsed(spark, d), "line_id", "csv_file", "release_track.csv")


def p2_errors(spark: SparkSession, d: str) -> DataFrame:
    return _parsed(spark, d).where("reason is not null").select("line_id", "csv_file", "reason", "error_at", "error_field")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    r = roots(table(spark, d, "label_hierarchy"), "label_id", "parent_label_id")
    return r.select(F.col("node").cast("int").alias("label_id"), F.col("root").cast("int").alias("root_label_id"), "depth")


def _label_paths(spark: SparkSession, d: str) -> DataFrame:
    return paths(table(spark, d, "label_hierarchy"), "label_id", "parent_label_id")


def p3_paths(spark: SparkSession, d: str) -> DataFrame:
    return _label_paths(spark, d).select(F.col("node").alias("label_id"), F.col("root").alias("root_label_id"), "depth", F.array_join("path", "/").alias("path"))


def p3_descendants(spark: SparkSession, d: str) -> DataFrame:
    return descendants(_label_paths(spark, d)).select(F.col("ancestor").alias("label_id"), F.col("node").alias("descendant_label_id"), "distance")


def p3_circles(spark: SparkSession, d: str) -> DataFrame:
    r = roots(table(spark, d, "label_hierarchy"), "label_id", "parent_label_id").where("depth = -1")
    return r.groupBy(F.col("root").alias("circle_label_id")).agg(F.count("*").alias("labels"))


_COMPARED = ["title", "artist", "alternate_artist_name"]


def _library_diff(spark: SparkSession, d: str) -> DataFrame:
    diff = table_diff(table(spark, d, "library"), table(spark, d, "library_backend"), "id", _COMPARED)
    named = F.when(F.col("diff") == "only_left", "only_library").when(F.col("diff") == "only_right", "only_backend").otherwise(F.col("diff"))
    return diff.withColumn("diff", named).withColumnRenamed("id", "library_id")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _library_diff(spark, d).select("library_id", "diff")


def p6_values(spark: SparkSession, d: str) -> DataFrame:
    return _library_diff(spark, d).where("diff not like 'only%'")


def p6_summary(spark: SparkSession, d: str) -> DataFrame:
    return _library_diff(spark, d).groupBy("diff").agg(F.count("*").alias("n"))


QUERIES = {f.__name__: f for f in (p2_found, p2_releases, p2_tracks, p2_errors, p3_found, p3_paths, p3_descendants, p3_circles, p6_found, p6_values, p6_summary)}

_FIELD = r"""(?:"(?:[^"]|"")*"|[^",\n\r]*)"""
_PARSED_SQL = rf"""
raw AS (SELECT line_id, csv_file, coalesce(raw_line, '') AS line FROM release_raw),
cut AS (SELECT *, regexp_full_match(line, '{_FIELD}(?:,{_FIELD})*') AS quoted_well,
  [replace(CASE WHEN starts_with(f, '"') THEN f[2:-2] ELSE f END, '""', '"') FOR f IN
    [g[:-2] FOR g IN regexp_extract_all(line || ',', '(?:"(?:[^"]|"")*"|[^",]*),')]] AS f FROM raw),
sized AS (SELECT *, CASE csv_file WHEN 'release.csv' THEN 9 WHEN 'release_track.csv' THEN 5 ELSE -1 END AS width FROM cut),
judged AS (SELECT *,
  CASE WHEN NOT quoted_well THEN 'quoting' WHEN len(f) <> width THEN 'columns'
  WHEN csv_file = 'release.csv' AND (
    NOT (regexp_full_match(f[1], '[+-]?[0-9]+') AND try_cast(f[1] AS INTEGER) IS NOT NULL) OR f[3] = ''
    OR NOT (f[5] IN ('', 'Unknown') OR regexp_full_match(f[5], '[0-9]{{4}}(-(0[1-9]|1[0-2]))?') OR regexp_full_match(f[5], '[0-9]{{4}}-00-00|[0-9]{{4}}-(0[1-9]|1[0-2])-00')
      OR (regexp_full_match(f[5], '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast(f[5] AS DATE) IS NOT NULL))
    OR NOT (f[8] = '' OR (regexp_full_match(f[8], '[+-]?[0-9]+') AND try_cast(f[8] AS INTEGER) IS NOT NULL))) THEN 'value'
  WHEN csv_file = 'release_track.csv' AND (
    NOT (regexp_full_match(f[1], '[+-]?[0-9]+') AND try_cast(f[1] AS INTEGER) IS NOT NULL)
    OR NOT (regexp_full_match(f[2], '[+-]?[0-9]+') AND try_cast(f[2] AS INTEGER) IS NOT NULL) OR f[4] = ''
    OR NOT (f[5] = '' OR regexp_full_match(f[5], '[0-9]+:[0-5][0-9](:[0-5][0-9])?') AND (regexp_full_match(f[5], '[0-9]+:[0-5][0-9](:[0-5][0-9])?')))) THEN 'value' END AS reason
  FROM sized)"""

_INT_SQL = "coalesce(regexp_full_match({x}, '[+-]?[0-9]+') AND try_cast({x} AS INTEGER) IS NOT NULL, false)"
# A record breaks the quoting rule after the longest beginning that a record may have.
_ERRORS_SQL = rf"""
WITH {_PARSED_SQL}, placed AS (SELECT *, CASE reason WHEN 'quoting' THEN strlen(regexp_extract(line, '^(?:{_FIELD},)*(?:"(?:[^"]|"")*"?|[^",\n\r]*)')) WHEN 'columns' THEN len(f)
  WHEN 'value' THEN CASE WHEN NOT {_INT_SQL.format(x='f[1]')} THEN 0
    WHEN csv_file = 'release.csv' THEN CASE WHEN f[3] = '' THEN 2 WHEN NOT (f[8] = '' OR {_INT_SQL.format(x='f[8]')}) AND (f[5] IN ('', 'Unknown') OR regexp_full_match(f[5], '[0-9]{{4}}(-(0[1-9]|1[0-2]))?|[0-9]{{4}}-00-00|[0-9]{{4}}-(0[1-9]|1[0-2])-00')
      OR (regexp_full_match(f[5], '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast(f[5] AS DATE) IS NOT NULL)) THEN 7 ELSE 4 END
    ELSE CASE WHEN NOT {_INT_SQL.format(x='f[2]')} THEN 1 WHEN f[4] = '' THEN 3 ELSE 4 END END END AS error_at FROM judged WHERE reason IS NOT NULL)
SELECT line_id, csv_file, reason, error_at::BIGINT AS error_at, CASE WHEN reason = 'value' THEN CASE csv_file WHEN 'release.csv' THEN ['id', 'status', 'title', 'country', 'released', 'notes', 'data_quality', 'master_id', 'format'][error_at + 1]
  ELSE ['release_id', 'sequence', 'position', 'title', 'duration'][error_at + 1] END END AS error_field FROM placed"""

_EDGES_SQL = """
e AS (SELECT label_id AS c, min(parent_label_id) AS p FROM label_hierarchy WHERE label_id IS NOT NULL AND parent_label_id IS NOT NULL GROUP BY 1),
ids AS (SELECT label_id AS id FROM label_hierarchy WHERE label_id IS NOT NULL UNION SELECT parent_label_id FROM label_hierarchy WHERE parent_label_id IS NOT NULL),
down AS (SELECT id, id AS root, 0 AS depth, id::VARCHAR AS path FROM ids WHERE id NOT IN (SELECT c FROM e)
  UNION ALL SELECT e.c, root, depth + 1, path || '/' || e.c FROM down JOIN e ON e.p = down.id),
reach AS (SELECT c AS id, p AS a FROM e WHERE c NOT IN (SELECT id FROM down) UNION SELECT reach.id, e.p FROM reach JOIN e ON e.c = reach.a),
circle AS (SELECT id FROM reach WHERE id = a),
allrows AS (SELECT * FROM down UNION ALL SELECT id, min(a), -1, NULL FROM reach WHERE a IN (SELECT id FROM circle) GROUP BY id)"""

_DIFF_SQL = """
SELECT coalesce(a.id, b.id) AS library_id, u.diff, u.l AS left_value, u.r AS right_value
FROM library a FULL JOIN library_backend b ON a.id = b.id,
LATERAL (SELECT unnest(CASE WHEN b.id IS NULL THEN ['only_library'] WHEN a.id IS NULL THEN ['only_backend'] ELSE ['title', 'artist', 'alternate_artist_name'] END) AS diff,
  unnest(CASE WHEN b.id IS NULL OR a.id IS NULL THEN [NULL] ELSE [a.title, a.artist, a.alternate_artist_name] END) AS l,
  unnest(CASE WHEN b.id IS NULL OR a.id IS NULL THEN [NULL] ELSE [b.title, b.artist, b.alternate_artist_name] END) AS r) u
WHERE u.diff LIKE 'only%' OR u.l IS DISTINCT FROM u.r"""

ORACLE = {
    "p2_found": f"WITH {_PARSED_SQL} SELECT line_id, reason FROM judged WHERE reason IS NOT NULL",
    "p2_releases": f"WITH {_PARSED_SQL} SELECT line_id, try_cast(f[1] AS INTEGER) AS id, nullif(f[2], '') AS status, f[3] AS title, nullif(f[4], '') AS country, nullif(f[5], '') AS released, nullif(f[6], '') AS notes, nullif(f[7], '') AS data_quality, try_cast(f[8] AS INTEGER) AS master_id, nullif(f[9], '') AS format FROM judged WHERE reason IS NULL AND csv_file = 'release.csv'",
    "p2_tracks": f"WITH {_PARSED_SQL} SELECT line_id, try_cast(f[1] AS INTEGER) AS release_id, try_cast(f[2] AS INTEGER) AS sequence, nullif(f[3], '') AS position, f[4] AS title, nullif(f[5], '') AS duration FROM judged WHERE reason IS NULL AND csv_file = 'release_track.csv'",
    "p2_errors": _ERRORS_SQL,
    "p3_found": f"WITH RECURSIVE {_EDGES_SQL} SELECT id AS label_id, root AS root_label_id, depth FROM allrows",
    "p3_paths": f"WITH RECURSIVE {_EDGES_SQL} SELECT id::BIGINT AS label_id, root::BIGINT AS root_label_id, depth, path FROM allrows",
    "p3_descendants": f"""WITH RECURSIVE {_EDGES_SQL}, below AS (SELECT c AS id, p AS a, 1 AS distance FROM e WHERE c IN (SELECT id FROM down)
      UNION ALL SELECT below.id, e.p, distance + 1 FROM below JOIN e ON e.c = below.a) SELECT a::BIGINT AS label_id, id::BIGINT AS descendant_label_id, distance FROM below""",
    "p3_circles": f"WITH RECURSIVE {_EDGES_SQL} SELECT root::BIGINT AS circle_label_id, count(*) AS labels FROM allrows WHERE depth = -1 GROUP BY 1",
    "p6_found": f"SELECT library_id, diff FROM ({_DIFF_SQL})",
    "p6_values": f"SELECT * FROM ({_DIFF_SQL}) WHERE diff NOT LIKE 'only%'",
    "p6_summary": f"SELECT diff, count(*) AS n FROM ({_DIFF_SQL}) GROUP BY 1",
}
