"""Delimited exports under fixed table layouts."""

from __future__ import annotations

import csv
import os
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crateflow.functions.formats import release_category
from crateflow.functions.normalize import without_nul
from crateflow.operators.record_parse import Field, Layout, parse_records


@dataclass(frozen=True)
class TableSpec:
    """How a file becomes a table: columns are file name -> table name; ``ids`` must be integers; ``key`` keeps the first row of each, widened by those optional columns of ``widening`` that the file has."""

    file: str
    columns: dict[str, str]
    required: tuple[str, ...] = ()
    ids: tuple[str, ...] = ()
    key: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    widening: tuple[str, ...] = ()
    transforms: dict[str, Callable[[Column], Column]] = field(default_factory=dict)


def _same(*names: str) -> dict[str, str]:
    return {n: n for n in names}


SPECS = {
    "release": TableSpec("release.csv", _same("id", "title", "country", "released", "format", "master_id"), ("id", "title"), ("id",), ("id",), transforms={"format": release_category}),
    "release_artist": TableSpec("release_artist.csv", _same("release_id", "artist_id", "artist_name", "extra", "role"), ("release_id", "artist_name"), ("release_id",), ("release_id", "artist_name", "extra"), ("role",)),
    "release_label": TableSpec("release_label.csv", {"release_id": "release_id", "label_id": "label_id", "label": "label_name", "catno": "catno"}, ("release_id", "label_name"), ("release_id",), ("release_id", "label_name", "catno"), ("label_id",)),
    "release_genre": TableSpec("release_genre.csv", _same("release_id", "genre"), ("release_id", "genre"), ("release_id",), ("release_id", "genre")),
    "release_style": TableSpec("release_style.csv", _same("release_id", "style"), ("release_id", "style"), ("release_id",), ("release_id", "style")),
    "release_track": TableSpec("release_track.csv", _same("release_id", "sequence", "position", "title", "duration"), ("release_id", "sequence", "title"), ("release_id", "sequence"), ("release_id", "sequence")),
    "release_track_artist": TableSpec("release_track_artist.csv", _same("release_id", "track_sequence", "artist_name", "extra", "role"), ("release_id", "track_sequence", "artist_name"), ("release_id", "track_sequence"), ("release_id", "track_sequence", "artist_name"), ("extra", "role"), ("extra", "role")),
    "release_video": TableSpec("release_video.csv", _same("release_id", "sequence", "src", "title", "duration", "embed"), ("release_id", "sequence", "src"), ("release_id", "sequence"), ("release_id", "sequence")),
    "artist_alias": TableSpec("artist_alias.csv", _same("artist_id", "alias_id", "alias_name"), ("artist_id", "alias_name"), ("artist_id",), ("artist_id", "alias_name")),
    "artist_name_variation": TableSpec("artist_name_variation.csv", _same("artist_id", "name"), ("artist_id", "name"), ("artist_id",), ("artist_id", "name")),
    "artist_member": TableSpec("artist_member.csv", _same("artist_id", "member_id", "member_name"), ("artist_id", "member_name"), ("artist_id",), ("artist_id", "member_id", "member_name")),
    "artist_url": TableSpec("artist_url.csv", _same("artist_id", "url"), ("artist_id", "url"), ("artist_id",), ("artist_id", "url")),
    "master": TableSpec("master.csv", _same("id", "title", "main_release_id", "year"), ("id", "title"), ("id",), ("id",)),
    "master_artist": TableSpec("master_artist.csv", _same("master_id", "artist_id", "artist_name"), ("master_id", "artist_name"), ("master_id",), ("master_id", "artist_name")),
}


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, quotes doubled as in RFC 4180, fields over several lines, and the row's place in the file as ``_row_pos``.

    A multi-line file is one partition, so its row ids are in file order.
    """
    raw = spark.read.option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("ignoreLeadingWhiteSpace", False).option("encoding", "UTF-8").csv(path)
    return raw.withColumn("_row_pos", F.monotonically_increasing_id())


def split_csv(spark: SparkSession, path: str) -> DataFrame:
    """The records of a file without its header, one ``record`` text each with its ``_row_pos`` in order, read by as many tasks as the file has splits.

    A line break inside quotes belongs to its field. Each split's quotes are counted first (one row a split reaches the driver), which tells every split
    whether it starts inside a field; only records of several lines are shuffled, to be put together.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_id"))
    odd = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))) % 2
    quoted = lines.withColumn("_odd", odd)
    per = {r["_part"]: r["n"] for r in quoted.groupBy("_part").agg(F.sum("_odd").alias("n")).collect()}  # a row a split
    inside, entry = 0, []
    for part in sorted(per):
        entry.append((part, inside))
        inside = (inside + per[part]) % 2
    known = F.broadcast(spark.createDataFrame(entry or [(0, 0)], "_part int, _inside int"))
    before = Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = quoted.join(known, "_part").withColumn("_open", (F.coalesce(F.sum("_odd").over(before), F.lit(0)) + F.col("_inside")) % 2)
    alone = placed.where("_open = 0 and _odd = 0").select("value", F.col("_id").alias("_row_pos"))
    parts = placed.where("_open = 1 or _odd = 1")
    # A record's lines carry the id of the line it starts on: the latest one before, in its split or, at a split's beginning, in an earlier one.
    starts = parts.where("_open = 0").groupBy("_part").agg(F.max("_id").alias("_last")).collect()  # a row a split
    last, carried = None, []
    by_part = {r["_part"]: r["_last"] for r in starts}
    for part, _ in entry:
        carried.append((part, last))
        last = by_part.get(part, last)
    carry = F.broadcast(spark.createDataFrame(carried or [(0, None)], "_part int, _carried bigint"))
    own = F.max(F.when(F.col("_open") == 0, F.col("_id"))).over(Window.partitionBy("_part").orderBy("_id"))
    grouped = parts.join(carry, "_part").withColumn("_row_pos", F.coalesce(own, "_carried"))
    joined = grouped.groupBy("_row_pos").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_id", "value"))), lambda x: x["value"]), "\n").alias("value"))
    whole = alone.unionByName(joined.select("value", "_row_pos"))
    return whole.select(F.regexp_replace("value", "\r$", "").alias("record"), "_row_pos").where("_row_pos <> 0 and record <> ''")


def read_split_csv(spark: SparkSession, path: str) -> DataFrame:
    """As ``read_csv`` for one file, by many tasks: columns of texts by the file's header, and ``_row_pos``. Records that break the quoting rule or have another
    width go; ``record_parse`` tells why."""
    header = next(csv.reader([spark.read.text(path).first()["value"]]))
    layout = {"file": Layout(tuple(Field(h) for h in header))}
    parsed = parse_records(split_csv(spark, path).withColumn("_file", F.lit("file")), "_row_pos", "record", "_file", layout)
    return parsed.where("reason is null").select(*[F.get("fields", F.lit(i)).alias(h) for i, h in enumerate(header)], "_row_pos")


def key_of(raw: DataFrame, spec: TableSpec) -> list[str]:
    """The columns that tell rows apart: the table's key and the widening columns that the file has."""
    return [*spec.key, *[c for c in spec.widening if c in raw.columns]]


def scan(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """The table's columns: empty text to null, NULs out, transforms applied. A missing mandatory column gives no rows; a missing
    optional one is null. Rows with a null in a required column or a non-integer id go."""
    have = set(raw.columns)
    missing = [c for c in spec.columns if c not in have and c not in spec.optional]
    cells = []
    for source, name in spec.columns.items():
        c = F.nullif(without_nul(F.col(source)), F.lit("")) if source in have else F.lit(None).cast("string")
        cells.append(spec.transforms.get(source, lambda x: x)(c).alias(name))
    position = [F.col("_row_pos")] if "_row_pos" in have else []
    rows = raw.select(*cells, *position)
    if missing:
        return rows.limit(0)
    names = [spec.columns.get(c, c) for c in spec.required]
    rows = rows.dropna(subset=names) if names else rows
    for c in spec.ids:
        rows = rows.where(F.col(c).rlike(r"^\s*[+-]?[0-9]+\s*$") & F.col(c).try_cast("int").isNotNull()).withColumn(c, F.col(c).try_cast("int"))
    return rows


def one_line(c: Column) -> Column:
    """The text without line breaks: line feeds become spaces, carriage returns go."""
    return F.replace(F.translate(c, "\r", ""), F.lit("\n"), F.lit(" "))


def write_fixed_lines(df: DataFrame, path: str) -> None:
    """CSV without line breaks inside fields."""
    flat = df.select(*[one_line(F.col(c).cast("string")).alias(c) for c in df.columns])
    flat.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def swap_in(df: DataFrame, path: str) -> None:
    """Write beside the path, then take its place; readers see the old or the new files, never a mixture. Local paths only."""
    fresh = f"{path}.tmp"
    df.write.mode("overwrite").parquet(fresh)
    old = f"{path}.old"
    if os.path.exists(path):
        os.rename(path, old)
    os.rename(fresh, path)
    if os.path.exists(old):
        import shutil

        shutil.rmtree(old)
