"""Loads of dependent tables: stubs, guarded reloads, copies of table families, the normalized library and lists kept for later steps."""

from __future__ import annotations

import random
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.functions.identity import identity_form
from crateflow.functions.normalize import without_nul
from crateflow.operators.tables import EmptySourceError, drop_ids, keep_ids

#: Systems that a snapshot of the library may come from.
SNAPSHOT_SOURCES = ("backend", "legacy", "llm")


def stub_artists(artists: DataFrame, credits: DataFrame) -> DataFrame:
    """The artists (id, name, not_found, ...) with a row for each credited id: new ones by the least credited name, ones marked as not found no longer so."""
    stubs = credits.where("artist_id is not null").groupBy(F.col("artist_id").alias("_id")).agg(F.min("artist_name").alias("_name"))
    both = artists.withColumn("_old", F.lit(True)).join(stubs, F.col("id") == F.col("_id"), "full")
    cells = {"id": F.coalesce("id", "_id"), "name": F.when(F.col("_old"), F.col("name")).otherwise(F.col("_name")), "not_found": F.when(F.col("_id").isNotNull(), False).otherwise(F.col("not_found"))}
    return both.select(*[cells.get(c, F.col(c)).alias(c) for c in artists.columns])


def guarded_reload(old: DataFrame, new: DataFrame | None, scope: DataFrame, key: str) -> DataFrame:
    """The table reloaded from ``new``, rows in scope (id) only; as it was where there's nothing to load from or the scope is empty."""
    wanted = scope.where("id is not null")
    if new is None or wanted.isEmpty():
        return old
    return keep_ids(new, key, wanted).select(*old.columns)


def reload_masters(masters: DataFrame, credits: DataFrame, new_masters: DataFrame | None, new_credits: DataFrame, releases: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(masters, their credits) reloaded for the masters that releases refer to; credits follow the masters that came in."""
    scope = releases.select(F.col("master_id").alias("id")).where("id is not null").distinct()
    if new_masters is None or scope.isEmpty():
        return masters, credits
    loaded = keep_ids(new_masters, "id", scope)
    return loaded, keep_ids(new_credits, "master_id", loaded)


def truncation(tables: Iterable[str]) -> list[str]:
    """The names of tables that a reload may empty. A name with a schema is refused: such tables belong to another system."""
    names = list(tables)
    for name in names:
        if "." in name:
            raise ValueError(f"{name} is in a schema of its own and must not be emptied")
    return names


class ShortfallError(ValueError):
    """A copy lacks rows that it should have."""


def checked_copy(copied: DataFrame, expected: DataFrame, column: str = "id", most: int = 20) -> DataFrame:
    """The copy, if it has exactly as many ids as are expected; else an error that names the first missing ones."""
    n, want = copied.select(column).distinct().count(), expected.select(column).distinct().count()
    if n != want:
        missing = [r[0] for r in missing_sample(copied, expected, column, most).collect()]
        raise ShortfallError(f"{n} of {want} ids were copied; missing: {missing}")
    return copied


def missing_sample(copied: DataFrame, expected: DataFrame, column: str = "id", most: int = 20) -> DataFrame:
    """The least expected ids that the copy lacks."""
    return drop_ids(expected.select(column).distinct(), column, copied, column).orderBy(column).limit(most)


def copy_family(tables: dict[str, tuple[DataFrame, str]], ids: DataFrame) -> dict[str, DataFrame]:
    """Each table (with its id column) cut to the rows of the ids; each is one semi join that the caller may write on its own."""
    return {name: keep_ids(table, column, ids) for name, (table, column) in tables.items()}


def load_family(raw: dict[str, DataFrame], parent: str, parent_key: str, child_key: str) -> dict[str, DataFrame]:
    """Parents first, then the children whose parent came in."""
    return {name: t if name == parent else keep_ids(t, child_key, raw[parent], parent_key) for name, t in raw.items()}


def restamp(metadata: DataFrame, ids: DataFrame, now: Column) -> DataFrame:
    """Cache metadata (release_id, cached_at, source) with a fresh stamp for new ids; rows that it has keep theirs."""
    fresh = drop_ids(ids.select("id").distinct(), "id", metadata, "release_id")
    return metadata.unionByName(fresh.select(F.col("id").alias("release_id"), now.alias("cached_at"), F.lit("bulk_import").alias("source")), allowMissingColumns=True)


def pending(df: DataFrame, value: str, checked: str, n: int, key: str = "id") -> DataFrame:
    """(key): the first n rows without a value that were never asked about."""
    return df.where(F.col(value).isNull() & F.col(checked).isNull()).select(key).orderBy(key).limit(n)


def stamp_results(df: DataFrame, results: DataFrame, key: str, value: str, checked: str, now: Column) -> DataFrame:
    """The rows with what was asked (key, value): the value as found, null for none, and the time; others as they were."""
    r = results.select(F.col(key).alias("_key"), F.col(value).alias("_value"), F.lit(True).alias("_asked"))
    joined = df.join(r, F.col(key) == F.col("_key"), "left")
    cells = {value: F.when(F.col("_asked"), F.col("_value")).otherwise(F.col(value)), checked: F.when(F.col("_asked"), now).otherwise(F.col(checked))}
    return joined.select(*[cells.get(c, F.col(c)).alias(c) for c in df.columns])


def normalized_library(rows: DataFrame, source: str, now: Column) -> DataFrame:
    """Library rows (library_id, artist_name, album_title, label_name, ...) with NULs out of their texts, comparison forms, and the snapshot's time and source."""
    if source not in SNAPSHOT_SOURCES:
        raise ValueError(f"{source} is none of {SNAPSHOT_SOURCES}")
    texts = [without_nul(F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in rows.dtypes]
    forms = {"norm_artist": "artist_name", "norm_title": "album_title", "norm_label": "label_name"}
    return rows.select(*texts, *[identity_form(F.col(c)).alias(n) for n, c in forms.items()], now.alias("snapshot_at"), F.lit(source).alias("snapshot_source"))


def keep_list(overrides: DataFrame | None, column: str, like: DataFrame) -> DataFrame:
    """(id): the distinct overridden ids, none where there's no such table; ``like`` lends the id's type."""
    if overrides is None:
        return like.select(F.col(like.columns[0]).alias("id")).limit(0)
    return overrides.where(F.col(column).isNotNull()).select(F.col(column).alias("id")).distinct()


def library_container(rows: DataFrame, tracks: DataFrame) -> dict[str, DataFrame]:
    """The library with its word index, and the compilation tracks only if there are any. Rows without an id are refused."""
    from crateflow.operators.search import inverted_index

    if rows.where("id is null").limit(1).count():
        raise EmptySourceError("a library row has no id")
    out = {"library": rows, "library_words": inverted_index(rows, "id", ["title", "artist", "alternate_artist_name", "album_artist"])}
    return out if tracks.isEmpty() else out | {"compilation_track_artist": tracks}


def random_sample(ids: DataFrame, n: int, seed: int, column: str = "id") -> DataFrame:
    """(id): n ids drawn by the Mersenne twister over the ids in order, all of them if there are no more.

    The draw needs only how many ids there are; the ids are numbered on the cluster, and only those drawn are kept.
    """
    spark = ids.sparkSession
    distinct = ids.select(F.col(column).alias("id")).where("id is not null").distinct()
    total = distinct.count()
    if total <= n:
        return distinct
    drawn = spark.createDataFrame([(i,) for i in sorted(random.Random(seed).sample(range(total), n))], "_place bigint")
    return ranked(distinct, "id").join(F.broadcast(drawn), "_place", "left_semi").select("id")  # n rows


def ranked(df: DataFrame, column: str) -> DataFrame:
    """The rows with ``_place``, their place from 0 in the order of a distinct column. Sorted over all partitions; each adds the counts of those before it."""
    ordered = df.orderBy(column).withColumn("_part", F.spark_partition_id())
    from crateflow.session import cut_lineage

    ordered = cut_lineage(ordered)
    sizes = {r["_part"]: r["n"] for r in ordered.groupBy("_part").agg(F.count("*").alias("n")).collect()}  # a row a partition
    before, total = [], 0
    for part in sorted(sizes):
        before.append((part, total))
        total += sizes[part]
    from pyspark.sql import Window

    start = df.sparkSession.createDataFrame(before, "_part int, _before bigint")
    within = F.row_number().over(Window.partitionBy("_part").orderBy(column)) - 1
    return ordered.withColumn("_in", within).join(F.broadcast(start), "_part").withColumn("_place", F.col("_in") + F.col("_before")).drop("_part", "_in", "_before")


def least_row(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row per key: the one with the least text in ``order``, null as empty; ties by the row's other values."""
    rest = [c for c in df.columns if c not in (key, order)]
    best = df.groupBy(key).agg(F.min(F.struct(F.coalesce(F.col(order), F.lit("")).alias("_o"), F.col(order).alias("_v"), *rest)).alias("_m"))
    return best.select(key, F.col("_m._v").alias(order), *[F.col(f"_m.{c}").alias(c) for c in rest])
