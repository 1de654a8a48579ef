"""Ranked deduplication of editions, with label preferences."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def label_match(credits: DataFrame, labels: DataFrame, prefs: DataFrame, hierarchy: DataFrame | None = None) -> DataFrame:
    """(release_id): releases on a label that the catalog prefers for that artist and title.

    ``credits`` (release_id, artist_name, title), ``labels`` (release_id, label_name), ``prefs`` (artist_name, title, label_name). A sublabel
    and its parent stand for each other: preferences are spread over the edges first, both ways, so one equi-join decides.
    """
    low = lambda c: F.lower(c)
    wanted = prefs.select(low("artist_name").alias("a"), low("title").alias("t"), low("label_name").alias("l")).dropna().distinct()
    if hierarchy is not None:
        edges = hierarchy.select(low("label_name").alias("x"), low("parent_label_name").alias("y")).dropna().distinct()
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y"))).distinct()
        wanted = wanted.unionByName(wanted.join(both, F.col("l") == F.col("x")).select("a", "t", F.col("y").alias("l"))).distinct()
    rows = credits.select("release_id", low("artist_name").alias("a"), low("title").alias("t"))
    named = labels.select(F.col("release_id").alias("_r"), low("label_name").alias("l"))
    return rows.join(named, F.col("release_id") == F.col("_r")).join(wanted, ["a", "t", "l"], "left_semi").select("release_id").distinct()


def ranked(releases: DataFrame, track_counts: DataFrame, matches: DataFrame | None = None, country: str = "US") -> DataFrame:
    """Releases with tracks and a master, with ``rank`` in their (master_id, format): label match, the country, more tracks, least id.

    An unknown country ranks before the preferred one, and a null format is a format of its own, as a database with nulls first
    has it. Releases without tracks are neither ranked nor ever deleted.
    """
    rows = releases.where("master_id is not null").join(track_counts.select(F.col("release_id").alias("_r"), "track_count"), F.col("id") == F.col("_r"))
    if matches is None:
        rows = rows.withColumn("label_match", F.lit(0))
    else:
        rows = rows.join(matches.select(F.col("release_id").alias("_m")), F.col("id") == F.col("_m"), "left").withColumn("label_match", F.when(F.col("_m").isNull(), 0).otherwise(1)).drop("_m")
    order = Window.partitionBy("master_id", "format").orderBy(F.desc("label_match"), F.desc_nulls_first((F.col("country") == country).cast("int")), F.desc("track_count"), F.asc("id"))
    return rows.drop("_r").withColumn("rank", F.row_number().over(order))


def surplus(ranked_rows: DataFrame, keep: DataFrame | None = None) -> DataFrame:
    """(id): releases that a better edition replaces. Ids on the keep list are exempt after ranking, so they don't move their siblings."""
    out = ranked_rows.where("rank > 1").select("id")
    return out if keep is None else out.join(keep.select("id"), "id", "left_anti")


def track_counts(tracks: DataFrame) -> DataFrame:
    """(release_id, track_count) of raw rows; rows whose id isn't an integer don't count."""
    ids = tracks.select(F.col("release_id").try_cast("int").alias("release_id")).where("release_id is not null")
    return ids.groupBy("release_id").agg(F.count("*").alias("track_count"))
