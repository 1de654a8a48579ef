"""The best record of each group of duplicates, whole or built field by field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Data quality from worst to best; a null or unlisted one ranks below all.
QUALITY = ("Needs Major Changes", "Needs Minor Changes", "Needs Vote", "Correct", "Complete and Correct")


def present(c: Column) -> Column:
    """True if the value counts as given: not null and not the placeholder ``Unknown``."""
    return F.coalesce(c != "Unknown", F.lit(False))


def quality_rank(c: Column) -> Column:
    """0 for null or unlisted, then 1.. from worst to best."""
    rank = F.lit(0)
    for i, q in enumerate(QUALITY, 1):
        rank = F.when(c == q, i).otherwise(rank)
    return rank


def with_profile(records: DataFrame, children: DataFrame, record_id: str, child_id: str, child_value: str, fields: list[str], quality: str) -> DataFrame:
    """Adds ``_has`` (a bit per field that is given, the last for a child row with a given value), ``_complete`` (their
    number) and ``_quality``. The children are reduced to distinct ids before the join."""
    ids = children.where(present(F.col(child_value))).select(F.col(child_id).alias("_id")).distinct().withColumn("_child", F.lit(1))
    bits = F.lit(0)
    for i, f in enumerate(fields):
        bits = bits + F.when(present(F.col(f)), 1 << i).otherwise(0)
    joined = records.join(ids, F.col(record_id) == F.col("_id"), "left")
    has = bits + F.coalesce("_child", F.lit(0)) * (1 << len(fields))
    return joined.withColumn("_has", has).withColumn("_complete", F.bit_count("_has")).withColumn("_quality", quality_rank(F.col(quality))).drop("_id", "_child")


def _grouped(profiled: DataFrame, keys: list[str]) -> tuple[DataFrame, list[str]]:
    """Keys as text that is never null, so that equal groups hash alike in every later step."""
    safe = [f"_k{i}" for i, _ in enumerate(keys)]
    return profiled.withColumns({s: F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("-")) for s, k in zip(safe, keys)}), safe


def _top(rows: DataFrame, safe: list[str], record_id: str, stamp: str) -> DataFrame:
    # row_number() = 1 is all that this window computes, so Spark keeps the first row of each group in every map task and
    # shuffles only those: a group of any size reaches the final window as one row per task.
    order = Window.partitionBy(*safe).orderBy(F.desc("_complete"), F.desc("_quality"), F.desc_nulls_last(stamp), F.asc(record_id))
    return rows.withColumn("_rank", F.row_number().over(order)).where("_rank = 1").drop("_rank")


def top_ranked(profiled: DataFrame, keys: list[str], record_id: str, stamp: str) -> DataFrame:
    """The top record of each group by completeness, trust, recency and least id. Null keys form a group of their own."""
    rows, safe = _grouped(profiled, keys)
    return _top(rows, safe, record_id, stamp).drop(*safe)


def dominant(profiled: DataFrame, keys: list[str], record_id: str, stamp: str) -> DataFrame:
    """(keys, record_id): in each group of two or more records the one that is best in every respect, where there is one.

    It has every field that another member has, a quality at least as good as each other's and a later stamp than all of
    theirs; a record without a stamp is never later. Such a record is most complete, of best quality and latest, hence the
    window's top record, which is held against the group's bounds: one aggregate of constant state, combined before the
    shuffle and hashed like the window. Repeated rows of one record count once; records with equal latest stamps leave
    the group without a winner.
    """
    rows, safe = _grouped(profiled, keys)
    rows = rows.select(*safe, *keys, F.col(record_id).alias("_id"), F.col(stamp).alias("_stamp"), "_has", "_complete", "_quality")
    bounds = rows.groupBy(*safe).agg(
        (F.min("_id") != F.max("_id")).alias("_several"), F.bit_or("_has").alias("_any"), F.max("_quality").alias("_best"),
        # Equal ids in both: one record alone holds the latest stamp.
        F.max(F.struct("_stamp", "_id")).alias("_last"), F.max(F.struct("_stamp", (-F.col("_id").cast("bigint")).alias("i"))).alias("_last2"),
    )
    best = (F.col("_has") == F.col("_any")) & (F.col("_quality") == F.col("_best")) & (F.col("_id") == F.col("_last._id")) & (F.col("_id") == -F.col("_last2.i"))
    found = _top(rows, safe, "_id", "_stamp").join(bounds, safe).where(F.col("_several") & best & F.col("_stamp").isNotNull())
    return found.select(*keys, F.col("_id").alias(record_id))


def merged(profiled: DataFrame, keys: list[str], record_id: str, stamp: str, fields: list[str]) -> DataFrame:
    """One record built per group: each field's given value from the record of best quality, latest stamp and least id;
    null where no record gives one. ``members`` counts the group's rows. One aggregate, combined before the shuffle."""
    rows, safe = _grouped(profiled, keys)
    trust = F.struct("_quality", F.col(stamp).alias("s"), (-F.col(record_id).cast("bigint")).alias("i"))
    cells = [F.max_by(f, F.when(present(F.col(f)), trust)).alias(f) for f in fields]
    out = rows.groupBy(*safe).agg(*[F.first(k).alias(k) for k in keys], *cells, F.count("*").alias("members"))
    return out.drop(*safe)
