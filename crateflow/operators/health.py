"""Counts that tell whether a build is sound."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.functions.stats import wilson


def tri_state(df: DataFrame, value: str, checked: Column) -> DataFrame:
    """(with_value, never_checked, checked_without) in one pass."""
    has = F.col(value).isNotNull()
    return df.agg(F.count_if(has).alias("with_value"), F.count_if(~has & ~checked).alias("never_checked"), F.count_if(~has & checked).alias("checked_without"))


def coverage(parents: DataFrame, key: str, children: DataFrame, child_key: str, least: float = 0.5) -> DataFrame:
    """(parents, covered, ratio, ok): share of parents with a child; no parents pass."""
    has = children.select(F.col(child_key).alias("_k")).distinct()
    c = parents.select(key).distinct().join(has, F.col(key) == F.col("_k"), "left").agg(F.count("*").alias("parents"), F.count("_k").alias("covered"))
    ratio = F.col("covered") / F.nullif(F.col("parents"), F.lit(0))
    return c.select("parents", "covered", ratio.alias("ratio"), F.coalesce(ratio >= least, F.lit(True)).alias("ok"))


def drift(library: DataFrame, lib_column: str, cache: DataFrame, cache_column: str, least: float = 0.7) -> DataFrame:
    """(library_n, cache_n, ratio, ok): distinct names on either side; without library names the ratio is undefined."""
    rows = library.select(F.lit("l").alias("s"), F.col(lib_column).alias("v")).unionByName(cache.select(F.lit("c").alias("s"), F.col(cache_column).alias("v"))).distinct()
    n = rows.agg(F.count(F.when((F.col("s") == "l"), F.col("v"))).alias("library_n"), F.count(F.when(F.col("s") == "c", F.col("v"))).alias("cache_n"))
    ratio = F.col("cache_n") / F.nullif(F.col("library_n"), F.lit(0))
    return n.select("library_n", "cache_n", ratio.alias("ratio"), (ratio >= least).alias("ok"))


def override_summary(overrides: DataFrame, releases: DataFrame) -> DataFrame:
    """(source, overrides, missing): distinct overridden ids per source, and those that the cache lacks."""
    joined = overrides.join(releases.select(F.col("id").alias("_id")).distinct(), F.col("release_id") == F.col("_id"), "left")
    return joined.groupBy("source").agg(F.count_distinct("release_id").alias("overrides"), F.count_distinct(F.when(F.col("_id").isNull(), F.col("release_id"))).alias("missing"))


def share(df: DataFrame, group: str, hit: Column) -> DataFrame:
    """(group, n, hits, rate, low, high): a rate per group with its Wilson interval."""
    c = df.groupBy(group).agg(F.count("*").alias("n"), F.count_if(hit).alias("hits"))
    w = wilson(F.col("hits").cast("double"), F.col("n").cast("double"))
    return c.select(group, "n", "hits", (F.col("hits") / F.col("n")).alias("rate"), w["low"].alias("low"), w["high"].alias("high"))


def set_summary(flags: DataFrame) -> DataFrame:
    """Counts of the set algebra over (id, keep, override, prune) flags: overlap, gains and losses."""
    both = F.col("keep") & F.col("override")
    return flags.agg(F.count_if("keep").alias("keep"), F.count_if(both).alias("keep_and_override"), F.count_if(F.col("keep") & ~F.col("override")).alias("keep_only"), F.count_if(F.col("prune") & F.col("override")).alias("pruned_overrides"))


def table_sizes(tables: dict[str, DataFrame], deletable: dict[str, DataFrame] | None = None) -> DataFrame:
    """(table_name, n, bytes, deletable): rows, the bytes of the files behind them, and how many of the rows a deletion would take. File sizes come from the files'
    own metadata; a table that isn't read from files has none."""
    out = None
    for name, t in tables.items():
        rows = t.agg(F.count("*").alias("n"))
        try:
            files = t.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("s")).distinct().agg(F.sum("s").alias("bytes"))
        except AnalysisException:
            files = t.sparkSession.createDataFrame([(None,)], "bytes bigint")
        gone = (deletable or {}).get(name)
        lost = t.sparkSession.createDataFrame([(0,)], "deletable bigint") if gone is None else gone.agg(F.count("*").alias("deletable"))
        row = rows.join(F.broadcast(files)).join(F.broadcast(lost)).select(F.lit(name).alias("table_name"), "n", F.coalesce("bytes", F.lit(0)).alias("bytes"), "deletable")  # one row each
        out = row if out is None else out.unionByName(row)
    return out


def override_verdict(summary: DataFrame) -> DataFrame:
    """(sources, missing, ok): whether no source of overrides lacks a release; no sources pass."""
    return summary.agg(F.count("*").alias("sources"), F.coalesce(F.sum("missing"), F.lit(0)).alias("missing"), F.coalesce(F.bool_and(F.col("missing") == 0), F.lit(True)).alias("ok"))


def tally(df: DataFrame, column: str, unnamed: str = "(unlabelled)") -> DataFrame:
    """(column, n): how many rows have each value, null and empty as ``unnamed``; values needn't be known before."""
    return df.groupBy(F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(unnamed)).alias(column)).agg(F.count("*").alias("n"))
