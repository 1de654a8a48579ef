"""Table transforms of the build: first-wins loading, membership filters, upserts, seeds and derived tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_wins(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; null key parts are equal. Kept to one row per task before the shuffle."""
    rank = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(rank)).where("_rank = 1").drop("_rank")


def keep_ids(df: DataFrame, column: str, ids: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows whose column is among the ids."""
    return df.join(ids.select(F.col(id_column).alias("_id")).distinct(), F.col(column) == F.col("_id"), "left_semi")


def drop_ids(df: DataFrame, column: str, ids: DataFrame, id_column: str = "id") -> DataFrame:
    """Rows whose column isn't among the ids; nulls in either stay out of the comparison, and such rows stay."""
    return df.join(ids.select(F.col(id_column).alias("_id")).where("_id is not null").distinct(), F.col(column) == F.col("_id"), "left_anti")


def orphans(children: DataFrame, column: str, parents: DataFrame, id_column: str = "id") -> DataFrame:
    """Child rows without a parent."""
    return drop_ids(children, column, parents, id_column)


class EmptySourceError(ValueError):
    """A step that would delete everything was given nothing."""


def upsert(live: DataFrame, staged: DataFrame, key: str, updated: list[str], guard: bool = True) -> DataFrame:
    """The live table after taking in a full snapshot: staged rows win in the ``updated`` columns, the live row's other columns
    stay, rows absent from the snapshot go. With the guard an empty snapshot is refused. One join, since what isn't staged goes."""
    if guard and staged.isEmpty():
        raise EmptySourceError("the snapshot has no rows")
    kept = [c for c in live.columns if c != key and c not in updated]
    old = live.select(F.col(key).alias("_key"), *kept)
    new = staged.select(key, *updated)
    return new.join(old, F.col(key) == F.col("_key"), "left").select(*[c if c == key or c in updated or c in kept else F.lit(None).alias(c) for c in live.columns])


def insert_absent(live: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The live table and those new rows whose key it hasn't."""
    fresh = new.join(live.select(F.col(key).alias("_key")), F.col(key) == F.col("_key"), "left_anti")
    return live.unionByName(fresh, allowMissingColumns=True)


def update_from(df: DataFrame, values: DataFrame, key: str, column: str) -> DataFrame:
    """The column replaced where ``values`` (key, column) has a value."""
    v = values.select(F.col(key).alias("_key"), F.col(column).alias("_new"))
    return df.join(v, F.col(key) == F.col("_key"), "left").withColumn(column, F.coalesce("_new", column)).drop("_key", "_new")


def first_image(images: DataFrame) -> DataFrame:
    """(release_id, uri): the first primary image with an address, else the first with one, by ``pos``."""
    given = images.where("uri is not null and uri <> ''")
    rank = F.struct((F.coalesce(F.col("type"), F.lit("")) != "primary").alias("later"), "pos")
    return given.groupBy("release_id").agg(F.min_by("uri", rank).alias("uri"))


def last_value(df: DataFrame, key: str, column: str, order: str) -> DataFrame:
    """(key, column): the last non-null value in order."""
    return df.where(F.col(column).isNotNull()).groupBy(key).agg(F.max_by(column, order).alias(column))


def seed(live: dict[str, DataFrame], source: dict[str, DataFrame], parent: str, parent_key: str, child_key: str, ids: DataFrame) -> dict[str, DataFrame]:
    """Additive copy of a family of tables for the ids that the live parent lacks: parents first, children only of the new ones.
    Only columns that both sides have are copied."""
    new = drop_ids(ids, "id", live[parent], parent_key).distinct()
    new = keep_ids(source[parent], parent_key, new).select(F.col(parent_key).alias("id"))
    out = {}
    for name, table in live.items():
        shared = [c for c in table.columns if c in source[name].columns]
        rows = keep_ids(source[name], parent_key if name == parent else child_key, new).select(*shared)
        out[name] = table.unionByName(rows, allowMissingColumns=True)
    return out


class FloorError(ValueError):
    """A derived table came out too small to replace the old one."""


def floor_guard(new: DataFrame, floor: int, before: int) -> DataFrame:
    """The derived table, unless it has fewer rows than the floor while the old one had some."""
    n = new.count()
    if before > 0 and n < floor:
        raise FloorError(f"{n} rows, at least {floor} are needed")
    return new


def shortfall(copied: DataFrame, expected: DataFrame, column: str = "id") -> DataFrame:
    """Expected ids that the copy lacks."""
    return expected.join(copied.select(F.col(column).alias("_id")), F.col(column) == F.col("_id"), "left_anti").select(column).distinct()


def compilations(releases: DataFrame, credits: DataFrame) -> DataFrame:
    """(id, title, norm_title) of the releases whose main credit is the compilation artist."""
    from crateflow.functions.normalize import is_various

    various = credits.where((F.col("extra") == 0) & is_various(F.col("artist_id"), F.col("artist_name"))).select("release_id").distinct()
    return releases.join(various, F.col("id") == F.col("release_id"), "left_semi").select("id", "title", F.lower("title").alias("norm_title"))


def precedence(classes: DataFrame) -> DataFrame:
    """(id, class): keep over review over prune where an id came out in several."""
    rank = F.when(F.col("class") == "keep", 3).when(F.col("class") == "review", 2).otherwise(1)
    top = classes.groupBy("id").agg(F.max(rank).alias("r"))
    return top.select("id", F.element_at(F.array(F.lit("prune"), F.lit("review"), F.lit("keep")), F.col("r")).alias("class"))


def override(classes: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, class) with the given ids kept, also those without a class."""
    forced = ids.select("id").distinct().withColumn("_forced", F.lit(True))
    return classes.join(forced, "id", "full").select("id", F.when(F.col("_forced"), "keep").otherwise(F.col("class")).alias("class"))


def hash_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows in the order of a seeded hash of the key: a sample that doesn't depend on partitions."""
    return df.orderBy(F.xxhash64(F.lit(seed), F.col(key)), key).limit(n)


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, n) of each table."""
    parts = [t.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n") for name, t in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
