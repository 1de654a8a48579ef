"""Line formats: database batch output, COPY text, id lists, newline JSON and id-class dumps."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

def unescape(c: Column) -> Column:
    """Backslash escapes for backslash, tab, line feed and NUL, read left to right, each in one sense: the text is split at escaped backslashes, which
    are put back once the other escapes are undone."""
    out = F.transform(F.split(c, "\\\\\\\\"), _undone)
    return F.array_join(out, "\\")


def _undone(part: Column) -> Column:
    for sign, real in (("\\t", "\t"), ("\\n", "\n"), ("\\0", "\u0000")):
        part = F.replace(part, F.lit(sign), F.lit(real))
    return part


def escape(c: Column) -> Column:
    """COPY text of a field: null and empty as backslash-N, backslash, tab and line feed escaped, carriage returns out."""
    out = F.replace(F.translate(c, "\r", ""), F.lit("\\"), F.lit("\\\\"))
    out = F.replace(F.replace(out, F.lit("\t"), F.lit("\\t")), F.lit("\n"), F.lit("\\n"))
    return F.when(c.isNull() | (c == ""), F.lit("\\N")).otherwise(out)


def parse_tsv(lines: DataFrame, columns: list[str], int_columns: tuple[str, ...] = ()) -> DataFrame:
    """Rows of a ``value`` column of tab-separated lines. Lines of another width go, as do rows whose integers don't parse;
    a field of backslash-N is null, which is tested before escapes are undone."""
    cut = lines.select(F.split("value", "\t").alias("f")).where(F.size("f") == len(columns))
    cells = []
    for i, name in enumerate(columns):
        field = F.col("f")[i]
        value = F.when(field != "\\N", unescape(field))
        cells.append((value.try_cast("int") if name in int_columns else value).alias(name))
    return cut.select(*cells).dropna(subset=list(int_columns)) if int_columns else cut.select(*cells)


def read_tsv(spark: SparkSession, path: str, columns: list[str], int_columns: tuple[str, ...] = ()) -> DataFrame:
    return parse_tsv(spark.read.option("lineSep", "\n").text(path), columns, int_columns)


def write_copy_text(df: DataFrame, path: str) -> None:
    df.select(F.concat_ws("\t", *[escape(F.col(c).cast("string")) for c in df.columns]).alias("value")).write.mode("overwrite").text(path)


def read_id_list(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ``id``s of a list; blank lines and those that start with # don't count."""
    lines = spark.read.text(path).select(F.trim("value").alias("v")).where("v <> '' and not startswith(v, '#')")
    return lines.select(F.col("v").try_cast("bigint").alias("id")).where("id is not null").distinct()


def read_ndjson(spark: SparkSession, path: str, schema: str, required: list[str]) -> DataFrame:
    """Newline JSON under a schema. A line of another shape fails the read; so does a null in a required field."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    checks = [F.when(F.col(c).isNull(), F.raise_error(F.lit(f"{c} is missing"))).otherwise(F.col(c)).alias(c) if c in required else F.col(c) for c in rows.columns]
    return rows.select(*checks)


def write_classes(classes: DataFrame, path: str) -> None:
    """A sorted id file per class, and the counts, for a table (id, class)."""
    for name in ("keep", "review", "prune"):
        classes.where(F.col("class") == name).select("id").distinct().orderBy("id").select(F.col("id").cast("string")).write.mode("overwrite").text(f"{path}/{name}")
    classes.groupBy("class").agg(F.count_distinct("id").alias("n")).coalesce(1).write.mode("overwrite").json(f"{path}/counts")


def load_mapping(spark: SparkSession, path: str) -> DataFrame:
    """(artist, decision) of a JSON file {"keep": {...}, "prune": {...}}; a small file, read on the driver."""
    with open(path, encoding="utf-8") as f:
        known: Mapping[str, dict] = json.load(f)
    rows = [(name, decision) for decision in ("keep", "prune") for name in known.get(decision, {})]
    return spark.createDataFrame(rows, "artist string, decision string")


def sql_values(df: DataFrame) -> DataFrame:
    """Each row as a parenthesised SQL tuple of quoted text, nulls as NULL."""
    cells = [F.coalesce(F.concat(F.lit("'"), F.replace(F.col(c).cast("string"), F.lit("'"), F.lit("''")), F.lit("'")), F.lit("NULL")) for c in df.columns]
    return df.select(F.concat(F.lit("("), F.concat_ws(", ", *cells), F.lit(")")).alias("value"))
