"""All pairs of the rows that share a form, hot forms split over tasks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.session import cut_lineage

#: Rows of one form that meet in one cell; a form of more is cut into parts, each two of which are a cell of their own.
CELL = 2_000


def pairs_of_forms(rows: DataFrame, item: str, carried: list[str] | None = None, kept: Column | None = None, wanted: Column | None = None, cell: int = CELL) -> DataFrame:
    """(a, b, n), a < b: every distinct pair of items with a form (column ``form``) in common, none left out however many share it, and
    how many items the rarest form has that they share.

    ``carried`` columns are at hand for ``kept``, a condition on pairs of them as ``x.`` and ``y.``; ``wanted`` is an aggregate over a form's rows
    without which none of its pairs is kept.
    """
    carried = carried or []
    counts = rows.groupBy("form").agg(F.count("*").alias("_n"), (F.lit(True) if wanted is None else wanted).alias("_w")).where("_n > 1 and _w").select("form", "_n")
    parts = F.ceil(F.col("_n") / cell).cast("int")
    shared = cut_lineage(rows.join(counts, "form").select("form", "_n", item, *carried, parts.alias("_parts"), F.pmod(F.xxhash64(F.col(item), F.lit(7)), F.ceil(F.col("_n") / cell)).cast("int").alias("_part")))
    # A row is in the cells of its part with each part; a pair meets in the cell of its two parts only.
    other = F.explode(F.sequence(F.lit(0), F.col("_parts") - 1))
    cells = shared.select("*", other.alias("_other")).withColumn("_low", F.least("_part", "_other")).withColumn("_high", F.greatest("_part", "_other"))
    x, y = cells.alias("x"), cells.alias("y")
    same = (F.col("x.form") == F.col("y.form")) & (F.col("x._low") == F.col("y._low")) & (F.col("x._high") == F.col("y._high")) & (F.col(f"x.{item}") < F.col(f"y.{item}"))
    met = x.join(y, same & kept if kept is not None else same)
    return met.groupBy(F.col(f"x.{item}").alias("a"), F.col(f"y.{item}").alias("b")).agg(F.min("x._n").alias("n"))
