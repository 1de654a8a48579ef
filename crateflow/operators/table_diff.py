"""Field-by-field difference of two copies of a table."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Keys that one cogrouped bucket should hold.
BUCKET_ROWS = 200_000


def _one_row_per_key(df: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Fold repeated keys into one row before anything is gathered, with constant state per key.

    A key that occurs once keeps its values. For a repeated key each field's text becomes a digest of the multiset of
    its values (count, count of nulls, extremes and two sums of hashes), so two copies agree on it iff they hold the same values
    equally often, up to a collision of 128 bits of hash.
    """
    n = F.count(F.lit(1))

    def value(c: str) -> Column:
        text = F.col(c).cast("string")
        sums = [F.sum(F.coalesce(F.xxhash64(F.lit(seed), text), F.lit(0)).cast("decimal(20,0)")) for seed in (1, 2)]
        parts = [n, F.count(text), F.coalesce(F.min(text), F.lit("")), F.coalesce(F.max(text), F.lit("")), *sums]
        return F.when(n == 1, F.max(text)).otherwise(F.concat_ws("\u0000", *[p.cast("string") for p in parts]))

    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_key")).agg(n.alias("_n"), *[value(c).alias(f"_f{i}") for i, c in enumerate(fields)])


def _diff_bucket(left: pa.Table, right: pa.Table, fields: list[str]) -> pa.Table:
    a, b = left.sort_by("_key"), right.sort_by("_key")
    ka, kb = a.column("_key").to_numpy(zero_copy_only=False), b.column("_key").to_numpy(zero_copy_only=False)
    at = np.searchsorted(kb, ka)
    safe = np.minimum(at, max(len(kb) - 1, 0))
    both = (kb[safe] == ka) & (at < len(kb)) if len(kb) else np.zeros(len(ka), dtype=bool)
    seen = np.zeros(len(kb), dtype=bool)
    seen[at[both]] = True
    keys = [a.column("_key").filter(pa.array(~both)), b.column("_key").filter(pa.array(~seen))]
    kinds = [pa.repeat("only_left", int((~both).sum())), pa.repeat("only_right", int((~seen).sum()))]
    nones = [pa.nulls(len(k), pa.string()) for k in keys]
    va, vb = list(nones), list(nones)
    l, r = a.filter(pa.array(both)), b.take(pa.array(at[both]))
    repeated = pc.not_equal(l.column("_n"), r.column("_n"))
    for i, name in enumerate(fields):
        x, y = l.column(f"_f{i}"), r.column(f"_f{i}")
        differs = pc.or_(pc.fill_null(pc.not_equal(x, y), False), pc.xor(pc.is_null(x), pc.is_null(y)))
        differs = pc.or_(differs, repeated)
        keys.append(l.column("_key").filter(differs))
        kinds.append(pa.repeat(name, len(keys[-1])))
        va.append(x.filter(differs))
        vb.append(y.filter(differs))
    flat = lambda xs, t: pa.chunked_array([c for x in xs for c in (x.chunks if isinstance(x, pa.ChunkedArray) else [x])], t)
    return pa.table({"_key": flat(keys, left.schema.field("_key").type), "diff": flat(kinds, pa.string()), "left_value": flat(va, pa.string()), "right_value": flat(vb, pa.string())})


def table_diff(left: DataFrame, right: DataFrame, key: str, fields: list[str], bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Rows (key, diff, left_value, right_value): what two copies of one table disagree on.

    ``diff`` is ``only_left`` or ``only_right`` for a key on one side only, else the name of a field whose two values are not the
    same text (null equals null only). Values are compared as text. Rows with a null key are ignored. A repeated key is
    compared as the multiset of its values, field by field, and differs in every field if the two sides hold it unequally
    often; its values come out as digests. Empty tables are fine; columns other than ``key`` and ``fields`` are not read.

    Repeated keys are folded first with map-side combining, so a hot key never reaches one task. Each side is then
    hashed into buckets of about ``bucket_rows`` keys that are cogrouped as Arrow tables.
    """
    a, b = (_one_row_per_key(x, key, fields) for x in (left, right))
    rows = max(left.count(), right.count())  # of files from their footers; a derived table is worked out once more for it
    buckets = max(1, -(-rows // bucket_rows), int(left.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    by = F.pmod(F.xxhash64("_key"), F.lit(buckets)).cast("int")
    a, b = a.withColumn("_bucket", by), b.withColumn("_bucket", by)
    kind = dict(left.dtypes)[key]
    out = a.groupBy("_bucket").cogroup(b.groupBy("_bucket")).applyInArrow(
        functools.partial(_diff_bucket, fields=fields), f"_key {kind}, diff string, left_value string, right_value string"
    )
    return out.withColumnRenamed("_key", key)
