"""Load delimited records, setting aside those that fail with the reason and the offset."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.functions.fsm import tokenize

#: Bytes of records that are tokenized at once; the machine holds about 50 times as many.
SLICE_BYTES = 4_000_000


@dataclass(frozen=True)
class Field:
    """A column of a record layout. kind: text, int32, int32_or_empty, title, partial_date or duration."""

    name: str
    kind: str = "text"


@dataclass(frozen=True)
class Layout:
    """The columns of one kind of file."""

    fields: tuple[Field, ...]


LAYOUTS = {
    "release.csv": Layout(
        (
            Field("id", "int32"), Field("status"), Field("title", "title"), Field("country"), Field("released", "partial_date"),
            Field("notes"), Field("data_quality"), Field("master_id", "int32_or_empty"), Field("format"),
        )
    ),
    "release_track.csv": Layout(
        (Field("release_id", "int32"), Field("sequence", "int32"), Field("position"), Field("title", "title"), Field("duration", "duration"))
    ),
}


def _int32(c: Column) -> Column:
    return F.coalesce(c.rlike(r"^[+-]?[0-9]+$") & F.expr("true") & _as_int(c).isNotNull(), F.lit(False))


def _as_int(c: Column) -> Column:
    return F.when(c.rlike(r"^[+-]?[0-9]+$"), c).try_cast("int")


def _valid(kind: str, c: Column) -> Column:
    if kind == "int32":
        return _int32(c)
    if kind == "int32_or_empty":
        return (c == "") | _int32(c)
    if kind == "title":
        return c != ""
    if kind == "partial_date":
        full = c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$") & (
            c.endswith("-00-00")
            | (c.endswith("-00") & c.substr(6, 2).between("01", "12"))
            | F.when(c.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), c).try_cast("date").isNotNull()
        )
        month = c.rlike(r"^[0-9]{4}-(0[1-9]|1[0-2])$")
        return c.isin("", "Unknown") | c.rlike(r"^[0-9]{4}$") | month | full
    if kind == "duration":
        return (c == "") | c.rlike(r"^[0-9]+:[0-5][0-9]$") | c.rlike(r"^[0-9]+:[0-5][0-9]:[0-5][0-9]$")
    return F.lit(True)


def _slices(batch: pa.RecordBatch, record: str, most: int) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``most`` bytes of records, or of one record."""
    lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(record))), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths.astype(np.int64) + 1)
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + most, "right")))
        yield batch.slice(first, last - first)
        first = last


def _tokenized(batches: Iterator[pa.RecordBatch], key: str, record: str, group: str) -> Iterator[pa.RecordBatch]:
    for batch in (s for b in batches for s in _slices(b, record, SLICE_BYTES)):
        raw = batch.column(batch.schema.get_field_index(record))
        raw = raw.cast(pa.large_string()).fill_null("")
        n = len(raw)
        if n == 0:
            continue
        _, offsets, data = raw.buffers()
        ends = np.frombuffer(offsets, dtype=np.int64)[raw.offset : raw.offset + n + 1]
        buffer = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
        bad_at, n_fields, lo, hi = tokenize(buffer, ends[:-1], ends[1:])
        # A quoted field loses its outer quotes here; doubled quotes are undone in the JVM, only where a quote occurs.
        quoted = np.zeros(len(lo), dtype=bool)
        some = hi > lo
        quoted[some] = buffer[lo[some]] == ord('"')
        lo, hi = lo + quoted, hi - quoted
        size = hi - lo
        out_offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        index = np.arange(int(out_offsets[-1])) - np.repeat(out_offsets[:-1] - lo, size)
        text = pa.LargeStringArray.from_buffers(len(lo), pa.py_buffer(out_offsets.tobytes()), pa.py_buffer(buffer[index].tobytes()))
        lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n_fields)]).astype(np.int32)), text.cast(pa.string()))
        yield pa.RecordBatch.from_arrays(
            [batch.column(batch.schema.get_field_index(key)), batch.column(batch.schema.get_field_index(group)), pa.array(bad_at), lists],
            names=["_key", "_group", "_bad_at", "_fields"],
        )


def parse_records(df: DataFrame, key: str, record: str, group: str, layouts: dict[str, Layout] = LAYOUTS) -> DataFrame:
    """One row per record: (key, group, fields, reason, error_at, error_field).

    ``fields`` holds the unquoted values of a record that keeps the quoting rule. ``reason`` is the first
    that applies of ``quoting`` (``error_at``: byte offset of the break, or the record's length when a quote is left
    open), ``columns`` (``error_at``: the number of fields found) and ``value`` (``error_at``: index of the first bad
    field, ``error_field`` its name); null for a loadable record. A null record counts as an empty one, which has one
    field; a record of a group without a layout fails with ``columns``. Repeated rows stay as they are; columns
    other than the three named ones are not carried, so they cannot clash. No shuffle: the scan's partitions
    go through one Arrow pass, in slices of bounded size.
    """
    kind = dict(df.dtypes)[key]
    schema = f"_key {kind}, _group string, _bad_at bigint, _fields array<string>"
    rows = df.select(F.col(key), F.col(group).cast("string").alias(group), F.col(record)).mapInArrow(
        lambda batches: _tokenized(batches, key, record, group), schema
    )
    fields = F.transform("_fields", lambda x: F.replace(x, F.lit('""'), F.lit('"')))
    rows = rows.withColumn("_fields", F.when(F.exists("_fields", lambda x: x.contains('""')), fields).otherwise(F.col("_fields")))
    width, first_bad, bad_name = F.lit(None).cast("int"), F.lit(None).cast("int"), F.lit(None).cast("string")
    for name, layout in layouts.items():
        mine = F.col("_group") == name
        width = F.when(mine, len(layout.fields)).otherwise(width)
        index = F.lit(None).cast("int")
        for i, f in reversed(list(enumerate(layout.fields))):
            if f.kind != "text":
                index = F.when(~_valid(f.kind, F.get("_fields", i)), i).otherwise(index)
        first_bad = F.when(mine, index).otherwise(first_bad)
        names = F.array(*[F.lit(f.name) for f in layout.fields])
        bad_name = F.when(mine, F.get(names, index)).otherwise(bad_name)
    reason = (
        F.when(F.col("_bad_at") >= 0, "quoting")
        .when(width.isNull() | (F.size("_fields") != width), "columns")
        .when(first_bad.isNotNull(), "value")
    )
    rows = rows.withColumn("_reason", reason)
    at = F.when(F.col("_reason") == "quoting", F.col("_bad_at")).when(F.col("_reason") == "columns", F.size("_fields")).when(F.col("_reason") == "value", first_bad)
    return rows.select(
        F.col("_key").alias(key), F.col("_group").alias(group), F.col("_fields").alias("fields"), F.col("_reason").alias("reason"),
        at.cast("bigint").alias("error_at"), F.when(F.col("_reason") == "value", bad_name).alias("error_field"),
    )


def typed_rows(parsed: DataFrame, key: str, group: str, name: str, layouts: dict[str, Layout] = LAYOUTS) -> DataFrame:
    """The loadable records of one layout as typed columns: integers as int, empty text as null, all else as text."""
    out = [F.col(key)]
    for i, f in enumerate(layouts[name].fields):
        c = F.get("fields", F.lit(i))
        out.append((_as_int(c) if f.kind.startswith("int32") else F.nullif(c, F.lit(""))).alias(f.name))
    return parsed.where(F.col("reason").isNull() & (F.col(group) == name)).select(*out)
