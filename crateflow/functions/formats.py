"""Carrier formats: broad categories, shelf formats with quantities, and compatibility."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crateflow.functions.normalize import strip

# Format wordings and their category.
CATEGORIES = {"vinyl": "Vinyl", "lp": "Vinyl", '12"': "Vinyl", '10"': "Vinyl", "cd": "CD", "cd-r": "CD", "cdr": "CD", "cassette": "Cassette", '7"': '7"', "file": "Digital", "flac": "Digital", "mp3": "Digital", "wav": "Digital"}


def _category(low: Column) -> Column:
    return F.create_map(*[F.lit(x) for kv in CATEGORIES.items() for x in kv])[low]


def release_category(c: Column) -> Column:
    """Category of the first of several formats, a leading ``Nx`` apart; null if unknown."""
    first = strip(F.split(c, ",")[0])
    return _category(F.lower(F.regexp_replace(first, r"(?i)^\d+x", "")))


def shelf_category(c: Column) -> Column:
    """Category of a shelf's own wording: quantity apart, ``vinyl - SIZE`` by its size."""
    low = F.lower(F.regexp_replace(strip(c), r"(?i)\s+x\s+\d+(?:\s+box)?$", ""))
    size = strip(F.regexp_replace(low, "^vinyl - ", ""))
    return F.when(low.startswith("vinyl - "), F.coalesce(_category(size), F.lit("Vinyl"))).otherwise(_category(low))


def shelf_format(c: Column) -> Column:
    """struct(name, discs) of a shelf format; null for what has none."""
    low = strip(F.lower(c))
    discs = lambda pattern: F.coalesce(F.nullif(F.regexp_extract(low, pattern, 1), F.lit("")).cast("int"), F.lit(1))
    size = F.when(low.contains('7"'), 'vinyl 7"').when(low.contains('10"'), 'vinyl 10"').when(low.contains('12"') | low.contains("lp"), 'vinyl 12"').otherwise("vinyl")
    cd = low.rlike(r"^cd(?:\s*x\s*\d+)?(?:\s*box)?$")
    pair = lambda name, n: F.struct(name.alias("name"), n.cast("int").alias("discs"))
    return F.when(cd, pair(F.lit("cd"), discs(r"x\s*(\d+)"))).when(low == "cdr", pair(F.lit("cdr"), F.lit(1))).when(low.startswith("vinyl"), pair(size, discs(r"\bx\s*(\d+)\b")))


def compatible(release: Column, shelf: Column, shelf_has_null: Column) -> Column:
    """Whether a release's category goes with the shelf's set of categories. Unknown on either side goes with all."""
    return (F.size(F.coalesce(shelf, F.array())) == 0) | F.coalesce(shelf_has_null, F.lit(False)) | release.isNull() | F.coalesce(F.array_contains(shelf, release), F.lit(False))
