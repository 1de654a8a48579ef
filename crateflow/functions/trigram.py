"""Trigram similarity inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def trigrams(c: Column) -> Column:
    """Distinct trigrams of the words, each padded by two spaces before and one behind; null and wordless text have none."""
    words = F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"[^\p{L}\p{N}]+", " "), " "), lambda w: w != "")
    grams = lambda w: F.transform(F.sequence(F.lit(1), F.length(w) + 1), lambda i: F.concat(F.lit("  "), w, F.lit(" ")).substr(i, F.lit(3)))
    return F.array_distinct(F.flatten(F.transform(words, grams)))


def overlap(a: Column, b: Column) -> Column:
    """Shared over all, of two arrays without repeats; 0 if both are empty."""
    shared = F.size(F.array_intersect(a, b))
    return F.coalesce(shared / F.nullif(F.size(a) + F.size(b) - shared, F.lit(0)), F.lit(0.0))


def similarity(a: Column, b: Column) -> Column:
    """Trigram similarity of two texts, 0..1."""
    return overlap(trigrams(a), trigrams(b))


def weighted(title: Column, artist: Column) -> Column:
    """Search score of a candidate: title counts for more than artist."""
    return 0.6 * title + 0.4 * artist
