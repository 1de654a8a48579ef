"""Misspelt words linked once over a vocabulary, so that texts need not be compared letter by letter."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.llm.pairs import pairs_of_forms
from crateflow.session import cut_lineage, spread


def distance(a: str, b: str) -> int:
    """Edits between two words: letters put in, left out, replaced, or swapped with their neighbour.

    Bit-parallel: the differences between neighbouring cells of a column are the bits of two integers, one step a letter of ``b``.
    """
    if a == b:
        return 0
    if not a or not b:
        return len(a) or len(b)
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, diagonal, before, score = full, 0, 0, 0, len(a)
    for c in b:
        equal = places.get(c, 0)
        swapped = ((~diagonal & equal) << 1) & before
        diagonal = ((((equal & up) + up) ^ up) | equal | down | swapped) & full
        grown, shrunk = down | (full & ~(diagonal | up)), diagonal & up
        score += (grown & last > 0) - (shrunk & last > 0)
        grown, shrunk = (grown << 1 | 1) & full, (shrunk << 1) & full
        up, down, before = shrunk | (full & ~(diagonal | grown)), grown & diagonal, equal
    return score


def _shortened(words: Column) -> Column:
    """The words and all that come of leaving out one letter of one of them."""
    cut = lambda w: F.transform(F.sequence(F.lit(1), F.length(w)), lambda i: F.concat(F.substring(w, F.lit(1), i - 1), F.substring(w, i + 1, F.length(w))))
    return F.array_distinct(F.concat(words, F.flatten(F.transform(F.filter(words, lambda w: F.length(w) > 0), cut))))


def slips(vocabulary: DataFrame, established: int, least_ratio: float, shortest: int = 2, double_from: int | None = None) -> DataFrame:
    """(word, meant, uses, edits): for each word of the vocabulary (word, uses) every word that it may be a slip of.

    That is one an edit away, or two edits for words of ``double_from`` letters or more, that is used as often or more. Two words of
    which each has ``established`` uses, the rarer one at least ``least_ratio`` times as many as the other, are two words. Words of fewer
    than ``shortest`` letters are left alone. Words meet in an equi-join on the forms in which letters are left out, every pair of a form.
    """
    words = cut_lineage(vocabulary.where(F.length("word") >= shortest - 1).select("word", "uses"))
    one = _shortened(F.array("word"))
    forms = one if double_from is None else F.when(F.length("word") >= double_from - 1, _shortened(one)).otherwise(one)
    formed = spread(words, "word").select("word", "uses", F.explode(forms).alias("form")).select("word", "uses", F.xxhash64("form").alias("form"))
    two_words = (F.least("x.uses", "y.uses") >= established) & (F.least("x.uses", "y.uses") >= least_ratio * F.greatest("x.uses", "y.uses"))
    met = pairs_of_forms(formed, "word", ["uses"], ~two_words & (F.greatest(F.length("x.word"), F.length("y.word")) >= shortest))

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            edits = [distance(x, y) for x, y in zip(b["a"], b["b"])]
            allowed = [2 if double_from is not None and max(len(x), len(y)) >= double_from else 1 for x, y in zip(b["a"], b["b"])]
            keep = [e <= n for e, n in zip(edits, allowed)]
            yield b.assign(edits=edits)[keep]

    near = spread(met.select("a", "b"), "a").mapInPandas(check, "a string, b string, edits int")
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "edits"))
    own, other = words.select(F.col("word").alias("a"), F.col("uses").alias("_own")), words.select(F.col("word").alias("b"), "uses")
    return both.join(own, "a").join(other, "b").where("uses >= _own").select(F.col("a").alias("word"), F.col("b").alias("meant"), "uses", "edits")


def established(vocabulary: DataFrame, slipped: DataFrame, least: int, least_ratio: float) -> DataFrame:
    """(word, uses): the words of ``least`` uses or more that aren't slips of a word used more than 1 / ``least_ratio`` times as often: two frequent slips of one word
    aren't two words."""
    doubtful = slipped.join(vocabulary.select("word", F.col("uses").alias("_own")), "word").where(F.col("_own") < least_ratio * F.col("uses")).select("word").distinct()
    return vocabulary.where(F.col("uses") >= least).join(doubtful, "word", "left_anti").select("word", "uses")
