"""Mixing sources to target shares of all tokens."""

from __future__ import annotations

import base64
import warnings
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crateflow.session import cut_lineage

#: Sources that a mix may list: their totals are a table of one row each.
MOST_SOURCES = 100_000
#: Share of the listed tokens below which a mix with exact shares warns that one source is too scarce.
LEAST_USED = 0.1


@cache
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
    # Fixed value: the split pattern of the public byte-level vocabulary.
    pattern = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, key: str, source: str, text: str, ranks_path: str) -> DataFrame:
    """(key, source, tokens): the tokens of each whole text under a public byte-level vocabulary; null text has none."""

    @F.pandas_udf(T.LongType())
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = _encoding(ranks_path).encode_ordinary
        for texts in batches:
            yield pd.Series([len(encode(t)) if isinstance(t, str) else 0 for t in texts], dtype="int64")

    return df.select(F.col(key), F.col(source).alias("source"), count(F.col(text)).alias("tokens"))


def repetition_rates(counts: DataFrame, targets: DataFrame, relative_size: float | None = None) -> DataFrame:
    """(source, target_share, max_repeats, tokens, rate) for each listed source.

    The rate, copies per document, never exceeds ``max_repeats``. Without ``relative_size`` the mix is as large as it can be with
    every target share met exactly: the source that is scarcest for its share is used ``max_repeats`` times and sets the
    size of all others too, so a source that is all but empty shrinks the mix to next to nothing; a warning names it where less than
    ``LEAST_USED`` of the listed tokens are used. With it, the mix aims at that multiple of the listed sources' tokens: each source gets its share of the total as far as its cap allows, and what capped sources lack goes to the
    others in proportion to their targets, again within their caps. Listed sources without tokens get the rate 0 and
    the others share the mix; sources that aren't listed don't take part. Target shares are scaled to sum to 1; a source
    listed twice takes its first row by cap.
    """
    totals = counts.groupBy("source").agg(F.sum("tokens").cast("double").alias("tokens"))  # one row per source, combined before the shuffle
    listed = targets.where("source is not null and target_share > 0 and max_repeats > 0").groupBy("source").agg(F.min(F.struct("max_repeats", "target_share")).alias("t"))
    rows = listed.join(totals, "source", "left").select("source", F.col("t.target_share").cast("double").alias("share"), F.col("t.max_repeats").alias("cap"), F.coalesce("tokens", F.lit(0.0)).alias("tokens"))
    plan = rows.limit(MOST_SOURCES + 1).collect()
    if len(plan) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources are listed")
    rates = _rates([(r["source"], r["share"], r["cap"], r["tokens"]) for r in plan], relative_size)
    schema = "source string, target_share double, max_repeats int, tokens double, rate double"
    return counts.sparkSession.createDataFrame([(r["source"], r["share"], int(r["cap"]), r["tokens"], rates[r["source"]]) for r in plan], schema)


def _rates(rows: list[tuple[str, float, int, float]], relative_size: float | None) -> dict[str, float]:
    rates = {source: 0.0 for source, *_ in rows}
    live = [r for r in rows if r[3] > 0]
    weight = sum(r[1] for r in live)
    if not live:
        return rates
    if relative_size is None:
        size, scarce = min((cap * tokens / (share / weight), source) for source, share, cap, tokens in live)
        if size < LEAST_USED * sum(r[3] for r in live):
            warnings.warn(f"the source {scarce!r} is so scarce for its share that the mix has {size:.0f} tokens only; relative_size asks for a size instead", stacklevel=2)
        return rates | {source: min(float(cap), share / weight * size / tokens) for source, share, cap, tokens in live}
    left = relative_size * sum(r[3] for r in live)
    while live:
        weight = sum(r[1] for r in live)
        full = [r for r in live if r[1] / weight * left >= r[2] * r[3]]
        if not full:
            return rates | {source: share / weight * left / tokens for source, share, _, tokens in live}
        for r in full:
            rates[r[0]] = float(r[2])
            left -= r[2] * r[3]
        live = [r for r in live if r not in full]
        left = max(left, 0.0)
    return rates


def mixed(counts: DataFrame, rates: DataFrame, key: str, seed: int = 17) -> DataFrame:
    """(key, source, tokens, copies) of each document that takes part: floor(rate) copies and one more with the probability of
    the fraction, drawn from a hash of key and seed, so a rerun or a retried task draws the same. Rows without copies are left out."""
    unit = F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 52)) / float(1 << 52)
    draw = F.floor("rate") + F.when(unit < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    joined = counts.join(F.broadcast(rates.select("source", "rate")), "source")  # at most MOST_SOURCES rows
    return joined.withColumn("copies", draw.cast("int")).where("copies > 0").select(key, "source", "tokens", "copies")


def emitted(mix: DataFrame) -> DataFrame:
    """One row per copy, numbered from 1."""
    return mix.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).drop("copies")


def shares(mix: DataFrame, rates: DataFrame) -> DataFrame:
    """(source, target_share, max_repeats, source_tokens, rate, mixed_tokens, actual_share) per listed source."""
    got = mix.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("mixed_tokens"))
    rows = rates.join(got, "source", "left").withColumn("mixed_tokens", F.coalesce("mixed_tokens", F.lit(0)))
    whole = rows.agg(F.sum("mixed_tokens").alias("_all"))
    return rows.join(F.broadcast(whole)).select(
        "source", "target_share", "max_repeats", F.col("tokens").cast("bigint").alias("source_tokens"), "rate", "mixed_tokens", (F.col("mixed_tokens") / F.greatest("_all", F.lit(1))).alias("actual_share")
    )


def mix_documents(docs: DataFrame, key: str, source: str, text: str, targets: DataFrame, ranks_path: str, relative_size: float | None = None, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(mix, shares). Tokens are counted once and kept, as three narrow columns, in the checkpoint folder."""
    counts = cut_lineage(token_counts(docs, key, source, text, ranks_path))
    rates = repetition_rates(counts, targets, relative_size)
    mix = mixed(counts, rates, key, seed)
    return mix, shares(mix, rates)
