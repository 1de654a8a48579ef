"""Queries of the training-data problems and, where SQL can express them, their SQL twins."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateflow.llm import canonical_text, entity_match, leaks, mixing, name_variants, prose, survivors
from crateflow.sources.tables import table

# --- 1: albums without a shared id ---------------------------------------------------------------------------------


def _p1_records(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Library rows, and releases under each main credit and under all of them together."""
    library = table(spark, d, "library")
    credits = table(spark, d, "release_artist").where("extra = 0 and artist_name is not null").select("release_id", "artist_name").distinct()
    together = credits.groupBy("release_id").agg(F.array_join(F.array_sort(F.collect_set("artist_name")), " & ").alias("artist_name"), F.count("*").alias("n")).where("n > 1").drop("n")
    titles = table(spark, d, "releases").select(F.col("id").alias("release_id"), "title")
    left = entity_match.records(library, "id", "artist", "title")
    return left, entity_match.records(credits.unionByName(together).join(titles, "release_id"), "release_id", "artist_name", "title")


def p1_matches(spark: SparkSession, d: str) -> DataFrame:
    """Every pair of library row and release that was compared, with its posterior and whether they are one album."""
    found = entity_match.match_records(*_p1_records(spark, d))
    return found.select(F.col("left_row").cast("int").alias("library_id"), F.col("right_row").cast("int").alias("release_id"), "confidence", "linked")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_matches(spark, d).where("linked").select("library_id", "release_id")


def p1_albums(spark: SparkSession, d: str) -> DataFrame:
    """The album of each library row (source 0) and release (source 1)."""
    return entity_match.albums(*_p1_records(spark, d)).select(F.col("side").alias("source"), F.col("row").cast("int").alias("row_id"), "album")


# --- 4: variant spellings -----------------------------------------------------------------------------------------


def _p4_names(spark: SparkSession, d: str) -> DataFrame:
    names = name_variants.name_keys(table(spark, d, "release_artist"), ["artist_name", "anv"])
    return names.unionByName(name_variants.name_keys(table(spark, d, "library"), ["alternate_artist_name"])).distinct()


def p4_entities(spark: SparkSession, d: str) -> DataFrame:
    return name_variants.name_entities(_p4_names(spark, d))


def p4_links(spark: SparkSession, d: str) -> DataFrame:
    """The links between name keys by strong rewritings, with the rarity of the rarest one they share."""
    return name_variants.name_links(_p4_names(spark, d))[0].select("a", "b", "score")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return name_variants.spelling_pairs(p4_entities(spark, d))


# --- 5: text that looks the same ---------------------------------------------------------------------------------


def _forms(spark: SparkSession, d: str) -> DataFrame:
    parts = [("release_artist", "artist_name"), ("identity_normalization_cases", "input"), ("wxyc_library", "norm_artist")]
    forms = [canonical_text.canonical_forms(table(spark, d, t), [f]) for t, f in parts]
    return forms[0].unionByName(forms[1]).unionByName(forms[2])


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return canonical_text.same_reading_pairs(_forms(spark, d))


def p5_forms(spark: SparkSession, d: str) -> DataFrame:
    return _forms(spark, d).where("text <> canonical")


# --- 7: best representative ---------------------------------------------------------------------------------------


def _profiled(spark: SparkSession, d: str) -> DataFrame:
    releases = table(spark, d, "releases").where("master_id is not null")
    return survivors.with_profile(releases, table(spark, d, "release_label"), "id", "release_id", "label_name", ["country", "released", "notes"], "data_quality")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return survivors.dominant(_profiled(spark, d), ["master_id", "format"], "id", "cached_at").select("master_id", F.col("id").alias("release_id"))


def p7_top(spark: SparkSession, d: str) -> DataFrame:
    top = survivors.top_ranked(_profiled(spark, d), ["master_id", "format"], "id", "cached_at")
    return top.select("master_id", "format", F.col("id").alias("release_id"), F.col("_complete").alias("complete"), F.col("_quality").alias("quality"))


def p7_merged(spark: SparkSession, d: str) -> DataFrame:
    return survivors.merged(_profiled(spark, d), ["master_id", "format"], "id", "cached_at", ["title", "country", "released", "notes", "data_quality"])


_P7_SQL = """
r AS (SELECT *, CASE data_quality WHEN 'Complete and Correct' THEN 5 WHEN 'Correct' THEN 4 WHEN 'Needs Vote' THEN 3 WHEN 'Needs Minor Changes' THEN 2 WHEN 'Needs Major Changes' THEN 1 ELSE 0 END AS q,
  coalesce(country <> 'Unknown', false) AS hc, coalesce(released <> 'Unknown', false) AS hr, coalesce(notes <> 'Unknown', false) AS hn,
  id IN (SELECT release_id FROM release_label WHERE label_name <> 'Unknown') AS hl FROM releases WHERE master_id IS NOT NULL)"""
_P7_ORDER = "q DESC, cached_at DESC NULLS LAST, id"

# --- 8: evaluation texts in training text -------------------------------------------------------------------------


def p8_leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find_leaks(table(spark, d, "documents"), "doc_id", "text", table(spark, d, "eval_items"), "item_id", "item_text")


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return p8_leaks(spark, d).select("item_id", "doc_id")


def p8_leaked_items(spark: SparkSession, d: str) -> DataFrame:
    return p8_leaks(spark, d).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("matched").alias("most_words"))


# --- 9: mixing sources --------------------------------------------------------------------------------------------

#: The public vocabulary whose tokens give the sizes; the folder can be set.
RANKS = os.path.join(os.environ.get("TOKENIZERS_DIR", "/opt/tokenizers"), "byte_bpe_50k.tiktoken")


def _mixed(spark: SparkSession, d: str, relative_size: float | None = None) -> tuple[DataFrame, DataFrame]:
    return mixing.mix_documents(table(spark, d, "documents"), "doc_id", "source", "text", table(spark, d, "mix_targets"), RANKS, relative_size)


def p9_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixing.emitted(_mixed(spark, d)[0])


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return _mixed(spark, d)[1]


def p9_shares_capped(spark: SparkSession, d: str) -> DataFrame:
    """The shares of a mix as large as the listed sources, in which scarce sources stay at their caps."""
    return _mixed(spark, d, 1.0)[1]


# --- 10: text quality ---------------------------------------------------------------------------------------------


def p10_statistics(spark: SparkSession, d: str) -> DataFrame:
    return prose.quality_statistics(table(spark, d, "documents"), "doc_id", "text")


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return prose.not_prose(p10_statistics(spark, d)).select("doc_id").distinct()


QUERIES = {f.__name__: f for f in (p1_found, p1_matches, p1_albums, p4_found, p4_entities, p4_links, p5_found, p5_forms, p7_found, p7_top, p7_merged, p8_found, p8_leaks, p8_leaked_items, p9_mix, p9_shares, p9_shares_capped, p10_found, p10_statistics)}
ORACLE = {
    "p7_found": f"""WITH {_P7_SQL} SELECT master_id, id AS release_id FROM r a
      WHERE EXISTS (FROM r b WHERE b.master_id = a.master_id AND b.format IS NOT DISTINCT FROM a.format AND b.id <> a.id)
      AND NOT EXISTS (FROM r b WHERE b.master_id = a.master_id AND b.format IS NOT DISTINCT FROM a.format AND b.id <> a.id
        AND (b.hc > a.hc OR b.hr > a.hr OR b.hn > a.hn OR b.hl > a.hl OR b.q > a.q OR coalesce(b.cached_at >= a.cached_at, a.cached_at IS NULL)))""",
    "p7_top": f"""WITH {_P7_SQL} SELECT master_id, format, id AS release_id, hc::INT + hr::INT + hn::INT + hl::INT AS complete, q AS quality FROM r
      QUALIFY row_number() OVER (PARTITION BY master_id, format ORDER BY complete DESC, {_P7_ORDER}) = 1""",
    "p7_merged": f"""WITH {_P7_SQL} SELECT master_id, format, {", ".join(f"first({c} ORDER BY {_P7_ORDER}) FILTER (WHERE {c} <> 'Unknown') AS {c}" for c in ("title", "country", "released", "notes", "data_quality"))},
      count(*) AS members FROM r GROUP BY master_id, format""",
}
