"""Spellings of one name linked by the rewritings they share, weighed by how rare a rewriting is."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crateflow.llm import name_forms as N
from crateflow.llm.components import components
from crateflow.llm.pairs import pairs_of_forms
from crateflow.llm.word_slips import slips
from crateflow.session import cut_lineage, spread

#: Two words that so many keys share, the rarer one at least so often for each use of the other, are two words, not one misspelt.
ESTABLISHED, LEAST_RATIO = 3, 0.1
#: An abbreviation is resolved if its rarity, 1 / (number of artists that offer it), is more than this: one artist is likelier than all others.
LEAST_RARITY = 0.5


def _parsed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        keys = [p.key if (p := N.parse(n)) else None for n in b["name"]]
        out = pd.DataFrame({"name": b["name"].to_numpy(), "key": keys})
        yield out[out["key"].notna()]


def _forms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows: list[tuple[str, str, str]] = []
        for key in b["key"]:
            p = _from_key(key)
            rows += [(key, "strong", f) for f in (*N.strong_forms(p), *N.slip_forms(key, {}))]
            offered, sought = N.weak_forms(p)
            rows += [(key, "offered", f) for f in offered] + [(key, "familiar" if offered else "sought", f) for f in sought]
        yield pd.DataFrame(rows, columns=["key", "kind", "form"])


def _slip_forms(keys: DataFrame) -> DataFrame:
    """(key, kind, form): the forms of keys with words that may be slips of others. Words are held against the vocabulary of all keys, once."""
    words = keys.select("key", F.explode(F.array_distinct(F.split("key", " "))).alias("word")).where(~F.col("word").endswith(".") & (F.col("word") != "&"))
    vocabulary = words.groupBy("word").agg(F.count("*").alias("uses"))
    meant = cut_lineage(slips(vocabulary, ESTABLISHED, LEAST_RATIO, N.TYPO_WORD).groupBy("word").agg(F.sort_array(F.collect_set("meant")).alias("meant")))
    open_ = words.join(meant, "word").groupBy("key").agg(F.collect_list(F.struct("word", "meant")).alias("open"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = [(k, "strong", f) for k, o in zip(b["key"], b["open"]) for f in N.slip_forms(k, {x["word"]: list(x["meant"]) for x in o})]
            yield pd.DataFrame(rows, columns=["key", "kind", "form"])

    return spread(open_, "key").mapInPandas(run, "key string, kind string, form string")


def _from_key(key: str) -> N.Parsed:
    members = [m.split(" ") for m in key.split(" & ")]
    return N.Parsed(tuple(tuple(w.rstrip(".") for w in m) for m in members), tuple(tuple(w.endswith(".") for w in m) for m in members))


def name_keys(df: DataFrame, fields: list[str]) -> DataFrame:
    """(name, key) for each distinct non-null value of the fields that names an artist."""
    names = df.select(F.explode(F.array(*[F.col(f).cast("string") for f in fields])).alias("name")).where("name is not null").distinct()
    return spread(names, "name").mapInPandas(_parsed, "name string, key string")


def name_links(names: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((a, b, slip, score), (key, kind, form)): the links between keys by strong rewritings, and all rewritings.

    A link's score is the rarity of the rarest rewriting that both keys have: 1 where only the two have it, towards 0 where all
    keys do (1 - ln(n - 1) / ln(keys)).
    """
    keys = cut_lineage(names.select("key").distinct())
    forms = spread(keys, "key").mapInPandas(_forms, "key string, kind string, form string").unionByName(_slip_forms(keys))
    forms = cut_lineage(forms.withColumn("form", F.xxhash64("form")).distinct())
    words = keys.select("key", F.explode(F.array_distinct(F.split("key", " "))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    frequent = words.where(F.col("n") >= ESTABLISHED)
    n_keys = max(keys.count(), 2)

    # Every pair of keys of a form, so that a key that the check refuses stands in no other's way.
    met = pairs_of_forms(forms.where("kind = 'strong'").select("form", "key"), "key")
    pairs = met.select("a", "b", (1 - F.log(F.col("n") - 1) / F.log(F.lit(float(n_keys)))).alias("score"))

    checked = cut_lineage(_checked(pairs))
    known = cut_lineage(_two_words(checked, frequent))
    links = cut_lineage(checked.join(known, ["a", "b"], "left_anti"))
    return cut_lineage(_without_ties(links, words, frequent).select("a", "b", (F.size("d") > 0).alias("slip"), "score")), forms


def _checked(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b, ...) of keys that are the same but for order, or but for an edit in a word or two, with d: those words, in pairs."""
    names = pairs.columns

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            d = [_differences(x, y) for x, y in zip(b["a"], b["b"])]
            keep = [x is not None for x in d]
            yield b.assign(d=d)[keep]

    return spread(pairs, "a", "b").mapInPandas(check, ", ".join(f"{c} {t}" for c, t in pairs.dtypes) + ", d array<string>").select(*names, "d")


def _two_words(checked: DataFrame, frequent: DataFrame) -> DataFrame:
    """(a, b) of the checked pairs in which a word and its counterpart are both in use."""
    slipped = checked.where(F.size("d") > 0).select("a", "b", F.posexplode("d").alias("i", "word"))
    known = slipped.join(frequent, "word").groupBy("a", "b", F.floor(F.col("i") / 2).alias("slip")).agg(F.count("*").alias("k"), (F.min("n") / F.max("n")).alias("ratio"))
    return known.where((F.col("k") == 2) & (F.col("ratio") >= LEAST_RATIO)).select("a", "b").distinct()


def name_entities(names: DataFrame) -> DataFrame:
    """(name, key, entity, score): equal entity for spellings of one artist; the entity is one of its keys.

    Names with one key (same but for encoding, case, accents, punctuation, article, connector, trailing number) are one.
    Keys explode into their rewritings, which meet in equi-joins. Strong ones (word order, middle initial, run-together
    words, a word or two put right by the vocabulary) link keys if the words that differ are an edit apart and not both words in use;
    every two keys of a form are checked. A key that is a slip of two keys told apart by their words links to neither.
    Weak ones (initials, abbreviated or familiar given names, a duo's family names) attach a key to the artist that offers
    the rewriting if its rarity, 1 / (number of artists offering it), exceeds ``LEAST_RARITY``. Ties therefore link nothing.
    ``score`` is the greatest rarity by which the key was linked, 1 for a key that stands alone.
    """
    names = cut_lineage(names)  # parsed once
    keys = names.select("key").distinct()
    links, forms = name_links(names)
    found = components(links.select("a", "b"))
    best = links.select(F.explode(F.array("a", "b")).alias("key"), "score")
    entity = cut_lineage(keys.join(found, F.col("key") == F.col("node"), "left").select("key", F.coalesce("component", "key").alias("entity")))

    # Familiar given names first, so that an initial finds one artist where it would find a name and its short form.
    entity, familiar = _attached(entity, forms, "familiar")
    entity = cut_lineage(entity)
    final, sought = _attached(entity, forms, "sought")
    best = best.unionByName(familiar).unionByName(sought).groupBy("key").agg(F.max("score").alias("score"))
    return names.join(final.join(best, "key", "left"), "key").select("name", "key", "entity", F.coalesce("score", F.lit(1.0)).alias("score"))


def _without_ties(links: DataFrame, words: DataFrame, frequent: DataFrame) -> DataFrame:
    """The links (a, b, d), less those of a key that is a slip of two keys which are two artists by their words: it may be a slip of either."""
    slipped = links.where(F.size("d") > 0).select("a", "b", F.posexplode("d").alias("i", "word")).join(words, "word")
    own = lambda side: F.max(F.when(F.col("i") % 2 == side, F.col("n")))
    per = slipped.groupBy("a", "b", F.floor(F.col("i") / 2).alias("slip")).agg(own(0).alias("na"), own(1).alias("nb"))
    way = per.groupBy("a", "b").agg(F.bool_and(F.col("na") < F.col("nb")).alias("up"), F.bool_and(F.col("na") > F.col("nb")).alias("down"))
    ends = way.where("up").select(F.col("a").alias("mid"), F.col("b").alias("end")).unionByName(way.where("down").select(F.col("b").alias("mid"), F.col("a").alias("end")))
    ends = cut_lineage(ends)
    two = ends.select("mid", F.col("end").alias("a")).join(ends.select("mid", F.col("end").alias("b")), "mid").where("a < b")
    apart = _two_words(_checked(two.select("a", "b").distinct()), frequent)
    torn = two.join(apart, ["a", "b"]).select("mid", F.explode(F.array("a", "b")).alias("end")).select(F.least("mid", "end").alias("a"), F.greatest("mid", "end").alias("b")).distinct()
    return links.join(torn, ["a", "b"], "left_anti")


def _attached(entity: DataFrame, forms: DataFrame, kind: str) -> tuple[DataFrame, DataFrame]:
    """((key, entity), (key, score)) after the artists that seek a rewriting have joined the one that offers it; an artist seeks through all of its
    keys at once. Artists that seek the same abbreviation, which nobody offers, are one too."""
    offered = forms.where("kind = 'offered'").join(entity, "key").select("form", "entity").distinct().withColumnRenamed("entity", "target")
    sought = forms.where(F.col("kind") == kind).join(entity, "key").select("form", "entity").distinct()
    met = sought.join(offered, "form").where("entity <> target").groupBy("entity").agg(F.min("target").alias("b"), F.count_distinct("target").alias("_n"))
    links = met.select(F.col("entity").alias("a"), "b", (1 / F.col("_n")).alias("score")).where(F.col("score") > LEAST_RARITY)
    if kind == "sought":
        lonely = sought.join(offered.select("form").distinct(), "form", "left_anti")
        first = lonely.groupBy("form").agg(F.min("entity").alias("b"), F.count("*").alias("_n"))
        links = links.unionByName(lonely.join(first, "form").where("entity <> b").select(F.col("entity").alias("a"), "b", (1 / (F.col("_n") - 1)).alias("score")))
    links = cut_lineage(links.groupBy("a", "b").agg(F.max("score").alias("score")))
    whole = components(links.select("a", "b"))
    scored = links.select(F.explode(F.array("a", "b")).alias("key"), "score")
    return entity.join(whole, F.col("entity") == F.col("node"), "left").select("key", F.coalesce("component", "entity").alias("entity")), scored


def _differences(a: str, b: str) -> list[str] | None:
    if _reordered(a, b):
        return []
    d = N.differing_words(a, b)
    return None if d is None else [w for pair in d for w in pair]


def _reordered(a: str, b: str) -> bool:
    """Same words in another order, middle initials left out."""
    x, y = (sorted(w for w in k.split(" ") if not (len(w) == 2 and w.endswith("."))) for k in (a, b))
    if sorted(a.split(" ")) == sorted(b.split(" ")):
        return True
    return x == y and len([w for w in x if w != "&"]) >= 2 and "&" not in x and abs(len(a.split(" ")) - len(b.split(" "))) <= 1


def spelling_pairs(entities: DataFrame) -> DataFrame:
    """(name_a, name_b), name_a < name_b by code point: all pairs of different spellings of one artist."""
    several = entities.groupBy("entity").agg(F.count("*").alias("_n")).where("_n > 1").select("entity")
    kept = entities.select("entity", "name").join(several, "entity", "left_semi")
    return kept.withColumnRenamed("name", "name_a").join(kept.withColumnRenamed("name", "name_b"), "entity").where("name_a < name_b").select("name_a", "name_b")
