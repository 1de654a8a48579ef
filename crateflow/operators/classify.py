"""Releases against a library: which to keep, review or prune, by exact pairs, tokens and fuzzy scores; audits and reports of the outcome."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from crateflow.functions.formats import compatible
from crateflow.functions.normalize import is_compilation, match_artist, match_title, split_names
from crateflow.functions.similarity import token_set_ratio
from crateflow.functions.stats import wilson
from crateflow.operators.fuzzy_match import best_match
from crateflow.operators.search import similarity_join, similarity_join_within, tokens
from crateflow.session import cut_lineage

#: Between artist and title in a combined text.
SEPARATOR = " ||| "


@dataclass(frozen=True)
class Thresholds:
    """Scores 0..1 of the decisions; ``artist_cutoff`` is that of whole classifications, ``pair_cutoff`` that of single pairs."""

    strong: float = 0.75
    one_strong: float = 0.85
    two_fair: float = 0.70
    review: float = 0.65
    compilation: float = 0.80
    artist_cutoff: float = 0.60
    pair_cutoff: float = 0.70


# --- the library --------------------------------------------------------------------------------------------------------


def name_components(rows: DataFrame, artists: DataFrame) -> DataFrame:
    """(artist, title): the parts of joint credits. Those at commas, slashes and plus signs always, those at ampersands if the library has one of
    the parts as an artist."""
    plain = rows.select("raw", "title", split_names(F.col("raw")).alias("parts"))
    sure = plain.where("parts is not null").select("title", F.explode("parts").alias("part"))
    tied = plain.where(F.col("parts").isNull() & F.col("raw").contains(" & ")).select("raw", "title", F.explode(F.transform(F.split("raw", " & "), lambda x: F.trim(x))).alias("part")).where("part <> ''")
    tied = tied.withColumn("artist", match_artist(F.col("part"))).join(artists.withColumn("_known", F.lit(1)), "artist", "left")
    known = tied.groupBy("raw", "title").agg(F.max("_known").alias("_k")).where("_k = 1").select("raw", "title")
    both = sure.select(match_artist(F.col("part")).alias("artist"), "title").unionByName(tied.join(known, ["raw", "title"], "left_semi").select("artist", "title"))
    return both.where("artist <> ''").distinct()


def library_index(library: DataFrame, artist: str, title: str, alternate: str | None = None, shelf_format: Column | None = None) -> dict[str, DataFrame]:
    """pairs (artist, title, formats, any_format), artists, combined texts and compilation titles, all in linkage form.

    Rows without artist or title don't count. A compilation gives its title only. An alternate artist that is neither a compilation nor the artist
    adds a pair and an artist, but no combined text; the parts of a joint credit add pairs only. A null format in a pair's set means that any
    format goes; a part's pair has no formats.
    """
    fmt = F.lit(None).cast("string") if shelf_format is None else shelf_format
    other = F.col(alternate) if alternate else F.lit(None).cast("string")
    given = library.where((F.coalesce(F.col(artist), F.lit("")) != "") & (F.coalesce(F.col(title), F.lit("")) != ""))
    rows = given.select(F.col(artist).alias("raw"), match_title(F.col(title)).alias("title"), fmt.alias("format"), other.alias("other"), is_compilation(F.col(artist)).alias("compilation"))
    main = rows.where("not compilation").withColumn("artist", match_artist(F.col("raw")))
    aliases = main.where((F.coalesce("other", F.lit("")) != "") & ~is_compilation(F.col("other"))).withColumn("alias", match_artist(F.col("other"))).where("alias <> '' and alias <> artist")
    direct = main.select("artist", "title", "format", F.lit(True).alias("combined")).unionByName(aliases.select(F.col("alias").alias("artist"), "title", "format", F.lit(False).alias("combined")))
    pairs = direct.groupBy("artist", "title").agg(F.array_sort(F.collect_set("format")).alias("formats"), F.bool_or(F.col("format").isNull()).alias("any_format"), F.bool_or("combined").alias("combined"))
    pairs = cut_lineage(pairs)
    artists = pairs.select("artist").distinct()
    parts = name_components(main, artists).join(pairs.select("artist", "title"), ["artist", "title"], "left_anti")
    every = pairs.drop("combined").unionByName(parts.select("artist", "title", F.array().cast("array<string>").alias("formats"), F.lit(False).alias("any_format")))
    return {
        "pairs": cut_lineage(every),
        "artists": artists,
        "combined": pairs.where("combined").select(F.concat("artist", F.lit(SEPARATOR), "title").alias("text")),
        "compilation_titles": rows.where("compilation").select("title").distinct(),
    }


# --- decisions ----------------------------------------------------------------------------------------------------------


def decide(token_set: Column, token_sort: Column, two_stage: Column, t: Thresholds = Thresholds()) -> Column:
    """keep, review or prune from three scores: two strong ones with the two-stage among them, or one very strong one with two fair
    ones and the two-stage fair, keep; a fair best score is for review."""
    scores = [token_set, token_sort, two_stage]
    at_least = lambda x: sum(((s >= x).cast("int") for s in scores[1:]), (scores[0] >= x).cast("int"))
    keep = ((at_least(t.strong) >= 2) & (two_stage >= t.strong)) | ((at_least(t.one_strong) >= 1) & (at_least(t.two_fair) >= 2) & (two_stage >= t.two_fair))
    return F.when(keep, "keep").when(F.greatest(*scores) >= t.review, "review").otherwise("prune")


def by_score(score: Column, t: Thresholds = Thresholds()) -> Column:
    """keep, review or prune from one score; none prunes."""
    return F.when(score >= t.strong, "keep").when(score >= t.review, "review").otherwise("prune")


def _title_scores(rows: DataFrame, pairs: DataFrame, artist: str) -> DataFrame:
    """(artist, title, title_score): the best token set ratio (0..1) of each title among those of the artist in the given column; 0 without titles."""
    asked = rows.select(F.col(artist).alias("artist"), "title").distinct()
    shelf = pairs.select("artist", F.col("title").alias("shelf"))
    scored = asked.join(shelf, "artist").withColumn("s", F.when(F.col("title") == F.col("shelf"), 100.0).otherwise(token_set_ratio("title", "shelf")))
    best = scored.groupBy("artist", "title").agg((F.max("s") / 100).alias("title_score"))
    return asked.join(best, ["artist", "title"], "left").select(F.col("artist").alias(artist), "title", F.coalesce("title_score", F.lit(0.0)).alias("title_score"))


def known_artist(releases: DataFrame, index: dict[str, DataFrame], t: Thresholds = Thresholds()) -> DataFrame:
    """(id, artist, class, score) of releases (id, artist, title, format) whose artist the library has: an exact pair keeps unless its formats don't go
    with the release's; else the best title of the artist decides, and an artist without titles prunes."""
    pairs = index["pairs"].withColumn("_exact", F.lit(True))
    met = releases.join(pairs, ["artist", "title"], "left")
    exact = met.where("_exact").select("id", "artist", F.when(compatible(F.col("format"), F.col("formats"), F.col("any_format")), "keep").otherwise("prune").alias("class"), F.lit(1.0).alias("score"))
    rest = met.where("_exact is null").select("id", "artist", "title")
    scored = rest.join(_title_scores(rest, index["pairs"], "artist"), ["artist", "title"])
    return exact.unionByName(scored.select("id", "artist", by_score(F.col("title_score"), t).alias("class"), F.col("title_score").alias("score")))


def compilation(releases: DataFrame, index: dict[str, DataFrame], t: Thresholds = Thresholds()) -> DataFrame:
    """(id, class, score): a compilation (id, title) is kept if a compilation's title on the shelf is equal or much like it; never reviewed."""
    best = best_match(releases.select("title"), index["compilation_titles"], 100 * t.compilation)
    kept = releases.join(best.select(F.col("text").alias("title"), "score"), "title", "left")
    exact = releases.select("title").distinct().join(index["compilation_titles"], "title", "left_semi").withColumn("_same", F.lit(True))  # also a title without words
    out = kept.join(exact, "title", "left").withColumn("s", F.when(F.col("_same"), 1.0).otherwise(F.coalesce(F.col("score") / 100, F.lit(0.0))))
    return out.groupBy("id").agg(F.max("s").alias("score")).select("id", F.when(F.col("score") >= t.compilation, "keep").otherwise("prune").alias("class"), "score")


def fuzzy_artist(releases: DataFrame, index: dict[str, DataFrame], t: Thresholds = Thresholds()) -> DataFrame:
    """(id, artist, class, score, match) of releases (id, artist, title) by the one library artist most like theirs: that artist's own pair keeps, else the geometric
    mean of artist and best title score decides. An artist below the cutoff prunes."""
    best = best_match(releases.select("artist"), index["artists"], 100 * t.artist_cutoff).select(F.col("text").alias("artist"), "match", (F.col("score") / 100).alias("artist_score"))
    rows = cut_lineage(releases.join(best, "artist", "left"))
    matched = rows.where("match is not null")
    scored = matched.join(_title_scores(matched, index["pairs"], "match"), ["match", "title"])
    exact = index["pairs"].select(F.col("artist").alias("match"), "title", F.lit(True).alias("_exact"))
    scored = scored.join(exact, ["match", "title"], "left").withColumn("score", F.sqrt(F.col("artist_score") * F.col("title_score")))
    out = scored.select("id", "artist", F.when(F.col("_exact"), "keep").otherwise(by_score(F.col("score"), t)).alias("class"), "score", "match")
    return out.unionByName(rows.where("match is null").select("id", "artist", F.lit("prune").alias("class"), F.lit(0.0).alias("score"), F.lit(None).cast("string").alias("match")))


def routed(releases: DataFrame, index: dict[str, DataFrame], mappings: DataFrame | None = None) -> DataFrame:
    """(id, artist, title, format, compilation, route) of releases (id, artist_name, title_text, format): ``known`` artists are the library's or mapped to keep,
    ``mapped`` ones to prune, ``screened`` ones share no word of three letters with any library artist, the others go on as ``compilation`` or ``fuzzy``.

    The screen comes before the compilation test, so a compilation's credit passes only if the library has an artist with one of its words.
    """
    rows = releases.where("artist_name is not null and title_text is not null").select("id", match_artist(F.col("artist_name")).alias("artist"), match_title(F.col("title_text")).alias("title"), "format", is_compilation(F.col("artist_name")).alias("compilation"))
    known = index["artists"].withColumn("_known", F.lit(True))
    told = known.select("artist", F.lit(None).cast("string").alias("decision")).limit(0) if mappings is None else mappings.groupBy("artist").agg(F.min("decision").alias("decision"))
    words = index["artists"].select(F.explode(tokens(F.col("artist"))).alias("w")).distinct()
    names = rows.select("artist").distinct()
    passed = names.select("artist", F.explode(tokens(F.col("artist"))).alias("w")).join(words, "w", "left_semi").select("artist").distinct().withColumn("_passed", F.lit(True))
    route = (
        F.when(F.col("_known") | (F.col("decision") == "keep"), "known").when(F.col("decision") == "prune", "mapped").when(F.col("_passed").isNull(), "screened")
        .when(F.col("compilation"), "compilation").otherwise("fuzzy")
    )
    return rows.join(known, "artist", "left").join(told, "artist", "left").join(passed, "artist", "left").select("id", "artist", "title", "format", "compilation", route.alias("route"))


def classify_credits(releases: DataFrame, index: dict[str, DataFrame], mappings: DataFrame | None = None, t: Thresholds = Thresholds()) -> DataFrame:
    """(id, artist, class, phase, score): the decision on each release under each of its credits."""
    rows = cut_lineage(routed(releases, index, mappings))
    one = known_artist(rows.where("route = 'known'"), index, t).withColumn("phase", F.lit("known"))
    comp = rows.where("route = 'compilation'")
    comp = compilation(comp.select("id", "title"), index, t).join(comp.select("id", "artist").distinct(), "id").withColumn("phase", F.lit("compilation"))
    fuzzy = fuzzy_artist(rows.where("route = 'fuzzy'").select("id", "artist", "title"), index, t).drop("match").withColumn("phase", F.lit("fuzzy"))
    none = rows.where("route in ('mapped', 'screened')").select("id", "artist", F.lit("prune").alias("class"), F.lit(0.0).alias("score"), F.col("route").alias("phase"))
    out = one.unionByName(comp.select(one.columns)).unionByName(fuzzy.select(one.columns)).unionByName(none.select(one.columns))
    return out.select("id", "artist", "class", "phase", "score")


def classify(releases: DataFrame, index: dict[str, DataFrame], mappings: DataFrame | None = None, t: Thresholds = Thresholds()) -> DataFrame:
    """(id, class, phase) of releases (id, artist_name, title_text, format). An id with several credits has its best class: keep, then review, then prune."""
    return best_class(classify_credits(releases, index, mappings, t))


def best_class(credits: DataFrame) -> DataFrame:
    """(id, class, phase): keep over review over prune of the credits of each id; ties by phase."""
    rank = F.when(F.col("class") == "keep", 3).when(F.col("class") == "review", 2).otherwise(1)
    return credits.groupBy("id").agg(F.max(F.struct(rank.alias("r"), "phase", "class")).alias("b")).select("id", "b.class", "b.phase")


def pair_scores(pairs: DataFrame, index: dict[str, DataFrame], mappings: DataFrame | None = None, t: Thresholds = Thresholds()) -> DataFrame:
    """(artist, title, token_set, token_sort, two_stage, class) of single pairs (artist, title in linkage form), each held against the whole library: a mapped
    artist has its decision, an exact pair keeps, else the three scores decide."""
    asked = cut_lineage(pairs.select("artist", "title").dropna().distinct().withColumn("text", F.concat("artist", F.lit(SEPARATOR), "title")))
    scores = {s: best_match(asked.select("text"), index["combined"], scorer=s).select("text", (F.col("score") / 100).alias(f"token_{s}")) for s in ("set", "sort")}
    artist = best_match(asked.select("artist"), index["artists"], 100 * t.pair_cutoff).select(F.col("text").alias("artist"), "match", (F.col("score") / 100).alias("artist_score"))
    rows = cut_lineage(asked.join(artist, "artist", "left"))
    titled = _title_scores(rows.where("match is not null"), index["pairs"], "match")
    exact = index["pairs"].select("artist", "title", F.lit(True).alias("_exact"))
    told = exact.select("artist", F.lit(None).cast("string").alias("decision")).limit(0) if mappings is None else mappings.groupBy("artist").agg(F.min("decision").alias("decision"))
    out = rows.join(titled, ["match", "title"], "left").join(scores["set"], "text", "left").join(scores["sort"], "text", "left").join(exact, ["artist", "title"], "left").join(told, "artist", "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    ts, to, two = zero(F.col("token_set")), zero(F.col("token_sort")), zero(F.sqrt(F.col("artist_score") * F.col("title_score")))
    decision = F.when(F.col("decision").isNotNull(), F.col("decision")).when(F.col("_exact"), "keep").otherwise(decide(ts, to, two, t))
    return out.select("artist", "title", ts.alias("token_set"), to.alias("token_sort"), two.alias("two_stage"), decision.alias("class"))


# --- reports ------------------------------------------------------------------------------------------------------------


def review_by_artist(credits: DataFrame, index: dict[str, DataFrame], most: int = 50) -> DataFrame:
    """(artist, releases, best_score, best_match): artists with releases for review, those with most of them first; ties by name. A top-k report."""
    per = credits.where("class = 'review'").groupBy("artist").agg(F.count_distinct("id").alias("releases"), F.max("score").alias("best_score"))
    top = cut_lineage(per.orderBy(F.desc("releases"), "artist").limit(most))
    best = best_match(top.select("artist"), index["artists"]).select(F.col("text").alias("artist"), F.col("match").alias("best_match"))
    return top.join(best, "artist", "left").select("artist", "releases", "best_score", "best_match")


def class_report(classes: DataFrame, children: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(item, class, n): releases of each class, and the rows of each child table (with its release column) that go with them."""
    out = classes.groupBy("class").agg(F.count("*").alias("n")).select(F.lit("release").alias("item"), "class", "n")
    for name, (table, column) in children.items():
        rows = table.select(F.col(column).alias("id")).join(classes.select("id", "class"), "id")
        out = out.unionByName(rows.groupBy("class").agg(F.count("*").alias("n")).select(F.lit(name).alias("item"), "class", "n"))
    return out


def match_filter(releases: DataFrame, key: str, artist: Column, title: Column | None, library: DataFrame, lib_artist: Column, lib_title: Column | None) -> DataFrame:
    """(key): releases with a credited artist, or pair of artist and title, that the library has in the given forms."""
    left = releases.select(key, artist.alias("a"), *([title.alias("t")] if title is not None else []))
    right = library.select(lib_artist.alias("a"), *([lib_title.alias("t")] if lib_title is not None else [])).distinct()
    return left.join(right, right.columns, "left_semi").select(key).distinct()


# --- audit of pruned releases -------------------------------------------------------------------------------------------


def substring_variant(a: Column, b: Column, least: int = 4) -> Column:
    """Whether one text holds the other, the shorter one of ``least`` letters or more and not equal."""
    return F.coalesce((a != b) & (F.least(F.length(a), F.length(b)) >= least) & (a.contains(b) | b.contains(a)), F.lit(False))


def title_outcome(score: Column, t: Thresholds = Thresholds()) -> Column:
    """Why a pruned release of a library artist missed, by its best title's score."""
    return F.when(score >= t.strong, "exact_artist_title_above_keep_on_rescore").when(score >= t.review, "exact_artist_rescore_review").otherwise("title_miss")


def fuzzy_outcome(artist_score: Column, combined: Column, variant: Column, t: Thresholds = Thresholds()) -> Column:
    """Why a pruned release of another artist missed, by the score of its most alike library artist and of both together."""
    near = (combined >= t.review) & (combined < t.strong)
    return (
        F.when(artist_score.isNull(), "empty_library").when(artist_score < t.artist_cutoff, "no_artist_match").when(near, "near_keep_threshold").when(variant, "substring_variant")
        .when(combined >= t.strong, "scores_above_keep_on_rescore").otherwise("weak_match")
    )


#: Outcomes that say that the release should perhaps have been kept.
CANDIDATE_MISSES = ("exact_artist_title_above_keep_on_rescore", "exact_artist_rescore_review", "near_keep_threshold", "substring_variant", "scores_above_keep_on_rescore")


def audit(pruned: DataFrame, index: dict[str, DataFrame], t: Thresholds = Thresholds()) -> DataFrame:
    """(id, artist, phase, call, mechanism, artist_score, title_score, combined) of pruned releases (id, artist_name, title_text), scored anew in the way in
    which they were pruned: by title under a library artist, else by the most alike artist and its titles."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = cut_lineage(pruned.select("id", match_artist(text("artist_name")).alias("artist"), match_title(text("title_text")).alias("title")))
    owners = index["pairs"].select("artist").distinct()
    exact = rows.join(owners, "artist", "left_semi")
    pair = index["pairs"].select("artist", "title", F.lit(True).alias("_pair"))
    one = exact.join(_title_scores(exact, index["pairs"], "artist"), ["artist", "title"]).join(pair, ["artist", "title"], "left")
    one = one.select("id", "artist", F.lit("exact").alias("phase"), F.when(F.col("_pair"), "format_mismatch").otherwise(title_outcome(F.col("title_score"), t)).alias("mechanism"), F.lit(1.0).alias("artist_score"), "title_score", F.col("title_score").alias("combined"))
    rest = rows.join(owners, "artist", "left_anti")
    best = best_match(rest.select("artist"), index["artists"]).select(F.col("text").alias("artist"), "match", (F.col("score") / 100).alias("artist_score"))
    rest = cut_lineage(rest.join(best, "artist", "left"))
    scored = rest.join(_title_scores(rest.where("match is not null"), index["pairs"], "match"), ["match", "title"], "left").withColumn("title_score", F.coalesce("title_score", F.lit(0.0)))
    some = index["artists"].limit(1).count() > 0
    artist_score = F.coalesce("artist_score", F.lit(0.0) if some else F.lit(None).cast("double"))
    combined = F.sqrt(F.coalesce("artist_score", F.lit(0.0)) * F.col("title_score"))
    two = scored.select("id", "artist", F.lit("fuzzy").alias("phase"), fuzzy_outcome(artist_score, combined, substring_variant(F.col("artist"), F.col("match")), t).alias("mechanism"), F.coalesce("artist_score", F.lit(0.0)).alias("artist_score"), "title_score", combined.alias("combined"))
    call = F.when(F.col("mechanism").isin(*CANDIDATE_MISSES), "candidate_false_negative").otherwise("true_reject")
    return one.unionByName(two).select("id", "artist", "phase", call.alias("call"), "mechanism", "artist_score", "title_score", "combined")


def miss_rate(audited: DataFrame) -> DataFrame:
    """(sample_size, misses, rate, low, high): the share of candidate misses with its Wilson interval; zeros for no rows."""
    c = audited.agg(F.count("*").alias("n"), F.count_if(F.col("call") == "candidate_false_negative").alias("hits"))
    w = wilson(F.col("hits").cast("double"), F.col("n").cast("double"))
    return c.select(F.col("n").alias("sample_size"), F.col("hits").alias("misses"), F.coalesce(F.col("hits") / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0)).alias("rate"), F.coalesce(w["low"], F.lit(0.0)).alias("low"), F.coalesce(w["high"], F.lit(0.0)).alias("high"))


def miss_mechanisms(audited: DataFrame) -> DataFrame:
    """(mechanism, n) of the candidate misses."""
    return audited.where("call = 'candidate_false_negative'").groupBy("mechanism").agg(F.count("*").alias("n"))


# --- names under a wrong id ---------------------------------------------------------------------------------------------


def collision_candidates(titles: DataFrame, releases: DataFrame, credits: DataFrame, most: int = 10) -> DataFrame:
    """(name, title, release_id, artist_id, score): for each title (name, title, wrong_id) of a name filed under the wrong artist the releases it may be: those
    credited to exactly that name with titles alike to more than 0.3, or, where there are none, those of any artist with titles alike to 0.5 or more;
    the ``most`` alike ones, ties by release and artist. Releases of the wrong artist don't count. ``releases`` (id, title), ``credits`` (release_id,
    artist_id, artist_name)."""
    from crateflow.functions.trigram import similarity, weighted

    asked = titles.select("name", "title", "wrong_id").distinct()
    named = credits.select("release_id", "artist_id", "artist_name").distinct().join(releases.select(F.col("id").alias("release_id"), F.col("title").alias("found")), "release_id")
    mine = asked.withColumn("_n", F.lower("name"))
    theirs = named.withColumn("_n", F.lower(F.substring("artist_name", 1, 200)))
    near = similarity_join_within(mine, theirs, "_n", "title", "found", 0.3)
    own = cut_lineage(mine.join(_first_rows(near, theirs, ["_n", "title"], ["_n", "found"], most), ["_n", "title"]).drop("_n"))
    lost = asked.join(own.select("name", "title"), ["name", "title"], "left_anti")
    alike = similarity_join(lost, named, "title", "found", 0.5, inclusive=True)
    any_ = lost.join(_first_rows(alike, named, ["title"], ["found"], most), "title")
    columns = ["name", "title", "wrong_id", *_ORDER, "similarity"]
    both = own.select(*columns, F.lit(True).alias("_own")).unionByName(any_.select(*columns, F.lit(False).alias("_own")))
    top = _top(both, ["name", "title"], [F.desc("similarity"), *_ORDER], most).where("wrong_id is null or artist_id is null or artist_id <> wrong_id")
    # Names are compared last, for the rows that are left.
    artist_sim = F.when(F.col("_own"), 1.0).otherwise(similarity(F.col("name"), F.col("artist_name")))
    return top.select("name", "title", "release_id", "artist_id", weighted(F.col("similarity"), artist_sim).alias("score"))


#: The order of rows that are equally alike.
_ORDER = ["release_id", "artist_id", "artist_name"]


def _top(rows: DataFrame, keys: list[str], order: list, most: int) -> DataFrame:
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_r") <= most).drop("_r")


def _first_rows(pairs: DataFrame, rows: DataFrame, keys: list[str], on: list[str], most: int) -> DataFrame:
    """The ``most`` rows of each of the keys: ``pairs`` (keys, found, similarity) with the rows of their text (``on``), the alike ones first, then by ``_ORDER``.
    A text has a row of its own to put before those of the texts behind it, so no more than the first ``most`` texts of a key, by likeness and first row,
    and rows of a text are joined."""
    first = rows.groupBy(*on).agg(F.min(F.struct(*_ORDER)).alias("_first"))
    texts = _top(pairs.join(first, on), keys, [F.desc("similarity"), "_first", "found"], most).drop("_first")
    return _top(texts.join(_top(rows, on, _ORDER, most), on), keys, [F.desc("similarity"), *_ORDER], most)


def resolve_collisions(names: DataFrame, candidates: DataFrame, threshold: float = 0.55, fair: float = 0.40) -> DataFrame:
    """(name, status, artist_id, release_id, score, hits) of each name: its best artist is the one with most candidates (name, artist_id, release_id, score), then
    with the best score, then the least id. It is resolved by a score of ``threshold`` or by two hits; else ambiguous where its score is fair, whether or not
    another artist comes near; else unresolved, as a name without candidates is."""
    per = candidates.groupBy("name", "artist_id").agg(F.count("*").alias("hits"), F.max(F.struct("score", (-F.col("release_id")).alias("_r"))).alias("m")).select("name", "artist_id", "hits", "m.score", (-F.col("m._r")).alias("release_id"))
    order = Window.partitionBy("name").orderBy(F.desc("hits"), F.desc("score"), F.asc_nulls_last("artist_id"))
    best = per.withColumn("_r", F.row_number().over(order)).where("_r = 1")
    status = F.when((F.col("score") >= threshold) | (F.col("hits") > 1), "RESOLVED").when(F.col("score") >= fair, "AMBIGUOUS").otherwise("UNRESOLVED")
    return names.select("name").distinct().join(best, "name", "left").select("name", status.alias("status"), "artist_id", "release_id", "score", F.coalesce("hits", F.lit(0)).alias("hits"))
