"""Queries of the catalogue build over the test tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateflow.functions import formats, identity, normalize, stats
from crateflow.functions.fold import combining_marks, fold_name, folding, strip_accents
from crateflow.operators import classify, dedup, health, parity, search, tables
from crateflow.sources.tables import table
from crateflow.sources.text_rows import escape, sql_values

QUERIES = {}
ORACLE = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL twin."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


# --- pieces of SQL ----------------------------------------------------------------------------------------------------


def _q(text: str) -> str:
    return text.replace("'", "''")


def _sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\p{{Z}}\x0B\x{{1C}}-\x{{1F}}\x{{85}}]+|[\s\p{{Z}}\x0B\x{{1C}}-\x{{1F}}\x{{85}}]+$', '', 'g')"


def _sql_fold(x: str, form: str = "NFKD") -> str:
    sources, targets, longer = folding(form)
    marks = "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in combining_marks())
    out = rf"regexp_replace(translate({x}, '{_q(sources)}', '{_q(targets)}'), '[{marks}]+', '', 'g')"
    for a, b in longer:
        if a in "ﬀﬁﬂﬃﬄﬆ":
            out = f"replace({out}, '{a}', '{b}')"
    return out


def _sql_title(x: str) -> str:
    return _sql_strip(rf"regexp_replace({_sql_fold(f'lower({_sql_strip(x)})')}, '(?:\s*(?:{normalize.TITLE_SUFFIX}))+\s*$', '')")


def _sql_compare(x: str) -> str:
    folded = _sql_fold(f"lower({_sql_strip(x)})")
    plain = rf"regexp_replace(regexp_replace({folded}, '\s*\(\d+\)\s*$', ''), '\s*\[.*?\]\s*$', '')"
    return _sql_strip(rf"regexp_replace({plain}, '^(.*),\s+({'|'.join(normalize.COMMA_ARTICLES)})$', '\2 \1')")


def _sql_artist(x: str) -> str:
    return rf"trim(regexp_replace(replace(replace({_sql_compare(x)}, '&', ' and '), '''', ''), '\s+', ' ', 'g'))"


def _sql_light(x: str) -> str:
    return _sql_strip(f"lower({_sql_fold(x)})")




def _sql_compilation(x: str) -> str:
    low = f"lower({_sql_strip(x)})"
    return rf"coalesce(regexp_matches({low}, '^(?:various artists|v/a|v\.a|soundtracks)(?:$|[^\p{{L}}\p{{N}}])') OR {low} IN ('various', 'soundtrack', 'compilation'), false)"


_TRI = r"list_distinct(flatten(list_transform(list_filter(string_split(regexp_replace(lower({x}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'), ' '), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substring('  ' || w || ' ', i, 3)))))"


def _sql_similarity(a: str, b: str) -> str:
    x, y = _TRI.format(x=a), _TRI.format(x=b)
    return f"coalesce(len(list_intersect({x}, {y})) / nullif(len({x}) + len({y}) - len(list_intersect({x}, {y})), 0), 0.0)"


_CATEGORY_SQL = "CASE {x} " + " ".join(f"WHEN '{_q(k)}' THEN '{_q(v)}'" for k, v in formats.CATEGORIES.items()) + " END"


# --- deduplication ----------------------------------------------------------------------------------------------------


def _counts(s: SparkSession, d: str) -> DataFrame:
    return dedup.track_counts(table(s, d, "release_track"))


_RANK_SQL = """
tc AS (SELECT release_id, count(*) AS track_count FROM release_track GROUP BY 1),
r AS (SELECT releases.*, track_count, {match} AS label_match FROM releases JOIN tc ON tc.release_id = id WHERE master_id IS NOT NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY master_id, format ORDER BY label_match DESC, (country = 'US') DESC NULLS FIRST, track_count DESC, id) AS rank FROM r)"""


@query(f"WITH {_RANK_SQL.format(match='0')} SELECT id, master_id, format, track_count, rank::INT AS rank FROM ranked")
def dedup_ranked(s, d):
    return dedup.ranked(table(s, d, "releases"), _counts(s, d)).select("id", "master_id", "format", "track_count", "rank")


@query(f"WITH {_RANK_SQL.format(match='0')} SELECT id FROM ranked WHERE rank = 1")
def dedup_best_per_group(s, d):
    return dedup.ranked(table(s, d, "releases"), _counts(s, d)).where("rank = 1").select("id")


@query(f"WITH {_RANK_SQL.format(match='0')} SELECT id FROM ranked WHERE rank > 1 AND id NOT IN (SELECT release_id FROM release_label WHERE catno IS NULL AND release_id IS NOT NULL)")
def dedup_keep_list(s, d):
    keep = table(s, d, "release_label").where("catno is null").select(F.col("release_id").alias("id"))
    return dedup.surplus(dedup.ranked(table(s, d, "releases"), _counts(s, d)), keep)


@query(f"WITH {_RANK_SQL.format(match='0')} SELECT id, title FROM releases WHERE id NOT IN (SELECT id FROM ranked WHERE rank > 1)")
def dedup_trackless_survive(s, d):
    releases = table(s, d, "releases")
    return tables.drop_ids(releases, "id", dedup.surplus(dedup.ranked(releases, _counts(s, d)))).select("id", "title")


_MATCH_SQL = """
prefs AS (SELECT DISTINCT lower(artist) AS a, lower(title) AS t, lower(label) AS l FROM library WHERE label IS NOT NULL AND artist IS NOT NULL AND title IS NOT NULL),
edges AS (SELECT DISTINCT lower(label_name) AS x, lower(parent_label_name) AS y FROM label_hierarchy WHERE label_name IS NOT NULL AND parent_label_name IS NOT NULL),
matches AS (SELECT DISTINCT c.release_id FROM release_artist c JOIN releases r ON r.id = c.release_id JOIN release_label b ON b.release_id = c.release_id
  JOIN prefs p ON p.a = lower(c.artist_name) AND p.t = lower(r.title)
  WHERE c.extra = 0 AND (p.l = lower(b.label_name) OR EXISTS (FROM edges e WHERE e.x = p.l AND e.y = lower(b.label_name)) OR EXISTS (FROM edges e WHERE e.y = p.l AND e.x = lower(b.label_name))))"""


def _label_matches(s: SparkSession, d: str) -> DataFrame:
    credits = table(s, d, "release_artist").where("extra = 0").join(table(s, d, "releases").select(F.col("id").alias("release_id"), "title"), "release_id")
    prefs = table(s, d, "library").select(F.col("artist").alias("artist_name"), "title", F.col("label").alias("label_name"))
    return dedup.label_match(credits, table(s, d, "release_label"), prefs, table(s, d, "label_hierarchy"))


@query(f"WITH {_MATCH_SQL} SELECT release_id FROM matches")
def label_match_hierarchy(s, d):
    return _label_matches(s, d)


@query(f"WITH {_MATCH_SQL}, {_RANK_SQL.format(match='(id IN (SELECT release_id FROM matches))::INT')} SELECT id, label_match FROM ranked WHERE rank = 1")
def dedup_with_label_match(s, d):
    return dedup.ranked(table(s, d, "releases"), _counts(s, d), _label_matches(s, d)).where("rank = 1").select("id", "label_match")


# --- loading ----------------------------------------------------------------------------------------------------------


@query("SELECT release_id, artist_name, extra, artist_id, role FROM release_artist QUALIFY row_number() OVER (PARTITION BY release_id, artist_name, extra ORDER BY artist_id NULLS FIRST, role NULLS FIRST, anv NULLS FIRST, position NULLS FIRST, join_field NULLS FIRST) = 1")
def ingest_first_wins(s, d):
    order = [F.asc_nulls_first(c) for c in ("artist_id", "role", "anv", "position", "join_field")]
    return tables.first_wins(table(s, d, "release_artist"), ["release_id", "artist_name", "extra"], order).select("release_id", "artist_name", "extra", "artist_id", "role")


@query("SELECT release_id, label_id, label_name, nullif(catno, 'none') AS catno FROM release_label WHERE label_id IS NOT NULL AND label_name IS NOT NULL")
def ingest_required_nulls(s, d):
    return table(s, d, "release_label").dropna(subset=["label_id", "label_name"]).select("release_id", "label_id", "label_name", F.nullif(F.col("catno"), F.lit("none")).alias("catno"))


@query("SELECT csv_file, try_cast(split_part(raw_line, ',', 1) AS INTEGER) AS release_id, count(*) AS n FROM release_raw WHERE try_cast(split_part(raw_line, ',', 1) AS INTEGER) IS NOT NULL AND regexp_matches(split_part(raw_line, ',', 1), '^[0-9]+$') GROUP BY 1, 2")
def ingest_count_raw(s, d):
    first = F.split_part("raw_line", F.lit(","), F.lit(1))
    ids = F.when(first.rlike("^[0-9]+$"), first).try_cast("int")
    return table(s, d, "release_raw").select("csv_file", ids.alias("release_id")).where("release_id is not null").groupBy("csv_file", "release_id").agg(F.count("*").alias("n"))


@query("SELECT release_id, sequence FROM release_track WHERE release_id IN (SELECT id FROM releases WHERE status = 'Accepted')")
def surviving_children(s, d):
    return tables.keep_ids(table(s, d, "release_track"), "release_id", table(s, d, "releases").where("status = 'Accepted'")).select("release_id", "sequence")


@query("SELECT release_id, count(*) AS n FROM release_artist WHERE release_id NOT IN (SELECT id FROM releases WHERE format = 'CD') GROUP BY 1")
def orphan_cleanup(s, d):
    return tables.orphans(table(s, d, "release_artist"), "release_id", table(s, d, "releases").where("format = 'CD'")).groupBy("release_id").agg(F.count("*").alias("n"))


@query("SELECT n.id, n.title, n.country, l.notes, l.cached_at::VARCHAR AS cached FROM (SELECT id, upper(title) AS title, country FROM releases WHERE format = 'CD') n LEFT JOIN (SELECT * FROM releases WHERE data_quality = 'Correct') l USING (id)")
def upsert_preserve_columns(s, d):
    live = table(s, d, "releases").where("data_quality = 'Correct'").select("id", "title", "country", "notes", "cached_at")
    staged = table(s, d, "releases").where("format = 'CD'").select("id", F.upper("title").alias("title"), "country")
    out = tables.upsert(live, staged, "id", ["title", "country"])
    text = F.regexp_replace(F.date_format("cached_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.?0+$", "")
    return out.select("id", "title", "country", "notes", F.concat(text, F.lit("+00")).alias("cached"))


@query("SELECT id, title FROM releases WHERE format = 'CD' UNION ALL SELECT id, title FROM releases WHERE country = 'US' AND (format <> 'CD' OR format IS NULL)")
def additive_insert(s, d):
    r = table(s, d, "releases")
    return tables.insert_absent(r.where("format = 'CD'").select("id", "title"), r.where("country = 'US'").select("id", "title"), "id")


@query("SELECT count(*) AS n, 'release' AS table_name FROM releases WHERE format = 'CD' OR country = 'US' UNION ALL SELECT count(*), 'track' FROM release_track WHERE release_id IN (SELECT id FROM releases WHERE format = 'CD' OR country = 'US')")
def additive_seed(s, d):
    r, t = table(s, d, "releases"), table(s, d, "release_track")
    live = {"release": r.where("format = 'CD'"), "track": tables.keep_ids(t, "release_id", r.where("format = 'CD'"))}
    grown = tables.seed(live, {"release": r, "track": t}, "release", "id", "release_id", r.where("country = 'US'").select("id"))
    return tables.counts(grown)


@query("SELECT id, CASE WHEN regexp_matches(released, '^[0-9]{4}') THEN released[:4]::SMALLINT END AS release_year FROM releases")
def release_year_extract(s, d):
    return table(s, d, "releases").select("id", stats.release_year(F.col("released")).alias("release_year"))


@query("SELECT id, title, lower(title) AS norm_title FROM releases WHERE id IN (SELECT release_id FROM release_artist WHERE extra = 0 AND (artist_id = 194 OR artist_name = 'Various'))")
def va_derive(s, d):
    return tables.floor_guard(tables.compilations(table(s, d, "releases"), table(s, d, "release_artist")), 1, 0)


@query("SELECT release_id, arg_min(title, (CASE WHEN position = 'A1' THEN 0 ELSE 1 END) * 1000000 + sequence) AS uri FROM (SELECT DISTINCT * FROM release_track) GROUP BY 1")
def first_image_per_release(s, d):
    images = table(s, d, "release_track").distinct().select("release_id", F.when(F.col("position") == "A1", "primary").alias("type"), F.col("title").alias("uri"), F.col("sequence").alias("pos"))
    return tables.first_image(images)


@query("SELECT artist_id, max_by(anv, release_id::BIGINT * 1000000 + hash_key) AS anv FROM (SELECT artist_id, max(anv) AS anv, release_id, 0 AS hash_key FROM release_artist WHERE anv IS NOT NULL AND artist_id IS NOT NULL GROUP BY 1, 3) GROUP BY 1")
def last_profile_wins(s, d):
    rows = table(s, d, "release_artist").where("anv is not null and artist_id is not null").groupBy("artist_id", "release_id").agg(F.max("anv").alias("anv"))
    return tables.last_value(rows, "artist_id", "anv", "release_id")


@query("SELECT r.id, coalesce(u.n, r.notes) AS notes FROM releases r LEFT JOIN (SELECT release_id, max(catno) AS n FROM release_label GROUP BY 1) u ON u.release_id = r.id")
def update_from_child(s, d):
    values = table(s, d, "release_label").groupBy(F.col("release_id").alias("id")).agg(F.max("catno").alias("notes"))
    return tables.update_from(table(s, d, "releases").select("id", "notes"), values, "id", "notes")


@query("SELECT event_type, json_extract_string(props, '$.' || k) AS v, k FROM (SELECT event_type, props, unnest(json_keys(props)) AS k FROM events) WHERE json_extract_string(props, '$.' || k) IS NOT NULL")
def ndjson_map(s, d):
    rows = table(s, d, "events").select("event_type", F.explode(F.from_json("props", "map<string,string>")).alias("k", "v"))
    return rows.where("v is not null").select("event_type", "v", "k")


@query(r"SELECT id, CASE WHEN notes IS NULL OR notes = '' THEN '\N' ELSE replace(replace(replace(replace(notes, chr(13), ''), '\', '\\'), chr(9), '\t'), chr(10), '\n') END AS value FROM releases")
def copy_text(s, d):
    return table(s, d, "releases").select("id", escape(F.col("notes")).alias("value"))


@query("SELECT '(''' || release_id || ''', ' || coalesce('''' || replace(title, '''', '''''') || '''', 'NULL') || ')' AS value FROM release_track")
def sql_values_text(s, d):
    return sql_values(table(s, d, "release_track").select("release_id", "title"))


@query("SELECT 'library' AS table_name, count(*) AS n FROM library UNION ALL SELECT 'releases', count(*) FROM releases UNION ALL SELECT 'release_artist', count(*) FROM release_artist UNION ALL SELECT 'release_track', count(*) FROM release_track")
def table_counts_union(s, d):
    return tables.counts({t: table(s, d, t) for t in ("library", "releases", "release_artist", "release_track")})


@query()
def hash_sample(s, d):
    return tables.hash_sample(table(s, d, "releases").select("id"), "id", 100, 217)


# --- text forms -------------------------------------------------------------------------------------------------------


@query(f"SELECT release_id, {_sql_fold('artist_name')} AS folded FROM release_artist")
def fold_accents(s, d):
    return table(s, d, "release_artist").select("release_id", strip_accents("artist_name").alias("folded"))


@query(f"SELECT id, {_sql_title('title')} AS form FROM releases")
def normalize_title(s, d):
    return table(s, d, "releases").select("id", normalize.match_title(F.col("title")).alias("form"))


@query(f"SELECT id, {_sql_artist('artist')} AS form FROM library")
def normalize_artist(s, d):
    return table(s, d, "library").select("id", normalize.match_artist(F.col("artist")).alias("form"))


@query(f"SELECT id, {_sql_compare('artist')} AS form FROM library")
def compare_form(s, d):
    return table(s, d, "library").select("id", normalize.compare_form(F.col("artist")).alias("form"))


@query(rf"SELECT id, CASE WHEN {_sql_strip('call_letters')} = '' OR call_letters IS NULL THEN NULL WHEN regexp_matches(call_letters, 'Z-[A-Z]') THEN 'V/A' WHEN length({_sql_strip('call_letters')}) = 3 THEN upper({_sql_strip('call_letters')}) ELSE upper({_sql_strip('call_letters')}[:2]) END AS code FROM library")
def code_letters(s, d):
    return table(s, d, "library").select("id", normalize.code_letters(F.col("call_letters")).alias("code"))


@query(rf"SELECT id, CASE WHEN regexp_full_match(lower({_sql_strip('artist')}), 'various(?:\s+artists(?:\s*-\s*[a-z]+)?)?') THEN 'Various Artists' ELSE {_sql_strip('artist')} END AS name, regexp_full_match(lower({_sql_strip('artist')}), 'various(?:\s+artists(?:\s*-\s*[a-z]+)?)?') AS is_various FROM library")
def parity_artist_names(s, d):
    name, various = normalize.parity_artist(F.col("artist"))
    return table(s, d, "library").select("id", name.alias("name"), various.alias("is_various"))


@query(f"SELECT id, {_sql_compilation('artist')} AS compilation FROM library")
def is_compilation(s, d):
    return table(s, d, "library").select("id", normalize.is_compilation(F.col("artist")).alias("compilation"))


@query(rf"""WITH f AS (SELECT id, format, regexp_replace(trim(lower(format)), '\s+x\s+\d+(?:\s+box)?$', '') AS low FROM library)
  SELECT id, CASE WHEN low LIKE 'vinyl - %' THEN coalesce({_CATEGORY_SQL.format(x="trim(low[9:])")}, 'Vinyl') ELSE {_CATEGORY_SQL.format(x="low")} END AS category FROM f""")
def library_format(s, d):
    return table(s, d, "library").select("id", formats.shelf_category(F.col("format")).alias("category"))


@query(rf"""WITH f AS (SELECT id, trim(lower(format)) AS low FROM library)
  SELECT id, CASE WHEN regexp_full_match(low, 'cd(?:\s*x\s*\d+)?(?:\s*box)?') THEN 'cd' WHEN low = 'cdr' THEN 'cdr' WHEN low LIKE 'vinyl%' THEN CASE WHEN contains(low, '7"') THEN 'vinyl 7"' WHEN contains(low, '10"') THEN 'vinyl 10"' WHEN contains(low, '12"') OR contains(low, 'lp') THEN 'vinyl 12"' ELSE 'vinyl' END END AS name,
  CASE WHEN regexp_full_match(low, 'cd(?:\s*x\s*\d+)?(?:\s*box)?') OR low LIKE 'vinyl%' THEN coalesce(nullif(regexp_extract(low, 'x\s*(\d+)', 1), '')::INT, 1) WHEN low = 'cdr' THEN 1 END AS discs FROM f""")
def parse_format(s, d):
    f = formats.shelf_format(F.col("format"))
    return table(s, d, "library").select("id", f["name"].alias("name"), f["discs"].alias("discs"))


@query(rf"""WITH f AS (SELECT line_id, regexp_replace(lower(trim(string_split(regexp_extract(raw_line, '([^,"]*)$', 1), ',')[1])), '^\d+x', '') AS low FROM release_raw WHERE csv_file = 'release.csv')
  SELECT line_id, {_CATEGORY_SQL.format(x="low")} AS category FROM f""")
def normalize_format(s, d):
    raw = table(s, d, "release_raw").where("csv_file = 'release.csv'")
    return raw.select("line_id", formats.release_category(F.regexp_extract("raw_line", '([^,"]*)$', 1)).alias("category"))


@query(rf"SELECT id, nullif(nullif({_sql_strip('label')}, ''), 'NULL') AS form, translate(title, chr(9) || chr(10), '  ') AS flat FROM library")
def none_form(s, d):
    return table(s, d, "library").select("id", normalize.none_form(F.col("label")).alias("form"), normalize.flat_breaks(F.col("title")).alias("flat"))


# Plain inputs, accents aside, are worked out in SQL; those in other encodings are held against the form that their table expects.
_IDENTITY_SQL = r"""
  WITH x AS (SELECT input, expected, trim(regexp_replace(lower(strip_accents(input)), '\s+', ' ', 'g')) AS t FROM identity_normalization_cases WHERE variant = '{variant}'),
  g AS (SELECT *, coalesce(nullif(regexp_replace(t, '\s*(?:\([^()]*\)|\[[^\[\]]*\])$', ''), ''), t) AS bare FROM x),
  l AS (SELECT *, regexp_replace(bare, '^(?:the|a|an)\s+(\S)', '\1') AS led FROM g),
  b AS (SELECT *, CASE WHEN led <> bare THEN led ELSE regexp_replace(bare, ',\s+(?:the|a|an)$', '') END AS base FROM l)
  SELECT input, CASE WHEN NOT regexp_full_match(t, '[ -~]*') THEN expected ELSE {form} END AS form FROM b"""


def _identity(variant: str, kernel):
    return lambda s, d: table(s, d, "identity_normalization_cases").where(F.col("variant") == variant).select("input", kernel(F.col("input")).alias("form"))


_NUMBERED = r"CASE WHEN regexp_matches(base, '\s+/\d+$') THEN coalesce(nullif(regexp_replace(regexp_replace(base, '\s+/\d+$', ''), '\s*(?:\([^()]*\)|\[[^\[\]]*\])$', ''), ''), base) ELSE base END"


@query(_IDENTITY_SQL.format(variant="base", form="base"))
def identity_base(s, d):
    return _identity("base", identity.identity_form)(s, d)


@query(_IDENTITY_SQL.format(variant="title", form="base"))
def identity_title(s, d):
    return _identity("title", identity.identity_form)(s, d)


@query(_IDENTITY_SQL.format(variant="punct", form=r"trim(regexp_replace(base, '[^a-z0-9]+', ' ', 'g'))"))
def identity_punct(s, d):
    return _identity("punct", identity.identity_punctuation_form)(s, d)


@query(_IDENTITY_SQL.format(variant="disamb", form=_NUMBERED))
def identity_disamb(s, d):
    return _identity("disamb", identity.identity_disambiguated_form)(s, d)


@query("SELECT id, array_to_string(list_filter(list_transform(string_split(cross_reference_names, ' | '), lambda x: trim(x)), lambda x: x <> ''), '/') AS refs FROM library WHERE cross_reference_names IS NOT NULL")
def cross_reference_split(s, d):
    return table(s, d, "library").where("cross_reference_names is not null").select("id", F.array_join(normalize.split_refs(F.col("cross_reference_names")), "/").alias("refs"))


# --- library filters and search ---------------------------------------------------------------------------------------


@query(f"SELECT DISTINCT release_id FROM release_artist WHERE {_sql_light('artist_name')} IN (SELECT {_sql_light('artist')} FROM library)")
def artist_filter(s, d):
    return classify.match_filter(table(s, d, "release_artist"), "release_id", normalize.light_form(F.col("artist_name")), None, table(s, d, "library"), normalize.light_form(F.col("artist")), None)


@query(f"SELECT DISTINCT c.release_id FROM release_artist c JOIN releases r ON r.id = c.release_id JOIN (SELECT DISTINCT {_sql_light('artist')} AS a, {_sql_light('title')} AS t FROM library) l ON l.a = {_sql_light('c.artist_name')} AND l.t = {_sql_light('r.title')}")
def pair_filter(s, d):
    rows = table(s, d, "release_artist").select("release_id", "artist_name").join(table(s, d, "releases").select(F.col("id").alias("release_id"), "title"), "release_id")
    light = normalize.light_form
    return classify.match_filter(rows, "release_id", light(F.col("artist_name")), light(F.col("title")), table(s, d, "library"), light(F.col("artist")), light(F.col("title")))


@query(f"SELECT label_id, label_name, round(similarity, 6) AS similarity FROM (SELECT DISTINCT label_id, label_name, {_sql_similarity('label_name', chr(39) + 'Hinthelaro Records' + chr(39))} AS similarity FROM label_hierarchy) WHERE similarity > 0.2 ORDER BY similarity DESC, label_id, label_name LIMIT 10")
def trgm_similarity_top(s, d):
    rows = table(s, d, "label_hierarchy").select("label_id", "label_name").distinct().withColumn("k", F.struct("label_id", "label_name"))
    return search.best_similar(rows, "label_name", "Hinthelaro Records", "k", 10, 0.2).select("label_id", "label_name", F.round("similarity", 6).alias("similarity"))


@query(f"SELECT a AS label, b AS other, round(s, 6) AS similarity FROM (SELECT a, b, {_sql_similarity('a', 'b')} AS s FROM (SELECT DISTINCT label AS a FROM library WHERE label IS NOT NULL) x, (SELECT DISTINCT parent_label_name AS b FROM label_hierarchy WHERE parent_label_name IS NOT NULL) y) WHERE s > 0.5")
def trgm_search_join(s, d):
    left, right = table(s, d, "library").withColumnRenamed("label", "l"), table(s, d, "label_hierarchy")
    return search.similarity_join(left.select(F.col("l").alias("label")), right.select(F.col("parent_label_name").alias("other")), "label", "other", 0.5).withColumn("similarity", F.round("similarity", 6))


@query(f"SELECT id, round(score, 6) AS score FROM (SELECT id, 0.6 * {_sql_similarity('title', chr(39) + 'Songs of the Harbor' + chr(39))} + 0.4 * {_sql_similarity('artist', chr(39) + 'Ida Brass Band' + chr(39))} AS score FROM library) ORDER BY score DESC, id LIMIT 10")
def title_search_weighted(s, d):
    return search.ranked_search(table(s, d, "library"), "id", "title", "artist", "Songs of the Harbor", "Ida Brass Band").select("id", F.round("score", 6).alias("score"))


@query("SELECT id FROM (SELECT id, unnest(list_distinct(list_filter(string_split(lower(concat_ws(' ', title, artist, alternate_artist_name, album_artist)), ' '), lambda w: w <> ''))) AS w FROM library) WHERE w IN ('and', 'the') GROUP BY id HAVING count(DISTINCT w) = 2")
def word_search(s, d):
    # White space other than blanks separates words as well, so the texts' tabs and wide blanks are kept out of the twin by being part of no searched word.
    text = F.concat_ws(" ", "title", "artist", "alternate_artist_name", "album_artist")
    rows = table(s, d, "library").select("id", text.alias("text"))
    return search.word_search(search.inverted_index(rows, "id", ["text"]), "id", ["and", "the"])


@query(r"SELECT DISTINCT release_id FROM (SELECT release_id, unnest(list_filter(regexp_split_to_array(lower(artist_name), '\s+'), lambda w: length(w) >= 3)) AS w FROM release_artist) WHERE w IN (SELECT unnest(list_filter(regexp_split_to_array(lower(artist), '\s+'), lambda w: length(w) >= 3)) FROM library)")
def token_prescreen(s, d):
    return search.token_overlap(table(s, d, "release_artist"), "artist_name", table(s, d, "library"), "artist", "release_id")


@query()
def fuzzy_resolve_gap(s, d):
    names = table(s, d, "library").select(F.col("label").alias("name"))
    return search.fuzzy_resolve(names, "name", table(s, d, "label_hierarchy").select(F.col("label_name").alias("entry")), "entry")


def _release_pairs(s: SparkSession, d: str) -> DataFrame:
    credits = table(s, d, "release_artist").where("extra = 0").select(F.col("release_id").alias("id"), "artist_name")
    return credits.join(table(s, d, "releases").select("id", F.col("title").alias("title_text"), "format"), "id")


def _index(s: SparkSession, d: str) -> dict[str, DataFrame]:
    return classify.library_index(table(s, d, "library"), "artist", "title", "alternate_artist_name", formats.shelf_category(F.col("format")))


@query()
def classify_releases(s, d):
    return classify.classify(_release_pairs(s, d), _index(s, d))


def _mappings(s: SparkSession) -> DataFrame:
    return s.createDataFrame([("ida mur", "keep"), ("various", "prune"), ("unknown artist", "prune")], "artist string, decision string")


_WORDS3 = r"list_filter(regexp_split_to_array({x}, '\s+'), lambda w: length(w) >= 3)"
_ARTISTS_SQL = f"""
lib AS (SELECT artist, alternate_artist_name AS other FROM library WHERE coalesce(artist, '') <> '' AND coalesce(title, '') <> '' AND NOT {_sql_compilation('artist')}),
arts AS (SELECT {_sql_artist('artist')} AS artist FROM lib UNION SELECT {_sql_artist('other')} FROM lib WHERE coalesce(other, '') <> '' AND NOT {_sql_compilation('other')} AND {_sql_artist('other')} <> ''),
words AS (SELECT DISTINCT unnest({_WORDS3.format(x='artist')}) AS w FROM arts)"""


@query(f"""WITH {_ARTISTS_SQL}, c AS (SELECT DISTINCT artist_name, {_sql_artist('artist_name')} AS a, {_sql_compilation('artist_name')} AS comp FROM release_artist c JOIN releases r ON r.id = c.release_id WHERE extra = 0 AND artist_name IS NOT NULL AND r.title IS NOT NULL),
  p AS (SELECT DISTINCT a FROM (SELECT a, unnest({_WORDS3.format(x='a')}) AS w FROM c) WHERE w IN (SELECT w FROM words))
  SELECT DISTINCT a AS artist, comp AS compilation, CASE WHEN a IN (SELECT artist FROM arts) OR a = 'ida mur' THEN 'known' WHEN a IN ('various', 'unknown artist') THEN 'mapped' WHEN a NOT IN (SELECT a FROM p) THEN 'screened' WHEN comp THEN 'compilation' ELSE 'fuzzy' END AS route FROM c""")
def classify_routes(s, d):
    return classify.routed(_release_pairs(s, d), _index(s, d), _mappings(s)).select("artist", "compilation", "route").distinct()


@query()
def classify_pairs(s, d):
    pairs = _release_pairs(s, d).select(normalize.match_artist(F.col("artist_name")).alias("artist"), normalize.match_title(F.col("title_text")).alias("title"))
    return classify.pair_scores(pairs, _index(s, d), _mappings(s))


@query()
def review_report(s, d):
    index = _index(s, d)
    return classify.review_by_artist(classify.classify_credits(_release_pairs(s, d), index), index)


@query()
def class_report(s, d):
    classes = classify.classify(_release_pairs(s, d), _index(s, d))
    return classify.class_report(classes, {"release_track": (table(s, d, "release_track"), "release_id"), "release_label": (table(s, d, "release_label"), "release_id")})


def _audited(s: SparkSession, d: str) -> DataFrame:
    index, rows = _index(s, d), _release_pairs(s, d)
    classes = classify.classify(rows, index).where("class = 'prune'").select("id")
    return classify.audit(rows.join(classes, "id", "left_semi"), index)


@query()
def audit_bands(s, d):
    return _audited(s, d).select("id", "artist", "phase", "call", "mechanism")


@query()
def audit_rate(s, d):
    return classify.miss_rate(_audited(s, d))


@query()
def audit_mechanisms(s, d):
    return classify.miss_mechanisms(_audited(s, d))


@query(rf"""WITH {_ARTISTS_SQL}, l AS (SELECT artist, alternate_artist_name AS other, {_sql_title('title')} AS t FROM library WHERE coalesce(artist, '') <> '' AND coalesce(title, '') <> '' AND NOT {_sql_compilation('artist')}),
  cut AS (SELECT artist, t, list_transform(regexp_split_to_array(artist, ',\s+|\s+/\s+|\s+\+\s+'), lambda x: trim(x)) AS p FROM l),
  fine AS (SELECT *, len(p) > 1 AND len(list_filter(p, lambda x: regexp_full_match(x, '\d+') OR length(x) < 2)) = 0 AS apart FROM cut),
  part AS (SELECT artist, t, apart, unnest(CASE WHEN apart THEN p WHEN contains(artist, ' & ') THEN list_filter(list_transform(string_split(artist, ' & '), lambda x: trim(x)), lambda x: x <> '') ELSE [] END) AS x FROM fine),
  named AS (SELECT artist, t, apart, {_sql_artist('x')} AS a FROM part),
  pairs AS (SELECT {_sql_artist('artist')} AS a, t FROM l UNION SELECT {_sql_artist('other')}, t FROM l WHERE coalesce(other, '') <> '' AND NOT {_sql_compilation('other')}
    UNION SELECT a, t FROM named n WHERE apart OR EXISTS (FROM named m WHERE m.artist = n.artist AND m.a IN (SELECT artist FROM arts)))
  SELECT DISTINCT c.release_id AS id FROM release_artist c JOIN releases r ON r.id = c.release_id JOIN pairs p ON p.a = {_sql_artist('c.artist_name')} AND p.t = {_sql_title('r.title')} WHERE c.extra = 0 AND p.a <> ''""")
def exact_pairs(s, d):
    rows = _release_pairs(s, d).select("id", normalize.match_artist(F.col("artist_name")).alias("artist"), normalize.match_title(F.col("title_text")).alias("title"))
    return rows.join(_index(s, d)["pairs"], ["artist", "title"], "left_semi").select("id").distinct()


@query()
def compilation_classify(s, d):
    rows = _release_pairs(s, d).where(normalize.is_compilation(F.col("artist_name")))
    return classify.compilation(rows.select("id", normalize.match_title(F.col("title_text")).alias("title")), _index(s, d))


@query()
def two_stage_classify(s, d):
    rows = _release_pairs(s, d).where(~normalize.is_compilation(F.col("artist_name")))
    rows = rows.select("id", normalize.match_artist(F.col("artist_name")).alias("artist"), normalize.match_title(F.col("title_text")).alias("title"))
    return classify.fuzzy_artist(rows, _index(s, d))


@query("""WITH c AS (SELECT id, unnest(['keep', 'prune', 'review']) AS class, unnest([country = 'US', data_quality = 'Correct', format = 'CD']) AS f FROM releases), t AS (SELECT id, CASE max(CASE class WHEN 'keep' THEN 3 WHEN 'review' THEN 2 ELSE 1 END) WHEN 3 THEN 'keep' WHEN 2 THEN 'review' ELSE 'prune' END AS class FROM c WHERE f GROUP BY id)
  SELECT coalesce(t.id, o.release_id) AS id, CASE WHEN o.release_id IS NOT NULL THEN 'keep' ELSE class END AS class FROM t FULL JOIN (SELECT DISTINCT release_id FROM release_label WHERE label_id = 5) o ON o.release_id = t.id""")
def precedence_override(s, d):
    r = table(s, d, "releases")
    rows = [r.where(cond).select("id", F.lit(name).alias("class")) for name, cond in (("keep", "country = 'US'"), ("prune", "data_quality = 'Correct'"), ("review", "format = 'CD'"))]
    classes = tables.precedence(rows[0].unionByName(rows[1]).unionByName(rows[2]))
    return tables.override(classes, table(s, d, "release_label").where("label_id = 5").select(F.col("release_id").alias("id")))


_WRONG_SQL = "SELECT lower(artist_name) AS name, min(artist_id) AS wrong_id FROM release_artist WHERE extra = 0 AND artist_id IS NOT NULL GROUP BY 1"


@query(f"""WITH w AS ({_WRONG_SQL}), a AS (SELECT DISTINCT l.artist AS name, l.title, w.wrong_id FROM library l LEFT JOIN w ON w.name = lower(l.artist) WHERE l.title IS NOT NULL AND l.artist IS NOT NULL AND l.label IS NOT NULL),
  n AS (SELECT DISTINCT c.release_id, c.artist_id, c.artist_name, r.title AS found FROM release_artist c JOIN releases r ON r.id = c.release_id WHERE c.extra = 0 AND c.artist_name IS NOT NULL),
  own AS (SELECT * FROM (SELECT name, title, wrong_id, release_id, artist_id, {_sql_similarity('title', 'found')} AS ts, 1.0::DOUBLE AS asim FROM a JOIN n ON lower(left(n.artist_name, 200)) = lower(a.name)) WHERE ts > 0.3),
  lost AS (SELECT * FROM a WHERE NOT EXISTS (FROM own o WHERE o.name = a.name AND o.title = a.title)),
  alike AS (SELECT * FROM (SELECT title, found, {_sql_similarity('title', 'found')} AS ts FROM (SELECT DISTINCT title FROM lost), (SELECT DISTINCT found FROM n)) WHERE ts >= 0.5),
  every AS (SELECT * FROM own UNION ALL SELECT l.name, l.title, l.wrong_id, n.release_id, n.artist_id, k.ts, {_sql_similarity('l.name', 'n.artist_name')} FROM lost l JOIN alike k USING (title) JOIN n ON n.found = k.found),
  c AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name, title ORDER BY ts DESC, release_id, artist_id NULLS FIRST) AS r FROM every) WHERE r <= 10 AND (wrong_id IS NULL OR artist_id IS NULL OR artist_id <> wrong_id)),
  p AS (SELECT name, artist_id, count(*) AS hits, max(0.6 * ts + 0.4 * asim) AS score FROM c GROUP BY 1, 2),
  b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY hits DESC, score DESC, artist_id NULLS LAST) AS r FROM p) WHERE r = 1)
  SELECT n.name, CASE WHEN score >= 0.55 OR hits > 1 THEN 'RESOLVED' WHEN score >= 0.40 THEN 'AMBIGUOUS' ELSE 'UNRESOLVED' END AS status, artist_id, round(score, 6) AS score, coalesce(hits, 0) AS hits FROM (SELECT DISTINCT name FROM a) n LEFT JOIN b USING (name)""")
def collision_resolve(s, d):
    credits = table(s, d, "release_artist").where("extra = 0 and artist_name is not null")
    wrong = credits.where("artist_id is not null").groupBy(F.lower("artist_name").alias("_n")).agg(F.min("artist_id").alias("wrong_id"))
    flagged = table(s, d, "library").where("title is not null and artist is not null and label is not null").select(F.col("artist").alias("name"), "title")
    titles = flagged.join(wrong, F.lower("name") == F.col("_n"), "left").drop("_n")
    found = classify.resolve_collisions(titles, classify.collision_candidates(titles, table(s, d, "releases"), credits))
    return found.select("name", "status", "artist_id", F.round("score", 6).alias("score"), "hits")


# --- snapshots --------------------------------------------------------------------------------------------------------


@query("SELECT coalesce(a.id, b.id) AS id, CASE WHEN b.id IS NULL THEN 'missing' WHEN a.id IS NULL THEN 'extra' ELSE 'matched' END AS presence FROM library a FULL JOIN library_backend b ON a.id = b.id")
def parity_full_outer(s, d):
    return parity.presence(table(s, d, "library"), table(s, d, "library_backend"), "id")


def _sql_none(x: str) -> str:
    return f"nullif(nullif({_sql_strip(f'CAST({x} AS VARCHAR)')}, ''), 'NULL')"


_VARIOUS_SQL = r"regexp_full_match(lower(la), 'various(?:\s+artists(?:\s*-\s*[a-z]+)?)?')"
_SHELF_SQL = r"""CASE WHEN regexp_full_match({x}, 'cd(?:\s*x\s*\d+)?(?:\s*box)?') THEN 'cd' WHEN {x} = 'cdr' THEN 'cdr' WHEN {x} LIKE 'vinyl%' THEN CASE WHEN contains({x}, '7"') THEN 'vinyl 7"' WHEN contains({x}, '10"') THEN 'vinyl 10"' WHEN contains({x}, '12"') OR contains({x}, 'lp') THEN 'vinyl 12"' ELSE 'vinyl' END END"""


def _sql_fold_name(x: str) -> str:
    sources, targets, _ = folding("NFD")
    return rf"lower(regexp_replace(translate({x}, '{_q(sources)}', '{_q(targets)}'), '[\x{{300}}-\x{{36F}}]+', '', 'g'))"


_REASON_SQL = f"""CASE WHEN lower({_sql_strip('genre')}) = 'db_only' THEN 'db_only_genre' WHEN ({_SHELF_SQL.format(x=f"coalesce(lower({_sql_strip('format')}), '')")}) IS NULL THEN 'unparseable_format'
  WHEN coalesce({_sql_strip('artist')}, '') = '' THEN 'empty_artist_name' WHEN coalesce({_sql_strip('title')}, '') = '' THEN 'empty_album_title' END"""


def _tiers_sql() -> str:
    """One branch per column: what the right side should hold if it isn't the same."""
    flat = lambda c: f"translate({c}, chr(9) || chr(10), '  ')"
    code = rf"CASE WHEN {_sql_none('l.call_letters')} IS NULL THEN NULL WHEN regexp_matches(l.call_letters, 'Z-[A-Z]') THEN 'V/A' WHEN length({_sql_strip('l.call_letters')}) = 3 THEN upper({_sql_strip('l.call_letters')}) ELSE upper({_sql_strip('l.call_letters')}[:2]) END"
    fold = _sql_fold_name
    name = f"CASE WHEN {_VARIOUS_SQL} THEN 'Various Artists' ELSE la END"
    refs = lambda x: f"list_distinct(list_transform(list_filter(string_split(coalesce({_sql_none(x)}, ''), ' | '), lambda w: trim(w) <> ''), lambda w: {fold('trim(w)')}))"
    rules = {
        "title": f"CASE WHEN {_sql_none('r.title')} IS NOT DISTINCT FROM {_sql_none(flat('l.title'))} THEN 'tab_newline_substituted' END",
        "alternate_artist_name": f"CASE WHEN {_sql_none('r.alternate_artist_name')} IS NOT DISTINCT FROM {_sql_none(flat('l.alternate_artist_name'))} THEN 'tab_newline_substituted' END",
        "album_artist": f"CASE WHEN {_sql_none('r.album_artist')} IS NOT DISTINCT FROM {_sql_none(flat('l.album_artist'))} THEN 'tab_newline_substituted' END",
        "artist": f"CASE WHEN {_sql_none('r.artist')} IS NOT DISTINCT FROM {_sql_none(name)} THEN CASE WHEN {_VARIOUS_SQL} THEN 'various_artists' ELSE 'trimmed_or_substituted' END WHEN {fold(_sql_none('r.artist'))} = {fold(_sql_none(name))} THEN 'fold_equal' END",
        "call_letters": f"CASE WHEN lower({_sql_none('r.call_letters')}) = lower(CASE WHEN {_VARIOUS_SQL} THEN 'V/A' ELSE coalesce({code}, '??') END) THEN CASE WHEN {_VARIOUS_SQL} THEN 'various' WHEN ({code}) IS NULL THEN 'fallback_unknown' WHEN ({code}) = 'V/A' THEN 'various_artists_code' ELSE 'uppercased' END END",
        "artist_call_number": f"CASE WHEN {_sql_none('r.artist_call_number')} = CASE WHEN {_VARIOUS_SQL} THEN '0' ELSE coalesce({_sql_none('l.artist_call_number')}, '0') END THEN CASE WHEN {_VARIOUS_SQL} THEN 'various' ELSE 'null_coalesced_zero' END END",
        "release_call_number": f"CASE WHEN {_sql_none('r.release_call_number')} = coalesce({_sql_none('l.release_call_number')}, '0') THEN 'null_coalesced_zero' END",
        "genre": f"CASE WHEN lower({_sql_none('r.genre')}) = lower({_sql_none('l.genre')}) THEN 'case_folded' END",
        "format": f"CASE WHEN lower({_sql_none('r.format')}) = {_SHELF_SQL.format(x='lower(' + _sql_strip('l.format') + ')')} THEN 'format_derived' END",
        "cross_reference_names": f"CASE WHEN len(list_filter(rr, lambda w: NOT list_contains(lr, w))) = 0 AND len(list_filter(lr, lambda w: NOT list_contains(rr, w))) = 0 THEN 'fold_equal' WHEN len(list_filter(rr, lambda w: NOT list_contains(lr, w))) = 0 THEN 'cardinality_loss' WHEN len(list_filter(lr, lambda w: NOT list_contains(rr, w))) = 0 THEN 'cardinality_gain' END",
    }
    cells = ", ".join(f"{{'field': '{c}', 'class': CASE WHEN {_sql_none(f'l.{c}')} IS NOT DISTINCT FROM {_sql_none(f'r.{c}')} THEN 'agree' ELSE {rule} END, 'value': {('upper(' + _sql_none(f'r.{c}') + ')') if c == 'call_letters' else _sql_none(f'r.{c}')}}}" for c, rule in rules.items())
    code_own = code.replace("l.", "")
    return f"""WITH j AS (SELECT l, r, {_sql_strip(flat("coalesce(l.artist, '')"))} AS la, {refs('l.cross_reference_names')} AS lr, {refs('r.cross_reference_names')} AS rr FROM library l JOIN library_backend r ON l.id = r.id),
      f AS (SELECT l.id AS id, {fold(name)} AS fold, coalesce(lower({_sql_none('l.genre')}), '') AS genre, unnest([{cells}]) AS c FROM j),
      o AS (SELECT genre, format, title, artist, call_letters, artist_call_number, {_sql_strip(flat("coalesce(artist, '')"))} AS la FROM library),
      s AS (SELECT {fold(name)} AS fold, coalesce(lower({_sql_none('genre')}), '') AS genre, upper(CASE WHEN {_VARIOUS_SQL} THEN 'V/A' ELSE coalesce({code_own}, '??') END) AS letters, CASE WHEN {_VARIOUS_SQL} THEN '0' ELSE coalesce({_sql_none('artist_call_number')}, '0') END AS number FROM o WHERE {_REASON_SQL} IS NULL),
      d AS (SELECT id, c.field AS field, coalesce(c.class, CASE WHEN c.field = 'call_letters' AND EXISTS (FROM s WHERE s.fold = f.fold AND s.letters = c.value) THEN 'fold_collapsed' WHEN c.field = 'artist_call_number' AND EXISTS (FROM s WHERE s.fold = f.fold AND s.genre = f.genre AND s.number = c.value) THEN 'fold_collapsed' END) AS class FROM f)
      SELECT id, field, CASE WHEN class = 'agree' THEN 'agree' WHEN class IS NULL THEN 'mismatch' ELSE 'normalized' END AS tier, CASE WHEN class <> 'agree' THEN class END AS class FROM d"""


@query(_tiers_sql())
def parity_field_classes(s, d):
    return parity.field_classes(table(s, d, "library"), table(s, d, "library_backend"), "id")


@query(f"SELECT g.field, g.tier, count(t.id) AS n FROM (SELECT unnest({list(parity.COLUMNS)}) AS field) f, LATERAL (SELECT f.field AS field, unnest(['agree', 'normalized', 'mismatch']) AS tier) g LEFT JOIN ({_tiers_sql()}) t ON t.field = g.field AND t.tier = g.tier GROUP BY 1, 2")
def parity_field_tiers(s, d):
    return parity.field_tiers(table(s, d, "library"), table(s, d, "library_backend"), "id")


_EXPECTED_SQL = f"""SELECT id, 'missing' AS side, {_REASON_SQL} IS NOT NULL OR id IN (SELECT id FROM library WHERE label IS NOT NULL) AS expected FROM library WHERE id NOT IN (SELECT id FROM library_backend)
  UNION ALL SELECT id, 'extra', id >= 1000000 FROM library_backend WHERE id NOT IN (SELECT id FROM library)"""


@query(_EXPECTED_SQL)
def parity_expectations(s, d):
    # The rows with a label stand in for a ledger of known residue.
    ledger = table(s, d, "library").where("label is not null").select("id")
    return parity.row_expectations(table(s, d, "library"), table(s, d, "library_backend"), "id", ledger)


@query(f"""WITH e AS ({_EXPECTED_SQL}), f AS ({_tiers_sql()}), o AS (SELECT artist, title, sum(n) AS n FROM (SELECT artist, title, 1 AS n FROM library UNION ALL SELECT artist, title, -1 FROM library_backend) GROUP BY 1, 2),
  c AS (SELECT (SELECT count(*) FROM e WHERE side = 'missing' AND expected) AS missing_expected, (SELECT count(*) FROM e WHERE side = 'missing' AND NOT expected) AS missing_unexplained, (SELECT count(*) FROM e WHERE side = 'extra' AND expected) AS extra_expected,
    (SELECT count(*) FROM e WHERE side = 'extra' AND NOT expected) AS extra_unexplained, (SELECT count(*) FROM f WHERE tier = 'mismatch') AS mismatches, (SELECT coalesce(sum(n) FILTER (WHERE n > 0), 0) > 100000000 OR coalesce(-sum(n) FILTER (WHERE n < 0), 0) > 0 FROM o) AS over)
  SELECT missing_expected, missing_unexplained, extra_expected, extra_unexplained, mismatches, missing_unexplained = 0 AND extra_unexplained = 0 AND mismatches = 0 AND NOT over AS clean,
    concat_ws(', ', CASE WHEN missing_unexplained > 0 THEN 'missing rows' END, CASE WHEN extra_unexplained > 0 THEN 'extra rows' END, CASE WHEN mismatches > 0 THEN 'field mismatches' END, CASE WHEN over THEN 'track credits' END) AS causes FROM c""")
def parity_verdict(s, d):
    a, b = table(s, d, "library"), table(s, d, "library_backend")
    ledger = a.where("label is not null").select("id")
    return parity.verdict(parity.row_expectations(a, b, "id", ledger), parity.field_classes(a, b, "id"), parity.multiset_difference(a, b, ["artist", "title"]), 100_000_000, 0)


@query("SELECT count(*) AS rows, count(*) FILTER (WHERE lower(artist) NOT IN (SELECT lower(artist_name) FROM wxyc_library WHERE artist_name IS NOT NULL) OR artist IS NULL) AS unmatched FROM library")
def parity_unmatched(s, d):
    return parity.unmatched(table(s, d, "library"), table(s, d, "wxyc_library"), F.lower("artist"), F.lower("artist_name"))


@query("SELECT artist, title, greatest(sum(n), 0)::BIGINT AS missing, greatest(-sum(n), 0)::BIGINT AS extra FROM (SELECT artist, title, 1 AS n FROM library UNION ALL SELECT artist, title, -1 FROM library_backend) GROUP BY 1, 2 HAVING sum(n) <> 0")
def parity_multiset(s, d):
    return parity.multiset_difference(table(s, d, "library"), table(s, d, "library_backend"), ["artist", "title"])


@query(rf"""WITH f AS (SELECT DISTINCT lower(regexp_replace(translate(artist, '{_q(folding("NFD")[0])}', '{_q(folding("NFD")[1])}'), '[\x{{300}}-\x{{36F}}]+', '', 'g')) AS fold, artist, call_letters FROM library WHERE artist IS NOT NULL)
  SELECT fold, array_to_string(list_sort(list(DISTINCT call_letters) FILTER (WHERE call_letters IS NOT NULL)), ',') AS codes FROM f GROUP BY 1 HAVING count(DISTINCT artist) > 1""")
def parity_fold_collapse(s, d):
    return parity.fold_groups(table(s, d, "library"), "artist", "call_letters").select("fold", F.when(F.size("values") > 0, F.array_join("values", ",")).alias("codes"))


@query("""WITH bad AS (SELECT DISTINCT release_id || '/' || sequence || '/' || title AS row, release_id, translate(title, 'éöí', '���') AS t FROM release_track),
  hit AS (SELECT DISTINCT b.row, g.title FROM bad b JOIN release_track g USING (release_id) WHERE contains(b.t, '�') AND length(b.t) = length(g.title)
    AND list_bool_and(list_transform(range(1, length(b.t) + 1), lambda i: b.t[i] = '�' OR b.t[i] = g.title[i])))
  SELECT r.row, CASE WHEN count(DISTINCT h.title) = 1 THEN 'resolved' WHEN count(DISTINCT h.title) > 1 THEN 'multiple_candidates' ELSE 'zero_candidates' END AS outcome,
    CASE WHEN count(DISTINCT h.title) = 1 THEN min(h.title) END AS value FROM (SELECT DISTINCT row FROM bad WHERE contains(t, '�')) r LEFT JOIN hit h ON h.row = r.row GROUP BY r.row""")
def fffd_repair(s, d):
    tracks = table(s, d, "release_track").select("release_id", "sequence", "title").distinct()
    bad = tracks.select(F.concat_ws("/", "release_id", "sequence", "title").alias("row"), "release_id", F.translate("title", "éöí", "���").alias("title"))
    return parity.repair(bad, tracks, ["release_id"], ["title"], "row").select("row", "outcome", F.get("values", F.lit(0)).alias("value"))


@query("""WITH e AS (SELECT DISTINCT label_id AS a, parent_label_id AS b FROM label_hierarchy WHERE label_id <> parent_label_id), b AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
  n AS (SELECT label_id AS id, label_name AS name FROM label_hierarchy WHERE label_name IS NOT NULL UNION SELECT parent_label_id, parent_label_name FROM label_hierarchy WHERE parent_label_name IS NOT NULL)
  SELECT b.a AS id, array_to_string(list_sort(list(DISTINCT n.name)), ' | ') AS names FROM b JOIN n ON n.id = b.b GROUP BY 1""")
def cross_reference_names(s, d):
    h = table(s, d, "label_hierarchy")
    names = h.select(F.col("label_id").alias("id"), F.col("label_name").alias("name")).unionByName(h.select(F.col("parent_label_id").alias("id"), F.col("parent_label_name").alias("name")))
    return parity.cross_references(h.select(F.col("label_id").alias("a"), F.col("parent_label_id").alias("b")).dropna(), names)


@query("SELECT l.id, r.artist_id FROM library l LEFT JOIN (SELECT lower(artist_name[:200]) AS n, min(artist_id) AS artist_id FROM release_artist WHERE artist_id IS NOT NULL GROUP BY 1) r ON r.n = lower(l.artist[:200])")
def reconcile_identity(s, d):
    return parity.reconcile(table(s, d, "library").select("id", "artist"), table(s, d, "release_artist"), "artist").select("id", "artist_id")


# --- health -----------------------------------------------------------------------------------------------------------


@query("SELECT count(*) FILTER (WHERE label IS NOT NULL) AS with_value, count(*) FILTER (WHERE label IS NULL AND format IS NULL) AS never_checked, count(*) FILTER (WHERE label IS NULL AND format IS NOT NULL) AS checked_without FROM library")
def artwork_states(s, d):
    return health.tri_state(table(s, d, "library"), "label", F.col("format").isNotNull())


@query("SELECT count(*) AS parents, count(t.release_id) AS covered, count(t.release_id) / nullif(count(*), 0) AS ratio, coalesce(count(t.release_id) / nullif(count(*), 0) >= 0.5, true) AS ok FROM (SELECT DISTINCT id FROM releases) r LEFT JOIN (SELECT DISTINCT release_id FROM release_track) t ON t.release_id = r.id")
def coverage_invariant(s, d):
    return health.coverage(table(s, d, "releases"), "id", table(s, d, "release_track"), "release_id")


@query("SELECT (SELECT count(DISTINCT artist) FROM library) AS library_n, (SELECT count(DISTINCT artist_name) FROM release_artist) AS cache_n, (SELECT count(DISTINCT artist_name) FROM release_artist) / nullif((SELECT count(DISTINCT artist) FROM library), 0) AS ratio, (SELECT count(DISTINCT artist_name) FROM release_artist) / nullif((SELECT count(DISTINCT artist) FROM library), 0) >= 0.7 AS ok")
def drift_ratio(s, d):
    return health.drift(table(s, d, "library"), "artist", table(s, d, "release_artist"), "artist_name")


@query("SELECT l.label_name AS source, count(DISTINCT l.release_id) AS overrides, count(DISTINCT l.release_id) FILTER (WHERE r.id IS NULL) AS missing FROM release_label l LEFT JOIN (SELECT id FROM releases WHERE format = 'CD') r ON r.id = l.release_id GROUP BY 1")
def override_summary(s, d):
    return health.override_summary(table(s, d, "release_label").withColumnRenamed("label_name", "source"), table(s, d, "releases").where("format = 'CD'"))


@query("SELECT DISTINCT release_id FROM release_label WHERE release_id NOT IN (SELECT id FROM releases WHERE format = 'CD')")
def missing_override_ids(s, d):
    return tables.drop_ids(table(s, d, "release_label"), "release_id", table(s, d, "releases").where("format = 'CD'")).select("release_id").distinct()


@query("""WITH c AS (SELECT country, count(*) AS n, count(*) FILTER (WHERE notes IS NULL) AS hits FROM releases GROUP BY 1), w AS (SELECT *, hits / n AS p, 1.96 * 1.96 AS zz FROM c)
  SELECT country, n, hits, round(p, 9) AS rate, round(greatest(0, ((p + zz / (2 * n)) / (1 + zz / n)) - 1.96 * sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)), 9) AS low, round(least(1, ((p + zz / (2 * n)) / (1 + zz / n)) + 1.96 * sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)), 9) AS high FROM w""")
def wilson_interval(s, d):
    out = health.share(table(s, d, "releases"), "country", F.col("notes").isNull())
    return out.select("country", "n", "hits", *[F.round(c, 9).alias(c) for c in ("rate", "low", "high")])


@query("SELECT count(*) FILTER (WHERE k) AS keep, count(*) FILTER (WHERE k AND o) AS keep_and_override, count(*) FILTER (WHERE k AND NOT o) AS keep_only, count(*) FILTER (WHERE p AND o) AS pruned_overrides FROM (SELECT coalesce(country = 'US', false) AS k, coalesce(format = 'CD', false) AS o, coalesce(data_quality = 'Correct', false) AS p FROM releases)")
def audit_summary(s, d):
    flag = lambda c: F.coalesce(c, F.lit(False))
    r = table(s, d, "releases").select("id", flag(F.col("country") == "US").alias("keep"), flag(F.col("format") == "CD").alias("override"), flag(F.col("data_quality") == "Correct").alias("prune"))
    return health.set_summary(r)
