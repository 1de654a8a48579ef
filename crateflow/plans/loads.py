"""Queries of the loads, searches and small functions of the catalogue build, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crateflow.functions import formats, mojibake, normalize, similarity, stats, trigram, unaccent
from crateflow.operators import classify, health, loads, search, tables
from crateflow.operators.record_parse import parse_records
from crateflow.plans.catalog import ORACLE as CATALOG_SQL
from crateflow.plans.catalog import QUERIES as CATALOG
from crateflow.plans.catalog import _sql_artist, _sql_similarity, _sql_title
from crateflow.sources.csv_tables import SPECS, one_line, scan
from crateflow.sources.exchange import filter_export
from crateflow.sources.tables import table
from crateflow.sources.text_rows import escape, parse_tsv

QUERIES = {}
ORACLE = {}
NOW = "TIMESTAMP '2026-01-02 03:04:05'"


def query(sql: str | None = None):
    """Registers a query under its function's name, with its SQL twin."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


def _artists(s: SparkSession, d: str) -> DataFrame:
    """An artist table that lags behind the credits: the ids that occur as printed with another name, every second one marked as not found."""
    rows = table(s, d, "release_artist").where("artist_id is not null and anv is not null")
    return rows.groupBy(F.col("artist_id").alias("id")).agg(F.max("anv").alias("name")).withColumn("not_found", F.col("id") % 2 == 0)


_ARTISTS_SQL = "SELECT artist_id AS id, max(anv) AS name, artist_id % 2 = 0 AS not_found FROM release_artist WHERE artist_id IS NOT NULL AND anv IS NOT NULL GROUP BY artist_id"


@query(f"WITH a AS ({_ARTISTS_SQL}), s AS (SELECT artist_id, min(artist_name) AS n FROM release_artist WHERE artist_id IS NOT NULL GROUP BY 1) SELECT coalesce(a.id, s.artist_id) AS id, CASE WHEN a.id IS NOT NULL THEN a.name ELSE s.n END AS name, CASE WHEN s.artist_id IS NOT NULL THEN false ELSE a.not_found END AS not_found FROM a FULL JOIN s ON s.artist_id = a.id")
def load_stub_artists(s, d):
    return loads.stub_artists(_artists(s, d), table(s, d, "release_artist"))


@query("SELECT 'master' AS table_name, count(*) AS n FROM (SELECT DISTINCT label_id AS id FROM label_hierarchy) WHERE id IN (SELECT master_id FROM releases) UNION ALL SELECT 'master_artist', count(*) FROM label_hierarchy WHERE label_id IN (SELECT master_id FROM releases) UNION ALL SELECT 'unscoped', count(*) FROM label_hierarchy")
def load_masters(s, d):
    # The label table stands in for the masters' files: ids of the same range, several rows to an id.
    h, releases = table(s, d, "label_hierarchy"), table(s, d, "releases")
    new, children = h.select(F.col("label_id").alias("id")).distinct(), h.select(F.col("label_id").alias("master_id"), "label_name")
    masters, credits = loads.reload_masters(new.limit(0), children.limit(0), new, children, releases)
    kept = loads.guarded_reload(children, None, new, "master_id")
    return tables.counts({"master": masters, "master_artist": credits, "unscoped": kept})


@query("SELECT id, title FROM releases WHERE format = 'CD'")
def load_checked_copy(s, d):
    cds = table(s, d, "releases").where("format = 'CD'").select("id", "title")
    return loads.checked_copy(cds, cds.select("id"))


@query("SELECT DISTINCT release_id FROM release_label WHERE release_id NOT IN (SELECT id FROM releases WHERE format = 'CD') ORDER BY release_id LIMIT 20")
def load_missing_sample(s, d):
    return loads.missing_sample(table(s, d, "releases").where("format = 'CD'").select(F.col("id").alias("release_id")), table(s, d, "release_label"), "release_id")


@query("SELECT 'releases' AS table_name, count(*) AS n FROM releases WHERE country = 'US' UNION ALL SELECT 'release_artist', count(*) FROM release_artist WHERE release_id IN (SELECT id FROM releases WHERE country = 'US') UNION ALL SELECT 'release_track', count(*) FROM release_track WHERE release_id IN (SELECT id FROM releases WHERE country = 'US') UNION ALL SELECT 'release_label', count(*) FROM release_label WHERE release_id IN (SELECT id FROM releases WHERE country = 'US')")
def load_family_copy(s, d):
    family = {"releases": (table(s, d, "releases"), "id")} | {t: (table(s, d, t), "release_id") for t in ("release_artist", "release_track", "release_label")}
    return tables.counts(loads.copy_family(family, table(s, d, "releases").where("country = 'US'")))


@query("SELECT 'releases' AS table_name, count(*) AS n FROM releases WHERE notes IS NOT NULL UNION ALL SELECT 'release_track', count(*) FROM release_track WHERE release_id IN (SELECT id FROM releases WHERE notes IS NOT NULL)")
def load_parent_then_children(s, d):
    raw = {"releases": table(s, d, "releases").where("notes is not null"), "release_track": table(s, d, "release_track")}
    return tables.counts(loads.load_family(raw, "releases", "id", "release_id"))


@query(f"SELECT id AS release_id, CASE WHEN format = 'CD' THEN 'old' ELSE 'bulk_import' END AS source, CASE WHEN format = 'CD' THEN cached_at::DATE ELSE {NOW}::DATE END AS day FROM releases WHERE format = 'CD' OR country = 'US'")
def load_restamped_metadata(s, d):
    r = table(s, d, "releases")
    known = r.where("format = 'CD'").select(F.col("id").alias("release_id"), "cached_at", F.lit("old").alias("source"))
    out = loads.restamp(known, r.where("country = 'US'"), F.expr(NOW))
    return out.select("release_id", "source", F.to_date("cached_at").alias("day"))


@query("SELECT id FROM releases WHERE notes IS NULL AND country IS NULL ORDER BY id LIMIT 100")
def artwork_pending(s, d):
    return loads.pending(table(s, d, "releases"), "notes", "country", 100)


@query("SELECT id, CASE WHEN id IN (SELECT release_id FROM release_label) THEN (SELECT max(catno) FROM release_label l WHERE l.release_id = id) ELSE notes END AS notes, CASE WHEN id IN (SELECT release_id FROM release_label) THEN 'asked' ELSE released END AS released FROM releases")
def artwork_stamped(s, d):
    results = table(s, d, "release_label").groupBy(F.col("release_id").alias("id")).agg(F.max("catno").alias("notes"))
    return loads.stamp_results(table(s, d, "releases").select("id", "notes", "released"), results, "id", "notes", "released", F.lit("asked"))


@query("SELECT event_type, json_extract_string(j, '$.images[0].uri') AS uri FROM (SELECT event_type, CASE WHEN user_id % 3 = 0 THEN '{\"images\": []}' WHEN user_id % 3 = 1 THEN '{\"images\": [{\"uri\": \"u' || user_id || '\"}, {\"uri\": \"x\"}]}' ELSE '{}' END AS j FROM events)")
def artwork_uri(s, d):
    k = F.col("user_id")
    doc = F.when(k % 3 == 0, '{"images": []}').when(k % 3 == 1, F.concat(F.lit('{"images": [{"uri": "u'), k.cast("string"), F.lit('"}, {"uri": "x"}]}'))).otherwise("{}")
    return table(s, d, "events").select("event_type", normalize.artwork_uri(doc).alias("uri"))


@query("SELECT library_id, artist_name, album_title, snapshot_source, norm_artist IS NULL AS no_artist, norm_label IS NULL AS no_label FROM (SELECT library_id, artist_name, album_title, 'backend' AS snapshot_source, artist_name AS norm_artist, label_name AS norm_label FROM wxyc_library)")
def load_normalized_library(s, d):
    rows = table(s, d, "wxyc_library").drop("norm_artist", "norm_title", "norm_label", "snapshot_at", "snapshot_source")
    out = loads.normalized_library(rows, "backend", F.expr(NOW))
    return out.select("library_id", "artist_name", "album_title", "snapshot_source", F.col("norm_artist").isNull().alias("no_artist"), F.col("norm_label").isNull().alias("no_label"))


@query("SELECT DISTINCT label_id AS id FROM release_label WHERE label_id IS NOT NULL")
def load_keep_list(s, d):
    labels = table(s, d, "release_label")
    return loads.keep_list(labels, "label_id", labels.select("label_id"))


@query("SELECT 'library' AS table_name, count(*) AS n FROM library UNION ALL SELECT 'library_words', (SELECT count(*) FROM (SELECT DISTINCT id, unnest(list_filter(regexp_split_to_array(lower(concat_ws(' ', title, artist, alternate_artist_name, album_artist)), '[\\s]+'), lambda w: w <> '')) FROM library))")
def load_library_container(s, d):
    rows = table(s, d, "library")
    return tables.counts(loads.library_container(rows, table(s, d, "release_track").limit(0)))


@query()
def random_sample(s, d):
    return loads.random_sample(table(s, d, "releases"), 100, 217)


@query("SELECT id, artist, title FROM (SELECT r.id, c.artist_name AS artist, r.title, row_number() OVER (PARTITION BY r.id ORDER BY coalesce(c.artist_name, ''), c.artist_name NULLS FIRST) AS k FROM releases r JOIN release_artist c ON c.release_id = r.id WHERE extra = 0) WHERE k = 1")
def least_artist_row(s, d):
    credits = table(s, d, "release_artist").where("extra = 0").select(F.col("release_id").alias("id"), F.col("artist_name").alias("artist"))
    return loads.least_row(credits.join(table(s, d, "releases").select("id", "title"), "id"), "id", "artist")


@query("WITH tc AS (SELECT release_id, count(*) AS n FROM release_track GROUP BY 1) SELECT id, rank::INT AS rank FROM (SELECT id, row_number() OVER (PARTITION BY master_id ORDER BY n DESC, id) AS rank FROM releases JOIN tc ON tc.release_id = id WHERE master_id IS NOT NULL)")
def dedup_historic(s, d):
    from pyspark.sql import Window

    from crateflow.operators.dedup import track_counts

    r = table(s, d, "releases").where("master_id is not null").join(track_counts(table(s, d, "release_track")).withColumnRenamed("release_id", "id"), "id")
    return r.select("id", F.row_number().over(Window.partitionBy("master_id").orderBy(F.desc("track_count"), "id")).alias("rank"))


# --- reports ------------------------------------------------------------------------------------------------------------


@query("SELECT 'releases' AS table_name, count(*) AS n, count(*) FILTER (WHERE format = 'CD') AS deletable FROM releases UNION ALL SELECT 'release_track', count(*), count(*) FILTER (WHERE release_id IN (SELECT id FROM releases WHERE format = 'CD')) FROM release_track")
def table_size_report(s, d):
    r, t = table(s, d, "releases"), table(s, d, "release_track")
    cds = r.where("format = 'CD'")
    return health.table_sizes({"releases": r, "release_track": t}, {"releases": cds, "release_track": tables.keep_ids(t, "release_id", cds)}).where("bytes > 0").drop("bytes")


@query("SELECT count(*) AS sources, coalesce(sum(missing), 0)::BIGINT AS missing, coalesce(bool_and(missing = 0), true) AS ok FROM (SELECT l.label_name, count(DISTINCT l.release_id) FILTER (WHERE r.id IS NULL) AS missing FROM release_label l LEFT JOIN (SELECT id FROM releases WHERE format = 'CD') r ON r.id = l.release_id GROUP BY 1)")
def override_verdict(s, d):
    return health.override_verdict(health.override_summary(table(s, d, "release_label").withColumnRenamed("label_name", "source"), table(s, d, "releases").where("format = 'CD'")))


@query(f"SELECT outcome, count(*) AS n FROM ({CATALOG_SQL['fffd_repair']}) GROUP BY 1")
def repair_reasons(s, d):
    return health.tally(CATALOG["fffd_repair"](s, d), "outcome")


@query(f"SELECT status, count(*) AS n FROM ({CATALOG_SQL['collision_resolve']}) GROUP BY 1")
def collision_statuses(s, d):
    return health.tally(CATALOG["collision_resolve"](s, d), "status")


@query("SELECT release_id, nullif(label_id::VARCHAR, '') AS label_id, label_name, nullif(catno, '') AS catno FROM release_label WHERE release_id IS NOT NULL AND coalesce(label_name, '') <> ''")
def csv_scan(s, d):
    # The table as its file would hold it: texts, nulls as empty, with a NUL that the scan takes out.
    t = table(s, d, "release_label")
    text = lambda c: F.concat(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("\0"))
    raw = t.select(F.coalesce(F.col("release_id").cast("string"), F.lit("x")).alias("release_id"), text("label_id").alias("label_id"), text("label_name").alias("label"), text("catno").alias("catno"))
    return scan(raw, SPECS["release_label"])


@query("SELECT id, nullif(replace(title, chr(13), ''), '') AS title, nullif(replace(notes, chr(13), ''), '') AS notes FROM releases")
def tsv_round_trip(s, d):
    r = table(s, d, "releases").select(F.col("id").cast("string"), "title", "notes")
    lines = r.select(F.concat_ws("\t", *[escape(F.col(c)) for c in r.columns]).alias("value"))
    return parse_tsv(lines, ["id", "title", "notes"], ("id",))


@query("SELECT id, replace(replace(notes, chr(13), ''), chr(10), ' ') AS line FROM releases")
def one_line_texts(s, d):
    return table(s, d, "releases").select("id", one_line(F.col("notes")).alias("line"))


@query("SELECT release_id, sequence, title FROM release_track WHERE release_id IN (SELECT id FROM releases WHERE format = 'CD')")
def filtered_export(s, d):
    raw = table(s, d, "release_track").select(*[F.col(c).cast("string").alias(c) for c in ("release_id", "sequence", "title")])
    kept = filter_export(raw, table(s, d, "releases").where("format = 'CD'").select("id"))
    return kept.select(F.col("release_id").cast("int").alias("release_id"), F.col("sequence").cast("int").alias("sequence"), "title")


# --- small functions ----------------------------------------------------------------------------------------------------


@query("SELECT id, coalesce(lower(trim(genre)) IN ('rock', 'db_only'), false) AS is_genre FROM library")
def db_only_genre(s, d):
    renamed = F.when(F.lower(F.trim("genre")) == "rock", "DB_Only ").otherwise(F.col("genre"))
    return table(s, d, "library").select("id", normalize.is_db_only_genre(renamed).alias("is_genre"))


@query("SELECT id, lower(strip_accents(replace(replace(translate(artist, 'ØøŁłĐđĦħŦŧı', 'OoLlDdHhTti'), 'ß', 'ss'), 'æ', 'ae'))) AS form FROM library WHERE NOT regexp_matches(artist, '[\\x{300}-\\x{36F}]') AND regexp_full_match(strip_accents(translate(artist, 'ØøŁłĐđĦħŦŧı', 'OoLlDdHhTti')), '[ -~]*') OR artist IS NULL")
def unaccent_form(s, d):
    rows = table(s, d, "library").where(F.col("artist").isNull() | unaccent.fold_by_rules(F.col("artist")).rlike(r"^[ -~]*$"))
    return rows.select("id", unaccent.unaccent(F.col("artist")).alias("form"))


@query("SELECT id, lower(replace(translate(title, 'aeiou', 'xyzvw'), 'q', 'kw')) AS form FROM library")
def fold_by_rules(s, d):
    rules = unaccent.parse_rules("# source and target\na\tx\ne\ty\ni\tz\no\tv\nu\tw\nq\tkw\n")
    return table(s, d, "library").select("id", F.lower(unaccent.fold_by_rules(F.col("title"), rules)).alias("form"))


@query("SELECT id, lower(strip_accents(title)) AS form FROM library WHERE regexp_full_match(strip_accents(title), '[ -~]*')")
def registered_function(s, d):
    unaccent.register(s)
    table(s, d, "library").createOrReplaceTempView("_library_titles")
    return s.sql("SELECT id, lower(f_unaccent(title)) AS form FROM _library_titles WHERE f_unaccent(title) RLIKE '^[ -~]*$'")


@query(rf"SELECT id, CASE WHEN len(p) > 1 AND len(list_filter(p, lambda x: regexp_full_match(x, '\d+') OR length(x) < 2)) = 0 THEN array_to_string(p, '/') END AS parts FROM (SELECT id, list_transform(regexp_split_to_array(artist, ',\s+|\s+/\s+|\s+\+\s+'), lambda x: trim(x)) AS p FROM library)")
def split_names(s, d):
    return table(s, d, "library").select("id", F.array_join(normalize.split_names(F.col("artist")), "/").alias("parts"))


@query(f"""WITH lib AS (SELECT DISTINCT artist AS raw FROM library WHERE contains(artist, ' & ') AND NOT regexp_matches(artist, ',\\s+|\\s+/\\s+|\\s+\\+\\s+')), arts AS (SELECT DISTINCT {_sql_artist('artist')} AS a FROM library WHERE artist IS NOT NULL),
  p AS (SELECT raw, unnest(list_filter(list_transform(string_split(raw, ' & '), lambda x: trim(x)), lambda x: x <> '')) AS part FROM lib), q AS (SELECT raw, {_sql_artist('part')} AS a FROM p)
  SELECT DISTINCT raw, a AS component FROM q WHERE raw IN (SELECT raw FROM q JOIN arts USING (a)) AND a <> ''""")
def split_names_by_known(s, d):
    lib = table(s, d, "library").where(F.col("artist").contains(" & ") & normalize.split_names(F.col("artist")).isNull())
    artists = table(s, d, "library").where("artist is not null").select(normalize.match_artist(F.col("artist")).alias("artist")).distinct()
    rows = lib.select(F.col("artist").alias("raw"), F.col("artist").alias("title")).distinct()
    return classify.name_components(rows, artists).select(F.col("title").alias("raw"), F.col("artist").alias("component")).distinct()


@query("SELECT line_id, list_transform(list_filter(range(1, length(raw_line) + 1), lambda i: unicode(raw_line[i]) > 127), lambda i: (i - 1) || ' ' || raw_line[i] || ' U+' || lpad(to_hex(unicode(raw_line[i])), 4, '0')) AS points FROM release_raw")
def codepoints(s, d):
    points = F.transform(normalize.codepoints(F.col("raw_line")), lambda x: F.concat_ws(" ", x["index"], x["char"], x["code"]))
    return table(s, d, "release_raw").select("line_id", points.alias("points"))


@query("SELECT line_id, CASE WHEN n < 1024 THEN n || ' bytes' WHEN n < 1048576 THEN printf('%.1f kB', n / 1024.0) WHEN n < 1073741824 THEN printf('%.1f MB', n / 1048576.0) ELSE printf('%.1f GB', n / 1073741824.0) END AS size FROM (SELECT line_id, strlen(raw_line)::BIGINT * line_id AS n FROM release_raw)")
def readable_sizes(s, d):
    return table(s, d, "release_raw").select("line_id", stats.readable_bytes(F.octet_length("raw_line") * F.col("line_id")).alias("size"))


@query(r"SELECT id, CASE WHEN regexp_matches(dsn, '^[a-z]+://') THEN coalesce(nullif(regexp_extract(dsn, '^[a-z]+://(?:[^/@]*@)?([^/?]*)', 1), ''), '<local socket>') || '/' || coalesce(nullif(regexp_extract(dsn, '^[a-z]+://[^/]*/([^?]*)', 1), ''), '<default db>') ELSE '<unparseable>' END AS shown FROM (SELECT id, CASE id % 3 WHEN 0 THEN 'postgresql://me:pw' || id || '@db' || id || ':5433/cache?x=1' WHEN 1 THEN 'postgresql:///' ELSE 'host' END AS dsn FROM library)")
def redacted_dsn(s, d):
    i = F.col("id")
    dsn = F.when(i % 3 == 0, F.concat(F.lit("postgresql://me:pw"), i, F.lit("@db"), i, F.lit(":5433/cache?x=1"))).when(i % 3 == 1, "postgresql:///").otherwise("host")
    return table(s, d, "library").select("id", stats.redact_dsn(dsn).alias("shown"))


@query("SELECT id, (format = 'CD' OR shelf IS NULL OR format IS NULL OR format = shelf) AS fits FROM (SELECT r.id, r.format, CASE WHEN r.country = 'US' THEN 'Vinyl' WHEN r.country = 'UK' THEN 'CD' END AS shelf FROM releases r) WHERE true")
def format_compatible(s, d):
    shelf = F.when(F.col("country") == "US", "Vinyl").when(F.col("country") == "UK", "CD")
    known = F.array_compact(F.array(shelf, F.lit("CD")))
    return table(s, d, "releases").select("id", formats.compatible(F.col("format"), known, shelf.isNull()).alias("fits"))


@query(f"SELECT id, cached_at + to_seconds(86400 * 30) > {NOW} AS fresh FROM releases")
def within_ttl(s, d):
    return table(s, d, "releases").select("id", stats.fresh(F.col("cached_at"), F.lit(86400 * 30), F.expr(NOW)).alias("fresh"))


@query("SELECT id, coalesce(lower(artist) <> lower(album_artist) AND least(length(artist), length(album_artist)) >= 4 AND (contains(lower(artist), lower(album_artist)) OR contains(lower(album_artist), lower(artist))), false) AS variant FROM library")
def substring_variants(s, d):
    return table(s, d, "library").select("id", classify.substring_variant(F.lower("artist"), F.lower("album_artist")).alias("variant"))


@query("SELECT id, round(jaro_winkler_similarity(regexp_replace(lower(artist), '[^ -~]', '', 'g'), regexp_replace(lower(title), '[^ -~]', '', 'g')), 6) AS score FROM library WHERE artist IS NOT NULL AND title IS NOT NULL")
def jaro_winkler(s, d):
    # The SQL engine compares bytes, so other letters than ASCII are left out.
    plain = lambda c: F.regexp_replace(F.lower(c), "[^ -~]", "")
    rows = table(s, d, "library").where("artist is not null and title is not null")
    return rows.select("id", F.round(similarity.jaro_winkler_similarity(plain("artist"), plain("title")), 6).alias("score"))


@query("SELECT id, title, array_to_string(list_sort(list_distinct(list_filter([title, CASE WHEN strlen(title) = length(title) THEN title END], lambda x: x IS NOT NULL))), '|') AS readings FROM library WHERE strlen(title) = length(title)")
def misreadings(s, d):
    rows = table(s, d, "library").where(F.octet_length("title") == F.length("title"))
    return rows.select("id", "title", F.array_join(F.array_sort(mojibake.readings("title")), "|").alias("readings"))


@query("""SELECT csv_file, id AS release_id, count(*) AS n FROM (SELECT csv_file, try_cast(f AS INTEGER) AS id, regexp_matches(f, '^[+-]?[0-9]+$') AS fine FROM (SELECT csv_file, CASE WHEN raw_line LIKE '"%' THEN regexp_extract(raw_line, '^"([^"]*)"', 1) ELSE split_part(raw_line, ',', 1) END AS f FROM release_raw)) WHERE fine AND id IS NOT NULL GROUP BY 1, 2""")
def count_parsed_ids(s, d):
    # Broken records have no fields; their ids are read up to the first comma or closing quote.
    raw = table(s, d, "release_raw")
    parsed = parse_records(raw, "line_id", "raw_line", "csv_file").select("line_id", F.get("fields", F.lit(0)).alias("first"))
    lenient = F.when(F.col("raw_line").startswith('"'), F.regexp_extract("raw_line", '^"([^"]*)"', 1)).otherwise(F.split_part("raw_line", F.lit(","), F.lit(1)))
    head = F.coalesce("first", lenient)
    rows = raw.join(parsed, "line_id").select("csv_file", F.when(head.rlike("^[+-]?[0-9]+$"), head).try_cast("int").alias("release_id"))
    return rows.where("release_id is not null").groupBy("csv_file", "release_id").agg(F.count("*").alias("n"))


# --- search -------------------------------------------------------------------------------------------------------------


@query(f"SELECT id FROM library WHERE {_sql_artist('artist')} = 'various artists' AND {_sql_title('title')} LIKE 's%'")
def search_exact(s, d):
    rows = search.exact_search(table(s, d, "library"), artist=("artist", "Various Artists"))
    return rows.where(normalize.match_title(F.col("title")).startswith("s")).select("id")


@query(f"SELECT t.release_id, t.title, r.title AS release, round({_sql_similarity('t.title', chr(39) + 'Harbor Song' + chr(39))}, 6) AS similarity FROM (SELECT DISTINCT release_id, title FROM release_track) t JOIN releases r ON r.id = t.release_id WHERE {_sql_similarity('t.title', chr(39) + 'Harbor Song' + chr(39))} > 0.3")
def search_tracks(s, d):
    found = search.track_search(table(s, d, "release_track"), table(s, d, "releases"), "Harbor Song", 0.3)
    return found.withColumn("similarity", F.round("similarity", 6))


@query(f"SELECT r.id, round(max({_sql_similarity('c.artist_name', chr(39) + 'Ida Brass Band' + chr(39))}), 6) AS similarity FROM releases r JOIN release_artist c ON c.release_id = r.id WHERE extra = 0 AND {_sql_similarity('c.artist_name', chr(39) + 'Ida Brass Band' + chr(39))} > 0.2 GROUP BY 1")
def search_releases_by_artist(s, d):
    credits = table(s, d, "release_artist").where("extra = 0").withColumn("similarity", trigram.similarity(F.col("artist_name"), F.lit("Ida Brass Band"))).where("similarity > 0.2")
    return credits.groupBy(F.col("release_id").alias("id")).agg(F.round(F.max("similarity"), 6).alias("similarity"))


@query("SELECT DISTINCT id FROM (SELECT id, unnest(regexp_extract_all(lower(strip_accents(concat_ws(' ', title, artist))), '[\\p{L}\\p{N}\\p{Co}\\p{S}]+')) AS w FROM library) WHERE w = '+' OR w = 'no'")
def search_symbol_words(s, d):
    index = search.symbol_index(table(s, d, "library"), "id", ["title", "artist"])
    return index.where(F.col("word").isin("+", "no")).select("id").distinct()
