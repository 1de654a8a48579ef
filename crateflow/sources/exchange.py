"""Files that the build exchanges with other systems: filtered exports, mappings, class dumps, collision lists, ledgers, XML, snapshots over two feeds."""

from __future__ import annotations

import json
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from crateflow.functions.formats import release_category
from crateflow.operators.loads import least_row
from crateflow.operators.tables import keep_ids
from crateflow.sources.text_rows import parse_tsv

CLASSES = ("keep", "review", "prune")


class SourceError(ValueError):
    """A source can't be read as what it should be."""


# --- delimited files ----------------------------------------------------------------------------------------------------


def filter_export(raw: DataFrame, ids: DataFrame, column: str | None = None) -> DataFrame:
    """The rows of an export (texts, as read) whose id is among the ids (id); the id column is the given one, else ``release_id``, else ``id``. Rows
    without a whole number there go, as do rows cut short, whose last columns are null."""
    column = column or next((c for c in ("release_id", "id") if c in raw.columns), None)
    if column is None:
        raise SourceError("the export has no id column")
    whole = raw.where(F.col(column).rlike(r"^\s*[+-]?[0-9]+\s*$"))
    return keep_ids(whole.withColumn("_n", F.trim(column).try_cast("bigint")), "_n", ids.select(F.col("id").cast("bigint").alias("id"))).drop("_n")


def adapted(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """The named columns (name -> type) of a table that may lack some, which are null then."""
    return df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns.items()])


def compilation_tracks(lines: DataFrame) -> DataFrame:
    """(library_release_id, artist_name, track_title) of a ``value`` column of lines; those of another width, without a whole id or without an artist go."""
    return parse_tsv(lines, ["library_release_id", "artist_name", "track_title"], ("library_release_id",)).dropna(subset=["artist_name"])


def label_preferences(raw: DataFrame) -> DataFrame:
    """(artist_name, title, label_name) of an export with these columns or ``release_title`` and ``label``; rows with an empty part go."""
    named = raw.select(*[F.col(next(c for c in options if c in raw.columns)).alias(name) for name, options in (("artist_name", ("artist_name", "artist")), ("title", ("title", "release_title")), ("label_name", ("label_name", "label")))])
    return named.where("artist_name <> '' and title <> '' and label_name <> ''").distinct()


def label_links(raw: DataFrame) -> DataFrame:
    """(label_id, label_name, parent_label_id, parent_label_name) of a hierarchy export; rows whose ids aren't whole numbers go."""
    ids = [F.col(c).try_cast("int").alias(c) for c in ("label_id", "parent_label_id")]
    return raw.select(ids[0], "label_name", ids[1], "parent_label_name").where("label_id is not null and parent_label_id is not null")


# --- mappings and class dumps -------------------------------------------------------------------------------------------


def write_mapping(decisions: DataFrame, path: str) -> None:
    """The JSON file {"keep": {artist: library artist}, "prune": {artist: null}} of decisions (artist, decision, library_artist): made by hand, so few."""
    rows = decisions.orderBy("artist").collect()
    out = {d: {r["artist"]: r["library_artist"] for r in rows if r["decision"] == d} for d in ("keep", "prune")}
    Path(path).write_text(json.dumps(out, ensure_ascii=False, indent=2) + "\n", encoding="utf-8")


def write_audit(classes: DataFrame, without_aliases: DataFrame, overrides: DataFrame, releases: DataFrame, path: str) -> None:
    """Everything an audit of a pruning needs: sorted id files per class, of overrides and of what would be pruned without alternate names, the pruned
    releases as JSON lines (their least artist's row), and the counts. ``classes`` and ``without_aliases`` (id, class), ``releases`` (id, artist, title, format)."""
    files = {f"{c}_ids": classes.where(F.col("class") == c).select("id") for c in CLASSES} | {"override_ids": overrides.select("id"), "prune_ids_no_anv": without_aliases.where("class = 'prune'").select("id")}
    for name, ids in files.items():
        ids.distinct().orderBy("id").select(F.col("id").cast("string")).write.mode("overwrite").text(f"{path}/{name}.txt")
    pruned = keep_ids(least_row(releases.select("id", "artist", "title", "format"), "id", "artist"), "id", files["prune_ids"])
    pruned.orderBy("id").write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/prune_releases.jsonl")
    counts = classes.groupBy().pivot("class", list(CLASSES)).agg(F.count_distinct("id")).select(*[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in CLASSES])
    counts.crossJoin(F.broadcast(releases.agg(F.count("*").alias("total_release_rows")))).coalesce(1).write.mode("overwrite").json(f"{path}/counts.json")  # one row each


def read_audit(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """((id, class), (id, artist, title, format)) of a dump: the classes and the pruned releases."""
    out = None
    for c in (*CLASSES, "override"):
        rows = spark.read.schema("value string").text(f"{path}/{c}_ids.txt").select(F.trim("value").try_cast("bigint").alias("id"), F.lit(c).alias("class")).where("id is not null")
        out = rows if out is None else out.unionByName(rows)
    return out, spark.read.schema("id bigint, artist string, title string, format string").json(f"{path}/prune_releases.jsonl")


# --- names under a wrong id ---------------------------------------------------------------------------------------------


def wrong_persons(raw: DataFrame) -> DataFrame:
    """(library_code_id, artist_name, genre, call_letters, call_numbers): the first row of each code of an analysis that says WRONG_PERSON. ``_row_pos`` gives the order, where it is."""
    rows = raw.where("diagnosis = 'WRONG_PERSON'").withColumn("library_code_id", F.col("library_code_id").try_cast("int")).where("library_code_id is not null")
    order = F.col("_row_pos") if "_row_pos" in raw.columns else F.col("artist_name")
    genre = next(c for c in raw.columns if c.endswith("genre"))
    cell = F.struct(order.alias("_o"), "artist_name", F.col(genre).alias("genre"), "call_letters", F.col("call_numbers").try_cast("int").alias("call_numbers"))
    first = rows.groupBy("library_code_id").agg(F.min(cell).alias("_f"))
    return first.select("library_code_id", *[F.col(f"_f.{c}").alias(c) for c in ("artist_name", "genre", "call_letters", "call_numbers")])


def collision_rows(resolved: DataFrame, titles: DataFrame, genres: DataFrame, styles: DataFrame) -> DataFrame:
    """The rows of a resolution report, all texts: name, titles, release, artist, score with three digits, genres and styles of a resolved release, hits and status."""
    joined = lambda df, key, c: df.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set(c)), "; ").alias(f"_{c}"))
    given = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    out = resolved.join(joined(titles, "name", "title"), "name", "left").join(joined(genres, "release_id", "genre"), "release_id", "left").join(joined(styles, "release_id", "style"), "release_id", "left")
    only = lambda c: F.when(F.col("status") == "RESOLVED", given(F.col(c))).otherwise("")
    return out.select("name", given(F.col("_title")).alias("titles"), given(F.col("release_id")).alias("release_id"), given(F.col("artist_id")).alias("artist_id"), F.when(F.col("score").isNull(), "").otherwise(F.format_string("%.3f", F.col("score"))).alias("score"), only("_genre").alias("genres"), only("_style").alias("styles"), given(F.col("hits")).alias("hits"), "status")


# --- ledger of known residue --------------------------------------------------------------------------------------------


def collapsed_ids(lines: DataFrame, header: tuple[str, str]) -> DataFrame:
    """(id, kept_id) of tab-separated lines; blank lines, those that start with # and the header don't count, others of another shape are an error."""
    rows = lines.where("value <> '' and not startswith(value, '#')").where(F.col("value") != "\t".join(header)).select("value", F.split("value", "\t").alias("f"))
    number = lambda i: F.get("f", F.lit(i)).try_cast("bigint")
    fine = (F.size("f") == 2) & number(0).isNotNull() & number(1).isNotNull()
    return rows.select(F.when(fine, number(0)).otherwise(F.raise_error(F.concat(F.lit("not two ids: "), F.col("value")))).alias("id"), number(1).alias("kept_id"))


def write_ledger(pairs: DataFrame, path: str, measured: str) -> None:
    """The ledger's JSON file; baselines that an earlier one held stay. The list was enumerated by hand, so it is small."""
    known = {}
    try:
        known = json.loads(Path(path).read_text(encoding="utf-8"))
    except (OSError, ValueError):
        pass
    baselines = known.get("baselines") if isinstance(known, dict) else None
    out = {"measured_date": measured, "collapsed_mysql_ids": {str(r["id"]): r["kept_id"] for r in pairs.orderBy("id").collect()}, "baselines": baselines if isinstance(baselines, dict) else {"normalizations": {}, "cta_missing": None, "cta_extra": None}}
    Path(path).write_text(json.dumps(out, indent=2, sort_keys=True) + "\n", encoding="utf-8")


def read_ledger(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """((id) of collapsed rows, baselines) of a ledger, checked as a whole before it is used."""
    try:
        data = json.loads(Path(path).read_text(encoding="utf-8"))
        ids = sorted(int(k) for k in data["collapsed_mysql_ids"])
    except (OSError, ValueError, KeyError, TypeError, AttributeError) as e:
        raise SourceError(f"{path} is no ledger: {e}") from e
    baselines = data.get("baselines") or {}
    if not isinstance(baselines, dict) or not isinstance(baselines.get("normalizations", {}), dict):
        raise SourceError(f"{path}: baselines aren't an object")
    for key in ("cta_missing", "cta_extra"):
        value = baselines.get(key)
        if value is not None and (isinstance(value, bool) or not isinstance(value, int)):
            raise SourceError(f"{path}: {key} is neither a whole number nor null")
    return spark.createDataFrame([(i,) for i in ids], "id bigint"), baselines


# --- XML ----------------------------------------------------------------------------------------------------------------

_CREDIT = "array<struct<id:int,name:string,anv:string,join:string,role:string>>"
_RELEASE = (
    f"_id int, _status string, title string, country string, released string, notes string, data_quality string, master_id int, "
    f"formats struct<format:array<struct<_name:string,_qty:string>>>, artists struct<artist:{_CREDIT}>, extraartists struct<artist:{_CREDIT}>, "
    "labels struct<label:array<struct<_id:int,_name:string,_catno:string>>>, tracklist struct<track:array<struct<position:string,title:string,duration:string>>>"
)


def read_releases_xml(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of a dump of ``release`` elements, each from one scan of the columns that it needs: release, release_artist (extra credits marked 1), release_label,
    release_track in order."""
    raw = spark.read.format("xml").option("rowTag", "release").option("nullValue", "").schema(_RELEASE).load(path).where("_id is not null")
    fmt = F.array_join(F.transform("formats.format", lambda f: F.when(F.coalesce(f["_qty"], F.lit("1")) == "1", f["_name"]).otherwise(F.concat(f["_qty"], F.lit("x"), f["_name"]))), ", ")
    releases = raw.select(F.col("_id").alias("id"), F.col("_status").alias("status"), "title", "country", "released", "notes", "data_quality", "master_id", release_category(fmt).alias("format"))
    credit = lambda c, extra: raw.select(F.col("_id").alias("release_id"), F.explode(f"{c}.artist").alias("a"), F.lit(extra).alias("extra"))
    credits = credit("artists", 0).unionByName(credit("extraartists", 1))
    credits = credits.select("release_id", F.col("a.id").alias("artist_id"), F.col("a.name").alias("artist_name"), "extra", F.col("a.anv").alias("anv"), F.col("a.join").alias("join_field"), F.col("a.role").alias("role"))
    labels = raw.select(F.col("_id").alias("release_id"), F.explode("labels.label").alias("l")).select("release_id", F.col("l._id").alias("label_id"), F.col("l._name").alias("label_name"), F.col("l._catno").alias("catno"))
    tracks = raw.select(F.col("_id").alias("release_id"), F.posexplode("tracklist.track").alias("_at", "t")).select("release_id", (F.col("_at") + 1).alias("sequence"), "t.position", "t.title", "t.duration")
    return {"release": releases, "release_artist": credits, "release_label": labels, "release_track": tracks}


def xml_filter(tables: dict[str, DataFrame], artists: DataFrame, form: Callable[[Column], Column]) -> dict[str, DataFrame]:
    """The tables cut to releases with a credit whose name, in the given form, is among the artists (name)."""
    known = artists.select(form(F.col("name")).alias("_n")).distinct()
    ids = tables["release_artist"].select("release_id", form(F.col("artist_name")).alias("_n")).join(known, "_n", "left_semi").select(F.col("release_id").alias("id")).distinct()
    return {name: keep_ids(t, "id" if name == "release" else "release_id", ids) for name, t in tables.items()}


# --- two feeds of one snapshot ------------------------------------------------------------------------------------------


def consistent_snapshot(fetch: Callable[[], tuple[DataFrame, str, DataFrame, str]], key: str, child_key: str, attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """(rows, child rows) of two feeds that tell one state: their watermarks are equal and no child row lacks its row. ``fetch`` gives both with their watermarks and
    is asked again, up to so many times, while they don't."""
    reason = "nothing was fetched"
    for _ in range(attempts):
        rows, mark, children, child_mark = fetch()
        if mark != child_mark:
            reason = f"the watermark moved from {mark} to {child_mark}"
            continue
        dangling = children.select(F.col(child_key).alias("_k")).join(rows.select(F.col(key).alias("_k")), "_k", "left_anti").limit(5).collect()
        if not dangling:
            return rows, children
        reason = f"child rows without their row: {sorted(r['_k'] for r in dangling)}"
    raise SourceError(f"no consistent snapshot in {attempts} attempts: {reason}")
