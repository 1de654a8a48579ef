"""Two snapshots of a catalog: presence, tiers per field, multisets, repair of damaged text."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crateflow.functions.formats import shelf_format
from crateflow.functions.mojibake import explained_by
from crateflow.functions.normalize import code_letters, flat_breaks, fold_name, is_corrupt, is_db_only_genre, none_form, parity_artist, split_refs, strip

#: Ids from here on are given out by the second system, so it alone has them by construction.
MINTED_FROM = 1_000_000
#: Columns of which the second system keeps one value an artist, so that rows of one folded name may explain each other's.
COLLAPSING = ("call_letters", "artist_call_number")
COLUMNS = ("title", "artist", "call_letters", "artist_call_number", "release_call_number", "genre", "format", "alternate_artist_name", "album_artist", "cross_reference_names")


def _text(c: Column) -> Column:
    return none_form(c.cast("string"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def _same_but_case(a: Column, b: Column) -> Column:
    return F.coalesce(F.lower(a) == F.lower(b), F.lit(False))


def artist_of(artist: Column) -> tuple[Column, Column]:
    """(name, is_various) that a row's artist is stored under: breaks as blanks, compilation wordings as one."""
    return parity_artist(flat_breaks(F.coalesce(artist, F.lit(""))))


def stored_letters(letters: Column, artist: Column) -> tuple[Column, Column]:
    """(letters, class) that a row's shelf letters are stored as."""
    derived, various = code_letters(letters), artist_of(artist)[1]
    kind = F.when(various, "various").when(derived.isNull(), "fallback_unknown").when(derived == "V/A", "various_artists_code").otherwise("uppercased")
    return F.when(various, "V/A").otherwise(F.coalesce(derived, F.lit("??"))), kind


def stored_number(number: Column, artist: Column) -> tuple[Column, Column]:
    """(number as text, class) that a row's artist number is stored as: 0 for compilations and for none."""
    various = artist_of(artist)[1]
    return F.when(various, "0").otherwise(F.coalesce(_text(number), F.lit("0"))), F.when(various, "various").otherwise("null_coalesced_zero")


def _fold_set(refs: Column, name=lambda x: x) -> Column:
    return F.array_distinct(F.transform(split_refs(refs), lambda x: fold_name(name(x))))


def classify_field(column: str, left: Callable[[str], Column], right: Callable[[str], Column]) -> Column:
    """struct(tier, class) of one column of a matched pair of rows; ``left`` and ``right`` give the rows' columns by name.

    ``agree``: equal but for outer white space, empty, null and the literal NULL. ``normalized``: the right value is what the second system makes of
    the left one, and class says how. ``mismatch``: neither.
    """
    raw, other = left(column), right(column)
    agree, b = _same(_text(raw), _text(other)), _text(other)
    no_class = F.lit(None).cast("string")
    if column in ("title", "alternate_artist_name", "album_artist"):
        rules = [(_same(b, _text(flat_breaks(raw))), F.lit("tab_newline_substituted"))]
    elif column == "artist":
        name, various = artist_of(raw)
        folded = b.isNotNull() & _text(name).isNotNull() & (fold_name(b) == fold_name(_text(name)))
        rules = [(_same(b, _text(name)), F.when(various, "various_artists").otherwise("trimmed_or_substituted")), (folded, F.lit("fold_equal"))]
    elif column == "call_letters":
        expected, kind = stored_letters(raw, left("artist"))
        rules = [(_same_but_case(b, _text(expected)), kind)]
    elif column == "artist_call_number":
        expected, kind = stored_number(raw, left("artist"))
        rules = [(_same(b, expected), kind)]
    elif column == "release_call_number":
        rules = [(_same(b, F.coalesce(_text(raw), F.lit("0"))), F.lit("null_coalesced_zero"))]
    elif column == "genre":
        rules = [(_same_but_case(b, _text(raw)), F.lit("case_folded"))]
    elif column == "format":
        rules = [(_same_but_case(b, shelf_format(F.coalesce(raw, F.lit("")))["name"]), F.lit("format_derived"))]
    elif column == "cross_reference_names":
        x, y = _fold_set(raw, lambda n: artist_of(n)[0]), _fold_set(other)
        less, more = F.size(F.array_except(y, x)) == 0, F.size(F.array_except(x, y)) == 0
        rules = [(less & more, F.lit("fold_equal")), (less, F.lit("cardinality_loss")), (more, F.lit("cardinality_gain"))]
    else:
        raise KeyError(column)
    pair = lambda tier, kind: F.struct(F.lit(tier).alias("tier"), kind.alias("class"))
    out = F.when(agree, pair("agree", no_class))
    for hit, kind in rules:
        out = out.when(F.coalesce(hit, F.lit(False)), pair("normalized", kind))
    return out.otherwise(pair("mismatch", no_class))


def missing_reason(genre: Column, fmt: Column, artist: Column, title: Column) -> Column:
    """Why the second system may lack a row, null if it should have it. The literal NULL is a name like any other here."""
    blank = lambda c: F.coalesce(strip(c) == "", F.lit(True))
    return (
        F.when(is_db_only_genre(genre), "db_only_genre").when(shelf_format(F.coalesce(fmt, F.lit("")))["name"].isNull(), "unparseable_format")
        .when(blank(artist), "empty_artist_name").when(blank(title), "empty_album_title")
    )


def _reason(prefix: str = "") -> Column:
    return missing_reason(*[F.col(prefix + c) for c in ("genre", "format", "artist", "title")])


def checked_rows(df: DataFrame, key: str) -> DataFrame:
    """The rows, which fail where an id occurs twice."""
    repeated = df.groupBy(key).agg(F.count("*").alias("_n")).where("_n > 1")
    row = repeated.first()
    if row is not None:
        raise ValueError(f"{key} {row[0]} occurs {row['_n']} times")
    return df


def field_classes(left: DataFrame, right: DataFrame, key: str, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """(key, field, tier, class) of each column of the rows that both have, in one join.

    A mismatch in one of ``COLLAPSING`` is ``fold_collapsed`` if the right value is what some left row of the same folded artist would store, rows that
    the second system skips apart, and for numbers only within the same genre.
    """
    need = sorted({*columns, "artist", "genre", "format", "title"} & set(left.columns))
    both = left.select(key, *[F.col(c).alias(f"l_{c}") for c in need]).join(right.select(key, *[F.col(c).alias(f"r_{c}") for c in columns]), key)
    l, r = lambda c: F.col(f"l_{c}"), lambda c: F.col(f"r_{c}")  # noqa: E731, E741
    cells = F.array(*[F.struct(F.lit(c).alias("field"), classify_field(c, l, r).alias("x"), (F.upper(_text(r(c))) if c == "call_letters" else _text(r(c))).alias("value")) for c in columns])
    genre = F.coalesce(F.lower(_text(l("genre"))), F.lit(""))
    flat = both.select(key, fold_name(artist_of(l("artist"))[0]).alias("fold"), genre.alias("genre"), F.explode(cells).alias("c")).select(key, "fold", "genre", "c.field", "c.value", "c.x.tier", "c.x.class")
    if not set(COLLAPSING) & set(columns):
        return flat.select(key, "field", "tier", "class")
    rows = left.where(_reason().isNull())
    letters, number = stored_letters(F.col("call_letters"), F.col("artist"))[0], stored_number(F.col("artist_call_number"), F.col("artist"))[0]
    given = F.array(
        F.struct(F.lit("call_letters").alias("field"), F.lit(None).cast("string").alias("genre"), F.upper(_text(letters)).alias("value")),
        F.struct(F.lit("artist_call_number").alias("field"), F.coalesce(F.lower(_text(F.col("genre"))), F.lit("")).alias("genre"), number.alias("value")),
    )
    supplied = rows.select(fold_name(artist_of(F.col("artist"))[0]).alias("fold"), F.explode(given).alias("g")).select("fold", "g.*").distinct().withColumn("_has", F.lit(True))
    missed = flat.where((F.col("tier") == "mismatch") & F.col("field").isin(*COLLAPSING)).withColumn("genre", F.when(F.col("field") == "artist_call_number", F.col("genre")))
    s = supplied.select(*[F.col(c).alias(f"_{c}") for c in ("fold", "field", "genre", "value")], "_has")
    same = (F.col("fold") == F.col("_fold")) & (F.col("field") == F.col("_field")) & F.col("genre").eqNullSafe(F.col("_genre")) & F.col("value").eqNullSafe(F.col("_value"))
    settled = missed.join(s, same, "left").select(key, "field", F.when(F.col("_has"), "normalized").otherwise("mismatch").alias("tier"), F.when(F.col("_has"), "fold_collapsed").alias("class"))
    rest = flat.where(~((F.col("tier") == "mismatch") & F.col("field").isin(*COLLAPSING))).select(key, "field", "tier", "class")
    return rest.unionByName(settled)


def row_expectations(left: DataFrame, right: DataFrame, key: str, ledger: DataFrame | None = None) -> DataFrame:
    """(key, side, expected): rows on one side only. A missing row is expected if ``missing_reason`` has one or the ledger (id) lists it, an extra one if its id was minted."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    listed = left.select(F.col(key).alias("_id")).limit(0) if ledger is None else ledger.select(F.col("id").alias("_id")).distinct()
    missing = left.join(b, key, "left_anti").join(listed.withColumn("_in", F.lit(True)), F.col(key) == F.col("_id"), "left")
    one = missing.select(key, F.lit("missing").alias("side"), (F.coalesce("_in", F.lit(False)) | _reason().isNotNull()).alias("expected"))
    return one.unionByName(b.join(a, key, "left_anti").select(key, F.lit("extra").alias("side"), (F.col(key) >= MINTED_FROM).alias("expected")))


def verdict(expectations: DataFrame, fields: DataFrame, others: DataFrame, missing_baseline: int = 0, extra_baseline: int = 0) -> DataFrame:
    """(missing_expected, missing_unexplained, extra_expected, extra_unexplained, mismatches, clean, causes): clean if nothing is unexplained, no field mismatches and the
    surplus of the tracks' multiset (missing, extra) lies within its baselines; causes names what isn't."""
    count = lambda side, yes: F.count_if((F.col("side") == side) & (F.col("expected") == yes))
    e = expectations.agg(count("missing", True).alias("missing_expected"), count("missing", False).alias("missing_unexplained"), count("extra", True).alias("extra_expected"), count("extra", False).alias("extra_unexplained"))
    m = fields.agg(F.count_if(F.col("tier") == "mismatch").alias("mismatches"))
    o = others.agg(F.coalesce(F.sum("missing"), F.lit(0)).alias("_m"), F.coalesce(F.sum("extra"), F.lit(0)).alias("_x"))
    causes = F.array_compact(F.array(
        F.when(F.col("missing_unexplained") > 0, "missing rows"), F.when(F.col("extra_unexplained") > 0, "extra rows"), F.when(F.col("mismatches") > 0, "field mismatches"),
        F.when((F.col("_m") > missing_baseline) | (F.col("_x") > extra_baseline), "track credits"),
    ))
    row = e.join(F.broadcast(m)).join(F.broadcast(o))  # one row each
    return row.select("missing_expected", "missing_unexplained", "extra_expected", "extra_unexplained", "mismatches", (F.size(causes) == 0).alias("clean"), F.array_join(causes, ", ").alias("causes"))


def unmatched(left: DataFrame, right: DataFrame, lkey: Column, rkey: Column) -> DataFrame:
    """(rows, unmatched): rows of the left table, and those whose key no right row has; null keys match nothing."""
    known = right.select(rkey.alias("_k")).where("_k is not null").distinct().withColumn("_has", F.lit(1))
    return left.select(lkey.alias("_k")).join(known, "_k", "left").agg(F.count("*").alias("rows"), F.count_if(F.col("_has").isNull()).alias("unmatched"))


def presence(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """(key, presence): matched, missing (left only) or extra (right only)."""
    a, b = left.select(key).distinct().withColumn("_l", F.lit(1)), right.select(key).distinct().withColumn("_r", F.lit(1))
    return a.join(b, key, "full").select(key, F.when(F.col("_r").isNull(), "missing").when(F.col("_l").isNull(), "extra").otherwise("matched").alias("presence"))


def field_tiers(left: DataFrame, right: DataFrame, key: str, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """(field, tier, n), zeros included: a histogram of the matched rows."""
    found = field_classes(left, right, key, columns).groupBy("field", "tier").agg(F.count("*").alias("n"))
    grid = left.sparkSession.createDataFrame([(c, t) for c in columns for t in ("agree", "normalized", "mismatch")], "field string, tier string")
    return grid.join(found, ["field", "tier"], "left").select("field", "tier", F.coalesce("n", F.lit(0)).alias("n"))


def multiset_difference(left: DataFrame, right: DataFrame, columns: list[str]) -> DataFrame:
    """(columns, missing, extra): how many more of each row one side has; equal nulls are equal."""
    count = lambda d, s: d.groupBy(*columns).agg(F.sum(F.lit(s)).alias("n"))
    net = count(left, 1).unionByName(count(right, -1)).groupBy(*columns).agg(F.sum("n").alias("n")).where("n <> 0")
    return net.select(*columns, F.greatest("n", F.lit(0)).alias("missing"), F.greatest(-F.col("n"), F.lit(0)).alias("extra"))


def fold_groups(df: DataFrame, name: str, column: str) -> DataFrame:
    """(fold, values): all values of a column among rows whose names fold alike, where there's more than one name."""
    rows = df.where(F.col(name).isNotNull()).select(fold_name(name).alias("fold"), F.col(name).alias("name"), F.col(column).alias("value")).distinct()
    return rows.groupBy("fold").agg(F.count_distinct("name").alias("names"), F.array_sort(F.collect_set("value")).alias("values")).where("names > 1").drop("names")


def repair(damaged: DataFrame, clean: DataFrame, key: list[str], columns: list[str], row: str) -> DataFrame:
    """(row, outcome, values): each row with damaged text in one of the columns against the clean rows of its key. The candidates explain every damaged column and
    equal the others; they count once for the same damaged columns. ``resolved`` by one, else ``multiple_candidates``, ``corrupt_candidates`` where only damaged ones
    would do, or ``zero_candidates``. ``values`` are the columns as repaired."""
    hurt = [F.coalesce(is_corrupt(F.col(c)), F.lit(False)) for c in columns]
    bad = damaged.where(functools.reduce(lambda a, b: a | b, hurt)).select(row, *key, *[F.col(c).alias(f"_b_{c}") for c in columns])
    pairs = bad.join(clean.select(*key, *[F.col(c).alias(f"_g_{c}") for c in columns]).distinct(), key)
    fits, own, still = F.lit(True), [], F.lit(False)
    for c in columns:
        broken = is_corrupt(F.col(f"_b_{c}"))
        fits = fits & F.when(broken, explained_by(f"_b_{c}", f"_g_{c}") | is_corrupt(F.col(f"_g_{c}"))).otherwise(F.col(f"_b_{c}").eqNullSafe(F.col(f"_g_{c}")))
        still = still | (broken & is_corrupt(F.col(f"_g_{c}")))
        own.append(F.when(broken, F.col(f"_g_{c}")))
    hits = pairs.where(fits).select(row, still.alias("still"), F.struct(*[o.alias(c) for o, c in zip(own, columns)]).alias("fix"), F.array(*[F.col(f"_g_{c}") for c in columns]).alias("whole")).distinct()
    good = hits.where("not still").groupBy(row).agg(F.count_distinct("fix").alias("n"), F.min("whole").alias("values"))
    worse = hits.where("still").select(row).distinct().withColumn("_c", F.lit(True))
    out = bad.select(row).distinct().join(good, row, "left").join(worse, row, "left")
    outcome = F.when(F.col("n") == 1, "resolved").when(F.col("n") > 1, "multiple_candidates").when(F.col("_c"), "corrupt_candidates").otherwise("zero_candidates")
    return out.select(row, outcome.alias("outcome"), F.when(F.col("n") == 1, F.col("values")).alias("values"))


def cross_references(edges: DataFrame, names: DataFrame) -> DataFrame:
    """(id, names): the sorted distinct names that each id is linked with in either direction, itself apart. ``edges`` (a, b), ``names`` (id, name)."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    named = both.join(names.select(F.col("id").alias("b"), "name").dropna().distinct(), "b")
    return named.groupBy(F.col("a").alias("id")).agg(F.array_join(F.array_sort(F.collect_set("name")), " | ").alias("names"))


def reconcile(identities: DataFrame, credits: DataFrame, name: str) -> DataFrame:
    """Identities with the least artist id credited under the first 200 characters of their name, case apart."""
    ids = credits.where("artist_id is not null").groupBy(F.lower(F.substring("artist_name", 1, 200)).alias("_n")).agg(F.min("artist_id").alias("artist_id"))
    return identities.join(ids, F.lower(F.substring(name, 1, 200)) == F.col("_n"), "left").drop("_n")
