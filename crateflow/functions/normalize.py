"""Comparison forms of names and titles, as Column expressions. The families differ on purpose; don't mix them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from crateflow.functions.fold import fold_name, strip_accents

# Articles that a list moves behind a comma, in the order in which they are tried.
COMMA_ARTICLES = ("the", "los", "las", "les", "la", "le", "el", "die", "der", "das")
# Endings of titles that name a format or an edition.
TITLE_SUFFIX = r'\d*"|\(\d+\)|\(\d+\s*(?:cd|lp)\s*set\)|\((?:reissue|deluxe\s+edition|expanded\s+edition|anniversary\s+edition|special\s+edition|limited\s+edition|bonus\s+tracks|ep|lp)\)|\(\d+lp\)'
# Wordings of a compilation's credit.
COMPILATION_PREFIX = r"^(?:various artists|v/a|v\.a|soundtracks)(?:$|[^\p{L}\p{N}])"
COMPILATION_WORDS = ("various", "soundtrack", "compilation")
VARIOUS = r"^various(?:\s+artists(?:\s*-\s*[a-z]+)?)?$"
REPLACEMENT = "�"


def strip(c: Column) -> Column:
    """Outer white space of any script removed."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def match_title(c: Column) -> Column:
    """Linkage form of a title: stripped, lower, without accents and without endings that name formats or editions, however many."""
    folded = strip_accents(F.lower(strip(c)))
    return strip(F.regexp_replace(folded, rf"(?:\s*(?:{TITLE_SUFFIX}))+\s*$", ""))


def compare_form(c: Column) -> Column:
    """Stripped, lower, without accents, trailing ``(N)`` and ``[...]``, with ``X, The`` turned to ``the X``."""
    folded = strip_accents(F.lower(strip(c)))
    plain = F.regexp_replace(F.regexp_replace(folded, r"\s*\(\d+\)\s*$", ""), r"\s*\[.*?\]\s*$", "")
    return strip(F.regexp_replace(plain, rf"^(.*),\s+({'|'.join(COMMA_ARTICLES)})$", "$2 $1"))


def match_artist(c: Column) -> Column:
    """Linkage form of an artist: the compare form with ``&`` spelt out, apostrophes dropped and white space collapsed."""
    return F.trim(F.regexp_replace(F.replace(F.replace(compare_form(c), F.lit("&"), F.lit(" and ")), F.lit("'"), F.lit("")), r"\s+", " "))


def light_form(c: Column) -> Column:
    """Filter form: accents dropped, lower, stripped; nothing else."""
    return strip(F.lower(strip_accents(c)))


def parity_artist(c: Column) -> tuple[Column, Column]:
    """(name, is_various): compilation credits under one name, others stripped."""
    t = strip(c)
    various = F.lower(t).rlike(VARIOUS)
    return F.when(various, "Various Artists").otherwise(t), F.coalesce(various, F.lit(False))


def code_letters(c: Column) -> Column:
    """Shelf letters: null for blank, V/A for codes with Z-letter, three letters as they are, else the first two; upper case."""
    t = strip(c)
    return F.when((t == "") | t.isNull(), None).when(t.rlike("Z-[A-Z]"), "V/A").when(F.length(t) == 3, F.upper(t)).otherwise(F.upper(F.substring(t, 1, 2)))


def none_form(c: Column) -> Column:
    """Stripped text; empty and the literal NULL become null."""
    return F.nullif(F.nullif(strip(c), F.lit("")), F.lit("NULL"))


def flat_breaks(c: Column) -> Column:
    """Tabs and line breaks as spaces."""
    return F.translate(c, "\t\n", "  ")


def without_nul(c: Column) -> Column:
    return F.translate(c, "\u0000", "")


def is_db_only_genre(c: Column) -> Column:
    """Whether a genre marks rows that only the first system keeps."""
    return F.coalesce(F.lower(strip(c)) == "db_only", F.lit(False))


def is_compilation(c: Column) -> Column:
    """Whether a credit names a compilation; null counts as no."""
    low = F.lower(strip(c))
    return F.coalesce(low.rlike(COMPILATION_PREFIX) | low.isin(*COMPILATION_WORDS), F.lit(False))


def is_various(artist_id: Column, name: Column) -> Column:
    return F.coalesce((artist_id == 194) | (name == "Various"), F.lit(False))


def is_corrupt(c: Column) -> Column:
    """Whether the text lost bytes to U+FFFD."""
    return F.coalesce(c.contains(REPLACEMENT), F.lit(False))


def split_refs(c: Column) -> Column:
    """Cross references joined by `` | `` as an array without empties; null gives an empty array."""
    parts = F.transform(F.split(F.coalesce(none_form(c), F.lit("")), r" \| "), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def split_names(c: Column) -> Column:
    """Parts of a joint credit at ``, ``, `` / `` and `` + ``; a name without such a joint, or with a number or a single letter for a
    part, gives null."""
    parts = F.transform(F.split(c, r",\s+|\s+/\s+|\s+\+\s+"), lambda x: F.trim(x))
    fine = (F.size(parts) > 1) & ~F.exists(parts, lambda x: x.rlike(r"^\d+$") | (F.length(x) < 2))
    return F.when(fine, parts)


def codepoints(c: Column) -> Column:
    """Array of (index, char, U+XXXX) for the characters beyond ASCII."""
    chars = F.transform(F.split(c, ""), lambda x, i: F.struct(i.alias("index"), x.alias("char"), F.concat(F.lit("U+"), F.lpad(F.hex(F.ascii(x)), 4, "0")).alias("code")))
    return F.filter(chars, lambda s: F.ascii(s["char"]) > 127)


def artwork_uri(document: Column) -> Column:
    """Address of the first image of a release's JSON; null where there's none or it's empty."""
    return F.nullif(F.get_json_object(document, "$.images[0].uri"), F.lit(""))
