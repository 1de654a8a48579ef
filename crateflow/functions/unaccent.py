"""Folds by rules: a table of single characters and their replacements, applied inside the JVM or as SQL text."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Letters without a decomposition, and their replacement.
STROKED = {"Ø": "O", "ø": "o", "Ł": "L", "ł": "l", "Đ": "D", "đ": "d", "Ħ": "H", "ħ": "h", "Ŧ": "T", "ŧ": "t", "ı": "i", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "Þ": "TH", "þ": "th", "Ð": "D", "ð": "d"}
_LATIN = (range(0xC0, 0x250), range(0x1E00, 0x1F00))


def parse_rules(text: str) -> list[tuple[str, str]]:
    """(source, target) of lines of two tab-separated fields; blank lines and those that start with # don't count, others are an error."""
    out = []
    for n, line in enumerate(text.splitlines(), 1):
        if line.strip() and not line.lstrip().startswith("#"):
            source, tab, target = line.partition("\t")
            if not tab or not source or not target or "\t" in target:
                raise ValueError(f"line {n} isn't two fields: {line!r}")
            out.append((source, target))
    return out


def split_rules(rules: list[tuple[str, str]]) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """(rules to one character, rules to several). Sources of several characters are an error, and so is a longer target whose characters
    a one-character rule would fold again."""
    if any(len(s) != 1 for s, _ in rules):
        raise ValueError("a source has several characters")
    one, several = [r for r in rules if len(r[1]) == 1], [r for r in rules if len(r[1]) != 1]
    again = {c for _, t in several for c in t} & {s for s, _ in one}
    if again:
        raise ValueError(f"folded twice: {sorted(again)}")
    return one, several


@cache
def default_rules() -> tuple[tuple[str, str], ...]:
    """Latin letters by their base letters, and the stroked ones."""
    out = dict(STROKED)
    for c in (chr(code) for block in _LATIN for code in block):
        base = "".join(x for x in unicodedata.normalize("NFD", c) if not unicodedata.combining(x))
        if base != c and c not in out:
            out[c] = "".join(STROKED.get(x, x) for x in base)
    return tuple(out.items())


def fold_by_rules(c: Column, rules=None) -> Column:
    """The text with every rule applied: longer targets by replacement, then all one-character ones at once."""
    one, several = split_rules(list(default_rules() if rules is None else rules))
    for source, target in several:
        c = F.replace(c, F.lit(source), F.lit(target))
    return F.translate(c, "".join(s for s, _ in one), "".join(t for _, t in one)) if one else c


def unaccent(c: Column) -> Column:
    """Lower case without accents or strokes."""
    return F.lower(fold_by_rules(c))


def sql_function(name: str, rules=None) -> str:
    """The fold as a SQL function's definition."""
    one, several = split_rules(list(default_rules() if rules is None else rules))
    quote = lambda t: "'" + t.replace("\\", "\\\\").replace("'", "\\'") + "'"
    body = "value"
    for source, target in several:
        body = f"replace({body}, {quote(source)}, {quote(target)})"
    return f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING) RETURNS STRING RETURN translate({body}, {quote(''.join(s for s, _ in one))}, {quote(''.join(t for _, t in one))})"


def register(spark: SparkSession) -> list[str]:
    """Makes the library's text functions known to SQL, under the names returned."""
    from crateflow.functions import identity

    spark.sql(sql_function("unaccent_text"))
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION f_unaccent(value STRING) RETURNS STRING RETURN unaccent_text(value)")
    kernels = {
        "identity_match_artist": identity.identity_form, "identity_match_title": identity.identity_form,
        "identity_match_with_punctuation": identity.identity_punctuation_form, "identity_match_with_disambiguator_strip": identity.identity_disambiguated_form,
    }
    for name, f in kernels.items():
        spark.udf.register(name, f)
    return ["unaccent_text", "f_unaccent", *kernels]
