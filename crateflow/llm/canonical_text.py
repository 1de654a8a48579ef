"""One consistent encoding for text that looks the same."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache, lru_cache

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crateflow.functions.identity import LOOK_ALIKES
from crateflow.session import cut_lineage, spread

_PREPENDED = frozenset(map(chr, [*range(0x600, 0x606), 0x6DD, 0x70F, 0x890, 0x891, 0x8E2, 0x110BD, 0x110CD]))
_FILLERS = frozenset("͏ᅟᅠㅤﾠ")
_DIGRAPH_START = 0x132
#: Zero-width joiner and non-joiner change what is seen between letters of these scripts and between pictures, and nothing elsewhere.
_JOINERS = regex.compile("[\u200c\u200d]+")
_SHAPED = regex.compile(
    r"[\p{Arabic}\p{Syriac}\p{Nko}\p{Mongolian}\p{Devanagari}\p{Bengali}\p{Gurmukhi}\p{Gujarati}\p{Oriya}\p{Tamil}\p{Telugu}\p{Kannada}\p{Malayalam}\p{Sinhala}\p{Khmer}\p{Myanmar}\p{Extended_Pictographic}\p{Emoji_Modifier}]"
)
#: Where characters stand that a rule can touch; the rest (ideographs, syllables, private use, unassigned) keeps its code.
_BLOCKS = (range(0x3300), range(0xA640, 0xAC00), range(0xF900, 0x10000), range(0x1D400, 0x1D800), range(0x2F800, 0x2FA20), range(0xE0000, 0xE0200))


def _joined(m: regex.Match) -> str:
    """What is left of a run of joiners: one between two characters that it may tie or part, else none."""
    text, (i, j) = m.string, m.span()
    while i and unicodedata.combining(text[i - 1]):
        i -= 1
    return m[0][0] if i and j < len(text) and _SHAPED.match(text[i - 1]) and _SHAPED.match(text[j]) else ""


def _invisible(c: str) -> bool:
    kind = unicodedata.category(c)
    selector = 0xFE00 <= ord(c) <= 0xFE0F or 0xE0100 <= ord(c) <= 0xE01EF
    return selector or c in _FILLERS or (kind == "Cf" and c not in _PREPENDED) or (kind == "Cc" and not c.isspace())


def _rule_targets(c: str) -> Iterator[str]:
    """Every target that a rule gives to the character; more than one different is a conflict."""
    if c in "\u200c\u200d":
        return
    if _invisible(c):
        yield ""
        return
    if c.isspace():
        yield " "
        return
    kind, _, _ = unicodedata.decomposition(c).partition(" ")
    if kind in ("<wide>", "<narrow>", "<font>"):
        yield unicodedata.normalize("NFKC", c)
    elif kind == "<compat>" and ord(c) >= _DIGRAPH_START and unicodedata.category(c) in ("Ll", "Lu", "Lt", "Nl"):
        flat = unicodedata.normalize("NFKC", c)
        # Ligatures, digraphs and Roman numerals; a long s keeps its own shape.
        if c not in "ſŉ" and flat.isalpha():
            yield flat
    elif not kind.startswith("<"):
        whole = unicodedata.normalize("NFC", c)
        if whole != c:
            yield whole


class ConflictError(ValueError):
    """Two rules map one source to different targets, or a target isn't itself in canonical form."""


def compile_table() -> dict[str, str]:
    """Source sequence (decomposed) -> target, checked: one target per source, and every target maps to itself."""
    table: dict[str, str] = {}

    def put(source: str, target: str) -> None:
        if table.setdefault(source, target) != target:
            raise ConflictError(f"{source!r} maps to {table[source]!r} and to {target!r}")

    for pair in LOOK_ALIKES.split():
        put(pair[:-1], pair[-1])
    alike, composed = dict(table), []
    for c in map(chr, (code for block in _BLOCKS for code in block)):
        if c in alike or " " <= c <= "~":
            continue
        for target in _rule_targets(c):
            resolved = "".join(alike.get(x, x) for x in target)
            if resolved != c:
                put(c, resolved)
        parts = unicodedata.normalize("NFD", c)
        if len(parts) > 1 and unicodedata.normalize("NFC", parts) == c:
            composed.append(parts)
    # Accents: base and marks as one letter, look-alike bases and widths included.
    for parts in composed:
        target = unicodedata.normalize("NFC", "".join(table.get(c, c) for c in parts))
        if table.get(parts, target) != target:
            raise ConflictError(f"{parts!r} maps to {table[parts]!r} and to {target!r}")
        table[parts] = target
    for source, target in table.items():
        for c in target:
            if table.get(c, c) != c:
                raise ConflictError(f"{source!r} maps to {target!r}, which maps on")
    return table


class Transducer:
    """Rewrites text cluster by cluster, at each place by the longest source sequence of the table."""

    def __init__(self, table: dict[str, str]):
        self.table = table
        self.longest = max(map(len, table))
        self.cluster = lru_cache(maxsize=100_000)(self._cluster)
        self.clusters = regex.compile(r"\X").findall

    def _cluster(self, cluster: str) -> str:
        visible = "".join(c for c in cluster if c in "\u200c\u200d" or not _invisible(c))
        source = unicodedata.normalize("NFD", visible)
        out, i = [], 0
        while i < len(source):
            for n in range(min(self.longest, len(source) - i), 0, -1):
                target = self.table.get(source[i : i + n])
                if target is not None:
                    break
            else:
                n, target = 1, source[i]
            out.append(target)
            i += n
        # Marks that no sequence of the table covers still join a rewritten base.
        return unicodedata.normalize("NFC", "".join(out))

    def __call__(self, text: str) -> str:
        if text.isascii() and text.isprintable():
            return text.strip()
        # An invisible character may stand between a base and its mark, so it goes before clusters are formed.
        seen = "".join([c for c in text if c.isprintable() or c in "\u200c\u200d" or not _invisible(c)])
        if "\u200c" in seen or "\u200d" in seen:
            seen = _JOINERS.sub(_joined, unicodedata.normalize("NFC", seen))
        return "".join(map(self.cluster, self.clusters(seen))).strip()


@cache
def transducer() -> Transducer:
    """The compiled transducer of this process."""
    return Transducer(compile_table())


@F.pandas_udf(T.StringType())
def _canonical(texts: pd.Series) -> pd.Series:
    rewrite = transducer()
    return pd.Series([None if t is None else rewrite(t) for t in texts], dtype=object)


def canonical(text: Column | str) -> Column:
    """The canonical form of a text column; null stays null, empty and all-invisible text becomes empty.

    Width forms, styled letters, ligatures, combining accents, space variants and letters of look-alike shape take one
    form; invisible characters and outer space go, but for joiners between letters that they shape. Case, accents, punctuation and spelling stay.
    """
    return _canonical(text)


def canonical_forms(df: DataFrame, fields: list[str]) -> DataFrame:
    """(field_name, text, canonical) for each distinct non-null value of the fields. Values are made distinct, with
    map-side combining, before they go through the transducer once each."""
    cells = df.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), F.col(f).cast("string").alias("text")) for f in fields])).alias("_c"))
    values = spread(cells.select("_c.*").where("text is not null").distinct(), "text")
    return values.select("field_name", "text", canonical("text").alias("canonical"))


def same_reading_pairs(forms: DataFrame) -> DataFrame:
    """(field_name, text_a, text_b), text_a < text_b by code point: values of one field with one canonical form. The forms are stored once."""
    forms = cut_lineage(forms)
    several = forms.groupBy("field_name", "canonical").agg(F.count("*").alias("_n")).where("_n > 1").select("field_name", "canonical")
    kept = forms.join(several, ["field_name", "canonical"], "left_semi")
    a = kept.withColumnRenamed("text", "text_a")
    b = kept.withColumnRenamed("text", "text_b")
    return a.join(b, ["field_name", "canonical"]).where("text_a < text_b").select("field_name", "text_a", "text_b")
