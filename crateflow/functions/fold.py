"""Accent folding inside the JVM: ``translate`` for one-to-one cases, ``regexp_replace`` for marks, ``replace`` for the rest."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Blocks with letters that decompose: Latin, Greek, Cyrillic, phonetic, ligatures and width forms.
_BLOCKS = (range(0xA0, 0x530), range(0x1D00, 0x2190), range(0xFB00, 0xFB07), range(0xFF01, 0xFFE7))


@cache
def folding(form: str) -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """(sources, targets) of the one-to-one folds under the normal form (NFD or NFKD) without marks, and the one-to-many ones."""
    sources, targets, longer = [], [], []
    for code in (c for block in _BLOCKS for c in block):
        c = chr(code)
        if unicodedata.combining(c):
            continue
        out = "".join(x for x in unicodedata.normalize(form, c) if not unicodedata.combining(x))
        if out == c:
            continue
        if len(out) == 1:
            sources.append(c)
            targets.append(out)
        else:
            longer.append((c, out))
    return "".join(sources), "".join(targets), tuple(longer)


@cache
def combining_marks() -> tuple[tuple[int, int], ...]:
    """Ranges of the characters that combine. Non-spacing signs that don't, such as vowel signs, aren't accents."""
    out: list[list[int]] = []
    for code in range(0x300, 0x10000):
        if unicodedata.combining(chr(code)):
            if out and out[-1][1] == code - 1:
                out[-1][1] = code
            else:
                out.append([code, code])
    return tuple((a, b) for a, b in out)


def strip_accents(c: Column | str, form: str = "NFKD", ligatures: str = "ﬀﬁﬂﬃﬄﬆ") -> Column:
    """Decompose under the form and drop combining marks, as one chain in which each step reads its input once.

    Of the characters that decompose to several, only those of ``ligatures`` do so here. Hangul and ideographs keep their
    code points, on both sides of a comparison.
    """
    text = F.col(c) if isinstance(c, str) else c
    sources, targets, longer = folding(form)
    marks = "".join(f"\\u{a:04X}-\\u{b:04X}" for a, b in combining_marks())
    folded = F.regexp_replace(F.translate(text, sources, targets), f"[{marks}]+", "")
    for a, b in longer:
        if a in ligatures:
            folded = F.replace(folded, F.lit(a), F.lit(b))
    return folded


def fold_name(c: Column | str) -> Column:
    """Comparison fold of a name: accents U+0300..U+036F dropped under NFD, lower case; null becomes empty."""
    text = F.col(c) if isinstance(c, str) else c
    sources, targets, _ = folding("NFD")
    return F.lower(F.regexp_replace(F.translate(F.coalesce(text, F.lit("")), sources, targets), "[\u0300-\u036f]+", ""))
