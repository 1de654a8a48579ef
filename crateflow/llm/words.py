"""Words of a text, blind to case, markup, punctuation, spacing and encoding."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import cache

import regex

from crateflow.llm.canonical_text import LOOK_ALIKES

_MARKUP = re.compile(r"<[/!]?[a-zA-Z][^<>]{0,300}>")
_INVISIBLE = re.compile("[­͏؜ᅟᅠ᠎​-‏‪-‮⁠-⁯︀-️﻿]+")
_MARKS = regex.compile(r"\p{M}+")
_WORD = re.compile(r"[^\W_]+")


@cache
def _alike() -> dict[int, str]:
    return {ord(p[0]): p[-1] for p in LOOK_ALIKES.split() if len(p) == 2 and p[-1].isalpha()}


def words(text: str | None) -> list[str]:
    """The words of a text, folded to base letters in lower case, split at all else. Null and empty text have none."""
    if not text:
        return []
    if "<" in text:
        text = _MARKUP.sub(" ", text)
    if "&" in text:
        text = html.unescape(text)
    if not text.isascii():
        text = _MARKS.sub("", unicodedata.normalize("NFKD", _INVISIBLE.sub("", text))).translate(_alike())
    return _WORD.findall(text.lower())
