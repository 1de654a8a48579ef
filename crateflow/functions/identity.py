"""Identity forms of names and titles: storage, match and ASCII forms, and the forms under which spellings of one artist are equal."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other scripts that have the shape of a Latin letter, and that letter.
LOOK_ALIKES = (
    "аa еe оo рp сc уy хx іi јj ѕs һh ԁd ԛq ԝw ѵv ӏl ԍg ҽe "
    "АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЈJ ЅS ҺH ԌG ԚQ ԜW ѴV ӀI "
    "οo ρp νv ιı κĸ ϲc ϳj αa υu "
    "ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX ϹC ϺM "
    "օo ոn սu հh զq ցg ՏS ՕO ԼL "
    "ɡg ɑa ‐- ‑-"
)
# Letters that have no decomposition, by their base letters.
BASE_LETTERS = {"ø": "o", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "æ": "ae", "œ": "oe", "ħ": "h", "ı": "i", "ŧ": "t"}

# Latin spellings of Cyrillic and Greek letters, without case and accents.
LATIN_SPELLINGS = {
    "а": "a", "б": "b", "в": "v", "г": "g", "д": "d", "е": "e", "ё": "yo", "ж": "zh", "з": "z", "и": "i", "й": "y", "к": "k", "л": "l", "м": "m", "н": "n", "о": "o", "п": "p", "р": "r", "с": "s", "т": "t", "у": "u",
    "ф": "f", "х": "kh", "ц": "ts", "ч": "ch", "ш": "sh", "щ": "shch", "ъ": "", "ы": "y", "ь": "", "э": "e", "ю": "yu", "я": "ya", "і": "i", "ї": "yi", "є": "ye", "ґ": "g",
    "α": "a", "β": "v", "γ": "g", "δ": "d", "ε": "e", "ζ": "z", "η": "i", "θ": "th", "ι": "i", "κ": "k", "λ": "l", "μ": "m", "ν": "n", "ξ": "x", "ο": "o", "π": "p", "ρ": "r", "σ": "s", "τ": "t", "υ": "y", "φ": "f", "χ": "ch", "ψ": "ps", "ω": "o",
    "‘": "'", "’": "'", "“": '"', "”": '"', "–": "-", "—": "-", "…": "...",
}

_ALIKE = {ord(p[0]): p[-1] for p in LOOK_ALIKES.split()}
_BASE = str.maketrans({a: b for a, b in BASE_LETTERS.items() if a != "ı"})
_SPELLED = str.maketrans(LATIN_SPELLINGS | BASE_LETTERS)
_FORMAT = regex.compile(r"[\p{Cf}--‍]+", regex.V1)
_JOINER = regex.compile(r"(?<!\p{Extended_Pictographic}[️\U0001f3fb-\U0001f3ff]?)‍|‍(?!\p{Extended_Pictographic})")
_MARKS = regex.compile(r"\p{Mn}+")
_LATIN = regex.compile(r"\p{Latin}")
_SPACE = regex.compile(r"\s+")
_OTHER = regex.compile(r"[^\p{L}\p{N}]+")
_LEADING = regex.compile(r"^(?:the|a|an)\s+(?=\S)")
_TRAILING = regex.compile(r",\s+(?:the|a|an)$")
_NUMBER = regex.compile(r"\s+/\d+$")


def _repaired(text: str) -> str:
    """The text whose UTF-8 bytes were read in a one-byte encoding, if all of it reads as such; else the text."""
    if text.isascii():
        return text
    for encoding in ("cp1252", "latin-1"):
        try:
            return text.encode(encoding).decode("utf-8")
        except UnicodeError:
            pass
    return text


@lru_cache(maxsize=200_000)
def storage(text: str) -> str:
    """Text to keep: damage by a wrong encoding undone, composed, ASCII white space at the ends off."""
    return unicodedata.normalize("NFC", _repaired(text)).strip(" \t\n\r\x0b\x0c")


@lru_cache(maxsize=200_000)
def match(text: str) -> str | None:
    """Text to compare by: compatibility forms, case and accents folded, final sigma as any sigma, format characters out but for joiners between
    pictures. Text with a NUL has none."""
    if "\0" in text:
        return None
    text = unicodedata.normalize("NFKC", storage(text)).casefold()
    # A breve or diaeresis that makes a Cyrillic letter of its own stays.
    text = "".join(c if "Ѐ" <= c <= "ӿ" else _MARKS.sub("", unicodedata.normalize("NFD", c)) for c in unicodedata.normalize("NFC", _FORMAT.sub("", text)))
    return unicodedata.normalize("NFC", _MARKS.sub("", _JOINER.sub("", text))).replace("ς", "σ").strip()


@lru_cache(maxsize=200_000)
def ascii_form(text: str) -> str | None:
    """The match form in ASCII letters; what has no Latin spelling goes, and text of nothing else has none."""
    folded = match(text)
    if folded is None:
        return None
    spelled = unicodedata.normalize("NFD", folded.translate(_SPELLED))
    out = _SPACE.sub(" ", "".join(c for c in spelled if c.isascii())).strip(" ") if not spelled.isascii() else spelled
    return out or None


def _without_group(text: str) -> str:
    """The text without one bracket group at its end, however nested; a text that is nothing else stays."""
    pairs = {")": "(", "]": "["}
    if text[-1:] not in pairs:
        return text
    closing, depth = text[-1], 0
    for i in range(len(text) - 1, -1, -1):
        depth += (text[i] == closing) - (text[i] == pairs[closing])
        if not depth:
            return text[:i].rstrip() or text
    return text


@lru_cache(maxsize=200_000)
def base(text: str) -> str | None:
    """Identity form: the match form with look-alike letters read as Latin in a text that has Latin ones, one trailing bracket group off, one
    leading article or trailing ``, article`` off."""
    kept = unicodedata.normalize("NFKC", storage(text).replace("\0", ""))
    if not kept.isascii() and _LATIN.search(kept):
        kept = unicodedata.normalize("NFKC", _FORMAT.sub("", kept).replace("‍", "")).translate(_ALIKE)
    folded = match(kept)
    if folded is None:
        return None
    bare = _without_group(_SPACE.sub(" ", folded.translate(_BASE).replace("’", "'")).strip())
    led = _LEADING.sub("", bare)
    return (led if led != bare else _TRAILING.sub("", bare)).strip()


def punctuation(text: str) -> str | None:
    """The identity form with all but letters and digits as single spaces."""
    b = base(text)
    return None if b is None else _OTHER.sub(" ", b).strip()


def disambiguated(text: str) -> str | None:
    """The identity form without a trailing ``/N`` and the bracket group before it."""
    b = base(text)
    bare = b and _NUMBER.sub("", b)
    return bare if bare == b else _without_group(bare)


def _column(kernel):
    @F.pandas_udf(T.StringType())
    def over(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else kernel(t) for t in texts], dtype=object)

    return over


#: Column functions of a text column; null stays null.
storage_form, match_form, ascii_match_form, identity_form, identity_punctuation_form, identity_disambiguated_form = (_column(k) for k in (storage, match, ascii_form, base, punctuation, disambiguated))
