"""Text damaged by misread encodings, and the clean text that explains it."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "�"
_RUNS = re.compile(f"({MARK}+)")
#: The one-byte table of the database's latin1: cp1252, with its five gaps as control characters.
_WIDE = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(256))


def misread(clean: str) -> list[str]:
    """The text itself and its UTF-8 bytes read through either one-byte table, without repeats."""
    raw = clean.encode("utf-8")
    return list(dict.fromkeys([clean, "".join(_WIDE[b] for b in raw), raw.decode("latin1")]))


def fits(damaged: str, form: str) -> bool:
    """Whether the form becomes the damaged text when each run of marks stands for characters of as many bytes."""
    at = 0
    for piece in _RUNS.split(damaged):
        if not piece:
            continue
        if piece[0] != MARK:
            if not form.startswith(piece, at):
                return False
            at += len(piece)
            continue
        need = len(piece)
        while need > 0 and at < len(form):
            need -= len(form[at].encode("utf-8"))
            at += 1
        if need:
            return False
    return at == len(form)


def explains(damaged: str | None, clean: str | None) -> bool:
    """Whether the clean text accounts for the damaged one. An undamaged text must equal a misreading of the clean one; a
    damaged one may also have one mark for each lost character. A clean side with marks explains nothing."""
    if damaged is None or clean is None:
        return damaged is None and clean is None
    if MARK not in damaged:
        return damaged in misread(clean)
    if MARK in clean:
        return False
    if len(damaged) == len(clean) and all(d in (MARK, c) for d, c in zip(damaged, clean)):
        return True
    return any(fits(damaged, m) for m in misread(clean))


@F.pandas_udf(T.BooleanType())
def explained_by(damaged: pd.Series, clean: pd.Series) -> pd.Series:
    return pd.Series([explains(d, c) for d, c in zip(damaged, clean)], dtype=bool)


@F.pandas_udf(T.ArrayType(T.StringType()))
def readings(texts: pd.Series) -> pd.Series:
    """The text and its misreadings, without repeats; null for null."""
    return pd.Series([None if t is None else misread(t) for t in texts], dtype=object)
