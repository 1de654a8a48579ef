"""Text statistics per document, and how much of it is natural prose."""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Frequent function words by language, first articles, then prepositions, then the words that only
# clauses need (pronouns, auxiliaries, conjunctions, negations, adverbs).
FUNCTION_WORDS = {
    "en": (
        "the a an",
        "of in to for with on at by from into over between after before about through under without against during near since until per",
        "and or but if than then that which who whom whose what when where while because so though although as it its he she they we you i him her them us me my your his their our this these those "
        "there here is are was were be been being am has have had having do does did not no nor none never only just even too very also yet still more most much many some any all every each other another "
        "would could should will shall can may might must let how why out up down off again ever one both either rather whether",
    ),
    "de": (
        "der die das den dem des ein eine einen einem einer eines",
        "von in im zu zum zur für mit auf an am bei nach aus über unter vor durch gegen ohne um bis seit vom ins",
        "und oder aber denn wenn als dass weil ob wie wo was wer er sie es wir ihr ich du man sich mich mir ihm ihn uns euch sein seine seinen ihre ihren mein dein unser dieser diese dieses dies jede jeder "
        "ist sind war waren wird werden wurde wurden hat haben hatte hatten kann können muss soll will nicht kein keine nie nur noch schon auch sehr mehr viel immer wieder hier da dort so dann nun doch also alles davon dafür dabei etwas wer bleibt",
    ),
    "fr": (
        "le la les l un une des du de d",
        "à au aux en dans sur pour par avec sans sous chez entre vers depuis pendant contre après avant jusque près",
        "et ou mais donc car ni si que qu qui quoi dont où quand comme il elle ils elles on nous vous je j tu se s me m te t lui leur y ce c cet cette ces cela ça son sa ses mon ma mes ton ta tes notre votre leurs "
        "est sont était étaient être été a ont avait avaient avoir fait n ne pas plus jamais rien aucun aucune très trop bien aussi encore toujours déjà là ici tout tous toute toutes même peu sans doute autres autre faut",
    ),
    "es": (
        "el la los las un una unos unas lo",
        "de del en a al con por para sin sobre entre desde hasta hacia contra según durante tras bajo",
        "y e o u pero sino si que quien cual cuando donde como porque aunque él ella ellos ellas yo tú nosotros usted se me te le les nos su sus mi mis tu este esta estos estas ese esa eso esto aquel aquella "
        "es son era eran fue fueron ser sido está están estaba ha han había hay hace hacer no ni nunca nada nadie muy más menos mucho también tampoco ya aún todavía siempre sólo solo aquí allí todo todos toda todas otro otra otros varias antes cada",
    ),
    "it": (
        "il lo la i gli le un uno una l",
        "di del della dei delle in nel nella a al alla da dal dalla con su per tra fra senza sotto verso",
        "e ed o ma se che chi cui quando dove come perché lui lei loro io noi voi si mi ti ci vi ne suo sua suoi mio questo questa quello quella è sono era erano essere stato ha hanno aveva non né mai nulla molto più anche ancora sempre già qui tutto tutti ogni altro",
    ),
    "pt": (
        "o a os as um uma uns umas",
        "de do da dos das em no na nos nas por pelo pela para com sem sobre entre até desde",
        "e ou mas se que quem quando onde como porque ele ela eles elas eu nós você se me te lhe seu sua seus meu este esta esse essa isso é são era eram foi foram ser está ha tem tinha não nem nunca nada muito mais também já ainda sempre só aqui tudo todos cada outro",
    ),
    "nl": (
        "de het een",
        "van in op te voor met aan bij naar uit over onder door tegen zonder om tot sinds tussen",
        "en of maar want als dat die wie wat waar toen omdat hij zij ze het wij we jij je ik u zich mij hem haar ons zijn hun mijn deze dit is was waren wordt werd heeft hebben had kan kon moet zal zou niet geen nooit nog al ook zeer meer veel altijd weer hier daar dan nu toch",
    ),
    "sv": (
        "en ett den det de",
        "av i på till för med från om vid under över mellan efter utan mot genom",
        "och eller men om att som när där var han hon de vi du jag man sig mig honom sin sitt sina min din denna detta är var blir blev har hade kan kunde ska skulle inte ingen aldrig bara också mycket mer alla här så då nu",
    ),
}

#: What a segment is made of. Content words count apart by case only where the text has both cases.
EVENTS = ("article", "preposition", "clause", "plain", "title", "number", "odd", "comma", "stop", "rule", "symbol")

# Shares of the events in running prose of each language, and in lists, tables and junk. They follow from common
# word and punctuation counts of the languages, not from the data at hand; only their order of magnitude matters.
PROFILES = {
    "en": (0.09, 0.11, 0.22, 0.36, 0.08, 0.01, 0.002, 0.045, 0.055, 0.008, 0.02),
    "de": (0.11, 0.10, 0.22, 0.27, 0.16, 0.01, 0.002, 0.05, 0.055, 0.005, 0.018),
    "fr": (0.14, 0.10, 0.22, 0.33, 0.07, 0.01, 0.002, 0.045, 0.055, 0.005, 0.023),
    "es": (0.10, 0.13, 0.20, 0.36, 0.07, 0.01, 0.002, 0.05, 0.055, 0.005, 0.018),
    "it": (0.10, 0.12, 0.19, 0.38, 0.07, 0.01, 0.002, 0.05, 0.055, 0.005, 0.018),
    "pt": (0.10, 0.13, 0.19, 0.37, 0.07, 0.01, 0.002, 0.05, 0.055, 0.005, 0.018),
    "nl": (0.11, 0.12, 0.22, 0.34, 0.07, 0.01, 0.002, 0.045, 0.055, 0.008, 0.02),
    "sv": (0.07, 0.12, 0.23, 0.38, 0.06, 0.01, 0.002, 0.045, 0.055, 0.005, 0.023),
    "narrative": (0.11, 0.14, 0.09, 0.47, 0.08, 0.02, 0.002, 0.03, 0.035, 0.005, 0.018),
    "neutral": (0.0, 0.0, 0.0, 0.77, 0.09, 0.01, 0.002, 0.055, 0.06, 0.005, 0.01),
    "clauses": (0.0, 0.0, 0.0, 0.69, 0.08, 0.005, 0.002, 0.15, 0.065, 0.003, 0.005),
    "list": (0.03, 0.04, 0.015, 0.06, 0.47, 0.07, 0.015, 0.06, 0.03, 0.14, 0.07),
    "list_plain": (0.03, 0.04, 0.015, 0.50, 0.05, 0.07, 0.015, 0.06, 0.02, 0.135, 0.07),
    "names": (0.02, 0.01, 0.02, 0.02, 0.70, 0.01, 0.01, 0.19, 0.01, 0.005, 0.005),
    "table": (0.015, 0.02, 0.01, 0.06, 0.34, 0.10, 0.015, 0.07, 0.01, 0.24, 0.12),
    "terms": (0.0, 0.0, 0.0, 0.60, 0.06, 0.01, 0.005, 0.30, 0.01, 0.005, 0.01),
    "tags": (0.01, 0.01, 0.01, 0.42, 0.04, 0.02, 0.06, 0.01, 0.01, 0.02, 0.39),
    "junk": (0.005, 0.005, 0.01, 0.10, 0.03, 0.12, 0.52, 0.03, 0.03, 0.055, 0.10),
    "noise": (0.02, 0.005, 0.01, 0.35, 0.05, 0.05, 0.17, 0.08, 0.06, 0.06, 0.145),
    "word_salad": (0.01, 0.01, 0.01, 0.93, 0.01, 0.005, 0.015, 0.002, 0.003, 0.002, 0.003),
}
LANGUAGES = tuple(FUNCTION_WORDS)
STRUCTURES = tuple(p for p in PROFILES if p not in FUNCTION_WORDS and p not in ("narrative", "neutral", "clauses"))
#: A text with at most this share of listed function words may be prose of a language without a list ("neutral", or "clauses" where commas part them), judged by its character classes.
UNLISTED = 0.25
#: Words in a row, or in a line on average, from which text with few clause words may be narrative rather than titles.
NARRATIVE_WORDS = 8

_MARKUP = re.compile(r"<[/!]?[a-zA-Z][^<>]{0,300}>")
_TOKEN = re.compile(r"[^\W_]+(?:['’.\-/+=@_:][^\W_]+)*|[^\w\s]+|_+|\t")
_NUMBER = re.compile(r"\d+(?:[.:,/\-]\d+)*")
_LETTERS = re.compile(r"[^\W\d_]+")
_VOWELS = frozenset("aeiouyαεηιουωаеёиоуыэюяіїєæœøı")
_RULES = frozenset("|;\t:–—-=+_•*·#>/\\~")
_STOPS = frozenset(".!?…。！？．।॥؟۔։።")
_COMMAS = frozenset(",،、，;；·")
_MARKS = regex.compile(r"\p{M}+")
# Scripts written without spaces, two letters of which count as a word.
_UNSPACED = regex.compile(r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]")
_ENDS = (".", "!", "?", "…", "。", "！", "？", "।", "॥", "؟", "۔", "」", "։", '."', '!"', '?"', ".”", "!”", "?”", ".)", ".'", ".»")

_ROLE: dict[str, dict[str, int]] = {lang: {w: role for role in (2, 1, 0) for w in groups[role].split()} for lang, groups in FUNCTION_WORDS.items()}
_KNOWN = frozenset(w for roles in _ROLE.values() for w in roles)


def _odd(part: str) -> bool:
    """A run of letters that isn't shaped like a word."""
    if len(part) > 24 and part.lower() != part.upper():
        return True
    if not "a" <= unicodedata.normalize("NFD", part[0])[0].lower() <= "z":
        return False
    inner = part[1:]
    if inner != inner.lower() and part != part.upper() and not part.startswith(("Mc", "Mac", "De", "Di", "Le", "La", "O")):
        return True
    return len(part) > 2 and part.upper() != part and not any(c in _VOWELS for c in unicodedata.normalize("NFD", part.lower()))


class Vocabulary(dict):
    """Token -> row of ``table``: what it adds to each language's events and to the counts."""

    WIDTH = len(LANGUAGES) * len(EVENTS) + len(LANGUAGES) + 6
    HITS = len(LANGUAGES) * len(EVENTS)
    WORDS, LENGTH, KNOWN, UPPER, TITLE, PLAIN = range(HITS + len(LANGUAGES), WIDTH)

    def __init__(self):
        super().__init__()
        self.kinds: dict[tuple, int] = {}
        self.rows: list[np.ndarray] = []

    def __missing__(self, token: str) -> int:
        row = self._row(token)
        kind = self.kinds.setdefault(tuple(row), len(self.rows))
        if kind == len(self.rows):
            self.rows.append(row)
        if len(self) < 1_000_000:  # a bound on memory only; tokens beyond it are worked out anew
            self[token] = kind
        return kind

    def _row(self, token: str) -> np.ndarray:
        out = np.zeros(self.WIDTH, dtype=np.float32)
        per = out[: self.HITS].reshape(len(LANGUAGES), len(EVENTS))
        if not token[0].isalnum():
            shape = [c for c in token if c in _RULES]
            per[:, EVENTS.index("rule")] = min(2, len(shape)) if "\t" not in token else 1
            per[:, EVENTS.index("comma")] = min(1, sum(c in _COMMAS for c in token))
            per[:, EVENTS.index("stop")] = min(1, sum(c in _STOPS for c in token))
            per[:, EVENTS.index("symbol")] = min(3, sum(c not in _RULES and c not in _STOPS and c not in _COMMAS for c in token))
            return out
        if _NUMBER.fullmatch(token):
            per[:, EVENTS.index("number")] = 1
            return out
        parts = _LETTERS.findall(token)
        low = token.lower()
        pieces = [low] if low in _KNOWN else [x for x in re.split("['’]", low) if x]
        if any(c.isdigit() or c in "+=@_/" for c in token) or any(map(_odd, parts)) and low not in _KNOWN:
            per[:, EVENTS.index("odd")] = 1
            return out
        upper = token.upper() == token and token.lower() != token and len(token) > 1
        title = not upper and token[0].isupper()
        weight = max(1, round(sum(map(len, parts)) / 2)) if _UNSPACED.match(parts[0]) else 1
        shape = EVENTS.index("title" if upper or title else "plain")
        for i, lang in enumerate(LANGUAGES):
            roles = [_ROLE[lang][x] for x in pieces if x in _ROLE[lang]]
            for r in roles:
                per[i, r] += 1
            out[self.HITS + i] = len(roles)
            if len(roles) < len(pieces):
                per[i, shape] += weight
        out[self.WORDS], out[self.LENGTH] = weight, sum(map(len, parts))
        known = any(x in _KNOWN for x in pieces)
        out[self.KNOWN], out[self.UPPER] = known, upper
        out[self.TITLE], out[self.PLAIN] = title and not known, weight * (not (title or upper or known))
        return out


def _negentropy(p: np.ndarray) -> np.ndarray:
    return (p * np.log2(np.maximum(p, 1e-300))).sum(axis=-1)


def jensen_shannon(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence in bits of each row of p from each row of q; a row of zeros lies at 1."""
    # The divergence is the entropy of the middle less the mean of the entropies, which takes one logarithm a cell.
    out = _negentropy(p)[:, None] / 2 + _negentropy(q)[None, :] / 2 - _negentropy((p[:, None, :] + q[None, :, :]) / 2)
    out[p.sum(axis=1) == 0] = 1
    return out


def _table(flat: bool) -> np.ndarray:
    t = np.array(list(PROFILES.values()))
    if flat:
        t[:, 3] += t[:, 4]
        t[:, 4] = 0
    return t / t.sum(axis=1, keepdims=True)


_NAMES = tuple(PROFILES)
_PROSE = np.array([n not in STRUCTURES for n in _NAMES])


def _judge(counts: np.ndarray, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(nearest profile, divergence from prose, divergence from the nearest structure) of each row of token counts."""
    n, width = len(counts), len(EVENTS)
    hits = counts[:, Vocabulary.HITS : Vocabulary.HITS + len(LANGUAGES)]
    lang = hits.argmax(axis=1)
    events = counts[:, : Vocabulary.HITS].reshape(n, len(LANGUAGES), width)[np.arange(n), lang].astype(float)
    words, known = counts[:, Vocabulary.WORDS], counts[:, Vocabulary.KNOWN]
    # Where the case says nothing, content words count together.
    flat = (counts[:, Vocabulary.UPPER] > 0.6 * words) | (counts[:, Vocabulary.TITLE] <= 0.02 * words)
    events[flat, 3] += events[flat, 4]
    events[flat, 4] = 0
    p = events / np.maximum(events.sum(axis=1, keepdims=True), 1)
    far = np.empty((n, len(_NAMES)))
    for is_flat in (False, True):
        rows = flat == is_flat
        if rows.any():
            far[rows] = jensen_shannon(p[rows], _table(is_flat))
    allowed = np.zeros((n, len(_NAMES)), dtype=bool)
    allowed[np.arange(n), lang] = True
    allowed[:, _NAMES.index("narrative")] = words >= NARRATIVE_WORDS * lines
    prose = np.where(allowed, far, 9).min(axis=1)
    other = np.where(_PROSE, 9, far)
    nearest = np.where(prose <= other.min(axis=1), np.where(known > 0, lang, _NAMES.index("narrative")), other.argmin(axis=1))
    # Languages without a list: sentences, by the character classes alone.
    plain = events.copy()
    plain[:, 3] += plain[:, :3].sum(axis=1)
    plain[:, :3] = 0
    sentences = (known <= UNLISTED * words) & (words >= NARRATIVE_WORDS) & (plain[:, EVENTS.index("stop")] > 0) & (_PROSE[nearest] == False)  # noqa: E712
    if sentences.any():
        p = plain[sentences] / np.maximum(plain[sentences].sum(axis=1, keepdims=True), 1)
        near = np.where(flat[sentences][:, None], jensen_shannon(p, _table(True)), jensen_shannon(p, _table(False)))
        both = near[:, [_NAMES.index("neutral"), _NAMES.index("clauses")]]
        own = both.min(axis=1)
        is_prose = own < np.where(_PROSE, 9, near).min(axis=1)
        at = np.flatnonzero(sentences)[is_prose]
        nearest[at], prose[at] = _NAMES.index("neutral") + both.argmin(axis=1)[is_prose], own[is_prose]
    return nearest, prose, other.min(axis=1)


_STATS = "n_words int, mean_word_length double, symbol_ratio double, digit_share double, ended_line_share double, common_word_share double, profile string, divergence double, prose_share double"
_COLUMNS = [c.split()[0] for c in _STATS.split(", ")]


def analyse(texts: list[str | None], vocabulary: Vocabulary | None = None) -> pd.DataFrame:
    """Statistics of each text. Null counts as empty; a text without visible characters has the profile ``empty`` and no prose."""
    vocabulary = Vocabulary() if vocabulary is None else vocabulary
    n = len(texts)
    owner: list[int] = []
    chars: list[int] = []
    ended: list[bool] = []
    joined: list[bool] = []  # to the line before, in one paragraph
    line_of: list[int] = []
    tokens: list[int] = []
    digits = np.zeros(n)
    for i, text in enumerate(texts):
        if not text:
            continue
        if "<" in text or "&" in text:  # markup isn't content; block ends are line ends
            text = html.unescape(_MARKUP.sub("\n", text))
        if not text.isascii():  # accents are part of their letter, vowel signs and joiners of their word
            text = _MARKS.sub("", unicodedata.normalize("NFC", text)).replace("\u200c", "").replace("\u200d", "")
        digits[i] = sum(map(text.count, "0123456789"))
        open_ = False
        for line in text.splitlines():
            visible = len(line) - line.count(" ") - line.count("\t") if not line.isspace() else 0
            if not visible:
                open_ = False
                continue
            found = _TOKEN.findall(line)
            line_of += [len(owner)] * len(found)
            tokens += [vocabulary[t] for t in found]
            owner.append(i)
            chars.append(visible)
            ended.append(line.rstrip().endswith(_ENDS))
            joined.append(open_)
            open_ = True
    out = pd.DataFrame({c: np.zeros(n) for c in _COLUMNS})
    out["profile"], out["divergence"], out["n_words"] = "empty", 1.0, 0
    if not owner:
        return out
    m = len(owner)
    own, size, tie = np.array(owner), np.array(chars, dtype=float), np.array(joined)
    counts = np.zeros((m, Vocabulary.WIDTH), dtype=np.float32)
    if tokens:
        rows = np.stack(vocabulary.rows)
        # Tokens are counted by line and kind, then each kind's row is added once per line it stands in.
        pairs, times = np.unique(np.array(line_of, dtype=np.int64) * len(rows) + np.array(tokens), return_counts=True)
        where = pairs // len(rows)
        starts = np.flatnonzero(np.r_[True, where[1:] != where[:-1]])
        counts[where[starts]] = np.add.reduceat(rows[pairs % len(rows)] * times[:, None].astype(np.float32), starts, axis=0)
    around, lines = counts.copy(), np.ones(m)
    after = np.r_[tie[1:], False]
    around[tie] += counts[np.flatnonzero(tie) - 1]
    around[after] += counts[np.flatnonzero(after) + 1]
    lines += tie.astype(float) + after
    # A line reads as prose by itself or, a short one or one cut from a sentence, together with its neighbours.
    alone, near_prose, near_other = _judge(counts, np.ones(m))
    group, _, _ = _judge(around, lines)
    words = counts[:, Vocabulary.WORDS]
    prose = _PROSE[alone] & (words >= 4) | _PROSE[group] & (near_prose < near_other + 0.12)
    total = np.zeros((n, Vocabulary.WIDTH))
    heads = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])  # lines come by document
    total[own[heads]] = np.add.reduceat(counts, heads, axis=0)
    by = lambda x: np.bincount(own, weights=x, minlength=n)
    n_lines, visible = by(np.ones(m)), by(size)
    n_words = total[:, Vocabulary.WORDS]
    some = np.maximum(n_words, 1)
    out["n_words"] = n_words.astype(int)
    out["mean_word_length"] = total[:, Vocabulary.LENGTH] / some
    out["symbol_ratio"] = (total[:, EVENTS.index("rule")] + total[:, EVENTS.index("symbol")]) / some
    out["digit_share"] = digits / np.maximum(visible, 1)
    out["ended_line_share"] = by(np.array(ended, dtype=float)) / np.maximum(n_lines, 1)
    out["common_word_share"] = total[:, Vocabulary.KNOWN] / some
    profile, divergence, _ = _judge(total, np.maximum(n_lines, 1))
    out["profile"] = np.where(n_lines > 0, np.array(_NAMES, dtype=object)[profile], "empty")
    out["divergence"] = np.where(n_lines > 0, divergence, 1.0)
    out["prose_share"] = by(size * prose) / np.maximum(visible, 1)
    return out


def quality_statistics(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, statistics) per row: one Arrow pass without a shuffle, over whole texts.

    ``profile`` is the nearest of the prose profiles and the structural ones, ``divergence`` the distance from the text's own
    language as prose, ``prose_share`` the share of visible characters in lines that read as prose. Null text counts as empty;
    repeated rows each get a row; other columns are not carried.
    """
    kind = dict(df.dtypes)[key]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vocabulary = Vocabulary()
        for b in batches:
            for i in range(0, len(b), 2000):
                part = b.iloc[i : i + 2000]
                rows = analyse([t if isinstance(t, str) else None for t in part["_text"]], vocabulary)
                rows.insert(0, "_key", part["_key"].to_numpy())
                yield rows

    out = df.select(F.col(key).alias("_key"), F.col(text).alias("_text")).mapInPandas(run, f"_key {kind}, {_STATS}")
    return out.withColumnRenamed("_key", key)


def not_prose(stats: DataFrame, least_share: float = 0.5, least_share_of_prose: float = 0.3) -> DataFrame:
    """The rows whose text is not mostly prose: a small share of prose lines; a smaller one where the whole text is nearest
    to prose, as short wrapped lines each say little."""
    prose = F.col("profile").isin([n for n in PROFILES if n not in STRUCTURES])
    return stats.where(F.col("prose_share") < F.when(prose, least_share_of_prose).otherwise(least_share))
