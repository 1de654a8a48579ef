"""Rewritings of typed names: encoding, articles, order, connectors, nicknames, initials, abbreviations and typing slips."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass
from itertools import combinations, product

from crateflow.functions.identity import BASE_LETTERS
from crateflow.llm.canonical_text import transducer

# Given names and their short forms.
NICKNAMES = {
    "abigail": "abby gail", "albert": "al bert bertie", "alexander": "alex sandy sasha xander", "alexandra": "alex sandra sasha", "alfred": "alf fred", "andrew": "andy drew", "andrzej": "jedrek",
    "anthony": "tony", "antonio": "tony toni tonio", "arthur": "art", "barbara": "barb babs", "benjamin": "ben benny", "bernard": "bernie", "catherine": "cathy kate katie kit", "charles": "charlie chuck chas",
    "christina": "chris tina", "christopher": "chris kit topher", "daniel": "dan danny", "david": "dave davy", "deborah": "deb debbie", "dmitri": "dima mitya", "dorothy": "dot dolly", "edward": "ed eddie ned ted teddy",
    "ekaterina": "katya", "eleanor": "ellie nell nora", "elizabeth": "liz lizzie beth betty eliza bess", "eugene": "gene", "francis": "frank", "francisco": "paco pancho", "frederick": "fred freddy fritz", "gerald": "gerry jerry", "giuseppe": "beppe pino",
    "guadalupe": "lupe", "gregory": "greg", "harold": "hal harry", "helen": "nell", "henry": "hank harry hal", "isabella": "bella izzy", "jacob": "jake", "james": "jim jimmy jamie", "jeffrey": "jeff", "johannes": "hannes hans", "john": "jack johnny",
    "jonathan": "jon jonny", "jose": "pepe", "joseph": "joe joey", "josephine": "jo josie", "joshua": "josh", "katherine": "kate kathy katie kit kitty", "kenneth": "ken", "lawrence": "larry", "leonard": "len lenny leo", "ludmila": "lyuda mila",
    "manuel": "manolo", "margaret": "maggie meg peggy greta marge", "maria": "masha", "martin": "marty", "matthew": "matt", "michael": "mike mick mickey", "mikhail": "misha", "nathaniel": "nat nate nathan", "nicholas": "nick nico", "nikolai": "kolya", "oksana": "ksenia",
    "pamela": "pam", "patricia": "pat patty tricia trish", "patrick": "pat paddy", "pavel": "pasha", "peter": "pete", "philip": "phil pip", "raymond": "ray", "rebecca": "becky", "richard": "dick rick ricky rich richie", "robert": "bob bobby rob robbie bert",
    "ronald": "ron ronnie", "samuel": "sam sammy", "sebastian": "seb bastian", "sofia": "sonya", "stephen": "steve", "steven": "steve", "susan": "sue susie", "susannah": "sue susie sukie", "theodore": "ted teddy theo", "thomas": "tom tommy", "tomas": "tom tommy",
    "timothy": "tim", "victoria": "vicky tori", "vincent": "vince vinny", "vladimir": "vova volodya vlad", "walter": "walt wally", "wilhelmina": "mina willa minnie", "william": "bill billy will willie liam", "zachary": "zach zack",
}
# Words that carry no identity at the end of an organisation's name.
LEGAL_FORMS = frozenset("inc incorporated ltd limited llc corp corporation gmbh plc".split())
# Leading words that a list may move behind the name or drop.
ARTICLES = frozenset("the les los las die der das".split())
# Names of what is no artist.
NO_ARTIST = frozenset(("various", "various artists", "v a", "va", "v/a", "unknown", "unknown artist", "no artist", ""))

_SHORT: dict[str, list[str]] = {}
for _full, _shorts in NICKNAMES.items():
    for _s in _shorts.split():
        _SHORT.setdefault(_s, []).append(_full)

_BASE = str.maketrans(BASE_LETTERS)
# Written-short words of ensembles and companies.
SHORT_WORDS = {
    "bros": "brothers", "intl": "international", "orch": "orchestra", "ens": "ensemble", "ch": "chamber", "str": "string", "qt": "quartet", "qrt": "quartet", "quart": "quartet",
    "symph": "symphony", "sym": "symphony", "phil": "philharmonic", "philh": "philharmonic", "so": "symphony orchestra", "co": "chamber orchestra", "sq": "string quartet", "bb": "brass band", "grp": "group", "sys": "system", "snd": "sound", "bnd": "band",
}

_NUMBER = re.compile(r"\s*\(\d+\)")
_POINTED = re.compile(r"\b([^\W\d_])\.([^\W\d_])\.(?=\s|$)")
_CONNECTOR = re.compile(r"\s*[&+]\s*|\s+/\s+|\s+and\s+", re.I)
_WORD = re.compile(r"[^\W_]+(?:['’][^\W_]+)*\.?")
#: Words that may be written with an edit each; shorter ones must be equal.
TYPO_WORD = 4
#: Longest stretch before the point of an abbreviated given name.
ABBREVIATION = 5


@dataclass(frozen=True)
class Parsed:
    """A name as members of words (one member unless connected), folded to base letters; ``short`` words are initials or end in a point."""

    members: tuple[tuple[str, ...], ...]
    short: tuple[tuple[bool, ...], ...]

    @property
    def key(self) -> str:
        """Text that is equal for spellings that differ in nothing but encoding, case, accents, punctuation, articles and connectors."""
        return " & ".join(" ".join(w + "." * s for w, s in zip(m, f)) for m, f in zip(self.members, self.short))


def parse(name: str) -> Parsed | None:
    """The parsed name, or None for one that names no artist."""
    text = transducer()(name)
    text = _NUMBER.sub("", text)
    folded = "".join(c for c in unicodedata.normalize("NFKD", text.casefold()) if not unicodedata.combining(c)).translate(_BASE)
    if " ".join(_WORD.findall(folded.replace(".", " "))) in NO_ARTIST or folded.strip(" .") in NO_ARTIST:
        return None
    members, short = [], []
    for part in _CONNECTOR.split(re.sub(r"(?<=[^\W_])-(?=[^\W_])", " ", folded)):
        before, comma, after = part.partition(",")
        if comma and after.strip() and "," not in after:  # family name first, or the article behind
            part = f"{after.strip()} {before.strip()}"
        words = _WORD.findall(_POINTED.sub(r"\1\2.", part))
        if len(words) > 1 and words[0] in ARTICLES:
            words = words[1:]
        while len(words) > 1 and words[-1].rstrip(".") in LEGAL_FORMS:
            words.pop()
        bare = [w.rstrip(".").replace("'", "").replace("’", "") for w in words]
        kept = []
        for i, (w, b) in enumerate(zip(words, bare)):
            if i and b in SHORT_WORDS and (w.endswith(".") or "'" in w or "’" in w):
                kept += [(x, False) for x in SHORT_WORDS[b].split()]
            elif b:
                kept.append((b, len(b) == 1 or (w.endswith(".") and len(b) <= ABBREVIATION)))
        if kept:
            members.append(tuple(b for b, _ in kept))
            short.append(tuple(s for _, s in kept))
    return Parsed(tuple(members), tuple(short)) if members else None


def _flat(p: Parsed) -> tuple[list[str], list[bool]]:
    words, short = [], []
    for k, (m, f) in enumerate(zip(p.members, p.short)):
        if k:
            words.append("&")
            short.append(True)
        words += m
        short += f
    return words, short


def slip_forms(key: str, meant: dict[str, list[str]], most: int = 2) -> list[str]:
    """The key's words sorted, as they stand and with up to ``most`` of them replaced by what they may be slips of: two keys that the
    check accepts have a form in common, as each replaces the words in which it is the rarer one."""
    words = key.split(" ")
    open_ = [i for i, w in enumerate(words) if meant.get(w)]
    out = ["t:" + " ".join(sorted(words))]
    for n in range(1, most + 1):
        for places in combinations(open_, n):
            for choice in product(*[meant[words[i]] for i in places]):
                new = list(words)
                for i, w in zip(places, choice):
                    new[i] = w
                out.append("t:" + " ".join(sorted(new)))
    return list(dict.fromkeys(out))


def strong_forms(p: Parsed) -> list[str]:
    """Forms that only spellings of one name share, up to the check of the pair: token order, a middle initial left out, words
    run together or apart. Slips have forms of their own (``slip_forms``)."""
    words, short = _flat(p)
    out = []
    if len(p.members) == 1:
        m, f = p.members[0], p.short[0]
        out.append("o:" + " ".join(sorted(w + "." * s for w, s in zip(m, f))))
        if len(m) >= 3 and not f[0] and not f[-1] and any(f[1:-1]):
            out.append("o:" + " ".join(sorted(w for w, s in zip(m, f) if not s)))
    else:
        out.append("o:" + " & ".join(sorted(" ".join(sorted(m)) for m in p.members)))
    out.append("j:" + "".join(w + "." * s for w, s in zip(words, short)))
    return list(dict.fromkeys(out))


def _person_forms(m: tuple[str, ...], f: tuple[bool, ...]) -> tuple[list[str], list[str]]:
    """(forms of a full person's name, forms under which an abbreviated one looks for it)."""
    core = [(w, s) for i, (w, s) in enumerate(zip(m, f)) if not (s and 0 < i < len(m) - 1)]
    if len(core) > 2:  # a group named after a person: only its first word may be short
        rest = " ".join(w for w, _ in core[1:])
        if any(s for _, s in core[1:]):
            return [], []
        if core[0][1]:
            return [], [f"{core[0][0]}|{rest}"]
        return [f"{core[0][0][:n]}|{rest}" for n in range(1, min(len(core[0][0]) - 1, ABBREVIATION) + 1)], [f"{x}|{rest}" for x in _SHORT.get(core[0][0], ())]
    if len(core) != 2:
        return [], []
    (a, sa), (b, sb) = core
    if sa and sb:
        return [], []
    if sa or sb:  # an initial or an abbreviation before or behind the family name
        given, family = (a, b) if sa else (b, a)
        return [], [f"{given}|{family}"]
    full = [f"{a[:n]}|{b}" for n in range(1, min(len(a) - 1, ABBREVIATION) + 1)] + [f"{a}|{b}"]
    nick = [f"{x}|{b}" for x in _SHORT.get(a, ())] + [f"{x}|{a}" for x in _SHORT.get(b, ())]
    return full, nick


def weak_forms(p: Parsed) -> tuple[list[str], list[str]]:
    """(offered, sought): a name whose sought form is offered by names of one artist alone is an abbreviation of that artist's."""
    if len(p.members) == 1:
        return _person_forms(p.members[0], p.short[0])
    if len(p.members) != 2:
        return [], []
    sides = [_person_forms(m, f) for m, f in zip(p.members, p.short)]
    pair = lambda x, y: "&".join(sorted((x, y)))
    offered, sought = [], []
    if all(len(m) == 2 and not any(f) for m, f in zip(p.members, p.short)):
        (a, b), (c, d) = p.members
        offered = [pair(b, d), pair(f"{a[0]}|{b}", f"{c[0]}|{d}")]
    elif all(len(m) == 1 for m in p.members):
        sought = [pair(p.members[0][0], p.members[1][0])]
    elif all(s[1] for s in sides):
        sought = [pair(sides[0][1][0], sides[1][1][0])]
    return offered, sought


def one_edit(a: str, b: str) -> bool:
    """Equal, or one letter put in, left out, replaced, or swapped with its neighbour."""
    if a == b:
        return True
    if abs(len(a) - len(b)) > 1:
        return False
    n = min(len(a), len(b))
    i = next((k for k in range(n) if a[k] != b[k]), n)
    x, y = a[i:], b[i:]
    return x[1:] == y[1:] or x[1:] == y or x == y[1:] or (len(x) > 1 and len(y) > 1 and x[0] == y[1] and x[1] == y[0] and x[2:] == y[2:])


def differing_words(a: str, b: str) -> list[tuple[str, str]] | None:
    """The word pairs in which two keys differ by an edit each, at most two; None if they differ otherwise. Words may be reordered."""
    wa, wb = a.split(" "), b.split(" ")
    if "".join(wa) == "".join(wb):
        return []
    if len(wa) != len(wb):
        return None
    rest_a, rest_b = list(wa), list(wb)
    for w in wa:
        if w in rest_b:
            rest_a.remove(w)
            rest_b.remove(w)
    if len(rest_a) > 2:
        return None
    orders = [rest_b] if len(rest_b) < 2 else [rest_b, rest_b[::-1]]
    for order in orders:
        if all(max(len(x), len(y)) >= TYPO_WORD and min(len(x), len(y)) >= TYPO_WORD - 1 and not x.endswith(".") and not y.endswith(".") and one_edit(x, y) for x, y in zip(rest_a, order)):
            return list(zip(rest_a, order))
    return None
