"""Parsing and comparing names of organisations."""
from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

from .addresses import canonical
from .lexicon import BOTH, DIGIT_AS_LETTER, FULL_NAMES, GIVEN_OF, LEGAL, _DOTTED, business_of, given_of, plain, present, within

_CAMEL = re.compile(r"(?<=[a-zà-ÿ]{2})(?=[A-ZÀ-Þ][a-zà-ÿ]{2})")
_APOS = re.compile(r"(?<=[a-z])['’](?=[a-z])")
_P_LTD = re.compile(r" p\.? (?=l(?:i?mi)?t(?:e?d)?\b)")
_PAREN = re.compile(r"\((?:india|us|u\.s\.|usa|france|fr|main|hq)\)")


class Name(NamedTuple):
    given: str  # canonical given name; one letter for an initial; '' when there is none
    core: tuple[str, ...]  # telling words, sorted
    business: tuple[str, ...]  # lines of business, sorted
    joined: str  # telling words in order of writing, without spaces


_KEPT = bytes(c if c < 128 and chr(c).isalnum() else 32 for c in range(256))


def tokens_of(raw: str) -> list[str]:
    if not (raw.islower() or raw.isupper() or raw.istitle()):  # none of these has a capital behind a small letter
        raw = _CAMEL.sub(" ", raw)
    s = plain(raw)
    if "(" in s:
        s = _PAREN.sub(" ", s).replace("(p)", " ")
    if " p" in s:
        s = _P_LTD.sub(" ", s)
    if "." in s:
        s = _DOTTED.sub(lambda m: " " + m[0].replace(".", "") + " ", s)
    if "/" in s:
        s = s.replace("m/s", " ")
    if "'" in s or "’" in s:
        s = _APOS.sub("", s)
    return s.encode().translate(_KEPT).decode().split()


def parse_name(raw: str | None) -> Name | None:
    """None for a missing name and for one without a letter or digit. Legal forms, articles and country remarks are left out."""
    if not present(raw):
        return None
    return _parse(raw)


WORD, LETTER, NUMBER, FORM = range(4)
_kinds: dict[str, tuple] = {}


def _kind(tok: str) -> tuple:
    """(word, what it is, line of business, given name, given name if spelled exactly) of a token."""
    t = tok
    if not t.isalpha():
        if t.isdigit():
            out = (t, NUMBER, "", "", "")
        else:
            t = t.translate(DIGIT_AS_LETTER)
            out = (t, WORD, business_of(t), given_of(t), GIVEN_OF.get(t, "")) if len(t) > 1 else (t, LETTER, "", "", "")
    elif t in LEGAL:
        out = (t, FORM, "", "", "")
    elif len(t) == 1:
        out = (t, LETTER, "", "", "")
    else:
        out = (t, WORD, business_of(t), given_of(t), GIVEN_OF.get(t, ""))
    if len(_kinds) > 400_000:
        _kinds.clear()
    _kinds[tok] = out
    return out


@lru_cache(maxsize=50_000)
def _parse(raw: str) -> Name | None:
    toks = tokens_of(raw)
    given, core, biz = "", [], []
    for t in toks:
        kind = _kinds.get(t)
        if kind is None:
            kind = _kind(t)
        t, what, b, g, exact = kind
        if what == WORD:
            if g and (not core or not given):
                g = g if not core else exact
            else:
                g = "" if core else g
            if b and not (g and not given):
                biz.append(b)
            elif g and g in BOTH and len(given) > 1:
                biz.append(BOTH[g])
            elif g:
                # beside another given name, a short form that abbreviates a line of business too is that
                if given in BOTH:
                    biz.append(BOTH[given])
                    given = ""
                given = given if len(given) > 1 else g
            else:
                core.append(t)
        elif what == LETTER:
            if not given:
                given = t
        elif what == NUMBER:
            core.append(t)
    if not core and not biz and not given:
        core = [t for t in toks if len(t) > 1] or toks
        if not core:
            return None
    joined = "".join(core)
    return Name(given, tuple(sorted(core)), tuple(sorted(set(biz))), joined)


def jaro_winkler(a: str, b: str) -> float:
    if a == b:
        return 1.0
    la, lb = len(a), len(b)
    if not la or not lb:
        return 0.0
    reach = max(la, lb) // 2 - 1
    used = [False] * lb
    hits = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(lb, i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                hits.append(c)
                break
    m = len(hits)
    if not m:
        return 0.0
    others = [b[j] for j in range(lb) if used[j]]
    t = sum(x != y for x, y in zip(hits, others)) / 2
    s = (m / la + m / lb + (m - t) / m) / 3
    p = 0
    while p < min(4, la, lb) and a[p] == b[p]:
        p += 1
    return s + p * 0.1 * (1 - s)


#: Jaro-Winkler similarity from which two words may be writings of one.
WORD = 0.8


def word_like(a: str, b: str, common: dict[str, float] = {}) -> float:  # noqa: B006
    """How surely b is a writing of a: their Jaro-Winkler similarity, 0 below WORD. Words of very different letters (more than one to
    three edits, by length) are none, and an abbreviation of the tables stands for its word.

    common: how common words are in the corpus, 0 to 1. Two different words that are both common are two words rather than one and its
    typo, so the similarity is scaled by 1 - the product of the two weights."""
    if a == b:
        return 1.0
    n = min(len(a), len(b))
    if canonical(a) == canonical(b):
        return 0.95
    if n < 3 or not within(a, b, 1 if n < 6 else 2 if n < 12 else 3):
        return 0.0
    j = jaro_winkler(a, b) * (1.0 - common.get(a, 0.0) * common.get(b, 0.0))
    return j if j >= WORD else 0.0


def given_like(a: str, b: str) -> float:
    """1 for one given name, less for an initial, for short forms that may stand for one name, and for a typo; 0 for two names."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    if len(a) == 1 or len(b) == 1:
        return 0.9 if a[0] == b[0] else 0.0
    if FULL_NAMES.get(a, frozenset((a,))) & FULL_NAMES.get(b, frozenset((b,))):
        return 0.9
    return 0.95 if within(a, b, 1) and min(len(a), len(b)) > 4 else 0.0


def readings(n: Name) -> list[Name]:
    """The name as parsed, and with its given name read as the line of business that it abbreviates too (`lexicon.BOTH`)."""
    if n.given not in BOTH:
        return [n]
    return [n, n._replace(given="", business=tuple(sorted({*n.business, BOTH[n.given]})))]


def compatible(a: Name, b: Name) -> bool:
    """Whether given names and lines of business, as far as both names have them, don't exclude one another."""

    def lines(x: Name, y: Name) -> bool:
        p, q = set(x.business), set(y.business)
        return not p or not q or p <= q or q <= p

    return any(given_like(x.given, y.given) > 0 and lines(x, y) for x in readings(a) for y in readings(b))


def name_like(a: Name, b: Name, common: dict[str, float] = {}) -> float:  # noqa: B006
    """0 to 1; at 0.85 and more two names are taken for one organisation."""
    if a.given in BOTH or b.given in BOTH:
        return max(_name_like(x, y, common) for x in readings(a) for y in readings(b))
    return _name_like(a, b, common)


def _name_like(a: Name, b: Name, common: dict[str, float]) -> float:
    if a.business != b.business:
        sa, sb = set(a.business), set(b.business)
        if sa and sb and not (sa <= sb or sb <= sa):
            return 0.0
        weight = 0.9 if (sa and sb) else 0.86
    else:
        weight = 1.0
    g = given_like(a.given, b.given)
    if g == 0.0:
        return 0.0
    if a.core == b.core:
        if not a.core and len(a.given) < 2 and not a.business:
            return 0.0
        return weight * g
    if len(a.core) == len(b.core):
        left, total, bad = list(b.core), 0.0, 0
        for w in a.core:
            best, at = max(((word_like(w, x, common), i) for i, x in enumerate(left)), default=(0.0, -1))
            if best < WORD:
                bad = 1
                break
            total += best
            left.pop(at)
        if not bad:
            return weight * g * total / len(a.core)
    if len(a.joined) >= 5 and len(b.joined) >= 5 and len(a.core) != len(b.core):
        return weight * g * word_like(a.joined, b.joined, common)
    return 0.0
