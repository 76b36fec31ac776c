"""Parsing and comparing postal addresses."""
from __future__ import annotations

import re
from functools import lru_cache
from typing import NamedTuple

from .lexicon import DIGIT_AS_LETTER, FRENCH_TYPES, ORDINALS, PLACE_WORD, STATE_WORDS, STREET_TYPE, plain, present, within

_SPACE_PIN = re.compile(r"(?<![\d/-])(\d{3}) (\d{3})(?!\d| ?[a-z/-]*\d*[-/]\d)")
_LANDMARK = r"(?:near|behind|opp|opposite|beside|next\s+to)\b\.?\s+[a-z]+(?:\s+(?:tank|stand|talkies|temple|station|school|market|mall|park))?"
# parts within or near a building, and words that only announce a number
_LEFT_OUT = re.compile(
    r"\b(?:(?:suite|ste|unit|shop|flat|apt|apartment|room|bp|bat|batiment|escalier|esc)\b\.?\s*(?:no\b\.?|n0|#)?\s*[a-z]?\d*[a-z]?\b"
    r"|\d+\s*(?:st|nd|rd|th|er|e|eme)?\s*(?:fl|floor|etage)\b\.?"
    r"|(?:gr|ground)\b\.?\s*(?:fl|floor)\b"
    r"|(?:fl|floor|etage)\.?\s*\d+\b"
    r"|rear\s+(?:bldg|building)\b|rdc\b|residence\s+\S+(?:\s+(?:des?|du|les?)\s+\S+)?"
    rf"|{_LANDMARK}"
    r"|(?:h\.?\s*no|plot\s*no|door\s*no|d\.?\s*no|no|pin|code|cedex)\b\.?|n°\.?|f-(?=\d{5}))"
    r"|#\d*[a-z]\b|#\s?[a-z]\d+\b|#"
)
_GLUED_HINT = re.compile(r"[a-zà-ÿ0-9][A-Z][A-Za-z]|[a-z]\d")
_GLUED = re.compile(r"(?<=[a-zà-ÿ])(?=[A-Z][A-Za-z])|(?<=[a-z])(?=\d+ [A-Z])|(?<=\d)(?=[A-Z][a-z]{2})")
#: Words one of which stands in every part that is left out, unless it holds '#'.
_LEFT_OUT_WORDS = frozenset(
    "suite ste unit shop flat apt apartment room bp bat batiment escalier esc fl floor etage gr ground rear rdc residence near behind opp opposite beside next "
    "hno no n plotno doorno dno pin code cedex f".split()
) | {o + f for o in ("st", "nd", "rd", "th", "er", "e", "eme") for f in ("fl", "floor", "etage")}
# byte tables: what isn't a letter, and what isn't part of a token, become spaces (bytes beyond ASCII too)
_LETTERS = bytes(c if chr(c).isalpha() and c < 128 else 32 for c in range(256))
_SPACED = bytes(c if c < 128 and (chr(c).isalnum() or chr(c) in ",;-/'") else 32 for c in range(256))
_TOKEN = re.compile(r"\d+(?:[/-]\d+)*[a-z]?(?![a-z0-9])|[a-z0-9]+(?:'[a-z]+)?|[,;]|(?<=\s)[-/]|[-/](?=\s)")
_NUMBER = re.compile(r"\d+(?:[/-]\d+)*[a-z]?$")
_ZIP4 = re.compile(r"\d{5}-\d{4}$")
_ORD = re.compile(r"\d+(?:st|nd|rd|th)$")
SMALL = {"de", "du", "des", "la", "le", "les", "l", "d", "sur", "sous"}
BIS = {"bis", "ter", "quater"}


class Address(NamedTuple):
    house: str  # house number as written, with bis or ter
    street: str  # telling words of the street's name
    kind: str  # kind of street, canonical; '' unknown
    post: str  # postcode; '' when absent
    town: str  # the remaining words, sorted, without regions
    side: str  # direction before a street name


def parse_address(raw: str | None) -> Address | None:
    """None for a missing address. Units, floors, landmarks and regions are left out."""
    if not present(raw):
        return None
    return _parse(raw)


STOP, NUMBER, TOWN, OTHER_WORD = range(4)
#: Of a run of characters without spaces: its tokens, each with what it reads as, what it may be, and its kind of street or ''.
_runs: dict[str, tuple[tuple[str, int, str], ...]] = {}


def _token(t: str) -> tuple[str, int, str]:
    if t.isalpha():
        t = "st" if t == "saint" else t
    elif _ZIP4.match(t):
        t = t[:5]
    elif not t.isdigit() and len(t) > 1:
        if "'" in t:
            head, _, tail = t.partition("'")
            t = tail if len(head) <= 2 else t.replace("'", "")
        if t[0].isdigit():
            if _ORD.match(t):
                t = ORDINALS.get(t, t)
            elif not _NUMBER.match(t):
                t = t.translate(DIGIT_AS_LETTER)
        elif not t.isalpha():
            t = t.translate(DIGIT_AS_LETTER)
    if t in ",;-/":
        what = STOP
    elif t[0] in "0123456789" and _NUMBER.match(t):
        what = NUMBER
    else:
        what = OTHER_WORD if len(t) < 3 or t in SMALL or t in STATE_WORDS or t in BIS or t in ("tamil", "nadu") else TOWN
    return t, what, STREET_TYPE.get(t, "")


def _run(raw: str) -> tuple[tuple[str, int, str], ...]:
    if len(_runs) > 300_000:
        _runs.clear()
    out = _runs[raw] = tuple(map(_token, _TOKEN.findall(" " + raw + " ")))
    return out


def _tokens(s: str) -> tuple[list[str], list[int], list[tuple[int, str]], set[int], bool]:
    """Tokens, what each may be, kinds of street by position, positions before which a separator stands, and whether two numbers of
    three digits follow one another."""
    toks: list[str] = []
    what: list[int] = []
    kinds: list[tuple[int, str]] = []
    stops: set[int] = {0}
    halves, three = False, False
    if "," in s:
        s = s.replace(",", " , ")
    if ";" in s:
        s = s.replace(";", " ; ")
    for raw in s.encode().translate(_SPACED).decode().split():
        if raw.isdigit():
            halves, three = halves or three and len(raw) == 3, len(raw) == 3
            toks.append(raw)
            what.append(NUMBER)
            continue
        three = False
        for t, w, kind in _runs.get(raw) or _run(raw):
            if w == STOP:
                stops.add(len(toks))
                continue
            if kind:
                kinds.append((len(toks), kind))
            toks.append(t)
            what.append(w)
    return toks, what, kinds, stops, halves


@lru_cache(maxsize=20_000)
def _parse(raw: str) -> Address:
    if _GLUED_HINT.search(raw):
        raw = _GLUED.sub(" ; ", raw)
    s = plain(raw)
    if "’" in s:
        s = s.replace("’", "'")
    if "#" in s or not _LEFT_OUT_WORDS.isdisjoint(s.encode().translate(_LETTERS).decode().split()):
        s = _LEFT_OUT.sub(" ; ", s)
    toks, what, kinds, stops, halves = _tokens(s)
    if halves:
        toks, what, kinds, stops, _ = _tokens(_SPACE_PIN.sub(r"\1\2", s))
    n = len(toks)
    best = None
    for i, kind in kinds:
        # number [bis] KIND name: the kind of street stands first
        j = i - 1
        bis = ""
        if j >= 1 and toks[j] in BIS and what[j - 1] == NUMBER:
            bis, j = toks[j], j - 1
        if j >= 0 and what[j] == NUMBER and i + 1 < n and what[i + 1] != NUMBER and kind in FRENCH_TYPES:
            e = i + 1
            while e < n and what[e] != NUMBER and (e == i + 1 or e not in stops):
                e += 1
            best = (j, toks[j] + bis, i + 1, e, kind, i)
            break
        # number name KIND
        j = i - 1
        while j >= 0 and what[j] != NUMBER and i - j <= 4 and (j + 1 == i or (j + 1) not in stops):
            j -= 1
        if j >= 0 and j < i - 1 and what[j] == NUMBER and (best is None or i - j < best[5] - best[0]):
            best = (j, toks[j], j + 1, i, kind, i)
    first = last = 0  # tokens of the street and its number
    if best:
        first, house, a, b, kind, i = best
        words = [t for t in toks[a:b] if t not in SMALL]
        last = max(b, i + 1)
    else:
        kind, words, house = "", [], ""
        # no kind of street: the first number that is not a postcode, and the words behind it
        for j in range(n):
            if what[j] == NUMBER and (len(toks[j]) <= 4 or not toks[j].isdigit()):
                e = j + 1
                while e < n and what[e] != NUMBER and e not in stops:
                    e += 1
                if e > j + 1 or not house:
                    house, words = toks[j], [t for t in toks[j + 1 : e] if t not in SMALL]
                    first, last = j, e
                    if e > j + 1:
                        break
    side = ""
    if len(words) > 1 and words[0] in _SIDES:
        side, words = words[0][0], words[1:]
    post, town = "", []
    for i in (*range(first), *range(last, n)):
        w = what[i]
        if w == TOWN:
            town.append(toks[i])
        elif w == NUMBER and not post and 4 <= len(toks[i]) <= 6 and toks[i].isdigit():
            post = toks[i]
    return Address(house.lstrip("0") or house, " ".join(words), kind, post, " ".join(town), side)


_SIDES = {"n", "s", "e", "w", "north", "south", "east", "west"}


def words_like(a: str, b: str) -> float:
    """0 to 1 for two runs of words, of any length: 1 less the cost of their affine-gap alignment for each word of the longer one."""
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    xs, ys = a.split(), b.split()
    most = max(len(xs), len(ys))
    return max(0.0, 1.0 - align(xs, ys, most) / most)


#: Costs of opening and extending a gap, of two words written as one, and of words that have nothing in common.
OPEN, EXTEND, JOIN, OTHER = 0.8, 0.4, 0.1, 2.0


def align(xs: list[str], ys: list[str], limit: float = float("inf")) -> float:
    """Affine-gap alignment cost of two token lists; a word may also stand for two neighbours written as one. Costs beyond limit come out
    as some number beyond it.

    The lists are aligned within a band round the diagonal, which is doubled until a path that leaves it would cost more than the best one
    inside, so the result is that of the whole table."""
    if not xs or not ys:
        n = len(xs) + len(ys)
        return OPEN + EXTEND * (n - 1) if n else 0.0
    band, wide = 8, max(len(xs), len(ys))
    while True:
        cost = _banded(xs, ys, band + abs(len(xs) - len(ys)))
        # a path reaches past the band only by words without a partner, or by words that stand for two at JOIN or more each
        beyond = min(JOIN, EXTEND) * band
        if band >= wide or cost <= beyond or beyond > limit:
            return cost
        band *= 2


def _banded(xs: list[str], ys: list[str], band: int) -> float:
    """The cost within the band: a row holds the cells of columns i - band to i + band only, with one cell of padding on either side."""
    inf = 1e9
    m = len(ys)
    lo = 0
    hi = min(m, band)
    pad = [inf]
    M = pad + [0.0] + [inf] * hi + pad
    X = [inf] * (hi + 3)
    Y = pad + [inf] + [OPEN + EXTEND * j for j in range(hi)] + pad
    best = [min(c) for c in zip(M, X, Y)]
    before, before_lo = None, 0
    for i, x in enumerate(xs, 1):
        up_lo, up_M, up_X, up = lo, M, X, best
        lo, hi = max(0, i - band), min(m, i + band)
        M, X, Y = [inf] * (hi - lo + 3), [inf] * (hi - lo + 3), [inf] * (hi - lo + 3)
        two = xs[i - 2] + x if i > 1 else ""
        last = len(up) - 1
        for j in range(lo, hi + 1):
            k = j - lo + 1
            u = j - up_lo + 1  # the same column one row up
            if j == 0:
                X[k] = OPEN + EXTEND * (i - 1)
                continue
            y = ys[j - 1]
            v = up[u - 1] + substitute(x, y) if u - 1 <= last else inf
            if before is not None:
                w = j - before_lo
                if w < len(before) and before[w] < v:
                    v = min(v, before[w] + _as_one(two, y))
            if j > 1 and u - 2 >= 0 and u - 2 <= last and up[u - 2] < v:
                v = min(v, up[u - 2] + _as_one(x, ys[j - 2] + y))
            M[k] = v
            if u <= last:
                X[k] = min(up_M[u] + OPEN, up_X[u] + EXTEND)
            Y[k] = min(M[k - 1] + OPEN, Y[k - 1] + EXTEND)
        before, before_lo = up, up_lo
        best = [min(c) for c in zip(M, X, Y)]
    return best[m - lo + 1] if lo <= m <= hi else inf


@lru_cache(maxsize=100_000)
def substitute(x: str, y: str) -> float:
    """Little for one word in two writings (an abbreviation of the tables, a typo), more for the beginning of a word, else OTHER."""
    if x == y:
        return 0.0
    if canonical(x) == canonical(y):
        return 0.05
    k = min(len(x), len(y))
    if k > 1 and within(x, y, 1 if k < 6 else 2 if k < 12 else 3):
        return 0.1
    if x.startswith(y) or y.startswith(x):
        return 0.45
    return OTHER


def _as_one(x: str, y: str) -> float:
    """Cost of a word for two neighbours written as one, which may hold a typo but not be cut."""
    c = substitute(x, y)
    return JOIN + c if c <= 0.1 else OTHER + OPEN


def canonical(word: str) -> str:
    """The full form of an abbreviation of a kind of street or of a word in street and town names."""
    return STREET_TYPE.get(word) or PLACE_WORD.get(word, word)


def address_like(a: Address, b: Address) -> float:
    """0 to 1; at 0.5 and more two addresses are taken for one building. House number and street must agree, and town or postcode."""
    if not a.house or a.house != b.house:
        return 0.0
    if a.kind and b.kind and a.kind != b.kind:
        return 0.0
    if a.side and b.side and a.side != b.side:
        return 0.0
    if a.town != b.town and not (a.town and b.town) and len(a.street) != len(b.street):
        # the town may stand behind the street without a separator
        long, short = (a, b) if len(a.street) > len(b.street) else (b, a)
        if short.town and short.street and not long.town:
            k = len(short.street.split())
            rest = long.street.split()[k:]
            if rest and words_like(" ".join(rest), short.town) >= 0.6:
                a, b = short, long._replace(street=" ".join(long.street.split()[:k]), town=short.town)
    if a.street and b.street:
        st = words_like(a.street, b.street)
        if st < 0.59:
            return 0.0
    else:
        st = 0.3
    post = 0.5
    if a.post and b.post:
        post = 1.0 if a.post == b.post else 0.7 if within(a.post, b.post, 1) else 0.0
    town = 0.5
    if a.town and b.town:
        town = words_like(a.town, b.town)
        if town < 0.6 and (set(a.town.split()) & set(b.town.split())):
            town = 0.7
    if post == 0.0 or (town < 0.6 and town != 0.5):
        return 0.0 if post < 1.0 or town < 0.5 and st < 0.9 else 0.6
    if post == 0.7:
        return 0.45
    if post == 0.5 and town == 0.5:
        return 0.4 if st >= 0.9 else 0.0
    if st < 0.5:
        return 0.0
    return min(1.0, 0.5 + 0.2 * st + 0.15 * (post == 1.0) + 0.15 * (town > 0.5))
