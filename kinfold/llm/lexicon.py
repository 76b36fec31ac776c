"""Fixed word tables of the name and address comparers, and the token canonicaliser built on them."""
from __future__ import annotations

import re
import unicodedata

# Legal forms and other words that do not tell organisations apart.
LEGAL = set(
    "ltd limited llc inc incorporated co company corp corporation llp lp plc pvt private sarl sa sas eurl gmbh ag bv nv spa srl "
    "the and et hq head office ms messrs pty main branch".split()
)
COUNTRY_WORDS = set("india us usa france fr in bharat".split())

# Lines of business in full spelling.
BUSINESS = (
    "foods manufacturing engineering trading logistics textiles pharmacy plumbing electricals hardware dental roofing furniture insurance "
    "construction travels bakery agro motors jewellers chemicals veterinary consulting packaging printing landscaping building opticians "
    "supplies materials products software medical restaurant services laundry storage distributors freight solutions security photography "
    "management systems international boulangerie menuiserie generale transports pharmacie plomberie electricite conseil batiment fromagerie "
    "imprimerie garage librairie agricole maconnerie patisserie metallerie cremerie societe etablissements epicerie hotel eyewear fitness "
    "electronics industries enterprises group stores clinic salon tailors gym cafe cleaning cleaners"
).split()

# Abbreviations that the subsequence rule cannot resolve alone.
BUSINESS_ABBR = {
    "mfg": "manufacturing", "manuf": "manufacturing", "mgt": "management", "mgmt": "management", "eng": "engineering", "engg": "engineering",
    "engr": "engineering", "intl": "international", "int": "international", "elec": "electricals", "elect": "electricals", "sys": "systems",
    "rest": "restaurant", "restt": "restaurant", "jewelers": "jewellers", "bldg": "building", "med": "medical",
    "medl": "medical", "mat": "materials", "matls": "materials", "cons": "consulting", "const": "construction", "constr": "construction",
    "conslt": "consulting", "ins": "insurance", "insur": "insurance", "pharm": "pharmacy", "phcy": "pharmacy", "vet": "veterinary",
    "vety": "veterinary", "chem": "chemicals", "chems": "chemicals", "soln": "solutions", "solns": "solutions", "softw": "software",
    "photo": "photography", "photog": "photography", "dist": "distributors", "distrs": "distributors", "sec": "security", "tex": "textiles",
    "textls": "textiles", "prods": "products", "prod": "products", "supp": "supplies", "svcs": "services", "svc": "services", "hdwe": "hardware",
    "furn": "furniture", "logist": "logistics", "trdg": "trading", "tradg": "trading", "optic": "opticians", "gle": "generale",
    "gen": "generale", "bat": "batiment", "htl": "hotel", "gar": "garage", "libr": "librairie", "plomb": "plomberie", "menuis": "menuiserie",
    "boul": "boulangerie", "blgerie": "boulangerie", "epic": "epicerie", "crem": "cremerie", "tpts": "transports", "ets": "etablissements",
    "frt": "freight", "pkg": "packaging", "pckg": "packaging", "prtg": "printing", "printg": "printing", "bky": "bakery", "dentl": "dental",
    "mtrs": "motors", "trvls": "travels", "lndry": "laundry", "stge": "storage", "jwlrs": "jewellers", "landscpg": "landscaping",
    "plmbg": "plumbing", "mac": "maconnerie", "agri": "agricole",
    "pharmacie": "pharmacy", "phie": "pharmacy", "conseil": "consulting", "electricite": "electricals", "elctr": "electricals",
    "ste": "societe", "imp": "imprimerie", "impr": "imprimerie", "from": "fromagerie", "from'": "fromagerie", "pat": "patisserie",
}

# Given names and the short or foreign forms of each.
GIVEN = {
    "william": "wm will bill billy liam willie", "margaret": "maggie peggy meg marge margie", "robert": "rob bob robt bobby robbie",
    "elizabeth": "liz beth eliza betty lizzie elisabeth", "susanne": "sue suzy susan suzanne susie", "nicholas": "nick nico nicolas",
    "alexander": "alex alec sandy xander", "mohammad": "mohd md mohammed muhammad mohamed mohamad", "chandrika": "chandra",
    "krishna": "kishan krish kishen krishnan", "subrahmanya": "subbu subramanya subramanian", "lakshmi": "laxmi luxmi",
    "patricia": "pat trish patty tricia", "venkatesh": "venky venkat venkatesan", "frederick": "fred fredk freddy frederic",
    "theodore": "theo ted teddy", "charles": "charlie chas chuck", "joseph": "joe jos joey", "katherine": "kate kathy katie kathryn catherine",
    "jennifer": "jen jenny", "thomas": "tom thos tommy", "rebecca": "becky becca", "samuel": "sam saml", "edward": "ed ned eddie edwd ted teddy",
    "michael": "mick mike mickey", "richard": "rich dick rick", "dominique": "dom", "jean": "", "pierre": "", "francois": "fr",
    "genevieve": "ginette", "james": "jim jas jimmy", "john": "jack jon", "george": "geo", "daniel": "dan danny", "matthew": "matt",
}

# Kinds of street, each with its short forms.
STREET_TYPES = {
    "road": "rd raod", "street": "st str", "avenue": "ave av aven avn", "boulevard": "blvd bd boul bld", "lane": "ln la",
    "drive": "dr drv", "court": "ct crt", "parkway": "pkwy pky", "highway": "hwy hiway", "marg": "mrg maarg", "nagar": "ngr nagr nagaar",
    "cross": "crs x", "colony": "cly colny", "bazaar": "bzr bazar", "rue": "r", "place": "pl plce", "chemin": "ch chem che", "impasse": "imp",
    "allee": "all", "quai": "q", "route": "rte", "square": "sq", "terrace": "terr", "way": "wy", "circle": "cir", "trail": "trl",
}
FRENCH_TYPES = {"rue", "place", "chemin", "impasse", "allee", "quai", "route", "avenue", "boulevard", "cours"}
STREET_TYPE = {s: k for k, v in STREET_TYPES.items() for s in [k, *v.split()]}

# Words of street and town names, each with its postal abbreviations.
PLACE_WORDS = {
    "mount": "mt mnt", "mountain": "mtn mntn", "fort": "ft frt", "lodge": "ldg ldge lodg", "point": "pt", "port": "prt", "heights": "hts ht",
    "hill": "hl", "hills": "hls", "spring": "spg spng", "springs": "spgs spngs", "falls": "fls", "junction": "jct jctn", "village": "vlg vill",
    "valley": "vly vally", "lake": "lk", "lakes": "lks", "grove": "grv grov", "garden": "gdn gardn", "gardens": "gdns grdns", "meadow": "mdw",
    "meadows": "mdws", "ridge": "rdg rdge", "river": "rvr riv", "beach": "bch", "bridge": "brg brdg", "creek": "crk", "estate": "est",
    "estates": "ests", "forest": "frst", "harbor": "hbr harbr", "island": "isl islnd", "landing": "lndg lndng", "manor": "mnr", "mill": "ml",
    "mills": "mls", "plaza": "plz plza", "station": "sta statn stn", "summit": "smt sumit", "view": "vw", "vista": "vis vst", "center": "ctr cntr centre",
    "cliff": "clf", "corner": "cor", "cove": "cv", "farm": "frm", "field": "fld", "fields": "flds", "glen": "gln", "green": "grn", "haven": "hvn",
    "hollow": "holw hllw", "orchard": "orch", "pine": "pne", "shore": "shr", "union": "un", "well": "wl", "wells": "wls", "park": "pk", "gate": "gt",
    "north": "n", "south": "s", "east": "e", "west": "w", "upper": "upr", "lower": "lwr", "great": "grt gt", "little": "ltl",
    "general": "gal gnrl", "marechal": "mal", "docteur": "doct", "president": "pdt", "professeur": "pr prof", "faubourg": "fbg fg", "sainte": "ste",
}
PLACE_WORD = {s: k for k, v in PLACE_WORDS.items() for s in v.split()}

# Regions with short forms.
STATES = {
    "maharashtra": "mh", "tamil nadu": "tn", "kerala": "kl", "rajasthan": "rj", "punjab": "pb", "gujarat": "gj", "telangana": "ts tg",
    "karnataka": "ka",
}
STATE_WORDS = {s for k, v in STATES.items() for s in [*k.split(), *v.split()]} | set(
    "al ak az ar ca co ct de fl ga hi id il in ia ks ky la me md ma mi mn ms mo mt ne nv nh nj nm ny nc nd oh ok or pa ri sc sd tn tx ut vt va wa wv wi wy".split()
)
DIRECTIONS = {"n": "north", "s": "south", "e": "east", "w": "west", "no": "no"}
# Words of parts within or near a building, and how many following words belong to them.
ORDINALS = {"1st": "first", "2nd": "second", "3rd": "third", "4th": "fourth", "5th": "fifth", "6th": "sixth", "7th": "seventh", "8th": "eighth", "9th": "ninth"}

#: Short form -> the given names that it may stand for.
FULL_NAMES: dict[str, frozenset[str]] = {}
for _k, _v in GIVEN.items():
    for _s in [_k, *_v.split()]:
        FULL_NAMES[_s] = FULL_NAMES.get(_s, frozenset()) | {_k}
#: Short forms of given names that abbreviate a line of business too.
BOTH = {s: BUSINESS_ABBR[s] for s in FULL_NAMES if s in BUSINESS_ABBR}
#: A short form of one name alone is written as that name, any other stays.
GIVEN_OF = {s: min(full) if len(full) == 1 and s not in BOTH else s for s, full in FULL_NAMES.items()}
_BY_FIRST: dict[str, list[str]] = {}
for _w in BUSINESS:
    _BY_FIRST.setdefault(_w[0], []).append(_w)
BUSINESS_SET = set(BUSINESS)
GIVEN_LONG = [g for g in GIVEN_OF if len(g) >= 6]


def plain(text: str) -> str:
    """Lower case without accents and invisible characters."""
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", text.replace("ß", "ss").replace("œ", "oe").replace("æ", "ae").replace("º", "o").replace("°", "o"))
    return "".join(c for c in text if not unicodedata.combining(c) and c not in "​­﻿").lower()


def within(a: str, b: str, most: int) -> bool:
    """Whether a and b are at most `most` edits apart (insert, delete, replace, swap of neighbours)."""
    if a == b:
        return True
    la, lb = len(a), len(b)
    if abs(la - lb) > most:
        return False
    i = 0
    while i < la and i < lb and a[i] == b[i]:
        i += 1
    j = 0
    while j < la - i and j < lb - i and a[la - 1 - j] == b[lb - 1 - j]:
        j += 1
    a, b = a[i : la - j], b[i : lb - j]
    la, lb = len(a), len(b)
    if la == 0 or lb == 0:
        return max(la, lb) <= most
    if la == 1 and lb == 1:
        return True
    if most == 1:
        return la == 2 and lb == 2 and a[0] == b[1] and a[1] == b[0]
    return edits(a, b) <= most


def edits(a: str, b: str) -> int:
    """Edit distance with swaps of neighbours."""
    prev2: list[int] = []
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            d = min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb))
            if i > 1 and j > 1 and ca == b[j - 2] and a[i - 2] == cb:
                d = min(d, prev2[j - 2] + 1)
            cur.append(d)
        prev2, prev = prev, cur
    return prev[-1]


def is_subsequence(short: str, long: str) -> bool:
    it = iter(long)
    return all(c in it for c in short)


def _ends(words: list[str]) -> dict[str, list[str]]:
    """Words by their first three and by their last three letters: a word with a typo or two keeps one of them."""
    out: dict[str, list[str]] = {}
    for w in words:
        out.setdefault("^" + w[:3], []).append(w)
        out.setdefault("$" + w[-3:], []).append(w)
    return out


_BUSINESS_ENDS = _ends([w for w in BUSINESS if len(w) >= 5])
_GIVEN_ENDS = _ends(GIVEN_LONG)
_VOWELS = set("aeiou")


def business_of(tok: str) -> str:
    """The line-of-business word that tok stands for, or ''. A short form of a given name is left to `names.readings`."""
    if tok in BOTH:
        return ""
    if tok in BUSINESS_ABBR:
        return BUSINESS_ABBR[tok]
    if tok in BUSINESS_SET:
        return tok
    n = len(tok)
    if n < 3:
        return ""
    found = ""
    if n >= 5:
        for w in (*_BUSINESS_ENDS.get("^" + tok[:3], ()), *_BUSINESS_ENDS.get("$" + tok[-3:], ())):
            if w[0] == tok[0] and within(tok, w, 1 if len(w) < 8 else 2):
                found = w
                break
    if not found and n <= 9:
        if _VOWELS.isdisjoint(tok[1:]):
            # consonants of a word, in order
            near = [w for w in _BY_FIRST.get(tok[0], ()) if n < len(w) - 1 and is_subsequence(tok, w)]
        elif n >= 4:
            near = [w for w in dict.fromkeys(_BUSINESS_ENDS.get("^" + tok[:3], ())) if n < len(w) - 1 and w.startswith(tok)]
        else:
            near = []
        found = near[0] if len(near) == 1 else ""
    return BUSINESS_ABBR.get(found, found)


def given_of(tok: str) -> str:
    """The given name that tok stands for, or ''."""
    out = GIVEN_OF.get(tok, "")
    if not out and len(tok) >= 6:
        for g in (*_GIVEN_ENDS.get("^" + tok[:3], ()), *_GIVEN_ENDS.get("$" + tok[-3:], ())):
            if g[0] == tok[0] and within(tok, g, 1):
                return GIVEN_OF[g]
    return out


MISSING = {"", "na", "n/a", "null", "none"}


def present(value: str | None) -> bool:
    return value is not None and value.strip().lower() not in MISSING


_DOTTED = re.compile(r"\b(?:s\.a\.r\.l|s\.a\.s|s\.a|l\.l\.p|l\.l\.c|g\.m\.b\.h|e\.u\.r\.l|p\.l\.c|u\.s\.a|u\.s)\b\.?")
DIGIT_AS_LETTER = str.maketrans("0135", "oles")
