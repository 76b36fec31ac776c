"""Matching a reference source with target sources by name, address and country, with a confidence."""
from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from ..functions.arrow import listed, uncollected
from ..operators.skew import join_split, sampled
from ..sources.scratch import materialize, shared_dir
from .addresses import Address, address_like, parse_address
from .names import Name, given_like, jaro_winkler, name_like, parse_name
from .phonetic import longest, name_keys, words

#: Marginal probability from which a pair is reported.
ACCEPT = 0.5
#: Log odds of a candidate pair before its evidence; odds that a record has no partner, as its one-to-one factor weighs them.
PRIOR, ALONE = -3.0, math.exp(-1.5)
#: Log odds of two countries that differ; on the tables with known pairs none of 22,582 do, once their writings are told.
ABROAD = -12.0
#: Belief propagation: damping, change below which all is settled, rounds after which steps shrink.
DAMP, SETTLED, FREE_ROUNDS = 0.25, 0.05, 12
#: Forms a task remembers so that copies are marked; those it forgets only cost time.
SEEN_ROWS = 100_000
#: The sieve of name keys: 64 bits a row, at most this many rows.
SIEVE_ROWS = 1 << 18

# Other writings of countries, in small letters without anything else.
COUNTRY = {
    "usa": "us", "unitedstates": "us", "unitedstatesofamerica": "us", "america": "us", "in": "india", "ind": "india", "bharat": "india", "fr": "france",
    "fra": "france", "de": "germany", "deutschland": "germany", "gb": "unitedkingdom", "uk": "unitedkingdom", "greatbritain": "unitedkingdom",
    "es": "spain", "espana": "spain", "it": "italy", "italia": "italy", "nl": "netherlands", "holland": "netherlands",
}

REC = "id string, name string, addr string, country string, fresh boolean"


def country_of(c: Column) -> Column:
    """One writing per country; null for a missing one."""
    plain = F.regexp_replace(F.lower(c), "[^a-z]", "")
    known = F.create_map(*[F.lit(x) for kv in COUNTRY.items() for x in kv])
    return F.when(~plain.isin("", "na", "null", "none"), F.coalesce(F.try_element_at(known, plain), plain))


def name_form(name: Name | None) -> str | None:
    return f"{name.given}|{' '.join(name.core)}|{' '.join(name.business)}|{name.joined if len(name.core) > 1 else ''}" if name else None


@lru_cache(maxsize=50_000)
def name_of(form: str | None) -> Name | None:
    if form is None:
        return None
    g, c, b, j = form.split("|")
    return Name(g, tuple(c.split()), tuple(b.split()), j or c)


@uncollected
def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Forms of name and address (an address without a house number is none). `fresh` marks the first row of its form in the task."""
    forms: set = set()
    for batch in batches:
        ids, names, addrs, countries, fresh = [], [], [], [], []
        for i, n, a, c in zip(*map(listed, batch.columns)):
            address = parse_address(a)
            name, addr = name_form(parse_name(n)), "|".join(address) if address and address.house else None
            if name is None and addr is None:
                continue
            form = (name, addr, c)
            ids.append(i)
            names.append(name)
            addrs.append(addr)
            countries.append(c)
            fresh.append(form not in forms)
            forms.add(form)
        if len(forms) > SEEN_ROWS:
            forms.clear()
        s = pa.string()
        cols = [pa.array(ids, s), pa.array(names, s), pa.array(addrs, s), pa.array(countries, s), pa.array(fresh, pa.bool_())]
        yield pa.RecordBatch.from_arrays(cols, ["id", "name", "addr", "country", "fresh"])


def _keys(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(cls, kh) by address and (cls, name, country, house, kh) by name, of each form; house is null where it has no address."""
    d = records.where("fresh")
    at = F.split("addr", "\\|")
    near = d.where("addr is not null").select("cls", at.alias("a"), F.split("name", "\\|")[1].alias("core"))
    near = near.select("cls", *[F.col("a")[i].alias(n) for i, n in ((0, "house"), (1, "street"), (3, "post"), (4, "town"))], F.coalesce("core", F.lit("")).alias("core"))
    first = lambda c: F.substring_index(c, " ", 1)
    lone = F.instr("core", " ") == 0
    by_address = F.array(
        F.when(F.col("post") != "", F.xxhash64(F.lit(1), "house", "post")),
        F.when(F.col("core") != "", F.xxhash64(F.lit(2), "house", F.substring("street", 1, 1), F.soundex(F.when(lone, F.col("core")).otherwise(longest(words(F.col("core"))))))),
        F.xxhash64(F.lit(3), "house", F.soundex(first("street")), F.soundex(first("town"))),
    )
    near = near.select("cls", F.explode(by_address).alias("kh")).where("kh is not null")
    parts = ("given", "core", "business", "joined")
    named = d.where("name is not null").select("cls", "name", "country", at[0].alias("house"), F.split("name", "\\|").alias("n"))
    named = named.select("cls", "name", "country", "house", *[F.col("n")[i].alias(p) for i, p in enumerate(parts)])
    named = named.withColumn("joined", F.when(F.col("joined") != "", F.col("joined")).otherwise(F.col("core")))
    by_name = name_keys(*map(F.col, parts))
    # a name without telling words has one more key, of its initial
    by_name = F.when(F.col("core") == "", F.concat(by_name, F.array(F.xxhash64(F.lit("i"), F.substring("given", 1, 1), "business")))).otherwise(by_name)
    named = named.select("cls", "name", "country", "house", F.explode(by_name).alias("kh"))
    return near, named


def _sieve(keys: DataFrame) -> DataFrame:
    """(_word, _bits): which of 64 * SIEVE_ROWS hash values occur among the keys. At most SIEVE_ROWS rows whatever the data."""
    at = F.pmod("kh", F.lit(64 * SIEVE_ROWS))
    return keys.groupBy(F.shiftright(at, 6).alias("_word")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(kh, {64 * SIEVE_ROWS}) & 63 as int))")).alias("_bits"))


def _sifted(keys: DataFrame, sieve: DataFrame) -> DataFrame:
    """Keys that the sieve may hold. It only saves a shuffle: what it lets through in vain meets nothing in the join."""
    at = F.pmod("kh", F.lit(64 * SIEVE_ROWS))
    hit = keys.withColumn("_word", F.shiftright(at, 6)).join(F.broadcast(sieve), "_word")
    return hit.where(F.expr(f"getbit(_bits, cast(pmod(kh, {64 * SIEVE_ROWS}) & 63 as int)) = 1")).drop("_word", "_bits")


def _clear(bare: DataFrame, full: DataFrame) -> DataFrame:
    """Of the forms without an address, those whose very name (and country) isn't at two house numbers of the other side. To the others two
    rivals of equal odds are known, so no candidate of theirs can reach ACCEPT (see `_told`): they have none."""
    key = F.xxhash64(F.lit("x"), "name", F.coalesce("country", F.lit(""))).alias("kh")
    own = bare.select("cls", key)
    there = _sifted(full.select(key, F.split("addr", "\\|")[0].alias("house")), _sieve(own))
    several = there.groupBy("kh").agg(F.min("house").alias("x"), F.max("house").alias("y")).where("x <> y").select("kh")
    gone = own.join(several, "kh", "left_semi").select("cls")
    return bare.join(gone, "cls", "left_anti")


def _told(keys: DataFrame) -> DataFrame:
    """(cls, kh) of forms with an address for the forms without one that share kh: all forms of a name and country that is at one house
    number, and two at different ones of any that is at several.

    To the factor of a form without an address, two records of one name at different house numbers are rivals of equal odds, of which none
    can reach ACCEPT, nor can any third; so two tell it as much as all would, and a name of a million buildings costs two pairs."""
    keys = keys.withColumn("_g", F.xxhash64("kh", "name", F.coalesce("country", F.lit(""))))
    per = keys.groupBy("_g", "kh").agg(F.min(F.struct("house", "cls")).alias("x"), F.max(F.struct("house", "cls")).alias("y"))
    several = per.where("x.house <> y.house").select("kh", F.explode(F.array("x.cls", "y.cls")).alias("cls"))
    one = per.where("x.house = y.house").select("_g", F.lit(True).alias("_one"))
    return join_split(keys.select("_g", "kh", "cls"), one, "_g", unique=True).select("cls", "kh").unionByName(several.select("cls", "kh"))


def loose(a: Name, b: Name) -> float:
    """Likeness of names at one building, where heavier damage is believed than elsewhere."""
    v = name_like(a, b)
    if v >= 0.8:
        return v
    if a.given and b.given and given_like(a.given, b.given) == 0:
        return 0.0
    sa, sb = set(a.business), set(b.business)
    if sa and sb and not sa & sb:
        return 0.0
    if not a.joined or not b.joined:
        return 0.75 if a.joined == b.joined else 0.0
    j = jaro_winkler("".join(a.core), "".join(b.core))
    if len(a.core) != len(b.core):
        j = max(j, jaro_winkler(a.joined, b.joined))
        x, y = (a, b) if len(a.core) < len(b.core) else (b, a)
        if set(x.core) <= set(y.core) and len(y.core) - len(x.core) == 1 and len(x.core) > 1:
            j = max(j, 0.87)
    return 0.7 if j >= 0.86 else 0.0


def evidence(na: Name | None, nb: Name | None, aa: Address | None, ab: Address | None) -> float | None:
    """What name and address add to the log odds that two records are one organisation at one building; None when they can't be."""
    n = None if na is None or nb is None else 1.0 if na is nb and na.core else loose(na, nb)
    if n == 0.0:
        return None
    a = None if aa is None or ab is None else address_like(aa, ab)
    if a == 0.0:
        return None
    if a is None and n is None:
        return None
    if a is None:
        return 2.0 if n >= 0.85 else None
    if n is None:
        return 2.0 if a >= 0.5 else None
    if a < 0.5:
        return 4.2 if n >= 0.85 else 0.5 if n >= 0.8 else None
    return 5.0 * a + (2.0 if n >= 0.8 else 0.0)


def label(name: Name | None, addr: Address | None, other_name: Name | None, other_addr: Address | None) -> int:
    """The class of a record among the candidates of another one, as a hash: what the other lacks (an address, a name, a given name in
    full) tells its candidates apart. Records of one class don't compete. 0: nothing tells it from any class."""
    parts = []
    if other_addr is None:
        parts.append("b:" + (addr.house if addr else "?"))
    if other_name is None:
        parts.append("n:" + ("+".join(name.business) + "|" + (name.core[0][0] if name.core else name.given[:1]) if name else "?"))
    elif len(other_name.given) == 1 and name and len(name.given) > 1:
        parts.append("g:" + name.given)
    return xxh3_64_intdigest(" ".join(parts)) >> 1 if parts else 0


@uncollected
def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        cols = map(listed, batch.columns[2:])
        theta, ls, lt = [], [], []
        for xn, xa, xc, yn, ya, yc in zip(*cols):
            na, nb, aa, ab = name_of(xn), name_of(yn), Address(*xa.split("|")) if xa else None, Address(*ya.split("|")) if ya else None
            e = evidence(na, nb, aa, ab)
            theta.append(None if e is None else e + PRIOR + (ABROAD if xc is not None and yc is not None and xc != yc else 0.0))
            ls.append(None if e is None else label(na, aa, nb, ab))
            lt.append(None if e is None else label(nb, ab, na, aa))
        score = pa.array(theta, pa.float64())
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(ls, pa.int64()), pa.array(lt, pa.int64()), score], ["s", "t", "ls", "lt", "theta"]).filter(score.is_valid())


def _classes(records: DataFrame, side: str) -> DataFrame:
    """The forms of a side, once each, by their hash. Copies of one form, however many, send one row per task."""
    d = records.where("fresh").select("cls", "name", "addr", "country").repartition("cls").distinct()
    return d.select(F.col("cls").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("name", "addr", "country")])


def candidates(refs: DataFrame, targets: DataFrame) -> DataFrame:
    """(s, t, ls, lt, theta): pairs of forms that share a block and aren't excluded, once each, with the class of each in the one-to-one
    factor of the other and the log odds of their evidence."""
    yes, no = F.lit(True).alias("open"), F.lit(False).alias("open")
    named = [d.where("fresh and name is not null") for d in (refs, targets)]
    kept = [materialize(_clear(named[i].where("addr is null"), named[1 - i].where("addr is not null")), "bare") for i in (0, 1)]
    sides = [[*_keys(d)] for d in (refs, targets)]
    # a form without an address meets by name; of the others only those keys move that such a form of the other side may have
    bare = [_keys(d)[1] for d in kept]
    full = [_told(materialize(_sifted(sides[i][1].where("house is not null"), _sieve(bare[1 - i])), "named")) for i in (0, 1)]
    near = [d.unionByName(k.select("cls", "kh")).select("cls", "kh", yes).unionByName(f.select("cls", "kh", no)) for (d, _), k, f in zip(sides, bare, full)]
    left, right = near[0].withColumnsRenamed({"cls": "s", "open": "_a"}), near[1].withColumnsRenamed({"cls": "t", "open": "_b"})
    look = [_keys(sampled(d))[0].select("kh") for d in (refs, targets)]
    met = join_split(left, right, "kh", look=look).where("_a or _b").select("s", "t")
    pairs = materialize(met.repartition("t").distinct(), "met")
    some = sampled(pairs)
    both = join_split(pairs, _classes(targets, "t"), "t", unique=True, look=[some])
    both = join_split(both, _classes(refs, "s"), "s", unique=True, look=[some])
    both = both.select("s", "t", "s_name", "s_addr", "s_country", "t_name", "t_addr", "t_country")
    return both.mapInArrow(_score, "s bigint, t bigint, ls bigint, lt bigint, theta double")


def propagate(pairs: DataFrame) -> DataFrame:
    """(s, t, theta, p, rounds): marginal match probabilities of candidate pairs (s, t, ls, lt, theta), given once each, by loopy belief propagation, and the number of message
    rounds until the pair was settled.

    A pair is a binary variable with log odds theta. A one-to-one factor at each of its two records lets the record match one class of
    the other side, or none (with odds ALONE): it tells a pair -log(ALONE + sum of the best odds of the other classes), each without what
    the factor itself said. Pairs of one class don't compete, so all writings of a match are kept; class 0 competes with none. A pair
    that no other class rivals is raised by both its factors, one with strong rivals is lowered, so theta alone decides no pair.

    All pairs exchange messages in the first round. Those whose factors hear no other class get the same message in every round and are
    settled by it; the others go on, through aggregations and joins by record, until no message moves by more than SETTLED. Steps are
    damped, and shrink by half every three rounds after FREE_ROUNDS, so the loop ends on every graph (messages are bounded)."""
    spark = pairs.sparkSession
    shared_dir(spark)
    best = materialize(pairs.select("s", "t", "theta", "ls", "lt"), "pairs")

    def rivals(me: str, other: str) -> DataFrame:
        c = F.nullif(F.col(other), F.lit(0))
        return best.groupBy(me).agg(F.min(c).alias("_x"), F.max(c).alias("_y")).where("_x <> _y").select(me, F.lit(True).alias("_many_" + me))

    alone = -math.log(ALONE)
    marked = best.join(rivals("s", "lt"), "s", "left").join(rivals("t", "ls"), "t", "left").withColumn("_busy", F.coalesce("_many_s", "_many_t").isNotNull())
    marked = materialize(marked.select("s", "t", "theta", "ls", "lt", "_busy"), "marked")
    sigmoid = lambda x: 1 / (1 + F.exp(-x))
    calm = marked.where("not _busy").select("s", "t", "theta", sigmoid(F.col("theta") + 2 * alone).alias("p"), F.lit(1).alias("rounds"))
    loop = marked.where("_busy").select("s", "t", "theta", "ls", "lt", F.lit(0.0).alias("ms"), F.lit(0.0).alias("mt")).checkpoint()
    rounds, moved = 0, None
    while loop is not None:
        rounds += 1
        step = (1 - DAMP) * 0.5 ** (max(0, rounds - FREE_ROUNDS) / 3)

        def heard(me: str, other: str, own: str, back: str) -> DataFrame:
            """Per record and class of the other side, the message of the record's factor."""
            per = loop.where(F.col(other) != 0).groupBy(me, other).agg(F.exp(F.max(F.least(F.col("theta") + F.col(back), F.lit(30.0)))).alias("_o"))
            total = per.groupBy(me).agg(F.sum("_o").alias("_total"))
            per = per.join(total, me).select(me, other, F.greatest(F.col("_total") - F.col("_o"), F.lit(0.0)).alias("_rest"))
            return per.select(me, other, (-F.log(F.lit(ALONE) + F.col("_rest"))).alias(own))

        new = loop.join(heard("s", "lt", "ns", "mt"), ["s", "lt"], "left").join(heard("t", "ls", "nt", "ms"), ["t", "ls"], "left")
        ns, nt = F.coalesce("ns", F.lit(alone)), F.coalesce("nt", F.lit(alone))
        moves = [F.lit(step) * (ns - F.col("ms")), F.lit(step) * (nt - F.col("mt"))]
        new = new.select(
            "s", "t", "theta", "ls", "lt", (F.col("ms") + moves[0]).alias("ms"), (F.col("mt") + moves[1]).alias("mt"), F.greatest(*map(F.abs, moves)).alias("moved")
        ).checkpoint()
        moved = new.agg(F.max("moved")).head()[0]
        loop = new.drop("moved")
        if moved is None or moved <= SETTLED * step:
            break
    settled = loop.select("s", "t", "theta", sigmoid(F.col("theta") + F.col("ms") + F.col("mt")).alias("p"), F.lit(rounds).alias("rounds"))
    return calm.unionByName(settled)


def _judged(ref: DataFrame, targets: list[DataFrame], ident: str, name: str, address: str, country: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    def read(df: DataFrame, label: str) -> DataFrame:
        d = df.select(F.col(ident).alias("id"), F.col(name).alias("n"), F.col(address).alias("a"), country_of(F.col(country)).alias("c")).where("id is not null")
        d = d.mapInArrow(_parse, REC)
        return materialize(d.withColumn("cls", F.xxhash64(*[F.coalesce(c, F.lit("\u0001")) for c in ("name", "addr", "country")])), label)

    t = targets[0].select(ident, name, address, country)
    for more in targets[1:]:
        t = t.unionByName(more.select(ident, name, address, country))
    refs, tgts = read(ref, "refs"), read(t, "targets")
    return propagate(candidates(refs, tgts)), refs, tgts


def match(
    ref: DataFrame, targets: list[DataFrame], least: float = 0.0, ident: str = "entity_id", name: str = "business_name", address: str = "business_address", country: str = "country"
) -> DataFrame:
    """(source1_entity_id, target_entity_id, confidence): candidate pairs of records that may be one organisation at one building, with the
    marginal probability of a match, from `least` on.

    Name and address may each be missing (null, blank, NA, N/A, null, None) on either side, not both on one; a missing country says
    nothing, different ones all but exclude a match. Null ids and repeated rows don't count; an id with several contents is matched by the
    best of them; other columns are ignored. An empty side: no rows. Every pair that shares a block is judged; no block is cut.

    Rows are parsed once; records of equal forms are one node from then on, told by a 64-bit hash of the forms, and are attached again at
    the end. Blocks by address: house number with postcode, with the street's first letter and the longest telling word's phonetic code,
    with the codes of street and town. A record without an address meets those that share a phonetic key of the name (`phonetic.name_keys`); where one name is at several
    house numbers, two of its forms stand for all in that (`_told`), which changes no decision at ACCEPT. Pairs become variables of
    `propagate`, whose marginals are reported. Hot blocks, nodes and forms are split."""
    judged, refs, tgts = _judged(ref, targets, ident, name, address, country)
    kept = materialize(judged.where(F.col("p") >= least).select("s", "t", "p"), "judged")
    ids = lambda d, side, as_: d.select(F.col("cls").alias(side), F.col("id").alias(as_))
    of_t, of_s = ids(tgts, "t", "target_entity_id"), ids(refs, "s", "source1_entity_id")
    some = sampled(kept)
    out = join_split(join_split(kept, of_t, "t", look=[some, sampled(of_t)]), of_s, "s", look=[some, sampled(of_s)])
    return out.groupBy("source1_entity_id", "target_entity_id").agg(F.round(F.max("p"), 6).alias("confidence"))


def settling(ref: DataFrame, targets: list[DataFrame]) -> DataFrame:
    """(rounds, n_pairs, n_accepted, n_by_evidence, n_raised, n_lowered): how many pairs of forms settled after so many message rounds, how
    many of them are accepted, how many evidence alone would accept, and how many the messages raised or lowered across ACCEPT."""
    judged, _, _ = _judged(ref, targets, "entity_id", "business_name", "business_address", "country")
    c = lambda x: F.sum(F.when(x, 1).otherwise(0))
    yes, before = F.col("p") >= ACCEPT, F.col("theta") >= math.log(ACCEPT / (1 - ACCEPT))
    return judged.groupBy(F.col("rounds").cast("long").alias("rounds")).agg(
        F.count(F.lit(1)).alias("n_pairs"), c(yes).alias("n_accepted"), c(before).alias("n_by_evidence"), c(yes & ~before).alias("n_raised"), c(before & ~yes).alias("n_lowered")
    )
