"""Phonetic block keys of names, as column expressions."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lexicon import BOTH

def code(word: Column) -> Column:
    """Soundex of a word from its front and from its back: of up to eight consonants each tells."""
    return F.concat(F.soundex(word), F.soundex(F.reverse(word)))


def words(text: Column) -> Column:
    """The words of a form, which holds single spaces only."""
    return F.when(text != "", F.split(text, " ")).otherwise(F.array().cast("array<string>"))


def longest(ws: Column) -> Column:
    return F.aggregate(ws, F.lit(""), lambda acc, w: F.when(F.length(w) > F.length(acc), w).otherwise(acc))


def name_keys(given: Column, core: Column, business: Column, joined: Column, wide: bool = False) -> Column:
    """Block keys of a name, of both its readings where its given name abbreviates a line of business too. `wide` adds keys of four letters
    at one end with the letter at the other, for short names with damage in both halves."""
    other = F.create_map(*[F.lit(x) for kv in BOTH.items() for x in kv])
    with_line = F.array_join(F.array_sort(F.array_distinct(F.concat(words(business), F.array(F.try_element_at(other, given))))), " ")
    own = _keys(given, core, business, joined)
    if wide:
        ends = F.array(
            F.xxhash64(business, F.lit("<4"), F.substring(joined, 1, 4), F.substring(joined, -1, 1)), F.xxhash64(business, F.lit("4>"), F.substring(joined, -4, 4), F.substring(joined, 1, 1))
        )
        own = F.when((F.length(joined) >= 6) & (F.length(core) - F.length(F.replace(core, F.lit(" "), F.lit(""))) <= 1), F.concat(own, ends)).otherwise(own)
    return F.when(given.isin(*BOTH), F.concat(own, _keys(F.lit(""), core, with_line, joined))).otherwise(own)


def _keys(given: Column, core: Column, business: Column, joined: Column) -> Column:
    """Array of block keys (bigint) of a name: its line of business with the phonetic codes of its telling words, all of them,
    and all but one with the first letter of that one, and the words written as one; for a name of one or two words also with its first
    and its last half in letters.

    A set of codes is keyed by the exclusive or of their hashes, so the order of words doesn't matter and leaving one out takes one step,
    however long the name. Names of one organisation that differ by a damaged word, by two words written as one, by order, by a nickname
    or by an abbreviation share a key. Halves are taken long and short, so lengths that differ by one letter share one. A name of a given
    name alone is keyed by it, one of a line of business alone by that."""
    no_keys = F.array().cast("array<bigint>")
    key = lambda k, h: F.xxhash64(business, k, h)

    def of_words(each: Column, whole: Column) -> Column:
        n = F.size(each)
        without = F.when(n > 1, F.transform(each, lambda w: F.xxhash64(business, n, whole.bitwiseXOR(w["h"]), w["first"]))).otherwise(no_keys)
        alone = F.when(business != "", F.array(key(F.lit(0), F.lit(0).cast("long")))).otherwise(no_keys)
        return F.when(n > 0, F.concat(F.array(key(n, whole)), without)).otherwise(alone)

    short, long = F.floor(F.length(joined) / 2).cast("int"), F.ceil(F.length(joined) / 2).cast("int")
    front = lambda n: F.xxhash64(business, F.lit("<"), F.substring(joined, F.lit(1), n))
    back = lambda n: F.xxhash64(business, F.lit(">"), F.substring(joined, -n, n))
    one = F.xxhash64(business, F.lit("="), code(joined))
    told = let(words(core), lambda t: F.when(F.size(t) > 0, t).when(F.length(given) > 1, F.array(given)).otherwise(F.array().cast("array<string>")))
    by_words = let(
        F.transform(told, lambda w: F.struct(F.xxhash64(code(w)).alias("h"), F.substring(w, 1, 1).alias("first"))),
        lambda each: let(F.aggregate(each, F.lit(0).cast("long"), lambda acc, w: acc.bitwiseXOR(w["h"])), lambda whole: of_words(each, whole)),
    )
    # the only word is the name written as one; most names are such, and cheap
    gaps = F.length(core) - F.length(F.replace(core, F.lit(" "), F.lit("")))
    halves = F.when(F.length(joined) >= 6, F.array(front(short), front(long), back(short), back(long))).otherwise(no_keys)
    return (
        F.when((core != "") & (gaps == 0), F.concat(F.array(one), halves)).when(gaps == 1, F.concat(by_words, F.array(one), halves))
        .when(gaps > 1, F.concat(by_words, F.array(one))).otherwise(by_words)
    )


def let(value: Column, body) -> Column:
    """body(value), with value computed once however often body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)
