"""Column functions of the entity-resolution pipeline: normal forms and token sets. All run inside the JVM."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Literals that a delimited-text reader with default settings takes for missing.
NA_LITERALS = [
    "", " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
]
# The long stop list, of candidate retrieval.
STOP55 = [
    "the", "and", "for", "inc", "incorporated", "llc", "ltd", "limited", "corp", "corporation", "company", "co", "pvt", "private", "public", "plc",
    "llp", "group", "services", "service", "solutions", "industries", "industry", "enterprise", "enterprises", "international", "global", "health",
    "healthcare", "medical", "medicine", "hospital", "clinic", "care", "center", "centre", "road", "rd", "street", "st", "avenue", "ave", "lane",
    "ln", "building", "block", "floor", "sector", "district", "city", "state", "india", "united", "states", "usa",
]
# The short stop list, of recall analyses.
STOP30 = [
    "the", "and", "of", "for", "in", "on", "at", "to", "a", "an", "limited", "ltd", "llp", "inc", "incorporated", "corp", "corporation", "company",
    "co", "private", "pvt", "plc", "group", "center", "centre", "clinic", "services", "service", "health", "medical",
]


def na_to_null(c: Column) -> Column:
    return F.when(c.isin(NA_LITERALS), None).otherwise(c)


def normalize(c: Column) -> Column:
    """Lower case; runs of other than a-z and 0-9 become one space; null becomes ''."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def _words(n: Column) -> Column:
    return F.filter(F.split(n, " "), lambda x: x != "")


def tokens_min1(n: Column) -> Column:
    return F.array_distinct(_words(n))


def tokens_min3(n: Column) -> Column:
    return F.filter(tokens_min1(n), lambda x: F.length(x) >= 3)


def _without(n: Column, stop: list[str]) -> Column:
    return F.filter(tokens_min3(n), lambda x: ~x.isin(stop))


def tokens_stop55(n: Column) -> Column:
    return _without(n, STOP55)


def tokens_stop30(n: Column) -> Column:
    return _without(n, STOP30)


def token_list_stop30(n: Column) -> Column:
    """With repeats, in order."""
    return F.filter(_words(n), lambda x: (F.length(x) >= 3) & ~x.isin(STOP30))


def number_runs(n: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(n, F.lit("[0-9]+"), F.lit(0)))


def characters(n: Column) -> Column:
    """Distinct characters, the space included."""
    return F.filter(F.array_distinct(F.split(n, "")), lambda x: x != "")


def letters(n: Column) -> Column:
    """Distinct characters without the space."""
    return characters(F.replace(n, F.lit(" "), F.lit("")))


def character_mask(n: Column) -> Column:
    """A bit for each of the 37 characters that a normal form may have."""
    bits = [F.when(F.contains(n, F.lit(c)), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, c in enumerate(" 0123456789abcdefghijklmnopqrstuvwxyz")]
    return reduce(lambda a, b: a + b, bits)


def mask_jaccard(a: Column, b: Column) -> Column:
    """jaccard of the sets of characters behind two masks."""
    union = F.bit_count(a.bitwiseOR(b))
    return F.when(union == 0, F.lit(0.0)).otherwise(F.bit_count(a.bitwiseAND(b)) / union).cast("double")


def joined(a: Column) -> Column:
    return F.array_join(F.array_sort(a), " ")


def id_list(c: Column) -> Column:
    """Comma-separated ids, trimmed, blanks dropped; null gives an empty list."""
    return F.filter(F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")


def jaccard(a: Column, b: Column, both_empty: float = 0.0) -> Column:
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(both_empty)).otherwise(F.size(F.array_intersect(a, b)) / union).cast("double")


def overlap(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b)) / F.greatest(F.lit(1), F.least(F.size(a), F.size(b)))


def length_ratio(a: Column, b: Column) -> Column:
    return F.least(F.length(a), F.length(b)) / F.greatest(F.lit(1), F.length(a), F.length(b))
