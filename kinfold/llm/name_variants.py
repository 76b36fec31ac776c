"""Linking the writings of one organisation's name."""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_split, meet_within, sampled
from ..sources.scratch import materialize
from .components import connected_components
from .names import Name, compatible, name_like, parse_name
from .phonetic import name_keys

SAME = 0.85
#: A word of COMMON_SHARE of all names weighs 1 as a common word, a rarer one less in proportion; COMMON_SURE is how many names make a
#: share half sure. Weights below COMMON_LEAST are left out.
COMMON_SHARE, COMMON_SURE, COMMON_LEAST = 2e-4, 3, 0.3


def key_of(n: Name) -> str:
    return "|".join((n.given, " ".join(n.core), " ".join(n.business), n.joined))


def name_of(key: str) -> Name:
    given, core, business, joined = key.split("|")
    return Name(given, tuple(core.split()), tuple(business.split()), joined)


def keys_of(cls: Column) -> Column:
    """Block keys of a canonical form."""
    p = F.split(cls, "\\|")
    return name_keys(p[0], p[1], p[2], p[3], wide=True)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [key_of(n) if (n := parse_name(v)) is not None else None for v in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.string())], ["id", "name", "cls"])


def _verify(common: dict[str, float]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, s = [], [], []
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                v = name_like(name_of(x), name_of(y), common)
                if v >= SAME:
                    a.append(x)
                    b.append(y)
                    s.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.string()), pa.array(b, pa.string()), pa.array(s, pa.float64())], ["a", "b", "score"])

    return run


def _compatible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [x == y or compatible(name_of(x), name_of(y)) for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        yield batch.filter(pa.array(keep, pa.bool_()))


def parsed(df: DataFrame, ident: str, name: str) -> DataFrame:
    """(id, name, cls) per distinct id and present name; cls is the canonical form: given name, telling words, line of business."""
    rows = df.select(F.col(ident).alias("id"), F.col(name).alias("name")).where("id is not null and name is not null").distinct()
    return materialize(rows.mapInArrow(_parse, "id string, name string, cls string").where("cls is not null"), "names")


def common_words(classes: DataFrame) -> dict[str, float]:
    """Telling words and how common they are, 0 to 1: share of the classes over COMMON_SHARE (1 at most), times n / (n + COMMON_SURE).

    Shares don't grow with the table. A class has few words, so at most their number over COMMON_LEAST * COMMON_SHARE come out: a bound
    that doesn't grow with the data either."""
    words = classes.select(F.explode(F.array_distinct(F.split(F.split("cls", "\\|")[1], " "))).alias("w")).where("w <> ''")
    total = classes.agg(F.count(F.lit(1)).alias("t"))
    n = words.groupBy("w").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(total))
    weight = F.least(F.lit(1.0), F.col("n") / F.col("t") / COMMON_SHARE) * F.col("n") / (F.col("n") + COMMON_SURE)
    return {r["w"]: r["c"] for r in n.select("w", weight.alias("c")).where(F.col("c") >= COMMON_LEAST).collect()}


def class_links(records: DataFrame) -> DataFrame:
    """(a, b, score): accepted pairs of different canonical forms. Blocks of phonetic codes of the telling words (`phonetic.name_keys`),
    then Jaro-Winkler of their words, given names through the nickname table."""
    classes = records.select("cls").distinct()
    common = common_words(classes)
    keys = materialize(classes.select("cls", F.explode(F.array_distinct(keys_of(F.col("cls")))).alias("key")), "name-keys")
    # keys of one class alone make no pair
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = meet_within(keys.join(shared, "key"), "key", "n", ["cls"]).where("a_cls < b_cls")
    pairs = pairs.select(F.col("a_cls").alias("a"), F.col("b_cls").alias("b")).distinct()
    return pairs.mapInArrow(_verify(common), "a string, b string, score double")


def name_groups(df: DataFrame, ident: str = "entity_id", name: str = "business_name") -> DataFrame:
    """(id, name, cls, group_id): every id with a present name and the group of names it belongs to.

    Missing names (null, blank, NA, N/A, null, None) have no row. Repeated rows count once; an id with two names has two rows. Names that
    parse alike share cls, the canonical form; accepted pairs of forms are clustered by connected components, and group_id is the least
    form. Empty table: no rows."""
    records = parsed(df, ident, name)
    links = class_links(records)
    comp = connected_components(links, "a", "b")
    return records.join(comp.select(F.col("node").alias("cls"), "component"), "cls", "left").select(
        "id", "name", "cls", F.coalesce("component", "cls").alias("group_id")
    )


def variant_pairs(df: DataFrame, ident: str = "entity_id", name: str = "business_name") -> DataFrame:
    """(entity_id_a, entity_id_b): pairs of different ids in one group of names whose names differ as stored, the smaller id first.

    Two forms that a chain of initials brought into one group but whose given names or lines of business exclude one another make no
    pair. Pairs of equal names are not cases, so copies of one name, however many, are never paired with one another: groups first
    reduce to distinct (form, name) entries, only differing entries of a group meet, and ids are attached at the end."""
    groups = materialize(name_groups(df, ident, name), "name-groups")
    entries = groups.groupBy("group_id", "cls", "name").agg(F.count(F.lit(1)).alias("n"))
    many = entries.groupBy("group_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    met = meet_within(entries.join(many, "group_id"), "group_id", "k", ["cls", "name"]).where("a_name < b_name")
    met = met.select(F.col("a_cls").alias("ca"), F.col("b_cls").alias("cb"), F.col("a_name").alias("na"), F.col("b_name").alias("nb"))
    met = met.mapInArrow(_compatible, "ca string, cb string, na string, nb string").select("na", "nb").distinct()
    ids = groups.select("id", "name").distinct()
    met = materialize(met, "name-pairs")
    out = join_split(met, ids.select(F.col("id").alias("ia"), F.col("name").alias("na")), "na")
    out = join_split(out, ids.select(F.col("id").alias("ib"), F.col("name").alias("nb")), "nb", look=[sampled(met)])
    return out.where("ia <> ib").select(F.least("ia", "ib").alias("entity_id_a"), F.greatest("ia", "ib").alias("entity_id_b")).distinct()
