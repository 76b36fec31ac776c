"""Which address records denote the same building."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_split, meet_within, sampled
from ..sources.scratch import materialize
from .addresses import Address, address_like, canonical, parse_address

SAME = 0.5
#: MinHash: bands of ROWS hash values. Two sets of similarity s share a band with probability 1 - (1 - s**ROWS)**BANDS.
BANDS, ROWS = 14, 2
_SEED = np.random.default_rng(7)
_A = _SEED.integers(1, 2**61, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)
_B = _SEED.integers(0, 2**61, BANDS * ROWS, dtype=np.uint64)


def key_of(a: Address) -> str:
    return "|".join(a)


def address_of(key: str) -> Address:
    return Address(*key.split("|"))


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [key_of(a) if (a := parse_address(v)) is not None else None for v in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(keys, pa.string())], ["id", "address", "cls"])


def parsed(df: DataFrame, ident: str, address: str) -> DataFrame:
    """(id, address, cls) per distinct id and present address; cls is the canonical form."""
    rows = df.select(F.col(ident).alias("id"), F.col(address).alias("address")).where("id is not null and address is not null").distinct()
    return materialize(rows.mapInArrow(_parse, "id string, address string, cls string").where("cls is not null"), "addresses")


def with_towns(classes: DataFrame) -> DataFrame:
    """(cls, full): forms with a postcode but no town get the town that most forms with that postcode have; ties by name."""
    part = F.split("cls", "\\|")
    c = classes.select("cls", part[3].alias("post"), part[4].alias("town"))
    votes = c.where("post <> '' and town <> ''").groupBy("post", "town").agg(F.count(F.lit(1)).alias("n"))
    best = votes.groupBy("post").agg(F.max_by("town", F.struct("n", "town")).alias("_town"))
    lacking = c.where("post <> '' and town = ''").join(best, "post", "left")
    p = F.split("cls", "\\|")
    filled = lacking.select("cls", F.concat_ws("|", p[0], p[1], p[2], p[3], F.coalesce("_town", F.lit("")), p[5]).alias("full"))
    return filled.unionByName(c.where("post = '' or town <> ''").select("cls", F.col("cls").alias("full")))


def shingles(a: Address) -> list[str]:
    """Tokens and padded 3-grams of the street, town and postcode, abbreviations in full."""
    out = []
    for w in map(canonical, (a.street + " " + a.town).split()):
        p = "^" + w + "$"
        out.append(w)
        out += [p[i : i + 3] for i in range(len(p) - 2)]
    if a.post:
        out += [a.post, a.post + "#"]
    return out or ["-"]


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per form and band: the band's key holds the house number, which two writings of one building share."""
    import xxhash

    hash_of = xxhash.xxh3_64_intdigest
    for whole in batches:
        for z in range(0, whole.num_rows, 2000):
            batch = whole.slice(z, 2000)
            fulls = batch.column(1).to_pylist()
            flat: list[int] = []
            starts, houses = [], []
            for f in fulls:
                a = address_of(f)
                starts.append(len(flat))
                flat += [hash_of(s) for s in shingles(a)]
                houses.append(a.house)
            if not fulls:
                continue
            h = np.array(flat, np.uint64)
            at = np.array(starts)
            keys = []
            for b in range(BANDS):
                key = np.full(len(fulls), np.uint64(b + 1), np.uint64)
                for r in range(ROWS):
                    k = b * ROWS + r
                    mixed = h * _A[k] + _B[k]
                    mixed ^= mixed >> np.uint64(29)
                    key = key * np.uint64(0x9E3779B97F4A7C15) + np.minimum.reduceat(mixed, at)
                keys.append(key)
            house = np.array([hash_of("h" + x) for x in houses], np.uint64)
            m = (np.stack(keys) ^ house[None, :]).T.reshape(-1).view(np.int64)
            idx = np.repeat(np.arange(len(fulls)), BANDS)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(idx)), batch.column(1).take(pa.array(idx)), pa.array(m)], ["cls", "full", "key"])


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        c = [col.to_pylist() for col in batch.columns]
        score = [address_like(address_of(x), address_of(y)) for x, y in zip(c[2], c[3])]
        keep = pa.array([s >= SAME for s in score], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(score)], ["a", "b", "score"]).filter(keep)


def class_links(records: DataFrame) -> DataFrame:
    """(a, b, score): pairs of different canonical forms at one building. MinHash bands over tokens and 3-grams give candidates, and
    affine-gap alignment of their words verifies them. Forms without a house number make no pair."""
    classes = with_towns(records.select("cls").distinct()).where("cls not like '|%'")
    keys = materialize(classes.mapInArrow(_bands, "cls string, full string, key bigint"), "address-keys")
    shared = keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = meet_within(keys.join(shared, "key"), "key", "n", ["cls", "full"]).where("a_cls < b_cls")
    pairs = pairs.select(F.col("a_cls").alias("a"), F.col("b_cls").alias("b"), F.col("a_full").alias("fa"), F.col("b_full").alias("fb")).distinct()
    return pairs.mapInArrow(_verify, "a string, b string, score double")


def same_building_pairs(df: DataFrame, ident: str = "entity_id", address: str = "business_address") -> DataFrame:
    """(entity_id_a, entity_id_b): pairs of different ids whose addresses denote one building and differ as stored, smaller id first.

    Missing addresses (null, blank, NA, N/A, null, None) pair with nothing; nor do addresses without a house number, unless they parse
    alike. Repeated rows count once. Units, floors and landmarks don't matter; house number, street, kind of street and town do. Empty
    table: no rows. Writings that parse alike form one class; classes, not records, are compared, and ids are attached at the end."""
    records = parsed(df, ident, address)
    links = class_links(records).select("a", "b")
    entries = records.groupBy("cls", "address").agg(F.count(F.lit(1)).alias("n"))
    x = entries.select(F.col("cls").alias("a"), F.col("address").alias("wa"))
    y = entries.select(F.col("cls").alias("b"), F.col("address").alias("wb"))
    several = entries.groupBy("cls").agg(F.count(F.lit(1)).alias("k")).where("k > 1 and cls not like '|%'").select("cls")
    own = several.select(F.col("cls").alias("a"), F.col("cls").alias("b"))
    # a building with many writings, or a writing of many records, is spread over tasks
    linked = materialize(links.unionByName(own), "address-links")
    some = sampled(linked)
    met = join_split(join_split(linked, x, "a"), y, "b", look=[some.select("b"), sampled(y)])
    met = materialize(met.where("wa <> wb and (a <> b or wa < wb)").select("wa", "wb").distinct(), "address-pairs")
    ids = records.select("id", "address").distinct()
    out = join_split(met, ids.select(F.col("id").alias("ia"), F.col("address").alias("wa")), "wa")
    out = join_split(out, ids.select(F.col("id").alias("ib"), F.col("address").alias("wb")), "wb", look=[sampled(met)])
    return out.where("ia <> ib").select(F.least("ia", "ib").alias("entity_id_a"), F.greatest("ia", "ib").alias("entity_id_b")).distinct()


def address_groups(df: DataFrame, ident: str = "entity_id", address: str = "business_address") -> DataFrame:
    """(id, group_id): every id with a present address and the least canonical form of the buildings linked with its own."""
    from .components import connected_components

    records = parsed(df, ident, address)
    comp = connected_components(class_links(records), "a", "b").select(F.col("node").alias("cls"), "component")
    return records.join(comp, "cls", "left").select("id", F.coalesce("component", "cls").alias("group_id"))
