"""Pairs of exact blocks that hold very many targets, such as those of a name that a tenth of all records share.

Such a block has its references times its targets as pairs. They are neither shuffled nor written as pairs: references and targets of a
block meet in cells, and a cell looks at all pairs of a reference at once through an index of its targets' tokens."""
from __future__ import annotations

from collections.abc import Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrow import listed
from ..sources.scratch import default_parallelism, materialize
from .skew import join_split

#: References and targets that meet in one cell.
CELL_REFERENCES, CELL_TARGETS = 500, 20_000
#: Pairs that a cell of a list passes on at once.
PAIRS_AT_ONCE = 20_000
CHARACTERS = {c: 1 << i for i, c in enumerate(" 0123456789abcdefghijklmnopqrstuvwxyz")}
LEXICAL, CHEAP = "s string, t string, score double", "s string, t string, name_exact bigint, address_exact bigint, name_shared bigint, address_shared bigint, score double"


def keys(df: DataFrame) -> DataFrame:
    """(entity_id, _key): the exact blocks of each record, one for its name and one for its address; repeated for an id with several
    contents that share one."""
    key = lambda f: F.when((F.col(f"{f}_norm") != "") & F.col("country").isNotNull(), F.concat_ws("\u0001", F.lit(f), "country", f"{f}_norm"))
    return df.select("entity_id", F.explode(F.array_compact(F.array(key("name"), key("address")))).alias("_key"))


def large_blocks(s1: DataFrame, tg: DataFrame, least: int) -> DataFrame | None:
    """(_key, _ns, _nt): blocks of at least `least` different targets and any reference, with the numbers of both; None if there are
    none. Hashes are counted first, so that few keys are moved."""
    hashed = lambda d: keys(d).withColumn("_h", F.xxhash64("_key"))
    often = materialize(hashed(tg).groupBy("_h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).select("_h"), "blocks")
    n = lambda d, c: hashed(d).join(often, "_h", "left_semi").select("entity_id", "_key").distinct().groupBy("_key").agg(F.count(F.lit(1)).alias(c))
    blocks = materialize(n(tg, "_nt").where(F.col("_nt") >= least).join(n(s1, "_ns"), "_key"), "blocks")
    return blocks if blocks.head() else None


def members(df: DataFrame, blocks: DataFrame) -> DataFrame:
    """(entity_id, _blocks): the large blocks of each record that is in any."""
    own = join_split(keys(df), blocks, "_key", unique=True)
    return own.groupBy("entity_id").agg(F.collect_set(F.struct("_key", "_ns", "_nt")).alias("_blocks"))


class Side:
    """Distinct values of one field of a cell's targets, indexed by token."""

    def __init__(self, values: list[str]):
        at: dict[str, int] = {}
        self.code = np.array([at.setdefault(v, len(at)) for v in values], dtype=np.int64)
        self.values = at
        found: dict[str, list[int]] = {}
        for v, i in at.items():
            for x in dict.fromkeys(v.split()):
                found.setdefault(x, []).append(i)
        self.postings = {x: np.array(p, dtype=np.int64) for x, p in found.items()}
        self.size = np.array([long_tokens(v) for v in at], dtype=np.int64)
        self.mask = np.array([mask(v) for v in at], dtype=np.uint64)

    def spread(self, per_value: np.ndarray) -> np.ndarray:
        return per_value[self.code]

    def exact(self, x: str) -> np.ndarray:
        out = np.zeros(len(self.values), dtype=np.int64)
        if x and x in self.values:
            out[self.values[x]] = 1
        return out

    def cheap(self, x: str) -> tuple[np.ndarray, ...]:
        """(exact, tokens shared, overlap, similarity of characters), as in scoring.cheap_columns."""
        shared = np.zeros(len(self.values), dtype=np.int64)
        for w in dict.fromkeys(x.split()):
            if len(w) >= 3 and w in self.postings:
                shared[self.postings[w]] += 1
        overlap = shared / np.maximum(1, np.minimum(long_tokens(x), self.size))
        m = np.uint64(mask(x))
        union = np.bitwise_count(self.mask | m).astype(np.int64)
        alike = np.where(union == 0, 0.0, np.bitwise_count(self.mask & m) / np.maximum(union, 1))
        return tuple(self.spread(a) for a in (self.exact(x), shared, overlap, alike))

    def weighed(self, weights: list[dict] | None, each: float) -> np.ndarray:
        """Sum of the weights of shared tokens, in the order of blocking.lexical_score."""
        out = np.zeros(len(self.values))
        for w in sorted(weights or [], key=lambda w: (w["token"], w["w"])):
            p = self.postings.get(w["token"])
            if p is not None:
                out[p] = out[p] + w["w"] + each
        return self.spread(out)


def long_tokens(v: str) -> int:
    return sum(len(x) >= 3 for x in set(v.split()))


def mask(v: str) -> int:
    return sum(CHARACTERS[c] for c in set(v))


def masks(texts: pa.StringArray, spaces: bool = True) -> np.ndarray:
    """`mask` of many texts, with or without their spaces."""
    bit = np.zeros(256, dtype=np.uint64)
    for c, b in CHARACTERS.items():
        bit[ord(c)] = b if spaces or c != " " else 0
    out, (_, ends, data) = np.zeros(len(texts), dtype=np.uint64), texts.buffers()
    ends = np.frombuffer(ends, dtype=np.int32)[texts.offset :][: len(texts) + 1]
    some = np.flatnonzero(np.diff(ends) > 0)
    if len(some):
        out[some] = np.bitwise_or.reduceat(bit[np.frombuffer(data, dtype=np.uint8)[: ends[-1]]], ends[:-1][some])
    return out


def half_up(x: np.ndarray, places: int = 4) -> np.ndarray:
    """Rounded as F.round does it: halves of the decimal form go up."""
    v = x * 10.0**places + 0.5
    q = np.floor(v)
    near = np.abs(v - np.rint(v)) < 1e-5
    if near.any():
        values, back = np.unique(x[near], return_inverse=True)
        q[near] = np.array([float(Decimal(repr(float(a))).quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP).scaleb(places)) for a in values])[back]
    return q / 10.0**places


def _cell(kind: str, bonus: float = 0.0, k: int = 0):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        is_target = np.asarray(rows.column("_target").to_numpy())
        refs, tgs = (rows.filter(pa.array(x)) for x in (~is_target, is_target))
        if not refs.num_rows or not tgs.num_rows:
            return
        key = rows.column("_key")[0].as_py()
        tgs = tgs.sort_by("entity_id")
        ids, others = tgs.column("entity_id").combine_chunks(), tgs.column("_others")
        others = [None] * len(others) if others.null_count == len(others) else others.to_pylist()
        several = [j for j, x in enumerate(others) if x]
        name, address = (Side(listed(tgs.column(c))) for c in ("name_norm", "address_norm")) if kind != "count" else (None, None)
        country = tgs.column("country").to_numpy(zero_copy_only=False)
        n = len(ids)
        for r in refs.to_pylist():
            here = None
            if r["_others"] and several:  # a pair that shares several large blocks belongs to the least of them
                here = np.ones(n, dtype=bool)
                here[[j for j in several if min(set(others[j]) & set(r["_others"])) != key]] = False
            if kind == "count":
                m = int(here.sum()) if here is not None else n
                yield pa.record_batch([pa.array([r["entity_id"]]), pa.array([m], pa.int64())], names=["s", "n"])
                continue
            if kind == "lexical":
                x = (name.spread(name.exact(r["name_norm"])) * bonus + address.spread(address.exact(r["address_norm"])) * bonus
                     + name.weighed(r["wn"], 100.0) + address.weighed(r["wa"], 150.0))
                out = [half_up(x)]
            else:
                (nx, ns, no, nc), (ax, as_, ao, ac) = name.cheap(r["name_norm"]), address.cheap(r["address_norm"])
                x = nx * 100.0 + ax * 100.0 + no * 30.0 + ao * 40.0 + np.minimum(ns, 5) * 8.0 + np.minimum(as_, 5) * 10.0 + nc * 5.0 + ac * 5.0
                same = country == r["country"] if r["country"] is not None else np.zeros(n, dtype=bool)
                here = same if here is None else here & same
                if kind == "top":
                    worth = (nx == 1) | (ax == 1) | (ns >= 2) | (as_ >= 2) | (x >= 29.99995)  # 30 when rounded
                    at = np.flatnonzero(here & worth)
                    if len(at) > k:
                        least = np.partition(x[at], len(at) - k)[len(at) - k]
                        at = at[x[at] >= least - 1e-3]
                    at = at[np.argsort(-half_up(x[at]), kind="stable")[:k]]
                    yield pa.record_batch([pa.array([r["entity_id"]] * len(at), pa.string()), ids.take(pa.array(at))], names=["s", "t"])
                    continue
                out = [nx, ax, ns, as_, half_up(x)]
            at = None if here is None or here.all() else np.flatnonzero(here)
            t, out = (ids, out) if at is None else (ids.take(pa.array(at)), [a[at] for a in out])
            s = pa.array([r["entity_id"]], pa.string()).take(pa.array(np.zeros(len(t), dtype=np.int64)))
            batch = pa.record_batch([s, t, *map(pa.array, out)], names=[f.split()[0] for f in (LEXICAL if kind == "lexical" else CHEAP).split(", ")])
            for i in range(0, len(t), PAIRS_AT_ONCE):
                yield batch.slice(i, PAIRS_AT_ONCE)

    return run


def _met(s1: DataFrame, tg: DataFrame, blocks: DataFrame, run, schema: str, weights: DataFrame | None = None) -> DataFrame:
    """Rows that `run` makes of the cells of large blocks. Records are read as their least contents, as scores do."""
    from .scoring import one_per_id

    of = "array<struct<token:string,w:double>>"
    cells_s, cells_t = (F.ceil(F.col(c) / F.lit(n)).cast("int") for c, n in (("_ns", CELL_REFERENCES), ("_nt", CELL_TARGETS)))

    def side(df: DataFrame, target: bool) -> DataFrame:
        own = members(df, blocks)
        d = one_per_id(df.select("entity_id", "name_norm", "address_norm", "country").join(own.select("entity_id"), "entity_id", "left_semi")).join(own, "entity_id")
        if weights is not None and not target:
            d = d.join(weights.withColumnRenamed("s", "entity_id"), "entity_id", "left")
        else:
            d = d.withColumns({"wn": F.lit(None).cast(of), "wa": F.lit(None).cast(of)})
        d = d.withColumn("_others", F.when(F.size("_blocks") > 1, F.col("_blocks._key"))).select("*", F.inline("_blocks")).drop("_blocks")
        mine, theirs = (cells_t, cells_s) if target else (cells_s, cells_t)
        own, every = F.pmod(F.xxhash64("entity_id"), mine).cast("int"), F.explode(F.sequence(F.lit(0), theirs - 1))
        i, j = (every, own) if target else (own, every)
        cols = ("_key", "entity_id", "name_norm", "address_norm", "country", "_others", "wn", "wa")
        return d.select(F.lit(target).alias("_target"), *cols, i.alias("_i"), j.alias("_j"))

    cells = blocks.agg(F.sum(cells_s.cast("long") * cells_t)).head()[0]
    n = max(default_parallelism(s1.sparkSession), min(2_000, cells))
    both = side(s1, False).unionByName(side(tg, True)).repartition(n, "_key", "_i", "_j")
    return both.groupBy("_key", "_i", "_j").applyInArrow(run, schema)


def counted(s1: DataFrame, tg: DataFrame, blocks: DataFrame) -> DataFrame:
    """(s, n): pairs of each reference in large blocks, without making them or looking at them.

    A reference in one block has as many pairs as the block has targets; one in two blocks has those of both, less the targets that are
    in both. Only references in three and more, ids with several contents, meet their targets in cells."""
    mine = materialize(members(s1, blocks).select("entity_id", F.array_sort("_blocks").alias("_blocks")), "inside")
    few, many = mine.where(F.size("_blocks") <= 2), mine.where(F.size("_blocks") > 2)
    each = few.select(F.col("entity_id").alias("s"), F.aggregate("_blocks", F.lit(0).cast("long"), lambda n, b: n + b["_nt"]).alias("n"))
    pair = lambda a, b: F.concat_ws("\u0002", a["_key"], b["_key"])
    own = F.col("_blocks")
    doubles = few.where(F.size("_blocks") == 2).select(F.col("entity_id").alias("s"), pair(own[0], own[1]).alias("_pair"))
    twos = F.flatten(F.transform(own, lambda b, i: F.transform(F.slice(own, F.lit(1), i), lambda a: pair(a, b))))
    shared = members(tg, blocks).where(F.size("_blocks") > 1).select(F.array_sort("_blocks").alias("_blocks")).select(F.explode(twos).alias("_pair"))
    shared = shared.groupBy("_pair").agg(F.count(F.lit(1)).alias("n"))
    n = each.unionByName(join_split(doubles, shared, "_pair", unique=True).select("s", (-F.col("n")).alias("n")))
    if many.head():
        refs = s1.join(many.select("entity_id"), "entity_id", "left_semi")
        theirs = blocks.join(many.select(F.explode("_blocks._key").alias("_key")).distinct(), "_key", "left_semi")
        n = n.unionByName(_met(refs, tg, theirs, _cell("count"), "s string, n bigint"))
    return n.groupBy("s").agg(F.sum("n").alias("n"))


def lexical(s1: DataFrame, tg: DataFrame, blocks: DataFrame, weights: DataFrame, bonus: float) -> DataFrame:
    """(s, t, score) of every pair of large blocks."""
    return _met(s1, tg, blocks, _cell("lexical", bonus), LEXICAL, weights)


def cheap(s1: DataFrame, tg: DataFrame, blocks: DataFrame) -> DataFrame:
    """(s, t, name_exact, address_exact, name_shared, address_shared, score) of every same-country pair of large blocks."""
    return _met(s1, tg, blocks, _cell("cheap"), CHEAP)


def top(s1: DataFrame, tg: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """(s, t): of each reference at least the k pairs of large blocks that stage 1 ranks first among those."""
    return _met(s1, tg, blocks, _cell("top", k=k), "s string, t string").distinct()
