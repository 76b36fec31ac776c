"""Cheap scores and the 17 features of a candidate pair, as column expressions."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.scratch import materialize
from . import cells, hot
from .blocking import BlockingConfig, Found, apart, frequencies, large_blocks, other_candidates, raw_candidates, retrieve, top_k

# The features in the order a model expects them.
FEATURES = [
    "country_match", "name_exact", "address_exact", "name_jaccard", "address_jaccard", "name_overlap", "address_overlap", "name_shared_tokens",
    "address_shared_tokens", "name_char_similarity", "address_char_similarity", "name_length_diff", "address_length_diff", "name_length_ratio",
    "address_length_ratio", "target_is_s2", "target_is_s3",
]


def one_per_id(df: DataFrame) -> DataFrame:
    """One record per id: the least of its contents where it has several."""
    rest = [c for c in df.columns if c != "entity_id"]
    return df.groupBy("entity_id").agg(F.min(F.struct(*rest)).alias("_r")).select("entity_id", "_r.*")


def attach(pairs: DataFrame, s1: DataFrame, tg: DataFrame, how: str = "inner") -> DataFrame:
    """Adds both records' normal forms and countries; pairs with an unknown id are dropped, or kept with nulls by how='left'."""
    left, right = (one_per_id(d.select("entity_id", "name_norm", "address_norm", "country")) for d in (s1, tg))
    left = left.select(F.col("entity_id").alias("s"), F.col("name_norm").alias("sn"), F.col("address_norm").alias("sa"), F.col("country").alias("sc"))
    right = right.select(F.col("entity_id").alias("t"), F.col("name_norm").alias("tn"), F.col("address_norm").alias("ta"), F.col("country").alias("tc"))
    return pairs.join(left, "s", how).join(right, "t", how)


def _exact(a: str, b: str):
    return ((F.col(a) == F.col(b)) & (F.col(a) != "")).cast("long")


#: Pairs whose texts a task reads at once.
KEPT_TEXTS = 50_000
COUNTS = ("shared", "fewer", "union", "chars_both", "chars_any")
COUNTED = "".join(f", {f}_{c} bigint" for f in "na" for c in COUNTS)


class Field:
    """One field of a batch of pairs: words as numbers, each different text read once. All but a few steps a batch run in numpy or Arrow."""

    def __init__(self, x: pa.Array, y: pa.Array):
        both = pa.concat_arrays([x.cast(pa.string()), y.cast(pa.string())]).dictionary_encode()
        at = both.indices.to_numpy()
        self.n, self.x, self.y, self.texts = len(x), at[: len(x)], at[len(x) :], both.dictionary
        words = pc.split_pattern(self.texts, " ")
        coded = words.flatten().dictionary_encode()
        self.words, self.base = coded.dictionary, len(coded.dictionary) + 1
        self.length = pc.utf8_length(self.words).to_numpy()
        text = np.repeat(np.arange(len(self.texts)), pc.list_value_length(words).to_numpy())
        self.keys = np.unique(text * self.base + coded.indices.to_numpy())  # a word of a text once

    def tokens(self, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each text how many words of at least `least` characters it has, and the words of all texts."""
        keys = self.keys[self.length[self.keys % self.base] >= max(1, least)]
        return np.bincount(keys // self.base, minlength=len(self.texts)), keys % self.base

    def spread(self, at: np.ndarray, size: np.ndarray, words: np.ndarray) -> np.ndarray:
        """pair * base + word, in order, of all words of the texts `at` of each pair."""
        n = size[at]
        first = np.cumsum(size) - size
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(np.arange(len(at)), n) * self.base + words[np.repeat(first[at], n) + within]

    @staticmethod
    def found(keys: np.ndarray, among: np.ndarray) -> np.ndarray:
        if not len(among):
            return np.zeros(len(keys), dtype=bool)
        return among[np.minimum(np.searchsorted(among, keys), len(among) - 1)] == keys

    def counts(self, least: int, spaces: bool) -> list[np.ndarray]:
        size, words = self.tokens(least)
        mine, theirs = (self.spread(at, size, words) for at in (self.x, self.y))
        shared = np.bincount(mine[self.found(mine, theirs)] // self.base, minlength=self.n)
        i, j, masks = size[self.x], size[self.y], self.masks(spaces)
        m, n = masks[self.x], masks[self.y]
        return [shared, np.minimum(i, j), i + j - shared, np.bitwise_count(m & n), np.bitwise_count(m | n)]

    def masks(self, spaces: bool) -> np.ndarray:
        """A bit for each character that a text has."""
        return hot.masks(self.texts, spaces)

    def exact(self) -> np.ndarray:
        return (self.x == self.y) & (pc.utf8_length(self.texts).to_numpy() > 0)[self.x]

    def weighed(self, weights: pa.ListArray, each: float) -> np.ndarray:
        """Sums of weight and `each` over the tokens shared, in the order of the reference's."""
        flat, n = weights.flatten(), pc.list_value_length(weights).to_numpy()
        code = pc.index_in(flat.field("token"), value_set=self.words).fill_null(self.base - 1).to_numpy()
        pair = np.repeat(np.arange(self.n), n)
        hit = self.found(pair * self.base + code, self.spread(self.y, *self.tokens(1)))
        w = flat.field("w").to_numpy()[hit]
        return np.bincount(np.repeat(pair[hit], 2), np.column_stack((w, np.full(len(w), each))).ravel(), minlength=self.n)


class Texts:
    """Both fields of a batch of attached pairs."""

    def __init__(self, b: pa.RecordBatch):
        self.fields = {f: Field(b.column(f"s{f}"), b.column(f"t{f}")) for f in "na"}

    def counts(self, least: int, spaces: bool) -> tuple[list[pa.Array], list[str]]:
        more = [pa.array(c, pa.int64()) for f in self.fields.values() for c in f.counts(least, spaces)]
        return more, [f"{f}_{c}" for f in self.fields for c in COUNTS]

    def lexical(self, b: pa.RecordBatch, bonus: float) -> pa.Array:
        """The lexical score: exact bonuses, then the weights of shared tokens of name and address."""
        n, a = self.fields["n"], self.fields["a"]
        total = n.exact() * bonus + a.exact() * bonus + n.weighed(b.column("wn"), 100.0) + a.weighed(b.column("wa"), 150.0)
        return pa.array(hot.half_up(total), pa.float64())


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        yield from (b.slice(i, KEPT_TEXTS) for i in range(0, b.num_rows, KEPT_TEXTS))


def _counts(least: int, spaces: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            more, names = Texts(b).counts(least, spaces)
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, *names])

    return run


def scored_pairs(both: DataFrame, keep: list[str], texts: tuple[str, ...], bonus: float) -> DataFrame:
    """`keep` and score of pairs with both records attached (sn, sa, tn, ta) and the sorted weights of the reference's tokens (wn, wa);
    with `texts` also these and the counts of with_counts. As column expressions these cost some 100 microseconds a pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts(batches):
            read, columns = Texts(b), [*keep, *texts]
            more, names = read.counts(3, True) if texts else ([], [])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in columns), read.lexical(b, bonus), *more], names=[*columns, "score", *names])

    of = dict(both.dtypes)
    schema = ", ".join(f"`{c}` {of[c]}" for c in (*keep, *texts)) + ", score double"
    return both.select(*dict.fromkeys((*keep, *texts, "s", "sn", "sa", "tn", "ta", "wn", "wa"))).mapInArrow(run, schema + COUNTED * bool(texts))


def with_counts(p: DataFrame, least: int = 3, spaces: bool = True) -> DataFrame:
    """Attached records with what both normal forms have: of the tokens of at least `least` characters how many are shared, in the shorter
    set and in any, and of the characters how many are in both and in any. Each text is read once a batch, not once a pair; as
    column expressions over a pair these cost some 100 microseconds."""
    return p.mapInArrow(_counts(least, spaces), ", ".join(f"`{n}` {t}" for n, t in p.dtypes) + COUNTED)


def _overlap(f: str) -> Column:
    return F.col(f"{f}_shared") / F.greatest(F.lit(1), F.col(f"{f}_fewer"))


def _share(part: str, of: str, none: float = 0.0) -> Column:
    return F.when(F.col(of) == 0, F.lit(none)).otherwise(F.col(part) / F.col(of)).cast("double")


def cheap_columns() -> dict[str, Column]:
    """Columns of the cheap score over attached records with their counts."""
    ns, as_ = F.col("n_shared"), F.col("a_shared")
    nc, ac = (_share(f"{f}_chars_both", f"{f}_chars_any") for f in "na")
    nx, ax = _exact("sn", "tn"), _exact("sa", "ta")
    score = (
        nx * 100.0 + ax * 100.0 + _overlap("n") * 30.0 + _overlap("a") * 40.0 + F.least(ns, F.lit(5)) * 8.0 + F.least(as_, F.lit(5)) * 10.0
        + nc * 5.0 + ac * 5.0
    )
    return {
        "same_country": F.coalesce(F.col("sc") == F.col("tc"), F.lit(False)), "name_exact": nx, "address_exact": ax, "name_shared": ns.cast("long"),
        "address_shared": as_.cast("long"), "cheap": F.round(score, 4),
    }


def cheap_score(pairs: DataFrame, s1: DataFrame, tg: DataFrame) -> DataFrame:
    """(s, t, name_exact, address_exact, name_shared, address_shared, score) of same-country pairs."""
    p = with_counts(attach(pairs.select("s", "t"), s1, tg))
    return cheap_scored(p.select("s", "t", *[c.alias(n) for n, c in cheap_columns().items()]))


def cheap_scored(p: DataFrame) -> DataFrame:
    return p.where("same_country").select("s", "t", "name_exact", "address_exact", "name_shared", "address_shared", F.col("cheap").alias("score"))


def cheap_candidates(s1: DataFrame, tg: DataFrame, cfg: BlockingConfig) -> DataFrame:
    """cheap_score of all candidates."""
    found = retrieve(s1, tg, cfg)
    rest = cheap_scored(other_candidates(s1, tg, cfg, found, cheap_columns()))
    return rest if found.large is None else rest.unionByName(hot.cheap(s1, tg, found.large))


def stage1_candidates(s1: DataFrame, tg: DataFrame, cfg: BlockingConfig, found: Found | None = None) -> DataFrame:
    """stage1 of all candidates. Large exact blocks pass on their best pairs only, as stage 1 would rank them, and so do the cells in which
    the other pairs meet, but for references with several contents or a candidate with several, whose pairs are made one by one; `found`
    has all pairs already."""
    if found is not None:
        large, rest = found.large, cheap_scored(other_candidates(s1, tg, cfg, found, cheap_columns()))
    else:
        large, df = large_blocks(s1, tg, cfg), frequencies(tg)
        ones, twos, odd = apart(s1, tg, lambda t: raw_candidates(s1, t, cfg, None, df))
        rest = cells.stage1(ones, twos, cfg, df, large, X.tokens_min1)
        if odd is not None:
            found = Found(large, df, materialize(raw_candidates(odd, tg, cfg, large, df), "pairs"))
            rest = rest.unionByName(cheap_scored(other_candidates(odd, tg, cfg, found, cheap_columns())).where(KEEP).select("s", "t", "score"))
    rest = rest.where(KEEP).select("s", "t", "score") if "name_exact" in rest.columns else rest
    if large is not None:
        hottest = cheap_score(hot.top(s1, tg, large, cfg.top_k), s1, tg).where(KEEP).select("s", "t", "score")
        rest = rest.unionByName(hottest).groupBy("s", "t").agg(F.max("score").alias("score"))  # a pair of a large and a small block is in both
    return top_k(rest, cfg.top_k)


def stage1(pairs: DataFrame, s1: DataFrame, tg: DataFrame, k: int = 20) -> DataFrame:
    """(s, t, score, rank): pairs worth a model, at most k per reference. The k best are found per task first. Pairs that carry the
    columns of the cheap score already aren't attached again."""
    scored = cheap_scored(pairs) if "cheap" in pairs.columns else cheap_score(pairs, s1, tg)
    return best(scored, k)


#: The pairs worth a model.
KEEP = "name_exact = 1 or address_exact = 1 or name_shared >= 2 or address_shared >= 2 or score >= 30"


def best(scored: DataFrame, k: int) -> DataFrame:
    """The keep rule and the top list over cheap scores."""
    return top_k(scored.where(KEEP).select("s", "t", "score"), k)


def features(pairs: DataFrame, s1: DataFrame, tg: DataFrame, mode: str = "serving") -> DataFrame:
    """pairs with the 17 features. 'training' keeps tokens of any length, leaves spaces out of characters and takes two empty token sets
    for equal, as the training of the model did; 'serving' scores as production does. The two differ on purpose."""
    training = mode == "training"
    p = with_counts(attach(pairs, s1, tg), 1 if training else 3, not training)
    both = 1.0 if training else 0.0
    out = {"country_match": F.coalesce(F.col("sc") == F.col("tc"), F.lit(False)).cast("long")}
    for f in ("name", "address"):
        x = f[0]
        a, b, shared = f"s{x}", f"t{x}", F.col(f"{x}_shared")
        out |= {
            f"{f}_exact": _exact(a, b),
            f"{f}_jaccard": F.round(_share(f"{x}_shared", f"{x}_union", both), 6),
            f"{f}_overlap": F.round(_overlap(x).cast("double"), 6),
            f"{f}_shared_tokens": shared.cast("long"),
            f"{f}_char_similarity": F.round(_share(f"{x}_chars_both", f"{x}_chars_any"), 6),
            f"{f}_length_diff": F.abs(F.length(a) - F.length(b)).cast("long"),
            f"{f}_length_ratio": F.round(X.length_ratio(F.col(a), F.col(b)).cast("double"), 6),
        }
    out |= {"target_is_s2": F.col("t").startswith("S2").cast("long"), "target_is_s3": F.col("t").startswith("S3").cast("long")}
    return p.select(*pairs.columns, *[out[n].alias(n) for n in FEATURES])


def features_of_all(s1: DataFrame, tg: DataFrame) -> DataFrame:
    """(s, t) and the 17 serving features of every pair that the keep rule takes, of all references and targets of a country: no frequency,
    number of tokens, cap or rank leaves any out. An id with several contents is read as the least of them."""
    ends = (one_per_id(d.select("entity_id", "name_norm", "address_norm", "country")) for d in (s1, tg))
    return cells.features(*ends, FEATURES)
