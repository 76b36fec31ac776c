"""Candidate retrieval: exact blocks, rare-token blocks and their combinations. Tokens join as rows; postings are never collected."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from .skew import join_split, sampled
from ..sources.scratch import materialize
from . import cells, frequency, hot
from .entities import tokens, union_tokens


@dataclass(frozen=True)
class BlockingConfig:
    """Cutoffs of candidate generation; the defaults are those of production scale."""

    max_token_freq: int = 500
    k_name: int = 3
    k_address: int = 3
    cap: int = 500
    top_k: int = 20
    exact_bonus: float = 1_000_000.0
    exact_blocks: bool = True


def exact_block(s1: DataFrame, tg: DataFrame, field: str) -> DataFrame:
    """(s, t): equal non-empty normal form in the same country. A null country matches nothing. A name or address that holds a third of
    the rows is spread over tasks."""
    col = f"{field}_norm"
    side = lambda d, x: d.where((F.col(col) != "") & F.col("country").isNotNull()).select(F.col("entity_id").alias(x), F.concat_ws("\u0001", "country", col).alias("_key"))
    return join_split(side(s1, "s"), side(tg, "t"), "_key").select("s", "t")


def rarest_tokens(s1: DataFrame, df: DataFrame, k_name: int, k_address: int, cutoff: int, kind=X.tokens_min1, often: DataFrame | None = None) -> DataFrame:
    """(s, country, field, token, df, rn): per reference and field the rarest tokens of the targets with df <= cutoff; ties by token."""
    known = df.where(F.col("df") <= cutoff)
    w = Window.partitionBy("entity_id", "country", "field").orderBy("df", "token")
    own = tokens(s1, kind) if often is None else tokens(s1, kind).join(F.broadcast(often), ["field", "token"], "left_anti")
    ranked = own.join(known, ["field", "token"]).withColumn("rn", F.row_number().over(w).cast("long"))
    k = F.when(F.col("field") == "name", F.lit(k_name)).otherwise(F.lit(k_address))
    return ranked.where(F.col("rn") <= k).withColumnRenamed("entity_id", "s")


def postings(tg: DataFrame, kind) -> DataFrame:
    return tokens(tg, kind).select("country", "field", "token", F.col("entity_id").alias("t"))


#: Tokens above the cutoff that are dropped before rows of tokens shuffle, the most frequent first.
DROPPED = 20_000


def rare_block(s1: DataFrame, tg: DataFrame, cfg: BlockingConfig, df: DataFrame) -> DataFrame:
    """(s, t) that share one of the reference's rarest tokens. The most frequent tokens, most of all rows, are left out before rows move;
    the join with the rarest tokens alone decides."""
    often = materialize(df.where(F.col("df") > cfg.max_token_freq).orderBy(F.desc("df"), "field", "token").limit(DROPPED).select("field", "token"), "often")
    post = postings(tg, X.tokens_min1).join(F.broadcast(often), ["field", "token"], "left_anti")
    rare = rarest_tokens(s1, df, cfg.k_name, cfg.k_address, cfg.max_token_freq, often=often)
    return rare.join(post, ["country", "field", "token"]).select("s", "t")


def frequencies(tg: DataFrame) -> DataFrame:
    """df_field, written for plans that read it several times."""
    return materialize(frequency.df_field(tg), "frequencies")


def raw_candidates(s1: DataFrame, tg: DataFrame, cfg: BlockingConfig, large: DataFrame | None = None, df: DataFrame | None = None) -> DataFrame:
    """(s, t, protected): the union of the blocks, once per pair; pairs of an exact block are protected (1). Without the pairs of the
    exact blocks in `large`, and without the rare pairs of references in those."""
    df = frequencies(tg) if df is None else df
    if large is None:
        parts = rare_block(s1, tg, cfg, df).withColumn("protected", F.lit(0))
        if cfg.exact_blocks:
            for f in ("name", "address"):
                parts = parts.unionByName(exact_block(s1, tg, f).withColumn("protected", F.lit(1)))
    else:
        inside = materialize(hot.members(s1, large).select("entity_id", F.col("_blocks._key").alias("_large")), "inside")
        parts = rare_block(s1.join(inside, "entity_id", "left_anti"), tg, cfg, df).withColumn("protected", F.lit(0))
        small = lambda d: hot.keys(d).join(large, "_key", "left_anti")
        ends = [small(d).withColumnRenamed("entity_id", x) for d, x in ((s1, "s"), (tg, "t"))]
        met = join_split(*ends, "_key", look=[small(sampled(d)) for d in (s1, tg)]).select("s", "t").distinct()
        other = materialize(hot.members(tg, large).select(F.col("entity_id").alias("t"), F.col("_blocks._key").alias("_larger")), "inside")
        met = met.join(inside.withColumnRenamed("entity_id", "s"), "s", "left").join(other, "t", "left")
        met = met.where(~F.coalesce(F.arrays_overlap("_large", "_larger"), F.lit(False))).select("s", "t")
        parts = parts.unionByName(met.withColumn("protected", F.lit(1)))
    return parts.groupBy("s", "t").agg(F.max("protected").alias("protected"))


def token_weights(s1: DataFrame, df: DataFrame) -> DataFrame:
    """(s, wn, wa): the weights 10000/df of the tokens of each reference's name and address."""
    weights = tokens(s1, X.tokens_min1).join(df, ["field", "token"]).select(
        F.col("entity_id").alias("s"), "field", "token", (F.lit(10_000.0) / F.col("df")).alias("w")
    )
    return weights.groupBy("s").agg(
        F.collect_set(F.when(F.col("field") == "name", F.struct("token", "w"))).alias("wn"),
        F.collect_set(F.when(F.col("field") == "address", F.struct("token", "w"))).alias("wa"),
    )


def lexical_score(pairs: DataFrame, s1: DataFrame, tg: DataFrame, bonus: float, more: dict | None = None, df: DataFrame | None = None) -> DataFrame:
    """Adds score: exact bonuses, 100 and 150 per shared name and address token, and 10000/df of each shared token, all tokens counting.

    A reference's tokens get their weights once, by a join before pairs are looked at; a pair then sums the weights of the tokens it
    shares in Arrow batches, without another shuffle by token. `more` names further columns over the attached records (sn, sa, sc,
    tn, ta, tc, and their counts), so that both records are attached once."""
    from .scoring import one_per_id, scored_pairs

    left, right = (one_per_id(d.select("entity_id", "name_norm", "address_norm", "country")) for d in (s1, tg))
    left = left.toDF("s", "sn", "sa", "sc").join(token_weights(s1, frequency.df_field(tg) if df is None else df), "s", "left")
    none = F.array().cast("array<struct<token:string,w:double>>")
    left = left.withColumns({c: F.array_sort(F.coalesce(c, none)) for c in ("wn", "wa")})
    right = right.toDF("t", "tn", "ta", "tc")
    both = pairs.join(right, "t").join(left, "s")  # a reference's weights are the widest, so pairs get them last
    texts = () if not more else ("sn", "sa", "sc", "tn", "ta", "tc")
    out = scored_pairs(both, pairs.columns, texts, bonus)
    return out.select(*pairs.columns, "score", *[c.alias(n) for n, c in (more or {}).items()])


def protected_cap(scored: DataFrame, cap: int) -> DataFrame:
    """Keeps all protected pairs and fills up to cap per reference with the best others; ties by target id.

    Protected pairs, of which a reference with a hot name has any number, are only counted; the rank runs over the others, and no task
    forwards more than cap of them per reference."""
    n = scored.where("protected = 1").groupBy("s").agg(F.count(F.lit(1)).alias("_np"))
    best = Window.partitionBy("s").orderBy(F.desc("score"), "t")
    rest = scored.where("protected = 0").withColumn("_rn", F.row_number().over(best)).where(F.col("_rn") <= cap).join(n, "s", "left")
    rest = rest.where(F.col("_rn") <= F.lit(cap) - F.coalesce("_np", F.lit(0))).select(*scored.columns)
    return scored.where("protected = 1").unionByName(rest)


def large_blocks(s1: DataFrame, tg: DataFrame, cfg: BlockingConfig) -> DataFrame | None:
    """Exact blocks that alone reach the cap, so that none but protected pairs are left to their references."""
    return hot.large_blocks(s1, tg, max(1, cfg.cap)) if cfg.exact_blocks else None


@dataclass(frozen=True)
class Found:
    """What is retrieved once for all that follows: the large exact blocks, the frequencies, and the pairs outside of the blocks."""

    large: DataFrame | None
    df: DataFrame
    pairs: DataFrame


def retrieve(s1: DataFrame, tg: DataFrame, cfg: BlockingConfig) -> Found:
    large, df = large_blocks(s1, tg, cfg), frequencies(tg)
    return Found(large, df, materialize(raw_candidates(s1, tg, cfg, large, df), "pairs"))


def other_candidates(s1: DataFrame, tg: DataFrame, cfg: BlockingConfig, found: Found, more: dict | None = None) -> DataFrame:
    """(s, t, protected, score) of the candidates outside the large blocks."""
    return protected_cap(materialize(lexical_score(found.pairs, s1, tg, cfg.exact_bonus, more, found.df), "scored"), cfg.cap)


def apart(s1: DataFrame, tg: DataFrame, met) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """(references and targets of one content, references for which they don't do: those with several contents and those that meet a
    target with several, as `met` of such targets tells; None if there are none)."""
    own, theirs = cells.several(s1), cells.several(tg)
    if own is None and theirs is None:
        return s1, tg, None
    ids = [] if own is None else [own]
    if theirs is not None:
        ids.append(met(tg.join(theirs, "entity_id", "left_semi")).select(F.col("s").alias("entity_id")))
        tg = tg.join(theirs, "entity_id", "left_anti")
    odd = materialize((ids[0] if len(ids) == 1 else ids[0].union(ids[1])).distinct(), "several")
    return s1.join(odd, "entity_id", "left_anti"), tg, s1.join(odd, "entity_id", "left_semi")


def candidates(s1: DataFrame, tg: DataFrame, cfg: BlockingConfig) -> DataFrame:
    """(s, t, protected, score): blocks, score and cap of production; without exact blocks the cap is a plain top list, which cells make."""
    if not cfg.exact_blocks:
        df, top = frequencies(tg), lambda d: top_k(d, cfg.cap).drop("rank")
        ones, twos, odd = apart(s1, tg, lambda t: rare_block(s1, t, cfg, df))
        out = cells.lexical(ones, twos, cfg, df, X.tokens_min1, top).select("s", "t", F.lit(0).alias("protected"), "score")
        if odd is not None:
            pairs = materialize(raw_candidates(odd, tg, cfg, None, df), "pairs")
            out = out.unionByName(other_candidates(odd, tg, cfg, Found(None, df, pairs)))
        return out
    found = retrieve(s1, tg, cfg)
    rest = other_candidates(s1, tg, cfg, found)
    if found.large is None:
        return rest
    pairs = hot.lexical(s1, tg, found.large, token_weights(s1, found.df), cfg.exact_bonus)
    return rest.unionByName(pairs.withColumn("protected", F.lit(1)).select(*rest.columns))


def candidate_counts(s1: DataFrame, tg: DataFrame, cfg: BlockingConfig, found: Found | None = None) -> DataFrame:
    """(s, n_protected, n_kept) of `candidates`, for references with any. How many others fill up to the cap needs no score."""
    large = found.large if found else large_blocks(s1, tg, cfg)
    p = F.sum("protected")
    n = (found.pairs if found else raw_candidates(s1, tg, cfg, large)).groupBy("s").agg(p.alias("n_protected"), (F.count(F.lit(1)) - p).alias("_rest"))
    n = n.select("s", "n_protected", F.least("_rest", F.greatest(F.lit(0), F.lit(cfg.cap) - F.col("n_protected"))).alias("_rest"))
    if large is not None:
        n = n.unionByName(hot.counted(s1, tg, large).select("s", F.col("n").alias("n_protected"), F.lit(0).cast("long").alias("_rest")))
        n = n.groupBy("s").agg(F.sum("n_protected").alias("n_protected"), F.sum("_rest").alias("_rest"))
    return n.select("s", "n_protected", (F.col("n_protected") + F.col("_rest")).alias("n_kept")).where("n_kept > 0")


def baseline_block(s1: DataFrame, tg: DataFrame, kind=X.tokens_stop55) -> DataFrame:
    """(s, t): any shared token within one field, same country, no cutoff. Meant for a sample of references."""
    left = tokens(s1, kind).select("country", "field", "token", F.col("entity_id").alias("s"))
    return left.join(postings(tg, kind), ["country", "field", "token"]).select("s", "t").distinct()


def ranked_union_tokens(s1: DataFrame, df: DataFrame, kind=X.tokens_stop55) -> DataFrame:
    """(s, country, token, df): tokens of both fields with their frequency in the country."""
    return union_tokens(s1, kind).join(df, ["country", "token"]).withColumnRenamed("entity_id", "s")


def rarest_union_block(s1: DataFrame, tg: DataFrame, n: int, cutoff: int, kind=X.tokens_stop55) -> DataFrame:
    """(s, t): the n rarest tokens of name and address together with df <= cutoff, met in either field."""
    w = Window.partitionBy("s", "country").orderBy("df", "token")
    rare = ranked_union_tokens(s1, frequency.df_union(tg, kind).where(F.col("df") <= cutoff), kind).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n)
    post = union_tokens(tg, kind).select("country", "token", F.col("entity_id").alias("t"))
    return rare.join(post, ["country", "token"]).select("s", "t").distinct()


def hybrid_block(s1: DataFrame, tg: DataFrame, n: int, cutoff: int, fallback: int = 100, kind=X.tokens_stop55) -> DataFrame:
    """(s, t): the rarest-token block, and the baseline block too for references with fewer than `fallback` candidates."""
    rare = rarest_union_block(s1, tg, n, cutoff, kind)
    count = rare.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    few = s1.select("*", F.col("entity_id").alias("s")).join(count, "s", "left").where(F.coalesce("n", F.lit(0)) < fallback).drop("s", "n")
    return rare.union(baseline_block(few, tg, kind)).distinct()


def _hits(s1: DataFrame, tg: DataFrame, known: DataFrame, kind) -> DataFrame:
    """(s, t, field, idf): a row per known token that two records share in one field."""
    left = tokens(s1, kind).join(known, ["country", "token"]).select("country", "field", "token", "idf", F.col("entity_id").alias("s"))
    return left.join(postings(tg, kind), ["country", "field", "token"])


def _ranked(s1: DataFrame, tg: DataFrame, known: DataFrame, k: int, kind, counted: bool, score) -> DataFrame:
    """The k best pairs of each reference, found in cells; `score` makes the pairs of hits for references whose pairs cells don't find."""
    known = materialize(known, "known")
    ones, twos, odd = apart(s1, tg, lambda t: _hits(s1, t, known, kind))
    top = lambda d: top_k(d.select("s", "t", "score"), k)
    out = cells.ranked(ones, twos, known, kind, k, counted, top)
    return out if odd is None else out.unionByName(top(score(_hits(odd, tg, known, kind))))


def idf_ranked(s1: DataFrame, tg: DataFrame, cutoff: int, k: int, kind=X.tokens_stop55) -> DataFrame:
    """(s, t, score, rank): 1.5 idf per shared name token and idf per shared address token, over tokens with df <= cutoff."""
    known = frequency.with_idf(frequency.df_union(tg, kind).where(F.col("df") <= cutoff), tg)
    w = F.when(F.col("field") == "name", F.lit(1.5)).otherwise(F.lit(1.0)) * F.col("idf")
    return _ranked(s1, tg, known, k, kind, False, lambda hits: hits.groupBy("s", "t").agg(F.round(F.sum(w), 4).alias("score")))


def count_ranked(s1: DataFrame, tg: DataFrame, cutoff: int, k: int, kind=X.tokens_stop55) -> DataFrame:
    """(s, t, score, rank): 10 and 7 per shared address and name token, idf sums of both, and 2 per token."""
    known = frequency.with_idf(frequency.df_sum(tg, kind).where(F.col("df") <= cutoff), tg)

    def score(hits: DataFrame) -> DataFrame:
        name = F.col("field") == "name"
        per = hits.groupBy("s", "t").agg(
            F.sum(F.when(name, 1).otherwise(0)).alias("nc"), F.sum(F.when(name, 0).otherwise(1)).alias("ac"),
            F.sum(F.when(name, F.col("idf")).otherwise(0.0)).alias("ni"), F.sum(F.when(name, F.lit(0.0)).otherwise(F.col("idf"))).alias("ai"),
        )
        return per.select("s", "t", F.round(F.col("ac") * 12.0 + F.col("nc") * 9.0 + F.col("ai") + F.col("ni") * 0.8, 4).alias("score"))

    return _ranked(s1, tg, known, k, kind, True, score)


def top_k(scored: DataFrame, k: int) -> DataFrame:
    """Best k per reference; ties by target id. The limit applies per task before the shuffle."""
    w = Window.partitionBy("s").orderBy(F.desc("score"), "t")
    return scored.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def cross_field_counts(s1: DataFrame, tg: DataFrame, cutoff: int, kind=X.tokens_stop30) -> DataFrame:
    """(target_source, s, n): candidates per reference when a name token may meet an address token; references without any have 0."""
    known = frequency.df_per_source(tg, kind).where(F.col("df") <= cutoff)
    both = F.array_union(kind(F.col("name_norm")), kind(F.col("address_norm")))
    post = tg.select("target_source", "country", F.explode(both).alias("token"), F.col("entity_id").alias("t")).join(known, ["target_source", "country", "token"])
    hits = union_tokens(s1, kind).join(post, ["country", "token"]).select("target_source", F.col("entity_id").alias("s"), "t").distinct()
    n = hits.groupBy("target_source", "s").agg(F.count(F.lit(1)).alias("n"))
    every = s1.select(F.col("entity_id").alias("s")).distinct().withColumn("target_source", F.explode(F.array(F.lit("S2"), F.lit("S3"))))
    return every.join(n, ["target_source", "s"], "left").select("target_source", "s", F.coalesce("n", F.lit(0)).alias("n"))
