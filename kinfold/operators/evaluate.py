"""How well blocking strategies keep true pairs, and how many candidates they make."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as X
from . import blocking, frequency
from .scoring import attach

QUANTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def true_pairs(truth: DataFrame, s1: DataFrame, tg: DataFrame, how: str = "inner") -> DataFrame:
    """True pairs with both records. how='left' keeps pairs that name an unknown id, which are misses of any block; 'inner' leaves them
    to `dangling`."""
    return attach(truth.select(F.col("source1_entity_id").alias("s"), F.col("target_entity_id").alias("t")), s1, tg, how)


def dangling(truth: DataFrame, s1: DataFrame, tg: DataFrame) -> DataFrame:
    """(source1_entity_id, target_entity_id, missing): true pairs of which a record is in no source; missing is reference, target or both."""
    known = lambda d, c: d.select(F.col("entity_id").alias(c), F.lit(True).alias("_" + c)).distinct()
    j = truth.join(known(s1, "source1_entity_id"), "source1_entity_id", "left").join(known(tg, "target_entity_id"), "target_entity_id", "left")
    no_s, no_t = F.col("_source1_entity_id").isNull(), F.col("_target_entity_id").isNull()
    missing = F.when(no_s & no_t, "both").when(no_s, "reference").when(no_t, "target")
    return j.where(missing.isNotNull()).select("source1_entity_id", "target_entity_id", missing.alias("missing"))


def distribution(df: DataFrame, column: str, more: dict[str, float] | None = None) -> list[Column]:
    qs = [F.round(F.percentile(column, F.lit(q)), 4).alias(n) for n, q in (QUANTILES | (more or {})).items()]
    return [F.round(F.avg(column), 4).alias("mean"), *qs, F.max(column).alias("max")]


def rate(c: Column) -> Column:
    return F.round(F.avg(F.coalesce(c, F.lit(False)).cast("double")), 6)


def recall_exact(pairs: DataFrame) -> DataFrame:
    """(source, n_pairs, name, address, either) of exact blocks, per target source and in total."""
    same = F.col("sc") == F.col("tc")
    n = same & (F.col("sn") == F.col("tn")) & (F.col("sn") != "")
    a = same & (F.col("sa") == F.col("ta")) & (F.col("sa") != "")
    flags = pairs.select(F.substring("t", 1, 2).alias("source"), F.coalesce(n, F.lit(False)).alias("n"), F.coalesce(a, F.lit(False)).alias("a"))
    both = flags.unionByName(flags.withColumn("source", F.lit("all")))
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("n_pairs"), rate(F.col("n")).alias("name"), rate(F.col("a")).alias("address"), rate(F.col("n") | F.col("a")).alias("either"))


def recall_shared_token(pairs: DataFrame) -> DataFrame:
    same = F.coalesce(F.col("sc") == F.col("tc"), F.lit(False))
    n = same & F.arrays_overlap(X.tokens_stop30(F.col("sn")), X.tokens_stop30(F.col("tn")))
    a = same & F.arrays_overlap(X.tokens_stop30(F.col("sa")), X.tokens_stop30(F.col("ta")))
    flags = pairs.select(F.substring("t", 1, 2).alias("source"), n.alias("n"), a.alias("a"))
    both = flags.unionByName(flags.withColumn("source", F.lit("all")))
    return both.groupBy("source").agg(F.count(F.lit(1)).alias("n_pairs"), rate(F.col("n")).alias("name"), rate(F.col("a")).alias("address"), rate(F.col("n") | F.col("a")).alias("either"))


def _least_df(pairs: DataFrame, df: DataFrame, kind) -> DataFrame:
    """(s, t, field, least): the rarest shared token of each field; pairs without a shared token are missing."""
    parts = [
        pairs.select("s", "t", F.col("sc").alias("country"), F.lit(f).alias("field"), F.explode(F.array_intersect(kind(F.col(a)), kind(F.col(b)))).alias("token"))
        for f, a, b in (("name", "sn", "tn"), ("address", "sa", "ta"))
    ]
    return parts[0].unionByName(parts[1]).join(df, ["country", "field", "token"]).groupBy("s", "t", "field").agg(F.min("df").alias("least"))


def _by_cutoff(base: DataFrame, least: DataFrame, cutoffs: list[int]) -> DataFrame:
    """One row per cutoff: (cutoff, name, address, either) as shares of base."""
    wide = least.groupBy("s", "t").agg(
        F.min(F.when(F.col("field") == "name", F.col("least"))).alias("n"), F.min(F.when(F.col("field") == "address", F.col("least"))).alias("a")
    )
    j = base.select("s", "t").join(wide, ["s", "t"], "left").withColumn("cutoff", F.explode(F.array(*[F.lit(c).cast("long") for c in cutoffs])))
    ok = lambda c: F.col(c) <= F.col("cutoff")
    return j.groupBy("cutoff").agg(
        F.count(F.lit(1)).alias("n_pairs"), rate(ok("n")).alias("name"), rate(ok("a")).alias("address"),
        rate(F.coalesce(ok("n"), F.lit(False)) | F.coalesce(ok("a"), F.lit(False))).alias("either"),
    )


def recall_rare_cutoff(pairs: DataFrame, tg: DataFrame, cutoffs: list[int], same_country: bool = True) -> DataFrame:
    """Share of true pairs whose rarest shared token has a frequency up to each cutoff; over same-country pairs, or over all."""
    base = pairs.where("sc = tc") if same_country else pairs
    kind = X.tokens_stop30
    return _by_cutoff(base, _least_df(base, frequency.df_country_field(tg, kind), kind), cutoffs)


def recall_shared_count(pairs: DataFrame, most: int = 5) -> DataFrame:
    n = F.size(F.array_intersect(X.tokens_stop55(F.col("sn")), X.tokens_stop55(F.col("tn"))))
    a = F.size(F.array_intersect(X.tokens_stop55(F.col("sa")), X.tokens_stop55(F.col("ta"))))
    p = pairs.select(n.alias("n"), a.alias("a")).withColumn("threshold", F.explode(F.array(*[F.lit(i).cast("long") for i in range(1, most + 1)])))
    ok = lambda c: F.col(c) >= F.col("threshold")
    return p.groupBy("threshold").agg(rate(ok("n")).alias("name"), rate(ok("a")).alias("address"), rate(ok("n") | ok("a")).alias("either"))


def recall_numbers(pairs: DataFrame, tg: DataFrame, cutoffs: list[int]) -> DataFrame:
    shared = pairs.select("s", "t", F.col("sc").alias("country"), F.explode(F.array_intersect(X.number_runs(F.col("sa")), X.number_runs(F.col("ta")))).alias("token"))
    least = shared.join(frequency.df_numbers(tg), ["country", "token"]).groupBy("s", "t").agg(F.min("df").alias("least"))
    j = pairs.select("s", "t").join(least, ["s", "t"], "left").withColumn("cutoff", F.explode(F.array(*[F.lit(c).cast("long") for c in cutoffs])))
    return j.groupBy("cutoff").agg(F.count(F.lit(1)).alias("n_pairs"), rate(F.col("least") <= F.col("cutoff")).alias("recall"))


def _union_shared(pairs: DataFrame):
    u = lambda n, a: F.array_union(X.tokens_stop55(F.col(n)), X.tokens_stop55(F.col(a)))
    return F.array_intersect(u("sn", "sa"), u("tn", "ta"))


def recall_hybrid_rule(pairs: DataFrame, tg: DataFrame, cutoffs: list[int]) -> DataFrame:
    """Rarest shared token of both fields together up to the cutoff, or two shared tokens."""
    p = pairs.select("s", "t", F.col("sc").alias("country"), _union_shared(pairs).alias("shared"))
    least = p.select("s", "t", "country", F.explode("shared").alias("token")).join(frequency.df_union(tg), ["country", "token"]).groupBy("s", "t").agg(F.min("df").alias("least"))
    j = p.select("s", "t", F.size("shared").alias("k")).join(least, ["s", "t"], "left")
    j = j.withColumn("cutoff", F.explode(F.array(*[F.lit(c).cast("long") for c in cutoffs])))
    ok = F.coalesce(F.col("least") <= F.col("cutoff"), F.lit(False)) | (F.col("k") >= 2)
    return j.groupBy("cutoff").agg(F.count(F.lit(1)).alias("n_pairs"), rate(ok).alias("recall"))


def weighted_scores(pairs: DataFrame, tg: DataFrame) -> DataFrame:
    """(s, t, score): 1.5 idf per shared name token and idf per shared address token; a token without a frequency weighs 1."""
    known = frequency.with_idf(frequency.df_union(tg), tg).select("country", "token", "idf")
    parts = [
        pairs.select("s", "t", F.col("sc").alias("country"), F.lit(w).alias("w"), F.explode(F.array_intersect(X.tokens_stop55(F.col(a)), X.tokens_stop55(F.col(b)))).alias("token"))
        for w, a, b in ((1.5, "sn", "tn"), (1.0, "sa", "ta"))
    ]
    hits = parts[0].unionByName(parts[1]).join(known, ["country", "token"], "left")
    per = hits.groupBy("s", "t").agg(F.sum(F.col("w") * F.coalesce("idf", F.lit(1.0))).alias("score"))
    return pairs.select("s", "t").join(per, ["s", "t"], "left").select("s", "t", F.round(F.coalesce("score", F.lit(0.0)), 4).alias("score"))


def similarity_profile(pairs: DataFrame) -> DataFrame:
    """Rates and describe() of true pairs; one that names an unknown id has empty fields on that side."""
    pairs = pairs.na.fill("", ["sn", "sa", "tn", "ta"])
    n, a = X.jaccard(X.tokens_min1(F.col("sn")), X.tokens_min1(F.col("tn"))), X.jaccard(X.tokens_min1(F.col("sa")), X.tokens_min1(F.col("ta")))
    p = pairs.select(
        ((F.col("sn") == F.col("tn")) & (F.col("sn") != "")).alias("nx"), ((F.col("sa") == F.col("ta")) & (F.col("sa") != "")).alias("ax"),
        F.coalesce(F.col("sc") == F.col("tc"), F.lit(False)).alias("cx"), n.alias("nj"), a.alias("aj"),
    )
    stats = [f(c, l) for c, l in (("nj", "name_jaccard"), ("aj", "address_jaccard")) for f in (
        lambda c, l: F.round(F.avg(c), 6).alias(l + "_mean"), lambda c, l: F.round(F.stddev_samp(c), 6).alias(l + "_std"),
        lambda c, l: F.round(F.min(c), 6).alias(l + "_min"), lambda c, l: F.round(F.percentile(c, F.lit(0.25)), 6).alias(l + "_p25"),
        lambda c, l: F.round(F.percentile(c, F.lit(0.5)), 6).alias(l + "_median"), lambda c, l: F.round(F.percentile(c, F.lit(0.75)), 6).alias(l + "_p75"),
        lambda c, l: F.round(F.max(c), 6).alias(l + "_max"),
    )]
    return p.agg(F.count(F.lit(1)).alias("n_pairs"), rate(F.col("nx")).alias("name_exact"), rate(F.col("ax")).alias("address_exact"), rate(F.col("cx")).alias("country_match"), rate(F.col("nx") & F.col("ax")).alias("both_exact"), *stats)


def method_row(method: str, sample: DataFrame, truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """(method, recall, mean, median, p95, p99, max) of one retrieval over a sample of references; those without candidates count too."""
    few = truth.join(sample.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_semi")
    t = few.select(F.col("source1_entity_id").alias("s"), F.col("target_entity_id").alias("t"))
    hits = t.join(candidates, ["s", "t"], "left_semi").agg(F.count(F.lit(1)).alias("h"))
    n = t.agg(F.count(F.lit(1)).alias("n"))
    per = candidates.groupBy("s").agg(F.count(F.lit(1)).alias("k"))
    k = sample.select(F.col("entity_id").alias("s")).join(per, "s", "left").select(F.coalesce("k", F.lit(0)).alias("k"))
    stats = k.agg(
        F.round(F.avg("k"), 4).alias("mean"), *[F.round(F.percentile("k", F.lit(QUANTILES[q])), 4).alias(q) for q in ("median", "p95", "p99")], F.max("k").alias("max")
    )
    recall = F.round(100.0 * F.col("h") / F.nullif(F.col("n"), F.lit(0)), 4)
    return stats.join(F.broadcast(hits)).join(F.broadcast(n)).select(F.lit(method).alias("method"), recall.alias("recall"), "mean", "median", "p95", "p99", "max")


def sweep(sample: DataFrame, tg: DataFrame, truth: DataFrame, cutoffs: list[int], ns: list[int], hybrid: bool, fallback: int = 100) -> DataFrame:
    """One row per method (see `method_row`): rarest tokens for every cutoff and n, and with `hybrid` the baseline and the fallback
    variants too.

    Tokens are ranked once, as those up to a cutoff are the first of the ranking. A candidate pair carries a bit for each cutoff and n
    that retrieves it and one for the baseline; sums per reference give the size of every candidate set and its hits."""
    grid = [(c, n) for c in cutoffs for n in ns]
    known = frequency.df_union(tg, X.tokens_stop55).where(F.col("df") <= max(cutoffs))
    w = Window.partitionBy("s", "country").orderBy("df", "token")
    rare = blocking.ranked_union_tokens(sample, known).withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= max(ns))
    post = blocking.union_tokens(tg, X.tokens_stop55).select("country", "token", F.col("entity_id").alias("t"))
    bits = sum((F.when((F.col("df") <= c) & (F.col("rn") <= n), F.lit(1 << k)).otherwise(F.lit(0)) for k, (c, n) in enumerate(grid)), F.lit(0))
    met = rare.join(post, ["country", "token"]).select("s", "t", bits.cast("long").alias("m"), F.lit(0).alias("b"))
    if hybrid:
        met = met.unionByName(blocking.baseline_block(sample, tg).select("s", "t", F.lit(0).cast("long").alias("m"), F.lit(1).alias("b")))
    pairs = met.groupBy("s", "t").agg(F.bit_or("m").alias("m"), F.max("b").alias("b"))
    true = truth.select(F.col("source1_entity_id").alias("s"), F.col("target_entity_id").alias("t"), F.lit(1).alias("y"))
    pairs = pairs.join(true, ["s", "t"], "left").withColumn("y", F.coalesce("y", F.lit(0)))
    bit = lambda k: F.getbit("m", F.lit(k)).cast("long")
    sums = [F.sum("b").alias("bn"), F.sum(F.col("b") * F.col("y")).alias("bh")]
    for k in range(len(grid)):
        sums += [F.sum(bit(k)).alias(f"n{k}"), F.sum(bit(k) * F.col("y")).alias(f"h{k}")]
        sums += [F.sum(F.greatest(bit(k), F.col("b"))).alias(f"u{k}"), F.sum(F.greatest(bit(k), F.col("b")) * F.col("y")).alias(f"v{k}")]
    per = sample.select(F.col("entity_id").alias("s")).join(pairs.groupBy("s").agg(*sums), "s", "left").na.fill(0)
    cell = lambda name, n, h: F.struct(F.lit(name).alias("method"), n.cast("long").alias("k"), h.cast("long").alias("h"))
    cells = [cell("BASELINE", F.col("bn"), F.col("bh"))] if hybrid else []
    for k, (c, n) in enumerate(grid):
        cells.append(cell(f"RAREST / {c} / {n}", F.col(f"n{k}"), F.col(f"h{k}")))
        if hybrid:
            few = F.col(f"n{k}") < fallback
            cells.append(cell(f"HYBRID / {c} / {n} / {fallback}", F.when(few, F.col(f"u{k}")).otherwise(F.col(f"n{k}")), F.when(few, F.col(f"v{k}")).otherwise(F.col(f"h{k}"))))
    few_true = true.join(sample.select(F.col("entity_id").alias("s")), "s", "left_semi").agg(F.count(F.lit(1)).alias("n_true"))
    stats = per.select(F.explode(F.array(*cells)).alias("x")).select("x.*").groupBy("method").agg(
        F.sum("h").alias("h"), F.round(F.avg("k"), 4).alias("mean"),
        *[F.round(F.percentile("k", F.lit(QUANTILES[q])), 4).alias(q) for q in ("median", "p95", "p99")], F.max("k").alias("max"),
    )
    recall = F.round(100.0 * F.col("h") / F.nullif(F.col("n_true"), F.lit(0)), 4).alias("recall")
    return stats.join(F.broadcast(few_true)).select("method", recall, "mean", "median", "p95", "p99", "max")


def recall_at(ranked: DataFrame, truth: DataFrame, ks: list[int]) -> DataFrame:
    """(k, n_true, found, recall) of a ranked candidate list."""
    t = truth.select(F.col("source1_entity_id").alias("s"), F.col("target_entity_id").alias("t"))
    j = t.join(ranked.select("s", "t", "rank"), ["s", "t"], "left").withColumn("k", F.explode(F.array(*[F.lit(k).cast("long") for k in ks])))
    return j.groupBy("k").agg(
        F.count(F.lit(1)).alias("n_true"), F.sum(F.when(F.col("rank") <= F.col("k"), 1).otherwise(0)).alias("found"),
        rate(F.coalesce(F.col("rank") <= F.col("k"), F.lit(False))).alias("recall"),
    )


def run_totals(s1: DataFrame, counts: DataFrame) -> DataFrame:
    """(n_references, n_pairs, mean, max, n_empty) of a candidate table, given as (s, n_kept); references without candidates are in the mean."""
    n = counts.select("s", F.col("n_kept").alias("k"))
    j = s1.select(F.col("entity_id").alias("s")).distinct().join(n, "s", "left").select(F.coalesce("k", F.lit(0)).alias("k"))
    return j.agg(
        F.count(F.lit(1)).alias("n_references"), F.sum("k").alias("n_pairs"), F.round(F.avg("k"), 4).alias("mean"), F.max("k").alias("max"),
        F.sum(F.when(F.col("k") == 0, 1).otherwise(0)).alias("n_empty"),
    )
