"""Training pairs, stratified split, classifier, metrics and the choice of the best match."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .blocking import exact_block
from .entities import sample
from .scoring import FEATURES


def chosen_references(truth: DataFrame, n: int = 20_000) -> DataFrame:
    """(source1_entity_id): up to n references that have a match."""
    return sample(truth, "source1_entity_id", n)


def positives(truth: DataFrame, chosen: DataFrame) -> DataFrame:
    return truth.join(chosen, "source1_entity_id", "left_semi").select(F.col("source1_entity_id").alias("s"), F.col("target_entity_id").alias("t"), F.lit(1).cast("long").alias("label"))


def negatives(truth: DataFrame, chosen: DataFrame, s1: DataFrame, tg: DataFrame, ratio: int = 3) -> DataFrame:
    """Exact-block candidates that are no match, at most `ratio` per match of the reference, in a fixed order of hashes."""
    few = s1.join(chosen.withColumnRenamed("source1_entity_id", "entity_id"), "entity_id", "left_semi")
    found = exact_block(few, tg, "name").union(exact_block(few, tg, "address")).distinct()
    true = truth.select(F.col("source1_entity_id").alias("s"), F.col("target_entity_id").alias("t"))
    n = true.groupBy("s").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("s").orderBy(F.md5(F.concat("s", "t")), "t")
    rest = found.join(true, ["s", "t"], "left_anti").withColumn("rn", F.row_number().over(w)).join(n, "s")
    return rest.where(F.col("rn") <= ratio * F.col("n")).select("s", "t", F.lit(0).cast("long").alias("label"))


def training_pairs(truth: DataFrame, s1: DataFrame, tg: DataFrame, n: int = 20_000, ratio: int = 3) -> DataFrame:
    chosen = chosen_references(truth, n)
    return positives(truth, chosen).unionByName(negatives(truth, chosen, s1, tg, ratio))


def stratified_split(pairs: DataFrame, share: float = 0.2) -> DataFrame:
    """Adds part: 'test' for the first `share` of each label in a fixed order of hashes, else 'train'.

    The order within a label is never sorted in one task: hash prefixes count up first, and only the prefix that holds the border is
    ordered row by row."""
    key = F.md5(F.concat("s", "t"))
    p = pairs.withColumn("_h", key).withColumn("_b", F.substring("_h", 1, 3))
    blocks = p.groupBy("label", "_b").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("label").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    total = Window.partitionBy("label")
    blocks = blocks.select("label", "_b", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"), F.floor(F.sum("n").over(total) * F.lit(share)).alias("take"))
    within = Window.partitionBy("label", "_b").orderBy("_h", "s", "t")
    ranked = p.withColumn("_rn", F.row_number().over(within)).join(blocks, ["label", "_b"])
    part = F.when(F.col("earlier") + F.col("_rn") <= F.col("take"), "test").otherwise("train")
    return ranked.select(*pairs.columns, part.alias("part"))


def fit(features: DataFrame, rounds: int = 300, step: float = 0.08, depth: int = 5, seed: int = 42):
    """Gradient-boosted trees over the 17 features. Boosting with a limit on leaves and an L2 term has no built-in equal; depth-limited
    trees are the closest."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler

    assemble = VectorAssembler(inputCols=FEATURES, outputCol="features")
    boost = GBTClassifier(labelCol="label", featuresCol="features", maxIter=rounds, stepSize=step, maxDepth=depth, seed=seed)
    return Pipeline(stages=[assemble, boost]).fit(features)


def scored(model, features: DataFrame) -> DataFrame:
    """features with match_probability."""
    from pyspark.ml.functions import vector_to_array

    out = model.transform(features).withColumn("match_probability", vector_to_array("probability")[1])
    return out.select(*features.columns, "match_probability")


def scored_matches(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(source1_entity_id, matched_entity_ids, match_probability): the most probable target of each reference that has one at or above
    threshold; ties go to the least id."""
    w = Window.partitionBy("s").orderBy(F.desc("match_probability"), "t")
    best = scores.where(F.col("match_probability") >= threshold).withColumn("_rn", F.row_number().over(w)).where("_rn = 1")
    return best.select(F.col("s").alias("source1_entity_id"), F.col("t").alias("matched_entity_ids"), "match_probability")


def best_match(scores: DataFrame, s1: DataFrame, threshold: float = 0.5, mode: str = "best") -> DataFrame:
    """(source1_entity_id, matched_entity_ids), one row per reference, '' without a match; 'all' lists every pair at or above threshold."""
    if mode == "best":
        found = scored_matches(scores, threshold).select("source1_entity_id", F.col("matched_entity_ids").alias("m"))
    else:
        found = scores.where(F.col("match_probability") >= threshold).groupBy(F.col("s").alias("source1_entity_id"))
        found = found.agg(F.array_join(F.array_sort(F.collect_set("t")), ",").alias("m"))
    return s1.select(F.col("entity_id").alias("source1_entity_id")).distinct().join(found, "source1_entity_id", "left").select(
        "source1_entity_id", F.coalesce("m", F.lit("")).alias("matched_entity_ids")
    )


def match_totals(matches: DataFrame) -> DataFrame:
    """(n_references, n_matched, n_unmatched) of the final table."""
    none = F.sum(F.when(F.col("matched_entity_ids") == "", 1).otherwise(0))
    n = F.count(F.lit(1))
    return matches.agg(n.alias("n_references"), (n - none).alias("n_matched"), none.alias("n_unmatched"))


def _rates(tp, fp, fn, beta2: float = 1.0):
    p, r = tp / F.nullif(tp + fp, F.lit(0)), tp / F.nullif(tp + fn, F.lit(0))
    return p, r, (1 + beta2) * p * r / F.nullif(beta2 * p + r, F.lit(0))


def report(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(class, precision, recall, f1, support): one row for each label, and the rows accuracy (in f1), macro avg and weighted avg. A rate
    without a denominator counts 0."""
    hit, y = F.col("match_probability") >= threshold, F.col("label") == 1
    c = lambda x: F.sum(F.when(x, 1).otherwise(0))
    n = scores.agg(c(hit & y).alias("tp"), c(hit & ~y).alias("fp"), c(~hit & y).alias("fn"), c(~hit & ~y).alias("tn"))
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    zero = lambda x: F.coalesce(x.cast("double"), F.lit(0.0))
    yes, no = [list(map(zero, _rates(*x))) for x in ((tp, fp, fn), (tn, fn, fp))]
    n1, n0, every = tp + fn, tn + fp, tp + fp + fn + tn
    row = lambda name, rates, k: F.struct(F.lit(name).alias("class"), *[F.round(x, 6).alias(l) for x, l in zip(rates, ("precision", "recall", "f1"))], k.cast("long").alias("support"))
    none = F.lit(None).cast("double")
    rows = [
        row("0", no, n0), row("1", yes, n1), row("accuracy", [none, none, zero((tp + tn) / F.nullif(every, F.lit(0)))], every),
        row("macro avg", [(a + b) / 2 for a, b in zip(no, yes)], every),
        row("weighted avg", [zero((a * n0 + b * n1) / F.nullif(every, F.lit(0))) for a, b in zip(no, yes)], every),
    ]
    return n.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def threshold_sweep(scores: DataFrame, thresholds: list[float]) -> DataFrame:
    """(threshold, precision, recall, f05) for every threshold, in one pass over the scores."""
    y = F.col("label") == 1
    c = lambda x: F.sum(F.when(x, 1).otherwise(0)).cast("double")
    n = scores.agg(c(y).alias("pos"), *[x for i, t in enumerate(thresholds) for x in (c((F.col("match_probability") >= t) & y).alias(f"tp{i}"), c((F.col("match_probability") >= t) & ~y).alias(f"fp{i}"))])
    rows = []
    for i, t in enumerate(thresholds):
        p, r, f = _rates(F.col(f"tp{i}"), F.col(f"fp{i}"), F.col("pos") - F.col(f"tp{i}"), 0.25)
        rows.append(F.struct(F.lit(float(t)).alias("threshold"), *[F.round(x, 6).alias(l) for x, l in ((p, "precision"), (r, "recall"), (f, "f05"))]))
    return n.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def metrics(scores: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(precision, recall, f1, f05, average_precision). Average precision sums precision over the steps of recall, one step per distinct
    probability. Running sums go over 4,096 ranges of probability and within each range, so no window holds all distinct values."""
    hit = F.col("match_probability") >= threshold
    y = F.col("label") == 1
    c = lambda x: F.sum(F.when(x, 1).otherwise(0))
    n = scores.agg(c(hit & y).alias("tp"), c(hit & ~y).alias("fp"), c(~hit & y).alias("fn"))
    steps = scores.groupBy(F.col("match_probability").alias("p")).agg(c(y).alias("pos"), F.count(F.lit(1)).alias("n"))
    steps = steps.withColumn("_range", F.floor(F.col("p") * 4096).cast("int"))
    above = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = steps.groupBy("_range").agg(F.sum("pos").alias("_pos"), F.sum("n").alias("_n"))
    ranges = ranges.select("_range", *[F.coalesce(F.sum(x).over(above), F.lit(0)).alias(x + "_above") for x in ("_pos", "_n")])
    w = Window.partitionBy("_range").orderBy(F.desc("p"))
    run = steps.withColumn("_tp", F.sum("pos").over(w)).withColumn("_k", F.sum("n").over(w)).join(F.broadcast(ranges), "_range")
    ap = run.agg((F.sum(F.col("pos") * (F.col("_tp") + F.col("_pos_above")) / (F.col("_k") + F.col("_n_above"))) / F.sum("pos")).alias("average_precision"))
    both = n.join(F.broadcast(ap))
    p, r, f1 = _rates(F.col("tp"), F.col("fp"), F.col("fn"))
    f05 = _rates(F.col("tp"), F.col("fp"), F.col("fn"), 0.25)[2]
    return both.select(p.alias("precision"), r.alias("recall"), f1.alias("f1"), f05.alias("f05"), "average_precision")
