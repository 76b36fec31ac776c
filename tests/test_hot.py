"""Exact blocks with very many targets: the same result as pair by pair, without writing the pairs."""
import random

import pytest
from pyspark.sql import functions as F

from kinfold.functions import text as X
from kinfold.operators import blocking, entities, evaluate, hot, scoring

SCHEMA = "entity_id string, business_name string, business_address string, country string"
CFG = blocking.BlockingConfig(max_token_freq=25, cap=10, top_k=5)


def records(prefix, n, rng):
    for i in range(n):
        name = rng.choice(["Parcel Grid", "Parcel Grid", "parcel grid!", f"Firm {i % 7} Labs", None])
        address = rng.choice([None, f"{i % 5} Oak Street Pune", f"{i % 9} Oak Road, Lyon {i % 3}", "1 Elm", f"{i} Hill Drive Suite {i % 4}"])
        yield f"{prefix}-{i}", name, address, rng.choice(["US", "US", "India", None])
        if i % 11 == 0:
            yield f"{prefix}-{i}", "Parcel Grid Two", "1 Elm", "US"  # an id with two contents


@pytest.fixture(scope="module")
def ends(spark):
    rng = random.Random(3)
    make = lambda rows: entities.prepare(spark.createDataFrame(list(rows), SCHEMA))
    s1, tg = make(records("S1", 60, rng)), make([*records("S2", 200, rng), *records("S3", 120, rng)])
    return s1.localCheckpoint(), tg.withColumn("target_source", F.substring("entity_id", 1, 2)).localCheckpoint()


@pytest.fixture(scope="module")
def pair_by_pair(ends):
    raw = blocking.raw_candidates(*ends, CFG)
    return blocking.protected_cap(blocking.lexical_score(raw, *ends, CFG.exact_bonus).localCheckpoint(), CFG.cap).localCheckpoint()


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_candidates(ends, pair_by_pair):
    assert blocking.large_blocks(*ends, CFG).count() > 2
    columns = ("s", "t", "protected", "score")
    assert rows(blocking.candidates(*ends, CFG), *columns) == rows(pair_by_pair, *columns)


def test_counts(ends, pair_by_pair):
    want = pair_by_pair.groupBy("s").agg(F.sum("protected").alias("n_protected"), F.count(F.lit(1)).alias("n_kept"))
    got = blocking.candidate_counts(*ends, CFG)
    assert rows(got, *want.columns) == rows(want, *want.columns)
    assert evaluate.run_totals(ends[0], got).head()["n_pairs"] == pair_by_pair.count()


def test_pairs_are_counted_without_meeting(ends, monkeypatch):
    """References in one or two large blocks, some of which share targets, need no cells; those in more meet as before."""
    large = blocking.large_blocks(*ends, CFG)
    want = hot._met(*ends, large, hot._cell("count"), "s string, n bigint").groupBy("s").agg(F.sum("n").alias("n")).localCheckpoint()
    assert rows(hot.counted(*ends, large), "s", "n") == rows(want, "s", "n")
    sizes = hot.members(ends[0], large).select("entity_id", F.size("_blocks").alias("n")).localCheckpoint()
    assert {1, 2, 3} <= {r["n"] for r in sizes.collect()}
    few = ends[0].join(sizes.where("n <= 2"), "entity_id", "left_semi")
    monkeypatch.setattr(hot, "_met", lambda *a: pytest.fail("pairs were looked at"))
    assert rows(hot.counted(few, ends[1], large), "s", "n") == rows(want.join(few, want["s"] == few["entity_id"], "left_semi"), "s", "n")


def test_cheap_scores(ends, pair_by_pair):
    want = scoring.cheap_score(pair_by_pair, *ends)
    assert rows(scoring.cheap_candidates(*ends, CFG), *want.columns) == rows(want, *want.columns)


def test_stage1(ends, pair_by_pair):
    want = scoring.stage1(pair_by_pair, *ends, k=CFG.top_k)
    assert rows(scoring.stage1_candidates(*ends, CFG), *want.columns) == rows(want, *want.columns)


def test_pairs_of_a_hot_name_are_not_written(spark, ends, monkeypatch):
    written = []
    for module in (blocking, hot):
        keep = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, label, keep=keep: written.append(keep(df, label)) or written[-1])
    one = lambda d: d.withColumns({"name_norm": F.lit("parcel grid"), "country": F.lit("US")}).dropDuplicates(["entity_id"])
    s1, tg = one(ends[0]), one(ends[1])
    pairs = s1.count() * tg.count()
    assert blocking.candidates(s1, tg, CFG).count() == pairs
    assert max(w.count() for w in written) < pairs / 10


def test_halves_round_as_in_spark(spark):
    values = [1 / 3, 30.15625, 2.00005, 118.33335, 1e6 + 0.00005, 12.3]
    got = hot.half_up(hot.np.array(values)).tolist()
    assert got == [r[0] for r in spark.createDataFrame([(v,) for v in values], "v double").select(F.round("v", 4)).collect()]


def test_masks_stand_for_characters(spark):
    df = spark.createDataFrame([("acme 12", "12 emca"), ("", ""), ("a", ""), ("zz 9", "0 y z")], "a string, b string")
    sets = X.jaccard(X.characters(F.col("a")), X.characters(F.col("b")))
    masks = X.mask_jaccard(X.character_mask(F.col("a")), X.character_mask(F.col("b")))
    assert all(r[0] == r[1] for r in df.select(sets, masks).collect())
