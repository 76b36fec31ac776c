"""A hand-made funnel: twelve records, every rule once."""
import pytest
from pyspark.sql import functions as F

from kinfold.operators import blocking, entities, evaluate, scoring, training

S1 = [
    ("S1-1", "Acme Widgets Pvt. Ltd.", "12 MG Road, Pune", "India"),
    ("S1-2", "Café Été", "5 Rue A", "France"),
    ("S1-3", None, "9 Main St", "US"),
    ("S1-4", "Blue Bolt Inc", "NA", "US"),
    ("S1-5", "Zeta Labs", "77 Hill Rd", None),
]
TG = [
    ("S2-1", "acme widgets pvt ltd", "12, M.G. Road Pune", "India"),
    ("S2-2", "Cafe Ete", "5 Rue A", "France"),
    ("S2-3", "Other", "9 Main St.", "US"),
    ("S3-4", "BLUE BOLT, INC", "1 Oak", "US"),
    ("S3-5", "Zeta Labs", "77 Hill Rd", None),
    ("S3-6", "Blue Bolt Inc", "2 Elm", "India"),
    ("S3-7", "Acme Gadgets", "44 Park", "India"),
]
SCHEMA = "entity_id string, business_name string, business_address string, country string"


@pytest.fixture(scope="module")
def ends(spark):
    s1 = entities.prepare(spark.createDataFrame(S1, SCHEMA))
    tg = entities.prepare(spark.createDataFrame(TG, SCHEMA)).withColumn("target_source", F.substring("entity_id", 1, 2))
    return s1, tg


def ids(df):
    return sorted((r["s"], r["t"]) for r in df.collect())


def test_exact_blocks_need_country_and_text(ends):
    assert ids(blocking.exact_block(*ends, "name")) == [("S1-1", "S2-1"), ("S1-4", "S3-4")]
    assert ids(blocking.exact_block(*ends, "address")) == [("S1-2", "S2-2"), ("S1-3", "S2-3")]


def test_protected_pairs_survive_a_cap_of_nothing(ends):
    kept = blocking.candidates(*ends, blocking.BlockingConfig(cap=0))
    assert ids(kept) == [("S1-1", "S2-1"), ("S1-2", "S2-2"), ("S1-3", "S2-3"), ("S1-4", "S3-4")]


def test_cap_bounds_the_rest(ends):
    kept = blocking.candidates(*ends, blocking.BlockingConfig(cap=1, exact_blocks=False))
    assert max(r["n"] for r in kept.groupBy("s").agg(F.count("*").alias("n")).collect()) == 1


def test_stage1_and_features(ends):
    s1, tg = ends
    top = scoring.stage1(blocking.candidates(s1, tg, blocking.BlockingConfig()), s1, tg)
    f = {(r["s"], r["t"]): r for r in scoring.features(top.select("s", "t"), s1, tg).collect()}
    assert f["S1-1", "S2-1"]["name_exact"] == 1 and f["S1-1", "S2-1"]["target_is_s2"] == 1
    for r in f.values():
        assert all(0 <= r[c] <= 1 for c in r.asDict() if c.endswith(("jaccard", "overlap", "similarity", "ratio")))


def test_hybrid_holds_the_rare_block(ends):
    rare = set(ids(blocking.rarest_union_block(*ends, 2, 5)))
    assert rare <= set(ids(blocking.hybrid_block(*ends, 2, 5)))


def test_split_and_best_match(spark, ends):
    pairs = spark.createDataFrame([(f"s{i}", f"t{i}", i % 2) for i in range(500)], "s string, t string, label bigint")
    n = {(r["label"], r["part"]): r["count"] for r in training.stratified_split(pairs).groupBy("label", "part").count().collect()}
    assert n == {(0, "test"): 50, (0, "train"): 200, (1, "test"): 50, (1, "train"): 200}
    scores = spark.createDataFrame([("S1-1", "S2-1", 0.9), ("S1-1", "S2-2", 0.4), ("S1-4", "S3-4", 0.49)], "s string, t string, match_probability double")
    got = {r[0]: r[1] for r in training.best_match(scores, ends[0]).collect()}
    assert got["S1-1"] == "S2-1" and got["S1-4"] == "" and len(got) == 5
    assert {r[0]: r[1] for r in training.best_match(scores, ends[0], 0.4, "all").collect()}["S1-1"] == "S2-1,S2-2"


def test_metrics_by_hand(spark):
    s = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.2)], "label bigint, match_probability double")
    m = training.metrics(s).head()
    assert (round(m["precision"], 4), m["recall"]) == (0.6667, 1.0)
    assert round(m["average_precision"], 4) == round((1 + 2 / 3) / 2, 4)


def test_recall_counts_empty_references(spark, ends):
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-2", "S2-9")], "source1_entity_id string, target_entity_id string")
    r = evaluate.method_row("x", ends[0], truth, blocking.exact_block(*ends, "name")).head()
    assert r["recall"] == 50.0 and r["mean"] == 0.4


def test_empty_tables(ends):
    s1, tg = ends
    assert blocking.candidates(s1.limit(0), tg, blocking.BlockingConfig()).count() == 0
    assert blocking.candidates(s1, tg.limit(0), blocking.BlockingConfig()).count() == 0


def test_registered_models_boost_all_surveyed_rounds(spark, monkeypatch):
    """SURVEY L2: 300 iterations at step 0.08."""
    from pyspark.ml import Pipeline

    from kinfold.plans import reference

    monkeypatch.setattr(Pipeline, "fit", lambda self, _: self)
    boost = reference._model(spark, "/root/testdata/sf0.001")[0].getStages()[-1]
    assert (boost.getMaxIter(), boost.getStepSize()) == (300, 0.08)


def test_best_match_chooses_from_the_candidates_of_production(spark, monkeypatch):
    from kinfold.plans import reference

    d = "/root/testdata/sf0.01"
    s1, tg = reference._s1(spark, d), reference._tg(spark, d)
    want, small = (set(ids(scoring.stage1(blocking.candidates(s1, tg, c), s1, tg))) for c in (blocking.BlockingConfig(), reference.CFG))
    monkeypatch.setattr(reference, "_model", lambda s, d: (None, None))
    monkeypatch.setattr(training, "scored", lambda model, features: features)
    monkeypatch.setattr(training, "best_match", lambda scores, s1: scores)
    assert set(ids(reference.best_match(spark, d))) == want and len(want) > len(small)
