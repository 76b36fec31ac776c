"""Pairs that share tokens, found in cells: the same lists as pair by pair, whatever the chunks, and no pair written on the way."""
import os
import random

import pytest
from oracle import same
from pyspark.sql import functions as F

from kinfold.operators import blocking, cells, entities, scoring
from kinfold.plans import reference, reference_sql
from kinfold.sources import scratch

SCHEMA = "entity_id string, business_name string, business_address string, country string"
CFG = blocking.BlockingConfig(max_token_freq=60, cap=12, top_k=5)


@pytest.fixture(scope="module")
def ends(spark):
    rng = random.Random(5)

    def rows(prefix, n):
        for i in range(n):
            name, address = f"firm {rng.randrange(9)} {rng.choice(['labs', 'mills', 'elm'])}", rng.choice([None, f"{rng.randrange(9)} elm road {rng.randrange(4)}"])
            yield f"{prefix}-{i}", name, address, rng.choice(["US", "US", "India", None])
            if i % 17 == 0:
                yield f"{prefix}-{i}", "firm 3 elm", "1 elm road", "US"  # an id with two contents

    make = lambda *x: entities.prepare(spark.createDataFrame(list(rows(*x)), SCHEMA)).localCheckpoint()
    return make("S1", 50), make("S2", 200).withColumn("target_source", F.lit("S2"))


@pytest.fixture(params=[None, 30])
def chunks(request, monkeypatch):
    if request.param:
        for n in ("CELL_REFERENCES", "CELL_TARGETS", "CELL_POSTINGS"):
            monkeypatch.setattr(cells, n, request.param)


def rows(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()))


def test_stage1_is_that_of_all_pairs(ends, chunks):
    raw = blocking.raw_candidates(*ends, CFG)
    kept = blocking.protected_cap(blocking.lexical_score(raw, *ends, CFG.exact_bonus).localCheckpoint(), CFG.cap)
    assert kept.count() < raw.count()
    columns = ("s", "t", "score", "rank")
    assert rows(scoring.stage1_candidates(*ends, CFG), *columns) == rows(scoring.stage1(kept, *ends, CFG.top_k), *columns)


@pytest.mark.parametrize("name", ["stage1_top20_production", "candidates_v1_production", "topk_idf_production", "hybrid_rank_production"])
def test_lists_of_several_chunks_match_sql(spark, chunks, name):
    same(spark, reference.queries(), reference_sql.oracle_sql(), name)


@pytest.mark.parametrize("query", [reference.stage1_top20_production, reference.candidates_v1_production, reference.topk_idf_production, reference.hybrid_rank_production])
def test_no_pair_is_written_or_joined(spark, monkeypatch, query):
    written = []
    for module in (blocking, cells):
        keep = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, label, keep=keep: written.append(label) or keep(df, label))
    query(spark, "/root/testdata/sf0.001")
    assert "pairs" not in written and "scored" not in written and "weighted" in written


def test_shuffle_files_go_with_the_write(spark):
    kept = lambda: {f for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString() for r, _, fs in os.walk(d) for f in fs if f.startswith("shuffle_")}
    before = kept()
    scratch.materialize(spark.range(1000).groupBy(F.col("id") % 10).count().withColumnsRenamed({"(id % 10)": "k"}), "few")
    assert not kept() - before


def test_features_are_of_every_pair_worth_a_model(spark, ends, chunks, monkeypatch):
    """No frequency, number of tokens, cap or rank leaves a pair out: the features of all pairs of a country that the keep rule takes."""
    s1, tg = ends
    every = s1.select(F.col("entity_id").alias("s")).distinct().crossJoin(tg.select(F.col("entity_id").alias("t")).distinct())
    pairs = scoring.cheap_score(every, s1, tg).where(scoring.KEEP).select("s", "t").localCheckpoint()
    assert pairs.groupBy("s").count().agg(F.max("count")).head()[0] > 20
    want = scoring.features(pairs, s1, tg).withColumnsRenamed({"s": "source1_entity_id", "t": "candidate_entity_id"})
    for n in ("LEAST_PASSING", "MOST_PASSING"):
        monkeypatch.setattr(cells, n, 7)
    monkeypatch.setattr(cells, "ROWS_AT_ONCE", 100)
    monkeypatch.setattr(reference, "_kept", lambda s, d: ends)
    got = reference.features_serving(spark, "")
    assert rows(got, *want.columns) == rows(want, *want.columns)


def test_features_of_empty_and_wordless_tables(spark):
    s1 = spark.createDataFrame([("S1-1", "a b", "", "US"), ("S1-2", "", "", "US"), ("S1-3", "a b", "7 x", None)], "entity_id string, name_norm string, address_norm string, country string")
    tg = s1.withColumn("entity_id", F.concat(F.lit("S3-"), F.substring("entity_id", 4, 1)))
    got = [r.asDict() for r in scoring.features_of_all(s1, tg).collect()]
    assert [(r["s"], r["t"], r["name_exact"], r["name_jaccard"], r["name_length_ratio"], r["target_is_s3"]) for r in got] == [("S1-1", "S3-1", 1, 0.0, 1.0, 1)]
    assert scoring.features_of_all(s1.limit(0), tg).count() == 0 and scoring.features_of_all(s1, tg.limit(0)).count() == 0
