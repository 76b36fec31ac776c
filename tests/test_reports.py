"""What follows a model, by hand; queries that read several contents of one id."""
import pytest
from pyspark.sql import functions as F

from kinfold.operators import blocking, evaluate, scoring, training
from kinfold.sources import io


def test_ties_go_to_the_least_id(spark):
    s = spark.createDataFrame([("a", "t9", 0.8), ("a", "t2", 0.8), ("a", "t1", 0.7), ("b", "t1", 0.4)], "s string, t string, match_probability double")
    assert [tuple(r) for r in training.scored_matches(s).collect()] == [("a", "t2", 0.8)]
    ref = spark.createDataFrame([("a",), ("b",)], "entity_id string")
    totals = training.match_totals(training.best_match(s, ref)).head()
    assert tuple(totals) == (2, 1, 1)


def test_report_and_sweep_without_a_case(spark):
    none = spark.createDataFrame([], "label bigint, match_probability double")
    assert {r["class"]: r["support"] for r in training.report(none).collect()}["accuracy"] in (0, None)
    assert training.threshold_sweep(none, [0.5]).count() == 1


def test_average_precision_over_many_values(spark):
    n = 20_000
    s = spark.range(n).select((F.col("id") % 2).alias("label"), ((F.col("id") * 7919) % n / n).cast("double").alias("match_probability"))
    rows = sorted(((r["match_probability"], r["label"]) for r in s.collect()), reverse=True)
    tp = ap = 0
    for k, (_, y) in enumerate(rows, 1):
        tp += y
        ap += y * tp / k
    assert abs(training.metrics(s).head()["average_precision"] - ap / tp) < 1e-9


def test_an_id_with_two_contents_is_read_in_one_fixed_way(spark):
    d = spark.createDataFrame([("x", "b", "", "US"), ("x", "a", "", "US")], "entity_id string, name_norm string, address_norm string, country string")
    for df in (d, d.orderBy("name_norm")):
        assert scoring.one_per_id(df).head()["name_norm"] == "a"


def test_dangling_pairs_are_misses_and_reported(spark):
    cols = "entity_id string, name_norm string, address_norm string, country string"
    s1 = spark.createDataFrame([("S1-1", "a", "b", "US")], cols)
    tg = spark.createDataFrame([("S2-1", "a", "b", "US")], cols)
    truth = spark.createDataFrame([("S1-1", "S2-1"), ("S1-1", "S2-9"), ("S1-9", "S2-9")], "source1_entity_id string, target_entity_id string")
    all_ = {r["source"]: r for r in evaluate.recall_exact(evaluate.true_pairs(truth, s1, tg, "left")).collect()}["all"]
    assert (all_["n_pairs"], round(all_["either"], 4)) == (3, 0.3333)
    assert sorted(r["missing"] for r in evaluate.dangling(truth, s1, tg).collect()) == ["both", "target"]


def test_a_hot_name_is_spread_and_kept_whole(spark, monkeypatch):
    """One name on a tenth of the rows and more: no pair is lost, and the join spreads it."""
    cols = "entity_id string, name_norm string, address_norm string, country string"
    s1 = spark.range(300).select(F.concat(F.lit("S1-"), "id").alias("entity_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), "id")).alias("name_norm"), F.lit("").alias("address_norm"), F.lit("US").alias("country"))
    tg = spark.range(900).select(F.concat(F.lit("S2-"), "id").alias("entity_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("n"), "id")).alias("name_norm"), F.lit("").alias("address_norm"), F.lit("US").alias("country"))
    split = blocking.join_split
    monkeypatch.setattr(blocking, "join_split", lambda a, b, k: split(a, b, k, hot=20, least=20))
    out = blocking.exact_block(s1, tg, "name")
    assert "_row" in out._jdf.queryExecution().toString() and cols
    assert out.count() == 100 * 300 + 200


def test_missing_inputs(spark, tmp_path):
    for read in (io.columns_of, io.read_candidates):
        with pytest.raises(FileNotFoundError):
            read(spark, "/nowhere/x.tsv")
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part.parquet").write_bytes(b"no parquet")
    with pytest.raises(Exception):
        io.checkpointed(spark, str(tmp_path / "broken"), lambda: pytest.fail("a broken table is not an absent one")).count()


def test_summary_csv(spark, tmp_path):
    io.write_csv(spark.createDataFrame([("RAREST / 5 / 1", 1.5)], "method string, recall double"), str(tmp_path / "s"))
    text = next((tmp_path / "s").glob("*.csv")).read_text()
    assert text.splitlines() == ["method,recall", "RAREST / 5 / 1,1.5"]
