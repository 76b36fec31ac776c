from kinfold.sources.io import ENTITY
from kinfold.streaming.intake import arriving, match_arriving


def test_arriving_files_are_matched(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    spark.createDataFrame([("S2-1", "Acme Ltd.", "x", "US"), ("S2-2", None, "x", "US")], ENTITY).coalesce(1).write.option("sep", "\t").option("header", True).csv(str(folder / "a"))
    ref = spark.createDataFrame([("S1-1", "ACME ltd", "y", "US"), ("S1-2", None, "y", "US")], ENTITY)
    q = match_arriving(arriving(spark, str(folder / "a")), ref, str(tmp_path / "out"), str(tmp_path / "state"))
    q.awaitTermination(120)
    assert [(r["s"], r["t"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("S1-1", "S2-1")]
