"""Counts of pairs, which scores and features are made of, against the column functions of one pair."""
from pyspark.sql import functions as F

from kinfold.functions import text as X
from kinfold.operators import scoring

TEXTS = ["", "acme", "acme 12 mg road", "road mg 12 acme acme", "a b c", "zz 9 zz"]


def test_counts_are_those_of_the_column_functions(spark, monkeypatch):
    monkeypatch.setattr(scoring, "KEPT_TEXTS", 2)
    pairs = spark.createDataFrame([(x, y, y, x) for x in TEXTS for y in TEXTS], "sn string, tn string, sa string, ta string").coalesce(1)
    for least, kind, spaces, chars in ((3, X.tokens_min3, True, X.characters), (1, X.tokens_min1, False, X.letters)):
        a, b = kind(F.col("sn")), kind(F.col("tn"))
        x, y = chars(F.col("sn")), chars(F.col("tn"))
        size = lambda f, *c: F.size(f(*c)).cast("long")
        want = [size(F.array_intersect, a, b), F.least(F.size(a), F.size(b)).cast("long"), size(F.array_union, a, b), size(F.array_intersect, x, y), size(F.array_union, x, y)]
        got = scoring.with_counts(pairs, least, spaces)
        assert got.where(F.struct(*[f"n_{c}" for c in scoring.COUNTS]) != F.struct(*want)).count() == 0
        assert got.where("n_shared <> a_shared or n_chars_any <> a_chars_any").count() == 0


def test_tokens_of_a_pair_are_not_split_by_column_expressions(spark):
    cols = "entity_id string, name_norm string, address_norm string, country string"
    s1, tg = (spark.createDataFrame([(i, "acme labs", "1 elm", "US")], cols) for i in ("S1-1", "S2-1"))
    out = scoring.features(spark.createDataFrame([("S1-1", "S2-1")], "s string, t string"), s1, tg)
    assert "split(" not in out._jdf.queryExecution().optimizedPlan().toString() and out.head()["name_jaccard"] == 1.0
