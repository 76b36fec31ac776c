import pytest
from pyspark.sql import functions as F

from kinfold.functions import text as X

ROWS = [("Été",), ("",), (None,), ("Acme  Widgets, Pvt. Ltd. a",), ("THE Health Centre 12b-7",)]


@pytest.fixture(scope="module")
def norms(spark):
    return spark.createDataFrame(ROWS, "x string").select(X.normalize(F.col("x")).alias("n"))


def test_normalize(norms):
    assert [r[0] for r in norms.collect()] == ["t", "", "", "acme widgets pvt ltd a", "the health centre 12b 7"]


@pytest.mark.parametrize(
    "kind,want",
    [
        (X.tokens_min1, [["t"], [], [], ["acme", "widgets", "pvt", "ltd", "a"], ["the", "health", "centre", "12b", "7"]]),
        (X.tokens_min3, [[], [], [], ["acme", "widgets", "pvt", "ltd"], ["the", "health", "centre", "12b"]]),
        (X.tokens_stop55, [[], [], [], ["acme", "widgets"], ["12b"]]),
        (X.tokens_stop30, [[], [], [], ["acme", "widgets"], ["12b"]]),
        (X.number_runs, [[], [], [], [], ["12", "7"]]),
    ],
)
def test_tokens(norms, kind, want):
    assert [r[0] for r in norms.select(kind(F.col("n"))).collect()] == want


def test_jaccard_of_empty_sets(spark):
    e = F.array().cast("array<string>")
    a = F.array(F.lit("x"))
    r = spark.range(1).select(X.jaccard(e, e), X.jaccard(e, e, 1.0), X.jaccard(e, a), X.jaccard(a, a), X.overlap(e, a)).head()
    assert list(r) == [0.0, 1.0, 0.0, 1.0, 0.0]


def test_id_list(spark):
    df = spark.createDataFrame([("S2-1, S3-2 ,,",), ("",), (None,)], "x string")
    assert [r[0] for r in df.select(X.id_list(F.col("x"))).collect()] == [["S2-1", "S3-2"], [], []]
