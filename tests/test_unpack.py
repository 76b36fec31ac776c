import pytest

from kinfold.operators.unpack import splitting_rule, unpack

CASES = {
    "S2-1": ["S2-1"],
    "S2-1,S3-2": ["S2-1", "S3-2"],
    " S2-1 ; S3-2;;S2-1 ": ["S2-1", "S3-2", "S2-1"],
    "[S2-1|'S3-2/9C']": ["S2-1", "S3-2/9C"],
    '"S2-1, S3-2"': ["S2-1", "S3-2"],
    '"S3-1,80"': ["S3-1,80"],
    '"S2-1,""S3-1,80"",S3-4"': ["S2-1", "S3-1,80", "S3-4"],
    '"""S3-1/9C""; S2-4"': ["S3-1/9C", "S2-4"],
    "{'S3-1,80' 'S3-2'}": ["S3-1,80", "S3-2"],
    "S2-1/S3-2 / S2-3": ["S2-1", "S3-2", "S2-3"],
    "S2-1\tS3-2\nS2-3": ["S2-1", "S3-2", "S2-3"],
    '"Acme Inc","Bolt Co"': ["Acme Inc", "Bolt Co"],
    '"Smith, John";"Doe, Jane"': ["Smith, John", "Doe, Jane"],
    "New York; Boston": ["New York", "Boston"],
    "a.b@x.com, c@y.com": ["a.b@x.com", "c@y.com"],
    "Acme Inc.; Bolt & Co. | O'Brien Ltd": ["Acme Inc.", "Bolt & Co.", "O'Brien Ltd"],
    "red/green  blue": ["red", "green", "blue"],
    '"He said ""no""";yes': ['He said "no"', "yes"],
    "Jean-Luc Picard; Room B-12, Studio-54 Club": ["Jean-Luc Picard", "Room B-12", "Studio-54 Club"],
    ",S2-7  S3-4 S3-2/9C S2-8": ["S2-7", "S3-4", "S3-2/9C", "S2-8"],
    "New York": ["New York"],
    "x;'y": ["x", "y"],
}


@pytest.mark.parametrize("field", list(CASES))
def test_values_and_places(spark, field):
    df = spark.createDataFrame([("k", field)], "id string, f string")
    assert [(r["pos"], r["value"]) for r in unpack(df, "id", "f").orderBy("pos").collect()] == list(enumerate(CASES[field], 1))


def test_missing_repeated_and_clashing(spark):
    rows = [("a", m, 1) for m in (None, "", "  ", "NA", "n/a", "null", "None", "[]", "-")] + [("b", "S2-1", 1), ("b", "S2-1", 2), (None, "S2-7", 3)]
    df = spark.createDataFrame(rows, "id string, f string, pos int").withColumnRenamed("pos", "value")
    assert sorted((r["id"] or "", r["pos"], r["value"]) for r in unpack(df, "id", "f").collect()) == [("", 1, "S2-7"), ("b", 1, "S2-1")]


def test_empty_table(spark):
    assert unpack(spark.createDataFrame([], "id string, f string"), "id", "f").count() == 0


def test_very_long_list(spark):
    ids = [f"S2-{i:07d}" for i in range(20_000)]
    out = unpack(spark.createDataFrame([("a", ",".join(ids))], "id string, f string"), "id", "f").orderBy("pos").collect()
    assert [r["value"] for r in out] == ids


def test_rule_is_per_skeleton():
    assert splitting_rule("I,I") == [(0, "", (), ""), (1, "", (), "")]
    assert splitting_rule("'I,a',I") == [(0, "", (",",), ""), (2, "", (), "")]
