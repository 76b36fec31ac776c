import pytest
from pyspark.sql import functions as F

from kinfold.llm.names import jaro_winkler, name_like, parse_name, word_like
from kinfold.llm.name_variants import key_of, keys_of, name_groups, variant_pairs

SAME = [
    ("Susanne Fofeamdaim Insurance GmbH", "S. Fofeamdaim Ins. G.m.b.H."),
    ("CleverThunder Ivy Software Solutions", "Clever Thunder Ivy Software Solutions Inc"),
    ("Modern Bear Ivy Manufacturing", "Bear Ivy Modern Mfg Ltd (India)"),
    ("Tirheartouv, Robert Manuf Ltd", "Bob Tirheartouv Manufacturing"),
    ("Maiddour - vear Travels Ltd", "Maiddourvear Travels Ltd."),
    ("Bâtiment Geneviève Gounkalgud SARL", "The Bât. G. Gounkalgud SARL"),
    ("F0nmaimled Travels Ltd", "Fonmaimled Travels Ltd"),
    ("Parcelgrid Locker Point", "PARCEL GRID LOCKER POINT"),
    ("Parcelgrid Locker Point", "Parcelgrid Locker Pt."),
    ("Pat Smith", "Patricia Smith"),
    ("Pât. Vormilden", "Pâtisserie Vormilden SARL"),
    ("Ted Kurvalden Foods", "Edward Kurvalden Foods"),
    ("Ted Wurbiggan Foods", "Theodore Wurbiggan Foods"),
]
OTHER = [
    ("Pesjuvais Pharmacy Ltd", "Pesjuvais Bakery Ltd"),
    ("William Tavveavvo Opticians", "Robert Tavveavvo Opticians"),
    ("Sealukni Photography", "Vorpandam Photography"),
    ("Abc Plumbing", "Bac Plumbing"),
    ("Edward Kurvalden Foods", "Theodore Kurvalden Foods"),
    ("Patricia Vormilden", "Pâtisserie Vormilden SARL"),
]


@pytest.mark.parametrize("a,b", SAME)
def test_writings_of_one_name(a, b):
    assert name_like(parse_name(a), parse_name(b)) >= 0.85


def test_writings_share_a_block(spark):
    rows = [(i, key_of(parse_name(n))) for i, pair in enumerate(SAME) for n in pair]
    keys = spark.createDataFrame(rows, "i int, cls string").selectExpr("i", "cls").withColumn("k", keys_of(F.col("cls"))).collect()
    for i, pair in enumerate(SAME):
        x, y = [set(r["k"]) for r in keys if r["i"] == i]
        assert x & y, pair


@pytest.mark.parametrize("a,b", OTHER)
def test_other_organisations(a, b):
    assert name_like(parse_name(a), parse_name(b)) < 0.85


def test_two_common_words_are_two_words():
    x, y = parse_name("Velvet Bridge Paddle Textiles"), parse_name("Velvet Bridge Saddle Textiles")
    assert name_like(x, y, {"paddle": 1.0, "saddle": 0.9}) == 0
    assert word_like("paddle", "saddle", {"paddle": 1.0}) == word_like("paddle", "saddle") == jaro_winkler("paddle", "saddle")


def test_jaro_winkler_published_values():
    assert round(jaro_winkler("martha", "marhta"), 4) == 0.9611
    assert round(jaro_winkler("dwayne", "duane"), 4) == 0.84
    assert jaro_winkler("", "a") == 0.0


SCHEMA = "entity_id string, business_name string, id string, name string, cls string"


def rows(*names):
    return [(f"S1-{i}", n, "clash", "clash", "clash") for i, n in enumerate(names)]


def test_pairs_are_brute_force_pairs(spark):
    names = [n for pair in SAME for n in pair]
    df = spark.createDataFrame(rows(*names) + rows(*names)[:3], SCHEMA)
    got = {tuple(r) for r in variant_pairs(df).collect()}
    parsed = [(f"S1-{i}", n, parse_name(n)) for i, n in enumerate(names)]
    want = {tuple(sorted((a[0], b[0]))) for a in parsed for b in parsed if a[0] < b[0] and a[1] != b[1] and name_like(a[2], b[2]) >= 0.85}
    assert got == want and len(got) >= len(SAME)


def test_missing_long_and_symbols(spark):
    long = " ".join(f"wordx{i}" for i in range(3000))
    df = spark.createDataFrame(rows(None, "", "  ", "NA", "&", "...", long, long + " Ltd") + [(None, "Acme Foods", "", "", "")], SCHEMA)
    assert [tuple(r) for r in variant_pairs(df).collect()] == [("S1-6", "S1-7")]
    assert name_groups(df).where("id = 'S1-0'").count() == 0


def test_equal_names_are_no_pair(spark):
    assert variant_pairs(spark.createDataFrame(rows(*["Parcelgrid Locker Point"] * 50), SCHEMA)).count() == 0


def test_empty(spark):
    assert variant_pairs(spark.createDataFrame([], SCHEMA)).count() == 0
