import pytest

from kinfold.llm import addresses
from kinfold.llm.addresses import address_like, align, parse_address, words_like
from kinfold.llm.same_address import address_groups, same_building_pairs

SAME = [
    ("8 North Elm Avenue, Rudkeasfield, AZ 39753", "Rudkeasfield; 8 N. Elm Ave."),
    ("1107 Dimjail Street, Baimfavville, NY 70873", "4 fl, 1107 dimjal street, baimfavville, ny - 70873-1941"),
    ("17/5, Tolwum Road, Keamsidnagar, Kerala - 387373", "17/5, TOLWUM RD - FLAT NO 303 - KL - KEAMSIDNAGAR PIN 387 373"),
    ("142 avenue Beamean, 43562 Lovmiv-le-Bas", "Nº 142 av. Beamean / RDC / F-43562 Lovmiv-le-Bas"),
    ("15-1-222, Telran Nagar, Daidvampur, Kerala - 154752", "15-1-222 Telran Ngr, Behind Lotus Talkies, Daidvampur"),
    ("12 Mt Vernon, Springfield", "12 Mount Vernon, Springfield"),
    ("5 Ldg, 12345", "5 Lodge, 12345"),
    ("8 Lakeview Drive, Rudkeasfield, AZ 39753", "8 Lake View Dr, Rudkeasfield"),
    ("7 Casino Street, Rudkeasfield, AZ 39753", "7 Casno St, Rudkeasfield"),
]
OTHER = [
    ("8 Elm Avenue, Rudkeasfield, AZ 39753", "9 Elm Avenue, Rudkeasfield, AZ 39753"),
    ("8 Elm Avenue, Rudkeasfield, AZ 39753", "8 Elm Street, Rudkeasfield, AZ 39753"),
    ("8 Elm Avenue, Rudkeasfield, AZ 39753", "8 Oak Avenue, Rudkeasfield, AZ 39753"),
    ("8 Elm Avenue, Rudkeasfield, AZ 39753", "8 Elm Avenue, Vumtom Falls, MN 11111"),
    ("8 North Elm Avenue, Rudkeasfield, AZ 39753", "8 South Elm Avenue, Rudkeasfield, AZ 39753"),
    ("8 Oak Avenue, Rudkeasfield, AZ 39753", "8 Oakland Avenue, Rudkeasfield, AZ 39753"),
]


@pytest.mark.parametrize("a,b", SAME)
def test_one_building(a, b):
    assert address_like(parse_address(a), parse_address(b)) >= 0.5


@pytest.mark.parametrize("a,b", OTHER)
def test_other_buildings(a, b):
    assert address_like(parse_address(a), parse_address(b)) < 0.5


def test_alignment_opens_gaps_dearly():
    assert align(["a1", "b1"], ["a1", "b1"]) == 0
    one_long, two_short = align(list("abxxcd"), list("abcd")), align(list("axbcxd"), list("abcd"))
    assert one_long < two_short
    assert align(["road"], ["rd"]) < align(["road"], ["street"])


def test_long_runs_of_words_are_aligned():
    words = [f"w{i}x{i * 7}" for i in range(201)]
    assert words_like(" ".join(words), " ".join(reversed(words))) < 0.3
    damaged = words[:50] + ["zzzzzz"] + words[51:150] + words[152:]
    assert 0.98 < words_like(" ".join(words), " ".join(damaged)) < 1


def test_the_band_changes_no_cost():
    import random

    rnd = random.Random(3)
    for _ in range(60):
        x, y = ([rnd.choice(["aa", "bb", "cc", "dd", "aabb"]) for _ in range(rnd.randrange(1, 40))] for _ in range(2))
        assert abs(align(x, y) - addresses._banded(x, y, 10**6)) < 1e-9


SCHEMA = "entity_id string, business_address string, id string, address string, cls string, key int"


def rows(*addresses):
    return [(f"S1-{i}", a, "x", "x", "x", 1) for i, a in enumerate(addresses)]


def test_pairs_are_brute_force_pairs(spark):
    adr = [a for pair in SAME + OTHER for a in pair]
    df = spark.createDataFrame(rows(*adr) + rows(*adr)[:4], SCHEMA)
    got = {tuple(r) for r in same_building_pairs(df).collect()}
    ps = [(f"S1-{i}", a, parse_address(a)) for i, a in enumerate(adr)]
    want = {tuple(sorted((x[0], y[0]))) for x in ps for y in ps if x[0] < y[0] and x[1] != y[1] and address_like(x[2], y[2]) >= 0.5}
    assert got == want and len(got) >= len(SAME)


def test_missing_long_and_odd(spark):
    long = "8 Elm Avenue, Rudkeasfield, AZ 39753" + " x" * 50_000
    df = spark.createDataFrame(rows(None, "", "NA", "???", "Somewhere", "somewhere", long, long + "y") + [(None, "8 Elm Ave", "", "", "", 1)], SCHEMA)
    assert {tuple(r) for r in same_building_pairs(df).collect()} <= {("S1-6", "S1-7")}
    assert address_groups(df).where("id in ('S1-0', 'S1-1', 'S1-2')").count() == 0


def test_a_town_is_filled_in_from_the_postcode(spark):
    df = spark.createDataFrame(rows("11 Mill Rd., Unit 20, 94743", "Jeavos Falls, MO, 11 Mill Rd.", "5 Oak Lane, Jeavos Falls, MO 94743"), SCHEMA)
    assert ("S1-0", "S1-1") in {tuple(r) for r in same_building_pairs(df).collect()}


def test_empty(spark):
    assert same_building_pairs(spark.createDataFrame([], SCHEMA)).count() == 0
