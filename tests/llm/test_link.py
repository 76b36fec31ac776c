import math

from kinfold.llm import link

SCHEMA = "entity_id string, business_name string, business_address string, country string, id string, s string, t string"
A, B = "8 Elm Avenue, Rudkeasfield, AZ 39753", "77 Tolwum Road, Vumtom Falls, MN 11111"


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA)


def run(spark, ref, targets):
    out = link.match(table(spark, ref), [table(spark, targets)]).collect()
    assert all(0 <= r["confidence"] <= 1 for r in out)
    return {(r[0], r[1]): r[2] for r in out}


def accepted(out):
    return {k for k, v in out.items() if v >= link.ACCEPT}


def test_every_writing_counts_and_branches_do_not(spark):
    ref = [("S1-1", "Susanne Fofeamdaim Insurance GmbH", A, "US"), ("S1-2", "Vorpandam Trading", B, "US")]
    tg = [
        ("S2-1", "S. Fofeamdaim Ins.", "8 Elm Ave; Rudkeasfield", "us"), ("S3-1", "Suzy Fofeamdaim Insurance", "39753 8 ELM AVENUE", None),
        ("S2-2", "Susanne Fofeamdaim Insurance", B, "US"), ("S2-3", "Vorpandam Bakery", B, "US"), ("S2-4", "Vorpandam Trdg", "77 Tolwum Rd, Vumtom Falls", "US"),
    ]
    assert accepted(run(spark, ref, tg)) == {("S1-1", "S2-1"), ("S1-1", "S3-1"), ("S1-2", "S2-4")}


def test_missing_parts_match_where_clear(spark):
    ref = [("S1-1", "Vorpandam Trading", A, "US"), ("S1-2", None, B, "US")]
    tg = [("S2-1", "Vorpandam Trading", None, "US"), ("S2-2", "NA", A, "US"), ("S2-3", "Kairnidlean Foods", B, "US"), ("S2-4", None, None, "US"), ("S2-5", "", "", None)]
    assert accepted(run(spark, ref, tg)) == {("S1-1", "S2-1"), ("S1-1", "S2-2"), ("S1-2", "S2-3")}


def test_damaged_names_without_an_address(spark):
    """A typo that moves a consonant class, split and joined words, on either side; an initial beside a line of business."""
    ref = [("S1-1", "Wild Ash Eagle Dental", A, "US"), ("S1-2", "Per ninfeav Jewellers", B, "US"), ("S1-3", "Hearluvkun Foods", None, "US"), ("S1-4", "Susanne Insurance", A, "US")]
    tg = [("S2-1", "Wikd Ash Eagle Dental", None, "US"), ("S2-2", "Perninfeav Jewellers", None, "US"), ("S2-3", "Hearlukvun Foods", B, "US"), ("S2-4", "S. Insurance", None, "US")]
    assert accepted(run(spark, ref, tg)) == {(f"S1-{i}", f"S2-{i}") for i in range(1, 5)}


def test_a_name_of_many_buildings_is_judged(spark):
    """None of them can be likely for a record without an address, by its very name or by another writing of it."""
    ref = [(f"S1-{i}", "Vorpandam Trading", f"{i} Elm Avenue, Rudkeasfield, AZ 39753", "US") for i in range(10, 16)]
    out = run(spark, ref, [("S2-1", "Vorpandam Trading", None, "US")])
    assert out == {}
    out = run(spark, ref, [("S2-1", "Vorpandan Trading", None, "US")])
    assert set(out) == {("S1-10", "S2-1"), ("S1-15", "S2-1")} and not accepted(out)
    # several writings of one building are all kept
    one = [("S1-1", "Vorpandam Trading", A, "US"), ("S1-2", "Vorpandam Trading", "8 Elm Ave; Rudkeasfield", "US")]
    assert accepted(run(spark, one, [("S2-1", "Vorpandam Trading", None, "US")])) == {("S1-1", "S2-1"), ("S1-2", "S2-1")}


def test_two_organisations_in_one_building_make_a_nameless_record_unclear(spark):
    ref = [("S1-1", "Vorpandam Trading", A, "US"), ("S1-2", "Kairnidlean Foods", A, "US")]
    tg = [("S2-1", "Vorpandam Trading", A, "US"), ("S2-2", "Kairnidlean Foods", A, "US"), ("S2-3", None, A, "US")]
    assert accepted(run(spark, ref, tg)) == {("S1-1", "S2-1"), ("S1-2", "S2-2")}


def test_repeated_rows_and_null_ids(spark):
    ref = [("S1-1", "Vorpandam Trading", A, "US")] * 3 + [(None, "Vorpandam Trading", A, "US")]
    tg = [("S2-1", "Vorpandam Trading", A, "US")] * 4 + [("S2-1", "VORPANDAM TRADING", A, "US")]
    assert accepted(run(spark, ref, tg)) == {("S1-1", "S2-1")}


def test_messages_by_hand(spark):
    """Two equal weak claims on one record: each is told of the other's odds; a pair without a rival is raised by both factors."""
    rows = [("s", "t1", 0, 11, -1.0), ("s", "t2", 0, 12, -1.0), ("z", "t3", 0, 0, -1.0), ("z", "t4", 0, 0, -9.0)]
    p = spark.createDataFrame(rows, "s string, t string, ls bigint, lt bigint, theta double")
    out = {(r["s"], r["t"]): (r["p"], r["rounds"]) for r in link.propagate(p).collect()}
    lone = -math.log(link.ALONE)
    rival = math.exp(-1 + lone)  # its evidence and the message of its own target, which has no other claim
    want = 1 / (1 + math.exp(-(-1 + lone - math.log(link.ALONE + rival))))
    assert abs(out["s", "t1"][0] - want) < 0.02 and out["s", "t1"] == out["s", "t2"] and want < link.ACCEPT and out["s", "t1"][1] > 1
    assert abs(out["z", "t3"][0] - 1 / (1 + math.exp(1 - 2 * lone))) < 1e-9 and out["z", "t3"][1] == 1
    assert out["z", "t4"][0] < 0.01


def test_a_cycle_of_claims_settles(spark):
    rows = [(f"s{i}", f"t{(i + j) % 6}", i + 1, (i + j) % 6 + 1, 0.3 * (j + 1)) for i in range(6) for j in range(3)]
    out = link.propagate(spark.createDataFrame(rows, "s string, t string, ls bigint, lt bigint, theta double")).collect()
    assert len(out) == 18 and all(0 < r["p"] < 1 and r["rounds"] < 80 for r in out)


def test_countries(spark):
    """Another country excludes, another writing of it or none does not."""
    ref = [("S1-1", "Vorpandam Trading", A, "US"), ("S1-2", "Kairnidlean Foods", B, "Bharat")]
    tg = [("S2-1", "Vorpandam Trading", A, "u.s.a."), ("S2-2", "Vorpandam Trading", A, "France"), ("S2-3", "Vorpandam Trading", A, None), ("S2-4", "Kairnidlean Foods", B, "IN"), ("S2-5", "Kairnidlean Foods", None, "US")]
    assert accepted(run(spark, ref, tg)) == {("S1-1", "S2-1"), ("S1-1", "S2-3"), ("S1-2", "S2-4")}


def test_copies_are_one_node(spark):
    """A third of all rows in one form, on both sides."""
    ref = [(f"S1-{i}", "Vorpandam Trading", A, "US") for i in range(30)]
    tg = [(f"S2-{i}", "Vorpandam Trading", A, "US") for i in range(40)] + [("S2-99", None, A, None)]
    assert len(accepted(run(spark, ref, tg))) == 30 * 41


def test_long_and_empty(spark):
    long = "Vorpandam Trading " + "x" * 100_000
    assert accepted(run(spark, [("S1-1", long, A, "US")], [("S2-1", long, A, "US")])) == {("S1-1", "S2-1")}
    assert run(spark, [], [("S2-1", "Vorpandam Trading", A, "US")]) == {} and run(spark, [("S1-1", "Vorpandam Trading", A, "US")], []) == {}


def test_held_out_pairs(spark):
    """Of the known pairs with both names and one house number, nearly all are found."""
    from kinfold.llm.addresses import parse_address
    from kinfold.llm.names import parse_name
    from kinfold.operators.entities import truth
    from kinfold.sources.tables import table as read

    d = "/root/testdata/sf0.01"
    src = [read(spark, d, f"train_source{i}") for i in (1, 2, 3)]
    rec = {r["entity_id"]: r for s in src for r in s.collect()}
    got = accepted({(r[0], r[1]): r[2] for r in link.match(src[0], src[1:]).collect()})
    pairs = [tuple(r) for r in truth(spark, d).collect() if r[0] in rec and r[1] in rec]

    def full(i):
        a, n = parse_address(rec[i]["business_address"]), parse_name(rec[i]["business_name"])
        return a.house if a and n else None

    near = [p for p in pairs if full(p[0]) and full(p[0]) == full(p[1])]
    assert sum(p in got for p in near) / len(near) > 0.96
