import random
import re
from collections import Counter

from kinfold.llm import terms


def brute(rows, sigma):
    cf, df = Counter(), Counter()
    for row in rows:
        for field, v in zip(("a", "b"), row):
            if v is None or v.strip().lower() in ("", "na", "n/a", "null", "none"):
                continue
            toks = re.findall("[a-z0-9]+", v.lower())
            grams = [(field, " ".join(toks[i : i + n])) for n in range(1, sigma + 1) for i in range(len(toks) - n + 1)]
            cf.update(grams)
            df.update(set(grams))
    return {g: (cf[g], df[g]) for g in cf}


def run(spark, rows, sigma):
    d = spark.createDataFrame(rows, "a string, b string").selectExpr("a", "b", "'x' as field", "'x' as term", "1 as cf")
    out = terms.ngram_counts(d, ["a", "b"], sigma).collect()
    return {(r["field"], r["term"]): (r["cf"], r["df"]) for r in out}


def test_against_brute_force(spark):
    rnd = random.Random(3)
    words = ["road", "rd", "ro", "road2", "a", "b", "ä", "ltd"]
    rows = [(" ".join(rnd.choices(words, k=rnd.randrange(0, 9))), rnd.choice([None, "NA", "x, x; x", "", "Ltd road"])) for _ in range(300)]
    rows += rows[:40] + [("road " * 4000, "hot")] * 2 + [(None, None)]
    for sigma in (1, 2, 3):
        assert run(spark, rows, sigma) == brute(rows, sigma)


def test_a_small_table_spills(spark, monkeypatch):
    rows = [(f"t{i} u{i % 5} v", None) for i in range(400)]
    assert run(spark, rows, 2) == brute(rows, 2)


def test_marks(spark):
    rows = [("common rare%d" % i, None) for i in range(150)] + [("twice", None)] * 2
    d = spark.createDataFrame(rows, "a string, b string")
    m = {r["term"]: r["mark"] for r in terms.marked(terms.ngram_counts(d, ["a"], 1), d).collect()}
    assert m["common"] == "too_common" and m["rare7"] == "too_rare" and m["twice"] == "too_common"


def test_empty(spark):
    assert run(spark, [], 2) == {}
