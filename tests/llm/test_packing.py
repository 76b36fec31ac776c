import random
from collections import Counter

from kinfold.llm import packing


def run(spark, sizes, kinds, monkeypatch=None):
    s = spark.createDataFrame(sizes, "doc_id bigint, n_tokens bigint").selectExpr("*", "1 as bin", "2 as grp")
    c = spark.createDataFrame(kinds, "container string, capacity bigint")
    return packing.pack(s, c).collect()


def check(out, sizes, kinds):
    room, whole, pieces = Counter(), Counter(), Counter()
    for r in out:
        room[r["container"], r["bin"]] += r["n_tokens"]
        whole[r["container"], r["doc_id"]] += r["n_tokens"]
        pieces[r["container"], r["doc_id"]] += 1
    caps = dict(kinds)
    assert all(v <= caps[k] for (k, _), v in room.items())
    want = {}
    for i, n in sizes:
        if i is not None:
            want[i] = max(want.get(i, 0), n or 0)
    assert {k: v for k, v in whole.items()} == {(c, i): n for c in caps for i, n in want.items()}
    assert all(pieces[c, i] == max(1, -(-n // caps[c])) for c in caps for i, n in want.items())
    return {c: sum(1 for k, _ in room if k == c) for c in caps}


def test_whole_split_and_tight(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_PER_GROUP", 50)
    rnd = random.Random(5)
    sizes = [(i, rnd.choice([0, 1, 5, 17, 33, 60, 100, 101, 250, 512, None])) for i in range(900)] + [(3, 7), (None, 9)]
    kinds = [("small", 100), ("large", 400)]
    bins = check(run(spark, sizes, kinds), sizes, kinds)
    total = sum(n or 0 for i, n in sizes if i is not None)
    assert bins["small"] <= total / 100 * 1.12 and bins["large"] <= total / 400 * 1.03


def test_three_levels_leave_little_unused(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_PER_GROUP", 40)
    rnd = random.Random(7)
    sizes = [(i, int(rnd.lognormvariate(4.5, 0.8)) + 1) for i in range(4000)]
    bins = check(run(spark, sizes, [("c", 1000)]), sizes, [("c", 1000)])
    assert bins["c"] <= -(-sum(n for _, n in sizes) // 1000) * 1.03


def test_items_over_half_end_and_none_is_emitted_early(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS_PER_GROUP", 20)
    sizes = [(i, 51 + i % 40) for i in range(500)] + [(1000 + i, 10) for i in range(500)]
    bins = check(run(spark, sizes, [("c", 100)]), sizes, [("c", 100)])
    assert bins["c"] <= 515


def test_equal_runs_are_equal(spark):
    sizes = [(i, 30) for i in range(40)]
    assert sorted(map(tuple, run(spark, sizes, [("c", 100)]))) == sorted(map(tuple, run(spark, sizes[::-1], [("c", 100)])))


def test_best_fit():
    assert sorted(r for r, _ in packing.best_fit([60, 40, 50, 50], 100)) == [0, 0]
    assert packing.best_fit([], 10) == []


def test_empty(spark):
    assert run(spark, [], [("c", 10)]) == []
    assert run(spark, [(1, 5)], [("c", 0)]) == []
