import random

import pytest

from kinfold.llm.components import connected_components


def brute(pairs, nodes=()):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        if a is not None and b is not None:
            a, b = find(a), find(b)
            up[max(a, b)] = min(a, b)
        else:
            [find(x) for x in (a, b) if x is not None]
    [find(n) for n in nodes]
    return {x: find(x) for x in up}


def run(spark, pairs, nodes=None):
    df = spark.createDataFrame(pairs, "x string, y string").selectExpr("x", "y", "1 as u", "2 as v", "3 as m")
    n = None if nodes is None else spark.createDataFrame([(k,) for k in nodes], "n string")
    out = connected_components(df, "x", "y", n).collect()
    assert len({r[0] for r in out}) == len(out)
    return {r[0]: r[1] for r in out}


def chain(n):
    ids = [f"n{i:03d}" for i in range(n)]
    random.Random(1).shuffle(ids)
    return list(zip(ids, ids[1:]))


CASES = {
    "chain": chain(60),
    "star": [("hub", f"leaf{i:04d}") for i in range(500)] + [("zz", "hub")],
    "repeats and loops": [("b", "a"), ("a", "b"), ("b", "a"), ("c", "c")],
    "nulls": [("a", None), (None, "b"), (None, None), ("c", "d")],
    "random": [(f"r{random.Random(i).randrange(60)}", f"r{random.Random(-i - 1).randrange(60)}") for i in range(45)],
}


@pytest.mark.parametrize("name", list(CASES))
def test_against_union_find(spark, name):
    assert run(spark, CASES[name]) == brute(CASES[name])


def test_lone_nodes_and_empty(spark):
    assert run(spark, [("a", "b")], ["c", "b", None]) == {"a": "a", "b": "a", "c": "c"}
    assert run(spark, []) == {}
