"""Pairs scored in batches, and what is retrieved once for several results."""
import pyarrow as pa

from kinfold.operators import blocking, hot, scoring
from kinfold.plans import reference

TEXTS = ["", "acme", "acme 12 mg road", "road mg 12 acme acme", "a b c", "zz 9 zz"]


def test_lexical_scores_are_made_in_batches(spark, monkeypatch):
    """The sums of a pair by hand, batches of any size, and no token of a pair split by a column expression."""
    monkeypatch.setattr(scoring, "KEPT_TEXTS", 3)
    cols = "entity_id string, name_norm string, address_norm string, country string"
    s1, tg = (spark.createDataFrame([(f"{p}-{i}-{j}", x, y, "US") for i, x in enumerate(TEXTS) for j, y in enumerate(TEXTS)], cols) for p in ("S1", "S2"))
    pairs = s1.selectExpr("entity_id as s").crossJoin(tg.selectExpr("entity_id as t"))
    out = blocking.lexical_score(pairs, s1, tg, 1000.0)
    assert "array_intersect" not in out._jdf.queryExecution().optimizedPlan().toString()
    df = {w: len(TEXTS) * sum(w in x.split() for x in TEXTS) for x in TEXTS for w in x.split()}

    def want(s, t):
        total = 0.0
        for i, j, each in zip(s.split("-")[1:], t.split("-")[1:], (100.0, 150.0)):
            x, y = TEXTS[int(i)], TEXTS[int(j)]
            total += 1000.0 * (x == y != "") + sum(10_000.0 / df[w] + each for w in {*x.split()} & {*y.split()})
        return total

    rows = out.collect()
    assert len(rows) == len(TEXTS) ** 4 and all(abs(r["score"] - want(r["s"], r["t"])) < 1e-4 for r in rows)


def test_reduction_retrieves_candidates_once(spark, monkeypatch):
    written = []
    for module in (blocking, hot):
        keep = module.materialize
        monkeypatch.setattr(module, "materialize", lambda df, label, keep=keep: written.append(label) or keep(df, label))
    reference.stage1_reduction(spark, "/root/testdata/sf0.001")
    assert written.count("blocks") == 2 and written.count("pairs") == 1


def test_matches_do_not_prepare_the_references_again(spark, monkeypatch):
    prepared = []
    keep = reference.entities.reference
    monkeypatch.setattr(reference.entities, "reference", lambda *a: prepared.append(a) or keep(*a))
    reference.all_matches_alike(spark, "/root/testdata/sf0.001")
    assert len(prepared) == 1


def test_cells_list_texts_without_a_scalar_each(monkeypatch):
    listed = []
    keep = hot.listed
    monkeypatch.setattr(hot, "listed", lambda c: listed.append(len(c)) or keep(c))
    rows = [{"_target": x != "S1-1", "_key": "k", "entity_id": x, "name_norm": "acme labs", "address_norm": "1 elm", "country": "US", "_others": None} for x in ("S1-1", "S2-1", "S2-2")]
    schema = pa.schema({"_target": pa.bool_(), "_others": pa.list_(pa.string())} | dict.fromkeys(("_key", "entity_id", "name_norm", "address_norm", "country"), pa.string()))
    out = pa.Table.from_batches(list(hot._cell("cheap")(iter(pa.Table.from_pylist(rows, schema).to_batches()))))
    assert listed == [2, 2] and out.column("t").to_pylist() == ["S2-1", "S2-2"] and out.column("name_shared").to_pylist() == [2, 2]
