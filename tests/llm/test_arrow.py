"""Reading of records in Arrow batches."""
import gc

import pyarrow as pa

from kinfold.functions.arrow import listed, uncollected
from kinfold.llm import link, names


def test_texts_are_listed_as_they_are():
    for a in (pa.array(["a", None, "", "é"]), pa.array([], pa.string()), pa.array(["x", "y", None]).slice(1), pa.chunked_array([["a"], [None, "b"]])):
        assert listed(a) == a.to_pylist()


def test_records_are_read_without_a_scalar_each(monkeypatch):
    """Nor with the collector of cycles, which is on again afterwards, if the batches are broken off too."""
    batch = pa.record_batch([["1", "2"], ["Acme Labs", None], [None, "12 Oak Street"], ["us", None]], names=["id", "name", "addr", "country"])
    seen = []
    keep = link.parse_name
    monkeypatch.setattr(link, "parse_name", lambda raw: seen.append(gc.isenabled()) or keep(raw))
    out = link._parse(iter([batch, batch]))
    assert next(out).column("fresh").to_pylist() == [True, True] and seen == [False, False]
    out.close()
    assert gc.isenabled()
    list(uncollected(lambda b: b)(iter([])))
    assert gc.isenabled()


def test_capitals_within_words_part_them_as_before():
    for raw in ("AcmeLabs", "Acme Labs", "ACME LABS", "acme labs", "Acme labsOne", "12Acme Labs", "McDonald", "Oak-Hill", "ÉcoleÉtoile Paris"):
        parted = names._CAMEL.sub(" ", raw)
        assert names.tokens_of(raw) == names.tokens_of(parted) and (not raw.istitle() or parted == raw)
