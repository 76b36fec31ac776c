import pytest

from kinfold.sources import io, scratch


def test_tsv_round_trip_and_missing_literals(spark, tmp_path):
    df = spark.createDataFrame([("S1-1", "A \"quoted\" name", None, "US"), ("S1-2", "NA", "1 Rd", "n/a")], io.ENTITY)
    io.write_tsv(df, str(tmp_path / "x.tsv"))
    got = {r[0]: tuple(r)[1:] for r in io.read_tsv(spark, str(tmp_path / "x.tsv")).collect()}
    assert got == {"S1-1": ('A "quoted" name', None, "US"), "S1-2": (None, "1 Rd", None)}


def test_missing_file(spark):
    with pytest.raises(FileNotFoundError):
        io.read_tsv(spark, "/nowhere/x.tsv")


def test_aliases(spark, tmp_path):
    assert io.resolve_pair_columns(["x", "s1_id", "target_id"]) == ("s1_id", "target_id")
    with pytest.raises(RuntimeError):
        io.resolve_pair_columns(["s1_id"])
    io.write_tsv(spark.createDataFrame([("S1-1", "S2-1", 1)], "s1_id string, target_id string, z int"), str(tmp_path / "c"))
    assert [tuple(r) for r in io.read_candidates(spark, str(tmp_path / "c")).collect()] == [("S1-1", "S2-1")]


def test_checkpoint_is_reused(spark, tmp_path):
    made = []
    build = lambda: made.append(1) or spark.range(3)
    for force in (False, False, True):
        assert io.checkpointed(spark, str(tmp_path / "c"), build, force).count() == 3
    assert len(made) == 2


def test_scratch_follows_the_session(spark, tmp_path):
    assert scratch.shared_dir(spark)
    assert scratch.materialize(spark.range(4), "t").count() == 4


def test_scratch_must_be_shared_off_local_mode():
    from types import SimpleNamespace as N

    for master in ("spark://host:7077", "local-cluster[2,1,1024]", "yarn"):
        session = N(conf=N(get=lambda *_: None), sparkContext=N(master=master, getCheckpointDir=lambda: None))
        with pytest.raises(RuntimeError):
            scratch.shared_dir(session)
