"""Delimited-text sources and sinks of the pipeline."""
from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import na_to_null

ENTITY = T.StructType([T.StructField(n, T.StringType()) for n in ("entity_id", "business_name", "business_address", "country")])
MATCHES = T.StructType([T.StructField(n, T.StringType()) for n in ("source1_entity_id", "matched_entity_ids")])
# Accepted names of the two columns of a candidate file, first hit wins.
REFERENCE_ALIASES = ("source1_entity_id", "s1_id", "source1_id")
TARGET_ALIASES = ("candidate_entity_id", "target_id", "matched_entity_id", "target_entity_id")


def _must_exist(path: str, read) -> DataFrame:
    try:
        return read()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(path) from e
        raise


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = ENTITY) -> DataFrame:
    """Tab-separated with a header; every column a string, missing-value literals null. A missing path raises FileNotFoundError."""
    reader = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("multiLine", False)
    df = _must_exist(path, lambda: reader.csv(path))
    return df.select(*[na_to_null(F.col(c)).alias(c) for c in df.columns])


def load_split(spark: SparkSession, folder: str, split: str) -> tuple[DataFrame, ...]:
    """The three sources of a split, and for 'train' the ground truth too."""
    sources = [read_tsv(spark, f"{folder}/{split}_source{i}.tsv") for i in (1, 2, 3)]
    return (*sources, read_tsv(spark, f"{folder}/train_ground_truth.tsv", MATCHES)) if split == "train" else tuple(sources)


def columns_of(spark: SparkSession, path: str) -> list[str]:
    """Names in the header of a tab-separated file. A missing path raises FileNotFoundError."""
    return _must_exist(path, lambda: spark.read.option("sep", "\t").option("header", True).csv(path)).columns


def resolve_pair_columns(columns: list[str]) -> tuple[str, str]:
    found = [next((a for a in names if a in columns), None) for names in (REFERENCE_ALIASES, TARGET_ALIASES)]
    if None in found:
        raise RuntimeError(f"no pair columns among {columns}")
    return found[0], found[1]


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Two string columns under their canonical names, whatever accepted names the file has; other columns are pruned."""
    s, t = resolve_pair_columns(columns_of(spark, path))
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    return df.select(F.col(s).cast("string").alias("source1_entity_id"), F.col(t).cast("string").alias("candidate_entity_id"))


def write_tsv(df: DataFrame, path: str) -> None:
    _write(df, path, "\t")


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """Delimited text with a header, quoted where needed, in one file; for a summary, such as that of a sweep."""
    _write(df.coalesce(1), path, sep)


def _write(df: DataFrame, path: str, sep: str) -> None:
    df.write.mode("overwrite").option("sep", sep).option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)


def checkpointed(spark: SparkSession, path: str, build, force: bool = False) -> DataFrame:
    """The table at path if it is there and force is off; else built, written and read back. Only a path that isn't there counts as
    absent: a table that can't be read is an error, and one that is there is taken as it is, however old."""
    if not force:
        try:
            return _must_exist(path, lambda: spark.read.parquet(path))
        except FileNotFoundError:
            pass
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def save_model(model, path: str, features: list[str], threshold: float = 0.5) -> None:
    model.write().overwrite().save(path + "/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps({"features": features, "threshold": threshold}),)], "value string").coalesce(1).write.mode("overwrite").text(path + "/meta")


def load_model(path: str):
    """(model, features, threshold); a file without a threshold has 0.5."""
    from pyspark.ml import PipelineModel

    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.text(path + "/meta").head()[0])
    return PipelineModel.load(path + "/model"), meta["features"], meta.get("threshold", 0.5)
