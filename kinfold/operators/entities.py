"""Prepared entities: normal forms and token sets of reference and target records."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..sources.tables import table
from .unpack import unpack


def prepare(df: DataFrame) -> DataFrame:
    """Distinct records (entity_id, name_norm, address_norm, country); missing literals are null, a null name or address is ''."""
    c = lambda n: X.na_to_null(F.col(n))
    return df.select(
        "entity_id", X.normalize(c("business_name")).alias("name_norm"), X.normalize(c("business_address")).alias("address_norm"), c("country").alias("country")
    ).distinct()


def reference(spark: SparkSession, d: str, split: str = "test") -> DataFrame:
    return prepare(table(spark, d, f"{split}_source1"))


def targets(spark: SparkSession, d: str, split: str = "test") -> DataFrame:
    """Both target sources with their provenance."""
    parts = [prepare(table(spark, d, f"{split}_source{i}")).withColumn("target_source", F.lit(f"S{i}")) for i in (2, 3)]
    return parts[0].unionByName(parts[1])


def truth(spark: SparkSession, d: str) -> DataFrame:
    """Distinct true pairs (source1_entity_id, target_entity_id)."""
    return unpack(table(spark, d, "train_matches"), "source1_entity_id", "matched_entity_ids", "target_entity_id").select(
        "source1_entity_id", "target_entity_id"
    ).distinct()


def tokens(df: DataFrame, kind, by_field: bool = True) -> DataFrame:
    """(entity_id, country, field, token) of both fields; distinct per field."""
    parts = [
        df.select("entity_id", "country", F.lit(f).alias("field"), F.explode(kind(F.col(f"{f}_norm"))).alias("token")) for f in ("name", "address")
    ]
    return parts[0].unionByName(parts[1])


def union_tokens(df: DataFrame, kind) -> DataFrame:
    """(entity_id, country, token) of name and address together, once each."""
    return df.select("entity_id", "country", F.explode(F.array_union(kind(F.col("name_norm")), kind(F.col("address_norm")))).alias("token"))


def sample(ids: DataFrame, column: str, n: int) -> DataFrame:
    """A fixed sample of n values: the least hashes, which no order of rows or partitions changes."""
    return ids.select(column).distinct().orderBy(F.md5(column), column).limit(n)
