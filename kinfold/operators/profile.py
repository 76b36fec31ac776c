"""Profiles of sources and ground truth."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import na_to_null, normalize


def missing_values(sources: dict[str, DataFrame]) -> DataFrame:
    """(source, n_rows, and the missing values of each column), one pass per source."""
    out = None
    for name, df in sources.items():
        miss = [F.sum(F.when(na_to_null(F.col(c)).isNull(), 1).otherwise(0)).alias(c) for c in ("entity_id", "business_name", "business_address", "country")]
        row = df.agg(F.count(F.lit(1)).alias("n_rows"), *miss).withColumn("source", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


def duplicate_ids(sources: dict[str, DataFrame]) -> DataFrame:
    """(source, n_rows, n_duplicates): rows beyond the first of their id."""
    out = None
    for name, df in sources.items():
        per = df.groupBy("entity_id").agg(F.count(F.lit(1)).alias("n"))
        row = per.agg(F.sum("n").alias("n_rows"), F.sum(F.col("n") - 1).alias("n_duplicates")).withColumn("source", F.lit(name))
        out = row if out is None else out.unionByName(row)
    return out


def match_counts(truth: DataFrame, references: DataFrame) -> DataFrame:
    """(source1_entity_id, n, n_s2, n_s3, match_type), references without a match included with 0."""
    t = truth.select("source1_entity_id", F.substring("target_entity_id", 1, 2).alias("p")).groupBy("source1_entity_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.when(F.col("p") == "S2", 1).otherwise(0)).alias("n_s2"), F.sum(F.when(F.col("p") == "S3", 1).otherwise(0)).alias("n_s3")
    )
    z = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    j = references.select("source1_entity_id").distinct().join(t, "source1_entity_id", "left").select("source1_entity_id", z("n"), z("n_s2"), z("n_s3"))
    kind = (
        F.when((F.col("n_s2") > 0) & (F.col("n_s3") > 0), "BOTH_S2_S3").when(F.col("n_s2") > 0, "S2_ONLY").when(F.col("n_s3") > 0, "S3_ONLY").otherwise("NONE")
    )
    return j.withColumn("match_type", kind)


def name_profile(df: DataFrame) -> DataFrame:
    """(country, name_norm, n): how often each non-empty normal name occurs in each country; rows without a country are in none."""
    c = df.select(na_to_null(F.col("country")).alias("country"), normalize(na_to_null(F.col("business_name"))).alias("name_norm"))
    return c.where("name_norm <> '' and country is not null").groupBy("country", "name_norm").agg(F.count(F.lit(1)).alias("n"))


def name_summary(df: DataFrame) -> DataFrame:
    """One row: empty names, names per country, rows with a name, rows of names that are alone in their country and of the others, with
    their shares of the rows with a name, and describe() of the counts."""
    rows = df.agg(
        F.count(F.lit(1)).alias("_all"), F.sum(F.when(normalize(na_to_null(F.col("business_name"))) == "", 1).otherwise(0)).alias("n_empty")
    ).select("n_empty", (F.col("_all") - F.col("n_empty")).alias("n_rows"))
    one = lambda x: F.sum(F.when(x, F.col("n")).otherwise(0))
    q = lambda x, n: F.round(F.percentile("n", F.lit(x)), 6).alias(n)
    c = name_profile(df).agg(
        F.count(F.lit(1)).alias("n_names"), one(F.col("n") == 1).alias("rows_unique"), one(F.col("n") > 1).alias("rows_duplicated"), F.round(F.avg("n"), 6).alias("mean"),
        F.round(F.stddev_samp("n"), 6).alias("std"), F.min("n").alias("least"), q(0.25, "p25"), q(0.5, "median"), q(0.75, "p75"), F.max("n").alias("most"),
    )
    share = lambda x: F.round(F.col(x) / F.nullif(F.col("n_rows"), F.lit(0)), 6)
    return rows.join(F.broadcast(c)).select("*", share("rows_unique").alias("share_unique"), share("rows_duplicated").alias("share_duplicated"))


def inspect(ref: DataFrame, tg: DataFrame, truth: DataFrame, ident: str) -> DataFrame:
    """The record `ident` and its true matches side by side: (role, entity_id, business_name, business_address, country)."""
    cols = ["entity_id", "business_name", "business_address", "country"]
    one = ref.where(F.col("entity_id") == ident).select(F.lit("reference").alias("role"), *cols)
    ids = truth.where(F.col("source1_entity_id") == ident).select(F.col("target_entity_id").alias("entity_id"))
    return one.unionByName(tg.join(ids, "entity_id", "left_semi").select(F.lit("match").alias("role"), *cols)).distinct()
