"""Document frequencies of tokens over target records, in the scopes the strategies use."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as X
from .entities import tokens, union_tokens


def df_field(tg: DataFrame, kind=X.tokens_min1) -> DataFrame:
    """Per field, over all countries."""
    return tokens(tg, kind).groupBy("field", "token").agg(F.count(F.lit(1)).alias("df"))


def df_country_field(tg: DataFrame, kind=X.tokens_stop55) -> DataFrame:
    return tokens(tg, kind).where("country is not null").groupBy("country", "field", "token").agg(F.count(F.lit(1)).alias("df"))


def df_union(tg: DataFrame, kind=X.tokens_stop55) -> DataFrame:
    """Per country; a token of both fields of a record counts once."""
    return union_tokens(tg, kind).where("country is not null").groupBy("country", "token").agg(F.count(F.lit(1)).alias("df"))


def df_sum(tg: DataFrame, kind=X.tokens_stop55) -> DataFrame:
    """Per country; a token of both fields of a record counts twice."""
    return tokens(tg, kind).where("country is not null").groupBy("country", "token").agg(F.count(F.lit(1)).alias("df"))


def df_per_source(tg: DataFrame, kind=X.tokens_stop30) -> DataFrame:
    """Per target source and country, distinct records over both fields. Tokens are made distinct per record before they shuffle."""
    t = tg.select("target_source", "country", F.explode(F.array_union(kind(F.col("name_norm")), kind(F.col("address_norm")))).alias("token"))
    return t.where("country is not null").groupBy("target_source", "country", "token").agg(F.count(F.lit(1)).alias("df"))


def df_numbers(tg: DataFrame) -> DataFrame:
    t = tg.where("country is not null").select("country", F.explode(X.number_runs(F.col("address_norm"))).alias("token"))
    return t.groupBy("country", "token").agg(F.count(F.lit(1)).alias("df"))


def with_idf(df: DataFrame, tg: DataFrame) -> DataFrame:
    """ln((N + 1) / (df + 1)) + 1 with N the number of target records of all countries."""
    n = tg.agg(F.count(F.lit(1)).alias("_n"))
    return df.join(F.broadcast(n)).withColumn("idf", F.log((F.col("_n") + 1) / (F.col("df") + 1)) + 1).drop("_n")
