"""Registered queries of the core and their SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import skew
from ..operators.unpack import unpack
from ..sources.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return skew.found_keys(table(spark, d, "test_source2"), "country")


def p1_country_stats(spark: SparkSession, d: str) -> DataFrame:
    return skew.key_stats(table(spark, d, "test_source2"), "country")


def p1_top_names(spark: SparkSession, d: str) -> DataFrame:
    return skew.top_per_key(table(spark, d, "test_source2"), "country", "business_name")


def p1_update_ranks(spark: SparkSession, d: str) -> DataFrame:
    return skew.rank_per_key(table(spark, d, "test_source2"), "country", "updated_at")


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return unpack(table(spark, d, "train_matches"), "source1_entity_id", "matched_entity_ids", "matched_entity_id")


def p7_values_per_record(spark: SparkSession, d: str) -> DataFrame:
    return p7_found(spark, d).groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("n_ids"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (p1_found, p1_country_stats, p1_top_names, p1_update_ranks, p7_found, p7_values_per_record)}


_UNPACK = r"""raw as (select distinct source1_entity_id as s, matched_entity_ids as m from train_matches),
lists as (select s, regexp_extract_all(m, 'S[0-9]-[0-9]+(?:[,/][0-9]+[A-Z]?["''])?') as l from raw where m is not null),
ids as (select s, unnest(range(1, len(l) + 1)) as pos, unnest(l) as v from lists)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": "select country from test_source2 where country is not null group by country having count(*) > 0.05 * (select count(*) from test_source2)",
        "p1_country_stats": """select country, count(*) as n_rows, count(business_name) as n_names, count(business_address) as n_addresses,
          count(distinct business_name) as n_distinct_names, min(updated_at) as first_update, max(updated_at) as last_update
          from test_source2 group by country""",
        "p1_top_names": """select country, business_name, n, rank from (select country, business_name, count(*) as n,
          row_number() over (partition by country order by count(*) desc, business_name) as rank
          from test_source2 where business_name is not null group by country, business_name) where rank <= 10""",
        "p1_update_ranks": """select country, updated_at, n, rank from (select country, updated_at, count(*) as n,
          1 + coalesce(sum(count(*)) over (partition by country order by updated_at rows between unbounded preceding and 1 preceding), 0)::bigint as rank
          from test_source2 where updated_at is not null group by country, updated_at)""",
        "p7_found": f"""with {_UNPACK} select s as source1_entity_id, pos, rtrim(v, '"''') as matched_entity_id from ids""",
        "p7_values_per_record": f"with {_UNPACK} select s as source1_entity_id, count(*) as n_ids from ids group by s",
    }
