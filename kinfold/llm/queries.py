"""Queries of the problems whose operators live in this subpackage, and their SQL."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.unpack import unpack
from ..sources.tables import table
from . import components, languages, link, name_variants, packing, same_address, terms, tokenize

FIELDS = ["business_name", "business_address"]


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return name_variants.variant_pairs(table(spark, d, "test_source1"))


def p2_groups(spark: SparkSession, d: str) -> DataFrame:
    return name_variants.name_groups(table(spark, d, "test_source1")).select(F.col("id").alias("entity_id"), "group_id").distinct()


def p3_terms(spark: SparkSession, d: str) -> DataFrame:
    s2 = table(spark, d, "test_source2")
    return terms.marked(terms.ngram_counts(s2, FIELDS, sigma=2), s2).select("field", "term", "n", "cf", "df", "mark")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return p3_terms(spark, d).where("n = 1 and mark is not null").select("field", "term", "mark")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "train_matches")
    links = unpack(m, "source1_entity_id", "matched_entity_ids")
    comp = components.connected_components(links, "source1_entity_id", "value", m.select("source1_entity_id"))
    return comp.select(F.col("node").alias("entity_id"), F.col("component").alias("group_id"))


def p4_group_sizes(spark: SparkSession, d: str) -> DataFrame:
    return p4_found(spark, d).groupBy("group_id").agg(F.count(F.lit(1)).alias("n_ids"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return same_address.same_building_pairs(table(spark, d, "test_source1"))


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    return same_address.address_groups(table(spark, d, "test_source1")).select(F.col("id").alias("entity_id"), "group_id").distinct()


def _sources(spark: SparkSession, d: str) -> tuple[DataFrame, list[DataFrame]]:
    return table(spark, d, "test_source1"), [table(spark, d, "test_source2"), table(spark, d, "test_source3")]


def p6_confidence(spark: SparkSession, d: str) -> DataFrame:
    return link.match(*_sources(spark, d), least=link.ACCEPT)


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return p6_confidence(spark, d).select("source1_entity_id", "target_entity_id")


def p6_rounds(spark: SparkSession, d: str) -> DataFrame:
    return link.settling(*_sources(spark, d))


def p8_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokenize.encode(table(spark, d, "documents"))


def p8_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, digest): a digest of each document's text as its ids decode, an empty one for a null text."""
    docs = table(spark, d, "documents").select("doc_id", "text")
    return tokenize.decode(tokenize.encode(docs)).select("doc_id", F.md5("text").alias("digest"))


def p9_assignments(spark: SparkSession, d: str) -> DataFrame:
    sizes = tokenize.encode(table(spark, d, "documents"), counts_only=True)
    return packing.pack(sizes, table(spark, d, "container_sizes"))


def p9_unused(spark: SparkSession, d: str) -> DataFrame:
    return packing.bin_report(p9_assignments(spark, d))


def p9_checks(spark: SparkSession, d: str) -> DataFrame:
    return packing.checked(p9_assignments(spark, d))


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return languages.relabelled(table(spark, d, "documents"), table(spark, d, "lang_codes"))


def p10_languages(spark: SparkSession, d: str) -> DataFrame:
    return languages.detect(table(spark, d, "documents"), table(spark, d, "lang_codes"))


def p10_segments(spark: SparkSession, d: str) -> DataFrame:
    return languages.segments(table(spark, d, "documents"), table(spark, d, "lang_codes"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    fs = [
        p2_found, p2_groups, p3_found, p3_terms, p4_found, p4_group_sizes, p5_found, p5_groups, p6_found, p6_confidence, p6_rounds, p8_ids,
        p8_round_trip, p9_assignments, p9_unused, p9_checks, p10_found, p10_languages, p10_segments,
    ]
    return {f.__name__: f for f in fs}


_TOKENS = """toks as (
  select 'business_name' as field, string_split(trim(regexp_replace(lower(business_name), '[^a-z0-9]+', ' ', 'g')), ' ') as t from test_source2
  where business_name is not null and lower(trim(business_name)) not in ('', 'na', 'n/a', 'null', 'none')
  union all
  select 'business_address', string_split(trim(regexp_replace(lower(business_address), '[^a-z0-9]+', ' ', 'g')), ' ') from test_source2
  where business_address is not null and lower(trim(business_address)) not in ('', 'na', 'n/a', 'null', 'none')
), numbered as (select row_number() over () as r, field, t from toks),
one as (select r, field, unnest(t) as term from numbered),
two as (select r, field, unnest([t[i] || ' ' || t[i + 1] for i in range(1, len(t))]) as term from numbered where len(t) > 1),
alls as (select r, field, term, 1 as n from one where term <> '' union all select r, field, term, 2 from two),
counts as (select field, term, n, count(*) as cf, count(distinct r) as df from alls group by all),
marked as (select field, term, cast(n as bigint) as n, cf, df,
  case when df = 1 then 'too_rare' when df > 0.01 * (select count(*) from test_source2) then 'too_common' end as mark from counts)"""
_LINKS = r"""raw as (select distinct source1_entity_id as s, matched_entity_ids as m from train_matches),
links as (select s, rtrim(unnest(regexp_extract_all(m, 'S[0-9]-[0-9]+(?:[,/][0-9]+[A-Z]?["''])?')), '"''') as v from raw where m is not null)"""

_GROUPS = f"""with recursive {_LINKS},
edges as (select s as a, v as b from links union select v, s from links),
nodes as (select s as id from raw where s is not null union select v from links),
reach(id, to_id) as (select id, id from nodes union select reach.id, edges.b from reach join edges on reach.to_id = edges.a),
found as (select id as entity_id, min(to_id) as group_id from reach group by id)"""


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": f"with {_TOKENS} select field, term, mark from marked where n = 1 and mark is not null",
        "p3_terms": f"with {_TOKENS} select field, term, n, cf, df, mark from marked",
        "p4_found": f"{_GROUPS} select entity_id, group_id from found",
        "p4_group_sizes": f"{_GROUPS} select group_id, count(*) as n_ids from found group by group_id",
        "p9_checks": "select container, (select count(distinct doc_id) from documents) as n_docs, 0::bigint as n_overfull, 0::bigint as n_torn from container_sizes where capacity > 0",
        "p8_round_trip": "select doc_id, md5(coalesce(text, '')) as digest from documents",
    }
