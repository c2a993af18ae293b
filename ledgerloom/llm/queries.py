"""Named queries of the text operators and, where SQL can express them, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontam, langid, media, neardup, pii, substrings, token_counts, token_files, toxicity
from .common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.digests(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return out.withColumnRenamed("id", "doc_id")


def op2_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digests(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).withColumnRenamed("id", "doc_id")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))
    return out.withColumnRenamed("id", "doc_id")


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).withColumnRenamed("id", "doc_id")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.passages(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_bpe, op2_media, op3_decontamination, op4_token_counts, op5_near_duplicates, op6_token_files, op7_pii, op8_toxicity, op9_substrings, op10_language)}

ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": r"""
with d as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (
  select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
p as (
  select distinct item_id, least(10, len(w)) as n, array_to_string(w[k : k + least(10, len(w)) - 1], ' ') as win
  from (select item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) as k from b where len(w) > 0)),
lens as (select distinct n from p),
dw as (
  select doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') as win
  from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as k from d, lens where len(w) >= n)),
h as (select doc_id, k, dw.n, item_id from dw join p on dw.n = p.n and dw.win = p.win),
hw as (select doc_id, count(distinct i) as n_hit from (select doc_id, unnest(range(k, k + n)) as i from h) group by doc_id),
hi as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, cast(item_id as varchar) as item from h) group by doc_id)
select d.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join hw using (doc_id) left join hi using (doc_id)""",
    "op5_near_duplicates": r"""
with recursive d as (
  select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
s as (
  select distinct doc_id, array_to_string(w[k : k + least(4, len(w)) - 1], ' ') as sh
  from (select doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) as k from d where len(w) > 0)),
n as (select doc_id, count(*) as n from s group by doc_id),
links as (
  select a, b from (select x.doc_id as a, y.doc_id as b, count(*) as i from s x join s y on x.sh = y.sh and x.doc_id < y.doc_id group by 1, 2)
  join n na on na.doc_id = a join n nb on nb.doc_id = b
  where 100 * i >= 80 * (na.n + nb.n - i)),
edges as (select a, b from links union all select b, a from links),
reach(doc_id, r) as (select a, a from edges union select e.b, reach.r from reach join edges e on e.a = reach.doc_id)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, coalesce(c.c, d.doc_id) as component_id, d.doc_id = coalesce(c.c, d.doc_id) as kept
from d left join n using (doc_id) left join (select doc_id, min(r) as c from reach group by doc_id) c using (doc_id)""",
}
