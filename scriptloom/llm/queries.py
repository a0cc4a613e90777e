"""Registered queries of the training-data operators, and their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from scriptloom.llm import (
    line_dedup, nn_descent, packing, pivot_codes, prefix_trie, quality_rank, quality_rules, setsketch, sharding, token_rollup,
    token_store, toxicity, unigram,
)
from scriptloom.llm.twins import PIVOT_CODES, PREFIX_TRIE, SHARDING

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_token_store(spark: SparkSession, folder: str) -> DataFrame:
    return token_store.read_back(table(spark, folder, "documents"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.judged(table(spark, folder, "documents"))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_rollup.rolled_up(table(spark, folder, "documents"), restored=True)


def op4_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return nn_descent.linked(table(spark, folder, "embeddings"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.rated(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.deduplicated(table(spark, folder, "documents"))


def op7_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(table(spark, folder, "documents"))


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return unigram.encoded(table(spark, folder, "documents"), digest=True)


def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rank.scored(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return setsketch.near_duplicates(table(spark, folder, "documents"))


def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.rebuilt_nodes(table(spark, folder, "conversations"))


def op12_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.digests(table(spark, folder, "documents"))


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return pivot_codes.compressed(table(spark, folder, "embeddings"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_token_store, op2_quality_rules, op3_token_counts, op4_embedding_near_dedup, op5_toxicity, op6_line_dedup, op7_best_fit_packing, op8_sentencepiece, op9_quality_classifier,
    op10_minhash_near_dedup, op11_prefix_trie, op12_sharding, op13_vector_codes)}

#: DuckDB SQL for the same rows.
ORACLES: dict[str, str] = {
    "op6_line_dedup": r"""
with parts as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) as p
  from documents),
w as (
  select doc_id, line, p, row_number() over (partition by doc_id order by p) as r,
         len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) as n
  from parts where regexp_matches(line, '[^\x20\x09-\x0D]')),
c as (
  select *, sum(n) over (partition by doc_id order by r) as upto from w),
seqs as (select doc_id, list(line order by r) as ls from w group by doc_id),
runs as (
  select a.doc_id, a.r as s, b.r as e
  from c a join c b on a.doc_id = b.doc_id and b.r between a.r and a.r + 50
  where b.upto - a.upto + a.n >= 50 and (b.upto - a.upto + a.n - b.n < 50 or b.upto - a.upto < 50)),
named as (
  select doc_id, s, e, list_aggregate(list_slice(ls, s, e), 'string_agg', chr(10)) as name
  from runs join seqs using (doc_id)),
firsts as (select *, min((doc_id, s)) over (partition by name) as f from named),
gone as (
  select distinct doc_id, unnest(range(s, e + 1)) as r from firsts where (doc_id, s) > f),
kept as (
  select parts.doc_id, parts.p, parts.line, gone.r is not null as cut
  from parts left join w on w.doc_id = parts.doc_id and w.p = parts.p
  left join gone on gone.doc_id = w.doc_id and gone.r = w.r)
select d.doc_id,
  case when coalesce(k.n_deleted, 0) = 0 then d.text else coalesce(k.text, '') end as text,
  coalesce(k.n_lines, 0)::bigint as n_lines, coalesce(k.n_deleted, 0)::bigint as n_deleted
from documents d left join (
  select doc_id, string_agg(line, chr(10) order by p) filter (where not cut) as text,
    count(*) filter (where regexp_matches(line, '[^\x20\x09-\x0D]')) as n_lines, count(*) filter (where cut) as n_deleted
  from kept group by doc_id) k on k.doc_id = d.doc_id
""",
    "op11_prefix_trie": PREFIX_TRIE,
    "op12_sharding": SHARDING,
    "op13_vector_codes": PIVOT_CODES,
}
