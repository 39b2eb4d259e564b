"""Thin queries ``opN_<name>`` that apply the corpus operators to their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from chronoloom.llm import alignment, bpe, decontaminate, licenses, pieces, quality, sharding, simhash, spelling, suffix, toolcalls, toxicity, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op1_quality_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op2_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results = toolcalls.turns_as_calls(_table(spark, sf_dir, "conversations"))
    linked = toolcalls.link_calls(calls, results, toolcalls.ASK)
    return linked.select("conv_id", "call_id", "position", "place", "n_results", "status", F.length("canonical").cast("long").alias("n_chars"), F.sha2("canonical", 256).alias("canonical_sha256"))


#: The same from the tables alone; turns are in order, so a call's place is its turn.
ORACLE_SQL["op2_tool_calls"] = """
with asked as (
  select conv_id, conv_id || ':' || turn as call_id, turn as position, text, length(text) as chars
  from conversations where role = 'user' and conv_id is not null and turn is not null),
replies as (
  select conv_id, conv_id || ':' || (turn - 1) as call_id, count(*) as n,
         arg_min(text, (turn, text)) as result
  from conversations where role = 'assistant' and conv_id is not null and turn is not null group by 1, 2),
linked as (
  select coalesce(a.conv_id, r.conv_id) as conv_id, coalesce(a.call_id, r.call_id) as call_id, a.position, a.position as place, coalesce(r.n, 0) as n_results,
         case when a.call_id is null then 'orphan' when a.text is null or a.chars < 1 then 'invalid'
              when r.call_id is null then 'unanswered' else 'linked' end as status,
         case when a.call_id is null then 'null'
              else '{' || concat_ws(',', '"chars":' || a.chars, '"text":' || to_json(a.text)) || '}' end as arguments,
         coalesce(to_json(r.result), 'null') as result, case when a.call_id is null then 'null' else '"ask"' end as name
  from asked a full join replies r on a.conv_id = r.conv_id and a.call_id = r.call_id),
lines as (
  select *, '{"arguments":' || arguments || ',"id":' || to_json(call_id) || ',"name":' || name || ',"result":' || result || '}' as line from linked)
select conv_id, call_id, cast(position as bigint) as position, cast(place as bigint) as place, n_results, status,
       cast(length(line) as bigint) as n_chars, sha256(line) as canonical_sha256
from lines
"""


@_query
def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(_table(spark, sf_dir, "documents"))


@_query
def op4_minimax_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"))


@_query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(_table(spark, sf_dir, "documents"))


@_query
def op6_pivot_cosine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.cosine_links(_table(spark, sf_dir, "embeddings"))


@_query
def op7_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(_table(spark, sf_dir, "documents"))


@_query
def op8_cgk_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminations(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_query
def op9_suffix_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.repeat_digests(_table(spark, sf_dir, "documents"))


@_query
def op10_toxicity_subwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, sf_dir, "documents"))


@_query
def op12_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(_table(spark, sf_dir, "documents"))


@_query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment_scores(_table(spark, sf_dir, "documents"))
