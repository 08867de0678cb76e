"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import centroids, chat, covertree, decontaminate, filteraudit, langid, licenses, linededup
from ledgerloom.llm import minhash, packing, pii, sharding, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op6_cover_tree_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return covertree.embedding_links(_table(spark, sf_dir, "embeddings"), cosine=0.9)


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op9_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the fixed word is for trial tables alone: with real data the setting has to be given
    key = spark.conf.get(pii.KEY_SETTING, "a key of your own")
    return pii.counted(_table(spark, sf_dir, "documents"), key)


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=3, percent=85)


def op1_karmarkar_karp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_byte_network_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op3_grammar_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_relational_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    own = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.format_conversations(rows))


def op5_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_by_bytes(_table(spark, sf_dir, "documents"), shards=40)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.centroid_clusters(_table(spark, sf_dir, "embeddings"))


def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.without_frequent_lines(_table(spark, sf_dir, "documents"), least=10)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit_filters(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_karmarkar_karp_packing,
        op2_byte_network_language_id,
        op3_grammar_toxicity,
        op4_relational_chat_formatting,
        op5_minimax_sharding,
        op6_cover_tree_near_dedup,
        op7_license_scan,
        op8_benchmark_decontamination,
        op9_feistel_pii,
        op10_minhash_near_dedup,
        op11_centroid_clustering,
        op12_line_dedup,
        op13_filter_audit,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run

#: Every mark costs its own length; escapes cost a character for each backslash and control string.
_OP4_SQL = r"""
with rows as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all values
        (-7, 0, 'user', '\### Assistant: </turn> ok'),
        (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), placed as (
    select *, lag(role) over (partition by conv_id order by turn, role, text) as before from rows
), sized as (
    select *,
        length(regexp_replace(replace(text, '\', '\\'), '<(turn>|says/>|next/>|/turn>)', '<_\1', 'g')) as chars,
        case when before = role then length('<next/>') else length('<turn><says/></turn>') + length(role) end as marks
    from placed
)
select conv_id,
    count(*)::bigint as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(chars + marks)::bigint as formatted_chars
from sized group by conv_id
"""

#: All pairs, and who is reached through links.
_OP6_SQL = """
with recursive whole as materialized (
    select vec_id, embedding::double[] as e from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), sized as materialized (
    select vec_id, e, list_inner_product(e, e) as square from whole where len(e) > 0
), links as materialized (
    select a.vec_id as x, b.vec_id as y from sized a join sized b on len(a.e) = len(b.e) and a.vec_id <> b.vec_id
    where a.square > 0 and b.square > 0 and list_inner_product(a.e, b.e) >= 0.9 * sqrt(a.square) * sqrt(b.square)
), reach(x, y) as (
    select x, y from links union select r.x, l.y from reach r join links l on l.x = r.y
), least_of as (
    select x, min(y) as y from reach group by x
), counts as (
    select x, count(*) as n from links group by x
)
select vec_id, coalesce(n, 0)::bigint as n_links, least(vec_id, coalesce(m.y, vec_id)) as component_id,
    least(vec_id, coalesce(m.y, vec_id)) = vec_id as kept
from embeddings left join counts c on c.x = vec_id left join least_of m on m.x = vec_id
"""

ORACLES: dict[str, str] = {
    "op4_relational_chat_formatting": _OP4_SQL,
    "op6_cover_tree_near_dedup": _OP6_SQL,
    "op11_centroid_clustering": centroids.SQL,
    "op12_line_dedup": linededup.SQL,
    "op13_filter_audit": filteraudit.SQL,
}
