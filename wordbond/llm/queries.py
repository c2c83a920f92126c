"""The numbered operators as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..workspace import Workspace
from . import (
    bpe, chat, codes, exact_dedup, lm_scoring, neighbours, packing, quality, sharding, simhash, token_files,
    toxicity, va_clustering, vector_sql,
)
from .batches import small_batches
from .shipping import share_import_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_import_path(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"), Workspace(spark))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"), Workspace(spark))


def op3_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest_neighbours(_table(spark, sf_dir, "embeddings"), Workspace(spark))


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), stored=True
    )


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    folder = Workspace(spark).new_path("token-files")
    token_files.write_token_files(docs, folder, public_tokenizers.path("word_bpe_49k.json"))
    return token_files.read_token_files(spark, folder, docs.select("doc_id"))


def op6_label_propagation_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, sf_dir, "documents"), Workspace(spark))


def op7_cross_entropy_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target are the documents labelled as of good quality."""
    good = _table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    docs = _table(spark, sf_dir, "documents")
    return lm_scoring.score_documents(docs, good, Workspace(spark), stored=True)


def op8_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, _table(spark, sf_dir, "labels"), Workspace(spark))
    scored = toxicity.score_toxicity(docs, model)
    return scored.select("doc_id", toxicity.held_out("doc_id").alias("held_out"), "score", "predicted")


def op9_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    workspace = Workspace(spark)
    conversations = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = F.lit("</s>[INST] ok [/INST]")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint"), "id", F.when(F.col("id") == 0, "user").otherwise("assistant"), control
    )
    made = workspace.store(chat.windows(conversations.union(extra), workspace), "windows")
    return chat.digests(made)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(
        _table(spark, sf_dir, "documents"), Workspace(spark), public_tokenizers.path("word_bpe_49k.json")
    )


def op11_boosted_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, workspace = _table(spark, sf_dir, "documents"), Workspace(spark)
    forest = quality.fit_quality(docs, _table(spark, sf_dir, "labels"), workspace)
    with small_batches(spark):
        return workspace.store(quality.judge_quality(docs, forest), "judged")


def op12_limb_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compress_vectors(_table(spark, sf_dir, "embeddings"), Workspace(spark))


def op13_va_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_clustering.cluster_vectors(_table(spark, sf_dir, "embeddings"), Workspace(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_projected_neighbours": op3_projected_neighbours,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_token_files": op5_token_files,
    "op6_label_propagation_shards": op6_label_propagation_shards,
    "op7_cross_entropy_difference": op7_cross_entropy_difference,
    "op8_crf_toxicity": op8_crf_toxicity,
    "op9_chat_windows": op9_chat_windows,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_boosted_quality": op11_boosted_quality,
    "op12_limb_codes": op12_limb_codes,
    "op13_va_centroids": op13_va_centroids,
}

SQL: dict[str, str] = {
    "op2_exact_dedup": f"""
        WITH bodies AS (
          SELECT doc_id, translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}') AS body
          FROM documents
        ), groups AS (
          SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM bodies GROUP BY body
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM bodies JOIN groups USING (body)""",
    "op9_chat_windows": rf"""
        WITH turns AS (
          SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
          UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), counted AS (
          SELECT *, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) + 1 AS tokens FROM turns
        ), numbered AS (
          SELECT *, row_number() OVER w - 1 AS number, sum(tokens) OVER w - tokens AS start
          FROM counted WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING)
        ), sized AS (
          SELECT *, coalesce(max(CASE WHEN number = 0 AND role = 'system' THEN tokens END)
                             OVER (PARTITION BY conv_id), 0) AS system
          FROM numbered
        ), ruled AS (
          SELECT *, greatest(1, ({chat.BUDGET} - {chat.HISTORY} - system) // 2) AS cell_size FROM sized
        ), placed AS (
          SELECT *, min(number) OVER (PARTITION BY conv_id, start // cell_size, tokens > cell_size) AS first,
            length(regexp_replace(regexp_replace(text, '<(\\*)(/?s)>', '<\\\1\2>', 'g'),
                                  '\[(\\*)(/?INST)\]', '[\\\1\2]', 'g'))
              + CASE WHEN role = 'assistant' THEN {1 + len(chat.END)}
                     ELSE {len(chat.OPEN) + len(chat.CLOSE) + 1} + length(role) END AS shown
          FROM ruled
        ), begins AS (
          SELECT conv_id, first, start AS begin FROM placed WHERE number = first AND first > 0
        ), repeated AS (
          SELECT p.conv_id, p.shown FROM begins b JOIN placed p ON p.conv_id = b.conv_id AND (
            (p.number = 0 AND p.system > 0)
            OR (p.number BETWEEN b.first - {chat.HISTORY_TURNS} AND b.first - 1
                AND b.begin - p.start <= {chat.HISTORY}))
        ), chars AS (
          SELECT conv_id, sum(n) AS formatted_chars FROM (
            SELECT conv_id, shown + CASE WHEN number = first THEN {len(chat.BEGIN)} ELSE 0 END AS n FROM placed
            UNION ALL SELECT conv_id, shown FROM repeated
          ) GROUP BY conv_id
        ), said AS (
          SELECT conv_id, count(*) AS n_turns,
            string_agg(role || chr(10) || text || chr(10), '' ORDER BY number) AS turns,
            coalesce(string_agg(text, '' ORDER BY number) FILTER (role = 'assistant'), '') AS learnt
          FROM placed GROUP BY conv_id
        )
        SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(learnt) AS loss_chars,
               sha256(learnt) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars
        FROM said JOIN chars USING (conv_id)""",
    "op12_limb_codes": vector_sql.compressed(),
    "op13_va_centroids": vector_sql.clustered(),
}
