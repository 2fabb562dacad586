"""Registered queries of the subpackage: each applies one operator, with production
parameters, to its whole table. SQL stands beside the queries it can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import (clusters, conversations, katz, langid, licenses, mixing, near_dup, packing, quality_model, quality_rules, token_counts,
                        topk, warc)
from tarmac.llm import oracle as O
from tarmac.llm.common import held_out, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _held_out():
    return held_out(F.col("doc_id")).alias("held_out")


@query("op1_language_id")
def op1(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs), _held_out())


@query("op2_token_counts")
def op2(spark, sf_dir):
    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


@query("op3_packing")
def op3(spark, sf_dir):
    return packing.pack(spark, read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op4_warc", O.WARC)
def op4(spark, sf_dir):
    return warc.archive_round_trip(spark, read(spark, sf_dir, "pages"))


@query("op5_topk", O.TOPK)
def op5(spark, sf_dir):
    return topk.top_k(spark, read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op6_quality")
def op6(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return quality_model.predict(docs, quality_model.train(docs, read(spark, sf_dir, "labels")), _held_out())


@query("op7_near_dup")
def op7(spark, sf_dir):
    return near_dup.near_duplicates(spark, read(spark, sf_dir, "documents")).select("doc_id", "class_id")


@query("op8_mixing", O.MIXING)
def op8(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_quality_rules", O.RULES)
def op9(spark, sf_dir):
    return quality_rules.judge(read(spark, sf_dir, "documents")).drop("rejected_by")


@query("op10_license_scan", O.LICENSES)
def op10(spark, sf_dir):
    return licenses.scan(spark, read(spark, sf_dir, "documents"))


@query("op11_katz")
def op11(spark, sf_dir):
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5
    docs = read(spark, sf_dir, "documents")
    model, scored = katz.train_and_score(spark, docs, fold != 1)
    return scored.select("doc_id", F.coalesce(fold == 1, F.lit(False)).alias("held_out"), "n_tokens", "n_known",
                         F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


@query("op12_clusters", O.CLUSTERS)
def op12(spark, sf_dir):
    return clusters.cluster(spark, read(spark, sf_dir, "embeddings"))


@query("op13_conversations", O.REPAIR)
def op13(spark, sf_dir):
    return conversations.report(conversations.damaged(read(spark, sf_dir, "conversations")))


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
