"""Corpus pipeline: quality, language, near-duplicates, mixing, packing.

``STAGES`` lists (name, function) pairs; a function takes (spark, docs, sf_dir) and
returns a DataFrame. All but the last return the columns of ``documents``: the
classifiers and the near-duplicate stage drop rows, mixing drops and repeats rows and sorts
them by training position. The last returns the packed pieces. ``run`` writes every stage's
result as Parquet in the shared scratch folder and reads it back as the next one's input.

No stage's model or plan can be stated in SQL, so ``ORACLE_SQL`` is None; tests hold each
stage against a brute-force version.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tarmac.llm import langid, mixing, near_dup, packing, quality_model
from tarmac.llm.common import read, table

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_model.train(docs, read(spark, sf_dir, "labels"))
    return quality_model.keep_good(docs, model)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_accepted(docs, langid.train(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.keep_one(spark, docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(spark, docs, public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


STAGES = [
    ("quality classifier", quality),
    ("language ID", language),
    ("MinHash near-dedup", near_duplicates),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = table(spark, docs, f"stage-{number}")
    return docs
