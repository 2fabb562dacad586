"""Long spans, repeated ids and characters beyond ASCII in the training-data operators."""

import zlib

import numpy as np
import public_tokenizers as P
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarmac.llm import langid, licenses, near_dup, packing, quality_model, token_counts, warc
from tarmac.llm.blocks import span_hashes

PATHS = (P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken"), P.PATTERN)
A, B, C = ("a" * 8192, "b" * 8192, "ab" * 4096)
SWAPPED = [A + B, B + A, A + B + C, C + B + A, B + C + A, A + A + B, A + B + A]


def test_spans_that_swap_pieces_have_their_own_hashes():
    data = np.frombuffer((" " + " ".join(SWAPPED) + " ").encode(), np.uint8)
    space = np.flatnonzero(data == 32)
    got = span_hashes(data, space[:-1] + 1, space[1:])
    assert len(set(got.tolist())) == len(SWAPPED)


def test_swapped_pieces_are_packed_and_counted_as_they_are(spark):
    docs = spark.createDataFrame(list(enumerate(SWAPPED)), "doc_id long, text string")
    whole = Tokenizer.from_file(PATHS[0])
    ids = {i: [*whole.encode(t, add_special_tokens=False).ids, 0] for i, t in enumerate(SWAPPED)}
    for r in packing.pack(spark, docs, *PATHS).collect():
        piece = ids[r.doc_id][r.start:r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and r.ids_crc32 == zlib.crc32(np.array(piece, "<u4").tobytes())
    together = {r.doc_id: r.n_tokens for r in token_counts.token_counts(docs, PATHS[1]).collect()}
    alone = {i: token_counts.token_counts(docs.filter(F.col("doc_id") == i), PATHS[1]).first().n_tokens for i in (0, 1)}
    assert {i: together[i] for i in alone} == alone


def test_swapped_pieces_are_no_copies(spark):
    docs = spark.createDataFrame(list(enumerate(SWAPPED[:2])) + [(7, SWAPPED[0])], "doc_id long, text string")
    classes = {r.doc_id: r.class_id for r in near_dup.near_duplicates(spark, docs).collect()}
    assert classes == {0: 0, 1: 1, 7: 0}


def test_samples_of_one_repeated_id_are_bounded(spark):
    learn = [i for i in range(20) if zlib.crc32(str(i).encode()) % 4 != 2][:8]
    rows = spark.range(20_000).select(F.lit(learn[0]).cast("long").alias("doc_id"), F.concat(F.lit("word number "), F.col("id")).alias("text"),
                                      F.lit("en").alias("lang"))
    few = spark.createDataFrame([(i, f"mot {i} et {j}", "fr") for i in learn[1:] for j in range(3)], "doc_id long, text string, lang string")
    docs = rows.unionByName(few)
    sample = langid.training_sample(docs, sample_docs=200).groupBy("lang").count().collect()
    assert {r["lang"] for r in sample} == {"en", "fr"} and all(r["count"] <= 200 for r in sample)
    labels = spark.createDataFrame([(i, 1) for i in learn], "doc_id long, quality int")
    assert quality_model.training_sample(docs, labels, 150, 5).count() <= 300
    pages = rows.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))
    assert len(warc.build_dictionary(pages, sample_records=20)) > 0


def test_many_labels_and_any_label_are_learned(spark):
    learn = [i for i in range(8000) if zlib.crc32(str(i).encode()) % 4 != 2]
    rows = [(i, f"text {'abcdefgh'[i % 8] * 6}", ["", "und", *(f"l{k}" for k in range(1000))][n % 1002]) for n, i in enumerate(learn)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = langid.training_sample(docs, sample_docs=2004)
    assert sample.select("lang").distinct().count() == 1002


def test_kelvin_sign_is_no_k(spark):
    docs = spark.createDataFrame([(1, "GENERAL PUBLIC LICENSE"), (2, "General Public LicenKe"), (3, "all rights reserved K")], "doc_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_base) for r in licenses.scan(spark, docs).collect()}
    assert got == {1: (3, 1), 2: (3, 0), 3: (4, 1)}
    words = docs.select(licenses.text_words(F.lit("worK WORK")).alias("w")).first().w
    assert words == ["worK", "work"]
