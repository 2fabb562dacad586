"""Quality classifier: hashed word n-grams, logistic regression by FTRL-proximal.

Tokens are the maximal runs of word bytes (ASCII letters and digits, bytes of
multi-byte characters) or of symbol bytes; features are the token unigrams and
bigrams, hashed into ``buckets``; a bigram whose second token repeats one of the two
tokens before it is hashed as one shared feature, so stuttering is learned once. A feature's value is its share of the text's n-grams
times ``GAIN``, so a score is one sparse dot product and does not grow with length.
The weights are trained by follow-the-regularised-leader (proximal, per-coordinate
rates, L1 and L2) in numpy on a bounded sample of labelled texts (``sample_docs``,
drawn by a hash of the id in proportion to the labels).

Scoring sums fixed-point weights over a text's n-grams block by block: exact in any
order, bounded memory, whole texts.

Defined cases: null, empty and token-free texts get the model's bias as score; without
a labelled row the score is 0.5. A document with several labels counts as low quality
if any of them is 0; null labels are not learned. Repeated rows score alike. Extra
columns are ignored; ``keep_good`` passes them through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.llm.blocks import blocks, runs, span_hashes, text_bytes
from tarmac.llm.common import draw, learnable, map_arrow

BUCKETS = 1 << 18
SAMPLE_DOCS = 4000
EPOCHS = 3
GAIN = 32.0
THRESHOLD = 0.7
SCALE = 1 << 20

# Token classes: 0 white space and control bytes, 1 word bytes, 2 symbols.
_CLASS = np.zeros(256, np.uint8)
_CLASS[0x21:0x7F] = 2
for _lo, _hi in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B), (0x80, 0x100)):
    _CLASS[_lo:_hi] = 1
# The bigram of a token that repeats one of the two before it, whatever the token.
_REPEATED = np.uint64(0x2545F4914F6CDD1D)


@dataclass
class QualityModel:
    weights: np.ndarray  # (buckets,), fixed point
    bias: float
    threshold: float = THRESHOLD


def _ngrams(data: np.ndarray, starts: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, bucket) of every token unigram and bigram of a block."""
    first, last = runs(_CLASS[data])
    h = span_hashes(data, first, last)
    piece = np.searchsorted(starts, first, "right") - 1
    same = piece[1:] == piece[:-1]
    pair = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ (h[1:] + np.uint64(0x632BE59BD9B4E019)))[same]
    again = h[1:] == h[:-1]
    again[1:] |= (h[2:] == h[:-2]) & (piece[2:] == piece[:-2])
    pair = np.where(again[same], _REPEATED, pair * np.uint64(0xFF51AFD7ED558CCD))
    shift = np.uint64(64 - int(buckets).bit_length() + 1)
    return (np.concatenate((piece, piece[1:][same])),
            (np.concatenate((h * np.uint64(0xC4CEB9FE1A85EC53), pair)) >> shift).astype(np.int64))


def _features(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, shares = [], []
        for raw in text_bytes(batch.column("text")):
            found = [_ngrams(data, starts, buckets)[1] for _, data, starts in blocks([raw])]
            used, counts = np.unique(np.concatenate(found or [np.zeros(0, np.int64)]), return_counts=True)
            ids.append(used.astype(np.uint32).tobytes())
            shares.append((counts / max(1, counts.sum())).astype(np.float32).tobytes())
        yield pa.record_batch([batch.column("quality"), batch.column("order"), pa.array(ids, pa.binary()),
                               pa.array(shares, pa.binary())], names=["quality", "order", "ids", "shares"])


def training_sample(docs: DataFrame, labels: DataFrame, sample_docs: int, seed: int) -> DataFrame:
    """About ``sample_docs`` labelled texts, drawn by a hash of the id, twice as many at most: if one id
    has thousands of rows, those with the least hash of id and text stay."""
    usable = learnable(F.col("doc_id"))
    known = (labels.select("doc_id", "quality").filter(usable & F.col("quality").isNotNull())
             .groupBy("doc_id").agg(F.min(F.col("quality").cast("int")).alias("quality")))
    rate = min(1.0, sample_docs / max(1, known.count()))
    drawn = known.filter(draw(F.col("doc_id"), seed) < rate)
    texts = docs.select("doc_id", "text").filter(usable & F.col("text").isNotNull() & (draw(F.col("doc_id"), seed) < rate))
    return (texts.join(drawn, "doc_id").withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "text"))
            .orderBy("order", "quality").limit(2 * sample_docs))


def _example(row, buckets: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Label, features (the last one is the bias) and their values of a sampled text."""
    return (1.0 if row["quality"] == 1 else 0.0,
            np.append(np.frombuffer(row["ids"], np.uint32).astype(np.int64), buckets),
            np.append(np.frombuffer(row["shares"], np.float32) * GAIN, 1.0))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, buckets: int = BUCKETS,
          epochs: int = EPOCHS, alpha: float = 0.2, beta: float = 1.0, l1: float = 0.05, l2: float = 0.1,
          seed: int = 5) -> QualityModel:
    """Fit on the bounded sample; its hashed counts (not its texts) reach the driver, which holds them as
    sent and widens one text's at a time."""
    rows = (training_sample(docs, labels, sample_docs, seed).select("quality", "order", "text")
            .transform(map_arrow, lambda it: _features(it, buckets), "quality int, order long, ids binary, shares binary").collect())
    rows.sort(key=lambda r: (r["order"], r["quality"]))
    z, n = np.zeros(buckets + 1), np.zeros(buckets + 1)
    rng = np.random.RandomState(seed)

    def weights(ids):
        at = z[ids]
        penalty = np.where(ids == buckets, 0.0, l1)
        return np.where(np.abs(at) <= penalty, 0.0,
                        -(at - np.sign(at) * penalty) / ((beta + np.sqrt(n[ids])) / alpha + l2))

    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            y, ids, x = _example(rows[i], buckets)
            w = weights(ids)
            g = (1.0 / (1.0 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            squared = n[ids] + g * g
            z[ids] += g - (np.sqrt(squared) - np.sqrt(n[ids])) / alpha * w
            n[ids] = squared
    w = weights(np.arange(buckets + 1))
    return QualityModel(np.rint(w[:-1] * SCALE).astype(np.int64), float(w[-1]))


def scores(column: pa.Array, model: QualityModel) -> np.ndarray:
    """Probability of label 1 of each text of an Arrow column."""
    texts = text_bytes(column)
    total, grams = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for rows, data, starts in blocks(texts):
        piece, bucket = _ngrams(data, starts, len(model.weights))
        # float64 sums of integers below 2**53: exact, and in any order
        got = np.bincount(piece, weights=model.weights[bucket], minlength=len(rows))
        np.add.at(total, rows, got.astype(np.int64))
        np.add.at(grams, rows, np.bincount(piece, minlength=len(rows)))
    margin = total / (SCALE * np.maximum(1, grams)) * GAIN + model.bias
    return 1.0 / (1.0 + np.exp(-np.clip(margin, -35, 35)))


def predict(docs: DataFrame, model: QualityModel, *keep: Column) -> DataFrame:
    """doc_id, the ``keep`` columns, score and predicted for every row."""
    def score(batches):
        for batch in batches:
            p = scores(batch.column("text"), model)
            labels = [n for n in batch.schema.names if n != "text"]
            yield pa.record_batch([*(batch.column(n) for n in labels), pa.array(p, pa.float64()),
                                   pa.array((p >= model.threshold).astype(np.int32))],
                                  names=[*labels, "score", "predicted"])

    narrow = docs.select("doc_id", *keep, F.col("text").cast("string").alias("text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema if f.name != "text")
    return narrow.transform(map_arrow, score, f"{fields}, score double, predicted int")


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of ``docs`` (all columns) that the model predicts as good."""
    def passed(batches):
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column("text"), model) >= model.threshold))

    return docs.transform(map_arrow, passed, docs.schema)
