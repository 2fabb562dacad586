"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the average of the embeddings of its subwords: byte 2-, 3- and 4-grams of
its lower-cased words (a word is a run of letters; the grams may include one word
boundary at either end), hashed into ``buckets`` rows. A linear softmax on that
average gives language probabilities. Embeddings and softmax are trained together by
stochastic gradient descent in numpy on a bounded sample of labelled texts
(``sample_docs``, spread over the languages by a hash of the id). A slice of the
sample is left out to calibrate a temperature, fitted to its likelihood. The rejection
threshold on the calibrated probability is a quantile over all labelled texts that may be
learned from and are not in the sample (over the slice if there are none), low enough
that at most ``reject_share`` of those labelled rightly would be rejected.

The average and the softmax are linear, so scoring folds the embedding and the softmax
into one table of per-language integers (fixed point); sums over a text are exact in
any order and every run agrees.

Defined cases: a null text or one without a letter gets ``und``, score 0 and is
rejected. Null labels are not learned. Without any label to learn,
every text is ``und``. Repeated rows get the same answer each. Extra columns are
ignored; ``keep_accepted`` passes them through. Very long texts are read whole, block
by block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.blocks import blocks, text_bytes
from tarmac.llm.common import draw, learnable, map_arrow

BUCKETS = 1 << 15
SAMPLE_DOCS = 3200
DIM = 16
EPOCHS = 4
LEAST_STEPS = 6000
RATE = 0.5
REJECT_SHARE = 0.001
SCALE = 1 << 16
STEPS = 1 << 16  # of the probability, for the quantile
UNDEFINED = "und"

# Letters of the subword view: ASCII letters and every byte of a multi-byte character.
_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[0x80:] = True
_ANY_LETTER = r"\p{L}"


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray  # (buckets, languages), fixed point
    bias: np.ndarray
    temperature: float
    threshold: float


def _grams(data: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(start of each gram, bucket) for the byte 2-, 3- and 4-grams inside words."""
    letter = _LETTER[data]
    byte = np.where(letter, data, 32).astype(np.uint32)
    shift = np.uint32(32 - int(buckets).bit_length() + 1)
    h = byte
    inner = np.ones(len(byte), bool)
    for n in (2, 3, 4):
        if len(byte) < n:
            return
        h = h[:-1] * np.uint32(0x01000193) + byte[n - 1:]
        if n > 2:
            inner = inner[:-1] & letter[n - 2:len(letter) - 1]
            at = np.flatnonzero(inner)
        else:
            inner = inner[:-1]
            at = np.flatnonzero(letter[:-1] | letter[1:])
        yield at, ((h[at] ^ np.uint32(n * 0x9E37)) * np.uint32(0x9E3779B1)) >> shift


def _lowered(column: pa.Array) -> list[bytes]:
    return text_bytes(pc.utf8_lower(column.cast(pa.string())))


def _features(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Gram counts of each text as pairs of uint16 bucket and capped uint16 count bytes."""
    for batch in batches:
        texts = _lowered(batch.column("text"))
        ids, counts = [], []
        for raw in texts:
            total = np.zeros(buckets, np.int64)
            for _, data, _ in blocks([raw]):
                for _, h in _grams(data, buckets):
                    total += np.bincount(h, minlength=buckets)
            used = np.flatnonzero(total)
            peak = max(1, int(total.max()))
            scaled = total[used] if peak < 65536 else np.maximum(1, total[used] * 65535 // peak)
            ids.append(used.astype(np.uint16).tobytes())
            counts.append(scaled.astype(np.uint16).tobytes())
        yield pa.record_batch([batch.column("lang").cast(pa.string()), batch.column("order"),
                               pa.array(ids, pa.binary()), pa.array(counts, pa.binary())],
                              names=["lang", "order", "ids", "counts"])


def training_sample(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, seed: int = 11) -> DataFrame:
    """About ``sample_docs`` labelled texts in all, alike many for each language, twice as many at most.

    Rows are drawn by a hash of the id, so the choice does not depend on the layout;
    the draw rate comes from counts over all labelled rows, and the rows of the first id
    are drawn in any case. Of a language's drawn rows (thousands may repeat one id) those
    with the least hash of id and text stay, up to twice its share.
    """
    drawn = _labelled(docs, sample_docs, seed).filter("drawn")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order"))
    return drawn.withColumn("place", place).filter(F.col("place") <= 2 * F.col("share")).select("doc_id", "lang", "text", "order")


def _labelled(docs: DataFrame, sample_docs: int, seed: int) -> DataFrame:
    """All rows to learn from, with their order and whether they are drawn for the sample."""
    usable = learnable(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull()
    sized = docs.select("doc_id", "lang", "text").filter(usable).withColumn("u", draw(F.col("doc_id"), seed))
    # three numbers a language; the model keeps ``buckets`` of them for each on the driver
    languages = sized.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("u").alias("least"))
    share = F.ceil(F.lit(float(sample_docs)) / F.count(F.lit(1)).over(Window.partitionBy()))
    rates = languages.withColumn("share", share).withColumn("rate", F.col("share") / F.col("n"))
    drawn = (F.col("u") < F.col("rate")) | (F.col("u") == F.col("least"))
    return (sized.join(F.broadcast(rates), "lang").withColumn("order", F.xxhash64(F.lit(seed), "doc_id", "text"))
            .withColumn("drawn", drawn).select("doc_id", "lang", "text", "order", "drawn", "share"))


def _shares(row) -> tuple[np.ndarray, np.ndarray]:
    """Gram buckets of a sampled text and their shares of its grams."""
    counts = np.frombuffer(row["counts"], np.uint16).astype(np.float64)
    return np.frombuffer(row["ids"], np.uint16).astype(np.int64), counts / counts.sum()


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, buckets: int = BUCKETS, dim: int = DIM,
          epochs: int = EPOCHS, rate: float = RATE, reject_share: float = REJECT_SHARE,
          seed: int = 11) -> LanguageModel:
    """Fit on the bounded sample; its gram counts (not its texts) reach the driver, which holds them as
    sent and widens one text's at a time."""
    if buckets > 1 << 16:
        raise ValueError("buckets must fit 16 bits")
    rows = training_sample(docs, sample_docs, seed).select("lang", "order", "text").transform(map_arrow,
        lambda it: _features(it, buckets), "lang string, order long, ids binary, counts binary").collect()
    rows.sort(key=lambda r: (r["order"], r["lang"]))
    languages = sorted({r["lang"] for r in rows})
    if not languages:
        return LanguageModel([], np.zeros((buckets, 0), np.int64), np.zeros(0), 1.0, 0.0)
    label = {x: i for i, x in enumerate(languages)}
    data = [r for r in rows if len(r["ids"])]
    fit = [d for i, d in enumerate(data) if i % 5] or data
    check = data[::5] or data
    rng = np.random.RandomState(seed)
    emb = rng.uniform(-1.0, 1.0, (buckets, dim)) / dim
    out = np.zeros((dim, len(languages)))
    bias = np.zeros(len(languages))
    epochs = max(epochs, -(-LEAST_STEPS // max(1, len(fit))))  # a small sample is gone over more often
    steps, done = max(1, epochs * len(fit)), 0
    for _ in range(epochs):
        for i in rng.permutation(len(fit)):
            y, (ids, share) = label[fit[i]["lang"]], _shares(fit[i])
            lr = rate * (1.0 - done / steps)
            done += 1
            mean = share @ emb[ids]
            err = _softmax(mean @ out + bias)
            err[y] -= 1.0
            # the average's gradient is spread over its grams; weighted up so that
            # rare grams move as well within few passes
            grad = out @ err
            out -= lr * np.outer(mean, err)
            bias -= 0.1 * lr * err
            emb[ids] -= (lr * len(ids) ** 0.5 * share)[:, None] * grad
    weights = np.rint(emb @ out * SCALE).astype(np.int64)
    logits = np.stack([share @ weights[ids] / SCALE + bias for ids, share in map(_shares, check)]) if check else np.zeros((0, len(languages)))
    truth = np.array([label[r["lang"]] for r in check], np.int64)
    temperature, threshold = _calibrate(logits, truth, reject_share)
    model = LanguageModel(languages, weights, bias, temperature, threshold)
    spread = _right_answers(_labelled(docs, sample_docs, seed).filter("NOT drawn"), model).groupBy("step").agg(F.sum("n").alias("n")).orderBy("step").collect()
    if spread:
        passed = np.cumsum([r["n"] for r in spread])
        model.threshold = min(spread[int(np.searchsorted(passed, int(reject_share * passed[-1]), "right"))]["step"] / STEPS, 0.5)
    return model


def _right_answers(labelled: DataFrame, model: LanguageModel) -> DataFrame:
    """(step, n): numbers of rightly labelled texts by their probability in STEPS."""
    def count(batches):
        seen = np.zeros(STEPS + 1, np.int64)
        for batch in batches:
            names, scores, _ = classify(batch.column("text"), model)
            right = np.array([n == x for n, x in zip(names, batch.column("lang").to_pylist())], bool)
            seen += np.bincount((scores[right] * STEPS).astype(np.int64), minlength=STEPS + 1)
        used = np.flatnonzero(seen)
        yield pa.record_batch([pa.array(used), pa.array(seen[used])], names=["step", "n"])

    texts = labelled.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    return texts.transform(map_arrow, count, "step long, n long")


def _calibrate(logits: np.ndarray, truth: np.ndarray, reject_share: float) -> tuple[float, float]:
    """Temperature of least negative log likelihood; threshold at a low quantile."""
    if not len(truth):
        return 1.0, 0.0
    grid = np.exp(np.linspace(np.log(0.1), np.log(5.0), 60))
    loss = [-np.log(np.maximum(1e-12, _softmax(logits / t)[np.arange(len(truth)), truth])).mean() for t in grid]
    temperature = float(grid[int(np.argmin(loss))])
    p = _softmax(logits / temperature)
    right = p.argmax(axis=1) == truth
    confident = np.sort(p.max(axis=1)[right])
    if not len(confident):
        return temperature, 0.0
    floor = float(confident[int(reject_share * len(confident))])
    # never above even odds against all other languages together
    return temperature, min(floor, 0.5)


def _scored(texts: list[bytes], model: LanguageModel) -> tuple[np.ndarray, np.ndarray]:
    """Summed fixed-point logits and gram counts of each text."""
    k = len(model.languages)
    total = np.zeros((len(texts), k), np.int64)
    grams = np.zeros(len(texts), np.int64)
    buckets = len(model.weights)
    for rows, data, starts in blocks(texts):
        bounds = np.append(starts, len(data))
        for at, h in _grams(data, buckets):
            cut = np.searchsorted(at, bounds)
            np.add.at(grams, rows, np.diff(cut))
            for j in range(k):
                run = np.concatenate(([0], np.cumsum(model.weights[:, j][h])))
                np.add.at(total[:, j], rows, run[cut[1:]] - run[cut[:-1]])
    return total, grams


def classify(column: pa.Array, model: LanguageModel) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, calibrated probability, accepted) of each text of an Arrow column."""
    column = column.cast(pa.string())
    lettered = np.array(pc.fill_null(pc.match_substring_regex(column, _ANY_LETTER), False).to_pylist(), bool)
    names, scores = [UNDEFINED] * len(column), np.zeros(len(column))
    if model.languages and len(column):
        total, grams = _scored(_lowered(column), model)
        p = _softmax((total / (SCALE * np.maximum(1, grams))[:, None] + model.bias) / model.temperature)
        best = p.argmax(axis=1)
        for i in np.flatnonzero(lettered):
            names[i] = model.languages[best[i]]
        scores = np.where(lettered, p.max(axis=1), 0.0)
    return names, scores, lettered & (scores >= model.threshold) & bool(model.languages)


def predict(docs: DataFrame, model: LanguageModel, *keep: Column) -> DataFrame:
    """doc_id, the ``keep`` columns, lang_pred, score, accepted for every row."""
    def score(batches):
        for batch in batches:
            names, scores, accepted = classify(batch.column("text"), model)
            kept = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "text"]
            labels = [n for n in batch.schema.names if n != "text"]
            yield pa.record_batch([*kept, pa.array(names, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted)],
                                  names=[*labels, "lang_pred", "score", "accepted"])

    narrow = docs.select("doc_id", *keep, F.col("text").cast("string").alias("text"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in narrow.schema if f.name != "text")
    return narrow.transform(map_arrow, score, f"{fields}, lang_pred string, score double, accepted boolean")


def keep_accepted(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """The rows of ``docs`` (all columns) whose language the model accepts."""
    def passed(batches):
        for batch in batches:
            accepted = classify(batch.column("text"), model)[2]
            yield batch.filter(pa.array(accepted, pa.bool_()))

    return docs.transform(map_arrow, passed, docs.schema)
