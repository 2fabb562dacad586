"""Language-model scores of texts by Katz backoff over all n-grams of the learned texts.

Tokens are the words of a text, A-Z in lower case, and one end. Contexts reach back to the
beginning of the text, which counts as a start. With c the count of an n-gram in the
learned texts, the probability of word w behind context h is

    discount(c(hw)) * c(hw) / total(h)     if hw was learned
    backoff(h) * P(w behind h without its first word)   if not

down to single words, whose discounted share falls to one unknown word. Discounts are
Good-Turing's for counts up to ``LARGEST`` (Katz's form, which leaves larger counts alone);
where the counts of counts give none between 0 and 1 an order takes (c - 0.5) / c instead.
backoff(h) is the mass that discounting left in h over the mass that the learned words of
h have in the shorter context, so each context's probabilities sum to 1. A context none
of whose counts is discounted takes one more, unseen event into its total, a context that
was not learned has backoff 1.

How it runs. Texts are read once into blocks of ``BLOCK_TOKENS`` tokens: numbers of the
block's own words and their hashes, one row a block, written in the scratch folder. The
n-grams of an order are told apart by 64-bit hashes; each block sends its distinct ones,
with their counts, to parts by the leading bits (as many parts as the input needs, about
``PART_KEYS`` n-grams each), so a word that is a third of all tokens costs one number a
block. A part sums the counts, which are a partition of the order's table, and answers each
block; an n-gram's first block also is told to be the one that speaks for it, so that the
sums of a context over its learned words, which the blocks send next to the parts of the
shorter order, take every n-gram once. Their quotient, the backoff, is the other table. With
the answers a block looks up every token, from the longest order down. Among n distinct
n-grams n**2 / 2**65 pairs are expected to share a hash, 0.0001 at 60 million.

Defined cases: a null or empty text is its end alone. Texts with a null id are scored and
not learned from (see ``common.fold``). With nothing learned every token has probability 1.
Repeated rows are learned from and scored each. An empty table gives no rows. Extra
columns are ignored. A text longer than a block is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.blocks import blocks, text_bytes, word_hashes
from tarmac.llm.common import map_arrow, swept_table

ORDER = 2
LARGEST = 5  # counts above it are not discounted
BLOCK_TOKENS = 3 << 19
PART_KEYS = 1 << 20
LEAST_BITS = 3
# Hashes of the start and the end of a text.
START, END = np.uint64(0x6A09E667F3BCC909), np.uint64(0xBB67AE8584CAA73B)


# --- packed arrays ---------------------------------------------------------------

def packed(values: np.ndarray) -> bytes:
    """The bytes of an array, all first ones, all second ones and so on, compressed."""
    flat = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(flat.T.tobytes())


def unpacked(cell: bytes, kind) -> np.ndarray:
    size = np.dtype(kind).itemsize
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(cell), np.uint8).reshape(size, -1)
    return np.ascontiguousarray(flat.T).view(kind).ravel()


def packed_keys(ascending: np.ndarray) -> bytes:
    return packed(np.diff(ascending, prepend=np.uint64(0)))


def unpacked_keys(cell: bytes) -> np.ndarray:
    return np.cumsum(unpacked(cell, np.uint64), dtype=np.uint64)


def mixed(prefix: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a context's hash and a word's, not symmetric in the two."""
    h = (prefix ^ (prefix >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + word
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


# --- blocks ----------------------------------------------------------------------

def _block(number: int, ids: list, learn: list[bool], words: list[np.ndarray]) -> dict:
    hashes = np.concatenate([x for w in words for x in (w, [END])]).astype(np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    known, number_of, n = np.unique(hashes, return_inverse=True, return_counts=True)
    often = np.argsort(-n, kind="stable")
    rank = np.empty(len(often), np.uint32)
    rank[often] = np.arange(1, len(often) + 1)  # 0 is the start
    return {"block": number, "ids": ids, "n_tokens": len(hashes), "ends": packed(ends.astype(np.int64)),
            "learn": packed(np.array(learn, np.uint8)), "tokens": packed(rank[number_of]),
            "keys": packed(np.append(START, known[often]))}


def block_table(spark: SparkSession, docs: DataFrame, learn: Column, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row a block: ids, ends and learned flags of its texts, token numbers, hash of each number."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def cut(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, flags, words, size = [], [], [], 0
        schema = None
        for batch in batches:
            column = batch.column("doc_id")
            schema = pa.schema([("block", pa.int64()), ("ids", pa.list_(column.type)), ("n_tokens", pa.int64()),
                                *((c, pa.binary()) for c in ("ends", "learn", "tokens", "keys"))])
            texts = [x.lower() for x in text_bytes(batch.column("text"))]
            found: list[list[np.ndarray]] = [[] for _ in texts]
            for rows, data, starts in blocks(texts):
                h, piece = word_hashes(data, starts)
                at = np.searchsorted(piece, np.arange(len(rows) + 1))
                for k, row in enumerate(rows):
                    found[row].append(h[at[k]:at[k + 1]])
            for doc_id, flag, parts in zip(column.to_pylist(), batch.column("learn").to_pylist(), found):
                ids.append(doc_id)
                flags.append(flag)
                words.append(np.concatenate(parts or [np.zeros(0, np.uint64)]))
                size += len(words[-1]) + 1
                if size >= block_tokens:
                    yield pa.RecordBatch.from_pylist([_block(number, ids, flags, words)], schema)
                    number, ids, flags, words, size = number + 1, [], [], [], 0
        if ids:
            yield pa.RecordBatch.from_pylist([_block(number, ids, flags, words)], schema)

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.coalesce(learn, F.lit(False)).alias("learn"))
    return swept_table(spark, map_arrow(narrow, cut, f"block long, ids array<{kind}>, n_tokens long, ends binary, learn binary, "
                                                     "tokens binary, keys binary"), "katz-blocks")


@dataclass
class Grams:
    """The distinct n-grams of one order in a block; number 0 is the start alone."""
    keys: np.ndarray
    at: np.ndarray  # n-gram that ends at each token
    prefix: np.ndarray  # context, as a number of the shorter order
    suffix: np.ndarray  # the n-gram without its first word, likewise
    order: np.ndarray  # numbers by ascending hash


def block_grams(tokens: np.ndarray, ends: np.ndarray, keys: np.ndarray, order: int) -> list[Grams]:
    first = np.append(0, ends[:-1])
    none = np.zeros(len(keys), np.int64)
    out = [Grams(keys, tokens, none, none, np.argsort(keys, kind="stable"))]
    for _ in range(1, order):
        shorter = out[-1]
        before = np.roll(shorter.at, 1).astype(np.int64)
        before[first] = 0
        pair, at_first, number_of = np.unique(before << 32 | tokens, return_index=True, return_inverse=True)
        prefix, word = pair >> 32, pair & 0xFFFFFFFF
        own = np.append(START, mixed(shorter.keys[prefix], keys[word]))
        out.append(Grams(own, number_of + 1, np.append(0, prefix), np.append(0, shorter.at[at_first]).astype(np.int64),
                         np.argsort(own, kind="stable")))
    return out


def learned_counts(grams: Grams, ends: np.ndarray, learn: np.ndarray) -> np.ndarray:
    """How often each n-gram stands in the block's learned texts; the start as often as there are such."""
    sizes = np.diff(ends, prepend=0)
    n = np.bincount(grams.at[np.repeat(learn.astype(bool), sizes)], minlength=len(grams.keys)).astype(np.uint64)
    n[0] = int(learn.sum())
    return n


def _cells(grams: Grams, bits: int) -> Iterator[tuple[int, np.ndarray]]:
    """(part, numbers of its n-grams by ascending hash) of the parts that the block has n-grams for."""
    part = (grams.keys[grams.order] >> np.uint64(64 - bits)).astype(np.int64)
    cut = np.flatnonzero(np.diff(part, prepend=-1))
    for lo, numbers in zip(cut, np.split(grams.order, cut[1:])):
        yield int(part[lo]), numbers


def part_bits(blocks_: DataFrame, part_keys: int = PART_KEYS) -> int:
    """Bits that number the parts, by the tokens of all blocks."""
    tokens = blocks_.agg(F.sum("n_tokens")).first()[0] or 0
    return max(LEAST_BITS, (tokens // part_keys).bit_length())


def _read(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return (unpacked(row["tokens"], np.uint32), unpacked(row["ends"], np.int64), unpacked(row["learn"], np.uint8),
            unpacked(row["keys"], np.uint64))


# --- counts ----------------------------------------------------------------------

COUNTED = "level int, part int, block long, keys binary, data binary, stats array<long>"


def count_ngrams(spark: SparkSession, blocks_: DataFrame, order: int, bits: int) -> DataFrame:
    """The tables of all orders and the answers to the blocks.

    A row with a block is an answer: twice the count of each of its n-grams in the part, plus 1 for
    those it speaks for. One without is a partition of the order's table: hashes, counts, and their
    sum, number and counts of counts.
    """
    def ask(batches):
        for batch in batches:
            for row in batch.to_pylist():
                tokens, ends, learn, keys = _read(row)
                for level, grams in enumerate(block_grams(tokens, ends, keys, order), 1):
                    n = learned_counts(grams, ends, learn)
                    cells = list(_cells(grams, bits))
                    yield pa.record_batch([pa.array([level] * len(cells), pa.int32()), pa.array([p for p, _ in cells], pa.int32()),
                                           pa.array([row["block"]] * len(cells), pa.int64()),
                                           pa.array([packed_keys(grams.keys[i]) for _, i in cells], pa.binary()),
                                           pa.array([packed(n[i]) for _, i in cells], pa.binary())],
                                          names=["level", "part", "block", "keys", "data"])

    def count(asked: pa.Table) -> pa.Table:
        asked = asked.sort_by("block")
        level, part = asked.column("level")[0].as_py(), asked.column("part")[0].as_py()
        keys = [unpacked_keys(x) for x in asked.column("keys").to_pylist()]
        sizes = [len(x) for x in keys]
        keys, n = np.concatenate(keys), np.concatenate([unpacked(x, np.uint64) for x in asked.column("data").to_pylist()])
        order_ = np.argsort(keys, kind="stable")
        keys, n = keys[order_], n[order_]
        new = np.append(True, keys[1:] != keys[:-1])
        which = np.cumsum(new) - 1
        total = np.add.reduceat(n, np.flatnonzero(new))
        told = total[which] * np.uint64(2)
        learned = np.flatnonzero(n)
        told[learned[np.diff(which[learned], prepend=-1) != 0]] += np.uint64(1)
        answer = np.empty_like(told)
        answer[order_] = told
        answers = [packed(x) for x in np.split(answer, np.cumsum(sizes)[:-1])]
        own, total = keys[new][total > 0], total[total > 0]
        counted = total[own != START].astype(np.int64)
        stats = [int(counted.sum()), len(counted), *np.bincount(counted[counted <= LARGEST + 1], minlength=LARGEST + 2)[1:].tolist()]
        m = len(answers)
        return pa.table({"level": pa.array([level] * (m + 1), pa.int32()), "part": pa.array([part] * (m + 1), pa.int32()),
                         "block": pa.array([*asked.column("block").to_pylist(), None], pa.int64()),
                         "keys": pa.array([None] * m + [packed_keys(own)], pa.binary()),
                         "data": pa.array([*answers, packed(total)], pa.binary()),
                         "stats": pa.array([None] * m + [stats], pa.list_(pa.int64()))})

    asked = map_arrow(blocks_.select("block", "tokens", "ends", "learn", "keys"), ask,
                      "level int, part int, block long, keys binary, data binary")
    return swept_table(spark, asked.groupBy("level", "part").applyInArrow(count, COUNTED), "katz-counts")


# --- discounts -------------------------------------------------------------------

def discounts(n: list[int]) -> np.ndarray:
    """Factor of each count 0 .. ``LARGEST`` from the counts of counts n[0] (of 1) .. n[LARGEST]."""
    out = np.ones(LARGEST + 1)
    half = (np.arange(1, LARGEST + 1) - 0.5) / np.arange(1, LARGEST + 1)
    if all(n):
        tail = (LARGEST + 1) * n[LARGEST] / n[0]
        turing = np.array([(r + 1) * n[r] / (r * n[r - 1]) for r in range(1, LARGEST + 1)])
        if tail != 1:
            katz = (turing - tail) / (1 - tail)
            if ((katz > 0) & (katz < 1)).all():
                half = katz
    out[1:] = half
    return out


@dataclass
class Model:
    """What the driver knows of an order-``order`` model: a few numbers; the tables hold the rest."""
    order: int
    tokens: int  # learned, ends among them
    types: int
    factors: list[np.ndarray]  # discounts of each order
    total: int  # of single words, with the unseen event if none is discounted
    unknown: float  # probability of an unlearned word

    def kept(self, level: int, n: np.ndarray) -> np.ndarray:
        """Discounted counts of n-grams of an order."""
        n = n.astype(np.int64)
        return n * np.where(n <= LARGEST, self.factors[level - 1][np.minimum(n, LARGEST)], 1.0)


def fitted(counted: DataFrame, order: int) -> Model:
    """The numbers of the model, from the partitions' sums."""
    sums = counted.filter("block IS NULL").groupBy("level").agg(*[F.sum(F.col("stats")[i]) for i in range(LARGEST + 3)]).collect()
    stats = {row[0]: [int(x) for x in row[1:]] for row in sums}
    none = [0] * (LARGEST + 3)
    factors = [discounts(stats.get(level, none)[2:]) for level in range(1, order + 1)]
    tokens, types, *n = stats.get(1, none)
    lost = sum((1 - factors[0][r]) * r * n[r - 1] for r in range(1, LARGEST + 1))
    total = tokens if lost > 0 else tokens + 1
    return Model(order, tokens, types, factors, total, lost / total if lost > 0 else 1 / total)


# --- looked up in a block --------------------------------------------------------

class Looked:
    """A block with the answers it got: counts of its n-grams, backoffs and totals of its contexts."""

    def __init__(self, row: dict, answers: pa.Table, model: Model):
        self.model = model
        self.tokens, self.ends, self.learn, keys = _read(row)
        self.grams = block_grams(self.tokens, self.ends, keys, model.order)
        got: dict[tuple[str, int], list[tuple[int, bytes]]] = {}
        for what, level, part, data in zip(*(answers.column(c).to_pylist() for c in ("what", "level", "part", "data"))):
            got.setdefault((what, level), []).append((part, data))

        def gathered(what: str, level: int, kind) -> np.ndarray:
            # parts are ranges of the hashes, so their answers follow the n-grams by hash
            values = np.concatenate([unpacked(d, kind) for _, d in sorted(got[what, level])])
            out = np.empty_like(values)
            out[self.grams[level - 1].order] = values
            return out

        told = [gathered("count", level, np.uint64) for level in range(1, model.order + 1)]
        self.counts = [(x >> np.uint64(1)).astype(np.int64) for x in told]
        self.speaks = [(x & np.uint64(1)).astype(bool) for x in told]
        self.backoff, self.total = [], []
        for level in range(1, model.order):
            if ("backoff", level) in got:
                signed = gathered("backoff", level, np.float64)  # negative: an unseen event is in the total
                self.backoff.append(np.abs(signed))
                self.total.append(self.counts[level - 1] + (signed < 0))

    def share(self, level: int) -> np.ndarray:
        """Probability of the last word of each learned n-gram behind the others (0 if not learned)."""
        kept = self.model.kept(level, self.counts[level - 1])
        if level == 1:
            return kept / self.model.total
        return kept / np.maximum(self.total[level - 2][self.grams[level - 1].prefix], 1)

    def log_probability(self, level: int) -> np.ndarray:
        """log10 of the probability of the last word of each n-gram, by backing off."""
        share = self.share(level)
        learned = share > 0
        out = np.log10(np.where(learned, share, 1.0))
        if level == 1:
            out[~learned] = np.log10(self.model.unknown)
        else:
            grams = self.grams[level - 1]
            out[~learned] = (np.log10(self.backoff[level - 2])[grams.prefix] + self.log_probability(level - 1)[grams.suffix])[~learned]
        return out


ANSWERS = ["block", "what", "level", "part", "data"]


def _answered(blocks_: DataFrame, answers: DataFrame, columns: list[str]):
    return blocks_.select("block", *columns).groupBy("block").cogroup(answers.select(*ANSWERS).groupBy("block"))


# --- backoff ---------------------------------------------------------------------

def backoffs(spark: SparkSession, blocks_: DataFrame, answers: DataFrame, model: Model, level: int, bits: int) -> DataFrame:
    """The table of backoffs of the contexts of ``level`` words, and the answers to the blocks."""
    sent = "part int, block long, keys binary, counts binary, seen binary, lost binary"

    def sums(block: pa.Table, answered: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        looked = Looked(row, answered, model)
        grams, longer = looked.grams[level - 1], looked.grams[level]
        speaks = looked.speaks[level].copy()
        speaks[0] = False  # the start is no word behind a context
        n = looked.counts[level][speaks]
        context = longer.prefix[speaks]
        seen = np.bincount(context, looked.share(level)[longer.suffix[speaks]], len(grams.keys))
        lost = np.bincount(context, n - model.kept(level + 1, n), len(grams.keys))
        cells = list(_cells(grams, bits))
        columns = [packed_keys, packed, packed, packed]
        values = [grams.keys, looked.counts[level - 1], seen, lost]
        return pa.table([pa.array([p for p, _ in cells], pa.int32()), pa.array([row["block"]] * len(cells), pa.int64()),
                         *(pa.array([pack(v[i]) for _, i in cells], pa.binary()) for pack, v in zip(columns, values))],
                        names=["part", "block", "keys", "counts", "seen", "lost"])

    def quotients(asked: pa.Table) -> pa.Table:
        asked = asked.sort_by("block")
        part = asked.column("part")[0].as_py()
        keys = [unpacked_keys(x) for x in asked.column("keys").to_pylist()]
        sizes = [len(x) for x in keys]
        keys = np.concatenate(keys)
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        starts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        n, seen, lost = (np.concatenate([unpacked(x, kind) for x in asked.column(c).to_pylist()])[order]
                         for c, kind in (("counts", np.int64), ("seen", np.float64), ("lost", np.float64)))
        n, seen, lost = n[starts], np.add.reduceat(seen, starts), np.add.reduceat(lost, starts)
        free = 1.0 - seen
        plain = lost > 0
        value = np.where(plain, lost / np.maximum(n, 1), -1.0 / (n + 1)) / free
        value[n == 0] = 1.0
        answer = np.empty(len(keys))
        answer[order] = np.repeat(value, np.diff(starts, append=len(keys)))
        answers = [packed(x) for x in np.split(answer, np.cumsum(sizes)[:-1])]
        own = n > 0
        m = len(answers)
        return pa.table({"block": pa.array([*asked.column("block").to_pylist(), None], pa.int64()),
                         "what": ["backoff"] * (m + 1), "level": pa.array([level] * (m + 1), pa.int32()),
                         "part": pa.array([part] * (m + 1), pa.int32()),
                         "data": pa.array([*answers, packed(value[own])], pa.binary()),
                         "keys": pa.array([None] * m + [packed_keys(keys[starts][own])], pa.binary())})

    asked = _answered(blocks_, answers, ["tokens", "ends", "learn", "keys"]).applyInArrow(sums, sent)
    return swept_table(spark, asked.groupBy("part").applyInArrow(
        quotients, "block long, what string, level int, part int, data binary, keys binary"), f"katz-backoff-{level}")


# --- scores ----------------------------------------------------------------------

def train_and_score(spark: SparkSession, docs: DataFrame, learn: Column, order: int = ORDER, block_tokens: int = BLOCK_TOKENS,
                    part_keys: int = PART_KEYS) -> tuple[Model, DataFrame]:
    """The model of the rows with ``learn`` and, of every row: doc_id, n_tokens, n_known, base_score, score."""
    if order < 2:
        raise ValueError("the order is 2 or more")
    blocks_ = block_table(spark, docs, learn, block_tokens)
    bits = part_bits(blocks_, part_keys)
    counted = count_ngrams(spark, blocks_, order, bits)
    model = fitted(counted, order)
    answers = counted.filter("block IS NOT NULL").withColumn("what", F.lit("count")).select(*ANSWERS)
    for level in range(1, order):
        table = backoffs(spark, blocks_, answers, model, level, bits)
        answers = answers.unionByName(table.filter("block IS NOT NULL").select(*ANSWERS))

    def score(block: pa.Table, answered: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        looked = Looked(row, answered, model)
        first = np.append(0, looked.ends[:-1])
        n = looked.counts[0]
        base = np.log10((n + 0.5) / (model.tokens + 0.5 * (model.types + 1)))
        of_token = looked.log_probability(order)[looked.grams[-1].at]
        return pa.table({"doc_id": pa.array(row["ids"], block.schema.field("ids").type.value_type),
                         "n_tokens": np.diff(looked.ends, prepend=0),
                         "n_known": np.add.reduceat((n > 0)[looked.tokens].astype(np.int64), first),
                         "base_score": np.add.reduceat(base[looked.tokens], first),
                         "score": np.add.reduceat(of_token, first)})

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = _answered(blocks_, answers, ["ids", "tokens", "ends", "learn", "keys"]).applyInArrow(
        score, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
    return model, scored
