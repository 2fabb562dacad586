"""Exact top-k inner products over integer vectors by a bit-sliced index.

Components are quantised to floor(256 * x). The index cuts the rows into blocks; a
block holds, for each dimension, the bitmaps of the bits of (component - the block's
least component). For a query the score of all rows of a block is added up with bitmap
arithmetic: a dimension's slices enter once for every set bit of the query's
component, shifted by that bit, in ripple-carry addition; for a negative component the
complemented slices enter, which only shifts all scores of the block by a constant.
The k best rows are then selected from the most significant score slice downward,
keeping the set surely in and the set still tied; the rows tied at the boundary are
resolved exactly by the smaller id. A second step merges the blocks' k best per query.

Blocks of rows meet blocks of queries as pairs of keys; every pair is a group of its
own, so memory holds one index block and one query block, whatever the table's size.

Defined cases: vectors that are null, empty or hold a null or non-finite component take
no part, nor do rows with a null id. As in the SQL, a component whose quantised value
needs more than 64 bits, or a score that does, is an error. Vectors of unequal lengths meet on their common dimensions. Repeated ids are
separate rows; a query's own row never is its candidate. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.common import map_arrow, table

K = 5
ROWS_PER_BLOCK = 1 << 15
QUERIES_PER_BLOCK = 256
FACTOR = 256.0

INDEX = ("block long, n int, dims int, ids binary, base binary, bits binary, slices binary, "
         "queries array<struct<chunk: int, at: binary, ids: binary, vectors: binary>>")
FOUND = "query_block long, query_at int, query_id long, vec_id long, score long"


def _bitmap(flags: np.ndarray, words: int) -> np.ndarray:
    raw = np.zeros(words * 8, np.uint8)
    packed = np.packbits(flags, bitorder="little")
    raw[:len(packed)] = packed
    return raw.view(np.uint64)


def slice_block(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(least component, number of bits) per dimension, and all bitmaps in order."""
    words = -(-len(vectors) // 64)
    base = vectors.min(axis=0)
    # differences of 64-bit numbers need all 64 bits without a sign
    over = (vectors - base).view(np.uint64)
    bits = np.array([int(x).bit_length() for x in over.max(axis=0)], np.int64)
    maps = [_bitmap(over[:, d] >> np.uint64(b) & np.uint64(1), words) for d in range(vectors.shape[1]) for b in range(bits[d])]
    return base, bits, np.array(maps, np.uint64).reshape(-1, words)


class ScoreSlices:
    """Score bitmaps of one query over one block, least significant first."""

    def __init__(self, words: int, width: int):
        self.slices = np.zeros((width, words), np.uint64)
        self.used = 0
        self._carry, self._half, self._next = (np.empty(words, np.uint64) for _ in range(3))

    def add(self, maps: list[np.ndarray], shift: int) -> None:
        """Add the number with bitmaps ``maps`` times 2**shift (ripple carry)."""
        s, carry, half, nxt = self.slices, self._carry, self._half, self._next
        live = False
        top = shift + len(maps)
        for i in range(shift, max(top, self.used + 1) + 1):
            a = s[i]
            if i < top:
                x = maps[i - shift]
                np.bitwise_xor(a, x, out=half)
                np.bitwise_and(a, x, out=nxt)
                if live:
                    np.bitwise_xor(half, carry, out=a)
                    np.bitwise_and(half, carry, out=half)
                    np.bitwise_or(nxt, half, out=carry)
                else:
                    a[:] = half
                    carry[:] = nxt
                    live = True
            else:
                np.bitwise_and(a, carry, out=nxt)
                np.bitwise_xor(a, carry, out=a)
                carry, nxt = nxt, carry
                if not carry.any():
                    break
        self.used = max(self.used, min(len(s) - 1, i))

    def best(self, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows surely among the k best, rows tied for the places left), as bitmaps."""
        sure, tied = np.zeros_like(rows), rows.copy()
        for i in range(self.used, -1, -1):
            ones = tied & self.slices[i]
            n = int(np.bitwise_count(sure | ones).sum())
            if n > k:
                tied = ones
            else:
                sure |= ones
                tied &= ~self.slices[i]
                if n == k:
                    return sure, np.zeros_like(rows)
        return sure, tied


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def search_block(base: np.ndarray, bits: np.ndarray, slices: np.ndarray, n: int, ids: np.ndarray,
                 query: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """The k best (id, score) of one block for one query; ``own`` is its row here or -1."""
    dims = min(len(query), len(bits))
    first = np.cumsum(bits) - bits
    room = sum(abs(int(query[d])) * ((1 << int(bits[d])) - 1) for d in range(dims))
    scores = ScoreSlices(slices.shape[1], room.bit_length() + 3)
    constant = 0
    for d in range(dims):
        q, wide = int(query[d]), int(bits[d])
        constant += q * int(base[d])
        maps = list(slices[first[d]:first[d] + wide])
        if q < 0:
            maps = [~m for m in maps]
            constant += q * ((1 << wide) - 1)
        size = abs(q)
        while size and wide:
            low = (size & -size).bit_length() - 1
            scores.add(maps, low)
            size &= size - 1
    rows = _bitmap(np.arange(n) != own, slices.shape[1])
    sure, tied = scores.best(rows, k)
    chosen = list(_positions(sure))
    boundary = _positions(tied)
    chosen += list(boundary[np.argsort(ids[boundary], kind="stable")[:k - len(chosen)]])
    out = []
    for r in chosen:
        word, bit = r >> 6, np.uint64(r & 63)
        value = sum((int(scores.slices[i, word] >> bit) & 1) << i for i in range(scores.used + 1))
        out.append((int(ids[r]), value + constant))
    return out


def quantised(vectors: list[list | None]) -> list[np.ndarray | None]:
    """floor(256 * x) of each vector as int64, or None for one that takes no part."""
    out: list[np.ndarray | None] = []
    for v in vectors:
        if not v or None in v:
            out.append(None)
            continue
        x = np.floor(FACTOR * np.asarray(v, np.float64))
        if not np.isfinite(np.asarray(v, np.float64)).all():
            out.append(None)
            continue
        if (x < -2.0**63).any() or (x >= 2.0**63).any():
            raise OverflowError("a vector's quantised component needs more than 64 bits")
        out.append(x.astype(np.int64))
    return out


def build_index(vectors: DataFrame, is_query: Column, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """INDEX rows, one per task: the bit slices of a block and the queries among its rows.

    Rows are dealt out evenly, so a block holds about ``rows_per_block`` rows at most.
    """
    narrow = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"),
                            F.coalesce(is_query, F.lit(False)).alias("asks")).filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
    tasks = max(1, -(-narrow.count() // rows_per_block))

    def build(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId()
        ids: list[int] = []
        kept: list[np.ndarray] = []
        asks: list[bool] = []

        def block():
            dims = max(map(len, kept))
            at = np.zeros((len(kept), dims), np.int64)
            for i, v in enumerate(kept):
                at[i, :len(v)] = v
            base, bits, slices = slice_block(at)
            own = np.flatnonzero(asks)
            queries = [{"chunk": c, "at": part.astype(np.int32).tobytes(), "ids": np.array(ids)[part].astype(np.int64).tobytes(),
                        "vectors": at[part].tobytes()}
                       for c, part in enumerate(np.split(own, range(QUERIES_PER_BLOCK, len(own), QUERIES_PER_BLOCK)))
                       if len(part)]
            return pa.RecordBatch.from_pylist([{
                "block": number, "n": len(kept), "dims": dims, "ids": np.array(ids, np.int64).tobytes(),
                "base": base.tobytes(), "bits": bits.tobytes(), "slices": slices.tobytes(), "queries": queries}],
                schema=pa.schema([("block", pa.int64()), ("n", pa.int32()), ("dims", pa.int32()), ("ids", pa.binary()),
                                  ("base", pa.binary()), ("bits", pa.binary()), ("slices", pa.binary()),
                                  ("queries", pa.list_(pa.struct([("chunk", pa.int32()), ("at", pa.binary()),
                                                                  ("ids", pa.binary()), ("vectors", pa.binary())])))]))

        for batch in batches:
            for vec_id, v, ask in zip(batch.column(0).to_pylist(), quantised(batch.column(1).to_pylist()), batch.column(2).to_pylist()):
                if v is None:
                    continue
                ids.append(vec_id)
                kept.append(v)
                asks.append(ask)
        if kept:
            yield block()

    return narrow.repartition(tasks).transform(map_arrow, build, INDEX)


def _search_pair(index: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    out = []
    for row in index.itertuples():
        words = -(-row.n // 64)
        slices = np.frombuffer(row.slices, np.uint64).reshape(-1, words)
        ids, base, bits = (np.frombuffer(x, np.int64) for x in (row.ids, row.base, row.bits))
        for q in queries.itertuples():
            at, qids = np.frombuffer(q.at, np.int32), np.frombuffer(q.qids, np.int64)
            vectors = np.frombuffer(q.vectors, np.int64).reshape(len(at), -1)
            for p, qid, v in zip(at, qids, vectors):
                own = int(p) if q.query_block == row.block else -1
                out += [(q.query_block, p, qid, i, s) for i, s in search_block(base, bits, slices, row.n, ids, v, own, k)]
    return pd.DataFrame(out, columns=[f.split()[0] for f in FOUND.split(", ")])


def top_k(spark: SparkSession, vectors: DataFrame, is_query: Column, k: int = K,
          rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score of each query's k highest inner products."""
    index = table(spark, build_index(vectors, is_query, rows_per_block), "bit-slices")
    asked = index.select(F.col("block").alias("query_block"), F.explode("queries").alias("q")).select(
        "query_block", F.col("q.chunk").alias("chunk"), F.col("q.at").alias("at"), F.col("q.ids").alias("qids"),
        F.col("q.vectors").alias("vectors"))
    last = index.agg(F.max("block")).first()[0] or 0
    # every query block meets every index block: keys first, payloads by equal keys
    right = asked.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last).cast("long"))))
    keys = right.select("block", F.col("query_block").alias("asking"), F.col("chunk").alias("part"))
    left = index.drop("queries", "dims").join(keys, "block").withColumnsRenamed({"asking": "query_block", "part": "chunk"})
    key = ["block", "query_block", "chunk"]
    found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(lambda a, b: _search_pair(a, b, k), FOUND)
    order = Window.partitionBy("query_block", "query_at", "query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
