"""Packing documents into fixed-length token sequences by minimum bin slack.

A document is its token ids and an end id. Whole windows of ``window`` tokens are cut
off from its front and are sequences by themselves; what remains (shorter than the
window) is packed. Packing plans on the histogram of remaining lengths, which has at most
``window - 1`` entries whatever the number of documents: the longest length left seeds
a window, and a bitset subset-sum dynamic programme over the lengths left finds the
multiset that fills the window closest to its capacity. Backtracking reads the count of
each length from the stored bitsets, and the pattern is applied as often as the counts
allow. When no multiset fills the window, one more remainder is cut at the slack
and its tail goes back into the histogram, so at most one sequence of all is padded.

The plan is a list of rank ranges: remainders of length L with ranks lo..hi-1 put their
tokens [cut, cut + size) at one offset of consecutive sequences. Ranks within a length
are counted in two levels (task of the tokenising pass, then position), so a length that
a third of all documents share is spread over tasks. Tokens themselves are not
shuffled: ids are kept only for remainders, in the written table of pieces, and are
read again only for the remainders that the plan cuts.

Defined cases: null and empty texts are the end id alone. Repeated rows are separate
documents. An empty table packs to no rows. Extra columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.llm.blocks import text_bytes
from tarmac.llm.common import map_arrow, table
from tarmac.llm.encode import shared_encoder

WINDOW = 1024
END_ID = 0
# Rows of cut remainders (about 100 bytes each) that are sent to all tasks; more are shuffled with the ids.
CUT_ROWS_SENT = 1 << 15

PIECES = ("piece long, doc_id {id}, start long, length long, ids_crc32 long, doc_tokens long, "
          "part int, ids binary")


def cut_documents(docs: DataFrame, tokenizer: str, ranks: str, pattern: str,
                  window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """One row per whole window and per remainder of every document."""
    def cut(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, number = shared_encoder(tokenizer, ranks, pattern), part << 33
        for batch in batches:
            columns: list[list] = [[] for _ in range(7)]
            ids = batch.column("doc_id").to_pylist()
            texts = text_bytes(batch.column("text"))
            for lo in range(0, len(texts), 512):
                for doc_id, tokens in zip(ids[lo:lo + 512], encoder.ids_of(texts[lo:lo + 512])):
                    tokens = np.append(tokens, np.uint32(end_id)).astype("<u4")
                    for start in range(0, len(tokens), window):
                        piece = tokens[start:start + window]
                        raw = piece.tobytes()
                        for col, x in zip(columns, (number, doc_id, start, len(piece), zlib.crc32(raw), len(tokens),
                                                    raw if len(piece) < window else None)):
                            col.append(x)
                        number += 1
            yield pa.record_batch([pa.array(columns[0], pa.int64()), pa.array(columns[1], batch.schema.field("doc_id").type),
                                   *(pa.array(c, pa.int64()) for c in columns[2:6]),
                                   pa.array([part] * len(columns[0]), pa.int32()), pa.array(columns[6], pa.binary())],
                                  names=["piece", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "ids"])

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return narrow.transform(map_arrow, cut, PIECES.format(id=narrow.schema["doc_id"].dataType.simpleString()))


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, at most ``counts`` of each, that fills ``capacity``
    closest: bitset subset sums over the lengths, longest first, then backtracking."""
    mask = (1 << (capacity + 1)) - 1
    steps, reach = [], 1
    for size in sorted(counts, reverse=True):
        left, chunk = min(counts[size], capacity // size), 1
        while left > 0:
            take = min(chunk, left)
            steps.append((size, take, reach))
            reach |= (reach << (size * take)) & mask
            left -= take
            chunk *= 2
        if reach >> capacity & 1:
            break
    at = reach.bit_length() - 1
    taken: dict[int, int] = {}
    for size, take, before in reversed(steps):
        if not before >> at & 1:
            taken[size] = taken.get(size, 0) + take
            at -= size * take
    return taken


class _Pool:
    """Remainders left of each length, as ranges of ranks of an original length."""

    def __init__(self, histogram: dict[int, int]):
        self.ranges = {s: [(s, 0, n, 0)] for s, n in histogram.items() if n}
        self.counts = {s: n for s, n in histogram.items() if n}

    def take(self, size: int, n: int) -> list[tuple[int, int, int, int]]:
        """``n`` remainders of ``size``: (original length, lo, hi, cut) ranges."""
        out = []
        self.counts[size] -= n
        while n:
            origin, lo, hi, cut = self.ranges[size].pop()
            if hi - lo > n:
                self.ranges[size].append((origin, lo + n, hi, cut))
                hi = lo + n
            out.append((origin, lo, hi, cut))
            n -= hi - lo
        if not self.counts[size]:
            del self.counts[size], self.ranges[size]
        return out

    def put(self, size: int, ranges: list[tuple[int, int, int, int]]) -> None:
        self.ranges.setdefault(size, []).extend(ranges)
        self.counts[size] = self.counts.get(size, 0) + sum(hi - lo for _, lo, hi, _ in ranges)


def plan_windows(histogram: dict[int, int], window: int = WINDOW) -> list[tuple[int, int, int, int, int, int, int]]:
    """(length, lo rank, hi rank, cut, piece length, first sequence, offset) rows for remainders counted by length."""
    pool, rows, sequence = _Pool(histogram), [], 0
    while pool.counts:
        seed = max(pool.counts)
        rest = dict(pool.counts)
        rest[seed] -= 1
        pattern = fill({s: n for s, n in rest.items() if n}, window - seed)
        pattern[seed] = pattern.get(seed, 0) + 1
        slack = window - sum(s * n for s, n in pattern.items())
        times = min(pool.counts[s] // n for s, n in pattern.items())
        split = 0
        if slack:
            # nothing left fits the slack whole: cut the longest remainder left
            over = {s: n - pattern.get(s, 0) for s, n in pool.counts.items()}
            split = max((s for s, n in over.items() if n > 0), default=0)
            if split:
                times = min(times, pool.counts[split] // (pattern.get(split, 0) + 1))
            else:
                times = 1
        offset = 0
        for size, n in sorted(pattern.items(), reverse=True):
            for _ in range(n):
                at = sequence
                for origin, lo, hi, cut in pool.take(size, times):
                    rows.append((origin, lo, hi, cut, size, at, offset))
                    at += hi - lo
                offset += size
        if split:
            at, tail = sequence, []
            for origin, lo, hi, cut in pool.take(split, times):
                rows.append((origin, lo, hi, cut, slack, at, offset))
                at += hi - lo
                tail.append((origin, lo, hi, cut + slack))
            pool.put(split - slack, tail)
        sequence += times
    return rows


class Places:
    """Which plan rows hold the remainder of a length and rank, found by one binary search.

    The ranks of a length are cut wherever a plan row begins or ends, so every rank lies in
    one interval; an interval lists its rows (one, and one more for each time that its
    remainders are cut). Intervals are at most twice the plan's rows.
    """

    RANKS = np.int64(1) << 48  # ranks of a length, by which lengths lie apart

    def __init__(self, rows: list[tuple[int, int, int, int, int, int, int]]):
        self.rows = np.array(rows, np.int64).reshape(-1, 7)
        lo, hi = (self.rows[:, 0] * self.RANKS + self.rows[:, i] for i in (1, 2))
        self.starts = np.unique(np.concatenate((lo, hi)))
        first, last = np.searchsorted(self.starts, lo), np.searchsorted(self.starts, hi)
        interval = np.concatenate([np.arange(a, b) for a, b in zip(first, last)] + [np.zeros(0, np.int64)]).astype(np.int64)
        order = np.argsort(interval, kind="stable")
        self.listed = np.repeat(np.arange(len(self.rows)), last - first)[order]
        self.n = np.bincount(interval, minlength=len(self.starts))
        self.at = np.cumsum(self.n) - self.n

    def find(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(asked place, plan row) of every row that holds a part of an asked remainder."""
        interval = np.searchsorted(self.starts, size.astype(np.int64) * self.RANKS + rank, "right") - 1
        n = self.n[interval]
        asked = np.repeat(np.arange(len(size)), n)
        nth = np.arange(len(asked)) - np.repeat(np.cumsum(n) - n, n)
        return asked, self.listed[self.at[interval][asked] + nth]


def place(ranked: DataFrame, rows: list[tuple[int, int, int, int, int, int, int]]) -> DataFrame:
    """piece, size, cut, piece_size, sequence_id, offset of every piece by its size and rank.

    The plan's rows are a few for every length and pattern and go with the tasks.
    """
    places = Places(rows)

    def found(batches):
        for batch in batches:
            size, rank = batch.column("size").to_numpy(), batch.column("rank").to_numpy()
            asked, at = places.find(size, rank)
            _, lo, _, cut, piece_size, first, offset = places.rows[at].T
            yield pa.record_batch([batch.column("piece").take(pa.array(asked)), batch.column("size").take(pa.array(asked)),
                                   pa.array(cut.astype(np.int32)), pa.array(piece_size.astype(np.int32)),
                                   pa.array(first + rank[asked] - lo), pa.array(offset)],
                                  names=["piece", "size", "cut", "piece_size", "sequence_id", "offset"])

    return ranked.select("piece", "size", F.col("rank").cast("long").alias("rank")).transform(
        map_arrow, found, "piece long, size int, cut int, piece_size int, sequence_id long, offset long")


def pack(spark: SparkSession, docs: DataFrame, tokenizer: str, ranks: str, pattern: str,
         window: int = WINDOW, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset per piece.

    Packed sequences are numbered from 0; a whole window's number follows from its piece
    number. The written table of pieces is in the shared scratch folder.
    """
    pieces = table(spark, cut_documents(docs, tokenizer, ranks, pattern, window, end_id), "pieces")
    whole = pieces.filter(F.col("length") == window)
    part = pieces.filter(F.col("length") < window).select("piece", "part", F.col("length").cast("int").alias("size"))
    by_task = part.groupBy("size", "part").agg(F.count("*").alias("n"))
    histogram = {r["size"]: r["n"] for r in by_task.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    rows = plan_windows(histogram, window)
    packed = max((first + hi - lo for _, lo, hi, _, _, first, _ in rows), default=0)

    before = by_task.select("size", "part", (F.sum("n").over(
        Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("before"))
    rank = F.row_number().over(Window.partitionBy("size", "part").orderBy("piece")) - 1
    ranked = part.withColumn("rank", rank).join(before, ["size", "part"]).select(
        "piece", "size", (F.col("rank") + F.col("before")).alias("rank"))
    placed = table(spark, place(ranked, rows), "placed")
    kept = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    remainders = pieces.filter(F.col("length") < window)
    # a row a document: the file of regular numbers is far smaller than its rows, so no broadcast by its size
    uncut = remainders.drop("ids").join(placed.hint("merge"), "piece").filter(F.col("piece_size") == F.col("length"))
    alone = whole.withColumns({"sequence_id": F.lit(packed) + F.col("piece"), "offset": F.lit(0).cast("long")})
    result = alone.select(kept).unionByName(uncut.select(kept))
    cut_rows = sum(hi - lo for origin, lo, hi, _, size, _, _ in rows if size != origin)
    if cut_rows:
        divided = placed.filter(F.col("piece_size") < F.col("size")).hint("broadcast" if cut_rows <= CUT_ROWS_SENT else "merge")
        result = result.unionByName(
            remainders.select("piece", "doc_id", "start", "doc_tokens", "ids").join(divided, "piece").withColumns({
                "ids_crc32": F.crc32(F.substring("ids", F.col("cut") * 4 + 1, F.col("piece_size") * 4)),
                "start": F.col("start") + F.col("cut"), "length": F.col("piece_size").cast("long")}).select(kept))
    return result
