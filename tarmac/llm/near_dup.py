"""Near-duplicate classes by improved consistent weighted sampling.

Words are lower-cased and separated by white space; shingles are ``WORDS`` of them in a
row (a shorter text is one shingle). The j-th occurrence of a shingle in a text is an
element of its own, so a text is a set of elements weighted by the inverse document
frequency of their shingle, and the weighted Jaccard similarity of two texts is that of
their TF-IDF vectors. Document frequencies are counted over all rows, by shingle hashes
of 32 bits and those that number the parts, of which there are the more the larger the
input (over 5,000 hash values a shingle); the damped weight
1 + IDF_SPAN * ln(N / df) / ln(N) is rounded down to one of ``LEVELS`` levels, so texts
that thousands copy keep their similarity. Texts are dealt into places, runs of
neighbours of about ``PLACE_BYTES``, and written in that order; a place tells a part each
shingle once, with the number of its texts that hold it, so a shingle in every text is one
entry a place and a text that a third of the rows repeat lies in as many places as its
copies. A part counts its shingles and answers every place with the levels of those that
are not in one text only, so no table of all shingles is held anywhere. Parts and places
grow in number with the input, without a cap.

Sampling: for sample k an element of weight w draws r, c from Gamma(2, 1) and b from U(0, 1), all
fixed by its hash, and t = floor(ln w / r + b), a = c * exp(-r * (t - b + 1)); the
element with the least a is the sample (with weights fixed by the element, t adds
nothing to the comparison). Draws are tables of ``CELLS`` cells per sample, an order of
the cells by a for each level, and elements of one cell are ordered by their hash.
``BANDS`` bands of ``ROWS`` samples each give the buckets: two texts of similarity s
meet in one with probability 1 - (1 - s**ROWS)**BANDS, over 0.999 for s >= 0.8.

Links: exact copies are one node. In every bucket all members are paired with its
center, the member whose buckets are the largest in all (never with each other, so a
bucket costs its size), pairs are verified by the exact weighted Jaccard similarity of
their elements, and components are formed. Members left
outside their bucket's largest component are then paired with the members of the
other components, unless an exact bound on what they can have in common or the sampled
similarity rules the pair out, and verified likewise; so a link is not lost because the center is no match. Components of
all verified links are the classes.

Defined cases: null texts and texts without a word are a class of their own each. A
class is named by its least doc_id; a null doc_id names a class only if it is alone.
Repeated rows are copies. Extra columns are ignored; ``keep_one`` passes them on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm.blocks import blocks, text_bytes, word_hashes
from tarmac.llm.common import WORD, drop_table, map_arrow, swept_table, table
from tarmac.llm.components import component_roots
from tarmac.session import broadcasts_by_run_size, shuffle_partitions_for

WORDS = 5
SIMILARITY = 0.8
BANDS = 20
ROWS = 5
SAMPLES = BANDS * ROWS
# Shingles that a part of the document frequencies counts, and bytes of text of a place.
PART_SHINGLES = 1 << 19
PLACE_BYTES = 1 << 24
ROW_BYTES = 16  # what a row counts for besides its text
LEAST_PLACE = 1 << 16  # bytes
LEAST_PARTS = 8  # bits
# A part's number and 32 bits tell shingles apart; with this many they are the whole hash.
HASH_PARTS = 32  # bits
# Shingles of a place that a task sorts at once before it sends them to their parts.
ASKED_AT_ONCE = 1 << 21
IDF_SPAN = 0.25
LEVELS = 8
CELLS = 1 << 12
# Samples that must agree (by NIBBLE bits of each) before a pair is verified: pairs of
# similarity 0.8 that share a band agree in 82 of 100 on average, with a standard deviation of 4.
LEAST_AGREEMENT = 67
NIBBLE = 4
_IN_LONG = 64 // NIBBLE
SKETCH = -(-SAMPLES // _IN_LONG)
# One-bit samples by which pairs from mixed buckets are filtered, and how many may
# differ: pairs of similarity 0.8 differ in 51 on average, with a standard deviation of 7.
FINE_SAMPLES = 512
MOST_APART = 78

_RNG = np.random.RandomState(4021)
_ODD = _RNG.randint(0, 1 << 62, SAMPLES).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_FINE_ODD = _RNG.randint(0, 1 << 62, FINE_SAMPLES).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_MIX = _RNG.randint(0, 1 << 62, ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SHINGLE_MIX = _RNG.randint(0, 1 << 62, WORDS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_LEVEL_WEIGHT = 1.0 + IDF_SPAN * np.arange(LEVELS) / LEVELS


def _sample_order() -> np.ndarray:
    """Rank of a for every (sample, level, cell), shifted to the top 16 bits."""
    shape = (SAMPLES, CELLS)
    r, c, b = _RNG.gamma(2.0, 1.0, shape), _RNG.gamma(2.0, 1.0, shape), _RNG.uniform(0.0, 1.0, shape)
    out = np.empty((SAMPLES, LEVELS, CELLS), np.uint64)
    ln_w = np.log(_LEVEL_WEIGHT)[None, :, None]
    t = np.floor(ln_w / r[:, None, :] + b[:, None, :])
    a = np.log(c)[:, None, :] - r[:, None, :] * (t - b[:, None, :] + 1.0)
    for k in range(SAMPLES):
        order = np.empty(LEVELS * CELLS, np.uint64)
        order[np.argsort(a[k].ravel(), kind="stable")] = np.arange(LEVELS * CELLS, dtype=np.uint64)
        out[k] = order.reshape(LEVELS, CELLS)
    return (out << np.uint64(48)).reshape(SAMPLES, LEVELS * CELLS)


_ORDER: list[np.ndarray] = []


def sample_order() -> np.ndarray:
    if not _ORDER:
        _ORDER.append(_sample_order())
    return _ORDER[0]


def elements(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(rows, first element of each row, element hashes, shingles, first of its shingle) by groups of rows.

    Rows without a word are left out. Elements of a row are sorted by shingle.
    """
    texts = text_bytes(pc.utf8_lower(column.cast(pa.string())))
    words: list[np.ndarray] = []
    rows: list[int] = []
    size = 0
    for row, h in _row_words(texts):
        if not len(h):
            continue
        rows.append(row)
        words.append(h)
        size += len(h)
        if size > 1 << 18:
            yield _shingled(np.array(rows), words)
            rows, words, size = [], [], 0
    if rows:
        yield _shingled(np.array(rows), words)


def _row_words(texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    """(row, word hashes) of every text, the pieces of a long text joined."""
    held_row, held = -1, []
    for rows, data, starts in blocks(texts):
        h, piece = word_hashes(data, starts)
        cut = np.searchsorted(piece, np.arange(len(rows) + 1))
        for k, row in enumerate(rows):
            if row != held_row:
                if held_row >= 0:
                    yield held_row, held[0] if len(held) == 1 else np.concatenate(held)
                held_row, held = row, []
            held.append(h[cut[k]:cut[k + 1]])
    if held_row >= 0:
        yield held_row, held[0] if len(held) == 1 else np.concatenate(held)


def _shingled(rows: np.ndarray, words: list[np.ndarray]):
    sizes = np.array([len(w) for w in words])
    h = np.concatenate(words + [np.zeros(WORDS - 1, np.uint64)])
    total = int(sizes.sum())
    s = np.zeros(total, np.uint64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    at = np.arange(total)
    for i in range(WORDS):
        # a text of fewer words is one shingle of what it has
        s += np.where(at + i < ends, h[i:total + i], np.uint64(0)) * _SHINGLE_MIX[i]
    s = (s ^ (s >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    s ^= s >> np.uint64(30)
    which = np.repeat(np.arange(len(rows)), sizes)
    first_word = np.repeat(np.cumsum(sizes) - sizes, sizes)
    whole = (at + WORDS <= ends) | (at == first_word)
    s, which = s[whole], which[whole]
    order = np.lexsort((s, which))
    s, which = s[order], which[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (which[1:] != which[:-1])
    begin = np.flatnonzero(new)
    nth = np.arange(len(s)) - np.repeat(begin, np.diff(begin, append=len(s)))
    element = (s + nth.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)) * np.uint64(0x9E3779B97F4A7C15)
    element ^= element >> np.uint64(32)
    first = np.searchsorted(which, np.arange(len(rows)))
    return rows, first, element, s, new


def placed(docs: DataFrame, place_bytes: int) -> DataFrame:
    """doc_id, text and place of every row: a place is a run of rows of one input task.

    Which rows are neighbours depends on the task's order, so the result is to be written.
    """
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def deal(batches):
        from pyspark import TaskContext

        first, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64) + ROW_BYTES
            before = size + np.cumsum(sizes) - sizes
            size += int(sizes.sum())
            yield pa.record_batch([batch.column("doc_id"), batch.column("text"), pa.array(first + before // place_bytes)],
                                  names=["doc_id", "text", "place"])

    return narrow.transform(map_arrow, deal, "doc_id long, text string, place long")


def layout(docs: DataFrame) -> tuple[int, int, int, int]:
    """(rows, bytes of text, bits of the part number, bytes of a place)."""
    size = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(F.col("text").cast("string"))).alias("bytes")).first()
    total = size["bytes"] or 0
    parts = total // 6 // PART_SHINGLES  # a word is about 6 bytes
    bits = min(HASH_PARTS, max(LEAST_PARTS, parts.bit_length()))
    return size["n"], total, bits, min(PLACE_BYTES, max(LEAST_PLACE, total >> LEAST_PARTS))


def _keys(shingle: np.ndarray, bits: int) -> np.ndarray:
    """The part number and the 32 bits by which a part knows a shingle."""
    return shingle >> np.uint64(32 - bits)


def _binary(joined: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """Binary cells of ``sizes`` numbers each."""
    ends = np.concatenate(([0], np.cumsum(sizes) * joined.itemsize)).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(joined))])


def _numbers(cells: pa.ChunkedArray, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all binary cells, joined, and how many each cell holds."""
    held = [np.zeros(0, np.uint8)]
    for chunk in cells.chunks:
        if len(chunk):
            ends = np.frombuffer(chunk.buffers()[1], np.int32)[chunk.offset:chunk.offset + len(chunk) + 1]
            held.append(np.frombuffer(chunk.buffers()[2], np.uint8)[ends[0]:ends[-1]])
    return np.concatenate(held).view(kind), pc.binary_length(cells).to_numpy() // np.dtype(kind).itemsize


ASKED = "place long, part long, hashes binary, counts binary"
ANSWERS = "place long, part long, hashes binary, levels binary"


def _asked(texts: DataFrame, bits: int) -> DataFrame:
    """ASKED: the shingles of each place by their part, with the number of its texts that hold them."""
    def packed(place, held):
        x, n = np.unique(np.concatenate(held), return_counts=True)
        part = x >> np.uint64(32)
        cut = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        sizes = np.diff(cut, append=len(x))
        return pa.record_batch([pa.array(np.full(len(cut), place, np.int64)), pa.array(part[cut].astype(np.int64)),
                                _binary(x.astype(np.uint32), sizes), _binary(n.astype(np.uint32), sizes)],
                               names=["place", "part", "hashes", "counts"])

    def ask(batches):
        at, held, size = None, [], 0
        for batch in batches:
            places = batch.column("place").to_numpy()
            for rows, first, _, shingle, new in elements(batch.column("text")):
                key = _keys(shingle[new], bits)
                ends = np.cumsum(np.add.reduceat(new.astype(np.int64), first))
                of = places[rows]
                last = np.flatnonzero(np.append(of[1:] != of[:-1], True))
                for place, part in zip(of[last], np.split(key, ends[last[:-1]])):
                    if held and (place != at or size > ASKED_AT_ONCE):
                        yield packed(at, held)
                        held, size = [], 0
                    at = place
                    held.append(part)
                    size += len(part)
        if held:
            yield packed(at, held)

    return texts.select("place", "text").transform(map_arrow, ask, ASKED)


def document_levels(texts: DataFrame, n: int, bits: int) -> DataFrame:
    """ANSWERS: per place and part the levels of its shingles, where they differ from that of a shingle of one text.

    A part holds about ``PART_SHINGLES`` entries, and one a place for a shingle in every text.
    """
    usual = idf_levels(np.array([1]), n)[0]

    def answer(asked: pa.Table) -> pa.Table:
        hashes, sizes = _numbers(asked.column("hashes"), np.uint32)
        counts, _ = _numbers(asked.column("counts"), np.uint32)
        _, which = np.unique(hashes, return_inverse=True)
        level = idf_levels(np.bincount(which, weights=counts).astype(np.int64), n)[which]
        told = level != usual
        kept = np.add.reduceat(told.astype(np.int64), np.cumsum(sizes) - sizes)
        some = pa.array(kept > 0)
        return pa.table([asked.column("place").filter(some), asked.column("part").filter(some),
                         _binary(hashes[told], kept[kept > 0]), _binary(level[told], kept[kept > 0])],
                        names=["place", "part", "hashes", "levels"])

    return _asked(texts, bits).groupBy("part").applyInArrow(answer, ANSWERS)


def idf_levels(df: np.ndarray, n: int) -> np.ndarray:
    """Level of each document frequency: 0 for one in every text, LEVELS - 1 for the rarest."""
    rarity = np.log((n + 1.0) / (df + 1.0)) / np.log(n + 2.0)
    return np.clip((rarity * LEVELS).astype(np.int64), 0, LEVELS - 1).astype(np.uint8)


def signatures(first: np.ndarray, element: np.ndarray, level: np.ndarray, odd: np.ndarray = _ODD) -> np.ndarray:
    """Consistent weighted samples, one row per text and one column per multiplier."""
    order = sample_order()
    out = np.empty((len(first), len(odd)), np.uint64)
    base = level.astype(np.int64) * CELLS
    for k in range(len(odd)):
        x = element * odd[k]
        cell = (x >> np.uint64(52)).astype(np.int64)
        cell += base
        key = order[k % SAMPLES][cell]
        x <<= np.uint64(12)
        x >>= np.uint64(16)
        key |= x
        out[:, k] = np.minimum.reduceat(key, first)
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


class PlaceLevels:
    """Levels of the shingles of one place's texts, from the answers of all parts."""

    def __init__(self, answers: list[tuple[int, bytes, bytes]], usual: int, bits: int):
        self.usual, self.bits = usual, bits
        keys = [np.frombuffer(h, np.uint32).astype(np.uint64) | np.uint64(part << 32) for part, h, _ in answers]
        self.keys = np.concatenate([np.zeros(0, np.uint64), *keys])
        order = np.argsort(self.keys)
        self.keys = self.keys[order]
        self.levels = np.frombuffer(b"".join(v for _, _, v in answers), np.uint8)[order]

    def of(self, shingle: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(shingle), self.usual, np.uint8)
        key = _keys(shingle, self.bits)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.levels[at], self.usual).astype(np.uint8)


SIGNED = "doc_id long, digest binary, weight double, bits array<long>, bands array<long>, levels binary"


def sign(docs: DataFrame, answers: DataFrame, n: int, bits: int) -> DataFrame:
    """SIGNED of every row; all but doc_id are null for a text without a word.

    The answers to a place arrive in front of its texts; levels are those of the elements.
    """
    usual = int(idf_levels(np.array([1]), n)[0])

    def signed(batches):
        place, told, levels = -1, [], None
        for batch in batches:
            places = batch.column("place").to_numpy()
            is_text = np.array(batch.column("hashes").is_null().to_pylist(), bool)
            cut = np.flatnonzero(np.diff(places * 2 + is_text, prepend=-1))
            for lo, hi in zip(cut, [*cut[1:], batch.num_rows]):
                if places[lo] != place:
                    place, told, levels = places[lo], [], None
                run = batch.slice(lo, hi - lo)
                if not is_text[lo]:
                    told += zip(*(run.column(c).to_pylist() for c in ("part", "hashes", "levels")))
                    continue
                if levels is None:
                    levels, told = PlaceLevels(told, usual, bits), []
                yield _signed(run.take(pa.array(range(run.num_rows))), levels)  # a copy without offsets

    texts = docs.withColumn("digest", _digest())
    both = texts.unionByName(answers, allowMissingColumns=True).repartition("place").sortWithinPartitions("place", F.col("hashes").isNull())
    return both.transform(map_arrow, signed, SIGNED)


def _signed(batch: pa.RecordBatch, levels: PlaceLevels) -> pa.RecordBatch:
    n = batch.num_rows
    weight, bits = np.full(n, np.nan), np.zeros((n, SKETCH), np.uint64)
    bands = np.zeros((n, BANDS), np.uint64)
    told: list[bytes | None] = [None] * n
    for rows, first, element, shingle, _ in elements(batch.column("text")):
        level = levels.of(shingle)
        got = _mixed(signatures(first, element, level))
        weight[rows] = np.add.reduceat(_LEVEL_WEIGHT[level], first)
        low = np.zeros((len(rows), SKETCH * _IN_LONG), np.uint64)
        low[:, :SAMPLES] = got & np.uint64(2**NIBBLE - 1)
        shifts = np.arange(0, 64, NIBBLE, dtype=np.uint64)
        bits[rows] = (low.reshape(len(rows), SKETCH, _IN_LONG) << shifts).sum(axis=2)
        banded = _mixed((got.reshape(len(rows), BANDS, ROWS) * _BAND_MIX).sum(axis=2))
        bands[rows] = banded + np.arange(BANDS, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
        for row, part in zip(rows, np.split(level, first[1:])):
            told[row] = part.tobytes()
    empty = pa.array(np.isnan(weight))
    listed = lambda x: pa.ListArray.from_arrays(pa.array(np.arange(0, n + 1, dtype=np.int32) * x.shape[1]),
                                                pa.array(x.view(np.int64).ravel()))
    none = lambda x: pc.if_else(empty, pa.scalar(None, x.type), x)
    return pa.record_batch([batch.column("doc_id"), none(batch.column("digest").cast(pa.binary())), none(pa.array(weight)),
                            none(listed(bits)), none(listed(bands)), pa.array(told, pa.binary())],
                           names=[f.split()[0] for f in SIGNED.split(", ")])


def _digest():
    return F.unhex(F.md5(F.col("text").cast("string").cast("binary")))


def _payloads(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, total, payload): sorted elements with their level in the low bits."""
    def packed(batches):
        for batch in batches:
            nodes = batch.column("node").to_numpy()
            ids, totals, raw = [], [], []
            told = batch.column("levels").to_pylist()
            for rows, first, element, _, _ in elements(batch.column("text")):
                level = np.frombuffer(b"".join(told[row] for row in rows), np.uint8)
                total = np.add.reduceat(_LEVEL_WEIGHT[level], first)
                tagged = (element & np.uint64(2**64 - LEVELS)) | level.astype(np.uint64)
                for row, part, w in zip(rows, np.split(tagged, first[1:]), total):
                    ids.append(int(nodes[row]))
                    totals.append(float(w))
                    raw.append(np.sort(part).tobytes())
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(totals, pa.float64()), pa.array(raw, pa.binary())],
                                  names=["node", "total", "payload"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("digest", _digest())
    # one row per distinct text: repeated (doc_id, text) rows fall together
    found = texts.join(wanted, (texts["digest"] == wanted["key"]) & texts["doc_id"].eqNullSafe(wanted["named"]))
    return found.select("node", "levels", "text").transform(map_arrow, packed, "node long, total double, payload binary").dropDuplicates(["node"])


def _verified(pairs: DataFrame, payloads: DataFrame, similarity: float) -> DataFrame:
    """(a, b, similarity) of the pairs that are similar enough by their elements."""
    def check(batches):
        for batch in batches:
            keep, sims = [], []
            for i in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[i].as_py(), np.uint64) for c in ("pa", "pb"))
                both = np.intersect1d(x, y, assume_unique=True)
                shared = _LEVEL_WEIGHT[(both & np.uint64(LEVELS - 1)).astype(np.int64)].sum()
                s = shared / (batch.column("ta")[i].as_py() + batch.column("tb")[i].as_py() - shared)
                if s >= similarity - 1e-9:
                    keep.append(i)
                    sims.append(s)
            at = pa.array(keep, pa.int64())
            yield pa.record_batch([batch.column("a").take(at), batch.column("b").take(at), pa.array(sims, pa.float64())],
                                  names=["a", "b", "similarity"])

    one = payloads.select(F.col("node").alias("a"), F.col("total").alias("ta"), F.col("payload").alias("pa"))
    two = payloads.select(F.col("node").alias("b"), F.col("total").alias("tb"), F.col("payload").alias("pb"))
    return pairs.select("a", "b").join(one, "a").join(two, "b").select("a", "b", "ta", "tb", "pa", "pb").transform(map_arrow, 
        check, "a long, b long, similarity double")


def near_duplicates(spark: SparkSession, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, digest, class_id, keeper of every row; keeper is the kept text's digest."""
    if similarity < SIMILARITY:
        raise ValueError(f"bands and sketch bounds are made for a similarity of {SIMILARITY} or more, not {similarity}")
    n, size, bits, place_bytes = layout(docs)
    with shuffle_partitions_for(spark, size), broadcasts_by_run_size(spark):
        return _classes(spark, docs, similarity, n, bits, place_bytes)


def _classes(spark: SparkSession, docs: DataFrame, similarity: float, n: int, bits: int, place_bytes: int) -> DataFrame:
    dealt = table(spark, placed(docs, place_bytes), "placed")
    answers = swept_table(spark, document_levels(dealt, n, bits), "levels")
    rows = swept_table(spark, sign(dealt, answers, n, bits), "signed")
    for done in (dealt, answers):
        drop_table(spark, done)
    texts = rows.filter("digest IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("named"), F.first("weight").alias("weight"), F.first("bits").alias("bits"), F.first("bands").alias("bands"),
        F.first("levels").alias("levels"))
    nodes = table(spark, texts.withColumn("node", F.monotonically_increasing_id()), "nodes")
    banded = nodes.select("node", F.explode("bands").alias("bucket"))
    members = table(spark, _members(banded), "members")
    in_buckets = members.select("node").distinct()
    wanted = nodes.join(in_buckets, "node").select("node", F.col("digest").alias("key"), "named", "levels")
    payloads = swept_table(spark, _payloads(docs, wanted), "payloads")

    sketch = nodes.select("node", "weight", "bits", "bands")
    first = members.filter("node <> center").select(F.greatest("node", "center").alias("a"), F.least("node", "center").alias("b")).distinct()
    links = table(spark, _verified(_alike(first, sketch, similarity), payloads, similarity), "verified")
    roots = component_roots(spark, links)
    second = _left_over(spark, members, roots, sketch, payloads, similarity).join(links.select("a", "b"), ["a", "b"], "left_anti")
    more = table(spark, _verified(second, payloads, similarity), "verified")
    for done in (members, payloads):
        drop_table(spark, done)
    if not more.isEmpty():
        roots = component_roots(spark, links.select("a", "b").unionByName(more.select("a", "b")))
    # planned when the caller runs it: the hints keep the driver from gathering a row a text
    classed = nodes.select("node", "digest", "named").join(roots.hint("merge"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = classed.groupBy("root").agg(F.min(F.struct(F.col("named").isNull().alias("x"), F.col("named").alias("class_id"), F.col("digest").alias("keeper"))).alias("k"))
    named = classed.join(least.hint("merge"), "root").select("digest", F.col("k.class_id").alias("class_id"), F.col("k.keeper").alias("keeper"))
    return rows.select("doc_id", "digest").join(named.hint("merge"), "digest", "left").select(
        "doc_id", "digest", F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), "keeper")


def _members(banded: DataFrame) -> DataFrame:
    """(bucket, node, center) of the buckets with several members.

    The center is the member whose buckets are the largest in all: the text that most
    copies were made from shares more buckets with them than they do with each other.
    """
    sized = banded.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    members = banded.join(sized, "bucket")
    middle = members.groupBy("node").agg(F.sum("n").alias("reach"))
    center = members.join(middle, "node").groupBy("bucket").agg(F.max(F.struct("reach", (-F.col("node")).alias("node"))).alias("c"))
    return members.join(center, "bucket").select("bucket", "node", (-F.col("c.node")).alias("center"))


def _alike(pairs: DataFrame, sketch: DataFrame, similarity: float) -> DataFrame:
    """Pairs whose total weights and sampled bits allow the similarity."""
    one = sketch.select(F.col("node").alias("a"), F.col("weight").alias("weight_1"), F.col("bits").alias("bits_1"))
    two = sketch.select(F.col("node").alias("b"), F.col("weight").alias("weight_2"), F.col("bits").alias("bits_2"))
    return pairs.join(one, "a").join(two, "b").filter(_may_match(similarity)).select("a", "b")


def _may_match(similarity: float):
    least, most = F.least("weight_1", "weight_2"), F.greatest("weight_1", "weight_2")
    ones = F.lit(int("1" * _IN_LONG, 16)).cast("long")  # the low bit of each nibble
    apart = F.lit(0)
    for i in range(SKETCH):
        x = F.get("bits_1", i).bitwiseXOR(F.get("bits_2", i))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        apart += F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 2)).bitwiseAND(ones))
    return (least >= most * (similarity - 1e-9)) & (SAMPLES - apart >= LEAST_AGREEMENT)


def _shared_weights(payloads: DataFrame) -> DataFrame:
    """(node, common): weight of a node's elements that some other of the nodes holds."""
    def listed(batches):
        for batch in batches:
            nodes, raw = batch.column("node").to_numpy(), batch.column("payload").to_pylist()
            for lo in range(0, len(raw), 64):
                parts = [np.frombuffer(x, np.int64) for x in raw[lo:lo + 64]]
                owner = np.repeat(nodes[lo:lo + 64], [len(x) for x in parts])
                yield pa.record_batch([pa.array(np.concatenate(parts)), pa.array(owner)], names=["element", "node"])

    level = F.col("element").bitwiseAND(F.lit(LEVELS - 1).cast("long"))
    private = payloads.select("node", "payload").transform(map_arrow, listed, "element long, node long").groupBy("element").agg(
        F.count("*").alias("n"), F.min("node").alias("node")).filter("n = 1").groupBy("node").agg(
        F.sum(1.0 + IDF_SPAN / LEVELS * level).alias("private"))
    return payloads.select("node", "total").join(private, "node", "left").select(
        "node", (F.col("total") - F.coalesce("private", F.lit(0.0))).alias("common"))


def _fine_sketches(payloads: DataFrame) -> DataFrame:
    """(node, fine): FINE_SAMPLES one-bit consistent weighted samples of each node."""
    def sketched(batches):
        for batch in batches:
            nodes, raw = batch.column("node"), batch.column("payload").to_pylist()
            for lo in range(0, len(raw), 64):
                parts = [np.frombuffer(x, np.uint64) for x in raw[lo:lo + 64]]
                first = np.cumsum([0] + [len(x) for x in parts[:-1]])
                flat = np.concatenate(parts)
                got = signatures(first, flat, flat & np.uint64(LEVELS - 1), _FINE_ODD)
                bits = np.packbits((_mixed(got) & np.uint64(1)).astype(np.uint8), axis=1, bitorder="little").view(np.int64)
                yield pa.record_batch([nodes.slice(lo, len(parts)), pa.array(list(bits), pa.list_(pa.int64()))], names=["node", "fine"])

    return payloads.select("node", "payload").transform(map_arrow, sketched, "node long, fine array<long>")


def _left_over(spark: SparkSession, members: DataFrame, roots: DataFrame, sketch: DataFrame, payloads: DataFrame,
               similarity: float) -> DataFrame:
    """Pairs of one bucket in different components, at least one outside the largest.

    What two texts have in common is at most the lesser of their weights that any other
    text of these buckets shares; this bound leaves out only pairs that cannot reach
    the similarity, and keeps the many variants of one text from meeting each other.
    """
    placed = members.select("bucket", "node").join(roots, "node", "left").select(
        "bucket", "node", F.coalesce("root", "node").alias("root"))
    sized = placed.groupBy("bucket", "root").agg(F.count("*").alias("n"))
    largest = sized.groupBy("bucket").agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("parts")).filter("parts > 1")
    mixed = table(spark, placed.join(largest.select("bucket", "main"), "bucket"), "mixed")
    shared = _shared_weights(payloads.join(mixed.select("node").distinct(), "node"))
    able = sketch.select("node", "weight", "bands").join(shared, "node").filter(F.col("common") >= F.col("weight") * similarity - 1e-6)
    fine = _fine_sketches(payloads.join(able.select("node"), "node", "left_semi"))
    full = mixed.join(table(spark, able.join(fine, "node"), "able"), "node")
    fields = ("node", "root", "main", "weight", "fine", "bands", "common")
    suffix = lambda df, i: df.select("bucket", *(F.col(c).alias(f"{c}_{i}") for c in fields))
    out, every = suffix(full.filter("root <> main"), 1), suffix(full, 2)
    most = F.least("common_1", "common_2")
    reachable = most * (1 + similarity) >= (F.col("weight_1") + F.col("weight_2")) * similarity - 1e-6
    apart = F.lit(0)
    for i in range(FINE_SAMPLES // 64):
        apart += F.bit_count(F.get("fine_1", i).bitwiseXOR(F.get("fine_2", i)))
    pairs = out.join(every, "bucket").filter(
        (F.col("root_1") != F.col("root_2")) & ((F.col("root_2") == F.col("main_2")) | (F.col("node_1") > F.col("node_2")))
        & reachable & (apart <= MOST_APART)
        # a pair comes from the least of the buckets it shares
        & (F.array_min(F.array_intersect("bands_1", "bands_2")) == F.col("bucket")))
    return pairs.select(F.greatest("node_1", "node_2").alias("a"), F.least("node_1", "node_2").alias("b")).distinct()


def keep_one(spark: SparkSession, docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` (all columns), one of each class: the class's named text.

    Rows without a word are no copies of anything and stay.
    """
    kept = near_duplicates(spark, docs, similarity).filter("digest = keeper AND doc_id <=> class_id").select(
        F.col("doc_id").alias("kept_id"), F.col("digest").alias("kept_digest")).distinct()
    worded = F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    # the row travels as one struct, so no column of docs can clash with the keys
    texts = docs.filter(worded).select(F.struct(*(docs[c] for c in docs.columns)).alias("row"),
                                       F.col("doc_id").cast("long").alias("key_id"), _digest().alias("key_digest"))
    found = texts.join(kept.hint("merge"), texts["key_id"].eqNullSafe(kept["kept_id"]) & (texts["key_digest"] == kept["kept_digest"]), "left_semi")
    return found.dropDuplicates(["key_id", "key_digest"]).select("row.*").unionByName(docs.filter(~worded))
