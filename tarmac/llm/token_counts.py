"""Token counts under a unigram model: a trie of pre-tokens, one score per prefix.

Pre-tokens: a run of non-white bytes with the one space before it, if there is one;
what else stands between is a pre-token of white space. The unigram model is a public
vocabulary of byte pieces (a path, never trained here): the piece of rank r has
probability proportional to 1 / (r + ``ZIPF_SHIFT``). A pre-token's tokens are the
segmentation of the highest summed log probability; of equal scores the one with fewer
tokens wins, then the one whose last piece is shorter.

The distinct pre-tokens of a block are sorted, so pre-tokens with a common prefix are
neighbours and every trie node is the first row that shows its prefix. Scores are
computed level by level, once per node: the best over all pieces that end the prefix
of the node's ancestors' score plus the piece's. A terminal node stores its token
count. Counts of frequent pre-tokens stay in a bounded table between blocks; a text's
count is the sum over its pre-tokens.

A pre-token over ``LONG`` bytes (a sentence of an unspaced script, a URL) is first cut
wherever no piece of the vocabulary can lie across: every segmentation has a border there,
so the parts are segmented alone and their counts add up. The parts enter the trie like
pre-tokens. Only a part that is itself over ``LONG`` bytes (one letter or a run of letters
without a border) is scored by the same recurrence alone, along a trie of the pieces.

Defined cases: null and empty texts have 0 of everything. Repeated rows count alike;
extra columns are ignored. Texts longer than a block are cut at a space, which is
always the border of two pre-tokens.
"""

from __future__ import annotations

import base64
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.blocks import NON_WHITE, blocks, span_hashes, text_bytes
from tarmac.llm.common import map_arrow

ZIPF_SHIFT = 2.7
LONG = 48
ROWS_AT_ONCE = 1 << 13
KEPT = 1 << 20
# Bytes looked at, and parts counted, at once of long pre-tokens.
BYTES_AT_ONCE = 1 << 20
PARTS_AT_ONCE = 1 << 17

_RNG = np.random.RandomState(77)
_STEP = np.uint64(int(_RNG.randint(1, 1 << 62)) * 2 + 1)
_BYTE = _RNG.randint(0, 1 << 62, 256).astype(np.uint64) * np.uint64(4) + np.uint64(1)


class UnigramPieces:
    """Pieces and log probabilities, with per-length hash tables for whole levels."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(p): int(r) for p, r in map(bytes.split, lines)}
        total = np.log(sum(1.0 / (r + ZIPF_SHIFT) for r in ranks.values()))
        self.logp = {p: float(-np.log(r + ZIPF_SHIFT) - total) for p, r in ranks.items()}
        self.longest = max(map(len, self.logp))
        self.levels = {}
        with np.errstate(over="ignore"):
            self.powers = np.cumprod(np.full(self.longest + 1, _STEP), dtype=np.uint64)
            for n in range(1, self.longest + 1):
                pieces = [p for p in self.logp if len(p) == n]
                if pieces:
                    h = np.zeros(len(pieces), np.uint64)
                    at = np.frombuffer(b"".join(pieces), np.uint8).reshape(-1, n)
                    for k in range(n):
                        h = h * _STEP + _BYTE[at[:, k]]
                    order = np.argsort(h)
                    self.levels[n] = h[order], np.array([self.logp[p] for p in pieces])[order]

    @cached_property
    def inside(self) -> tuple[np.ndarray, np.ndarray]:
        """Which two bytes are a piece, and which three stand next to each other in one."""
        two, three = np.zeros(1 << 16, bool), np.zeros(1 << 24, bool)
        for p in self.logp:
            if len(p) == 2:
                two[p[0] << 8 | p[1]] = True
            for i in range(len(p) - 2):
                three[p[i] << 16 | p[i + 1] << 8 | p[i + 2]] = True
        return two, three

    @cached_property
    def walk(self) -> tuple[dict[int, int], list[float | None]]:
        """A trie of the pieces: the next node by node * 256 + byte, and each node's log probability."""
        step: dict[int, int] = {}
        logp: list[float | None] = [None]
        for p, score in self.logp.items():
            node = 0
            for byte in p:
                key = node << 8 | byte
                if key not in step:
                    step[key] = len(logp)
                    logp.append(None)
                node = step[key]
            logp[node] = score
        return step, logp

    def borders(self, raw: bytes, begin: np.ndarray) -> np.ndarray:
        """Starts of the parts of the words that begin at ``begin``: no piece lies across one."""
        two, three = self.inside
        data = np.frombuffer(raw, np.uint8)
        border = np.zeros(len(data), bool)
        for lo in range(0, len(data), BYTES_AT_ONCE):
            # two bytes more on each side; a piece across a place shows the three bytes
            # up to it or around it, or is the two bytes at it
            a, z = max(0, lo - 2), min(len(data), lo + BYTES_AT_ONCE + 1)
            x = data[a:z].astype(np.int32)
            pair = x[:-1] << 8 | x[1:]
            across = np.zeros(len(x), bool)
            across[1:] = two[pair]
            if len(x) > 2:
                within = three[pair[:-1] << 8 | x[2:]]
                across[1:-1] |= within
                across[2:] |= within
            hi = min(len(data), lo + BYTES_AT_ONCE)
            border[lo:hi] = ~across[lo - a:hi - a]
        border[begin] = True
        return np.flatnonzero(border)

    def run_count(self, raw: bytes) -> int:
        """Tokens of one run of bytes, along the trie of the pieces from each place."""
        step, logp = self.walk
        n = len(raw)
        best, count = [-np.inf] * (n + 1), [0] * (n + 1)
        best[0] = 0.0
        for start in range(n):
            before, t, node = best[start], count[start] + 1, 0
            for end in range(start, n):
                node = step.get(node << 8 | raw[end])
                if node is None:
                    break
                p = logp[node]
                if p is not None:
                    s, at = before + p, end + 1
                    if s > best[at] or (s == best[at] and t < count[at]):
                        best[at], count[at] = s, t
        return count[n]

    def counts(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each of the distinct words."""
        out = self._distinct([w if len(w) <= LONG else b"" for w in words])
        long = np.array([i for i, w in enumerate(words) if len(w) > LONG], np.int64)
        if len(long):
            raw = b"".join(words[i] for i in long)
            begin = np.cumsum([0] + [len(words[i]) for i in long[:-1]])
            starts = self.borders(raw, begin)
            ends, owner = np.append(starts[1:], len(raw)), long[np.searchsorted(begin, starts, "right") - 1]
            for lo in range(0, len(starts), PARTS_AT_ONCE):
                known: dict[bytes, int] = {}
                part = slice(lo, lo + PARTS_AT_ONCE)
                which = [known.setdefault(raw[a:z], len(known)) for a, z in zip(starts[part].tolist(), ends[part].tolist())]
                np.add.at(out, owner[part], self._distinct(list(known))[which])
        return out

    def _distinct(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each word by one pass over the trie of those up to LONG bytes."""
        out = np.zeros(len(words), np.int64)
        for i, w in enumerate(words):
            if len(w) > LONG:
                out[i] = self.run_count(w)
        order = sorted((i for i, w in enumerate(words) if 0 < len(w) <= LONG), key=words.__getitem__)
        for lo in range(0, len(order), ROWS_AT_ONCE):
            part = order[lo:lo + ROWS_AT_ONCE]
            out[part] = self._trie([words[i] for i in part])
        return out

    def _trie(self, words: list[bytes]) -> np.ndarray:
        """``words`` sorted and at most LONG bytes each."""
        size = np.array([len(w) for w in words])
        depth = int(size.max())
        text = np.frombuffer(b"".join(w.ljust(depth, b"\0") for w in words), np.uint8).reshape(-1, depth)
        rows = np.arange(len(words))
        hashes = [np.zeros(len(words), np.uint64)]
        score, tokens = [np.zeros(len(words))], [np.zeros(len(words), np.int32)]
        out = np.zeros(len(words), np.int64)
        with np.errstate(over="ignore"):
            for d in range(1, depth + 1):
                h = hashes[-1] * _STEP + _BYTE[text[:, d - 1]]
                hashes.append(h)
                live = size >= d
                alive = rows[live]
                if not len(alive):
                    break
                fresh = np.ones(len(alive), bool)
                fresh[1:] = h[alive[1:]] != h[alive[:-1]]
                node = alive[fresh]  # the first word below each trie node
                best, count = np.full(len(node), -np.inf), np.zeros(len(node), np.int32)
                for n, (known, logp) in self.levels.items():
                    if n > d:
                        break
                    suffix = h[node] - hashes[d - n][node] * self.powers[n - 1]
                    at = np.minimum(np.searchsorted(known, suffix), len(known) - 1)
                    hit = np.flatnonzero(known[at] == suffix)
                    if len(hit):
                        s = score[d - n][node[hit]] + logp[at[hit]]
                        t = tokens[d - n][node[hit]] + 1
                        better = (s > best[hit]) | ((s == best[hit]) & (t < count[hit]))
                        best[hit[better]], count[hit[better]] = s[better], t[better]
                which = np.cumsum(fresh) - 1  # words below a node share its score
                full, full_t = np.zeros(len(words)), np.zeros(len(words), np.int32)
                full[alive], full_t[alive] = best[which], count[which]
                score.append(full)
                tokens.append(full_t)
                ends = size == d
                out[ends] = full_t[ends]
        return out


@lru_cache(maxsize=2)
def shared_counter(path: str) -> Counter:
    """One counter for all tasks that a Python worker runs."""
    return Counter(UnigramPieces(path))


def pretoken_spans(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans of the pre-tokens of a block's pieces, which lie behind one space each."""
    word = NON_WHITE[data].astype(bool)
    begin = np.zeros(len(data) + 1, bool)
    begin[:-1][1:] = word[1:] != word[:-1]  # a word or white space begins
    into = np.flatnonzero(begin[:-1] & word)
    spaced = into[data[into - 1] == 32]
    begin[spaced] = False
    begin[spaced - 1] = True  # with the space before it
    begin[starts + 1] = True  # the separating space is no text
    begin[starts] = True
    tail = starts[1:] if len(starts) else starts
    begin[tail] = True
    begin[len(data) - 1] = True  # the space behind the last piece
    cut = np.flatnonzero(begin[:-1])
    end = np.append(cut[1:], len(data))
    space = np.zeros(len(data), bool)
    space[starts] = space[-1] = True
    text = ~space[cut]
    return cut[text], end[text]


class Counter:
    """Token counts by pre-token hash, kept between blocks up to a bound."""

    def __init__(self, pieces: UnigramPieces, kept: int = KEPT):
        self.pieces, self.kept = pieces, kept
        self.hashes, self.tokens = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def look_up(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = span_hashes(data, starts, ends)
        known, first, where = np.unique(h, return_index=True, return_inverse=True)
        got = np.full(len(known), -1, np.int64)
        if len(self.hashes):
            at = np.minimum(np.searchsorted(self.hashes, known), len(self.hashes) - 1)
            hit = self.hashes[at] == known
            got[hit] = self.tokens[at[hit]]
        new = np.flatnonzero(got < 0)
        if len(new):
            raw = data.tobytes()
            got[new] = self.pieces.counts([raw[starts[i]:ends[i]] for i in first[new]])
            if len(self.hashes) + len(new) > self.kept:
                self.hashes, self.tokens = known, got
            else:
                at = np.searchsorted(self.hashes, known[new])
                self.hashes = np.insert(self.hashes, at, known[new])
                self.tokens = np.insert(self.tokens, at, got[new])
        return got[where]


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_bytes, n_pretokens, n_tokens of every whole text.

    ``vocabulary`` is the path of a rank file (base64 piece, rank) that every executor
    can open, as installed with the tokenizer package.
    """
    def count(batches):
        counter = shared_counter(vocabulary)
        for batch in batches:
            texts = text_bytes(batch.column("text"))
            pre, tokens = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
            for rows, data, starts in blocks(texts):
                lo, hi = pretoken_spans(data, starts)
                piece = rows[np.searchsorted(starts, lo, "right") - 1]
                np.add.at(pre, piece, 1)
                np.add.at(tokens, piece, counter.look_up(data, lo, hi))
            yield pa.record_batch([batch.column("doc_id"), pa.array([len(x) for x in texts], pa.int64()),
                                   pa.array(pre), pa.array(tokens)],
                                  names=["doc_id", "n_bytes", "n_pretokens", "n_tokens"])

    narrow = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType.simpleString()
    return narrow.transform(map_arrow, count, f"doc_id {kind}, n_bytes long, n_pretokens long, n_tokens long")
