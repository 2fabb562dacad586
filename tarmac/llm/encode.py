"""Token ids of whole texts by a public byte-level BPE vocabulary.

The ids are those of the tokenizer file. A text is cut where the tokenizer's own word
pattern always has a border: before a single space between two characters that are
surely not white space. Distinct segments are encoded once and kept in a bounded table, so
frequent words are not merged again and again. Plain segments (ASCII and two-byte
characters) go through the rank file of the same vocabulary, which gives the same ids
in a fraction of the time (tests compare both on whole texts); segments with other
characters or with a special token's string go through the tokenizer file itself.
"""

from __future__ import annotations

import base64
import os
from functools import lru_cache

import numpy as np

from tarmac.llm.blocks import blocks, span_hashes

KEPT = 1 << 20

# Bytes that may stand before or after a cut: ASCII graphic characters, and the parts
# of two-byte characters from U+00C0 on, none of which is white space.
_GRAPHIC = np.zeros(256, bool)
_GRAPHIC[0x21:0x7F] = True
_LEAD = np.zeros(256, bool)
_LEAD[0xC3:0xE0] = True
_WIDE = np.zeros(256, bool)
_WIDE[0xE0:] = True
_WIDE[0xC0:0xC3] = True


@lru_cache(maxsize=2)
def _encoders(tokenizer: str, ranks: str, pattern: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import tiktoken
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(tokenizer)
    with open(ranks, "rb") as lines:
        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return whole, tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=merges, special_tokens={})


def _cuts(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Positions where a segment begins: each piece, and each safe single space."""
    space = np.flatnonzero(data[1:-1] == 32) + 1
    before, after = data[space - 1], data[space + 1]
    ok_before = _GRAPHIC[before] | ((before >= 0x80) & _LEAD[data[np.maximum(space - 2, 0)]])
    begins = np.zeros(len(data), bool)
    begins[space[ok_before & (_GRAPHIC[after] | _LEAD[after])]] = True
    begins[starts[starts > 0] - 1] = False
    begins[starts + 1] = True
    begins[starts] = False  # the separating spaces are no text
    begins[-1] = False
    return np.flatnonzero(begins)


@lru_cache(maxsize=2)
def shared_encoder(tokenizer: str, ranks: str, pattern: str) -> Encoder:
    """One encoder for all tasks that a Python worker runs."""
    return Encoder(tokenizer, ranks, pattern)


class Encoder:
    """Ids of segments by hash, kept between blocks up to a bound."""

    def __init__(self, tokenizer: str, ranks: str, pattern: str, kept: int = KEPT):
        self.whole, self.plain = _encoders(tokenizer, ranks, pattern)
        self.kept = kept
        self._clear()

    def _clear(self):
        self.hashes, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size, self.ids, self.used = np.zeros(0, np.int64), np.zeros(1 << 16, np.uint32), 0

    def _encode(self, raw: bytes) -> list[int]:
        if raw.isascii():
            if raw[1:].isalpha() and (raw[0] == 32 or raw[:1].isalpha()):
                return self.plain._encode_single_piece(raw)  # one word of the pattern
            if b"<|" not in raw:
                return self.plain.encode_ordinary(raw.decode())
        elif b"<|" not in raw and not _WIDE[np.frombuffer(raw, np.uint8)].any():
            return self.plain.encode_ordinary(raw.decode())
        return self.whole.encode(raw.decode(), add_special_tokens=False).ids

    def _learn(self, hashes: np.ndarray, segments: list[bytes]) -> None:
        if len(self.hashes) + len(hashes) > self.kept:
            self._clear()
        sizes = np.zeros(len(segments), np.int64)
        flat: list[int] = []
        for i, raw in enumerate(segments):
            got = self._encode(raw)
            sizes[i] = len(got)
            flat += got
        if self.used + len(flat) > len(self.ids):
            grown = np.zeros(2 * (self.used + len(flat)), np.uint32)
            grown[:self.used] = self.ids[:self.used]
            self.ids = grown
        self.ids[self.used:self.used + len(flat)] = flat
        where = np.searchsorted(self.hashes, hashes)
        self.at = np.insert(self.at, where, self.used + np.cumsum(sizes) - sizes)
        self.size = np.insert(self.size, where, sizes)
        self.hashes = np.insert(self.hashes, where, hashes)
        self.used += len(flat)

    def _find(self, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.hashes):
            return np.zeros(len(known), np.int64), np.zeros(len(known), bool)
        at = np.minimum(np.searchsorted(self.hashes, known), len(self.hashes) - 1)
        return at, self.hashes[at] == known

    def ids_of(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each text, uint32."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        for rows, data, starts in blocks(texts):
            begin = _cuts(data, starts)
            end = np.append(begin[1:], len(data) - 1)
            # a segment ends before the space that separates its piece from the next
            piece = np.searchsorted(starts, begin, "right") - 1
            end = np.minimum(end, np.append(starts[1:], len(data) - 1)[piece])
            full = end > begin
            begin, end, piece = begin[full], end[full], piece[full]
            h = span_hashes(data, begin, end)
            known, first, where = np.unique(h, return_index=True, return_inverse=True)
            at, hit = self._find(known)
            if not hit.all():
                raw = data.tobytes()
                miss = np.flatnonzero(~hit)
                before = len(self.hashes)
                self._learn(known[miss], [raw[begin[i]:end[i]] for i in first[miss]])
                if len(self.hashes) != before + len(miss):  # the table was emptied
                    at, hit = self._find(known)
                    miss = np.flatnonzero(~hit)
                    if len(miss):
                        self.kept = max(self.kept, len(known))
                        self._learn(known[miss], [raw[begin[i]:end[i]] for i in first[miss]])
                at, hit = self._find(known)
            at = at[where]
            size = self.size[at]
            last = np.cumsum(size)
            flat = self.ids[np.arange(int(last[-1]) if len(last) else 0) - np.repeat(last - size - self.at[at], size)]
            cut = np.concatenate(([0], last))[np.searchsorted(piece, np.arange(len(rows) + 1))]
            for k, row in enumerate(rows):
                out[row].append(flat[cut[k]:cut[k + 1]])
        return [x[0] if len(x) == 1 else np.concatenate(x or [np.zeros(0, np.uint32)]) for x in out]
