"""Texts of an Arrow column as byte blocks, and vectorised word hashes over a block.

A block is one byte array with a space before each piece of text. Texts longer than
the block limit are cut at a space into several pieces of the same row, so memory is
bounded by the limit (or by the longest run without a space), never by a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

LIMIT = 1 << 20
_SPREAD = 1 << 13
# Random odd multipliers by position in a word: a multilinear hash modulo 2**64.
_MULT = np.random.RandomState(20240229).randint(0, 1 << 62, _SPREAD).astype(np.uint64) * 2 + 1
# Byte classes: 0 white space, 1 anything else (words are runs of non-white bytes).
NON_WHITE = np.ones(256, np.uint8)
NON_WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = 0


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null is empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def _pieces(raw: bytes, limit: int) -> Iterator[bytes]:
    at = 0
    while len(raw) - at > limit:
        cut = raw.rfind(b" ", at + 1, at + limit)
        if cut < 0:
            cut = raw.find(b" ", at + limit)
        if cut < 0:
            break
        yield raw[at:cut]
        at = cut  # the space stays at the head of the next piece
    yield raw[at:] if at else raw


def blocks(texts: list[bytes], limit: int = LIMIT) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row of each piece, bytes, position of the space before each piece)."""
    rows: list[int] = []
    held: list[bytes] = []
    size = 0

    def block():
        starts = np.cumsum([0] + [len(x) + 1 for x in held[:-1]])
        data = np.frombuffer(b" " + b" ".join(held) + b" ", np.uint8)
        return np.array(rows), data, starts

    for row, raw in enumerate(texts):
        for piece in _pieces(raw, limit):
            if held and size + len(piece) > limit:
                yield block()
                rows, held, size = [], [], 0
            rows.append(row)
            held.append(piece)
            size += len(piece) + 1
    if held:
        yield block()


def runs(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of one non-zero class."""
    edge = np.flatnonzero(classes[1:] != classes[:-1]) + 1
    edge = np.concatenate(([0], edge, [len(classes)]))
    keep = classes[edge[:-1]] != 0
    return edge[:-1][keep], edge[1:][keep]


def _turn(number: np.ndarray) -> np.ndarray:
    """Odd factors, each its own, for the first, second, ... time that the multipliers are gone through."""
    h = number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (h ^ (h >> np.uint64(31))) | np.uint64(1)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of data[start:end] for disjoint ascending non-empty spans.

    The block's last byte belongs to no span.
    """
    if not len(starts):
        return np.zeros(0, np.uint64)
    at = np.arange(starts[0], len(data), dtype=np.int32)
    at -= np.repeat(starts.astype(np.int32), np.diff(starts, append=len(data)))
    part = data[starts[0]:].astype(np.uint64)
    part += np.uint64(1)
    part *= _MULT[at & (_SPREAD - 1)]
    if (ends - starts).max() > _SPREAD:
        part *= _turn(np.arange(int(at.max()) // _SPREAD + 1))[at // _SPREAD]
    h = np.add.reduceat(part, np.stack((starts, ends), axis=1).ravel() - starts[0])[::2]
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(data: np.ndarray, piece_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the white-space separated words, piece of each word)."""
    starts, ends = runs(NON_WHITE[data])
    return span_hashes(data, starts, ends), np.searchsorted(piece_starts, starts, "right") - 1
