"""Words and their hashes for blocks of texts, computed on whole byte arrays.

Texts are UTF-8 bytes; a word is a longest run of bytes other than space and \\t to \\r.
Blocks hold about a megabyte of texts (a longer text is a block of its own), so that the
arrays of a block stay small however long a partition is.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

from guardwork.llm.worker_memory import remembered_by_all

BLOCK_BYTES = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Continuation bytes carry no code point of their own.
CODE_POINT = (np.arange(256) & 0xC0) != 0x80

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_VALUES = np.random.default_rng(20).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_PLACES = np.random.default_rng(21).integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as bytes; null is empty."""
    return [b"" if value is None else value for value in column.cast(pa.binary()).to_pylist()]


class Block(NamedTuple):
    """Texts first..first+n-1 of a batch, each followed by one separating space."""

    first: int
    data: np.ndarray
    starts: np.ndarray  # of each text in data
    lengths: np.ndarray


def blocks(texts: list[bytes], limit: int = BLOCK_BYTES) -> Iterator[Block]:
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            yield _block(texts, first, i)
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield _block(texts, first, len(texts))


def _block(texts: list[bytes], first: int, end: int) -> Block:
    part = texts[first:end]
    lengths = np.fromiter(map(len, part), np.int64, len(part))
    starts = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
    return Block(first, np.frombuffer(b" ".join(part) + b" ", np.uint8), starts, lengths)


class Words(NamedTuple):
    starts: np.ndarray
    ends: np.ndarray
    text: np.ndarray  # index of the word's text in its block
    first: np.ndarray  # index of each text's first word, and the number of all words


def words_of(block: Block) -> Words:
    space = SPACE[block.data]
    before = np.concatenate(([True], space[:-1]))
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(space & ~before)
    first = np.searchsorted(starts, np.append(block.starts, len(block.data)))
    text = np.repeat(np.arange(len(block.starts)), np.diff(first))
    return Words(starts, ends, text, first)


@remembered_by_all(2)
def _powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    up = np.full(length, _BASE, np.uint64)
    down = np.full(length, _BASE_INVERSE, np.uint64)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def powers(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse modulo 2^64, length of each at least."""
    return _powers(1 << max(21, (length - 1).bit_length()))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads each value over all 64 bits, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes modulo 2^64, the empty one first."""
    up, _ = powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    return sums


def range_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[start:end]; equal bytes have equal hashes wherever they stand."""
    _, down = powers(len(sums))
    return mixed((sums[ends] - sums[starts]) * down[starts])


def word_hashes(data: np.ndarray, words: Words, fold_case: bool = False) -> np.ndarray:
    return range_hashes(prefix_hashes(_LOWER[data] if fold_case else data), words.starts, words.ends)


def window_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each `size` successive hashes, in order."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = hashes[:n] * _PLACES[0]
    for i in range(1, size):
        total += hashes[i : n + i] * _PLACES[i]
    return mixed(total)


def windows_within(words: Words, size: int) -> np.ndarray:
    """Indices of the words that start a window of `size` words of one text."""
    n = len(words.starts) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(words.text[:n] == words.text[size - 1 :])
