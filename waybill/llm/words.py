"""Words of whole Arrow batches as numbers, without a Python loop over words.

A word is a run of bytes outside `\\x20\\x09-\\x0D`. Texts are read as UTF-8, in which no other character holds one of
those bytes. Each word gets a 64-bit hash of its bytes and its length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 18  # bytes hashed at a time: temporary arrays stay in the processor's cache, however long a text is

_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse and no power of it vanishes


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finisher of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hasher:
    """Tables for hashing words; `fold` maps A-Z to a-z first."""

    def __init__(self, fold: bool = False, space: bytes = b"\t\n\x0b\f\r "):
        byte = np.arange(256, dtype=np.uint64)
        folded = byte.copy()
        if fold:
            folded[65:91] += np.uint64(32)
        self.value = mixed(folded + np.uint64(0xA24BAED4963EE407))
        self.space = np.isin(np.arange(256), list(space))
        self.power = np.full(PIECE_BYTES + 1, _BASE, dtype=np.uint64)
        self.power[0] = 1
        self.power = np.multiply.accumulate(self.power)
        self.inverse = np.full(PIECE_BYTES + 1, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        self.inverse[0] = 1
        self.inverse = np.multiply.accumulate(self.inverse)

    def spans(self, data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of words in `data`; a word also ends at each of `cuts` (starts of texts)."""
        word = ~self.space[data]
        first = word.copy()
        first[1:] &= ~word[:-1]
        inner = cuts[(cuts > 0) & (cuts < len(data))]
        first[inner] = word[inner]
        last = word.copy()
        last[:-1] &= ~word[1:]
        last[inner - 1] = word[inner - 1]
        return np.flatnonzero(first), np.flatnonzero(last) + 1

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The sum of the bytes' values, each times the base to the power of its place in the word."""
        if len(data) > PIECE_BYTES:  # holds a word longer than a piece
            return np.array([self._one(data[a:b]) for a, b in zip(starts, ends)], np.uint64)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.value[data] * self.power[: len(data)], out=sums[1:])
        return self._finish((sums[ends] - sums[starts]) * self.inverse[starts], ends - starts)

    def _one(self, word: np.ndarray) -> np.uint64:
        total = 0
        for at in range(0, len(word), PIECE_BYTES):
            part = word[at : at + PIECE_BYTES]
            part_sum = int(np.sum(self.value[part] * self.power[: len(part)], dtype=np.uint64))
            total += part_sum * pow(_BASE, at, 1 << 64)
        return self._finish(np.array([total & (1 << 64) - 1], np.uint64), np.array([len(word)]))[0]

    @staticmethod
    def _finish(sums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return mixed(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and the bounds of each (null: empty)."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data, bounds


def slices(batches, text: int = 1, most: int = 4 << 20):
    """Arrow batches cut so that each holds about `most` bytes of text in the given column, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        group = np.cumsum(sizes, dtype=np.int64) // most
        edges = np.flatnonzero(np.diff(group)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
            yield batch.slice(a, b - a)


def pieces(data: np.ndarray, bounds: np.ndarray, space: np.ndarray):
    """Cut texts into pieces of about PIECE_BYTES: (from, to, first text, last text + 1).

    Short texts share a piece; a long one is cut behind a white space byte, or if it has none nearby, where its
    next one comes.
    """
    at, text, end = int(bounds[0]), 0, int(bounds[-1])
    while at < end:
        upto = min(at + PIECE_BYTES, end)
        stop = int(np.searchsorted(bounds, upto, "right")) - 1
        if upto < end and bounds[stop] > at:
            upto = int(bounds[stop])
        elif upto < end:
            limit = int(bounds[np.searchsorted(bounds, at, "right")])
            while upto < limit:
                there = np.flatnonzero(space[data[upto : min(upto + PIECE_BYTES, limit)]])
                if len(there):
                    upto += int(there[0]) + 1
                    break
                upto = min(upto + PIECE_BYTES, limit)
            upto = min(upto, limit)
        yield at, upto
        at = upto


def word_table(column: pa.Array, hasher: Hasher) -> tuple[np.ndarray, ...]:
    """All words of a batch in order: hashes, starts, ends in the batch's bytes; each text's bounds among them; the bytes."""
    data, bounds = text_buffers(column)
    found = [(np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64))]
    for at, upto in pieces(data, bounds, hasher.space):
        part = data[at:upto]
        starts, ends = hasher.spans(part, bounds[(bounds > at) & (bounds < upto)] - at)
        found.append((hasher.hashes(part, starts, ends), starts + at, ends + at))
    hashes, starts, ends = (np.concatenate(x) for x in zip(*found))
    return hashes, starts, ends, np.searchsorted(starts, bounds), data


def word_hashes(column: pa.Array, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a batch in order, and the bounds of each text's words among them."""
    hashes, _, _, bounds, _ = word_table(column, hasher)
    return hashes, bounds


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of `width` words of one text; of all its words where it has fewer, none where it has none."""
    n = len(words)
    if n == 0:
        return words
    width_here = min(width, n)
    out = np.zeros(n - width_here + 1, np.uint64)
    for i in range(width_here):
        out = out * np.uint64(_BASE) + words[i : n - width_here + 1 + i]
    return mixed(out + np.uint64(width_here))
