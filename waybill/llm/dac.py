"""A file of token ids in directly addressable codes.

Ids are cut into chunks of CHUNK_BITS bits, lowest first. Level 0 holds the first chunk of every id; a bitmap marks the
ids that go on, and level 1 holds the second chunks of those, and so on. A rank directory counts the marks before
every block of RANK_BITS bits, so the place of an id on the next level is a count and the marks of one block: any token
is read without decoding another.

Layout, little-endian: magic, number of documents, of levels, of tokens; document ids (with a flag for null) and token bounds; then for
each level its size, chunks, bitmap and rank directory.
"""

from __future__ import annotations

import numpy as np

MAGIC = b"DAC1"
CHUNK_BITS = 8
RANK_BITS = 512


def encode(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap, ranks) of each level of unsigned 32-bit ids."""
    levels, rest = [], ids.astype(np.uint32)
    while len(rest):
        more = rest >> np.uint32(CHUNK_BITS)
        going = more > 0
        bitmap = np.packbits(going, bitorder="little")
        bitmap = np.concatenate([bitmap, np.zeros(-len(bitmap) % (RANK_BITS // 8), np.uint8)])
        blocks = np.bitwise_count(bitmap).reshape(-1, RANK_BITS // 8).sum(axis=1, dtype=np.uint64)
        ranks = np.concatenate([[0], np.cumsum(blocks)[:-1]]).astype(np.uint64)
        levels.append(((rest & np.uint32((1 << CHUNK_BITS) - 1)).astype(np.uint8), bitmap, ranks))
        rest = more[going]
    return levels


def to_bytes(doc_ids: list, bounds: np.ndarray, ids: np.ndarray) -> bytes:
    """A file of documents: document i has the ids from bounds[i] to bounds[i + 1]."""
    levels = encode(ids)
    known = np.array([d is not None for d in doc_ids], np.uint8)
    parts = [
        MAGIC, np.array([len(doc_ids), len(levels), len(ids)], "<u8").tobytes(), known.tobytes(),
        np.array([d or 0 for d in doc_ids], "<i8").tobytes(), bounds.astype("<u8").tobytes(),
    ]
    for chunks, bitmap, ranks in levels:
        parts += [np.array([len(chunks)], "<u8").tobytes(), chunks.tobytes(), bitmap.tobytes(), ranks.astype("<u8").tobytes()]
    return b"".join(parts)


class DacFile:
    """Random access to one file's bytes; nothing is decoded until it is asked for."""

    def __init__(self, content: bytes):
        if content[:4] != MAGIC:
            raise ValueError("no file of directly addressable codes")
        n, depth, self.n_tokens = (int(x) for x in np.frombuffer(content, "<u8", 3, 4))
        at = 28
        known = np.frombuffer(content, np.uint8, n, at)
        numbers = np.frombuffer(content, "<i8", n, at + n)
        self.doc_ids = [int(d) if k else None for d, k in zip(numbers, known)]
        self.bounds = np.frombuffer(content, "<u8", n + 1, at + 9 * n).astype(np.int64)
        at += 9 * n + 8 * (n + 1)
        self.levels = []
        for _ in range(depth):
            size = int(np.frombuffer(content, "<u8", 1, at)[0])
            blocks = -(-size // RANK_BITS)
            chunks = np.frombuffer(content, np.uint8, size, at + 8)
            bitmap = np.frombuffer(content, np.uint8, blocks * RANK_BITS // 8, at + 8 + size)
            at += 8 + size + len(bitmap)
            self.levels.append((chunks, bitmap, np.frombuffer(content, "<u8", blocks, at)))
            at += 8 * blocks

    def token(self, i: int) -> int:
        """Token i of the file, by its chunks alone."""
        value, shift = 0, 0
        for chunks, bitmap, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BITS
            first = block * RANK_BITS // 8
            before = int(np.bitwise_count(bitmap[first : i >> 3]).sum())
            before += int(bitmap[i >> 3] & ((1 << (i & 7)) - 1)).bit_count()
            i, shift = int(ranks[block]) + before, shift + CHUNK_BITS
        return value

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """Tokens from start to stop, by slices of each level."""
        values = np.zeros(stop - start, np.uint32)
        place = np.arange(stop - start)
        for level, (chunks, bitmap, ranks) in enumerate(self.levels):
            if stop <= start:
                break
            values[place] |= chunks[start:stop].astype(np.uint32) << np.uint32(CHUNK_BITS * level)
            block = start // RANK_BITS
            bits = np.unpackbits(bitmap[block * RANK_BITS // 8 : (stop + 7) // 8], bitorder="little")
            ahead = start - block * RANK_BITS
            going = bits[ahead : ahead + stop - start].astype(bool)
            start = int(ranks[block]) + int(bits[:ahead].sum())
            stop = start + int(going.sum())
            place = place[going]
        return values
