"""Byte-level BPE by a sentencepiece model that is written straight from the vocabulary.

Each byte is mapped to a character of its own, so that every token of the rank file is a piece of text. The pieces go into a
model of type BPE with the negative rank as the score and no normalisation: merging the pair of the best score is then
merging the pair of the lowest rank. Texts are cut by the pattern, each cut is encoded by that model, and ids are decoded by
the inverse mapping. The model is never trained; it is bytes in the format of sentencepiece's model files.
"""

from __future__ import annotations

import base64
import functools
import itertools
import struct

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import worker_store
from .words import slices

FIRST_CHAR = 0x3400  # byte b is written as the character FIRST_CHAR + b: a letter that no normalisation or space rule knows
CACHE_BYTES = 96 << 20  # of remembered pre-tokens in a worker, by estimate
LONG_CUT = 256  # characters; longer cuts are encoded but not remembered
CUTS_AT_ONCE = 1 << 18  # of one text that are held as a list

TO_CHAR = {b: FIRST_CHAR + b for b in range(256)}
TO_BYTE = {FIRST_CHAR + b: b for b in range(256)}


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file, by rank; ranks have to be whole, from 0 on."""
    with open(path, "rb") as f:
        pairs = [line.split() for line in f if line.strip()]
    ranks = {int(rank): base64.b64decode(token) for token, rank in pairs}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"ranks of {path} are not 0 to {len(ranks) - 1}")
    return [ranks[i] for i in range(len(ranks))]


def mapped(token: bytes) -> str:
    return token.decode("latin-1").translate(TO_CHAR)


def unmapped(piece: str) -> bytes:
    return piece.translate(TO_BYTE).encode("latin-1")


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _bytes_field(number: int, content: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(content)) + content


def _int_field(number: int, value: int) -> bytes:
    return _varint(number << 3) + _varint(value)


def sentencepiece_model(tokens: list[bytes]) -> bytes:
    """A serialised BPE model whose id i is `tokens[i]`; the unknown piece that such a model needs comes last.

    Fields of the public model format: 1 pieces (1 text, 2 score, 3 type, where 2 is unknown), 2 trainer (3 type, where 2
    is BPE; 40 the unknown id), 3 normaliser (1 name; 3 to 5 dummy prefix, white space removal and escaping).
    """
    pieces = [
        _bytes_field(1, _bytes_field(1, mapped(token).encode()) + _varint(2 << 3 | 5) + struct.pack("<f", -float(rank)))
        for rank, token in enumerate(tokens)
    ]
    unknown = _bytes_field(1, _bytes_field(1, b"<unk>") + _varint(2 << 3 | 5) + struct.pack("<f", 0.0) + _int_field(3, 2))
    trainer = _int_field(3, 2) + _int_field(40, len(tokens))
    normaliser = _bytes_field(1, b"identity") + _int_field(3, 0) + _int_field(4, 0) + _int_field(5, 0)
    return b"".join(pieces) + unknown + _bytes_field(2, trainer) + _bytes_field(3, normaliser)


class Remembered:
    """Codes of cuts of text, each different cut being encoded once as long as it is remembered.

    `encode_all` gives the ids of each of a list of cuts; a code is its ids as little-endian unsigned 32-bit integers.
    Cuts come in two generations: when the younger has half of the memory, the older one is forgotten but for the cuts
    that came again, so that common cuts stay however many others pass by.
    """

    def __init__(self, encode_all):
        self.encode_all = encode_all
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.size = 0

    def _learn(self, cuts) -> list[str]:
        """Makes all cuts known; gives those that are too long to be kept."""
        new = set(cuts).difference(self.known)
        again = {cut: self.older[cut] for cut in new if cut in self.older}
        unknown = list(new.difference(again))
        for cut, ids in zip(unknown, self.encode_all(unknown)):
            again[cut] = struct.pack(f"<{len(ids)}I", *ids)
        self.known.update(again)
        self.size += sum(200 + 2 * len(cut) + len(code) for cut, code in again.items() if len(cut) <= LONG_CUT)
        return [cut for cut in unknown if len(cut) > LONG_CUT]

    def _forget(self, long: list[str]) -> None:
        for cut in long:
            del self.known[cut]
        if self.size > CACHE_BYTES // 2:
            self.known, self.older, self.size = {}, self.known, 0

    def codes(self, groups: list[list[str]]) -> list[bytes]:
        """For each group of cuts, their codes one after another."""
        long = self._learn(itertools.chain.from_iterable(groups))
        out = [b"".join(map(self.known.__getitem__, cuts)) for cuts in groups]
        self._forget(long)
        return out

    def code(self, cuts: list[str]) -> bytes:
        try:
            return b"".join(map(self.known.__getitem__, cuts))
        except KeyError:
            return self.codes([cuts])[0]


def cuts_of(cutter, text: str):
    """Lists of the pattern's matches in the text; of a long one some at a time."""
    if len(text) <= CUTS_AT_ONCE:
        return [cutter.findall(text)]
    found = (match[0] for match in cutter.finditer(text))
    return iter(lambda: list(itertools.islice(found, CUTS_AT_ONCE)), [])


class ByteBpe:
    """Ids of texts as packed little-endian unsigned 32-bit integers, and back."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_proto=sentencepiece_model(tokens))
        self.cutter = regex.compile(portable(pattern))
        self.bytes_of = [unmapped(self.model.id_to_piece(i)) for i in range(len(tokens))]
        # A cut that is a token as it stands has that token's id, even one that merging does not reach.
        self.whole = {token: i for i, token in enumerate(self.bytes_of)}
        self.remembered = Remembered(self._encode_all)

    def _encode_all(self, cuts: list[str]) -> list[list[int]]:
        raw = [cut.encode() for cut in cuts]
        return [[self.whole[r]] if r in self.whole else self.model.encode(mapped(r)) for r in raw]

    def encode(self, text: str) -> bytes:
        return b"".join([self.remembered.code(cuts) for cuts in cuts_of(self.cutter, text)])

    def decode(self, ids: bytes) -> bytes:
        step = 4 * CUTS_AT_ONCE
        parts = (memoryview(ids)[at : at + step].cast("I") for at in range(0, len(ids), step))
        return b"".join([b"".join(map(self.bytes_of.__getitem__, part)) for part in parts])


@functools.cache
def portable(pattern: str) -> str:
    r"""The pattern with `\s` spelled out: the two libraries differ on a few control characters."""
    space = r"\t-\r \x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"  # fixed values: Unicode's white space
    outside = f"[{space}]"
    out, inside, at = [], False, 0
    while at < len(pattern):
        two = pattern[at : at + 2]
        if two == r"\s":
            out.append(space if inside else outside)
        elif two == r"\S" and not inside:
            out.append(f"[^{space}]")
        elif pattern[at] == "\\":
            out.append(two)
        else:
            inside = pattern[at] == "[" or (inside and pattern[at] != "]")
            out.append(pattern[at])
            at -= 1
        at += 2
    return "".join(out)


def bpe_of(path: str, pattern: str) -> ByteBpe:
    store = worker_store("byte_bpe")
    if (path, pattern) not in store:
        store[path, pattern] = ByteBpe(read_ranks(path), pattern)
    return store[path, pattern]


def _mapped_rows(df: DataFrame, id_col: str, value_col: str, made: str, kind: T.DataType, make) -> DataFrame:
    """(id, value, made): `make(value)` beside each row's value, in Arrow batches of bounded size."""

    def run(batches):
        for batch in slices(batches):
            values = [make(v) for v in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.binary())], ["id", "value", made])

    rows = df.select(F.col(id_col).alias("id"), F.col(value_col).alias("value"))
    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(made, kind)]))


def encoded(docs: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids) for every row: token ids as packed little-endian unsigned 32-bit integers, without special tokens.

    Null texts count as empty, and empty ones have no ids. Each row is encoded for itself, whatever its id; other columns
    are ignored; an empty table gives an empty one. Nothing is shuffled; a task holds about 4 MB of text, or one longer text.
    """
    found = _mapped_rows(docs, id_col, text_col, "ids", T.BinaryType(), lambda text: bpe_of(ranks, pattern).encode(text or ""))
    return found.select(F.col("id").alias(id_col), "ids")


def decoded(rows: DataFrame, ranks: str, pattern: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(id, ids, content): the bytes that the ids of each row stand for. Null ids count as none."""
    found = _mapped_rows(rows, id_col, ids_col, "content", T.BinaryType(), lambda ids: bpe_of(ranks, pattern).decode(ids or b""))
    return found.select(F.col("id").alias(id_col), F.coalesce("value", F.lit(b"")).alias("ids"), "content")
