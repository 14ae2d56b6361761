"""Alignment of two tokenizers over the same bytes.

Tokens of one text under tokenizers A and B are ranges of its bytes. Every token points to the token of the other side
that overlaps it and reaches farthest to the right; where both end on the same byte, the A token points to itself. Jumping
from pointer to pointer, with the jumps doubled in each step for all tokens of a batch at once, every token comes to the
last A token of its group. Groups are the smallest stretches that both tokenizers cut out alike.

An id pair's count is the number of documents in which its tokens overlap. Pairs of each document are written once; the
counts are summed with partial aggregation and joined back: the most frequent pairs, of a checked number, by broadcast, the
others by shuffle, where no key has more rows than the least of the frequent ones has documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .shared import Landing, worker_store
from .tokens import PieceEncoder
from .words import slices

BROADCAST_PAIRS = 500_000  # of 17 bytes each
SEGMENT_BYTES = 1 << 20  # of text that a task aligns at a time
SPACE_MARK = "▁"  # fixed value: how sentencepiece writes a space

# Bytes that stand for themselves in byte-level vocabularies.
PRINTED = (range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100))


def byte_of_char() -> dict[str, int]:
    """Bytes by the characters of byte-level vocabularies: printed ones as they are, the others from U+0100 on."""
    printed = {b for r in PRINTED for b in r}
    others = [b for b in range(256) if b not in printed]
    return {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(others)}


class ByteLevelSide(PieceEncoder):
    """A byte-level BPE of the tokenizers library, which takes the strings of special tokens as plain text."""

    def __init__(self, path: str):
        super().__init__(path)
        self.tokenizer.encode_special_tokens, self.added = True, []
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        chars = byte_of_char()
        bytes_of = [b""] * (max(vocabulary.values()) + 1)
        for piece, i in vocabulary.items():
            bytes_of[i] = bytes(chars[c] for c in piece) if all(c in chars for c in piece) else piece.encode()
        self.spelling = Spelling(bytes_of)


class PieceSide(PieceEncoder):
    """A sentencepiece model that puts a space before each text; cut before each run of spaces.

    No token reaches over such a cut where no piece has a space behind another character. Texts come with their first
    space, and so does each cut: the model adds it.
    """

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces):
            self.added = [" "]  # no text is cut
        self.space = self.model.piece_to_id(SPACE_MARK)
        self.spelling = Spelling(
            [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        )
        self._prepare()

    def piece_starts(self, points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        begin = points == 32
        begin[1:] &= points[:-1] != 32
        begin[cuts] = True
        return np.flatnonzero(begin)

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        coded = self.model.encode([text[1:] for text in texts], num_threads=1)
        return [ids if text != " " else [self.space] for text, ids in zip(texts, coded)]


class Spelling:
    """The bytes of tokens, for spelling whole texts at once."""

    def __init__(self, bytes_of: list[bytes]):
        self.bytes_of = bytes_of
        self.sizes = np.array([len(b) for b in bytes_of])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(bytes_of), np.uint8)

    def spelled(self, ids: np.ndarray) -> np.ndarray:
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        return self.flat[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.starts[ids] - ends + sizes, sizes)]

    def spells(self, ids: np.ndarray, content: bytes) -> bool:
        return np.array_equal(self.spelled(ids), np.frombuffer(content, np.uint8))


def tokens_of(side: PieceEncoder, texts: list[str]) -> list[np.ndarray | None]:
    """Ids of each text with a space before it; None where the bytes of the tokens are not those of the two.

    Cuts are remembered by a hash. A text whose tokens by cuts spell other bytes, by chance of two equal hashes or as the
    tokenizer changes texts, is encoded whole.
    """
    texts = [" " + text for text in texts]
    out: list = []
    for text, ids in zip(texts, side.encode(texts)):
        content = text.encode()
        if not side.spelling.spells(ids, content):
            ids = np.array(side.encode_all([text])[0], np.uint32)
            if not side.spelling.spells(ids, content):
                out.append(None)
                continue
        out.append(ids.astype(np.int64))
    return out


def follow(pointers: np.ndarray) -> np.ndarray:
    """The end of each chain of pointers, where a pointer points to itself; jumps double in each step."""
    while True:
        further = pointers[pointers]
        if np.array_equal(further, pointers):
            return pointers
        pointers = further


def groups_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of the groups of all A and of all B tokens, from the ends of their byte ranges.

    Both sides cover the same bytes without gaps, from 0 on.
    """
    n = len(a_ends)
    a_starts, b_starts = (np.concatenate([[0], e[:-1]]) for e in (a_ends, b_ends))
    last_b = np.searchsorted(b_starts, a_ends) - 1
    last_a = np.searchsorted(a_starts, b_ends) - 1
    terminal = b_ends[last_b] == a_ends
    pointers = np.concatenate([np.where(terminal, np.arange(n), last_b + n), last_a])
    group = (np.cumsum(terminal) - 1)[follow(pointers)]
    return group[:n], group[n:]


def links_of(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the A and of the B token of each overlap, by A token."""
    a_starts, b_starts = (np.concatenate([[0], e[:-1]]) for e in (a_ends, b_ends))
    first = np.searchsorted(b_ends, a_starts, "right")
    partners = np.searchsorted(b_starts, a_ends) - first
    a = np.repeat(np.arange(len(a_ends)), partners)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(partners) - partners - first, partners)


class Written:
    """Groups as text: `a1,a2|b1;a3|b2,b3`, ids in order."""

    def __init__(self, a_size: int, b_size: int):
        self.a_size, self.b_size = a_size, b_size
        sides = ((a_size, ",|"), (b_size, ",;"))
        self.words = [f"{i}{mark}".encode() for size, marks in sides for mark in marks for i in range(size)]

    def parts(self, a_ids, b_ids, a_group, b_group) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of words in order of groups, and the place of each A token among them."""
        groups = int(a_group[-1]) + 1 if len(a_group) else 0
        of_a, of_b = np.bincount(a_group, minlength=groups), np.bincount(b_group, minlength=groups)
        a_at = np.arange(len(a_group)) + (np.cumsum(of_b) - of_b)[a_group]
        b_at = np.arange(len(b_group)) + np.cumsum(of_a)[b_group]
        last_a, last_b = (np.append(g[1:] != g[:-1], True)[: len(g)] for g in (a_group, b_group))
        numbers = np.empty(len(a_at) + len(b_at), np.int64)
        numbers[a_at] = a_ids + last_a * self.a_size
        numbers[b_at] = 2 * self.a_size + b_ids + last_b * self.b_size
        return numbers, a_at

    def text(self, numbers: np.ndarray) -> bytes:
        return b"".join(map(self.words.__getitem__, numbers.tolist()))


def segments(a_ends: np.ndarray, b_ends: np.ndarray, size: int):
    """Cuts (A from, to, B from, to) of at least `size` bytes, but for the last, at bytes where tokens of both sides end."""
    shared = np.intersect1d(a_ends, b_ends, assume_unique=True)
    at, a, b = 0, 0, 0
    while at < len(shared):
        before = int(shared[at - 1]) if at else 0
        at = min(int(np.searchsorted(shared, before + size)), len(shared) - 1) + 1
        to_a, to_b = (int(np.searchsorted(e, shared[at - 1], "right")) for e in (a_ends, b_ends))
        yield a, to_a, b, to_b
        a, b = to_a, to_b


def _tools(a_path: str, b_path: str) -> tuple[ByteLevelSide, PieceSide, Written]:
    store = worker_store("alignment")
    if (a_path, b_path) not in store:
        a, b = ByteLevelSide(a_path), PieceSide(b_path)
        store[a_path, b_path] = a, b, Written(len(a.spelling.sizes), len(b.spelling.sizes))
    return store[a_path, b_path]


def _aligned_batch(texts: list, a_side: PieceEncoder, b_side: PieceEncoder, written: Written) -> dict[str, pa.Array]:
    """Columns of the result for some texts; all of them lie one after another, as no group reaches over their bounds."""
    nothing = np.empty(0, np.int64)
    n = len(texts)
    a_of, b_of = [nothing] * n, [nothing] * n
    some = [i for i, text in enumerate(texts) if text]
    chosen = [texts[i] for i in some]
    for i, a, b in zip(some, tokens_of(a_side, chosen), tokens_of(b_side, chosen)):
        if a is not None and b is not None:
            a_of[i], b_of[i] = a, b
    n_a, n_b = (np.array([len(x) for x in ids], np.int64) for ids in (a_of, b_of))
    a_ids, b_ids = np.concatenate([nothing, *a_of]), np.concatenate([nothing, *b_of])
    del a_of, b_of
    a_ends, b_ends = np.cumsum(a_side.spelling.sizes[a_ids]), np.cumsum(b_side.spelling.sizes[b_ids])
    text_of = np.repeat(np.arange(n), n_a)
    n_groups, n_links = np.zeros(n, np.int64), np.zeros(n, np.int64)
    parts: list[list[bytes]] = [[] for _ in range(n)]
    keys, times = [nothing], [nothing]
    for a, to_a, b, to_b in segments(a_ends, b_ends, SEGMENT_BYTES):
        start = int(a_ends[a - 1]) if a else 0
        ids, ends = (a_ids[a:to_a], b_ids[b:to_b]), (a_ends[a:to_a] - start, b_ends[b:to_b] - start)
        groups, owner = groups_of(*ends), text_of[a:to_a]
        n_groups += np.bincount(owner[np.append(groups[0][1:] != groups[0][:-1], True)], minlength=n)
        numbers, a_at = written.parts(*ids, *groups)
        first = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        cuts = np.append(a_at[first], len(numbers))  # an A token opens each group
        for k, text in enumerate(owner[first].tolist()):
            parts[text].append(written.text(numbers[cuts[k] : cuts[k + 1]]))
        at_a, at_b = links_of(*ends)
        n_links += np.bincount(owner[at_a], minlength=n)
        pair = ids[0][at_a] * written.b_size + ids[1][at_b]
        key, count = np.unique(owner[at_a] * (written.a_size * written.b_size) + pair, return_counts=True)
        keys.append(key)
        times.append(count)
    keys, times = np.concatenate(keys), np.concatenate(times)
    distinct, each = np.unique(keys, return_inverse=True)
    counts = np.bincount(each, weights=times, minlength=len(distinct)).astype(np.int64)
    of_text, pair = np.divmod(distinct, written.a_size * written.b_size)
    a_id, b_id = np.divmod(pair, written.b_size)
    bounds = pa.array(np.searchsorted(of_text, np.arange(n + 1)), pa.int32())
    return {
        "n_a": pa.array(n_a), "n_b": pa.array(n_b), "n_groups": pa.array(n_groups), "n_links": pa.array(n_links),
        "groups": pa.array([b"".join(p)[:-1] for p in parts], pa.binary()).cast(pa.string()),
        "pairs": pa.ListArray.from_arrays(bounds, pa.array(a_id << 32 | b_id)),
        "times": pa.ListArray.from_arrays(bounds, pa.array(counts)),
    }


def aligned(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, groups, pairs, times) for every row.

    `groups` is the text form of all groups, `pairs` the distinct pairs of ids (A id in the upper 32 bits) whose tokens
    overlap somewhere in the text, `times` how many overlaps each has. Null and empty texts, and texts whose tokens on
    either side spell other bytes than a space and the text, have none and zeros. Rows with null or repeated ids are
    each aligned; other columns are ignored; an empty table gives an empty one. Nothing is shuffled. A task holds the
    tokens of about 1 MB of text at a time, or of one longer text, which is aligned in segments of that size.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches):
        a_side, b_side, written = _tools(a_path, b_path)
        for batch in slices(batches, most=SEGMENT_BYTES):
            columns = _aligned_batch(batch.column(1).to_pylist(), a_side, b_side, written)
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns.values()], ["id", *columns])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)])
    for field in T.StructType.fromDDL(
        "n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<bigint>, times array<bigint>"
    ):
        schema = schema.add(field)
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def pair_counts(pairs: DataFrame, landing: Landing) -> DataFrame:
    """(pair, documents, best) from the `pairs` of all texts: whether no pair of the same A id has more documents."""
    counts = pairs.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("documents"))
    of_a = Window.partitionBy(F.shiftright("pair", 32))  # at most the size of B's vocabulary
    best = F.col("documents") == F.max("documents").over(of_a)
    return landing.land(counts.withColumn("best", best), "counts")


def link_scores(rows: DataFrame, landing: Landing, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Adds `n_best` and `count_sum` to the rows of `aligned` and drops `pairs` and `times`.

    `n_best` are the links whose pair has the highest count of its A id, ties included; `count_sum` sums the counts of
    all links. All other columns are kept.
    """
    rows = landing.land(rows.withColumn("row", F.monotonically_increasing_id()), "aligned", compression="zstd")
    counts = pair_counts(rows, landing)
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select("row", "link.pairs", "link.times")
    links = links.withColumnRenamed("pairs", "pair")
    # Frequent pairs are those from the least power of two that leaves at most `broadcast_pairs` of them.
    power = F.floor(F.log2("documents")).cast("int").alias("power")
    sizes = {r["power"]: r["count"] for r in counts.groupBy(power).count().collect()}
    least = max(sizes, default=0) + 1
    while least and sum(n for p, n in sizes.items() if p >= least - 1) <= broadcast_pairs:
        least -= 1
    frequent, others = (counts.where(test) for test in (F.col("documents") >= 1 << least, F.col("documents") < 1 << least))
    sums = [F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"), F.sum(F.col("times") * F.col("documents")).alias("count_sum")]
    frequent = F.broadcast(frequent)
    parts = links.join(frequent, "pair").groupBy("row").agg(*sums)
    if least:
        rest = links.join(frequent.select("pair"), "pair", "left_anti").join(others.hint("merge"), "pair")
        parts = parts.unionByName(rest.groupBy("row").agg(*sums))
        parts = parts.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    zero = F.lit(0).cast("long")
    scored = rows.drop("pairs", "times").join(parts, "row", "left")
    return scored.select(
        *[c for c in rows.columns if c not in ("pairs", "times", "row")],
        F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"),
    )
