"""Token ids of documents, written as files of directly addressable codes and read back.

Documents are sorted by id into ranges; a task encodes its range and writes files of bounded size, in order. A table of
files, summed up, gives each file's first position in the whole sequence.
"""

from __future__ import annotations

import os
import unicodedata
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .dac import DacFile, to_bytes
from .shared import Landing, worker_store
from .words import PIECE_BYTES, Hasher, mixed, slices

END_ID = 2
FILE_TOKENS = 2_000_000  # tokens after which a file is closed
BATCH_CHARS = 1 << 19  # of text encoded at a time
CACHED_PIECES = 1_000_000  # of about 40 bytes each
READ_TOKENS = 16_000_000  # tokens that a task reads back

# Code points up to here are cut into pieces here; texts with others, with rare white space or with the text of an added
# token, by the library.
KNOWN = 0x250
RARE = (0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0)
# Classes of the byte-level pattern, and the endings that an apostrophe takes with it.
SPACE, LETTER, DIGIT, OTHER = range(4)
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")


class PieceEncoder:
    """Ids of texts under a byte-level BPE vocabulary of the tokenizers library.

    Such a vocabulary never merges across the pieces its pattern cuts, and most pieces come again and again: texts are
    cut here, each different piece is encoded once by the library, and the ids are put together with numpy.
    """

    added: list[str] = []  # texts with one of these are left to the library

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        self._prepare()

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids of texts by the library."""
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _prepare(self):
        kinds = [unicodedata.category(chr(c))[0] for c in range(KNOWN)]
        self.classes = np.array([LETTER if k == "L" else DIGIT if k == "N" else OTHER for k in kinds], np.int8)
        self.classes[[9, 10, 11, 12, 13, 32]] = SPACE
        self.strange = np.zeros(KNOWN + 1, bool)
        self.strange[[*RARE, KNOWN]] = True
        self.hasher = Hasher()
        self.hasher.value = mixed(np.arange(KNOWN, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D))
        self._forget()

    def _forget(self):
        self.keys = np.empty(0, np.uint64)
        self.at, self.length = np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids = np.empty(0, np.uint32)

    def piece_starts(self, points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        """Where pieces begin in code points; `cuts` are the starts of texts, each of which begins one."""
        n = len(points)
        kind = self.classes[points]
        space = kind == SPACE
        opens = np.zeros(n + 1, bool)
        opens[cuts] = True
        begin = opens[:n].copy()
        before_space = np.concatenate([[False], space[:-1]])
        plain = np.concatenate([[False], points[:-1] == 32])
        changed = np.concatenate([[True], kind[1:] != kind[:-1]])
        begin |= space & ~before_space
        begin |= ~space & np.where(before_space, ~plain, changed)
        after = np.concatenate([~space[1:], [False]]) & ~opens[1:]
        begin |= space & after
        begin[opens[:n]] = True
        for at in np.flatnonzero(begin & (points == 39)):
            stop = int(cuts[np.searchsorted(cuts, at, "right")]) if at < cuts[-1] else n
            ending = "".join(map(chr, points[at + 1 : min(at + 3, stop)]))
            for e in ENDINGS:
                if ending.startswith(e):
                    begin[at + 1] = False
                    if at + 1 + len(e) < stop and kind[at + 1 + len(e)] == LETTER:
                        begin[at + 1 + len(e)] = True
                    break
        return np.flatnonzero(begin)

    def _ids_of(self, hashes: np.ndarray, text_of) -> tuple[np.ndarray, np.ndarray]:
        """(place, length) in `self.ids` of each of the distinct `hashes`; unknown ones are encoded first."""
        found = np.minimum(np.searchsorted(self.keys, hashes), max(len(self.keys) - 1, 0))
        missing = np.flatnonzero(self.keys[found] != hashes) if len(self.keys) else np.arange(len(hashes))
        if len(missing):
            if len(self.keys) + len(missing) > CACHED_PIECES:
                self._forget()
                found, missing = np.zeros(len(hashes), np.int64), np.arange(len(hashes))
            got = self.encode_all([text_of(i) for i in missing])
            length = np.array([len(g) for g in got], np.int64)
            at = len(self.ids) + np.cumsum(length) - length
            self.ids = np.concatenate([self.ids, np.array([i for g in got for i in g], np.uint32)])
            place = np.searchsorted(self.keys, hashes[missing])  # both are sorted, and stay so
            self.keys = np.insert(self.keys, place, hashes[missing])
            self.at, self.length = np.insert(self.at, place, at), np.insert(self.length, place, length)
            found = np.searchsorted(self.keys, hashes)
        return self.at[found], self.length[found]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out, group, size = [], [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size > BATCH_CHARS:
                out += self._encode(group)
                group, size = [], 0
        return out + self._encode(group)

    def _encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [np.empty(0, np.uint32)] * len(texts)
        points = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), np.uint32) for t in texts]
        known = [
            i for i, p in enumerate(points)
            if len(p) and not self.strange[np.minimum(p, KNOWN)].any() and not any(a in texts[i] for a in self.added)
        ]
        if known:
            joined = np.concatenate([points[i] for i in known])
            cuts = np.cumsum([0] + [len(points[i]) for i in known])
            starts = self.piece_starts(joined, cuts[:-1])
            ends = np.append(starts[1:], len(joined))
            if int((ends - starts).max()) > PIECE_BYTES:
                known = []  # one piece longer than the hash's tables
        if known:
            hashes = np.empty(len(starts), np.uint64)
            a = 0
            while a < len(starts):
                b = max(a + 1, int(np.searchsorted(ends, starts[a] + PIECE_BYTES, "right")))
                part = joined[starts[a] : ends[b - 1]]
                hashes[a:b] = self.hasher.hashes(part, starts[a:b] - starts[a], ends[a:b] - starts[a])
                a = b
            distinct, first, each = np.unique(hashes, return_index=True, return_inverse=True)
            whole = "".join(texts[i] for i in known)
            at, length = self._ids_of(distinct, lambda i: whole[starts[first[i]] : ends[first[i]]])
            counts = length[each]
            bounds = np.concatenate([[0], np.cumsum(counts)])
            ids = self.ids[np.arange(bounds[-1]) + np.repeat(at[each] - bounds[:-1], counts)]
            at_text = bounds[np.append(np.searchsorted(starts, cuts[:-1]), len(starts))]
            for k, i in enumerate(known):
                out[i] = ids[at_text[k] : at_text[k + 1]]
        rest = sorted(set(range(len(texts))) - set(known))
        rest = [i for i in rest if texts[i]]
        if rest:
            for i, ids in zip(rest, self.encode_all([texts[i] for i in rest])):
                out[i] = np.array(ids, np.uint32)
        return out


def encoder_of(path: str) -> PieceEncoder:
    store = worker_store("piece_encoders")
    if path not in store:
        store[path] = PieceEncoder(path)
    return store[path]


def _local(folder: str) -> str | None:
    """Path of a folder that is one of this machine, or of a file system all machines have mounted."""
    return "/" + folder.removeprefix("file:").lstrip("/") if folder.startswith("file:") else None


def _write_file(folder: str, name: str, content: bytes) -> None:
    """Write under another name and rename, so that a lost or doubled task leaves whole files only."""
    draft, root = f"_{name}-{uuid.uuid4().hex}", _local(folder)
    if root is not None:
        os.makedirs(root, exist_ok=True)
        with open(f"{root}/{draft}", "wb") as f:
            f.write(content)
        os.replace(f"{root}/{draft}", f"{root}/{name}")
        return
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder)
    system.create_dir(root)
    with system.open_output_stream(f"{root}/{draft}") as f:
        f.write(content)
    system.move(f"{root}/{draft}", f"{root}/{name}")


def _read_file(folder: str, name: str) -> bytes:
    root = _local(folder)
    if root is not None:
        with open(f"{root}/{name}", "rb") as f:
            return f.read()
    from pyarrow import fs

    system, root = fs.FileSystem.from_uri(folder)
    with system.open_input_file(f"{root}/{name}") as f:
        return f.read()


def _writer(folder: str, path: str, end_id: int, file_tokens: int):
    """Rows (id, text) of one range in order to (part, file, documents, tokens) of the files written."""

    def write(batches):
        from pyspark import TaskContext

        encoder, part = encoder_of(path), TaskContext.get().partitionId()
        ids, coded, size, count = [], [], 0, 0

        def close():
            name = f"part-{part:07d}-{count:05d}.dac"
            bounds = np.concatenate([[0], np.cumsum([len(c) for c in coded])])
            _write_file(folder, name, to_bytes(ids, bounds, np.concatenate(coded)))
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "file": [name], "documents": [len(ids)], "tokens": [size]}
            )

        for batch in slices(batches, most=BATCH_CHARS):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for number, tokens in zip(batch.column(0).to_pylist(), encoder.encode(texts)):
                ids.append(number)
                coded.append(np.append(tokens, np.uint32(end_id)))
                size += len(tokens) + 1
                if size >= file_tokens:
                    yield close()
                    ids, coded, size, count = [], [], 0, count + 1
        if ids:
            yield close()

    return write


def write_tokens(
    docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID,
    file_tokens: int = FILE_TOKENS,
) -> DataFrame:
    """Write files of `docs` in ascending order of id below `folder`; (part, file, documents, tokens) of each file.

    Ids are whole numbers of 64 bits, or text that spells one; other text is an error, as the files have no place for it.
    Null ids come first, rows with the same id by a hash of the text and then the text. Null texts are empty: their
    only token is the end id, which follows each document. No rows give no file. `folder` is a whole address of a
    shared file system.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order, "text")
    return ranged.mapInArrow(_writer(folder, tokenizer, end_id, file_tokens), "part int, file string, documents long, tokens long")


def _reader(folder: str):
    """Rows (file, first) to (doc_id, start, n_tokens, ids_crc32) of the documents in the files."""

    def read(batches):
        for batch in batches:
            for name, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file = DacFile(_read_file(folder, name))
                bounds, checks = file.bounds, []
                step = 1 << 20
                block, held = np.empty(0, np.uint32), (0, 0)
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    if b > held[1]:
                        held = (a, min(max(b, a + step), file.n_tokens))
                        block = file.tokens(*held)
                    checks.append(zlib.crc32(block[a - held[0] : b - held[0]].astype("<u4").tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(file.doc_ids, pa.int64()), pa.array(bounds[:-1] + first), pa.array(np.diff(bounds)), pa.array(checks, pa.int64())],
                    ["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return read


def first_tokens(files: DataFrame) -> DataFrame:
    """(file, first): how many tokens come before each file; sums of whole parts, and of files within a part."""
    ahead = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    parts = files.groupBy("part").agg(F.sum("tokens").alias("tokens"))  # a row for each writing task
    parts = parts.select("part", F.coalesce(F.sum("tokens").over(ahead(Window.orderBy("part"))), F.lit(0)).alias("before"))
    within = F.coalesce(F.sum("tokens").over(ahead(Window.partitionBy("part").orderBy("file"))), F.lit(0))
    return files.withColumn("within", within).join(parts, "part").select("file", (F.col("before") + F.col("within")).alias("first"))


def read_tokens(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of `folder`, from the files themselves.

    Names and first places are dealt out to tasks, which open the files; no content is shuffled.
    """
    count, tokens = files.agg(F.count(F.lit(1)), F.sum("tokens")).first()
    tasks = max(1, min(count, max(2 * spark.sparkContext.defaultParallelism, (tokens or 0) // READ_TOKENS)))
    dealt = first_tokens(files).repartition(tasks, "file")
    return dealt.mapInArrow(_reader(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_table(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the token files of `docs` into the shared folder and read them back, one row for each document.

    See `write_tokens` for nulls and order. Other columns are ignored; without rows the result is empty.
    """
    spark = docs.sparkSession
    landing = Landing(spark, "tokens")
    folder = f"{landing.root}/files"
    files = landing.land(write_tokens(docs, folder, tokenizer, id_col, text_col), "manifest")
    if files.isEmpty():
        return spark.createDataFrame([], "doc_id long, start long, n_tokens long, ids_crc32 long")
    return read_tokens(spark, folder, files)
