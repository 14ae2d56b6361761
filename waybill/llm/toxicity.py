"""Toxicity by compression distance.

Two zstandard dictionaries are trained: one of segments typical of toxic text, one of the commonest words of ordinary
text and of ordinary words that begin like toxic segments. A window, one word with its bounds, is compressed with
either; the bytes that the toxic dictionary saves are its excess. A document's excess is the sum over its different
windows whose own reaches a threshold, and its score a logistic of it. The windows' threshold and the logistic's middle
are calibrated on a third of the training documents that the dictionaries have not seen, so that the score of 0.7 falls
where labels are told apart best: for each band of lengths by itself, as few toxic words make a short text toxic, and a long one
gathers some excess by chance.

Windows are spelled out for the compressor: every character comes with a checksum of the word up to it. Matches
can then begin only where words begin, so a dictionary's word never matches the inside of another.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Landing
from .words import slices

TRAIN_ROWS = 30_000  # labelled documents learned from, expected number at most, by hash of id and text
HELD_SEGMENTS = 300_000  # that a training task counts before it hands them on
LEAST_SHARE = 0.02  # of toxic training documents that hold a segment
TYPICAL = 19.0  # times more often in toxic documents than in ordinary ones
LONGEST = 20  # characters of a segment
ORDINARY_WORDS, TOXIC_SEGMENTS, LOOKALIKES = 2000, 300, 4000
THRESHOLD = 0.7
LEAST_EXCESS = (6, 9, 12, 15)  # of a window that counts, one of these
BANDS = (50, 200, 500)  # different words from which a text is of the next band
BAND_TOXIC = 5  # toxic documents with an excess that a band needs for a middle of its own
SEPARATORS = re.compile(r"[^\w]+")


def words_of(text: str) -> list[str]:
    return SEPARATORS.sub(" ", text.lower()).split()


def segments(words: set[str]) -> set[str]:
    """Beginnings of words from four characters on, and whole words; a space marks a bound."""
    found = set()
    for word in words:
        cut = word[:LONGEST]
        found.update(" " + cut[:k] for k in range(4, len(cut)))
        if 3 <= len(word) <= LONGEST:
            found.add(f" {word} ")
    return found


def spelled(segment: str) -> bytes:
    """Each byte of a word with two bytes of checksum of the word so far; a bound is a space with zeros."""
    out = bytearray(b" \0\0")
    for word in segment.split(" "):
        if word:
            check = 7
            for byte in word.encode():
                check = (check * 31 + byte) % 64007
                out += bytes((byte, 1 + check // 256, check % 256))
            out += b" \0\0"
    return bytes(out if segment.endswith(" ") else out[:-3])


def _count_segments(batches):
    """Rows (toxic, text) to (segment, toxic, n): documents that hold each segment, summed up within the task."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def rows():
        for toxic, found in enumerate(counts):
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found.keys(), pa.string()), pa.array([toxic] * len(found), pa.int64()), pa.array(found.values(), pa.int64())],
                    ["segment", "toxic", "n"],
                )
                found.clear()

    for batch in slices(batches):
        for toxic, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            counts[toxic].update(segments(set(words_of(text.as_py()))))
        if len(counts[0]) + len(counts[1]) > HELD_SEGMENTS:
            yield from rows()
    yield from rows()


def compressor(content: bytes):
    """Stores literals as they are, so that lengths count matched bytes; no headers that differ between dictionaries."""
    import zstandard

    settings = zstandard.ZstdCompressionParameters(
        window_log=19, hash_log=17, chain_log=16, search_log=1, min_match=7, target_length=1, strategy=zstandard.STRATEGY_FAST,
        write_content_size=False, write_checksum=False, write_dict_id=False,
    )
    dictionary = zstandard.ZstdCompressionDict(content.ljust(64, b"\xff"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    dictionary.precompute_compress(compression_params=settings)
    return zstandard.ZstdCompressor(dict_data=dictionary, compression_params=settings)


class WindowScores:
    """Excess of windows under two dictionaries; each different window is compressed once while it is remembered."""

    REMEMBERED = 1_000_000

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = compressor(toxic), compressor(ordinary)
        self.known: dict[str, int] = {}

    def window(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            spelling = spelled(f" {word} ")
            found = len(self.ordinary.compress(spelling)) - len(self.toxic.compress(spelling))
            if len(self.known) >= self.REMEMBERED:
                self.known.clear()
            self.known[word] = found
        return found

    def document(self, text: str) -> tuple[int, list[int]]:
        """A text's band of length, and the excess of those of its different windows that have the least that may count."""
        words = set(words_of(text))
        return sum(len(words) >= b for b in BANDS), [x for x in map(self.window, words) if x >= LEAST_EXCESS[0]]


class ToxicityModel:
    """Contents of the two dictionaries, the least excess of windows that count, and (middle, slope) of each band's logistic."""

    def __init__(self, toxic: bytes, ordinary: bytes, least: int, logistics: list[tuple[float, float]]):
        self.toxic, self.ordinary, self.least, self.logistics = toxic, ordinary, least, logistics


def _prefix_free(found: list[tuple[str, int]], most: int) -> list[str]:
    """Segments by the characters they cover, none of which begins another."""
    kept: list[str] = []
    for segment, _ in sorted(found, key=lambda x: (-x[1] * len(x[0]), x[0])):
        if not any(segment.startswith(k) or k.startswith(segment) for k in kept):
            kept.append(segment)
        if len(kept) == most:
            break
    return kept


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = TRAIN_ROWS) -> ToxicityModel:
    """A model from the documents of `docs` that `labels` (id, toxic) marks 0 or 1.

    Beyond `rows` labelled documents a share is learned from, chosen by hash. An id with labels of both kinds counts as
    toxic. Equal texts are learned from once. What reaches the driver is the segments of the dictionaries and a
    histogram. Without toxic documents no window has an excess and all scores are low.
    """
    marks = labels.where(F.col("toxic").isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.max("toxic").alias("toxic"))
    total = marks.count()
    share = int(min(1.0, rows / max(total, 1)) * 1_000_000)
    marks = F.broadcast(marks.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share))
    texts = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    chosen = texts.join(marks, "id").select(F.col("toxic").cast("int").alias("toxic"), "text").distinct().repartition(24)
    unseen = F.pmod(F.xxhash64("text"), F.lit(3)) == 0
    seen = chosen.where(~unseen)
    counts = {r.toxic: r["n"] for r in seen.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_plain = counts.get(1, 0), counts.get(0, 0)
    counted = seen.mapInArrow(_count_segments, "segment string, toxic long, n long").groupBy("segment").agg(
        F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"),
        F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("plain"),
    )
    counted = Landing(docs.sparkSession, "toxicity").land(counted.where((F.col("bad") > 1) | F.col("segment").endswith(" ")), "segments")
    typical = counted.where(
        (F.col("bad") >= max(3.0, LEAST_SHARE * n_toxic)) & (F.col("bad") * (n_plain + 1.0) >= TYPICAL * (F.col("plain") + 0.5) * (n_toxic + 1.0))
    )
    found = typical.orderBy((F.col("bad") * F.length("segment")).desc(), "segment").limit(20 * TOXIC_SEGMENTS).collect()
    kept = _prefix_free([(r.segment, r.bad) for r in found], TOXIC_SEGMENTS)
    ordinary = counted.where(F.col("segment").endswith(" ") & (F.col("plain") * (n_toxic + 1.0) * 3 >= F.col("bad") * (n_plain + 1.0)))
    common = ordinary.orderBy(F.desc("plain"), "segment").limit(ORDINARY_WORDS).collect()
    alike = []
    if kept:
        begins = F.col("segment").rlike("^(?:" + "|".join(re.escape(k) for k in kept) + ")")
        alike = ordinary.where(begins).orderBy(F.desc("plain"), "segment").limit(LOOKALIKES).collect()
    toxic = b"".join(spelled(s) for s in reversed(kept))
    plain = b"".join(spelled(r.segment) for r in [*reversed(common), *reversed(alike)])
    shared = docs.sparkSession.sparkContext.broadcast((toxic, plain))
    excess = chosen.where(unseen).mapInArrow(_excess(shared, LEAST_EXCESS), "key int, least long, band int, excess long")
    histogram = excess.groupBy("least", "key", "band", "excess").agg(F.count(F.lit(1)).alias("n")).collect()
    found = [(least, *calibrated([tuple(r)[1:] for r in histogram if r.least == least])) for least in LEAST_EXCESS]
    least, _, logistics = max(found, key=lambda x: (x[1], x[0]))
    return ToxicityModel(toxic, plain, least, logistics)


def best_cut(histogram: list[tuple[int, int, int]]) -> tuple[int, int, float, float]:
    """(toxic documents found, others flagged, middle, slope) of the best balance (F1) over (toxic, excess, documents)."""
    toxic = sum(n for t, _, n in histogram if t == 1)

    def flagged(cut, kind):
        return sum(n for t, e, n in histogram if t == kind and e >= cut)

    values = sorted({e for _, e, _ in histogram if e > 0})
    cut = max(values, key=lambda v: (2 * flagged(v, 1) / (toxic + flagged(v, 0) + flagged(v, 1)), -v))
    below = max((v for v in values if v < cut), default=0)
    return flagged(cut, 1), flagged(cut, 0), (cut + below) / 2, 4.0 / max(cut, 1)


def calibrated(histogram: list[tuple[int, int, int, int]]) -> tuple[float, list[tuple[float, float]]]:
    """F1 over all (toxic, band, excess, documents), and each band's middle and slope.

    A band with few toxic documents that have an excess takes the middle of all bands together.
    """
    every = [(t, e, n) for t, _, e, n in histogram]
    if not any(t == 1 and e > 0 for t, e, _ in every):
        return 0.0, [(1.0, 1.0)] * (len(BANDS) + 1)
    _, _, middle, slope = best_cut(every)
    logistics, right, wrong = [], 0, 0
    for band in range(len(BANDS) + 1):
        here = [(t, e, n) for t, b, e, n in histogram if b == band]
        own = sum(n for t, e, n in here if t == 1 and e > 0) >= BAND_TOXIC
        logistics.append(best_cut(here)[2:] if own else (middle, slope))
        for t, e, n in here:
            right, wrong = (right + n * (t == 1), wrong + n * (t == 0)) if e > logistics[-1][0] else (right, wrong)
    toxic = sum(n for t, _, n in every if t == 1)
    return 2 * right / (toxic + right + wrong), logistics


def _excess(shared, leasts: tuple[int, ...]):
    def read(batches):
        scores = WindowScores(*shared.value)
        for batch in slices(batches):
            found = [scores.document(t.as_py() or "") for t in batch.column(1)]
            bands = pa.array([band for band, _ in found], pa.int32())
            for least in leasts:
                sums = pa.array([sum(x for x in excess if x >= least) for _, excess in found], pa.int64())
                columns = [batch.column(0), pa.array([least] * len(found), pa.int64()), bands, sums]
                yield pa.RecordBatch.from_arrays(columns, ["key", "least", "band", "excess"])

    return read


def toxicity_scores(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, excess, score, predicted) for every row of `docs`; predicted is 1 from a score of THRESHOLD on.

    Null, empty and wordless texts have no excess and the lowest score. Rows with null or repeated ids are each scored;
    other columns are ignored; an empty table gives an empty result. Windows of any length are compressed whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.toxic, model.ordinary))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("key"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(_excess(shared, (model.least,)), f"key {kind}, least long, band int, excess long")
    shift = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    middle, slope = (F.get(F.array(*[F.lit(float(x[i])) for x in model.logistics]), F.col("band")) for i in (0, 1))
    score = 1 / (1 + F.exp(-(F.col("excess") - middle) * slope - shift))
    scored = found.select(F.col("key").alias(id_col), "excess", score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
