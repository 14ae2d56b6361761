"""Language of texts: multinomial naive Bayes over hashed character n-grams.

Characters are lower-cased, everything that is no letter becomes one mark, and runs of GRAM characters are hashed into
buckets. Spark counts the buckets of each language; the matrix of log-probabilities goes to all executors. The n-grams of
a whole Arrow batch are counted into one sparse matrix of texts by buckets, in compressed rows, and its product with the
matrix of log-probabilities scores all texts at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import worker_store
from .words import slices

GRAM = 3
BUCKETS = 1 << 16
TRAIN_ROWS = 40_000  # labelled rows learned from, expected number at most, by hash of their id
SMOOTHING = 0.5
MOST_LANGUAGES = 300
PIECE = 1 << 18  # entries of the sparse matrix that are multiplied at a time
UNKNOWN = "und"


def _letters() -> np.ndarray:
    """For every code point, whether it is a letter."""
    store = worker_store("language")
    if "letters" not in store:
        store["letters"] = np.array([chr(c).isalpha() for c in range(0x110000)])
    return store["letters"]


def gram_buckets(text: str, letters: np.ndarray) -> np.ndarray:
    """Buckets of all n-grams of a text framed by marks; none for a text without letters."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    known = letters[points]
    if not known.any():
        return np.empty(0, np.int64)
    points = np.where(known, points, 0)
    keep = known.copy()
    keep[1:] |= known[:-1]  # of several marks in a row the first
    points = np.concatenate([[0], points[keep], [0, 0]]).astype(np.uint64)
    hashed = np.zeros(len(points) - GRAM + 1, np.uint64)
    for i in range(GRAM):
        hashed = (hashed + points[i : len(hashed) + i] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        hashed ^= hashed >> np.uint64(29)
    return (hashed >> np.uint64(20) & np.uint64(BUCKETS - 1)).astype(np.int64)


def _count(batches):
    """Rows (lang, text) to (lang, bucket, n), summed up within the task."""
    letters, counts = _letters(), {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            found = counts.setdefault(lang, np.zeros(BUCKETS + 1, np.int64))
            found[BUCKETS] += 1  # documents
            found[:BUCKETS] += np.bincount(gram_buckets(text, letters), minlength=BUCKETS)
    for lang, found in counts.items():
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(found[at])], ["lang", "bucket", "n"]
        )


class LanguageModel:
    """Languages in order, log-probability of each bucket for each (buckets x languages), and log of their shares."""

    def __init__(self, langs: list[str], counts: np.ndarray, documents: np.ndarray):
        self.langs = langs
        self.matrix = np.log((counts + SMOOTHING) / (counts.sum(axis=0) + SMOOTHING * BUCKETS)).astype(np.float32)
        self.share = np.log(documents / documents.sum()) if len(langs) else np.empty(0)


def sparse_counts(texts: list[str | None], letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bounds of the rows, buckets and counts of a sparse matrix with a row for each text."""
    rows = [np.unique(gram_buckets(text or "", letters), return_counts=True) for text in texts]
    bounds = np.cumsum([0, *(len(buckets) for buckets, _ in rows)])
    buckets, counts = (np.concatenate([np.empty(0, np.int64), *parts]) for parts in (zip(*rows) if rows else ((), ())))
    return bounds, buckets, counts


def sparse_scores(bounds: np.ndarray, buckets: np.ndarray, counts: np.ndarray, matrix: np.ndarray, share: np.ndarray) -> np.ndarray:
    """Log-likelihood of each row in each language; rows without n-grams have the log of the shares."""
    total = np.repeat(share[None, :], len(bounds) - 1, axis=0)
    row_of = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    for lang in range(len(share)):
        for at in range(0, len(buckets), PIECE):
            part = slice(at, at + PIECE)
            weights = counts[part] * matrix[buckets[part], lang].astype(np.float64)
            total[:, lang] += np.bincount(row_of[part], weights=weights, minlength=len(total))
    return total


def fit_languages(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", rows: int = TRAIN_ROWS):
    """A model of the languages in `docs`; rows without text or language don't count.

    Beyond `rows` rows a share is learned from, chosen by hash of id and text. What reaches the driver is one number
    for each language and bucket, of at most `MOST_LANGUAGES` languages; more are an error.
    """
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    total = usable.count()
    share = int(min(1.0, rows / max(total, 1)) * 1_000_000)
    chosen = usable.where(F.pmod(F.xxhash64(id_col, text_col), F.lit(1_000_000)) < share)
    counted = chosen.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counted = counted.mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    if chosen.select(lang_col).distinct().count() > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages; raise MOST_LANGUAGES if the driver has the memory")
    found = counted.collect()
    langs = sorted({r.lang for r in found})
    place = {lang: i for i, lang in enumerate(langs)}
    counts = np.zeros((BUCKETS + 1, len(langs)))
    for lang, bucket, n in found:
        counts[bucket, place[lang]] = n
    return LanguageModel(langs, counts[:BUCKETS], counts[BUCKETS])


def _predict(shared):
    def read(batches):
        (names, matrix, share), letters = shared.value, _letters()
        for batch in slices(batches):
            bounds, buckets, counts = sparse_counts(batch.column(1).to_pylist(), letters)
            known = (np.diff(bounds) > 0) & (len(names) > 0)
            langs, scores = np.full(len(known), UNKNOWN, object), np.zeros(len(known))
            if known.any():
                total = sparse_scores(bounds, buckets, counts, matrix, share)[known]
                best = total.argmax(axis=1)
                langs[known] = np.array(names, object)[best]
                scores[known] = 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["id", "lang_pred", "score"]
            )

    return read


def predict_languages(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score) for every row: the likeliest language and its probability among those learned.

    A text that is null or has no letter is `und` with score 0, as is every text where no language was learned. Of
    equally likely languages the first by name is taken. Rows with null or repeated ids are each predicted; other columns are
    ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast((model.langs, model.matrix, model.share))
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = rows.mapInArrow(_predict(shared), f"id {kind}, lang_pred string, score double")
    return found.withColumnRenamed("id", id_col)
