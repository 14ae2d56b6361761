"""Quality rules: counts of each text, and a log-likelihood ratio between trusted and raw text for the verdict.

Words and pairs of neighbouring words are hashed into buckets. Two multinomials over the buckets are counted, one over
all documents and one over the trusted ones. A document's score is the mean logarithm of trusted to raw probability
over its n-grams, both smoothed by counts, as trusted documents are a part of all and rare n-grams of others would
else look untrusted; documents below a fixed threshold are rejected. Everything is built from column functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters that separate words, and those that count as symbols.
SPACES = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"

BUCKETS = 1 << 16
TRUSTED_ROWS = 50_000  # labelled rows that the trusted multinomial is fitted on at most, by hash of their id
PRIOR = 5.0  # added to a bucket's trusted count and to the one expected of it, so that rare n-grams say little
THRESHOLD = -0.2
LEAST_WORDS, MOST_REPEATED = 50, 50  # words; percent of words in repeated windows


def _once(df: DataFrame, keep: list[str], **made: Column) -> DataFrame:
    """The columns `keep`, and others that are made once for each row.

    They come out of a generator, which no rule moves: plain columns would be put into their uses, and so be made again
    for every element of a lambda, or a second time in a filter on the result.
    """
    row = F.explode(F.array(F.struct(*[c.alias(n) for n, c in made.items()]))).alias("made")
    return df.select(*keep, row).select(*keep, *[F.col(f"made.{n}").alias(n) for n in made])


def _replaced(c: Column, chars: str, by: str) -> Column:
    for char in chars:
        c = F.replace(c, F.lit(char), F.lit(by))
    return c


def _neighbours(array: str) -> Column:
    """A hash of each element of an array of numbers and the one behind it."""
    rest = f"greatest(size({array}) - 1, 0)"
    return F.expr(f"zip_with(slice({array}, 1, {rest}), slice({array}, 2, {rest}), (x, y) -> xxhash64(x, y))")


def _hashed(rows: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Adds `words`, and hashes of the words and of the pairs of neighbours."""
    content = F.coalesce(F.col(text), F.lit(""))
    rows = _once(rows, keep, words=F.array_remove(F.split(_replaced(content, SPACES[1:], " "), " "), ""))
    rows = _once(rows, [*keep, "words"], hashes=F.transform("words", lambda w: F.xxhash64(w)))
    return _once(rows, [*keep, "words", "hashes"], pairs=_neighbours("hashes"))


def trusted_ids(labels: DataFrame, id_col: str = "doc_id", quality_col: str = "quality", rows: int = TRUSTED_ROWS) -> DataFrame:
    """Ids with quality 1, each once; where there are more than `rows`, those of the lowest hashes."""
    ids = labels.where(F.col(quality_col) == 1).where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct()
    return ids.orderBy(F.xxhash64("id"), "id").limit(rows)


def bucket_weights(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[float]:
    """Log ratio of trusted to raw probability for each bucket; 0 for all where nothing is trusted.

    The counts cover all documents. What reaches the driver is one number per bucket.
    """
    trusted = F.broadcast(trusted_ids(labels).withColumn("trusted", F.lit(1)))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(trusted, "id", "left")
    grams = _hashed(rows, "text", ["trusted"]).select(F.coalesce("trusted", F.lit(0)).alias("trusted"), F.explode(F.concat("hashes", "pairs")).alias("gram"))
    bucket = F.col("gram").bitwiseAND(BUCKETS - 1).cast("int").alias("bucket")
    counts = grams.groupBy(bucket).agg(F.count(F.lit(1)).alias("raw"), F.sum("trusted").alias("good"))
    found = counts.collect()
    raw_all, good_all = sum(r.raw for r in found), sum(r.good for r in found)
    weights = [0.0] * BUCKETS
    for bucket, raw, good in found:
        weights[bucket] = math.log((good + PRIOR) / (raw * good_all / raw_all + PRIOR)) if good_all else 0.0
    return weights


def _repeated(rows: DataFrame, keep: list[str]) -> DataFrame:
    """Adds `n_repeat_words`, the words in windows of three that are found more than once.

    Windows are sorted by hash where any comes again; the places of those with an equal neighbour, sorted, cover three
    words each, or as many as lie between one and the next.
    """
    rows = _once(rows, keep, windows=_neighbours("pairs"))
    again = F.expr("""if(size(array_distinct(windows)) < size(windows),
        sort_array(transform(windows, (x, i) -> struct(x as hash, i as place))), null)""")
    rows = _once(rows, keep, by_hash=again)
    places = F.expr("""sort_array(transform(filter(by_hash, (e, k) -> (k > 0 and by_hash[greatest(k - 1, 0)].hash = e.hash)
        or (k < size(by_hash) - 1 and by_hash[least(k + 1, size(by_hash) - 1)].hash = e.hash)), e -> e.place))""")
    rows = _once(rows, keep, places=places)
    gaps = F.expr("zip_with(slice(places, 2, size(places) - 1), slice(places, 1, size(places) - 1), (b, a) -> least(3, b - a))")
    covered = F.aggregate(gaps, F.lit(3).cast("long"), lambda total, gap: total + gap)
    return _once(rows, keep, n_repeat_words=F.coalesce(covered, F.lit(0).cast("long")))


def _judged(rows: DataFrame, text: str, keep: list[str], weights: list[float], threshold: float) -> DataFrame:
    """The columns `keep`, of which no name is one of those made here, with all counts, the score and the verdict."""
    table = F.split(F.lit(",".join(f"{w:.6g}" for w in weights)), ",").cast("array<double>")
    kept = list(dict.fromkeys([*keep, text]))
    rows = _hashed(rows, text, kept)

    def total(array: str) -> Column:
        weight = lambda x: F.get(table, x.bitwiseAND(BUCKETS - 1).cast("int"))
        return F.aggregate(array, F.lit(0.0), lambda sum_, x: sum_ + weight(x))

    content = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(content, "\n"), lambda line: _replaced(line, SPACES, "") != "")
    counts = {
        "n_words": F.size("words").cast("long"),
        "word_chars": F.char_length(F.array_join("words", "")).cast("long"),
        "n_symbols": (F.char_length(content) - F.char_length(_replaced(content, SYMBOLS, ""))).cast("long"),
        "n_dup_lines": F.get(F.transform(F.array(lines), lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0)).cast("long"),
        "score": (total("hashes") + total("pairs")) / F.greatest(2 * F.size("words") - 1, F.lit(1)),
    }
    rows = _once(rows, [*kept, "pairs"], **counts)
    rows = _repeated(rows, [*kept, *counts])
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return rows.select(
        *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score", failed.alias("base_failed"),
        (~failed & (F.col("score") >= threshold)).alias("kept"),
    )


def quality_verdicts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
    weights: list[float] | None = None,
) -> DataFrame:
    """Counts, score and verdict for every row of `docs`; other columns are left out.

    Null texts count as empty. A text without words has score 0 and fails the base rules, as all with fewer than 50
    words do. Rows with a null or repeated id are judged each for itself; a null id is never trusted, and labels that
    are null or of unknown documents count for nothing. With no trusted document all scores are 0, which passes. Empty tables give an
    empty result. A filter on any column of the result costs no more than the result itself.
    """
    weights = bucket_weights(docs, labels, id_col, text_col) if weights is None else weights
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return _judged(rows, "text", ["id"], weights, threshold).withColumnRenamed("id", id_col)


def kept_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` with all their columns that `quality_verdicts` keeps."""
    weights = bucket_weights(docs, labels, id_col, text_col)
    numbered = docs.toDF(*[f"column_{i}" for i in range(len(docs.columns))])  # no name that the steps use
    judged = _judged(numbered, numbered.columns[docs.columns.index(text_col)], numbered.columns, weights, THRESHOLD)
    return judged.where("kept").select(numbered.columns).toDF(*docs.columns)
