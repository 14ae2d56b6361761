"""Runs of periodic words: a dictionary of basic factors over the words of each text.

The factors of length 2^k are named level by level: two neighbouring factors of one level make one of the next. Within
a run of period q, each factor of the first power of two L >= q comes again after exactly q words, and the two lie
within a window of 2 L. So on each level the successors at distances from L/2 (exclusive) to L propose periods: the
occurrences form arithmetic progressions, and neighbouring positions with the same distance are a stretch whose factors,
laid over one another, are the run. A stretch ends where the period ends, which makes it maximal; and a period has one level,
so that no run is proposed twice. A position whose factor comes only once in its text can open no longer factor that repeats,
and leaves the dictionary; ordinary text is through after a few levels.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .words import Hasher, slices, text_buffers

SHORTEST = 6  # words a run has at least
TIMES = 4  # periods a run has at least; the dictionary needs three

RUN = "array<struct<start:bigint,length:bigint,period:bigint>>"


def batch_words(column: pa.Array, hasher: Hasher) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts one after another, and each text's bounds among them. Null texts have none."""
    data, bounds = text_buffers(column)
    at = int(bounds[0])
    part = data[at : int(bounds[-1])]
    starts, ends = hasher.spans(part, bounds - at) if len(part) else (np.empty(0, np.int64),) * 2
    offsets = np.concatenate([[0], np.cumsum(ends - starts)])
    packed = part[~hasher.space[part]]
    words = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(packed))
    return words, np.searchsorted(starts, bounds - at)


def _stretches(at: np.ndarray, distance: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(start, length, period) of each series of neighbouring positions with one distance to their successors."""
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1] + 1) | (distance[1:] != distance[:-1])
    first = np.flatnonzero(fresh)
    last = np.append(first[1:], len(at))[: len(first)] - 1
    period = distance[first]
    return at[first], at[last] - at[first] + length + period, period


def find_runs(codes: np.ndarray, bounds: np.ndarray, shortest: int = SHORTEST, times: int = TIMES) -> np.ndarray:
    """Rows (text, start, length, period) of all runs, by text, start and period; `codes` are numbers of words.

    A run is a stretch of one text with smallest period q, of at least `shortest` words and `times` q, that no
    neighbouring word extends.
    """
    if times < 3:
        raise ValueError("runs of fewer than three periods are not found by their factors")
    n = len(codes)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    longest = int(np.diff(bounds).max(initial=0))
    found = [np.empty((4, 0), np.int64)]
    alive = np.arange(n)
    keys = text * (int(codes.max(initial=0)) + 1) + codes
    names = np.empty(n, np.int64)
    length = 1
    # A period above length / 2 needs a text of `times` periods.
    while len(alive) and times * (length // 2 + 1) <= longest:
        order = np.argsort(keys, kind="stable")
        places, sorted_keys = alive[order], keys[order]
        again = sorted_keys[1:] == sorted_keys[:-1]
        distance = np.diff(places)
        proposing = again & (distance <= length) & (2 * distance > length)
        at = places[:-1][proposing]
        by_place = np.argsort(at, kind="stable")
        start, size, period = _stretches(at[by_place], distance[proposing][by_place], length)
        enough = size >= np.maximum(shortest, times * period)
        start = start[enough]
        found.append(np.stack([text[start], start - bounds[text[start]], size[enough], period[enough]]))
        # Names of this level, for positions whose factor repeats; the next level's factors are pairs of them.
        repeated = np.zeros(len(places), bool)
        repeated[1:] |= again
        repeated[:-1] |= again
        number = np.cumsum(np.concatenate([[False], ~again])) if len(places) else np.empty(0, np.int64)
        names.fill(-1)
        names[places[repeated]] = number[repeated]
        alive = np.sort(places[repeated])
        alive = alive[alive + length < n]
        alive = alive[(names[alive + length] >= 0) & (text[alive + length] == text[alive])]
        keys = names[alive] * (n + 1) + names[alive + length]
        length *= 2
    runs = np.concatenate(found, axis=1)
    return runs[:, np.lexsort((runs[3], runs[1], runs[0]))].T


def repeated_words(runs: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which words lie in a run behind its first period."""
    change = np.zeros(int(bounds[-1]) + 1, np.int64)
    start = bounds[runs[:, 0]] + runs[:, 1]
    np.add.at(change, start + runs[:, 3], 1)
    np.add.at(change, start + runs[:, 2], -1)
    return np.cumsum(change[:-1]) > 0


def _scan(batches, shortest: int, times: int):
    hasher = Hasher()
    for batch in slices(batches):
        words, bounds = batch_words(batch.column(1), hasher)
        codes = words.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        runs = find_runs(codes, bounds, shortest, times)
        stay = ~repeated_words(runs, bounds)
        left = np.concatenate([[0], np.cumsum(stay)])[bounds]
        kept = pa.LargeListArray.from_arrays(pa.array(left, pa.int64()), words.filter(pa.array(stay)))
        of_text = np.searchsorted(runs[:, 0], np.arange(batch.num_rows + 1))
        each = pa.StructArray.from_arrays([pa.array(runs[:, i]) for i in (1, 2, 3)], ["start", "length", "period"])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0), pa.array(np.diff(bounds)), pa.ListArray.from_arrays(pa.array(of_text, pa.int32()), each),
                pc.binary_join(kept, pa.scalar(" ", pa.large_string())).cast(pa.string()),
            ],
            ["id", "n_words", "runs", "collapsed"],
        )


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, times: int = TIMES
) -> DataFrame:
    """(id, n_words, runs, collapsed) for every row: the runs of its words, and the words left without repeated periods.

    `runs` holds start (a word's number from 0), length and period, by start and then period. `collapsed` joins by one
    space the words that lie in no run behind the run's first period. Null, empty and blank texts have no word, no
    run and empty text. Rows with null or repeated ids are each scanned; other columns are ignored; an empty table
    gives an empty one. No rows are shuffled; a task holds about 4 MB of text at a time, or one longer text.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)])
    for field in T.StructType.fromDDL(f"n_words bigint, runs {RUN}, collapsed string"):
        schema = schema.add(field)
    found = rows.mapInArrow(lambda batches: _scan(batches, shortest, times), schema)
    return found.withColumnRenamed("id", id_col)
