"""Benchmark items found in documents, verbatim or with other numbers, names and units.

Texts become runs of letters and digits, lower-cased. Those with a digit, capitalised ones inside a sentence and words of
measure are replaced by a placeholder of their kind. Windows of WIDTH such words are hashed; windows of documents and of
items with the same hash are joined. In each passage so found a slot's value in the item must always stand for the
same value in the document. Windows with few literal words are left out there, as too much would fit them. All windows
are hashed a second time with their words as they are, and joined exactly. A document holds an item if enough of the
item's windows of either kind are in it. An item of a few words is held where they are a line of their own.

A window that many items share, as a stock opening of questions, says little: an item needs others as well, unless such
windows alone reach the cover. So those are joined only where another window of the item is met.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import Landing, broadcast_if_small
from .words import Hasher, mixed, slices, word_table

WIDTH = 8  # words of a window; an item with fewer is one window
LEAST_WORDS = 4  # an item with fewer can't be told from ordinary text, but as a whole line
STOCK = 50  # items from which a window they share is a stock one
LITERAL_SHARE = 0.5  # of a template window's words that aren't placeholders, at least
COVER = 0.3  # of an item's windows, at least
BATCH_BYTES = 1 << 20  # of text whose windows a task holds at a time, or one longer text
BROADCAST_WINDOWS = 2_000_000  # hashes of item windows sent to all executors at most (16 MB); beyond, a shuffled join

# Words of measure.
UNITS = (
    "mm cm m km g kg mg t l ml s sec min h hr hrs day days week weeks month months year years hour hours minute minutes "
    "second seconds meter meters metre metres kilometer kilometers gram grams kilogram kilograms liter liters litre "
    "litres mile miles foot feet inch inches pound pounds ounce ounces dollar dollars cent cents euro euros percent "
    "degree degrees usd eur gbp"
).split()
LITERAL, NUMBER, NAME, UNIT = range(4)
TEMPLATE, QUOTED, RAW = range(3)  # forms of windows

_SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum())
_STEP = np.uint64(0xC2B2AE3D27D4EB4F)
_RAW = np.uint64(0x165667B19E3779F9)  # keeps hashes of plain words apart from those of templates


class Templates:
    """Canonical words of batches of texts, and their windows."""

    def __init__(self):
        self.hasher = Hasher(fold=True, space=_SEPARATORS)
        self.units = np.sort(word_table(pa.array(UNITS), self.hasher)[0])
        self.digit = np.isin(np.arange(256), list(b"0123456789"))
        self.stop = np.isin(np.arange(256), list(b".!?\n"))

    def canonical(self, column: pa.Array):
        """(template hash, value hash, kind) of every word, whether it is capitalised and opens a line, and texts' bounds among them."""
        values, starts, ends, bounds, data = word_table(column, self.hasher)
        kinds, capital, opens_line = np.zeros(len(values), np.int8), np.zeros(len(values), bool), np.ones(len(values), bool)
        if len(values):
            low = int(starts[0])  # the buffer may hold the texts of a larger batch
            data, starts, ends = data[low : int(ends[-1])], starts - low, ends - low
            first = data[starts]
            second = data[np.minimum(starts + 1, len(data) - 1)]
            capital = (first >= 65) & (first <= 90) | (first == 0xC3) & (second >= 0x80) & (second <= 0x9E)
            stops = np.concatenate([[0], np.cumsum(self.stop[data], dtype=np.int32)])
            opens = np.ones(len(values), bool)
            opens[1:] = stops[starts[1:]] > stops[ends[:-1]]
            opens[bounds[:-1][bounds[:-1] < len(values)]] = True
            ends_line = np.concatenate([[0], np.cumsum(data == 10, dtype=np.int32)])
            opens_line[1:] = ends_line[starts[1:]] > ends_line[ends[:-1]]
            opens_line[bounds[:-1][bounds[:-1] < len(values)]] = True
            kinds[capital & ~opens] = NAME
            at = np.minimum(np.searchsorted(self.units, values), len(self.units) - 1)
            kinds[self.units[at] == values] = UNIT
            digits = np.concatenate([[0], np.cumsum(self.digit[data], dtype=np.int32)])
            kinds[digits[ends] > digits[starts]] = NUMBER
        template = np.where(kinds == LITERAL, values, mixed(kinds.astype(np.uint64)))
        return template, values, kinds, capital, opens_line, bounds

    @staticmethod
    def windows(template: np.ndarray, kinds: np.ndarray | None, bounds: np.ndarray, width: int):
        """Hashes of all windows of `width` words and where they start.

        Those of too few literal words are left out. With `kinds` None the words are plain, and none is.
        """
        n = len(template) - width + 1
        if n <= 0:
            return np.empty(0, np.uint64), np.empty(0, np.int64)
        hashes = np.zeros(n, np.uint64)
        for i in range(width):
            hashes = hashes * _STEP + template[i : n + i]
        fit = np.ones(n, bool)
        if kinds is not None:
            literal = np.concatenate([[0], np.cumsum(kinds == LITERAL)])
            fit = (literal[width:] - literal[:-width]) >= LITERAL_SHARE * width
        for cut in bounds[1:-1]:
            fit[max(0, cut - width + 1) : cut] = False
        at = np.flatnonzero(fit)
        return mixed(hashes[at] + np.uint64(width) + (_RAW if kinds is None else np.uint64(0))), at


def _slots(values, kinds, at, width):
    return [values[i : i + width][kinds[i : i + width] != LITERAL].astype(np.int64) for i in at]


def _windows_of(widths: tuple[int, ...] | None, wanted):
    """Rows (key, text) to (key, hash, place, slots, windows, form, width): those in `wanted`, a broadcast sorted array, or all.

    With `widths` None each text has windows of WIDTH words, or one of all its words; `windows` says how many. Given
    widths below LEAST_WORDS stand for lines of so many words.
    Raw windows have no slots. A capitalised word that opens such a text is a literal there, but a name where the text is
    quoted behind a colon or quotation mark: its first window comes in both forms.
    """

    def read(batches):
        templates = Templates()
        hashes_wanted = None if wanted is None else wanted.value
        own = widths is None
        for batch in slices(batches, most=BATCH_BYTES):
            template, values, kinds, capital, opens_line, bounds = templates.canonical(batch.column(1))
            sizes = np.diff(bounds)
            lines = np.append(np.flatnonzero(opens_line), len(values))

            def found(words, kinds, width, form):
                hashes, at = templates.windows(words, kinds, bounds, width)
                text = np.searchsorted(bounds, at, "right") - 1
                keep = np.ones(len(at), bool)
                if own:
                    keep = np.minimum(sizes[text], WIDTH) == width
                elif hashes_wanted is not None and len(at):
                    there = np.minimum(np.searchsorted(hashes_wanted, hashes), len(hashes_wanted) - 1)
                    keep = hashes_wanted[there] == hashes
                if not own and width < LEAST_WORDS:
                    keep &= np.isin(at, lines[:-1][np.diff(lines) == width])
                hashes, at, text = hashes[keep], at[keep], text[keep]
                counts = np.bincount(text, minlength=len(sizes))[text] if len(text) else np.empty(0, np.int64)
                if form == QUOTED:
                    first = at == bounds[text]
                    hashes, at, text, counts = hashes[first], at[first], text[first], counts[first]
                slots = [[]] * len(at) if form == RAW else _slots(values, kinds, at, width)
                return pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(text)), pa.array(hashes.astype(np.int64)), pa.array(at - bounds[text]),
                     pa.array(slots, pa.list_(pa.int64())), pa.array(counts, pa.int64()), pa.array(np.full(len(at), form, np.int32)),
                     pa.array(np.full(len(at), width, np.int32))],
                    ["key", "hash", "place", "slots", "windows", "form", "width"],
                )

            for width in sorted({min(WIDTH, int(s)) for s in sizes if s}) if own else widths:
                yield found(values, None, width, RAW)
                if width < LEAST_WORDS:
                    continue
                yield found(template, kinds, width, TEMPLATE)
                if own:
                    opens = bounds[:-1][sizes > 0]
                    opens = opens[capital[opens] & (kinds[opens] == LITERAL)]
                    named, named_kinds = template.copy(), kinds.copy()
                    named[opens], named_kinds[opens] = mixed(np.array([NAME], np.uint64))[0], NAME
                    yield found(named, named_kinds, width, QUOTED)

    return read


def _schema(kind: str) -> str:
    return f"key {kind}, hash long, place long, slots array<long>, windows long, form int, width int"


def _met(windows: DataFrame, items: DataFrame, cover: float) -> DataFrame:
    """Windows of documents beside equal ones of items, all that matter for items that reach the cover.

    Stock windows of an item whose other windows are needed for the cover are joined where one of these was met.
    """
    shared = items.groupBy("hash").agg(F.countDistinct("item").alias("items")).where(F.col("items") > STOCK).select("hash", F.lit(True).alias("stock"))
    marked = items.join(shared, "hash", "left").withColumn("stock", F.coalesce("stock", F.lit(False)))
    raw = (F.col("form") == RAW).alias("of_raw")
    stocks = marked.where("stock").groupBy("item", raw).agg(F.countDistinct("item_place").alias("stocks"), F.max("item_windows").alias("all_windows"))
    leaning = stocks.where(F.col("stocks") >= cover * F.col("all_windows")).select("item").distinct()  # on stock windows alone
    marked = marked.join(leaning.withColumn("leans", F.lit(True)), "item", "left")
    late = F.col("stock") & F.col("leans").isNull()

    def met(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
        return left.join(right.drop("stock", "leans"), keys).where(
            (F.size("slots") == F.size("item_slots"))
            & ((F.col("form") != QUOTED) | F.get("slots", F.lit(0)).eqNullSafe(F.get("item_slots", F.lit(0))))
        )

    columns = ["id", "text_hash", "place", "slots", "item", "item_place", "item_slots", "item_windows", "form"]
    first = met(windows, marked.where(~late), ["hash"]).select(columns)
    held = first.select(F.col("id").alias("of_id"), F.col("text_hash").alias("of_text"), "item").distinct()
    stock_windows = windows.join(shared.select("hash"), "hash", "left_semi")
    of_same = (F.col("text_hash") == F.col("of_text")) & F.col("id").eqNullSafe(F.col("of_id"))
    again = stock_windows.join(held, of_same).select("id", "text_hash", "hash", "place", "slots", "item")
    return first.unionByName(met(again, marked.where(late), ["hash", "item"]).select(columns))


def contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", cover: float = COVER,
) -> DataFrame:
    """One row for each document and each item it holds: id, item, matched and item windows, whether values differ.

    The windows are those of templates, or the raw ones where only they reach the cover.
    Null, empty and blank texts hold nothing and blank items are held by nothing; items of fewer than LEAST_WORDS words are
    held by texts that have a line of just these words. Rows that
    agree in id and text give one row for each item; rows with an id but different texts are looked at each for
    itself. Null ids stay null. Items of equal text are all named. Other columns are ignored. With no documents or no items the
    result is empty.
    """
    spark = docs.sparkSession
    landing = Landing(spark, "decontamination")
    items = benchmark.select(F.col(item_col).alias("key"), F.col(item_text_col).alias("text")).where(F.col("key").isNotNull())
    kind = items.schema["key"].dataType.simpleString()
    items = landing.land(items.mapInArrow(_windows_of(None, None), _schema(kind)), "items")
    items = items.select(
        F.col("key").alias("item"), "hash", F.col("place").alias("item_place"), F.col("slots").alias("item_slots"),
        F.col("windows").alias("item_windows"), "form", "width",
    )
    widths = tuple(sorted(r[0] for r in items.select("width").distinct().collect()))
    distinct = items.select("hash").distinct()
    wanted = None
    if distinct.count() <= BROADCAST_WINDOWS:
        found = np.array([r[0] for r in distinct.collect()], np.int64).astype(np.uint64)
        wanted = spark.sparkContext.broadcast(np.sort(found) if len(found) else np.zeros(1, np.uint64))
    rows = docs.select(
        F.struct(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("text_hash")).alias("key"),
        F.col(text_col).alias("text"),
    )
    kind = docs.schema[id_col].dataType.simpleString()
    windows = rows.mapInArrow(_windows_of(widths, wanted), _schema(f"struct<id:{kind},text_hash:bigint>"))
    windows = windows.select("key.id", "key.text_hash", "hash", "place", "slots")
    if wanted is None:
        windows = windows.join(distinct, "hash", "left_semi")
    windows = landing.land(windows, "windows")
    met = _met(windows, items.drop("width"), cover)
    met = met.withColumn("raw", F.col("form") == RAW).drop("form")
    met = landing.land(met.distinct(), "met")

    passage = ["id", "text_hash", "item", "raw", "shift"]
    met = met.withColumn("shift", F.col("place") - F.col("item_place"))
    slots = met.select(*passage, F.explode(F.arrays_zip("item_slots", "slots")).alias("slot"))
    slots = slots.select(*passage, F.col("slot.item_slots").alias("item_value"), F.col("slot.slots").alias("value")).distinct()
    clashes = slots.groupBy(*passage, "item_value").agg(F.count(F.lit(1)).alias("values")).where(F.col("values") > 1)
    clashes = clashes.select(*[F.col(c).alias(f"c_{c}") for c in passage]).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"c_{c}")) for c in passage]
    sound = met.join(clashes, same, "left_anti")
    counted = sound.groupBy("id", "text_hash", "item", "raw").agg(
        F.countDistinct("item_place").alias("matched_windows"), F.max("item_windows").alias("item_windows"),
        F.max(F.col("slots") != F.col("item_slots")).alias("other_values"),
    )
    enough = counted.where(F.col("matched_windows") >= cover * F.col("item_windows"))
    of_kind = F.min(F.struct("raw", "matched_windows", "item_windows", "other_values")).alias("best")
    return enough.groupBy("id", "text_hash", "item").agg(of_kind).select(
        F.col("id").alias(id_col), F.col("item").alias(item_col), "best.matched_windows", "best.item_windows",
        "best.other_values", "text_hash",
    )


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of `docs` with all their columns that hold no item of `benchmark`."""
    held = contaminated(docs, benchmark, id_col, text_col, **options).select("text_hash").distinct()
    held = broadcast_if_small(Landing(docs.sparkSession, "held").land(held, "held"))
    return docs.join(held, F.xxhash64(docs[text_col]) == held["text_hash"], "left_anti")
