"""Mixing sources to target weights by systematic sampling.

Every document of a source is expected the same number of times, its source's target over its source's size. With
the documents of a source in a fixed order, these expectations are summed up from document to document and one offset
between 0 and 1 is added; a document is taken once for each whole number its step crosses. The order is by size, so
that large and small documents are taken in the same proportion and the words taken stay near the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import Landing, broadcast_if_small

# The mix's weights, its share of all words, and how often a source may be used.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_TIMES = 2.0
SEED = "waybill-mix"


def word_count(text: Column) -> Column:
    """Runs of characters other than `\\x20\\x09-\\x0D`; null counts 0."""
    spaced = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\f\r", "     ")
    return F.size(F.filter(F.split(spaced, " "), lambda w: w != "")).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from (source, source_size): sources by code point, null last, weighted in turn.

    A target stops at MOST_TIMES the source's size, the excess goes to the others by weight. The targets below their
    stop are all the same multiple of their weights; sorted by stop over weight, the multiple is found from the sums of
    stops before and weights from each source on. The table has one row per source.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), turn + 1)
    rows = sizes.withColumn("weight", weight).withColumn("stop", MOST_TIMES * F.col("source_size"))
    by_stop = Window.orderBy(F.col("stop") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    whole = Window.partitionBy(F.lit(1))
    rows = rows.withColumn("before", F.coalesce(F.sum("stop").over(by_stop.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    rows = rows.withColumn("rest", F.sum("weight").over(by_stop.rowsBetween(0, Window.unboundedFollowing)))
    rows = rows.withColumn("multiple", (SHARE * F.sum("source_size").over(whole) - F.col("before")) / F.col("rest"))
    rows = rows.withColumn("multiple", F.max("multiple").over(whole))  # it rises while sources stop, and falls after
    target = F.least("stop", F.col("weight") * F.col("multiple"))
    return rows.select("source", "source_size", target.alias("target"))


def _rank(rows: DataFrame, landing: Landing) -> DataFrame:
    """Adds `rank`, the place among all rows of the source by (size, draw, id, tie), without a task for a whole source.

    Rows are sorted into ranges and numbered on; the first number and the count of each source in each range, summed up
    over earlier ranges, turn numbers into ranks.
    """
    order = [F.col("source").asc_nulls_last(), "size", "draw", F.col("id").asc_nulls_last(), "tie", "other_tie"]
    number = F.monotonically_increasing_id()  # the range in the upper bits, the place in it in the lower 33
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("number", number)
    ranged = landing.land(ranged.withColumn("range", F.shiftright("number", 33)), "ranges")
    counts = ranged.groupBy("range", "source").agg(F.count(F.lit(1)).alias("rows"), F.min("number").alias("first"))
    earlier = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("rows").over(earlier), F.lit(0)) + 1 - F.col("first")
    starts = counts.select("range", F.col("source").alias("of"), start.alias("start"))
    starts = broadcast_if_small(landing.land(starts, "starts")).alias("s")
    joined = ranged.alias("n").join(starts, (F.col("n.range") == F.col("s.range")) & F.col("source").eqNullSafe(F.col("of")))
    return joined.select("n.*", (F.col("start") + F.col("number")).alias("rank"))


def mixture(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: str = SEED,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id, size, source_size, target, copies, taken) for every row of `docs`, and the columns named in `keep`.

    The draw that orders documents of equal size and the offset of a source come from hashes of the id, the source and
    the seed, so reruns agree. Null texts have size 0; null is a source of its own, the last. Documents of size 0 are
    drawn like others, though they take no words; a source without words has target 0 and none of it is taken. Rows
    that agree in id, size and source come in the order of two hashes of their text and of the columns in `keep`, so it
    makes no difference how the table is partitioned. Empty tables give an empty result.
    """
    landing = Landing(docs.sparkSession, "mix")
    told = [text_col, *[c for c in keep if "map<" not in docs.schema[c].dataType.simpleString()]]  # maps have no hash
    draw = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    rows = docs.select(
        *[F.col(c).alias(f"kept_{c}") for c in keep], F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"), draw.alias("draw"),
        F.xxhash64(*told).alias("tie"), F.xxhash64(F.lit(seed), *told).alias("other_tie"),
    )
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed), F.coalesce("source", F.lit("")))), 1, 8), 16, 10).cast("double")
    targets = landing.land(targets.withColumn("offset", offset / 4294967296.0).withColumnRenamed("source", "of"), "targets")
    ranked = _rank(rows, landing).join(broadcast_if_small(targets), F.col("source").eqNullSafe(F.col("of")))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    upto = lambda rank: F.floor(each * rank + F.col("offset"))
    ranked = ranked.withColumn("copies", (upto(F.col("rank")) - upto(F.col("rank") - 1)).cast("long"))
    return ranked.select(
        F.col("id").alias(id_col), "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"),
        *[F.col(f"kept_{c}").alias(c) for c in keep],
    )


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The rows of `docs`, each as often as `mixture` takes it, with all their columns."""
    packed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col], docs[text_col], docs[source_col])
    taken = mixture(packed, id_col, text_col, source_col, keep=("row",))
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("row.*")
