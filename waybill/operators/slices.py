"""Ordered scans that stay balanced when one group holds a large part of the rows.

A window over a group runs in one task. For groups that hold more than `share` of all rows this module cuts
the group into slices of about that share along its sort order, runs the window per slice, and carries the last row,
or the running count, of each slice over to the next one. The cuts are values of the real order columns, compared one after
another, out of a sorted sample. The result is exact whatever the cuts are; only the balance depends on them.

Finding the large groups costs one pass over the key columns, ahead of the query. All groups above the share are cut, of which
there are at most 1/share, as there are slices over all groups: cuts and carried rows are small at any input size
and may be broadcast. Without large groups the query keeps its plain plan. Inputs below `min_bytes`, by Spark's
own estimate, skip all of it: no group of theirs is too large for one task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 64
SAMPLED = 32  # sampled rows for each slice
TRACKED = 1 << 18  # groups that the search for large ones keeps count of


@dataclass(frozen=True)
class SkewRule:
    share: float = 0.0001
    min_rows: int = 1_000_000
    min_bytes: int = 1 << 30


def position_of(*columns: Column) -> Column:
    """Sort position: the order columns as they are, compared one after another, nulls first."""
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(columns)])


def time_position(stamp: Column) -> Column:
    """Microseconds of a zone-free timestamp."""
    day = F.datediff(stamp, F.lit("1970-01-01").cast("date")).cast("long")
    seconds = day * 86400 + F.hour(stamp) * 3600 + F.minute(stamp) * 60
    return seconds * 1_000_000 + (F.extract(F.lit("SECOND"), stamp) * 1_000_000).cast("long")


def _estimated_bytes(df: DataFrame) -> float:
    try:
        return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except AttributeError:
        return float("inf")


def hot_groups(df: DataFrame, keys: list[str], position: Column, rule: SkewRule) -> DataFrame | None:
    """Cut points of the groups holding more than the rule's share of `df`; None when there are none.

    Runs at once, for inputs that are large enough: one pass over the keys, and one over the large groups'
    positions if there are any. What comes to the driver is at most 1/share groups, and about 1/share positions.
    """
    if _estimated_bytes(df) < rule.min_bytes:
        return None
    most = min(math.ceil(1 / rule.share), TRACKED // 4)
    tagged = df.select(F.xxhash64(*keys).alias("_tag"), position.alias("_pos"))
    found = tagged.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(_tag, {most}, {TRACKED})").alias("top")).first()
    rows_per_slice = max(found["n"] * rule.share, rule.min_rows, 1)
    large = [t["item"] for t in found["top"] if t["count"] > rows_per_slice]
    if not large:
        return None
    spark = df.sparkSession
    wanted = spark.createDataFrame(pa.table({"_tag": large}))
    scale = 1 << 53
    drawn = F.pmod(F.xxhash64("_pos", F.lit(1)), F.lit(scale)) < int(min(1.0, SAMPLED / rows_per_slice) * scale)
    sample = tagged.where(drawn).join(F.broadcast(wanted), "_tag").groupBy("_tag").agg(F.sort_array(F.collect_list("_pos")).alias("_all"))
    step = max(1, round(min(SAMPLED, rows_per_slice)))  # where all rows are drawn, the rows of a slice
    cuts = F.transform(F.sequence(F.lit(step), F.size("_all"), F.lit(step)), lambda i: F.get("_all", i - 1))
    cuts = sample.where(F.size("_all") > step).select("_tag", cuts.alias("_cuts"))
    return spark.createDataFrame(cuts.toArrow(), cuts.schema)


def with_slice(df: DataFrame, keys: list[str], position: Column, hot: DataFrame) -> DataFrame:
    """Add `_slice`: 0 for ordinary groups, the number of cuts below the position for hot ones (`_hot`)."""
    every = F.expr(f"filter(_cuts, (cut, i) -> i % {BLOCK} = {BLOCK - 1})")
    placed = df.withColumn("_tag", F.xxhash64(*keys)).withColumn("_pos", position)
    joined = placed.join(F.broadcast(hot.withColumn("_coarse", every)), "_tag", "left")

    def below(cuts: Column) -> Column:
        return F.size(F.filter(cuts, lambda cut: cut < F.col("_pos")))

    # The block of 64 cuts first, then the place within the block.
    joined = joined.withColumn("_block", F.when(F.col("_cuts").isNotNull(), below(F.col("_coarse"))))
    within = below(F.slice("_cuts", F.col("_block") * BLOCK + 1, F.lit(BLOCK - 1)))
    number = F.coalesce(F.col("_block") * BLOCK + within, F.lit(0))
    return (
        joined.withColumn("_slice", number)
        .withColumn("_hot", F.col("_cuts").isNotNull())
        .drop("_tag", "_pos", "_block", "_cuts", "_coarse")
    )


def spread_lookup(lookup: DataFrame, keys: list[str], hot: DataFrame) -> DataFrame:
    """Lookup side of a join on keys and `_slice`: a row of a hot key once for each slice, others for slice 0."""
    tagged = lookup.withColumn("_tag", F.xxhash64(*keys))
    marked = tagged.join(F.broadcast(hot.select("_tag", F.size("_cuts").alias("_last"))), "_tag", "left")
    slices = F.sequence(F.lit(0), F.coalesce("_last", F.lit(0)))
    return marked.withColumn("_slice", F.explode(slices)).drop("_tag", "_last")


def _cut(df: DataFrame, keys: list[str], position: Column, hot: DataFrame) -> tuple[DataFrame, list[str]]:
    """Sliced rows and their proper columns; rows that come with `_slice` are taken as they are."""
    if "_slice" in df.columns:
        return df, [c for c in df.columns if c not in ("_slice", "_hot")]
    # Rows already partitioned by the keys alone would satisfy the windows and keep a hot group in one task.
    return with_slice(df, keys, position, hot).repartition(*keys, "_slice"), df.columns


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    test = F.lit(True)
    for name in names:
        test = test & left[name].eqNullSafe(right[f"_c_{name}"])
    return test


def _join_carry(df: DataFrame, chain: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Attach a per-slice value; the chain has one row for each slice of a hot group, about 1/share in all."""
    names = [*keys, "_slice"]
    chain = chain.select(*[F.col(n).alias(f"_c_{n}") for n in names], value)
    return df.join(F.broadcast(chain), _same(df, chain, names), "left").drop(*[f"_c_{n}" for n in names])


def with_previous(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    previous: dict[str, str],
    position: Column | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add columns of the preceding row of the same group: `previous` maps new name -> column."""
    if hot is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        return df.select("*", *[F.lag(c).over(w).alias(n) for n, c in previous.items()])
    cut, columns = _cut(df, keys, position, hot)
    last = F.max_by(F.struct(*[F.col(c).alias(n) for n, c in previous.items()]), F.struct(*order))
    edges = cut.where("_hot").groupBy(*keys, "_slice").agg(last.alias("_last"))
    chain = edges.select(*keys, "_slice", F.lag("_last").over(Window.partitionBy(*keys).orderBy("_slice")).alias("_carry"))
    w = Window.partitionBy(*keys, "_slice").orderBy(*order)
    scanned = cut.select(
        "*",
        F.row_number().over(w).alias("_row"),
        *[F.lag(c).over(w).alias(f"_lag_{n}") for n, c in previous.items()],
    )
    joined = _join_carry(scanned, chain, keys, "_carry")
    first = F.col("_row") == 1
    return joined.select(
        *columns,
        *[F.when(first, F.col(f"_carry.{n}")).otherwise(F.col(f"_lag_{n}")).alias(n) for n in previous],
    )


def with_rank(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    name: str,
    position: Column | None = None,
    hot: DataFrame | None = None,
    also: dict | None = None,
) -> DataFrame:
    """Add the 1-based place of each row in its group, and `also` columns: name -> function of the window.

    The extra columns see one slice only, so they are for groups that the caller keeps whole (position null).
    """
    also = also or {}
    if hot is None:
        w = Window.partitionBy(*keys).orderBy(*order)
        extra = [make(w).alias(n) for n, make in also.items()]
        return df.select("*", F.row_number().over(w).cast("long").alias(name), *extra)
    cut, columns = _cut(df, keys, position, hot)
    counts = cut.where("_hot").groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    chain = counts.select(*keys, "_slice", F.sum("_n").over(before).alias("_before"))
    w = Window.partitionBy(*keys, "_slice").orderBy(*order)
    scanned = cut.select("*", F.row_number().over(w).alias("_row"), *[make(w).alias(n) for n, make in also.items()])
    joined = _join_carry(scanned, chain, keys, "_before")
    place = F.col("_row") + F.coalesce(F.col("_before"), F.lit(0).cast("long"))
    return joined.select(*columns, place.alias(name), *also)
