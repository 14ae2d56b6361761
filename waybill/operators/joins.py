"""Lookup join that keeps the first match."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .slices import spread_lookup


def first_per_key(lookup: DataFrame, keys: list[str], bring: list[str], order: str) -> DataFrame:
    """One row per key: the values of the row that comes first by `order`."""
    values = [F.min_by(c, order).alias(c) for c in bring]
    return lookup.groupBy(*keys).agg(*values)


def first_match_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[tuple[str, str]],
    bring: list[str],
    order: str = "rec_no",
    null_safe: bool = True,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Rows that have a match in the lookup, with the first match's `bring` columns.

    `keys` pairs a column of `rows` with one of `lookup`. The lookup is cut to one row per key before the
    join, so rows never multiply. A brought column replaces a column of the same name. With `null_safe` two
    missing keys match, except where the whole lookup row is missing. Spark picks the join by the size of
    the reduced lookup, and splits a skewed key of `rows` at run time.

    With `hot`, rows sliced by the same keys join on keys and slice, so that the join's shuffle balances them
    and serves a later window over keys and slice too.
    """
    right_keys = [r for _, r in keys]
    if null_safe:
        some = F.coalesce(*[F.col(c).cast("string") for c in [*right_keys, *bring]])
        lookup = lookup.where(some.isNotNull())
    firsts = first_per_key(lookup, right_keys, bring, order)
    firsts = firsts.select(
        *[F.col(r).alias(f"_key{i}") for i, r in enumerate(right_keys)],
        *[F.col(c).alias(f"_new_{c}") for c in bring],
    )
    rows = rows.drop(*bring)
    match = F.lit(True)
    if hot is not None:
        # Slices go by a hash of the keys, which has to see the same types on both sides.
        firsts = firsts.withColumns({f"_key{i}": F.col(f"_key{i}").cast(rows.schema[a].dataType) for i, (a, _) in enumerate(keys)})
        firsts = spread_lookup(firsts, [f"_key{i}" for i in range(len(keys))], hot).withColumnRenamed("_slice", "_part")
        match = rows["_slice"] == firsts["_part"]
    for i, (left, _) in enumerate(keys):
        key = F.col(f"_key{i}")
        match = match & (rows[left].eqNullSafe(key) if null_safe else rows[left] == key)
    return rows.join(firsts, match).select(*[rows[c] for c in rows.columns], *[F.col(f"_new_{c}").alias(c) for c in bring])
