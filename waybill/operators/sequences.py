"""Neighbours in ordered stop sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .slices import with_previous


def is_new_group(seq: Column, previous_seq: Column, *same: tuple[Column, Column]) -> Column:
    """Start of a sequence: no row before, sequence number not rising, or a changed (value, previous) pair."""
    start = previous_seq.isNull() | (seq <= previous_seq)
    for value, before in same:
        start = start | ~value.eqNullSafe(before)
    return start


def consecutive_repeats(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    seq: str,
    code: str,
    bring: dict[str, str] | None = None,
    same: list[str] | None = None,
    position: Column | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Rows whose code equals that of the row before them in the same sequence.

    A sequence lies within one group of `keys`, sorted by `order`; it ends where `seq` does not rise or a
    column of `same` changes. `bring` maps a new column to the previous row's column.
    """
    bring, same = bring or {}, same or []
    previous = {"_prev_seq": seq, "_prev_code": code, **bring, **{f"_prev_{c}": c for c in same}}
    paired = with_previous(rows, keys, order, previous, position, hot)
    changed = [(F.col(c), F.col(f"_prev_{c}")) for c in same]
    start = is_new_group(F.col(seq), F.col("_prev_seq"), *changed)
    repeat = ~start & F.col(code).eqNullSafe(F.col("_prev_code"))
    return paired.where(repeat).select(*[c for c in rows.columns if c not in ("_slice", "_hot")], *bring)


def sequence_groups(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    seq: str,
    same: list[str] | None = None,
    position: Column | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Rows and number of sequences in every group of `keys`."""
    same = same or []
    previous = {"_prev_seq": seq, **{f"_prev_{c}": c for c in same}}
    paired = with_previous(rows, keys, order, previous, position, hot)
    start = is_new_group(F.col(seq), F.col("_prev_seq"), *[(F.col(c), F.col(f"_prev_{c}")) for c in same])
    return paired.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.when(start, 1).otherwise(0)).alias("groups")
    )
