"""Rows that share a name or a code."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as Win
from pyspark.sql import functions as F

from .slices import SkewRule, hot_groups, position_of, with_rank, with_slice


def member_text(name: Column, code: Column) -> Column:
    blank = F.lit("")
    return F.concat(F.lit("["), F.coalesce(name, blank), F.lit("] ["), F.coalesce(code, blank), F.lit("]"))


def duplicate_groups(df: DataFrame, keys: list[str], rec: str = "rec_no") -> DataFrame:
    """One row per repeated key: `members`, `findings` (one less) and the first record number.

    Plain partial aggregation, so a key of any size costs one row per map task in the shuffle. Rows with a
    null in the last key are no candidates.
    """
    counted = df.where(F.col(keys[-1]).isNotNull()).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("members"), F.min(rec).alias("first_rec")
    )
    return counted.where("members > 1").withColumn("findings", F.col("members") - 1)


def _repeated(df: DataFrame, keys: list[str], rec: str) -> DataFrame:
    """Rows of repeated keys with the size of their group; few of them in sound data."""
    return df.join(duplicate_groups(df, keys, rec).select(*keys, "members", "first_rec"), keys)


def duplicate_runs(df: DataFrame, keys: list[str], name: str, code: str, rec: str = "rec_no") -> DataFrame:
    """One row per repeated key with its first two members, and whether their codes agree.

    The rank limit runs before the shuffle too, so a key of any size sends two rows per map task.
    """
    place = F.row_number().over(Win.partitionBy(*keys).orderBy(rec))
    pairs = (
        df.where(F.col(keys[-1]).isNotNull())
        .select(*keys, rec, F.col(name).alias("_name"), F.col(code).alias("_code"))
        .withColumn("_place", place)
        .where("_place <= 2")
    )
    runs = pairs.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_shown"),
        F.min_by("_name", "_place").alias("first_name"),
        F.min_by("_code", "_place").alias("first_code"),
        F.max_by("_name", "_place").alias("second_name"),
        F.max_by("_code", "_place").alias("second_code"),
    )
    same = F.col("first_code").eqNullSafe(F.col("second_code"))
    return runs.where("_shown = 2").drop("_shown").withColumn("same_code", same)


def drop_same_name_and_code(
    df: DataFrame, keys: list[str], name: str, code: str, rec: str = "rec_no", runs: DataFrame | None = None
) -> DataFrame:
    """Remove every run whose first two members agree in code as well."""
    runs = duplicate_runs(df, keys, name, code, rec) if runs is None else runs
    return df.join(runs.where("same_code").select(*keys), keys, "left_anti")


def with_runs(
    df: DataFrame, keys: list[str], name: str, code: str, rec: str = "rec_no", skew: SkewRule = SkewRule()
) -> DataFrame | None:
    """Rows with the size of their group (`members`), its first member and whether its first two codes agree.

    One shuffle and one sort serve the findings of a key and all that follows from them. None where a group is too large
    for one task; then each of them is worked out for itself.
    """
    if hot_groups(df.select(*keys, rec), keys, position_of(F.col(rec)), skew) is not None:
        return None
    whole = Win.partitionBy(*keys).orderBy(rec).rowsBetween(Win.unboundedPreceding, Win.unboundedFollowing)
    return df.select(
        "*",
        F.count(F.lit(1)).over(whole).alias("members"),
        F.first(member_text(F.col(name), F.col(code))).over(whole).alias("_first"),
        F.first(code).over(whole).eqNullSafe(F.nth_value(code, 2).over(whole)).alias("same_code"),
    )


def _with_carry(rows: DataFrame, keys: list[str], rec: str, spot: Column, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows with their slices, and for each slice but the first of a long run the texts of all slices before it."""
    cut = with_slice(rows, keys, spot, hot).repartition(*keys, "_slice")
    in_order = F.transform(F.sort_array(F.collect_list(F.struct(rec, "_text"))), lambda r: r["_text"])
    pieces = cut.where("_hot").groupBy(*keys, "_slice").agg(F.array_join(in_order, ", ").alias("_piece"))
    before = Win.partitionBy(*keys).orderBy("_slice").rowsBetween(Win.unboundedPreceding, -1)
    carry = pieces.select(
        *[F.col(k).alias(f"_of_{k}") for k in keys], F.col("_slice").alias("_of_part"), F.collect_list("_piece").over(before).alias("_pieces")
    )
    return cut, carry.where(F.size("_pieces") > 0).withColumn("_earlier", F.array_join("_pieces", ", ")).drop("_pieces")


def duplicate_findings(
    df: DataFrame,
    keys: list[str],
    name: str,
    code: str,
    rec: str = "rec_no",
    mode: str = "member",
    skew: SkewRule = SkewRule(),
    marked: bool = False,
) -> DataFrame:
    """Repeats of a key, the last of `keys`, in record order.

    mode `member`: n-1 rows for n members; row k has member k and the first member.
    mode `cumulative`: the same rows, `listed` naming members 1 to k. Its text grows with the square of a run's
    length, so `member` and `group` are the choices for very long runs. A task holds one slice of a long run, and the text
    of the slices before it.
    mode `group`: one row per key, `listed` naming the first two members.

    `marked` rows come from `with_runs` for the same key.

    Result: keys, `k`, the record number, `name`, `code`, `members`, `errors`, `same_code`, `listed`.
    """
    if mode == "group":
        runs = duplicate_groups(df, keys, rec).join(duplicate_runs(df, keys, name, code, rec), keys)
        pair = [member_text(F.col(f"{side}_name"), F.col(f"{side}_code")) for side in ("first", "second")]
        return runs.select(
            *keys,
            F.col("members").alias("k"),
            F.col("first_rec").alias(rec),
            *[F.col(f"first_{side}").alias(c) for side, c in (("name", name), ("code", code)) if c not in keys],
            "members",
            (F.col("members") - 1).alias("errors"),
            "same_code",
            F.concat(*pair[:1], F.lit(", "), *pair[1:]).alias("listed"),
        )
    if mode not in ("member", "cumulative"):
        raise ValueError(f"unknown mode {mode!r}")
    marks = ["members", "_first", "same_code"] if marked else []
    narrow = df.select(*dict.fromkeys([*keys, rec, name, code]), *marks).where(F.col(keys[-1]).isNotNull())
    narrow = narrow.withColumn("_text", member_text(F.col(name), F.col(code)))
    spot = position_of(F.col(rec))
    hot = None if marked else hot_groups(narrow, keys, spot, skew)
    upto = F.collect_list("_text")
    also = {}
    if mode == "cumulative":
        also["_upto"] = lambda w: upto.over(w.rowsBetween(Win.unboundedPreceding, Win.currentRow))
    carry = None
    if hot is None:
        # No group is large: its size and first members come from the same window as the places.
        rows = narrow if marked else with_runs(narrow, keys, name, code, rec, SkewRule(min_bytes=1 << 62))
        ranked = with_rank(rows.where("members > 1"), keys, [rec], "k", also=also)
    else:
        rows = _repeated(narrow, keys, rec)
        if mode == "cumulative":
            rows, carry = _with_carry(rows, keys, rec, spot, hot)
            also["_part"] = lambda w: F.max("_slice").over(w)
        ranked = with_rank(rows, keys, [rec], "k", spot, hot, also)
        runs = duplicate_runs(narrow, keys, name, code, rec)
        first = member_text(F.col("first_name"), F.col("first_code"))
        ranked = ranked.join(runs.select(*keys, first.alias("_first"), "same_code"), keys)
    listed = F.concat("_first", F.lit(", "), "_text")
    if carry is not None:
        same = [ranked[k].eqNullSafe(carry[f"_of_{k}"]) for k in keys]
        ranked = ranked.join(carry, reduce(and_, same, ranked["_part"] == carry["_of_part"]), "left")
        listed = F.concat_ws(", ", "_earlier", F.array_join("_upto", ", "))
    elif mode == "cumulative":
        listed = F.array_join("_upto", ", ")
    return ranked.where("k > 1").select(
        *keys, "k", rec, *dict.fromkeys(c for c in (name, code) if c not in keys), "members",
        F.lit(1).cast("long").alias("errors"), "same_code", listed.alias("listed"),
    )
