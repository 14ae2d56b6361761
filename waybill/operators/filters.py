"""Row filters of the audits and imports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import date_of, is_blank, is_model, text_of, to_version, trimmed, years_ago


def check_ref_date(ref_date: dt.date | None, today: dt.date) -> dt.date:
    """The reference date has to be set and to lie before today."""
    if ref_date is None:
        raise ValueError("set the reference date")
    if ref_date >= today:
        raise ValueError("the reference date must lie before today")
    return ref_date


def filter_active(df: DataFrame, col: str, on: bool = True, value: str = "2") -> DataFrame:
    """Rows whose status text equals `value`; every row when switched off."""
    return df.where(text_of(df, col) == value) if on else df


def filter_carrier(
    df: DataFrame, manifest: DataFrame | None, include_foreign: bool = True, col: str = "NRF"
) -> DataFrame:
    """Rows of the archive's own company, compared as text; every row when foreign ones count too."""
    if include_foreign:
        return df
    own = manifest.select("archive_id", F.col("company").alias("_company"))
    return df.join(own, "archive_id").where(text_of(df, col) == F.col("_company")).drop("_company")


def is_valid_after(end: Column, ref_date: dt.date | dt.datetime) -> Column:
    """Open-ended, or ending strictly after the reference date."""
    return end.isNull() | (end > F.lit(ref_date))


def filter_valid(df: DataFrame, col: str, ref_date: dt.date | dt.datetime) -> DataFrame:
    return df.where(is_valid_after(date_of(df, col), ref_date))


def filter_recent(
    df: DataFrame, col: str, today: dt.date | None = None, years: int = 1, since: Column | None = None
) -> DataFrame:
    """Rows dated no earlier than `since` (a year before today by default).

    A missing date drops the row, a date that cannot be read keeps it.
    """
    since = years_ago(today, years) if since is None else since
    day = date_of(df, col)
    return df.where(F.col(col).isNotNull() & (day.isNull() | (day >= since)))


def drop_blank(df: DataFrame, col: str, keep_null: bool = False) -> DataFrame:
    """Rows with text in `col`; nulls pass only when asked for."""
    filled = trimmed(F.col(col)) != ""
    return df.where(filled | F.col(col).isNull() if keep_null else filled)


def missing_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows in which any of the columns is blank."""
    test = F.lit(False)
    for name in cols:
        test = test | is_blank(F.col(name))
    return df.where(test)


def version_rows(df: DataFrame, model: str, min_version: float, model_col: str, version_col: str) -> DataFrame:
    """Devices of a model with no version, or one below the minimum, and which of both it is (`rule`)."""
    version = trimmed(F.col(version_col))
    lacking = version.isNull() | (version == "")
    rule = F.when(lacking, "version_missing").when(to_version(version) < min_version, "version_too_old")
    return df.where(is_model(trimmed(F.col(model_col)), model)).withColumn("rule", rule).where("rule is not null")


def version_flag(findings: DataFrame, keys: tuple[str, ...] = ("archive_id",)) -> DataFrame:
    """Whether any device is too old; a missing version alone does not raise the flag."""
    flag = F.bool_or(F.col("rule") == "version_too_old").alias("any_too_old")
    return findings.groupBy(*keys).agg(flag)
