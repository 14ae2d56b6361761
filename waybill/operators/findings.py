"""The common shape of findings, summaries and rejected values."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import UNREAD, unread_text

SECTIONS = ("stops", "lines", "courses", "machines")

FINDING_TYPES = {
    "archive_id": "string",
    "section": "string",
    "rule": "string",
    "rec_no": "long",
    "key": "string",
    "members": "long",
    "errors": "long",
    "carrier": "int",
    "number": "int",
    "variant": "int",
    "valid_from": "date",
    "seq": "int",
    "code": "string",
    "name": "string",
    "status": "string",
    "edited": "timestamp_ntz",
    "message": "string",
}

REJECT_COLUMNS = ("archive_id", "table", "rec_no", "column", "value")


def as_findings(df: DataFrame, section: str, **columns: str) -> DataFrame:
    """Rows as findings: given columns by their SQL expressions, the rest of the shape null, one error per row."""
    columns = {"archive_id": "archive_id", "section": section, "errors": "1", **columns}
    return df.selectExpr(*[f"cast({columns.get(n, 'null')} as {t}) as {n}" for n, t in FINDING_TYPES.items()])


def concat_frames(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def rejected(df: DataFrame, table: str, tests: dict[str, str]) -> DataFrame:
    """One row per unusable value: `tests` maps a column to the SQL test that finds it bad."""
    bad = [f"if({test}, struct('{n}' as column, cast({n} as string) as value), null)" for n, test in tests.items()]
    found = df.selectExpr("archive_id", f"'{table}' as table", "rec_no", f"explode(array_compact(array({', '.join(bad)}))) as b")
    return found.select("archive_id", "table", "rec_no", "b.column", "b.value")


def unread_cells(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """Rejects for the cells of the given columns that are not what their field says; none where the rows don't tell."""
    if UNREAD not in df.columns:
        return df.sparkSession.createDataFrame([], "archive_id string, table string, rec_no long, column string, value string")
    rows = df.where(F.size(UNREAD) > 0).select("archive_id", "rec_no", F.explode(UNREAD).alias("column", "value"))
    return rows.where(F.col("column").isin(columns)).select("archive_id", F.lit(table).alias("table"), "rec_no", "column", "value")


def readable(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows without unreadable cells in the given columns."""
    if UNREAD not in df.columns:
        return df
    return df.where(F.coalesce(*[unread_text(df, n) for n in columns]).isNull())


def section_counts(df: DataFrame, section: str) -> DataFrame:
    return df.groupBy("archive_id").agg(F.count(F.lit(1)).alias("checked")).withColumn("section", F.lit(section))


def summarise(checked: DataFrame, findings: DataFrame, archives: DataFrame | None = None) -> DataFrame:
    """Rows checked and errors found per archive and section, and whether the section is clean.

    A section of which no row was checked is neither clean nor not: `clean` is null. With `archives` given, sections
    without any row are listed too.
    """
    if archives is not None:
        names = F.explode(F.array(*[F.lit(s) for s in SECTIONS[:3]])).alias("section")
        every = archives.select("archive_id", names)
        checked = every.join(checked, ["archive_id", "section"], "left")
    errors = findings.groupBy("archive_id", "section").agg(F.sum("errors").alias("errors"))
    joined = checked.join(errors, ["archive_id", "section"], "left")
    total = F.coalesce("errors", F.lit(0).cast("long"))
    return joined.select(
        "archive_id",
        "section",
        F.coalesce("checked", F.lit(0).cast("long")).alias("checked"),
        total.alias("errors"),
        F.when(F.col("checked") > 0, total == 0).alias("clean"),
    )
