"""Audit findings as a table, and as one text report per archive."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import texts
from ..operators.findings import SECTIONS, concat_frames
from ..operators.slices import hot_groups, position_of, with_rank
from ..plans.audit import AuditOptions
from ..sources.archives import landing_folder
from .documents import write_documents
from .scripts import file_safe

# Date forms of the report's head and file name.
HEAD_TIME, NAME_TIME, HEAD_DATE = "%d/%m/%Y %H:%M", "%d%m%Y%H%M", "%d/%m/%Y"

RULES = (
    "same_name", "same_name_and_code", "same_code", "no_administration", "no_coordinates", "consecutive_stop",
    "missing_table",
)
BY_RECORD = ("no_administration", "no_coordinates")  # listed in the order of the stops
LINES_PER_PART = 1_000_000


def write_findings(findings: DataFrame, path: str, fmt: str = "parquet", by: tuple[str, ...] = ("section",)) -> None:
    """Findings as a partitioned table; `by=("archive_id", "section")` suits a modest number of archives."""
    findings.write.mode("overwrite").partitionBy(*by).format(fmt).save(path)


def _place(values: tuple, column: str):
    return F.coalesce(*[F.when(F.col(column) == v, F.lit(i)) for i, v in enumerate(values)], F.lit(len(values)))


def parameter_text(options: AuditOptions, when: dt.datetime) -> list[str]:
    """Head lines before and after the one that names the company."""
    yes_no = {True: texts.YES, False: texts.NO}
    statuses = texts.ONLY_ACTIVE if options.only_active else texts.ALL_STATUSES
    before = f"{when.strftime(HEAD_TIME)}\n{texts.PARAMETERS_HEAD}\n\n"
    after = [
        texts.CHECK_COORDINATES.format(yes_no[options.check_coords]),
        texts.CHECK_ADMINISTRATION.format(yes_no[options.check_admin]),
        texts.CHECK_FOREIGN.format(yes_no[options.include_foreign]),
        texts.STATUS_AND_DATE.format(statuses, options.ref_date.strftime(HEAD_DATE)),
    ]
    return [before, "".join(f"\t{line}\n" for line in after)]


def report_lines(
    findings: DataFrame, summary: DataFrame, manifest: DataFrame, options: AuditOptions, when: dt.datetime,
    lines_per_part: int = LINES_PER_PART,
) -> DataFrame:
    """Report rows in the shape of the document writer: head, then per section its count, findings and total.

    Findings come by carrier, number, variant, time of edit where that is the order, validity and sequence number;
    repeats by their key, and all by record in the end. In that order every row has its place, and each
    `lines_per_part` of them are a part: put together, the parts of a report of any size are the report. No task takes a
    whole report: places are counted by slices.
    """
    columns = ["archive_id", "section_no", "step", "rule_no", "sort", "text"]

    def sort_key(**values):
        parts = {"a": "int", "b": "int", "c": "int", "t": "timestamp_ntz", "d": "date", "e": "int", "f": "string", "g": "long", "h": "string"}
        return F.struct(*[values.get(n, F.lit(None)).cast(t).alias(n) for n, t in parts.items()])

    col = F.col
    body = findings.select(
        "archive_id", _place(SECTIONS, "section").alias("section_no"), F.lit(1).alias("step"),
        _place(RULES, "rule").alias("rule_no"),
        sort_key(a=col("carrier"), b=col("number"), c=col("variant"), t=col("edited"), d=col("valid_from"), e=col("seq"),
                 f=F.when(~col("rule").isin(*BY_RECORD), col("key")), g=col("rec_no"), h=col("message")).alias("sort"),
        F.expr(texts.worded("\n\t{}\n", "message")).alias("text"),
    )
    # Names and names with codes are one pass over the stops and share a place.
    body = body.withColumn("rule_no", F.greatest(F.col("rule_no"), F.lit(1)))
    wording = F.lit("")
    for section, text in texts.SECTION_HEADS.items():
        wording = F.when(col("section") == section, F.expr(texts.worded(f"\n\n{text}\n", "checked"))).otherwise(wording)
    unchecked = F.when(col("clean").isNull() & (col("errors") == 0), f"\n\t{texts.NOT_CHECKED}\n")
    total = unchecked.when(col("clean"), f"\n\t{texts.NO_ERRORS}\n").otherwise(
        F.expr(texts.worded(f"\n\n\t{texts.ERRORS_FOUND}\n", "errors"))
    )
    edges = F.explode(F.array(F.struct(F.lit(0).alias("step"), wording.alias("text")), F.struct(F.lit(2).alias("step"), total.alias("text"))))
    frame = summary.select("archive_id", _place(SECTIONS, "section").alias("section_no"), edges.alias("e")).select(
        "archive_id", "section_no", "e.step", F.lit(0).alias("rule_no"), sort_key().alias("sort"), "e.text",
    )
    before, after = parameter_text(options, when)
    company = F.expr(texts.worded(f"\t{texts.COMPANY}\n", "company"))
    head = manifest.select(
        "archive_id", F.lit(-1).alias("section_no"), F.lit(0).alias("step"), F.lit(0).alias("rule_no"), sort_key().alias("sort"),
        F.concat(F.lit(before), company, F.lit(after)).alias("text"),
    )
    lines = concat_frames([d.select(*columns) for d in (head, frame, body)])
    folder = landing_folder(lines.sparkSession)
    if folder is not None:  # the findings are worked out once, and it is known how many there are
        lines.write.parquet(f"{folder}/lines")
        lines = lines.sparkSession.read.schema(lines.schema).parquet(f"{folder}/lines")
    order = ["section_no", "step", "rule_no", "sort"]
    spot = position_of(*[col(c) for c in order])
    hot = hot_groups(lines, ["archive_id"], spot, options.skew)
    placed = with_rank(lines, ["archive_id"], order, "place", spot, hot)
    archive = F.regexp_replace("archive_id", r"(?i)\.zip$", "")
    name = F.concat_ws("_", file_safe(F.coalesce("company", F.lit(""))), file_safe(archive), F.lit(when.strftime(NAME_TIME)))
    placed = placed.join(manifest.select("archive_id", "company"), "archive_id", "left")
    part = F.floor((col("place") - 1) / lines_per_part)
    return placed.select(F.concat(name, F.lit(".txt")).alias("doc"), part.alias("part"), "place", "text")


def write_report(
    findings: DataFrame, summary: DataFrame, manifest: DataFrame, path: str,
    options: AuditOptions = AuditOptions(), when: dt.datetime | None = None, lines_per_part: int = LINES_PER_PART,
) -> None:
    """Save `{company}_{archive}_{ddMMyyyyHHmm}.txt` for every archive."""
    lines = report_lines(findings, summary, manifest, options, when or dt.datetime.now(), lines_per_part)
    write_documents(lines, path, ["place"])
