"""Start-data import: ticket machines, employees and memory cards as INSERT scripts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import texts
from ..functions.literals import insert_statement
from ..functions.scalars import default_status, is_model, text_of
from ..operators.filters import drop_blank, filter_recent, version_flag, version_rows
from ..operators.findings import as_findings, concat_frames, rejected, unread_cells
from ..sources.archives import landing_folder, scan_archives
from ..sources.dbf import DAY_FIRST
from .audit import archive_rejects, missing_tables
from .specs import CARDS, EMAR_MIN_VERSION, EMAR_MODEL, EMPLOYEES, MACHINES, SCRIPTS


@dataclass(frozen=True)
class ImportResult:
    scripts: DataFrame
    findings: DataFrame | None = None
    rejects: DataFrame | None = None


def _script(df: DataFrame, name: str, spec: list) -> DataFrame:
    stmt = insert_statement(df, SCRIPTS[name][1], spec)
    return df.select("archive_id", F.lit(name).alias("script"), "rec_no", stmt.alias("stmt"))


def current_machines(df: DataFrame, today: dt.date, keep_null_logo: bool = False) -> DataFrame:
    """Ticket machines with a logo number, settled within the last year."""
    return drop_blank(filter_recent(df, "DATAZORF", today), "LOGO", keep_null_logo)


def version_findings(
    df: DataFrame, model: str = EMAR_MODEL, min_version: float = EMAR_MIN_VERSION
) -> DataFrame:
    """Devices of the model that have no software version or one that is too old."""
    found = version_rows(df, model, min_version, "TYPBIL", "WERPSB")
    logo, version = "trim(LOGO)", "trim(WERPSB)"
    missing = texts.worded(texts.NO_VERSION, f"'{model}'", logo)
    old = texts.worded(texts.OLD_VERSION, f"'{model}'", logo, version)
    return as_findings(
        found, "'machines'", rule="rule", rec_no="rec_no", key=logo, code=version,
        message=f"if(rule = 'version_missing', {missing}, {old})",
    )


def version_rejects(df: DataFrame, model: str = EMAR_MODEL) -> DataFrame:
    """Versions of the model that are no numbers."""
    unreadable = "trim(WERPSB) <> '' and try_cast(trim(WERPSB) as float) is null"
    return rejected(df.where(is_model(text_of(df, "TYPBIL"), model)), "kasyfiskalne", {"WERPSB": unreadable})


def import_machines(df: DataFrame, today: dt.date, keep_null_logo: bool = False) -> ImportResult:
    kept = current_machines(df, today, keep_null_logo)
    return ImportResult(_script(kept, "KasyFiskalne", MACHINES), version_findings(kept), version_rejects(kept))


def import_employees(df: DataFrame) -> ImportResult:
    """Every employee, with statuses other than the known ones replaced."""
    fixed = df.withColumn("STATUS", default_status(text_of(df, "STATUS")))
    return ImportResult(_script(fixed, "Pracownicy", EMPLOYEES))


def import_cards(df: DataFrame) -> ImportResult:
    return ImportResult(_script(df, "KartyPamieci", CARDS))


def import_summary(scripts: DataFrame) -> DataFrame:
    """Statements per archive and script."""
    return scripts.groupBy("archive_id", "script").agg(F.count(F.lit(1)).alias("rows"))


def import_tables(tables: dict[str, DataFrame], today: dt.date, keep_null_logo: bool = False) -> ImportResult:
    """The scripts of all given tables, gathered under their names."""
    scripts, findings, rejects = [], None, None
    if "kasyfiskalne" in tables:
        machines = import_machines(tables["kasyfiskalne"], today, keep_null_logo)
        scripts, findings, rejects = [machines.scripts], machines.findings, machines.rejects
    if "pracownicy" in tables:
        scripts.append(import_employees(tables["pracownicy"]).scripts)
    if "kartypamieci" in tables:
        scripts.append(import_cards(tables["kartypamieci"]).scripts)
    if not scripts:
        raise ValueError("none of the imported tables is present")
    return ImportResult(concat_frames(scripts), findings, rejects)


def start_data(
    spark: SparkSession, path: str, today: dt.date | None = None, landing: str | None = None
) -> tuple[ImportResult, DataFrame]:
    """Scripts, findings and rejects of every archive below `path`, and the manifest; landing as in the audit.

    Findings are about devices and missing tables; rejects also name unreadable archives and tables and those without
    company. `import_summary` counts the scripts' rows, `version_flag` tells of devices that are too old.
    """
    specs = {"kasyfiskalne": MACHINES, "pracownicy": EMPLOYEES, "kartypamieci": CARDS}
    columns = {t: [n for n, _ in spec] for t, spec in specs.items()}
    found = scan_archives(spark, path, columns, landing or landing_folder(spark), dates=DAY_FIRST)
    result = import_tables(found.tables, today or dt.date.today())
    lacking = missing_tables(found.directory, found.members, dict.fromkeys(specs, "import"))
    findings = concat_frames([f for f in (result.findings, lacking) if f is not None])
    unread = [unread_cells(found.tables[t], t, names) for t, names in columns.items()]
    damaged = archive_rejects(found.members, found.manifest, found.faults)
    rejects = concat_frames([f for f in (result.rejects, *unread, *damaged) if f is not None])
    return ImportResult(result.scripts, findings, rejects), found.manifest


__all__ = [
    "ImportResult", "current_machines", "import_cards", "import_employees", "import_machines", "import_summary",
    "import_tables", "start_data", "version_findings", "version_flag", "version_rejects",
]
