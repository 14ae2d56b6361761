"""Timetable audit: stops, lines and courses of one or many archives."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import texts
from ..functions.scalars import (
    UNREAD,
    course_status,
    int_of,
    int_or,
    is_blank,
    is_text,
    line_status,
    text_of,
    to_date_or_min,
    to_int,
    to_ts_or_min,
    upper_key,
)
from ..operators.duplicates import drop_same_name_and_code, duplicate_findings, with_runs
from ..operators.filters import check_ref_date, filter_active, filter_carrier, filter_valid, missing_rows
from ..operators.findings import as_findings, concat_frames, readable, rejected, section_counts, summarise, unread_cells
from ..operators.joins import first_match_join
from ..operators.sequences import consecutive_repeats
from ..operators.slices import SkewRule, hot_groups, position_of, time_position, with_slice
from ..sources.archives import landing_folder, scan_archives
from .specs import AUDIT_TABLES


@dataclass(frozen=True)
class AuditOptions:
    ref_date: dt.date = dt.date(2018, 1, 1)
    only_active: bool = True
    include_foreign: bool = True
    check_admin: bool = True
    check_coords: bool = False
    duplicate_mode: str = "member"
    blank_is_key: bool = False
    course_order: str = "validity"
    skew: SkewRule = field(default_factory=SkewRule)


@dataclass(frozen=True)
class AuditResult:
    findings: DataFrame
    checked: DataFrame
    rejects: DataFrame


def audit_stops(stops: DataFrame, options: AuditOptions = AuditOptions()) -> AuditResult:
    """Repeated names and codes, missing administration and coordinates."""
    fields = ["NAZWA", "KOD2", "SYM", "X_KRAJ", "Y_KRAJ"]
    unread = [UNREAD] if UNREAD in stops.columns else []
    stops = stops.select("archive_id", "rec_no", *[text_of(stops, n).alias(n) for n in fields], *unread)
    named = stops.where("NAZWA is not null").withColumn("name_key", upper_key(F.col("NAZWA")))
    by_name = ["archive_id", "name_key"]
    mode = options.duplicate_mode
    marked = with_runs(named, by_name, "NAZWA", "KOD2", skew=options.skew) if mode != "group" else None
    names = duplicate_findings(
        named if marked is None else marked, by_name, "NAZWA", "KOD2", mode=mode, skew=options.skew, marked=marked is not None
    )
    both, name_only = [texts.worded(w, "listed") for w in (texts.SAME_NAME_AND_CODE, texts.SAME_NAME)]
    shared = {"rec_no": "rec_no", "members": "k", "errors": "errors", "code": "KOD2", "name": "NAZWA"}
    found = [
        as_findings(
            names, "'stops'", rule="if(same_code, 'same_name_and_code', 'same_name')", key="name_key",
            message=f"if(same_code, {both}, {name_only})", **shared,
        )
    ]
    if marked is None:
        kept = drop_same_name_and_code(named, by_name, "NAZWA", "KOD2")
    else:
        kept = marked.where("members = 1 or not same_code").select(named.columns)
    coded = kept.where("KOD2 is not null") if options.blank_is_key else kept.where(~is_blank(F.col("KOD2")))
    codes = duplicate_findings(coded, ["archive_id", "KOD2"], "NAZWA", "KOD2", mode=mode, skew=options.skew)
    message = texts.worded(texts.SAME_CODE, "listed")
    found.append(as_findings(codes, "'stops'", rule="'same_code'", key="KOD2", message=message, **shared))
    if options.check_admin:
        found.append(missing_findings(readable(kept, ["SYM"]), ["SYM"], "no_administration", texts.NO_ADMINISTRATION))
    if options.check_coords:
        placed = readable(kept, ["X_KRAJ", "Y_KRAJ"])
        found.append(missing_findings(placed, ["X_KRAJ", "Y_KRAJ"], "no_coordinates", texts.NO_COORDINATES))
    rejects = rejected(readable(stops, ["NAZWA"]), "przystanki", {"NAZWA": "NAZWA is null"})
    rejects = concat_frames([rejects, unread_cells(stops, "przystanki", fields)])
    return AuditResult(concat_frames(found), section_counts(stops, "stops"), rejects)


def missing_findings(stops: DataFrame, cols: list[str], rule: str, wording: str) -> DataFrame:
    return as_findings(
        missing_rows(stops, cols), "'stops'", rule=f"'{rule}'", rec_no="rec_no", key="KOD2", code="KOD2", name="NAZWA",
        message=texts.worded(wording, "NAZWA", "KOD2"),
    )


@dataclass(frozen=True)
class _Route:
    """Names that differ between line routes and course routes."""

    section: str
    table: str
    owner: str
    status: str
    valid_from: str
    valid_to: str
    keys: tuple[tuple[str, str], ...]
    label: object
    wording: str


LINES = _Route(
    "lines", "trasylinii", "linie", "STATLINII", "WAZNAOD", "WAZNADO",
    (("NRF", "NRF"), ("NRLINII", "NRLINII"), ("WARLINII", "WARLINII")), line_status, texts.LINE_REPEAT,
)
COURSES = _Route(
    "courses", "trasykursow", "kursy", "STATKURSU", "WAZNYOD", "WAZNYDO",
    (("NRFK", "NRF"), ("NRKURSU", "NRKURSU"), ("WARIANT", "WARIANT")), course_status, texts.COURSE_REPEAT,
)


def active_rows(table: DataFrame, manifest: DataFrame | None, route: _Route, options: AuditOptions) -> DataFrame:
    """Lines or courses that pass the status, carrier and validity filters."""
    rows = filter_active(table, route.status, options.only_active)
    rows = filter_carrier(rows, manifest, options.include_foreign)
    return filter_valid(rows, route.valid_to, options.ref_date)


def _match_key(df: DataFrame, name: str, other: DataFrame, other_name: str) -> Column:
    """Key as compared: trimmed text, or the values themselves where both sides are numbers of one scale or dates."""
    kinds = df.schema[name].dataType, other.schema[other_name].dataType
    scales = [getattr(k, "scale", 0) if isinstance(k, T.DecimalType | T.IntegralType) else k for k in kinds]
    same = scales[0] == scales[1] and not is_text(df, name)
    return F.col(name) if same else text_of(df, name)


def matched_routes(routes: DataFrame, active: DataFrame, route: _Route) -> DataFrame:
    """Route rows of active lines or courses, every column kept, with the status text of the first match."""
    status = text_of(active, route.status)
    pairs = [*route.keys, (route.valid_from, route.valid_from)]
    rows = routes.select("*", *[_match_key(routes, a, active, b).alias(f"k_{i}") for i, (a, b) in enumerate(pairs)])
    some = F.coalesce(*[text_of(active, c) for c in [*[b for _, b in pairs], route.status]])
    lookup = active.where(some.isNotNull()).select(
        "archive_id", "rec_no", *[_match_key(active, b, routes, a).alias(f"k_{i}") for i, (a, b) in enumerate(pairs)],
        status.alias(route.status),
    )
    keys = [("archive_id", "archive_id"), *[(f"k_{i}", f"k_{i}") for i in range(len(pairs))]]
    return first_match_join(rows, lookup, keys, [route.status]).drop(*[f"k_{i}" for i in range(len(pairs))])


def _keys_are_numbers(routes: DataFrame, active: DataFrame, route: _Route) -> bool:
    """Whether all keys are whole numbers and dates, so that equal values and equal texts are the same thing."""
    kinds = [side.schema[n].dataType for pair in route.keys for side, n in zip((routes, active), pair)]
    dates = [side.schema[route.valid_from].dataType for side in (routes, active)]
    return all(isinstance(k, T.IntegralType | T.DecimalType) and getattr(k, "scale", 0) == 0 for k in kinds) and all(
        isinstance(k, T.DateType) for k in dates
    )


def _audit_routes(table, routes, manifest, route: _Route, options: AuditOptions) -> AuditResult:
    fields = [*[b for _, b in route.keys], route.status, route.valid_from, route.valid_to]
    unread = [unread_cells(table, route.owner, fields)]
    active = active_rows(readable(table, fields), manifest, route, options)
    carrier, number, variant = [a for a, _ in route.keys]
    is_course = route is COURSES
    by_edit = is_course and options.course_order == "edit_ts"
    needed = ["archive_id", "rec_no", carrier, number, variant, route.valid_from, "NRPRZYST", "KOD2", "NAZPRZYST"]
    stamps = ["DATAOP", "GODZOP"] if by_edit else []
    unread.append(unread_cells(routes, route.table, [*needed, *stamps]))
    # What can't be read is rejected, and its row is not examined.
    routes = readable(routes, [*needed[2:], *stamps]).select(*needed, *stamps)

    def typed(df: DataFrame) -> DataFrame:
        code = int_or(df, "KOD2", -1) if is_course else int_of(df, "KOD2")
        stamp = to_ts_or_min(df, *stamps) if by_edit else F.lit(None).cast("timestamp_ntz")
        return df.select(
            "*",
            int_of(df, carrier).alias("carrier"),
            int_of(df, number).alias("number"),
            int_of(df, variant).alias("variant"),
            to_date_or_min(df, route.valid_from).alias("valid_from"),
            int_of(df, "NRPRZYST").alias("seq"),
            code.alias("code"),
            F.coalesce(text_of(df, "NAZPRZYST"), F.lit("")).alias("name"),
            stamp.alias("edited"),
        )

    matched = typed(matched_routes(routes, active, route)).withColumn("status_code", to_int(F.col(route.status)))
    parsed = {
        carrier: "carrier", number: "number", variant: "variant", "NRPRZYST": "seq", "KOD2": "code",
        route.status: "status_code",
    }
    rejects = concat_frames([rejected(matched, route.table, {raw: f"{p} is null" for raw, p in parsed.items()}), *unread])
    keys, same = ["archive_id", "carrier", "number", "variant"], []
    if by_edit:
        order, same = ["edited", "seq", "rec_no"], ["valid_from"]
        spot = position_of(time_position(F.col("edited")), F.col("seq"), F.col("rec_no"))
    else:
        keys, order = [*keys, "valid_from"], ["seq", "rec_no"]
        spot = position_of(F.col("seq"), F.col("rec_no"))
    typed_routes = typed(routes)
    hot = hot_groups(typed_routes, keys, spot, options.skew)
    sound = " and ".join(f"{p} is not null" for p in parsed.values())
    columns = ["archive_id", "rec_no", "carrier", "number", "variant", "valid_from", "seq", "code", "name", "edited"]
    # The findings need the status as a number only, which lets Spark reduce the lookup by hashing.
    status = int_of(active, route.status).alias("status_code")
    if _keys_are_numbers(routes, active, route):
        rows, match = typed_routes.select(columns), ["archive_id", "carrier", "number", "variant", "valid_from"]
        lookup = active.select(
            "archive_id", "rec_no", status, to_date_or_min(active, route.valid_from).alias("valid_from"),
            *[int_of(active, b).alias(n) for (_, b), n in zip(route.keys, match[1:4])],
        )
        # Join and ordered scan have the same keys, so one shuffle of the routes does for both.
        shared = hot if not by_edit else None
        if shared is not None:
            rows = with_slice(rows, keys, spot, hot)
        usable = first_match_join(rows, lookup, [(k, k) for k in match], ["status_code"], null_safe=False, hot=shared)
        usable = usable.where(sound)
    else:
        # Keys compared as text: findings and rejects come from one join.
        usable = matched.where(sound).select(*columns, "status_code")
    repeats = consecutive_repeats(
        usable, keys, order, "seq", "code", bring={"previous_name": "name"}, same=same, position=spot, hot=hot
    )
    day = "date_format(valid_from, 'yyyy-MM-dd')"
    found = as_findings(
        repeats.withColumn("label", route.label(F.col("status_code"))),
        f"'{route.section}'",
        rule="'consecutive_stop'",
        key=f"concat_ws('/', carrier, number, variant, {day})",
        status="label",
        message=texts.worded(route.wording, "carrier", "number", "label", "variant", day, "previous_name", "code"),
        **{n: n for n in ("rec_no", "carrier", "number", "variant", "valid_from", "seq", "code", "name")},
        **({"edited": "edited"} if by_edit else {}),
    )
    return AuditResult(found, section_counts(active, route.section), rejects)


def audit_lines(
    lines: DataFrame, routes: DataFrame, manifest: DataFrame | None = None, options: AuditOptions = AuditOptions()
) -> AuditResult:
    """The same stop twice in a row within a line variant."""
    return _audit_routes(lines, routes, manifest, LINES, options)


def audit_courses(
    courses: DataFrame, routes: DataFrame, manifest: DataFrame | None = None, options: AuditOptions = AuditOptions()
) -> AuditResult:
    """The same stop twice in a row within a course; missing codes count as one code."""
    return _audit_routes(courses, routes, manifest, COURSES, options)


def audit_tables(
    tables: dict[str, DataFrame], manifest: DataFrame | None = None, options: AuditOptions = AuditOptions()
) -> AuditResult:
    """All three audits over tables read or landed before; absent tables are left out."""
    results = []
    if "przystanki" in tables:
        results.append(audit_stops(tables["przystanki"], options))
    if {"linie", "trasylinii"} <= tables.keys():
        results.append(audit_lines(tables["linie"], tables["trasylinii"], manifest, options))
    if {"kursy", "trasykursow"} <= tables.keys():
        results.append(audit_courses(tables["kursy"], tables["trasykursow"], manifest, options))
    if not results:
        raise ValueError("none of the audited tables is present")
    return AuditResult(*[concat_frames([getattr(r, n) for r in results]) for n in ("findings", "checked", "rejects")])


def missing_tables(archives: DataFrame, members: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """A finding for every archive that lacks a table; `wanted` maps table -> section."""
    pairs = F.explode(F.array(*[F.struct(F.lit(t).alias("table"), F.lit(s).alias("section")) for t, s in wanted.items()]))
    every = archives.select("archive_id", pairs.alias("p")).select("archive_id", "p.*")
    lacking = every.join(members.select("archive_id", "table"), ["archive_id", "table"], "left_anti")
    return as_findings(
        lacking, "section", rule="'missing_table'", key="table", errors="0", message=texts.worded(texts.NO_TABLE, "table")
    )


def archive_rejects(members: DataFrame, manifest: DataFrame, faults: DataFrame) -> list[DataFrame]:
    """Files that are no archives, archives without company, and tables that are unreadable or cut short."""
    nothing = F.lit(None).cast("long").alias("rec_no")
    broken = members.where("error is not null").select(
        "archive_id", F.lit(None).cast("string").alias("table"), nothing, F.lit("archive").alias("column"), F.col("error").alias("value")
    )
    nameless = manifest.where("company is null").select(
        "archive_id", F.lit("archiwuminfo").alias("table"), nothing, F.lit("company").alias("column"), F.col("company_line").alias("value")
    )
    damaged = faults.select("archive_id", "table", nothing, F.lit("table").alias("column"), F.col("fault").alias("value"))
    return [broken, nameless, damaged]


def audit(
    spark: SparkSession,
    path: str,
    options: AuditOptions = AuditOptions(),
    today: dt.date | None = None,
    landing: str | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Audit every archive below `path`: findings, summary per archive and section, rejected values.

    The tables are first written as Parquet, so that archives are unpacked once: to `landing`, or to a new folder
    below spark.checkpoint.dir. On a cluster that sets neither, every pass reads the archives again.
    """
    check_ref_date(options.ref_date, today or dt.date.today())
    columns = {t: c for t, (c, _) in AUDIT_TABLES.items()}
    found = scan_archives(spark, path, columns, landing or landing_folder(spark))
    result = audit_tables(found.tables, found.manifest, options)
    lacking = missing_tables(found.directory, found.members, {t: s for t, (_, s) in AUDIT_TABLES.items()})
    findings = concat_frames([result.findings, lacking])
    rejects = concat_frames([result.rejects, *archive_rejects(found.members, found.manifest, found.faults)])
    return findings, summarise(result.checked, result.findings, found.directory), rejects
