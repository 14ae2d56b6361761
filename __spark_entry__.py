"""Queries over the driver's tables, and the SQL that gives the same rows.

Timetable and ticketing tables are not among the driver's, so each query maps some of those onto the columns an
operator names. The archive queries pack table rows into ZIP/DBF archives first and read them back.
"""

from __future__ import annotations

import datetime as dt
import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from driver_archives import pack_archives, record_of, scratch_folder, write_file  # noqa: E402
from waybill.functions.codepages import decode  # noqa: E402
from waybill.functions.literals import insert_statement, sql_date, sql_value  # noqa: E402
from waybill.functions.scalars import default_status, line_status, upper_key  # noqa: E402
from waybill.operators.duplicates import (  # noqa: E402
    drop_same_name_and_code,
    duplicate_findings,
    duplicate_groups,
)
from waybill.operators.filters import (  # noqa: E402
    drop_blank,
    filter_active,
    filter_carrier,
    filter_recent,
    filter_valid,
    missing_rows,
    version_flag,
    version_rows,
)
from waybill.operators.findings import concat_frames, section_counts, summarise  # noqa: E402
from waybill.operators.joins import first_match_join  # noqa: E402
from waybill.operators.sequences import consecutive_repeats, sequence_groups  # noqa: E402
from waybill.operators.slices import SkewRule, hot_groups, position_of, time_position, with_slice  # noqa: E402
from waybill.plans.audit import (  # noqa: E402
    LINES,
    AuditOptions,
    active_rows,
    audit,
    audit_courses,
    audit_lines,
    audit_stops,
    matched_routes,
)
from waybill.plans.imports import (  # noqa: E402
    import_cards,
    import_employees,
    import_machines,
    import_summary,
    import_tables,
    start_data,
)
from waybill.plans.specs import CARDS, EMPLOYEES, MACHINES  # noqa: E402
from waybill.sinks.reports import write_findings, write_report  # noqa: E402
from waybill.sinks.scripts import write_scripts  # noqa: E402
from waybill.sources.archives import list_members, read_manifest, read_table, read_template  # noqa: E402

SKEW = SkewRule()
TODAY = dt.date(2025, 1, 16)
AUDIT_DAY = dt.date(2026, 12, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- operators ---------------------------------------------------------------------------------------------


def _parts(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey", "p_name", "p_brand", F.col("p_size").alias("part_size"), upper_key(F.col("p_name")).alias("name_key")
    )


def duplicate_name_groups(spark, sf_dir):
    found = duplicate_groups(_parts(spark, sf_dir), ["part_size", "name_key"], "p_partkey")
    return found.select("name_key", "part_size", "members", "findings", "first_rec")


def duplicate_name_findings(spark, sf_dir):
    found = duplicate_findings(
        _parts(spark, sf_dir), ["part_size", "name_key"], "p_name", "p_brand", "p_partkey", "cumulative", SKEW
    )
    return found.select("name_key", "part_size", "k", "same_code", F.col("listed").alias("members"))


def duplicate_code_findings(spark, sf_dir):
    kept = drop_same_name_and_code(_parts(spark, sf_dir), ["part_size", "name_key"], "p_name", "p_brand", "p_partkey")
    found = duplicate_groups(kept, ["part_size", "p_brand"], "p_partkey")
    return found.select(F.col("p_brand").alias("code"), "part_size", "members", "findings")


def _documents(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("doc_id", "source", "lang")
    return documents.join(table(spark, sf_dir, "labels"), "doc_id", "left")


def missing_admin_findings(spark, sf_dir):
    return missing_rows(_documents(spark, sf_dir), ["quality"]).select("doc_id", "source")


def missing_coords_findings(spark, sf_dir):
    rows = _documents(spark, sf_dir).select(
        "doc_id", F.nullif("lang", F.lit("en")).alias("x"), F.nullif("toxic", F.lit(1)).alias("y")
    )
    return missing_rows(rows, ["x", "y"]).select("doc_id")


def active_lines(spark, sf_dir):
    archive = F.concat(F.lit("a"), F.col("o_custkey") % 7)
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", archive.alias("archive_id"),
        (F.col("o_custkey") % 2).cast("string").alias("NRF"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate")).alias("valid_to"),
    )
    manifest = spark.range(7).select(F.concat(F.lit("a"), "id").alias("archive_id"), F.lit("0").alias("company"))
    rows = filter_active(orders, "o_orderstatus", value="F")
    rows = filter_carrier(rows, manifest, include_foreign=False)
    return filter_valid(rows, "valid_to", dt.date(1998, 1, 1)).select("o_orderkey", "o_custkey")


def trip_first_match(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    lookup = orders.where("o_orderstatus <> 'P'").withColumnRenamed("o_orderstatus", "matched_status")
    keys = [("o_custkey", "o_custkey"), ("o_orderpriority", "o_orderpriority")]
    joined = first_match_join(orders.where("o_orderstatus = 'P'"), lookup, keys, ["matched_status"], "o_orderkey")
    return joined.select("o_orderkey", "matched_status")


LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]


def line_consecutive_stops(spark, sf_dir, skew=SKEW):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    valid = filter_valid(orders, "o_orderdate", dt.date(1996, 1, 1))
    key, spot = ["l_orderkey"], position_of(F.col("l_linenumber"), F.col("l_partkey"))
    hot = hot_groups(lines, key, spot, skew)
    if hot is not None:
        lines = with_slice(lines, key, spot, hot)
    rows = first_match_join(lines, valid, [("l_orderkey", "o_orderkey")], ["o_orderstatus"], "o_orderdate", False, hot)
    repeats = consecutive_repeats(
        rows, key, LINE_ORDER, "l_linenumber", "l_suppkey", {"prev_part": "l_partkey"}, position=spot, hot=hot
    )
    status = line_status(F.col("o_orderstatus"), ("O", "F", "P"))
    return repeats.select("l_orderkey", "l_linenumber", "l_suppkey", "prev_part", status.alias("status_name"))


def course_consecutive_stops(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(
        "user_id", "event_id", "event_type", "ts", "value", F.col("ts").cast("date").alias("day")
    )
    spot = time_position(F.col("ts"))
    repeats = consecutive_repeats(
        events, ["user_id"], ["ts", "event_id"], "event_id", "event_type", {"prev_value": "value"}, ["day"],
        spot, hot_groups(events, ["user_id"], spot, SKEW),
    )
    return repeats.select("user_id", "event_id", "event_type", "prev_value")


def sequence_group_counts(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    spot = position_of(F.col("l_linenumber"), F.col("l_partkey"))
    counted = sequence_groups(
        lines, ["l_orderkey"], LINE_ORDER, "l_linenumber", position=spot, hot=hot_groups(lines, ["l_orderkey"], spot, SKEW)
    )
    return counted.select("l_orderkey", F.col("rows").alias("rows_in_order"), F.col("groups").alias("group_count"))


def device_recency(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "event_type")
    since = F.expr("timestamp_ntz'2024-01-30 23:57:12' - interval 7 days")
    return drop_blank(filter_recent(events, "ts", since=since), "event_type").select("event_id")


def _devices(spark, sf_dir):
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", F.when(F.col("value") >= 2, F.col("value")).alias("version")
    )


def device_version_findings(spark, sf_dir):
    found = version_rows(_devices(spark, sf_dir), "error", 5, "event_type", "version")
    return found.select("event_id", F.regexp_replace("rule", "version_", "").alias("finding"))


def device_version_flag(spark, sf_dir):
    return version_flag(version_rows(_devices(spark, sf_dir), "error", 5, "event_type", "version"), ("user_id",))


def status_default(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", default_status(F.col("event_type"), ("click", "view"), "view").alias("status"))


def sql_literals(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        "o_orderkey", sql_date(orders, "o_orderdate").alias("d_lit"), sql_value(orders, "o_totalprice").alias("n_lit"),
        sql_value(orders, "o_orderpriority").alias("s_lit"),
    )


def insert_statements(spark, sf_dir):
    named = table(spark, sf_dir, "supplier").selectExpr("s_suppkey", "s_suppkey as K", "s_name as N", "s_acctbal as A")
    return named.select("s_suppkey", insert_statement(named, "IMP_S", [(c, "value") for c in "KNA"]).alias("stmt"))


def audit_summary(spark, sf_dir):
    parts = _parts(spark, sf_dir).withColumn("archive_id", F.lit("all"))
    orders = table(spark, sf_dir, "orders").select("o_orderstatus", F.lit("all").alias("archive_id"))
    names = duplicate_groups(parts, ["archive_id", "part_size", "name_key"], "p_partkey")
    names = names.select("archive_id", F.lit("parts").alias("section"), F.col("findings").alias("errors"))
    held = orders.where("o_orderstatus = 'P'").select(
        "archive_id", F.lit("orders").alias("section"), F.lit(1).cast("long").alias("errors")
    )
    checked = concat_frames([section_counts(parts, "parts"), section_counts(orders, "orders")])
    return summarise(checked, concat_frames([names, held])).select("section", "checked", "errors")


# --- jobs over mapped tables -------------------------------------------------------------------------------


def _stops(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select(
        F.concat(F.lit("a"), F.col("p_size") % 5).alias("archive_id"),
        F.col("p_partkey").alias("rec_no"),
        F.concat_ws(" ", "p_name", "p_size").alias("NAZWA"),
        F.concat_ws("/", "p_brand", "p_size").alias("KOD2"),
        F.when(F.col("p_partkey") % 7 != 0, F.col("p_type")).alias("SYM"),
        F.when(F.col("p_partkey") % 11 != 0, F.lit("1")).otherwise("  ").alias("X_KRAJ"),
        F.when(F.col("p_partkey") % 13 != 0, F.lit("1")).alias("Y_KRAJ"),
    )


FINDING_KEYS = ("archive_id", "rule", "rec_no", "key", "members", "errors", "message")


def stop_audit(spark, sf_dir):
    return audit_stops(_stops(spark, sf_dir), AuditOptions(check_coords=True)).findings.select(*FINDING_KEYS)


def _line_tables(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    key, none = F.col("o_orderkey"), F.lit(None).cast("date")
    status = F.when(F.col("o_orderstatus") == "F", "2").when(F.col("o_orderstatus") == "O", "1").otherwise("3")
    lines = orders.select(
        F.concat(F.lit("a"), key % 3).alias("archive_id"), key.alias("rec_no"), status.alias("STATLINII"),
        (key % 5).cast("string").alias("NRF"), key.alias("NRLINII"), F.lit(1).alias("WARLINII"), none.alias("WAZNAOD"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate").cast("date")).alias("WAZNADO"),
    )
    key = F.col("l_orderkey")
    routes = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("a"), key % 3).alias("archive_id"),
        (F.col("l_partkey") * 10_000_000 + F.col("l_suppkey")).alias("rec_no"),
        (key % 5).cast("string").alias("NRF"), key.alias("NRLINII"), F.lit(1).alias("WARLINII"), none.alias("WAZNAOD"),
        F.col("l_linenumber").alias("NRPRZYST"), F.col("l_suppkey").alias("KOD2"),
        F.concat(F.lit("P"), "l_partkey").alias("NAZPRZYST"),
    )
    return lines, routes


def matched_line_routes(spark, sf_dir):
    """Every column of the routes of valid lines, with the line's status."""
    lines, routes = _line_tables(spark, sf_dir)
    active = active_rows(lines, None, LINES, AuditOptions(ref_date=dt.date(1996, 1, 1), only_active=False))
    return matched_routes(routes, active, LINES).drop("WAZNAOD", "WARLINII")


def findings_table(spark, sf_dir):
    out = scratch_folder(spark)
    write_findings(audit_stops(_stops(spark, sf_dir)).findings, out, by=("section", "rule"))
    return spark.read.parquet(out).select("section", *FINDING_KEYS)


def line_audit(spark, sf_dir):
    lines, routes = _line_tables(spark, sf_dir)
    options = AuditOptions(ref_date=dt.date(1996, 1, 1), only_active=False)
    found = audit_lines(lines, routes, None, options).findings
    return found.select("archive_id", "rec_no", "carrier", "number", "seq", "status", "message")


def _course_tables(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    user = F.col("user_id")
    shared = [
        F.concat(F.lit("a"), user % 3).alias("archive_id"), F.col("event_id").alias("rec_no"),
        user.alias("NRKURSU"), F.lit(1).alias("WARIANT"), F.col("ts").cast("date").alias("WAZNYOD"),
    ]
    courses = events.where("event_type = 'view'").select(
        *shared, (user % 4).alias("NRF"), (F.col("event_id") % 5).alias("STATKURSU"), F.lit(None).cast("date").alias("WAZNYDO")
    )
    second = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    routes = events.select(
        *shared, (user % 4).alias("NRFK"), second.alias("NRPRZYST"),
        F.when(F.col("event_type") != "click", F.length("event_type")).alias("KOD2"), F.col("event_type").alias("NAZPRZYST"),
        F.col("ts").cast("date").alias("DATAOP"), F.date_format("ts", "HH:mm:ss").alias("GODZOP"),
    )
    return courses, routes


def _course_findings(spark, sf_dir, order):
    courses, routes = _course_tables(spark, sf_dir)
    found = audit_courses(courses, routes, None, AuditOptions(only_active=False, course_order=order)).findings
    return found.select("archive_id", "rec_no", "number", "valid_from", "seq", "code", "status", "message")


def course_audit(spark, sf_dir):
    return _course_findings(spark, sf_dir, "validity")


def course_audit_by_edit_time(spark, sf_dir):
    return _course_findings(spark, sf_dir, "edit_ts")


def timetable_rejects(spark, sf_dir):
    lines, routes = _line_tables(spark, sf_dir)
    routes = routes.withColumn("KOD2", F.when(F.col("KOD2") % 50 != 0, F.col("KOD2").cast("string")).otherwise("x"))
    options = AuditOptions(ref_date=dt.date(1996, 1, 1))
    rejects = audit_lines(lines, routes, None, options).rejects
    return rejects.groupBy("archive_id", "table", "column", "value").agg(F.count(F.lit(1)).alias("rows"))


def _with_nulls(df, spec):
    return df.selectExpr("*", *[f"cast(null as string) as {n}" for n, _ in spec if n not in df.columns])


def _machines(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return _with_nulls(
        events.select(
            F.concat(F.lit("a"), F.col("user_id") % 3).alias("archive_id"), F.col("event_id").alias("rec_no"),
            F.when(F.col("user_id") % 10 != 0, F.concat(F.lit("K"), "user_id")).otherwise(" ").alias("LOGO"),
            F.col("event_id").alias("NRFABR"), F.col("ts").alias("DATAPROD"),
            F.when(F.col("event_type") == "error", "EMAR-105").otherwise("OTHER").alias("TYPBIL"),
            F.col("ts").cast("date").alias("DATAZORF"), F.col("props").alias("UWAGI"),
            F.when(F.col("value") > 1, F.col("value").cast("decimal(10,2)").cast("string")).alias("WERPSB"),
        ),
        MACHINES,
    )


def machine_import(spark, sf_dir):
    return import_machines(_machines(spark, sf_dir), TODAY).scripts


def machine_findings(spark, sf_dir):
    return import_machines(_machines(spark, sf_dir), TODAY).findings.select("archive_id", "rec_no", "rule", "message")


def _employees(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return _with_nulls(
        customer.select(
            F.concat(F.lit("a"), F.col("c_custkey") % 3).alias("archive_id"), F.col("c_custkey").alias("rec_no"),
            F.col("c_custkey").alias("NR_SLUZB"), F.col("c_name").alias("IMIE"), F.col("c_mktsegment").alias("NAZWISKO"),
            (F.col("c_nationkey") % 10).cast("string").alias("STATUS"), F.col("c_acctbal").alias("ETAT"),
        ),
        EMPLOYEES,
    )


def employee_import(spark, sf_dir):
    return import_employees(_employees(spark, sf_dir)).scripts


def _cards(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return _with_nulls(
        orders.select(
            F.concat(F.lit("a"), F.col("o_custkey") % 3).alias("archive_id"), F.col("o_orderkey").alias("rec_no"),
            F.col("o_orderkey").alias("NRKP"), F.col("o_orderdate").alias("DATAPROD"), F.col("o_totalprice").alias("POJEMN"),
            F.col("o_orderpriority").alias("TYP"), F.col("o_orderstatus").alias("STATUS"), F.col("o_orderdate").alias("DATAREJ"),
        ),
        CARDS,
    )


def card_import(spark, sf_dir):
    return import_cards(_cards(spark, sf_dir)).scripts


def script_counts(spark, sf_dir):
    tables = {
        "kasyfiskalne": _machines(spark, sf_dir), "pracownicy": _employees(spark, sf_dir), "kartypamieci": _cards(spark, sf_dir)
    }
    return import_summary(import_tables(tables, TODAY).scripts)


# --- archives packed from the tables -----------------------------------------------------------------------

PER_ARCHIVE = 500
STOP_FIELDS = [("NAZWA", "C", 40, 0), ("KOD2", "C", 16, 0), ("SYM", "C", 12, 0), ("X_KRAJ", "N", 12, 2), ("Y_KRAJ", "F", 12, 1),
               ("OD", "D", 8, 0), ("CZYNNY", "L", 1, 0)]
STAFF_FIELDS = [("NR_SLUZB", "N", 10, 0), ("IMIE", "C", 40, 0), ("NAZWISKO", "C", 20, 0), ("STATUS", "C", 1, 0),
                ("DATA_PRZYJ", "D", 8, 0)]
_packed: dict = {}


def packed_archives(spark: SparkSession, sf_dir: str) -> str:
    """Folder with one archive for every 500 parts, holding a stop and an employee table made from them."""
    if sf_dir not in _packed:
        number = F.floor(F.col("p_partkey") / PER_ARCHIVE)
        key = F.col("p_partkey")
        rows = table(spark, sf_dir, "part").select(
            F.format_string("a%07d.zip", number).alias("archive_id"), key.alias("rec_no"),
            F.concat(F.lit("Łódź "), number).alias("company"),
            F.concat_ws(" ", "p_name", F.lit("żółć"), "p_size").alias("NAZWA"), F.concat_ws("/", "p_brand", "p_size").alias("KOD2"),
            F.when(key % 7 != 0, F.col("p_type")).alias("SYM"),
            F.when(key % 11 != 0, F.col("p_retailprice").cast("decimal(10,2)").cast("string")).alias("X_KRAJ"),
            F.concat(key % 100, F.lit(".5")).alias("Y_KRAJ"),
            F.when(key % 3 != 0, F.lit("20240131")).alias("OD"), F.when(key % 2 == 0, "T").otherwise("F").alias("CZYNNY"),
            key.alias("NR_SLUZB"), F.concat(F.lit("Świętosław "), "p_name").alias("IMIE"), F.col("p_type").alias("NAZWISKO"),
            (F.col("p_size") % 10).cast("string").alias("STATUS"), F.lit("20200229").alias("DATA_PRZYJ"),
        )
        layout = {"PRZYSTANKI.dbf": STOP_FIELDS, "Pracownicy.DBF": STAFF_FIELDS}
        made = F.explode(F.array(*[F.struct(F.lit(i).alias("place"), record_of(f).alias("record")) for i, f in enumerate(layout.values())]))
        records = rows.select("archive_id", "company", F.lit(0).alias("layout"), "rec_no", made.alias("made"))
        folder = scratch_folder(spark)
        pack_archives(records.select("*", "made.*").drop("made"), folder, [layout], ["rec_no"])
        _packed[sf_dir] = folder
    return _packed[sf_dir]


def archive_members(spark, sf_dir):
    return list_members(spark, packed_archives(spark, sf_dir)).select("archive_id", "member", "table")


def archive_scan(spark, sf_dir):
    stops = read_table(spark, packed_archives(spark, sf_dir), "przystanki")
    return stops.select(
        "archive_id", "rec_no", F.col("NAZWA").alias("name"), F.col("KOD2").alias("code"), F.col("SYM").alias("sym"),
        F.col("X_KRAJ").cast("double").alias("x"), F.col("Y_KRAJ").alias("y"),
        F.date_format("OD", "yyyy-MM-dd").alias("valid_from"), F.col("CZYNNY").alias("active"),
    )


def archive_columns(spark, sf_dir):
    return read_table(spark, packed_archives(spark, sf_dir), "przystanki", ["KOD2"]).select(
        "archive_id", "rec_no", F.col("KOD2").alias("code")
    )


def manifest(spark, sf_dir):
    return read_manifest(spark, packed_archives(spark, sf_dir))


def archive_audit(spark, sf_dir):
    _, summary, _ = audit(spark, packed_archives(spark, sf_dir), today=AUDIT_DAY)
    return summary


def archive_audit_findings(spark, sf_dir):
    findings, _, _ = audit(spark, packed_archives(spark, sf_dir), today=AUDIT_DAY)
    return findings.select("archive_id", "section", "rule", "rec_no", "message")


# Archives whose headers differ: those of even number hold numbers and dates, the others text where others have numbers.
ORDERS_PER_ARCHIVE, USERS_PER_ARCHIVE, CUSTOMERS_PER_ARCHIVE = 2000, 20, 200
TIMETABLES = {
    "linie": (
        [("STATLINII", "N", 1, 0), ("NRF", "N", 5, 0), ("NRLINII", "N", 9, 0), ("WARLINII", "N", 3, 0), ("WAZNAOD", "D", 8, 0), ("WAZNADO", "D", 8, 0)],
        [("STATLINII", "C", 1, 0), ("NRF", "N", 7, 1), ("NRLINII", "C", 9, 0), ("WARLINII", "N", 3, 0), ("WAZNAOD", "D", 8, 0), ("WAZNADO", "C", 10, 0)],
    ),
    "trasylinii": (
        [("NRF", "N", 5, 0), ("NRLINII", "N", 9, 0), ("WARLINII", "N", 3, 0), ("WAZNAOD", "D", 8, 0), ("NRPRZYST", "N", 3, 0), ("KOD2", "N", 8, 0),
         ("NAZPRZYST", "C", 12, 0)],
        [("NRF", "C", 5, 0), ("NRLINII", "N", 11, 1), ("WARLINII", "C", 3, 0), ("WAZNAOD", "C", 10, 0), ("NRPRZYST", "C", 3, 0), ("KOD2", "C", 8, 0),
         ("NAZPRZYST", "C", 12, 0)],
    ),
    "kursy": (
        [("STATKURSU", "N", 1, 0), ("NRF", "N", 3, 0), ("NRKURSU", "N", 7, 0), ("WARIANT", "N", 2, 0), ("WAZNYOD", "D", 8, 0), ("WAZNYDO", "D", 8, 0)],
        [("STATKURSU", "F", 3, 0), ("NRF", "C", 3, 0), ("NRKURSU", "F", 7, 0), ("WARIANT", "N", 2, 0), ("WAZNYOD", "D", 8, 0), ("WAZNYDO", "D", 8, 0)],
    ),
    "trasykursow": (
        [("NRFK", "N", 3, 0), ("NRKURSU", "N", 7, 0), ("WARIANT", "N", 2, 0), ("WAZNYOD", "D", 8, 0), ("NRPRZYST", "N", 6, 0), ("KOD2", "N", 4, 0),
         ("NAZPRZYST", "C", 12, 0), ("DATAOP", "D", 8, 0), ("GODZOP", "C", 8, 0)],
        [("NRFK", "N", 3, 0), ("NRKURSU", "C", 7, 0), ("WARIANT", "C", 2, 0), ("WAZNYOD", "C", 10, 0), ("NRPRZYST", "F", 6, 0), ("KOD2", "F", 7, 2),
         ("NAZPRZYST", "C", 12, 0), ("DATAOP", "C", 10, 0), ("GODZOP", "C", 8, 0)],
    ),
    "kasyfiskalne": (
        [("LOGO", "C", 8, 0), ("NRFABR", "N", 10, 0), ("DATAPROD", "D", 8, 0), ("TYPBIL", "C", 10, 0), ("DATAZORF", "D", 8, 0), ("UWAGI", "C", 60, 0),
         ("WERPSB", "C", 12, 0)],
        [("LOGO", "C", 8, 0), ("NRFABR", "C", 10, 0), ("DATAPROD", "C", 10, 0), ("TYPBIL", "C", 10, 0), ("DATAZORF", "D", 8, 0), ("UWAGI", "C", 60, 0),
         ("WERPSB", "N", 12, 2)],
    ),
    "pracownicy": (
        [("NR_SLUZB", "N", 10, 0), ("IMIE", "C", 25, 0), ("NAZWISKO", "C", 12, 0), ("STATUS", "N", 1, 0), ("ETAT", "N", 12, 2)],
        [("NR_SLUZB", "C", 10, 0), ("IMIE", "C", 25, 0), ("NAZWISKO", "C", 12, 0), ("STATUS", "C", 1, 0), ("ETAT", "F", 12, 2)],
    ),
    "kartypamieci": (
        [("NRKP", "N", 9, 0), ("DATAPROD", "D", 8, 0), ("POJEMN", "N", 14, 2), ("TYP", "C", 16, 0), ("STATUS", "C", 1, 0), ("DATAREJ", "D", 8, 0)],
        [("NRKP", "F", 9, 0), ("DATAPROD", "D", 8, 0), ("POJEMN", "F", 14, 2), ("TYP", "C", 16, 0), ("STATUS", "C", 1, 0), ("DATAREJ", "C", 10, 0)],
    ),
}


def _day(c, odd):
    """A date as its field holds it: packed where it is a date, with hyphens where it is text."""
    return F.date_format(c, "yyyyMMdd") if odd is None else F.when(odd, F.date_format(c, "yyyy-MM-dd")).otherwise(F.date_format(c, "yyyyMMdd"))


def packed_timetables(spark: SparkSession, sf_dir: str) -> str:
    """Folder of archives with timetables and devices made from orders, line items, events and customers."""
    if ("timetables", sf_dir) in _packed:
        return _packed["timetables", sf_dir]

    def rows(name, source, number, order, **columns):
        """Records of one table, with their archive's number and what they are sorted by."""
        values = {n: (c(odd) if callable(c) else c).cast("string") for odd in [number % 2 == 1] for n, c in columns.items()}
        sorted_by = [F.col(c).alias(f"by_{i}") for i, c in enumerate(order)]
        made = table(spark, sf_dir, source).select(number.alias("number"), *sorted_by, *[c.alias(n) for n, c in values.items()])
        even, odd = map(record_of, TIMETABLES[name])
        record = F.when(F.col("number") % 2 == 1, odd).otherwise(even)
        place = F.lit(list(TIMETABLES).index(name))
        return made.select("number", place.alias("place"), *[f"by_{i}" for i in range(len(order))], record.alias("record"))

    def fraction(c):
        return lambda odd: F.when(odd, F.concat(c.cast("string"), F.lit(".0"))).otherwise(c.cast("string"))

    def whole(c, per):
        return F.floor(F.col(c) / per).cast("int")

    order, line, user, event, one = F.col("o_orderkey"), F.col("l_orderkey"), F.col("user_id"), F.col("event_id"), F.lit(1)
    status = F.when(F.col("o_orderstatus") == "F", 2).when(F.col("o_orderstatus") == "O", 1).otherwise(3)
    until = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate"))
    opened = F.to_date(F.lit("1995-03-01"))
    day, clock = F.col("ts").cast("date"), F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    in_orders, in_events = whole("o_orderkey", ORDERS_PER_ARCHIVE), whole("user_id", USERS_PER_ARCHIVE)
    parts = [
        rows("linie", "orders", in_orders, ["o_orderkey"], STATLINII=status, NRF=fraction(order % 5), NRLINII=order, WARLINII=one,
             WAZNAOD=_day(opened, None), WAZNADO=lambda odd: _day(until, odd)),
        rows("trasylinii", "lineitem", whole("l_orderkey", ORDERS_PER_ARCHIVE), ["l_orderkey", *LINE_ORDER], NRF=line % 5,
             NRLINII=fraction(line), WARLINII=one, WAZNAOD=lambda odd: _day(opened, odd), NRPRZYST=F.col("l_linenumber"),
             KOD2=lambda odd: F.when(F.col("l_suppkey") % 50 != 0, F.col("l_suppkey").cast("string")).when(odd, F.lit("x")).otherwise(F.lit("*****")),
             NAZPRZYST=F.concat(F.lit("P"), "l_partkey")),
        rows("kursy", "events", in_events, ["event_id"], STATKURSU=F.when(F.col("event_type") == "view", event % 5), NRF=user % 4, NRKURSU=user,
             WARIANT=one, WAZNYOD=_day(day, None), WAZNYDO=F.lit(None)),
        rows("trasykursow", "events", in_events, ["event_id"], NRFK=user % 4, NRKURSU=user, WARIANT=one, WAZNYOD=lambda odd: _day(day, odd),
             NRPRZYST=clock, KOD2=F.when(F.col("event_type") != "click", F.length("event_type")), NAZPRZYST=F.col("event_type"),
             DATAOP=lambda odd: _day(day, odd), GODZOP=F.date_format("ts", "HH:mm:ss")),
        rows("kasyfiskalne", "events", in_events, ["event_id"], LOGO=F.when(user % 10 != 0, F.concat(F.lit("K"), user)), NRFABR=event,
             DATAPROD=lambda odd: _day(day, odd), TYPBIL=F.when(F.col("event_type") == "error", "EMAR-105").otherwise("OTHER"),
             DATAZORF=_day(day, None), UWAGI=F.substring("props", 1, 60),
             WERPSB=F.when(F.col("value") > 1, F.col("value").cast("decimal(10,2)"))),
        rows("pracownicy", "customer", whole("c_custkey", CUSTOMERS_PER_ARCHIVE), ["c_custkey"], NR_SLUZB=F.col("c_custkey"), IMIE=F.col("c_name"),
             NAZWISKO=F.col("c_mktsegment"), STATUS=F.col("c_nationkey") % 10, ETAT=F.col("c_acctbal").cast("decimal(10,2)")),
        rows("kartypamieci", "orders", in_orders, ["o_orderkey"], NRKP=order, DATAPROD=_day(F.col("o_orderdate"), None),
             POJEMN=F.col("o_totalprice").cast("decimal(12,2)"), TYP=F.col("o_orderpriority"), STATUS=F.col("o_orderstatus"),
             DATAREJ=lambda odd: _day(F.col("o_orderdate"), odd)),
    ]
    every = concat_frames(parts).withColumn("layout", F.col("number") % 2).where(F.col("layout").isin(0, 1))
    every = every.withColumns({"archive_id": F.format_string("t%05d.zip", "number"), "company": F.concat(F.lit("K"), "number")})
    folder = scratch_folder(spark)
    layouts = [{f"{t}.dbf": fields[odd] for t, fields in TIMETABLES.items()} for odd in (0, 1)]
    pack_archives(every.drop("number"), folder, layouts, [f"by_{i}" for i in range(1 + len(LINE_ORDER))])
    _packed["timetables", sf_dir] = folder
    return folder


ROUTE_OPTIONS = AuditOptions(ref_date=dt.date(1996, 1, 1), only_active=False)


def archive_route_findings(spark, sf_dir):
    """Repeats in lines and courses read from archives of different headers."""
    findings, _, _ = audit(spark, packed_timetables(spark, sf_dir), ROUTE_OPTIONS, AUDIT_DAY)
    found = findings.where("rule = 'consecutive_stop'")
    return found.select("archive_id", "section", "rec_no", "carrier", "number", "seq", "code", "status", "message")


def archive_rejects(spark, sf_dir):
    """Cells that could not be read, with the text that stood there."""
    _, _, rejects = audit(spark, packed_timetables(spark, sf_dir), ROUTE_OPTIONS, AUDIT_DAY)
    return rejects


def archive_scripts(spark, sf_dir):
    """Statements for machines, employees and cards read from archives of different headers."""
    result, _ = start_data(spark, packed_timetables(spark, sf_dir), TODAY)
    return result.scripts


TEMPLATE = "-- dane początkowe\r\n--START\r\n-- stare\r\n--KONIEC\r\nCOMMIT;"


def _write_templates(folder: str) -> None:
    for name in ("KasyFiskalne", "Pracownicy", "KartyPamieci"):
        write_file(folder, f"import_{name}.sql", TEMPLATE.encode("cp1250"))


def _lines_of(spark, folder, pattern, codepage):
    files = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(folder)
    )
    text = decode(F.col("content"), codepage) if codepage else F.decode("content", "UTF-8")
    relative = F.substring_index("path", "/", -2)
    return files.select(relative.alias("file"), F.explode(F.split(text, "\r?\n")).alias("line"))


def script_files(spark, sf_dir):
    folder, out, templates = packed_archives(spark, sf_dir), scratch_folder(spark), scratch_folder(spark)
    _write_templates(templates)
    result, companies = start_data(spark, folder, TODAY)
    write_scripts(result.scripts, read_template(spark, templates), companies, out)
    return _lines_of(spark, out, "import_*.sql", "cp1250")


def report_files(spark, sf_dir):
    """Every line of every report, with its place."""
    folder, out = packed_archives(spark, sf_dir), scratch_folder(spark)
    options, when = AuditOptions(), dt.datetime(2026, 12, 1, 8, 30)
    findings, summary, _ = audit(spark, folder, options, AUDIT_DAY)
    write_report(findings, summary, read_manifest(spark, folder), out, options, when)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt").load(out)
    lines = F.posexplode(F.split(F.decode("content", "UTF-8"), "\n")).alias("place", "line")
    return files.select(F.substring_index("path", "/", -1).alias("file"), lines)


QUERIES = (
    duplicate_name_groups, duplicate_name_findings, duplicate_code_findings, missing_admin_findings,
    missing_coords_findings, active_lines, trip_first_match, line_consecutive_stops, course_consecutive_stops,
    device_recency, device_version_findings, device_version_flag, status_default, sql_literals, insert_statements,
    audit_summary, stop_audit, findings_table, matched_line_routes, line_audit, course_audit, course_audit_by_edit_time, timetable_rejects, machine_import,
    machine_findings, employee_import, card_import, script_counts, archive_members, archive_scan, archive_columns,
    manifest, archive_audit, archive_audit_findings, archive_route_findings, archive_rejects, archive_scripts, script_files, report_files,
)


def entry(spark: SparkSession) -> DataFrame:
    """Repeated stops in line sequences, on the smallest tables."""
    return line_consecutive_stops(spark, "/root/testdata/sf0.001")


def _llm():
    """Queries and SQL of the training-data operators, or none where their folders are not there."""
    try:
        from corpus_pipeline import ORACLE_SQL, run
        from waybill.llm.queries import ORACLES, QUERIES as found
    except ModuleNotFoundError as missing:
        if missing.name not in ("corpus_pipeline", "waybill.llm"):
            raise
        return {}, {}
    return {**found, "pipeline": run}, {**ORACLES, **({"pipeline": ORACLE_SQL} if ORACLE_SQL else {})}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"sequence_groups": sequence_group_counts, **{q.__name__: q for q in QUERIES}, **_llm()[0]}


def oracle_sql() -> dict[str, str]:
    from driver_oracle import ORACLES

    return {**ORACLES, **_llm()[1]}
