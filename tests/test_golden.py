"""Small cases worked out by hand."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from waybill.functions.literals import sql_date, sql_value
from waybill.operators.duplicates import duplicate_findings
from waybill.operators.filters import check_ref_date, version_flag
from waybill.operators.findings import summarise
from waybill.plans.audit import AuditOptions, audit_courses, audit_lines, audit_stops
from waybill.plans.imports import import_employees, import_machines, import_summary
from waybill.plans.specs import EMPLOYEES, MACHINES

STOPS = [
    (1, "Dworzec", "100", "A", "1", "1"),
    (2, "DWORZEC", "101", "A", "1", "1"),
    (3, "Rynek", "200", None, "", ""),
    (4, "rynek", "200", "A", "1", "1"),
    (5, "Szkoła", "300", "A", "1", "1"),
    (6, "Las", "300", "  ", "1", None),
    (7, "Dworzec", "102", "A", "1", "1"),
]
STOP_SCHEMA = "archive_id string, rec_no long, NAZWA string, KOD2 string, SYM string, X_KRAJ string, Y_KRAJ string"
DAY = dt.date(2020, 1, 1)


def stops_of(spark, rows=STOPS):
    return spark.createDataFrame([("a.zip", *r) for r in rows], STOP_SCHEMA)


def manifest_of(spark):
    return spark.createDataFrame([("a.zip", "7")], "archive_id string, company string")


@pytest.mark.parametrize("mode", ["member", "cumulative", "group"])
def test_stops(spark, mode):
    result = audit_stops(stops_of(spark), AuditOptions(duplicate_mode=mode))
    found = result.findings.collect()
    errors = {}
    for r in found:
        errors[r.rule] = errors.get(r.rule, 0) + r.errors
    assert errors == {"same_name": 2, "same_name_and_code": 1, "same_code": 1, "no_administration": 1}
    assert result.checked.first().checked == 7
    assert result.rejects.count() == 0
    summary = summarise(result.checked, result.findings).first()
    assert (summary.checked, summary.errors, summary.clean) == (7, 5, False)


def test_stops_listing(spark):
    found = audit_stops(stops_of(spark), AuditOptions(duplicate_mode="cumulative")).findings.collect()
    listed = sorted(r.message for r in found if r.rule.startswith("same"))
    assert listed == [
        "Przystanki [Dworzec] [100], [DWORZEC] [101] mają taką samą nazwę.",
        "Przystanki [Dworzec] [100], [DWORZEC] [101], [Dworzec] [102] mają taką samą nazwę.",
        "Przystanki [Rynek] [200], [rynek] [200] mają taką samą nazwę i kod.",
        "Przystanki [Szkoła] [300], [Las] [300] mają taki sam kod.",
    ]
    missing = [r for r in found if r.rule == "no_administration"]
    assert [(r.rec_no, r.message) for r in missing] == [(6, "Przystanek [Las] [300] nie ma przypisanej administracji.")]


def test_stops_coordinates(spark):
    found = audit_stops(stops_of(spark), AuditOptions(check_coords=True)).findings
    assert found.where("rule = 'no_coordinates'").select("rec_no").collect() == [Row(rec_no=6)]
    assert found.count() == 6


def test_long_runs_keep_every_member(spark):
    df = stops_of(spark)
    keyed = df.selectExpr("*", "upper(NAZWA) as name_key").where("NAZWA is not null")
    found = duplicate_findings(
        keyed, ["archive_id", "name_key"], "NAZWA", "KOD2", mode="cumulative"
    ).where("name_key = 'DWORZEC'")
    assert [r.listed for r in found.orderBy("k").collect()] == [
        "[Dworzec] [100], [DWORZEC] [101]",
        "[Dworzec] [100], [DWORZEC] [101], [Dworzec] [102]",
    ]


def test_null_name_is_rejected(spark):
    rows = [*STOPS, (8, None, "900", None, "1", "1"), (9, "Brak", None, "A", "1", "1"), (10, "Pusty", " ", "A", "1", "1"),
            (11, "Inny", "", "A", "1", "1")]
    result = audit_stops(stops_of(spark, rows))
    assert [(r.table, r.rec_no, r.column) for r in result.rejects.collect()] == [("przystanki", 8, "NAZWA")]
    assert result.findings.where("rule = 'same_code'").count() == 1
    blank = audit_stops(stops_of(spark, rows), AuditOptions(blank_is_key=True))
    assert blank.findings.where("rule = 'same_code'").count() == 2


def lines_of(spark):
    rows = [
        (1, "2", "7", "1", "1", DAY, None),
        (2, "2", "7", "2", "1", DAY, dt.date(2018, 1, 1)),
        (3, "2", "9", "1", "1", DAY, None),
        (4, "3", "7", "3", "1", DAY, None),
    ]
    schema = "archive_id string, rec_no long, STATLINII string, NRF string, NRLINII string, WARLINII string, WAZNAOD date, WAZNADO date"
    return spark.createDataFrame([("a.zip", *r) for r in rows], schema)


def line_routes_of(spark, extra=()):
    rows = [
        ("7", "1", "1", "100", "A"), ("7", "1", "2", "100", "A"), ("7", "1", "3", "101", "B"), ("7", "1", "3", "101", "B"),
        ("7", "1", "4", "101", "B"), ("7", "2", "1", "100", "A"), ("7", "2", "2", "100", "A"), ("9", "1", "1", "500", "C"),
        ("9", "1", "2", "500", "C"), ("7", "3", "1", "100", "A"), ("7", "3", "2", "100", "A"), *extra,
    ]
    schema = (
        "archive_id string, rec_no long, NRF string, NRLINII string, WARLINII string, WAZNAOD date, NRPRZYST string, "
        "KOD2 string, NAZPRZYST string, OTHER string"
    )
    data = [("a.zip", i, f, n, "1", DAY, s, c, name, "x") for i, (f, n, s, c, name) in enumerate(rows, 1)]
    return spark.createDataFrame(data, schema)


@pytest.mark.parametrize(
    "options, checked, findings",
    [({}, 2, 3), ({"include_foreign": False}, 1, 2), ({"only_active": False}, 3, 4)],
)
def test_lines(spark, options, checked, findings):
    result = audit_lines(lines_of(spark), line_routes_of(spark), manifest_of(spark), AuditOptions(**options))
    assert result.checked.first().checked == checked
    found = result.findings.collect()
    assert len(found) == findings
    assert ("zawieszona" in {r.status for r in found}) == (not options.get("only_active", True))


def test_lines_text(spark):
    found = audit_lines(lines_of(spark), line_routes_of(spark), None).findings.orderBy("carrier", "rec_no").collect()
    assert [(r.carrier, r.number, r.seq, r.rec_no) for r in found] == [(7, 1, 2, 2), (7, 1, 4, 5), (9, 1, 2, 9)]
    assert found[0].message == (
        "[7] Linia 1 (aktywna), wariant 1, ważna od 2020-01-01, przystanek [ A ], kod2: [ 100 ] następuje jeden po drugim."
    )


def as_numbers(df):
    keys = ("NRF", "NRLINII", "WARLINII")
    return df.selectExpr(*[f"cast({c} as decimal(5,0)) as {c}" if c in keys else c for c in df.columns])


@pytest.mark.parametrize("numbers", [False, True])
def test_lines_rejects(spark, numbers):
    extra = [("7", "1", "x", "100", "A"), ("7", "1", "9", None, "A"), ("8", "1", "y", "100", "A")]
    lines, routes = lines_of(spark), line_routes_of(spark, extra)
    if numbers:
        lines, routes = as_numbers(lines), as_numbers(routes)
    result = audit_lines(lines, routes, None)
    assert sorted((r.table, r.rec_no, r.column, r.value) for r in result.rejects.collect()) == [
        ("trasylinii", 12, "NRPRZYST", "x"), ("trasylinii", 13, "KOD2", None),
    ]
    assert result.findings.count() == 3


def courses_of(spark):
    schema = "archive_id string, rec_no long, STATKURSU string, NRF string, NRKURSU string, WARIANT string, WAZNYOD date, WAZNYDO date"
    return spark.createDataFrame([("a.zip", 1, "2", "7", "10", "1", DAY, None)], schema)


def course_routes_of(spark, rows):
    schema = (
        "archive_id string, rec_no long, NRFK string, NRKURSU string, WARIANT string, WAZNYOD date, NRPRZYST string, "
        "KOD2 string, NAZPRZYST string, DATAOP date, GODZOP string"
    )
    return spark.createDataFrame([("a.zip", i, "7", "10", "1", DAY, *r) for i, r in enumerate(rows, 1)], schema)


@pytest.mark.parametrize("order", ["validity", "edit_ts"])
def test_courses(spark, order):
    rows = [(1, "100", "A"), (2, None, None), (3, None, None), (4, "100", "A")]
    routes = course_routes_of(spark, [(str(s), c, n, DAY, "10:00") for s, c, n in rows])
    result = audit_courses(courses_of(spark), routes, None, AuditOptions(course_order=order))
    assert result.checked.first().checked == 1
    (found,) = result.findings.collect()
    assert (found.seq, found.code, found.status) == (3, "-1", "aktywny")
    assert "przystanek [  ]" in found.message and found.message.startswith("[7] Kurs 10 (aktywny), wariant 1, ważny od")


def test_courses_edit_order_differs(spark):
    rows = [("1", "100", "A", DAY, "09:00"), ("2", "200", "B", DAY, "08:00"), ("3", "100", "A", DAY, "09:00")]
    routes = course_routes_of(spark, rows)
    by_validity = audit_courses(courses_of(spark), routes)
    by_edit = audit_courses(courses_of(spark), routes, None, AuditOptions(course_order="edit_ts"))
    assert by_validity.findings.count() == 0
    assert [r.seq for r in by_edit.findings.collect()] == [3]


TODAY = dt.date(2026, 12, 1)


def machines_of(spark):
    june = dt.date(2026, 6, 1)
    rows = [
        ("K1", "EMAR-105", june, "1.4"), ("K2", "EMAR-105", june, ""), ("K3", "EMAR-105", dt.date(2025, 12, 1), "1.5"),
        ("K4", "OTHER", dt.date(2025, 11, 30), "1.0"), ("", "EMAR-105", june, "1.0"), ("K6", "OTHER", None, "2.0"),
        ("K7", "EMAR-105", june, "1.10"),
    ]
    df = spark.createDataFrame(
        [("a.zip", i, *r) for i, r in enumerate(rows, 1)],
        "archive_id string, rec_no long, LOGO string, TYPBIL string, DATAZORF date, WERPSB string",
    )
    for name, _ in MACHINES:
        if name not in df.columns:
            df = df.selectExpr("*", f"cast(null as string) as {name}")
    return df


def test_machines(spark):
    result = import_machines(machines_of(spark), TODAY)
    scripts = result.scripts.orderBy("rec_no").collect()
    assert [r.rec_no for r in scripts] == [1, 2, 3, 7]
    assert scripts[0].stmt.startswith("INSERT INTO IMP_KasyFiskalne (LOGO, NRINW, ")
    assert scripts[0].stmt.endswith("null,null,'1.4',null,null,null);") and "'01.06.2026'" in scripts[0].stmt
    found = {(r.rec_no, r.rule): r.message for r in result.findings.collect()}
    assert found == {
        (1, "version_too_old"): "Bileterka EMAR-105 K1 ma wersję oprogramowania 1.4!",
        (2, "version_missing"): "Bileterka EMAR-105 K2 nie ma wersji oprogramowania!",
        (7, "version_too_old"): "Bileterka EMAR-105 K7 ma wersję oprogramowania 1.10!",
    }
    assert version_flag(result.findings).first().any_too_old is True
    only_missing = result.findings.where("rule = 'version_missing'")
    assert version_flag(only_missing).first().any_too_old is False
    assert import_summary(result.scripts).first().rows == 4


def test_unreadable_versions(spark):
    df = machines_of(spark).withColumn("WERPSB", F.when(F.col("LOGO") == "K1", "1,4").otherwise(F.col("WERPSB")))
    result = import_machines(df, TODAY)
    assert [(r.rec_no, r.column, r.value) for r in result.rejects.collect()] == [(1, "WERPSB", "1,4")]
    assert sorted(r.rec_no for r in result.findings.collect()) == [2, 7]
    assert result.scripts.count() == 4


def test_employee_status(spark):
    df = spark.createDataFrame(
        [("a.zip", i, s) for i, s in enumerate(["7", "8", "3", None, " 7 "], 1)], "archive_id string, rec_no long, STATUS string"
    )
    for name, _ in EMPLOYEES:
        if name != "STATUS":
            df = df.selectExpr("*", f"cast(null as string) as {name}")
    stmts = [r.stmt for r in import_employees(df).scripts.orderBy("rec_no").collect()]
    assert [s.split("VALUES (null,null,null,")[1][:3] for s in stmts] == ["'7'", "'8'", "'8'", "'8'", "'7'"]


def test_literals(spark):
    row = Row(
        n=None, d12=12.0, d125=12.5, dec=Decimal("12.50"), whole=Decimal("12.00"), s="  ab ", blank="   ", b=b"x",
        day=dt.date(2024, 2, 3), bad="x", q="O'Neil", big=12345678.9, small=0.00012, huge=1e22, i=5, flag=True,
        text_day="2024-02-03", pl_day="03.02.2024",
    )
    schema = (
        "n string, d12 double, d125 double, dec decimal(10,2), whole decimal(10,2), s string, blank string, b binary, "
        "day date, bad string, q string, big double, small double, huge double, i int, flag boolean, text_day string, pl_day string"
    )
    df = spark.createDataFrame([row], schema)
    values = df.select(*[sql_value(df, c).alias(c) for c in df.columns]).first().asDict()
    assert values == {
        "n": "null", "d12": "'12'", "d125": "'12.5'", "dec": "'12.50'", "whole": "'12'", "s": "'ab'", "blank": "''",
        "b": "null", "day": "'03.02.2024'", "bad": "'x'", "q": "'O''Neil'", "big": "'12345678.9'", "small": "'0.00012'",
        "huge": "'10000000000000000000000'", "i": "'5'", "flag": "'True'", "text_day": "'2024-02-03'", "pl_day": "'03.02.2024'",
    }
    dates = df.select(*[sql_date(df, c).alias(c) for c in ("n", "day", "bad", "text_day", "pl_day", "i")]).first().asDict()
    assert dates == {
        "n": "null", "day": "'03.02.2024'", "bad": "null", "text_day": "'03.02.2024'", "pl_day": "'03.02.2024'", "i": "null",
    }


def test_ref_date():
    assert check_ref_date(dt.date(2018, 1, 1), TODAY) == dt.date(2018, 1, 1)
    for bad in (None, TODAY, dt.date(2027, 1, 1)):
        with pytest.raises(ValueError):
            check_ref_date(bad, TODAY)


def test_numbers_of_any_size_keep_their_digits(spark):
    values = [1.2345678901234567e-10, 1e-20, -2.5e-7, 1.5e16, 12345678.25, -1e22, 1e40, 0.0, 5.0, 0.5, 1e-3]
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    texts = [r.x for r in df.select(sql_value(df, "v").alias("x")).collect()]
    assert [float(x.strip("'")) for x in texts] == values and not any("E" in x for x in texts)
    assert texts[1:] == [
        "'0.00000000000000000001'", "'-0.00000025'", "'15000000000000000'", "'12345678.25'",
        "'-1" + "0" * 22 + "'", "'1" + "0" * 40 + "'", "'0'", "'5'", "'0.5'", "'0.001'",
    ]


def test_white_space_is_blank(spark):
    from waybill.functions.scalars import is_blank, parse_date, trimmed

    df = spark.createDataFrame([("\t",), ("\u00a0 x\u2003\n",), (None,), ("20240131",)], "v string").coalesce(1)
    rows = df.select(is_blank(F.col("v")).alias("b"), trimmed(F.col("v")).alias("t"), parse_date(F.col("v")).alias("d")).collect()
    assert [r.b for r in rows] == [True, False, True, False] and rows[1].t == "x" and str(rows[3].d) == "2024-01-31"
