"""Archives packed from records, and what is made of their cells by code that the JVM compiles."""

import datetime as dt
import re
import struct
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import driver_archives as packing
from driver_archives import dbf_bytes, pack_archives, record_of
from waybill.functions.scalars import CLEAN, date_of, int_of
from waybill.plans.audit import AuditOptions, audit_courses, audit_lines
from waybill.plans.imports import import_cards, import_employees
from waybill.plans.specs import AUDIT_TABLES, CARDS, EMPLOYEES
from waybill.sources import dbf

STOPS = [("NAZWA", "C", 12, 0), ("KOD2", "N", 6, 0)]
ODD_STOPS = [("NAZWA", "C", 12, 0), ("KOD2", "C", 8, 0)]
STAFF = [("NR", "I", 4, 0), ("IMIE", "C", 9, 0)]
LAYOUTS = [{"STOPS.dbf": STOPS, "Staff.DBF": STAFF}, {"STOPS.dbf": ODD_STOPS, "Staff.DBF": STAFF}]


def records(spark, rows):
    """Records of rows (archive, layout, place, order, name, number)."""
    df = spark.createDataFrame(rows, "archive_id string, layout int, place int, at int, NAZWA string, KOD2 int")
    df = df.withColumns({"NR": F.col("KOD2"), "IMIE": F.col("NAZWA"), "company": F.concat(F.lit("K"), "archive_id")})
    stops = F.when(F.col("layout") == 1, record_of(ODD_STOPS)).otherwise(record_of(STOPS))
    return df.withColumn("record", F.when(F.col("place") == 0, stops).otherwise(record_of(STAFF)))


def test_archives_hold_their_records_in_order(spark, tmp_path, monkeypatch):
    rows = [("a.zip", 0, 0, 2, "Łódź", 5), ("a.zip", 0, 0, 1, None, None), ("b.zip", 1, 1, 1, "żółć", -2), ("b.zip", 1, 0, 1, "x", 70),
            ("c.zip", 0, 1, 1, "y", 300)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        assert pack_archives(records(spark, rows), f"file://{tmp_path}", LAYOUTS, ["at"]) == 3
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = {
        "a.zip": [(STOPS, [(None, None), ("Łódź", 5)]), (STAFF, [])],
        "b.zip": [(ODD_STOPS, [("x", 70)]), (STAFF, [(-2, "żółć")])],
        "c.zip": [(STOPS, []), (STAFF, [(300, "y")])],
    }
    assert sorted(p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")) == sorted(expected)
    for name, members in expected.items():
        with zipfile.ZipFile(tmp_path / name) as archive:
            assert archive.namelist() == ["info/ArchiwumInfo_1.rtf", "bazy/STOPS.dbf", "bazy/Staff.DBF"]
            assert f"Dane firmy: K{name}".encode() in archive.read("info/ArchiwumInfo_1.rtf")
            assert [archive.read(m) for m in archive.namelist()[1:]] == [dbf_bytes(f, r) for f, r in members]


def test_a_cell_that_does_not_fit_is_an_error(spark, tmp_path):
    with pytest.raises(Exception, match="NAZWA: a very long name is longer than 12"):
        pack_archives(records(spark, [("a.zip", 0, 0, 1, "a very long name", 1)]), f"file://{tmp_path}", LAYOUTS, ["at"])


def test_an_archive_is_written_as_its_records_come(tmp_path, monkeypatch):
    """No archive is held whole: of a large one no more than a buffer is in memory, and it is written when the next begins."""
    monkeypatch.setattr(packing, "BUFFERED", 100)
    seen = []

    def batches():
        for name, n in (("a.zip", 50), ("a.zip", 70), ("b.zip", 1)):
            seen.append(name)
            columns = {"archive_id": [name] * n, "company": ["K"] * n, "layout": [0] * n, "place": [0] * n, "record": [" " + "x" * 18] * n}
            yield pa.RecordBatch.from_pydict(columns)

    packer = packing._Packer(f"file://{tmp_path}", LAYOUTS)
    made = packer(batches())
    assert next(made).column(0).to_pylist() == ["a.zip"] and seen == ["a.zip", "a.zip", "b.zip"]
    with zipfile.ZipFile(tmp_path / "a.zip") as archive:
        assert struct.unpack_from("<I", archive.read("bazy/STOPS.dbf"), 4)[0] == 120
    assert packer.body._max_size == 100
    assert [b.column(0).to_pylist() for b in made] == [["b.zip"]]


@pytest.mark.parametrize("spec, imported", [(CARDS, import_cards), (EMPLOYEES, import_employees)])
def test_statements_are_made_by_code_that_is_compiled(spark, spec, imported, tmp_path, capfd):
    """The JVM never compiles a method of more than 8000 bytes of code."""
    rows = spark.range(3).select(F.lit("a").alias("archive_id"), F.col("id").alias("rec_no"), *[F.col("id").cast("string").alias(n) for n, _ in spec])
    rows.write.parquet(str(tmp_path / "rows"))
    imported(spark.read.parquet(str(tmp_path / "rows"))).scripts.explain(mode="codegen")
    sizes = re.findall(r"maxMethodCodeSize:(\d+)", capfd.readouterr().out)
    assert all(int(size) < 8000 for size in sizes)


@pytest.mark.parametrize("table, routes, check", [("linie", "trasylinii", audit_lines), ("kursy", "trasykursow", audit_courses)])
def test_routes_are_audited_by_code_that_is_compiled(spark, table, routes, check, tmp_path, capfd):
    clean = {}
    for name in (table, routes):
        columns = AUDIT_TABLES[name][0]
        spark.range(3).select(F.lit("a").alias("archive_id"), F.col("id").alias("rec_no"), *[F.col("id").cast("string").alias(n) for n in columns],
                              F.create_map(F.lit("x"), F.lit("y")).alias("unread")).write.parquet(str(tmp_path / name))
        df = spark.read.parquet(str(tmp_path / name))
        clean[name] = df.select("archive_id", "rec_no", *[F.col(n).alias(n, metadata={CLEAN: True}) for n in columns], "unread")
    result = check(clean[table], clean[routes], None, AuditOptions(only_active=False))
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # an adaptive plan has its code made as it runs
    try:
        for found in (result.findings, result.rejects):
            found.explain(mode="codegen")
            sizes = re.findall(r"maxMethodCodeSize:(\d+)", capfd.readouterr().out)
            assert sizes and all(int(size) < 8000 for size in sizes)
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_clean_text_is_read_as_trimmed_text_is(spark):
    texts = ["2024-01-31", "20240131", "31.01.2024", "2024/01/31", "2024-02-30", "20240230", "2024-01-31 10:00:00", "5", "-0", "5.0", "", "x", None, "99999999999"]
    df = spark.createDataFrame([(t,) for t in texts], "raw string")
    df = df.select("raw", F.col("raw").alias("clean", metadata={CLEAN: True}))
    rows = df.select(*[read(df, n).alias(f"{read.__name__}_{n}") for read in (date_of, int_of) for n in df.columns]).collect()
    assert [(r[0], r[2]) for r in rows] == [(r[1], r[3]) for r in rows]
    assert [r[0] for r in rows].count(None) == 9 and rows[7][2] == 5


def test_usual_decimals_take_one_pattern(monkeypatch):
    cells = pa.array(["12.50", "0.00", "-0.00", "7", "", "-3.", "100.010"])
    expected = ["12.5", "0", "0", "7", None, "-3", "100.01"]
    assert dbf._numbers(pa.concat_arrays([cells, pa.array(["+1"])]))[0].to_pylist() == [*expected, "1"]
    monkeypatch.setattr(dbf, "PLAINER", None)
    shown, unread = dbf._numbers(cells)
    assert shown.to_pylist() == expected and not any(unread.to_pylist())


def test_days_are_those_of_the_calendar(monkeypatch):
    monkeypatch.delattr(dbf.pc, "strftime")  # slower than all the rest
    cells = [f"{y:04}{m:02}{d:02}" for y in (1, 4, 100, 400, 1900, 2000, 2023, 2024, 9999) for m in range(14) for d in range(33)]

    def shown(cell):
        try:
            return dt.date(int(cell[:4]), int(cell[4:6]), int(cell[6:])).isoformat()
        except ValueError:
            return None

    found, unread = dbf._dates(pa.array([*cells, "", "00000000", "2024013", "2024x101"]), dbf.ISO_DATE)
    expected = [*map(shown, cells), None, None, None, None]
    assert found.to_pylist() == expected
    assert unread.to_pylist() == [*[e is None for e in expected[:-4]], False, False, True, True]
