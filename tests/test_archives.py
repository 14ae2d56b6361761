"""Archives written byte by byte, read back through Spark."""

import collections
import datetime as dt
import pathlib
import random
import zipfile
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from driver_archives import dbf_bytes, manifest_bytes, zip_bytes
from waybill.functions.codepages import decode, upper_half
from waybill.plans.audit import AuditOptions, audit
from waybill.sources import archives as source
from waybill.sources.archives import list_archives, list_members, read_manifest, read_table, read_template
from waybill.sources.dbf import DAY_FIRST, canonical, unread_map

FIELDS = [("NAZWA", "C", 20, 0), ("KOD2", "N", 6, 0), ("CENA", "N", 8, 2), ("KM", "F", 8, 3), ("OD", "D", 8, 0), ("OK", "L", 1, 0),
          ("OPIS", "M", 10, 0), ("NR", "I", 4, 0)]
ROWS = [
    ("Łódź Żabieniec", 100, "12.50", "1.250", "20240203", "T", "1", 7),
    ("usunięty", 1, "1.00", "1", "20240101", "F", "2", 8),
    ("", None, "***", None, None, "?", None, -1),
    ("  Świnoujście\t", 5, "-3.00", "2", "2024xx01", "n", "3", 9),
]


@pytest.fixture
def folder(tmp_path):
    def write(name, data):
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(data)

    table = dbf_bytes(FIELDS, ROWS, deleted={1})
    later = dbf_bytes(FIELDS, ROWS[:1])
    write("one.zip", zip_bytes({"info/archiwumINFO_77.RTF": manifest_bytes("7", "Ł-1"), "x/PRZYSTANKI.Dbf": table, "przystanki.dbf": later}))
    narrow = dbf_bytes([("NAZWA", "C", 30, 0), ("KOD2", "N", 9, 1)], [("A" * 30, "1234567.5"), ("b", "2.0")])
    write("deep/two.ZIP", zip_bytes({"przystanki.dbf": narrow, "ArchiwumInfo_.rtf": b"{\\rtf1 brak}"}, stored=True))
    write("three.zip", zip_bytes({"kursy.dbf": later}))
    write("broken.zip", b"this is no archive")
    write("ignored.txt", b"x")
    return str(tmp_path)


def test_listing(spark, folder):
    names = {r.archive_id for r in list_archives(spark, folder).collect()}
    assert names == {"one.zip", "deep/two.ZIP", "three.zip", "broken.zip"}
    members = list_members(spark, folder).collect()
    found = {(r.archive_id, r.table): r.member for r in members if r.table}
    assert found == {
        ("one.zip", "przystanki"): "x/PRZYSTANKI.Dbf", ("deep/two.ZIP", "przystanki"): "przystanki.dbf",
        ("three.zip", "kursy"): "kursy.dbf",
    }
    assert [(r.archive_id, bool(r.error)) for r in members if r.error] == [("broken.zip", True)]


@pytest.mark.parametrize("split", [64 << 20, 100])
def test_table(spark, folder, monkeypatch, split):
    """With a tiny split size every archive is read in many parts by record range."""
    monkeypatch.setattr(source, "SPLIT_BYTES", split)
    df = read_table(spark, folder, "Przystanki.DBF")
    types = dict(df.dtypes)
    assert types == {
        "archive_id": "string", "rec_no": "bigint", "NAZWA": "string", "KOD2": "decimal(8,1)", "CENA": "decimal(7,2)",
        "KM": "double", "OD": "date", "OK": "boolean", "OPIS": "binary", "NR": "int",
    }
    rows = {(r.archive_id, r.rec_no): r for r in df.collect()}
    assert sorted(rows) == [("deep/two.ZIP", 1), ("deep/two.ZIP", 2), ("one.zip", 1), ("one.zip", 3), ("one.zip", 4)]
    first = rows["one.zip", 1]
    assert first[2:] == ("Łódź Żabieniec", Decimal("100.0"), Decimal("12.50"), 1.25, dt.date(2024, 2, 3), True, bytearray(b"1"), 7)
    assert rows["one.zip", 3][2:] == ("", None, None, None, None, None, bytearray(b""), -1)
    assert rows["one.zip", 4][2:] == ("Świnoujście", Decimal("5.0"), Decimal("-3.00"), 2.0, None, False, bytearray(b"3"), 9)
    assert rows["deep/two.ZIP", 1][2:5] == ("A" * 30, Decimal("1234567.5"), None)


def test_chosen_columns(spark, folder):
    df = read_table(spark, folder, "przystanki", ["KOD2", "OBCA"])
    assert df.columns == ["archive_id", "rec_no", "KOD2", "OBCA"]
    assert df.where("OBCA is not null").count() == 0 and df.count() == 5


def test_manifest(spark, folder):
    rows = {r.archive_id: r[1:] for r in read_manifest(spark, folder).collect()}
    assert rows == {
        "one.zip": ("7", "Dane firmy: 7", "Licencja: Ł-1"), "deep/two.ZIP": (None, None, None),
        "three.zip": (None, None, None), "broken.zip": (None, None, None),
    }


@pytest.mark.parametrize(
    "rtf, text",
    [
        ("{\\rtf1\\ansi a\\par b\\line c}", "a\nb\nc"),
        ("{\\rtf1{\\fonttbl{\\f0 A:B;}{\\f1 C;}}{\\colortbl;\\red0;}\\pard x\\par}", "x\n"),
        ("{\\rtf1 \\'a3\\'f3d\\'9f \\u321?\\u243\\'f3 {\\b bold} \\{z\\} a\\\\b}", "Łódź Łó bold {z} a\\b"),
        ("{\\rtf1 x\\tab y\\parx\\pard z}", "x\tyz"),
        ("{\\rtf1 a{\\*\\x b{c{d{e{f{g{h{i}j}k}l}m}n}o}p}q}r{s{t{\\info u{v}}w}x}}", "aqrstwx"),
        ("{\\rtf1{\\fonttbl" + "{\\f0 A" * 40 + "}" * 40 + "}b{\\pict{\\*\\c}d}{e}", "be"),
        ("{\\rtf1 a}{\\*\\never closed {b", "a"),
        ("plain: 1\nnext \\par", "plain: 1\nnext \\par"),
    ],
)
def test_rtf(spark, rtf, text):
    assert spark.createDataFrame([(rtf,)], "t string").select(source.rtf_text(F.col("t"))).first()[0] == text


def test_codepages(spark):
    for page in ("cp852", "cp1250"):
        data = bytes(range(256))
        got = spark.createDataFrame([(data,)], "b binary").select(decode(F.col("b"), page)).first()[0]
        assert got == "".join(map(chr, range(128))) + upper_half(page) and len(got) == 256


def test_templates(spark, tmp_path):
    (tmp_path / "import_Pracownicy.sql").write_bytes("--START\r\nzażółć".encode("cp1250"))
    (tmp_path / "other.sql").write_bytes(b"x")
    assert [tuple(r) for r in read_template(spark, str(tmp_path)).collect()] == [("Pracownicy", "--START\r\nzażółć")]


def test_audit_of_archives(spark, tmp_path):
    stops = [("NAZWA", "C", 20, 0), ("KOD2", "N", 6, 0), ("SYM", "C", 3, 0), ("X_KRAJ", "N", 8, 2), ("Y_KRAJ", "N", 8, 2)]
    lines = [("STATLINII", "N", 1, 0), ("NRF", "N", 5, 0), ("NRLINII", "N", 5, 0), ("WARLINII", "N", 3, 0), ("WAZNAOD", "D", 8, 0), ("WAZNADO", "D", 8, 0)]
    routes = [("NRF", "N", 5, 0), ("NRLINII", "N", 5, 0), ("WARLINII", "N", 3, 0), ("WAZNAOD", "D", 8, 0), ("NRPRZYST", "N", 3, 0), ("KOD2", "N", 6, 0),
              ("NAZPRZYST", "C", 20, 0), ("UWAGI", "C", 5, 0)]
    full = zip_bytes(
        {
            "ArchiwumInfo_1.rtf": manifest_bytes("7"),
            "przystanki.dbf": dbf_bytes(stops, [("Dworzec", 1, "A", 1, 1), ("dworzec", 1, "A", 1, 1), ("Rynek", 2, "", None, None)]),
            "linie.dbf": dbf_bytes(lines, [(2, 7, 1, 1, "20200101", None), (2, 8, 1, 1, "20200101", None)]),
            "trasylinii.dbf": dbf_bytes(
                routes, [(f, 1, 1, "20200101", s, c, n, "") for f in (7, 8) for s, c, n in ((1, 5, "A"), (2, 5, "A"), (3, None, "B"))]
            ),
        }
    )
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.zip").write_bytes(full)
    (tmp_path / "in" / "b.zip").write_bytes(b"junk")
    options = AuditOptions(include_foreign=False, check_coords=True)
    for landing in (None, str(tmp_path / "landed")):
        findings, summary, rejects = audit(spark, str(tmp_path / "in"), options, dt.date(2026, 12, 1), landing)
        found = sorted((r.archive_id, r.section, r.rule, r.rec_no, r.errors) for r in findings.collect() if r.archive_id == "a.zip")
        assert [f[1:] for f in found if f[2] != "missing_table"] == [
            ("lines", "consecutive_stop", 2, 1), ("stops", "no_administration", 3, 1), ("stops", "no_coordinates", 3, 1),
            ("stops", "same_name_and_code", 2, 1),
        ]
        assert [f[1] for f in found if f[2] == "missing_table"] == ["courses", "courses"]
        assert sorted(map(tuple, summary.collect())) == [
            ("a.zip", "courses", 0, 0, None), ("a.zip", "lines", 1, 1, False), ("a.zip", "stops", 3, 3, False),
            ("b.zip", "courses", 0, 0, None), ("b.zip", "lines", 0, 0, None), ("b.zip", "stops", 0, 0, None),
        ]
        bad = sorted((r.archive_id, r.table or "", r.rec_no or 0, r.column) for r in rejects.collect())
        assert bad == [("a.zip", "trasylinii", 3, "KOD2"), ("b.zip", "", 0, "archive"), ("b.zip", "archiwuminfo", 0, "company")]


def test_audit_needs_a_past_date(spark, tmp_path):
    with pytest.raises(ValueError):
        audit(spark, str(tmp_path), today=dt.date(2018, 1, 1))


def test_tables_land_in_the_shared_folder(spark, folder, tmp_path):
    shared = pathlib.Path(spark.conf.get("spark.checkpoint.dir"))
    before = set(shared.iterdir())
    findings, summary, _ = audit(spark, folder, today=dt.date(2026, 12, 1))
    (landed,) = set(shared.iterdir()) - before
    assert sorted(p.name for p in landed.iterdir()) == ["directory", "scan"]
    assert {p.name for p in (landed / "scan" / "entry=row").iterdir()} == {"table=kursy", "table=przystanki"}
    for name in ("one.zip", "three.zip"):
        (tmp_path / name).unlink()  # the tables are not read from the archives again
    assert spark.read.parquet(f"{landed}/scan").where("table = 'przystanki' and archive_id = 'one.zip'").count() == 3
    assert findings.where("rule = 'no_administration' and archive_id = 'one.zip'").count() == 3


def test_damaged_tables_are_rejected(spark, tmp_path):
    """A member of wrong check sum, one cut short and one without header end no run, and no other archive's."""
    stops = [("NAZWA", "C", 20, 0), ("KOD2", "N", 6, 0), ("SYM", "C", 3, 0), ("X_KRAJ", "N", 8, 2), ("Y_KRAJ", "N", 8, 2)]
    table = dbf_bytes(stops, [(f"Stop {i}", i, "A", 1, 1) for i in range(10)])
    whole = zip_bytes({"ArchiwumInfo_1.rtf": manifest_bytes("7"), "przystanki.dbf": table}, stored=True)
    at = whole.index(b"Stop 5")
    size = (len(table) - 32 - 5 * 32 - 1) // 10
    files = {
        "good.zip": whole,
        "sum.zip": whole[:at] + b"X" + whole[at + 1 :],
        "cut.zip": zip_bytes({"ArchiwumInfo_1.rtf": manifest_bytes("7"), "przystanki.dbf": table[: len(table) - 6 * size - 1]}),
        "head.zip": zip_bytes({"ArchiwumInfo_1.rtf": manifest_bytes("7"), "przystanki.dbf": table[:20]}),
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    findings, summary, rejects = audit(spark, str(tmp_path), AuditOptions(), dt.date(2026, 12, 1))
    bad = {r.archive_id: r.value for r in rejects.where("column = 'table'").collect()}
    assert set(bad) == {"sum.zip", "cut.zip", "head.zip"} and bad["cut.zip"].startswith("10 records declared")
    checked = {r.archive_id: (r.checked, r.clean) for r in summary.where("section = 'stops'").collect()}
    assert checked["good.zip"] == (10, True) and checked["sum.zip"] == (0, None) == checked["head.zip"]
    assert checked["cut.zip"][0] == int(bad["cut.zip"].split()[3])


def test_read_table_gives_no_part_of_a_damaged_table(spark, tmp_path):
    """A wrong check sum, a cut stream or a cut header raises, whatever columns are read; with faults the table is left out."""
    fields = [("NAZWA", "C", 20, 0), ("KOD2", "N", 6, 0)]
    rng = random.Random(1)
    table = dbf_bytes(fields, [("".join(rng.choice("abcdefgh") for _ in range(20)), i, ) for i in range(20_000)])
    stored, packed = (zip_bytes({"przystanki.dbf": table}, stored=s) for s in (True, False))
    at, half = stored.index(table[1000:1020]), len(packed) // 2
    damaged = {
        "sum": stored[:at] + b"?" + stored[at + 1 :], "stream": packed[:half] + bytes(64) + packed[half + 64 :],
        "head": zip_bytes({"przystanki.dbf": table[:20]}),
    }
    for name, data in damaged.items():
        (tmp_path / name).mkdir()
        (tmp_path / name / "bad.zip").write_bytes(data)
        for others in (0, 1):
            if others:
                (tmp_path / name / "good.zip").write_bytes(packed)
            path = str(tmp_path / name)
            for columns in (None, ["KOD2"]):
                with pytest.raises(Exception, match="przystanki of bad.zip can't be read"):
                    read_table(spark, path, "przystanki", columns).collect()
            found = read_table(spark, path, "przystanki", faults=source.table_faults(spark, path, ["przystanki"]))
            assert [tuple(r) for r in found.groupBy("archive_id").count().collect()] == [("good.zip", 20_000)] * others


def test_neighbours_do_not_change_an_archive(spark, tmp_path):
    """Another archive's wider number fields leave an archive's statuses and codes as they are."""
    lines = lambda decimals: [("STATLINII", "N", 3, decimals), ("NRF", "N", 5, 0), ("NRLINII", "N", 5, 0), ("WARLINII", "N", 3, 0), ("WAZNAOD", "D", 8, 0), ("WAZNADO", "D", 8, 0)]
    routes = [("NRF", "N", 5, 0), ("NRLINII", "N", 5, 0), ("WARLINII", "N", 3, 0), ("WAZNAOD", "D", 8, 0), ("NRPRZYST", "N", 3, 0),
              ("KOD2", "N", 6, 0), ("NAZPRZYST", "C", 20, 0)]
    for name, decimals in (("a.zip", 0), ("b.zip", 1)):
        (tmp_path / name).write_bytes(zip_bytes({
            "ArchiwumInfo_1.rtf": manifest_bytes("7"),
            "linie.dbf": dbf_bytes(lines(decimals), [("2.0" if decimals else "2", 7, 1, 1, "20200101", None)]),
            "trasylinii.dbf": dbf_bytes(routes, [(7, 1, 1, "20200101", s, 5, "A") for s in (1, 2)]),
        }))
    _, summary, _ = audit(spark, str(tmp_path), AuditOptions(), dt.date(2026, 12, 1))
    assert [(r.checked, r.errors) for r in summary.where("section = 'lines'").collect()] == [(1, 1), (1, 1)]


# --- canonical cells -----------------------------------------------------------------------------------------


@pytest.mark.parametrize(
    "kind, cells",
    [
        ("N", {"5": "5", "007": "7", "-0.50": "-0.5", ".5": "0.5", "5.": "5", "+3": "3", "-0": "0", "0.00": "0", "": None, "12.3400": "12.34",
               "100": "100", "1e3": "1000", "1.25E-10": "0.000000000125", "123456789012345678": "123456789012345678"}),
        ("F", {"2.0": "2", "1.250": "1.25"}),
        ("D", {"20240203": "2024-02-03", "18991231": "1899-12-31", "": None, "00000000": None}),
        ("L", {"T": "True", "y": "True", "F": "False", "n": "False", "?": None, "": None}),
        ("C", {"007": "007", "": "", "2.0": "2.0", "x": "x"}),
    ],
)
def test_canonical_cells(kind, cells):
    for chosen in (list(cells), *([c] for c in cells)):  # alone, and beside cells of other forms
        text, bad = canonical(pa.array(chosen, pa.string()), kind)
        assert text.to_pylist() == [cells[c] for c in chosen]
        assert bad is None or not any(bad.to_pylist())


@pytest.mark.parametrize("kind, cells", [("N", ["*****", ".", "-", "1.2.3", "nan", "1 2"]), ("D", ["20240230", "2024xx01", "202402"]), ("L", ["x", "1"])])
def test_unreadable_cells(kind, cells):
    text, bad = canonical(pa.array([*cells, ""], pa.string()), kind)
    assert text.to_pylist() == [None] * (len(cells) + 1) and bad.to_pylist() == [True] * len(cells) + [False]


def test_dates_with_the_day_first():
    assert canonical(pa.array(["20240203", "x", ""]), "D", DAY_FIRST)[0].to_pylist() == ["03.02.2024", None, None]


def test_unread_map():
    bad = {"A": (pa.array(["x", "1", "y"]), pa.array([True, False, True])), "B": (pa.array(["1", "2", "z"]), pa.array([False, False, True]))}
    assert [dict(m) for m in unread_map(3, bad).to_pylist()] == [{"A": "x"}, {}, {"A": "y", "B": "z"}]
    assert unread_map(2, {}).to_pylist() == [[], []]


ROUTE_KINDS = {"NRF": "CNF", "NRLINII": "CNF", "WARLINII": "CN", "WAZNAOD": "CD", "NRPRZYST": "CNF", "KOD2": "CNF", "NAZPRZYST": "C"}
LINE_KINDS = {"STATLINII": "CNF", "NRF": "CNF", "NRLINII": "CNF", "WARLINII": "CN", "WAZNAOD": "CD", "WAZNADO": "CD"}


def random_archive(rng):
    """Lines and routes whose fields have any kinds, decimals and spellings, some of them unreadable."""

    def cell(name, kind, decimals, value):
        if name.startswith("WAZNA"):
            return {"D": ["20200101", "20200101", "2020xx01", ""], "C": ["2020-01-01", "20200101", "01.01.2020", "?"]}[kind][value]
        if rng.random() < 0.05:
            return "*****"
        if kind == "C":
            return rng.choice([str(value), f"0{value}", f"{value}.0", ""]) if rng.random() < 0.2 else str(value)
        return f"{value}.{'0' * decimals}" if decimals else str(value)

    def table(kinds, rows):
        fields = []
        for name, allowed in kinds.items():
            kind = rng.choice(allowed)
            fields.append((name, kind, 8 if kind == "D" else 12, rng.choice([0, 0, 1, 3]) if kind in "NF" else 0))
        return dbf_bytes(fields, [[cell(f[0], f[1], f[3], row[f[0]]) for f in fields] for row in rows])

    day = rng.choice([0, 0, 0, 1])
    keys = [{"NRF": rng.randint(7, 8), "NRLINII": rng.randint(1, 3), "WARLINII": 1, "WAZNAOD": day} for _ in range(4)]
    lines = [{**k, "STATLINII": rng.choice([2, 2, 1]), "WAZNADO": rng.choice([3, 3, 2])} for k in keys]
    routes = [{**k, "NRPRZYST": s, "KOD2": rng.randint(1, 2), "NAZPRZYST": f"P{s}"} for k in keys for s in range(1, 7)]
    return zip_bytes(
        {"ArchiwumInfo_1.rtf": manifest_bytes("7"), "linie.dbf": table(LINE_KINDS, lines), "trasylinii.dbf": table(ROUTE_KINDS, routes)},
        stored=rng.random() < 0.5,
    )


def test_an_archive_gives_the_same_alone_and_beside_any_other(spark, tmp_path):
    rng = random.Random(11)

    def results(folder):
        found = audit(spark, str(folder), AuditOptions(), dt.date(2026, 12, 1))
        rows = [sorted((r.asDict() for r in df.collect()), key=repr) for df in found]
        return {a: [[r for r in part if r["archive_id"] == a] for part in rows] for a in {r["archive_id"] for part in rows for r in part}}

    (tmp_path / "all").mkdir()
    alone = {}
    for i in range(5):
        data = random_archive(rng)
        (tmp_path / str(i)).mkdir()
        for folder in (str(i), "all"):
            (tmp_path / folder / f"a{i}.zip").write_bytes(data)
        alone |= results(tmp_path / str(i))
    together = results(tmp_path / "all")
    assert together == alone
    assert sum(len(r[0]) for r in alone.values()) > 10 and any(x["value"] == "*****" for r in alone.values() for x in r[2])


def test_cells_that_do_not_parse_are_rejected_with_their_text(spark, tmp_path):
    """An unreadable code is no missing code: it gives no repeat, and the reject names what stood there."""
    courses = [("STATKURSU", "N", 1, 0), ("NRF", "N", 5, 0), ("NRKURSU", "N", 5, 0), ("WARIANT", "N", 3, 0), ("WAZNYOD", "D", 8, 0), ("WAZNYDO", "D", 8, 0)]
    routes = [("NRFK", "N", 5, 0), ("NRKURSU", "N", 5, 0), ("WARIANT", "N", 3, 0), ("WAZNYOD", "D", 8, 0), ("NRPRZYST", "N", 3, 0), ("KOD2", "N", 6, 0),
              ("NAZPRZYST", "C", 9, 0), ("DATAOP", "D", 8, 0), ("GODZOP", "C", 8, 0)]
    stops = [("NAZWA", "C", 20, 0), ("KOD2", "N", 6, 0), ("SYM", "C", 3, 0), ("X_KRAJ", "N", 8, 2), ("Y_KRAJ", "N", 8, 2)]
    rest = ("20200101", "10:00")
    (tmp_path / "a.zip").write_bytes(zip_bytes({
        "ArchiwumInfo_1.rtf": manifest_bytes("7"),
        "przystanki.dbf": dbf_bytes(stops, [("A", 1, "x", "****", 1), ("B", "?", "x", 1, 1), ("C", "?", "x", 1, None)]),
        "kursy.dbf": dbf_bytes(courses, [(2, 7, 10, 1, "20200101", None), (2, 7, 11, 1, "20200101", "2020ab01")]),
        "trasykursow.dbf": dbf_bytes(routes, [(7, 10, 1, "20200101", s, c, n, *rest) for s, c, n in
                                              ((1, "*****", "A"), (2, "*****", "B"), (3, None, "C"), (4, None, "D"), ("x", 5, "E"))]),
    }))
    findings, summary, rejects = audit(spark, str(tmp_path), AuditOptions(check_coords=True), dt.date(2026, 12, 1))
    assert sorted((r.section, r.rule, r.rec_no) for r in findings.where("rule <> 'missing_table'").collect()) == [
        ("courses", "consecutive_stop", 4), ("stops", "no_coordinates", 3),
    ]
    assert sorted((r.table, r.rec_no, r.column, r.value) for r in rejects.collect()) == [
        ("kursy", 2, "WAZNYDO", "2020ab01"), ("przystanki", 1, "X_KRAJ", "****"), ("przystanki", 2, "KOD2", "?"), ("przystanki", 3, "KOD2", "?"),
        ("trasykursow", 1, "KOD2", "*****"), ("trasykursow", 2, "KOD2", "*****"), ("trasykursow", 5, "NRPRZYST", "x"),
    ]
    assert {r.section: r.checked for r in summary.collect()} == {"stops": 3, "lines": 0, "courses": 1}


# --- how members are read ------------------------------------------------------------------------------------


@pytest.mark.parametrize("split", [64 << 20, 3000, 500])
def test_every_member_is_inflated_once(spark, tmp_path, monkeypatch, split):
    """Small archives are read in one go, large ones by member; ranges are cut of stored members only."""
    monkeypatch.setattr(source, "SPLIT_BYTES", split)
    fields = [("NAZWA", "C", 20, 0), ("KOD2", "N", 6, 0)]
    sizes = {"przystanki": 40, "linie": 300, "kursy": 3, "obca": 90}
    for name, stored in (("packed", False), ("stored", True)):
        members = {f"{t}.dbf": dbf_bytes(fields, [(f"{t} {i}", i) for i in range(n)]) for t, n in sizes.items()}
        (tmp_path / f"{name}.zip").write_bytes(zip_bytes({**members, "ArchiwumInfo_1.rtf": manifest_bytes("7")}, stored=stored))
    tables = {t: ["NAZWA", "KOD2"] for t in sizes if t != "obca"}
    units = source._dealt(source._units(source.archive_directory(spark, str(tmp_path)), list(tables), True, False)).drop("place", "cost").toArrow()
    opened, records = collections.Counter(), collections.Counter()
    real = zipfile.ZipFile.open

    def counting(archive, member, *more, **named):
        opened[pathlib.Path(archive.fp.name).stem, getattr(member, "filename", member)] += 1
        return real(archive, member, *more, **named)

    monkeypatch.setattr(zipfile.ZipFile, "open", counting)
    for batch in source._Scanner(tables, "cp852", "-", False, False)(units.to_batches()):
        for row in batch.select(["archive_id", "entry", "table", "c0"]).to_pylist():
            assert row["entry"] != "fault"
            records[row["archive_id"], row["entry"], row["table"], row["c0"]] += 1
    assert set(records.values()) == {1} and len(records) == 2 * (343 + 1)
    wanted = {"przystanki.dbf", "linie.dbf", "kursy.dbf", "ArchiwumInfo_1.rtf"}
    assert {m for _, m in opened} == wanted and all(opened["packed", m] == 1 for m in wanted)
    parts = -(-(len(dbf_bytes(fields, [])) + 300 * 27) // split)
    assert opened["stored", "linie.dbf"] == (1 if parts == 1 else parts + 1)
    assert len({u["archive_id"] for u in units.to_pylist()}) == 2 and (len(units) == 2) == (split > 1 << 20)


def test_units_are_dealt_out_by_size(spark, monkeypatch):
    rng = random.Random(5)
    costs = [int(1000 * rng.paretovariate(1.5)) for _ in range(3000)]
    monkeypatch.setattr(source, "SPLIT_BYTES", sum(costs) // 16)
    rows = [(f"a{i}", "p", "", [], c) for i, c in enumerate(costs)]
    units = spark.createDataFrame(rows, "archive_id string, path string, unit string, items array<string>, cost long")
    loads = source._dealt(units).groupBy(F.spark_partition_id()).agg(F.sum("cost"), F.count("*")).collect()
    assert sum(r[2] for r in loads) == 3000 and sum(r[1] for r in loads) == sum(costs)
    assert len(loads) == 16 and max(r[1] for r in loads) <= sum(costs) / 16 + 2 * max(costs)


def test_damage_in_a_stored_member_read_by_ranges(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(source, "SPLIT_BYTES", 2000)
    fields = [("NAZWA", "C", 20, 0), ("KOD2", "N", 6, 0)]
    whole = zip_bytes({"przystanki.dbf": dbf_bytes(fields, [(f"Stop {i}", i) for i in range(500)])}, stored=True)
    at = whole.index(b"Stop 77 ")
    (tmp_path / "good.zip").write_bytes(whole)
    (tmp_path / "bad.zip").write_bytes(whole[:at] + b"X" + whole[at + 1 :])
    with pytest.raises(Exception, match="przystanki of bad.zip can't be read"):
        read_table(spark, str(tmp_path), "przystanki").collect()
    faults = source.table_faults(spark, str(tmp_path), ["przystanki"])
    assert [(r.archive_id, r.fatal) for r in faults.collect()] == [("bad.zip", True)]
    found = read_table(spark, str(tmp_path), "przystanki", faults=faults).collect()
    assert sorted((r.archive_id, r.rec_no) for r in found) == [("good.zip", i) for i in range(1, 501)]
