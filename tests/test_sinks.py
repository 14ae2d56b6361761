"""Script and report files, byte by byte."""

import datetime as dt
import os
import random

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tests.test_golden import manifest_of, stops_of
from waybill.operators.findings import as_findings, summarise
from waybill.operators.slices import SkewRule
from waybill.plans.audit import AuditOptions, audit_stops
from waybill.sinks.documents import _finish, write_documents
from waybill.sinks.reports import write_findings, write_report
from waybill.sinks.scripts import splice, write_scripts

TEMPLATE = "A\r\n--START\r\nstare\r\n--KONIEC\r\nŻ"


def scripts_of(spark, n=5):
    rows = [("a.zip", "Pracownicy", i, f"INSERT {i} Łódź ║") for i in range(1, n + 1)] + [("b.zip", "Pracownicy", 9, "INSERT b")]
    df = spark.createDataFrame(rows, "archive_id string, script string, rec_no long, stmt string")
    return df.repartition(5)


def manifest(spark):
    return spark.createDataFrame([("a.zip", "Firma: 7"), ("b.zip", "8"), ("c.zip", "9")], "archive_id string, company string")


def templates(spark, text=TEMPLATE):
    return spark.createDataFrame([("Pracownicy", text), ("KartyPamieci", TEMPLATE)], "script string, text string")


def tree(path):
    return {os.path.relpath(os.path.join(d, f), path): open(os.path.join(d, f), "rb").read() for d, _, fs in os.walk(path) for f in fs}


def expected(n):
    rows = "".join(f"INSERT {i} Łódź ?\r\n" for i in range(1, n + 1))
    return f"A\r\n--START\r\n{rows}--KONIEC\r\nŻ".encode("cp1250")


def test_scripts(spark, tmp_path):
    out = str(tmp_path / "out")
    write_scripts(scripts_of(spark), templates(spark), manifest(spark), out)
    assert tree(out) == {
        "Firma_ 7_a_import_danych_startowych/import_Pracownicy.sql": expected(5),
        "8_b_import_danych_startowych/import_Pracownicy.sql": "A\r\n--START\r\nINSERT b\r\n--KONIEC\r\nŻ".encode("cp1250"),
    }


def test_large_scripts_come_in_parts(spark, tmp_path):
    out = str(tmp_path / "out")
    write_scripts(scripts_of(spark, 2000), templates(spark), manifest(spark), out, rows_per_part=300)
    files = tree(out)
    parts = sorted(n for n in files if n.startswith("Firma"))
    assert len(parts) == 7 and parts[0].endswith("import_Pracownicy.part00001.sql") and parts[-1].endswith("import_Pracownicy.sql")
    assert in_order({n: files[n] for n in parts}) == expected(2000)
    write_scripts(scripts_of(spark, 20), templates(spark), manifest(spark), out)
    assert sorted(n for n in tree(out) if n.startswith("Firma")) == ["Firma_ 7_a_import_danych_startowych/import_Pracownicy.sql"]


def test_existing_scripts_can_be_kept(spark, tmp_path):
    out = str(tmp_path / "out")
    write_scripts(scripts_of(spark), templates(spark), manifest(spark), out)
    before = tree(out)
    with pytest.raises(FileExistsError):
        write_scripts(scripts_of(spark, 9), templates(spark), manifest(spark), out, replace=False)
    assert tree(out) == before


@pytest.mark.parametrize("text", ["no marks", "--KONIEC --START", "--START only"])
def test_templates_need_both_marks(spark, tmp_path, text):
    with pytest.raises(PySparkException, match="--START"):
        write_scripts(scripts_of(spark), templates(spark, text), manifest(spark), str(tmp_path / "out"))
    assert tree(str(tmp_path / "out")) == {}


def test_scripts_need_a_template(spark, tmp_path):
    with pytest.raises(PySparkException, match="no template"):
        write_scripts(scripts_of(spark), templates(spark).where("script <> 'Pracownicy'"), manifest(spark), str(tmp_path / "out"))


def test_splice(spark):
    row = splice(templates(spark)).where("script = 'Pracownicy'").first()
    assert (row["head"], row["tail"]) == ("A\r\n--START", "--KONIEC\r\nŻ")


REPORT = """01/12/2026 08:30
Parametry weryfikacji:

\tFirma: 7
\tSprawdź współrzędne przystanków: nie
\tSprawdź administrację przystanków: tak
\tSprawdź linie/kursy firm obcych: tak
\tLinie/kursy: tylko aktywne, data ważności do > 01/01/2018 lub pole puste


Przystanki: 7

\tPrzystanki [Dworzec] [100], [DWORZEC] [101] mają taką samą nazwę.

\tPrzystanki [Dworzec] [100], [DWORZEC] [101], [Dworzec] [102] mają taką samą nazwę.

\tPrzystanki [Rynek] [200], [rynek] [200] mają taką samą nazwę i kod.

\tPrzystanki [Szkoła] [300], [Las] [300] mają taki sam kod.

\tPrzystanek [Las] [300] nie ma przypisanej administracji.


\tZnaleziono błędów: 5


Linie: 0

\tNie sprawdzono żadnych danych.


Kursy: 0

\tNie sprawdzono żadnych danych.
"""


@pytest.mark.parametrize("per_part", [1000, 5, 2, 1])
@pytest.mark.parametrize("skew", [SkewRule(), SkewRule(share=0.05, min_rows=2, min_bytes=0)])
def test_report(spark, tmp_path, per_part, skew):
    """The parts, put together, are the report, whatever its size and the slices its lines are placed by."""
    options = AuditOptions(duplicate_mode="cumulative", skew=skew)
    result = audit_stops(stops_of(spark), options)
    summary = summarise(result.checked, result.findings, manifest_of(spark))
    when = dt.datetime(2026, 12, 1, 8, 30)
    write_report(result.findings, summary, manifest_of(spark), str(tmp_path / "out"), options, when, per_part)
    files = tree(str(tmp_path / "out"))
    assert len(files) == -(-12 // per_part) and "7_a_011220260830.txt" in files
    assert in_order(files) == REPORT.encode()


def in_order(files):
    """Contents of a document's parts: the one of its own name first."""
    return b"".join(files[n] for n in sorted(files, key=lambda n: (".part" in n, n)))


def findings_of(spark, rows):
    columns = "section string, rule string, rec_no int, key string, carrier int, number int, variant int, valid_from string, seq int, edited string, message string"
    df = spark.createDataFrame(rows, columns)
    return as_findings(df.withColumn("archive_id", F.lit("a.zip")), "section", **{n: n for n in df.columns if n != "section"})


def test_order_of_a_report(spark, tmp_path):
    """Attributes by record, repeats by their key, courses by edit time where that is their order; alike at every size."""
    none = (None,) * 6
    rows = [("stops", "no_administration", r, f"k{9 - r}", *none, f"admin {r}") for r in range(1, 9)]
    rows += [("stops", "same_code", r, f"k{9 - r}", *none, f"code {r}") for r in range(1, 9)]
    rows += [("courses", "consecutive_stop", r, "", 7, 1, 1, f"2020-01-0{9 - r}", 9 - r, f"2021-01-0{r} 10:00:00", f"course {r}") for r in range(1, 9)]
    random.Random(3).shuffle(rows)
    findings = findings_of(spark, rows)
    checked = findings.groupBy("archive_id", "section").agg(F.count("*").alias("checked"))
    summary = summarise(checked, findings)
    want = [f"code {r}" for r in range(8, 0, -1)] + [f"admin {r}" for r in range(1, 9)] + [f"course {r}" for r in range(1, 9)]
    texts = set()
    for skew, per_part in ((SkewRule(), 1000), (SkewRule(), 7), (SkewRule(share=0.1, min_rows=3, min_bytes=0), 4)):
        out = tmp_path / f"{per_part}"
        write_report(findings, summary, manifest(spark).where("archive_id = 'a.zip'"), str(out), AuditOptions(skew=skew), dt.datetime(2026, 12, 1), per_part)
        texts.add(in_order(tree(str(out))))
    (text,) = texts
    assert [x[1:] for x in text.decode().split("\n") if x[1:].split(" ")[0] in ("code", "admin", "course")] == want


def test_many_documents(spark, tmp_path):
    out = str(tmp_path / "out")
    rows = spark.range(6000).selectExpr("concat('f', id % 7, '/d', id % 2000, '.txt') as doc", "id % 3 as part", "concat(id, '\n') as text", "id as pos")
    for _ in range(2):
        write_documents(rows, out, ["pos"])
    files = tree(out)
    want = {}
    for i in range(6000):
        want.setdefault(f"f{i % 7}/d{i % 2000}.txt", {}).setdefault(i % 3, []).append(i)
    assert sum(len(parts) for parts in want.values()) == len(files)
    for doc, parts in want.items():
        for k, part in enumerate(sorted(parts)):
            name = doc if k == 0 else doc.replace(".txt", f".part{k:05d}.txt")
            assert files[name] == "".join(f"{i}\n" for i in parts[part]).encode()


def test_moving_again_changes_nothing(tmp_path):
    """What a lost task had moved before it was repeated stays as it is."""
    staging = tmp_path / "_staging"
    staging.mkdir()
    for name in ("x", "y"):
        (staging / name).write_text(name)
    (tmp_path / "old.txt").write_text("old")
    (tmp_path / "a.txt").write_text("earlier")
    batch = pa.record_batch([pa.array(["x", "y", None]), pa.array(["a.txt", "f/b.txt", "old.txt"])], names=["file", "target"])
    for _ in range(2):
        assert [b.to_pylist() for b in _finish([batch], str(tmp_path), str(staging))] == [[{"files": 3}]]
        assert tree(str(tmp_path)) == {"a.txt": b"x", "f/b.txt": b"y"}
    with pytest.raises(FileNotFoundError):
        list(_finish([pa.record_batch([pa.array(["z"]), pa.array(["c.txt"])], names=["file", "target"])], str(tmp_path), str(staging)))


def test_findings_table(spark, tmp_path):
    findings = audit_stops(stops_of(spark)).findings
    write_findings(findings, str(tmp_path / "f"), by=("archive_id", "section"))
    back = spark.read.parquet(str(tmp_path / "f"))
    assert back.count() == 5 and set(back.columns) == set(findings.columns)
