"""Invented archives for checks: DBF bytes, manifests, and archives packed from a DataFrame."""

from __future__ import annotations

import io
import shutil
import struct
import sys
import tempfile
import uuid
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.sinks.documents import file_system

cloudpickle.register_pickle_by_value(sys.modules[__name__])


CODEPAGE = "cp852"
RECORDS_PER_TASK = 500_000
BUFFERED = 16 << 20  # bytes of a member, and of an archive, that a task keeps in memory


def dbf_head(fields: list, records: int) -> bytes:
    """Header of a DBF file of `fields` (name, kind, length, decimals)."""
    size = 1 + sum(f[2] for f in fields)
    head = struct.pack("<BBBBIHH20x", 3, 126, 1, 1, records, 32 + 32 * len(fields) + 1, size)
    for name, kind, length, decimals in fields:
        head += struct.pack("<11sc4xBB14x", name.encode("ascii"), kind.encode("ascii"), length, decimals)
    return head + b"\r"


def dbf_bytes(fields: list, rows: list, deleted: set = frozenset(), codepage: str = CODEPAGE) -> bytes:
    """DBF file of `fields` (name, kind, length, decimals) and rows of texts; None is blank."""
    out = [dbf_head(fields, len(rows))]
    for i, row in enumerate(rows):
        out.append(b"*" if i in deleted else b" ")
        for (name, kind, length, decimals), value in zip(fields, row):
            if kind == "I":
                out.append(struct.pack("<i", int(value)))
                continue
            text = ("" if value is None else str(value)).encode(codepage)
            if len(text) > length:
                raise ValueError(f"{name}: {value!r} is longer than {length}")
            out.append(text.rjust(length) if kind in "NF" else text.ljust(length))
    out.append(b"\x1a")
    return b"".join(out)


def manifest_bytes(company: str, licence: str = "L-1") -> bytes:
    def escaped(text):
        return "".join(c if c.isascii() else f"\\'{c.encode('cp1250').hex()}" for c in text)

    return (
        "{\\rtf1\\ansi\\ansicpg1250\\deff0{\\fonttbl{\\f0\\fnil\\fcharset238 Arial: CE;}}\r\n"
        "{\\*\\generator Test: 1;}\\viewkind4\\uc1\\pard\\f0\\fs20 Archiwum\\par\r\n"
        f"Dane firmy: {escaped(company)}\\par\r\nLicencja: {escaped(licence)}\\par\r\n}}\r\n"
    ).encode("ascii")


def zip_bytes(members: dict, stored: bool = False) -> bytes:
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_STORED if stored else zipfile.ZIP_DEFLATED) as archive:
        for name, data in members.items():
            archive.writestr(name, data)
    return buffer.getvalue()


def scratch_folder(spark: SparkSession) -> str:
    """New folder in the cluster's shared folder, or where none is named and all runs on this machine, a temporary one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="archives-")
    return f"{shared.rstrip('/')}/archives-{uuid.uuid4().hex}"


def write_file(folder: str, name: str, content) -> None:
    """Write bytes, or all of a file that is open, under another name first."""
    system, root = file_system(folder)
    system.create_dir(root, recursive=True)
    draft = f"{root}/.{uuid.uuid4().hex}"
    with system.open_output_stream(draft) as f:
        if isinstance(content, bytes):
            f.write(content)
        else:
            shutil.copyfileobj(content, f, BUFFERED)
    system.move(draft, f"{root}/{name}")


def record_of(fields: list) -> Column:
    """A live record of `fields` as text, one character for each byte, out of the columns of their names; null is blank."""

    def cell(name, kind, length):
        if kind == "I":
            value, page = F.col(name).cast("int"), F.lit(bytes(range(256)).decode(CODEPAGE))
            return F.concat(*[F.substr(page, F.shiftright(value, 8 * i).bitwiseAND(255) + 1, F.lit(1)) for i in range(4)])
        text = F.coalesce(F.col(name).cast("string"), F.lit(""))
        padded = F.lpad(text, length, " ") if kind in "NF" else F.rpad(text, length, " ")
        problem = F.concat(F.lit(f"{name}: "), text, F.lit(f" is longer than {length}"))
        return F.when(F.length(text) <= length, padded).otherwise(F.raise_error(problem))

    return F.concat(F.lit(" "), *[cell(name, kind, length) for name, kind, length, _ in fields])


class _Packer:
    """Writes the archives of a partition one after another, from records sorted by archive and member.

    Memory holds a batch, and of the archive at work what fits a buffer; the rest is in temporary files.
    """

    def __init__(self, folder: str, layouts: list):
        self.folder, self.layouts = folder, [list(members.items()) for members in layouts]

    def __call__(self, batches):
        name = None
        for batch in batches:
            names = batch.column("archive_id").dictionary_encode()
            places = batch.column("place").to_numpy(zero_copy_only=False)
            at = names.indices.to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.diff(at, prepend=-1) | np.diff(places, prepend=-1))
            for start, stop in zip(starts, [*starts[1:], len(at)]):
                if (found := names.dictionary[at[start]].as_py()) != name:
                    if name is not None:
                        yield self.close(name)
                    name = found
                    self.open(batch.column("company")[start].as_py(), batch.column("layout")[start].as_py())
                self.add(int(places[start]), batch.column("record").slice(start, stop - start))
        if name is not None:
            yield self.close(name)

    def open(self, company: str, layout: int) -> None:
        self.members = self.layouts[layout]
        self.file = tempfile.SpooledTemporaryFile(BUFFERED)
        self.archive = zipfile.ZipFile(self.file, "w", zipfile.ZIP_DEFLATED)
        self.archive.writestr("info/ArchiwumInfo_1.rtf", manifest_bytes(str(company)))
        self.place, self.records, self.body = 0, 0, tempfile.SpooledTemporaryFile(BUFFERED)

    def add(self, place: int, records: pa.Array) -> None:
        while self.place < place:
            self.end_member()
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(records)], records.cast(pa.string())), "")[0].as_py()
        self.body.write(text.encode("ascii" if text.isascii() else CODEPAGE))  # the first is far quicker
        self.records += len(records)

    def end_member(self) -> None:
        name, fields = self.members[self.place]
        self.body.seek(0)
        with self.archive.open(f"bazy/{name}", "w", force_zip64=True) as member:
            member.write(dbf_head(fields, self.records))
            shutil.copyfileobj(self.body, member, BUFFERED)
            member.write(b"\x1a")
        self.body.close()
        self.place, self.records, self.body = self.place + 1, 0, tempfile.SpooledTemporaryFile(BUFFERED)

    def close(self, name: str) -> pa.RecordBatch:
        while self.place < len(self.members):
            self.end_member()
        self.body.close()
        self.archive.close()
        self.file.seek(0)
        write_file(self.folder, name, self.file)
        self.file.close()
        return pa.record_batch([pa.array([name], pa.string())], names=["archive_id"])


def pack_archives(records: DataFrame, folder: str, layouts: list, order: list) -> int:
    """Write one archive per `archive_id`; returns the number of archives.

    Records have `archive_id`, `company`, `layout` (of the archive, a number in `layouts`), `place` (the member's in its
    layout), `record` (see `record_of`) and the columns by which the records of a member are sorted. A layout maps member
    names to DBF fields. A task streams through its archives in order, so that none has to fit in memory.
    """
    tasks = max(2 * records.sparkSession.sparkContext.defaultParallelism, records.count() // RECORDS_PER_TASK)
    dealt = records.repartition(tasks, "archive_id").sortWithinPartitions("archive_id", "place", *order)
    made = dealt.select("archive_id", "company", "layout", "place", "record").mapInArrow(_Packer(folder, layouts), "archive_id string")
    return made.count()
