"""Tables, manifests and templates out of directories of ZIP archives.

Spark lists the archives, and their central directories say which members are wanted and how large they are. Small
archives and single members of large ones are dealt out evenly by size; a task opens what it was dealt and reads each member
once, from begin to end: records, faults and the manifest come out of the same pass. Only members that are stored
without compression are cut into ranges of records. Cells leave a task as canonical text, which depends on their own
archive alone; what can't be read goes beside it.
"""

from __future__ import annotations

import os
import re
import struct
import tempfile
import uuid
import zipfile
import zlib
from contextlib import contextmanager
from functools import partial
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.codepages import decode
from ..functions.scalars import CLEAN, trimmed
from .dbf import ISO_DATE, read_columns, read_header

# Code pages of tables and templates, and the names the manifest is found by.
TABLE_CODEPAGE = "cp852"
TEMPLATE_CODEPAGE = "cp1250"
MANIFEST_PREFIX, MANIFEST_SUFFIX = "archiwuminfo_", ".rtf"
COMPANY_LABEL, LICENCE_LABEL = "Dane firmy:", "Licencja:"

SPLIT_BYTES = 64 << 20  # of unpacked tables that one task reads, or one packed member
CHECK = -1  # part of a stored member that reads it to its end for the check sum, beside the ranges
TEXT_KINDS = "CNFDLI"  # fields that are text; all others are binary


@contextmanager
def open_path(uri: str):
    """Open a file by the name Spark lists it under."""
    if uri.startswith("file:"):
        with open(re.sub(r"^file:/+", "/", uri), "rb") as f:
            yield f
    else:
        from pyarrow import fs

        system, name = fs.FileSystem.from_uri(re.sub(r"^s3[an]:", "s3:", uri))
        with system.open_input_file(name) as f:
            yield f


def base_name(member: str) -> str:
    return member.replace("\\", "/").rsplit("/", 1)[-1].lower()


def table_of(member: str) -> str | None:
    name = base_name(member)
    return name[:-4] if name.endswith(".dbf") else None


def first_member(archive: zipfile.ZipFile, test) -> zipfile.ZipInfo | None:
    return next((m for m in archive.infolist() if test(m.filename)), None)


def list_archives(spark: SparkSession, path: str) -> DataFrame:
    """Archives below a directory: `archive_id` (path below it), `path`, `length`. Contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.[zZ][iI][pP]")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )
    root = path.rstrip("/") if "://" in path else re.sub(r"^file:/+", "/", path)
    root = (root if "://" in root else os.path.abspath(root)) + "/"
    at = F.locate(root, F.col("path"))
    below = F.when(at > 0, F.col("path").substr(at + len(root), F.length("path")))
    name = F.coalesce(below, F.substring_index("path", "/", -1))
    return files.select(name.alias("archive_id"), "path", "length")


def _per_archive(batches, read, columns: tuple, guard: bool):
    """Run `read(archive, row)` for every listed archive; `guard` passes over files that are no archives."""
    for batch in batches:
        for row in batch.select(list(columns)).to_pylist():
            with open_path(row["path"]) as f:
                try:
                    archive = zipfile.ZipFile(f)
                except zipfile.BadZipFile as problem:
                    if guard:
                        continue
                    yield from read(None, row, str(problem))
                    continue
                with archive:
                    yield from read(archive, row, None)


MEMBERS = "array<struct<member:string,table:string,manifest:boolean,size:bigint,stored:boolean>>"
DIRECTORY_SCHEMA = f"archive_id string, path string, error string, members {MEMBERS}"
MEMBER_SCHEMA = "archive_id string, member string, table string, size long, error string"


def is_manifest(member: str) -> bool:
    name = base_name(member)
    return name.startswith(MANIFEST_PREFIX) and name.endswith(MANIFEST_SUFFIX)


def _directory_of(archive, row, problem):
    members, seen, manifest = [], set(), False
    for m in archive.infolist() if archive is not None else ():
        table = table_of(m.filename)
        if m.is_dir() or table in seen:
            continue
        if table is not None:
            seen.add(table)
        first = is_manifest(m.filename) and not manifest
        manifest |= first
        stored = m.compress_type == zipfile.ZIP_STORED and not m.flag_bits & 1
        members.append({"member": m.filename, "table": table, "manifest": first, "size": m.file_size, "stored": stored})
    kind = pa.struct(
        [("member", pa.string()), ("table", pa.string()), ("manifest", pa.bool_()), ("size", pa.int64()), ("stored", pa.bool_())]
    )
    arrays = [pa.array([v], k) for v, k in ((row["archive_id"], pa.string()), (row["path"], pa.string()), (problem, pa.string()), (members, pa.list_(kind)))]
    yield pa.record_batch(arrays, names=["archive_id", "path", "error", "members"])


def archive_directory(spark: SparkSession, path: str) -> DataFrame:
    """Central directory of every archive; of equal table names, ignoring case and folder, the first one counts.

    A file that is no archive has `error` set and no members.
    """
    read = partial(_per_archive, read=_directory_of, columns=("archive_id", "path"), guard=False)
    return list_archives(spark, path).mapInArrow(read, DIRECTORY_SCHEMA)


def _members(directory: DataFrame) -> DataFrame:
    rows = directory.select("archive_id", "error", F.explode_outer("members").alias("m")).where("error is not null or m is not null")
    return rows.select("archive_id", "m.member", "m.table", "m.size", "error")


def list_members(spark: SparkSession, path: str) -> DataFrame:
    """Members of every archive; a file that is no archive gives one row with `error` set."""
    return _members(archive_directory(spark, path))


def _units(directory: DataFrame, tables: list[str], manifest: bool, check_only: bool) -> DataFrame:
    """What is read in one go: (archive_id, path, unit, items, cost), items (member, table, part, parts).

    An archive whose wanted members are small is one unit, else each member is, or each range of a stored one.
    """
    m, split = F.col("m"), F.lit(SPLIT_BYTES)
    wanted = F.filter("members", lambda m: F.coalesce(m["table"].isin(tables), F.lit(False)) | (m["manifest"] & F.lit(manifest)))
    some = directory.select("archive_id", "path", wanted.alias("wanted")).where(F.size("wanted") > 0)
    total = F.aggregate("wanted", F.lit(0).cast("long"), lambda sum_, m: sum_ + m["size"])
    each = some.select("archive_id", "path", total.alias("total"), F.explode("wanted").alias("m"))
    ranged = m["stored"] & (m["size"] > split) & m["table"].isNotNull()
    parts = F.when(F.lit(check_only) | ~ranged, F.lit(1)).otherwise(F.ceil(m["size"] / split).cast("int"))
    first = F.when((F.col("parts") > 1) | F.lit(check_only) & m["table"].isNotNull(), F.lit(CHECK)).otherwise(F.lit(0))
    last = F.when(F.lit(check_only) & m["table"].isNotNull(), F.lit(CHECK)).otherwise(F.col("parts") - 1)
    each = each.withColumn("parts", parts).withColumn("part", F.explode(F.sequence(first, last)))
    name = F.when(F.col("total") <= split, F.lit("")).otherwise(F.concat(m["member"], F.lit("/"), F.col("part")))
    item = F.struct(m["member"].alias("member"), m["table"].alias("table"), "part", "parts")
    grouped = each.groupBy("archive_id", "path", name.alias("unit"))
    return grouped.agg(F.sort_array(F.collect_list(item)).alias("items"), F.sum(m["size"] / F.col("parts")).cast("long").alias("cost"))


def _dealt(units: DataFrame) -> DataFrame:
    """Units in tasks of like size: sorted by cost into ranges, and dealt out in turn within each range; a few as they come."""
    count, cost = units.agg(F.count(F.lit(1)), F.sum("cost")).first()
    tasks = max(1, min(count, max(2 * units.sparkSession.sparkContext.defaultParallelism, (cost or 0) // SPLIT_BYTES)))
    if (cost or 0) < SPLIT_BYTES:  # all of it is less than a task reads
        return units.repartition(tasks)
    order = [F.desc("cost"), "archive_id", "unit"]
    ranged = units.repartitionByRange(min(tasks, 200), *order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()  # the range in the upper bits, the place in it in the lower 33
    place = (F.shiftright(number, 33) + number.bitwiseAND((1 << 33) - 1)) % tasks
    return ranged.withColumn("place", place.cast("int")).repartitionById(tasks, "place")


# What a damaged, encrypted or cut member raises while it is read.
UNREADABLE = (zipfile.BadZipFile, zlib.error, ValueError, EOFError, RuntimeError, NotImplementedError, struct.error)
FAULT_COLUMNS = ("archive_id", "table", "fault", "fatal")
ROW, FAULT, MANIFEST = "row", "fault", "manifest"


def _scan_schema(width: int) -> T.StructType:
    """Rows of all kinds; tables have as many of the columns c0, c1 ... as they have."""
    cells = "".join(f", c{i} string" for i in range(width))
    return T.StructType.fromDDL(
        "archive_id string, rec_no bigint, unread map<string,string>, data binary, fault string, fatal boolean" + cells
        + ", entry string, table string"
    )


class _Scanner:
    """Reads the members of units; see `scan_archives`."""

    def __init__(self, columns: dict[str, list[str]], codepage: str, dates: str, strict: bool, binary: bool):
        self.columns, self.codepage, self.dates, self.strict, self.binary = columns, codepage, dates, strict, binary
        self.width = max(map(len, columns.values()), default=0)

    def __call__(self, batches):
        for batch in batches:
            for unit in batch.select(["archive_id", "path", "items"]).to_pylist():
                with open_path(unit["path"]) as f, zipfile.ZipFile(f) as archive:
                    for item in unit["items"]:
                        yield from self.read(archive, unit["archive_id"], item)

    def batch(self, archive_id: str, entry: str, table: str | None, n: int = 1, cells=(), **given) -> pa.RecordBatch:
        kinds = {"rec_no": pa.int64(), "unread": pa.map_(pa.string(), pa.string()), "data": pa.binary(), "fault": pa.string(), "fatal": pa.bool_()}
        columns = {"archive_id": pa.repeat(archive_id, n)}
        columns |= {name: given.get(name, pa.nulls(n, kind)) for name, kind in kinds.items()}
        columns |= {f"c{i}": cells[i] if i < len(cells) else pa.nulls(n, pa.string()) for i in range(self.width)}
        columns |= {"entry": pa.repeat(entry, n), "table": pa.repeat(table or entry, n)}
        return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    def fault(self, archive_id: str, table: str, text: str, fatal: bool) -> pa.RecordBatch:
        return self.batch(archive_id, FAULT, table, fault=pa.array([text]), fatal=pa.array([fatal]))

    def read(self, archive: zipfile.ZipFile, archive_id: str, item: dict):
        table = item["table"]
        try:
            if table is None:
                yield self.batch(archive_id, MANIFEST, None, data=pa.array([archive.read(item["member"])], pa.binary()))
                return
            with archive.open(item["member"]) as stream:
                yield from self.records(stream, archive_id, table, item["part"], item["parts"])
        except UNREADABLE as problem:
            if table is None:
                return  # an archive without a readable manifest
            if self.strict:
                raise _damaged(archive_id, table, problem) from problem
            yield self.fault(archive_id, table, str(problem), True)

    def records(self, stream, archive_id: str, table: str, part: int, parts: int):
        header, seen = read_header(stream), 0
        names = self.columns[table]
        if part != CHECK:
            kinds = {f.name: f.kind for f in header.fields}
            wanted = [n for n in names if n in kinds and (self.binary or kinds[n] in TEXT_KINDS)]
            start, stop = (header.records * p // parts for p in (part, part + 1))
            for got, rec_no, cells, unread in read_columns(stream, header, wanted, start, stop, self.codepage, self.dates):
                seen += got
                n = len(rec_no)
                texts = [cells.get(c, pa.nulls(n, pa.string())) for c in names]
                yield self.batch(archive_id, ROW, table, n, texts, rec_no=pa.array(rec_no), unread=unread)
        if part == CHECK or parts == 1:
            size = 0
            while block := stream.read(1 << 20):  # the check sum is compared at the end of the member
                size += len(block)
            if part == CHECK:
                seen = size // max(1, header.record_length)
            if seen < header.records:
                yield self.fault(archive_id, table, f"{header.records} records declared, {seen} found", False)


def _scan(
    directory: DataFrame, columns: dict[str, list[str]], manifest: bool, codepage: str = TABLE_CODEPAGE, dates: str = ISO_DATE,
    strict: bool = False, binary: bool = False, check_only: bool = False,
) -> DataFrame:
    scanner = _Scanner(columns, codepage, dates, strict, binary)
    return _dealt(_units(directory, list(columns), manifest, check_only)).mapInArrow(scanner, _scan_schema(scanner.width))


def _table(found: DataFrame, table: str, names: list[str], faults: DataFrame | None) -> DataFrame:
    """Rows of one table in canonical text, without tables that can't be read to their end."""
    cells = [F.col(f"c{i}").alias(n, metadata={CLEAN: True}) for i, n in enumerate(names)]
    rows = found.where((F.col("entry") == ROW) & (F.col("table") == table)).select("archive_id", "rec_no", *cells, "unread")
    if faults is None:
        return rows
    return rows.join(faults.where(F.col("fatal") & (F.col("table") == table)).select("archive_id"), "archive_id", "left_anti")


class Archives(NamedTuple):
    """What one pass over all archives gives; see `scan_archives`."""

    directory: DataFrame
    members: DataFrame
    manifest: DataFrame
    faults: DataFrame
    tables: dict[str, DataFrame]


def scan_archives(
    spark: SparkSession, path: str, columns: dict[str, list[str]], landing: str | None = None,
    codepage: str = TABLE_CODEPAGE, dates: str = ISO_DATE,
) -> Archives:
    """Members, manifests, faults and the given columns of the given tables, each member being read once.

    Tables have `archive_id`, `rec_no` (the record's place in its file counting deleted records, which are left out),
    the columns as canonical text, and `unread`, the texts of cells that are not what their field says by column
    name. A column that an archive lacks is null there, as are binary fields. Tables that can't be read to their end are left
    out whole and named in `faults`, as are those with fewer records than declared. With a `landing` folder all of it is
    written there once, as Parquet; without one, every use of a result reads the archives again.
    """
    directory = archive_directory(spark, path)
    if landing is not None:
        directory.write.mode("overwrite").parquet(f"{landing}/directory")
        directory = spark.read.schema(DIRECTORY_SCHEMA).parquet(f"{landing}/directory")
    found = _scan(directory, columns, True, codepage, dates)
    if landing is not None:
        schema = found.schema
        found.write.mode("overwrite").partitionBy("entry", "table").parquet(f"{landing}/scan")
        found = spark.read.schema(schema).parquet(f"{landing}/scan")
    faults = found.where(F.col("entry") == FAULT).select(*FAULT_COLUMNS)
    damaged = faults if landing is None or not faults.where("fatal").isEmpty() else None
    manifest = _manifest(directory, found.where(F.col("entry") == MANIFEST).select("archive_id", "data"))
    tables = {t: _table(found, t, names, damaged) for t, names in columns.items()}
    return Archives(directory, _members(directory), manifest, faults, tables)


def table_faults(spark: SparkSession, path: str, tables: list[str]) -> DataFrame:
    """Tables that can't be read (`fatal`) or have fewer records than declared, of all archives below `path`."""
    found = _scan(archive_directory(spark, path), {t: [] for t in tables}, False, check_only=True)
    return found.where(F.col("entry") == FAULT).select(*FAULT_COLUMNS)


FIELD_SCHEMA = "table string, ordinal int, name string, kind string, length int, decimals int"


def _damaged(archive_id: str, table: str, problem: Exception) -> ValueError:
    return ValueError(f"{table} of {archive_id} can't be read: {problem}")


def _fields_of(archive, row, problem, tables, strict):
    out = []
    for table in tables:
        member = first_member(archive, lambda m: table_of(m) == table)
        if member is not None:
            try:
                with archive.open(member) as stream:
                    header = read_header(stream)
            except UNREADABLE as problem:
                if strict:
                    raise _damaged(row["archive_id"], table, problem) from problem
                continue  # `table_faults` names it
            out += [(table, i, f.name, f.kind, f.length, f.decimals) for i, f in enumerate(header.fields)]
    kinds = [pa.string(), pa.int32(), pa.string(), pa.string(), pa.int32(), pa.int32()]
    names = ["table", "ordinal", "name", "kind", "length", "decimals"]
    if out:
        yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)


def table_fields(archives: DataFrame, tables: list[str], strict: bool = False) -> dict[str, dict[str, T.DataType]]:
    """Columns of each table over all archives, as Spark types wide enough for every archive.

    Only headers are read, and they are merged on the executors: one row per column name comes back. A header that
    can't be read is passed over, or raises if `strict`.
    """
    read = partial(
        _per_archive, read=partial(_fields_of, tables=tables, strict=strict), columns=("archive_id", "path"), guard=True
    )
    rows = (
        archives.mapInArrow(read, FIELD_SCHEMA)
        .groupBy("table", "name")
        .agg(
            F.min("ordinal").alias("ordinal"),
            F.collect_set("kind").alias("kinds"),
            F.max(F.col("length") - F.col("decimals") - F.when(F.col("decimals") > 0, 1).otherwise(0)).alias("whole"),
            F.max("decimals").alias("decimals"),
        )
        .orderBy("table", "ordinal", "name")
        .collect()
    )
    found: dict = {t: {} for t in tables}
    for r in rows:
        found[r["table"]][r["name"]] = _type_of(set(r["kinds"]), r["whole"], r["decimals"])
    return found


def _type_of(kinds: set, whole: int, decimals: int) -> T.DataType:
    if kinds == {"N"}:
        digits = max(1, max(whole, 0) + decimals)
        return T.DecimalType(digits, decimals) if digits <= 38 else T.StringType()  # as text no digit is lost
    single = {"C": T.StringType(), "F": T.DoubleType(), "D": T.DateType(), "L": T.BooleanType(), "I": T.IntegerType()}
    if len(kinds) == 1:
        return single.get(next(iter(kinds)), T.BinaryType())
    return T.StringType()


def _typed(name: str, kind: T.DataType) -> Column:
    """Canonical text as a value of the type."""
    c = F.col(name)
    if isinstance(kind, T.StringType):
        return c
    if isinstance(kind, T.BooleanType):
        return c == "True"
    if isinstance(kind, T.BinaryType):
        return F.encode(c, "ISO-8859-1")
    return c.try_cast(kind)


def landing_folder(spark: SparkSession) -> str | None:
    """New folder for written tables: in the cluster's shared folder if it names one, local only in local mode.

    It goes when the session ends.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None and not spark.sparkContext.master.startswith("local"):
        return None
    root = shared.rstrip("/") if shared else "file://" + tempfile.mkdtemp(prefix="tables-")
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/tables-{uuid.uuid4().hex}")
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).deleteOnExit(folder)
    return folder.toString()


def read_table(
    spark: SparkSession, path: str, table: str, columns: list[str] | None = None, codepage: str = TABLE_CODEPAGE,
    faults: DataFrame | None = None,
) -> DataFrame:
    """One table of all archives below `path`; one that can't be read to its end raises.

    Columns have the type that all archives' headers agree on; where they don't, the canonical text of each cell, which
    is the same beside any other archive. Cells that are not what their field says are null, and `scan_archives` names
    them. `columns` limits what is read; one that no archive has comes out as null text. With `faults`, the result of
    `table_faults`, tables that can't be read to their end are left out whole.
    """
    table = table.lower().removesuffix(".dbf")
    directory, folder = archive_directory(spark, path), landing_folder(spark)
    if folder is not None:
        directory.write.parquet(f"{folder}/directory")
        directory = spark.read.schema(DIRECTORY_SCHEMA).parquet(f"{folder}/directory")
    types = table_fields(directory.where("error is null"), [table], strict=faults is None)[table]
    names = columns or list(types)
    found = _scan(directory, {table: names}, False, codepage, strict=faults is None, binary=True)
    rows = _table(found, table, names, faults)
    return rows.select("archive_id", "rec_no", *[_typed(n, types.get(n, T.StringType())).alias(n) for n in names])


# Escapes are parked on private characters while control words and groups are removed.
_PARKED = {"\\\\": "\ue000", "\\{": "\ue001", "\\}": "\ue002"}
_HIDDEN = r"^\{\\(?:\*|fonttbl|colortbl|stylesheet|info|pict)"


def _without_hidden_groups(rtf: Column) -> Column:
    """The text without groups that are no text of the document, however deep groups lie within them.

    A fold over the pieces that begin with a brace counts the depth, and leaves out all from the brace that opens such a
    group to the one that closes it.
    """
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("hidden"), F.array().cast("array<string>").alias("kept"))

    def step(acc: Column, piece: Column) -> Column:
        opens, closes = piece.startswith("{"), piece.startswith("}")
        depth = acc["depth"] + opens.cast("int")
        hidden = F.when((acc["hidden"] == 0) & piece.rlike(_HIDDEN), depth).otherwise(acc["hidden"])
        ends = closes & (hidden == depth)
        kept = F.when(ends, F.substring(piece, 2, 1 << 30)).when(hidden == 0, piece).otherwise("")
        return F.struct(
            (depth - closes.cast("int")).alias("depth"), F.when(ends, 0).otherwise(hidden).alias("hidden"),
            F.concat(acc["kept"], F.array(kept)).alias("kept"),
        )

    return F.aggregate(F.split(rtf, r"(?=[{}])"), start, step, lambda acc: F.array_join(acc["kept"], ""))


def rtf_text(rtf: Column) -> Column:
    """Plain text of an RTF document, paragraphs ending in newlines; other text passes unchanged."""
    c = F.regexp_replace(rtf, r"[\r\n]+", "")
    for escape, parked in _PARKED.items():
        c = F.replace(c, F.lit(escape), F.lit(parked))
    c = _without_hidden_groups(c)
    c = F.regexp_replace(c, r"\\(?:par|line|sect|page)(?![a-z])(?:-?\d+)? ?", "\n")
    c = F.regexp_replace(c, r"\\tab(?![a-z]) ?", "\t")
    c = F.regexp_replace(c, r"\\~", "\u00a0")
    c = _replace_escapes(c, "\\u", r"^(-?\d+) ?(?:\\'[0-9a-fA-F]{2}|\?)?", _unicode_char)
    c = _replace_escapes(c, "\\'", r"^([0-9a-fA-F]{2})", lambda h: decode(F.unhex(h), TEMPLATE_CODEPAGE))
    c = F.regexp_replace(c, r"\\[a-zA-Z]+(?:-?\d+)? ?|\\[^a-zA-Z]|[{}]", "")
    for escape, parked in _PARKED.items():
        c = F.replace(c, F.lit(parked), F.lit(escape[1:]))
    return F.when(F.ltrim(rtf).startswith("{\\rtf"), c).otherwise(rtf)


def _unicode_char(number: Column) -> Column:
    code = F.pmod(number.cast("int"), F.lit(65536))
    return F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")


def _replace_escapes(c: Column, mark: str, pattern: str, char) -> Column:
    """Replace every `mark` followed by `pattern` with the character its first group names."""
    pieces = F.split(c, re.escape(mark) + ("(?=-?[0-9])" if mark == "\\u" else ""))

    def piece(text: Column, i: Column) -> Column:
        code = F.regexp_extract(text, pattern, 1)
        put = F.concat(char(code), F.regexp_replace(text, pattern, ""))
        return F.when((i == 0) | (code == ""), text).otherwise(put)

    return F.array_join(F.transform(pieces, piece), "")


def labelled_line(lines: Column, label: str) -> Column:
    return trimmed(F.get(F.filter(lines, lambda x: F.contains(x, F.lit(label))), F.lit(0)))


def _manifest(directory: DataFrame, found: DataFrame) -> DataFrame:
    text = rtf_text(decode(F.col("data"), TEMPLATE_CODEPAGE))
    lines = F.split(text, r"\r?\n")
    rows = directory.select("archive_id").join(found, "archive_id", "left").select(
        "archive_id",
        labelled_line(lines, COMPANY_LABEL).alias("company_line"),
        labelled_line(lines, LICENCE_LABEL).alias("licence_line"),
    )
    company = trimmed(F.split_part("company_line", F.lit(":"), F.lit(2)))
    return rows.select("archive_id", company.alias("company"), "company_line", "licence_line")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per archive: `company` (between the first two colons), `company_line`, `licence_line`.

    All three are null where the archive has no manifest or the manifest lacks the line.
    """
    directory = archive_directory(spark, path)
    found = _scan(directory, {}, True).where(F.col("entry") == MANIFEST).select("archive_id", "data")
    return _manifest(directory, found)


def read_template(spark: SparkSession, path: str, codepage: str = TEMPLATE_CODEPAGE) -> DataFrame:
    """Script templates `import_<script>.sql` of a folder: `script`, `text`."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "import_*.sql").load(path)
    script = F.regexp_extract("path", r"import_([^/]*)\.sql$", 1)
    return files.select(script.alias("script"), decode(F.col("content"), codepage).alias("text"))
