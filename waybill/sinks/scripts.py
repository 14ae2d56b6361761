"""INSERT scripts spliced into templates, one file per archive and script."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .documents import write_documents

# Template marks, line end, code page, and the names of folders and files.
START_MARK, END_MARK = "--START", "--KONIEC"
LINE_END = "\r\n"
SCRIPT_CODEPAGE = "cp1250"
FOLDER_SUFFIX = "_import_danych_startowych"
SCRIPT_FILE = "import_{}.sql"

ROWS_PER_PART = 500_000


def splice(templates: DataFrame) -> DataFrame:
    """Cut each template around the rows to be put in: `script`, `head` (to the start mark), `tail`."""
    start, end = F.instr("text", START_MARK), F.instr("text", END_MARK)
    sound = (start > 0) & (end > start)
    problem = F.raise_error(F.concat(F.lit(f"no {START_MARK} before {END_MARK} in the template of "), "script"))
    head = F.col("text").substr(F.lit(1), start + len(START_MARK) - 1)
    tail = F.col("text").substr(end, F.length("text"))
    return templates.select(
        "script", F.when(sound, head).otherwise(problem).alias("head"), F.when(sound, tail).otherwise(problem).alias("tail")
    )


def file_safe(c: Column) -> Column:
    return F.regexp_replace(c, r'[\\/:*?"<>|]', "_")


def script_folder(company: Column, archive_id: Column) -> Column:
    """Folder of an archive's scripts; two archives may share a company, so both names are in it."""
    archive = F.regexp_replace(archive_id, r"(?i)\.zip$", "")
    return F.concat(file_safe(F.coalesce(company, F.lit(""))), F.lit("_"), file_safe(archive), F.lit(FOLDER_SUFFIX))


def script_lines(
    scripts: DataFrame, templates: DataFrame, manifest: DataFrame, rows_per_part: int = ROWS_PER_PART
) -> DataFrame:
    """Rows of the script files in the shape of the document writer, with `pos` for the order.

    Parts are ranges of record numbers, so a table of any size spreads over many tasks. The template's head
    goes before the first part that has rows, its tail after the last. Scripts without rows give no file.
    """
    body = scripts.withColumn("part", F.floor(F.col("rec_no") / rows_per_part))
    spans = body.groupBy("archive_id", "script").agg(F.min("part").alias("first"), F.max("part").alias("last"))
    cut = spans.join(splice(templates), "script", "left")
    absent = F.raise_error(F.concat(F.lit("no template for script "), "script"))
    frame = cut.select(
        "archive_id", "script",
        F.explode(
            F.array(
                _edge(F.col("first"), 0, F.concat(F.coalesce("head", absent), F.lit(LINE_END))),
                _edge(F.col("last"), (1 << 62), F.coalesce("tail", absent)),
            )
        ).alias("e"),
    ).select("archive_id", "script", "e.*")
    rows = body.select(
        "archive_id", "script", "part", F.col("rec_no").alias("pos"), F.concat("stmt", F.lit(LINE_END)).alias("text")
    )
    names = manifest.select("archive_id", "company")
    lines = rows.unionByName(frame).join(names, "archive_id", "left")
    file = F.format_string(SCRIPT_FILE.replace("{}", "%s"), "script")
    doc = F.concat(script_folder(F.col("company"), F.col("archive_id")), F.lit("/"), file)
    return lines.select(doc.alias("doc"), "part", "pos", "text")


def _edge(part: Column, pos: int, text: Column) -> Column:
    return F.struct(part.alias("part"), F.lit(pos).cast("long").alias("pos"), text.alias("text"))


def write_scripts(
    scripts: DataFrame,
    templates: DataFrame,
    manifest: DataFrame,
    path: str,
    rows_per_part: int = ROWS_PER_PART,
    replace: bool = True,
) -> None:
    """Save `import_<script>.sql` files in the Windows code page."""
    lines = script_lines(scripts, templates, manifest, rows_per_part)
    write_documents(lines, path, ["pos"], SCRIPT_CODEPAGE, replace)
