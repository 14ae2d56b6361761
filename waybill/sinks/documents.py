"""Writer of named text files in a code page, from rows that are already in order.

Input rows: `doc` (file name below the output folder), `part` and `text` (written as it stands, line ends
included). The first part of a document has the document's name, the others `name.part00001.ext` and so on, however many
there are; put together in order they give the document: no task and no file has to take a whole one of any size.

Tasks write below a staging folder and note what they wrote in a table, of which Spark keeps the rows of each task once.
When all are through, names are worked out and files moved by Spark jobs too. A repeated task finds what is moved already
and goes on, so a lost executor leaves no partial document, and the driver sees no list of files.
"""

from __future__ import annotations

import os
import uuid
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STAGED = "doc string, part long, file string"


def file_system(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), os.path.abspath(path)
    scheme, rest = path.split("://", 1)
    return fs.FileSystem.from_uri(f"{'s3' if scheme in ('s3a', 's3n') else scheme}://{rest}")


def part_name(doc: Column, index: Column) -> Column:
    """File name of a part by its place in the document, counted from 0."""
    ending = F.regexp_extract(doc, r"(\.[^./]*)$", 1)
    stem = F.substring(doc, F.lit(1), F.length(doc) - F.length(ending))
    return F.when(index == 0, doc).otherwise(F.concat(stem, F.format_string(".part%05d", index), ending))


def doc_of(file: Column) -> Column:
    """Document a file belongs to, by its name."""
    return F.regexp_replace(file, r"\.part\d{5,}(\.[^./]*)?$", "$1")


def _stage(batches, folder: str, encoding: str):
    """Write each run of rows with equal document and part to a file of its own; tells which is which."""
    system, root = file_system(folder)
    system.create_dir(root, recursive=True)
    current, out, made = None, None, []

    def told():
        arrays = [pa.array(c, k) for c, k in zip(zip(*made), (pa.string(), pa.int64(), pa.string()))]
        made.clear()
        return pa.record_batch(arrays, names=["doc", "part", "file"])

    try:
        for batch in batches:
            docs, parts, texts = (batch.column(n).to_pylist() for n in ("doc", "part", "text"))
            start = 0
            for i in range(1, len(docs) + 1):
                if i < len(docs) and docs[i] == docs[start] and parts[i] == parts[start]:
                    continue
                if (docs[start], parts[start]) != current:
                    if out is not None:
                        out.close()
                    current, file = (docs[start], parts[start]), uuid.uuid4().hex
                    out = system.open_output_stream(f"{root}/{file}")
                    made.append((*current, file))
                out.write("".join(texts[start:i]).encode(encoding, "replace"))
                start = i
            if len(made) >= 10_000:
                yield told()
    finally:
        if out is not None:
            out.close()
    if made:
        yield told()


def _finish(batches, root: str, staging: str):
    """Move staged files to their names, and delete files without one; both may have been done before."""
    from pyarrow import fs

    system, folder = file_system(root)
    _, staged = file_system(staging)
    known, count = set(), 0
    for batch in batches:
        for file, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            target = f"{folder}/{target}"
            there = system.get_file_info(target).type == fs.FileType.File
            if file is None:
                if there:
                    system.delete_file(target)
            elif system.get_file_info(f"{staged}/{file}").type == fs.FileType.File:
                if there:
                    system.delete_file(target)
                parent = os.path.dirname(target)
                if parent not in known:
                    system.create_dir(parent, recursive=True)
                    known.add(parent)
                system.move(f"{staged}/{file}", target)
            elif not there:
                raise FileNotFoundError(f"{staged}/{file} of {target}")
            count += 1
    yield pa.record_batch([pa.array([count], pa.int64())], names=["files"])


def _files_below(spark: SparkSession, root: str) -> DataFrame:
    """(file), paths below the folder as they are now."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    tail = spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getPath().rstrip("/") + "/"
    return listed.select(F.col("path").substr(F.locate(tail, F.col("path")) + len(tail), F.length("path")).alias("file"))


def _holds_files(system, folder) -> bool:
    """Whether the folder has any entry of an earlier writing; looks no further than the first one."""
    entries = system.listStatusIterator(folder)
    while entries.hasNext():
        if not entries.next().getPath().getName().startswith(("_", ".")):
            return True
    return False


def write_documents(
    lines: DataFrame, path: str, order: list[str], encoding: str = "utf-8", replace: bool = True
) -> None:
    """Write rows `doc`, `part`, `text`, sorted by `order` within each part.

    Files of an earlier writing of the same documents are replaced, parts that are no more included; without `replace` they
    are an error, and nothing is written.
    """
    spark = lines.sparkSession
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    root = system.makeQualified(folder).toString()
    staging = f"{root}/_staging-{uuid.uuid4().hex}"
    placed = lines.repartition("doc", "part").sortWithinPartitions("doc", "part", *order)
    try:
        staged = placed.select("doc", "part", "text").mapInArrow(partial(_stage, folder=staging, encoding=encoding), STAGED)
        staged.write.parquet(f"{staging}/_names")
        files = spark.read.schema(STAGED).parquet(f"{staging}/_names")
        place = F.row_number().over(Window.partitionBy("doc").orderBy("part")) - 1
        targets = files.select("file", part_name(F.col("doc"), place).alias("target"))
        actions = targets
        if _holds_files(system, folder):
            docs = files.select("doc").distinct()
            old = _files_below(spark, root).withColumn("doc", doc_of(F.col("file"))).join(docs, "doc", "left_semi").select(F.col("file").alias("target"))
            if not replace and (first := old.first()) is not None:
                raise FileExistsError(f"already written: {first['target']}")
            gone = old.join(targets, "target", "left_anti").select(F.lit(None).cast("string").alias("file"), "target")
            actions = targets.unionByName(gone)
        actions = actions.repartition(2 * spark.sparkContext.defaultParallelism)
        actions.mapInArrow(partial(_finish, root=root, staging=staging), "files long").agg(F.sum("files")).first()
    finally:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(staging), True)
