"""Lines that many sites share are boilerplate and are removed from all documents.

Each line's hash gets a HyperLogLog sketch of the sites it is on; sketches merge as the aggregation goes on, so that a
common line sends one small sketch per map task. Lines whose estimate is clear of the threshold are decided by it, those
near it by an exact count of distinct sites. The hashes found, of a checked number, go to every task, which cuts the
lines out of its texts where they lie; beyond that number they meet the lines in a join of hashes and places.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import Landing, broadcast_if_small
from .words import slices

SITES = 10  # distinct sites from which a line is boilerplate
MARGIN = 0.25  # of the threshold, either side: estimates in between are counted exactly
LG_K = 12  # sketches of 4096 registers have a standard error of 1.6 percent
SENT_HASHES = 500_000  # of 8 bytes each, that are sent to every task at most


def boilerplate_lines(lines: DataFrame, landing: Landing, sites: int = SITES, margin: float = MARGIN) -> DataFrame:
    """(hash) of the lines in `lines(hash, site)` that are on at least `sites` sites; null is no site."""
    site = F.concat(F.lit("="), F.col("site").cast("string"))  # a sketch takes no notice of empty text
    about = F.hll_sketch_estimate(F.hll_sketch_agg(site, LG_K)).alias("about")
    sketched = lines.groupBy("hash").agg(about).where(F.col("about") >= sites * (1 - margin))
    sketched = landing.land(sketched, "sketched")
    clear = sketched.where(F.col("about") > sites * (1 + margin)).select("hash")
    near = sketched.where(F.col("about") <= sites * (1 + margin)).select("hash")
    counted = lines.join(broadcast_if_small(near), "hash", "left_semi").distinct().groupBy("hash").agg(F.count("site").alias("exact"))
    return clear.unionByName(counted.where(F.col("exact") >= sites).select("hash"))


def _line_hashes() -> Column:
    """A hash of each line of `text`, null for blank ones."""
    blank = lambda line: F.translate(line, " \t\x0b\f\r", "") == ""
    return F.transform(F.split("text", "\n"), lambda line: F.when(~blank(line), F.xxhash64(line)))


def _cut(gone: np.ndarray | None):
    """Rows (id, text, hashes of lines, hashes to remove) to (id, n_lines, n_removed, text).

    The hashes to remove are those of `gone`, sorted, or where it is None those of the row.
    """

    def run(batches):
        for batch in slices(batches):
            counts, removed, texts = [], [], []
            for text, hashes, own in zip(*(batch.column(i) for i in (1, 2, 3))):
                text = text.as_py()
                values = hashes.values if text is not None else None
                counts.append(0 if text is None else len(values))
                here = gone if gone is not None else np.sort(own.values.to_numpy(zero_copy_only=False)) if own.is_valid else np.empty(0, np.int64)
                if text is None or not len(here):
                    removed.append(0)
                    texts.append(text)
                    continue
                number = values.fill_null(0).to_numpy(zero_copy_only=False)
                at = np.minimum(np.searchsorted(here, number), len(here) - 1)
                out = (here[at] == number) & values.is_valid().to_numpy(zero_copy_only=False)
                removed.append(int(out.sum()))
                texts.append("\n".join([line for line, o in zip(text.split("\n"), out.tolist()) if not o]) if out.any() else text)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.string())],
                ["id", "n_lines", "n_removed", "text"],
            )

    return run


def without_boilerplate(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", sites: int = SITES,
    sent_hashes: int = SENT_HASHES,
) -> DataFrame:
    """(id, n_lines, n_removed, text) for every row: the text without lines that are on at least `sites` sites.

    Lines end at \\n and are compared as they stand; blank ones stay. A null text stays null, with no lines; an empty
    one has one blank line. A null site counts for nothing, but its documents lose shared lines too. Rows with null
    or repeated ids are each cleaned; other columns are ignored; an empty table gives an empty one. With more than
    `sent_hashes` shared lines texts are shuffled once, to meet the hashes of their own shared lines.
    """
    landing = Landing(docs.sparkSession, "lines")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(site_col).alias("site"))
    hashed = rows.select("id", "text", "site", _line_hashes().alias("hashes"))
    every = hashed.select("site", F.explode("hashes").alias("hash")).where("hash is not null")
    found = landing.land(boilerplate_lines(every, landing, sites), "boilerplate")
    split, own = hashed.select("id", "text", "hashes"), F.lit(None).cast("array<bigint>")
    if found.count() <= sent_hashes:
        gone = np.sort(found.toArrow()["hash"].to_numpy())
        split = split.withColumn("own", own)
    else:
        gone, key = None, F.xxhash64("text", "hashes")
        places = split.select(key.alias("key"), F.explode("hashes").alias("hash")).where("hash is not null").distinct()
        places = places.join(found, "hash", "left_semi").groupBy("key").agg(F.collect_set("hash").alias("own"))
        split = split.withColumn("key", key).join(landing.land(places, "places"), "key", "left").select("id", "text", "hashes", "own")
    schema = T.StructType([split.schema["id"]])
    for field in T.StructType.fromDDL("n_lines long, n_removed long, text string"):
        schema = schema.add(field)
    return split.mapInArrow(_cut(gone), schema).withColumnRenamed("id", id_col)
