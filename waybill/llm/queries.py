"""One query for each operator of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .alignment import aligned, link_scores
from .bpe import decoded, encoded
from .decontamination import contaminated
from .jaccard import jaccard_components
from .language import fit_languages, predict_languages
from .lines import without_boilerplate
from .mixing import mixture
from .oracles import ORACLES  # noqa: F401
from .pages import main_texts
from .quality import quality_verdicts
from .runs import periodic_runs
from .secrets import secret_spans
from .shared import Landing
from .tokens import token_table
from .toxicity import fit_toxicity, toxicity_scores


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold(n: int) -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % n


def op1_toxicity(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(_fold(3) == 1, F.lit(False))
    labels = _table(spark, sf_dir, "labels").where(~held_out)
    model = fit_toxicity(docs.where(~held_out), labels)
    return toxicity_scores(docs, model).select("doc_id", held_out.alias("held_out"), "score", "predicted", "excess")


def op2_quality_rules(spark, sf_dir):
    return quality_verdicts(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_token_ids(spark, sf_dir):
    import public_tokenizers

    return token_table(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_mix_sources(spark, sf_dir):
    return mixture(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op5_line_dedup(spark, sf_dir):
    return without_boilerplate(_table(spark, sf_dir, "documents"))


def op6_html_extraction(spark, sf_dir):
    return main_texts(_table(spark, sf_dir, "pages"))


def op7_secret_scan(spark, sf_dir):
    import public_tokenizers

    return secret_spans(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"))


def op8_language_id(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(_fold(5) == 0, F.lit(False))
    model = fit_languages(docs.where(~held_out))
    found = predict_languages(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_ngram_jaccard_join(spark, sf_dir):
    return jaccard_components(_table(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark, sf_dir):
    found = contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "matched_windows", "item_windows", "other_values")


def op11_byte_bpe(spark, sf_dir):
    import public_tokenizers

    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    found = decoded(encoded(_table(spark, sf_dir, "documents"), ranks, pattern), ranks, pattern)
    return found.select(
        "doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("content", 256).alias("decoded_sha256"),
    )


def op12_token_alignment(spark, sf_dir):
    import public_tokenizers

    a, b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    found = aligned(_table(spark, sf_dir, "documents"), a, b)
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    found = found.withColumn("groups_sha256", digest).drop("groups")
    found = link_scores(found, Landing(spark, "alignment"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _with_periods(docs: DataFrame) -> DataFrame:
    """One document in ten, by the crc of its id, repeats a part of its words from some word on to its end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    spaced = F.translate(F.col("text"), "\t\n\x0b\f\r", "     ")
    words = F.filter(F.split(spaced, " "), lambda w: w != "")

    # Arrays of one element bind the words, and then first place and period, to names that are evaluated once.
    def repeated(ws):
        n = F.size(ws)
        a = g % n
        steps = F.array(F.struct(a.alias("a"), (1 + F.floor((n - a) / (3 + g % 8))).alias("p")))

        def written(at):
            return F.transform(ws, lambda w, i: F.when(i < at["a"], w).otherwise(F.get(ws, (at["a"] + (i - at["a"]) % at["p"]).cast("int"))))

        return F.when(n > 0, F.array_join(F.get(F.transform(steps, written), F.lit(0)), " ")).otherwise("")

    planted = F.get(F.transform(F.array(words), repeated), F.lit(0))
    return docs.select("doc_id", F.when(h % 10 == 0, planted).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark, sf_dir):
    found = periodic_runs(_with_periods(_table(spark, sf_dir, "documents")))
    first = F.expr("array_max(transform(runs, r -> struct(r.length as length, -r.start as start, -r.period as period)))")
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    lines = F.concat_ws("", F.transform(lines, lambda line: F.concat(line, F.lit("\n"))))
    return found.withColumn("first", first).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("first.start")).alias("start"), F.col("first.length").alias("length"),
        (-F.col("first.period")).alias("period"), F.expr("1000 * first.length div -first.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES = {
    q.__name__: q
    for q in (
        op1_toxicity, op2_quality_rules, op3_token_ids, op4_mix_sources, op5_line_dedup, op6_html_extraction, op7_secret_scan, op8_language_id, op9_ngram_jaccard_join,
        op10_benchmark_decontamination, op11_byte_bpe, op12_token_alignment, op13_periodic_runs,
    )
}
