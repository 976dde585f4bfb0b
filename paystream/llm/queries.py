"""One query for each operator, over the whole of the table it is meant for."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystream.llm import (
    decontaminate, infill, langid, license, minhash, packing, quality, runs, substring, tokens, toxicity, urlfilter, warc,
)
from paystream.llm.common import held_out, let, shipped, table, word_array

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

#: The rules of the URL query (host, path, verdict), as its contract states them.
URL_RULES = (
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
)
#: Domains that the list blocks on its own account, where no rule fits.
BLOCKED_DOMAINS = ("cheap-pills.example.org", "cheap-pills.example.net", "spam-farm.example.org", "spam-farm.example.net")


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = shipped(f)
    return f


@query
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and detections of every document."""
    found = license.scan(table(spark, sf_dir, "documents"))
    base = F.transform("base", lambda d: d["label"])
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.transform("base", lambda d: d["start"])).cast("long").alias("first_word"),
        F.array_max(F.transform("base", lambda d: d["start"])).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.transform("detections", lambda d: d["label"]))), ",").alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d["score"])), F.lit(0.0)).alias("score"),
    )


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from two thirds of the labels."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(~held_out(F.col("doc_id"))))
    return toxicity.score(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted")
    )


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with copies of benchmark items, and where the copies stand."""
    return decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the url of every page."""
    rules = [(*r, True) for r in URL_RULES] + [(d, "", "block", False) for d in BLOCKED_DOMAINS]
    index = urlfilter.build_index(spark.createDataFrame(rules, urlfilter.RULE_SCHEMA))
    return urlfilter.judge(table(spark, sf_dir, "pages"), index).select("page_id", "host", "path", "rule", "verdict")


@query
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the runs of 13 words that an earlier one has."""
    left = substring.deduplicate(table(spark, sf_dir, "documents"), window=13, with_text=False)
    return left.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to an archive and read back."""
    records = warc.archive(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of every document and whether the rules keep it."""
    judged = quality.verdicts(quality.measure(table(spark, sf_dir, "documents")))
    base = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base.alias("base_failed"), (~base & (F.size("failed") == 0)).alias("kept"),
    )


@query
def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share four fifths of their pairs of words."""
    found = minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences, one row per piece."""
    packed = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of them."""
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~held_out(F.col("doc_id"))))
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, and whether it is longer than 2048 tokens."""
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 2048)


@query
def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document rearranged, as digests of what came out and of the text put back together."""
    rows = infill.restore(infill.fill_in_middle(table(spark, sf_dir, "documents")))
    return rows.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )


@query
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document; those whose id's checksum ends in 0 repeat from some word on."""
    docs = table(spark, sf_dir, "documents")
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))

    def repeated(words: Column) -> Column:
        n, g = F.size(words).cast("long"), F.floor(h / 10)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        tail = F.slice(words, (a + 1).cast("int"), p.cast("int"))
        copies = F.flatten(F.array_repeat(tail, F.ceil((n - a) / p).cast("int")))
        return F.array_join(F.slice(F.concat(F.slice(words, F.lit(1), a.cast("int")), copies), F.lit(1), n.cast("int")), " ")

    given = F.when(h % 10 != 0, F.col("text")).otherwise(
        let(word_array(F.col("text")), lambda w: F.when(F.size(w) > 0, repeated(w)))
    )
    found = runs.periodic_runs(docs.select("doc_id", given.alias("text")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    # Structs are compared field by field.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), -r["start"], -r["period"])))
    best = best.cast("struct<length:long,start:long,period:long>")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"), (-F.col("best.period")).alias("period"),
        F.floor(F.col("best.length") * 1000 / -F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
