"""The registered queries of this subpackage, and their SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import corpus_pipeline
from tickerloom.llm.common import let, new_folder, read, words_of
from tickerloom.llm.periodic_runs import periodic_runs
from tickerloom.llm.pieces import decode_documents, encode_documents
from tickerloom.llm.pii import find_personal_data
from tickerloom.llm.quality_lines import clean_lines
from tickerloom.llm.scaled_sketch import as_text, containment, sketch_edits
from tickerloom.llm.simhash import near_duplicates
from tickerloom.llm.sql import LINES_SQL, URLS_SQL
from tickerloom.llm.statistics_qda import score_quality
from tickerloom.llm.template_leaks import leaks
from tickerloom.llm.token_files import read_token_files, write_token_files
from tickerloom.llm.toxic_spans import score_toxicity
from tickerloom.llm.url_cascade import judge_urls
from tickerloom.llm.warc import read_warc, write_warc
from tickerloom.llm.whitening import by_component, whiten

URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
END_ID = 1


def op1_quality_discriminant(spark: SparkSession, folder: str) -> DataFrame:
    return score_quality(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op2_toxic_spans(spark: SparkSession, folder: str) -> DataFrame:
    return score_toxicity(read(spark, folder, "documents"), read(spark, folder, "labels"))


def op3_warc(spark: SparkSession, folder: str) -> DataFrame:
    archives = new_folder(spark, "warc")
    return read_warc(write_warc(read(spark, folder, "pages"), archives), archives)


def op4_template_leaks(spark: SparkSession, folder: str) -> DataFrame:
    return leaks(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op5_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = find_personal_data(read(spark, folder, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans"
    )


def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    encoded = encode_documents(read(spark, folder, "documents").select("doc_id", "text"), model)
    digests = encoded.select(
        "doc_id", (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"), F.sha2("token_ids", 256).alias("ids_sha256"), "token_ids"
    )
    return decode_documents(digests, model).select(
        "doc_id", "n_tokens", "ids_sha256", F.sha2(F.col("decoded_text").cast("binary"), 256).alias("decoded_sha256")
    )


def op7_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    return clean_lines(read(spark, folder, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op8_url_cascade(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return judge_urls(read(spark, folder, "pages").select("page_id", "url"), rules).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op9_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(read(spark, folder, "documents"))


def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    files = new_folder(spark, "ids")
    docs = read(spark, folder, "documents")
    manifest = write_token_files(docs, public_tokenizers.path("word_bpe_49k.json"), files, END_ID)
    return read_token_files(manifest, files).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.crc32("ids").alias("ids_crc32")
    )


def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return by_component(whiten(read(spark, folder, "embeddings"), "embedding", 32))


def with_planted_period(docs: DataFrame) -> DataFrame:
    """doc_id and text; every tenth text, by the id's crc32, repeats some of its words from some place on."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    g = F.floor(h / 10)

    def repeat(words: Column) -> Column:
        n = F.size(words)
        first = g % n
        period = 1 + F.floor((n - first) / (3 + g % 8))
        word = lambda w, i: F.when(i < first, w).otherwise(F.get(words, (first + (i - first) % period).cast("int")))
        return F.when(n > 0, F.array_join(F.transform(words, word), " ")).otherwise("")

    text = F.when(h % 10 == 0, let(words_of(F.coalesce("text", F.lit(""))), repeat)).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(with_planted_period(read(spark, folder, "documents")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    # A line feed after every run: between them, and behind the last.
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    longest = F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("shorter"), r["start"], r["period"])))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        F.col("longest.start").alias("start"),
        (-F.col("longest.shorter")).alias("length"),
        F.col("longest.period").alias("period"),
        F.floor(-1000 * F.col("longest.shorter") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op13_scaled_sketch(spark: SparkSession, folder: str) -> DataFrame:
    return sketch_edits(read(spark, folder, "documents")).select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited_text").cast("binary"), 256).alias("edited_sha256"),
        as_text("sketch").alias("fingerprint"),
        as_text("edited_sketch").alias("edited_fingerprint"),
        containment("sketch", "edited_sketch").alias("near_edited"),
        containment("sketch", "next_sketch").alias("near_next"),
    )


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    return corpus_pipeline.run(spark, folder)


QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_discriminant, op2_toxic_spans, op3_warc, op4_template_leaks, op5_personal_data, op6_sentencepiece,
        op7_line_rules, op8_url_cascade, op9_simhash, op10_token_files, op11_whitening,
        op12_periodic_runs, op13_scaled_sketch, pipeline,
    )
}
ORACLES = {"op7_line_rules": LINES_SQL, "op8_url_cascade": URLS_SQL}
