"""The corpus pipeline: five stages from `documents` to token ids.

Every stage takes (spark, docs, folder of the tables) and returns a DataFrame; `run` writes
each as Parquet in the shared folder and reads it back as the next one's input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tickerloom.llm.common import read, stored
from tickerloom.llm.pieces import decode_documents, encode_documents
from tickerloom.llm.pii import find_personal_data
from tickerloom.llm.quality_lines import clean_lines
from tickerloom.llm.simhash import near_duplicates
from tickerloom.llm.template_leaks import leaks
from tickerloom.operators.cleaning import keep_first

# Rows depend on trained weights and tokenizer files, which SQL cannot express.
ORACLE_SQL = None


def quality_rules(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that pass the rules, without their failing lines."""
    kept = clean_lines(docs).where("kept")
    changed = F.col("clean_text") != F.coalesce(F.col("text"), F.lit(""))
    columns = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(changed, F.length("clean_text").cast("long")).otherwise(F.col("n_chars"))
    return kept.withColumns(columns).select(*docs.columns)


def _one_row_per_text(docs: DataFrame) -> DataFrame:
    """`docs` with a number in place of each doc_id: one per (doc_id, text), in that order; rows equal in both become one."""
    rest = [name for name in docs.columns if name not in ("doc_id", "text")]
    alone = keep_first(docs, ["doc_id", "text"], rest or ["doc_id"])
    digests = {"d1": F.xxhash64("text"), "d2": F.xxhash64(F.lit("second"), "text")}
    keys = alone.select("doc_id", *[c.alias(n) for n, c in digests.items()]).distinct()
    # Sorted ranges number their rows upwards; the numbers are written down before they are used.
    ranged = keys.repartitionByRange("doc_id", "d1", "d2").sortWithinPartitions("doc_id", "d1", "d2")
    numbered = stored(ranged.withColumn("number", F.monotonically_increasing_id()), "numbers")
    found = alone.select(F.struct(*docs.columns).alias("row"), "doc_id", *[c.alias(n) for n, c in digests.items()])
    return found.join(numbered, ["doc_id", "d1", "d2"]).select("row", F.col("number").alias("doc_id"), F.col("row.text").alias("text"))


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The document with the smallest doc_id of each near-duplicate group; rows without a doc_id stay.

    Rows that repeat doc_id and text become one, the first by the other columns. Different texts under
    one doc_id are documents of their own. Only the ids that go are joined: a few per cent of all,
    broadcast as far as adaptive execution finds them small.
    """
    named = docs.where("doc_id IS NOT NULL")
    repeated = named.groupBy("doc_id").count().where("count > 1")
    rows = named.select("doc_id", "text") if repeated.isEmpty() else stored(_one_row_per_text(named), "rows")
    groups = near_duplicates(rows.select("doc_id", "text"))
    dropped = stored(groups.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct(), "dropped", named.count())
    if "row" not in rows.columns:
        return docs.join(dropped, "doc_id", "left_anti").select(*docs.columns)
    kept = rows.join(dropped, "doc_id", "left_anti").select(*[F.col("row").getField(name).alias(name) for name in docs.columns])
    return kept.unionByName(docs.where("doc_id IS NULL"))


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = stored(leaks(docs, read(spark, folder, "benchmark")).select("doc_id").distinct(), "leaks", docs.count())
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document, with personal data replaced by its kind."""
    found = find_personal_data(docs)
    columns = {"text": F.col("clean_text")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("spans") == "", F.col("n_chars")).otherwise(F.length("clean_text").cast("long"))
    return found.withColumns(columns).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Every document with its token ids, their number and whether decoding gives the text again."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    decoded = decode_documents(encode_documents(docs, model), model)
    return decoded.select(
        *docs.columns,
        "token_ids",
        (F.octet_length("token_ids") / 4).cast("long").alias("n_tokens"),
        (F.col("decoded_text") == F.coalesce(F.col("text"), F.lit(""))).alias("round_trip"),
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, folder), name)
    return docs
