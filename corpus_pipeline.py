"""Corpus pipeline: toxic texts, near duplicates and benchmark leaks go,
personal data is hidden, what stays is encoded.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a table; all but the last return the columns of ``documents``.
Rows are told apart by their place in the stored table, not by ``doc_id``: of
rows that repeat an id each is judged by its own text, and rows without an id
as all others. Of a group of near copies the row with the least ``doc_id``
stays (NULL last, then the row stored first). An empty table stays empty; NULL
texts pass the filters and encode as empty; texts of any length are read whole;
further columns are kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.llm import decontaminate, jaccard_join, pii, sentencepiece, toxicity
from dimwright.llm.common import store, table
from dimwright.llm.queries import public_model, training_labels


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose score stays under the bar."""
    scorer = toxicity.Scorer(training_labels(spark, sf_dir))
    return scorer.rows(docs, "text").filter(F.col("score") < toxicity.BAR).select("row.*")


def _numbered(docs: DataFrame) -> DataFrame:
    """(row, row_id, doc_id, body): a number for each row of ``docs``, stored with it;
    every text is stored once."""
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("row_id"))
    stored = store(rows, "numbered")
    return stored.select("row", "row_id", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("body"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every component of near copies."""
    rows = _numbered(docs)
    groups = jaccard_join.near_duplicates(rows, "row_id", "body").select(
        F.col("doc_id").alias("row_id"), "component_id"
    )
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row_id")
    named = groups.join(rows.select("row_id", "doc_id"), "row_id")
    best = named.groupBy("component_id").agg(F.min_by("row_id", order).alias("row_id"))
    kept = store(best.select("row_id"), "kept")
    return rows.join(kept, "row_id", "left_semi").select("row.*")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without a consistent match of a benchmark item."""
    rows = _numbered(docs)
    found = decontaminate.find_leaks(rows, table(spark, sf_dir, "benchmark"), "row_id", "body")
    leaks = store(found.filter("consistent").select(F.col("doc_id").alias("row_id")).distinct(), "leaks")
    return rows.join(leaks, "row_id", "left_anti").select("row.*")


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data and disclosing terms replaced, and their new length."""
    clean = pii.sanitise(docs, "text")
    if "n_chars" in clean.columns:
        kind = clean.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids in place of the text, and the digest of what they decode to."""
    coded = sentencepiece.encode_texts(docs, "text", public_model())
    return coded.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("pii", hide_personal_data),
    ("sentencepiece", encode),
]
# Stages train, iterate and tokenise; tests compare them with brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is stored and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
