"""The text operators on the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.llm import (
    collocations,
    decontaminate,
    importance,
    interpolation,
    jaccard_join,
    language_id,
    licenses,
    pii,
    quality,
    sentencepiece,
    toxicity,
    url_filter,
    vector_search,
)
from dimwright.llm.common import fold, table

# Fixed values of the query contract.
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged by the rules, else by the list of addresses fetched
    under several names."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = url_filter.stored_list(pages, "url")
    judged = url_filter.judge_urls(pages, "url", URL_RULES, listed)
    return judged.select("page_id", "host", "path", "rule", "verdict", "canonical", "listed")


def op8_weak_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    judged = quality.judge_quality(docs, "text")
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality",
    )


def op9_license_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licenses.scan_licenses(docs, "text")
    return found.select("doc_id", "first_word", "n_words", "license", F.round("dice", 6).alias("dice"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def public_model(name: str = "piece_bpe_32k.model") -> bytes:
    """A vocabulary file of the public tokenizers, read on the driver."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One training text in eight is deleted while the weights are learnt."""
    held_out = fold(F.col("doc_id"), 7) == 2
    deleted = F.pmod(F.xxhash64("doc_id", F.lit("deleted")), F.lit(8)) == 0
    role = F.when(held_out, 0).when(deleted, 2).otherwise(1)
    scored = interpolation.score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), role)
    return scored.withColumn("held_out", held_out)


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sentencepiece.encode_texts(docs, "text", public_model(), digests=True)


def op5_template_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_pii_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_spans(docs, "text")
    counts = [
        F.regexp_count("base_spans", F.lit(f"(^|,){kind}:")).cast("long").alias(f"n_{kind}") for kind in pii.KINDS
    ]
    return found.select(
        "doc_id",
        *counts,
        F.sha2("base_spans", 256).alias("base_sha256"),
        F.concat_ws(
            ",", *(F.when(F.col(c) != "", F.col(c)) for c in ("base_spans", "term_spans"))
        ).alias("spans"),
    )


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs.filter(fold(F.col("doc_id"), 5) != 0).select("text", "lang"))
    found = language_id.predict_languages(docs, model)
    return found.select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def training_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text, toxic) of the labelled rows that may be learnt from."""
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic").filter(fold(F.col("doc_id"), 4) != 2)
    return table(spark, sf_dir, "documents").select("doc_id", "text").join(labels, "doc_id")


def op4_toxic_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity.score_texts(table(spark, sf_dir, "documents"), training_labels(spark, sf_dir))
    return found.select(
        "doc_id",
        (fold(F.col("doc_id"), 4) == 2).alias("held_out"),
        "score",
        F.when(F.col("score") >= toxicity.BAR, 1).otherwise(0).alias("predicted"),
        "evidence",
    )


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def op12_vector_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best of all other vectors for every hundredth id."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return vector_search.top_k(vectors, F.col("id") % 100 == 0)


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the longer documents, drawn towards the benchmark's words."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return importance.resample(docs, table(spark, sf_dir, "benchmark"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
