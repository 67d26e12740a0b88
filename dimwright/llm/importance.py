"""Importance resampling towards a target distribution, over hashed n-grams.

Each text is a bag of runs of 1 to ``n`` words, hashed into buckets. Bucket
frequencies of the raw and of the target texts give every bucket a gain, the
sum of a document's gains is its weight, and the documents with the highest
weight plus Gumbel noise are drawn, which samples without replacement in
proportion to the importance weights.

A task does not walk text by text: the texts of a batch are joined with a
separator sentinel, one pass of a regular expression finds the words of all of
them, ``searchsorted`` over the text offsets tells which text a word belongs
to, and that masks n-grams that would run across two texts before ``bincount``
counts the buckets. Counts leave a task once, as one row per bucket.

Drawing needs no global sort in one task: the (score, id) pairs are shuffled
by range, sorted inside their partitions and stored, and the row counts per
partition turn places into ranks.

Defined results: NULL and empty texts have no words, weight 0, and are not
drawn. The noise depends on the seed and the id only, so equal rows get equal
scores; a NULL id reads as empty. Ties go to the smaller id, NULL first, then
to the smaller weight and feature count; rows alike in all of these are one
another's equals. A text may have any length (a batch is cut after whole
texts). An empty target or raw table gives gains by the smoothing alone; no
documents give no rows. Input columns other than id and text do not take part.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.llm.common import chunks, store
from dimwright.operators.surrogate import assign_surrogate_keys

BUCKETS = 10_000
MAX_N = 1
SEED = 2024
LEAST_WORDS = 20
PERCENT = 10

# Fixed value of the query contract: words are digits, letters a-z and everything
# beyond ASCII; in UTF-8 that is a class of bytes. The sentinel is none of them.
_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_SENTINEL = b"\x00"


@dataclass(frozen=True)
class Features:
    """Hashed n-grams of one batch: the bucket of each, the text it is in, and
    the number of words of every text."""

    bucket: np.ndarray
    text: np.ndarray
    n_words: np.ndarray


def batch_features(texts: Iterable[str | None], n: int = MAX_N, buckets: int = BUCKETS) -> Features:
    """All runs of 1 to ``n`` words of every text, in one pass over the batch."""
    raw = [(t or "").encode().lower() for t in texts]
    ends = np.cumsum([len(r) + len(_SENTINEL) for r in raw], dtype=np.int64)
    found = list(_WORDS.finditer(_SENTINEL.join(raw)))
    words = [m.group() for m in found]
    starts = np.fromiter((m.start() for m in found), np.int64, len(found))
    text = np.searchsorted(ends, starts, side="right")
    hashes = [crc32(w) for w in words]
    bucket, owner = [np.array(hashes, dtype=np.int64) % buckets], [text]
    for k in range(2, n + 1):
        # the hash of a run is carried on by a blank and its next word
        hashes = [crc32(b" " + w, h) for h, w in zip(hashes, words[k - 1 :])]
        inside = text[: len(hashes)] == text[k - 1 :]
        bucket.append(np.array(hashes, dtype=np.int64)[inside] % buckets)
        owner.append(text[: len(hashes)][inside])
    return Features(
        np.concatenate(bucket), np.concatenate(owner), np.bincount(text, minlength=len(raw))
    )


def bucket_counts(df: DataFrame, text: str, n: int = MAX_N, buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows; the driver receives ``buckets``
    numbers whatever the size of the table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                found = batch_features(part["text"].to_pylist(), n, buckets)
                total += np.bincount(found.bucket, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.record_batch([pa.array(used), pa.array(total[used])], names=["bucket", "n"])

    counted = df.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long")
    total = np.zeros(buckets, np.int64)
    for bucket, hits in counted.groupBy("bucket").agg(F.sum("n")).collect():
        total[bucket] = hits
    return total


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Smoothed log ratio of target to raw frequency, in whole thousandths."""
    smooth = float(len(raw))
    all_raw, all_target = float(raw.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1) * (all_raw + smooth) / ((s + 1) * (all_target + smooth))))
            for s, t in zip(raw.astype(float).tolist(), target.astype(float).tolist())
        ],
        dtype=np.int64,
    )


def _noise_source(key: Column, seed: int) -> Column:
    """First 32 bits of sha256 of ``seed:id``."""
    written = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.sha2(written, 256), 1, 8), 16, 10).cast("long")


def _gumbel(h: int) -> int:
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(
    df: DataFrame, text: str, key: str, gains: np.ndarray, n: int = MAX_N, seed: int = SEED
) -> DataFrame:
    """(key, n_words, n_features, weight, score) of every row."""
    kind = df.schema[key].dataType.simpleString()
    columns = [key, "n_words", "n_features", "weight", "score"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                found = batch_features(part["text"].to_pylist(), n, len(gains))
                weight = np.zeros(part.num_rows, np.int64)
                np.add.at(weight, found.text, gains[found.bucket])
                noise = np.array([_gumbel(h) for h in part["h"].to_pylist()], dtype=np.int64)
                yield pa.record_batch(
                    [
                        part["key"],
                        pa.array(found.n_words.astype(np.int64)),
                        pa.array(np.bincount(found.text, minlength=part.num_rows).astype(np.int64)),
                        pa.array(weight),
                        pa.array(weight + noise),
                    ],
                    names=columns,
                )

    rows = df.select(
        F.col(key).alias("key"), F.col(text).alias("text"), _noise_source(F.col(key), seed).alias("h")
    )
    return rows.mapInArrow(
        score, f"`{key}` {kind}, n_words long, n_features long, weight long, score long"
    )


def resample(
    df: DataFrame,
    target: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    n: int = MAX_N,
    buckets: int = BUCKETS,
    seed: int = SEED,
    least_words: int = LEAST_WORDS,
    percent: int = PERCENT,
) -> DataFrame:
    """Every row's (key, n_features, weight, score, rank); ``rank`` counts the
    drawn rows from 1 and is NULL for the others. Of the rows with at least
    ``least_words`` words, ``percent`` in a hundred are drawn."""
    gains = bucket_gains(bucket_counts(df, text, n, buckets), bucket_counts(target, text, n, buckets))
    scored = store(weigh(df, text, key, gains, n, seed), "weights")
    fit = F.col("n_words") >= least_words
    ordered = scored.filter(fit).withColumn("_from_top", -F.col("score"))
    ranked = assign_surrogate_keys(
        ordered, "rank", ["_from_top", key, "weight", "n_features"]
    ).drop("_from_top")
    drawn = scored.filter(fit).count() * percent // 100
    rank = F.when(F.col("rank") <= drawn, F.col("rank"))
    rest = scored.filter(~fit).withColumn("rank", F.lit(None).cast("long"))
    return (
        ranked.withColumn("rank", rank)
        .unionByName(rest)
        .select(key, "n_features", "weight", "score", "rank")
    )
