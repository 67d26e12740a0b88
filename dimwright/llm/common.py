"""Small helpers the text operators share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.session import materialise

# Fixed values of the query contracts: what separates words, and the letters lower-cased.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

CHUNK_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Spark's setting that drops the shuffle files of a query once it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside give up their shuffle files once they have ended."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def store(df: DataFrame, label: str) -> DataFrame:
    """``materialise``, after which the shuffle files of the work are given up:
    what follows reads the stored table."""
    with dropping_shuffles(df.sparkSession):
        stored = materialise(df, label)
        stored.stored_at = stored.inputFiles()[:1]
        return stored


def forget(*tables: DataFrame) -> None:
    """Deletes tables of ``store`` that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession.sparkContext._jvm
        conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for file in getattr(df, "stored_at", []):
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(conf).delete(folder, True)


def lower_az(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fold(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo n; -1 for a NULL id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % n, F.lit(-1)).cast("int")


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``limit`` bytes of text each; a longer
    text makes a slice of its own, so memory follows the longest text."""
    lengths = np.asarray(
        pc.fill_null(pc.binary_length(batch[column]), 0), dtype=np.int64
    )
    block = np.cumsum(lengths) // limit
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts one after the other, and where each begins
    (one more entry for the end); NULL reads as empty."""
    col = pc.fill_null(column, "").cast(pa.large_string())
    _, offsets, data = col.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[col.offset : col.offset + len(col) + 1]
    raw = np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]] if data else np.zeros(0, np.uint8)
    return raw, at - at[0]


def _spaces() -> np.ndarray:
    lut = np.zeros(256, dtype=bool)
    lut[0x20] = True
    lut[0x09:0x0E] = True
    return lut


SPACE = _spaces()
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32


def word_spans(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end (exclusive) of every word in the bytes, and its text's
    place in the chunk. Words never run from one text into the next."""
    if not len(raw):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = ~SPACE[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[at] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    start = np.flatnonzero(begins)
    end = np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(at, start, side="right") - 1


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (finaliser of the public splitmix64 generator)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = 1 << 13
_powers: dict[str, np.ndarray] = {}


def _series(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, dtype=np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _power(name: str, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a base modulo 2**64, in two tables whose product at
    (place // _STEP, place % _STEP) is that of the place, for ``n`` places:
    a table of all places would be as large as the work itself."""
    if name not in _powers:
        _powers[name] = _series(base, _STEP)
    blocks = max(n, CHUNK_BYTES) // _STEP + 1
    if len(_powers.get(f"{name} blocks", ())) < blocks:
        _powers[f"{name} blocks"] = _series(pow(base, _STEP, 1 << 64), blocks)
    return _powers[f"{name} blocks"], _powers[name]


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, case kept as in ``raw``: a polynomial in the
    places of its bytes, taken for all words at once from running sums."""
    if not len(start):
        return np.zeros(0, np.uint64)
    block, place = _power("up", _BASE, len(raw))
    sums = _BYTE[raw]
    for i, at in enumerate(range(0, len(raw), _STEP)):
        part = sums[at : at + _STEP]
        part *= place[: len(part)]
        part *= block[i]
    np.cumsum(sums, out=sums)
    value = sums[end - 1]
    value -= np.where(start > 0, sums[start - 1], np.uint64(0))
    block, place = _power("down", pow(_BASE, -1, 1 << 64), len(raw))
    value *= block[start // _STEP]
    value *= place[start % _STEP]
    return mix(value)


def sequence_hashes(words: np.ndarray, doc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words of one text, and its first word's place."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(doc[:n] == doc[k - 1 :])
    total = np.full(len(first), k, dtype=np.uint64)
    for j in range(k):
        total = total * np.uint64(_BASE) + words[first + j]
    return mix(total), first


def by_doc(doc: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Order of the rows by text, then value."""
    order = np.argsort(value)
    key = doc[order]
    if len(key) and key.max() < 1 << 16:
        key = key.astype(np.uint16)
    return order[np.argsort(key, kind="stable")]


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, dtype=np.uint64).view(np.int64)
