"""Toxicity by nearest labelled examples under exact TF-IDF cosine.

The examples are at most ``EXAMPLES`` labelled rows, those with the least hash
of the id, then of the text, so all of them where there are no more; rows equal
in both count as one. Terms are words and the first five and four letters of
longer words, kept if ``SHARE`` of the examples hold them: their number is
bounded by the mean number of terms of an example over ``SHARE``, whatever the
input. A term weighs (1 + ln tf) * idf * (1 + log-odds), where the log-odds
compare its share in rows of label 1 with its share in the others and count only
where they speak for label 1. Terms of more than ``COMMON`` of the examples, and
more than ten of them, are stop words unless their log-odds exceed ``TELLING``.
Examples with the same vector form one entry that knows how many carry each label.

The index is block-max inverted: entries lie in blocks of ``BLOCK`` similar
ones, the postings of a term are cut by block, and the greatest weight of each
term in each block is kept. A query adds up these maxima, which bounds every
cosine of a block, scores blocks from the highest bound down, and stops where
the bound cannot reach the k-th nearest row found. Where the blocks left would
cut the lists of its terms into many short pieces, the lists are read whole
instead, which costs less. The cosines are exact.

Neighbours vote with weight 1 / (1.05 - cosine), smoothed by the base rate.
With ``CALIBRATED`` examples of each label at least, the vote is mapped to the
share of label 1 among examples of such votes: every example is voted on by the
others, and the map is the isotonic regression of their labels. With fewer the
vote is the score. ``evidence`` names the closest examples. Texts without a
kept term get the rate of examples without one.

Every text is read once, whole, and scored where it lies, without a shuffle.
The driver and each task hold the kept terms and the index, both bounded by
``EXAMPLES`` and the kept terms.

Defined results: NULL and empty texts have no terms. Ties at the k-th place go
to the entry first in the index. Rows that share a doc_id are scored each for
itself. Without labels every score is 0; an empty table gives no rows. Other
columns are neither inputs nor results.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructType

from dimwright.llm.common import chunks, store

NEIGHBOURS = 25
EXAMPLES = 3072  # labelled rows searched
SHARE = 0.003  # of the examples must hold a term
COMMON, TELLING = 0.1, 0.5  # share beyond which a term is a stop word, log-odds that keep it
BLOCK = 64
WHOLE = 0.3  # cuts of postings left to a search, for each posting, beyond which whole lists are read
CALIBRATED = 30  # examples of each label that a map of votes needs
REMEMBERED = 1 << 12  # texts of a task whose score is kept for their copies
BAR = 0.3
SLACK = 1e-5  # what single precision may take from a bound
WORD = re.compile(r"[^\W\d_]{2,}")


def term_counts(text: str | None) -> Counter[str]:
    """Words and their openings, each with how often it occurs."""
    words = Counter(WORD.findall(text.lower())) if text else Counter()
    out = Counter(words)
    for w, n in words.items():
        for size in (4, 5):
            if len(w) > size:
                out[w[:size] + "*"] += n
    return out


def _held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(term, rows that hold it, those of label 1) per task: summed before the shuffle."""
    rows, good = Counter(), Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays(
            [
                pa.array(rows.keys(), pa.string()),
                pa.array(rows.values(), pa.int64()),
                pa.array([good[t] for t in rows], pa.int64()),
            ],
            names=["term", "n", "pos"],
        )
        rows.clear()
        good.clear()
        return out

    for batch in batches:
        for part in chunks(batch, "text"):
            for text, toxic in zip(part["text"].to_pylist(), part["toxic"].to_pylist()):
                terms = term_counts(text).keys()
                rows.update(terms)
                if toxic:
                    good.update(terms)
            if len(rows) > 400_000:
                yield flush()
    if rows:
        yield flush()


class Terms:
    """Kept terms by number, and their weights."""

    def __init__(self, names: list[str], weights: np.ndarray):
        self.number = {t: i for i, t in enumerate(names)}
        self.weights = weights

    def counts(self, text: str | None) -> dict[int, int]:
        """``term_counts`` of the kept terms, by number. A word is cut here, not
        remembered: most words of a corpus are seen a few times only."""
        out: dict[int, int] = {}
        number, held = self.number.get, out.get
        for word, n in Counter(WORD.findall(text.lower()) if text else ()).items():
            i = number(word)
            if i is not None:
                out[i] = held(i, 0) + n
            if len(word) > 4:
                i = number(word[:4] + "*")
                if i is not None:
                    out[i] = held(i, 0) + n
                if len(word) > 5:
                    i = number(word[:5] + "*")
                    if i is not None:
                        out[i] = held(i, 0) + n
        return out


def kept_terms(examples: DataFrame) -> tuple[Terms, int, int]:
    """The kept terms; rows and rows of label 1."""
    n = examples.agg(F.count("*").alias("whole"), F.count(F.when(F.col("toxic") != 0, 1)).alias("pos")).first()
    whole, pos = n["whole"], n["pos"]
    counts = examples.select("text", "toxic").mapInArrow(_held, "term string, n bigint, pos bigint")
    summed = counts.groupBy("term").agg(F.sum("n").alias("n"), F.sum("pos").alias("pos"))
    kept = summed.filter(F.col("n") >= SHARE * whole).toArrow().sort_by("term")
    rows, good = kept["n"].to_numpy().astype(float), kept["pos"].to_numpy().astype(float)
    odds = np.log((good + 0.5) / (pos + 1)) - np.log((rows - good + 0.5) / (whole - pos + 1))
    weight = np.log1p(whole / np.maximum(rows, 1)) * (1 + np.maximum(odds, 0))
    used = np.flatnonzero((rows <= max(COMMON * whole, 10)) | (odds > TELLING))
    names = kept["term"].take(used).to_pylist()
    return Terms(names, weight[used]), whole, pos


def vector(text: str | None, terms: Terms) -> tuple[np.ndarray, np.ndarray]:
    """Unit vector over the kept terms, by term number."""
    counts = terms.counts(text)
    if not counts:
        return np.zeros(0, "<u4"), np.zeros(0, "<f4")
    at = np.fromiter(counts.keys(), "<u4", len(counts))
    weight = terms.weights[at] * (1 + np.log(np.fromiter(counts.values(), np.float64, len(counts))))
    order = np.argsort(at)
    return at[order], (weight[order] / np.sqrt(weight @ weight)).astype("<f4")


def _vectors(terms) -> Callable:
    """Examples with their vector in place of the text: numbers and weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = terms.value
        for batch in batches:
            for part in chunks(batch, "text"):
                vectors = [vector(t, known) for t in part["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        part["toxic"],
                        pa.array([i.tobytes() for i, _ in vectors], pa.binary()),
                        pa.array([w.tobytes() for _, w in vectors], pa.binary()),
                    ],
                    names=["doc_id", "toxic", "ids", "weights"],
                )

    return run


def _similar(sketch: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
    """Rows in blocks of similar ones: halved along the direction they differ most in."""
    if len(rows) <= BLOCK:
        return [rows]
    apart = sketch[rows] - sketch[rows].mean(axis=0)
    axis = apart[np.argmax((apart * apart).sum(axis=1))]
    for _ in range(8):
        axis = apart.T @ (apart @ axis)
        axis /= max(np.linalg.norm(axis), 1e-30)
    order = rows[np.argsort(apart @ axis, kind="stable")]
    half = -(-len(rows) // (2 * BLOCK)) * BLOCK  # whole blocks on the left
    return _similar(sketch, order[:half]) + _similar(sketch, order[half:])


class BlockMaxIndex:
    """Postings by term, cut by block, with the number and the greatest weight in each cut."""

    def __init__(self, entries: list[tuple[bytes, bytes, int, int, int]]):
        entries = sorted(entries)
        self.size, self.scored = len(entries), 0  # blocks scored so far
        ids = [np.frombuffer(e[0], "<u4").astype(np.int64) for e in entries]
        entry = np.repeat(np.arange(self.size), [len(i) for i in ids])
        term = np.concatenate(ids) if ids else np.zeros(0, np.int64)
        weight = np.concatenate([np.frombuffer(e[1], "<f4") for e in entries]) if ids else np.zeros(0, np.float32)
        # similar entries side by side, by a sketch that adds terms into 128 signed places
        spread = (term * 0x9E3779B1) >> 7
        sign = np.where((spread >> 8) & 1, 1.0, -1.0)
        sketch = np.bincount(entry * 128 + spread % 128, weight * sign, minlength=self.size * 128)
        place = np.concatenate(_similar(sketch.reshape(-1, 128), np.arange(self.size))).astype(np.int64)
        self.votes = np.array([entries[i][2:4] for i in place], dtype=np.float64).reshape(-1, 2)
        self.example = [entries[i][4] for i in place]
        moved = np.zeros(self.size, np.int64)
        moved[place] = np.arange(self.size)
        entry = moved[entry]
        self.blocks = -(-self.size // BLOCK)
        self.terms = int(term.max()) + 1 if len(term) else 0
        order = np.lexsort((entry, term))
        self.entry, self.weight = entry[order], weight[order]
        cell = term[order] * self.blocks + self.entry // BLOCK
        held = np.bincount(cell, minlength=self.terms * self.blocks)
        self.held, self.cut = held.astype(np.uint8), (np.cumsum(held) - held).astype(np.int32)
        self.posted = held.reshape(self.terms, self.blocks).sum(axis=1)
        self.begin = np.cumsum(self.posted) - self.posted
        greatest = np.zeros(self.terms * self.blocks, np.float32)
        np.maximum.at(greatest, cell, self.weight)
        self.greatest = greatest.reshape(self.terms, self.blocks)

    def _add(self, ids: np.ndarray, weights: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Cosines of the entries of some blocks; zero elsewhere."""
        cell = (ids[:, None] * self.blocks + blocks).ravel()
        some = np.flatnonzero(self.held[cell])
        length = self.held[cell[some]].astype(np.int64)
        return self._sums(self.cut[cell[some]], length, weights[some // len(blocks)])

    def _sums(self, begin: np.ndarray, length: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """What runs of postings add to each entry."""
        place = np.repeat(begin - np.cumsum(length) + length, length)
        place += np.arange(len(place))
        of = np.repeat(weights, length)
        of *= self.weight[place]
        return np.bincount(self.entry[place], of, minlength=self.size)

    def search(self, ids: np.ndarray, weights: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Entries and cosines of the nearest k rows (an entry counts as many)."""
        ids = np.asarray(ids, np.int64)
        known = ids < self.terms
        ids, weights = ids[known], np.asarray(weights, np.float64)[known]
        if not len(ids):
            return np.zeros(0, np.int64), np.zeros(0)
        bound = weights.astype(np.float32) @ self.greatest[ids] + SLACK
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] > SLACK]
        score, low, at, step = np.zeros(self.size), 0.0, 0, 4
        while at < len(order) and bound[order[at]] >= low:
            blocks = order[at : at + step]
            blocks = blocks[bound[blocks] >= low]
            left = int(np.count_nonzero(bound[order[at:]] >= low))
            if left * len(ids) > self.posted[ids].sum() * WHOLE:
                score = self._sums(self.begin[ids], self.posted[ids], weights)
                self.scored += left
                at = len(order)
            else:
                score += self._add(ids, weights, blocks)
                self.scored += len(blocks)
                at, step = at + step, step * 3
            # any k entries hold k rows at least
            if self.size > k:
                low = np.partition(score, -k)[-k]
        near = np.flatnonzero((score > 0) & (score >= low - 1e-6))
        order = np.lexsort((near, -np.round(score[near], 6)))
        upto = np.cumsum(self.votes[near[order]].sum(axis=1))
        near = near[order[: int(np.searchsorted(upto, k)) + 1]]
        return near, score[near]


def vote(near: list[tuple[float, int, int]], rate: float, k: int) -> float:
    """Smoothed distance-weighted share of label 1 among the nearest k rows;
    of a tied entry that reaches beyond k each row counts in proportion."""
    left, good, total = float(k), rate, 1.0
    for cosine, pos, neg in near:
        rows = pos + neg
        taken = min(left, rows) / rows
        weight = taken / (1.05 - cosine)
        good += weight * pos
        total += weight * rows
        left -= rows * taken
        if left <= 0:
            break
    return good / total


def _neighbours(index: BlockMaxIndex, ids: np.ndarray, weights: np.ndarray, k: int) -> list[tuple]:
    """(cosine, rows of label 1, rows of label 0, example) of the nearest entries."""
    found, cosine = index.search(ids, weights, k)
    return [
        (min(c, 1.0), pos, neg, index.example[e])
        for e, c, (neg, pos) in zip(found.tolist(), cosine.tolist(), index.votes[found].tolist())
    ]


def _votes_of_others(index, rate: float, k: int) -> Callable:
    """(vote, toxic) of every example, from the other examples."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        built = index.value
        for batch in batches:
            votes = []
            for i, w, toxic in zip(*(batch[c].to_pylist() for c in ("ids", "weights", "toxic"))):
                near = _neighbours(built, np.frombuffer(i, "<u4"), np.frombuffer(w, "<f4"), k + 1)
                own, others = True, []
                for cosine, pos, neg, example in near:
                    if own and cosine > 1 - 1e-6 and (pos if toxic else neg):
                        own, pos, neg = False, pos - (toxic != 0), neg - (toxic == 0)
                    if pos + neg:
                        others.append((cosine, pos, neg))
                votes.append(vote(others, rate, k))
            yield pa.RecordBatch.from_arrays([pa.array(votes, pa.float64()), batch["toxic"]], names=["vote", "toxic"])

    return run


def isotonic(votes: np.ndarray, good: np.ndarray, rows: np.ndarray, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """Rising map from votes to shares of label 1, by pooling neighbours that
    fall; a pool counts one more row of the base rate."""
    pools: list[list[float]] = []  # sum of votes, label 1, rows
    for i in np.argsort(votes, kind="stable"):
        pools.append([votes[i] * rows[i], good[i], rows[i]])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    total, label, count = np.array(pools, dtype=float).reshape(-1, 3).T
    return total / count, np.maximum.accumulate((label + rate) / (count + 1))


def _score(terms, index, rate: float, without: float, shares, k: int, out: list[str]) -> Callable:
    """The columns ``out`` of every row with score and evidence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, built, seen = terms.value, index.value, {}

        def judged(text: str | None) -> tuple[float, list[int]]:
            ids, weights = vector(text, known)
            if not len(ids):
                return without, []
            near = _neighbours(built, ids, weights, k)
            raw = vote([n[:3] for n in near], rate, k)
            return (raw if shares is None else float(np.interp(raw, *shares))), [n[3] for n in near[:3]]

        for batch in batches:
            for part in chunks(batch, "_text"):
                found = []
                for text in part["_text"].to_pylist():
                    # by digest: the texts themselves would be held twice and more
                    key = text and hashlib.sha256(text.encode("utf-8")).digest()
                    if key not in seen:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen[key] = judged(text)
                    found.append(seen[key])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part[c] for c in out),
                        pa.array([f[0] for f in found], pa.float64()),
                        pa.array([f[1] for f in found], pa.list_(pa.int64())),
                    ],
                    names=[*out, "score", "evidence"],
                )

    return run


class Scorer:
    """Examples, index and map, fitted on labelled rows (doc_id, text, toxic)."""

    def __init__(self, labelled: DataFrame, k: int = NEIGHBOURS):
        context = labelled.sparkSession.sparkContext
        known = labelled.filter(F.col("toxic").isNotNull()).select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            "text",
            F.col("toxic").cast("int").alias("toxic"),
            F.xxhash64("doc_id").alias("place"),
        )
        # up to the EXAMPLES-th hash of an id, so that other texts stay unread; where rows share
        # ids, up to the EXAMPLES-th hash of id and text
        last = known.select("place").distinct().orderBy("place").limit(EXAMPLES).agg(F.max("place")).first()[0]
        named = store(known.filter(F.col("place") <= F.lit(last)), "toxic-examples")
        named = named.withColumn("place", F.struct("place", F.xxhash64("text").alias("body")))
        last = named.select("place").distinct().orderBy("place").limit(EXAMPLES).agg(F.max("place").alias("p")).first()["p"]
        at = last or {"place": None, "body": None}
        examples = named.filter(F.col("place") <= F.struct(F.lit(at["place"]).alias("place"), F.lit(at["body"]).alias("body")))
        terms, rows, pos = kept_terms(examples)
        self.terms = context.broadcast(terms)
        vectors = store(
            examples.mapInArrow(_vectors(self.terms), "doc_id bigint, toxic int, ids binary, weights binary"),
            "toxic-vectors",
        )
        label = [F.count(F.when(x, 1)).alias(name) for x, name in ((F.col("toxic") == 0, "neg"), (F.col("toxic") != 0, "pos"))]
        entries = vectors.groupBy("ids", "weights").agg(*label, F.min("doc_id").alias("example")).toArrow().to_pylist()
        bare = [e for e in entries if not e["ids"]]
        bare_pos, bare_neg = sum(e["pos"] for e in bare), sum(e["neg"] for e in bare)
        self.k, self.rate = k, pos / max(rows, 1)
        self.without = bare_pos / max(bare_pos + bare_neg, 1)
        self.index = context.broadcast(
            BlockMaxIndex([(e["ids"], e["weights"], e["neg"], e["pos"], e["example"] or 0) for e in entries if e["ids"]])
        )
        self.shares = None
        if min(pos, rows - pos) >= CALIBRATED:
            others = vectors.filter(F.length("ids") > 0).mapInArrow(
                _votes_of_others(self.index, self.rate, k), "vote double, toxic int"
            )
            seen = others.groupBy("vote").agg(*label).toArrow()
            votes, good, bad = (seen[c].to_numpy().astype(float) for c in ("vote", "pos", "neg"))
            if len(votes):
                self.shares = isotonic(votes, good, good + bad, self.rate)

    def _scored(self, rows: DataFrame, out: list[str]) -> DataFrame:
        schema = StructType([rows.schema[c] for c in out]).add("score", "double").add("evidence", ArrayType(LongType()))
        run = _score(self.terms, self.index, self.rate, self.without, self.shares, self.k, out)
        return rows.mapInArrow(run, schema)

    def rows(self, docs: DataFrame, text: str) -> DataFrame:
        """(row, score, evidence) for the rows of ``docs`` as structs."""
        packed = F.struct(*(F.col(c) for c in docs.columns)).alias("row")
        return self._scored(docs.select(packed, F.col(text).alias("_text")), ["row"])


def score_texts(docs: DataFrame, labelled: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """(doc_id, score, evidence) for every row of ``docs`` (doc_id, text), from
    ``labelled`` rows (doc_id, text, toxic)."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").alias("_text"))
    return Scorer(labelled, k)._scored(rows, ["doc_id"])
