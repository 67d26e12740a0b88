"""Language identification by hierarchical discrimination.

First the family, then one-versus-one linear support vector machines between
the languages of that family. A text is described by the relative frequency of
its hashed letter-byte trigrams inside words, so a linear score is the mean of
one weight per trigram: one look-up and one sum, whatever the length.

Training reads a bounded sample of labelled texts (``PER_LANGUAGE`` per
language, at most ``LANGUAGES`` languages, chosen by a hash of the text) as
feature rows; the machines are fitted on them by dual coordinate descent.
Prediction covers every text whole and uses the text alone.

Defined results: NULL texts, and texts without a letter, are ``und`` with
score 0; without labelled rows every text is. Ties go to the language first by
name. Repeated rows are predicted each for itself; an empty table gives no
rows. Columns other than id, text and language are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.llm import common

FEATURES = 4096
PER_LANGUAGE = 400
LANGUAGES = 100
# Families of the more common written languages; others stand alone.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi".split(),
    "romance": "fr es pt it ro ca gl oc la".split(),
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk".split(),
    "uralic": "fi et hu".split(),
    "turkic": "tr az kk uz ky tk".split(),
    "indic": "hi bn mr gu pa ur ne si".split(),
    "semitic": "ar he am mt".split(),
}


def family_of(language: str) -> str:
    base = language.lower().split("-")[0]
    return next((f for f, members in FAMILIES.items() if base in members), language)


def _separators() -> np.ndarray:
    lut = np.ones(256, dtype=bool)
    lut[97:123] = False
    lut[65:91] = False
    lut[128:] = False
    return lut


_OUTSIDE = _separators()


def trigrams(raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature number and text of every trigram of letter bytes; runs of other
    bytes count as one blank on either side of a word."""
    low = common.LOWERED[raw].astype(np.uint32)
    low[_OUTSIDE[raw]] = 32
    if len(low) < 2:
        none = np.zeros(0, np.int64)
        return none, none
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    left = np.concatenate([[32], low[:-1]]).astype(np.uint32)
    right = np.concatenate([low[1:], [32]]).astype(np.uint32)
    edge = at[(at > 0) & (at < len(low))]
    left[edge] = 32
    right[edge - 1] = 32
    code = left | (low << np.uint32(8)) | (right << np.uint32(16))
    feature = (code * np.uint32(2654435761)) >> np.uint32(32 - 12)
    inside = low != 32
    return feature[inside].astype(np.int64), doc[inside]


def frequencies(part: pa.RecordBatch, text: str) -> np.ndarray:
    raw, at = common.text_bytes(part[text])
    feature, doc = trigrams(raw, at)
    n = part.num_rows
    counts = np.bincount(doc * FEATURES + feature, minlength=n * FEATURES).reshape(n, FEATURES)
    return (counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)).astype(np.float32)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in common.chunks(batch, "text", 1 << 19):
            for i in range(0, part.num_rows, 256):
                rows = part.slice(i, 256)
                x = frequencies(rows, "text")
                yield pa.RecordBatch.from_arrays(
                    [rows["lang"], pa.array([r.tobytes() for r in x], pa.binary())], names=["lang", "x"]
                )


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30) -> np.ndarray:
    """Weights (the last one the offset) of a linear machine with hinge loss,
    by dual coordinate descent; y is +1 or -1."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)]).astype(np.float64)
    norms = np.maximum((x * x).sum(axis=1), 1e-12)
    alpha, w = np.zeros(len(x)), np.zeros(x.shape[1])
    order = np.random.default_rng(7)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(len(x)):
            grad = y[i] * (x[i] @ w) - 1
            new = min(max(alpha[i] - grad / norms[i], 0.0), cost)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


class Model:
    """Family machines (one against the rest) and pair machines in families."""

    def __init__(self, languages: np.ndarray, x: np.ndarray):
        self.languages = sorted(set(languages.tolist()))
        families = np.array([family_of(n) for n in languages])
        self.families = sorted(set(families.tolist()))
        mean = x.mean(axis=0)
        scale = 1.0 / (x.std(axis=0) + 1e-3)
        z = (x - mean) * scale / np.sqrt(FEATURES)
        weights = []
        self.pairs: list[tuple[int, int]] = []
        if len(self.families) > 1:
            for f in self.families:
                weights.append(linear_svm(z, np.where(families == f, 1.0, -1.0)))
        for f in self.families:
            members = [i for i, n in enumerate(self.languages) if family_of(n) == f]
            for a, b in combinations(members, 2):
                mine = np.isin(languages, [self.languages[a], self.languages[b]])
                y = np.where(languages[mine] == self.languages[a], 1.0, -1.0)
                weights.append(linear_svm(z[mine], y))
                self.pairs.append((a, b))
        w = np.array(weights).reshape(len(weights), FEATURES + 1)
        # fold centring and scaling into one weight per trigram
        self.weights = (w[:, :-1] * scale / np.sqrt(FEATURES)).astype(np.float32)
        self.offsets = w[:, -1] - (w[:, :-1] * mean * scale / np.sqrt(FEATURES)).sum(axis=1)

    def predict(self, part: pa.RecordBatch, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Language numbers and probabilities."""
        raw, at = common.text_bytes(part[text])
        feature, doc = trigrams(raw, at)
        n = part.num_rows
        size = np.maximum(np.bincount(doc, minlength=n), 1)
        margins = [
            np.bincount(doc, weights=w[feature], minlength=n) / size + b for w, b in zip(self.weights, self.offsets)
        ]
        own = np.array([self.families.index(family_of(x)) for x in self.languages])
        if len(self.families) > 1:
            family = np.array(margins[: len(self.families)])
            chance = 1 / (1 + np.exp(-3 * family))
            chance /= chance.sum(axis=0)
        else:
            chance = np.ones((1, n))
        score = np.zeros((len(self.languages), n))
        rivals = np.zeros(len(self.languages))
        for (a, b), m in zip(self.pairs, margins[len(margins) - len(self.pairs) :]):
            p = 1 / (1 + np.exp(-3 * m))
            score[a] += p
            score[b] += 1 - p
            rivals[a] += 1
            rivals[b] += 1
        within = np.where(rivals[:, None] > 0, score / np.maximum(rivals, 1)[:, None], 1.0)
        best_family = chance.argmax(axis=0)
        eligible = own[:, None] == best_family[None, :]
        pick = np.where(eligible, within, -1.0).argmax(axis=0)
        place = np.arange(n)
        return pick, np.clip(within[pick, place] * chance[best_family, place], 0.0, 1.0)


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Model | None:
    """``labelled`` has text and lang. The sample is spread over each language
    by a hash of the text; its size has the bound given above."""
    usable = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(LANGUAGES).collect()
    if not counts:
        return None
    draw = F.pmod(F.xxhash64("text"), F.lit(1_000_000))
    share: Column = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("lang") == row["lang"], 1e6 * min(1.0, per_language / row["count"])).otherwise(share)
    sample = usable.filter(draw < share).orderBy(F.xxhash64("text", F.lit(1))).limit(2 * per_language * len(counts))
    rows = sample.select("lang", "text").mapInArrow(_feature_rows, "lang string, x binary").collect()
    if not rows:
        return None
    x = np.array([np.frombuffer(r["x"], dtype=np.float32) for r in rows])
    return Model(np.array([r["lang"] for r in rows]), x)


def _predict(model) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        letter = regex.compile(r"\p{L}")
        fitted: Model | None = model.value
        for batch in batches:
            for part in common.chunks(batch, "text"):
                spoken = [bool(t and letter.search(t)) for t in part["text"].to_pylist()]
                if fitted is None:
                    names, scores = ["und"] * part.num_rows, [0.0] * part.num_rows
                else:
                    pick, score = fitted.predict(part, "text")
                    names = [fitted.languages[i] if s else "und" for i, s in zip(pick, spoken)]
                    scores = np.where(spoken, score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "lang_pred", "score"],
                )

    return run


def predict_languages(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, lang_pred, score) of every row; the model (at most
    LANGUAGES ** 2 / 2 weight rows, in practice a few) is broadcast."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return rows.mapInArrow(_predict(shared), "doc_id bigint, lang_pred string, score double")
