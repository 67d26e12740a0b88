"""Deleted interpolation: a bigram language model learnt from the whole corpus.

P(w | h) = a_b f(w | h) + b_b f(w) + c_b / classes, where the f are maximum-
likelihood estimates and the weights depend on the bucket of the context's
frequency (a power of two). The weights are learnt by expectation-maximisation
on a deleted part of the training texts: counts of the rest give the estimates,
the events of the deleted part are counted. Then all training texts count.

Every word of the training texts is a class of its own; words of none of them
share one class without counts. The ``VOCABULARY`` most frequent words have
numbers and their counts are broadcast, a table of bounded size. Pairs that hold another word
go by the words' hashes: they are stored, grouped, and the counts of such words are
joined to them. Which way a pair goes does not change its probability.

Counts of pairs and their uses meet by a hash of the pair. Tasks send arrays
with one entry per pair, or per pair and text, so a shuffled entry takes a few
bytes; the number of groups follows the number of tokens, so a group has a
fixed size. Pairs of two words of the ``HOT`` most frequent are counted and
scored inside the tasks, so no very frequent pair is dealt to one group.

Defined results: NULL reads as empty, a text of one end token. Rows that share a
doc_id are one document of several texts, each with its end. Without training
rows every class is equally likely. An empty table gives no rows. Other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.llm import common
from dimwright.llm.common import forget, store

# (VOCABULARY + 2) ** 2 pairs fit PAIR_BYTES.
VOCABULARY, HOT, PAIR_BYTES = (1 << 20) - 2, 256, 5
END, OTHER, FIRST = 0, 1, 2  # class numbers; words follow by falling frequency
END_HASH = -1
GROUP_TOKENS, HELD_TOKENS = 2_000_000, 2_000_000
BUCKETS = 40
STEPS = 4  # bins per power of two of the estimates in the event counts
EM_ROUNDS = 60


class Tokens:
    """Words of a chunk of rows as hashes, with their rows."""

    def __init__(self, part: pa.RecordBatch):
        raw, at = common.text_bytes(part["text"])
        raw = common.LOWERED[raw]
        start, end, self.doc = common.word_spans(raw, at)
        self.words = common.signed(common.word_hashes(raw, start, end))
        self.words[self.words == END_HASH] = 0
        self.rows = part.num_rows

    def classes(self, vocab: Vocab) -> np.ndarray:
        return vocab.classes(self.words)

    def pairs(self, classes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Pair number and row of every token: each text begins after an end
        and closes with one."""
        seq, row = self.closed(classes, END)
        before = np.concatenate([[END], seq[:-1]]).astype(np.int64)
        return before * width + seq, row

    def closed(self, classes: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
        """Every token with the ends of the texts, and its row."""
        n = np.bincount(self.doc, minlength=self.rows)
        close = np.cumsum(n + 1) - 1
        seq = np.full(len(classes) + self.rows, end, dtype=np.int64)
        inside = np.ones(len(seq), dtype=bool)
        inside[close] = False
        seq[inside] = classes
        return seq, np.repeat(np.arange(self.rows), n + 1)


class Vocab:
    """Class of a word hash, and class counts."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, dev: np.ndarray, end: tuple[int, int], total: tuple[int, int]):
        self.width = len(hashes) + FIRST
        order = np.argsort(np.array(hashes, dtype=np.int64))
        self.sorted = np.array(hashes, dtype=np.int64)[order]
        self.number = (order + FIRST).astype(np.int32)
        # hashes lie evenly: their leading bits lead to a run of about one
        self.shift = np.uint64(64 - max(1, len(hashes).bit_length()))
        slots = np.arange((1 << (64 - int(self.shift))) + 1)
        self.first = np.searchsorted(self._slot(self.sorted), slots).astype(np.int32)
        c, d = np.array(counts, dtype=np.int64), np.array(dev, dtype=np.int64)
        self.counts = np.concatenate([[end[0], total[0] - end[0] - c.sum()], c])
        self.core = self.counts - np.concatenate([[end[1], total[1] - end[1] - d.sum()], d])

    def numbered(self, code: np.ndarray) -> np.ndarray:
        """Pairs without a word beyond the vocabulary."""
        return (code // self.width != OTHER) & (code % self.width != OTHER)

    def hot(self, code: np.ndarray) -> np.ndarray:
        return self.numbered(code) & (code // self.width < HOT + FIRST) & (code % self.width < HOT + FIRST)

    def _slot(self, words: np.ndarray) -> np.ndarray:
        return ((words.view(np.uint64) ^ np.uint64(1 << 63)) >> self.shift).astype(np.int64)

    def classes(self, words: np.ndarray) -> np.ndarray:
        out = np.full(len(words), OTHER, dtype=np.int64)
        slot = self._slot(words)
        at, end = self.first[slot], self.first[slot + 1]
        left = np.flatnonzero(at < end)
        at, end, asked = at[left], end[left], words[left]
        while len(left):
            same = self.sorted[at] == asked
            out[left[same]] = self.number[at[same]]
            on = ~same & (at + 1 < end)
            left, at, end, asked = left[on], at[on] + 1, end[on], asked[on]
        return out


def bucket(counts: np.ndarray) -> np.ndarray:
    return np.where(counts > 0, np.floor(np.log2(np.maximum(counts, 1))) + 1, 0).astype(np.int64)


def _sum_by(key: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct keys and the sums of the values."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    sums = [np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values]
    return (key[first], *sums)


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, n, dev) of the training rows, summed up in the task."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0

    def rows(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        key, n, dev = _sum_by(*(np.concatenate(c) for c in zip(*parts)))
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(n), pa.array(dev)], names=["word", "n", "dev"])

    for batch in batches:
        for part in common.chunks(batch, "text"):
            tokens = Tokens(part)
            role = np.asarray(part["role"])
            own = role[tokens.doc]
            train = role > 0
            words = np.concatenate([tokens.words[own > 0], np.full(int(train.sum()), END_HASH)])
            dev = np.concatenate([own[own > 0] == 2, role[train] == 2]).astype(np.int64)
            held.append(_sum_by(words, np.ones(len(words), dtype=np.int64), dev))
            size += len(held[-1][0])
            if size > 3_000_000:
                yield rows(held)
                held, size = [], 0
    if held:
        yield rows(held)


def _dealt(code: np.ndarray, groups: int) -> np.ndarray:
    return (common.mix(code.astype(np.uint64)) % np.uint64(groups)).astype(np.int64)


def _packed(code: np.ndarray) -> bytes:
    return np.ascontiguousarray(code.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :PAIR_BYTES]).tobytes()


def _unpacked(raw: pa.Scalar) -> np.ndarray:
    short = np.frombuffer(raw.as_buffer(), np.uint8).reshape(-1, PAIR_BYTES)
    wide = np.zeros((len(short), 8), dtype=np.uint8)
    wide[:, :PAIR_BYTES] = short
    return wide.view("<i8").ravel()


def _slices(group: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Places of each group, in their order."""
    if len(group) and group.max() < 1 << 16:
        group = group.astype(np.uint16)
    order = np.argsort(group, kind="stable")
    ranked = group[order]
    for run in np.split(order, np.flatnonzero(np.diff(ranked)) + 1):
        if len(run):
            yield int(group[run[0]]), run


def _pair_counts(shared, groups: int) -> Callable:
    """One row per task part and group: pairs with their core and deleted counts."""

    def pack(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        key = np.sort(np.concatenate(held))
        held.clear()
        code = key >> 1
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]])) if len(code) else np.zeros(0, np.int64)
        dev = np.add.reduceat(key & 1, first) if len(first) else key
        core = np.diff(np.append(first, len(key))) - dev
        code, out = code[first], []
        for g, run in _slices(_dealt(code, groups)):
            out.append((g, _packed(code[run]), *(x[run].astype("<u4").tobytes() for x in (core, dev))))
        if out:
            kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["g", "code", "core", "dev"]
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        held: list[np.ndarray] = []
        size = 0
        for batch in batches:
            for part in common.chunks(batch, "text"):
                tokens = Tokens(part)
                code, row = tokens.pairs(tokens.classes(vocab), vocab.width)
                role = np.asarray(part["role"])[row]
                own = (role > 0) & vocab.numbered(code)
                held.append(code[own] * 2 + (role[own] == 2))
                size += len(held[-1])
                if size > HELD_TOKENS:
                    yield from pack(held)
                    size = 0
        if held:
            yield from pack(held)

    return run


def _event_keys(context: np.ndarray, own: np.ndarray, pair: np.ndarray, total: int) -> np.ndarray:
    """Bucket of the context and bins of both estimates in one number."""
    with np.errstate(divide="ignore"):
        two = np.where(pair > 0, np.round(STEPS * np.log2(pair / np.maximum(context, 1))), -999)
        one = np.where(own > 0, np.round(STEPS * np.log2(own / max(total, 1))), -999)
    return (bucket(context) * 2000 + two.astype(np.int64) + 999) * 2000 + one.astype(np.int64) + 999


def _events(shared) -> Callable:
    """For a group of pairs: counts of deleted events by bucket and estimates,
    and the totals of the hot pairs."""

    def run(table: pa.Table) -> pa.Table:
        vocab = shared.value
        parts = [
            (_unpacked(c), *(np.frombuffer(x.as_buffer(), "<u4").astype(np.int64) for x in n))
            for c, *n in zip(*(table[c] for c in ("code", "core", "dev")))
        ]
        code, core, dev = _sum_by(*(np.concatenate(c) for c in zip(*parts)))
        before, word = code // vocab.width, code % vocab.width
        hot = vocab.hot(code)
        seen = dev > 0
        key = _event_keys(vocab.core[before[seen]], vocab.core[word[seen]], core[seen], int(vocab.core.sum()))
        key, n = _sum_by(key, dev[seen])
        return pa.table(
            {
                "hot": pa.array([False] * len(key) + [True] * int(hot.sum())),
                "key": pa.array(np.concatenate([key, code[hot]])),
                "n": pa.array(np.concatenate([n, (core + dev)[hot]])),
            }
        )

    return run


def learn_weights(events: dict[int, int], classes: int) -> np.ndarray:
    """Weights (pair, single, uniform) per bucket, by expectation-maximisation;
    a bucket without events takes those of all events together."""
    key = np.array(list(events), dtype=np.int64)
    n = np.array(list(events.values()), dtype=np.float64)
    where, two, one = key // 4_000_000, key // 2000 % 2000 - 999, key % 2000 - 999
    estimates = np.stack(
        [
            np.where(two > -999, np.exp2(two / STEPS), 0.0),
            np.where(one > -999, np.exp2(one / STEPS), 0.0),
            np.full(len(key), 1.0 / classes),
        ]
    )

    def fitted(chosen: np.ndarray) -> np.ndarray:
        f, m = estimates[:, chosen], n[chosen]
        w = np.full(3, 1 / 3)
        for _ in range(EM_ROUNDS):
            share = w[:, None] * f
            share /= share.sum(axis=0)
            w = (share * m).sum(axis=1) + 1e-3
            w /= w.sum()
        return w

    overall = fitted(np.ones(len(key), dtype=bool)) if len(key) else np.array([0.0, 0.0, 1.0])
    weights = np.tile(overall, (BUCKETS, 1))
    for b in np.unique(where):
        weights[b] = fitted(where == b)
    return weights


def log_prob(
    weights: np.ndarray, classes: int, total: int, context: np.ndarray, own: np.ndarray, pair: np.ndarray
) -> np.ndarray:
    """log10 P from the counts of context, word and pair."""
    w = weights[np.minimum(bucket(context), BUCKETS - 1)]
    return np.log10(w[:, 0] * pair / np.maximum(context, 1) + w[:, 1] * own / max(total, 1) + w[:, 2] / classes)


PARTS = "doc_id bigint, n_tokens bigint, n_known bigint, base double, score double"


def _local(shared, hot_counts, weights: np.ndarray, classes: int, total: int, distinct: int) -> Callable:
    """What a task knows itself: tokens, base of vocabulary words, hot pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in batches:
            for part in common.chunks(batch, "text"):
                tokens = Tokens(part)
                code, row = tokens.pairs(tokens.classes(vocab), vocab.width)
                before, word = code // vocab.width, code % vocab.width
                known = word != OTHER
                c = vocab.counts[word]
                base = np.where(known, np.log10((c + 1.0) / (total + distinct + 1)), 0.0)
                hot = vocab.hot(code)
                pair = hot_counts.value[before[hot], word[hot]]
                score = np.zeros(len(code))
                score[hot] = log_prob(weights, classes, total, vocab.counts[before[hot]], vocab.counts[word[hot]], pair)
                add = lambda v: np.bincount(row, weights=v, minlength=part.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        pa.array(np.bincount(row, minlength=part.num_rows).astype(np.int64)),
                        pa.array(add(known & (c > 0)).astype(np.int64)),
                        pa.array(add(base)),
                        pa.array(add(score)),
                    ],
                    names=["doc_id", "n_tokens", "n_known", "base", "score"],
                )

    return run


def _rare_pairs(shared) -> Callable:
    """(doc_id, before, word, m, core, dev) of each row's pairs that hold a word
    outside the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in batches:
            for part in common.chunks(batch, "text"):
                tokens = Tokens(part)
                classes, row = tokens.closed(tokens.classes(vocab), END)
                words, _ = tokens.closed(tokens.words, END_HASH)
                earlier = np.concatenate([[END], classes[:-1]]).astype(np.int64)
                before = np.concatenate([[END_HASH], words[:-1]]).astype(np.int64)
                rare = np.flatnonzero((earlier == OTHER) | (classes == OTHER))
                rare = rare[np.lexsort((words[rare], before[rare], row[rare]))]
                row, before, words = (x[rare] for x in (row, before, words))
                new = np.ones(len(rare), dtype=bool)
                new[1:] = (row[1:] != row[:-1]) | (before[1:] != before[:-1]) | (words[1:] != words[:-1])
                new = np.flatnonzero(new)
                m = np.diff(np.append(new, len(rare)))
                role = np.asarray(part["role"])[row[new]]
                columns = [before[new], words[new], m, m * (role == 1), m * (role == 2)]
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"].take(pa.array(row[new])), *(pa.array(c.astype(np.int64)) for c in columns)],
                    names=["doc_id", "before", "word", "m", "core", "dev"],
                )

    return run


RARE = "doc_id bigint, before bigint, word bigint, m bigint, core bigint, dev bigint"
COUNTED = "before bigint, word bigint, core bigint, dev bigint, n_b bigint, core_b bigint, n_w bigint, core_w bigint"


def _listed_counts(shared) -> Callable:
    """Adds n and core of the context and of the word, -1 where they must be looked up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in batches:
            listed = []
            for words in _arrays(batch, "before", "word"):
                c = np.where(words == END_HASH, END, vocab.classes(words))
                listed += [np.where(c == OTHER, -1, counts[c]) for counts in (vocab.counts, vocab.core)]
            columns = [*batch.columns, *(pa.array(c.astype(np.int64)) for c in listed)]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in COUNTED.split(", ")])

    return run


def _with_counts(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Looks up the counts of the words outside the vocabulary; only pairs that
    need one are dealt out."""
    found = words.select(F.col("word").alias("_word"), F.col("n").alias("_n"), (F.col("n") - F.col("dev")).alias("_core"))
    for own, tag in (("before", "b"), ("word", "w")):
        asking = pairs.filter(F.col(f"n_{tag}") < 0).join(found, F.col(own) == F.col("_word"), "left")
        asking = asking.withColumns(
            {f"n_{tag}": F.coalesce("_n", F.lit(0)), f"core_{tag}": F.coalesce("_core", F.lit(0))}
        ).select(*pairs.columns)
        whole = store(pairs.filter(F.col(f"n_{tag}") >= 0).unionByName(asking), "lm-rare-pairs")
        forget(pairs)
        pairs = whole
    return pairs


def _arrays(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch[c].to_numpy(zero_copy_only=False) for c in names]


def _rare_events(total: int) -> Callable:
    """The event counts of pairs that hold a word outside the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            context, own, pair, dev = _arrays(batch, "core_b", "core_w", "core", "dev")
            key, n = _sum_by(_event_keys(context, own, pair, total), dev)
            yield pa.RecordBatch.from_arrays(
                [pa.array([False] * len(key), pa.bool_()), pa.array(key), pa.array(n)], names=["hot", "key", "n"]
            )

    return run


SCORED = "before bigint, word bigint, known bigint, base double, score double"


def _rare_scores(shared, weights: np.ndarray, classes: int, total: int, distinct: int) -> Callable:
    """Score of every pair that holds a word outside the vocabulary; known and
    base of its word, where that is the one outside."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for batch in batches:
            word, context, own, core, dev = _arrays(batch, "word", "n_b", "n_w", "core", "dev")
            rare = (vocab.classes(word) == OTHER) & (word != END_HASH)
            columns = [
                ((own > 0) & rare).astype(np.int64),
                np.where(rare, np.log10((own + 1.0) / (total + distinct + 1)), 0.0),
                log_prob(weights, classes, total, context, own, core + dev),
            ]
            yield pa.RecordBatch.from_arrays(
                [batch["before"], batch["word"], *(pa.array(c) for c in columns)],
                names=[c.split()[0] for c in SCORED.split(", ")],
            )

    return run


def _pair_uses(shared, groups: int) -> Callable:
    """One row per chunk and group: pairs in the order of the rows they are used
    in, and how many each row uses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        vocab = shared.value
        chunk = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in common.chunks(batch, "text", 2 * common.CHUNK_BYTES):
                chunk += 1
                tokens = Tokens(part)
                code, row = tokens.pairs(tokens.classes(vocab), vocab.width)
                cold = vocab.numbered(code) & ~vocab.hot(code)
                code, row = code[cold], row[cold]
                ids = np.asarray(pc_fill(part["doc_id"]))
                role = np.asarray(part["role"]).astype(np.uint8)
                out = []
                for g, take in _slices(_dealt(code, groups)):
                    mine = row[take]  # ascending
                    first = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
                    used, many = mine[first], np.diff(np.append(first, len(mine)))
                    out.append(
                        (g, chunk, _packed(code[take]), many.astype("<u4").tobytes(),
                         ids[used].astype("<i8").tobytes(), role[used].tobytes())
                    )
                if out:
                    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                        names=["g", "chunk", "code", "many", "ids", "roles"],
                    )

    return run


def pc_fill(ids: pa.Array) -> pa.Array:
    return common.pc.fill_null(ids, -(1 << 62))


def _pair_scores(shared, weights: np.ndarray, classes: int, total: int) -> Callable:
    """Scores of a group of pairs, as one row of sums for each chunk they come
    from. All uses of a pair are here, so its count is the number of those in
    training texts."""

    def run(table: pa.Table) -> pa.Table:
        vocab = shared.value
        code = np.concatenate([_unpacked(c) for c in table["code"]])
        many = np.concatenate([np.frombuffer(m.as_buffer(), "<u4") for m in table["many"]])
        ids = [np.frombuffer(doc.as_buffer(), "<i8") for doc in table["ids"]]
        train = np.concatenate([np.frombuffer(role.as_buffer(), np.uint8) for role in table["roles"]]) > 0
        order = np.argsort(code)
        code = code[order]
        owner = np.repeat(np.arange(len(many), dtype=np.int32), many)[order]
        first = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        kinds, counts = code[first], np.add.reduceat(train[owner], first, dtype=np.int64)
        score = log_prob(
            weights, classes, total, vocab.counts[kinds // vocab.width], vocab.counts[kinds % vocab.width], counts
        )
        score = np.repeat(score, np.diff(np.append(first, len(code))))
        sums = np.bincount(owner, weights=score, minlength=len(many)).astype("<f8")
        cuts = np.cumsum([len(i) for i in ids])[:-1]
        return pa.table(
            {
                "chunk": table["chunk"],
                "ids": pa.array([i.tobytes() for i in ids], pa.binary()),
                "sums": pa.array([s.tobytes() for s in np.split(sums, cuts)], pa.binary()),
            }
        )

    return run


def _chunk_scores(table: pa.Table) -> pa.Table:
    """The sums of all groups for the documents of one chunk."""
    ids = np.concatenate([np.frombuffer(v.as_buffer(), "<i8") for v in table["ids"]])
    sums = np.concatenate([np.frombuffer(v.as_buffer(), "<f8") for v in table["sums"]])
    doc, score = _sum_by(ids, sums)
    return pa.table({"doc_id": doc, "score": score})


def _vocabulary(words: DataFrame, end: tuple[int, int], total: tuple[int, int]) -> Vocab:
    """The words of the highest counts, as many counts as give ``VOCABULARY`` words at most:
    no task ranks them all, and the driver gets a table of bounded size."""
    least, listed = None, 0
    # few rows: k distinct counts take k * k / 2 tokens
    for r in sorted(words.groupBy("n").count().toArrow().to_pylist(), key=lambda r: -r["n"]):
        listed += r["count"]
        if listed > VOCABULARY:
            break
        least = r["n"]
    found = words.filter(F.lit(False) if least is None else F.col("n") >= least).toArrow()
    word, n, dev = (np.asarray(found[c].combine_chunks()) for c in ("word", "n", "dev"))
    order = np.lexsort((word, -n))
    return Vocab(word[order], n[order], dev[order], end, total)


def score_texts(docs: DataFrame, role: F.Column) -> DataFrame:
    """(doc_id, n_tokens, n_known, train_tokens, base_score, score) for each
    doc_id of ``docs`` (doc_id, text). ``role``: 0 held out, 1 training, 2
    training and deleted while the weights are learnt."""
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", role.cast("int").alias("role"))
    words = store(
        rows.mapInArrow(_word_counts, "word bigint, n bigint, dev bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"), F.sum("dev").alias("dev")),
        "lm-words",
    )
    sums = words.agg(F.sum("n"), F.sum("dev"), F.count("*")).first()
    total, deleted, distinct = sums[0] or 0, sums[1] or 0, sums[2]
    ends = words.filter(F.col("word") == END_HASH).first()
    end = (ends["n"], ends["dev"]) if ends else (0, 0)
    vocab = _vocabulary(words.filter(F.col("word") != END_HASH), end, (total, deleted))
    shared = context.broadcast(vocab)
    classes = max(distinct, 1) + 1  # the words, the end, and what no training text holds

    groups = max(1, -(-total // GROUP_TOKENS))
    pairs = rows.filter("role > 0").mapInArrow(
        _pair_counts(shared, groups), "g int, code binary, core binary, dev binary"
    )
    rare_uses = store(rows.mapInArrow(_rare_pairs(shared), RARE), "lm-rare-uses")
    summed = rare_uses.groupBy("before", "word").agg(
        F.sum("core").alias("core"), F.sum("dev").alias("dev")
    )
    rare_pairs = _with_counts(store(summed.mapInArrow(_listed_counts(shared), COUNTED), "lm-rare-sums"), words)
    events = "hot boolean, key bigint, n bigint"
    found = store(
        pairs.groupBy("g").applyInArrow(_events(shared), events)
        .unionByName(rare_pairs.filter("dev > 0").mapInArrow(_rare_events(total - deleted), events))
        .groupBy("hot", "key").agg(F.sum("n").alias("n")),
        "lm-events",
    ).collect()  # bounded: buckets x bins of both estimates, and HOT ** 2 pairs
    weights = learn_weights({r["key"]: r["n"] for r in found if not r["hot"]}, classes)
    hot = np.zeros((HOT + FIRST, HOT + FIRST), dtype=np.int64)
    for r in found:
        if r["hot"]:
            hot[r["key"] // vocab.width, r["key"] % vocab.width] = r["n"]
    hot_counts = context.broadcast(hot)

    local = rows.mapInArrow(_local(shared, hot_counts, weights, classes, total, distinct), PARTS)
    scores = rare_pairs.mapInArrow(_rare_scores(shared, weights, classes, total, distinct), SCORED)
    used = rare_uses.select("doc_id", "before", "word", "m").join(scores, ["before", "word"])
    rare = store(
        used.groupBy("doc_id").agg(
            F.lit(0).cast("bigint").alias("n_tokens"),
            F.sum(F.col("m") * F.col("known")).alias("n_known"),
            F.sum(F.col("m") * F.col("base")).alias("base"),
            F.sum(F.col("m") * F.col("score")).alias("score"),
        ),
        "lm-rare",
    )
    forget(rare_uses, rare_pairs)
    uses = rows.mapInArrow(
        _pair_uses(shared, groups), "g int, chunk bigint, code binary, many binary, ids binary, roles binary"
    )
    by_chunk = uses.groupBy("g").applyInArrow(_pair_scores(shared, weights, classes, total), "chunk bigint, ids binary, sums binary")
    used = by_chunk.groupBy("chunk").applyInArrow(_chunk_scores, "doc_id bigint, score double")
    zero = F.lit(0).cast("bigint")
    used = used.select(
        F.when(F.col("doc_id") != -(1 << 62), F.col("doc_id")).alias("doc_id"),
        "score",
    )
    used = used.select(
        "doc_id", zero.alias("n_tokens"), zero.alias("n_known"), F.lit(0.0).alias("base"), "score"
    )
    used = store(used.groupBy("doc_id").agg(*(F.sum(c).alias(c) for c in ("n_tokens", "n_known", "base", "score"))), "lm-pairs")
    parts = local.unionByName(rare).unionByName(used)
    return parts.groupBy("doc_id").agg(
        F.sum("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        F.sum("base").alias("base_score"),
        F.sum("score").alias("score"),
    )
