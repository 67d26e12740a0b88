"""Collocations: phrases whose words occur together more than their parts suggest.

First it is found out what may reach ``least`` at all, level by level. Tasks
count 64-bit keys of words and word pairs, write them as runs sorted by key,
and every prefix of the key space is merged in one task. The keys that reach
``least`` become a bit filter, and the next pass counts keys of longer phrases
both of whose parts are in it. A key may stand for two phrases, so a filter
lets too much through at times and never too little.

The last pass counts exactly, in a HAT-trie per task. Under a shallow trie of
word ids hang hash containers that map the rest of a phrase to its count; a
container that grows past its bound bursts into a node with a container per
next word. Only phrases of the filters enter. When the trie holds too many
entries, whole subtrees leave it, largest first, as runs sorted by phrase, one
row for each lang and partition, and every partition's runs are merged in one
task. (A first word may begin a large share of all phrases, so the partitions
go by a hash of the whole word path.)

What follows works on the phrases that reach ``least``: every part of such a
phrase reaches it too, so the counts of both parts are look-ups in the same
table, single words spread over salts because one word is part of many
phrases. Products are decimals, so scores are exact.

Defined results: NULL and empty texts hold no words, a NULL lang counts as
``und``. Rows are counted each for itself, repeated or not. Texts of any
length are read whole. Score ties go to the higher count, then to the phrase
that comes first in byte order; two cuts with one floored score go to the
shorter first part. No rows give no rows; columns beside text and lang do not
take part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimwright.llm.common import (
    LOWERED,
    chunks,
    forget,
    mix,
    sequence_hashes,
    signed,
    store,
    text_bytes,
    word_hashes,
)

LEAST = 10
MAX_WORDS = 3
COVERED = 50  # percent of a phrase's count inside a longer one that drops it
TOP = 2000

BURST = 4096  # entries of a container
ENTRIES = 600_000  # of a task's trie before subtrees leave it
WORDS = 1_000_000  # ids of a task before it starts anew
RUN_ROWS = 1 << 16
SALTS = 16
READ_BYTES = 2 << 20  # of text looked at together
KEYS = 4_000_000  # of a task before they leave it as a run
FILTER_BITS = 1 << 29  # at most; 16 a key while they suffice
FILTER_BLOCK = 1 << 16

_ID_BITS = 32
_ID = (1 << _ID_BITS) - 1
# 1e15 occurrences in one lang; squared and times a million still exact
_COUNT = "decimal(15,0)"

# Fixed values of the query contract: what separates words, and what ends a piece as well.
_BLANKS = b" \t"
_BREAKS = b".,;:!?\n\x0b\x0c\r"


def _marks(chars: bytes) -> np.ndarray:
    lut = np.zeros(256, dtype=bool)
    lut[list(chars)] = True
    return lut


_BREAK, _GAP = _marks(_BREAKS), _marks(_BLANKS + _BREAKS)


class HatTrie:
    """Counts of word paths. Words are numbers from 1; the rest of a path is
    packed with its next word lowest, and 0 is the end of the path."""

    def __init__(self, burst: int = BURST):
        self.burst = burst
        self.children: dict[int, Subtree] = {}
        self.size = 0

    def add(self, first: int, rests: list[int], counts: list[int]) -> None:
        """Paths that begin with one word."""
        tree = self.children.get(first)
        if tree is None:
            tree = self.children[first] = Subtree()
        before = tree.size
        tree.add(rests, counts, self.burst)
        self.size += tree.size - before

    def largest(self, keep: int) -> list[int]:
        """First words of the subtrees to give up until ``keep`` entries stay."""
        out, left = [], self.size
        for first in sorted(self.children, key=lambda w: -self.children[w].size):
            if left <= keep:
                break
            out.append(first)
            left -= self.children[first].size
        return out

    def cut(self, first: int) -> Iterator[tuple[tuple[int, ...], int]]:
        """Takes a subtree out; its paths and counts."""
        tree = self.children.pop(first)
        self.size -= tree.size
        return tree.paths((first,))


class Subtree:
    """A hash container, or after its burst a node above further subtrees."""

    __slots__ = ("counts", "children", "size")

    def __init__(self) -> None:
        self.counts: dict[int, int] = {}
        self.children: dict[int, Subtree] | None = None
        self.size = 0

    def add(self, rests: list[int], counts: list[int], burst: int) -> None:
        if self.children is None:
            held = self.counts
            get = held.get
            for rest, n in zip(rests, counts):
                held[rest] = get(rest, 0) + n
            self.size = len(held)
            if self.size > burst:
                self._burst(burst)
        else:
            self._descend(rests, counts, burst)

    def _burst(self, burst: int) -> None:
        held, self.counts, self.children, self.size = self.counts, {}, {}, 0
        self._descend(list(held), list(held.values()), burst)

    def _descend(self, rests: list[int], counts: list[int], burst: int) -> None:
        split: dict[int, tuple[list[int], list[int]]] = {}
        for rest, n in zip(rests, counts):
            if rest == 0:
                self.size += 0 not in self.counts
                self.counts[0] = self.counts.get(0, 0) + n
            else:
                tails, ns = split.setdefault(rest & _ID, ([], []))
                tails.append(rest >> _ID_BITS)
                ns.append(n)
        for word, (tails, ns) in split.items():
            tree = self.children.get(word)
            if tree is None:
                tree = self.children[word] = Subtree()
            before = tree.size
            # a container of last words has nothing to burst into
            tree.add(tails, ns, burst if any(tails) else len(tails) + tree.size + 1)
            self.size += tree.size - before

    def paths(self, prefix: tuple[int, ...]) -> Iterator[tuple[tuple[int, ...], int]]:
        for rest, n in self.counts.items():
            path = prefix
            while rest:
                path += (rest & _ID,)
                rest >>= _ID_BITS
            yield path, n
        for word, tree in (self.children or {}).items():
            yield from tree.paths((*prefix, word))


@dataclass(frozen=True)
class _Words:
    """Words of a batch: place in its bytes, text, piece (a piece ends at its
    text's end too), number of the lang, and a key of lang and word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    lang: np.ndarray
    names: list[str]
    key: np.ndarray

    @classmethod
    def of(cls, batch: pa.RecordBatch) -> _Words:
        raw, at = text_bytes(batch["text"])
        raw = LOWERED[raw]
        langs = batch["lang"].to_pylist()
        names = sorted(set(langs))
        number = {name: i for i, name in enumerate(names)}
        if not len(raw):
            none = np.zeros(0, np.int64)
            return cls(raw, none, none, none, none, names, none.astype(np.uint64))
        inside = ~_GAP[raw]
        edge = np.zeros(len(raw) + 1, dtype=bool)
        edge[at] = True
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1] | edge[1:-1]
        ends[:-1] &= ~inside[1:] | edge[1:-1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        piece = np.cumsum(_BREAK[raw] | edge[:-1])[start]
        text = np.searchsorted(at, start, side="right") - 1
        lang = np.array([number[x] for x in langs], dtype=np.int64)[text]
        seeds = np.array(
            [int.from_bytes(hashlib.sha256(x.encode()).digest()[:8], "little") for x in names], dtype=np.uint64
        )
        key = mix(word_hashes(raw, start, end) ^ seeds[lang])
        return cls(raw, start, end, piece, lang, names, key)

    def runs(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Key of every run of ``size`` words of one piece, and its first place."""
        if size == 1:
            return self.key, np.arange(len(self.key))
        return sequence_hashes(self.key, self.piece, size)

    def candidates(self, size: int, shorter: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Of those, the runs whose two shorter runs are marked."""
        keys, first = self.runs(size)
        if shorter is None or size == 1:
            return keys, first
        both = shorter[first] & shorter[first + 1]
        return keys[both], first[both]

    def known(self, filters: list[Filter]) -> list[np.ndarray]:
        """For every size a mark at the places where a run in the filter begins."""
        marks: list[np.ndarray] = []
        for size, known in enumerate(filters, 1):
            keys, first = self.candidates(size, marks[-1] if marks else None)
            marks.append(np.zeros(len(self.key), dtype=bool))
            marks[-1][first] = known.has(keys)
        return marks


class Filter:
    """Two bits a key; knows every key it was made of."""

    def __init__(self, bits: np.ndarray):
        self.bits, self.size = bits, len(bits) * 8

    @staticmethod
    def places(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        mask = np.uint64(size - 1)
        return keys & mask, mix(keys + np.uint64(1)) & mask

    def __contains__(self, key: int) -> bool:
        return bool(self.has(np.array([key], dtype=np.uint64))[0])

    def has(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), dtype=bool)
        for at in self.places(keys, self.size):
            found &= (self.bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def frequent_keys(df: DataFrame, least: int, sizes: Sequence[int], shorter: Broadcast | None = None) -> DataFrame:
    """(key) of the phrases of the given sizes that may occur ``least`` times;
    ``shorter`` holds the filters of all smaller sizes."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    width = np.uint8 if least < 256 else np.uint32
    most = np.iinfo(width).max

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            for part in chunks(batch, "text", READ_BYTES):
                words = _Words.of(part)
                marks = words.known(shorter.value)[-1] if shorter else None
                held += [words.candidates(size, marks)[0] for size in sizes]
                if sum(map(len, held)) > KEYS:
                    yield run(held)
                    held = []
        if held:
            yield run(held)

    def run(held: list[np.ndarray]) -> pa.RecordBatch:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        counts = np.minimum(counts, most).astype(width)
        part = (keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
        cuts = np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))
        used = np.flatnonzero(np.diff(cuts))
        return pa.record_batch(
            [
                pa.array(used.astype(np.int32)),
                pa.array([keys[cuts[i] : cuts[i + 1]].tobytes() for i in used], pa.binary()),
                pa.array([counts[cuts[i] : cuts[i + 1]].tobytes() for i in used], pa.binary()),
            ],
            names=["part", "keys", "counts"],
        )

    def merge(found: pa.Table) -> pa.Table:
        keys = np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in found["keys"]])
        counts = np.concatenate([np.frombuffer(x.as_buffer(), width) for x in found["counts"]])
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order].astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        enough = np.add.reduceat(counts, first) >= least
        return pa.table({"key": signed(keys[first[enough]])})

    packed = df.mapInArrow(runs, "part int, keys binary, counts binary")
    return packed.groupBy("part").applyInArrow(merge, "key long")


def key_filter(keys: DataFrame, bits: int = FILTER_BITS) -> Filter:
    """The keys' filter, put together from blocks that tasks fill; its size
    follows their number up to ``bits``."""
    wanted = max(FILTER_BLOCK, 16 * keys.count())
    size = min(1 << (wanted - 1).bit_length(), bits)

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate(Filter.places(np.asarray(batch["key"]).view(np.uint64), size))
            at = np.unique(at.astype(np.int64))
            yield pa.record_batch(
                [pa.array((at // FILTER_BLOCK).astype(np.int32)), pa.array((at % FILTER_BLOCK).astype(np.int32))],
                names=["block", "bit"],
            )

    def fill(found: pa.Table) -> pa.Table:
        flags = np.zeros(FILTER_BLOCK, dtype=np.uint8)
        flags[np.asarray(found["bit"])] = 1
        packed = np.packbits(flags, bitorder="little").tobytes()
        return pa.table({"block": found["block"].slice(0, 1), "bits": pa.array([packed], pa.binary())})

    out = np.zeros(size // 8, dtype=np.uint8)
    filled = keys.mapInArrow(marks, "block int, bit int").groupBy("block").applyInArrow(fill, "block int, bits binary")
    for block, found in filled.collect():  # never more than ``bits``
        at = block * (FILTER_BLOCK // 8)
        out[at : at + FILTER_BLOCK // 8] = np.frombuffer(found, np.uint8)
    return Filter(out)


class _Counter:
    """A task's tries, one per lang, and its word ids."""

    def __init__(self, filters: list[Filter], parts: int, entries: int, burst: int):
        self.filters, self.parts, self.entries, self.burst = filters, parts, entries, burst
        self.ids: dict[bytes, int] = {}
        self.words: list[str] = [""]
        self.tries: dict[str, HatTrie] = {}
        self.totals: dict[str, int] = {}

    def read(self, batch: pa.RecordBatch) -> None:
        found = _Words.of(batch)
        for i, n in enumerate(np.bincount(found.lang, minlength=len(found.names)).tolist()):
            self.totals[found.names[i]] = self.totals.get(found.names[i], 0) + n
        marks = found.known(self.filters)
        begin = np.flatnonzero(marks[0])
        word = np.zeros(len(found.key), dtype=np.int64)
        word[begin] = self._ids(found, begin)
        # level by level: a path is its shorter path's number and one more word
        shorter = found.lang
        for level, mark in enumerate(marks, 1):
            begin = begin[mark[begin]]
            last = word[begin + level - 1]
            _, spot, inverse = np.unique(
                (shorter[begin] << _ID_BITS) | last, return_index=True, return_inverse=True
            )
            at = begin[spot]
            rests = [0] * len(at)
            for k in range(level - 1, 0, -1):
                rests = [(r << _ID_BITS) | w for r, w in zip(rests, word[at + k].tolist())]
            counts = np.bincount(inverse, minlength=len(at))
            self._put(found.lang[at], word[at], rests, counts, found.names)
            shorter = np.zeros(len(word), dtype=np.int64)
            shorter[begin] = inverse

    def _ids(self, found: _Words, at: np.ndarray) -> list[int]:
        data, ids, out = found.data.tobytes(), self.ids, []
        for a, b in zip(found.start[at].tolist(), found.end[at].tolist()):
            w = data[a:b]
            n = ids.get(w)
            if n is None:
                n = ids[w] = len(self.words)
                self.words.append(w.decode())
            out.append(n)
        return out

    def _put(self, lang, first, rests: list[int], counts, names: list[str]) -> None:
        """Paths in order of lang and first word, a subtree at a time."""
        if not len(first):
            return
        order = np.lexsort((first, lang))
        lang, first, counts = lang[order], first[order], counts[order].tolist()
        rests = [rests[i] for i in order.tolist()]
        cuts = np.flatnonzero((np.diff(lang) != 0) | (np.diff(first) != 0)) + 1
        edges = [0, *cuts.tolist(), len(first)]
        for a, b in zip(edges, edges[1:]):
            trie = self.tries.setdefault(names[lang[a]], HatTrie(self.burst))
            trie.add(int(first[a]), rests[a:b], counts[a:b])

    def runs(self, everything: bool = False) -> Iterator[pa.RecordBatch]:
        """Subtrees that must go, as sorted runs."""
        held = sum(t.size for t in self.tries.values())
        anew = everything or len(self.words) > WORDS
        if held <= self.entries and not anew:
            return
        for lang, trie in self.tries.items():
            keep = 0 if anew else trie.size * self.entries // (2 * held)
            lines: list[tuple[str, int]] = []
            for first in trie.largest(keep):
                run = [(" ".join([self.words[w] for w in path]), n) for path, n in trie.cut(first)]
                run.sort()
                lines += run
                if len(lines) >= RUN_ROWS:
                    yield self._run(lang, lines)
                    lines = []
            if lines:
                yield self._run(lang, lines)
        if anew:
            self.ids, self.words, self.tries = {}, [""], {}
        if everything:
            for lang, n in self.totals.items():
                yield self._run(lang, [("", n)])

    def _run(self, lang: str, lines: list[tuple[str, int]]) -> pa.RecordBatch:
        """Sorted lines, a row for each partition."""
        dealt: dict[int, tuple[list[str], list[int]]] = {}
        for phrase, n in lines:
            phrases, counts = dealt.setdefault(crc32(phrase.encode()) % self.parts, ([], []))
            phrases.append(phrase)
            counts.append(n)
        return pa.record_batch(
            [
                pa.array(list(dealt), pa.int32()),
                pa.array([lang] * len(dealt), pa.string()),
                pa.array([p for p, _ in dealt.values()], pa.list_(pa.string())),
                pa.array([n for _, n in dealt.values()], pa.list_(pa.int64())),
            ],
            names=["part", "lang", "phrases", "counts"],
        )


def phrase_counts(
    df: DataFrame, text: str, lang: Column, least: int, max_words: int, entries: int = ENTRIES, burst: int = BURST
) -> DataFrame:
    """(lang, phrase, n) of all word sequences that occur ``least`` times, and
    every lang's number of words under the empty phrase."""

    rows = df.select(F.col(text).alias("text"), lang.alias("lang"))
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    filters: list[Filter] = []
    known = None
    for sizes in [range(1, min(2, max_words) + 1), *([size] for size in range(3, max_words + 1))]:
        keys = store(frequent_keys(rows, least, sizes, known), "keys")
        # words and pairs share one filter
        filters += [key_filter(keys)] * len(sizes)
        forget(keys)
        known = spark.sparkContext.broadcast(list(filters))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _Counter(known.value, parts, entries, burst)
        for batch in batches:
            for part in chunks(batch, "text", READ_BYTES):
                counter.read(part)
                yield from counter.runs()
        yield from counter.runs(everything=True)

    def merge(runs: pa.Table) -> pa.Table:
        runs = runs.combine_chunks()
        lines = pa.table(
            {
                "lang": runs["lang"].take(pc.list_parent_indices(runs["phrases"])),
                "phrase": pc.list_flatten(runs["phrases"]),
                "n": pc.list_flatten(runs["counts"]),
            }
        )
        summed = lines.group_by(["lang", "phrase"]).aggregate([("n", "sum")]).rename_columns(["lang", "phrase", "n"])
        return summed.filter(pc.or_(pc.greater_equal(summed["n"], least), pc.equal(summed["phrase"], "")))

    runs = rows.mapInArrow(count, "part int, lang string, phrases array<string>, counts array<long>")
    return runs.groupBy("part").applyInArrow(merge, "lang string, phrase string, n long")


def _parts(words: str, a: Column, n: Column) -> Column:
    return F.array_join(F.slice(F.col(words), a, n), " ")


def _counted(rows: DataFrame, part: str, counts: DataFrame, name: str) -> DataFrame:
    """Rows with the count of one of their parts; single words are salted."""
    one = ~F.contains(F.col(part), F.lit(" "))
    salted = rows.withColumn(
        "_salt", F.when(one, F.pmod(F.xxhash64("phrase"), F.lit(SALTS))).otherwise(0).cast("int")
    )
    one_word = ~F.contains(F.col("phrase"), F.lit(" "))
    spread = counts.select(
        "lang",
        F.col("phrase").alias(part),
        F.col("n").alias(name),
        F.explode(F.sequence(F.lit(0), F.when(one_word, SALTS - 1).otherwise(0))).alias("_salt"),
    )
    return salted.join(spread, ["lang", part, "_salt"]).drop("_salt")


def score_phrases(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, k, l, r, score) of every phrase of two or more
    words: the cut with the lowest score."""
    phrases = (
        counts.filter(F.contains(F.col("phrase"), F.lit(" ")))
        .withColumn("words", F.split("phrase", " "))
        .withColumnRenamed("n", "a")
    )
    size = F.size("words")
    cuts = phrases.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1))).select(
        "lang",
        "phrase",
        "a",
        "k",
        _parts("words", F.lit(1), F.col("k")).alias("left"),
        _parts("words", F.col("k") + 1, size - F.col("k")).alias("right"),
    )
    known = counts.filter(F.col("phrase") != "")
    both = _counted(_counted(cuts, "left", known, "l"), "right", known, "r")
    a, left, right = (F.col(c).cast(_COUNT) for c in ("a", "l", "r"))
    worth = F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), left * right)
    lowest = F.min(F.struct(worth.alias("score"), "k", "l", "r"))
    return (
        both.groupBy("lang", "phrase")
        .agg(F.max("a").alias("a"), lowest.alias("cut"))
        .select("lang", "phrase", F.split("phrase", " ").alias("words"), "a", "cut.*")
    )


def drop_covered(scored: DataFrame, covered: int, max_words: int) -> DataFrame:
    """Phrases that do not mostly occur as part of one longer phrase."""
    spans = [(at, size) for size in range(2, max_words) for at in range(1, max_words - size + 2)]
    if not spans:
        return scored
    inner = [
        F.when((F.size("words") > size) & (F.size("words") >= at + size - 1), _parts("words", F.lit(at), F.lit(size)))
        for at, size in spans
    ]
    held = F.array_compact(F.array(*inner))
    around = (
        scored.select("lang", "a", F.explode(F.array_distinct(held)).alias("phrase"))
        .groupBy("lang", "phrase")
        .agg(F.max("a").alias("longest"))
    )
    keep = F.coalesce(100 * F.col("longest") < covered * F.col("a"), F.lit(True))
    return scored.join(around, ["lang", "phrase"], "left").filter(keep).drop("longest")


def collocations(
    df: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = LEAST,
    max_words: int = MAX_WORDS,
    covered: int = COVERED,
    top: int = TOP,
    entries: int = ENTRIES,
    burst: int = BURST,
) -> DataFrame:
    """The ``top`` phrases of every lang: lang, rank, phrase, a, l, r, n, score."""
    named = F.coalesce(F.col(lang).cast("string"), F.lit("und"))
    counts = store(phrase_counts(df, text, named, least, max_words, entries, burst), "phrases")
    scored = store(score_phrases(counts), "scored")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = (
        drop_covered(scored, covered, max_words)
        .withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= top)
    )
    totals = counts.filter(F.col("phrase") == "").select("lang", "n")
    numbers = [F.col(c).cast("long").alias(c) for c in ("a", "l", "r", "n", "score")]
    # a row per lang in the data
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", *numbers)
