"""Benchmark decontamination by templates.

Every text becomes a sequence of template tokens: words in lower case without
outer punctuation, numbers as ``#num``, units after a number or written onto
it as ``#unit``, a run of capitalised words inside a sentence as one
``#name``; what a placeholder stands for is its slot value. Windows of a fixed
number of tokens are hashed and joined with the benchmark's; a question that
was copied with other numbers or names still has the same windows. A window
with too few plain words to tell anything is hashed with its slot values, so
that an item made of such windows is still found by its copies.

The hits of one text and item are then chained: runs of hits whose places grow
in both and whose distance drifts by at most ``DRIFT`` tokens, so that words
put in, left out or replaced do not part a copy. A chain must hold
``COVERAGE`` of the item's tokens, and ``LEAST`` of them (or all). Slot
consistency decides: along the chain each value of the item must stand
against one value of the text only.

A Bloom filter of the benchmark's windows, sized by their number up to
``2 ** FILTER_BITS`` bits, travels to the texts; only windows that may be
listed leave their task, and the exact hash join drops the rest.

Defined results: NULL and empty texts and items match nothing. An item shorter
than a window is one window. An item is listed as it reads at the begin of a
sentence and inside one. Repeated rows of a document add no evidence; different
texts under one id are judged each for itself and the best speaks for the id.
Ties between chains go to the earliest. Empty tables give no rows. Columns of
``documents`` other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from dimwright.llm.common import (
    LOWERED,
    chunks,
    mix,
    sequence_hashes,
    signed,
    store,
    text_bytes,
    word_hashes,
    word_spans,
)

WINDOW = 5
# Plain words that a window needs to stand for its template.
LITERALS = 3
COVERAGE = 0.5
LEAST = 8
DRIFT = 10
FILTER_BITS = 24
# Words of a task whose reading is remembered.
REMEMBERED = 100_000
# Units that may follow a number.
UNITS = frozenset(
    "mm cm m km in ft mi mg g kg t lb oz ml l s sec ms min h hr day days week weeks month months year years "
    "hours minutes seconds meters metres miles feet inches pounds grams kilograms liters litres percent % "
    "degrees dollars euros cents usd eur gbp kb mb gb tb hz khz mhz ghz w kw v a".split()
)
EDGE = "\"'()[]{}<>«»“”‘’.,;:!?¡¿…"
CLOSING = "\"')]}>»”’"
NUMBER = regex.compile(r"([+-]?[$€£]?\p{N}[\p{N}.,:/-]*)(\p{L}+|%)?")

PLAIN, NUM, UNIT, NAME = range(4)
KIND = ("", "#num", "#unit", "#name")
KIND_HASH = np.array([xxh64_intdigest(f"slot {k}") for k in KIND], dtype=np.uint64)
BY_VALUE = np.uint64(xxh64_intdigest("by value"))


class Word(NamedTuple):
    """How a word reads by itself: its form without outer punctuation, in lower
    case, and what it can be."""

    low: str
    unit: str  # a unit written onto a number
    number: bool
    capital: bool
    ends: bool  # a sentence
    breaks: bool  # a run of names


def read_word(word: str) -> Word:
    core = word.strip(EDGE)
    found = NUMBER.fullmatch(core)
    unit = (found[2] or "").lower() if found else ""
    number = bool(found) and (not unit or unit in UNITS)
    return Word(
        found[1] if number else core.lower(),
        unit if number else "",
        number,
        bool(core) and core[0].isupper() and not core.isupper(),
        word.rstrip(CLOSING)[-1:] in (".", "!", "?", "…"),
        word[-1] in EDGE,
    )


def _hashes(words: list[str]) -> np.ndarray:
    parts = [w.encode("utf-8", "surrogatepass") for w in words]
    end = np.cumsum([len(p) for p in parts], dtype=np.int64)
    raw = np.frombuffer(b"".join(parts) + b" ", dtype=np.uint8)
    return word_hashes(raw, np.concatenate([[0], end[:-1]]).astype(np.int64), end)


UNIT_HASHES = _hashes(sorted(UNITS))
FINAL = np.isin(np.arange(256), list(b".,;:!?"))
STOP = np.isin(np.arange(256), list(b".!?"))
A_Z = np.isin(np.arange(256), list(range(65, 91)))
LOWER_AZ = np.isin(np.arange(256), list(range(97, 123)))


class Spelling(NamedTuple):
    """What the bytes of words say: ``simple`` words are letters of ASCII or
    Latin-1 with ``.,;:!?`` after them at most; only the others are read one by one."""

    lowered: np.ndarray  # all bytes
    core: np.ndarray  # where each word ends without punctuation
    simple: np.ndarray
    capital: np.ndarray
    ends: np.ndarray
    breaks: np.ndarray


def spell(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> Spelling:
    lowered = LOWERED[raw]
    letter, small, upper = LOWER_AZ[raw] | A_Z[raw], LOWER_AZ[raw], A_Z[raw]
    # in UTF-8 a letter of Latin-1 is the byte C3 and one more
    lead = np.flatnonzero((raw[:-1] == 0xC3) & (raw[1:] >= 0x80) & (raw[1:] != 0x97) & (raw[1:] != 0xB7))
    big = lead[raw[lead + 1] <= 0x9E]
    lowered[big + 1] += 0x20
    upper[big] = True
    letter[lead] = letter[lead + 1] = True
    small[lead + 1] = raw[lead + 1] > 0x9E
    last = np.maximum.accumulate(np.where(FINAL[raw], -1, np.arange(len(raw))))
    core = np.maximum(last[end - 1] + 1, start)
    other = np.concatenate([[0], np.cumsum(~letter)])
    smalls = np.concatenate([[0], np.cumsum(small)])
    some = core > start
    return Spelling(
        lowered, core, other[core] == other[start], some & upper[start] & (smalls[core] > smalls[start]),
        STOP[raw[end - 1]], FINAL[raw[end - 1]],
    )


class Templates:
    """Template tokens of many texts at once, one entry a token in each array."""

    def __init__(self, texts: pa.Array, known: dict[bytes, Word], opens: bool = True):
        raw, at = text_bytes(texts)
        start, end, doc = word_spans(raw, at)
        lowered, core, simple, capital, ends, breaks = spell(raw, start, end)
        low_hash = word_hashes(lowered, start, core)
        solid = core > start
        number, unit_hash = np.zeros(len(start), dtype=bool), np.zeros(len(start), np.uint64)
        glued = number.copy()
        self.lowered, self.start, self.core = lowered, start, core
        self.read: dict[int, Word] = {}
        if len(known) > REMEMBERED:
            known.clear()
        odd = np.flatnonzero(~simple)
        for i, a, b in zip(odd.tolist(), start[odd].tolist(), end[odd].tolist()):
            spelt = raw[a:b].tobytes()
            word = known.get(spelt)
            if word is None:
                word = known[spelt] = read_word(spelt.decode("utf-8", "replace"))
            self.read[i] = word
        if len(odd):
            low, unit, number[odd], capital[odd], ends[odd], breaks[odd] = zip(*self.read.values())
            low_hash[odd], unit_hash[odd] = _hashes(low), _hashes(unit)
            solid[odd], glued[odd] = [w != "" for w in low], [u != "" for u in unit]
        measure = np.isin(low_hash, UNIT_HASHES)

        # words of punctuation alone are no tokens, but may end a sentence
        ended = np.concatenate([[0], np.cumsum(ends)])
        place = np.flatnonzero(solid)
        opening = np.full(len(place), opens)
        opening[1:] = np.where(
            doc[place[1:]] != doc[place[:-1]], opens, ended[place[1:]] > ended[place[:-1]]
        )

        part = np.repeat(np.arange(len(place)), 1 + glued[place])
        second = np.zeros(len(part), dtype=bool)
        second[1:] = part[1:] == part[:-1]
        word = place[part]
        doc = doc[word]
        after = np.zeros(len(part), dtype=bool)  # has a token of the same text before it
        after[1:] = doc[1:] == doc[:-1]
        number = number[word] & ~second
        unit = np.zeros(len(part), dtype=bool)
        unit[1:] = number[:-1] & after[1:] & (second[1:] | measure[word[1:]])
        name = capital[word] & ~opening[part] & ~number & ~unit & ~second
        joined = np.zeros(len(part), dtype=bool)
        joined[1:] = name[1:] & name[:-1] & after[1:] & ~breaks[word[:-1]]

        head = np.flatnonzero(~joined)
        self.tail = np.append(head[1:], len(part))
        self.head, self.word, self.second = head, word, second
        self.kind = np.where(number, NUM, np.where(unit, UNIT, np.where(name, NAME, PLAIN)))[head]
        self.doc = doc[head]
        own = np.where(second, unit_hash[word], low_hash[word])
        if len(head):
            inside = np.arange(len(part)) - head[np.cumsum(~joined) - 1]
            spread = mix(own + inside.astype(np.uint64) * KIND_HASH[NAME])
            self.by_value = np.add.reduceat(spread, head)
        else:
            self.by_value = np.zeros(0, np.uint64)
        self.by_kind = np.where(self.kind == PLAIN, self.by_value, KIND_HASH[self.kind])
        counts = np.bincount(self.doc, minlength=len(texts))
        self.counts = counts
        self.begin = np.cumsum(counts) - counts

    def _form(self, part: int) -> str:
        place = int(self.word[part])
        read = self.read.get(place)
        if read:
            return read.unit if self.second[part] else read.low
        return self.lowered[self.start[place] : self.core[place]].tobytes().decode("utf-8")

    def value(self, token: int) -> str:
        return " ".join(self._form(i) for i in range(self.head[token], self.tail[token]))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and first tokens of all windows of ``size`` tokens."""
        alike, first = sequence_hashes(self.by_kind, self.doc, size)
        exact, _ = sequence_hashes(self.by_value, self.doc, size)
        plain = np.concatenate([[0], np.cumsum(self.kind == PLAIN)])
        enough = plain[first + size] - plain[first] >= min(LITERALS, size)
        return np.where(enough, alike, mix(exact ^ BY_VALUE)), first

    def slots(self, first: int, size: int) -> list[str]:
        return [
            f"{KIND[self.kind[i]]}:{self.value(i)}" for i in range(first, first + size) if self.kind[i] != PLAIN
        ]


def template(text: str, opens: bool = True) -> list[tuple[str, str]]:
    """(placeholder or empty, value) of each template token of one text."""
    found = Templates(pa.array([text]), {}, opens)
    return [(KIND[k], found.value(i)) for i, k in enumerate(found.kind.tolist())]


def _places(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << bits) - 1)
    return (hashes & mask).astype(np.int64), ((hashes >> np.uint64(32)) & mask).astype(np.int64)


ITEMS = "item_id bigint, opens boolean, n_tokens int, size int, window bigint, item_start int, item_slots array<string>"
SEEN = "doc_id bigint, digest bigint, size int, window bigint, start int, slots array<string>"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {
        "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string()),
        "double": pa.float64(),
    }
    names, types = zip(*(f.split() for f in schema.split(", ")))
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(zip(*rows), types)], names=names)


def _windows_of_items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All windows of every item, at the window's size or the item's if shorter."""
    known: dict[bytes, Word] = {}
    for batch in batches:
        for part in chunks(batch, "text"):
            ids = part["id"].to_pylist()
            rows: dict[tuple, tuple] = {}
            for opens in (True, False):
                found = Templates(part["text"], known, opens)
                for size in range(1, WINDOW + 1):
                    hashes, first = found.windows(size)
                    own = np.minimum(found.counts, WINDOW)[found.doc[first]] == size
                    for h, t in zip(signed(hashes[own]).tolist(), first[own].tolist()):
                        d = int(found.doc[t])
                        rows[d, opens, t] = (ids[d], opens, int(found.counts[d]), size, h,
                                             t - int(found.begin[d]), found.slots(t, size))
            if rows:
                yield _batch(list(rows.values()), ITEMS)


def _windows_of_texts(sizes: list[int], bits: int, filter_) -> Callable:
    """The windows of every text, of the listed sizes, that may be listed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = np.unpackbits(np.frombuffer(filter_.value, dtype=np.uint8), bitorder="little").astype(bool)
        known: dict[bytes, Word] = {}
        for batch in batches:
            for part in chunks(batch, "text"):
                found = Templates(part["text"], known)
                digests: dict[int, int] = {}
                rows = []
                for size in sizes:
                    hashes, first = found.windows(size)
                    a, b = _places(hashes, bits)
                    hit = listed[a] & listed[b]
                    for h, t in zip(signed(hashes[hit]).tolist(), first[hit].tolist()):
                        d = int(found.doc[t])
                        if d not in digests:
                            value = xxh64_intdigest(part["text"][d].as_py())
                            digests[d] = value - (1 << 64) if value >> 63 else value
                        rows.append((part["id"][d].as_py(), digests[d], size, h,
                                     t - int(found.begin[d]), found.slots(t, size)))
                if rows:
                    yield _batch(rows, SEEN)

    return run


def _filter_bits(listed: DataFrame, bits: int) -> bytes:
    """The Bloom filter, joined by blocks of 64 bits on the executors."""
    mask = F.lit((1 << bits) - 1)
    low = F.col("window").bitwiseAND(mask)
    high = F.shiftrightunsigned("window", 32).bitwiseAND(mask)
    places = listed.select(F.explode(F.array(low, high)).alias("place"))
    one = F.expr("shiftleft(1L, CAST(place % 64 AS INT))")
    blocks = places.groupBy(F.expr("place div 64").alias("block")).agg(F.bit_or(one).alias("mask"))
    found = blocks.toArrow()  # at most 2 ** FILTER_BITS / 64 rows
    words = np.zeros((1 << bits) // 64, dtype=np.int64)
    words[found["block"].to_numpy()] = found["mask"].to_numpy()
    return words.astype("<i8").tobytes()


class Chain(NamedTuple):
    matched: int
    start: int
    n_slots: int
    changed: int
    consistent: bool


def best_chain(hits: list[tuple[int, int, int, list, list]], n_tokens: int, least: float) -> Chain | None:
    """The best chain of hits (start, item_start, size, slots, item_slots) that
    holds ``least`` tokens: consistent before not, then by tokens, then the earliest."""
    runs: list[list] = []  # [start, end, item_start, item_end, pairs]
    for start, item_start, size, slots, item_slots in sorted(hits, key=lambda h: (h[0] - h[1], h[0])):
        pairs = set(zip(item_slots, slots))
        if runs and runs[-1][0] - runs[-1][2] == start - item_start and start <= runs[-1][1]:
            runs[-1][1], runs[-1][3] = start + size, item_start + size
            runs[-1][4] |= pairs
        else:
            runs.append([start, start + size, item_start, item_start + size, pairs])
    runs.sort(key=lambda r: (r[0], r[2]))
    score, before = [], []
    for k, (d0, d1, i0, i1, _) in enumerate(runs):
        best, link = d1 - d0, -1
        for j in range(k - 1, -1, -1):
            e0, e1, j0, j1, _ = runs[j]
            if d0 - e0 > 2 * n_tokens + DRIFT:
                break
            if e0 < d0 and j0 < i0 and abs((d0 - i0) - (e0 - j0)) <= DRIFT:
                gain = min(d1 - max(d0, e1), i1 - max(i0, j1))
                if gain > 0 and score[j] + gain > best:
                    best, link = score[j] + gain, j
        score.append(best)
        before.append(link)
    used: set[int] = set()
    first = None
    for k in sorted(range(len(runs)), key=lambda k: (-score[k], runs[k][0])):
        if score[k] < least:
            break
        if k in used:
            continue
        links, at = [], k
        while at >= 0:
            links.append(at)
            at = before[at]
        used.update(links)
        pairs = set().union(*(runs[j][4] for j in links))
        chain = Chain(score[k], runs[links[-1]][0], len(pairs), sum(i != d for i, d in pairs),
                      len({i for i, _ in pairs}) == len(pairs))
        if chain.consistent:
            return chain
        first = first or chain
    return first


JUDGED = (
    "doc_id bigint, item_id bigint, n_tokens int, n_matched int, start int, n_slots int, changed int, "
    "consistent boolean"
)


def _chains(coverage: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                hits = [(h["start"], h["item_start"], h["size"], h["slots"], h["item_slots"]) for h in r["hits"]]
                n = r["n_tokens"]
                chain = best_chain(hits, n, max(coverage * n, min(LEAST, n)))
                if chain:
                    rows.append((r["doc_id"], r["item_id"], n, chain.matched, chain.start, chain.n_slots,
                                 chain.changed, chain.consistent))
            if rows:
                yield _batch(rows, JUDGED)

    return run


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    coverage: float = COVERAGE,
) -> DataFrame:
    """(doc_id, item_id, n_tokens, n_matched, coverage, n_slots, consistent,
    changed) for each document with a chain of at least ``coverage`` of an
    item's tokens. ``consistent`` says whether the slot values fit; ``changed``
    counts values that differ from the item's. A leak is a consistent row."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_id).cast("bigint").alias("id"), F.col(item_text).alias("text"))
    listed = store(asked.mapInArrow(_windows_of_items, ITEMS).distinct(), "benchmark-windows")
    known = listed.agg(F.count("*").alias("n"), F.collect_set("size").alias("sizes")).first()  # sizes up to WINDOW
    bits = min(FILTER_BITS, max(12, (16 * known["n"]).bit_length()))
    filter_ = spark.sparkContext.broadcast(_filter_bits(listed, bits))

    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).alias("text"))
    seen = rows.mapInArrow(_windows_of_texts(sorted(known["sizes"]), bits, filter_), SEEN)
    hits = seen.join(listed, ["size", "window"])
    hit = F.struct("start", "item_start", "size", "slots", "item_slots")
    # the hits of one text and item, each once: bounded by the text's windows
    pairs = hits.groupBy("doc_id", "digest", "item_id", "opens", "n_tokens").agg(F.collect_set(hit).alias("hits"))
    reach = F.size("hits") * F.col("hits")[0]["size"]
    hopeful = pairs.filter(reach >= F.lit(coverage) * F.col("n_tokens"))
    judged = hopeful.select("doc_id", "item_id", "n_tokens", "hits").mapInArrow(_chains(coverage), JUDGED)
    order = F.struct("consistent", "n_matched", -F.col("start"), "n_slots", "changed", "n_tokens")
    best = judged.groupBy("doc_id", "item_id").agg(F.max(order).alias("b"))
    return best.select(
        "doc_id",
        "item_id",
        F.col("b.n_tokens").cast("bigint").alias("n_tokens"),
        F.col("b.n_matched").cast("bigint").alias("n_matched"),
        F.round(F.col("b.n_matched") / F.col("b.n_tokens"), 6).alias("coverage"),
        F.col("b.n_slots").cast("bigint").alias("n_slots"),
        "b.consistent",
        F.col("b.changed").cast("bigint").alias("changed"),
    )
