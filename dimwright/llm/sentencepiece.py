"""SentencePiece encoding and decoding for merge-type (BPE) vocabularies.

Encoding is exact backtracking instead of a merge queue. A sequence of pieces
is the merge result if and only if each neighbouring pair is what merging
their joined text gives, so the text is covered from the left: at each place
the longest piece (one Aho-Corasick pass finds all matches) is tried first,
then ever shorter ones; a piece must be compatible with the one before it,
which is tested by merging the two texts again; a bit field remembers places
from which no cover was found, so no place is explored twice.

No piece spans a blank that follows other characters, so a text is encoded in
units that start at a blank, and units that recur are looked up. The
vocabulary file is a parameter and is read by each Python worker's driver-sent
bytes, so it need not exist on the executors.

Defined results: a NULL text encodes as an empty one (begin and end id only).
Characters outside the vocabulary become byte pieces; a text may have any
length, its units being bounded by blanks and such characters. Repeated rows
are encoded each for itself; an empty table gives no rows. Columns beside the
text are kept; one that has the name of a result is replaced by it.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from dimwright.llm.common import chunks

BLANK = "▁"
# Entries a Python worker remembers: of units, the newest so many and as many
# before them; a full memory of pairs starts anew.
CACHE_UNITS, CACHE_PAIRS = 150_000, 300_000
# Kinds of vocabulary entries in the public model format.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6


class Vocabulary:
    """Pieces, merge priorities and byte pieces of a model file."""

    def __init__(self, model: bytes):
        from sentencepiece import sentencepiece_model_pb2

        proto = sentencepiece_model_pb2.ModelProto()
        proto.ParseFromString(model)
        if proto.trainer_spec.model_type != 2 or proto.normalizer_spec.name != "identity":
            raise ValueError("a merge-type model without normalisation is needed")
        if not proto.normalizer_spec.add_dummy_prefix or proto.normalizer_spec.remove_extra_whitespaces:
            raise ValueError("a model that adds one blank in front and keeps others is needed")
        self.pieces = [p.piece for p in proto.pieces]
        self.kinds = [p.type for p in proto.pieces]
        if USER in self.kinds or UNUSED in self.kinds:
            raise ValueError("a model without user-defined pieces is needed")
        self.ids = {p: i for i, p in enumerate(self.pieces) if self.kinds[i] == NORMAL}
        self.score = {p: proto.pieces[i].score for p, i in self.ids.items()}
        self.bytes = {int(p[3:5], 16): i for i, p in enumerate(self.pieces) if self.kinds[i] == BYTE}
        self.begin, self.end = self.pieces.index("<s>"), self.pieces.index("</s>")
        longer = [p for p in self.ids if len(p) > 1]
        if any(BLANK in p.lstrip(BLANK) for p in longer):
            raise ValueError("pieces must not span a blank inside")
        self.joinable = {c for p in longer for c in p}
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self._compatible: dict[tuple[str, str], bool] = {}
        self._finder = None

    def merged(self, text: str) -> list[str]:
        """Plain merging: the best-scored neighbouring pair first, leftmost on a tie."""
        parts = list(text)
        score = self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, left: str, right: str) -> bool:
        key = (left, right)
        known = self._compatible.get(key)
        if known is None:
            if len(self._compatible) >= CACHE_PAIRS:
                self._compatible.clear()
            # under the vocabulary's own strings: a cut of a text would be kept for each pair
            key = (self.own(left), self.own(right))
            known = self._compatible[key] = self.merged(left + right) == [left, right]
        return known

    def own(self, piece: str) -> str:
        i = self.ids.get(piece)
        return piece if i is None else self.pieces[i]

    def recent(self) -> tuple[dict[str, bytes], dict[str, bytes]]:
        """Units remembered, and those remembered before; both live as long as
        the worker, so no task adds to what the last one left."""
        if len(self.units) > CACHE_UNITS:
            self.units, self.older = {}, self.units
        return self.units, self.older

    def matches(self, text: str) -> list[list[int]]:
        """For every place the ends of the pieces that start there, ascending;
        a single character always matches, known or not."""
        if self._finder is None:
            import ahocorasick

            self._finder = ahocorasick.Automaton()
            for p in self.ids:
                if len(p) > 1:
                    self._finder.add_word(p, len(p))
            self._finder.make_automaton()
        found: list[list[int]] = [[i + 1] for i in range(len(text))]
        for last, length in self._finder.iter(text):
            found[last - length + 1].append(last + 1)  # ends come in order
        return found

    def cover(self, text: str) -> list[str]:
        """The merge result, by backtracking."""
        ends = self.matches(text)
        n, failed, at = len(text), 0, 0
        path: list[tuple[int, int]] = []  # start, rank of the end chosen
        rank = len(ends[0]) - 1 if n else -1
        while at < n:
            chosen = -1
            while rank >= 0:
                end = ends[at][rank]
                if not failed >> end & 1:
                    piece = text[at:end]
                    if path:
                        start, r = path[-1]
                        fits = self.compatible(text[start : ends[start][r]], piece)
                    else:
                        fits = True
                    # a piece alone must be a merge result as well
                    if fits and (rank == 0 or self.compatible_alone(piece)):
                        chosen = rank
                        break
                rank -= 1
            if chosen >= 0:
                path.append((at, chosen))
                at = ends[at][chosen]
                rank = len(ends[at]) - 1 if at < n else -1
            else:
                failed |= 1 << at
                at, rank = path.pop()
                rank -= 1
        return [text[s : ends[s][r]] for s, r in path]

    def compatible_alone(self, piece: str) -> bool:
        known = self._compatible.get((piece, ""))
        if known is None:
            known = self._compatible[(self.own(piece), "")] = self.merged(piece) == [piece]
        return known

    def unit_ids(self, unit: str) -> bytes:
        """Ids of a unit as little-endian 32-bit numbers."""
        out: list[int] = []
        for piece in self.cover(unit):
            i = self.ids.get(piece)
            if i is None:
                out.extend(self.bytes[b] for b in piece.encode("utf-8"))
            else:
                out.append(i)
        return struct.pack(f"<{len(out)}I", *out)

    def splitter(self) -> re.Pattern[str]:
        """Units: blanks with what follows them, and, apart, runs of characters
        that no longer piece holds (they never merge)."""
        joinable = "".join(re.escape(c) for c in sorted(self.joinable - {BLANK}))
        return re.compile(f"{BLANK}*[{joinable}]+|{BLANK}+|[^{joinable}{BLANK}]")

    def decode(self, ids: list[int]) -> str:
        """Text of the ids: control ids say nothing, byte pieces join to UTF-8
        (what is none reads U+FFFD per byte), the blank put in front goes."""
        if not hasattr(self, "_plain"):
            self._plain = [
                "" if k == CONTROL else " ⁇ " if k == UNKNOWN else None if k == BYTE else p.replace(BLANK, " ")
                for p, k in zip(self.pieces, self.kinds)
            ]
            self._byte_of = {i: b for b, i in self.bytes.items()}
        texts = [self._plain[i] for i in ids]
        if None in texts:
            joined, run = [], bytearray()
            for i, t in zip(ids, texts):
                if t is None:
                    run.append(self._byte_of[i])
                    continue
                if run:
                    joined.append(_utf8(bytes(run)))
                    run.clear()
                joined.append(t)
            joined.append(_utf8(bytes(run)))
            texts = joined
        first = next((i for i in ids if self.kinds[i] != CONTROL), None)
        text = "".join(texts)
        return text[1:] if first is not None and self.kinds[first] == NORMAL and text[:1] == " " else text


def _utf8(run: bytes) -> str:
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(run):
            for size in (1, 2, 3, 4):
                try:
                    out.append(run[at : at + size].decode("utf-8"))
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                size = 1
            at += size
        return "".join(out)


_loaded: dict[str, Vocabulary] = {}


def vocabulary(model: bytes) -> Vocabulary:
    key = hashlib.sha256(model).hexdigest()
    if key not in _loaded:
        _loaded[key] = Vocabulary(model)
    return _loaded[key]


class Encoder:
    """Encodes texts, remembering the ids of recurring units."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.split = vocab, vocab.splitter()
        self.edges = np.array([vocab.begin, vocab.end], dtype="<u4").tobytes()

    def ids(self, text: str | None) -> bytes:
        if not text:
            return self.edges
        (known, older), out = self.vocab.recent(), []  # what recurs is taken over again
        for unit in self.split.findall(BLANK + text.replace(" ", BLANK)):
            code = known.get(unit)
            if code is None:
                code = older.get(unit) or self.vocab.unit_ids(unit)
                if len(unit) <= 64:
                    known[unit] = code
            out.append(code)
        return self.edges[:4] + b"".join(out) + self.edges[4:]


def _rows(model: bytes, text: str, kept: list[str], digests: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(model)
        encoder = Encoder(vocab)
        for batch in batches:
            for part in chunks(batch, text):
                counts, ids_out, text_out = [], [], []
                for value in part[text].to_pylist():
                    packed = encoder.ids(value)
                    ids = np.frombuffer(packed, dtype="<u4")
                    decoded = vocab.decode(ids.tolist())
                    counts.append(len(ids))
                    if digests:
                        ids_out.append(hashlib.sha256(packed).hexdigest())
                        text_out.append(hashlib.sha256(decoded.encode("utf-8")).hexdigest())
                    else:
                        ids_out.append(ids.astype(np.int32))
                        text_out.append(decoded)
                columns = [part[c] for c in kept] + [
                    pa.array(counts, pa.int64()),
                    pa.array(ids_out, pa.string() if digests else pa.list_(pa.int32())),
                    pa.array(text_out, pa.string()),
                ]
                added = ["n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["n_tokens", "ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *added])

    return run


def encode_texts(docs: DataFrame, text: str, model: bytes, digests: bool = False) -> DataFrame:
    """The columns of ``docs`` but the text, with ``n_tokens``, ``ids`` and
    ``decoded``; with ``digests`` the sha256 of both stands in their place."""
    added = {"n_tokens", "ids", "decoded", "ids_sha256", "decoded_sha256"}
    kept = [c for c in docs.columns if c != text and c.lower() not in added]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*kept).schema)
    more = (
        "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
        if digests
        else "n_tokens bigint, ids array<int>, decoded string"
    )
    return docs.select(*kept, text).mapInArrow(
        _rows(model, text, kept, digests), f"{schema}, {more}" if schema else more
    )
