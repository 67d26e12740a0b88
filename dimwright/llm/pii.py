"""Personal data: patterns, and terms that give protected entities away.

Patterns find e-mail addresses, IP numbers, cards and phones. Each distinct
value is a protected entity. The words around its mentions are then weighed by
what they disclose: with the corpus-wide counts, a term t reveals an entity e
by ``log2(p(e | t) / p(e))`` bits. A term is disclosing when it was seen with
the entity in several different contexts, most texts that hold the term hold
that entity, and the information reaches a bar. Disclosing terms are removed
where they alone name the entity (p = 1) and generalised to ``<TERM>`` else.
They are hidden wherever they occur, with or without the entity.

Contexts are counted once per different window text, so copies of a document
add no weight. Candidate terms and disclosing terms travel to the texts as
Bloom filters of fixed size; only words that pass meet the exact counts.

Defined results: NULL reads as empty and has no spans. Spans of one kind do
not overlap; a span inside another kind is kept in the list, and in the
sanitised text the earlier and longer wins. Repeated rows give the same spans
each. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dimwright.llm.common import chunks, store

# Fixed values of the query contract.
KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
RUN = re.compile(r"[^\W\d_]{3,}")  # what counts as a term

AROUND = 6  # words looked at on either side of a mention
CONTEXTS = 3  # different contexts a disclosing term needs
SHARE = 0.5  # least p(entity | term)
BITS = 6.0  # least information
FILTER_BITS = 23


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start; failing matches are
    dropped and not tried again."""
    out: list[tuple[str, int, int]] = []
    if "@" in text:
        out += [("email", *m.span()) for m in EMAIL.finditer(text)]
    if DIGIT.search(text):
        for m in IP.finditer(text):
            if all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in m[0].split(".")):
                out.append(("ip", *m.span()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                    out.append(("phone", *m.span()))
    return out


def terms_near(text: str, spans: list[tuple[str, int, int]]) -> list[tuple[str, str, str]]:
    """(entity, term, context) for the words around each mention."""
    if not spans:
        return []
    words = [m.span() for m in WORD.finditer(text)]
    starts = np.array([w[0] for w in words])
    masked = [(s, e) for _, s, e in spans]
    out = []
    for kind, start, end in spans:
        at = int(np.searchsorted(starts, start, side="right")) - 1
        after = int(np.searchsorted(starts, end))
        near = [w for w in words[max(0, at - AROUND) : at] + words[after : after + AROUND]
                if not any(s < w[1] and w[0] < e for s, e in masked)]
        entity = f"{kind}:{text[start:end].lower()}"
        context = hashlib.blake2b(" ".join(text[a:b] for a, b in near).lower().encode(), digest_size=8).hexdigest()
        terms = {t for a, b in near for t in RUN.findall(text[a:b].lower())}
        out += [(entity, t, context) for t in terms]
    return out


def _places(term: str) -> tuple[int, int]:
    h = hashlib.blake2b(term.encode("utf-8", "surrogatepass"), digest_size=8).digest()
    mask = (1 << FILTER_BITS) - 1
    return int.from_bytes(h[:4], "little") & mask, int.from_bytes(h[4:], "little") & mask


def _filter_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << FILTER_BITS, dtype=bool)
    for batch in batches:
        for term in batch["term"].to_pylist():
            for place in _places(term):
                bits[place] = True
    yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])


def _term_filter(terms: DataFrame):
    bits = np.zeros((1 << FILTER_BITS) // 8, dtype=np.uint8)
    for row in terms.select("term").coalesce(4).mapInArrow(_filter_of, "bits binary").collect():
        bits |= np.frombuffer(row["bits"], dtype=np.uint8)  # four rows of fixed size
    return terms.sparkSession.sparkContext.broadcast(bits.tobytes())


class _Sieve:
    """Whether a term may be one of the filter's, remembered for recurring terms."""

    def __init__(self, packed: bytes):
        self.bits = np.unpackbits(np.frombuffer(packed, dtype=np.uint8)).astype(bool)
        self.empty = not self.bits.any()
        self.known: dict[str, bool] = {}

    def __call__(self, term: str) -> bool:
        may = self.known.get(term)
        if may is None:
            if len(self.known) > 300_000:
                self.known.clear()
            a, b = _places(term)
            may = self.known[term] = bool(self.bits[a] and self.bits[b])
        return may


def _mentions(text: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, text):
                rows = {r for t in part[text].to_pylist() if t for r in terms_near(t, pattern_spans(t))}
                if rows:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.string()) for c in zip(*rows)], names=["entity", "term", "context"]
                    )

    return run


def _holders(text: str, sieve_bits) -> Callable:
    """(term, text digest) once per task for every text that may hold a candidate."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = _Sieve(sieve_bits.value)
        if sieve.empty:
            return
        for batch in batches:
            for part in chunks(batch, text):
                terms, digests = [], []
                for value in set(part[text].to_pylist()) - {None, ""}:
                    held = [t for t in set(RUN.findall(value.lower())) if sieve(t)]
                    if held:
                        digest = hashlib.blake2b(value.encode(), digest_size=8).digest()
                        terms += held
                        digests += [int.from_bytes(digest, "little", signed=True)] * len(held)
                if terms:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(terms, pa.string()), pa.array(digests, pa.int64())], names=["term", "digest"]
                    )

    return run


def _least_holders(text: str, sieve_bits) -> Callable:
    """(term, n, mask) summed up in the task: the different texts that may hold
    a candidate, and the classes (of 64) of their digests."""

    def rows(found: dict[str, list[int]]) -> pa.RecordBatch:
        n, mask = (np.array(c, dtype=np.uint64).view(np.int64) for c in zip(*found.values()))
        return pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.string()), pa.array(n), pa.array(mask)], names=["term", "n", "mask"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = _Sieve(sieve_bits.value)
        if sieve.empty:
            return
        seen: set[bytes] = set()
        found: dict[str, list[int]] = {}
        for batch in batches:
            for part in chunks(batch, text):
                for value in part[text].to_pylist():
                    digest = hashlib.blake2b((value or "").encode(), digest_size=8).digest()
                    if not value or digest in seen:
                        continue
                    seen.add(digest)
                    for t in set(RUN.findall(value.lower())):
                        if sieve(t):
                            held = found.setdefault(t, [0, 0])
                            held[0] += 1
                            held[1] |= 1 << (digest[0] & 63)
                if len(found) > 300_000:
                    yield rows(found)
                    found = {}
        if found:
            yield rows(found)

    return run


def _scored(joint: DataFrame, n_term: str, total: int) -> DataFrame:
    """Adds share and bits, and keeps what reaches both bars."""
    share = F.least(F.lit(1.0), F.col("n_joint") / F.col(n_term))
    bits = F.log2(F.col("share") * F.lit(float(max(total, 1))) / F.col("n_entity"))
    scored = joint.withColumn("share", share).withColumn("bits", bits)
    return scored.filter((F.col("share") >= SHARE) & (F.col("bits") >= BITS))


def disclosing_terms(docs: DataFrame, text: str) -> DataFrame:
    """(term, bits, share): terms that exceed the thresholds for some entity.

    The texts of a term are counted in two steps. What single tasks see, and the
    digest classes of all tasks together, are never more than the true count, so
    a pair that misses a bar with them misses it for certain. Common words go
    that way; the texts of the others are counted exactly."""
    rows = docs.select(F.col(text).alias("text"))
    near = store(
        rows.mapInArrow(_mentions("text"), "entity string, term string, context string").distinct(), "pii-contexts"
    )
    joint = near.groupBy("entity", "term").agg(F.count("*").alias("n_joint"))
    entities = near.groupBy("entity").agg(F.count_distinct("context").alias("n_entity"))
    total = near.select("context").distinct().count()
    often = store(joint.filter(F.col("n_joint") >= CONTEXTS).join(entities, "entity"), "pii-often")
    least = (
        rows.mapInArrow(_least_holders("text", _term_filter(often)), "term string, n bigint, mask bigint")
        .groupBy("term")
        .agg(F.greatest(F.max("n"), F.bit_count(F.bit_or("mask")).cast("bigint")).alias("n_least"))
    )
    candidates = store(
        _scored(often.join(least, "term"), "n_least", total).select("entity", "term", "n_joint", "n_entity"),
        "pii-candidates",
    )
    held = rows.mapInArrow(_holders("text", _term_filter(candidates)), "term string, digest bigint")
    spread = (
        held.join(candidates.select("term").distinct(), "term", "left_semi")
        .distinct()
        .groupBy("term")
        .agg(F.count("*").alias("n_term"))
    )
    scored = _scored(candidates.join(spread, "term"), "n_term", total)
    return store(scored.groupBy("term").agg(F.max("bits").alias("bits"), F.max("share").alias("share")), "pii-terms")


def _base(text: str, sieve_bits) -> Callable:
    """Each row with its pattern spans and the places of words that may disclose."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sieve = _Sieve(sieve_bits.value)
        for batch in batches:
            for part in chunks(batch, text):
                spans, terms = [], []
                for value in part[text].to_pylist():
                    value = value or ""
                    spans.append(",".join(f"{k}:{a}:{b}" for k, a, b in pattern_spans(value)))
                    found = []
                    if value and not sieve.empty:
                        low = value.lower()
                        if len(low) != len(value):  # a letter whose lower case is longer
                            low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
                        if any(sieve(t) for t in set(RUN.findall(low))):
                            found = [
                                {"term": m[0], "at": m.start()} for m in RUN.finditer(low) if sieve(m[0])
                            ]
                    terms.append(found)
                columns = [c for c in part.schema.names]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(spans, pa.string()),
                     pa.array(terms, pa.list_(pa.struct([("term", pa.string()), ("at", pa.int32())])))],
                    names=[*columns, "base_spans", "_maybe"],
                )

    return run


def find_spans(docs: DataFrame, text: str, keep_text: bool = False) -> DataFrame:
    """The columns of ``docs`` (without the text unless asked for) with
    ``base_spans`` and ``term_spans``: comma-joined kind:start:end in code points."""
    terms = disclosing_terms(docs, text)
    sieve = _term_filter(terms)
    made = {"base_spans", "term_spans", "_maybe", "_row"}
    kept = [c for c in docs.columns if c != text and c.lower() not in made]
    rows = docs.select(*kept, text)
    places = T.ArrayType(T.StructType([T.StructField("term", T.StringType()), T.StructField("at", T.IntegerType())]))
    made_fields = [T.StructField("base_spans", T.StringType()), T.StructField("_maybe", places)]
    found = rows.mapInArrow(_base(text, sieve), T.StructType([*rows.schema.fields, *made_fields]))
    if not keep_text:
        found = found.drop(text)
    found = store(found.withColumn("_row", F.monotonically_increasing_id()), "pii-spans")
    suspected = found.filter(F.size("_maybe") > 0).select("_row", F.explode("_maybe").alias("m"))
    known = suspected.select("_row", "m.term", "m.at").join(terms, "term")
    # the disclosing words of one text: bounded by the text
    end = F.col("at") + F.length("term")
    kind = F.when(F.col("share") >= 1, "name").otherwise("term")
    span = F.concat_ws(":", kind, F.col("at").cast("string"), end.cast("string"))
    listed = known.groupBy("_row").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct(kind.alias("k"), "at", span.alias("s")))), lambda x: x["s"]),
            ",",
        ).alias("term_spans")
    )
    # only texts with suspected words are dealt out
    clear = found.filter(F.size("_maybe") == 0).withColumn("term_spans", F.lit(""))
    mixed = found.filter(F.size("_maybe") > 0).join(listed, "_row", "left")
    mixed = mixed.withColumn("term_spans", F.coalesce("term_spans", F.lit("")))
    return clear.unionByName(mixed).drop("_maybe", "_row")


def _hide(text: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = (batch[c].to_pylist() for c in (text, "base_spans", "term_spans"))
            for value, base, terms in zip(*columns):
                spans = [s.split(":") for s in f"{base},{terms}".split(",") if s]
                if value is None or not spans:
                    out.append(value)
                    continue
                places = sorted((int(a), -int(b), k) for k, a, b in spans)
                pieces, at = [], 0
                for a, b, k in places:
                    if a < at:
                        continue
                    pieces.append(value[at:a])
                    pieces.append("" if k == "name" else f"<{k.upper()}>")
                    at = -b
                out.append("".join([*pieces, value[at:]]))
            names = [c for c in batch.schema.names if c not in (text, "base_spans", "term_spans")]
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in names), pa.array(out, pa.string())], names=[*names, text]
            )

    return run


def sanitise(docs: DataFrame, text: str) -> DataFrame:
    """``docs`` with personal data replaced by its kind, disclosing terms by
    ``<TERM>``, and terms that alone name an entity removed."""
    # the row goes along as one struct, so that no column of it can meet one made here
    packed = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("body"))
    found = find_spans(packed, "body", keep_text=True)
    clean = found.mapInArrow(_hide("body"), found.select("row", "body").schema)
    return clean.select(*[F.col("body").alias(c) if c == text else F.col("row")[c].alias(c) for c in docs.columns])
