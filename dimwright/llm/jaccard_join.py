"""Near duplicates by an exact Jaccard join with adaptive multi-match prefixes.

A text is the set of its distinct five-word shingles (64-bit hashes). Shingles
have one total order: rare first, by a count sketch over all texts, then by
hash. If two sets reach the similarity, the prefixes that leave out all but
``overlap - l`` tokens of each share l tokens or more. Each text picks its own
l: a longer prefix is asked for where the estimated list lengths say that a
single shared token would bring many candidates, and a pair becomes a candidate
only if it shares the smaller of the two l, within the part of both prefixes that
the sizes of the two sets leave. Candidates are then verified
exactly on the whole sets.

Equal sets are one class from the start, so copies are never paired. Within
the list of a token, members are first paired with a few hubs only, then with
the next member in order of size, as hubs may belong to another group of texts.
What these links connect is contracted, and all remaining pairs are formed only
between members of different components. A large group of near copies is thus mostly
connected before its members are paired, and no link between different components is lost:
the last step omits only pairs that are connected already.

Families of texts just under the similarity share many tokens and are never
connected. Each text therefore has the parities of its shingles over 512 buckets,
or more for larger sets: every differing bit stands for a shingle that one text
has and the other lacks, so a pair with too many differing bits cannot reach
the similarity, and its whole sets are not compared. In the last step each text
of up to ``SIGNED`` shingles carries 512 of them, and such a pair never becomes a row.

The sketch is a fixed table of counters (a parameter). It steers the order and
the choice of l, that is the work, never the result.

Defined results: NULL and empty texts have no shingles and form a component of
their own each; a text of fewer than five words is one shingle. Rows that
share a doc_id are one document whose sets all belong to it. Repeated texts
fall into one component, whose id is the least doc_id. An empty table gives no
rows. Other columns are not read, so their names do not matter.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dimwright.llm import common
from dimwright.llm.common import forget, store
from dimwright.llm.components import connected_components

SHINGLE = 5
# Similarity as a fraction, so that bars are exact in whole numbers.
NUMERATOR, DENOMINATOR = 3, 4
SKETCH_BITS, SKETCH_PART = 22, 16
MOST_MATCHES = 8
VERIFY_COST = 4.0
BLOOM_BITS = 24
# Buckets of a signature, in words of 64 bits, and the largest set that they serve: beyond it even
# texts without a common shingle differ in too few buckets. Sets above half of it get twice the
# buckets, and so on.
SIGNATURE_WORDS = 8
SIGNED = SIGNATURE_WORDS * 32 * (DENOMINATOR + NUMERATOR) // (2 * (DENOMINATOR - NUMERATOR))
# A list is linked through hubs, then between neighbours in size, then whatever is apart still.
STEPS = ("hubs", "neighbours", "rest")
LAST, HUBS = STEPS[-1], 2


def shingle_sets(part: pa.RecordBatch, text: str, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, as (place of the text,
    hash), and the set sizes."""
    raw, at = common.text_bytes(part[text])
    raw = common.LOWERED[raw]
    start, end, doc = common.word_spans(raw, at)
    words = common.word_hashes(raw, start, end)
    value, first = common.sequence_hashes(words, doc, k)
    owner = doc[first]
    n_words = np.bincount(doc, minlength=part.num_rows)
    short = np.flatnonzero((n_words > 0) & (n_words < k))
    if len(short):
        begin = np.searchsorted(doc, short)
        whole = [
            common.sequence_hashes(words[b : b + n], np.zeros(n, np.int64), int(n))[0][0]
            for b, n in zip(begin, n_words[short])
        ]
        value = np.concatenate([value, np.array(whole, dtype=np.uint64)])
        owner = np.concatenate([owner, short])
    order = common.by_doc(owner, value)
    owner, value = owner[order], value[order]
    new = np.ones(len(value), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (value[1:] != value[:-1])
    owner, value = owner[new], value[new]
    return owner, value, np.bincount(owner, minlength=part.num_rows)


def set_keys(owner: np.ndarray, value: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """One number per set, whatever the order; together with the size it names a class."""
    keys = np.zeros(len(sizes), dtype=np.uint64)
    if len(value):
        filled = np.flatnonzero(sizes)
        begin = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
        keys[filled] = np.add.reduceat(common.mix(value), begin)
    return common.mix(keys + sizes.astype(np.uint64))


def signatures(owner: np.ndarray, value: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    """Parities of each set's shingles by bucket; NULL for empty sets."""
    has = sizes > 0
    doubled = np.ceil(np.log2(np.maximum(sizes / (SIGNED // 2), 1.0))).astype(np.int64)
    width = np.where(has, SIGNATURE_WORDS << doubled, 0)
    begin = np.concatenate([[0], np.cumsum(width)])
    bucket = (common.mix(value) >> np.uint64(32)) & (width[owner] * 64 - 1).astype(np.uint64)
    words = np.zeros(begin[-1], dtype=np.uint64)
    at = begin[owner] + (bucket >> np.uint64(6)).astype(np.int64)
    np.bitwise_xor.at(words, at, np.uint64(1) << (bucket & np.uint64(63)))
    # an entry whose begin is NULL is NULL
    begin = pa.array(begin, pa.int32(), mask=np.append(~has, False))
    return pa.ListArray.from_arrays(begin, pa.array(common.signed(words)))


def _survey(text: str, doc_id: str) -> Callable:
    """First pass: (doc_id, n, key, signature) of every row, and the task's counters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        seen: set[int] = set()  # classes of this task
        any_row = False
        for batch in batches:
            for part in common.chunks(batch, text):
                any_row = True
                owner, value, sizes = shingle_sets(part, text)
                keys = set_keys(owner, value, sizes)
                fresh = np.array([k not in seen and not seen.add(k) for k in keys.tolist()], dtype=bool)
                place = (value[fresh[owner]] & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)
                counts += np.bincount(place, minlength=len(counts)).astype(np.uint32)
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        part[doc_id].cast(pa.int64()),
                        pa.array(sizes, pa.int64()),
                        pa.array(common.signed(keys)),
                        signatures(owner, value, sizes),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.binary()),
                    ],
                    names=["doc_id", "n", "key", "signature", "part", "task", "counts"],
                )
        if any_row:
            task = TaskContext.get().partitionId()
            size = 1 << SKETCH_PART
            blocks = [np.minimum(counts[i : i + size], 65535).astype("<u2") for i in range(0, len(counts), size)]
            n = len(blocks)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.int64()),
                    pa.nulls(n, pa.list_(pa.int64())),
                    pa.array(range(n), pa.int32()),
                    pa.array([task] * n, pa.int32()),
                    pa.array([b.tobytes() for b in blocks], pa.binary()),
                ],
                names=["doc_id", "n", "key", "signature", "part", "task", "counts"],
            )

    return run


def _add_counters(table: pa.Table) -> pa.Table:
    total = None
    for row in table["counts"]:
        raw = row.as_buffer()
        width = raw.size >> SKETCH_PART
        counts = np.frombuffer(raw, dtype=f"<u{width}").astype(np.uint64)
        total = counts if total is None else total + counts
    return pa.table(
        {
            "part": table["part"][:1],
            "task": pa.array([table["task"][0].as_py() // 32], pa.int32()),
            "counts": pa.array([total.astype("<u8").tobytes()], pa.binary()),
        }
    )


def _sketch(survey: DataFrame, tasks: int) -> np.ndarray:
    """Counters of all tasks, added up 32 tasks at a time: no task ever holds
    more than 32 blocks, and the driver gets one table of fixed size."""
    blocks = survey.filter("part IS NOT NULL").select("part", "task", "counts")
    with common.dropping_shuffles(survey.sparkSession):
        while True:
            grouped = blocks.groupBy("part", F.floor(F.col("task") / 32))
            blocks = grouped.applyInArrow(_add_counters, "part int, task int, counts binary")
            tasks = (tasks + 31) // 32
            if tasks <= 1:
                break
        added = blocks.collect()
    out = np.zeros(1 << SKETCH_BITS, dtype=np.uint64)
    for row in added:
        at = row["part"] << SKETCH_PART
        out[at : at + (1 << SKETCH_PART)] = np.frombuffer(row["counts"], dtype="<u8")
    return out


def prefix_lengths(
    sizes: np.ndarray, excess: np.ndarray, begin: np.ndarray, most: int = MOST_MATCHES
) -> tuple[np.ndarray, np.ndarray]:
    """Matches asked for (l) and prefix length of each set.

    ``excess`` are estimated list lengths above the usual one, in prefix order.
    A prefix costs its list entries; the candidates with l shared tokens are at
    most a l-th of the entries, each with a share of the verification."""
    need = -(-sizes * NUMERATOR // DENOMINATOR)  # least overlap with any partner
    sums = np.concatenate([[0.0], np.cumsum(excess)])
    best_cost = np.full(len(sizes), np.inf)
    best = np.ones(len(sizes), dtype=np.int64)
    for matches in range(1, most + 1):
        length = np.minimum(sizes - need + matches, sizes)
        scan = sums[begin + length] - sums[begin]
        cost = np.where(matches <= np.maximum(need, 1), scan + VERIFY_COST * scan / matches, np.inf)
        better = cost < best_cost
        best_cost, best = np.where(better, cost, best_cost), np.where(better, matches, best)
    return best, np.minimum(sizes - need + best, sizes)


def _postings(text: str, levels, usual: float) -> Callable:
    """Second pass: one row per prefix token and class (once in a task)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level_of = np.frombuffer(levels.value, dtype=np.uint8)
        seen: set[int] = set()
        for batch in batches:
            for part in common.chunks(batch, text):
                owner, value, sizes = shingle_sets(part, text)
                keys = set_keys(owner, value, sizes)
                fresh = np.array(
                    [n > 0 and k not in seen and not seen.add(k) for k, n in zip(keys.tolist(), sizes.tolist())],
                    dtype=bool,
                )
                if not fresh.any():
                    continue
                mine = fresh[owner]
                owner, value = owner[mine], value[mine]
                level = level_of[(value & np.uint64((1 << SKETCH_BITS) - 1)).astype(np.int64)]
                rank = (level.astype(np.uint64) << np.uint64(56)) | (value >> np.uint64(8))
                order = np.argsort(rank, kind="stable")
                order = order[np.argsort(owner[order], kind="stable")]
                owner, value, level = owner[order], value[order], level[order]
                kept = np.flatnonzero(fresh)
                n = sizes[kept]
                begin = np.concatenate([[0], np.cumsum(n)[:-1]])
                excess = np.maximum(np.exp2(level / 4.0) - usual, 0.0)
                matches, length = prefix_lengths(n, excess, begin)
                at = np.arange(len(value)) - np.repeat(begin, n)
                inside = at < np.repeat(length, n)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(common.signed(value[inside])),
                        pa.array(common.signed(np.repeat(keys[kept], n)[inside])),
                        pa.array(np.repeat(n, n)[inside].astype(np.int32)),
                        pa.array(at[inside].astype(np.int32)),
                        pa.array(np.repeat(matches, n)[inside].astype(np.int32)),
                    ],
                    names=["token", "key", "n", "at", "matches"],
                )

    return run


def _bloom_places(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << BLOOM_BITS) - 1)
    mixed = common.mix(keys)
    return (mixed & mask).astype(np.int64), ((mixed >> np.uint64(32)) & mask).astype(np.int64)


def _bloom_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    bits = np.zeros(1 << BLOOM_BITS, dtype=bool)
    for batch in batches:
        for places in _bloom_places(np.asarray(batch["key"]).view(np.uint64)):
            bits[places] = True
    yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["bits"])


def _whole_sets(text: str, bloom) -> Callable:
    """Third pass: whole sets of the classes that share a prefix token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.unpackbits(np.frombuffer(bloom.value, dtype=np.uint8)).astype(bool)
        seen: set[int] = set()
        for batch in batches:
            for part in common.chunks(batch, text):
                owner, value, sizes = shingle_sets(part, text)
                keys = set_keys(owner, value, sizes)
                a, b = _bloom_places(keys)
                may = bits[a] & bits[b] & (sizes > 0)
                fresh = np.array(
                    [m and k not in seen and not seen.add(k) for k, m in zip(keys.tolist(), may.tolist())], dtype=bool
                )
                if not fresh.any():
                    continue
                value, n = value[fresh[owner]], sizes[fresh]
                offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(common.signed(keys[fresh])),
                        pa.array(n.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(common.signed(value))),
                    ],
                    names=["key", "n", "items"],
                )

    return run


def _can_reach(n_a, n_b, shared):
    """Whether an overlap of ``shared`` is enough: 4 (shared) >= 3 (union)."""
    return DENOMINATOR * shared >= NUMERATOR * (n_a + n_b - shared)


def _in_reach():
    """A pair that reaches the similarity has ``least`` tokens in common, and its first l common
    tokens stand before the last ``least - l`` of either set: later places need not be paired."""
    least = F.ceil((F.col("n_a") + F.col("n_b")) * NUMERATOR / (NUMERATOR + DENOMINATOR))
    beyond = least - F.least("matches_a", "matches_b")
    return (F.col("at_a") < F.col("n_a") - beyond) & (F.col("at_b") < F.col("n_b") - beyond)


def _sizes_fit():
    return _in_reach() & (DENOMINATOR * F.least("n_a", "n_b") >= NUMERATOR * F.greatest("n_a", "n_b")) & _can_reach(
        F.col("n_a"),
        F.col("n_b"),
        F.least("at_a", "at_b") + F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")),
    )


def _may_be_near():
    """False where the signatures alone show that too many shingles differ."""
    differ = sum(
        F.bit_count(F.col("signature_a")[i].bitwiseXOR(F.col("signature_b")[i])) for i in range(SIGNATURE_WORDS)
    )
    size = F.col("n_a") + F.col("n_b")
    return F.coalesce(DENOMINATOR * (size - differ) >= NUMERATOR * (size + differ), F.lit(True))


def _folded(signature, width):
    """The signature over half as many buckets, where that is ``width``; NULL where even that is not."""
    half = F.zip_with(F.slice(signature, 1, width), F.slice(signature, width + 1, width), lambda x, y: x.bitwiseXOR(y))
    return F.when(F.size(signature) == width, signature).when(F.size(signature) == 2 * width, half)


def _plausible(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """The pairs that the signatures leave."""
    joined = pairs
    for side in ("a", "b"):
        own = signed.select(F.col("key").alias(side), F.col("n").alias(f"n_{side}"), F.col("signature").alias(f"_{side}"))
        joined = joined.join(own, [side, f"n_{side}"], "left")
    width = F.least(F.size("_a"), F.size("_b"))
    bits = F.zip_with(_folded(F.col("_a"), width), _folded(F.col("_b"), width), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differ = F.aggregate(bits, F.lit(0), lambda total, x: total + x)
    size = F.col("n_a") + F.col("n_b")
    near = F.coalesce(DENOMINATOR * (size - differ) >= NUMERATOR * (size + differ), F.lit(True))
    return joined.filter(near).select("a", "b", "n_a", "n_b")


def _candidates(pairs: DataFrame, counted: bool) -> DataFrame:
    """Distinct pairs; if counted, those that share as many prefix tokens as the smaller l asks for."""
    if not counted:
        return pairs.select("a", "b", "n_a", "n_b").distinct()
    shared = pairs.groupBy("a", "b", "n_a", "n_b").agg(
        F.count("*").alias("_shared"), F.min(F.least("matches_a", "matches_b")).alias("_need")
    )
    return shared.filter("_shared >= _need").select("a", "b", "n_a", "n_b")


def _side(name: str, extra: list[str]) -> list:
    own = [F.col("key").alias(name)]
    return own + [F.col(c).alias(f"{c}_{name}") for c in ("n", "at", "matches", *extra)]


def _ascending(pairs: DataFrame) -> DataFrame:
    """Pairs with the lesser class first."""
    swap = F.col("a") > F.col("b")
    sides = [
        F.when(swap, F.col(f"{c}{y}")).otherwise(F.col(f"{c}{x}")).alias(f"{c}{x}")
        for c in ("", "n_", "at_", "matches_")
        for x, y in (("a", "b"), ("b", "a"))
    ]
    return pairs.select(*sides)


def _verified(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The pairs whose whole sets reach the similarity. A fixed-size Bloom
    filter of their classes keeps other texts' sets out of the shuffle."""
    spark = rows.sparkSession
    pairs = store(pairs, "candidates")
    keys = pairs.select(F.explode(F.array("a", "b")).alias("key")).coalesce(4)
    bits = np.zeros((1 << BLOOM_BITS) // 8, dtype=np.uint8)
    for row in keys.mapInArrow(_bloom_of, "bits binary").collect():  # four rows of fixed size
        bits |= np.frombuffer(row["bits"], dtype=np.uint8)
    bloom = spark.sparkContext.broadcast(bits.tobytes())
    # a class of copies comes from many tasks and is to be joined once
    whole = rows.mapInArrow(_whole_sets("text", bloom), "key bigint, n int, items array<bigint>")
    sets = store(whole.dropDuplicates(["key", "n"]), "shingle-sets")
    left = sets.select(F.col("key").alias("a"), F.col("n").alias("n_a"), F.col("items").alias("_x"))
    right = sets.select(F.col("key").alias("b"), F.col("n").alias("n_b"), F.col("items").alias("_y"))
    joined = pairs.join(left, ["a", "n_a"]).join(right, ["b", "n_b"])
    shared = F.size(F.array_intersect("_x", "_y"))
    found = joined.filter(_can_reach(F.col("n_a"), F.col("n_b"), shared)).select("a", "b")
    links = store(found.distinct(), "links")
    forget(pairs, sets)
    return links


def _joined_parts(parts: DataFrame, links: DataFrame) -> DataFrame:
    """(node, root) after new links: these are brought to the roots first, so the many links
    between two components count once. Every root is a node of its own."""
    edges = links
    for side in ("a", "b"):
        root = parts.select(F.col("node").alias(side), F.col("root").alias(f"_{side}"))
        edges = edges.join(root, side, "left").withColumn(side, F.coalesce(f"_{side}", side)).drop(f"_{side}")
    moved = connected_components(edges.select("a", "b").distinct())
    new = moved.select(F.col("node").alias("root"), F.col("root").alias("_new"))
    older = parts.join(new, "root", "left").select("node", F.coalesce("_new", "root").alias("root"))
    return store(older.unionByName(moved.join(parts.select("node"), "node", "left_anti")), "parts")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs``."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    survey = store(
        rows.mapInArrow(
            _survey("text", "doc_id"),
            "doc_id bigint, n bigint, key bigint, signature array<bigint>, part int, task int, counts binary",
        ),
        "shingle-survey",
    )
    members = survey.filter("part IS NULL").select("doc_id", "n", "key")
    tasks = survey.agg(F.max("task")).first()[0]
    counts = _sketch(survey, (tasks or 0) + 1)
    usual = 4.0 * max(float(counts.mean()), 1.0)
    levels = np.minimum(np.floor(4 * np.log2(1.0 + counts)), 255).astype(np.uint8)
    shared_levels = spark.sparkContext.broadcast(levels.tobytes())  # fixed size

    postings = rows.mapInArrow(
        _postings("text", shared_levels, usual), "token bigint, key bigint, n int, at int, matches int"
    )
    own = Window.partitionBy("token")

    def spanning(rows_: DataFrame, part: str) -> DataFrame:
        """Lists whose members are in different components."""
        marked = rows_.withColumn("_low", F.min(part).over(own)).withColumn("_high", F.max(part).over(own))
        return marked.filter("_low != _high").drop("_low", "_high")

    # Edits make rare shingles, which come first: where the first shared token of a text stands early,
    # the text has few of them and is a centre of its group.
    found = spanning(postings, "key").dropDuplicates(["token", "key"])
    shared = store(found.withColumn("early", F.min("at").over(Window.partitionBy("key"))), "shared-postings")
    # sizes as in the postings
    classes = survey.filter("signature IS NOT NULL").select("key", F.col("n").cast("int").alias("n"), "signature")
    signed = store(classes.dropDuplicates(["key", "n"]), "signatures")
    parts = spark.createDataFrame([], "node bigint, root bigint")
    for step in STEPS:
        placed = shared.join(parts.withColumnRenamed("node", "key"), "key", "left")
        placed = placed.withColumn("part", F.coalesce("root", "key")).drop("root")
        listed = mixed = store(spanning(placed, "part"), "mixed-postings")
        fits, extra = _sizes_fit(), []
        if step == LAST:
            short = signed.filter(F.col("n") <= SIGNED).withColumn("signature", _folded(F.col("signature"), F.lit(SIGNATURE_WORDS)))
            mixed = mixed.join(short, ["key", "n"], "left")
            fits, extra = fits & _may_be_near(), ["signature"]
        order = {"hubs": ("early", "key"), "neighbours": ("n", "key")}.get(step)
        if order:
            mixed = mixed.withColumn("_rank", F.row_number().over(Window.partitionBy("token").orderBy(*order)))
        left, right, on, apart = mixed, mixed, ["token"], F.col("part_a") != F.col("part_b")
        if step == "hubs":
            left = mixed.filter(F.col("_rank") <= HUBS)
            apart &= (F.col("a") < F.col("b")) | (F.col("_rank") > HUBS)
        elif step == "neighbours":
            right, on = mixed.withColumn("_rank", F.col("_rank") - 1), ["token", "_rank"]
        else:
            apart &= F.col("a") < F.col("b")
        left = left.select(*on, F.col("part").alias("part_a"), *_side("a", extra))
        rank = [] if step == LAST else ["_rank"]
        right = right.select("token", *rank, F.col("part").alias("part_b"), *_side("b", extra))
        pairs = left.join(right, on).filter(apart & fits)
        # the linking steps meet a pair at some of its tokens only, so there one is enough
        met = _candidates(_ascending(pairs), counted=step == LAST)
        links = _verified(_plausible(met, signed), rows)
        parts = _joined_parts(parts, links)
        forget(listed, links)
    forget(signed, shared)
    roots = parts

    classes = members.filter("n > 0").groupBy("key", "n").agg(F.min("doc_id").alias("_least"))
    named = classes.join(roots, classes["key"] == roots["node"], "left").select(
        "key", "n", "_least", F.coalesce("root", "key").alias("root")
    )
    named = store(named, "classes")
    least = named.groupBy("root").agg(F.min("_least").alias("component_id"))
    labelled = store(named.join(least, "root").select("key", "n", "component_id"), "class-components")
    return members.join(labelled, ["key", "n"], "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )
