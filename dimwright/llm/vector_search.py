"""Exact top-k search by inner product: columnar branch and bound.

Vectors are integers, ``floor(scale * x)`` of every component. A stated set of
queries meets all rows in blocks: candidates and queries are dealt into groups
of bounded size by a hash of their row, each pair of groups meets in one task,
and the best ``k`` of every task are merged per query.

Inside a task the candidates lie in vertical layout, one array per dimension.
A query visits the blocks of dimensions by its own mass in them, largest
first, and adds each block's products to the candidates' running sums. What
the unseen blocks can still add is bounded by Cauchy and Schwarz from the
remaining mass of query and candidate; a candidate whose sum and bound stay
under the query's k-th best score so far is dropped, and the survivors'
arrays are compacted. The first k-th best comes from candidates with the best
partial sums, scored in full. Nothing is approximate: sums are whole numbers below 2**53,
bounds are widened by more than their rounding error, and larger vectors are
multiplied as Python integers.

Defined results: rows whose vector is NULL or holds a NULL or a component that
is not finite take no part. Vectors of unlike length are compared as if the
shorter ended in zeros; an empty vector scores 0. A row is never its own
candidate, though rows that repeat its id are. Ties go to the smaller id (NULL
last), then to the row stored first. Components beyond the range of a long
saturate, and so do scores. No rows give no rows; columns beside id and vector
do not take part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimwright.llm.common import forget, store

BLOCK = 8  # dimensions added between two looks at the bounds
SEEDS = 4  # candidates scored in full at once, in multiples of k
GROUP_BYTES = 32 << 20  # of vectors on either side of a task
GROUP_ROWS = 2048  # groups are not cut smaller for more tasks
COPIES = 2  # how often a wave of query groups sends the candidates

_SLACK = 1 + 1e-9
_EXACT = 2.0**53
_LONG = 2**63


@dataclass
class Vertical:
    """Candidates of a task, a row per dimension, with their mass per block."""

    columns: np.ndarray
    blocks: list[slice]
    mass: np.ndarray
    ids: np.ndarray
    rows: np.ndarray
    work: int = 0  # products of components, for tests

    @classmethod
    def of(cls, vectors: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> Vertical:
        blocks = [slice(a, a + BLOCK) for a in range(0, vectors.shape[1], BLOCK)]
        columns = np.ascontiguousarray(vectors.T)
        mass = np.array([(columns[b] ** 2).sum(axis=0) for b in blocks]).reshape(len(blocks), len(ids))
        return cls(columns, blocks, mass, ids, rows)

    def best(self, query: np.ndarray, own_row: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the query's ``k`` best candidates."""
        at = np.flatnonzero(self.rows != own_row)
        columns, mass = self.columns, self.mass
        if len(at) < len(self.rows):
            columns, mass = columns[:, at], mass[:, at]
        query_mass = np.array([(query[b] ** 2).sum() for b in self.blocks])
        order = np.argsort(-query_mass, kind="stable")
        sums = np.zeros(len(at))
        left, query_left = mass.sum(axis=0), query_mass.sum()
        bar = -np.inf
        for step, b in enumerate(order):
            part = self.blocks[b]
            sums += query[part] @ columns[part]
            self.work += columns[part].size
            left -= mass[b]
            query_left -= query_mass[b]
            if step + 1 == len(order) or len(at) <= k:
                continue
            if bar == -np.inf and len(at) > SEEDS * k:
                first = np.argpartition(-sums, SEEDS * k - 1)[: SEEDS * k]
                bar = np.partition(query @ columns[:, first], -k)[-k]
                self.work += SEEDS * k * len(query)
            reach = np.sqrt(np.maximum(left, 0.0) * max(query_left, 0.0)) * _SLACK + 1
            alive = np.flatnonzero(sums + reach >= bar)
            if 2 * len(alive) < len(at):
                at, sums, left = at[alive], sums[alive], left[alive]
                columns, mass = columns[:, alive], mass[:, alive]
                floors = sums - reach[alive]
                if len(floors) > k:
                    bar = max(bar, np.partition(floors, -k)[-k])
        return _top(at, sums, self.ids, self.rows, k)


def _top(at: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int):
    if len(at) > k:
        # ties with the k-th score stay until the ids decide
        near = np.flatnonzero(scores >= np.partition(scores, -k)[-k])
        at, scores = at[near], scores[near]
    order = np.lexsort((rows[at], ids[at], -scores))[:k]
    return at[order], scores[order]


def _matrix(table: pa.Table, width: int) -> np.ndarray:
    vectors = table["vector"].combine_chunks()
    sizes = np.asarray(vectors.value_lengths(), dtype=np.int64)
    out = np.zeros((len(sizes), width), dtype=np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    column = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[row, column] = np.asarray(vectors.flatten())
    return out


def _peak(m: np.ndarray) -> int:
    """Largest magnitude, as an unbounded integer."""
    return max(abs(int(m.max(initial=0))), abs(int(m.min(initial=0))))


_FOUND = "q_row long, query_id {kind}, vec_id {kind}, c_row long, score long"


def _meet(kind: str, k: int):
    """Best candidates of one group for the queries of another."""

    def meet(queries: pa.Table, found: pa.Table) -> pa.Table:
        out: dict[str, list] = {name: [] for name in ("q_row", "query_id", "vec_id", "c_row", "score")}
        if queries.num_rows and found.num_rows:
            width = max(
                int(np.asarray(t["vector"].combine_chunks().value_lengths()).max()) for t in (queries, found)
            )
            q, c = _matrix(queries, width), _matrix(found, width)
            ids = np.asarray(found["id"].combine_chunks().fill_null(np.iinfo(np.int64).max), dtype=np.int64)
            rows = np.asarray(found["row"], dtype=np.int64)
            shown, q_ids = found["id"].to_pylist(), queries["id"].to_pylist()
            exact = width * max(_peak(q), _peak(c)) ** 2 < _EXACT
            if exact:
                table = Vertical.of(c.astype(float), ids, rows)
                q = q.astype(float)
            for i, own in enumerate(queries["row"].to_pylist()):
                if exact:
                    at, scores = table.best(q[i], own, k)
                else:
                    at = np.flatnonzero(rows != own)
                    whole = c[at].astype(object) @ q[i].astype(object)
                    whole = [min(max(int(s), -_LONG), _LONG - 1) for s in whole]
                    order = sorted(range(len(at)), key=lambda j: (-whole[j], ids[at[j]], rows[at[j]]))[:k]
                    at, scores = at[order], [whole[j] for j in order]
                out["q_row"] += [own] * len(at)
                out["query_id"] += [q_ids[i]] * len(at)
                out["vec_id"] += [shown[j] for j in at]
                out["c_row"] += rows[at].tolist()
                out["score"] += [int(s) for s in scores]
        return pa.table(
            {
                name: pa.array(values, pa.int64() if name in ("q_row", "c_row", "score") else kind)
                for name, values in out.items()
            }
        )

    return meet


def whole_vectors(df: DataFrame, vector: str, key: str, scale: int) -> DataFrame:
    """(id, vector of whole numbers) of the rows that take part."""
    value = F.transform(F.col(vector), lambda x: x.cast("double"))
    usable = ~F.exists(value, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(value, lambda x: F.floor(x * F.lit(float(scale))).cast("long"))
    return df.filter(F.col(vector).isNotNull() & usable).select(
        F.col(key).alias("id"), whole.alias("vector")
    )


def top_k(
    df: DataFrame, is_query: Column, vector: str = "embedding", key: str = "vec_id", k: int = 10, scale: int = 1024
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best rows of ``df`` for each
    row of it that ``is_query`` (over the column ``id``) marks."""
    spark = df.sparkSession
    rows = store(
        whole_vectors(df, vector, key, scale).withColumn("row", F.monotonically_increasing_id()), "vectors"
    )
    kind = rows.schema["id"].dataType.simpleString()
    arrow = pa.int64() if kind == "bigint" else pa.int32()
    queries = rows.filter(F.coalesce(is_query, F.lit(False)))
    n, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    asked = queries.count()
    most = max(1, GROUP_BYTES // (8 * max(width, 1)))
    wanted = max(1, min(most, max(GROUP_ROWS, n // (4 * spark.sparkContext.defaultParallelism))))
    c_groups, q_groups = max(1, math.ceil(n / wanted)), max(1, math.ceil(asked / most))

    def dealt(df: DataFrame, name: str, groups: int) -> DataFrame:
        return df.withColumn(name, F.pmod(F.xxhash64("row", F.lit(name)), F.lit(groups)).cast("int"))

    found = []
    for first in range(0, q_groups, COPIES):
        last = min(first + COPIES, q_groups)
        some = dealt(queries, "q", q_groups).filter(F.col("q").between(first, last - 1))
        left = some.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(c_groups - 1))))
        right = dealt(rows, "c", c_groups).withColumn(
            "q", F.explode(F.sequence(F.lit(first), F.lit(last - 1)))
        )
        met = (
            left.groupBy("q", "c")
            .cogroup(right.groupBy("q", "c"))
            .applyInArrow(_meet(arrow, k), _FOUND.format(kind=kind))
        )
        order = Window.partitionBy("q_row").orderBy(
            F.desc("score"), F.asc_nulls_last("vec_id"), F.asc("c_row")
        )
        best = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        found.append(store(best.select("query_id", "rank", "vec_id", "score"), "nearest"))
    forget(rows)
    whole = found[0]
    for more in found[1:]:
        whole = whole.unionByName(more)
    return whole
