"""Dense surrogate keys without a single-task window."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.session import materialise

# monotonically_increasing_id keeps the row's place in the low 33 bits and the
# partition above them.
_PLACE_BITS = 33


def assign_surrogate_keys(
    df: DataFrame, sk: str, order_cols: Sequence[str] | None = None, start: int = 0
) -> DataFrame:
    """Add ``sk`` = start + 1, start + 2, ...

    With ``order_cols`` the keys follow that order, as ``row_number`` over the
    whole table would: rows are range-partitioned, sorted inside each
    partition and written once with their place; the stored row counts per
    partition give each partition its first key. Without ``order_cols`` the
    keys are dense but follow arrival order, and nothing is shuffled.
    The order columns should be unique together, or ties fall either way.
    """
    rows = df
    if order_cols:
        rows = df.repartitionByRange(*order_cols).sortWithinPartitions(*order_cols)
    stored = materialise(rows.withColumn("_slot", F.monotonically_increasing_id()), "keys")
    part = F.shiftright("_slot", _PLACE_BITS)
    place = F.col("_slot").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    counts = {
        r["part"]: r["n"]
        for r in stored.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    }
    if len(counts) <= 1:
        first = F.lit(start)
    else:
        sizes = [counts.get(p, 0) for p in range(max(counts) + 1)]
        before = [start, *(start + x for x in accumulate(sizes))][:-1]
        # one literal array, a number per partition
        first = F.element_at(
            F.expr("array(" + ",".join(f"{x}L" for x in before) + ")"), part.cast("int") + 1
        )
    return stored.withColumn(sk, (first + place + 1).cast("long")).drop("_slot")


def next_start(dim: DataFrame, sk: str) -> int:
    """Largest key in use, 0 for an empty table."""
    return dim.agg(F.coalesce(F.max(sk), F.lit(0))).first()[0]
