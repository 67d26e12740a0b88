"""Dimensions overwritten in place (type 1)."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.functions import changed
from dimwright.operators.surrogate import assign_surrogate_keys, next_start
from dimwright.session import materialise


class DuplicateKeys(ValueError):
    """A batch names the same natural key more than once."""


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    twice = df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    found = twice.limit(5).collect()
    if found:
        raise DuplicateKeys(f"repeated {list(keys)}: {[tuple(r)[:-1] for r in found]}")


def scd1_upsert(
    dim: DataFrame | None,
    stage: DataFrame,
    sk: str,
    nk: Sequence[str],
    cols: Sequence[str],
    compare: Sequence[str],
    ts: datetime,
    loaded_at: str,
    fixed: Sequence[str] = (),
    mode: str = "upsert",
    start: int | None = None,
) -> DataFrame:
    """Snapshot of ``dim`` after loading ``stage``.

    New natural keys are inserted. In ``upsert`` mode a held row takes the
    staged ``cols`` when any of ``compare`` differs (NULL counts as a value);
    ``fixed`` columns are set on insert only. ``insert_only`` leaves held rows
    alone. Inserted and revised rows are stamped with ``ts``.
    A batch that repeats a key is refused. ``dim`` may be the slice of a
    larger dimension the staged keys can lie in; then ``start`` gives the
    largest key in use.
    """
    if mode not in ("upsert", "insert_only"):
        raise ValueError(mode)
    incoming = stage.select(*nk, *fixed, *cols)
    stamp = F.lit(ts).cast("timestamp_ntz")
    order = [sk, *fixed, *nk, *cols, loaded_at]
    if dim is None:
        keyed = assign_surrogate_keys(incoming, sk, list(nk))
        require_unique(keyed, nk)
        return keyed.withColumn(loaded_at, stamp).select(*order)

    require_unique(stage, nk)
    held = dim.select(*order).withColumn("_held", F.lit(True))
    staged = incoming.select(
        *nk, F.lit(True).alias("_staged"), *[F.col(c).alias(f"_new_{c}") for c in [*fixed, *cols]]
    )
    # each side holds a key once, so neither can be hot; stored, as held and
    # new rows both come out of this one join
    both = materialise(held.join(staged, list(nk), "full"), "upsert")
    added = both.filter(F.col("_held").isNull()).select(
        *nk, *[F.col(f"_new_{c}").alias(c) for c in [*fixed, *cols]]
    )
    start = next_start(dim, sk) if start is None else start
    added = assign_surrogate_keys(added, sk, list(nk), start)
    added = added.withColumn(loaded_at, stamp).select(*order)
    both = both.filter("_held")
    if mode == "insert_only":
        return both.select(*order).unionByName(added)

    pairs = [(F.col(c), F.col(f"_new_{c}")) for c in compare]
    both = both.withColumn(
        "_revise", F.coalesce(F.col("_staged"), F.lit(False)) & changed(pairs, null_safe=True)
    )
    revised = both.select(
        sk,
        *fixed,
        *nk,
        *[F.when(F.col("_revise"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in cols],
        F.when(F.col("_revise"), stamp).otherwise(F.col(loaded_at)).alias(loaded_at),
    )
    return revised.unionByName(added)
