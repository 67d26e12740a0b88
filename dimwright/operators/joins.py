"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key above this share of the rows is hot; at most 1 / share keys can be.
HOT_SHARE_CONF = "spark.dimwright.hotShare"
HOT_SHARE = 0.02


def hot_keys(df: DataFrame, keys: Sequence[str]) -> list[tuple]:
    """Keys whose row count reaches the hot share, with their counts.

    The counts combine on the map side, and no more than 1 / share keys can
    pass the filter, so the driver holds a bounded list.
    """
    share = float(df.sparkSession.conf.get(HOT_SHARE_CONF, str(HOT_SHARE)))
    total = df.count()
    rows = (
        df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") >= max(2, share * total))
    ).collect()
    return [(tuple(r[k] for k in keys), r["_n"], total) for r in rows]


def _matches(keys: Sequence[str], values: list[tuple]) -> Column:
    if len(keys) == 1:
        return F.col(keys[0]).isin([v[0] for v in values])
    return reduce(
        lambda a, b: a | b,
        [reduce(lambda a, b: a & b, [F.col(k) == F.lit(x) for k, x in zip(keys, v)]) for v in values],
    )


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str, hot: list[tuple]
) -> DataFrame:
    """Shuffled join in which each hot key of ``left`` is spread over many
    tasks and the matching rows of ``right`` are repeated for each of them."""
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = max(2, min(parts, math.ceil(parts * max(n / total for _, n, total in hot))))
    named = [k for k, _, _ in hot if None not in k]
    is_hot = F.coalesce(_matches(on, named), F.lit(False)) if named else F.lit(False)
    # rows without a key match nothing, so they may go anywhere
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on])
    spread = F.pmod(F.xxhash64(*left.columns), F.lit(salts)).cast("int")
    salted_left = left.withColumn("_salt", F.when(is_hot | no_key, spread).otherwise(0))
    every_salt = F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(
        F.array(F.lit(0))
    )
    salted_right = right.withColumn("_salt", F.explode(every_salt))
    return salted_left.join(salted_right, [*on, "_salt"], how).drop("_salt")


def balanced_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    hot: list[tuple] | None = None,
) -> DataFrame:
    """Join ``left`` to ``right`` on equal columns; no job runs to plan it.

    Adaptive execution picks the join by the sizes it meets and splits skewed
    partitions. A caller that knows hot keys of ``left`` (``hot_keys`` of a
    stored table, found once) declares them, and these are salted.
    ``how`` is inner, left, left_semi or left_anti; the columns of ``left``
    keep their order, those ``right`` adds follow.
    """
    keys = [on] if isinstance(on, str) else list(on)
    joined = salted_join(left, right, keys, how, hot) if hot else left.join(right, keys, how)
    added = [] if how in ("left_semi", "left_anti") else [c for c in right.columns if c not in keys]
    return joined.select(*left.columns, *added)


def collated_join(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, how: str = "inner", collation: str = "UNICODE_CI_AI"
) -> DataFrame:
    """Join of text columns that are equal under a collation; the default
    passes over case and accents. It is the option beside ``fold_key``, which
    folds a fixed list of letters: a collation folds any letter the way its
    script does (é and E, but also Greek and Cyrillic). Both sides shuffle by
    the collation's sort key; columns come out with their own collation.
    """
    a = left.withColumn("_left_key", F.collate(F.col(left_on), collation))
    b = right.withColumn("_right_key", F.collate(F.col(right_on), collation))
    return a.join(b, F.col("_left_key") == F.col("_right_key"), how).drop("_left_key", "_right_key")
