"""Flatten a chain of look-up tables onto a base table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.operators.joins import balanced_join


@dataclass(frozen=True)
class Level:
    """A parent table joined on a column both sides share."""

    table: DataFrame
    on: str


@dataclass(frozen=True)
class Metric:
    """Aggregates of a detail table, joined on the base key; absent = ``empty``."""

    detail: DataFrame
    on: str
    aggregates: dict[str, Column]
    empty: int | float = 0


def denormalise_snowflake(
    base: DataFrame, chain: Sequence[Level], metrics: Sequence[Metric] = ()
) -> DataFrame:
    """Inner-join each level of ``chain`` in turn, then left-join detail
    tables already aggregated to the base key, with ``empty`` for keys that
    have no detail rows. Detail rows are combined before they are shuffled,
    so a key with many of them stays cheap."""
    flat = base
    for level in chain:
        flat = balanced_join(flat, level.table, level.on)
    for metric in metrics:
        totals = metric.detail.groupBy(metric.on).agg(
            *[agg.alias(name) for name, agg in metric.aggregates.items()]
        )
        # both sides hold a key once
        flat = flat.join(totals, metric.on, "left")
        flat = flat.select(
            *[
                F.coalesce(F.col(c), F.lit(metric.empty).cast(totals.schema[c].dataType)).alias(c)
                if c in metric.aggregates
                else F.col(c)
                for c in flat.columns
            ]
        )
    return flat
