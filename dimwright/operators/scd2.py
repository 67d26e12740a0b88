"""Dimensions that keep every version of a row (type 2)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.functions import changed
from dimwright.operators.joins import balanced_join
from dimwright.operators.scd1 import require_unique
from dimwright.operators.surrogate import assign_surrogate_keys, next_start
from dimwright.session import materialise


@dataclass(frozen=True)
class Versioned:
    """Column names of a versioned dimension."""

    sk: str
    nk: str
    valid_from: str
    valid_to: str
    is_current: str

    @classmethod
    def prefixed(cls, prefix: str, nk: str) -> Versioned:
        return cls(
            f"{prefix}_sk",
            f"{prefix}_{nk}",
            f"{prefix}_dt_inicio",
            f"{prefix}_dt_fim",
            f"{prefix}_is_atual",
        )


def _moment(ts: datetime | None) -> Column:
    return F.lit(ts).cast("timestamp_ntz")


def _open_version(rows: DataFrame, names: Versioned, ts: datetime) -> DataFrame:
    return (
        rows.withColumn(names.valid_from, _moment(ts))
        .withColumn(names.valid_to, _moment(None))
        .withColumn(names.is_current, F.lit(True))
    )


def current(dim: DataFrame, names: Versioned) -> DataFrame:
    return dim.filter(F.col(names.is_current))


def scd2_initial(
    src: DataFrame, names: Versioned, attrs: Sequence[str], ts: datetime
) -> DataFrame:
    """First load: every source row becomes the current version."""
    rows = src.select(names.nk, *attrs)
    return _open_version(assign_surrogate_keys(rows, names.sk, [names.nk]), names, ts).select(
        names.sk, names.nk, *attrs, names.valid_from, names.valid_to, names.is_current
    )


@dataclass(frozen=True)
class Merge:
    """Outcome of a merge, as a whole and in the pieces a store writes.

    ``changes`` is stored and holds one row per version to open, with the key
    of the version it replaces in ``_closes``. The dimension itself is only
    read past a look-up of those few keys; while they fit a broadcast it is
    not shuffled.
    """

    dim: DataFrame
    changes: DataFrame
    names: Versioned
    ts: datetime

    @property
    def _closing(self) -> DataFrame:
        return self.changes.filter(F.col("_closes").isNotNull()).select(
            F.col("_closes").alias(self.names.sk)
        )

    @property
    def opened(self) -> DataFrame:
        """Versions this load adds."""
        return _open_version(self.changes, self.names, self.ts).select(*self.dim.columns)

    @property
    def closed(self) -> DataFrame:
        """Versions this load closes."""
        rows = balanced_join(
            current(self.dim, self.names), self._closing, self.names.sk, "left_semi"
        )
        return rows.withColumn(self.names.valid_to, _moment(self.ts)).withColumn(
            self.names.is_current, F.lit(False)
        )

    @property
    def kept(self) -> DataFrame:
        """Current versions left as they were."""
        return balanced_join(
            current(self.dim, self.names), self._closing, self.names.sk, "left_anti"
        )

    def whole(self) -> DataFrame:
        """Every version, in one pass over the dimension."""
        names = self.names
        marked = balanced_join(
            self.dim, self._closing.withColumn("_closing", F.lit(True)), names.sk, "left"
        )
        is_closing = F.col("_closing").isNotNull()
        rows = marked.withColumn(
            names.valid_to, F.when(is_closing, _moment(self.ts)).otherwise(F.col(names.valid_to))
        ).withColumn(names.is_current, F.col(names.is_current) & ~is_closing)
        return rows.select(*self.dim.columns).unionByName(self.opened)


def scd2_merge_parts(
    dim: DataFrame,
    src: DataFrame,
    names: Versioned,
    tracked: Sequence[str],
    ts: datetime,
    changed_keys: DataFrame | None = None,
    null_safe: bool = False,
) -> Merge:
    """Close current versions whose tracked attributes differ from the source
    and open a version for every source key left without a current one.

    ``changed_keys`` (one column named like the natural key) limits the load
    to those keys; repeated keys count once. The changes are found in one join
    of source and current slice, stored once together with their new
    surrogate keys, and everything else is derived from that small table.
    A source that repeats a key is refused, as it would open two current
    versions: the changes are checked, and so is a held key that would meet
    one changed and one unchanged row.
    """
    incoming, known = src.select(names.nk, *tracked), current(dim, names)
    if changed_keys is not None:
        # both sides shrink to the named keys before they meet
        keys = changed_keys.select(names.nk).distinct()
        incoming = balanced_join(incoming, keys, names.nk, "left_semi")
        known = balanced_join(known, keys, names.nk, "left_semi")
    held = known.select(
        F.col(names.nk),
        F.col(names.sk).alias("_closes"),
        *[F.col(a).alias(f"_old_{a}") for a in tracked],
    )
    pairs = [(F.col(f"_old_{a}"), F.col(a)) for a in tracked]
    differs = F.col("_closes").isNull() | changed(pairs, null_safe)
    # each side holds a key once, so neither can be hot
    changes = (
        incoming.join(held, names.nk, "left")
        .filter(differs)
        .select(names.nk, *tracked, "_closes")
    )
    # the order by key reads its rows twice: once stored, the join runs once
    keyed = assign_surrogate_keys(materialise(changes, "changes"), names.sk, [names.nk], next_start(dim, names.sk))
    # all rows of a key that changed are in the source, so few are looked at
    require_unique(balanced_join(incoming.select(names.nk), keyed.select(names.nk).distinct(), names.nk, "left_semi"), [names.nk])
    others = [c for c in dim.columns if c not in keyed.columns]
    for c in others:  # columns this load does not know start empty
        if c not in (names.valid_from, names.valid_to, names.is_current):
            keyed = keyed.withColumn(c, F.lit(None).cast(dim.schema[c].dataType))
    return Merge(dim, keyed, names, ts)


def scd2_merge(
    dim: DataFrame,
    src: DataFrame,
    names: Versioned,
    tracked: Sequence[str],
    ts: datetime,
    changed_keys: DataFrame | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """The whole dimension after :func:`scd2_merge_parts`."""
    return scd2_merge_parts(dim, src, names, tracked, ts, changed_keys, null_safe).whole()


def scd2_fill(
    dim: DataFrame, src: DataFrame, names: Versioned, new_attrs: Sequence[str]
) -> DataFrame:
    """Give current versions their added attributes where the first of them is
    still NULL; that opens no version, since nothing changed."""
    for a in new_attrs:
        if a not in dim.columns:
            dim = dim.withColumn(a, F.lit(None).cast(src.schema[a].dataType))
    values = src.select(
        names.nk, F.lit(True).alias("_found"), *[F.col(a).alias(f"_src_{a}") for a in new_attrs]
    )
    blank = F.col("_found") & F.col(new_attrs[0]).isNull()
    joined = balanced_join(current(dim, names), values, names.nk, "left").withColumn(
        "_blank", F.coalesce(blank, F.lit(False))
    )
    filled = joined.select(
        *[
            F.when(F.col("_blank"), F.col(f"_src_{c}")).otherwise(F.col(c)).alias(c)
            if c in new_attrs
            else F.col(c)
            for c in dim.columns
        ]
    )
    return filled.unionByName(dim.filter(~F.col(names.is_current)))


def scd2_unfilled(
    dim: DataFrame,
    src: DataFrame,
    names: Versioned,
    new_attrs: Sequence[str],
    changed_keys: DataFrame | None = None,
) -> DataFrame:
    """Keys whose current version a fill would give a value."""
    known = reduce(lambda a, b: a | b, [F.col(a).isNotNull() for a in new_attrs])
    blank = current(dim, names).filter(F.col(new_attrs[0]).isNull()).select(names.nk)
    if changed_keys is not None:
        blank = balanced_join(blank, changed_keys.select(names.nk), names.nk, "left_semi")
    return balanced_join(blank, src.filter(known).select(names.nk), names.nk, "left_semi")


def scd2_extend_parts(
    dim: DataFrame,
    src: DataFrame,
    names: Versioned,
    new_attrs: Sequence[str],
    ts: datetime,
    changed_keys: DataFrame | None = None,
) -> Merge:
    """Fill added attributes, then close current versions whose added
    attributes differ (NULL counts as a value) and open a copy with the new
    ones; a key whose versions are all closed reopens from the latest closed.
    ``changed_keys`` limits all of it to those keys.
    """
    if changed_keys is not None:
        keys = changed_keys.select(names.nk).distinct()
        src = balanced_join(src, keys, names.nk, "left_semi")
    filled = scd2_fill(dim, src, names, new_attrs)
    columns = filled.columns
    open_rows = current(filled, names)
    # normally none: a load closes and opens together
    past = filled.filter(~F.col(names.is_current))
    if changed_keys is not None:
        past = balanced_join(past, keys, names.nk, "left_semi")
        open_rows = balanced_join(open_rows, keys, names.nk, "left_semi")
    orphans = balanced_join(past, open_rows.select(names.nk), names.nk, "left_anti")
    rest = [c for c in columns if c != names.nk]
    newest = orphans.groupBy(names.nk).agg(
        F.max_by(F.struct(*rest), F.struct(names.valid_to, names.sk)).alias("v")
    )
    latest = open_rows.unionByName(newest.select(names.nk, "v.*"))
    carried = [c for c in columns if c not in new_attrs and c != names.sk]
    held = latest.select(
        *carried,
        F.col(names.sk).alias("_newest"),
        *[F.col(a).alias(f"_old_{a}") for a in new_attrs],
    )
    pairs = [(F.col(f"_old_{a}"), F.col(a)) for a in new_attrs]
    changes = (
        held.join(src.select(names.nk, *new_attrs), names.nk)
        .filter(~F.col(names.is_current) | changed(pairs, null_safe=True))
        .withColumn("_closes", F.when(F.col(names.is_current), F.col("_newest")))
        .select(*carried, *new_attrs, "_closes")
    )
    keyed = assign_surrogate_keys(materialise(changes, "changes"), names.sk, [names.nk], next_start(dim, names.sk))
    return Merge(filled, keyed, names, ts)


def scd2_extend(
    dim: DataFrame,
    src: DataFrame,
    names: Versioned,
    new_attrs: Sequence[str],
    ts: datetime,
    changed_keys: DataFrame | None = None,
) -> DataFrame:
    """The whole dimension after :func:`scd2_extend_parts`."""
    return scd2_extend_parts(dim, src, names, new_attrs, ts, changed_keys).whole()
