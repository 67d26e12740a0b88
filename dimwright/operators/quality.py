"""Reconciliation and constraint reports; each is a small DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dimwright.functions import hash_sums
from dimwright.operators.facts import BUYER, COLUMNS, SELLER, SaleColumns
from dimwright.operators.joins import balanced_join


@dataclass(frozen=True)
class ForeignKey:
    columns: Sequence[str]
    parent: DataFrame
    parent_columns: Sequence[str]


@dataclass(frozen=True)
class Rules:
    """Constraints of one table."""

    not_null: Sequence[str] = ()
    unique: Sequence[Sequence[str]] = ()
    foreign_keys: dict[str, ForeignKey] = field(default_factory=dict)
    domains: dict[str, Sequence] = field(default_factory=dict)
    max_lengths: dict[str, int] = field(default_factory=dict)


def _tally(report: DataFrame, kind: str, subject: str) -> DataFrame:
    return report.select(
        F.lit(kind).alias("rule"),
        F.lit(subject).alias("subject"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("violations"),
    )


def check_constraints(df: DataFrame, rules: Rules) -> DataFrame:
    """Violating rows per rule.

    Row rules share one scan. Unique and foreign-key rules count rows per key
    first and work on the counts: a key held by very many rows costs one row,
    and parents are only compared with distinct keys.
    """
    row_rules: list[tuple[str, str, Column]] = [
        ("not_null", c, F.col(c).isNull()) for c in rules.not_null
    ]
    row_rules += [("domain", c, ~F.col(c).isin(*v)) for c, v in rules.domains.items()]
    row_rules += [("length", c, F.length(c) > n) for c, n in rules.max_lengths.items()]
    reports = []
    if row_rules:
        counted = df.agg(
            F.array(
                *[
                    F.struct(
                        F.lit(kind).alias("rule"),
                        F.lit(subject).alias("subject"),
                        F.count(F.when(broken, 1)).alias("violations"),
                    )
                    for kind, subject, broken in row_rules
                ]
            ).alias("r")
        )
        reports.append(counted.select(F.inline("r")))
    for keys in rules.unique:
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        extra = (
            df.filter(whole)
            .groupBy(*keys)
            .agg((F.count("*") - 1).alias("n"))
            .agg(F.sum("n").alias("n"))
        )
        reports.append(_tally(extra, "unique", ",".join(keys)))
    for name, fk in rules.foreign_keys.items():
        known = fk.parent.select(
            *[F.col(p).alias(c) for p, c in zip(fk.parent_columns, fk.columns)]
        ).distinct()
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in fk.columns])
        used = df.filter(whole).groupBy(*fk.columns).agg(F.count("*").alias("n"))
        lost = balanced_join(used, known, fk.columns, "left_anti").agg(F.sum("n").alias("n"))
        reports.append(_tally(lost, "foreign_key", name))
    return reduce(DataFrame.unionByName, reports)


@dataclass(frozen=True)
class VersionRules:
    """Columns of a versioned dimension whose history is checked."""

    nk: str
    sk: str
    valid_from: str
    valid_to: str
    is_current: str


def check_versions(dim: DataFrame, names: VersionRules, subject: str) -> DataFrame:
    """Violations of the rules every history must keep, as a constraint report.

    ``overlap`` and ``gap``: a version ends after, or before, the next one of
    its key begins. ``one_current``: a key without exactly one current
    version. ``open_end``: the current flag and a missing end do not agree.
    ``backwards``: a version ends before it begins. Versions are compared with
    the next one in order of begin and key only; a key has few versions.
    """
    order = Window.partitionBy(names.nk).orderBy(names.valid_from, names.sk)
    end, is_open = F.col(names.valid_to), F.coalesce(F.col(names.is_current), F.lit(False))
    rows = dim.select(
        names.nk, end.alias("_end"), F.col(names.valid_from).alias("_begin"), is_open.alias("_open"),
        F.lead(names.valid_from).over(order).alias("_next"),
    )

    def hits(rule: Column) -> Column:
        return F.count(F.when(rule, 1))

    later = F.col("_next").isNotNull()
    per_key = rows.groupBy(names.nk).agg(
        hits(later & (F.col("_end").isNull() | (F.col("_end") > F.col("_next")))).alias("overlap"),
        hits(later & (F.col("_end") < F.col("_next"))).alias("gap"),
        (hits(F.col("_open")) != 1).cast("long").alias("one_current"),
        hits(F.col("_open") != F.col("_end").isNull()).alias("open_end"),
        hits(F.col("_end") < F.col("_begin")).alias("backwards"),
    )
    rules = ("overlap", "gap", "one_current", "open_end", "backwards")
    report = per_key.agg(
        F.array(
            *[
                F.struct(
                    F.lit(rule).alias("rule"),
                    F.lit(subject).alias("subject"),
                    F.coalesce(F.sum(rule), F.lit(0)).cast("long").alias("violations"),
                )
                for rule in rules
            ]
        ).alias("r")
    )
    return report.select(F.inline("r"))


def _exact(c: str) -> Column:
    """Sum that does not depend on row order."""
    return F.sum(F.col(c).cast("decimal(28,10)"))


def reconcile(
    sale: DataFrame,
    sale_item: DataFrame,
    participant_fact: DataFrame,
    sale_fact: DataFrame | None = None,
    c: SaleColumns = COLUMNS,
) -> DataFrame:
    """Totals of value and commission on every side, one row per measure.

    ``origem`` sums the sales that have items; ``origem_itens`` counts such a
    sale once per item, as the facts do, so ``fator_itens`` tells by how much
    many-to-many items multiply the sums.
    """
    per_sale = sale_item.groupBy(c.sale).agg(F.count("*").alias("_items"))
    sold = sale.select(c.sale, c.value, c.commission).join(per_sale, c.sale)
    # both sides of the source in one pass over the joined sales
    sums = {}
    for m, x in (("valor", c.value), ("comissao", c.commission)):
        sums[f"{m}_origem"] = _exact(x)
        sums[f"{m}_origem_itens"] = F.sum(F.col(x).cast("decimal(28,10)") * F.col("_items"))
    source = sold.agg(*[total.cast("double").alias(name) for name, total in sums.items()])
    pair = [
        F.struct(F.lit(side).alias("side"), *[F.col(f"{m}_{side}").alias(m) for m in ("valor", "comissao")])
        for side in ("origem", "origem_itens")
    ]
    sides = [
        source.select(F.inline(F.array(*pair))),
        participant_fact.groupBy(
            F.when(F.col("tv_tipo_cliente") == BUYER, "compradores")
            .when(F.col("tv_tipo_cliente") == SELLER, "vendedores")
            .alias("side")
        ).agg(
            _exact("tv_valor_cliente").alias("valor"),
            _exact("tv_comissao_cliente").alias("comissao"),
        ),
    ]
    if sale_fact is not None:
        sides.append(
            sale_fact.agg(
                _exact("tv_valor").alias("valor"), _exact("tv_comissao").alias("comissao")
            ).withColumn("side", F.lit("fato"))
        )
    table = reduce(
        DataFrame.unionByName,
        [s.select("side", F.col("valor").cast("double"), F.col("comissao").cast("double")) for s in sides],
    )
    long = table.select(
        "side",
        F.inline(
            F.array(
                F.struct(F.lit("valor").alias("medida"), F.col("valor").alias("total")),
                F.struct(F.lit("comissao").alias("medida"), F.col("comissao").alias("total")),
            )
        ),
    )

    def side(name: str) -> Column:
        return F.round(F.max(F.when(F.col("side") == name, F.col("total"))), 2)

    names = ["origem", "origem_itens", "compradores", "vendedores"]
    if sale_fact is not None:
        names.append("fato")
    return (
        long.groupBy("medida")
        .agg(*[side(n).alias(n) for n in names])
        .withColumn("fator_itens", F.round(F.col("origem_itens") / F.col("origem"), 6))
    )


# Buckets of rows whose digests are compared before any row is.
DIGEST_BUCKETS = 4096


def differing_rows(there: DataFrame, here: DataFrame) -> DataFrame:
    """(n_rows, n_differing): rows of ``there``, and how many rows of either
    side, repeats counted, the other lacks. Both have the same columns.

    Rows are dealt to buckets by their hash, and each bucket is reduced to a
    count and the sums of two hashes per side on the map side, so no row is
    shuffled for it. Only rows of buckets that differ are then compared by
    value; where none does, the sides are not read again.
    """
    columns = there.columns
    row = [*columns, *[F.col(c).isNull() for c in columns]]
    bucket = F.pmod(F.hash(*row), F.lit(DIGEST_BUCKETS))

    def sides(one: DataFrame, other: DataFrame) -> DataFrame:
        return one.withColumn("_side", F.lit(1)).unionByName(other.withColumn("_side", F.lit(-1)))

    sums = [total for seed in (1, 2) for total in hash_sums(F.xxhash64(F.lit(seed), *row), F.col("_side"))]
    names = [f"_sum_{i}" for i in range(len(sums))]

    digests = (
        sides(there, here)
        .groupBy(bucket.alias("_bucket"))
        .agg(
            F.count(F.when(F.col("_side") == 1, 1)).alias("n"),
            F.sum("_side").alias("_count"),
            *[total.alias(name) for total, name in zip(sums, names)],
        )
    )
    # at most a row per bucket
    found = digests.collect()
    n_rows = sum(r["n"] for r in found)
    odd = [r["_bucket"] for r in found if r["_count"] or any(r[name] for name in names)]
    spark = there.sparkSession
    if not odd:
        return spark.range(1).select(
            F.lit(n_rows if found else None).cast("long").alias("n_rows"), F.lit(0).cast("long").alias("n_differing")
        )
    near = [df.filter(bucket.isin(odd)) for df in (there, here)]
    return (
        sides(*near)
        .groupBy(*columns)
        .agg(F.sum("_side").alias("d"))
        .agg(F.lit(n_rows).cast("long").alias("n_rows"), F.coalesce(F.sum(F.abs("d")), F.lit(0)).alias("n_differing"))
    )


def side_measures(role: str | None = None) -> dict[str, Column]:
    """Rows, sales' value and commission of a fact as it is written; of the
    rows of one role, or of all where the fact has none."""
    share = "_cliente" if role else ""
    mine = F.col("tv_tipo_cliente") == role if role else F.lit(True)
    tag = f"_{role.lower()}" if role else ""
    return {
        f"linhas{tag}": F.count(F.when(mine, 1)),
        **{
            f"{m}{tag}": F.sum(F.when(mine, F.col(f"tv_{m}{share}").cast("decimal(28,10)")))
            for m in ("valor", "comissao")
        },
    }


def reconcile_counts(
    sale: DataFrame,
    sale_item: DataFrame,
    links: Mapping[str, DataFrame],
    taken: Mapping[str, object],
    c: SaleColumns = COLUMNS,
) -> DataFrame:
    """(lado, linhas_origem, linhas_fato, valor, comissao) per role: the rows
    the source calls for, against rows and sums taken while a load wrote its
    fact (``side_measures``), so the stored fact is not read at all.

    A role's rows are its links times the items of their sale; both are
    counted per sale before they meet.
    """
    per_sale = balanced_join(sale_item, sale.select(c.sale), c.sale, "left_semi").groupBy(c.sale).agg(
        F.count("*").alias("_items")
    )
    sides = []
    for role, link in links.items():
        linked = link.groupBy(c.sale).agg(F.count("*").alias("_links"))
        due = balanced_join(linked, per_sale, c.sale).agg(
            F.coalesce(F.sum(F.col("_links") * F.col("_items")), F.lit(0)).alias("linhas_origem")
        )
        tag = role.lower()

        def number(m: str, tag: str = tag) -> Column:
            value = taken[f"{m}_{tag}"]
            return F.round(F.lit(value).cast("double"), 2).alias(m)

        sides.append(
            due.select(
                F.lit(role).alias("lado"),
                "linhas_origem",
                F.lit(taken[f"linhas_{tag}"]).cast("long").alias("linhas_fato"),
                number("valor"),
                number("comissao"),
            )
        )
    return reduce(DataFrame.unionByName, sides)


def coverage(view: DataFrame) -> DataFrame:
    """How many sales have a benchmark, as numbers and as the line x/y."""
    return view.agg(
        F.count("agio_vs_mercado").alias("com_benchmark"), F.count("*").alias("vendas")
    ).withColumn(
        "linha", F.format_string("%d/%d vendas com benchmark", "com_benchmark", "vendas")
    )
