"""Sale facts, bridges and aggregates.

Inputs follow the operational tables' column names; the column roles are
gathered in :class:`SaleColumns` so that any tables of the same shape work.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.functions import date_key, unit_price
from dimwright.operators.joins import balanced_join
from dimwright.session import materialise, together

BUYER = "COMPRADOR"
SELLER = "VENDEDOR"


@dataclass(frozen=True)
class SaleColumns:
    """Names of the columns of sale, sale item and participant tables."""

    sale: str = "transvendaid"
    value: str = "transvendavalor"
    commission: str = "transcomissao"
    date: str = "transvendadata"
    broker: str = "funccpf"
    item: str = "imovelid"
    client: str = "clientecpf"


@dataclass(frozen=True)
class SaleDims:
    """Dimensions a sale fact binds to. Facts take the versions current now."""

    broker: DataFrame  # cor_cpf, cor_sk, cor_is_atual
    item: DataFrame  # im_id, im_sk, im_is_atual
    client: DataFrame | None = None  # cl_cpf, cl_sk, cl_is_atual
    date: DataFrame | None = None  # dt_data_completa, dt_sk


COLUMNS = SaleColumns()


def _current_keys(dim: DataFrame, prefix: str, nk: str, alias: str, *more: Column) -> DataFrame:
    return dim.filter(F.col(f"{prefix}_is_atual")).select(
        F.col(nk).alias(alias), F.col(f"{prefix}_sk"), *more
    )


def _sale_items(
    sale: DataFrame, sale_item: DataFrame, dims: SaleDims, c: SaleColumns, *of_item: Column
) -> DataFrame:
    """Sale x item with broker, item and date keys, before any fan-out.

    Each key is looked up on the narrow table that holds it, before sales and
    items meet: what is joined on the sale is not shuffled by another key again.
    """
    sold = sale.select(c.sale, c.value, c.commission, c.date, c.broker)
    brokers = _current_keys(dims.broker, "cor", "cor_cpf", c.broker)
    sold = _with_date_key(balanced_join(sold, brokers, c.broker).drop(c.broker), dims.date, c)
    items = _current_keys(dims.item, "im", "im_id", c.item, *of_item)
    lines = balanced_join(sale_item.select(c.sale, c.item), items, c.item).drop(c.item)
    return balanced_join(lines, sold.drop(c.date), c.sale)


def participants(buyers: DataFrame, sellers: DataFrame, c: SaleColumns = COLUMNS) -> DataFrame:
    """One row per sale, client and role."""
    return (
        buyers.select(c.sale, c.client)
        .withColumn("tv_tipo_cliente", F.lit(BUYER))
        .unionByName(
            sellers.select(c.sale, c.client).withColumn("tv_tipo_cliente", F.lit(SELLER))
        )
    )


def participant_fact(
    sale: DataFrame,
    sale_item: DataFrame,
    buyers: DataFrame,
    sellers: DataFrame,
    dims: SaleDims,
    c: SaleColumns = COLUMNS,
    new_sales: DataFrame | None = None,
    existing: DataFrame | None = None,
    carried: Column | None = None,
) -> DataFrame:
    """One row per sale x item x participant; value and commission are shared
    equally inside a role, and both role totals stand on every row.

    With ``new_sales`` (sale ids; repeats count once) only those sales are
    built. With ``existing`` as well, sales it holds unchanged are left out;
    one that has got further participants or items since comes back whole,
    with new shares, to take the place of its held rows (``replace_sales``).
    ``carried``, a struct of the item's row, stands on every row as ``_item``.
    """
    everyone = participants(buyers, sellers, c)
    if new_sales is not None:
        ids = new_sales.select(c.sale).distinct()
        if existing is not None:
            ids = due_sales(ids, sale_item, buyers, sellers, existing, c).select(c.sale)
        # as large as the batch, and read five times below
        ids = materialise(ids, "new-sales")
        sale = balanced_join(sale, ids, c.sale, "left_semi")
        sale_item = balanced_join(sale_item, ids, c.sale, "left_semi")
        # ids are distinct; unlike a semi join this one is not repeated for either role
        everyone = balanced_join(everyone, ids, c.sale)

    totals = everyone.groupBy(c.sale).agg(
        F.count(F.when(F.col("tv_tipo_cliente") == BUYER, 1)).cast("int").alias("tv_total_compradores"),
        F.count(F.when(F.col("tv_tipo_cliente") == SELLER, 1)).cast("int").alias("tv_total_vendedores"),
    )
    # the totals count clients without a version too; the rows need one, found before the fan-out
    clients = _current_keys(dims.client, "cl", "cl_cpf", c.client)
    known = balanced_join(everyone, clients, c.client).drop(c.client)
    more = [] if carried is None else [carried.alias("_item")]
    lines = _sale_items(sale, sale_item, dims, c, *more)
    lines = balanced_join(lines, totals, c.sale)
    rows = balanced_join(known, lines, c.sale)

    peers = F.when(
        F.col("tv_tipo_cliente") == BUYER, F.col("tv_total_compradores")
    ).otherwise(F.col("tv_total_vendedores"))
    fact = rows.select(
        F.col(c.sale).alias("tv_id"),
        F.col(c.value).cast("double").alias("tv_valor"),
        (F.col(c.value).cast("double") / peers).alias("tv_valor_cliente"),
        F.col(c.commission).cast("double").alias("tv_comissao"),
        (F.col(c.commission).cast("double") / peers).alias("tv_comissao_cliente"),
        "tv_tipo_cliente",
        "tv_total_compradores",
        "tv_total_vendedores",
        "cor_sk",
        "im_sk",
        "cl_sk",
        "dt_sk",
        *(["_item"] if more else []),
    )
    return fact


def due_sales(
    named: DataFrame,
    sale_item: DataFrame,
    buyers: DataFrame,
    sellers: DataFrame,
    existing: DataFrame,
    c: SaleColumns = COLUMNS,
    every: bool = False,
) -> DataFrame:
    """(sale, is_held) of the named sales that ``existing`` lacks, or holds
    with other numbers of buyers, sellers or items than the source has now.

    A held sale that is named again unchanged keeps its rows, and with them
    the versions it was bound to. Links, items and held rows are stacked, cut
    to the named sales in one join and counted per sale in one pass, so a task
    sorts two inputs, however many tables there are. Where ``every`` sale of
    the source is named, a cut would spare nothing: rows are then combined
    before they are shuffled, and nothing is joined or sorted.
    """
    kinds = {kind: i for i, kind in enumerate(("named", "buyer", "seller", "item", "held"))}
    ids = named.select(c.sale).distinct()
    stack = [
        (named.select(c.sale) if every else ids).withColumn("_kind", F.lit(kinds["named"])),
        buyers.select(c.sale, F.lit(kinds["buyer"]).alias("_kind")),
        sellers.select(c.sale, F.lit(kinds["seller"]).alias("_kind")),
        sale_item.select(c.sale, F.lit(kinds["item"]).alias("_kind")),
        existing.select(
            F.col("tv_id").alias(c.sale),
            F.lit(kinds["held"]).alias("_kind"),
            "im_sk",
            "tv_total_compradores",
            "tv_total_vendedores",
        ),
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stack)

    def of(kind: str) -> Column:
        return F.col("_kind") == kinds[kind]

    # a NULL id meets nothing, and is never held
    # ids are distinct; a semi join would be repeated for every table
    rows = rows.filter(F.col(c.sale).isNotNull()) if every else balanced_join(rows, ids, c.sale)
    # a row per sale and held item first, so items are counted without a set
    per_item = rows.groupBy(c.sale, "im_sk").agg(
        *[F.count(F.when(of(kind), 1)).alias(f"_{kind}s") for kind in ("buyer", "seller", "item")],
        F.max("tv_total_compradores").alias("_held_buyers"),
        F.max("tv_total_vendedores").alias("_held_sellers"),
        F.max(of("held")).alias("is_held"),
        F.max(of("named")).alias("_is_named"),
    )
    found = per_item.groupBy(c.sale).agg(
        *[F.sum(f"_{kind}s").alias(f"_{kind}s") for kind in ("buyer", "seller", "item")],
        *[F.max(f"_held_{kind}s").alias(f"_held_{kind}s") for kind in ("buyer", "seller")],
        F.count("im_sk").alias("_held_items"),
        F.max("is_held").alias("is_held"),
        F.max("_is_named").alias("_is_named"),
    ).filter("_is_named")
    same = reduce(
        lambda a, b: a & b, [F.col(f"_{x}") == F.col(f"_held_{x}") for x in ("buyers", "sellers", "items")]
    )
    due = found.filter(~F.col("is_held") | ~same).select(c.sale, "is_held")
    return due.unionByName(ids.filter(F.col(c.sale).isNull()).withColumn("is_held", F.lit(False)))


def replace_sales(fact: DataFrame, rows: DataFrame) -> DataFrame:
    """Snapshot of ``fact`` in which the sales of ``rows`` consist of these."""
    kept = balanced_join(fact, rows.select("tv_id").distinct(), "tv_id", "left_anti")
    return kept.unionByName(rows, allowMissingColumns=True)


def unresolved_sales(
    ids: DataFrame | None,
    sale: DataFrame,
    sale_item: DataFrame,
    buyers: DataFrame,
    sellers: DataFrame,
    dims: SaleDims,
    c: SaleColumns = COLUMNS,
) -> DataFrame:
    """(sale, missing) of the given sales that cannot become fact rows yet;
    without ``ids`` all sales are looked at.

    ``missing`` names what has not arrived, in order: the broker's, client's
    or item's dimension row, any item or participant of the sale, or the sale
    itself. Foreign keys are made distinct before they are looked up, so a
    broker with very many sales costs one row, and only the sales of unknown
    keys go on. Sales, items and participants are stacked and marked per sale
    in one pass, which combines on the map side.
    """
    everyone = participants(buyers, sellers, c)
    every_sale = ids is None
    # links may name sales that are not there, and a NULL id names none
    ids = sale.select(c.sale).filter(F.col(c.sale).isNotNull()) if every_sale else ids.select(c.sale).distinct()

    def lacking(df: DataFrame, key: str, dim: DataFrame, prefix: str, nk: str) -> DataFrame:
        known = _current_keys(dim, prefix, nk, key).select(key)
        # stored, so that their number is known before the sales are looked at:
        # while they fit a broadcast no sale is shuffled to find them
        unknown = materialise(balanced_join(df.select(key).distinct(), known, key, "left_anti"), "unknown")
        # a NULL key is unknown too, and meets nothing in a join
        hits = balanced_join(df, unknown, key, "left_semi").unionByName(df.filter(F.col(key).isNull()))
        return hits.select(c.sale)

    unknown = together(
        sale.sparkSession,
        lambda: lacking(sale, c.broker, dims.broker, "cor", "cor_cpf"),
        lambda: lacking(everyone, c.client, dims.client, "cl", "cl_cpf"),
        lambda: lacking(sale_item, c.item, dims.item, "im", "im_id"),
    )
    lost = reduce(
        DataFrame.unionByName,
        [df.withColumn("what", F.lit(what)) for what, df in zip(("broker", "client", "item"), unknown)],
    )
    lost = balanced_join(lost, ids, c.sale)  # repeats count once below

    arrived = {"items": sale_item, "participants": everyone} | ({} if every_sale else {"sale": sale})
    bits = {what: 1 << i for i, what in enumerate(("id", *arrived))}
    there = reduce(
        DataFrame.unionByName,
        [df.select(c.sale, F.lit(bits[what]).alias("_what")) for what, df in arrived.items()],
    )
    if not every_sale:  # few ids cut the tables before anything is shuffled
        there = balanced_join(there, ids, c.sale)
    there = there.filter(F.col(c.sale).isNotNull()).unionByName(ids.withColumn("_what", F.lit(bits["id"])))
    marks = there.groupBy(c.sale).agg(F.bit_or("_what").alias("_there"))

    def lacks(what: str) -> Column:
        return F.col("_there").bitwiseAND(F.lit(bits[what])) == 0

    # as a rule no sale lacks anything, so none is taken apart
    some = marks.filter(~lacks("id") & reduce(lambda a, b: a | b, [lacks(what) for what in arrived]))
    absent = some.select(
        c.sale, F.explode(F.array(*[F.when(lacks(what), F.lit(what)) for what in arrived])).alias("what")
    )
    # at most six names a sale
    return (
        lost.unionByName(absent.filter(F.col("what").isNotNull()))
        .groupBy(c.sale)
        .agg(F.concat_ws(",", F.array_sort(F.collect_set("what"))).alias("missing"))
    )


def sale_fact(
    sale: DataFrame,
    sale_item: DataFrame,
    dims: SaleDims,
    c: SaleColumns = COLUMNS,
    existing: DataFrame | None = None,
) -> DataFrame:
    """One row per sale x item, undivided. With ``existing`` only sales whose
    id the fact does not hold; they are dropped before any other join."""
    if existing is not None:
        held = existing.select(F.col("tv_id").alias(c.sale)).distinct()
        sale = balanced_join(sale, held, c.sale, "left_anti")
    return _sale_items(sale, sale_item, dims, c).select(
        F.col(c.sale).alias("tv_id"),
        F.col(c.value).cast("double").alias("tv_valor"),
        F.col(c.commission).cast("double").alias("tv_comissao"),
        "cor_sk",
        "im_sk",
        "dt_sk",
    )


def bridge(
    fact: DataFrame,
    link: DataFrame,
    client_dim: DataFrame,
    c: SaleColumns = COLUMNS,
    existing: DataFrame | None = None,
) -> DataFrame:
    """(fact key, client key) pairs of one role, with the client's current
    version; with ``existing`` only pairs it does not hold."""
    keys = fact.select(F.col("tv_id").alias(c.sale), "tv_sk")
    pairs = balanced_join(link.select(c.sale, c.client), keys, c.sale)
    clients = _current_keys(client_dim, "cl", "cl_cpf", c.client)
    pairs = balanced_join(pairs, clients, c.client)
    pairs = pairs.select("tv_sk", "cl_sk")
    if existing is None:
        return pairs
    return balanced_join(pairs, existing.select("tv_sk", "cl_sk"), ["tv_sk", "cl_sk"], "left_anti")


def _item_days(
    sale: DataFrame,
    sale_item: DataFrame,
    item_dim: DataFrame,
    date_dim: DataFrame | None,
    c: SaleColumns,
) -> DataFrame:
    """Commission of each sale x item with its keys, looked up as for ``_sale_items``."""
    sold = _with_date_key(sale.select(c.sale, c.commission, c.date), date_dim, c)
    items = _current_keys(item_dim, "im", "im_id", c.item)
    lines = balanced_join(sale_item.select(c.sale, c.item), items, c.item).drop(c.item)
    return balanced_join(lines, sold.drop(c.date), c.sale)


def aggregate_fact(
    sale: DataFrame,
    sale_item: DataFrame,
    item_dim: DataFrame,
    date_dim: DataFrame | None = None,
    c: SaleColumns = COLUMNS,
    total: Column | None = None,
) -> DataFrame:
    """Commission per (current item version, day)."""
    amount = F.sum(c.commission) if total is None else total
    return (
        _item_days(sale, sale_item, item_dim, date_dim, c)
        .groupBy("im_sk", "dt_sk")
        .agg(amount.cast("double").alias("ra_comissao_total"))
    )


def restate_aggregate(
    agg: DataFrame,
    new_sales: DataFrame,
    sale: DataFrame,
    sale_item: DataFrame,
    item_dim: DataFrame,
    date_dim: DataFrame | None = None,
    c: SaleColumns = COLUMNS,
) -> DataFrame:
    """Snapshot of ``agg`` with the (item, day) pairs touched by ``new_sales``
    recomputed from the source and all other rows kept."""
    kept, fresh = restate_parts(agg, new_sales, sale, sale_item, item_dim, date_dim, c)
    return kept.select("im_sk", "dt_sk", "ra_comissao_total").unionByName(fresh)


def restate_parts(
    agg: DataFrame,
    new_sales: DataFrame,
    sale: DataFrame,
    sale_item: DataFrame,
    item_dim: DataFrame,
    date_dim: DataFrame | None = None,
    c: SaleColumns = COLUMNS,
    held: DataFrame | None = None,
    touched: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Kept and recomputed rows of :func:`restate_aggregate`; with ``held``
    (sale ids) only those sales count. ``touched`` are the new sales' pairs,
    stored, where the caller has found them."""
    if touched is None:
        ids = new_sales.select(c.sale).distinct()
        # as large as the batch, and read four times below
        touched = materialise(touched_pairs(ids, sale, sale_item, c), "touched")
    # only sales of touched items on touched days are read past this point
    days = touched.select(c.date).distinct()
    items = touched.select(c.item).distinct()
    near_sales = balanced_join(sale, days, c.date, "left_semi")
    near_items = balanced_join(sale_item, items, c.item, "left_semi")
    if held is not None:
        # a fact holds a sale in many rows, which lie together
        near_sales = balanced_join(near_sales, held.select(c.sale).distinct(), c.sale, "left_semi")
    lines = balanced_join(
        near_items.select(c.sale, c.item),
        near_sales.select(c.sale, c.commission, c.date),
        c.sale,
    )
    lines = balanced_join(lines, touched, [c.item, c.date], "left_semi")
    keys = _current_keys(item_dim, "im", "im_id", c.item)
    fresh = (
        _with_date_key(balanced_join(lines, keys, c.item), date_dim, c)
        .groupBy("im_sk", "dt_sk")
        .agg(F.sum(c.commission).cast("double").alias("ra_comissao_total"))
    )
    stale = _with_date_key(balanced_join(touched, keys, c.item), date_dim, c)
    kept = balanced_join(agg, stale.select("im_sk", "dt_sk"), ["im_sk", "dt_sk"], "left_anti")
    return kept, fresh


def touched_pairs(
    ids: DataFrame, sale: DataFrame, sale_item: DataFrame, c: SaleColumns = COLUMNS
) -> DataFrame:
    """Distinct (item, date) of the given sales."""
    some = balanced_join(sale.select(c.sale, c.date), ids, c.sale, "left_semi")
    lines = balanced_join(sale_item.select(c.sale, c.item), some, c.sale)
    return lines.select(c.item, c.date).distinct()


def _with_date_key(df: DataFrame, date_dim: DataFrame | None, c: SaleColumns) -> DataFrame:
    """Date key from the dimension, or worked out where none is given."""
    if date_dim is None:
        return df.withColumn("dt_sk", date_key(c.date))
    days = date_dim.select(F.col("dt_data_completa").alias(c.date), "dt_sk")
    return balanced_join(df, days, c.date)


def append_aggregate(agg: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows of ``fresh`` whose (total, item, day) triple ``agg`` lacks.

    The bridge variant's rule: a changed total is added beside the old one,
    not put in its place; :func:`restate_aggregate` is the default.
    """
    triple = ["im_sk", "dt_sk", "ra_comissao_total"]
    return balanced_join(fresh.select(*triple), agg.select(*triple), triple, "left_anti")


def derive_unit_price(
    fact: DataFrame, item_dim: DataFrame, value: str = "tv_valor", area: str = "im_m2"
) -> DataFrame:
    """Fill ``tv_valor_m2`` where it is still NULL, with the area of the item
    version the fact is bound to."""
    if "tv_valor_m2" not in fact.columns:
        fact = fact.withColumn("tv_valor_m2", F.lit(None).cast("double"))
    areas = item_dim.select("im_sk", F.col(area).alias("_area"))
    joined = balanced_join(fact, areas, "im_sk", "left")
    return joined.withColumn(
        "tv_valor_m2", F.coalesce("tv_valor_m2", unit_price(value, "_area"))
    ).drop("_area")


def first_per_key(
    df: DataFrame, key: str, order: str, columns: Sequence[str]
) -> DataFrame:
    """The row of each key that comes first by ``order``; combines on the map
    side, so a key with very many rows is no burden."""
    return df.groupBy(key).agg(*[F.min_by(x, order).alias(x) for x in columns])
