"""Market index: reshaping its sheets, linking sales to it, measuring against it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dimwright.functions import (
    band_of,
    fold_ascii,
    fold_key,
    month_of_date_key,
    parse_number,
    premium,
    unit_price,
)
from dimwright.functions.columns import BANDS, TOTAL_BAND
from dimwright.operators.facts import first_per_key
from dimwright.operators.joins import balanced_join

# Sheets that hold no city, and the zero-based first column of
# each five-band block of a city's sheet.
IGNORED_SHEETS = ("Resumo", "Aux", "Índice FipeZAP")
BLOCKS = {"var_mensal": 7, "var_12m": 12, "preco_m2": 17}


def wide_to_long(
    df: DataFrame,
    sheet: str = "sheet",
    date_col: str = "c1",
    bands: Sequence[str] = BANDS,
    blocks: dict[str, int] = BLOCKS,
    ignored: Sequence[str] = IGNORED_SHEETS,
    price: str = "preco_m2",
) -> DataFrame:
    """Long rows (city, month, band, measures) of wide monthly sheets.

    ``df`` has one row per sheet row with text cells named ``c0``, ``c1``, ...
    Ignored sheets, rows whose date cell holds no date and bands without a
    numeric price are dropped; other cells that are no number become NULL.
    Prices are rounded to cents.
    """
    written = F.col(date_col).cast("string")
    month = F.when(written.rlike(r"^\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?)?$"), written.try_cast("date"))

    def cell(block: str, i: int) -> Column:
        return parse_number(f"c{blocks[block] + i}")

    per_band = F.array(
        *[
            F.struct(
                F.lit(band).alias("dormitorios"),
                *[cell(block, i).alias(block) for block in blocks],
            )
            for i, band in enumerate(bands)
        ]
    )
    rows = (
        df.filter(~F.col(sheet).isin(*ignored))
        .withColumn("mes", month)
        .filter(F.col("mes").isNotNull())
        .select(
            F.col(sheet).alias("cidade"),
            fold_ascii(sheet).alias("cidade_norm"),
            "mes",
            F.inline(per_band),
        )
        .filter(F.col(price).isNotNull())
    )
    others = [b for b in blocks if b != price]
    return rows.select(
        "cidade",
        "cidade_norm",
        "mes",
        "dormitorios",
        F.round(price, 2).alias(price),
        *others,
    )


def _bands_in_a_row(market: DataFrame) -> DataFrame:
    """One row per (city, month) with a key column per band."""
    return market.groupBy("mk_cidade_norm", "mk_mes").agg(
        *[
            F.max(F.when(F.col("mk_dormitorios") == b, F.col("mk_sk"))).alias(f"_mk_{b}")
            for b in BANDS
        ]
    )


def link_benchmark(
    fact: DataFrame,
    item_dim: DataFrame,
    market: DataFrame,
    kind: str = "Apartamento",
) -> DataFrame:
    """Fill ``mk_sk`` where it is still NULL and the item is of ``kind``.

    The market row has the item's folded city, the sale's month and the
    item's band, or else the total band; without either the key stays NULL
    and the next load tries again. The market is turned to one row per city
    and month first, so exact band and fallback come out of a single look-up,
    and city and band are worked out per item rather than per sale.
    """
    return _linked(_with_item(fact, item_dim, of_item(kind)), market).select(
        *fact.columns, *(["mk_sk"] if "mk_sk" not in fact.columns else [])
    )


def of_item(kind: str, *more: Column) -> Column:
    """What a link needs of an item, and ``more``, as the struct ``_item``."""
    is_kind = F.col("im_tipo") == kind
    return F.struct(
        *more,
        F.coalesce(is_kind, F.lit(False)).alias("of_kind"),
        F.when(is_kind, fold_key("im_cidade")).alias("city"),
        band_of("im_qtd_quartos").alias("band"),
    ).alias("_item")


def price_item(kind: str) -> Column:
    """``of_item`` with what a unit price needs too."""
    return of_item(kind, F.col("im_m2").alias("area"))


def _with_item(fact: DataFrame, item_dim: DataFrame, item: Column) -> DataFrame:
    """The fact with ``item``, by one join on ``im_sk``."""
    if "mk_sk" not in fact.columns:
        fact = fact.withColumn("mk_sk", F.lit(None).cast("long"))
    return balanced_join(fact, item_dim.select("im_sk", item), "im_sk", "left")


def _linked(joined: DataFrame, market: DataFrame) -> DataFrame:
    # rows already linked take no part in the market join
    joined = joined.withColumn("mk_mes", month_of_date_key("dt_sk")).withColumn(
        "_open_city", F.when(F.col("mk_sk").isNull(), F.col("_item.city"))
    )
    wide = _bands_in_a_row(market).withColumnRenamed("mk_cidade_norm", "_open_city")
    joined = balanced_join(joined, wide, ["_open_city", "mk_mes"], "left")
    exact = F.coalesce(
        *[F.when(F.col("_item.band") == b, F.col(f"_mk_{b}")) for b in BANDS if b != TOTAL_BAND]
    )
    return joined.withColumn("mk_sk", F.coalesce("mk_sk", exact, f"_mk_{TOTAL_BAND}"))


def price_and_link(
    fact: DataFrame,
    item_dim: DataFrame,
    market: DataFrame,
    kind: str = "Apartamento",
    fresh: DataFrame | None = None,
) -> DataFrame:
    """Unit price and benchmark link of a fact in one pass, each filled where
    it is still NULL, and ``is_settled``: no later load can add anything.

    ``fresh`` rows that carry their item (``price_item`` as ``_item``, taken
    where the item was looked up) come in addition and need no join on it.
    """
    if "tv_valor_m2" not in fact.columns:
        fact = fact.withColumn("tv_valor_m2", F.lit(None).cast("double"))
    if "mk_sk" not in fact.columns:
        fact = fact.withColumn("mk_sk", F.lit(None).cast("long"))
    rows = _with_item(fact, item_dim, price_item(kind))
    if fresh is not None:
        rows = rows.unionByName(fresh, allowMissingColumns=True)
    joined = _linked(rows, market)
    price = F.coalesce("tv_valor_m2", unit_price("tv_valor", "_item.area"))
    linked = F.col("mk_sk").isNotNull() | ~F.col("_item.of_kind")
    return joined.withColumn("tv_valor_m2", price).select(
        *fact.columns,
        F.coalesce(linked & F.col("tv_valor_m2").isNotNull(), F.lit(False)).alias("is_settled"),
    )


SALE_COLUMNS = (
    "cor_sk",
    "im_sk",
    "dt_sk",
    "mk_sk",
    "tv_total_compradores",
    "tv_total_vendedores",
    "tv_valor",
    "tv_comissao",
    "tv_valor_m2",
)


def sale_vs_market(
    fact: DataFrame,
    broker_dim: DataFrame,
    item_dim: DataFrame,
    date_dim: DataFrame,
    market: DataFrame,
    first_by: str = "tv_sk",
) -> DataFrame:
    """One row per sale, its attributes, and its premium over the market.

    The participant fact repeats sale-level columns per client; its first row
    by ``first_by`` stands for the sale.
    """
    sales = first_per_key(fact, "tv_id", first_by, SALE_COLUMNS)
    brokers = broker_dim.select(
        "cor_sk", F.concat("cor_nome", F.lit(" "), "cor_sobrenome").alias("corretor")
    )
    items = item_dim.select(
        "im_sk", "im_cidade", "im_estado", "im_bairro", "im_tipo", "im_qtd_quartos", "im_m2"
    )
    days = date_dim.select("dt_sk", "dt_data_completa")
    prices = market.select("mk_sk", "mk_preco_m2", "mk_var_12m")
    rows = balanced_join(sales, items, "im_sk")
    rows = balanced_join(rows, days, "dt_sk")
    rows = balanced_join(rows, brokers, "cor_sk")
    rows = balanced_join(rows, prices, "mk_sk", "left")
    return rows.select(
        "tv_id",
        "cor_sk",
        "im_sk",
        "dt_sk",
        "mk_sk",
        "tv_total_compradores",
        "tv_total_vendedores",
        "dt_data_completa",
        "corretor",
        "im_cidade",
        "im_estado",
        "im_bairro",
        "im_tipo",
        "im_qtd_quartos",
        "im_m2",
        "tv_valor",
        "tv_comissao",
        "tv_valor_m2",
        "mk_preco_m2",
        "mk_var_12m",
        premium("tv_valor_m2", "mk_preco_m2").alias("agio_vs_mercado"),
    )


def benchmark_measures(view: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Average premium, own price and market price, and the number of sales
    with a benchmark; all of them pass over NULLs. Sums are exact decimals, so
    no row order shows; the quotient is rounded once, to five decimals."""

    def mean(c: str) -> Column:
        exact = F.sum(F.col(c).cast("decimal(28,10)")) / F.count(c)
        return F.round(exact, 5).cast("double")

    return view.groupBy(*by).agg(
        mean("agio_vs_mercado").alias("agio_medio"),
        mean("tv_valor_m2").alias("preco_m2_nosso"),
        mean("mk_preco_m2").alias("preco_m2_mercado"),
        F.count("agio_vs_mercado").alias("vendas_com_benchmark"),
    )


def market_subset(market: DataFrame, item_dim: DataFrame) -> DataFrame:
    """Market rows of the cities the item dimension knows."""
    cities = item_dim.select("im_cidade").distinct().select(
        fold_key("im_cidade").alias("mk_cidade_norm")
    )
    return balanced_join(market, cities.distinct(), "mk_cidade_norm", "left_semi")
