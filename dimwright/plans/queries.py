"""One query per operator, over the test tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.functions import fold_key
from dimwright.operators.dates import date_dimension
from dimwright.operators.facts import (
    BUYER,
    SELLER,
    SaleDims,
    aggregate_fact,
    append_aggregate,
    bridge,
    derive_unit_price,
    participant_fact,
    restate_aggregate,
    sale_fact,
)
from dimwright.operators.joins import balanced_join, collated_join
from dimwright.operators.market import (
    benchmark_measures,
    link_benchmark,
    market_subset,
    sale_vs_market,
    wide_to_long,
)
from dimwright.operators.quality import (
    ForeignKey,
    Rules,
    VersionRules,
    check_constraints,
    check_versions,
    coverage,
    differing_rows,
    reconcile,
    reconcile_counts,
    side_measures,
)
from dimwright.operators.scd2 import scd2_extend, scd2_fill, scd2_initial, scd2_merge
from dimwright.operators.surrogate import assign_surrogate_keys
from dimwright.plans import pipeline, rules, star
from dimwright.plans.pipeline import Paths
from dimwright.plans.testmap import CUT, MID_MONTH_CUT, TS0, TS1, Source, event_feed, read
from dimwright.session import fresh_path, materialise, together
from dimwright.sources.lake import MARKET_TABLE, land_snapshot, publish_gold, read_landed
from dimwright.sources.versions import Lake
from dimwright.streaming.feed import (
    changed_keys,
    consume_feed,
    feed_from_snapshots,
    follow_feed,
    latest_change,
    read_feed,
)

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def _query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- shared pieces ---------------------------------------------------------


def _broker_dim(src: Source) -> DataFrame:
    t = {"corretor": src.corretor(), "funcionario": src.funcionario()}
    return scd2_initial(star.broker_source(t), star.BROKER, star.BROKER_ATTRS, TS0)


def _client_dim(src: Source) -> DataFrame:
    t = {"cliente": src.cliente()}
    return scd2_initial(star.client_source(t), star.CLIENT, star.CLIENT_ATTRS, TS0)


def _item_dim(src: Source) -> DataFrame:
    t = src.tables()
    rows = star.item_source(t).join(star.item_extra(t), "im_id")
    return scd2_initial(rows, star.ITEM, [*star.ITEM_ATTRS, *star.ITEM_EXTRA], TS0)


def _date_dim(src: Source) -> DataFrame:
    return date_dimension(src.transvenda(), "transvendadata")


def _market_dim(src: Source) -> DataFrame:
    stage = star.market_stage(wide_to_long(src.wide_sheet()))
    return star.load_market(None, stage, TS0, "insert_only")


def _dims(src: Source) -> SaleDims:
    broker, item, client = together(
        src.spark, lambda: _broker_dim(src), lambda: _item_dim(src), lambda: _client_dim(src)
    )
    return SaleDims(broker, item, client)


def _participants(src: Source, dims: SaleDims, many_items: bool = False, **more) -> DataFrame:
    t = src.tables(many_items)
    return participant_fact(
        t["transvenda"], t["imoveltransacao"], t["clientecompra"], t["clientevende"], dims, **more
    )


def _dims_and_market(src: Source) -> tuple[SaleDims, DataFrame]:
    dims, market = together(src.spark, lambda: _dims(src), lambda: _market_dim(src))
    return dims, market


def _view(src: Source) -> tuple[DataFrame, DataFrame]:
    """Sales against the market, and the market."""
    dims, market = _dims_and_market(src)
    fact = link_benchmark(
        derive_unit_price(_participants(src, dims), dims.item), dims.item, market
    )
    # all rows of a sale agree here, so any order picks the same sale row
    view = sale_vs_market(fact, dims.broker, dims.item, _date_dim(src), market, first_by="cl_sk")
    return view, market


# --- lake ------------------------------------------------------------------


@_query
def land_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land every source table as CSV, read it back typed, and total it."""
    keys = {
        "nation": ("n_nationkey", None),
        "region": ("r_regionkey", None),
        "customer": ("c_custkey", "c_acctbal"),
        "supplier": ("s_suppkey", "s_acctbal"),
        "part": ("p_partkey", "p_retailprice"),
        "orders": ("o_orderkey", "o_totalprice"),
        "lineitem": ("l_orderkey", "l_extendedprice"),
    }
    sources = {n: read(spark, sf_dir, n) for n in keys}
    out = fresh_path(spark, "bronze")
    land_snapshot(sources, out, fmt="csv")
    totals = []
    for name, (key, amount) in keys.items():
        back = read_landed(spark, f"{out}/{name}", sources[name].schema, fmt="csv")
        money = F.sum(F.col(amount).cast("decimal(18,2)")) if amount else F.lit(0)
        totals.append(
            back.agg(
                F.count("*").alias("n_rows"),
                F.sum(F.col(key).cast("long")).alias("key_sum"),
                money.cast("double").alias("amount_sum"),
            ).select(F.lit(name).alias("table_name"), "n_rows", "key_sum", "amount_sum")
        )
    report = totals[0]
    for t in totals[1:]:
        report = report.unionByName(t)
    return report


TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "pages", "benchmark", "labels", "conversations", "embeddings",
)


@_query
def land_text_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every table landed and read back: rows, NULLs and a digest of each text
    column. Tables with a column CSV cannot hold are landed as Parquet."""
    out = fresh_path(spark, "bronze")
    reports = []
    for name in TABLES:
        source = read(spark, sf_dir, name)
        kinds = dict(source.dtypes)
        fmt = "parquet" if any(k.startswith(("array", "map", "struct")) for k in kinds.values()) else "csv"
        land_snapshot({name: source}, out, fmt)
        back = read_landed(spark, f"{out}/{name}", source.schema, fmt)
        texts = [c for c, k in kinds.items() if k == "string"]
        columns = [
            F.struct(
                F.lit(c).alias("column_name"),
                F.count("*").alias("n_rows"),
                F.count(F.when(F.col(c).isNull(), 1)).alias("n_null"),
                F.coalesce(
                    F.sum(F.conv(F.substring(F.md5(F.col(c).cast("binary")), 1, 8), 16, 10).cast("decimal(20,0)")), F.lit(0)
                ).cast("long").alias("digest"),
            )
            for c in texts
        ] or [
            F.struct(
                F.lit("").alias("column_name"), F.count("*").alias("n_rows"),
                F.lit(0).cast("long").alias("n_null"), F.lit(0).cast("long").alias("digest"),
            )
        ]
        reports.append(back.agg(F.array(*columns).alias("r")).select(F.lit(name).alias("table_name"), F.inline("r")))
    return reduce(DataFrame.unionByName, reports)


@_query
def market_subset_region(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market rows of the cities of one region's properties, as published:
    the rows of the other regions go."""
    src = Source(spark, sf_dir)
    dim, market = together(spark, lambda: _item_dim(src), lambda: _market_dim(src))
    known = dim.filter(F.col("im_estado") == "ASIA")
    out = fresh_path(spark, "gold")
    publish_gold({"imovel_dimension": known, MARKET_TABLE: market}, out, fmt="csv")
    back = read_landed(spark, f"{out}/{MARKET_TABLE}", market.schema, fmt="csv")
    return back.select("mk_sk", *star.MARKET_KEY, "mk_preco_m2")


@_query
def market_subset_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market rows of cities where properties have been sold, as exported."""
    src = Source(spark, sf_dir)
    dim, market = together(spark, lambda: _item_dim(src), lambda: _market_dim(src))
    out = fresh_path(spark, "gold")
    publish_gold({"imovel_dimension": dim, MARKET_TABLE: market}, out, fmt="csv")
    back = read_landed(spark, f"{out}/{MARKET_TABLE}", market.schema, fmt="csv")
    return back.select("mk_sk", *star.MARKET_KEY, "mk_preco_m2")


@_query
def market_subset_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market rows of the cities in which the second load's sales lie."""
    src = Source(spark, sf_dir)
    sold = (
        src.imoveltransacao()
        .join(
            src.transvenda().filter(F.col("transvendadata") >= F.lit(CUT)).select("transvendaid"),
            "transvendaid",
            "left_semi",
        )
        .select(F.col("imovelid").alias("im_id"))
    )
    dim = balanced_join(_item_dim(src), sold.distinct(), "im_id", "left_semi")
    return market_subset(_market_dim(src), dim).select("mk_sk", *star.MARKET_KEY, "mk_preco_m2")


# --- reshaping and keys ----------------------------------------------------


@_query
def wide_to_long_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_to_long(Source(spark, sf_dir).wide_sheet())


@_query
def wide_to_long_faulty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sheet with accented names and cells that hold something else: dates
    with trailing text, prices with a type suffix, words for numbers."""
    sheet = Source(spark, sf_dir).wide_sheet()
    month = F.month(F.col("c1").try_cast("date"))
    faulty = (
        sheet.withColumn("sheet", F.replace("sheet", F.lit("Sao "), F.lit("São ")))
        .withColumn("c18", F.when(month % 2 == 0, F.concat("c18", F.lit("D"))).otherwise(F.col("c18")))
        .withColumn("c7", F.when(month == 7, "Infinity").when(month == 8, "NaN").otherwise(F.col("c7")))
        .withColumn("c19", F.when(month == 9, F.concat(F.lit(" "), "c19", F.lit(" "))).otherwise(F.col("c19")))
        .withColumn(
            "c1",
            F.when(month == 3, F.concat("c1", F.lit(" total")))
            .when(month == 5, F.concat("c1", F.lit(" 00:00:00")))
            .when(month == 11, F.substring("c1", 1, 7))
            .otherwise(F.col("c1")),
        )
    )
    return wide_to_long(faulty)


@_query
def fold_key_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts folded; the fold is compared by digest and length."""
    folded = fold_key("text")
    return read(spark, sf_dir, "documents").select(
        "doc_id", F.md5(folded).alias("folded_md5"), F.length(folded).alias("folded_length")
    )


@_query
def fold_collation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of the texts joined under a collation that passes over case and
    accents: for each written form with a letter beyond ASCII, how many
    written forms there are that it equals, itself included."""
    letters = F.regexp_extract_all(F.col("text"), F.lit(r"(\p{L}+)"), F.lit(1))
    words = materialise(
        read(spark, sf_dir, "documents").select(F.explode(letters).alias("word")).distinct(), "words"
    )
    marked = words.filter(F.col("word").rlike(r"[^\x00-\x7F]")).select(F.col("word").alias("written"))
    return (
        collated_join(marked, words, "written", "word")
        .groupBy("written")
        .agg(F.count("*").alias("n_equal"), F.min("word").alias("first_form"))
    )


@_query
def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _date_dim(Source(spark, sf_dir))


@_query
def date_dim_incr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension after a second load, with the load that brought each date."""
    src = Source(spark, sf_dir)
    first = _date_dim(src.at(CUT))
    added = date_dimension(src.transvenda(), "transvendadata", first)
    return first.withColumn("carga", F.lit(0)).unionByName(added.withColumn("carga", F.lit(1)))


@_query
def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders numbered by date and key, after 1,000 keys in use."""
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    return assign_surrogate_keys(orders, "sk", ["o_orderdate", "o_orderkey"], start=1000).select(
        "o_orderkey", "sk"
    )


# --- dimensions ------------------------------------------------------------


@_query
def scd2_initial_broker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _broker_dim(Source(spark, sf_dir))


def _merged_brokers(spark: SparkSession, sf_dir: str, keys: DataFrame | None) -> DataFrame:
    src = Source(spark, sf_dir)
    t = {"corretor": src.corretor(), "funcionario": src.funcionario()}
    return scd2_merge(
        _broker_dim(src.at(CUT)),
        star.broker_source(t),
        star.BROKER,
        star.BROKER_ATTRS,
        TS1,
        keys,
    )


@_query
def scd2_merge_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brokers after a second load that compares every row."""
    return _merged_brokers(spark, sf_dir, None)


@_query
def scd2_merge_cdc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brokers after a second load that only sees keys named in the feed."""
    keys = changed_keys(event_feed(spark, sf_dir)).select(F.col("key").alias("cor_cpf"))
    return _merged_brokers(spark, sf_dir, keys)


@_query
def scd2_extend_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties given type, rooms and area, then loaded again after some
    areas changed."""
    src = Source(spark, sf_dir)
    early = src.at(CUT)
    dim = scd2_initial(star.item_source(early.tables()), star.ITEM, star.ITEM_ATTRS, TS0)
    dim = materialise(
        scd2_fill(dim, star.item_extra(early.tables()), star.ITEM, star.ITEM_EXTRA), "filled"
    )
    return scd2_extend(dim, star.item_extra(src.tables()), star.ITEM, star.ITEM_EXTRA, TS1)


@_query
def snowflake_property(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.item_source(Source(spark, sf_dir).tables())


@_query
def snowflake_property_early(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same before the first month's ads were all out: some have none."""
    return star.item_source(Source(spark, sf_dir, date(1995, 2, 1)).tables())


@_query
def scd1_insert_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second feed that may add months but leaves held ones alone."""
    src = Source(spark, sf_dir)
    first = _market_dim(src.at(MID_MONTH_CUT))
    stage = materialise(star.market_stage(wide_to_long(src.wide_sheet())), "stage")
    return star.load_market(first, stage, TS1, "insert_only")


@_query
def scd1_upsert_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second feed that adds months and revises the cut one."""
    src = Source(spark, sf_dir)
    first = _market_dim(src.at(MID_MONTH_CUT))
    stage = materialise(star.market_stage(wide_to_long(src.wide_sheet())), "stage")
    return star.load_market(first, stage, TS1, "upsert")


# --- facts -----------------------------------------------------------------


@_query
def participant_fact_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = Source(spark, sf_dir)
    return _participants(src, _dims(src))


@_query
def participant_fact_nn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sales with several properties: every property repeats the shares."""
    src = Source(spark, sf_dir)
    return _participants(src, _dims(src), many_items=True)


@_query
def participant_fact_incr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows added by a second load that is told of all sales."""
    src = Source(spark, sf_dir)
    dims = _dims(src)
    held = materialise(_participants(src.at(CUT), dims), "held")
    told = src.transvenda().select("transvendaid")
    return _participants(src, dims, new_sales=told, existing=held)


@_query
def sale_fact_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = Source(spark, sf_dir)
    t = src.tables()
    return sale_fact(t["transvenda"], t["imoveltransacao"], _dims(src))


@_query
def sale_fact_nn(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = Source(spark, sf_dir)
    t = src.tables(many_items=True)
    return sale_fact(t["transvenda"], t["imoveltransacao"], _dims(src))


def _sale_facts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, SaleDims]:
    """Facts of the first load and those the second adds."""
    src = Source(spark, sf_dir)
    t, early = src.tables(), src.at(CUT).tables()
    dims = _dims(src)
    first = assign_surrogate_keys(
        sale_fact(early["transvenda"], early["imoveltransacao"], dims), "tv_sk", ["tv_id"]
    )
    added = sale_fact(t["transvenda"], t["imoveltransacao"], dims, existing=first)
    return first, added, dims


@_query
def sale_fact_incr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sale_facts(spark, sf_dir)[1]


def _bridge(spark: SparkSession, sf_dir: str, role: str) -> DataFrame:
    src = Source(spark, sf_dir)
    t, dims = src.tables(), _dims(src)
    fact = assign_surrogate_keys(
        sale_fact(t["transvenda"], t["imoveltransacao"], dims), "tv_sk", ["tv_id"]
    )
    return bridge(fact, t[role], dims.client)


@_query
def bridge_buyers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bridge(spark, sf_dir, "clientecompra")


@_query
def bridge_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bridge(spark, sf_dir, "clientevende")


@_query
def bridge_incr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyer pairs a second load adds to those of the first."""
    first, added, dims = _sale_facts(spark, sf_dir)
    start = first.agg(F.max("tv_sk")).first()[0] or 0
    keyed = assign_surrogate_keys(added, "tv_sk", ["tv_id"], start=start)
    link = Source(spark, sf_dir).clientecompra()
    held = bridge(first, link, dims.client)
    return bridge(first.unionByName(keyed), link, dims.client, existing=held)


@_query
def aggregate_fact_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = Source(spark, sf_dir)
    t = src.tables()
    return aggregate_fact(t["transvenda"], t["imoveltransacao"], _item_dim(src), _date_dim(src))


def _aggregates(spark: SparkSession, sf_dir: str):
    """The first load's aggregate, holding sales up to the cut of which every
    commission was doubled, so that a recomputed row shows."""
    src = Source(spark, sf_dir)
    early = src.at(CUT)
    dim = _item_dim(src)
    doubled = early.transvenda().withColumn("transcomissao", F.col("transcomissao") * 2)
    agg = materialise(aggregate_fact(doubled, early.imoveltransacao(), dim), "held")
    return agg, src, dim


@_query
def restate_aggregate_touched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs touched by urgent sales and by all later sales are recomputed."""
    agg, src, dim = _aggregates(spark, sf_dir)
    news = (
        read(spark, sf_dir, "orders")
        .filter((F.col("o_orderdate") >= F.lit(CUT)) | (F.col("o_orderpriority") == "1-URGENT"))
        .select(F.col("o_orderkey").alias("transvendaid"))
    )
    return restate_aggregate(agg, news, src.transvenda(), src.imoveltransacao(), dim)


@_query
def append_aggregate_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The append variant keeps old totals and adds the new ones."""
    agg, src, dim = _aggregates(spark, sf_dir)
    fresh = aggregate_fact(src.transvenda(), src.imoveltransacao(), dim)
    return agg.unionByName(append_aggregate(agg, fresh))


# --- market ----------------------------------------------------------------


@_query
def unit_price_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = Source(spark, sf_dir)
    dims = _dims(src)
    t = src.tables()
    fact = sale_fact(t["transvenda"], t["imoveltransacao"], dims)
    return derive_unit_price(fact, dims.item).select("tv_id", "im_sk", "tv_valor", "tv_valor_m2")


@_query
def link_benchmark_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = Source(spark, sf_dir)
    (dims, market), t = _dims_and_market(src), src.tables()
    fact = sale_fact(t["transvenda"], t["imoveltransacao"], dims)
    return link_benchmark(fact, dims.item, market).select("tv_id", "im_sk", "mk_sk")


@_query
def sale_vs_market_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _view(Source(spark, sf_dir))[0]


def _measures(view: DataFrame, *by: str) -> DataFrame:
    return benchmark_measures(view, by)


@_query
def measures_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measures(_view(Source(spark, sf_dir))[0])


@_query
def measures_by_broker(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measures(_view(Source(spark, sf_dir))[0], "corretor")


@_query
def measures_by_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _measures(_view(Source(spark, sf_dir))[0], "im_cidade")


@_query
def measures_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """By the benchmark's month, as charts of the index need it."""
    view, market = _view(Source(spark, sf_dir))
    view = balanced_join(view, market.select("mk_sk", "mk_mes"), "mk_sk")
    return _measures(view, "mk_mes")


# --- checks ----------------------------------------------------------------


@_query
def reconcile_sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    src = Source(spark, sf_dir)
    dims, t = _dims(src), src.tables(many_items=True)
    fact = participant_fact(
        t["transvenda"], t["imoveltransacao"], t["clientecompra"], t["clientevende"], dims
    )
    sales = sale_fact(t["transvenda"], t["imoveltransacao"], dims)
    return reconcile(t["transvenda"], t["imoveltransacao"], fact, sales)


@_query
def reconcile_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and sums per role, taken while the fact is written, against the
    rows the source calls for."""
    src = Source(spark, sf_dir)
    t = src.tables(many_items=True)
    load = Lake(spark, fresh_path(spark, "lake")).begin()
    fact = _participants(src, _dims(src), many_items=True)
    taken = load.put(star.FACT, fact, **side_measures(BUYER), **side_measures(SELLER))
    load.commit()
    links = {BUYER: t["clientecompra"], SELLER: t["clientevende"]}
    return reconcile_counts(t["transvenda"], t["imoveltransacao"], links, taken)


@_query
def coverage_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coverage(_view(Source(spark, sf_dir))[0])


@_query
def constraint_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = {n: read(spark, sf_dir, n) for n in ("lineitem", "orders", "part", "supplier")}
    lines = Rules(
        not_null=["l_orderkey", "l_shipdate"],
        unique=[["l_orderkey", "l_linenumber"]],
        foreign_keys={
            "lineitem_orders": ForeignKey(["l_orderkey"], t["orders"], ["o_orderkey"]),
            "lineitem_part": ForeignKey(["l_partkey"], t["part"], ["p_partkey"]),
            "lineitem_supplier": ForeignKey(["l_suppkey"], t["supplier"], ["s_suppkey"]),
        },
        domains={"l_returnflag": ["A", "N"], "l_linestatus": ["O", "F"]},
        max_lengths={"l_returnflag": 1},
    )
    return check_constraints(t["lineitem"], lines)


@_query
def version_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker histories after a second load, with planted faults: some closed
    versions end too late, some too early, some current ones lost their flag."""
    dim = _merged_brokers(spark, sf_dir, None)
    number = F.col("cor_cpf").cast("long") % 10
    moved = (
        F.when((number == 3) & ~F.col("cor_is_atual"), F.col("cor_dt_fim") + F.expr("INTERVAL 1 DAY"))
        .when((number == 4) & ~F.col("cor_is_atual"), F.col("cor_dt_fim") - F.expr("INTERVAL 1 DAY"))
        .otherwise(F.col("cor_dt_fim"))
    )
    flag = F.when(number == 5, F.lit(False)).otherwise(F.col("cor_is_atual"))
    planted = dim.withColumn("cor_dt_fim", moved).withColumn("cor_is_atual", flag)
    n = star.BROKER
    return check_versions(planted, VersionRules(n.nk, n.sk, n.valid_from, n.valid_to, n.is_current), "cor_cpf")


@_query
def source_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared rules of the source, with planted faults: clients with a
    number divisible by 7 are gone, brokers divisible by 9 come twice, and
    sales of numbers divisible by 11 name a broker nobody knows."""
    t = dict(Source(spark, sf_dir).tables())
    t["cliente"] = t["cliente"].filter(F.col("clientecpf").cast("long") % 7 != 0)
    t["corretor"] = t["corretor"].unionByName(t["corretor"].filter(F.col("funccpf").cast("long") % 9 == 0))
    unknown = F.when(F.col("transvendaid") % 11 == 0, "x").otherwise(F.col("funccpf"))
    t["transvenda"] = t["transvenda"].withColumn("funccpf", unknown)
    return rules.source_report(t).filter("violations > 0")


@_query
def star_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The declared rules of a star after two loads: every rule and its
    violations, with planted faults in the fact."""
    src = Source(spark, sf_dir)
    lake = Lake(spark, fresh_path(spark, "lake"))
    first = src.at(CUT)
    star.load_initial(lake, first.tables(), wide_to_long(first.wide_sheet()), TS0)
    star.load_incremental(lake, src.tables(), wide_to_long(src.wide_sheet()), TS1)
    t = {n: lake.table(n) for n in lake.tables()}
    sale = F.col("tv_id")
    t[star.FACT] = (
        t[star.FACT]
        .withColumn("tv_tipo_cliente", F.when(sale % 10 == 0, "OUTRO").otherwise(F.col("tv_tipo_cliente")))
        .withColumn("dt_sk", F.when(sale % 13 == 0, 0).otherwise(F.col("dt_sk")))
    )
    return rules.star_report(t).select("table_name", "rule", "subject", "violations")


# --- change feed -----------------------------------------------------------


@_query
def feed_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_change(event_feed(spark, sf_dir), ["entity", "key"], ["tstamp", "seq"])


@_query
def feed_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed consumed as a stream of files; each micro-batch appends its
    distinct keys, and the batches together name the batch run's keys."""
    feed_dir, out = fresh_path(spark, "feed"), fresh_path(spark, "feed-keys")
    event_feed(spark, sf_dir).repartitionByRange(4, "seq").write.parquet(feed_dir)
    def note(batch: DataFrame, batch_id: int) -> None:
        path = f"{out}/batch={batch_id}"
        changed_keys(batch).write.mode("overwrite").parquet(path)

    consume_feed(
        read_feed(spark, feed_dir, files_per_batch=1), fresh_path(spark, "offsets"), note, "keys"
    ).awaitTermination()
    return spark.read.parquet(out).select("entity", "key").distinct()


@_query
def feed_merge_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker dimension kept up to date by the stream, one commit per batch;
    ends where the batch run over all changed keys ends."""
    feed_dir = fresh_path(spark, "feed")
    event_feed(spark, sf_dir).repartitionByRange(2, "seq").write.parquet(feed_dir)
    lake = Lake(spark, fresh_path(spark, "lake"))
    last = Source(spark, sf_dir)
    first = last.at(CUT)
    star.load_initial(lake, first.tables(), wide_to_long(first.wide_sheet()), TS0)
    follow_feed(
        lake,
        read_feed(spark, feed_dir, files_per_batch=1),
        fresh_path(spark, "offsets"),
        tables=last.tables,
        market=lambda: None,
        now=lambda: TS1,
    ).awaitTermination()
    dim = lake.table("corretor_dimension")
    return dim.select("cor_cpf", "cor_registro", "cor_nome", "cor_sobrenome", "cor_is_atual")


# --- a feed out of order ----------------------------------------------------


def _agency(src: Source, early: bool) -> dict[str, DataFrame]:
    """The source before the cut or now. Before, some clients were not there
    yet, some had another name, and only the sales up to then had links."""
    t = dict((src.at(CUT) if early else src).tables())
    if early:
        number = F.col("clientecpf").cast("long")
        t["cliente"] = (
            t["cliente"]
            .filter(number % 7 != 0)
            .withColumn(
                "clienteprimnome",
                F.when(number % 5 == 0, F.upper("clienteprimnome")).otherwise(F.col("clienteprimnome")),
            )
        )
        # landed once, like the links they are drawn from: a load reads them many times
        for link in ("clientecompra", "clientevende"):
            known = balanced_join(t[link], t["transvenda"].select("transvendaid"), "transvendaid", "left_semi")
            t[link] = materialise(known, link)
    return t


@_query
def feed_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed between two landed states of the source."""
    src = Source(spark, sf_dir)
    states = []
    for early in (True, False):
        tables, out = _agency(src, early), fresh_path(spark, "bronze")
        land_snapshot(tables, out)
        states.append({n: read_landed(spark, f"{out}/{n}", df.schema) for n, df in tables.items()})
    return feed_from_snapshots(*states, TS1).select("seq", "entity", "key", "action")


SALE_ENTITIES = ("transvenda", "clientecompra", "clientevende")


def _out_of_order(spark: SparkSession, sf_dir: str, batches: int) -> Lake:
    """A first load, then a batch that names sales whose brokers and clients
    have not arrived, then one that names everybody else."""
    src = Source(spark, sf_dir)
    before, now = _agency(src, True), _agency(src, False)
    feed = materialise(feed_from_snapshots(before, now, TS1), "feed")
    ahead = F.col("entity").isin(*SALE_ENTITIES)
    lake = Lake(spark, fresh_path(spark, "lake"))
    star.load_initial(lake, before, wide_to_long(src.at(CUT).wide_sheet()), TS0)
    half = {**before, **{n: now[n] for n in (*SALE_ENTITIES, "imoveltransacao")}}
    for tables, named in ((half, ahead), (now, ~ahead))[:batches]:
        star.load_incremental(lake, tables, None, TS1, changed_keys(feed.filter(named)))
    return lake


def _natural_fact(lake: Lake) -> DataFrame:
    fact = lake.table(star.FACT)
    for dim, sk, nk in (
        ("corretor_dimension", "cor_sk", "cor_cpf"),
        ("imovel_dimension", "im_sk", "im_id"),
        ("cliente_dimension", "cl_sk", "cl_cpf"),
    ):
        fact = balanced_join(fact, lake.table(dim).select(sk, nk), sk)
    return fact.select(
        "tv_id", "cor_cpf", "im_id", "cl_cpf", "dt_sk", "tv_tipo_cliente", "tv_valor", "tv_valor_cliente",
        "tv_comissao_cliente", "tv_total_compradores", "tv_total_vendedores",
    )


@_query
def feed_parked_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What waits after the first batch, and for what."""
    return _out_of_order(spark, sf_dir, 1).table(star.PARKED).select("transvendaid", "missing")


@_query
def feed_aggregate_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The aggregate after the first batch: only of sales the fact holds."""
    lake = _out_of_order(spark, sf_dir, 1)
    items = lake.table("imovel_dimension").select("im_sk", "im_id")
    agg = balanced_join(lake.table(star.AGGREGATE), items, "im_sk")
    return agg.select("im_id", "dt_sk", "ra_comissao_total")


@_query
def feed_out_of_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after both batches: what one load of the final state gives."""
    return _natural_fact(_out_of_order(spark, sf_dir, 2))


@_query
def participant_fact_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buyers and sellers written after their sale's load replace its rows."""
    src = Source(spark, sf_dir)
    now = dict(src.tables())
    before = dict(now)
    for link in ("clientecompra", "clientevende"):
        last = now[link].groupBy("transvendaid").agg(
            F.max("clientecpf").alias("clientecpf"), F.count("*").alias("n")
        )
        late = last.filter("n > 1").drop("n")
        # landed once: the feed and the first load read it many times
        before[link] = materialise(balanced_join(now[link], late, ["transvendaid", "clientecpf"], "left_anti"), link)
    feed = feed_from_snapshots(before, now, TS1)
    lake = Lake(spark, fresh_path(spark, "lake"))
    star.load_initial(lake, before, wide_to_long(src.wide_sheet()), TS0)
    star.load_incremental(lake, now, None, TS1, changed_keys(feed))
    return _natural_fact(lake)


# --- whole loads -----------------------------------------------------------


def _natural(lake: Lake) -> dict[str, DataFrame]:
    """Current slices by natural key, free of surrogate keys and load times."""
    brokers = lake.table("corretor_dimension")
    items = lake.table("imovel_dimension")
    clients = lake.table("cliente_dimension")
    market = lake.table(MARKET_TABLE)
    fact = lake.table("trans_venda_fact")
    for dim, sk, nk in (
        (brokers, "cor_sk", "cor_cpf"),
        (items, "im_sk", "im_id"),
        (clients, "cl_sk", "cl_cpf"),
    ):
        fact = balanced_join(fact, dim.select(sk, nk), sk)
    agg = balanced_join(
        lake.table("receita_agregada_fact"), items.select("im_sk", "im_id"), "im_sk"
    )
    return {
        "corretor_dimension": brokers.filter("cor_is_atual").select("cor_cpf", *star.BROKER_ATTRS),
        "cliente_dimension": clients.filter("cl_is_atual").select("cl_cpf", *star.CLIENT_ATTRS),
        "imovel_dimension": items.filter("im_is_atual").select(
            "im_id", *star.ITEM_ATTRS, *star.ITEM_EXTRA
        ),
        "data_dimension": lake.table("data_dimension").select("dt_sk", "dt_dia_semana"),
        MARKET_TABLE: market.select(*star.MARKET_KEY, "mk_preco_m2"),
        "trans_venda_fact": fact.select(
            "tv_id",
            "cor_cpf",
            "im_id",
            "cl_cpf",
            "dt_sk",
            "tv_tipo_cliente",
            "tv_valor_cliente",
            "tv_comissao_cliente",
        ),
        "receita_agregada_fact": agg.groupBy("im_id", "dt_sk").agg(
            F.sum(F.col("ra_comissao_total").cast("decimal(18,4)")).alias("total")
        ),
    }


@_query
def pipeline_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze files and sheet files to gold, run at the cut and once more at
    the end; the published view is read back."""
    src = Source(spark, sf_dir)
    root = fresh_path(spark, "warehouse")
    paths = Paths(*(f"{root}/{part}" for part in ("bronze", "sheets", "silver", "offsets", "gold")))
    lake = Lake(spark, f"{root}/lake")
    for state, ts in ((src.at(CUT), TS0), (src, TS1)):
        tables = state.tables()
        land_snapshot(tables, paths.bronze, fmt="csv")
        sheet = state.wide_sheet()
        cells = [
            F.col(c) if c in sheet.columns else F.lit(None).cast("string").alias(c)
            for c in ("sheet", *(f"c{i}" for i in range(22)))
        ]
        sheet.select(*cells).write.mode("append").option("header", True).csv(paths.sheets)
        pipeline.run(lake, paths, {n: df.schema for n, df in tables.items()}, ts)
    view = "vw_venda_vs_mercado"
    back = read_landed(spark, f"{paths.gold}/{view}", star.star_view(lake).schema, fmt="csv")
    return back.select(
        "tv_id", "dt_data_completa", "corretor", "im_cidade", "im_estado", "im_bairro", "im_tipo", "im_qtd_quartos",
        "tv_total_compradores", "tv_total_vendedores", "tv_valor", "tv_comissao", "mk_preco_m2", "mk_var_12m",
    )


@_query
def bridge_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The bridge model after a first and a second load: who took part in
    which sale, by natural keys."""
    src = Source(spark, sf_dir)
    lake = Lake(spark, fresh_path(spark, "lake"))
    star.load_bridge_initial(lake, src.at(CUT).tables(), TS0)
    star.load_bridge_incremental(lake, src.tables(), TS1)
    sales = lake.table(star.FACT).select("tv_sk", "tv_id", "tv_valor")
    clients = lake.table("cliente_dimension").select("cl_sk", "cl_cpf")
    pairs = None
    for table, role in (("comprador_ponte", "COMPRADOR"), ("vendedor_ponte", "VENDEDOR")):
        found = lake.table(table).withColumn("papel", F.lit(role))
        pairs = found if pairs is None else pairs.unionByName(found)
    named = balanced_join(balanced_join(pairs, sales, "tv_sk"), clients, "cl_sk")
    return named.select("tv_id", "tv_valor", "papel", "cl_cpf")


@_query
def scd1_upsert_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market after a feed of the cut month and later ones, of which only
    their parts are read and written."""
    src = Source(spark, sf_dir)
    lake = Lake(spark, fresh_path(spark, "lake"))
    for state, since, ts in ((src.at(MID_MONTH_CUT), date(1900, 1, 1), TS0), (src, CUT, TS1)):
        load = lake.begin()
        news = wide_to_long(state.wide_sheet()).filter(F.col("mes") >= F.lit(since))
        star.put_market(load, news, ts)
        load.commit()
    return lake.table(MARKET_TABLE).select(*_market_dim_columns())


def _market_dim_columns() -> list[str]:
    return ["mk_sk", "mk_cidade", *star.MARKET_KEY, "mk_preco_m2", "mk_var_mensal", "mk_var_12m", "mk_dt_carga"]


@_query
def pipeline_equivalence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load plus an incremental one against a single load of the final
    state: rows of each current slice, and how many differ."""
    last = Source(spark, sf_dir)
    first = last.at(CUT)
    steps, once = (Lake(spark, fresh_path(spark, "lake")) for _ in range(2))

    def by_steps() -> None:
        star.load_initial(steps, first.tables(), wide_to_long(first.wide_sheet()), TS0)
        star.load_incremental(steps, last.tables(), wide_to_long(last.wide_sheet()), TS1)

    # neither lake knows of the other
    together(
        spark, by_steps, lambda: star.load_initial(once, last.tables(), wide_to_long(last.wide_sheet()), TS1)
    )
    there, here = _natural(once), _natural(steps)
    names = sorted(there)
    reports = together(spark, *(partial(differing_rows, there[name], here[name]) for name in names))
    return reduce(
        DataFrame.unionByName,
        [
            report.select(F.lit(name).alias("table_name"), "n_rows", "n_differing")
            for name, report in zip(names, reports)
        ],
    )
