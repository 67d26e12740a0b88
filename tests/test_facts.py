from datetime import date

import pytest
from conftest import T0, frame, rows
from pyspark.sql import functions as F

from dimwright.operators.dates import date_dimension
from dimwright.operators.facts import (
    SaleDims,
    aggregate_fact,
    append_aggregate,
    bridge,
    derive_unit_price,
    first_per_key,
    participant_fact,
    replace_sales,
    restate_aggregate,
    sale_fact,
    unresolved_sales,
)
from dimwright.operators.quality import reconcile
from dimwright.operators.scd2 import scd2_fill, scd2_initial, scd2_merge
from dimwright.operators.surrogate import assign_surrogate_keys
from dimwright.plans import star


@pytest.fixture(scope="module")
def dims(agency):
    item = scd2_initial(star.item_source(agency), star.ITEM, star.ITEM_ATTRS, T0)
    return SaleDims(
        scd2_initial(star.broker_source(agency), star.BROKER, star.BROKER_ATTRS, T0),
        scd2_fill(item, star.item_extra(agency), star.ITEM, star.ITEM_EXTRA),
        scd2_initial(star.client_source(agency), star.CLIENT, star.CLIENT_ATTRS, T0),
        date_dimension(agency["transvenda"], "transvendadata"),
    )


def build(t, dims, **more):
    return participant_fact(
        t["transvenda"], t["imoveltransacao"], t["clientecompra"], t["clientevende"], dims, **more
    )


def test_date_dimension(agency, dims):
    dates = frame(agency["uf"].sparkSession, [(date(2025, 6, 15),), (date(2025, 6, 15),), (None,)], "d date")
    assert rows(date_dimension(dates, "d")) == [(20250615, date(2025, 6, 15), 0, 15, 6, 2025, 2)]
    assert dims.date.count() == 3
    assert date_dimension(agency["transvenda"], "transvendadata", dims.date).count() == 0


def test_snowflake_fills_missing_ads(agency):
    got = rows(star.item_source(agency), "im_id", "im_cidade", "im_estado", "im_num_anuncios", "im_gasto_em_anuncios")
    assert got == [
        (2, "Rio de Janeiro", "Rio de Janeiro", 1, 10.0),
        (25, "Vitória", "Espírito Santo", 2, 150.5),
        (9, "Vitória", "Espírito Santo", 0, 0.0),
    ]


def check_shares(fact):
    got = rows(
        fact.filter("tv_id in (1, 11)"),
        "tv_id",
        "tv_tipo_cliente",
        "tv_valor",
        "tv_valor_cliente",
        "tv_total_compradores",
        "tv_total_vendedores",
        "dt_sk",
    )
    assert got == [
        (1, "COMPRADOR", 722655.0, 361327.5, 2, 1, 20250301),
        (1, "COMPRADOR", 722655.0, 361327.5, 2, 1, 20250301),
        (1, "VENDEDOR", 722655.0, 722655.0, 2, 1, 20250301),
        (11, "COMPRADOR", 942104.83, 942104.83, 1, 2, 20250420),
        (11, "VENDEDOR", 942104.83, 471052.415, 1, 2, 20250420),
        (11, "VENDEDOR", 942104.83, 471052.415, 1, 2, 20250420),
    ]
    assert fact.count() == 12


def test_participant_fact_shares(agency, dims):
    check_shares(build(agency, dims))


def test_participant_fact_on_shuffled_path(shuffled, agency, dims):
    check_shares(build(agency, dims))


def test_one_sided_sale_has_rows_of_that_side(spark, agency, dims):
    t = dict(agency, clientevende=agency["clientevende"].filter("transvendaid <> 1"))
    assert rows(build(t, dims).filter("tv_id = 1"), "tv_tipo_cliente", "tv_total_vendedores") == [
        ("COMPRADOR", 0),
        ("COMPRADOR", 0),
    ]


def test_incremental_adds_only_new_rows_and_only_named_sales(spark, agency, dims):
    held = build(dict(agency, transvenda=agency["transvenda"].filter("transvendaid = 1")), dims)
    told = frame(spark, [(1,), (11,), (11,)], "transvendaid int")
    added = build(agency, dims, new_sales=told, existing=held)
    assert rows(added.groupBy("tv_id").count()) == [(11, 3)]


def test_late_participant_replaces_the_rows_of_its_sale(spark, agency, dims):
    early = dict(agency, clientecompra=agency["clientecompra"].filter("clientecpf <> '00000000101'"))
    held = build(early, dims)
    told = frame(spark, [(1,), (11,)], "transvendaid int")
    added = build(agency, dims, new_sales=told, existing=held)
    # sale 11 is as it was, sale 1 comes whole with new shares
    assert rows(added, "tv_id", "tv_tipo_cliente", "tv_valor_cliente", "tv_total_compradores") == [
        (1, "COMPRADOR", 361327.5, 2),
        (1, "COMPRADOR", 361327.5, 2),
        (1, "VENDEDOR", 722655.0, 2),
    ]
    whole = build(agency, dims)
    assert rows(replace_sales(held, added).select(whole.columns)) == rows(whole)


def test_unresolved_sales_name_what_is_missing(spark, agency, dims):
    lost = dict(
        agency,
        transvenda=agency["transvenda"].filter("transvendaid <> 11").unionByName(
            frame(
                spark,
                [(30, 1.0, None, 1.0, "00000000099"), (31, 1.0, None, 1.0, None), (32, 1.0, None, 1.0, "00000000011")],
                agency["transvenda"].schema,
            )
        ),
        imoveltransacao=agency["imoveltransacao"].unionByName(
            frame(spark, [(77, 30), (2, 30), (2, 31)], agency["imoveltransacao"].schema)
        ),
        clientecompra=agency["clientecompra"].unionByName(
            frame(spark, [(30, "00000000100"), (31, "nobody")], agency["clientecompra"].schema)
        ),
    )
    ids = frame(spark, [(1,), (1,), (11,), (30,), (31,), (32,)], "transvendaid int")
    found = unresolved_sales(
        ids, lost["transvenda"], lost["imoveltransacao"], lost["clientecompra"], lost["clientevende"], dims
    )
    assert rows(found) == [(11, "sale"), (30, "broker,item"), (31, "broker,client"), (32, "items,participants")]
    none = unresolved_sales(
        ids.limit(0), lost["transvenda"], lost["imoveltransacao"], lost["clientecompra"], lost["clientevende"], dims
    )
    assert none.count() == 0


def test_sale_fact_and_bridges(spark, agency, dims):
    fact = assign_surrogate_keys(
        sale_fact(agency["transvenda"], agency["imoveltransacao"], dims), "tv_sk", ["tv_id"]
    )
    assert rows(fact, "tv_sk", "tv_id", "tv_valor") == [
        (1, 1, 722655.0),
        (2, 11, 942104.83),
        (3, 25, 1365126.21),
        (4, 26, 1365126.21),
    ]
    assert sale_fact(agency["transvenda"], agency["imoveltransacao"], dims, existing=fact).count() == 0
    buyers = bridge(fact, agency["clientecompra"], dims.client)
    assert buyers.count() == 7
    assert bridge(fact, agency["clientecompra"], dims.client, existing=buyers).count() == 0
    # a renamed client's old sales get a second pair
    renamed = agency["cliente"].withColumn(
        "cliultimonome", F.when(F.col("clientecpf") == "00000000100", "Nova").otherwise(F.col("cliultimonome"))
    )
    clients = scd2_merge(
        dims.client, star.client_source({"cliente": renamed}), star.CLIENT, star.CLIENT_ATTRS, T0
    )
    assert rows(bridge(fact, agency["clientecompra"], clients, existing=buyers)) == [(1, 9)]


def test_aggregate_adds_up_two_sales_of_a_day(agency, dims):
    agg = aggregate_fact(agency["transvenda"], agency["imoveltransacao"], dims.item, dims.date)
    totals = {r["dt_sk"]: r["ra_comissao_total"] for r in agg.collect()}
    assert len(totals) == 3 and totals[20250715] == pytest.approx(163815.14)


def sale_day(agg):
    return rows(agg, "dt_sk", F.round("ra_comissao_total", 2))


@pytest.mark.parametrize("path", ["small", "large"])
def test_restate_recomputes_only_touched_pairs(request, spark, agency, dims, path):
    if path == "large":
        request.getfixturevalue("shuffled")
    before = agency["transvenda"].filter("transvendaid <> 26")
    agg = aggregate_fact(before, agency["imoveltransacao"], dims.item, dims.date).withColumn(
        "ra_comissao_total", F.col("ra_comissao_total") + 1  # shows what was kept
    )
    told = frame(spark, [(26,)], "transvendaid int")
    got = restate_aggregate(agg, told, agency["transvenda"], agency["imoveltransacao"], dims.item, dims.date)
    assert sale_day(got) == [(20250301, 43360.3), (20250420, 56527.29), (20250715, 163815.14)]


def test_append_keeps_the_old_total(spark, agency, dims):
    before = agency["transvenda"].filter("transvendaid <> 26")
    agg = aggregate_fact(before, agency["imoveltransacao"], dims.item, dims.date)
    fresh = aggregate_fact(agency["transvenda"], agency["imoveltransacao"], dims.item, dims.date)
    assert sale_day(append_aggregate(agg, fresh)) == [(20250715, 163815.14)]


def test_unit_price_only_where_missing(spark, agency, dims):
    fact = sale_fact(agency["transvenda"], agency["imoveltransacao"], dims).withColumn(
        "tv_valor_m2", F.when(F.col("tv_id") == 11, 5.0)
    )
    assert rows(derive_unit_price(fact, dims.item), "tv_id", "tv_valor_m2") == [
        (1, 15375.63829787234),
        (11, 5.0),
        (25, 2886.1019238900635),
        (26, 2886.1019238900635),
    ]


def test_first_per_key(spark):
    df = frame(spark, [(1, 5, None), (1, 3, "b"), (1, 2, None), (2, 9, "c")], "k int, o int, v string")
    assert rows(first_per_key(df, "k", "o", ["v"])) == [(1, None), (2, "c")]


def test_reconcile_sides_and_item_factor(spark, agency, dims):
    fact = build(agency, dims)
    whole = sale_fact(agency["transvenda"], agency["imoveltransacao"], dims)
    got = {r["medida"]: r for r in reconcile(agency["transvenda"], agency["imoveltransacao"], fact, whole).collect()}
    v = got["valor"]
    assert v["origem"] == v["compradores"] == v["vendedores"] == v["fato"] == 4395012.25
    assert v["fator_itens"] == 1.0
    both = agency["imoveltransacao"].union(frame(spark, [(2, 1)], "imovelid int, transvendaid int"))
    t = dict(agency, imoveltransacao=both)
    twice = {r["medida"]: r for r in reconcile(t["transvenda"], both, build(t, dims)).collect()}
    assert twice["valor"]["compradores"] == twice["valor"]["origem_itens"] == 5117667.25
    assert twice["valor"]["fator_itens"] > 1


def test_facts_with_one_sale_holding_most_rows(shuffled, dims):
    """A sale with a third of all participants and items goes the salted way."""
    spark = shuffled
    sale = spark.range(60).select(
        F.col("id").cast("int").alias("transvendaid"),
        F.lit(100.0).alias("transvendavalor"),
        F.lit(date(2025, 3, 1)).alias("transvendadata"),
        F.lit(6.0).alias("transcomissao"),
        F.lit("00000000011").alias("funccpf"),
    )
    link = spark.range(240).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 60).cast("int").alias("transvendaid"),
        F.format_string("0000000010%d", (F.col("id") % 8).cast("int")).alias("clientecpf"),
    )
    items = sale.select(F.lit(9).alias("imovelid"), "transvendaid")
    fact = participant_fact(sale, items, link, link, dims)
    assert fact.count() == 480
    total = fact.filter("tv_tipo_cliente = 'VENDEDOR'").agg(F.sum("tv_valor_cliente")).first()[0]
    assert total == pytest.approx(100.0 * link.select("transvendaid").distinct().count())
