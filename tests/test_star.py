from datetime import date

import pytest
from conftest import T0, T1, T2, frame, rows
from pyspark.sql import functions as F

from dimwright.plans import pipeline, star
from dimwright.plans.pipeline import Paths
from dimwright.session import fresh_path
from dimwright.sources.lake import MARKET_TABLE, land_snapshot, read_landed
from dimwright.sources.versions import Lake
from dimwright.streaming.feed import (
    FEED_SCHEMA,
    changed_keys,
    feed_from_snapshots,
    follow_feed,
    read_feed,
    snapshot_changes,
)


def loaded(spark, agency, index):
    lake = Lake(spark, fresh_path(spark, "lake"))
    star.load_initial(lake, agency, index, T0)
    return lake


def early(agency):
    """Before the last sale, with one broker and two areas yet to change."""
    return dict(
        agency,
        transvenda=agency["transvenda"].filter("transvendaid <> 26"),
        corretor=agency["corretor"].withColumn(
            "corretorregistro",
            F.when(F.col("funccpf") == "00000000012", "old").otherwise(F.col("corretorregistro")),
        ),
        imovel=agency["imovel"].withColumn(
            "imovelm2", F.when(F.col("imovelid") == 9, 400).otherwise(F.col("imovelm2"))
        ),
    )


def test_initial_load_and_view(spark, agency, index):
    lake = loaded(spark, agency, index)
    assert lake.version() == 1
    assert rows(star.star_view(lake), "tv_id", "corretor", "im_cidade", "mk_preco_m2", "agio_vs_mercado") == [
        (1, "Ana Lima", "Vitória", 13001.78, 0.18257948510683453),
        (11, "Bia Melo", "Rio de Janeiro", 10366.81, -0.11769880658066878),
        (25, "Bia Melo", "Vitória", None, None),
        (26, "Caio Nunes", "Vitória", None, None),
    ]
    gold = star.gold_tables(lake)
    assert {n: df.count() for n, df in gold.items()} == {
        "corretor_dimension": 3,
        "cliente_dimension": 8,
        "imovel_dimension": 3,
        "data_dimension": 3,
        "trans_venda_fact": 12,
        "receita_agregada_fact": 3,
        MARKET_TABLE: 4,
        "vw_venda_vs_mercado": 4,
    }


def test_incremental_twice_is_incremental_once(spark, agency, index):
    lake = loaded(spark, early(agency), index)
    star.load_incremental(lake, agency, index, T1)
    once = {n: rows(lake.table(n).select(sorted(lake.table(n).columns))) for n in lake.tables()}
    star.load_incremental(lake, agency, index, T2)
    assert {n: rows(lake.table(n).select(sorted(lake.table(n).columns))) for n in lake.tables()} == once

    assert rows(lake.table("corretor_dimension"), "cor_sk", "cor_registro", "cor_is_atual") == [
        (1, "R-11", True),
        (2, "old", False),
        (3, "R-13", True),
        (4, "R-12", True),
    ]
    # facts keep the version they were bound to, the new sale takes the new one
    fact = lake.table("trans_venda_fact")
    assert fact.count() == 12 and fact.select("tv_sk").distinct().count() == 12
    areas = {r["im_sk"]: r["im_m2"] for r in lake.table("imovel_dimension").collect()}
    priced = fact.filter("tv_id in (25, 26)").select("tv_id", "im_sk", "tv_valor_m2").distinct()
    # the item's area changed only after the sale was bound in this load
    got = {r["tv_id"]: (areas[r["im_sk"]], r["tv_valor_m2"]) for r in priced.collect()}
    assert got[25][0] == 400 and got[25][1] == 1365126.21 / 400
    assert got[26][1] == 1365126.21 / got[26][0]


def test_incremental_reaches_the_final_state(spark, agency, index):
    steps = loaded(spark, early(agency), index)
    star.load_incremental(steps, agency, index, T1)
    once = loaded(spark, agency, index)

    def current(lake, name, flag, *columns):
        return rows(lake.table(name).filter(flag), *columns)

    for name, flag, columns in (
        ("corretor_dimension", "cor_is_atual", ["cor_cpf", *star.BROKER_ATTRS]),
        ("cliente_dimension", "cl_is_atual", ["cl_cpf", *star.CLIENT_ATTRS]),
        ("imovel_dimension", "im_is_atual", ["im_id", *star.ITEM_ATTRS, *star.ITEM_EXTRA]),
    ):
        assert current(steps, name, flag, *columns) == current(once, name, flag, *columns)
    shares = ["tv_id", "tv_tipo_cliente", "tv_valor_cliente", "tv_comissao_cliente", "dt_sk"]
    assert rows(steps.table("trans_venda_fact"), *shares) == rows(once.table("trans_venda_fact"), *shares)


def test_open_sales_are_retried_when_the_index_arrives(spark, agency, index):
    lake = loaded(spark, agency, index.filter("mes < '2025-04-01'"))
    linked = lambda: rows(lake.table("trans_venda_fact").filter("mk_sk is not null"), "tv_id")
    assert set(linked()) == {(1,)}
    fact = lake.begin().state["trans_venda_fact"].parts
    done = {k: v for k, v in fact.items() if k.startswith("done")}
    star.load_incremental(lake, agency, index, T1)
    assert set(linked()) == {(1,), (11,)}
    now = lake.begin().state["trans_venda_fact"].parts
    assert done.items() <= now.items()  # settled rows were not rewritten


def test_revised_index_keeps_links(spark, agency, index):
    lake = loaded(spark, agency, index)
    revised = index.withColumn("preco_m2", F.col("preco_m2") * 2)
    star.load_incremental(lake, agency, revised, T1)
    assert rows(star.star_view(lake).filter("tv_id = 1"), "mk_preco_m2") == [(26003.56,)]
    assert rows(lake.table(MARKET_TABLE), "mk_sk") == [(1,), (2,), (3,), (4,)]


def test_bridge_model(spark, agency):
    lake = Lake(spark, fresh_path(spark, "lake"))
    star.load_bridge_initial(lake, early(agency), T0)
    star.load_bridge_incremental(lake, agency, T1)
    first = {n: lake.table(n).count() for n in lake.tables()}
    star.load_bridge_incremental(lake, agency, T2)
    assert {n: lake.table(n).count() for n in lake.tables()} == first
    assert rows(lake.table("trans_venda_fact"), "tv_id") == [(1,), (11,), (25,), (26,)]
    assert lake.table("comprador_ponte").count() == 7 and lake.table("vendedor_ponte").count() == 5
    # the new version of a property brings its past days back, beside the old
    assert lake.table("receita_agregada_fact").count() > 3


def feed_file(spark, path, changes, start=1):
    data = [(start + i, e, k, a, T1) for i, (e, k, a) in enumerate(changes)]
    frame(spark, data, FEED_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_changed_keys(spark):
    data = [
        (1, "funcionario", "1", "U", T1),
        (2, "corretor", "1", "U", T1),
        (3, "anuncio", "7", "I", T1),
        (4, "anuncio", "8", "U", T1),  # an edited ad marks nothing
        (5, "transvenda", "9", "I", T1),
        (6, "transvenda", "10", "U", T1),  # sales are not edited
        (7, "clientecompra", "9", "I", T1),
        (8, "regiao", "3", "U", T1),
    ]
    feed = frame(spark, data, FEED_SCHEMA)
    assert rows(changed_keys(feed)) == [("corretor", "1"), ("imovel", "7"), ("transvenda", "9")]
    late = frame(spark, [(1, "clientecompra", "5", "I", T1)], FEED_SCHEMA)
    assert rows(changed_keys(late)) == [("transvenda", "5")]
    assert rows(changed_keys(late, late_participants=False)) == []


def test_stream_equals_batch_and_replays_change_nothing(spark, agency, index):
    lake = loaded(spark, early(agency), index)
    path, offsets = fresh_path(spark, "feed"), fresh_path(spark, "offsets")
    feed_file(spark, path, [("corretor", "00000000012", "U"), ("funcionario", "00000000012", "U")])
    feed_file(spark, path, [("transvenda", "26", "I"), ("imovel", "9", "U")], start=3)

    def run(checkpoint):
        follow_feed(
            lake,
            read_feed(spark, path, files_per_batch=1),
            checkpoint,
            tables=lambda: agency,
            market=lambda: None,
            now=lambda: T1,
        ).awaitTermination()

    run(offsets)
    assert lake.version() == 3  # a commit per micro-batch
    batch = loaded(spark, early(agency), index)
    star.load_incremental(batch, agency, None, T1)
    for name in ("corretor_dimension", "trans_venda_fact", "receita_agregada_fact"):
        drop = [c for c in lake.table(name).columns if c.endswith("_sk") and c != "dt_sk"]
        a, b = (x.table(name).drop(*drop) for x in (lake, batch))
        assert rows(a.select(sorted(a.columns))) == rows(b.select(sorted(b.columns)))

    run(offsets)
    assert lake.version() == 3
    # offsets lost: the same batches come again and are known by their ids
    run(fresh_path(spark, "offsets"))
    assert lake.version() == 3


def test_batch_without_sales_leaves_the_facts_alone(spark, agency, index):
    lake = loaded(spark, early(agency), index)
    before = lake.begin().state
    changes = frame(spark, [("corretor", "00000000012")], "entity string, key string")
    star.load_incremental(lake, agency, None, T1, changes, batch="x")
    after = lake.begin().state
    changed = {n for n in after if after[n].parts != before[n].parts}
    assert changed == {"corretor_dimension"}
    assert star.load_incremental(lake, agency, None, T2, changes, batch="x") == lake.version() == 2


@pytest.mark.parametrize("day", [date(2025, 7, 15), date(2025, 8, 3)])
def test_restate_rewrites_only_touched_months(spark, agency, index, day):
    lake = loaded(spark, early(agency), index)
    before = dict(lake.begin().state["receita_agregada_fact"].parts)
    sale = agency["transvenda"].withColumn(
        "transvendadata", F.when(F.col("transvendaid") == 26, F.lit(day)).otherwise(F.col("transvendadata"))
    )
    changes = frame(spark, [("transvenda", "26")], "entity string, key string")
    star.load_incremental(lake, dict(agency, transvenda=sale), None, T1, changes)
    after = lake.begin().state["receita_agregada_fact"].parts
    assert {m for m in after if before.get(m) != after[m]} == {f"{day:%Y%m}"}
    total = lake.table("receita_agregada_fact").agg(F.sum("ra_comissao_total")).first()[0]
    assert total == pytest.approx(43359.3 + 56526.29 + 2 * 81907.57)


def fed(spark, *changes):
    return frame(spark, list(changes), "entity string, key string")


def shares(lake):
    return rows(
        lake.table("trans_venda_fact"),
        "tv_id", "tv_tipo_cliente", "tv_valor_cliente", "tv_total_compradores", "tv_total_vendedores",
    )


def totals(lake):
    agg = lake.table("receita_agregada_fact").join(lake.table("imovel_dimension").select("im_sk", "im_id"), "im_sk")
    return rows(agg, "im_id", "dt_sk", "ra_comissao_total")


def test_sale_named_before_its_broker_and_client_waits_for_both(spark, agency, index):
    before = dict(
        early(agency),
        corretor=agency["corretor"].filter("funccpf <> '00000000013'"),
        cliente=agency["cliente"].filter("clientecpf <> '00000000105'"),
    )
    lake = loaded(spark, before, index)
    held = totals(lake)
    half = dict(before, transvenda=agency["transvenda"])
    star.load_incremental(lake, half, None, T1, fed(spark, ("transvenda", "26")))
    assert rows(lake.table(star.PARKED)) == [(26, "broker,client", 2)]
    # neither the fact nor the aggregate knows the sale yet
    assert totals(lake) == held and 26 not in {r[0] for r in shares(lake)}
    # each arrival is named alone, without the sale
    star.load_incremental(lake, agency, None, T1, fed(spark, ("corretor", "00000000013")))
    assert rows(lake.table(star.PARKED)) == [(26, "client", 2)]
    star.load_incremental(lake, agency, None, T2, fed(spark, ("cliente", "00000000105")))
    assert rows(lake.table(star.PARKED)) == []
    once = loaded(spark, agency, index)
    assert shares(lake) == shares(once) and totals(lake) == totals(once)


def test_late_participant_rewrites_one_bucket(spark, agency, index):
    before = dict(agency, clientecompra=agency["clientecompra"].filter("clientecpf <> '00000000101'"))
    lake = loaded(spark, before, index)
    parts = dict(lake.begin().state["trans_venda_fact"].parts)
    star.load_incremental(lake, agency, None, T1, fed(spark, ("transvenda", "1"), ("transvenda", "11")))
    once = loaded(spark, agency, index)
    assert shares(lake) == shares(once) and totals(lake) == totals(once)
    now = lake.begin().state["trans_venda_fact"].parts
    gone = {k for k in parts if now.get(k) != parts[k] and k.startswith("done")}
    assert len(gone) == 1  # sale 1 is settled; 11 is as it was
    keys = lake.table("trans_venda_fact").select("tv_sk")
    assert keys.count() == keys.distinct().count()
    # a load that is told the same again changes nothing
    star.load_incremental(lake, agency, None, T2, fed(spark, ("transvenda", "1")))
    assert rows(lake.table("trans_venda_fact").select("tv_sk")) == rows(keys)


def test_snapshots_name_what_changed(spark):
    schema = "clientecpf string, name string"
    before = frame(spark, [("1", "a"), ("2", None), ("3", "c"), ("4", "d"), ("4", "e"), (None, "x")], schema)
    after = frame(
        spark, [("1", "a"), ("2", ""), ("4", "e"), ("4", "d"), ("5", "n"), ("6", "p"), ("6", "p"), (None, "y")], schema
    )
    found = snapshot_changes(before, after, "cliente", "clientecpf")
    assert rows(found) == [("cliente", "2", "U"), ("cliente", "5", "I"), ("cliente", "6", "I")]
    assert rows(snapshot_changes(after, after, "cliente", "clientecpf")) == []
    assert snapshot_changes(before.limit(0), after, "cliente", "clientecpf").count() == 5


def test_feed_from_snapshots_drives_a_load(spark, agency, index):
    lake = loaded(spark, early(agency), index)
    feed = feed_from_snapshots(early(agency), agency, T1)
    assert rows(feed, "entity", "key", "action") == [
        ("corretor", "00000000012", "U"),
        ("imovel", "9", "U"),
        ("transvenda", "26", "I"),
    ]
    star.load_incremental(lake, agency, None, T1, changed_keys(feed))
    once = loaded(spark, agency, index)
    assert shares(lake) == shares(once)


def test_attributes_first_known_later_reach_the_current_version(spark, agency, index):
    blank = agency["imovel"].withColumn("imoveltipo", F.lit(None).cast("string"))
    for column in ("imovelqtdquartos", "imovelm2"):
        blank = blank.withColumn(column, F.lit(None).cast("int"))
    lake = loaded(spark, dict(agency, imovel=blank), index)
    star.load_incremental(lake, agency, None, T1, fed(spark, ("imovel", "9")))
    got = rows(lake.table("imovel_dimension"), "im_sk", "im_id", "im_tipo", "im_m2", "im_is_atual")
    assert [r for r in got if r[1] == 9] == [(2, 9, "Sala Comercial", 473, True)]
    assert len(got) == 3  # no version was opened, and only the named key was filled
    assert [r[2] for r in got if r[1] != 9] == [None, None]


def test_index_feed_writes_its_months_only(spark, agency, index):
    lake = loaded(spark, agency, index.filter("mes < '2025-05-01'"))
    before = dict(lake.begin().state[MARKET_TABLE].parts)
    assert sorted(before) == ["202503", "202504"]
    news = index.filter("mes >= '2025-04-01'").withColumn("preco_m2", F.col("preco_m2") + 1)
    star.load_incremental(lake, agency, news, T1, fed(spark))
    after = lake.begin().state[MARKET_TABLE].parts
    assert {m for m in after if before.get(m) != after[m]} == {"202504", "202505"}
    assert rows(lake.table(MARKET_TABLE), "mk_sk", "mk_preco_m2") == [
        (1, 10367.81), (2, 10000.0), (3, 13001.78), (4, 10401.0),
    ]


def test_pipeline_from_files_to_gold(spark, agency, index):
    root = fresh_path(spark, "warehouse")
    paths = Paths(*(f"{root}/{p}" for p in ("bronze", "sheets", "silver", "offsets", "gold")))
    lake = Lake(spark, f"{root}/lake")
    schemas = {n: df.schema for n, df in agency.items()}

    def sheet(name, month, *prices):
        cells = [None, month, *[None] * 5, *["0.01"] * 5, *["0.15"] * 5, *prices]
        names = ["sheet", *(f"c{i}" for i in range(22))]
        row = frame(spark, [(name, *cells)], ",".join(f"{n} string" for n in names))
        row.coalesce(1).write.mode("append").option("header", True).csv(paths.sheets)

    sheet("Vitória", "2025-03-01", "13001.78", ".", ".", ".", ".")
    land_snapshot(early(agency), paths.bronze, "csv")
    assert pipeline.run(lake, paths, schemas, T0) == 1
    land_snapshot(agency, paths.bronze, "csv")
    # one key in two files of two runs: the later one counts
    sheet("Rio de Janeiro", "2025-04-01 00:00:00", "1", ".", ".", "2", ".")
    pipeline.take_sheets(spark, paths)
    sheet("Rio de Janeiro", "2025-04-01", "9999.0", ".", ".", "10366.81", ".")
    sheet("Rio de Janeiro", "2025-05-01 total", "5", "5", "5", "5", "5")
    assert pipeline.run(lake, paths, schemas, T1) == 2
    view = read_landed(spark, f"{paths.gold}/vw_venda_vs_mercado", star.star_view(lake).schema, "csv")
    assert rows(view, "tv_id", "corretor", "mk_preco_m2", "agio_vs_mercado") == [
        (1, "Ana Lima", 13001.78, 0.18257948510683453),
        (11, "Bia Melo", 10366.81, -0.11769880658066878),
        (25, "Bia Melo", None, None),
        (26, "Caio Nunes", None, None),
    ]
    # no new sheet: the batch is known, and only the source is compared
    assert pipeline.run(lake, paths, schemas, T2) == 3
    assert lake.batches() and rows(lake.table(MARKET_TABLE), "mk_sk") == [(1,), (2,), (3,)]
