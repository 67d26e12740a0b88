from datetime import date

import pytest
from conftest import T0, frame, rows
from pyspark.sql import functions as F

from dimwright.operators.market import (
    benchmark_measures,
    link_benchmark,
    market_subset,
    price_and_link,
    price_item,
    sale_vs_market,
    wide_to_long,
)
from dimwright.operators.quality import ForeignKey, Rules, check_constraints, coverage
from dimwright.plans import star


def sheet_row(sheet, when, prices, var_m=None, var_12=None):
    blank = ["."] * 5
    cells = [None, when, *["x"] * 5, *(var_m or blank), *(var_12 or blank), *prices]
    return (sheet, *cells)


SHEET = "sheet string, " + ", ".join(f"c{i} string" for i in range(22))


def test_wide_to_long(spark):
    df = frame(
        spark,
        [
            sheet_row("São Paulo", "Data", ["Total", "1D", "2D", "3D", "4D"]),  # heading
            sheet_row("São Paulo", "2025-03-01", ["100.126", "90", ".", "80.5", ""], ["0.1", ".", "0.2", "x", "."]),
            sheet_row("Vitória", "2025-03-01", ["130.4", ".", ".", ".", "."], None, ["0.5", ".", ".", ".", "."]),
            sheet_row("Resumo", "2025-03-01", ["1", "2", "3", "4", "5"]),
            sheet_row("Índice FipeZAP", "2025-03-01", ["1", "2", "3", "4", "5"]),
            sheet_row("Vitória", None, ["9", "9", "9", "9", "9"]),
        ],
        SHEET,
    )
    march = date(2025, 3, 1)
    assert rows(
        wide_to_long(df), "cidade", "cidade_norm", "mes", "dormitorios", "preco_m2", "var_mensal", "var_12m"
    ) == [
        ("São Paulo", "SAO PAULO", march, "1D", 90.0, None, None),
        ("São Paulo", "SAO PAULO", march, "3D", 80.5, None, None),
        ("São Paulo", "SAO PAULO", march, "Total", 100.13, 0.1, None),
        ("Vitória", "VITORIA", march, "Total", 130.4, None, 0.5),
    ]


@pytest.fixture(scope="module")
def market(spark):
    data = [
        (1, "VITORIA", date(2025, 3, 1), "Total"),
        (2, "RIO", date(2025, 3, 1), "Total"),
        (3, "RIO", date(2025, 3, 1), "2D"),
        (4, "RIO", date(2025, 3, 1), "4D"),
        (5, "NATAL", date(2025, 3, 1), "2D"),
    ]
    return frame(spark, data, "mk_sk long, mk_cidade_norm string, mk_mes date, mk_dormitorios string")


@pytest.fixture(scope="module")
def items(spark):
    data = [
        (1, "Rio", "Apartamento", 2),
        (2, "Rio", "Apartamento", 3),  # no 3D: total
        (3, "Rio", "Apartamento", 6),  # four or more
        (4, "Rio", "Apartamento", 0),
        (5, "Rio", "Apartamento", None),
        (6, " Vitória ", "Apartamento", 2),
        (7, "Rio", "Casa", 2),
        (8, "Natal", "Apartamento", 3),  # neither band nor total
        (9, "Ouro Preto", "Apartamento", 1),
    ]
    return frame(spark, data, "im_sk long, im_cidade string, im_tipo string, im_qtd_quartos int")


LINKED = [(1, 3), (2, 2), (3, 4), (4, 2), (5, 2), (6, 1), (7, None), (8, None), (9, None)]


def test_link_prefers_the_band_and_falls_back_to_total(spark, items, market):
    fact = items.select("im_sk").selectExpr("im_sk", "20250317 AS dt_sk")
    assert rows(link_benchmark(fact, items, market), "im_sk", "mk_sk") == LINKED
    other_month = fact.selectExpr("im_sk", "20250417 AS dt_sk")
    assert link_benchmark(other_month, items, market).filter("mk_sk is not null").count() == 0


def test_link_on_shuffled_path(shuffled, items, market):
    fact = items.select("im_sk").selectExpr("im_sk", "20250317 AS dt_sk")
    assert rows(link_benchmark(fact, items, market), "im_sk", "mk_sk") == LINKED


def test_link_is_sticky(spark, items, market):
    fact = frame(spark, [(1, 20250317, 2), (2, 20250317, None)], "im_sk long, dt_sk int, mk_sk long")
    assert rows(link_benchmark(fact, items, market), "im_sk", "mk_sk") == [(1, 2), (2, 2)]


def test_market_subset_folds_both_sides(items, market):
    assert rows(market_subset(market, items), "mk_sk") == [(1,), (2,), (3,), (4,), (5,)]
    assert rows(market_subset(market, items.filter("im_sk = 6")), "mk_sk") == [(1,)]


def test_view_and_measures(spark):
    fact = frame(
        spark,
        [
            # tv_sk, tv_id, cor, im, dt, mk, buyers, sellers, valor, comissao, m2 price
            (1, 1, 1, 1, 20250301, 7, 2, 1, 100.0, 6.0, 12.0),
            (2, 1, 1, 1, 20250301, 7, 2, 1, 100.0, 6.0, 12.0),
            (3, 1, 1, 1, 20250301, 7, 2, 1, 100.0, 6.0, 12.0),
            (4, 2, 1, 1, 20250301, None, 1, 1, 50.0, 3.0, 6.0),
        ],
        "tv_sk long, tv_id int, cor_sk long, im_sk long, dt_sk int, mk_sk long, tv_total_compradores int, "
        "tv_total_vendedores int, tv_valor double, tv_comissao double, tv_valor_m2 double",
    )
    brokers = frame(spark, [(1, "Ana", "Lima")], "cor_sk long, cor_nome string, cor_sobrenome string")
    item = frame(
        spark,
        [(1, "Rio", "RJ", "Centro", "Apartamento", 2, 8)],
        "im_sk long, im_cidade string, im_estado string, im_bairro string, im_tipo string, im_qtd_quartos int, im_m2 int",
    )
    days = frame(spark, [(20250301, date(2025, 3, 1))], "dt_sk int, dt_data_completa date")
    prices = frame(spark, [(7, 10.0, 0.1)], "mk_sk long, mk_preco_m2 double, mk_var_12m double")
    view = sale_vs_market(fact, brokers, item, days, prices)
    assert rows(view, "tv_id", "corretor", "mk_sk", "agio_vs_mercado") == [
        (1, "Ana Lima", 7, 12.0 / 10.0 - 1),
        (2, "Ana Lima", None, None),
    ]
    # a sale counts once, however many clients it has
    assert rows(benchmark_measures(view)) == [(0.2, 9.0, 10.0, 1)]
    assert rows(benchmark_measures(view, ["im_cidade"]), "im_cidade", "vendas_com_benchmark") == [("Rio", 1)]
    assert rows(coverage(view)) == [(1, 2, "1/2 vendas com benchmark")]


def test_constraints(spark):
    df = frame(
        spark,
        [(1, "I", "x"), (1, "U", None), (2, "D", "xyz"), (None, "I", "x"), (1, "I", "x")],
        "k int, action string, p string",
    )
    parent = frame(spark, [("x",), ("x",)], "p string")
    rules = Rules(
        not_null=["k"],
        unique=[["k"]],
        foreign_keys={"to_parent": ForeignKey(["p"], parent, ["p"])},
        domains={"action": ["I", "U"]},
        max_lengths={"p": 2},
    )
    for data in (df, df.repartition(3)):
        assert rows(check_constraints(data, rules)) == [
            ("domain", "action", 1),
            ("foreign_key", "to_parent", 1),
            ("length", "p", 1),
            ("not_null", "k", 1),
            ("unique", "k", 2),
        ]
    empty = check_constraints(df.filter("k > 9"), rules)
    assert {r["violations"] for r in empty.collect()} == {0}


def test_market_load_modes_use_the_star_names(spark, index):
    dim = star.load_market(None, star.market_stage(index), T0, "insert_only")
    assert rows(dim, "mk_sk", "mk_cidade_norm", "mk_dormitorios") == [
        (1, "RIO DE JANEIRO", "3D"),
        (2, "RIO DE JANEIRO", "Total"),
        (3, "RIO DE JANEIRO", "3D"),
        (4, "VITORIA", "Total"),
    ]


def test_rows_that_carry_their_item_need_no_join_on_it(spark):
    """New rows are priced and linked as after a look-up by ``im_sk``."""
    items = spark.createDataFrame(
        [(1, "Apartamento", "São Paulo", 2, 50), (2, "Casa", "São Paulo", 2, 80), (3, "Apartamento", None, None, None)],
        "im_sk long, im_tipo string, im_cidade string, im_qtd_quartos int, im_m2 int",
    )
    market = spark.createDataFrame(
        [(7, "SAO PAULO", date(2000, 1, 1), "2D"), (8, "SAO PAULO", date(2000, 2, 1), "Total")],
        "mk_sk long, mk_cidade_norm string, mk_mes date, mk_dormitorios string",
    )
    sold = [(i, item, day, 100.0) for i, (item, day) in enumerate((x, d) for x in (1, 2, 3) for d in (20000105, 20000203, 20000301))]
    fact = spark.createDataFrame(sold, "tv_id long, im_sk long, dt_sk int, tv_valor double")
    expected = price_and_link(fact, items, market)
    carried = fact.join(items.select("im_sk", price_item("Apartamento")), "im_sk", "left").localCheckpoint()
    none = spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fact.schema])
    got = price_and_link(none, items, market, fresh=carried)
    assert got.columns == expected.columns
    assert sorted(got.collect(), key=str) == sorted(expected.collect(), key=str)
    assert {r["mk_sk"] for r in got.collect()} == {None, 7, 8}
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1  # the index
