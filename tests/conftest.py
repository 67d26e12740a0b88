import os
import sys
from datetime import date, datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from dimwright.session import local_session, materialise  # noqa: E402

T0 = datetime(2025, 8, 1, 9, 0)
T1 = datetime(2025, 9, 1, 9, 0)
T2 = datetime(2025, 10, 1, 9, 0)


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, shuffle_partitions=3)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def shuffled(spark):
    """No broadcasts, and low bars for hot keys: the paths of large tables."""
    names = {
        "spark.dimwright.broadcastBytes": "-1",
        "spark.dimwright.hotShare": "0.2",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    before = {n: spark.conf.get(n, None) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield spark
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)


def frame(spark, data, schema):
    return spark.createDataFrame(data, schema)


@pytest.fixture(scope="session")
def agency(spark):
    """Four sales of a small agency.

    Fixed values: sale amounts, areas and commissions with known results.
    """

    def make(data, schema):
        # stored, as operational tables are: their size is known to the planner
        return materialise(spark.createDataFrame(data, schema).coalesce(1), "fixture")

    return {
        "funcionario": make(
            [
                ("00000000011", "Ana", "Lima"),
                ("00000000012", "Bia", "Melo"),
                ("00000000013", "Caio", "Nunes"),
                ("00000000014", "Davi", "Pena"),  # no broker
            ],
            "funccpf string, funcprimnome string, funcultimonome string",
        ),
        "corretor": make(
            [("R-11", 1.0, "00000000011"), ("R-12", 2.0, "00000000012"), ("R-13", 3.0, "00000000013")],
            "corretorregistro string, orcamentomes double, funccpf string",
        ),
        "uf": make([("ES", "Espírito Santo"), ("RJ", "Rio de Janeiro")], "uf string, ufestadonome string"),
        "cep": make(
            [
                ("29010000", "Rua A", "Vitória", "ES"),
                ("22410000", "Rua B", "Rio de Janeiro", "RJ"),
            ],
            "cep string, nmlogradouro string, cepmunicipio string, uf string",
        ),
        "endereco": make(
            [(1, "Centro", "29010000"), (2, "Ipanema", "22410000"), (3, "Centro", "29010000")],
            "endid int, endbairro string, cep string",
        ),
        "imovel": make(
            [
                (25, "Apartamento", 1, 47, 1),
                (2, "Apartamento", 3, 103, 2),
                (9, "Sala Comercial", 0, 473, 3),
            ],
            "imovelid int, imoveltipo string, imovelqtdquartos int, imovelm2 int, endid int",
        ),
        "anuncio": make(
            [(1, 100.5, 25), (2, 50.0, 25), (3, 10.0, 2)],
            "anuncioid int, anunciopreco double, imovelid int",
        ),
        "cliente": make(
            [(f"0000000010{i}", f"Cli{i}", f"Ente{i}") for i in range(8)],
            "clientecpf string, clienteprimnome string, cliultimonome string",
        ),
        "transvenda": make(
            [
                (1, 722655.0, date(2025, 3, 1), 43359.3, "00000000011"),
                (11, 942104.83, date(2025, 4, 20), 56526.29, "00000000012"),
                (25, 1365126.21, date(2025, 7, 15), 81907.57, "00000000012"),
                (26, 1365126.21, date(2025, 7, 15), 81907.57, "00000000013"),
            ],
            "transvendaid int, transvendavalor double, transvendadata date, transcomissao double, funccpf string",
        ),
        "imoveltransacao": make(
            [(25, 1), (2, 11), (9, 25), (9, 26)], "imovelid int, transvendaid int"
        ),
        "clientecompra": make(
            [
                (1, "00000000100"),
                (1, "00000000101"),
                (11, "00000000102"),
                (25, "00000000103"),
                (25, "00000000104"),
                (26, "00000000105"),
                (26, "00000000106"),
            ],
            "transvendaid int, clientecpf string",
        ),
        "clientevende": make(
            [
                (1, "00000000107"),
                (11, "00000000103"),
                (11, "00000000104"),
                (25, "00000000100"),
                (26, "00000000103"),
            ],
            "transvendaid int, clientecpf string",
        ),
    }


@pytest.fixture(scope="session")
def index(spark):
    """Silver rows of the index: one city with the total band only."""
    silver = spark.createDataFrame(
        [
            ("Vitoria", "VITORIA", date(2025, 3, 1), "Total", 13001.78, 0.01, 0.15),
            ("Rio de Janeiro", "RIO DE JANEIRO", date(2025, 4, 1), "Total", 9999.0, 0.01, 0.02),
            ("Rio de Janeiro", "RIO DE JANEIRO", date(2025, 4, 1), "3D", 10366.81, 0.01, 0.03),
            ("Rio de Janeiro", "RIO DE JANEIRO", date(2025, 5, 1), "3D", 10400.0, 0.01, 0.03),
        ],
        "cidade string, cidade_norm string, mes date, dormitorios string, preco_m2 double, "
        "var_mensal double, var_12m double",
    )
    return materialise(silver.coalesce(1), "fixture")
