"""Declared rules of the agency's source and of its star, and their reports."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.operators.facts import BUYER, SELLER
from dimwright.operators.quality import ForeignKey, Rules, VersionRules, check_constraints, check_versions
from dimwright.operators.scd2 import Versioned
from dimwright.plans.star import AGGREGATE, BROKER, CLIENT, FACT, ITEM, MARKET_KEY
from dimwright.sources.lake import MARKET_TABLE

Tables = Mapping[str, DataFrame]

# table: primary key, columns that may not be NULL, references (column, parent, parent's column)
SOURCE = {
    "uf": (["uf"], ["ufestadonome"], []),
    "cep": (["cep"], ["cepmunicipio"], [("uf", "uf", "uf")]),
    "endereco": (["endid"], ["endbairro"], [("cep", "cep", "cep")]),
    "funcionario": (["funccpf"], ["funcprimnome", "funcultimonome"], []),
    "corretor": (["funccpf"], ["corretorregistro"], [("funccpf", "funcionario", "funccpf")]),
    "cliente": (["clientecpf"], ["clienteprimnome", "cliultimonome"], []),
    "imovel": (["imovelid"], ["imoveltipo"], [("endid", "endereco", "endid")]),
    "anuncio": ([], ["anunciopreco"], [("imovelid", "imovel", "imovelid")]),
    "transvenda": (["transvendaid"], ["transvendavalor", "transvendadata"], [("funccpf", "corretor", "funccpf")]),
    "imoveltransacao": (
        ["imovelid", "transvendaid"],
        [],
        [("imovelid", "imovel", "imovelid"), ("transvendaid", "transvenda", "transvendaid")],
    ),
    "clientecompra": (
        ["transvendaid", "clientecpf"],
        [],
        [("transvendaid", "transvenda", "transvendaid"), ("clientecpf", "cliente", "clientecpf")],
    ),
    "clientevende": (
        ["transvendaid", "clientecpf"],
        [],
        [("transvendaid", "transvenda", "transvendaid"), ("clientecpf", "cliente", "clientecpf")],
    ),
}
TAX_ID_LENGTH = 11


def _named(report: DataFrame, table: str) -> DataFrame:
    return report.select(F.lit(table).alias("table_name"), "rule", "subject", "violations")


def source_report(t: Tables) -> DataFrame:
    """Violations of keys, references and lengths in every source table."""
    reports = []
    for table, (key, filled, references) in SOURCE.items():
        if table not in t:
            continue
        df = t[table]
        rules = Rules(
            not_null=[*key, *filled],
            unique=[key] if key else [],
            foreign_keys={f"{table}.{c}": ForeignKey([c], t[parent], [p]) for c, parent, p in references},
            max_lengths={c: TAX_ID_LENGTH for c in df.columns if c.endswith("cpf")},
        )
        reports.append(_named(check_constraints(df, rules), table))
    return reduce(DataFrame.unionByName, reports)


def star_report(t: Tables) -> DataFrame:
    """Violations in dimensions (keys and histories), facts (references and
    roles), market and aggregate."""
    dims: dict[str, Versioned] = {
        "corretor_dimension": BROKER,
        "cliente_dimension": CLIENT,
        "imovel_dimension": ITEM,
    }
    reports = []
    for table, names in dims.items():
        rules = Rules(not_null=[names.sk, names.nk, names.valid_from, names.is_current], unique=[[names.sk]])
        reports.append(_named(check_constraints(t[table], rules), table))
        history = VersionRules(names.nk, names.sk, names.valid_from, names.valid_to, names.is_current)
        reports.append(_named(check_versions(t[table], history, names.nk), table))
    keys = {names.sk: ForeignKey([names.sk], t[table], [names.sk]) for table, names in dims.items()}
    days = ForeignKey(["dt_sk"], t["data_dimension"], ["dt_sk"])
    fact = Rules(
        not_null=["tv_id", "tv_valor", "tv_tipo_cliente"],
        unique=[["tv_sk"], ["tv_id", "im_sk", "cl_sk", "tv_tipo_cliente"]],
        foreign_keys={**keys, "dt_sk": days, "mk_sk": ForeignKey(["mk_sk"], t[MARKET_TABLE], ["mk_sk"])},
        domains={"tv_tipo_cliente": [BUYER, SELLER]},
    )
    reports.append(_named(check_constraints(t[FACT], fact), FACT))
    aggregate = Rules(unique=[["im_sk", "dt_sk"]], foreign_keys={"im_sk": keys["im_sk"], "dt_sk": days})
    reports.append(_named(check_constraints(t[AGGREGATE], aggregate), AGGREGATE))
    market = Rules(not_null=["mk_preco_m2"], unique=[["mk_sk"], list(MARKET_KEY)])
    reports.append(_named(check_constraints(t[MARKET_TABLE], market), MARKET_TABLE))
    return reduce(DataFrame.unionByName, reports)
