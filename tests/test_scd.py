from datetime import date

import pytest
from conftest import T0, T1, T2, frame, rows

from dimwright.operators.scd1 import DuplicateKeys, scd1_upsert
from dimwright.operators.scd2 import (
    Versioned,
    scd2_extend,
    scd2_fill,
    scd2_initial,
    scd2_merge,
)

CL = Versioned.prefixed("cl", "cpf")
SRC = "cl_cpf string, cl_nome string, cl_sobrenome string"
ATTRS = ["cl_nome", "cl_sobrenome"]
SHOWN = ["cl_sk", "cl_cpf", "cl_nome", "cl_dt_inicio", "cl_dt_fim", "cl_is_atual"]


@pytest.fixture
def clients(spark):
    src = frame(spark, [("03", "Caio", "C"), ("01", "Ana", "A"), ("02", "Bia", None)], SRC)
    return scd2_initial(src, CL, ATTRS, T0)


def test_initial_opens_every_row(clients):
    assert rows(clients, *SHOWN) == [
        (1, "01", "Ana", T0, None, True),
        (2, "02", "Bia", T0, None, True),
        (3, "03", "Caio", T0, None, True),
    ]


def test_merge_closes_changed_and_opens_new(spark, clients):
    src = frame(spark, [("01", "Ana", "A"), ("03", "Cauã", "C"), ("04", "Davi", "D")], SRC)
    dim = scd2_merge(clients, src, CL, ATTRS, T1)
    assert rows(dim, *SHOWN) == [
        (1, "01", "Ana", T0, None, True),
        (2, "02", "Bia", T0, None, True),  # deleted at the source: never closed
        (3, "03", "Caio", T0, T1, False),
        (4, "03", "Cauã", T1, None, True),
        (5, "04", "Davi", T1, None, True),
    ]
    assert rows(scd2_merge(dim, src, CL, ATTRS, T2)) == rows(dim)  # again: nothing new


def test_merge_null_against_value_is_no_change_unless_null_safe(spark, clients):
    src = frame(spark, [("02", "Bia", "Braga")], SRC)
    assert scd2_merge(clients, src, CL, ATTRS, T1).count() == 3
    assert scd2_merge(clients, src, CL, ATTRS, T1, null_safe=True).count() == 4


def test_merge_by_changed_keys_dedupes_and_ignores_the_rest(spark, clients):
    src = frame(spark, [("01", "Anna", "A"), ("03", "Cauã", "C"), ("09", "Novo", "N")], SRC)
    keys = frame(spark, [("01",), ("01",), ("09",), ("09",)], "cl_cpf string")
    dim = scd2_merge(clients, src, CL, ATTRS, T1, keys)
    assert rows(dim.filter("cl_is_atual"), "cl_cpf", "cl_nome") == [
        ("01", "Anna"),
        ("02", "Bia"),
        ("03", "Caio"),  # changed but not named
        ("09", "Novo"),
    ]


def test_named_key_without_tracked_change_makes_no_version(spark, clients):
    src = frame(spark, [("01", "Ana", "A")], SRC)
    keys = frame(spark, [("01",)], "cl_cpf string")
    assert scd2_merge(clients, src, CL, ATTRS, T1, keys).count() == 3


def test_merge_on_shuffled_path(shuffled, clients):
    src = frame(shuffled, [("01", "Anna", "A"), ("04", "Davi", "D")], SRC)
    keys = frame(shuffled, [("01",), ("04",)], "cl_cpf string")
    dim = scd2_merge(clients, src, CL, ATTRS, T1, keys)
    assert rows(dim, "cl_sk", "cl_nome", "cl_is_atual") == [
        (1, "Ana", False),
        (2, "Bia", True),
        (3, "Caio", True),
        (4, "Anna", True),
        (5, "Davi", True),
    ]


EXTRA = "cl_cpf string, cl_tipo string, cl_m2 int"


def test_fill_makes_no_version_and_leaves_history_alone(spark, clients):
    src = frame(spark, [("01", "Anna", "A")], SRC)
    dim = scd2_merge(clients, src, CL, ATTRS, T1)
    extra = frame(spark, [("01", "x", 10), ("02", "y", None)], EXTRA)
    filled = scd2_fill(dim, extra, CL, ["cl_tipo", "cl_m2"])
    assert rows(filled, "cl_sk", "cl_tipo", "cl_m2", "cl_is_atual") == [
        (1, None, None, False),
        (2, "y", None, True),
        (3, None, None, True),
        (4, "x", 10, True),
    ]
    again = frame(spark, [("01", "z", 11)], EXTRA)
    assert rows(scd2_fill(filled, again, CL, ["cl_tipo", "cl_m2"])) == rows(filled)


def test_extend_closes_changed_and_copies_the_rest(spark, clients):
    first = frame(spark, [("01", "x", 10), ("02", "y", None), ("03", "z", 5)], EXTRA)
    dim = scd2_extend(clients, first, CL, ["cl_tipo", "cl_m2"], T1)
    assert dim.count() == 3  # filled, not changed
    later = frame(spark, [("01", "x", 12), ("02", "y", 7), ("03", "z", 5)], EXTRA)
    dim2 = scd2_extend(dim, later, CL, ["cl_tipo", "cl_m2"], T2)
    assert rows(dim2, "cl_sk", "cl_cpf", "cl_nome", "cl_m2", "cl_dt_fim", "cl_is_atual") == [
        (1, "01", "Ana", 10, T2, False),
        (2, "02", "Bia", None, T2, False),  # NULL to a value counts here
        (3, "03", "Caio", 5, None, True),
        (4, "01", "Ana", 12, None, True),
        (5, "02", "Bia", 7, None, True),
    ]
    assert rows(scd2_extend(dim2, later, CL, ["cl_tipo", "cl_m2"], T2)) == rows(dim2)


def test_extend_reopens_from_the_latest_closed_version(spark):
    dim = frame(
        spark,
        [
            (1, "01", "old", T0, T1, False, "x"),
            (2, "01", "newer", T1, T2, False, "x"),
        ],
        "cl_sk long, cl_cpf string, cl_nome string, cl_dt_inicio timestamp_ntz, "
        "cl_dt_fim timestamp_ntz, cl_is_atual boolean, cl_tipo string",
    )
    src = frame(spark, [("01", "x")], "cl_cpf string, cl_tipo string")
    out = scd2_extend(dim, src, CL, ["cl_tipo"], T2)
    assert rows(out.filter("cl_is_atual"), "cl_sk", "cl_nome", "cl_tipo") == [(3, "newer", "x")]


MK = "mk_cidade string, mk_cidade_norm string, mk_mes date, mk_dormitorios string, mk_preco_m2 double, mk_var_mensal double, mk_var_12m double"
NK = ["mk_cidade_norm", "mk_mes", "mk_dormitorios"]
COLS = ["mk_preco_m2", "mk_var_mensal", "mk_var_12m"]


def upsert(dim, stage, ts, mode="upsert"):
    return scd1_upsert(
        dim, stage, "mk_sk", NK, COLS, ["mk_preco_m2", "mk_var_12m"], ts, "mk_dt_carga", ["mk_cidade"], mode
    )


def mk(city, month, price, var_m=0.1, var_12=None, name=None):
    return (name or city, city, date(2025, month, 1), "Total", price, var_m, var_12)


def test_scd1_upsert_rules(spark):
    dim = upsert(None, frame(spark, [mk("A", 1, 10.0), mk("A", 2, 11.0), mk("B", 1, 9.0)], MK), T0)
    stage = frame(
        spark,
        [
            mk("A", 1, 10.0, var_m=0.9, name="other"),  # only the ignored measure differs
            mk("A", 2, 11.0, var_12=0.5, name="other"),  # NULL to a value: revised
            mk("C", 1, 7.0),
        ],
        MK,
    )
    got = upsert(dim, stage, T1)
    shown = ["mk_sk", "mk_cidade", "mk_preco_m2", "mk_var_mensal", "mk_var_12m", "mk_dt_carga"]
    assert rows(got, *shown) == [
        (1, "A", 10.0, 0.1, None, T0),
        (2, "A", 11.0, 0.1, 0.5, T1),
        (3, "B", 9.0, 0.1, None, T0),
        (4, "C", 7.0, 0.1, None, T1),
    ]
    assert rows(upsert(got, stage, T2)) == rows(got)
    only = upsert(dim, stage, T1, "insert_only")
    assert rows(only.filter("mk_sk <= 3")) == rows(dim) and only.count() == 4


def test_scd1_refuses_a_repeated_key(spark):
    twice = frame(spark, [mk("A", 1, 10.0), mk("A", 1, 11.0)], MK)
    with pytest.raises(DuplicateKeys):
        upsert(None, twice, T0)


def test_scd1_on_shuffled_path(shuffled):
    dim = upsert(None, frame(shuffled, [mk("A", m, 1.0) for m in range(1, 13)], MK), T0)
    got = upsert(dim, frame(shuffled, [mk("A", 3, 2.0), mk("B", 3, 4.0)], MK), T1)
    assert rows(got.filter("mk_preco_m2 > 1"), "mk_sk", "mk_preco_m2") == [(13, 4.0), (3, 2.0)]


def test_merge_refuses_a_repeated_source_key(spark, clients):
    for twice in ([("01", "Eva", "A"), ("01", "Ida", "A")], [("01", "Eva", "A"), ("01", "Ana", "A")]):
        with pytest.raises(DuplicateKeys):
            scd2_merge(clients, frame(spark, twice, SRC), CL, ATTRS, T1)
    # a key that comes twice as it is opens nothing
    same = frame(spark, [("01", "Ana", "A")] * 2, SRC)
    assert scd2_merge(clients, same, CL, ATTRS, T1).count() == 3


def test_upsert_of_a_slice_goes_on_from_the_largest_key(spark):
    schema = "sk long, nk string, price double, loaded timestamp_ntz"
    part = frame(spark, [(7, "a", 1.0, T0), (3, "b", 2.0, T0)], schema)
    stage = frame(spark, [("b", 5.0), ("c", 6.0)], "nk string, price double")
    got = scd1_upsert(part, stage, "sk", ["nk"], ["price"], ["price"], T1, "loaded", start=40)
    assert rows(got) == [(3, "b", 5.0, T1), (41, "c", 6.0, T1), (7, "a", 1.0, T0)]
