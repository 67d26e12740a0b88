"""What loads shuffle, store and write: each test pins the rows and the saving."""

import re
from datetime import date, datetime
from pathlib import Path
from threading import Barrier

from conftest import T0, T1, frame, rows
from pyspark.sql import functions as F

from dimwright.functions import hash_sums
from dimwright.operators.facts import SaleDims, aggregate_fact, due_sales, participant_fact, sale_fact, unresolved_sales
from dimwright.operators.quality import differing_rows, reconcile
from dimwright.plans import queries, star
from dimwright.session import fresh_path, materialise
from dimwright.sources import lake as landing
from dimwright.sources.lake import land_snapshot, publish_gold, read_landed
from dimwright.sources.versions import Lake
from dimwright.streaming.feed import snapshot_changes
from test_star import early


def joins(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return len(re.findall(r"^\W*Join ", plan, re.MULTILINE))


def test_text_layers_are_compressed(spark):
    df = frame(spark, [("a,b", None), ("", 1.5), (None, 2.0)], "t string, x double")
    out = fresh_path(spark, "bronze")
    land_snapshot({"a": df}, out, "csv")
    publish_gold({"trans_venda_fact": df}, f"{out}/gold")
    for folder in (f"{out}/a", f"{out}/gold/trans_venda_fact"):
        written = [p for p in Path(folder.removeprefix("file:")).iterdir() if p.name.startswith("part-")]
        assert written and all(p.name.endswith(".csv.gz") for p in written)
        assert rows(read_landed(spark, folder, df.schema, "csv")) == rows(df)
    publish_gold({"trans_venda_fact": df}, f"{out}/plain", compression="none")
    assert rows(read_landed(spark, f"{out}/plain/trans_venda_fact", df.schema, "csv")) == rows(df)


def test_differing_rows_counts_repeats_and_nulls(spark):
    kind = "a long, b string"
    there = frame(spark, [(1, "x"), (1, "x"), (2, None), (None, "2"), (3, "z")], kind)
    assert rows(differing_rows(there, there.orderBy(F.desc("a")))) == [(5, 0)]
    here = frame(spark, [(1, "x"), (2, None), (2, None), (None, "2"), (4, "z")], kind)
    # (1, x) and (3, z) are lacking, (2, NULL) and (4, z) too many
    assert rows(differing_rows(there, here)) == [(5, 4)]
    none = there.filter("a > 9")
    assert rows(differing_rows(none, none)) == [(None, 0)]
    assert rows(differing_rows(none, here)) == [(0, 5)]


def test_equal_sides_are_compared_without_a_shuffle_of_rows(spark):
    many = spark.range(50_000).select("id", F.concat(F.lit("n"), "id").alias("name"))
    report = differing_rows(many, many)
    assert rows(report) == [(50_000, 0)]
    assert "Exchange" not in report._jdf.queryExecution().executedPlan().toString()


def test_due_sales_meet_the_named_ones_once(spark):
    sale = "transvendaid long"
    named = frame(spark, [(1,), (1,), (2,), (3,), (4,), (None,)], sale)
    buyers = frame(spark, [(1,), (2,), (2,), (5,), (None,)], sale)
    sellers = frame(spark, [(1,), (2,), (3,)], sale)
    items = frame(spark, [(1,), (1,), (2,), (3,)], sale)
    held = frame(
        spark,
        [(1, 7, 1, 1), (1, 8, 1, 1), (1, 8, 1, 1), (2, 7, 1, 1), (5, 7, 1, 0), (None, 7, 1, 1)],
        "tv_id long, im_sk long, tv_total_compradores int, tv_total_vendedores int",
    )
    due = due_sales(named, items, buyers, sellers, held)
    # 1 is held as it is, 2 got a buyer, 3 and 4 and the one without an id are not held
    assert rows(due) == [(2, True), (3, False), (4, False), (None, False)]
    assert joins(due) == 1


def unresolved(spark, ids=None):
    sale = frame(
        spark,
        [(1, "b1"), (2, "b9"), (3, "b1"), (4, None), (None, "b1")],
        "transvendaid long, funccpf string",
    )
    items = frame(spark, [(1, 7), (2, 9), (4, 7), (8, 7), (None, 9)], "transvendaid long, imovelid long")
    link = "transvendaid long, clientecpf string"
    buyers = frame(spark, [(1, "c1"), (2, "c9"), (8, None), (None, "c9")], link)
    sellers = frame(spark, [(1, "c1"), (3, None)], link)
    dims = SaleDims(
        frame(spark, [("b1", 1, True), ("b9", 2, False)], "cor_cpf string, cor_sk long, cor_is_atual boolean"),
        frame(spark, [(7, 1, True)], "im_id long, im_sk long, im_is_atual boolean"),
        frame(spark, [("c1", 1, True)], "cl_cpf string, cl_sk long, cl_is_atual boolean"),
    )
    return unresolved_sales(ids, sale, items, buyers, sellers, dims)


def test_unresolved_sales_are_marked_in_one_pass(spark):
    every = unresolved(spark)
    assert rows(every) == [(2, "broker,client,item"), (3, "client,items"), (4, "broker,participants")]
    ids = frame(spark, [(1,), (2,), (2,), (8,), (9,), (None,)], "transvendaid long")
    some = unresolved(spark, ids)
    assert rows(some) == [
        (2, "broker,client,item"),
        (8, "client,sale"),
        (9, "items,participants,sale"),
        (None, "items,participants,sale"),
    ]
    # look-ups of unknown keys (one per role for clients), one of the sales; few ids cut the tables in one more
    assert joins(every) <= 5 and joins(some) <= 6


def test_new_sales_are_not_compared_with_the_bridges(spark, agency, monkeypatch):
    seen = []

    def noted(fact, link, clients, *more, existing=None):
        seen.append((rows(fact.select("tv_id").distinct()), None if existing is None else existing.count()))
        return real(fact, link, clients, *more, existing=existing)

    real = star.bridge
    lake = Lake(spark, fresh_path(spark, "lake"))
    star.load_bridge_initial(lake, early(agency), T0)
    first = rows(lake.table("trans_venda_fact").select("tv_id").distinct())
    monkeypatch.setattr(star, "bridge", noted)
    star.load_bridge_incremental(lake, agency, T1)
    new = [sales for sales, held in seen if held is None]
    assert len(seen) == 4 and len(new) == 2
    assert all(not set(sales) & set(first) for sales in new)


def test_early_links_are_stored_once(spark, tmp_path):
    from dimwright.plans.testmap import Source

    day = "timestamp_ntz'1999-05-01 00:00:00'"
    small = {
        "region": "0L r_regionkey, 'R' r_name",
        "nation": "0L n_nationkey, 'N' n_name, 0L n_regionkey",
        "customer": "1L c_custkey, 'C' c_name, 0L c_nationkey",
        "supplier": "1L s_suppkey, 'S' s_name, 0L s_nationkey",
        "part": "1L p_partkey, 'B' p_brand, 'PROMO' p_type, 5 p_size",
        "orders": f"1L o_orderkey, 1L o_custkey, 9.0D o_totalprice, {day} o_orderdate, '1-URGENT' o_orderpriority",
        "lineitem": "id l_orderkey, 1L l_partkey, 1L l_suppkey, 1.0D l_extendedprice, 'N' l_returnflag, "
        f"'O' l_linestatus, {day} l_shipdate",
    }
    for name, columns in small.items():
        spark.range(1, 3).selectExpr(*re.split(r", (?=\S)", columns)).limit(2 if name == "lineitem" else 1).write.parquet(
            f"{tmp_path}/{name}.parquet"
        )
    tables = queries._agency(Source(spark, str(tmp_path)), True)
    # sale 2 has no row yet, so its link is not there either
    assert rows(tables["clientecompra"]) == [(1, "00000000001")] and rows(tables["clientevende"]) == []
    for link in ("clientecompra", "clientevende"):
        assert joins(tables[link]) == 0


def agency_tables(spark):
    sale = frame(
        spark,
        [(1, 90.0, 9.0, T0.date(), "b"), (2, 50.0, 5.0, T0.date(), "x"), (3, None, 1.0, T0.date(), "b")],
        "transvendaid long, transvendavalor double, transcomissao double, transvendadata date, funccpf string",
    )
    items = frame(spark, [(1, 7), (1, 8), (1, 9), (2, 7), (3, 8), (None, 8)], "transvendaid long, imovelid long")
    links = "transvendaid long, clientecpf string"
    buyers = frame(spark, [(1, "c"), (1, "gone"), (1, None), (3, "c"), (3, "c")], links)
    sellers = frame(spark, [(1, "d"), (2, "c"), (None, "d")], links)
    return sale, items, buyers, sellers


def known_keys(spark):
    def dim(prefix, nk, keys, kind):
        found = [(k, i, i % 5 != 4) for i, k in enumerate(keys)]
        return frame(spark, found, f"{prefix}_{nk} {kind}, {prefix}_sk long, {prefix}_is_atual boolean")

    return SaleDims(
        dim("cor", "cpf", ["b"], "string"), dim("im", "id", [7, 8], "long"), dim("cl", "cpf", ["c", "d"], "string")
    )


def lookups_of_joined_rows(df):
    """Joins on a natural key whose input is a join already."""
    lines = df._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = [re.search(r"[A-Za-z]", line + "z").start() for line in lines]
    found = []
    for i, line in enumerate(lines):
        if re.match(r"^\W*Join .*(funccpf|imovelid|clientecpf|transvendadata)#", line):
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            found += [line for below in lines[i + 1 : end] if re.match(r"^\W*Join ", below)]
    return found


def test_keys_are_looked_up_before_sales_fan_out(spark):
    sale, items, buyers, sellers = agency_tables(spark)
    dims = known_keys(spark)
    fact = participant_fact(sale, items, buyers, sellers, dims)
    assert rows(fact, "tv_id", "im_sk", "cl_sk", "tv_valor_cliente", "tv_total_compradores", "tv_total_vendedores") == [
        (1, 0, 0, 30.0, 3, 1), (1, 0, 1, 90.0, 3, 1), (1, 1, 0, 30.0, 3, 1), (1, 1, 1, 90.0, 3, 1),
        (3, 1, 0, None, 2, 0), (3, 1, 0, None, 2, 0),
    ]
    assert rows(sale_fact(sale, items, dims), "tv_id", "im_sk", "tv_comissao") == [(1, 0, 9.0), (1, 1, 9.0), (3, 1, 1.0)]
    agg = aggregate_fact(sale, items, dims.item)
    assert rows(agg, "im_sk", "ra_comissao_total") == [(0, 14.0), (1, 10.0)]
    for df in (fact, sale_fact(sale, items, dims), agg):
        assert lookups_of_joined_rows(df) == []


def test_source_sides_are_summed_in_one_pass(spark):
    sale, items, buyers, sellers = agency_tables(spark)
    fact = participant_fact(sale, items, buyers, sellers, known_keys(spark))
    report = reconcile(sale, items, fact)
    assert rows(report, "medida", "origem", "origem_itens", "compradores", "vendedores") == [
        ("comissao", 15.0, 33.0, 7.0, 18.0), ("valor", 140.0, 320.0, 60.0, 180.0),
    ]
    alone = reconcile(sale, items, fact.limit(0))
    assert joins(alone) <= joins(fact.limit(0)) + 1


def test_tables_are_landed_side_by_side(spark, monkeypatch):
    both, write = Barrier(2, timeout=60), landing._write
    monkeypatch.setattr(landing, "SIDE_BY_SIDE", 2)
    monkeypatch.setattr(landing, "_write", lambda *args: (both.wait(), write(*args)))
    tables = {name: frame(spark, [(i, name)], "n long, t string") for i, name in enumerate("dcba")}
    out = fresh_path(spark, "bronze")
    assert land_snapshot(tables, out) == ["a", "b", "c", "d"] and land_snapshot({}, out) == []
    assert {n: rows(read_landed(spark, f"{out}/{n}", df.schema)) for n, df in tables.items()} == {
        "a": [(3, "a")], "b": [(2, "b")], "c": [(1, "c")], "d": [(0, "d")],
    }


def test_snapshots_meet_without_a_join(spark):
    before = frame(
        spark, [(1, "a", 1.0), (1, "b", None), (2, None, 0.0), (3, "x", 1.0), (None, "n", 1.0)], "k int, t string, x double"
    )
    after = frame(
        spark, [(1, "b", None), (1, "a", 1.0), (2, None, -0.0), (4, "y", 1.0), (4, "y", 1.0)], "k long, t string, x double"
    )
    found = snapshot_changes(before, after, "cliente", "k")
    # the key's type differs, so keys and their rows are compared as text
    assert rows(found) == [("cliente", "2", "U"), ("cliente", "4", "I")]
    assert joins(found) == 0
    same = snapshot_changes(after, after.orderBy("t"), "cliente", "k")
    assert rows(same) == [] and joins(same) == 0


def test_hash_sums_hold_for_any_order_and_tell_sets_apart(spark):
    many = spark.range(1000).select(F.xxhash64("id").alias("h"))
    sums = [c.alias(f"s{i}") for i, c in enumerate(hash_sums(F.col("h")))]
    total = many.agg(*sums)
    assert {f.dataType.simpleString() for f in total.schema} == {"bigint"}
    whole = total.selectExpr("(s0 + s1 * 4194304 + cast(s2 as decimal(38,0)) * 17592186044416) % 18446744073709551616")
    exact = many.agg(F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).selectExpr("pmod(s, 18446744073709551616)")
    assert rows(whole) == rows(exact)
    assert rows(many.orderBy(F.desc("h")).agg(*sums)) == rows(total) != rows(many.filter("h % 7 <> 0").agg(*sums))


def test_due_sales_of_a_whole_source_are_not_joined(spark):
    sale = "transvendaid long"
    named = frame(spark, [(1,), (1,), (2,), (3,), (4,), (None,)], sale)
    links = [frame(spark, data, sale) for data in ([(1,), (1,), (2,), (3,)], [(1,), (2,), (2,), (5,), (None,)], [(1,), (2,), (3,)])]
    held = frame(
        spark,
        [(1, 7, 1, 1), (1, 8, 1, 1), (1, 8, 1, 1), (2, 7, 1, 1), (5, 7, 1, 0), (None, 7, 1, 1)],
        "tv_id long, im_sk long, tv_total_compradores int, tv_total_vendedores int",
    )
    due = due_sales(named, *links, held, every=True)
    assert rows(due) == rows(due_sales(named, *links, held)) == [(2, True), (3, False), (4, False), (None, False)]
    assert joins(due) == 0


def test_settled_parts_are_split_by_number(spark, agency, index):
    store = Lake(spark, fresh_path(spark, "lake"))
    star.load_initial(store, agency, index, T0)
    parts = store._state(store.version())[star.FACT].parts
    assert parts and all(re.fullmatch(r"open|done-0064-\d{4}-00000001", name) for name in parts)
    for name, path in parts.items():
        assert path.endswith("/_part=-1" if name == "open" else f"/_part={int(name.split('-')[2])}")


def test_later_steps_of_a_load_read_the_batch_only(spark, agency, index, monkeypatch):
    seen = []

    def noted(name, real, sales):
        def call(*args, **more):
            seen.append((name, rows(sales(args).select("transvendaid").distinct())))
            return real(*args, **more)

        monkeypatch.setattr(star, name, call)

    store = Lake(spark, fresh_path(spark, "lake"))
    star.load_initial(store, early(agency), index, T0)
    noted("unresolved_sales", star.unresolved_sales, lambda args: args[1])
    noted("participant_fact", star.participant_fact, lambda args: args[2])
    noted("touched_pairs", star.touched_pairs, lambda args: args[1])
    star.load_incremental(store, agency, None, T1)
    assert sorted(seen) == [(name, [(26,)]) for name in ("participant_fact", "touched_pairs", "unresolved_sales")]


def test_published_tables_are_written_side_by_side(spark, monkeypatch):
    both, write = Barrier(2, timeout=60), landing._write
    monkeypatch.setattr(landing, "_write", lambda *args: (both.wait(), write(*args)))
    tables = {name: frame(spark, [(1, name)], "n long, t string") for name in ("data_dimension", "cliente_dimension")}
    out = fresh_path(spark, "gold")
    assert publish_gold(tables, out, "parquet") == ["cliente_dimension", "data_dimension"] and publish_gold({}, out) == []
    assert {n: rows(spark.read.parquet(f"{out}/{n}")) for n in tables} == {n: [(1, n)] for n in tables}


def test_states_of_the_source_share_what_they_are_drawn_from(spark, tmp_path, monkeypatch):
    from dimwright.plans import testmap

    def put(name, data, schema):
        frame(spark, data, schema).write.parquet(f"{tmp_path}/{name}.parquet")

    days = [datetime(1999, 12, 31), datetime(2000, 1, 15), datetime(2000, 1, 16), None]
    put("nation", [(1, "N", 2), (2, "M", 0)], "n_nationkey long, n_name string, n_regionkey long")
    put("part", [(1, "PROMO", 5), (26, "STANDARD", 10)], "p_partkey long, p_type string, p_size int")
    put(
        "orders",
        [(i, 1, 100.0 * i, day, "1-URGENT") for i, day in enumerate(days)],
        "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    )
    put(
        "lineitem",
        [(i, 1 if i % 2 else 26, "R", day) for i, day in enumerate(days)],
        "l_orderkey long, l_partkey long, l_returnflag string, l_shipdate timestamp_ntz",
    )
    drawn = []
    monkeypatch.setattr(testmap, "materialise", lambda df, label: (drawn.append(label), materialise(df, label))[1])
    last = testmap.Source(spark, str(tmp_path))
    states = [last.at(until) for until in (testmap.CUT, testmap.MID_MONTH_CUT, None)]
    # price of the days before the cut over their areas, in ten-thousandths; part 1 has one room, 26 two
    total = [rows(state.market().filter("dormitorios = 'Total'"), "mes", "p4") for state in states]
    december, january, nowhen = date(1999, 12, 1), date(2000, 1, 1), None
    assert total == [
        [(december, 0)],
        [(december, 0), (january, 200000)],
        sorted([(december, 0), (january, 200000), (nowhen, 600000)], key=str),
    ]
    for state in states:
        assert rows(state.imovel()) == rows(state.imovel()) and joins(state.imovel()) == 0
    assert drawn.count("sold-by-day") == drawn.count("imoveltransacao") == 1
    assert len([label for label in drawn if label.startswith("imovel-")]) == 3
