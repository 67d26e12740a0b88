"""The sales star: dimension sources, initial and incremental loads.

``tables`` maps operational table names to DataFrames: funcionario, corretor,
uf, cep, endereco, imovel, anuncio, cliente, transvenda, imoveltransacao,
clientecompra and clientevende.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimwright.operators.dates import date_dimension
from dimwright.operators.facts import (
    COLUMNS,
    SaleDims,
    aggregate_fact,
    append_aggregate,
    bridge,
    due_sales,
    participant_fact,
    restate_parts,
    sale_fact,
    touched_pairs,
    unresolved_sales,
)
from dimwright.operators.joins import balanced_join
from dimwright.operators.market import price_and_link, price_item, sale_vs_market
from dimwright.operators.scd1 import scd1_upsert
from dimwright.operators.scd2 import (
    Merge,
    Versioned,
    current,
    scd2_extend_parts,
    scd2_initial,
    scd2_merge_parts,
    scd2_unfilled,
)
from dimwright.operators.snowflake import Level, Metric, denormalise_snowflake
from dimwright.operators.surrogate import assign_surrogate_keys, next_start
from dimwright.session import materialise, together
from dimwright.sources.lake import MARKET_TABLE
from dimwright.sources.versions import Lake, Load, empty

Tables = Mapping[str, DataFrame]

BROKER = Versioned.prefixed("cor", "cpf")
CLIENT = Versioned.prefixed("cl", "cpf")
ITEM = Versioned.prefixed("im", "id")

BROKER_ATTRS = ["cor_registro", "cor_nome", "cor_sobrenome"]
CLIENT_ATTRS = ["cl_nome", "cl_sobrenome"]
ITEM_ATTRS = [
    "im_logradouro",
    "im_bairro",
    "im_cidade",
    "im_estado",
    "im_num_anuncios",
    "im_gasto_em_anuncios",
]
ITEM_EXTRA = ["im_tipo", "im_qtd_quartos", "im_m2"]

MARKET_KEY = ["mk_cidade_norm", "mk_mes", "mk_dormitorios"]
KIND = "Apartamento"

# Settled sale rows lie in parts by hash of the sale id, so that replacing a
# sale rewrites one of them. The number is fixed by a lake's first load.
BUCKETS_CONF = "spark.dimwright.saleBuckets"
BUCKETS = 64
OPEN = -1  # stands for the part of rows a later load may add to

FACT, AGGREGATE, PARKED = "trans_venda_fact", "receita_agregada_fact", "venda_pendente"


def broker_source(t: Tables) -> DataFrame:
    # one row per person on both sides
    return t["corretor"].join(t["funcionario"], "funccpf").select(
        F.col("funccpf").alias("cor_cpf"),
        F.col("corretorregistro").alias("cor_registro"),
        F.col("funcprimnome").alias("cor_nome"),
        F.col("funcultimonome").alias("cor_sobrenome"),
    )


def client_source(t: Tables) -> DataFrame:
    return t["cliente"].select(
        F.col("clientecpf").alias("cl_cpf"),
        F.col("clienteprimnome").alias("cl_nome"),
        F.col("cliultimonome").alias("cl_sobrenome"),
    )


def item_source(t: Tables) -> DataFrame:
    flat = denormalise_snowflake(
        t["imovel"].select("imovelid", "endid"),
        [
            Level(t["endereco"].select("endid", "endbairro", "cep"), "endid"),
            Level(t["cep"].select("cep", "nmlogradouro", "cepmunicipio", "uf"), "cep"),
            Level(t["uf"].select("uf", "ufestadonome"), "uf"),
        ],
        [
            Metric(
                t["anuncio"].select("imovelid", "anunciopreco"),
                "imovelid",
                {
                    "im_num_anuncios": F.count("*").cast("int"),
                    "im_gasto_em_anuncios": F.sum("anunciopreco").cast("double"),
                },
            )
        ],
    )
    return flat.select(
        F.col("imovelid").alias("im_id"),
        F.col("nmlogradouro").alias("im_logradouro"),
        F.col("endbairro").alias("im_bairro"),
        F.col("cepmunicipio").alias("im_cidade"),
        F.col("ufestadonome").alias("im_estado"),
        "im_num_anuncios",
        "im_gasto_em_anuncios",
    )


def item_extra(t: Tables) -> DataFrame:
    return t["imovel"].select(
        F.col("imovelid").alias("im_id"),
        F.col("imoveltipo").alias("im_tipo"),
        F.col("imovelqtdquartos").alias("im_qtd_quartos"),
        F.col("imovelm2").alias("im_m2"),
    )


def market_stage(long: DataFrame) -> DataFrame:
    """Silver rows under the market dimension's column names."""
    names = {
        "cidade": "mk_cidade",
        "cidade_norm": "mk_cidade_norm",
        "mes": "mk_mes",
        "dormitorios": "mk_dormitorios",
        "preco_m2": "mk_preco_m2",
        "var_mensal": "mk_var_mensal",
        "var_12m": "mk_var_12m",
    }
    return long.select(*[F.col(a).alias(b) for a, b in names.items()])


def load_market(
    dim: DataFrame | None, stage: DataFrame, ts: datetime, mode: str, start: int | None = None
) -> DataFrame:
    return scd1_upsert(
        dim,
        stage,
        "mk_sk",
        MARKET_KEY,
        ["mk_preco_m2", "mk_var_mensal", "mk_var_12m"],
        ["mk_preco_m2", "mk_var_12m"],
        ts,
        "mk_dt_carga",
        fixed=["mk_cidade"],
        mode=mode,
        start=start,
    )


# --- storing -------------------------------------------------------------


def _put_merge(load: Load, table: str, merge: Merge) -> None:
    """Rewrite the current slice, append the versions just closed; versions
    closed by earlier loads stay where they are."""
    if merge.changes.isEmpty():
        return
    load.put(table, merge.kept.unionByName(merge.opened), "current")
    load.append(table, merge.closed, "past")


def _month_part(df: DataFrame) -> DataFrame:
    return df.withColumn("_month", (F.col("dt_sk") / 100).cast("int"))


def _market_part(df: DataFrame) -> DataFrame:
    return df.withColumn("_month", F.year("mk_mes") * 100 + F.month("mk_mes"))


def put_market(load: Load, market_long: DataFrame, ts: datetime) -> None:
    """Upsert of the staged months: only their parts are read, joined and
    written, one full outer join; of the others not more than the key column
    is read, for the largest key in use."""
    stage = materialise(market_stage(market_long), "stage")
    if not load.has(MARKET_TABLE):
        first = load_market(None, stage, ts, "insert_only")
        load.put_split(MARKET_TABLE, _market_part(first), "_month")
        return
    # as many numbers as the feed has months
    months = [str(r[0]) for r in _market_part(stage).select("_month").distinct().collect()]
    if not months:
        return
    table = load.state[MARKET_TABLE]
    near = [table.parts[m] for m in months if m in table.parts]
    spark = load.lake.spark
    held = spark.read.schema(table.schema).parquet(*near) if near else empty(spark, table.schema)
    start = next_start(load.read(MARKET_TABLE), "mk_sk")
    load.put_split(MARKET_TABLE, _market_part(load_market(held, stage, ts, "upsert", start)), "_month")


def _buckets(load: Load) -> int:
    """Number of parts the fact was begun with."""
    if load.has(FACT):
        for part in load.state[FACT].parts:
            if part.startswith("done-"):
                return int(part.split("-")[1])
    return int(load.lake.spark.conf.get(BUCKETS_CONF, str(BUCKETS)))


def _put_sales(load: Load, fresh: DataFrame | None, replaced: DataFrame | None = None) -> None:
    """Store new sale rows, which carry their item, and enrich those still open.

    Rows a later load can add nothing to are appended to their bucket, so only
    the open ones are read again. The rows held of ``replaced`` sales (tv_id)
    give way: of the settled parts only the buckets such sales lie in are
    written anew.
    """
    count = _buckets(load)
    bucket = F.pmod(F.xxhash64(F.col("tv_id").cast("long")), F.lit(count)).cast("int")
    kept, still_open = None, None
    if load.has(FACT):
        still_open = load.read(FACT, "open")
        if replaced is not None:
            still_open = balanced_join(still_open, replaced, "tv_id", "left_anti")
            touched = [r[0] for r in replaced.select(bucket.alias("b")).distinct().collect()]
            stale = [
                part for part in load.state[FACT].parts
                for b in touched if part.startswith(f"done-{count:04d}-{b:04d}-")
            ]
            if stale:
                paths = [load.state[FACT].parts[part] for part in stale]
                held = load.lake.spark.read.schema(load.state[FACT].schema).parquet(*paths)
                kept = balanced_join(held, replaced, "tv_id", "left_anti")
                for part in stale:
                    load.drop_part(FACT, part)
        load.drop_part(FACT, "open")
    if still_open is None:  # a first load has new rows only
        still_open = empty(load.lake.spark, fresh.drop("_item").schema)
    fact = price_and_link(still_open, load.read("imovel_dimension"), load.read(MARKET_TABLE), KIND, fresh)
    # parts are split by number and named once each, not row by row
    out = fact.withColumn("_part", F.when(F.col("is_settled"), bucket).otherwise(OPEN)).drop("is_settled")
    if kept is not None:
        out = out.unionByName(kept.withColumn("_part", bucket))
    load.put_split(
        FACT, out, "_part", lambda b: "open" if b == OPEN else f"done-{count:04d}-{b:04d}-{load.version:08d}"
    )


def _sale_dims(load: Load) -> SaleDims:
    return SaleDims(
        load.read("corretor_dimension"),
        load.read("imovel_dimension"),
        load.read("cliente_dimension"),
        load.read("data_dimension"),
    )


def _load_dims_initial(load: Load, t: Tables, ts: datetime, *more: Callable[[], None]) -> None:
    """All dimensions, side by side with whatever else needs none of them."""

    def versioned(table: str, rows: DataFrame, names: Versioned, attrs: list[str]) -> None:
        load.put(table, scd2_initial(rows, names, attrs, ts), "current")

    def items() -> None:
        # a first load knows all attributes, so there is nothing to fill later
        rows = item_source(t).join(item_extra(t), ITEM.nk)
        versioned("imovel_dimension", rows, ITEM, [*ITEM_ATTRS, *ITEM_EXTRA])

    together(
        load.lake.spark,
        lambda: load.put("data_dimension", date_dimension(t["transvenda"], "transvendadata")),
        lambda: versioned("corretor_dimension", broker_source(t), BROKER, BROKER_ATTRS),
        lambda: versioned("cliente_dimension", client_source(t), CLIENT, CLIENT_ATTRS),
        items,
        *more,
    )


@dataclass(frozen=True)
class Changes:
    """Keys to look at; without a feed everything is compared."""

    rows: DataFrame | None  # entity, key
    entities: frozenset[str]

    ALL = frozenset({"corretor", "cliente", "imovel", "transvenda"})

    @classmethod
    def of(cls, rows: DataFrame | None) -> Changes:
        if rows is None:
            return cls(None, cls.ALL)
        stored = materialise(rows.select("entity", "key").distinct(), "changes")
        # a handful of entity names, not the keys
        named = stored.select("entity").distinct().collect()
        return cls(stored, frozenset(r[0] for r in named))

    def keys(self, entity: str, column: str, kind: str) -> DataFrame | None:
        if self.rows is None:
            return None
        return self.rows.filter(F.col("entity") == entity).select(
            F.col("key").cast(kind).alias(column)
        )


def _load_dims_incremental(
    load: Load, t: Tables, ts: datetime, changes: Changes, *more: Callable[[], None]
) -> None:
    """Dimensions of the entities that changed, side by side; the others are
    carried over."""

    def dates() -> None:
        days = date_dimension(t["transvenda"], "transvendadata", load.read("data_dimension"))
        load.append("data_dimension", days)

    def people(table: str, names: Versioned, rows: DataFrame, attrs: list[str], entity: str) -> None:
        keys = changes.keys(entity, names.nk, "string")
        _put_merge(load, table, scd2_merge_parts(load.read(table), rows, names, attrs, ts, keys))

    steps = {
        "transvenda": dates,
        "corretor": lambda: people(
            "corretor_dimension", BROKER, broker_source(t), BROKER_ATTRS, "corretor"
        ),
        "cliente": lambda: people(
            "cliente_dimension", CLIENT, client_source(t), CLIENT_ATTRS, "cliente"
        ),
        "imovel": lambda: _load_items(load, t, ts, changes),
    }
    due = [step for entity, step in steps.items() if entity in changes.entities]
    if due or more:
        together(load.lake.spark, *due, *more)


def _load_items(load: Load, t: Tables, ts: datetime, changes: Changes) -> None:
    """Address and ads first, then type, rooms and area; written once."""
    table = "imovel_dimension"
    dim = load.read(table)
    kind = dim.schema[ITEM.nk].dataType.simpleString()
    keys = changes.keys("imovel", ITEM.nk, kind)
    base = scd2_merge_parts(dim, item_source(t), ITEM, ITEM_ATTRS, ts, keys)
    both = scd2_extend_parts(base.whole(), item_extra(t), ITEM, ITEM_EXTRA, ts, keys)
    if base.changes.isEmpty() and both.changes.isEmpty():
        # attributes first known now go into the version there is
        if scd2_unfilled(dim, item_extra(t), ITEM, ITEM_EXTRA, keys).isEmpty():
            return
    columns = base.closed.columns
    load.put(table, both.kept.unionByName(both.opened).select(*columns), "current")
    load.append(table, base.closed.unionByName(both.closed.select(*columns)), "past")


# --- participant model ---------------------------------------------------


def load_initial(lake: Lake, t: Tables, market_long: DataFrame, ts: datetime, batch: str = "") -> int:
    """Dimensions, facts, aggregate, market, unit prices and links, as one commit."""
    load = lake.begin(batch)

    def market() -> None:
        put_market(load, market_long, ts)

    # a source may draw a table when it is first asked for
    links = [partial(t.__getitem__, n) for n in ("imoveltransacao", "clientecompra", "clientevende")]
    _load_dims_initial(load, t, ts, market, *links)
    dims = _sale_dims(load)
    parked = _park(load, t, dims, None)
    # as a rule nothing is parked, and the look-up is of an empty table
    whole = balanced_join(t["transvenda"], parked.select(COLUMNS.sale), COLUMNS.sale, "left_anti")
    rows = participant_fact(
        whole, t["imoveltransacao"], t["clientecompra"], t["clientevende"], dims, carried=price_item(KIND)
    )
    agg = aggregate_fact(whole, t["imoveltransacao"], dims.item, dims.date)
    together(
        lake.spark,
        lambda: _put_sales(load, assign_surrogate_keys(rows, "tv_sk")),
        lambda: load.put_split(AGGREGATE, _month_part(assign_surrogate_keys(agg, "ra_sk")), "_month"),
    )
    return load.commit()


def _park(load: Load, t: Tables, dims: SaleDims, ids: DataFrame | None) -> DataFrame:
    """Stores which of the sales cannot become rows yet, and since when; later
    loads try these again, whatever their feed names."""
    parked = unresolved_sales(
        ids, t["transvenda"], t["imoveltransacao"], t["clientecompra"], t["clientevende"], dims
    )
    since = F.lit(load.version).cast("long")
    if load.has(PARKED):
        before = load.read(PARKED).select(COLUMNS.sale, F.col("since").alias("_since"))
        parked = balanced_join(parked, before, COLUMNS.sale, "left")
        since = F.coalesce("_since", since)
    load.put(PARKED, parked.select(COLUMNS.sale, "missing", since.alias("since")))
    return load.read(PARKED)


def load_incremental(
    lake: Lake,
    t: Tables,
    market_long: DataFrame | None,
    ts: datetime,
    changes: DataFrame | None = None,
    batch: str = "",
) -> int:
    """One incremental load, as one commit.

    ``changes`` (entity, key) comes from the change feed and limits dimensions
    and sales to the keys it names; without it everything is compared. A batch
    already committed is not applied again.
    """
    if batch and lake.has_batch(batch):
        return lake.version()
    load = lake.begin(batch)
    seen = Changes.of(changes)

    def market() -> None:
        put_market(load, market_long, ts)

    _load_dims_incremental(load, t, ts, seen, *([market] if market_long is not None else []))
    parked = load.read(PARKED).select(COLUMNS.sale)
    waiting = not parked.isEmpty()
    if "transvenda" not in seen.entities and not waiting:
        if market_long is not None or "imovel" in seen.entities:
            _put_sales(load, None)
        return load.commit()

    held = load.read(FACT)
    links = t["imoveltransacao"], t["clientecompra"], t["clientevende"]
    named = _named_sales(t, seen).unionByName(parked)
    due = materialise(due_sales(named, *links, held, every=seen.rows is None), "due")
    dims = _sale_dims(load)
    near = _of_sales(t, due)
    stay = _park(load, near, dims, due).select(COLUMNS.sale)
    ready = materialise(balanced_join(due, stay, COLUMNS.sale, "left_anti"), "ready")
    rows = participant_fact(*near.values(), dims, new_sales=ready, carried=price_item(KIND))
    replaced = materialise(
        ready.filter("is_held").select(F.col(COLUMNS.sale).alias("tv_id")), "replaced"
    )

    def sales() -> None:
        keyed = assign_surrogate_keys(rows, "tv_sk", start=next_start(held, "tv_sk"))
        _put_sales(load, keyed, replaced)

    now_held = held.select(F.col("tv_id").alias(COLUMNS.sale)).unionByName(ready.select(COLUMNS.sale))
    together(lake.spark, sales, lambda: _restate_months(load, t, near, ready.select(COLUMNS.sale), now_held))
    return load.commit()


def _of_sales(t: Tables, ids: DataFrame) -> dict[str, DataFrame]:
    """Sales, items and participants of the given sales, stored: what follows
    reads each of them several times, and no more than the batch."""
    c = COLUMNS
    of = {
        "transvenda": [c.sale, c.value, c.commission, c.date, c.broker],
        "imoveltransacao": [c.sale, c.item],
        "clientecompra": [c.sale, c.client],
        "clientevende": [c.sale, c.client],
    }
    cut = {n: balanced_join(t[n].select(*names), ids.select(c.sale), c.sale, "left_semi") for n, names in of.items()}
    stored = together(ids.sparkSession, *[partial(materialise, df, n) for n, df in cut.items()])
    return dict(zip(cut, stored))


def _named_sales(t: Tables, changes: Changes) -> DataFrame:
    """Sales the feed names; without a feed all of them."""
    kind = t["transvenda"].schema[COLUMNS.sale].dataType.simpleString()
    told = changes.keys("transvenda", COLUMNS.sale, kind)
    return t["transvenda"].select(COLUMNS.sale) if told is None else told


def _restate_months(load: Load, t: Tables, near: Tables, new_sales: DataFrame, held: DataFrame) -> None:
    """Recompute touched pairs from the sales the fact holds; only the months
    they lie in are rewritten, each read once and its kept rows found once.
    The new sales' own rows are among those of ``near``."""
    table = AGGREGATE
    sale, lines = t["transvenda"], t["imoveltransacao"]
    agg = load.read(table)
    touched = materialise(touched_pairs(new_sales, near["transvenda"], near["imoveltransacao"]), "touched")
    touched_months = touched.select((F.year(COLUMNS.date) * 100 + F.month(COLUMNS.date)).alias("_month"))
    months = [str(r[0]) for r in touched_months.distinct().collect()]
    if not months:
        return
    parts = load.state[table].parts
    near = [parts[m] for m in months if m in parts]
    spark = load.lake.spark
    near_agg = (
        spark.read.schema(agg.schema).parquet(*near)
        if near
        else empty(spark, agg.schema)
    )
    # a column more than an aggregate has goes along with the rows that stay
    kept, fresh = restate_parts(
        near_agg, new_sales, sale, lines, load.read("imovel_dimension"), load.read("data_dimension"), held=held,
        touched=touched,
    )
    keyed = assign_surrogate_keys(fresh, "ra_sk", start=next_start(agg, "ra_sk"))
    load.put_split(table, _month_part(kept.unionByName(keyed)).select(*agg.columns, "_month"), "_month")


def star_view(lake: Lake) -> DataFrame:
    """Sales against the market, over the newest commit."""
    return sale_vs_market(
        lake.table("trans_venda_fact"),
        lake.table("corretor_dimension"),
        lake.table("imovel_dimension"),
        lake.table("data_dimension"),
        lake.table(MARKET_TABLE),
    )


def gold_tables(lake: Lake) -> dict[str, DataFrame]:
    kept = [n for n in lake.tables() if n != PARKED]  # parked sales are state, not star
    return {n: lake.table(n) for n in kept} | {"vw_venda_vs_mercado": star_view(lake)}


# --- bridge model --------------------------------------------------------


def load_bridge_initial(lake: Lake, t: Tables, ts: datetime) -> int:
    """The variant with one fact row per sale x item and two bridges."""
    load = lake.begin()
    _load_dims_initial(load, t, ts)
    fact = sale_fact(t["transvenda"], t["imoveltransacao"], _sale_dims(load))
    load.put("trans_venda_fact", assign_surrogate_keys(fact, "tv_sk"))
    _put_bridges(load, t)
    agg = aggregate_fact(
        t["transvenda"], t["imoveltransacao"], load.read("imovel_dimension"), load.read("data_dimension")
    )
    load.put("receita_agregada_fact", assign_surrogate_keys(agg, "ra_sk"))
    return load.commit()


def load_bridge_incremental(lake: Lake, t: Tables, ts: datetime) -> int:
    """Full comparison; facts, bridges and aggregate rows are only appended."""
    load = lake.begin()
    _load_dims_incremental(load, t, ts, Changes.of(None))
    held = load.read("trans_venda_fact")
    rows = sale_fact(t["transvenda"], t["imoveltransacao"], _sale_dims(load), existing=held)
    load.append(
        "trans_venda_fact",
        assign_surrogate_keys(rows, "tv_sk", start=next_start(held, "tv_sk")).select(*held.columns),
    )
    _put_bridges(load, t, ts, held)
    agg = load.read("receita_agregada_fact")
    fresh = aggregate_fact(
        t["transvenda"], t["imoveltransacao"], load.read("imovel_dimension"), load.read("data_dimension")
    )
    added = assign_surrogate_keys(
        append_aggregate(agg, fresh), "ra_sk", start=next_start(agg, "ra_sk")
    )
    load.append("receita_agregada_fact", added.select(*agg.columns))
    return load.commit()


def _put_bridges(load: Load, t: Tables, ts: datetime | None = None, before: DataFrame | None = None) -> None:
    """Pairs of both roles. A later load looks only at links of sales the fact
    did not hold ``before`` and of clients that got a version at ``ts``: the
    first meet the fact rows this load added, whose keys no bridge can hold
    yet; of the pairs held, only those of the second are compared."""
    clients = current(load.read("cliente_dimension"), CLIENT)
    for table, link in (("vendedor_ponte", "clientevende"), ("comprador_ponte", "clientecompra")):
        links = t[link].select(COLUMNS.sale, COLUMNS.client)
        if before is None:
            load.append(table, bridge(load.read(FACT), links, clients))
            continue
        added = load.read(FACT, f"seg-{load.version:08d}")
        renewed = clients.filter(F.col(CLIENT.valid_from) == F.lit(ts).cast("timestamp_ntz"))
        names = renewed.select(F.col(CLIENT.nk).alias(COLUMNS.client))
        old = balanced_join(links, names, COLUMNS.client, "left_semi")
        held = balanced_join(load.read(table), renewed.select("cl_sk"), "cl_sk", "left_semi")
        pairs = bridge(added, links, clients).unionByName(bridge(before, old, clients, existing=held))
        load.append(table, pairs)
