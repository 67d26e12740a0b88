"""Operational tables of a property agency, derived from the test tables.

Every definition is relational, so the same rules stand in SQL for the
oracle. ``until`` gives the state of the source before that date; None is the
final state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date, datetime
from threading import RLock

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dimwright.functions import band_of
from dimwright.session import materialise

# The first load sees everything before this day, the second everything.
CUT = date(2000, 1, 1)
# A cut inside a month leaves that month's index to be revised.
MID_MONTH_CUT = date(2000, 1, 16)
TS0 = datetime(2024, 1, 1, 8, 0, 0)
TS1 = datetime(2024, 2, 1, 8, 0, 0)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tax_id(c: str) -> Column:
    return F.lpad(F.col(c).cast("string"), 11, "0")


def _postcode(c: Column) -> Column:
    return F.lpad(c.cast("string"), 8, "0")


def _before(df: DataFrame, c: str, until: date | None) -> DataFrame:
    return df if until is None else df.filter(F.col(c) < F.lit(until).cast("timestamp_ntz"))


def _days(c: str) -> Column:
    return F.datediff(F.col(c).cast("date"), F.lit(date(1990, 1, 1)))


class Tables(Mapping):
    """Operational tables by name, each defined when first asked for."""

    NAMES = (
        "funcionario",
        "corretor",
        "uf",
        "cep",
        "endereco",
        "imovel",
        "anuncio",
        "cliente",
        "transvenda",
        "imoveltransacao",
        "clientecompra",
        "clientevende",
    )

    def __init__(self, source: Source, many_items: bool):
        self._source, self._many_items = source, many_items
        self._made: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.NAMES:
            raise KeyError(name)
        if name not in self._made:
            method = "imoveltransacao_nn" if self._many_items and name == "imoveltransacao" else name
            self._made[name] = getattr(self._source, method)()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)


class Source:
    """The agency's tables over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str, until: date | None = None):
        self.spark, self.sf_dir, self.until = spark, sf_dir, until
        self._opened: dict[str, DataFrame] = {}
        self._lock = RLock()
        self._landing: dict[str, RLock] = {}

    def at(self, until: date | None) -> Source:
        """The same tables as of another day."""
        other = Source(self.spark, self.sf_dir, until)
        other._opened, other._lock, other._landing = self._opened, self._lock, self._landing
        return other

    def _landed(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """Link tables are drawn from the line items once and then read from
        where they were stored, however many joins use them. Others are landed
        or opened meanwhile."""
        with self._lock:
            turn = self._landing.setdefault(name, RLock())
        with turn:
            if name not in self._opened:
                self._opened[name] = materialise(make(), name)
            return self._opened[name]

    def _read(self, name: str) -> DataFrame:
        with self._lock:
            if name not in self._opened:
                self._opened[name] = read(self.spark, self.sf_dir, name)
            return self._opened[name]

    def orders(self) -> DataFrame:
        return _before(self._read("orders"), "o_orderdate", self.until)

    def transvenda(self) -> DataFrame:
        value = F.col("o_totalprice").cast("decimal(18,2)")
        return self.orders().select(
            F.col("o_orderkey").alias("transvendaid"),
            value.alias("transvendavalor"),
            F.col("o_orderdate").cast("date").alias("transvendadata"),
            (value * F.lit("0.06").cast("decimal(3,2)")).cast("decimal(18,4)").alias("transcomissao"),
            tax_id("o_custkey").alias("funccpf"),
        )

    def imoveltransacao(self) -> DataFrame:
        """One property per sale."""
        return self._landed(
            "imoveltransacao",
            lambda: self._read("lineitem")
            .groupBy(F.col("l_orderkey").alias("transvendaid"))
            .agg(F.min("l_partkey").alias("imovelid")),
        )

    def imoveltransacao_nn(self) -> DataFrame:
        """All properties of a sale."""
        return self._landed(
            "imoveltransacao_nn",
            lambda: self._read("lineitem")
            .select(
                F.col("l_orderkey").alias("transvendaid"), F.col("l_partkey").alias("imovelid")
            )
            .distinct(),
        )

    def _clients(self, status: str) -> DataFrame:
        return self._landed(
            f"clients-{status}",
            lambda: self._read("lineitem")
            .filter(F.col("l_linestatus") == status)
            .select("l_orderkey", "l_suppkey")
            .repartition("l_orderkey")  # a sale's links lie together, for those that count them
            .distinct()
            .select(
                F.col("l_orderkey").alias("transvendaid"), tax_id("l_suppkey").alias("clientecpf")
            ),
        )

    def clientecompra(self) -> DataFrame:
        return self._clients("O")

    def clientevende(self) -> DataFrame:
        return self._clients("F")

    def funcionario(self) -> DataFrame:
        nation = self._read("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
        return (
            self._read("customer")
            .join(nation, "c_nationkey")
            .select(
                F.col("c_name").alias("funcprimnome"),
                F.col("n_name").alias("funcultimonome"),
                tax_id("c_custkey").alias("funccpf"),
            )
        )

    def corretor(self) -> DataFrame:
        """Customers with a sale; the registration follows the priority of
        their latest one, so it changes over time."""
        mark = _days("o_orderdate") * 10 + F.substring("o_orderpriority", 1, 1).cast("int")
        return (
            self.orders()
            .groupBy("o_custkey")
            .agg((F.max(mark) % 10).alias("grade"))
            .select(
                F.concat(F.lit("R"), F.col("grade").cast("string")).alias("corretorregistro"),
                tax_id("o_custkey").alias("funccpf"),
            )
        )

    def uf(self) -> DataFrame:
        return self._read("region").select(
            F.col("r_regionkey").cast("string").alias("uf"), F.col("r_name").alias("ufestadonome")
        )

    def cep(self) -> DataFrame:
        return self._read("nation").select(
            _postcode(F.col("n_nationkey")).alias("cep"),
            F.concat(F.lit("Rua "), "n_name").alias("nmlogradouro"),
            F.concat(F.lit("São "), "n_name").alias("cepmunicipio"),
            F.col("n_regionkey").cast("string").alias("uf"),
        )

    def endereco(self) -> DataFrame:
        return self._read("part").select(
            F.col("p_partkey").alias("endid"),
            F.col("p_brand").alias("endbairro"),
            _postcode(F.col("p_partkey") % 25).alias("cep"),
        )

    def imovel(self) -> DataFrame:
        """Properties, landed once for each state: a load reads them many times."""
        return self._landed(f"imovel-{self.until}", self._properties)

    def _properties(self) -> DataFrame:
        """One whose last shipped ad came back was enlarged."""
        flag = F.when(F.col("l_returnflag") == "R", 3).when(F.col("l_returnflag") == "N", 2).otherwise(1)
        enlarged = (
            self._ads()
            .groupBy(F.col("l_partkey").alias("p_partkey"))
            .agg((F.max(_days("l_shipdate") * 4 + flag) % 4 == 3).alias("enlarged"))
        )
        return (
            self._read("part")
            .join(enlarged, "p_partkey", "left")
            .select(
                F.col("p_partkey").alias("imovelid"),
                F.when(F.col("p_type") == "PROMO", "Apartamento")
                .otherwise(F.col("p_type"))
                .alias("imoveltipo"),
                (F.col("p_partkey") % 6).cast("int").alias("imovelqtdquartos"),
                (F.col("p_size") + F.when(F.col("enlarged"), 5).otherwise(0)).alias("imovelm2"),
                F.col("p_partkey").alias("endid"),
            )
        )

    def _ads(self) -> DataFrame:
        return _before(self._read("lineitem"), "l_shipdate", self.until)

    def anuncio(self) -> DataFrame:
        return self._ads().select(
            F.col("l_partkey").alias("imovelid"),
            F.col("l_extendedprice").cast("decimal(18,2)").alias("anunciopreco"),
        )

    def cliente(self) -> DataFrame:
        nation = self._read("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
        return (
            self._read("supplier")
            .join(nation, "s_nationkey")
            .select(
                F.col("s_name").alias("clienteprimnome"),
                F.col("n_name").alias("cliultimonome"),
                tax_id("s_suppkey").alias("clientecpf"),
            )
        )

    def tables(self, many_items: bool = False) -> Tables:
        return Tables(self, many_items)

    # --- market index ---------------------------------------------------

    def _sold_by_day(self) -> DataFrame:
        """Sums of price and area of each city, day and band, over all sales;
        landed once, and every state of the index is drawn from it."""

        def make() -> DataFrame:
            sold = self.at(None)._sales_per_area()
            return sold.groupBy("n_name", "n_regionkey", "transvendadata", "faixa").agg(
                F.sum("cents").alias("cents"), F.sum("m2").alias("m2")
            )

        return self._landed("sold-by-day", make)

    def _sales_per_area(self) -> DataFrame:
        sale = self.transvenda().select("transvendaid", "transvendavalor", "transvendadata")
        part = self._read("part").select(
            F.col("p_partkey").alias("imovelid"),
            F.col("p_size").alias("m2"),
            (F.col("p_partkey") % 6).cast("int").alias("rooms"),
            (F.col("p_partkey") % 25).cast("int").alias("n_nationkey"),
        )
        nation = self._read("nation").select("n_nationkey", "n_name", "n_regionkey")
        return (
            self.imoveltransacao()
            .join(sale, "transvendaid")
            .join(part, "imovelid")
            .join(nation, "n_nationkey")
            .filter(F.col("n_regionkey") != 0)  # the index does not cover region 0
            .select(
                "n_name",
                "n_regionkey",
                "transvendadata",
                band_of("rooms").alias("faixa"),
                (F.col("transvendavalor") * 100).cast("long").alias("cents"),
                F.col("m2").cast("long").alias("m2"),
            )
        )

    def market(self) -> DataFrame:
        """Mean price per area of each city, month and band; region 1's cities
        have the total band only. Prices are whole ten-thousandths."""
        sold = _before(self._sold_by_day(), "transvendadata", self.until)
        cell = sold.select(
            "n_name",
            F.trunc("transvendadata", "MM").alias("mes"),
            "cents",
            "m2",
            F.explode(
                F.array_distinct(
                    F.array(
                        F.lit("Total"),
                        F.when(F.col("n_regionkey") == 1, "Total").otherwise(F.col("faixa")),
                    )
                )
            ).alias("dormitorios"),
        )
        return (
            cell.groupBy("n_name", "mes", "dormitorios")
            .agg(F.sum("cents").alias("cents"), F.sum("m2").alias("m2"))
            .select("n_name", "mes", "dormitorios", F.expr("cents * 100 div m2").alias("p4"))
        )

    def wide_sheet(self) -> DataFrame:
        """The index as sheet rows of text cells: a heading and a row per
        month for every city, and a summary sheet nobody should load."""
        bands = ["Total", "1D", "2D", "3D", "4D"]
        by_band = [
            F.max(F.when(F.col("dormitorios") == b, F.col("p4"))).alias(f"p{i}")
            for i, b in enumerate(bands)
        ]
        months = self.market().groupBy("n_name", "mes").agg(*by_band)
        prices = [
            F.coalesce(
                (F.col(f"p{i}").cast("decimal(18,0)") * F.lit("0.0001").cast("decimal(5,4)")).cast("string"),
                F.lit("."),
            ).alias(f"c{17 + i}")
            for i in range(5)
        ]
        # variation cells: the band's price against the total's, in hundredths
        against = [
            F.coalesce(F.expr(f"(p{i} * 100 div p0)").cast("string"), F.lit("."))
            for i in range(5)
        ]
        monthly = [c.alias(f"c{7 + i}") for i, c in enumerate(against)]
        yearly = [
            F.coalesce(F.expr(f"(p{i} * 1000 div p0)").cast("string"), F.lit(".")).alias(f"c{12 + i}")
            for i in range(5)
        ]
        rows = months.select(
            F.explode(F.array(F.concat(F.lit("Sao "), "n_name"), F.lit("Resumo"))).alias("sheet"),
            F.lit(None).cast("string").alias("c0"),
            F.col("mes").cast("string").alias("c1"),
            *monthly,
            *yearly,
            *prices,
        )
        cells = [c for c in rows.columns if c not in ("sheet", "c0", "c1")]
        heading = (
            self._read("nation")
            .filter(F.col("n_regionkey") != 0)
            .select(
                F.concat(F.lit("Sao "), "n_name").alias("sheet"),
                F.lit("Data").alias("c1"),
                *[F.lit("Total").alias(c) for c in cells],
            )
        )
        return rows.unionByName(heading, allowMissingColumns=True)


def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as changes of brokers: a signup inserts, the rest update."""
    return read(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        F.lit("corretor").alias("entity"),
        tax_id("user_id").alias("key"),
        F.when(F.col("event_type") == "signup", "I").otherwise("U").alias("action"),
        F.col("ts").cast("timestamp_ntz").alias("tstamp"),
    )
