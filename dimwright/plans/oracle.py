"""The queries once more, as plain SQL over the test tables.

Each statement is written from the meaning of its operator (row_number,
EXISTS, correlated counts, ...), not from the Spark plan. ``{s}`` names the
state of the source: f final, e before the cut, m before the mid-month cut,
j before the first February.
"""

from __future__ import annotations

import re

from dimwright.plans.testmap import CUT, MID_MONTH_CUT, TS0, TS1

_UNTIL = {"f": None, "e": CUT, "m": MID_MONTH_CUT, "j": "1995-02-01"}

ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇ"
PLAIN = "aaaaaeeeeiiiiooooouuuucAAAAAEEEEIIIIOOOOOUUUUC"


def _fold(expr: str) -> str:
    # the sharp s has no one-letter upper case here
    return f"replace(upper(translate(trim({expr}), '{ACCENTED}', '{PLAIN}')), 'ẞ', 'ß')"


def _ts(value) -> str:
    return "CAST(NULL AS TIMESTAMP)" if value is None else f"TIMESTAMP '{value}'"


_FIXED = {
    "imoveltransacao": """
        SELECT l_orderkey AS transvendaid, min(l_partkey) AS imovelid FROM lineitem GROUP BY 1""",
    "imoveltransacao_nn": """
        SELECT DISTINCT l_orderkey AS transvendaid, l_partkey AS imovelid FROM lineitem""",
    "clientecompra": """
        SELECT DISTINCT l_orderkey AS transvendaid, lpad(CAST(l_suppkey AS VARCHAR), 11, '0') AS clientecpf
        FROM lineitem WHERE l_linestatus = 'O'""",
    "clientevende": """
        SELECT DISTINCT l_orderkey AS transvendaid, lpad(CAST(l_suppkey AS VARCHAR), 11, '0') AS clientecpf
        FROM lineitem WHERE l_linestatus = 'F'""",
    "cl_dim": """
        SELECT row_number() OVER (ORDER BY s_suppkey) AS cl_sk,
               lpad(CAST(s_suppkey AS VARCHAR), 11, '0') AS cl_cpf
        FROM supplier JOIN nation ON n_nationkey = s_nationkey""",
    "feed": """
        SELECT event_id AS seq, 'corretor' AS entity, lpad(CAST(user_id AS VARCHAR), 11, '0') AS key,
               CASE WHEN event_type = 'signup' THEN 'I' ELSE 'U' END AS action, ts AS tstamp
        FROM events""",
}

_BY_STATE = {
    "venda_{s}": """
        SELECT o_orderkey AS transvendaid, CAST(o_totalprice AS DECIMAL(18,2)) AS valor,
               CAST(o_orderdate AS DATE) AS dia,
               CAST(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.06 AS DECIMAL(3,2)) AS DECIMAL(18,4)) AS comissao,
               lpad(CAST(o_custkey AS VARCHAR), 11, '0') AS funccpf,
               o_custkey, o_orderpriority, o_orderdate
        FROM orders{orders_until}""",
    "ads_{s}": "SELECT * FROM lineitem{ads_until}",
    "cor_src_{s}": """
        SELECT v.funccpf AS cor_cpf, 'R' || substr(v.o_orderpriority, 1, 1) AS cor_registro,
               c_name AS cor_nome, n_name AS cor_sobrenome
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
                     ORDER BY dia DESC, CAST(substr(o_orderpriority, 1, 1) AS INT) DESC) AS r
              FROM venda_{s}) v
        JOIN customer ON c_custkey = v.o_custkey
        JOIN nation ON n_nationkey = c_nationkey
        WHERE v.r = 1""",
    "cor_dim_{s}": "SELECT row_number() OVER (ORDER BY cor_cpf) AS cor_sk, * FROM cor_src_{s}",
    "im_src_{s}": """
        SELECT p_partkey AS im_id, 'Rua ' || n_name AS im_logradouro, p_brand AS im_bairro,
               'São ' || n_name AS im_cidade, r_name AS im_estado,
               CAST((SELECT count(*) FROM ads_{s} a WHERE a.l_partkey = p_partkey) AS INT) AS im_num_anuncios,
               CAST(coalesce((SELECT sum(CAST(l_extendedprice AS DECIMAL(18,2))) FROM ads_{s} a
                              WHERE a.l_partkey = p_partkey), 0) AS DOUBLE) AS im_gasto_em_anuncios
        FROM part
        JOIN nation ON n_nationkey = p_partkey % 25
        JOIN region ON r_regionkey = n_regionkey""",
    "im_extra_{s}": """
        SELECT p_partkey AS im_id,
               CASE WHEN p_type = 'PROMO' THEN 'Apartamento' ELSE p_type END AS im_tipo,
               CAST(p_partkey % 6 AS INT) AS im_qtd_quartos,
               p_size + CASE WHEN last.l_returnflag = 'R' THEN 5 ELSE 0 END AS im_m2
        FROM part LEFT JOIN (
            SELECT l_partkey, l_returnflag,
                   row_number() OVER (PARTITION BY l_partkey ORDER BY CAST(l_shipdate AS DATE) DESC,
                     CASE l_returnflag WHEN 'R' THEN 3 WHEN 'N' THEN 2 ELSE 1 END DESC) AS r
            FROM ads_{s}) last
          ON last.l_partkey = p_partkey AND last.r = 1""",
    "im_dim_{s}": """
        SELECT row_number() OVER (ORDER BY im_id) AS im_sk, * FROM im_src_{s} JOIN im_extra_{s} USING (im_id)""",
    "sold_{s}": """
        SELECT n_name, n_regionkey, CAST(date_trunc('month', v.dia) AS DATE) AS mes,
               CASE WHEN p_partkey % 6 >= 1 THEN CAST(least(p_partkey % 6, 4) AS VARCHAR) || 'D' ELSE 'Total' END AS faixa,
               CAST(v.valor * 100 AS BIGINT) AS cents, CAST(p_size AS BIGINT) AS m2
        FROM imoveltransacao it
        JOIN venda_{s} v USING (transvendaid)
        JOIN part ON p_partkey = it.imovelid
        JOIN nation ON n_nationkey = p_partkey % 25
        WHERE n_regionkey <> 0""",
    "market_{s}": """
        SELECT n_name, mes, dormitorios, (sum(cents) * 100) // sum(m2) AS p4
        FROM (SELECT n_name, mes, 'Total' AS dormitorios, cents, m2 FROM sold_{s}
              UNION ALL
              SELECT n_name, mes, faixa, cents, m2 FROM sold_{s} WHERE n_regionkey <> 1 AND faixa <> 'Total')
        GROUP BY n_name, mes, dormitorios""",
    "long_{s}": """
        SELECT 'Sao ' || m.n_name AS cidade, 'SAO ' || m.n_name AS cidade_norm, m.mes, m.dormitorios,
               CAST((m.p4 + 50) // 100 AS DOUBLE) / 100 AS preco_m2,
               CAST((m.p4 * 100) // t.p4 AS DOUBLE) AS var_mensal,
               CAST((m.p4 * 1000) // t.p4 AS DOUBLE) AS var_12m
        FROM market_{s} m
        JOIN market_{s} t ON t.n_name = m.n_name AND t.mes = m.mes AND t.dormitorios = 'Total'""",
    "mk_dim_{s}": """
        SELECT row_number() OVER (ORDER BY cidade_norm, mes, dormitorios) AS mk_sk, cidade AS mk_cidade,
               cidade_norm AS mk_cidade_norm, mes AS mk_mes, dormitorios AS mk_dormitorios,
               preco_m2 AS mk_preco_m2, var_mensal AS mk_var_mensal, var_12m AS mk_var_12m
        FROM long_{s}""",
    # sale x item with keys; dimensions are always the final state's
    "lines_{s}": """
        SELECT v.transvendaid AS tv_id, CAST(v.valor AS DOUBLE) AS tv_valor, v.valor, v.comissao,
               CAST(v.comissao AS DOUBLE) AS tv_comissao, cor_sk, im_sk, im_id,
               CAST(strftime(v.dia, '%Y%m%d') AS INT) AS dt_sk, v.dia
        FROM venda_{s} v
        JOIN imoveltransacao it USING (transvendaid)
        JOIN cor_dim_f ON cor_cpf = v.funccpf
        JOIN im_dim_f ON im_id = it.imovelid""",
    "lines_nn_{s}": """
        SELECT v.transvendaid AS tv_id, CAST(v.valor AS DOUBLE) AS tv_valor, v.valor, v.comissao,
               CAST(v.comissao AS DOUBLE) AS tv_comissao, cor_sk, im_sk, im_id,
               CAST(strftime(v.dia, '%Y%m%d') AS INT) AS dt_sk, v.dia
        FROM venda_{s} v
        JOIN imoveltransacao_nn it USING (transvendaid)
        JOIN cor_dim_f ON cor_cpf = v.funccpf
        JOIN im_dim_f ON im_id = it.imovelid""",
    "link_{s}": """
        WITH flats AS (
          SELECT l.tv_id, l.im_sk, l.dt_sk, date_trunc('month', l.dia)::DATE AS first_day, FOLD(d.im_cidade) AS place,
                 CASE WHEN d.im_qtd_quartos > 0 THEN concat(least(d.im_qtd_quartos, 4), 'D') END AS band
          FROM lines_{s} l JOIN im_dim_f d ON d.im_sk = l.im_sk AND d.im_tipo = 'Apartamento')
        SELECT f.tv_id, f.im_sk, f.dt_sk, coalesce(own.mk_sk, whole.mk_sk) AS mk_sk
        FROM flats f
        LEFT JOIN mk_dim_f own ON own.mk_cidade_norm = f.place AND own.mk_mes = f.first_day
             AND own.mk_dormitorios = f.band
        LEFT JOIN mk_dim_f whole ON whole.mk_cidade_norm = f.place AND whole.mk_mes = f.first_day
             AND whole.mk_dormitorios = 'Total'""",
    "view_{s}": """
        SELECT l.tv_id, l.cor_sk, l.im_sk, l.dt_sk, k.mk_sk,
               CAST((SELECT count(*) FROM clientecompra x WHERE x.transvendaid = l.tv_id) AS INT) AS tv_total_compradores,
               CAST((SELECT count(*) FROM clientevende x WHERE x.transvendaid = l.tv_id) AS INT) AS tv_total_vendedores,
               l.dia AS dt_data_completa, cor_nome || ' ' || cor_sobrenome AS corretor,
               im_cidade, im_estado, im_bairro, im_tipo, im_qtd_quartos, im_m2,
               l.tv_valor, l.tv_comissao, l.tv_valor / nullif(CAST(im_m2 AS DOUBLE), 0) AS tv_valor_m2,
               mk_preco_m2, mk_var_12m, mk_mes,
               CASE WHEN mk_preco_m2 IS NOT NULL
                    THEN l.tv_valor / nullif(CAST(im_m2 AS DOUBLE), 0) / mk_preco_m2 - 1 END AS agio_vs_mercado
        FROM lines_{s} l
        JOIN im_dim_f USING (im_sk)
        JOIN cor_dim_f USING (cor_sk)
        LEFT JOIN link_{s} k ON k.tv_id = l.tv_id
        LEFT JOIN mk_dim_f m ON m.mk_sk = k.mk_sk""",
}


def _participants(lines: str) -> str:
    branches = []
    for role, link in (("COMPRADOR", "clientecompra"), ("VENDEDOR", "clientevende")):
        branches.append(f"""
        SELECT l.*, x.clientecpf, '{role}' AS tv_tipo_cliente,
               (SELECT count(*) FROM {link} y WHERE y.transvendaid = l.tv_id) AS peers
        FROM {lines} l JOIN {link} x ON x.transvendaid = l.tv_id""")
    return f"""
        SELECT p.tv_id, p.tv_valor, p.tv_valor / p.peers AS tv_valor_cliente, p.tv_comissao,
               p.tv_comissao / p.peers AS tv_comissao_cliente, p.tv_tipo_cliente,
               CAST((SELECT count(*) FROM clientecompra b WHERE b.transvendaid = p.tv_id) AS INT) AS tv_total_compradores,
               CAST((SELECT count(*) FROM clientevende b WHERE b.transvendaid = p.tv_id) AS INT) AS tv_total_vendedores,
               p.cor_sk, p.im_sk, cl_sk, p.dt_sk
        FROM ({" UNION ALL ".join(branches)}) p
        JOIN cl_dim ON cl_cpf = p.clientecpf"""


def _merged_brokers(scope: str) -> str:
    """Closed, kept and opened versions; ``scope`` limits the second load."""
    return f"""
    , src AS (SELECT * FROM cor_src_f WHERE {scope})
    , gone AS (SELECT d.cor_cpf FROM cor_dim_e d JOIN src s USING (cor_cpf)
               WHERE d.cor_registro <> s.cor_registro OR d.cor_nome <> s.cor_nome
                  OR d.cor_sobrenome <> s.cor_sobrenome)
    SELECT cor_sk, cor_cpf, cor_registro, cor_nome, cor_sobrenome, {_ts(TS0)} AS cor_dt_inicio,
           CASE WHEN cor_cpf IN (SELECT cor_cpf FROM gone) THEN {_ts(TS1)} END AS cor_dt_fim,
           cor_cpf NOT IN (SELECT cor_cpf FROM gone) AS cor_is_atual
    FROM cor_dim_e
    UNION ALL
    SELECT (SELECT max(cor_sk) FROM cor_dim_e) + row_number() OVER (ORDER BY cor_cpf),
           cor_cpf, cor_registro, cor_nome, cor_sobrenome, {_ts(TS1)}, {_ts(None)}, TRUE
    FROM src
    WHERE cor_cpf IN (SELECT cor_cpf FROM gone) OR cor_cpf NOT IN (SELECT cor_cpf FROM cor_dim_e)"""


def _second_market(revise: bool) -> str:
    differs = (
        "(o.mk_preco_m2 IS DISTINCT FROM n.mk_preco_m2 OR o.mk_var_12m IS DISTINCT FROM n.mk_var_12m)"
        if revise
        else "FALSE"
    )
    key = "n.mk_cidade_norm = o.mk_cidade_norm AND n.mk_mes = o.mk_mes AND n.mk_dormitorios = o.mk_dormitorios"
    picked = ", ".join(
        f"CASE WHEN n.mk_sk IS NOT NULL AND {differs} THEN n.{c} ELSE o.{c} END AS {c}"
        for c in ("mk_preco_m2", "mk_var_mensal", "mk_var_12m")
    )
    return f"""
    SELECT o.mk_sk, o.mk_cidade, o.mk_cidade_norm, o.mk_mes, o.mk_dormitorios, {picked},
           CASE WHEN n.mk_sk IS NOT NULL AND {differs} THEN {_ts(TS1)} ELSE {_ts(TS0)} END AS mk_dt_carga
    FROM mk_dim_m o LEFT JOIN mk_dim_f n ON {key}
    UNION ALL
    SELECT (SELECT max(mk_sk) FROM mk_dim_m)
             + row_number() OVER (ORDER BY n.mk_cidade_norm, n.mk_mes, n.mk_dormitorios),
           n.mk_cidade, n.mk_cidade_norm, n.mk_mes, n.mk_dormitorios,
           n.mk_preco_m2, n.mk_var_mensal, n.mk_var_12m, {_ts(TS1)}
    FROM mk_dim_f n WHERE NOT EXISTS (SELECT 1 FROM mk_dim_m o WHERE {key})"""


def _measures(by: str) -> str:
    keys, group = (f"{by},", f"GROUP BY {by}") if by else ("", "")
    where = "WHERE mk_mes IS NOT NULL" if by == "mk_mes" else ""

    def mean(column: str) -> str:
        total = f"CAST(sum(CAST({column} AS DECIMAL(28, 10))) * 10000000000 AS HUGEINT)"
        half_up = f"(2 * abs({total}) + 100000 * count({column})) // (200000 * count({column}))"
        return f"CASE WHEN count({column}) > 0 THEN CAST(sign({total}) * ({half_up}) AS DOUBLE) / 100000 END"

    return f"""
    SELECT {keys} {mean("agio_vs_mercado")} AS agio_medio,
           {mean("tv_valor_m2")} AS preco_m2_nosso,
           {mean("mk_preco_m2")} AS preco_m2_mercado,
           count(agio_vs_mercado) AS vendas_com_benchmark
    FROM view_f {where} {group}"""


def _natural_participants() -> str:
    return f"""
    SELECT p.tv_id, cor_cpf, im_id, cl_cpf, p.dt_sk, p.tv_tipo_cliente, p.tv_valor, p.tv_valor_cliente,
           p.tv_comissao_cliente, p.tv_total_compradores, p.tv_total_vendedores
    FROM ({_participants("lines_f")}) p JOIN cor_dim_f USING (cor_sk) JOIN im_dim_f USING (im_sk) JOIN cl_dim USING (cl_sk)"""


# After the first batch the dimensions are the early ones: clients with a
# number divisible by 7 are not there, nor brokers without an early sale.
_WAITING = """
    , waiting AS (
        SELECT transvendaid, string_agg(DISTINCT what, ',' ORDER BY what) AS missing FROM (
            SELECT transvendaid, 'broker' AS what FROM venda_f WHERE funccpf NOT IN (SELECT cor_cpf FROM cor_src_e)
            UNION ALL
            SELECT transvendaid, 'client' FROM venda_f JOIN (SELECT * FROM clientecompra UNION ALL SELECT * FROM clientevende) x
                USING (transvendaid) WHERE CAST(clientecpf AS BIGINT) % 7 = 0
            UNION ALL
            SELECT transvendaid, 'items' FROM venda_f WHERE transvendaid NOT IN (SELECT transvendaid FROM imoveltransacao)
            UNION ALL
            SELECT transvendaid, 'participants' FROM venda_f WHERE transvendaid NOT IN (
                SELECT transvendaid FROM clientecompra UNION ALL SELECT transvendaid FROM clientevende)) w
        GROUP BY transvendaid)"""


_TEXTS = {
    "region": ["r_name"], "nation": ["n_name"], "customer": ["c_name", "c_mktsegment"], "supplier": ["s_name"],
    "part": ["p_name", "p_brand", "p_type"], "orders": ["o_orderstatus", "o_orderpriority"],
    "lineitem": ["l_returnflag", "l_linestatus"], "events": ["event_type", "props"],
    "documents": ["text", "lang", "source"], "pages": ["url", "html"], "benchmark": ["text"], "labels": [],
    "conversations": ["role", "text"], "embeddings": [],
}


def _text_digests() -> str:
    rows = []
    for table, columns in _TEXTS.items():
        for c in columns or [""]:
            digest = f"coalesce(sum(CAST('0x' || substr(md5({c}), 1, 8) AS BIGINT)), 0)" if c else "0"
            rows.append(
                f"SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS n_rows, "
                f"{f'count(*) - count({c})' if c else '0'}::BIGINT AS n_null, CAST({digest} AS BIGINT) AS digest FROM {table}"
            )
    return " UNION ALL ".join(rows)


def _star_constraints() -> str:
    """Two loads of a sound source leave no fault but the planted ones."""
    clean = [(t, "not_null", c) for t, cs in {
        "corretor_dimension": ("cor_sk", "cor_cpf", "cor_dt_inicio", "cor_is_atual"),
        "cliente_dimension": ("cl_sk", "cl_cpf", "cl_dt_inicio", "cl_is_atual"),
        "imovel_dimension": ("im_sk", "im_id", "im_dt_inicio", "im_is_atual"),
        "trans_venda_fact": ("tv_id", "tv_valor", "tv_tipo_cliente"),
        "mercado_dimension": ("mk_preco_m2",),
    }.items() for c in cs]
    clean += [
        ("corretor_dimension", "unique", "cor_sk"),
        ("cliente_dimension", "unique", "cl_sk"),
        ("imovel_dimension", "unique", "im_sk"),
        ("trans_venda_fact", "unique", "tv_sk"),
        ("trans_venda_fact", "unique", "tv_id,im_sk,cl_sk,tv_tipo_cliente"),
        ("receita_agregada_fact", "unique", "im_sk,dt_sk"),
        ("mercado_dimension", "unique", "mk_sk"),
        ("mercado_dimension", "unique", "mk_cidade_norm,mk_mes,mk_dormitorios"),
        *[("trans_venda_fact", "foreign_key", c) for c in ("cor_sk", "cl_sk", "im_sk", "mk_sk")],
        ("receita_agregada_fact", "foreign_key", "im_sk"),
        ("receita_agregada_fact", "foreign_key", "dt_sk"),
    ]
    for table, key in (("corretor_dimension", "cor_cpf"), ("cliente_dimension", "cl_cpf"), ("imovel_dimension", "im_id")):
        clean += [(table, rule, key) for rule in ("overlap", "gap", "one_current", "open_end", "backwards")]
    rows = ", ".join(f"('{t}', '{r}', '{c}', CAST(0 AS BIGINT))" for t, r, c in clean)
    facts = _participants("lines_f")
    # two rows of a sale that only differed in the role are one after the fault
    return f"""
        , clean(table_name, rule, subject, violations) AS (VALUES {rows})
        , fact AS ({facts})
        , twice AS (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS v FROM (
              SELECT count(*) AS n FROM fact WHERE tv_id % 10 = 0 GROUP BY tv_id, im_sk, cl_sk))
        SELECT table_name, rule, subject,
               CASE WHEN subject = 'tv_id,im_sk,cl_sk,tv_tipo_cliente' THEN (SELECT v FROM twice) ELSE violations END AS violations
        FROM clean
        UNION ALL SELECT 'trans_venda_fact', 'domain', 'tv_tipo_cliente', (SELECT count(*) FROM fact WHERE tv_id % 10 = 0)
        UNION ALL SELECT 'trans_venda_fact', 'foreign_key', 'dt_sk', (SELECT count(*) FROM fact WHERE tv_id % 13 = 0)"""


def _snapshot_feed() -> str:
    """Every captured table: I for further rows of a key, U for other ones."""
    sold = "(SELECT transvendaid FROM venda_e)"
    parts = {
        "corretor": """SELECT n.cor_cpf, CASE WHEN o.cor_cpf IS NULL THEN 'I' ELSE 'U' END
            FROM cor_src_f n LEFT JOIN cor_src_e o USING (cor_cpf)
            WHERE o.cor_cpf IS NULL OR o.cor_registro <> n.cor_registro""",
        "cliente": """SELECT lpad(CAST(s_suppkey AS VARCHAR), 11, '0'), CASE WHEN s_suppkey % 7 = 0 THEN 'I' ELSE 'U' END
            FROM supplier JOIN nation ON n_nationkey = s_nationkey
            WHERE s_suppkey % 7 = 0 OR (s_suppkey % 5 = 0 AND upper(s_name) <> s_name)""",
        "imovel": """SELECT CAST(im_id AS VARCHAR), 'U' FROM im_extra_f n JOIN im_extra_e o USING (im_id)
            WHERE o.im_m2 <> n.im_m2""",
        "anuncio": f"""SELECT DISTINCT CAST(l_partkey AS VARCHAR), 'I' FROM lineitem
            WHERE l_shipdate >= TIMESTAMP '{CUT}'""",
        "transvenda": f"SELECT CAST(transvendaid AS VARCHAR), 'I' FROM venda_f WHERE transvendaid NOT IN {sold}",
        "clientecompra": f"SELECT DISTINCT CAST(transvendaid AS VARCHAR), 'I' FROM clientecompra WHERE transvendaid NOT IN {sold}",
        "clientevende": f"SELECT DISTINCT CAST(transvendaid AS VARCHAR), 'I' FROM clientevende WHERE transvendaid NOT IN {sold}",
    }
    rows = " UNION ALL ".join(f"SELECT '{entity}' AS entity, k AS key, a AS action FROM ({sql}) t(k, a)" for entity, sql in parts.items())
    return f"SELECT row_number() OVER (ORDER BY entity, key) AS seq, entity, key, action FROM ({rows}) r"


_DATE_COLUMNS = """CAST(strftime(dia, '%Y%m%d') AS INT) AS dt_sk, dia AS dt_data_completa,
           CAST(date_part('dow', dia) AS INT) AS dt_dia_semana, CAST(date_part('day', dia) AS INT) AS dt_dia_mes,
           CAST(date_part('month', dia) AS INT) AS dt_mes, CAST(date_part('year', dia) AS INT) AS dt_ano,
           CAST(date_part('quarter', dia) AS INT) AS dt_trimestre"""

_TOTALS = [
    ("nation", "n_nationkey", None),
    ("region", "r_regionkey", None),
    ("customer", "c_custkey", "c_acctbal"),
    ("supplier", "s_suppkey", "s_acctbal"),
    ("part", "p_partkey", "p_retailprice"),
    ("orders", "o_orderkey", "o_totalprice"),
    ("lineitem", "l_orderkey", "l_extendedprice"),
]

_OLD_AGG = """
    , old_agg AS (SELECT im_sk, dt_sk, CAST(sum(comissao * 2) AS DOUBLE) AS ra_comissao_total
                  FROM lines_e GROUP BY im_sk, dt_sk)
    , now_agg AS (SELECT im_sk, dt_sk, CAST(sum(comissao) AS DOUBLE) AS ra_comissao_total
                  FROM lines_f GROUP BY im_sk, dt_sk)"""

_FACT_KEYS = """
    , first AS (SELECT tv_id, row_number() OVER (ORDER BY tv_id) AS tv_sk FROM lines_e)
    , keyed AS (SELECT * FROM first UNION ALL
               SELECT tv_id, (SELECT max(tv_sk) FROM first) + row_number() OVER (ORDER BY tv_id)
               FROM lines_f WHERE tv_id NOT IN (SELECT tv_id FROM first))"""


def _bridge(link: str) -> str:
    return f"""
    SELECT f.tv_sk, cl_sk
    FROM (SELECT tv_id, row_number() OVER (ORDER BY tv_id) AS tv_sk FROM lines_f) f
    JOIN {link} x ON x.transvendaid = f.tv_id JOIN cl_dim ON cl_cpf = x.clientecpf"""


_SALE_COLUMNS = "tv_id, tv_valor, tv_comissao, cor_sk, im_sk, dt_sk"

_RECONCILE_SIDES = {
    "origem": """SELECT sum(valor) AS valor, sum(comissao) AS comissao FROM venda_f
                 WHERE transvendaid IN (SELECT transvendaid FROM imoveltransacao_nn)""",
    "origem_itens": "SELECT sum(valor) AS valor, sum(comissao) AS comissao FROM lines_nn_f",
    "fato": "SELECT sum(valor) AS valor, sum(comissao) AS comissao FROM lines_nn_f",
}


def _reconcile() -> str:
    for side, link in (("compradores", "clientecompra"), ("vendedores", "clientevende")):
        _RECONCILE_SIDES[side] = f"""
        SELECT sum(CAST(l.valor AS DOUBLE) / n) AS valor, sum(CAST(l.comissao AS DOUBLE) / n) AS comissao
        FROM lines_nn_f l JOIN {link} x ON x.transvendaid = l.tv_id
        JOIN (SELECT transvendaid, count(*) AS n FROM {link} GROUP BY 1) c ON c.transvendaid = l.tv_id"""
    ctes = "".join(f", s_{k} AS ({v})" for k, v in _RECONCILE_SIDES.items())
    rows = []
    for m in ("valor", "comissao"):
        cols = ", ".join(
            f"(SELECT round(CAST({m} AS DOUBLE), 2) FROM s_{k}) AS {k}" for k in _RECONCILE_SIDES
        )
        rows.append(
            f"SELECT '{m}' AS medida, {cols}, round((SELECT round(CAST({m} AS DOUBLE), 2) FROM s_origem_itens)"
            f" / (SELECT round(CAST({m} AS DOUBLE), 2) FROM s_origem), 6) AS fator_itens"
        )
    return ctes + " UNION ALL ".join(rows)


def _constraints() -> str:
    def row(rule: str, subject: str, sql: str) -> str:
        return f"SELECT '{rule}' AS rule, '{subject}' AS subject, CAST(coalesce(({sql}), 0) AS BIGINT) AS violations"

    rows = [
        row("not_null", c, f"SELECT count(*) FROM lineitem WHERE {c} IS NULL")
        for c in ("l_orderkey", "l_shipdate")
    ]
    rows += [
        row("domain", "l_returnflag", "SELECT count(*) FROM lineitem WHERE l_returnflag NOT IN ('A', 'N')"),
        row("domain", "l_linestatus", "SELECT count(*) FROM lineitem WHERE l_linestatus NOT IN ('O', 'F')"),
        row("length", "l_returnflag", "SELECT count(*) FROM lineitem WHERE length(l_returnflag) > 1"),
        row(
            "unique",
            "l_orderkey,l_linenumber",
            "SELECT sum(n - 1) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)",
        ),
    ]
    for name, c, parent, p in (
        ("lineitem_orders", "l_orderkey", "orders", "o_orderkey"),
        ("lineitem_part", "l_partkey", "part", "p_partkey"),
        ("lineitem_supplier", "l_suppkey", "supplier", "s_suppkey"),
    ):
        rows.append(
            row(
                "foreign_key",
                name,
                f"SELECT count(*) FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM {parent} WHERE {p} = {c})",
            )
        )
    return " UNION ALL ".join(rows)


def _equivalence() -> str:
    counts = {
        "corretor_dimension": "cor_src_f",
        "cliente_dimension": "cl_dim",
        "imovel_dimension": "im_src_f",
        "data_dimension": "(SELECT DISTINCT dia FROM venda_f)",
        "mercado_dimension": "long_f",
        "trans_venda_fact": f"({_participants('lines_f')})",
        "receita_agregada_fact": "(SELECT DISTINCT im_id, dt_sk FROM lines_f)",
    }
    return " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_differing FROM {t} q"
        for n, t in counts.items()
    )


_BODIES = {
    "land_roundtrip": " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS n_rows, CAST(sum({k}) AS BIGINT) AS key_sum, "
        + (f"CAST(sum(CAST({a} AS DECIMAL(18,2))) AS DOUBLE)" if a else "CAST(0 AS DOUBLE)")
        + f" AS amount_sum FROM {t}"
        for t, k, a in _TOTALS
    ),
    "market_subset_gold": "SELECT mk_sk, mk_cidade_norm, mk_mes, mk_dormitorios, mk_preco_m2 FROM mk_dim_f",
    "market_subset_semi": f"""
        SELECT mk_sk, mk_cidade_norm, mk_mes, mk_dormitorios, mk_preco_m2 FROM mk_dim_f
        WHERE mk_cidade_norm IN (
            SELECT FOLD(im_cidade) FROM im_dim_f JOIN imoveltransacao ON imovelid = im_id
            JOIN venda_f USING (transvendaid) WHERE dia >= DATE '{CUT}')""",
    "wide_to_long_sheet": "SELECT * FROM long_f",
    "fold_key_text": "SELECT doc_id, md5(FOLD(text)) AS folded_md5, length(FOLD(text)) AS folded_length FROM documents",
    "date_dim": f"SELECT DISTINCT {_DATE_COLUMNS} FROM venda_f",
    "date_dim_incr": f"""
        SELECT {_DATE_COLUMNS}, CASE WHEN min(dia) IN (SELECT dia FROM venda_e) THEN 0 ELSE 1 END AS carga
        FROM venda_f GROUP BY dia""",
    "surrogate_keys": """
        SELECT o_orderkey, 1000 + row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS sk FROM orders""",
    "scd2_initial_broker": f"""
        SELECT cor_sk, cor_cpf, cor_registro, cor_nome, cor_sobrenome, {_ts(TS0)} AS cor_dt_inicio,
               {_ts(None)} AS cor_dt_fim, TRUE AS cor_is_atual FROM cor_dim_f""",
    "scd2_merge_full": _merged_brokers("TRUE"),
    "scd2_merge_cdc": _merged_brokers("cor_cpf IN (SELECT key FROM feed)"),
    "scd2_extend_property": f"""
        , gone AS (SELECT d.im_id FROM im_dim_e d JOIN im_extra_f n USING (im_id)
                   WHERE (d.im_tipo, d.im_qtd_quartos, d.im_m2) IS DISTINCT FROM (n.im_tipo, n.im_qtd_quartos, n.im_m2))
        SELECT im_sk, im_id, im_logradouro, im_bairro, im_cidade, im_estado, im_num_anuncios,
               im_gasto_em_anuncios, {_ts(TS0)} AS im_dt_inicio,
               CASE WHEN im_id IN (SELECT im_id FROM gone) THEN {_ts(TS1)} END AS im_dt_fim,
               im_id NOT IN (SELECT im_id FROM gone) AS im_is_atual, im_tipo, im_qtd_quartos, im_m2
        FROM im_dim_e
        UNION ALL
        SELECT (SELECT max(im_sk) FROM im_dim_e) + row_number() OVER (ORDER BY d.im_id),
               d.im_id, im_logradouro, im_bairro, im_cidade, im_estado, im_num_anuncios,
               im_gasto_em_anuncios, {_ts(TS1)}, {_ts(None)}, TRUE, n.im_tipo, n.im_qtd_quartos, n.im_m2
        FROM im_dim_e d JOIN im_extra_f n USING (im_id) WHERE d.im_id IN (SELECT im_id FROM gone)""",
    "snowflake_property": "SELECT * FROM im_src_f",
    "snowflake_property_early": "SELECT * FROM im_src_j",
    "scd1_insert_only": _second_market(revise=False),
    "scd1_upsert_market": _second_market(revise=True),
    "participant_fact_initial": _participants("lines_f"),
    "participant_fact_nn": _participants("lines_nn_f"),
    "participant_fact_incr": f"""
        SELECT * FROM ({_participants("lines_f")}) n
        WHERE NOT EXISTS (SELECT 1 FROM ({_participants("lines_e")}) o WHERE o.tv_id = n.tv_id
                          AND o.cl_sk = n.cl_sk AND o.tv_tipo_cliente = n.tv_tipo_cliente)""",
    "sale_fact_initial": f"SELECT {_SALE_COLUMNS} FROM lines_f",
    "sale_fact_nn": f"SELECT {_SALE_COLUMNS} FROM lines_nn_f",
    "sale_fact_incr": f"SELECT {_SALE_COLUMNS} FROM lines_f WHERE tv_id NOT IN (SELECT tv_id FROM lines_e)",
    "bridge_buyers": _bridge("clientecompra"),
    "bridge_sellers": _bridge("clientevende"),
    "bridge_incr": _FACT_KEYS
    + """
        SELECT b.tv_sk, cl_sk FROM keyed b
        JOIN clientecompra x ON x.transvendaid = b.tv_id JOIN cl_dim ON cl_cpf = x.clientecpf
        WHERE b.tv_id NOT IN (SELECT tv_id FROM first)""",
    "aggregate_fact_initial": """
        SELECT im_sk, dt_sk, CAST(sum(comissao) AS DOUBLE) AS ra_comissao_total FROM lines_f GROUP BY im_sk, dt_sk""",
    "restate_aggregate_touched": _OLD_AGG
    + f"""
        , touched AS (SELECT DISTINCT im_sk, dt_sk FROM lines_f JOIN orders ON o_orderkey = tv_id
                      WHERE o_orderdate >= {_ts(CUT)} OR o_orderpriority = '1-URGENT')
        SELECT * FROM old_agg o
        WHERE NOT EXISTS (SELECT 1 FROM touched t WHERE t.im_sk = o.im_sk AND t.dt_sk = o.dt_sk)
        UNION ALL
        SELECT n.* FROM now_agg n JOIN touched USING (im_sk, dt_sk)""",
    "append_aggregate_rows": _OLD_AGG
    + """
        SELECT * FROM old_agg
        UNION ALL
        SELECT * FROM now_agg n
        WHERE NOT EXISTS (SELECT 1 FROM old_agg o WHERE o.im_sk = n.im_sk AND o.dt_sk = n.dt_sk
                          AND o.ra_comissao_total = n.ra_comissao_total)""",
    "unit_price_fact": """
        SELECT tv_id, im_sk, tv_valor, tv_valor / nullif(CAST(im_m2 AS DOUBLE), 0) AS tv_valor_m2
        FROM lines_f JOIN im_dim_f USING (im_sk)""",
    "link_benchmark_fact": """
        SELECT l.tv_id, l.im_sk, k.mk_sk FROM lines_f l LEFT JOIN link_f k ON k.tv_id = l.tv_id""",
    "sale_vs_market_view": "SELECT * EXCLUDE (mk_mes) FROM view_f",
    "measures_overall": _measures(""),
    "measures_by_broker": _measures("corretor"),
    "measures_by_city": _measures("im_cidade"),
    "measures_by_month": _measures("mk_mes"),
    "reconcile_sides": _reconcile(),
    "coverage_line": """
        SELECT count(agio_vs_mercado) AS com_benchmark, count(*) AS vendas,
               count(agio_vs_mercado) || '/' || count(*) || ' vendas com benchmark' AS linha FROM view_f""",
    "constraint_report": _constraints(),
    "feed_latest": """
        SELECT entity, key, count(*) AS n_changes, arg_max(action, (tstamp, seq)) AS last_action,
               arg_max(seq, (tstamp, seq)) AS last_seq
        FROM feed GROUP BY entity, key""",
    "feed_batches": "SELECT DISTINCT entity, key FROM feed",
    "feed_merge_stream": f"""
        SELECT cor_cpf, cor_registro, cor_nome, cor_sobrenome, cor_is_atual
        FROM (SELECT * FROM ({{scd2_merge_cdc}}) z)""",
    "land_text_digests": _text_digests(),
    "market_subset_region": """
        SELECT mk_sk, mk_cidade_norm, mk_mes, mk_dormitorios, mk_preco_m2 FROM mk_dim_f
        WHERE mk_cidade_norm IN (SELECT FOLD(im_cidade) FROM im_dim_f WHERE im_estado = 'ASIA')""",
    "wide_to_long_faulty": """
        SELECT 'São' || substr(cidade, 4) AS cidade, cidade_norm, mes, dormitorios, preco_m2,
               CASE WHEN dormitorios = 'Total' AND date_part('month', mes) IN (7, 8) THEN NULL ELSE var_mensal END AS var_mensal,
               var_12m
        FROM long_f
        WHERE date_part('month', mes) NOT IN (3, 11) AND NOT (dormitorios = '1D' AND date_part('month', mes) % 2 = 0)""",
    "reconcile_written": f"""
        SELECT tv_tipo_cliente AS lado, count(*) AS linhas_origem, count(*) AS linhas_fato,
               round(CAST(sum(CAST(tv_valor_cliente AS DECIMAL(28, 10))) AS DOUBLE), 2) AS valor,
               round(CAST(sum(CAST(tv_comissao_cliente AS DECIMAL(28, 10))) AS DOUBLE), 2) AS comissao
        FROM ({_participants("lines_nn_f")}) GROUP BY tv_tipo_cliente""",
    "version_rules": f"""
        , merged AS (SELECT * FROM ({{MERGED}}) z)
        , planted AS (
            SELECT cor_cpf, cor_sk, cor_dt_inicio AS b, CASE WHEN CAST(cor_cpf AS BIGINT) % 10 = 5 THEN FALSE ELSE cor_is_atual END AS o,
                   CASE WHEN CAST(cor_cpf AS BIGINT) % 10 = 3 AND NOT cor_is_atual THEN cor_dt_fim + INTERVAL 1 DAY
                        WHEN CAST(cor_cpf AS BIGINT) % 10 = 4 AND NOT cor_is_atual THEN cor_dt_fim - INTERVAL 1 DAY
                        ELSE cor_dt_fim END AS e FROM merged)
        , pairs AS (SELECT x.*, y.b AS nb FROM planted x JOIN planted y ON x.cor_cpf = y.cor_cpf AND y.b > x.b)
        SELECT 'overlap' AS rule, 'cor_cpf' AS subject, count(*) AS violations FROM pairs WHERE e IS NULL OR e > nb
        UNION ALL SELECT 'gap', 'cor_cpf', count(*) FROM pairs WHERE e < nb
        UNION ALL SELECT 'one_current', 'cor_cpf', count(*) FROM (SELECT cor_cpf FROM planted GROUP BY 1 HAVING count(*) FILTER (WHERE o) <> 1)
        UNION ALL SELECT 'open_end', 'cor_cpf', count(*) FROM planted WHERE o <> (e IS NULL)
        UNION ALL SELECT 'backwards', 'cor_cpf', count(*) FROM planted WHERE e < b""",
    "source_constraints": """
        , sales AS (SELECT transvendaid, CASE WHEN transvendaid % 11 = 0 THEN 'x' ELSE funccpf END AS funccpf FROM venda_f)
        SELECT * FROM (
            SELECT 'corretor' AS table_name, 'unique' AS rule, 'funccpf' AS subject,
                   (SELECT count(*) FROM cor_src_f WHERE CAST(cor_cpf AS BIGINT) % 9 = 0) AS violations
            UNION ALL SELECT 'transvenda', 'foreign_key', 'transvenda.funccpf',
                   (SELECT count(*) FROM sales WHERE funccpf NOT IN (SELECT cor_cpf FROM cor_src_f))
            UNION ALL SELECT 'clientecompra', 'foreign_key', 'clientecompra.clientecpf',
                   (SELECT count(*) FROM clientecompra WHERE CAST(clientecpf AS BIGINT) % 7 = 0)
            UNION ALL SELECT 'clientevende', 'foreign_key', 'clientevende.clientecpf',
                   (SELECT count(*) FROM clientevende WHERE CAST(clientecpf AS BIGINT) % 7 = 0)) r
        WHERE violations > 0""",
    "star_constraints": _star_constraints(),
    "fold_collation": """
        WITH found AS (SELECT DISTINCT unnest(regexp_extract_all(text, '\\p{L}+')) AS word FROM documents)
        , folded AS (SELECT word, lower(strip_accents(replace(replace(word, 'ẞ', 'ss'), 'ß', 'ss'))) AS k FROM found)
        SELECT a.word AS written, count(*) AS n_equal, min(b.word) AS first_form
        FROM folded a JOIN folded b ON a.k = b.k
        WHERE regexp_matches(a.word, '[^\\x00-\\x7F]') GROUP BY a.word""",
    "pipeline_paths": """
        SELECT tv_id, dt_data_completa, corretor, im_cidade, im_estado, im_bairro, im_tipo, im_qtd_quartos,
               tv_total_compradores, tv_total_vendedores, tv_valor, tv_comissao, mk_preco_m2, mk_var_12m
        FROM view_f WHERE tv_total_compradores + tv_total_vendedores > 0""",
    "bridge_pipeline": """
        SELECT l.tv_id, l.tv_valor, papel, clientecpf AS cl_cpf
        FROM lines_f l JOIN (SELECT *, 'COMPRADOR' AS papel FROM clientecompra
                             UNION ALL SELECT *, 'VENDEDOR' FROM clientevende) x ON x.transvendaid = l.tv_id""",
    "scd1_upsert_months": _second_market(revise=True),
    "feed_snapshots": _snapshot_feed(),
    "feed_parked_sales": _WAITING + " SELECT transvendaid, missing FROM waiting",
    "feed_aggregate_held": _WAITING
    + """
        SELECT im_id, dt_sk, CAST(sum(comissao) AS DOUBLE) AS ra_comissao_total FROM lines_f
        WHERE tv_id NOT IN (SELECT transvendaid FROM waiting) GROUP BY im_id, dt_sk""",
    "feed_out_of_order": _natural_participants(),
    "participant_fact_late": _natural_participants(),
    "pipeline_equivalence": _equivalence(),
}


def _definitions() -> dict[str, str]:
    found = dict(_FIXED)
    for state, until in _UNTIL.items():
        limits = {
            "orders_until": "" if until is None else f" WHERE o_orderdate < TIMESTAMP '{until}'",
            "ads_until": "" if until is None else f" WHERE l_shipdate < TIMESTAMP '{until}'",
        }
        for name, sql in _BY_STATE.items():
            found[name.format(s=state)] = sql.format(s=state, **limits)
    return found


def _folds(sql: str) -> str:
    return re.sub(r"FOLD\(([\w.]+)\)", lambda m: _fold(m[1]), sql)


def _statement(body: str) -> str:
    """Prefix ``body`` with the common tables it needs, in order of need."""
    known = _definitions()
    ordered: list[str] = []

    def need(sql: str) -> None:
        for word in re.findall(r"\w+", sql):
            if word in known and word not in ordered:
                need(known[word])
                if word not in ordered:
                    ordered.append(word)

    need(body)
    ctes = ", ".join(f"{n} AS ({known[n]})" for n in ordered)
    body = body.strip()
    if body.startswith(","):
        return _folds(f"WITH {ctes} {body}")
    return _folds(f"WITH {ctes} {body}" if ctes else body)


def all_oracles() -> dict[str, str]:
    bodies = dict(_BODIES)
    merged = _statement(bodies["scd2_merge_cdc"])
    bodies["version_rules"] = bodies["version_rules"].replace("{MERGED}", _statement(bodies["scd2_merge_full"]))
    bodies["feed_merge_stream"] = bodies["feed_merge_stream"].replace("{scd2_merge_cdc}", merged)
    return {
        name: body if name == "feed_merge_stream" else _statement(body)
        for name, body in bodies.items()
    }
