"""Views that let the given tables play the planning inputs.

Every text is SQL that Spark and DuckDB read alike, so a query and its twin start from
the same rows. ``{{each x in a, b}}`` repeats a row for the listed constants; that is the
one clause each engine spells in its own way.
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from partflow.config import INVENTORY_QUANTITIES
from partflow.session import hold_settings

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# The latest order month of the given tables, the same at every scale.
ANCHOR = date(2001, 8, 1)
CYCLES = (
    "2000-09-01", "2000-10-01", "2000-11-01", "2000-12-01", "2001-01-01", "2001-02-01",
    "2001-03-01", "2001-04-01", "2001-05-01",
)

SUFFIX = (
    "CASE WHEN p_partkey % 17 = 0 THEN ' C' WHEN p_partkey % 19 = 0 THEN ' G' "
    "WHEN p_partkey % 23 = 0 THEN ' NP' WHEN p_partkey % 29 = 0 THEN ' N' ELSE '' END"
)
MIXED_DATE = (
    "CASE p_partkey % 4 WHEN 0 THEN '05.03.2020' WHEN 1 THEN '00.00.0000' WHEN 2 THEN NULL "
    "ELSE concat(CAST(p_partkey % 12 + 1 AS STRING), '/', CAST(p_partkey % 28 + 1 AS STRING), '/', "
    "lpad(CAST(p_partkey % 100 AS STRING), 2, '0')) END"
)


def _number_text(j: int) -> str:
    p = f"(p_partkey + {j})"
    return (
        f"CASE WHEN {p} % 11 = 0 THEN NULL WHEN {p} % 7 = 0 THEN concat(CAST(p_partkey AS STRING), ',5') "
        f"WHEN {p} % 7 = 1 THEN '1.234' WHEN {p} % 7 = 2 THEN '1.234,56' WHEN {p} % 7 = 3 THEN '1,234.56' "
        f"WHEN {p} % 7 = 4 THEN ' R$ 12,30 ' WHEN {p} % 7 = 5 THEN '1.23E+2' ELSE '' END"
    )


def _horizon_text(i: int) -> str:
    return (
        f"CASE WHEN (p_partkey + {i * 5} + k) % 29 = 0 THEN NULL WHEN (p_partkey + {i} + k) % 17 = 0 THEN ' ' "
        f"WHEN (p_partkey + {i}) % 13 = 0 THEN '0' ELSE concat("
        f"CAST((p_partkey * 7 + {i * 13} + k * 5) % 41 - CASE kind WHEN 'Enrich' THEN 20 ELSE 4 END AS STRING), "
        f"CASE (p_partkey + {i}) % 2 WHEN 0 THEN '.25' ELSE '.5' END) END AS h{i}"
    )


_ORGS = "{{each org in '0200', '0500'}}"
_CYCLE_NUMBERS = f"{{{{each k in {', '.join(str(k) for k in range(len(CYCLES)))}}}}}"
_CYCLE = "CASE k " + " ".join(f"WHEN {k} THEN '{c}'" for k, c in enumerate(CYCLES)) + " END"

FIXTURES: dict[str, str] = {
    "fx_sales": """
        SELECT l.l_orderkey AS numero_ov, CAST(l.l_linenumber AS BIGINT) AS item,
          CAST(o.o_orderdate AS DATE) AS data,
          CASE o.o_orderpriority WHEN '1-URGENT' THEN 'ZPUG' WHEN '5-LOW' THEN 'ZESP'
            WHEN '4-NOT SPECIFIED' THEN NULL ELSE 'ZNOR' END AS tipo_ov,
          CASE WHEN l.l_suppkey % 2 = 0 THEN '0200' ELSE '0500' END AS org_vendas,
          CASE WHEN l.l_returnflag = 'R' THEN '02' ELSE '01' END AS canal_dist,
          l.l_linestatus AS setor_ativ,
          CASE l.l_suppkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '0203' WHEN 2 THEN '0503'
            WHEN 3 THEN '0209' WHEN 4 THEN '0505' WHEN 5 THEN '0232' ELSE '0999' END AS centro,
          o.o_custkey AS emissor_da_ordem,
          concat('M', CAST(l.l_partkey AS STRING),
            CASE WHEN l.l_partkey % 17 = 0 THEN ' C' ELSE '' END) AS material,
          CASE WHEN l.l_linenumber = 7 AND l.l_partkey % 10 = 0 THEN NULL
            ELSE CAST(CAST(l.l_quantity AS DECIMAL(18,3)) + CASE l.l_partkey % 4
              WHEN 1 THEN 0.250 WHEN 2 THEN 0.500 ELSE 0.000 END AS DECIMAL(18,3)) END AS quantidade
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "fx_master": f"""
        SELECT org AS empresa, concat('M', CAST(p_partkey AS STRING), {SUFFIX}) AS material,
          CASE WHEN org = '0200' THEN '0203' ELSE '0503' END AS centro,
          CASE p_type WHEN 'PROMO' THEN 'ZXXX' WHEN 'SMALL' THEN 'ZHAW' WHEN 'LARGE' THEN 'ZFER'
            ELSE 'ZRO1' END AS tipo_de_material,
          CASE p_size % 10 WHEN 0 THEN '040' WHEN 1 THEN '054' WHEN 2 THEN NULL WHEN 3 THEN '043'
            ELSE '042' END AS grupo_de_compradores,
          CASE WHEN p_partkey % 5 = 0 THEN 'SIM' WHEN p_partkey % 7 = 0 THEN NULL
            WHEN p_partkey % 11 = 0 THEN ' ' WHEN p_partkey % 31 = 0 THEN '0'
            ELSE concat('M', CAST(p_partkey - p_partkey % 5 AS STRING),
              CASE WHEN p_partkey % 13 = 0 THEN ' C' WHEN p_partkey % 3 = 0 THEN '  G' ELSE '' END)
            END AS item_principal_cadeia,
          CAST(p_partkey % 6 + 1 AS STRING) AS origem,
          CASE p_size % 3 WHEN 0 THEN 'X' WHEN 1 THEN ' Y ' ELSE NULL END AS intercambiabilidade,
          {MIXED_DATE} AS data_cadeia,
          CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE '01.01.2019' END AS cut_in_material,
          {MIXED_DATE} AS cut_off_material,
          CASE WHEN p_partkey % 8 = 0 THEN NULL ELSE concat('CH', CAST(p_partkey % 50 AS STRING)) END AS cadeia,
          p_brand AS modelo_comercial_principal, p_type AS status_compra,
          CAST(p_size AS STRING) AS prazo_entrega_prevista_lead_time_firme,
          p_name AS descricao_curta_portugues, upper(p_name) AS descricao_curta_ingles
        FROM part {_ORGS}""",
    "fx_area": f"""
        SELECT lpad(CAST(c_custkey AS STRING), 10, '0') AS CLIENTE, org AS ORGV, channel AS CDST, sector AS SA,
          CASE WHEN c_nationkey % 7 = 0 THEN NULL WHEN c_nationkey % 11 = 0 THEN ' '
            WHEN org = '0200' THEN CASE c_nationkey % 3 WHEN 0 THEN '0203' WHEN 1 THEN '0209' ELSE '0232' END
            ELSE CASE c_nationkey % 2 WHEN 0 THEN '0503' ELSE '0505' END END AS CEN
        FROM customer {_ORGS} {{{{each channel in '01', '02'}}}} {{{{each sector in 'O', 'F'}}}}
        WHERE c_custkey % 31 <> 0""",
    "fx_customer": """
        SELECT lpad(CAST(c_custkey AS STRING), 10, '0') AS CLIENTE, r_name AS PS, n_name AS LOCAL,
          CASE c_nationkey % 5 WHEN 0 THEN 'SP' WHEN 1 THEN 'TO' WHEN 2 THEN 'AP' WHEN 3 THEN 'RJ'
            ELSE NULL END AS RG, c_name AS NOME_3
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        WHERE c_custkey % 37 <> 0""",
    "fx_stock": f"""
        SELECT CASE WHEN p_partkey % 2 = 0 THEN '0200' ELSE '0500' END AS empresa,
          concat('M', CAST(p_partkey AS STRING), {SUFFIX}) AS material,
          concat(CASE WHEN p_partkey % 2 = 0 THEN '020' ELSE '050' END, CASE c WHEN 1 THEN '5' ELSE '3' END)
            AS centro,
          CASE p_type WHEN 'PROMO' THEN 'ZXXX' ELSE 'ZHAW' END AS tipo_de_material,
          {", ".join(f"{_number_text(j)} AS {c}" for j, c in enumerate(INVENTORY_QUANTITIES))}
        FROM (SELECT /*+ REPARTITION(16, p_partkey) */ * FROM part) p {{{{each c in 0, 1, 2}}}} WHERE c < 2 OR p_partkey % 9 = 0""",
    "fx_bom": f"""
        SELECT CASE WHEN p_partkey % 2 = 0 THEN '0203' ELSE '0503' END AS centro,
          concat('M', CAST(p_partkey + 1 AS STRING), CASE WHEN (p_partkey + 1) % 17 = 0 THEN ' C' ELSE '' END)
            AS material,
          concat('M', CAST(CASE WHEN p_partkey % 3 = 0 THEN p_partkey - p_partkey % 10 ELSE p_partkey END AS STRING))
            AS componente
        FROM part
        UNION ALL
        SELECT CASE WHEN p_partkey % 2 = 0 THEN '0209' ELSE '0505' END AS centro,
          concat('M', CAST(p_partkey + 1 AS STRING)) AS material,
          concat('M', CAST(p_partkey + 2 AS STRING)) AS componente
        FROM part WHERE p_partkey % 6 = 0""",
    "fx_forecast": f"""
        SELECT {_CYCLE} AS forecast_cycle,
          CASE WHEN (p_partkey + k) % 3 = 0 THEN 'Export - Parts' ELSE 'Domestic - Parts' END AS department,
          CASE WHEN p_partkey % 37 = 0 THEN NULL ELSE kind END AS forecast_type,
          CASE WHEN p_partkey % 2 = 0 THEN '0200' ELSE '0500' END AS segment,
          CASE WHEN (p_partkey + k) % 3 = 0 THEN 'Export' ELSE 'Domestic' END AS market,
          concat('M', CAST(p_partkey AS STRING), {SUFFIX}) AS main_material,
          CASE p_partkey % 4 WHEN 0 THEN 'Supply - Parts - X' WHEN 1 THEN 'Supply' WHEN 2 THEN NULL
            ELSE 'Non - Forecastable' END AS forecast_classification,
          {", ".join(_horizon_text(i) for i in range(36))},
          concat('forecast_', {_CYCLE}, '.csv') AS _source_file_name,
          concat('load-', CAST(k AS STRING)) AS _load_id
        FROM (SELECT /*+ REPARTITION(16, p_partkey) */ * FROM part) p {_CYCLE_NUMBERS} {{{{each kind in 'Judgment', 'Enrich'}}}}""",
    "fx_lines": """
        SELECT CASE
          WHEN l_orderkey % 50 = 0 THEN '   '
          WHEN l_orderkey % 51 = 0 THEN concat(CAST(l_orderkey AS STRING), '|', dia, '|ZNOR')
          WHEN l_orderkey % 52 = 0 THEN concat('Doc. venda|', dia, '|||||||||||||||M1|1')
          WHEN l_orderkey % 53 = 0 THEN concat('|', CAST(l_orderkey AS STRING), '|', iso, tail)
          WHEN l_orderkey % 57 = 0 THEN concat('|', CAST(l_orderkey AS STRING), '|', dia, '|X', tail)
          ELSE concat('|', CAST(l_orderkey AS STRING), ' | ', dia, tail) END AS value
        FROM (SELECT l_orderkey, iso, concat(substring(iso, 9, 2), '.', substring(iso, 6, 2), '.',
            substring(iso, 1, 4)) AS dia,
          concat('| ZNOR |  ||', CASE WHEN l_tax > 0.05 THEN 'R1' ELSE '' END, '|0200|01|04|0203|',
            CAST(o_custkey AS STRING), '|autor x|', CAST(l_linenumber AS STRING), '|M', CAST(l_partkey AS STRING),
            '|TAN||', CASE l_linenumber % 3 WHEN 0 THEN concat('1.', lpad(q, 3, '0'), ',250')
              WHEN 1 THEN concat(q, ',000-') ELSE q END, '|PC|') AS tail
          FROM (SELECT l_orderkey, l_tax, o_custkey, l_linenumber, l_partkey,
              CAST(CAST(o_orderdate AS DATE) AS STRING) AS iso, CAST(CAST(l_quantity AS INT) AS STRING) AS q
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey) a) b""",
    "fx_numbers": """
        SELECT p_partkey, CASE p_partkey % 12 WHEN 0 THEN concat(CAST(p_partkey AS STRING), ',5')
          WHEN 1 THEN '1.234' WHEN 2 THEN '1.234,56' WHEN 3 THEN '1,234.56' WHEN 4 THEN ' R$ 12,30 '
          WHEN 5 THEN '1.23E+2' WHEN 6 THEN '' WHEN 7 THEN NULL WHEN 8 THEN 'abc' WHEN 9 THEN '12,30-'
          WHEN 10 THEN '99999999999999999,00' ELSE concat('-', CAST(p_partkey AS STRING), '.125') END AS texto
        FROM part""",
    "fx_snapshot_1": """
        SELECT CAST(c_custkey AS STRING) AS k, c_mktsegment AS a, CAST(c_nationkey AS STRING) AS b
        FROM customer WHERE c_custkey % 13 <> 0""",
    "fx_snapshot_2": """
        SELECT CAST(c_custkey AS STRING) AS k,
          CASE WHEN c_custkey % 6 = 0 THEN 'CHANGED' ELSE c_mktsegment END AS a,
          CAST(c_nationkey AS STRING) AS b FROM customer WHERE c_custkey % 11 <> 0""",
    "fx_snapshot_3": """
        SELECT CAST(c_custkey AS STRING) AS k,
          CASE WHEN c_custkey % 6 = 0 THEN 'CHANGED' WHEN c_custkey % 25 = 0 THEN NULL ELSE c_mktsegment END AS a,
          CAST(c_nationkey AS STRING) AS b FROM customer""",
}


def with_views(sql: str, views: dict[str, str]) -> str:
    """Prepends the views a text refers to, directly or through other views."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in views:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(views[name])
                if name not in needed:
                    needed.append(name)

    visit(sql)
    if not needed:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({views[n]})" for n in needed) + "\n" + sql


_SCANS: dict[tuple[str, str, str], DataFrame] = {}

EACH = re.compile(r"\{\{each (\w+) in ([^}]*)\}\}")
#: The views that widen a table row by row spread it over this many partitions at least, and over more as it grows.
SPREAD = re.compile(r"REPARTITION\((\d+), p_partkey\) \*/ \* FROM (\w+)")
SPREAD_ROWS = 10_000


def for_spark(sql: str) -> str:
    return EACH.sub(r"LATERAL VIEW explode(array(\2)) AS \1", sql)


def for_duckdb(sql: str) -> str:
    return EACH.sub(r"CROSS JOIN (SELECT unnest([\2]) AS \1)", sql)


class Inputs:
    """The fixture views as DataFrames over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        hold_settings(spark)

    def table(self, name: str) -> DataFrame:
        """The table's scan; its schema is read from the file footers once per session."""
        key = (self.spark.sparkContext.applicationId, self.folder, name)
        if key not in _SCANS:
            _SCANS[key] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return _SCANS[key]

    def _spread(self, hint: re.Match) -> str:
        least, name = hint.groups()
        parts = max(int(least), -(-self.table(name).count() // SPREAD_ROWS))
        return f"REPARTITION({parts}, p_partkey) */ * FROM {name}"

    def sql(self, text: str) -> DataFrame:
        full = SPREAD.sub(self._spread, for_spark(with_views(text, FIXTURES)))
        for name in TABLES:
            if re.search(rf"\b{name}\b", full):
                self.table(name).createOrReplaceTempView(name)
        return self.spark.sql(full)

    def view(self, name: str) -> DataFrame:
        return self.sql(f"SELECT * FROM {name}")
