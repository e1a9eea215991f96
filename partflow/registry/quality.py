"""Quality gate and audit queries."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.config import INVENTORY_KEYS, INVENTORY_QUANTITIES
from partflow.operators import quality
from partflow.plans import inventory
from partflow.registry.base import Family
from partflow.registry.fixtures import ANCHOR, Inputs
from partflow.registry.state import _HISTORY, history_of
from partflow.registry.twins import locale_number

QUERIES = Family()

# Sales rows as if they had come in monthly files, some of them misnamed or misfilled.
_FILED = """
    SELECT CASE WHEN month(data) = 2 AND org_vendas = '0500' THEN concat('sales_', mes, '.txt')
        WHEN month(data) = 3 AND org_vendas = '0200' THEN concat('salesorder_raw_', mes, '_0200_4W.txt')
        WHEN month(data) = 4 AND org_vendas = '0500' THEN concat('salesorder_raw_', mes, '_0700_4W.txt')
        WHEN month(data) = 5 THEN concat('salesorder_raw_', mes, '_0200_2W.txt')
        WHEN month(data) = 6 AND org_vendas = '0500'
          THEN concat('salesorder_raw_', substring(mes, 1, 4), '-07_0500_4W.txt')
        WHEN org_vendas = '0200' THEN concat('salesorder_raw_', mes, '_0200_2W.txt')
        ELSE concat('salesorder_raw_', mes, '_0500_4W.txt') END AS _source_file_name,
      CASE WHEN month(data) = 8 AND numero_ov % 97 = 0 THEN NULL ELSE data END AS data, org_vendas, numero_ov
    FROM (SELECT *, substring(CAST(data AS STRING), 1, 7) AS mes FROM fx_sales) s"""

_STATS = f"""
    SELECT _source_file_name AS file, count(*) AS rows, count_if(data IS NULL) AS null_dates,
      strftime(min(data), '%Y-%m') AS min_period, strftime(max(data), '%Y-%m') AS max_period,
      min(org_vendas) AS min_org, max(org_vendas) AS max_org
    FROM ({_FILED}) GROUP BY 1"""


@QUERIES.query(_STATS)
def gate_file_stats(inputs: Inputs) -> DataFrame:
    return quality.file_stats(inputs.sql(_FILED))


_PATTERN = "'^salesorder_raw_(\\d{4}-\\d{2})_(\\d{4})_(\\dW)\\.txt$'"
_NAMED = f"""
    SELECT *, CASE WHEN ok THEN regexp_extract(file, {_PATTERN}, 1) END AS period,
      CASE WHEN ok THEN regexp_extract(file, {_PATTERN}, 2) END AS org,
      CASE WHEN ok THEN regexp_extract(file, {_PATTERN}, 3) END AS seg
    FROM (SELECT *, regexp_matches(file, {_PATTERN}) AS ok FROM ({_STATS}))"""
_KNOWN = f"SELECT * FROM ({_NAMED}) WHERE org IN ('0200', '0500')"


def _missing(loaded: str = "") -> str:
    return f"""SELECT 'file_missing' AS rule, p.period || ' ' || o.org AS subject, 'organisation did not arrive' AS detail
        FROM (SELECT DISTINCT period FROM ({_KNOWN})) p CROSS JOIN (SELECT unnest(['0200', '0500']) AS org) o
        WHERE NOT EXISTS (SELECT 1 FROM ({_KNOWN}) k WHERE k.period = p.period AND k.org = o.org) {loaded}"""


@QUERIES.query(f"""
    SELECT 'file_name' AS rule, file AS subject, 'name does not match the pattern' AS detail FROM ({_NAMED}) WHERE NOT ok
    UNION ALL SELECT 'file_org', file, CASE org WHEN '0200' THEN 'segment should be 2W' WHEN '0500'
      THEN 'segment should be 4W' ELSE 'unknown organisation' END FROM ({_NAMED})
      WHERE ok AND NOT ((org = '0200' AND seg = '2W') OR (org = '0500' AND seg = '4W'))
    UNION ALL SELECT 'file_null_dates', file, CAST(null_dates AS VARCHAR) FROM ({_KNOWN}) WHERE null_dates > 0
    UNION ALL SELECT 'file_period', file, concat_ws(' to ', min_period, max_period) FROM ({_KNOWN})
      WHERE min_period IS DISTINCT FROM period OR max_period IS DISTINCT FROM period
    UNION ALL SELECT 'file_content_org', file, concat_ws(' to ', min_org, max_org) FROM ({_KNOWN})
      WHERE min_org IS DISTINCT FROM org OR max_org IS DISTINCT FROM org
    UNION ALL SELECT 'file_repeated', period || ' ' || org, CAST(count(*) AS VARCHAR) FROM ({_KNOWN})
      GROUP BY period, org HAVING count(*) > 1
    UNION ALL {_missing()}""")
def gate_files(inputs: Inputs) -> DataFrame:
    return quality.sales_file_gates(quality.file_stats(inputs.sql(_FILED)))


@QUERIES.query(_missing("""AND NOT EXISTS (SELECT 1 FROM fx_sales s WHERE s.data < DATE '1999-01-01'
    AND strftime(s.data, '%Y-%m') = p.period AND s.org_vendas = o.org)"""))
def gate_missing_org(inputs: Inputs) -> DataFrame:
    files = inputs.sql(_FILED).select(F.col("_source_file_name").alias("file")).distinct()
    loaded = inputs.view("fx_sales").where("data < DATE '1999-01-01'")
    return quality.gate_missing_org(quality.named_files(files), loaded)


@QUERIES.query("""
    SELECT 'key' AS rule, concat_ws('|', empresa, coalesce(item_principal_cadeia, 'NULL')) AS subject,
      'empty key part' AS detail
    FROM fx_master WHERE item_principal_cadeia IS NULL OR trim(item_principal_cadeia) = ''""")
def gate_keys(inputs: Inputs) -> DataFrame:
    return quality.gate_keys(inputs.view("fx_master"), ["empresa", "item_principal_cadeia"])


@QUERIES.query("""
    SELECT 'number' AS rule, CAST(p_partkey AS VARCHAR) AS subject, 'texto: ' || texto AS detail FROM fx_numbers
    WHERE texto IN ('abc', '12,30-', '99999999999999999,00')""")
def gate_numeric(inputs: Inputs) -> DataFrame:
    return quality.gate_numeric(inputs.view("fx_numbers"), ["p_partkey"], ["texto"])


@QUERIES.query("""
    SELECT 'conflict' AS rule, numero_ov || '|' || item AS subject, CAST(count(DISTINCT
      concat_ws('|', coalesce(CAST(data AS VARCHAR), '-'), material, coalesce(CAST(quantidade AS VARCHAR), '-'))) AS VARCHAR) AS detail
    FROM fx_sales GROUP BY numero_ov, item
    HAVING count(DISTINCT concat_ws('|', coalesce(CAST(data AS VARCHAR), '-'), material,
      coalesce(CAST(quantidade AS VARCHAR), '-'))) > 1""")
def gate_conflict(inputs: Inputs) -> DataFrame:
    return quality.gate_conflict(
        inputs.view("fx_sales"), ["numero_ov", "item"], ["data", "material", "quantidade"])


@QUERIES.query("""
    SELECT 'divergence' AS rule, org_vendas || '|' || material AS subject,
      count(DISTINCT tipo_ov) || ' versions in ' || count(DISTINCT centro) || ' places' AS detail
    FROM fx_sales GROUP BY org_vendas, material HAVING count(DISTINCT tipo_ov) > 1""")
def gate_divergence(inputs: Inputs) -> DataFrame:
    return quality.gate_divergence(inputs.view("fx_sales"), ["org_vendas", "material"], "tipo_ov", "centro")


@QUERIES.query("""
    SELECT 'duplicate' AS rule, numero_ov || '|' || item AS subject, CAST(count(*) AS VARCHAR) AS detail
    FROM fx_sales GROUP BY numero_ov, item HAVING count(*) > 1""")
def gate_duplicates(inputs: Inputs) -> DataFrame:
    return quality.gate_duplicates(inputs.view("fx_sales"), ["numero_ov", "item"])




@QUERIES.query("""
    SELECT 'freshness' AS rule, event_type AS subject, count(*) > 0 AS seen
    FROM events GROUP BY event_type HAVING max(ts) < (SELECT max(ts) FROM events WHERE event_type = 'view')
    UNION ALL SELECT 'freshness', 'absent', false""")
def gate_freshness(inputs: Inputs) -> DataFrame:
    audit = inputs.table("events").select(
        F.col("event_type").alias("table"), F.lit("write").alias("op"), "ts")
    stale = quality.gate_freshness(
        audit, "view", ["signup", "purchase", "error", "click", "absent"])
    return stale.select("rule", "subject", (F.col("detail") != "never").alias("seen"))


@QUERIES.query("""
    SELECT 'reference_date' AS rule, 'mes' AS subject, min(mes) || ', ' || max(mes) || ', 0 empty' AS detail
    FROM (SELECT date_trunc('month', data)::DATE AS mes FROM fx_sales) HAVING min(mes) <> max(mes)""")
def gate_reference_date(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_sales").select(F.trunc("data", "month").alias("mes"))
    return quality.gate_reference_date(rows, "mes")


@QUERIES.query(f"""
    SELECT 'chronology' AS rule, '2001-07-01' AS subject, CAST(CAST(max(start_date) AS DATE) AS VARCHAR) AS detail
    FROM ({_HISTORY}) WHERE is_current HAVING max(start_date) >= TIMESTAMP '2001-07-01'""")
def gate_chronology(inputs: Inputs) -> DataFrame:
    return quality.gate_chronology(history_of(inputs), date(2001, 7, 1))


@QUERIES.query("""
    SELECT 'loaded' AS rule, '2001-08-01' AS subject, CAST(count(*) AS VARCHAR) AS detail
    FROM fx_snapshot_3 s LEFT JOIN fx_snapshot_2 p ON s.k = p.k AND s.a IS NOT DISTINCT FROM p.a AND s.b = p.b
    WHERE p.k IS NULL HAVING count(*) > 0""")
def gate_loaded(inputs: Inputs) -> DataFrame:
    return quality.gate_loaded(history_of(inputs), ANCHOR)


@QUERIES.query("""
    SELECT 'lossless' AS rule, 'valor' AS subject, count_if(v IS NOT NULL AND TRY_CAST(v AS DECIMAL(18,2)) IS NULL) || ' / '
      || count_if(abs(v - round(v, 2)) > 1e-4) AS detail
    FROM (SELECT l_extendedprice * l_discount / 8 AS v FROM lineitem)""")
def gate_lossless(inputs: Inputs) -> DataFrame:
    value = F.col("l_extendedprice") * F.col("l_discount") / 8
    return quality.gate_lossless(inputs.table("lineitem").select(value.alias("valor")), "valor")


@QUERIES.query("""
    SELECT org_vendas AS _load_id, tipo_ov AS _ingested_by, canal_dist AS _source_file_name, count(*) AS rows,
      count(DISTINCT numero_ov) AS orders, min(data) AS data_min, max(data) AS data_max FROM fx_sales GROUP BY 1, 2, 3""")
def load_audit(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_sales").withColumnsRenamed({
        "org_vendas": "_load_id", "tipo_ov": "_ingested_by", "canal_dist": "_source_file_name"})
    return quality.load_audit(rows)


@QUERIES.query("""
    SELECT 'pedidos' AS tabela, left(centro, 3) AS segmento, count(*) AS linhas FROM fx_sales GROUP BY 2
    UNION ALL SELECT 'cadastro', left(centro, 3), count(*) FROM fx_master GROUP BY 2""")
def output_inventory(inputs: Inputs) -> DataFrame:
    return quality.output_inventory(
        {"pedidos": inputs.view("fx_sales"), "cadastro": inputs.view("fx_master")}, "centro")


@QUERIES.query("""
    SELECT empresa, centro, count(*) AS rows FROM fx_stock WHERE (empresa, centro) IN
      (SELECT empresa, centro FROM fx_stock WHERE centro LIKE '%5') GROUP BY 1, 2""")
def scope_count(inputs: Inputs) -> DataFrame:
    stock = inputs.view("fx_stock")
    return quality.scope_count(stock, stock.where("centro LIKE '%5'"), ["empresa", "centro"])


@QUERIES.query("""
    SELECT count(*) AS rows, count_if(item_principal_cadeia IS NULL OR upper(trim(item_principal_cadeia)) IN ('', 'SIM')
      OR regexp_full_match(trim(item_principal_cadeia), '0+(\\.0+)?')) AS residual FROM fx_master""")
def residual(inputs: Inputs) -> DataFrame:
    from partflow.functions.codes import names_no_item

    return quality.residual(
        inputs.view("fx_master"), names_no_item(F.col("item_principal_cadeia"), zeros=True))


@QUERIES.query("SELECT *, DATE '2001-08-01' AS reference_date FROM ox_inventory")
def inventory_snapshot(inputs: Inputs) -> DataFrame:
    return inventory.inventory_snapshot(inputs.view("fx_stock"), ANCHOR)


_SUMS = ", ".join(f"CAST(sum(round({locale_number(c)}, 2)) AS DECIMAL(38,2)) AS {c}" for c in INVENTORY_QUANTITIES)


@QUERIES.query(f"""
    SELECT empresa || '|' || material || '|' || centro AS chave, count(*) AS linhas, {_SUMS} FROM fx_stock GROUP BY 1""")
def inventory_numbers(inputs: Inputs) -> DataFrame:
    rows = inventory.inventory_numbers(inputs.view("fx_stock"))
    return rows.groupBy(quality.joined_keys(INVENTORY_KEYS).alias("chave")).agg(
        F.count(F.lit(1)).alias("linhas"),
        *[F.sum(c).cast("decimal(38,2)").alias(c) for c in INVENTORY_QUANTITIES])
