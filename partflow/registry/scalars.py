"""Scalar function queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from partflow.config import LINEAGE_COLUMNS, STOCK_PARTS
from partflow.functions import codes, dates, hashing, labels, numbers
from partflow.operators.project import blanks_to_null, normalize_columns
from partflow.plans import customers, materials, sales
from partflow.registry.base import Family
from partflow.registry.fixtures import Inputs
from partflow.session import scratch_path
from partflow.sources.readers import read_lines

QUERIES = Family()


@QUERIES.query("""
    SELECT p_partkey, TRY_CAST(CASE WHEN regexp_matches(texto, '[Ee]') THEN NULL WHEN right(trim(texto), 1) = '-'
      THEN '-' || replace(replace(left(trim(texto), length(trim(texto)) - 1), '.', ''), ',', '.')
      ELSE replace(replace(trim(texto), '.', ''), ',', '.') END AS DECIMAL(18,3)) AS valor
    FROM fx_numbers""")
def number_erp(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_numbers").select("p_partkey", numbers.erp_number(F.col("texto")).alias("valor"))


_LOCALE = """
    SELECT *, CASE
      WHEN t IS NULL OR t = '' THEN NULL
      WHEN regexp_full_match(t, '-?\\d+(\\.\\d+)?[Ee][+-]?\\d+') THEN TRY_CAST(TRY_CAST(t AS DOUBLE) AS DECIMAL(38,6))
      WHEN regexp_full_match(t, '-?\\d{1,3}(\\.\\d{3})+,\\d+') THEN TRY_CAST(replace(replace(t, '.', ''), ',', '.') AS DECIMAL(38,6))
      WHEN regexp_full_match(t, '-?\\d{1,3}(\\.\\d{3})+') THEN TRY_CAST(replace(t, '.', '') AS DECIMAL(38,6))
      WHEN regexp_full_match(t, '-?\\d{1,3}(,\\d{3})+\\.\\d+') THEN TRY_CAST(replace(t, ',', '') AS DECIMAL(38,6))
      WHEN regexp_full_match(t, '-?\\d+,\\d+') THEN TRY_CAST(replace(t, ',', '.') AS DECIMAL(38,6))
      WHEN regexp_full_match(t, '-?\\d+(\\.\\d+)?') THEN TRY_CAST(t AS DECIMAL(38,6)) END AS valor
    FROM (SELECT *, regexp_replace(texto, '[\\sR$]', '', 'g') AS t FROM fx_numbers)"""


@QUERIES.query(f"SELECT p_partkey, valor FROM ({_LOCALE})")
def number_locale(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_numbers").select(
        "p_partkey", numbers.locale_decimal(F.col("texto")).alias("valor"))


@QUERIES.query(f"""
    SELECT p_partkey, CAST(round(CASE WHEN abs(valor) < 1e16 THEN valor END, 2) AS DECIMAL(18,2)) AS valor,
      coalesce(trim(texto) <> '', false) AND (valor IS NULL OR abs(valor) >= 1e16) AS invalido
    FROM ({_LOCALE})""")
def decimal_fit(inputs: Inputs) -> DataFrame:
    value = numbers.locale_decimal(F.col("texto"))
    return inputs.view("fx_numbers").select(
        "p_partkey",
        F.when(numbers.fits_decimal(value), numbers.round_half_up(value)).alias("valor"),
        numbers.invalid_number(F.col("texto")).alias("invalido"))


@QUERIES.query("""
    SELECT p_partkey, CAST(round(v, 2) AS DECIMAL(18,2)) AS meia_acima,
      CAST(round_even(v, 2) AS DECIMAL(18,2)) AS meia_par, CAST(trunc(v) AS INTEGER) AS inteiro
    FROM (SELECT p_partkey, CAST(p_partkey * 5 AS DECIMAL(18,3)) / 1000 AS q,
      CAST(CAST(p_partkey * 5 AS DECIMAL(18,3)) * 0.001 AS DECIMAL(18,3)) AS v FROM part)""")
def rounding(inputs: Inputs) -> DataFrame:
    value = (F.col("p_partkey") * 5).cast("decimal(18,3)") * F.lit("0.001").cast("decimal(4,3)")
    value = value.cast("decimal(18,3)")
    return inputs.table("part").select(
        "p_partkey", numbers.round_half_up(value).alias("meia_acima"),
        numbers.round_half_even(value).alias("meia_par"), numbers.trunc_int(value).alias("inteiro"))


_REPAIRED = """CASE WHEN {c} IS NULL THEN NULL WHEN regexp_full_match({c}, '\\d{{2}}\\.\\d{{2}}\\.\\d{{4}}') THEN {c}
    ELSE lpad(split_part({c}, '/', 2), 2, '0') || '.' || lpad(split_part({c}, '/', 1), 2, '0') || '.'
      || CAST(CASE WHEN CAST(split_part({c}, '/', 3) AS INTEGER) > 29 THEN 1900 ELSE 2000 END
        + CAST(split_part({c}, '/', 3) AS INTEGER) AS VARCHAR) END"""


@QUERIES.query(f"""SELECT empresa, material, {_REPAIRED.format(c="data_cadeia")} AS data_cadeia FROM fx_master""")
def date_repair(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_master").select(
        "empresa", "material", dates.repair_date(F.col("data_cadeia")).alias("data_cadeia"))


@QUERIES.query("""
    SELECT DISTINCT data, strftime(data, '%Y/%m') AS ano_mes, CAST(date_trunc('month', data) AS DATE) AS inicio,
      CAST(data + INTERVAL 5 MONTH AS DATE) AS depois, CAST(isodow(data) AS INTEGER) AS dia_semana,
      CAST(week(data) AS INTEGER) AS semana,
      CAST(CASE WHEN month(data) >= 4 THEN year(data) - 1923 ELSE year(data) - 1924 END AS INTEGER) AS ki_numero,
      CAST(CASE WHEN month(data) >= 4 THEN year(data) - 1923 ELSE year(data) - 1924 END AS VARCHAR) || 'ki' AS ki
    FROM fx_sales""")
def date_parts(inputs: Inputs) -> DataFrame:
    day = F.col("data")
    return inputs.view("fx_sales").select("data").distinct().select(
        "data", dates.month_label(day).alias("ano_mes"), dates.month_start(day).alias("inicio"),
        dates.add_months(day, 5).alias("depois"), dates.iso_weekday(day).alias("dia_semana"),
        F.weekofyear(day).alias("semana"), dates.fiscal_number(day).alias("ki_numero"),
        dates.fiscal_label(day).alias("ki"))


@QUERIES.query("SELECT event_id, epoch_us(ts) // 1000 AS millis FROM events")
def epoch_millis(inputs: Inputs) -> DataFrame:
    rows = inputs.table("events")
    # The stored times carry no zone; count them as UTC whatever the session's zone is.
    moment = F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone())
    return rows.select("event_id", dates.to_millis(moment).alias("millis"))


@QUERIES.query("""
    SELECT empresa, material, nullif(trim(item_principal_cadeia), '') IS NULL AS vazio,
      CASE WHEN trim(item_principal_cadeia) <> '' THEN item_principal_cadeia END AS item_principal_cadeia
    FROM fx_master""")
def blank_to_null(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_master").select(
        "empresa", "material", codes.is_blank(F.col("item_principal_cadeia")).alias("vazio"),
        "item_principal_cadeia")
    return blanks_to_null(rows)


@QUERIES.query("SELECT cliente AS cliente, ps AS ps, local AS local, rg AS rg, nome_3 AS nome_3 FROM fx_customer")
def normalize_names(inputs: Inputs) -> DataFrame:
    odd = inputs.view("fx_customer").toDF("Cliente ", "PS.", "Lócal", "(RG)", "Nome  3")
    return normalize_columns(odd)


@QUERIES.query("SELECT * FROM ox_area")
def customer_area(inputs: Inputs) -> DataFrame:
    return customers.customer_area(inputs.view("fx_area"))


@QUERIES.query("SELECT * FROM ox_customer")
def customer_master(inputs: Inputs) -> DataFrame:
    return customers.customer_master(inputs.view("fx_customer"))


@QUERIES.query("""
    SELECT cliente AS original, ltrim(cliente, '0') AS cliente FROM fx_customer""")
def normalize_codes(inputs: Inputs) -> DataFrame:
    code = F.col("CLIENTE")
    return inputs.view("fx_customer").select(
        code.alias("original"), codes.strip_zeros(code).alias("cliente"))


@QUERIES.query("""
    SELECT orgv AS orgv, cen AS original, CASE WHEN cen IS NULL OR trim(cen) = '' THEN
      CASE orgv WHEN '0200' THEN '0203' WHEN '0500' THEN '0503' END ELSE cen END AS cen, count(*) AS linhas
    FROM fx_area GROUP BY ALL""")
def center_default(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_area").select(
        F.col("ORGV").alias("orgv"), F.col("CEN").alias("original"),
        codes.default_center(F.col("ORGV"), F.col("CEN")).alias("cen"))
    return rows.groupBy("orgv", "original", "cen").agg(F.count(F.lit(1)).alias("linhas"))


@QUERIES.query("""
    SELECT m.empresa, m.material, m.principal,
      CASE WHEN m.item_principal_cadeia IS NULL OR upper(trim(m.item_principal_cadeia)) IN ('', 'SIM')
        OR regexp_full_match(trim(m.item_principal_cadeia), '0+(\\.0+)?') THEN m.material
        ELSE m.item_principal_cadeia END AS exportado, v.item_principal_cadeia AS consumidor
    FROM ox_main m JOIN ox_view v ON m.empresa = v.empresa AND m.material = v.material""")
def main_item_fallback(inputs: Inputs) -> DataFrame:
    item, material = F.col("item_principal_cadeia"), F.col("material")
    return inputs.view("fx_master").select(
        "empresa", "material", codes.main_item(item, material).alias("principal"),
        codes.main_item(item, material, zeros=True).alias("exportado"),
        codes.main_item_plain(item, material).alias("consumidor"))


@QUERIES.query("SELECT * FROM ox_chain")
def material_chain(inputs: Inputs) -> DataFrame:
    return materials.material_chain(inputs.view("fx_master"))


@QUERIES.query("""
    SELECT empresa, material, grupo_de_compradores, CASE
      WHEN empresa = '0500' THEN regexp_replace(material, '\\s+[CG]$', '')
      WHEN empresa = '0200' AND coalesce(grupo_de_compradores, '') <> '040' THEN regexp_replace(material, '\\s+C$', '')
      ELSE material END AS limpo FROM fx_master""")
def suffix_clean_chain(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_master").select(
        "empresa", "material", "grupo_de_compradores",
        codes.clean_chain(F.col("material"), F.col("empresa"), F.col("grupo_de_compradores")).alias("limpo"))


@QUERIES.query("SELECT empresa, material, grupo_de_compradores, material_sem_cgn AS limpo FROM ox_codes")
def suffix_clean_cgn(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_master").select(
        "empresa", "material", "grupo_de_compradores",
        codes.clean_variant(F.col("material"), F.col("empresa"), F.col("grupo_de_compradores")).alias("limpo"))


@QUERIES.query("""
    SELECT DISTINCT department, forecast_classification,
      regexp_replace(department, '^(Domestic|Export)\\s*-\\s*', '') AS departamento,
      CASE WHEN contains(forecast_classification, ' - ')
        THEN regexp_extract(forecast_classification, '^.+? - (.+)$', 1) END AS etiqueta
    FROM fx_forecast""")
def forecast_labels(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_forecast").select("department", "forecast_classification").distinct()
    return rows.select(
        "*", codes.strip_market(F.col("department")).alias("departamento"),
        codes.class_tag(F.col("forecast_classification")).alias("etiqueta"))


@QUERIES.query("""
    SELECT empresa, material, sha256(concat_ws('||', coalesce(cadeia, '<NULL>'), coalesce(data_cadeia, '<NULL>'),
      coalesce(status_compra, '<NULL>'))) AS row_hash FROM fx_master""")
def row_hash(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_master").select(
        "empresa", "material", hashing.row_hash(["cadeia", "data_cadeia", "status_compra"]).alias("row_hash"))


@QUERIES.query("""
    SELECT empresa, material, sha256('{"cadeia":' || coalesce('"' || cadeia || '"', 'null') || ',"origem":'
      || coalesce('"' || origem || '"', 'null') || '}') AS payload_hash FROM fx_master""")
def payload_hash(inputs: Inputs) -> DataFrame:
    return inputs.view("fx_master").select(
        "empresa", "material", hashing.payload_hash(["cadeia", "origem"]).alias("payload_hash"))


@QUERIES.query("""
    SELECT org_vendas, canal_dist, centro, CASE org_vendas WHEN '0200' THEN '2W - Motos' WHEN '0500' THEN '4W - Automóveis' END AS segmento,
      CASE canal_dist WHEN '01' THEN 'Domestic' WHEN '02' THEN 'Export' END AS market,
      coalesce(CASE centro WHEN '0203' THEN 'Sumaré 2W' WHEN '0503' THEN 'Sumaré 4W' WHEN '0209' THEN 'Jaboatão 2W'
        WHEN '0505' THEN 'Jaboatão 4W' WHEN '0232' THEN 'Manaus 2W' END, centro) AS centro_nome,
      left(centro, 2) || '00' AS empresa, count(*) AS linhas
    FROM fx_sales GROUP BY ALL""")
def code_labels(inputs: Inputs) -> DataFrame:
    rows = inputs.view("fx_sales").groupBy("org_vendas", "canal_dist", "centro").agg(
        F.count(F.lit(1)).alias("linhas"))
    center = F.col("centro")
    return rows.select(
        "org_vendas", "canal_dist", "centro",
        labels.label(F.col("org_vendas"), labels.SEGMENT_LABELS).alias("segmento"),
        labels.label(F.col("canal_dist"), labels.CHANNEL_MARKETS).alias("market"),
        labels.label(center, labels.CENTER_LABELS, center).alias("centro_nome"),
        codes.company_of(center).alias("empresa"), "linhas")


@QUERIES.query(f"""
    SELECT empresa, material, centro, CAST({" + ".join(f"coalesce({c}, 0)" for c in STOCK_PARTS)} AS DECIMAL(18,2)) AS estoque_total
    FROM ox_stock""")
def stock_total(inputs: Inputs) -> DataFrame:
    parts = [numbers.round_half_up(numbers.locale_decimal(F.col(c))) for c in STOCK_PARTS]
    return inputs.view("fx_stock").select(
        "empresa", "material", "centro", numbers.total_of(parts).alias("estoque_total"))


@QUERIES.query("""
    SELECT CAST(f[1] AS BIGINT) AS numero_ov, CAST(strptime(f[2], '%d.%m.%Y') AS DATE) AS data,
      nullif(f[3], '') AS tipo_ov, nullif(f[4], '') AS motivo_ov, nullif(f[5], '') AS bloqueio_rem,
      nullif(f[6], '') AS motivo_recusa, nullif(f[7], '') AS org_vendas, nullif(f[8], '') AS canal_dist,
      nullif(f[9], '') AS setor_ativ, nullif(f[10], '') AS centro, CAST(nullif(f[11], '') AS BIGINT) AS emissor_da_ordem,
      CAST(NULL AS VARCHAR) AS numero_pedido, nullif(f[12], '') AS autor, CAST(nullif(f[13], '') AS BIGINT) AS item,
      nullif(f[14], '') AS material, nullif(f[15], '') AS categoria_do_item,
      CAST(nullif(f[16], '') AS BIGINT) AS item_superior,
      CAST(CASE WHEN right(f[17], 1) = '-' THEN '-' ELSE '' END
        || replace(replace(rtrim(f[17], '-'), '.', ''), ',', '.') AS DECIMAL(18,3)) AS quantidade,
      nullif(f[18], '') AS um
    FROM (SELECT list_transform(string_split(regexp_replace(regexp_replace(value, '^\\|', ''), '\\|$', ''), '|'),
        lambda x: trim(x)) AS f FROM fx_lines WHERE trim(value) <> '')
    WHERE len(f) = 18 AND f[1] NOT LIKE 'Doc.%' AND regexp_full_match(f[2], '\\d{2}\\.\\d{2}\\.\\d{4}')""")
def sales_parse(inputs: Inputs) -> DataFrame:
    """The lines are written as text files, then read and parsed."""
    path = scratch_path(inputs.spark, "lines")
    inputs.view("fx_lines").write.text(path)
    return sales.parse_sales(read_lines(inputs.spark, path)).drop(*LINEAGE_COLUMNS)


@QUERIES.query("""
    SELECT numero_ov, item, data, material, coalesce(quantidade, 0) AS quantidade, 'INITIAL_LOAD' AS _load_type,
      'carga-1' AS _load_id FROM fx_sales""")
def sales_history(inputs: Inputs) -> DataFrame:
    raw = inputs.view("fx_sales")
    missing = {c: F.lit(None).cast("string") for c in (
        "Motivo OV", "Bloqueio Rem", "Motivo Recusa", "Numero Pedido", "Autor", "Categoria do Item", "UM")}
    raw = raw.withColumns({**missing, "Item Superior": F.lit(None).cast("bigint")})
    now = F.lit("2001-09-01 00:00:00").cast("timestamp")
    return sales.sales_history(raw, "carga-1", now, "planner").select(
        "numero_ov", "item", "data", "material", "quantidade", "_load_type", "_load_id")


@QUERIES.query("""
    SELECT material, empresa, descricao_curta_portugues, descricao_curta_ingles,
      CASE WHEN item_principal_cadeia IS NULL OR upper(trim(item_principal_cadeia)) IN ('', 'SIM')
        OR regexp_full_match(trim(item_principal_cadeia), '0+(\\.0+)?') THEN material
        ELSE item_principal_cadeia END AS item_principal_cadeia, prazo_entrega_prevista_lead_time_firme
    FROM fx_master""")
def material_export(inputs: Inputs) -> DataFrame:
    return materials.material_export(inputs.view("fx_master"))


@QUERIES.query("SELECT * FROM ox_view")
def material_view(inputs: Inputs) -> DataFrame:
    return materials.material_view(inputs.view("fx_master"))
