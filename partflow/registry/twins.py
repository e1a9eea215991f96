"""Derived inputs of the SQL twins, written for DuckDB independently of the Spark plans."""

from __future__ import annotations

from partflow.config import INVENTORY_QUANTITIES, STOCK_PARTS


def locale_number(c: str) -> str:
    t = f"regexp_replace({c}, '[\\sR$]', '', 'g')"
    return (
        f"CASE WHEN {t} = '' THEN NULL WHEN {t} LIKE '%E%' THEN CAST(CAST({t} AS DOUBLE) AS DECIMAL(38,6)) "
        f"WHEN {t} LIKE '%.%,%' OR ({t} LIKE '%,%' AND {t} NOT LIKE '%.%') OR regexp_full_match({t}, '\\d{{1,3}}(\\.\\d{{3}})+') "
        f"THEN CAST(replace(replace({t}, '.', ''), ',', '.') AS DECIMAL(38,6)) "
        f"ELSE CAST(replace({t}, ',', '') AS DECIMAL(38,6)) END"
    )


SALES_COLUMNS = ("data", "tipo_ov", "org_vendas", "canal_dist", "setor_ativ", "centro", "emissor_da_ordem", "material", "quantidade")

TWIN_VIEWS: dict[str, str] = {
    # One row per order item: the greatest by its columns, from left to right.
    "ox_keyed": f"""
        SELECT * FROM fx_sales QUALIFY row_number() OVER (
          PARTITION BY numero_ov, item ORDER BY {", ".join(f"{c} DESC NULLS LAST" for c in SALES_COLUMNS)}) = 1""",
    "ox_area": """
        SELECT ltrim(cliente, '0') AS cliente, orgv AS orgv, cdst AS cdst, sa AS sa,
          CASE WHEN cen IS NULL OR trim(cen) = '' THEN CASE orgv WHEN '0200' THEN '0203' WHEN '0500' THEN '0503' END
            ELSE cen END AS cen FROM fx_area""",
    "ox_customer": """
        SELECT ltrim(cliente, '0') AS cliente, ps AS pais, local AS cidade, rg AS estado, nome_3 AS razao_social
        FROM fx_customer""",
    "ox_main": """
        SELECT *, CASE WHEN item_principal_cadeia IS NULL OR upper(trim(item_principal_cadeia)) IN ('', 'SIM')
          THEN material ELSE item_principal_cadeia END AS principal FROM fx_master""",
    "ox_chain": """
        SELECT empresa, material, CASE
          WHEN empresa = '0500' THEN regexp_replace(principal, '\\s+[CG]$', '')
          WHEN empresa = '0200' AND coalesce(trim(grupo_de_compradores), '') <> '040'
            THEN regexp_replace(principal, '\\s+C$', '')
          ELSE principal END AS item_principal_cadeia FROM ox_main""",
    "ox_view": """
        SELECT * REPLACE (CASE WHEN upper(item_principal_cadeia) = 'SIM' OR item_principal_cadeia IS NULL
          THEN material ELSE item_principal_cadeia END AS item_principal_cadeia) FROM fx_master""",
    "ox_anchor": "SELECT CAST(date_trunc('month', max(data)) AS DATE) AS m FROM fx_sales",
    "ox_sales": """
        SELECT s.*, coalesce(c.item_principal_cadeia, s.material) AS item_principal_cadeia,
          a.cen AS centro_original, k.razao_social, k.estado, k.pais,
          CAST(date_trunc('month', s.data) AS DATE) AS mes
        FROM fx_sales s
        LEFT JOIN ox_chain c ON s.material = c.material AND s.org_vendas = c.empresa
        LEFT JOIN ox_area a ON CAST(s.emissor_da_ordem AS VARCHAR) = a.cliente AND s.org_vendas = a.orgv
          AND s.canal_dist = a.cdst AND s.setor_ativ = a.sa
        LEFT JOIN ox_customer k ON CAST(s.emissor_da_ordem AS VARCHAR) = k.cliente
        WHERE s.data >= (SELECT m - INTERVAL 59 MONTH FROM ox_anchor)""",
    "ox_sales_keyed": """
        SELECT s.*, coalesce(c.item_principal_cadeia, s.material) AS item_principal_cadeia,
          a.cen AS centro_original, k.razao_social, k.estado, k.pais,
          CAST(date_trunc('month', s.data) AS DATE) AS mes
        FROM ox_keyed s
        LEFT JOIN ox_chain c ON s.material = c.material AND s.org_vendas = c.empresa
        LEFT JOIN ox_area a ON CAST(s.emissor_da_ordem AS VARCHAR) = a.cliente AND s.org_vendas = a.orgv
          AND s.canal_dist = a.cdst AND s.setor_ativ = a.sa
        LEFT JOIN ox_customer k ON CAST(s.emissor_da_ordem AS VARCHAR) = k.cliente
        WHERE s.data >= (SELECT m - INTERVAL 59 MONTH FROM ox_anchor)""",
    "ox_base": """
        SELECT CAST(numero_ov AS VARCHAR) AS numero_ordem_venda, CAST(item AS VARCHAR) AS item_ordem_venda,
          data AS data_ordem, tipo_ov AS tipo_ordem_venda, org_vendas AS organizacao_vendas,
          canal_dist AS canal_distribuicao, CAST(emissor_da_ordem AS VARCHAR) AS codigo_cliente,
          centro AS centro_fornecedor, material AS codigo_material,
          CAST(trunc(quantidade) AS INTEGER) AS quantidade, item_principal_cadeia,
          centro_original AS centro_distribuicao_original, razao_social AS cliente, estado AS uf_cliente,
          pais AS pais_cliente,
          CASE org_vendas WHEN '0200' THEN '2W - Motos' WHEN '0500' THEN '4W - Automóveis' END AS segmento,
          CASE canal_dist WHEN '01' THEN 'Doméstico' WHEN '02' THEN 'Exportação' END AS mercado,
          CASE centro WHEN '0203' THEN 'Sumaré 2W' WHEN '0503' THEN 'Sumaré 4W' WHEN '0209' THEN 'Jaboatão 2W'
            WHEN '0505' THEN 'Jaboatão 4W' WHEN '0232' THEN 'Manaus 2W' END AS centro_nome
        FROM ox_sales""",
    "ox_codes": """
        SELECT *, CASE WHEN regexp_matches(material, '\\s+(N|C|NP)$') THEN regexp_replace(material, '\\s+(N|C|NP)$', '')
          WHEN regexp_matches(material, '\\s+G$') AND (empresa = '0500'
            OR (empresa = '0200' AND grupo_de_compradores <> '040')) THEN regexp_replace(material, '\\s+G$', '')
          ELSE material END AS material_sem_cgn FROM fx_master""",
    "ox_stock": "SELECT empresa, material, centro, tipo_de_material, "
    + ", ".join(f"CAST(round({locale_number(c)}, 2) AS DECIMAL(18,2)) AS {c}" for c in INVENTORY_QUANTITIES)
    + " FROM fx_stock",
    "ox_inventory": f"""
        SELECT DISTINCT centro, material, empresa, {", ".join(INVENTORY_QUANTITIES)},
          CAST({" + ".join(f"coalesce({c}, 0)" for c in STOCK_PARTS)} AS DECIMAL(18,2)) AS estoque_total
        FROM ox_stock WHERE tipo_de_material IN ('ZHAW', 'ZFER', 'ZRO1')""",
    "ox_refined_all": f"""
        SELECT CAST(f.forecast_cycle AS DATE) AS forecast_cycle,
          regexp_replace(department, '^(Domestic|Export)\\s*-\\s*', '') AS department, forecast_type, segment, market,
          main_material AS material, coalesce(c.item_principal_cadeia, main_material) AS main_material,
          forecast_classification, CASE WHEN contains(forecast_classification, ' - ')
            THEN regexp_extract(forecast_classification, '^.+? - (.+)$', 1) END AS forecast_classification_tag,
          lag, CAST(CAST(forecast_cycle AS DATE) + to_months(lag) AS DATE) AS forecast_month,
          CAST(CASE WHEN regexp_matches(texto, '^\\s*$') THEN '0' ELSE texto END AS DOUBLE) AS forecast_qty,
          _load_id AS _raw_load_id
        FROM (SELECT *, unnest([{", ".join(str(i) for i in range(36))}]) AS lag,
            unnest([{", ".join(f"h{i}" for i in range(36))}]) AS texto FROM fx_forecast) f
        LEFT JOIN ox_chain c ON f.segment = c.empresa AND f.main_material = c.material""",
    "ox_refined": """
        SELECT * FROM ox_refined_all WHERE NOT (forecast_type = 'Enrich' AND forecast_qty = 0) AND lag <= 11""",
    "ox_edges": """
        SELECT DISTINCT s.empresa, s.componente_item AS item_principal_cadeia_componente,
          p.principal AS item_principal_cadeia_material_produzido
        FROM (SELECT b.empresa, b.material, c.principal AS componente_item,
            count(*) OVER (PARTITION BY b.empresa, b.material) AS n
          FROM (SELECT left(centro, 2) || '00' AS empresa, material, componente FROM fx_bom
            WHERE NOT regexp_matches(material, '\\s+(C|G|NP)$')) b
          JOIN ox_main c ON b.empresa = c.empresa AND b.componente = c.material
          WHERE c.tipo_de_material IN ('ZHAW', 'ZFER', 'ZRO1')) s
        JOIN ox_main p ON s.empresa = p.empresa AND s.material = p.material
        WHERE s.n = 1 AND NOT regexp_matches(s.componente_item, '\\s+N$')
          AND p.grupo_de_compradores NOT IN ('040', '054')""",
    "ox_depara": """
        SELECT d.empresa, d.material, d.material_sem_cgn,
          coalesce(m.principal, d.material_sem_cgn) AS item_principal_cadeia_material_sem_cgn,
          coalesce(e.item_principal_cadeia_material_produzido, m.principal, d.material_sem_cgn)
            AS item_principal_cadeia_material_final
        FROM ox_codes d LEFT JOIN ox_main m ON d.empresa = m.empresa AND d.material_sem_cgn = m.material
        LEFT JOIN ox_edges e ON d.empresa = e.empresa
          AND coalesce(m.principal, d.material_sem_cgn) = e.item_principal_cadeia_componente
        WHERE d.tipo_de_material IN ('ZHAW', 'ZFER', 'ZRO1')""",
}
