"""Business configuration: segments, demand views and the fixed code lists."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Segment:
    org: str
    tag: str
    wheels: str
    label: str
    centers: tuple[str, ...]
    default_center: str


@dataclass(frozen=True)
class DemandView:
    """One monthly demand view, described as data.

    ``center_orgs`` lists the organisations that also get one sheet per centre;
    every organisation gets the total sheet.
    """

    key: str
    suffix: str
    grain: str = "item_principal_cadeia"
    measure: str = "sum"
    channel: str | None = None
    only_type: str | None = None
    exclude_type: str | None = None
    center_orgs: tuple[str, ...] = ()
    by_customer: bool = False
    months: int = 60

    @property
    def item_label(self) -> str:
        return "Material" if self.grain == "material" else "Item Principal Cadeia"


# Organisations, distribution centres and file prefixes.
SEGMENTS = {
    "0200": Segment("0200", "HDA", "2W", "2W - Motos", ("0203", "0209", "0232"), "0203"),
    "0500": Segment("0500", "HAB", "4W", "4W - Automóveis", ("0503", "0505"), "0503"),
}
MOTORCYCLES, CARS = "0200", "0500"
BOTH = (MOTORCYCLES, CARS)
TOTAL_SHEET = "TTL"

# Order types and channels.
INITIAL_EXPORT, URGENT_WARRANTY = "ZESP", "ZPUG"
DOMESTIC, EXPORT = "01", "02"

DEMAND_VIEWS = {
    v.key: v
    for v in (
        DemandView("fechada", "Demanda Fechada", center_orgs=BOTH),
        DemandView("fechada_sem_zesp", "Demanda Fechada sem ZESP",
                   exclude_type=INITIAL_EXPORT, center_orgs=BOTH),
        DemandView("aberta", "Demanda Aberta", grain="material", center_orgs=BOTH),
        DemandView("linha", "Demanda Linha", measure="count", center_orgs=BOTH),
        DemandView("mi", "Demanda MI", channel=DOMESTIC, center_orgs=(MOTORCYCLES,)),
        DemandView("me", "Demanda ME", channel=EXPORT),
        DemandView("me_sem_zesp", "Demanda ME sem ZESP", channel=EXPORT,
                   exclude_type=INITIAL_EXPORT),
        DemandView("zpug", "Pedido ZPUG", only_type=URGENT_WARRANTY),
        DemandView("zpug_cliente", "Pedido ZPUG Cliente", only_type=URGENT_WARRANTY,
                   by_customer=True, months=12),
    )
}

# Material master domains.
MATERIAL_TYPES = ("ZHAW", "ZFER", "ZRO1")
IN_HOUSE_BUYERS = ("040", "054")
KEEP_SUFFIX_BUYER = "040"

# Material history.
HISTORY_KEYS = ("empresa", "material")
HISTORY_TRACKED = (
    "intercambiabilidade", "item_principal_cadeia", "data_cadeia", "cut_in_material",
    "cut_off_material", "cadeia", "modelo_comercial_principal", "status_compra", "lead_time",
)
HISTORY_DATES = ("cut_in_material", "cut_off_material", "data_cadeia")
LEAD_TIME_SOURCE = "prazo_entrega_prevista_lead_time_firme"

# Inventory snapshot.
INVENTORY_KEYS = ("empresa", "material", "centro")
INVENTORY_QUANTITIES = (
    "estoque_livre_no_centro", "estoque_disponivel_para_venda", "estoque_bloqueado",
    "estoque_em_transito", "estoque_em_poder_de_terceiros", "estoque_em_controle_qualidade",
    "estoque_devolucoes", "saldo_da_carteira_de_pedidos", "quantidade_em_pi",
    "quantidade_em_bo", "preco_de_rede_price_de_venda_liquida",
)
STOCK_PARTS = (
    "estoque_livre_no_centro", "estoque_bloqueado", "estoque_em_transito",
    "estoque_em_poder_de_terceiros", "estoque_em_controle_qualidade",
)

# Sales text layout, in file order.
SALES_LAYOUT = (
    "numero_ov", "data", "tipo_ov", "motivo_ov", "bloqueio_rem", "motivo_recusa",
    "org_vendas", "canal_dist", "setor_ativ", "centro", "emissor_da_ordem", "autor",
    "item", "material", "categoria_do_item", "item_superior", "quantidade", "um",
)
SALES_COLUMNS = {
    "numero_ov": "bigint", "data": "date", "tipo_ov": "string", "motivo_ov": "string",
    "bloqueio_rem": "string", "motivo_recusa": "string", "org_vendas": "string",
    "canal_dist": "string", "setor_ativ": "string", "centro": "string",
    "emissor_da_ordem": "bigint", "numero_pedido": "string", "autor": "string",
    "item": "bigint", "material": "string", "categoria_do_item": "string",
    "item_superior": "bigint", "quantidade": "decimal(18,3)", "um": "string",
}
SALES_KEYS = ("numero_ov", "item")
SALES_FILE_PATTERN = r"^salesorder_raw_(\d{4}-\d{2})_(\d{4})_(\dW)\.txt$"

LINEAGE_COLUMNS = (
    "_source_file_name", "_source_file_path", "_source_file_modification_time",
)
AUDIT_COLUMNS = (
    "_ingested_at", "_last_updated_at", "_ingested_by", "_load_type", "_load_id",
)
LOCAL_ZONE = "America/Sao_Paulo"

# Forecast.
FORECAST_IDS = (
    "forecast_cycle", "department", "forecast_type", "segment", "market",
    "main_material", "forecast_classification",
)
HORIZON = tuple(f"n+{i}" for i in range(36))
REFINED_LAGS = 12
FORECAST_GROUP = ("forecast_cycle", "segment", "material", "forecast_month")
NEGATIVE_LIMIT = -1e-6

# Spreadsheet delivery limits.
SHEET_MAX_ROWS = 1_000_000
SHEET_MAX_CELLS = 5_000_000
SHEET_NAME_LENGTH = 31
DEFAULT_SHEET = "Planilha"
