"""Code-to-label lookups."""

from __future__ import annotations

from collections.abc import Mapping
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from partflow.config import DOMESTIC, EXPORT, SEGMENTS

# Labels.
SEGMENT_LABELS = {s.org: s.label for s in SEGMENTS.values()}
MARKET_LABELS = {DOMESTIC: "Doméstico", EXPORT: "Exportação"}
FORECAST_MARKET_LABELS = {"Domestic": "Doméstico", "Export": "Exportação"}
CHANNEL_MARKETS = {DOMESTIC: "Domestic", EXPORT: "Export"}
MARKET_TAGS = {DOMESTIC: "MI", EXPORT: "ME"}
CENTER_LABELS = {
    "0203": "Sumaré 2W", "0503": "Sumaré 4W", "0209": "Jaboatão 2W",
    "0505": "Jaboatão 4W", "0232": "Manaus 2W",
}
ORIGIN_LABELS = {
    "1": "Fornecedor São Paulo", "2": "Fábrica HDA", "3": "Importado",
    "4": "Fornecedor Manaus", "5": "Fábrica HAB",
}
WEEKDAYS_PT = ("Segunda", "Terça", "Quarta", "Quinta", "Sexta", "Sábado", "Domingo")
WEEKDAYS_EN = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")
MONTHS_PT = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho", "Julho", "Agosto",
    "Setembro", "Outubro", "Novembro", "Dezembro",
)
MONTHS_EN = (
    "January", "February", "March", "April", "May", "June", "July", "August",
    "September", "October", "November", "December",
)


def label(c: Column, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """The label of a code; ``default`` (NULL unless given) for unknown codes."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    found = F.try_element_at(table, c)
    return found if default is None else F.coalesce(found, default)


def name_at(position: Column, names: tuple[str, ...]) -> Column:
    """The ``position``-th name, counted from 1."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), position)
