"""Column-name rules. These work on names only, never on rows."""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterable, Mapping


def normalize_name(name: str | None) -> str:
    """``"Cód. Cliente (SAP)"`` becomes ``"cod_cliente_sap"``."""
    if not name:
        return "col_unknown"
    plain = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode("ascii")
    return "_".join(re.findall(r"[a-z0-9]+", plain.lower()))


def unique_names(names: Iterable[str]) -> list[str]:
    """Repeated names get ``_1``, ``_2`` … in order of appearance."""
    seen: Counter[str] = Counter()
    result = []
    for name in names:
        result.append(f"{name}_{seen[name]}" if seen[name] else name)
        seen[name] += 1
    return result


def normalized_names(names: Iterable[str], rename: Mapping[str, str] | None = None) -> list[str]:
    rename = rename or {}
    return unique_names(rename.get(n, n) for n in map(normalize_name, names))
