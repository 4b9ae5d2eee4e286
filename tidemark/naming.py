"""Physical naming: camelCase source fields become snake_case columns, nesting joins with ``__``."""

from __future__ import annotations

import re

_LOWER_UPPER = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_ACRONYM_END = re.compile(r"(?<=[A-Z])(?=[A-Z][a-z])")

NEST_SEP = "__"


def snake_case(name: str) -> str:
    """``totalPriceSet`` -> ``total_price_set``; ``countryCodeV2`` -> ``country_code_v2``; ``_loaded_at`` unchanged."""
    out = _ACRONYM_END.sub("_", name)
    out = _LOWER_UPPER.sub("_", out)
    return out.lower()


def nested_name(path: list[str], snake: bool = True) -> str:
    parts = [snake_case(p) if snake else p for p in path]
    return NEST_SEP.join(parts)
