"""B12 PII pseudonymisation of dotted paths (``customer.email``, ``refunds[*].note``)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions.hashing import pii_hash
from .nested import rewrite_paths

# The default PII path sets (must match the source pipeline's choices).
ORDER_PII_PATHS = [
    "email", "phone", "note",
    "customer.email", "customer.firstName", "customer.lastName", "customer.phone",
    "billingAddress.firstName", "billingAddress.lastName", "billingAddress.name",
    "billingAddress.address1", "billingAddress.address2", "billingAddress.phone",
    "shippingAddress.firstName", "shippingAddress.lastName", "shippingAddress.name",
    "shippingAddress.address1", "shippingAddress.address2", "shippingAddress.phone",
]
LINE_ITEM_PII_PATHS: list[str] = []
REFUND_PII_PATHS = ["note"]
JOURNEY_PII_PATHS: list[str] = []
CUSTOMER_PII_PATHS = ["firstName", "lastName", "note", "email", "phone"]

# Stricter opt-in set: fields that carry personal data but are left clear by the defaults.
STRICT_EXTRA_ORDER_PATHS = [
    "shippingLines[*].phone",
    "customerJourneySummary.firstVisit.referrerUrl",
    "customerJourneySummary.lastVisit.referrerUrl",
]


def hash_pii_paths(df: DataFrame, paths: Iterable[str], secret: str | bytes | None) -> DataFrame:
    """Hash every scalar at the given paths; NULL stays NULL, absent paths are skipped.

    Containers (struct / array / map) at a leaf are left untouched: only values are hashed.
    Non-string scalars are hashed from their Spark string form.
    """

    def fn(c: Column, dtype: DataType) -> Column:
        if isinstance(dtype, (StructType, ArrayType, MapType)):
            return c
        return pii_hash(c, secret)

    return rewrite_paths(df, paths, fn)


def nested_paths(prefix: str, paths: Iterable[str]) -> list[str]:
    """Re-root a per-element path set under an array: (``refunds``, ``note``) -> ``refunds[*].note``."""
    return [f"{prefix}[*].{p}" for p in paths]
