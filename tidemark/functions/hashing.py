"""PII pseudonymisation: SHA-256 or keyed HMAC-SHA256, both as JVM-side expressions.

HMAC (RFC 2104) needs only two SHA-256 passes over byte strings, so it is spelled with ``sha2``,
``unhex`` and binary ``concat``; the two padded keys are computed once on the driver and enter the
plan as literals. No Python runs per row.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64  # SHA-256 block size in bytes


def hmac_pads(secret: str | bytes) -> tuple[str, str]:
    """Hex of (key XOR ipad, key XOR opad) for HMAC-SHA256."""
    key = secret.encode("utf-8") if isinstance(secret, str) else secret
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\x00")
    inner = bytes(b ^ 0x36 for b in key)
    outer = bytes(b ^ 0x5C for b in key)
    return inner.hex(), outer.hex()


def _as_text(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def sha256_hex(c: Column | str) -> Column:
    """Lower-case hex SHA-256 of the UTF-8 text; NULL stays NULL."""
    return F.sha2(F.encode(_as_text(c), "UTF-8"), 256)


def hmac_sha256_hex(c: Column | str, secret: str | bytes) -> Column:
    """Lower-case hex HMAC-SHA256(secret, text); NULL stays NULL."""
    ipad, opad = hmac_pads(secret)
    msg = F.encode(_as_text(c), "UTF-8")
    inner = F.sha2(F.concat(F.unhex(F.lit(ipad)), msg), 256)
    return F.sha2(F.concat(F.unhex(F.lit(opad)), F.unhex(inner)), 256)


def pii_hash(c: Column | str, secret: str | bytes | None) -> Column:
    """HMAC when a secret is given, plain SHA-256 when ``secret is None``.

    An empty secret is rejected instead of silently downgrading to unkeyed hashing.
    """
    if secret is None:
        return sha256_hex(c)
    if len(secret) == 0:
        raise ValueError("empty PII secret: pass secret=None to allow unkeyed SHA-256")
    return hmac_sha256_hex(c, secret)
