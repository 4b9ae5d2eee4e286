"""Global-id (``gid://<app>/<Type>/<n>?<query>``) normalisation as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GID_MARKER = "gid://"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def gid_to_long(c: Column | str) -> Column:
    """Numeric id of a GID string; NULL for empty input or a non-numeric tail.

    Text after the last ``/`` when the value contains ``gid://``, cut before the first ``?``, then an
    integer cast that yields NULL instead of failing (``try_cast``). Plain strings skip the ``/`` step,
    as a bigint column hint would treat them.
    """
    s = _col(c).cast("string")
    # Cut at single characters: splitting by patterns costs several times as much, for every id of every table.
    tail = F.when(s.contains(GID_MARKER), F.substring_index(s, "/", -1)).otherwise(s)
    return F.substring_index(tail, "?", 1).try_cast("bigint")


def to_gid(kind: str, c: Column | str, query: str | None = None) -> Column:
    """Inverse helper used to land ids in GID form: ``gid://shop/<kind>/<n>[?query]``."""
    parts = [F.lit(f"{GID_MARKER}shop/{kind}/"), _col(c).cast("string")]
    if query:
        parts.append(F.lit(f"?{query}"))
    return F.concat(*parts)
