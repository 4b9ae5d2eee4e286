"""ISO-8601 instants <-> timestamps, and money strings -> doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_instant(c: Column | str) -> Column:
    """ISO-8601 text (``Z`` or offset) -> TIMESTAMP (UTC instant). Bad text -> NULL."""
    return F.try_to_timestamp(_col(c))


def format_instant(c: Column | str, micros: bool = True) -> Column:
    """TIMESTAMP / TIMESTAMP_NTZ (read as UTC) -> ISO-8601 text ending in ``Z``."""
    return F.date_format(_col(c), ISO_MICROS if micros else ISO_SECONDS)


def as_utc_ntz(c: Column | str) -> Column:
    """UTC wall-clock view of an instant, for comparison with engines without zoned timestamps."""
    return _col(c).cast("timestamp_ntz")


def money_amount(c: Column | str) -> Column:
    """Money amount string -> double; empty or malformed -> NULL."""
    return F.nullif(F.trim(_col(c)), F.lit("")).try_cast("double")
