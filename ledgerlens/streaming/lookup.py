"""Rows whose key a table does not hold yet."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Keys are broadcast to a stored table while there are no more than this (tens of MB).
BROADCAST_KEYS = 1_000_000


def unseen(rows: DataFrame, stored: DataFrame, key: str, count: int | None = None) -> DataFrame:
    """``rows`` without those whose ``key`` is in ``stored``.

    A small batch (``count`` rows, known by the caller) is sent to where the stored keys
    lie; of the table only the few matching keys move. Otherwise both sides meet by key.
    """
    if count is None or count > BROADCAST_KEYS:
        return rows.join(stored.select(key), key, "left_anti")
    held = stored.select(key).join(F.broadcast(rows.select(key)), key, "left_semi")
    return rows.join(held, key, "left_anti")
