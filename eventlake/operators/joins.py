"""Joins with a side whose size is checked before it is broadcast."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

BROADCAST_ROWS = 100_000


def checked_broadcast(small: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``small`` with a broadcast hint if it has at most ``max_rows`` rows, else unchanged.

    Meant for control tables (checkpoints, rebuild marks): counting up to the limit is cheap there.
    """
    return F.broadcast(small) if small.limit(max_rows + 1).count() <= max_rows else small


def without_known(rows: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``known``, a table that grows without end.

    ``known`` is first reduced to the keys that occur in ``rows``. A small ``rows`` is then the
    broadcast side of that semi join, so a large ``known`` is scanned but never shuffled.
    """
    keys = list(keys)
    seen = known.select(*keys).join(rows.select(*keys), keys, "left_semi").distinct()
    return rows.join(seen, keys, "left_anti")
