"""Change-log rows from a stream into the index."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from eventlake.operators.index import IndexStore
from eventlake.sources.validate import check_changes, usable
from eventlake.streaming.sinks import COMPACT_EVERY, each_batch


def follow_log(log: DataFrame, store: IndexStore, run: str, checkpoint: str,
               every: str | None = None, clock: Callable[[], float] = time.time,
               compact_every: int | None = COMPACT_EVERY) -> StreamingQuery:
    """Apply every change of a log; rows with an unknown operation are left out."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        store.apply_batch(usable(check_changes(batch)), int(clock()), run, batch_id)

    return each_batch(log, apply, checkpoint, "append", every, store.compact, compact_every)
