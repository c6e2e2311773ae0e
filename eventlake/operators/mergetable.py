"""Current-state tables on plain Parquet: written as batches, merged when read.

Plain Parquet tables have no MERGE. A batch therefore writes only its own folder
``open/segment=S/run=R/batch_id=N``, in overwrite mode, so a retried batch replaces itself; readers keep,
per key, the row that is last in the *data's* order (offset, version, …), wherever it lies. Compaction is an
ordinary job that merges the batches of the open segment once into ``closed/segment=S``; a closed segment is
never read for writing again, so a compaction costs what came since the last one, however large the table.
Later batches go to the next segment. One writer at a time; where the catalog supports row-level changes,
``DataFrame.mergeInto`` does this instead. The open folder of a closed segment is no longer read; removing it
is left to the owner of the storage.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from eventlake.session import WITHOUT_DICTIONARY, shuffles_removed
from eventlake.sources.schemas import record

FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)


def fold(rows: DataFrame, keys: Sequence[str], order: Sequence[str],
         earliest: Sequence[str] = ()) -> DataFrame:
    """Per key the row that is greatest by ``order``; ``earliest`` columns keep their smallest value.

    An aggregation, not a window: equal keys are reduced before the shuffle, whatever their number. Values of
    fixed width are kept one by one, which a hash aggregate can do; others are kept as one struct, for which
    the rows are sorted by their keys.
    """
    rest = [c for c in rows.columns if c not in keys and c not in earliest]
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    if len(order) == 1 and isinstance(kinds[order[0]], T.IntegralType) and all(isinstance(kinds[c], FIXED_WIDTH) for c in rest):
        place = F.coalesce(F.col(order[0]).cast("long"), F.lit(-(2 ** 63)))  # rows without an order come first
        kept = [F.max_by(c, place).alias(c) for c in rest]
        return rows.groupBy(*keys).agg(*kept, *[F.min(c).alias(c) for c in earliest]).select(*rows.columns)
    last = F.max_by(F.struct(*rest), F.struct(*order)).alias("last")
    merged = rows.groupBy(*keys).agg(last, *[F.min(c).alias(c) for c in earliest])
    return merged.select(*keys, "last.*", *earliest).select(*rows.columns)


class MergeTable:
    """``finish`` merges the rows of a segment when it is closed, unless ``fold`` by the keys does.

    ``part`` names a column of the schema by which a batch is filed in folders of their own, in the same
    write; a read that asks for one of its values opens those files alone.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str],
                 order: Sequence[str], earliest: Sequence[str] = (),
                 finish: Callable[[DataFrame], DataFrame] | None = None, part: str | None = None):
        self.spark, self.path, self.schema = spark, path, schema
        self.keys, self.order, self.earliest = list(keys), list(order), list(earliest)
        self.finish = finish or (lambda rows: fold(rows, self.keys, self.order, self.earliest))
        self.parts = [part] if part else []
        for name, places in (("open", ["segment", "run", "batch_id"]), ("closed", ["segment"])):
            none = spark.createDataFrame([], self._layout(name))
            none.write.mode("ignore").partitionBy(*places, *self.parts).parquet(f"{path}/{name}")

    def write(self, rows: DataFrame, run: str, batch_id: int) -> None:
        """Store one batch; writing the same batch again changes nothing."""
        self._save(rows, f"{self.path}/open/segment={self._open_segment()}/run={run}/batch_id={batch_id}")

    def batches(self) -> DataFrame:
        """All stored rows; ``run`` and ``batch_id`` are null for those of closed segments."""
        closed, done = self._files("closed"), self._open_segment() - 1
        opened = self._files("open").where(F.col("segment") > done)
        return opened.unionByName(closed, allowMissingColumns=True).drop("segment")

    def read(self) -> DataFrame:
        rows = self.batches().drop("run", "batch_id")
        return fold(rows, self.keys, self.order, self.earliest)

    def compact(self) -> None:
        """Merge the batches of the open segment and close it; nothing is done where there are none."""
        segment = self._open_segment()
        rows = self._files("open").where(F.col("segment") == segment)
        if any(f"/segment={segment}/" in f for f in rows.inputFiles()):
            self._save(self.finish(rows.select(*self.schema.names)), f"{self.path}/closed/segment={segment}")

    def _save(self, rows: DataFrame, path: str) -> None:
        with shuffles_removed(rows.sparkSession):
            rows.select(*self.schema.names).write.mode("overwrite").options(**WITHOUT_DICTIONARY) \
                .partitionBy(*self.parts).parquet(path)

    def _open_segment(self) -> int:
        """One more than the last closed segment, from the file list alone."""
        found = [int(m[1]) for f in self._files("closed").inputFiles() if (m := re.search(r"/closed/segment=(\d+)/", f))]
        return max(found, default=-1) + 1

    def _layout(self, name: str) -> T.StructType:
        own = [f for f in self.schema.fields if f.name not in self.parts]
        places = record(segment="integer", **({"run": "string", "batch_id": "long"} if name == "open" else {}))
        return T.StructType([*own, *places.fields, *[self.schema[p] for p in self.parts]])

    def _files(self, name: str) -> DataFrame:
        return self.spark.read.schema(self._layout(name)).parquet(f"{self.path}/{name}")
