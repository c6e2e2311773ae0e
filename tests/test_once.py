"""Shared inputs are computed once."""

import pytest
from pyspark.sql import functions as F

from eventlake.operators.daystore import KeyLedger
from eventlake.operators.warehouse import Warehouse
from eventlake.plans import queries
from eventlake.sources.schemas import record
from test_stores import envelope, order

FOLDER = "/root/testdata/sf0.001"


def test_keys_are_not_looked_at_where_nothing_is_stored(spark, tmp_path):
    ledger = KeyLedger(spark, str(tmp_path), record(key="string", n="long"), "key")
    broken = spark.range(3).select(F.raise_error(F.lit("looked at")).cast("string").alias("key"), F.col("id").alias("n"))
    assert ledger.possible_days(broken) == []


def test_first_deliveries_of_a_batch_are_found_once(spark, tmp_path, monkeypatch):
    asked, unseen = [], KeyLedger.unseen

    def spy(self, rows, *rest):
        asked.append(rows.storageLevel.useMemory)
        return unseen(self, rows, *rest)

    monkeypatch.setattr(KeyLedger, "unseen", spy)
    Warehouse(spark, str(tmp_path)).apply_batch(envelope(spark, (1, order("k1")), (2, order("k2"))), "r", 0)
    assert asked == [True]


@pytest.mark.parametrize("name", ["wh_dedup", "wh_dedup_filtered"])
def test_dedup_reads_envelopes_parsed_once(spark, name):
    read = queries.QUERIES[name](spark, FOLDER).inputFiles()
    assert read and not any("orders.parquet" in f for f in read)


@pytest.mark.parametrize("name,purpose", [("reconcile_tree", "orders"), ("stream_wh_checkpoints", "order-messages")])
def test_costly_inputs_are_written_once(spark, monkeypatch, name, purpose):
    kept, written = [], queries.written
    monkeypatch.setattr(queries, "written", lambda df, to: kept.append(to) or written(df, to))
    queries.QUERIES[name](spark, FOLDER)
    assert kept == [purpose]
