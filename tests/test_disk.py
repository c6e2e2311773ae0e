"""What stored batches cost: no dictionaries of unique texts, no shuffle files and no inputs that are done with."""

import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from eventlake.functions.keys import FLAT_LENGTH, known_json, sorted_json
from eventlake.operators.warehouse import LAKE_COLUMNS, Warehouse
from eventlake.plans import queries
from eventlake.session import SHUFFLE_CLEANUP, emptied, shuffles_removed, written
from test_staging import TEXTS
from test_stores import envelope, order

FOLDER = "/root/testdata/sf0.001"
NAMES = ("b", "a", "a_", "aa")


def test_known_names_give_the_same_text(spark):
    more = ['{"a":1,"b":2}', '{"a":1,}', '{,"a":1}', '{"a":1"b":2}', '{"b":2,"a":1}', '{"a":1,"c":2}', '{"a":"}","b":"{,"}',
            '{"a":1}}', '{"a":1,"a":2}', '{"a":1,"b":2,}', '{"a":"' + "x" * FLAT_LENGTH + '"}', '{"a":1,"b":[2]}']
    given = spark.createDataFrame([(t,) for t in [*TEXTS, *more]], "x string")
    rows = given.select("x", sorted_json(F.col("x"), NAMES).alias("new"), F.to_json(F.try_parse_json("x")).alias("old"))
    assert [r for r in rows.collect() if r.new != r.old] == []
    known = {r.x for r in given.where(F.col("x").rlike(known_json(NAMES))).collect()}
    assert {"{}", '{"a":1,"b":2}', '{"a":"}","b":"{,"}'} <= known
    assert not known & {'{"a":1,}', '{"a":1"b":2}', '{"b":2,"a":1}', '{"a":1,"c":2}', '{"a":1,"a":2}', '{"a":1}\n'}


def test_stored_files_have_no_dictionaries(spark, tmp_path):
    Warehouse(spark, str(tmp_path)).apply_batch(envelope(spark, (1, order("k1")), (2, order("k2"))), "r", 0)
    for place in ("lake", "orders", "ledger/rows"):
        used = set()
        for file in (tmp_path / place).rglob("*.parquet"):
            meta = pq.ParquetFile(file).metadata
            used |= {e for g in range(meta.num_row_groups) for c in range(meta.num_columns)
                     for e in meta.row_group(g).column(c).encodings}
        assert used and not any("DICTIONARY" in e for e in used)
    assert set(LAKE_COLUMNS) <= set(spark.read.parquet(str(tmp_path / "lake/orders")).columns)


def _shuffles(spark) -> set[str]:
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for i in range(files.size()) if (name := files.apply(i).getName()).startswith("shuffle")}


def test_a_written_frame_leaves_no_shuffle_files(spark):
    before = _shuffles(spark)
    rows = written(spark.range(100_000).groupBy((F.col("id") % 50_000).alias("k")).agg(F.max("id").alias("m")), "rows")
    left = _shuffles(spark) - before
    for _ in range(50):
        left &= _shuffles(spark)
        if not left:
            break
        time.sleep(0.2)
    assert not left and rows.count() == 50_000


@pytest.mark.parametrize("given", ["true", "false"])
def test_the_setting_is_taken_back(spark, given):
    session = spark.newSession()
    session.conf.set(SHUFFLE_CLEANUP, given)
    with pytest.raises(ZeroDivisionError), shuffles_removed(session):
        assert session.conf.get(SHUFFLE_CLEANUP) == "true"
        raise ZeroDivisionError
    assert session.conf.get(SHUFFLE_CLEANUP) == given


def test_emptied_rows_are_gone(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("eventlake.session.scratch_dir", lambda session, purpose: str(tmp_path / f"{purpose} é%"))
    rows = written(spark.range(10), "some rows")
    emptied(rows)
    assert spark.read.parquet(str(tmp_path / "some rows é%")).count() == 0


@pytest.mark.parametrize("name,purposes,rows", [
    ("stream_wh_checkpoints", ["order-messages"], 6), ("wh_dedup_filtered", ["envelopes", "known"], None)])
def test_inputs_that_are_done_with_are_emptied(spark, monkeypatch, name, purposes, rows):
    kept, made = {}, queries.written

    def spy(df, purpose):
        kept[purpose] = made(df, purpose)
        return kept[purpose]

    monkeypatch.setattr(queries, "written", spy)
    found = queries.QUERIES[name](spark, FOLDER).count()
    assert found == rows if rows else found > 0
    for purpose in purposes:
        again = spark.read.schema(kept[purpose].schema).parquet(kept[purpose].inputFiles()[0].rsplit("/", 1)[0])
        assert again.count() == 0
