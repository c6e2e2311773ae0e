import hashlib
import json

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from eventlake.functions.keys import (
    clean_dims, dims_hash, dims_json, dims_map_json, idempotency_key, idempotency_text, spaced_json)

TEXT = st.text(st.characters(exclude_categories=("Cs",)), max_size=12) | st.text(
    st.sampled_from([*map(chr, range(33)), "\\", "u", "0", "1", "B", "F", "\x7f"]), max_size=12)


@settings(max_examples=5, deadline=None)
@given(rows=st.lists(st.tuples(TEXT, st.one_of(st.none(), TEXT), st.integers(-2**62, 2**62)),
                     min_size=1, max_size=30))
def test_keys_equal_plain_json_hashing(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string, n long")
    payload = spaced_json({"b": F.col("b"), "a": F.col("a"), "n": F.col("n")})
    got = df.select(
        "a", "b", "n", dims_hash(dims_json({"b": F.col("b"), "a": F.col("a")})).alias("dims"),
        idempotency_key(idempotency_text(F.lit("t"), F.col("a"), payload)).alias("key")).collect()
    for r in got:
        dims = {k: v for k, v in (("a", r.a), ("b", r.b)) if v is not None}
        text = json.dumps(dims, sort_keys=True, separators=(",", ":"))
        assert r.dims == hashlib.sha256(text.encode()).hexdigest()[:32]
        text = json.dumps({"t": "t", "id": r.a, "p": {"a": r.a, "b": r.b, "n": r.n}}, sort_keys=True)
        assert r.key == hashlib.sha256(text.encode()).hexdigest()


def test_dimension_maps_are_cleaned(spark):
    dims = {"z": " q\n", "a": "\t ", "m": None, "k": "é"}
    row = spark.createDataFrame([(dims,)], "dims map<string,string>").select(
        clean_dims(F.col("dims")).alias("d"), dims_map_json(clean_dims(F.col("dims"))).alias("j")).first()
    assert row.d == {"z": "q", "k": "é"}
    assert row.j == '{"k":"é","z":"q"}'
