"""Whether a text is one JSON value is told by one parse, and a message passes one generator."""

import pytest

from eventlake.sources.validate import parse_envelopes, validate_events

EVENT = '{"event_id":"e","event_type":"t","metric":"m","ts":1700000000,"props":%s}'
ENVELOPE = '{"idempotency_key":"k","payload":{"order_id":"o"},"more":%s}'


def test_envelopes_take_one_generator(spark):
    plan = parse_envelopes(spark.createDataFrame([(0, "{}")], "i int, value string"))
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("Generate ") == 1


@pytest.mark.parametrize("tail", ["", " ", ",null", ",[7", ",[", "]", "],[{}", ',"\\u005d"', ",[7]"])
@pytest.mark.parametrize("inner", ['"x"', "[1]", '"]"', "{}"])
def test_only_one_value_is_well_formed(spark, inner, tail):
    df = spark.createDataFrame([(ENVELOPE % inner + tail, EVENT % inner + tail)], "a string, b string")
    reason = "malformed_json" if tail.strip() else None
    assert parse_envelopes(df, "a").first().reason == reason
    assert validate_events(df, "b").first().reason == reason
