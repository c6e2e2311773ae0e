import pytest
from datetime import datetime

from eventlake.sources.members import activity_events, messaging_events, without_redeliveries
from eventlake.sources.validate import (
    check_changes, decodable, parse_envelopes, quarantined, usable, validate_events)

GOOD = '"event_id":"a","event_type":"t","metric":"m","ts":"2025-05-04T10:20:30Z"'


def reasons(spark, parse, texts):
    rows = parse(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string"))
    assert usable(rows).count() + quarantined(rows).count() == len(texts)
    return [r.reason for r in rows.orderBy("i").collect()]


def test_event_rules(spark):
    cases = {
        "{" + GOOD + "}": None,
        "{" + GOOD + ',"value":"1.5","unknown":[1],"extra":{"k":1}}': None,
        "{" + GOOD + ',"user_id":null}': None,
        "{" + GOOD + ',"value":null}': "bad_value",
        "{" + GOOD + ',"value":"x"}': "bad_value",
        "{" + GOOD + ',"user_id":7}': "bad_user_id",
        "{" + GOOD + ',"extra":null}': "bad_extra",
        "{" + GOOD: "malformed_json",
        "{" + GOOD + "} tail": "malformed_json",
        "[1]": "not_an_object",
        None: "malformed_json",
        '{"event_type":"t","metric":"m","ts":"2025-05-04"}': "missing_event_id",
        '{"event_id":5,"event_type":"t","metric":"m","ts":"2025-05-04"}': "bad_event_id",
        '{"event_id":"a","event_type":"t","metric":null,"ts":"2025-05-04"}': "missing_metric",
        '{"event_id":"a","event_type":"t","metric":"m","ts":"soon"}': "bad_ts",
        '{"event_id":"a","event_type":"t","metric":"m","ts":1770465605}': None,
    }
    assert reasons(spark, validate_events, cases) == list(cases.values())


def test_event_values(spark):
    texts = ["{" + GOOD + "}", "{" + GOOD + ',"value":3}',
             '{"event_id":"a","event_type":"t","metric":"m","ts":"2025-05-04T12:20:30+02:00"}',
             '{"event_id":"a","event_type":"t","metric":"m","ts":1746354030000}']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    rows = usable(validate_events(df)).orderBy("i").collect()
    assert [r.value for r in rows] == [1.0, 3.0, 1.0, 1.0]
    assert {r.ts for r in rows} == {datetime(2025, 5, 4, 10, 20, 30)}


def test_envelope_rules(spark):
    cases = {
        '{"idempotency_key":"k","payload":{"order_id":"o-1","amount_kobo":5,"new":1}}': None,
        '{"idempotency_key":5,"payload":{"order_id":7}}': None,
        '{"idempotency_key":"","payload":{"order_id":"o"}}': "missing_idempotency_key",
        '{"payload":{"order_id":"o"}}': "missing_idempotency_key",
        '{"idempotency_key":"k","payload":null}': "missing_order_id",
        '{"idempotency_key":"k"}': "missing_order_id",
        '{"idempotency_key":"k"': "malformed_json",
        "nope": "malformed_json",
        None: "malformed_json",
        "[1]": "not_an_object",
    }
    assert reasons(spark, parse_envelopes, cases) == list(cases.values())
    df = spark.createDataFrame([(t,) for t in cases], "value string")
    assert decodable(parse_envelopes(df)).count() == 6
    first = parse_envelopes(df).first()
    assert (first.order_id, first.amount_kobo, first.customer_id, first.schema_version) == (
        "o-1", 5, None, 1)


def test_change_operations(spark):
    df = spark.createDataFrame([("d", "r", "upsert", 1), ("d", "r", "merge", 1), ("d", None, "delete", 1)],
                               "dataset string, record_id string, op string, version long")
    assert [r.reason for r in check_changes(df).collect()] == [None, "unknown_op", "missing_key"]


def test_member_events_need_a_member_and_a_time(spark):
    cases = {
        '{"memberId":"m","eventType":"play","eventTsMs":5,"new":{"a":1}}': None,
        '{"memberId":"m","eventTsMs":5}': None,
        '{"eventType":"play","eventTsMs":5}': "missing_member",
        '{"memberId":"m","eventType":"play"}': "missing_time",
        '{"memberId":"m"': "malformed_json",
        None: "malformed_json",
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)], "`offset` long, value string")
    assert [r.reason for r in activity_events(df).orderBy("seq").collect()] == list(cases.values())


def test_redelivered_messages_count_once(spark):
    texts = ['{"memberId":"m","eventType":"sent","eventTsMs":5,"messageId":"a","channel":"push"}'] * 2
    texts += ['{"memberId":"m","eventType":"open","eventTsMs":6,"messageId":"a"}']
    texts += ['{"memberId":"m","eventType":"open","eventTsMs":7}'] * 2
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "`offset` long, value string")
    assert sorted(r.seq for r in without_redeliveries(usable(messaging_events(df))).collect()) == [0, 2, 3, 4]


@pytest.mark.parametrize("tail", ['{"x":1}', " junk}", "}", ",{}", '],[{"x":1}', ',"b":{}', "]", " null"])
@pytest.mark.parametrize("lead", ["", " ", "\n"])
def test_text_after_a_record_is_malformed(spark, lead, tail):
    event, envelope = lead + "{" + GOOD + "}", lead + '{"idempotency_key":"k","payload":{"order_id":"o"}}'
    df = spark.createDataFrame([(0, event), (1, event + " \n"), (2, event + tail), (3, envelope), (4, envelope + "\t"), (5, envelope + tail)],
                               "i int, value string")
    events = {r.i: r.reason for r in validate_events(df.where("i < 3")).collect()}
    assert events == {0: None, 1: None, 2: "malformed_json"}
    orders = {r.i: r.reason for r in parse_envelopes(df.where("i > 2")).collect()}
    assert orders == {3: None, 4: None, 5: "malformed_json"}
