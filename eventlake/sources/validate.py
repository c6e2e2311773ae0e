"""Split raw JSON text into usable records and quarantined ones with a reason.

``reason`` is null on usable records, so usable plus quarantined is always the whole input. Metric
events are parsed into a VARIANT, which keeps "absent", "null" and the JSON type of a field apart;
envelopes, whose rules are looser, take the faster way through ``from_json``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from eventlake.sources.schemas import record

REQUIRED_TEXT = ("event_id", "event_type", "metric")
OPTIONAL_TEXT = ("user_id", "customer_id", "endpoint", "status")

ORDER_TEXTS = record(**{n: "string" for n in (
    "order_id", "customer_id", "amount_kobo", "currency", "status")})

# Fixed value: numeric event times above this are milliseconds, up to it seconds.
EPOCH_SECONDS_LIMIT = 20_000_000_000


def _first_reason(checks: Sequence[tuple[str, Column]]) -> Column:
    return F.coalesce(*[F.when(failed, F.lit(reason)) for reason, failed in checks])


def _one_value(text: Column) -> Column:
    """Whether a text is one JSON value and nothing else; true, false or null.

    The parsers stop after the first value and do not look at the rest, so that the text is put into a
    list. A text without a ``]`` closes no list: this one ends behind its own bracket or is an error, and
    its second entry is the list added here only where the text is one entry. One parse tells. Other texts
    are parsed inside a list and inside an object: what ends the one early is an error in the other.
    """
    marked = F.try_parse_json(F.concat(F.lit("["), text, F.lit(",[7]]")))
    single = F.try_variant_get(marked, "$[1][0]", "int").isNotNull()
    listed = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    named = F.try_parse_json(F.concat(F.lit('{"a":'), text, F.lit("}")))
    alone = F.size(F.try_variant_get(listed, "$", "array<variant>")) == 1
    return F.when(~text.contains("]"), single).otherwise(named.isNotNull() & F.coalesce(alone, F.lit(False)))


def _computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a costly column that later filters read instead of copying its expression.

    Filters are pushed through plain projections, which would parse the text again for every check
    on it; they stop at a generator, here one that makes exactly one row of each.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def _event_time(kind: Column, field: Column) -> Column:
    number = field.try_cast("double")
    seconds = F.when(F.abs(number) <= EPOCH_SECONDS_LIMIT, number).otherwise(number / 1000)
    return F.when(kind == "STRING", field.try_cast("string").try_cast("timestamp")) \
        .otherwise(F.timestamp_micros(F.round(seconds * 1_000_000).cast("long")))


def validate_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """Metric events with a ``reason`` column.

    The four required fields must be present, ``value`` defaults to 1.0 only when absent, a null
    ``value`` is rejected, and unknown fields are ignored.
    """
    kept = [c for c in messages.columns if c != value]
    names = (*REQUIRED_TEXT, "ts", *OPTIONAL_TEXT, "value", "extra")
    spec = ", ".join(f"{n}: variant" for n in names)
    parsed = F.when(_one_value(F.col(value)), F.try_parse_json(value))
    # A cast of an object to a struct keeps absent fields (null) and JSON nulls (VOID) apart.
    fields = F.try_variant_get(F.col("parsed"), "$", f"struct<{spec}>")
    read = _computed_once(_computed_once(messages, "parsed", parsed), "record", fields).withColumns(
        {f"{n}_kind": F.schema_of_variant(F.col("record")[n]) for n in names})

    def field(name: str) -> Column:
        return F.col("record")[name]

    def kind(name: str) -> Column:
        """JSON type of a field: null when absent, ``VOID`` when it is a JSON null."""
        return F.col(f"{name}_kind")

    amount = F.when(kind("value").isNull(), F.lit(1.0)).otherwise(field("value").try_cast("double"))
    typed = read.select(
        *kept, F.col(value).alias("raw"), "parsed", "record", *[f"{n}_kind" for n in names],
        *[field(n).try_cast("string").alias(n) for n in REQUIRED_TEXT + OPTIONAL_TEXT],
        amount.alias("value"), _event_time(kind("ts"), field("ts")).alias("ts"),
        F.to_json(field("extra")).alias("extra"))
    required = (*REQUIRED_TEXT, "ts")
    checks = [("malformed_json", F.col("parsed").isNull()), ("not_an_object", F.col("record").isNull())]
    checks += [(f"missing_{n}", kind(n).isNull() | (kind(n) == "VOID")) for n in required]
    checks += [(f"bad_{n}", kind(n) != "STRING") for n in REQUIRED_TEXT]
    checks += [(f"bad_{n}", ~kind(n).isin("STRING", "VOID")) for n in OPTIONAL_TEXT]
    checks += [("bad_value", F.col("value").isNull()), ("bad_ts", F.col("ts").isNull()),
               ("bad_extra", ~kind("extra").startswith("OBJECT"))]
    return typed.withColumn("reason", _first_reason(checks)).drop(
        "parsed", "record", *[f"{n}_kind" for n in names])


def parse_envelopes(messages: DataFrame, value: str = "value") -> DataFrame:
    """Change envelopes with a ``reason`` column.

    The order columns are read from the payload by name, so new payload keys pass through and absent
    ones are null. ``payload`` is its whole JSON text; it costs nothing where it is not used.
    """
    kept = [c for c in messages.columns if c != value]
    texts = ("event_id", "event_type", "aggregate_type", "aggregate_id", "idempotency_key")
    schema = record(
        **{n: "string" for n in (*texts, "emitted_at", "schema_version")}, payload=ORDER_TEXTS)
    text = F.ltrim(F.col(value), F.lit(" \t\r\n"))
    is_object = text.startswith("{")
    parsed = F.struct(
        F.when(is_object, F.from_json(value, schema, {"allowSingleQuotes": "false"})).alias("read"),
        F.coalesce(_one_value(F.col(value)), F.lit(False)).alias("alone"))
    read = _computed_once(messages, "parsed", parsed).select("*", "parsed.*")
    shape = F.when(~F.col("alone"), "malformed_json").when(~is_object, "not_an_object")
    typed = read.select(
        *kept, F.col(value).alias("raw"), shape.alias("shape"),
        *[F.coalesce(f"read.{n}", F.lit("")).alias(n) for n in texts],
        F.coalesce(F.get_json_object(value, "$.payload"), F.lit("{}")).alias("payload"),
        "read.emitted_at",
        F.coalesce(F.col("read.schema_version").try_cast("int"), F.lit(1)).alias("schema_version"),
        F.coalesce("read.payload.order_id", F.lit("")).alias("order_id"), "read.payload.customer_id",
        F.col("read.payload.amount_kobo").try_cast("long").alias("amount_kobo"),
        "read.payload.currency", "read.payload.status")
    return typed.withColumn("reason", F.coalesce("shape", _first_reason([
        ("missing_idempotency_key", F.col("idempotency_key") == ""),
        ("missing_order_id", F.col("order_id") == ""),
    ]))).drop("shape")


def usable(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reason").isNull()).drop("reason", "raw")


def quarantined(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("reason").isNotNull())


def decodable(envelopes: DataFrame) -> DataFrame:
    """Envelopes the raw lake and the checkpoints keep: readable objects, usable or not."""
    return envelopes.where(
        F.col("reason").isNull() | F.col("reason").startswith("missing_"))


def check_changes(log: DataFrame) -> DataFrame:
    """Change-log rows with a ``reason`` column; only the two known operations are usable."""
    return log.withColumn("reason", _first_reason([
        ("unknown_op", F.col("op").isNull() | ~F.col("op").isin("upsert", "delete")),
        ("missing_key", F.col("dataset").isNull() | F.col("record_id").isNull()),
        ("missing_version", F.col("version").isNull()),
    ]))
