"""Canonical JSON text, stable hashes and dimension maps."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, functions as F

# Fixed value: length of a dimension key, in hex digits of a SHA-256.
DIMS_HASH_LENGTH = 32


def strip(value: Column) -> Column:
    """Remove leading and trailing white space of every kind, not only blanks."""
    return F.regexp_replace(value, r"^[\s\x0B\x1C-\x1F\x85\p{Z}]+|[\s\x0B\x1C-\x1F\x85\p{Z}]+$", "")


def clean_dim(value: Column) -> Column:
    """A dimension value as stripped text; null when nothing is left."""
    return F.nullif(strip(value.cast("string")), F.lit(""))


def clean_dims(dims: Column) -> Column:
    """``clean_dim`` over every entry of a map; empty entries are dropped."""
    cleaned = F.transform_values(dims, lambda _, value: clean_dim(value))
    return F.map_filter(cleaned, lambda _, value: value.isNotNull())


# Control characters that ``to_json`` writes with capital hex digits.
CAPITAL_ESCAPES = ("0B", "0E", "0F", "1A", "1B", "1C", "1D", "1E", "1F")


def _small_hex(text: Column) -> Column:
    """Escapes of control characters in small letters; a doubled backslash starts no escape."""
    changed = text
    for digits in CAPITAL_ESCAPES:
        changed = F.regexp_replace(changed, r"(?<!\\)((?:\\\\)*\\u00)" + digits, "$1" + digits.lower())
    return F.when(text.contains("\\u00"), changed).otherwise(text)


def ascii_json(text: Column) -> Column:
    """Escape every character of JSON text beyond ``~`` as UTF-16 ``\\uXXXX`` units, in small letters."""
    text = _small_hex(text)
    escaped = F.array_join(
        F.transform(
            F.split(text, ""),
            lambda ch: F.when(
                ch.rlike(r"[^\x00-\x7E]"),
                F.regexp_replace(F.lower(F.hex(F.encode(ch, "UTF-16BE"))), "(.{4})", r"\\u$1"),
            ).otherwise(ch),
        ),
        "",
    )
    return F.when(text.rlike(r"[^\x00-\x7E]"), escaped).otherwise(text)


def json_scalar(value: Column) -> Column:
    """The JSON text of one scalar column, ``null`` included.

    Brackets inside a text are safe: its quotes come first from either end.
    """
    return F.btrim(F.to_json(F.array(value)), F.lit("[]"))


def spaced_json(fields: Mapping[str, Column], raw: Collection[str] = (),
                only_if: Mapping[str, Column] | None = None) -> Column:
    """A JSON object with sorted keys and ``", "`` / ``": "`` separators.

    Fields named in ``raw`` already hold JSON text; a field named in ``only_if`` is left out where
    its condition does not hold (not possible for the first key).
    """
    only_if = only_if or {}
    parts = []
    for i, name in enumerate(sorted(fields)):
        value = fields[name] if name in raw else json_scalar(fields[name])
        part = [F.lit(("{" if i == 0 else ", ") + f'"{name}": '), value]
        if name in only_if:
            part = [F.when(only_if[name], F.concat(*part)).otherwise("")]
        parts += part
    return F.concat(*parts, F.lit("}")) if parts else F.lit("{}")


# A flat object as ``to_json`` writes it, whatever the order of its keys: plain names, ASCII texts without escapes,
# whole numbers, no white space. Longer texts are not looked at, since a group is repeated by recursion.
FLAT_NAME, FLAT_LENGTH = r'"([A-Za-z0-9_]+)":', 4000
FLAT_VALUE = r'(?:"[ !#-\[\]-~]*+"|0|-?[1-9][0-9]{0,17}+|true|false|null)'
FLAT_FIELD = FLAT_NAME.replace("(", "(?:") + FLAT_VALUE
FLAT_JSON = rf"^\{{(?:{FLAT_FIELD}(?:,{FLAT_FIELD})*+)?\}}\z"


def known_json(names: Collection[str]) -> str:
    """Matches flat objects with any of the plain ``names`` in ascending order and no others."""
    fields = [rf'(?:"{name}":{FLAT_VALUE}(?:,(?=")|(?=\}})))?+' for name in sorted(names)]
    return rf"^\{{{''.join(fields)}\}}\z"


def sorted_json(text: Column, names: Collection[str] = ()) -> Column:
    """JSON text with sorted keys and no white space, null where it is not JSON.

    A flat object whose keys ascend is that already and only looked through, at a fraction of what reading
    and writing it costs. Where it has only ``names``, its own need not be taken out of it to see that.
    """
    found = F.regexp_extract_all(text, F.lit(FLAT_NAME), F.lit(1))
    ascending = found == F.sort_array(F.array_distinct(found))
    short = F.length(text) <= FLAT_LENGTH
    rest = F.when(short & text.rlike(FLAT_JSON) & ascending, text).otherwise(F.to_json(F.try_parse_json(text)))
    return F.when(short & text.rlike(known_json(names)), text).otherwise(rest) if names else rest


def dims_json(dims: Mapping[str, Column]) -> Column:
    """Compact key-sorted JSON of cleaned dimension columns; null dimensions are left out."""
    if not dims:
        return F.lit("{}")
    return F.to_json(F.struct(*[dims[name].alias(name) for name in sorted(dims)]))


def dims_map_json(dims: Column) -> Column:
    """Compact key-sorted JSON of a dimension map."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(dims))))


def dims_hash(json_text: Column) -> Column:
    """Stable dimension key: the leading hex digits of the SHA-256 of canonical JSON."""
    return F.substring(F.sha2(ascii_json(json_text), 256), 1, DIMS_HASH_LENGTH)


def dims_as_map(dims: Mapping[str, Column]) -> Column:
    """The cleaned dimension columns as a map without null entries."""
    if not dims:
        return F.create_map().cast("map<string,string>")
    pairs = [part for name in sorted(dims) for part in (F.lit(name), dims[name])]
    return F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())


def idempotency_text(event_type: Column, aggregate_id: Column, payload_json: Column) -> Column:
    """The text an idempotency key is made from: equal events give equal text on every retry."""
    return spaced_json({"t": event_type, "id": aggregate_id, "p": payload_json}, raw=("p",))


def idempotency_key(text: Column) -> Column:
    """SHA-256 of ``idempotency_text``."""
    return F.sha2(ascii_json(text), 256)


def derived_uuid(*parts: Column) -> Column:
    """A UUID-shaped id computed from ``parts``, so recomputing a lost task yields the same id."""
    digest = F.sha2(F.concat_ws("|", *[p.cast("string") for p in parts]), 256)
    spans = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in spans])
