"""What the operators share: result columns beside any input columns, whole texts in batches, words."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from eventlake.session import stored

__all__ = ["alnum_words", "ascii_lower", "beside", "bind", "fresh", "on_texts", "prepare_python", "quoted", "stored", "text_key"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ARROW_ROWS, ARROW_BYTES = "2000", str(16 << 20)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def beside(df: DataFrame, result: Column, names: list[str]) -> DataFrame:
    """``df`` with the fields of the struct ``result``; columns of the same name give way to them."""
    found, clash = fresh(df, "found"), {n.lower() for n in names}
    kept = [c for c in df.columns if c.lower() not in clash]
    held = df.select(*[quoted(c) for c in kept], result.alias(found))
    return held.select(*[quoted(c) for c in kept], *[F.col(found)[n].alias(n) for n in names])


def on_texts(rows: Callable[[list], list[tuple]], schema: str) -> Callable[[Column], Column]:
    """A column function that hands whole texts to ``rows``, one Arrow batch at a time.

    ``rows`` takes a list of texts (None for null) and returns one tuple per text.
    """
    names = [f.name for f in T._parse_datatype_string(schema).fields]

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            values = [None if t is None or t != t else t for t in texts]
            yield pd.DataFrame(rows(values), columns=names)

    return run


def prepare_python(spark: SparkSession) -> None:
    """Make a session ready for Python on executors.

    Arrow batches are limited by bytes as well as rows, so that very long texts cannot fill a worker.
    Workers on machines where the package lies at the same place as here also find it without being
    installed.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
    root, environment = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    places = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in places:
        environment["PYTHONPATH"] = os.pathsep.join([*places, root])


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z in small letters and every other character as it is; null gives ''."""
    text = F.coalesce(text, F.lit(""))
    plain = F.char_length(text) == F.octet_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def alnum_words(text: Column) -> Column:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the lower-cased text."""
    gaps = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return F.array_remove(F.split(ascii_lower(text), gaps), "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once.

    The optimizer may otherwise copy an expression into a lambda that uses it once, where it would
    be computed again for every element.
    """
    return F.transform(F.array(value), body)[0]


def text_key(text: Column) -> Column:
    """A digest that stands for a whole text in joins and groups."""
    return F.md5(F.coalesce(text, F.lit("")))
