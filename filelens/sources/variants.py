"""JSON text whose shape nobody declared, by way of VARIANT.

The text is parsed once into a VARIANT, and the union of all rows' shapes is an
aggregate over them (``schema_of_variant_agg``, merged like any other partial
aggregate), so there is no sample and no inference pass over files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filelens.functions.flatten import flatten
from filelens.operators.catalogue import union_labels

_TOKEN = re.compile(r"`(?:[^`]|``)*`|DECIMAL\(\d+, ?\d+\)|[^<>,:\s]+|[<>,:]")


def variant_type(shape: str) -> str:
    """The Spark type of a VARIANT schema: an ``OBJECT`` is a struct, a number
    with a fraction a double (as Spark's JSON reader has it), a value that is
    null everywhere (``VOID``) or one of several kinds (``VARIANT``) its text."""
    names = {"OBJECT": "STRUCT", "VOID": "STRING", "VARIANT": "STRING"}
    typed = "".join("DOUBLE" if t.startswith("DECIMAL(") else names.get(t, t) for t in _TOKEN.findall(shape))
    return re.sub(r"STRUCT(?!<)", "STRUCT<>", typed)


def parse_undeclared(df: DataFrame, column: str, bad: str = "raise") -> DataFrame:
    """``df`` with the JSON text of ``column`` parsed under the union of the
    shapes of all its rows (two passes: one for the union, one to read).

    Text that is no JSON raises; with ``bad="null"`` it becomes null.  A column
    without any JSON stays text.
    """
    if bad not in ("raise", "null"):
        raise ValueError("bad must be 'raise' or 'null'")
    c = F.col(f"`{column}`")
    parsed = F.try_parse_json(c) if bad == "null" else F.parse_json(c)
    shape = df.agg(F.schema_of_variant_agg(parsed).alias("shape")).first().shape  # one string
    if shape is None or not shape.startswith(("OBJECT<", "ARRAY<OBJECT<")):
        return df
    # parse errors are the first pass's to report
    return df.withColumn(column, F.from_json(F.when(parsed.isNotNull(), c), variant_type(shape)))


def flatten_undeclared(df: DataFrame, column: str, sep: str = ".", depth: int | None = None, bad: str = "raise") -> DataFrame:
    """:func:`parse_undeclared`, then one column for every field at any depth."""
    return flatten(parse_undeclared(df, column, bad), sep=sep, depth=depth)


def union_undeclared(frames: list[DataFrame], column: str) -> DataFrame:
    """Frames of one key layout whose JSON ``column`` differs in shape, stacked:
    the column gets the union of all their fields."""
    return parse_undeclared(union_labels(frames), column)
