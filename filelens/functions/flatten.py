"""Flatten nested structs by walking the schema - a single lazy ``select``.

``flatten(df, sep="_", depth=1)`` turns ``a{b}`` into ``a_b`` one level deep;
``flatten(df, sep=".", depth=None)`` flattens every level into dotted names.
Arrays and maps are passed through untouched; structs with no fields vanish
(as empty JSON objects do).  The schema is known up front, so no rows are
looked at and no schema is re-inferred.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def flat_columns(schema: T.StructType, sep: str = "_", depth: int | None = None) -> list[tuple[str, list[str]]]:
    """(output name, field path) for every leaf the flattening produces."""
    out: list[tuple[str, list[str]]] = []

    def walk(field_path: list[str], dtype: T.DataType, level: int) -> None:
        if isinstance(dtype, T.StructType) and field_path and (depth is None or level <= depth):
            for child in dtype.fields:
                walk(field_path + [child.name], child.dataType, level + 1)
            return
        out.append((sep.join(field_path), field_path))

    for f in schema.fields:
        if isinstance(f.dataType, T.StructType) and (depth is None or depth >= 1):
            for child in f.dataType.fields:
                walk([f.name, child.name], child.dataType, 2)
        else:
            out.append((f.name, [f.name]))
    return out


def nested_field(path: str | list[str]) -> Column:
    """A nested field reference from ``"a.b.c"`` or ``["a", "b", "c"]``;
    each name is taken literally (names may contain any character)."""
    parts = path.split(".") if isinstance(path, str) else path
    c = F.col(f"`{parts[0]}`")
    for name in parts[1:]:
        c = c.getField(name)
    return c


def flatten(df: DataFrame, sep: str = "_", depth: int | None = None, case_sensitive: bool | None = None) -> DataFrame:
    """Flatten struct columns of ``df`` (see module doc).

    Two sources giving the same output name (``a{b}`` next to a top-level
    ``a_b``) raise ``ValueError`` naming both, instead of one silently
    replacing the other.  Unless the session is case sensitive, names that
    differ only in case also clash.
    """
    if case_sensitive is None:
        case_sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false").lower() == "true"
    leaves = flat_columns(df.schema, sep, depth)
    seen: dict[str, list[str]] = {}
    for name, path in leaves:
        key = name if case_sensitive else name.lower()
        if key in seen:
            raise ValueError(
                f"flattened name {name!r} comes from both {'.'.join(seen[key])!r} and {'.'.join(path)!r}"
            )
        seen[key] = path
    return df.select(*[nested_field(path).alias(name) for name, path in leaves])


#: Keys of a map column that may become columns.
MOST_KEYS = 10_000


def map_keys(df: DataFrame, column: str, most: int = MOST_KEYS) -> list[str]:
    """All keys of a map column, sorted: a job of its own over the whole
    column.  They become column names, so a map of more than ``most`` keys
    raises instead of filling the driver with them."""
    keys = df.select(F.explode(F.map_keys(F.col(f"`{column}`"))).alias("k")).distinct().limit(most + 1).collect()
    if len(keys) > most:
        raise ValueError(f"{column!r} has more than {most} keys; keep it a map, or name the keys wanted")
    return sorted(str(r.k) for r in keys)


def flatten_map(df: DataFrame, column: str, keys: list[str], sep: str = "_") -> DataFrame:
    """Turn a map column into one column per key (``m{k}`` -> ``m_k``).

    Map keys vary by row, so the output columns are named by ``keys``
    (:func:`map_keys` finds them).  Rows without a key get null in its column.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != column]
    taken = set(df.columns) - {column}
    new_cols = []
    for k in keys:
        name = f"{column}{sep}{k}"
        if name in taken:
            raise ValueError(f"flattened name {name!r} clashes with an existing column")
        taken.add(name)
        new_cols.append(F.col(f"`{column}`").getItem(k).alias(name))
    return df.select(*others, *new_cols)
