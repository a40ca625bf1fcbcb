"""Global order positions without a single-partition window.

``row_number() over (order by k)`` with no partition moves every row into
one task.  :func:`global_row_index` cuts the order into ranges whose bounds are
fixed first: rows chosen by the least hashes, a bounded number for each range,
give the bounds; each row finds its range by bisection over them.  Only the
bounds (on the driver) and the rows of each range (a table of one row a range,
broadcast) are kept; the frame itself is neither checkpointed nor stored.  Ties
on the key are broken by hashes of the whole row, which a repeated task gives
again, so the positions do not hang on how the input is split.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a range, on average, and the chosen rows that bound each range.
ROWS_A_RANGE, CHOSEN_A_RANGE = 500_000, 20
#: Ranges at most: their bounds are literals of the plan.
MOST_RANGES = 4096


def _named(c: str) -> Column:
    return F.col(f"`{c}`")


def _place(bounds: Column, n: int, key: Column, df: DataFrame, out: str, step_col: str) -> DataFrame:
    """Column ``out``: how many of the ``n`` sorted ``bounds`` are not above ``key``."""
    df = df.withColumn(step_col, key).withColumn(out, F.lit(0))
    step = 1 << max(n.bit_length() - 1, 0)
    while step and n:
        ahead = F.col(out) + step
        fits = F.when(ahead <= n, F.element_at(bounds, F.least(ahead, F.lit(n))) <= F.col(step_col)).otherwise(F.lit(False))
        df = df.withColumn(out, F.when(fits, ahead).otherwise(F.col(out)))
        step >>= 1
    return df.drop(step_col)


def cut_ranges(df: DataFrame, order: Sequence[str], ranges: int, out: str) -> DataFrame:
    """``df`` with an integer column ``out``, the range of each row: at most
    ``ranges`` of them, ascending in the order of ``order`` (nulls first), of
    about as many rows each.

    The bounds come from ``CHOSEN_A_RANGE`` rows a range, those of the least
    hashes of ``order``: equal rows give equal bounds however they are split,
    and equal keys lie in one range.  One job over the columns of ``order``.
    """
    ranges = max(1, min(ranges, MOST_RANGES))
    rows = []
    if ranges > 1:
        keys = df.select(*map(_named, order))
        chosen = keys.orderBy(F.xxhash64(*map(_named, order)), *map(_named, order)).limit(ranges * CHOSEN_A_RANGE)
        # a bounded number of rows, sorted by Spark's own order
        rows = chosen.orderBy(*[_named(c).asc_nulls_first() for c in order]).collect()
        rows = [rows[i * len(rows) // ranges] for i in range(1, ranges)] if rows else []
    if not rows:
        return df.withColumn(out, F.lit(0))
    types = {f.name: f.dataType for f in df.schema.fields}
    bounds = F.array(*[F.struct(*[F.lit(v).cast(types[c]).alias(c) for c, v in zip(order, r, strict=True)]) for r in rows])
    return _place(bounds, len(rows), F.struct(*map(_named, order)), df, out, f"__{out}_key")


def global_row_index(df: DataFrame, order_by: Sequence[str], index_col: str = "row_index",
                     num_partitions: int | None = None) -> DataFrame:
    """0-based position of each row in the total order of ``order_by`` (nulls first).

    ``num_partitions`` is the number of ranges; by default it follows from the
    number of rows.  The frame is read three times (the bounds, the counts, the
    result): give it a table or a plan that gives the same rows each time.
    Rows that are equal in every column are interchangeable; they lie in one
    range.
    """
    key, tie1, tie2, at, local, n, offset = (f"__filelens_{x}" for x in ("key", "tie1", "tie2", "range", "local", "n", "offset"))
    clash = {key, tie1, tie2, at, local, n, offset, index_col} & set(df.columns)
    if clash:
        raise ValueError(f"input already has column(s) {sorted(clash)}")
    whole = [_named(c) for c in df.columns]
    order = [*order_by, tie1, tie2]
    ranges = num_partitions or -(-df.count() // ROWS_A_RANGE)
    tied = cut_ranges(df.withColumn(tie1, F.xxhash64(*whole)).withColumn(tie2, F.hash(*whole)), order, ranges, at)
    counts = tied.groupBy(at).agg(F.count(F.lit(1)).alias(n))
    before = Window.orderBy(at).rowsBetween(Window.unboundedPreceding, -1)  # one row a range
    offsets = counts.select(F.col(at).alias(key), F.coalesce(F.sum(n).over(before), F.lit(0)).alias(offset))
    inside = Window.partitionBy(at).orderBy(*[_named(c).asc_nulls_first() for c in order])
    placed = tied.withColumn(local, F.row_number().over(inside).cast("bigint") - 1)
    out = placed.join(F.broadcast(offsets), F.col(at) == F.col(key))
    return out.withColumn(index_col, F.col(offset) + F.col(local)).select(*whole, index_col)


def assign_batches(df: DataFrame, order_by: Sequence[str], size: int, batch_col: str = "batch_id",
                   index_col: str = "row_index", num_partitions: int | None = None) -> DataFrame:
    """Cut the rows, in ``order_by`` order, into consecutive batches of ``size``.

    ``num_partitions`` is the number of ranges (default: by the number of rows).
    """
    if size <= 0:
        raise ValueError("size must be positive")
    indexed = global_row_index(df, order_by, index_col, num_partitions=num_partitions)
    return indexed.withColumn(batch_col, F.expr(f"`{index_col}` div {size}"))


def preview(df: DataFrame, n: int, order_by: Sequence[str] | None = None, ascending: bool = True) -> DataFrame:
    """First ``n`` rows in a stated order (a top-k: each task keeps its best
    ``n``, then one small merge)."""
    if order_by:
        keys = [F.col(c).asc() if ascending else F.col(c).desc() for c in order_by]
        df = df.orderBy(*keys)
    return df.limit(n)


def to_pandas_preview(df: DataFrame, n: int, order_by: Sequence[str] | None = None):
    """Bounded collect for interactive use: never more than ``n`` rows."""
    return preview(df, n, order_by).toPandas()
