"""Counts and bytes by file type, table shape - each a single aggregation.

Every report is one ``agg`` of conditional counts: partial aggregation runs
in each scan task and only one small row per task is merged, so a hot
extension or folder never concentrates rows in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from filelens.functions.paths import extension
from filelens.functions.sizes import format_bytes

# The three bucket rules for the type counts.  Extensions not
# listed fall in "etc"; matching is exact and case-sensitive.
BUCKETS_A1 = (("png", ("png",)), ("jpg", ("jpg", "jpeg")), ("csv", ("csv",)), ("json", ("json",)))
BUCKETS_A2 = (("png", ("png",)), ("jpg", ("jpg", "jpeg")), ("csv", ("csv",)))
BUCKETS_A3 = (("png", ("png",)), ("jpg", ("jpg", "jpeg")))

# The substring rule of the long-form report, in its order.
LONG_FORM_TYPES = ("jpg", "jpeg", "png", "csv", "json")


def bucket_column(path: Column | str, buckets: Sequence[tuple[str, Sequence[str]]]) -> Column:
    """The bucket name of each path, ``etc`` when no bucket matches."""
    ext = extension(path)
    expr = None
    for name, exts in buckets:
        cond = ext.isin(*exts)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return F.lit("etc") if expr is None else expr.otherwise(F.lit("etc"))


def type_counts(df: DataFrame, buckets: Sequence[tuple[str, Sequence[str]]] = BUCKETS_A1,
                path: str = "full_path", size: str | None = None,
                by: Sequence[str] = ()) -> DataFrame:
    """Total and per-bucket counts (and bytes when ``size`` is given).

    Output: ``n_files``, ``<bucket>_count`` for each bucket, ``etc_count``;
    with ``size``: ``total_bytes`` (bigint; 0 for no rows, as a Python sum
    gives) and ``total_size`` (formatted).  ``by`` groups the report (e.g.
    per dataset) in the same single pass.
    """
    ext = extension(path)
    aggs: list[Column] = [F.count(F.lit(1)).alias("n_files")]
    if size is not None:
        aggs.append(F.coalesce(F.sum(F.col(size)), F.lit(0)).cast("bigint").alias("total_bytes"))
    known: list[str] = []
    for name, exts in buckets:
        aggs.append(F.count_if(ext.isin(*exts)).alias(f"{name}_count"))
        known.extend(exts)
    aggs.append(F.count_if(~ext.isin(*known)).alias("etc_count"))
    out = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    if size is not None:
        out = out.withColumn("total_size", format_bytes("total_bytes"))
    return out


def type_counts_long(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Long-form (type_name, n) counts by unanchored substring of the name.

    A name like ``a.jpg.png`` counts for both jpg and png; ``etc`` counts
    names that do not *end* in one of the known extensions.  One scan, one
    aggregation, then ``stack`` to long form.
    """
    c = F.col(name)
    aggs = [F.count_if(c.contains("." + t)).alias(f"{t}_counts") for t in LONG_FORM_TYPES]
    pattern = r"\.(" + "|".join(LONG_FORM_TYPES) + r")$"
    aggs.append(F.count_if(~c.rlike(pattern)).alias("etc_counts"))
    wide = df.agg(*aggs)
    names = [f"{t}_counts" for t in LONG_FORM_TYPES] + ["etc_counts"]
    stack = "stack({n}, {pairs}) as (type_name, n)".format(
        n=len(names), pairs=", ".join(f"'{x}', `{x}`" for x in names)
    )
    return wide.selectExpr(stack)


def table_shape(df: DataFrame, by: Sequence[str] = (), size: str | None = None) -> DataFrame:
    """Row count and column count (columns other than ``by``) in one pass.

    With ``by`` (e.g. a dataset tag) every group is reported by the same
    aggregation; ``size`` adds the summed bytes and their formatted text.
    """
    n_cols = len([c for c in df.columns if c not in set(by)])
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if size is not None:
        aggs.append(F.coalesce(F.sum(F.col(size)), F.lit(0)).cast("bigint").alias("total_bytes"))
    counted = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    counted = counted.withColumn("n_cols", F.lit(n_cols).cast("bigint"))
    if size is not None:
        counted = counted.withColumn("total_size", format_bytes("total_bytes"))
    return counted
