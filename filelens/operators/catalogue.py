"""File catalogue, label selection and the label join.

All operators take and return DataFrames and stay lazy; Catalyst sees one
plan from the scan to the sink.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filelens.functions import paths as P
from filelens.functions.flatten import nested_field
from filelens.operators.skew import skew_join

CATALOGUE_COLUMNS = ("full_path", "file_id", "file_name", "folder_name", "file_size")
CATALOGUE_SCHEMA = T.StructType(
    [
        T.StructField("full_path", T.StringType(), False),
        T.StructField("file_id", T.StringType(), True),
        T.StructField("file_name", T.StringType(), True),
        T.StructField("folder_name", T.StringType(), True),
        T.StructField("file_size", T.LongType(), True),
    ]
)

# Nested label fields kept from each label document and the
# names they get in the joined table (density, absorption, soundness, fines
# passing), in the order of the output table.
LABEL_FIELDS = (
    ("id", "file_id"),
    ("image.size.width", "width"),
    ("image.size.height", "height"),
    ("dataset.quality1", "밀도"),
    ("dataset.quality2", "흡수율"),
    ("dataset.quality3", "안전성"),
    ("dataset.quality4", "잔입자_통과량"),
    ("dataset.result", "target_data"),
)

# Quality rules stated for the label fields.  They are opt-in
# flags; nothing is filtered by default.
QUALITY_RULES = (
    ("q1_ok", "dataset.quality1", ">=", 2.5),
    ("q2_ok", "dataset.quality2", "<=", 3.0),
    ("q3_ok", "dataset.quality3", "<=", 5.0),
)


def with_file_columns(df: DataFrame, path: str = "full_path", size: str | None = "file_size") -> DataFrame:
    """Add file id, name and folder to a path table (catalogue column order).

    ``size`` names an existing byte-count column (cast to bigint); pass None
    when the input has none and the column is left out.
    """
    p = F.col(path)
    cols: list[Column] = [
        p.alias("full_path"),
        P.file_id(p).alias("file_id"),
        P.file_name(p).alias("file_name"),
        P.folder_name(p).alias("folder_name"),
    ]
    if size is not None:
        cols.append(F.col(size).cast("bigint").alias("file_size"))
    extra = [c for c in df.columns if c not in {path, size}]
    clash = set(extra) & set(CATALOGUE_COLUMNS)
    if clash:
        raise ValueError(f"input already has catalogue column(s) {sorted(clash)}; drop or rename them first")
    return df.select(*cols, *[F.col(f"`{c}`") for c in extra])


def file_catalogue(paths: DataFrame, path: str = "full_path", size: str = "file_size") -> DataFrame:
    """The five-column catalogue (path, id, name, folder, size) of a listing."""
    return with_file_columns(paths.select(path, size), path, size)


def catalogue_files(spark: SparkSession, root: str, rule: str = "subdirs", pattern: str | None = None,
                    complete: bool | None = None) -> DataFrame:
    """List a tree and build its catalogue; plain paths are walked, hidden and
    empty files included (see :func:`~filelens.sources.files.scan_files`)."""
    from filelens.sources.files import scan_files

    return file_catalogue(scan_files(spark, root, rule=rule, pattern=pattern, complete=complete))


def catalogue_roots(spark: SparkSession, roots: Mapping[str, str], rule: str = "subdirs", complete: bool | None = None,
                    name: str = "dataset") -> DataFrame:
    """Catalogue several dataset roots into one table tagged by dataset name
    (``{"cctv": "/mnt/cctv/*", "sand": "/mnt/sand/*"}``); report it with
    ``table_shape(df, by=["dataset"], size="file_size")``."""
    return catalogue_datasets(
        {key: catalogue_files(spark, root, rule=rule, complete=complete) for key, root in roots.items()}, name)


def _check_key_types(left: DataFrame, right: DataFrame, key: str) -> None:
    lt = left.schema[key].dataType
    rt = right.schema[key].dataType
    if lt != rt:
        raise TypeError(
            f"join key {key!r} has type {lt.simpleString()} on the files side and "
            f"{rt.simpleString()} on the labels side; read labels with an explicit schema"
        )


def join_labels(files: DataFrame, labels: DataFrame, key: str = "file_id", drop_key: bool = True,
                hot_keys: bool = False) -> DataFrame:
    """Inner equi-join of files and labels; many-to-many multiplicity kept.

    The planner chooses: a side is broadcast only below
    ``spark.sql.autoBroadcastJoinThreshold``, by the sizes that the scans, or
    with adaptive execution the shuffles, report; otherwise it is a sort-merge
    join whose skewed partitions are split.  Key types must agree up front, so
    a numeric JSON id never turns into an implicit cast of the path-derived
    side.  ``hot_keys=True`` looks for keys that hold a large share of the files
    first and joins their rows apart (:func:`~filelens.operators.skew.skew_join`);
    ``files`` is then read more than once.
    """
    _check_key_types(files, labels, key)
    joined = skew_join(files, labels, [key]) if hot_keys else files.join(labels, on=key, how="inner")
    return joined.drop(key) if drop_key else joined


def select_label_fields(labels: DataFrame, fields: Sequence[tuple[str, str]] = LABEL_FIELDS) -> DataFrame:
    """Pick nested fields and give them flat names (positional rename).

    Selecting ``a.b.c`` from a nested struct lets Parquet / JSON readers
    prune every other field.
    """
    return labels.select(*[nested_field(src).alias(dst) for src, dst in fields])


def flag_quality(labels: DataFrame, rules: Sequence[tuple[str, str, str, float]] = QUALITY_RULES,
                 fields: Mapping[str, str] | None = None) -> DataFrame:
    """Add boolean quality flags; never filters.

    ``fields`` maps a rule's source field to a column of ``labels`` when the
    labels were already renamed (e.g. ``{"dataset.quality1": "밀도"}``).
    """
    ops = {">=": Column.__ge__, "<=": Column.__le__, ">": Column.__gt__, "<": Column.__lt__}
    out = labels
    for name, src, op, bound in rules:
        c = F.col(f"`{fields[src]}`") if fields and src in fields else nested_field(src)
        out = out.withColumn(name, ops[op](c, F.lit(bound)))
    return out


def legacy_columns(paths: DataFrame, path: str = "full_path", size: str = "file_size") -> DataFrame:
    """Catalogue with the older keys: ``full_path, file_id, folder, file_name,
    file_size`` by :func:`~filelens.functions.paths.file_id_legacy` and
    :func:`~filelens.functions.paths.folder_legacy`."""
    p = F.col(path)
    return paths.select(p.alias("full_path"), P.file_id_legacy(p).alias("file_id"), P.folder_legacy(p).alias("folder"),
                        P.file_name(p).alias("file_name"), F.col(size).cast("bigint").alias("file_size"))


def label_catalogue(files: DataFrame, labels: DataFrame,
                    fields: Sequence[tuple[str, str]] = LABEL_FIELDS) -> DataFrame:
    """Files joined to selected label fields, join key dropped.  ``files`` is a
    catalogue with the current keys (:func:`file_catalogue`) or the older ones
    (:func:`legacy_columns`); its columns come first."""
    return join_labels(files, select_label_fields(labels, fields), key=fields[0][1], drop_key=True)


def union_labels(frames: Sequence[DataFrame]) -> DataFrame:
    """Stack label frames by column name; missing columns become null."""
    if not frames:
        raise ValueError("union_labels needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def catalogue_datasets(datasets: Mapping[str, DataFrame], name: str = "dataset") -> DataFrame:
    """Several catalogues side by side in one table, tagged by dataset name.

    Written partitioned by ``dataset``, later reads of one dataset prune the
    others.
    """
    frames = [df.withColumn(name, F.lit(key)) for key, df in datasets.items()]
    return union_labels(frames)
