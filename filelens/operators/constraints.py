"""Key and column constraints of the catalogue's target table, as a table of
violations (one aggregation, one shuffle on the key)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelens.sinks.tables import save_table, unique_table_name

# Limits of the target table (key up to 20 characters, names up
# to 255, every column NOT NULL, key unique).
KEY_MAX_LEN = 20
NAME_MAX_LEN = 255
NAME_COLUMNS = ("file_name", "folder_name")
NOT_NULL_COLUMNS = ("full_path", "file_id", "file_name", "folder_name", "file_size")


def constraint_counts(df: DataFrame, key: str = "file_id", key_max_len: int = KEY_MAX_LEN,
                      name_columns: Sequence[str] = NAME_COLUMNS, name_max_len: int = NAME_MAX_LEN,
                      not_null: Sequence[str] = NOT_NULL_COLUMNS) -> DataFrame:
    """What decides the constraints, by key: one column of counts for each.

    The counts of two sets of rows are the sums of theirs, so they can be kept
    and merged (:func:`merge_counts`).  One ``groupBy(key)``; the map-side
    partial aggregation collapses a hot key before the shuffle.
    """
    k = F.col(key)
    aggs = [
        F.count(F.lit(1)).alias("primary_key"),
        F.count_if(F.length(k) > key_max_len).alias("key_length"),
    ]
    for c in name_columns:
        aggs.append(F.count_if(F.length(F.col(c)) > name_max_len).alias(f"{c}_length"))
    any_null = None
    for c in not_null:
        cond = F.col(c).isNull()
        any_null = cond if any_null is None else (any_null | cond)
    aggs.append(F.count_if(any_null if any_null is not None else F.lit(False)).alias("not_null"))
    return df.groupBy(k.alias(key)).agg(*aggs)


def violations(counts: DataFrame) -> DataFrame:
    """``(violation, <key>, n_rows)`` of counts whose first column is the key."""
    key, *names = counts.columns
    stack = "stack({n}, {pairs}) as (violation, n_rows)".format(
        n=len(names), pairs=", ".join(f"'{x}', `{x}`" for x in names))
    long = counts.selectExpr(f"`{key}`", stack)
    violated = (F.col("violation") == "primary_key") & (F.col("n_rows") > 1) | (
        (F.col("violation") != "primary_key") & (F.col("n_rows") > 0))
    return long.filter(violated).select("violation", key, F.col("n_rows").cast("bigint").alias("n_rows"))


def check_constraints(df: DataFrame, key: str = "file_id", key_max_len: int = KEY_MAX_LEN,
                      name_columns: Sequence[str] = NAME_COLUMNS, name_max_len: int = NAME_MAX_LEN,
                      not_null: Sequence[str] = NOT_NULL_COLUMNS) -> DataFrame:
    """Violations as ``(violation, <key>, n_rows)``.

    * ``primary_key``: the key occurs ``n_rows`` > 1 times;
    * ``key_length``: rows whose key is longer than ``key_max_len``;
    * ``<col>_length``: rows whose ``col`` is longer than ``name_max_len``;
    * ``not_null``: rows with a null in any ``not_null`` column.

    All counts come from one aggregation (:func:`constraint_counts`).
    """
    return violations(constraint_counts(df, key, key_max_len, name_columns, name_max_len, not_null))


def merge_counts(kept: DataFrame, arrived: DataFrame, buckets: int) -> DataFrame:
    """The counts of two sets of rows together.  Where ``kept`` is a table of
    ``buckets`` buckets by the key, only ``arrived`` is shuffled."""
    key, *names = kept.columns
    new = arrived.where(F.col(key).isNotNull()).select(F.col(key).alias("__new_key"), *[F.col(n).alias(f"__new_{n}") for n in names])
    both = kept.where(F.col(key).isNotNull()).join(new.repartition(buckets, "__new_key"), F.col(key) == F.col("__new_key"), "full_outer")
    sums = [(F.coalesce(F.col(n), F.lit(0)) + F.coalesce(F.col(f"__new_{n}"), F.lit(0))).alias(n) for n in names]
    both = both.select(F.coalesce(F.col(key), F.col("__new_key")).alias(key), *sums)
    # a null key is a key of its own, of two rows at most
    nulls = kept.where(F.col(key).isNull()).unionByName(arrived.where(F.col(key).isNull()))
    return both.unionByName(nulls.groupBy(key).agg(*[F.sum(n).alias(n) for n in names]))


class ConstraintState:
    """The constraint counts of a catalogue that grows by batches, held as a
    table bucketed by the key.

    :meth:`add` merges a batch into a new version of the table and then makes
    that the current one; a failed merge leaves the current version as it is,
    and the caller adds the batch again.  The join of a merge shuffles the
    batch alone.  Versions lie under ``path`` in the shared folder; the names
    are unique to the state, and :meth:`drop` removes the tables.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, key: str = "file_id"):
        self.spark, self.path, self.buckets, self.key = spark, path, buckets, key
        self.table: str | None = None
        self._versions: list[str] = []

    def merged(self, batch: DataFrame) -> DataFrame:
        """The counts after ``batch``; nothing is written yet."""
        arrived = constraint_counts(batch, self.key)
        return arrived if self.table is None else merge_counts(self.spark.table(self.table), arrived, self.buckets)

    def add(self, batch: DataFrame) -> None:
        name = unique_table_name("filelens_constraint_state")
        save_table(self.merged(batch), name, path=f"{self.path}/{name}", bucket_by=(self.buckets, [self.key]))
        self.table = name
        self._versions.append(name)

    def violations(self) -> DataFrame:
        """As :func:`check_constraints` of all batches so far."""
        if self.table is None:
            raise ValueError("no batch was added")
        return violations(self.spark.table(self.table))

    def drop(self) -> None:
        """Remove the tables from the catalog; frames read before keep their files."""
        for name in self._versions:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        self.table, self._versions = None, []
