"""Joins with hot keys: same rows as a plain join, no task with the whole key."""

from __future__ import annotations

import statistics

import pytest
from pyspark.sql import functions as F

from filelens.operators import skew
from filelens.operators.catalogue import join_labels


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows on one key, some without a key."""
    return spark.range(0, 60_000, 1, 12).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 100 = 1 THEN NULL ELSE concat('k', id % 5000) END AS file_id", "id").cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_heavy_keys_are_found(spark, hot):
    (h,) = hot.where("file_id = 'hot'").select(F.xxhash64("file_id")).distinct().first()
    assert h in skew.heavy_hashes(hot, ["file_id"], 0.01)
    assert len(skew.heavy_hashes(hot, ["file_id"], 0.01)) <= 2
    assert skew.heavy_hashes(hot.limit(0), ["file_id"]) == []


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("limit", [10_000, 0])
def test_rows_are_those_of_a_plain_join(spark, hot, how, limit, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", limit)
    facts = spark.range(4000).selectExpr("concat('k', id) AS file_id", "id * 2 AS w").unionByName(
        spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3)], "file_id string, w bigint"))
    got = skew.skew_join(hot, facts, ["file_id"], how, share=0.01)
    assert rows(got) == rows(hot.join(facts, ["file_id"], how).select(got.columns))


def test_no_task_reads_twice_the_median(spark, hot, monkeypatch):
    """The hot rows stay where they are; the others are dealt out evenly."""
    monkeypatch.setattr(skew, "HEAVY_SHARE", 0.01)
    labels = spark.range(5000).selectExpr("concat('k', id) AS file_id", "id AS w").unionByName(spark.createDataFrame([("hot", 1)], "file_id string, w bigint"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def sizes(df):
            parts = df.groupBy(F.spark_partition_id().alias("p"), (F.col("file_id") == "hot").alias("hot")).count().collect()
            return [[r["count"] for r in parts if r.hot == hot_rows] for hot_rows in (True, False)]

        apart, light = sizes(join_labels(hot, labels, drop_key=False, hot_keys=True))
        together = sizes(join_labels(hot, labels, drop_key=False))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert (sum(apart), sum(light)) == tuple(map(sum, together)) and len(together[0]) == 1
    for stage in (apart, light):  # the tasks of the hot rows, and those of the others
        assert len(stage) > 4 and max(stage) <= 2 * statistics.median(stage)
