from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from filelens.functions.flatten import flatten
from filelens.functions.sizes import format_bytes


# Literal sizes and their texts.
TEXTS = {
    0: "0 B", 1: "1 B", -5: "-5 B", 1023: "1023 B", 1024: "1024 B", 1025: "1.0009765625 KB", 1536: "1.5 KB", 1048576: "1024.0 KB",
    1048577: "1.0000009536743164 MB", 123456789: "117.73756885528564 MB", 10**10: "9.313225746154785 GB",
    1024**3 * 7: "7.0 GB", 1024**4: "1024.0 GB", 1024**4 + 1024**3: "1.0009765625 TB", 1024**5: "1024.0 TB", 1024**5 + 1: None,
}


def test_format_bytes(spark):
    df = spark.createDataFrame([(v,) for v in TEXTS], "n bigint")
    assert dict(df.select("n", format_bytes("n").alias("t")).collect()) == TEXTS


NESTED = "id string, image struct<size:struct<width:bigint,height:bigint>>, tags array<string>, " \
         "dataset struct<quality1:double,result:string>, empty struct<>"


@pytest.fixture(scope="module")
def nested(spark):
    return spark.createDataFrame(
        [("a", ((1, 2),), ["x"], (2.5, "ok"), ()), ("b", None, None, (None, "bad"), ())], NESTED)


def test_flatten_one_level(nested):
    out = flatten(nested, sep="_", depth=1)
    assert out.columns == ["id", "image_size", "tags", "dataset_quality1", "dataset_result"]
    row = out.filter("id = 'a'").first()
    assert row.image_size.width == 1 and row.tags == ["x"]


def test_flatten_all_levels(nested):
    out = flatten(nested, sep=".", depth=None)
    assert out.columns == ["id", "image.size.width", "image.size.height", "tags", "dataset.quality1",
                           "dataset.result"]
    rows = {r["id"]: r for r in out.collect()}
    assert rows["a"]["image.size.height"] == 2
    assert rows["b"]["image.size.width"] is None and rows["b"]["dataset.result"] == "bad"


def test_flatten_name_clash_raises(spark):
    df = spark.createDataFrame([((1,), 2)], "a struct<b:int>, a_b int")
    with pytest.raises(ValueError, match="a_b"):
        flatten(df, sep="_", depth=1)


def test_flatten_case_clash_raises(spark):
    df = spark.createDataFrame([((1,), 2)], "a struct<B:int>, a_b int")
    with pytest.raises(ValueError):
        flatten(df, sep="_", depth=1)


def test_flatten_map(spark):
    from filelens.functions.flatten import flatten_map, map_keys

    df = spark.createDataFrame([(1, {"a": 1, "b": 2}), (2, {"c": 3}), (3, None)], "id int, m map<string,int>")
    assert map_keys(df, "m") == ["a", "b", "c"]
    assert [tuple(r) for r in flatten_map(df, "m", map_keys(df, "m")).orderBy("id").collect()] == [
        (1, 1, 2, None), (2, None, None, 3), (3, None, None, None)]
    assert flatten_map(df, "m", keys=["b"]).columns == ["id", "m_b"]
    with pytest.raises(ValueError, match="more than 2 keys"):
        map_keys(df, "m", most=2)
    with pytest.raises(ValueError):
        flatten_map(df.withColumnRenamed("id", "m_b"), "m", keys=["b"])
