"""JSON without a declared schema; tables replaced without a gap; constraints of a growing catalogue."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from filelens.operators import batches, constraints
from filelens.session import scratch_path
from filelens.sinks import tables as sinks
from filelens.sources import tables as srcs
from filelens.sources import variants


def test_union_of_all_shapes_at_any_depth(spark):
    texts = ['{"k": 1}', '{"k": 2, "more": {"a b": "x", "deep": {"v": 1.5, "none": null}}, "l": [1, 2], "e": {}}', None, '{"k": 3, "more": {"deep": {"v": 2}}}']
    df = spark.createDataFrame(list(enumerate(texts)), "id int, p string")
    out = variants.flatten_undeclared(df, "p")
    assert out.columns == ["id", "p.k", "p.l", "p.more.a b", "p.more.deep.none", "p.more.deep.v"]
    assert sorted(tuple(r) for r in out.collect()) == [
        (0, 1, None, None, None, None), (1, 2, [1, 2], "x", None, 1.5), (2, None, None, None, None, None), (3, 3, None, None, None, 2.0)]
    assert dict(out.dtypes)["`p.more.deep.v`".strip("`")] == "double"


def test_a_field_of_several_kinds_is_text_and_bad_text_is_told(spark):
    df = spark.createDataFrame([(1, '{"k": "x"}'), (2, '{"k": 5}'), (3, '{"k": {"a": 1}}')], "id int, p string")
    assert sorted(tuple(r) for r in variants.flatten_undeclared(df, "p").collect()) == [(1, "x"), (2, "5"), (3, '{"a":1}')]
    bad = df.unionByName(spark.createDataFrame([(4, "{not json")], "id int, p string"))
    with pytest.raises(Exception, match="(?i)malformed"):
        variants.parse_undeclared(bad, "p").collect()
    assert sorted(tuple(r) for r in variants.flatten_undeclared(bad, "p", bad="null").collect())[-1] == (4, None)
    assert variants.parse_undeclared(df.limit(0), "p").dtypes == df.dtypes


def test_frames_of_different_shapes_are_stacked(spark):
    a = spark.createDataFrame([(1, '{"x": 1}')], "id int, p string")
    b = spark.createDataFrame([(2, '{"y": {"z": "q"}}', True)], "id int, p string, flag boolean")
    out = variants.union_undeclared([a, b], "p")
    assert out.dtypes == [("id", "int"), ("p", "struct<x:bigint,y:struct<z:string>>"), ("flag", "boolean")]


def test_a_failed_write_leaves_the_old_rows(spark):
    name, root = sinks.unique_table_name("fl_replace"), scratch_path(spark, "versions")
    first = sinks.replace_table(spark.range(10).selectExpr("id", "'ab' AS s"), name, root)
    assert (first.rows, first.value_bytes, first.before) == (10, 100, None)
    bad = spark.range(10, 30).selectExpr("IF(id = 25, raise_error('broken row'), id) AS id", "CAST(NULL AS STRING) AS s")
    with pytest.raises(Exception, match="broken row"):
        sinks.replace_table(bad.select(F.col("id").cast("bigint"), "s"), name, root)
    assert spark.table(name).count() == 10
    done = sinks.replace_table(spark.table(name).where("id > 6"), name, root)  # from itself
    assert (done.rows, done.before.split("/")[-1]) == (3, first.location.split("/")[-1])
    assert sorted(r.id for r in spark.table(name).collect()) == [7, 8, 9]
    assert spark.read.parquet(first.location).count() == 10
    with pytest.raises(ValueError, match="columns"):
        sinks.replace_table(spark.range(3), name, root)
    assert spark.table(name).count() == 3
    spark.sql(f"DROP TABLE {name}")


def _catalogue(spark, n):
    return spark.range(n).selectExpr(
        "concat('/d/', id) AS full_path", "CASE WHEN id % 11 = 0 THEN NULL WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN concat('long_identifier_number_', id) ELSE concat('k', id % 40) END AS file_id",
        "repeat('n', CAST(id % 300 AS INT)) AS file_name", "'f' AS folder_name", "IF(id % 13 = 0, NULL, id) AS file_size")


def test_three_batches_give_the_violations_of_one_run(spark):
    cat = _catalogue(spark, 900)
    state = constraints.ConstraintState(spark, scratch_path(spark, "state"), buckets=4)
    with pytest.raises(ValueError):
        state.violations()
    for k in range(3):
        state.add(cat.where(F.col("file_size").isNull() | (F.col("file_size") % 3 != k)).where(f"pmod(hash(full_path), 3) = {k}"))
    whole = [cat.where(F.col("file_size").isNull() | (F.col("file_size") % 3 != k)).where(f"pmod(hash(full_path), 3) = {k}") for k in range(3)]
    want = constraints.check_constraints(whole[0].unionByName(whole[1]).unionByName(whole[2]))
    assert sorted(map(str, state.violations().collect())) == sorted(map(str, want.collect())) and want.count() > 10
    state.drop()


def test_a_merge_shuffles_the_batch_alone(spark):
    cat = _catalogue(spark, 300)
    state = constraints.ConstraintState(spark, scratch_path(spark, "state"), buckets=4)
    state.add(cat)
    plan = state.merged(cat.limit(50))._jdf.queryExecution().executedPlan().toString()
    join = plan[plan.index("FullOuter") :]
    kept = join[: join.index("Bucketed: true")]  # from the join down its first side to the bucketed scan
    assert "SelectedBucketsCount: 4 out of 4" in join and "Exchange" not in kept
    state.drop()


def test_dataset_names_from_a_table_prune_the_scan(spark, tmp_path):
    path = str(tmp_path / "sets")
    spark.range(40).selectExpr("id", "concat('set', id % 4) AS dataset").write.partitionBy("dataset").parquet(path)
    names = str(tmp_path / "names")
    spark.createDataFrame([("set1", True), ("set3", True), ("set3", True), ("set2", False), ("none", True)], "name string, active boolean").write.parquet(names)
    df = srcs.read_catalogue(spark, path, spark.read.parquet(names).where("active").select("name"))
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString().lower()
    assert sorted({r.dataset for r in df.collect()}) == ["set1", "set3"] and df.count() == 20
    metrics = spark.read.parquet(path).where("dataset IN ('set1', 'set3')")
    assert sorted(r.id for r in df.collect()) == sorted(r.id for r in metrics.collect())


@pytest.mark.parametrize("ranges", [1, 3, 300])
def test_positions_do_not_hang_on_the_ranges(spark, ranges):
    """Ties, nulls and a key of a third of the rows; no checkpoint of the frame."""
    df = spark.range(0, 1500, 1, 7).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 10 = 1 THEN NULL ELSE concat('k', id % 100) END AS k", "id % 4 AS j")
    out = batches.global_row_index(df, ["k", "j"], num_partitions=ranges)
    assert "Scan ExistingRDD" not in out._jdf.queryExecution().executedPlan().toString()
    rows = sorted(out.collect(), key=lambda r: r.row_index)
    assert [r.row_index for r in rows] == list(range(1500)) and sorted(r.id for r in rows) == list(range(1500))
    keys = [((r.k is not None, r.k or ""), r.j) for r in rows]
    assert keys == sorted(keys)
    again = batches.global_row_index(df.repartition(3), ["k", "j"], num_partitions=5)
    assert {r.id: r.row_index for r in again.collect()} == {r.id: r.row_index for r in rows}
