from __future__ import annotations

import os

from filelens.session import scratch_path
from filelens.streaming.arrivals import append_catalogue, catalogue_stream


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_incremental_catalogue(spark, tmp_path):
    root = str(tmp_path / "incoming")
    _write(f"{root}/TS1/a.png", b"a" * 3)
    _write(f"{root}/TS1/b.json", b"{}")
    out, ckpt = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    q = append_catalogue(catalogue_stream(spark, root), out, ckpt)
    q.awaitTermination(120)
    first = spark.read.parquet(out)
    assert sorted((r.file_id, r.folder_name, r.file_size) for r in first.collect()) == [("a", "TS1", 3), ("b", "TS1", 2)]
    _write(f"{root}/TS2/c.png", b"c" * 5)
    q = append_catalogue(catalogue_stream(spark, root), out, ckpt)
    q.awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert sorted(r.file_id for r in rows) == ["a", "b", "c"]  # nothing catalogued twice


def test_type_counts_on_a_stream(spark, tmp_path):
    """The batch report applies unchanged to the streaming catalogue."""
    from filelens.operators.stats import BUCKETS_A2, type_counts

    root = str(tmp_path / "arrivals")
    for name, size in [("a.png", 1), ("b.jpg", 2), ("c.jpeg", 3), ("d.json", 4)]:
        _write(f"{root}/TS1/{name}", b"x" * size)
    counts = type_counts(catalogue_stream(spark, root), BUCKETS_A2, size="file_size")
    out = scratch_path(spark, "counts-ckpt")
    q = (counts.writeStream.outputMode("complete").format("memory").queryName("fl_type_counts")
         .option("checkpointLocation", out).trigger(availableNow=True).start())
    q.awaitTermination(120)
    row = spark.table("fl_type_counts").first()
    assert (row.n_files, row.total_bytes, row.png_count, row.jpg_count, row.etc_count) == (4, 10, 1, 2, 1)


def test_arriving_labels_join_static_catalogue(spark, tmp_path):
    import json

    from filelens.operators.catalogue import file_catalogue, label_catalogue
    from filelens.streaming.arrivals import label_stream

    files = file_catalogue(spark.createDataFrame(
        [("/d/TS/img_1.png", 10), ("/d/TS/img_2.png", 20), ("/d/TS/img_3.png", 30)],
        "full_path string, file_size bigint"))
    root = tmp_path / "labels"

    def label(i):
        return {"id": f"img_{i}", "image": {"size": {"width": i, "height": 2 * i}},
                "dataset": {"quality1": 2.5, "quality2": 1.0, "quality3": 1.0, "quality4": 1.0, "result": "ok"}}

    _write(str(root / "b1" / "img_1.json"), json.dumps(label(1)).encode())
    out, ckpt = scratch_path(spark, "lab-out"), scratch_path(spark, "lab-ckpt")

    def run():
        joined = label_catalogue(files, label_stream(spark, str(root)))
        q = (joined.writeStream.format("parquet").option("checkpointLocation", ckpt)
             .trigger(availableNow=True).start(out))
        q.awaitTermination(120)

    run()
    _write(str(root / "b2" / "img_3.json"), json.dumps(label(3)).encode())
    run()
    rows = sorted((r.full_path, r.width) for r in spark.read.parquet(out).collect())
    assert rows == [("/d/TS/img_1.png", 1), ("/d/TS/img_3.png", 3)]
