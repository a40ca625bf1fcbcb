"""The reference's everyday workflows, written with filelens.

Each function takes the roots a user would pass and returns DataFrames; run
this file to try them on a small demo tree built in a temporary folder
(local mode only):

    python examples/workflows.py
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import zipfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from filelens.operators.batches import assign_batches  # noqa: E402
from filelens.operators.catalogue import catalogue_files, catalogue_roots, label_catalogue  # noqa: E402
from filelens.operators.stats import BUCKETS_A3, table_shape, type_counts  # noqa: E402
from filelens.session import local_session  # noqa: E402
from filelens.sinks.tables import save_table  # noqa: E402
from filelens.sources.archives import expand_archives, scan_archives  # noqa: E402
from filelens.sources.labels import read_labels  # noqa: E402


def image_label_table(spark: SparkSession, image_glob: str, label_glob: str,
                      table: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Image folders one level deep + one JSON label per image -> the joined
    table (file_id dropped) and its count/bytes report; saved if ``table``."""
    files = catalogue_files(spark, image_glob, rule="one_level")
    joined = label_catalogue(files, read_labels(spark, label_glob))
    if table:
        save_table(joined, table)
    return joined, type_counts(joined, BUCKETS_A3, size="file_size")


def dataset_report(spark: SparkSession, roots: dict[str, str]) -> DataFrame:
    """Several dataset roots catalogued side by side: rows, columns, bytes."""
    return table_shape(catalogue_roots(spark, roots, rule="subdirs"), by=["dataset"], size="file_size")


def archives_in_batches(spark: SparkSession, folder: str, batch: int = 3) -> tuple[DataFrame, DataFrame]:
    """Zip archives of one folder, sorted and cut into batches, and their
    members as a table."""
    zips = scan_archives(spark, folder)
    batches = assign_batches(zips.select("path", "length"), ["path"], batch)
    return batches, expand_archives(zips).select("archive", "dest", "member", "length")


def _demo_tree(root: str) -> None:
    for folder, names in {"TS_01": ["A1.png", "A2.jpg"], "TS_02": ["B1.jpeg", "B2.png"]}.items():
        os.makedirs(f"{root}/image/{folder}", exist_ok=True)
        for i, name in enumerate(names):
            with open(f"{root}/image/{folder}/{name}", "wb") as f:
                f.write(b"x" * (100 * (i + 1)))
    os.makedirs(f"{root}/labels", exist_ok=True)
    for stem, q1 in [("A1", 2.7), ("A2", 2.1), ("B1", 3.0), ("B2", 2.4)]:
        doc = {"id": stem, "image": {"size": {"width": 64, "height": 48}},
               "dataset": {"quality1": q1, "quality2": 1.5, "quality3": 2.0, "quality4": 9.0, "result": "pass"}}
        with open(f"{root}/labels/{stem}.json", "w", encoding="utf-8") as f:
            json.dump(doc, f, indent=2)
    os.makedirs(f"{root}/zips", exist_ok=True)
    for i in range(4):
        with zipfile.ZipFile(f"{root}/zips/part{i}.zip", "w") as zf:
            zf.writestr(f"labels/L{i}.json", json.dumps({"id": f"L{i}"}))


if __name__ == "__main__":
    spark = local_session()
    root = tempfile.mkdtemp(prefix="filelens-demo-")
    _demo_tree(root)
    table, report = image_label_table(spark, f"{root}/image/TS*", f"{root}/labels/*.json")
    table.show(truncate=False)
    report.show(truncate=False)
    dataset_report(spark, {"images": f"{root}/image/*", "labels": f"{root}/labels*"}).show()
    batches, members = archives_in_batches(spark, f"{root}/zips")
    batches.orderBy("row_index").show(truncate=False)
    members.show(truncate=False)
    spark.stop()
