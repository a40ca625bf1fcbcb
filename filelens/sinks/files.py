"""Rows as files: one file a row, written by the executors to a shared mount."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from filelens.session import local_dir, ship_package


def write_files(df: DataFrame, root: str, path: str = "path", content: str = "content") -> str:
    """Write each row's ``content`` (binary) to the relative ``path`` under ``root``.

    ``root`` lies on a mount that every executor sees (a plain path or
    ``file:``).  A file appears under its name only when it is whole, and
    writing it again gives the same file, so a lost task is simply run again.
    Paths that are absolute or climb out of ``root`` raise, null contents too.
    """
    if "://" in root and not root.startswith("file:"):
        raise ValueError(f"{root!r} is not on a mount; files are written by path")
    base = local_dir(root)
    ship_package(df.sparkSession)

    def put(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, data in zip(pdf["p"], pdf["c"], strict=True):
                if name.startswith("/") or ".." in name.split("/"):
                    raise ValueError(f"unsafe path {name!r}")
                full = os.path.join(base, name)
                os.makedirs(os.path.dirname(full), exist_ok=True)
                part = os.path.join(os.path.dirname(full), f".{uuid.uuid4().hex}.part")
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, full)
            yield pd.DataFrame({"n": [len(pdf)]})

    rows = df.select(F.col(path).alias("p"), F.col(content).cast("binary").alias("c"))
    rows.mapInPandas(put, "n bigint").agg(F.sum("n")).collect()  # one number
    return base
