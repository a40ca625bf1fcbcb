"""JSON label documents read under a declared schema.

Giving the schema up front means only the declared fields are parsed, the
key keeps its declared type (a numeric ``id`` stays a string), and no
inference pass reads every file twice.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filelens.functions import paths as P
from filelens.session import ship_package

# Shape of one label document (fields the label join uses).
LABEL_DDL = (
    "id string, "
    "image struct<size:struct<width:bigint,height:bigint>>, "
    "dataset struct<quality1:double,quality2:double,quality3:double,quality4:double,result:string>"
)

MODES = ("PERMISSIVE", "FAILFAST", "DROPMALFORMED")

# Charsets Spark's JSON reader accepts without legacy settings.
SPARK_JSON_CHARSETS = ("iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32", "utf-8")


def read_labels(spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType = LABEL_DDL,
                multi_line: bool = True, mode: str | None = None, corrupt_column: str | None = None,
                with_path: bool = False, pattern: str | None = None, recursive: bool = False,
                encoding: str | None = None) -> DataFrame:
    """Read many JSON files in one job (one document per file by default).

    The default stops at the first malformed file.  ``corrupt_column`` keeps
    going instead (``mode="PERMISSIVE"``, which needs it) and holds the raw
    text of bad records, so none of them turns into a row of nulls unseen.  ``with_path`` adds ``label_path`` (the file read).
    ``pattern`` (e.g. ``"*.json"``) and ``recursive`` select label files in
    nested folders mixed with other files; both act in the listing.
    ``encoding`` reads files that are not UTF-8.  The charsets Spark's JSON
    reader knows are passed to it; any other (e.g. ``"EUC-KR"``, common for
    Korean label files) is decoded from the raw bytes by a vectorized UDF,
    one document per file, then parsed with the same schema.
    """
    mode = mode or ("PERMISSIVE" if corrupt_column else "FAILFAST")
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "PERMISSIVE" and not corrupt_column:
        raise ValueError("PERMISSIVE needs corrupt_column, to keep what could not be read")
    if encoding and encoding.lower().replace("_", "-") not in SPARK_JSON_CHARSETS:
        return _read_labels_decoded(spark, paths, schema, encoding, mode, pattern, recursive, with_path,
                                    corrupt_column)
    if corrupt_column:
        if isinstance(schema, T.StructType):
            schema = T.StructType(schema.fields + [T.StructField(corrupt_column, T.StringType())])
        else:
            schema = f"{schema}, {corrupt_column} string"
    reader = spark.read.schema(schema).option("multiLine", str(multi_line).lower()).option("mode", mode)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if encoding:
        reader = reader.option("encoding", encoding)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    paths_list = [paths] if isinstance(paths, str) else list(paths)
    df = reader.json(paths_list)
    if with_path:
        df = df.withColumn("label_path", P.uri_to_path(F.col("_metadata.file_path")))
    return df


#: Bytes of label files that a task holds at once (one file may be larger), and what a file costs besides its bytes.
LABEL_BYTES, FILE_BYTES = 8 << 20, 1 << 10


def _texts(names: Iterator[str], encoding: str) -> Iterator[pd.DataFrame]:
    """``label_path, text`` of files, in frames of about ``LABEL_BYTES``; empty files count as well."""
    rows: list[tuple[str, str]] = []
    held = 0
    for name in names:
        with open(name, "rb") as f:
            data = f.read()
        rows.append((name, data.decode(encoding)))
        held += len(data) + FILE_BYTES
        del data
        if held >= LABEL_BYTES:
            out, rows, held = pd.DataFrame(rows, columns=["label_path", "text"]), [], 0
            yield out
            del out  # not held while the next one is filled
    if rows:
        yield pd.DataFrame(rows, columns=["label_path", "text"])


def read_label_files(paths: DataFrame, path: str = "label_paths", schema: str | T.StructType = LABEL_DDL, encoding: str = "utf-8",
                     corrupt_column: str | None = None) -> DataFrame:
    """Label documents, one a file, whose paths are a table (as
    :func:`~filelens.sources.files.label_paths` gives it): the fields of
    ``schema`` and ``label_path``.

    The paths stay in Spark, dealt out by hash; each task opens its own, on a
    mount that every executor sees, and holds ``LABEL_BYTES`` of them at a
    time.  What lists the paths in Python thus runs in a stage before, not
    beside the reading, and its slices need not be even.  The first malformed document raises, or with
    ``corrupt_column`` its text is kept in that column and its fields are null.
    A path that cannot be read raises.
    """
    ship_package(paths.sparkSession)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        yield from _texts((name for pdf in batches for name in pdf["p"]), encoding)

    ddl = schema if isinstance(schema, str) else ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = {"mode": "FAILFAST"}
    if corrupt_column:
        ddl, options = f"{ddl}, `{corrupt_column}` string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_column}
    texts = paths.select(F.col(f"`{path}`").alias("p")).repartition("p").mapInPandas(read, "label_path string, text string")
    return texts.select("label_path", F.from_json("text", ddl, options).alias("doc")).select("doc.*", "label_path")


def parse_labels(df: DataFrame, column: str, schema: str | T.DataType, mode: str = "PERMISSIVE") -> DataFrame:
    """Parse a JSON text column in place with ``from_json`` (JVM-side)."""
    return df.withColumn(column, F.from_json(F.col(column), schema, {"mode": mode}))


def infer_schema(spark: SparkSession, paths: str | Sequence[str], multi_line: bool = True,
                 sampling_ratio: float = 1.0) -> T.StructType:
    """Union schema Spark infers over the files (for comparison with a DDL)."""
    paths_list = [paths] if isinstance(paths, str) else list(paths)
    return (spark.read.option("multiLine", str(multi_line).lower())
            .option("samplingRatio", sampling_ratio).json(paths_list).schema)


def _read_labels_decoded(spark: SparkSession, paths: str | Sequence[str], schema: str | T.StructType,
                         encoding: str, mode: str, pattern: str | None, recursive: bool,
                         with_path: bool, corrupt_column: str | None = None) -> DataFrame:
    """One label document per file in a charset Spark's JSON reader lacks."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    raw = reader.load([paths] if isinstance(paths, str) else list(paths))
    ship_package(spark)

    @F.pandas_udf("string")
    def decode(blobs: pd.Series) -> pd.Series:
        return blobs.map(lambda b: None if b is None else bytes(b).decode(encoding))

    ddl = schema if isinstance(schema, str) else schema.simpleString()
    bad = corrupt_column or "_filelens_bad_record"
    opts = {"mode": "FAILFAST" if mode == "FAILFAST" else "PERMISSIVE", "columnNameOfCorruptRecord": bad}
    parsed = raw.select(P.strip_uri("path").alias("label_path"),
                        F.from_json(decode("content"), f"{ddl}, `{bad}` string", opts).alias("doc"))
    out = parsed.select("doc.*", "label_path")
    if mode == "DROPMALFORMED":  # the caller asked to drop unparsable documents
        out = out.filter(F.col(f"`{bad}`").isNull())
    if not corrupt_column:
        out = out.drop(bad)
    return out if with_path else out.drop("label_path")
