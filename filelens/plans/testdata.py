"""Bindings from the driver's Parquet tables to the engine's inputs.

The test data has no file tree, so listings are derived from table rows:
each binding is a projection over one table (only the columns it needs are
read; ``text`` / ``html`` bodies are read only where their byte length is
the file size).  The same expressions are written in DuckDB SQL in
``filelens.plans.oracle`` so both engines see identical inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Extension assigned to a document by ``doc_id % 6``, so the
# type reports see every bucket (png, jpg, jpeg, csv, json, and tar.gz as etc).
DOC_EXTENSIONS = ("png", "jpg", "jpeg", "csv", "json", "tar.gz")
DOC_ROOT = "/data"
CONV_ROOT = "/conversations"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    return spark.read.parquet(path)


def doc_extension_sql(doc_id: str = "doc_id") -> str:
    """SQL text of the extension rule (one expression, parsed once)."""
    branches = " ".join(f"WHEN {i} THEN '{ext}'" for i, ext in enumerate(DOC_EXTENSIONS))
    return f"CASE pmod({doc_id}, {len(DOC_EXTENSIONS)}) {branches} END"


def doc_path(source: str = "source", lang: str = "lang", doc_id: str = "doc_id", stem: str = "doc_") -> F.Column:
    """``/data/<source>/<lang>/doc_<id>.<ext>``."""
    return F.expr(
        f"concat('{DOC_ROOT}/', {source}, '/', {lang}, '/{stem}', CAST({doc_id} AS STRING), '.', "
        f"{doc_extension_sql(doc_id)})"
    )


def documents_as_files(spark: SparkSession, sf_dir: str, stem: str = "doc_") -> DataFrame:
    """Listing ``(full_path, file_size)`` over ``documents``; n_chars is the size.

    Only ``doc_id, source, lang, n_chars`` are read - the text column is
    pruned at the scan.
    """
    docs = table(spark, sf_dir, "documents")
    return docs.select(doc_path(stem=stem).alias("full_path"), F.col("n_chars").cast("bigint").alias("file_size"))


# Where a document lies in the listing tree, by ``doc_id % 8``:
# an archive at the top, a loose file at the top, an archive two levels down,
# a dot file, a file below an entry named like an archive, a file whose name
# has a line end; the others lie at /data/<source>/<lang>/.
TREE_PLACES = {
    0: "concat('/data/', source, '-', doc_id, '.zip')",
    1: "concat('/data/', source, '-', doc_id, '.png')",
    2: "concat('/data/', source, '/', lang, '/in_', doc_id, '.zip')",
    3: "concat('/data/', source, '/', lang, '/.dot_', doc_id, '.json')",
    4: "concat('/data/', source, '.zip/', lang, '/doc_', doc_id, '.csv')",
    5: "concat('/data/', source, '/', lang, '/two\\nlines_', doc_id, '.csv')",
}


def _tree_place() -> F.Column:
    branches = " ".join(f"WHEN {k} THEN {place}" for k, place in TREE_PLACES.items())
    return F.expr(f"CASE pmod(doc_id, 8) {branches} ELSE concat('/data/', source, '/', lang, '/doc_', doc_id, '.txt') END")


def documents_as_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing over ``documents`` in which every clause of the listing rules
    meets files that it keeps and files that it drops (``TREE_PLACES``)."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(_tree_place().alias("full_path"), F.col("n_chars").cast("bigint").alias("file_size"))


def documents_as_tree_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tree as files to write: ``path`` (relative) and ``content``, the text."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(F.substring(_tree_place(), 2, 1 << 20).alias("path"), F.encode(F.coalesce("text", F.lit("")), "UTF-8").alias("content"))


def documents_as_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` as archive members: ``/archives/<source>.zip`` holds ``<lang>/doc_<id>.txt``."""
    docs = table(spark, sf_dir, "documents")
    member = F.concat_ws("/", F.col("lang"), F.concat(F.lit("doc_"), F.col("doc_id").cast("string"), F.lit(".txt")))
    return docs.select(F.concat(F.lit("/archives/"), F.col("source"), F.lit(".zip")).alias("archive"), member.alias("member"),
                       F.encode("text", "UTF-8").alias("content"))


def events_as_mixed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, props``: every other event's JSON has more fields, nested two deep."""
    events = table(spark, sf_dir, "events")
    more = F.expr("concat(left(props, length(props) - 1), ', \"more\": {\"kind\": \"', event_type, '\", \"deep\": {\"v\": ', CAST(value AS STRING), '}}}')")
    return events.select("event_id", F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(more).alias("props"))


def dataset_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``name, active``: names of datasets, some twice, some inactive, from ``region``."""
    names = F.element_at(F.array(*map(F.lit, ("documents", "pages", "conversations", "documents", "missing"))), F.col("r_regionkey").cast("int") + 1)
    return table(spark, sf_dir, "region").select(names.alias("name"), (F.col("r_regionkey") != 1).alias("active"))


def lineitem_by_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_id, order_key, line``: every third order's lines carry one key."""
    li = table(spark, sf_dir, "lineitem")
    key = F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot")).otherwise(F.col("l_partkey").cast("string"))
    return li.select(key.alias("file_id"), F.col("l_orderkey").alias("order_key"), F.col("l_linenumber").alias("line"))


def part_labels_with_hot_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``file_id, brand`` of every part, and labels of the hot key from the parts of key 1 to 3."""
    part = table(spark, sf_dir, "part")
    hot = part.where("p_partkey <= 3").select(F.lit("hot").alias("file_id"), F.col("p_brand").alias("brand"))
    return part.select(F.col("p_partkey").cast("string").alias("file_id"), F.col("p_brand").alias("brand")).unionByName(hot)


def pages_as_odd_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing over ``pages`` with names that break each rule of the target
    table: by ``page_id % 5`` a repeated id, an id over 20, a name over 255, a
    folder over 255 characters, a missing size."""
    pages = table(spark, sf_dir, "pages")
    path = ("CASE pmod(page_id, 5) WHEN 0 THEN concat('/p/', page_id, '/same.html') "
            "WHEN 1 THEN concat('/p/a_very_long_page_identifier_', page_id, '.html') "
            "WHEN 2 THEN concat('/p/', page_id, repeat('n', 260), '.html') "
            "WHEN 3 THEN concat('/p/', repeat('f', 260), '/', page_id, '.html') ELSE concat('/p/', page_id, '.html') END")
    size = F.when(F.expr("pmod(page_id, 5)") != 4, F.octet_length("html").cast("bigint"))
    return pages.select(F.expr(path).alias("full_path"), size.alias("file_size"))


def lineitem_as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger listing over ``lineitem`` (six times ``orders``):
    ``/lineitem/<returnflag>/<linestatus>/<suppkey>/part_<partkey>_<orderkey>_<line>.<ext>``,
    size ``quantity * 1024``."""
    li = table(spark, sf_dir, "lineitem")
    return li.selectExpr(
        "concat('/lineitem/', l_returnflag, '/', l_linestatus, '/', CAST(l_suppkey AS STRING), '/part_', "
        "CAST(l_partkey AS STRING), '_', CAST(l_orderkey AS STRING), '_', CAST(l_linenumber AS STRING), '.', "
        f"{doc_extension_sql('l_orderkey + l_linenumber')}) AS full_path",
        "CAST(l_quantity AS BIGINT) * 1024 AS file_size",
    )


def pages_as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing over ``pages``: the URL is the path, the HTML byte length the size."""
    pages = table(spark, sf_dir, "pages")
    return pages.select(F.col("url").alias("full_path"), F.octet_length("html").cast("bigint").alias("file_size"))


def conversations_as_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing over ``conversations``: ``/conversations/<conv>/<turn>_<role>.txt``."""
    conv = table(spark, sf_dir, "conversations")
    return conv.selectExpr(
        f"concat('{CONV_ROOT}/', CAST(conv_id AS STRING), '/', CAST(turn AS STRING), '_', role, '.txt') AS full_path",
        "CAST(octet_length(text) AS BIGINT) AS file_size",
    )


def labels_as_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` shaped as flat label records keyed by the document's file id."""
    labels = table(spark, sf_dir, "labels")
    return labels.select(
        F.concat(F.lit("doc_"), F.col("doc_id").cast("string")).alias("file_id"),
        F.col("quality"),
        F.col("toxic"),
    )


def part_as_labels(spark: SparkSession, sf_dir: str, id_prefix: str = "") -> DataFrame:
    """``part`` rows packed into the nested label document shape.

    ``id string, image struct<size struct<width, height>>,
    dataset struct<quality1..quality4 double, result string>``.
    """
    part = table(spark, sf_dir, "part")
    return part.select(
        F.concat(F.lit(id_prefix), F.col("p_partkey").cast("string")).alias("id"),
        F.struct(
            F.struct(
                F.col("p_size").cast("bigint").alias("width"),
                (F.col("p_size") * 2).cast("bigint").alias("height"),
            ).alias("size")
        ).alias("image"),
        F.struct(
            (F.col("p_retailprice") / F.lit(500.0)).alias("quality1"),
            (F.col("p_size") / F.lit(10.0)).alias("quality2"),
            (F.col("p_retailprice") / F.lit(250.0)).alias("quality3"),
            F.col("p_size").cast("double").alias("quality4"),
            F.col("p_brand").alias("result"),
        ).alias("dataset"),
    )


def part_as_label_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The label documents as files to write, several lines each: ``path`` is
    ``set<n>/<id>.json``; every fifth lies where a label scan of ``set*`` has
    not to look (a sub-folder, another extension, a dot file, an archive's name)."""
    labels = part_as_labels(spark, sf_dir)
    body = F.encode(F.to_json(F.struct(*labels.columns), {"pretty": "true"}), "UTF-8")
    place = F.expr("""CASE pmod(CAST(id AS BIGINT), 20) WHEN 5 THEN concat('set1/sub/', id, '.json') WHEN 10 THEN concat('set1/', id, '.jsonl')
                      WHEN 15 THEN concat('set2/.', id, '.json') WHEN 0 THEN concat('set3.zip/', id, '.json')
                      ELSE concat('set', pmod(CAST(id AS BIGINT), 3), '/', id, '.json') END""")
    return labels.select(place.alias("path"), body.alias("content"))
