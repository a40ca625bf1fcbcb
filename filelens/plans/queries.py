"""Registered queries: each is ``(spark, sf_dir) -> DataFrame`` over whole tables.

Each query composes library operators on a binding from
:mod:`filelens.plans.testdata`; the DuckDB text of the same query is in
:mod:`filelens.plans.oracle`.  Computed columns carry the same aliases in
both.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelens.functions import paths as P
from filelens.functions.flatten import flatten, flatten_map
from filelens.functions.sizes import format_bytes
from filelens.operators import batches, catalogue, constraints, stats
from filelens.plans import testdata as td
from filelens.session import default_parallelism, scratch_path
from filelens.sinks import tables as sinks
from filelens.sinks.files import write_files
from filelens.sources import archives, members, variants
from filelens.sources import files as scan
from filelens.sources import labels as lbl
from filelens.sources import tables as srcs


#: Label documents of one multi-line JSON file.
LABELS_A_FILE = 10_000


def _three_catalogues(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The three datasets of the multi-dataset report, each as a catalogue."""
    return {
        "documents": catalogue.file_catalogue(td.documents_as_files(spark, sf_dir)),
        "pages": catalogue.file_catalogue(td.pages_as_files(spark, sf_dir)),
        "conversations": catalogue.file_catalogue(td.conversations_as_files(spark, sf_dir)),
    }


def q_file_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.file_catalogue(td.documents_as_files(spark, sf_dir))


def q_url_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.file_catalogue(td.pages_as_files(spark, sf_dir))


def q_legacy_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = td.documents_as_files(spark, sf_dir)
    return files.select(
        "full_path",
        P.file_id_legacy("full_path").alias("file_id_legacy"),
        P.folder_legacy("full_path").alias("folder_legacy"),
        P.file_id("full_path").alias("file_id"),
    )


def q_extension_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = td.documents_as_files(spark, sf_dir)
    kept = scan.exclude_suffix(files, ".gz")
    return kept.select("full_path", P.extension("full_path").alias("extension"), "file_size")


def q_subdir_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = scan.apply_rule(td.documents_as_tree(spark, sf_dir), "/data/src1*", rule="subdirs")
    return picked.select("full_path", "file_size", P.path_depth("full_path").alias("depth"))


def q_one_level_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = scan.apply_rule(td.documents_as_tree(spark, sf_dir), "/data/src1*/e*", rule="one_level")
    return picked.select("full_path", "file_size", P.path_depth("full_path").alias("depth"))


def q_no_zip_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    picked = scan.apply_rule(td.documents_as_tree(spark, sf_dir), "/data", rule="no_zip")
    return picked.select("full_path", "file_size")


def q_type_counts_a1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.type_counts(td.documents_as_files(spark, sf_dir), stats.BUCKETS_A1)


def q_type_counts_a2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.type_counts(td.documents_as_files(spark, sf_dir), stats.BUCKETS_A2, size="file_size")


def q_type_counts_a3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.type_counts(td.documents_as_files(spark, sf_dir), stats.BUCKETS_A3, size="file_size")


def q_type_counts_by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = td.documents_as_files(spark, sf_dir)
    files = files.withColumn("source", P.top_folder("full_path", 2))
    return stats.type_counts(files, stats.BUCKETS_A2, size="file_size", by=["source"])


def q_type_counts_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.type_counts_long(catalogue.file_catalogue(td.documents_as_files(spark, sf_dir)))


def q_format_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = td.table(spark, sf_dir, "orders")
    sized = orders.select("o_orderkey", (F.col("o_orderkey") * F.lit(1000003)).alias("n_bytes"))
    return sized.select("o_orderkey", "n_bytes", format_bytes("n_bytes").alias("size_text"))


def q_archive_dest(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = td.documents_as_files(spark, sf_dir)
    return files.select("full_path", P.archive_dest("full_path").alias("dest"))


def q_flatten_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = td.table(spark, sf_dir, "part")
    nested = part.select(
        F.col("p_partkey").alias("id"),
        F.struct(F.col("p_name").alias("name"), F.col("p_brand").alias("brand")).alias("info"),
        F.struct(F.col("p_size").alias("size"), F.col("p_retailprice").alias("price")).alias("spec"),
        F.col("p_type").alias("info_kind"),
    )
    return flatten(nested, sep="_", depth=1)


def q_flatten_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flatten(td.part_as_labels(spark, sf_dir), sep=".", depth=None)


def q_flatten_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A map-typed label column flattened into one column per key."""
    events = td.table(spark, sf_dir, "events").select("event_id", "props")
    parsed = lbl.parse_labels(events, "props", "map<string,bigint>")
    return flatten_map(parsed, "props", keys=["k"])


def q_json_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = td.table(spark, sf_dir, "events")
    parsed = lbl.parse_labels(events, "props", "k bigint")
    return parsed.select("event_id", "event_type", F.col("props.k").alias("k"))


def q_select_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = td.part_as_labels(spark, sf_dir)
    picked = catalogue.select_label_fields(labels)
    return catalogue.flag_quality(picked, fields=dict(
        (src, dst) for src, dst in catalogue.LABEL_FIELDS))


def q_label_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = catalogue.file_catalogue(td.documents_as_files(spark, sf_dir))
    labels = td.labels_as_documents(spark, sf_dir)
    return catalogue.join_labels(files, labels, key="file_id", drop_key=True)


def q_meta_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image-label table: file catalogue joined to selected, renamed label
    fields, join key dropped."""
    files = catalogue.file_catalogue(td.documents_as_files(spark, sf_dir))
    labels = td.part_as_labels(spark, sf_dir, id_prefix="doc_")
    return catalogue.label_catalogue(files, labels)


def q_legacy_label_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The everyday label table: files by their older keys, joined to label fields."""
    files = catalogue.legacy_columns(td.documents_as_files(spark, sf_dir, stem="scan.doc_"))
    return catalogue.label_catalogue(files, td.part_as_labels(spark, sf_dir, id_prefix="doc_"))


def q_union_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three tables with different columns stacked by name."""
    labels = td.table(spark, sf_dir, "labels")
    parts = td.table(spark, sf_dir, "part").select(F.col("p_partkey").alias("doc_id"), F.col("p_brand").alias("result"))
    turns = td.table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("doc_id"), "turn", F.col("role").alias("result"))
    return catalogue.union_labels([labels, parts, turns])


def q_catalogue_datasets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = _three_catalogues(spark, sf_dir)
    return stats.table_shape(catalogue.catalogue_datasets(sets), by=["dataset"], size="file_size")


def q_assign_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = td.documents_as_files(spark, sf_dir)
    return batches.assign_batches(files, order_by=["full_path"], size=3)


def q_preview_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batches.preview(catalogue.file_catalogue(td.documents_as_files(spark, sf_dir)), 10,
                           order_by=["file_size", "full_path"], ascending=False)


def q_check_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return constraints.check_constraints(catalogue.file_catalogue(td.pages_as_odd_files(spark, sf_dir)))


def q_expand_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = archives.pack_archives(td.documents_as_members(spark, sf_dir))
    n = 4 * default_parallelism(spark)  # tasks that take less at a time, and even out the parts' sizes
    out = archives.expand_archives(packed, num_partitions=n)
    return out.select(P.folder_name("archive").alias("source"), "member", "length",
                      F.md5("content").alias("content_md5"))


def _resolved(spark: SparkSession, name: str) -> DataFrame:
    """The rows of an external table of this run, whose name goes again; its files stay."""
    df = srcs.read_table(spark, name)
    df.schema  # noqa: B018 - resolved while the table is known
    spark.sql(f"DROP TABLE {name}")
    return df


def q_table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = td.table(spark, sf_dir, "orders")
    name = sinks.save_table(orders, sinks.unique_table_name("filelens_orders_copy"), path=scratch_path(spark, "orders-table"))
    return _resolved(spark, name)


def q_parquet_to_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A Parquet folder loaded into a catalog table."""
    path = sinks.write_parquet(td.table(spark, sf_dir, "orders"), scratch_path(spark, "orders-parquet"))
    name = sinks.parquet_to_table(spark, path, sinks.unique_table_name("filelens_orders_loaded"), location=scratch_path(spark, "orders-loaded"))
    return _resolved(spark, name)


def q_replaced_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of orders replaced, from itself, by those that are not open,
    and the rows that the write counted."""
    name, root = sinks.unique_table_name("filelens_orders"), scratch_path(spark, "orders-versions")
    sinks.replace_table(td.table(spark, sf_dir, "orders"), name, root)
    closed = srcs.read_table(spark, name).where("o_orderstatus <> 'O'")
    done = sinks.replace_table(closed, name, root)
    return _resolved(spark, name).withColumn("n_written", F.lit(done.rows).cast("bigint"))


def q_create_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogue's target table by its declared types, filled and read back."""
    name = sinks.create_table(spark, sinks.unique_table_name("filelens_file_data"), sinks.CATALOGUE_SPARK_DDL, location=scratch_path(spark, "file-data"))
    cat = catalogue.file_catalogue(td.documents_as_files(spark, sf_dir))
    cat.write.insertInto(name)
    return _resolved(spark, name)


def q_json_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label documents, several lines each, written and read back strictly
    from a list of paths under the declared schema."""
    nested = td.part_as_labels(spark, sf_dir)
    body = F.to_json(F.struct(*nested.columns), {"pretty": "true"})
    path = scratch_path(spark, "label-json")
    # one array a file, as the multi-line reader takes whole files; the files follow from the rows
    n_files = -(-nested.count() // LABELS_A_FILE)
    files = nested.select(body.alias("value"), F.pmod(F.xxhash64("id"), F.lit(max(1, n_files))).alias("file"))
    grouped = files.groupBy("file").agg(F.concat_ws(",\n", F.collect_list("value")).alias("value"))
    grouped.select(F.concat(F.lit("["), "value", F.lit("]")).alias("value"), "file").write.partitionBy("file").text(path)
    folders = scan.paths_to_df(spark, [path])
    read = lbl.read_labels(spark, [r.full_path for r in folders.collect()], multi_line=True)
    return catalogue.select_label_fields(read)


def q_label_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Label documents written as files among others, found by their names,
    and read from the table of their paths."""
    root = write_files(td.part_as_label_files(spark, sf_dir), scratch_path(spark, "label-files"))
    found = scan.label_paths(spark, f"{root}/set*")
    return catalogue.select_label_fields(lbl.read_label_files(found))


def q_undeclared_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON of two shapes under no declared schema, one column a field."""
    return variants.flatten_undeclared(td.events_as_mixed_json(spark, sf_dir), "props")


def q_listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as files, listed and sized by each rule."""
    root = write_files(td.documents_as_tree_files(spark, sf_dir), scratch_path(spark, "tree"))
    found = [scan.scan_files(spark, f"{root}/data{glob}", rule=rule).select(F.lit(rule).alias("rule"), "full_path", "file_size")
             for rule, glob in (("subdirs", "/src1*"), ("one_level", "/src1*/e*"), ("no_zip", ""))]
    paths = catalogue.union_labels(found)
    return paths.select("rule", F.expr(f"substring(full_path, {len(root) + 1})").alias("full_path"), "file_size")


def q_archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed to archives on disk, which are found, read in
    chunks and checked: size and checksum of each member."""
    packed = archives.pack_archives(td.documents_as_members(spark, sf_dir))
    flat = packed.select(F.regexp_replace(F.substring("path", 2, 1 << 20), "/", "=").alias("path"), "content")
    root = write_files(flat, scratch_path(spark, "archives"))
    totals = members.member_totals(members.member_chunks(spark, root, chunk_bytes=4096))
    source = F.split_part(P.file_name("archive"), F.lit("="), F.lit(2))
    return totals.select(source.alias("source"), "member", "length", "crc32", "ok")


def q_parquet_gzip_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.write_parquet(td.table(spark, sf_dir, "orders"), scratch_path(spark, "orders-gzip"), compression="gzip")
    return srcs.read_catalogue(spark, path)


def q_json_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = catalogue.file_catalogue(td.documents_as_files(spark, sf_dir))
    path = sinks.write_json(files, scratch_path(spark, "catalogue-json"))
    return lbl.read_labels(spark, path, schema=catalogue.CATALOGUE_SCHEMA, multi_line=False)


def q_lineitem_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalogue.file_catalogue(td.lineitem_as_files(spark, sf_dir))


def q_lineitem_type_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = td.lineitem_as_files(spark, sf_dir).withColumn("flag", P.top_folder("full_path", 2))
    return stats.type_counts(files, stats.BUCKETS_A1, size="file_size", by=["flag"])


def q_partitioned_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the three catalogues partitioned by dataset and read them back
    by name (PartitionFilters prune what is not named)."""
    sets = _three_catalogues(spark, sf_dir)
    path = sinks.write_parquet(catalogue.catalogue_datasets(sets), scratch_path(spark, "catalogues"),
                               partition_by=["dataset"])
    return srcs.read_catalogue(spark, path, datasets=list(sets))


def q_label_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = td.documents_as_files(spark, sf_dir)
    return scan.label_path_table(scan.match_name(files, "*.json"))


def q_list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three catalogues saved as tables of one database; the listing of
    that database, in its order, with the rows of each table."""
    db = sinks.unique_table_name("filelens_catalogues")
    spark.sql(f"CREATE DATABASE {db} LOCATION '{scratch_path(spark, 'catalogues-db')}'")
    for name, cat in _three_catalogues(spark, sf_dir).items():
        sinks.save_table(cat, f"{db}.{name}_files", path=scratch_path(spark, f"{name}-files"))
    shown = [tuple(r) for r in srcs.list_tables(spark, db).collect()]  # a catalog's listing is on the driver anyway
    rows = [_resolved(spark, f"{schema}.{name}").groupBy().agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(schema.replace(db, "filelens_catalogues")).alias("table_schema"), F.lit(name).alias("table_name"), F.lit(at).alias("position"), "n_rows")
        for at, (schema, name) in enumerate(shown, 1)]
    spark.sql(f"DROP DATABASE {db}")
    return catalogue.union_labels(rows)


def q_datasets_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalogues whose names a table lists, its inactive ones left out."""
    path = sinks.write_parquet(catalogue.catalogue_datasets(_three_catalogues(spark, sf_dir)), scratch_path(spark, "catalogues"), partition_by=["dataset"])
    names = td.dataset_names(spark, sf_dir)
    listed = sinks.write_parquet(names, scratch_path(spark, "dataset-names"))
    return srcs.read_catalogue(spark, path, datasets=spark.read.parquet(listed).where("active").select("name"))


def q_constraint_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Constraints of a catalogue that arrives in three batches."""
    cat = catalogue.file_catalogue(td.pages_as_odd_files(spark, sf_dir))
    state = constraints.ConstraintState(spark, scratch_path(spark, "constraint-state"), buckets=default_parallelism(spark))
    for batch in range(3):
        state.add(cat.where(F.pmod(F.xxhash64("full_path"), F.lit(3)) == batch))
    out = state.violations()
    out.schema  # noqa: B018 - resolved while the table is known
    state.drop()
    return out


def q_hot_label_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels joined to files of which a third carries one key."""
    files, labels = td.lineitem_by_hot_key(spark, sf_dir), td.part_labels_with_hot_key(spark, sf_dir)
    return catalogue.join_labels(files, labels, drop_key=False, hot_keys=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "file_catalogue": q_file_catalogue,
    "url_catalogue": q_url_catalogue,
    "legacy_ids": q_legacy_ids,
    "extension_filter": q_extension_filter,
    "subdir_rule": q_subdir_rule,
    "one_level_rule": q_one_level_rule,
    "no_zip_rule": q_no_zip_rule,
    "type_counts_a1": q_type_counts_a1,
    "type_counts_a2": q_type_counts_a2,
    "type_counts_a3": q_type_counts_a3,
    "type_counts_by_source": q_type_counts_by_source,
    "type_counts_long": q_type_counts_long,
    "format_bytes": q_format_bytes,
    "archive_dest": q_archive_dest,
    "flatten_one": q_flatten_one,
    "flatten_deep": q_flatten_deep,
    "flatten_map": q_flatten_map,
    "json_labels": q_json_labels,
    "select_labels": q_select_labels,
    "label_catalogue": q_label_catalogue,
    "meta_info": q_meta_info,
    "legacy_label_catalogue": q_legacy_label_catalogue,
    "union_labels": q_union_labels,
    "catalogue_datasets": q_catalogue_datasets,
    "assign_batches": q_assign_batches,
    "preview_top": q_preview_top,
    "check_constraints": q_check_constraints,
    "expand_archives": q_expand_archives,
    "table_roundtrip": q_table_roundtrip,
    "parquet_gzip_roundtrip": q_parquet_gzip_roundtrip,
    "json_records": q_json_records,
    "json_documents": q_json_documents,
    "parquet_to_table": q_parquet_to_table,
    "create_table": q_create_table,
    "partitioned_catalogue": q_partitioned_catalogue,
    "label_paths": q_label_paths,
    "lineitem_catalogue": q_lineitem_catalogue,
    "lineitem_type_counts": q_lineitem_type_counts,
    "list_tables": q_list_tables,
    "listed_files": q_listed_files,
    "label_files": q_label_files,
    "archive_members": q_archive_members,
    "undeclared_labels": q_undeclared_labels,
    "replaced_table": q_replaced_table,
    "constraint_batches": q_constraint_batches,
    "datasets_by_table": q_datasets_by_table,
    "hot_label_catalogue": q_hot_label_catalogue,
}
