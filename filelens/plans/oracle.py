"""DuckDB SQL for every registered query (the correctness oracle).

Where the path rules are under test, the SQL derives the expected value from
the table columns directly (``doc_id % 6`` gives the extension, ``lang``
the folder, ...) instead of repeating the regexes, so the Spark expressions
are checked against an independent formulation.
"""

from __future__ import annotations

# ``doc_id % 6`` -> extension, as in filelens.plans.testdata.DOC_EXTENSIONS.
EXT = ("CASE doc_id % 6 WHEN 0 THEN 'png' WHEN 1 THEN 'jpg' WHEN 2 THEN 'jpeg' "
       "WHEN 3 THEN 'csv' WHEN 4 THEN 'json' ELSE 'tar.gz' END")
PATH = f"'/data/' || source || '/' || lang || '/doc_' || CAST(doc_id AS VARCHAR) || '.' || {EXT}"
FILE_NAME = f"'doc_' || CAST(doc_id AS VARCHAR) || '.' || {EXT}"
FILE_ID = "'doc_' || CAST(doc_id AS VARCHAR) || CASE WHEN doc_id % 6 = 5 THEN '.tar' ELSE '' END"

DOC_CATALOGUE = f"""
SELECT {PATH} AS full_path, {FILE_ID} AS file_id, {FILE_NAME} AS file_name,
       lang AS folder_name, CAST(n_chars AS BIGINT) AS file_size
FROM documents"""


# ``doc_id % 8`` -> place, as in filelens.plans.testdata.TREE_PLACES.
TREE = """
SELECT doc_id, source, lang, CAST(n_chars AS BIGINT) AS file_size, '/data/' || source || CASE doc_id % 8
    WHEN 0 THEN '-' || doc_id || '.zip' WHEN 1 THEN '-' || doc_id || '.png'
    WHEN 2 THEN '/' || lang || '/in_' || doc_id || '.zip' WHEN 3 THEN '/' || lang || '/.dot_' || doc_id || '.json'
    WHEN 4 THEN '.zip/' || lang || '/doc_' || doc_id || '.csv'
    WHEN 5 THEN '/' || lang || '/two' || chr(10) || 'lines_' || doc_id || '.csv'
    ELSE '/' || lang || '/doc_' || doc_id || '.txt' END AS full_path
FROM documents"""


def _fmt(n: str) -> str:
    """format_bytes in SQL: strict '>' steps of 1024, B as integer text."""
    parts = [f"WHEN {n} <= 1024 THEN CAST({n} AS VARCHAR) || ' B'"]
    for k, unit in enumerate(("KB", "MB", "GB", "TB"), start=1):
        parts.append(f"WHEN {n} <= {1024 ** (k + 1)} THEN CAST(CAST({n} AS DOUBLE) / {float(1024 ** k)!r} AS VARCHAR) || ' {unit}'")
    return "CASE " + " ".join(parts) + " END"


def _url_catalogue() -> str:
    # basename = text after the last '/', id = basename minus '.ext' when a
    # non-dot character precedes the last dot, folder = last piece of the
    # dirname with trailing slashes removed.
    return r"""
WITH b AS (
  SELECT url AS full_path, regexp_extract(url, '[^/]*$') AS file_name,
         CAST(strlen(html) AS BIGINT) AS file_size FROM pages),
d AS (
  SELECT *, rtrim(left(full_path, length(full_path) - length(file_name)), '/') AS dir_part FROM b)
SELECT full_path,
       CASE WHEN regexp_matches(file_name, '^\.*[^.].*\.[^.]*$')
            THEN left(file_name, length(file_name) - length(regexp_extract(file_name, '\.[^.]*$')))
            ELSE file_name END AS file_id,
       file_name,
       CASE WHEN dir_part = '' THEN '' ELSE string_split(dir_part, '/')[-1] END AS folder_name,
       file_size
FROM d"""


def _type_counts(buckets: list[tuple[str, str]], etc: str, with_size: bool, by: str | None = None) -> str:
    cols = ["count(*) AS n_files"]
    if with_size:
        cols.append("CAST(sum(n_chars) AS BIGINT) AS total_bytes")
    cols += [f"count(*) FILTER (WHERE {cond}) AS {name}_count" for name, cond in buckets]
    cols.append(f"count(*) FILTER (WHERE {etc}) AS etc_count")
    sel = ", ".join(([by] if by else []) + cols)
    inner = f"SELECT {sel} FROM documents" + (f" GROUP BY {by}" if by else "")
    if not with_size:
        return inner
    return f"SELECT *, {_fmt('total_bytes')} AS total_size FROM ({inner})"


A1 = [("png", "doc_id % 6 = 0"), ("jpg", "doc_id % 6 IN (1, 2)"), ("csv", "doc_id % 6 = 3"),
      ("json", "doc_id % 6 = 4")]
A2 = A1[:3]
A3 = A1[:2]

LONG_TYPES = [("jpg", 1), ("jpeg", 2), ("png", 0), ("csv", 3), ("json", 4)]

LI_EXT = ("CASE (l_orderkey + l_linenumber) % 6 WHEN 0 THEN 'png' WHEN 1 THEN 'jpg' WHEN 2 THEN 'jpeg' "
          "WHEN 3 THEN 'csv' WHEN 4 THEN 'json' ELSE 'tar.gz' END")
LI_STEM = ("'part_' || CAST(l_partkey AS VARCHAR) || '_' || CAST(l_orderkey AS VARCHAR) || '_' "
           "|| CAST(l_linenumber AS VARCHAR)")
LI_CATALOGUE = f"""
SELECT '/lineitem/' || l_returnflag || '/' || l_linestatus || '/' || CAST(l_suppkey AS VARCHAR) || '/'
         || {LI_STEM} || '.' || {LI_EXT} AS full_path,
       {LI_STEM} || CASE WHEN (l_orderkey + l_linenumber) % 6 = 5 THEN '.tar' ELSE '' END AS file_id,
       {LI_STEM} || '.' || {LI_EXT} AS file_name,
       CAST(l_suppkey AS VARCHAR) AS folder_name,
       CAST(l_quantity AS BIGINT) * 1024 AS file_size
FROM lineitem"""


def _li_type_counts() -> str:
    m = "(l_orderkey + l_linenumber) % 6"
    inner = f"""
SELECT l_returnflag AS flag, count(*) AS n_files, CAST(sum(CAST(l_quantity AS BIGINT) * 1024) AS BIGINT) AS total_bytes,
       count(*) FILTER (WHERE {m} = 0) AS png_count, count(*) FILTER (WHERE {m} IN (1, 2)) AS jpg_count,
       count(*) FILTER (WHERE {m} = 3) AS csv_count, count(*) FILTER (WHERE {m} = 4) AS json_count,
       count(*) FILTER (WHERE {m} = 5) AS etc_count
FROM lineitem GROUP BY l_returnflag"""
    return f"SELECT *, {_fmt('total_bytes')} AS total_size FROM ({inner})"


def _crc_table() -> list[int]:
    """What one byte does to a CRC-32 (reflected polynomial 0xEDB88320)."""
    table = []
    for value in range(256):
        for _ in range(8):
            value = (value >> 1) ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


SQL: dict[str, str] = {
    "file_catalogue": DOC_CATALOGUE,
    "url_catalogue": _url_catalogue(),
    "legacy_ids": f"""
SELECT {PATH} AS full_path,
       CASE WHEN doc_id % 6 = 5 THEN 'tar' ELSE 'doc_' || CAST(doc_id AS VARCHAR) END AS file_id_legacy,
       CASE WHEN doc_id % 6 = 5 THEN NULL ELSE lang END AS folder_legacy,
       {FILE_ID} AS file_id
FROM documents""",
    "extension_filter": f"""
SELECT {PATH} AS full_path, {EXT} AS extension, CAST(n_chars AS BIGINT) AS file_size
FROM documents WHERE doc_id % 6 <> 5""",
    "subdir_rule": f"""
SELECT full_path, file_size, CAST(5 AS BIGINT) AS depth FROM ({TREE})
WHERE source LIKE 'src1%' AND doc_id % 8 IN (2, 3, 5, 6, 7)""",
    "one_level_rule": f"""
SELECT full_path, file_size, CAST(5 AS BIGINT) AS depth FROM ({TREE})
WHERE source LIKE 'src1%' AND lang LIKE 'e%' AND doc_id % 8 IN (2, 4, 5, 6, 7)""",
    "no_zip_rule": f"""
SELECT full_path, file_size FROM ({TREE}) WHERE doc_id % 8 NOT IN (0, 2)""",
    "type_counts_a1": _type_counts(A1, "doc_id % 6 = 5", with_size=False),
    "type_counts_a2": _type_counts(A2, "doc_id % 6 IN (4, 5)", with_size=True),
    "type_counts_a3": _type_counts(A3, "doc_id % 6 IN (3, 4, 5)", with_size=True),
    "type_counts_by_source": _type_counts(A2, "doc_id % 6 IN (4, 5)", with_size=True, by="source"),
    "type_counts_long": " UNION ALL ".join(
        [f"SELECT '{t}_counts' AS type_name, count(*) FILTER (WHERE doc_id % 6 = {m}) AS n FROM documents"
         for t, m in LONG_TYPES]
        + ["SELECT 'etc_counts' AS type_name, count(*) FILTER (WHERE doc_id % 6 = 5) AS n FROM documents"]),
    "format_bytes": f"""
SELECT o_orderkey, o_orderkey * 1000003 AS n_bytes, {_fmt('o_orderkey * 1000003')} AS size_text
FROM orders""",
    "archive_dest": f"""
SELECT {PATH} AS full_path,
       '/data/' || source || '/' || lang || '/' || {FILE_ID} AS dest
FROM documents""",
    "flatten_one": """
SELECT p_partkey AS id, p_name AS info_name, p_brand AS info_brand, p_size AS spec_size,
       p_retailprice AS spec_price, p_type AS info_kind
FROM part""",
    "flatten_deep": """
SELECT CAST(p_partkey AS VARCHAR) AS id,
       CAST(p_size AS BIGINT) AS "image.size.width", CAST(p_size * 2 AS BIGINT) AS "image.size.height",
       p_retailprice / 500.0::DOUBLE AS "dataset.quality1", p_size / 10.0::DOUBLE AS "dataset.quality2",
       p_retailprice / 250.0::DOUBLE AS "dataset.quality3", CAST(p_size AS DOUBLE) AS "dataset.quality4",
       p_brand AS "dataset.result"
FROM part""",
    "flatten_map": """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS props_k FROM events""",
    "json_labels": """
SELECT event_id, event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events""",
    "select_labels": """
SELECT CAST(p_partkey AS VARCHAR) AS file_id, CAST(p_size AS BIGINT) AS width,
       CAST(p_size * 2 AS BIGINT) AS height,
       p_retailprice / 500.0::DOUBLE AS "밀도", p_size / 10.0::DOUBLE AS "흡수율",
       p_retailprice / 250.0::DOUBLE AS "안전성", CAST(p_size AS DOUBLE) AS "잔입자_통과량",
       p_brand AS target_data,
       p_retailprice / 500.0::DOUBLE >= 2.5 AS q1_ok, p_size / 10.0::DOUBLE <= 3.0 AS q2_ok,
       p_retailprice / 250.0::DOUBLE <= 5.0 AS q3_ok
FROM part""",
    "label_catalogue": f"""
WITH d AS (SELECT {FILE_ID} AS file_id, {PATH} AS full_path, {FILE_NAME} AS file_name, lang AS folder_name,
                  CAST(n_chars AS BIGINT) AS file_size FROM documents)
SELECT full_path, file_name, folder_name, file_size, l.quality, l.toxic
FROM d JOIN labels l ON d.file_id = 'doc_' || CAST(l.doc_id AS VARCHAR)""",
    "meta_info": f"""
SELECT {PATH} AS full_path, {FILE_NAME} AS file_name, d.lang AS folder_name,
       CAST(d.n_chars AS BIGINT) AS file_size,
       CAST(p.p_size AS BIGINT) AS width, CAST(p.p_size * 2 AS BIGINT) AS height,
       p.p_retailprice / 500.0::DOUBLE AS "밀도", p.p_size / 10.0::DOUBLE AS "흡수율",
       p.p_retailprice / 250.0::DOUBLE AS "안전성", CAST(p.p_size AS DOUBLE) AS "잔입자_통과량",
       p.p_brand AS target_data
FROM documents d JOIN part p ON {FILE_ID} = 'doc_' || CAST(p.p_partkey AS VARCHAR)""",
    "legacy_label_catalogue": f"""
SELECT '/data/' || source || '/' || lang || '/scan.doc_' || CAST(doc_id AS VARCHAR) || '.' || {EXT} AS full_path,
       NULL::VARCHAR AS folder, 'scan.doc_' || CAST(doc_id AS VARCHAR) || '.' || {EXT} AS file_name,
       CAST(d.n_chars AS BIGINT) AS file_size,
       CAST(p.p_size AS BIGINT) AS width, CAST(p.p_size * 2 AS BIGINT) AS height,
       p.p_retailprice / 500.0::DOUBLE AS "밀도", p.p_size / 10.0::DOUBLE AS "흡수율",
       p.p_retailprice / 250.0::DOUBLE AS "안전성", CAST(p.p_size AS DOUBLE) AS "잔입자_통과량",
       p.p_brand AS target_data
FROM documents d JOIN part p ON d.doc_id = p.p_partkey WHERE doc_id % 6 <> 5""",
    "union_labels": """
SELECT doc_id, quality, toxic FROM labels
UNION ALL BY NAME SELECT p_partkey AS doc_id, p_brand AS result FROM part
UNION ALL BY NAME SELECT conv_id AS doc_id, turn, role AS result FROM conversations""",
    "catalogue_datasets": f"""
WITH s AS (
  SELECT 'documents' AS dataset, count(*) AS n_rows, CAST(sum(n_chars) AS BIGINT) AS total_bytes FROM documents
  UNION ALL SELECT 'pages', count(*), CAST(sum(strlen(html)) AS BIGINT) FROM pages
  UNION ALL SELECT 'conversations', count(*), CAST(sum(strlen(text)) AS BIGINT) FROM conversations)
SELECT dataset, n_rows, total_bytes, CAST(5 AS BIGINT) AS n_cols, {_fmt('total_bytes')} AS total_size FROM s""",
    "assign_batches": f"""
WITH f AS (SELECT {PATH} AS full_path, CAST(n_chars AS BIGINT) AS file_size FROM documents)
SELECT full_path, file_size, row_number() OVER (ORDER BY full_path) - 1 AS row_index,
       CAST((row_number() OVER (ORDER BY full_path) - 1) // 3 AS BIGINT) AS batch_id
FROM f""",
    "preview_top": f"""
SELECT * FROM ({DOC_CATALOGUE}) ORDER BY file_size DESC, full_path DESC LIMIT 10""",
    "check_constraints": """
SELECT 'primary_key' AS violation, 'same' AS file_id, count(*) AS n_rows FROM pages WHERE page_id % 5 = 0 HAVING count(*) > 1
UNION ALL SELECT 'key_length', 'a_very_long_page_identifier_' || page_id, count(*) FROM pages WHERE page_id % 5 = 1 GROUP BY ALL
UNION ALL SELECT 'key_length', page_id || repeat('n', 260), count(*) FROM pages WHERE page_id % 5 = 2 GROUP BY ALL
UNION ALL SELECT 'file_name_length', page_id || repeat('n', 260), count(*) FROM pages WHERE page_id % 5 = 2 GROUP BY ALL
UNION ALL SELECT 'folder_name_length', CAST(page_id AS VARCHAR), count(*) FROM pages WHERE page_id % 5 = 3 GROUP BY ALL
UNION ALL SELECT 'not_null', CAST(page_id AS VARCHAR), count(*) FROM pages WHERE page_id % 5 = 4 GROUP BY ALL""",
    "expand_archives": """
SELECT source, lang || '/doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS member,
       CAST(strlen(text) AS BIGINT) AS length, md5(text) AS content_md5
FROM documents""",
    "table_roundtrip": "SELECT * FROM orders",
    "parquet_gzip_roundtrip": "SELECT * FROM orders",
    "parquet_to_table": "SELECT * FROM orders",
    "create_table": DOC_CATALOGUE,
    "json_records": DOC_CATALOGUE,
    "json_documents": """
SELECT CAST(p_partkey AS VARCHAR) AS file_id, CAST(p_size AS BIGINT) AS width, CAST(p_size * 2 AS BIGINT) AS height,
       p_retailprice / 500.0::DOUBLE AS "밀도", p_size / 10.0::DOUBLE AS "흡수율",
       p_retailprice / 250.0::DOUBLE AS "안전성", CAST(p_size AS DOUBLE) AS "잔입자_통과량", p_brand AS target_data
FROM part""",
    "partitioned_catalogue": f"""
SELECT *, 'documents' AS dataset FROM ({DOC_CATALOGUE})
UNION ALL SELECT *, 'pages' FROM ({_url_catalogue()})
UNION ALL SELECT '/conversations/' || conv_id || '/' || turn || '_' || role || '.txt', turn || '_' || role, turn || '_' || role || '.txt',
       CAST(conv_id AS VARCHAR), CAST(strlen(text) AS BIGINT), 'conversations' FROM conversations""",
    "list_tables": """
SELECT 'filelens_catalogues' AS table_schema, 'documents_files' AS table_name, 2 AS position, count(*) AS n_rows FROM documents
UNION ALL SELECT 'filelens_catalogues', 'pages_files', 3, count(*) FROM pages
UNION ALL SELECT 'filelens_catalogues', 'conversations_files', 1, count(*) FROM conversations""",
    "listed_files": f"""
WITH t AS (SELECT t.*, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes FROM ({TREE}) t JOIN documents d ON d.doc_id = t.doc_id)
SELECT 'subdirs' AS rule, full_path, n_bytes AS file_size FROM t WHERE source LIKE 'src1%' AND doc_id % 8 IN (2, 3, 5, 6, 7)
UNION ALL SELECT 'one_level', full_path, n_bytes FROM t WHERE source LIKE 'src1%' AND lang LIKE 'e%' AND doc_id % 8 IN (2, 4, 5, 6, 7)
UNION ALL SELECT 'no_zip', full_path, n_bytes FROM t WHERE doc_id % 8 NOT IN (0, 2)""",
    "archive_members": f"""
WITH b AS (SELECT source, lang, doc_id, text, CASE WHEN text = '' THEN [] ELSE
             list_transform(range(0, strlen(text)), lambda i: CAST('0x' || substr(hex(text), 2 * i + 1, 2) AS BIGINT)) END AS bs FROM documents)
SELECT source, lang || '/doc_' || CAST(doc_id AS VARCHAR) || '.txt' AS member, CAST(strlen(text) AS BIGINT) AS length,
       xor(list_reduce(list_prepend(4294967295::BIGINT, bs), lambda h, b: xor(h >> 8, CAST(({_crc_table()})[xor(h & 255, b) + 1] AS BIGINT))),
           4294967295::BIGINT) AS crc32, true AS ok
FROM b""",
    "undeclared_labels": """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS "props.k",
       CASE WHEN event_id % 2 <> 0 THEN value END AS "props.more.deep.v", CASE WHEN event_id % 2 <> 0 THEN event_type END AS "props.more.kind"
FROM events""",
    "replaced_table": """
SELECT *, count(*) OVER () AS n_written FROM orders WHERE o_orderstatus <> 'O'""",
    "datasets_by_table": f"""
SELECT * FROM (SELECT *, 'documents' AS dataset FROM ({DOC_CATALOGUE})
UNION ALL SELECT '/conversations/' || conv_id || '/' || turn || '_' || role || '.txt', turn || '_' || role, turn || '_' || role || '.txt',
       CAST(conv_id AS VARCHAR), CAST(strlen(text) AS BIGINT), 'conversations' FROM conversations)""",
    "hot_label_catalogue": """
SELECT CAST(p_partkey AS VARCHAR) AS file_id, l_orderkey AS order_key, l_linenumber AS line, p_brand AS brand
FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_orderkey % 3 <> 0
UNION ALL SELECT 'hot', l_orderkey, l_linenumber, p_brand FROM lineitem, part WHERE l_orderkey % 3 = 0 AND p_partkey <= 3""",
    "lineitem_catalogue": LI_CATALOGUE,
    "lineitem_type_counts": _li_type_counts(),
    "label_paths": f"""
SELECT 'doc_' || CAST(doc_id AS VARCHAR) AS file_id, {PATH} AS label_paths
FROM documents WHERE doc_id % 6 = 4""",
}
SQL["constraint_batches"] = SQL["check_constraints"]
SQL["label_files"] = SQL["json_documents"] + " WHERE p_partkey % 5 <> 0"
