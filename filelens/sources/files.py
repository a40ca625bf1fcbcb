"""File listings as DataFrames, and the listing rules as predicates.

Two listers produce the same ``(full_path string, file_size bigint)`` table:

* :func:`walk_files` - an executor-side walk, the default for paths on a
  shared mount.  The folders of the tree are found level by level, every folder
  a row of a table in the shared scratch folder, so nothing of the listing
  passes through the driver and a lost executor costs one round at most; the
  files are then listed and sized by the ``file_tree`` data source
  (:mod:`filelens.sources.tree`), in as many partitions as their number asks
  for.  Hidden, ``_name`` and empty files are included.
* :func:`list_files` - Spark's ``binaryFile`` source, for stores that only
  Spark reads.  Only ``path`` and ``length`` are selected, so file bodies are
  never read.  Spark keeps the status of every listed file on the driver and,
  like every Spark file source, skips names starting with ``.`` or ``_`` and
  zero-length files.

A folder that does not exist is an error in both; only a pattern with
wildcards may match nothing.  The listing rules are predicates over one
listing (:func:`apply_rule`), not walkers of their own.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from filelens.functions import paths as P
from filelens.session import default_parallelism, ship_package
from filelens.sources import tree
from filelens.sources.tree import LISTING, in_batches

RULES = ("subdirs", "no_zip", "one_level", "all")
_WILD = re.compile(r"[*?]|\[[^\]]+\]")


def paths_to_df(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """A user-supplied list of paths as a one-column table (empty list ok)."""
    return spark.createDataFrame([(p,) for p in paths], "full_path string")


def has_wildcards(path: str) -> bool:
    return bool(_WILD.search(path))


def hadoop_glob(path: str, literal: bool = False) -> str:
    """A path or shell glob as Hadoop reads it: braces are no alternatives
    there, and with ``literal`` nothing is a wildcard."""
    return re.sub(r"([\\{}\[\]*?])" if literal else r"([{}])", r"\\\1", path)


def list_files(spark: SparkSession, root: str | Sequence[str], pattern: str | None = None,
               recursive: bool = True) -> DataFrame:
    """``binaryFile`` listing of ``root`` (a path, glob or list of them).

    ``pattern`` is a file-name glob pushed into the listing
    (``pathGlobFilter``), e.g. ``"*.json"``.  A root with wildcards that match
    nothing gives no rows; any other root that does not exist raises, also as
    one of several.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    roots = [root] if isinstance(root, str) else list(root)
    try:
        df = reader.load(roots)
    except AnalysisException as exc:
        if "PATH_NOT_FOUND" not in str(exc) or not any(map(has_wildcards, roots)):
            raise
        if len(roots) == 1:
            return spark.createDataFrame([], LISTING)
        parts = [list_files(spark, r, pattern, recursive) for r in roots]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
    return df.select(P.strip_uri("path").alias("full_path"), F.col("length").cast("bigint").alias("file_size"))


def walk_files(spark: SparkSession, tops: Sequence[str] | DataFrame, follow_links: bool = False,
               num_partitions: int | None = None, recursive: bool = True, errors: str = "raise",
               pattern: str | None = None) -> DataFrame:
    """Executor-side walk of the given folders (a list, or a DataFrame ``top``).

    ``recursive=False`` lists the files directly inside each folder only;
    ``pattern`` is a glob for file names, applied before a file is sized.  The
    folders are found first (:func:`filelens.sources.tree.folders`), then listed
    by the ``file_tree`` data source in slices, so a flat folder that holds a
    third of all files is sized by many tasks; ``num_partitions`` replaces the
    number of tasks that follows from the number of files.  A folder that
    cannot be read or a file without a size (removed meanwhile, a dangling
    link) raises; ``errors="keep"`` keeps such a file with a null size.
    """
    if errors not in ("raise", "keep"):
        raise ValueError("errors must be 'raise' or 'keep'")
    if not isinstance(tops, DataFrame):
        tops = spark.createDataFrame([(t,) for t in tops], "top string")
    found = tree.folders(spark, tops, follow_links, recursive)
    named = f"(?s){P.glob_to_regex(pattern)}" if pattern else None
    return tree.listing(spark, found, num_partitions, errors, named)


def glob_tops(spark: SparkSession, root_glob: str, skip_zip: bool = True) -> DataFrame:
    """Folders matched by ``root_glob`` as a DataFrame ``(top)``.

    Each segment with wildcards is matched on the executors, in the folders
    that the segments before it matched, so the matches never pass through the
    driver.  Names ending in ``.zip`` are skipped unless ``skip_zip`` is false;
    hidden names follow the glob rule.  A root without wildcards must exist.
    """
    ship_package(spark)
    segments = root_glob.rstrip("/").split("/")
    first = next((i for i, s in enumerate(segments) if has_wildcards(s)), len(segments))
    n = default_parallelism(spark)
    start = "/".join(segments[:first]) or ("/" if root_glob.startswith("/") else ".")
    tops = spark.createDataFrame([(start,)], "top string")
    wild = first < len(segments)

    def step(segment: str, last: bool):
        match = re.compile("(?s)" + P.glob_to_regex(segment)).fullmatch if has_wildcards(segment) else None

        def found(folder: str) -> Iterator[tuple[str]]:
            if match is None:
                path = os.path.join(folder, segment)
                if os.path.isdir(path):
                    yield (path,)
                return
            with os.scandir(folder) as it:
                for e in it:
                    if match(e.name) and e.is_dir(follow_symlinks=True) and not (last and skip_zip and e.name.endswith(".zip")):
                        yield (e.path,)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                yield from in_batches((r for f in pdf["top"] for r in found(f)), ["top"])

        return run

    for i in range(first, len(segments)):
        last = i == len(segments) - 1
        tops = tops.mapInPandas(step(segments[i], last), "top string")
        if not last:
            tops = tops.repartition(n, "top")
    return tops if wild or not (skip_zip and start.endswith(".zip")) else tops.limit(0)


def exclude_suffix(df: DataFrame, suffix: str = ".zip", path: str = "full_path") -> DataFrame:
    """Drop paths ending in ``suffix`` (case-sensitive)."""
    return df.filter(~F.col(path).endswith(suffix))


def apply_rule(df: DataFrame, root: str, rule: str = "subdirs", path: str = "full_path") -> DataFrame:
    """Keep the rows of a listing that a listing rule returns.

    * ``subdirs``   - ``root`` is a glob; every file *inside* a matched
      entry, at any depth, unless the matched entry ends in ``.zip``.  Files
      that the glob matches directly (loose top-level files) are not kept;
      nested ``.zip`` files are.
    * ``no_zip``    - ``root`` is a directory; every file below it whose name
      does not end in ``.zip``, at any depth.
    * ``one_level`` - ``root`` is a glob of folders; the files directly inside
      each matched folder not ending in ``.zip`` (names starting with ``.``
      excluded, as ``folder/*`` does).
    * ``all``       - every file below ``root`` (a directory).

    A wildcard at the start of a segment does not match a leading dot, as
    with a shell glob.  Names may hold any character, line ends too.
    """
    p = F.col(path)
    if rule in ("subdirs", "one_level"):
        inside = ".+" if rule == "subdirs" else r"(?!\.)[^/]+"
        # the matched entry with its slash, or '' where the rule does not match
        top = F.regexp_extract(p, rf"(?s)\A({P.glob_to_regex(root.rstrip('/'))}/){inside}\z", 1)
        return df.filter((top != "") & ~top.endswith(".zip/"))
    base = root.rstrip("/") + "/"
    under = p.startswith(base) & (F.length(p) > len(base))
    if rule == "no_zip":
        return df.filter(under & ~P.file_name(p).endswith(".zip"))
    if rule == "all":
        return df.filter(under)
    raise ValueError(f"unknown rule {rule!r}; expected one of {RULES}")


def scan_files(spark: SparkSession, root: str, rule: str = "subdirs", pattern: str | None = None,
               complete: bool | None = None) -> DataFrame:
    """List a tree and keep what ``rule`` returns; ``(full_path, file_size)``.

    ``complete=True`` walks the matches on the executors (:func:`walk_files`);
    links to folders are followed only by ``no_zip``, loops of them end.
    ``complete=False`` lists
    with ``binaryFile`` (:func:`list_files`).  The default walks plain paths and
    lists URIs (``scheme://``) with Spark's source.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}; expected one of {RULES}")
    globbed = rule in ("subdirs", "one_level")
    if complete or complete is None and "://" not in root:
        tops = glob_tops(spark, root) if globbed else [root.rstrip("/") or "/"]
        listing = walk_files(spark, tops, follow_links=rule == "no_zip", recursive=rule != "one_level", pattern=pattern)
    else:
        listing = list_files(spark, hadoop_glob(root.rstrip("/"), literal=not globbed), pattern=pattern)
    if pattern:
        listing = match_name(listing, pattern)
    return apply_rule(listing, root, rule)


def match_name(df: DataFrame, pattern: str, path: str = "full_path") -> DataFrame:
    """Keep rows whose file name matches a glob such as ``*.json``."""
    return df.filter(P.file_name(path).rlike(rf"(?s)\A{P.glob_to_regex(pattern)}\z"))


def label_paths(spark: SparkSession, root: str, pattern: str = "*.json", rule: str = "one_level",
                complete: bool | None = None) -> DataFrame:
    """Label files of one folder (not of its sub-folders, unless ``rule`` is
    ``all``) as ``(file_id, label_paths)``."""
    return label_path_table(scan_files(spark, root, rule=rule, pattern=pattern, complete=complete))


def label_path_table(listing: DataFrame, path: str = "full_path") -> DataFrame:
    """``(file_id, label_paths)`` of a label listing; the id follows the older
    rule (:func:`filelens.functions.paths.file_id_legacy`)."""
    return listing.select(P.file_id_legacy(path).alias("file_id"), F.col(path).alias("label_paths"))
