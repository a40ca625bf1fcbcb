"""Session helpers: the caller owns the session; these only read settings.

``local_session`` is for tests and the bench script.  Library functions never
create a session; they take the one their input DataFrame belongs to.
"""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "filelens",
                  extra_conf: dict[str, str] | None = None) -> SparkSession:
    """A local session tuned like the target cluster (AQE on, UI off, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Arrow batches handed to mapInPandas (archive rows) bounded in bytes too
        .config("spark.sql.execution.arrow.maxBytesPerBatch", str(64 << 20))
        .config("spark.driver.memory", "8g")
    )
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None for a Spark Connect one."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no context
        return None


def default_parallelism(spark: SparkSession) -> int:
    sc = _context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", None) or spark.conf.get("spark.sql.shuffle.partitions"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where unset.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (or a folder
    already set on the context).  Only a local session - tests, the bench -
    gets a fresh temporary folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if sc is None:
        if configured:
            return configured
        raise RuntimeError("spark.checkpoint.dir is not set on this session")
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = configured or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="filelens-ckpt-"))
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; give the session a shared folder "
        "(HDFS, object store or shared mount) for checkpoints and scratch tables"
    )


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"


def local_dir(path: str) -> str:
    """Strip a ``file:`` scheme so Python can open a local folder (tests)."""
    if path.startswith("file:"):
        path = path[5:]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``filelens`` importable in the Python workers of this application.

    Operators that run Python on the executors (``mapInPandas``) need the
    package there.  When it runs from a source checkout, its ``.py`` files
    are zipped on the driver once per application and handed to Spark
    (``addPyFile``, or ``addArtifacts`` on Spark Connect), which serves them
    to the executors - the same as ``--py-files``.  An installed package is
    left alone.
    """
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    if "site-packages" in pkg_dir.split(os.sep):
        return  # installed as a package: executors have it the same way
    sc = _context(spark)
    key = sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "connect")
    if key in _SHIPPED:
        return
    base = os.path.dirname(pkg_dir)
    archive = os.path.join(tempfile.mkdtemp(prefix="filelens-pyfiles-"), "filelens.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, base))
    if sc is not None:
        sc.addPyFile(archive)
    else:
        spark.addArtifacts(archive, pyfile=True)
    _SHIPPED.add(key)
