"""Session defaults and the shared scratch folder.

All instants are carried as ``timestamp_ntz`` holding UTC wall-clock time, so
results never depend on ``spark.sql.session.timeZone``; the session zone is
still pinned to UTC for anything that prints or parses zoned values.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, app: str = "vatio",
                shuffle_partitions: int | None = None,
                conf: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    ``master`` is only set when given, so a cluster launcher keeps control.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (conf or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the launcher (a shared file system or
    object store). Only a local-mode session without it gets a private folder,
    as tests do.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: only the SQL conf is visible
        sc = None
    d = (sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir")) if sc else None
    if not d:
        try:
            d = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            d = None
    if not d:
        if sc is None:
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        if not (sc.master or "").startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="vatio-ckpt-")
        atexit.register(shutil.rmtree, d, ignore_errors=True)
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


_RUN_FOLDERS: dict[str, str] = {}


def _run_folder(spark: SparkSession) -> str:
    """The application's own folder under the shared checkpoint folder. The file system
    of the driver deletes it when the driver ends."""
    root, key = checkpoint_root(spark).rstrip("/"), session_key(spark)
    if key is None:
        return f"{root}/vatio"
    name = f"{key}|{root}"
    if name not in _RUN_FOLDERS:
        folder = f"{root}/vatio/{key}"
        p = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        fs.mkdirs(p)
        fs.deleteOnExit(p)
        _RUN_FOLDERS[name] = folder
    return _RUN_FOLDERS[name]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique location under the shared checkpoint folder, for the life of the application."""
    return f"{_run_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def session_key(spark: SparkSession) -> str | None:
    """Names the running application for caches; None where it has no name here.
    (An object id could be used again after ``stop()``.)"""
    try:
        return spark.sparkContext.applicationId
    except Exception:  # noqa: BLE001 - remote session: no SparkContext
        return None


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on the file system that Spark resolves it to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def qualified(spark: SparkSession, path: str) -> str:
    """The path with scheme and authority, as Spark resolves it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(p).toString()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in executor Python workers (needed by the
    pandas-backed steps): zip it once per SparkContext and ``addPyFile`` it,
    which Spark distributes to every executor."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server side provides the package
        return
    if sc.applicationId in _SHIPPED:
        return
    import zipfile  # noqa: PLC0415
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    parent = os.path.dirname(pkg_dir)
    fd, path = tempfile.mkstemp(prefix="vatio-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, parent))
    sc.addPyFile(path)
    atexit.register(lambda: os.path.exists(path) and os.remove(path))
    _SHIPPED.add(sc.applicationId)
