"""Session and shared storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def get_session(
    app: str = "clickpulse",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the settings every job here expects.

    The session time zone is pinned to UTC so printed times match the oracle;
    the library itself never depends on it (see ``functions.timeutil``).
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Window state of streams need not fit in memory.
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def storage_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` as the cluster names it. Only a local
    session without it (tests) gets a fresh temporary folder; on a cluster a
    machine-local folder would not survive the loss of that machine, so the
    setting is required there.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not _is_local(spark):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="clickpulse-")
        spark.conf.set(CHECKPOINT_CONF, root)
    try:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    except Exception:  # noqa: BLE001 - no SparkContext (e.g. a Spark Connect session)
        pass
    return root.rstrip("/")


def _is_local(spark: SparkSession) -> bool:
    try:
        return spark.sparkContext.master.startswith("local")
    except Exception:  # noqa: BLE001 - no SparkContext: a remote session, never local
        return False


def scratch_path(spark: SparkSession, kind: str, name: str) -> str:
    """A new, unique path under the shared root: ``<root>/clickpulse/<kind>/<name>-<id>``."""
    return f"{storage_root(spark)}/clickpulse/{kind}/{name}-{uuid.uuid4().hex[:12]}"


def _file_system(spark: SparkSession, path: str):
    """The file system of a path, whatever its kind, and the path in it."""
    jvm = spark.sparkContext._jvm  # noqa: SLF001 - Hadoop's file systems have no other door in PySpark
    there = jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), there  # noqa: SLF001


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, there = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(there)) if fs.exists(there) else []


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder of ours if it is there."""
    fs, there = _file_system(spark, path)
    fs.delete(there, True)


def publish_folder(spark: SparkSession, draft: str, final: str) -> bool:
    """Show a finished folder under its final name in one step; False, and no change, if that name is taken."""
    fs, here = _file_system(spark, draft)
    _, there = _file_system(spark, final)
    if fs.exists(there):
        fs.delete(here, True)
        return False
    if not fs.rename(here, there):
        raise OSError(f"cannot rename {draft} to {final}")
    return True


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``clickpulse`` importable in Python workers (needed by Python stateful code).

    Only for a source checkout on a local master: the package is zipped once per
    application and added with ``addPyFile``. On a cluster the package is
    installed on the executors or passed with ``--py-files``; nothing is done.
    """
    import zipfile

    import clickpulse

    pkg_dir = os.path.dirname(os.path.abspath(clickpulse.__file__))
    app = spark.sparkContext.applicationId
    local = spark.sparkContext.master.startswith("local")
    if not local or "site-packages" in pkg_dir or app in _SHIPPED:
        return
    zpath = os.path.join(tempfile.mkdtemp(prefix="clickpulse-code-"), "clickpulse.zip")
    with zipfile.ZipFile(zpath, "w") as z:
        for base, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    spark.sparkContext.addPyFile(zpath)
    _SHIPPED.add(app)
