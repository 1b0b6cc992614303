"""Session factory and the shared folder every job writes intermediate data to."""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC session zone (date functions, D8), ANSI
# semantics, adaptive execution with skew-join splitting and partition
# coalescing, and no web UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once the DataFrame that made them is gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # list many partition folders in a few tasks rather than one tiny task per folder
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


# Added for large clusters (profile="cluster"): bigger input splits and shuffle partitions,
# many initial shuffle partitions that AQE merges to the advisory size, skew splits
# from 256 MB, and broadcasts only of sides that measure under 64 MB at run time.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "1000",
}


def get_session(master: str | None = None, app: str = "cellar", shuffle_partitions: int | None = None,
                extra: dict | None = None, profile: str = "default") -> SparkSession:
    """A session with the package's settings; ``profile='cluster'`` adds :data:`CLUSTER_CONF`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    for k, v in conf.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    ship_code(spark)
    return spark


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (what ``--py-files`` does).

    Runs once per application: the package's ``.py`` files are zipped and added
    with ``addPyFile``, so executor-side callbacks (pandas UDFs, ``mapInPandas``)
    import it whatever the driver's working directory or path is.
    """
    app = spark.conf.get("spark.app.id", None) or str(id(spark))
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    files = []
    for d, _, names in os.walk(pkg):
        files += [os.path.join(d, n) for n in sorted(names) if n.endswith(".py")]
    digest = hashlib.sha1()
    for f in sorted(files):
        with open(f, "rb") as fh:
            digest.update(f.encode() + fh.read())
    target = os.path.join(tempfile.mkdtemp(prefix="cellar-code-"), f"cellar-{digest.hexdigest()[:12]}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in files:
            z.write(f, os.path.relpath(f, root))
    try:
        spark.sparkContext.addPyFile(target)
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        spark.addArtifacts(target, pyfile=True)
    _SHIPPED.add(app)


def _is_local(spark: SparkSession) -> bool:
    master = spark.conf.get("spark.master", "") or ""
    return master == "local" or master.startswith("local[")  # local-cluster has executors of its own


def checkpoint_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    Read from the session; only a local session without one gets a fresh
    scratch folder (tests). On a cluster an unset folder is an error, never a
    machine-local fallback.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not _is_local(spark):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="cellar-ckpt-"))
    return sc.getCheckpointDir()


def shared_root(spark: SparkSession) -> str:
    """The configured shared folder itself (stable across sessions, unlike the
    per-application subfolder Spark creates for ``checkpoint()``)."""
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    return conf_dir.rstrip("/") if conf_dir else checkpoint_dir(spark).rstrip("/")


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder, for tables a job writes (derived inputs, stream checkpoints)."""
    base = shared_root(spark)
    names = [p.strip("/") for p in parts if p]
    if unique:
        names.append(uuid.uuid4().hex)
    return "/".join([base, "cellar", *names])


def run_path(spark: SparkSession, *parts: str) -> str:
    """A new path for what one run of this application writes; :func:`release_runs` removes them all."""
    return shared_path(spark, "runs", spark.sparkContext.applicationId, *parts, unique=True)


def release_runs(spark: SparkSession) -> None:
    """Remove what this application's runs have written (results must have been read or saved)."""
    fs, root = file_system(spark, shared_path(spark, "runs", spark.sparkContext.applicationId))
    fs.delete(root, True)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path in it."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme (for tests that inspect written files)."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["CLUSTER_CONF", "get_session", "ship_code", "checkpoint_dir", "shared_root", "shared_path", "run_path", "release_runs", "file_system", "local_fs_path", "DEFAULT_CONF"]
