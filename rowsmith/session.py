"""Session helpers: a local session for tests and benches, and the shared scratch folder.

Derived files (staged text, archives, stream sinks and checkpoints) go under the
folder the cluster names in ``spark.checkpoint.dir``: it is shared storage, so
a lost executor's output is still readable and retried tasks overwrite it. A
folder of our own is made only when the session names none (local tests).
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(
    cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "rowsmith", extra: dict[str, str] | None = None
) -> SparkSession:
    """A local session with the settings the tests and the bench use (``extra``: more settings)."""
    builder = SparkSession.builder
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = (
        builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(master: str) -> bool:
    """One JVM: driver and tasks see the same disk (``local-cluster`` runs executors of their own)."""
    return master == "local" or master.startswith("local[")


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session; set one only where none is named."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a Spark Connect session has no SparkContext
        sc = None
    current = sc.getCheckpointDir() if sc is not None else None
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not _is_local(sc.master if sc is not None else spark.conf.get("spark.master", "")):
            # A folder of one machine would be written by each executor on its own disk.
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        named = tempfile.mkdtemp(prefix="rowsmith-checkpoints-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
    if sc is None:
        spark.conf.set("spark.checkpoint.dir", named)
        return named
    sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def default_parallelism(spark: SparkSession) -> int:
    """Task slots of the cluster (from the SparkContext, else from the session conf)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # noqa: BLE001 - Spark Connect
        return int(spark.conf.get("spark.default.parallelism", "8"))


def input_bytes(spark: SparkSession, path: str | list[str]) -> int:
    """Bytes of all files under the given paths (globs allowed), from the file system's listing; no Spark job."""
    total = 0
    for p in [path] if isinstance(path, str) else path:
        target = spark._jvm.org.apache.hadoop.fs.Path(p)
        fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
        for found in fs.globStatus(target) or []:
            total += fs.getContentSummary(found.getPath()).getLength()
    return total


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder path under the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/rowsmith/{name}-{uuid.uuid4().hex[:12]}"


def local_path(uri: str) -> str | None:
    """Plain file-system path for a ``file:`` URI (or a bare path), else None."""
    if uri.startswith("file:"):
        rest = uri[len("file:"):]
        while rest.startswith("//"):
            rest = rest[1:]
        from urllib.parse import unquote

        return unquote(rest)
    if "://" not in uri and not uri.startswith(("hdfs:", "s3:", "s3a:", "gs:", "abfs:")):
        return os.path.abspath(uri)
    return None


def file_system(uri: str):
    """``(pyarrow file system, path)`` for a local or remote URI."""
    import pyarrow as pa
    import pyarrow.fs as pafs

    lp = local_path(uri)
    if lp is not None:
        return pafs.LocalFileSystem(), lp
    # Hadoop's names of the S3 file system
    if uri.startswith(("s3a://", "s3n://")):
        uri = "s3" + uri[3:]
    try:
        return pafs.FileSystem.from_uri(uri)
    except pa.ArrowInvalid as e:
        raise ValueError(f"archives can't be opened on {uri.split(':', 1)[0]}: {e}") from None
