"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "siltlake", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution, where bad values are errors; ``conf`` keys use ``__`` for ``.``."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.ansi.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from ``spark.checkpoint.dir``.

    Only a local session that names none, as in tests, gets a temporary folder, the same one
    for as long as it runs.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if context.applicationId not in _local_dirs:
            _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="siltlake-")
        folder = _local_dirs[context.applicationId]
    return folder.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a file or directory through the file system that owns it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.delete(target, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a directory, through the file system that owns it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    return [status.getPath().getName() for status in fs.listStatus(target)]
