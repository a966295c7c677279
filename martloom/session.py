"""Session helpers: a local session for tests and the shared folder for written tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

from martloom.operators.joins import RUNTIME_SETTINGS

_local_dirs: dict[str, str] = {}


def local_session(cores: int | str = 8, app: str = "martloom", **conf: object) -> SparkSession:
    """A local session for tests and benchmarks; a cluster brings its own session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in (RUNTIME_SETTINGS | conf).items():
        builder = builder.config(key, str(value))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach, as the cluster names it.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would lose the data with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="martloom-")
        atexit.register(shutil.rmtree, _local_dirs[app], ignore_errors=True)
    return _local_dirs[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, never used by another run."""
    return f"{shared_dir(spark)}/martloom/{uuid.uuid4().hex}/{name}"
