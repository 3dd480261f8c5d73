"""Session helpers: construction for local runs, shared folders, lineage cuts."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: dict[str, str] = {}
_WRITTEN: dict[str, set[str]] = {}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(app: str = "codexmill", cores: int = 8, memory: str = "8g") -> SparkSession:
    """A local session with the settings the tests and the benchmark share."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset
    and the master is local does a temporary folder of this machine stand in.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="codexmill-")
        atexit.register(shutil.rmtree, _LOCAL[app], True)
    return "file://" + _LOCAL[app]


def written(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The plan behind the result is a plain scan, so a lost executor costs a
    re-read and not a re-computation, and an expensive Python stage runs once
    although several consumers follow. The shuffle files of the write go with its
    end, as nothing reads them again; else they stay until the driver happens to
    collect its garbage.
    """
    spark = df.sparkSession
    path = scratch(spark, label)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, name: str):
    """(file system, path) of a name, wherever Spark reaches it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def scratch(spark: SparkSession, label: str) -> str:
    """A new name in the shared folder, deleted by ``clear_written``."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, set()).add(path)
    return path


def _delete(spark: SparkSession, name: str) -> None:
    fs, path = file_system(spark, name)
    fs.delete(path, True)


def drop_written(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a table made by :func:`written` that nothing needs any more."""
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        _delete(spark, name)


def clear_written(spark: SparkSession) -> None:
    """Delete all tables made by :func:`written`, once the results that read them are stored elsewhere."""
    for name in _WRITTEN.pop(spark.sparkContext.applicationId, set()):
        _delete(spark, name)
