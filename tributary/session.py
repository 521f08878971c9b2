"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_local_roots: dict[str, str] = {}
_staged: dict[str, list[str]] = {}  # by application: paths that ``scratch`` has given out


def local_session(cores: str = "*", app: str = "tributary", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.maxConcurrentOutputFileWriters", "4")  # no sort before a split write
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own: on a
    cluster a driver-local path would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="tributary-")
    return _local_roots[context.applicationId]


def qualified(spark: SparkSession, name: str) -> str:
    """A path with its scheme, so that it means the same wherever it is used."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(path).toString()


def scratch(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder, which ``drop_staged`` will delete."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Write ``df`` once to the shared folder; returns it read back, and its rows.

    Cuts the lineage, so later passes neither recompute the input nor see other
    row positions after an executor is lost. The rows are counted by the writing
    tasks, of which Spark takes one success each.
    """
    path = scratch(df.sparkSession, label)
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen.get["rows"]


def stage(df: DataFrame, label: str) -> DataFrame:
    """As ``stage_counted``, without the count."""
    return stage_counted(df, label)[0]


def drop_staged(spark: SparkSession) -> int:
    """Delete what this application has written to the shared folder so far; returns how many folders.

    To be called when the results that read them are written.
    """
    jvm = spark.sparkContext._jvm
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    paths = _staged.pop(spark.sparkContext.applicationId, [])
    for name in paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(hadoop).delete(path, True)
    return len(paths)
