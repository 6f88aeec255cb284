"""Session settings and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: str = "8", app: str = "tapeloom", **extra: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Per application: the root chosen where none is configured, and the paths made below the root.
_ROOTS: dict[str, str] = {}
_MADE: dict[str, list[str]] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; the setting is read, never written.

    Only a local-mode session without the setting gets a temporary folder of its
    own: on a cluster a machine-local path would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local") or "cluster" in spark.sparkContext.master:
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        _ROOTS[app] = tempfile.mkdtemp(prefix="tapeloom-")
    return _ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the scratch root; ``release`` removes what was written there."""
    path = f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    _MADE.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release(spark: SparkSession) -> int:
    """Remove the stored copies of this application; results that read them end here."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    removed = 0
    for path in _MADE.pop(spark.sparkContext.applicationId, []):
        place = jvm.org.apache.hadoop.fs.Path(path)
        removed += bool(place.getFileSystem(conf).delete(place, True))
    return removed


def staged(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back; ``options`` are the writer's.

    Used where a derived table feeds several branches: they then read the small
    result instead of scanning the sources again, and a lost executor costs no
    recomputation before this point.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
