"""Session set-up and the shared scratch folder used to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

def build_session(app: str = "grainframe", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library is tuned for.

    Adaptive execution does the run-time work the library relies on: it turns
    small sides into broadcasts after their size is known, splits skewed join
    partitions and merges small shuffle partitions.  ``conf`` keys use ``__``
    for dots (``spark__driver__memory="8g"``) and win over the defaults.
    """
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _scratch_root(spark: SparkSession) -> str:
    """The folder the cluster names, or one below the session's warehouse, which is shared too."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    return spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared scratch folder of this application."""
    app = spark.sparkContext.applicationId
    return f"{_scratch_root(spark)}/grainframe-{app}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once to shared storage and continue from the written files.

    Later steps then read committed files, so a lost executor costs a re-read
    and never a recomputation that could give other partition bounds or, for
    sums of doubles, other last digits.  ``path`` is the folder, else a new one.
    """
    spark = df.sparkSession
    path = path or scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(spark: SparkSession, path: str | None = None) -> None:
    """Delete what :func:`cut_lineage` wrote for this application, or only what it wrote to ``path``."""
    app = spark.sparkContext.applicationId
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(path or f"{_scratch_root(spark)}/grainframe-{app}")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)
