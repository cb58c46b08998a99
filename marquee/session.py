"""Optional session helper for jobs started with spark-submit or ``python -m marquee``.

Library functions always take the caller's session and never build, configure or stop one.
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# What Spark documents for enabling Delta tables in a session.
DELTA_CONF = {
    "spark.sql.extensions": "io.delta.sql.DeltaSparkSessionExtension",
    "spark.sql.catalog.spark_catalog": "org.apache.spark.sql.delta.catalog.DeltaCatalog",
}


# What Spark documents for writing to object stores, where a rename is a copy: tasks upload
# parts of files, which the commit of the job completes.
COMMITTER_CONF = {
    "spark.hadoop.fs.s3a.committer.name": "magic",
    "spark.hadoop.mapreduce.outputcommitter.factory.scheme.s3a": "org.apache.hadoop.fs.s3a.commit.S3ACommitterFactory",
    "spark.sql.sources.commitProtocolClass": "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol",
    "spark.sql.parquet.output.committer.class": "org.apache.spark.internal.io.cloud.BindingParquetOutputCommitter",
}

# Classes that have to be there, and the packages they come in.
NEEDED = {
    "delta": {"io.delta.sql.DeltaSparkSessionExtension": "io.delta:delta-spark"},
    "s3a": {
        "org.apache.hadoop.fs.s3a.S3AFileSystem": "org.apache.hadoop:hadoop-aws",
        "org.apache.spark.internal.io.cloud.PathOutputCommitProtocol": "org.apache.spark:spark-hadoop-cloud",
    },
}


def require_classes(spark: SparkSession, feature: str) -> None:
    """Raise a ``RuntimeError`` that names the packages a feature lacks."""
    loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    missing = []
    for name, package in NEEDED[feature].items():
        try:
            spark._jvm.java.lang.Class.forName(name, False, loader)
        except Py4JJavaError:
            missing.append(f"{package} (for {name})")
    if missing:
        raise RuntimeError(f"{feature} needs these packages on the class path: {', '.join(missing)}")


def object_store_conf(endpoint: str) -> dict[str, str]:
    """S3A settings for a self-hosted store; credentials come from the provider chain."""
    return COMMITTER_CONF | {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.path.style.access": "true",
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
    }


def build_session(
    app_name: str,
    fmt: str = "parquet",
    endpoint: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the running session, or start one set up for ``fmt`` and the object store.

    Where their packages are absent, a new session is stopped with an error that names them, rather than
    writing through renames or failing in the middle of a job.
    """
    settings: dict[str, str] = {}
    if fmt == "delta":
        settings |= DELTA_CONF
    if endpoint:
        settings |= object_store_conf(endpoint)
    settings |= conf or {}
    builder = SparkSession.builder.appName(app_name)
    for name, value in settings.items():
        builder = builder.config(name, value)
    ours = SparkSession.getActiveSession() is None
    spark = builder.getOrCreate()
    try:
        for feature, wanted in (("delta", fmt == "delta"), ("s3a", bool(endpoint))):
            if wanted:
                require_classes(spark, feature)
    except RuntimeError:
        if ours:
            spark.stop()
        raise
    return spark
