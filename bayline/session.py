"""Session helpers: runtime settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings the operators count on. Skewed join keys are split by
# AQE even where the split costs one more shuffle.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else has built."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = 8, app: str = "bayline") -> SparkSession:
    """A local session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def session_scratch(spark: SparkSession) -> str:
    """The session's own folder below the shared folder the cluster names.

    ``spark.checkpoint.dir`` comes from the session. Only a local master without
    that setting gets a folder on the machine itself.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.gettempdir()
    return f"{shared.rstrip('/')}/bayline-{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder in the session's scratch folder."""
    return f"{session_scratch(spark)}/{purpose}-{uuid.uuid4().hex}"


def clean_scratch(spark: SparkSession) -> bool:
    """Delete the session's scratch folder once no result that reads from it is needed any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(session_scratch(spark))
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
