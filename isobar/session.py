"""Session defaults."""

from __future__ import annotations

import atexit
import re
import uuid

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def session(app: str = "isobar", **conf: str) -> SparkSession:
    """A session with the defaults; keyword names use _ for the dots of a setting's name."""
    builder = SparkSession.builder.appName(app)
    for key, value in (DEFAULTS | {k.replace("_", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Only used in local mode, as in tests, where the session names no folder.
LOCAL_SCRATCH = "file:///tmp/checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share; the cluster names it in spark.checkpoint.dir. A cluster that names none is refused."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return named.rstrip("/") if named else LOCAL_SCRATCH


_ROOTS: dict[str, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path in the session's own folder of the shared one, which goes when the driver ends."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        _ROOTS[app] = f"{shared_dir(spark)}/{app}-{uuid.uuid4().hex}"
        atexit.register(_remove, spark, _ROOTS[app])
    return f"{_ROOTS[app]}/{name}-{uuid.uuid4().hex}"


def _remove(spark: SparkSession, root: str) -> None:
    """Deletes a session's folder, if the session still runs."""
    if spark.sparkContext._jsc is not None:
        at = spark._jvm.org.apache.hadoop.fs.Path(root)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
