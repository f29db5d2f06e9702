"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache
from weakref import WeakSet

from pyspark.sql import SparkSession

# Runtime settings the plans rely on.  All of them can be changed on a running
# session, so ``configure`` also works on a session somebody else has built.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time; see operators.joins.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # ... even where the grouping that follows then needs a shuffle of its own.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM compiles no method of more than 8000 bytes: larger ones are better cut up.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Shuffle files go when the query that wrote them ends; tables read again are written.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # A JSON document that repeats a key keeps the last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
}

# Upper bounds, for a session that has larger values.  A payment takes some twenty bytes in a
# compressed file, a hundred in a shuffle and several hundred while it is sorted: with so much a
# task, what tasks sort fits their memory however large the tables are, and nothing is spilled.
AT_MOST = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 16 << 20,
}

# Settings a session gets only when it is built.
STARTUP_SETTINGS = {
    "spark.ui.enabled": "false",
    # One plan here compiles some hundred classes: with the default of 100 entries
    # they would be compiled, and warmed up, anew for every query.
    "spark.sql.codegen.cache.maxEntries": "2000",
    # Do not look up the Python call site for every column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


_configured: WeakSet[SparkSession] = WeakSet()


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to ``spark``, once, and return it."""
    if spark not in _configured:
        for key, value in RUNTIME_SETTINGS.items():
            spark.conf.set(key, value)
        for key, most in AT_MOST.items():
            if _bytes(spark, spark.conf.get(key)) > most:
                spark.conf.set(key, str(most))
        _configured.add(spark)
    return spark


def _bytes(spark: SparkSession, size: str) -> int:
    """A size as settings have it (``64MB``), in bytes."""
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size)


def build_session(
    app: str = "paylake", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """A configured session.  Without ``master`` the launcher decides where it runs."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **STARTUP_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    path on one machine would be lost with that machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.conf.get("spark.master", "").startswith("local"):
        return _local_folder()
    raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="paylake-")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
