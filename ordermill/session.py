"""Session settings the engine relies on, and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_SETTINGS = {
    # ISO dates and run timestamps must not depend on the machine's zone.
    "spark.sql.session.timeZone": "UTC",
    # A repeated key in an items object: the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # windows-1256 sources are outside the short list of charsets Spark 4 accepts by default.
    "spark.sql.legacy.javaCharsets": "true",
    "spark.sql.adaptive.enabled": "true",
    # Generated methods above this size are never compiled to machine code by HotSpot; Spark then
    # generates smaller ones per operator. The wide rule projections run measurably faster so.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Shuffle files go when their query ends, not when the driver's garbage collector finds them unused.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Re-writing one run's partition must leave the other runs alone.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session; safe to call again."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session may do without it: it then gets a fresh temporary folder, which is
    recorded in the session so that later calls find the same one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    folder = spark.conf.get("ordermill.local.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = tempfile.mkdtemp(prefix="ordermill-")
        spark.conf.set("ordermill.local.dir", folder)
    return folder


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A new, not yet existing path under the shared folder."""
    return f"{shared_dir(spark)}/ordermill/{label}-{uuid.uuid4().hex}"
