"""Path helpers that work on whatever file system the path names."""

from __future__ import annotations

import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


# Parquet files of the store and of written intermediates: a third smaller than by Spark's default.
COMPRESSION = "zstd"


def read_parquet(
    spark: SparkSession,
    paths: list[str],
    schema: T.StructType,
    base: str | None = None,
    kind: str = "parquet",
) -> DataFrame:
    """Read with a given schema; an empty frame if nothing has been written yet."""
    reader = spark.read.schema(schema)
    if base:
        reader = reader.option("basePath", base)
    if len(paths) == 1:
        target, system = _hadoop(spark, paths[0])
        paths = paths if system.exists(target) else []
    if not paths:
        return spark.createDataFrame([], schema)
    try:
        return reader.format(kind).load(paths)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def _hadoop(spark: SparkSession, path: str):
    """A path and the Hadoop file system that owns it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_path(spark: SparkSession, path: str) -> bool:
    """Remove a folder through the Hadoop file system that owns it."""
    target, system = _hadoop(spark, path)
    return bool(system.delete(target, True))


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Let a small file appear with its whole text, unless one of that name exists; then False.

    Of several writers exactly one succeeds wherever a rename is atomic and refuses an existing target
    (HDFS, ABFS); local files are linked, which is as strict. On an object store without such a rename
    let one writer at a time commit.
    """
    target, system = _hadoop(spark, path)
    system.mkdirs(target.getParent())
    draft, _ = _hadoop(spark, f"{os.path.dirname(path)}/_{uuid.uuid4().hex}")
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    try:
        if system.getUri().getScheme() == "file":
            os.link(draft.toUri().getPath(), target.toUri().getPath())
        else:
            _rename(spark, draft, target)
        return True
    except FileExistsError:
        return False
    finally:
        system.delete(draft, False)


def _rename(spark: SparkSession, draft, target) -> None:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(draft, target, no_options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception.getClass().getName()):
            raise FileExistsError(str(target)) from error
        raise
