"""Small files in whatever store Spark writes to, and the atomic step that publishes one."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """What a folder holds, sorted; nothing if it is not there."""
    p, fs = _path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _path(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str:
    p, fs = _path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def publish(spark: SparkSession, path: str, text: str, draft: str) -> bool:
    """Write the text under the name draft, then give it its name in one step; False if the name is taken."""
    (p, fs), (d, _) = _path(spark, path), _path(spark, draft)
    out = fs.create(d, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    try:  # without the option to overwrite
        context.rename(d, p, spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in str(e.java_exception):
            raise
        fs.delete(d, True)
        return False
    return True
