"""Small files and folders of whatever file system a URI names, through Hadoop's API.

For metadata only (manifests, folders to expire); tables go through Spark's readers and
writers.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsc.hadoopConfiguration()
    return hadoop_path.getFileSystem(conf), hadoop_path


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, in order; none if there is no such folder."""
    system, path = _at(spark, folder)
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a file, or of all files in a folder."""
    system, hadoop_path = _at(spark, path)
    return system.getContentSummary(hadoop_path).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    system, hadoop_path = _at(spark, path)
    stream = system.open(hadoop_path)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that must not exist yet; readers see all of it or nothing.

    The text is written under another name first. Renaming fails where the name is
    taken, so of two writers of one name one gets an error.
    """
    system, target = _at(spark, path)
    _, draft = _at(spark, f"{path}.{spark.sparkContext.applicationId}.draft")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(target) or not system.rename(draft, target):
        system.delete(draft, False)
        raise FileExistsError(path)


def remove_folder(spark: SparkSession, path: str) -> None:
    system, hadoop_path = _at(spark, path)
    system.delete(hadoop_path, True)
