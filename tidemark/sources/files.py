"""Small file-system calls through Hadoop, so that any shared storage works."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    fs, path = _fs(spark, folder), _path(spark, folder)
    if not fs.exists(path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(path))


def exists(spark: SparkSession, path: str) -> bool:
    return bool(_fs(spark, path).exists(_path(spark, path)))


def make_folder(spark: SparkSession, folder: str) -> None:
    _fs(spark, folder).mkdirs(_path(spark, folder))


def rename(spark: SparkSession, source: str, target: str) -> bool:
    """Atomic on file systems with a real rename; never replaces an existing target."""
    fs = _fs(spark, source)
    if fs.exists(_path(spark, target)):
        return False
    return bool(fs.rename(_path(spark, source), _path(spark, target)))


def delete_folder(spark: SparkSession, folder: str) -> None:
    _fs(spark, folder).delete(_path(spark, folder), True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    out = _fs(spark, path).create(_path(spark, path), False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str:
    stream = _fs(spark, path).open(_path(spark, path))
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()
