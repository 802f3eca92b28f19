"""Small files on the shared file system: driver-side reads and writes of a few kilobytes, by Hadoop's file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file whole: it is drafted under a name with a dot, which readers skip, and then renamed."""
    system, target = _system(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}")
    stream = system.create(draft, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if system.exists(target):
        system.delete(target, False)
    if not system.rename(draft, target):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """The whole of a small file."""
    system, target = _system(spark, path)
    stream = system.open(target)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder that readers see, sorted; none if there is no folder."""
    system, target = _system(spark, path)
    if not system.exists(target):
        return []
    found = (s.getPath().getName() for s in system.listStatus(target))
    return sorted(name for name in found if name[0] not in "_.")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of our own, if it is there."""
    system, target = _system(spark, path)
    system.delete(target, True)
