"""Small file operations through the Hadoop file system: no Spark job, any store the session reaches."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession

# Beside a table: what takes its place next, and what it was before.
NEXT, OLD = ".next", ".old"
_READY = "_READY"


def _at(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _at(spark, path)
    return system.exists(place)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    place, system = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(place)) if system.exists(place) else []


def make_folder(spark: SparkSession, path: str) -> None:
    place, system = _at(spark, path)
    system.mkdirs(place)


def remove(spark: SparkSession, path: str) -> None:
    place, system = _at(spark, path)
    system.delete(place, True)


def rename(spark: SparkSession, path: str, new: str) -> None:
    place, system = _at(spark, path)
    if not system.rename(place, _at(spark, new)[0]):
        raise OSError(f"cannot rename {path} to {new}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Stores a small file in one step: it appears under its name when it is whole."""
    target, system = _at(spark, path)
    # A dot in front hides the file from readers until it is renamed.
    hidden = target.getParent().suffix(f"/.{target.getName()}")
    stream = system.create(hidden, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if system.exists(target):
        system.delete(target, False)
    if not system.rename(hidden, target):
        raise OSError(f"cannot store {path}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as ``write_text`` stores it."""
    place, system = _at(spark, path)
    stream = system.open(place)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def settle(spark: SparkSession, path: str) -> None:
    """Ends a replacement that was interrupted, and removes what an earlier one has left."""
    fresh, old = path + NEXT, path + OLD
    if not exists(spark, path) and exists(spark, old):
        whole = exists(spark, f"{fresh}/{_READY}")
        rename(spark, fresh if whole else old, path)
    for leftover in (fresh, old):
        remove(spark, leftover)


def current(spark: SparkSession, path: str) -> str:
    """Where a table can be read: also in the moment between the two renames of a replacement."""
    if not exists(spark, path) and exists(spark, path + OLD):
        return path + OLD
    return path


@contextmanager
def replacing(spark: SparkSession, path: str) -> Iterator[str]:
    """The folder to write a table's next state to; it becomes the table if the block ends well.

    The table stays as it is until all of the new one is written. It is then
    renamed out of the way and the new one renamed to its place. Should the
    driver die in between, ``current`` still finds the old state, and the next
    load finishes the replacement. One load at a time may replace a table.
    """
    settle(spark, path)
    try:
        yield path + NEXT
    except BaseException:
        remove(spark, path + NEXT)
        raise
    write_text(spark, f"{path}{NEXT}/{_READY}", "")
    if exists(spark, path):
        rename(spark, path, path + OLD)
    rename(spark, path + NEXT, path)
    remove(spark, path + OLD)
