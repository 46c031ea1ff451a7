"""Small files and names in the store that Spark's tables lie in, whatever file system that is."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _is_cause(error: Py4JJavaError, name: str) -> bool:
    cause = error.java_exception
    while cause is not None:
        if cause.getClass().getSimpleName() == name:
            return True
        cause = cause.getCause()
    return False


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file, over an older one."""
    store, target = _located(spark, path)
    out = store.create(target, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file unless there is one; of any number of writers exactly one gets True.

    The text is written under a name of its own first, so that nobody sees a part of it.  The store then decides: a
    hard link on a local disk, elsewhere a rename that must not replace, which the file system has to do in one step
    (HDFS does).
    """
    store, target = _located(spark, path)
    store.mkdirs(target.getParent())
    draft = f"{target.getParent().toString()}/_draft-{uuid.uuid4().hex}"
    write_text(spark, draft, text)
    jvm = spark._jvm
    try:
        if store.getUri().getScheme() == "file":
            of = jvm.java.nio.file.Paths.get
            no_more = spark._sc._gateway.new_array(jvm.java.lang.String, 0)
            jvm.java.nio.file.Files.createLink(of(target.toUri().getPath(), no_more),
                                               of(jvm.org.apache.hadoop.fs.Path(draft).toUri().getPath(), no_more))
        else:
            context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration())
            context.rename(jvm.org.apache.hadoop.fs.Path(draft), target,
                           spark._sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0))
        return True
    except Py4JJavaError as error:
        if _is_cause(error, "FileAlreadyExistsException"):
            return False
        raise
    finally:
        delete(spark, draft)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None if there is none."""
    store, target = _located(spark, path)
    try:
        stream = store.open(target)
    except Py4JJavaError as error:
        if _is_cause(error, "FileNotFoundException"):
            return None
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    store, target = _located(spark, path)
    try:
        return sorted(status.getPath().getName() for status in store.listStatus(target))
    except Py4JJavaError as error:
        if _is_cause(error, "FileNotFoundException"):
            return []
        raise


def drop_older(spark: SparkSession, path: str, hours: float) -> None:
    """Removes what a folder holds that was last changed more than ``hours`` ago."""
    store, target = _located(spark, path)
    if store.exists(target):
        limit = spark._jvm.java.lang.System.currentTimeMillis() - int(hours * 3_600_000)
        for status in store.listStatus(target):
            if status.getModificationTime() < limit:
                store.delete(status.getPath(), True)


def exists(spark: SparkSession, path: str) -> bool:
    store, target = _located(spark, path)
    return store.exists(target)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file; one that is no longer there has been moved before."""
    store, start = _located(spark, source)
    end = spark._jvm.org.apache.hadoop.fs.Path(target)
    if store.exists(start):
        store.mkdirs(end.getParent())
        if not store.rename(start, end) and store.exists(start):
            raise OSError(f"cannot move {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    """Removes a file or folder, if it is there."""
    store, target = _located(spark, path)
    store.delete(target, True)


def relative(spark: SparkSession, root: str, path: str) -> str:
    """The part of a listed path below ``root``."""
    store, target = _located(spark, root)
    base = store.makeQualified(target).toUri().getPath().rstrip("/") + "/"
    below = spark._jvm.org.apache.hadoop.fs.Path(path).toUri().getPath()
    if not below.startswith(base):
        raise ValueError(f"{path} is not below {root}")
    return below[len(base):]
