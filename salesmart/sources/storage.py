"""The file-system calls that Spark's readers and writers do not offer: exclusive creation, listing, removal."""

from __future__ import annotations

import os
import shutil
import uuid
from urllib.parse import unquote, urlparse

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _local(path: str) -> str | None:
    """The path of a local or mounted folder; None for other file systems."""
    parsed = urlparse(path)
    return unquote(parsed.path) if parsed.scheme == "file" else None


def _remote(spark: SparkSession, path: str):
    context = spark.sparkContext
    target = context._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(context._jsc.hadoopConfiguration())


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme: one without it belongs to the default file system."""
    if urlparse(path).scheme:
        return path
    target, fs = _remote(spark, path)
    return fs.makeQualified(target).toString()


def place_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with its whole content, unless it exists; of several writers exactly one gets True.

    The content is written beside it first. A hard link, or a rename that never overwrites, then makes it appear at once:
    readers see no half-written file. The store must offer such a rename, as HDFS does.
    """
    path = _qualified(spark, path)
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    local = _local(draft)
    if local is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "x", encoding="utf-8") as out:
            out.write(text)
        try:
            os.link(local, _local(path))
        except FileExistsError:
            return False
        finally:
            os.unlink(local)
        return True
    source, fs = _remote(spark, draft)
    target, _ = _remote(spark, path)
    stream = fs.create(source, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        files.rename(source, target, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError as problem:
        fs.delete(source, False)
        if "FileAlreadyExistsException" in problem.java_exception.getClass().getName():
            return False
        raise
    return True


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible files and folders right below ``path``; none if it does not exist."""
    path = _qualified(spark, path)
    local = _local(path)
    if local is not None:
        found = os.listdir(local) if os.path.isdir(local) else []
    else:
        target, fs = _remote(spark, path)
        found = [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []
    return sorted(n for n in found if not n.startswith("."))


def exists(spark: SparkSession, path: str) -> bool:
    target, fs = _remote(spark, path)
    return fs.exists(target)


def age_seconds(spark: SparkSession, path: str) -> float:
    """Seconds since a file was last changed, by the clock of this machine."""
    target, fs = _remote(spark, path)
    return spark.sparkContext._jvm.java.lang.System.currentTimeMillis() / 1000 - fs.getFileStatus(target).getModificationTime() / 1000


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    return spark.read.text(path, wholetext=True).first()["value"]


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or folder with all below it; none there is no error."""
    path = _qualified(spark, path)
    local = _local(path)
    if local is None:
        target, fs = _remote(spark, path)
        fs.delete(target, True)
    elif os.path.isdir(local):
        shutil.rmtree(local)
    elif os.path.exists(local):
        os.unlink(local)


def claim_next(spark: SparkSession, folder: str, floor: int = 0) -> int:
    """A number above ``floor`` and all that were claimed in ``folder``, which no other caller ever gets."""
    n = max([floor, *(int(name) for name in names(spark, folder))])
    while True:
        n += 1
        if place_new(spark, f"{folder}/{n}", ""):
            return n
