"""Small documents on any file system: plain paths by the operating system, paths with a scheme by Spark's file systems."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import SparkSession


def _remote(path: str) -> bool:
    return re.match(r"[A-Za-z][A-Za-z0-9+.-]+:/", path) is not None


def _hadoop(path: str):
    spark = SparkSession.active()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return spark, target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(path: str) -> bool:
    if not _remote(path):
        return Path(path).exists()
    _, target, fs = _hadoop(path)
    return fs.exists(target)


def read_bytes(path: str) -> bytes:
    if not _remote(path):
        return Path(path).read_bytes()
    spark, target, fs = _hadoop(path)
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def write_bytes(path: str, data: bytes) -> None:
    """Write a document so that readers see the old one or the new one."""
    if not _remote(path):
        folder = Path(path).parent
        folder.mkdir(parents=True, exist_ok=True)
        handle, name = tempfile.mkstemp(dir=folder)
        with os.fdopen(handle, "wb") as out:
            out.write(data)
        os.replace(name, path)
        return
    spark, target, fs = _hadoop(path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.new")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    if fs.exists(target):
        fs.delete(target, False)
    fs.rename(part, target)


def create_bytes(path: str, data: bytes) -> bool:
    """Write a document that doesn't exist yet; False, and no change, where another writer was first."""
    if not _remote(path):
        folder = Path(path).parent
        folder.mkdir(parents=True, exist_ok=True)
        handle, name = tempfile.mkstemp(dir=folder, prefix=".new-")
        with os.fdopen(handle, "wb") as out:
            out.write(data)
        try:
            os.link(name, path)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(name)
    spark, target, fs = _hadoop(path)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.new")
    stream = fs.create(part, False)
    try:
        stream.write(bytearray(data))
    finally:
        stream.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(part, target, spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0))
        return True
    except Exception:
        fs.delete(part, False)
        if fs.exists(target):
            return False
        raise


def names(folder: str) -> list[str]:
    """Names of a folder's files; none where it doesn't exist."""
    if not _remote(folder):
        return sorted(p.name for p in Path(folder).iterdir() if p.is_file()) if Path(folder).is_dir() else []
    _, target, fs = _hadoop(folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isFile()) if fs.exists(target) else []


def remove(path: str) -> None:
    """Remove a document if it is there."""
    if not _remote(path):
        Path(path).unlink(missing_ok=True)
        return
    _, target, fs = _hadoop(path)
    fs.delete(target, False)


def latest(folder: str, ending: str = "") -> str | None:
    """The file of a folder that was changed last; ties go to the greater name."""
    if not _remote(folder):
        found = [(p.stat().st_mtime_ns, str(p)) for p in Path(folder).glob(f"*{ending}") if p.is_file()] if Path(folder).is_dir() else []
    else:
        _, target, fs = _hadoop(folder)
        found = [(s.getModificationTime(), s.getPath().toString()) for s in fs.listStatus(target) if s.isFile() and s.getPath().getName().endswith(ending)] if fs.exists(target) else []
    return max(found)[1] if found else None


def join(*parts: str) -> str:
    return "/".join([parts[0].rstrip("/"), *(p.strip("/") for p in parts[1:])])
