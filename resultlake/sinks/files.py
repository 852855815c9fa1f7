"""Files on whatever file system a path names, through Spark's own Hadoop client."""

from __future__ import annotations

import os
import shutil
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def first_bytes(spark: SparkSession, path: str, count: int) -> bytes:
    """Leading bytes of a file; empty for a folder or a short file."""
    system, where = _open(spark, path)
    if not system.exists(where) or not system.getFileStatus(where).isFile():
        return b""
    stream = system.open(where)
    try:
        found = (stream.read() for _ in range(count))
        return bytes(b for b in found if b >= 0)
    finally:
        stream.close()


def qualified(spark: SparkSession, path: str) -> str:
    """Absolute form of a path; a local one without its scheme."""
    system, where = _open(spark, path)
    text = system.makeQualified(where).toString()
    return text.removeprefix("file:") if text.startswith("file:/") else text


def is_local(spark: SparkSession, path: str) -> bool:
    """Whether a path is on the file system of the machine it is used on."""
    system, where = _open(spark, path)
    return system.makeQualified(where).toUri().getScheme() == "file"


def ensure_folder(spark: SparkSession, path: str) -> None:
    system, where = _open(spark, path)
    system.mkdirs(where)


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _open(spark, path)
    return system.exists(where)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    system, where = _open(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file that is there as a whole or not at all."""
    system, where = _open(spark, path)
    draft = where.suffix(f".{uuid.uuid4().hex}.draft")
    system.mkdirs(where.getParent())
    stream = system.create(draft, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    if system.exists(where) or not system.rename(draft, where):
        system.delete(draft, False)
        raise OSError(f"{path} is there already or cannot be written")


def read_text(spark: SparkSession, path: str) -> str:
    system, where = _open(spark, path)
    stream = system.open(where)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace(spark: SparkSession, draft: str, target: str) -> None:
    """Put ``draft`` in the place of ``target``, whose former content stays readable
    until the last step and is put back if that fails."""
    system, goal = _open(spark, target)
    new, former = _open(spark, draft)[1], goal.suffix(f".{uuid.uuid4().hex}.former")
    had = system.exists(goal)
    if had and not system.rename(goal, former):
        raise OSError(f"cannot move {target} away")
    if not system.rename(new, goal):
        if had:
            system.rename(former, goal)
        raise OSError(f"cannot move {draft} to {target}")
    if had:
        system.delete(former, True)


def remove(spark: SparkSession, path: str) -> None:
    system, where = _open(spark, path)
    system.delete(where, True)


def replace_with_only_part(spark: SparkSession, folder: str, target: str) -> None:
    """Make the one part file of ``folder`` the file ``target``; drop the folder."""
    system, where = _open(spark, folder)
    parts = [s.getPath() for s in system.listStatus(where) if s.getPath().getName().startswith("part-")]
    if len(parts) != 1:
        raise OSError(f"{folder} has {len(parts)} part files")
    replace(spark, parts[0].toString(), target)
    # The local file system keeps a checksum beside each file.
    system.delete(where, True)


def join_parts(spark: SparkSession, folders: list[str], target: str) -> None:
    """The part files of local ``folders``, in order, as one file: a task copies a part to
    its place."""
    parts, size = [], 0
    for folder in folders:
        system, where = _open(spark, folder)
        found = [s for s in system.listStatus(where) if s.getPath().getName().startswith("part-")]
        for status in sorted(found, key=lambda s: s.getPath().getName()):
            if status.getLen():
                parts.append((status.getPath().toUri().getPath(), size))
                size += status.getLen()
    whole = _open(spark, target)[1].toUri().getPath()
    with open(whole, "wb") as made:
        made.truncate(size)

    def copy(part):
        source, at = part
        with open(source, "rb") as old, open(whole, "r+b") as new:
            new.seek(at)
            shutil.copyfileobj(old, new, 1 << 20)

    spark.sparkContext.parallelize(parts, max(1, len(parts))).foreach(copy)
    if os.path.getsize(whole) != size:
        raise OSError(f"{target} is not whole")
