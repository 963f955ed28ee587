"""File-system questions asked through Spark's own Hadoop layer."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _path(spark, path)
    return fs.exists(hadoop)


def is_file(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _path(spark, path)
    return fs.exists(hadoop) and fs.getFileStatus(hadoop).isFile()


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under a path; none if it is absent."""
    fs, hadoop = _path(spark, path)
    if not fs.exists(hadoop):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop) if status.isDirectory())


def has_data_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds a file that is not a marker."""
    fs, hadoop = _path(spark, path)
    if not fs.exists(hadoop):
        return False
    return any(status.isFile() and not status.getPath().getName().startswith(("_", "."))
               for status in fs.listStatus(hadoop))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of a file."""
    fs, hadoop = _path(spark, path)
    return fs.getFileStatus(hadoop).getLen()


def join_parts(spark: SparkSession, folder: str, target: str, head: str, tail: str, skip: int) -> None:
    """Data files of a folder, in order of their names, as one file between two texts.

    ``skip`` bytes at the begin of all are left out. A file has one writer, so
    bytes go through one buffer, as they are.
    """
    io, buffer = spark._jvm.org.apache.hadoop.io.IOUtils, 4 << 20
    fs, hadoop = _path(spark, folder)
    found = sorted((status for status in fs.listStatus(hadoop)
                    if status.getLen() and not status.getPath().getName().startswith(("_", "."))),
                   key=lambda status: status.getPath().getName())
    out_fs, out_path = _path(spark, target)
    out = out_fs.create(out_path, False)
    try:
        out.write(bytearray(head.encode()))
        for number, status in enumerate(found):
            part = fs.open(status.getPath())
            try:
                part.seek(0 if number else skip)
                io.copyBytes(part, out, buffer, False)
            finally:
                part.close()
        out.write(bytearray(tail.encode()))
    finally:
        out.close()


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Moves a file or folder to a path where there is none yet."""
    fs, hadoop = _path(spark, target)
    fs.mkdirs(hadoop.getParent())
    if fs.exists(hadoop) or not fs.rename(_path(spark, source)[1], hadoop):
        raise OSError(f"Cannot move {source} to {target}")


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = _path(spark, path)
    fs.delete(hadoop, True)


def replace_folder(spark: SparkSession, staged: str, target: str) -> None:
    """Puts a finished folder in the place of another; that one comes back if the move fails."""
    parent, name = target.rstrip("/").rsplit("/", 1)
    old = f"{parent}/_{name}-replaced"
    there = exists(spark, target)
    if there:
        delete(spark, old)
        rename(spark, target, old)
    try:
        rename(spark, staged, target)
    except Exception:
        if there:
            rename(spark, old, target)
        raise
    if there:
        delete(spark, old)
