"""File-system metadata operations through the Hadoop FileSystem API.

Data is always read and written with the DataFrame reader / writer. These
helpers cover the few metadata-only steps PySpark has no public call for:
small control files (table description, version files), renames (give
staged part files their ``.json`` name, move loaded files out of
``pending/``, swap a compacted partition) and dropping whole partition
folders (retention). They work on any Hadoop-compatible store the session
can reach (local, HDFS, object stores).
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    _, p, fs = _fs(spark, path)
    return fs.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small control file that is not there yet: temp file in the same folder, then rename.

    An existing file is never touched; whoever renames first wins."""
    jvm, p, fs = _fs(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    tmp = jvm.org.apache.hadoop.fs.Path(path + f".{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not fs.rename(tmp, p):
        fs.delete(tmp, False)
        raise FileExistsError(path)


def read_text(spark: SparkSession, path: str) -> str | None:
    jvm, p, fs = _fs(spark, path)
    if not fs.exists(p):
        return None
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    lines = []
    line = reader.readLine()
    while line is not None:
        lines.append(line)
        line = reader.readLine()
    reader.close()
    return "\n".join(lines)


def list_dir(spark: SparkSession, path: str) -> list[tuple[str, str, bool, int]]:
    """(full path, name, is_directory, length) of the entries of a folder."""
    _, p, fs = _fs(spark, path)
    return [(st.getPath().toString(), st.getPath().getName(), st.isDirectory(), st.getLen())
            for st in fs.listStatus(p)]


def rename(spark: SparkSession, src: str, dst: str) -> None:
    """Moves a file or folder; a store that refuses is an error, so that nothing is deleted after it."""
    jvm, p, fs = _fs(spark, src)
    if not fs.rename(p, jvm.org.apache.hadoop.fs.Path(dst)):
        raise OSError(f"could not move {src} to {dst}")


def first_line(spark: SparkSession, path: str, most: int = 1 << 16) -> str | None:
    """The first line of a file that is not blank, from its first ``most`` bytes; None where they don't hold one whole."""
    jvm, p, fs = _fs(spark, path)
    stream = fs.open(p)
    try:
        head = bytes(stream.readNBytes(most))
    finally:
        stream.close()
    lines = head.split(b"\n")
    whole = lines if len(head) < most else lines[:-1]
    return next((x.decode("utf-8", "replace") for x in whole if x.strip()), None)


def modified(spark: SparkSession, path: str) -> int:
    _, p, fs = _fs(spark, path)
    return fs.getFileStatus(p).getModificationTime()


def mkdirs(spark: SparkSession, path: str) -> None:
    _, p, fs = _fs(spark, path)
    fs.mkdirs(p)


def move_into(spark: SparkSession, files: list[str], folder: str) -> None:
    jvm, t, fs = _fs(spark, folder)
    fs.mkdirs(t)
    for f in files:
        src = jvm.org.apache.hadoop.fs.Path(f)
        if not fs.rename(src, jvm.org.apache.hadoop.fs.Path(t, src.getName())):
            raise OSError(f"could not move {f} into {folder}")


def delete(spark: SparkSession, path: str, recursive: bool = True) -> bool:
    _, p, fs = _fs(spark, path)
    return fs.delete(p, recursive)
