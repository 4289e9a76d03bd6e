"""File-system steps that a load needs besides Spark's readers and writers.

Everything goes through the Hadoop FileSystem API, so it works on the store the
tables are in. Existence is asked of the file system, never concluded from a
failed read: an unreadable table raises.
"""

from __future__ import annotations

from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` (none if it does not exist)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def holds_data(spark: SparkSession, path: str) -> bool:
    """Whether a table folder exists and holds anything but hidden files."""
    fs, p = _fs(spark, path)
    return fs.exists(p) and any(s.getPath().getName()[0] not in "._" for s in fs.listStatus(p))


def move(spark: SparkSession, source: str, target: str) -> None:
    """Renames a file or folder; the target must not exist."""
    fs, src = _fs(spark, source)
    _, dst = _fs(spark, target)
    fs.mkdirs(dst.getParent())
    if fs.exists(dst) or not fs.rename(src, dst):
        raise OSError(f"cannot rename {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file, None if there is none."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file beside the old one, then renames it over in one step."""
    fs, p = _fs(spark, path + ".new")
    fs.mkdirs(p.getParent())
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm = spark._jvm.org.apache.hadoop.fs
    over = spark.sparkContext._gateway.new_array(jvm.Options.Rename, 1)
    over[0] = jvm.Options.Rename.OVERWRITE
    context = jvm.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    context.rename(p, jvm.Path(path), over)
