"""Small file-system calls on whatever file system a path names (Hadoop's interface)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return bool(fs.exists(p))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``, sorted; none if it does not exist."""
    fs, p = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def count_files(spark: SparkSession, path: str) -> int:
    """Number of data files below ``path``; only the count comes to the driver."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return 0
    done = fs.exists(_at(spark, f"{path.rstrip('/')}/_SUCCESS")[1])
    return int(fs.getContentSummary(p).getFileCount()) - bool(done)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Make the folder, and have it removed when the driver's JVM ends."""
    fs, p = _at(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a hidden name, then rename it, so readers see all of it or nothing."""
    head, _, name = path.rpartition("/")
    fs, hidden = _at(spark, f"{head}/.{name}.tmp")
    out = fs.create(hidden, True)
    out.write(bytearray(text.encode()))
    out.close()
    target = _at(spark, path)[1]
    if fs.exists(target):
        fs.delete(target, False)
    if not fs.rename(hidden, target):
        raise OSError(f"cannot write {path}")


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _at(spark, path)
    size = int(fs.getFileStatus(p).getLen())
    stream = fs.open(p)
    try:
        return bytes(stream.readNBytes(size)).decode()
    finally:
        stream.close()
