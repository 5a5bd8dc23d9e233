"""The few file-system calls the stores make, on Spark's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str):
    """The path and its file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def entries(spark: SparkSession, folder: str) -> list[str]:
    """Sorted names directly inside ``folder``; none where it does not exist."""
    p, fs = hadoop_path(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = hadoop_path(spark, path)
    return bool(fs.exists(p))


def remove(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        p, fs = hadoop_path(spark, path)
        fs.delete(p, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Rename to a path that does not exist; anything else raises."""
    p, fs = hadoop_path(spark, old)
    q, _ = hadoop_path(spark, new)
    fs.mkdirs(q.getParent())
    if fs.exists(q) or not fs.rename(p, q):
        raise FileExistsError(f"{old} cannot become {new}")


def read_text(spark: SparkSession, path: str) -> str:
    """A small file as text."""
    p, fs = hadoop_path(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str = "") -> None:
    """Create or replace a small file."""
    p, fs = hadoop_path(spark, path)
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def create_exclusive(spark: SparkSession, path: str, text: str = "") -> bool:
    """Create a small file unless it exists; True for the one caller who did.

    HDFS creates exclusively by itself; for local folders the operating
    system's own exclusive creation is used, as Hadoop's local file system
    tests and then writes."""
    p, fs = hadoop_path(spark, path)
    gateway, jvm = spark.sparkContext._gateway, spark.sparkContext._jvm
    fs.mkdirs(p.getParent())
    try:
        if fs.getUri().getScheme() == "file":
            options = gateway.new_array(jvm.java.nio.file.OpenOption, 2)
            options[0], options[1] = jvm.java.nio.file.StandardOpenOption.CREATE_NEW, jvm.java.nio.file.StandardOpenOption.WRITE
            at = jvm.java.nio.file.Path.of(p.toUri().getPath(), gateway.new_array(jvm.java.lang.String, 0))
            jvm.java.nio.file.Files.write(at, bytearray(text.encode()), options)
        else:
            out = fs.create(p, False)
            out.write(bytearray(text.encode()))
            out.close()
    except Exception as error:  # noqa: BLE001 - py4j wraps every Java exception alike
        if "AlreadyExists" in str(error):
            return False
        raise
    return True
