"""Files of whatever store Spark's paths name, by Hadoop's file systems: for a job's own few marks, never for rows."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, files = _at(spark, path)
    return files.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p, files = _at(spark, path)
    files.delete(p, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Moves a file or folder to a place where none is, in one step of the store."""
    p, files = _at(spark, path)
    q, _ = _at(spark, to)
    files.mkdirs(q.getParent())
    if files.exists(q) or not files.rename(p, q):
        raise FileExistsError(to)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it isn't there."""
    p, files = _at(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(p)) if files.exists(p) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """What a small file says; None if it isn't there."""
    p, files = _at(spark, path)
    if not files.exists(p):
        return None
    stream = files.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, in place of what is there; readers see the old one or the new one."""
    aside = f"{path.rsplit('/', 1)[0]}/.{path.rsplit('/', 1)[1]}-new"
    p, files = _at(spark, aside)
    stream = files.create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    q, _ = _at(spark, path)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri() if p.toUri().getScheme() else files.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    overwrite = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = spark._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(files.makeQualified(p), files.makeQualified(q), overwrite)
