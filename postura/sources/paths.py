"""Questions about paths, answered by the Hadoop file system of the path's scheme.

The same code serves local folders, HDFS and object stores (``s3a://`` and the
like), so a table's location is only ever a URI.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Suffixes that compression adds to a data file's name.
COMPRESSED = ("gz", "snappy", "zst", "zstd", "lz4", "bz2", "deflate", "c000")


# Folders listed at the same time.
LISTINGS = 16


def _conf(spark: SparkSession):
    return spark._jsparkSession.sessionState().newHadoopConf()


def _at(spark: SparkSession, location: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    return path, path.getFileSystem(_conf(spark))


def _hidden(name: str) -> bool:
    return name.startswith(("_", "."))


def has_files(spark: SparkSession, location: str) -> bool:
    """Whether any data file lies at or below ``location`` (which may be a glob).

    The listing is a remote iterator and stops at the first hit, so the answer
    does not cost a walk over a large table.
    """
    path, fs = _at(spark, location)
    for status in fs.globStatus(path) or []:
        files = fs.listFiles(status.getPath(), True)
        while files.hasNext():
            if not _hidden(files.next().getPath().getName()):
                return True
    return False


def data_suffixes(spark: SparkSession, location: str) -> set[str]:
    """The last name suffixes of the data files at or below ``location``, without compression's."""
    path, fs = _at(spark, location)
    found = set()
    for status in fs.globStatus(path) or []:
        files = fs.listFiles(status.getPath(), True)
        while files.hasNext():
            name = files.next().getPath().getName()
            if not _hidden(name):
                parts = [p for p in name.lower().split(".")[1:] if p not in COMPRESSED]
                found.add(parts[-1] if parts else "")
    return found


def names(spark: SparkSession, location: str) -> list[str]:
    """What lies directly below a folder; nothing if it is absent."""
    path, fs = _at(spark, location)
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path))


def partition_names(spark: SparkSession, location: str, depth: int) -> list[str]:
    """The partition folders ``depth`` levels below ``location``, as relative paths."""
    found = [""]
    with ThreadPoolExecutor(LISTINGS) as pool:
        for _ in range(depth):
            below = pool.map(lambda above: names(spark, f"{location}/{above}" if above else location), found)
            found = [
                f"{above}/{n}" if above else n
                for above, listed in zip(found, below, strict=True)
                for n in listed
                if "=" in n
            ]
    return found


def read_text(spark: SparkSession, location: str) -> str:
    path, fs = _at(spark, location)
    try:
        stream = fs.open(path)
    except Py4JJavaError as e:
        if "FileNotFoundException" in str(e.java_exception):
            raise FileNotFoundError(location) from e
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, location: str, text: str) -> None:
    """A new small file."""
    path, fs = _at(spark, location)
    stream = fs.create(path, False)
    stream.write(bytearray(text.encode()))
    stream.close()


def rename_new(spark: SparkSession, source: str, target: str) -> bool:
    """Give a file a name that no file has, in one step; false if one has it."""
    fs = spark._jvm.org.apache.hadoop.fs
    old, new = fs.Path(source), fs.Path(target)
    context = fs.FileContext.getFileContext(old.getFileSystem(_conf(spark)).getUri(), _conf(spark))
    plain = spark.sparkContext._gateway.new_array(getattr(fs, "Options$Rename"), 0)
    try:
        context.rename(old, new, plain)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    return True


def delete(spark: SparkSession, location: str) -> None:
    """Remove ``location`` and what lies below it."""
    path, fs = _at(spark, location)
    fs.delete(path, True)
