"""Names and first lines of files, through the file system Spark itself uses. Metadata only; data stays in scans."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession


def filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, hadoop_path = filesystem(spark, path)
    return fs.getContentSummary(hadoop_path).getLength()


def list_files(spark: SparkSession, folder: str, suffixes: tuple[str, ...]) -> list[str]:
    """All files below ``folder`` with one of the suffixes, sorted; none when the folder is missing."""
    fs, path = filesystem(spark, folder)
    if not fs.exists(path):
        return []
    found = []
    entries = fs.listFiles(path, True)
    while entries.hasNext():
        entry = entries.next()
        if entry.getLen() > 0 and entry.getPath().getName().endswith(suffixes):
            found.append(entry.getPath().toString())
    return sorted(found)


def first_lines(spark: SparkSession, paths: list[str], threads: int = 16) -> list[str]:
    """The first line of each file, by one short read per file."""
    jvm = spark.sparkContext._jvm

    def read(path: str) -> str:
        fs, hadoop_path = filesystem(spark, path)
        stream = fs.open(hadoop_path)
        try:
            return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8")).readLine() or ""
        finally:
            stream.close()

    with ThreadPoolExecutor(threads) as pool:
        return list(pool.map(read, paths))
