"""A folder that changes as a whole: tables are written into a new generation, then one pointer is set.

Layout of ``path``: ``gen-<id>/`` folders, and ``_current/<number>`` files whose text is the name of a
generation. The highest number is current. A pointer is written under another name and renamed, so it is
either there with its text or not there; a number can be taken only once, so of two builds that end at the
same time the later one fails and leaves the folder as the other made it. A build that dies before that
leaves a generation that no pointer names; readers never see it, and a later one removes it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _fs(spark: SparkSession, path: str):
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark._jsc.hadoopConfiguration()), hpath


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, hpath = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(hpath)] if fs.exists(hpath) else []


def tables_in(spark: SparkSession, folder: str) -> list[str]:
    return sorted(n for n in _names(spark, folder) if not n.startswith(("_", ".")))


class Generations:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _numbers(self) -> list[int]:
        return sorted(int(n) for n in _names(self.spark, f"{self.path}/_current") if n.isdigit())

    def _named(self, number: int) -> str:
        fs, hpath = _fs(self.spark, f"{self.path}/_current/{number:012d}")
        stream = fs.open(hpath)
        try:
            return str(self.spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream), "utf-8")
        finally:
            stream.close()

    def current(self) -> str | None:
        """The folder of the current generation; none before the first commit."""
        numbers = self._numbers()
        return f"{self.path}/{self._named(numbers[-1])}" if numbers else None

    def begin(self) -> "Generation":
        """A new generation, and the pointer number it will take."""
        numbers = self._numbers()
        return Generation(self, f"gen-{uuid.uuid4().hex}", (numbers[-1] if numbers else 0) + 1)

    def point(self, name: str, number: int) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        fs, part = _fs(self.spark, f"{self.path}/_current/.{uuid.uuid4().hex}")
        out = fs.create(part, False)
        try:
            out.write(bytearray(name.encode()))
        finally:
            out.close()
        target = jvm.org.apache.hadoop.fs.Path(f"{self.path}/_current/{number:012d}")
        options = self.spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
        # Unlike the file system's own rename this one fails everywhere if the target is there.
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(
            fs.makeQualified(part), fs.makeQualified(target), options)

    def prune(self, keep: int = 2) -> None:
        """Remove all but the last ``keep`` generations (a reader may still be in the one before). A generation
        that is being written for a number to come has no pointer and is removed too: one build at a time."""
        numbers = self._numbers()
        kept = {self._named(n) for n in numbers[-keep:]}
        for name in _names(self.spark, self.path):
            if name.startswith("gen-") and name not in kept:
                fs, hpath = _fs(self.spark, f"{self.path}/{name}")
                fs.delete(hpath, True)
        for n in numbers[:-keep]:
            fs, hpath = _fs(self.spark, f"{self.path}/_current/{n:012d}")
            fs.delete(hpath, False)


class Generation:
    """A generation being written: ``write`` tables, then ``commit``. As a context it commits at the end of the
    block, unless the block fails."""

    def __init__(self, home: Generations, name: str, number: int):
        self.home, self.name, self.number = home, name, number
        self.folder = f"{home.path}/{name}"

    def write(self, table: str, df: DataFrame, partition_by: list[str] | None = None) -> str:
        path = f"{self.folder}/{table}"
        writer = df.write
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        return path

    def commit(self) -> None:
        self.home.point(self.name, self.number)

    def __enter__(self) -> "Generation":
        return self

    def __exit__(self, kind, value, trace) -> None:
        if kind is None:
            self.commit()
            self.home.prune()
