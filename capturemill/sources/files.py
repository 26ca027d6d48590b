"""Names and small files on whatever file system a path's scheme names, through the session's Hadoop configuration.

Payloads are read, hashed and written by Spark; what goes through here is names, renames and manifests of a few kilobytes.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Files:
    """File operations that the session's Hadoop file systems offer."""

    def __init__(self, spark: SparkSession):
        self.jvm, self.conf, self.gateway = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._gateway

    def _at(self, path: str):
        at = self.jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.conf)

    def exists(self, path: str) -> bool:
        at, fs = self._at(path)
        return fs.exists(at)

    def names(self, pattern: str) -> list[str]:
        """Paths that match a pattern, in order; none if its folder is absent. For manifests and parts, whose number is that of units."""
        at, fs = self._at(pattern)
        return sorted(s.getPath().toString() for s in fs.globStatus(at) or ())

    def count(self, pattern: str) -> int:
        """How many paths match a pattern; files without bytes, which Spark's readers pass over, are among them."""
        at, fs = self._at(pattern)
        return len(fs.globStatus(at) or ())

    def count_below(self, path: str) -> int:
        """How many files lie below a path, whatever their names and sizes."""
        at, fs = self._at(path)
        return fs.getContentSummary(at).getFileCount()

    def qualified(self, path: str) -> str:
        """The path with its scheme, as Spark gives it in ``_metadata.file_path``."""
        at, fs = self._at(path)
        return fs.makeQualified(at).toString()

    def delete(self, path: str) -> None:
        at, fs = self._at(path)
        fs.delete(at, True)

    def read(self, path: str) -> str:
        at, fs = self._at(path)
        stream = fs.open(at)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str, replace: bool = False) -> None:
        """A small file, whole or not at all. Without ``replace`` it must be new: of several writers one wins, the others get ``FileExistsError``."""
        at, fs = self._at(path)
        new = self.jvm.org.apache.hadoop.fs.Path(at.getParent(), f".{uuid.uuid4().hex}")
        stream = fs.create(new, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        rename = self.jvm.org.apache.hadoop.fs.Options.Rename
        how = self.gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE if replace else rename.NONE
        try:
            self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), self.conf).rename(fs.makeQualified(new), fs.makeQualified(at), how)
        except Py4JJavaError as e:
            fs.delete(new, False)
            if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
                raise FileExistsError(path) from None
            raise

    def move(self, old: str, new: str) -> None:
        """A rename within one file system; what is there already stays and fails it."""
        at, fs = self._at(old)
        to = self.jvm.org.apache.hadoop.fs.Path(new)
        if fs.exists(to):
            raise FileExistsError(new)
        fs.mkdirs(to.getParent())
        if not fs.rename(at, to):
            raise OSError(f"{old} can't be moved to {new}")


def listing(spark: SparkSession, root: str, name: str = "payload.json") -> DataFrame:
    """``path, length, modified`` of the files of a name below ``root``, at any depth; their bytes aren't read. No rows where ``root`` is absent."""
    if not Files(spark).exists(root):
        return spark.createDataFrame([], "path string, length long, modified timestamp")
    found = spark.read.format("binaryFile").option("pathGlobFilter", name).option("recursiveFileLookup", True).load(root)
    return found.select("path", "length", F.col("modificationTime").alias("modified"))
