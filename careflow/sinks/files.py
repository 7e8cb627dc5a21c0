"""Folders of the file system that driver and executors share."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class Folders:
    """Looking at, removing and publishing folders, by Hadoop's file system interface."""

    def __init__(self, spark: SparkSession):
        self._context = spark.sparkContext
        self._hadoop = self._context._jvm.org.apache.hadoop.fs

    def exists(self, name: str) -> bool:
        path, files = self._at(name)
        return files.exists(path)

    def make(self, name: str) -> None:
        path, files = self._at(name)
        files.mkdirs(path)

    def children(self, name: str) -> list[str]:
        """Names of the folders in a folder, hidden ones left out; none if it does not exist."""
        path, files = self._at(name)
        if not files.exists(path):
            return []
        inside = (status.getPath().getName() for status in files.listStatus(path) if status.isDirectory())
        return sorted(child for child in inside if not child.startswith(("_", ".")))

    def remove(self, name: str) -> None:
        path, files = self._at(name)
        files.delete(path, True)

    def publish(self, staged: str, name: str) -> bool:
        """Renames a complete folder to its final name, unless there is one of that name; tells whether it did.

        The rename is one step where the file system has one, as HDFS does.
        """
        source, files = self._at(staged)
        target, _ = self._at(name)
        files.mkdirs(target.getParent())
        try:
            place = self._hadoop.FileContext.getFileContext(target.toUri(), self._context._jsc.hadoopConfiguration())
        except Py4JJavaError as missing:
            # Some file systems come without this interface; theirs is a check and a rename.
            if "UnsupportedFileSystemException" not in str(missing.java_exception):
                raise
            return not files.exists(target) and files.rename(source, target)
        never_over = self._context._gateway.new_array(getattr(self._hadoop, "Options$Rename"), 1)
        never_over[0] = getattr(self._hadoop, "Options$Rename").NONE
        try:
            place.rename(source, target, never_over)
        except Py4JJavaError as there:
            if "FileAlreadyExistsException" not in str(there.java_exception):
                raise
            return False
        return True

    def _at(self, name: str):
        path = self._hadoop.Path(name)
        return path, path.getFileSystem(self._context._jsc.hadoopConfiguration())
