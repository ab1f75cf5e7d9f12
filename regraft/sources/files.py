"""The few file operations needed, through Hadoop's file system: on any store that Spark reads."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


class Files:
    """Files and folders below a root, by their names there; an empty name is the root."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        context = spark.sparkContext
        self._jvm = context._jvm
        self._system = self._place("").getFileSystem(context._jsc.hadoopConfiguration())

    def _place(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, folder: str = "") -> list[str]:
        place = self._place(folder)
        return sorted(s.getPath().getName() for s in self._system.listStatus(place)) if self._system.exists(place) else []

    def exists(self, name: str) -> bool:
        return self._system.exists(self._place(name))

    def read(self, name: str) -> str:
        stream = self._system.open(self._place(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def rename(self, before: str, after: str) -> None:
        """Hadoop says by its result that nothing was renamed; here that raises."""
        if not self.exists(before) or not self._system.rename(self._place(before), self._place(after)):
            raise OSError(f"{before} could not be renamed to {after} below {self.root}")

    def remove(self, name: str) -> None:
        self._system.delete(self._place(name), True)

    def _beside(self, name: str, text: str) -> str:
        beside = f"{name}-{uuid.uuid4().hex}"
        stream = self._system.create(self._place(beside), False)
        stream.write(bytearray(text.encode()))
        stream.close()
        return beside

    def create(self, name: str, text: str) -> bool:
        """Makes a file that isn't there yet; False if it is. It appears under its name when it is whole."""
        if self.exists(name):
            return False
        beside = self._beside(name, text)
        try:
            self.rename(beside, name)
        except OSError:
            self.remove(beside)
            return False
        return True

    def put(self, name: str, text: str) -> None:
        """Makes a file or makes it anew."""
        beside = self._beside(name, text)
        self.remove(name)
        self.rename(beside, name)
