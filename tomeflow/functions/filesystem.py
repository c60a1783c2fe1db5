"""Small files in the shared folder, through the file system that Spark itself uses: local, HDFS or an object store."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """A folder by its URI or path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark, self.path = spark, path.rstrip("/")
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):  # noqa: ANN202
        return self._spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))

    def names(self, name: str = "") -> list[str]:
        """What a sub-folder holds; nothing if it isn't there."""
        at = self._at(name)
        return sorted(x.getPath().getName() for x in self._fs.listStatus(at)) if self._fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return bytes(self._spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def add(self, name: str, text: str) -> None:
        """A new file, there at once and whole. Raises FileExistsError if another writer was first."""
        draft = self._at(f"{name}.draft-{self._spark._jvm.java.util.UUID.randomUUID()}")
        stream = self._fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        if self._fs.exists(self._at(name)) or not self._fs.rename(draft, self._at(name)):
            self._fs.delete(draft, False)
            raise FileExistsError(f"{self.path}/{name}")

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)
