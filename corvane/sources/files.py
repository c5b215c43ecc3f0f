"""Small files through Hadoop's file system, so that a store may live wherever Spark can write."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def list(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(self._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
        finally:
            stream.close()

    def create(self, path: str, text: str, replace: bool = False) -> bool:
        """Write a file; False if it exists and isn't to be replaced."""
        fs, p = self._at(path)
        if not replace and fs.exists(p):
            return False
        try:
            stream = fs.create(p, replace)
        except Exception as e:
            if "AlreadyExists" in str(e):
                return False
            raise
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        return True

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)
