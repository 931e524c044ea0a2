"""Small files on whatever file system the cluster uses (local, NFS, HDFS, ...), through Hadoop's own client."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm, self._gateway = spark._jvm, spark.sparkContext._gateway
        self._conf = spark._jsc.hadoopConfiguration()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def _fs(self, path: str):
        return self._path(path).getFileSystem(self._conf)

    def exists(self, path: str) -> bool:
        return self._fs(path).exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """The entries of a folder, none if it is not there."""
        if not self.exists(path):
            return []
        return sorted(x.getPath().getName() for x in self._fs(path).listStatus(self._path(path)))

    def read(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        stream = self._fs(path).open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """Write a file so that readers see the old or the new content: written beside it, then renamed over it."""
        beside = f"{path}.new"
        stream = self._fs(path).create(self._path(beside), True)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        over = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        over[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs(path).getUri(), self._conf)
        context.rename(context.makeQualified(self._path(beside)), context.makeQualified(self._path(path)), over)

    def delete(self, path: str) -> None:
        self._fs(path).delete(self._path(path), True)
