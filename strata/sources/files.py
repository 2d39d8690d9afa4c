"""The Hadoop file system as the session sees it: listings and small metadata files."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession) -> None:
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def children(self, path: str) -> list[tuple[str, str, int]]:
        """(path, name, size) of everything in a folder, oldest first; none when there is no folder."""
        fs, p = self._at(path)
        if not fs.exists(p):
            return []
        found = sorted((s.getModificationTime(), s.getPath().toString(), s.getPath().getName(), s.getLen())
                       for s in fs.listStatus(p))
        return [f[1:] for f in found]

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def make(self, path: str) -> None:
        fs, p = self._at(path)
        fs.mkdirs(p)

    def put(self, path: str, text: str) -> None:
        """Write a small file under another name, then rename it: it is whole or absent."""
        fs, p = self._at(path)
        _, part = self._at(f"{path}.part")
        out = fs.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        if not fs.rename(part, p):
            raise RuntimeError(f"cannot put {path} in place")

    def get(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)


def database_location(spark: SparkSession, database: str | None) -> str:
    rows = spark.sql(f"DESCRIBE DATABASE {database or 'default'}").collect()
    return next(r[1] for r in rows if r[0] == "Location").rstrip("/")
