"""Folders and small files of any file system that Spark reaches."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    """The file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._system = self._path(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def matching(self, pattern: str) -> list[str]:
        """Paths that fit a glob pattern; names are listed, no file is read."""
        return [s.getPath().toString() for s in self._system.globStatus(self._path(pattern)) or ()]

    def exists(self, path: str) -> bool:
        return self._system.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._system.delete(self._path(path), True)

    def move(self, source: str, target: str) -> None:
        """Renames a file or folder; the target must not exist."""
        self._system.mkdirs(self._path(target).getParent())
        if self.exists(target) or not self._system.rename(self._path(source), self._path(target)):
            raise OSError(f"{source} was not moved to {target}")

    def write_text(self, path: str, text: str) -> None:
        """Writes a small file whole: it appears under its name only when it is complete."""
        draft = f"{path}.draft"
        out = self._system.create(self._path(draft), True)
        try:
            out.write(text.encode())
        finally:
            out.close()
        self.move(draft, path)
