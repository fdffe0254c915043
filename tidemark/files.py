"""Small files and renames on whatever file system Spark uses."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

#: Object stores that copy where they are told to rename.
NO_RENAME = {"s3", "s3a", "s3n", "gs", "oss", "wasb", "wasbs"}


class Files:
    def __init__(self, spark: SparkSession):
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def size(self, path: str) -> int:
        """Bytes of all files below."""
        fs, p = self._at(path)
        return fs.getContentSummary(p).getLength()

    def write_text(self, path: str, text: str) -> None:
        """Written beside and renamed, so a reader sees the old text or the new."""
        fs, p = self._at(path)
        fs.mkdirs(p.getParent())
        beside = self.jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.new")
        out = fs.create(beside, True)
        out.write(bytearray(text.encode()))
        out.close()
        self._rename(beside, p, "OVERWRITE")

    def _rename(self, a, b, option: str) -> None:
        scheme = (a.toUri().getScheme() or "").lower()
        if scheme in NO_RENAME:
            raise OSError(f"{scheme} has no atomic rename: keep tables and topics on a file system that has")
        ctx = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(b.toUri(), self.conf)
        kind = self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename")
        options = self.jvm.java.lang.reflect.Array.newInstance(kind, 1)
        options[0] = getattr(self.jvm.org.apache.hadoop.fs.Options.Rename, option)
        ctx.rename(ctx.makeQualified(a), ctx.makeQualified(b), options)

    def read_text(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def rename(self, a: str, b: str) -> bool:
        """Moves a to b; False, and nothing moved, if b exists."""
        fs, p = self._at(a)
        q = self.jvm.org.apache.hadoop.fs.Path(b)
        fs.mkdirs(q.getParent())
        try:
            self._rename(p, q, "NONE")
        except Py4JJavaError as e:
            if "AlreadyExists" in e.java_exception.getClass().getName() or fs.exists(q):  # a folder that came between the check and the move
                return False
            raise
        return True

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)
