"""Small-file helpers over the session's Hadoop file system (local, HDFS or object store alike).

Used for metadata only: manifests, existence checks and file lengths — never for rows.
"""
from __future__ import annotations

from pyspark.sql import SparkSession


class HadoopFs:
    def __init__(self, spark: SparkSession, root: str):
        self.jvm = spark._jvm
        self.conf = spark._jsc.hadoopConfiguration()
        self.root = self.jvm.org.apache.hadoop.fs.Path(root)
        self.fs = self.root.getFileSystem(self.conf)

    def path(self, *parts):
        p = self.root
        for x in parts:
            p = self.jvm.org.apache.hadoop.fs.Path(p, x)
        return p

    def exists(self, *parts) -> bool:
        return bool(self.fs.exists(self.path(*parts)))

    def list_names(self, *parts) -> list:
        p = self.path(*parts)
        if not self.fs.exists(p):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(p)]

    def write_text(self, text: str, *parts) -> None:
        """Write to a hidden temporary name, then rename into place (atomic on HDFS and local file systems)."""
        final = self.path(*parts)
        tmp = self.jvm.org.apache.hadoop.fs.Path(final.getParent(), "." + final.getName() + ".tmp")
        out = self.fs.create(tmp, True)
        out.write(bytearray(text.encode("utf-8")))
        out.close()
        if not self.fs.rename(tmp, final):
            self.fs.delete(tmp, False)
            raise IOError(f"could not publish {final}")

    def read_text(self, *parts) -> str:
        stream = self.fs.open(self.path(*parts))
        reader = self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(stream, "UTF-8"))
        lines = []
        line = reader.readLine()
        while line is not None:
            lines.append(line)
            line = reader.readLine()
        reader.close()
        return "\n".join(lines)


def file_length(spark: SparkSession, path: str) -> int:
    fs = HadoopFs(spark, path)
    return int(fs.fs.getFileStatus(fs.root).getLen())


def folder_kbs(spark: SparkSession, path: str) -> int:
    """Bytes under a folder in KB, from one recursive content summary (no per-file calls from the driver)."""
    fs = HadoopFs(spark, path)
    if not fs.fs.exists(fs.root):
        return 0
    return (int(fs.fs.getContentSummary(fs.root).getLength()) + 1023) // 1024
