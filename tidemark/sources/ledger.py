"""Versions issued so far, kept as empty pointer files instead of being looked up in the tables.

Versions are handed out in blocks of a fixed size: ``block-k`` stands for the versions k * block + 1 ... (k + 1) * block
and is claimed by creating it, which only one writer can do where the file system's create is exclusive (HDFS is;
on one whose is not, publish one table at a time).  ``closed-a-b`` says that nothing more will be written with the
versions of blocks a to b.  Reading a bound is one folder listing, however large the tables are.

Gaps are fine: a claim uses up whole blocks, and blocks lost to another writer in the middle of one are closed unused.
"""
from __future__ import annotations

from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from .fs import HadoopFs


class VersionLedger:
    def __init__(self, spark: SparkSession, root: str, block: int = 1 << 20):
        """``block`` must be the same for all users of a folder; a claim of n versions makes n / block files."""
        if block < 1:
            raise ValueError("a block holds at least one version")
        self.block = block
        self.files = HadoopFs(spark, root)

    def _names(self):
        claimed, closed = set(), []
        for name in self.files.list_names():
            kind, *numbers = name.split("-")
            if kind == "block":
                claimed.add(int(numbers[0]))
            elif kind == "closed":
                closed.append((int(numbers[0]), int(numbers[1])))
        return claimed, sorted(closed)

    def _create(self, name: str) -> bool:
        path = self.files.path(name)
        try:
            self.files.fs.create(path, False).close()
        except Py4JJavaError:
            if not self.files.fs.exists(path):
                raise
            return False
        return True

    def _close(self, first: int, last: int) -> None:
        self._create(f"closed-{first:012d}-{last:012d}")

    def issue(self, n: int) -> int:
        """Claim ``n`` versions; they are base + 1 ... base + n of the returned base.  ``n`` of 0 claims nothing."""
        claimed, _ = self._names()
        first = max(claimed, default=-1) + 1
        need, k = -(-n // self.block), first
        while k < first + need:
            if not self._create(f"block-{k:012d}"):
                if k > first:
                    self._close(first, k - 1)
                first = k + 1
            k += 1
        return first * self.block

    def close(self, base: int, n: int) -> None:
        """Nothing more will be written with the ``n`` versions claimed above ``base``."""
        if n > 0:
            self._close(base // self.block, base // self.block + -(-n // self.block) - 1)

    @contextmanager
    def versions(self, n: int):
        """The base of ``n`` claimed versions, closed at the end, also after an error (what failed is not published)."""
        base = self.issue(n)
        try:
            yield base
        finally:
            self.close(base, n)

    def issued(self) -> int:
        """Highest version that any writer may hold."""
        claimed, _ = self._names()
        return (max(claimed, default=-1) + 1) * self.block

    def safe(self) -> int:
        """Highest version below which no writer is still at work: the bound up to which readers may go.

        A run that stops here can never skip a version that appears later.  A writer that died keeps its block open
        and the bound below it, until ``close`` is called for it.
        """
        _, closed = self._names()
        end = 0
        for first, last in closed:
            if first > end:
                break
            end = max(end, last + 1)
        return end * self.block
