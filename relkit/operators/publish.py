"""Versioned snapshots with optimistic commits.

A table is a folder of snapshots and a log.  Version ``n`` exists when the log
has the file ``<base>/_log/<n>.json``, which names the snapshot's folder, the
version it was made from and the folder of its changes.  The file is written
under another name and then given its own one only if no file has that name
yet (an atomic rename or link of the file system), so of two writers that
want the same version exactly one gets it, and a job that fails leaves
nothing that a reader or a later writer would take for a version.

``begin`` remembers the version that a writer reads.  ``commit`` writes the
next version; where others have committed in between, the keys that they
changed decide: if none of this writer's keys is among them, its delta is
applied to the newest snapshot and committed on top of it, else the commit is
refused with ``PublishConflict`` and nothing is changed.  Guards (the
reference's ``IF EXISTS ... RAISE EXCEPTION`` inside a transaction) are
checked on the snapshot that is about to be published.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .dml import SIGN, DmlResult
from .subqueries import any_row


class PublishConflict(RuntimeError):
    """Another writer changed a key, or replaced the table, since the version that was read."""


class GuardViolated(RuntimeError):
    """The guard of a commit found rows; nothing was published."""


# ------------------------------------------------------------- the log

def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def create_exclusive(spark: SparkSession, path: str, content: str) -> bool:
    """Write a small file whole, unless a file of that name exists; True if this call wrote it.

    The content goes to a name of its own first.  On a local file system a
    hard link gives it its final name, elsewhere a rename that does not
    overwrite; both are atomic and fail if the name is taken.
    """
    jvm = spark._jvm
    target, fs = _fs(spark, path)
    if not fs.exists(target.getParent()):
        fs.mkdirs(target.getParent())
    staged = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}-{uuid.uuid4().hex}")
    out = fs.create(staged, False)
    out.write(bytearray(content.encode("utf-8")))
    out.close()
    try:
        if fs.exists(target):
            return False
        local = fs.getScheme() == "file"
        try:
            if local:
                name = lambda p: jvm.java.nio.file.Paths.get(fs.makeQualified(p).toUri().getPath(), spark._sc._gateway.new_array(jvm.java.lang.String, 0))  # noqa: E731,E501
                jvm.java.nio.file.Files.createLink(name(target), name(staged))
                return True
            return bool(fs.rename(staged, target))
        except Exception:
            if fs.exists(target):
                return False
            raise
    finally:
        if fs.exists(staged):
            fs.delete(staged, False)


def log_versions(spark: SparkSession, folder: str) -> list[int]:
    """The numbers of the committed files of a log, ascending."""
    path, fs = _fs(spark, folder)
    if not fs.exists(path):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(path))
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def log_entry(spark: SparkSession, folder: str, version: int) -> dict:
    path, fs = _fs(spark, f"{folder}/{version:012d}.json")
    stream = fs.open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _log(base: str) -> str:
    return f"{base.rstrip('/')}/_log"


# ------------------------------------------------------------- reading

def current_version(spark: SparkSession, base: str) -> int:
    """The newest version, 0 where nothing was published."""
    return max(log_versions(spark, _log(base)), default=0)


def read_version(spark: SparkSession, base: str, version: int) -> DataFrame:
    if version not in log_versions(spark, _log(base)):
        raise FileNotFoundError(f"no published version {version} under {base}")
    return spark.read.parquet(f"{base}/{log_entry(spark, _log(base), version)['folder']}")


def read_current(spark: SparkSession, base: str) -> DataFrame:
    version = current_version(spark, base)
    if not version:
        raise FileNotFoundError(f"no published version under {base}")
    return read_version(spark, base, version)


# ------------------------------------------------------------- writing

Guard = Callable[[DataFrame], DataFrame]


@dataclass
class Transaction:
    """A writer that has read one version of a table."""

    spark: SparkSession
    base: str
    version: int

    def read(self) -> DataFrame:
        return read_version(self.spark, self.base, self.version)

    def _write(self, df: DataFrame, kind: str) -> str:
        folder = f"{kind}-{uuid.uuid4().hex[:16]}"
        df.write.mode("errorifexists").parquet(f"{self.base}/{folder}")
        return folder

    def _claim(self, version: int, folder: str, changes: str | None, keys: Sequence[str]) -> bool:
        entry = {"version": version, "read": self.version, "folder": folder, "changes": changes, "keys": list(keys)}
        return create_exclusive(self.spark, f"{_log(self.base)}/{version:012d}.json", json.dumps(entry))

    def replace(self, df: DataFrame, guard: Guard | None = None) -> int:
        """Publish ``df`` as the whole table; refused if anyone committed since the version that was read."""
        folder = self._write(df, "snapshot")
        written = self.spark.read.parquet(f"{self.base}/{folder}")
        if guard is not None and any_row(guard(written)):
            raise GuardViolated("the guard found rows")
        if current_version(self.spark, self.base) != self.version or not self._claim(self.version + 1, folder, None, ()):
            raise PublishConflict(f"the table was published after version {self.version}")
        return self.version + 1

    def commit(self, result: DmlResult, keys: Sequence[str], guard: Guard | None = None) -> int:
        """Publish the snapshot of ``result``, or its delta on top of what others committed; returns the version.

        ``keys`` identify a row of the table; a changed row must have them all.
        """
        changes = self._write(result.delta, "changes")
        delta = self.spark.read.schema(result.delta.schema).parquet(f"{self.base}/{changes}")
        if any_row(delta.where(F.exists(F.array(*[F.col(k).isNull() for k in keys]), lambda x: x))):
            raise ValueError("a changed row has no key")
        snapshot, seen = result.snapshot, self.version
        while True:
            head = current_version(self.spark, self.base)
            if head != seen:
                self._check(delta, keys, seen, head)
                seen = head
            if head != self.version:
                snapshot = self._rebased(delta, keys, head)
            folder = self._write(snapshot, "snapshot")
            written = self.spark.read.parquet(f"{self.base}/{folder}")
            if guard is not None and any_row(guard(written)):
                raise GuardViolated("the guard found rows")
            if self._claim(head + 1, folder, changes, keys):
                return head + 1

    def _check(self, delta: DataFrame, keys: Sequence[str], after: int, upto: int) -> None:
        """Refuse if a version in (after, upto] changed one of the delta's keys."""
        mine = delta.select(*keys).distinct()
        for version in range(after + 1, upto + 1):
            entry = log_entry(self.spark, _log(self.base), version)
            if entry["changes"] is None or entry["keys"] != list(keys):
                raise PublishConflict(f"version {version} replaced the table")
            theirs = self.spark.read.schema(delta.schema).parquet(f"{self.base}/{entry['changes']}").select(*keys)
            if any_row(mine.join(theirs, list(keys), "left_semi")):
                raise PublishConflict(f"version {version} changed the same keys")

    def _rebased(self, delta: DataFrame, keys: Sequence[str], head: int) -> DataFrame:
        current = read_version(self.spark, self.base, head)
        kept = current.join(delta.select(*keys).distinct(), list(keys), "left_anti").select(*current.columns)
        # A delta of several statements can hold rows that one brought and a later one took away.
        net = delta.groupBy(*current.columns).agg(F.sum(SIGN).alias(SIGN)).where(F.col(SIGN) > 0)
        return kept.unionByName(net.drop(SIGN))


def begin(spark: SparkSession, base: str) -> Transaction:
    """A transaction on the newest version (0 where there is none yet)."""
    return Transaction(spark, base, current_version(spark, base))


def publish(df: DataFrame, base: str, guard: DataFrame | None = None) -> dict:
    """Write ``df`` as the next version unless ``guard`` has any row.

    Returns ``{"published": bool, "version": int}``; when the guard fires the
    current version is unchanged.  Raises ``PublishConflict`` when another
    writer publishes meanwhile.
    """
    tx = begin(df.sparkSession, base)
    if guard is not None and any_row(guard):
        return {"published": False, "version": tx.version}
    return {"published": True, "version": tx.replace(df)}


def materialize(df: DataFrame, path: str) -> DataFrame:
    """``CREATE MATERIALIZED VIEW``: write the result, read it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
