"""A target table that knows its keys, for incremental copies.

Rows lie in hash buckets of their key (``data/_b=<bucket>/_e=<commit>``), and
every bucket has a Bloom filter of its keys (``filters/_b=<bucket>/_e=<commit>``,
the newest one holds all earlier keys).  A batch reads the filters of the
buckets that it touches; keys that the filter does not know are new, and only
for the others the key columns of their buckets are read and compared.  So a
batch of new keys reads nothing of the table, however large that is, and one
with known keys reads the buckets that they are in.

A commit exists when its file is in the log (created whole or not at all, see
``operators.publish``); readers pass over rows of commits that are not.  The
log also keeps, per stream, the last micro-batch that was copied, so a replay
of a committed batch does nothing, and one of a batch that failed half-way
starts from the state before it.  One writer at a time may append.

A row whose key has a NULL is never a duplicate of another.  To tell it from
its own replay (also under a new streaming checkpoint) it is known by its
origin: the file it came from, its content, and its number among equal rows
of that file.

Choose ``buckets`` so that one holds what a task can read (a million keys,
say), and ``filter_bits`` at about ten per key of a bucket.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.publish import create_exclusive, log_entry, log_versions
from ..operators.windows import distinct_on

_PROBES = 4
_INTERNAL = ("_b", "_e", "_origin")


def _positions(key_hash: Column, bits: int) -> Column:
    """The filter bits of a key: steps of one half of its hash from the other."""
    high, low = F.shiftrightunsigned(key_hash, 32), key_hash.bitwiseAND(F.lit(0xFFFFFFFF)).bitwiseOR(F.lit(1))
    return F.array(*[F.pmod(high + F.lit(k) * low, F.lit(bits)) for k in range(_PROBES)])


class IndexedTarget:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], buckets: int = 64,
                 filter_bits: int = 1 << 16) -> None:
        if filter_bits % 64 or set(_INTERNAL) & set(schema.names):
            raise ValueError("filter_bits is a multiple of 64, and columns are not named " + ", ".join(_INTERNAL))
        self.spark, self.path, self.schema, self.keys = spark, path.rstrip("/"), schema, list(keys)
        self.buckets, self.bits = buckets, filter_bits

    # ---------------------------------------------------------- files

    def _files(self, folder: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _bytes(self, folders: Sequence[str]) -> int:
        total = 0
        for folder in folders:
            p, fs = self._files(folder)
            total += fs.getContentSummary(p).getLength()
        return total

    def _head(self) -> tuple[int, dict]:
        """The last commit's number (-1: none) and entry."""
        log = f"{self.path}/_log"
        n = max(log_versions(self.spark, log), default=-1)
        return n, log_entry(self.spark, log, n) if n >= 0 else {"streams": {}, "filters": {}, "made": [self.buckets, self.bits]}

    # -------------------------------------------------------- reading

    def _data(self, folders: Sequence[str], upto: int) -> DataFrame:
        schema = StructType(list(self.schema.fields)).add("_origin", "string").add("_b", "integer").add("_e", "integer")
        df = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*folders)
        return df.where(F.col("_e") <= upto)

    def read(self) -> DataFrame:
        """The committed rows."""
        n, entry = self._head()
        if not entry["filters"]:
            return self.spark.createDataFrame([], self.schema)
        return self._data([f"{self.path}/data"], n).select(*self.schema.names)

    def history(self) -> list[dict]:
        """What every commit took in and read: rows, new rows, buckets and bytes."""
        log = f"{self.path}/_log"
        return [log_entry(self.spark, log, n)["stats"] for n in log_versions(self.spark, log)]

    # ------------------------------------------------------- appending

    def _keyed(self, batch: DataFrame, origin: Column) -> DataFrame:
        """The batch, once per key, with bucket, filter hash and the origin of rows whose key has a NULL."""
        no_key = F.exists(F.array(*[F.col(k).isNull() for k in self.keys]), lambda x: x)
        content = F.sha2(F.to_json(F.struct(*self.schema.names), {"ignoreNullFields": "false"}), 256)
        rows = batch.select(*self.schema.names, origin.cast("string").alias("_file"), content.alias("_row"))
        keyed = distinct_on(rows.where(~no_key), self.keys, ["_row"]).withColumn("_origin", F.lit(None).cast("string"))
        nth = F.row_number().over(Window.partitionBy("_file", "_row").orderBy(F.lit(0)))
        unkeyed = rows.where(no_key).withColumn("_origin", F.concat_ws("#", F.coalesce("_file", F.lit("")), "_row", nth.cast("string")))
        both = keyed.unionByName(unkeyed).drop("_file", "_row")
        hashed = F.xxhash64(*self.keys, "_origin")
        return both.withColumn("_h", hashed).withColumn("_b", F.pmod(F.xxhash64(F.col("_h"), F.lit("b")), F.lit(self.buckets)).cast("int"))

    def _filters(self, rows: DataFrame, n: int, known: DataFrame | None) -> DataFrame:
        """The filters of the rows' buckets with the rows' keys added."""
        words = self.bits // 64
        bit = rows.select("_b", F.explode(_positions(F.col("_h"), self.bits)).alias("p")).select(
            "_b", F.floor(F.col("p") / 64).cast("int").alias("w"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("v"))
        per_word = bit.groupBy("_b", "w").agg(F.bit_or("v").alias("v"))
        new = per_word.groupBy("_b").agg(F.map_from_entries(F.collect_list(F.struct("w", "v"))).alias("m"))
        new = new.withColumn("words", F.transform(F.sequence(F.lit(0), F.lit(words - 1)), lambda i: F.coalesce(F.col("m")[i], F.lit(0).cast("long"))))
        if known is not None:
            old = known.select(F.col("_b").alias("_ob"), F.col("words").alias("old"))
            both = F.zip_with("words", "old", lambda a, b: a.bitwiseOR(b))
            new = new.join(old, F.col("_b") == F.col("_ob"), "left").withColumn("words", F.coalesce(both, "words"))
        return new.select("_b", F.lit(n).alias("_e"), "words")

    def append(self, batch: DataFrame, stream: str | None = None, epoch: int = 0, origin: Column | None = None) -> int:
        """Append the rows whose key the table does not hold; returns how many.

        ``stream`` and ``epoch`` name a micro-batch; one that was committed is not taken again.
        """
        last, entry = self._head()
        if entry["made"] != [self.buckets, self.bits]:
            raise ValueError(f"the target was made with {entry['made']} buckets and filter bits")
        if stream is not None and epoch <= entry["streams"].get(stream, -1):
            return 0
        n = last + 1
        for kind in ("data", "filters"):  # left by a commit of this number that failed
            p, fs = self._files(f"{self.path}/{kind}/_b=*/_e={n}")
            for found in fs.globStatus(p) or []:
                fs.delete(found.getPath(), True)
        rows = self._keyed(batch, F.lit(None) if origin is None else origin).persist()
        try:
            newest = {int(b): e for b, e in entry["filters"].items()}
            # At most `buckets` numbers.
            touched = sorted(r["_b"] for r in rows.select("_b").distinct().collect())
            seen = [b for b in touched if b in newest]
            known, hit, read = None, [], 0
            if seen:
                folders = [f"{self.path}/filters/_b={b}/_e={newest[b]}" for b in seen]
                known = (self.spark.read.schema("words array<bigint>, _b int, _e int")
                         .option("basePath", f"{self.path}/filters").parquet(*folders).select("_b", "words"))
                read += self._bytes(folders)
                maybe = F.forall(_positions(F.col("_h"), self.bits), lambda p: F.getbit(
                    F.element_at("words", (F.floor(p / 64) + 1).cast("int")), (p % 64).cast("int")) == 1)
                old = known.withColumnRenamed("_b", "_fb")
                tested = rows.join(old, F.col("_b") == F.col("_fb"), "left").withColumn("_maybe", F.coalesce(maybe, F.lit(False)))
                hit = sorted(r["_b"] for r in tested.where("_maybe").select("_b").distinct().collect())
            new = rows
            if hit:
                folders = [f"{self.path}/data/_b={b}" for b in hit]
                read += self._bytes(folders)
                held = self._data(folders, last).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)],
                                                        F.col("_origin").alias("_o"))
                same = F.col("_origin").eqNullSafe(F.col("_o"))
                for i, k in enumerate(self.keys):
                    same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
                new = rows.join(held, same, "left_anti")
            new = new.persist()
            count = new.count()
            if count:
                out = new.select(*self.schema.names, "_origin", "_b", F.lit(n).alias("_e"))
                # Large buckets are split over tasks, small ones share them.
                (out.hint("rebalance", "_b").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                    .partitionBy("_b", "_e").parquet(f"{self.path}/data"))
                (self._filters(new, n, known).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                     .partitionBy("_b", "_e").parquet(f"{self.path}/filters"))
            changed = [r["_b"] for r in new.select("_b").distinct().collect()]
            taken = rows.count()
            new.unpersist()
        finally:
            rows.unpersist()
        stats = {"rows": taken, "new": count, "touched": len(touched), "read_buckets": len(hit), "read_bytes": read}
        content = {"streams": entry["streams"] | ({stream: epoch} if stream is not None else {}), "stats": stats,
                   "filters": {str(b): e for b, e in (newest | {b: n for b in changed}).items()}, "made": entry["made"]}
        if not create_exclusive(self.spark, f"{self.path}/_log/{n:012d}.json", json.dumps(content)):
            raise RuntimeError(f"another writer made commit {n} of {self.path}")
        return count


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming checkpoint gives its query; a new checkpoint at the same place has another one."""
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/metadata")
    stream = p.getFileSystem(spark._jsc.hadoopConfiguration()).open(p)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()
