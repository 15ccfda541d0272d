"""A keyed table that takes upserts by what they change: bucketed, log-structured, versioned.

Rows lie in buckets by the hash of their key. An upsert writes its own rows as a delta, into the buckets that they touch; a reader merges
a bucket's deltas into its base, and reads buckets without deltas as they are. A bucket that has gathered ``compact_after`` deltas
is rewritten, it alone. What belongs to a version is listed in a manifest, a small file whose number is the version's: it is put in place by one
rename that fails if another writer was first, so that readers see a version whole or not at all.

A batch that is tried again is told by its id and changes nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources.files import Versions

SEQ = "_seq"


class KeyedTable:
    """A table below ``root`` with one row for each value of ``key``; null is a value too."""

    def __init__(self, spark: SparkSession, root: str, key: str, buckets: int = 16, compact_after: int = 8):
        self.spark, self.root, self.key, self.buckets, self.compact_after = spark, root.rstrip("/"), key, buckets, compact_after
        self._manifests = Versions(spark, f"{self.root}/manifests")

    # Manifests: {"schema": ..., "buckets": n, "batch": last id, "base": {bucket: folder}, "deltas": {bucket: [folders, oldest first]}, "seq": n}

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join((self.root, *parts)))

    def versions(self) -> list[int]:
        return self._manifests.numbers()

    def manifest(self, version: int | None = None) -> dict | None:
        return self._manifests.read(version)

    def _write(self, rows: DataFrame, kind: str) -> tuple[str, list[str]]:
        """Writes rows (with _bucket) and gives the folder and the buckets that it has."""
        folder = f"{kind}-{uuid.uuid4().hex}"
        rows.write.option("compression", "zstd").partitionBy("_bucket").parquet(f"{self.root}/{folder}")
        found = [x.getPath().getName() for x in self._manifests.fs().listStatus(self._path(folder))]
        return folder, sorted(n.partition("=")[2] for n in found if n.startswith("_bucket="))

    def _bucketed(self, rows: DataFrame, n: int) -> DataFrame:
        return rows.withColumn("_bucket", F.pmod(F.xxhash64(F.col(self.key)), F.lit(n)).cast("int"))

    def _scan(self, folders: list[tuple[str, str]], schema: StructType) -> DataFrame:
        paths = [f"{self.root}/{folder}/_bucket={b}" for folder, b in folders]
        return self.spark.read.schema(StructType([*schema.fields]).add(SEQ, "long")).parquet(*paths)

    def _merged(self, m: dict, buckets: list[str], schema: StructType) -> DataFrame:
        """The rows of buckets with deltas: of each key the newest."""
        rows = self._scan([*((m["base"][b], b) for b in buckets if b in m["base"]), *((d, b) for b in buckets for d in m["deltas"][b])], schema)
        newest = F.max_by(F.struct(*schema.names, SEQ), SEQ).alias("r")
        return rows.groupBy(F.col(self.key).alias("_k")).agg(newest).select("r.*")

    def upsert(self, batch: DataFrame, order: str, batch_id: int | None = None) -> int | None:
        """Writes the rows of ``batch``, of each key the last in order; gives the new version, or none if the batch was written before."""
        m = self.manifest() or {"schema": None, "buckets": self.buckets, "batch": -1, "base": {}, "deltas": {}, "seq": 0}
        if batch_id is not None and batch_id <= m["batch"]:
            return None
        version, seq = (self.versions() or [0])[-1] + 1, m["seq"] + 1
        known = StructType.fromJson(m["schema"]) if m["schema"] else StructType()
        more = [f for f in batch.schema.fields if f.name not in known.names]
        for f in more:
            known = known.add(f.name, f.dataType, True)
        last = batch.groupBy(F.col(self.key).alias("_k")).agg(F.max_by(F.struct(*batch.columns), order).alias("r")).select("r.*")
        rows = last.select(*(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in batch.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in known.fields), F.lit(seq).cast("long").alias(SEQ))
        folder, touched = self._write(self._bucketed(rows, m["buckets"]), "delta")
        for b in touched:
            m["deltas"].setdefault(b, []).append(folder)
        m |= {"schema": json.loads(known.json()), "seq": seq, "batch": m["batch"] if batch_id is None else batch_id}
        self._manifests.put(version, m)
        if any(len(d) >= self.compact_after for d in m["deltas"].values()):
            return self.compact() or version
        return version

    def compact(self, least: int | None = None) -> int | None:
        """Rewrites the buckets that have ``least`` deltas; gives the new version, or none if there is nothing to do."""
        m = self.manifest()
        many = [b for b, d in (m or {}).get("deltas", {}).items() if len(d) >= (least or self.compact_after)]
        if not many:
            return None
        version = self.versions()[-1] + 1
        merged = self._merged(m, many, StructType.fromJson(m["schema"]))
        folder, _ = self._write(self._bucketed(merged, m["buckets"]), "base")
        for b in many:
            m["base"][b] = folder
            del m["deltas"][b]
        self._manifests.put(version, m)
        return version

    def read(self, version: int | None = None) -> DataFrame | None:
        """The rows of a version, by default the newest."""
        m = self.manifest(version)
        if m is None:
            return None
        schema = StructType.fromJson(m["schema"])
        dirty, clean = sorted(m["deltas"]), sorted(b for b in m["base"] if b not in m["deltas"])
        parts = ([self._merged(m, dirty, schema)] if dirty else []) + ([self._scan([(m["base"][b], b) for b in clean], schema)] if clean else [])
        out = parts[0].unionByName(parts[1]) if len(parts) == 2 else parts[0] if parts else self.spark.createDataFrame([], schema)
        return out.select(*schema.names)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Deletes the manifests before the last ``keep``, and the folders that none of those that are left names."""
        known, fs = self.versions(), self._manifests.fs()
        for v in known[:-keep]:
            self._manifests.drop(v)
        used = {f for v in known[-keep:] if (m := self.manifest(v)) for f in [*m["base"].values(), *(x for d in m["deltas"].values() for x in d)]}
        gone = [n for x in fs.listStatus(self._path()) if (n := x.getPath().getName()).startswith(("delta-", "base-")) and n not in used]
        for n in gone:
            fs.delete(self._path(n), True)
        return gone

    def sink(self, order: str):
        """A function for ``foreachBatch``."""
        return lambda batch, batch_id: self.upsert(batch, order, batch_id)
