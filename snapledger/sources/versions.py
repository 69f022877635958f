"""Tables written version by version in a shared folder: a delta for each version, folded into a base now and then.

    <path>/version=<n>/base=<0 or 1>/[bucket=<b>/]part-*.parquet

A version is the number of a batch. Writing one again replaces it, and what was written only in part is not seen. The state as
of a version is the last base up to it and the deltas that follow, folded by key. A compaction writes that state as a base and
deletes what no version that must stay readable needs, so the number of folders is bounded however many batches there are.
With ``buckets`` rows are dealt by a hash of their key, and readers that name the buckets they touch read only those.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from snapledger.operators.merge import upsert

BUCKET = "bucket"


class Versions:
    """One such table.

    Rows of one key fold as ``merge.upsert`` has it: ``first`` keeps the earliest value, ``last`` takes the latest, and
    ``last_filled`` the latest that isn't null; with keys and no policy all columns are ``last``. Within one version a key
    stands once. Without keys the rows of all versions stand side by side.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: str | StructType, keys: Sequence[str] = (), last: Sequence[str] = (),
        first: Sequence[str] = (), last_filled: Sequence[str] = (), buckets: int = 0,
    ):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets
        self.schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
        self.policy = {"last": list(last), "first": list(first), "last_filled": list(last_filled)}
        if keys and not any(self.policy.values()):
            self.policy["last"] = [c for c in self.schema.names if c not in keys]

    def _files(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def folders(self) -> list[tuple[int, bool]]:
        """(version, whether it is a base) of all that was written completely; as many as compaction leaves."""
        system, root = self._files(self.path)
        found = []
        for version in system.listStatus(root) if system.exists(root) else []:
            name = version.getPath().getName()
            for part in system.listStatus(version.getPath()) if name.startswith("version=") else []:
                if system.exists(self._files(f"{part.getPath()}/_SUCCESS")[1]):
                    found.append((int(name.partition("=")[2]), part.getPath().getName() == "base=1"))
        return sorted(found)

    def bucket_of(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def _write(self, df: DataFrame, version: int, base: bool) -> None:
        out = df.select(*self.schema.names)
        writer = out.withColumn(BUCKET, self.bucket_of()).repartition(BUCKET).write.partitionBy(BUCKET) if self.buckets else out.write
        writer.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{self.path}/version={version}/base={int(base)}")

    def write(self, df: DataFrame, version: int) -> None:
        """The rows of one version, in place of any it had. A version that a base has taken in can't be written again."""
        if any(base and known >= version for known, base in self.folders()):
            raise ValueError(f"version {version} is compacted")
        self._write(df, version, False)

    def read(self, as_of: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The state as of a version (the last one unless given), of the named buckets only."""
        folders = [f for f in self.folders() if as_of is None or f[0] <= as_of]
        start = max((v for v, base in folders if base), default=None)
        if start is None and as_of is not None and any(base for _, base in self.folders()):
            raise ValueError(f"version {as_of} is compacted")
        chosen = [f for f in folders if start is None or f == (start, True) or f[0] > start]
        if not chosen:
            return self.spark.createDataFrame([], self.schema)
        shape = StructType(list(self.schema.fields)).add("version", IntegerType()).add("base", IntegerType())
        if self.buckets:
            shape = shape.add(BUCKET, IntegerType())
        paths = [f"{self.path}/version={v}/base={int(base)}" for v, base in chosen]
        rows = self.spark.read.schema(shape).option("basePath", self.path).parquet(*paths)
        if buckets is not None and self.buckets:
            rows = rows.filter(F.col(BUCKET).isin(list(buckets)))
        if self.keys and len(chosen) > 1:
            rows = upsert(rows, self.keys, F.col("version"), **self.policy)
        return rows.select(*self.schema.names)

    def compact(self, upto: int | None = None, keep_from: int | None = None) -> None:
        """Write the state as of ``upto`` as a base; versions from ``keep_from`` on (``upto`` unless given) stay readable.

        A job that still reads older folders must have ended. Repeating a compaction changes nothing.
        """
        folders = self.folders()
        upto = max((v for v, _ in folders if upto is None or v <= upto), default=None)
        if upto is None:
            return
        if (upto, True) not in folders:
            self._write(self.read(upto), upto, True)
        oldest = max((v for v, base in self.folders() if base and v <= (upto if keep_from is None else keep_from)), default=None)
        for version, base in self.folders():
            if oldest is not None and (version < oldest or (version == oldest and not base)):
                system, at = self._files(f"{self.path}/version={version}/base={int(base)}")
                system.delete(at, True)
                if not system.listStatus(at.getParent()):
                    system.delete(at.getParent(), True)
