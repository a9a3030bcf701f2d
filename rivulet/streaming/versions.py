"""Tables with a version per micro-batch: the state of flows that run in ``foreachBatch``.

A micro-batch reads the version of the batch before it and writes its own.
If it is run again after a failure it reads the same version and overwrites
its own, so state and output move on together with the stream's checkpoint
and nothing is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditions import column

_VERSION = "__version"
_GONE = "__gone"


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of any file system that Spark reaches; nothing happens if there is none."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def _schema(schema) -> T.StructType:
    schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])


class Versions:
    """A table that each micro-batch replaces as a whole. The last two versions are kept."""

    def __init__(self, spark: SparkSession, path: str, schema):
        self.spark, self.path, self.schema = spark, path, _schema(schema)

    def _at(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def read(self, version: int) -> DataFrame:
        """A version; before the first one the table is empty."""
        if version < 0:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(self._at(version))

    def write(self, df: DataFrame, version: int) -> None:
        cols = [column(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        df.select(*cols).write.mode("overwrite").parquet(self._at(version))
        drop_folder(self.spark, self._at(version - 2))


class KeyedVersions:
    """One row per key. A micro-batch writes only the keys it changes; every ``every`` batches all keys are written once.

    Reading a version takes the last such snapshot and the changes since, at
    most ``every - 1`` of them, however many batches there were; what is
    older than the snapshot before is deleted. ``gone`` keys are left out
    and leave the next snapshot.
    """

    def __init__(self, spark: SparkSession, path: str, schema, keys: list[str], every: int = 8):
        self.spark, self.path, self.schema, self.keys, self.every = spark, path, _schema(schema), list(keys), every
        self._stored = T.StructType([*self.schema.fields, T.StructField(_GONE, T.BooleanType()), T.StructField(_VERSION, T.LongType())])

    def _snapshot(self, version: int) -> int:
        """The last snapshot at or before a version; -1 if there is none."""
        return (version + 1) // self.every * self.every - 1

    def paths(self, version: int) -> list[str]:
        """The folders a read of this version opens."""
        s = self._snapshot(version)
        return [f"{self.path}/snapshot={s}"] * (s >= 0) + [f"{self.path}/delta={v}" for v in range(s + 1, version + 1)]

    def _latest(self, paths: list[str]) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], self._stored)
        df = self.spark.read.schema(self._stored).parquet(*paths)
        if len(paths) == 1:  # one row per key in each folder
            return df
        held = [f.name for f in self._stored.fields if f.name not in self.keys]
        last = df.groupBy(*[column(k) for k in self.keys]).agg(F.max_by(F.struct(*[column(c) for c in held]), F.col(_VERSION)).alias("__r"))
        return last.select(*[column(k) if k in self.keys else F.col("__r").getField(k).alias(k) for k in self._stored.names])

    def read(self, version: int) -> DataFrame:
        return self._latest(self.paths(version)).where(f"not {_GONE}").drop(_GONE, _VERSION)

    def write(self, changed: DataFrame, version: int, gone=None) -> None:
        """``changed``: at most one row per key; ``gone``: a condition for keys that are removed."""
        cols = [column(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        out = changed.select(*cols, F.coalesce(gone if gone is not None else F.lit(False), F.lit(False)).alias(_GONE),
                             F.lit(version).cast("long").alias(_VERSION))
        out.write.mode("overwrite").parquet(f"{self.path}/delta={version}")
        if self._snapshot(version) == version:
            every = self._latest([*self.paths(version - 1), f"{self.path}/delta={version}"]).where(f"not {_GONE}")
            every.write.mode("overwrite").parquet(f"{self.path}/snapshot={version}")
            old = version - 2 * self.every  # the snapshot before stays, for a reader of the version before
            drop_folder(self.spark, f"{self.path}/snapshot={old}")
            for v in range(max(0, old - self.every + 1), old + 1):
                drop_folder(self.spark, f"{self.path}/delta={v}")
