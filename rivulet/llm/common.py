"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from functools import partial
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rivulet.session import scratch_path


def col(name: str) -> Column:
    """A column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole(df: DataFrame) -> Column:
    """All columns of a row as one, to carry it beside working columns whose names could clash."""
    return F.struct(*[col(c) for c in df.columns])


def unpacked(df: DataFrame, row: str, columns: list[str], new: dict[str, Column] | None = None) -> DataFrame:
    """The columns packed by ``whole``, some of them replaced."""
    return df.select(*[(new or {}).get(c, F.col(row).getField(c)).alias(c) for c in columns])


def package_for_workers(spark: SparkSession) -> None:
    """Let Python workers on this machine import this package wherever the driver was started.

    On a cluster the package is installed or shipped (``--py-files``); an unknown path does no harm there.
    """
    root = str(Path(__file__).resolve().parents[2])
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [env.get("PYTHONPATH"), root]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    package_for_workers(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def saved(df: DataFrame, name: str, codec: str = "lz4") -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back.

    It cuts the lineage at a table that every executor can read, so a lost
    executor never repeats the work before it.
    """
    path = scratch_path(df.sparkSession, name)
    schema = df.schema
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


_HELD: dict = {}


def held(key: str, make):
    """``make()``, kept by this Python worker until another key is asked for.

    Workers serve many operators in turn; with one place for all, a worker
    never holds more than one automaton, model or memory of words.
    """
    if _HELD.get("key") != key:
        _HELD.clear()
        _HELD.update(key=key, it=make())
    return _HELD["it"]


def sliced(batches, rows: int = 1000):
    """Arrow batches in pieces of at most ``rows`` rows, so that few texts are copied at a time."""
    for t in batches:
        for s in range(0, t.num_rows, rows):
            yield t.slice(s, rows)


def held_out(doc_id: Column) -> Column:
    """True for documents kept out of training: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def bounded_sample(df: DataFrame, rows: int, seed: int, *by: str) -> DataFrame:
    """About ``rows`` rows, chosen by a hash of the named columns; all of them if there are fewer.

    One count fixes the fraction, so the size of what is fitted does not
    grow with the table, and the same rows are chosen on every run.
    """
    n = df.count()
    if n <= rows:
        return df
    cut = int(rows / n * 2**31)
    return df.where(F.pmod(F.xxhash64(F.lit(seed), *[col(c) for c in by]), F.lit(2**31)) < cut)


class Forest:
    """Union-find over the distinct values of integer pairs (one block's worth)."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.root(i), self.root(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        return True


def rank(ids: np.ndarray, seed: int) -> np.ndarray:
    """A random order of ids, another for each seed; pointers that only go down in it never meet a cycle."""
    h = (ids.view(np.uint64) ^ np.uint64(seed + 1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def _stars(batches, seed, block=1 << 20):
    """Edges of one partition → each node beside the lowest-ranked node it is connected to there."""
    import pyarrow as pa

    def flush(a, b):
        ids, inv = np.unique(np.concatenate([a, b]), return_inverse=True)
        order = np.argsort(rank(ids, seed), kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        inv, f = place[inv], Forest(len(ids))
        for i, j in zip(inv[:len(a)].tolist(), inv[len(a):].tolist()):
            f.join(i, j)
        r = np.fromiter((f.root(i) for i in range(len(ids))), np.int64, len(ids))
        keep = r != np.arange(len(ids))
        ids = ids[order]
        return ids[keep], ids[r[keep]]

    out = lambda: pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
    a, b = np.empty(0, np.int64), np.empty(0, np.int64)
    for t in batches:
        a = np.concatenate([a, t.column(0).to_numpy(zero_copy_only=False)])
        b = np.concatenate([b, t.column(1).to_numpy(zero_copy_only=False)])
        if len(a) >= block:  # there are fewer stars' edges than nodes, so this shrinks it
            a, b = flush(a, b)
            if len(a) >= block // 2:
                yield out()
                a, b = a[:0], b[:0]
    if len(a):
        a, b = flush(a, b)
        yield out()


def components(edges: DataFrame, block: int = 1 << 18) -> DataFrame:
    """``edges(a, b)`` of long ids → ``(id, component)``: the smallest id reachable by edges.

    Only ids on an edge between two different ids are returned. Each round
    deals the edges into blocks of about ``block``, joins up each block, and
    contracts every node to the lowest-ranked node it has met in any block.
    Ranks are random anew each round, so the graph shrinks geometrically
    whatever its shape; the round in which it fits one block is the last. A
    hub's rows meet only in partial aggregates and in joins of two exchanged
    sides, which adaptive execution splits. Rounds are cut by written tables.
    """
    a, b = edges.columns[:2]
    e = edges.select(col(a).cast("long").alias("a"), col(b).cast("long").alias("b")).where("a != b")
    e = saved(e.mapInArrow(partial(_stars, seed=0), "a long, b long"), "cc-edges")
    maps = []
    while n := e.count():
        parts = -(-n // block)
        star = saved(e.repartition(parts).mapInArrow(partial(_stars, seed=len(maps) + 1), "a long, b long"), "cc-stars")
        if parts == 1:
            maps.append(star.select("a", F.col("b").alias("to")))
            break
        low = F.min(F.struct(F.xxhash64(F.lit(len(maps)), F.col("b")).alias("r"), F.col("b").alias("v")))
        point = saved(star.groupBy("a").agg(low.alias("m")).select("a", F.col("m.v").alias("to")), "cc-points")
        maps.append(point)
        left = star.join(point.select("a", F.col("to").alias("ta")), "a")
        e = left.join(point.select(F.col("a").alias("b"), F.col("to").alias("tb")), "b", "left")
        e = e.select("ta", F.coalesce("tb", "b").alias("tb")).where("ta != tb")
        e = saved(e.select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct(), "cc-edges")
    if not maps:
        return e.select(F.col("a").alias("id"), F.col("b").alias("component"))
    final = maps[-1]
    for point in reversed(maps[:-1]):
        nxt = final.select(F.col("a").alias("to"), F.col("to").alias("last"))
        moved = point.join(nxt, "to", "left").select("a", F.coalesce("last", "to").alias("to"))
        final = saved(moved.union(final.join(point, "a", "left_anti")), "cc-map")
    least = final.groupBy("to").agg(F.min("a").alias("m")).select("to", F.least("m", "to").alias("component"))
    least = saved(least, "cc-least")
    every = final.join(least, "to").select(F.col("a").alias("id"), "component")
    return every.union(least.select(F.col("to").alias("id"), "component")).distinct()
