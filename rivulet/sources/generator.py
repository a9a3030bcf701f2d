"""Random items as a Python Data Source with copy-aware partitions.

``spark.read.format("rivulet_random").option("limit", n).option("copies", c)``
gives ``n`` items ``(id, copy, x)``: the ids ``0..n-1`` are cut into ``c``
contiguous blocks (the last takes the rest), one input partition — one
copy — per block, so copies share the work and no item is made twice
(Q11). Each partition builds its items with numpy and returns Arrow
batches. ``spark.readStream`` on the same format is a bounded stream:
all ``limit`` items are available at once, read in one micro-batch by
``copies`` partitions; a restart from the checkpoint finds nothing new.
``x`` equals :func:`rivulet.sources.generated.random_value` of the id.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from .generated import LCG_A, LCG_C, LCG_M

FORMAT = "rivulet_random"
SCHEMA = "id long, copy int, x double"
CHUNK = 1 << 16


class CopyBlock(InputPartition):
    def __init__(self, copy: int, start: int, end: int):
        super().__init__(copy)
        self.copy, self.start, self.end = copy, start, end


def copy_blocks(start: int, end: int, copies: int) -> list[CopyBlock]:
    """Contiguous blocks of ``[start, end)``: size floor(n / copies), the last takes the rest."""
    n = max(0, end - start)
    copies = max(1, min(int(copies), n)) if n else 1
    size = n // copies if n else 0
    out = []
    for c in range(copies):
        lo = start + c * size
        hi = end if c == copies - 1 else lo + size
        out.append(CopyBlock(c, lo, hi))
    return out


def generate(block: CopyBlock):
    import numpy as np
    import pyarrow as pa

    for lo in range(block.start, block.end, CHUNK):
        ids = np.arange(lo, min(lo + CHUNK, block.end), dtype=np.int64)
        x = ((ids % LCG_M) * LCG_A + LCG_C) % LCG_M / float(LCG_M)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids), pa.array(np.full(len(ids), block.copy, dtype=np.int32)), pa.array(x)],
            names=["id", "copy", "x"])


class _Options:
    def __init__(self, options):
        self.limit = int(options.get("limit", 0))
        self.copies = int(options.get("copies", 1))


class _BatchReader(DataSourceReader):
    def __init__(self, options):
        self.o = _Options(options)

    def partitions(self):
        return copy_blocks(0, self.o.limit, self.o.copies)

    def read(self, partition):
        yield from generate(partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, options):
        self.o = _Options(options)

    def initialOffset(self):
        return {"next": 0}

    def latestOffset(self):
        return {"next": self.o.limit}

    def partitions(self, start, end):
        return copy_blocks(int(start["next"]), int(end["next"]), self.o.copies)

    def read(self, partition):
        yield from generate(partition)

    def commit(self, end):
        pass


class RandomItemsSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _BatchReader(self.options)

    def streamReader(self, schema):
        return _StreamReader(self.options)


def register(spark: SparkSession) -> None:
    """Make ``format("rivulet_random")`` available in this session."""
    spark.dataSource.register(RandomItemsSource)


# Readers run in Python workers: ship this module's code with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
