"""Line and random sources (S11, S12), and parallel copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.conditions import column
from .files import FILE_COL, decoded, suffix_regex

# Fixed values of the random source (our definition): a linear congruential
# step, x = ((id * A + C) mod M) / M.
LCG_A = 1103515245
LCG_C = 12345
LCG_M = 2 ** 31


def lines_of(df: DataFrame, text_col: str = "text", keep=(), line_col: str = "line",
             number_col: str = "line_no") -> DataFrame:
    """One record per ``\\n``-separated line of a text column, whole text.

    ``number_col`` is the 0-based line number (long). A trailing newline
    gives a last empty line, as splitting does; a null text gives no line.
    """
    keep = [keep] if isinstance(keep, str) else list(keep)
    return df.select(*[column(k) for k in keep],
                     F.posexplode(F.split(F.col(text_col), "\n")).alias(number_col, line_col)
                     ).withColumn(number_col, F.col(number_col).cast("long"))


def read_lines(spark: SparkSession, root: str, ending: str | None = None, stream: bool = False,
               skip_errors: bool = False, **options) -> DataFrame:
    """Text files below ``root`` as one record per line, with the origin file."""
    reader = spark.readStream if stream else spark.read
    opts = {"recursiveFileLookup": "true", **{k: str(v) for k, v in options.items()}}
    if skip_errors:
        opts["ignoreCorruptFiles"] = "true"
    df = reader.format("text").options(**opts).load(root)
    name = decoded(F.col("_metadata.file_path"))
    return df.where(name.rlike(suffix_regex(ending))).select(F.col("value").alias("line"), name.alias(FILE_COL))


def random_value(id_col: Column) -> Column:
    """The random value of an item id (S12); exact in 64-bit integers for any id ≥ 0."""
    return ((F.pmod(id_col, F.lit(LCG_M)) * LCG_A + LCG_C) % LCG_M) / F.lit(float(LCG_M))


def random_items(spark: SparkSession, limit: int, num_partitions: int | None = None) -> DataFrame:
    """``limit`` random items ``(id, x)``, reproducible and generated in parallel."""
    df = spark.range(0, int(limit), 1, num_partitions) if num_partitions else spark.range(int(limit))
    return df.withColumn("x", random_value(F.col("id")))


def random_stream(spark: SparkSession, rows_per_batch: int, partitions: int | None = None) -> DataFrame:
    """Random items as a stream (S12 as a stream source): ``(id, x)``.

    Spark's ``rate-micro-batch`` source gives ``rows_per_batch`` consecutive
    ids per micro-batch, spread over ``partitions`` tasks, independent of
    processing speed; ``x`` is the same value as in :func:`random_items`.
    """
    r = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", str(int(rows_per_batch)))
    if partitions:
        r = r.option("numPartitions", str(int(partitions)))
    return r.load().select(F.col("value").alias("id"), random_value(F.col("value")).alias("x"))


def assign_copies(df: DataFrame, copies: int, key: str | None = None, copy_col: str = "copy") -> DataFrame:
    """Tag each record with the copy (0..copies-1) that reads it.

    Copies split one scan; a record is never read twice (Q11). With a key
    its records share a copy: ``pmod(key, copies)`` of an integer, else of
    the key's hash; records without a key are one key. Without a key the
    copy comes from a hash of the whole record.
    """
    if key is None:
        basis = F.xxhash64(*[column(c) for c in df.columns])
    elif isinstance(df.schema[key].dataType, T.IntegralType):
        basis = F.coalesce(column(key), F.lit(0))
    else:
        basis = F.xxhash64(column(key))
    return df.withColumn(copy_col, F.pmod(basis, F.lit(int(copies))).cast("int"))


def union_sources(*dfs: DataFrame) -> DataFrame:
    """Several sources as one flow (R6); unlike schemas meet with nulls."""
    if not dfs:
        raise ValueError("no source to unite")
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out
