"""Printing sinks (K2): every record as a line of text, written where it is; and a preview on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def record_lines(df: DataFrame) -> DataFrame:
    """Each record as one line of JSON (nulls included), in the column ``value``."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def print_data(df: DataFrame, path: str, mode: str = "error") -> None:
    """Print all records of a batch: text files below ``path``, written by the tasks that hold them."""
    record_lines(df).write.mode(mode).text(path)


def print_stream(stream: DataFrame, path: str, checkpoint: str, trigger: dict | None = None):
    """Print all records of a stream to text files below ``path`` (returns the running query)."""
    w = record_lines(stream).writeStream.format("text").option("path", path).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()


def preview(df: DataFrame, n: int = 20, truncate: bool = False) -> None:
    """Show the first ``n`` records on the driver."""
    df.show(n, truncate=truncate)


def preview_stream(stream: DataFrame, checkpoint: str, n: int = 20, trigger: dict | None = None):
    """Start a console sink that shows the first ``n`` records of each micro-batch (returns the running query)."""
    w = (stream.writeStream.format("console").option("numRows", str(n)).option("truncate", "false")
         .option("checkpointLocation", checkpoint))
    return (w.trigger(**trigger) if trigger else w).start()
