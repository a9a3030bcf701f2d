"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes all that its predecessor kept, written as Parquet and read
again; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rivulet.llm import decontaminate, linededup, packing, simhash, toxicity
from rivulet.llm.common import package_for_workers, saved, table


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity grammar does not reject."""
    package_for_workers(spark)
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that repeat an earlier line or resemble one."""
    package_for_workers(spark)
    return linededup.drop_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    package_for_workers(spark)
    return simhash.drop_near_duplicates(docs)


def benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark text worth mentioning."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2048 tokens."""
    package_for_workers(spark)
    return packing.pack(docs, packing.tokenizer_spec())


STAGES = [("toxicity", toxic), ("line dedup", lines), ("simhash near-dedup", near_duplicates),
          ("benchmark decontamination", benchmarks), ("packing", pack)]

#: Trained scores, fingerprints and token ids are not SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
