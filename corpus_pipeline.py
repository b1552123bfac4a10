"""Documents to training sequences: toxic documents go, then repeated lines,
then near-duplicates; the sources are mixed and the rest is packed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame.  All but the
last return the columns of ``documents``.

Cases: a null text is an empty one; empty texts are near copies of nothing but one
another.  Repeated rows are near copies, so one stays; mixing repeats rows on
purpose, and packing places each of them, with the same doc_id and piece.  Columns
of ``documents`` pass through, whatever their names, up to packing, which returns
its own.  Of an empty table nothing is returned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quarry.llm import line_dedup, mixing, near_dedup, packing, toxicity
from quarry.llm.common import crc_mod, table
from quarry.session import scratch_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.reject(docs, table(spark, sf_dir, "labels"), crc_mod(3) != 1)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_repeated_lines(docs).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.placements(packing.pack(docs, packing.default_vocabulary()))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("near_dedup", drop_near_copies), ("mixing", mix_sources), ("packing", pack)]

#: A trained classifier, hashed signatures and a tokenizer decide; SQL has none of them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
