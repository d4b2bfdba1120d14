"""Documents to training data: toxic documents go, copies go, near copies go, sources are mixed, texts are encoded.

Each stage takes what the one before it kept. All but the last give the columns of ``documents``.
A document that the mix takes twice is there twice, and all rows stand in the order of the mix's queue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marquee.llm.bpe import stage_byte_bpe
from marquee.llm.common import Work
from marquee.llm.exact import stage_exact_dedup
from marquee.llm.mixing import stage_mixing
from marquee.llm.near_dedup import stage_near_dedup
from marquee.llm.toxicity import stage_toxicity

STAGES = [
    ("toxicity", stage_toxicity),
    ("exact dedup", stage_exact_dedup),
    ("near dedup", stage_near_dedup),
    ("mixing", stage_mixing),
    ("byte bpe", stage_byte_bpe),
]

# Learned scores, word sets and merges are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read again."""
    work = Work(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = work.stored(stage(spark, docs, sf_dir), f"stage-{n}")
    return docs
