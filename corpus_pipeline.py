"""The corpus pipeline: quality rules, line dedup, near-duplicates, mixing, packing.

Each stage takes what the one before it kept, all of it, and is written and read again before the next.
All but the last return the columns of ``documents``; the last returns the packed pieces with their ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from llm.common import table
from llm.lines import line_dedup_stage
from llm.minhash import near_duplicate_stage
from llm.mixing import mixing_stage
from llm.packing import packing_stage
from llm.quality import quality_stage
from ticketloom.session import written

STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("minhash_near_duplicates", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]

#: SQL states neither the certified cutoffs, the signatures nor the tokenizer; tests/llm checks the stages one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
