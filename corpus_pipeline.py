"""Quality rules, near duplicates, repeated passages, secrets and packing, one after the other over the documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from talkweave.llm import fertility, packing, secret_scan, setsketch, suffix_dedup
from talkweave.llm._tables import stored, table

STAGES = [
    ("quality_rules", fertility.reject_stage),
    ("near_dedup", setsketch.dedup_stage),
    ("suffix_dedup", suffix_dedup.cut_stage),
    ("secret_scan", secret_scan.mask_stage),
    ("packing", packing.pack_stage),
]
#: Tokenisers, sketches and models decide, which SQL can't express; tests/llm hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the documents table; what each returns is stored as Parquet and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs)
    return docs
