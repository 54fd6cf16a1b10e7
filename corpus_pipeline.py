"""Training-data pipeline: from ``documents`` to packed sequences.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor
kept. ``run`` writes what a stage returns as Parquet in the shared folder and reads
it again for the next one, so a lost executor costs the stage it was in. All stages
but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from feedpulse.llm.common import documents, written
from feedpulse.llm.exact_dedup import keep_first_copies
from feedpulse.llm.near_dedup import keep_first_of_near
from feedpulse.llm.packing import pack_stage
from feedpulse.llm.quality import keep_good
from feedpulse.llm.secret_scan import redact_secrets

STAGES = [
    ("quality", keep_good),
    ("exact_dedup", keep_first_copies),
    ("near_dedup", keep_first_of_near),
    ("secret_scan", redact_secrets),
    ("packing", pack_stage),
]

#: A trained classifier and MinHash have no SQL; tests/llm checks the run by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
