"""A corpus pipeline over ``documents``: rules, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; the result is written as Parquet under the shared checkpoint folder and
read back as the next stage's ``docs``; what a stage read and wrote besides is
deleted then. All but the last return the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from shiftwise.llm import mixing, ngram_join, packing, quality, secret_scan
from shiftwise.llm.common import table
from shiftwise.session import materialize, remove_folder, run_folder, scratch

STAGES = [
    ("quality_rules", quality.stage),
    ("near_duplicates", ngram_join.stage),
    ("secrets", secret_scan.stage),
    ("mix", mixing.stage),
    ("pack", packing.stage),
]

#: EM, the similarity join, the test battery and tokenisation are beyond SQL; tests/llm/test_pipeline.py has the checks.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        run_id = uuid.uuid4().hex
        with scratch(spark):
            docs = materialize(stage(spark, docs, sf_dir), name, run_id)
        if before:
            remove_folder(spark, run_folder(spark, before))
        before = run_id
    return docs
