"""Training-corpus pipeline: five stages over ``documents``.

Each stage takes the documents that its predecessor kept and returns the
columns of ``documents``; the last returns token counts and digests. ``run``
writes every stage's rows to the shared folder and reads them again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from urbanframe.llm.jaccard import stage_jaccard
from urbanframe.llm.mixing import stage_mix
from urbanframe.llm.pieces import stage_pieces
from urbanframe.llm.quality import stage_quality
from urbanframe.llm.repeats import stage_repeats
from urbanframe.session import shared_folder

STAGES = [
    ("quality_filter", stage_quality),
    ("near_duplicates", stage_jaccard),
    ("long_repeats", stage_repeats),
    ("source_mix", stage_mix),
    ("tokenize", stage_pieces),
]

#: The classifier and the byte-level stages are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{shared_folder(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
