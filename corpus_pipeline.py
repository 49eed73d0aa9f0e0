"""The corpus pipeline: language ID, near duplicates, decontamination, secrets, tokens.

Each stage takes `(spark, docs, sf_dir)` and works on all that the one before has kept. All but the
last return the columns of `documents`; the last gives each document's token ids. An empty table
passes through all of them.
"""

from pyspark.sql import DataFrame, SparkSession

from wardline.llm import bpe, decontamination, jaccard_join, language_id, secret_scans
from wardline.llm.tasks import read, stored

#: Documents without a recognised language go; one document of each group of near duplicates stays;
#: documents with benchmark passages go; secrets are masked; what is left is encoded.
STAGES = [
    ("language_id", language_id.stage),
    ("jaccard_join", jaccard_join.stage),
    ("decontamination", decontamination.stage),
    ("secret_scans", secret_scans.stage),
    ("bpe", bpe.stage),
]

#: Trained models and a tokenizer are not for SQL; a test runs the stages by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`; each result is written below the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
