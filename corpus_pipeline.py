"""Corpus pipeline over ``documents``: quality rules, near copies, personal
data, source mixing, BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is
written as Parquet in the shared folder and read again as the next stage's
``docs``. All but the last return the columns of ``documents``:

1. ``quality``   compression bands and the base rule; rejected rows go;
2. ``dedup``     n-gram Jaccard join; one row of each component stays;
3. ``pii``       skip-chain field; personal data is replaced by its kind, and
                 ``n_chars`` follows the new text;
4. ``mix``       systematic sampling; rows are repeated or go, so that each
                 source comes near its target;
5. ``bpe``       distinct-word encoding and decoding; one row per remaining row
                 with its token count and digests.

Every stage works on all rows its predecessor kept. An empty table passes
through. SQL can express neither zstandard ratios nor the field, so there is no
oracle; the tests run the pipeline against a brute-force version.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vigil.llm import bpe, mixing, ngram_join, pii, quality
from vigil.llm.common import documents, shared_table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_quality(docs)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask_documents(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(docs)


STAGES = [("quality", quality_stage), ("dedup", dedup_stage), ("pii", pii_stage), ("mix", mix_stage),
          ("bpe", bpe_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = shared_table(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
