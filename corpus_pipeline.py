"""The training-corpus pipeline: five stages over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet to the shared folder and read back as the next stage's documents.

1. quality rules: documents that the base rules or the fertility bands reject go;
2. SimHash near-dedup: of each group of linked fingerprints the smallest id stays;
3. benchmark decontamination: documents that hold a benchmark passage go;
4. mixing: documents are repeated or left out so that sources reach their targets;
5. sharding: every remaining row gets its ``shard`` and ``slot``.

A stage's own scratch tables are deleted when the next stage begins: its result is
written by then, and nothing reads them any more.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from basketry.llm import common, decontam, mixing, quality, sharding, simhash

_SCRATCH: dict[str, list[str]] = {}


def _stage(fn):
    """Delete what the stage before has left, and note what this one writes."""
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        app = spark.sparkContext.applicationId
        common.discard(spark, _SCRATCH.pop(app, []))
        with common.recording() as paths:
            out = fn(spark, docs, sf_dir)
        _SCRATCH[app] = paths
        return out
    return run_stage


@_stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.passing(docs, "text", "lang")


@_stage
def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs, "text", shingle=4, bits=4)


@_stage
def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.clean_rows(docs, common.table(spark, sf_dir, "benchmark"), "text")


@_stage
def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_rows(docs, "doc_id", "text", "source")


@_stage
def shard_rows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(docs, "doc_id", "text", shards=8)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("sharding", shard_rows),
]

# Fingerprints (XXH64), token counts and latent vectors have no SQL form; tests/llm/test_pipeline.py
# holds the rows against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the ``documents`` of ``sf_dir``."""
    docs, before = common.table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        result = stage(spark, docs, sf_dir)
        with common.recording() as paths:
            docs = common.stage(result, f"pipeline-{name}")
        common.discard(spark, before)  # the input of this stage
        before = paths
    common.discard(spark, _SCRATCH.pop(spark.sparkContext.applicationId, []))
    return docs
