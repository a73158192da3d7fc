"""The corpus pipeline: from raw documents to token ids.

Each stage takes what the one before has kept, written as Parquet in the
shared folder and read again. All but the last return the columns of
``documents``; the last adds each text's ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hestia.llm import bpe, contamination, language, ledger, simhash
from hestia.llm.common import crc_of_id, fresh_path, table

#: SQL can't express compression, hashing of shingles into fingerprints, or pair merging.
ORACLE_SQL = None
RANKS = "byte_bpe_50k.tiktoken"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is told by a clear margin; those without a letter and those near a tie go."""
    learned = language.learn(docs.where(~language.held_out(crc_of_id())))
    found = language.classify(docs, learned, keep=docs.columns, names=("__lang", "__score", "__rejected"))
    return found.where("not __rejected").select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of 2 bits or fewer connect: that of the smallest id."""
    return simhash.one_of_each(docs, shingle=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no 10 consecutive words (or whole shorter text) of a benchmark item."""
    return contamination.without_benchmark(docs, table(spark, sf_dir, "benchmark"), width=10)


def drop_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no rule finds a secret."""
    return ledger.without_secrets(docs)


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ``n_tokens`` and ``ids`` (in place of columns of these names); one whose ids don't decode to its text would go."""
    from public_tokenizers import path

    found = bpe.encode(docs, path(RANKS), keep=docs.columns, outputs=("n_tokens", "ids", "decoded_sha256"), prefix="token__")
    whole = F.col("token__decoded_sha256") == F.sha2(F.coalesce("text", F.lit("")), 256)
    others = [c for c in docs.columns if c not in ("n_tokens", "ids")]
    return found.where(whole).select(*others, F.col("token__n_tokens").alias("n_tokens"), F.col("token__ids").alias("ids"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("benchmark", drop_contaminated),
    ("secrets", drop_secrets),
    ("tokens", tokenise),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
