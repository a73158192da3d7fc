"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word of the licence and decontamination operators: a run of anything but ASCII outside 0-9 a-z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Bytes of text that a Python task turns into its own objects at a time.
SLICE = 4 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (``spark.checkpoint.dir``).

    Only where the session names none, as in tests on a local master, a
    temporary folder is made; elsewhere that is an error.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="hestia-shared-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` cut from its lineage by a reliable checkpoint."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, other letters as they are.

    ``lower`` does it where every character is ASCII; only other texts
    take the slower ``translate``.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, UPPER, LOWER)
    )


def crc_of_id(doc_id: str = "doc_id") -> Column:
    """crc32 of the id as text, as the train/held-out splits use it."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def reading(df: DataFrame, keep: list[str], text: str) -> tuple[DataFrame, int]:
    """``keep`` of ``df`` with the column ``text`` (once; last unless it is one of ``keep``), and the place of the text."""
    if text in keep:
        return df.select(*keep), keep.index(text)
    return df.select(*keep, F.col(text).alias("__text")), len(keep)


def sliced(batches: Iterable[pa.RecordBatch], column: int, most: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches``, at most about ``most`` bytes of the text column at a time (a longer text alone)."""
    for batch in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + most, side="right")))
            yield batch.slice(at, to - at)
            at = to
