"""ST1: incremental ingest of landed page files.

New page files in ``in_dir`` are read as a stream; each micro-batch is
extracted to records, de-duplicated, filtered against keys that other
batches have written (left anti join: no unbounded streaming state), and
written to a partition of its own, named after the checkpoint and the batch.
A batch that runs again after a failure replaces its partition, so the sink is
idempotent; a replay with another checkpoint finds all keys there. The log of
batches is counted from these partitions, so it can't disagree with them.

Inside its partition a batch is laid out by buckets of the key's hash, in order
of the key. A later batch looks its keys up in the buckets that they fall into
only, and there between their least and greatest first column: the first
filter prunes folders, the second row groups.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from hestia.functions import html as H
from hestia.operators.extract import extract_price_cards

BATCH = "batch"
BUCKET = "bucket"
#: Buckets of a table, the same for all its batches: another number is another table.
BUCKETS = 256
PAGE_SCHEMA = "page_id long, url string, html string"


def page_record(pages: DataFrame) -> DataFrame:
    """One record a page: title, heading and link count."""
    return pages.select(
        "page_id",
        "url",
        H.element_text("html", "title").alias("title"),
        H.element_text("html", "h1").alias("h1"),
        F.size(H.hrefs("html")).alias("n_links"),
    )


def _bucket(keys: Sequence[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def _written(spark: SparkSession, path: str, keys: Sequence[str], own: str, schema: StructType) -> DataFrame | None:
    """Keys and buckets that other batches have written; None where nothing is there yet.

    Any other trouble with the target is an error, not an empty target."""
    fields = StructType([schema[k] for k in keys] + [StructField(BATCH, StringType()), StructField(BUCKET, IntegerType())])
    try:
        table = spark.read.schema(fields).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    return table.filter(F.col(BATCH) != own).select(*keys, BUCKET)


def _near(known: DataFrame, records: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The known keys that can be in ``records``: those in its buckets, between the least and the greatest of its first key column.

    Keys without a bucket (a table written without them) are all kept. What
    comes to the driver is two keys and at most ``BUCKETS`` numbers."""
    low, high, buckets = records.agg(F.min(keys[0]), F.max(keys[0]), F.collect_set(_bucket(keys))).first()
    known = known.filter(F.col(BUCKET).isin(sorted(buckets)) | F.col(BUCKET).isNull())
    if low is not None:
        known = known.filter(F.col(keys[0]).between(F.lit(low), F.lit(high)))
    return known.select(*keys)


def ingest_pages(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    extract: Callable[[DataFrame], DataFrame] = extract_price_cards,
    key: Sequence[str] = ("page_id", "block_no"),
    max_files_per_trigger: int | None = 1000,
    schema: str = PAGE_SCHEMA,
) -> None:
    """Run the ingest until every landed file is processed (availableNow)."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(in_dir)
    keys = list(key)
    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write_batch(batch: DataFrame, epoch_id: int) -> None:
        own = f"{run}-{epoch_id}"
        records = extract(batch).dropDuplicates(keys).persist()
        try:
            new, known = records, _written(spark, out_dir, keys, own, records.schema)
            if known is not None:
                new = records.join(_near(known, records, keys), keys, "left_anti")
            # A file a bucket, in order of the key: its row groups hold narrow ranges.
            laid = new.withColumn(BUCKET, _bucket(keys)).repartition(BUCKET).sortWithinPartitions(BUCKET, *keys)
            writer = laid.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(BUCKET)
            writer.parquet(f"{out_dir.rstrip('/')}/{BATCH}={own}")
        finally:
            records.unpersist()

    q = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    q.awaitTermination()


def batch_log(spark: SparkSession, out_dir: str) -> DataFrame:
    """Records that each batch has brought: ``(batch, n_new)``."""
    return spark.read.parquet(out_dir).groupBy(BATCH).agg(F.count(F.lit(1)).alias("n_new"))
