"""Joins and lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hestia.functions.rules import cascade
from hestia.functions.text import ColumnOrName, _c

def unmatched_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys of ``a`` with no match in ``b`` (left anti)."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "left_anti")


def matched_keys(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct keys present in both."""
    return a.select(key).distinct().join(b.select(key).distinct(), key, "inner")


def enrich(
    df: DataFrame,
    dim: DataFrame,
    key: str | Sequence[str],
    cols: Sequence[str],
) -> DataFrame:
    """Left join of a dimension's columns.

    The dimension is de-duplicated on the key first, so the join never
    multiplies fact rows. Whether it is broadcast is Spark's choice, by its
    size in bytes (``spark.sql.autoBroadcastJoinThreshold``, checked again
    at run time); beyond that, a hot fact key is split by the skew join.
    """
    keys = [key] if isinstance(key, str) else list(key)
    # One whole row per key, chosen deterministically (the smallest).
    d = dim.groupBy(*keys).agg(F.min(F.struct(*cols)).alias("__d")).select(*keys, "__d.*")
    return df.join(d, keys, "left")


def apply_aliases(col: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """N:1 alias substitution, unknown values kept (a CASE expression)."""
    c = _c(col)
    return cascade([(c == F.lit(old), new) for old, new in mapping.items()], c)


def apply_aliases_join(df: DataFrame, col: str, aliases: DataFrame) -> DataFrame:
    """J4, table form: ``aliases(alias, canonical)`` joined on the value."""
    a = aliases.select(F.col("alias").alias(col), "canonical").dropDuplicates([col])
    return (
        df.join(a, col, "left")
        .withColumn(col, F.coalesce("canonical", col))
        .drop("canonical")
    )


def match_report(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row per distinct key of either side with per-side row counts
    and a status (``both``, ``left_only``, ``right_only``)."""
    ca = a.groupBy(key).agg(F.count(F.lit(1)).alias("left_rows"))
    cb = b.groupBy(key).agg(F.count(F.lit(1)).alias("right_rows"))
    j = ca.join(cb, key, "full_outer")
    return j.select(
        key,
        F.coalesce("left_rows", F.lit(0)).alias("left_rows"),
        F.coalesce("right_rows", F.lit(0)).alias("right_rows"),
        F.when(F.col("left_rows").isNotNull() & F.col("right_rows").isNotNull(), "both")
        .when(F.col("left_rows").isNotNull(), "left_only")
        .otherwise("right_only")
        .alias("status"),
    )
