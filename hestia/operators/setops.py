"""Set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from hestia.operators.relational import common_columns


def union_loose(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by name; a column missing on one side is null there."""
    return a.unionByName(b, allowMissingColumns=True)


def align_types(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Cast columns that are text on one side only to text on the other, so
    the union never fails on int-vs-text under ANSI. Numbers of different
    types are left to the union, which widens them (int and double: double)."""
    ta = dict(a.dtypes)
    tb = dict(b.dtypes)
    for c in cols:
        if ta[c] != tb[c] and "string" in (ta[c], tb[c]):
            a = a.withColumn(c, a[c].cast("string"))
            b = b.withColumn(c, b[c].cast("string"))
    return a, b


def union_common(a: DataFrame, b: DataFrame) -> DataFrame:
    """Union by name on the columns both sides share (order of ``a``)."""
    cols = common_columns(a, b)
    a2, b2 = align_types(a.select(*cols), b.select(*cols), cols)
    return a2.unionByName(b2)


def distinct_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Distinct rows, or distinct values of some columns."""
    return (df.select(*cols) if cols else df).distinct()


def concat_dedup(*dfs: DataFrame) -> DataFrame:
    """U4: concatenate (by name) and drop duplicate rows."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out.dropDuplicates()
