"""Projections (P1–P7) and filters (F1–F8)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hestia.functions.text import ColumnOrName, _c


def project(df: DataFrame, cols: Sequence[ColumnOrName]) -> DataFrame:
    """Column projection (pruned down to the scan by Catalyst)."""
    return df.select(*cols)


def ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Null-safe ratio: null when the denominator is 0 or null (ANSI safe)."""
    return F.try_divide(_c(num), _c(den))


def with_ratio(df: DataFrame, num: ColumnOrName, den: ColumnOrName, name: str) -> DataFrame:
    """Derived ratio column."""
    return df.withColumn(name, ratio(num, den))


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename several columns in one projection."""
    return df.withColumnsRenamed(dict(mapping))


def drop_cols(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """P4."""
    return df.drop(*cols)


def common_columns(a: DataFrame, b: DataFrame) -> list[str]:
    """P5: names present in both, in the order of ``a``."""
    other = set(b.columns)
    return [c for c in a.columns if c in other]


NUMERIC_TYPES = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.ShortType, T.DecimalType)


def columns_of_type(df: DataFrame, types: tuple = NUMERIC_TYPES, exclude: Iterable[str] = ()) -> list[str]:
    """Column names whose type is one of ``types``, minus exclusions."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, types) and f.name not in ex]


def schema_table(spark: SparkSession, df: DataFrame) -> DataFrame:
    """The schema as a table (position, name, type, nullable).

    Built from the schema held by the driver (metadata only, no rows).
    """
    rows = [(i + 1, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "position int, column_name string, data_type string, nullable boolean")


def filter_null(df: DataFrame, col: ColumnOrName, keep_null: bool = True) -> DataFrame:
    """keep the null rows (or the non-null rows)."""
    c = _c(col)
    return df.filter(c.isNull() if keep_null else c.isNotNull())


def null_but_mentions(df: DataFrame, col: ColumnOrName, text: ColumnOrName, needle: str) -> DataFrame:
    """``col`` is null and the lower-cased text mentions ``needle``."""
    return df.filter(_c(col).isNull() & F.lower(_c(text)).contains(needle.lower()))


def filter_eq(df: DataFrame, col: ColumnOrName, value) -> DataFrame:
    """F3."""
    return df.filter(_c(col) == F.lit(value))


def drop_outliers(
    df: DataFrame,
    num: ColumnOrName,
    den: ColumnOrName,
    lo: float,
    hi: float,
    caps: Mapping[str, float] | None = None,
) -> DataFrame:
    """keep rows whose ratio lies in ``[lo, hi]`` and whose capped columns
    are strictly below their cap. A null ratio fails the band (row removed)."""
    r = ratio(num, den)
    cond = r.between(lo, hi)
    for c, cap in (caps or {}).items():
        cond = cond & (F.col(c) < F.lit(cap))
    return df.filter(cond)


def contains_ci(df: DataFrame, col: ColumnOrName, needle: str) -> DataFrame:
    """case-insensitive substring; null values do not match."""
    return df.filter(F.lower(_c(col)).contains(needle.lower()))


def tail_rows(df: DataFrame, cols: Sequence[str], p: float = 0.99, exact: bool = False, accuracy: int = 10000) -> DataFrame:
    """rows where any of ``cols`` is at or above its own p-quantile.

    The thresholds are one aggregate over all columns (one pass), used as a
    scalar subquery: no cross join and nothing collected to the driver.
    Adds a ``tail_columns`` array naming the columns that hit.
    """
    # One scalar subquery carrying every threshold.
    if exact:
        from hestia.operators.aggregate import quantiles

        rows = quantiles(df, cols, [p], exact=True, accuracy=accuracy)
        q = rows.agg(F.map_from_entries(F.collect_list(F.struct("column_name", "value"))).alias("q")).scalar()
    else:
        aggs = [x for c in cols for x in (F.lit(c), F.percentile_approx(c, p, accuracy).cast("double"))]
        q = df.agg(F.create_map(*aggs).alias("q")).scalar()
    hits = [F.when(F.col(c) >= F.try_element_at(q, F.lit(c)), F.lit(c)) for c in cols]
    out = df.withColumn("tail_columns", F.array_compact(F.array(*hits)))
    return out.filter(F.size("tail_columns") > 0)


def violations(df: DataFrame, predicate: Column) -> DataFrame:
    """rows that break a rule expected to hold (expected empty)."""
    return df.filter(predicate)


def preview(df: DataFrame, n: int, order: Sequence[ColumnOrName]) -> DataFrame:
    """F8: first ``n`` rows under a total order (TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n)


def cached(df: DataFrame) -> DataFrame:
    """K3: keep a table reused by several jobs (memory, spilling to disk)."""
    from pyspark import StorageLevel

    return df.persist(StorageLevel.MEMORY_AND_DISK)
