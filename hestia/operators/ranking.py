"""Window ranking, sorts and top-k.

Top-k filters written as ``row_number() <= k`` let Spark insert a partial
``WindowGroupLimit`` before the shuffle, so each task keeps only k rows per
group even when one group holds a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hestia.functions.text import ColumnOrName, _c


def _order(by: Sequence[ColumnOrName | tuple[str, str]]) -> list[Column]:
    out = []
    for b in by:
        if isinstance(b, tuple):
            name, direction = b
            out.append(F.desc(name) if direction.lower().startswith("d") else F.asc(name))
        else:
            out.append(_c(b))
    return out


def sort_by(df: DataFrame, by: Sequence[ColumnOrName | tuple[str, str]]) -> DataFrame:
    """O1/O2: total sort (range-partitioned, distributed)."""
    return df.orderBy(*_order(by))


def top_k(df: DataFrame, by: Sequence[ColumnOrName | tuple[str, str]], k: int) -> DataFrame:
    """O3: global top-k (``TakeOrderedAndProject``: k rows kept per task)."""
    return df.orderBy(*_order(by)).limit(k)


def top_row(df: DataFrame, partition: Sequence[str], order: Sequence[ColumnOrName | tuple[str, str]]) -> DataFrame:
    """First row per partition under ``order`` (add a unique tie-break)."""
    return top_k_per(df, partition, order, 1)


def top_k_per(
    df: DataFrame,
    partition: Sequence[str],
    order: Sequence[ColumnOrName | tuple[str, str]],
    k: int,
    rank_col: str = "rank",
) -> DataFrame:
    """Top ``k`` rows per category with their rank."""
    w = Window.partitionBy(*partition).orderBy(*_order(order))
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def argmax_row(df: DataFrame, by: str | Sequence[str], cols: Sequence[str]) -> DataFrame:
    """The row holding the maximum of ``by`` (one partial aggregate).

    ``by`` may list tie-break columns after the main one (compared as a
    struct, left to right)."""
    keys = [by] if isinstance(by, str) else list(by)
    order = F.struct(*[F.col(c) for c in keys]) if len(keys) > 1 else F.col(keys[0])
    best = F.max_by(F.struct(*[F.col(c) for c in cols]), order)
    return df.agg(best.alias("__best")).select("__best.*")


def ranked(df: DataFrame, by: Sequence[ColumnOrName | tuple[str, str]], k: int, rank_col: str = "rank") -> DataFrame:
    """Top-k with its position 1..k.

    The rank is computed over the k rows left after the top-k (a single
    small partition), never over the whole input.
    """
    top = top_k(df, by, k)
    w = Window.orderBy(*_order(by))
    return top.withColumn(rank_col, F.row_number().over(w))


def top_k_with_pinned(
    df: DataFrame,
    key: str,
    by: str,
    k: int,
    needle: str,
) -> DataFrame:
    """Top-k rows by ``by`` plus the first row whose key contains
    ``needle`` (case-insensitive), de-duplicated, sorted by ``by`` desc.

    One read of ``df``: each row goes to the list of all rows and, if it
    matches, to that of the pinned ones; both are limited before the
    shuffle, and only k + 1 rows are left to sort."""
    hit = F.lower(F.col(key)).contains(needle.lower())
    lists = F.explode(F.array_compact(F.array(F.lit(0), F.when(hit, F.lit(1)))))
    w = Window.partitionBy("__list").orderBy(F.when(F.col("__list") == 0, F.col(by)).desc_nulls_last(), F.asc(key))
    ranked_rows = df.withColumn("__list", lists).withColumn("__rank", F.row_number().over(w))
    kept = ranked_rows.filter(F.col("__rank") <= F.lit(k))
    kept = kept.filter((F.col("__list") == 0) | (F.col("__rank") == 1)).select(df.columns).distinct()
    return kept.orderBy(F.desc_nulls_last(by), F.asc(key))
