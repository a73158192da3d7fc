"""Market statistics behind the report's charts.

Each statistic is its own DataFrame so a caller writes (or shows) only
what it needs; all are aggregates with partial phases or top-k plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hestia.operators import aggregate as A
from hestia.operators import ranking as O


def type_share(df: DataFrame) -> DataFrame:
    """Share of ads per property type (pie chart)."""
    return A.share(df, "type_bien")


def price_histogram(df: DataFrame, bins: int = 50) -> DataFrame:
    """Equal-width price histogram (the chart's bin count, made exact)."""
    return A.histogram(df, "prix", bins)


def price_center(df: DataFrame) -> DataFrame:
    """Median (rounded to units) and mean (2 decimals) price."""
    c = A.center(df, "prix", None)
    return c.select(F.round("median", 0).alias("median_price"), F.round("mean", 2).alias("mean_price"))


def top_cities(df: DataFrame, k: int = 10, pinned: str = "lyon") -> DataFrame:
    """Top-k cities by mean price plus the first city naming ``pinned``."""
    means = A.group_mean(df, "ville", "prix", "prix")
    return O.top_k_with_pinned(means, "ville", "prix", k, pinned)


def top_per_type(df: DataFrame, k: int = 10, kinds=("maison", "appart")) -> DataFrame:
    """Top-k ads by price for each kind (substring of the type, any case)."""
    # One pass over the input: each row carries the kinds it matches (a row
    # may match several), exploded, then ranked per kind.
    low = F.lower("type_bien")
    matched = F.array_compact(F.array(*[F.when(low.contains(k), F.lit(k)) for k in kinds]))
    parts = df.withColumn("kind", F.explode(matched))
    order = [("prix", "desc")] + [(c, "asc") for c in df.columns if c != "prix"]
    return O.top_k_per(parts, ["kind"], order, k)


def top_price_m2(df: DataFrame, k: int = 10) -> DataFrame:
    """Top-k cities by mean price per m²."""
    return A.top_ratio_mean(df, "ville", "prix", "surface", k, "prix_m2")


def price_vs_area(df: DataFrame) -> DataFrame:
    """The scatter's rows: price, area, type, city."""
    return df.select("prix", "surface", "type_bien", "ville")


def market_report(df: DataFrame) -> dict[str, DataFrame]:
    """All statistics over one input, persisted once (every statistic reads
    it; the caller unpersists when done)."""
    from hestia.operators.relational import cached

    df = cached(df)
    return {
        "type_share": type_share(df),
        "price_histogram": price_histogram(df),
        "price_center": price_center(df),
        "top_cities": top_cities(df),
        "top_per_type": top_per_type(df),
        "top_price_m2": top_price_m2(df),
        "price_vs_area": price_vs_area(df),
    }
