"""Raw page tables (S8) and paged URL frontiers.

Fetching pages over the network is not part of this library: pages arrive
as a table ``(page_id, url, html)`` that an external crawler landed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """A landed page table (Parquet), ``(page_id, url, html)``."""
    return spark.read.parquet(path).select("page_id", "url", "html")


def frontier_url(base: Column, page_no: Column, suffix: str) -> Column:
    """Page 1 is the base URL; page n appends ``suffix`` + n."""
    return F.when(page_no == 1, base).otherwise(F.concat(base, F.lit(suffix), page_no.cast("string")))


def frontiers(sites: DataFrame, base_col: str, n_col: str, suffix: str = "&page=") -> DataFrame:
    """S9 for many sites: one row per (site, page) from a table of
    ``(base, n_pages)``; each site's pages come from ``sequence``."""
    pages = sites.select(base_col, F.explode(F.sequence(F.lit(1), F.col(n_col).cast("int"))).alias("page_no"))
    return pages.withColumn("url", frontier_url(F.col(base_col), F.col("page_no"), suffix))


def until_empty(pages: DataFrame, site: str, page_no: str, empty: Column) -> DataFrame:
    """H8 for many sites: the pages of each site before its first empty one.

    A collector stops a site at the first result page that holds no card; here
    the smallest such page number of each site is one partial aggregate, joined
    back. A page number that is missing is no empty page; a site without an
    empty page keeps all; a null ``empty`` counts as not empty, and pages
    without a number are kept only where the site has no empty page.
    """
    stops = pages.filter(empty).groupBy(F.col(site).alias("__site")).agg(F.min(page_no).alias("__stop"))
    joined = pages.join(stops, F.col(site).eqNullSafe(F.col("__site")), "left")
    return joined.filter(F.col("__stop").isNull() | (F.col(page_no) < F.col("__stop"))).select(*[pages[c] for c in pages.columns])
