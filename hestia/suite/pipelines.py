"""Registered queries: fusion (E2) and the market report."""

from __future__ import annotations

from pyspark.sql import functions as F

from hestia.functions.text import floor_label, fold_accents
from hestia.plans import fuse as E2
from hestia.plans import market as E3
from hestia.plans.clean import clean_listings
from hestia.session import ensure_checkpoint_dir, scratch_dir
from hestia.sources import csv as CSV
from hestia.sources.tables import listing_view, load
from hestia.suite.registry import register
from hestia.suite.textops import CLEAN_SQL, FOLD_SQL
from hestia.suite.analysis import histogram_sql


def place_lines(spark, sf):
    """``Name (code)`` lines, one per nation (the place dimension's input)."""
    n = load(spark, sf, "nation")
    return n.select(
        F.concat(F.col("n_name"), F.lit(" ("), (F.col("n_nationkey") + 69000).cast("string"), F.lit(")")).alias("line")
    )


def place_dim(spark, sf):
    return E2.place_dimension(place_lines(spark, sf))


def first_source(spark, sf):
    return clean_listings(listing_view(spark, sf))


def second_source(spark, sf):
    """The second site's cleaned format, derived from ``V``."""
    v = listing_view(spark, sf, text=False)
    # One code per place, so that a repeated place never multiplies ads.
    d = place_dim(spark, sf).groupBy(F.col("ville").alias("__v")).agg(F.min("code_postal").alias("code_postal"))
    j = v.join(d, fold_accents("ville") == F.col("__v"), "left")
    kind = F.lower("type_bien")
    return j.select(
        "prix",
        kind.alias("type_clean"),
        floor_label(kind, "etage").alias("etage_clean"),
        "surface",
        F.col("pieces").cast("double").alias("pieces"),
        "ville",
        F.col("code_postal").cast("int").alias("code_postal"),
    )


def fused(spark, sf):
    return E2.fuse_listings(first_source(spark, sf), second_source(spark, sf), place_dim(spark, sf))


PLACE_NAME_X = r"regexp_extract(ville_brute, '(.*)\s\((\d+)\)', 1)"


def fold(x):
    return FOLD_SQL.format(x=x)


def _alias_case() -> str:
    def q(s):
        return "'" + s.replace("'", "''") + "'"

    parts = " ".join(f"WHEN ville = {q(k)} THEN {q(v)}" for k, v in E2.PLACE_ALIASES.items())
    return f"CASE {parts} ELSE ville END"


FUSED_SQL = CLEAN_SQL + rf""", DIM AS (
  SELECT trim(lower(n_name || ' (' || CAST(n_nationkey + 69000 AS VARCHAR) || ')')) AS ville_brute FROM nation),
DIM2 AS (SELECT ville_brute, regexp_extract(ville_brute, '(.*)\s\((\d+)\)', 1) AS ville_og,
                {fold(PLACE_NAME_X)} AS ville,
                regexp_extract(ville_brute, '(.*)\s\((\d+)\)', 2) AS code_postal FROM DIM),
A1 AS (SELECT * REPLACE (trim(regexp_replace({fold('ville')}, '\s*\d+e\b', '', 'g')) AS ville,
                          lower(type_bien) AS type_bien) FROM CLEAN),
A2 AS (SELECT * REPLACE ({_alias_case()} AS ville) FROM A1),
A3 AS (SELECT * REPLACE (CASE WHEN type_bien = 'maison' THEN 'MAISON' WHEN etage = 0 THEN 'RDC'
                              ELSE CAST(etage AS VARCHAR) END AS etage) FROM A2),
A4 AS (SELECT A3.*, d.code_postal FROM A3 LEFT JOIN (SELECT ville, min(code_postal) AS code_postal
                                                     FROM DIM2 GROUP BY ville) d ON A3.ville = d.ville),
B AS (SELECT prix, lower(type_bien) AS type_clean,
             CASE WHEN lower(type_bien) = 'maison' THEN 'MAISON' WHEN etage = 0 THEN 'RDC'
                  ELSE CAST(etage AS VARCHAR) END AS etage_clean,
             surface, CAST(pieces AS DOUBLE) AS pieces, V.ville AS ville, CAST(d.code_postal AS INTEGER) AS code_postal
      FROM V LEFT JOIN DIM2 d ON {fold('V.ville')} = d.ville),
B2 AS (SELECT prix, type_clean AS type_bien, etage_clean AS etage, surface, pieces, {fold('ville')} AS ville,
              CAST(code_postal AS VARCHAR) AS code_postal FROM B),
FUSED AS (SELECT DISTINCT * FROM (
  SELECT * FROM B2
  UNION ALL SELECT prix, type_bien, etage, surface, pieces, ville, code_postal FROM A4))
"""


@register("fuse_listings", v=True, sql=FUSED_SQL + "SELECT * FROM FUSED")
def q_fuse(spark, sf):
    return fused(spark, sf)


@register("fuse_chain", v=True, sql=FUSED_SQL + "SELECT * REPLACE (CAST(code_postal AS INTEGER) AS code_postal) FROM FUSED")
def q_fuse_chain(spark, sf):
    """Both sources through their files: raw CSV (S1) → E1 → CSV (K1) → inferred
    (S2); the second site's CSV with ``;`` (S3) → E2 → CSV (K1) → inferred (S4).
    The files between are compressed: two of them hold every ad's whole text."""
    root = scratch_dir(spark, "fuse-chain")
    CSV.write_csv(listing_view(spark, sf), f"{root}/raw", bom=True, compression="gzip")
    CSV.write_csv(clean_listings(CSV.read_listings_csv(spark, f"{root}/raw")), f"{root}/clean", compression="gzip")
    CSV.write_csv(second_source(spark, sf), f"{root}/second", sep=";", compression="gzip")
    first = CSV.read_csv_inferred(spark, f"{root}/clean")
    second = CSV.read_csv_inferred(spark, f"{root}/second", sep=";")
    CSV.write_csv(E2.fuse_listings(first, second, place_dim(spark, sf)), f"{root}/fused", compression="gzip")
    return CSV.read_csv_inferred(spark, f"{root}/fused")


@register(
    "fuse_dup_groups",
    v=True,
    sql=FUSED_SQL.replace("FUSED AS (SELECT DISTINCT * FROM", "FUSED AS (SELECT * FROM")
    + "SELECT *, count(*) AS count FROM FUSED GROUP BY ALL HAVING count(*) > 1",
)
def q_fuse_dup_groups(spark, sf):
    from hestia.operators.aggregate import duplicate_groups

    u = E2.fuse_listings(first_source(spark, sf), second_source(spark, sf), place_dim(spark, sf), dedup=False)
    return duplicate_groups(u, u.columns)


@register(
    "fuse_dup_totals",
    v=True,
    sql=FUSED_SQL.replace("FUSED AS (SELECT DISTINCT * FROM", "FUSED AS (SELECT * FROM")
    + """, G AS (SELECT count(*) AS n FROM FUSED GROUP BY prix, type_bien, etage, surface, pieces, ville, code_postal)
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(*) AS distinct_rows, CAST(sum(n) AS BIGINT) - count(*) AS duplicates FROM G""",
)
def q_fuse_dup_totals(spark, sf):
    from hestia.operators.aggregate import duplicate_totals

    u = E2.fuse_listings(first_source(spark, sf), second_source(spark, sf), place_dim(spark, sf), dedup=False)
    return duplicate_totals(u)


@register(
    "fuse_union_missing",
    v=True,
    sql=FUSED_SQL + """SELECT count(*) AS n_rows, count(*) FILTER (WHERE titre IS NULL) AS n_null_titre FROM (
  SELECT prix, type_bien, etage, surface, pieces, ville, CAST(code_postal AS VARCHAR) AS code_postal,
         NULL AS titre FROM B2
  UNION ALL SELECT prix, type_bien, etage, surface, pieces, ville, code_postal, titre FROM A4)""",
)
def q_fuse_union_missing(spark, sf):
    from hestia.operators.setops import union_loose

    a = E2.conform_first(first_source(spark, sf), place_dim(spark, sf))
    b = E2.conform_second(second_source(spark, sf)).withColumn("code_postal", F.col("code_postal").cast("string"))
    u = union_loose(b, a)
    return u.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("titre").isNull()).alias("n_null_titre"))


@register(
    "place_dimension",
    sql=r"""WITH DIM AS (SELECT trim(lower(n_name || ' (' || CAST(n_nationkey + 69000 AS VARCHAR) || ')')) AS ville_brute FROM nation)
SELECT ville_brute, regexp_extract(ville_brute, '(.*)\s\((\d+)\)', 1) AS ville_og,
       """ + fold(r"regexp_extract(ville_brute, '(.*)\s\((\d+)\)', 1)") + r""" AS ville,
       regexp_extract(ville_brute, '(.*)\s\((\d+)\)', 2) AS code_postal FROM DIM""",
)
def q_place_dimension(spark, sf):
    return place_dim(spark, sf)


# --------------------------------------------------------------------- E3
@register(
    "market_share",
    v=True,
    sql=FUSED_SQL + """SELECT type_bien, count(*) AS count, round(count(*) / (SELECT count(*) FROM FUSED), 6) AS share
FROM FUSED GROUP BY 1""",
)
def q_market_share(spark, sf):
    return E3.type_share(fused(spark, sf))


@register("market_price_hist", v=True, sql=FUSED_SQL + ", " + histogram_sql("FUSED", "prix", 50))
def q_market_hist(spark, sf):
    return E3.price_histogram(fused(spark, sf), 50)


@register(
    "market_center",
    v=True,
    sql=FUSED_SQL + "SELECT round(median(prix), 0) AS median_price, round(avg(prix), 2) AS mean_price FROM FUSED",
)
def q_market_center(spark, sf):
    # The median reads the prices more than once: they are written once, E1 and E2 run once.
    ensure_checkpoint_dir(spark)
    return E3.price_center(fused(spark, sf).select("prix").checkpoint())


@register(
    "market_top_cities",
    v=True,
    sql=FUSED_SQL + """, M AS (SELECT ville, round(avg(prix), 4) AS prix FROM FUSED WHERE ville IS NOT NULL GROUP BY 1)
SELECT DISTINCT * FROM (
  (SELECT * FROM M ORDER BY prix DESC, ville LIMIT 10)
  UNION ALL (SELECT * FROM M WHERE contains(lower(ville), 'nation_1') ORDER BY ville LIMIT 1))""",
)
def q_market_top_cities(spark, sf):
    return E3.top_cities(fused(spark, sf), 10, "nation_1")


@register(
    "market_top_per_type",
    v=True,
    sql=FUSED_SQL + """, K AS (
  SELECT *, 'maison' AS kind FROM FUSED WHERE contains(lower(type_bien), 'maison')
  UNION ALL SELECT *, 'appart' AS kind FROM FUSED WHERE contains(lower(type_bien), 'appart'))
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY prix DESC, type_bien NULLS FIRST, etage NULLS FIRST,
                   surface NULLS FIRST, pieces NULLS FIRST, ville NULLS FIRST, code_postal NULLS FIRST) AS rank FROM K) WHERE rank <= 10""",
)
def q_market_top_per_type(spark, sf):
    return E3.top_per_type(fused(spark, sf)).withColumn("rank", F.col("rank").cast("bigint"))


@register(
    "market_m2_top",
    v=True,
    sql=FUSED_SQL + """SELECT ville, round(avg(prix / NULLIF(surface, 0)), 4) AS prix_m2 FROM FUSED WHERE ville IS NOT NULL
GROUP BY 1 HAVING avg(prix / NULLIF(surface, 0)) IS NOT NULL ORDER BY prix_m2 DESC, ville LIMIT 10""",
)
def q_market_m2_top(spark, sf):
    return E3.top_price_m2(fused(spark, sf))


@register("market_scatter", v=True, sql=FUSED_SQL + "SELECT prix, surface, type_bien, ville FROM FUSED")
def q_market_scatter(spark, sf):
    return E3.price_vs_area(fused(spark, sf))
