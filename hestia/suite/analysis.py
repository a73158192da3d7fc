"""Registered queries: projections, filters, joins, aggregates, ranking, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from hestia.functions.rules import bin_labels
from hestia.operators import aggregate as A
from hestia.operators import joins as J
from hestia.operators import ranking as O
from hestia.operators import relational as P
from hestia.operators import setops as U
from hestia.sources.tables import listing_view, load
from hestia.suite.registry import register

# The area bands of the rooms-per-area table.
RATIO_EDGES = [150, 250]
RATIO_LABELS = ["100-150", "150-250", "250+"]


def ratio_rows(spark, sf):
    v = listing_view(spark, sf, text=False)
    return (
        v.filter(F.col("surface").isNotNull() & F.col("pieces").isNotNull() & (F.col("pieces") > 0))
        .withColumn("ratio_surface_piece", P.ratio("surface", "pieces"))
        .withColumn("surface_bin", bin_labels("surface", RATIO_EDGES, RATIO_LABELS))
    )


RATIO_SQL = """
R AS (
  SELECT type_bien,
         CASE WHEN surface < 150 THEN '100-150' WHEN surface < 250 THEN '150-250' ELSE '250+' END AS surface_bin,
         surface / pieces AS ratio_surface_piece
  FROM V WHERE surface IS NOT NULL AND pieces IS NOT NULL AND pieces > 0)
"""


@register(
    "group_stats",
    v=True,
    sql=", " + RATIO_SQL + """
SELECT type_bien, surface_bin, round(avg(ratio_surface_piece), 4) AS moyenne,
       round(quantile_disc(ratio_surface_piece, 0.5), 4) AS mediane, count(*) AS nb_obs
FROM R GROUP BY type_bien, surface_bin""",
)
def q_group_stats(spark, sf):
    return A.group_stats(ratio_rows(spark, sf), ["type_bien", "surface_bin"], "ratio_surface_piece")


@register(
    "group_stats_exact",
    v=True,
    sql=", " + RATIO_SQL + """
SELECT type_bien, surface_bin, round(avg(ratio_surface_piece), 4) AS moyenne,
       round(median(ratio_surface_piece), 4) AS mediane, count(*) AS nb_obs
FROM R GROUP BY type_bien, surface_bin""",
)
def q_group_stats_exact(spark, sf):
    return A.group_stats(ratio_rows(spark, sf), ["type_bien", "surface_bin"], "ratio_surface_piece", exact=True)


# ------------------------------------------------------------------ P1..P7
@register("project_listing", v=True, sql="SELECT titre, ville, prix FROM V")
def q_project_listing(spark, sf):
    return P.project(listing_view(spark, sf, text=False), ["titre", "ville", "prix"])


@register(
    "derive_ratio",
    v=True,
    sql="SELECT lien, prix / NULLIF(surface, 0) AS prix_m2 FROM V",
)
def q_derive_ratio(spark, sf):
    v = P.with_ratio(listing_view(spark, sf, text=False), "prix", "surface", "prix_m2")
    return v.select("lien", "prix_m2")


@register(
    "rename_cols",
    sql="SELECT c_custkey AS customer_id, c_name AS customer_name, c_nationkey, c_acctbal, c_mktsegment FROM customer",
)
def q_rename(spark, sf):
    return P.rename(load(spark, sf, "customer"), {"c_custkey": "customer_id", "c_name": "customer_name"})


@register("drop_cols", sql="SELECT p_partkey, p_brand, p_size, p_retailprice FROM part")
def q_drop(spark, sf):
    return P.drop_cols(load(spark, sf, "part"), ["p_name", "p_type"])


def unprefixed(df, prefix):
    return df.withColumnsRenamed({c: c[len(prefix):] for c in df.columns if c.startswith(prefix)})


@register("common_columns", sql="SELECT custkey AS key, name, nationkey, acctbal FROM (SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer)")
def q_common_columns(spark, sf):
    c = unprefixed(load(spark, sf, "customer"), "c_").withColumnRenamed("custkey", "key")
    s = unprefixed(load(spark, sf, "supplier"), "s_").withColumnRenamed("suppkey", "key")
    return c.select(*P.common_columns(c, s))


@register("numeric_columns", sql="SELECT p_size, p_retailprice FROM part")
def q_numeric_columns(spark, sf):
    part = load(spark, sf, "part")
    return part.select(*P.columns_of_type(part, exclude=["p_partkey"]))


def _schema_sql():
    from hestia.sources.tables import LISTING_COLUMNS

    kinds = {"etage": "int", "prix": "double", "surface": "double", "pieces": "int"}
    never_null = {"type_bien", "lien"}
    rows = [f"({i}, '{c}', '{kinds.get(c, 'string')}', {str(c not in never_null).lower()})" for i, c in enumerate(LISTING_COLUMNS, 1)]
    table = f"(VALUES {', '.join(rows)}) AS t(position, column_name, data_type, nullable)"
    return f"SELECT t.*, n_null FROM {table} JOIN ({_null_profile_sql()}) USING (column_name)"


def _null_profile_sql():
    from hestia.sources.tables import LISTING_COLUMNS

    parts = [
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM V"
        for c in LISTING_COLUMNS
    ]
    return "\nUNION ALL ".join(parts)


@register("schema_listing", v=True, sql=_schema_sql())
def q_schema_listing(spark, sf):
    v = listing_view(spark, sf)
    return P.schema_table(spark, v).join(A.null_profile(v), "column_name")


# ------------------------------------------------------------------ F1..F8
@register("filter_null", v=True, sql="SELECT lien, titre FROM V WHERE surface IS NULL")
def q_filter_null(spark, sf):
    return P.filter_null(listing_view(spark, sf, text=False), "surface").select("lien", "titre")


@register(
    "filter_null_keyword",
    v=True,
    sql="SELECT lien, etage FROM V WHERE etage IS NULL AND contains(lower(full_description), 'étage')",
)
def q_filter_null_keyword(spark, sf):
    v = listing_view(spark, sf)
    return P.null_but_mentions(v, "etage", "full_description", "étage").select("lien", "etage")


@register("filter_eq", v=True, sql="SELECT lien, prix FROM V WHERE type_bien = 'Maison'")
def q_filter_eq(spark, sf):
    return P.filter_eq(listing_view(spark, sf, text=False), "type_bien", "Maison").select("lien", "prix")


@register(
    "outlier_band",
    v=True,
    sql="""SELECT lien, prix, surface FROM V
WHERE prix / NULLIF(surface, 0) BETWEEN 500 AND 25000 AND surface < 925""",
)
def q_outlier_band(spark, sf):
    v = listing_view(spark, sf, text=False)
    return P.drop_outliers(v, "prix", "surface", 500, 25000, {"surface": 925}).select("lien", "prix", "surface")


@register("contains_ci", sql="SELECT p_partkey, p_name FROM part WHERE contains(lower(p_name), 'gear')")
def q_contains_ci(spark, sf):
    return P.contains_ci(load(spark, sf, "part"), "p_name", "GEAR").select("p_partkey", "p_name")


TAIL_COLS = ["surface", "pieces", "etage"]


TAIL_SQL = """, Q AS (SELECT quantile_cont(surface, 0.99) AS qs, quantile_cont(pieces, 0.99) AS qp,
                   quantile_cont(etage, 0.99) AS qe FROM V)
SELECT lien, surface, pieces, etage,
       concat_ws(',', CASE WHEN surface >= qs THEN 'surface' END, CASE WHEN pieces >= qp THEN 'pieces' END,
                 CASE WHEN etage >= qe THEN 'etage' END) AS tail_columns
FROM V, Q WHERE surface >= qs OR pieces >= qp OR etage >= qe"""


@register("tail_p99", v=True, sql=TAIL_SQL)
def q_tail_p99(spark, sf):
    t = P.tail_rows(listing_view(spark, sf, text=False), TAIL_COLS, 0.99, exact=True)
    return t.select("lien", *TAIL_COLS, F.array_join("tail_columns", ",").alias("tail_columns"))


@register("tail_p99_approx", v=True, sql=TAIL_SQL.replace("quantile_cont", "quantile_disc"))
def q_tail_p99_approx(spark, sf):
    t = P.tail_rows(listing_view(spark, sf, text=False), TAIL_COLS, 0.99, exact=False)
    return t.select("lien", *TAIL_COLS, F.array_join("tail_columns", ",").alias("tail_columns"))


@register(
    "assert_clean",
    v=True,
    sql=""", C AS (SELECT * FROM V WHERE prix / NULLIF(surface, 0) BETWEEN 500 AND 25000 AND surface < 925)
SELECT count(*) AS n_violations FROM C
WHERE prix / NULLIF(surface, 0) < 500 OR prix / NULLIF(surface, 0) > 25000 OR surface >= 925""",
)
def q_assert_clean(spark, sf):
    c = P.drop_outliers(listing_view(spark, sf, text=False), "prix", "surface", 500, 25000, {"surface": 925})
    r = P.ratio("prix", "surface")
    bad = P.violations(c, (r < 500) | (r > 25000) | (F.col("surface") >= 925))
    return bad.agg(F.count(F.lit(1)).alias("n_violations"))


@register("preview", v=True, sql="SELECT lien, prix, ville FROM V ORDER BY prix DESC, lien LIMIT 5")
def q_preview(spark, sf):
    v = listing_view(spark, sf, text=False).select("lien", "prix", "ville")
    return P.preview(v, 5, [F.desc("prix"), F.asc("lien")])


# ------------------------------------------------------------------ J1..J5
def _customers(spark, sf):
    return load(spark, sf, "customer").select(F.col("c_custkey").alias("custkey"))


def _urgent(spark, sf):
    o = load(spark, sf, "orders")
    return o.filter(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_custkey").alias("custkey"))


URGENT_SQL = "(SELECT o_custkey AS custkey FROM orders WHERE o_orderpriority = '1-URGENT')"


@register(
    "anti_keys",  # the question: which customers have no urgent order
    sql=f"SELECT DISTINCT c_custkey AS custkey FROM customer WHERE c_custkey NOT IN (SELECT custkey FROM {URGENT_SQL})",
)
def q_anti_keys(spark, sf):
    return J.unmatched_keys(_customers(spark, sf), _urgent(spark, sf), "custkey")


@register(
    "inner_keys",
    sql="SELECT DISTINCT c_custkey AS custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)",
)
def q_inner_keys(spark, sf):
    return J.matched_keys(_customers(spark, sf), load(spark, sf, "orders").select(F.col("o_custkey").alias("custkey")), "custkey")


@register(
    "dim_enrich",
    sql="""SELECT o.o_orderkey, o.o_custkey, c.c_mktsegment, c.c_nationkey
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey""",
)
def q_dim_enrich(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", "c_nationkey")
    return J.enrich(o, c, "o_custkey", ["c_mktsegment", "c_nationkey"])


# Fixed values for the alias check: two names fold into one, one renamed.
NATION_ALIASES = {"NATION_1": "NATION_1_2", "NATION_2": "NATION_1_2", "NATION_3": "NATION_THREE"}


@register(
    "alias_map",
    v=True,
    sql="""SELECT CASE WHEN ville = 'NATION_1' THEN 'NATION_1_2' WHEN ville = 'NATION_2' THEN 'NATION_1_2'
                  WHEN ville = 'NATION_3' THEN 'NATION_THREE' ELSE ville END AS ville, count(*) AS count
FROM V GROUP BY 1""",
)
def q_alias_map(spark, sf):
    v = listing_view(spark, sf, text=False).withColumn("ville", J.apply_aliases("ville", NATION_ALIASES))
    return A.group_count(v, ["ville"])


@register(
    "alias_map_table",
    v=True,
    sql="""SELECT CASE WHEN ville = 'NATION_1' THEN 'NATION_1_2' WHEN ville = 'NATION_2' THEN 'NATION_1_2'
                  WHEN ville = 'NATION_3' THEN 'NATION_THREE' ELSE ville END AS ville, count(*) AS count
FROM V GROUP BY 1""",
)
def q_alias_map_table(spark, sf):
    aliases = spark.createDataFrame(list(NATION_ALIASES.items()), "alias string, canonical string")
    v = J.apply_aliases_join(listing_view(spark, sf, text=False), "ville", aliases)
    return A.group_count(v, ["ville"])


@register(
    "match_report",
    sql=f"""WITH a AS (SELECT c_custkey AS custkey, count(*) AS n FROM customer GROUP BY 1),
b AS (SELECT o_custkey AS custkey, count(*) AS n FROM orders GROUP BY 1)
SELECT coalesce(a.custkey, b.custkey) AS custkey, coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows,
       CASE WHEN a.n IS NOT NULL AND b.n IS NOT NULL THEN 'both' WHEN a.n IS NOT NULL THEN 'left_only'
            ELSE 'right_only' END AS status
FROM a FULL OUTER JOIN b ON a.custkey = b.custkey""",
)
def q_match_report(spark, sf):
    return J.match_report(_customers(spark, sf), load(spark, sf, "orders").select(F.col("o_custkey").alias("custkey")), "custkey")


# ----------------------------------------------------------------- A1..A18
@register("row_count", v=True, sql="SELECT count(*) AS n_rows FROM V")
def q_row_count(spark, sf):
    return A.row_count(listing_view(spark, sf, text=False))


@register("null_profile", v=True, sql=_null_profile_sql())
def q_null_profile(spark, sf):
    return A.null_profile(listing_view(spark, sf))


@register("group_count", v=True, sql="SELECT type_bien, count(*) AS count FROM V GROUP BY 1")
def q_group_count(spark, sf):
    return A.group_count(listing_view(spark, sf, text=False), ["type_bien"])


@register(
    "group_count_expr",
    v=True,
    sql="SELECT lower(trim(ville)) AS ville_key, count(*) AS count FROM V GROUP BY 1",
)
def q_group_count_expr(spark, sf):
    return A.group_count(listing_view(spark, sf, text=False), [F.lower(F.trim("ville")).alias("ville_key")])


# The five area bands used for floors.
FLOOR_BAND_EDGES = [40, 70, 100, 150]
FLOOR_BAND_LABELS = ["<40", "40-70", "70-100", "100-150", "150+"]
FLOOR_BAND_SQL = """CASE WHEN surface < 40 THEN '<40' WHEN surface < 70 THEN '40-70' WHEN surface < 100 THEN '70-100'
     WHEN surface < 150 THEN '100-150' ELSE '150+' END"""


@register(
    "group_count_multi",
    v=True,
    sql=f"SELECT type_bien, {FLOOR_BAND_SQL} AS surface_bin, etage, count(*) AS count FROM V GROUP BY 1, 2, 3",
)
def q_group_count_multi(spark, sf):
    v = listing_view(spark, sf, text=False).withColumn("surface_bin", bin_labels("surface", FLOOR_BAND_EDGES, FLOOR_BAND_LABELS))
    return A.group_count(v, ["type_bien", "surface_bin", "etage"], order=["type_bien", "surface_bin", F.desc("count")])


@register("global_center", v=True, sql="SELECT round(median(prix), 2) AS median, round(avg(prix), 2) AS mean FROM V")
def q_global_center(spark, sf):
    return A.center(listing_view(spark, sf, text=False), "prix")


@register("group_mean", v=True, sql="SELECT ville, round(avg(prix), 4) AS mean FROM V WHERE ville IS NOT NULL GROUP BY 1")
def q_group_mean(spark, sf):
    return A.group_mean(listing_view(spark, sf, text=False), "ville", "prix")


@register(
    "ratio_mean_top",
    v=True,
    sql="""SELECT ville, round(avg(prix / NULLIF(surface, 0)), 4) AS mean_ratio FROM V WHERE ville IS NOT NULL
GROUP BY 1 HAVING avg(prix / NULLIF(surface, 0)) IS NOT NULL ORDER BY mean_ratio DESC, ville LIMIT 10""",
)
def q_ratio_mean_top(spark, sf):
    return A.top_ratio_mean(listing_view(spark, sf, text=False), "ville", "prix", "surface", 10)


QUANTILE_PROBS = [0.25, 0.5, 0.99]


def _quantile_sql(fn="quantile_cont"):
    parts = []
    for c in ["surface", "pieces"]:
        for p in QUANTILE_PROBS:
            parts.append(
                f"SELECT '{c}' AS column_name, CAST({p} AS DOUBLE) AS prob, round({fn}({c}, {p}), 4) AS value FROM V"
            )
    return "\nUNION ALL ".join(parts)


@register("quantiles", v=True, sql=_quantile_sql())
def q_quantiles(spark, sf):
    q = A.quantiles(listing_view(spark, sf, text=False), ["surface", "pieces"], QUANTILE_PROBS, exact=True)
    return q.withColumn("value", F.round("value", 4))


@register("quantiles_approx", v=True, sql=_quantile_sql("quantile_disc"))
def q_quantiles_approx(spark, sf):
    return A.quantiles(listing_view(spark, sf, text=False), ["surface", "pieces"], QUANTILE_PROBS, exact=False)


def _describe_sql():
    parts = []
    for c in ["prix", "surface", "pieces"]:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count({x}) AS count, round(avg({x}), 4) AS mean, "
            f"round(stddev_samp({x}), 4) AS stddev, min({x}) AS min, max({x}) AS max FROM V"
        )
    return "\nUNION ALL ".join(parts)


@register("describe_table", v=True, sql=_describe_sql())
def q_describe(spark, sf):
    return A.describe_table(listing_view(spark, sf, text=False), ["prix", "surface", "pieces"])


@register(
    "dup_totals",
    sql="""SELECT count(*) AS total_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_rows,
       count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS duplicates FROM lineitem""",
)
def q_dup_totals(spark, sf):
    return A.duplicate_totals(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("dup_groups", sql="SELECT text, count(*) AS count FROM documents GROUP BY text HAVING count(*) > 1")
def q_dup_groups(spark, sf):
    return A.duplicate_groups(load(spark, sf, "documents"), ["text"])


@register("dedup_rows", sql="SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def q_dedup_rows(spark, sf):
    return U.distinct_rows(load(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@register(
    "type_share",
    sql="""SELECT o_orderpriority, count(*) AS count, round(count(*) / (SELECT count(*) FROM orders), 6) AS share
FROM orders GROUP BY 1""",
)
def q_type_share(spark, sf):
    return A.share(load(spark, sf, "orders"), "o_orderpriority")


def histogram_sql(source: str, col: str, bins: int) -> str:
    return f"""HB AS (SELECT min({col}) AS lo, max({col}) AS hi FROM {source} WHERE {col} IS NOT NULL),
HH AS (SELECT CAST(least(coalesce(floor(({col} - lo) / NULLIF((hi - lo) / {bins}, 0)), 0), {bins - 1}) AS INTEGER) AS bin,
             lo, (hi - lo) / {bins} AS w FROM {source}, HB WHERE {col} IS NOT NULL)
SELECT bin, round(any_value(lo) + bin * any_value(w), 4) AS bin_lo,
       round(any_value(lo) + (bin + 1) * any_value(w), 4) AS bin_hi, count(*) AS count FROM HH GROUP BY bin"""


@register("price_histogram", v=True, sql=", " + histogram_sql("V", "prix", 50))
def q_price_histogram(spark, sf):
    return A.histogram(listing_view(spark, sf, text=False), "prix", 50)



@register(
    "collect_by_key",
    v=True,
    sql="SELECT ville, pieces AS value, count(*) AS n FROM V WHERE pieces IS NOT NULL GROUP BY ville, pieces",
)
def q_collect_by_key(spark, sf):
    v = listing_view(spark, sf, text=False).filter(F.col("pieces").isNotNull())
    g = A.group_by_key(v, "ville", "pieces", ["lien"])
    # The lists' contents, compared as counts of each value.
    return g.select("ville", F.explode("values").alias("value")).groupBy("ville", "value").agg(F.count(F.lit(1)).alias("n"))


@register("fold_by_key", v=True, sql="SELECT ville, round(sum(prix), 2) AS value FROM V GROUP BY ville")
def q_fold_by_key(spark, sf):
    r = A.reduce_by_key(listing_view(spark, sf, text=False), "ville", "prix", "sum")
    return r.withColumn("value", F.round("value", 2))


MODE_SQL = f""", C AS (SELECT type_bien, {FLOOR_BAND_SQL} AS surface_bin, etage, count(*) AS count
           FROM V WHERE etage IS NOT NULL GROUP BY 1, 2, 3)
SELECT type_bien, surface_bin, etage, count FROM (
  SELECT *, row_number() OVER (PARTITION BY type_bien, surface_bin ORDER BY count DESC, etage) AS rn FROM C)
WHERE rn = 1"""


@register("mode_per_group", v=True, sql=MODE_SQL)
def q_mode_per_group(spark, sf):
    v = listing_view(spark, sf, text=False).withColumn("surface_bin", bin_labels("surface", FLOOR_BAND_EDGES, FLOOR_BAND_LABELS))
    return A.mode_per_group(v, ["type_bien", "surface_bin"], "etage").select("type_bien", "surface_bin", "etage", "count")


@register("mode_window", v=True, sql=MODE_SQL)
def q_mode_window(spark, sf):
    v = listing_view(spark, sf, text=False).withColumn("surface_bin", bin_labels("surface", FLOOR_BAND_EDGES, FLOOR_BAND_LABELS))
    counts = A.group_value_counts(v, ["type_bien", "surface_bin"], "etage")
    top = O.top_row(counts, ["type_bien", "surface_bin"], [("count", "desc"), ("etage", "asc")])
    return top.select("type_bien", "surface_bin", "etage", "count")


# ----------------------------------------------------------------- O1..O7
@register("sort_one", sql="SELECT o_orderkey, o_totalprice FROM orders")
def q_sort_one(spark, sf):
    return O.sort_by(load(spark, sf, "orders").select("o_orderkey", "o_totalprice"), [("o_totalprice", "desc")])


@register(
    "sort_multi",
    v=True,
    sql="SELECT type_bien, ville, count(*) AS count FROM V GROUP BY 1, 2",
)
def q_sort_multi(spark, sf):
    c = A.group_count(listing_view(spark, sf, text=False), ["type_bien", "ville"])
    return O.sort_by(c, [("type_bien", "asc"), ("count", "desc"), ("ville", "asc")])


@register(
    "topk",
    sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10",
)
def q_topk(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return O.top_k(o, [("o_totalprice", "desc"), ("o_orderkey", "asc")], 10)


@register(
    "topk_per_type",
    v=True,
    sql="""SELECT type_bien, lien, prix, rank FROM (
  SELECT type_bien, lien, prix, row_number() OVER (PARTITION BY type_bien ORDER BY prix DESC, lien) AS rank FROM V
  WHERE contains(lower(type_bien), 'maison') OR contains(lower(type_bien), 'appart'))
WHERE rank <= 10""",
)
def q_topk_per_type(spark, sf):
    v = listing_view(spark, sf, text=False)
    v = v.filter(F.lower("type_bien").contains("maison") | F.lower("type_bien").contains("appart"))
    t = O.top_k_per(v, ["type_bien"], [("prix", "desc"), ("lien", "asc")], 10)
    return t.select("type_bien", "lien", "prix", F.col("rank").cast("bigint").alias("rank"))


@register(
    "argmax_row",
    sql="SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 1",
)
def q_argmax_row(spark, sf):
    o = load(spark, sf, "orders")
    return O.argmax_row(o, ["o_totalprice", "o_orderkey"], ["o_orderkey", "o_totalprice"])


@register(
    "ranked_topk",
    sql="""SELECT p_partkey, p_retailprice, row_number() OVER (ORDER BY p_retailprice DESC, p_partkey) AS rank
FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20""",
)
def q_ranked_topk(spark, sf):
    p = load(spark, sf, "part").select("p_partkey", "p_retailprice")
    r = O.ranked(p, [("p_retailprice", "desc"), ("p_partkey", "asc")], 20)
    return r.withColumn("rank", F.col("rank").cast("bigint"))


@register(
    "topk_plus_pinned",
    v=True,
    sql=""", M AS (SELECT ville, round(avg(prix), 4) AS mean FROM V WHERE ville IS NOT NULL GROUP BY 1)
SELECT DISTINCT * FROM (
  (SELECT * FROM M ORDER BY mean DESC, ville LIMIT 10)
  UNION ALL
  (SELECT * FROM M WHERE contains(lower(ville), 'nation_1') ORDER BY ville LIMIT 1))""",
)
def q_topk_plus_pinned(spark, sf):
    m = A.group_mean(listing_view(spark, sf, text=False), "ville", "prix")
    return O.top_k_with_pinned(m, "ville", "mean", 10, "NATION_1")


# ------------------------------------------------------------------ U1..U4
def _parties(spark, sf):
    c = unprefixed(load(spark, sf, "customer"), "c_").withColumnRenamed("custkey", "key")
    s = unprefixed(load(spark, sf, "supplier"), "s_").withColumnRenamed("suppkey", "key")
    return c, s


@register(
    "union_missing",
    sql="""SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS mktsegment FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL FROM supplier""",
)
def q_union_missing(spark, sf):
    c, s = _parties(spark, sf)
    return U.union_loose(c, s)


@register(
    "union_common",
    sql="""SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
)
def q_union_common(spark, sf):
    c, s = _parties(spark, sf)
    return U.union_common(c, s)


@register(
    "concat_dedup",
    sql="""SELECT DISTINCT * FROM (
  (SELECT c_custkey AS key, c_name AS name, c_acctbal AS acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 10)
  UNION ALL
  (SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_nationkey = 3))""",
)
def q_concat_dedup(spark, sf):
    c, _ = _parties(spark, sf)
    c = c.select("key", "name", "acctbal", "nationkey")
    top = O.top_k(c, [("acctbal", "desc"), ("key", "asc")], 10).drop("nationkey")
    n3 = c.filter(F.col("nationkey") == 3).drop("nationkey")
    return U.concat_dedup(top, n3)
