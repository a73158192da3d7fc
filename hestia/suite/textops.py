"""Registered queries: text and cleaning functions (T1–T28) and E1, E4."""

from __future__ import annotations

from pyspark.sql import functions as F

from hestia.functions import rules as R
from hestia.functions import text as T
from hestia.operators import aggregate as A
from hestia.plans import clean as C
from hestia.plans.words import top_words, word_count, word_pairs
from hestia.sources.tables import listing_view, load
from hestia.suite.registry import register

# ------------------------------------------------------------- SQL pieces
FOLD_SQL = "trim(translate(lower({x}), 'àâäéèêëîïôöùûüç-', 'aaaeeeeiioouuuc '))"


def sql_any(col: str, needles) -> str:
    return "(" + " OR ".join(f"contains({col}, '{n}')" for n in needles) + ")"


def dpe_sql() -> str:
    lf = "lower(full_description)"
    steps = [f"WHEN DPE IS NULL AND {sql_any(lf, n)} THEN '{lab}'" for n, lab in C.DPE_RULES]
    unknown = f"({sql_any(lf, C.DPE_UNKNOWN)} OR NOT contains({lf}, 'dpe') OR full_description IS NULL)"
    steps.append(f"WHEN DPE IS NULL AND {unknown} THEN '{C.DPE_UNKNOWN_LABEL}'")
    return "CASE " + " ".join(steps) + " ELSE DPE END"


def rooms_sql() -> str:
    steps = []
    for t, rs in C.ROOM_RATIOS.items():
        bands = [f"surface < {C.ROOM_EDGES[0]}", f"surface < {C.ROOM_EDGES[1]}", f"surface >= {C.ROOM_EDGES[1]}"]
        for b, r in zip(bands, rs):
            steps.append(f"WHEN pieces IS NULL AND type_bien = '{t}' AND {b} THEN round(surface / {r})")
    return "CAST(CASE " + " ".join(steps) + " ELSE pieces END AS DOUBLE)"


def top_floor_sql() -> str:
    return f"CASE WHEN etage IS NULL AND {sql_any('lower(full_description)', C.TOP_FLOOR_WORDS)} THEN -1 ELSE etage END"


FLOOR_DEFAULT_SQL = (
    "CASE WHEN etage IS NULL AND type_bien = 'Appartement' THEN 1 "
    "WHEN etage IS NULL AND type_bien = 'Maison' THEN 0 ELSE etage END"
)
SALE_PREFIX_SQL = r"trim(regexp_replace(lower(ville), 'vente\s+(appartement|maison)?\s*', '', 'g'))"

CLEAN_SQL = f""", S1 AS (SELECT * REPLACE ({dpe_sql()} AS DPE) FROM V),
S2 AS (SELECT * REPLACE (coalesce(full_description, description) AS full_description) FROM S1),
S3 AS (SELECT * REPLACE ({rooms_sql()} AS pieces) FROM S2),
S4 AS (SELECT * REPLACE ({top_floor_sql()} AS etage) FROM S3),
S5 AS (SELECT * REPLACE ({FLOOR_DEFAULT_SQL} AS etage) FROM S4),
CLEAN AS (SELECT * REPLACE ({SALE_PREFIX_SQL} AS ville) FROM S5
          WHERE prix / NULLIF(surface, 0) BETWEEN 500 AND 25000 AND surface < 925)
"""


# ------------------------------------------------------------------ T1..T3
@register(
    "fold_city",
    sql=f"""SELECT doc_id, md5({FOLD_SQL.format(x='text')}) AS folded_md5,
       length({FOLD_SQL.format(x='text')}) AS folded_len FROM documents""",
)
def q_fold_city(spark, sf):
    d = load(spark, sf, "documents").select("doc_id", T.fold_accents("text").alias("f"))
    return d.select("doc_id", F.md5("f").alias("folded_md5"), F.length("f").alias("folded_len"))


@register(
    "strip_prefix",
    v=True,
    sql=r"""SELECT lien, trim(regexp_replace(lower(titre), 'vente\s+(appartement|maison)?\s*', '', 'g')) AS place,
       trim(regexp_replace(lower(description), '\s*\d+e\b', '', 'g')) AS no_district FROM V""",
)
def q_strip_prefix(spark, sf):
    v = listing_view(spark, sf)
    return v.select(
        "lien",
        F.trim(T.strip_pattern(F.lower("titre"), T.SALE_PREFIX)).alias("place"),
        F.trim(T.strip_pattern(F.lower("description"), T.DISTRICT_SUFFIX)).alias("no_district"),
    )


# ------------------------------------------------------------------ T6..T11
@register("case_cascade", v=True, sql=f"SELECT {dpe_sql()} AS DPE, count(*) AS count FROM V GROUP BY 1")
def q_case_cascade(spark, sf):
    v = listing_view(spark, sf)
    dpe = C.dpe_inference(F.col("DPE"), F.lower("full_description"), C.CleaningRules())
    return A.group_count(v, [dpe.alias("DPE")])


@register(
    "bin_labels",
    v=True,
    sql="""SELECT CASE WHEN surface < 40 THEN '<40' WHEN surface < 70 THEN '40-70' WHEN surface < 100 THEN '70-100'
     WHEN surface < 150 THEN '100-150' ELSE '150+' END AS surface_bin, count(*) AS count FROM V GROUP BY 1""",
)
def q_bin_labels(spark, sf):
    return A.group_count(C.with_surface_bin(listing_view(spark, sf)), ["surface_bin"])


@register(
    "fill_from",
    v=True,
    sql="""SELECT lien, md5(coalesce(full_description, description)) AS text_md5,
       full_description IS NULL AS filled FROM V""",
)
def q_fill_from(spark, sf):
    v = listing_view(spark, sf)
    return v.select(
        "lien",
        F.md5(R.fill_from("full_description", "description")).alias("text_md5"),
        F.col("full_description").isNull().alias("filled"),
    )


@register("fill_category", v=True, sql=f"SELECT {FLOOR_DEFAULT_SQL} AS etage, count(*) AS count FROM V GROUP BY 1")
def q_fill_category(spark, sf):
    v = listing_view(spark, sf).withColumn("etage", R.fill_by_category("etage", "type_bien", C.FLOOR_DEFAULTS))
    return A.group_count(v, ["etage"])


@register(
    "fill_ratio",
    v=True,
    sql=f"SELECT type_bien, {rooms_sql()} AS pieces, count(*) AS count FROM V GROUP BY 1, 2",
)
def q_fill_ratio(spark, sf):
    rooms = C.rooms_by_ratio(F.col("pieces"), F.col("surface"), F.col("type_bien"), C.ROOM_EDGES, C.ROOM_RATIOS)
    v = listing_view(spark, sf).withColumn("pieces", rooms.cast("double"))
    return A.group_count(v, ["type_bien", "pieces"])


# The fitted form: the median area per room of each type and band, as the sketch gives it (an observed value).
def _band_sql():
    cases = " ".join(f"WHEN surface < {e} THEN {i}" for i, e in enumerate(C.ROOM_EDGES))
    return f"CASE {cases} ELSE {len(C.ROOM_EDGES)} END"


RATIOS_SQL = f""", RB AS (SELECT type_bien, {_band_sql()} AS band, quantile_disc(surface / pieces, 0.5) AS ratio FROM V
  WHERE surface IS NOT NULL AND pieces > 0 AND type_bien IN ('Appartement', 'Maison') GROUP BY 1, 2)"""
FITTED_ROOMS_SQL = """CASE WHEN pieces IS NULL THEN round(surface / NULLIF(
  (SELECT ratio FROM RB WHERE RB.type_bien = {t}.type_bien AND RB.band = """ + _band_sql().replace("surface", "{t}.surface") + """), 0)) ELSE CAST(pieces AS DOUBLE) END"""


@register(
    "fill_ratio_fitted",
    v=True,
    sql=RATIOS_SQL + f""", W AS (SELECT type_bien, {FITTED_ROOMS_SQL.format(t='V')} AS pieces FROM V)
SELECT type_bien, pieces, count(*) AS count FROM W GROUP BY 1, 2""",
)
def q_fill_ratio_fitted(spark, sf):
    v = C._fill_rooms_from_data(listing_view(spark, sf), C.ROOM_EDGES)
    return A.group_count(v, ["type_bien", "pieces"])


@register("fill_keywords", v=True, sql=f"SELECT {top_floor_sql()} AS etage, count(*) AS count FROM V GROUP BY 1")
def q_fill_keywords(spark, sf):
    v = listing_view(spark, sf).withColumn(
        "etage", R.fill_by_keywords("etage", "full_description", C.TOP_FLOOR_WORDS, C.TOP_FLOOR_VALUE)
    )
    return A.group_count(v, ["etage"])


# ----------------------------------------------------------------- T12..T17
def price_text(col):
    """Synthetic price text: thousands group split by a NBSP, then ' €'."""
    digits = F.floor(col).cast("bigint").cast("string")
    return F.concat(F.regexp_replace(digits, r"(\d{3})$", "\u00a0$1"), F.lit(" €"))


@register(
    "parse_price",
    v=True,
    sql=r"""SELECT lien, regexp_replace(CAST(CAST(floor(prix) AS BIGINT) AS VARCHAR), '(\d{3})$', chr(160) || '\1') || ' €' AS price_text,
       CAST(floor(prix) AS BIGINT) AS price FROM V""",
)
def q_parse_price(spark, sf):
    v = listing_view(spark, sf).select("lien", price_text(F.col("prix")).alias("price_text"))
    return v.withColumn("price", T.parse_price("price_text"))


@register(
    "parse_area",
    v=True,
    sql=r"""SELECT lien,
  TRY_CAST(replace(nullif(regexp_extract(titre, '(\d+(?:[.,]\d+)?)\s*m\S*', 1), ''), ',', '.') AS DOUBLE) AS area,
  TRY_CAST(replace(nullif(regexp_extract(titre, '(\d+(?:[.,]\d+)?)\s*m(?:²|2)', 1), ''), ',', '.') AS DOUBLE) AS area_strict,
  TRY_CAST(replace(nullif(regexp_extract(full_description, '(\d+(?:[.,]\d+)?)\s*m\S*', 1), ''), ',', '.') AS DOUBLE) AS area_text
FROM V""",
)
def q_parse_area(spark, sf):
    v = listing_view(spark, sf)
    return v.select(
        "lien",
        T.parse_area("titre").alias("area"),
        T.parse_area("titre", strict=True).alias("area_strict"),
        T.parse_area("full_description").alias("area_text"),
    )


@register(
    "parse_rooms",
    v=True,
    sql="""SELECT lien, CAST(pieces AS VARCHAR) || CASE WHEN pieces > 1 THEN ' pièces' ELSE ' pièce' END AS rooms_text,
       pieces AS rooms FROM V""",
)
def q_parse_rooms(spark, sf):
    v = listing_view(spark, sf, text=False)
    txt = F.concat(F.col("pieces").cast("string"), F.when(F.col("pieces") > 1, " pièces").otherwise(" pièce"))
    return v.select("lien", txt.alias("rooms_text")).withColumn("rooms", T.parse_rooms("rooms_text"))


@register(
    "coerce_number",
    sql="""SELECT p_partkey, TRY_CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand_no,
       TRY_CAST(p_name AS DOUBLE) AS name_num FROM part""",
)
def q_coerce(spark, sf):
    p = load(spark, sf, "part")
    return p.select(
        "p_partkey",
        T.coerce(F.split_part("p_brand", F.lit("#"), F.lit(2)), "int").alias("brand_no"),
        T.coerce("p_name", "double").alias("name_num"),
    )


@register(
    "nth_token",
    v=True,
    sql="""SELECT lien, string_split(titre, ' ')[2] AS type_token, trim(string_split(titre, '²')[-1]) AS place_token FROM V""",
)
def q_nth_token(spark, sf):
    v = listing_view(spark, sf)
    return v.select(
        "lien",
        T.nth_token("titre", " ", 2).alias("type_token"),
        F.trim(T.nth_token("titre", "²", -1)).alias("place_token"),
    )


@register(
    "nfkc_text",
    v=True,
    sql="SELECT lien, translate(titre, chr(160) || chr(8239) || '²³', '  23') AS titre_nfkc FROM V",
)
def q_nfkc(spark, sf):
    return listing_view(spark, sf).select("lien", T.nfkc("titre").alias("titre_nfkc"))


@register(
    "nfkc_cheap",
    v=True,
    sql="SELECT lien, translate(titre, chr(160) || chr(8239) || '²³', '  23') AS titre_nfkc FROM V",
)
def q_nfkc_cheap(spark, sf):
    return listing_view(spark, sf).select("lien", T.nfkc("titre", cheap=True).alias("titre_nfkc"))


# --------------------------------------------------------------------- T18
def floor_sql(x: str) -> str:
    digits = (
        r"regexp_extract(" + x + r", '(?i)(\d+)\s*(?:[eèéê?][mr]?[eèé]?|°)?\s*(?:et\s+)?(?:\(dernier\)|dernier)?\s*[eé]tage', 1)"
    )
    words = " ".join(f"WHEN contains(lower({x}), '{w}') THEN {n}" for w, n in T.FLOOR_WORDS)
    ground = sql_any(f"lower({x})", T.GROUND_WORDS)
    return f"""CASE WHEN {x} IS NULL OR {x} = '' THEN NULL
  WHEN {digits} <> '' THEN TRY_CAST({digits} AS INTEGER)
  ELSE coalesce(CASE {words} END, CASE WHEN {ground} THEN 0 END) END"""


@register(
    "floor_extract",
    v=True,
    sql=f"SELECT {floor_sql('full_description')} AS etage_text, count(*) AS count FROM V GROUP BY 1",
)
def q_floor_extract(spark, sf):
    v = T.with_lowered(listing_view(spark, sf), "full_description", "__low")
    return A.group_count(v, [T.extract_floor("full_description", low=F.col("__low")).alias("etage_text")])


@register(
    "floor_extract_docs",
    sql=f"SELECT doc_id, {floor_sql('text')} AS etage_text FROM documents",
)
def q_floor_extract_docs(spark, sf):
    d = T.with_lowered(load(spark, sf, "documents"), "text", "__low")
    return d.select("doc_id", T.extract_floor("text", low=F.col("__low")).alias("etage_text"))


# ----------------------------------------------------------------- T23..T28
@register(
    "context_matches",
    v=True,
    sql="""SELECT lien, m AS context FROM (
  SELECT lien, unnest(regexp_extract_all(full_description, '(?i).{0,20}[eéE]tage.{0,20}')) AS m FROM V
  WHERE etage IS NULL)""",
)
def q_context_matches(spark, sf):
    v = listing_view(spark, sf).filter(F.col("etage").isNull())
    return v.select("lien", F.explode(T.context_matches("full_description", guard="tage")).alias("context"))


@register(
    "floor_label",
    v=True,
    sql="""SELECT CASE WHEN lower(type_bien) = 'maison' THEN 'MAISON' WHEN etage = 0 THEN 'RDC'
            ELSE CAST(etage AS VARCHAR) END AS etage_label, count(*) AS count FROM V GROUP BY 1""",
)
def q_floor_label(spark, sf):
    v = listing_view(spark, sf)
    return A.group_count(v, [T.floor_label(F.lower("type_bien"), "etage").alias("etage_label")])


@register(
    "round_modes",
    sql="""SELECT l_quantity / 8 AS x, round(l_quantity / 8, 2) AS half_up, round_even(l_quantity / 8, 2) AS half_even,
       count(*) AS count FROM lineitem GROUP BY 1, 2, 3""",
)
def q_round_modes(spark, sf):
    li = load(spark, sf, "lineitem").select((F.col("l_quantity") / 8).alias("x"))
    return A.group_count(
        li,
        ["x", T.round_num("x", 2).alias("half_up"), T.round_num("x", 2, "half_even").alias("half_even")],
    )


# ------------------------------------------------------------- T25..T27, E4
TOKEN_SQL = (
    "list_filter(regexp_split_to_array(regexp_replace(lower({x}), '[^a-zàâäéèêëîïôùûüç\\s]', ' ', 'g'), '\\s+'), "
    "lambda w: length(w) >= 4 AND NOT list_contains([{stop}], w))"
)


def token_sql(x: str) -> str:
    stop = ", ".join(f"'{w}'" for w in sorted(set(T.STOPWORDS)))
    return TOKEN_SQL.format(x=x, stop=stop)


DOCS = "(SELECT doc_id, text FROM documents WHERE text IS NOT NULL)"


@register(
    "tokenise",
    sql=f"SELECT doc_id, CAST(len({token_sql('text')}) AS INTEGER) AS n_tokens FROM {DOCS}",
)
def q_tokenise(spark, sf):
    d = load(spark, sf, "documents").filter(F.col("text").isNotNull())
    return d.select("doc_id", F.size(T.tokens("text")).alias("n_tokens"))


@register(
    "word_pairs",
    sql=f"""SELECT word, CAST(sum(one) AS BIGINT) AS n_pairs FROM (
  SELECT unnest({token_sql('text')}) AS word, 1 AS one FROM {DOCS}) GROUP BY word""",
)
def q_word_pairs(spark, sf):
    d = load(spark, sf, "documents")
    pairs = word_pairs(d, "text")
    return A.reduce_by_key(pairs, "word", "one", "sum", "n_pairs").withColumn("n_pairs", F.col("n_pairs").cast("bigint"))


@register(
    "word_count",
    sql=f"""SELECT word, count(*) AS count FROM (SELECT unnest({token_sql('text')}) AS word FROM {DOCS})
GROUP BY word""",
)
def q_word_count(spark, sf):
    d = load(spark, sf, "documents")
    return word_count(d, "text")


@register(
    "top_words",
    sql=f"""SELECT word, count, row_number() OVER (ORDER BY count DESC, word) AS rank FROM (
  SELECT word, count(*) AS count FROM (SELECT unnest({token_sql('text')}) AS word FROM {DOCS}) GROUP BY word)
ORDER BY count DESC, word LIMIT 30""",
)
def q_top_words(spark, sf):
    d = load(spark, sf, "documents")
    return top_words(d, "text", 30).withColumn("rank", F.col("rank").cast("bigint"))


# -------------------------------------------------------------------- E1
@register("clean_listings", v=True, sql=CLEAN_SQL + "SELECT * FROM CLEAN")
def q_clean_listings(spark, sf):
    return C.clean_listings(listing_view(spark, sf))


@register(
    "clean_null_profile",
    v=True,
    sql=CLEAN_SQL
    + "\nUNION ALL ".join(
        ["SELECT '%s' AS column_name, count(*) FILTER (WHERE %s IS NULL) AS n_null FROM CLEAN" % (c, c)
         for c in ["titre", "description", "ville", "type_bien", "etage", "prix", "surface", "pieces", "DPE",
                   "full_description", "lien"]]
    ),
)
def q_clean_null_profile(spark, sf):
    return A.null_profile(C.clean_listings(listing_view(spark, sf)))


@register(
    "clean_listings_fitted",
    v=True,
    sql=RATIOS_SQL + CLEAN_SQL.replace(f"S3 AS (SELECT * REPLACE ({rooms_sql()} AS pieces) FROM S2)", f"S3 AS (SELECT * REPLACE ({FITTED_ROOMS_SQL.format(t='S2')} AS pieces) FROM S2)")
    + "SELECT * FROM CLEAN",
)
def q_clean_listings_fitted(spark, sf):
    return C.clean_listings(listing_view(spark, sf), C.CleaningRules(room_ratios=None))
