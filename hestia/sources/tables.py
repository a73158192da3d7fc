"""Reading the driver tables and the ad-shaped view built over them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a DataFrame (Parquet: pushdown and pruning)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# The phrases appended to a description, chosen by
# ``l_orderkey % 7`` so that the cleaning rules have something to match.
DESCRIPTION_PHRASES = [
    " non soumis au dpe",
    " dpe a",
    " dpe : d",
    " dpe vierge",
    " dernier étage",
    " au 3ème étage",
    "",
]

LISTING_COLUMNS = [
    "titre",
    "description",
    "ville",
    "type_bien",
    "etage",
    "prix",
    "surface",
    "pieces",
    "DPE",
    "full_description",
    "lien",
]


def _phrase(key: Column) -> Column:
    expr = None
    for i, text in enumerate(DESCRIPTION_PHRASES):
        cond = (key % 7) == i
        expr = F.when(cond, F.lit(text)) if expr is None else expr.when(cond, F.lit(text))
    return expr


def listing_view(spark: SparkSession, sf_dir: str, text: bool = True) -> DataFrame:
    """View ``V``: one ad per ``lineitem`` row, with deterministic nulls.

    Columns follow the raw-ad schema (titre, description, ville, type_bien,
    etage, prix, surface, pieces, DPE, full_description, lien). The place is
    the supplier's nation; the long text is the document whose ``doc_id``
    equals ``l_partkey`` (left join, so ads without a document carry a null
    text), followed by a phrase picked by the order key. ``text=False``
    leaves out the long text and the join that brings it (``doc_id`` is
    unique, so the rows are the same).
    """
    return with_text(spark, sf_dir, listing_keys(spark, sf_dir)) if text else listing_rows(spark, sf_dir).drop("__doc", "__phrase")


def with_text(spark: SparkSession, sf_dir: str, keys: DataFrame, written: Callable[[Column], Column] = lambda c: c) -> DataFrame:
    """The ads of ``listing_keys`` with the long text (``full_description``) of each one's document.

    An ad meets its document as the columns that it is made of, so nothing made
    of them is shuffled or sorted. ``written`` is how the long text is put down:
    a function that treats each character by itself, called once a document.
    """
    docs = load(spark, sf_dir, "documents").select("doc_id", written(F.col("text")).alias("__text"))
    ads = keys.join(docs, F.col("l_partkey") == F.col("doc_id"), "left")
    made = listing_columns(F.col)
    made["full_description"] = F.concat(F.col("__text"), written(made["__phrase"]))
    return ads.select(*[made[c].alias(c) for c in LISTING_COLUMNS])


def listing_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``V`` without its long text; ``__doc`` and ``__phrase`` tell the document and what follows it (``with_text``)."""
    return listing_keys(spark, sf_dir).select(*[c.alias(name) for name, c in listing_columns(F.col).items()])


#: The table columns that ``V`` is made of, besides its documents.
KEY_COLUMNS = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
    "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "n_name",
]


def listing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``KEY_COLUMNS`` of each ad: the few bytes that ``listing_columns`` makes the ad of."""
    li = load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus",
    )
    supplier = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # 25 rows by construction of the schema: a bounded broadcast.
    nation = F.broadcast(load(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    places = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).select(
        "s_suppkey", "n_name"
    )

    # supplier ⋈ nation grows with the scale: Spark broadcasts it up to its
    # size threshold in bytes and shuffles beyond.
    return li.join(places, li.l_suppkey == places.s_suppkey, "inner").select(*KEY_COLUMNS)


def listing_columns(key: Callable[[str], Column]) -> dict[str, Column]:
    """The columns of ``listing_rows``, of the ``KEY_COLUMNS`` that ``key`` gives."""
    type_bien = F.when(key("l_returnflag") == "R", "Maison").otherwise("Appartement")
    area_txt = (key("l_quantity") * 6).cast("int").cast("string")
    return {
        "titre": F.concat(F.lit("Vente "), type_bien, F.lit(" "), area_txt, F.lit(" m² "), key("n_name")),
        "description": F.concat(type_bien, F.lit(" "), area_txt, F.lit(" m² à "), key("n_name")),
        "ville": key("n_name"),
        "type_bien": type_bien,
        "etage": F.when(key("l_suppkey") % 4 == 0, F.lit(None)).otherwise((key("l_suppkey") % 9).cast("int")),
        "prix": key("l_extendedprice") * 10,
        "surface": F.when(key("l_orderkey") % 11 == 0, F.lit(None)).otherwise(key("l_quantity") * 6),
        "pieces": F.when(key("l_partkey") % 5 == 0, F.lit(None)).otherwise(key("l_linenumber")),
        "DPE": F.when(key("l_orderkey") % 3 == 0, F.lit(None)).otherwise(key("l_linestatus")),
        "lien": F.concat_ws(
            "-",
            F.concat(F.lit("https://annonces.example/"), key("l_orderkey").cast("string")),
            key("l_linenumber").cast("string"),
            key("l_partkey").cast("string"),
            key("l_suppkey").cast("string"),
        ),
        "__doc": key("l_partkey"),
        "__phrase": _phrase(key("l_orderkey")),
    }


# The same view as SQL text, so oracle queries can start from it. Written
# for DuckDB (``||`` keeps SQL null semantics, ``concat`` would skip nulls).
LISTING_VIEW_SQL = """
SELECT
  'Vente ' || (CASE WHEN l.l_returnflag = 'R' THEN 'Maison' ELSE 'Appartement' END) || ' '
    || CAST(CAST(l.l_quantity * 6 AS INTEGER) AS VARCHAR) || ' m² ' || n.n_name AS titre,
  (CASE WHEN l.l_returnflag = 'R' THEN 'Maison' ELSE 'Appartement' END) || ' '
    || CAST(CAST(l.l_quantity * 6 AS INTEGER) AS VARCHAR) || ' m² à ' || n.n_name AS description,
  n.n_name AS ville,
  CASE WHEN l.l_returnflag = 'R' THEN 'Maison' ELSE 'Appartement' END AS type_bien,
  CASE WHEN l.l_suppkey % 4 = 0 THEN NULL ELSE CAST(l.l_suppkey % 9 AS INTEGER) END AS etage,
  l.l_extendedprice * 10 AS prix,
  CASE WHEN l.l_orderkey % 11 = 0 THEN NULL ELSE l.l_quantity * 6 END AS surface,
  CASE WHEN l.l_partkey % 5 = 0 THEN NULL ELSE l.l_linenumber END AS pieces,
  CASE WHEN l.l_orderkey % 3 = 0 THEN NULL ELSE l.l_linestatus END AS DPE,
  d.text || CASE l.l_orderkey % 7
      WHEN 0 THEN ' non soumis au dpe' WHEN 1 THEN ' dpe a' WHEN 2 THEN ' dpe : d'
      WHEN 3 THEN ' dpe vierge' WHEN 4 THEN ' dernier étage' WHEN 5 THEN ' au 3ème étage'
      ELSE '' END AS full_description,
  'https://annonces.example/' || CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR)
    || '-' || CAST(l.l_partkey AS VARCHAR) || '-' || CAST(l.l_suppkey AS VARCHAR) AS lien
FROM lineitem l
JOIN supplier s ON l.l_suppkey = s.s_suppkey
JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN documents d ON d.doc_id = l.l_partkey
"""


def with_v(sql: str) -> str:
    """Prefix an oracle query with the ``V`` common table expression."""
    return f"WITH V AS ({LISTING_VIEW_SQL})\n{sql}"
