"""Page-to-record extraction as whole-table jobs.

The reference parses one page at a time in a Python loop; here a table of
pages is exploded into blocks and fields are regular-expression columns,
so extraction is a narrow (shuffle-free) map over the page table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hestia.functions import html as H
from hestia.functions import text as T


def explode_blocks(df: DataFrame, html: str, tag: str, cls: str | None = None, keep_open: bool = False,
                   keep: Sequence[str] = ()) -> DataFrame:
    """H1: one row per block, with its position ``block_no`` (1-based)."""
    return df.select(*keep, F.posexplode(H.blocks(html, tag, cls, keep_open)).alias("block_no", "block")).withColumn(
        "block_no", F.col("block_no") + 1
    )


def links(df: DataFrame, html: str, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """H6: one row per link whose URL starts with ``prefix``."""
    return df.select(*keep, F.explode(H.links_with_prefix(html, prefix)).alias("link"))


def require(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """H8: drop records that lack a mandatory field (null or empty)."""
    cond = None
    for c in cols:
        ok = F.col(c).isNotNull() & (F.col(c) != "")
        cond = ok if cond is None else cond & ok
    return df.filter(cond)


def split_good_bad(df: DataFrame, rules: Mapping[str, Column], key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """H9: records passing every rule, and a reject table ``(key…, reason)``
    with one row per failed rule (a null rule result counts as a failure)."""
    checks = F.array(*[F.when(~F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()])
    tagged = df.withColumn("__failed", F.array_compact(checks))
    good = tagged.filter(F.size("__failed") == 0).drop("__failed")
    bad = tagged.select(*key, F.explode("__failed").alias("reason"))
    return good, bad


def with_source(df: DataFrame, name: str, col: str = "source") -> DataFrame:
    """Constant provenance column."""
    return df.withColumn(col, F.lit(name))


# --------------------------------------------------------------- H11 cards
# The card layout of the first listing site.
CARD_TAG, CARD_CLASS = "div", "blocAnnonce"
CARD_PRICE = r"(?U)([\d\s]+€)"
CARD_AREA = r"(?U)(\d+)\s*m[\s\|²]"
CARD_ROOMS = r"(?iU)(\d+)\s*pi"
CARD_BEDROOMS = r"(?iU)(\d+)\s*chambre"
CARD_PLACE = r"(?U)([A-ZÀ-Ÿa-zà-ÿ\-\s]+)\s*\((\d{2})\)"
CARD_PLACE_DEFAULT = "Lyon"


def card_fields(block: Column, source: str, text: Column | None = None) -> list[Column]:
    """Fields of one card block; ``text`` is the card's visible text joined
    with `` | `` (pass it as a staged column to compute it once)."""
    text = H.page_text(block, " | ") if text is None else text
    area = T.capture(text, CARD_AREA, 1)
    return [
        H.attr(block, CARD_TAG, "data-id").alias("id"),
        F.coalesce(H.py_strip(H.attr(block, "a", "title", having="href")), F.when(H.attr(block, "a", "href", having="href").isNotNull(), F.lit(""))).alias("titre"),
        H.py_strip(T.capture(text, CARD_PRICE, 1)).alias("prix"),
        T.with_unit(area, " m²").alias("surface"),
        T.capture(text, CARD_ROOMS, 1).alias("pieces"),
        T.capture(text, CARD_BEDROOMS, 1).alias("chambres"),
        F.coalesce(H.py_strip(T.capture(text, CARD_PLACE, 0)), F.lit(CARD_PLACE_DEFAULT)).alias("localisation"),
        H.py_strip(T.long_run(text)).alias("description"),
        T.capture(text, T.DATE_DMY, 1).alias("date"),
        F.lit(source).alias("source"),
    ]


def extract_listing_cards(pages: DataFrame, html: str = "html", source: str = "cards") -> DataFrame:
    """One listing record per card of every page.

    The card text is its own column (one evaluation per card) before the
    field patterns read it.
    """
    b = explode_blocks(pages, html, CARD_TAG, CARD_CLASS, keep_open=True, keep=["page_id"])
    staged = b.withColumn("__text", H.page_text(F.col("block"), " | "))
    return staged.select("page_id", "block_no", *card_fields(F.col("block"), source, F.col("__text")))


# ------------------------------------------------------------- H12 details
# Element classes of the detail page.
DETAIL_H1 = ("h1", "annonce-immobilier")
DETAIL_PRICE = ("div", "ep-price")
DETAIL_AREA = ("div", "ep-area")
DETAIL_ROOMS = ("div", "ep-room")
DETAIL_DESC = ("div", "ep-desc-truncated")
DETAIL_DPE = (("div", "dpe-diagram"), ("div", "selected"))


def extract_listing_details(pages: DataFrame, html: str = "html", url: str = "url", nfkc_cheap: bool = False) -> DataFrame:
    """The 11-field raw-ad record of each detail page.

    A field that cannot be read is null (never a failed row): ``try_cast``
    and null-on-no-match regexes stand in for per-field exception handlers.
    Stage 1 reads the texts of all fields from one scan of the page's
    elements; later stages work on those short strings only.
    """
    fields = {
        "title": [("title", None)], "h1": [DETAIL_H1], "price": [DETAIL_PRICE], "area": [DETAIL_AREA],
        "rooms": [DETAIL_ROOMS], "desc": [DETAIL_DESC], "dpe": list(DETAIL_DPE),
    }
    found = pages.select(F.col(url).alias("lien"), H.element_fields(html, fields).alias("f"))
    done = found.select("lien", *[F.col(f"f.{x}").alias(f"t_{x}") for x in fields])
    norm = (lambda c: T.nfkc(c, cheap=True)) if nfkc_cheap else T.nfkc
    # The three normalised texts go to Python together.
    texts = done.select("lien", "t_title", "t_price", "t_area", "t_rooms", "t_dpe", norm("t_title").alias("titre"), norm("t_h1").alias("description"), norm("t_desc").alias("full_description"))
    staged = texts.select(
        "lien",
        "titre",
        "description",
        "full_description",
        T.parse_price("t_price").alias("prix"),
        T.parse_area_field("t_area").alias("surface"),
        T.parse_rooms("t_rooms").alias("pieces"),
        F.col("t_dpe").alias("DPE"),
        H.py_strip(T.nth_token("t_title", "²", -1)).alias("ville"),
        F.lower("full_description").alias("__low"),
    )
    return staged.select(
        "titre",
        "description",
        "ville",
        T.nth_token("titre", " ", 2).alias("type_bien"),
        T.extract_floor("full_description", low=F.col("__low")).alias("etage"),
        F.col("prix").cast("double").alias("prix"),
        F.col("surface").cast("double").alias("surface"),
        "pieces",
        "DPE",
        "full_description",
        "lien",
    )


def fill_area_from_text(df: DataFrame) -> DataFrame:
    """E6 step: a missing area is read from the title, then the description."""
    return df.withColumn(
        "surface", F.coalesce(F.col("surface"), T.parse_area("titre"), T.parse_area("full_description"))
    )


# ------------------------------------------------------------ H13 price cards
# The card classes of the second listing site.
PRICE_CARD = ("div", "css-wb0bqw")
PRICE_CARD_FIELDS = {
    "prix": "css-1ilgral",
    "type_de_bien": "css-jeruic",
    "details": "css-1okpm0e",
    "details_alt": "css-1mqggk6",
    "zone": "css-1bola4h",
}


def _card_text(text: Column, keep_comma: bool = False) -> Column:
    """An element's text with newlines → spaces, commas → spaces unless kept; empty when absent."""
    t = F.replace(F.coalesce(text, F.lit("")), F.lit("\n"), F.lit(" "))
    return t if keep_comma else F.replace(t, F.lit(","), F.lit(" "))


def extract_price_cards(pages: DataFrame, html: str = "html") -> DataFrame:
    """``(prix, type_de_bien, details, zone)`` per card; cards without a
    price are skipped (H8)."""
    b = explode_blocks(pages, html, PRICE_CARD[0], PRICE_CARD[1], keep_open=True, keep=["page_id"])
    f = b.select("page_id", "block_no", H.element_fields("block", {k: [(None, c)] for k, c in PRICE_CARD_FIELDS.items()}).alias("f")).select("page_id", "block_no", "f.*")
    price_txt = _card_text(F.col("prix"))
    digits = F.regexp_replace(F.regexp_extract(price_txt, r"(?U)([\d\s]+)€", 1), r"(?U)\s", "")
    out = f.select(
        "page_id",
        "block_no",
        digits.alias("prix"),
        _card_text(F.col("type_de_bien")).alias("type_de_bien"),
        F.coalesce(H.empty_to_null(_card_text(F.col("details"), True)), _card_text(F.col("details_alt"), True)).alias("details"),
        _card_text(F.col("zone")).alias("zone"),
    )
    return require(out, ["prix"])
