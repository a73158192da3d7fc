"""Registered queries: sources/sinks (S, K) and page extraction (H, E6)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as TY

from hestia.functions import html as H
from hestia.functions import text as T
from hestia.operators import extract as X
from hestia.plans.fuse import explode_lines
from hestia.session import scratch_dir
from hestia.sources import csv as CSV
from hestia.plans import collect as E6
from hestia.sources.pages import frontiers, read_pages, until_empty
from hestia.sources.tables import listing_columns, listing_keys, listing_view, load, with_text
from hestia.suite.registry import register
from hestia.suite.textops import floor_sql, price_text

# ---------------------------------------------------------------- S1..S5, K1
DOC_SCHEMA = TY.StructType(
    [
        TY.StructField("doc_id", TY.LongType()),
        TY.StructField("text", TY.StringType()),
        TY.StructField("lang", TY.StringType()),
    ]
)


@register("csv_roundtrip_fixed", sql="SELECT doc_id, text, lang FROM documents")
def q_csv_fixed(spark, sf):
    path = scratch_dir(spark, "csv-fixed")
    CSV.write_csv(load(spark, sf, "documents").select("doc_id", "text", "lang"), path)
    return CSV.read_listings_csv(spark, path, DOC_SCHEMA)


@register(
    "csv_roundtrip_inferred",
    sql="SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
)
def q_csv_inferred(spark, sf):
    path = scratch_dir(spark, "csv-inferred")
    CSV.write_csv(load(spark, sf, "part"), path)
    return CSV.read_csv_inferred(spark, path)


@register(
    "csv_semicolon",
    sql="""SELECT CAST(c_custkey AS INTEGER) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer""",
)
def q_csv_semicolon(spark, sf):
    path = scratch_dir(spark, "csv-semicolon")
    CSV.write_csv(load(spark, sf, "customer"), path, sep=";")
    return CSV.read_csv_inferred(spark, path, sep=";", multiline=False)


@register(
    "csv_bom",
    sql="SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part",
)
def q_csv_bom(spark, sf):
    path = scratch_dir(spark, "csv-bom")
    CSV.write_csv(load(spark, sf, "part"), path, bom=True)
    return CSV.read_csv_inferred(spark, path)


@register("append_batches", sql="SELECT event_id, event_type, value FROM events")
def q_append_batches(spark, sf):
    """K2: four deterministic batches, the first truncating, the rest
    appended; the table read back equals the source."""
    path = scratch_dir(spark, "csv-append")
    ev = load(spark, sf, "events").select("event_id", "event_type", "value")
    batch = F.pmod(F.xxhash64("event_id"), F.lit(4))
    for b in range(4):
        CSV.append_batch(ev.filter(batch == b), path, first=(b == 0))
    schema = TY.StructType(
        [
            TY.StructField("event_id", TY.LongType()),
            TY.StructField("event_type", TY.StringType()),
            TY.StructField("value", TY.DoubleType()),
        ]
    )
    return CSV.read_listings_csv(spark, path, schema)


# ------------------------------------------------------------------ S6..S9
@register(
    "lines_to_table",
    sql="""SELECT doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))) AS line_no,
       unnest(string_split(text, chr(10))) AS line FROM documents""",
)
def q_lines_to_table(spark, sf):
    d = load(spark, sf, "documents")
    return d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line")).withColumn(
        "line_no", (F.col("line_no") + 1).cast("bigint")
    )


@register(
    "lines_block",
    sql="""SELECT unnest(string_split(string_agg(n_name, chr(10) ORDER BY n_nationkey), chr(10))) AS line FROM nation""",
)
def q_lines_block(spark, sf):
    # A text block (bounded: the nation table's fixed 25 rows) → rows.
    block = load(spark, sf, "nation").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("n_nationkey", "n_name"))), lambda s: s["n_name"]), "\n").alias("t")
    )
    return explode_lines(block, "t")


@register(
    "records_to_table",
    sql="SELECT r_regionkey, r_name FROM region",
)
def q_records_to_table(spark, sf):
    """JSON-like records parsed with an explicit schema."""
    recs = load(spark, sf, "region").select(F.to_json(F.struct("r_regionkey", "r_name")).alias("rec"))
    return recs.select(F.from_json("rec", "r_regionkey int, r_name string").alias("r")).select("r.*")


HOST_SQL = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"


@register(
    "page_frontier",
    sql=f"""WITH S AS (SELECT {HOST_SQL} AS base, count(*) AS n_pages FROM pages GROUP BY 1)
SELECT base, CAST(p AS INTEGER) AS page_no, CASE WHEN p = 1 THEN base ELSE base || '/?page=' || CAST(p AS VARCHAR) END AS url
FROM (SELECT base, unnest(generate_series(1, n_pages)) AS p FROM S)""",
)
def q_page_frontier(spark, sf):
    p = read_pages(spark, f"{sf.rstrip('/')}/pages.parquet")
    sites = p.groupBy(F.regexp_extract("url", r"^(https?://[^/?#]+)", 1).alias("base")).agg(
        F.count(F.lit(1)).alias("n_pages")
    )
    return frontiers(sites, "base", "n_pages", "/?page=")


@register(
    "frontier_until_empty",
    sql=f"""WITH P AS (SELECT page_id, url, {HOST_SQL} AS site, (length(html) - length(replace(html, '<p>', ''))) / 3 <= 4 AS empty FROM pages),
S AS (SELECT site, min(page_id) AS stop FROM P WHERE empty GROUP BY site)
SELECT P.site, page_id, url FROM P LEFT JOIN S ON P.site = S.site WHERE stop IS NULL OR page_id < stop""",
)
def q_frontier_until_empty(spark, sf):
    """Each site's pages (in the order of their ids) up to the first one with four paragraphs or fewer."""
    p = read_pages(spark, f"{sf.rstrip('/')}/pages.parquet")
    found = p.select("page_id", "url", F.regexp_extract("url", r"^(https?://[^/?#]+)", 1).alias("site"), F.size(H.blocks("html", "p")).alias("n"))
    return until_empty(found, "site", "page_id", F.col("n") <= 4).select("site", "page_id", "url")


# ------------------------------------------------------------------ H1..H9
def _pages(spark, sf):
    return read_pages(spark, f"{sf.rstrip('/')}/pages.parquet")


@register(
    "page_blocks",
    sql=r"""SELECT page_id, CAST(i AS INTEGER) AS block_no, length(split_part(b, '</p>', 1)) AS block_len FROM (
  SELECT page_id, unnest(generate_series(1, len(parts) - 1)) AS i, unnest(parts[2:]) AS b
  FROM (SELECT page_id, string_split_regex(html, '(?i)<p\b[^>]*>') AS parts FROM pages))""",
)
def q_page_blocks(spark, sf):
    b = X.explode_blocks(_pages(spark, sf), "html", "p", keep=["page_id"])
    return b.select("page_id", F.col("block_no").cast("int").alias("block_no"), F.length("block").alias("block_len"))


UNESCAPE_SQL = "replace(replace(replace(replace(replace(replace(replace(replace(replace({x}, '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&copy;', '©'), '&middot;', '·'), '&euro;', '€'), '&amp;', '&')"


def sql_unescape(x: str) -> str:
    return UNESCAPE_SQL.format(x=x)


def sql_strip(x: str) -> str:
    return rf"regexp_replace({x}, '^[\s\x{{a0}}]+|[\s\x{{a0}}]+$', '', 'g')"


def sql_element_text(x: str, tag: str) -> str:
    inner = rf"nullif(regexp_extract({x}, '(?is)<{tag}\b[^>]*>(.*?)</{tag}\s*>', 1), '')"
    return f"nullif({sql_strip(sql_unescape(rf'''regexp_replace({inner}, '<[^>]*>', '', 'g')'''))}, '')"


@register(
    "page_title_h1",
    sql=f"SELECT page_id, {sql_element_text('html', 'title')} AS title, {sql_element_text('html', 'h1')} AS h1 FROM pages",
)
def q_page_title_h1(spark, sf):
    p = _pages(spark, sf)
    return p.select("page_id", H.element_text("html", "title").alias("title"), H.element_text("html", "h1").alias("h1"))


@register(
    "nested_element",
    sql=f"""SELECT page_id, {sql_element_text("nullif(regexp_extract(html, '(?is)<nav\\b[^>]*>(.*)', 1), '')", 'a')} AS nav_first
FROM pages""",
)
def q_nested_element(spark, sf):
    return _pages(spark, sf).select("page_id", H.nested_text("html", ("nav", None), ("a", None)).alias("nav_first"))


def sql_page_text(x: str, sep: str = " | ") -> str:
    c = rf"regexp_replace({x}, '(?is)<script\b.*?</script\s*>', chr(1), 'g')"
    c = rf"regexp_replace({c}, '(?is)<style\b.*?</style\s*>', chr(1), 'g')"
    c = rf"regexp_replace({c}, '(?s)<!--.*?-->', chr(1), 'g')"
    c = rf"regexp_replace({c}, '<[^>]*>', chr(1), 'g')"
    c = sql_unescape(c)
    c = rf"regexp_replace({c}, '[\s\x{{a0}}]*\x01[\s\x{{a0}}\x01]*', chr(1), 'g')"
    c = rf"regexp_replace({c}, '^\x01|\x01$', '', 'g')"
    c = sql_strip(c)
    return f"replace({c}, chr(1), '{sep}')"


@register(
    "page_text",
    sql=f"SELECT page_id, md5({sql_page_text('html')}) AS text_md5, length({sql_page_text('html')}) AS text_len FROM pages",
)
def q_page_text(spark, sf):
    t = _pages(spark, sf).select("page_id", H.page_text("html").alias("t"))
    return t.select("page_id", F.md5("t").alias("text_md5"), F.length("t").alias("text_len"))


@register(
    "page_attr",
    sql=r"""SELECT page_id, coalesce(CASE WHEN regexp_extract(html, '(?is)<a\b[^>]*\bhref\s*=\s*"([^"]*)"', 0) <> ''
                            THEN regexp_extract(html, '(?is)<a\b[^>]*\bhref\s*=\s*"([^"]*)"', 1) END, '') AS first_href,
       CASE WHEN regexp_extract(html, '(?is)<html\b[^>]*\blang\s*=\s*"([^"]*)"', 0) <> ''
            THEN regexp_extract(html, '(?is)<html\b[^>]*\blang\s*=\s*"([^"]*)"', 1) END AS lang FROM pages""",
)
def q_page_attr(spark, sf):
    p = _pages(spark, sf)
    return p.select("page_id", H.attr("html", "a", "href", "").alias("first_href"), H.attr("html", "html", "lang").alias("lang"))


@register(
    "page_links_prefix",
    sql=r"""SELECT page_id, link FROM (
  SELECT page_id, unnest(regexp_extract_all(html, '(?i)<a\b[^>]*\bhref\s*=\s*"([^"]*)"', 1)) AS link FROM pages)
WHERE starts_with(link, '/t')""",
)
def q_page_links(spark, sf):
    return X.links(_pages(spark, sf), "html", "/t", keep=["page_id"])


@register(
    "first_nonempty",
    sql=f"""SELECT page_id, coalesce(nullif(trim({sql_element_text('html', 'h2')}), ''), nullif(trim({sql_element_text('html', 'h1')}), ''),
                nullif(trim({sql_element_text('html', 'title')}), '')) AS heading FROM pages""",
)
def q_first_nonempty(spark, sf):
    p = _pages(spark, sf)
    return p.select(
        "page_id",
        H.first_nonempty(H.element_text("html", "h2"), H.element_text("html", "h1"), H.element_text("html", "title")).alias("heading"),
    )


BOLD_SQL = r"nullif(" + "regexp_replace(regexp_replace(split_part(string_split_regex(html, '(?i)<b\\b[^>]*>')[2], '</b>', 1), '<[^>]*>', '', 'g'), '^[\\s\\x{a0}]+|[\\s\\x{a0}]+$', '', 'g')" + ", '')"


def first_bold(html):
    """Text of the first ``<b>`` block (bold runs may be left unclosed)."""
    return F.nullif(H.py_strip(H.strip_tags(F.element_at(H.blocks(html, "b"), 1))), F.lit(""))


@register(
    "require_field",
    sql=f"SELECT page_id, md5({BOLD_SQL}) AS bold_md5 FROM pages WHERE {BOLD_SQL} IS NOT NULL",
)
def q_require_field(spark, sf):
    p = _pages(spark, sf).select("page_id", first_bold(F.col("html")).alias("bold"))
    return X.require(p, ["bold"]).select("page_id", F.md5("bold").alias("bold_md5"))


@register(
    "reject_table",
    sql=f"""SELECT page_id, 'bold' AS reason FROM pages WHERE {BOLD_SQL} IS NULL
UNION ALL SELECT page_id, 'https' AS reason FROM pages WHERE NOT starts_with(url, 'https://')""",
)
def q_reject_table(spark, sf):
    p = _pages(spark, sf)
    rules = {"bold": first_bold(F.col("html")).isNotNull(), "https": F.col("url").startswith("https://")}
    _, bad = X.split_good_bad(p, rules, ["page_id"])
    return bad


@register(
    "good_records",
    sql=f"""SELECT page_id FROM pages WHERE {BOLD_SQL} IS NOT NULL AND starts_with(url, 'https://')""",
)
def q_good_records(spark, sf):
    p = _pages(spark, sf)
    rules = {"bold": first_bold(F.col("html")).isNotNull(), "https": F.col("url").startswith("https://")}
    good, _ = X.split_good_bad(p, rules, ["page_id"])
    return X.with_source(good.select("page_id"), "pages").drop("source")


# ------------------------------------------------------ synthetic ad pages
def esc(c):
    """Text as page source: markup characters and some accented letters as references of each kind."""
    c = _markup(c)
    for char, ref in (("é", "&eacute;"), ("à", "&#224;"), ("ç", "&#xE7;")):
        c = F.replace(c, F.lit(char), F.lit(ref))
    return c


# What follows the records of a page and must not be read into them.
FOOTER = "<footer><div class='note'><a href='/legal' title='Legal'>990 € 12 m² 9 pièces Paris (75) 01/01/2001</a></div></footer>"


def _markup(c):
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))


CARDS_PER_PAGE = 4


def _paged(v, lien="lien", titre="titre"):
    """Assign ads to result pages by a content hash (MD5 of link and
    title) over ``ceil(N / 4)`` pages: a page holds a small Poisson-sized
    number of ads whatever the skew of any business key, so the per-page
    list below stays bounded."""
    n_pages = v.agg(F.ceil(F.count(F.lit(1)) / CARDS_PER_PAGE).cast("bigint").alias("n")).scalar()
    return v.withColumn("__page", F.pmod(_ad_hash(lien, titre), n_pages))


def _ad_hash(lien, titre):
    return F.conv(F.substr(F.md5(F.concat_ws("|", lien, titre)), F.lit(1), F.lit(15)), 16, 10).cast("bigint")


def _segment(lien):
    return F.element_at(F.split(lien, "/"), -1)


def _order_key(seg):
    return F.split_part(seg, F.lit("-"), F.lit(1)).cast("bigint")


def _ad_keys(v):
    return v.withColumn("__seg", _segment("lien")).withColumn("__ok", _order_key(F.col("__seg"))).withColumn(
        "__ln", F.split_part("__seg", F.lit("-"), F.lit(2)).cast("int")
    )


def _dealt(ads):
    """``(__page, __ads)``: the rows of each result page, which ads of ``listing_keys`` and what else they hold are dealt to."""
    columns = listing_columns(F.col)
    paged = _paged(ads, columns["lien"], columns["titre"]).select("__page", F.struct(*ads.columns).alias("__ad"))
    # Dealt before the lists are made: no list is begun, sorted and spilled on the sending side.
    return paged.repartition("__page").groupBy("__page").agg(F.collect_list("__ad").alias("__ads"))


def _result_pages(spark, sf, card, text=False):
    """Result pages ``(page_id, html)`` of the cards that ``card`` makes of each ad of ``V``.

    An ad goes to its page as the table columns it is made of and, with
    ``text``, its document's text as compressed once a document; the card is
    made there. So neither markup nor plain texts are shuffled."""
    docs = load(spark, sf, "documents").select("doc_id", *([T.packed("text").alias("__packed")] if text else []))
    g = _dealt(listing_keys(spark, sf).join(docs, F.col("l_partkey") == F.col("doc_id"), "left").drop("doc_id"))
    if text:
        g = g.withColumn("__texts", T.unpacked(F.transform("__ads", lambda a: a["__packed"])))

    def ad(a, i):
        found = listing_columns(lambda c: a[c])
        found["__seg"] = _segment(found["lien"])
        found["__ok"] = _order_key(found["__seg"])
        if text:
            found["full_description"] = F.concat(F.get("__texts", i), found["__phrase"])
        return F.struct(*[c.alias(name) for name, c in found.items()])

    def ranked(v):
        return F.struct(_ad_hash(v["lien"], v["titre"]).alias("__h"), v["__seg"], v["prix"], v["titre"], card(v).alias("c"))

    cards = F.array_sort(F.transform(F.transform("__ads", ad), ranked))
    html = F.concat(F.lit("<html><body>"), F.array_join(F.transform(cards, lambda s: s["c"]), ""), F.lit(FOOTER + "</body></html>"))
    return g.select(F.col("__page").alias("page_id"), html.alias("html"))


def detail_pages(spark, sf):
    """One detail page per ad of ``V`` (as a crawler would have landed it)."""
    return detail_html(spark, sf, listing_keys(spark, sf))


def detail_html(spark, sf, keys):
    """The detail page ``(url, html)`` of each ad of ``listing_keys``; a long text is made page source once a document."""
    v = with_text(spark, sf, keys, esc)
    area = F.concat(F.lit('<div class="ep-area">'), F.col("surface").cast("int").cast("string"), F.lit(" m²</div>"))
    rooms = F.concat(F.lit('<div class="ep-room">'), F.col("pieces").cast("string"), F.lit(" pièces</div>"))
    # Every fourth description is nested in an element of the same name.
    nested = F.crc32(F.col("lien").cast("binary")) % 4 == 0
    desc = F.concat(
        F.lit("<div class='ep-desc-truncated long'>"), F.when(nested, '<div class="inner">').otherwise("<span>"),
        F.col("full_description"), F.when(nested, "</div>").otherwise("</span>"), F.lit("</div>"),
    )
    dpe = F.concat(
        F.lit('<div class="dpe-diagram"><div class="dpe-a">A</div><div class="selected">'), F.col("DPE"), F.lit("</div></div>")
    )
    # An empty diagram, and a selection outside of it.
    no_dpe = F.lit('<div class="dpe-diagram"></div><div class="ges"><div class="selected">B</div></div>')
    html = F.concat(
        F.lit("<html><head><title>"), esc(F.col("titre")), F.lit("</title></head><body>"),
        F.lit('<h1 class="annonce-immobilier">'), esc(F.col("description")), F.lit("</h1>"),
        F.lit('<div class="ep-price-old">999 €</div><div class=ep-price>'), price_text(F.col("prix")), F.lit("</div>"),
        F.coalesce(area, F.lit("")), F.coalesce(rooms, F.lit("")), F.coalesce(desc, F.lit("")),
        F.coalesce(dpe, no_dpe), F.lit(FOOTER + "</body></html>"),
    )
    return v.select(F.col("lien").alias("url"), html.alias("html"))


DETAIL_SQL = f"""SELECT translate(titre, '²', '2') AS titre, translate(description, '²', '2') AS description,
       trim(string_split(titre, '²')[-1]) AS ville, string_split(translate(titre, '²', '2'), ' ')[2] AS type_bien,
       {floor_sql('full_description')} AS etage,
       CAST(floor(prix) AS DOUBLE) AS prix, CAST(CAST(surface AS INTEGER) AS DOUBLE) AS surface, pieces, DPE,
       {sql_strip('full_description')} AS full_description, lien
FROM V"""


@register("listing_details", v=True, sql=DETAIL_SQL)
def q_listing_details(spark, sf):
    return X.extract_listing_details(detail_pages(spark, sf), nfkc_cheap=True)


@register("listing_details_nfkc", v=True, sql=DETAIL_SQL)
def q_listing_details_nfkc(spark, sf):
    return X.extract_listing_details(detail_pages(spark, sf))


AREA_FAITHFUL_SQL = r"TRY_CAST(replace(nullif(regexp_extract({x}, '(\d+(?:[.,]\d+)?)\s*m\S*', 1), ''), ',', '.') AS DOUBLE)"


@register(
    "collect_listings",
    v=True,
    sql=f"""SELECT * REPLACE (coalesce(surface, {AREA_FAITHFUL_SQL.format(x='titre')},
                                  {AREA_FAITHFUL_SQL.format(x='full_description')}) AS surface)
FROM ({DETAIL_SQL})""",
)
def q_collect_listings(spark, sf):
    """E6 (first site): pages → records, texts normalised to full NFKC → missing area from the text."""
    return E6.collect_listings(detail_pages(spark, sf))


def list_pages(spark, sf):
    """Result pages of the crawled site: links to ads inside the list, others around it."""
    g = _dealt(listing_keys(spark, sf))

    def link(a):
        found = listing_columns(lambda c: a[c])
        return F.concat(F.lit("<li><a class='ad' href='"), found["lien"], F.lit("'>"), esc(found["titre"]), F.lit("</a></li>"))

    g = g.select(F.col("__page").alias("page_id"), F.array_join(F.array_sort(F.transform("__ads", link)), "").alias("links"))
    html = F.concat(
        F.lit("<html><body><a href='https://annonces.example/annonce-du-jour'>x</a><div class='bloc results'><div><ul>"), F.col("links"),
        F.lit("</ul></div><a href='/aide'>aide</a></div>" + FOOTER + "</body></html>"),
    )
    return g.select("page_id", F.concat(F.lit("https://annonces.example/liste?page="), F.col("page_id").cast("string")).alias("url"), html.alias("html"))


@register(
    "collect_chain",
    v=True,
    sql=f"""SELECT * REPLACE (coalesce(surface, {AREA_FAITHFUL_SQL.format(x='titre')},
                                  {AREA_FAITHFUL_SQL.format(x='full_description')}) AS surface)
FROM ({DETAIL_SQL})""",
)
def q_collect_chain(spark, sf):
    """E6 as a chain: result pages → links inside the list → detail pages →
    records → missing area → CSV (K1, with a BOM), read back (S1)."""
    ads = listing_keys(spark, sf).withColumn("url", listing_columns(F.col)["lien"])
    return E6.collect_to_csv(
        ads, scratch_dir(spark, "collected"), list_pages(spark, sf), "/annonces.example/", fetch=lambda kept: detail_html(spark, sf, kept)
    )


# Cards: the ads of one order form one result page.
def _card_date(ok):
    d = F.lpad((ok % 28 + 1).cast("string"), 2, "0")
    m = F.lpad((ok % 12 + 1).cast("string"), 2, "0")
    return F.concat_ws("/", d, m, (ok % 5 + 2020).cast("string"))


def card_pages(spark, sf):
    return _result_pages(spark, sf, _card, text=True)


def _card(v):
    place = F.translate(v["ville"], "_0123456789", "-abcdefghij")
    span = lambda x: F.concat(F.lit("<span>"), x, F.lit("</span>"))
    return F.concat(
        F.lit("<div data-id='"), v["__seg"], F.lit("' class='blocAnnonce premium'><div><a title=\"Photo\"></a></div><a href=\""), v["lien"],
        F.lit('" title="'), esc(v["titre"]), F.lit('"></a>'),
        span(price_text(v["prix"])),
        F.coalesce(span(F.concat(v["surface"].cast("int").cast("string"), F.lit(" m²"))), F.lit("")),
        F.coalesce(span(F.concat(v["pieces"].cast("string"), F.lit(" pièces"))), F.lit("")),
        F.coalesce(span(F.concat(v["etage"].cast("string"), F.lit(" chambres"))), F.lit("")),
        span(F.concat(place, F.lit(" (69)"))),
        F.coalesce(F.concat(F.lit("<p>"), esc(v["full_description"]), F.lit("</p>")), F.lit("")),
        span(_card_date(v["__ok"])),
        F.lit("</div>"),
    )


def _sql_card_text() -> str:
    date = "lpad(CAST(ok % 28 + 1 AS VARCHAR), 2, '0') || '/' || lpad(CAST(ok % 12 + 1 AS VARCHAR), 2, '0') || '/' || CAST(ok % 5 + 2020 AS VARCHAR)"
    price = r"regexp_replace(CAST(CAST(floor(prix) AS BIGINT) AS VARCHAR), '(\d{3})$', chr(160) || '\1') || ' €'"
    return f"""concat_ws(' | ', {price}, CAST(CAST(surface AS INTEGER) AS VARCHAR) || ' m²', CAST(pieces AS VARCHAR) || ' pièces',
      CAST(etage AS VARCHAR) || ' chambres', translate(ville, '_0123456789', '-abcdefghij') || ' (69)',
      nullif({sql_strip('full_description')}, ''), {date})"""


WS = r"[\s\x{a0}\x{202f}]"
PAGED_SQL = """, K0 AS (SELECT *, string_split(lien, '/')[-1] AS seg,
                  CAST(split_part(string_split(lien, '/')[-1], '-', 1) AS BIGINT) AS ok,
                  CAST('0x' || substr(md5(lien || '|' || titre), 1, 15) AS BIGINT) AS h FROM V),
K AS (SELECT *, h % (SELECT CAST(ceil(count(*) / 4) AS BIGINT) FROM V) AS pg FROM K0)"""

CARD_SQL = PAGED_SQL + rf""",
C AS (SELECT pg AS page_id, row_number() OVER (PARTITION BY pg ORDER BY h, seg, prix, titre) AS block_no, seg AS id, titre,
             {_sql_card_text()} AS texte FROM K)
SELECT page_id, block_no, id, titre,
  nullif(regexp_replace(regexp_extract(texte, '([\d\s\x{{a0}}\x{{202f}}]+€)', 1), '^{WS}+|{WS}+$', '', 'g'), '') AS prix,
  nullif(regexp_extract(texte, '(\d+){WS}*m[\s\x{{a0}}\x{{202f}}\|²]', 1), '') || ' m²' AS surface,
  nullif(regexp_extract(texte, '(?i)(\d+){WS}*pi', 1), '') AS pieces,
  nullif(regexp_extract(texte, '(?i)(\d+){WS}*chambre', 1), '') AS chambres,
  coalesce(nullif(regexp_replace(regexp_extract(texte, '([A-ZÀ-Ÿa-zà-ÿ\-\s\x{{a0}}\x{{202f}}]+){WS}*\((\d{{2}})\)', 0), '^{WS}+|{WS}+$', '', 'g'), ''), 'Lyon') AS localisation,
  nullif(regexp_replace(regexp_extract(texte, '([\pL\pN\pM_\s\x{{a0}}\x{{202f}},àéèêëùûüîïôç\.\-]{{80,}})', 1), '^{WS}+|{WS}+$', '', 'g'), '') AS description,
  nullif(regexp_extract(texte, '(\d{{2}}/\d{{2}}/\d{{4}})', 1), '') AS date,
  'cards' AS source
FROM C"""


@register("listing_cards", v=True, sql=CARD_SQL)
def q_listing_cards(spark, sf):
    c = X.extract_listing_cards(card_pages(spark, sf))
    return c.withColumn("block_no", F.col("block_no").cast("bigint"))


def price_card_pages(spark, sf):
    return _result_pages(spark, sf, _price_card)


def _price_card(v):
    kind = F.concat_ws(", ", v["type_bien"], F.concat(v["surface"].cast("int").cast("string"), F.lit(" m²")))
    details = F.coalesce(
        F.concat(F.lit('<div class="css-1okpm0e">'), v["pieces"].cast("string"), F.lit(" pièces,\n"),
                 F.coalesce(v["etage"].cast("string"), F.lit("?")), F.lit(" étage</div>")),
        F.concat(F.lit('<div class="css-1mqggk6">'), esc(v["description"]), F.lit("</div>")),
    )
    price = F.when(
        v["DPE"].isNotNull(), F.concat(F.lit('<span class="css-1ilgral">'), price_text(v["prix"]), F.lit("</span>"))
    ).otherwise(F.lit(""))
    return F.concat(
        F.lit('<div class="card css-wb0bqw"><div class="css-1ilgral-old">999 €</div>'), price,
        F.lit('<span class="css-jeruic">'), kind, F.lit("</span>"), details,
        F.lit('<span class="css-1bola4h">'), v["ville"], F.lit("</span></div>"),
    )


@register(
    "price_cards",
    v=True,
    sql=PAGED_SQL + """
SELECT page_id, block_no, prix, type_de_bien, details, zone FROM (
  SELECT pg AS page_id, row_number() OVER (PARTITION BY pg ORDER BY h, seg, prix, titre) AS block_no, DPE,
         CAST(CAST(floor(prix) AS BIGINT) AS VARCHAR) AS prix,
         replace(concat_ws(', ', type_bien, CAST(CAST(surface AS INTEGER) AS VARCHAR) || ' m²'), ',', ' ') AS type_de_bien,
         coalesce(CAST(pieces AS VARCHAR) || ' pièces, ' || coalesce(CAST(etage AS VARCHAR), '?') || ' étage',
                  description) AS details,
         replace(ville, ',', ' ') AS zone FROM K)
WHERE DPE IS NOT NULL""",
)
def q_price_cards(spark, sf):
    c = X.extract_price_cards(price_card_pages(spark, sf))
    return c.withColumn("block_no", F.col("block_no").cast("bigint"))


# --------------------------------------------------------------------- ST1
@register(
    "ingest_pages",
    sql=rf"""SELECT page_id, url, {sql_element_text('html', 'title')} AS title, {sql_element_text('html', 'h1')} AS h1,
       CAST(len(regexp_extract_all(html, '(?i)<a\b[^>]*\bhref\s*=\s*"([^"]*)"', 1)) AS INTEGER) AS n_links FROM pages""",
)
def q_ingest_pages(spark, sf):
    """The pages table is landed twice as separate files (a re-crawl); the
    stream ingests them in batches of few files and must end equal to the batch
    extraction with each page once."""
    from hestia.streaming.ingest import BATCH, BUCKET, ingest_pages, page_record

    root = scratch_dir(spark, "ingest")
    land, out, ckpt = f"{root}/landed", f"{root}/table", f"{root}/checkpoint"
    pages = _pages(spark, sf)
    pages.write.mode("overwrite").parquet(land)
    pages.write.mode("append").parquet(land)
    ingest_pages(spark, land, out, ckpt, page_record, ["page_id"], max_files_per_trigger=4)
    return spark.read.parquet(out).drop(BATCH, BUCKET)


@register(
    "card_dates_typed",
    v=True,
    sql=""", K AS (SELECT ville, CAST(split_part(string_split(lien, '/')[-1], '-', 1) AS BIGINT) AS ok FROM V),
D AS (SELECT 'publié le ' || lpad(CAST(ok % 28 + 1 AS VARCHAR), 2, '0') || '/' || lpad(CAST(ok % 12 + 1 AS VARCHAR), 2, '0')
             || '/' || CAST(ok % 5 + 2020 AS VARCHAR) || ', ' || translate(ville, '_0123456789', '-abcdefghij') || ' (69)' AS t
      FROM K)
SELECT CAST(try_strptime(regexp_extract(t, '(\\d{2}/\\d{2}/\\d{4})', 1), '%d/%m/%Y') AS DATE) AS date,
       coalesce(nullif(trim(regexp_extract(t, '([A-ZÀ-Ÿa-zà-ÿ\\-\\s]+)\\s*\\((\\d{2})\\)', 0)), ''), 'Lyon') AS place,
       count(*) AS count FROM D GROUP BY 1, 2""",
)
def q_card_dates_typed(spark, sf):
    """Typed date capture and capture-with-default on ad text."""
    v = _ad_keys(listing_view(spark, sf))
    ok = F.col("__ok")
    place = F.translate("ville", "_0123456789", "-abcdefghij")
    t = F.concat(F.lit("publié le "), _card_date(ok), F.lit(", "), place, F.lit(" (69)"))
    d = v.select(t.alias("t"))
    from hestia.operators.aggregate import group_count

    return group_count(
        d,
        [T.capture_date("t", typed=True).alias("date"), T.capture_or("t", T.PLACE_DEPT, "Lyon").alias("place")],
    )
