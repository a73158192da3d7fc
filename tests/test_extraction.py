"""Hand-written pages for the extraction operators."""

from hestia.functions import html as H
from hestia.operators import extract as X


def test_cards(spark):
    html = (
        '<html><body><div class="blocAnnonce" data-id="42"><a href="/a" title=" Maison 5 pièces "></a>'
        "<span>350 000 €</span><span>120 m²</span><span>5 pièces</span><span>3 chambres</span>"
        "<span>Villeurbanne (69)</span><p>Belle maison familiale avec jardin arboré, garage double, "
        "proche des écoles et des commerces du centre-ville.</p><span>12/03/2024</span></div>"
        '<div class="blocAnnonce" data-id="43"><span>Prix sur demande</span></div></body></html>'
    )
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = {r["id"]: r for r in X.extract_listing_cards(pages).collect()}
    a = rows["42"]
    assert a["titre"] == "Maison 5 pièces"
    assert a["prix"] == "350 000 €"
    assert a["surface"] == "120 m²" and a["pieces"] == "5" and a["chambres"] == "3"
    assert a["localisation"] == "Villeurbanne (69)"
    assert a["description"].startswith("Belle maison familiale") and a["date"] == "12/03/2024"
    b = rows["43"]
    assert b["titre"] is None and b["prix"] is None and b["localisation"] == "Lyon"


def test_price_cards(spark):
    html = (
        '<div class="css-wb0bqw"><span class="css-1ilgral">289 000 €</span>'
        '<span class="css-jeruic">Appartement, 3 pièces</span>'
        '<div class="css-1mqggk6">Lyon 3e,\nbalcon</div><span class="css-1bola4h">Lyon</span></div>'
        '<div class="css-wb0bqw"><span class="css-jeruic">Maison</span></div>'
    )
    pages = spark.createDataFrame([(1, html)], "page_id long, html string")
    rows = X.extract_price_cards(pages).collect()
    assert len(rows) == 1  # the card without a price is skipped
    r = rows[0]
    assert r["prix"] == "289000"
    assert r["type_de_bien"] == "Appartement  3 pièces"
    assert r["details"] == "Lyon 3e, balcon"  # fallback class, commas kept, newline → space
    assert r["zone"] == "Lyon"


def test_detail_page(spark):
    html = (
        "<html><head><title>Vente Appartement 75 m² Paris-14e</title></head><body>"
        '<h1 class="annonce-immobilier">Appartement 75 m² à Paris</h1>'
        '<div class="ep-price">250 000 €</div><div class="ep-area">75 m²</div>'
        '<div class="ep-room">3 pièces</div><div class="ep-desc-truncated">Au 2e et dernier étage &amp; vue</div>'
        '<div class="dpe-diagram"><div class="dpe-a">A</div><div class="dpe-c selected">C</div></div>'
        "</body></html>"
    )
    pages = spark.createDataFrame([("u", html)], "url string, html string")
    r = X.extract_listing_details(pages).first()
    assert r["titre"] == "Vente Appartement 75 m2 Paris-14e"
    assert r["ville"] == "Paris-14e" and r["type_bien"] == "Appartement"
    assert r["prix"] == 250000.0 and r["surface"] == 75.0 and r["pieces"] == 3
    assert r["etage"] == 2 and r["DPE"] == "C"
    assert r["full_description"] == "Au 2e et dernier étage & vue"


def _one(spark, html, column):
    return spark.createDataFrame([(html,)], "html string").select(column.alias("x")).first()["x"]


def test_elements_end_where_they_do(spark):
    import hestia.functions.html as H

    nested = '<div class="dpe-diagram"></div><div class="dpe-diagram"><div class="selected">B</div></div>'
    assert _one(spark, nested, H.nested_text("html", ("div", "dpe-diagram"), ("div", "selected"))) is None
    inside = '<div class="dpe-diagram"><div>A</div><div class="x selected">C</div></div>'
    assert _one(spark, inside, H.nested_text("html", ("div", "dpe-diagram"), ("div", "selected"))) == "C"
    body = '<div class="ep-desc-truncated">Bel appartement <div class="more">au 3ème étage</div> calme</div> autre'
    assert _one(spark, body, H.element_text("html", "div", "ep-desc-truncated")) == "Bel appartement au 3ème étage calme"
    assert _one(spark, "<div class=a>open <div>in</div> end", H.element_text("html", "div", "a")) == "open in end"
    assert _one(spark, '<div class="a"></div>', H.element_text("html", "div", "a")) is None


def test_class_tokens_and_quotes(spark):
    import hestia.functions.html as H

    old = """<div class="ep-price-old">999</div><p data-class="ep-price">1</p><div class='big ep-price'>250</div>"""
    assert _one(spark, old, H.element_text("html", "div", "ep-price")) == "250"
    assert _one(spark, "<div class=ep-price>7</div>", H.element_text("html", "div", "ep-price")) == "7"
    assert _one(spark, "<DIV CLASS='Ep-Price'>7</DIV>", H.element_text("html", "div", "ep-price")) is None
    links = """<div class="list"><a href='/t1'>x</a><a class=q href=/t2>y</a><a href="/t3?a=1&amp;b=2">z</a></div><a href="/t4">o</a>"""
    assert _one(spark, links, H.links_with_prefix("html", "/t")) == ["/t1", "/t2", "/t3?a=1&b=2", "/t4"]
    assert _one(spark, links, H.links_containing("html", "t", ("div", "list"))) == ["/t1", "/t2", "/t3?a=1&b=2"]
    assert _one(spark, "<a title='T'>x</a><a href='/u'>y</a>", H.attr("html", "a", "title")) == "T"
    assert _one(spark, "<a title='T'>x</a><a href='/u'>y</a>", H.attr("html", "a", "title", having="href")) is None


def test_references(spark):
    import hestia.functions.html as H

    text = "<p>R&eacute;sidence l&#8217;&#xE9;tage &amp;lt; &euro; &bogus; &#0; &#xD800; &#x1F600; a&b; &am</p>"
    assert _one(spark, text, H.element_text("html", "p")) == "Résidence l’étage &lt; € &bogus; &#0; &#xD800; 😀 a&b; &am"


def test_card_ends_before_the_footer(spark):
    page = (
        "<div class='blocAnnonce' data-id='7'><a title='Photo'></a><a href='/x'>Prix sur demande</a></div>"
        "<footer><div data-id='9'>990 € Paris (75) 01/01/2001</div></footer>"
    )
    from hestia.operators.extract import extract_listing_cards

    (r,) = extract_listing_cards(spark.createDataFrame([(1, page)], "page_id long, html string")).collect()
    assert (r["id"], r["titre"], r["prix"], r["localisation"], r["date"]) == ("7", "", None, "Lyon", None)


def test_page_regexes_run_once(spark):
    import contextlib
    import io

    from hestia.operators.extract import extract_listing_details

    df = extract_listing_details(spark.createDataFrame([("u", "<p>")], "url string, html string"), nfkc_cheap=True)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="extended")
    assert "nullif(regexp_extract" not in buf.getvalue() and "if ((regexp_extract(html" not in buf.getvalue()


def test_one_scan_reads_what_each_field_reads(spark):
    """``element_fields`` against the single-field columns, on odd markup."""
    pages = [
        '<div class="a">x<div class="b c">y &amp; <b>z</b></div>w</div><div class=b>late</div>',
        "<DIV Class='a'> <div>open <div class=\"b\">in &#233;&#xE9;&#0;&nope;&eacute; </div>",
        '</div><div class="ab">no</div><div class="a"></div><p class="b">p</p>',
        '<div class="a" id=x><img class="b" /><br/>t</div>', "plain", "", None, "<div class='a'>&#99999999999999999999999;&#xD800;</div>",
        '<h1 class="a">one</h1><div\nclass = "a\tq">two</div>', '<div class="b"><div class="a"><div class="b"> <i>deep</i> </div></div></div>',
    ]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    f = {"a": [("div", "a")], "b": [("div", "b")], "ab": [("div", "a"), ("div", "b")], "h1": [("h1", None)], "any": [(None, "b")]}
    one = df.select("i", H.element_fields("html", f).alias("f")).select("i", "f.*")
    each = df.select(
        "i", H.element_text("html", "div", "a").alias("a"), H.element_text("html", "div", "b").alias("b"),
        H.nested_text("html", ("div", "a"), ("div", "b")).alias("ab"), H.element_text("html", "h1").alias("h1"), H.finish_text(H.any_element_html("html", "b")).alias("any"),
    )
    assert one.orderBy("i").collect() == each.orderBy("i").collect()
    raw = df.select("i", H.element_fields("html", {"a": [("div", "a")]}, text=False)["a"].alias("a"))
    assert raw.orderBy("i").collect() == df.select("i", H.element_html("html", "div", "a").alias("a")).orderBy("i").collect()
