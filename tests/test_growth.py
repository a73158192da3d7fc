"""What keeps disk, memory and time in proportion to the input (round 3's findings F1 to F18)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def files_under(root: str, ending: str) -> list[str]:
    return [f for _, _, files in os.walk(root) for f in files if f.startswith("part-") and f.endswith(ending)]


def test_compressed_csv_round_trip(spark, tmp_path):
    from hestia.sources import csv as CSV

    df = spark.createDataFrame([(1, 'a "b",\nc'), (2, None), (3, " é ")], "n int, t string")
    CSV.write_csv(df, str(tmp_path / "c"), bom=True, compression="gzip")
    assert files_under(str(tmp_path), ".csv.gz") and not files_under(str(tmp_path), ".csv")
    back = CSV.read_listings_csv(spark, str(tmp_path / "c"), df.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_fuse_chain_files_are_compressed(spark, tmp_path, monkeypatch):
    from hestia.suite import pipelines as P

    monkeypatch.setattr(P, "scratch_dir", lambda spark, name: str(tmp_path / name))
    P.q_fuse_chain(spark, SF)
    assert files_under(str(tmp_path), ".csv.gz") and not files_under(str(tmp_path), ".csv")


def test_collect_fetches_html_of_linked_pages_only(spark):
    from hestia.plans.collect import collect_listings

    html = "<html><title>Vente Maison 50 m² X</title><h1 class='annonce-immobilier'>m</h1></html>"
    pages = spark.createDataFrame([("https://a/1", 1), ("https://a/2", 2), ("https://a/2", 3), (None, 4)], "url string, key int")
    lists = spark.createDataFrame([("<div class='results'><a href='https://a/2'>x</a></div>",)], "html string")
    seen = []

    def fetch(kept):
        seen.append(sorted(r["key"] for r in kept.collect()))
        return kept.select("url", F.lit(html).alias("html"))

    got = collect_listings(pages, lists, "https://a/", fetch=fetch).select("lien", "surface").collect()
    assert seen == [[2, 3]]
    whole = pages.select("url", F.lit(html).alias("html"))
    assert sorted(got) == sorted(collect_listings(whole, lists, "https://a/").select("lien", "surface").collect())


def test_collect_chain_finds_links_before_texts(spark, tmp_path, monkeypatch):
    from hestia.plans import collect as C
    from hestia.suite import extraction as X

    found = []
    monkeypatch.setattr(X, "scratch_dir", lambda spark, name: str(tmp_path / name))
    monkeypatch.setattr(C, "write_csv", lambda df, path, **k: found.append(df))
    monkeypatch.setattr(C, "read_listings_csv", lambda spark, path: None)
    X.q_collect_chain(spark, SF)
    text = plan(found[0])
    # The join that brings the texts stands above the one that finds linked pages.
    assert text.index("doc_id") < text.index("LeftSemi")


def test_quantiles_meet_bounds_as_counted_values(spark):
    from hestia.operators import aggregate as A

    df = spark.range(4000).select(F.when(F.col("id") % 4 > 0, 7.0).otherwise(F.col("id").cast("double")).alias("a"), F.lit(None).cast("double").alias("b"))
    q = A.quantiles(df, ["a", "b"], [0.0, 0.5, 1.0], exact=True)
    assert {(r["column_name"], r["prob"]): r["value"] for r in q.collect()} == {("a", 0.0): 0.0, ("a", 0.5): 7.0, ("a", 1.0): 3996.0}
    assert "__share" in plan(q)  # a column's values never meet in one task


def test_quantiles_of_null_groups(spark):
    from hestia.operators import aggregate as A

    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("x", -0.0), ("x", 0.0), ("x", None)], "k string, v double")
    got = {r["k"]: r["values"] for r in A.exact_quantiles(df, ["k"], "v", [0.5]).collect()}
    assert got == {None: [2.0], "x": [0.0]}


def test_duplicate_groups_read_rows_once(spark):
    from hestia.operators.aggregate import duplicate_groups

    df = spark.createDataFrame([(None, 0.0), (None, -0.0), ("a", 1.0), ("b", 2.0), ("b", 2.0), ("b", 2.0)], "k string, v double")
    found = duplicate_groups(df, ["k", "v"])
    assert [tuple(r) for r in found.collect()] == [("b", 2.0, 3), (None, 0.0, 2)]
    assert "Join" not in plan(found)


def test_clean_lowers_only_texts_that_a_rule_needs(spark):
    from hestia.plans.clean import clean_listings

    kept = plan(clean_listings(spark.read.schema("titre string, description string, ville string, type_bien string, etage int, prix double, surface double, "
                                                 "pieces int, DPE string, full_description string, lien string").csv(SF), drop_bad=False).select("etage"))  # fmt: skip
    at = kept.index("lower(coalesce(full_description")
    assert "isnull(etage" in kept[max(0, at - 60) : at]
    assert "lower(full_description" not in kept


def test_market_center_and_split_run_fusion_once(spark):
    from hestia.suite.modelling import q_split
    from hestia.suite.pipelines import q_market_center

    assert "parquet" not in plan(q_market_center(spark, SF))
    assert "parquet" not in plan(q_split(spark, SF))


def test_classes_are_read_once_a_template():
    from hestia.functions import html as H

    H._cached_classes.cache_clear()
    page = '<DIV class="a b"><p>x</p></DIV><b class="%s">y</b>' % ("q " * 200)
    for _ in range(3):
        found = H.page_elements(page)
    assert [(name, sorted(classes)) for name, classes, _, _ in found] == [("div", ["a", "b"]), ("p", []), ("b", ["q"])]
    assert H._cached_classes.cache_info().misses == 1  # long attributes aren't kept


def test_models_score_the_test_split_once(spark):
    from hestia.plans import model as M

    rows = [(100.0 + i, "maison" if i % 2 else "appartement", str(i % 5), float(20 + i % 60), float(i % 6), f"v{i % 4}", 69000 + i % 4) for i in range(300)]
    fused = spark.createDataFrame(rows, "prix double, type_bien string, etage string, surface double, pieces double, ville string, code_postal int")
    m = M.fit_price_models(spark, fused, {"dt": {"maxDepth": [2]}}, folds=2)
    assert "UDF" not in plan(m.scored["dt"]) and m.scored["dt"].columns == ["prix", "prediction"]
    assert m.comparison.first()["n"] == m.scored["dt"].count()


def test_packed_texts_come_back(spark):
    from hestia.functions import text as T

    rows = [(1, ["é & <b>", "", None]), (2, []), (3, ["x" * 5000, "中🙂\u0000"]), (4, None)]
    df = spark.createDataFrame(rows, "k int, t array<string>")
    kept = df.select("k", F.posexplode_outer("t").alias("i", "x")).withColumn("p", T.packed("x"))
    assert kept.where("length(x) = 5000 and length(p) < 100 or x is null and p is null").count() == 4
    lists = kept.groupBy("k").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "p"))), lambda s: s["p"]).alias("ps"))
    back = {r["k"]: r["b"] for r in lists.select("k", T.unpacked("ps").alias("b")).collect()}
    assert back == {1: rows[0][1], 2: [None], 3: rows[2][1], 4: [None]}
    assert spark.sql("select cast(null as array<binary>) n").select(T.unpacked("n").alias("b")).first()["b"] == []


def test_pages_are_dealt_keys_and_packed_texts(spark):
    from hestia.suite import extraction as X

    for pages in (X.card_pages(spark, SF), X.price_card_pages(spark, SF)):
        above, below = plan(pages).split("RepartitionByExpression [__page", 1)
        assert "full_description" in above or "<span" in above
        for built in ("<span", "€", "Vente ", "full_description"):
            # The page's hash alone reads a link and a title; no card is made before ads meet on their page.
            assert built not in below or built == "Vente "


def test_cards_of_odd_rows_equal_the_sql(spark, tmp_path):
    import duckdb

    from hestia.suite import extraction as X
    from hestia.suite.registry import ORACLES, QUERIES

    long = "un très bel appartement avec vue sur le parc & la rivière, proche des écoles, des commerces et du métro"
    ads = [(o, p, s, 1 + o % 3, 10.0 + o, 25000.0 + o, "R" if o % 2 else "N", "OF"[o % 2]) for o, p, s in
           [(1, 1, 1), (1, 1, 1), (2, 2, 2), (3, 8, 3), (4, 3, 4), (5, 9, 1), (6, 4, 9), (7, 1, 2), (11, 3, 3), (21, 1, None)]]
    tables = {
        "lineitem": (ads, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_returnflag string, l_linestatus string"),
        "supplier": ([(1, 0), (2, 1), (3, 1), (4, 0), (4, 1)], "s_suppkey long, s_nationkey int"),
        "nation": ([(0, "FRANCE"), (1, "PERU")], "n_nationkey int, n_name string"),
        "documents": ([(1, long), (2, None), (3, ""), (3, long.upper()), (4, long), (None, long)], "doc_id long, text string"),
    }
    db = duckdb.connect()
    for name, (rows, schema) in tables.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    assert X.card_pages(spark, str(tmp_path)).count() > 1
    for name in ("listing_cards", "price_cards"):
        found = QUERIES[name](spark, str(tmp_path))
        wanted = db.sql(ORACLES[name])
        assert sorted(map(repr, map(tuple, found.select(*wanted.columns).collect()))) == sorted(map(repr, wanted.fetchall()))


def test_batches_of_pages_are_read_like_single_ones():
    """``read_fields`` against ``page_elements``, page by page, on odd markup; a regular batch parses each different tag once."""
    import random

    import pyarrow as pa

    from hestia.functions import html as H

    paths = [[("div", "a")], [("div", "a"), ("div", "b")], [("h1", None)], [(None, "b")], [("p", None), (None, "a"), ("p", None)]]
    tags = ['<div class="a">', "<div class=b>", "<DIV CLASS='x a'>", "</div>", "</DIV >", "<p>", "</p>", '<h1 class="a b">', "</h1>", "<br/>", "é", "\xa0", "&amp;", "&#233;", ""]
    odd = ["<", ">", "a<b", "<!-- c -->", "< div>", "<div", '<b x=">">']
    rnd = random.Random(3)

    def alone(page, text):
        elements = H.page_elements(page or "")
        found = [H._content(page, elements, p) if elements else None for p in paths]
        return tuple(H._finished(x) for x in found) if text else tuple(found)

    for _ in range(200):
        pages = [None if rnd.random() < 0.1 else "".join(rnd.choices(tags + odd * (rnd.random() < 0.3), k=rnd.randrange(30))) for _ in range(rnd.randrange(6))]
        pages += ['<div class="a">' + "<div>" * 150 + "y" + "</div>" * 151 + "z"] * (rnd.random() < 0.05)
        for kind in (pa.string(), pa.large_string()):
            batch = pa.array(["<p>", *pages, "</p>"], kind).slice(1, len(pages))
            for text in (True, False):
                assert list(zip(*[x.to_pylist() for x in H.read_fields(batch, paths, text)])) == [alone(p, text) for p in pages]
    H._cached_classes.cache_clear()
    H.read_fields(pa.array(["<p><div class='a'>x</div></p>"] * 50), paths)
    info = H._cached_classes.cache_info()
    assert info.misses == 1 and info.hits == 0


def test_ascii_texts_stay_in_spark(spark):
    from hestia.functions import text as T

    rows = ["plain", "", None, "75 m² à ﬁn ①", "a b", "é", "m³ ½", "\u007f"]
    df = spark.createDataFrame([(x,) for x in rows], "t string")
    got = df.select("t", T.nfkc("t").alias("full"), T.nfkc("t", cheap=True).alias("cheap")).collect()
    import unicodedata

    assert [r.full for r in got] == [x and unicodedata.normalize("NFKC", x) for x in rows]
    assert [r.cheap for r in got] == [x and x.translate(dict(zip(map(ord, T.NFKC_CHEAP_FROM), T.NFKC_CHEAP_TO))) for x in rows]
    assert "octet_length" in plan(df.select(T.nfkc("t")))


def test_ads_meet_documents_as_keys(spark):
    from hestia.suite import extraction as X

    above, below = plan(X.detail_pages(spark, SF)).split("LeftOuter", 1)
    assert "Vente " in above and "Vente " not in below
    assert "&eacute;" in below  # texts are made page source once a document


def test_ground_floor_words_hold_their_guard(spark):
    from hestia.functions import text as T

    df = spark.createDataFrame([(w.upper(),) for w in T.GROUND_WORDS] + [("chaussure",)], "t string")
    assert [r.f for r in df.select(T.extract_floor("t").alias("f")).collect()] == [0] * len(T.GROUND_WORDS) + [None]


def test_collect_listings_normalises_every_character(spark, monkeypatch):
    """full NFKC (ligatures, circled digits, fractions), not four characters."""
    from hestia.suite import extraction as X

    html = "<html><title>Vente ﬂat 50 m² X</title><h1 class='annonce-immobilier'>① ½</h1><div class='ep-desc-truncated'>ﬁn</div></html>"
    monkeypatch.setattr(X, "detail_pages", lambda spark, sf: spark.createDataFrame([("u", html)], "url string, html string"))
    (r,) = X.q_collect_listings(spark, SF).collect()
    assert (r.titre, r.description, r.full_description, r.surface) == ("Vente flat 50 m2 X", "1 1⁄2", "fin", 50.0)
