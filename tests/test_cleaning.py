"""E1 rules on hand-written rows, and invariants on the listing view."""

from pyspark.sql import functions as F

from hestia.operators.aggregate import null_profile
from hestia.plans.clean import clean_listings
from hestia.sources.csv import LISTING_SCHEMA
from hestia.sources.tables import listing_view


def raw(spark, rows):
    base = dict(titre="t", description="d", ville="Vente Maison Lyon", type_bien="Appartement", etage=None,
                prix=300000.0, surface=68.0, pieces=None, DPE=None, full_description=None, lien="u")
    data = []
    for r in rows:
        x = dict(base)
        x.update(r)
        data.append(tuple(x[f.name] for f in LISTING_SCHEMA.fields))
    return spark.createDataFrame(data, LISTING_SCHEMA)


def test_dpe_rules(spark):
    df = raw(spark, [
        dict(lien="a"),  # null text -> Inconnu
        dict(lien="b", full_description="Joli bien. DPE : C"),  # other mention stays null
        dict(lien="c", full_description="bien non soumis au DPE"),
        dict(lien="d", full_description="vue dégagée"),  # no dpe mention -> Inconnu
        dict(lien="e", DPE="B", full_description="dpe a"),  # known class kept
    ])
    got = {r["lien"]: r["DPE"] for r in clean_listings(df, drop_bad=False).collect()}
    assert got == {"a": "Inconnu", "b": None, "c": "Non soumis", "d": "Inconnu", "e": "B"}


def test_rooms_floor_and_place(spark):
    df = raw(spark, [
        dict(lien="a"),
        dict(lien="b", type_bien="Terrain"),
        dict(lien="c", full_description="au dernier étage"),
    ])
    got = {r["lien"]: r for r in clean_listings(df, drop_bad=False).collect()}
    assert got["a"]["pieces"] == 3.0
    assert got["b"]["pieces"] is None
    assert got["a"]["etage"] == 1 and got["c"]["etage"] == -1 and got["b"]["etage"] is None
    assert got["a"]["ville"] == "lyon"
    assert got["a"]["full_description"] == "d"


def test_outliers(spark):
    df = raw(spark, [
        dict(lien="ok", prix=300000.0, surface=68.0),
        dict(lien="noprice", prix=None),
        dict(lien="cheap", prix=499.0, surface=1.0),
        dict(lien="huge", prix=925.0 * 3000, surface=925.0),
    ])
    assert [r["lien"] for r in clean_listings(df).collect()] == ["ok"]


def test_null_counts_never_rise(spark, sf):
    v = listing_view(spark, sf)
    before = {r["column_name"]: r["n_null"] for r in null_profile(v).collect()}
    after = {r["column_name"]: r["n_null"] for r in null_profile(clean_listings(v, drop_bad=False)).collect()}
    for c in ("etage", "pieces", "DPE", "full_description"):
        assert after[c] <= before[c], c
    assert after["full_description"] == 0


def test_rules_with_other_words(spark):
    from hestia.plans.clean import CleaningRules, clean_listings

    cols = "titre string, description string, ville string, type_bien string, etage int, prix double, surface double, pieces int, DPE string, full_description string, lien string"
    rows = [("t", "d", "Lyon", "Appartement", None, 200000.0, 50.0, 2, None, "Penthouse, classe energie : b", "u")]
    rules = CleaningRules(top_floor_words=["penthouse"], dpe_rules=[(["classe energie : b"], "B")], dpe_unknown=["sans classe"])
    r = clean_listings(spark.createDataFrame(rows, cols), rules).first()
    assert (r["etage"], r["DPE"]) == (-1, "B")


def test_market_report(spark):
    from hestia.plans.market import market_report

    df = spark.createDataFrame([(100000.0 * i, "maison" if i % 2 else "appartement", "1", 50.0, 2.0, f"lyon {i % 3}", "69001") for i in range(1, 9)], "prix double, type_bien string, etage string, surface double, pieces double, ville string, code_postal string")
    report = market_report(df)
    assert report["type_share"].count() == 2 and report["price_vs_area"].count() == 8
    assert report["price_center"].first()["median_price"] == 450000.0
    assert [r["ville"] for r in report["top_cities"].collect()][0] == "lyon 2" and report["top_per_type"].count() == 8
