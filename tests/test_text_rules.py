"""Hand-written edge rows (FIXTURES.md) for the text and rule functions."""

from pyspark.sql import functions as F

from hestia.functions import rules as R
from hestia.functions import text as T
from hestia.operators.joins import apply_aliases
from hestia.plans.fuse import PLACE_ALIASES


def one(spark, expr, value, dtype="string"):
    df = spark.createDataFrame([(value,)], f"x {dtype}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_floor_digits(spark):
    cases = {
        "au 3ème étage": 3,
        "au 2e et dernier étage": 2,
        "4° ETAGE": 4,
        "3eme Étage": 3,
        "etage 5": None,
        "deuxième … première": 1,
        "RDC sur cour": 0,
        "": None,
    }
    for text, want in cases.items():
        assert one(spark, T.extract_floor, text) == want, text
    assert one(spark, T.extract_floor, None) is None


def test_area(spark):
    assert one(spark, T.parse_area, "Vente Appartement 75,5 m² Lyon") == 75.5
    assert one(spark, T.parse_area, "3 minutes du metro 75 m²") == 3.0
    assert one(spark, lambda c: T.parse_area(c, strict=True), "3 minutes du metro 75 m²") == 75.0
    assert one(spark, T.parse_area_field, "75 m²") == 75
    assert one(spark, T.parse_area_field, "75,5 m²") is None


def test_price(spark):
    assert one(spark, T.parse_price, "250\u00a0000 €") == 250000
    assert one(spark, T.parse_price, "250\u202f000 €") == 250000
    assert one(spark, T.parse_price, "250 000 €") == 250000
    assert one(spark, T.parse_price, "prix sur demande") is None


def test_rooms_and_tokens(spark):
    assert one(spark, T.parse_rooms, "3 pièces") == 3
    assert one(spark, T.parse_rooms, "1 pièce") == 1
    toks = one(spark, T.tokens, "Appartement à Lyon, l'été cœur naïf Öl vue")
    assert toks == ["appartement", "lyon", "naïf"]


def test_city_folding_and_suffix(spark):
    assert one(spark, T.fold_accents, "Saint-Étienne-la-Varenne") == "saint etienne la varenne"
    strip = lambda c: F.trim(T.strip_pattern(c, T.DISTRICT_SUFFIX))
    assert one(spark, strip, "lyon 3e") == "lyon"
    assert one(spark, strip, "lyon 1er") == "lyon 1er"
    assert one(spark, strip, "lyon 12e arr") == "lyon arr"
    prefix = lambda c: F.trim(T.strip_pattern(F.lower(c), T.SALE_PREFIX))
    assert one(spark, prefix, "Vente Appartement  Sainte-Foy-Les-Lyon") == "sainte-foy-les-lyon"


def test_aliases(spark):
    f = lambda c: apply_aliases(c, PLACE_ALIASES)
    assert one(spark, f, "oullins") == "oullins pierre benite"
    assert one(spark, f, "pierre benite") == "oullins pierre benite"
    assert one(spark, f, "lyon") == "lyon"


def test_floor_label(spark):
    df = spark.createDataFrame([("maison", 0), ("appartement", 0), ("appartement", 3), ("appartement", None)], "t string, e int")
    got = [r["l"] for r in df.select(T.floor_label("t", "e").alias("l")).collect()]
    assert got == ["MAISON", "RDC", "3", None]
    # A CSV-borne double floor still reads as an integer label.
    d2 = spark.createDataFrame([("appartement", 1.0)], "t string, e double")
    assert d2.select(T.floor_label("t", "e").alias("l")).first()["l"] == "1"


def test_bins_and_fills(spark):
    edges, labels = [40, 70, 100, 150], ["<40", "40-70", "70-100", "100-150", "150+"]
    assert one(spark, lambda c: R.bin_labels(c, edges, labels), None, "double") == "150+"
    assert one(spark, lambda c: R.bin_labels(c, edges, labels), 39.9, "double") == "<40"
    df = spark.createDataFrame([(None, "Maison"), (None, "Terrain"), (2, "Maison")], "e int, t string")
    got = [r["e"] for r in df.select(R.fill_by_category("e", "t", {"Appartement": 1, "Maison": 0}).alias("e")).collect()]
    assert got == [0, None, 2]


def test_nfkc(spark):
    assert one(spark, T.nfkc, "75 m² Lyon") == "75 m2 Lyon"
    assert one(spark, lambda c: T.nfkc(c, cheap=True), "75 m² Lyon") == "75 m2 Lyon"


def test_context_matches(spark):
    import re

    for text in [
        "Bel appartement au 3ème étage avec vue, dernier Etage refait",
        "étage. " + "x" * 50 + " ÉTAGE haut",
        "rien ici",
    ]:
        want = re.findall(r".{0,20}[eéE]tage.{0,20}", text, re.IGNORECASE)
        assert list(one(spark, T.context_matches, text)) == want, text
