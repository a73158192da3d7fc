"""Clean raw listings with declarative rules.

Order is fixed (energy class inference runs before the description
fallback; the floor sentinel before the per-type floor default). Each stage
is one ``withColumns`` so Catalyst collapses the whole chain into a single
projection over the scan: one pass, no shuffle, until the caller's sink.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hestia.functions.rules import bin_labels, cascade
from hestia.functions.text import SALE_PREFIX, any_contains, strip_pattern
from hestia.operators.relational import drop_outliers

# Energy-class rules, tried in order on the lower-cased
# description (substring tests). The last rule also fires when the text
# does not mention "dpe" at all or is missing.
DPE_RULES = [
    (["non soumis au dpe"], "Non soumis"),
    (["dpe a"], "A"),
    (["dpe : d"], "D"),
]
DPE_UNKNOWN = ["dpe en cours", "dpe non communiqu", "dpe : non communiqu", "dpe vierge", "dpe est vierge"]
DPE_UNKNOWN_LABEL = "Inconnu"

# Rooms imputation, area per room by type and area band
# (< 150, < 250, >= 250 m²).
ROOM_EDGES = [150, 250]
ROOM_RATIOS = {
    "Appartement": [22.67, 30.4, 47.57],
    "Maison": [23.33, 27.83, 38.8],
}

# Phrases that mark a top floor (sentinel -1).
TOP_FLOOR_WORDS = ["dernier etage", "dernier étage", "etage eleve", "étage élevé", "haut etage", "haut étage"]
TOP_FLOOR_VALUE = -1

# Default floor by type when still unknown.
FLOOR_DEFAULTS = {"Appartement": 1, "Maison": 0}

# Price per m² band and the area cap for outliers.
PRICE_M2_BAND = (500, 25000)
AREA_CAP = 925


@dataclass
class CleaningRules:
    dpe_rules: Sequence = field(default_factory=lambda: list(DPE_RULES))
    dpe_unknown: Sequence[str] = field(default_factory=lambda: list(DPE_UNKNOWN))
    room_edges: Sequence[float] = field(default_factory=lambda: list(ROOM_EDGES))
    room_ratios: Mapping[str, Sequence[float]] | None = field(default_factory=lambda: dict(ROOM_RATIOS))
    top_floor_words: Sequence[str] = field(default_factory=lambda: list(TOP_FLOOR_WORDS))
    floor_defaults: Mapping[str, int] = field(default_factory=lambda: dict(FLOOR_DEFAULTS))
    price_m2_band: tuple = PRICE_M2_BAND
    area_cap: float = AREA_CAP


def dpe_inference(dpe: Column, low_text: Column, rules: CleaningRules) -> Column:
    """T6 cascade for the energy class (null-only rules).

    Where every needle contains "dpe", a text without it (or a missing
    text) goes straight to the unknown label and skips the needle tests; the
    result equals the plain first-match cascade.
    """
    needles = [n for ns, _ in rules.dpe_rules for n in ns] + list(rules.dpe_unknown)
    has = low_text.contains("dpe") if all("dpe" in n for n in needles) else any_contains(low_text, needles)
    steps = [(any_contains(low_text, ns), label) for ns, label in rules.dpe_rules]
    steps.append((any_contains(low_text, rules.dpe_unknown), DPE_UNKNOWN_LABEL))
    inferred = cascade(steps, None)
    return (
        F.when(dpe.isNotNull(), dpe)
        .when(low_text.isNull() | ~has, F.lit(DPE_UNKNOWN_LABEL))
        .otherwise(inferred)
    )


def band_index(area: Column, edges: Sequence[float]) -> list[Column]:
    """Conditions for each band: ``< e0``, ``< e1``, ..., ``>= last``."""
    conds = [area < F.lit(e) for e in edges]
    conds.append(area >= F.lit(edges[-1]))
    return conds


def rooms_by_ratio(
    rooms: Column, area: Column, kind: Column, edges: Sequence[float], ratios: Mapping[str, Sequence[float]]
) -> Column:
    """T10 (constant table form): null rooms → round(area / ratio[type][band])."""
    steps = []
    for t, rs in ratios.items():
        for cond, r in zip(band_index(area, edges), rs):
            steps.append((rooms.isNull() & (kind == t) & cond, F.round(area / F.lit(r))))
    return cascade(steps, rooms)


def fit_room_ratios(df: DataFrame, edges: Sequence[float], kinds: Sequence[str] = ("Appartement", "Maison")) -> DataFrame:
    """T10 (fitted form): median area per room by type and band, as a small
    table ``(type_bien, band, ratio)`` — one aggregate, bounded by
    types × bands rows."""
    band = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        band = F.when(F.col("surface") < F.lit(edges[i]), F.lit(i)).otherwise(band)
    rows = df.filter(
        F.col("surface").isNotNull() & F.col("pieces").isNotNull() & (F.col("pieces") > 0)
        & F.col("type_bien").isin(list(kinds))
    )
    return rows.groupBy("type_bien", band.alias("band")).agg(
        F.percentile_approx(F.col("surface") / F.col("pieces"), 0.5, 10000).alias("ratio")
    )


def clean_listings(df: DataFrame, rules: CleaningRules | None = None, drop_bad: bool = True) -> DataFrame:
    """E1 over a raw-ads DataFrame (columns of the raw schema)."""
    r = rules or CleaningRules()
    # The lowered text is its own column so the many substring rules share
    # one evaluation per row (Catalyst keeps a multiply-used expression in
    # its own projection). Each rule has one of its own, lowered only in the
    # rows that the rule fills, so a caller that drops a rule's column pays for
    # none of its texts.
    s0 = df.withColumn("__low_dpe", F.when(F.col("DPE").isNull(), F.lower(F.col("full_description"))))
    s1 = s0.withColumns({"DPE": dpe_inference(F.col("DPE"), F.col("__low_dpe"), r)}).drop("__low_dpe")
    s2 = s1.withColumns({"full_description": F.coalesce(F.col("full_description"), F.col("description"))})
    s2 = s2.withColumn("__low", F.when(F.col("etage").isNull(), F.lower(F.col("full_description"))))
    if r.room_ratios is not None:
        rooms = rooms_by_ratio(F.col("pieces"), F.col("surface"), F.col("type_bien"), r.room_edges, r.room_ratios)
        s3 = s2.withColumns({"pieces": rooms.cast("double")})
    else:
        s3 = _fill_rooms_from_data(s2, r.room_edges)
    low = F.col("__low")
    hit = any_contains(low, r.top_floor_words)
    # Where every phrase contains "tage", one test skips the others.
    if all("tage" in w for w in r.top_floor_words):
        hit = low.contains("tage") & hit
    top = F.when(F.col("etage").isNull() & hit, F.lit(TOP_FLOOR_VALUE)).otherwise(F.col("etage"))
    s4 = s3.withColumns({"etage": top})
    kind = F.col("type_bien")
    default = cascade([(F.col("etage").isNull() & (kind == t), v) for t, v in r.floor_defaults.items()], F.col("etage"))
    s5 = s4.withColumns({"etage": default}).drop("__low")
    out = s5
    if drop_bad:
        lo, hi = r.price_m2_band
        out = drop_outliers(out, "prix", "surface", lo, hi, {"surface": r.area_cap})
    return out.withColumns({"ville": F.trim(strip_pattern(F.lower(F.col("ville")), SALE_PREFIX, guard="vente"))})


def _fill_rooms_from_data(df: DataFrame, edges: Sequence[float]) -> DataFrame:
    table = fit_room_ratios(df, edges)
    band = F.lit(len(edges))
    for i in reversed(range(len(edges))):
        band = F.when(F.col("surface") < F.lit(edges[i]), F.lit(i)).otherwise(band)
    # Two types times the bands: a handful of rows.
    t = F.broadcast(
        table.select(F.col("type_bien").alias("__t"), F.col("band").alias("__b"), F.col("ratio").alias("__r"))
    )
    j = df.withColumn("__band", band).join(
        t, (F.col("type_bien") == F.col("__t")) & (F.col("__band") == F.col("__b")), "left"
    )
    filled = F.when(F.col("pieces").isNull(), F.round(F.try_divide(F.col("surface"), F.col("__r")))).otherwise(
        F.col("pieces")
    )
    return j.withColumn("pieces", filled.cast("double")).drop("__band", "__t", "__b", "__r")


SURFACE_BANDS = ([40, 70, 100, 150], ["<40", "40-70", "70-100", "100-150", "150+"])


def with_surface_bin(df: DataFrame) -> DataFrame:
    edges, labels = SURFACE_BANDS
    return df.withColumn("surface_bin", bin_labels("surface", edges, labels))
