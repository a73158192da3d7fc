"""Conform two listing sources and merge them.

Place names are folded (lower, accents, hyphens), district suffixes
stripped, aliases mapped n:1, floors recoded to labels, and each ad of the
first source gets its commune code from a place dimension parsed from
``Name (code)`` lines. The two sources are unioned on their shared columns
and de-duplicated.

Scale notes: the dimension is de-duplicated on the join key and broadcast
only behind a size check (``joins.enrich``), so a city that holds a third
of all ads never becomes a skewed shuffle partition; the final
``distinct`` is one aggregate whose partial phase collapses repeats within
each task first.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hestia.functions.text import DISTRICT_SUFFIX, floor_label, fold_accents, strip_pattern
from hestia.operators.joins import apply_aliases, enrich
from hestia.operators.setops import union_common

# Place aliases (old name → current commune), folded form.
PLACE_ALIASES = {
    "grigny": "grigny sur rhone",
    "saint maurice sur dargoire": "chabaniere",
    "belleville": "belleville en beaujolais",
    "oullins": "oullins pierre benite",
    "pierre benite": "oullins pierre benite",
    "liergues": "porte des pierres dorees",
    "le bois d'oingt": "val d'oingt",
    "oingt": "val d'oingt",
}

# Fixed value: the line form of the place dimension, ``Name (code)``.
PLACE_LINE = r"(.*)\s\((\d+)\)"


def explode_lines(df: DataFrame, text_col: str, col: str = "line") -> DataFrame:
    """A table of text blocks → one row per line."""
    return df.select(F.explode(F.split(F.col(text_col), "\n")).alias(col))


def place_dimension(lines: DataFrame, col: str = "line") -> DataFrame:
    """``(ville_brute, ville_og, ville, code_postal)`` from ``Name (code)``
    lines; the commune name is lowered and folded like the ads."""
    brute = F.trim(F.lower(F.col(col)))
    return (
        lines.select(brute.alias("ville_brute"))
        .withColumn("ville_og", F.regexp_extract("ville_brute", PLACE_LINE, 1))
        .withColumn("ville", fold_accents("ville_og"))
        .withColumn("code_postal", F.regexp_extract("ville_brute", PLACE_LINE, 2))
    )


def conform_first(df: DataFrame, dim: DataFrame, aliases: Mapping[str, str] = PLACE_ALIASES) -> DataFrame:
    """Conform the cleaned first source and attach its commune code."""
    v = df.withColumn("ville", F.trim(strip_pattern(fold_accents("ville"), DISTRICT_SUFFIX)))
    v = v.withColumn("type_bien", F.lower("type_bien"))
    v = v.withColumn("ville", apply_aliases("ville", aliases))
    v = v.withColumn("etage", floor_label("type_bien", "etage"))
    return enrich(v, dim, "ville", ["code_postal"])


def conform_second(df: DataFrame) -> DataFrame:
    """Conform the second source: folded place, shared column names."""
    return df.withColumn("ville", fold_accents("ville")).withColumnsRenamed(
        {"type_clean": "type_bien", "etage_clean": "etage"}
    )


def fuse_listings(
    first: DataFrame,
    second: DataFrame,
    dim: DataFrame,
    aliases: Mapping[str, str] = PLACE_ALIASES,
    dedup: bool = True,
) -> DataFrame:
    """Union of the two conformed sources on their shared columns (in the
    second source's column order), duplicates removed."""
    a = conform_first(first, dim, aliases)
    b = conform_second(second)
    u = union_common(b, a)
    return u.distinct() if dedup else u
