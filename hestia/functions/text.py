"""Column functions for text: case, accents, patterns, parsing, tokens.

Every function takes and returns ``Column`` expressions built from
``pyspark.sql.functions`` so they stay inside whole-stage codegen. Only
``nfkc`` falls back to an Arrow-batched pandas UDF, because Spark has no
Unicode normalisation built in.

Java regex note: ``\\s``/``\\w``/``\\d`` are ASCII unless ``(?U)`` is set,
and ``.`` stops at several line terminators unless ``(?d)`` is set. The
patterns below set those flags so they behave like Python's ``re``.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterable, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


# ---------------------------------------------------------------- T1, T2, T3
def norm_case(col: ColumnOrName) -> Column:
    """Lower case and trimmed."""
    return F.lower(F.trim(_c(col)))


# The accent fold used for place names (source and target
# characters pair up by position; the hyphen becomes a space).
FOLD_FROM = "àâäéèêëîïôöùûüç-"
FOLD_TO = "aaaeeeeiioouuuc "


def fold_accents(col: ColumnOrName) -> Column:
    """Lower first, then fold accents and hyphens, then trim.

    Lowering first means capitals such as ``É`` fold too (a documented
    deviation from folding before lowering).
    """
    return F.trim(F.translate(F.lower(_c(col)), FOLD_FROM, FOLD_TO))


def strip_pattern(col: ColumnOrName, pattern: str, guard: str | None = None) -> Column:
    """Remove every match of ``pattern``. Values without ``guard``, a
    substring that every match contains, skip the regex."""
    c = _c(col)
    out = F.regexp_replace(c, pattern, "")
    return out if guard is None else F.when(c.contains(guard), out).otherwise(c)


# The cleaning patterns for place names.
SALE_PREFIX = r"vente\s+(appartement|maison)?\s*"
DISTRICT_SUFFIX = r"\s*\d+e\b"


# ------------------------------------------------------------------- T4, T5
def capture(col: ColumnOrName, pattern: str, group: int = 1) -> Column:
    """T4: regex capture group of the first match; null when there is no
    match.

    One scan of the input that stops at the first match: the value is bound
    before it is compared with the empty string (as ``nullif`` and
    ``regexp_substr`` are written, the input would be scanned twice). An empty
    group counts as no match.
    """
    found = F.transform(F.array(F.regexp_extract(_c(col), pattern, group)), lambda x: F.when(x != "", x))
    return F.get(found, F.lit(0))


def capture_or(col: ColumnOrName, pattern: str, default: str, group: int = 0) -> Column:
    """Capture with a default when the pattern does not match."""
    return F.coalesce(F.trim(capture(col, pattern, group)), F.lit(default))


def any_contains(col: ColumnOrName, needles: Iterable[str]) -> Column:
    """T5: true when any needle is a substring (case-sensitive; lower first).

    An OR of substring tests: measured faster on long texts than one regex
    alternation, and it stops at the first hit.
    """
    c = _c(col)
    out = None
    for n in needles:
        term = c.contains(n)
        out = term if out is None else (out | term)
    return out if out is not None else F.lit(False)


def first_listed(col: ColumnOrName, table: Sequence[tuple[str, object]], guard: Sequence[str] | None = None) -> Column:
    """Value of the first entry of ``table`` (in table order) whose word
    occurs anywhere in ``col``; null when none does.

    ``guard``: substrings such that every word contains one of them; texts
    with none of them skip the per-word tests.
    """
    c = _c(col)
    chain = None
    for w, v in table:
        cond = c.contains(w)
        chain = F.when(cond, F.lit(v)) if chain is None else chain.when(cond, F.lit(v))
    if guard:
        assert all(any(g in w for g in guard) for w, _ in table), "guard must cover every word"
        return F.when(any_contains(c, guard), chain)
    return chain


# -------------------------------------------------------------- T12 .. T16
def parse_price(col: ColumnOrName) -> Column:
    """``'250 000 €'`` → 250000; spaces of any width and € removed."""
    cleaned = F.regexp_replace(_c(col), "(?U)[\\s\u00a0\u202f€]", "")
    return cleaned.try_cast("bigint")


# Area patterns.
AREA_PATTERN = r"(\d+(?:[.,]\d+)?)\s*m\S*"
AREA_PATTERN_STRICT = r"(\d+(?:[.,]\d+)?)\s*m(?:²|2)"


def parse_area(col: ColumnOrName, strict: bool = False) -> Column:
    """First ``<number> m…`` in the text as a double; decimal comma ok.

    The default pattern is the faithful one and accepts ``3 minutes`` as 3;
    ``strict=True`` requires ``m²`` / ``m2``.
    """
    pattern = "(?U)" + (AREA_PATTERN_STRICT if strict else AREA_PATTERN)
    num = capture(col, pattern, 1)
    return F.replace(num, F.lit(","), F.lit(".")).try_cast("double")


def parse_area_field(col: ColumnOrName) -> Column:
    """T13, field form: ``'75 m²'`` → 75 as int (NBSP and ``m²`` removed)."""
    cleaned = F.trim(F.replace(F.replace(_c(col), F.lit("\u00a0"), F.lit("")), F.lit("m²"), F.lit("")))
    return cleaned.try_cast("int")


def parse_rooms(col: ColumnOrName) -> Column:
    """T14, field form: ``'3 pièces'`` → 3."""
    c = F.replace(F.replace(_c(col), F.lit("pièces"), F.lit("")), F.lit("pièce"), F.lit(""))
    return F.trim(c).try_cast("int")


def coerce(col: ColumnOrName, dtype: str) -> Column:
    """Cast; bad values become null instead of failing (ANSI safe)."""
    return _c(col).try_cast(dtype)


def nth_token(col: ColumnOrName, sep: str, n: int) -> Column:
    """N-th token (1-based; negative counts from the end) of a split."""
    import re

    return F.try_element_at(F.split(_c(col), re.escape(sep)), F.lit(n))


# --------------------------------------------------------------------- T17
@F.arrow_udf(StringType())
def _nfkc_udf(texts: pa.Array) -> pa.Array:
    return pa.array([None if x is None else unicodedata.normalize("NFKC", x) for x in texts.to_pylist()], pa.string())


# The NFKC mappings that occur in ad text (no-break spaces,
# superscript two and three).
NFKC_CHEAP_FROM = "\u00a0\u202f\u00b2\u00b3"
NFKC_CHEAP_TO = "  23"


def nfkc(col: ColumnOrName, cheap: bool = False) -> Column:
    """Unicode NFKC. ``cheap=True`` maps only NBSP/narrow NBSP/²/³."""
    if cheap:
        c = _c(col)
        # Most texts hold none of the four characters: byte searches
        # decide, the per-character mapping runs only when needed.
        return F.when(_beyond_ascii(c) & any_contains(c, NFKC_CHEAP_FROM), F.translate(c, NFKC_CHEAP_FROM, NFKC_CHEAP_TO)).otherwise(c)
    c = _c(col)
    # ASCII texts are normalised as they are: only others go to Python and back.
    return F.coalesce(_nfkc_udf(F.when(_beyond_ascii(c), c)), c)


def _beyond_ascii(c: Column) -> Column:
    """Whether some character takes more than a byte."""
    return F.octet_length(c) > F.char_length(c)


# --------------------------------------------------------------------- T18
# Fixed value: the floor number pattern.
FLOOR_DIGITS = (
    r"(?iU)(\d+)\s*(?:[eèéê?][mr]?[eèé]?|°)?\s*(?:et\s+)?(?:\(dernier\)|dernier)?\s*[eé]tage"
)

# Ordinal words tried in this order (list order, not text
# order), then the ground-floor words.
FLOOR_WORDS = [
    ("premier", 1), ("première", 1), ("premiere", 1),
    ("deuxième", 2), ("deuxieme", 2),
    ("troisième", 3), ("troisieme", 3),
    ("quatrième", 4), ("quatrieme", 4),
    ("cinquième", 5), ("cinquieme", 5),
    ("sixième", 6), ("sixieme", 6),
    ("septième", 7), ("septieme", 7),
    ("huitième", 8), ("huitieme", 8),
    ("neuvième", 9), ("neuvieme", 9),
    ("dixième", 10), ("dixieme", 10),
]
GROUND_WORDS = ["rez-de-chaussée", "rez de chaussée", "rez-de-chaussee", "rez de chaussee", "rdc", "r.d.c"]
# Every ordinal word, and every ground-floor word, contains one of these.
FLOOR_WORD_GUARD = ["premi", "ième", "ieme"]
GROUND_WORD_GUARD = ["chauss", "rdc", "r.d.c"]


def extract_floor(
    col: ColumnOrName,
    words: Sequence[tuple[str, int]] = FLOOR_WORDS,
    ground: Sequence[str] = GROUND_WORDS,
    low: Column | None = None,
) -> Column:
    """Floor number from free text.

    1. ``<digits> … étage`` pattern; 2. first ordinal word of ``words`` (in
    list order) found anywhere; 3. a ground-floor word gives 0.

    ``low`` may pass an already lower-cased column (see ``with_lowered``) so
    the 27 substring tests do not lower the whole text again each time.
    """
    c = _c(col)
    low = F.lower(c) if low is None else low
    by_word = first_listed(low, words, FLOOR_WORD_GUARD if words is FLOOR_WORDS else None)
    is_ground = any_contains(low, ground)
    if all(any(g in w for g in GROUND_WORD_GUARD) for w in ground):
        is_ground = any_contains(low, GROUND_WORD_GUARD) & is_ground
    ground_hit = F.when(is_ground, F.lit(0))
    # The digit pattern needs "tage" (any case): texts without it skip it.
    digits = F.when(low.contains("tage"), capture(c, FLOOR_DIGITS, 1))
    found = F.coalesce(digits.try_cast("int"), by_word, ground_hit)
    return F.when(c.isNull() | (c == ""), F.lit(None).cast("int")).otherwise(found)


def with_lowered(df, col: str, name: str | None = None):
    """Add ``lower(col)`` once as its own column.

    Catalyst keeps a non-trivial expression in its own projection when it
    is referenced several times, so every rule that reads the lowered text
    shares one evaluation per row instead of lowering the text per test.
    """
    return df.withColumn(name or f"__low_{col}", F.lower(F.col(col)))


# -------------------------------------------------------------- T20 .. T24
# Description, date and place patterns.
LONG_RUN = r"(?U)([\w\s,àéèêëùûüîïôç\.\-]{80,})"
DATE_DMY = r"(\d{2}/\d{2}/\d{4})"
PLACE_DEPT = r"([A-ZÀ-Ÿa-zà-ÿ\-\s]+)\s*\((\d{2})\)"


def long_run(col: ColumnOrName, min_len: int = 80) -> Column:
    """First run of at least ``min_len`` word/space/punctuation chars."""
    pattern = LONG_RUN.replace("{80,}", "{%d,}" % min_len)
    return F.trim(capture(col, pattern, 1))


def capture_date(col: ColumnOrName, typed: bool = False) -> Column:
    """First ``dd/mm/yyyy``; ``typed=True`` returns a DATE (bad → null)."""
    txt = capture(col, DATE_DMY, 1)
    return F.try_to_date(txt, "dd/MM/yyyy") if typed else txt


def with_unit(col: ColumnOrName, unit: str = " m²") -> Column:
    """Append a unit literal (null stays null)."""
    return F.concat(_c(col), F.lit(unit))


def floor_label(type_col: ColumnOrName, floor_col: ColumnOrName) -> Column:
    """``MAISON`` for houses, ``RDC`` for floor 0, else the integer text.

    The value is cast to int before string so a CSV-borne ``1.0`` reads ``1``.
    """
    t, f = _c(type_col), _c(floor_col)
    return (
        F.when(t == "maison", F.lit("MAISON"))
        .when(f == 0, F.lit("RDC"))
        .otherwise(f.try_cast("int").cast("string"))
    )


def context_pattern(word_pattern: str = "[eéE]tage", width: int = 20) -> str:
    return "(?iud).{0,%d}%s.{0,%d}" % (width, word_pattern, width)


def context_matches(
    col: ColumnOrName,
    word_pattern: str = "[eéE]tage",
    width: int = 20,
    guard: str | None = None,
    low: Column | None = None,
) -> Column:
    """Every match of the word with up to ``width`` chars each side.

    ``guard`` is a lower-case substring that every match of *this* word
    pattern contains (``tage`` for the default one); texts without it skip
    the (backtracking) regex scan. Without a guard every text is scanned.
    """
    c = _c(col)
    found = F.regexp_extract_all(c, F.lit(context_pattern(word_pattern, width)), 0)
    if guard is None:
        return found
    low = F.lower(c) if low is None else low
    return F.when(low.contains(guard), found).otherwise(F.array().cast("array<string>"))


def round_num(col: ColumnOrName, digits: int = 0, mode: str = "half_up") -> Column:
    """``half_up`` (SQL ``round``) or ``half_even`` (Python ``round``)."""
    if mode == "half_even":
        return F.bround(_c(col), digits)
    return F.round(_c(col), digits)


# ------------------------------------------------------------ T25 .. T27
# The stop-word list of the word count, as given.
STOPWORDS = [
    "le", "la", "les", "de", "du", "des", "un", "une", "en", "et", "à", "au", "aux",
    "est", "sont", "se", "sa", "son", "ses", "sur", "par", "pour", "dans", "avec",
    "ce", "cette", "ces", "qui", "que", "qu", "il", "elle", "ils", "elles", "on",
    "nous", "vous", "tout", "plus", "très", "ou", "y", "ne", "pas", "vous", "si",
    "bien", "être", "avoir", "fait", "été", "comme", "dont", "mais", "aussi", "entre",
    "leur", "leurs", "votre", "notre", "nos", "vos", "has", "the", "a", "an", "of",
    "its", "from", "this", "that", "to", "is", "in", "at", "be", "as", "are", "was",
    "d", "l", "n", "s", "m", "j", "c", "y", "qu", "jusqu", "lorsqu",
]
# Fixed value: characters kept by the tokenizer (besides whitespace).
TOKEN_KEEP = "a-zàâäéèêëîïôùûüç"


def tokens(col: ColumnOrName, min_len: int = 4, stopwords: Sequence[str] = STOPWORDS) -> Column:
    """Lower, non-letters → space, split on whitespace, keep words of
    at least ``min_len`` characters that are not stop words."""
    cleaned = F.regexp_replace(F.lower(_c(col)), f"(?U)[^{TOKEN_KEEP}\\s]", " ")
    parts = F.regexp_extract_all(cleaned, F.lit(r"(?U)\S+"), 0)
    stop = F.array(*[F.lit(w) for w in sorted(set(stopwords))])
    return F.filter(
        parts,
        lambda w: (F.length(w) >= F.lit(min_len)) & ~F.array_contains(stop, w),
    )


# ------------------------------------------------------------ shuffled texts
def packed(text: ColumnOrName) -> Column:
    """A text's UTF-8 bytes, compressed each on its own; null stays null."""

    @F.arrow_udf("binary")
    def pack(texts: pa.Array) -> pa.Array:
        return pa.array([None if x is None else zlib.compress(x) for x in texts.to_pylist()], pa.binary())

    return pack(_c(text).cast("binary"))


def unpacked(texts: ColumnOrName) -> Column:
    """The texts of an array of ``packed`` ones, in their places; a null array counts as empty."""

    @F.arrow_udf("array<binary>")
    def unpack(lists: pa.Array) -> pa.Array:
        ends = np.cumsum([0, *(n or 0 for n in lists.value_lengths().to_pylist())])
        made = [None if x is None else zlib.decompress(x) for x in lists.flatten().to_pylist()]
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(made, pa.binary()))

    return F.transform(unpack(_c(texts)), lambda x: x.cast("string"))
