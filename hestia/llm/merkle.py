"""Fingerprints of documents as Merkle trees over paragraphs and sections.

A paragraph is a line. Its leaves are runs of words that end after a word whose
hash falls on a chosen remainder, so that an inserted or changed word moves no
other border. A paragraph's node hashes its leaves, a section's node the
paragraphs' nodes, the root the sections' nodes. A section ends after a
paragraph whose node falls on a chosen remainder, or after a blank line. Equal
roots mean equal texts (but for collisions of hashes: 48 bits a leaf, 64 a
node). Where roots differ, only differing sections are gone into, and in these
only differing paragraphs; what differs there tells how alike two texts are and
where the edit is.

A fingerprint is a string: the root, then each section as ``/`` and its entry.
An entry is a node followed by its children's entries, each of them after ``,``
(paragraphs) or ``.`` (leaves, which are their hash alone), so equal entries
are equal nodes. Built-in functions only.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from hestia.llm.common import checkpointed

#: One word of so many ends a leaf; so does each 32nd since the last end, so that a text of one word repeated has leaves too.
LEAF, LONGEST = 4, 32
#: One paragraph of so many ends a section.
SECTION = 8
#: A word with the white space after it; of a run of more than 32 characters without any, each character before the last 32.
PIECE = r"(?s)\S{1,32}+(?!\S)\s*|."
#: To find each row's neighbour, ids are cut into ranges of about so many rows, up to so many ranges; each is ordered by one task, which can spill.
RANGE_ROWS, RANGES = 200, 16384
#: More elements than an array holds.
ALL = 1 << 30


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _cut(items: Column, ends: Callable[[Column], Column], made: Callable[[Column], Column], longest: int = ALL) -> Column:
    """``made`` of each run of ``items``; a run ends after an item for which ``ends`` holds, with the last one, and after ``longest`` items."""
    n = F.size(items)
    places = F.when(n > 0, F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | ends(F.element_at(items, i))))

    def run(at: Column, end: Column, i: Column) -> Column:
        start = F.when(i == 0, F.lit(0)).otherwise(F.get(at, i - 1))
        if longest == ALL:
            return made(F.slice(items, start + 1, end - start))
        long_run = F.transform(F.sequence(start, end - 1, F.lit(longest)), lambda x: made(F.slice(items, x + 1, F.least(F.lit(longest), end - x))))
        return F.when(end - start <= longest, F.array(made(F.slice(items, start + 1, end - start)))).otherwise(long_run)

    runs = _let(places, lambda at: F.transform(at, lambda end, i: run(at, end, i)))
    return F.coalesce(runs if longest == ALL else F.flatten(runs), F.array().cast("array<string>"))


def _falls(h: Column, one_of: int) -> Column:
    return F.pmod(h, F.lit(one_of)) == 0


def _leaf(pieces: Column) -> Column:
    return F.concat(F.lit("."), F.lpad(F.right(F.hex(F.xxhash64(pieces)), F.lit(12)), 12, "0"))


def _node(children: Column) -> Column:
    return F.left(F.sha2(children, 256), F.lit(16))


def _nodes(entries: Column) -> Column:
    return F.array_join(F.transform(entries, lambda e: F.left(e, F.lit(16))), "")


def paragraph(line: Column) -> Column:
    """A paragraph's entry: its node and, each after a dot, its leaves. A blank line has none."""
    pieces = F.regexp_extract_all(line, F.lit(PIECE), F.lit(0))
    made = _let(pieces, lambda p: _cut(p, lambda x: _falls(F.xxhash64(x), LEAF), _leaf, LONGEST))
    return _let(F.lower(F.array_join(made, "")), lambda leaves: F.concat(_node(leaves), leaves))


def _section(paragraphs: Column) -> Column:
    return F.concat(_node(_nodes(paragraphs)), F.lit(","), F.array_join(paragraphs, ","))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text (not null)."""
    ends = lambda p: (F.length(p) == 16) | _falls(F.xxhash64(F.left(p, F.lit(16))), SECTION)
    sections = _let(F.transform(F.split(text, "\n"), paragraph), lambda ps: _cut(ps, ends, _section))
    return _let(sections, lambda x: F.concat(F.left(F.sha2(_nodes(x), 256), F.lit(32)), F.lit("/"), F.array_join(x, "/")))


def _sections(fp: Column) -> Column:
    return F.slice(F.split(fp, "/"), 2, ALL)


def _below(entries: Column, mark: str) -> Column:
    """The children of ``entries``."""
    return F.flatten(F.transform(entries, lambda e: F.slice(F.split(e, mark), 2, ALL)))


def _count(entries: Column, mark: str) -> Column:
    """How often ``mark`` stands in ``entries``."""
    return _let(F.array_join(entries, ""), lambda j: F.length(j) - F.length(F.replace(j, F.lit(mark), F.lit(""))))


def _same_root(a: Column, b: Column) -> Column:
    return F.left(a, F.lit(32)) == F.left(b, F.lit(32))


def likeness(a: Column, b: Column) -> Column:
    """Share of leaves in common: 1 where the roots agree, 0 where no leaf does; different texts have 0.999 at most.

    Sections of equal nodes count with all their leaves; of the others, paragraphs
    of equal nodes do; of what is then left, equal leaves. What repeats among the
    sections, paragraphs or leaves compared counts once.
    """

    def compared(s: Column, common: Column, leaves: Callable[[Column], Column]) -> Column:
        both = leaves(F.array_intersect(s["x"], s["y"]))
        return F.struct((common + both).alias("common"), F.array_except(s["x"], s["y"]).alias("x"), F.array_except(s["y"], s["x"]).alias("y"))

    def into(s: Column, mark: str, leaves: Callable[[Column], Column]) -> Column:
        below = F.struct(_below(s["x"], mark).alias("x"), _below(s["y"], mark).alias("y"))
        return _let(below, lambda t: compared(t, s["common"], leaves))

    dots = lambda entries: _count(entries, ".")
    sections = _let(F.struct(_sections(a).alias("x"), _sections(b).alias("y")), lambda s: compared(s, F.lit(0), dots))
    paragraphs = _let(sections, lambda s: into(s, ",", dots))
    left = _let(paragraphs, lambda s: into(s, r"\.", F.size))
    twice = lambda s: F.lit(2.0) * s["common"]
    share = _let(left, lambda s: twice(s) / F.greatest(twice(s) + F.size(s["x"]) + F.size(s["y"]), F.lit(1.0)))
    return F.when(_same_root(a, b), F.lit(1.0)).otherwise(F.least(share, F.lit(0.999)))


def edit(a: Column, b: Column) -> Column:
    """(first_line, last_line, first_leaf, last_leaf) of ``a`` that the edit to ``b`` touched, counted from 0; null where the roots agree.

    Sections that agree from the front and, of the rest, from the back lie outside
    the edit; so do, in what is between, paragraphs, and then leaves. A line's
    leaves count on from those of the lines before. A last one is below the first
    where ``b`` only inserts.
    """

    def between(s: Column) -> Column:
        """How many agree in front and at the back, and what lies between."""
        short = F.least(F.size(s["x"]), F.size(s["y"]))

        def agreeing(u: Column, v: Column) -> Column:
            first = F.array_position(F.zip_with(F.slice(u, 1, short), F.slice(v, 1, short), lambda p, q: p != q), True)
            return F.when(first > 0, first - 1).otherwise(short).cast("int")

        def cut(front: Column, back: Column) -> Column:
            middle = lambda u: F.slice(u, front + 1, F.size(u) - front - back)
            return F.struct(
                F.slice(s["x"], 1, front).alias("front"), F.slice(s["x"], F.size(s["x"]) - back + 1, back).alias("back"),
                middle(s["x"]).alias("x"), middle(s["y"]).alias("y"),
            )

        front = agreeing(s["x"], s["y"])
        ends = F.struct(front.alias("front"), F.least(agreeing(F.reverse(s["x"]), F.reverse(s["y"])), short - front).alias("back"))
        return _let(ends, lambda e: cut(e["front"], e["back"]))

    def below(s: Column, mark: str) -> Column:
        return _let(F.struct(_below(s["x"], mark).alias("x"), _below(s["y"], mark).alias("y")), between)

    def place(s: Column, p: Column, v: Column) -> Column:
        lines = {end: _count(s[end], ",") + F.size(p[end]) for end in ("front", "back")}
        leaves = {end: _count(s[end], ".") + _count(p[end], ".") + F.size(v[end]) for end in ("front", "back")}
        return F.struct(
            lines["front"].alias("first_line"), (_count(_sections(a), ",") - lines["back"] - 1).alias("last_line"),
            leaves["front"].alias("first_leaf"), (_count(_sections(a), ".") - leaves["back"] - 1).alias("last_leaf"),
        )

    sections = _let(F.struct(_sections(a).alias("x"), _sections(b).alias("y")), between)
    found = _let(sections, lambda s: _let(below(s, ","), lambda p: _let(below(p, r"\."), lambda v: place(s, p, v))))
    return F.when(~_same_root(a, b), found)


def with_next(df: DataFrame, *, doc_id: str, text: str) -> DataFrame:
    """``df`` with ``next_text``: the text of the row with the next lower id (the highest one's for the lowest).

    Null ids come after all others; rows of equal ids come by their text's
    hash. Ids are cut into ranges of about as many rows each at quantiles of all
    ids; the rows of a range meet in one task, sorted there, and only the first row
    of each range is handed to the range before it.
    """
    n = min(RANGES, df.count() // RANGE_ROWS + 1)
    at = [i / n for i in range(1, n)] or [0.5]
    bounds = sorted(set(df.agg(F.percentile_approx(doc_id, at, 20 * n).alias("b")).first()["b"] or []))
    # Two levels of borders, so that a row is compared with about the root of their number twice.
    wide = math.isqrt(len(bounds)) + 1
    groups = [bounds[i : i + wide] for i in range(0, len(bounds), wide)] or [[0]]
    longs = lambda x: F.array(*[F.lit(int(b)).cast("long") for b in x]).cast("array<bigint>")
    below = lambda cuts: F.size(F.filter(cuts, lambda c: c <= F.col(doc_id)))
    placed = df.withColumn("__group", below(longs([g[0] for g in groups])))
    fine = below(F.get(F.array(*map(longs, groups)), F.col("__group") - 1))
    number = F.when(F.col("__group") == 0, 0).otherwise((F.col("__group") - 1) * wide + fine)
    placed = placed.withColumn("__range", F.when(F.col(doc_id).isNull(), -1).otherwise(number)).drop("__group")
    key = F.xxhash64(text)
    w = Window.partitionBy("__range").orderBy(F.col(doc_id).desc_nulls_last(), key)
    # What follows the last row of a range is the first row of the next lower range that has rows.
    first = placed.groupBy("__range").agg(F.min(F.struct(F.bitwise_not(doc_id).alias("k"), key.alias("h"))).alias("f"))
    around = Window.orderBy(F.col("__range").desc())  # a row of numbers for each range
    heads = checkpointed(first.select("__range", F.coalesce(F.lead("f").over(around), F.first("f").over(around)).alias("f")))
    texts = df.select(F.bitwise_not(doc_id).alias("k"), key.alias("h"), F.col(text).alias("t"))
    on = texts["k"].eqNullSafe(heads["f.k"]) & (texts["h"] == heads["f.h"])
    heads = texts.join(F.broadcast(heads), on).groupBy("__range").agg(F.first("t").alias("__head"))
    led = placed.withColumn("next_text", F.lead(text).over(w))
    return led.join(heads, "__range", "left").withColumn("next_text", F.coalesce("next_text", "__head", F.lit(""))).drop("__range", "__head")


def edited(text: Column, other: Column) -> Column:
    """``text`` with its last floor(n/2) characters replaced by the first as many (or all) of ``other``."""
    n = F.char_length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.left(text, n - half), F.left(other, half))


def compare_with_edits(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edit for every row of ``docs``.

    A null text counts as empty (one blank line, no leaves). Equal
    texts have equal fingerprints; repeated rows are returned each. In a table
    of one row, it is its own next. An empty table gives an empty one; other
    columns are not read.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    d = with_next(d, doc_id="doc_id", text="text")
    d = d.withColumns({"after": edited(F.col("text"), F.col("next_text"))})
    names = {"text": "fingerprint", "after": "edited_fingerprint", "next_text": "next_fingerprint"}
    d = d.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("after", 256).alias("edited_sha256"),
        *[fingerprint(F.col(x)).alias(y) for x, y in names.items()],
    )
    own, after = F.col("fingerprint"), F.col("edited_fingerprint")
    return d.select(
        "doc_id", "n_chars", "edited_sha256", own, after,
        likeness(own, after).alias("near_edited"),
        likeness(own, F.col("next_fingerprint")).alias("near_next"),
        edit(own, after).alias("edit"),
    )
