"""Toxicity scores from a learned lexicon, matched with spelling errors and read in context.

Terms are learned from labelled rows: words, and beginnings that several words
share, that occur in toxic texts far more often than chance allows. They are
kept in a trie. For each word of a text the Levenshtein automaton of the word
is intersected with the trie, which finds the terms within one edit, two for long
terms; two letters swapped are one edit. Words that the labelled texts show to
be ordinary are no spelling of a term. Each find is weighted by its context: less where it
stands in quotation marks or behind a verb of reporting, more where it
addresses somebody. The sum of the weights becomes a score by a logistic curve
fitted to labelled rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Labelled rows that terms and curve are learned from at most, and terms at most.
LABELLED, TERMS = 20_000, 5_000
#: A term occurs in this share of toxic texts among those that hold it at least, and a stem has so many words and letters at least.
PURITY, STEM_WORDS, STEM_LETTERS, STEM_MOST = 0.85, 3, 4, 10
#: Letters from which a term may differ in one edit, and in two; weight of a find for each edit; words around a find that are its context.
FUZZY_FROM, FUZZY_TWICE, FUZZY_WEIGHT, CONTEXT = 4, 8, 0.8, 8
#: Sums of weights above this count as this: one sure find in a plain context is halfway.
CAP = 2.0
#: Words that a worker remembers at most.
CACHE_ENTRIES = 500_000

# Words that report somebody's speech, words that address somebody, and quotation marks.
REPORTING = set("said says saying called calls wrote writes quoted quote quotes quoting word words term terms dit disait écrit mot sagte sagt schrieb wort dijo dice escribió palabra".split())
ADDRESSING = set("you your you're youre u ur yourself tu toi vous ton ta du dich dein deine ihr tú eres usted tus".split())
OPENING, CLOSING = "\"“„«‘", "\"”“»’"

_WORDS = re.compile(r"[^\W_]+")
_END = "\0"
_STEM = "\1"


class Automaton:
    """The Levenshtein automaton of a word: states are the (place, edits) that a prefix can have led to.

    With ``swaps``, two neighbouring letters may change places as one edit; place ~i is between the two.
    """

    def __init__(self, word: str, edits: int, swaps: bool = False):
        self.word, self.edits, self.swaps = word, edits, swaps

    def start(self) -> tuple[tuple[int, int], ...]:
        return tuple((i, i) for i in range(min(self.edits, len(self.word)) + 1))

    def step(self, state: tuple[tuple[int, int], ...], ch: str) -> tuple[tuple[int, int], ...]:
        word, n, best = self.word, len(self.word), {}
        for i, e in state:
            if i < 0:
                if word[~i] == ch:
                    best[~i + 2] = min(e, best.get(~i + 2, e))
                continue
            if self.swaps and e < self.edits and i + 1 < n and word[i + 1] == ch:
                best[~i] = min(e + 1, best.get(~i, e + 1))
            if i < n and word[i] == ch:
                best[i + 1] = min(e, best.get(i + 1, e))
            if e < self.edits:
                best[i] = min(e + 1, best.get(i, e + 1))  # a letter too many in the term
                if i < n:
                    best[i + 1] = min(e + 1, best.get(i + 1, e + 1))  # another letter
        for i in range(max(0, min(best, default=0)), n):  # letters too many in the word
            if best.get(i, self.edits) < self.edits:
                best[i + 1] = min(best[i] + 1, best.get(i + 1, best[i] + 1))
        return tuple(sorted(best.items()))

    def distance(self, state: tuple[tuple[int, int], ...]) -> int | None:
        return next((e for i, e in state if i == len(self.word)), None)


def shortened(word: str, edits: int) -> set[str]:
    """The word with up to ``edits`` letters left out; words within so many edits have one of these in common."""
    out = last = {word}
    for _ in range(edits):
        last = {x[:i] + x[i + 1 :] for x in last for i in range(len(x))}
        out = out | last
    return out


class Lexicon:
    """Terms (with how many edits may change them, and their weight) and stems (beginnings of terms, with their weight).

    ``clean`` are words that are no spelling of a term. With ``swaps``, two letters swapped are one edit.
    """

    def __init__(self, words: dict[str, tuple[int, float]], stems: dict[str, float], clean: Iterable[str] = (), swaps: bool = False):
        self.words, self.stems, self.clean, self.swaps = words, stems, frozenset(clean), swaps
        self.trie: dict = {}
        for term, mark in [*((t, _END) for t in words), *((t, _STEM) for t in stems)]:
            at = self.trie
            for ch in term:
                at = at.setdefault(ch, {})
            at[mark] = term
        self.edits = max((int(e) for e, _ in words.values()), default=0)
        self.longest = max((len(t) + e for t, (e, _) in words.items() if e), default=0)
        self.shorter = {x for t, (e, _) in words.items() for x in shortened(t, int(e))} if self.edits else set()
        self.cache: dict[str, float] = {}

    def stem(self, word: str) -> str | None:
        at = self.trie
        for ch in word:
            at = at.get(ch)
            if at is None:
                return None
            if _STEM in at:
                return at[_STEM]
        return None

    def near(self, word: str) -> tuple[int, str] | None:
        """Edits and term of the nearest term in reach, the first in order of these, by walking automaton and trie together."""
        if len(word) > self.longest or self.shorter.isdisjoint(shortened(word, self.edits)):
            return None
        automaton = Automaton(word, self.edits, self.swaps)
        found, todo = [], [(self.trie, automaton.start())]
        while todo:
            node, state = todo.pop()
            if _END in node:
                edits = automaton.distance(state)
                if edits is not None and edits <= self.words[node[_END]][0]:
                    found.append((edits, node[_END]))
            for ch, child in node.items():
                if ch not in (_END, _STEM) and (to := automaton.step(state, ch)):
                    todo.append((child, to))
        return min(found, default=None)

    def nearest(self, word: str) -> str | None:
        found = self.near(word)
        return found[1] if found else None

    def weight(self, word: str) -> float:
        """Weight of a word in lower case; 0 if it is near no term."""
        if word in self.words:
            w = self.words[word][1]
        elif found := self.stem(word):
            w = self.stems[found]
        elif word in self.clean:
            w = 0.0
        else:
            w = FUZZY_WEIGHT ** near[0] * self.words[near[1]][1] if (near := self.near(word)) else 0.0
        if len(self.cache) >= CACHE_ENTRIES:
            self.cache.clear()
        self.cache[word] = w
        return w

    def abuse(self, text: str) -> float:
        """The sum of the weights of all finds in context."""
        low, cache = text.lower(), self.cache
        seen = set(_WORDS.findall(low))
        found = {}
        for x in seen:
            w = cache.get(x)
            if w is None:
                w = self.weight(x)
            if w:
                found[x] = w
        if not found:
            return 0.0
        spans = [(m.start(), m.end(), m[0]) for m in _WORDS.finditer(low)]
        return sum(found[x] * in_context(low, spans, i) for i, (_, _, x) in enumerate(spans) if x in found)


def in_context(text: str, spans: list[tuple[int, int, str]], i: int) -> float:
    """Factor of the find at word ``i``: 0.25 in a quotation, 1.5 where it addresses somebody, else 1."""
    before = spans[max(0, i - CONTEXT) : i]
    after = spans[i + 1 : i + 1 + CONTEXT]
    left = text[before[0][0] if before else spans[i][0] - 1 if spans[i][0] else 0 : spans[i][0]].rsplit("\n", 1)[-1]
    if before and before[0][0]:
        left = text[before[0][0] - 1] + left if "\n" not in text[before[0][0] : spans[i][0]] else left
    right = text[spans[i][1] : (after[-1][1] + 1) if after else spans[i][1] + 2].split("\n", 1)[0]
    opened = max(left.rfind(c) for c in OPENING)
    # A mark right before a word opens; one with white space or the end behind it has closed.
    opens = opened >= 0 and left[opened + 1 : opened + 2] not in (" ", ".", ",")
    quoted = opens and any(c in right for c in CLOSING)
    reported = any(x in REPORTING for _, _, x in before[-4:])
    if quoted or (reported and any(c in left for c in OPENING + ":")):
        return 0.25
    near = {x for _, _, x in before[-3:]} | {x for _, _, x in after[:2]}
    return 1.5 if near & ADDRESSING else 1.0


def _weight(pos: int, n: int) -> float:
    """Weight of a term: the log odds of a text that holds it to be toxic, 1 at 55 to 1."""
    return max(0.1, min(1.5, math.log((pos + 0.5) / (n - pos + 0.5)) / 4))


def _surprise(pos: Column, n: Column, base: float) -> Column:
    """How far the share of toxic texts lies above ``base``: texts times the divergence, in nats."""
    p = pos / n
    down = F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - base))).otherwise(0.0)
    return n * (p * F.log(p / base) + down)


def learn(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> dict:
    """Terms, stems and curve from the labelled rows, ``LABELLED`` of them at most (by a hash).

    Repeated ids count once, as toxic if any of their labels is; rows without
    a label or a text are left out; equal texts count once.
    """
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg(F.max(label).alias("y"))
    known = known.orderBy(F.xxhash64("__id"), "__id").limit(LABELLED)
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("t")).where("t is not null").join(F.broadcast(known), "__id")
    rows = rows.groupBy(F.sha2("t", 256).alias("h")).agg(F.first("t").alias("t"), F.max("y").alias("y")).select("t", "y").persist()
    try:
        total, toxic = rows.agg(F.count("*"), F.coalesce(F.sum("y"), F.lit(0))).first()
        if not toxic or toxic == total:
            return {"words": {}, "stems": {}, "clean": [], "curve": (math.log((toxic + 0.5) / (total - toxic + 0.5)), 0.0)}
        base = toxic / total
        words = F.array_distinct(F.regexp_extract_all(F.lower("t"), F.lit(r"[\p{L}\p{N}]+"), F.lit(0)))
        counts = rows.select("y", F.explode(words).alias("w")).groupBy("w").agg(F.sum("y").alias("pos"), F.count("*").alias("n")).persist()
        sure = F.log(F.lit(float(counts.count()))) + 3.0
        good = (F.col("pos") >= PURITY * F.col("n")) & (_surprise(F.col("pos"), F.col("n"), base) >= sure)
        found = counts.where((F.col("pos") > 0)).where(good & (F.length("w") > 2)).orderBy(F.desc("pos"), "w").limit(TERMS).collect()
        longer = F.length("w") > STEM_LETTERS
        begin = F.transform(F.sequence(F.lit(STEM_LETTERS), F.least(F.length("w") - 1, F.lit(STEM_MOST))), lambda k: F.left("w", k))
        stems = (
            counts.where(longer)
            .select(F.explode(begin).alias("w"), "pos", "n")
            .groupBy("w")
            .agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"), F.count("*").alias("words"))
            .where((F.col("pos") > 0) & (F.col("words") >= STEM_WORDS))
            .where(good)
            .orderBy(F.length("w"), F.desc("pos"), "w")
            .limit(TERMS)
            .collect()
        )
        short: dict[str, float] = {}
        for r in stems:  # the shortest beginnings only
            if not r.w.startswith(tuple(short)):
                short[r.w] = _weight(r.pos, r.n)
        edits = lambda w: (len(w) >= FUZZY_FROM) + (len(w) >= FUZZY_TWICE)
        terms = {r.w: (edits(r.w), _weight(r.pos, r.n)) for r in found if not r.w.startswith(tuple(short))}
        # Near spellings that are ordinary words of the labelled texts don't count.
        clean = sorted(r.w for r in _near(counts, terms, short).where(F.col("pos") < PURITY * F.col("n")).select("w").collect())
        counts.unpersist()
        model = {"words": terms, "stems": short, "clean": clean}
        scored = _mapped(rows.select("y", "t"), model, None, ["y"], "t")
        levels = scored.groupBy(F.round(F.least("x", F.lit(CAP)), 1).alias("x"), "y").agg(F.count("*").alias("n")).collect()
        model["curve"] = fitted([(r.x, r.y, r.n) for r in levels])
        return model
    finally:
        rows.unpersist()


def fitted(levels: list[tuple[float, int, int]], ridge: float = 0.05) -> tuple[float, float]:
    """(a, b) of the logistic curve a + b x through (x, label, rows), by Newton steps with a small ridge."""
    a = b = 0.0
    for _ in range(100):
        ga, gb, haa, hab, hbb = -ridge * a, -ridge * b, ridge, 0.0, ridge
        for x, y, n in levels:
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * x))))
            ga, gb = ga + n * (y - p), gb + n * (y - p) * x
            v = n * p * (1 - p)
            haa, hab, hbb = haa + v, hab + v * x, hbb + v * x * x
        det = haa * hbb - hab * hab
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        step = min(1.0, 3.0 / max(abs(da), abs(db), 1e-12))
        a, b = a + step * da, b + step * db
        if abs(da) + abs(db) < 1e-9:
            break
    return a, b


@lru_cache(4)
def _lexicon(words: tuple, stems: tuple, clean: tuple = ()) -> Lexicon:
    return Lexicon(dict(words), dict(stems), clean, swaps=True)


def _near(counts: DataFrame, terms: dict, stems: dict) -> DataFrame:
    """(pos, n, w) of every word that is in reach of a term and none itself."""
    words, begin = tuple(sorted(terms.items())), tuple(sorted(stems.items()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(words, begin)
        for batch in batches:
            near = [x not in lexicon.words and not lexicon.stem(x) and lexicon.near(x) is not None for x in batch.column(2).to_pylist()]
            yield batch.filter(pa.array(near, pa.bool_()))

    rows = counts.select(F.col("pos").cast("long"), "n", "w")
    return rows.mapInArrow(run, "pos long, n long, w string")


def _mapped(df: DataFrame, model: dict, curve: tuple[float, float] | None, keep: list[str], text: str) -> DataFrame:
    words, stems, clean = tuple(sorted(model["words"].items())), tuple(sorted(model["stems"].items())), tuple(model["clean"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _lexicon(words, stems, clean)
        for batch in batches:
            *rest, texts = batch.columns
            x = [lexicon.abuse(t) if t else 0.0 for t in texts.to_pylist()]
            if curve:
                a, b = curve
                x = [1 / (1 + math.exp(-max(-30.0, min(30.0, a + b * min(v, CAP))))) for v in x]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(x, pa.float64())], names=[*batch.schema.names[:-1], "x"])

    chosen = df.select(*keep, F.col(text).alias("__text"))
    return chosen.mapInArrow(run, StructType([*chosen.schema.fields[:-1], *StructType.fromDDL("x double").fields]))


def score(df: DataFrame, model: dict, *, text: str = "text", keep: list[str]) -> DataFrame:
    """``keep`` and ``score`` (0 to 1) for every row of ``df``.

    Reads nothing but ``text`` of a row. A null or empty text scores as one
    without a find; equal texts score alike; an empty table gives an empty one.
    """
    return _mapped(df, model, model["curve"], keep, text).withColumnRenamed("x", "score")


def held_out(crc: Column) -> Column:
    """Rows whose labels nothing is learned from; so are rows without an id."""
    return F.coalesce(crc % 5 == 0, F.lit(True))
