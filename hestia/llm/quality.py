"""Quality classifier: a generalised additive model with pairwise interactions.

A text becomes a fixed row of numbers (shares of kinds of characters, word and
line figures, repetition). Each number is cut into bins at quantiles of the
labelled sample. Boosting takes the features in turn, again and again: each
step fits one shallow tree of that feature's bins to what the others leave
unexplained and adds a little of it to the feature's lookup table. Pairs of
features that explain most of the rest then get tables of their own in the same
way. A score is the logistic curve of the sum of one entry from each table, so
scoring is a search for bins and an addition, vectorised over a batch.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from hestia.llm.common import sliced

#: Labelled rows that are learned from, about at most: a larger table is thinned by a hash to this number.
LABELLED = 20_000
#: Bins of a feature, and of each feature of a pair; pairs that get a table.
BINS, PAIR_BINS, PAIRS = 32, 8, 8
#: Share of a step that is added, rounds at most, rounds without gain on the rows set aside after which boosting ends.
RATE, ROUNDS, PATIENCE = 0.1, 200, 12
#: Weight of the penalty on an entry, rows in a leaf at least, share of rows set aside.
PENALTY, LEAF, ASIDE = 1.0, 5, 0.15
#: Bytes of a text that are looked at together; the figures of a text are sums over such blocks.
BLOCK = 1 << 20

FEATURES = (
    "log_bytes log_words word_length letters digits capitals blanks marks symbols controls distinct_words top_word dull_words short_words long_words "
    "same_as_last repeated_triples symbol_ends capital_words log_line_length repeated_lines blank_lines entropy".split()
)

_KINDS = np.zeros((7, 256), np.int64)
for _b in range(256):
    _c = chr(_b)
    _KINDS[0, _b] = _b >= 128 or _c.isalpha()
    _KINDS[1, _b] = _b < 128 and _c.isdigit()
    _KINDS[2, _b] = 65 <= _b <= 90
    _KINDS[3, _b] = _c in " \t\n\r\x0b\x0c"
    _KINDS[4, _b] = _c in ".,;:!?'\"()-"
    _KINDS[5, _b] = _c in "#$%&*+/<=>@[\\]^_`{|}~"
    _KINDS[6, _b] = _b < 32 and _c not in "\t\n\r"
_SYMBOLS = frozenset(b"#$%&*+/<=>@[\\]^_`{|}~!")
_CAPITALS = frozenset(range(65, 91))
_LETTERS = frozenset(b for b in range(256) if b >= 128 or chr(b).isalpha())
_BREAK = re.compile(rb"[ \n]")


def blocks(text: bytes) -> Iterator[bytes]:
    """The text in parts of ``BLOCK`` bytes or a little more: each but the last ends behind a blank or line break, if one follows."""
    at = 0
    while at < len(text):
        end = at + BLOCK
        if end < len(text):
            cut = _BREAK.search(text, end)
            end = cut.end() if cut else len(text)
        yield text[at:end]
        at = end


def figures(text: bytes) -> list[float]:
    """The features of a text in UTF-8, in the order of ``FEATURES``; repetition is looked for within each block."""
    kinds = np.zeros(256, np.int64)
    n = distinct = top = dull = short = long = letters = last = triples = three = ends = capital = lines = repeated = empty = 0
    for part in blocks(text):
        kinds += np.bincount(np.frombuffer(part, np.uint8), minlength=256)
        words = part.split()
        if words:
            count = Counter(words)
            n += len(words)
            distinct += len(count)
            top += max(count.values())
            for w, k in count.items():
                size = len(w)
                letters += size * k
                dull += k * (not (w.isalpha() or any(c in _LETTERS for c in w)))
                short += k * (size <= 3)
                long += k * (size > 20)
                ends += k * (w[-1] in _SYMBOLS)
                capital += k * (w[0] in _CAPITALS)
            last += sum(map(bytes.__eq__, words, words[1:]))
            if len(words) > 2:
                three += len(words) - 2
                triples += len(words) - 2 - len(set(zip(words, words[1:], words[2:])))
        found = part.split(b"\n")
        lines += len(found)
        full = [x for x in found if x.strip()]
        empty += len(found) - len(full)
        repeated += sum(map(len, full)) - sum(map(len, set(full)))
    size = max(1, len(text))
    share = kinds[kinds > 0] / size
    w = max(1, n)
    by_kind = (_KINDS @ kinds) / size
    return [
        float(np.log1p(len(text))), float(np.log1p(n)), letters / w, by_kind[0], by_kind[1], by_kind[2] / max(by_kind[0], 1 / size), by_kind[3],
        by_kind[4], by_kind[5], by_kind[6], distinct / w, top / w, dull / w, short / w, long / w, last / w, triples / max(1, three), ends / w,
        capital / w, float(np.log1p(size / max(1, lines))), repeated / size, empty / max(1, lines), float(-(share * np.log2(share)).sum()) if len(share) else 0.0,
    ]


def measured(texts: pa.Array) -> np.ndarray:
    """(n, features) of an array of binary texts; a null counts as empty."""
    return np.array([figures(t.as_py() or b"") for t in texts], np.float64).reshape(len(texts), len(FEATURES))


def tree(g: np.ndarray, h: np.ndarray, n: np.ndarray, depth: int = 2) -> np.ndarray:
    """The steps of a tree on ordered bins: sums of gradients, second derivatives and rows of each bin give an entry for each bin."""
    out = np.full(len(g), g.sum() / (h.sum() + PENALTY))
    if depth == 0 or len(g) < 2:
        return out
    left, hl, nl = np.cumsum(g)[:-1], np.cumsum(h)[:-1], np.cumsum(n)[:-1]
    gain = left**2 / (hl + PENALTY) + (g.sum() - left) ** 2 / (h.sum() - hl + PENALTY)
    gain[(nl < LEAF) | (n.sum() - nl < LEAF)] = -np.inf
    at = int(np.argmax(gain)) + 1
    if gain[at - 1] <= g.sum() ** 2 / (h.sum() + PENALTY) + 1e-12:
        return out
    return np.concatenate([tree(g[:at], h[:at], n[:at], depth - 1), tree(g[at:], h[at:], n[at:], depth - 1)])


def tree_of_pair(g: np.ndarray, h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, float]:
    """The steps of a tree on a grid of bins, split along one axis, then each half along the other; and its gain."""
    best, most = np.full(g.shape, g.sum() / (h.sum() + PENALTY)), g.sum() ** 2 / (h.sum() + PENALTY)
    base = most
    for axis in (0, 1):
        a, b, c = (x if axis == 0 else x.T for x in (g, h, n))
        for at in range(1, len(a)):
            halves = [(a[s].sum(0), b[s].sum(0), c[s].sum(0)) for s in (slice(at), slice(at, None))]
            steps = [tree(*x, depth=1) for x in halves]
            gain = sum(float((2 * s * x[0] - s**2 * (x[1])).sum()) - PENALTY * float((s**2).mean()) for s, x in zip(steps, halves))
            if gain > most + 1e-12:
                grid = np.vstack([np.repeat(steps[0][None], at, 0), np.repeat(steps[1][None], len(a) - at, 0)])
                best, most = grid if axis == 0 else grid.T, gain
    return best, most - base


@dataclass
class Model:
    """Tables of a fitted model: for each feature its bins' lower ends and entries, for each pair its coarse ends and grid."""

    intercept: float = 0.0
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int, np.ndarray]] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        """Sum of the entries of each row of ``x``."""
        total = np.full(len(x), self.intercept)
        for f, (ends, entries) in enumerate(zip(self.edges, self.tables)):
            total += entries[np.searchsorted(ends, x[:, f], side="right")]
        for i, j, grid in self.pairs:
            total += grid[np.searchsorted(self.coarse[i], x[:, i], side="right"), np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _ends(x: np.ndarray, bins: int) -> np.ndarray:
    """Where bins begin: distinct quantiles of the values, above the least."""
    found = np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1], method="higher"))
    return found[found > x.min()]


def _loss(y: np.ndarray, logit: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logit) - y * logit)) if len(y) else 0.0


def fit(x: np.ndarray, y: np.ndarray, aside: np.ndarray) -> Model:
    """The model of features ``x`` and labels ``y`` (0 or 1); rows ``aside`` only tell when to stop.

    Without rows, or with one label only, there are no tables: every score is
    about the share of label 1.
    """
    y = y.astype(np.float64)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    model = Model(float(np.log(rate / (1 - rate))))
    if not len(y) or y.min() == y.max():
        return model
    features = x.shape[1]
    model.edges = [_ends(x[:, f], BINS) for f in range(features)]
    model.coarse = [_ends(x[:, f], PAIR_BINS) for f in range(features)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    bins = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.edges)]
    coarse = [np.searchsorted(e, x[:, f], side="right") for f, e in enumerate(model.coarse)]
    fits, tests = ~aside, aside if aside.any() else ~aside
    logit = np.full(len(y), model.intercept)

    def sums(cell: np.ndarray, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(logit[fits], -30, 30)))
        at = cell[fits]
        return np.bincount(at, y[fits] - p, cells), np.bincount(at, p * (1 - p), cells), np.bincount(at, minlength=cells)

    def boost(tables: list[np.ndarray], cells: list[np.ndarray], step) -> list[np.ndarray]:
        """Cycles over the tables until the rows aside gain no more; the tables of the best round."""
        best, least, idle = [t.copy() for t in tables], _loss(y[tests], logit[tests]), 0
        for _ in range(ROUNDS):
            for t, cell in zip(tables, cells):
                change = RATE * step(*(s.reshape(t.shape) for s in sums(cell, t.size)))
                t += change
                logit[:] += change.reshape(-1)[cell]
            now = _loss(y[tests], logit[tests])
            if now < least - 1e-6:
                best, least, idle = [t.copy() for t in tables], now, 0
            else:
                idle += 1
                if idle >= PATIENCE:
                    break
        for t, b, cell in zip(tables, best, cells):
            logit[:] += (b - t).reshape(-1)[cell]
        return best

    model.tables = boost(model.tables, bins, tree)
    grids = []
    for i, j in combinations(range(features), 2):
        shape = (len(model.coarse[i]) + 1, len(model.coarse[j]) + 1)
        if min(shape) < 2:
            continue
        cell = coarse[i] * shape[1] + coarse[j]
        _, gain = tree_of_pair(*(s.reshape(shape) for s in sums(cell, shape[0] * shape[1])))
        grids.append((-gain, i, j, shape, cell))
    grids = sorted(grids, key=lambda r: r[:3])[:PAIRS]
    found = boost([np.zeros(g[3]) for g in grids], [g[4] for g in grids], lambda *s: tree_of_pair(*s)[0])
    model.pairs = [(g[1], g[2], t) for g, t in zip(grids, found)]
    # Tables are centred, so that an entry is the change against the average text.
    for f, t in enumerate(model.tables):
        mean = float(t[bins[f]].mean())
        t -= mean
        model.intercept += mean
    return model


def learn(docs: DataFrame, labels: DataFrame, *, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> Model:
    """The model of the labelled rows, about ``LABELLED`` of them at most (by a hash of the id).

    Repeated ids count once, as 1 where most of their labels are (or half);
    labels without an id or a value, and documents without a text, are left out.
    """
    known = labels.where(F.col(doc_id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(doc_id).alias("__id")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    total = known.count()
    part = F.pmod(F.xxhash64("__id"), F.lit(1 << 30))
    # Hashes are even, so this is within a few hundredths of ``LABELLED`` rows: small enough to broadcast.
    known = known.where(part < int(min(1.0, LABELLED / max(1, total)) * (1 << 30)))
    rows = docs.select(F.col(doc_id).alias("__id"), F.col(text).cast("binary").alias("t")).where("t is not null").join(F.broadcast(known), "__id")
    aside = F.pmod(F.xxhash64("__id", F.lit(7)), F.lit(1000)) < int(1000 * ASIDE)
    found = _mapped(rows.select("__id", "y", aside.alias("aside"), "t"), None, ["__id", "y", "aside"], "t").collect()
    found.sort(key=lambda r: (r["__id"], r["__x"]))
    x = np.array([r["__x"] for r in found], np.float64).reshape(len(found), len(FEATURES))
    return fit(x, np.array([r.y for r in found], np.int64), np.array([r.aside for r in found], bool))


def _mapped(df: DataFrame, model: Model | None, keep: list[str], text: str) -> DataFrame:
    """``keep`` and ``__x``: the features, or with a model the score."""

    place = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, place):
            *rest, texts = batch.columns
            x = measured(texts)
            if model is None:
                made = pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, len(FEATURES), dtype=np.int32)), pa.array(x.reshape(-1)))
            else:
                made = pa.array(model.probability(x))
            yield pa.RecordBatch.from_arrays([*rest, made], names=[*batch.schema.names[:-1], "__x"])

    chosen = df.select(*keep, F.col(text).cast("binary").alias("__text"))
    kind = "__x array<double>" if model is None else "__x double"
    return chosen.mapInArrow(run, StructType([*chosen.schema.fields[:-1], *StructType.fromDDL(kind).fields]))


def score(df: DataFrame, model: Model, *, text: str = "text", keep: list[str]) -> DataFrame:
    """``keep`` and ``score`` (0 to 1) for every row of ``df``.

    Reads nothing but ``text`` of a row. A null text counts as empty, which is
    scored by its figures like any other; equal texts score alike; an empty
    table gives an empty one.
    """
    return _mapped(df, model, keep, text).withColumnRenamed("__x", "score")


def held_out(crc: Column) -> Column:
    """Rows whose labels nothing is learned from; so are rows without an id."""
    return F.coalesce(crc % 3 == 1, F.lit(True))
