"""Byte-level BPE encoding and decoding with vectorised pre-tokenisation.

Texts of an Arrow batch are laid end to end as one array of code points.
Each code point gets a class (letter, number, space, ...); where the class
needs a look ahead (the last space before a word, an apostrophe that opens a
contraction) shifted copies of the array decide. A small automaton over these
classes says where a match of the splitting pattern starts. Its run over the
batch is a scan: every class is a function from state to state, functions
compose associatively, and the finite set of all compositions is enumerated
once, so that a composition is one table look-up. The array is cut into many
rows that advance together; their total functions are chained, then every row
runs again from its known first state. No regular expression is used.

The slices between boundaries go through pair merging by rank, with a cache
from slice to ids, which are kept as packed numbers. The cache has two halves:
where the newer is full, it becomes the older, and what is found there moves
back, so that slices in use stay. Offsets (in code points) are kept beside the
ids, and decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from array import array
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hestia.llm.common import reading, sliced

#: Classes of code points as the automaton reads them.
LETTER, NUMBER, OTHER, APOS1, APOS2, SPACE_LAST, WHITE_LAST, WHITE, RESET = range(9)
#: States: nothing open, in letters, in numbers, in others, after a joining space, in white space, one or two contraction letters to come.
NONE, IN_L, IN_N, IN_O, JOIN, IN_W, ONE, TWO = range(8)
#: White space as the splitting pattern means it (the Unicode property).
WHITE_SPACE = [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
#: Entries that the cache of a task holds at most, each of a slice of ``LONG_SLICE`` at most: half of them new, half the last full half (some 70 MB).
CACHE_ENTRIES = 400_000
#: A slice longer than this is merged with a heap and isn't cached.
LONG_SLICE = 200
#: Slices of up to this many bytes are merged together where at least so many have one size.
SHORT_SLICE, MANY = 48, 32
#: Code points that one round of the scan takes at most (a longer text has a round of its own).
ROUND = 1_000_000


@lru_cache(1)
def codepoint_classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or WHITE for each code point."""
    import regex

    table = np.full(0x110000, OTHER, np.uint8)
    points = np.arange(0x110000, dtype=np.uint32)
    every = points[(points < 0xD800) | (points >= 0xE000)].tobytes().decode("utf-32-le")  # single characters joined would take 80 MB
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+")):
        for m in regex.finditer(pattern, every):
            shift = [0x800 if i >= 0xD800 else 0 for i in (m.start(), m.end() - 1)]
            table[m.start() + shift[0] : m.end() + shift[1]] = kind
    table[0xD800:0xE000] = OTHER
    table[WHITE_SPACE] = WHITE
    return table


def step(state: int, kind: int) -> tuple[int, bool]:
    """The next state, and whether a match starts at this code point."""
    if kind == RESET:
        return NONE, True
    if kind == LETTER:
        if state == TWO:
            return ONE, False
        if state == ONE:
            return NONE, False
        return IN_L, state not in (IN_L, JOIN)
    if kind == NUMBER:
        return IN_N, state not in (IN_N, JOIN)
    if kind in (OTHER, APOS1, APOS2):
        if state in (IN_O, JOIN):
            return IN_O, False
        return {OTHER: IN_O, APOS1: ONE, APOS2: TWO}[kind], True
    if kind == SPACE_LAST:
        return JOIN, True
    if kind == WHITE_LAST:
        return NONE, True
    return IN_W, state != IN_W


@lru_cache(1)
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(next state by class*8+state, start flag likewise, function by function*9+class, functions as rows of states)."""
    moves = np.array([[step(s, k)[0] for s in range(8)] for k in range(9)], np.uint8)
    starts = np.array([[step(s, k)[1] for s in range(8)] for k in range(9)], bool)
    found = {tuple(range(8)): 0}
    todo = [tuple(range(8))]
    after: list[list[int]] = []
    for f in todo:  # grows while it runs; ends as there are finitely many functions
        row = []
        for k in range(9):
            g = tuple(int(moves[k][s]) for s in f)
            if g not in found:
                found[g] = len(found)
                todo.append(g)
            row.append(found[g])
        after.append(row)
    return moves.ravel(), starts.ravel(), np.array(after, np.uint16).ravel(), np.array(todo, np.uint8)


def classes_of(points: np.ndarray, reset: np.ndarray) -> np.ndarray:
    """Class of each code point in its place; ``reset`` marks the separators between texts."""
    kind = codepoint_classes()[points]
    kind[reset] = RESET
    white = kind == WHITE
    after = np.empty_like(white)  # white space or the text's end follows
    after[:-1] = white[1:] | reset[1:]
    after[-1] = True
    last = white & ~after
    kind[last] = WHITE_LAST
    kind[last & (points == 0x20)] = SPACE_LAST
    apos = np.flatnonzero(points[:-1] == 0x27)
    if len(apos):
        one = points[apos + 1]
        two = points[np.minimum(apos + 2, len(points) - 1)]
        kind[apos[np.isin(one, [ord(c) for c in "stmd"])]] = APOS1
        pair = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        kind[apos[pair]] = APOS2
    kind[reset] = RESET
    return kind


def starts_of(kind: np.ndarray) -> np.ndarray:
    """Whether a match starts, for each class in its place, by the scan of transition functions."""
    moves, starts, after, functions = automaton()
    n = len(kind)
    width = max(1, int(np.sqrt(n)))
    rows = -(-n // width)
    grid = np.full(rows * width, RESET, np.uint8)
    grid[:n] = kind
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    total = np.zeros(rows, np.intp)
    for column in grid:
        total = after[total * 9 + column].astype(np.intp)  # the column's uint8 is widened here, one at a time
    entry = np.empty(rows, np.intp)
    state = NONE
    for i, f in enumerate(total.tolist()):
        entry[i] = state
        state = int(functions[f][state])
    flags = np.empty((width, rows), bool)
    for j, column in enumerate(grid):
        at = column.astype(np.intp) * 8 + entry
        flags[j] = starts[at]
        entry = moves[at].astype(np.intp)
    return flags.T.ravel()[:n]


def slices_of(texts: list[str]) -> Iterator[tuple[np.ndarray, int]]:
    """For each text, the offsets at which its slices start, and its length."""
    at = 0
    while at < len(texts):
        to, size = at, 0
        while to < len(texts) and (to == at or size + len(texts[to]) < ROUND):
            size += len(texts[to]) + 1
            to += 1
        points = np.frombuffer("\0".join([*texts[at:to], ""]).encode("utf-32-le"), np.uint32)
        ends = np.cumsum([len(t) + 1 for t in texts[at:to]]) - 1
        reset = np.zeros(len(points), bool)
        reset[ends] = True
        begin = np.flatnonzero(starts_of(classes_of(points, reset)))
        cut = np.searchsorted(begin, ends)
        first, low = 0, 0
        for end, c in zip(ends.tolist(), cut.tolist()):
            yield (begin[low:c] - first).astype(np.int32), end - first
            first, low = end + 1, c + 1
        at = to


#: A slice's ids as packed int32: a third of what the same takes as a tuple with its decimal text and bytes.
Entry = bytes


class Encoder:
    """Ids of texts by a rank file, and their bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = {v: k for k, v in self.ranks.items()}
        self.byte_ids = [self.ranks[bytes([i])] for i in range(256)]
        self.none = max(self.bytes_of) + 1
        self.decimals = list(map(str, range(self.none)))
        #: Rank of what two adjacent ids join to, by the left id and the right one.
        self.pairs: list[dict[int, int]] = [{} for _ in range(self.none)]
        for piece, rank in self.ranks.items():
            for i in range(1, len(piece)):
                if (x := self.ranks.get(piece[:i])) is not None and (y := self.ranks.get(piece[i:])) is not None:
                    self.pairs[x][y] = rank
        #: The same of two bytes, by left * 256 + right; ``none`` where they don't join.
        self.byte_pairs = [self.pairs[x].get(y, self.none) for x in self.byte_ids for y in self.byte_ids]
        #: The pairs' keys (left * none + right) in order, ended by one that no pair has, and their ranks.
        found = sorted((x * self.none + y, rank) for x, right in enumerate(self.pairs) for y, rank in right.items())
        self.keys = np.array([k for k, _ in found] + [self.none**2], np.int64)
        self.key_ranks = np.array([rank for _, rank in found] + [self.none], np.int32)
        self.byte_id_array, self.byte_pair_array = np.array(self.byte_ids, np.int32), np.array(self.byte_pairs, np.int32)
        self.cache: dict[str, Entry] = {}
        self.older: dict[str, Entry] = {}

    def merged(self, piece: bytes) -> tuple[int, ...]:
        """Ids of one slice: again and again the adjacent pair of the lowest rank is joined, the leftmost first."""
        if (whole := self.ranks.get(piece)) is not None:
            return (whole,)
        if len(piece) > LONG_SLICE:
            return self.merged_long(piece)
        none, pairs, byte_ids, byte_pairs = self.none, self.pairs, self.byte_ids, self.byte_pairs
        ids = [byte_ids[b] for b in piece]
        score = [byte_pairs[a << 8 | b] for a, b in zip(piece, piece[1:])]
        while score:
            best = min(score)
            if best == none:
                break
            i = score.index(best)
            ids[i] = best
            del ids[i + 1], score[i]
            if i < len(score):
                score[i] = pairs[best].get(ids[i + 1], none)
            if i:
                score[i - 1] = pairs[ids[i - 1]].get(best, none)
        return tuple(ids)

    def merged_long(self, piece: bytes) -> tuple[int, ...]:
        """As ``merged``, in n log n by a heap over a linked list of parts."""
        import heapq

        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # of the part that begins here; 0: joined to an earlier one
        before = list(range(-1, n - 1))

        def pair(i: int) -> int | None:
            j = end[i]
            return ranks.get(piece[i : end[j]]) if j < n else None

        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, to = heapq.heappop(heap)
            if not end[i] or end[i] >= n or end[end[i]] != to or pair(i) != r:
                continue
            j = end[i]
            end[i], end[j] = to, 0
            if to < n:
                before[to] = i
            for k in (i, before[i]):
                if k >= 0 and end[k] < n and (x := pair(k)) is not None:
                    heapq.heappush(heap, (x, k, end[end[k]]))
        out, i = [], 0
        while i < n:
            out.append(ranks[piece[i : end[i]]])
            i = end[i]
        return tuple(out)

    def joined(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of what each two ids join to; ``none`` where they don't."""
        key = left.astype(np.int64) * self.none + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.key_ranks[at], self.none)

    def merged_rows(self, rows: np.ndarray) -> list[tuple[int, ...]]:
        """As ``merged``, for slices of one size as rows of bytes: each round joins one pair of every row that has one left."""
        out: list[tuple[int, ...]] = [()] * len(rows)
        ids = self.byte_id_array[rows]
        score = self.byte_pair_array[rows[:, :-1].astype(np.intp) << 8 | rows[:, 1:]]
        place = np.arange(len(rows))
        while len(place):
            at = score.argmin(1) if score.shape[1] else np.zeros(len(place), np.intp)
            best = score[np.arange(len(at)), at] if score.shape[1] else np.full(len(at), self.none)
            go = best != self.none
            for k, row in zip(place[~go].tolist(), ids[~go].tolist()):
                out[k] = tuple(row)
            place, at, best, ids, score = place[go], at[go], best[go], ids[go], score[go]
            if not len(place):
                break
            line, width = np.arange(len(at)), ids.shape[1]
            column = np.arange(width)
            ids[line, at] = best
            ids = ids[column != at[:, None] + 1].reshape(-1, width - 1)
            score = score[column[:-1] != at[:, None]].reshape(-1, width - 2)
            right, left = np.flatnonzero(at < width - 2), np.flatnonzero(at)
            score[right, at[right]] = self.joined(best[right], ids[right, at[right] + 1])
            score[left, at[left] - 1] = self.joined(ids[left, at[left] - 1], best[left])
        return out

    def merged_many(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """``merged`` of each; short slices of one size together where there are many."""
        out: list[tuple[int, ...]] = [()] * len(pieces)
        sizes: dict[int, list[int]] = {}
        for k, piece in enumerate(pieces):
            if (whole := self.ranks.get(piece)) is not None:
                out[k] = (whole,)
            else:
                sizes.setdefault(len(piece), []).append(k)
        for size, at in sizes.items():
            if size > SHORT_SLICE or len(at) < MANY:
                found = [self.merged(pieces[k]) for k in at]
            else:
                found = self.merged_rows(np.frombuffer(b"".join([pieces[k] for k in at]), np.uint8).reshape(-1, size))
            for k, ids in zip(at, found):
                out[k] = ids
        return out

    def learn(self, pieces: Iterable[str]) -> dict[str, Entry]:
        """Entries of distinct slices that the newer half of the cache lacks, from the older one or made; those of short ones are kept."""
        out = {p: e for p in pieces if (e := self.older.get(p)) is not None}
        new = [p for p in pieces if p not in out]
        for p, ids in zip(new, self.merged_many([p.encode() for p in new])):
            out[p] = array("i", ids).tobytes()
        for p, e in out.items():
            if len(p) <= LONG_SLICE:
                if len(self.cache) >= max(1, CACHE_ENTRIES // 2):
                    self.older, self.cache = self.cache, {}
                self.cache[p] = e
        return out

    def forget(self) -> None:
        self.cache, self.older = {}, {}
        gc.collect()  # also drops the interpreter's lists of free tuples, which hold the memory around them

    def encode(self, texts: list[str]) -> Iterator[tuple[list[tuple[tuple[int, ...], bytes]], np.ndarray]]:
        """For each text: its slices' ids with the bytes they decode to, and where each slice starts."""
        for entries, begin in self.entries(texts):
            ids = [tuple(np.frombuffer(x, np.int32).tolist()) for x in entries]
            yield [(x, self.decode(x)) for x in ids], begin

    def entries(self, texts: list[str]) -> Iterator[tuple[list[Entry], np.ndarray]]:
        """For each text: its slices' entries, and where each slice starts."""
        held: list[tuple[list[str], np.ndarray]] = []
        size = 0
        for text, (begin, n) in zip(texts, slices_of(texts)):
            cuts = [*begin.tolist(), n]
            held.append(([text[a:b] for a, b in zip(cuts, cuts[1:])], begin))
            size += n
            if size >= ROUND:
                yield from self.known(held)
                held, size = [], 0
        yield from self.known(held)

    def known(self, held: list[tuple[list[str], np.ndarray]]) -> Iterator[tuple[list[Entry], np.ndarray]]:
        """The entries of some texts' slices; those that aren't cached are merged together."""
        found = [list(map(self.cache.get, pieces)) for pieces, _ in held]
        lacking = {p: None for (pieces, _), entries in zip(held, found) if None in entries for p, e in zip(pieces, entries) if e is None}
        made = self.learn(lacking)
        for (pieces, begin), entries in zip(held, found):
            yield [e or made[p] for p, e in zip(pieces, entries)] if None in entries else entries, begin

    def decode(self, ids: Sequence[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker and rank file."""
    return Encoder(path)


#: What ``encode`` can return for a text.
OUTPUTS = {
    "n_tokens": ("long", pa.int64()),
    "ids": ("array<int>", pa.list_(pa.int32())),
    "offsets": ("array<int>", pa.list_(pa.int32())),
    "ids_sha256": ("string", pa.string()),
    "decoded_sha256": ("string", pa.string()),
}


def _encoded(path: str, outputs: list[str], names: list[str], place: int, kept: int):
    digests = {"ids_sha256", "decoded_sha256"} & set(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path)
        collects = gc.isenabled()
        gc.disable()  # the entries form no cycles, and walking the cache again and again takes a fifth of the time
        try:
            for batch in sliced(batches, place):
                yield one(e, batch)
        finally:
            e.forget()  # the worker may live on for other stages
            pa.default_memory_pool().release_unused()
            if collects:
                gc.enable()

    def one(e: Encoder, batch: pa.RecordBatch) -> pa.RecordBatch:
        text = batch.column(place)
        rows: dict[str, list] = {x: [] for x in outputs}
        for entries, begin in e.entries([t or "" for t in text.to_pylist()]):
            ids = np.frombuffer(b"".join(entries), np.int32)
            listed = ids.tolist() if digests else []
            for name, held in rows.items():
                if name == "n_tokens":
                    held.append(len(ids))
                elif name == "ids":
                    held.append(ids)
                elif name == "offsets":
                    held.append(np.repeat(begin, [len(x) // ids.itemsize for x in entries]))
                elif name == "ids_sha256":
                    held.append(hashlib.sha256(" ".join([e.decimals[i] for i in listed]).encode()).hexdigest())
                else:
                    held.append(hashlib.sha256(e.decode(listed)).hexdigest())
        made = [pa.array(held, OUTPUTS[name][1]) for name, held in rows.items()]
        return pa.RecordBatch.from_arrays([*batch.columns[:kept], *made], names=[*batch.schema.names[:kept], *names])

    return run


def encode(df: DataFrame, path: str, *, text: str = "text", keep: list[str], outputs: tuple[str, ...] = ("ids", "offsets"), prefix: str = "") -> DataFrame:
    """Ids of every whole text; one row for each row of ``df``, with the columns ``keep`` and, named after ``prefix``, ``outputs``.

    ``ids``, ``offsets`` (code point at which the slice of each id starts),
    ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` (of the bytes that
    decoding the ids gives). A null text counts as empty and has no ids;
    repeated rows are encoded each; an empty table gives an empty one; other
    columns than ``keep`` are not read, and ``prefix`` keeps the names of the
    outputs from clashing with them. ``path`` must name the rank file on every
    executor.
    """
    from pyspark.sql.types import StructType

    chosen, place = reading(df, keep, text)
    names = [f"{prefix}{x}" for x in outputs]
    made = StructType.fromDDL(", ".join(f"`{n}` {OUTPUTS[x][0]}" for n, x in zip(names, outputs)))
    return chosen.mapInArrow(_encoded(path, list(outputs), names, place, len(keep)), StructType([*chosen.schema.fields[: len(keep)], *made.fields]))


def decode(ids: Column, path: str) -> Column:
    """The text of an array of ids; null where the ids are null, U+FFFD where bytes are no UTF-8."""

    @F.pandas_udf("string")
    def text_of(column):  # type: ignore[no-untyped-def]
        e = encoder(path)
        return column.map(lambda x: None if x is None else e.decode([int(i) for i in x]).decode("utf-8", "replace"))

    return text_of(ids)
