"""SimHash fingerprints, exact near-duplicate links and their components.

Fingerprints are made row by row. Equal fingerprints are folded to one before
anything is compared, so exact copies cost nothing more. Pairs within the
radius are found exactly: the 64 bits are cut into ``radius + 1`` blocks, and
two fingerprints that differ in at most ``radius`` bits agree in a whole
block at least, so comparing within each (block, its value) finds every link.
At radius 2 a bucket of n evenly spread fingerprints has n / 2 million rows.
The fingerprints of every such bucket, small or large, are laid out in tiles
of one population count and about ``TILE`` rows; tile pairs whose population
counts differ beyond the radius are never formed (``tile_pairs`` counts both
kinds), and the others are compared with exclusive-or and bit counts in numpy. A large bucket becomes many tile pairs in many tasks. A tile
pair returns a spanning set of its links (at most one row for each
fingerprint in it), not all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from hestia.llm.common import checkpointed

#: Fingerprints in a tile at most, about: a bucket's rows are dealt into so many tiles that a tile has this on average.
TILE = 512
SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """Bit i is 1 where it is set in over half of the shingles' hashes."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().lower().split()  # bytes: A-Z, and white space of ASCII
    if not words:
        return 0
    joined = b" ".join(words)
    ends, at = [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    begins = [0, *[e + 1 for e in ends[:-1]]]
    spans = zip(begins, ends[shingle - 1 :]) if len(words) >= shingle else [(0, ends[-1])]
    hashes = np.array([xxh64_intdigest(joined[a:b], SEED) for a, b in spans], np.uint64)
    total = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 65536):
        block = np.unpackbits(hashes[i : i + 65536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        total += block.sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(df: DataFrame, *, text: str = "text", keep: list[str], shingle: int = 3) -> DataFrame:
    """``keep`` and ``fp``, the fingerprint as a signed long, for every row of ``df``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *rest, texts = batch.columns
            fps = np.array([fingerprint(t, shingle) for t in texts.to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*rest, pa.array(fps)], names=[*batch.schema.names[:-1], "fp"])

    chosen = df.select(*keep, F.col(text).alias("__text"))
    return chosen.mapInArrow(run, StructType([*chosen.schema.fields[:-1], StructField("fp", LongType())]))


def _block_keys(radius: int) -> list[Column]:
    """The value of each of ``radius + 1`` blocks of the fingerprint, as a key with the block's number."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    masks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]
    signed = [x - (1 << 64 if x >> 63 else 0) for x in masks]
    return [
        F.struct(F.lit(k).cast("byte").alias("block"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("bits"))
        for k, m in enumerate(signed)
    ]


def _compared(radius: int):
    """Spanning links of each tile pair; rows of one come together, sorted."""

    def spanning(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
        """Links (child, root) that connect what is linked between ``a`` and ``b`` (a tile with itself: both the same)."""
        sides, same = (a, b), a is b
        left = [np.arange(len(a)), np.arange(len(b))]  # not reached yet
        out = []
        while len(left[0]):
            root = int(left[0][0])
            left[0] = left[0][1:]
            if same:
                left[1] = left[0]
            todo = [(0, root)]
            while todo:
                side, i = todo.pop()
                other = 0 if same else 1 - side
                rest = left[other]
                hit = np.bitwise_count(sides[side][i] ^ sides[other][rest]) <= radius
                if hit.any():
                    found = rest[hit]
                    left[other] = rest[~hit]
                    todo += [(other, int(j)) for j in found]
                    out += [(int(sides[other][j].view(np.int64)), int(a[root].view(np.int64))) for j in found]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def pairs(t: pa.Table, cut: np.ndarray) -> pa.RecordBatch:
            side = t.column("side").to_numpy()
            fp = t.column("fp").to_numpy().view(np.uint64)
            inner = t.column("inner").to_numpy()
            out: list[tuple[int, int]] = []
            for a, b in zip(cut, cut[1:]):
                s, f = side[a:b], fp[a:b]
                if inner[a]:
                    out += spanning(f, f)
                elif (s == 0).any() and (s == 1).any():
                    out += spanning(f[s == 0], f[s == 1])
            child, root = zip(*out) if out else ((), ())
            return pa.RecordBatch.from_arrays([pa.array(child, pa.int64()), pa.array(root, pa.int64())], names=["a", "b"])

        def cuts(t: pa.Table) -> np.ndarray:
            new = np.zeros(t.num_rows, bool)
            for name in ("block", "bits", "p", "q", "s", "t"):
                x = t.column(name).to_numpy()
                new[1:] |= x[1:] != x[:-1]
            return np.flatnonzero(new)

        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = t if held is None else pa.concat_tables([held, t])
            cut = cuts(t)
            if not len(cut):
                held = t
                continue
            yield pairs(t, np.array([0, *cut]))
            held = t.slice(cut[-1])
        if held is not None and held.num_rows:
            yield pairs(held, np.array([0, held.num_rows]))

    return run


def _tiles(fps: DataFrame, radius: int) -> tuple[DataFrame, DataFrame]:
    """(fp, block, bits, pop) of each fingerprint in each of its buckets, and (block, bits, tiles) of the buckets of two rows or more.

    ``tiles`` maps each population count of the bucket to its number of tiles; at most 65 counts.
    """
    keyed = fps.select("fp", F.explode(F.array(*_block_keys(radius))).alias("key")).select(
        "fp", "key.block", "key.bits", F.bit_count("fp").alias("pop")
    )
    bucket = ["block", "bits"]
    sizes = keyed.groupBy(*bucket, "pop").agg(F.count("*").alias("n"))
    tiles = (
        sizes.groupBy(*bucket)
        .agg(F.sum("n").alias("rows"), F.map_from_entries(F.collect_list(F.struct("pop", F.ceil(F.col("n") / TILE).cast("int")))).alias("tiles"))
        .where(F.col("rows") > 1)
    )
    return keyed, tiles.select(*bucket, "tiles")


def tile_pairs(fps: DataFrame, radius: int = 2) -> DataFrame:
    """(formed, skipped): pairs of tiles that ``links`` compares, a tile with itself among them, and those left out by their population counts."""
    _, tiles = _tiles(fps, radius)
    entries = F.map_entries("tiles")
    total = F.aggregate(F.map_values("tiles"), F.lit(0).cast("long"), lambda s, n: s + n)

    def beyond(x: Column) -> Column:
        far = F.filter(entries, lambda y: y["key"] - x["key"] > radius)
        return x["value"] * F.aggregate(far, F.lit(0).cast("long"), lambda s, y: s + y["value"])

    skipped = F.aggregate(entries, F.lit(0).cast("long"), lambda s, x: s + beyond(x))
    of = tiles.select((total * (total + 1) / 2).cast("long").alias("all"), skipped.alias("skipped"))
    return of.agg((F.coalesce(F.sum("all"), F.lit(0)) - F.coalesce(F.sum("skipped"), F.lit(0))).alias("formed"), F.coalesce(F.sum("skipped"), F.lit(0)).alias("skipped"))


def links(fps: DataFrame, radius: int = 2) -> DataFrame:
    """Links (a, b) between the distinct fingerprints ``fp`` of ``fps``; their connected components are those of all pairs within ``radius``."""
    keyed, tiles = _tiles(fps, radius)
    bucket = ["block", "bits"]
    dealt = keyed.join(tiles, bucket).withColumn("own", F.pmod(F.xxhash64("fp"), F.col("tiles")[F.col("pop")]).cast("int"))

    # (side, p, s, q, t): in the tile pair of population counts p <= q with tiles s and t, this row is on that side.
    def with_pop(other: Column) -> Column:
        def with_tile(t: Column) -> Column:
            first = (F.col("pop") < other) | ((F.col("pop") == other) & (F.col("own") <= t))
            return F.struct(
                ((F.col("pop") == other) & (F.col("own") == t)).alias("inner"),
                F.when(first, 0).otherwise(1).alias("side"),
                F.least(F.col("pop"), other).alias("p"),
                F.when(first, F.col("own")).otherwise(t).alias("s"),
                F.greatest(F.col("pop"), other).alias("q"),
                F.when(first, t).otherwise(F.col("own")).alias("t"),
            )

        count = F.coalesce(F.col("tiles")[other], F.lit(0))
        return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), with_tile)).otherwise(F.array().cast("array<struct<inner:boolean,side:int,p:int,s:int,q:int,t:int>>"))

    near = F.flatten(F.transform(F.sequence(F.col("pop") - radius, F.col("pop") + radius), with_pop))
    placed = dealt.select("fp", *bucket, F.explode(near).alias("x")).select("fp", *bucket, "x.*")
    order = [*bucket, "p", "q", "s", "t"]
    placed = placed.repartition(*order).sortWithinPartitions(*order)
    return placed.mapInArrow(_compared(radius), "a long, b long").distinct()


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """(node, root): the smallest node that each node of the links (a, b) reaches.

    Alternates large-star and small-star steps until the links are stars. Each
    round is cut from its lineage by a reliable checkpoint.
    """

    def star(both: DataFrame, large: bool) -> DataFrame:
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        joined = both.join(low, "u")
        if large:
            return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()

    down = checkpointed(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    seen = None
    for _ in range(most):
        both = down.union(down.select(F.col("v").alias("u"), F.col("u").alias("v")))
        down = checkpointed(star(star(both, True), False))
        now = down.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == seen:
            return down.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = now
    raise RuntimeError(f"components did not settle in {most} rounds")


def near_duplicates(df: DataFrame, *, doc_id: str = "doc_id", text: str = "text", keep: list[str] | None = None, shingle: int = 3, radius: int = 2) -> DataFrame:
    """(doc_id, fp, component_id): for each row, its fingerprint and the smallest id that its fingerprint reaches by links.

    A null or empty text, or one without words, has the fingerprint zero and
    is linked like any other. Rows with a null id keep it and get the smallest
    id of their component (null if that has none). Repeated rows are returned
    each; an empty table gives an empty one. Of the other columns of ``df``
    only those in ``keep`` are read and returned.
    """
    chosen = df.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__body"), *(keep or []))
    rows = checkpointed(fingerprints(chosen, text="__body", keep=["doc_id", *(keep or [])], shingle=shingle))
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("doc_id"))
    roots = components(links(rows.select("fp").distinct(), radius))
    group = least.join(roots, least.fp == roots.node, "left").select("fp", F.coalesce("root", "fp").alias("root"), "doc_id")
    best = group.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_fp = group.join(best, "root").select("fp", "component_id", "root")
    return rows.join(of_fp, "fp")


def one_of_each(docs: DataFrame, *, shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: that of the smallest id.

    Among rows of one component with that id (repeated or with null ids) the
    one of the smallest text hash stays; rows that also agree in their text
    are one document.
    """
    keyed = docs.withColumns({"__id": F.coalesce("doc_id", F.lit(-1)), "__hash": F.xxhash64("text")})
    found = near_duplicates(keyed, keep=["__id", "__hash"], shingle=shingle, radius=radius)
    first = F.min(F.struct(F.col("doc_id").isNull(), "__id", "__hash")).alias("first")
    kept = found.groupBy("root").agg(first).select("first.__id", "first.__hash")
    return keyed.join(kept, ["__id", "__hash"], "left_semi").dropDuplicates(["__id", "__hash"]).select(docs.columns)
