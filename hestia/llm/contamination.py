"""Benchmark decontamination by a prefix-filtered set join.

A window is ``width`` consecutive words of an item (a shorter item is one
window). Taken as a set of word shingles, a window that occurs in a document
has all its shingles there, so the document must hold the window's rarest one:
for containment c a set of n shingles needs the n - ceil(c n) + 1 rarest as
its prefix, which for whole windows is one. Shingles are ordered by how often
they occur in all documents. Documents' shingles are joined with these prefix
shingles only; the place of the shingle in document and window gives the one
place where the window can lie, which must fit between the first and the last
word (positional and length bound); then the words there are compared one by
one. Built-in functions only.

The items' side is broadcast where a count shows that it has at most
``BROADCAST_ROWS`` rows of bounded width; beyond that, Spark joins by shuffle:
of the documents' shingles, those that a bit table of bounded size (a Bloom
filter of one broadcast row) can't rule out go, without the words, which are
joined to the candidates' documents afterwards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hestia.llm.common import WORD, ascii_lower, checkpointed

#: Words in a shingle.
SHINGLE = 3
#: Rows up to which the items' side is broadcast (a hash, a few numbers, and the words of a window).
BROADCAST_ROWS = 200_000
#: Bits of the table for each row it is made of, and at most (8 MB).
BITS_A_ROW, MOST_BITS = 16, 1 << 26


def words(text: Column) -> Column:
    """The words of a text, A-Z in lower case; none for null."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def shingles(w: Column, size: int) -> Column:
    """Hashes of ``size`` consecutive words, by place."""
    n = F.size(w) - (size - 1)
    each = lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(size)])
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), each)).otherwise(F.array().cast("array<bigint>"))


def windows(items: DataFrame, width: int, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, win, size, k, sh): the distinct windows of each item, with the hashes of their shingles of k words."""
    n = F.size("w")
    size = F.least(F.lit(width), n)
    of_item = items.select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("w")).where(n > 0)
    each = of_item.select(
        "item_id", size.alias("size"), F.explode(F.transform(F.sequence(F.lit(0), n - size), lambda i: F.slice("w", i + 1, size))).alias("win")
    ).distinct()
    k = F.least(F.lit(SHINGLE), F.col("size"))
    sh = F.lit(None)
    for s in range(SHINGLE, 0, -1):
        sh = F.when(k == s, shingles(F.col("win"), s)).otherwise(sh)
    return each.select("item_id", "win", "size", k.alias("k"), sh.alias("sh"))


def _is_small(df: DataFrame, most: int) -> bool:
    """Whether ``df`` has at most ``most`` rows."""
    return df.limit(most + 1).count() <= most


def sieved(rows: DataFrame, by: DataFrame, keys: list[str]) -> DataFrame:
    """The rows whose keys may be in ``by``: all that are, and few others unless the table is full."""
    wanted = max(1, by.count()) * BITS_A_ROW
    bits = min(MOST_BITS, max(64, 1 << (wanted - 1).bit_length()))
    places = [F.pmod(F.xxhash64(F.lit(i), *keys), F.lit(bits)) for i in range(2)]
    marked = by.select(F.explode(F.array(*places)).alias("b")).select((F.col("b") / 64).cast("int").alias("at"), F.pmod("b", F.lit(64)).cast("int").alias("bit"))
    # bits / 64 rows at most.
    cells = marked.distinct().groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("cell")).toArrow()
    filled = np.zeros(bits // 64, dtype=np.int64)
    filled[cells["at"].to_numpy()] = cells["cell"].to_numpy()
    one = rows.sparkSession.createDataFrame(pa.table({"__bits": pa.array([filled], pa.list_(pa.int64()))}))
    held = F.lit(True)
    for p in places:
        bit = F.call_function("getbit", F.get("__bits", (p / 64).cast("int")), F.pmod(p, F.lit(64)).cast("int"))
        held = held & (bit == 1)
    return rows.join(F.broadcast(one), held).select(rows.columns)


def hits(docs: DataFrame, items: DataFrame, *, width: int = 10, keys: list[str], text: str = "text") -> DataFrame:
    """(keys, item_id, start, size): every place in a document where a window of an item occurs.

    ``keys`` must tell rows with different texts apart; rows equal in them and
    in their text give their hits once.
    """
    wins = checkpointed(windows(items, width))
    sizes = [r.k for r in wins.select("k").distinct().collect()]  # SHINGLE values at most
    tokens = docs.select(*keys, words(F.col(text)).alias("w"))

    def in_documents(keep: list) -> DataFrame:
        """(keep, k, pos, h) of every shingle."""
        every = [tokens.select(*keep, F.lit(k).alias("k"), F.posexplode(shingles(F.col("w"), k)).alias("pos", "h")) for k in sizes]
        out = every[0]
        for df in every[1:]:
            out = out.unionAll(df)
        return out

    if not sizes:
        return docs.select(*keys, F.lit(None).cast(items.schema["item_id"].dataType).alias("item_id"), F.lit(0).alias("start"), F.lit(0).alias("size")).limit(0)
    wanted = wins.select("k", F.explode(F.array_distinct("sh")).alias("h")).distinct()
    if _is_small(wanted, BROADCAST_ROWS):
        often = in_documents([]).join(F.broadcast(wanted), ["k", "h"]).groupBy("k", "h").agg(F.count("*").alias("n"))
    else:
        often = sieved(in_documents([]), wanted, ["k", "h"]).groupBy("k", "h").agg(F.count("*").alias("n")).join(wanted, ["k", "h"])
    # The rarest shingle of each window; one that no document has rules the window out.
    ranked = (
        wins.select("item_id", "win", "size", "k", F.posexplode("sh").alias("at", "h"))
        .join(often, ["k", "h"], "left")
        .groupBy("item_id", "win", "size", "k")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "h", "at")).alias("rare"))
        .where("rare.n > 0")
    )
    prefix = checkpointed(ranked.select("k", F.col("rare.h").alias("h"), F.col("rare.at").alias("at"), "item_id", "win", "size"))
    start = F.col("pos") - F.col("at")
    if _is_small(prefix, BROADCAST_ROWS):
        found = in_documents([*keys, "w"]).join(F.broadcast(prefix), ["k", "h"])
    else:
        shared = sieved(in_documents(keys), prefix.select("k", "h").distinct(), ["k", "h"]).join(prefix, ["k", "h"])
        shared = checkpointed(shared.where(start >= 0).drop("k", "h").distinct())
        of = shared.withColumnsRenamed({x: f"__of_{x}" for x in keys})
        same_row = [F.col(x).eqNullSafe(F.col(f"__of_{x}")) for x in keys]
        found = sieved(tokens, shared.select(*keys).distinct(), keys).join(of, same_row)
    fits = (start >= 0) & (start + F.col("size") <= F.size("w"))
    same = F.slice("w", start + 1, F.col("size")) == F.col("win")
    # The second condition is tried only where the window fits.
    return found.where(F.when(fits, same).otherwise(False)).select(*keys, "item_id", start.alias("start"), "size").distinct()


def covered(spans: Column) -> Column:
    """Number of words in the union of sorted (start, size)."""
    return F.aggregate(
        spans,
        F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda acc, x: F.struct(
            (acc["n"] + F.greatest(F.lit(0), x["start"] + x["size"] - F.greatest(acc["to"], x["start"]))).alias("n"),
            F.greatest(acc["to"], x["start"] + x["size"]).alias("to"),
        ),
        lambda acc: acc["n"].cast("long"),
    )


def contaminated(docs: DataFrame, items: DataFrame, *, width: int = 10, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, n_items, item_ids (sorted as strings) of every row of ``docs``.

    A null text has no words and no hits, nor has any document where the items
    have no words. Items with equal windows all count. Rows with a null id or
    a repeated one are told apart by their text; equal rows are returned each.
    An empty table gives an empty one; other columns are not read.
    """
    d = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    key = {"__id": F.coalesce("doc_id", F.lit(-1)), "__text": F.xxhash64("text")}
    d = d.withColumns(key)
    of_doc = (
        hits(d, items.select("item_id", "text"), width=width, keys=list(key))
        .groupBy(*key)
        .agg(
            covered(F.array_sort(F.collect_set(F.struct("start", "size")))).alias("n_hit"),  # no more than the document has words, for each size
            F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("item_ids"),
        )
    )
    counted = d.select("doc_id", *key, F.size(words(F.col("text"))).cast("long").alias("n_words"))
    none = F.array().cast("array<string>")
    return counted.join(of_doc, list(key), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce(F.size("item_ids"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("item_ids", none).alias("item_ids"),
    )


def without_benchmark(docs: DataFrame, items: DataFrame, width: int = 10) -> DataFrame:
    """The rows of ``docs`` in which no window of an item occurs, with all their columns."""
    key = {"__id": F.coalesce("doc_id", F.lit(-1)), "__text": F.xxhash64("text")}
    keyed = docs.withColumns(key)
    hit = hits(keyed.select(*key, "text"), items.select("item_id", "text"), width=width, keys=list(key)).select(*key).distinct()
    return keyed.join(hit, list(key), "left_anti").select(docs.columns)
