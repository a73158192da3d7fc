"""Audit of how the sources of a language diverge in their words.

Terms become strings again as late as possible. A first pass over the documents
shuffles a fixed-width digest of each (language, term) with its number of
documents, and nothing else; that tells which digests are kept. A second counts
the occurrences of kept digests by source, again without any string. A bit
table of bounded size, made of the kept digests, keeps nearly all others out of
that shuffle. A third pass fetches the strings of kept digests, once from each
task: the minimum and maximum string of a digest tell whether it stands for
several terms, and only these are counted anew, split by string. Ranks work on
numbers of terms; text is joined back to the rows that are put out.

Sources are compared in tiles: so many sources by so many, for a block of the
language's terms at a time, in numpy; sums of the blocks are added up.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hestia.llm.common import fresh_path

#: Bits of a digest.
BITS = 64
#: Terms that a task holds before it writes its counts; bytes of a text that are cut into terms at a time.
HELD, BLOCK = 150_000, 1 << 20
#: Bits of the table of kept digests for each of them, and at most (8 MB).
BITS_A_DIGEST, MOST_BITS = 16, 1 << 26
#: Sources on a side of a tile and terms of a block, on average.
SOURCES, TERMS = 128, 2048

_PARTING = re.compile(rb"[^A-Za-z\x80-\xff]")
#: Letters of ASCII in lower case and all bytes of other characters stay; the rest parts terms.
_TERMS = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text (A-Z in lower case), a list for about each ``BLOCK`` bytes."""
    at = 0
    while at < len(text):
        end = at + BLOCK
        if end < len(text):
            cut = _PARTING.search(text, end)
            end = cut.start() if cut else len(text)
        yield text[at:end].translate(_TERMS).split()
        at = end


def digests(lang: str, terms: Iterable[bytes], bits: int = BITS) -> np.ndarray:
    """Digests of a language's terms, as signed longs."""
    from xxhash import xxh64_intdigest

    seed = xxh64_intdigest(lang.encode())
    return (np.fromiter(map(xxh64_intdigest, terms, repeat(seed)), np.uint64) >> np.uint64(64 - bits)).view(np.int64)


def sieve(found: DataFrame) -> np.ndarray:
    """A bit table that marks the column ``digest`` of ``found``: from 64 bits up to ``MOST_BITS``, beyond which it lets more through."""
    size = min(MOST_BITS, max(64, 1 << (max(1, found.count() * BITS_A_DIGEST) - 1).bit_length()))
    place = F.col("digest").bitwiseAND(size - 1)
    marked = found.select((place / 64).cast("int").alias("at"), F.pmod(place, F.lit(64)).cast("int").alias("bit"))
    cells = marked.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("cell")).toArrow()  # size / 64 rows at most
    table = np.zeros(size // 64, np.int64)
    table[cells["at"].to_numpy()] = cells["cell"].to_numpy()
    return table


def passing(table: np.ndarray, found: np.ndarray) -> np.ndarray:
    place = found & (len(table) * 64 - 1)
    return (table[place >> 6] >> (place & 63)) & 1 == 1


def counted(docs: DataFrame, *, documents: bool, by_source: bool = False, strings: bool = False, table: np.ndarray | None = None, bits: int = BITS) -> DataFrame:
    """digest and n (documents that hold the term, or its occurrences), and with ``strings`` lang and term, with ``by_source`` source.

    A row or more for each: a task adds up as far as it holds them. Only
    digests that ``table`` lets through.
    """
    fields = [*(["lang string", "term string"] if strings else []), *(["source string"] if by_source else []), "digest long", "n long"]
    names = [f.split()[0] for f in fields]

    def rows(held: dict[tuple[str, str], Counter]) -> Iterator[pa.RecordBatch]:
        for (lang, source), count in held.items():
            if not count:
                continue
            found = digests(lang, count, bits)
            n = np.fromiter(count.values(), np.int64, len(count))
            columns = {"digest": pa.array(found), "n": pa.array(n)}
            if strings:
                columns["term"] = pa.array(list(count), pa.binary()).cast(pa.string())
                columns["lang"] = pa.array([lang] * len(count), pa.string())
            if by_source:
                columns["source"] = pa.array([source] * len(count), pa.string())
            batch = pa.RecordBatch.from_arrays([columns[x] for x in names], names=names)
            yield batch if table is None else batch.filter(pa.array(passing(table, found)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], Counter] = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                count = held.setdefault((lang, source if by_source else ""), Counter())
                before = len(count)
                if documents:
                    count.update(set().union(*pieces(text.as_py())))
                else:
                    for terms in pieces(text.as_py()):
                        count.update(terms)
                size += len(count) - before
                if size >= HELD:
                    yield from rows(held)
                    held, size = {}, 0
        yield from rows(held)

    chosen = docs.select("lang", "source", F.col("text").cast("binary").alias("text"))
    return chosen.mapInArrow(run, ", ".join(fields))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 terms)), in exact arithmetic; null without any term."""
    whole = lambda x: x.cast("decimal(19,0)")
    top = F.lit(1_000_000_000).cast("decimal(10,0)") * whole(n + 5)
    return F.when(terms > 0, F.call_function("div", top, whole(total + 5 * terms)) + 1)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def spelled(docs: DataFrame, table: np.ndarray, bits: int = BITS) -> DataFrame:
    """digest, lang, term: the strings of the digests that ``table`` lets through, each once from a task as far as it remembers them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new: dict[str, set] = {}
        given: dict[str, set] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            for lang, terms in new.items():
                fresh = list(terms - given.setdefault(lang, set()))
                if not fresh:
                    continue
                found = digests(lang, fresh, bits)
                held = np.flatnonzero(passing(table, found)).tolist()
                texts = [fresh[i] for i in held]
                given[lang].update(texts)
                made = [pa.array(found[held]), pa.array([lang] * len(held), pa.string()), pa.array(texts, pa.binary()).cast(pa.string())]
                yield pa.RecordBatch.from_arrays(made, names=["digest", "lang", "term"])
            new.clear()
            if sum(map(len, given.values())) > 3 * HELD:
                given.clear()

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                new.setdefault(lang, set()).update(*pieces(text.as_py()))
                if sum(map(len, new.values())) >= HELD:
                    yield from rows()
        yield from rows()

    return docs.select("lang", F.col("text").cast("binary").alias("text")).mapInArrow(run, "digest long, lang string, term string")


def vocabulary(docs: DataFrame, least_docs: int, bits: int = BITS) -> tuple[DataFrame, DataFrame]:
    """The terms in at least so many documents of their language, and their occurrences.

    The first: lang, term, unit (a number for each). The second: lang, source,
    unit, n, a row for each term that occurs in a group.
    """
    per_digest = counted(docs, documents=True, bits=bits).groupBy("digest").agg(F.sum("n").alias("docs"))
    kept = _written(per_digest.where(F.col("docs") >= least_docs).select("digest"), "digests")
    table = sieve(kept)
    by_source = counted(docs, documents=False, by_source=True, table=table, bits=bits).groupBy("source", "digest").agg(F.sum("n").alias("n"))
    both = F.struct("lang", "term")
    names = spelled(docs, table, bits).groupBy("digest").agg(F.min(both).alias("lo"), F.max(both).alias("hi"))
    names = _written(names.join(kept, "digest", "left_semi"), "names")
    mixed = names.where("lo != hi").select("digest")
    several = not mixed.isEmpty()
    words = names.where("lo = hi").select("digest", "lo.*", F.lit(False).alias("several"))
    if several:
        again = sieve(mixed)
        split = counted(docs, documents=True, strings=True, table=again, bits=bits).join(mixed, "digest", "left_semi")
        split = split.groupBy("digest", "lang", "term").agg(F.sum("n").alias("docs")).where(F.col("docs") >= least_docs)
        words = words.unionByName(split.drop("docs").withColumn("several", F.lit(True)))
    # The numbers hold once they are written.
    words = _written(words.withColumn("unit", F.monotonically_increasing_id()), "vocabulary")
    counts = by_source.join(words.where("not several").select("digest", "lang", "unit"), "digest").select("lang", "source", "unit", "n")
    if several:
        per_term = counted(docs, documents=False, by_source=True, strings=True, table=again, bits=bits).groupBy("lang", "source", "digest", "term")
        held = words.where("several").select("digest", "lang", "term", "unit")
        counts = counts.unionByName(per_term.agg(F.sum("n").alias("n")).join(held, ["digest", "lang", "term"]).select("lang", "source", "unit", "n"))
    return words.select("lang", "term", "unit"), _written(counts, "counts")


def pair_sums(groups: DataFrame, shares: DataFrame, langs: DataFrame, words: DataFrame, sources: int = SOURCES, terms: int = TERMS) -> DataFrame:
    """lang, source, item, value: the sum over the language's kept terms of the difference of the shares, for every two sources.

    ``groups``: lang, source, p0 (share of a term that the group lacks);
    ``shares``: lang, source, unit, p; ``langs``: lang, terms, sources;
    ``words``: lang, unit. Each tile of sources meets each other (and itself)
    once for each block of terms; a task holds one of these at a time. Terms of
    the block that none of its sources has count by their number.
    """
    sized = langs.select(
        "lang",
        F.ceil(F.col("sources") / sources).cast("int").alias("tiles"),
        F.greatest(F.lit(1), F.ceil(F.col("terms") / terms)).cast("int").alias("blocks"),
    )
    block = F.pmod(F.xxhash64("unit"), F.col("blocks")).cast("int")
    tile = F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int")
    # The tile pairs of a row: its own tile with every other.
    meets = F.transform(
        F.sequence(F.lit(0), F.col("tiles") - 1),
        lambda t: F.struct(F.least(t, F.col("tile")).alias("i"), F.greatest(t, F.col("tile")).alias("j"), (F.col("tile") > t).alias("second")),
    )
    rows = shares.join(sized, "lang").select("lang", "source", "unit", "p", F.lit(0).cast("long").alias("held"), block.alias("block"), tile.alias("tile"), "tiles")
    in_block = words.join(sized, "lang").groupBy("lang", block.alias("block")).agg(F.count("*").alias("held"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    heads = groups.join(sized, "lang").select("lang", "source", F.lit(None).cast("long").alias("unit"), F.col("p0").alias("p"), every, tile.alias("tile"), "tiles")
    heads = heads.join(in_block, ["lang", "block"], "left").withColumn("held", F.coalesce("held", F.lit(0)))
    columns = ["lang", "source", "unit", "p", "held", "block"]
    placed = rows.unionByName(heads).select(*columns, F.explode(meets).alias("m")).select(*columns, "m.*")

    def compare(at: pd.DataFrame) -> pd.DataFrame:
        heads = at[at["unit"].isna()].drop_duplicates("source").sort_values("source")
        body = at[at["unit"].notna()]
        names = heads["source"].to_numpy()
        place = pd.Series(np.arange(len(names)), index=names)
        units, column = np.unique(body["unit"].to_numpy(), return_inverse=True)
        absent = heads["p"].to_numpy().astype(np.int64)
        others = int(heads["held"].iloc[0]) - len(units)
        share = np.repeat(absent[:, None], len(units), axis=1)
        share[place[body["source"]].to_numpy(), column] = body["p"].to_numpy().astype(np.int64)
        second = heads["second"].to_numpy().astype(bool)
        left, right = (np.flatnonzero(~second), np.flatnonzero(second)) if at["i"].iloc[0] != at["j"].iloc[0] else (np.arange(len(names)),) * 2
        out = []
        for a in left:
            value = np.abs(share[right] - share[a]).sum(axis=1) + others * np.abs(absent[right] - absent[a])
            out.append(pd.DataFrame({"source": names[a], "item": names[right], "value": value}))
        found = pd.concat(out) if out else pd.DataFrame({"source": [], "item": [], "value": []})
        if at["i"].iloc[0] != at["j"].iloc[0]:
            found = pd.concat([found, found.rename(columns={"source": "item", "item": "source"})])
        found = found[found["source"] != found["item"]]
        found.insert(0, "lang", at["lang"].iloc[0])
        return found[["lang", "source", "item", "value"]]

    parts = placed.groupBy("lang", "i", "j", "block").applyInPandas(compare, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(
    df: DataFrame, *, text: str = "text", lang: str = "lang", source: str = "source", least_docs: int = 30, top: int = 50, bits: int = BITS
) -> DataFrame:
    """lang, source, part, item, value, rank: how each source differs from the others of its language (part ``pair``) and which terms it has more of (``term``).

    A term is a run of letters of ASCII and characters beyond it, A-Z in lower
    case. A language keeps the terms in at least ``least_docs`` of its
    documents. Nulls in the three columns count as empty strings; repeated rows
    count each; groups without a term, and languages without a kept one, have
    their pairs too (value 0 for the latter). Ties rank by item. An empty table
    gives an empty result; other columns are not read.
    """
    docs = df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(x) for c, x in ((lang, "lang"), (source, "source"), (text, "text"))])
    words, counts = vocabulary(docs, least_docs, bits)
    known = docs.select("lang", "source").distinct()
    kept = words.groupBy("lang").agg(F.count("*").alias("terms"))
    in_group = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sums = known.join(in_group, ["lang", "source"], "left").join(kept, "lang", "left")
    groups = _written(sums.select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("terms", F.lit(0)).alias("terms")), "groups")
    langs = groups.groupBy("lang").agg(F.max("terms").alias("terms"), F.count("*").alias("sources"), F.sum("total").alias("lang_total"))
    shares = counts.join(groups, ["lang", "source"]).select("lang", "source", "unit", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    heads = groups.select("lang", "source", F.coalesce(_share(F.lit(0), F.col("total"), F.col("terms")), F.lit(0)).alias("p0"))
    value = F.desc("value")
    within = Window.partitionBy("lang", "source")
    pairs = pair_sums(heads, shares, langs, words).withColumn("rank", F.row_number().over(within.orderBy(value, "item")))
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")

    whole = counts.groupBy("lang", "unit").agg(F.sum("n").alias("n")).join(langs, "lang")
    whole = whole.select("lang", "unit", _share(F.col("n"), F.col("lang_total"), F.col("terms")).alias("q"))
    more = shares.join(whole, ["lang", "unit"]).where("p > q").select("lang", "source", "unit", (F.col("p") - F.col("q")).alias("value"))
    # All that tie with the last place stay until their text tells them apart.
    most = more.withColumn("place", F.rank().over(within.orderBy(value))).where(F.col("place") <= top)
    named = most.join(words.select("unit", F.col("term").alias("item")), "unit")
    named = named.withColumn("rank", F.row_number().over(within.orderBy(value, "item"))).where(F.col("rank") <= top)
    return pairs.unionByName(named.select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
