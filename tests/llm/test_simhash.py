import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from hestia.llm import simhash


def by_hand(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else " " if c in "\t\n\v\f\r" else c for c in text or "").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(odd):
    for r in simhash.near_duplicates(odd, keep=["text"]).collect():
        assert r.fp % (1 << 64) == by_hand(r.text)


def roots_by_hand(fps, radius):
    parent = list(range(len(fps)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


@pytest.mark.parametrize("radius,tile", [(2, 512), (2, 4), (3, 8), (0, 2)])
def test_links_are_exact(spark, monkeypatch, radius, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rnd = random.Random(radius)
    fps = [0, (1 << 64) - 1]
    for _ in range(12):
        at = rnd.getrandbits(64)
        for _ in range(25):
            fps.append(at)
            for _ in range(rnd.randint(0, radius + 1)):
                at ^= 1 << rnd.randrange(64)
    fps = sorted(set(fps))
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    found = {r.node: r.root for r in simhash.components(simhash.links(df, radius)).collect()}
    groups = {}
    for f, r in zip(signed, roots_by_hand(fps, radius)):
        groups.setdefault(r, set()).add(found.get(f, f))
    assert all(len(x) == 1 for x in groups.values()) and len({next(iter(x)) for x in groups.values()}) == len(groups)


def pairs_by_hand(fps, radius, tile):
    """Tile pairs formed and skipped, by counting the rows of each population count in each bucket."""
    n = radius + 1
    edges = [64 * i // n for i in range(n + 1)]
    buckets = {}
    for f in fps:
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            buckets.setdefault((i, f >> a & ((1 << (b - a)) - 1)), []).append(bin(f).count("1"))
    formed = skipped = 0
    for pops in buckets.values():
        tiles = [p for p in sorted(set(pops)) for _ in range(-(-pops.count(p) // tile))]
        if len(pops) > 1:
            for i, p in enumerate(tiles):
                for q in tiles[i:]:
                    formed, skipped = formed + (q - p <= radius), skipped + (q - p > radius)
    return formed, skipped


@pytest.mark.parametrize("tile", [512, 3])
def test_tile_pairs_run_on_the_documents(spark, monkeypatch, tile):
    """At the query's own parameters: tile pairs are compared and others skipped, as many as counted by hand."""
    monkeypatch.setattr(simhash, "TILE", tile)
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    fps = simhash.fingerprints(docs, keep=["doc_id"]).select("fp").distinct().persist()
    formed, skipped = simhash.tile_pairs(fps).first()
    assert (formed, skipped) == pairs_by_hand([r.fp % (1 << 64) for r in fps.collect()], 2, tile)
    assert formed > 0 and skipped > 0
    fps.unpersist()


def test_tile_pairs_of_a_crowded_bucket(spark):
    """One bucket of all population counts: only counts within the radius meet; no rows give no pairs."""
    fps = [(1 << i) - 1 for i in range(33)]  # the upper half is equal in all
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    assert tuple(simhash.tile_pairs(df).first()) == pairs_by_hand(fps, 2, simhash.TILE)
    assert tuple(simhash.tile_pairs(df.limit(0)).first()) == (0, 0)


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 3000)], "a long, b long")
    found = {r.node: r.root for r in simhash.components(edges).collect()}
    assert all(found[i] == 0 for i in range(1, 301)) and found[3000] == 2000 and 1000 not in found


def test_odd_rows(odd, empty):
    rows = simhash.near_duplicates(odd, keep=["text"]).collect()
    assert len(rows) == odd.count()
    of = {}
    for r in rows:
        of.setdefault(r.text, set()).add((r.fp, r.component_id))
    assert all(len(x) == 1 for x in of.values())
    assert next(iter(of["Le chat et le chien sont dans la maison avec un homme."]))[1] == 9
    assert next(iter(of[None])) == next(iter(of[""])) == (0, 3)
    assert simhash.near_duplicates(empty).count() == 0


def test_one_of_each(odd, empty, spark):
    kept = simhash.one_of_each(odd)
    assert kept.columns == odd.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 6, 7, 8, 9]
    assert simhash.one_of_each(empty).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d"), (None, "x y z u v w"), (None, "a b c d")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.one_of_each(nulls.withColumn("extra", F.lit(1))).collect()) == ["a b c d", "x y z u v w"]
