"""The divergence audit against plain counting."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from hestia.llm import divergence as D

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {i: i + 32 for i in range(65, 91)}


def plain(rows, least=30, top=50):
    n, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        found = TERM.findall((text or "").translate(FOLD))
        n[lang or "", source or ""].update(found)
        docs[lang or ""].update(set(found))
    out = []
    for lang in docs:
        kept = [t for t, k in docs[lang].items() if k >= least]
        own = {s: c for (x, s), c in n.items() if x == lang}
        share = lambda count: {t: 1 + 10**9 * (count[t] + 5) // (sum(count[x] for x in kept) + 5 * len(kept)) for t in kept}
        p = {s: share(c) for s, c in own.items()}
        q = share(sum(own.values(), Counter()))
        for s in own:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in own if o != s))
            out += [(lang, s, "pair", o, -v, i + 1) for i, (v, _, o) in enumerate(pairs)]
            more = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if own[s][t] > 0 and p[s][t] > q[t])
            out += [(lang, s, "term", t, -v, i + 1) for i, (v, _, t) in enumerate(more[:top])]
    return sorted(out)


def found(df, **kw):
    return sorted(tuple(r) for r in D.audit(df, **kw).select("lang", "source", "part", "item", "value", "rank").collect())


def test_pieces(monkeypatch):
    text = "Ab,cd É😀x 12z--" * 50 + "q" * 300 + " end"
    want = TERM.findall(text.translate(FOLD))
    for block in (1, 2, 7, 64, 1 << 20):
        monkeypatch.setattr(D, "BLOCK", block)
        assert [t.decode() for part in D.pieces(text.encode()) for t in part] == want
    assert list(D.pieces(b"")) == []


def test_sieve(spark):
    """All that it is made of pass, and few others; beyond its bound it is full but not wrong."""
    found = D.digests("en", [str(i).encode() for i in range(3000)])
    table = D.sieve(spark.createDataFrame([(int(d),) for d in found[:1000]], "digest long"))
    assert len(table) * 64 == 16384 and D.passing(table, found[:1000]).all() and D.passing(table, found[1000:]).mean() < 0.1
    assert not D.passing(D.sieve(spark.createDataFrame([], "digest long")), found).any()
    assert list(D.digests("de", [b"x"])) != list(D.digests("en", [b"x"]))


@pytest.mark.parametrize("bits", [64, 6])
def test_given_table(spark, sf, bits):
    """Six bits make nearly every digest stand for several terms, of one language too."""
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.text, r.lang, r.source) for r in df.collect()]
    assert found(df, least_docs=10, top=7, bits=bits) == plain(rows, 10, 7)


def test_flushed_often(spark, sf, monkeypatch):
    df = spark.read.parquet(f"{sf}/documents.parquet").limit(60).persist()
    rows = [(r.text, r.lang, r.source) for r in df.collect()]
    monkeypatch.setattr(D, "HELD", 1)
    assert found(df, least_docs=3) == plain(rows, 3)


def test_tiles(spark):
    """Many tiles of sources and blocks of terms give the sums that one gives."""
    words = "alpha beta gamma delta eps zeta eta theta".split()
    rows = [(" ".join([words[(i * k) % 8] for k in range(1 + i % 7)] + ["own" + "abcdefghijklmnopqrstuvw"[i % 23]]), "en", f"s{i % 23}") for i in range(200)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string")
    words_, counts = D.vocabulary(docs, 2)
    total = counts.groupBy("lang", "source").agg(F.sum("n").alias("total")).withColumn("terms", F.lit(31))
    shares = counts.join(total, ["lang", "source"]).select("lang", "source", "unit", D._share(F.col("n"), F.col("total"), F.col("terms")).alias("p"))
    heads = total.select("lang", "source", D._share(F.lit(0), F.col("total"), F.col("terms")).alias("p0"))
    langs = spark.createDataFrame([("en", 31, 23)], "lang string, terms long, sources long")
    get = lambda **kw: sorted((r.source, r.item, r.value) for r in D.pair_sums(heads, shares, langs, words_, **kw).collect())
    one = get()
    assert len(one) == 23 * 22 and get(sources=4, terms=3) == one
    want = [r for r in plain(rows, 2) if r[2] == "pair"]
    assert one == sorted((r[1], r[3], r[4]) for r in want)


def test_odd_rows(spark, odd, empty):
    rows = [(r.text, r.lang, r.source) for r in odd.select("text", "lang", "source").collect()]
    assert found(odd, least_docs=1) == plain(rows, 1)
    assert found(odd) == plain(rows)
    assert found(empty) == []
    many = [("x y", "en", "a"), (None, "en", "b"), ("x", None, None), ("X Ä", None, "c"), ("", "de", "d")] * 2
    df = spark.createDataFrame(many, "text string, lang string, source string")
    assert found(df, least_docs=2) == plain(many, 2)
    assert [r[4] for r in found(df, least_docs=99)] == [0, 0, 0, 0]
