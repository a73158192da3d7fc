"""The quality classifier: figures, trees, additive scores and held-out accuracy."""

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from hestia.llm import quality as Q
from hestia.llm import queries
from tests.llm.conftest import LONG


def figure(text, name):
    return Q.figures(text.encode())[Q.FEATURES.index(name)]


def test_figures():
    assert len(Q.figures(b"")) == len(Q.FEATURES) and not any(Q.figures(b"")[:10])
    assert figure("ab cd ab 12 --", "distinct_words") == 4 / 5
    assert figure("ab cd ab 12 --", "dull_words") == 2 / 5
    assert figure("É1 é2 -é", "dull_words") == 0
    assert figure("a a a b", "same_as_last") == 2 / 4
    assert figure("a b c a b c", "repeated_triples") == 1 / 4
    assert figure("AB!! CD%% e.", "symbol_ends") == 2 / 3
    assert figure("aaaa", "entropy") == 0 and figure("ab" * 9, "entropy") == 1
    assert figure("x y\nx y\n\nz", "repeated_lines") == 3 / 10
    assert figure("AbC", "capitals") == 2 / 3


def test_blocks_cover_the_text(monkeypatch):
    text = (LONG + "x" * 500 + " é\n").encode()
    whole = Q.figures(text)
    monkeypatch.setattr(Q, "BLOCK", 97)
    assert b"".join(Q.blocks(text)) == text and len(list(Q.blocks(text))) > 100
    parts = Q.figures(text)
    for name in "log_words word_length letters digits capitals blanks marks dull_words short_words symbol_ends entropy".split():
        i = Q.FEATURES.index(name)
        assert math.isclose(whole[i], parts[i], rel_tol=1e-12), name


def test_trees_find_steps():
    n = np.full(8, 10)
    g = np.array([-4.0, -4, -4, 4, 4, 4, 4, 4])
    step = Q.tree(g, np.full(8, 2.0), n)
    assert (step[:3] < 0).all() and (step[3:] > 0).all() and len(set(step[:3])) == 1
    grid = np.where(np.add.outer(np.arange(4) < 2, np.arange(4) < 2) == 1, 3.0, -3.0)  # exclusive or
    step, gain = Q.tree_of_pair(grid, np.ones((4, 4)), np.full((4, 4), 10))
    assert (np.sign(step) == np.sign(grid)).all() and gain > 0


def test_pairs_are_needed_and_found():
    """Labels by exclusive or of two features: single tables can't tell them, a pair's grid can."""
    r = np.random.default_rng(2)
    x = r.random((2000, 4))
    y = (x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)
    m = Q.fit(x, y.astype(int), np.arange(2000) % 7 == 0)
    assert m.pairs[0][:2] == (0, 1)
    t = r.random((1000, 4))
    assert ((m.probability(t) >= 0.5) == ((t[:, 0] > 0.5) ^ (t[:, 1] > 0.5))).mean() > 0.95


def plain_score(model, x):
    """One row's score, entry by entry."""
    at = lambda ends, v: sum(e <= v for e in ends)
    total = model.intercept + sum(t[at(e, v)] for t, e, v in zip(model.tables, model.edges, x))
    total += sum(grid[at(model.coarse[i], x[i])][at(model.coarse[j], x[j])] for i, j, grid in model.pairs)
    return 1 / (1 + math.exp(-max(-30, min(30, total))))


def test_held_out_rows(spark, sf):
    """The query's scores are the model's plain sums, and right on rows whose labels it never saw."""
    sf = sf.replace("sf0.001", "sf0.01")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = {r.doc_id: r for r in queries.op13_quality(spark, sf).collect()}
    model = Q.learn(docs, labels.where(~Q.held_out(F.crc32(F.col("doc_id").cast("string").cast("binary")))))
    assert len(got) == docs.count()
    for r in docs.collect():
        assert math.isclose(got[r.doc_id].score, plain_score(model, Q.figures((r.text or "").encode())), rel_tol=1e-9)
    seen = [(got[r.doc_id], r.quality) for r in labels.collect() if got[r.doc_id].held_out]
    assert len(seen) > 100 and sum(g.predicted == y for g, y in seen) / len(seen) > 0.98
    assert sum(g.predicted == 0 for g, y in seen if y == 0) / sum(y == 0 for _, y in seen) > 0.9


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, 0), (4, 1), (6, 0), (8, 1), (9, None), (None, 1), (77, 0)], "doc_id long, quality int").withColumn("text", F.lit(1))
    model = Q.learn(odd, labels)
    rows = Q.score(odd, model, keep=["doc_id", "lang", "score"]).toDF("doc_id", "lang", "kept", "score").collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    same = {r.score for r in rows if r.doc_id in (1, 2)}
    assert len(same) == 1 and len({r.score for r in rows if r.doc_id in (3, 4)}) == 1
    assert Q.score(empty, model, keep=["doc_id"]).count() == 0
    for none in (labels.limit(0), labels.where("quality = 1")):
        flat = Q.score(odd, Q.learn(odd, none), keep=["doc_id"]).collect()
        assert len({r.score for r in flat}) == 1


def test_fit_without_rows():
    m = Q.fit(np.zeros((0, 3)), np.zeros(0, int), np.zeros(0, bool))
    assert m.probability(np.zeros((2, 3))).tolist() == pytest.approx([0.5, 0.5])
    assert Q.measured(pa.array([], pa.binary())).shape == (0, len(Q.FEATURES))
