import random

from pyspark.sql import functions as F

from hestia.llm import language as L
from hestia.llm.common import crc_of_id

SYLLABLES = {"xx": "the and ing tion er of to in".split(), "yy": "der die und ung keit sch ein ge".split(), "zz": "que les ment eau oir est une pas".split()}


def corpus(spark, n=300):
    rnd = random.Random(2)
    rows = []
    for i in range(n):
        lang = rnd.choice(list(SYLLABLES))
        words = ["".join(rnd.choice(SYLLABLES[lang]) for _ in range(rnd.randint(1, 3))) for _ in range(rnd.randint(20, 120))]
        rows.append((i, " ".join(words), lang))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_held_out_accuracy(spark):
    df = corpus(spark).withColumn("held_out", L.held_out(crc_of_id()))
    learned = L.learn(df.where("not held_out"))
    assert sorted(learned) == sorted(SYLLABLES) and all(len(d) <= L.DICTIONARY for d in learned.values())
    rows = L.classify(df, learned, keep=["lang", "held_out"]).where("held_out").collect()
    assert len(rows) > 40 and sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97
    assert all(0 <= r.score <= 1 for r in rows) and not any(r.rejected for r in rows)


def test_odd_rows(spark, odd, empty):
    learned = L.learn(odd.where("doc_id != 6"))
    rows = L.classify(odd, learned, keep=["doc_id", "text"]).collect()
    assert len(rows) == odd.count()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.rejected)
        assert r.lang_pred in (*learned, "und")
    assert len({(r.lang_pred, r.score) for r in rows if r.doc_id in (1, 2)}) == 1
    assert L.learn(empty) == {} and L.classify(empty, learned, keep=["doc_id"]).count() == 0
    assert {r.lang_pred for r in L.classify(odd, {}, keep=["doc_id"]).collect()} == {"und"}
    assert L.learn(odd.withColumn("lang", F.lit(None).cast("string"))) == {}


def test_near_ties_are_rejected():
    c = L.Classifier({"a": b"one two three four five six seven", "b": b"one two three four five six seven"})
    assert c.predict("one two three")[2] and c.predict(None) == ("und", 0.0, True)


def test_rejection_is_by_the_margin_of_sizes(spark, sf):
    """Against sizes taken one by one: under the margin all are rejected, above it none."""
    df = spark.read.parquet(f"{sf}/documents.parquet").withColumn("held_out", L.held_out(crc_of_id()))
    learned = L.learn(df.where("not held_out"))
    c = L.Classifier(learned)
    ends = [(" ".join(t.split()[:k])) for (t,) in df.select("text").limit(80).collect() for k in (1, 2, 3, 5, 9)]
    texts = spark.createDataFrame([(t,) for t in ends], "text string")
    narrow = 0
    for r in L.classify(texts, learned, keep=["text"]).collect():
        clean = L.normalised(r.text)
        if not clean:
            assert r.rejected and r.lang_pred == "und"
            continue
        a, b = sorted(c.sizes(clean))[:2]
        assert r.rejected == ((b - a) / a < L.MARGIN)
        narrow += r.rejected
    assert narrow > 5
