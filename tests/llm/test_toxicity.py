import random

from pyspark.sql import functions as F

from hestia.llm import toxicity as T


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_automaton_and_trie():
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abc") for _ in range(rnd.randint(5, 8)))
    terms = {word(): (True, 1.0) for _ in range(15)}
    lexicon = T.Lexicon(terms, {})
    for _ in range(1500):
        w = word()
        near = [t for t in terms if distance(w, t) <= 1]
        assert lexicon.nearest(w) == (min(near) if near else None), (w, near)


def test_context():
    lexicon = T.Lexicon({"idiot": (True, 1.0)}, {"vequ": 0.5})
    plain = lexicon.abuse("what an idiot on the road")
    assert lexicon.abuse('he said "what an idiot" and left') < plain < lexicon.abuse("you idiot")
    assert lexicon.abuse("what an idi0t on the road") == T.FUZZY_WEIGHT * plain
    assert lexicon.abuse("le vequmo") == 0.5 and lexicon.abuse("fine words only") == 0


def corpus(spark, n=900):
    rnd = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rnd.choice(["the", "ing", "er", "of", "ta"]) for _ in range(rnd.randint(1, 3))) for _ in range(40)]
        toxic = rnd.random() < 0.2
        if toxic:
            for _ in range(3):
                words[rnd.randrange(40)] = rnd.choice(["idiot", "stupid", "wretched"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out(spark):
    docs, labels = corpus(spark)
    model = T.learn(docs, labels.where("doc_id % 3 != 0"))
    assert {"idiot", "stupid", "wretched"} <= set(model["words"])
    rows = T.score(docs, model, keep=["doc_id"]).join(labels, "doc_id").where("doc_id % 3 = 0").collect()
    assert all((r.score >= 0.5) == bool(r.toxic) for r in rows)
    texts = spark.createDataFrame([(0, "you wretchd person"), (1, "a fine day")], "doc_id long, text string")
    assert [r.score >= 0.5 for r in T.score(texts, model, keep=["doc_id"]).orderBy("doc_id").collect()] == [True, False]


def test_odd_rows(odd, empty, spark):
    docs, labels = corpus(spark)
    model = T.learn(docs, labels)
    rows = T.score(odd, model, keep=["doc_id"]).collect()
    assert len(rows) == odd.count() and all(0 <= r.score < 0.5 for r in rows)
    assert T.score(empty, model, keep=["doc_id"]).count() == 0
    for few in (labels.limit(0), labels.withColumn("toxic", F.lit(None).cast("int")), labels.withColumn("toxic", F.lit(0))):
        bare = T.learn(docs, few)
        assert not bare["words"] and all(0 <= r.score <= 1 for r in T.score(odd, bare, keep=["doc_id"]).collect())
    twice = labels.unionAll(labels).unionAll(spark.createDataFrame([(None, 1)], "doc_id long, toxic int"))
    assert set(T.learn(docs, twice)["words"]) == set(model["words"])


def swapped(a, b):
    """Edits from a to b where two neighbouring letters may change places as one."""
    d = {(i, j): i + j for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and y == a[i - 2]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_swaps_and_two_edits():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abc") for _ in range(rnd.randint(3, 9)))
    terms = {w: ((len(w) >= 4) + (len(w) >= 8), 1.0) for w in (word() for _ in range(15))}
    lexicon = T.Lexicon(terms, {}, swaps=True)
    for _ in range(1500):
        w = word()
        near = [(swapped(w, t), t) for t, (edits, _) in terms.items() if swapped(w, t) <= edits]
        assert lexicon.near(w) == (min(near) if near else None), (w, near)


def test_clean_neighbours(spark):
    docs, labels = corpus(spark)
    ordinary = F.when(F.col("toxic") == 0, F.concat("text", F.lit(" idiom studio scam "))).otherwise(F.concat("text", F.lit(" scum ")))
    docs = docs.join(labels, "doc_id").select("doc_id", ordinary.alias("text"))
    model = T.learn(docs, labels)
    lexicon = T.Lexicon(model["words"], model["stems"], model["clean"], swaps=True)
    assert {"idiom", "scam"} <= set(model["clean"])
    assert not any(lexicon.weight(w) for w in ("idiom", "scam", "studio"))
    assert all(lexicon.weight(w) > 0 for w in ("idoit", "idiott", "stpuid", "scumm", "scmu", "wretvhde"))
