import random
import re

from hestia.llm import contamination as C

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def by_hand(text, items, width):
    w, hit, which = words(text), set(), set()
    for item_id, item in items:
        v = words(item)
        n = min(width, len(v))
        for i in range(len(v) - n + 1 if v else 0):
            for s in range(len(w) - n + 1):
                if w[s : s + n] == v[i : i + n]:
                    hit.update(range(s, s + n))
                    if item_id is not None:
                        which.add(str(item_id))
    return len(w), len(hit), sorted(which)


def check(df, items, width):
    known = [tuple(r) for r in items.collect()]
    rows = sorted((tuple(r) for r in C.contaminated(df, items, width=width).collect()), key=repr)
    want = []
    for r in df.collect():
        n, hit, which = by_hand(r.text, known, width)
        want.append((r.doc_id, n, hit, len(which), which))
    assert rows == sorted(want, key=repr)


def test_odd_rows(odd, empty, items):
    check(odd.select("doc_id", "text"), items, 10)
    assert C.contaminated(empty, items).count() == 0
    none = C.contaminated(odd, items.limit(0)).collect()
    assert len(none) == odd.count() and not any(r.n_hit for r in none)
    kept = C.without_benchmark(odd, items)
    assert kept.columns == odd.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 3, 4, 5, 7, 8, 9]


def test_random_texts(spark, monkeypatch):
    rnd = random.Random(5)
    vocabulary = ["a", "b", "C", "é", "É", "d1"]
    text = lambda n: rnd.choice([" ", ", "]).join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, n)))
    docs = spark.createDataFrame([(i, text(60)) for i in range(60)], "doc_id long, text string")
    items = spark.createDataFrame([(i, text(9)) for i in range(25)], "item_id long, text string")
    check(docs, items, 4)
    monkeypatch.setattr(C, "BROADCAST_ROWS", 0)
    check(docs, items, 5)


def test_shuffled_rows_are_narrow(spark, odd, items, monkeypatch):
    docs = odd.select("doc_id", "text")
    monkeypatch.setattr(C, "BROADCAST_ROWS", 0)
    check(docs, items, 10)
    kept = C.without_benchmark(odd, items)
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 0, 3, 4, 5, 7, 8, 9]
    keyed = docs.where("doc_id is not null").select("doc_id", "text").distinct()
    plan = C.hits(keyed, items, keys=["doc_id"])._jdf.queryExecution().executedPlan().toString()
    for line in plan.split("\n"):  # no shingle row carries the words of its document
        assert not ("Generate posexplode" in line and re.search(r"\[[^\]]*\bw#", line.split("posexplode", 1)[1].split("),", 1)[-1])), line


def test_sieve(spark):
    rows, by = spark.range(5000).selectExpr("id AS k", "xxhash64(id) AS h"), spark.range(0, 5000, 50).selectExpr("id AS k", "xxhash64(id) AS h")
    kept = C.sieved(rows, by, ["k", "h"])
    assert kept.columns == ["k", "h"] and kept.join(by, ["k", "h"]).count() == 100 and kept.count() < 400
    assert C.sieved(rows, by.limit(0), ["k", "h"]).count() == 0
