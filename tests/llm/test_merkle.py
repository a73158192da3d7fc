import hashlib
import random
import re
import time

import xxhash

from pyspark.sql import functions as F

from hestia.llm import merkle as M


def test_edits_by_hand(odd, empty, spark):
    rows = M.compare_with_edits(odd.where("doc_id is not null").dropDuplicates(["doc_id"])).collect()
    texts = {r.doc_id: r.text or "" for r in odd.collect()}
    ids = sorted((r.doc_id for r in rows), reverse=True)
    for r in rows:
        text, other = texts[r.doc_id], texts[ids[(ids.index(r.doc_id) + 1) % len(ids)]]
        half = len(text) // 2
        after = text[: len(text) - half] + other[:half]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(after.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.near_edited == 1) == (after == text) and (r.fingerprint == r.edited_fingerprint) == (after == text)
    assert M.compare_with_edits(odd).count() == odd.count()
    assert M.compare_with_edits(empty).count() == 0


def test_neighbours_across_ranges(spark, monkeypatch):
    monkeypatch.setattr(M, "RANGE_ROWS", 3)
    ids = [5, 9, -4, 1000, 10**15, 17, 18, 19, 20, 21, 44, 45, 2, 3]
    df = spark.createDataFrame([(i, f"text of {i}") for i in ids], "doc_id long, text string")
    got = {r.doc_id: r.next_text for r in M.with_next(df, doc_id="doc_id", text="text").collect()}
    down = sorted(ids, reverse=True)
    assert got == {i: f"text of {down[(k + 1) % len(down)]}" for k, i in enumerate(down)}


def cut(items, ends):
    runs, run = [], []
    for k, x in enumerate(items):
        run.append(x)
        if ends(x) or k == len(items) - 1:
            runs.append(run)
            run = []
    return runs


def falls(text, one_of):
    h = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return (h - (1 << 64) if h >> 63 else h) % one_of == 0


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def plain_tree(text):
    """The tree by plain loops: (root, [(node, [(node, [leaf])])])."""

    def leaf(pieces):
        h = 42
        for p in pieces:
            h = xxhash.xxh64(p.encode(), seed=h).intdigest()
        return f"{h:016x}"[-12:]

    lines = []
    for line in text.split("\n"):
        runs = cut(re.findall(r"(?as)\S{1,32}+(?!\S)\s*|.", line), lambda x: falls(x, M.LEAF))
        leaves = [leaf(r[i : i + M.LONGEST]) for r in runs for i in range(0, len(r), M.LONGEST)]
        lines.append((sha("".join("." + x for x in leaves))[:16], leaves))
    sections = [(sha("".join(n for n, _ in r))[:16], r) for r in cut(lines, lambda x: not x[1] or falls(x[0], M.SECTION))]
    return sha("".join(n for n, _ in sections))[:32], sections


def plain_fingerprint(tree):
    entry = lambda s: s[0] + "".join("," + n + "".join("." + x for x in leaves) for n, leaves in s[1])
    return tree[0] + "".join("/" + entry(s) for s in tree[1])


def plain_likeness(a, b):
    if a[0] == b[0]:
        return 1.0
    x, y, common = {n: c for n, c in a[1]}, {n: c for n, c in b[1]}, 0
    common += sum(len(leaves) for n in x.keys() & y.keys() for _, leaves in x[n])
    below = lambda u, v: {n: leaves for s in u.keys() - v.keys() for n, leaves in u[s]}
    p, q = below(x, y), below(y, x)
    common += sum(len(p[n]) for n in p.keys() & q.keys())
    u = {leaf for n in p.keys() - q.keys() for leaf in p[n]}
    v = {leaf for n in q.keys() - p.keys() for leaf in q[n]}
    common += len(u & v)
    rest = len(u ^ v)
    return min(2 * common / max(2 * common + rest, 1), 0.999)


def plain_edit(a, b):
    def agreeing(x, y):
        front = 0
        while front < min(len(x), len(y)) and x[front] == y[front]:
            front += 1
        back = 0
        while back < min(len(x), len(y)) - front and x[-1 - back] == y[-1 - back]:
            back += 1
        return front, len(x) - back - 1

    lines = lambda t: [line for _, s in t[1] for line in s]
    return agreeing(lines(a), lines(b))


def random_texts(n):
    rnd = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "é", "naïve", "x", "", "日本語のテキスト", "a" * 50, "tab\tbed", "non\u00a0break", "ſ", "😀", "end."]
    for _ in range(n):
        lines = [" ".join(rnd.choice(words) for _ in range(rnd.randint(0, 30))) for _ in range(rnd.randint(1, 40))]
        other = list(lines)
        for _ in range(rnd.randint(0, 3)):
            k = rnd.randrange(len(other) + 1)
            other[k:k + rnd.randint(0, 1)] = [rnd.choice([*lines, "something new here"])] * rnd.randint(0, 2)
        yield "\n".join(lines), "\n".join(other)


def compared(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    df = df.select("i", M.fingerprint(F.col("a")).alias("a"), M.fingerprint(F.col("b")).alias("b"))
    a, b = F.col("a"), F.col("b")
    return df.select("i", a, b, M.likeness(a, b).alias("l"), M.edit(a, b).alias("e"), M.edit(a, a).alias("none")).orderBy("i").collect()


def test_against_a_plain_tree(spark):
    same = [w * n for w in ("one ", "two ", "x", "é", "word ", "go ") for n in (31, 32, 33, 64, 65, 200)]
    pairs = [("", ""), ("", "a"), ("\n", "\n\n"), ("a b c", "a b c\n"), *random_texts(120), *zip(same, same[1:])]
    for (a, b), r in zip(pairs, compared(spark, pairs)):
        x, y = plain_tree(a), plain_tree(b)
        assert r.a == plain_fingerprint(x) and r.b == plain_fingerprint(y)
        assert abs(r.l - plain_likeness(x, y)) < 1e-12 and (r.l == 1) == (a == b)
        assert r.none is None and (r.e is None) == (a == b)
        if r.e:  # a line counts as touched where its section's neighbours do: descending finds the same lines
            assert (r.e.first_line, r.e.last_line) == plain_edit(x, y)


def test_inserted_character_in_a_long_paragraph(spark):
    text = " ".join(f"word{i * i % 97}x{i}" for i in range(250))
    pairs = [("Q" + text, text), (text[:900] + "Q" + text[900:], text), ("Q" + "".join(f"{i:x}" for i in range(9000)), "".join(f"{i:x}" for i in range(9000)))]
    for r in compared(spark, pairs):
        assert 0.9 < r.l < 1 and r.e.first_line == r.e.last_line == 0 and r.e.last_leaf - r.e.first_leaf <= 2


def test_where_an_edit_is(spark):
    lines = [f"paragraph number {i} says something of its own" for i in range(60)]
    other = [*lines[:30], "this one is new", *lines[31:]]
    inserted = [*lines[:30], "this one is new", *lines[30:]]
    r, s = compared(spark, [("\n".join(lines), "\n".join(other)), ("\n".join(lines), "\n".join(inserted))])
    assert 0.9 < r.l < 1 and (r.e.first_line, r.e.last_line) == (30, 30)
    assert 0.9 < s.l < 1 and (s.e.first_line, s.e.last_line) == (30, 29)


def test_half_of_a_text_of_one_word(spark):
    pairs = [(w * 4000, w * 2000 + "something else entirely " * 300) for w in ("one ", "two ", "x", "é", "word ", "go ")]
    assert all(r.l > 0.1 for r in compared(spark, pairs))


def test_many_lines_and_long_lines(spark):
    texts = ["\n".join(f"line {i}" for i in range(64000)), "word " * 200000, "x" * 300000]
    began = time.monotonic()
    rows = compared(spark, [(t, t[:-1] + "!") for t in texts])
    assert all(r.l < 1 for r in rows) and time.monotonic() - began < 20  # three pairs
