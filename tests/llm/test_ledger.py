import random
import re
import tempfile
import time

from hestia.llm import ledger as L

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def by_hand(text):
    text = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out)


def found(df):
    return {r.doc_id: [(s.start, s.rank, s.kind, s.end) for s in r.spans if s.rank < 3] for r in L.scan(df, content="text", keep=["doc_id"]).collect()}


def test_spans(spark):
    rnd = random.Random(3)
    parts = ["token", "SECRET", "api_key", "apikey", "=", ":", " ", "'", '"', "abc", "deadbeefdeadbeef0123456789ab", "AKIA", "ABCDEFGHIJKLMNOP1", "é", "😀", "zzzzzz", "ſecret", "-", "."]
    texts = ["secret: api_key=abcdefgh x", "password=abc TOKEN==abcdef", "AKIAAKIA1 AKIA" + "A" * 16]
    texts += ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 40))) for _ in range(300)]
    got = found(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert all(got[i] == by_hand(t) for i, t in enumerate(texts))


def test_more_rules(spark):
    text = "x -----BEGIN RSA PRIVATE KEY----- y ghp_" + "xY" * 20
    (row,) = L.scan(spark.createDataFrame([(1, text)], "doc_id long, text string"), content="text", keep=["doc_id"]).collect()
    assert [s.kind for s in row.spans] == ["pem", "github"]


def test_only_unseen_pairs_are_scanned(spark):
    path = tempfile.mkdtemp() + "/ledger"
    first = spark.createDataFrame([("a", "token=abcdef"), ("b", "token=abcdef"), ("c", "nothing")], "path string, text string")
    L.scan(first, content="text", keep=["path"], ledger_path=None)
    L.scan_unseen(first, None, "text").write.parquet(path)
    assert L.read_ledger(spark, path).count() == 2 * len(L.RULES)
    more = first.union(spark.createDataFrame([("d", "AKIA" + "B" * 16), ("a", "a new version")], "path string, text string"))
    assert L.scan_unseen(more, L.read_ledger(spark, path), "text").count() == 2 * len(L.RULES)
    rules = [*L.RULES[:-1], L.Rule("github", "gh", version=2)]
    assert L.scan_unseen(first, L.read_ledger(spark, path), "text", rules).count() == 2
    rows = L.scan(more, content="text", keep=["path"], ledger_path=path).collect()
    assert sorted((r.path, len(r.spans)) for r in rows) == [("a", 0), ("a", 1), ("b", 1), ("c", 0), ("d", 1)]
    assert L.read_ledger(spark, path).count() == 4 * len(L.RULES)


def test_odd_rows(odd, empty):
    rows = L.scan(odd, content="text", keep=["doc_id"]).collect()
    assert len(rows) == odd.count() and not any(r.spans for r in rows)
    assert L.scan(empty, content="text", keep=["doc_id"]).count() == 0
    assert L.without_secrets(odd).count() == odd.count() and L.without_secrets(empty).count() == 0
    assert L.without_secrets(odd).columns == odd.columns


def test_a_second_run_scans_only_what_is_new(spark):
    path = L.new_ledger(spark)
    first = spark.createDataFrame([("a", "token=abcdef"), ("b", "token=abcdef"), ("c", None)], "path string, text string")
    assert sorted((r.path, len(r.spans)) for r in L.scan(first, content="text", keep=["path"], ledger_path=path).collect()) == [("a", 1), ("b", 1), ("c", 0)]
    assert L.read_ledger(spark, path).count() == 2 * len(L.RULES)
    second = first.union(spark.createDataFrame([("a", "AKIA" + "B" * 16)], "path string, text string"))
    rows = L.scan(second, content="text", keep=["path"], ledger_path=path).collect()
    assert sorted((r.path, len(r.spans)) for r in rows) == [("a", 1), ("a", 1), ("b", 1), ("c", 0)]
    assert L.read_ledger(spark, path).count() == 3 * len(L.RULES)  # one more blob, the others not again
    L.scan(second, content="text", keep=["path"], ledger_path=path).collect()
    assert L.read_ledger(spark, path).count() == 3 * len(L.RULES)


def test_many_matches_in_one_text(spark):
    texts = [(n, "é " + " x ".join(f"token={i:08d}" + (" secret=ab" if i % 3 else "") for i in range(n))) for n in (1, 127, 128, 129, 300)]
    got = found(spark.createDataFrame(texts, "doc_id long, text string"))
    assert all(got[i] == by_hand(t) for i, t in texts)
    text = " ".join(f"token={i:08d}" for i in range(50000))
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    began = time.monotonic()
    assert got[1] and found(df)[1] == by_hand(text)
    assert time.monotonic() - began < 30  # session start and both joins included
