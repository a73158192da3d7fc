"""The pipeline's rows against a plain Python version of its five stages."""

import re
import zlib

import corpus_pipeline as P
from hestia.llm import language
from hestia.llm import ledger
from hestia.llm import simhash

FOLD = {i: i + 32 for i in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(FOLD))


def windows(items):
    found = set()
    for text in items:
        w = words(text)
        size = min(10, len(w))
        if size:
            found |= {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    return found


def hit(text, wins):
    w, sizes = words(text), {len(x) for x in wins}
    return any(tuple(w[i : i + s]) in wins for s in sizes for i in range(len(w) - s + 1))


def secret(text):
    for rule in ledger.RULES:
        for m in re.finditer(rule.pattern, text or ""):
            if len(m[rule.group]) >= rule.at_least:
                return True
    return False


def test_kept_documents_and_ids(spark, sf):
    import tiktoken
    from public_tokenizers import PATTERN, path
    from tiktoken.load import load_tiktoken_bpe

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    # Language: the learned dictionaries, one text after another.
    known = docs.where(~language.held_out(P.crc_of_id()))
    assert {r.doc_id for r in known.collect()} == {i for i in rows if zlib.crc32(str(i).encode()) % 4 != 2}
    c = language.Classifier(language.learn(known))
    left = [i for i in sorted(rows) if not c.predict(rows[i].text)[2]]
    # Near duplicates: all pairs, one of each group.
    fp = {i: simhash.fingerprint(rows[i].text, 3) for i in left}
    root = {i: i for i in left}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in left:
        for j in left:
            if i < j and (fp[i] ^ fp[j]).bit_count() <= 2:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    left = [i for i in left if find(i) == i]
    wins = windows([r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()])
    left = [i for i in left if not hit(rows[i].text, wins)]
    left = [i for i in left if not secret(rows[i].text)]
    enc = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=load_tiktoken_bpe(str(path(P.RANKS))), special_tokens={})
    got = {r.doc_id: r for r in P.run(spark, sf).collect()}
    assert sorted(got) == left and 0 < len(left) < len(rows)
    for i in left:
        assert got[i].ids == enc.encode_ordinary(rows[i].text or "") and got[i].n_tokens == len(got[i].ids)
