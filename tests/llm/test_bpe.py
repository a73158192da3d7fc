import base64
import hashlib
import random
import tracemalloc

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from hestia.llm import bpe

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def tk():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_every_code_point_and_random_texts(tk):
    rnd = random.Random(1)
    letters = "ab's''tre vell md !?1२٣é中\n\t \r\xa0 \x85\x1c\x00𝒳😀'll've'd́ǅⅫ²"
    texts = ["".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    texts += ["", "'s", "\n's", "  's", "don't 'really", "a" * 5000, "ab" * 400 + " " * 300]
    texts.append("".join(chr(c) for c in range(1, 0x20000) if not 0xD800 <= c < 0xE000))
    e = bpe.Encoder(PATH)
    for text, (groups, begin) in zip(texts, e.encode(texts)):
        ids = [i for g, _ in groups for i in g]
        assert ids == tk.encode_ordinary(text)
        assert e.decode(ids) == text.encode()
        assert "".join(text[a:b] for a, b in zip(begin, [*begin[1:], len(text)])) == text


def test_cache_starts_anew(tk, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    e = bpe.Encoder(PATH)
    text = "several different words keep the cache of this encoder small"
    ((groups, _),) = list(e.encode([text]))
    assert [i for g, _ in groups for i in g] == tk.encode_ordinary(text) and len(e.cache) <= 3


def test_odd_rows(odd, tk):
    rows = bpe.encode(odd, PATH, keep=["doc_id", "text"], outputs=tuple(bpe.OUTPUTS)).collect()
    assert len(rows) == odd.count()
    for r in rows:
        text = r.text or ""
        assert list(r.ids) == tk.encode_ordinary(text) and r.n_tokens == len(r.ids) == len(r.offsets)
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.ids)).encode()).hexdigest()


def test_names_and_round_trip(odd, empty):
    made = bpe.encode(odd, PATH, keep=odd.columns, outputs=("ids",), prefix="t_")
    back = made.select("text", bpe.decode(F.col("t_ids"), PATH).alias("back")).collect()
    assert all((r.text or "") == r.back for r in back)
    assert bpe.encode(empty, PATH, keep=["doc_id"]).count() == 0


def test_slices_in_use_stay_cached(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 8)
    e, made = bpe.Encoder(PATH), []
    whole = e.merged_many
    monkeypatch.setattr(e, "merged_many", lambda pieces: made.extend(pieces) or whole(pieces))
    for i in range(12):  # more slices than the cache holds; one of them comes every time
        list(e.encode([f"often w{chr(97 + i)}q" + chr(97 + i) * 3]))
    assert made.count(b"often") == 1 and len(e.cache) + len(e.older) <= 8
    e.forget()
    assert not e.cache and not e.older


def test_many_slices_are_merged_together(tk):
    rnd = random.Random(2)
    pieces = ["".join(rnd.choice("abcdeth \x00é中🙂") for _ in range(rnd.randint(1, 20))).encode() for _ in range(3000)]
    pieces += [b"ab" * 30] * bpe.MANY + [b"aaaa", b"\xff\xfe", b"th" * 24]
    e = bpe.Encoder(PATH)
    assert e.merged_many(pieces) == [e.merged(p) for p in pieces]
    assert e.merged_many([]) == []
    words = ["".join(rnd.choice("abcdeth") for _ in range(9)) for _ in range(2000)]
    for w, (groups, _) in zip(words, e.encode(words)):
        assert [i for g, _ in groups for i in g] == tk.encode_ordinary(w)


def test_memory_of_cache_and_classes():
    e, rnd = bpe.Encoder(PATH), random.Random(3)
    words = list({"".join(rnd.choice("abcdethqxz") for _ in range(8)) for _ in range(20_000)})
    tracemalloc.start()
    try:
        e.learn(words)
        held = tracemalloc.get_traced_memory()[0] / len(e.cache)
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        bpe.codepoint_classes.__wrapped__()
        made = tracemalloc.get_traced_memory()[1] - before
    finally:
        tracemalloc.stop()
    assert len(e.cache) == len(words)
    assert held < 150, held  # bytes a slice besides its text, 395 with the ids as objects and their texts
    assert made < 40 << 20, made  # 82 MB with a string for each code point
