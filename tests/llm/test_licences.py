import math
import random
import re

from hestia.llm import licences as L

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text))


def by_hand(text, templates, threshold):
    w = words(text or "")
    base = sorted((i, label) for label, p in L.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
    best, more = 0.0, set()
    for line in (text or "").split("\n"):
        v = words(line)
        pairs = set(zip(v, v[1:]))
        for label, t in templates:
            of = set(zip(t.split(), t.split()[1:]))
            if len(of & pairs) >= math.ceil(threshold * len(of) - 1e-9):
                more.add(label)
                best = max(best, len(of & pairs) / len(of))
    labels = {x for _, x in base}
    first, last = (base[0][0], base[-1][0]) if base else (None, None)
    return (len(w), len(base), first, last, ",".join(sorted(labels)), ",".join(sorted(labels | more)), 1.0 if base else best)


def check(df, threshold=L.THRESHOLD):
    rows = sorted((tuple(r) for r in L.licences(df, threshold=threshold).collect()), key=repr)
    want = [(r.doc_id, *by_hand(r.text, L.TEMPLATES, threshold)) for r in df.collect()]
    assert [tuple(map(str, r)) for r in rows] == [tuple(map(str, r)) for r in sorted(want, key=repr)]


def test_random_notices(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(150):
        lines = []
        for _ in range(rnd.randint(1, 4)):
            _, t = rnd.choice(L.TEMPLATES)
            w = [x for x in t.split() if rnd.random() > 0.06]
            at = rnd.randint(0, len(w))
            w[at:at] = rnd.choice([[], ["MIT", "License"], ["noise"], ["Apache\nLicense"]])
            lines.append(rnd.choice([" ", ", "]).join(w))
        rows.append((i, rnd.choice(["\n", " "]).join(lines)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df)
    check(df, 0.6)


def test_odd_rows(odd, empty):
    check(odd.select("doc_id", "text"))
    assert L.licences(odd).count() == odd.count() and L.licences(empty).count() == 0


def by_stretches(text, templates, threshold):
    """Labels and the highest containment over all stretches of each template's greatest length."""
    w, best, more = words(text or ""), 0.0, set()
    for label, t in templates:
        t = t.split()
        of, n = set(zip(t, t[1:])), math.ceil(len(t) / threshold - 1e-9)
        for i in range(max(1, len(w) - 1)):
            v = w[i : i + n]
            hit = len(of & set(zip(v, v[1:])))
            if hit >= math.ceil(threshold * len(of) - 1e-9):
                more.add(label)
                best = max(best, hit / len(of))
    return more, best


def test_wrapped_notices(spark):
    bsd, mit = L.TEMPLATES[6][1], L.TEMPLATES[1][1]
    wrap = lambda t, after: t.replace(after, after + ",\n * ")
    rows = [
        (1, "/*\n * " + wrap(bsd, "with or without") + ":\n */"),
        (2, wrap(mit, "obtaining a copy")),
        (3, "\n".join(bsd.split())),
        (4, wrap(bsd, "with or without") + "\n" + wrap(mit, "a copy")),
        (5, "This text is licensed under\nCC-BY-SA 4.0."),
        (6, "licensed under a Creative\nCommons Attribution-ShareAlike license"),
        (7, " ".join(f"{x}\nfiller text of other kind" for x in bsd.split())),
        (8, "a plain text\n" * 500),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.labels, r.score) for r in L.licences(df, templates=L.TEMPLATES + L.CC_TEMPLATES, wrapped=True).collect()}
    assert [got[i][0] for i in range(1, 9)] == ["bsd", "mit", "bsd", "bsd,mit", "cc", "cc", "", ""]
    assert got[1][1] == got[3][1] == 1.0 and got[7][1] == 0.0


def test_random_stretches(spark):
    rnd = random.Random(8)
    rows = []
    for i in range(120):
        w = []
        for _ in range(rnd.randint(1, 4)):
            part = [x for x in rnd.choice(L.TEMPLATES)[1].split() if rnd.random() > 0.05]
            at = rnd.randint(0, len(part))
            part[at:at] = ["noise"] * rnd.choice([0, 0, 1, 5, 9])
            w += part + ["x"] * rnd.choice([0, 3, 40])
        rows.append((i, "".join(x + rnd.choice([" ", " ", " ", "\n"]) for x in w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for threshold in (L.THRESHOLD, 0.6):
        got = {r.doc_id: r for r in L.licences(df, threshold=threshold, wrapped=True).collect()}
        for i, text in rows:
            lines = by_hand(text, L.TEMPLATES, threshold)
            more, best = by_stretches(text, L.TEMPLATES, threshold)
            labels = set(filter(None, lines[5].split(","))) | more
            assert (got[i].labels, got[i].score) == (",".join(sorted(labels)), max(lines[6], best)), text


def labels_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = L.licences(df, templates=L.ALL_TEMPLATES, wrapped=True).collect()
    return [set(filter(None, r.labels.split(","))) for r in sorted(rows, key=lambda r: r.doc_id)]


def test_standard_texts(spark):
    """Sentences of the standard texts, wrapped and punctuated as in files, and tags name their family and no other."""
    isc = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies."""
    hpnd = isc.replace("and/or", "and")
    mpl = """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0."""
    warranty = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT."""
    lgpl = "under the terms of the GNU Lesser General Public License as published by"
    texts = [
        isc, hpnd, mpl, warranty, lgpl,
        "# SPDX-License-Identifier: GPL-2.0-only", "/* SPDX-License-Identifier: BSD-3-Clause */", "SPDX-License-Identifier:\nLGPL-2.1-or-later",
        "SPDX-License-Identifier: Proprietary", "The software is provided to all, without a fee.", "mozilla and a public license", "",
    ]
    assert labels_of(spark, texts) == [{"isc"}, {"isc"}, {"mpl"}, {"mit"}, {"gpl", "lgpl"}, {"gpl"}, {"bsd"}, {"lgpl"}, set(), set(), set(), set()]


def test_each_template_names_its_own_family(spark):
    """No template's text matches one of another family, but for the LGPL's and AGPL's names, which hold the GPL's phrase."""
    got = labels_of(spark, [t for _, t in L.ALL_TEMPLATES])
    for (label, t), found in zip(L.ALL_TEMPLATES, got):
        assert label in found and found - {label} <= ({"gpl"} if "general public license" in t else set()), t


def test_oracle_knows_stretches_and_all_templates(spark, tmp_path):
    """The registered query and its oracle agree on wrapped and damaged notices of every template."""
    import duckdb

    from hestia.llm import queries as Q

    rnd = random.Random(8)
    rows = []
    for i in range(300):
        parts = []
        for _ in range(rnd.randint(1, 3)):
            _, t = rnd.choice(L.ALL_TEMPLATES)
            w = [x.upper() if rnd.random() < 0.1 else x for x in t.split() if rnd.random() > 0.05]
            parts.append("".join(x + rnd.choice([" ", " ", " ", ", ", "\n * "]) for x in w))
        rows.append((i, rnd.choice(["\n", " ", " and so on "]).join(parts)))
    rows += [(1000, None), (1001, ""), (1002, "mit")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    want = con.execute(Q.ORACLES["op8_licences"])
    names = [c[0] for c in want.description]
    want = sorted(want.fetchall())
    got = sorted(tuple(r[c] for c in names) for r in Q.op8_licences(spark, str(tmp_path)).collect())
    assert [x[:-1] for x in got] == [x[:-1] for x in want]
    assert all(math.isclose(a[-1], b[-1]) for a, b in zip(got, want)) and sum(0 < x[-1] < 1 for x in got) > 20
