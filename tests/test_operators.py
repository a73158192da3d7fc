"""Operator invariants and skew-safe variants."""

from pyspark.sql import functions as F

from hestia.operators import aggregate as A
from hestia.operators import joins as J
from hestia.operators import ranking as O
from hestia.operators import relational as P
from hestia.plans.words import word_count, word_pairs
from hestia.sources.pages import until_empty
from hestia.sources.tables import listing_view, load


def test_enrich_keeps_rows(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    c = load(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    dup_dim = c.unionByName(c)  # duplicated dimension keys must not multiply rows
    assert J.enrich(o, dup_dim, "o_custkey", ["c_mktsegment"]).count() == o.count()


def test_histogram_sums_and_last_bin(spark, sf):
    v = listing_view(spark, sf)
    h = A.histogram(v, "prix", 60)
    assert h.agg(F.sum("count")).first()[0] == v.filter(F.col("prix").isNotNull()).count()
    assert h.agg(F.max("bin")).first()[0] == 59
    df = spark.createDataFrame([(0.0,), (5.0,), (10.0,)], "x double")
    bins = {r["bin"]: r["count"] for r in A.histogram(df, "x", 2).collect()}
    assert bins == {0: 1, 1: 2}  # the maximum falls in the last, closed bin
    same = spark.createDataFrame([(3.0,), (3.0,)], "x double")
    assert A.histogram(same, "x", 4).first()["count"] == 2


def test_word_counts_sum_to_tokens(spark, sf):
    d = load(spark, sf, "documents").filter(F.col("lang") == "fr")
    n_tokens = word_pairs(d, "text").count()
    assert word_count(d, "text").agg(F.sum("count")).first()[0] == n_tokens


def test_topk_subset_and_order(spark, sf):
    o = load(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    top = O.top_k(o, [("o_totalprice", "desc"), ("o_orderkey", "asc")], 10).collect()
    assert len(top) == 10
    prices = [r["o_totalprice"] for r in top]
    assert prices == sorted(prices, reverse=True)
    assert o.agg(F.max("o_totalprice")).first()[0] == prices[0]


def test_group_by_key_chunks(spark, sf):
    v = listing_view(spark, sf).filter(F.col("pieces").isNotNull())
    g = A.group_by_key(v, "ville", "pieces", ["lien"], chunks=7)
    per_key = g.groupBy("ville").agg(F.count(F.lit(1)).alias("chunks"), F.sum(F.size("values")).alias("n"))
    truth = v.groupBy("ville").agg(F.count(F.lit(1)).alias("n_true"))
    rows = per_key.join(truth, "ville").collect()
    assert rows and all(r["n"] == r["n_true"] for r in rows)
    assert all(r["chunks"] <= 7 for r in rows)
    assert A.values_of(v, "ville", "pieces").count() == v.count()


def test_hot_key_with_one_repeated_id_is_split(spark):
    df = spark.range(4000).selectExpr("'hot' AS k", "id AS v", "1 AS row_id")
    g = A.group_by_key(df, "k", "v", ["row_id"], chunks=8)
    sizes = [len(r["values"]) for r in g.collect()]
    assert len(sizes) == 8 and sum(sizes) == 4000 and max(sizes) < 700


def test_lists_and_folds_are_bounded_by_rows(spark):
    """A key with most of the rows is dealt to lists of the bound; folds of any depth give the whole result."""
    df = spark.range(5000).selectExpr("CASE WHEN id < 4000 THEN 'hot' WHEN id < 4900 THEN NULL ELSE concat('k', id) END AS k", "id AS v", "id AS row_id")
    lists = A.group_by_key(df, "k", "v", ["row_id"], most=200).collect()
    assert max(len(r["values"]) for r in lists) <= 200
    assert sorted(x for r in lists for x in r["values"]) == list(range(5000))
    assert sum(r["k"] == "k4950" for r in lists) == 1 and sum(r["k"] == "hot" for r in lists) == 40
    want = {r["k"]: r["n"] for r in df.groupBy("k").agg(F.sum("v").alias("n")).collect()}
    for most in (3, 50, 10_000):
        got = A.reduce_by_key(df, "k", "v", zero=F.lit(0).cast("bigint"), merge=lambda x, y: x + y, most=most).collect()
        assert {r["k"]: r["value"] for r in got} == want


def test_until_empty(spark):
    rows = [("a", 1, 5), ("a", 2, 0), ("a", 3, 4), ("b", 2, 1), ("b", 7, 1), ("c", 1, 0), ("d", 3, 0), ("d", 1, 2), ("d", 9, None), (None, 1, 3), (None, 2, 0)]
    df = spark.createDataFrame(rows, "site string, page int, cards int")
    got = sorted(map(tuple, until_empty(df, "site", "page", F.col("cards") == 0).collect()), key=str)
    assert got == sorted([("a", 1, 5), ("b", 2, 1), ("b", 7, 1), ("d", 1, 2), (None, 1, 3)], key=str)
    assert until_empty(df.limit(0), "site", "page", F.col("cards") == 0).count() == 0


def test_mode_tie_break(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("a", 2), ("a", 1), ("b", 5)], "k string, v int")
    got = {r["k"]: (r["v"], r["count"]) for r in A.mode_per_group(df, ["k"], "v").collect()}
    assert got == {"a": (1, 2), "b": (5, 1)}
    text = spark.createDataFrame([("a", "y"), ("a", "x"), ("a", "x"), ("a", "y"), ("b", None)], "k string, v string")
    assert [(r["k"], r["v"], r["count"]) for r in A.mode_per_group(text, ["k"], "v").collect()] == [("a", "x", 2)]


def test_reduce_by_key_and_share(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 4.0)], "k string, v double")
    assert {r["k"]: r["value"] for r in A.reduce_by_key(df, "k", "v", "sum").collect()} == {"a": 3.0, "b": 4.0}
    longest = A.reduce_by_key(
        spark.createDataFrame([("a", "x"), ("a", "xyz"), ("b", "q"), ("b", None)], "k string, v string"),
        "k", "v", zero=F.lit(""), merge=lambda x, y: F.when(F.length(y) > F.length(x), y).otherwise(x), most=2,
    )
    assert {r["k"]: r["value"] for r in longest.collect()} == {"a": "xyz", "b": "q"}
    s = {r["k"]: r["share"] for r in A.share(df, "k").collect()}
    assert abs(s["a"] - 2 / 3) < 1e-6


def test_tail_rows_and_violations(spark, sf):
    v = listing_view(spark, sf)
    t = P.tail_rows(v, ["surface"], 0.99, exact=True)
    q = v.agg(F.percentile("surface", 0.99)).first()[0]
    assert t.filter(F.col("surface") < q).count() == 0
    clean = P.drop_outliers(v, "prix", "surface", 500, 25000, {"surface": 925})
    r = P.ratio("prix", "surface")
    assert P.violations(clean, (r < 500) | (r > 25000) | (F.col("surface") >= 925)).count() == 0


def test_same_result_any_partitioning(spark, sf):
    v = listing_view(spark, sf)
    a = A.group_stats(v.repartition(1), ["type_bien"], "prix", exact=True).orderBy("type_bien").collect()
    b = A.group_stats(v.repartition(13), ["type_bien"], "prix", exact=True).orderBy("type_bien").collect()
    assert a == b


def test_exact_quantiles(spark):
    import random

    import numpy as np

    rnd = random.Random(3)
    rows = [(k, rnd.choice([None, float(rnd.randrange(40)), rnd.random() * 1e6])) for k in "aab" for _ in range(3000)]
    rows += [("one", 7.0), ("none", None), (None, 2.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    probs = [0.0, 0.25, 0.5, 0.99, 1.0]
    got = {r["k"]: r["values"] for r in A.exact_quantiles(df, ["k"], "v", probs).collect()}
    assert "none" not in got and got["one"] == [7.0] * 5
    assert np.allclose(got[None], [2.0, 2.25, 2.5, 2.99, 3.0])
    for k in "ab":
        want = np.quantile([v for x, v in rows if x == k and v is not None], probs)
        assert np.allclose(got[k], want)
    every = A.exact_quantiles(df, [], "v", [0.5], accuracy=100).first()["values"][0]
    assert np.isclose(every, np.median([v for _, v in rows if v is not None]))


def test_union_widens_numbers(spark):
    from hestia.operators.setops import union_common

    a = spark.createDataFrame([(250000, "x", 1)], "prix int, ville string, code int")
    b = spark.createDataFrame([(250000.0, "x", "1"), (90000.0, "y", "2")], "prix double, ville string, code string")
    u = union_common(a, b)
    assert dict(u.dtypes) == {"prix": "double", "ville": "string", "code": "string"}
    assert [r["prix"] for r in u.distinct().orderBy(F.desc("prix")).collect()] == [250000.0, 90000.0]


def test_pinned_and_duplicates_are_sorted(spark):
    df = spark.createDataFrame([("a", 3.0), ("b", 9.0), ("c", 1.0), ("Lyon x", 0.5), ("lyon a", 0.7), ("d", None)], "ville string, prix double")
    got = [tuple(r) for r in O.top_k_with_pinned(df, "ville", "prix", 2, "LYON").collect()]
    assert got == [("b", 9.0), ("a", 3.0), ("Lyon x", 0.5)]
    dup = spark.createDataFrame([("x",), ("y",), ("y",), ("y",), ("x",), ("z",), (None,), (None,)], "t string")
    assert [tuple(r) for r in A.duplicate_groups(dup, ["t"]).collect()] == [("y", 3), (None, 2), ("x", 2)]
    words = spark.createDataFrame([("maison jardin maison",), ("grand jardin maison",)], "t string")
    assert [tuple(r) for r in word_count(words, "t").collect()] == [("maison", 3), ("jardin", 2), ("grand", 1)]


def test_context_without_guard(spark):
    from hestia.functions.text import context_matches

    df = spark.createDataFrame([("grand balcon sud",)], "t string")
    assert df.select(context_matches("t", "balcon")).first()[0] == ["grand balcon sud"]


def test_duplicate_totals_by_hash(spark):
    """Counts equal those of whole rows, with nulls in different places and zeros of both signs; no text is shuffled."""
    rows = [(1, "a", 0.0), (1, "a", -0.0), (None, "1", 2.5), (1, None, 2.5), (1, None, 2.5), (2, "x" * 5000, None)]
    df = spark.createDataFrame(rows, "k int, t string, x double")
    assert tuple(A.duplicate_totals(df).first()) == (6, 4, 2) and df.distinct().count() == 4
    plan = A.duplicate_totals(df)._jdf.queryExecution().executedPlan().toString()
    shuffled = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert shuffled and not any(" t#" in line or "(t#" in line for line in shuffled)


def test_exact_quantiles_order_few_values(spark, monkeypatch):
    """A continuous column with a coarse sketch: exact with any number of slots, infinities and NaN included, and few values meet in a task."""
    df = spark.range(30_000).selectExpr("id % 3 AS k", "pow(rand(5), 3) * 1000 AS v").persist()
    probs = [0.0, 0.01, 0.5, 0.99, 1.0]
    want = {r["k"]: r["q"] for r in df.groupBy("k").agg(F.percentile("v", probs).alias("q")).collect()}
    for slots in (1, 7, 65_536):
        monkeypatch.setattr(A, "SLOTS", slots)
        got = {r["k"]: r["values"] for r in A.exact_quantiles(df, ["k"], "v", probs, accuracy=50).collect()}
        assert all(abs(x - y) < 1e-9 for k in want for x, y in zip(got[k], want[k]))
    odd = spark.createDataFrame([(x,) for x in [float("-inf"), -1.0, 0.0, 0.0, 2.0, float("inf"), float("nan"), None]], "v double")
    assert A.exact_quantiles(odd, [], "v", [0.0, 0.5]).first()["values"] == [float("-inf"), 0.0]
    plan = A.exact_quantiles(df, ["k"], "v", [0.5])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    assert len(windows) == 2 and all("slot" in line for line in windows)
