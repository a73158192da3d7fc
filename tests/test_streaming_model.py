"""Streaming ingest idempotence and deterministic model split."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from hestia.plans import model as M
from hestia.session import scratch_dir
from hestia.sources.pages import read_pages
from hestia.streaming.ingest import BATCH, batch_log, ingest_pages, page_record


def test_ingest_is_idempotent(spark, sf):
    pages = read_pages(spark, f"{sf}/pages.parquet")
    root = scratch_dir(spark, "ingest-test")
    land, out = f"{root}/landed", f"{root}/table"
    pages.write.parquet(land)
    ingest_pages(spark, land, out, f"{root}/ckpt1", page_record, ["page_id"])
    first = spark.read.parquet(out).count()
    # A replay from scratch (lost checkpoint) appends nothing new.
    ingest_pages(spark, land, out, f"{root}/ckpt2", page_record, ["page_id"])
    assert spark.read.parquet(out).count() == first == pages.count()
    assert batch_log(spark, out).agg(F.sum("n_new")).first()[0] == first


def test_failed_write_is_made_good(spark, sf):
    pages = read_pages(spark, f"{sf}/pages.parquet")
    root = scratch_dir(spark, "ingest-fail")
    land, out, ckpt = f"{root}/landed", f"{root}/table", f"{root}/ckpt"
    pages.repartition(3).write.parquet(land)
    calls = []

    def fails_once(batch):
        calls.append(1)
        records = page_record(batch)
        if len(calls) == 2:  # the second batch breaks off while it is written
            records = records.withColumn("h1", F.when(F.col("page_id") % 5 == 0, F.raise_error(F.lit("lost"))).otherwise(F.col("h1")))
        return records

    with pytest.raises(StreamingQueryException):
        ingest_pages(spark, land, out, ckpt, fails_once, ["page_id"], max_files_per_trigger=1)
    ingest_pages(spark, land, out, ckpt, fails_once, ["page_id"], max_files_per_trigger=1)
    got = spark.read.parquet(out)
    assert got.count() == pages.count() == got.select("page_id").distinct().count()
    assert sorted(r["n_new"] for r in batch_log(spark, out).collect() if r["n_new"]) and batch_log(spark, out).count() == 3


def test_batch_reads_only_its_buckets(spark):
    """Keys in no order: only those in a batch's buckets and between its least and greatest are looked up, by filters that reach the scan."""
    from hestia.streaming.ingest import BUCKET, _bucket, _near, _written

    root = scratch_dir(spark, "ingest-buckets")
    key = F.xxhash64("id").alias("page_id")  # no order at all
    land, out = f"{root}/landed", f"{root}/table"
    page = [key, F.lit("u").alias("url"), F.lit("<title>t</title>").alias("html")]
    spark.range(4000).select(*page).coalesce(1).write.parquet(land)
    ingest_pages(spark, land, out, f"{root}/ckpt", page_record, ["page_id"])
    batch = spark.range(3990, 4010).select(*page[:1])
    known = _written(spark, out, ["page_id"], "another", batch.schema)
    near = _near(known, batch, ["page_id"])
    mine = {r.b for r in batch.select(_bucket(["page_id"]).alias("b")).collect()}
    read = near.select("page_id", _bucket(["page_id"]).alias(BUCKET)).collect()
    assert {r.page_id for r in batch.limit(10).collect()} <= {r.page_id for r in read}
    assert {r[BUCKET] for r in read} <= mine and len(read) < 4000 * 20 / 256 * 2
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "GreaterThanOrEqual(page_id," in plan
    filters = plan.split("PartitionFilters")[1].split("PushedFilters")[0]
    assert BUCKET in filters
    # What is new comes in, what is known doesn't, and a bucket is one file of a batch.
    spark.range(3990, 4010).select(*page).coalesce(1).write.mode("append").parquet(land)
    ingest_pages(spark, land, out, f"{root}/ckpt", page_record, ["page_id"])
    assert sorted(r.n_new for r in batch_log(spark, out).collect()) == [10, 4000]
    assert spark.read.parquet(out).select("page_id").distinct().count() == 4010
    files = spark.read.parquet(out).select(BATCH, BUCKET, F.input_file_name().alias("file")).distinct()
    assert files.groupBy(BATCH, BUCKET).count().agg(F.max("count")).first()[0] == 1
    assert _near(known, batch.limit(0), ["page_id"]).count() == 0


def test_null_keys_and_no_records(spark):
    """A null key is looked up like any other absent one (never equal, so each batch brings its own); a batch of no records writes nothing."""
    from hestia.streaming.ingest import _near, _written

    root = scratch_dir(spark, "ingest-null")
    rows = spark.createDataFrame([(None, "u", "<title>a</title>"), (1, "u", "<title>b</title>")], "page_id long, url string, html string")
    rows.write.parquet(f"{root}/landed")
    ingest_pages(spark, f"{root}/landed", f"{root}/table", f"{root}/ckpt", page_record, ["page_id"])
    assert spark.read.parquet(f"{root}/table").count() == 2
    known = _written(spark, f"{root}/table", ["page_id"], "another", rows.select("page_id").schema)
    assert {r.page_id for r in _near(known, rows.where("page_id is null"), ["page_id"]).collect()} <= {None}


def test_unreadable_target_is_an_error(spark, sf):
    root = scratch_dir(spark, "ingest-bad")
    read_pages(spark, f"{sf}/pages.parquet").write.parquet(f"{root}/landed")
    spark.range(3).selectExpr("cast(id as string) AS value").write.text(f"{root}/table/{BATCH}=other")
    with pytest.raises(StreamingQueryException):
        ingest_pages(spark, f"{root}/landed", f"{root}/table", f"{root}/ckpt", page_record, ["page_id"])


def test_models_of_each_kind(spark):
    rows = [(float(1000 * s + 5000 * p + i % 7), float(p), float(s), "69001", f"v{i % 3}", "maison" if i % 2 else "appartement", str(i % 4)) for i in range(240) for p, s in [(i % 5 + 1, 20 + i % 60)]]
    fused = spark.createDataFrame(rows + [(None, 1.0, 2.0, "1", "v0", "maison", "0")], "prix double, pieces double, surface double, code_postal string, ville string, type_bien string, etage string")
    grids = {"dt": {"maxDepth": [2, 5]}, "rf": {"maxDepth": [4], "numTrees": [5]}, "gbt": {"maxDepth": [3], "stepSize": [0.1]}}
    m = M.fit_price_models(spark, fused, grids, folds=2, gbt_iter=3, fit_rows=150)
    assert m.scores.count() == 4 and m.comparison.count() == 3 and m.comparison.filter("best").count() == 1
    assert m.dropped.count() == 1 and m.comparison.agg(F.max("r2")).first()[0] > 0.5
    imp = [(r["model"], -r["importance"], r["feature"]) for r in m.importances.collect()]
    assert imp == sorted(imp) and len(imp) == 18
    assert M.max_bins_for(fused) == 256
    cats = {r.feature: r for r in m.categories.collect()}
    assert cats["ville"].labels == 3 and cats["ville"].bins == 4 and cats["ville"].test_rows_in_overflow == 0
    assert [len(M.param_grid(M.make_regressor(k, 256), v)) for k, v in M.FULL_GRIDS.items()] == [3, 4, 4]


def test_split_ignores_partitioning(spark, sf):
    from hestia.sources.tables import load

    part = load(spark, sf, "part")
    a, _ = M.split_by_key(part.repartition(1), ["p_partkey"])
    b, _ = M.split_by_key(part.repartition(7), ["p_partkey"])
    ka = sorted(r[0] for r in a.select("p_partkey").collect())
    kb = sorted(r[0] for r in b.select("p_partkey").collect())
    assert ka == kb and 0.7 < len(ka) / part.count() < 0.9


def test_rare_labels_share_a_bin(spark):
    """Categories are counted over the whole training split; what has no bin of its own is in the last, and counted."""
    rows = [(float(1000 + i), 2.0, 40.0, "69001", f"v{i % 40}" if i % 5 else "big", None if i % 50 == 0 else "maison", str(i % 3)) for i in range(1500)]
    table, _ = M.model_table(spark.createDataFrame(rows, "prix double, pieces double, surface double, code_postal string, ville string, type_bien string, etage string"))
    ready = M.prepare(table, table.columns, folds=3, fit_rows=100, max_bins=9)
    assert ready.train.count() == 100 and {r.fold for r in ready.train.select("fold").distinct().collect()} <= {0, 1, 2}
    cats = {r.feature: r for r in ready.categories.collect()}
    train, test = M.split_by_key(table, table.columns)
    first = [r.ville for r in train.groupBy("ville").count().orderBy(F.desc("count"), "ville").limit(8).collect()]
    assert cats["ville"].bins == 9 and cats["ville"].labels == train.select("ville").distinct().count()
    assert cats["ville"].test_rows_in_overflow == test.filter(~F.col("ville").isin(first)).count() > 0
    assert cats["type_bien"].test_rows_in_overflow == test.filter("type_bien is null").count()
    assert ready.train.schema["features"].metadata["ml_attr"]["attrs"]["nominal"]


def test_search_is_read_back(spark, sf, monkeypatch):
    from hestia.sources.tables import load

    part = load(spark, sf.replace("sf0.001", "sf0.01"), "part").select(
        F.col("p_retailprice").cast("double").alias("prix"), F.col("p_size").cast("double").alias("pieces"), F.col("p_size").cast("double").alias("surface"),
        F.lit("69001").alias("code_postal"), F.col("p_brand").alias("ville"), F.col("p_type").alias("type_bien"), F.col("p_size").cast("string").alias("etage"),
    )
    options = {"grids": {"dt": {"maxDepth": [2]}}, "folds": 2, "fit_rows": 400}
    first = {k: sorted(map(tuple, v.collect()), key=repr) for k, v in M.search_results(spark, part, **options).items()}
    monkeypatch.setattr(M, "fit_price_models", None)
    again = M.search_results(spark, part, **options)
    assert set(first) == set(M.RESULTS) and first == {k: sorted(map(tuple, v.collect()), key=repr) for k, v in again.items()}


def test_ranks_across_ranges(spark):
    """Ranks are those of one sort, whatever the size of a range, with many labels of one frequency."""
    rows = [(f"w{i:03d}",) for i in range(300)] + [("w007",)] * 3 + [("w100",)] * 2 + [(None,)]
    df = spark.createDataFrame(rows, "w string").repartition(5)
    want = {w: float(i) for i, w in enumerate(["w007", "w100", *[f"w{i:03d}" for i in range(300) if i not in (7, 100)]])}
    for size in (7, 100_000):
        assert {r.w: r.w_idx for r in M.category_index_table(spark, df, "w", per_range=size).collect()} == want


def test_registered_search_fits_the_whole_training_split(spark, sf, monkeypatch):
    """The queries over fitted models search on every training row, in the same order each time."""
    from hestia.suite import modelling
    from hestia.suite.pipelines import fused

    class Stop(Exception):
        pass

    def searched(kind, values, train, *options):
        seen.append([repr(r) for r in train.collect()])
        raise Stop

    seen = []
    monkeypatch.setattr(M, "_searched", searched)
    table, _ = M.model_table(fused(spark, sf))
    rows = M.split_by_key(table, table.columns)[0].count()
    for query in (modelling.q_cv_scores, modelling.q_model_residual_hist):
        monkeypatch.setattr(M, "RESULTS", ("not-written",))
        with pytest.raises(Stop):
            query(spark, sf)
    assert rows > 2000 and {len(x) for x in seen} == {rows}
    assert all(x == seen[0] for x in seen)
