"""Plan shape checks through the public ``explain`` output."""

import contextlib
import io

from pyspark.sql import functions as F

from __spark_entry__ import queries
from hestia.operators import ranking as O
from hestia.sources.tables import listing_view, load


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_topk_per_group_limits_before_shuffle(spark, sf):
    v = listing_view(spark, sf)
    p = plan(O.top_k_per(v, ["type_bien"], [("prix", "desc"), ("lien", "asc")], 10))
    assert "WindowGroupLimit" in p


def test_filter_and_columns_reach_the_scan(spark, sf):
    o = load(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")
    p = plan(o)
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in p
    assert "ReadSchema: struct<o_custkey:bigint,o_orderpriority:string>" in p


def test_fact_table_is_not_broadcast(spark, sf):
    p = plan(listing_view(spark, sf))
    # Every broadcast exchange reads a dimension (supplier/nation/documents), never lineitem.
    for block in p.split("BroadcastExchange")[1:]:
        head = block.split("\n\n")[0]
        assert "lineitem" not in head.split("Input")[0]


def test_global_topk_is_take_ordered(spark, sf):
    p = plan(queries()["topk"](spark, sf))
    assert "TakeOrderedAndProject" in p


def test_aggregates_are_partial(spark, sf):
    p = plan(queries()["word_count"](spark, sf))
    assert "HashAggregate" in p and "partial_count" in p
