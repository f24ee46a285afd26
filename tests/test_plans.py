"""Plan properties of every registered query: no cross joins, no
row-at-a-time Python UDFs; lookups broadcast only after their size check."""

import __spark_entry__ as E
from scoreloop.plans.registry import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "RoundRobin")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins_or_row_udfs(spark):
    bad = {}
    for name, fn in sorted(QUERIES.items()):
        p = plan(fn(spark, SF))
        hits = [k for k in FORBIDDEN if k in p]
        if hits:
            bad[name] = hits
    assert bad == {}


def test_detection_joins_profile_map_side(spark):
    from scoreloop.operators import lang as L
    from scoreloop.sources.tables import table

    docs = table(spark, SF, "documents").select("doc_id", "text", "lang")
    wide, langs = L.train_profile(docs)  # the form for profiles beyond the bound of the arrays
    p = plan(L.with_language(docs.select("doc_id", "text"), L.prepare_profile(wide), langs, key="doc_id", prepared=True, unique_keys=True))
    assert "Generate" in p and "BroadcastHashJoin" in p


def test_detection_by_arrays_moves_nothing(spark):
    p = plan(E.queries()["lang_detect"](spark, SF))
    assert "MapInArrow" in p and "Exchange" not in p and "Join" not in p


def test_oversized_lookup_is_not_broadcast(spark):
    from pyspark.sql import functions as F

    from scoreloop.operators.sizing import bounded_lookup

    small = spark.range(10).withColumn("v", F.col("id") * 2)
    assert "ResolvedHint" in bounded_lookup(small, max_rows=100)._jdf.queryExecution().analyzed().toString() \
        or "broadcast" in bounded_lookup(small, max_rows=100)._jdf.queryExecution().logical().toString().lower()
    big = bounded_lookup(small, max_rows=5)
    assert "broadcast" not in big._jdf.queryExecution().logical().toString().lower()
