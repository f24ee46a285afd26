"""Results do not depend on the number of shuffle partitions."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NAMES = ["clean_feedback", "funnel_report", "seeded_shuffle", "split_exact", "promotion_history",
         "early_stop", "lang_detect", "vocab_build", "ingest_pipeline", "duplicate_flag"]


def rows(spark, name, parts):
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = E.queries()[name](spark, SF)
        return sorted(map(str, (tuple(r) for r in df.collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("name", NAMES)
def test_same_result_with_one_and_seven_partitions(spark, name):
    assert rows(spark, name, 1) == rows(spark, name, 7)
