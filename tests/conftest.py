import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from scoreloop.session import get_session

    s = get_session("local[4]", app="scoreloop-tests", shuffle_partitions=4,
                    extra={"spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="scoreloop-test-ckpt-"))
    yield s


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="scoreloop-test-")


FB_SCHEMA = ("id long, text string, text_hash string, model_score double, user_feedback string, "
             "model_version string, event_timestamp timestamp_ntz, target_score double, lang string")


def feedback(spark, rows):
    """rows: (id, text, score, feedback, ts-string-or-None[, target][, lang])"""
    import datetime as dt
    out = []
    for r in rows:
        rid, text, score, fb, ts = r[:5]
        target = r[5] if len(r) > 5 else {"human": 0.0, "human_edited_ai": 0.5, "ai": 1.0}.get(fb)
        lang = r[6] if len(r) > 6 else "en"
        tsv = dt.datetime.fromisoformat(ts) if ts else None
        out.append((rid, text, None, score, fb, "m1", tsv, target, lang))
    from pyspark.sql import functions as F
    df = spark.createDataFrame(out, FB_SCHEMA)
    return df.withColumn("text_hash", F.sha2("text", 256))
