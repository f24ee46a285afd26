"""Language detection, tokens, encoding, vocabulary, linear scores."""

from pyspark.sql import functions as F

from scoreloop.functions import tokens as TK
from scoreloop.operators import lang as L
from scoreloop.operators import vocab as VO

DOCS = "/root/testdata/sf0.001/documents.parquet"


def test_trigrams_are_code_points(spark):
    df = spark.createDataFrame([("AÉ😀bc",), ("ab",), (None,)], "text string")
    got = [r[0] for r in df.select(TK.char_trigrams("text")).collect()]
    assert got == [["aé😀", "é😀b", "😀bc"], [], None]


def test_detect_held_out_and_failures(spark):
    docs = spark.read.parquet(DOCS)
    train = docs.filter(F.col("doc_id") % 2 == 0)   # a hash-free even/odd split of the fixture
    test = docs.filter(F.col("doc_id") % 2 == 1)
    prof, langs = L.train_profile(train)
    det = L.with_language(test.select("doc_id", "text", "lang"), prof, langs, key="doc_id")
    rows = det.filter(F.length("text").between(5, 1000)).collect()
    acc = sum(r["lang"] == r["detected_lang"] for r in rows) / len(rows)
    assert acc > 0.9
    short = spark.createDataFrame([(1, "ab"), (2, "")], "doc_id long, text string")
    got = L.with_language(short, prof, langs, key="doc_id").withColumn("reason", L.language_reason()).collect()
    assert {r["reason"] for r in got} == {"detection failed"}


def test_detect_is_repeatable(spark):
    docs = spark.read.parquet(DOCS)
    prof, langs = L.train_profile(docs)
    a = {r["doc_id"]: r["detected_lang"] for r in L.detect(docs, prof, langs, key="doc_id").collect()}
    b = {r["doc_id"]: r["detected_lang"] for r in L.detect(docs.repartition(3), prof, langs, key="doc_id").collect()}
    assert a == b


def test_token_length_and_truncation(spark):
    df = spark.createDataFrame([("Hello, world 42!",)], "text string")
    r = df.select(TK.tokens("text").alias("t"), TK.token_length("text").alias("n"),
                  TK.truncated_length("text", 4).alias("k")).first()
    assert r["t"] == ["Hello", ",", " world", " 42", "!"] and r["n"] == 7 and r["k"] == len("Hello,")


def test_encode_fixed_shape_and_marks(spark):
    docs = spark.createDataFrame([(1, "a b a " * 400), (2, "")], "doc_id long, text string")
    vocab = VO.vocab_build(docs)
    enc = {r["doc_id"]: r for r in VO.encode_fixed(docs, vocab, key="doc_id").collect()}
    ids, mask = enc[1]["input_ids"], enc[1]["attention_mask"]
    assert len(ids) == 512 and ids[0] == 0 and ids[-1] == 2 and sum(mask) == 512
    e = enc[2]
    assert e["input_ids"][:3] == [0, 2, 1] and sum(e["attention_mask"]) == 2
    assert sorted(r["token_id"] for r in vocab.collect())[0] == 4


def test_score_linear_in_unit_interval(spark):
    docs = spark.read.parquet(DOCS)
    lab = docs.join(spark.read.parquet("/root/testdata/sf0.001/labels.parquet"), "doc_id")
    s = VO.score_linear(docs, VO.token_weights(lab), key="doc_id")
    r = s.agg(F.min("score"), F.max("score"), F.count("*")).first()
    assert 0 < r[0] <= r[1] < 1 and r[2] == docs.count()


def test_score_linear_beyond_the_bound_moves_only_rare_tokens(spark, monkeypatch):
    import dataclasses

    from scoreloop.operators import sizing as SZ

    data = [(1, "aa bb aa cc", 1), (2, "aa dd", 1), (3, "bb bb aa", 0), (4, "ee aa zz zz", 0), (4, "aa dd", 1), (5, None, 1), (6, "", 0), (None, "aa cc qq", 0)]
    docs = spark.createDataFrame(data, "doc_id long, text string, quality int")
    w = VO.token_weights(docs.filter("doc_id < 4"))
    rows = lambda: sorted((r.doc_id or 0, round(r.score, 9)) for r in VO.score_linear(docs, w, key="doc_id").collect())
    want = rows()
    assert len(want) == 7 and VO.prepare_weights(w)[1] is None  # a row a key
    for most in (0, 1, 4):
        monkeypatch.setattr(SZ, "SIZING", dataclasses.replace(SZ.SIZING, max_broadcast_rows=most))
        often, seldom = VO.prepare_weights(w)
        assert often.count() <= most and often.count() + seldom.count() == w.count() and rows() == want
    assert 0 < often.count() and often.agg(F.min("n")).first()[0] > seldom.agg(F.max("n")).first()[0]


def test_score_linear_shuffles_a_row_a_text(spark):
    docs = spark.read.parquet(DOCS)
    w = VO.prepare_weights(VO.token_weights(docs.withColumn("quality", F.lit(1))))
    plan = VO.score_linear(docs, w, key="doc_id", prepared=True)._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("Exchange hashpartitioning(")[1].split(")")[0] for line in plan.splitlines() if "Exchange hashpartitioning(" in line]
    assert keys and all("token" not in k for k in keys)  # no token travels
