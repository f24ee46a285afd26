"""D5 stored profile: arrays against the join, one build per training set, edges."""

import numpy as np
from pyspark.sql import functions as F

from scoreloop.operators import lang as L
from scoreloop.operators import langprofile as LP

TEXTS = [(1, "The quick brown fox jumps", "en"), (2, "Der schnelle braune Fuchs springt", "de"), (3, "le renard brun saute \U0001F98A\U0001F98A\U0001F98A", "fr"),
         (4, None, "en"), (5, "", "de"), (6, "ab", "en"), (7, "ÉTÉ İSTANBUL ΣΑΣ", "fr"), (8, "the the the der der", None), (9, "x" * 5000, "en")]


def docs(spark):
    return spark.createDataFrame(TEXTS, "doc_id long, text string, lang string").withColumns({"gram": F.lit("x"), "n": F.lit(1)}).repartition(3)


def test_arrays_equal_the_join(spark, monkeypatch):
    monkeypatch.setattr(LP, "STEP", 20)
    d = docs(spark)
    wide, langs = L.train_profile(d)
    want = {r.doc_id: r.detected_lang for r in L.with_language(d, wide, langs, key="doc_id").collect()}
    counts = {(r.lang, r.gram): r.n for r in L.profile_counts(d).collect()}
    assert {(r.lang, r.gram): r.n for r in LP.gram_counts(d).collect()} == counts
    profile = LP.Profile.load(LP.profile_arrays(LP.gram_counts(d)))
    assert profile.langs == langs
    got = L.with_language(d, profile, langs, key="doc_id", prepared=True, unique_keys=True).collect()
    assert {r.doc_id: r.detected_lang for r in got} == want and len(got) == len(TEXTS)
    logp = {(r.lang, r.gram): r.logp for r in L.profile_logp(L.profile_counts(d)).collect()}
    for k, lang in enumerate(profile.langs):
        for code, row in zip(profile.codes.tolist(), profile.logp):
            if (lang, LP.gram_of(code)) in logp:
                assert abs(logp[lang, LP.gram_of(code)] - row[k]) < 1e-12


def test_profile_is_built_once_and_follows_its_rows(spark, tmp_dir, monkeypatch):
    d = docs(spark)
    built = []
    real = LP.gram_counts
    monkeypatch.setattr(LP, "gram_counts", lambda *a: built.append(1) or real(*a))
    first = L.stored(d, tmp_dir)[0]
    again = L.stored(d.orderBy(F.desc("doc_id")), tmp_dir)[0]
    assert len(built) == 1 and np.array_equal(first.logp, again.logp)
    L.stored(d.filter("doc_id <> 2"), tmp_dir)
    assert len(built) == 2


def test_beyond_the_bound_the_join_is_used(spark, tmp_dir, monkeypatch):
    d = docs(spark)
    assert LP.Profile.load(LP.stored_profile(d, tmp_dir), max_rows=3) is None
    want = {r.doc_id: r.detected_lang for r in L.with_language(d, *L.stored(d, tmp_dir), key="doc_id", prepared=True).collect()}
    monkeypatch.setattr(LP.Profile, "load", classmethod(lambda *a, **k: None))
    profile, langs = L.stored(d, tmp_dir)
    assert {r.doc_id: r.detected_lang for r in L.with_language(d, profile, langs, key="doc_id", prepared=True).collect()} == want


def test_no_training_rows(spark, tmp_dir):
    profile, langs = L.stored(docs(spark).limit(0), tmp_dir)
    assert langs == [] and {r.detected_lang for r in L.detect(docs(spark), profile, langs, key="doc_id").collect()} == {None}


def test_codes_round_trip():
    for g in ("abc", "é☃\U0001F98A", "   ", "\x00\x01\x02"):
        assert LP.gram_of(LP.code_of(g)) == g
        row, code = LP.gram_codes([None, "", "ab", g, g + "z"])
        assert row.tolist() == [3, 4, 4] and LP.gram_of(int(code[0])) == g


def test_long_texts_are_looked_at_in_parts(spark, monkeypatch):
    texts = ["der " * 300 + "the", None, "the " * 40, "", "ab", "der"] * 3
    d = spark.createDataFrame([(i, t, ("de", "en")[i % 2]) for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    want = {(r.lang, r.gram): r.n for r in L.profile_counts(d).collect()}
    whole = LP.Profile.load(LP.profile_arrays(LP.gram_counts(d)))
    found = whole.languages_of(texts, len(texts))
    seen, real = [], LP.gram_codes
    monkeypatch.setattr(LP, "STEP", 50)
    monkeypatch.setattr(LP, "gram_codes", lambda x: seen.append(sum(map(len, x))) or real(x))
    assert whole.languages_of(iter(texts), len(texts)) == found and found[1] is None
    assert len(seen) > 60 and max(seen) <= 2 * 52  # a text of 1,203 characters is never in memory as arrays at once
    monkeypatch.setattr(LP, "gram_codes", real)
    monkeypatch.setattr(LP, "HELD", 5)
    assert {(r.lang, r.gram): r.n for r in LP.gram_counts(d).collect()} == want
