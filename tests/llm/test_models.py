"""Classifier, language, language-model and tokenizer operators, and the pipeline."""

import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import tiktoken
from pyspark.sql import functions as F

from scoreloop.llm import bpe, crf, grulm, langid
from scoreloop.llm.common import read
from scoreloop.llm.queries import QUERIES, public_vocabulary

from . import edge
from .test_dedup import brute_fingerprint, brute_repeats, components

SF = "/root/testdata/sf0.01"


def write_docs(spark, tmp_dir, data, labels=()):
    edge.docs(spark, data).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    return tmp_dir


def test_language_held_out_accuracy(spark):
    got = QUERIES["op9_language_hierarchy"](spark, SF).join(read(spark, SF, "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in got)
    assert len(held) > 200 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97


def test_language_edges(spark, tmp_dir):
    got = QUERIES["op9_language_hierarchy"](spark, write_docs(spark, tmp_dir, edge.rows())).collect()
    assert len(got) == len(edge.rows())
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (100, 101, 102, 103))
    assert by[104].lang_pred in ("en", "de")
    none = langid.predict(edge.docs(spark), langid.fit(edge.empty(spark)), ["doc_id"]).collect()
    assert {r.lang_pred for r in none} == {"und"}
    assert langid.predict(edge.empty(spark), None, ["doc_id"]).count() == 0
    one = langid.fit(edge.docs(spark).filter("lang = 'de'"))
    assert {r.lang_pred for r in langid.predict(edge.docs(spark), one, ["doc_id"]).collect()} == {"de", "und"}


def test_every_language_is_learned(spark):
    rnd = random.Random(3)
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 600)]
    rows = [(10 * k + j, " ".join("".join(rnd.choice(letters[2 * k:2 * k + 2]) for _ in range(6)) for _ in range(20)), f"q{k:03d}")
            for k in range(220) for j in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit(df, max_sample=1000)  # fewer texts than five a language: classes are not bounded
    assert sum(map(len, model.families.values())) == 220


def test_one_versus_one_against_plain_votes():
    rng = np.random.default_rng(5)
    langs = ["de", "en", "nl", "es", "fr", "xx"]
    base = {lang: rng.random(langid.DIM) for lang in langs}
    x = np.array([base[lang] + rng.normal(0, 0.5, langid.DIM) for lang in langs for _ in range(20)], np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = [lang for lang in langs for _ in range(20)]
    model = langid.Hierarchy(x, y)

    def winner(v, labels, name):  # counts the votes of every pair, one row at a time
        votes = {k: 0.0 for k in range(len(labels))}
        for i, j, c in model.machines[name]:
            m = float(v.astype(np.float64) @ model.weights[:, c].astype(np.float64))
            votes[i if m > 0 else j] += 1
            votes[i] += np.tanh(m) / (10 * len(labels))
            votes[j] -= np.tanh(m) / (10 * len(labels))
        return labels[max(votes, key=lambda k: (votes[k], -k))]

    want = []
    for v in x:
        family = winner(v, list(model.families), "")
        want.append(winner(v, model.families[family], family))
    assert model.predict(x)[0].tolist() == want


def test_svm_against_a_slow_solver():
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(0.4, 1, (25, 8)), rng.normal(-0.4, 1, (35, 8))])
    y = np.array([1.0] * 25 + [-1.0] * 35)
    cost = np.where(y > 0, 10 * 60 / 50, 10 * 60 / 70)

    def loss(w):
        return 0.5 * w @ w + cost @ np.maximum(0, 1 - y * (x @ w))

    w = np.zeros(8)
    best = loss(w)
    for k in range(1, 20001):  # subgradient steps
        w = w - 1 / (k + 10) * (w - ((cost * y * (y * (x @ w) < 1)) @ x))
        best = min(best, loss(w))
    mine = loss(langid.fit_svm(x, y, epochs=300).astype(np.float64))
    assert mine <= best * 1.01


def test_family_comes_first():
    rng = np.random.default_rng(0)
    base = {lang: rng.random(langid.DIM) for lang in ("en", "de", "fr", "es", "xx")}
    x = np.array([base[lang] + rng.normal(0, 0.3, langid.DIM) for lang in base for _ in range(30)], np.float32)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    langs = [lang for lang in base for _ in range(30)]
    model = langid.Hierarchy(x, langs)
    assert model.families == {"germanic": ["de", "en"], "romance": ["es", "fr"], "xx": ["xx"]}
    assert (model.predict(x)[0] == np.array(langs)).mean() > 0.98


def test_quality_held_out_accuracy(spark):
    got = QUERIES["op1_quality_crf"](spark, SF).join(read(spark, SF, "labels"), "doc_id").filter("held_out").collect()
    assert len(got) > 50 and sum(r.quality == r.predicted for r in got) / len(got) > 0.95
    assert all(r.predicted == (r.score >= 0.3) for r in got)


def test_quality_edges(spark, tmp_dir):
    labels = [(i, int(i % 3 > 0), 0) for i in range(40)] + [(None, 1, 0), (3, None, None), (9999, 1, 0)]
    got = QUERIES["op1_quality_crf"](spark, write_docs(spark, tmp_dir, edge.rows(), labels)).collect()
    assert len(got) == len(edge.rows()) and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in crf.score(edge.docs(spark, clash=True), None, ["doc_id"]).collect()} == {0.5}
    assert crf.score(edge.empty(spark), None, ["doc_id"]).count() == 0
    assert crf.fit(edge.empty(spark), spark.createDataFrame([], "doc_id long, label int")) is None


def test_quality_learns_from_long_documents(spark):
    good = "\n".join("A plain sentence about the weather, and another one." for _ in range(300))
    data = [(i, good if i % 2 else "click here >>> $$$ !!!\n" * 300, "en", "a", 0) for i in range(20)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, label int")
    model = crf.fit(edge.docs(spark, data), labels)
    got = {r.doc_id: r.score for r in crf.score(edge.docs(spark, data), model, ["doc_id"]).collect()}
    assert min(got[i] for i in range(1, 20, 2)) > 0.5 > max(got[i] for i in range(0, 20, 2))
    assert crf.fit(edge.docs(spark, data).filter("doc_id % 2 = 1"), labels) is None


def test_forward_backward_matches_enumeration():
    rng = np.random.default_rng(3)
    e, trans = rng.normal(size=(1, 5)), rng.normal(size=(2, 2))
    p, pairs = crf.forward_backward(e, np.array([5]), trans)
    weight, total, want, moves = 0.0, 0.0, np.zeros(5), np.zeros((2, 2))
    for path in np.ndindex(*[2] * 5):
        weight = math.exp(sum(e[0, k] * y for k, y in enumerate(path)) + sum(trans[a, b] for a, b in zip(path, path[1:])))
        total += weight
        want += weight * np.array(path)
        for a, b in zip(path, path[1:]):
            moves[a, b] += weight
    assert np.allclose(p[0], want / total) and np.allclose(pairs[0], moves / total)


def test_unigram_scores_are_exact(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(grulm, "BLOCK_TYPES", 300)  # several blocks
    data = edge.rows(n=60)
    got = QUERIES["op10_gru_lm"](spark, write_docs(spark, tmp_dir, data)).collect()
    tokens = lambda t: (t or "").encode().lower().split() + [b"</s> "]
    learnt = [r for r in data if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 != 2]
    c = Counter(w for r in learnt for w in tokens(r[1]))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for r in data:
        ws = tokens(r[1])
        want[r[0], len(ws), sum(w in c for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)] += 1
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 and math.isfinite(r.score) for r in got)
    empty = grulm.score_documents(edge.empty(spark).withColumn("train", F.lit(True)))
    assert empty.count() == 0
    untrained = grulm.score_documents(edge.docs(spark, data[:3]).withColumn("train", F.lit(False))).collect()
    assert all(r.score == r.base_score and r.train_tokens == 0 for r in untrained)


def test_gru_gradient_and_window_carry(monkeypatch):
    rng = np.random.default_rng(0)
    size = sum(int(np.prod(s)) for _, s in grulm.Gru.SHAPES)
    net = grulm.Gru(rng.normal(0, 0.3, size))
    inputs, targets = rng.integers(0, grulm.CODES, (6, 4)), rng.integers(0, grulm.CODES, (6, 4))
    inputs[3, 1] = 0
    h = rng.normal(0, 0.5, (4, grulm.HIDDEN))
    g, _, _ = net.gradient(inputs, targets, h)
    for i in np.argsort(-abs(g))[:25]:
        d = np.zeros(size)
        d[i] = 1e-5
        slope = (grulm.Gru(net.theta + d).gradient(inputs, targets, h)[2] - grulm.Gru(net.theta - d).gradient(inputs, targets, h)[2]) / 2e-5
        assert abs(slope - g[i]) < 1e-8
    docs = [rng.integers(0, grulm.CODES, n) for n in (1, 5, 32, 33, 100, 257)]
    for doc, s in zip(docs, net.score(docs)):  # one token after the other, state never dropped
        state, last, total = np.zeros((1, grulm.HIDDEN)), 0, 0.0
        for code in doc:
            state = net.step(net.x[[last]], state)[0]
            total += net.losses(state, np.array([code]))[0][0]
            last = code
        assert abs(total / math.log(10) - s) < 1e-8


def test_gru_distribution_sums_to_one():
    rng = np.random.default_rng(1)
    net = grulm.Gru(rng.normal(0, 0.3, sum(int(np.prod(s)) for _, s in grulm.Gru.SHAPES)))
    h = np.repeat(rng.normal(size=(1, grulm.HIDDEN)), grulm.CODES, axis=0)
    assert abs(np.exp(net.losses(h, np.arange(grulm.CODES))[0]).sum() - 1) < 1e-9


def test_gru_learns(spark):
    got = QUERIES["op10_gru_lm"](spark, SF).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]  # better than unigrams on held-out documents


def test_gru_trains_on_every_document_of_a_block(spark):
    rows = [(1, "a b " * 60_000, True), (2, "x y " * 10_000, True), (3, "x y " * 200, False)]
    got = grulm.score_documents(spark.createDataFrame(rows, "doc_id long, text string, train boolean").coalesce(1)).collect()
    held = next(r for r in got if r.doc_id == 3)
    assert held.score > 0.5 * held.base_score  # "x y" comes only in the second document
    rng = np.random.default_rng(2)
    net = grulm.Gru(rng.normal(0, 0.1, sum(int(np.prod(s)) for _, s in grulm.Gru.SHAPES)))
    for n in (0, 1, 31, 32, 33, 255, 256, 257, 5000):
        assert net.fit(rng.integers(0, grulm.CODES, n + 1)) == n


@pytest.mark.parametrize("buckets", [1, 4, 64, 200, 1000])
def test_gru_head_does_not_depend_on_partitions(spark, buckets):
    words = [f"w{i}" for i in range(30_000)]
    rows = [(k, " ".join(words[k % 7::7]) + " " + " ".join(words[:4000]), True) for k in range(14)]
    packed = grulm.pack(spark.createDataFrame(rows, "doc_id long, text string, train boolean"), buckets)
    corpus = grulm.Corpus(grulm.answer(packed.coalesce(1), buckets))
    first = {grulm.END} | {w.encode() for w in words[:4000]}  # these come most often
    import xxhash

    assert corpus.types == 30_001 and len(corpus.head) == corpus.size == grulm.vocabulary(30_001)
    assert set(corpus.head.tolist()) <= {xxhash.xxh64_intdigest(w) for w in first}


def test_gru_vocabulary_grows_with_the_corpus(spark):
    common = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(common * 20 + [f"once{i}" for i in range(2000)]), True)]
    packed = grulm.pack(spark.createDataFrame(rows, "doc_id long, text string, train boolean"), 4).cache()
    answers = grulm.answer(packed, 4).cache()
    corpus = grulm.Corpus(answers)
    assert corpus.types == 2401 and corpus.size >= 16 * 49 and len(corpus.head) == corpus.size
    row = grulm.encode(packed, answers, corpus).first()
    codes = grulm.expand(row["codes"], grulm.code_type(corpus.size))
    assert set(codes[:8000].tolist()) <= set(range(corpus.size)) and len(set(codes[:400].tolist())) == 400
    assert grulm.vocabulary(10**8) > 9 * grulm.vocabulary(10**6)
    net = grulm.Gru.start(corpus)
    rng = np.random.default_rng(4)
    h = rng.normal(size=(1, grulm.HIDDEN)).repeat(corpus.size + grulm.BINS + 1, axis=0)
    logp = [net.losses(k * h, np.arange(len(h)))[0] for k in (1, -1)]
    assert all(abs(np.exp(x).sum() - 1) < 1e-9 for x in logp)
    one_class = slice(300 // net.per_class * net.per_class, 300 // net.per_class * net.per_class + 5)
    assert np.ptp((logp[0] - logp[1])[one_class]) > 1e-3  # the state tells words of one class apart
    inputs, targets = rng.integers(0, len(h), (6, 4)), rng.integers(0, len(h), (6, 4))
    state = rng.normal(0, 0.5, (4, grulm.HIDDEN))
    g = net.gradient(inputs, targets, state)[0]
    for i in np.argsort(-abs(g))[:10]:
        d = np.zeros(len(g))
        d[i] = 1e-5
        slope = [grulm.Gru(net.theta + x, net.head).gradient(inputs, targets, state)[2] for x in (d, -d)]
        assert abs((slope[0] - slope[1]) / 2e-5 - g[i]) < 1e-8


def test_gru_works_in_pieces_of_bounded_size(monkeypatch):
    import tracemalloc

    head = grulm.vocabulary(3_400_000)
    rng = np.random.default_rng(8)
    net = grulm.Gru(rng.normal(0, 0.1, sum(int(np.prod(s)) for _, s in grulm.Gru.shapes(head))).astype(np.float32), head)
    codes = np.minimum(rng.zipf(1.2, (33, 256)) - 1, head + grulm.BINS)  # one class with most tokens, many with a few
    h = np.zeros((256, grulm.HIDDEN), np.float32)
    tracemalloc.start()
    net.parts(codes[:-1], codes[1:], h)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20e6
    net = grulm.Gru(net.theta.astype(np.float64), head)
    g, state, loss = net.gradient(codes[:-1], codes[1:], h.astype(np.float64))
    monkeypatch.setattr(grulm, "CACHED", 1 << 40)
    whole = net.gradient(codes[:-1], codes[1:], h.astype(np.float64))
    assert np.abs(whole[0] - g).max() < 1e-12 and np.abs(whole[1] - state).max() < 1e-12 and abs(whole[2] - loss) < 1e-12


def test_gru_learns_from_a_window_without_head_words():
    rng = np.random.default_rng(9)
    net = grulm.Gru(rng.normal(0, 0.1, sum(int(np.prod(s)) for _, s in grulm.Gru.SHAPES)))
    assert net.fit(np.full(40, grulm.CODES - 1)) == 39 and np.isfinite(net.theta).all()


def encoding():
    raw, pattern = public_vocabulary()
    return raw, pattern, tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.load_ranks(raw), special_tokens={})


def test_bpe_equals_tiktoken(monkeypatch):
    raw, pattern, enc = encoding()
    rnd = random.Random(1)
    bits = ["a", "b", "the", " ", "  ", "\n", "\t", "\x1c", "\x85", "\xa0", "　", "​", "é", "中", "😀", "'s", "'ll", "1", "½", "Ⅷ",
            "<|endoftext|>", ".", "!!", "\r\n", "́", "_", "ß"]
    texts = ["", "  ", " a", "a ", "a\n b", "x" * 1000, "ab" * 400 + "c", "the" * 90]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 40))) for _ in range(600)]
    want = [np.array(enc.encode_ordinary(t), "<u4").tobytes() for t in texts]
    assert bpe.Encoder(raw, pattern).encode(texts) == want
    monkeypatch.setattr(bpe, "LONG", 3)  # the heap gives what the recursive query gives
    assert bpe.Encoder(raw, pattern).encode(texts) == want
    monkeypatch.setattr(bpe, "LONG", 5000)
    monkeypatch.setattr(bpe, "ROWS", 50)
    assert bpe.Encoder(raw, pattern).encode(texts[6:200]) == want[6:200]


def test_bpe_query_edges(spark, tmp_dir):
    _, _, enc = encoding()
    import hashlib

    got = QUERIES["op7_bpe_duckdb"](spark, write_docs(spark, tmp_dir, edge.rows())).collect()
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = Counter()
    for r in edge.rows():
        ids = np.array(enc.encode_ordinary(r[1] or ""), "<u4")
        want[r[0], len(ids), sha(ids.tobytes()), sha((r[1] or "").encode())] += 1
    assert Counter(tuple(r) for r in got) == want


def test_pipeline_stages(spark, tmp_dir):
    import corpus_pipeline as P

    assert [n for n, _ in P.STAGES] == ["language_id", "simhash_near_dedup", "suffix_dedup", "mix_sources", "bpe_encode"]
    docs = edge.docs(spark, clash=True)
    step = {}
    for name, stage in P.STAGES:
        stage(spark, docs, tmp_dir).write.parquet(f"{tmp_dir}/{name}")
        out = spark.read.parquet(f"{tmp_dir}/{name}")
        if name != "bpe_encode":
            assert out.columns == docs.columns
        step[name] = (docs.collect(), out.collect())
        docs = out
    before, after = step["language_id"]
    key = lambda rs: Counter((r.doc_id, r.text, r.n_chars, r.score) for r in rs)
    assert key(after) == key(r for r in before if r.text and any(c.isalpha() for c in r.text))
    before, after = step["simhash_near_dedup"]
    fps = [brute_fingerprint(r.text) for r in before]
    comp = components(len(fps), lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 3)
    low = {c: min((before[i].doc_id is None, before[i].doc_id) for i in range(len(fps)) if comp[i] == c) for c in set(comp)}
    assert Counter(r.doc_id for r in after) == Counter(i for _, i in low.values())
    before, after = step["suffix_dedup"]
    left = {r.doc_id: r for r in after}
    for r, (n, gone, _, sha) in zip(before, brute_repeats([r.text.encode() for r in before], 400)):
        new = left[r.doc_id]
        assert (new.text == r.text) if not gone else len(new.text.encode()) <= n - gone + 4 and new.n_chars == len(new.text)
    before, after = step["mix_sources"]
    words = lambda rs: sum(len(r.text.split()) for r in rs)
    assert abs(words(after) - words(before)) <= 100
    sizes = {r.doc_id: len(r.text.split()) for r in before}
    per = Counter()
    for r in after:
        per[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert all(n <= 3 * sizes[d] for d, n in per.items())
    before, after = step["bpe_encode"]
    _, _, enc = encoding()
    assert Counter((r.text, bytes(r.ids)) for r in after) == Counter((r.text, np.array(enc.encode_ordinary(r.text), "<u4").tobytes()) for r in before)
    assert all(r.round_trip for r in after)


def test_pipeline_language_score_decides(spark, tmp_dir):
    import corpus_pipeline as P

    noise = ["x 12345 !!! ### 999 @@ ;; $$", "0x9f 77 == 88 %% 12 zq 99 ##", "~~~~ 1q ----", "qzxv kjwq zzxq vvkq jxqz wqkz", "|||| 4 || b || 5 |||"]
    docs = read(spark, SF, "documents")
    bad = spark.createDataFrame([(10**6 + i, t, None) for i, t in enumerate(noise)], "doc_id long, text string, lang string")
    out = P.language_id(spark, docs.unionByName(bad, allowMissingColumns=True), tmp_dir).select("doc_id").collect()
    ids = {r.doc_id for r in out}
    assert not any(i >= 10**6 for i in ids)
    assert ids == {r.doc_id for r in docs.select("doc_id", "text").collect() if langid.has_letter(r.text)}


def test_pipeline_on_an_empty_table(spark, tmp_dir):
    import corpus_pipeline as P

    edge.empty(spark).write.parquet(f"{tmp_dir}/documents.parquet")
    assert P.run(spark, tmp_dir).count() == 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_takes_an_empty_table(spark, tmp_dir, name):
    edge.empty(spark).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_dir}/embeddings.parquet")
    assert QUERIES[name](spark, tmp_dir).count() == 0
