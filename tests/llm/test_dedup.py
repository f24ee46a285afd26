"""Near-duplicate and repeated-substring operators against brute force, with edge rows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from scoreloop.llm import ego, simhash, suffix

from . import edge


def components(n, linked):
    top = list(range(n))

    def root(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = root(i), root(j)
                top[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_simhash_against_brute_force(spark):
    rnd = random.Random(6)
    data = edge.rows(seed=3)
    for k, r in enumerate(list(data[:25])):  # near copies
        words = (r[1] or "").split()
        if len(words) > 40:
            words[rnd.randrange(len(words))] = "changed"
            data.append((200 + k, "  ".join(words).upper() if k % 2 else "\n".join(words), *r[2:]))
    got = Counter((r.doc_id, r.fp, r.component_id) for r in simhash.near_duplicates(edge.docs(spark, data, clash=True).drop("fp")).collect())
    fps = [brute_fingerprint(r[1]) for r in data]
    comp = components(len(data), lambda i, j: bin(fps[i] ^ fps[j]).count("1") <= 3)
    low = {c: min((data[i][0] for i in range(len(data)) if comp[i] == c and data[i][0] is not None), default=None) for c in set(comp)}
    signed = lambda f: f - (1 << 64) if f >> 63 else f
    assert got == Counter((r[0], signed(f), low[c]) for r, f, c in zip(data, fps, comp))
    assert simhash.near_duplicates(edge.empty(spark)).count() == 0


@pytest.mark.parametrize("node_rows", [1 << 18, 100])
def test_gray_index_finds_every_link(spark, node_rows):
    rng = np.random.default_rng(7)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    near = base.copy()
    for _ in range(3):
        near ^= np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64)
    same16 = rng.integers(0, 1 << 48, 200, dtype=np.uint64) | np.uint64(0xAB << 56)  # a crowded upper node
    codes = np.unique(np.concatenate([base, near, same16]))
    fps = spark.createDataFrame([(int(c),) for c in codes.view(np.int64)], "fp long")
    got = {r.fp: r.group for r in simhash.groups(fps, 3, node_rows).collect()}
    comp = components(len(codes), lambda i, j: int(codes[i] ^ codes[j]).bit_count() <= 3)
    by = {}
    for c, k in zip(codes.view(np.int64).tolist(), comp):
        by.setdefault(k, set()).add(got[c])
    assert all(len(v) == 1 for v in by.values()) and len({min(v) for v in by.values()}) == len(by)


def test_gray_rank_sorts_by_gray_code():
    codes = np.array([i ^ (i >> 1) for i in range(1000)], np.uint64)
    assert (simhash.gray_rank(codes) == np.arange(1000)).all()


def brute_vectors(vecs, c=0.9):
    ok = [v is not None and len(v) == 5 and all(x is not None and np.isfinite(x) for x in v) and any(v) for v in vecs]
    unit = [np.array(v, float) / np.linalg.norm(v) if o else None for v, o in zip(vecs, ok)]
    near = lambda i, j: ok[i] and ok[j] and float(unit[i] @ unit[j]) >= c
    return components(len(vecs), near), [sum(near(i, j) for j in range(len(vecs)) if j != i) for i in range(len(vecs))]


@pytest.mark.parametrize("leaf,block", [(512, 2048), (4, 16)])
def test_ego_join_against_brute_force(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(ego, "LEAF", leaf)
    rng = np.random.default_rng(8)
    vecs = [rng.normal(size=5).astype(np.float32).tolist() for _ in range(120)]
    vecs += [(np.array(v) + rng.normal(0, 0.15, 5)).astype(np.float32).tolist() for v in vecs[:50]]
    vecs += [vecs[0]] * 20 + [(2 * np.array(vecs[1])).tolist(), [0.0] * 5, [-0.0, 0.0, 0.0, 0.0, 0.0], None, [1.0, None, 0.0, 0.0, 0.0],
                              [float("nan")] * 5, [float("inf"), 0.0, 0.0, 0.0, 0.0], [], [1.0, 0.0, 0.0, 0.0, -0.0], [1.0, 0.0, 0.0, 0.0, 0.0]]
    df = spark.createDataFrame([(1000 - i, v) for i, v in enumerate(vecs)], "vec_id long, embedding array<float>").repartition(4)
    got = {r.vec_id: r for r in ego.near_duplicates(df, 0.9, block).collect()}
    comp, links = brute_vectors([None if v is None else [None if x is None else float(np.float32(x)) for x in v] for v in vecs])
    low = {k: min(1000 - i for i in range(len(vecs)) if comp[i] == k) for k in comp}
    for i in range(len(vecs)):
        r = got[1000 - i]
        assert (r.n_links, r.component_id, r.kept) == (links[i], low[comp[i]], low[comp[i]] == 1000 - i), i
    assert ego.near_duplicates(df.limit(0)).count() == 0
    short = [[1.0, 0.0], [1.0, 0.1], [0.0, 1.0], [1.0, 0.0], [0.0, 0.0]] + [[float(x)] for x in (1, 2, -1)]  # other lengths link among themselves
    mixed = df.union(spark.createDataFrame([(2000 + i, v) for i, v in enumerate(short)], "vec_id long, embedding array<float>")).withColumn("n_links", F.lit("x"))
    more = {r.vec_id: (r.n_links, r.component_id) for r in ego.near_duplicates(mixed, 0.9, block).collect()}
    assert [more[2000 + i] for i in range(8)] == [(2, 2000), (2, 2000), (0, 2002), (2, 2000), (0, 2004), (1, 2005), (1, 2005), (0, 2007)]
    assert all(more[1000 - i] == (links[i], low[comp[i]]) for i in range(len(vecs)))
    alone = ego.near_duplicates(df.filter("vec_id > 999")).collect()
    assert [(r.n_links, r.kept) for r in alone] == [(0, True)]


def brute_repeats(texts, size):
    seen = {}
    for k, t in enumerate(texts):
        for p in range(len(t) - size + 1):
            seen.setdefault(t[p:p + size], []).append((k, p))
    gone = [bytearray(len(t)) for t in texts]
    for at in seen.values():
        if len(at) > 1:
            for k, p in at:
                gone[k][p:p + size] = b"\1" * size
    return [(len(t), sum(g), sum(1 for i in range(len(g)) if g[i] and (i == 0 or not g[i - 1])),
             hashlib.sha256(bytes(c for c, x in zip(t, g) if not x)).hexdigest()) for t, g in zip(texts, gone)]


def repeat_texts(rnd, n=50):
    passages = [edge.prose(rnd, 150) for _ in range(6)]
    texts = [None, "", "x" * 399, "y" * 400, "y" * 401, "z" * 900, "ab" * 500]
    for _ in range(n):
        t = edge.prose(rnd, rnd.randint(5, 250))
        for _ in range(rnd.randint(0, 3)):
            a = rnd.randint(0, 200)
            t += rnd.choice(passages)[a:a + rnd.randint(380, 450)] + edge.prose(rnd, rnd.randint(0, 30))
        texts.append(t)
        if rnd.random() < 0.5:
            c = list(t)
            for _ in range(rnd.randint(0, 3)):
                c[rnd.randrange(len(c))] = "Q"
            texts.append("".join(c))
    return texts


@pytest.mark.parametrize("block,part", [(8_000_000, 1_000_000), (3000, 700), (1, 50)])
def test_suffix_dedup_against_brute_force(spark, monkeypatch, block, part):
    monkeypatch.setattr(suffix, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix, "PART", part)
    texts = repeat_texts(random.Random(block))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.sha) for r in
           suffix.remove_repeats(df, ["doc_id"], 400).withColumn("sha", F.sha2(F.coalesce("kept", F.lit(b"")), 256)).collect()}
    want = brute_repeats([(t or "").encode() for t in texts], 400)
    assert [got[i] for i in range(len(texts))] == want
    assert sum(w[1] for w in want) > 10_000


def test_suffix_dedup_edges(spark):
    df = edge.docs(spark, clash=True).select("doc_id", "text", "lang", "score")
    out = suffix.remove_repeats(df, ["doc_id", "lang", "score"], 400)
    assert Counter((r.doc_id, r.lang, r.score) for r in out.collect()) == Counter((r[0], r[2], "extra score") for r in edge.rows())
    assert suffix.remove_repeats(edge.empty(spark), ["doc_id"], 400).count() == 0
