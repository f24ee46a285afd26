"""Rules, sharding and mixing: brute force, SQL, invariants and edge rows."""

import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from scoreloop.llm import mixing, rules, sharding
from scoreloop.llm.common import connected_components
from scoreloop.llm.queries import QUERIES, SQL

from . import edge

SF = "/root/testdata/sf0.001"


def brute_rules(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if grams[tuple(words[i:i + 8])] > 1:
            hit.update(range(i, i + 8))
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_rules_against_brute_force(spark):
    rnd = random.Random(4)
    texts = [r[1] for r in edge.rows()]
    for _ in range(60):  # few words, so windows and lines repeat
        ws = [rnd.choice(["a", "b", "#x", "é"]) for _ in range(rnd.randint(0, 60))]
        texts.append("".join(w + rnd.choice([" ", "\n", "  ", "\t\n"]) for w in ws))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    led = rules.ledger(df)
    for r in led.collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute_rules(texts[r.doc_id]), texts[r.doc_id]
    kept = {r.doc_id: r.kept for r in rules.apply_policy(led, rules.BASE).collect()}
    for i, t in enumerate(texts):
        n, _, _, _, rep = brute_rules(t)
        assert kept[i] == (not (n < 20 or 100 * rep > 30 * n))


def test_ablation_counts(spark):
    led = rules.ledger(edge.docs(spark).select("doc_id", "text"))
    bits = [r.fail_bits for r in led.collect()]
    for r in rules.ablation(led).collect():
        p = next(p for p in rules.POLICIES if p.name == r.policy)
        bit = 1 << rules.BIT[r.rule]
        assert r.n_failed == sum(b & bit != 0 for b in bits)
        assert r.n_only_this == sum(b & p.mask == bit for b in bits)
        assert r.n_kept == sum(b & p.mask == 0 for b in bits)
        assert r.n_kept_without == sum(b & p.mask & ~bit == 0 for b in bits)


def test_shards_are_exact_and_gapless(spark):
    df = edge.docs(spark, clash=True)
    out = sharding.shard(df, n_shards=5)
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and out.columns.count("shard") == 1
    got = out.select("doc_id", "text", "shard", "slot").collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r[0], r[1]) for r in edge.rows())
    sizes = Counter(r.shard for r in got)
    assert max(sizes.values()) - min(sizes.values()) <= 1 and set(sizes) == set(range(5))
    for s, n in sizes.items():
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n))
    assert sharding.shard(edge.empty(spark)).count() == 0


def test_communication_matrix_margins(spark):
    rnd = random.Random(2)
    counts = [rnd.choice([0, 1, 7, 300, 5000]) for _ in range(150)]
    n = sum(counts)
    sizes = [n // 8 + (j < n % 8) for j in range(8)]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(counts) if c], "src long, rows long")
    m = {r.src: r.caps for r in sharding.communication_matrix(df, 150, sizes, 3).collect()}
    assert all(sum(m[i]) == c for i, c in enumerate(counts) if c)
    assert [sum(col) for col in zip(*m.values())] == sizes
    assert all(x >= 0 for row in m.values() for x in row)


def test_hypergeometric_draws_follow_the_law(spark):
    from math import comb

    u = "(shiftrightunsigned(xxhash64(id, 5L), 11) / 9007199254740992D)"
    got = Counter(r.x for r in spark.range(4000).select(F.expr(sharding._draw("30L", "12L", "10L", u)).alias("x")).collect())
    for k in range(11):
        p = comb(12, k) * comb(18, 10 - k) / comb(30, 10)
        assert abs(got[k] / 4000 - p) < 4 * (p / 4000) ** 0.5 + 1e-3


def test_shard_draw_is_uniform(spark):
    """Where one row lands is even over shards and slots of many seeds."""
    df = spark.range(40).select(F.col("id").alias("doc_id")).repartition(3)
    seen = [sharding.shard(df, 4, seed=s).filter("doc_id = 7").first() for s in range(0, 36, 3)]
    assert len({(r.shard, r.slot) for r in seen}) > 6 and len({r.shard for r in seen}) >= 3


def test_mix_targets_and_limits(spark):
    out = mixing.plan(edge.docs(spark).withColumn("size", mixing.n_words()).select("doc_id", "source", "size", "text"))
    got = out.collect()
    assert len(got) == len(edge.rows())
    total = sum(r.size for r in got)
    per = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size
        per.setdefault(r.source, [r.target, r.source_size, 0])[2] += r.taken
    assert abs(sum(t for t, _, _ in per.values()) - total) < 1e-6
    for t, n, taken in per.values():
        assert t <= 3 * n + 1e-9 and abs(taken - t) <= 2 * mixing.BLOCK
    again = mixing.plan(edge.docs(spark).repartition(5).withColumn("size", mixing.n_words()).select("doc_id", "source", "size", "text")).collect()
    key = lambda rs: Counter((r.doc_id, r.size, r.taken) for r in rs)
    assert key(got) == key(again)
    pieces = mixing.taken_texts(out).groupBy("doc_id", "size").agg(F.sum(mixing.n_words()).alias("n")).collect()
    want = Counter()
    for r in got:
        want[r.doc_id, r.size] += r.taken
    assert {(r.doc_id, r["size"]): r.n for r in pieces} == {k: v for k, v in want.items() if v}
    assert mixing.plan(edge.empty(spark).withColumn("size", mixing.n_words())).count() == 0


@pytest.mark.parametrize("weights", [(5.0, 2.0, 1.0), (40.0, 1.0)])
def test_dealt_words_follow_the_quotas(spark, weights):
    docs = spark.read.parquet(f"{SF}/documents.parquet").withColumn("size", mixing.n_words()).withColumn("shard", F.lit("mine"))
    out = mixing.plan(docs.select("doc_id", "source", "size", "shard"), weights=weights).cache()
    got = mixing.dealt(out).select("doc_id", "source", "shard", "shard_words", "taken").collect()
    assert all(r.shard_words > 0 and 0 <= r.shard < mixing.SHARDS for r in got)
    words, per = Counter(), Counter()
    for r in got:
        words[r.doc_id] += r.shard_words
        per[r.source, r.shard] += r.shard_words
    assert words == Counter({r.doc_id: r.taken for r in out.filter("taken > 0").collect()})
    quota = {r.source: r.quota for r in out.select("source", "quota").distinct().collect()}
    assert max(r.rounds for r in out.select("rounds").distinct().collect()) >= 1
    for source, q in quota.items():
        for k, n in enumerate(q):
            assert abs(per[source, k] - n * mixing.BLOCK) <= 4 * mixing.BLOCK, (source, k)
    assert mixing.dealt(out.limit(0)).count() == 0


def test_dealt_blocks_against_brute_force(spark):
    out = mixing.plan(edge.docs(spark).withColumn("size", mixing.n_words()).select("doc_id", "source", "size", "text")).cache()
    want = Counter()
    for r in out.collect():
        k, ends = r.pick, [sum(r.quota[:j + 1]) for j in range(len(r.quota) - 1)]
        for word in range(k.pos, k.pos + r.size):
            place = (k.mul * (word // k.block) + k.add) % k.n_blocks
            for t in range(r.rounds + (place < k.extra)):
                seat = t * k.n_blocks + place
                want[r.doc_id, r.size, sum(seat >= e for e in ends)] += 1
    got = Counter()
    for r in mixing.dealt(out).collect():
        got[r.doc_id, r["size"], r.shard] += r.shard_words
    assert got == want


def test_quotas_match_highest_quotients(spark):
    rnd = random.Random(9)
    goals = [rnd.choice([0.0, 160.0, 1000.0, rnd.uniform(0, 9000)]) for _ in range(13)]
    tgt = spark.createDataFrame([(i, t) for i, t in enumerate(goals)], "sid int, target double")
    got = Counter()
    for r in mixing.quotas(tgt, 16, 4).collect():
        assert r.quota >= 0
        got[r.sid, r.shard] += r.quota
    house, taken, seats = round(sum(goals) / 16), [0] * len(goals), []
    for _ in range(house):
        i = max(range(len(goals)), key=lambda i: (goals[i] / (2 * taken[i] + 1), -i))
        taken[i] += 1
        seats.append(i)
    ends = [house * k // 4 for k in range(5)]
    for k in range(4):
        want = Counter(seats[ends[k]:ends[k + 1]])
        assert all(got[i, k] == want[i] for i in range(len(goals)))


@pytest.mark.parametrize("name", ["op6_mix_sainte_lague", "op8_quality_rules", "op11_phrase_quicksort"])
def test_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = con.sql(SQL[name])
    cols = sorted(want.columns)
    norm = lambda rs: sorted(tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rs)
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == cols
    assert norm(map(tuple, got.select(*cols).collect())) == norm(con.sql(f"select {', '.join(cols)} from want").fetchall())


def test_components(spark):
    rnd = random.Random(5)
    pairs = [(rnd.randrange(300), rnd.randrange(300)) for _ in range(220)] + [(500 + i, 501 + i) for i in range(70)] + [(900, 900 + i) for i in range(50)]
    top = {}

    def root(i):
        while top.get(i, i) != i:
            i = top[i]
        return i

    for a, b in pairs:
        a, b = root(a), root(b)
        top[max(a, b)] = min(a, b)
    got = {r.node: r.component_id for r in connected_components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {i: root(i) for p in pairs if p[0] != p[1] for i in p}
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
