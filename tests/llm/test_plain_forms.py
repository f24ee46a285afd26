"""Operators against plainer forms of themselves: extra columns change nothing, op9's vote written out."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from scoreloop.llm import langid
from scoreloop.llm.queries import QUERIES

from . import edge

SF = "/root/testdata/sf0.001"
RESULT = {
    "op3_shard_hypergeometric": ["doc_id", "size", "text_crc32", "law"],
    "op4_suffix_dedup": ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    "op5_simhash_gray": ["doc_id", "fingerprint", "component_id"],
    "op6_mix_sainte_lague": ["doc_id", "size", "source_size", "target", "taken"],
    "op7_bpe_duckdb": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    "op8_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    "op9_language_hierarchy": ["doc_id", "held_out", "lang_pred"],
    "op10_gru_lm": ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"],
}
#: names of the operators' own columns that documents do not have
OWN = [*edge.CLASH, "held_out", "n_words", "n_repeat_words", "n_dup_lines", "n_symbols", "word_chars", "fail_bits", "base_failed",
       "target", "source_size", "rounds", "quota", "pick", "component_id", "decoded", "n_removed", "n_bytes", "base_score", "h", "k", "n", "_t", "_w", "_l", "_j"]


@pytest.mark.parametrize("name", sorted(RESULT))
def test_extra_columns_change_nothing(spark, tmp_dir, name):
    docs = edge.docs(spark).coalesce(1)
    docs.write.parquet(f"{tmp_dir}/plain/documents.parquet")
    spark.read.parquet(f"{tmp_dir}/plain/documents.parquet").withColumns({c: F.lit(f"extra {c}") for c in OWN}) \
        .write.parquet(f"{tmp_dir}/wide/documents.parquet")
    got = [Counter(tuple(r[c] for c in RESULT[name]) for r in QUERIES[name](spark, f"{tmp_dir}/{form}").collect()) for form in ("plain", "wide")]
    assert got[0] == got[1]
    assert sum(got[0].values()) == len(edge.rows())


def test_extra_columns_of_embeddings_change_nothing(spark, tmp_dir):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet")
    wide = rows.withColumns({c: F.lit("extra") for c in ("n_links", "component_id", "kept", "node", "u", "v", "raw", "x", "block", "rep") if c not in rows.columns})
    wide.write.parquet(f"{tmp_dir}/embeddings.parquet")
    cols = ["vec_id", "n_links", "component_id", "kept"]
    got = [Counter(tuple(r[c] for c in cols) for r in QUERIES["op2_embedding_ego"](spark, d).collect()) for d in (SF, tmp_dir)]
    assert got[0] == got[1] and sum(got[0].values()) == rows.count()


def plain_vote(model, x, name, labels):
    """One-versus-one votes of one row, counted pair by pair; ties to the larger sum of squashed margins, then the first label."""
    import math

    votes, total = Counter(), Counter()
    for i, j, column in model.machines[name]:
        margin = sum(float(a) * float(b) for a, b in zip(x, model.weights[:, column]) if a)
        votes[i if margin > 0 else j] += 1
        total[i] += math.tanh(margin)
        total[j] -= math.tanh(margin)
    return labels[max(range(len(labels)), key=lambda i: (votes[i], total[i], -i))]


def test_language_vote_against_plain_pairs(spark):
    import numpy as np

    train = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    model = langid.fit(train)
    texts = [r.text for r in train.orderBy("doc_id").limit(60).collect()] + ["a", "ß", "x y z", "1a"]
    feats = np.stack([langid.features(t) for t in texts])
    got, scores = model.predict(feats)
    families = list(model.families)
    for k, x in enumerate(feats):
        family = families[0] if len(families) == 1 else plain_vote(model, x, "", families)
        langs = model.families[family]
        assert got[k] == (langs[0] if len(langs) == 1 else plain_vote(model, x, family, langs)), texts[k]
        assert 0 <= scores[k] <= 1


def test_svm_is_near_a_slow_solution():
    """Separable points with a wide gap: the fast fit and a plain subgradient descent put every point on the same side."""
    import numpy as np

    rng = np.random.default_rng(3)
    y = np.where(rng.random(300) < 0.4, 1.0, -1.0)
    x = np.zeros((300, langid.DIM), np.float32)
    x[:, :20] = rng.normal(size=(300, 20)) * 0.1
    x[:, 3] += y
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    fast = langid.fit_svm(x, y)
    slow, small = np.zeros(20), x[:, :20].astype(float)
    for step in range(2000):
        wrong = y * (small @ slow) < 1
        slow -= 1 / (1 + step) ** 0.5 * (0.001 * slow - (y[wrong, None] * small[wrong]).sum(0) / len(y))
    assert (np.sign(x @ fast) == y).all() and (np.sign(small @ slow) == y).all()
    cosine = fast[:20] @ slow / np.linalg.norm(fast) / np.linalg.norm(slow)
    assert cosine > 0.9
