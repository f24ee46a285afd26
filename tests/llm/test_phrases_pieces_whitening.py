"""Phrase mining, SentencePiece coding and whitening: brute force, the library, numpy, edge rows."""

import random
import re
import struct
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from scoreloop.llm import phrases, pieces, whitening
from scoreloop.llm.queries import public_file

from . import edge


# phrases ------------------------------------------------------------------------------------------

def brute_phrases(rows, min_count, max_words, top, cover=100):
    counts, totals = {}, Counter()
    for _, text, lang, *_ in rows:
        low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            ws = re.findall(r"[^\x20\x09]+", piece)
            lang = lang if lang is not None else "und"
            totals[lang] += len(ws)
            c = counts.setdefault(lang, Counter())
            for i in range(len(ws)):
                c.update(tuple(ws[i:i + m]) for m in range(1, max_words + 1) if i + m <= len(ws))
    out = []
    for lang, c in counts.items():
        cand = [p for p, a in c.items() if len(p) > 1 and a >= min_count]
        inside = {}
        for p in cand:
            for m in range(2, len(p)):
                for s in range(len(p) - m + 1):
                    inside[p[s:s + m]] = max(inside.get(p[s:s + m], 0), c[p])
        got = []
        for p in cand:
            if p in inside and 100 * inside[p] >= cover * c[p]:
                continue
            best = min(((1000 * c[p] * totals[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p))))
            got.append((-best[0], -c[p], " ".join(p).encode(), c[p[:best[1]]], c[p[best[1]:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(got)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def phrase_rows(seed):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["the", "The", "of", "a", "é", "ß", "x\x00", "b-c"] + [f"w{k}" for k in range(30)])
    rows = list(edge.rows(seed=seed))
    for i in range(60):
        ws = [word() for _ in range(rnd.randint(0, 80))]
        rows.append((300 + i, "".join(w + rnd.choice([" ", " ", "  ", "\t", ", ", ".\n", "\x0b"]) for w in ws), rnd.choice(["en", "en", "de", None, "und"]), "a", 1))
    passage = " ".join(f"w{k % 30}" for k in range(200))
    return rows + [(500 + i, passage, "en", "a", 1) for i in range(20)]  # a passage that a quarter of all texts share


@pytest.mark.parametrize("hash_bits, block, tasks", [(64, 1_000_000, 4), (7, 500, 4), (64, 300, 37)])
def test_phrases_against_brute_force(spark, monkeypatch, hash_bits, block, tasks):
    monkeypatch.setattr(phrases, "BLOCK_WORDS", block)
    monkeypatch.setattr(phrases, "PART_WINDOWS", 400)
    monkeypatch.setattr(phrases, "WORDS_HELD", 50)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        rows = phrase_rows(hash_bits + tasks)
        for cover, width in ((100, 5), (60, 3)):
            got = phrases.collocations(edge.docs(spark, rows, clash=True).withColumn("word", F.lit(1)).withColumn("h", F.lit(2)), min_count=6,
                                       hash_bits=hash_bits, max_words=width, top=50, cover=cover)
            assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
            want = brute_phrases(rows, 6, width, 50, cover)
            assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 25
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


@pytest.mark.parametrize("depth", [2, 3, 4, 5])
def test_quicksort_counts_partitions(depth):
    rng = np.random.default_rng(depth)
    w = rng.integers(1, 4, (4000, 5)).astype(np.uint64)
    w[np.cumsum(rng.random((4000, 5)) < 0.1, axis=1) > 0] = 0
    weight = rng.integers(1, 4, 4000)
    got = list(phrases.sort_pointers(list(w.T), weight, np.arange(4000), depth, 60))
    want = Counter()
    for row, n in zip(w.tolist(), weight.tolist()):
        for m in range(2, 6):
            if all(row[:m]):
                want[tuple(row[:m])] += n
    assert dict(got) == {p: n for p, n in want.items() if n >= 60 or len(p) < depth} and len(got) == len(dict(got))


def test_phrase_scores_past_64_bits(spark):
    n, a, left, right = 9 * 10**15, 7 * 10**15 + 1, 8 * 10**15 + 3, 7 * 10**15 + 11
    found = spark.createDataFrame([("en", [1, 2], a)], "lang string, ids array<long>, a long")
    named = spark.createDataFrame([("en", "x", 1, left), ("en", "y", 2, right)], "lang string, word string, id long, n long")
    totals = spark.createDataFrame([("en", n)], "lang string, total long")
    row = phrases.scored(found, named, totals, None, 100).first()
    assert (row.phrase, row.l, row.r, row.score) == ("x y", left, right, 1000 * a * n // (left * right))


def test_phrases_of_nothing(spark):
    assert phrases.collocations(edge.empty(spark)).count() == 0
    nulls = spark.createDataFrame([(None, None)] * 3, "text string, lang string")
    assert phrases.collocations(nulls, min_count=1).count() == 0
    with pytest.raises(ValueError):
        phrases.collocations(nulls, max_words=1)


# pieces -------------------------------------------------------------------------------------------

MODEL = "piece_bpe_32k.model"


def message(number, value):
    """A field of a protocol-buffer message."""
    def varint(v):
        out = b""
        while v > 127:
            out, v = out + bytes([v & 127 | 128]), v >> 7
        return out + bytes([v])

    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3) + varint(value)


def compiled(entries):
    """A compiled character map: double-array trie of the keys, then the replacements."""
    texts, trie = b"", {}
    for key, value in sorted(entries.items()):
        node = trie
        for byte in key.encode():
            node = node.setdefault(byte, {})
        node[0] = len(texts)
        texts += value.encode() + b"\0"
    units, used, bases, todo = [0] * 65536, {0}, set(), [(0, trie)]
    while todo:
        at, node = todo.pop()
        step = next(s for s in range(1, 60000) if at ^ s not in bases and not any(at ^ s ^ b in used for b in node))
        bases.add(at ^ step)
        units[at] |= step << 10 | (1 << 8 if 0 in node else 0)
        for byte, below in node.items():
            used.add(at ^ step ^ byte)
            units[at ^ step ^ byte] = below | 1 << 31 if byte == 0 else byte
            if byte:
                todo.append((at ^ step ^ byte, below))
    return struct.pack("<I", 4 * len(units)) + struct.pack(f"<{len(units)}I", *units) + texts


CHARS = {"ﬁ": "fi", "é": "é", "Å": "Å", "\t": " ", "\n": " ", "　": " ", "…": "...", "­": "", "ab": "X", "abc": "  y ", "A": "a", "¨": " ̈"}


def models():
    raw = public_file(MODEL)
    mapped = message(2, compiled(CHARS))
    return {"public": raw, "mapped": raw + message(3, mapped), "squeezed": raw + message(3, mapped + message(4, 1)),
            "no prefix": raw + message(3, mapped + message(3, 0)), "squeezed, no prefix": raw + message(3, message(3, 0) + message(4, 1)),
            "no bytes": b"".join(message(k, v) for k, v in pieces.fields(raw) if k != 1 or b"<0x" not in v) + message(2, message(35, 0)),
            "symbols": raw + b"".join(message(1, message(1, p) + message(2, 0.0) + message(3, 4)) for p in (b"<<x>>", b"zqz", b"k br")),
            "unused": raw + message(1, message(1, "zqzq".encode()) + message(2, 1.0) + message(3, 5)) + message(1, message(1, b"zq") + message(2, 2.0))}


@pytest.mark.parametrize("name", list(models()))
def test_pieces_equal_the_library(name):
    import sentencepiece

    raw = models()[name]
    lib, coder = sentencepiece.SentencePieceProcessor(model_proto=raw), pieces.Model(raw).coder()
    rnd = random.Random(7)
    signs = "ab cAﬁé Å…­　¨.,\t\n▁日🙂the wor<<x>>zqzq"
    texts = ["", " ", "   ", "▁", " ▁ x", "ab", "abc abc", "a" * 200, "zqzqzq", "<s> a </s> <0x0A>", "\x00", "x<<x>>y", "thek brown zqzq", "quick brown"]
    texts += ["".join(rnd.choice(signs) for _ in range(rnd.randint(0, 25))) for _ in range(600)]
    texts += [r[1] or "" for r in edge.rows()] + [f"word{k}, the quick" for k in range(30)]
    for t in texts:
        ids, bounds = coder.encode(t.encode())
        want = lib.encode(t, add_bos=True, add_eos=True)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == want, t
        assert coder.decode(ids).decode() == lib.decode(want), t
        spans = [t.encode()[i:j].decode("utf-8", "replace") for i, j in zip(bounds[1:-2], bounds[2:-1])]
        assert spans == [p.surface for p in lib.encode(t, return_type="proto").pieces], t
        assert len(bounds) == len(want) + 1 and (np.diff(bounds) >= 0).all() and bounds[-1] <= len(t.encode())
    for _ in range(500):  # any ids, also bytes that are no UTF-8
        some = [rnd.choice([rnd.randrange(300), rnd.randrange(lib.get_piece_size())]) for _ in range(rnd.randint(0, 6))]
        assert coder.decode(struct.pack(f"<{len(some)}I", *some)).decode() == lib.decode(some), some


def test_character_map_round_trip():
    assert pieces.char_map(compiled(CHARS)) == {k.encode(): v.encode() for k, v in CHARS.items()}
    assert pieces.char_map(b"") == {}


def test_words_of_any_length_agree(monkeypatch):
    model = pieces.Model(public_file(MODEL))
    texts = [(r[1] or "").encode() for r in edge.rows()]
    whole = model.coder()
    want = [whole.encode(t)[0] for t in texts]
    monkeypatch.setattr(pieces, "LONG", 0)  # the heap for every word, nothing remembered
    monkeypatch.setattr(pieces, "REMEMBER", 0)
    plain = model.coder()
    assert [plain.encode(t)[0] for t in texts] == want and not plain
    plain.cut = None  # texts uncut
    assert [plain.encode(t)[0] for t in texts[:12]] == want[:12]


def test_bytes_that_are_no_text():
    coder = pieces.Model(public_file(MODEL)).coder()
    ids, bounds = coder.encode(b"a\xff\xe6\x97b")
    assert coder.decode(ids).decode() == "a���b"
    assert ids == coder.encode("a���b".encode())[0] and bounds[-1] == 5


def test_pieces_query_edges(spark):
    import sentencepiece

    model = public_file(MODEL)
    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    df = edge.docs(spark, clash=True).withColumns({"bounds": F.lit(1), "decoded": F.lit("x")})
    out = pieces.encode(df, model, df.columns, decoded=True)
    assert out.columns == [c for c in df.columns if c not in pieces.RESULT] + list(pieces.RESULT)
    texts = {r[0]: r[1] or "" for r in edge.rows()}
    rows = out.collect()
    assert len(rows) == len(edge.rows())
    for r in rows:
        want = lib.encode(texts[r.doc_id], add_bos=True, add_eos=True)
        assert list(struct.unpack(f"<{r.n_tokens}I", r.ids)) == want and r.decoded.decode() == lib.decode(want)
        assert r.bounds[0] == 0 and r.bounds[-1] == len(texts[r.doc_id].encode()) and r.score == "extra score"
    back = pieces.decode(out, model)
    assert back.columns == out.columns and {(r.doc_id, bytes(r.decoded)) for r in back.collect()} == {(r.doc_id, bytes(r.decoded)) for r in rows}
    assert pieces.encode(edge.empty(spark), model, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        pieces.Model(model + message(2, message(3, 1)))


# whitening ----------------------------------------------------------------------------------------

def spectra():
    rng = np.random.default_rng(13)
    x = rng.standard_normal((300, 24))
    flat = x[:5].T @ x[:5]
    return {"random": x.T @ x, "falling": (x * np.logspace(0, -7, 24)).T @ (x * np.logspace(0, -7, 24)), "rank 5": flat, "equal": 3 * np.eye(24),
            "two values": np.diag([5.0] * 10 + [1.0] * 14), "zero": np.zeros((24, 24)), "one": np.array([[2.0]]),
            "shift on a value": np.diag([1.0, 2.0, 3.0]), "blocks": np.kron(np.eye(6), np.ones((4, 4)))}


@pytest.mark.parametrize("name", list(spectra()))
def test_divide_and_conquer_against_numpy(name):
    v = spectra()[name]
    for count in (min(8, len(v)), len(v)):
        values, axes = whitening.components_of(v, count)
        top = max(np.abs(v).max(), 1e-300) * len(v)
        assert np.allclose(values, np.sort(np.linalg.eigvalsh(v))[::-1][:count], atol=1e-14 * top, rtol=0)
        assert np.linalg.norm(v @ axes - axes * values) <= 1e-13 * top and np.abs(axes.T @ axes - np.eye(count)).max() < 1e-13


def test_polar_factor():
    rng = np.random.default_rng(1)
    for scale in (1, 1e-9, 1e12):
        a = rng.standard_normal((30, 30))
        a = scale * (a + a.T)
        u = whitening.polar(a)
        e, q = np.linalg.eigh(a)
        assert np.abs(u - (q * np.sign(e)) @ q.T).max() < 1e-12


def check_whitening(got, vecs, k):
    x = np.array([[int(np.floor(1024 * float(c))) + 100_000 for c in v] for _, v in vecs], object)
    n, sums = len(x), x.sum(axis=0)
    c = (x * n - sums).astype(float) / n
    values, axes = np.linalg.eigh(c.T @ c / n)
    by = {(r.vec_id, r.component): r for r in got}
    assert len(by) == len(got) == n * k
    for j in range(1, k + 1):
        rows = [by[i, j] for i, _ in vecs]
        want = c @ axes[:, -j] / np.sqrt(values[-j])
        mine = np.array([r.whitened for r in rows])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < 1e-8
        assert all(abs(r.explained / (values[-j] / values.sum()) - 1) < 1e-9 and r.identity_error < 1e-9 and r.n == n for r in rows)
        assert [int(r.deviation) for r in rows] == [sum((n * a - s) ** 2 for a, s in zip(row, sums)) for row in x.tolist()]


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(2)
    good = [(i, (rng.standard_normal(12) * np.arange(1, 13)).tolist()) for i in range(200)] + [(900, [0.0] * 12), (900_000, [-0.0] * 12)]
    short = [(1000 + i, rng.standard_normal(3).tolist()) for i in range(20)]
    bad = [(2000, None), (2001, [None] + [1.0] * 11), (2002, [float("nan")] * 12), (2003, [float("inf")] + [1.0] * 11), (2004, []), (None, None), (2005, [1e300] * 12)]
    df = spark.createDataFrame(good + short + bad, "vec_id long, embedding array<double>").repartition(3).withColumns({c: F.lit("x") for c in ("n", "component", "whitened", "d")})
    rows = whitening.whiten(df).collect()
    check_whitening([r for r in rows if r.vec_id < 1000 or r.vec_id == 900_000], good, 8)
    check_whitening([r for r in rows if 1000 <= r.vec_id < 1020], short, 3)
    assert len(rows) == 202 * 8 + 20 * 3


def test_whitening_large_entries_are_exact(spark):
    vecs = [(i, [1e12 * i, 3e9 * i * i, float(i % 3)]) for i in range(1, 9)]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    rows = whitening.whiten(df, components=1).collect()
    x = [[int(np.floor(1024 * c)) + 100_000 for c in v] for _, v in vecs]
    sums = [sum(c) for c in zip(*x)]
    for r in rows:
        assert int(r.deviation) == sum((8 * a - s) ** 2 for a, s in zip(x[r.vec_id - 1], sums))


def test_whitening_degenerate(spark):
    make = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whiten(make([])).count() == 0 and whitening.whiten(make([(1, None)])).count() == 0
    same = whitening.whiten(make([(1, [1.0, 2.0])] * 4)).collect()  # no variance, equal ids
    assert len(same) == 8 and all(r.whitened == 0 and r.explained == 0 and r.identity_error == 0 and r.deviation == 0 for r in same)
    line = whitening.whiten(make([(i, [float(i), float(2 * i), 5.0]) for i in range(10)])).collect()  # rank one
    assert all((r.component == 1 and abs(r.explained - 1) < 1e-6) or r.whitened == 0 for r in line) and all(r.identity_error < 1e-9 for r in line)
