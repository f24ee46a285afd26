"""Phrase collocations by a multikey three-way quicksort of suffix pointers.

Texts are lower-cased (A-Z), cut into pieces at punctuation and line ends, and those into words. Per
language, every run of 2 to ``max_words`` words in a piece is a phrase; the ones that occur ``min_count`` times or
more are candidates. Steps:

1. One pass counts the words. Words get 64-bit hashes as identifiers; words that share one are found in
   the counted table and get small numbers of their own, so identifiers are exact.
2. A second pass routes a code of the two leading words of every suffix and counts the codes. Pairs of words below
   ``min_count`` are abandoned here: no pointer of theirs travels. (Bitmaps of at most ``BITS`` bits say which words and
   pairs may be frequent; a false yes costs work only.)
3. A third pass makes suffix pointers with the words behind them, as far as ``max_words``, the piece and the frequent pairs go.
   Equal windows of a block travel as one, with their count, routed by a hash of their two leading words.
   Prefixes that hold over half a task's share of all windows (counted by the second pass in a bounded
   number of hash buckets) are routed by three words, then by four, and so on; what such a prefix
   itself counts is added up from the tasks.
4. A task sorts its pointers by the quicksort: the pointers whose word at the present depth is less than, equal to and
   greater than a pivot's form three partitions. The size of an equal partition is the count of its phrase; it is sorted
   by the next word, down to ``max_words``. A partition with fewer than ``min_count`` occurrences is abandoned.
5. Spark joins the counts of both parts of every cut, drops candidates covered by longer ones and ranks.

Counting covers all texts; a language, word or passage that holds a third of all rows is spread by its followers
and pre-aggregated. Null text is empty text, null language is ``und``. Repeated rows count each. Texts that are not
valid UTF-8 are taken with U+FFFD for what is not. A text is in memory whole. Other columns are not read.
An empty table gives an empty result.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloop.llm.common import cut, drop_scratch, write_scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Words of a block, and windows meant for one sort.
BLOCK_WORDS = 1_000_000
PART_WINDOWS = 1_000_000
#: Distinct words a task counts before it hands them on.
WORDS_HELD = 500_000
#: Most bits of a bitmap; bits of a pair's code and of a prefix bucket; small numbers kept for words that share a hash.
BITS = 1 << 27
PAIR_BITS = 40
HEAT_BITS = 20
SHARED = 1 << 16
#: The piece separators, and a byte that valid UTF-8 never holds.
SEPARATORS = b".,;:!?\n\x0b\x0c\r"
CUT = b"\xff"
UND = "und"
MIX = (0x9E3779B97F4A7C15, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


def words_of(texts: list[bytes]) -> list[bytes]:
    """The words of all texts in order; ``CUT`` between pieces and texts."""
    table = bytes.maketrans(bytes(range(65, 91)) + SEPARATORS, bytes(range(97, 123)) + CUT * len(SEPARATORS))
    return CUT.join(texts).translate(table).replace(CUT, b" " + CUT + b" ").split()


def word_hash(word: bytes, bits: int) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word) & ((1 << bits) - 1)


def mixed(x, y):
    """64-bit hashes of pairs (numpy, unsigned)."""
    import numpy as np

    x = (x ^ (x >> np.uint64(32))) * np.uint64(MIX[0]) + y
    x = (x ^ (x >> np.uint64(33))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(33))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(33))


def by_lang(batch):
    """Texts of a batch by language, in order."""
    out: dict[str, list[bytes]] = {}
    for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
        out.setdefault(lang, []).append(text)
    return out


def blocks_of(batches, size: int):
    """(lang, words) in blocks of about ``size`` words; whole texts."""
    held: dict[str, list[bytes]] = {}
    total = 0

    def flush():
        for lang, ws in held.items():
            if ws:
                yield lang, ws
        held.clear()

    for b in batches:
        for k in range(0, b.num_rows, 256):
            for lang, texts in by_lang(b.slice(k, 256)).items():
                found = words_of(texts)
                held.setdefault(lang, []).extend([*found, CUT])
                total += len(found)
            if total >= size:
                yield from flush()
                total = 0
    yield from flush()


def prefixes(cols, lang: str):
    """Hashes of the leading 2, 3, ... words of windows."""
    import numpy as np
    import xxhash

    h, out = np.full(len(cols[0]), xxhash.xxh64_intdigest(lang.encode()), np.uint64), []
    for k, c in enumerate(cols):
        h = mixed(h, c)
        if k:
            out.append(h)
    return out


def windows(ids, width: int, follows=None):
    """Columns of the windows that begin with two words (id 0 ends a piece; nothing follows where ``follows`` is false)."""
    import numpy as np

    padded = np.concatenate([ids, np.zeros(width, np.uint64)])
    after = padded[1:len(ids) + 1] != 0
    after = np.concatenate([after if follows is None else after & follows, np.zeros(width, bool)])
    at = np.nonzero((ids != 0) & after[:len(ids)])[0]
    cols, on = [ids[at]], np.ones(len(at), bool)
    for k in range(1, width):
        on = on & after[at + k - 1]
        cols.append(np.where(on, padded[at + k], np.uint64(0)))
    return cols


def count_words(docs: DataFrame, bits: int) -> DataFrame:
    """Rows (lang, word, h, n) per task; a word may come again."""

    def run(batches):
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        held: dict[str, Counter] = {}

        def flush():
            for lang, counts in held.items():
                counts.pop(CUT, None)
                words = list(counts)
                for k in range(0, len(words), 50_000):
                    part = words[k:k + 50_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(part)), pa.array([w.decode() for w in part]),
                         pa.array(np.array([word_hash(w, bits) for w in part], np.uint64).view(np.int64)), pa.array([counts[w] for w in part], pa.int64())],
                        names=["lang", "word", "h", "n"])
            held.clear()

        for lang, words in blocks_of(batches, BLOCK_WORDS):
            held.setdefault(lang, Counter()).update(words)
            if sum(map(len, held.values())) > WORDS_HELD:
                yield from flush()
        yield from flush()

    return docs.mapInArrow(run, "lang string, word string, h long, n long")


def bitmap(rows: DataFrame, column: str, n: int) -> bytes:
    """Flags of the ``n`` values of a column, by their lowest bits: 64 bits or more a value, at most ``BITS`` in all."""
    bits = 1 << 15
    while bits < min(64 * n, BITS):
        bits *= 2
    place = F.col(column).bitwiseAND(F.lit(bits - 1)) + 1
    flags = bytearray(bits // 8)
    for r in (rows.select(F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("p"))
              .groupBy("b").agg(F.bitmap_construct_agg("p").alias("m")).collect()):  # 4096 bytes a row
        flags[(r["b"] - 1) * 4096:r["b"] * 4096] = r["m"]
    return bytes(flags)


def identifiers(frequent: bytes, special: dict, bits: int):
    """Word -> identifier, 0 for words that are surely infrequent; a dictionary that forgets beyond ``WORDS_HELD``."""
    import numpy as np

    size = len(frequent) * 8

    class Ids(dict):
        def __missing__(self, word):
            i = special.get(word) or word_hash(word, bits)
            at = i % size
            self[word] = i = i if frequent[at >> 3] >> (at & 7) & 1 else 0
            return i

        def of(self, words):
            if len(self) > WORDS_HELD:
                self.clear()
            self[CUT] = 0
            return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))

    return Ids()


def count_codes(docs: DataFrame, width: int, bits: int, parts: int, frequent: bytes, special: dict, share: float, min_count: int) -> DataFrame:
    """(depth, code, n): codes of pairs (depth 0) that occur ``min_count`` times; buckets of prefixes of ``depth`` words
    that hold over ``share`` of the windows of some task."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        ids = identifiers(frequent, special, bits)
        heat, seen = [np.zeros(1 << HEAT_BITS, np.int64) for _ in range(2, width)], 0

        def messages(depth, codes, counts, code_bits):
            part = (codes * np.uint64(parts)) >> np.uint64(code_bits)
            at = np.concatenate([[0], np.nonzero(np.diff(part))[0] + 1, [len(part)]]) if len(part) else [0]
            return pa.RecordBatch.from_arrays(
                [pa.array([depth] * (len(at) - 1), pa.int32()), pa.array([int(part[i]) for i in at[:-1]], pa.int32()),
                 pa.array([packed([differences(codes[i:j]), counts[i:j].astype(np.uint32)]) for i, j in zip(at[:-1], at[1:])], pa.binary())],
                names=["depth", "part", "payload"])

        for lang, words in blocks_of(batches, BLOCK_WORDS):
            cols = windows(ids.of(words), max(2, width - 1))
            ph = prefixes(cols, lang)
            seen += len(ph[0])
            for k, h in enumerate(heat):
                h += np.bincount((ph[k][cols[k + 1] != 0] >> np.uint64(64 - HEAT_BITS)).astype(np.int64), minlength=1 << HEAT_BITS)
            codes = np.sort(ph[0] >> np.uint64(64 - PAIR_BITS))
            first = np.nonzero(np.append(True, codes[1:] != codes[:-1]))[0] if len(codes) else np.zeros(0, np.int64)
            yield messages(0, codes[first], np.diff(np.append(first, len(codes))), PAIR_BITS)
        for k, h in enumerate(heat):
            hot = np.nonzero(h > share * seen)[0]
            yield messages(k + 2, hot.astype(np.uint64), np.minimum(h[hot], (1 << 32) - 1), HEAT_BITS)

    def add(table):
        import numpy as np
        import pyarrow as pa

        depth = table.column("depth")[0].as_py()
        got = [unpacked(x, [(8, np.uint8), (4, np.uint32)]) for x in table.column("payload").to_pylist()]
        codes = np.concatenate([np.cumsum(together(g[0])) for g in got])
        order = np.argsort(codes, kind="stable")
        codes, n = codes[order], np.concatenate([g[1] for g in got])[order].astype(np.int64)
        first = np.nonzero(np.append(True, codes[1:] != codes[:-1]))[0]
        codes, n = codes[first], np.add.reduceat(n, first)
        keep = n >= (1 if depth else min_count)
        return pa.table([pa.array(np.full(int(keep.sum()), depth, np.int32)), pa.array(codes[keep].astype(np.int64)), pa.array(n[keep])],
                        names=["depth", "code", "n"])

    sent = docs.mapInArrow(run, "depth int, part int, payload binary")
    return sent.groupBy("depth", "part").applyInArrow(add, "depth int, code long, n long")


def differences(codes):
    """Steps of a rising sequence, byte by byte (numpy, unsigned): mostly zeros, so they pack well."""
    import numpy as np

    return np.diff(codes, prepend=np.uint64(0)).astype("<u8").view(np.uint8).reshape(-1, 8).T


def together(planes):
    import numpy as np

    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").ravel()


def route(docs: DataFrame, width: int, bits: int, parts: int, frequent: bytes, special: dict, pairs: bytes, hot: list) -> DataFrame:
    """(lang, part, payload): windows with counts and route depths, packed per block and part."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        ids, flags = identifiers(frequent, special, bits), np.frombuffer(pairs, np.uint8)
        low = np.uint64(len(pairs) * 8 - 1)
        for lang, words in blocks_of(batches, BLOCK_WORDS):
            at = ids.of(words)
            code = (prefixes([at, np.append(at[1:], np.uint64(0))], lang)[0] >> np.uint64(64 - PAIR_BITS)) & low
            cols = windows(at, width, (flags[(code >> np.uint64(3)).astype(np.int64)] >> (code & np.uint64(7)).astype(np.uint8)) & 1 == 1)
            n = len(cols[0])
            if not n:
                continue
            ph = prefixes(cols, lang)
            order = np.argsort(ph[-1])  # equal windows come together; a run is cut wherever two rows differ
            differ = np.ones(n, bool)
            differ[1:] = np.logical_or.reduce([c[order[1:]] != c[order[:-1]] for c in cols])
            first = np.nonzero(differ)[0]
            weight = np.diff(np.append(first, n)).astype(np.uint32)
            cols, ph = [c[order[first]] for c in cols], [p[order[first]] for p in ph]
            depth, key = np.full(len(first), 2, np.uint8), ph[0].copy()
            for k, flag in enumerate(hot):  # k + 2 leading words
                deeper = (depth == k + 2) & (cols[k + 1] != 0) & flag[(ph[k] >> np.uint64(64 - HEAT_BITS)).astype(np.int64)]
                depth[deeper], key[deeper] = k + 3, ph[k + 1][deeper]
            order = np.argsort(key, kind="stable")
            part = ((key[order] >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            cols, weight, depth = [c[order] for c in cols], weight[order], depth[order]
            at = np.concatenate([[0], np.nonzero(np.diff(part))[0] + 1, [len(part)]])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(at) - 1)), pa.array(part[at[:-1]].astype(np.int32)),
                 pa.array([packed([*[c[i:j] for c in cols], weight[i:j], depth[i:j]]) for i, j in zip(at[:-1], at[1:])], pa.binary())],
                names=["lang", "part", "payload"])

    return docs.mapInArrow(run, "lang string, part int, payload binary")


def packed(columns) -> bytes:
    """Columns of equal length as one byte string, compressed unless it is short."""
    import pyarrow as pa

    n = len(columns[-1])
    raw = b"".join([c.tobytes() for c in columns])
    return n.to_bytes(4, "little") + (pa.compress(raw, codec="zstd", asbytes=True) if n >= 64 else raw)


def unpacked(payload: bytes, kinds):
    """The columns: ``kinds`` are (bytes a row, type)."""
    import numpy as np
    import pyarrow as pa

    n, out, at = int.from_bytes(payload[:4], "little"), [], 0
    raw = pa.decompress(payload[4:], decompressed_size=n * sum(k for k, _ in kinds), codec="zstd", asbytes=True) if n >= 64 else payload[4:]
    for size, kind in kinds:
        out.append(np.frombuffer(raw, kind, n * size // np.dtype(kind).itemsize, at))
        at += n * size
    return out


def sort_pointers(cols, weight, pointers, depth: int, min_count: int):
    """Multikey three-way quicksort; yields (phrase, count) of every equal partition of two words or more.

    All pointers are routed by ``depth`` leading words: counts of phrases that long are whole, so
    partitions below ``min_count`` are abandoned; those of shorter ones (but one word) are this task's share."""
    import numpy as np

    todo = [(pointers, 0, ())]
    while todo:
        p, k, phrase = todo.pop()
        keys = cols[k][p]
        pivot = np.sort(keys[::max(1, len(keys) // 9)])[len(keys[::max(1, len(keys) // 9)]) // 2]
        less, equal = keys < pivot, keys == pivot
        whole = depth == 2 or k + 1 >= depth
        for side in (p[less], p[~(less | equal)]):
            if len(side) and not (whole and weight[side].sum() < min_count):
                todo.append((side, k, phrase))
        if not pivot:
            continue
        same = p[equal]
        size = int(weight[same].sum())
        if whole and size < min_count:
            continue
        longer = (*phrase, int(pivot))
        if len(longer) > 1:
            yield longer, size
        if len(longer) < len(cols):
            todo.append((same, k + 1, longer))


def count_phrases(routed: DataFrame, width: int, min_count: int) -> DataFrame:
    """(lang, ids, n) of the phrases that every task finds."""
    import pyarrow as pa

    schema = pa.schema([("lang", pa.string()), ("ids", pa.list_(pa.int64())), ("n", pa.int64())])

    def run(table):
        import numpy as np

        kinds = [(8, np.uint64)] * width + [(4, np.uint32), (1, np.uint8)]
        got = [unpacked(x, kinds) for x in table.column("payload").to_pylist()]
        cols = [np.concatenate([g[k] for g in got]) for k in range(width + 2)]
        weight, depths = cols[width].astype(np.int64), cols[width + 1]
        found = []
        for d in np.unique(depths).tolist():
            found += sort_pointers(cols[:width], weight, np.nonzero(depths == d)[0], d, min_count)
        ids = [np.array(p, np.uint64).view(np.int64) for p, _ in found]
        return pa.table([pa.array([table.column("lang")[0].as_py()] * len(found), pa.string()),
                         pa.array(ids, pa.list_(pa.int64())), pa.array([n for _, n in found], pa.int64())], schema=schema)

    return routed.groupBy("lang", "part").applyInArrow(run, "lang string, ids array<long>, n long")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", max_words: int = 5, min_count: int = 100,
                 top: int | None = 2000, cover: int = 100, hash_bits: int = 64) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of the ``top`` phrases of every language (None: all).

    score is floor(1000 a n / (l r)) at the cut into two parts that gives the least of it, exact in 38 digits; a candidate goes
    if a longer one that holds it has ``cover`` percent of its count. ``hash_bits`` is for tests."""
    import numpy as np

    if max_words < 2:
        raise ValueError("phrases have two words or more")
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(F.coalesce(F.col(f"`{lang}`").cast("string"), F.lit(UND)).alias("lang"),
                        F.make_valid_utf8(F.coalesce(F.col(f"`{text}`"), F.lit(""))).cast("binary").alias("text"))
    by_hash = Window.partitionBy("h")
    words, words_dir = write_scratch(
        count_words(given, hash_bits).repartition("h").groupBy("h", "lang", "word").agg(F.sum("n").alias("n"))
        .withColumn("shared", (F.min("word").over(by_hash) != F.max("word").over(by_hash)) | F.col("h").between(0, SHARED)), "phrase-words")
    shared = words.filter("shared").select("word").distinct().limit(SHARED).collect()
    if len(shared) >= SHARED:
        raise ArithmeticError("too many words share a hash")
    special = {r["word"].encode(): i + 1 for i, r in enumerate(sorted(shared))}
    named = words.filter(F.col("n") >= min_count).withColumn("id", F.col("h"))
    if special:
        own = spark.createDataFrame([(w.decode(), i) for w, i in special.items()], "word string, own long")
        named = named.join(own, "word", "left").withColumn("id", F.coalesce("own", "h"))
    named = named.select("lang", "word", "id", "n")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    n_words, n_frequent = (v or 0 for v in words.agg(F.sum("n"), F.count(F.when(F.col("n") >= min_count, 1))).first())
    frequent = bitmap(named, "id", n_frequent)
    coded, coded_dir = write_scratch(count_codes(given, max_words, hash_bits, max(tasks, -(-n_words // PART_WINDOWS)), frequent, special,
                                                 1 / 32 / tasks, min_count), "phrase-pairs")
    pairs = coded.filter("depth = 0")
    n_pairs, n_windows = (v or 0 for v in pairs.agg(F.count("*"), F.sum("n")).first())
    hot = [np.zeros(1 << HEAT_BITS, bool) for _ in range(2, max_words)]
    for r in (coded.filter("depth > 0").filter(F.col("n") > n_windows * 0.5 / tasks)
              .select("depth", "code").collect()):  # at most 2 ** HEAT_BITS a depth
        hot[r["depth"] - 2][r["code"]] = True
    routed = route(given, max_words, hash_bits, max(tasks, -(-n_windows // PART_WINDOWS)), frequent, special, bitmap(pairs, "code", n_pairs), hot)
    found, found_dir = write_scratch(count_phrases(routed, max_words, min_count).groupBy("lang", "ids").agg(F.sum("n").alias("a"))
                                     .filter(F.col("a") >= min_count), "phrase-found")
    out = cut(scored(found, named, totals, top, cover))
    drop_scratch(spark, words_dir, coded_dir, found_dir)
    return out


def scored(found: DataFrame, named: DataFrame, totals: DataFrame, top: int | None, cover: int) -> DataFrame:
    """The ranked collocations of counted candidates (lang, ids, a)."""
    spelled = (found.select("lang", "ids", "a", F.posexplode("ids").alias("at", "id")).join(named, ["lang", "id"])
               .groupBy("lang", "ids", "a").agg(F.array_sort(F.collect_list(F.struct("at", "word", "n"))).alias("w")))
    size = F.size("ids")
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda s: F.slice("ids", s, m))))
    covered = (found.filter(size > 2).select("lang", F.explode(inner).alias("ids"), F.col("a").alias("longer"))
               .groupBy("lang", "ids").agg(F.max("longer").alias("longer")))
    kept = (spelled.join(covered, ["lang", "ids"], "left")
            .filter(F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(cover) * F.col("a"))))
    last = F.col("w")[size - 1]["n"]
    sides = F.flatten(F.transform(F.sequence(F.lit(1), size - 1), lambda k: F.array(
        F.struct(k.alias("k"), F.lit(True).alias("left"), F.slice("ids", 1, k).alias("part"), F.when(k == 1, F.col("w")[0]["n"]).alias("f")),
        F.struct(k.alias("k"), F.lit(False).alias("left"), F.slice("ids", k + 1, size - k).alias("part"), F.when(k == size - 1, last).alias("f")))))
    cuts = kept.select("lang", "ids", "a", F.concat_ws(" ", F.col("w")["word"]).alias("phrase"), F.explode(sides).alias("s")).select(
        "lang", "ids", "a", "phrase", "s.k", "s.left", "s.part", "s.f")
    long = (cuts.filter("f is null").drop("f").join(found.select("lang", F.col("ids").alias("part"), F.col("a").alias("f")), ["lang", "part"]))
    names = ["lang", "ids", "a", "phrase", "k", "left", "f"]
    both = (cuts.filter("f is not null").select(names).union(long.select(names)).groupBy("lang", "ids", "a", "phrase", "k")
            .agg(F.max(F.when(F.col("left"), F.col("f"))).alias("l"), F.max(F.when(~F.col("left"), F.col("f"))).alias("r"))
            .join(totals, "lang"))
    big = lambda c: F.col(c).cast("decimal(19,0)")
    both = both.withColumn("top", F.lit(1000).cast("decimal(4,0)") * big("a") * big("total")).withColumn("low", big("l") * big("r"))
    best = (both.groupBy("lang", "ids", "a", "phrase", "total")
            .agg(F.min(F.struct(F.expr("top div low").alias("score"), "k", "l", "r")).alias("b")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.select("lang", "phrase", "a", "b.l", "b.r", F.col("total").alias("n"), "b.score").withColumn("rank", F.row_number().over(order).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
