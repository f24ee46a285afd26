"""SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints: 64 bits, bit set if it is set in over half of the XXH64 hashes
of a text's word shingles (repeats included).

Search on the distinct fingerprints, so copies cost nothing beyond the first:
two fingerprints within ``max_bits`` bits agree wholly on one of
``max_bits + 1`` bit segments. Each segment pattern is an upper node of the
index: it factors the bits its members share. Below it the members are sorted
by Gray rank of their remaining bits, so that neighbours share bits, and
recursively factored: a node keeps the mask of bits all its members share and
their pattern. Two nodes are compared by the bits both factor out; if those
alone differ in more than ``max_bits`` places, both whole groups are pruned, and
the differences accumulate downwards because a child's mask contains its
parent's. Links found under one upper node leave it as a spanning forest, and
connected components joins the forests, so a crowd of near copies never turns into
all its pairs.

An upper node with more than ``node_rows`` members is split by the same
argument on its remaining bits, until it fits; nothing is capped. (Bits left
over that no longer split belong to at most 2^bits distinct members.)

Null text is empty text. Texts without words have fingerprint zero, linked
like any other. Equal rows share a fingerprint. An empty table gives an empty
result.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloop.llm.common import connected_components, cut

# the kernels below travel by value, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 42
LEAF = 16


def fingerprint(text: str | None, size: int = 3) -> int:
    """The fingerprint of one text (unsigned)."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= size:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends[:len(words) - size + 1] - np.fromiter(map(len, words[:len(words) - size + 1]), np.int64) - 1).tolist()
    stops = (ends[size - 1:] - 1).tolist()
    joined, digest = b" ".join(words), xxhash.xxh64_digest
    votes, step = np.zeros(64, np.int64), 1 << 15
    for k in range(0, len(starts), step):
        raw = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[k:k + step], stops[k:k + step])])
        votes += np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, keep: list[str], size: int = 3) -> DataFrame:
    """``keep`` columns and fp, the fingerprint as a signed long, of every row of ``docs`` (which has text)."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("fp", T.LongType())])

    where = keep.index("text") if "text" in keep else len(keep)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            fps = [fingerprint(t.as_py(), size) for t in b.column(where)]
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(len(keep))] + [pa.array([f - (1 << 64) if f >> 63 else f for f in fps], pa.int64())],
                names=[*keep, "fp"])

    given = [F.col(f"`{c}`") for c in keep] + ([] if "text" in keep else [F.col("text").alias("_text")])
    return docs.select(*given).mapInArrow(run, schema)


def gray_rank(codes):
    """Position of each code in the Gray sequence (numpy uint64)."""
    import numpy as np

    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


def gray_links(codes, max_bits: int, group=None):
    """Spanning forest of the links within ``max_bits`` bits among distinct codes of a group.

    ``group`` numbers the upper node of each code (none: all share one). Returns
    index arrays (u, v) into ``codes``. The index is a binary hierarchy over the
    (group, Gray rank) order; pairs of nodes descend together, level by level, as
    arrays, and are pruned where their groups or too many shared bits differ.
    """
    import numpy as np

    n = len(codes)
    group = np.zeros(n, np.int64) if group is None else group
    order = np.lexsort((gray_rank(codes), group))
    c, g = codes[order], group[order]
    width = 1
    while width * LEAF < n:
        width *= 2
    edges = (np.arange(width + 1) * n) // width
    ones, zeros = [], []  # per level, leaves last: bits set in all members, bits clear in all members
    first, last = [g[edges[:-1]]], [g[edges[1:] - 1]]  # groups a node spans
    lo = np.bitwise_and.reduceat(c, edges[:-1])
    hi = np.bitwise_or.reduceat(c, edges[:-1])
    ones.append(lo)
    zeros.append(~hi)
    while len(ones[0]) > 1:
        ones.insert(0, ones[0][::2] & ones[0][1::2])
        zeros.insert(0, zeros[0][::2] & zeros[0][1::2])
        first.insert(0, first[0][::2])
        last.insert(0, last[0][1::2])
    parent = np.arange(n)

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    found_u, found_v = [], []

    def link(us, vs):
        for a, b in zip(us.tolist(), vs.tolist()):
            ra, rb = root(a), root(b)
            if ra != rb:
                parent[max(ra, rb)] = min(ra, rb)
                found_u.append(a)
                found_v.append(b)

    def descend(level, a, b):
        """Pairs of nodes (a <= b) of one level; large sets are worked off in parts."""
        if len(a) > (1 << 18):
            for k in range(0, len(a), 1 << 18):
                descend(level, a[k:k + (1 << 18)], b[k:k + (1 << 18)])
            return
        apart = (ones[level][a] & zeros[level][b]) | (zeros[level][a] & ones[level][b])
        near = (np.bitwise_count(apart) <= max_bits) & (last[level][a] >= first[level][b])
        a, b = a[near], b[near]
        if not len(a):
            return
        if level + 1 < len(ones):
            same = a == b
            a2 = np.concatenate([2 * a, 2 * a, 2 * a[~same] + 1, 2 * a + 1])
            b2 = np.concatenate([2 * b, 2 * b + 1, 2 * b[~same], 2 * b + 1])
            descend(level + 1, a2, b2)
            return
        size = np.diff(edges)
        for k in range(0, len(a), 1 << 12):
            x, y = a[k:k + (1 << 12)], b[k:k + (1 << 12)]
            i = edges[x][:, None] + np.arange(size.max())
            j = edges[y][:, None] + np.arange(size.max())
            d = np.bitwise_count(c[np.minimum(i, n - 1)][:, :, None] ^ c[np.minimum(j, n - 1)][:, None, :]) <= max_bits
            d &= g[np.minimum(i, n - 1)][:, :, None] == g[np.minimum(j, n - 1)][:, None, :]
            d &= (i < edges[x + 1][:, None])[:, :, None] & (j < edges[y + 1][:, None])[:, None, :]
            p, q, r = np.nonzero(d)
            u, v = i[p, q], j[p, r]
            keep = u < v
            link(u[keep], v[keep])

    descend(0, np.zeros(1, np.int64), np.zeros(1, np.int64))
    return order[np.array(found_u, np.int64)], order[np.array(found_v, np.int64)]


def segments(bits: list[int], parts: int) -> list[list[int]]:
    """``bits`` cut into ``parts`` runs of nearly equal length."""
    return [bits[len(bits) * k // parts:len(bits) * (k + 1) // parts] for k in range(parts)]


def _bit_pattern(bits: list[int]) -> F.Column:
    mask = sum(1 << b for b in bits)
    return F.col("fp").bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long"))


def links(fps: DataFrame, max_bits: int = 3, node_rows: int = 1 << 18) -> DataFrame:
    """(u, v): forest edges that connect all distinct ``fp`` linked within ``max_bits`` bits."""

    def search(batches):
        import numpy as np
        import pyarrow as pa

        got = [b for b in batches if b.num_rows]
        if not got:
            return
        path, pattern, codes = (np.concatenate([b.column(k).to_numpy() for b in got]) for k in range(3))
        order = np.lexsort((pattern, path))
        path, pattern, codes = path[order], pattern[order], codes[order]
        new = np.r_[False, (path[1:] != path[:-1]) | (pattern[1:] != pattern[:-1])]
        u, v = gray_links(codes.view(np.uint64), max_bits, np.cumsum(new))
        yield pa.RecordBatch.from_arrays([pa.array(codes[u]), pa.array(codes[v])], names=["u", "v"])

    # a node: (path of segment numbers, factored pattern); bits: what it has not factored yet
    todo = [((), fps.select("fp", F.lit(0).cast("long").alias("pattern")), list(range(64)))]
    ready, n_paths = None, 0
    while todo:
        path, members, bits = todo.pop()
        cuts = [s for s in segments(bits, max_bits + 1) if s]
        for k, seg in enumerate(cuts):
            way = path + (k,)
            m = members.withColumn("pattern", F.col("pattern").bitwiseOR(_bit_pattern(seg)))
            rest = [b for b in bits if b not in seg]
            m, n_paths = m.withColumn("path", F.lit(n_paths).cast("long")), n_paths + 1
            if 2 ** len(rest) > node_rows:  # a node that may be too large: measure, split what is
                sizes = m.groupBy("pattern").agg(F.count("*").alias("n")).filter(F.col("n") > node_rows).select("pattern")
                if not (big := cut(sizes)).isEmpty():
                    todo.append((way, m.join(big, "pattern", "left_semi").select("fp", "pattern"), rest))
                    m = m.join(big, "pattern", "left_anti").select(m.columns)
            m = m.select("path", "pattern", "fp")
            ready = m if ready is None else ready.union(m)
    return ready.repartition("path", "pattern").mapInArrow(search, "u long, v long")


def groups(fps: DataFrame, max_bits: int = 3, node_rows: int = 1 << 18) -> DataFrame:
    """(fp, group): near-duplicate group of every distinct fingerprint of ``fps``."""
    distinct = cut(fps.select("fp").distinct())
    comp = connected_components(links(distinct, max_bits, node_rows))
    return (distinct.join(comp, F.col("fp") == F.col("node"), "left")
            .select("fp", F.coalesce("component_id", "fp").alias("group")))


def near_duplicates(docs: DataFrame, size: int = 3, max_bits: int = 3, node_rows: int = 1 << 18) -> DataFrame:
    """(doc_id, fp, component_id): component_id is the smallest doc_id reachable by links."""
    f = cut(fingerprints(docs.withColumn("doc_id", F.col("doc_id").cast("long")), ["doc_id"], size))
    low = f.groupBy("fp").agg(F.min("doc_id").alias("low"))
    named = cut(groups(f, max_bits, node_rows).join(low, "fp"))
    tops = named.groupBy("group").agg(F.min("low").alias("component_id"))
    return f.join(named.join(tops, "group").select("fp", "component_id"), "fp").select("doc_id", "fp", "component_id")
