"""Repeated-substring removal by bucket-pointer refinement of a sparse suffix array.

Removes every byte covered by a ``length``-byte string that also starts anywhere
else (same text included; matches never cross texts; strings are judged on the input).

Suffix starts are grouped by what selects them: in the window of ``WINDOW``
positions from a start p, the 8-gram of least hash is p's anchor. Equal
strings have equal anchors at equal offsets, so only the anchors, one in about
``WINDOW`` / 2 positions, enter the bucket stage, each standing for the
contiguous run of starts that chose it:

1. initial buckets: the q-gram at the anchor, q = length - WINDOW + 1 bytes, which
   lies inside the string of every start of the run;
2. first refinement: runs with the same q-gram whose whole spans of bytes agree.
   A shared span settles all its starts at once (all repeat), one alone in
   its q-gram bucket settles too (none repeats);
3. second refinement, for runs still open (their q-gram is shared, their span is
   not) and one representative of each shared span in the same bucket: every start p
   is sorted by the pair of bucket identifiers (q-gram at p, q-gram at p + length - q).
   Equal pairs are equal ``length``-byte strings. Settled runs are reused as they are.

Bucket identifiers are 64-bit hashes of q-grams. Tasks pack texts into blocks; a
block asks for each distinct identifier once and gets the answer back, so a
passage that a third of all texts share is one number per block, never all its
rows in one task. Blocks travel compressed.

Null text is empty text. Texts shorter than ``length`` are kept whole. Exact
copies of long texts lose every byte. An empty table gives an empty result.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloop.llm.common import drop_scratch, write_scratch

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW = 96
BLOCK_BYTES = 4_000_000
PART = 1_000_000
#: Odd multipliers of the rolling hash and the bit mixer.
BASE = 0x9E3779B97F4A7C15
MIX = (0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)

MESSAGE = "kind int, block long, bucket long, a binary, b binary"
PAIRS, GRAMS, STARTS, STATE = 0, 1, 2, 3


def squeeze(array) -> bytes:
    import pyarrow as pa

    raw = array.tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def expand(raw: bytes, dtype):
    import numpy as np
    import pyarrow as pa

    raw = bytes(raw)
    size = int.from_bytes(raw[:8], "little")
    return np.frombuffer(pa.decompress(raw[8:], decompressed_size=size, codec="zstd"), dtype) if size else np.zeros(0, dtype)


def mix(x):
    import numpy as np

    for m in MIX:
        x = x ^ (x >> np.uint64(33))
        x = x * np.uint64(m)
    return x ^ (x >> np.uint64(33))


class Grams:
    """Rolling hashes of a byte string (numpy uint8): of any span of 8 bytes or more."""

    def __init__(self, raw):
        import numpy as np

        n = max(len(raw) - 7, 0)
        self.g = mix(np.ndarray((n,), "<u8", raw.tobytes(), strides=(1,)).astype(np.uint64)) if n else np.zeros(0, np.uint64)
        up, down = np.full(n + 1, BASE, np.uint64), np.full(n + 1, pow(BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        up, self.down = np.cumprod(up), np.cumprod(down)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.g * up[:n], out=self.sums[1:])

    def span(self, start, size):
        """Hash of the ``size`` bytes at ``start`` (arrays)."""
        return mix((self.sums[start + size - 7] - self.sums[start]) * self.down[start])


def window_argmin(g, width: int):
    """For every window [i, i + width) the leftmost position of its least value."""
    import numpy as np

    n = len(g)
    rows = -(-n // width)
    a = np.full(rows * width, np.iinfo(np.uint64).max, np.uint64)
    a[:n] = g
    a, at = a.reshape(rows, width), np.arange(rows * width).reshape(rows, width)
    low = np.minimum.accumulate(a, axis=1)
    new = np.ones(a.shape, bool)
    new[:, 1:] = a[:, 1:] < low[:, :-1]
    low_at = np.maximum.accumulate(np.where(new, at, 0), axis=1).ravel()
    back = a[:, ::-1]
    tail = np.minimum.accumulate(back, axis=1)
    new[:, 1:] = back[:, 1:] <= tail[:, :-1]
    tail_at = np.minimum.accumulate(np.where(new, at[:, ::-1], rows * width), axis=1)[:, ::-1].ravel()
    low, tail = low.ravel(), tail[:, ::-1].ravel()
    m = n - width + 1
    return np.where(tail[:m] <= low[width - 1:n], tail_at[:m], low_at[width - 1:n])


class Block:
    """The texts of a block, one after the other, and the runs of suffix starts in them."""

    def __init__(self, texts: list[bytes], length: int):
        import numpy as np

        self.length, self.gram = length, length - WINDOW + 1
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.raw = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum(self.sizes)
        self.parts = []  # (from, to): byte ranges with the starts in them, all of about PART bytes
        lo = 0
        for end in self.ends.tolist():
            if end - lo >= PART or end == len(self.raw):
                for k in range(lo, end, PART):
                    self.parts.append((k, min(k + PART, end)))
                lo = end

    def runs_of(self, part):
        """Runs of one part: (first start, last start, q-gram bucket, span bucket), and the part's hashes."""
        import numpy as np

        lo, hi = part
        off = hi + self.length + WINDOW
        grams = Grams(self.raw[lo:min(off, len(self.raw))])
        p = np.arange(lo, hi)
        p = p[p + self.length <= self.ends[np.searchsorted(self.ends, p, side="right")]] - lo
        none = np.zeros(0, np.int64)
        if not len(p):
            return none, none, none.astype(np.uint64), none.astype(np.uint64), grams
        anchor = window_argmin(grams.g, WINDOW)[p]
        new = np.r_[True, (anchor[1:] != anchor[:-1]) | (p[1:] != p[:-1] + 1)]
        first = np.nonzero(new)[0]
        p0, p1, a = p[first], p[np.r_[first[1:], len(p)] - 1], anchor[first]
        hm = grams.span(a, self.gram)
        span = mix(grams.span(p0, p1 + self.length - p0) ^ mix((a - p0).astype(np.uint64) << np.uint64(32) | (p1 - p0).astype(np.uint64)) ^ hm)
        return p0 + lo, p1 + lo, hm, span, grams

    def runs(self):
        import numpy as np

        got = [self.runs_of(part)[:4] for part in self.parts]
        return [np.concatenate([g[k] for g in got]) for k in range(4)] if got else [np.zeros(0, np.int64)] * 2 + [np.zeros(0, np.uint64)] * 2

    def start_ids(self, p0, p1):
        """Refined bucket of every start in the runs [p0, p1] (runs in order)."""
        import numpy as np

        out = []
        for lo, hi in self.parts:
            k = np.nonzero((p0 >= lo) & (p0 < hi))[0]
            if len(k):
                grams = Grams(self.raw[lo:min(hi + self.length + WINDOW, len(self.raw))])
                p = ranges(p0[k], p1[k] + 1) - lo
                out.append(mix(grams.span(p, self.gram) * np.uint64(3) + grams.span(p + self.length - self.gram, self.gram)))
        return np.concatenate(out) if out else np.zeros(0, np.uint64)


def ranges(start, stop):
    """All integers of [start, stop) of each row, in order."""
    import numpy as np

    n = stop - start
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


def ask(kind, block, ids, extra, buckets):
    """Messages with distinct ids by bucket; ``extra`` goes along."""
    import numpy as np

    order = np.lexsort((ids, ids % np.uint64(buckets)))
    ids, extra = ids[order], extra[order]
    bucket = (ids % np.uint64(buckets)).astype(np.int64)
    at = np.r_[0, np.nonzero(np.diff(bucket))[0] + 1, len(bucket)] if len(ids) else [0]
    for i, j in zip(at[:-1], at[1:]):
        yield dict(kind=kind, block=block, bucket=int(bucket[i]), a=ids[i:j].tobytes(), b=squeeze(extra[i:j]))


def in_asked_order(ids, buckets):
    import numpy as np

    return np.lexsort((ids, ids % np.uint64(buckets)))


def distinct_pairs(hm, span):
    """(distinct spans, asked twice here, distinct q-grams, least span, more than one span here)."""
    import numpy as np

    pair, first, n = np.unique(span, return_index=True, return_counts=True)
    gram_of = hm[first]
    order = np.lexsort((pair, gram_of))
    gram, at, spans = np.unique(gram_of[order], return_index=True, return_counts=True)
    return pair, n > 1, gram, pair[order][at] if len(gram) else pair[:0], spans > 1


def pack(docs: DataFrame, keep: list[str], length: int, buckets: int) -> DataFrame:
    """Blocks (kind STATE, the rows as an Arrow stream) and their questions."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc
        from pyspark import TaskContext

        serial = [TaskContext.get().partitionId() << 32]
        schema = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("bucket", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])

        def flush(tables):
            block, serial[0] = serial[0], serial[0] + 1
            table = pa.Table.from_batches(tables)
            texts = [(t or "").encode() for t in table.column(table.num_columns - 1).to_pylist()]
            _, _, hm, span = Block(texts, length).runs()
            pair, twice, gram, least, more = distinct_pairs(hm, span)
            yield from ask(PAIRS, block, pair, twice, buckets)
            yield from ask(GRAMS, block, gram, np.rec.fromarrays([least, more], names="least,more"), buckets)
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table)
            yield dict(kind=STATE, block=block, bucket=-1, a=sink.getvalue().to_pybytes())

        got, size = [], 0
        for batch in batches:
            lens = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_pylist()
            at = 0
            for k, n in enumerate(lens):
                size += n + 64
                if size >= BLOCK_BYTES:
                    for message in flush([*got, batch.slice(at, k + 1 - at)]):
                        yield pa.RecordBatch.from_pylist([message], schema)
                    got, size, at = [], 0, k + 1
            if at < len(lens):
                got.append(batch.slice(at))
        if got:
            for message in flush(got):
                yield pa.RecordBatch.from_pylist([message], schema)

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text")).mapInArrow(run, MESSAGE)


def answer(messages: DataFrame) -> DataFrame:
    """Per question and id one byte. PAIRS: 0 alone, 1 shared, 2 shared and this block
    represents it; GRAMS: 1 if several spans share the q-gram; STARTS: 1 if repeated."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        rows = [r for b in batches for r in b.to_pylist()]
        schema = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("bucket", pa.int64()), ("a", pa.binary()), ("b", pa.binary())])
        for kind in (PAIRS, GRAMS, STARTS):
            own = [r for r in rows if r["kind"] == kind]
            if not own:
                continue
            ids = [np.frombuffer(r["a"], np.uint64) for r in own]
            lens = [len(x) for x in ids]
            known, back, n = np.unique(np.concatenate(ids), return_inverse=True, return_counts=True)
            if kind == GRAMS:
                extra = np.concatenate([expand(r["b"], np.dtype([("least", np.uint64), ("more", np.bool_)])) for r in own])
                low, high = np.full(len(known), np.iinfo(np.uint64).max, np.uint64), np.zeros(len(known), np.uint64)
                np.minimum.at(low, back, extra["least"])
                np.maximum.at(high, back, extra["least"])
                many = low != high
                np.logical_or.at(many, back, extra["more"])
                code = many[back].astype(np.uint8)
            else:
                twice = np.concatenate([expand(r["b"], np.bool_) for r in own])
                shared = n > 1
                np.logical_or.at(shared, back, twice)
                code = shared[back].astype(np.uint8)
                if kind == PAIRS:
                    blocks = np.repeat([r["block"] for r in own], lens)
                    low = np.full(len(known), np.iinfo(np.int64).max)
                    np.minimum.at(low, back, blocks)
                    code[(code == 1) & (blocks == low[back])] = 2
            at = 0
            for r, size in zip(own, lens):
                yield pa.RecordBatch.from_pylist([dict(kind=kind, block=r["block"], bucket=r["bucket"], a=squeeze(code[at:at + size]))], schema)
                at += size

    return messages.select("kind", "block", "bucket", "a", "b").repartition("kind", "bucket").mapInArrow(run, MESSAGE)


def read_block(payload: bytes):
    import pyarrow as pa

    return pa.ipc.open_stream(pa.py_buffer(bytes(payload))).read_all()


def answers_for(frame, kind, ids, buckets):
    """The answers of one kind, aligned with ``ids`` (distinct)."""
    import numpy as np

    rows = frame[frame["kind"] == kind].sort_values("bucket")
    out = np.zeros(len(ids), np.uint8)
    if len(ids):
        out[in_asked_order(ids, buckets)] = np.concatenate([expand(a, np.uint8) for a in rows["a"]])
    return out


def refine(blocks: DataFrame, answers: DataFrame, length: int, buckets: int) -> DataFrame:
    """Settles runs by the first refinement; asks for the starts of the others.

    STATE rows: a = settled runs (start, stop pairs), b = open runs and, for
    each of their starts, the place of its id among the block's asked ids."""

    def run(left, right):
        import numpy as np
        import pandas as pd

        out = []
        for block, payload in zip(left["block"], left["a"]):
            table = read_block(payload)
            b = Block([(t or "").encode() for t in table.column(table.num_columns - 1).to_pylist()], length)
            p0, p1, hm, span = b.runs()
            pair, _, gram, _, _ = distinct_pairs(hm, span)
            state = answers_for(right, PAIRS, pair, buckets)[np.searchsorted(pair, span)]
            shared = answers_for(right, GRAMS, gram, buckets)[np.searchsorted(gram, hm)] > 0
            first = np.zeros(len(span), bool)
            first[np.unique(span, return_index=True)[1]] = True
            open_ = shared & ((state == 0) | ((state == 2) & first))
            ids, back, n = np.unique(b.start_ids(p0[open_], p1[open_]), return_inverse=True, return_counts=True)
            out += [(m["kind"], m["block"], m["bucket"], m["a"], m["b"]) for m in ask(STARTS, int(block), ids, n > 1, buckets)]
            place = np.empty(len(ids), np.int64)
            place[in_asked_order(ids, buckets)] = np.arange(len(ids))
            settled = state > 0
            runs = lambda k: np.stack([p0[k], p1[k] + 1]).astype(np.int64)
            alone = open_ & ~settled
            size = (p1 - p0 + 1)[open_]
            asked = np.repeat(alone[open_], size)
            parts = [squeeze(runs(settled)), squeeze(runs(alone)), squeeze(place[back][asked].astype(np.uint32))]
            out.append((STATE, int(block), -1, parts[0], b"".join(len(x).to_bytes(8, "little") + x for x in parts[1:])))
        return pd.DataFrame(out, columns=["kind", "block", "bucket", "a", "b"])

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(run, MESSAGE)


def removed_runs(start, stop, ends):
    """Maximal removed runs from overlapping byte ranges: (text, from, to), texts ending at ``ends``."""
    import numpy as np

    order = np.argsort(start, kind="stable")
    start, stop = start[order], stop[order]
    text = np.searchsorted(ends, start, side="right")  # one free place between texts: their runs never join
    far = np.maximum.accumulate(stop + text) if len(stop) else stop
    new = np.ones(len(start), bool)
    new[1:] = (start + text)[1:] > far[:-1]
    first = np.nonzero(new)[0]
    text = text[first]
    return text, start[first], far[np.append(first[1:], len(far)) - 1] - text if len(first) else first


def cut_out(blocks: DataFrame, told: DataFrame, docs: DataFrame, keep: list[str], length: int) -> DataFrame:
    """The rows with n_bytes, n_removed, n_spans and kept (the remaining bytes)."""
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_removed", "n_spans")]
                          + [T.StructField("kept", T.BinaryType())])

    def run(left, right):
        import numpy as np
        import pyarrow as pa

        tables = []
        rows = right.to_pandas()
        for payload in left.column("a").to_pylist():
            table = read_block(payload)
            texts = [(t or "").encode() for t in table.column(table.num_columns - 1).to_pylist()]
            raw, ends = b"".join(texts), np.cumsum([len(t) for t in texts])
            state = rows[rows["kind"] == STATE].iloc[0]
            start, stop = expand(state["a"], np.int64).reshape(2, -1)
            packed, parts = bytes(state["b"]), []
            while packed:
                n = int.from_bytes(packed[:8], "little")
                parts.append(packed[8:8 + n])
                packed = packed[8 + n:]
            o0, o1 = expand(parts[0], np.int64).reshape(2, -1)
            said = rows[rows["kind"] == STARTS].sort_values("bucket")
            codes = [expand(a, np.uint8) for a in said["a"]]
            codes = np.concatenate(codes) if codes else np.zeros(0, np.uint8)
            p = ranges(o0, o1)[codes[expand(parts[1], np.uint32)] > 0] if len(o0) else o0
            text, lo, hi = removed_runs(np.r_[start, p], np.r_[stop - 1, p] + length, ends)
            kept = [None if given is None else t for given, t in zip(table.column(table.num_columns - 1).to_pylist(), texts)]
            at = np.r_[0, np.nonzero(np.diff(text))[0] + 1, len(text)] if len(text) else [0]
            for i, j in zip(at[:-1], at[1:]):
                k = text[i]
                stays = zip([int(ends[k]) - len(texts[k]), *hi[i:j].tolist()], [*lo[i:j].tolist(), int(ends[k])])
                kept[k] = b"".join([raw[x:y] for x, y in stays])
            count = lambda w=None: pa.array(np.bincount(text, w, len(texts)).astype(np.int64))
            tables.append(pa.table([table.column(k) for k in range(table.num_columns - 1)]
                                   + [pa.array([len(t) for t in texts], pa.int64()), count(hi - lo), count(), pa.array(kept, pa.binary())],
                                   names=[*keep, "n_bytes", "n_removed", "n_spans", "kept"]))
        return pa.concat_tables(tables)

    return blocks.groupBy("block").cogroup(told.groupBy("block")).applyInArrow(run, schema)


def remove_repeats(docs: DataFrame, keep: list[str], length: int = 400) -> DataFrame:
    """``keep`` columns of every row with n_bytes, n_removed, n_spans and kept (binary; null text: null).

    The text travels once, apart from ``keep``; leave it out there unless the original is needed."""
    spark = docs.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed, packed_dir = write_scratch(pack(docs, keep, length, buckets), "suffix-packed")
    blocks = packed.filter(f"kind = {STATE}").select("block", "a")
    first, first_dir = write_scratch(answer(packed.filter(f"kind <> {STATE}")), "suffix-first")
    refined, refined_dir = write_scratch(refine(blocks, first.select("block", "kind", "bucket", "a"), length, buckets), "suffix-refined")
    second, second_dir = write_scratch(answer(refined.filter(f"kind = {STARTS}")), "suffix-second")
    told = (refined.filter(f"kind = {STATE}").union(second).select("block", "kind", "bucket", "a", "b"))
    out, _ = write_scratch(cut_out(blocks, told, docs, keep, length), "suffix-out")
    drop_scratch(spark, packed_dir, first_dir, refined_dir, second_dir)
    return out
