"""Byte-level BPE encoding and decoding with DuckDB recursive queries in each task.

A task cuts its texts into pre-tokens (each match of the pattern), and gives
every distinct pre-token that is not itself a token to DuckDB as one row per
byte: (word, position, token). A recursive query joins adjacent rows with the
merge table and contracts, in every word, the leftmost pair of minimum rank, until
no word has a pair left; a word without a pair leaves the loop. Decoding joins (document, position, id) rows with
the vocabulary and concatenates the bytes in position order.

The merge table holds every pair of tokens whose bytes together are a token
(bounded by the vocabulary, not by the data). Words are remembered within a task; the
memory of a task is bounded: the remembered words are dropped beyond
``REMEMBER``, and a recursive query gets a bounded number of rows. A pre-token
longer than ``LONG`` bytes would take a round per merge, so it goes
through a heap with the same merge rule.

Text boundaries: the pattern can never match across a single space between two
non-space characters, so a text without other white space beside its spaces is
cut there first and each part is matched once per task.

Null text is empty text: no tokens. Special-token strings are ordinary text.
Equal rows get equal ids; an empty table gives an empty result.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LONG = 128
REMEMBER = 700_000
ROWS = 4_000_000
BYTES = 4_000_000

#: p is word * 2^20 + byte position; k packs (rank, position, next position), so its minimum is the leftmost pair of minimum rank.
RECURSIVE = """
with recursive tk as (
  select p, t, 0 as done from bytes_of
  union all
  (with pairs as (
     select x.p, x.t, case when x.np >> 20 = x.p >> 20 then (m.r::bigint << 40) + ((x.p & 1048575) << 20) + (x.np & 1048575) end as k
     from (select p, t, lead(t) over q as nt, lead(p) over q as np from tk where done = 0 window q as (order by p)) x
     left join merges m on m.a = x.t and m.b = x.nt),
   best as (select p >> 20 as w, min(k) as k from pairs group by 1)
   select p.p, case when p.p & 1048575 = (b.k >> 20) & 1048575 then (b.k >> 40)::int else p.t end, (b.k is null)::int
   from pairs p join best b on p.p >> 20 = b.w where b.k is null or p.p & 1048575 <> b.k & 1048575)
)
select p >> 20 as w, t from tk where done = 1 order by p
"""

DECODE = """
select d, unhex(string_agg(h, '' order by p)) as raw
from ids_of join vocab on vocab.id = ids_of.id group by d
"""


def load_ranks(raw: bytes) -> dict[bytes, int]:
    """The ranks of a file with one base64 token and its rank per line."""
    import base64

    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines()) if a}


def connect():
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
    con.execute("set enable_progress_bar = false")
    return con


def table_of(con, name, columns):
    """Create a DuckDB table from numpy arrays or lists."""
    import pyarrow as pa

    data = pa.table(columns)
    con.register("_given", data)
    con.execute(f"create or replace table {name} as select * from _given")
    con.unregister("_given")


class Encoder:
    """Encodes texts of one task."""

    def __init__(self, raw: bytes, pattern: str, remember: int | None = None, rows: int | None = None):
        import numpy as np
        import regex

        self.remember, self.rows = remember or REMEMBER, rows or ROWS

        self.ranks, self.find = load_ranks(raw), regex.compile(pattern).findall
        self.byte = np.array([self.ranks[bytes([k])] for k in range(256)], np.int32)
        self.con = connect()
        split = [(self.ranks[t[:k]], self.ranks[t[k:]], r) for t, r in self.ranks.items()
                 for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        table_of(self.con, "merges", {name: np.array([x[k] for x in split], np.int32) for k, name in enumerate("abr")})
        self.first: dict[str, bytes] = {}  # part at the start of a text -> ids
        self.after: dict[str, bytes] = {}  # part after a space -> ids
        self.odd: set[str] = set()

    def words(self, words: list[bytes]) -> dict[bytes, bytes]:
        """ids (little-endian unsigned 32-bit) of distinct pre-tokens that are no tokens."""
        import numpy as np

        out, group, rows = {}, [], 0
        for w in [*words, None]:
            if w is not None and len(w) > LONG:
                out[w] = self.by_heap(w)
                continue
            if group and (w is None or rows > self.rows):
                lens = np.fromiter(map(len, group), np.int64, len(group))
                at = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
                table_of(self.con, "bytes_of", {"p": (np.repeat(np.arange(len(group)), lens) << 20) + at,
                                                "t": self.byte[np.frombuffer(b"".join(group), np.uint8)]})
                got = self.con.sql(RECURSIVE).to_arrow_table()
                flat = got.column("t").to_numpy().astype("<u4").tobytes()
                ends = [0, *np.cumsum(4 * np.bincount(got.column("w").to_numpy(), minlength=len(group))).tolist()]
                out.update((w2, flat[a:b]) for w2, a, b in zip(group, ends, ends[1:]))
                group, rows = [], 0
            if w is not None:
                group.append(w)
                rows += len(w) * (len(w) + 1) // 2
        return out

    def by_heap(self, word: bytes) -> bytes:
        """The same merges, lowest rank and leftmost first, for one long pre-token."""
        import heapq
        import struct

        parts = [word[k:k + 1] for k in range(len(word))]
        nxt, prev = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        heap = []

        def offer(i):
            j = nxt[i]
            if j < len(parts) and (r := self.ranks.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (r, i, len(parts[i]), len(parts[j])))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = nxt[i] if len(parts[i]) == a else len(parts)
            if j >= len(parts) or not a or len(parts[j]) != b or not b:
                continue
            parts[i], parts[j] = parts[i] + parts[j], b""
            nxt[i] = nxt[j]
            if nxt[j] < len(parts):
                prev[nxt[j]] = i
            offer(i)
            if prev[i] >= 0:
                offer(prev[i])
        return b"".join(struct.pack("<I", self.ranks[p]) for p in parts if p)

    def encode(self, texts: list[str]) -> list[bytes]:
        """ids of each text as little-endian unsigned 32-bit integers."""
        import struct

        if len(self.first) + len(self.after) + len(self.odd) > self.remember:
            self.first, self.after, self.odd = {}, {}, set()
        cut = [t.split(" ") for t in texts]
        new_first = {c[0] for c in cut} - self.first.keys()
        new_after = set().union(*(c[1:] for c in cut)) - self.after.keys()
        # a part that is empty or has white space at an end: the cut beside it may not be a boundary
        self.odd.update([p for s in (new_first, new_after) for p in s if not p or p[0].isspace() or p[-1].isspace()])
        new_first -= self.odd
        new_after -= self.odd
        whole = {k: self.find(texts[k]) for k, c in enumerate(cut) if not self.odd.isdisjoint(c)}
        pieces = {}  # (place, part) -> pre-tokens
        for p in new_first:
            pieces[0, p] = [x.encode() for x in self.find(p)]
        if new_after:  # one match of all: a space starts each part, and no part holds a space
            found = [x.encode() for x in self.find(" " + " ".join(new_after))]
            starts = [k for k, x in enumerate(found) if x.startswith(b" ")]
            for p, i, j in zip(new_after, starts, [*starts[1:], len(found)], strict=True):
                pieces[1, p] = found[i:j]
        for k, found in whole.items():
            pieces[2, k] = [x.encode() for x in found]
        need = {x for ps in pieces.values() for x in ps if x not in self.ranks}
        ids = self.words(list(need))

        def join(ps):
            return b"".join([ids[x] if x in ids else struct.pack("<I", self.ranks[x]) for x in ps])

        for (place, p), ps in pieces.items():
            if place < 2:
                (self.after if place else self.first)[p] = join(ps)
        return [join(pieces[2, k]) if k in whole else self.first[c[0]] + b"".join(map(self.after.__getitem__, c[1:]))
                for k, c in enumerate(cut)]


def _runs(sizes, most):
    """Consecutive index ranges whose sizes add up to about ``most``."""
    at, n = 0, 0
    for k, s in enumerate(sizes):
        n += s
        if n >= most:
            yield at, k + 1
            at, n = k + 1, 0
    if at < len(sizes):
        yield at, len(sizes)


class Decoder:
    """Decodes id sequences of one task."""

    def __init__(self, raw: bytes, con=None):
        import numpy as np

        ranks, self.con = load_ranks(raw), con or connect()
        table_of(self.con, "vocab", {"id": np.fromiter(ranks.values(), np.int32, len(ranks)), "h": [t.hex() for t in ranks]})

    def decode(self, ids: list[bytes]) -> list[bytes]:
        import numpy as np

        out = []
        for i, j in _runs([len(x) // 4 for x in ids], BYTES // 8):
            lens = np.array([len(x) // 4 for x in ids[i:j]])
            at = np.arange(lens.sum(), dtype=np.int64) - np.repeat(np.cumsum(lens) - lens, lens)
            table_of(self.con, "ids_of", {"d": np.repeat(np.arange(j - i, dtype=np.int32), lens), "p": at,
                                          "id": np.frombuffer(b"".join(ids[i:j]), "<u4").astype(np.int32)})
            got = self.con.sql(DECODE).to_arrow_table()
            raw = dict(zip(got.column("d").to_pylist(), got.column("raw").to_pylist()))
            out += [raw.get(k, b"") for k in range(j - i)]
        return out


def encode(docs: DataFrame, vocabulary: bytes, pattern: str, keep: list[str], text: str = "text", decoded: bool = False,
           remember: int | None = None, rows: int | None = None, step: int | None = None) -> DataFrame:
    """``keep`` columns, n_tokens and ids (binary) of every row of ``docs``; with
    ``decoded`` also the bytes the ids decode to, by the same task. ``remember``, ``rows`` and
    ``step`` (characters taken at once) set a task's memory; results do not depend on them."""
    step = step or BYTES
    own = text in keep
    schema = T.StructType([docs.schema[c] for c in keep] + [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]
                          + [T.StructField("decoded", T.BinaryType())] * decoded)
    where = keep.index(text) if own else len(keep)

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        coder = None
        for b in batches:
            if coder is None:
                coder = Encoder(vocabulary, pattern, remember, rows)
                back = Decoder(vocabulary, coder.con) if decoded else None
            for i, j in _runs(pc.fill_null(pc.binary_length(b.column(where)), 0).to_pylist(), step):
                part = b.slice(i, j - i)
                ids = coder.encode([t or "" for t in part.column(where).to_pylist()])
                cols = [part.column(k) for k in range(len(keep))] + [pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
                if decoded:
                    cols.append(pa.array(back.decode(ids), pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[*keep, "n_tokens", "ids"] + ["decoded"] * decoded)

    given = [F.col(f"`{c}`") for c in keep] + ([] if own else [F.col(f"`{text}`").alias("_text")])
    return docs.select(*given).mapInArrow(run, schema)


def decode(coded: DataFrame, vocabulary: bytes) -> DataFrame:
    """All columns of ``coded`` and ``decoded`` (binary), the bytes of its ``ids``."""
    names = coded.columns
    schema = T.StructType(list(coded.schema.fields) + [T.StructField("decoded", T.BinaryType())])
    where = names.index("ids")

    def run(batches):
        import pyarrow as pa

        back = None
        for b in batches:
            back = back or Decoder(vocabulary)
            ids = [x or b"" for x in b.column(where).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(back.decode(ids), pa.binary())], names=[*names, "decoded"])

    return coded.mapInArrow(run, schema)
