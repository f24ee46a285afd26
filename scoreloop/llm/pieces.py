"""SentencePiece encoding and decoding that keeps the place of every piece in the source bytes.

1. Normalisation: at every place of a text the longest entry of the model's compiled character map
   that matches there is replaced (one character as it is where none does). For every byte of the
   normalised text the operator records the source byte it came from.
2. Pieces: the pair of neighbours whose union is the piece of highest score is merged, leftmost
   first, until none is left; a character that is no piece becomes its bytes (or ``<unk>``).
3. Projection: the boundaries of the pieces are looked up in the alignment, so piece i covers the
   source bytes ``bounds[i]`` to ``bounds[i + 1]`` (of a character spelled in bytes, its last byte
   piece covers it).

Where no piece has a space mark after another character, no merge crosses the start of a
word; where none has another sign after a letter, none crosses the end of a run of letters; and a
character that is in no longer piece merges with nothing. Texts are cut there, and a task works out a
distinct word once. Words are remembered up to ``REMEMBER`` entries and dropped beyond; results do not
depend on it. A text is in memory whole, with about 12 bytes per byte of text.

Null text is empty text: begin and end id only. Bytes that are not UTF-8 become U+FFFD one by one.
Result columns replace kept columns of the same name. Equal rows get equal results; an empty
table gives an empty result. Models other than byte-pair ones raise ``ValueError``.
"""

from __future__ import annotations

import heapq
import re
import struct
import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

cloudpickle.register_pickle_by_value(sys.modules[__name__])

REMEMBER = 700_000
#: Longer words are not remembered.
LONG = 64
#: Bytes of text whose results are returned at once.
STEP = 2_000_000
#: The mark that stands for a space, piece types and model type of the file format.
MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
PAIR_MODEL = 2
RESULT = ("n_tokens", "ids", "bounds", "decoded")


def fields(raw: bytes):
    """(number, value) of each field of a protocol-buffer message."""
    at = 0

    def varint():
        nonlocal at
        value = shift = 0
        while True:
            byte = raw[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
        yield key >> 3, raw[at:at + size]
        at += size


def char_map(raw: bytes) -> dict[bytes, bytes]:
    """Entries of a compiled character map: a double-array trie and the strings its leaves point to."""
    if not raw:
        return {}
    size = struct.unpack_from("<I", raw)[0]
    units = struct.unpack_from(f"<{size // 4}I", raw, 4)
    texts = raw[4 + size:]

    def below(node):
        return node ^ ((units[node] >> 10) << ((units[node] & 512) >> 6))

    found, todo = {}, [(below(0), b"")]
    while todo:
        base, key = todo.pop()
        for byte in range(1, 256):
            node = base ^ byte
            if node < len(units) and units[node] & 0x800000FF == byte:
                if units[node] >> 8 & 1:
                    start = units[below(node)] & 0x7FFFFFFF
                    found[key + bytes([byte])] = texts[start:texts.index(b"\0", start)]
                todo.append((below(node), key + bytes([byte])))
    return found


class Model:
    """A byte-pair model file: pieces, scores, flags and the character map."""

    def __init__(self, raw: bytes):
        self.pieces, self.scores, self.kinds = [], [], []
        trainer, normal = {}, {}
        for number, value in fields(raw):
            if number == 1:
                piece = dict(fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number in (2, 3):
                (trainer if number == 2 else normal).update(fields(value))
        if trainer.get(3, 1) != PAIR_MODEL:
            raise ValueError("not a byte-pair model")
        self.bytes_left = bool(trainer.get(35, 0))
        self.suffix = bool(trainer.get(24, 0))
        self.unk_text = trainer.get(44, b" \xe2\x81\x87 ")
        self.dummy, self.squeeze, self.escape = (bool(normal.get(k, 1)) for k in (3, 4, 5))
        self.chars = char_map(normal.get(2, b""))
        place = {p: i for i, p in enumerate(self.pieces)}
        self.unk = self.kinds.index(UNKNOWN)
        self.begin = place.get(trainer.get(46, b"<s>").decode(), self.unk)
        self.end = place.get(trainer.get(47, b"</s>").decode(), self.unk)
        self.own = {p: i for p, i in place.items() if self.kinds[i] in (NORMAL, USER, UNUSED)}
        self.byte = {int(p[3:5], 16): i for p, i in place.items() if self.kinds[i] == BYTE}
        self.users = sorted((p for p, i in place.items() if self.kinds[i] == USER), key=len, reverse=True)
        self.words = not any(MARK in p.lstrip(MARK) for p in self.own) and not self.suffix

    def coder(self):
        return Coder(self)


def one_of(strings) -> str:
    return "|".join(map(re.escape, strings))


class Normaliser:
    """Texts by the character map, with the source byte of every normalised byte."""

    def __init__(self, model: Model):
        self.model = model
        entries = {k.decode("utf-8", "surrogateescape"): v for k, v in model.chars.items()}
        self.entries = {**entries, **{u: u.encode() for u in model.users}}
        self.most = max(map(len, self.entries), default=0)
        first = sorted({k[0] for k in self.entries})
        self.start = re.compile("[" + "".join(map(re.escape, first)) + "]") if first else None
        self.user = re.compile(one_of(model.users)) if model.users else None

    def longest(self, text: str, at: int) -> str | None:
        """The entry at a place: a symbol of the user first, else the longest of the map."""
        if self.user and (m := self.user.match(text, at)):
            return m.group()
        return next((text[at:at + n] for n in range(min(self.most, len(text) - at), 0, -1) if text[at:at + n] in self.entries), None)

    def parts(self, raw: bytes):
        """(bytes, source size, whether it was replaced) of successive parts of a text."""
        at = 0
        while at <= len(raw):
            try:
                text, bad = raw[at:].decode(), 0
            except UnicodeDecodeError as e:
                text, bad = raw[at:at + e.start].decode(), 1
            done = 0
            while self.start and (m := self.start.search(text, done)):
                key = self.longest(text, m.start())
                stop = m.start() + len(key or " ")
                same = text[done:m.start() if key else stop].encode()
                yield same, len(same), False
                if key:
                    yield self.entries[key], len(key.encode()), True
                done = stop
            same = text[done:].encode()
            yield same, len(same), False
            at += len(text.encode())
            if not bad:
                return
            yield "�".encode(), 1, True
            at += 1

    def run(self, raw: bytes):
        """(normalised text, source byte of each of its bytes and of its end)."""
        import numpy as np

        m = self.model
        out, align, keep, at, space = [], [], [], 0, m.squeeze
        head, leading = 0, m.squeeze  # source bytes of the spaces before everything else
        for part, size, replaced in self.parts(raw):
            if leading and (part or replaced):
                spaces = len(part) - len(part.lstrip(b" ")) if not replaced else part == b" "
                head = at + (spaces if not replaced else size * spaces)
                leading = spaces == len(part) and len(part) > 0
            if part:
                b = np.frombuffer(part, np.uint8) == 32
                if replaced:  # only spaces at its head can be one space too many
                    stay = np.ones(len(part), bool)
                    stay[:len(part) - len(part.lstrip(b" "))] = not space
                    align.append(np.full(len(part), at, np.int64))
                else:
                    stay = ~(b & np.concatenate([[space], b[:-1]]))
                    align.append(np.arange(at, at + size))
                space = m.squeeze and (bool(b[-1]) if stay.any() or not replaced else space)
                out.append(part)
                keep.append(stay)
            at += size
        data, align = b"".join(out), np.concatenate([*align, [at]])
        if m.squeeze and out:
            stay = np.concatenate(keep)
            data, align = np.frombuffer(data, np.uint8)[stay].tobytes(), align[np.append(stay, True)]
        if raw and m.dummy and not m.suffix:
            data, align = b" " + data, np.insert(align, 0, head)
        if m.escape and b" " in data:
            align = np.repeat(align, np.append(1 + 2 * (np.frombuffer(data, np.uint8) == 32), 1))
            data = data.replace(b" ", MARK.encode())
        space = MARK.encode() if m.escape else b" "
        while m.squeeze and data.endswith(space):
            data = data[:-len(space)]
            align = align[:len(data) + 1]
        if data and m.dummy and m.suffix:
            data, align = data + space, np.append(align, [align[-1]] * len(space))
        return data.decode("utf-8", "surrogateescape"), align


class Coder(dict):
    """Word -> (id, normalised bytes) of its pieces, little-endian unsigned 32-bit; encodes and decodes the texts of a task."""

    def __init__(self, model: Model):
        super().__init__()
        self.model, self.normaliser = model, Normaliser(model)
        self.user = re.compile(one_of(model.users)) if model.users else None
        self.plain = not model.users and UNUSED not in model.kinds
        self.cost = {p: -model.scores[i] for p, i in model.own.items()}
        self.pair = {p: struct.pack("<II", i, len(p.encode())) for p, i in model.own.items()}
        self.cut = self.cutter() if model.words else None
        self.text = [b"" if k == CONTROL else model.unk_text if k == UNKNOWN else bytes([int(p[3:5], 16)]) if k == BYTE
                     else p.replace(MARK, " ").encode() for p, k in zip(model.pieces, model.kinds)]

    def cutter(self):
        """Cuts a normalised text into words that no merge leaves."""
        long = [p.lstrip(MARK) for p in self.model.own if len(p) > 1]
        letters = "".join(sorted({c for p in long for c in p if c.isalpha()}))
        signs = "".join(sorted({c for p in long for c in p if not c.isalpha()}))
        if not letters + signs:
            return re.compile(f"{MARK}+|[^{MARK}]").findall
        inside = "".join(map(re.escape, letters + signs))
        runs = f"{MARK}*[{inside}]+"
        if letters and signs and not any(x.isalpha() and not y.isalpha() for p in long for x, y in zip(p, p[1:])):
            a, b = ("".join(map(re.escape, x)) for x in (letters, signs))
            runs = f"{MARK}*[{b}]*[{a}]+|{MARK}*[{b}]+"
        return re.compile(f"{runs}|{MARK}+|[^{inside}{MARK}]").findall

    def __missing__(self, word: str):
        found = self.encode_word(word)
        if len(word) <= LONG:
            self[word] = found
        return found

    def encode_word(self, word: str) -> bytes:
        parts = self.short(word) if self.plain and len(word) <= LONG else self.merged(word)
        try:
            return b"".join([self.pair[p] for p in parts])
        except KeyError:  # a character that is no piece
            return b"".join([self.pair[p] if p in self.pair else self.spelled(p.encode("utf-8", "surrogateescape")) for p in parts])

    def spelled(self, raw: bytes) -> bytes:
        """An unknown character: its bytes, the last of which covers it."""
        if not self.model.bytes_left:
            return struct.pack("<II", self.model.unk, len(raw))
        return b"".join([struct.pack("<II", self.model.byte[x], len(raw) if k == len(raw) - 1 else 0) for k, x in enumerate(raw)])

    def short(self, word: str) -> list[str]:
        """The pieces of a short word: the cheapest pair, leftmost of equal ones, until none is a piece."""
        get, none = self.cost.get, float("inf")
        parts = list(word)
        costs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while costs:
            low = min(costs)
            if low == none:
                break
            i = costs.index(low)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del costs[i]
            if i < len(costs):
                costs[i] = get(parts[i] + parts[i + 1], none)
            if i:
                costs[i - 1] = get(parts[i - 1] + parts[i], none)
        return parts

    def merged(self, word: str) -> list[str]:
        """The same for a word of any length, with symbols of the user and unused pieces."""
        own, scores = self.model.own, self.model.scores
        parts, frozen, at = [], set(), 0
        while at < len(word):
            m = self.user.match(word, at) if self.user else None
            if m:
                frozen.add(len(parts))
            parts.append(m.group() if m else word[at])
            at += len(parts[-1])
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap, halves = [], {}

        def offer(i):
            j = after[i] if i >= 0 else n
            if i >= 0 and j < n and i not in frozen and j not in frozen and (k := own.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (-scores[k], i, j, len(parts[i]) + len(parts[j])))
                if self.model.kinds[k] == UNUSED:
                    halves[parts[i] + parts[j]] = parts[i], parts[j]

        for i in range(n - 1):
            offer(i)
        while heap:
            _, i, j, size = heapq.heappop(heap)
            if not parts[i] or not parts[j] or len(parts[i]) + len(parts[j]) != size:
                continue
            parts[i], parts[j], after[i] = parts[i] + parts[j], "", after[j]
            if after[j] < n:
                before[after[j]] = i
            offer(before[i])
            offer(i)

        def usable(p):
            return [x for half in halves[p] for x in usable(half)] if p in halves else [p]

        return [x for p in parts if p for x in usable(p)]

    def encode(self, raw: bytes):
        """(ids, bounds) of a text: bounds has one entry more than ids."""
        import numpy as np

        if len(self) > REMEMBER:
            self.clear()
        text, align = self.normaliser.run(raw)
        found = b"".join(map(self.__getitem__, self.cut(text))) if self.cut else self[text] if text else b""
        ids, sizes = np.frombuffer(found, "<u4").reshape(-1, 2).T
        if not self.model.bytes_left and len(ids):  # neighbouring unknown characters are one piece
            first = np.nonzero(np.append(True, (ids[1:] != self.model.unk) | (ids[:-1] != self.model.unk)))[0]
            ids, sizes = ids[first], np.add.reduceat(sizes, first)
        ends = np.zeros(len(sizes) + 3, np.int64)
        np.cumsum(sizes, out=ends[2:-1])
        ends[-1] = ends[-2]
        return b"".join([struct.pack("<I", self.model.begin), ids.tobytes(), struct.pack("<I", self.model.end)]), align[ends]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of a sequence of ids; bytes that are not UTF-8 become U+FFFD one by one."""
        import numpy as np

        m, rest = self.model, np.frombuffer(ids, "<u4").tolist()
        head, k = b"", 0
        while k < len(rest) and not head:
            own = m.kinds[rest[k]] in (NORMAL, USER, UNUSED)
            head = self.text[rest[k]]
            k += 1
            if own and (m.dummy or m.squeeze) and m.pieces[rest[k - 1]].startswith(MARK):
                head = head[1:]
                if m.dummy and not m.squeeze:
                    break
        raw = b"".join([head, *map(self.text.__getitem__, rest[k:])])
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            out, at = [], 0
            while at < len(raw):
                try:
                    raw[at:].decode()
                    out.append(raw[at:])
                    break
                except UnicodeDecodeError as e:
                    out += [raw[at:at + e.start], "�".encode()]
                    at += e.start + 1
            return b"".join(out)


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


def encode(docs: DataFrame, model: bytes, keep: list[str], text: str = "text", decoded: bool = False) -> DataFrame:
    """``keep`` columns, n_tokens, ids (little-endian unsigned 32-bit, begin and end id included) and bounds
    (array of n_tokens + 1 source bytes) of every row of ``docs``; with ``decoded`` also the bytes the ids decode to."""
    given = [c for c in keep if c not in RESULT]
    schema = T.StructType([docs.schema[c] for c in given] + [T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
                          T.StructField("bounds", T.ArrayType(T.IntegerType()))] + [T.StructField("decoded", T.BinaryType())] * decoded)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        coder = None
        for b in batches:
            coder = coder or Model(model).coder()
            for i, j in _runs(pc.fill_null(pc.binary_length(b.column(len(given))), 0).to_pylist(), STEP):
                part = b.slice(i, j - i)
                coded = [coder.encode(t or b"") for t in part.column(len(given)).to_pylist()]
                ids, bounds = [c[0] for c in coded], [c[1] for c in coded]
                places = np.concatenate([[0], np.cumsum([len(x) for x in bounds])]).astype(np.int32)
                cols = [part.column(k) for k in range(len(given))] + [
                    pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate(bounds).astype(np.int32)))]
                if decoded:
                    cols.append(pa.array([coder.decode(x) for x in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(cols, names=[*given, "n_tokens", "ids", "bounds"] + ["decoded"] * decoded)

    # numbered names: a kept column may have any name
    rows = docs.select(*[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(given)], F.col(f"`{text}`").cast("binary").alias("_text"))
    return rows.mapInArrow(run, schema)


def decode(coded: DataFrame, model: bytes) -> DataFrame:
    """The columns of ``coded`` and ``decoded`` (binary), the text of its ``ids`` (null ids: empty)."""
    names = [c for c in coded.columns if c != "decoded"]
    schema = T.StructType([coded.schema[c] for c in names] + [T.StructField("decoded", T.BinaryType())])
    where = names.index("ids")

    def run(batches):
        import pyarrow as pa

        coder = None
        for b in batches:
            coder = coder or Model(model).coder()
            out = [coder.decode(x or b"") for x in b.column(where).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(out, pa.binary())], names=[*names, "decoded"])

    return coded.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, schema)
