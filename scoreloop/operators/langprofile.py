"""D5 with a stored profile: one row per gram with the log-probabilities of all languages.

The profile is kept under a root folder by the fingerprint of its training rows, so every job that
asks for the same rows reads the same table; it is built once. Within the broadcast bound it goes to the
tasks as two arrays (sorted gram codes, a row of log-probabilities each), and a text is scored where it is read:
its grams are looked up and the rows of the known ones added up, ``STEP`` characters at a time. No gram becomes a row,
no text and no language travels. Beyond the bound callers keep the join of ``operators.lang``.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoreloop.config import SIZING
from scoreloop.operators import lang as L
from scoreloop.operators.sizing import materialize
from scoreloop.session import scratch_path
from scoreloop.sources.files import path_exists

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Characters of text whose grams are looked at together: a task's arrays take about 150 bytes for each.
STEP = 250_000
#: Counted grams a task holds before it passes them on.
HELD = 200_000


def gram_codes(texts):
    """(row, code) of every 3-gram of lower-cased texts: three code points of 21 bits each."""
    points = [np.frombuffer((t or "").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) for t in texts]
    lens = np.array([len(p) for p in points])
    p = np.concatenate([*points, np.zeros(2, np.uint64)])
    row = np.repeat(np.arange(len(texts)), lens)
    place = np.arange(len(row)) - np.repeat(np.cumsum(lens) - lens, lens)
    whole = place + 2 < np.repeat(lens, lens)
    code = p[:-2] << np.uint64(42) | p[1:-1] << np.uint64(21) | p[2:]
    return row[whole], code[whole]


def gram_of(code: int) -> str:
    return "".join(chr(code >> k & 0x1FFFFF) for k in (42, 21, 0))


def code_of(gram: str) -> int:
    a, b, c = map(ord, gram)
    return a << 42 | b << 21 | c


def parts(texts):
    """(rows, strings) of about ``STEP`` characters. A longer text is cut, each cut with the two characters after it:
    every gram lies in exactly one string."""
    rows, strings, size = [], [], 0
    for row, t in enumerate(texts):
        for at in range(0, len(t or "") - 2, STEP):
            rows.append(row)
            strings.append(t[at:at + STEP + 2])
            size += len(strings[-1])
            if size >= STEP:
                yield rows, strings
                rows, strings, size = [], [], 0
    if rows:
        yield rows, strings


class Counts:
    """Counts of gram codes, added up as sorted arrays."""

    def __init__(self):
        self.found, self.size = [], 0

    def add(self, codes, n):
        self.found.append((codes, n))
        self.size += len(codes)
        if self.size > HELD:
            self.merge()

    def merge(self):
        codes, back = np.unique(np.concatenate([c for c, _ in self.found]), return_inverse=True)
        n = np.zeros(len(codes), np.int64)
        np.add.at(n, back, np.concatenate([n for _, n in self.found]))
        self.found, self.size = [(codes, n)], len(codes)
        return codes, n


def gram_counts(train: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, gram, n) over the labelled texts: a task adds up its own texts first."""
    t = train.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.lower(text).alias("t"))

    def run(batches):
        import pyarrow as pa

        held = {}

        def told(name):
            codes, n = held.pop(name).merge()
            for i in range(0, len(codes), 10_000):
                grams = [gram_of(c) for c in codes[i:i + 10_000].tolist()]
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(grams), pa.string()), pa.array(grams, pa.string()),
                                                  pa.array(n[i:i + 10_000])], names=["lang", "gram", "n"])

        for b in batches:
            langs = np.array(b.column(0).to_pylist(), object)
            for name in sorted(set(langs.tolist())):
                for _, strings in parts(b.column(1)[i].as_py() for i in np.nonzero(langs == name)[0].tolist()):
                    held.setdefault(name, Counts()).add(*np.unique(gram_codes(strings)[1], return_counts=True))
                    while held and sum(c.size for c in held.values()) > HELD:
                        yield from told(max(held, key=lambda x: held[x].size))
        for name in sorted(held):
            yield from told(name)

    return t.mapInArrow(run, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def profile_arrays(counts: DataFrame) -> DataFrame:
    """(gram, langs, logp): ``logp`` has ln((n + 0.5) / (T + 0.5 V)) of every language, in the order of ``langs``."""
    v = counts.select(F.count_distinct("gram")).scalar()
    totals = counts.groupBy("lang").agg(F.sum("n").alias("t")).agg(F.array_sort(F.collect_list(F.struct("lang", "t"))).alias("ts"))
    per = (counts.groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("m"))
           .withColumns({"ts": totals.select("ts").scalar(), "v": v}))  # no subquery inside a lambda
    n = lambda x: F.coalesce(F.try_element_at("m", x["lang"]), F.lit(0))
    logp = F.transform("ts", lambda x: F.log(n(x) + L.SMOOTH) - F.log(x["t"] + L.SMOOTH * F.col("v")))
    return per.select("gram", F.transform("ts", lambda x: x["lang"]).alias("langs"), logp.alias("logp"))


def stored_profile(docs: DataFrame, root: str | None = None, text: str = "text", lang: str = "lang") -> DataFrame:
    """The profile table of these training rows: read if it is stored, else built and stored."""
    from scoreloop.operators.audit import table_fingerprint

    spark = docs.sparkSession
    stamp = table_fingerprint(docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()), [text, lang]).first()
    path = f"{(root or scratch_path(spark, 'lang_profiles')).rstrip('/')}/v1-{stamp['num_rows']}-{stamp['fingerprint']}"
    if not path_exists(spark, f"{path}/arrays/_SUCCESS"):  # a table whose writing was cut off is built again
        counts = materialize(gram_counts(docs, text, lang))
        profile_arrays(counts).write.mode("overwrite").parquet(f"{path}/arrays")
    return spark.read.schema("gram string, langs array<string>, logp array<double>").parquet(f"{path}/arrays")


class Profile:
    """A profile small enough for every task: sorted gram codes and their rows of log-probabilities."""

    def __init__(self, langs: list[str], codes, logp):
        self.langs, self.codes, self.logp = langs, codes, logp

    @classmethod
    def load(cls, table: DataFrame, max_rows: int | None = None) -> Profile | None:
        """None if the table is beyond the broadcast bound."""
        n, values = table.agg(F.count("*"), F.coalesce(F.sum(F.size("logp").cast("long")), F.lit(0))).first()
        if n > (SIZING.max_broadcast_rows if max_rows is None else max_rows) or 8 * (n + values) > SIZING.max_broadcast_bytes:
            return None
        got = table.select("gram", "langs", "logp").collect()
        if not got:
            return cls([], np.zeros(0, np.uint64), np.zeros((0, 0)))
        codes = np.array([code_of(r["gram"]) for r in got], np.uint64)
        order = np.argsort(codes)
        return cls(list(got[0]["langs"]), codes[order], np.array([r["logp"] for r in got])[order])

    def languages_of(self, texts, size: int) -> list:
        """The best language of each of ``size`` lower-cased texts; None where no gram is known."""
        sums, known = np.zeros((size, len(self.langs))), np.zeros(size, bool)
        for rows, strings in parts(texts) if len(self.codes) else ():
            row, code = gram_codes(strings)
            at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
            hit = self.codes[at] == code
            row, at = row[hit], at[hit]
            for k in range(len(self.langs)):
                np.add.at(sums[:, k], rows, np.bincount(row, self.logp[at, k], len(strings)))
            known[np.array(rows)[np.bincount(row, minlength=len(strings)) > 0]] = True
        if not self.langs:
            return [None] * size
        return [self.langs[i] if k else None for i, k in zip(sums.argmax(axis=1), known)]  # ties: the first language


def detect_rows(df: DataFrame, profile: Profile, text: str = "text", out: str = "detected_lang", *keep: str) -> DataFrame:
    """``keep`` columns and ``out`` for every row, in the task that reads it."""
    schema = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep)
    shared = df.sparkSession.sparkContext.broadcast((profile.langs, profile.codes, profile.logp))

    def run(batches):
        import pyarrow as pa

        own = Profile(*shared.value)
        for b in batches:
            found = own.languages_of((t.as_py() for t in b.column(len(keep))), b.num_rows)
            yield pa.RecordBatch.from_arrays([*[b.column(k) for k in range(len(keep))], pa.array(found, pa.string())], names=[*keep, out])

    return df.select(*keep, F.lower(text).alias("_t")).mapInArrow(run, f"{schema}, `{out}` string")
