"""Language identification by hierarchical discrimination.

The language family is predicted first, by one-versus-one linear support
vector machines between families; inside the family one-versus-one machines
separate its languages. Features are hashed byte trigrams of the lower-cased
letters of the whole text (square root of the counts, unit length).

The machines are fitted on the driver on at most ``per_lang`` texts per
language and ``max_sample`` in all (but ``FEW`` of every language, however many there are), the ones with
the smallest seeded hash of their id; that bound does not grow with the input. Prediction is one pass
over the texts, without a shuffle.

Texts that are null or have no letter, and every text when nothing can be
learned, get ``und`` with score 0. Rows without a language are not learned
from. An empty table gives an empty result; equal rows get equal predictions.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from scoreloop.llm.common import cut, unit

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UND = "und"
DIM = 1 << 12
SEED = 9
FEW = 5
#: Language families by language code; a code not listed is a family of its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af", "lb", "fy"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "sl", "hr", "sr", "bs", "bg", "mk"),
    "baltic": ("lt", "lv"),
    "uralic": ("fi", "et", "hu"),
    "celtic": ("ga", "cy", "br", "gd"),
    "turkic": ("tr", "az", "kk", "uz"),
    "semitic": ("ar", "he", "mt"),
    "indo-aryan": ("hi", "bn", "ur", "mr", "gu", "pa", "ne"),
}


def family_of(lang: str) -> str:
    return next((f for f, ls in FAMILIES.items() if lang.lower().split("-")[0] in ls), lang)


def has_letter(text: str | None) -> bool:
    return any(c.isalpha() for c in text or "")


def features(text: str):
    """Unit vector of hashed byte trigrams (numpy float32)."""
    import re

    import numpy as np

    letters = re.sub(r"[\W\d_]+", " ", text.lower())
    b = np.frombuffer((" " + letters.strip() + " ").encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    x = np.zeros(DIM, np.float32)
    if len(b) >= 3:
        code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        x = np.sqrt(np.bincount((code * np.uint32(2654435761)) >> np.uint32(20), minlength=DIM)).astype(np.float32)
        x /= max(float(np.linalg.norm(x)), 1e-9)
    return x


def fit_svm(x, y, c: float = 10.0, epochs: int = 30):
    """Linear support vector machine by dual coordinate descent; (weights, scale of the margin)."""
    import numpy as np

    n = len(y)
    w, alpha, rng = np.zeros(x.shape[1]), np.zeros(n), np.random.default_rng(SEED)
    x = x.astype(np.float64)
    cost = np.where(y > 0, c * n / (2 * max((y > 0).sum(), 1)), c * n / (2 * max((y < 0).sum(), 1)))
    q = np.einsum("ij,ij->i", x, x) + 1e-12
    for _ in range(epochs):
        for i in rng.permutation(n):
            g = y[i] * (w @ x[i]) - 1
            new = min(max(alpha[i] - g / q[i], 0.0), cost[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w.astype(np.float32)


class Hierarchy:
    """One-versus-one machines between families and inside each family."""

    def __init__(self, x, langs):
        import numpy as np

        langs = np.array(langs)
        self.families: dict[str, list[str]] = {}
        for lang in sorted(set(langs.tolist())):
            self.families.setdefault(family_of(lang), []).append(lang)
        fam = np.array([family_of(v) for v in langs])
        self.machines: dict[tuple, list] = {}  # group -> (i, j, column)
        columns = []
        for name, labels, of in [("", list(self.families), fam)] + [(f, ls, langs) for f, ls in self.families.items()]:
            self.machines[name] = []
            for i in range(len(labels)):
                for j in range(i + 1, len(labels)):
                    rows = (of == labels[i]) | (of == labels[j])
                    self.machines[name].append((i, j, len(columns)))
                    columns.append(fit_svm(x[rows], np.where(of[rows] == labels[i], 1.0, -1.0)))
        self.weights = np.stack(columns, axis=1) if columns else np.zeros((DIM, 0), np.float32)

    def choose(self, margins, name, n):
        """Winner by votes, then by summed margins; its share of a soft vote."""
        import numpy as np

        if n == 1:
            return np.zeros(len(margins), np.int64), np.ones(len(margins))
        votes, total, soft = (np.zeros((len(margins), n)) for _ in range(3))
        for i, j, k in self.machines[name]:
            m = margins[:, k]
            votes[:, i] += m > 0
            votes[:, j] += m <= 0
            total[:, i] += np.tanh(m)
            total[:, j] -= np.tanh(m)
            p = 1 / (1 + np.exp(-4 * m))
            soft[:, i] += p
            soft[:, j] += 1 - p
        best = np.argmax(votes + total / (10 * n), axis=1)
        return best, soft[np.arange(len(best)), best] / (n - 1)

    def predict(self, x):
        """(languages, scores) of the feature rows."""
        import numpy as np

        margins = (x @ self.weights).astype(np.float64)
        fams = list(self.families)
        f, p = self.choose(margins, "", len(fams))
        langs = np.empty(len(x), object)
        for k, name in enumerate(fams):
            rows = np.nonzero(f == k)[0]
            if len(rows):
                best, share = self.choose(margins[rows], name, len(self.families[name]))
                langs[rows] = [self.families[name][i] for i in best]
                p[rows] *= share
        return langs, np.clip(p, 0.0, 1.0)


def fit(train: DataFrame, per_lang: int = 400, max_sample: int = 4000) -> Hierarchy | None:
    """Fit on ``train`` (doc_id, text, lang): a bounded sample of each language; None without rows."""
    train = train.filter("lang is not null and text is not null and trim(text) <> ''")
    counts = {r["lang"]: r["n"] for r in train.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # one row a language
    if not counts:
        return None
    bound = min(per_lang, max(FEW, max_sample // len(counts)))
    # a hash threshold that leaves about twice the bound, before any shuffle
    share = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, 2.0 * bound / n + 100.0 / n)])[F.col("lang")]
    draw = unit(F.lit(SEED), F.col("doc_id"))
    near = train.withColumn("_u", draw).filter(F.col("_u") < share)
    order = Window.partitionBy("lang").orderBy("_u", "doc_id")
    sample = near.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= bound).select("lang", "text")

    def run(batches):
        import pyarrow as pa

        for b in batches:
            ok = [(lang, t) for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if has_letter(t)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in ok], pa.string()),
                                              pa.array([features(t).tobytes() for _, t in ok], pa.binary())], names=["lang", "x"])

    import numpy as np

    got = sorted((r["lang"], bytes(r["x"])) for r in sample.mapInArrow(run, "lang string, x binary").collect())
    if not got:
        return None
    return Hierarchy(np.stack([np.frombuffer(x, np.float32) for _, x in got]), [lang for lang, _ in got])


def predict(docs: DataFrame, model: Hierarchy | None, keep: list[str]) -> DataFrame:
    """``keep`` columns, lang_pred and score of every row of ``docs`` (which has text)."""
    from pyspark.sql import types as T

    schema = T.StructType([docs.schema[c] for c in keep]
                          + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    where = keep.index("text") if "text" in keep else len(keep)

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                texts = part.column(where).to_pylist()
                known = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
                langs, scores = [UND] * len(texts), [0.0] * len(texts)
                if known:
                    found, p = model.predict(np.stack([features(texts[i]) for i in known]))
                    for i, lang, s in zip(known, found, p):
                        langs[i], scores[i] = lang, float(s)
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(len(keep))] + [pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=[*keep, "lang_pred", "score"])

    given = [F.col(f"`{c}`") for c in keep] + ([] if "text" in keep else [F.col("text").alias("_text")])
    return docs.select(*given).mapInArrow(run, schema)
