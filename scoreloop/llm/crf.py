"""Document quality from a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line's features describe the line and its
two neighbours; transitions tie the labels of adjacent lines. Forward-backward
gives each line's marginal, and a document's quality is the mean marginal
weighted by line length, put on a probability scale by a logistic curve.

Training needs document labels only: lines start with their document's label;
two more rounds relabel the lines of bad documents by the model's own marginals
(the worst line stays bad). It runs on the driver on at most ``per_class``
documents of each label with at most ``max_lines`` lines each, chosen by a seeded
hash; that bound does not grow with the input. Scoring is one pass over whole
texts, without a shuffle.

Null and empty text is one empty line. Without labelled rows of both kinds
the score is 0.5 everywhere. Equal rows get equal scores; an empty table gives
an empty result.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from scoreloop.llm.common import unit

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 1
N_BASE = 14
N_FEATURES = 3 * N_BASE + 1


def line_features(text: str | None):
    """(features of every line with its neighbours, line weights)."""
    import re

    import numpy as np

    capitals = re.compile("[A-Z\u00c0-\u00d6\u00d8-\u00de\u0391-\u03a9\u0410-\u042f]+")
    lines = (text or "").split("\n")
    seen, rows = set(), np.zeros((len(lines), N_BASE), np.float32)
    for k, line in enumerate(lines):
        words = line.split()
        if not words:
            rows[k, 0] = 1.0
            continue
        n, m = len(line), len(words)
        raw = line.encode("utf-8", "surrogatepass")
        symbols = len(raw) - len(raw.translate(None, b"#*$%&|<>"))
        bangs = raw.count(b"!")
        digits = len(raw) - len(raw.translate(None, b"0123456789"))
        upper = n - len(capitals.sub("", line))
        chars = sum(map(len, words))
        key = " ".join(words)
        rows[k, 1:] = (min(np.log1p(n) / 8, 2.0), symbols / m, min(bangs / m, 3.0), digits / chars, upper / chars,
                       chars / m / 10, len(set(words)) / m, sum(map(str.__eq__, words[1:], words[:-1])) / m,
                       raw.count(b"|") / m, key in seen, (symbols + bangs) / m > 0.3, upper * 2 > chars and m > 1, m < 4)
        seen.add(key)
    out = np.ones((len(lines), N_FEATURES), np.float32)
    out[:, 1:1 + N_BASE] = rows
    out[:, 1 + N_BASE:1 + 2 * N_BASE] = np.vstack([np.zeros((1, N_BASE), np.float32), rows[:-1]])
    out[:, 1 + 2 * N_BASE:] = np.vstack([rows[1:], np.zeros((1, N_BASE), np.float32)])
    return out, np.array([max(len(x), 1) for x in lines], np.float64)


def forward_backward(e, n, trans):
    """Marginals of a padded batch: e (docs, lines) emission score of label good
    against bad, n lines per document, trans (2, 2) log transition scores.

    Returns (P(good) per line, expected transition counts per document)."""
    import numpy as np

    b, length = e.shape
    live = np.arange(length)[None, :] < n[:, None]
    em = np.stack([np.zeros_like(e), np.clip(e, -30, 30)], axis=2)
    em = np.exp(em - em.max(axis=2, keepdims=True))
    t = np.exp(trans - trans.max())
    alpha, beta = np.empty((b, length, 2)), np.ones((b, length, 2))
    alpha[:, 0] = em[:, 0] / em[:, 0].sum(axis=1, keepdims=True)
    for k in range(1, length):
        a = (alpha[:, k - 1] @ t) * em[:, k]
        alpha[:, k] = a / a.sum(axis=1, keepdims=True)
    for k in range(length - 2, -1, -1):
        x = (em[:, k + 1] * beta[:, k + 1]) @ t.T
        beta[:, k] = np.where(live[:, k + 1:k + 2], x / x.sum(axis=1, keepdims=True), 1.0)
    p = alpha * beta
    p /= p.sum(axis=2, keepdims=True)
    pairs = alpha[:, :-1, :, None] * t[None, None] * (em[:, 1:] * beta[:, 1:])[:, :, None, :]
    if length > 1:
        pairs /= pairs.sum(axis=(2, 3), keepdims=True)
        pairs *= live[:, 1:, None, None]
    return p[:, :, 1], pairs.sum(axis=1)


def batches_of(docs, cells: int = 100_000):
    """Index groups of similar line counts, at most ``cells`` padded lines each (or one document)."""
    order = sorted(range(len(docs)), key=lambda i: len(docs[i][1]))
    group: list[int] = []
    for i in order:
        if group and len(docs[i][1]) * (len(group) + 1) > cells:
            yield group
            group = []
        group.append(i)
    if group:
        yield group


class Batch:
    """Documents ``group`` laid out as a padded (documents, lines) grid."""

    def __init__(self, docs, group):
        import numpy as np

        self.group, self.n = group, np.array([len(docs[i][1]) for i in group])
        self.x = np.concatenate([docs[i][0] for i in group])
        self.row = np.repeat(np.arange(len(group)), self.n)
        self.col = np.arange(len(self.x)) - np.repeat(np.cumsum(self.n) - self.n, self.n)

    def grid(self, values):
        import numpy as np

        out = np.zeros((len(self.n), self.n.max()))
        out[self.row, self.col] = values
        return out

    def marginals(self, weights, trans):
        return forward_backward(self.grid(self.x @ weights), self.n, trans)


class LineModel:
    """CRF weights and the logistic curve from weighted marginals to quality."""

    def __init__(self, docs, labels, rounds: int = 3, steps: int = 50):
        import numpy as np

        self.w, self.trans = np.zeros(N_FEATURES), np.zeros((2, 2))
        labels = np.asarray(labels, np.float64)
        gold = [np.full(len(wt), y) for (_, wt), y in zip(docs, labels)]
        share = np.where(labels > 0, 0.5 / max(labels.sum(), 1), 0.5 / max((1 - labels).sum(), 1))
        batches = [Batch(docs, g) for g in batches_of(docs)]
        for turn in range(rounds):
            self._climb(batches, gold, share, steps)
            if turn + 1 < rounds:
                for i, p in enumerate(self.line_marginals(docs)):
                    if labels[i] == 0:
                        gold[i] = (p >= 0.5).astype(np.float64)
                        gold[i][np.argmin(p)] = 0.0
        m = self._means(docs)
        a, b, x = 1.0, 0.0, self._logit(m)
        weight = share * len(docs)
        for _ in range(200):  # logistic curve by Newton steps
            p = 1 / (1 + np.exp(-(a * x + b)))
            g = np.array([(weight * (labels - p) * x).sum() - 0.1 * a, (weight * (labels - p)).sum()])
            s = weight * p * (1 - p) + 1e-6
            h = np.array([[(s * x * x).sum() + 0.1, (s * x).sum()], [(s * x).sum(), s.sum()]])
            d = np.linalg.solve(h, g)
            a, b = a + float(np.clip(d[0], -1, 1)), b + float(np.clip(d[1], -1, 1))
            if np.abs(d).max() < 1e-8:
                break
        self.a, self.b = a, b

    def _climb(self, batches, gold, share, steps):
        """Adam on the conditional likelihood; documents weigh alike, both classes half."""
        import numpy as np

        theta = np.concatenate([self.w, self.trans.ravel()])
        m, v = np.zeros_like(theta), np.zeros_like(theta)
        known = []
        for b in batches:  # gold labels, document weights and gold transitions of each batch
            y, f = b.grid(np.concatenate([gold[i] for i in b.group])), share[b.group] / b.n
            live = (np.arange(y.shape[1])[None, 1:] < b.n[:, None])
            one, two = y[:, :-1], y[:, 1:]
            own = np.stack([((1 - one) * (1 - two) * live).sum(1), ((1 - one) * two * live).sum(1),
                            (one * (1 - two) * live).sum(1), (one * two * live).sum(1)], axis=1)
            known.append((b, y, f, own))
        for step in range(1, steps + 1):
            grad = -1e-4 * theta
            for b, y, f, own in known:
                p, pairs = b.marginals(theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2))
                grad[:N_FEATURES] += (((y - p) * f[:, None])[b.row, b.col]) @ b.x
                grad[N_FEATURES:] += f @ (own - pairs.reshape(len(f), 4))
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            theta = theta + 0.2 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
        self.w, self.trans = theta[:N_FEATURES], theta[N_FEATURES:].reshape(2, 2)

    def line_marginals(self, docs):
        """P(good) of every line of every document."""
        out = [None] * len(docs)
        for group in batches_of(docs):
            p, _ = Batch(docs, group).marginals(self.w, self.trans)
            for r, i in enumerate(group):
                out[i] = p[r, :len(docs[i][1])]
        return out

    @staticmethod
    def _logit(m):
        import numpy as np

        m = np.clip(m, 1e-4, 1 - 1e-4)
        return np.log(m / (1 - m))

    def _means(self, docs, marginals=None):
        import numpy as np

        marginals = self.line_marginals(docs) if marginals is None else marginals
        return np.array([float(p @ w / w.sum()) for p, (_, w) in zip(marginals, docs)])

    def quality(self, docs, marginals=None):
        import numpy as np

        return 1 / (1 + np.exp(-np.clip(self.a * self._logit(self._means(docs, marginals)) + self.b, -50, 50)))


def fit(docs: DataFrame, labels: DataFrame, per_class: int = 800, max_lines: int = 200) -> LineModel | None:
    """Fit on ``docs`` (doc_id, text) by ``labels`` (doc_id, label 0/1); None unless both labels occur.

    The sample is drawn from the labels alone, so only its texts move. Of a text with more
    than ``max_lines`` lines a seeded run of that many is learnt from."""
    labels = labels.filter("label in (0, 1) and doc_id is not null").select("doc_id", F.col("label").cast("int"))
    counts = {r["label"]: r["n"] for r in labels.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if set(counts) != {0, 1}:
        return None
    near = F.when(F.col("label") == 0, F.lit((2.0 * per_class + 100) / counts[0])).otherwise(F.lit((2.0 * per_class + 100) / counts[1]))
    order = Window.partitionBy("label").orderBy("_u", "doc_id")
    ids = (labels.withColumn("_u", unit(F.lit(SEED), F.col("doc_id"))).filter(F.col("_u") < near)
           .withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= per_class).drop("_r"))
    once = Window.partitionBy("doc_id", "label").orderBy(F.length("text"), "text")
    sample = (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")  # at most 2 * per_class ids
              .withColumn("_r", F.row_number().over(once)).filter(F.col("_r") == 1))

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def some(u, x, w):
            at = int(np.random.default_rng([SEED, int(u * (1 << 53))]).integers(max(len(w) - max_lines, 0) + 1))
            return x[at:at + max_lines], w[at:at + max_lines]

        for b in batches:
            got = [some(u, *line_features(t)) for u, t in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([x.tobytes() for x, _ in got], pa.binary()),
                 pa.array([w.tobytes() for _, w in got], pa.binary())], names=["label", "u", "x", "w"])

    import numpy as np

    rows = (sample.select(F.col("label").cast("int"), F.col("_u").alias("u"), "text")
            .mapInArrow(run, "label int, u double, x binary, w binary").collect())
    if {r["label"] for r in rows} != {0, 1}:  # ids without a document
        return None
    rows = sorted(rows, key=lambda r: (r["u"], r["label"], bytes(r["x"])))
    docs = [(np.frombuffer(r["x"], np.float32).reshape(-1, N_FEATURES), np.frombuffer(r["w"], np.float64)) for r in rows]
    return LineModel(docs, [r["label"] for r in rows])


def score(docs: DataFrame, model: LineModel | None, keep: list[str]) -> DataFrame:
    """``keep`` columns, score, n_lines and bad_lines of every row of ``docs`` (which has text)."""
    schema = T.StructType([docs.schema[c] for c in keep] + [
        T.StructField("score", T.DoubleType()), T.StructField("n_lines", T.LongType()), T.StructField("bad_lines", T.LongType())])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                lines = [line_features(t) for t in part.column(part.num_columns - 1).to_pylist()]
                if model is None:
                    q, bad = np.full(len(lines), 0.5), [0] * len(lines)
                else:
                    p = model.line_marginals(lines)
                    q, bad = model.quality(lines, p), [int((x < 0.5).sum()) for x in p]
                yield pa.RecordBatch.from_arrays(
                    [part.column(i) for i in range(part.num_columns - 1)]
                    + [pa.array(q, pa.float64()), pa.array([len(w) for _, w in lines], pa.int64()), pa.array(bad, pa.int64())],
                    names=[*keep, "score", "n_lines", "bad_lines"])

    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias("_text")).mapInArrow(run, schema)
