"""Embedding whitening by QDWH spectral divide-and-conquer.

Components are scaled to integers x = floor(``scale`` * c) + ``offset``, so counts and sums are exact. Spark sums
the moments: one pass gives the count n and the per-dimension sums S, a second one the covariance V of the
centred rows. V (dimensions x dimensions, at most ``MAX_DIM`` of them) is what reaches the driver.

The eigenvectors of V come from polar decompositions: the dynamically weighted Halley iteration gives the
polar factor U of V - s I, (U + I) / 2 projects onto the eigenvectors above the shift s, orthonormal bases of
its range and of the rest split V into two smaller problems, and so on until every
part is one component (or a multiple of the identity). Parts below the asked components are not split.

The components and scales (dimensions x components, bounded as V) go to the tasks with the code; a third
pass measures the covariance of the whitened rows, and the result is one row per vector and component.

Vectors that are null, or hold null or non-finite entries, or one whose integer does not fit 62 bits, are
dropped. Zero vectors stay. Vectors of another length are a fit of their own (n, S and V of that length);
empty vectors have no component, so no rows. Rows with equal ids are vectors of their own. A component without
variance (its eigenvalue is rounding error) has whitened 0 and explained 0 and is left out of identity_error.
A deviation of over 38 digits is null. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MAX_DIM = 4096
SCALE, OFFSET = 1024, 100_000
#: Eigenvalues below this share of the largest one are rounding error.
RANK = 1e-13


def matrices(column, dim: int | None = None, scale: int = SCALE, offset: int = OFFSET):
    """(rows, x) of each vector length of an Arrow list column: row numbers and integer matrix of the valid vectors."""
    import numpy as np
    import pyarrow.compute as pc

    size = pc.list_value_length(column)
    null = size.is_null().to_numpy(zero_copy_only=False)
    lens = pc.fill_null(size, 0).to_numpy(zero_copy_only=False).astype(np.int64)
    with np.errstate(invalid="ignore", over="ignore"):
        flat = np.floor(column.flatten().cast("float64").to_numpy(zero_copy_only=False) * scale)
        good = np.abs(flat) < 2.0**62
    starts = np.cumsum(lens) - lens
    bad = np.concatenate([[0], np.cumsum(~good)])
    valid = ~null & (bad[starts + lens] == bad[starts]) & (lens > 0)
    for d in np.unique(lens[valid]).tolist() if dim is None else [dim]:
        rows = np.nonzero(valid & (lens == d))[0]
        if len(rows):
            yield rows, flat[starts[rows][:, None] + np.arange(d)].astype(np.int64) + offset


def centred(x, n: int, sums):
    """x - S / n in double precision: the whole part of the mean is taken off as integers."""
    import numpy as np

    whole = [s // n for s in sums]
    return (x - np.array(whole, np.int64)) - np.array([(s - w * n) / n for s, w in zip(sums, whole)])


def moments(df: DataFrame, vec: str, scale: int, offset: int) -> dict[int, tuple[int, list[int]]]:
    """Vector length -> (n, sums)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        n, sums = {}, {}
        for b in batches:
            for _, x in matrices(b.column(0), None, scale, offset):
                d = x.shape[1]
                if d > MAX_DIM:
                    raise ValueError(f"vectors of {d} components; the bound is {MAX_DIM}")
                n[d] = n.get(d, 0) + len(x)
                low, high = x & 0xFFFFFFFF, x >> 32  # two halves: no sum of a batch overflows
                total = low.sum(axis=0).astype(object) + (high.sum(axis=0).astype(object) << 32)
                sums[d] = sums.get(d, np.zeros(d, object)) + total
        for d in n:
            yield pa.RecordBatch.from_arrays([pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n[d]] * d, pa.int64()),
                                              pa.array([str(v) for v in sums[d]])], names=["d", "i", "n", "s"])

    got: dict = {}
    parts = df.select(vec).mapInArrow(run, "d int, i int, n long, s string")
    for r in parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect():
        got.setdefault(r["d"], (r["n"], [0] * r["d"]))[1][r["i"]] = int(r["s"])
    return got


def summed(df: DataFrame, vec: str, dim: int, width: int, rows_of, scale: int, offset: int):
    """Sum over all valid vectors of length ``dim`` of the outer products of ``rows_of(x)`` (``width`` columns)."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        total = np.zeros((width, width))
        for b in batches:
            for _, x in matrices(b.column(0), dim, scale, offset):
                y = rows_of(x)
                total += y.T @ y
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i * width + j), pa.array(total[i, j])], names=["k", "v"])

    import numpy as np

    m = np.zeros(width * width)
    for r in df.select(vec).mapInArrow(run, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).collect():
        m[r["k"]] = r["v"]
    m = m.reshape(width, width)
    return m + np.triu(m, 1).T


def polar(a):
    """Polar factor of a symmetric matrix by the dynamically weighted Halley iteration."""
    import numpy as np

    n = len(a)
    x = a / np.linalg.norm(a)
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(x))  # no larger than the least singular value
    except np.linalg.LinAlgError:
        low = 0.0
    low = min(max(low, np.finfo(float).eps), 1.0)
    eye = np.eye(n)
    for _ in range(30):
        l2 = low * low
        d = np.sqrt(1 + (4 * (1 - l2) / l2**2) ** (1 / 3))
        wa = d + np.sqrt(8 - 4 * (d * d - 1) + 8 * (2 - l2) / (l2 * d)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
            new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            new = wb / wc * x + (wa - wb / wc) * np.linalg.solve(eye + wc * x.T @ x, x.T).T
        new = (new + new.T) / 2
        low = min(low * (wa + wb * l2) / (1 + wc * l2), 1.0)
        moved, x = np.linalg.norm(new - x), new
        if moved < 1e-14 * n and 1 - low < 1e-14:
            break
    return x


def split(a, seed: int):
    """(basis of the eigenvectors above a shift, basis of the rest), or None if ``a`` is a multiple of the identity."""
    import numpy as np

    n = len(a)
    size = np.linalg.norm(a)
    spread = np.linalg.norm(a - np.trace(a) / n * np.eye(n))
    if n == 1 or spread <= 4 * n * np.finfo(float).eps * size:
        return None
    rng = np.random.default_rng(seed)
    mean = np.trace(a) / n
    best = None
    for k, shift in enumerate([np.median(np.diag(a)), mean, *(mean + spread / np.sqrt(n) * rng.uniform(-0.5, 0.5, 30))]):
        u = polar(a - shift * np.eye(n))
        projector = (u + np.eye(n)) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < n or np.linalg.norm(u @ u - np.eye(n)) > 1e-8:
            continue  # all on one side, or an eigenvalue at the shift
        upper, _ = np.linalg.qr(projector @ rng.standard_normal((n, rank)))
        upper, _ = np.linalg.qr(projector @ upper)
        basis, _ = np.linalg.qr(np.hstack([upper, rng.standard_normal((n, n - rank))]))
        upper, lower = basis[:, :rank], basis[:, rank:]
        left = np.linalg.norm(lower.T @ a @ upper)
        if best is None or left < best[0]:
            best = left, upper, lower
        if left <= 4 * n * np.finfo(float).eps * size:
            break
    if best is None:
        raise ArithmeticError("no shift splits the spectrum")
    return best[1], best[2]


def components_of(v, count: int):
    """(eigenvalues, unit eigenvectors as columns) of the ``count`` largest eigenvalues of a symmetric matrix."""
    import numpy as np

    v = (v + v.T) / 2
    parts, done = [np.eye(len(v))], []
    while parts and len(done) < count:
        basis = parts.pop()
        a = basis.T @ v @ basis
        halves = split((a + a.T) / 2, len(done) + len(parts))
        if halves is None:
            done += [basis[:, k] for k in range(basis.shape[1])]
        else:  # the part above the shift comes first
            parts += [basis @ halves[1], basis @ halves[0]]
    axes = np.stack(done, axis=1)
    axes, _ = np.linalg.qr(axes)
    values = np.einsum("ij,ij->j", axes, v @ axes)
    order = np.argsort(-values, kind="stable")[:count]
    axes = axes[:, order]
    axes = axes * np.where(axes[np.abs(axes).argmax(axis=0), np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    return values[order], axes


def deviations(x, n: int, sums):
    """Exact sums of (n x - S)^2 of the rows, as an Arrow decimal array."""
    from decimal import Decimal

    import numpy as np
    import pyarrow as pa

    reach = max(max(abs(n * int(lo) - s), abs(n * int(hi) - s)) for lo, hi, s in zip(x.min(axis=0), x.max(axis=0), sums))
    if x.shape[1] * reach**2 < 2**63 and n * max(abs(int(x.min())), abs(int(x.max()))) < 2**63:
        y = n * x - np.array(sums, np.int64)
        return pa.array((y * y).sum(axis=1)).cast(pa.decimal128(38, 0))
    total = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums)) for row in x.tolist()]
    return pa.array([Decimal(t) if t < 10**38 else None for t in total], pa.decimal128(38, 0))


def whiten(df: DataFrame, key: str = "vec_id", vec: str = "embedding", components: int = 8, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(``key``, component, n, deviation, whitened, explained, identity_error) of every valid vector and component."""
    import numpy as np

    models = {}
    for dim, (n, sums) in moments(df, vec, scale, offset).items():
        v = summed(df, vec, dim, dim, lambda x, n=n, sums=sums: centred(x, n, sums), scale, offset) / n
        values, axes = components_of(v, min(components, dim))
        trace = float(np.trace(v))
        live = values > RANK * max(float(values[0]), np.finfo(float).tiny)
        turn = np.where(live, axes / np.sqrt(np.where(live, values, 1.0)), 0.0)

        def ones(x, n=n, sums=sums, turn=turn):
            return np.hstack([centred(x, n, sums) @ turn, np.ones((len(x), 1))])

        m = summed(df, vec, dim, turn.shape[1] + 1, ones, scale, offset) / n
        cov = m[:-1, :-1] - np.outer(m[-1, :-1], m[-1, :-1])
        error = float(np.abs(cov - np.diag(live.astype(float))).max())
        models[dim] = n, sums, turn, np.where(live, values / trace if trace else 0.0, 0.0), error

    def run(batches):
        import pyarrow as pa

        for b in batches:
            for rows, x in matrices(b.column(1), None, scale, offset):
                n, sums, turn, share, error = models[x.shape[1]]
                k = turn.shape[1]
                place = np.repeat(np.arange(len(rows)), k)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(rows)).take(pa.array(place)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))),
                     pa.array(np.full(len(place), n)), deviations(x, n, sums).take(pa.array(place)), pa.array((centred(x, n, sums) @ turn).ravel()),
                     pa.array(np.tile(share, len(rows))), pa.array(np.full(len(place), error))],
                    names=[key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, vec).mapInArrow(
        run, f"`{key}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
