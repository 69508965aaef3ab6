"""Whitening of embeddings: exact distributed covariance, eigenvectors refined from float32.

1. Sums. Per dimension the number and sum of the integer vectors ``x`` (long); sums are decimals, exact.
2. Covariance. Each task centres its vectors on the rounded means ``m`` before it multiplies,
   so ``y = x - m`` are small integers, and adds up ``y y'`` exactly: float64 products of limbs of 20
   bits, short enough that no sum rounds. Tasks emit partial sums per pair of dimensions, Spark adds
   them (a table of pairs, whatever the number of rows). What is left of the centre, ``S/n - m``, is taken off in
   whole numbers, so the covariance is rounded once, to extended precision.
3. Eigenvectors. float32 eigenvectors of the covariance are corrected by the iteration of Ogita and
   Aishima in higher precision: with ``R = I - X'X`` and ``S = X'VX``, the eigenvalues are
   ``s_ii / (1 - r_ii)`` and ``X`` becomes ``X + XE``, matrix products only, with
   ``e_ij = (s_ij + l_j r_ij) / (l_j - l_i)``; where two eigenvalues are closer than the error bound,
   ``e_ij = r_ij / 2``, which keeps the vectors orthonormal but does not tell them apart. Such a cluster is a
   sub-solve: the covariance, less the cluster's mean eigenvalue, projected on its vectors is a
   small matrix in which their gaps are large; its own eigenvectors, again float32 refined by the same
   iteration, turn the cluster's vectors.
4. Whitening. Row by row ``(x - S/n) v / sqrt(e)``, and a pass over all rows that measures the
   covariance of the result.

The driver holds matrices of the dimension alone. Vectors that are NULL, empty, hold NULL or non-finite
entries, or entries of 2**55 and more (differences of their ``x`` fit no long), take no part; nor do vectors of another length than
the most frequent one (the longer, if two are). Equal rows count as often as they stand; NULL ids
are kept. Components without variance (an eigenvalue within rounding of 0) have NULL ``whitened`` and
no part in ``identity_error``; without any component it is 0. No vectors: no rows. Further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.llm.common import read_table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# rows that one block of a task multiplies, and bits of a limb: |limb| <= 2**19, so sums stay below 2**51
_ROWS = 8192
_LIMB = 20
# sums travel as high and low parts, so that their totals fit decimal(38)
_SPLIT = 60
_LONG = float(1 << 61)
Wide = np.longdouble


class Whitener(NamedTuple):
    """Components of the fit list: ``vectors`` (a column each) and eigenvalues, largest first."""

    n: int
    sums: list[int]
    centre: np.ndarray
    rest: np.ndarray
    vectors: np.ndarray
    values: np.ndarray
    explained: np.ndarray


# ---------------------------------------------------------------- rows


def scaled(embedding: Column) -> Column:
    """The vector as ``floor(64 c) + 1000000``, NULL where it takes no part."""
    usable = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double") * SCALE) < F.lit(_LONG))
    x = F.transform(embedding, lambda c: F.floor(c.cast("double") * SCALE).cast("long") + F.lit(SHIFT).cast("long"))
    return F.when((F.size(embedding) > 0) & F.forall(embedding, usable), x)


def _matrix(lists: pa.Array, size: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def _sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and sums by dimension, of the most frequent length; (0, []) without any."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            lists = batch.column("x")
            lengths = lists.value_lengths().to_numpy()
            for size in np.unique(lengths).tolist():
                x = _matrix(lists.filter(pa.array(lengths == size)), size)
                n, total = found.get(size, (0, np.zeros(size, object)))
                # 32 bits and the rest apart: no sum over a batch overflows
                total = total + (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
                found[size] = n + len(x), total
        for size, (n, total) in found.items():
            high = [int(t) >> _SPLIT for t in total]
            low = [int(t) & ((1 << _SPLIT) - 1) for t in total]
            kinds = pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()
            columns = [size] * size, list(range(size)), [n] * size, high, low
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["size", "i", "n", "high", "low"])

    parts = vectors.mapInArrow(partial, "size int, i int, n long, high long, low long")
    exact = [F.sum(F.col(c).cast("decimal(28,0)")).alias(c) for c in ("high", "low")]
    totals = parts.groupBy("size", "i").agg(F.sum("n").alias("n"), *exact)
    most = totals.filter("i = 0").orderBy(F.desc("n"), F.desc("size")).select("size").limit(1)
    rows = totals.join(F.broadcast(most), "size").orderBy("i").collect()  # a row a dimension
    return (int(rows[0]["n"]), [(int(r["high"]) << _SPLIT) + int(r["low"]) for r in rows]) if rows else (0, [])


def exact_gram(y: np.ndarray) -> np.ndarray:
    """``y' y`` of integers as Python integers, from float64 products that do not round."""
    limbs, rest = [], y
    while True:
        low = ((rest + (1 << (_LIMB - 1))) & ((1 << _LIMB) - 1)) - (1 << (_LIMB - 1))
        limbs.append(low.astype(np.float64))
        rest = (rest - low) >> _LIMB
        if not rest.any():
            break
    out = np.zeros((y.shape[1],) * 2, object)
    for a, left in enumerate(limbs):
        for b, right in enumerate(limbs):
            for k in range(0, len(y), _ROWS):
                part = (left[k : k + _ROWS].T @ right[k : k + _ROWS]).astype(np.int64).astype(object)
                out += part * (1 << (_LIMB * (a + b)))
    return out


def _pair_sums(batches_of: DataFrame, size: int, rows_of, kind: str) -> DataFrame:
    """Sums over all rows of per-task (i, j, high, low) or (i, j, value) tables, by pair of dimensions."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            part = rows_of(batch)
            total = part if total is None else total + part
        if total is None:
            return
        i, j = (k.ravel() for k in np.indices(total.shape))
        if kind == "exact":
            values = [int(v) for v in total.ravel()]
            columns = {"high": pa.array([v >> _SPLIT for v in values], pa.decimal128(38)), "low": pa.array([v & ((1 << _SPLIT) - 1) for v in values], pa.decimal128(38))}
        else:
            columns = {"value": pa.array(total.ravel(), pa.float64())}
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *columns.values()], names=["i", "j", *columns])

    exact = kind == "exact"
    parts = batches_of.mapInArrow(partial, "i int, j int, " + ("high decimal(38,0), low decimal(38,0)" if exact else "value double"))
    return parts.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in (("high", "low") if exact else ("value",))])


def _rounded_mean(n: int, sums: list[int]) -> list[int]:
    return [(2 * s + n) // (2 * n) for s in sums]


def covariance(vectors: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The covariance (divisor n) in extended precision; every entry is rounded once."""
    size, mean = len(sums), _rounded_mean(n, sums)
    centre = np.array(mean, np.int64)

    def gram(batch: pa.RecordBatch) -> np.ndarray:
        return exact_gram(_matrix(batch.column("x"), size) - centre)

    total = np.zeros((size, size), object)
    for r in _pair_sums(vectors, size, gram, "exact").collect():  # a row for a pair of dimensions
        total[r["i"], r["j"]] = (int(r["high"]) << _SPLIT) + int(r["low"])
    left = [s - n * m for s, m in zip(sums, mean, strict=True)]
    out = np.zeros((size, size), Wide)
    for i in range(size):
        for j in range(size):
            # n^2 times the covariance, a whole number
            out[i, j] = _quotient(n * total[i, j] - left[i] * left[j], n * n)
    return out


def _quotient(a: int, b: int) -> Wide:
    """a / b rounded to extended precision."""
    sign, a = (-1, -a) if a < 0 else (1, a)
    if not a:
        return Wide(0)
    shift = max(0, 80 - a.bit_length() + b.bit_length())
    q = (a << shift) // b
    cut = max(0, q.bit_length() - 64)
    q = (q + ((1 << cut) >> 1)) >> cut
    whole = Wide(q >> 32) * Wide(1 << 32) + Wide(q & 0xFFFFFFFF)
    return Wide(sign) * np.ldexp(whole, cut - shift)


# ---------------------------------------------------------------- eigenvectors


def _step(v: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, Wide]:
    """One correction of Ogita and Aishima: new vectors, eigenvalues, S, and the bound below which two eigenvalues count as equal."""
    n = len(x[0])
    r = np.eye(n, dtype=x.dtype) - x.T @ x
    s = x.T @ (v @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    bound = 2 * (np.sqrt((off * off).sum()) + np.abs(values).max() * np.sqrt((r * r).sum()))
    gap = values[None, :] - values[:, None]
    far = np.abs(gap) > bound
    e = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1), r / 2)
    return x + x @ e, values, s, bound


def _iterate(v: np.ndarray, x: np.ndarray, most: int = 12) -> tuple[np.ndarray, np.ndarray, Wide]:
    """Corrections until the error bound stops falling."""
    values, bound, before = np.diag(x.T @ v @ x), Wide(np.inf), Wide(np.inf)
    tiny = Wide(len(x)) * np.finfo(Wide).eps
    for _ in range(most):
        x, values, _, bound = _step(v, x)
        if bound <= tiny * np.abs(values).max() or bound >= before / 2:
            break
        before = bound
    return x, values, bound


def _clusters(values: np.ndarray, bound: Wide) -> list[list[int]]:
    """Runs of eigenvalues (by order) that are nearer to each other than the bound."""
    order = np.argsort(-values)
    runs = [[int(order[0])]]
    for a, b in zip(order[:-1], order[1:], strict=True):
        if values[a] - values[b] <= bound:
            runs[-1].append(int(b))
        else:
            runs.append([int(b)])
    return runs


def eigenvectors(v: np.ndarray, depth: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Unit eigenvectors (columns) and eigenvalues of a symmetric extended-precision matrix, largest first."""
    size = len(v)
    scale = np.abs(v).max()
    if size == 1 or not scale:
        return np.eye(size, dtype=Wide), np.diag(v).copy()
    v = v / scale
    x = np.linalg.eigh(v.astype(np.float32))[1].astype(Wide)
    values, bound, before = np.diag(v), Wide(0), Wide(np.inf)
    for _ in range(6):
        x, values, bound = _iterate(v, x)
        # below this two eigenvalues differ by rounding alone, and any basis of their space is as good
        floor = 4 * Wide(size) * np.finfo(Wide).eps * np.abs(values).max()
        runs = [run for run in _clusters(values, bound) if len(run) > 1 and values[run].max() - values[run].min() > floor or len(run) > 1 and bound > floor]
        if not runs or bound <= floor or depth >= 4 or bound >= before / 2:
            break
        before = bound
        for run in runs:
            if len(run) == size:
                # nothing to project away: float64 vectors in place of the float32 ones
                x = np.linalg.eigh(v.astype(np.float64))[1].astype(Wide)
                continue
            some = x[:, run]
            middle = values[run].mean()
            small = some.T @ (v @ some) - middle * (some.T @ some)
            x[:, run] = some @ eigenvectors((small + small.T) / 2, depth + 1)[0]
    # corrections between near eigenvalues are large against their gap: the vectors stay eigenvectors, but lose right angles
    for _ in range(2):
        x = x + x @ (np.eye(size, dtype=Wide) - x.T @ x) / 2
    values = ((x * (v @ x)).sum(axis=0)) * scale
    order = np.argsort(-values, kind="stable")
    return x[:, order], values[order]


# ---------------------------------------------------------------- fit and use


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitener | None:
    """Components of vectors (a column ``x``, as :func:`scaled` gives it); None without vectors."""
    n, sums = _sums(vectors)
    if not n:
        return None
    vectors = vectors.filter(F.size("x") == len(sums))
    v = covariance(vectors, n, sums)
    x, values = eigenvectors(v)
    trace = np.diag(v).sum()
    mean = _rounded_mean(n, sums)
    rest = np.array([float(_quotient(s - n * m, n)) for s, m in zip(sums, mean, strict=True)])
    k = min(components, len(sums))
    # an eigenvalue within rounding of 0 is no variance
    none = values <= Wide(len(sums)) * np.finfo(np.float64).eps * max(values[0], Wide(0))
    kept = np.where(none, 0, values)[:k].astype(np.float64)
    explained = (np.where(none, 0, values)[:k] / trace if trace else np.zeros(k)).astype(np.float64)
    return Whitener(n, sums, np.array(mean, np.int64), rest, x[:, :k].astype(np.float64), kept, explained)


def _project(w: Whitener, x: np.ndarray) -> np.ndarray:
    """Whitened rows; NaN in components without variance."""
    y = (x - w.centre).astype(np.float64) - w.rest
    return (y @ w.vectors) / np.sqrt(np.where(w.values > 0, w.values, np.nan))


def deviation(w: Whitener, x: np.ndarray) -> list[int | None]:
    """Per row the exact sum of ``(n x - S)^2``; None beyond a long."""
    left = np.array([s - w.n * int(m) for s, m in zip(w.sums, w.centre, strict=True)], object)
    y = x - w.centre
    most = w.n * int(np.abs(y).max(initial=0)) + max(map(abs, left.tolist()))
    if most * most * len(left) < 1 << 62:
        d = w.n * y - left.astype(np.int64)
        return (d * d).sum(axis=1).tolist()
    d = y.astype(object) * w.n - left
    return [int(t) if t < 1 << 63 else None for t in (d * d).sum(axis=1)]


def identity_error(w: Whitener, vectors: DataFrame) -> float:
    """Largest absolute entry of the whitened rows' covariance (divisor n) less the identity, measured over all rows."""
    real = np.flatnonzero(w.values > 0)
    if not len(real):
        return 0.0

    def gram(batch: pa.RecordBatch) -> np.ndarray:
        z = _project(w, _matrix(batch.column("x"), len(w.sums)))[:, real]
        z = np.concatenate([z, np.ones((len(z), 1))], axis=1)  # the last column holds the sums
        return z.T @ z

    k = len(real) + 1
    total = np.zeros((k, k))
    for r in _pair_sums(vectors, k, gram, "float").collect():  # a row for a pair of components
        total[r["i"], r["j"]] = r["value"]
    mean = total[:-1, -1] / w.n
    return float(np.abs(total[:-1, :-1] / w.n - np.outer(mean, mean) - np.eye(k - 1)).max())


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of rows (vec_id, embedding)."""
    slim = rows.select(F.col("vec_id").cast("long").alias("vec_id"), scaled(F.col("embedding")).alias("x")).filter("x is not null")
    w = fit(slim.select("x"), components)
    if w is None:
        return rows.sparkSession.createDataFrame([], OUT)
    slim = slim.filter(F.size("x") == len(w.sums))
    error = identity_error(w, slim.select("x"))
    k, size = len(w.values), len(w.sums)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, _ROWS // 4):
                batch = whole.slice(at, _ROWS // 4)
                x = _matrix(batch.column("x"), size)
                z = _project(w, x).ravel()
                each = pa.array(np.repeat(np.arange(len(x)), k))
                n = len(z)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))), pa.array(np.full(n, w.n)),
                     pa.array(deviation(w, x), pa.int64()).take(each), pa.array(z, from_pandas=True), pa.array(np.tile(w.explained, len(x))), pa.array(np.full(n, error))],
                    names=[c.split()[0] for c in OUT.split(", ")],
                )

    return slim.mapInArrow(project, OUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 32 largest components of every usable vector of ``embeddings``."""
    return whiten(read_table(spark, sf_dir, "embeddings"))
