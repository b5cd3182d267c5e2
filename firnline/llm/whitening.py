"""Embedding whitening by a bidiagonal qd solver.

The covariance is never formed. Centred rows are reduced block by block to the triangle R of a QR decomposition
(every task folds its batches into one R, and rounds of ``FAN`` triangles a group fold those into one), so that
``V = R'R / n``. R is turned into a bidiagonal by Householder reflections; dqds finds all its singular values to high
relative accuracy; a twisted factorisation of ``B'B - lambda`` gives each wanted direction, and the reflections carry it
back. What reaches the driver is one R, whose size follows the dimension, not the rows.

Entries become whole numbers ``floor(scale * c) + shift`` first, so that the sums and ``n * x - S`` are exact and
centring rounds once.

Cases: vectors that are null, empty, or hold a null, non-finite or too large entry (``|c| >= 2^30``) are dropped; where lengths
differ the commonest one (of ties the longest) is kept and the others are dropped; repeated rows and null ids count like any
other row; equal eigenvalues get orthogonal directions; components whose eigenvalue is zero (fewer distinct rows or
dimensions than components) are left out, so a table of equal vectors, of one row, or none gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import bounded_batches, per_batch
from firnline.session import stage

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
FAN = 32
LARGEST = float(1 << 30)
EPS = float(np.finfo(float).eps)


# --- small dense linear algebra, on one triangle -----------------------------------------------------------------

def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v of unit length with ``x - 2 v (v.x) = (alpha, 0, ...)``, and alpha."""
    norm = np.linalg.norm(x)
    if norm == 0 or not np.any(x[1:]):
        return np.zeros_like(x), float(x[0])
    alpha = -norm if x[0] > 0 else norm
    v = x.copy()
    v[0] -= alpha
    return v / np.linalg.norm(v), float(alpha)


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and Q of ``r = U B Q'``, B upper bidiagonal."""
    work, size = r.astype(float).copy(), r.shape[1]
    a, b, q = np.zeros(size), np.zeros(max(0, size - 1)), np.eye(size)
    for j in range(size):
        v, a[j] = reflector(work[j:, j])
        work[j:, j:] -= 2 * np.outer(v, v @ work[j:, j:])
        if j + 1 < size:
            v, b[j] = reflector(work[j, j + 1:])
            work[j:, j + 1:] -= 2 * np.outer(work[j:, j + 1:] @ v, v)
            q[:, j + 1:] -= 2 * np.outer(q[:, j + 1:] @ v, v)
    return a, b, q


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], bool]:
    """One differential qd transform; false where the shift was above the smallest value."""
    new_q, new_e, d = [], [], q[0] - shift
    for k in range(len(e)):
        if d < 0:
            return q, e, False
        total = d + e[k]
        ratio = q[k + 1] / total if total > 0 else 0.0
        new_q.append(total)
        new_e.append(e[k] * ratio)
        d = d * ratio - shift
    return new_q + [d], new_e, d >= 0


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The squares of the singular values of the bidiagonal, falling."""
    found: list[float] = []
    # (q, e, sigma, rest): a block still to do, what has been taken off it, and the rounding of that.
    blocks = [([float(x) ** 2 for x in a], [float(x) ** 2 for x in b], 0.0, 0.0)]
    while blocks:
        q, e, sigma, rest = blocks.pop()
        while q:
            if len(q) == 1:
                found.append(sigma + (q[0] + rest))
                break
            # Negligible couplings split the block.
            tiny = [k for k in range(len(e)) if e[k] <= EPS * EPS * (sigma + min(q[k], q[k + 1])) or e[k] < 1e-300]
            if tiny:
                k = tiny[-1]
                blocks.append((q[:k + 1], e[:k], sigma, rest))
                q, e = q[k + 1:], e[k + 1:]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            # The smaller eigenvalue of the trailing 2 x 2 of the block is close to the one sought and not below it.
            s, t = q[-2] + e[-1] + (e[-2] if len(e) > 1 else 0.0), q[-1]
            gap = (s - t) / 2
            off = q[-1] * e[-1] if len(q) == 2 else q[-2] * e[-1]
            low = min(q[-1], max(0.0, t - off / (abs(gap) + (gap * gap + off) ** 0.5))) if off > 0 else t
            shift, done = low * (1 - 4 * EPS), False
            for _ in range(6):
                made_q, made_e, done = _sweep(q, e, shift)
                if done:
                    break
                shift *= 0.5 if shift > EPS * sigma else 0.0
            if not done:
                shift = 0.0
                made_q, made_e, done = _sweep(q, e, 0.0)
            q, e = made_q, made_e
            total = sigma + shift
            rest += shift - (total - sigma)
            sigma = total
    return np.sort(np.maximum(found, 0.0))[::-1]


class Twisted:
    """The twisted factorisation of ``B'B - value``: top-down, bottom-up, and the row where they meet best."""

    def __init__(self, a: np.ndarray, b: np.ndarray, value: float):
        size = len(a)
        tiny = EPS * max(value, 1e-300)
        floor = np.sqrt(tiny) * EPS
        a = np.where(np.abs(a) < floor, floor, a)
        d, low = a * a, b / a[:-1]
        self.down, self.up = np.empty(size), np.empty(size)
        self.lower, self.upper = np.zeros(max(0, size - 1)), np.zeros(max(0, size - 1))
        s, p = np.empty(size), np.empty(size)
        s[0] = -value
        for k in range(size):
            self.down[k] = s[k] + d[k]
            if self.down[k] == 0:
                self.down[k] = tiny
            if k + 1 < size:
                self.lower[k] = d[k] * low[k] / self.down[k]
                s[k + 1] = self.lower[k] * low[k] * s[k] - value
        p[-1] = d[-1] - value
        self.up[-1] = p[-1] if p[-1] != 0 else tiny
        for k in range(size - 2, -1, -1):
            meet = d[k] * low[k] ** 2 + p[k + 1]
            self.up[k + 1] = meet if meet != 0 else tiny
            ratio = d[k] / self.up[k + 1]
            self.upper[k] = low[k] * ratio
            p[k] = p[k + 1] * ratio - value
        self.up[0] = p[0] if p[0] != 0 else tiny
        gamma = s + p + value
        self.at = int(np.argmin(np.abs(gamma)))
        self.meet = gamma[self.at] if gamma[self.at] != 0 else tiny

    def back(self, u: np.ndarray) -> np.ndarray:
        """y of ``N' y = u``, at unit length."""
        y = u.copy()
        for i in range(self.at - 1, -1, -1):
            y[i] -= self.lower[i] * y[i + 1]
        for i in range(self.at, len(y) - 1):
            y[i + 1] -= self.upper[i] * y[i]
        return y / np.linalg.norm(y)

    def vector(self) -> np.ndarray:
        unit = np.zeros(len(self.down))
        unit[self.at] = 1.0
        return self.back(unit)

    def solve(self, x: np.ndarray) -> np.ndarray:
        """The direction of ``(B'B - value)^-1 x``."""
        v, size, at = x.copy(), len(x), self.at
        for i in range(1, at):
            v[i] -= self.lower[i - 1] * v[i - 1]
        for i in range(size - 2, at, -1):
            v[i] -= self.upper[i] * v[i + 1]
        if at > 0:
            v[at] -= self.lower[at - 1] * v[at - 1]
        if at + 1 < size:
            v[at] -= self.upper[at] * v[at + 1]
        pivots = np.concatenate([self.down[:at], [self.meet], self.up[at + 1:]])
        v /= np.where(pivots == 0, EPS, pivots)
        return self.back(v / np.abs(v).max())


def directions(a: np.ndarray, b: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A unit eigenvector of ``B'B`` for each of the falling values, one a column."""
    rng, found = np.random.default_rng(11), []
    for i, value in enumerate(values):
        near = [z for other, z in zip(values, found) if other - value <= 1e-3 * other]
        shape = Twisted(a, b, float(value))
        z = shape.vector()
        if near or (i + 1 < len(values) and value - values[i + 1] <= 1e-3 * value):
            # Values close together: inverse iteration, kept apart from the directions found.
            z = z + 1e-3 * rng.standard_normal(len(z))
            for _ in range(4):
                z = shape.solve(z)
                for _ in range(2):
                    for other in near:
                        z = z - other * (other @ z)
                    z = z / np.linalg.norm(z)
        found.append(z)
    return np.array(found).T if found else np.zeros((len(a), 0))


@dataclass(frozen=True)
class Whitening:
    """n and S of the fitted rows, directions by column, their eigenvalues, and the trace of the covariance."""

    rows: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float


def solved(r: np.ndarray, rows: int, sums: tuple[int, ...], components: int) -> Whitening:
    a, b, q = bidiagonal(r)
    squares = dqds(a, b)
    wanted = squares[:components]
    wanted = wanted[wanted > len(a) * EPS * squares[0]] if len(squares) and squares[0] > 0 else wanted[:0]
    vectors = q @ directions(a, b, wanted)
    if len(wanted):
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(wanted))])
    return Whitening(rows, sums, vectors, wanted / rows, float(squares.sum() / rows))


# --- over the rows -----------------------------------------------------------------------------------------------

def whole_numbers(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, x): the usable rows, entries as whole numbers."""
    bad = F.exists(column, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) >= F.lit(LARGEST)))
    return vectors.filter(F.col(column).isNotNull() & (F.size(column) > 0)).filter(~bad).select(
        "vec_id", F.transform(column, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")).cast("long")
                              + F.lit(SHIFT).cast("long")).alias("x"))


def _by_length(x: pa.ListArray) -> Iterator[np.ndarray]:
    """The batch's vectors as matrices, one a length."""
    flat, lengths = x.flatten().to_numpy(zero_copy_only=False), x.value_lengths().to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for size in np.unique(lengths):
        yield flat[(starts[lengths == size][:, None] + np.arange(size)).ravel()].reshape(-1, size)


def totals(rows: DataFrame) -> tuple[int, list[int]] | None:
    """n and the exact sums of the commonest length."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for m in _by_length(batch["x"]):
                count, sums = held.get(m.shape[1], (0, [0] * m.shape[1]))
                held[m.shape[1]] = (count + len(m), [s + int(t) for s, t in zip(sums, m.sum(axis=0))])
        if held:
            yield pa.RecordBatch.from_pydict({
                "size": pa.array(held, pa.int32()), "n": pa.array([c for c, _ in held.values()], pa.int64()),
                "sums": pa.array([[Decimal(s) for s in sums] for _, sums in held.values()],
                                 pa.list_(pa.decimal128(38, 0)))})

    parts = stage(rows.select("x").mapInArrow(add, "size int, n long, sums array<decimal(38,0)>"), "sums")
    commonest = (parts.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("size")).limit(1)).collect()
    if not commonest:
        return None
    summed = (parts.filter(F.col("size") == commonest[0]["size"]).select(F.posexplode("sums").alias("at", "s"))
              .groupBy("at").agg(F.sum("s").alias("s")).orderBy("at").collect())
    return commonest[0]["n"], [int(r["s"]) for r in summed]


def exact_deviations(x: np.ndarray, rows: int, sums: np.ndarray) -> np.ndarray:
    """``n * x - S``: whole numbers, beyond 64 bits as Python's."""
    most = rows * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in sums), default=0)
    if most < 1 << 62:
        return x * np.int64(rows) - sums.astype(np.int64)
    return x.astype(object) * rows - sums


def square_sums(deviations: np.ndarray) -> list[int]:
    """The exact sum of squares of every row."""
    largest = int(np.abs(deviations).max(initial=0))
    if deviations.dtype != object and largest * largest * deviations.shape[1] >= 1 << 63:
        deviations = deviations.astype(object)
    return [int(s) for s in (deviations * deviations).sum(axis=1)]


def triangle(rows: DataFrame, n: int, sums: list[int], fan: int = FAN) -> np.ndarray:
    """R of the QR decomposition of all centred rows."""
    size, total = len(sums), np.array(sums, dtype=object)

    def fold(r: np.ndarray, block: np.ndarray) -> np.ndarray:
        return np.linalg.qr(np.vstack([r, block]), mode="r")

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, seen = np.zeros((0, size)), False
        for batch in batches:
            for m in _by_length(batch["x"]):
                if m.shape[1] == size and len(m):
                    r, seen = fold(r, exact_deviations(m, n, total).astype(float) / n), True
        if seen:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "r": pa.array([r.tobytes()], pa.binary())})

    def merge(key: tuple, group: pa.Table) -> pa.Table:
        r = np.zeros((0, size))
        for made in group.sort_by("part")["r"].to_pylist():
            r = fold(r, np.frombuffer(made).reshape(-1, size))
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "r": pa.array([r.tobytes()], pa.binary())})

    parts = stage(rows.select("x").mapInArrow(reduce_rows, "part int, r binary"), "triangles")
    groups = parts.agg(F.max("part") + 1).first()[0]
    while groups > 1:
        # Neighbours by number meet, at most ``fan`` of them, until one triangle is left.
        parts = stage(parts.groupBy(F.expr(f"part div {fan}").cast("int").alias("group")).applyInArrow(
            merge, "part int, r binary"), "triangles")
        groups = -(-groups // fan)
    return np.frombuffer(parts.first()["r"]).reshape(-1, size)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the rows of ``whole_numbers``, or None without rows."""
    bounded_batches(rows.sparkSession)
    known = totals(rows)
    if known is None:
        return None
    n, sums = known
    r = triangle(rows, n, sums)
    return solved(np.vstack([r, np.zeros((max(0, len(sums) - len(r)), len(sums)))]), n, tuple(sums), components)


def transformed(rows: DataFrame, model: Whitening) -> DataFrame:
    """(vec_id, deviation decimal(38,0), whitened array): every fitted row."""
    size, total = len(model.sums), np.array(model.sums, dtype=object)
    n, matrix = model.rows, model.vectors / np.sqrt(model.values)

    def make():
        def act(x: pa.ListArray) -> pa.Array:
            m = x.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            d = exact_deviations(m, n, total)
            # Row by row: the same vector gives the same numbers wherever it stands in a batch.
            w = np.einsum("ij,jk->ik", d.astype(float) / n, matrix)
            return pa.StructArray.from_arrays(
                [pa.array([Decimal(s) for s in square_sums(d)], pa.decimal128(38, 0)),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32()), pa.array(w.ravel()))],
                ["deviation", "whitened"])

        return act

    made = per_batch(make, "struct<deviation:decimal(38,0),whitened:array<double>>")(F.col("x"))
    return rows.filter(F.size("x") == size).select("vec_id", made.alias("w")).select("vec_id", "w.*")


def identity_error(white: DataFrame, components: int) -> float:
    """The largest entry, by size, of the whitened rows' covariance minus the identity."""
    at = [F.element_at("whitened", i + 1) for i in range(components)]
    means = white.agg(*[F.avg(c).alias(f"m{i}") for i, c in enumerate(at)]).first()
    centred = [c - F.lit(float(m)) for c, m in zip(at, means)]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    row = white.agg(*[F.avg(centred[i] * centred[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(row, pairs))


RESULT = ("vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, "
          "identity_error double")


def whitened(vectors: DataFrame, components: int = COMPONENTS, column: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per vector and component."""
    rows = whole_numbers(vectors, column)
    model = fit(rows, components)
    found = 0 if model is None else len(model.values)
    if not found:
        return vectors.sparkSession.createDataFrame([], RESULT)
    white = stage(transformed(rows, model), "whitened")
    shares = F.array(*[F.lit(float(v / model.trace)) for v in model.values])
    return (white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("at") + 1).cast("int").alias("component"),
                    F.lit(model.rows).cast("long").alias("n"), "deviation", "whitened",
                    F.element_at(shares, F.col("at") + 1).alias("explained"),
                    F.lit(identity_error(white, found)).alias("identity_error")))
