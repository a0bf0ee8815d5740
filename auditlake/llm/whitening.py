"""Embedding whitening by a bidiagonal qd solver.

Entries become whole numbers x = floor(1024 c) + 100000, so sums and squared deviations are exact.
The covariance matrix is never formed:

1. Each task centres its rows and folds them, block by block, into an upper triangle R
   by QR; the triangles are joined up in groups of `FAN` in Spark until few are left.
2. Householder reflections from both sides bring R to an upper bidiagonal B.
3. dqds (differential qd with shifts) finds the squared singular values of B, small ones as
   accurately as large ones: it only adds, multiplies and divides positive numbers.
4. For each value a stationary and a progressive qd transform with that shift meet in a
   twisted factorisation of B'B; the twist of least residual gives the direction by products
   alone. Directions of values too close to be told apart are made orthogonal by plane
   rotations (one-sided Jacobi on B).

A row is whitened by its centred numbers' product with the leading directions, over the root of the
eigenvalue. Only triangles (dimensions squared numbers) reach the driver.

Defined cases: rows whose vector is null, empty, or holds null or non-finite entries, or entries whose
whole number does not fit 53 bits, are left out; where lengths differ, only the
most frequent length (of equals the greater) is whitened and the others are left out. Components without
variance have no direction and are left out, so a single row or equal rows give no
result row. Null and repeated ids are carried through: each row is its own. Columns beyond id
and vector are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auditlake.llm.common import pieces, read
from auditlake.operators.lookup import materialize
from auditlake.session import prepare

EPS = np.finfo(float).eps
QR_ROWS = 2048
FAN = 32
LOW_BITS = 28


@dataclass(frozen=True)
class Settings:
    components: int = 8
    scale: float = 1024.0
    offset: int = 100_000


# ------------------------------------------------------------ small dense solver
def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, upper diagonal, V) with r = U B V'."""
    b = r.astype(float).copy()
    n = b.shape[1]
    v = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = math.sqrt(float(x @ x))
        if size == 0.0:
            return None
        w = x.copy()
        w[0] += math.copysign(size, x[0])
        return w / math.sqrt(float(w @ w))

    for k in range(n):
        if (w := reflector(b[k:, k])) is not None:
            b[k:, k:] -= 2 * np.outer(w, w @ b[k:, k:])
        if k + 2 < n and (w := reflector(b[k, k + 1:])) is not None:
            b[k:, k + 1:] -= 2 * np.outer(b[k:, k + 1:] @ w, w)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ w, w)
    return np.diag(b).copy(), np.diag(b, 1).copy(), v


def qd_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], list[float]]:
    """One dqds transform: (q, e) of the next matrix, and the d of each row; a negative d says
    that the shift was beyond the least value."""
    d, nq, ne, ds = q[0] - shift, [], [], [q[0] - shift]
    for i, off in enumerate(e):
        top = d + off
        ratio = q[i + 1] / top if top > 0 else 0.0
        nq.append(top)
        ne.append(off * ratio)
        d = d * ratio - shift if top > 0 else q[i + 1] - shift
        ds.append(d)
    nq.append(d)
    return nq, ne, ds


def dqds(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squared singular values, falling, of the bidiagonal matrix whose squared diagonal is q and squared
    upper diagonal e."""
    found: list[float] = []
    todo = [(q.tolist(), e.tolist(), 0.0)]
    tiny = (10 * EPS) ** 2
    while todo:
        q, e, base = todo.pop()
        for _ in range(200 * (len(q) + 1)):
            cut = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= tiny * (base + min(q[i], q[i + 1]))
                        or e[i] < 1e-300), None)
            if cut is not None:
                todo += [(q[:cut + 1], e[:cut], base), (q[cut + 1:], e[cut + 1:], base)]
                break
            if len(q) == 1:
                found.append(base + max(q[0], 0.0))
                break
            if q[0] < q[-1]:            # small values are found at the end: read the matrix from its other corner
                q, e = q[::-1], e[::-1]
            q, e, ds = qd_step(q, e, 0.0)
            least = min(ds)
            if least > 0:
                safe = 1 / sum(1 / d for d in ds)              # never beyond the least value
                for shift in (least - e[-1], 0.9 * least, safe * (1 - 4 * EPS)):
                    if shift > 0:
                        nq, ne, nd = qd_step(q, e, shift)
                        if min(nd) >= 0:
                            q, e, base = nq, ne, base + shift
                            break
        else:
            raise ArithmeticError("qd iterations did not converge")
    return np.sort(np.array(found))[::-1]


def twisted(q: np.ndarray, e: np.ndarray, value: float) -> np.ndarray:
    """The unit vector z with B'B z = value z, from the twisted factorisation of least residual."""
    n = len(q)
    floor = EPS * EPS * (float(q.max()) + 1e-300)
    diag = np.maximum(q, floor)
    lower = np.sqrt(e / diag[:-1]) if n > 1 else np.zeros(0)
    solid = lambda x: x if abs(x) > floor else math.copysign(floor, x or 1.0)
    s, plus = np.empty(n), np.empty(max(n - 1, 0))
    s[0] = -value
    for i in range(n - 1):
        pivot = solid(s[i] + diag[i])
        plus[i] = diag[i] * lower[i] / pivot
        s[i + 1] = plus[i] * lower[i] * s[i] - value
    p, minus = np.empty(n), np.empty(max(n - 1, 0))
    p[-1] = diag[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = solid(diag[i] * lower[i] ** 2 + p[i + 1])
        minus[i] = diag[i] * lower[i] / pivot
        p[i] = p[i + 1] * (diag[i] / pivot) - value
    residual = np.abs(s + p + value)
    z = np.zeros(n)
    r = int(np.argmin(residual))
    z[r] = 1.0
    for i in range(r - 1, -1, -1):
        z[i] = -plus[i] * z[i + 1]
        if abs(z[i]) > 1e100:
            z /= abs(z[i])
    for i in range(r, n - 1):
        z[i + 1] = -minus[i] * z[i]
        if abs(z[i + 1]) > 1e100:
            z /= abs(z[i + 1])
    return z / math.sqrt(float(z @ z))


def directions(r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values of r, falling; right singular vectors as columns)."""
    size = float(np.abs(r).max()) if r.size else 0.0
    n = r.shape[1]
    if size == 0.0:
        return np.zeros(n), np.eye(n)
    a, b, v = bidiagonal(r / size)
    q, e = a * a, b * b
    values = dqds(q, e)
    sign_a = np.where(a < 0, -1.0, 1.0)
    # B'B has a_i b_i beside its diagonal; the factorisation takes roots of squares, so signs go to the vectors
    beside = sign_a[:-1] * np.where(b < 0, -1.0, 1.0)
    signs = np.concatenate([[1.0], np.cumprod(beside)])
    z = np.stack([twisted(q, e, value) for value in values], 1) * signs[:, None]
    z, upper = np.linalg.qr(z)
    z *= np.where(np.diag(upper) < 0, -1.0, 1.0)
    z = rotated(np.diag(a) + np.diag(b, 1), z)
    return values * size * size, v @ z


def rotated(b: np.ndarray, z: np.ndarray, sweeps: int = 30) -> np.ndarray:
    """Plane rotations of z's columns until the columns of b z are orthogonal; columns that are so
    already stay as they are."""
    w = b @ z
    tolerance = 4 * EPS * math.sqrt(len(b))
    floor = EPS * np.linalg.norm(w, axis=0).max()
    for _ in range(sweeps):
        sizes = np.linalg.norm(w, axis=0)
        dots = np.abs(np.triu(w.T @ w, 1))
        close = np.argwhere(dots > tolerance * np.maximum(np.outer(sizes, sizes), floor * floor))
        if not len(close):
            break
        for i, j in close.tolist():
            x, y, xy = float(w[:, i] @ w[:, i]), float(w[:, j] @ w[:, j]), float(w[:, i] @ w[:, j])
            if abs(xy) <= tolerance * max(math.sqrt(x * y), floor * floor):
                continue
            turn = (y - x) / (2 * xy)
            t = math.copysign(1.0, turn) / (abs(turn) + math.hypot(1.0, turn))
            c = 1 / math.hypot(1.0, t)
            for m in (w, z):
                m[:, i], m[:, j] = c * m[:, i] - c * t * m[:, j], c * t * m[:, i] + c * m[:, j]
    order = np.argsort(-np.linalg.norm(w, axis=0), kind="stable")
    return z[:, order]


# ----------------------------------------------------------------- Spark stages
def numbers(batch: pa.RecordBatch, s: Settings) -> list[np.ndarray | None]:
    """The whole numbers of each row's vector, or None where it is left out."""
    column = batch.column("entries")
    sizes = set(column.value_lengths().to_pylist())
    if len(sizes) == 1 and column.null_count == 0 and column.flatten().null_count == 0 and min(sizes):
        scaled = np.floor(column.flatten().to_numpy().reshape(len(column), -1) * s.scale)
        fits = np.isfinite(scaled).all(1) & (np.abs(scaled).max(1) < 2.0 ** 53 - s.offset)
        whole = np.where(fits[:, None], scaled, 0).astype(np.int64) + s.offset
        return [x if ok else None for x, ok in zip(whole, fits.tolist())]
    out = []
    for entries in column.to_pylist():
        x = None
        if entries and None not in entries:
            scaled = np.floor(np.array(entries, np.float64) * s.scale)
            if np.isfinite(scaled).all() and np.abs(scaled).max() < 2.0 ** 53 - s.offset:
                x = scaled.astype(np.int64) + s.offset
        out.append(x)
    return out


def vectors_of(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return vectors.select(F.col(id_col).alias("vec"), F.col(vector_col).cast("array<double>").alias("entries"))


def fit_sums(rows: DataFrame, s: Settings) -> tuple[int, list[int]]:
    """(n, exact sums by dimension) of the vectors of the most frequent length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, list] = {}
        for batch in batches:
            for small in pieces(batch):
                by_size: dict[int, list] = {}
                for x in numbers(small, s):
                    if x is not None:
                        by_size.setdefault(len(x), []).append(x)
                for size, xs in by_size.items():
                    held = seen.setdefault(size, [0, [0] * size])
                    held[0] += len(xs)
                    held[1] = [a + b for a, b in zip(held[1], np.stack(xs).sum(0).tolist())]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.int32()), pa.array([h[0] for h in seen.values()], pa.int64()),
             pa.array([list(map(str, h[1])) for h in seen.values()], pa.list_(pa.string()))], names=["size", "n", "sums"])

    parts, _ = materialize(rows.mapInArrow(run, "size int, n long, sums array<string>"), "whitening-sums")
    most = (parts.groupBy("size").agg(F.sum("n").alias("n")).orderBy(F.col("n").desc(), F.col("size").desc()).first())
    if most is None:
        return 0, []
    sums = (parts.where(F.col("size") == most["size"]).select(F.posexplode("sums"))
            .groupBy("pos").agg(F.sum(F.col("col").cast("decimal(38,0)")).alias("total")).collect())     # a row for each dimension
    return int(most["n"]), [int(r["total"]) for r in sorted(sums)]


def centred(xs: list[np.ndarray], n: int, sums: list[int]) -> np.ndarray:
    """n x - S, exact: whole numbers of 64 bits, or Python's where those could overflow."""
    x = np.stack(xs)
    if n * int(np.abs(x).max()) + max(map(abs, sums)) < 2 ** 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def squares(y: np.ndarray) -> list[int]:
    """Exact sum of squares of each row. Numbers are split at `LOW_BITS` bits, so that products fit 64 bits."""
    if y.dtype == object or np.abs(y).max() >= 2 ** (2 * LOW_BITS) or y.shape[1] > 64:
        return [sum(v * v for v in map(int, row)) for row in y]
    high, low = y >> LOW_BITS, y & (1 << LOW_BITS) - 1
    parts = [(a * b).sum(1).tolist() for a, b in ((high, high), (high, low), (low, low))]
    return [(a << 2 * LOW_BITS) + (b << LOW_BITS + 1) + c for a, b, c in zip(*parts)]


def joined(triangles: list[np.ndarray], dims: int) -> np.ndarray:
    r = np.linalg.qr(np.concatenate(triangles), mode="r")
    return np.concatenate([r, np.zeros((dims - len(r), dims))]) if len(r) < dims else r


def fit_triangle(rows: DataFrame, n: int, sums: list[int], s: Settings) -> np.ndarray:
    """R of the QR factorisation of all centred rows."""
    dims = len(sums)
    schema = "part long, r array<double>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, held = np.zeros((dims, dims)), []
        for batch in batches:
            for small in pieces(batch):
                xs = [x for x in numbers(small, s) if x is not None and len(x) == dims]
                if xs:
                    held.append((centred(xs, n, sums) / n).astype(float))
                if sum(map(len, held)) >= QR_ROWS:
                    r, held = joined([r, *held], dims), []
        r = joined([r, *held], dims)
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()], pa.int64()),
                                          pa.array([r.ravel().tolist()], pa.list_(pa.float64()))], names=["part", "r"])

    def join(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("part").to_numpy())
        stack = [np.array(table.column("r")[int(k)].as_py()).reshape(dims, dims) for k in order]
        return pa.table({"part": pa.array([table.column("part")[int(order[0])].as_py() // FAN], pa.int64()),
                         "r": pa.array([joined(stack, dims).ravel().tolist()], pa.list_(pa.float64()))})

    found, seen = materialize(rows.mapInArrow(run, schema), "whitening-r", n=F.count(F.lit(1)))
    while seen["n"] > FAN:
        group = F.floor(F.col("part") / FAN).alias("group")
        found, seen = materialize(found.groupBy(group).applyInArrow(join, schema), "whitening-r", n=F.count(F.lit(1)))
    triangles = [np.array(r["r"]).reshape(dims, dims) for r in sorted(found.collect(), key=lambda r: r["part"])]   # FAN at most
    return joined(triangles, dims)


def whiten(vectors: DataFrame, s: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n, deviation decimal(38,0), white, explained arrays by component, identity_error) of every row
    that is not left out."""
    spark = prepare(vectors.sparkSession)
    rows = vectors_of(vectors, id_col, vector_col)
    schema = "vec string, deviation string, white array<double>"
    id_type = vectors.schema[id_col].dataType
    n, sums = fit_sums(rows, s)
    dims = len(sums)
    values, vectors_ = directions(fit_triangle(rows, n, sums, s) / math.sqrt(n)) if n else (np.zeros(0), np.zeros((0, 0)))
    trace = float(values.sum())
    used = int((values[:s.components] > trace * dims * EPS * EPS).sum()) if trace > 0 else 0
    weights = spark.sparkContext.broadcast(vectors_[:, :used] / np.sqrt(values[:used]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for small in pieces(batch):
                found = numbers(small, s)
                own = [k for k, x in enumerate(found) if x is not None and len(x) == dims]
                if not own:
                    continue
                y = centred([found[k] for k in own], n, sums)
                white = (y / n).astype(float) @ weights.value
                yield pa.RecordBatch.from_arrays(
                    [small.column("vec").take(pa.array(own)), pa.array(list(map(str, squares(y))), pa.string()),
                     pa.array(white.tolist(), pa.list_(pa.float64()))], names=["vec", "deviation", "white"])

    made, _ = materialize(rows.withColumn("vec", F.col("vec").cast("string")).mapInArrow(run, schema), "whitened")
    made = made.select(F.col("vec").cast(id_type).alias(id_col), F.lit(n).cast("long").alias("n"),
                       F.col("deviation").cast("decimal(38,0)").alias("deviation"), "white")
    pairs = [(i, j) for i in range(used) for j in range(i, used)]
    white = [F.col("white")[i] for i in range(used)]
    error = 0.0
    if used:
        means = made.agg(*[F.avg(w).alias(f"m{i}") for i, w in enumerate(white)]).first()
        cov = made.agg(*[F.avg((white[i] - F.lit(means[i])) * (white[j] - F.lit(means[j]))).alias(f"c{i}_{j}") for i, j in pairs]).first()
        error = max(abs(c - (i == j)) for c, (i, j) in zip(cov, pairs))
    shares = F.array(*[F.lit(float(v / trace)) for v in values[:used]]).cast("array<double>")
    return made.select("*", shares.alias("explained"), F.lit(float(error)).alias("identity_error"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each vector and component. `deviation` is null where it is beyond a long."""
    made = whiten(read(spark, sf_dir, "embeddings"))
    part = F.posexplode(F.arrays_zip("white", "explained")).alias("at", "part")
    return made.select("vec_id", "n", F.expr("try_cast(deviation AS bigint)").alias("deviation"), "identity_error", part).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", F.col("part.white").alias("whitened"),
        F.col("part.explained").alias("explained"), "identity_error")
