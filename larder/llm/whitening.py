"""Embedding whitening; the leading eigenpairs of the covariance by spectrum slicing.

Entries become integers, x = floor(scale * c) + shift, so that counts, sums and
products are exact: the first pass sums the entries, the second centres them at
the integer nearest the mean and multiplies; what the integer is off the mean is
taken out of the total in integers, so the covariance is that of entries centred
at the exact mean, rounded once.  Both passes are partial sums of the size of
the dimension (squared), summed again in Spark; d * (d + 1) / 2 sums come to the driver.

Slicing: the inertia of V - s, counted from an LDL^T factorisation with
diagonal pivots of order one and two, says how many eigenvalues exceed s.
Bisection by these counts isolates each leading eigenvalue; Rayleigh quotient iteration
from inside the interval converges cubically; counts just below and above the
result certify that it has the number it is given.  Eigenvalues that no count
tells apart share their interval, and their vectors are made orthogonal.

Edge cases: rows whose vector is null or empty or holds null or non-finite
entries are dropped, as are rows whose length is not the most common one (the
longest of these, if several); zero vectors, repeated rows and rows without
vec_id stay.  Entries beyond 2^40 / scale count as that bound.  Components
without variance (an eigenvalue below 1e-12 of the trace) cannot be whitened
and are not returned; so equal rows or a single row give no rows, as does an empty
table.  A deviation that is too large for a long is null.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.llm.common import materialize, release_memory

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
BOUND = 1 << 40
NO_VARIANCE = 1e-12  # of the trace


def complete(vector: Column) -> Column:
    """Not null, not empty, without null or non-finite entries."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & ~bad, F.lit(False))


def integers(batch: pa.RecordBatch, dim: int, scale: int, shift: int) -> np.ndarray:
    """floor(scale * c) + shift of a batch's vectors, as a rows x dim matrix."""
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.clip(np.floor(flat.reshape(-1, dim) * scale), -BOUND, BOUND).astype(np.int64) + shift


def exact_products(y: np.ndarray) -> np.ndarray:
    """y' y for integers: by floating point where every sum stays exact, else by Python's integers."""
    top = int(np.abs(y).max(initial=0))
    if top * top * len(y) < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    o = y.astype(object)
    return o.T.dot(o)


# ---------------------------------------------------------------- slicing


def count_above(a: np.ndarray, s: float) -> int:
    """Eigenvalues of the symmetric matrix `a` above `s`: the positive pivots of L D L' = a - s.

    Pivots are chosen over the whole rest (Bunch and Parlett): the largest diagonal entry unless an entry beside
    the diagonal is much larger; such a pair is a pivot of order two, with one eigenvalue of each sign.
    """
    m = a - s * np.eye(len(a))
    alpha, above = (1 + 17 ** 0.5) / 8, 0
    while len(m):
        diagonal = np.abs(np.diag(m))
        p = int(np.argmax(diagonal))
        if len(m) > 1:
            off = np.abs(np.triu(m, 1))
            at = int(np.argmax(off))
            i, j = divmod(at, len(m))
            if diagonal[p] < alpha * off[i, j]:
                keep = np.delete(np.arange(len(m)), [i, j])
                block = m[np.ix_([i, j], [i, j])]
                side = m[np.ix_(keep, [i, j])]
                m = m[np.ix_(keep, keep)] - side @ np.linalg.solve(block, side.T)
                m = (m + m.T) / 2
                above += 1
                continue
        pivot = m[p, p]
        if pivot == 0:  # nothing but zeros is left: eigenvalues equal to s
            return above
        above += pivot > 0
        keep = np.delete(np.arange(len(m)), p)
        side = m[keep, p]
        m = m[np.ix_(keep, keep)] - np.outer(side, side / pivot)
    return above


def isolate(a: np.ndarray, wanted: int) -> list[tuple[float, float, int, int]]:
    """Intervals (low, high, first, last) that hold the eigenvalues of these numbers (1 is the largest), and no others,
    until they hold all up to `wanted`; one to an interval, but for those that cannot be told apart."""
    radius = np.abs(a).sum(axis=1)
    top = float(radius.max(initial=0.0))
    tight = 64 * np.finfo(float).eps * max(top, np.finfo(float).tiny) * max(1, len(a)) ** 0.5
    todo, found = [(-top - tight, top + tight, 0, len(a))], []
    while todo:
        low, high, before, upto = todo.pop()  # numbers before + 1 .. upto lie in (low, high]
        if before >= wanted:
            continue
        if upto - before == 1 and high - low < 0.25 * max(abs(high), abs(low)) or high - low <= tight:
            found.append((low, high, before + 1, upto))
            continue
        mid = (low + high) / 2
        above = min(max(count_above(a, mid), before), upto)
        if above < upto:
            todo.append((low, mid, above, upto))
        if above > before:
            todo.append((mid, high, before, above))
    return sorted(found, key=lambda x: x[2])


def refine(a: np.ndarray, low: float, high: float, others: list[np.ndarray], seed: int) -> tuple[float, np.ndarray]:
    """The eigenpair in (low, high] that is orthogonal to `others`: bisected a little further by inverse iteration,
    then by Rayleigh quotients."""
    eye, top = np.eye(len(a)), np.abs(a).sum(axis=1).max()

    def clean(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for o in others:
                x = x - (o @ x) * o
        return x / np.linalg.norm(x)

    def solve(shift: float, x: np.ndarray) -> np.ndarray:
        for nudge in (0.0, 1e-15, 1e-14, 1e-13):  # an exact eigenvalue makes the matrix singular
            try:
                y = np.linalg.solve(a - (shift + nudge * top) * eye, x)
            except np.linalg.LinAlgError:
                continue
            if np.isfinite(y).all() and np.linalg.norm(y) > 0:
                return y
        return x

    x = clean(np.random.Generator(np.random.PCG64(seed)).standard_normal(len(a)))
    mid = (low + high) / 2
    for _ in range(60):  # until the quotient stays in the interval
        x = clean(solve(mid, x))
        value = float(x @ a @ x)
        if low < value <= high and np.linalg.norm(a @ x - value * x) < max(0.25 * (high - low), 1e-12 * top):
            break
    for _ in range(12):
        y = clean(solve(value, x))
        nearer = float(y @ a @ y)
        done = abs(nearer - value) <= 4e-16 * top and np.linalg.norm(a @ y - nearer * y) <= 1e-14 * top * len(a) ** 0.5
        x, value = y, nearer
        if done:
            break
    return value, x


def leading_eigenpairs(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues of a symmetric matrix, falling, and unit eigenvectors (columns), certified by counts."""
    wanted = min(wanted, len(a))
    values, vectors, top = [], [], float(np.abs(a).sum(axis=1).max(initial=0.0))
    if not top:
        return np.zeros(wanted), np.eye(len(a))[:, :wanted]
    for low, high, first, last in isolate(a, wanted):
        for steps in (8, 80):  # a neighbour very near to the interval may need it narrowed to the end
            low, high = _narrow(a, low, high, first, last, steps)
            group: list[tuple[float, np.ndarray]] = []
            for number in range(first, last + 1):
                group.append(refine(a, low, high, vectors + [v for _, v in group], number))
            group.sort(key=lambda pair: -pair[0])
            if all(certified(a, value, number, 1e-10 * top) for number, (value, _) in enumerate(group, first)):
                break
        else:
            raise ArithmeticError(f"eigenvalues {first} to {last} are not certified by the counts")
        values += [value for value, _ in group]
        vectors += [vector for _, vector in group]
    return np.array(values[:wanted]), np.array(vectors[:wanted]).reshape(-1, len(a)).T


def certified(a: np.ndarray, value: float, number: int, slack: float) -> bool:
    """Fewer than `number` eigenvalues lie above the value and at least so many not below it."""
    return count_above(a, value + slack) < number <= count_above(a, value - slack)


def _narrow(a: np.ndarray, low: float, high: float, first: int, last: int, steps: int) -> tuple[float, float]:
    """More counts, so that inverse iteration from the middle is nearer to this eigenvalue than to others."""
    for _ in range(steps):
        mid = (low + high) / 2
        above = count_above(a, mid)
        if above >= last:
            low = mid
        elif above < first:
            high = mid
        else:
            break
    return low, high


# ---------------------------------------------------------------- Spark


def _sums(vectors: DataFrame, dim: int, scale: int, shift: int, centre: np.ndarray | None = None) -> dict[int, int]:
    """Totals by place: of entries (centre None), else of centred entries' products (place i * dim + j, i <= j)."""
    ii, jj = np.triu_indices(dim)
    places = np.arange(dim) if centre is None else ii * dim + jj

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(places), object)
        for b in batches:
            x = integers(b, dim, scale, shift)
            if centre is None:
                total += x.sum(axis=0).astype(object)  # at most 2^41 a row
            else:
                total += exact_products(x - centre)[ii, jj]
        yield pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int64()), pa.array([str(v) for v in total], pa.string())], ["place", "total"])

    parts = vectors.select("vector").mapInArrow(run, "place long, total string")
    rows = parts.groupBy("place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    return {r["place"]: int(r["total"]) for r in rows}


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE,
           shift: int = SHIFT) -> DataFrame:
    """`vec_id`, n, deviation, `whitened` (array, component 1 first), `explained` (array) and identity_error per row."""
    fit = rows.select("vec_id", F.col(f"`{vector}`").cast("array<double>").alias("vector")).where(complete(F.col("vector")))
    lengths = fit.groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not lengths:
        return fit.sparkSession.createDataFrame([], _schema(rows))
    dim, n = lengths[0]["d"], lengths[0]["count"]
    fit = fit.where(F.size("vector") == dim)
    sums = _sums(fit, dim, scale, shift)
    total = [sums[k] for k in range(dim)]
    centre = np.array([round(s / n) for s in total], np.int64)
    products = _sums(fit, dim, scale, shift, centre)
    off = [s - n * int(c) for s, c in zip(total, centre, strict=True)]  # what the centres are off the means, times n
    covariance = np.zeros((dim, dim))
    for place, p in products.items():
        i, j = divmod(place, dim)
        covariance[i, j] = covariance[j, i] = (n * p - off[i] * off[j]) / (n * n)
    values, vectors = leading_eigenpairs(covariance, components)
    trace = float(np.trace(covariance))
    kept = values > NO_VARIANCE * trace
    values, vectors = values[kept], vectors[:, kept]
    scaled, mean_off = vectors / np.sqrt(values), np.array([o / n for o in off])
    explained = [float(v / trace) for v in values]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = integers(b, dim, scale, shift)
            y = x - centre
            white = (y - mean_off) @ scaled
            far = n * int(np.abs(y).max(initial=0)) + max(map(abs, off))
            if far * far * dim < 1 << 63:  # every square and sum fits
                d = n * y - np.array(off, np.int64)
                deviation = (d * d).sum(axis=1).tolist()
            else:
                d = n * y.astype(object) - np.array(off, object)
                deviation = [v if v < 1 << 63 else None for v in (d * d).sum(axis=1)]
            lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * len(values), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(deviation, pa.int64()), lists],
                                             ["vec_id", "deviation", "whitened"])
        release_memory()

    white = materialize(fit.mapInArrow(run, f"vec_id {_id_type(rows).simpleString()}, deviation long, whitened array<double>"),
                        "whitened")
    error = _identity_error(white, len(values), n)
    return white.select("vec_id", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                        F.array(*[F.lit(v) for v in explained]).cast("array<double>").alias("explained"),
                        F.lit(error).cast("double").alias("identity_error"))


def _id_type(rows: DataFrame) -> T.DataType:
    return rows.schema["vec_id"].dataType


def _schema(rows: DataFrame) -> T.StructType:
    row = T.StructType([T.StructField("vec_id", _id_type(rows))])
    return (row.add("n", T.LongType()).add("deviation", T.LongType()).add("whitened", T.ArrayType(T.DoubleType()))
            .add("explained", T.ArrayType(T.DoubleType())).add("identity_error", T.DoubleType()))


def _identity_error(white: DataFrame, k: int, n: int) -> float | None:
    """The largest entry of |covariance of the whitened rows - identity|, from the rows themselves, centred first."""
    if not k:
        return None
    at = [F.get("whitened", F.lit(i)) for i in range(k)]
    mean = white.agg(*[F.avg(c).alias(str(i)) for i, c in enumerate(at)]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    sums = white.agg(*[F.sum((at[i] - mean[i]) * (at[j] - mean[j])).alias(f"{i}_{j}") for i, j in pairs]).first()
    return max(abs(s / n - (i == j)) for s, (i, j) in zip(sums, pairs, strict=True))


def op11_whitening(embeddings: DataFrame) -> DataFrame:
    rows = whiten(embeddings.select("vec_id", "embedding"))
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "one")
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "n", "deviation", "identity_error", each).select(
        "vec_id", (F.col("k") + 1).cast("int").alias("component"), "n", "deviation",
        F.col("one.whitened").alias("whitened"), F.col("one.explained").alias("explained"), "identity_error")
