"""Whitening of embeddings by the exact characteristic polynomial of their integer scatter.

Entries become integers, so the scatter matrix (n times the sum of products, less the product of the sums) is exact:
tasks add up products of 20-bit limbs, Spark adds up the tasks' sums per cell. Its characteristic polynomial is found
modulo 31-bit primes (reduction to Hessenberg form, then the recurrence of leading minors), the primes dealt to
tasks, and put together by Chinese remaindering; the trace bounds its coefficients, for no eigenvalue is negative.
All roots are real, so by Descartes' rule the sign changes of the polynomial shifted to a point count the roots above it
exactly, equal ones included: bisection with that count isolates the largest roots to ``ROOT_BITS`` bits of the trace.
Components are null vectors of the matrix less a root, by inverse iteration in fixed-point numbers of ``WORK_BITS``.

What reaches the driver depends on the dimension alone: d squared sums and, per prime, d residues.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import comb, isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import tidy

# An entry c becomes floor(SCALE * c) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: floor(SCALE * c) saturates here, so that it is exact as a double.
LIMIT = 1 << 53
LIMB = 20
#: Rows that are multiplied at once: products of two limbs, added up over them, stay below 2**53.
ROWS = 4096
DIGIT = 40
ROOT_BITS = 128
WORK_BITS = 384
#: Primes that one task reduces the matrix by.
PRIMES_PER_TASK = 32


def _integers(lists: pa.Array, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows that are vectors of d finite numbers, and floor(SCALE * entry) of these as doubles."""
    size = lists.value_lengths().to_numpy(zero_copy_only=False)
    at = np.flatnonzero(size == d)
    v = lists.take(pa.array(at, pa.int64())).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, d)
    ok = np.isfinite(v).all(axis=1)
    with np.errstate(over="ignore"):
        return at[ok], np.clip(np.floor(v[ok] * SCALE), -LIMIT, LIMIT)


def _limbs(y: np.ndarray) -> list[np.ndarray]:
    """y as a sum of limbs times powers of 2**LIMB; one limb if every entry is short."""
    out = []
    while len(y) and np.abs(y).max() >= 1 << LIMB:
        high = np.floor(y / (1 << LIMB))
        out.append(y - high * (1 << LIMB))
        y = high
    return [*out, y]


def _scatter_sums(d: int):
    """mapInArrow: v -> per task the sums of products of (1, y), cell by cell, in digits of DIGIT bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d + 1, d + 1), dtype=object)
        for b in batches:
            _, y = _integers(b.column("v"), d)
            for i in range(0, len(y), ROWS):
                limbs = [np.hstack([np.full((len(x), 1), float(k == 0)), x]) for k, x in enumerate(_limbs(y[i:i + ROWS]))]
                for j, p in enumerate(limbs):
                    for k, q in enumerate(limbs):
                        total += (p.T @ q).astype(np.int64).astype(object) << LIMB * (j + k)
        cells, digits, values = [], [], []
        for cell in range((d + 1) ** 2):
            i, j = divmod(cell, d + 1)
            value, digit = int(total[i, j]) if i <= j else 0, 0
            sign, value = (-1 if value < 0 else 1), abs(value)
            while value:
                cells.append(cell)
                digits.append(digit)
                values.append(sign * (value & ((1 << DIGIT) - 1)))
                value, digit = value >> DIGIT, digit + 1
        yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(digits, pa.int32()), pa.array(values, pa.int64())],
                                         names=["cell", "digit", "value"])

    return run


def scatter(vectors: DataFrame, d: int) -> tuple[int, list[int], list[list[int]]]:
    """(n, sums, scatter) of the integers y of the vectors v: scatter = n * sum(y y') - sums sums', exactly."""
    sums = (vectors.mapInArrow(tidy(_scatter_sums(d)), "cell int, digit int, value long")
            .groupBy("cell", "digit").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect())  # d squared cells
    cells = [0] * (d + 1) ** 2
    for r in sums:
        cells[r.cell] += int(r.value) << DIGIT * r.digit
    n, t = cells[0], cells[1:d + 1]
    both = lambda i, j: cells[min(i, j) * (d + 1) + max(i, j)]
    return n, t, [[n * both(i + 1, j + 1) - t[i] * t[j] for j in range(d)] for i in range(d)]


def _is_prime(p: int) -> bool:
    """Miller-Rabin; these bases decide every p below 3.2e9."""
    odd, twos = p - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, p)
        if x not in (1, p - 1) and not any((x := x * x % p) == p - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bits: int) -> list[int]:
    """The largest 31-bit primes, so many that their product has more than ``bits`` bits."""
    out, p = [], (1 << 31) - 1
    while len(out) * 30 <= bits:
        if _is_prime(p):
            out.append(p)
        p -= 2
    return out


def _inverse(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """x ** (p - 2) modulo the primes p; 0 stays 0."""
    out, e = np.ones_like(x), p - 2
    while e.any():
        out = np.where(e & 1, out * x % p, out)
        x, e = x * x % p, e >> 1
    return out


def polynomial_residues(matrix: list[list[int]], primes: list[int]) -> np.ndarray:
    """Row per prime: the coefficients of det(x - matrix), highest first, modulo the prime."""
    d, p = len(matrix), np.array(primes, np.int64)
    h = np.array([[[x % q for x in row] for row in matrix] for q in primes], np.int64).reshape(len(p), d, d)
    every, p2, p3 = np.arange(len(p)), p[:, None], p[:, None, None]
    for m in range(1, d - 1):
        # A similar matrix with zeros below row m of column m - 1; a prime's own pivot row comes to row m.
        pivot = m + np.argmax(h[:, m:, m - 1] != 0, axis=1)
        for rows in (h, h.transpose(0, 2, 1)):
            kept = rows[every, pivot].copy()
            rows[every, pivot] = rows[:, m]
            rows[:, m] = kept
        u = h[:, m + 1:, m - 1] * _inverse(h[:, m, m - 1], p)[:, None] % p2
        h[:, m + 1:] = (h[:, m + 1:] - u[:, :, None] * h[:, m:m + 1] % p3) % p3
        h[:, :, m] = (h[:, :, m] + (h[:, :, m + 1:] * u[:, None, :] % p3).sum(axis=2)) % p2
    # minors[k]: characteristic polynomial of the leading k rows and columns, lowest coefficient first.
    minors = [np.zeros((len(p), d + 1), np.int64)]
    minors[0][:, 0] = 1
    for k in range(d):
        last = minors[k]
        now = np.zeros_like(last)
        now[:, 1:] = last[:, :-1]
        now = (now - h[:, k, k][:, None] * last) % p2
        below = np.ones(len(p), np.int64)
        for i in range(k - 1, -1, -1):
            below = below * h[:, i + 1, i] % p
            now = (now - (below * h[:, i, k] % p)[:, None] * minors[i]) % p2
        minors.append(now)
    return minors[d][:, ::-1]


def _residues(matrix: list[list[int]]):
    """mapInArrow: primes -> their residues of the characteristic polynomial."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            primes = b.column("prime").to_pylist()
            for i in range(0, len(primes), PRIMES_PER_TASK):
                part = primes[i:i + PRIMES_PER_TASK]
                yield pa.RecordBatch.from_arrays([pa.array(part, pa.int64()), pa.array(list(polynomial_residues(matrix, part)), pa.list_(pa.int64()))],
                                                 names=["prime", "residues"])

    return run


def coefficient_bits(matrix: list[list[int]]) -> int:
    """Bits of the largest coefficient's bound: e_k of non-negative eigenvalues is at most binom(d, k) (trace / d) ** k."""
    d, trace = len(matrix), sum(matrix[i][i] for i in range(len(matrix)))
    return max(comb(d, k) * -(-trace ** k // d ** k) for k in range(d + 1)).bit_length()


def characteristic_polynomial(spark, matrix: list[list[int]]) -> list[int]:
    """Coefficients of det(x - matrix), highest first, of a positive semidefinite integer matrix. The primes are dealt to tasks."""
    primes = primes_beyond(coefficient_bits(matrix) + 1)
    rows = (spark.createDataFrame([(p,) for p in primes], "prime long").repartition(-(-len(primes) // PRIMES_PER_TASK))
            .mapInArrow(tidy(_residues(matrix)), "prime long, residues array<long>").collect())  # d numbers per prime
    product = reduce(int.__mul__, primes)
    weights = [(product // r.prime) * pow(product // r.prime, -1, r.prime) for r in rows]
    out = []
    for k in range(len(matrix) + 1):
        x = sum(w * r.residues[k] for w, r in zip(weights, rows)) % product
        out.append(x - product if x > product // 2 else x)
    return out


def _roots_above(scaled: list[int], at: int) -> int:
    """How many roots of the polynomial, all of them real, are larger than ``at``: sign changes of it shifted there."""
    c = list(scaled)
    for stop in range(len(c) - 1, 0, -1):
        for i in range(1, stop + 1):
            c[i] += at * c[i - 1]
    signs = [x > 0 for x in c if x]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def largest_roots(polynomial: list[int], trace: int, count: int) -> tuple[list[int], int]:
    """(roots, shift): the ``count`` largest roots above zero, each at most 1 above the true root times 2 ** shift.

    ``trace`` is at least the largest root. Equal roots come as often as they are; roots that differ by less than
    2 ** -ROOT_BITS of the trace may come as equal.
    """
    shift = max(0, ROOT_BITS - trace.bit_length())
    scaled = [c << shift * k for k, c in enumerate(polynomial)]
    known = {0: _roots_above(scaled, 0), trace << shift: 0}
    out = []
    for i in range(1, min(count, known[0]) + 1):
        low, high = max(m for m, c in known.items() if c >= i), min(m for m, c in known.items() if c < i)
        while high - low > 1:
            middle = (low + high) // 2
            known[middle] = _roots_above(scaled, middle)
            low, high = (middle, high) if known[middle] >= i else (low, middle)
        out.append(high)
    return out, shift


def _solved(rows: np.ndarray, right: np.ndarray) -> np.ndarray:
    """rows x = right in fixed point, by elimination with row pivots. A pivot of zero becomes the smallest number."""
    a, d = np.concatenate([rows, right[:, None]], axis=1), len(rows)
    for k in range(d):
        best = k + max(range(d - k), key=lambda i: abs(a[k + i, k]))
        a[[k, best]] = a[[best, k]]
        a[k, k] = a[k, k] or 1
        for i in range(k + 1, d):
            if a[i, k]:
                factor = (a[i, k] << WORK_BITS) // a[k, k]
                a[i, k:] -= (a[k, k:] * factor) >> WORK_BITS
    x = np.zeros(d, dtype=object)
    for k in range(d - 1, -1, -1):
        x[k] = ((a[k, d] << WORK_BITS) - int((a[k, k + 1:d] * x[k + 1:]).sum())) // a[k, k]
    return x


def _unit(x: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """x less its part along the others, which are unit vectors, and brought to length one; all in fixed point."""
    x = (x << WORK_BITS) // max(1, max(map(abs, x)))
    for o in others * 2:
        x = x - ((o * (int((x * o).sum()) >> WORK_BITS)) >> WORK_BITS)
    return (x << WORK_BITS) // max(1, isqrt(int((x * x).sum())))


def null_vectors(matrix: list[list[int]], trace: int, roots: list[int], shift: int) -> list[np.ndarray]:
    """Unit eigenvectors to the roots, in fixed point, by two steps of inverse iteration each.

    Each is kept orthogonal to those before, so that equal roots span their whole space.
    """
    d, out = len(matrix), []
    a = np.array([[(x << WORK_BITS) // trace for x in row] for row in matrix], dtype=object).reshape(d, d)
    seed = 1
    for root in roots:
        moved, value = a.copy(), (root << WORK_BITS) // (trace << shift)
        for i in range(d):
            moved[i, i] -= value
        x = np.zeros(d, dtype=object)
        for i in range(d):  # a start that no eigenvector is likely to be orthogonal to
            seed = seed * 6364136223846793005 + 1442695040888963407 & (1 << 64) - 1
            x[i] = (seed >> 32) - (1 << 31)
        x = _unit(x, out)
        for _ in range(2):
            x = _unit(_solved(moved, x), out)
        top = max(range(d), key=lambda i: abs(x[i]))
        out.append(-x if x[top] < 0 else x)
    return out


class Whitening:
    """What one fit found: n, sums of the integers y, unit components (d x k, doubles), variances and shares of the trace."""

    def __init__(self, n: int, sums: list[int], matrix: list[list[int]], polynomial: list[int], count: int):
        trace = sum(matrix[i][i] for i in range(len(matrix)))
        roots, shift = largest_roots(polynomial, trace, count) if trace else ([], 0)
        vectors = null_vectors(matrix, trace, roots, shift) if roots else []
        self.n, self.sums = n, sums
        self.components = np.array([[x / (1 << WORK_BITS) for x in v] for v in vectors], np.float64).reshape(len(roots), len(sums)).T
        self.variances = np.array([r / (n * n << shift) for r in roots])
        self.shares = np.array([r / (trace << shift) for r in roots])

    def deviations(self, y: np.ndarray) -> np.ndarray:
        """n * y - sums, exact: as int64 where the squares' sums fit, else as Python integers."""
        largest = self.n * int(np.abs(y).max(initial=0)) + max(map(abs, self.sums))
        if largest * largest * max(1, len(self.sums)) < 1 << 63:
            return y.astype(np.int64) * self.n - np.array(self.sums, np.int64)
        return y.astype(np.int64).astype(object) * self.n - np.array(self.sums, dtype=object)

    def project(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations / self.n).astype(np.float64) @ (self.components / np.sqrt(self.variances))


def fit(vectors: DataFrame, d: int, count: int) -> Whitening:
    n, sums, matrix = scatter(vectors, d)
    return Whitening(n, sums, matrix, characteristic_polynomial(vectors.sparkSession, matrix), count)


def _moments(model: Whitening, d: int):
    """mapInArrow: v -> per task the sums of (1, whitened) times (1, whitened), cell by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.variances)
        total = np.zeros((k + 1, k + 1))
        for b in batches:
            _, y = _integers(b.column("v"), d)
            w = np.hstack([np.ones((len(y), 1)), model.project(model.deviations(y))])
            total += w.T @ w
        yield pa.RecordBatch.from_arrays([pa.array(range((k + 1) ** 2), pa.int32()), pa.array(total.ravel())], names=["cell", "value"])

    return run


def identity_error(vectors: DataFrame, d: int, model: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity, over all vectors."""
    k = len(model.variances)
    rows = vectors.mapInArrow(tidy(_moments(model, d)), "cell int, value double").groupBy("cell").agg(F.sum("value").alias("value")).collect()
    m = np.zeros((k + 1) ** 2)
    m[[r.cell for r in rows]] = [r.value for r in rows]
    m = m.reshape(k + 1, k + 1) / model.n
    return float(np.abs(m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]) - np.eye(k)).max())


_OUT = "id long, component int, n long, deviation decimal(38,0), whitened double, explained double"


def _rows(model: Whitening, d: int):
    """mapInArrow: (id, v) -> a row per vector and component."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.variances)
        for b in batches:
            at, y = _integers(b.column("v"), d)
            ids = b.column("id").take(pa.array(at, pa.int64()))
            for i in range(0, len(y), ROWS):
                dev = model.deviations(y[i:i + ROWS])
                m = len(dev)
                square = (dev * dev).sum(axis=1)
                if square.dtype == object:
                    square = pa.array([x if x < 10 ** 38 else None for x in square], pa.decimal128(38, 0))
                else:
                    square = pa.array(square).cast(pa.decimal128(38, 0))
                each = pa.array(np.repeat(np.arange(m), k))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, m).take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model.n, np.int64)),
                     square.take(each), pa.array(model.project(dev).ravel()), pa.array(np.tile(model.shares, m))],
                    names=["id", "component", "n", "deviation", "whitened", "explained"])

    return run


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 8) -> DataFrame:
    """Per vector and component: ``id_col``, ``component``, ``n``, ``deviation``, ``whitened``, ``explained``, ``identity_error``.

    Every finite entry c is taken as x = floor(1024 c) + 100000 (floor(1024 c) saturates at 2**53). Null
    vectors, empty ones and those with null or non-finite entries take no part; nor do vectors that are not
    of the length most others have (of equally frequent lengths the smallest counts). All others, repeated rows and
    rows with a null id included, are fitted and returned. ``deviation`` (decimal) is the exact sum of (n x - S)**2, null
    from 1e38 on; components are numbered by falling variance, equal variances span their space, and the largest entry of a
    component is positive. Components without variance are left out, so constant vectors, one single
    vector or an empty table give no rows. Other columns are not read. An integer entry type counts as doubles.
    """
    spark = df.sparkSession
    vectors = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))  # NaN is larger than any number
    common = vectors.filter(finite & (F.size("v") > 0)).groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    model = fit(vectors.select("v"), common.d, components) if common else None
    if model is None or not len(model.variances):
        out, error = spark.createDataFrame([], _OUT), 0.0
    else:
        error = identity_error(vectors.select("v"), common.d, model)
        out = vectors.mapInArrow(tidy(_rows(model, common.d)), _OUT)
    return out.withColumn("identity_error", F.lit(error)).withColumnRenamed("id", id_col)
