"""Whitening of embedding vectors by the exact characteristic polynomial of their integer scatter.

Vectors become integers x = floor(SCALE * c). The fit list is every distinct x once; Spark adds up its count, sums and
products exactly, so n * sum(x x') - S S' is an integer matrix, n squared times the covariance. Its characteristic
polynomial is found modulo many primes in tasks (reduction to Hessenberg form, then the recurrence over leading minors)
and put together by the Chinese remainder theorem; by Maclaurin's inequality the trace says how many primes are enough. All roots
are real, so the sign changes of the shifted polynomial count the roots above a point exactly, repeated ones included: the
wanted roots are isolated by bisection, refined in integers to ROOT_BITS bits, and their vectors found by
inverse iteration in decimals, a block of vectors for a repeated root.

Only n, sums and products (of the dimension squared, not of the data) reach the driver. Vectors that are null or hold null or
non-finite entries are left out, as are those of another length than the commonest (of equally common ones the longest). Values
of x beyond a long saturate. Components with eigenvalue zero do not exist: a table of one distinct vector, or an
empty one, gives no scores. Roots closer than 2^-ROOT_BITS of the trace count as one repeated root, in which any orthonormal basis serves.
``deviation`` is null where the exact number is too large for a long. Repeated rows each get their scores; null ids are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from gritstone.llm.store import stored

SCALE = 256
ROOT_BITS = 256
DIGITS = 120
ITERATIONS = 200
PRIMES_A_TASK = 32
#: Rows and bits multiplied at once, so that sums of products stay below 2^53 and doubles are exact.
BLOCK, PIECE = 4096, 20
LIMB = 60
ADDED = ("n", "deviation", "scores")


@dataclass(frozen=True)
class Whitening:
    """n and sums of the fit list, trace of the scatter, and (eigenvalue of the scatter, unit vector) by falling eigenvalue."""

    n: int
    sums: list[int]
    trace: int
    roots: list[float]
    vectors: list[list[float]]

    @property
    def explained(self) -> list[float]:
        return [root / float(self.trace) for root in self.roots]


def to_integers(vectors: pa.Array, scale: int) -> pa.Array:
    """floor(scale * c) as longs; null where the vector is unusable."""
    offsets = vectors.offsets.to_numpy()
    values = vectors.values
    flat = np.asarray(values.to_numpy(zero_copy_only=False), dtype=np.float64)  # nulls become NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(flat))])
    usable = (bad[offsets[1:]] == bad[offsets[:-1]]) & np.asarray(vectors.is_valid())
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(flat * scale)
    top = 2.0**63
    whole = np.where(scaled >= top, np.iinfo(np.int64).max, np.where(scaled < -top, np.iinfo(np.int64).min, 0))
    inside = np.isfinite(scaled) & (scaled < top) & (scaled >= -top)
    whole[inside] = scaled[inside].astype(np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(whole, pa.int64()), mask=pa.array(~usable))


def integer_vectors(frame: DataFrame, vector: str, keep: list[str], scale: int) -> DataFrame:
    """``row`` (struct of the columns of ``keep``) and ``x``; unusable vectors are left out."""
    chosen = frame.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), F.col(f"`{vector}`").cast("array<double>").alias("x"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), to_integers(batch.column(1), scale)], names=["row", "x"])

    kind = chosen.schema["row"].dataType.simpleString()
    return chosen.mapInArrow(work, f"row {kind}, x array<bigint>").where("x is not null and size(x) > 0")


def as_matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def exact_products(x: np.ndarray) -> np.ndarray:
    """x' x in Python integers, by double products of pieces of PIECE bits."""
    total = np.zeros((x.shape[1], x.shape[1]), dtype=object)
    for start in range(0, len(x), BLOCK):
        rest, pieces = x[start : start + BLOCK], []
        while True:
            low = rest & ((1 << PIECE) - 1)
            if np.abs(rest >> (PIECE - 1)).max(initial=0) <= 1:
                pieces.append(rest.astype(np.float64))
                break
            pieces.append(low.astype(np.float64))
            rest = rest >> PIECE
        for i, a in enumerate(pieces):
            for j, b in enumerate(pieces):
                total += (a.T @ b).astype(np.int64).astype(object) << (PIECE * (i + j))
    return total


def limbs(value: int) -> Iterator[tuple[int, int]]:
    """(place, part) with value the sum of part * 2^(LIMB * place); the last part carries the sign."""
    place = 0
    while not -(1 << LIMB) < value < (1 << LIMB):
        yield place, value & ((1 << LIMB) - 1)
        value >>= LIMB
        place += 1
    yield place, value


def moments(fit: DataFrame, width: int) -> tuple[int, list[int], np.ndarray]:
    """Exact count, sums and products of the distinct vectors, added up by Spark in parts that fit a long."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, products = 0, np.zeros(width, dtype=object), np.zeros((width, width), dtype=object)
        for batch in batches:
            x = as_matrix(batch.column(0), width)
            n += len(x)
            sums += (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
            products += exact_products(x)
        cells = [(-1, -1, n)] + [(i, -1, sums[i]) for i in range(width)] + [(i, j, products[i, j]) for i in range(width) for j in range(i + 1)]
        rows = [(i, j, place, part) for i, j, value in cells if value for place, part in limbs(int(value))]
        columns = list(zip(*rows)) if rows else [[], [], [], []]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int64()))],
                                         names=["i", "j", "place", "part"])

    parts = fit.mapInArrow(partial, "i int, j int, place int, part bigint")
    n, sums, products = 0, [0] * width, np.zeros((width, width), dtype=object)
    for row in parts.groupBy("i", "j", "place").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect():
        value = int(row["total"]) << (LIMB * row["place"])
        if row["i"] < 0:
            n += value
        elif row["j"] < 0:
            sums[row["i"]] += value
        else:
            products[row["i"], row["j"]] += value
            if row["i"] != row["j"]:
                products[row["j"], row["i"]] += value
    return n, sums, products


def is_prime(value: int) -> bool:
    """Miller and Rabin; these bases settle every number below 3 * 10^9."""
    if value % 2 == 0:
        return value == 2
    odd, twos = value - 1, 0
    while odd % 2 == 0:
        odd, twos = odd // 2, twos + 1
    for base in (2, 3, 5, 7):
        x = pow(base, odd, value)
        if x not in (1, value - 1) and not any((x := x * x % value) == value - 1 for _ in range(twos - 1)):
            return False
    return True


def primes_beyond(bits: float) -> list[int]:
    """Primes below 2^31, the largest first, with a product of more than ``bits`` bits."""
    found, have, value = [], 0.0, (1 << 31) - 1
    while have <= bits:
        if is_prime(value):
            found.append(value)
            have += log2(value)
        value -= 2
    return found


def hessenberg(a: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Similar matrices in Hessenberg form, one modulus per matrix: (k, d, d) and (k,)."""
    width, one = a.shape[1], np.arange(len(p))
    wide = p[:, None, None]
    for c in range(width - 2):
        pivot = c + 1 + np.argmax(a[:, c + 1 :, c] != 0, axis=1)
        rows = a[one, pivot].copy()
        a[one, pivot], a[:, c + 1] = a[:, c + 1].copy(), rows
        columns = a[one, :, pivot].copy()
        a[one, :, pivot], a[:, :, c + 1] = a[:, :, c + 1].copy(), columns
        inverse = np.array([pow(int(v), -1, int(q)) if v else 0 for v, q in zip(a[:, c + 1, c], p)], dtype=np.int64)
        factor = a[:, c + 2 :, c] * inverse[:, None] % p[:, None]
        a[:, c + 2 :] = (a[:, c + 2 :] - factor[:, :, None] * a[:, c + 1][:, None, :] % wide) % wide
        a[:, :, c + 1] = (a[:, :, c + 1] + (a[:, :, c + 2 :] * factor[:, None, :] % wide).sum(axis=2)) % p[:, None]
    return a


def polynomials_modulo(matrix: np.ndarray, primes: list[int]) -> np.ndarray:
    """Coefficients of det(xI - matrix), lowest power first, modulo each prime: (k, d + 1)."""
    width, p = len(matrix), np.array(primes, dtype=np.int64)
    h = hessenberg(np.stack([(matrix % q).astype(np.int64) for q in primes]), p)
    minors = np.zeros((len(p), width + 1, width + 1), dtype=np.int64)
    minors[:, 0, 0] = 1
    for k in range(1, width + 1):
        weight, below = np.zeros((len(p), k), dtype=np.int64), np.ones(len(p), dtype=np.int64)
        for i in range(k - 1, -1, -1):  # minor i is met with the entry in row i and the product of the subdiagonal below it
            weight[:, i] = h[:, i, k - 1] * below % p
            if i:
                below = below * h[:, i, i - 1] % p
        minors[:, k, 1:] = minors[:, k - 1, :-1]
        used = (weight[:, :, None] * minors[:, :k] % p[:, None, None]).sum(axis=1)
        minors[:, k] = (minors[:, k] - used) % p[:, None]
    return minors[:, width]


def characteristic_polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """Integer coefficients of det(xI - matrix), lowest power first, for a positive semidefinite integer matrix."""
    width, trace = len(matrix), int(sum(matrix.diagonal()))
    primes = primes_beyond(2 + width * log2(1 + trace / width))
    chunks = [primes[at : at + PRIMES_A_TASK] for at in range(0, len(primes), PRIMES_A_TASK)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in batch.column(0).to_pylist():
                found = polynomials_modulo(matrix, chunks[chunk])
                yield pa.RecordBatch.from_arrays([pa.array(chunks[chunk], pa.int64()), pa.array(found.tolist(), pa.list_(pa.int64()))],
                                                 names=["prime", "residues"])

    found = spark.range(0, len(chunks), 1, len(chunks)).mapInArrow(work, "prime bigint, residues array<bigint>").collect()
    whole = 1
    for prime in primes:
        whole *= prime
    out = [0] * (width + 1)
    for row in found:
        rest = whole // row["prime"]
        unit = rest * pow(rest, -1, row["prime"])
        out = [c + r * unit for c, r in zip(out, row["residues"])]
    # coefficients of a matrix without negative eigenvalues alternate in sign, and whole is more than twice the largest
    return [c - whole if c > whole // 2 else c for c in (v % whole for v in out)]


def roots_above(polynomial: list[int], point: int) -> int:
    """Roots greater than ``point`` of a polynomial with real roots only: the sign changes after shifting it there."""
    c = polynomial[::-1]
    for end in range(len(c) - 1, 0, -1):
        for k in range(1, end + 1):
            c[k] += point * c[k - 1]
    signs = [v > 0 for v in c if v]
    return sum(a != b for a, b in zip(signs, signs[1:]))


def at(polynomial: list[int], point: int) -> int:
    value = 0
    for c in reversed(polynomial):
        value = value * point + c
    return value


def largest_roots(polynomial: list[int], trace: int, wanted: int) -> list[tuple[int, int, int]]:
    """(low, multiplicity, shift): a root in (low, low + 1] / 2^shift, for the largest roots that are not zero, until ``wanted``."""
    width = len(polynomial) - 1
    zeros = next(k for k, c in enumerate(polynomial) if c)
    bits = ROOT_BITS
    while True:
        shift = max(0, bits - trace.bit_length())
        scaled = [c << (shift * (width - k)) for k, c in enumerate(polynomial)]
        found, have = [], 0
        spans = [(0, trace << shift, width - zeros, 0)]  # low, high, roots above low, roots above high
        while spans and have < wanted:
            low, high, above_low, above_high = spans.pop()
            if above_low == above_high:
                continue
            if above_low - above_high == 1:
                positive = above_high % 2 == 0  # the sign between this root and the next larger one
                while high - low > 1:
                    middle = (low + high) // 2
                    value = at(scaled, middle)
                    if value == 0:
                        low, high = middle - 1, middle
                    elif (value > 0) == positive:
                        high = middle
                    else:
                        low = middle
            if high - low == 1:
                found.append((low, above_low - above_high, shift))
                have += above_low - above_high
                continue
            middle = (low + high) // 2
            above = roots_above(scaled, middle)
            spans += [(low, middle, above_low, above), (middle, high, above, above_high)]
        if all(low >> 80 for low, _, _ in found):
            return found
        bits *= 2


def null_space(matrix: np.ndarray, low: int, shift: int, size: int) -> np.ndarray:
    """``size`` orthonormal vectors that the matrix stretches by the root in (low, low + 1] / 2^shift: block inverse iteration.

    The point used lies half a unit above ``low``: eigenvalues of an integer matrix that are rational are integers, so none is met.
    """
    width = len(matrix)
    digits = DIGITS + ceil(low.bit_length() * 0.302)
    with localcontext() as context:
        context.prec = digits
        point = (Decimal(low) + Decimal("0.5")) / Decimal(2) ** shift
        a = np.array([[Decimal(int(v)) for v in row] for row in matrix], dtype=object)
        a[np.diag_indices(width)] -= point
        order = np.arange(width)
        for c in range(width):
            best = c + max(range(width - c), key=lambda k: abs(a[c + k, c]))
            a[[c, best]], order[[c, best]] = a[[best, c]], order[[best, c]]
            for r in range(c + 1, width):
                if a[r, c]:
                    a[r, c] /= a[c, c]
                    a[r, c + 1 :] -= a[r, c] * a[c, c + 1 :]
        block = np.array([[Decimal((r + 1) * (r + 2 + k) * 7919 % 104729 - 52364) for k in range(size)] for r in range(width)], dtype=object)
        for _ in range(ITERATIONS):
            before, block = block, block[order]
            for r in range(width):
                block[r] -= a[r, :r].dot(block[:r]) if r else 0
            for r in range(width - 1, -1, -1):
                block[r] = (block[r] - (a[r, r + 1 :].dot(block[r + 1 :]) if r + 1 < width else 0)) / a[r, r]
            for k in range(size):
                for _ in range(2):
                    for j in range(k):
                        block[:, k] -= block[:, j] * block[:, j].dot(block[:, k])
                    block[:, k] /= block[:, k].dot(block[:, k]).sqrt()
            if all(abs(abs(before[:, k].dot(block[:, k])) - 1) < Decimal(10) ** -60 for k in range(size)):
                break
        out = block.astype(float).T
    return np.array([v if v[np.argmax(np.abs(v))] > 0 else -v for v in out])


def fit(vectors: DataFrame, components: int) -> Whitening:
    """The whitening of the distinct vectors ``x`` of the frame, all of one length."""
    first = vectors.first()
    width = len(first["x"]) if first else 0
    n, sums, products = moments(vectors.select("x"), width) if width else (0, [], np.zeros((0, 0), dtype=object))
    scatter = n * products - np.outer(np.array(sums, dtype=object), np.array(sums, dtype=object))
    trace = int(sum(scatter.diagonal())) if width else 0
    if not trace:
        return Whitening(n, sums, 0, [], [])
    polynomial = characteristic_polynomial(vectors.sparkSession, scatter)
    roots, found = [], []
    for low, size, shift in largest_roots(polynomial, trace, components):
        roots += [(2 * low + 1) / (1 << (shift + 1))] * size
        found += null_space(scatter, low, shift, size).tolist()
    return Whitening(n, sums, trace, roots[:components], found[:components])


def deviations(z: np.ndarray) -> list[int | None]:
    """Exact sums of squares of integer rows; None beyond a long."""
    rough = (z.astype(np.float64) ** 2).sum(axis=1)
    most = 2.0**63
    out: list[int | None] = [None] * len(z)
    small = np.flatnonzero(rough < most * (1 - 1e-6))
    exact = (z[small].astype(np.int64) ** 2).sum(axis=1)
    for k, value in zip(small.tolist(), exact.tolist()):
        out[k] = value
    for k in np.flatnonzero((rough >= most * (1 - 1e-6)) & (rough < most * (1 + 1e-6))).tolist():
        value = sum(int(v) ** 2 for v in z[k])
        out[k] = value if value < 1 << 63 else None
    return out


def scored(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``vectors`` (any columns before x) with ``deviation`` and ``scores`` in place of x."""
    others = [c for c in vectors.columns if c != "x"]
    sums, width = np.array(model.sums, dtype=object), len(model.sums)
    axes = np.array(model.vectors, dtype=np.float64).reshape(len(model.roots), width).T / np.sqrt(np.array(model.roots, dtype=np.float64))
    room = (1 << 62) - max(map(abs, model.sums), default=0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = as_matrix(batch.column("x"), width)
            largest = max(int(x.max(initial=0)), -int(x.min(initial=0)))
            fits = largest * model.n < room
            z = x * model.n - sums.astype(np.int64) if fits else x.astype(object) * model.n - sums
            scores = z.astype(np.float64) @ axes
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in others], pa.array(deviations(z), pa.int64()), pa.array(scores.tolist(), pa.list_(pa.float64()))],
                names=[*others, "deviation", "scores"])

    kinds = ", ".join(f"{c} {vectors.schema[c].dataType.simpleString()}" for c in others)
    return vectors.select(*others, "x").mapInArrow(work, f"{kinds + ', ' if kinds else ''}deviation bigint, scores array<double>")


def identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list, less the identity."""
    size = len(model.roots)
    if not size:
        return None
    scores = scored(distinct.select("x"), model).select(*[F.get("scores", k).alias(f"s{k}") for k in range(size)])
    pairs = [(i, j) for i in range(size) for j in range(i + 1)]
    row = scores.agg(*[F.covar_pop(f"s{i}", f"s{j}") for i, j in pairs]).first()
    return max(abs(row[k] - (i == j)) for k, (i, j) in enumerate(pairs))


def whiten(frame: DataFrame, vector: str = "embedding", components: int = 4, scale: int = SCALE) -> tuple[DataFrame, Whitening, float | None]:
    """Rows with a usable vector, with their other columns, n, deviation and scores; the model; the identity error.

    Columns of the names in ADDED are replaced; the vector itself is left out.
    """
    keep = [c for c in frame.columns if c != vector and c.lower() not in ADDED]
    rows = stored(integer_vectors(frame, vector, keep, scale), "integers")
    common = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    rows = rows.where(F.size("x") == (common["width"] if common else 0))
    distinct = stored(rows.select("x").distinct(), "fit-list")
    model = fit(distinct, components)
    found = scored(rows, model).select("row.*", F.lit(model.n).cast("long").alias("n"), "deviation", "scores")
    return found, model, identity_error(distinct, model)


def by_component(frame: DataFrame, key: str, vector: str = "embedding", components: int = 4) -> DataFrame:
    """One row for each vector and component, with the share that the component explains and the identity error."""
    found, model, error = whiten(frame, vector, components)
    shares = F.array(*[F.lit(v) for v in model.explained]).cast("array<double>")
    return found.select(key, "n", "deviation", F.posexplode("scores").alias("at", "whitened")).select(
        key, (F.col("at") + 1).cast("int").alias("component"), "n", "deviation", "whitened",
        F.get(shares, F.col("at")).alias("explained"), F.lit(error).cast("double").alias("identity_error"))
