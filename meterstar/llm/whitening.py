"""Embedding whitening by the exact characteristic polynomial of the integer scatter.

Vectors become integers, so their scatter is summed up exactly: tasks multiply centred blocks
and hand over whole numbers in digits of 30 bits, whatever their size. With n distinct vectors x
of the sum S, the matrix of the sums of (n x - S)(n x - S)' is n times the integer matrix A, and
A is n^2 times their covariance. A's characteristic polynomial is computed modulo primes in
tasks, one prime at a time, and its roots and vectors are found in `exact_algebra`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal, localcontext

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from meterstar.llm import exact_algebra as algebra
from meterstar.llm.common import free_name, importable, in_tasks
from meterstar.llm.topk import as_integers
from meterstar.scratch import staged

COMPONENTS = 16
SCALE = 64
OFFSET = 1_000_000
LARGEST = 1 << 60  # larger entries count as this one
DIGIT = 30
EXACT = 1 << 53
LIMB = 20
BLOCK = 4096  # rows; their products of two limbs sum up exactly in floating point


def entries(vector: Column, scale: int = SCALE, offset: int = OFFSET) -> Column:
    """floor(scale * c) + offset of each entry; null for null vectors and bad entries."""
    bounded = F.transform(as_integers(vector, scale),
                          lambda c: F.greatest(F.least(c, F.lit(LARGEST)), F.lit(-LARGEST)))
    return F.transform(bounded, lambda c: c + offset)


@dataclass
class Whitening:
    """A fitted model; `weights` has a column per component, `explained` its share."""

    width: int
    n: int
    centre: np.ndarray  # floor(S / n)
    rest: np.ndarray  # S - n * centre
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n."""
        return (x - self.centre) - self.rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n x - S)^2 per row; None beyond 64 bits."""
        y = x - self.centre
        most = (max(int(np.abs(y).max(initial=0)), 1) + 1) * self.n
        if most * most * self.width < 1 << 63:
            return ((self.n * y - self.rest) ** 2).sum(1).tolist()
        exact = [sum((self.n * int(a) - int(b)) ** 2 for a, b in zip(row, self.rest)) for row in y]
        return [v if v < 1 << 63 else None for v in exact]


def matrix_of(column: pa.Array, width: int, fill: int) -> np.ndarray:
    """Rows of vectors; shorter ones are filled up."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.diff(column.offsets.to_numpy())
    out = np.full((len(lengths), width), fill, np.int64)
    out[np.arange(width)[None, :] < lengths[:, None]] = column.flatten().to_numpy()
    return out


def products(y: np.ndarray) -> np.ndarray:
    """y' y in whole numbers of any size."""
    width = y.shape[1]
    total = np.zeros((width, width), object)
    for a in range(0, len(y), BLOCK):
        block = y[a : a + BLOCK]
        most = int(np.abs(block).max(initial=0))
        if most * most * len(block) < EXACT:
            limbs = [block.astype(np.float64)]
        else:
            limbs = []
            while block.any() and len(limbs) < 63 // LIMB:
                limbs.append((block & ((1 << LIMB) - 1)).astype(np.float64))
                block = block >> LIMB
            limbs.append(block.astype(np.float64))
        for i, left in enumerate(limbs):
            for j, right in enumerate(limbs):
                total += (left.T @ right).astype(np.int64).astype(object) << (LIMB * (i + j))
    return total


def _exact_sums(df: DataFrame, function: Callable[[pa.RecordBatch], np.ndarray], size: int) -> list[int]:
    """The sum over all batches of a vector of `size` whole numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, object)
        for batch in batches:
            if batch.num_rows:
                total = total + function(batch)
        cells, places, digits = [], [], []
        for cell, number in enumerate(total):
            sign, number, place = (-1 if number < 0 else 1), abs(int(number)), 0
            while number:
                cells.append(cell)
                places.append(place)
                digits.append(sign * (number & ((1 << DIGIT) - 1)))
                number, place = number >> DIGIT, place + 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells, pa.int64()), pa.array(places, pa.int32()), pa.array(digits, pa.int64())],
            names=["cell", "place", "digit"],
        )

    rows = in_tasks(df, run, "cell bigint, place int, digit bigint")
    out = [0] * size
    for row in rows.groupBy("cell", "place").agg(F.sum("digit").alias("digit")).collect():
        out[row.cell] += row.digit << (DIGIT * row.place)
    return out


def _polynomial(spark: SparkSession, matrix: np.ndarray) -> list[int]:
    """det(t - matrix), its residues modulo primes from tasks of their own."""
    wanted = list(algebra.primes(algebra.coefficient_bound(matrix)))
    flat = [int(x) for x in matrix.ravel()]
    width = len(matrix)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for p in batch.column(0).to_pylist():
                residues = np.array([x % p for x in flat], np.int64).reshape(width, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p]), pa.array([algebra.characteristic_mod(residues, p).tolist()])],
                    names=["prime", "coefficients"],
                )

    rows = spark.createDataFrame([(p,) for p in wanted], "prime bigint")
    rows = rows.repartition(min(len(wanted), spark.sparkContext.defaultParallelism))
    found = in_tasks(rows, run, "prime bigint, coefficients array<bigint>").collect()
    return algebra.remaindered({r.prime: np.array(r.coefficients, object) for r in found})


def fit(rows: DataFrame, components: int = COMPONENTS, fill: int = OFFSET) -> Whitening | None:
    """A model of the distinct vectors `x` (array<long>, no nulls) of `rows`; None if there are
    none, or they are all alike.

    Components without variance are left out. The cost on the driver is that of the matrix
    (64 dimensions: seconds) and does not grow with the rows.
    """
    spark = rows.sparkSession
    importable(spark)
    fitted = staged(rows.select("x").distinct(), "fit")
    n, width, least = fitted.agg(F.count(F.lit(1)), F.max(F.size("x")), F.min(F.size("x"))).first()
    if not n or not width:
        return None
    if least < width:  # a short vector filled up can equal another one
        more = F.array_repeat(F.lit(fill).cast("long"), F.lit(width) - F.size("x"))
        fitted = staged(fitted.select(F.concat("x", more).alias("x")).distinct(), "fit")
        n = fitted.count()

    def read(batch: pa.RecordBatch) -> np.ndarray:
        return matrix_of(batch.column(0), width, fill)

    sums = _exact_sums(fitted, lambda b: read(b).astype(object).sum(0), width)
    centre = [s // n for s in sums]
    rest = np.array([s - n * c for s, c in zip(sums, centre)], object)
    centre = np.array(centre, np.int64)
    scatter = _exact_sums(fitted, lambda b: products(read(b) - centre).ravel(), width * width)
    matrix = n * np.array(scatter, object).reshape(width, width) - np.outer(rest, rest)
    trace = sum(int(matrix[i, i]) for i in range(width))
    if not trace:
        return None
    divisor = algebra.common_divisor(matrix)
    matrix = matrix // divisor
    pairs = algebra.decomposed(matrix, _polynomial(spark, matrix), components)
    with localcontext(prec=algebra.DIGITS):
        scale = Decimal(divisor) / Decimal(n) ** 2
        values = np.array([float(v * scale) for v, _ in pairs])
        explained = np.array([float(v * divisor / trace) for v, _ in pairs])
    vectors = np.array([[float(x) for x in v] for _, v in pairs]).T
    model = Whitening(width, n, centre, rest.astype(np.int64), values, vectors, explained)
    model.identity_error = identity_error(fitted, model, fill)
    return model


def _double_sums(df: DataFrame, function: Callable[[pa.RecordBatch], np.ndarray], size: int) -> np.ndarray:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                total += function(batch)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), pa.array(total)], names=["cell", "n"])

    out = np.zeros(size)
    for row in in_tasks(df, run, "cell bigint, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[row.cell] = row.n
    return out


def identity_error(fitted: DataFrame, model: Whitening, fill: int = OFFSET) -> float:
    """The largest entry of the whitened vectors' covariance less the identity, in size."""
    many = len(model.values)

    def whitened(batch: pa.RecordBatch) -> np.ndarray:
        return model.whitened(matrix_of(batch.column(0), model.width, fill))

    mean = _double_sums(fitted, lambda b: whitened(b).sum(0), many) / model.n

    def product(batch: pa.RecordBatch) -> np.ndarray:
        w = whitened(batch) - mean
        return (w.T @ w).ravel()

    covariance = _double_sums(fitted, product, many * many).reshape(many, many) / model.n
    return float(np.abs(covariance - np.eye(many)).max(initial=0))


def transform(rows: DataFrame, model: Whitening, fill: int = OFFSET) -> DataFrame:
    """`rows` with deviation (long) and whitened (array<double>) in the place of their vectors x."""
    others = [f for f in rows.schema.fields if f.name != "x"]
    names = [free_name(rows, n) for n in ("deviation", "whitened")]
    schema = StructType([*others, StructField(names[0], LongType()),
                         *StructType.fromDDL(f"{names[1]} array<double>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix_of(batch.column(batch.schema.get_field_index("x")), model.width, fill)
            white = model.whitened(x)
            offsets = np.arange(len(x) + 1, dtype=np.int32) * white.shape[1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(f.name) for f in others),
                 pa.array(model.deviations(x), pa.int64()),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(white.ravel()))],
                names=schema.fieldNames(),
            )

    return in_tasks(rows, run, schema)


def whitened_components(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                        components: int = COMPONENTS) -> DataFrame:
    """id, component (from 1), n, deviation, whitened, explained, identity_error: a row for each
    row of `vectors` that takes part and each component.

    Null vectors, and vectors with a null, NaN or infinite entry, take no part. Shorter vectors
    are filled up with zeros to the longest one's length. Repeated vectors count once in the fit
    and get rows each; null ids are kept. Entries beyond 2^60 (scaled) count as that; a deviation
    beyond 64 bits is null. There are as many components as the fit has variance in, `components`
    at most: none, and so no rows, for an empty table and for vectors all alike. Other columns
    are not looked at.
    """
    rows = vectors.select(F.col(id_column).alias("id"), entries(F.col(vector_column)).alias("x"))
    rows = rows.filter("x is not null")
    model = fit(rows, components)
    kind = vectors.schema[id_column].dataType.simpleString()
    if model is None:
        return vectors.sparkSession.createDataFrame(
            [], f"`{id_column}` {kind}, component int, n bigint, deviation bigint, whitened double, "
                "explained double, identity_error double")
    share = F.array(*(F.lit(float(e)) for e in model.explained))
    out = transform(rows, model).select("id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return out.select(
        F.col("id").alias(id_column), (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, F.col("at")).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
