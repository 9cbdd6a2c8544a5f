"""Whitening of embeddings through the distinct vectors and their multiplicities.

Entries become whole numbers on a fixed grid, so many rows share one vector. Rows are
grouped by that vector; a vector's weight in the fit is its count (or one). The
covariance is a weighted product of centred matrices, summed over tasks. Each distinct
vector is whitened once and joined back to its rows.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import ship, stored, with_facts

GRID = 64
ORIGIN = 1_000_000
COMPONENTS = 32
# Directions with less than this share of the variance are rounding noise of constant
# or dependent dimensions.
LEAST_SHARE = 1e-12
# Entries beyond this many grid steps are cut to it: doubles hold no fractions there.
_FARTHEST = 2.0**53
_BATCH_ROWS = 4096


def grid_vectors(docs: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``(id, x)`` of every row whose vector has finite entries only: ``x`` holds
    ``floor(64 * entry) + 1000000`` as 64-bit numbers, lowest byte first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            lengths = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy()
            values = vectors.flatten()
            empty = values.is_null().to_numpy(zero_copy_only=False)
            numbers = values.fill_null(0).to_numpy().astype(float)
            bad = np.concatenate([[0], np.cumsum(empty | ~np.isfinite(numbers))])
            ends = np.cumsum(lengths)
            sound = vectors.is_valid().to_numpy(zero_copy_only=False)
            sound = sound & (bad[ends] == bad[ends - lengths])
            steps = np.floor(np.where(np.isfinite(numbers), numbers, 0) * GRID)
            x = np.clip(steps, -_FARTHEST, _FARTHEST).astype("<i8") + ORIGIN
            found = [
                x[end - size : end].tobytes()
                for end, size in zip(ends[sound], lengths[sound], strict=True)
            ]
            yield pa.RecordBatch.from_arrays(
                [ids.filter(pa.array(sound)), pa.array(found, pa.binary())], ["id", "x"]
            )

    rows = docs.select(
        F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v")
    )
    return rows.mapInArrow(run, "id long, x binary")


def _by_length(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Places, vectors as a matrix, and weights of each length of vector in a batch of
    ``(x, weight)``; the empty vector has no dimension to whiten."""
    sizes = pc.binary_length(batch.column(0)).to_numpy() // 8
    weights = batch.column(1).to_numpy()
    for size in np.unique(sizes[sizes > 0]):
        places = np.flatnonzero(sizes == size)
        raw = b"".join(batch.column(0).take(pa.array(places)).to_pylist())
        yield places, np.frombuffer(raw, "<i8").reshape(-1, size), weights[places]


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Weight and exact weighted sum of each dimension, per length."""
    found = {}
    for batch in batches:
        for _, x, weights in _by_length(batch):
            if float(np.abs(x).max()) * float(weights.sum()) < 2.0**62:
                sums = [int(s) for s in weights @ x]
            else:
                sums = list(weights.astype(object) @ x.astype(object))
            n, before = found.get(x.shape[1], (0, [0] * x.shape[1]))
            sums = [a + b for a, b in zip(sums, before, strict=True)]
            found[x.shape[1]] = (n + int(weights.sum()), sums)
    rows = [
        (size, place, n, Decimal(s))
        for size, (n, sums) in found.items()
        for place, s in enumerate(sums)
    ]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int32()),
            pa.array([r[1] for r in rows], pa.int32()),
            pa.array([r[2] for r in rows], pa.int64()),
            pa.array([r[3] for r in rows], pa.decimal128(38, 0)),
        ],
        ["size", "place", "n", "sum"],
    )


def _matrix_rows(matrices: dict[int, np.ndarray]) -> pa.RecordBatch:
    rows = [(size, i, row.tobytes()) for size, m in matrices.items() for i, row in enumerate(m)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([r[0] for r in rows], pa.int32()),
            pa.array([r[1] for r in rows], pa.int32()),
            pa.array([r[2] for r in rows], pa.binary()),
        ],
        ["size", "place", "row"],
    )


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of the matrix rows that share a length and a place."""
    total = {}
    for batch in batches:
        for size, place, row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            own = np.frombuffer(row)
            total[size, place] = total[size, place] + own if (size, place) in total else own
    keys = list(total)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([k[0] for k in keys], pa.int32()),
            pa.array([k[1] for k in keys], pa.int32()),
            pa.array([total[k].tobytes() for k in keys], pa.binary()),
        ],
        ["size", "place", "row"],
    )


_ROWS = "size int, place int, row binary"


def _matrices(partial: DataFrame) -> dict[int, np.ndarray]:
    """The sums of the tasks' matrices, one per length: as large as a length squared."""
    rows = partial.repartition("size", "place").mapInArrow(_added, _ROWS).collect()
    found = defaultdict(dict)
    for row in rows:
        found[row.size][row.place] = np.frombuffer(row.row)
    return {size: np.stack([m[i] for i in range(len(m))]) for size, m in found.items()}


def _split(exact: int, n: int) -> tuple[int, float]:
    """The mean ``exact / n`` as a whole number and the rest of it."""
    return exact // n, (exact % n) / n


def _centred(x: np.ndarray, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (x - whole).astype(float) - rest


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[Decimal]:
    """Exact sums of ``(n * x - S)^2`` over the dimensions, for each row of ``x``."""
    widest = float(np.abs(x).max()) * n + max(abs(s) for s in sums)
    if widest >= 2.0**52:
        t = x.astype(object) * n - np.array(sums, object)
        return [Decimal(int(v)) for v in (t * t).sum(1)]
    t = x * n - np.array(sums, np.int64)
    high, low = t >> 26, t & (1 << 26) - 1
    parts = ((a * b).astype(object).sum(1) for a, b in ((high, high), (high, low), (low, low)))
    return [Decimal((int(a) << 52) + (int(b) << 27) + int(c)) for a, b, c in zip(*parts, strict=True)]


def whiten(
    docs: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = COMPONENTS,
    counted: bool = True,
) -> DataFrame:
    """One row per row of ``docs`` with a sound vector: ``id``, ``n``, ``deviation``,
    ``whitened`` and ``explained`` (arrays, one entry per component) and
    ``identity_error``.

    Vectors that are null or hold null or non-finite entries are left out. Entries
    count in steps of 1/64. The fit takes each distinct vector as often as it occurs,
    or once with ``counted=False``. ``n`` is the sum of these weights, ``deviation``
    the exact sum over dimensions of ``(n * x - S)^2`` as decimal(38, 0). Components go
    by falling eigenvalue of the covariance; there are ``components`` at most, and none
    for directions without variance (a single vector, constant or dependent
    dimensions), so arrays may be shorter or empty. ``identity_error`` is the largest
    absolute entry of the whitened vectors' covariance, measured over the fit, less
    the identity; null where there are no components.

    Vectors of different lengths are different spaces, each with its own fit; vectors
    of length zero have ``n`` null and no components. Null and repeated ids stay as they
    are. An empty table gives no rows. Entries beyond 2^53 steps are cut to that. Only
    figures per dimension and matrices of a length squared reach the driver.
    """
    rows = grid_vectors(docs, key, vector)
    distinct = rows.groupBy("x").agg(F.count("*").alias("rows"))
    weight = F.col("rows") if counted else F.lit(1).cast("long")
    distinct = stored(distinct.select("x", weight.alias("weight")), "distinct-vectors")

    schema = "size int, place int, n long, sum decimal(38,0)"
    sums = distinct.mapInArrow(_sums, schema).groupBy("size", "place")
    known = defaultdict(dict)
    for row in sums.agg(F.sum("n").alias("n"), F.sum("sum").alias("sum")).collect():
        known[row.size][row.place] = (row.n, int(row.sum))
    totals = {
        size: (places[0][0], [places[i][1] for i in range(size)])
        for size, places in known.items()
    }
    means = {}
    for size, (n, exact) in totals.items():
        pairs = [_split(s, n) for s in exact]
        means[size] = (np.array([w for w, _ in pairs], np.int64), np.array([r for _, r in pairs]))
    context = docs.sparkSession.sparkContext
    centre = context.broadcast(means)

    def covariance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}
        for batch in batches:
            for _, x, weights in _by_length(batch):
                size = x.shape[1]
                found.setdefault(size, np.zeros((size, size)))
                for first in range(0, len(x), _BATCH_ROWS):
                    part = _centred(x[first : first + _BATCH_ROWS], *centre.value[size])
                    own = weights[first : first + _BATCH_ROWS, None]
                    found[size] += (part * own).T @ part
        yield _matrix_rows(found)

    directions, shares = {}, {}
    for size, matrix in _matrices(distinct.mapInArrow(covariance, _ROWS)).items():
        matrix = (matrix + matrix.T) / (2 * totals[size][0])
        values, vectors = np.linalg.eigh(matrix)
        trace = np.trace(matrix)
        kept = np.argsort(-values, kind="stable")[:components]
        kept = kept[values[kept] > LEAST_SHARE * trace]
        directions[size] = vectors[:, kept] / np.sqrt(values[kept])
        shares[size] = (values[kept] / trace).tolist()
    fitted = context.broadcast((totals, directions))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, directions = fitted.value
        for batch in batches:
            whitened, deviations = [[]] * len(batch), [None] * len(batch)
            for places, x, _ in _by_length(batch):
                size = x.shape[1]
                found = _centred(x, *centre.value[size]) @ directions[size]
                away = _deviations(x, *totals[size])
                for place, row, value in zip(places, found.tolist(), away, strict=True):
                    whitened[place], deviations[place] = row, value
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(deviations, pa.decimal128(38, 0)),
                    pa.array(whitened, pa.list_(pa.float64())),
                ],
                ["x", "weight", "deviation", "whitened"],
            )

    schema = "x binary, weight long, deviation decimal(38,0), whitened array<double>"
    white = stored(distinct.mapInArrow(project, schema), "whitened")
    errors = _errors(white, totals)
    facts = [
        (size, n, shares.get(size, []), errors.get(size)) for size, (n, _) in totals.items()
    ]
    facts = docs.sparkSession.createDataFrame(
        facts, "size int, n long, explained array<double>, identity_error double"
    )
    # One row per length of vector.
    size = F.octet_length("x") / F.lit(8)
    white = white.withColumn("size", size.cast("int")).join(F.broadcast(facts), "size", "left")
    none = F.array().cast("array<double>")
    white = white.select(
        F.unhex(F.sha2("x", 256)).alias("sha"),
        "n",
        "deviation",
        "whitened",
        F.coalesce("explained", none).alias("explained"),
        "identity_error",
    )
    named = rows.select("id", F.unhex(F.sha2("x", 256)).alias("sha"))
    named = stored(named, "vector-rows")
    return with_facts(named, white, "sha", "inner").drop("sha")


def _errors(white: DataFrame, totals: dict[int, tuple[int, list[int]]]) -> dict[int, float]:
    """For each length the largest absolute entry of the covariance of the whitened
    vectors less the identity."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {}
        for batch in batches:
            sizes = pc.binary_length(batch.column(0)).to_numpy() // 8
            weights = batch.column(1).to_numpy().astype(float)
            rows = batch.column(2)
            for size in np.unique(sizes[sizes > 0]):
                places = np.flatnonzero(sizes == size)
                flat = rows.take(pa.array(places)).flatten().to_numpy()
                y = flat.reshape(len(places), -1)
                if not y.shape[1]:
                    continue
                # A column of ones beside the vectors gives their sums.
                y = np.concatenate([y, np.ones((len(y), 1))], 1)
                own = (y * weights[places, None]).T @ y
                found[int(size)] = found.get(int(size), 0) + own
        yield _matrix_rows(found)

    out = {}
    for size, matrix in _matrices(
        white.select("x", "weight", "whitened").mapInArrow(moments, _ROWS)
    ).items():
        n = totals[size][0]
        mean = matrix[-1, :-1] / n
        found = matrix[:-1, :-1] / n - np.outer(mean, mean)
        out[size] = float(np.abs(found - np.eye(len(found))).max())
    return out


ship(__name__)
