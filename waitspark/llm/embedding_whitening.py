"""Embedding whitening by an incremental eigendecomposition and a distributed refinement.

A vector's entry ``c`` counts as the whole number ``floor(SCALE * c) + OFFSET``, so counts, sums and
distances from the mean are exact. Each partition keeps the spectrum of the scatter of its vectors: a
vector is a centred rank-one update, solved by the secular equation with deflation (``spectrum``). Equal
vectors of a batch are one update of their weight. The partitions' spectra are combined in groups of
``FAN``, again by rank-one updates, round by round. The joint eigenvectors are then the basis of a
Rayleigh-Ritz step: a second pass sums the products of the exactly centred vectors in that basis,
where the matrix is diagonal but for rounding, and its eigenvectors make the basis precise. A third
pass measures how far the covariance of the whitened values is from the identity.

Tasks hold one batch and one spectrum, of dimension squared numbers; the driver gets only such matrices.

Rows whose vector is null, is empty, or holds a null, NaN, infinity or an entry of at least 2**56 are
left out. Of vectors of several lengths those of the most frequent length remain (of several, the
longest). Repeated rows each count. A direction without spread gives null. An empty table gives an
empty result. A deviation that no long holds is null.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from waitspark.llm.common import share_package
from waitspark.llm.spectrum import Spectrum, whole_numbers
from waitspark.workspace import materialize

SCALE = 64.0
OFFSET = 1_000_000
#: Components that the query returns.
TOP = 32
#: States that one task combines.
FAN = 16
#: A variance below this share of the largest is rounding of a direction without spread.
NO_SPREAD = 1e-13


@dataclass(frozen=True)
class Whitening:
    """Count, sums and principal axes (columns, by falling variance) of the vectors it was fitted on."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    total_variance: float
    identity_error: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.total_variance) if self.total_variance else 0.0 for v in self.variances]


def whole_vectors(df: DataFrame, column: str) -> tuple[Column, Column]:
    """(whether a row's vector counts, its entries as whole numbers)."""
    vector = F.col(column).cast("array<double>")
    fits = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(2.0**56)))
    whole = F.transform(vector, lambda c: F.floor(F.lit(SCALE) * c) + F.lit(OFFSET))
    return vector.isNotNull() & (F.size(vector) > 0) & fits, whole


def _rows(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def centred(rows: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n`` times the distance of each of ``rows`` from the mean, exactly."""
    most = max(abs(int(rows.max())), abs(int(rows.min()))) if rows.size else 0
    kind = whole_numbers(n * most, *sums)
    return n * rows.astype(kind) - np.array(sums, dtype=kind)


def fold(states: DataFrame, merge: Callable[[list], object]) -> dict[int, object]:
    """One state for each ``size`` of ``states`` (part, size, state), merged in the order of ``part``.

    A task takes ``FAN`` states; each round is written, so that a lost executor costs only its own tasks.
    """

    def step(group: pa.Table) -> pa.Table:
        rows = sorted(group.to_pylist(), key=lambda r: r["part"])
        first = rows[0]
        state = pickle.dumps(merge([pickle.loads(r["state"]) for r in rows]))
        return pa.table({"part": [first["part"] // FAN], "size": [first["size"]], "state": [state]}, STATE_ARROW)

    states = materialize(states, "states")
    last = states.agg(F.max("part")).first()[0]
    while last:
        groups = states.groupBy("size", F.floor(F.col("part") / FAN).alias("_group"))
        states = materialize(groups.applyInArrow(step, STATE), "states")
        last //= FAN
    return {r["size"]: pickle.loads(r["state"]) for r in states.toLocalIterator()}


STATE = "part long, size int, state binary"
STATE_ARROW = pa.schema([("part", pa.int64()), ("size", pa.int32()), ("state", pa.binary())])


def by_task(df: DataFrame, start: Callable[[int], object], take: Callable[[object, np.ndarray], object]) -> DataFrame:
    """A state for each task and length of ``df``'s one column of whole vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        states: dict[int, object] = {}
        for batch in batches:
            column = batch.column(0)
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                same = column.filter(pa.array(sizes == size))
                states[size] = take(states[size] if size in states else start(size), _rows(same, size))
        part = TaskContext.get().partitionId()
        for size, state in states.items():
            yield pa.RecordBatch.from_pylist([{"part": part, "size": size, "state": pickle.dumps(state)}], STATE_ARROW)

    return df.mapInArrow(run, STATE)


def _add_all(spectrum: Spectrum, rows: np.ndarray) -> Spectrum:
    spectrum.add(*np.unique(rows, axis=0, return_counts=True))
    return spectrum


def _merge_all(spectra: list[Spectrum]) -> Spectrum:
    first, *others = spectra
    for other in others:
        first.merge(other)
    return first


def products(df: DataFrame, n: int, sums: list[int], basis: np.ndarray) -> np.ndarray:
    """Covariance of the centred vectors of ``df`` along the columns of ``basis``."""

    def take(total: np.ndarray, rows: np.ndarray) -> np.ndarray:
        along = (centred(rows, n, sums) / n).astype(float) @ basis
        return total + along.T @ along

    width = basis.shape[1]
    found = fold(by_task(df, lambda size: np.zeros((width, width)), take), sum)
    return found[len(sums)] / n


def fit(df: DataFrame, column: str = "embedding") -> Whitening | None:
    """The principal axes of all vectors in ``column`` that count; None if there is none."""
    share_package(df.sparkSession)
    counts, whole = whole_vectors(df, column)
    vectors = df.filter(counts).select(whole.alias("x"))
    spectra = fold(by_task(vectors, Spectrum.empty, _add_all), _merge_all)
    if not spectra:
        return None
    size, spectrum = max(spectra.items(), key=lambda item: (item[1].n, item[0]))
    vectors = vectors.filter(F.size("x") == size)
    basis, _ = np.linalg.qr(spectrum.vectors[:, ::-1])
    ritz, turn = np.linalg.eigh(products(vectors, spectrum.n, spectrum.sums, basis))
    axes, variances = basis @ turn[:, ::-1], np.maximum(ritz[::-1], 0)
    # Either sign is right: the largest entry of an axis is positive.
    axes = axes * np.sign(axes[np.abs(axes).argmax(axis=0), np.arange(size)])
    variances[variances <= NO_SPREAD * variances[0]] = 0
    spread = variances > 0
    error = 0.0
    if spread.any():
        white = products(vectors, spectrum.n, spectrum.sums, axes[:, spread] / np.sqrt(variances[spread]))
        error = float(np.abs(white - np.eye(len(white)))[:TOP, :TOP].max())
    return Whitening(spectrum.n, spectrum.sums, axes, variances, float(ritz.sum()), error)


def whiten(df: DataFrame, model: Whitening, column: str = "embedding", top: int = TOP, carry: list[str] | None = None) -> DataFrame:
    """``carry`` (all columns if None) of the rows that count, with ``deviation`` and ``whitened``.

    deviation: the sum of squares of ``n`` times the distance from the mean. whitened: the first ``top``
    components, each of variance 1. Columns of those names are replaced.
    """
    counts, whole = whole_vectors(df, column)
    size = len(model.sums)
    kept = [c for c in (df.columns if carry is None else carry) if c not in ("deviation", "whitened")]
    held = "_whole"
    while held in kept:
        held += "_"
    rows = df.filter(counts & (F.size(column) == size)).select(*kept, whole.alias(held))
    added = [T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
    schema = T.StructType([*df.select(*kept).schema.fields, *added])
    variances = model.variances[:top]
    with np.errstate(divide="ignore", invalid="ignore"):
        scaled = np.where(variances > 0, model.axes[:, :top] / np.sqrt(variances), 0.0)
    flat = np.flatnonzero(variances <= 0)
    n, sums = model.n, model.sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            apart = centred(_rows(batch.column(batch.num_columns - 1), size), n, sums)
            most = int(np.abs(apart).max()) if apart.size else 0
            squares = (apart.astype(whole_numbers(size * most * most)) ** 2).sum(axis=1).tolist()
            white = (apart / n).astype(float) @ scaled
            nulls = np.zeros(white.shape, bool)
            nulls[:, flat] = True
            values = pa.array(white.ravel(), pa.float64(), mask=nulls.ravel())
            offsets = pa.array(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1])
            deviation = pa.array([s if s < 2**63 else None for s in squares], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], deviation, pa.ListArray.from_arrays(offsets, values)], names=[*kept, "deviation", "whitened"]
            )

    return rows.mapInArrow(run, schema)


RESULT = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def op12(embeddings: DataFrame) -> DataFrame:
    """A row for each vector that counts and each of its first components."""
    model = fit(embeddings)
    if model is None:
        kind = embeddings.schema["vec_id"].dataType.simpleString()
        return embeddings.sparkSession.createDataFrame([], RESULT.format(id=kind))
    rows = whiten(embeddings, model, carry=["vec_id"])
    shares = F.array(*map(F.lit, model.explained[:TOP]))
    exploded = rows.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return exploded.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("place") + 1).alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )
