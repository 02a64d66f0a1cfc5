"""A regression network of the wait, trained by synchronous mini-batches.

The training rows are put into a fixed random order and dealt into blocks of ``BLOCK_ROWS``, each one row
of a table partitioned by mini-batch. A step reads one mini-batch; its tasks turn each block into the
gradient of the squared loss, and only those sums, a few thousand numbers a task, reach the driver,
where Adam takes the step. Batch norm and dropout work within a block. Sums are of whole multiples of
``GRID``, so the order in which tasks end changes nothing: a model is the same on any number of cores.

After each epoch both splits' losses and the state are written below ``state``, so a stopped training
goes on from its last epoch, and from any earlier one.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from waitspark.operators.losses import loss_rows
from waitspark.operators.ordering import with_positions
from waitspark.schema import SEED, TARGET
from waitspark.workspace import discard, materialize

# The layers, of which the first two are normalised, and the training settings.
HIDDEN_LAYERS = [64, 32, 16]
NORMALISED = 2
DROPOUT = 0.1
EPOCHS = 50
BLOCK_ROWS = 512
MOMENTUM = 0.1
NORM_EPSILON = 1e-5
BETAS = (0.9, 0.999)
ADAM_EPSILON = 1e-8

# Steps of an epoch, if there are as many blocks; more rows make larger mini-batches.
STEPS = 4
# Adam's step: larger than the usual 0.001, for epochs of few steps.
STEP_SIZE = 0.01
# Unit of the summed gradients and losses.
GRID = 2.0**-24
# Blocks of a file.
FILE_BLOCKS = 64
# Task results that are summed on the driver; more are added up in tasks first.
DIRECT_SUMS = 64


@dataclass(frozen=True)
class Shape:
    """Where the arrays of a network of some layer sizes lie in one vector."""

    sizes: tuple[int, ...]

    @property
    def pieces(self) -> list[tuple[str, tuple[int, ...]]]:
        found = []
        for i, (a, b) in enumerate(zip(self.sizes, self.sizes[1:])):
            found += [(f"w{i}", (a, b)), (f"b{i}", (b,))]
            if i < NORMALISED and i < len(self.sizes) - 2:
                found += [(f"scale{i}", (b,)), (f"shift{i}", (b,))]
        return found

    @property
    def length(self) -> int:
        return sum(math.prod(s) for _, s in self.pieces)

    @property
    def normalised(self) -> list[int]:
        """Widths of the normalised layers."""
        return [s[0] for name, s in self.pieces if name.startswith("scale")]

    def arrays(self, vector: np.ndarray) -> dict[str, np.ndarray]:
        found, at = {}, 0
        for name, shape in self.pieces:
            end = at + math.prod(shape)
            found[name] = vector[at:end].reshape(shape)
            at = end
        return found

    def start(self, seed: int) -> np.ndarray:
        """Uniform weights within one over the root of a layer's inputs; scales of 1."""
        rng = np.random.default_rng(seed)
        parts = []
        for name, shape in self.pieces:
            inputs = self.sizes[int(name[-1])]
            if name[0] == "s":
                parts.append(np.full(shape, 1.0 if name.startswith("scale") else 0.0))
            else:
                parts.append(rng.uniform(-1, 1, shape) / math.sqrt(inputs))
        return np.concatenate([p.ravel() for p in parts])


def predict(shape: Shape, theta: np.ndarray, running: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Outputs with the running means and variances of the normalised layers."""
    p, at = shape.arrays(theta), 0
    last = len(shape.sizes) - 2
    for i in range(last):
        x = np.maximum(x @ p[f"w{i}"] + p[f"b{i}"], 0)
        if f"scale{i}" in p:
            width = x.shape[1]
            mean, variance = running[at : at + width], running[at + width : at + 2 * width]
            x = (x - mean) / np.sqrt(variance + NORM_EPSILON) * p[f"scale{i}"] + p[f"shift{i}"]
            at += 2 * width
    return (x @ p[f"w{last}"] + p[f"b{last}"])[:, 0]


def gradient(
    shape: Shape, theta: np.ndarray, x: np.ndarray, y: np.ndarray, rng: np.random.Generator | None
) -> tuple[float, np.ndarray, np.ndarray]:
    """(sum of squared errors of a block, its gradient, the block's means and variances times its rows).

    ``rng`` draws what drops out; None drops nothing. Arrays of a block are changed in place where they can be:
    making new ones costs more than the arithmetic.
    """
    p = shape.arrays(theta)
    out = np.zeros_like(theta)
    g = shape.arrays(out)
    last = len(shape.sizes) - 2
    kept, moments = [], []
    h = x
    for i in range(last):
        inputs = h
        a = inputs @ p[f"w{i}"]
        a += p[f"b{i}"]
        h = np.maximum(a, 0)
        norm = None
        if f"scale{i}" in p:
            mean = h.mean(axis=0)
            h -= mean
            variance = np.einsum("ij,ij->j", h, h) / len(h)
            moments += [mean, variance]
            root = np.sqrt(variance + NORM_EPSILON)
            h /= root
            norm = h, root
            h = h * p[f"scale{i}"]
            h += p[f"shift{i}"]
        mask = None
        if rng is not None:
            mask = rng.random(h.shape) >= DROPOUT
            h *= mask
            h *= 1 / (1 - DROPOUT)
        kept.append((inputs, a, norm, mask))
    error = (h @ p[f"w{last}"] + p[f"b{last}"])[:, 0] - y
    d = 2 * error[:, None]
    g[f"w{last}"][:] = h.T @ d
    g[f"b{last}"][:] = d.sum(axis=0)
    d = d @ p[f"w{last}"].T
    for i in reversed(range(last)):
        inputs, a, norm, mask = kept[i]
        if mask is not None:
            d *= mask
            d *= 1 / (1 - DROPOUT)
        if norm is not None:
            unit, root = norm
            along = d * unit
            scale, n = p[f"scale{i}"], len(d)
            g[f"scale{i}"][:] = along.sum(axis=0)
            g[f"shift{i}"][:] = d.sum(axis=0)
            d *= scale
            d -= scale * g[f"shift{i}"] / n
            d -= np.multiply(unit, scale * g[f"scale{i}"] / n, out=along)
            d /= root
        d *= a > 0
        g[f"w{i}"][:] = inputs.T @ d
        g[f"b{i}"][:] = d.sum(axis=0)
        if i:
            d = d @ p[f"w{i}"].T
    seen = np.concatenate(moments) * len(x) if moments else np.zeros(0)
    return float(error @ error), out, seen


def blocks(rows: DataFrame, label: str, size: int, mean: float, spread: float, steps: int) -> tuple[DataFrame, int, int]:
    """(batch, block, data) of ``rows`` with ``features`` in a fixed random order, written; blocks; rows.

    A block's data are its features and scaled label, row after row. The order goes by a hash, copies of
    a row are dealt to blocks in turn, so blocks are alike however the rows were partitioned.
    """
    narrow = rows.select(
        F.concat(vector_to_array("features"), F.array(F.col(label).cast("double"))).alias("x")
    ).withColumn("_hash", F.xxhash64("x", F.lit(SEED)))
    placed = with_positions(narrow, ["_hash", "x"])
    total = placed.count()
    count = max(1, -(-total // BLOCK_ROWS))
    steps = min(steps, count)

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("position")
        data = group["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, size + 1).copy()
        data[:, -1] = (data[:, -1] - mean) / spread
        block = group["block"][0].as_py()
        kinds = pa.schema([("block", pa.int64()), ("data", pa.binary()), ("batch", pa.int32())])
        return pa.table({"block": [block], "data": [data.tobytes()], "batch": [block % steps]}, kinds)

    dealt = placed.select((F.col("position") % count).alias("block"), "position", "x")
    packed = dealt.groupBy("block").applyInArrow(pack, "block long, data binary, batch int")
    # A file holds some blocks of one mini-batch, so a step starts no more tasks than it has work for.
    packed = packed.repartition("batch", F.floor(F.col("block") / (steps * FILE_BLOCKS)))
    return materialize(packed, "blocks", ["batch"]), steps, total


def summed(df: DataFrame, tasks: int, work: Callable[[int, np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """The sum over all blocks (block, data) of ``work``'s numbers, in units of ``GRID``, exactly.

    ``tasks`` is the number of partitions of ``df``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = None
        for batch in batches:
            for block, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found = np.rint(work(block, np.frombuffer(data).reshape(-1, size)) / GRID).astype(np.int64)
                total = found if total is None else total + found
        if total is not None:
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "sums": [total.tobytes()]}, kinds)

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(s, np.int64) for s in group["sums"].to_pylist())
        return pa.table({"part": [group["part"][0].as_py() // DIRECT_SUMS], "sums": [total.tobytes()]}, kinds)

    kinds = pa.schema([("part", pa.int64()), ("sums", pa.binary())])
    sums = df.select("block", "data").mapInArrow(run, "part long, sums binary")
    if tasks > DIRECT_SUMS:
        sums = sums.groupBy(F.floor(F.col("part") / DIRECT_SUMS)).applyInArrow(add, "part long, sums binary")
    return sum(np.frombuffer(r["sums"], np.int64) for r in sums.collect()) * GRID


@dataclass(frozen=True)
class WaitNetwork:
    """A trained network over the feature vector; its prediction is in the label's unit."""

    sizes: tuple[int, ...]
    theta: np.ndarray
    running: np.ndarray
    mean: float
    spread: float

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` with ``prediction`` from its ``features``."""
        shape, theta, running, mean, spread = Shape(self.sizes), self.theta, self.running, self.mean, self.spread

        @F.pandas_udf("double")
        def outputs(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=float)
            return pd.Series(predict(shape, theta, running, np.stack(x.to_numpy())) * spread + mean)

        return df.withColumn("prediction", outputs(vector_to_array("features")))

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        row = (list(self.sizes), self.theta.tolist(), self.running.tolist(), self.mean, self.spread)
        spark.createDataFrame(
            [row], "sizes array<int>, theta array<double>, running array<double>, mean double, spread double"
        ).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, path: str) -> WaitNetwork:
        row = SparkSession.active().read.parquet(path).first()
        return cls(tuple(row["sizes"]), np.array(row["theta"]), np.array(row["running"]), row["mean"], row["spread"])


@dataclass
class _State:
    """What a training goes on from after an epoch."""

    theta: np.ndarray
    running: np.ndarray
    first: np.ndarray
    second: np.ndarray
    step: int
    losses: list[tuple[float, float | None]]


def _written(spark: SparkSession, state: str) -> list[int]:
    """Epochs whose state is below ``state``."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(state)
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(folder):
        return []
    names = [s.getPath().getName() for s in system.listStatus(folder)]
    done = [n for n in names if n.startswith("epoch=") and system.exists(spark._jvm.org.apache.hadoop.fs.Path(f"{state}/{n}/_SUCCESS"))]
    return sorted(int(n.removeprefix("epoch=")) for n in done)


def train_network(
    train: DataFrame,
    validation: DataFrame | None = None,
    epochs: int = EPOCHS,
    label: str = TARGET,
    steps: int = STEPS,
    step_size: float = STEP_SIZE,
    state: str | None = None,
    restart: int | None = None,
) -> tuple[WaitNetwork, DataFrame]:
    """(network, mean squared loss per epoch of the training rows, and of the validation rows if given).

    The label is scaled to mean 0 and deviation 1 of the training rows and losses are scaled back. The
    training loss is that of the steps, with dropout; the validation loss is that of the network as it
    predicts. With ``state``, a folder, training goes on after the last epoch written there, or after
    epoch ``restart``.
    """
    spark = train.sparkSession
    head = train.agg(F.avg(label), F.stddev_pop(label), F.first(F.size(vector_to_array("features")))).first()
    if head[0] is None:
        raise ValueError("no training rows")
    mean, spread, size = float(head[0]), float(head[1] or 1.0), int(head[2])
    shape = Shape((size, *HIDDEN_LAYERS, 1))
    table, steps, total = blocks(train, label, size, mean, spread, steps)
    batches = [table.filter(F.col("batch") == k) for k in range(steps)]
    tasks = [b.rdd.getNumPartitions() for b in batches]
    sizes = [_rows_of(b, size + 1) for b in batches]
    held = blocks(validation, label, size, mean, spread, 1) if validation is not None else None
    held_tasks = held[0].rdd.getNumPartitions() if held else 0
    widths = shape.normalised
    running = np.concatenate([np.concatenate([np.zeros(w), np.ones(w)]) for w in widths]) if widths else np.zeros(0)
    theta = shape.start(SEED)
    now = _State(theta, running, np.zeros_like(theta), np.zeros_like(theta), 0, [])
    if state:
        done = [e for e in _written(spark, state) if e <= (epochs if restart is None else restart)]
        if done:
            now = pickle.loads(spark.read.parquet(f"{state}/epoch={done[-1]}").first()["state"])
    for epoch in range(len(now.losses), epochs):
        loss = 0.0
        for k in np.random.default_rng((SEED, epoch)).permutation(steps).tolist():
            loss += _step(now, shape, batches[k], tasks[k], sizes[k], epoch, size + 1, step_size)
        seen = None
        if held is not None and held[2]:
            seen = _loss(shape, now, held[0], held_tasks, size + 1) / held[2] * spread**2
        now.losses.append((loss / total * spread**2, seen))
        if state:
            row = [(pickle.dumps(now),)]
            spark.createDataFrame(row, "state binary").write.mode("overwrite").parquet(f"{state}/epoch={epoch + 1}")
    discard(table, *([held[0]] if held else []))
    curve = loss_rows(spark, "network", "train", [a for a, _ in now.losses])
    if held is not None:
        curve = curve.unionByName(
            loss_rows(spark, "network", "validation", [b for _, b in now.losses if b is not None])
        )
    return WaitNetwork(shape.sizes, now.theta, now.running, mean, spread), curve


def _rows_of(batch: DataFrame, width: int) -> int:
    return batch.agg(F.sum(F.octet_length("data"))).first()[0] // (8 * width)


def _step(now: _State, shape: Shape, batch: DataFrame, tasks: int, rows: int, epoch: int, width: int, step_size: float) -> float:
    """One step of Adam on the gradient of a mini-batch; the loss summed over its rows."""
    theta = now.theta

    def work(block: int, data: np.ndarray) -> np.ndarray:
        rng = np.random.default_rng((SEED, epoch, block))
        loss, found, moments = gradient(shape, theta, data[:, :-1], data[:, -1], rng)
        return np.concatenate([[loss], found, moments])

    sums = summed(batch, tasks, work, width)
    slope, moments = sums[1 : 1 + len(theta)] / rows, sums[1 + len(theta) :] / rows
    now.running = (1 - MOMENTUM) * now.running + MOMENTUM * moments
    now.step += 1
    now.first = BETAS[0] * now.first + (1 - BETAS[0]) * slope
    now.second = BETAS[1] * now.second + (1 - BETAS[1]) * slope**2
    first, second = now.first / (1 - BETAS[0] ** now.step), now.second / (1 - BETAS[1] ** now.step)
    now.theta = theta - step_size * first / (np.sqrt(second) + ADAM_EPSILON)
    return float(sums[0])


def _loss(shape: Shape, now: _State, table: DataFrame, tasks: int, width: int) -> float:
    theta, running = now.theta, now.running

    def work(block: int, data: np.ndarray) -> np.ndarray:
        error = predict(shape, theta, running, data[:, :-1]) - data[:, -1]
        return np.array([error @ error])

    return float(summed(table, tasks, work, width)[0])
