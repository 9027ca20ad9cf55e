"""Embedding whitening: centred covariance, leading components, broadcast projection.

An entry c of a vector becomes ``floor(64 c) + 1000000``; the fit list is every distinct such
vector once, written to the shared folder. Its covariance is summed in tasks over vectors that
are centred before they are multiplied; the driver gets one number a pair of dimensions, never
vectors. ``eigen.leading`` finds the components; every row is projected with them.

A vector travels as bytes: the narrowest width that holds its entries less the offset, then the
entries. Equal vectors have equal bytes, copies collapse in their task before the shuffle.

Defined cases: rows whose vector is null or holds null, NaN or infinite entries give no output;
so do vectors whose length is not that of most distinct vectors (ties: the shorter; empty vectors
never count). Null ids stay, repeated rows each get their output. Entries beyond a long are the
nearest long; a deviation beyond a long is null. A component without variance (zero to double
precision) is left out: a table of one distinct vector, or none, gives no rows. Other columns
are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventweave.llm import eigen
from eventweave.llm.frames import need, record_batch, arrow_schema, stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
_LONG = 2.0 ** 63


def matrix(col: pa.Array | pa.ChunkedArray) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Length -> (row numbers, entries) of the finite vectors of a list<double> column."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    rows = np.flatnonzero(np.asarray(col.is_valid()))
    size = np.asarray(col.value_lengths().fill_null(0)).astype(np.int64)[rows]
    flat = col.flatten()
    value = np.asarray(flat.fill_null(float("nan")), dtype=float)
    first = np.concatenate([[0], np.cumsum(size)])[:-1]
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(value))])
    good = bad[first + size] == bad[first]
    out = {}
    for d in np.unique(size[good & (size > 0)]).tolist():
        at = good & (size == d)
        out[d] = rows[at], value[first[at][:, None] + np.arange(d)]
    return out


def whole(entries: np.ndarray) -> np.ndarray:
    """``floor(64 c)`` as longs (x less its offset), the nearest long where it does not fit."""
    with np.errstate(over="ignore"):
        f = np.floor(SCALE * entries)
    inside = np.abs(f) < _LONG
    top = np.int64(2 ** 63 - 1 - OFFSET)
    y = np.where(inside, f, 0.0).astype(np.int64)
    y = np.where(inside, y, np.where(f > 0, top, -top - 1))
    return np.minimum(y, top)


def encoded(y: np.ndarray) -> pa.Array:
    """Distinct rows of ``y`` as bytes: width, then entries of that width."""
    reach = np.maximum(y.max(axis=1), -1 - y.min(axis=1))      # v fits w bytes if it is below 2^(8w-1)
    parts = []
    for width in (1, 2, 4, 8):
        fits = reach < 1 << (8 * width - 1) if width < 8 else np.ones(len(y), bool)
        own = y[fits]
        y, reach = y[~fits], reach[~fits]
        if not len(own):
            continue
        raw = np.ascontiguousarray(own.astype(f"<i{width}")).view(np.uint8).reshape(len(own), -1)
        raw = np.concatenate([np.full((len(own), 1), width, np.uint8), raw], axis=1)
        uniq = np.unique(np.ascontiguousarray(raw).view(f"V{raw.shape[1]}").ravel())
        offsets = (np.arange(len(uniq) + 1) * raw.shape[1]).astype(np.int32)
        parts.append(pa.Array.from_buffers(pa.binary(), len(uniq), [None, pa.py_buffer(offsets), pa.py_buffer(uniq.tobytes())]))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.binary())


def decoded(col: pa.Array, dim: int) -> np.ndarray:
    """Rows of longs from their bytes."""
    out = np.empty((len(col), dim), np.int64)
    size = np.asarray(pa.compute.binary_length(col))
    for width in (1, 2, 4, 8):
        at = np.flatnonzero(size == 1 + width * dim)
        if len(at):
            joined = b"".join(col.take(pa.array(at)).to_pylist())
            out[at] = np.frombuffer(joined, np.uint8).reshape(len(at), -1)[:, 1:].copy().view(f"<i{width}")
    return out


@dataclass
class Whitening:
    """n distinct vectors of ``dim`` entries, their sums (less the offset), and the components."""
    n: int
    dim: int
    sums: list[int]
    values: np.ndarray          # eigenvalues, falling
    vectors: np.ndarray         # unit eigenvectors as columns
    trace: float
    identity_error: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


def distinct_vectors(embeddings: DataFrame, vector: str) -> DataFrame:
    """``dim, key`` of every distinct vector."""
    def run(batches):
        schema = arrow_schema(out)
        for batch in batches:
            for dim, (_, entries) in matrix(batch.column(0)).items():
                keys = encoded(whole(entries))
                yield record_batch({"dim": pa.array(np.full(len(keys), dim, np.int32)), "key": keys}, schema)

    from pyspark.sql.types import BinaryType, IntegerType, StructField, StructType
    out = StructType([StructField("dim", IntegerType()), StructField("key", BinaryType())])
    return embeddings.select(F.col(vector).cast("array<double>").alias("v")).mapInArrow(run, out).distinct()


def _pair_sums(fit: DataFrame, dim: int, mean: np.ndarray, project: np.ndarray | None = None) -> np.ndarray:
    """Sums over the fit list of the products of centred (and projected) entries."""
    shared = fit.sparkSession.sparkContext.broadcast((mean, project))

    def run(batches):
        middle, onto = shared.value
        width = dim if onto is None else onto.shape[1]
        total = np.zeros((width, width))
        for batch in batches:
            c = decoded(batch.column(0), dim) - middle
            c = c if onto is None else c @ onto
            total += c.T @ c
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_pydict({"i": pa.array(i.astype(np.int32)), "j": pa.array(j.astype(np.int32)), "v": pa.array(total[i, j])})

    sums = fit.select("key").mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    width = dim if project is None else project.shape[1]
    out = np.zeros((width, width))           # a number a pair of dimensions
    i, j = sums["i"].to_numpy(int), sums["j"].to_numpy(int)
    out[i, j] = out[j, i] = sums["v"].to_numpy(float)
    return out


def _sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """(vectors, exact sum of every dimension)."""
    def run(batches):
        total, n = [0] * dim, 0
        for batch in batches:
            y = decoded(batch.column(0), dim)
            if len(y):
                reach = int(max(y.max(), -(y.min() + 1))) + 1
                part = y.sum(axis=0) if reach * len(y) < 1 << 62 else y.astype(object).sum(axis=0)
                total, n = [a + int(b) for a, b in zip(total, part)], n + len(y)
        yield pa.RecordBatch.from_pydict({"j": pa.array([*range(dim), dim], pa.int32()), "s": pa.array([str(v) for v in (*total, n)], pa.string())})

    got = (fit.select("key").mapInArrow(run, "j int, s string").groupBy("j")
           .agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect())        # one row a dimension
    by = {r["j"]: int(r["s"]) for r in got}
    return by.get(dim, 0), [by.get(j, 0) for j in range(dim)]


def fit(embeddings: DataFrame, *, vector: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The whitening of the table's distinct vectors."""
    need(embeddings, vector)
    every = stored(distinct_vectors(embeddings, vector), "vectors")
    most = every.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if most is None:
        return Whitening(0, 0, [], np.zeros(0), np.zeros((0, 0)), 0.0, 0.0)
    dim = most["dim"]
    own = every.filter(F.col("dim") == dim)
    n, sums = _sums(own, dim)
    mean = np.array([s / n for s in sums])
    covariance = _pair_sums(own, dim, mean) / n
    values, found = eigen.leading(covariance, components)
    error = 0.0
    if len(values):
        error = float(np.abs(_pair_sums(own, dim, mean, found / np.sqrt(values)) / n - np.eye(len(values))).max())
    return Whitening(n, dim, sums, values, found, float(np.trace(covariance)), error)


def deviations(y: np.ndarray, n: int, sums: list[int]) -> list[int | None] | np.ndarray:
    """Sum over dimensions of ``(n x - S)^2``, exactly."""
    reach = max(abs(int(y.max())), abs(int(y.min())))
    worst = n * reach + max(abs(s) for s in sums)
    if worst * worst * y.shape[1] < 1 << 63:
        off = n * y - np.array(sums, np.int64)
        return np.einsum("ij,ij->i", off, off)
    off = n * y.astype(object) - np.array(sums, dtype=object)
    return [int(v) if v < 1 << 63 else None for v in (off * off).sum(axis=1)]


def whiten(embeddings: DataFrame, model: Whitening, *, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """One row a vector and component: ``vec_id, component, n, deviation, whitened, explained,
    identity_error``."""
    need(embeddings, key, vector)
    shared = embeddings.sparkSession.sparkContext.broadcast(model)
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"

    def run(batches):
        m = shared.value
        k = len(m.values)
        names = ("vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
        for batch in batches:
            rows, entries = matrix(batch.column(1)).get(m.dim, (np.zeros(0, int), np.zeros((0, m.dim))))
            if not k or not len(rows):
                continue
            y = whole(entries)
            ids = batch.column(0).take(pa.array(np.repeat(rows, k)))
            z = (y - m.mean) @ (m.vectors / np.sqrt(m.values))
            dev = pa.array(deviations(y, m.n, m.sums), pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k)))
            cells = len(rows) * k
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(rows))), pa.array(np.full(cells, m.n, np.int64)), dev,
                 pa.array(z.ravel()), pa.array(np.tile(m.values / m.trace, len(rows))), pa.array(np.full(cells, m.identity_error))], names=names)

    return (embeddings.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
            .mapInArrow(run, schema))
