"""Embedding whitening: exact integer covariance from bit planes, then principal axes of unit variance.

Entries become integers. Each task packs the bit planes of every dimension, shifted to start at zero,
across rows into 64-bit words; the cross-products are weighted counts of the set bits that two planes
share. Tasks send one sum per pair of dimensions, cut into limbs that Spark can add without overflow.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairmill.sources.staging import spread

#: Rows whose bit planes are packed and multiplied at once.
BLOCK_ROWS = 8192
#: Bits and number of the limbs of a sum: 200 bits hold the squares of longs over any number of rows.
LIMB_BITS, LIMBS = 40, 5
#: Planes multiplied at a time hold so many words.
WORDS = 1 << 20


def whole_numbers(values: np.ndarray, scale: int, shift: int) -> np.ndarray:
    """``floor(scale * c) + shift`` as longs; what does not fit ends at 2 ** 62 on either side."""
    x = np.floor(values * scale)
    fits = np.abs(x) < 2.0 ** 62
    return np.where(fits, np.where(fits, x, 0).astype(np.int64) + shift,
                    np.where(x > 0, 1 << 62, -(1 << 62)))


def vectors(batches: Iterable[pa.RecordBatch], scale: int, shift: int,
            limit: int = BLOCK_ROWS) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Ids and integer matrices of the usable rows, for each block and length of vectors."""
    for batch in batches:
        lists = batch.column("vector")
        given = pc.is_valid(lists)
        ids, lists = batch.column("vec_id").filter(given), lists.filter(given)
        lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)  # null becomes NaN
        starts = np.cumsum(lengths) - lengths
        for dims in np.unique(lengths[lengths > 0]).tolist():
            rows = np.flatnonzero(lengths == dims)
            for at in range(0, len(rows), limit):
                own = rows[at:at + limit]
                matrix = flat[starts[own][:, None] + np.arange(dims)]
                usable = np.isfinite(matrix).all(1)
                if usable.any():
                    yield (ids.take(pa.array(own[usable])),
                           whole_numbers(matrix[usable], scale, shift))


def cross_products(x: np.ndarray) -> np.ndarray:
    """The exact sums of products of each two columns of an integer matrix, as Python integers."""
    low = x.min(0)
    rise = (x - low).astype(np.uint64)  # wraps to the right value where the gap exceeds a long
    depth = [int(v).bit_length() for v in rise.max(0)]
    owner = np.repeat(np.arange(len(depth)), depth)
    bit = np.concatenate([np.arange(k, dtype=np.uint64) for k in depth])
    gram = np.zeros((len(depth), len(depth)), object)
    if len(owner):
        planes = np.packbits((rise[:, owner] >> bit & np.uint64(1)).astype(np.uint8), axis=0)
        planes = np.pad(planes, ((0, -len(planes) % 8), (0, 0)))
        words = np.ascontiguousarray(planes.T).view(np.uint64)
        shared = np.zeros((len(owner), len(owner)), np.int64)
        step = max(1, WORDS // words.shape[1])
        for i in range(len(owner)):
            for j in range(i, len(owner), step):
                both = words[i] & words[j:j + step]
                shared[i, j:j + step] = np.bitwise_count(both).sum(1, dtype=np.int64)
        shared = np.maximum(shared, shared.T)
        exact = np.int64 if 2 * max(depth) + len(x).bit_length() < 63 else object
        weight = np.array([1 << int(b) for b in bit], exact)
        # Planes of a dimension stand together: sum them along both sides.
        edges = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
        part = np.add.reduceat(shared.astype(exact) * weight, edges, axis=1)
        part = np.add.reduceat(part * weight[:, None], edges, axis=0).astype(object)
        used = owner[edges]
        gram[np.ix_(used, used)] = part
    low, total = low.astype(object), column_sums(x) - len(x) * low.astype(object)
    return gram + np.outer(low, total) + np.outer(total, low) + len(x) * np.outer(low, low)


def column_sums(x: np.ndarray) -> np.ndarray:
    return (x >> 31).sum(0).astype(object) * (1 << 31) + (x & (1 << 31) - 1).sum(0).astype(object)


def _limbs(value: int) -> list[int]:
    """The lowest limbs are from 0 on, the highest carries the sign."""
    low = (1 << LIMB_BITS) - 1
    return [value >> LIMB_BITS * i & low for i in range(LIMBS - 1)] + [value >> LIMB_BITS * (LIMBS - 1)]


@dataclass(frozen=True)
class Fit:
    """What the fit list of one vector length says; ``axes`` has a column for each component."""

    n: int
    sums: list[int]
    axes: np.ndarray
    variances: np.ndarray
    explained: np.ndarray

    @property
    def scaling(self) -> np.ndarray:
        """Axes over the root of their variance; a component without variance gives NaN."""
        flat = self.variances <= self.variances.max(initial=0) * len(self.sums) * np.finfo(float).eps
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(flat, np.nan, self.axes / np.sqrt(np.abs(self.variances)))

    def away(self, x: np.ndarray) -> np.ndarray:
        """``n * x - S``, exact: as longs where they hold it, else as Python integers."""
        low, high = x.min(0).astype(object), x.max(0).astype(object)
        sums = np.array(self.sums, object)
        most = max(map(abs, (self.n * low - sums).tolist() + (self.n * high - sums).tolist()))
        if most < 1 << 62:  # the difference fits, so it is right even where its terms wrap
            return x * np.int64(self.n) - np.array([s % (1 << 64) for s in self.sums], np.uint64).view(np.int64)
        return x.astype(object) * self.n - sums

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return (self.away(x) / self.n).astype(np.float64) @ self.scaling

    def deviation(self, x: np.ndarray) -> list[int]:
        """The exact sum over dimensions of ``(n * x - S) ** 2``."""
        e = self.away(x)
        if e.dtype != object and len(self.sums) * int(np.abs(e).max()) ** 2 >= 1 << 63:
            e = e.astype(object)
        return (e * e).sum(1).tolist()


def fitted(rows: DataFrame, components: int, scale: int, shift: int) -> dict[int, Fit]:
    """A fit for each length of vectors. The driver gets the square of the length in sums, whatever
    the number of rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for ids, x in vectors(batches, scale, shift):
            own = held.setdefault(x.shape[1], [0, 0, 0])
            own[0] += len(x)
            own[1] = own[1] + column_sums(x)
            own[2] = own[2] + cross_products(x)
        for dims, (n, sums, gram) in held.items():
            found = [(-1, -1, n), *((-1, i, s) for i, s in enumerate(sums)),
                     *((i, j, gram[i, j]) for i in range(dims) for j in range(i, dims))]
            limbs = zip(*(_limbs(int(v)) for _, _, v in found), strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array([dims] * len(found), pa.int32()), pa.array([f[0] for f in found], pa.int32()),
                 pa.array([f[1] for f in found], pa.int32()), *(pa.array(x, pa.int64()) for x in limbs)],
                ["dims", "i", "j", *(f"limb{k}" for k in range(LIMBS))])

    names = [f"limb{k}" for k in range(LIMBS)]
    sums = rows.mapInArrow(run, "dims int, i int, j int, " + ", ".join(f"{x} long" for x in names))
    totals: dict[int, dict[tuple[int, int], int]] = {}
    for r in sums.groupBy("dims", "i", "j").agg(*[F.sum(x).alias(x) for x in names]).toLocalIterator():
        totals.setdefault(r.dims, {})[r.i, r.j] = sum(r[x] << LIMB_BITS * k for k, x in enumerate(names))
    return {dims: _fit(dims, found, components) for dims, found in totals.items()}


def _fit(dims: int, found: dict[tuple[int, int], int], components: int) -> Fit:
    n = found[-1, -1]
    sums = [found[-1, i] for i in range(dims)]
    cov = np.array([[(n * found[min(i, j), max(i, j)] - sums[i] * sums[j]) / (n * n)
                     for j in range(dims)] for i in range(dims)])
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:components]
    trace = float(np.trace(cov))
    explained = np.maximum(values[order], 0) / trace if trace > 0 else np.full(len(order), math.nan)
    return Fit(n, sums, axes[:, order], np.maximum(values[order], 0), explained)


def identity_errors(rows: DataFrame, fits: dict[int, Fit], scale: int, shift: int) -> dict[int, float]:
    """For each length, the largest absolute entry of the whitened rows' covariance minus the
    identity, over the components that have variance; measured on all rows."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for _, x in vectors(batches, scale, shift):
            w = fits[x.shape[1]].whitened(x)
            w = np.column_stack([w, np.ones(len(w))])  # the last row and column become the sums
            held[x.shape[1]] = held.get(x.shape[1], 0.0) + w.T @ w
        for dims, gram in held.items():
            i, j = np.triu_indices(len(gram))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(i), dims, np.int32)), pa.array(i.astype(np.int32)),
                 pa.array(j.astype(np.int32)), pa.array(gram[i, j])], ["dims", "i", "j", "total"])

    sums = rows.mapInArrow(run, "dims int, i int, j int, total double").groupBy("dims", "i", "j")
    grams = {d: np.zeros((len(f.variances) + 1,) * 2) for d, f in fits.items()}
    for r in sums.agg(F.sum("total").alias("total")).toLocalIterator():
        grams[r.dims][r.i, r.j] = grams[r.dims][r.j, r.i] = r.total
    errors = {}
    for dims, gram in grams.items():
        mean = gram[-1, :-1] / fits[dims].n
        off = np.abs(gram[:-1, :-1] / fits[dims].n - np.outer(mean, mean) - np.eye(len(mean)))
        off = off[np.isfinite(off)]
        errors[dims] = float(off.max()) if len(off) else math.nan
    return errors


def whitened(table: DataFrame, vector: str = "embedding", components: int = 32, scale: int = 64,
             shift: int = 1_000_000) -> DataFrame:
    """``vec_id``, ``dims``, ``n``, ``deviation``, ``deviation_wide``, ``whitened``, ``explained`` and
    ``identity_error`` of every row whose vector is not null, not empty and has finite entries only.

    ``table`` needs ``vec_id`` and ``vector``, an array of numbers; other columns are not read. Each entry c
    becomes ``floor(scale * c) + shift`` (2 ** 62 with its sign where that fits no long). Their
    covariance has the divisor ``n``, all such rows of the same length: vectors of another length lie
    in another space and get a fit of their own. ``whitened`` is an array of the row's scores on the
    first ``components`` axes, each over the root of its variance, and ``explained`` the axes' shares
    of the variance. ``deviation`` is null where it exceeds a long, ``deviation_wide`` where it
    exceeds 38 digits. A component without variance (equal rows, one row) has null scores. Repeated
    rows and ids, and null ids, give a row each and count as often as they occur. An empty table
    gives no rows.
    """
    rows = spread(table.select(F.col("vec_id"), F.col(vector).alias("vector")))
    fits = fitted(rows, components, scale, shift)
    errors = identity_errors(rows, fits, scale, shift)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in vectors(batches, scale, shift):
            fit = fits[x.shape[1]]
            scores, m, far = fit.whitened(x), len(x), fit.deviation(x)
            wide = [d if d < 10 ** 38 else None for d in far]
            k = scores.shape[1]
            at = pa.array(np.arange(m + 1, dtype=np.int32) * k)

            def lists(values: np.ndarray, at: pa.Array = at) -> pa.Array:
                return pa.ListArray.from_arrays(at, pa.array(values.ravel(), from_pandas=True))  # NaN: null

            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.full(m, x.shape[1], np.int32)), pa.array(np.full(m, fit.n)),
                 pa.array([d if d < 1 << 63 else None for d in far], pa.int64()),
                 pa.array([None if d is None else str(d) for d in wide], pa.string()), lists(scores),
                 lists(np.tile(fit.explained, m)),
                 pa.array(np.full(m, errors[x.shape[1]]), from_pandas=True)],
                ["vec_id", "dims", "n", "deviation", "deviation_wide", "whitened", "explained",
                 "identity_error"])

    kind = table.schema["vec_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"vec_id {kind}, dims int, n long, deviation long, deviation_wide string, "
                           "whitened array<double>, explained array<double>, identity_error double").withColumn(
        "deviation_wide", F.col("deviation_wide").cast("decimal(38,0)"))


def by_component(rows: DataFrame) -> DataFrame:
    """A row for each score of ``whitened``'s result; ``component`` counts from 1."""
    kept = [c for c in rows.columns if c not in ("whitened", "explained")]
    return rows.select(*kept, F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "pair")).select(
        *kept, (F.col("at") + 1).alias("component"), "pair.whitened", "pair.explained")
