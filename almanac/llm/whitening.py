"""Embedding whitening from variances alone: the covariance by polarisation.

A covariance of two dimensions is half the variance of their sum less half of either's own. So no products of two dimensions
are summed, only squares: of each dimension, and of the sum of each pair. Values are whole numbers, they are centred before
they are squared, and the sums are exact, so the differences of variances lose nothing; only the finished covariance is
rounded to doubles, and its eigenvectors whiten.

Centring by a mean that is no whole number would not be exact. Values are centred at the whole number next below the mean
instead, and what remains between the two is taken off the sums of squares, exactly: for u = x - m with sum r over n rows,
the sum of (n x - S)^2 is n^2 times that of u^2 less n r^2.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.topk import usable

SCALE, SHIFT = 64, 1_000_000
#: Components a row gets at most; eigenvalues below this share of the largest are rounding and whiten nothing.
MOST, NOTHING = 32, 1e-13
#: Bits of a limb of an exact sum; vectors of more different lengths than LENGTHS are no embeddings of anything.
LIMB, LENGTHS = 32, 1000
#: Whole numbers whose sums and products stay below this are exact in 64 bits.
EXACT = 1 << 62
SUMS = "dim int, a int, b int, limb int, value bigint"


def whole_vectors(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x): floor(64 c) + 1000000 of each entry c of the vectors that have entries, all finite, and none too large for a long."""
    x = F.transform(F.col("v"), lambda c: F.floor(c.cast("double") * SCALE))
    fits = F.forall("v", lambda c: F.abs(c.cast("double")) < float(1 << 55))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).where(usable(F.col("v")) & (F.size("v") > 0) & fits)
    return rows.select("id", F.transform(x, lambda c: c.cast("bigint") + SHIFT).alias("x"))


def _by_length(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, rows, their matrix) for each length of the arrays in a column."""
    arrays = batch.column(column)
    sizes = np.diff(arrays.offsets.to_numpy())
    for dim in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == dim)
        some = arrays if len(rows) == len(arrays) else arrays.take(pa.array(rows))
        yield dim, rows, some.flatten().to_numpy(zero_copy_only=False).reshape(len(rows), dim)


def exact_sum(x: np.ndarray) -> np.ndarray:
    """Sums of columns of whole numbers, as Python's own where 64 bits might not do."""
    return x.sum(axis=0).astype(object) if not x.size or int(np.abs(x).max()) * len(x) < EXACT else x.astype(object).sum(axis=0)


def exact_squares(x: np.ndarray) -> np.ndarray:
    """Sums of the squares of columns of whole numbers."""
    if not x.size or int(np.abs(x).max()) ** 2 * len(x) < EXACT:
        return np.einsum("ij,ij->j", x, x).astype(object)
    x = x.astype(object)
    return (x * x).sum(axis=0)


def _limbs(dim: int, sums: dict[tuple[int, int], int]) -> Iterator[tuple[int, int, int, int, int]]:
    """Exact sums of any size in limbs of LIMB bits that Spark can add up; zero limbs are left out."""
    for (a, b), value in sums.items():
        sign, rest, limb = (-1 if value < 0 else 1), abs(value), 0
        while rest:
            if part := rest & ((1 << LIMB) - 1):
                yield dim, a, b, limb, sign * part
            rest, limb = rest >> LIMB, limb + 1


def _summed(rows: DataFrame, sums_of) -> DataFrame:
    """Sums (dim, a, b, limb, value) over all rows of what sums_of(dim, matrix) adds up, an array each of names and values.

    A task adds up its own rows, so what is shuffled is a few numbers a task, whatever its rows."""

    def run(batches):
        own: dict[int, dict] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch, 0):
                for at in range(0, len(x), 4096):
                    for key, values in sums_of(dim, x[at : at + 4096]):
                        held = own.setdefault(dim, {})
                        held[key] = held[key] + values if key in held else values
        for dim, held in own.items():
            found = list(_limbs(dim, {(a, b + k): int(v) for (a, b), values in held.items() for k, v in enumerate(values)}))
            for at in range(0, len(found), 65536):
                columns = zip(*found[at : at + 65536], strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], ["dim", "a", "b", "limb", "value"])

    return rows.select("x").mapInArrow(run, SUMS).groupBy("dim", "a", "b", "limb").agg(F.sum("value").alias("value"))


def totals(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per length: number of rows and exact sums by dimension. The driver gets as many numbers as the vectors have entries."""
    summed = _summed(rows, lambda dim, x: [((-1, 0), np.array([len(x)], object)), ((0, 0), exact_sum(x))])
    if (n := summed.select("dim").distinct().count()) > LENGTHS:
        raise ValueError(f"vectors of {n} different lengths are no embeddings of one kind")
    found: dict[int, tuple[int, list[int]]] = {}
    for r in summed.collect():
        n, sums = found.get(r.dim, (0, [0] * r.dim))
        part = r.value << (LIMB * r.limb)
        if r.a < 0:
            n += part
        else:
            sums[r.b] += part
        found[r.dim] = n, sums
    return found


@dataclass
class Whitening:
    """Of vectors of one length: n of them, sums by dimension, eigenvalues falling, their unit vectors as columns, the trace."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    def centre(self) -> np.ndarray:
        return np.array([s // self.n for s in self.sums], np.int64)

    def rest(self) -> list[int]:
        return [s - self.n * (s // self.n) for s in self.sums]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows of whole vectors to components; NaN where the eigenvalue is none. x - S/n is rounded once."""
        centred = (x - self.centre()) - np.array([r / self.n for r in self.rest()])
        scale = np.where(self.values > 0, np.sqrt(np.maximum(self.values, 0)), np.nan)
        return centred @ self.vectors / scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n x - S)^2, exact; None where that is too large for a long."""
        u, n, r = x - self.centre(), self.n, self.rest()
        if (n * int(np.abs(u).max(initial=0)) + n) ** 2 * x.shape[1] < EXACT:
            return exact_squares((n * u - np.array(r, np.int64)).T).tolist()
        found = exact_squares((n * u.astype(object) - np.array(r, object)).T.astype(object)) if u.size else []
        return [v if v < 1 << 63 else None for v in found]


def _pair_squares(models: dict[int, tuple[int, list[int]]]):
    """Exact sums of squares of each dimension (key (d, d)) and of the sum of each pair (key (a, b), a < b)."""
    centres = {dim: np.array([s // n for s in sums], np.int64) for dim, (n, sums) in models.items()}

    def squares(dim: int, x: np.ndarray):
        u = x - centres[dim]
        yield (0, 0), exact_squares(u)
        for a in range(dim - 1):
            yield (a + 1, a + 1), exact_squares(u[:, a : a + 1] + u[:, a + 1 :])

    return squares


def covariance(n: int, sums: list[int], own: list[int], pair: dict[tuple[int, int], int]) -> np.ndarray:
    """Covariance, divisor n, from the exact squares of dimensions and of sums of pairs, each centred at whole numbers.

    Variances times n^3 are whole; half the difference of the pair's and its members' is the covariance times n^3, and one
    division rounds it."""
    rest = [s - n * (s // n) for s in sums]
    single = [n * n * q - n * r * r for q, r in zip(own, rest, strict=True)]
    out = np.zeros((len(sums), len(sums)))
    for d, v in enumerate(single):
        out[d, d] = v / n**3
    for (a, b), q in pair.items():
        both = n * n * q - n * (rest[a] + rest[b]) ** 2
        out[a, b] = out[b, a] = (both - single[a] - single[b]) / (2 * n**3)
    return out


def fit(rows: DataFrame, most: int = MOST) -> dict[int, Whitening]:
    """The whitening of each length of vectors. Lengths are few (LENGTHS at most, else an error); those of one embedding are one.

    Two passes over the rows: exact sums, then exact squares of every dimension and pair sum, added up by the tasks. The
    squares of one length, of which there are as many as pairs of dimensions, meet in one task, which solves for the
    eigenvectors; the driver gets those of the components asked for. Eigenvectors point so that their largest entry is
    positive.
    """
    found = totals(rows)
    if not found:
        return {}
    shared = rows.sparkSession.sparkContext.broadcast(found)
    squares = _pair_squares(found)

    def solved(pdf):
        import pandas as pd

        dim = int(pdf["dim"].iloc[0])
        n, sums = shared.value[dim]
        own, pair = [0] * dim, {(a, b): 0 for a in range(dim) for b in range(a + 1, dim)}
        for a, b, limb, value in zip(pdf["a"], pdf["b"], pdf["limb"], pdf["value"], strict=True):
            part = int(value) << (LIMB * int(limb))
            if a == 0:
                own[b] += part
            else:
                pair[a - 1, b] += part
        v = covariance(n, sums, own, pair)
        values, vectors = np.linalg.eigh(v)
        order = np.argsort(values, kind="stable")[::-1][:most]
        values, vectors = values[order], vectors[:, order]
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))])
        values = np.where(values > NOTHING * max(values[0], 0), values, 0.0)
        return pd.DataFrame([(dim, values.tolist(), vectors.ravel().tolist(), float(np.trace(v)))], columns=["dim", "e", "v", "trace"])

    # A row for every length even where all squares are zero, which have no limbs.
    every = rows.sparkSession.createDataFrame([(d, 0, 0, 0, 0) for d in found], SUMS)
    rows = _summed(rows, squares).unionByName(every).groupBy("dim").applyInPandas(solved, "dim int, e array<double>, v array<double>, trace double")
    return {r.dim: Whitening(*found[r.dim], np.array(r.e), np.array(r.v).reshape(r.dim, len(r.e)), r.trace) for r in rows.collect()}


def identity_errors(rows: DataFrame, fits: dict[int, Whitening]) -> dict[int, float]:
    """Per length the largest entry, in size, of the covariance of its whitened vectors less the identity.

    One more pass: tasks add up the products of centred components, a matrix a task. Components without an eigenvalue have
    no part in it; a length that has no others has error zero."""
    shared = rows.sparkSession.sparkContext.broadcast(fits)

    def run(batches):
        grams: dict[int, np.ndarray] = {}
        for batch in batches:
            for dim, _, x in _by_length(batch, 0):
                w = np.nan_to_num(shared.value[dim].whitened(x))
                grams[dim] = grams.get(dim, 0) + w.T @ w
        for dim, g in grams.items():
            yield pa.RecordBatch.from_arrays([pa.array([dim] * g.size, pa.int32()), pa.array(range(g.size), pa.int32()), pa.array(g.ravel())], ["dim", "at", "g"])

    summed = rows.select("x").mapInArrow(run, "dim int, at int, g double").groupBy("dim", "at").agg(F.sum("g").alias("g"))
    out = dict.fromkeys(fits, 0.0)
    for r in summed.collect():
        k, e = len(fits[r.dim].values), fits[r.dim].values
        i, j = divmod(r.at, k)
        if e[i] > 0 and e[j] > 0:
            out[r.dim] = max(out[r.dim], abs(r.g / fits[r.dim].n - (i == j)))
    return out


def whiten(vectors: DataFrame, most: int = MOST, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, dim, n, deviation, whitened, explained, identity_error) per row of vectors: arrays of ``most`` components at most.

    Rows whose vector is null, empty, or holds a null, a value that is not finite, or one of 2**55 and more, are left out
    and not fitted on. The id is not looked at: it may be null or repeat, and a repeated row counts as often as it stands.
    Each length of vectors is a space of its own, fitted on its own rows. A component whose eigenvalue is zero (less rows
    than components, constant dimensions) has a null value and explains 0. deviation is null where a long can't hold it.
    No rows give none; other columns are not read. Each pass reads the vectors' column only; nothing of a row is shuffled.
    """
    rows = whole_vectors(vectors, id_col, vec_col)
    fits = fit(rows, most)
    errors = identity_errors(rows, fits) if fits else {}
    shared = vectors.sparkSession.sparkContext.broadcast((fits, errors))

    def run(batches):
        for batch in batches:
            for dim, at, x in _by_length(batch, 1):
                f, error = shared.value[0][dim], shared.value[1][dim]
                for k in range(0, len(x), 4096):
                    some, n = x[k : k + 4096], len(x[k : k + 4096])
                    w, share = f.whitened(some), f.values / f.trace if f.trace > 0 else f.values
                    flat = pa.array(w.ravel(), from_pandas=True)
                    arrays = [pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * w.shape[1], pa.int32()), v) for v in (flat, pa.array(np.tile(share, n)))]
                    each = [batch.column(0).take(pa.array(at[k : k + 4096])), pa.array([dim] * n, pa.int32()), pa.array([f.n] * n, pa.int64()), pa.array(f.deviations(some), pa.int64()), *arrays, pa.array([error] * n)]
                    yield pa.RecordBatch.from_arrays(each, ["id", "dim", "n", "deviation", "whitened", "explained", "identity_error"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, dim int, n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double")


def components(whitened: DataFrame) -> DataFrame:
    """A row per component of each row of ``whiten``, numbered from 1 by falling eigenvalue."""
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("k", "c")
    rows = whitened.select("id", "n", "deviation", "identity_error", each)
    return rows.select("id", (F.col("k") + 1).alias("component"), "n", "deviation", F.col("c.whitened").alias("whitened"), F.col("c.explained").alias("explained"), "identity_error")
