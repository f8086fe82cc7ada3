"""Characteristics-based factor model from one pass over the panel.

Both steps of alternating least squares need only the cross products Z'Z, Z'r and r'r of each month. Spark sums them in
one aggregation; the fit then runs on that table, whose size is months times characteristics squared and never follows the
number of entities.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.operators.peers import rank_shares
from almanac.work import checkpointed


def panel(characteristics: DataFrame, returns: DataFrame, key: list[str], cols: list[str]) -> DataFrame:
    """Complete rows of both sides by key (entity, month), each characteristic ranked within its month to [-1/2, 1/2]."""
    return ranked(characteristics.join(returns, key), key[1], cols)


def ranked(df: DataFrame, month: str, cols: list[str]) -> DataFrame:
    """The panel of rows that hold returns and characteristics side by side. They are kept, as the ranks take more than one
    pass over them."""
    return rank_shares(checkpointed(df.dropna()), [month], cols)


def month_sums(df: DataFrame, month: str, cols: list[str], r: str, *by: str) -> DataFrame:
    """Cross products per month, and per universe if columns of one are named."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    return df.groupBy(*by, month).agg(F.count("*").alias("n"), F.array(*(F.sum(F.col(a) * F.col(b)) for a, b in pairs)).alias("g"), F.array(*(F.sum(F.col(a) * F.col(r)) for a in cols)).alias("c"), F.sum(F.col(r) * F.col(r)).alias("s"))


@dataclass
class Grams:
    months: list
    g: np.ndarray
    c: np.ndarray
    s: np.ndarray

    @classmethod
    def of(cls, sums: DataFrame, month: str, width: int) -> Grams:
        return cls.from_rows(sums.orderBy(month).collect(), month, width)

    @classmethod
    def from_rows(cls, rows: list, month: str, width: int) -> Grams:
        g = np.zeros((len(rows), width, width))
        upper = np.triu_indices(width)
        for k, row in enumerate(rows):
            g[k][upper] = row.g
            g[k] += np.triu(g[k], 1).T
        return cls([row[month] for row in rows], g, np.array([row.c for row in rows]), np.array([row.s for row in rows]))

    def part(self, at: slice) -> Grams:
        return Grams(self.months[at], self.g[at], self.c[at], self.s[at])

    def factors(self, loading: np.ndarray) -> np.ndarray:
        return np.stack([np.linalg.pinv(loading.T @ g @ loading) @ loading.T @ c for g, c in zip(self.g, self.c, strict=True)])

    def r2(self, loading: np.ndarray, factors: np.ndarray) -> float:
        b = factors @ loading.T
        left = self.s - 2 * np.einsum("tl,tl->t", b, self.c) + np.einsum("tl,tlm,tm->t", b, self.g, b)
        return float(1 - left.sum() / self.s.sum())


def fit(grams: Grams, k: int, rounds: int = 200, tolerance: float = 1e-8) -> tuple[np.ndarray, np.ndarray]:
    """Loading (orthonormal columns, ordered by factor variance, mean factors positive) and factors per month."""
    width = grams.g.shape[1]
    values, vectors = np.linalg.eigh(grams.g.sum(axis=0))
    loading = vectors[:, np.argsort(values)[::-1][:k]]
    for _ in range(rounds):
        f = grams.factors(loading)
        a = np.einsum("tlm,tj,tk->ljmk", grams.g, f, f).reshape(width * k, width * k)
        b = np.einsum("tl,tk->lk", grams.c, f).reshape(-1)
        new = (np.linalg.pinv(a) @ b).reshape(width, k)
        q, _ = np.linalg.qr(new)
        moved = np.linalg.norm(q @ q.T - loading @ loading.T)
        loading = q
        if moved < tolerance:
            break
    f = grams.factors(loading)
    values, turn = np.linalg.eigh(f.T @ f)
    loading = loading @ turn[:, np.argsort(values)[::-1]]
    f = grams.factors(loading)
    sign = np.where(f.mean(axis=0) < 0, -1.0, 1.0)
    return loading * sign, f * sign


def walk_forward(grams: Grams, k: int, train: int = 24, test: int = 12) -> float:
    """Out-of-sample r-square of expanding fits: each test month's prediction uses the mean factor of the training months."""
    left = total = 0.0
    for end in range(train, len(grams.months), test):
        loading, f = fit(grams.part(slice(0, end)), k)
        later = grams.part(slice(end, end + test))
        b = np.tile(loading @ f.mean(axis=0), (len(later.months), 1))
        left += (later.s - 2 * np.einsum("tl,tl->t", b, later.c) + np.einsum("tl,tlm,tm->t", b, later.g, b)).sum()
        total += later.s.sum()
    return float(1 - left / total) if total else float("nan")


def choose(grams: Grams, most: int, slack: float = 0.005) -> tuple[int, bool, dict[int, float]]:
    """The fewest factors within ``slack`` of the best out-of-sample r-square, whether that is below zero, and all scores."""
    scores = {k: walk_forward(grams, k) for k in range(1, most + 1)}
    best = max(scores.values())
    k = min(k for k, v in scores.items() if v >= best - slack)
    return k, best <= 0, scores


def drift(new: np.ndarray, old: np.ndarray) -> float:
    """Relative distance of two loadings of one shape after the best rotation of one onto the other; one if the new is zero."""
    if new.shape != old.shape or not new.size:
        raise ValueError(f"loadings of shapes {old.shape} and {new.shape} can't be compared")
    size = np.linalg.norm(old)
    if size < 1e-12:
        raise ValueError("the old loading is zero")
    u, _, v = np.linalg.svd(old.T @ new)
    return float(np.linalg.norm(new - old @ (u @ v)) / size)


def fit_history(sums: DataFrame, universe: str, month: str, width: int, k: int, least: int = 24, step: int = 12) -> DataFrame:
    """(universe, fit_date, width, k, loading): expanding fits of each universe, the newest over all its months and those
    before each by ``step`` months less, while there are ``least``. A group is a universe's months, whatever its entities."""

    def run(pdf):
        import pandas as pd

        rows = pdf.sort_values(month).to_dict("records")
        grams = Grams.from_rows([_Row(r) for r in rows], month, width)
        ends = range(len(rows), least - 1, -step)
        return pd.DataFrame([(rows[0][universe], rows[end - 1][month], width, k, fit(grams.part(slice(0, end)), k)[0].ravel().tolist()) for end in ends], columns=[universe, "fit_date", "width", "k", "loading"])

    return sums.groupBy(universe).applyInPandas(run, f"{universe} string, fit_date date, width int, k int, loading array<double>")


class _Row(dict):
    __getattr__ = dict.__getitem__


def newest_drift(fits: DataFrame, universe: str, alert: float) -> DataFrame:
    """(universe, fit_date, drift, alert): the two newest fits of each universe; none where there is only one."""
    newest = fits.withColumn("rank", F.row_number().over(Window.partitionBy(universe).orderBy(F.desc("fit_date")))).where("rank <= 2")

    def run(pdf):
        import pandas as pd

        pdf = pdf.sort_values("rank")
        one = lambda r: np.array(r.loading).reshape(r.width, r.k)
        found = [(pdf[universe].iloc[0], pdf.fit_date.iloc[0], drift(*(one(r) for r in pdf.itertuples())))] if len(pdf) == 2 else []
        return pd.DataFrame([(*f, f[2] > alert) for f in found], columns=[universe, "fit_date", "drift", "alert"])

    return newest.groupBy(universe).applyInPandas(run, f"{universe} string, fit_date date, drift double, alert boolean")
