"""Quality scores: histogram gradient-boosted trees over document statistics, flattened for numpy.

Statistics are ratios of bytes, words and lines of a whole text. The trees are fitted on binned values of a bounded
sample of labelled rows and kept as flat arrays, so a batch of documents goes down all trees together.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import sliced

#: Most labelled rows that a model learns from.
SAMPLE = 8000
TREES, DEPTH, RATE, BINS, LEAST, RIDGE = 60, 3, 0.15, 64, 10, 1.0
FEATURES = (
    "log_bytes log_words log_lines mean_word mean_line long_word digits capitals blanks high punctuation stops commas marks symbols "
    "pipes hashes brackets quotes distinct_words distinct_lines top_word repeated_pairs capital_words plain_words symbol_words ended_lines "
    "entropy short_words digit_words"
).split()
_sets = {
    "digits": b"0123456789", "stops": b".", "commas": b",;:", "marks": b"!?", "symbols": b"$%&*@^~+=_/\\", "pipes": b"|", "hashes": b"#", "brackets": b"()[]{}<>", "quotes": b"\"'`",
    "capitals": bytes(range(65, 91)), "blanks": b" \t\n\v\f\r", "high": bytes(range(128, 256)), "punctuation": bytes([*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]),
}
#: Which bytes count for which of these, so that one product gives all shares.
_belongs = np.stack([np.isin(np.arange(256), list(v)) for v in _sets.values()], axis=1).astype(float)
_high, _odd = bytes(range(128, 256)), frozenset(b"$%&*#@^~+=_|/\\<>!")


def statistics(text: str | None) -> list[float]:
    """The values named in FEATURES; all zero for a null or empty text."""
    data = (text or "").encode()
    if not data:
        return [0.0] * len(FEATURES)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    n, words, lines = len(data), data.split(), data.split(b"\n")
    m, share = max(1, len(words)), counts / n
    # What is asked of words is asked once of each different word.
    kinds = Counter(words)
    times = np.fromiter(kinds.values(), np.int64, len(kinds)) if words else np.zeros(1, np.int64)
    lengths = np.fromiter(map(len, kinds), np.int64, len(kinds)) if words else np.zeros(1, np.int64)
    pairs = len(set(zip(words, words[1:], strict=False)))
    upper = plain = odd = numeric = 0
    for w, c in kinds.items():
        if w.isupper():
            upper += c
        if w.isalpha():
            plain += c
            continue
        plain += c * (w.translate(None, _high).rstrip(b".,;:!?") or b"a").isalpha()
        odd += c * (w[-1] in _odd)
        numeric += c * w.isdigit()
    filled = [x for x in lines if x.strip()]
    entropy = -float((share[share > 0] * np.log2(share[share > 0])).sum())
    values = {
        "log_bytes": np.log1p(n), "log_words": np.log1p(len(words)), "log_lines": np.log1p(len(lines)), "mean_word": (lengths * times).sum() / m, "mean_line": np.log1p(n / len(lines)), "long_word": np.log1p(lengths.max()),
        "distinct_words": len(kinds) / m, "distinct_lines": len(set(filled)) / max(1, len(filled)), "top_word": int(times.max()) / m, "repeated_pairs": 1 - pairs / max(1, len(words) - 1),
        "capital_words": upper / m, "plain_words": plain / m, "symbol_words": odd / m, "ended_lines": sum(x.rstrip()[-1] in b".!?" for x in filled) / max(1, len(filled)),
        "entropy": entropy, "short_words": int(times[lengths <= 2].sum()) / m, "digit_words": numeric / m,
    }
    values |= zip(_sets, (share @ _belongs).tolist(), strict=True)
    return [float(values[k]) for k in FEATURES]


@dataclass
class Trees:
    """Complete binary trees of one depth: per tree and inner node a feature and a threshold, per leaf a value."""

    base: float
    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        rows, total = np.arange(len(x)), np.full(len(x), self.base)
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - (2**depth - 1)]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(x)))


def fit(x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Logistic boosting with second-order gains on quantile bins."""
    n, width = x.shape if len(x) else (0, len(FEATURES))
    inner, rate = 2**depth - 1, float(np.clip(y.mean(), 1e-3, 1 - 1e-3)) if n else 0.5
    base = float(np.log(rate / (1 - rate)))
    out = Trees(base, np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf), np.zeros((trees, 2**depth)))
    if n == 0 or y.min() == y.max():
        return Trees(base, out.feature[:0], out.threshold[:0], out.leaf[:0])
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(width)]
    bins = np.stack([np.searchsorted(edges[j], x[:, j]) for j in range(width)], axis=1)  # above an edge: right of it
    score = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess, node = p - y, p * (1 - p), np.zeros(n, np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.full(count, 1e-6)
            feature, cut = np.zeros(count, np.int64), np.full(count, BINS, np.int64)
            for j in range(width):
                key, size = (node - first) * BINS + bins[:, j], count * BINS
                g, h, c = (np.cumsum(np.bincount(key, w, size).reshape(count, BINS), axis=1) for w in (grad, hess, None))
                gr, hr, cr = g[:, -1:] - g, h[:, -1:] - h, c[:, -1:] - c
                gain = g**2 / (h + RIDGE) + gr**2 / (hr + RIDGE) - (g[:, -1:] ** 2) / (h[:, -1:] + RIDGE)
                gain[(c < LEAST) | (cr < LEAST)] = 0
                at = gain.argmax(axis=1)
                better = gain[np.arange(count), at] > best
                best[better], feature[better], cut[better] = gain[np.arange(count), at][better], j, at[better]
            out.feature[t, first : first + count] = feature
            out.threshold[t, first : first + count] = [edges[f][b] if b < len(edges[f]) else np.inf for f, b in zip(feature, cut, strict=True)]
            own = node - first
            node = 2 * node + 1 + (bins[np.arange(n), feature[own]] > cut[own])
        own = node - inner
        g, h = np.bincount(own, grad, 2**depth), np.bincount(own, hess, 2**depth)
        out.leaf[t] = -RATE * g / (h + RIDGE)
        score += out.leaf[t][own]
    return out


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE, usable=None) -> Trees:
    """Trees from at most ``sample`` labelled rows, those least by a hash of their id; usable: a condition on the label rows.

    Labels and ids that are null don't count; of several labels of an id the largest does, and of documents of one id each.
    Ties of gain go to the first feature and the lowest cut. Without labelled documents, or with labels of one kind, the
    score is the share of label 1 for every text (one half without any)."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & (F.lit(True) if usable is None else usable))
    rows = rows.groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("y"))
    chosen = rows.orderBy(F.xxhash64("id", F.lit("quality")), "id").limit(sample)
    # The sample is bounded: ``sample`` rows.
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(chosen), "id").select("id", "y", "t")

    def measure(batches):
        for batch in sliced(batches):
            values = [statistics(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.float64()), pa.array(values, pa.list_(pa.float64()))], ["id", "y", "x"])

    got = texts.mapInArrow(measure, "id bigint, y double, x array<double>").collect()
    got.sort(key=lambda r: (r.id, r.x))
    return fit(np.array([r.x for r in got]).reshape(len(got), len(FEATURES)), np.array([r.y for r in got]))


def scores(texts: list[str | None], trees: Trees) -> np.ndarray:
    """Scores of texts, in a worker."""
    return trees.score(np.array([statistics(t) for t in texts]).reshape(len(texts), len(FEATURES)))


def score(docs: DataFrame, trees: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) per row of docs, over whole texts; null counts as empty, and empty texts get a score like any other.

    Rows stay as they are, repeated ones and null ids too; no rows give none, and other columns are not read. A very long
    text is one row of a worker, with its words counted.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches):
        for batch in sliced(batches):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(batch.column(1).to_pylist(), shared.value), pa.float64())], ["id", "score"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t")).mapInArrow(run, "id bigint, score double")
