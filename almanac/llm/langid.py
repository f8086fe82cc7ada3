"""Language identification by interpolated Kneser-Ney character models.

Grams of up to four characters are packed into 64-bit keys, 16 bits a character. The models of all languages share one
sorted key array per order, with a row of log probabilities (a column per language) beside each key, so a text needs one
binary search per character while its grams are known, and goes to shorter grams only where they aren't.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.common import kept, sliced

ORDER = 4
#: Most documents per language that a model learns from, and the share of them kept back to calibrate.
SAMPLE, HELD_BACK = 250, 5
#: Groups of tasks whose first rows are found apart.
SALTS = 32
UNKNOWN = "und"
#: Letters from which the classes of length after the first begin; and the texts that the language's limit counts for in a class's.
CLASSES, FEW = (64, 256, 1024, 4096), 5


def letters() -> np.ndarray:
    """Whether each code point is a letter."""
    return kept("letters", None, lambda: np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))


def characters(text: str | None) -> np.ndarray:
    """Lower-case letters as 16-bit numbers; each run of other characters is one blank, with a blank at either end."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
    is_letter = letters()[codes]
    if not is_letter.any():
        return np.empty(0, np.uint64)
    folded = np.where(is_letter, np.where(codes < 0x10000, codes, 0xE000 + codes % 0x1900), 32).astype(np.uint64)
    keep = np.ones(len(folded), bool)
    keep[1:] = is_letter[1:] | is_letter[:-1]
    return np.concatenate([[32], folded[keep], [32]]).astype(np.uint64)


def grams(chars: np.ndarray, n: int = ORDER) -> np.ndarray:
    """Keys of the grams of n characters."""
    if len(chars) < n:
        return np.empty(0, np.uint64)
    keys = np.zeros(len(chars) - n + 1, np.uint64)
    for k in range(n):
        keys = (keys << np.uint64(16)) | chars[k : len(chars) - n + 1 + k]
    return keys


def _suffix(keys, n):
    return keys & np.uint64((1 << 16 * n) - 1)


def _class(n):
    return np.searchsorted(CLASSES, n, side="right")


@dataclass
class Level:
    """Grams of one order: sorted keys with log probabilities, sorted contexts with log weights of the shorter gram."""

    keys: np.ndarray
    logs: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray


@dataclass
class Models:
    langs: list[str]
    levels: list[Level] = field(default_factory=list)  # of order 1, 2, ...
    unseen: np.ndarray | None = None
    scale: float = 1.0
    #: Per language: usual cross-entropy in bits; and by class of length, how far a text's may lie above it.
    usual: np.ndarray | None = None
    slack: np.ndarray | None = None

    def logs(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """A row of log probabilities of the last character for each gram."""
        if order == 0:
            return np.broadcast_to(self.unseen, (len(keys), len(self.langs)))
        level = self.levels[order - 1]
        at = np.searchsorted(level.keys, keys)
        at[at == len(level.keys)] = 0
        out = level.logs[at]
        missing = np.flatnonzero(level.keys[at] != keys)
        if len(missing):
            context = keys[missing] >> np.uint64(16)
            c = np.searchsorted(level.contexts, context)
            c[c == len(level.contexts)] = 0
            weight = np.where((level.contexts[c] == context)[:, None], level.weights[c], 0)
            out[missing] = weight + self.logs(_suffix(keys[missing], order - 1), order - 1)
        return out

    def cross_entropy(self, chars: np.ndarray) -> np.ndarray:
        """Bits a character, per language; length-normalised."""
        keys, total = grams(chars), np.zeros(len(self.langs))
        if not len(keys):  # a text of one letter or two
            short = len(chars) - 1
            return -self.logs(grams(chars, short), short).sum(axis=0)
        for at in range(0, len(keys), 1 << 16):
            total += self.logs(keys[at : at + (1 << 16)]).sum(axis=0, dtype=np.float64)
        return -total / len(keys)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score in 0 to 1, and whether the calibrated test accepts the text as that language."""
        chars = characters(text)
        if not len(chars) or not self.langs:
            return UNKNOWN, 0.0, False
        bits = self.cross_entropy(chars)
        best = int(np.argmin(bits))
        odds = np.exp(-self.scale * (bits - bits[best]))
        n = max(1, len(chars) - 2)
        allowed = self.usual[best] + max(self.slack[best, _class(n)], 20 / np.sqrt(n))
        return self.langs[best], float(1 / odds.sum()), bool(bits[best] <= allowed)


def _discount(counts: np.ndarray) -> float:
    one, two = (counts == 1).sum(), (counts == 2).sum()
    return float(min(0.95, max(0.1, one / (one + 2 * two)))) if one else 0.5


def build(langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]]) -> Models:
    """Models from each language's sorted distinct keys of the longest grams and their counts.

    The longest order uses plain counts; a shorter gram counts the different characters before it (Kneser-Ney).
    """
    models = Models(langs)
    tables = [None] * ORDER
    tables[-1] = counts
    for n in range(ORDER - 1, 0, -1):
        tables[n - 1] = [np.unique(_suffix(keys, n), return_counts=True) for keys, _ in tables[n]]
    alphabet = max(2, len(np.unique(np.concatenate([k for k, _ in tables[0]]))) + 1)
    models.unseen = np.full(len(langs), -np.log2(alphabet))
    for n in range(1, ORDER + 1):
        union = np.unique(np.concatenate([k for k, _ in tables[n - 1]]))
        contexts = np.unique(union >> np.uint64(16))
        weights, mass = np.zeros((len(contexts), len(langs))), np.zeros((len(union), len(langs)))
        for j, (keys, c) in enumerate(tables[n - 1]):
            if not len(keys):
                continue
            cut = _discount(c)
            own, which = np.unique(keys >> np.uint64(16), return_inverse=True)
            total, kinds = np.bincount(which, c), np.bincount(which)
            weights[np.searchsorted(contexts, own), j] = np.log2(cut * kinds / total)
            mass[np.searchsorted(union, keys), j] = np.maximum(c - cut, 0) / total[which]
        lower = models.logs(_suffix(union, n - 1), n - 1)
        weight = weights[np.searchsorted(contexts, union >> np.uint64(16))]
        models.levels.append(Level(union, np.log2(mass + 2.0 ** (weight + lower)).astype(np.float32), contexts, weights.astype(np.float32)))
    return models


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE, usable=None) -> Models:
    """Models of every non-null value of lang_col.

    At most ``sample`` whole documents per language are used, those least by a hash of their id; one in HELD_BACK of
    them calibrates. usable: a condition that a row must meet to be learned from. Rows without a text or language don't count;
    rows that share a sampled id are all used. Without rows the models know no language.
    """
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (F.lit(True) if usable is None else usable))
    # The first of a language among the rows of some tasks, then among all: no task sees more than a part of the tasks' firsts.
    first = lambda df, *by: df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(F.xxhash64("id", F.lit("language")), "id"))).where(F.col("rank") <= sample)
    ids = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), (F.spark_partition_id() % SALTS).alias("salt"))
    chosen = first(first(ids, "lang", "salt"), "lang")
    chosen = chosen.select("id", "rank").distinct()
    texts = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    # The sample is bounded: ``sample`` ids a language.
    texts = texts.join(F.broadcast(chosen), "id").select("lang", (F.col("rank") % HELD_BACK == 0).alias("back"), "text")

    def count(batches):
        seen: dict[str, list[np.ndarray]] = {}
        for batch in sliced(batches):
            for lang, back, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if not back:
                    seen.setdefault(lang, []).append(grams(characters(text)))
        for lang, parts in seen.items():
            keys, n = np.unique(np.concatenate(parts), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "gram", "n"])

    counted = texts.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = sorted(counted.column("lang").unique().to_pylist())
    if not names:
        return Models([])
    lang, keys, n = (counted.column(k).to_numpy() for k in ("lang", "gram", "n"))
    tables = []
    for name in names:
        own, c = keys[lang == name].view(np.uint64), n[lang == name]
        order = np.argsort(own)
        tables.append((own[order], c[order]))
    models = build(names, tables)
    _calibrate(models, texts)
    return models


def _calibrate(models: Models, texts: DataFrame) -> None:
    """Set the scale of scores and the limits of acceptance from the held-back documents of the bounded sample."""
    shared = texts.sparkSession.sparkContext.broadcast(models)
    names = list(models.langs)

    def measure(batches):
        for batch in sliced(batches):
            out = []
            for lang, back, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if back and lang in names and len(chars := characters(text)):
                    out.append((names.index(lang), len(chars) - 2, shared.value.cross_entropy(chars).tolist()))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.list_(pa.float64()))], ["lang", "n", "bits"])

    rows = texts.mapInArrow(measure, "lang int, n bigint, bits array<double>").collect()
    k = len(names)
    own = np.array([r.bits[r.lang] for r in rows])
    lang, n = np.array([r.lang for r in rows], int), np.array([r.n for r in rows])
    models.usual, models.slack = np.full(k, np.median(own) if len(own) else 16.0), np.zeros((k, len(CLASSES) + 1))
    for j in range(k):
        if (lang == j).any():
            models.usual[j] = np.median(own[lang == j])
    # Twice what nine in ten held-back texts of the length needed, so that a few odd or mislabelled ones don't count. Few
    # texts of a length say little: what they need is drawn towards what the language's do, and that towards all texts'.
    over = own - models.usual[lang]
    needed = lambda some: max(0.0, 2 * np.quantile(some, 0.9, method="lower")) if len(some) else 0.0
    drawn = lambda some, towards: (len(some) * needed(some) + FEW * towards) / (len(some) + FEW)
    for j in range(k):
        usual = drawn(over[lang == j], needed(over))
        models.slack[j] = [drawn(over[(lang == j) & (_class(n) == c)], usual) for c in range(len(CLASSES) + 1)]
    models.usual += 1.5
    best = (-np.inf, 1.0)
    if len(rows):
        bits = np.array([r.bits for r in rows])
        for scale in (0.5, 1, 2, 4, 8, 16, 32):
            z = -scale * (bits - bits.min(axis=1, keepdims=True))
            fit = (z[np.arange(len(z)), lang] - np.log(np.exp(z).sum(axis=1))).mean()
            best = max(best, (fit, float(scale)))
    models.scale = best[1]


def identify(docs: DataFrame, models: Models, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang, score, accepted) per row of docs, over whole texts.

    A null text, one without a letter, or models of no language give ``und``, score 0, not accepted. Of equal scores the
    language first by code point wins. Rows stay as they are, repeated ones and null ids too; no rows give none, and other columns are
    not read. A very long text is scored whole, in parts of 65,536 grams.
    """
    shared = docs.sparkSession.sparkContext.broadcast(models)

    def run(batches):
        for batch in sliced(batches):
            found = [shared.value.predict(x) for x in batch.column(1).to_pylist()]
            lang, score, accepted = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())], ["id", "lang", "score", "accepted"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("t")).mapInArrow(run, "id bigint, lang string, score double, accepted boolean")


def accepted_only(docs: DataFrame, models: Models, text_col: str = "text") -> DataFrame:
    """The rows of docs whose text the models accept as one of their languages; all columns. Null texts, and those without a
    letter, go; no rows give none."""
    shared = docs.sparkSession.sparkContext.broadcast(models)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in sliced(batches):
            keep = [shared.value.predict(x)[2] for x in batch.column(at).to_pylist()]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
