"""One-permutation MinHash fingerprints in Spark expressions.

Each five-word shingle is hashed once. The top eight bits of the hash choose one of 256 bins, which keeps its least hash.
An empty bin is filled by optimal densification: it takes the value of the first full bin in a random order of its own,
the same for all texts. A fingerprint stores four bits of each bin, of its value hashed once more with the bin, so that a
value that fills several bins agrees by chance in each of them independently. Unlike bins agree in one case of sixteen,
and ``likeness`` takes that out.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almanac.llm.common import words_of

SHINGLE, BINS, BITS = 5, 256, 4
#: Bits of a hash below those that choose its bin.
_REST = 64 - (BINS - 1).bit_length()
_LOW = (1 << _REST) - 1
#: Rows a bucket of neighbouring ids aims at, and the most buckets.
ROWS, BUCKETS = 1000, 100_000


def _bin(h: Column) -> Column:
    return F.shiftrightunsigned(h, _REST)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


#: In each bin the value beyond all others, which stands for an empty bin. In signed order the upper half of the bins comes first.
EMPTY = sorted(_signed((k << _REST) | _LOW) for k in range(BINS))


def probes(n: int = 16, seed: int = 11) -> list[list[int]]:
    """For each place of a bin the places to take a value from when it is empty, in order."""
    rng = random.Random(seed)
    return [[rng.randrange(BINS) for _ in range(n)] for _ in range(BINS)]


def with_fingerprint(df: DataFrame, text: str, out: str) -> DataFrame:
    """df with a fingerprint of the whole text column, as 256 hexadecimal digits. Texts of fewer than five words count as
    one shingle; null and empty texts are the empty shingle.

    Each bin's own end value is sorted in with the hashes, so the first value of every bin stands in its place. An empty
    bin tries its probes in turn; should all be empty, it takes the full bin that comes first by a hash of both.
    """
    keep = [c for c in df.columns if c != out]
    shingle = lambda i: F.xxhash64(*(F.get("_w", i + k) for k in range(SHINGLE)))  # noqa: E731  missing words are skipped
    df = df.select(*keep, words_of(F.col(text)).alias("_w"))
    hashes = F.transform(F.sequence(F.lit(0), F.greatest(F.size("_w") - SHINGLE, F.lit(0))), shingle)
    df = df.select(*keep, F.sort_array(F.concat(hashes, F.lit(EMPTY))).alias("_h"))
    df = df.select(*keep, F.filter("_h", lambda h, i: (i == 0) | (_bin(h) != _bin(F.get("_h", i - 1)))).alias("_m"))
    df = df.select(*keep, F.transform("_m", lambda h: F.when(h.bitwiseAND(F.lit(_LOW)) != _LOW, h)).alias("_m"))
    df = df.select(*keep, "_m", F.array_compact("_m").alias("_full"))
    table, n = F.lit(probes()), len(probes()[0])
    last = lambda i: F.array_min(F.transform("_full", lambda m: F.struct(F.xxhash64(i, _bin(m)).alias("order"), m.alias("h"))))["h"]
    value = lambda h, i: F.coalesce(h, *(F.get("_m", F.get(F.get(table, i), F.lit(t))) for t in range(n)), last(i))
    bits = lambda h, i: F.hex(F.xxhash64(value(h, i), i).bitwiseAND(F.lit(2**BITS - 1)))
    return df.select(*keep, F.lower(F.array_join(F.transform("_m", bits), "")).alias(out))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of common shingles of two fingerprints, 0 to 1, without the agreement that chance gives."""
    same = F.size(F.filter(F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: x == y), lambda x: x)) / F.lit(float(BINS))
    chance = 1.0 / 2**BITS
    return F.greatest(F.lit(0.0), (same - chance) / (1 - chance))


def _bucket(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts lie at or below key, by a coarse and then a fine step; null keys are in the first."""
    if not cuts:
        return F.lit(0)
    wide = max(1, int(len(cuts) ** 0.5))
    groups = [cuts[k : k + wide] for k in range(0, len(cuts), wide)]
    fine = F.lit(groups)
    at = F.size(F.filter(F.lit([g[0] for g in groups]), lambda c: c <= key))
    return F.when(at == 0, 0).otherwise((at - 1) * wide + F.size(F.filter(F.get(fine, at - 1), lambda c: c <= key)))


def with_next(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, text, next, real) in buckets of neighbouring ids: each row and the text of the next one by ascending id.

    Ids are cut into buckets of even size at actual ids; the first rows of a bucket are also put behind the last of the
    bucket before (real is false for these), and the very first behind the very last. So no order over all rows is made.
    Null ids come first; rows of one id follow their text. Returns the rows and the window in which they stand.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    n, least, nulls = rows.agg(F.count("*"), F.min("id"), F.count_if(F.col("id").isNull())).first()
    buckets = min(BUCKETS, -(-n // ROWS))
    cuts: list[int] = []
    if buckets > 1 and least is not None:
        shares = [k / buckets for k in range(1, buckets)]
        found = rows.agg(F.percentile_approx("id", shares, max(10_000, 10 * buckets)).alias("c")).first().c
        cuts = sorted({c for c in found if c > least})
    own = _bucket(F.col("id"), cuts)
    first = F.col("id").isNull() if nulls else F.col("id") == F.lit(least)
    behind = F.when(F.get(F.lit(cuts or [0]), own - 1) == F.col("id"), F.struct((own - 1).alias("bucket"), F.lit(1).alias("copy"))) if cuts else F.lit(None)
    places = [F.struct(own.alias("bucket"), F.lit(0).alias("copy")), F.when(first, F.struct(F.lit(len(cuts)).alias("bucket"), F.lit(2).alias("copy"))), *([behind] if cuts else [])]
    rows = rows.withColumn("place", F.explode(F.array_compact(F.array(*places)))).select("id", "text", "place.bucket", "place.copy")
    return rows, Window.partitionBy("bucket").orderBy("copy", F.asc_nulls_first("id"), "text")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, edited, fingerprint, edited_fingerprint, next_fingerprint) per row of docs.

    edited is the text with its last quarter (rounded down, in code points) replaced by the first as many code points, or
    all, of the next document by ascending id; the first document follows the last. A sole document follows itself. Null
    texts count as empty; rows of a null id come first; repeated rows follow each other, in the order of their texts. No rows
    give none. Other columns are not read. A text is taken whole, however long: a task holds its words and a hash of each.
    """
    rows, order = with_next(docs, id_col, text_col)
    quarter = F.floor(F.length("text") / 4).cast("int")
    rows = rows.withColumn("next", F.lead("text").over(order)).withColumn("edited", F.concat(F.substring("text", F.lit(1), F.length("text") - quarter), F.substring(F.coalesce("next", F.lit("")), F.lit(1), quarter))).drop("next")
    rows = with_fingerprint(rows, "text", "fingerprint").withColumn("next_fingerprint", F.lead("fingerprint").over(order))
    rows = with_fingerprint(rows.where("copy = 0"), "edited", "edited_fingerprint")
    return rows.select("id", "text", "edited", "fingerprint", "edited_fingerprint", "next_fingerprint")
