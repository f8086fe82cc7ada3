"""Quality rules as weak supervision: each rule votes for a text, against it, or abstains.

Rules are bands of plain statistics. A rule's votes differ in worth, so expectation-maximisation estimates from the votes
alone, without a label, how often each rule votes for a good text and how often against a bad one. The posterior probability
of a good text then replaces the demand that every rule be passed: one rule that fails by accident doesn't drop a text that
the others speak for.

Everything per text is DataFrame expressions. What reaches the driver is a count per pattern of votes, of which there are
no more than three to the power of the number of rules, whatever the number of texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import BLANKS, checkpointed
from almanac.llm.spans import indices, named, quoted

SYMBOLS = r"[#*$%&|<>]"
#: Low bits of a window's packed hash that hold its place; texts of more words go by the words themselves.
PLACE = 20
STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_stops", "n_odd", "n_capitals", "n_unlettered", "n_digits", "n_marks")
#: Below so many words, or with more than this share of words in repeated windows, a text fails whatever the rules say.
LEAST_WORDS, MOST_REPEATED = 50, 0.5
#: A rule: (value, bands that speak for a text, bands that speak against it), in SQL over STATS. Values outside both abstain.
RULES: dict[str, tuple[str, str, str]] = {
    "length": ("n_words", "v BETWEEN 50 AND 100000", "v < 20 OR v > 1000000"),
    "mean_word": ("word_chars / n_words", "v BETWEEN 3 AND 7", "v < 2.5 OR v > 10"),
    "symbols": ("n_symbols / n_words", "v <= 0.05", "v > 0.1"),
    "repeated_lines": ("n_dup_lines / n_lines", "v <= 0.1", "v > 0.3"),
    "repeated_words": ("n_repeat_words / n_words", "v <= 0.2", "v > 0.35"),
    "sentences": ("n_stops / n_words", "v BETWEEN 0.04 AND 0.34", "v < 0.03 OR v > 0.6"),
    "odd_characters": ("n_odd / word_chars", "v <= 0.08", "v > 0.12"),
    "unlettered_words": ("n_unlettered / n_words", "v <= 0.15", "v > 0.3"),
    "capitals": ("n_capitals / nullif(word_chars - n_odd, 0)", "v <= 0.15", "v > 0.3"),
    "digits": ("n_digits / word_chars", "v <= 0.08", "v > 0.2"),
    "marks": ("n_marks / n_words", "v <= 0.05", "v > 0.25"),
}
#: Where estimation starts: the share of good texts, how often a rule votes for a good one, and how often against a bad one.
#: A good text seldom breaks a rule, while a bad one breaks some and passes most.
SHARE, GOOD, BAD = 0.8, 0.98, 0.4
#: Votes that these accuracies count for as a prior, rounds at most, the change that ends them, and limits of an accuracy.
PRIOR_VOTES, ROUNDS, SETTLED, LIMITS = 10.0, 500, 1e-10, (0.005, 0.995)


def _count(pattern: str) -> str:
    return f"cast(regexp_count(_text, {quoted(pattern)}) AS bigint)"


def _covered(same: str, first: str, otherwise: str = "") -> str:
    """Words in windows that another one equals. es: windows in order; ``same`` of neighbours k and k + 1, ``first`` of k."""
    starts = f"flatten(transform(ps, k -> array({first.format('k')}, {first.format('k + 1')})))"
    words = f"size(array_distinct(flatten(transform(array_distinct({starts}), p -> array(p, p + 1, p + 2)))))"
    return named("ps", f"filter({indices('size(ws) - 3')}, k -> {same})", f"if(size(ps) = 0, 0, {otherwise}{words}{')' if otherwise else ''})")


def repeated_words(words: str, place: int = PLACE) -> str:
    """SQL: how many of an array's words stand in a window of three that is found twice or more.

    Windows are hashes with their places in the low bits, sorted as numbers. Should two different windows agree in the bits
    that are left of their hashes, or the places not fit, the windows are sorted by their words instead: exact either way.
    """
    low, at = (1 << place) - 1, indices("size(ws) - 2")
    packed = f"sort_array(transform({at}, i -> (xxhash64(get(ws, i), get(ws, i + 1), get(ws, i + 2)) & ~{low}L) | i))"
    whole = f"sort_array(transform({at}, i -> named_struct('a', get(ws, i), 'b', get(ws, i + 1), 'c', get(ws, i + 2), 'i', cast(i AS bigint))))"
    slow = named("es", whole, _covered(" AND ".join(f"get(es, k).{c} = get(es, k + 1).{c}" for c in "abc"), "get(es, {}).i"))
    word = lambda k, j: f"get(ws, cast((get(es, {k}) & {low}L) AS int) + {j})"
    differ = " OR ".join(f"{word('k', j)} <> {word('k + 1', j)}" for j in range(3))
    fast = _covered(f"shiftright(get(es, k) ^ get(es, k + 1), {place}) = 0", f"(get(es, {{}}) & {low}L)", f"if(exists(ps, k -> {differ}), {slow}, ")
    return named("ws", words, f"cast(CASE WHEN size(ws) < 4 THEN 0 WHEN size(ws) > {low} THEN {slow} ELSE {named('es', packed, fast)} END AS bigint)")


def with_statistics(df: DataFrame, text_col: str) -> DataFrame:
    """df with the columns named in STATS, all bigint, of the whole text; a null text has none of anything.

    Words are runs without blanks. A line counts if it has a word, and as repeated if an earlier line is equal.
    n_repeat_words counts words within any window of three that is found twice or more, its first place included; n_odd
    counts characters of words that are no letters. Work follows the length of the text, but for a sort of its windows.
    """
    word, own = f"[^{BLANKS}]", df.columns
    df = df.withColumn("_text", F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    df = df.withColumn("_words", F.expr(f"filter(split(_text, {quoted(f'[{BLANKS}]+')}), w -> w <> '')"))
    df = df.withColumn("_lines", F.expr(f"filter(split(_text, '\\n'), l -> l RLIKE {quoted(word)})"))
    values = {
        "n_words": "cast(size(_words) AS bigint)", "word_chars": "cast(length(array_join(_words, '')) AS bigint)", "n_symbols": _count(SYMBOLS),
        "n_dup_lines": "cast(size(_lines) - size(array_distinct(_lines)) AS bigint)", "n_repeat_words": repeated_words("_words"), "n_lines": "cast(size(_lines) AS bigint)",
        "n_stops": _count(rf"[.!?](?=[{BLANKS}]|\z)"), "n_odd": _count(rf"[^\p{{L}}{BLANKS}]"), "n_capitals": _count(r"\p{Lu}"),
        "n_unlettered": _count(rf"(?:\A|[{BLANKS}])[^{BLANKS}\p{{L}}]++(?!{word})"), "n_digits": _count("[0-9]"), "n_marks": _count("!"),
    }
    return df.select(*own, *(F.expr(values[s]).alias(s) for s in STATS))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the columns named in STATS) per row of docs."""
    return with_statistics(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_t")), "_t").drop("_t")


def votes() -> Column:
    """An array of 1, -1 or 0 for each rule, over the columns of STATS; a text without words has no votes."""
    each = []
    for value, good, bad in RULES.values():
        v = f"if(n_words > 0, {value}, NULL)"
        each.append(named("v", v, f"CASE WHEN {good} THEN 1 WHEN {bad} THEN -1 ELSE 0 END"))
    return F.expr(f"array({', '.join(each)})")


@dataclass
class Model:
    """share: of good texts; good and bad: per rule, how often its votes on good texts are for, on bad ones against."""

    share: float
    good: np.ndarray
    bad: np.ndarray

    def posterior(self, votes: str = "votes") -> Column:
        """Probability of a good text by its votes; abstentions say nothing, so without a vote it is the share."""
        odds = [repr(float(np.log(self.share / (1 - self.share))))]
        for r, (g, b) in enumerate(zip(self.good.tolist(), self.bad.tolist(), strict=True)):
            odds.append(f"CASE get({votes}, {r}) WHEN 1 THEN {float(np.log(g / (1 - b)))!r}D WHEN -1 THEN {float(np.log((1 - g) / b))!r}D ELSE 0D END")
        return F.expr(f"1 / (1 + exp(-({' + '.join(odds)})))")


def estimate(patterns: list[tuple[tuple[int, ...], int]]) -> Model:
    """Expectation-maximisation over (votes, count); no patterns give the start.

    A text's probability of being good comes from all votes by the rules' present accuracies; a rule's accuracies are then
    the shares of its votes that agree with these probabilities, PRIOR_VOTES of the start's included. A vote never speaks
    for the other side: a rule whose votes would do so says nothing in that round, so the classes can't change places.
    """
    v = np.array([p for p, _ in sorted(patterns)], float).reshape(-1, len(RULES))
    n = np.array([c for _, c in sorted(patterns)], float)
    plus, minus = (v > 0).astype(float), (v < 0).astype(float)
    share, good, bad = SHARE, np.full(len(RULES), GOOD), np.full(len(RULES), BAD)
    for _ in range(ROUNDS if len(n) else 0):
        odds = np.log(share / (1 - share)) + plus @ np.log(good / (1 - bad)) + minus @ np.log((1 - good) / bad)
        q = 1 / (1 + np.exp(-odds))
        new_share = float(np.clip((n * q).sum() / n.sum(), 0.01, 0.99))
        new_good = ((n * q) @ plus + PRIOR_VOTES * GOOD) / ((n * q) @ (plus + minus) + PRIOR_VOTES)
        new_bad = ((n * (1 - q)) @ minus + PRIOR_VOTES * BAD) / ((n * (1 - q)) @ (plus + minus) + PRIOR_VOTES)
        usual = (n @ plus + PRIOR_VOTES / 2) / (n @ (plus + minus) + PRIOR_VOTES)
        odd = new_good + new_bad < 1
        new_good, new_bad = np.clip(np.where(odd, usual, new_good), *LIMITS), np.clip(np.where(odd, 1 - usual, new_bad), *LIMITS)
        moved = max(abs(new_share - share), np.abs(new_good - good).max(), np.abs(new_bad - bad).max())
        share, good, bad = new_share, new_good, new_bad
        if moved < SETTLED:
            break
    return Model(share, good, bad)


def train(voted: DataFrame) -> Model:
    """The model of all rows' votes: one aggregation with partial counts, a row per pattern."""
    return estimate([(tuple(r.votes), r["count"]) for r in voted.groupBy("votes").count().collect()])


def judge(docs: DataFrame, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, STATS, votes, base_failed, posterior, kept) per row of docs, whose own votes are what the accuracies are learned from.

    kept: not base_failed, and a posterior of ``least`` or more. A null or empty text has no words and fails. Repeated rows
    count as often as they stand; no rows give none. Other columns are not read. Each text is read once: statistics are
    checkpointed, a few numbers a row.
    """
    voted = checkpointed(statistics(docs, id_col, text_col).withColumn("votes", votes()))
    rows = voted.withColumn("base_failed", failed()).withColumn("posterior", train(voted).posterior())
    return rows.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= least))


def failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > int(100 * MOST_REPEATED) * F.col("n_words"))


def kept_documents(docs: DataFrame, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows of docs that ``judge`` keeps, all columns, whatever their names.

    The votes are learned in one pass and the rows filtered in another; no text is shuffled or written. Null and empty
    texts go; repeated rows stay repeated; no rows give none.
    """
    own = {c: f"_own_{k}" for k, c in enumerate(docs.columns)}
    rows = with_statistics(docs.withColumnsRenamed(own), own[text_col]).withColumn("_votes", votes())
    rows = rows.withColumn("_posterior", train(rows.select(F.col("_votes").alias("votes"))).posterior("_votes"))
    return rows.where(~failed() & (F.col("_posterior") >= least)).select(*(F.col(new).alias(c) for c, new in own.items()))
