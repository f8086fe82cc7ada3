r"""Personal data by candidate boosting, in Spark expressions.

Generators of high recall propose spans, which may overlap. Each gets features of its format and of the characters around
it, in a few levels each. What the trees learn is evidence that no feature shows: for kinds with a checksum or a range,
whether it holds; for the others, whether the words before name the kind ("token =", "call", "ssn"). So context judges
formats: a format that usually stands behind such words is taken without them too, and one that never does is not.

Words that name a kind may be missing before true ones, so evidence is a part of the truth. A score divided by the mean
score of the held-back candidates with evidence estimates the share of true ones (learning from positive and unlabelled
rows); each kind's threshold is where that passes one half. A kind that hardly ever has evidence falls back: see ``train``.
Spans of the four base kinds that pass their own check always stay; the trees add spans of the other generators, of which
overlapping ones are resolved by score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.common import checkpointed, written
from almanac.llm.spans import SPANS, cut, indices, named, pages, quoted, running, spans

#: Base kinds in the order in which ties of start are listed, then those the method adds.
BASE = ("email", "ip", "card", "phone")
ADDED = ("written_email", "local_phone", "ssn", "iban", "secret", "ipv6")
KINDS = BASE + ADDED
# The base patterns match what their plain forms match, without starting anew inside a run: a match begins where a run
# begins or where the match before ended. Runs with too few or too many digits for a card are left out at once.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){11,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "written_email": r"(?i)[a-z0-9._%+-]{2,40}+ ?[\[(] ?at ?[\])] ?[a-z0-9-]{2,40}+(?: ?[\[(] ?dot ?[\])] ?|\.)[a-z]{2,10}+",
    "local_phone": r"\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}[0-9]*+",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}[0-9-]*+",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?[A-Za-z0-9]*+",
    "secret": r"(?<![A-Za-z0-9_/+-])(?=[A-Za-z_/+-]*+[0-9])[A-Za-z0-9_/+-]{12,}+",
    "ipv6": r"(?i)(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}[0-9a-f:]*+",
}
#: A cheap sign that a text may hold a kind.
SIGNS = {"email": ("@",), "phone": ("+",), "ssn": ("-",), "ip": (".",), "ipv6": (":",)}
_octet = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?"  # zeros alone count as zero
#: What names a kind that has no checksum, right before a span of it.
CUES = {
    "written_email": r"(?i)(?:mail|contact|write|reach|address)[^.!?]{0,20}$",
    "local_phone": r"(?i)(?:phone|tel|call|fax|mobile|dial|text)[a-z.:]{0,8}[^.!?]{0,12}$|\+[0-9]{1,3} ?$",
    "ssn": r"(?i)(?:ssn|social|security|taxpayer|insurance)[^.!?]{0,20}$",
    "secret": r"(?i)(?:key|secret|token|passw(?:or)?d|pwd|credential|auth|bearer)[\"' ]{0,2}[=: ][\"' ]{0,2}$",
    "ipv6": r"(?i)(?:ip|host|server|address|client|ping)[^.!?]{0,16}$",
}
TREES, RATE = 24, 0.3
#: Held-back candidates with evidence that a threshold asks for, and the least mean score of these.
FEW, FAINT = 4, 0.05


#: Of a candidate s with its digits: format checks, of the base kinds as defined, of the others by their own rules.
LUHN = "aggregate(transform(split(reverse(digits), ''), (d, i) -> coalesce(if(i % 2 = 1, if(try_cast(d AS int) > 4, 2 * try_cast(d AS int) - 9, 2 * try_cast(d AS int)), try_cast(d AS int)), 0)), 0, (a, d) -> a + d) % 10 = 0"
VALID = {
    "email": "true",
    "ip": f"s.found RLIKE {quoted(rf'^{_octet}(?:\.{_octet}){{3}}$')}",
    "card": f"length(digits) BETWEEN 12 AND 19 AND {LUHN}",
    "phone": "length(digits) BETWEEN 9 AND 15",
    "written_email": f"s.found RLIKE {quoted(r'(?i)(?:com|org|net|edu|gov|io|[a-z]{2})$')}",
    "local_phone": f"length(digits) = 10 AND s.found RLIKE {quoted(r'^\(?[2-9]')}",
    "ssn": f"length(digits) = 9 AND length(s.found) = 11 AND NOT s.found RLIKE {quoted(r'^(?:000|666|9)|-00-|-0000$')}",
    "iban": f"s.found RLIKE {quoted('^[A-Z]{2}[0-9]{2}[ A-Z0-9]+$')} AND length(digits) >= 8",
    "secret": "length(s.found) >= 20 AND s.found RLIKE '[A-Za-z]' AND length(digits) >= 3",
    "ipv6": f"s.found RLIKE {quoted(r'(?i)^(?:[0-9a-f]{1,4}:){7}[0-9a-f]{1,4}$')}",
}
#: Country and check digits behind the rest, letters from 10 on: the remainder is one.
MOD97 = (
    "aggregate(filter(split(concat(substring(regexp_replace(upper(s.found), ' ', ''), 5), left(regexp_replace(s.found, ' ', ''), 4)), ''), c -> c <> ''), 0, "
    "(a, c) -> (if(try_cast(c AS int) IS NULL, a * 100 + ascii(c) - 55, a * 10 + try_cast(c AS int))) % 97) = 1"
)
#: Levels of each feature; their product bounds the counts that the trees learn from.
LEVELS = {"kind": len(KINDS), "valid": 2, "length": 7, "digits": 6, "marks": 4, "letters": 4, "before": 5, "after": 5}


def _level(x: str, *cuts: int) -> str:
    return "(" + " + ".join(f"int({x} > {c})" for c in cuts) + ")"


def _around(c: str) -> str:
    return f"CASE WHEN {c} = '' THEN 0 WHEN {c} RLIKE {quoted(r'^\s$')} THEN 1 WHEN {c} RLIKE '^[0-9A-Za-z]$' THEN 2 WHEN {c} RLIKE {quoted("^[\"'`]$")} THEN 4 ELSE 3 END"


def _judged() -> str:
    """(kind, start, end, valid, evidence, x) of a candidate s: evidence is a checksum or range, or else a cue before it."""
    valid = "coalesce(CASE s.kind " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in VALID.items()) + " END, false)"
    cued = "coalesce(CASE s.kind " + " ".join(f"WHEN '{k}' THEN s.before RLIKE {quoted(v)}" for k, v in CUES.items()) + f" WHEN 'iban' THEN {MOD97} ELSE valid END, false)"
    features = [
        f"array_position(array({', '.join(map(quoted, KINDS))}), s.kind)::int - 1",
        f"int(valid AND s.kind NOT IN ({', '.join(map(quoted, BASE))}))",  # of the base kinds the check is what is learned
        _level("length(s.found)", 8, 12, 15, 19, 27, 39),
        _level("length(digits) * 8 / length(s.found)", 0, 1, 2, 4, 6),
        _level("length(regexp_replace(s.found, '[0-9A-Za-z]+', ''))", 0, 2, 4),
        "CASE WHEN NOT s.found RLIKE '[A-Za-z]' THEN 0 WHEN s.found RLIKE '^[^A-Za-z]*[a-f0-9]+$' THEN 1 WHEN s.found RLIKE '[a-z]' AND s.found RLIKE '[A-Z]' THEN 2 ELSE 3 END",
        _around("right(s.before, 1)"),
        _around("s.after"),
    ]
    struct = f"named_struct('kind', s.kind, 'start', s.start, 'end', s.end, 'valid', valid, 'evidence', {cued}, 'x', array({', '.join(features)}))"
    return named("digits", "regexp_replace(s.found, '[^0-9]+', '')", named("valid", valid, struct))


def with_candidates(df: DataFrame, text: str, out: str = "candidates") -> DataFrame:
    """df with the candidates of the whole text column: kind, place, whether its format check holds, evidence, and feature levels x."""
    keep, none = [c for c in df.columns if c != out], f"cast(array() AS {SPANS})"
    found = {k: spans("_text", quoted(PATTERNS[k]), quoted(k)) for k in KINDS}
    found |= {k: f"if({' OR '.join(f'contains(_text, {quoted(s)})' for s in signs)}, {found[k]}, {none})" for k, signs in SIGNS.items()}
    df = df.withColumn("_text", F.coalesce(F.col(text), F.lit(""))).select(*keep, F.expr(f"concat({', '.join(found[k] for k in KINDS)})").alias("_spans"))
    return df.select(*keep, F.expr(f"transform(_spans, s -> {_judged()})").alias(out))


@dataclass
class Model:
    """Depth-two trees over feature levels: (feature, cut, (feature, cut, low, high) on either side), and thresholds.

    limits: the least score of each kind; None where evidence is too rare, so that the format check decides.
    """

    base: float
    trees: list[tuple]
    limits: dict[str, float | None]

    def score(self, x: str) -> str:
        """SQL of the score of feature levels x."""
        side = lambda f, c, low, high: f"if({x}[{f}] <= {c}, {low!r}D, {high!r}D)"
        trees = "".join(f" + if({x}[{f}] <= {c}, {side(*left)}, {side(*right)})" for f, c, left, right in self.trees)
        return f"(1 / (1 + exp(-({self.base!r}D{trees}))))"

    def values(self, x: np.ndarray) -> np.ndarray:
        """Scores of rows of levels, on the driver."""
        raw = np.full(len(x), self.base)
        for f, c, *sides in self.trees:
            for side, (f2, c2, low, high) in zip((x[:, f] <= c, x[:, f] > c), sides, strict=True):
                raw += np.where(side, np.where(x[:, f2] <= c2, low, high), 0)
        return 1 / (1 + np.exp(-raw))


def _boost(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[float, list[tuple]]:
    """Boosted trees on weighted rows of feature levels."""
    if not len(x):
        return 0.0, []
    rate = np.clip((w * y).sum() / w.sum(), 0.01, 0.99)
    base, trees = float(np.log(rate / (1 - rate))), []
    raw = np.full(len(x), base)

    def split(rows, grad, hess):
        best = (0.0, 0, len(KINDS))
        for f in range(x.shape[1]):
            n = x[:, f].max() + 1
            g, h = np.bincount(x[rows, f], grad[rows], n).cumsum(), np.bincount(x[rows, f], hess[rows], n).cumsum()
            gain = g**2 / (h + 1) + (g[-1] - g) ** 2 / (h[-1] - h + 1) - g[-1] ** 2 / (h[-1] + 1)
            at = int(gain.argmax())
            best = max(best, (float(gain[at]), -f, at))
        return -best[1], best[2]

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = w * (p - y), w * p * (1 - p)
        f, c = split(np.ones(len(x), bool), grad, hess)
        tree, step = [f, c], np.zeros(len(x))
        for side in (x[:, f] <= c, x[:, f] > c):
            f2, c2 = split(side, grad, hess)
            values = []
            for leaf in (side & (x[:, f2] <= c2), side & (x[:, f2] > c2)):
                values.append(float(-RATE * grad[leaf].sum() / (hess[leaf].sum() + 1)))
                step[leaf] = values[-1]
            tree.append((f2, c2, *values))
        trees.append(tuple(tree))
        raw += step
    return base, trees


def train(candidates: DataFrame, id_col: str) -> Model:
    """Trees and thresholds from all rows' candidates (id, candidates).

    Candidates are counted by feature levels, evidence and fold on Spark; the counts, no more than the product of LEVELS
    times four, are what reaches the driver. One fold in four, by a hash of the id, is held back for the thresholds.

    A kind's threshold is half the mean score of its held-back candidates with evidence. With less than FEW of these in
    all, nothing can be learned of the kind and its format check decides alone. Where that mean is below FAINT, look-alikes
    prevail, and only candidates with evidence of their own are taken. Kinds without candidates have no say.
    """
    each = candidates.select((F.pmod(F.xxhash64(id_col), F.lit(4)) == 0).alias("back"), F.explode("candidates").alias("c"))
    counts = each.groupBy("back", F.col("c.evidence").alias("y"), F.col("c.x").alias("x")).count().collect()
    counts.sort(key=lambda r: (r.back, r.y, r.x))
    x = np.array([r.x for r in counts], int).reshape(len(counts), len(LEVELS))
    y, w, back = (np.array([v(r) for r in counts], float) for v in (lambda r: r.y, lambda r: r["count"], lambda r: r.back))
    learn = back == 0 if (back == 0).any() else back >= 0
    model = Model(*_boost(x[learn], y[learn], w[learn]), {})
    score = model.values(x)
    for k, kind in enumerate(KINDS):
        sure = (x[:, 0] == k) & (y == 1)
        held = sure & (back == 1) if w[sure & (back == 1)].sum() >= FEW else sure
        if w[sure].sum() < FEW:
            model.limits[kind] = None
            continue
        usual = float((score[held] * w[held]).sum() / w[held].sum())
        model.limits[kind] = usual / 2 if usual >= FAINT else 2.0
    return model


def with_spans(df: DataFrame, model: Model, candidates: str = "candidates") -> DataFrame:
    """df with taken (every candidate the model takes), base (valid spans of the base kinds) and spans (these and the added
    ones that are left): arrays of (start, rank of kind, end), in order. Of spans that overlap in a chain the base ones stay;
    where there is none the one of highest score does, then the longest, then the first."""
    limits = ", ".join(f"{-1.0 if model.limits[k] is None else model.limits[k]!r}D" for k in KINDS)
    score = f"if(c.x[0] < {len(BASE)}, if(c.valid, 2D, -1D), {model.score('c.x')})"
    weighed = f"named_struct('start', c.start, 'rank', c.x[0], 'end', c.end, 'score', {score}, 'valid', c.valid, 'sure', c.evidence AND c.valid)"
    limit = f"get(array({limits}), p.rank)"
    chosen = f"if(p.rank < {len(BASE)} OR {limit} < 0, p.valid, p.score >= {limit} - 1e-9D OR p.sure)"
    df = df.withColumn("taken", F.expr(f"array_sort(filter(transform({candidates}, c -> {weighed}), p -> {chosen}))"))
    plain = lambda ps: F.expr(f"transform({ps}, p -> named_struct('start', p.start, 'rank', p.rank, 'end', p.end))")
    better = "struct(p.score, p.end - p.start, -p.start, -p.rank)"
    one = named("top", f"array_max(transform(chain, p -> {better}))", f"filter(chain, p -> p.rank < {len(BASE)} OR {better} = top)")
    resolved = f"flatten(transform({_chains('taken')}, g -> {named('chain', 'slice(taken, g.first + 1, g.last - g.first + 1)', one)}))"
    return df.withColumns({"base": plain(f"filter(taken, p -> p.rank < {len(BASE)})"), "spans": plain(f"if(size(taken) > 1, {resolved}, taken)")})


def _chains(places: str) -> str:
    """Runs of ordered places that overlap: (first, last) as places in the array, and the end of the run."""
    firsts = f"filter({indices(f'size({places})')}, i -> i = 0 OR get({places}, i).start >= get(reach, i - 1))"
    last = f"(coalesce(get(firsts, k + 1), size({places})) - 1)"
    run = f"transform(firsts, (f, k) -> named_struct('first', f, 'last', {last}, 'end', cast(get(reach, {last}) AS int)))"
    return named("reach", running(f"transform({places}, p -> cast(p.end AS bigint))", lambda a, b: f"greatest({a}, {b})"), named("firsts", firsts, run))


def listed(places: Column) -> Column:
    """kind:start:end of each, joined by commas."""
    return F.array_join(F.transform(places, lambda p: F.concat_ws(":", F.get(F.lit(list(KINDS)), p["rank"]), p["start"], p["end"])), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, base, spans) per row of docs, over whole texts.

    Null and empty texts have no spans. Rows stay as they are, repeated ones and null ids too; no rows give none, and other
    columns are not read. The texts are read once: what they hold of candidates is small, and is kept in the shared folder
    for training and selection. Work follows the length of a text and the count of its candidates, also in very long ones.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    rows = checkpointed(with_candidates(rows, "text").drop("text"))
    return with_spans(rows, train(rows, "id")).select("id", "base", "spans")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with each found span, overlapping ones as one, replaced by its kind in angle brackets; all columns stay.

    Rows without a span keep their text, null texts stay null, repeated rows stay repeated and no rows give none. The rows
    with their candidates are written to the shared folder once, so no text is matched or shuffled a second time.
    """
    columns = docs.columns
    own = {c: f"_own_{k}" for k, c in enumerate(columns)}
    rows = written(with_candidates(docs.withColumnsRenamed(own), own[text_col]))
    found = with_spans(rows, train(rows, own[id_col]))

    begin, before = "get(taken, g.first)", "coalesce(get(b.chains, k - 1).end, 0)"
    part = f"concat({cut('b.paged', before, f'{begin}.start')}, '<', get(array({', '.join(map(quoted, KINDS))}), {begin}.rank), '>')"
    tail = cut("b.paged", "element_at(b.chains, -1).end", f"length({own[text_col]})")
    clean = f"concat(array_join(transform(b.chains, (g, k) -> {part}), ''), {tail})"
    pair = f"named_struct('paged', {pages(own[text_col])}, 'chains', {_chains('taken')})"
    new = F.expr(f"if(size(taken) = 0, {own[text_col]}, {named('b', pair, clean)})")
    return found.select(*((new if c == text_col else F.col(own[c])).alias(c) for c in columns))
