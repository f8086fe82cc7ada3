r"""License scans by ordered signature rules, in Spark expressions.

A rule (of ``license_rules``) is a label, a keyword, a regular expression and a priority. Rules are tried on texts that hold
their keyword. A detection is dropped when one of higher priority, or of the same and longer, contains its interval. Three
base phrases are found by words besides, and always stay.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almanac.llm.license_rules import rules
from almanac.llm.spans import indices, named, quoted, running, spans

WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BASE = ((("cc", "by"), "cc-by"), (("general", "public", "license"), "gpl"), (("all", "rights", "reserved"), "reserved"))
RULES = "array<struct<key:string,own:array<struct<label:string,pattern:string,rank:int>>>>"


def detections(text: str, low: str) -> Column:
    """(start, end, label, rank) of every match of a rule whose keyword stands in the text, before suppression."""
    by_key: dict[str, list[dict]] = {}
    for label, key, pattern, rank in rules():
        by_key.setdefault(key, []).append({"label": label, "pattern": f"(?i){pattern}", "rank": rank})
    # One literal; thousands of them would take seconds to plan.
    table = f"from_json({quoted(json.dumps([{'key': key, 'own': own} for key, own in by_key.items()]))}, '{RULES}')"
    tried = f"flatten(transform(filter({table}, t -> contains({low}, t.key)), t -> t.own))"
    place = "named_struct('start', s.start, 'end', s.end, 'label', s.kind, 'rank', r.rank)"
    return F.expr(f"flatten(transform({tried}, r -> transform({spans(text, 'r.pattern', 'r.label')}, s -> {place})))")


def unsuppressed(found: str) -> Column:
    """The detections that no other contains with higher priority, or with the same and more length; by start.

    Sorted by start, then from long to short, then by priority, what contains a detection stands before it. An interval's
    reach is its end, then how far left it starts. A detection goes if the running maximum of the reaches of a higher
    priority is its own or more, or that of its priority is more: one pass over all.
    """
    ranks = sorted({r[3] for r in rules()})
    reach = f"(cast(d.end AS bigint) * {1 << 31} - d.start)"
    ordered = f"array_sort(transform({found}, d -> named_struct('start', d.start, 'to', -d.end, 'over', -d.rank, 'label', d.label, 'end', d.end, 'rank', d.rank)))"
    reaches = f"transform(ds, d -> array({', '.join(f'if(d.rank = {r}, {reach}, -1L)' for r in ranks)}))"
    best = running(reaches, lambda a, b: f"zip_with({a}, {b}, (y, z) -> greatest(y, z))", "array<bigint>")
    above = " OR ".join(f"({r} > d.rank AND get(get(ms, i), {k}) >= {reach}) OR ({r} = d.rank AND get(get(ms, i), {k}) > {reach})" for k, r in enumerate(ranks))
    swept = named("ms", best, f"filter(ds, (d, i) -> NOT ({above}))")
    return F.expr(named("ds", ordered, f"transform(if(size(ds) > 1, {swept}, ds), d -> named_struct('start', d.start, 'end', d.end, 'label', d.label, 'rank', d.rank))"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, places, found) per row of docs, over whole texts.

    places: (word, label) of every base phrase; found: the detections left, (start, end, label, rank). A null text counts
    as empty: no words, places or detections. Rows stay as they are, repeated ones and null ids too; no rows give none, and
    other columns are not read. Equal intervals of one priority all stay. Work follows the length of a text and the count
    of its detections, also in very long ones.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("n_words", F.regexp_count("text", F.lit(WORD)).cast("bigint")).withColumn("low", F.lower("text"))
    gates = [F.least(*(F.contains("low", F.lit(w)) for w in phrase)) for phrase, _ in BASE]
    rows = rows.withColumn("words", F.when(F.greatest(*gates), F.regexp_extract_all(F.translate("text", _UPPER, _LOWER), F.lit(WORD), F.lit(0))).otherwise(F.array().cast("array<string>")))
    rows = rows.withColumn("found", detections("text", "low"))

    def places(phrase, label):
        rest = " AND ".join(f"get(words, i + {k}) = '{w}'" for k, w in enumerate(phrase))
        starts = f"filter({indices('size(words)')}, i -> coalesce({rest}, false))"
        return F.expr(f"transform({starts}, i -> named_struct('word', i, 'label', '{label}'))")

    rows = rows.withColumn("places", F.concat(*(places(p, label) for p, label in BASE)))
    return rows.select("id", "n_words", "places", unsuppressed("found").alias("found"))
