"""Quality rules by weak supervision: statistics and estimation against plain definitions, verdicts against labels."""

import math
import random
import re
import unicodedata
from collections import Counter

import pytest
from pyspark.sql import functions as F

from almanac.llm import queries, rules
from tests.llm import data

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    lines, seen, repeated = text.split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    inside = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    kinds = [[unicodedata.category(c) for c in w] for w in words]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": repeated, "n_repeat_words": len(inside),
        "n_lines": sum(bool(WORD.search(x)) for x in lines), "n_stops": sum(w[-1] in ".!?" for w in words), "n_odd": sum(k[0] != "L" for w in kinds for k in w), "n_capitals": sum(k == "Lu" for w in kinds for k in w),
        "n_unlettered": sum(all(k[0] != "L" for k in w) for w in kinds), "n_digits": len(re.findall("[0-9]", text)), "n_marks": text.count("!"),
    }


def plain_model(rows):
    """Expectation-maximisation row by row, in plain loops."""
    share, good, bad = rules.SHARE, [rules.GOOD] * len(rules.RULES), [rules.BAD] * len(rules.RULES)
    for _ in range(rules.ROUNDS):
        qs = []
        for v in rows:
            a, b = share, 1 - share
            for r, x in enumerate(v):
                if x:
                    a *= good[r] if x > 0 else 1 - good[r]
                    b *= bad[r] if x < 0 else 1 - bad[r]
            qs.append(a / (a + b))
        new = [min(0.99, max(0.01, sum(qs) / len(qs)))], [], []
        for r in range(len(rules.RULES)):
            g = (sum(q for q, v in zip(qs, rows, strict=True) if v[r] > 0) + 10 * rules.GOOD) / (sum(q for q, v in zip(qs, rows, strict=True) if v[r]) + 10)
            b = (sum(1 - q for q, v in zip(qs, rows, strict=True) if v[r] < 0) + 10 * rules.BAD) / (sum(1 - q for q, v in zip(qs, rows, strict=True) if v[r]) + 10)
            if g + b < 1:
                g = (sum(v[r] > 0 for v in rows) + 5) / (sum(v[r] != 0 for v in rows) + 10)
                b = 1 - g
            new[1].append(min(rules.LIMITS[1], max(rules.LIMITS[0], g)))
            new[2].append(min(rules.LIMITS[1], max(rules.LIMITS[0], b)))
        moved = max(abs(x - y) for x, y in zip([share, *good, *bad], [*new[0], *new[1], *new[2]], strict=True))
        share, good, bad = new[0][0], new[1], new[2]
        if moved < rules.SETTLED:
            break
    return share, good, bad


def test_statistics_of_odd_texts(spark):
    more = ["a b c a b c", "a a a a", "x\nx\n\nx \n y", "Ä ß É? ǅ 中文。 a1 !! |", "one two three one two", "| | |", "\n\n", "…!   　x y", "a\rb\r\nc a\x0bb"]
    docs = data.documents(spark).unionByName(spark.createDataFrame([(100 + k, t, "en", "s", 1, "x", "y", 0) for k, t in enumerate(more)], data.SCHEMA))
    texts = {r.kept: r.text for r in docs.collect()}
    got = rules.with_statistics(docs.select("text", F.lit("own").alias("id")), "text").collect()
    for r in got:
        assert {s: r[s] for s in rules.STATS} == plain_statistics(r.text), r.text and r.text[:80]
    assert len(got) == docs.count() and len(texts)
    assert rules.judge(data.empty(spark)).collect() == []


@pytest.mark.parametrize("place", [20, 60, 2])
def test_repeated_words_whatever_the_hashes_say(spark, place):
    """With 60 low bits for places hardly a bit of the hash is left, and with two the places don't fit: words decide then."""
    draw = random.Random(7)
    texts = ["", "a", "a b", "a b c", "a b c d", *(" ".join(draw.choice("abcdef"[: 2 + k % 5]) for _ in range(k)) for k in range(4, 90))]
    df = spark.createDataFrame([(t, t.split()) for t in texts], "text string, words array<string>")
    for r in df.select("text", F.expr(rules.repeated_words("words", place)).alias("n")).collect():
        assert r.n == plain_statistics(r.text)["n_repeat_words"], r.text


def test_verdicts_are_those_of_plain_estimation(spark):
    docs = spark.read.parquet(f"{data.DATA}/documents.parquet")
    docs = docs.unionByName(docs.limit(3)).unionByName(docs.where("doc_id < 40").withColumn("text", F.lit(None).cast("string")))
    judged = rules.judge(docs).collect()
    share, good, bad = plain_model([r.votes for r in judged])
    for r in judged:
        odds = math.log(share / (1 - share))
        for k, v in enumerate(r.votes):
            odds += {1: math.log(good[k] / (1 - bad[k])), -1: math.log((1 - good[k]) / bad[k]), 0: 0}[v]
        failed = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.posterior == pytest.approx(1 / (1 + math.exp(-odds)), abs=1e-6) and r.base_failed == failed and r.kept == (not failed and r.posterior >= 0.5)
    odd = data.documents(spark).withColumn("posterior", F.lit("own"))
    kept = rules.kept_documents(odd)
    assert kept.columns == odd.columns
    want = Counter(r.id for r in rules.judge(odd, id_col="kept").where("kept").collect())
    assert Counter(r.kept for r in kept.collect()) == want and rules.kept_documents(data.empty(spark)).collect() == []


def test_verdicts_agree_with_labels(spark):
    """Labels were never seen: good texts of some length stay, bad ones go."""
    where = data.DATA.replace("0.001", "0.01")
    found = queries.op11_rules(spark, where).join(spark.read.parquet(f"{where}/labels.parquet"), "doc_id").where("NOT base_failed").collect()
    good, bad = [r.kept for r in found if r.quality == 1], [r.kept for r in found if r.quality == 0]
    assert len(bad) > 20 and sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_one_failed_rule_does_not_drop_a_text(spark):
    plain = "Some words of a plain text stand here, and they go on for a while. "
    texts = [plain * 1 + " ".join(f"word{k} and then" for k in range(30)) + ". " + " ".join(f"more{k} of it." for k in range(20)) for _ in range(1)]
    marked = texts[0] + " !" * 60
    docs = spark.createDataFrame([(k, t) for k, t in enumerate([*texts * 60, marked])], "doc_id bigint, text string")
    found = {r.id: r for r in rules.judge(docs).collect()}
    assert -1 in found[60].votes and found[60].kept
