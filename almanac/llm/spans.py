"""Spans of regular expression matches, running values and cuts of long texts, as SQL expressions of Spark.

An array that grows by one element a step is copied at each step, which is the square of its length. So running values are
made in blocks of BLOCK elements, and the blocks' own totals likewise, three levels deep: work in proportion up to some
millions of elements.

The functions take and return SQL text: as nested column objects the same expressions take seconds to build.
"""

from __future__ import annotations

from collections.abc import Callable

AROUND, BLOCK, PAGE = 40, 64, 4096
SPANS = "array<struct<kind:string,start:int,end:int,found:string,before:string,after:string>>"


def quoted(text: str) -> str:
    """A string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def named(name: str, value: str, body: str) -> str:
    """body, in which name stands for a value that is made once."""
    return f"get(transform(array({value}), {name} -> {body}), 0)"


def indices(n: str) -> str:
    """0 to n - 1; none for 0."""
    return f"if({n} > 0, sequence(0, {n} - 1), cast(array() AS array<int>))"


def running(values: str, both: Callable[[str, str], str], kind: str = "bigint", levels: int = 3) -> str:
    """The running values of an array, each with all before it joined by ``both`` (a sum, a maximum)."""

    def plain(xs: str) -> str:
        return f"aggregate({xs}, cast(array() AS array<{kind}>), (o, x) -> concat(o, array(if(size(o) > 0, {both('element_at(o, -1)', 'x')}, x))))"

    if levels == 1:
        return plain(values)
    xs, ps, es = f"xs{levels}", f"ps{levels}", f"es{levels}"
    parts = f"transform({indices(f'cast(ceil(size({xs}) / {BLOCK}) AS int)')}, k -> {plain(f'slice({xs}, k * {BLOCK} + 1, {BLOCK})')})"
    ends = running(f"transform({ps}, p -> element_at(p, -1))", both, kind, levels - 1)
    shifted = f"flatten(transform({ps}, (p, k) -> if(k = 0, p, {named('b', f'get({es}, k - 1)', f'transform(p, v -> {both("b", "v")})')})))"
    return named(xs, values, f"if(size({xs}) <= {BLOCK}, {plain(xs)}, {named(ps, parts, named(es, ends, shifted))})")


def spans(text: str, pattern: str, kind: str) -> str:
    """(kind, start, end, found, before, after) of each match in order; code points from 0, end exclusive.

    The texts between the matches, split off by the same pattern, give the places by the running sum of their lengths, and
    up to AROUND characters before and one after each match. Work follows the length of the text and the count of matches.
    A text without a match is matched once and not split.
    """
    sizes = "transform(m.found, (f, i) -> cast(length(f) + length(get(m.gaps, i)) AS bigint))"
    span = (
        f"named_struct('kind', {kind}, 'start', cast(get(ends, i) AS int) - length(f), 'end', cast(get(ends, i) AS int), 'found', f, "
        f"'before', right(get(m.gaps, i), {AROUND}), 'after', left(get(m.gaps, i + 1), 1))"
    )
    placed = named("ends", running(sizes, lambda a, b: f"{a} + {b}"), f"transform(m.found, (f, i) -> {span})")
    every = named("m", f"named_struct('found', regexp_extract_all({text}, {pattern}, 0), 'gaps', split({text}, {pattern}, -1))", placed)
    return f"if(regexp_like({text}, {pattern}), {every}, cast(array() AS {SPANS}))"


def pages(text: str) -> str:
    """A text in pages of PAGE code points."""
    return f"regexp_extract_all({text}, '(?s).{{1,{PAGE}}}', 0)"


def cut(paged: str, start: str, end: str) -> str:
    """The code points from start to end of a text in pages; only the pages between are looked at."""
    first, last = f"cast(floor(({start}) / {PAGE}) AS int)", f"cast(floor(({end}) / {PAGE}) AS int)"
    return f"substring(array_join(slice({paged}, {first} + 1, {last} - {first} + 1), ''), ({start}) - {first} * {PAGE} + 1, ({end}) - ({start}))"
