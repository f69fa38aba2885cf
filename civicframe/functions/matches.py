"""All matches of a pattern as columns: their places, and replacement by an expression of each match."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once a row however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def replaced(text: Column, pattern: str, instead: Callable[[Column], Column]) -> Column:
    """``text`` with each match of ``pattern`` (which matches no empty text) as ``instead(match)``.

    The text is cut at the matches, so an expression can decide for each of them; texts without a match stay as they are.
    """

    def build(t: Column) -> Column:
        between = F.split(t, pattern, -1)
        found = F.transform(F.regexp_extract_all(t, F.lit(f"({pattern})"), F.lit(1)), instead)
        return F.array_join(F.flatten(F.zip_with(between, found, lambda b, m: F.array(F.coalesce(b, F.lit("")), F.coalesce(m, F.lit(""))))), "")

    return let(text, lambda t: F.when(t.rlike(pattern), build(t)).otherwise(t))


def placed(text: Column, pattern: str) -> Column:
    """Array of (start, match) of the matches of ``pattern``, starts from 0 in code points."""

    def build(t: Column) -> Column:
        pairs = F.arrays_zip(F.split(t, pattern, -1).alias("b"), F.regexp_extract_all(t, F.lit(f"({pattern})"), F.lit(1)).alias("m"))
        none = F.array().cast("array<struct<start:int,match:string>>")
        zero = F.struct(F.lit(0).alias("at"), none.alias("out"))

        def step(a: Column, p: Column) -> Column:
            start = a["at"] + F.length(p["b"])
            return F.struct((start + F.length(p["m"])).alias("at"), F.array_append(a["out"], F.struct(start.alias("start"), p["m"].alias("match"))).alias("out"))

        return F.aggregate(F.filter(pairs, lambda p: p["m"].isNotNull()), zero, step, lambda a: a["out"])

    return let(text, lambda t: F.when(t.rlike(pattern), build(t)).otherwise(F.array().cast("array<struct<start:int,match:string>>")))


def any_of(names: list[str] | tuple[str, ...]) -> str:
    """A pattern of literal names, longest first, white space between words in any form; names that begin alike share their start."""
    quoted = lambda w: r"\Q" + w.replace(r"\E", "") + r"\E"
    groups: dict[str, list[list[str]]] = {}
    for words in sorted({tuple(n.split()) for n in names if n.split()}, key=lambda w: (-sum(map(len, w)), w)):
        groups.setdefault(words[0], []).append(list(words[1:]))
    # one first word with several endings is one branch; a branch's longer endings come first
    branches = []
    for first, rests in sorted(groups.items(), key=lambda g: (-len(g[0]), g[0])):
        ends = [r"\s+" + r"\s+".join(map(quoted, r)) for r in rests if r]
        branches.append(quoted(first) + (f"(?:{'|'.join(ends)}){'?' if [] in rests else ''}" if ends else ""))
    return f"(?:{'|'.join(branches)})"
