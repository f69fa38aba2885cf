"""Votes in the minutes of an item, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from civicframe.functions.dates import MONTHS
from civicframe.functions.text import let

MEMBERS, LARGEST = 43, 60
FOOTER = r"(?im)^\s*\d{1,2}\s+(?:" + "|".join(MONTHS) + r")\s+\d{4}\s*$"
#: One count or a unanimous vote, and what may stand between counts of one vote. Fixed values.
COUNT = r"(?:\d+\s+(?:stemmen\s+voor|stem\s+voor|stemmen\s+tegen|stem\s+tegen|onthoudingen|onthouding)\b)"
BETWEEN = r"[\s,;]*(?:\((?:[^()]|\([^()]*\)){0,3000}\))?[\s,;]*(?:en\s+)?(?:met\s+)?"
UNANIMOUS = r"eenparigheid\s+van\s+stemmen"
OWN = r"\bstemresultaat\s+(?:agenda)?punt\s+zelf\b"

KINDS = ("voor", "tegen", "onthoudingen")
VOTE = "struct<eenparig:boolean,onbetrouwbaar:boolean,voor:int,tegen:int,onthoudingen:int>"


def formulas(low: Column) -> Column:
    """Array of the votes in a text in lower case, in order.

    A run of counts is one vote until a kind comes a second time; a count above ``LARGEST`` makes an unreliable one.
    """
    runs = F.regexp_extract_all(low, F.lit(f"({UNANIMOUS}|{COUNT}(?:{BETWEEN}{COUNT})*)"), F.lit(1))
    vote = lambda **given: F.struct(*(given.get(k, F.lit(None)).cast(t).alias(k) for k, t in (("eenparig", "boolean"), ("onbetrouwbaar", "boolean"), ("voor", "int"), ("tegen", "int"), ("onthoudingen", "int"))))
    none = F.array().cast(f"array<{VOTE}>")

    def of_run(run: Column) -> Column:
        def step(acc: Column, text: Column) -> Column:
            kind = F.when(F.contains(text, F.lit("voor")), "voor").when(F.contains(text, F.lit("tegen")), "tegen").otherwise("onthoudingen")
            read = F.struct(F.regexp_extract(text, r"^(\d+)", 1).try_cast("int").alias("n"), kind.alias("kind"), F.get(acc, F.size(acc) - 1).alias("last"))
            return let(read, lambda r: put(acc, r["n"], r["kind"], r["last"]))

        def put(acc: Column, n: Column, kind: Column, last: Column) -> Column:
            mine = lambda k: F.when(kind == k, n)
            fresh = vote(**{k: mine(k) for k in KINDS})
            taken = F.when(kind == "voor", last["voor"]).when(kind == "tegen", last["tegen"]).otherwise(last["onthoudingen"])
            joined = vote(**{k: F.coalesce(last[k], mine(k)) for k in KINDS})
            opens = (F.size(acc) == 0) | taken.isNotNull() | F.coalesce(last["onbetrouwbaar"], F.lit(False))
            return F.when(n.isNull() | (n > LARGEST), F.concat(acc, F.array(vote(onbetrouwbaar=F.lit(True))))).when(opens, F.concat(acc, F.array(fresh))).otherwise(F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(joined)))

        counts = F.regexp_extract_all(run, F.lit(f"({COUNT})"), F.lit(1))
        return F.when(run.rlike(UNANIMOUS), F.array(vote(eenparig=F.lit(True)))).otherwise(F.aggregate(counts, none, step))

    def whole(v: Column) -> Column:
        counted = v["eenparig"].isNull() & v["onbetrouwbaar"].isNull()
        return vote(eenparig=v["eenparig"], onbetrouwbaar=v["onbetrouwbaar"], **{k: F.when(counted, F.coalesce(v[k], F.lit(0))) for k in KINDS})

    return F.transform(F.flatten(F.transform(runs, of_run)), whole)


def vote(text: Column) -> Column:
    """How an item was voted: struct of modus, voor, tegen, onthoudingen and stemmingen (when there were several).

    After the last mark of the item's own vote only what follows counts, if there is a vote there.
    """
    plain = F.translate(F.coalesce(text, F.lit("")), "\u00a0\u2007\u202f", "   ")  # blanks that do not break a line
    low = F.lower(F.regexp_replace(plain, FOOTER, ""))
    own = lambda t: F.when(F.contains(t, F.lit("stemresultaat")), F.regexp_extract(t, rf"(?s).*({OWN}.*)$", 1)).otherwise("")

    def of_own(t: Column, o: Column) -> Column:
        votes = F.when(F.contains(o, F.lit("stemresultaat")), formulas(o)).otherwise(F.array().cast(f"array<{VOTE}>"))
        return let(votes, lambda v: let(F.when(F.size(v) > 0, F.struct(o.alias("part"), v.alias("votes"))).otherwise(F.struct(t.alias("part"), formulas(t).alias("votes"))), lambda x: let(F.array_distinct(x["votes"]), lambda d: _judged(x["part"], d))))

    return let(low, lambda t: let(own(t), lambda o: of_own(t, o)))


def _judged(part: Column, distinct: Column) -> Column:
    """The struct of :func:`vote` for the text that counts and its different votes."""
    one = F.get(distinct, 0)
    total = lambda v: F.coalesce(v["voor"] + v["tegen"] + v["onthoudingen"], F.lit(0))
    mode = (
        F.when((F.size(distinct) == 0) & F.contains(part, F.lit("niet ter stemming")), "niet-ter-stemming")
        .when((F.size(distinct) == 0) & F.contains(part, F.lit("mondeling beantwoord")), "mondeling-beantwoord")
        .when(F.size(distinct) == 0, "geen")
        .when(F.exists(distinct, lambda v: F.coalesce(v["onbetrouwbaar"], F.lit(False)) | (total(v) > MEMBERS)), "onbekend")
        .when(F.size(distinct) > 1, "meerdere")
        .when(F.coalesce(one["eenparig"], F.lit(False)), "eenparig")
        .otherwise("geteld")
    )
    single = lambda modus, k: F.when(modus == "geteld", one[k]).alias(k)
    return let(mode, lambda modus: F.struct(modus.alias("modus"), *(single(modus, k) for k in KINDS), F.when(modus == "meerdere", distinct).alias("stemmingen")))
