"""Language identification by cross-parsing.

For each language, a suffix automaton holds every substring of a sample of its labelled text. A text is parsed from
left to right into phrases, each the longest match in the automaton; a text in the automaton's language needs few.
The number of phrases, times the bits that name a place in the sample, over the length of the text, is the
cross-parsing entropy; the language of the least wins.

The automata are turned into tables so that many segments of ``SEGMENT`` symbols are parsed in step, each from the root at first. A
segment that goes on with a text is then parsed again from the state that the one before it ends in, beside the first parse, until
both are in one state, mostly after some phrases. So phrases run on over cuts, and long texts get exactly the phrases of the method.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from civicframe.llm.common import release

SEGMENT = 2048
#: Entries of a full table; a language whose letters and states make more keeps its arcs as a sorted list.
FULL = 1 << 23
UNKNOWN = "und"


class Alphabet:
    """Maps code points of lower-case text to symbols: 0 is a gap between words, 1 a letter that no sample has; each
    letter of the samples has its own."""

    def __init__(self, samples: dict[str, str]) -> None:
        counts: dict[str, int] = {}
        for text in samples.values():
            for c in text.lower():
                if c.isalpha():
                    counts[c] = counts.get(c, 0) + 1
        self.symbol = {c: i + 2 for i, c in enumerate(sorted(counts, key=lambda c: (-counts[c], c)))}
        self.size = len(self.symbol) + 2
        self.table = np.full(0x110000, -1, np.int32)  # -1: not looked at yet
        for c, i in self.symbol.items():
            self.table[ord(c)] = i

    def encode(self, text: str) -> np.ndarray:
        """Symbols of ``text``: one gap for each run of other signs than letters, none at the ends."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        out = self.table[points]
        if (new := out < 0).any():
            for p in np.unique(points[new]).tolist():
                self.table[p] = 1 if chr(p).isalpha() else 0
            out = self.table[points]
        keep = out != 0
        keep[1:] |= out[:-1] != 0  # the first sign of each gap
        out = out[keep]
        return out[int(len(out) > 0 and out[0] == 0) : len(out) - int(len(out) > 0 and out[-1] == 0)]


class Arcs(NamedTuple):
    """Arcs of a suffix automaton.

    ``column`` has the language's own column of each symbol; letters that it does not have share column 0. ``table`` has,
    at state * columns + column, twice the next state's row; it is odd where the state has no such arc: a phrase ends,
    and the next one has begun with this symbol. With many letters ``table`` is for the root alone, and ``keys`` and
    ``to`` are the sorted places and the entries of all other states' arcs.
    """

    column: np.ndarray
    columns: int
    table: np.ndarray
    keys: np.ndarray | None
    to: np.ndarray | None


def automaton(symbols: list[int], size: int, full: int = FULL) -> Arcs:
    """The suffix automaton of ``symbols``, which are less than ``size``."""
    own = sorted(set(symbols))
    column = np.zeros(size, np.int32)
    column[own] = np.arange(1, len(own) + 1)
    symbols, columns = column[symbols].tolist() if symbols else [], len(own) + 1
    arcs: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new = len(arcs)
        arcs.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in arcs[p]:
            arcs[p][c] = new
            p = link[p]
        if p >= 0:
            q = arcs[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(arcs)
                arcs.append(dict(arcs[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[new] = copy
                while p >= 0 and arcs[p].get(c) == q:
                    arcs[p][c] = copy
                    p = link[p]
        last = new
    root = np.array([2 * columns * arcs[0].get(c, 0) + 1 for c in range(columns)], np.int64)
    if len(arcs) * columns > full:
        places = sorted((state * columns + c, 2 * columns * to) for state, out in enumerate(arcs) if state for c, to in out.items())
        keys, to = np.array(places, np.int64).reshape(-1, 2).T.copy()
        return Arcs(column, columns, root, keys, to)
    table = np.tile(root.astype(np.int32), (len(arcs), 1))
    for state, out in enumerate(arcs):
        for c, to in out.items():
            table[state, c] = 2 * columns * to
    table[0, :] |= 1  # the root stands for the end of a phrase that could not begin
    return Arcs(column, columns, table.ravel(), None, None)


def _next(arcs: Arcs, state: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Where each state goes by its column: twice the next state's row, odd if a phrase begins there."""
    if arcs.keys is None:
        return arcs.table[state + columns]
    to, place = arcs.table[columns], state + columns
    if len(arcs.keys):
        at = np.searchsorted(arcs.keys, place)
        at[at == len(arcs.keys)] = 0
        to = np.where(arcs.keys[at] == place, arcs.to[at], to)
    return to


def parsed(arcs: Arcs, segments: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Phrases of each column of ``segments``, and its last state; the columns are in descending order of ``lengths``."""
    segments = arcs.column[segments]
    count = np.zeros(segments.shape[1], np.int32)
    state = np.zeros(segments.shape[1], arcs.table.dtype)
    live = np.searchsorted(-lengths, -np.arange(segments.shape[0]), "left")
    for step in range(segments.shape[0]):
        n = live[step]
        if not n:
            break
        to = _next(arcs, state[:n], segments[step, :n])
        count[:n] += to & 1
        state[:n] = to >> 1
    return count, state


def phrases(arcs: Arcs, segments: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Number of phrases of each column of ``segments``, whose columns are in descending order of ``lengths``."""
    return parsed(arcs, segments, lengths)[0]


def carried(arcs: Arcs, pieces: list[np.ndarray], begin: np.ndarray, step: int = 64) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """How many phrases more each piece has if it begins in state ``begin`` instead of the root.

    Both parses go on side by side until they are in one state, from where they are the same. Returns the difference, whether they met, and the
    state that the parse from ``begin`` has reached where they did not.
    """
    more, met, last = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), bool), begin.astype(arcs.table.dtype)
    who = np.arange(len(pieces))
    true, root = last.copy(), np.zeros(len(pieces), arcs.table.dtype)
    sizes = np.array([len(p) for p in pieces], np.int64)
    at = 0
    while len(who):
        wide = min(step, int(sizes[who].max()) - at)
        grid = np.zeros((wide, len(who)), np.int32)
        for k, j in enumerate(who.tolist()):
            part = pieces[j][at : at + wide]
            grid[: len(part), k] = part
        grid = arcs.column[grid]
        for row in range(wide):
            go = (sizes[who] > at + row) & ~met[who]
            a, b = _next(arcs, true, grid[row]), _next(arcs, root, grid[row])
            more[who] += np.where(go, (a & 1).astype(np.int64) - (b & 1), 0)
            true, root = np.where(go, a >> 1, true), np.where(go, b >> 1, root)
            met[who] |= go & (true == root)
        last[who] = true
        at += wide
        on = ~met[who] & (sizes[who] > at)
        who, true, root = who[on], true[on], root[on]
    return more, met, last


class Model:
    """Automata of some languages."""

    def __init__(self, samples: dict[str, str]) -> None:
        self.alphabet = Alphabet(samples)
        self.langs = sorted(samples)
        encoded = [self.alphabet.encode(samples[k]) for k in self.langs]
        self.tables = [automaton(x.tolist(), self.alphabet.size) for x in encoded]
        self.bits = np.array([math.log2(len(x) + 2) for x in encoded])

    def entropies(self, texts: list[str], group: int = 2048) -> tuple[np.ndarray, np.ndarray]:
        """Bits a symbol, a row for each text and a column for each language; and the symbols of each text."""
        parts = [self.alphabet.encode(t) for t in texts]
        n = np.array([len(p) for p in parts], np.int64)
        owner = np.repeat(np.arange(len(parts)), -(-n // SEGMENT))
        pieces = [p[i : i + SEGMENT] for p in parts for i in range(0, len(p), SEGMENT)]
        sizes = np.array([len(x) for x in pieces], np.int64)
        order = np.argsort(-sizes, kind="stable")
        count = np.zeros((len(pieces), len(self.langs)), np.int64)
        last = [np.zeros(len(pieces), t.table.dtype) for t in self.tables]
        for i in range(0, len(order), group):
            some = order[i : i + group]
            grid = np.zeros((sizes[some[0]], len(some)), np.int32)
            for k, j in enumerate(some.tolist()):
                grid[: sizes[j], k] = pieces[j]
            for k, table in enumerate(self.tables):
                count[some, k], last[k][some] = parsed(table, grid, sizes[some])
        # a piece that goes on with a text begins in the state that the one before it ends in
        goes_on = np.flatnonzero(owner[1:] == owner[:-1]) + 1
        for k, table in enumerate(self.tables):
            alone, ends, todo = count[:, k].copy(), last[k].copy(), goes_on
            while len(todo):
                more, met, end = carried(table, [pieces[j] for j in todo], last[k][todo - 1])
                count[todo, k] = alone[todo] + more
                # where the two parses never met, the piece ends elsewhere, and the next one is to be done again
                end = np.where(met, ends[todo], end)
                changed = end != last[k][todo]
                last[k][todo] = end
                todo = np.intersect1d(todo[changed] + 1, goes_on)
        total = np.zeros((len(texts), len(self.langs)))
        np.add.at(total, owner, count)
        return total * self.bits / np.maximum(n, 1)[:, None], n

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """The language of each text, and how clearly it wins: the runner-up's share of both entropies.

        0.5 is a tie (the first language by name wins it) and 1.0 stands for only one language known. Null texts and
        texts without letters are ``und``, with 0.
        """
        if not self.langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        bits, n = self.entropies([t or "" for t in texts])
        best = bits.argmin(axis=1)
        ordered = np.sort(bits, axis=1)
        first, second = ordered[:, 0], ordered[:, 1] if len(self.langs) > 1 else np.full(len(texts), np.inf)
        with np.errstate(invalid="ignore"):
            score = np.where(np.isinf(second), 1.0, second / np.maximum(first + second, 1e-12))
        return [self.langs[b] if k else UNKNOWN for b, k in zip(best.tolist(), n.tolist(), strict=True)], np.where(n > 0, score, 0.0).tolist()


def has_letter(text: Column) -> Column:
    """Whether a text has a letter of any script."""
    return text.rlike(r"\p{L}")


def samples(labelled: DataFrame, *, text_col: str, lang_col: str, rows: int, chars: int) -> dict[str, str]:
    """Labelled text of each language: whole texts, in the order of a hash, up to ``chars`` characters.

    Equal texts of a language count once, whatever their number. Only a share of the texts of each language that holds
    about twice ``rows`` is ordered, so a common language does not land in one task; at most ``rows`` of each come
    to the driver. Longer texts are cut, here alone. Texts without a letter teach nothing and are left out.
    """
    text = F.col(text_col)
    ranked = labelled.where(text.isNotNull() & F.col(lang_col).isNotNull() & has_letter(text)).select(F.col(lang_col).alias("lang"), text.alias("text"), F.xxhash64(text, F.lit("sample")).alias("h"))
    counts = ranked.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n")).collect()
    if not counts:
        return {}
    spark = labelled.sparkSession
    share = spark.createDataFrame([(r.lang, int(2 * rows / r.n * (2**63 - 1)) if r.n > 2 * rows else 2**63 - 1) for r in counts], "lang string, most long")
    few = ranked.join(F.broadcast(share), "lang").where(F.abs(F.col("h")) <= F.col("most")).select("lang", "h", F.substring("text", 1, chars).alias("text")).dropDuplicates(["lang", "h"])
    order = Window.partitionBy("lang").orderBy("h", "text")
    out: dict[str, list[str]] = {}
    for r in few.withColumn("k", F.row_number().over(order)).where(F.col("k") <= rows).orderBy("lang", "k").toLocalIterator():
        held = out.setdefault(r.lang, [])
        if sum(map(len, held)) < chars:
            held.append(r.text[: chars - sum(map(len, held))])
    return {k: " ".join(v) for k, v in out.items()}


models: dict[str, Model] = {}


def identify(docs: DataFrame, learned: dict[str, str], *, text_col: str = "text", out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """Add the columns ``out`` to ``docs``: the language and how clearly it wins. Columns of these names are replaced;
    all others, whatever their names, stay as they are.

    The samples are small (their bound is a parameter), so they go to the workers, which build the automata once.
    """
    share, key = docs.sparkSession.sparkContext.broadcast(learned), uuid.uuid4().hex
    names = docs.columns
    text_at = names.index(text_col)
    keep = [i for i, c in enumerate(names) if c not in out]
    plain = [f"c{i}" for i in range(len(names))]  # a name may hold signs that a column's can't be asked for by
    schema = StructType([StructField(plain[i], docs.schema.fields[i].dataType, True) for i in keep]).add("lang", "string").add("score", "double")

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from civicframe.llm import langid  # the module's own store, which later tasks of this worker find again

        if key not in langid.models:
            langid.models.clear()
            langid.models[key] = Model(share.value)
        model = langid.models[key]
        for batch in batches:
            for i in range(0, batch.num_rows, 1024):
                part = batch.slice(i, 1024)
                langs, scores = model.predict(part.column(text_at).to_pylist())
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keep), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], [*(plain[k] for k in keep), "lang", "score"])
        release()  # the worker waits for other tasks

    return docs.toDF(*plain).mapInArrow(predict, schema).toDF(*(names[i] for i in keep), *out)


def learn(docs: DataFrame, *, held_out: Column, text_col: str = "text", lang_col: str = "lang", rows: int = 400, chars: int = 40_000) -> dict[str, str]:
    """Samples of the rows that are not held out. At most ``rows`` texts and ``chars`` characters of each language.

    An empty table, or one without labels, gives no samples; all predictions are then ``und``. Equal texts of a
    language count once; ids play no part, so rows that repeat an id, or have none, are learned from like any others.
    """
    return samples(docs.where(~held_out), text_col=text_col, lang_col=lang_col, rows=rows, chars=chars)


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether a row belongs to the held-out fold; a null id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % folds == fold


__all__ = ["Model", "has_letter", "held_out", "identify", "learn", "samples"]
