"""Text functions as column expressions."""

from __future__ import annotations

import html
import unicodedata
from bisect import bisect_left
from collections import Counter
from difflib import SequenceMatcher

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


def let(value: Column, body) -> Column:
    """``body(value)``, with ``value`` computed once a row however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _fold_table() -> tuple[str, str]:
    """Letters of Latin blocks that decompose to one ASCII letter and marks, and these letters."""
    source, target = [], []
    for point in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        base = "".join(c for c in unicodedata.normalize("NFD", chr(point)) if unicodedata.category(c) != "Mn")
        if len(base) == 1 and base.isascii() and base != chr(point):
            source.append(chr(point))
            target.append(base)
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _fold_table()
_MARKS = "[\\u0300-\\u036F]"


def fold(text: Column) -> Column:
    """Lower case without accents: Latin letters by a table, loose combining marks removed."""
    plain = lambda t: F.when(t.rlike(r"[^\x00-\x7F]"), F.regexp_replace(F.translate(t, _ACCENTED, _PLAIN), _MARKS, "")).otherwise(t)
    return let(F.lower(text), plain)


@F.pandas_udf(StringType())
def fold_exact(text: pd.Series) -> pd.Series:
    """Lower case, decomposed, without marks, for all scripts; :func:`fold` is the fast path for Latin text."""
    return text.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFD", t.lower()) if unicodedata.category(c) != "Mn"))


@F.pandas_udf(StringType())
def html_unescape(text: pd.Series) -> pd.Series:
    """Character references of HTML resolved."""
    return text.map(lambda t: None if t is None else html.unescape(t))


@F.pandas_udf(DoubleType())
def seq_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Share of matching characters of two strings, as ``difflib`` computes it."""
    return pd.Series([None if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


Seeds = tuple[dict[str, list[int]], dict[str, list[int]], dict[str, int]]


def _seeds(b: str) -> Seeds:
    """Where the characters of ``b`` stand that can begin a match, and pairs of them; if all can, these places as bits.

    Of 200 characters or more ``difflib`` lets none begin that make up over a hundredth.
    """
    at: dict[str, list[int]] = {}
    for j, c in enumerate(b):
        at.setdefault(c, []).append(j)
    bits = {c: sum(1 << j for j in places) for c, places in at.items()} if len(b) < 200 else {}
    if len(b) >= 200:
        at = {c: places for c, places in at.items() if len(places) <= len(b) // 100 + 1}
    twos: dict[str, list[int]] = {}
    for j in range(len(b) - 1):
        if b[j] in at and b[j + 1] in at:
            twos.setdefault(b[j : j + 2], []).append(j)
    return at, twos, bits


def _common(a: str, size: int, bits: dict[str, int]) -> int:
    """Length of the longest common subsequence of ``a`` and a string of ``size`` characters, all its columns in one number."""
    full = left = (1 << size) - 1
    for c in a:
        both = left & bits.get(c, 0)
        left = (left + both | left - both) & full
    return size - left.bit_count()


def _ratio_from(a: str, b: str, least: float, seeds: Seeds | None = None) -> float | None:
    """``SequenceMatcher(None, a, b).ratio()`` if it is ``least`` or more; ``seeds`` are those of ``b``.

    The same matches in the same order. Runs of two or more characters that can begin a match are listed once and cut to each part;
    a part without such a run is gone through once, as there the first character with a place is the longest match, and what lies
    before it holds none. Stops when what is left can't reach ``least``; short strings begin with their longest common subsequence.
    """
    la, lb, total = len(a), len(b), len(a) + len(b)
    if not total:
        return 1.0
    need = least * total / 2 - 1e-6
    if min(la, lb) < need:
        return None
    at, twos, bits = seeds or _seeds(b)
    if bits and least > 0 and _common(a, lb, bits) < need:
        return None
    starts = [i for i, c in enumerate(a) if c in at]
    runs = []
    for i in starts:
        for j in twos.get(a[i : i + 2], ()):
            if not (i and j and a[i - 1] == b[j - 1] and a[i - 1] in at):
                n = 2
                while i + n < la and j + n < lb and a[i + n] == b[j + n] and a[i + n] in at:
                    n += 1
                runs.append((n, i, j))
    runs.sort(key=lambda r: -r[0])
    matched, possible, queue = 0, min(la, lb), [(0, la, 0, lb, runs)]

    def begin(ahi: int, bhi: int) -> int:
        n = 0
        while n < ahi and n < bhi and a[n] == b[n]:
            n += 1
        return n

    while queue:
        alo, ahi, blo, bhi, runs = queue.pop()
        possible -= min(ahi - alo, bhi - blo)
        size, x, y = 1, 0, 0
        for n, i, j in runs:
            if n < size:
                break
            shift, s = j - i, max(i, alo, blo + i - j)
            k = min(i + n, ahi, bhi - shift) - s
            if k > size or k == size > 1 and (s, s + shift) < (x, y):
                size, x, y = k, s, s + shift
        if size > 1:
            u, v = x + size, y + size
            # a match grows over common characters too
            while x > alo and y > blo and a[x - 1] == b[y - 1]:
                x, y = x - 1, y - 1
            while u < ahi and v < bhi and a[u] == b[v]:
                u, v = u + 1, v + 1
            matched += u - x
            if x > alo and y > blo:
                possible += min(x - alo, y - blo)
                queue.append((alo, x, blo, y, [r for r in runs if r[1] < x and r[2] < y]))
            if u < ahi and v < bhi:
                possible += min(ahi - u, bhi - v)
                queue.append((u, ahi, v, bhi, [r for r in runs if r[0] + r[1] > u and r[0] + r[2] > v]))
        else:
            # before the first match of all, and where none begins, the strings may still begin alike
            p, q, whole = alo, blo, alo == blo == 0
            for k in range(bisect_left(starts, alo), len(starts)):
                i = starts[k]
                if i >= ahi or q >= bhi:
                    break
                places = at[a[i]]
                m = bisect_left(places, q)
                if i < p or m == len(places) or places[m] >= bhi:
                    continue
                x, y, u, v = i, places[m], i + 1, places[m] + 1
                while x > p and y > q and a[x - 1] == b[y - 1]:
                    x, y = x - 1, y - 1
                while u < ahi and v < bhi and a[u] == b[v]:
                    u, v = u + 1, v + 1
                matched += u - x + (begin(x, y) if whole else 0)
                p, q, whole = u, v, False
            if whole:
                matched += begin(ahi, bhi)
        if matched + possible < need:
            return None
    r = 2.0 * matched / total
    return r if r >= least else None


#: Bins over which characters, sequences of three and sequences of LONG characters are counted, and LONG. Fixed values.
CHAR_BINS, GRAM_BINS, LONG_BINS, LONG = 64, 251, 8191, 9


def _binned(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins of a string's characters, and of its sequences of three and of LONG characters."""
    v = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)

    def grams(n: int) -> np.ndarray:
        h = np.zeros(max(0, len(v) - n + 1), np.uint64)
        for k in range(n if len(h) else 0):
            h = h * np.uint64(31) + v[k : k + len(h)]
        return h

    return (v % CHAR_BINS).astype(np.intp), (grams(3) % GRAM_BINS).astype(np.intp), (grams(LONG) % LONG_BINS).astype(np.intp)


class Likened:
    """Strings that others are compared with, as ``difflib`` does it; upper bounds spare most of the slow comparisons."""

    def __init__(self, texts: list[str]):
        self.texts, self.seeds = texts, [None] * len(texts)  # seeds are made at need
        self.sizes = np.array([len(t) for t in texts])
        n = len(texts)
        self.chars, self.begins = np.zeros((CHAR_BINS, n), np.int32), np.zeros((CHAR_BINS, n), np.int32)
        self.grams, self.long = np.zeros((GRAM_BINS, n), np.int32), np.zeros((LONG_BINS, n), np.bool_)
        for k, t in enumerate(texts if n > 2 else ()):
            chars, grams, long = _binned(t)
            self.chars[:, k] = np.bincount(chars, minlength=CHAR_BINS)
            self.grams[:, k] = np.bincount(grams, minlength=GRAM_BINS)
            self.long[long, k] = True
            if len(t) >= 200:
                for c, m in Counter(t).items():
                    self.begins[ord(c) % CHAR_BINS, k] += m if m <= len(t) // 100 + 1 else 0

    def bounds(self, a: str, least: float) -> np.ndarray:
        """Upper bounds of the ratio of ``a`` to each string; one below ``least`` may be any below it.

        No more is matched than characters are shared. With m matched, at most 1 + total - 2 m pieces match, each with two sequences
        of three fewer than characters: 5 m - 2 total - 2 are shared at least. Of 200 characters or more, each piece but one holds a
        character that can begin a match, and all its sequences of LONG characters are the string's.
        """
        total = self.sizes + len(a)
        most = np.minimum(self.sizes, len(a)).astype(np.float64)
        if len(self.texts) > 2 and (2 * most >= least * total - 1e-6).any():
            chars, grams, long = _binned(a)
            count = np.bincount(chars, minlength=CHAR_BINS)[:, None]
            most = np.minimum(most, np.minimum(self.chars, count).sum(0))
            junk = self.sizes >= 200
            if junk.any():
                pieces = np.minimum(self.begins, count).sum(0) + 1
                most = np.where(junk, np.minimum(most, (LONG - 1) * pieces + self.long[long].sum(0)), most)
            if (2 * most >= least * total - 1e-6).any():
                shared = np.minimum(self.grams, np.bincount(grams, minlength=GRAM_BINS)[:, None]).sum(0)
                most = np.minimum(most, (shared + 2 * total + 2) / 5)
        return np.where(total > 0, 2 * most / np.maximum(total, 1), 1.0)

    def best(self, a: str, least: float, only_first: bool = False) -> tuple[int, float] | None:
        """Place and ratio of the string most like ``a``, the first of these, if it is ``least`` or more.

        Strings are compared by descending bound, until none can reach the best ratio; with ``only_first`` just the first one.
        """
        bound, found = self.bounds(a, least), None
        may = np.flatnonzero(bound >= least - 1e-9)
        for k in may[np.argsort(-bound[may], kind="stable")].tolist():
            if bound[k] < least - 1e-9:
                break
            self.seeds[k] = self.seeds[k] or _seeds(self.texts[k])
            r = _ratio_from(a, self.texts[k], least, self.seeds[k])
            if r is not None and (found is None or r > least or k < found[0]):
                found, least = (k, r), r
            if only_first:
                break
        return found


def squeeze(text: Column) -> Column:
    """White space runs to one blank, none at the ends."""
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def strip_tags(markup: Column) -> Column:
    """Markup without tags, white space squeezed."""
    return squeeze(F.regexp_replace(markup, r"<[^>]*>", " "))


def first_nonempty(*columns: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in columns))


def slug(text: Column, length: int = 80, default: str = "overig") -> Column:
    """Folded text with hyphens for all else than letters and digits."""
    plain = F.regexp_replace(F.regexp_replace(fold(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")
    return first_nonempty(F.regexp_replace(F.substring(plain, 1, length), "-+$", ""), F.lit(default))


def norm_title(text: Column) -> Column:
    """A title for comparison: folded, without a leading document kind, signs as blanks."""
    plain = F.regexp_replace(fold(text), r"^\s*uittreksel\s*-\s*", "")
    return F.trim(F.regexp_replace(plain, "[^a-z0-9]+", " "))


def title_key(text: Column) -> Column:
    """Letters and digits of a title only."""
    return F.regexp_replace(fold(text), "[^a-z0-9]+", "")


def capitalised(text: Column) -> Column:
    """First letter in upper case, the rest as it is."""
    return F.concat(F.upper(F.substring(text, 1, 1)), F.substr(text, F.lit(2)))


def stem(word: Column) -> Column:
    """Plural endings off: ``en`` from words that keep four letters, else ``s`` from those that keep four."""
    return F.when(word.endswith("en") & (F.length(word) >= 6), F.substring(word, F.lit(1), F.length(word) - 2)).when(word.endswith("s") & (F.length(word) >= 5), F.substring(word, F.lit(1), F.length(word) - 1)).otherwise(word)


def index_tokens(text: Column, stop: Column, min_length: int = 3) -> Column:
    """Distinct folded words of letters and digits that can be search terms: long enough, no stop word, no number."""
    # a run of letters and digits is found whole: it fails at its start only if it is too short or a number, and so do its ends
    found = F.regexp_extract_all(fold(F.coalesce(text, F.lit(""))), F.lit(f"((?=[0-9]*+[a-z])[a-z0-9]{{{min_length},}}+)"), F.lit(1))
    return F.array_except(found, stop)


def title_words(text: Column) -> Column:
    """Distinct folded words of five letters or hyphens or more."""
    return F.array_distinct(F.regexp_extract_all(fold(F.coalesce(text, F.lit(""))), F.lit("([a-z][a-z-]{4,})"), F.lit(1)))


def link_words(text: Column, stop: Column) -> Column:
    """Distinct words of a normalised title that count for linking: five characters or more and no stop word."""
    return F.filter(F.array_distinct(F.split(text, " ")), lambda w: (F.length(w) >= 5) & ~F.array_contains(stop, w))


def prefix_overlap(a: Column, b: Column) -> Column:
    """How many words of ``a`` equal, begin or continue a word of ``b``. Not symmetric."""
    return F.size(F.filter(a, lambda x: F.exists(b, lambda y: y.startswith(x) | x.startswith(y))))


def content_key(*parts: Column, length: int = 40) -> Column:
    """Hexadecimal digest of parts joined by bars, for caches and work lists."""
    return F.substring(F.sha1(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)).cast("binary")), 1, length)
