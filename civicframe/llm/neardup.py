"""Near-duplicates by bottom-k sketches from one hash function.

A text's set is its distinct word shingles. Texts of equal sets are one class, told apart by 128 bits of hash, and go on
as their document of least id. Of a class the ``K`` least shingle hashes are retained: a bottom-k sketch. Inverted
lists of the retained values give the candidates; the union of two sketches, cut to its k least values, estimates
their likeness and drops what is far off; full sets, made again from the texts, decide exactly.

Which retained values are listed. Two sets with likeness t or more differ in few of their values, so of a sketch put
in the order of rising document frequency at least one of the first values is shared (a prefix filter): for a sketch that
is the whole set, the first n - ceil(t * n) + 1 values suffice for certain; for a cut sketch the share of values that are
missing in the other set is binomial with 1 - t at most, and a margin of ``SIGMAS`` standard deviations is added. Values
of one class are dropped as nobody shares them, so the lists of ordinary text are short.

Lists of up to ``LIST`` classes give all their pairs. Longer lists, which only groups of near copies and texts made of
very common shingles have, are worked off by hubs: the class of the list with the fewest values of its own, which stands
nearest the middle of a group, is compared with all others, so a group of near copies costs a pair a member; ``ROUNDS``
more hubs follow among those not yet in one component. The classes that are still apart then get lists of their full
sets. A shingle that none of these classes shares can't be in an intersection, so a class with more such shingles than
the threshold allows drops out, and so does a pair whose rest is too small; in each list, what is outside the largest
component is compared with the others by bitmaps of parities: each shingle flips one of ``64 * MARKS`` bits, so the bits
in which two classes differ are no more than the shingles in which they do, and a pair with more differences than the
threshold allows drops out. No link between components is left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicframe.llm.common import let, small, stored, words
from civicframe.operators.dossiers import components

K = 64
#: Retained values of an exact run: more than any set has.
WHOLE = 1 << 30
SIGMAS = 5.0
LIST = 16
ROUNDS = 1
#: Words of 64 bits of the bitmap of a set.
MARKS = 16
#: A pair goes to the exact test unless its sketches estimate a likeness under the threshold by more than this many
#: standard errors.
FILTER_SIGMAS = 5.0


def shingle_set(text: Column, n: int) -> Column:
    """Sorted distinct 64-bit hashes of the runs of ``n`` words; of fewer words, the whole sequence is one; of none, nothing."""
    return let(
        words(text),
        lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
            F.sort_array(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.size(w) - (n - 1), F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, F.lit(n))))))
        ),
    )


def sketches(docs: DataFrame, *, id_col: str, text_col: str, n: int, k: int) -> DataFrame:
    """Per row: id, size of the set, two hashes of the whole set, and its k least values."""
    full = docs.select(F.col(id_col).alias("id"), shingle_set(F.col(text_col), n).alias("s"))
    return full.select("id", F.size("s").cast("long").alias("n"), F.xxhash64("s").alias("c1"), F.xxhash64(F.lit(n), F.reverse("s")).alias("c2"), F.slice("s", 1, k).alias("sketch"))


def _prefix(n: Column, k: int, t: float) -> Column:
    """How many values of a sketch must be looked up, of a set of ``n``."""
    exact = n - F.ceil(n * F.lit(t) - F.lit(1e-9)) + 1  # where the sketch of any partner is whole too
    cut = math.ceil(k * (1 - t) + SIGMAS * math.sqrt(k * t * (1 - t))) + 1
    return F.when(n <= t * k, exact).otherwise(F.lit(min(k, cut)))


def listed(classes: DataFrame, *, k: int, t: float) -> DataFrame:
    """Entries (v, id, n, own) of the inverted lists of two classes or more, with the list's length ``df``.

    ``own`` is the number of the class's retained values that no other class has.
    """
    values = classes.select("id", "n", F.size("sketch").alias("k"), F.explode("sketch").alias("v"))
    shared = values.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    held = stored(values.join(shared, "v"), "shared-values")
    # values that no other class has come first in the order, so the place of a shared one starts after them
    own = (F.col("k") - F.count("*").over(Window.partitionBy("id"))).cast("int")
    place = F.row_number().over(Window.partitionBy("id").orderBy("df", "v")) + F.col("own")
    entries = held.withColumn("own", own).withColumn("place", place).where(F.col("place") <= _prefix(F.col("n"), k, t)).select("v", "id", "n", "own")
    lengths = entries.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    return stored(entries.join(lengths, "v"), "lists")


def _fit(a: Column, b: Column, t: float) -> Column:
    """Whether sets of two sizes can be as like as t."""
    return F.least(a, b) >= F.greatest(a, b) * F.lit(t) - F.lit(1e-9)


def full_sets(needed: DataFrame, classes: DataFrame, docs: DataFrame, *, id_col: str, text_col: str, n: int) -> DataFrame:
    """The full sets (id, s) of the classes that ``needed`` (id) names, made again from their texts."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(small(needed), "id", "left_semi").withColumn("s", shingle_set(F.col("text"), n))
    full = texts.join(classes.select("id", F.col("c1").alias("_c1"), F.col("c2").alias("_c2")).join(small(needed), "id", "left_semi"), "id")
    # rows that repeat an id may hold other texts
    full = full.where((F.xxhash64("s") == F.col("_c1")) & (F.xxhash64(F.lit(n), F.reverse("s")) == F.col("_c2"))).dropDuplicates(["id", "_c1"])
    return stored(full.select("id", "s"), "full-sets")


def apart(entries: DataFrame, full: DataFrame, *, t: float) -> DataFrame:
    """Pairs (a, b) of different components that may be linked, of the classes in ``entries`` (id, c); ``full`` has their sets."""
    held = full.select("id", F.size("s").alias("n"), F.explode("s").alias("v"))
    word, bit = F.shiftright("v", 6).bitwiseAND(F.lit(MARKS - 1)), F.expr("shiftleft(1L, cast(v & 63 AS int))")
    marks = held.groupBy("id").agg(*(F.bit_xor(F.when(word == i, bit).otherwise(F.lit(0).cast("bigint"))).alias(f"m{i}") for i in range(MARKS)))
    shared = held.groupBy("v").agg(F.count("*").alias("df")).where("df > 1")
    every = Window.partitionBy("id")
    # shingles of one class alone come first in the order
    held = held.join(shared, "v").withColumn("own", F.col("n") - F.count("*").over(every))
    held = held.withColumn("place", F.row_number().over(every.orderBy("df", "v")) + F.col("own"))
    lists = held.where(F.col("place") <= F.col("n") - F.ceil(F.col("n") * F.lit(t) - F.lit(1e-9)) + 1).select("v", "id", "n", "own")
    lists = stored(lists.join(entries.select("id", "c").distinct(), "id").join(marks, "id"), "rest-lists")
    sizes = lists.groupBy("v", "c").agg(F.count("*").alias("m")).groupBy("v").agg(F.max(F.struct("m", "c")).alias("top"), F.count("*").alias("parts")).where("parts > 1")
    outside = lists.join(sizes, "v").where(F.col("c") != F.col("top.c")).select("v", F.col("id").alias("a"), F.col("c").alias("ca"), F.col("n").alias("na"), (F.col("n") - F.col("own")).alias("ra"), *(F.col(f"m{i}").alias(f"ma{i}") for i in range(MARKS)))
    partner = lists.select("v", F.col("id").alias("b"), F.col("c").alias("cb"), F.col("n").alias("nb"), (F.col("n") - F.col("own")).alias("rb"), *(F.col(f"m{i}").alias(f"mb{i}") for i in range(MARKS)))
    # an intersection has t / (1 + t) of both sizes at least
    enough = F.least("ra", "rb") * F.lit(1 + t) >= (F.col("na") + F.col("nb")) * F.lit(t) - F.lit(1e-6)
    # and what only one of the two has, (1 - t) / (1 + t) of both sizes at most
    differ = sum((F.bit_count(F.col(f"ma{i}").bitwiseXOR(F.col(f"mb{i}"))) for i in range(1, MARKS)), F.bit_count(F.col("ma0").bitwiseXOR(F.col("mb0"))))
    alike = differ * F.lit(1 + t) <= (F.col("na") + F.col("nb")) * F.lit(1 - t) + F.lit(1e-6)
    return outside.join(partner, "v").where((F.col("ca") != F.col("cb")) & enough & alike).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def verified(pairs: DataFrame, classes: DataFrame, docs: DataFrame, *, id_col: str, text_col: str, n: int, k: int, percent: int) -> DataFrame:
    """The links among distinct ``pairs`` (a, b): first by the sketches of both, then by their full sets."""
    t = percent / 100
    ids = lambda p: p.select(F.col("a").alias("id")).unionByName(p.select(F.col("b").alias("id"))).distinct()
    own = classes.join(small(stored(ids(pairs), "pair-ids")), "id", "left_semi").select("id", "n", "sketch")
    left, right = own.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("sketch").alias("sa")), own.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("sketch").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    union = F.slice(F.sort_array(F.array_union("sa", "sb")), 1, k)
    rated = both.select("a", "b", "na", "nb", let(union, lambda u: F.struct(F.size(u).alias("u"), F.size(F.array_intersect(F.array_intersect(u, F.col("sa")), F.col("sb"))).alias("i"))).alias("e"))
    error = FILTER_SIGMAS * F.sqrt(F.lit(t * (1 - t)) / F.col("e.u"))
    likely = F.when((F.col("na") <= k) & (F.col("nb") <= k) & (F.col("e.u") < k), F.col("e.i") >= F.lit(t) * F.col("e.u") - F.lit(1e-9)).otherwise(F.col("e.i") / F.col("e.u") >= F.lit(t) - error)
    close = stored(rated.where(likely).select("a", "b"), "close-pairs")
    needed = stored(ids(close), "text-ids")
    full = full_sets(needed, classes, docs, id_col=id_col, text_col=text_col, n=n)
    exact = close.join(full.select(F.col("id").alias("a"), F.col("s").alias("sa")), "a").join(full.select(F.col("id").alias("b"), F.col("s").alias("sb")), "b")
    common = F.size(F.array_intersect("sa", "sb"))
    return exact.select("a", "b", common.alias("i"), (F.size("sa") + F.size("sb") - common).alias("u")).where(100 * F.col("i") >= percent * F.col("u")).select("a", "b")


def near_links(classes: DataFrame, docs: DataFrame, *, id_col: str, text_col: str, n: int, k: int, percent: int) -> DataFrame:
    """Links between classes that make the same components as all links do; rows (a, b) with a < b."""
    t = percent / 100
    entries = listed(classes, k=k, t=t)
    check = lambda pairs: stored(verified(stored(pairs.distinct(), "pairs"), classes, docs, id_col=id_col, text_col=text_col, n=n, k=k, percent=percent), "links")
    other = lambda e: e.select("v", F.col("id").alias("b"), F.col("n").alias("nb"))
    short, long = entries.where(F.col("df") <= LIST), entries.where(F.col("df") > LIST)
    pairs = short.select("v", F.col("id").alias("a"), F.col("n").alias("na")).join(other(short), "v").where(F.col("a") < F.col("b"))
    hubs = long.groupBy("v").agg(F.min(F.struct("own", "id", "n")).alias("hub"))
    spokes = long.join(hubs, "v").where(F.col("id") != F.col("hub.id")).select(F.least("hub.id", "id").alias("a"), F.col("hub.n").alias("na"), F.greatest("hub.id", "id").alias("b"), F.col("n").alias("nb"))
    links = check(pairs.select("a", "na", "b", "nb").unionByName(spokes).where(_fit(F.col("na"), F.col("nb"), t)).select("a", "b"))
    open_lists, done = long, 0
    while True:
        done += 1
        label = small(components(links))
        now = open_lists.join(label, open_lists.id == label.node, "left").select("v", "id", "n", "own", F.coalesce("component", "id").alias("c"))
        per_list = now.groupBy("v").agg(F.min("c").alias("c_min"), F.max("c").alias("c_max")).where("c_min < c_max").select("v")
        now = stored(now.join(per_list, "v", "left_semi"), "open-lists")
        if now.limit(1).count() == 0:
            return links
        if done > ROUNDS:
            full = full_sets(stored(now.select("id").distinct(), "rest-ids"), classes, docs, id_col=id_col, text_col=text_col, n=n)
            return links.unionByName(check(apart(now, full, t=t)))
        # the next hub of a list: of its second and first component in turn, the class with the fewest values of its own
        heads = now.groupBy("v", "c").agg(F.min(F.struct("own", F.xxhash64("id", F.lit(done)).alias("h"), "id", "n")).alias("hub"))
        chosen = heads.withColumn("rank", F.row_number().over(Window.partitionBy("v").orderBy("c"))).where(F.col("rank") == 1 + done % 2).select("v", "hub", F.col("c").alias("hc"))
        spokes = now.join(chosen, "v").where((F.col("c") != F.col("hc")) & _fit(F.col("hub.n"), F.col("n"), t)).select(F.least("hub.id", "id").alias("a"), F.greatest("hub.id", "id").alias("b"))
        links = stored(links.unionByName(check(spokes)), "links")
        open_lists = now.select("v", "id", "n", "own")


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, k: int = K, exact: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id (smallest id reachable by links) and kept.

    Sets of up to ``k * percent / 100`` shingles lose no link; of larger ones a link is lost about once in three million at a
    likeness of exactly ``percent``. With ``exact`` the sketches retain whole sets, so that lists and filters are certain for sets of every size,
    at the cost of moving the sets.

    Two rows are linked if their sets have 100 * intersection >= percent * union. Null, empty and wordless texts have
    an empty set and are linked with nothing. Rows that repeat an id are one document with the links of all its texts;
    rows with a null id have a null component and are kept, as nothing can name them. Other columns are ignored.
    """
    k = WHOLE if exact else k
    rows = stored(sketches(docs, id_col=id_col, text_col=text_col, n=shingle, k=k), "sketches")
    named = rows.where("n > 0 and id is not null")
    classes = named.groupBy("c1", "c2").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    classes = stored(classes, "classes")
    links = near_links(classes, docs, id_col=id_col, text_col=text_col, n=shingle, k=k, percent=percent)
    # ids that repeat with texts of different classes tie these together
    several = named.groupBy("id").agg(F.countDistinct("c1").alias("m")).where("m > 1").select("id")
    ties = named.join(several, "id").join(classes.select("c1", "c2", F.col("id").alias("a")), ["c1", "c2"]).select("a", F.col("id").alias("b"))
    links = links.unionByName(ties)
    member = rows.join(classes.select("c1", "c2", F.col("id").alias("rep")), ["c1", "c2"], "left").withColumn("rep", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("rep")).otherwise(F.col("id")))
    found = components(links)
    labelled = member.join(small(found), F.col("rep") == F.col("node"), "left").select("id", "n", F.coalesce("component", "rep").alias("c"))
    return labelled.select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("c").alias("component_id"), F.coalesce(F.col("id") == F.col("c"), F.lit(True)).alias("kept"))
