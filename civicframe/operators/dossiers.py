"""Dossiers: judged groups as cores, own rules for the rest, questions placed by their verdicts, and manual corrections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicframe.store import stored

#: Titles of which a word may be a signature: more make it common.
MOST_TITLES = 40


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of ``links`` (a, b): rows (node, component).

    Each round tells every node's neighbours the least label it knows (a join and a minimum, pre-aggregated) and then
    follows labels to the labels of their nodes, which halves the way to the smallest node; it ends when no label
    changes. Every round's labels are a stored table. Links to oneself and repeated links do no harm.
    """
    edges = stored(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), "edges")
    labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        told = edges.join(labels, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("label").alias("told"))
        nearer = labels.join(told, "node").select("node", F.col("label").alias("old"), F.least("label", "told").alias("label"))
        of_label = labels.select(F.col("node").alias("_n"), F.col("label").alias("_l"))
        jumped = nearer.join(of_label, F.col("label") == F.col("_n"), "left").select("node", "old", F.least("label", F.coalesce("_l", "label")).alias("label"))
        jumped = stored(jumped, "labels")
        moved = jumped.where("label <> old").limit(1).count()
        labels = jumped.select("node", "label")
        if not moved:
            return labels.select("node", F.col("label").alias("component"))


def dossiers(items: DataFrame, links: DataFrame) -> DataFrame:
    """Dossier of each item (id): its component, or itself if it is linked with nothing."""
    return items.select("id").join(components(links).withColumnRenamed("node", "id"), "id", "left").select("id", F.coalesce("component", "id").alias("dossier"))


def corrected(links: DataFrame, cut: DataFrame, merge: DataFrame) -> DataFrame:
    """Links without those of items that are set loose (``cut``: id) and with those made by hand (``merge``: a, b)."""
    for c in ("a", "b"):
        links = links.join(cut.select(F.col("id").alias(c)), c, "left_anti")
    return links.select("a", "b").unionByName(merge.select("a", "b")).distinct()


def moved(groups: DataFrame, moves: DataFrame, alias: DataFrame) -> DataFrame:
    """Dossiers (id, dossier) after items are moved (``moves``: id, to) and names replaced (``alias``: dossier, name)."""
    placed = groups.join(moves, "id", "left").select("id", F.coalesce("to", "dossier").alias("dossier"))
    return placed.join(alias, "dossier", "left").select("id", F.coalesce("name", "dossier").alias("dossier"))


def signatures(tokens: DataFrame, *, most: int = MOST_TITLES) -> DataFrame:
    """The rarest title word of each item (rows id, token, each once) that two to ``most`` titles have: id, token; ties go by the word."""
    rare = tokens.groupBy("token").agg(F.count("*").alias("df")).where(F.col("df").between(2, most))
    return tokens.join(rare, "token").groupBy("id").agg(F.min(F.struct("df", "token")).alias("best")).select("id", "best.token")


def signature_links(tokens: DataFrame, general: DataFrame, terms: DataFrame, streets: DataFrame, referrals: DataFrame, *, most: int = MOST_TITLES) -> DataFrame:
    """Links (a, b, token, reason) of items with one signature word.

    A word that names a subject links by itself (``woord``). A general word (``general``: token) must be confirmed by, in this
    order: a shared title word that is no general one, however common (``onderwerp``); a shared key term (``terms``: id,
    term; ``kernbegrip``); the same single street of both (``streets``: id, street; ``straat``); or a referral
    (``referrals``: a, b, in any order; ``verwijzing``). A signature is in ``most`` titles at most, so pairs are bounded for each word, and evidence
    is looked up for these pairs only: common words and terms are never paired with one another.
    """
    mine = stored(signatures(tokens, most=most), "signatures")
    other = mine.withColumnRenamed("id", "b")
    pairs = mine.withColumnRenamed("id", "a").join(other, "token").where("a < b")
    marked = stored(pairs.join(general.select("token").distinct().withColumn("vague", F.lit(True)), "token", "left"), "signature-pairs")
    open_ = marked.where("vague")

    def shared(rows: DataFrame, what: str) -> DataFrame:
        """The open pairs of which both have the same ``what``."""
        side = lambda k: rows.select(F.col("id").alias(k), F.col(what).alias("_shared")).distinct()
        return open_.select("a", "b").join(side("a"), "a").join(side("b"), ["b", "_shared"]).select("a", "b").distinct()

    one_street = streets.groupBy("id").agg(F.count_distinct("street").alias("n"), F.min("street").alias("street")).where("n = 1")
    both_ways = referrals.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    evidence = [
        (1, "onderwerp", shared(tokens.join(general.select("token"), "token", "left_anti"), "token")),
        (2, "kernbegrip", shared(terms, "term")),
        (3, "straat", shared(one_street, "street")),
        (4, "verwijzing", open_.select("a", "b").join(both_ways, ["a", "b"], "left_semi")),
    ]
    found = reduce(DataFrame.unionByName, (df.select("a", "b", F.struct(F.lit(n).alias("n"), F.lit(why).alias("why")).alias("r")) for n, why, df in evidence))
    confirmed = found.groupBy("a", "b").agg(F.min("r").alias("r"))
    plain = marked.where("vague is null").select("a", "b", "token", F.lit("woord").alias("reason"))
    return plain.unionByName(open_.join(confirmed, ["a", "b"]).select("a", "b", "token", F.col("r.why").alias("reason")))


def around_cores(items: DataFrame, core: DataFrame, series: DataFrame, alone: DataFrame, links: DataFrame) -> DataFrame:
    """Rows (id, dossier, kind): judged dossiers as cores, and the library's own ``links`` (a, b) for the rest.

    ``core`` (id, dossier) and ``series`` (id, series) are as judged, and ``alone`` (id) was judged to belong nowhere; links
    of their items never bring together what was judged apart. An item without a verdict joins one dossier at most: that of the fewest
    links away; of several as near, that with most links from there, then the one of least name. What reaches no core forms
    components of its own. ``kind``: kern, reeks (labelled as recurring), alleen, eigen, los. An item with several verdicts keeps the
    first of core, series, alone, and the least name.

    Each round moves the front by one link and is a stored table; there are as many rounds as the longest way to a core.
    """
    judged = core.select("id", F.struct(F.lit(1).alias("n"), F.col("dossier").alias("name"), F.lit("kern").alias("kind")).alias("v"))
    judged = judged.unionByName(series.select("id", F.struct(F.lit(2).alias("n"), F.col("series").alias("name"), F.lit("reeks").alias("kind")).alias("v")))
    judged = judged.unionByName(alone.select("id", F.struct(F.lit(3).alias("n"), F.col("id").alias("name"), F.lit("alleen").alias("kind")).alias("v")))
    known = items.select("id").distinct()
    judged = stored(judged.join(known, "id", "left_semi").groupBy("id").agg(F.min("v").alias("v")).select("id", F.col("v.name").alias("dossier"), "v.kind"), "judged")
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct()
    free = known.join(judged, "id", "left_anti")
    # links that lead to an item without a verdict, from such items or from cores
    edges = both.join(free.withColumnRenamed("id", "b"), "b", "left_semi").join(judged.where("kind <> 'kern'").select(F.col("id").alias("a")), "a", "left_anti")
    edges = stored(edges.join(known.withColumnRenamed("id", "a"), "a", "left_semi"), "own-links")
    placed = judged
    front = judged.where("kind = 'kern'").select("id", "dossier")
    while True:
        told = edges.join(front.withColumnRenamed("id", "a"), "a").groupBy("b", "dossier").agg(F.count("*").alias("n"))
        best = told.groupBy(F.col("b").alias("id")).agg(F.min(F.struct((-F.col("n")).alias("n"), "dossier")).alias("best"))
        front = stored(best.join(placed.select("id"), "id", "left_anti").select("id", "best.dossier"), "front")
        if not front.limit(1).count():
            break
        placed = stored(placed.unionByName(front.withColumn("kind", F.lit("eigen"))), "placed")
    rest = free.join(placed, "id", "left_anti")
    among = edges.join(rest.withColumnRenamed("id", "a"), "a", "left_semi").join(rest.withColumnRenamed("id", "b"), "b", "left_semi")
    return placed.unionByName(dossiers(rest, among).withColumn("kind", F.lit("los")))


def without_conflicts(yes: DataFrame, no: DataFrame) -> DataFrame:
    """Groups (question, group) of questions that say yes to one another (``yes``: a, b), without any ``no`` (a, b) inside a group.

    As long as a group holds a no, the question with most of them leaves its group (of several, the least id) and forms
    a group of its own; the rest is grouped again by what yes links are left. A group is named by its least question.
    """
    yes, no = (stored(df.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct(), "verdicts") for df in (yes, no))
    asked = yes.select(F.col("a").alias("id")).union(yes.select("b")).distinct()
    gone: list[DataFrame] = []
    while True:
        groups = components(yes).select(F.col("node").alias("id"), "component")
        left, right = (groups.select(F.col("id").alias(k), F.col("component").alias(f"_{k}")) for k in ("a", "b"))
        inside = no.join(left, "a").join(right, "b").where("_a = _b")
        counted = inside.select(F.col("a").alias("id"), F.col("_a").alias("group")).union(inside.select("b", "_b")).groupBy("group", "id").agg(F.count("*").alias("n"))
        worst = stored(counted.groupBy("group").agg(F.min(F.struct((-F.col("n")).alias("n"), "id")).alias("w")).select("w.id"), "conflicts")
        if not worst.limit(1).count():
            break
        gone.append(worst)
        for k in ("a", "b"):
            yes = yes.join(worst.withColumnRenamed("id", k), k, "left_anti")
        yes = stored(yes, "verdicts")
    grouped = groups.select("id", "component").unionByName(asked.join(groups, "id", "left_anti").select("id", F.col("id").alias("component")))
    return grouped.select(F.col("id").alias("question"), F.col("component").alias("group"))


def placed_questions(questions: DataFrame, yes: DataFrame, no: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows (id, dossier) of judged ``questions`` (id) and of the lone items that follow them, by verdicts ``yes`` and ``no`` (a, b).

    Questions that say yes to one another choose together (:func:`without_conflicts`): the dossier of ``groups`` (id, dossier)
    with most yes pairs, of equals the least; they stay out if they have as many other verdicts or more there. Questions without a
    dossier form one, named by the least of them. An item in no dossier follows the questions it has a yes pair
    with: the dossier with most of these, of equals the least.
    """
    ask = stored(questions.select("id").distinct(), "questions")
    of = lambda df, k: df.join(ask.withColumnRenamed("id", k), k, "left_semi")
    not_of = lambda df, k: df.join(ask.withColumnRenamed("id", k), k, "left_anti")
    among = without_conflicts(of(of(yes, "a"), "b"), of(of(no, "a"), "b")).withColumnRenamed("question", "id")
    chosen = stored(ask.join(among, "id", "left").select("id", F.coalesce("group", "id").alias("group")), "question-groups")

    def with_items(df: DataFrame) -> DataFrame:
        """Distinct pairs (question, item) of a question and an item that is none."""
        ways = not_of(of(df, "a"), "b").select(F.col("a").alias("question"), F.col("b").alias("item"))
        return ways.unionByName(not_of(of(df, "b"), "a").select(F.col("b").alias("question"), F.col("a").alias("item"))).distinct()

    votes_yes, votes_no = (with_items(df) for df in (yes, no))
    member = groups.select(F.col("id").alias("item"), "dossier")

    def counted(votes: DataFrame, name: str) -> DataFrame:
        return votes.join(chosen.withColumnRenamed("id", "question"), "question").join(member, "item").groupBy("group", "dossier").agg(F.count("*").alias(name))

    both = counted(votes_yes, "n_yes").join(counted(votes_no, "n_no"), ["group", "dossier"], "left").fillna({"n_no": 0})
    most = both.groupBy("group").agg(F.min(F.struct((-F.col("n_yes")).alias("n"), "dossier", "n_no")).alias("best"))
    won = most.where(-F.col("best.n") > F.col("best.n_no")).select("group", F.col("best.dossier").alias("won"))
    placed = stored(chosen.join(won, "group", "left").select("id", F.coalesce("won", "group").alias("dossier")), "placed-questions")
    lone = votes_yes.join(member.select("item"), "item", "left_anti").join(placed.withColumnRenamed("id", "question"), "question")
    follow = lone.groupBy("item", "dossier").agg(F.count("*").alias("n")).groupBy("item").agg(F.min(F.struct((-F.col("n")).alias("n"), "dossier")).alias("best"))
    return placed.unionByName(follow.select(F.col("item").alias("id"), "best.dossier"))
