"""Items of a session from decision lists, minutes and agendas."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from civicframe.functions.text import capitalised, first_nonempty
from civicframe.operators.catalogue import looked_up
from civicframe.operators.merge import first_wins, last_wins, suffix_duplicates

#: Result lines and the slugs that stand for them. Fixed values.
RESULTS = {
    "Goedgekeurd": "goedgekeurd",
    "Bekrachtigd": "bekrachtigd",
    "Vastgesteld": "vastgesteld",
    "Niet ter stemming gelegd": "niet-gestemd",
    "Verdaagd": "verdaagd",
    "Verworpen": "verworpen",
}


#: Domains of executive decisions and their theme. Fixed values.
DOMAIN_THEMES = {
    "Bestuurlijk Beheer": "Bestuur",
    "Burgerzaken": "Bestuur",
    "Strategie & ICT": "Bestuur",
    "Interne Dienst Preventie en Bescherming": "Bestuur",
    "Overheidsopdrachten": "Bestuur",
    "Zaalbeheer & Protocol": "Bestuur",
    "Boekhouding": "Financiën",
    "Belastingen en Inningen": "Financiën",
    "Staf Financiën": "Financiën",
    "Toezicht Financiën": "Financiën",
    "Bouwdienst": "Stedenbouw",
    "Vastgoedmanagement": "Stedenbouw",
    "Integraal Stedelijk Beleid": "Stedenbouw",
    "Project Management Bureau": "Openbare werken",
    "Infrastructuurprojecten Openbaar Domein": "Openbare werken",
    "Sociaal Beleid": "Sociale zaken",
    "Sociale zaken": "Sociale zaken",
    "Jeugd": "Jeugd",
    "Sport": "Sport",
    "Kunstonderwijs": "Onderwijs",
    "Mechelen Feest": "Cultuur",
    "Milieu en Landbouw": "Milieu",
    "GAS Rivierenland": "Veiligheid",
}


def domain_theme(domain: Column) -> Column:
    """The theme of an executive decision's domain: itself if the map lacks it, ``Overig`` without one."""
    tidy = F.trim(domain)
    return F.when(F.coalesce(domain, F.lit("")) == "", "Overig").otherwise(looked_up(tidy, DOMAIN_THEMES, tidy))


def roster(members: DataFrame, aliases: DataFrame, parties: DataFrame) -> DataFrame:
    """Rows (name, party) of members (first, last, party): party names as ``parties`` (party, shown) says; ``aliases`` (name, party) override."""
    named = members.select(F.concat_ws(" ", "first", "last").alias("name"), "party").join(parties, "party", "left").select("name", F.coalesce("shown", "party").alias("party"))
    return named.join(aliases.select("name"), "name", "left_anti").unionByName(aliases.select("name", "party")).distinct()


def result_slug(result: Column) -> Column:
    """The slug of a result line; of one that isn't known, the line in small letters."""
    return looked_up(result, RESULTS, F.lower(result))


def decided_items(decisions: DataFrame, minutes: DataFrame, themes: DataFrame) -> DataFrame:
    """Decisions with their minutes by number and the themes of their category (table category, themes).

    All three have ``session_id``, but for ``themes``; columns are those of the parsers.
    """
    m = last_wins(minutes, ["session_id", "number"], "block").select("session_id", "number", F.col("text").alias("source_text"), "promises", "vote")
    d = decisions.join(m, ["session_id", "number"], "left").join(themes, "category", "left")
    result = F.when(F.col("result") != "", F.struct(result_slug(F.col("result")).alias("decision"), F.col("result").alias("text")))
    return d.select(
        F.concat_ws("-", "session_id", "number").alias("id"), "session_id", "number", F.lit("beslist").alias("status"), result.alias("result"), "type", "added",
        capitalised(F.col("title")).alias("title"), F.coalesce("themes", F.array().cast("array<string>")).alias("themes"), "submitter", F.coalesce("source_text", F.lit("")).alias("source_text"), "promises", "vote",
        F.when(F.col("section") == "besloten", "besloten").alias("section"),
    )


def oral_questions(minutes: DataFrame, agenda: DataFrame) -> DataFrame:
    """Questions by number: title and submitter from the minutes if they have it, else from the first agenda; status by answer."""
    asked = first_wins(agenda.where("type = 'vraag'"), ["session_id", "number"], F.col("ord")).select("session_id", "number", F.col("title").alias("agenda_title"), F.col("submitter").alias("agenda_submitter"))
    told = minutes.where("type = 'vraag'").select("session_id", "number", F.col("title").alias("minutes_title"), F.col("text").alias("source_text"))
    both = asked.join(told, ["session_id", "number"], "full")
    cut = F.regexp_replace("source_text", r"(?s)(Antwoord.*?)\n\d+\. [A-Z]{3}.*$", "$1")
    return both.select(
        F.concat_ws("-", "session_id", "number").alias("id"), "session_id", "number", F.lit("vraag").alias("type"),
        capitalised(first_nonempty(F.col("minutes_title"), F.col("agenda_title"), F.lit(""))).alias("title"), F.col("agenda_submitter").alias("submitter"),
        F.coalesce(cut, F.lit("")).alias("source_text"), F.when(F.col("source_text").isNull(), "op-agenda").when(F.contains("source_text", F.lit("Antwoord")), "beslist").otherwise("agenda").alias("status"),
    )


def debate_number(number: Column) -> Column:
    """``ACT``, ``ACT1`` and ``ACT01`` are one debate; other numbers stay."""
    bare = F.regexp_extract(number, r"^ACT0*(\d*)$", 1)
    return F.when(number.rlike(r"^ACT0*\d*$"), F.concat(F.lit("ACT"), F.when(bare == "", "1").otherwise(bare))).otherwise(number)


def debates(minutes: DataFrame, agenda: DataFrame, decisions: DataFrame) -> DataFrame:
    """Debates of the day that the decision list lacks: title of the first agenda, else of the minutes; text and status by the minutes.

    Nothing is voted on. Without minutes a debate is an item of the agenda, and its source text is the agenda's line.
    """
    with_key = lambda df: df.withColumn("key", debate_number(F.col("number")))
    planned = first_wins(with_key(agenda.where("type = 'actuadebat'")), ["session_id", "key"], F.col("ord")).select("session_id", "key", F.col("number").alias("_planned"), F.col("title").alias("_title"))
    told = last_wins(with_key(minutes.where("type = 'actualiteitsdebat'")), ["session_id", "key"], "block").select("session_id", "key", F.col("number").alias("_told"), F.col("title").alias("_heard"), "text", "vote")
    both = planned.join(told, ["session_id", "key"], "full").join(with_key(decisions).select("session_id", "key").distinct(), ["session_id", "key"], "left_anti")
    number, title = F.coalesce("_planned", "_told"), F.trim(F.coalesce("_title", "_heard", F.lit("")))
    held = F.col("_told").isNotNull()
    result = F.when(held, F.struct(F.lit("bespreking ter zitting").alias("decision"), F.lit("Bespreking ter zitting").alias("text")))
    return both.select(
        F.concat_ws("-", "session_id", number).alias("id"), "session_id", number.alias("number"), F.when(held, "beslist").otherwise("agenda").alias("status"), result.alias("result"),
        F.lit("actuadebat").alias("type"), title.alias("title"), F.when(held, F.coalesce("text", F.lit(""))).otherwise(F.concat(number, F.lit(". ACTUALITEITSDEBAT. "), title)).alias("source_text"), "vote",
    )


def missing_questions(agenda: DataFrame, published: DataFrame) -> DataFrame:
    """Questions of the agenda that no published item has."""
    return agenda.where("type = 'vraag'").join(published, ["session_id", "number"], "left_anti")


def upcoming_items(agenda: DataFrame) -> DataFrame:
    """Items of coming sessions: of several agendas the last one counts."""
    return last_wins(agenda, ["session_id", "number"], "ord").select(F.concat_ws("-", "session_id", "number").alias("id"), "session_id", "number", F.lit("op-agenda").alias("status"), "type", "title", "submitter", "category")


def executive_items(decisions: DataFrame) -> DataFrame:
    """Decisions of executive organs (orgaan, date, doc, pos and the parser's columns); struck ones go, equal ids get a suffix."""
    kept = decisions.where("title <> '' and not upper(title) like 'GESCHRAPT%'").withColumn("id", F.concat_ws("-", "orgaan", F.date_format("date", "yyyyMMdd"), "number"))
    return suffix_duplicates(kept, [], "id", F.col("title"), F.col("doc"), F.col("pos")).select("id", "orgaan", "date", "number", "category", "title", F.when(F.col("section") == "besloten", "besloten").alias("section"))


def unified(council: DataFrame, executive: DataFrame, questions: DataFrame) -> DataFrame:
    """One view of all items with an ``item_date``; on an id clash the later collection wins."""
    parts = [council.withColumn("collection", F.lit(0)), executive.withColumn("collection", F.lit(1)), questions.withColumn("collection", F.lit(2))]
    both = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return last_wins(both, ["id"], "collection")
