"""Decision lists, agendas and minutes: lines of a document become items.

A document's lines stay in its row, as an array with their places; which lines open an item is found by a fold over the
candidates of the document, as a head may depend on the number of the head before it; slices between heads are the items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicframe.functions.dates import MONTHS
from civicframe.functions.text import let
from civicframe.operators.catalogue import continued_title


def line_array(text: Column, noise: str | None = None) -> Column:
    """Trimmed, non-empty lines of a text in their order, without those that match ``noise``: array of (pos, line)."""
    rows = F.transform(F.split(text, r"\R"), lambda x, i: F.struct(i.alias("pos"), F.trim(F.regexp_replace(x, r"^(?U)\s+|\s+$", "")).alias("line")))
    return F.filter(rows, lambda r: (r["line"] != "") if noise is None else (r["line"] != "") & ~r["line"].rlike(noise))


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """``doc`` and the columns, as the row of a generator: what follows reads them and does not compute them again."""
    return df.select("doc", F.inline(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))))


def _lines(docs: DataFrame, noise: str, id_col: str = "doc", text_col: str = "text") -> DataFrame:
    return _once(docs.select(F.col(id_col).alias("doc"), F.col(text_col).alias("text")), rows=line_array(F.col("text"), noise)).where("rows is not null")


def _after_opening(docs: DataFrame) -> DataFrame:
    """The rows from the first public-session line on; all if there is none."""
    opens = F.array_position(F.transform("rows", lambda r: F.lower(r["line"]).startswith("openbare zitting")), True).cast("int")
    return _once(docs, rows=F.slice("rows", F.greatest(opens, F.lit(1)), F.size("rows")))


def follows(previous: Column, number: Column) -> Column:
    """Whether an item number is the successor of another: same number and next letter, or next number without one."""
    digits = lambda c: F.regexp_extract(c, r"^(\d+)[A-Za-z]?$", 1).try_cast("int")
    letter = lambda c: F.upper(F.regexp_extract(c, r"^\d+([A-Za-z]?)$", 1))
    a, b = digits(F.coalesce(previous, F.lit("0"))), digits(number)
    expected = F.when(letter(F.coalesce(previous, F.lit("0"))) == "", F.lit("A")).otherwise(F.char(F.ascii(letter(F.coalesce(previous, F.lit("0")))) + 1))
    return F.coalesce(F.when(letter(number) != "", (a == b) & (letter(number) == expected)).otherwise(b == a + 1), F.lit(False))


#: Heads and lines without meaning of decision lists and agendas. Fixed values.
DECISION_HEAD = r"^(\d+[A-Za-z]?|\d+ [A-Z]|[A-Z]{2,4}\d{1,3})\.\s+(.*)$"
DECISION_HEAD_BARE = r"(?U)^([1-9]\d{0,2}[A-Z]?) ([A-Z](?:[^\W\d_]|[ &()\-]){1,60}\.\s+\S.*)$"
DECISION_HEAD_TYPE = r"^([A-Z]{2,4}\d{0,3})\.\s*((?:ACTUALITEITSDEBAT|TOEGEVOEGD PUNT|POLITIEVERORDENINGEN)\.\s+\S.*)$"
DECISION_NOISE = r"(?U)^(Beslissing(?:en|s)?lijst\s+\d+$|Beslissingslijst toezicht\b|BESLISSING(?:EN|S)?LIJST$|TOEZICHT$|\d{1,2} \w+ \d{4}$)"
DECISION_BREAK = r"^volgende?\s+punt(en)?\s+werd(en)?\b|^(aan\s+)?de agenda toegevoegd\s*:?\s*$"
AGENDA_HEAD = r"^(\d+[A-Za-z]?|TP\d+|V\d+|ACT\d*)\.\s*(.*)$"
AGENDA_NOISE = r"(?U)^(Agenda(?:\s+volledig)?\s+\d+$|AGENDA(?:\s+VOLLEDIG)?$|\d{1,2} \w+ \d{4}$)"
RUBRIC = r"^([^.]+?)\.\s+(.*)$"


def _items(docs: DataFrame) -> DataFrame:
    """One row an item of the marked rows of each document: pos, number, rest, section and ``lines``, the array of its lines from the head on.

    Rows have pos, line, mark (of a section), closes, number, rest, plain, bare and tail. Which lines open an item is found by a
    fold over the candidates of a document: ``plain`` heads open one, unless ``tail`` says that the line may be the tail of a
    title and its number does not follow the last one inside an open item; ``bare`` heads open one if their number follows.
    An item ends where the next one opens or a line closes it. All is done in the document's row: nothing is shuffled or sorted.
    """
    kind = "struct<at:int,head:boolean,section:string>"
    start = F.struct(F.lit(None).cast("string").alias("prev"), F.lit(False).alias("open"), F.lit("openbaar").alias("section"), F.array().cast(f"array<{kind}>").alias("cuts"))

    def step(acc: Column, x: Column) -> Column:
        series = F.coalesce(acc["prev"].rlike(r"^\d+[A-Za-z]?$"), F.lit(False)) & x["number"].rlike(r"^\d+[A-Za-z]?$")
        opens = (x["plain"] & ~(acc["open"] & x["tail"] & series & ~follows(acc["prev"], x["number"]))) | (~x["plain"] & x["bare"] & follows(acc["prev"], x["number"]))
        section = F.coalesce(x["mark"], acc["section"])
        cut = lambda head: F.array_append(acc["cuts"], F.struct(x["at"].alias("at"), F.lit(head).alias("head"), section.alias("section")))
        shut = F.struct(acc["prev"].alias("prev"), F.lit(False).alias("open"), section.alias("section"), cut(False).alias("cuts"))
        taken = F.struct(x["number"].alias("prev"), F.lit(True).alias("open"), section.alias("section"), cut(True).alias("cuts"))
        return F.when(x["closes"], shut).when(opens, taken).otherwise(acc)

    fields = ("number", "plain", "bare", "tail", "mark", "closes")
    numbered = F.transform("rows", lambda r, i: F.struct(i.alias("at"), *(r[k].alias(k) for k in fields)))
    cuts = F.aggregate(F.filter(numbered, lambda r: r["plain"] | r["bare"] | r["closes"]), start, step)["cuts"]
    docs = docs.select("doc", "rows", F.inline(F.array(F.struct(cuts.alias("cuts")))))

    def item(c: Column, k: Column) -> Column:
        head, end = F.get(F.col("rows"), c["at"]), F.coalesce(F.get(F.col("cuts"), k + 1)["at"], F.size("rows"))
        body = F.transform(F.slice("rows", c["at"] + 1, end - c["at"]), lambda r: r["line"])
        return F.when(c["head"], F.struct(head["pos"].alias("pos"), head["number"].alias("number"), head["rest"].alias("rest"), c["section"].alias("section"), body.alias("lines")))

    return docs.select("doc", F.inline(F.filter(F.transform("cuts", item), lambda x: x.isNotNull())))


def _mark(line: Column) -> Column:
    low = F.lower(line)
    return F.when(low.startswith("openbare zitting"), "openbaar").when(low.startswith("besloten zitting"), "besloten")


def parse_decisions(docs: DataFrame, **columns: str) -> DataFrame:
    """Items of decision lists: doc, pos, number, category, section, added, submitter, type, title, result.

    The last line of an item is its result, the others are its title.
    """
    def marked(r: Column) -> Column:
        line = r["line"]
        forms = F.struct(*(F.regexp_extract(line, p, i).alias(f"{k}{j}") for j, p in enumerate((DECISION_HEAD, DECISION_HEAD_TYPE, DECISION_HEAD_BARE), 1) for k, i in (("n", 1), ("r", 2))))
        return let(forms, lambda f: let(_real(f), lambda real: let(_read(line, f, real), lambda x: _row(r, f, real, x))))

    def _real(f: Column) -> Column:
        year = F.coalesce(F.regexp_extract(f["n1"], r"^(\d+)", 1).try_cast("int") >= 1000, F.lit(False))
        return (f["n1"] != "") & ~year & (~f["n1"].rlike(r"^[A-Z]{2,4}\d") | f["r1"].rlike("^[A-Z]{2,}"))

    def _read(line: Column, f: Column, real: Column) -> Column:
        number = F.when(real, f["n1"]).when(f["n2"] != "", f["n2"]).otherwise(f["n3"])
        rest = F.when(real, f["r1"]).when(f["n2"] != "", f["r2"]).otherwise(f["r3"])
        closes = _mark(line).isNotNull() | F.lower(line).rlike(DECISION_BREAK)
        return F.struct(F.regexp_replace(number, r"^(\d+) ([A-Z])$", "$1$2").alias("number"), rest.alias("rest"), _mark(line).alias("mark"), closes.alias("closes"))

    def _row(r: Column, f: Column, real: Column, x: Column) -> Column:
        plain = (real | (f["n2"] != "")) & ~x["closes"]
        tail = ~x["rest"].rlike(RUBRIC) & ~F.upper(x["rest"]).startswith("GESCHRAPT")
        return F.struct(r["pos"].alias("pos"), r["line"].alias("line"), *(x[k].alias(k) for k in ("number", "rest", "mark", "closes")), plain.alias("plain"), ((f["n3"] != "") & ~plain & ~x["closes"]).alias("bare"), tail.alias("tail"))

    items = _items(_once(_after_opening(_lines(docs, DECISION_NOISE, **columns)), rows=F.transform("rows", marked)))
    category, title = F.trim(F.regexp_extract("rest", RUBRIC, 1)), F.when(F.col("rest").rlike(RUBRIC), F.trim(F.regexp_extract("rest", RUBRIC, 2))).otherwise(F.col("rest"))
    added = F.col("number").startswith("TP") | (F.upper(category) == "TOEGEVOEGD PUNT")
    debate = F.col("number").startswith("ACT") | (F.upper(category) == "ACTUALITEITSDEBAT")
    split = added & F.contains(title, F.lit(" - "))
    body = F.slice("lines", F.lit(2), F.greatest(F.size("lines") - 2, F.lit(0)))
    head = F.when(split, F.trim(F.regexp_extract(title, r"^.*? - (.*)$", 1))).otherwise(title)
    return items.select(
        "doc", "pos", "number",
        F.when(added | debate, "").otherwise(category).alias("category"), "section", added.alias("added"),
        F.when(split, F.trim(F.substring_index(title, " - ", 1))).alias("submitter"),
        F.when(debate, "actuadebat").when(added, "toegevoegd").otherwise("gewoon").alias("type"),
        F.trim(F.array_join(F.concat(F.array(head), body), " ")).alias("title"),
        F.when(F.size("lines") > 1, F.element_at("lines", -1)).otherwise("").alias("result"),
    )


def parse_agenda(docs: DataFrame, **columns: str) -> DataFrame:
    """Items of agendas: doc, pos, number, category, section, type, submitter, title."""
    def marked(r: Column) -> Column:
        line = r["line"]
        read = F.struct(F.regexp_extract(line, AGENDA_HEAD, 1).alias("number"), F.regexp_extract(line, AGENDA_HEAD, 2).alias("rest"), _mark(line).alias("mark"), (_mark(line).isNotNull() | (F.lower(line) == "vragen")).alias("closes"))
        return let(read, lambda x: _row(r, x))

    def _row(r: Column, x: Column) -> Column:
        spaced = r["line"].rlike(r"^[^.]+\.\s") | x["number"].startswith("ACT")
        real = (x["number"] != "") & spaced & (x["number"].rlike("^[TVA]") | (F.coalesce(F.regexp_extract(x["number"], r"^(\d+)", 1).try_cast("int"), F.lit(0)) < 1000))
        return F.struct(r["pos"].alias("pos"), r["line"].alias("line"), *(x[k].alias(k) for k in ("number", "rest", "mark", "closes")), (real & ~x["closes"]).alias("plain"), F.lit(False).alias("bare"), F.lit(False).alias("tail"))

    items = _items(_once(_after_opening(_lines(docs, AGENDA_NOISE, **columns)), rows=F.transform("rows", marked)))
    category, title = F.trim(F.regexp_extract("rest", RUBRIC, 1)), F.when(F.col("rest").rlike(RUBRIC), F.trim(F.regexp_extract("rest", RUBRIC, 2))).otherwise(F.col("rest"))
    kind = F.when(F.col("number").startswith("V"), "vraag").when(F.col("number").startswith("TP") | (F.upper(category) == "TOEGEVOEGD PUNT"), "toegevoegd").when(F.col("number").startswith("ACT") | (F.upper(category) == "ACTUALITEITSDEBAT"), "actuadebat").otherwise("gewoon")
    split = kind.isin("vraag", "toegevoegd") & title.rlike(r"\s[-–]\s")
    head = F.when(split, F.trim(F.regexp_extract(title, r"^.*?\s[-–]\s(.*)$", 1))).otherwise(title)
    return items.select(
        "doc", "pos", "number", F.when(kind == "gewoon", category).otherwise("").alias("category"), "section", kind.alias("type"),
        F.when(split, F.trim(F.regexp_extract(title, r"^(.*?)\s[-–]\s", 1))).alias("submitter"),
        F.trim(F.array_join(F.concat(F.array(head), F.slice("lines", F.lit(2), F.size("lines"))), " ")).alias("title"),
    )


#: Heads and lines without meaning of minutes. Fixed values.
MINUTES_NUMBERED = r"^(\d+)\.(?:\s+|(?=[A-ZÀ-Ÿ]))([A-ZÀ-Ÿ][A-ZÀ-Ÿ0-9 /()&\-]{2,60})\.\s+(.*)$"
MINUTES_SPECIAL = r"^(TP\d+|ACT\d*|HP\d+|V\d+|O\d+)\.\s+([^.]+?)\.\s+(.*)$"
MINUTES_NOISE = r"^(Notulen gemeenteraad|Gemeenteraad . Notulen|Vergadering van |NAMENS DE)"
BULLET = "^\uf0b7\\s*"
PAGE_FOOTER = rf"(?iU)^\s*\d{{1,2}}\s+(?:{'|'.join(MONTHS)})\s+\d{{4}}\s*$"


def parse_minutes(docs: DataFrame, **columns: str) -> DataFrame:
    """Items of minutes: doc, number, type, category, title, text, promises (titles of the O items that follow it)."""

    def marked(r: Column) -> Column:
        parts = lambda t, p: F.struct(F.regexp_extract(t, p, 1).alias("number"), F.trim(F.regexp_extract(t, p, 2)).alias("category"), F.trim(F.regexp_extract(t, p, 3)).alias("title"))
        head = lambda t: F.when(t.rlike(MINUTES_NUMBERED), parts(t, MINUTES_NUMBERED)).when(t.rlike(MINUTES_SPECIAL), parts(t, MINUTES_SPECIAL))
        return let(F.regexp_replace(r["line"], BULLET, ""), lambda t: F.struct(t.alias("line"), head(t).alias("h")))

    is_promise = lambda r: F.coalesce(r["h"]["number"].startswith("O"), F.lit(False))
    found = _once(_lines(docs, MINUTES_NOISE, **columns), rows=F.transform("rows", marked))
    starts = F.filter(F.transform("rows", lambda r, i: F.when(r["h"].isNotNull() & ~is_promise(r), i)), lambda i: i.isNotNull())
    found = found.select("doc", "rows", F.inline(F.array(F.struct(starts.alias("starts")))))

    def item(at: Column, k: Column) -> Column:
        n = F.coalesce(F.get(F.col("starts"), k + 1), F.size("rows")) - at
        return F.struct((k + 1).cast("long").alias("block"), n.alias("n"), F.slice("rows", at + 1, n + 3).alias("near"))

    # an item's rows, and the three after them: the title of a promise runs on over up to three lines, to a full stop, a section or the next head
    items = found.select("doc", F.inline(F.transform("starts", item)))

    def promised(r: Column, i: Column) -> Column:
        following = F.array(*(F.coalesce(F.get(F.col("near"), i + j)["line"], F.lit("Motivering")) for j in (1, 2, 3)))
        whole = continued_title(r["h"]["title"], following, stop=f"{MINUTES_NUMBERED}|{MINUTES_SPECIAL}", footer=PAGE_FOOTER)
        return F.when((i < F.col("n")) & is_promise(r), F.coalesce(whole, F.lit("")))

    text = F.array_join(F.transform(F.slice("near", F.lit(1), F.col("n")), lambda r: r["line"]), "\n")
    promises = F.filter(F.transform("near", promised), lambda x: x.isNotNull())
    items = items.select("doc", "block", F.inline(F.array(F.struct(F.get("near", F.lit(0))["h"].alias("h"), text.alias("text"), promises.alias("promises"))))).select("doc", "block", "h.*", "text", "promises")
    kind = F.when(F.col("number").startswith("ACT"), "actualiteitsdebat").when(F.col("number").startswith("TP"), "toegevoegd").when(F.col("number").startswith("HP"), "politieverordening").when(F.col("number").startswith("V"), "vraag").otherwise("gewoon")
    return items.select("doc", "block", "number", kind.alias("type"), "category", "title", "text", "promises")


#: Role names in attendance lists. Fixed values.
ROLES = ("plaatsvervangend voorzitter voor 10", "algemeen directeur", "gemeenteraadsleden", "schepenen", "burgemeester", "voorzitter", "afwezig voor 10")


def attendance(text: Column) -> Column:
    """Struct of the names present and absent in minutes, each once in order."""
    block = F.regexp_extract(text, r"(?is)(?:^|\n)Aanwezig:(.*?)\nopenbare zitting", 1)
    here, away = block, F.regexp_extract(block, r"(?s)Tijdelijk afwezig:(.*)$", 1)
    here = F.regexp_replace(here, r"(?s)Tijdelijk afwezig:.*$", "")
    roles = "(?i)" + "|".join(ROLES)
    shape = r"(?U)^[A-ZÀ-Ÿ][\w’\-]+( [A-ZÀ-Ÿ][\w’\-.]+)+$"
    names = lambda t: F.array_distinct(F.filter(F.transform(F.split(F.regexp_replace(F.regexp_replace(t, r"\s+", " "), roles, ","), ","), lambda s: F.regexp_replace(s, r"^[ .]+|[ .]+$", "")), lambda s: s.rlike(shape)))
    return F.struct(names(here).alias("present"), names(away).alias("absent"))


#: Known results of items; a result of several parts joins them by " / ". Fixed values.
OUTCOMES = (
    "Goedgekeurd", "Goedgekeurd na amendering", "Aktename", "Kennisname", "Vastgesteld", "Bekrachtigd", "Gunstig geadviseerd", "Verworpen", "Niet ter stemming gelegd",
    "Verdaagd", "Afgevoerd van agenda", "Verkozen verklaring", "Aangesteld", "Geschrapt", "Bespreking ter zitting", "Behandeld ter zitting",
)
#: Heads of three kinds of items in the lines of a list. Fixed values.
KIND_HEAD = r"^(?:[A-Z]{2,4}\d{0,3}|\d{1,3} ?[A-Z]?)\.?\s*(ACTUALITEITSDEBAT|TOEGEVOEGD PUNT|POLITIEVERORDENINGEN)\."


def decision_errors(items: DataFrame, texts: DataFrame | None = None, known: DataFrame | None = None) -> DataFrame:
    """Rows (doc, number, what) of what is wrong in parsed decision lists, without the deviations that are ``known`` (the same columns).

    ``items`` is :func:`parse_decisions`, ``texts`` (doc, text) their source. Six checks: ``gat`` (a number, a letter of a series, or the main
    item of a letter is missing), ``dubbel``, ``volgorde`` (a number descends within a section), ``resultaat`` (no known
    outcome, unless the item is struck), ``opgeslokt`` (a title holds an outcome and then the head of another item),
    ``punttype`` (the text has more heads of a kind than there are items of it). Known deviations are part of the data, not of this module.
    """
    main, letter = F.regexp_extract("number", r"^(\d+)([A-Za-z]?)$", 1).try_cast("int"), F.upper(F.regexp_extract("number", r"^(\d+)([A-Za-z]?)$", 2))
    rows = items.withColumn("n", main).withColumn("letter", F.when(main.isNotNull(), letter))
    say = lambda df, what, number="number": df.select("doc", F.col(number).cast("string").alias("number"), F.lit(what).alias("what"))
    numbers = rows.where("n is not null").groupBy("doc", "n").agg(F.max(F.col("letter") == "").alias("whole"), F.max(F.nullif("letter", F.lit(""))).alias("last"), F.collect_set(F.nullif("letter", F.lit(""))).alias("has"))
    per_doc = numbers.groupBy("doc").agg(F.max("n").alias("top"))
    wanted = per_doc.where("top > 0").select("doc", F.explode(F.sequence(F.lit(1), F.col("top"))).alias("n"))
    gaps = say(wanted.join(numbers, ["doc", "n"], "left_anti"), "gat", "n")
    orphans = say(numbers.where("not whole").withColumn("number", F.concat("n", F.array_min("has"))), "gat")
    alphabet = F.transform(F.sequence(F.lit(65), F.ascii("last")), lambda i: F.char(i))
    series = numbers.where("last is not null").select("doc", "n", F.explode(F.array_except(alphabet, "has")).alias("x"))
    found = gaps.unionByName(orphans).unionByName(say(series.withColumn("number", F.concat("n", "x")), "gat"))
    doubles = rows.withColumn("key", F.coalesce(F.concat("n", "letter"), "number")).groupBy("doc", "key").agg(F.count("*").alias("c"), F.max("number").alias("number")).where("c > 1")
    order = Window.partitionBy("doc").orderBy("pos")
    run = rows.withColumn("_run", F.sum(F.coalesce((F.col("section") != F.lag("section").over(order)).cast("int"), F.lit(0))).over(order))
    here = F.struct("n", "letter")
    down = run.where("n is not null").withColumn("_before", F.lag(here).over(Window.partitionBy("doc", "_run").orderBy("pos"))).where(here < F.col("_before"))
    struck = (F.col("result") == "") & F.upper("title").startswith("GESCHRAPT")
    odd = F.exists(F.split("result", " / "), lambda r: ~F.trim(r).isin(*OUTCOMES))
    swallowed = rf"(?U)\b(?:{'|'.join(sorted(OUTCOMES, key=len, reverse=True))})\s+(?:\d{{1,3}} ?[A-Z]?|[A-Z]{{2,4}}\d{{1,3}})(?:[.:)]\s*|\s+)[A-Z]"
    for what, df in (("dubbel", doubles), ("volgorde", down), ("resultaat", rows.where(~struck & odd)), ("opgeslokt", rows.where(F.col("title").rlike(swallowed)))):
        found = found.unionByName(say(df, what))
    if texts is not None:
        heads = texts.select("doc", F.explode(F.transform(F.split("text", r"\R"), lambda x: F.regexp_extract(F.trim(x), KIND_HEAD, 1))).alias("number")).where("number <> ''").groupBy("doc", "number").agg(F.count("*").alias("n"))
        kind = F.when(F.col("type") == "actuadebat", "ACTUALITEITSDEBAT").when(F.col("type") == "toegevoegd", "TOEGEVOEGD PUNT").when(F.upper("category") == "POLITIEVERORDENINGEN", "POLITIEVERORDENINGEN")
        have = items.groupBy("doc", kind.alias("number")).agg(F.count("*").alias("have"))
        found = found.unionByName(say(heads.join(have, ["doc", "number"], "left").where("n > coalesce(have, 0)"), "punttype"))
    found = found.distinct()
    return found if known is None else found.join(known.select("doc", "number", "what"), ["doc", "number", "what"], "left_anti")


def numbering_errors(items: DataFrame) -> DataFrame:
    """Violations (doc, number, what) in parsed items (doc, pos, number, section, title, result): gaps, doubles, descents, no result."""
    n = F.regexp_extract("number", r"^(\d+)", 1).try_cast("int")
    numbered = items.withColumn("n", n)
    seen = numbered.where("n is not null").groupBy("doc").agg(F.sequence(F.lit(1), F.max("n")).alias("all"), F.collect_set("n").alias("has"))
    gaps = seen.select("doc", F.explode(F.array_except("all", "has").cast("array<string>")).alias("number"), F.lit("gat").alias("what"))
    doubles = items.groupBy("doc", "number").count().where("count > 1").select("doc", "number", F.lit("dubbel").alias("what"))
    order = Window.partitionBy("doc").orderBy("pos")
    run = numbered.withColumn("_changed", (F.col("section") != F.lag("section").over(order)).cast("int")).withColumn("_run", F.sum(F.coalesce("_changed", F.lit(0))).over(order))
    down = run.where("n is not null").withColumn("_before", F.lag("n").over(Window.partitionBy("doc", "_run").orderBy("pos"))).where("n < _before").select("doc", "number", F.lit("volgorde").alias("what"))
    bare = items.where("result = '' and not upper(title) like 'GESCHRAPT%'").select("doc", "number", F.lit("resultaat").alias("what"))
    return gaps.unionByName(doubles).unionByName(down).unionByName(bare)
