"""Filters, look-ups, orders and small joins of the catalogue, as frames and column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicframe.functions.text import let

COUNCIL, WELFARE, COLLEGE, BUREAU, MAYOR = "Gemeenteraad", "Raad voor maatschappelijk welzijn", "College van burgemeester en schepenen", "Vast bureau", "Burgemeester"
#: Names of organs and what stands for them in types, file names and keys. Fixed values.
TYPE_CODE = {COUNCIL: "Gemeenteraad", WELFARE: "RMW"}
SLUG = {COUNCIL: "gemeenteraad", WELFARE: "rmw"}
ORGAN_KEY = {COUNCIL: "Gemeenteraad", WELFARE: "RMW", COLLEGE: "College", BUREAU: "Vast bureau", MAYOR: "Burgemeester"}
FOLDER = {COLLEGE: "college_van_burgemeester_en_schepenen", COUNCIL: "gemeenteraad", WELFARE: "raad_voor_maatschappelijk_welzijn", MAYOR: "burgemeester", BUREAU: "vast_bureau"}
EXECUTIVE = {COLLEGE: ("College", "college"), BUREAU: ("Vast bureau", "vastbureau"), MAYOR: ("Burgemeester", "burgemeester")}
#: Most characters of a source text that goes to a model, and of a question's text that isn't a bundle. Fixed values.
MOST_SOURCE, MOST_QUESTION = 24_000, 50_000
#: The head of an extract: in its first lines, number, letter, department and title. Fixed values.
HEAD_LINES, HEAD_MORE = 25, 4
HEAD_NUMBER = r"^\s*(\d{1,3})\s*(?:([A-Z])\s*\.?|\.)\s+[A-ZÀ-Þ][A-Za-zÀ-ÿ]{2,}"
HEAD_SECTION = r"^\s*(Voorgeschiedenis|Feiten|Motivering|Juridische grond|Argumentatie|Adviezen|Besluit|Regelgeving|Aanleiding|Context|Financi)"
HEAD_PARTS = r"^\s*(\d{1,3})\s*([A-Z]?)\s*\.?\s+([^.]{3,80}?)\.\s+(.+)$"
NUMBER_IN_ID = r"-(\d{8})-(\d+)([A-Z]*)(?:-[0-9a-f]{6})?$"
SESSION_IN_ID = r"^[a-z]+[-_]?(\d{4})(\d{2})(\d{2})"
VERDICTS = ("ja", "nee", "twijfel")


def since(df: DataFrame, day: str, floor: str) -> DataFrame:
    """Rows of ``floor`` or later; rows without a day go."""
    return df.where(F.col(day) >= F.to_date(F.lit(floor)))


def titled(df: DataFrame, title: str, pattern: str, *, present: str | None = None) -> DataFrame:
    """Rows whose title has the pattern and, if ``present`` names a flag, whose file is there."""
    kept = df.where(F.col(title).rlike(pattern))
    return kept.where(F.col(present)) if present else kept


def chosen(df: DataFrame, *, organ: str = "", only_late: bool = False) -> DataFrame:
    """Rows whose organ holds a text, in any case of letters, and of these only late ones if asked for."""
    kept = df.where(F.contains(F.lower("organ"), F.lit(organ.lower()))) if organ else df
    return kept.where(F.col("late_days") > 0) if only_late else kept


def looked_up(value: Column, table: dict[str, str], default: Column | None = None) -> Column:
    """The entry of a fixed table, else ``default``, else the value itself; null stays null."""
    pairs = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.when(value.isNotNull(), F.coalesce(F.try_element_at(pairs, value), value if default is None else default))


def organ_of(organ: Column, session_id: Column) -> Column:
    """The organ of an item: its own, else by the prefix of its session, else null."""
    return F.coalesce(F.nullif(organ, F.lit("")), F.when(session_id.startswith("rmw"), WELFARE).when(session_id.startswith("gemeenteraad"), COUNCIL))


def capped(text: Column, most: int = MOST_SOURCE) -> Column:
    """At most so many characters of a source text for a model."""
    return F.substring(text, 1, most)


def is_bundle(text: Column, most: int = MOST_QUESTION) -> Column:
    """Whether the file of a question is too long to be one question."""
    return F.coalesce(F.char_length(text) > most, F.lit(False))


def with_cached(items: DataFrame, cache: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Items with each of ``fields`` from the cache where their own is null or empty."""
    c = cache.select(F.col(key), *(F.col(f).alias(f"_cached_{f}") for f in fields))
    own = {f: F.coalesce(F.nullif(F.col(f), F.lit("")), F.col(f"_cached_{f}")) for f in fields}
    return items.join(c, key, "left").select(*(own.get(n, F.col(n)).alias(n) for n in items.columns))


def linked_texts(links: DataFrame, texts: DataFrame, *, item: str, text_id: str, order: str, text: str = "text", between: str = "\n\n") -> DataFrame:
    """One text an item of all texts that are linked to it, in order; empty ones are left out."""
    both = links.join(texts.where(F.col(text) != ""), text_id)
    return both.groupBy(item).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, text_id, text))), lambda x: x[text]), between).alias(text))


def source_text(kind: str, **c: Column) -> Column:
    """The text of an item as each reader takes it: of ``title``, ``result``, ``terms`` (array), ``source``, ``minutes``,
    ``extracts`` and ``attachments``; null and empty parts are left out."""
    full = lambda x: F.nullif(F.trim(x), F.lit(""))
    if kind == "index":
        return F.concat_ws("\n", full(c["source"]), full(c["result"]), full(F.array_join(c["terms"], " ")), full(c["minutes"]), full(c["extracts"]))
    if kind == "codes":
        return F.concat_ws("\n", full(c["title"]), full(c["source"]), full(c["minutes"]))
    if kind == "tagging":  # its own extract, else the attachments, and the source
        return capped(F.concat_ws("\n\n", F.coalesce(full(c["extracts"]), full(c["attachments"])), full(c["source"])))
    raise ValueError("kind is 'index', 'codes' or 'tagging'")


def unknown_sessions(planned: DataFrame, known: DataFrame, today: str) -> DataFrame:
    """Planned sessions (organ, day) from today on that no known one (type, day) is, with their type code and id."""
    coming = since(planned, "day", today).withColumn("type", looked_up(F.col("organ"), TYPE_CODE))
    new = coming.join(known.select("type", "day"), ["type", "day"], "left_anti")
    return new.withColumn("id", F.concat_ws("-", looked_up(F.col("organ"), SLUG, F.lit(SLUG[COUNCIL])), F.date_format("day", "yyyyMMdd")))


def used_codes(codes: DataFrame, corpus: DataFrame, key: str) -> DataFrame:
    """Codes that the corpus names."""
    return codes.join(corpus.select(key), key, "left_semi")


def codes_of_kind(codes: DataFrame, kind: str) -> DataFrame:
    """Codes ``kind:code`` of one kind without it, a row for each item that names them."""
    return codes.where(F.split_part("code", F.lit(":"), F.lit(1)) == kind).select(F.regexp_replace("code", "^[^:]*:", "").alias("code"), "item_id").distinct()


def districts(streets: DataFrame, single: DataFrame, double: DataFrame, *, default: str) -> DataFrame:
    """District of streets (postcode, located): by ``single`` (postcode, district); for a postcode of several, by place,
    else the first of ``double`` (postcode, main); for any other postcode the default."""
    found = streets.join(single.select("postcode", F.col("district").alias("_single")), "postcode", "left").join(double.select("postcode", F.col("main").alias("_main")), "postcode", "left")
    return found.select(*streets.columns, F.coalesce("_single", F.when(F.col("_main").isNotNull(), F.coalesce("located", "_main")), F.lit(default)).alias("district"))


def without_match(names: DataFrame, used: DataFrame, name: str) -> DataFrame:
    """Names that are not among the used ones, in any case of letters."""
    return names.withColumn("_n", F.lower(F.trim(name))).join(used.select(F.lower(F.trim(name)).alias("_n")), "_n", "left_anti").drop("_n")


def split_matches(hits: DataFrame, matches: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Hits with their match, and those without one."""
    return hits.join(matches, key), hits.join(matches, key, "left_anti")


def organ_years(organs: DataFrame, first: int, last: int) -> DataFrame:
    """A row for each organ and year."""
    return organs.withColumn("year", F.explode(F.sequence(F.lit(first), F.lit(last))))


def histogram(df: DataFrame, *keys: str) -> DataFrame:
    """Rows of each value, null included."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def kind_counts(codes: DataFrame) -> DataFrame:
    """Codes and distinct items of each kind of code (kind, code, item_id)."""
    return codes.groupBy("kind").agg(F.countDistinct("code").alias("n_codes"), F.countDistinct("item_id").alias("n_items"))


def keyword_dossier(hits: DataFrame) -> DataFrame:
    """Hits of each session (organ, day)."""
    return hits.groupBy("organ", "day").agg(F.count("*").alias("n_hits"))


def earliest(*parts: tuple[DataFrame, str]) -> DataFrame:
    """The earliest day of several tables' columns, as one row."""
    days = [df.agg(F.min(F.col(c).cast("date")).alias("day")) for df, c in parts]
    return reduce(DataFrame.unionByName, days).agg(F.min("day").alias("day"))


def newest_versions(catalogue: DataFrame, *, entity: str, order: str) -> DataFrame:
    """Of each plan (years ``2026-2031`` in ``set``, else the set) the first document of an entity by ``order``."""
    years = F.regexp_extract(F.coalesce("set", F.lit("")), r"20\d{2}\s*-\s*20\d{2}", 0)
    own = catalogue.where(F.lower("entity").startswith(entity.lower())).withColumn("plan", F.when(years != "", years).otherwise(F.col("set")))
    return own.groupBy("plan").agg(F.min_by(F.struct(*catalogue.columns), order).alias("_d")).select("plan", "_d.*")


def merged_spans(spans: DataFrame, key: str, start: str, end: str, *, cell_rows: int = 10_000) -> DataFrame:
    """Spans of a key that overlap or touch, as one each. Starts and ends are numbers, days or times without nulls.

    The line of a key is cut into cells of equal width, one for about each ``cell_rows`` spans, and spans are sorted inside the cell that they
    start in. How far the cells before reach, and how many islands they open, comes from a table of one row a cell, so a
    key with very many spans is spread over its cells.
    """
    kind = spans.schema[start].dataType.simpleString()
    number = F.unix_date(start) if kind == "date" else F.unix_micros(F.col(start).cast("timestamp")) if kind.startswith("timestamp") else F.col(start)
    at = spans.withColumn("_at", number.cast("double"))
    lines = at.groupBy(F.col(key).alias("_key")).agg(F.min("_at").alias("_low"), F.max("_at").alias("_high"), F.ceil(F.count("*") / cell_rows).alias("_n"))
    share = F.when(F.col("_high") > F.col("_low"), (F.col("_at") - F.col("_low")) / (F.col("_high") - F.col("_low"))).otherwise(0.0)
    placed = at.join(lines, F.col(key).eqNullSafe(F.col("_key"))).withColumn("_cell", F.least(F.floor(share * F.col("_n")), F.col("_n") - 1)).select(*spans.columns, "_cell")
    per_key = Window.partitionBy("_key").orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    reach = placed.groupBy(F.col(key).alias("_key"), F.col("_cell").alias("_c")).agg(F.max(end).alias("_end")).withColumnRenamed("_c", "_cell").withColumn("_before", F.max("_end").over(per_key))
    same = F.col(key).eqNullSafe(F.col("_key")) & (F.col("_cell") == F.col("_c"))
    rows = placed.join(reach.select("_key", F.col("_cell").alias("_c"), "_before"), same).drop("_key", "_c")
    inside = Window.partitionBy(key, "_cell").orderBy(start, end)
    far = F.greatest("_before", F.max(end).over(inside.rowsBetween(Window.unboundedPreceding, -1)))
    opened = rows.withColumn("_far", far).withColumn("_new", (F.col("_far").isNull() | (F.col(start) > F.col("_far"))).cast("int"))
    opened = opened.withColumn("_island", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    earlier = opened.groupBy(F.col(key).alias("_key"), "_cell").agg(F.sum("_new").alias("_opened")).withColumn("_first", F.coalesce(F.sum("_opened").over(per_key), F.lit(0)))
    numbered = opened.join(earlier.select("_key", F.col("_cell").alias("_c"), "_first"), same).withColumn("_island", F.col("_island") + F.col("_first"))
    return numbered.groupBy(key, "_island").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("_island")


#: Orders of the published lists.
LISTINGS = {
    "sessions": lambda: ["organ", "day"],
    "decisions": lambda: [F.col("day").desc(), "ordinal"],
    "questions": lambda: [F.col("day").desc(), F.col("id").desc()],
    "streets": lambda: [F.lower("name"), "name"],
    "rare words": lambda: ["n", "word"],
    "deadlines": lambda: [F.col("organ").desc(), F.col("day").desc()],
}


def listed(df: DataFrame, listing: str) -> DataFrame:
    """Rows in the order of a published list."""
    return df.orderBy(*LISTINGS[listing]())


def next_work(work: DataFrame, key: str, most: int) -> DataFrame:
    """The first ``most`` rows of a work list by key: what one run may ask for."""
    return work.orderBy(key).limit(most)


def sampled(tokens: DataFrame, token: str, n: int, seed: str) -> DataFrame:
    """``n`` tokens in the order of a hash with a seed, so reruns agree."""
    return tokens.orderBy(F.md5(F.concat_ws("|", token, F.lit(seed)).cast("binary")), token).limit(n)


def append_new(known: DataFrame, found: DataFrame, keys: list[str]) -> DataFrame:
    """Known rows as they are, and the found ones that are new, once each."""
    new = found.dropDuplicates(keys).join(known, keys, "left_anti")
    return known.unionByName(new)


def judged_questions(verdicts: DataFrame) -> DataFrame:
    """Questions that a verdict (a, b, verdict) names, once each."""
    told = verdicts.where(F.col("verdict").isNotNull())
    return told.select(F.col("a").alias("id")).unionByName(told.select(F.col("b").alias("id"))).distinct()


def _head_lines(text: Column) -> Column:
    return F.slice(F.split(F.coalesce(text, F.lit("")), r"\r\n|[\n\r\x0B\x0C\x1C-\x1E\x85  ]"), 1, HEAD_LINES + HEAD_MORE)


def head_number(text: Column) -> Column:
    """Number and letter in the first head line of an extract: struct<number:int,letter:string>, null without one."""
    heads = F.filter(F.slice(_head_lines(text), 1, HEAD_LINES), lambda x: x.rlike(HEAD_NUMBER))
    return let(F.get(heads, 0), lambda x: F.when(x.isNotNull(), F.struct(F.regexp_extract(x, HEAD_NUMBER, 1).cast("int").alias("number"), F.regexp_extract(x, HEAD_NUMBER, 2).alias("letter"))))


def head_of(text: Column) -> Column:
    """Number, letter, department and title of an extract's head, whose title may run on for some lines until a full stop."""

    def joined(lines: Column) -> Column:
        at = F.array_position(F.transform(F.slice(lines, 1, HEAD_LINES), lambda x: x.rlike(HEAD_NUMBER)), True).cast("int")

        def step(acc: Column, line: Column) -> Column:
            stop = acc["stop"] | acc["text"].endswith(".") | (F.trim(line) == "") | line.rlike(HEAD_SECTION)
            return F.struct(F.when(stop, acc["text"]).otherwise(F.concat_ws(" ", acc["text"], F.trim(line))).alias("text"), stop.alias("stop"))

        more = F.slice(lines, at + 1, F.lit(HEAD_MORE))
        start = F.struct(F.trim(F.get(lines, at - 1)).alias("text"), F.lit(False).alias("stop"))
        return F.when(at > 0, F.aggregate(more, start, step)["text"])

    parts = lambda head: F.struct(F.regexp_extract(head, HEAD_PARTS, 1).cast("int").alias("number"), F.regexp_extract(head, HEAD_PARTS, 2).alias("letter"), F.trim(F.regexp_extract(head, HEAD_PARTS, 3)).alias("department"), F.trim(F.regexp_extract(head, HEAD_PARTS, 4)).alias("title"))
    return let(let(_head_lines(text), joined), lambda head: F.when(head.rlike(HEAD_PARTS), parts(head)))


def provisional_decisions(extracts: DataFrame, decisions: DataFrame) -> DataFrame:
    """Decisions made from extracts (publication, organ, day, text) of executive organs that have none yet that day.

    Of extracts with the same id the one of least ``publication`` counts; ``decisions`` has organ (short) and day.
    """
    short, prefix = ({k: v[i] for k, v in EXECUTIVE.items()} for i in (0, 1))
    mine = extracts.where(F.col("organ").isin(*EXECUTIVE)).withColumn("_prefix", looked_up(F.col("organ"), prefix)).withColumn("organ", looked_up(F.col("organ"), short))
    new = mine.join(decisions.select("organ", "day").distinct(), ["organ", "day"], "left_anti").withColumn("_h", head_of(F.col("text"))).where("_h is not null")
    new = new.withColumn("id", F.concat(F.col("_prefix"), F.lit("-"), F.date_format("day", "yyyyMMdd"), F.lit("-"), F.col("_h.number"), F.col("_h.letter")))
    first = Window.partitionBy("id").orderBy("publication")
    return new.withColumn("_k", F.row_number().over(first)).where("_k = 1").select("id", "organ", "day", F.col("_h.department").alias("category"), F.col("_h.title").alias("title"), F.lit(True).alias("provisional"))


def number_in_id(item_id: Column) -> Column:
    """Number and letter at the end of an item's id, before a suffix of equal ids if there is one; null without."""
    return F.when(item_id.rlike(NUMBER_IN_ID), F.struct(F.regexp_extract(item_id, NUMBER_IN_ID, 2).cast("int").alias("number"), F.regexp_extract(item_id, NUMBER_IN_ID, 3).alias("letter")))


def session_in_id(item_id: Column) -> Column:
    """The day in an item's id as text; null without."""
    return F.when(item_id.rlike(SESSION_IN_ID), F.concat_ws("-", *(F.regexp_extract(item_id, SESSION_IN_ID, i) for i in (1, 2, 3))))


def verdict_in(answer: Column) -> Column:
    """The verdict in the first JSON object of a model's answer; null if there is none or it is no known verdict."""
    found = F.get_json_object(F.regexp_extract(F.coalesce(answer, F.lit("")), r"(?s)\{.*?\}", 0), "$.oordeel")
    return F.when(found.isin(*VERDICTS), found)


def tags_in(answer: Column, schema: str) -> Column:
    """The JSON object of a model's answer, from its first brace to its last, whatever stands around it; line breaks inside
    strings are allowed. Null if it can't be read."""
    return F.from_json(F.nullif(F.regexp_extract(F.coalesce(answer, F.lit("")), r"(?s)\{.*\}", 0), F.lit("")), schema, {"allowUnquotedControlChars": "true", "mode": "PERMISSIVE"})


def continued_title(first: Column, following: Column, *, stop: str, footer: str, most: int = 3) -> Column:
    """A title that runs on over the ``following`` lines until a full stop; page footers between are skipped."""

    def step(acc: Column, line: Column) -> Column:
        end = acc["stop"] | acc["text"].endswith(".") | line.startswith("Motivering") | line.rlike(stop)
        kept = F.when(end | line.rlike(footer), acc["text"]).otherwise(F.concat_ws(" ", acc["text"], line))
        return F.struct(kept.alias("text"), end.alias("stop"))

    return F.trim(F.aggregate(F.slice(following, 1, most), F.struct(first.alias("text"), F.lit(False).alias("stop")), step)["text"])


def archive_names(replaced: DataFrame, taken: DataFrame) -> DataFrame:
    """Names under which replaced files (folder, day, kind, seen) are kept; a suffix counts on from the ``taken`` (stem, n)."""
    stem = F.concat_ws("_", "folder", F.date_format("day", "yyyy-MM-dd"), "kind", F.date_format("seen", "yyyyMMdd"))
    rows = replaced.withColumn("stem", stem).join(taken.select("stem", F.col("n").alias("_n")), "stem", "left")
    number = F.row_number().over(Window.partitionBy("stem").orderBy("file")) + F.coalesce("_n", F.lit(0))
    return rows.select(*replaced.columns, F.concat(F.col("stem"), F.when(number > 1, F.concat(F.lit("_"), number)).otherwise(F.lit("")), F.lit(".pdf")).alias("archive"))


def blanked(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with private columns emptied."""
    return df.select(*(F.lit("").alias(c) if c in columns else F.col(c) for c in df.columns))
