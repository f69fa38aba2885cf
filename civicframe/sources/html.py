"""Pages: links, headings carried down, catalogues."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from civicframe.functions.dates import checked_date, month_number
from civicframe.functions.matches import replaced
from civicframe.functions.text import squeeze, strip_tags


def hrefs(html: Column, contains: str = "") -> Column:
    """Distinct link targets of a page, in order, that contain a text."""
    found = F.array_distinct(F.regexp_extract_all(html, F.lit(r"""(?i)href=["']([^"']*)["']"""), F.lit(1)))
    return F.filter(found, lambda h: F.contains(h, F.lit(contains)))


def doctype(filename: Column) -> Column:
    """Kind of a main document by the start of its file name; null for others. Supplements go before agendas."""
    low = F.lower(filename)
    return F.when(low.startswith("aanvullende"), "aanvullend").when(low.startswith("agenda"), "agenda").when(low.rlike("^(besluiten|beslissing)"), "besluiten").when(low.startswith("notulen"), "notulen")


def document_class(text: Column, filename: Column) -> Column:
    """``uittreksel`` if link text or file name says so, ``hoofddoc`` for main documents, else ``bijlage``."""
    return F.when(F.lower(text).startswith("uittreksel") | F.lower(filename).startswith("uittreksel"), "uittreksel").when(doctype(filename).isNotNull(), "hoofddoc").otherwise("bijlage")


def publications(pages: DataFrame, html: str = "html") -> DataFrame:
    """Rows (organ, href, filename, doctype, session, publication, published) of an overview page's blocks.

    The first link of a block is its document; its file name has the session's date and, for extracts, a number.
    """
    blocks = pages.select("organ", F.explode(F.slice(F.split(html, "publicatie-grid"), F.lit(2), F.size(F.split(html, "publicatie-grid")))).alias("block"))
    href = F.regexp_extract("block", r"""(?i)href=["']([^"']*\.pdf)["']""", 1)
    rows = blocks.select("organ", href.alias("href"), F.regexp_extract("block", r"<span[^>]*>\s*(\d{2}/\d{2}/\d{4})", 1).alias("_p")).where("href <> ''")
    rows = rows.withColumn("filename", F.url_decode(F.regexp_extract("href", r"([^/=]+)$", 1)))
    day = [F.regexp_extract("filename", r"_(\d{2})-(\d{2})-(\d{4})", i) for i in (3, 2, 1)]
    number = F.nullif(F.regexp_extract("filename", r"_\d{2}-\d{2}-\d{4}_(\d+)\.pdf$", 1), F.lit(""))
    seen = [F.regexp_extract("_p", r"(\d{2})/(\d{2})/(\d{4})", i) for i in (3, 2, 1)]
    return rows.select("organ", "href", "filename", doctype(F.col("filename")).alias("doctype"), checked_date(*day).alias("session"), number.alias("publication"), checked_date(*seen).alias("published"))


def extract_catalogue(pages: DataFrame, *, since: str = "1900-01-01", root: str = "") -> DataFrame:
    """Extracts and attachments (organ, session, title, kind, published, extract_id, url, filename) of overview pages (organ, html).

    Each link of a publication's block that names a file counts, but for main documents; its text is the title, and the file's name has the
    session's date (files without one go, and sessions before ``since``) and the publication's number. The day of publication is the block's.
    """
    blocks = pages.select("organ", F.explode(F.slice(F.split("html", "publicatie-grid"), F.lit(2), F.size(F.split("html", "publicatie-grid")))).alias("block"))
    link = r"""(?is)<a\b[^>]*href=["']([^"']*filename=[^"']*)["'][^>]*>(.*?)</a>"""
    seen = F.regexp_extract("block", r"<span[^>]*>\s*(\d{2}/\d{2}/\d{4})", 1)
    links = blocks.select("organ", seen.alias("_seen"), F.explode(F.regexp_extract_all("block", F.lit(f"({link})"), F.lit(1))).alias("a"))
    href = F.regexp_extract("a", link, 1)
    rows = links.select("organ", "_seen", href.alias("href"), plain_text(F.regexp_extract("a", link, 2)).alias("title"), F.try_url_decode(F.substring_index(href, "filename=", -1)).alias("filename"))
    rows = rows.withColumn("kind", document_class(F.col("title"), F.col("filename"))).where("kind <> 'hoofddoc'")
    day = [F.regexp_extract("filename", r"_(\d{2})-(\d{2})-(\d{4})", i) for i in (3, 2, 1)]
    shown = [F.regexp_extract("_seen", r"(\d{2})/(\d{2})/(\d{4})", i) for i in (3, 2, 1)]
    rows = rows.withColumn("session", checked_date(*day)).where(F.col("session") >= F.lit(since).cast("date"))
    number = F.nullif(F.regexp_extract("filename", r"_(\d+)\.pdf$", 1), F.lit(""))
    return rows.select("organ", "session", "title", "kind", checked_date(*shown).alias("published"), number.alias("extract_id"), F.concat(F.lit(root), "href").alias("url"), "filename")


def plain_text(html: Column) -> Column:
    """Text of a piece of HTML: tags off, the references of five signs, of spaces and of numbers resolved, white space squeezed."""
    named = {"&lt;": "<", "&gt;": ">", "&quot;": '"', "&apos;": "'", "&nbsp;": " "}
    text = F.regexp_replace(html, r"(?s)<[^>]*>", "")
    text = replaced(text, r"&#\d{1,5};", lambda m: F.char(F.regexp_extract(m, r"(\d+)", 1).cast("int")))
    for sign, plain in named.items():
        text = F.replace(text, F.lit(sign), F.lit(plain))
    return squeeze(F.replace(text, F.lit("&amp;"), F.lit("&")))


def catalogue_report(catalogue: DataFrame) -> DataFrame:
    """Rows (what, key, n) about a catalogue (organ, kind, url, filename): documents by kind and organ, urls that repeat, extracts with odd names."""
    say = lambda what, key, df: df.groupBy(key.alias("key")).agg(F.count("*").alias("n")).select(F.lit(what).alias("what"), F.coalesce(F.col("key"), F.lit("")).alias("key"), "n")
    odd = catalogue.where((F.col("kind") == "uittreksel") & ~F.lower("filename").startswith("uittreksel"))
    parts = [say("soort", F.col("kind"), catalogue), say("orgaan", F.col("organ"), catalogue), say("dubbele url", F.col("url"), catalogue).where("n > 1"), say("vreemde naam", F.col("organ"), odd)]
    return reduce(DataFrame.unionByName, parts)


def tokens_in_order(pages: DataFrame, id_col: str, html: str, pattern: str) -> DataFrame:
    """Rows (page, pos, token): the matches of a pattern in the order of the page."""
    return pages.select(F.col(id_col).alias("page"), F.posexplode(F.regexp_extract_all(html, F.lit(f"({pattern})"), F.lit(1))).alias("pos", "token"))


def carried_links(pages: DataFrame, id_col: str = "page_id", html: str = "html", *, upper: str = "h2", lower: str = "h3", link: str = r'<a\b[^>]*href="[^"]+"[^>]*>.*?</a>', chrome: tuple[str, ...] = ()) -> DataFrame:
    """Links with the headings they stand under: page, pos, url, title, entity (upper) and set (lower).

    An upper heading ends the lower one; headings in ``chrome`` blank their level; links outside any entity go, and a
    url counts where it comes first.
    """
    pattern = rf"(?is)<{upper}[^>]*>.*?</{upper}>|<{lower}[^>]*>.*?</{lower}>|{link}"
    rows = tokens_in_order(pages, id_col, html, pattern)
    low = F.lower("token")
    text = F.when(F.lower(strip_tags(F.col("token"))).isin(list(chrome) or [""]), "").otherwise(strip_tags(F.col("token")))
    running = Window.partitionBy("page").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("is_upper", low.startswith(f"<{upper}")).withColumn("is_lower", low.startswith(f"<{lower}"))
    rows = rows.withColumn("entity", F.last(F.when(F.col("is_upper"), text), ignorenulls=True).over(running)).withColumn("run", F.sum(F.col("is_upper").cast("int")).over(running))
    within = Window.partitionBy("page", "run").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("set", F.coalesce(F.last(F.when(F.col("is_lower"), text), ignorenulls=True).over(within), F.lit("")))
    links = rows.where(~F.col("is_upper") & ~F.col("is_lower") & (F.coalesce("entity", F.lit("")) != "")).withColumn("url", F.regexp_extract("token", r'(?i)href="([^"]*)"', 1))
    first = Window.partitionBy("page", "url").orderBy("pos")
    return links.withColumn("rn", F.row_number().over(first)).where("rn = 1").select("page", "pos", "url", strip_tags(F.col("token")).alias("title"), "entity", "set")


def planned_sessions(pages: DataFrame, id_col: str, html: str) -> DataFrame:
    """Distinct dates in the list rows of a page; a row without a year takes that of the heading above; impossible ones go."""
    rows = tokens_in_order(pages, id_col, html, r"(?is)<h[2-6][^>]*>.*?</h[2-6]>|<li[^>]*>.*?</li>")
    text = strip_tags(F.col("token"))
    running = Window.partitionBy("page").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.when(F.lower("token").startswith("<h"), F.nullif(F.regexp_extract(text, r"\b(20\d{2})\b", 1), F.lit("")))
    rows = rows.withColumn("year", F.last(heading, ignorenulls=True).over(running)).withColumn("text", text)
    pattern = r"(?i)(\d{1,2})\s+([a-z]+)(?:\s+(\d{4}))?"
    part = lambda i: F.regexp_extract("text", pattern, i)
    day = checked_date(F.coalesce(F.nullif(part(3), F.lit("")), F.col("year")), month_number(part(2)), part(1))
    return rows.where(F.lower("token").startswith("<li")).select("page", day.alias("day")).where("day is not null").distinct()


def safe_name(url: Column, folder: Column, longest: int = 250) -> Column:
    """File name of a document's url: no path parts or odd signs, shortened with a digest; null if not a PDF's name."""
    name = F.trim(F.regexp_replace(F.url_decode(F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"([^/]*)$", 1)), r'[<>:"|?*\\/]', "_"))
    room = longest - F.length(folder) - 1
    short = F.concat(F.substr(name, F.lit(1), F.greatest(room - 13, F.lit(1))), F.lit("-"), F.substring(F.sha1(url.cast("binary")), 1, 8), F.lit(".pdf"))
    return F.when(F.lower(name).endswith(".pdf") & ~name.isin(".pdf", "..pdf"), F.when(F.length(name) > room, short).otherwise(name))


def allowed_host(url: Column, hosts: list[str]) -> Column:
    """Whether a url is of one of the hosts."""
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("HOST"))).isin([h.lower() for h in hosts]), F.lit(False))
