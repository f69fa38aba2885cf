"""Full-text index, search, codes, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from civicframe.functions.text import title_words
from civicframe.operators import codes, index
from civicframe.plans.registry import query, table
from civicframe.sources import html
from civicframe.store import stored

STOP = "['" + "','".join(index.STOP_WORDS) + "']"
#: A fixed limit on items of a token that suits the driver tables at every size.
TOKENS = f"""
    doc_tokens AS (
        SELECT DISTINCT doc_id AS id, unnest(regexp_extract_all(strip_accents(lower(text)), '[a-z0-9]+')) AS token FROM documents
    ),
    kept AS (SELECT id, token FROM doc_tokens WHERE length(token) >= 3 AND NOT regexp_full_match(token, '[0-9]+') AND NOT list_contains({STOP}, token))
"""


def _tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return index.item_tokens(table(spark, sf_dir, "documents"), "doc_id", F.col("text"), F.lit(""))


@query(
    f"""
    WITH {TOKENS}, df AS (SELECT token, count(*) AS df FROM kept GROUP BY token HAVING count(*) <= 120)
    SELECT token, df, array_to_string(list(id ORDER BY id), ',') AS items FROM kept JOIN df USING (token) GROUP BY token, df
    """
)
def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sorted posting lists of the tokens in at most 120 documents."""
    return index.inverted_index(_tokens(spark, sf_dir)).select("token", "df", F.array_join("items", ",").alias("items"))


_FIRST_LINE = "string_split(text, chr(10))[1]"
HIDDEN = f"""
    WITH {TOKENS},
    visible AS (SELECT DISTINCT doc_id AS id, unnest(regexp_extract_all(strip_accents(lower({_FIRST_LINE})), '[a-z0-9]+')) AS token FROM documents),
    hidden AS (SELECT * FROM kept EXCEPT SELECT * FROM visible)
"""


@query(f"{HIDDEN} SELECT id, count(*) AS n_tokens, min(token) AS first_token, max(token) AS last_token FROM hidden GROUP BY id")
def index_minus_visible(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each document that its first line does not have; counted in the row, so nothing is shuffled."""
    hidden = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), index.hidden_tokens(F.col("text"), F.get(F.split("text", "\n"), 0)).alias("t"))
    return hidden.where(F.size("t") > 0).select("id", F.size("t").cast("long").alias("n_tokens"), F.array_min("t").alias("first_token"), F.array_max("t").alias("last_token"))


@query(f"WITH {TOKENS} SELECT token FROM kept GROUP BY token HAVING count(*) > 120 UNION SELECT unnest({STOP}) AS token")
def boundary_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Too common tokens and stop words."""
    return index.boundary_tokens(_tokens(spark, sf_dir))


@query(f"{HIDDEN} SELECT (SELECT count(*) FROM (SELECT token, count(*) AS n FROM hidden GROUP BY token HAVING count(*) <= 120)) AS n_tokens, (SELECT count(*) FROM documents WHERE doc_id % 7 = 0) + (SELECT count(*) FROM hidden WHERE token IN (SELECT min(token) FROM hidden)) AS n_errors")
def index_truth_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every posting of the index checked against the texts, after lies were planted: a word that is nowhere, and the first token at items that don't exist."""
    docs, visible = table(spark, sf_dir, "documents"), F.get(F.split("text", "\n"), 0)
    built = stored(index.inverted_index(index.item_tokens(docs, "doc_id", F.col("text"), visible)), "index")
    first = built.where(F.col("token") == F.lit(built.agg(F.min("token")).first()[0]))
    lies = docs.where("doc_id % 7 = 0").select(F.lit("nergenstevinden").alias("token"), F.array("doc_id").alias("items"))
    lies = lies.unionByName(first.select("token", F.transform("items", lambda i: -1 - i).alias("items")))
    planted = built.select("token", "items").unionByName(lies)
    errors = index.index_errors(planted, docs, "doc_id", F.col("text"), visible).agg(F.count("*").alias("n_errors"))
    return built.agg(F.count("*").alias("n_tokens")).crossJoin(errors)


@query(
    f"""
    SELECT doc_id AS id, contains(strip_accents(lower({_FIRST_LINE})), 'tion') AND contains(strip_accents(lower({_FIRST_LINE})), 'ent') AS hit_visible
    FROM documents WHERE contains(strip_accents(lower(text)), 'tion') AND contains(strip_accents(lower(text)), 'ent')
    """
)
def search_and(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with two terms, and whether the first line alone has both."""
    return index.search(table(spark, sf_dir, "documents"), "doc_id", ["tion", "ënt"], F.col("text"), F.get(F.split("text", "\n"), 0))


@query(f"WITH {TOKENS}, i AS (SELECT DISTINCT id FROM kept) SELECT id, row_number() OVER (ORDER BY id) - 1 AS number FROM i")
def index_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers of the documents that have a term of their own, in the order of their ids."""
    return index.dictionary(_tokens(spark, sf_dir))


GROUPS = [("the", "a"), ("and", "a"), ("thnd", "a"), ("oning", "b"), ("haea", "b"), ("eren", "b")]


@query(
    f"""
    WITH {TOKENS}, wanted AS (SELECT * FROM (VALUES ('oning', 0), ('haea', 1), ('eren', 1)) AS t(token, rank))
    SELECT id, CAST(min(rank) AS INTEGER) AS rank FROM kept JOIN wanted USING (token) GROUP BY id
    """
)
def search_synonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of a word or of one of its synonyms."""
    return index.synonym_items(_tokens(spark, sf_dir), spark.createDataFrame(GROUPS, "word string, group string"), "oning")


@query(
    f"""
    WITH {TOKENS}, v AS MATERIALIZED (SELECT DISTINCT token FROM kept),
    held AS MATERIALIZED (SELECT token, substr(token, 1, strpos(token, 'tion') - 1) AS head FROM v WHERE contains(token, 'tion'))
    SELECT held.token FROM held LEFT JOIN v ON v.token = head WHERE head = '' OR (v.token IS NOT NULL AND held.token <> 'ertion')
    """
)
def search_compound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that hold a term at the start or after another word."""
    return index.compounds(_tokens(spark, sf_dir), "tion", ["ertion"])


@query(
    """
    WITH w AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(strip_accents(lower(string_split(text, chr(10))[1])), '[a-z][a-z-]{4,}')) AS word FROM documents),
    s AS (SELECT *, CASE WHEN word LIKE '%en' AND length(word) >= 6 THEN left(word, -2) WHEN word LIKE '%s' AND length(word) >= 5 THEN left(word, -1) ELSE word END AS stem FROM w),
    n AS (SELECT stem, count(DISTINCT doc_id) AS n FROM s GROUP BY stem HAVING count(DISTINCT doc_id) >= 2)
    SELECT DISTINCT word, stem, n FROM s JOIN n USING (stem)
    """
)
def title_word_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of first lines whose stem stands in two lines or more."""
    return index.word_candidates(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.explode(title_words(F.get(F.split("text", "\n"), 0))).alias("word")))


#: Codes in urls: hosts, and the last number of a path.
PAGE_CODES = {"host": r"(?://)([a-z0-9.-]+)", "num": r"(\d+)(?=\D*$)"}
EDGES = """
    edges AS (
        SELECT DISTINCT 'host' AS kind, upper(regexp_extract(url, '//([a-z0-9.-]+)', 1)) AS code, page_id AS item FROM pages WHERE regexp_matches(url, '//[a-z0-9.-]+')
        UNION SELECT DISTINCT 'num', regexp_extract(url, '(\\d+)\\D*$', 1), page_id FROM pages WHERE regexp_matches(url, '\\d')
    )
"""


@query(f"WITH {EDGES} SELECT kind, translate(code, '/-', '__') AS code, count(*) OVER (PARTITION BY kind, code) AS n_items, item FROM edges QUALIFY n_items >= 2")
def code_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes in the urls of two pages or more, a row for each page."""
    return codes.linking(codes.mined(table(spark, sf_dir, "pages"), "page_id", F.col("url"), PAGE_CODES))


@query(
    f"""
    WITH {EDGES}, c AS (SELECT *, count(*) OVER (PARTITION BY kind, code) AS n FROM edges)
    SELECT x.item AS a, y.item AS b, '' AS kind, '' AS code, count(*) AS n FROM c x JOIN c y USING (kind, code) WHERE x.item < y.item AND x.n <= 40 GROUP BY x.item, y.item
    UNION ALL SELECT item, -1, kind, translate(code, '/-', '__'), n FROM c WHERE n > 40
    """
)
def related_by_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of pages that share codes, and the members of codes of more than 40 pages (with -1 for a partner)."""
    return codes.related(codes.mined(table(spark, sf_dir, "pages"), "page_id", F.col("url"), PAGE_CODES)).na.fill(-1, ["b"]).na.fill("", ["kind", "code"])


@query(
    """
    WITH h AS (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS href, generate_subscripts(regexp_extract_all(html, 'href="([^"]*)"', 1), 1) AS pos FROM pages),
    d AS (SELECT page_id, href, min(pos) AS pos FROM h GROUP BY ALL)
    SELECT page_id, count(href) AS n_links, coalesce(array_to_string(list(href ORDER BY pos), ' '), '') AS links FROM pages LEFT JOIN d USING (page_id) GROUP BY page_id
    """
)
def html_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct links of each page in order."""
    links = html.hrefs(F.coalesce(F.col("html"), F.lit("")))
    return table(spark, sf_dir, "pages").select("page_id", F.size(links).cast("long").alias("n_links"), F.array_join(links, " ").alias("links"))


@query(
    """
    WITH t AS (SELECT page_id AS page, unnest(regexp_extract_all(html, '<title[^>]*>[^<]*</title>|<a [^>]*href="[^"]+"[^>]*>[^<]*</a>')) AS token, generate_subscripts(regexp_extract_all(html, '<title[^>]*>[^<]*</title>|<a [^>]*href="[^"]+"[^>]*>[^<]*</a>'), 1) AS pos FROM pages),
    c AS (SELECT *, last_value(CASE WHEN token LIKE '<title%' THEN trim(regexp_replace(regexp_replace(token, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) END IGNORE NULLS) OVER (PARTITION BY page ORDER BY pos ROWS UNBOUNDED PRECEDING) AS entity FROM t),
    l AS (SELECT page, entity, pos, regexp_extract(token, 'href="([^"]*)"', 1) AS url FROM c WHERE token LIKE '<a%' AND entity <> '')
    SELECT page, url, arg_min(entity, pos) AS entity FROM l GROUP BY page, url
    """
)
def heading_carry_down(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of pages with the heading above them."""
    return html.carried_links(table(spark, sf_dir, "pages"), upper="title", lower="h3", link=r'<a [^>]*href="[^"]+"[^>]*>[^<]*</a>').select("page", "url", "entity")


@query(
    """
    SELECT CASE WHEN event_type LIKE 's%' THEN 'agenda' WHEN event_type LIKE 'p%' THEN 'besluiten' WHEN event_type LIKE 'c%' THEN 'notulen' ELSE 'bijlage' END AS doctype, count(*) AS n
    FROM events GROUP BY 1
    """
)
def doctype_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of file names, made of event types, by their first word."""
    t = F.col("event_type")
    name = F.concat(F.when(t.startswith("s"), "Agenda_").when(t.startswith("p"), "Besluitenlijst_").when(t.startswith("c"), "Notulen_").otherwise("Nota_"), t, F.lit(".pdf"))
    return table(spark, sf_dir, "events").select(F.coalesce(html.doctype(name), html.document_class(F.lit("nota"), name)).alias("doctype")).groupBy("doctype").agg(F.count("*").alias("n"))


