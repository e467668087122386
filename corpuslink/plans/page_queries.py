"""Registered link, crawl and keyword index queries over the pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslink.functions.html_blocks import BlockShape
from corpuslink.functions.text import STOP_WORDS
from corpuslink.operators import crawl, keywords, links, postings
from corpuslink.plans import views
from corpuslink.session import cut_lineage

DOMAIN = "example.com"
SITE = "http://site.example.com/"
ARTICLE = BlockShape(tag="article", title=("h1", None), desc=None)
MENU_ITEM = BlockShape(tag="li", title=("a", None), desc=None)
NO_LIMIT = 10**12
BUDGET = 100


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.texts(spark, sf_dir, "pages", "page_id", "url", "html")


def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links.page_links(_pages(spark, sf_dir)).select("page_id", "pos", "href")


def links_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.resolved_links(links.page_links(_pages(spark, sf_dir)))
    return found.select("page_id", "pos", "target")


def links_followable(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = links.resolved_links(links.page_links(_pages(spark, sf_dir)))
    return links.followable_links(found, DOMAIN).select("page_id", "pos", "target")


def site_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two links per page, computed from the page ids (links inside the pages leave the table)."""
    pages = views.table(spark, sf_dir, "pages").select("page_id")
    n_pages = pages.agg(F.count("*")).scalar()
    targets = F.array(F.col("page_id") * 2 + 1, F.col("page_id") * 2 + 2)
    address = lambda page: F.concat(F.lit(SITE), page.cast("string"), F.lit(".html"))
    return (
        pages.withColumn("n_pages", n_pages)
        .select("page_id", "n_pages", F.posexplode(targets).alias("pos", "to"))
        .select(
            address(F.col("page_id")).alias("src"),
            "pos",
            address(F.col("to") % F.col("n_pages")).alias("dst"),
        )
    )


def link_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = crawl.crawl_links(site_links(spark, sf_dir), f"{SITE}0.html", NO_LIMIT)
    return found.select("url", "visit_no", "level")


def link_crawl_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same crawl with the budget of pages as the limit."""
    found = crawl.crawl_links(site_links(spark, sf_dir), f"{SITE}0.html", BUDGET)
    return found.select("url", "visit_no", "level")


def named_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages under the words of their headings, the first page of each word, so that the links inside
    the pages, which name words, lead to pages."""
    heading = F.regexp_replace(F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1), "&[a-z]+;", " ")
    words = F.regexp_extract_all(heading, F.lit("[a-zA-Z]+"), F.lit(0))
    named = _pages(spark, sf_dir).select(F.explode(words).alias("word"), "page_id").groupBy("word").agg(F.min("page_id").alias("page_id"))
    address = F.concat(F.lit(SITE), F.col("word")).alias("url")
    return named.join(views.table(spark, sf_dir, "pages").select("page_id", "html"), "page_id").select("page_id", address, "html")


def page_crawl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the pages' own links, from the page whose links lead to most pages."""
    pages = cut_lineage(named_pages(spark, sf_dir))
    to_pages = links.link_table(pages, DOMAIN).join(pages.select(F.col("url").alias("dst")), "dst")
    start = to_pages.groupBy("src").agg(F.count_distinct("dst").alias("n")).orderBy(F.desc("n"), "src").first()
    found = crawl.crawl_pages(pages, start["src"] if start else SITE, DOMAIN, NO_LIMIT)
    return found.select("url", "visit_no", "level")


def _coded(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = views.table(spark, sf_dir, "pages")
    area = F.upper(F.regexp_extract("url", r"/([a-z]{2})/(\d+)", 1))
    number = F.regexp_extract("url", r"/([a-z]{2})/(\d+)", 2)
    return pages.select("page_id", F.when(area != "", F.concat_ws(" ", area, number)).alias("code"))


def course_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _coded(spark, sf_dir)


def code_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest page id of every code."""
    coded = _coded(spark, sf_dir).where(F.col("code").isNotNull())
    return coded.groupBy("code").agg(F.min("page_id").alias("course_id"))


def _article_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.block_words(keywords.page_blocks(_pages(spark, sf_dir), ARTICLE))


def block_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.exploded(_article_words(spark, sf_dir), "page_id")


def keyword_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages' ids are looked up before they meet the words, which are shuffled once."""
    known = _coded(spark, sf_dir).join(code_map(spark, sf_dir), "code").select("page_id", "course_id")
    words = _article_words(spark, sf_dir).join(known, "page_id")
    return keywords.exploded(words, "course_id")


def keyword_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.nested_index(keyword_index(spark, sf_dir))


def keyword_posting_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posting lists themselves, in chunks."""
    chunks = postings.posting_chunks(keyword_index(spark, sf_dir))
    return chunks.withColumn("deltas", F.array_join(F.col("deltas").cast("array<string>"), " "))


def sequence_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Menu items as blocks: the first one of a page is the header of those next to it."""
    items = keywords.page_blocks(_pages(spark, sf_dir), MENU_ITEM)
    role = F.when(F.col("block_no") == 0, keywords.MAIN_CLASS).otherwise(keywords.SUB_CLASS)
    found = keywords.sequence_words(items.withColumn("class", role))
    return keywords.exploded(found, "page_id", "block_no")


def _catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalog pages made of the articles: a header block and a sub-course block. On even pages they
    are next to each other, the header holds the first paragraph and the sub-course all others; on
    odd ones text stands between them and the header, indexed alone, holds all paragraphs. Titles
    carry a code where the address of the page has a number."""
    pages = _pages(spark, sf_dir)
    area = F.upper(F.regexp_extract("url", r"/([a-z]{2})/(\d+)", 1))
    number = F.regexp_extract("url", r"/([a-z]{2})/(\d+)", 2)
    heading = F.regexp_extract("html", "(?s)<h1>(.*?)</h1>", 1)
    plain = F.regexp_extract_all("html", F.lit("<p>([^<]*)</p>"), F.lit(1))

    odd = F.col("page_id") % 2 == 1
    first = F.when(odd, F.array_join(plain, " ")).otherwise(F.coalesce(F.get(plain, F.lit(0)), F.lit("")))
    others = F.array_join(F.slice(plain, F.lit(2), F.greatest(F.size(plain), F.lit(1))), " ")

    def block(kind: str, first_digit: str, desc: Column) -> Column:
        code = F.when(
            number != "", F.concat(area, F.lit(f"PG\xa0{first_digit}"), F.lpad(F.right(number, F.lit(4)), 4, "0"), F.lit(". "))
        ).otherwise("")
        return F.concat(
            F.lit(f'<div class="{kind}"><p class="courseblocktitle"><b>'), code, heading,
            F.lit('</b></p><p class="courseblockdesc">'), desc, F.lit("</p></div>"),
        )

    html = F.concat(
        block(keywords.MAIN_CLASS, "1", first),
        F.when(odd, "\n").otherwise(""),
        block(keywords.SUB_CLASS, "2", others),
    )
    return pages.select("page_id", html.alias("html"))


def _catalog_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of the codes of two thirds of the pages, the smallest one where several pages share a code."""
    pages = views.table(spark, sf_dir, "pages").where(F.col("page_id") % 3 != 0)
    area = F.upper(F.regexp_extract("url", r"/([a-z]{2})/(\d+)", 1))
    number = F.lpad(F.right(F.regexp_extract("url", r"/([a-z]{2})/(\d+)", 2), F.lit(4)), 4, "0")
    both = F.array(*[F.concat(area, F.lit(f"PG {digit}"), number) for digit in "12"])
    return (
        pages.where(area != "")
        .select(F.posexplode(both).alias("pos", "code"), "page_id")
        .groupBy("code")
        .agg(F.min(F.col("page_id") * 2 + F.col("pos")).alias("course_id"))
    )


def _catalog_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = keywords.page_blocks(_catalog(spark, sf_dir), BlockShape(), marker="courseblock")
    return keywords.with_codes(keywords.sequence_words(blocks))


def catalog_index_built(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.build_index(_catalog(spark, sf_dir), _catalog_map(spark, sf_dir))


def title_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _catalog_blocks(spark, sf_dir).select("page_id", "block_no", "code")


def unmatched_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    unknown = keywords.unknown_codes(_catalog_blocks(spark, sf_dir), _catalog_map(spark, sf_dir))
    return unknown.select("page_id", "block_no", "code")


QUERIES = {
    "page_links": page_links,
    "links_resolved": links_resolved,
    "links_followable": links_followable,
    "link_crawl": link_crawl,
    "link_crawl_budget": link_crawl_budget,
    "page_crawl": page_crawl,
    "course_codes": course_codes,
    "block_words": block_words,
    "keyword_index": keyword_index,
    "keyword_postings": keyword_postings,
    "keyword_posting_chunks": keyword_posting_chunks,
    "sequence_words": sequence_words,
    "catalog_index_built": catalog_index_built,
    "title_codes": title_codes,
    "unmatched_codes": unmatched_codes,
}

_STOP = ", ".join(f"'{word}'" for word in STOP_WORDS)
_WORD = "[a-zA-Z][a-zA-Z\\p{Nd}]*"

_LINKS = """found AS MATERIALIZED (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs
                    FROM pages),
places AS (SELECT page_id, url, hrefs, unnest(range(1, len(hrefs) + 1)) AS i FROM found),
links AS MATERIALIZED (
    SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, url, replace(hrefs[i], '&amp;', '&') AS href FROM places),
resolved AS MATERIALIZED (
    SELECT page_id, pos, regexp_extract(url, '^(https?://[^/?#]+)', 1) || regexp_replace(href, '#.*$', '') AS target
    FROM links)"""

_CODED = """coded AS MATERIALIZED (
    SELECT page_id, CASE WHEN regexp_matches(url, '/([a-z]{2})/(\\d+)')
        THEN upper(regexp_extract(url, '/([a-z]{2})/(\\d+)', 1)) || ' ' ||
             regexp_extract(url, '/([a-z]{2})/(\\d+)', 2) END AS code FROM pages)"""


def _text(html: str) -> str:
    plain = f"regexp_replace({html}, '<[^>]*>', '', 'g')"
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", "\xa0"), ("&amp;", "&")):
        plain = f"replace({plain}, '{entity}', '{char}')"
    return plain



def _follow(url: str) -> str:
    return f"""(regexp_extract({url}, '//([^/?#]*)', 1) = '{DOMAIN}'
               OR ends_with(regexp_extract({url}, '//([^/?#]*)', 1), '.{DOMAIN}'))
          AND NOT contains({url}, '@') AND NOT contains({url}, 'mailto:')
          AND NOT regexp_matches({url}, '[?][^#]') AND NOT regexp_matches({url}, '#.')
          AND (NOT regexp_matches(regexp_extract(regexp_extract({url}, '//[^/?#]*([^?#]*)', 1), '[^/]*$'), '[^.].*[.]')
               AND NOT regexp_matches(regexp_extract(regexp_extract({url}, '//[^/?#]*([^?#]*)', 1), '[^/]*$'), '[^.][.]$')
               OR regexp_matches(regexp_extract({url}, '//[^/?#]*([^?#]*)', 1), '[^./][.]html$'))"""


_ARTICLES = f"""articles AS MATERIALIZED (
    SELECT page_id, {_text("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS title,
           {_text("regexp_extract(html, '<article>(.*)</article>', 1, 's')")} AS body FROM pages),
tokens AS (SELECT page_id, unnest(regexp_extract_all(title, '{_WORD}')) AS token FROM articles
           UNION ALL
           SELECT page_id, unnest(regexp_extract_all(body, '{_WORD}')) AS token FROM articles),
article_words AS MATERIALIZED (
    SELECT DISTINCT page_id, lower(token) AS word FROM tokens WHERE token NOT IN ({_STOP}))"""

_INDEX = f"""{_CODED}, {_ARTICLES},
code_map AS (SELECT code, min(page_id) AS course_id FROM coded WHERE code IS NOT NULL GROUP BY code),
index_rows AS MATERIALIZED (
    SELECT m.course_id, w.word FROM article_words w JOIN coded c ON w.page_id = c.page_id
    JOIN code_map m ON c.code = m.code)"""

_AREA = "upper(regexp_extract(url, '/([a-z]{2})/(\\d+)', 1))"
_NUMBER = "lpad(right(regexp_extract(url, '/([a-z]{2})/(\\d+)', 2), 4), 4, '0')"
_CATALOG = f"""cat AS MATERIALIZED (
    SELECT page_id, {_AREA} AS area, {_NUMBER} AS number,
           {_text("regexp_extract(html, '<h1>(.*?)</h1>', 1, 's')")} AS heading,
           regexp_extract_all(html, '<p>([^<]*)</p>', 1) AS plain FROM pages),
listed AS MATERIALIZED (
    SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 1 ELSE 0 END AS block_no,
           CASE WHEN area <> '' THEN area || 'PG ' || CASE WHEN page_id % 2 = 0 THEN '2' ELSE '1' END || number END AS code,
           heading || ' ' || CASE WHEN area <> '' THEN area || 'PG ' ELSE '' END
               || {_text("array_to_string(plain, ' ')")} AS said FROM cat),
catalog_map AS MATERIALIZED (
    SELECT code, min(id) AS course_id FROM (
        SELECT area || 'PG 1' || number AS code, page_id * 2 AS id FROM cat WHERE page_id % 3 <> 0 AND area <> ''
        UNION ALL
        SELECT area || 'PG 2' || number, page_id * 2 + 1 FROM cat WHERE page_id % 3 <> 0 AND area <> '') GROUP BY code)"""

# A page's two targets keep the order of the page numbers, so visits go by level and number. No
# shortest way is longer than the pages are many.
_SITE_CRAWL = f"""n AS (SELECT count(*) AS n FROM pages),
edges AS (SELECT page_id AS src, (page_id * 2 + 1) % n AS dst FROM pages, n
          UNION SELECT page_id, (page_id * 2 + 2) % n FROM pages, n),
reached(page, level) AS (
    SELECT CAST(0 AS BIGINT), 0 UNION
    SELECT e.dst, r.level + 1 FROM reached r JOIN edges e ON e.src = r.page, n WHERE e.dst > r.page AND r.level < n),
visited AS (SELECT '{SITE}' || page || '.html' AS url, row_number() OVER (ORDER BY min(level), page) - 1 AS visit_no,
                   min(level) AS level FROM reached GROUP BY page)"""

SQL = {
    "page_links": f"WITH {_LINKS} SELECT page_id, pos, href FROM links",
    "links_resolved": f"WITH {_LINKS} SELECT page_id, pos, target FROM resolved",
    "links_followable": f"""WITH {_LINKS}
        SELECT page_id, pos, target FROM resolved
        WHERE {_follow("target")}""",
    "link_crawl": f"WITH RECURSIVE {_SITE_CRAWL} SELECT * FROM visited",
    "link_crawl_budget": f"WITH RECURSIVE {_SITE_CRAWL} SELECT * FROM visited WHERE visit_no < {BUDGET}",
    "page_crawl": f"""WITH RECURSIVE headings AS (
            SELECT page_id, html, unnest(regexp_extract_all(
                regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1, 's'), '&[a-z]+;', ' ', 'g'), '[a-zA-Z]+')) AS word FROM pages),
        named AS MATERIALIZED (SELECT '{SITE}' || word AS url, arg_min(html, page_id) AS html FROM headings GROUP BY word),
        found AS (SELECT url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS hrefs FROM named),
        places AS (SELECT url, hrefs, unnest(range(1, len(hrefs) + 1)) AS i FROM found),
        targets AS (SELECT url AS src, i, regexp_extract(url, '^(https?://[^/?#]+)', 1)
                           || regexp_replace(replace(hrefs[i], '&amp;', '&'), '#.*$', '') AS dst FROM places),
        edges AS MATERIALIZED (SELECT src, dst, min(i) AS i FROM targets WHERE {_follow("dst")} GROUP BY src, dst),
        n_pages AS (SELECT count(*) AS n FROM named),
        start AS (SELECT e.src AS url FROM edges e JOIN named n ON n.url = e.dst
                  GROUP BY e.src ORDER BY count(DISTINCT e.dst) DESC, e.src LIMIT 1),
        reached(url, level, way) AS (
            SELECT coalesce((SELECT url FROM start), '{SITE}'), 0, CAST([] AS BIGINT[]) UNION ALL
            SELECT e.dst, r.level + 1, list_append(r.way, CAST(e.i AS BIGINT))
            FROM reached r JOIN edges e ON e.src = r.url, n_pages WHERE r.level < n
            QUALIFY row_number() OVER (PARTITION BY e.dst ORDER BY list_append(r.way, CAST(e.i AS BIGINT))) = 1),
        visited AS (SELECT url, level, way FROM reached QUALIFY row_number() OVER (PARTITION BY url ORDER BY level, way) = 1)
        SELECT url, row_number() OVER (ORDER BY level, way) - 1 AS visit_no, level FROM visited""",
    "catalog_index_built": f"""WITH {_CATALOG},
        said AS (SELECT page_id, code, unnest(regexp_extract_all(said, '{_WORD}')) AS token FROM listed)
        SELECT m.course_id, w.word FROM catalog_map m JOIN (
            SELECT DISTINCT page_id, code, lower(token) AS word FROM said WHERE token NOT IN ({_STOP})) w
        ON m.code = w.code""",
    "title_codes": f"WITH {_CATALOG} SELECT page_id, block_no, code FROM listed",
    "unmatched_codes": f"""WITH {_CATALOG} SELECT page_id, block_no, code FROM listed
        WHERE code IS NULL OR code NOT IN (SELECT code FROM catalog_map)""",
    "course_codes": f"WITH {_CODED} SELECT page_id, code FROM coded",
    "block_words": f"WITH {_ARTICLES} SELECT page_id, word FROM article_words",
    "keyword_index": f"WITH {_INDEX} SELECT course_id, word FROM index_rows",
    "keyword_postings": f"""WITH {_INDEX}
        SELECT word, count(*) AS n_rows, count(DISTINCT course_id) AS n_courses FROM index_rows GROUP BY word""",
    "keyword_posting_chunks": f"""WITH {_INDEX},
        places AS (SELECT word, course_id, (row_number() OVER (ORDER BY word, course_id) - 1) // {postings.CHUNK_IDS} AS block
                   FROM index_rows),
        chunks AS MATERIALIZED (
            SELECT word, block, min(course_id) AS first_id, max(course_id) AS last_id, count(*) AS n,
                   list(course_id ORDER BY course_id) AS ids FROM places GROUP BY word, block)
        SELECT word, block - min(block) OVER (PARTITION BY word) AS chunk_no, first_id, last_id, n,
               array_to_string(list_transform(ids, lambda x: x - first_id), ' ') AS deltas FROM chunks""",
    "sequence_words": f"""WITH items AS MATERIALIZED (
            SELECT page_id, regexp_extract_all(html, '<li>(.*?)</li>', 1) AS items FROM pages),
        blocks AS (SELECT page_id, items, unnest(range(1, len(items) + 1)) AS i FROM items),
        texts AS (SELECT page_id, CAST(i - 1 AS INTEGER) AS block_no, {_text("items[i]")} AS own,
                         {_text("items[1]")} AS head, len(items) AS n FROM blocks),
        tokens AS (SELECT page_id, block_no,
                          unnest(regexp_extract_all(own || ' ' || head, '{_WORD}')) AS token
                   FROM texts WHERE block_no > 0 OR n = 1)
        SELECT DISTINCT page_id, block_no, lower(token) AS word FROM tokens WHERE token NOT IN ({_STOP})""",
}
