import random
from html.parser import HTMLParser
from urllib.parse import urljoin

import pytest
from pyspark.sql import functions as F

from corpuslink.functions.text import course_code, index_words, nearby_keys, search_terms
from corpuslink.functions.urls import is_absolute_url, is_ok_to_follow, process_link, resolve_link
from corpuslink.operators import crawl as C
from corpuslink.operators import keywords as K
from corpuslink.operators import links as L
from corpuslink.sources.pages import read_code_map, read_pages, usable_pages
from tests.conftest import rows

URLS = [
    ("http://lib.z.org", "shelf/7.html", "http://lib.z.org/shelf/7.html", "lib.z.org", True),
    ("http://lib.z.org", "maps.net/world.html", "http://maps.net/world.html", "lib.z.org", False),
    ("http://h.org/a/b/c.html", "../x", "http://h.org/a/x", "h.org", True),
    ("http://h.org/a/b.html", "#top", "http://h.org/a/b.html", "h.org", True),
    ("http://h.org/a/b.html", "/z?q=1", "http://h.org/z?q=1", "h.org", False),
    ("http://h.org/a/b.html", "y.pdf", "http://h.org/a/y.pdf", "h.org", False),
    ("http://h.org/a/b.html", "http://sub.h.org/d/", "http://sub.h.org/d/", "h.org", True),
    ("http://h.org/a/b.html", "http://xh.org/d", "http://xh.org/d", "h.org", False),
    ("http://h.org/a/b.html", "//h2.org/y", "//h2.org/y", "h2.org", False),
    ("http://h.org/a/b.html", "mailto:a@b.edu", "http://mailto:a@b.edu", "b.edu", False),
    ("http://h.org/a/b.html", "www.foo.gov/x", "http://www.foo.gov/x", "h.org", False),
    ("http://h.org/a/b.html", "", None, "h.org", False),
    ("no/host", "x", None, "h.org", False),
]


def test_url_table(spark):
    df = spark.createDataFrame(URLS, "page string, link string, want string, domain string, ok boolean")
    df = df.withColumn("got", process_link(F.col("page"), F.col("link")))
    for r in df.collect():
        assert r.got == r.want
    for domain in {u[3] for u in URLS}:
        found = df.where(F.col("domain") == domain).select("ok", is_ok_to_follow(F.col("got"), domain).alias("is_ok"))
        assert all(r.ok == r.is_ok for r in found.collect())


def test_follow_rules(spark):
    cases = {
        "http://h.org/.html": True, "http://h.org/a.": False, "http://h.org/a.b/c": True, "HTTPS://h.org/x.html": True,
        "ftp://h.org/x": False, "http://h.org/x?": True, "http://h.org/x#": True, "http://h.org/old/x": False,
        "http:///x": False,
    }
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    got = df.select("u", is_ok_to_follow(F.col("u"), "h.org", ["http://h.org/old/"]).alias("ok")).collect()
    assert {r.u: r.ok for r in got} == cases
    absolute = df.select(is_absolute_url(F.lit("//h.org/x")).alias("a"), is_absolute_url(F.lit("")).alias("b")).first()
    assert absolute.a and not absolute.b


def test_relative_links_match_urljoin(spark):
    bases = ["http://h.org", "http://h.org/", "http://h.org/a/b/c.html", "http://h.org/a/b/", "http://h.org/a//b?x=1", "http://h.org/a;p/b"]
    links = "x ./x ../x ../../x ../../../../x x/ ./ .. . ../ ?q=2 #f x?y#z /abs /abs/../q a//b /a//b x/./y/../z http:foo ftp://a/b javascript:void(0) g;x ..g g.. x?".split()
    cases = [(b, u, urljoin(b, u)) for b in bases for u in links]
    df = spark.createDataFrame(cases, "b string, u string, want string")
    wrong = df.withColumn("got", resolve_link(F.col("b"), F.col("u"))).where(~F.col("got").eqNullSafe(F.col("want")))
    assert rows(wrong) == []


class Anchors(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        if tag == "a" and dict(attrs).get("href") is not None:
            self.found.append(dict(attrs)["href"])


def test_link_extraction_matches_html_parser(spark):
    html = (
        "<p><a href='a'>1</a><A class=\"x>y\" HREF = b.html >2</A><a name=q>no</a><!-- <a href=hidden> -->"
        "<script>var s = '<a href=\"no\">';</script><a\nhref=\"c&amp;d\">3</a><abbr href=z></abbr><a href=''>4</a><a data-href='n'>"
    )
    reader = Anchors()
    reader.feed(html)
    pages = spark.createDataFrame([(1, "http://h.org/", html), (2, "http://h.org/", "")], "page_id bigint, url string, html string")
    got = [r.href for r in L.page_links(pages).orderBy("pos").collect()]
    assert got == reader.found == ["a", "b.html", "c&d", ""]


def test_link_extraction_of_generated_pages(spark):
    rng = random.Random(17)
    values = ["x", "a/b.html", "c&amp;d", "&#x2F;e", "&#38;f", "&eacute;g", "&nosuch;", "&#0;", "h&i", "", "k l", "href=q"]

    def attribute():
        name = rng.choice(["href", "HREF", "title", "data-href", "rel", "hrefs", "class"])
        quote = rng.choice(['"', "'", ""])
        value = rng.choice(values + [" href=zz ", "' href='n" if quote == '"' else '" href="n'])
        value = value if quote else (value.replace(" ", "") .replace("'", "").replace('"', "") or "u")
        return name if rng.random() < 0.1 and name != "href" else f"{name}{rng.choice(['=', ' = '])}{quote}{value}{quote}"

    def piece():
        return rng.choice(
            [lambda: "<a " + " ".join(attribute() for _ in range(rng.randint(0, 3))) + rng.choice([">", " >", " />"]),
             lambda: "<!-- <a href=hidden> -->", lambda: "<p title='<a href=\"no\">'>", lambda: "</a> text ",
             lambda: "<script>'<a href=s>'</script>", lambda: "<abbr href=z>", lambda: "<a\nhref=nl>"]
        )()

    class First(Anchors):  # the first of several targets counts
        def handle_starttag(self, tag, attrs):
            targets = [v for k, v in attrs if k == "href" and v is not None]
            if tag == "a" and targets:
                self.found.append(targets[0])

        handle_startendtag = handle_starttag

    made = []
    for i in range(300):
        html = "".join(piece() for _ in range(rng.randint(1, 6)))
        reader = First()
        reader.feed(html)
        reader.close()
        made.append((i, "http://h.org/", html, reader.found))
    pages = spark.createDataFrame([m[:3] for m in made], "page_id bigint, url string, html string")
    got = {r.page_id: r.hrefs for r in pages.select("page_id", L.hrefs(F.col("html")).alias("hrefs")).collect()}
    wrong = [(html, got[i], want) for i, _, html, want in made if got[i] != want]
    assert wrong == []


def test_links_in_open_comments_and_other_values(spark):
    pages = [("<a title=' href=x' href=\"y\">", ["y"]), ("<a href=a><!-- <a href=b> ", ["a"]), ("<a href=a><script> <a href=b>", ["a"])]
    df = spark.createDataFrame(pages, "html string, want array<string>")
    assert [r.got for r in df.select(L.hrefs(F.col("html")).alias("got")).collect()] == [w for _, w in pages]


def fifo(edges, start, budget):
    queue, seen, out = [start], {start}, []
    while queue and len(out) < budget:
        page = queue.pop(0)
        out.append(page)
        for target in edges.get(page, []):
            if target not in seen:
                seen.add(target)
                queue.append(target)
    return out


@pytest.mark.parametrize("budget", [1, 7, 25, 1000])
def test_crawl_matches_a_queue(spark, budget):
    rng = random.Random(11)
    edges = {f"p{i}": [f"p{rng.randrange(60)}" for _ in range(rng.randint(0, 4))] for i in range(50)}
    table = [(s, i, t) for s, targets in edges.items() for i, t in enumerate(targets)]
    start = max(edges, key=lambda p: len(fifo(edges, p, 999)))
    found = C.crawl_links(spark.createDataFrame(table, "src string, pos int, dst string"), start, budget)
    got = [r.url for r in found.orderBy("visit_no").collect()]
    assert got == fifo(edges, start, budget)
    assert sorted(r.visit_no for r in found.collect()) == list(range(len(got)))


def test_crawl_pages_with_redirect(spark):
    data = [
        (1, "http://h.org/", "http://h.org/", "<a href=old.html>x</a><a href=c.html>y</a>"),
        (2, "http://h.org/old.html", "http://h.org/new/", "<a href=d.html>x</a><a href='/new/'>self</a>"),
    ]
    pages = spark.createDataFrame(data, "page_id bigint, url string, final_url string, html string")
    got = [r.url for r in C.crawl_pages(pages, "http://h.org/", "h.org").orderBy("visit_no").collect()]
    assert got == ["http://h.org/", "http://h.org/old.html", "http://h.org/c.html", "http://h.org/new/d.html"]
    with pytest.raises(ValueError):
        C.crawl_pages(pages, "http://h.org/", "h.org", 0)


def block(kind, title, desc):
    return f'<div class="{kind}"><p class="courseblocktitle"><b>{title}</b></p><p class="courseblockdesc">{desc}</p></div>'


def catalog(spark):
    nb = "\xa0"
    one = (
        block("courseblock main", f"CMSC{nb}12100-12200. Intro", "Header words")
        + block("courseblock subsequence", f"CMSC{nb}12100. One", "first &amp; foremost")
        + block("courseblock subsequence", f"CMSC{nb}12200. Two", "second")
        + "\n" + block("courseblock main", f"CMSC{nb}20000. Alone", "The social alone")
    )
    two = block("courseblock main", f"MATH{nb}10000. Seq", "Header") + "\n" + block("courseblock subsequence", f"MATH{nb}10100. One", "x")
    three = block("courseblock main", "No code", "words") + "<div><p>no class</p></div>"
    return spark.createDataFrame([(1, "u1", one), (2, "u2", two), (3, "u3", three), (4, "u4", None)], "page_id bigint, url string, html string")


def test_keyword_index(spark, tmp_path):
    (tmp_path / "map.json").write_text('{"CMSC 12100": 1, "CMSC 12200": 2,\n "CMSC 20000": 3, "MATH 10000": 4, "MATH 10100": 5}')
    codes = read_code_map(spark, str(tmp_path / "map.json"))
    assert codes.count() == 5
    pages = usable_pages(catalog(spark))
    found = {}
    for r in K.build_index(pages, codes).collect():
        found.setdefault(r.course_id, []).append(r.word)
    assert {k: sorted(v) for k, v in found.items()} == {
        1: ["cmsc", "first", "foremost", "header", "intro", "one", "words"],
        2: ["cmsc", "header", "intro", "second", "two", "words"],
        3: ["alone", "cmsc", "the"],
        4: ["header", "math", "seq"],
    }
    loose = K.build_index(pages, codes, strict_adjacent=False, lower_first=True)
    assert {r.course_id for r in loose.collect()} == {1, 2, 3, 5}
    assert "the" not in {r.word for r in loose.collect()}
    coded = K.with_codes(K.sequence_words(K.page_blocks(pages)))
    assert rows(K.unknown_codes(coded, codes).select("page_id", "title")) == [(3, "No code")]
    sizes = {r.word: (r.n_rows, r.n_courses) for r in K.nested_index(K.build_index(pages, codes)).collect()}
    assert sizes["header"] == (3, 3)


def test_page_sources(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "x", 200), (2, "u", "y", 404), (3, "u", None, None)], "page_id bigint, url string, html string, status int")
    assert rows(usable_pages(pages).select("page_id", "html")) == [(1, "x"), (3, "")]
    catalog(spark).write.parquet(f"{tmp_path}/p")
    assert read_pages(spark, f"{tmp_path}/p").where("html = ''").count() == 1


def test_text_functions(spark):
    df = spark.createDataFrame([("The Art of CS 122x", "CMSC\xa012200. Intro", "CMSC 12200")], "t string, a string, b string")
    r = df.select(
        index_words(F.col("t"), F.lit(None).cast("string")).alias("w"), course_code(F.col("a")).alias("a"),
        course_code(F.col("b")).alias("b"), nearby_keys(F.lit("q")).alias("q"), nearby_keys(F.lit("Q")).alias("none"),
        search_terms(F.lit("a  b")).alias("s"),
    ).first()
    assert r.w == ["the", "art", "cs", "x"] and r.a == "CMSC 12200" and r.b is None
    assert r.q == ["w", "a"] and [k for k in r.none if k] == [] and r.s == ["a", "", "b"]


def exchanges_over(plan, table):
    """Lines of a plan from the scan of a table up to the first join above it."""
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if table in line)
    depth, above = lines[at].find("FileScan"), []
    for line in reversed(lines[:at]):
        start = len(line) - len(line.lstrip(" :+-"))
        if start < depth:
            above.append(line)
            depth = start
            if "Join" in line:
                break
    return above


def test_what_is_known_does_not_move(spark):
    """No exchange between the bucketed tables and the joins of a level."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        edges, known = C._Buckets(spark, "src", "edges"), C._Buckets(spark, "url", "known")
        edges.append(spark.range(500).selectExpr("concat('p', id) AS src", "0 AS pos", "concat('p', id + 1) AS dst"))
        for low in (0, 100):
            known.append(spark.range(low, low + 100).selectExpr("concat('p', id) AS url", "id AS visit_no", "0 AS level"), 100)
        frontier = spark.createDataFrame([("p150", 150), ("p220", 7)], "url string, visit_no long")
        found = C.next_targets(edges.rows(), frontier, known.rows())
        assert rows(found.select("url", "first.visit_no")) == [("p221", 7)]
        plan = found._jdf.queryExecution().executedPlan().toString()
        for table in (edges.name, known.name):
            above = exchanges_over(plan, table)
            assert "Join" in above[-1] and not any("Exchange" in line for line in above)
        known.compact()
        assert known.rows().count() == 200
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_long_crawl(spark):
    """More levels than appends between two compactions."""
    table = [(f"p{i}", 0, f"p{i + 1}") for i in range(22)] + [(f"p{i}", 1, "p0") for i in range(22)]
    found = C.crawl_links(spark.createDataFrame(table, "src string, pos int, dst string"), "p0", 10**6)
    assert rows(found) == sorted([(f"p{i}", i, i) for i in range(23)], key=repr)
