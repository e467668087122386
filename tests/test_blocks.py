import random

import pytest
from pyspark.sql import functions as F

from corpuslink.functions.html_blocks import BlockShape
from corpuslink.functions.html_events import events
from corpuslink.operators import keywords as K
from tests.block_reader import blocks_of

SHAPES = [
    BlockShape(),
    BlockShape(tag="article", title=("h1", None), desc=None),
    BlockShape(tag="li", title=("a", None), desc=None),
    BlockShape(tag="div", title=("p", None), desc=("div", "x")),
]
NAMES = ["class", "title", "desc", "prev_adjacent", "prev_blank"]


def page(r):
    def attributes():
        made = [
            r.choice(['class="courseblocktitle"', "class='a courseblockdesc b'", 'CLASS="x"', "class=x", "class", 'class=""', "id=q",
                      "class = \"&lt;x\"", 'title="<p class=x>"', "class='courseblock main'", 'class="x" class="courseblocktitle"'])
            for _ in range(r.choice([0, 0, 1, 1, 2]))
        ]
        return "".join(" " + a for a in made)

    def tag():
        name = r.choice("div div p p p li a h1 article span br hr img b ul DIV P".split())
        return f"<{name}{attributes()}{r.choice(['>', '>', '>', ' >', '/>', ' />'])}"

    def end():
        return f"</{r.choice('div div p p li a h1 article span br b ul DIV'.split())}{r.choice(['>', '>', ' >'])}"

    text = lambda: r.choice([" ", "\n", "\t \n", "word", "a &amp; b", "&nbsp;", "&#65;x", "1 > 0", "x &nosuch; y", "é😀", "\x1c"])
    odd = lambda: r.choice(["<!-- <div> -->", "<!DOCTYPE html>", "<script>var a = '<p>' + 1;</script>", "<style>p {}</style>", "<?x y?>"])
    return "".join(r.choice([tag, tag, tag, end, end, end, text, text, text, odd])() for _ in range(r.randint(0, 40)))


@pytest.mark.parametrize("shape", SHAPES)
def test_blocks_of_generated_pages(spark, shape):
    r = random.Random(21)
    pages = [page(r) for _ in range(700)]
    pages += [
        "<div class='courseblock main'><p class=courseblocktitle>One<p class=courseblockdesc>two<div>three</div>",
        "<div><p>a<div><p>b</div>\n</div><div>c", "<li><a>x<li><a>y</a>z</li></li>", "<article><h1>t</h1><p>u<article>v</article>w",
        "", "no markup", "<div", "</p></div>", "<div></div> <div></div>x<div></div><!-- --><div></div>",
    ]
    table = spark.createDataFrame(list(enumerate(pages)), "page_id bigint, html string")
    got = {}
    for b in K.page_blocks(table, shape).collect():
        got.setdefault(b.page_id, {})[b.block_no] = tuple(b[n] for n in NAMES)
    wrong = []
    for i, html in enumerate(pages):
        want = {n: tuple(b[c] for c in NAMES) for n, b in enumerate(blocks_of(html, shape))}
        if got.get(i, {}) != want:
            wrong.append((html, got.get(i, {}), want))
    assert wrong == []


def test_no_python_in_the_plan_and_null_pages(spark):
    table = spark.createDataFrame([(1, None), (2, "<div class='courseblock'>x</div>")], "page_id bigint, html string")
    blocks = K.page_blocks(table)
    assert "Pandas" not in blocks._jdf.queryExecution().executedPlan().toString()
    assert [(b.page_id, b["class"], b.title) for b in blocks.collect()] == [(2, "courseblock", None)]
    assert K.page_blocks(table, marker="nothing").count() == 0


def test_titles_and_text_areas_hold_no_markup(spark):
    table = spark.createDataFrame([("<title>a <p> b</title><textarea><div>&amp;</textarea>x",)], "html string")
    found = table.select(events(F.col("html"), BlockShape()).alias("e")).first().e
    assert [(e.kind, e.tag, e.text) for e in found] == [
        ("open", "title", None), ("data", None, "a <p> b"), ("close", "title", None),
        ("open", "textarea", None), ("data", None, "<div>&"), ("close", "textarea", None), ("data", None, "x"),
    ]
