"""Blocks of a page as Column expressions: the page as an array of events, folded with a stack.

A page is cut into comments, elements whose content is raw, tags and text. Each becomes an event:
``open``, ``close``, ``void``, ``data`` or ``gap`` (a comment). The fold keeps the open elements and
the blocks found so far; of a block it keeps the places of the events in which its title and
description begin and end, so texts are put together once, after the fold. A paragraph left open ends
where an element begins that cannot stand in it; an end tag closes what is open inside its element.
The content of scripts and styles is no text, that of titles and text areas no markup. Of named
character references those of HTML 4 with a semicolon are read.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuslink.functions.html_blocks import CLOSES_P, VOID, BlockShape
from corpuslink.functions.markup import ATTRIBUTE, INSIDE, VALUE, unescape

_PIECE = (
    r"(?is)<!--.*?(?:--!?>|\z)"
    rf"|<(script|style|textarea|title)(?=[\s/>]){INSIDE}>.*?(?:</\1\s*>|\z)"
    rf"|<[a-z][^\s/>]*+{INSIDE}>"
    r"|</[a-z][^>]*+>|<[!?/][^>]*+>|[^<]++|<"
)
_TAG = r"(?s)^<([a-zA-Z][^\s/>]*+)"
_END = r"(?s)^</([a-zA-Z][^\s/>]*+)"
_RAW = rf"(?is)^<(script|style|textarea|title)(?=[\s/>]){INSIDE}>"
_RAW_END = r"(?is)</(?:script|style|textarea|title)\s*>$"
_SELF_CLOSED = rf"(?is)^<[a-z][^\s/>]*+(?:\s++|/(?!>)|{ATTRIBUTE})*+/>$"
_CLASS = rf"(?is)^class\s*+=[\s=]*+({VALUE})"

_STACK = "array<struct<tag:string,after:int,block:int,titles:array<int>,descs:array<int>>>"
_BLOCKS = "array<struct<class:string,adjacent:boolean,blank:boolean,t0:int,t1:int,d0:int,d1:int>>"
# What stands between a closed block and the next tag: nothing, blanks, other text.
_NOTHING, _BLANKS, _TEXT = 1, 2, 3


def _event(kind: str, tag: Column | None = None, classes: Column | None = None, text: Column | None = None) -> Column:
    void = F.lit(None).cast("string")
    parts = {"tag": tag, "class": classes, "text": text}
    return F.struct(F.lit(kind).alias("kind"), *[(void if c is None else c).alias(n) for n, c in parts.items()])


def _one_of(tag: Column, names: set[str]) -> Column:
    """One pattern instead of a literal per name: the plan is made and read faster."""
    return tag.rlike(rf"\A(?:{'|'.join(sorted(names))})\z")


def _class_of(start_tag: Column) -> Column:
    """Value of the last class attribute, empty without one."""
    inside = F.regexp_replace(start_tag, _TAG, "")
    found = F.filter(F.regexp_extract_all(inside, F.lit(f"(?is){ATTRIBUTE}"), F.lit(0)), lambda a: a.rlike(r"(?is)^class(?:\s*+=.*)?+$"))
    value = F.regexp_extract(F.element_at(found, -1), _CLASS, 1)
    plain = F.regexp_replace(value, r"""(?s)^(["'])(.*)\1$""", "$2")
    return F.when(F.size(found) > 0, unescape(plain)).otherwise("")


def events(html: Column, shape: BlockShape) -> Column:
    """The page as an array of ``(kind, tag, class, text)``; classes are read of the tags that the
    shape names."""
    named = {shape.tag, shape.title[0], *([shape.desc[0]] if shape.desc else [])}

    def started(piece: Column, tag: Column) -> Column:
        classes = F.when(_one_of(tag, named), _class_of(piece))
        opened = F.when(
            _one_of(tag, CLOSES_P), F.array(_event("close", F.lit("p")), _event("open", tag, classes))
        ).otherwise(F.array(_event("open", tag, classes)))
        closed = F.array(_event("close", tag))
        content = F.regexp_replace(F.regexp_replace(piece, _RAW, ""), _RAW_END, "")
        shown = F.when(tag.isin("textarea", "title") & (content != ""), F.array(_event("data", text=unescape(content))))
        ended = F.when(piece.rlike(_RAW_END), closed)
        none = F.slice(closed, 1, 0)
        is_p = F.array(_event("close", F.lit("p")))
        return (
            F.when(tag.isin("script", "style", "textarea", "title"), F.concat(opened, F.coalesce(shown, none), F.coalesce(ended, none)))
            .when(
                _one_of(tag, VOID),
                F.concat(F.when(_one_of(tag, CLOSES_P & VOID), is_p).otherwise(none), F.array(_event("void", tag))),
            )
            .when(piece.endswith("/>") & piece.rlike(_SELF_CLOSED), F.concat(opened, closed))
            .otherwise(opened)
        )

    def read(piece: Column, tag: Column, ended: Column) -> Column:
        return (
            F.when(tag != "", started(piece, tag))
            .when(ended != "", F.array(_event("close", ended)))
            .when(~piece.startswith("<") | (piece == "<"), F.array(_event("data", text=unescape(piece))))
            .when(piece.startswith("<!--"), F.array(_event("gap")))
            .otherwise(F.slice(F.array(_event("gap")), 1, 0))
        )

    # Names are read once per piece; the second pass uses them several times.
    pieces = F.transform(
        F.regexp_extract_all(F.coalesce(html, F.lit("")), F.lit(_PIECE), F.lit(0)),
        lambda p: F.struct(
            p.alias("piece"), F.lower(F.regexp_extract(p, _TAG, 1)).alias("tag"), F.lower(F.regexp_extract(p, _END, 1)).alias("ended")
        ),
    )
    return F.flatten(F.transform(pieces, lambda p: read(p["piece"], p["tag"], p["ended"])))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _element(tag: Column, after: Column, block: Column, titles: Column, descs: Column) -> Column:
    return F.struct(
        tag.alias("tag"), after.cast("int").alias("after"), block.cast("int").alias("block"), titles.alias("titles"), descs.alias("descs")
    )


def _with_after(stack: Column, after: Column) -> Column:
    """The stack with what follows the innermost element's last block."""
    top = F.element_at(stack, -1)
    changed = _element(top["tag"], after, top["block"], top["titles"], top["descs"])
    return F.concat(F.slice(stack, F.lit(1), F.size(stack) - 1), F.array(changed))


def _state(at: Column, stack: Column, found: Column) -> Column:
    return F.struct((at + 1).alias("at"), stack.alias("stack"), found.alias("found"))


def _block(block: Column, **changed: Column) -> Column:
    names = ("class", "adjacent", "blank", "t0", "t1", "d0", "d1")
    return F.struct(*[changed.get(n, block[n]).alias(n) for n in names])


def _fold(shape: BlockShape):
    none = F.lit(None).cast("int")
    nobody = F.array().cast("array<int>")

    def fits(event: Column, part: tuple[str, str | None] | None) -> Column:
        if part is None:
            return F.lit(False)
        tag, wanted = part
        if wanted is None:
            return event["tag"] == tag
        words = F.split(event["class"], r"(?U)\s+")
        return (event["tag"] == tag) & ((event["class"] == wanted) | F.array_contains(words, wanted))

    def opened(state: Column, event: Column) -> Column:
        at, stack, found = state["at"], state["stack"], state["found"]
        gap = F.element_at(stack, -1)["after"]
        outer = F.filter(F.transform(stack, lambda e: e["block"]), lambda b: b >= 0)
        lacks = lambda name: F.filter(outer, lambda b: F.get(found, b)[name].isNull())
        is_title, is_desc, is_block = fits(event, shape.title), fits(event, shape.desc), event["tag"] == shape.tag
        begun = F.struct(
            event["class"].alias("class"),
            F.coalesce(gap == _NOTHING, F.lit(False)).alias("adjacent"),
            F.coalesce(gap.isin(_NOTHING, _BLANKS), F.lit(False)).alias("blank"),
            none.alias("t0"),
            none.alias("t1"),
            (at if shape.desc is None else none).alias("d0"),
            none.alias("d1"),
        )

        def taking(parts: Column) -> Column:
            """The next state for an element that opens a part of some blocks, or is a block."""
            titles, descs = parts["titles"], parts["descs"]
            taken = lambda block, place: _block(
                block,
                t0=F.when(F.array_contains(titles, place), at).otherwise(block["t0"]),
                d0=F.when(F.array_contains(descs, place), at).otherwise(block["d0"]),
            )
            marked = F.when((F.size(titles) > 0) | (F.size(descs) > 0), F.transform(found, taken)).otherwise(found)
            element = _element(event["tag"], none, F.when(is_block, F.size(found)).otherwise(-1), titles, descs)
            return _state(
                at,
                F.concat(_with_after(stack, none), F.array(element)),
                F.when(is_block, F.concat(marked, F.array(begun))).otherwise(marked),
            )

        plain = _state(at, F.concat(_with_after(stack, none), F.array(_element(event["tag"], none, F.lit(-1), nobody, nobody))), found)
        parts = F.struct(
            F.when(is_title, lacks("t0")).otherwise(nobody).alias("titles"), F.when(is_desc, lacks("d0")).otherwise(nobody).alias("descs")
        )
        return F.when(is_title | is_desc | is_block, _let(parts, taking)).otherwise(plain)

    def closed(state: Column, event: Column) -> Column:
        at, stack, found = state["at"], state["stack"], state["found"]
        whole_block = shape.desc is None

        def popped(back: Column) -> Column:
            """The next state when the ``back`` innermost elements close."""

            def ended(ends: Column) -> Column:
                done = lambda block, place: _block(
                    block,
                    t1=F.when(F.array_contains(ends["titles"], place), at).otherwise(block["t1"]),
                    d1=F.when(F.array_contains(ends["descs"], place), at).otherwise(block["d1"]),
                )
                return F.when((F.size(ends["titles"]) > 0) | (F.size(ends["descs"]) > 0), F.transform(found, done)).otherwise(found)

            gone = F.slice(stack, F.size(stack) - back + 1, back)
            blocks_of_gone = F.filter(F.transform(gone, lambda e: e["block"]), lambda b: b >= 0)
            ends = F.struct(
                F.flatten(F.transform(gone, lambda e: e["titles"])).alias("titles"),
                (blocks_of_gone if whole_block else F.flatten(F.transform(gone, lambda e: e["descs"]))).alias("descs"),
            )
            after = F.when(F.get(stack, F.size(stack) - back)["block"] >= 0, F.lit(_NOTHING))
            left = _let(F.slice(stack, F.lit(1), F.size(stack) - back), lambda rest: _with_after(rest, after))
            return F.when(back > 0, _state(at, left, _let(ends, ended))).otherwise(_state(at, stack, found))

        # The root has an empty tag, which no event has.
        tags = F.transform(stack, lambda e: e["tag"])
        return _let(F.array_position(F.reverse(tags), event["tag"]).cast("int"), popped)

    def said(state: Column, event: Column) -> Column:
        stack = state["stack"]
        after = F.element_at(stack, -1)["after"]
        blank = event["text"].rlike(r"(?U)^[\s\x1c-\x1f]*$")
        now = F.when(blank & (after < _TEXT), _BLANKS).otherwise(_TEXT)
        return F.when(after.isNull(), _state(state["at"], stack, state["found"])).otherwise(
            _state(state["at"], _with_after(stack, now), state["found"])
        )

    def step(state: Column, event: Column) -> Column:
        kind = event["kind"]
        return (
            F.when(kind == "data", said(state, event))
            .when(kind == "open", opened(state, event))
            .when(kind == "close", closed(state, event))
            .otherwise(_state(state["at"], _with_after(state["stack"], none), state["found"]))
        )

    return step


def blocks(page_events: Column, shape: BlockShape) -> Column:
    """Blocks in document order as ``(class, adjacent, blank, t0, t1, d0, d1)``: the events, counted
    from 0, in which title and description begin and end (null: with the page)."""
    root = _element(
        F.lit(""), F.lit(None), F.lit(-1), F.array().cast("array<int>"), F.array().cast("array<int>")
    )
    start = F.struct(
        F.lit(0).alias("at"), F.array(root).cast(_STACK).alias("stack"), F.array().cast(_BLOCKS).alias("found")
    )
    return F.aggregate(page_events, start, _fold(shape), lambda state: state["found"])


def text_between(page_events: Column, first: Column, last: Column) -> Column:
    """Text of the events from ``first`` up to ``last`` (null: the last one); null without a first."""
    n = F.coalesce(last, F.size(page_events)) - first
    inside = F.filter(F.slice(page_events, first + 1, n), lambda e: e["kind"] == "data")
    return F.when(first.isNotNull(), F.array_join(F.transform(inside, lambda e: e["text"]), ""))
