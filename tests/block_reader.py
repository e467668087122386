"""Brute force: blocks of one page by the standard library's parser and a stack."""

from __future__ import annotations

from dataclasses import dataclass, field
from html.parser import HTMLParser

from corpuslink.functions.html_blocks import CLOSES_P, VOID, BlockShape


@dataclass
class _Open:
    tag: str
    block: dict | None = None
    texts: list = field(default_factory=list)
    after_block: str | None = None


class _BlockReader(HTMLParser):
    def __init__(self, shape: BlockShape):
        super().__init__(convert_charrefs=True)
        self.shape = shape
        self.stack = [_Open("")]
        self.blocks: list[dict] = []
        self.sinks: list[list[str]] = []

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P and any(e.tag == "p" for e in self.stack):
            self._close("p")
        classes = dict(attrs).get("class") or ""
        parent = self.stack[-1]
        gap, parent.after_block = parent.after_block, None
        if tag in VOID:
            return
        element = _Open(tag)
        if tag == self.shape.tag:
            element.block = {
                "class": classes,
                "prev_adjacent": gap == "",
                "prev_blank": gap is not None and gap.strip() == "",
                "title": None,
                "desc": None,
            }
            self.blocks.append(element.block)
            if self.shape.desc is None:
                element.block["desc"] = []
                element.texts.append(element.block["desc"])
        for part, wanted in (("title", self.shape.title), ("desc", self.shape.desc)):
            if wanted and tag == wanted[0] and (wanted[1] is None or wanted[1] in (classes, *classes.split())):
                for outer in self.stack:
                    if outer.block is not None and outer.block[part] is None:
                        outer.block[part] = []
                        element.texts.append(outer.block[part])
        self.sinks += element.texts
        self.stack.append(element)

    def handle_endtag(self, tag):
        self._close(tag)

    def _close(self, tag):
        if not any(e.tag == tag for e in self.stack[1:]):
            return
        while True:
            element = self.stack.pop()
            for sink in element.texts:
                self.sinks = [s for s in self.sinks if s is not sink]
            self.stack[-1].after_block = "" if element.block is not None else None
            if element.tag == tag:
                return

    def handle_data(self, data):
        top = self.stack[-1]
        if top.after_block is not None:
            top.after_block += data
        if top.tag not in ("script", "style"):
            for sink in self.sinks:
                sink.append(data)

    def handle_comment(self, data):
        self.stack[-1].after_block = None


def blocks_of(html: str, shape: BlockShape) -> list[dict]:
    """Blocks of a page in document order with class, title, desc and what precedes them."""
    reader = _BlockReader(shape)
    reader.feed(html)
    reader.close()
    for block in reader.blocks:
        for part in ("title", "desc"):
            if block[part] is not None:
                block[part] = "".join(block[part])
    return reader.blocks
