"""What counts as a block of a page."""

from __future__ import annotations

from dataclasses import dataclass

# Elements without content, and those that end an open paragraph.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
CLOSES_P = set(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
    "nav ol p pre section table ul".split()
)


@dataclass(frozen=True)
class BlockShape:
    """Which elements are blocks and where their title and description are.

    ``title`` and ``desc`` are (tag, class) pairs, class ``None`` accepts any; ``desc=None``
    takes the text of the whole block.
    """

    tag: str = "div"
    title: tuple[str, str | None] = ("p", "courseblocktitle")
    desc: tuple[str, str | None] | None = ("p", "courseblockdesc")
