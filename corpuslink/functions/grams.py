"""Character grams over circular text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Characters a row holds at most while its grams are read.
PIECE_CHARS = 1 << 16


def circular_pieces(text: Column, k: int, piece_chars: int = PIECE_CHARS, before: Column | None = None) -> Column:
    """``text`` in consecutive pieces, each with the k characters before it in front; before the
    first ones stands the end of the text (or ``before``). The pieces' grams are those of the text
    as a ring. Texts shorter than k give nothing."""
    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{max(k, piece_chars)}}}"), F.lit(0))
    first = F.right(text, F.lit(k)) if before is None else before
    led = F.zip_with(
        pieces,
        F.concat(F.array(first), F.transform(pieces, lambda p: F.right(p, F.lit(k)))),
        lambda piece, lead: F.when(piece.isNotNull(), F.concat(lead, piece)),
    )
    whole = F.filter(led, lambda p: p.isNotNull())
    return F.when(F.char_length(text) >= k, whole) if before is None else whole


def piece_grams(piece: Column, k: int) -> Column:
    """The grams of length k+1 at every position of ``piece`` (in no particular order).

    Starting at each of the first k+1 positions, the piece is cut into consecutive parts of k+1
    characters; together these are all its grams. Every pass is linear and stays in one expression
    without lambdas.
    """
    passes = [
        F.regexp_extract_all(
            F.substring(piece, F.lit(start + 1), F.char_length(piece)), F.lit(f"(?s).{{{k + 1}}}"), F.lit(0)
        )
        for start in range(k + 1)
    ]
    return F.flatten(F.array(*passes))


def circular_grams(text: Column, k: int) -> Column:
    """All grams of a short text as one array; long texts go through :func:`circular_pieces`."""
    return F.when(F.char_length(text) >= k, piece_grams(F.concat(F.right(text, F.lit(k)), text), k))


def context_of(gram: Column, k: int) -> Column:
    """First k characters of a gram."""
    return F.left(gram, F.lit(k))


def smoothed_log(n_seq: Column, n_ctx: Column, alphabet: Column) -> Column:
    """Add-one smoothed log probability of a gram given its context."""
    return F.log((n_seq + 1) / (n_ctx + alphabet))
