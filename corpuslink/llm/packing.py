"""Packing of examples into sequences under several limits at once.

Vector bin packing with the dot-product heuristic: an example is a vector of demands (tokens,
segments, loss-bearing tokens), a sequence a vector of limits. An open sequence takes, of all
examples that still fit, the one whose demands have the largest inner product with what is left,
both as shares of the limits; when none fits, the next sequence opens.

Examples are dealt by hash into groups of bounded size that are packed independently, so nothing
is gathered beyond one group; a group leaves at most one badly filled sequence.

Documents are cut into pieces of ``max_tokens`` and a rest. A full piece is a sequence of its own,
rests are packed. Null or empty texts are the end id alone. Repeated rows are packed as often as
they occur. Columns other than ``doc_id`` and ``text`` are not read. No rows give no rows.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslink.llm.tokens import END_ID, default_tokenizer, encoder
from corpuslink.llm.wordhash import give_back
from corpuslink.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

GROUP_ITEMS = 8192
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def place(demands: np.ndarray, limits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence of each example and its place in the order of filling.

    Equal demands are interchangeable, so the search runs over the distinct ones."""
    kinds, kind_of = np.unique(demands, axis=0, return_inverse=True)
    kind_of = kind_of.reshape(-1)
    members = np.argsort(kind_of, kind="stable")
    next_of = np.searchsorted(kind_of[members], np.arange(len(kinds)))
    left = np.bincount(kind_of, minlength=len(kinds))
    shares = kinds / limits
    sequence = np.empty(len(demands), np.int64)
    turn = np.empty(len(demands), np.int64)
    room, now = limits.astype(np.int64).copy(), 0
    for step in range(len(demands)):
        fits = (left > 0) & (kinds <= room).all(axis=1)
        if not fits.any():
            room, now = limits.astype(np.int64).copy(), now + 1
            fits = left > 0
        best = int(np.argmax(np.where(fits, shares @ (room / limits), -1.0)))
        item = members[next_of[best]]
        next_of[best] += 1
        left[best] -= 1
        room = room - kinds[best]
        sequence[item], turn[item] = now, step
    return sequence, turn


def pack_examples(examples: DataFrame, limits: dict[str, int], group_items: int = GROUP_ITEMS) -> DataFrame:
    """``examples`` with ``sequence_id`` and ``offset`` (of the first limited column).

    ``limits`` maps demand columns to their limits; the first is the one that offsets count. No
    example may exceed a limit; a null demand counts as 0. Columns ``sequence_id`` and ``offset`` that
    ``examples`` has already are replaced; all others are kept, whatever their names. ``examples``
    should be a stored table: it is counted first."""
    names = list(limits)
    if {"sequence_id", "offset"} & {n.lower() for n in names}:
        raise ValueError("a demand must not be named sequence_id or offset")
    examples = examples.drop("sequence_id", "offset")
    row_name, group_name = "_row", "_group"
    while {row_name, group_name} & {c.lower() for c in examples.columns}:
        row_name, group_name = "_" + row_name, "_" + group_name
    bounds = np.array([limits[n] for n in names], np.int64)
    groups = max(1, -(-examples.count() // group_items))
    schema = T.StructType([*examples.schema.fields, *T.StructType.fromDDL("sequence_id bigint, offset bigint").fields])
    dealt = examples.withColumn(row_name, F.monotonically_increasing_id()).withColumn(
        group_name, F.pmod(F.xxhash64(row_name), F.lit(groups))
    )

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by(row_name)
        demands = np.stack([table[n].fill_null(0).to_numpy().astype(np.int64) for n in names], axis=1)
        if (demands > bounds).any():
            raise ValueError(f"an example exceeds the limits {limits}")
        sequence, turn = place(demands, bounds)
        order = np.lexsort((turn, sequence))
        size = demands[order, 0]
        before = np.cumsum(size) - size
        opens = np.concatenate([[True], np.diff(sequence[order]) > 0])
        offset = np.empty(len(order), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(opens, before, 0))
        ids = ((table[group_name].to_numpy().astype(np.int64) << 24) | sequence) * 2
        table = table.drop_columns([row_name, group_name])
        return table.append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset))

    return dealt.groupBy(group_name).applyInArrow(pack, schema)


def cut_documents(docs: DataFrame, max_tokens: int, tokenizer: str | None = None) -> DataFrame:
    """One row per piece of every document: ids from ``start``, ``length`` of them, their CRC-32
    and the tokens of the whole document with its end id."""
    path = tokenizer or default_tokenizer()

    @give_back
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for batch in batches:
            for low, high, ids, lengths in encode(batch["text"]):
                rows, at = [], 0
                for doc_id, n in zip(batch["doc_id"][low:high].to_pylist(), lengths.tolist()):
                    own = np.append(ids[at : at + n], END_ID).astype("<u4").tobytes()
                    at += n
                    for start in range(0, n + 1, max_tokens):
                        piece = own[4 * start : 4 * (start + max_tokens)]
                        rows.append((doc_id, start, len(piece) // 4, zlib.crc32(piece), n + 1))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
                )

    return docs.select("doc_id", "text").mapInArrow(cut, PIECES)


def pack_documents(
    docs: DataFrame,
    max_tokens: int = 1024,
    max_segments: int = 128,
    max_loss_tokens: int | None = None,
    tokenizer: str | None = None,
) -> DataFrame:
    """Pieces of all documents with the sequence and offset each is placed at. In plain text every
    id bears loss, so the limit on these is that of the tokens unless another is given; it also
    bounds the pieces."""
    loss = min(max_tokens, max_loss_tokens or max_tokens)
    pieces = cut_lineage(cut_documents(docs, loss, tokenizer))
    full = F.col("length") == max_tokens
    alone = pieces.where(full).select(
        "*", (F.monotonically_increasing_id() * 2 + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rests = pieces.where(~full).select(
        "*", F.lit(1).cast("long").alias("_segments"), F.col("length").alias("_loss_tokens")
    )
    packed = pack_examples(
        rests, {"length": max_tokens, "_segments": max_segments, "_loss_tokens": loss}
    ).drop("_segments", "_loss_tokens")
    return alone.unionByName(packed)
