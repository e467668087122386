"""Token ids in files: canonical length-limited Huffman codes from global counts.

Layout: one row per block, blocks in ascending order of document id. A block holds whole documents
(at least one, about ``BLOCK_IDS`` ids otherwise): their ids, their numbers of ids, the bit stream,
and the bit offset of every ``STRIDE``-th id of each document. Each block can be read alone, and
all checkpoints of a block are decoded side by side through one table of ``2 ** limit`` entries.
A code table (one row: length of every id) lies beside the blocks.

The order of rows with equal ids is arbitrary but fixed once written. A null text is empty and
consists of the end id. No documents give no blocks.
"""

from __future__ import annotations

import sys
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpuslink.llm.tokens import END_ID, default_tokenizer, encoder
from corpuslink.llm.wordhash import give_back
from corpuslink.session import discard, shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])

LIMIT = 18
STRIDE = 512
BLOCK_IDS = 1 << 20


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Code lengths of least total under ``limit`` for the ids that occur (package-merge)."""
    used = np.flatnonzero(counts)
    lengths = np.zeros(len(counts), np.uint8)
    if len(used) < 2:
        lengths[used] = 1
        return lengths
    if len(used) > 1 << limit:
        raise ValueError(f"{len(used)} ids do not fit codes of {limit} bits")
    order = used[np.argsort(counts[used], kind="stable")]
    weights = counts[order].astype(np.float64)
    n = len(order)
    # At each level the coins are merged with the packages of the level below; which entries of
    # the merged list are coins is all that the way back needs.
    marks, packages = [], np.empty(0)
    for _ in range(limit):
        merged = np.concatenate([weights, packages])
        by = np.argsort(merged, kind="stable")
        marks.append(by < n)
        merged = merged[by]
        even = len(merged) // 2 * 2
        packages = merged[0:even:2] + merged[1:even:2]
    taken, depth = 2 * n - 2, np.zeros(n, np.int64)
    for coins in reversed(marks):
        chosen = int(coins[:taken].sum())  # the cheapest coins come first
        depth[:chosen] += 1
        taken = 2 * (taken - chosen)
    lengths[order] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id)."""
    codes = np.zeros(len(lengths), np.uint32)
    code = previous = 0
    used = np.flatnonzero(lengths)
    for i in used[np.lexsort((used, lengths[used]))].tolist():
        code <<= int(lengths[i]) - previous
        previous = int(lengths[i])
        codes[i] = code
        code += 1
    return codes


def decode_table(lengths: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """For every window of ``limit`` bits the id it begins with, times 32, plus its length."""
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    sizes = lengths[used].astype(np.int64)
    filled = np.repeat(used.astype(np.int64) * 32 + sizes, np.int64(1) << (limit - sizes))
    return np.pad(filled, (0, (1 << limit) - len(filled)))


def encode(ids: np.ndarray, n_ids: np.ndarray, codes: np.ndarray, lengths: np.ndarray):
    """Streams of several documents: all bytes, bytes of each, bit offsets of checkpoints within
    their document, checkpoints of each."""
    size = lengths[ids].astype(np.int64)
    after = np.cumsum(size)
    edges = np.concatenate([[0], np.cumsum(n_ids)])
    bits = np.diff(np.concatenate([[0], after])[edges])
    n_bytes = (bits + 7) // 8
    shift = 8 * (np.cumsum(n_bytes) - n_bytes) - (np.cumsum(bits) - bits)
    own = np.repeat(np.arange(len(n_ids)), n_ids)
    at = after - size + shift[own]
    value = codes[ids].astype(np.uint64) << (64 - (at & 31) - size).astype(np.uint64)
    word = at >> 5
    out = np.zeros(int(n_bytes.sum()) // 4 + 3, np.uint32)
    if len(ids):
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        both = np.bitwise_or.reduceat(value, first)
        out[word[first]] |= (both >> np.uint64(32)).astype(np.uint32)
        out[word[first] + 1] |= (both & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    within = np.arange(len(ids)) - edges[:-1][own]
    stops = np.flatnonzero(within % STRIDE == 0)
    offsets = at[stops] - 8 * (np.cumsum(n_bytes) - n_bytes)[own[stops]]
    return out.astype(">u4").tobytes()[: int(n_bytes.sum())], n_bytes, offsets, -(-n_ids // STRIDE)


def decode(stream: bytes, starts: np.ndarray, counts: np.ndarray, table: np.ndarray, limit: int = LIMIT):
    """Ids of runs that begin at bit ``starts`` and have ``counts`` ids, one run after the other."""
    data = np.frombuffer(stream + bytes(8), np.uint8).astype(np.uint32)
    window = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    order = np.argsort(-counts, kind="stable")
    place, many = (np.cumsum(counts) - counts)[order], counts[order]
    at = starts[order].astype(np.int64)
    ids = np.empty(int(counts.sum()), np.uint32)
    alive = len(order)
    for step in range(int(many[0]) if len(many) else 0):
        while alive and many[alive - 1] <= step:
            alive -= 1
        at = at[:alive]
        seen = (window[at >> 3] >> (32 - limit - (at & 7)).astype(np.uint32)) & np.uint32((1 << limit) - 1)
        got = table[seen]
        ids[place[:alive] + step] = got >> 5
        at = at + (got & 31)
    return ids


_IDS = "doc_id bigint, n_ids bigint, ids binary"
_CODED = "doc_id bigint, n_ids bigint, checkpoints binary, stream binary"
#: Stands for a null document id inside a block.
_NO_ID = -(1 << 63)


def _tokenised(docs: DataFrame, path: str) -> DataFrame:
    @give_back
    def tokenise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run = encoder(path).encode
        for batch in batches:
            for low, high, ids, n_ids in run(batch["text"]):
                edges = np.cumsum(n_ids)
                ids = np.insert(ids, edges, END_ID).astype("<u4")
                edges = np.concatenate([[0], edges + np.arange(1, len(edges) + 1)])
                if ids.max(initial=0) < 1 << 16:
                    ids = ids.astype("<u2")
                rows = [ids[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"][low:high], pa.array(n_ids + 1, pa.int64()), pa.array(rows, pa.binary())],
                    names=["doc_id", "n_ids", "ids"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(tokenise, _IDS)


def _ids_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    n_ids = batch["n_ids"].to_numpy()
    rows = batch["ids"].to_pylist()
    parts = [np.frombuffer(r, "<u2" if len(r) == 2 * n else "<u4") for r, n in zip(rows, n_ids.tolist())]
    return np.concatenate(parts).astype(np.int64), n_ids


def _small(batch: pa.RecordBatch, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    total = np.cumsum(batch["n_ids"].to_numpy())
    low = 0
    while low < len(total):
        high = max(low + 1, int(np.searchsorted(total, (total[low - 1] if low else 0) + most, side="right")))
        yield batch.slice(low, high - low)
        low = high


def _counts(stored: DataFrame) -> np.ndarray:
    @give_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << 16, np.int64)
        for batch in batches:
            for part in _small(batch):
                own = np.bincount(_ids_of(part)[0], minlength=len(total))
                total = np.pad(total, (0, len(own) - len(total))) + own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["id", "n"])

    summed = stored.mapInArrow(count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    rows = summed.toPandas()  # at most one row per id of the vocabulary
    counts = np.zeros(int(rows["id"].max()) + 1 if len(rows) else 1, np.int64)
    counts[rows["id"].to_numpy(np.int64)] = rows["n"].to_numpy(np.int64)
    return counts


_BLOCK = (
    "file int, block int, before bigint, n_ids bigint, first_doc bigint, docs binary, sizes binary, "
    "checkpoints binary, stream binary"
)


def write_ids(docs: DataFrame, folder: str, tokenizer: str | None = None, limit: int = LIMIT) -> None:
    """Encode every whole text and write blocks and code table below ``folder``."""
    spark = docs.sparkSession
    path = tokenizer or default_tokenizer()
    ids_at, coded_at = shared_folder(spark, "ids"), shared_folder(spark, "coded")
    _tokenised(docs, path).write.option("compression", "zstd").parquet(ids_at)
    stored = spark.read.schema(_IDS).parquet(ids_at)
    lengths = code_lengths(_counts(stored), limit)
    codes = canonical_codes(lengths)

    @give_back
    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _small(batch):
                ids, n_ids = _ids_of(part)
                stream, n_bytes, offsets, stops = encode(ids, n_ids, codes, lengths)
                a, b = np.concatenate([[0], np.cumsum(n_bytes)]), np.concatenate([[0], np.cumsum(stops)])
                marks = offsets.astype("<i8")
                yield pa.RecordBatch.from_arrays(
                    [
                        part["doc_id"],
                        part["n_ids"],
                        pa.array([marks[x:y].tobytes() for x, y in zip(b[:-1], b[1:])], pa.binary()),
                        pa.array([stream[x:y] for x, y in zip(a[:-1], a[1:])], pa.binary()),
                    ],
                    names=["doc_id", "n_ids", "checkpoints", "stream"],
                )

    stored.mapInArrow(coded, _CODED).write.option("compression", "uncompressed").parquet(coded_at)
    discard(spark, ids_at)

    @give_back
    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, no, before, held = TaskContext.get().partitionId(), 0, 0, []

        def row():
            sizes = np.array([r[1] for r in held], "<i8")
            bytes_before = np.cumsum([0] + [len(r[3]) for r in held])[:-1]
            marks = [np.frombuffer(r[2], "<i8") + 8 * at for r, at in zip(held, bytes_before)]
            return {
                "file": file, "block": no, "before": before, "n_ids": int(sizes.sum()), "first_doc": held[0][0],
                "docs": np.array([_NO_ID if r[0] is None else r[0] for r in held], "<i8").tobytes(),
                "sizes": sizes.tobytes(),
                "checkpoints": np.concatenate(marks).astype("<i8").tobytes(),
                "stream": b"".join(r[3] for r in held),
            }

        schema = pa.schema(
            [("file", pa.int32()), ("block", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()),
             ("first_doc", pa.int64()), ("docs", pa.binary()), ("sizes", pa.binary()),
             ("checkpoints", pa.binary()), ("stream", pa.binary())]
        )
        total = 0
        for batch in batches:
            for r in zip(*(batch[c].to_pylist() for c in ("doc_id", "n_ids", "checkpoints", "stream"))):
                if held and total + r[1] > BLOCK_IDS:
                    yield pa.RecordBatch.from_pylist([row()], schema=schema)
                    no, before, held, total = no + 1, before + total, [], 0
                held.append(r)
                total += r[1]
        if held:
            yield pa.RecordBatch.from_pylist([row()], schema=schema)

    ordered = (
        spark.read.schema(_CODED).parquet(coded_at)
        .withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange("doc_id", "_row")
        .sortWithinPartitions("doc_id", "_row")
        .drop("_row")
    )
    ordered.mapInArrow(block, _BLOCK).write.option("compression", "uncompressed").parquet(f"{folder}/blocks")
    discard(spark, coded_at)
    spark.createDataFrame([(limit, bytearray(lengths.tobytes()))], "code_limit int, lengths binary").coalesce(
        1
    ).write.parquet(f"{folder}/codes")


def read_ids(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Decoded documents: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens``,
    ``ids_crc32`` and, if asked for, ``ids``."""
    blocks = spark.read.schema(_BLOCK).parquet(f"{folder}/blocks")
    code = spark.read.parquet(f"{folder}/codes").first()
    table = decode_table(np.frombuffer(bytes(code["lengths"]), np.uint8), code["code_limit"])
    limit = code["code_limit"]
    # One row per file: where its ids begin.
    files = blocks.groupBy("file").agg(F.sum("n_ids").alias("n"), F.min("first_doc").alias("first"))
    begins = files.select(
        "file", (F.sum("n").over(Window.orderBy("first", "file")) - F.col("n")).alias("file_begin")
    )
    schema = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<int>" * with_ids

    @give_back
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                docs, sizes = np.frombuffer(r["docs"], "<i8"), np.frombuffer(r["sizes"], "<i8")
                stops = -(-sizes // STRIDE)
                nth = np.arange(stops.sum()) - np.repeat(np.cumsum(stops) - stops, stops)
                counts = np.minimum(STRIDE, np.repeat(sizes, stops) - nth * STRIDE)
                ids = decode(r["stream"], np.frombuffer(r["checkpoints"], "<i8"), counts, table, limit)
                raw, edges = ids.astype("<u4").tobytes(), np.concatenate([[0], np.cumsum(sizes)])
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
                columns = [
                    pa.array(docs, mask=docs == _NO_ID), pa.array(r["file_begin"] + r["before"] + edges[:-1]), pa.array(sizes),
                    pa.array(crc, pa.int64()),
                ]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(ids.astype(np.int32))))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return blocks.join(begins, "file").select(*blocks.columns, "file_begin").mapInArrow(read, schema)
