"""Exact top-k inner products by descending length with rotated partial sums.

Vectors are turned into integers once. The rotation comes from the eigenvectors of their summed
outer products (the right singular vectors of all data), so the first coordinates carry most of
every vector. All vectors are sorted by length into slabs. Queries are taken in blocks, get a first
threshold from the slab of the longest vectors, and then meet every slab: within it, runs of vectors
in order of descending length are skipped once length times length falls below all thresholds; a
vector is dropped for a query when its partial product plus the product of the remaining lengths
(Cauchy-Schwarz) stays below the threshold; only the rest is scored, in integers. Bounds carry a
margin for rounding, so nothing is lost.

Slabs and query blocks have bounded sizes; what a task holds is one of each. The driver sees the
square matrix of outer products and one slab.

Vectors that are null, empty or hold null or non-finite components take no part. Vectors shorter
than the longest one are filled up with zeros. A query meets all rows but those with its own id;
repeated candidate rows each count, a repeated query is answered once per row. Other columns are
not read. No vectors, no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslink.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SLAB = 4096
RUN = 512
QUERY_BLOCK = 2048


def integer_vectors(table: DataFrame, id_column: str, vector_column: str, scale: int = 1024) -> DataFrame:
    """``vec_id`` and ``v`` (floor of scaled components) of the usable vectors."""
    x = F.col(vector_column)
    usable = x.isNotNull() & (F.size(x) > 0)
    usable &= F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return table.where(F.col(id_column).isNotNull() & F.coalesce(usable, F.lit(False))).select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.transform(x, lambda c: F.floor(scale * c.cast("double"))).alias("v"),
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column as int64, filled up to ``width``."""
    flat = column.flatten().to_numpy()
    sizes = column.value_lengths().to_numpy()
    if (sizes == width).all():
        return flat.reshape(-1, width).astype(np.int64)
    out = np.zeros((len(sizes), width), np.int64)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return out


def rotation(vectors: DataFrame, width: int) -> np.ndarray:
    """Orthogonal matrix whose columns are the principal directions, strongest first."""

    def outer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            m = _matrix(batch["v"], width).astype(float)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width * width)), pa.array(total.ravel())], names=["cell", "x"])

    cells = vectors.select("v").mapInArrow(outer, "cell bigint, x double").groupBy("cell").agg(F.sum("x").alias("x"))
    found = cells.toPandas()  # width * width rows
    total = np.zeros(width * width)
    total[found["cell"].to_numpy()] = found["x"].to_numpy()
    _, directions = np.linalg.eigh(total.reshape(width, width))
    return directions[:, ::-1]


_BLOCK = "block bigint, longest double, ids binary, v binary"


def _blocked(sorted_rows: DataFrame, width: int, size: int) -> DataFrame:
    """Runs of up to ``size`` rows of each partition as one row of bytes; numbered apart."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, longest = [], [], []

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([0]), pa.array([max(longest)]), pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                 pa.array([np.concatenate(parts).tobytes()], pa.binary())],
                names=["block", "longest", "ids", "v"],
            )

        for batch in batches:
            m = _matrix(batch["v"], width)
            low = 0
            while low < len(m):
                take = min(len(m) - low, size - sum(map(len, ids)))
                ids.append(batch["vec_id"].to_numpy()[low : low + take])
                parts.append(m[low : low + take])
                longest.append(float(np.sqrt((parts[-1].astype(float) ** 2).sum(axis=1).max())))
                low += take
                if sum(map(len, ids)) == size:
                    yield row()
                    ids, parts, longest = [], [], []
        if ids:
            yield row()

    return sorted_rows.mapInArrow(gather, _BLOCK).withColumn("block", F.monotonically_increasing_id())


def _opened(ids: bytes, v: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(ids, np.int64), np.frombuffer(v, np.int64).reshape(-1, width)


class Searcher:
    """Best ``k`` of one slab for the queries of one block, given what they have already."""

    def __init__(self, turn: np.ndarray, k: int, head: int):
        self.turn, self.k, self.head = turn, k, head

    def search(self, query_ids, queries, thresholds, ids, vectors):
        """Rows (query row, vector row, score) that are among the k best of this slab and not below
        the thresholds. A threshold is a score that k other vectors are known to reach."""
        q, x = queries @ self.turn, vectors @ self.turn
        q_len, x_len = np.sqrt((q * q).sum(1)), np.sqrt((x * x).sum(1))
        q_tail = np.sqrt((q[:, self.head :] ** 2).sum(1))
        x_tail = np.sqrt((x[:, self.head :] ** 2).sum(1))
        order = np.lexsort((ids, -x_len))
        thresholds = thresholds.copy()
        kept = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
        for low in range(0, len(order), RUN):
            run = order[low : low + RUN]
            margin = 1e-9 * q_len * x_len[run[0]] + 1e-6
            active = np.flatnonzero(q_len * x_len[run[0]] + margin >= thresholds)
            if not len(active):
                if (q_len * x_len[run].min() < thresholds).all():
                    break
                continue
            bound = q[active, : self.head] @ x[run, : self.head].T + np.outer(q_tail[active], x_tail[run])
            maybe = bound + margin[active, None] >= thresholds[active, None]
            maybe &= query_ids[active, None] != ids[run][None, :]
            a, b = np.nonzero(maybe)
            if not len(a):
                continue
            a, b = active[a], run[b]
            score = np.concatenate(
                [np.einsum("ij,ij->i", queries[a[i : i + 65536]], vectors[b[i : i + 65536]]) for i in range(0, len(a), 65536)]
            )
            keep = score >= thresholds[a]
            kept = tuple(np.concatenate([old, new[keep]]) for old, new in zip(kept, (a, b, score)))
            by = np.lexsort((ids[kept[1]], -kept[2], kept[0]))
            kept = tuple(c[by] for c in kept)
            first = np.searchsorted(kept[0], kept[0])
            rank = np.arange(len(first)) - first
            full = rank == self.k - 1
            thresholds[kept[0][full]] = np.maximum(thresholds[kept[0][full]], kept[2][full])
            kept = tuple(c[rank < self.k] for c in kept)
        return kept


def top_k(vectors: DataFrame, is_query: Column, k: int = 10) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` best of ``vectors`` (``vec_id``,
    ``v``) for each row that ``is_query`` picks."""
    spark = vectors.sparkSession
    stored = cut_lineage(
        vectors.withColumn("norm", F.aggregate("v", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double")))
    )
    seen = stored.agg(F.max(F.size("v")), F.count("*"), F.count(F.when(is_query, 1))).first()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not seen[2] or seen[1] < 2:
        return spark.createDataFrame([], schema)
    width = seen[0]
    turn = rotation(stored, width)
    head = max(1, width // 4)
    slabs = cut_lineage(
        _blocked(
            stored.repartitionByRange(F.desc("norm"), "vec_id").sortWithinPartitions(F.desc("norm"), "vec_id"), width, SLAB
        )
    )
    longest = slabs.orderBy(F.desc("longest"), "block").first()  # one slab
    first_ids, first_v = _opened(longest["ids"], longest["v"], width)
    searcher = Searcher(turn, k, head)
    blocks = max(1, -(-seen[2] // QUERY_BLOCK))
    asked = stored.where(is_query).repartition(blocks, "vec_id")
    queries = _blocked(asked, width, QUERY_BLOCK)

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                ids, v = _opened(r["ids"], r["v"], width)
                none = np.full(len(ids), -np.inf)
                rows, _, score = searcher.search(ids, v, none, first_ids, first_v)
                first = np.searchsorted(rows, np.arange(len(ids)))
                last = np.searchsorted(rows, np.arange(len(ids)), side="right")
                none[last - first == k] = score[last[last - first == k] - 1]
                yield pa.RecordBatch.from_pylist([r | {"least": none.tobytes()}])

    queries = cut_lineage(queries.mapInArrow(start, f"{_BLOCK}, least binary"))
    numbers = queries.select("block").distinct()
    pairs = (
        slabs.drop("block", "longest")
        .withColumn("block", F.explode(F.lit([r[0] for r in numbers.collect()])))  # one number per query block
        .join(queries.select("block", F.col("ids").alias("q_ids"), F.col("v").alias("q_v"), "least"), "block")
    )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch[c][i].as_py() for c in ("ids", "v", "q_ids", "q_v", "least")}
                ids, v = _opened(r["ids"], r["v"], width)
                q_ids, q_v = _opened(r["q_ids"], r["q_v"], width)
                a, b, score = searcher.search(q_ids, q_v, np.frombuffer(r["least"]), ids, v)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(q_ids[a]), pa.array(ids[b]), pa.array(score), pa.array(a), pa.array(np.full(len(a), batch["block"][i].as_py()))],
                    names=["query_id", "vec_id", "score", "place", "block"],
                )

    found = pairs.select("ids", "v", "q_ids", "q_v", "least", "block").mapInArrow(
        meet, "query_id bigint, vec_id bigint, score bigint, place bigint, block bigint"
    )
    best = Window.partitionBy("query_id", "block", "place").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
