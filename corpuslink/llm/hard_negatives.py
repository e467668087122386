"""Hard negatives by Kronecker-packed products.

Vectors are integers. Candidates of one label are packed, component by component, into wide
integers: each candidate's component, biased so that it is not negative, has a field of its own. One
multiplication of a wide integer by an anchor's (biased) component multiplies all candidates at
once; the sum over the components holds every inner product in its field. Fields are wide enough
for the largest possible sum, so they never run into each other, and taking the biases off again
leaves exact scores.

Candidates are dealt out evenly into groups of at most ``GROUP_ROWS`` rows, whatever their labels or
ids, and anchors, in small blocks, visit every group: a task holds the packed candidates of one
group and streams the anchors past them. First an anchor meets the candidates of its own label and
its best ones become its positives; with their scores it then meets the other labels, and of each
group only the best of each positive's score window go on to be ranked. The work is that of the
stated anchors against all rows; what is moved is the rows once and the anchors once per group.

Rows whose label or vector is null, or whose vector is empty or holds null or non-finite components,
take no part. Vectors shorter than the longest one are filled up with zeros. An anchor meets all
rows but those with its own id; repeated rows each count, a repeated anchor is answered once per
row. Other columns are not read. No anchors, no positives or no negatives: no rows. Components so
large that a score could pass 63 bits are refused with a ``ValueError``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslink.llm.grouped_stream import held_then_streamed
from corpuslink.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Candidates of a group, of one wide integer, and anchors of a block.
GROUP_ROWS = 1 << 16
WIDE_ROWS = 4096
ANCHOR_ROWS = 64
_NO_SCORE = -(1 << 63)


def labelled_vectors(table: DataFrame, id_column: str, vector_column: str, label: Column, scale: int) -> DataFrame:
    """``vec_id``, ``label`` (as text) and ``v`` (floor of scaled components) of the rows that take
    part. ``label`` may be made of any columns of ``table``."""
    x = F.col(vector_column)
    usable = x.isNotNull() & (F.size(x) > 0)
    usable &= F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return table.where(F.col(id_column).isNotNull() & label.isNotNull() & F.coalesce(usable, F.lit(False))).select(
        F.col(id_column).cast("long").alias("vec_id"),
        label.cast("string").alias("label"),
        F.transform(x, lambda c: F.floor(scale * c.cast("double"))).alias("v"),
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of an array column as int64, filled up to ``width``."""
    flat, sizes = column.flatten().to_numpy(), column.value_lengths().to_numpy()
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


class Packed:
    """Candidates of one label, packed component by component into wide integers.

    ``low`` and ``high`` bound all components of candidates and anchors (and zero)."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, low: int, high: int, wide_rows: int = WIDE_ROWS):
        width = vectors.shape[1]
        most = width * (high - low) ** 2
        if most >= 1 << 62:
            raise ValueError("components are too large for scores of 63 bits")
        self.low, self.field = low, np.dtype("<u4" if most < 1 << 32 else "<u8")
        self.ids, self.parts = ids, []
        for at in range(0, len(ids), wide_rows):
            part = vectors[at : at + wide_rows]
            biased = np.ascontiguousarray((part - low).T).astype(self.field)
            wide = [int.from_bytes(row.tobytes(), "little") for row in biased]
            self.parts.append((wide, len(part), part.sum(axis=1) * -low + width * low * low))

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Inner products of the anchor with all candidates."""
        factors, own = (anchor - self.low).tolist(), int(anchor.sum()) * -self.low
        out = []
        for wide, n, bias in self.parts:
            total = sum(w * f for w, f in zip(wide, factors))
            fields = np.frombuffer(total.to_bytes(n * self.field.itemsize, "little"), self.field)
            out.append(fields.astype(np.int64) - bias - own)
        return np.concatenate(out) if out else np.empty(0, np.int64)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to the smaller id."""
    at = np.arange(len(scores))
    if len(at) > k:
        at = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    return at[np.lexsort((ids[at], -scores[at]))[:k]]


_BLOCK = "a_no binary, a_id binary, a_label array<string>, a_v binary, a_least binary"


def _blocks(anchors: DataFrame, width: int, k: int, rows: int) -> DataFrame:
    """Anchors (``a``, ``vec_id``, ``label``, ``v``, ``positives``) in rows of bytes."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                given = np.full((part.num_rows, k), _NO_SCORE, np.int64)
                for i, scores in enumerate(part["positives"].to_pylist()):
                    given[i, : len(scores or ())] = scores or ()
                cells = [part["a"].to_numpy().tobytes(), part["vec_id"].to_numpy().tobytes(), part["label"].to_pylist(),
                         _matrix(part["v"], width).tobytes(), given.tobytes()]
                kinds = [pa.binary(), pa.binary(), pa.list_(pa.string()), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c], t) for c, t in zip(cells, kinds)], names=["a_no", "a_id", "a_label", "a_v", "a_least"]
                )

    return anchors.select("a", "vec_id", "label", "v", "positives").mapInArrow(gather, _BLOCK)


_FOUND = "a bigint, anchor_id bigint, place int, vec_id bigint, score bigint"


def _met(
    candidates: DataFrame, blocks: DataFrame, groups: int, width: int, low: int, high: int, k: int,
    same: bool, percent: int, wide_rows: int,
) -> DataFrame:
    """Every anchor with every group. ``same``: its ``k`` best of its own label. Else, for each of its
    positives, the ``k`` best of other labels that score ``percent`` of it up to all of it."""

    def load(rows: list[pa.RecordBatch]) -> dict[str, Packed]:
        by_label: dict[str, list] = {}
        for batch in rows:
            labels = batch["label"].dictionary_encode()
            codes, ids, v = labels.indices.to_numpy(), batch["vec_id"].to_numpy(), _matrix(batch["v"], width)
            for code, label in enumerate(labels.dictionary.to_pylist()):
                by_label.setdefault(label, []).append((ids[codes == code], v[codes == code]))
        return {
            label: Packed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), low, high, wide_rows)
            for label, parts in by_label.items()
        }

    def found(packed: dict[str, Packed], row: dict) -> Iterator[tuple]:
        numbers, own_ids = np.frombuffer(row["a_no"], np.int64), np.frombuffer(row["a_id"], np.int64)
        vectors = np.frombuffer(row["a_v"], np.int64).reshape(-1, width)
        least = np.frombuffer(row["a_least"], np.int64).reshape(len(numbers), -1)
        for i, label in enumerate(row["a_label"]):
            met = [p for name, p in packed.items() if (name == label) == same]
            if not met or not (same or (least[i] != _NO_SCORE).any()):
                continue
            ids = np.concatenate([p.ids for p in met])
            scores = np.concatenate([p.scores(vectors[i]) for p in met])
            other = ids != own_ids[i]
            if same:
                windows = [(0, other)]
            else:  # percent * positive <= 100 * negative <= 100 * positive, in whole numbers
                windows = [
                    (place, other & (scores <= s) & (scores >= -(-percent * s // 100)))
                    for place, s in enumerate(least[i].tolist())
                    if s != _NO_SCORE
                ]
            for place, inside in windows:
                at = np.flatnonzero(inside)
                at = at[best(scores[at], ids[at], k)]
                n = len(at)
                yield np.full(n, numbers[i]), np.full(n, own_ids[i]), np.full(n, place, np.int32), ids[at], scores[at]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held, packed = None, [], None
        for batch in batches:
            numbers, streamed = batch["g"].to_numpy(), batch["streamed_row"].to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(numbers) != 0) | (np.diff(streamed.astype(int)) != 0)) + 1
            for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(numbers)]):
                if numbers[a] != group:
                    group, held, packed = int(numbers[a]), [], None
                if not streamed[a]:
                    held.append(batch.slice(a, b - a))
                    continue
                if packed is None:
                    packed, held = load(held), []
                for row in batch.slice(a, b - a).select(["a_no", "a_id", "a_label", "a_v", "a_least"]).to_pylist():
                    parts = list(found(packed, row))
                    if parts:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.concatenate(c)) for c in zip(*parts)],
                            names=["a", "anchor_id", "place", "vec_id", "score"],
                        )

    visits = blocks.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    dealt = held_then_streamed(candidates.select("g", "vec_id", "label", "v"), visits, "g", groups)
    return dealt.mapInArrow(meet, _FOUND)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 5,
    percent: int = 80,
    group_rows: int = GROUP_ROWS,
    wide_rows: int = WIDE_ROWS,
) -> DataFrame:
    """For each row of ``vectors`` (``vec_id``, ``label``, ``v``) that ``is_anchor`` picks and each of
    its ``n_positives`` best rows of the same label: ``anchor_id``, ``positive_id``, ``rank``,
    ``negative_id``, ``positive_score``, ``negative_score`` of the ``n_negatives`` best rows of other
    labels that score from ``percent`` of the positive's score up to it. Ties go to the smaller id."""
    spark = vectors.sparkSession
    seen = vectors.agg(
        F.count("*"), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))
    ).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not seen[0]:
        return spark.createDataFrame([], schema)
    width, low, high = seen[1], min(0, seen[2]), max(0, seen[3])
    if width * (high - low) ** 2 >= 1 << 62:
        raise ValueError("components are too large for scores of 63 bits")
    groups = -(-seen[0] // group_rows)
    # Dealt row by row in turn, so groups are of one size whatever ids and labels repeat.
    candidates = cut_lineage(vectors.repartition(groups).withColumn("g", F.spark_partition_id()))
    anchors = cut_lineage(
        candidates.where(is_anchor).select(F.monotonically_increasing_id().alias("a"), "vec_id", "label", "v")
    )
    k = max(n_positives, n_negatives)

    def met(rows: DataFrame, same: bool, most: int) -> DataFrame:
        return _met(candidates, _blocks(rows, width, k, ANCHOR_ROWS), groups, width, low, high, most, same, percent, wide_rows)

    none = F.lit(None).cast("array<long>")
    order = Window.partitionBy("a").orderBy(F.desc("score"), "vec_id")
    positives = cut_lineage(
        met(anchors.withColumn("positives", none), True, n_positives)
        .withColumn("place", F.row_number().over(order) - 1)
        .where(F.col("place") < n_positives)
        .select("a", "place", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    )
    # At most n_positives rows an anchor.
    scored = positives.groupBy("a").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "positive_score"))), lambda p: p["positive_score"])
        .alias("positives")
    )
    negatives = met(anchors.join(scored, "a"), False, n_negatives)
    order = Window.partitionBy("a", "place").orderBy(F.desc("score"), "vec_id")
    return (
        negatives.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n_negatives)
        .join(positives, ["a", "place"])
        .select(
            "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
            "positive_score", F.col("score").alias("negative_score"),
        )
    )
