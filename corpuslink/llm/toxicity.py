"""Toxic passages as maximum-scoring segments of token log-odds.

Tokens are lower-cased runs of letters and digits. From a bounded sample of labelled documents and
the token counts of all documents, every token gets the log-odds of the toxic against the other
class under an informative Dirichlet prior: the corpus frequencies, ``PRIOR`` tokens strong, on top
of ``FLOOR`` for every token. In the sample a token counts once for each document, and equal texts
count once, so copies do not weigh as evidence. A token scores the side of its confidence interval nearer to zero; all others score zero; a drift is
taken off so that an ordinary text scores below zero on average. One linear scan finds all
maximal-scoring segments (Ruzzo and Tompa). Segment scores of ordinary text follow an extreme-value
law whose two parameters come from the token frequencies and the sample; the segments that are
significant for their document's length add up to its evidence, and a logistic curve fitted on the
sample turns evidence into a probability.

Counts for the prior are combined in each task and grouped over all documents. What the driver
sees is bounded: at most ``max_tokens`` scored tokens and ``fit_rows`` pairs of evidence and label.

A null or empty text has no passages and the score of no evidence. Repeated rows are scored alike;
a document labelled more than once counts as toxic if any label says so. Without labels of both
classes nothing can be learned and every document scores the share of toxic labels. Columns other
than ``doc_id`` and ``text`` (and ``toxic`` of the labels) are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslink.llm.wordhash import WordHasher, blocks, give_back, not_letters
from corpuslink.session import cut_lineage

cloudpickle.register_pickle_by_value(sys.modules[__name__])

PRIOR = 500.0
FLOOR = 0.5
#: Standard errors taken off a log-odds before it counts.
CAUTION = 3.0
FIT_ROWS = 20_000
SIGNIFICANT = 0.05
_COUNT_EVERY = 1_500_000


@dataclass(frozen=True)
class Model:
    tokens: np.ndarray  # sorted hashes
    scores: np.ndarray
    drift: float
    decay: float  # of the extreme-value law, per unit of score
    log_k: float
    weights: tuple[float, float]  # intercept, evidence


def segments(positions: np.ndarray, gains: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal-scoring segments as (first, last, score): token ``positions[i]`` scores
    ``gains[i] - drift``, every other one ``-drift``."""
    keep = gains > drift
    loss = np.concatenate([[0.0], np.cumsum(gains - drift)])
    before = (loss[:-1] - drift * (positions - np.arange(len(positions))))[keep].tolist()
    after = (loss[1:] - drift * (positions - np.arange(len(positions))))[keep].tolist()
    found: list[list] = []  # first, last, sum before, sum after, last candidate with a smaller sum before
    for at, low, high in zip(positions[keep].tolist(), before, after):
        item = [at, at, low, high]
        while True:
            j = len(found) - 1
            while j >= 0 and found[j][2] >= item[2]:
                j = found[j][4]
            if j < 0 or found[j][3] >= item[3]:
                found.append([*item, j])
                break
            item = [found[j][0], item[1], found[j][2], item[3]]
            del found[j:]
    return [(a, b, high - low) for a, b, low, high, _ in found]


def _evidence(found: list[tuple[int, int, float]], n_words: int, model: Model) -> tuple[float, list]:
    """Sum of the normalised scores of the significant segments, and these segments."""
    normal = [model.decay * s - model.log_k - np.log(n_words) for _, _, s in found]
    held = [(x, f) for x, f in zip(normal, found) if x > -np.log(SIGNIFICANT)]
    return sum(x for x, _ in held), [f for _, f in held]


def _scanned(batches: Iterator[pa.RecordBatch], model: Model):
    hasher = WordHasher(not_letters())
    for batch in batches:
        for low, high, data, offsets in blocks(batch["text"]):
            hashes, begins = hasher.words(data, offsets)
            at = np.minimum(np.searchsorted(model.tokens, hashes), max(len(model.tokens) - 1, 0))
            hit = np.flatnonzero(model.tokens[at] == hashes) if len(model.tokens) else np.empty(0, np.int64)
            gains = model.scores[at[hit]] if len(hit) else np.empty(0)
            edges = np.searchsorted(hit, begins)
            results = []
            for i in range(high - low):
                a, b = edges[i], edges[i + 1]
                found = segments(hit[a:b] - begins[i], gains[a:b], model.drift) if b > a else []
                results.append((found, int(begins[i + 1] - begins[i])))
            yield batch.slice(low, high - low), results


def token_counts(docs: DataFrame, label: str | None = None) -> DataFrame:
    """``token`` (hash), ``label`` (-1 without one) and ``n``, combined within each task only. With
    labels a document counts a token once."""
    read = docs.select("text", F.col(label).cast("int").alias("label") if label else F.lit(-1).alias("label"))

    @give_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(not_letters())
        held: dict[int, list[np.ndarray]] = {}
        total = 0

        def flush():
            for key, parts in held.items():
                tokens, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens.view(np.int64)), pa.array(np.full(len(n), key, np.int32)), pa.array(n)],
                    names=["token", "label", "n"],
                )

        for batch in batches:
            labels = batch["label"].to_numpy(zero_copy_only=False)
            for low, high, data, offsets in blocks(batch["text"]):
                hashes, begins = hasher.words(data, offsets)
                if label:
                    place = np.repeat(np.arange(high - low), np.diff(begins))
                    order = np.lexsort((hashes, place))
                    hashes, place = hashes[order], place[order]
                    new = np.ones(len(hashes), bool)
                    new[1:] = (hashes[1:] != hashes[:-1]) | (place[1:] != place[:-1])
                    hashes, own = hashes[new], labels[low:high][place[new]]
                else:
                    own = np.full(len(hashes), -1)
                for key in np.unique(own).tolist():
                    held.setdefault(key, []).append(hashes[own == key])
                total += len(hashes)
                if total > _COUNT_EVERY:
                    yield from flush()
                    held, total = {}, 0
        yield from flush()

    return read.mapInArrow(count, "token bigint, label int, n bigint")


def _decay(scores: np.ndarray, shares: np.ndarray, drift: float) -> float:
    """The positive root of sum(share * exp(decay * score)) = 1; tokens without a score drift."""
    rest = 1.0 - shares.sum()
    low, high = 1e-6, 64.0
    for _ in range(80):
        mid = (low + high) / 2
        with np.errstate(over="ignore"):
            over = (shares * np.exp(mid * (scores - drift))).sum() + rest * np.exp(-mid * drift) > 1
        low, high = (low, mid) if over else (mid, high)
    return low


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """Learn from at most ``fit_rows`` of ``labels`` (``doc_id``, ``toxic``), taken by hash. Every token
    of these rows whose log-odds are beyond doubt is scored; their number is bounded by the rows."""
    chosen = (
        labels.where("doc_id is not null and toxic is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    # The chosen rows are bounded by a parameter, so they may be sent to every task.
    sample = cut_lineage(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy(F.md5("text"), "text").agg(F.max("toxic").alias("toxic"))
        .select("text", "toxic")
    )
    counted = (
        token_counts(docs).union(token_counts(sample, "toxic"))
        .groupBy("token")
        .agg(*(F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)).alias(c) for k, c in ((-1, "n"), (0, "y0"), (1, "y1"))))
    )
    counted = cut_lineage(counted)
    sums = counted.agg(
        F.count("*").alias("kinds"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "y0", "y1"))
    ).first()
    empty = Model(np.empty(0, np.uint64), np.empty(0), 0.1, 1.0, 0.0, (0.0, 0.0))
    if not sums["y0"] or not sums["y1"]:
        share = sample.agg(F.avg("toxic")).first()[0]
        share = min(max(share if share is not None else 0.0, 1e-6), 1 - 1e-6)
        return Model(empty.tokens, empty.scores, 0.1, 1.0, 0.0, (float(np.log(share / (1 - share))), 0.0))
    prior, all_prior = FLOOR + F.col("n") * (PRIOR / sums["n"]), PRIOR + FLOOR * sums["kinds"]

    def log_odds(y: str):
        return F.log((F.col(y) + prior) / (sums[y] + all_prior - F.col(y) - prior))

    rated = (
        counted.where("y1 + y0 > 0")
        .select(
            "token",
            (F.col("n") / sums["n"]).alias("share"),
            (log_odds("y1") - log_odds("y0")).alias("d"),
            (CAUTION * F.sqrt(1 / (F.col("y1") + prior) + 1 / (F.col("y0") + prior))).alias("e"),
        )
        .where(F.abs("d") > F.col("e"))
        .toPandas()
    )
    tokens = rated["token"].to_numpy(np.int64).view(np.uint64)
    scores = (np.sign(rated["d"]) * (rated["d"].abs() - rated["e"])).to_numpy(float)
    shares = rated["share"].to_numpy(float)
    order = np.argsort(tokens)
    tokens, scores, shares = tokens[order], scores[order], shares[order]
    drift = 0.05 + max(0.0, 2.0 * float((scores * shares).sum()))
    decay = _decay(scores, shares, drift)
    first = Model(tokens, scores, drift, decay, 0.0, (0.0, 1.0))

    @give_back
    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, results in _scanned(batches, first):
            yield pa.RecordBatch.from_arrays(
                [
                    batch["toxic"],
                    pa.array([n for _, n in results], pa.int64()),
                    pa.array([[float(s) for _, _, s in found] for found, _ in results], pa.list_(pa.float64())),
                ],
                names=["toxic", "n", "found"],
            )

    seen = sample.mapInArrow(best, "toxic int, n bigint, found array<double>").toPandas()
    toxic, n_words = seen["toxic"].to_numpy(), seen["n"].to_numpy(float)
    best_score = np.array([max(f) if len(f) else 0.0 for f in seen["found"]])
    # K: as many ordinary documents pass the smallest segment score as the law says.
    ordinary = (toxic == 0) & (n_words > 0)
    gains = scores[scores > drift] - drift
    least = float(gains.min()) if len(gains) else 1.0
    passed = max(1, int((best_score[ordinary] >= least).sum()))
    log_k = float(np.log(passed / max(1.0, n_words[ordinary].sum())) + decay * least)
    law = Model(tokens, scores, drift, decay, log_k, (0.0, 1.0))
    evidence = np.array(
        [_evidence([(0, 0, s) for s in f], max(n, 1), law)[0] for f, n in zip(seen["found"], n_words)]
    )
    return Model(tokens, scores, drift, decay, log_k, _logistic(_shape(evidence), toxic.astype(float)))


def _shape(evidence):
    return np.log1p(evidence)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    design = np.stack([np.ones_like(x), x], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (y - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0]), float(w[1])


_SCORED = (
    "doc_id bigint, score double, predicted int, "
    "passages array<struct<first_word: bigint, last_word: bigint, score: double>>"
)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1), ``predicted`` and the significant ``passages`` of every row."""
    kind = pa.list_(pa.struct([("first_word", pa.int64()), ("last_word", pa.int64()), ("score", pa.float64())]))

    @give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, results in _scanned(batches, model):
            held = [_evidence(found, max(n, 1), model) for found, n in results]
            margin = model.weights[0] + model.weights[1] * _shape(np.array([e for e, _ in held]))
            value = 1 / (1 + np.exp(-np.clip(margin, -30, 30)))
            passages = [[{"first_word": a, "last_word": b, "score": s} for a, b, s in p] for _, p in held]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(value), pa.array((value >= 0.5).astype(np.int32)), pa.array(passages, kind)],
                names=["doc_id", "score", "predicted", "passages"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, _SCORED)


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the model does not call toxic, with all their columns."""

    @give_back
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, results in _scanned(batches, model):
            margin = model.weights[0] + model.weights[1] * _shape(
                np.array([_evidence(found, max(n, 1), model)[0] for found, n in results])
            )
            yield batch.filter(pa.array(margin < 0))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id) -> Column:
    """Rows whose labels are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def toxic_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Learn from the labels that are not held out and score all of ``docs``."""
    model = fit(docs, labels.where(~held_out(F.col("doc_id"))))
    return score(docs, model).withColumn("held_out", held_out(F.col("doc_id")))
